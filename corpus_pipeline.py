"""The pipeline over the text operators: five stages, each a function of (spark, docs, sf_dir)."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from precedent.llm import bpe, decontaminate, language, ngram_join, secret_scan
from precedent.session import fresh_path

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
#: A document whose best language has a smaller share of the evidence is rejected.
LEAST_SCORE = 0.5


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that the model knows; texts without letters and doubtful ones go.

    The stage never writes its own guess over ``lang``. Null texts have no language and go.
    """
    model = language.train(docs.select("text", "lang"))
    found = language.with_language(docs.select(*COLUMNS), model)
    return found.where((F.col("lang_pred") != language.UNDETERMINED) & (F.col("score") >= LEAST_SCORE)).select(*COLUMNS)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: that of the least id (of these, the least text).

    Documents without words are linked with nothing and stay; so does a row without id, unless its group has another.
    """
    rows = ngram_join.link_components(docs.select("doc_id", "text"))
    least = rows.where("label is not null").groupBy("label").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "node")).alias("best"))
    best = least.select(F.col("best.doc_id").alias("id"), F.col("best.node").alias("node"))
    empty = rows.where("node is null").select(F.col("doc_id").alias("id"), "node")
    keep = best.union(empty).distinct()
    columns = docs.select(*COLUMNS).withColumn("node", ngram_join.node_column(F.col("text")))
    found = columns.join(keep, F.col("doc_id").eqNullSafe(F.col("id")) & columns["node"].eqNullSafe(keep["node"]), "left_semi")
    # Rows that repeat one id and text are copies as well.
    whole = found.where("node is null").select(*COLUMNS)
    return found.where("node is not null").dropDuplicates(["doc_id", "node"]).select(*COLUMNS).union(whole)


def remove_benchmark_items(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no item of the benchmark."""
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontaminate.decontaminate(docs.select(*COLUMNS), items)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, its secrets replaced by a mark and ``n_chars`` brought up to date."""
    found = secret_scan.scan_secrets(docs.select(*COLUMNS))
    # A lambda variable holds the new text, so it is made once for both columns.
    both = F.transform(
        F.array(secret_scan.redact(F.col("text"), F.col("secret_spans"))),
        lambda text: F.struct(text.alias("text"), F.length(text).cast("long").alias("n")),
    )
    found = found.withColumn("_new", both[0])
    n_chars = F.when(F.size("secret_spans") > 0, F.col("_new.n")).otherwise(F.col("n_chars"))
    return found.select("doc_id", F.col("_new.text").alias("text"), "lang", "source", n_chars.alias("n_chars"))


def encode_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang, source, n_chars, token_ids and n_tokens of every document."""
    encoded = bpe.encode_documents(docs.select(*COLUMNS), TOKENIZER)
    return encoded.withColumn("n_tokens", F.size("token_ids").cast("long"))


STAGES = [
    ("language ID", identify_language),
    ("n-gram Jaccard join", drop_near_copies),
    ("benchmark decontamination", remove_benchmark_items),
    ("secret scans", redact_secrets),
    ("BPE encoding", encode_tokens),
]

#: SQL cannot express language ID and BPE; the tests hold each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``; each is written as Parquet and read again by the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for at, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if at < len(STAGES) - 1:
            path = fresh_path(spark, f"stage-{at}")
            docs.write.parquet(path)
            docs = spark.read.parquet(path)
    return docs
