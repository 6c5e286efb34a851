"""Tables derived from the given ones, and the queries that run the library on them.

Every table here uses all rows of its source. ``% n`` on an id only chooses which
kind of row is made (a close query, an unanswerable one, a broken ticket), never
which rows are kept.
"""

import re

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from precedent.functions.grounding import SECTION_NAMES, answer_sections, violation
from precedent.functions.prompts import (
    abstain_answer,
    evidence_text,
    prompt_messages,
    repair_messages,
)
from precedent.functions.text import citations
from precedent.operators import dense, lexical, metrics, probing, validate
from precedent.operators.gate import gate_and_select
from precedent.operators.rank import evidence_lists, ranked_listing, top_k_per_query, with_ticket_fields
from precedent.operators.vectorize import embed_function, tf_idf, vector_column, with_vectors
from precedent.plans.evaluate import evaluate
from precedent.plans.resolve import resolve, response_rows, run_metrics
from precedent.plans.retrieve import retrieve
from precedent.schemas import HEADINGS, ROUTE_ABSTAIN
from precedent.session import fresh_path, materialize
from precedent.sources.index_store import build_index, index_status, open_index
from precedent.sources.tickets import read_cases_json, read_tickets_csv, ticket_documents
from precedent.streaming.resolve_stream import METRICS, RESULTS, resolve_stream

ANY_ID = "SR[0-9]+"
GIVEN = vector_column("vector", "given")
H1, H2, H3, H4 = HEADINGS


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# -- vectors: tickets, queries, cases -----------------------------------------


def _mixed(weight: Column) -> Column:
    """(1 - weight) of the own vector and ``weight`` of the next one."""
    return F.zip_with("v", "w", lambda a, b: (1.0 - weight) * a + weight * b)


def _pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("i"), "label", F.col("embedding").cast("array<double>").alias("v")
    )
    n = F.lit(rows.count())
    following = rows.select(((F.col("i") + n - 1) % n).alias("i"), F.col("v").alias("w"))
    return rows.join(following, "i")


def vector_tickets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each vector as a ticket, and a mixture with its neighbour as another."""
    pairs = _pairs(spark, sf_dir)
    share = F.lit(0.05) + F.lit(0.15) * (F.col("i") % 7)
    mixtures = pairs.withColumn("vector", _mixed(share)).withColumn("i", F.col("i") + 1000000)
    both = pairs.select("i", "label", F.col("v").alias("vector")).unionByName(
        mixtures.select("i", "label", "vector")
    )
    return both.select(
        F.concat(F.lit("SR"), F.col("i").cast("string")).alias("ticket_id"),
        F.concat(F.lit("family "), F.col("label").cast("string")).alias("product"),
        F.concat(F.lit("symptom of vector "), F.col("i").cast("string")).alias("issue"),
        F.concat(F.lit("remedy of vector "), F.col("i").cast("string")).alias("resolution"),
        "vector",
    )


def vector_cases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled cases: near, halfway and far queries, and two kinds without an answer."""
    kind = F.col("i") % 5
    share = F.when(kind == 2, 0.48).when(kind == 3, 0.6).otherwise(0.2)
    return _pairs(spark, sf_dir).select(
        F.col("i").cast("string").alias("id"),
        F.concat(F.lit("kind "), kind.cast("string")).alias("category"),
        F.concat(F.lit("request about vector "), F.col("i").cast("string")).alias("query"),
        F.when(
            kind.isin(1, 2, 3), F.concat(F.lit("SR"), F.col("i").cast("string"))
        ).alias("expected_ticket_id"),
        F.when(kind == 0, F.reverse("v")).otherwise(_mixed(share)).alias("vector"),
    )


def vector_queries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_cases(spark, sf_dir).select(
        F.col("id").alias("query_id"), F.col("query").alias("issue"), "vector"
    )


def retrieved(spark: SparkSession, sf_dir: str, **plan) -> DataFrame:
    tickets = vector_tickets(spark, sf_dir)
    queries = vector_queries(spark, sf_dir)
    return with_ticket_fields(dense.dense_top_k(tickets, queries, 3, **plan), tickets)


def gated(spark: SparkSession, sf_dir: str) -> DataFrame:
    queries = vector_queries(spark, sf_dir).select("query_id", "issue")
    found = evidence_lists(retrieved(spark, sf_dir))
    return gate_and_select(queries.join(found, "query_id", "left"))


def _ids(evidence: str) -> Column:
    return F.array_join(F.col(evidence)["ticket_id"], ",")


def _top(rows: DataFrame) -> DataFrame:
    return rows.select(
        "query_id",
        F.col("rank").cast("long").alias("rank"),
        "ticket_id",
        F.round("similarity_score", 6).alias("similarity_score"),
    )


def retrieve_topk_dense(spark, sf_dir):
    return _top(retrieved(spark, sf_dir))


def retrieve_topk_cells(spark, sf_dir):
    return _top(retrieved(spark, sf_dir, broadcast_bytes=0))


def retrieve_topk_tree(spark, sf_dir):
    """From a stored index with two levels of cells, by visits of leaves."""
    index = _vector_index(spark, sf_dir, two_levels=True, leaf_rows=32)
    issues = vector_queries(spark, sf_dir)
    return _top(retrieve(index, issues, GIVEN, 3, broadcast_bytes=0))


def retrieve_ivf(spark, sf_dir):
    return _top(retrieved(spark, sf_dir, n_probe=dense.MAX_CELLS))


def retrieve_cosine(spark, sf_dir):
    return _top(retrieved(spark, sf_dir, metric=dense.COSINE))


def ivf_recall(spark, sf_dir):
    """What probes fitted to a recall of 0.95 on a sample find for all queries, and whether a quarter of the cells was enough."""
    queries = materialize(vector_queries(spark, sf_dir).select("query_id", "vector"))
    tickets = vector_tickets(spark, sf_dir).select("ticket_id", "vector")
    exact = dense.dense_top_k(tickets, queries, 3)
    assigned, cells = probing.build_probing_cells(tickets)
    fitted = probing.calibrate(assigned, cells, queries, 3, 0.95)
    found = top_k_per_query(probing.probed_hits(assigned, queries, cells, 3, fitted), 3)
    share = probing.probed_share(queries, cells, 3, fitted).head().probed_share
    return dense.recall_against(exact, found).select(
        "n_expected", (F.col("recall") >= 0.95).alias("recall_reached"), F.lit(share <= 0.25).alias("few_cells")
    )


def listing(spark, sf_dir):
    rows = ranked_listing(retrieved(spark, sf_dir))
    return rows.withColumn("rank", F.col("rank").cast("long"))


def gate_and_select_rows(spark, sf_dir):
    return gated(spark, sf_dir).select(
        "query_id",
        "route",
        "evidence_sufficient",
        F.round(F.col("evidence")[0]["similarity_score"], 6).alias("top_score"),
        _ids("evidence").alias("evidence_ids"),
        _ids("generation_evidence").alias("sent_ids"),
    )


# -- evaluation ---------------------------------------------------------------


def _results(spark, sf_dir):
    cases = vector_cases(spark, sf_dir).drop("vector")
    return metrics.case_results(cases, evidence_lists(retrieved(spark, sf_dir)))


def eval_cases(spark, sf_dir):
    return (
        _results(spark, sf_dir)
        .withColumn("top_score", F.round("top_score", 6))
        .withColumn("reciprocal_rank", F.round("reciprocal_rank", 6))
    )


def _rounded_totals(totals: DataFrame) -> DataFrame:
    return totals.withColumn("recall", F.round("recall", 6)).withColumn("mrr", F.round("mrr", 6))


def eval_summary(spark, sf_dir):
    return _rounded_totals(metrics.summary(_results(spark, sf_dir), 3))


def eval_by_category(spark, sf_dir):
    rows = metrics.mrr_by_category(_results(spark, sf_dir))
    return rows.withColumn("mrr", F.round("mrr", 6))


def eval_check(spark, sf_dir):
    return _rounded_totals(
        metrics.regression_check(metrics.summary(_results(spark, sf_dir), 3), 0.25)
    )


def eval_from_index(spark, sf_dir):
    index = _vector_index(spark, sf_dir)
    return _rounded_totals(evaluate(index, vector_cases(spark, sf_dir), GIVEN, 3).summary)


# -- texts --------------------------------------------------------------------


def _messages_text(messages: Column) -> Column:
    lines = F.transform(messages, lambda m: F.concat(m["role"], F.lit(": "), m["content"]))
    return F.array_join(lines, "\n----\n")


def evidence_texts(spark, sf_dir):
    rows = gated(spark, sf_dir)
    return rows.select(
        "query_id",
        evidence_text(F.col("evidence")).alias("all_text"),
        evidence_text(F.col("generation_evidence")).alias("sent_text"),
        # An empty list has its own fixed sentence.
        evidence_text(F.slice("evidence", 1, 0)).alias("no_text"),
    )


def prompts(spark, sf_dir):
    rows = gated(spark, sf_dir)
    messages = prompt_messages(F.col("issue"), F.col("generation_evidence"))
    return rows.select("query_id", _messages_text(messages).alias("messages"))


def repair_prompts(spark, sf_dir):
    rows = _answers(spark, sf_dir).where(F.col("code").isNotNull())
    first = prompt_messages(F.col("issue"), F.col("generation_evidence"))
    messages = repair_messages(first, F.col("answer"), F.col("detail"))
    return rows.select("query_id", _messages_text(messages).alias("messages"))


def abstain_answers(spark, sf_dir):
    rows = gated(spark, sf_dir).where(F.col("route") == ROUTE_ABSTAIN)
    return rows.select("query_id", abstain_answer().alias("answer"))


# -- grounding ----------------------------------------------------------------


def _answer_text(i: Column, ticket_id: Column) -> Column:
    """An answer whose fault depends on the id of its query."""
    kind = i % 7

    def by_kind(at, other, default):
        return F.when(kind == at, other).otherwise(default)

    first = by_kind(6, F.lit(f"{H1}\nOnce more.\n{H1}"), F.lit(H1))
    second = by_kind(3, F.lit(H3), F.lit(H2))
    third = by_kind(3, F.lit(H2), F.lit(H3))
    cause = by_kind(2, F.lit("As in SR99999999."), F.lit("A known fault."))
    fix = by_kind(4, F.lit(" \t "), F.lit("Apply the remedy."))
    cited = by_kind(1, F.lit("None."), ticket_id)
    limits = by_kind(5, F.lit("There is No Direct Evidence here."), F.lit("No material gap."))
    parts = [first, cause, second, fix, third, cited, F.lit(H4), limits]
    return F.concat_ws("\n", *parts)


def _answers(spark, sf_dir):
    answer = _answer_text(F.col("query_id").cast("long"), F.col("generation_evidence")[0]["ticket_id"])
    found = violation(F.col("answer"), F.col("generation_evidence")["ticket_id"], ANY_ID)
    return (
        gated(spark, sf_dir)
        .withColumn("answer", answer)
        .withColumn("found", found)
        .select("*", F.col("found.code").alias("code"), F.col("found.detail").alias("detail"))
    )


def sections(spark, sf_dir):
    rows = _answers(spark, sf_dir)
    parts = answer_sections(F.col("answer"))
    return rows.select("query_id", *[parts[name].alias(name) for name in SECTION_NAMES])


def cited_ids(spark, sf_dir):
    """Every id of the answers, and the anti-join with the supplied evidence."""
    rows = _answers(spark, sf_dir)
    cited = rows.select("query_id", F.explode(citations(F.col("answer"), ANY_ID)).alias("ticket_id"))
    sent = rows.select("query_id", F.explode(F.col("generation_evidence")["ticket_id"]).alias("ticket_id"))
    unknown = cited.join(sent, ["query_id", "ticket_id"], "left_anti").withColumn(
        "unknown", F.lit(True)
    )
    return cited.join(unknown, ["query_id", "ticket_id"], "left").fillna(False, ["unknown"])


def grounding(spark, sf_dir):
    return _answers(spark, sf_dir).select("query_id", "code", "detail")


# -- tickets and issues from texts ----------------------------------------------


def chat_tickets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A user turn and the assistant turn right after it make one ticket."""
    turns = table(spark, sf_dir, "conversations")
    asked = turns.where(F.col("role") == "user")
    replied = turns.where(F.col("role") == "assistant").select(
        "conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("resolution")
    )
    number = (F.col("conv_id") * 1000 + F.col("turn")).cast("string")
    return asked.join(replied, ["conv_id", "turn"]).select(
        F.concat(F.lit("SR"), number).alias("ticket_id"),
        F.concat(F.lit("product "), (F.col("conv_id") % 5).cast("string")).alias("product"),
        F.col("text").alias("issue"),
        "resolution",
    )


def retrieval_texts(spark, sf_dir):
    return ticket_documents(chat_tickets(spark, sf_dir))


def ticket_violations(spark, sf_dir):
    number = F.substring("ticket_id", 3, 20).cast("long")
    broken = chat_tickets(spark, sf_dir).select(
        F.when(number % 17 == 0, F.lower("ticket_id"))
        .when(number % 13 == 0, F.lit("SR1"))
        .otherwise(F.col("ticket_id"))
        .alias("ticket_id"),
        F.when(number % 19 == 0, F.lit(" \t")).otherwise(F.col("product")).alias("product"),
        F.when(number % 23 != 0, F.col("issue")).alias("issue"),
        F.when(number % 11 == 0, F.lit("")).otherwise(F.col("resolution")).alias("resolution"),
    )
    return validate.ticket_violations(broken, ANY_ID)


def case_violations(spark, sf_dir):
    item = F.col("item_id")
    cases = table(spark, sf_dir, "benchmark").select(
        F.when(item % 9 == 0, F.lit("again")).otherwise(item.cast("string")).alias("id"),
        F.when(item % 8 == 0, F.lit(" ")).otherwise(F.lit("passage")).alias("category"),
        F.when(item % 7 == 0, F.lit(" abc ")).otherwise(F.col("text")).alias("query"),
        F.when(item % 6 == 0, F.lit("")).when(item % 2 == 0, item.cast("string")).alias(
            "expected_ticket_id"
        ),
    )
    return validate.case_violations(cases)


def document_issues(spark, sf_dir):
    doc = F.col("doc_id")
    return table(spark, sf_dir, "documents").select(
        doc.cast("string").alias("query_id"),
        F.when(doc % 29 != 0, F.concat(F.lit("\n "), F.col("text"), F.lit("\t"))).alias("issue"),
        (doc % 8 - 1).cast("int").alias("top_k"),
    )


def issue_status(spark, sf_dir):
    rows = validate.issue_status(document_issues(spark, sf_dir))
    return rows.select(
        "query_id",
        F.coalesce(F.length("issue"), F.lit(-1)).cast("long").alias("n_chars"),
        F.col("top_k").cast("long"), "status"
    )


# -- sources and index ----------------------------------------------------------


def csv_roundtrip(spark, sf_dir):
    path = fresh_path(spark, "tickets-csv")
    (
        chat_tickets(spark, sf_dir)
        .write.option("header", True)
        .option("escape", '"')
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )
    return read_tickets_csv(spark, path)


def cases_json(spark, sf_dir):
    """Cases written as one JSON array, and read back in byte ranges."""
    path = fresh_path(spark, "cases-json")
    item = F.col("item_id")
    cases = table(spark, sf_dir, "benchmark").select(
        F.struct(
            item.cast("string").alias("id"),
            F.lit("passage").alias("category"),
            F.col("text").alias("query"),
            F.when(item % 2 == 0, item.cast("string")).alias("expected_ticket_id"),
        ).alias("case"),
        item.alias("at"),
    )
    # A line per element, the brackets and commas around them: the file of one writer.
    n = cases.count()
    ordered = cases.orderBy("at").withColumn("place", F.row_number().over(Window.orderBy("at")))
    begin = F.when(F.col("place") == 1, "[").otherwise("")
    end = F.when(F.col("place") == n, "]").otherwise(",")
    value = F.concat(begin, F.to_json("case", {"ignoreNullFields": "false"}), end)
    ordered.coalesce(1).select(value.alias("value")).write.text(path)
    return read_cases_json(spark, path)


def _chat_index(spark, sf_dir):
    return build_index(
        chat_tickets(spark, sf_dir), fresh_path(spark, "chat-index"), tf_idf(), id_pattern=ANY_ID
    )


def _vector_index(spark, sf_dir, **plan):
    return build_index(
        vector_tickets(spark, sf_dir), fresh_path(spark, "vector-index"), GIVEN, id_pattern=ANY_ID, **plan
    )


def index_roundtrip(spark, sf_dir):
    path = _chat_index(spark, sf_dir).path
    return open_index(spark, path).table("tickets")


def index_states(spark, sf_dir):
    """A built index and one that is not there."""
    built = index_status(spark, _chat_index(spark, sf_dir).path)
    missing = index_status(spark, fresh_path(spark, "no-index"))
    return built.withColumn("which", F.lit("built")).unionByName(
        missing.withColumn("which", F.lit("missing"))
    )


def _renumbered(tickets: DataFrame) -> DataFrame:
    """The tickets under ids that none of them has: numbers with a leading zero, which ``chat_tickets`` never writes."""
    return tickets.withColumn("ticket_id", F.concat(F.lit("SR0"), F.substring("ticket_id", 3, 20)))


def index_versions(spark, sf_dir):
    """Kept as it is without ``reset``, replaced with it."""
    first = _chat_index(spark, sf_dir)
    tickets = chat_tickets(spark, sf_dir)
    more = tickets.unionByName(_renumbered(tickets))
    kept = build_index(more, first.path, tf_idf(), id_pattern=ANY_ID)
    reset = build_index(more, first.path, tf_idf(), reset=True, id_pattern=ANY_ID)
    rows = None
    for step, index in (("built", first), ("kept", kept), ("reset", reset)):
        row = index.table("tickets").agg(F.count(F.lit(1)).alias("n_tickets"))
        row = row.withColumn("step", F.lit(step)).withColumn(
            "version", F.lit(index.version).cast("long")
        )
        rows = row if rows is None else rows.unionByName(row)
    return rows


# -- lexical --------------------------------------------------------------------


def _documents(spark, sf_dir):
    return table(spark, sf_dir, "documents").select(
        F.col("doc_id").cast("string").alias("ticket_id"), "text"
    )


def _passages(spark, sf_dir):
    return table(spark, sf_dir, "benchmark").select(
        F.col("item_id").cast("string").alias("query_id"), "text"
    )


def lexical_weights(spark, sf_dir):
    forward, _, _ = lexical.tfidf(_documents(spark, sf_dir), "ticket_id", "text")
    return forward.select(
        "ticket_id", F.explode(F.arrays_zip("terms", "weights")).alias("t")
    ).select(
        "ticket_id",
        F.col("t.terms").alias("term"),
        F.round("t.weights", 6).alias("weight"),
    )


def _lexical(spark, sf_dir, **plan):
    forward, vocab, n = lexical.tfidf(_documents(spark, sf_dir), "ticket_id", "text")
    queries = lexical.query_weights(_passages(spark, sf_dir), "text", vocab, n)
    return _top(lexical.lexical_top_k(forward, queries, 3, **plan))


def lexical_topk(spark, sf_dir):
    return _lexical(spark, sf_dir)


def lexical_topk_blocks(spark, sf_dir):
    return _lexical(spark, sf_dir, broadcast_queries=0)


def lexical_retrieve(spark, sf_dir):
    """All user turns of the chats against the stored chat index."""
    index = _chat_index(spark, sf_dir)
    turns = table(spark, sf_dir, "conversations").where(F.col("role") == "user")
    issues = turns.select(
        (F.col("conv_id") * 1000 + F.col("turn")).cast("string").alias("query_id"),
        F.col("text").alias("issue"),
    )
    rows = retrieve(index, issues, tf_idf(), 3)
    return _top(rows)


# -- embedding function ---------------------------------------------------------

LETTERS = "abcdefghijklmnopqrstuvwxyz"


def _ship(spark):
    """Functions of this file run in Python workers, which have to import it."""
    spark.sparkContext.addPyFile(__file__)


def load_letter_counts():
    """A stand-in for a model: how often each letter occurs."""

    def embed(texts):
        return np.array([[1.0, *(text.count(c) for c in LETTERS)] for text in texts])

    return embed


def embed_topk(spark, sf_dir):
    _ship(spark)
    letters = embed_function(load_letter_counts, "letters")
    tickets = with_vectors(_documents(spark, sf_dir), "text", letters)
    queries = with_vectors(_passages(spark, sf_dir), "text", letters)
    return _top(dense.dense_top_k(tickets, queries, 3))


# -- resolve ----------------------------------------------------------------------


def template_generator(messages):
    """Deterministic text; its fault depends on the number in the issue."""
    request = messages[1]["content"]
    number = int(re.search(r"about vector (\d+)", request).group(1))
    ticket = re.search(r"Historical ticket (SR\d+)", request).group(1)
    retry = len(messages) > 2
    if number % 41 == 0:
        raise RuntimeError("no connection")
    if number % 37 == 0:
        return "  \n"
    kind = (0 if number % 2 == 0 else 2) if retry else number % 7
    lines = [H1, "A known fault.", H2, "Apply the remedy.", H3, ticket, H4, "No material gap."]
    if kind == 1:
        lines[5] = "None."
    if kind == 2:
        lines[1] = "As in SR99999999."
    if kind == 3:
        lines[2], lines[4] = H3, H2
    if kind == 4:
        lines[3] = " \t "
    if kind == 5:
        lines[7] = "There is No Direct Evidence here."
    if kind == 6:
        lines[0] = f"{H1}\nOnce more.\n{H1}"
    return "\n".join(lines)


def request_issues(spark, sf_dir):
    """All queries, some with a broken issue text or a bad ``top_k``."""
    i = F.col("query_id").cast("long")
    return vector_queries(spark, sf_dir).select(
        "query_id",
        F.when(i % 31 == 0, F.lit(" bad ")).otherwise(F.col("issue")).alias("issue"),
        F.when(i % 29 == 0, F.lit(6)).otherwise((i % 3 + 1).cast("int")).alias("top_k"),
        "vector",
    )


def _resolved(spark, sf_dir):
    _ship(spark)
    index = _vector_index(spark, sf_dir)
    return resolve(
        index,
        request_issues(spark, sf_dir),
        GIVEN,
        template_generator,
        citation_pattern=ANY_ID,
    )


def resolve_from_answers(spark, sf_dir):
    """The same answers, taken from a table instead of a function."""
    i = F.col("query_id").cast("long")
    rows = gate_and_select(
        request_issues(spark, sf_dir)
        .select("query_id", "issue")
        .join(evidence_lists(_requested(spark, sf_dir)), "query_id")
    )
    ticket = F.col("generation_evidence")[0]["ticket_id"]
    texts = F.array(_answer_text(i, ticket), _answer_text(F.when(i % 2 == 0, 0).otherwise(2), ticket))
    answers = rows.where(i % 41 != 0).select(
        "query_id",
        F.posexplode(F.when(i % 37 == 0, F.array(F.lit("  \n"))).otherwise(texts)).alias("at", "answer"),
    )
    answers = materialize(answers.select("query_id", (F.col("at") + 1).alias("attempt"), "answer"))
    index = _vector_index(spark, sf_dir)
    issues = request_issues(spark, sf_dir)
    return _flat(resolve(index, issues, GIVEN, answers, citation_pattern=ANY_ID))


def _requested(spark, sf_dir):
    """Evidence of each request, cut to its own ``top_k``."""
    asked = request_issues(spark, sf_dir).select("query_id", "top_k")
    tickets = vector_tickets(spark, sf_dir)
    found = dense.dense_top_k(tickets, vector_queries(spark, sf_dir), 5)
    found = found.join(asked, "query_id").where(F.col("rank") <= F.col("top_k")).drop("top_k")
    return with_ticket_fields(found, tickets)


def _flat(rows: DataFrame) -> DataFrame:
    return rows.select(
        "query_id",
        "status",
        "reason_code",
        "answer",
        "evidence_sufficient",
        _ids("evidence").alias("evidence_ids"),
        F.array_join("sent_ticket_ids", ",").alias("sent_ids"),
        F.col("attempts").cast("long").alias("attempts"),
    )


def resolve_batch(spark, sf_dir):
    return _flat(_resolved(spark, sf_dir))


def responses(spark, sf_dir):
    rows = response_rows(_resolved(spark, sf_dir))
    return rows.select(
        "query_id", "status", "answer", "evidence_sufficient", _ids("evidence").alias("evidence_ids")
    )


def status_metrics(spark, sf_dir):
    return run_metrics(_resolved(spark, sf_dir))


def resolve_streamed(spark, sf_dir):
    """The same issues, arriving as files."""
    out = _streamed(spark, sf_dir, request_issues(spark, sf_dir).repartition(4, "query_id"))
    return _flat(spark.read.parquet(f"{out}/{RESULTS}"))


def stream_metrics(spark, sf_dir):
    """What the metrics of all batches add up to, where every seventh issue arrives once more and one has no id."""
    issues = request_issues(spark, sf_dir)
    again = issues.where(F.col("query_id").cast("long") % 7 == 0)
    nameless = issues.where("query_id = '1'").withColumn("query_id", F.lit(None).cast("string"))
    out = _streamed(spark, sf_dir, issues.unionByName(again).unionByName(nameless).repartition(4, "vector"))
    found = spark.read.parquet(f"{out}/{METRICS}")
    return found.agg(*(F.sum(c).cast("long").alias(c) for c in found.columns if c.startswith("n_")))


def _streamed(spark, sf_dir, issues):
    _ship(spark)
    incoming = fresh_path(spark, "incoming")
    issues.write.parquet(incoming)
    schema = spark.read.parquet(incoming).schema
    out = fresh_path(spark, "resolved")
    stream = resolve_stream(
        _vector_index(spark, sf_dir),
        spark.readStream.schema(schema).option("maxFilesPerTrigger", 2).parquet(incoming),
        out,
        fresh_path(spark, "stream-checkpoint"),
        GIVEN,
        template_generator,
        trigger={"availableNow": True},
        citation_pattern=ANY_ID,
    )
    stream.awaitTermination()
    return out


QUERIES = {
    "retrieve_topk_dense": retrieve_topk_dense,
    "retrieve_topk_cells": retrieve_topk_cells,
    "retrieve_topk_tree": retrieve_topk_tree,
    "retrieve_cosine": retrieve_cosine,
    "retrieve_ivf": retrieve_ivf,
    "ivf_recall": ivf_recall,
    "ranked_listing": listing,
    "gate_and_select": gate_and_select_rows,
    "eval_cases": eval_cases,
    "eval_summary": eval_summary,
    "eval_by_category": eval_by_category,
    "eval_check": eval_check,
    "eval_from_index": eval_from_index,
    "evidence_text": evidence_texts,
    "prompt_messages": prompts,
    "repair_messages": repair_prompts,
    "abstain_answers": abstain_answers,
    "answer_sections": sections,
    "citations": cited_ids,
    "grounding_check": grounding,
    "retrieval_text": retrieval_texts,
    "ticket_violations": ticket_violations,
    "case_violations": case_violations,
    "issue_status": issue_status,
    "tickets_csv": csv_roundtrip,
    "cases_json": cases_json,
    "index_roundtrip": index_roundtrip,
    "index_status": index_states,
    "index_versions": index_versions,
    "lexical_weights": lexical_weights,
    "lexical_topk": lexical_topk,
    "lexical_topk_blocks": lexical_topk_blocks,
    "lexical_retrieve": lexical_retrieve,
    "embed_topk": embed_topk,
    "resolve_batch": resolve_batch,
    "resolve_from_answers": resolve_from_answers,
    "response_rows": responses,
    "run_metrics": status_metrics,
    "resolve_stream": resolve_streamed,
    "stream_metrics": stream_metrics,
}
