"""Token ids in Parquet files that can be read by part.

A token file is an ordinary Parquet file of one row per document, in ascending id order:
``doc_id, part, offset, n_tokens, ids_crc32, token_ids``. ``part`` numbers the files in order of their ids and
``offset`` is the document's first token within its part, so that the position in the whole
corpus follows from one sum per part. Pages of format version 2 hold the columns with a dictionary where it is
small enough and with delta encoding otherwise; row groups and pages have set sizes, and the
page indexes that come with them let a reader take single documents, or the metadata without
any id.

Edge cases: a null text is the empty text and has the end id alone; rows of one id are ordered by
the hash of their text, then their text; null ids come first; an empty table gives no rows.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from precedent.llm.bpe import PATTERN, BatchEncoder, byte_alphabet
from precedent.llm.common import slices
from precedent.session import ship_package

ROW_GROUP_BYTES = 16 << 20
PAGE_BYTES = 64 << 10
PAGE_ROWS = 1000
DICTIONARY_BYTES = 256 << 10
FILE_SCHEMA = "doc_id long, part int, offset long, n_tokens long, token_ids array<int>"

_workers: dict[str, BatchEncoder] = {}


def library_encoder(path: str) -> BatchEncoder:
    """The tokenizers library behind a memory of pieces, made once per Python worker.

    Its model is given the pre-tokens of a byte-level file; any other file is refused.
    """
    if path not in _workers:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs the tasks side by side
        from tokenizers import Tokenizer

        library = Tokenizer.from_file(path)
        library.no_truncation()
        library.no_padding()
        if type(library.pre_tokenizer).__name__ != "ByteLevel" or library.normalizer is not None:
            raise ValueError("not a byte-level tokenizer without normalizer")

        model, of_byte = library.model, {b: c for c, b in byte_alphabet().items()}
        space = of_byte[ord(" ")]

        def piece(text: str) -> list[int]:
            if text[:1] == " " and text[1:].isalpha():
                # ASCII letters stand for themselves.
                raw = space + text[1:] if text.isascii() else text.encode().decode("latin-1").translate(of_byte)
                return [token.id for token in model.tokenize(raw)]
            ids: list[int] = []
            for word in PATTERN.findall(text):
                raw = word.encode().decode("latin-1").translate(of_byte)
                ids += [token.id for token in model.tokenize(raw)]
            return ids

        def whole(text: str) -> list[int]:
            return library.encode(text, add_special_tokens=False).ids

        special = [t.content for t in library.get_added_tokens_decoder().values()]
        _workers[path] = BatchEncoder(piece, whole, special)
    return _workers[path]


def write_token_files(docs: DataFrame, path: str, tokenizer: str, end_id: int = 0) -> None:
    """Encode ``docs`` (doc_id, text) in id order and write token files to ``path``.

    The texts are dealt out by ranges of id and text hash, so rows of one id are split over files too.
    """
    ship_package(docs.sparkSession)
    tail = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part, offset = library_encoder(tokenizer), TaskContext.get().partitionId(), 0
        for batch in slices(batches, "text"):
            raw = [ids + tail for ids in encoder.encode(batch.column("text"))]
            sizes = np.array([len(b) // 4 for b in raw], np.int64)
            ends = np.cumsum(sizes)
            lists = pa.ListArray.from_arrays(
                pa.array(np.concatenate([[0], ends]).astype(np.int32)),
                pa.array(np.frombuffer(b"".join(raw), "<i4")),
            )
            columns = [
                batch.column("doc_id"),
                pa.array(np.full(len(raw), part, np.int32)),
                pa.array(offset + ends - sizes),
                pa.array(sizes),
                lists,
            ]
            offset += int(ends[-1]) if len(ends) else 0
            names = ["doc_id", "part", "offset", "n_tokens", "token_ids"]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    keyed = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text")
    ).withColumn("salt", F.xxhash64("text"))
    ordered = keyed.repartitionByRange("doc_id", "salt").sortWithinPartitions("doc_id", "salt", "text")
    (
        ordered.select("doc_id", "text")
        .mapInArrow(run, FILE_SCHEMA)
        .write.option("compression", "zstd")
        .option("parquet.writer.version", "PARQUET_2_0")
        .option("parquet.enable.dictionary", "true")
        .option("parquet.dictionary.page.size", DICTIONARY_BYTES)
        .option("parquet.block.size", ROW_GROUP_BYTES)
        .option("parquet.page.size", PAGE_BYTES)
        .option("parquet.page.row.count.limit", PAGE_ROWS)
        .parquet(path)
    )


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """The token files as a table; select columns and filter ids to read parts of them."""
    return spark.read.schema(FILE_SCHEMA).parquet(path)


def read_positions(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens of every document; no token id is read."""
    rows = read_tokens(spark, path).select("doc_id", "part", "offset", "n_tokens")
    return rows.join(F.broadcast(part_starts(spark, path)), "part").select(
        "doc_id", (F.col("base") + F.col("offset")).alias("start"), "n_tokens"
    )


def part_starts(spark: SparkSession, path: str) -> DataFrame:
    """(part, base): tokens before each file. One row per file, so it is small and may be broadcast."""
    sums = read_tokens(spark, path).groupBy("part").agg(F.sum("n_tokens").alias("n"))
    rows = sums.orderBy("part").collect()
    bases = np.cumsum([0, *(r["n"] for r in rows)])
    return spark.createDataFrame(
        [(r["part"], int(base)) for r, base in zip(rows, bases)], "part int, base long"
    )


CRC = "doc_id long, part int, offset long, n_tokens long, ids_crc32 long"


def with_crc(tokens: DataFrame) -> DataFrame:
    """ids_crc32 (of the ids as little-endian unsigned 32-bit integers) instead of token_ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("token_ids")
            flat = lists.flatten().to_numpy(zero_copy_only=False).astype("<u4")
            ends = lists.offsets.to_numpy() - lists.offsets[0].as_py()
            data = memoryview(flat.tobytes())
            crc = [zlib.crc32(data[4 * a : 4 * b]) for a, b in zip(ends[:-1], ends[1:])]
            columns = [batch.column(i) for i in range(4)] + [pa.array(crc, pa.int64())]
            names = ["doc_id", "part", "offset", "n_tokens", "ids_crc32"]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    ship_package(tokens.sparkSession)
    order = ["doc_id", "part", "offset", "n_tokens", "token_ids"]
    return tokens.select(*order).mapInArrow(run, CRC)
