"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import ctypes
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from precedent.session import Tables  # noqa: F401  the operators here take it from this module

#: White space of the word rule ``[^\x20\x09-\x0D]+``.
WORD_SPACE = " \t\n\x0b\x0c\r"

#: Documents are handled in slices of about this many bytes inside a task.
SLICE_BYTES = 8_000_000


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold_column(doc_id: Column) -> Column:
    """crc32 of the id as text, modulo 3; a null id counts as the empty text."""
    return F.crc32(F.encode(F.coalesce(doc_id.cast("string"), F.lit("")), "UTF-8")) % 3


def fold(doc_id: int | None) -> int:
    """The same in Python."""
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % 3


def others(df: DataFrame, added: list[str]) -> list[str]:
    """Columns of ``df`` that carry no name of ``added`` in any case, quoted for ``select``."""
    taken = {name.lower() for name in added}
    return ["`" + c.replace("`", "``") + "`" for c in df.columns if c.lower() not in taken]


def spare_names(df: DataFrame, names: list[str]) -> list[str]:
    """The names, each lengthened until no column of ``df`` has it in any case."""
    taken, found = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name += "_"
        found.append(name)
    return found


def slices(batches: Iterator[pa.RecordBatch], column: str, most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The same rows in batches whose ``column`` holds about ``most`` bytes at most.

    A single longer text is a batch of its own.
    """
    for batch in batches:
        sizes = [len(v) if v is not None else 0 for v in _views(batch.column(column))]
        begin, total = 0, 0
        for row, size in enumerate(sizes):
            if total and total + size > most:
                yield batch.slice(begin, row - begin)
                begin, total = row, 0
            total += size
        if begin < batch.num_rows:
            yield batch.slice(begin)


def trimmed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The same batches; before each and after the last, memory that this worker has freed goes back to the system.

    Workers are used again by later stages, and their allocators would keep what the largest batch of any stage took.
    """
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc has it
    batches = iter(batches)
    while True:
        pa.default_memory_pool().release_unused()
        if trim is not None:
            trim(0)
        batch = next(batches, None)
        if batch is None:
            return
        yield batch
        # Nothing here may hold the batch while memory is given back.
        del batch


def _views(array: pa.Array) -> Iterator:
    return (v.as_buffer() if v.is_valid else None for v in array)


def texts_of(batch: pa.RecordBatch, column: str = "text") -> list[str]:
    """The texts of a batch, null as the empty text."""
    return [t or "" for t in batch.column(column).to_pylist()]
