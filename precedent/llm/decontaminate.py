"""Benchmark items inside documents, by MinHash containment over windows of matching size.

Items are partitioned by their number of shingles into classes [2^c, 2^(c+1)). For a class, a document is cut
into blocks of 2^c shingles, and three blocks in a row form a window: an item lies inside one of
them, and their similarity is at least ``least_similarity`` if 0.75 of its shingles are there.
A window and an item that agree in any of ``HASHES`` minima are candidates; the chance to miss one is
(1 - 0.23)^48 < 1e-5 at worst. Candidates are checked by exact containment in the document.

Items go to the executors in blocks of ``ITEMS_AT_ONCE``, one scan of the documents each, so the
memory does not depend on their number.

Edge cases: null and empty texts match nothing; an item of fewer than five words is the sequence of its
words and matches a document of these words only; repeated items are all reported; extra columns are kept out.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from precedent.llm.common import slices
from precedent.llm.ngram_join import Shingler
from precedent.session import ship_package

HASHES = 48
#: Least share of an item's shingles, in percent.
PERCENT = 75
ITEMS_AT_ONCE = 20_000
_BITS = 18
_RNG = np.random.default_rng(11)
_A = _RNG.integers(1, 1 << 63, HASHES, dtype=np.uint64) | np.uint64(1)
_B = _RNG.integers(0, 1 << 63, HASHES, dtype=np.uint64)


def least_similarity() -> float:
    """Jaccard similarity of an item and its window, at worst: 3 blocks against one."""
    share = PERCENT / 100
    return share / (3 + 1 - share)


def _hashed(shingles: np.ndarray, k: int) -> np.ndarray:
    return ((shingles * _A[k] + _B[k]) >> np.uint64(32)).astype(np.uint32)


class ItemIndex:
    """MinHash minima of a block of items, by size class."""

    def __init__(self, items: list[tuple[int, str]]):
        sets = Shingler().sets(pa.array([t for _, t in items], pa.string()))
        self.items = [(i, s) for (i, _), s in zip(items, sets) if len(s)]
        self.classes: dict[int, list[int]] = {}
        for at, (_, s) in enumerate(self.items):
            self.classes.setdefault(len(s).bit_length() - 1, []).append(at)
        self.minima: dict[int, list[dict[int, list[int]]]] = {}
        self.flags: dict[int, np.ndarray] = {}
        for c, members in self.classes.items():
            flags = np.zeros((HASHES, 1 << _BITS), bool)
            tables: list[dict[int, list[int]]] = []
            for k in range(HASHES):
                table: dict[int, list[int]] = {}
                for at in members:
                    table.setdefault(int(_hashed(self.items[at][1], k).min()), []).append(at)
                flags[k, np.array(list(table), np.uint32) & np.uint32((1 << _BITS) - 1)] = True
                tables.append(table)
            self.minima[c], self.flags[c] = tables, flags

    def search(self, sequences: list[np.ndarray]) -> list[tuple[int, int, int, int]]:
        """(document, item, shingles in common, shingles of the item) of all that are contained."""
        lengths = np.array([len(s) for s in sequences])
        if not self.items or not lengths.sum():
            return []
        base = min(self.classes)
        flat = np.concatenate(sequences)
        blocks, starts = _block_starts(lengths, 1 << base)
        owner = np.repeat(np.arange(len(lengths)), blocks)
        levels = {c: _block_starts(blocks, 1 << (c - base)) for c in self.classes}
        hits: set[tuple[int, int]] = set()
        for k in range(HASHES):
            low = np.minimum.reduceat(_hashed(flat, k), starts)
            for c, (_, at) in levels.items():
                own = owner[at]
                window = _three(np.minimum.reduceat(low, at), own)
                near = np.nonzero(self.flags[c][k][window & np.uint32((1 << _BITS) - 1)])[0]
                table = self.minima[c][k]
                for w, doc in zip(window[near].tolist(), own[near].tolist()):
                    for item in table.get(w, ()):
                        hits.add((doc, item))
        out = []
        sets: dict[int, np.ndarray] = {}
        for doc, item in sorted(hits):
            if doc not in sets:
                sets = {doc: np.unique(sequences[doc])}
            own, given = self.items[item][1], sets[doc]
            common = int((given[np.minimum(np.searchsorted(given, own), len(given) - 1)] == own).sum())
            if 100 * common >= PERCENT * len(own):
                out.append((doc, item, common, len(own)))
        return out


def _block_starts(lengths: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(blocks of each row, first place of each block) when rows of these lengths lie in one array."""
    blocks = -(-lengths // size)
    first = np.cumsum(lengths) - lengths
    within = np.arange(blocks.sum()) - np.repeat(np.cumsum(blocks) - blocks, blocks)
    return blocks, np.repeat(first, blocks) + within * size


def _three(low: np.ndarray, owner: np.ndarray) -> np.ndarray:
    """Minimum of each block and the next two of its document."""
    out = low.copy()
    for k in (1, 2):
        if len(low) > k:
            same = owner[k:] == owner[:-k]
            out[:-k][same] = np.minimum(out[:-k][same], low[k:][same])
    return out


FOUND = "doc_id long, item_id long, common long, item_shingles long"


def contained_items(docs: DataFrame, items: DataFrame) -> DataFrame:
    """(doc_id, item_id, common, item_shingles) of every item (item_id, text) in a document (doc_id, text)."""
    spark = docs.sparkSession
    ship_package(spark)
    rows = docs.selectExpr("cast(doc_id as long) as doc_id", "text")
    given = items.selectExpr("cast(item_id as long) as item_id", "text").where("text is not null")
    n = max(1, -(-given.count() // ITEMS_AT_ONCE))
    parts = []
    for block in range(n):
        own = given.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == block).collect()
        sent = spark.sparkContext.broadcast([(r["item_id"], r["text"]) for r in own])
        parts.append(rows.mapInArrow(_searcher(sent), FOUND))
    return reduce(DataFrame.unionAll, parts)


def _searcher(sent):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index, shingler = ItemIndex(sent.value), Shingler()
        for batch in slices(batches, "text"):
            ids = batch.column("doc_id").to_pylist()
            found = index.search(shingler.sequences(batch.column("text")))
            columns = list(zip(*[(ids[d], index.items[i][0], c, q) for d, i, c, q in found])) or [()] * 4
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, pa.int64()) for c in columns], names=["doc_id", "item_id", "common", "item_shingles"]
            )

    return run


def contaminated_documents(docs: DataFrame, items: DataFrame) -> DataFrame:
    """(doc_id, item_ids, most): one row per document with an item in it."""
    share = F.col("common") / F.col("item_shingles")
    return (
        contained_items(docs, items)
        .groupBy("doc_id")
        .agg(F.sort_array(F.collect_set("item_id")).alias("item_ids"), F.max(share).alias("containment"))
    )


def decontaminate(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The rows of ``docs`` without an item in their text; rows are told apart by text too, as ids may repeat."""
    spark = docs.sparkSession
    ship_package(spark)
    given = items.selectExpr("cast(item_id as long) as item_id", "text").where("text is not null")
    n = max(1, -(-given.count() // ITEMS_AT_ONCE))
    for block in range(n):
        own = given.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == block).collect()
        sent = spark.sparkContext.broadcast([(r["item_id"], r["text"]) for r in own])
        docs = docs.mapInArrow(_cleaner(sent), docs.schema)
    return docs


def _cleaner(sent):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index, shingler = ItemIndex(sent.value), Shingler()
        for batch in slices(batches, "text"):
            dirty = {d for d, *_ in index.search(shingler.sequences(batch.column("text")))}
            yield batch.filter(pa.array([row not in dirty for row in range(batch.num_rows)], pa.bool_()))

    return run
