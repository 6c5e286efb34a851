"""Nearest tickets by dense vector: exact, and approximate by cells.

Two plans give the same exact result:

* few queries: they are size-checked, broadcast, and the tickets stream past;
* many queries: tickets are split into cells around pivots. Each query first
  visits its nearest cells, which yields a score its k-th best ticket surely
  reaches; it then visits only those further cells whose best possible score,
  by the triangle inequality, can still reach that one.

Cells are cut into blocks of bounded size on both sides, so that a cell holding a
third of all vectors is many tasks, not one.
"""

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from precedent.errors import InputError
from precedent.operators.blocks import HITS, HITS_ARROW, TILE_CELLS, BestHits, cogroup_hits, collect_small, scan_hits
from precedent.operators.rank import top_k_per_query
from precedent.schemas import RANK_DIGITS
from precedent.session import materialize, ship_package

EXP_NEG_SQ_L2 = "exp_neg_sq_l2"
COSINE = "cosine"

BLOCK_ROWS = 16_384
# Queries that the scan holds in every task, and lists the best k of in every task: what is more goes by cells.
SCAN_BYTES = 8 << 20
# Blocks that meet grow from ``BLOCK_ROWS`` rows to this many times as many once there are ``LEAST_BLOCKS`` of them,
# as every block of one side is copied to the blocks of the other.
BLOCK_GROWTH = 4
LEAST_BLOCKS = 8
# Tickets of several groups that are compared at a time.
SLICE_ROWS = 2048
# A task gets pairs of blocks with about this many pairs of vectors and this many rows at most, or one pair of blocks.
TASK_PAIRS = 1 << 28
TASK_ROWS = BLOCK_GROWTH * BLOCK_ROWS
PIVOT_ROWS_PER_CELL = 256
MAX_CELLS = 4096
# Bounds are compared with this much slack, above rounding error and below any
# difference the ranking can see.
SLACK = 1e-7

UNEQUAL = "vectors must be present and of one length"


def require_metric(metric: str) -> str:
    if metric not in (EXP_NEG_SQ_L2, COSINE):
        raise InputError("metric", "metric must be exp_neg_sq_l2 or cosine.")
    return metric


def vector_dim(vectors: DataFrame) -> int:
    """The common length of all vectors; unequal, null or empty ones are refused."""
    size = F.size("vector")
    row = vectors.agg(
        F.min(size).alias("low"),
        F.max(size).alias("high"),
        F.count_if(F.col("vector").isNull() | F.exists("vector", lambda x: x.isNull())).alias("bad"),
        F.count_if(F.exists("vector", lambda x: F.isnan(x) | F.abs(x).isin(float("inf")))).alias("wild"),
    ).head()
    if row.low is None or row.low != row.high or row.low < 1 or row.bad:
        raise InputError("vector_size", "All vectors must be present and of one length.")
    if row.wild:
        raise InputError("vector_value", "All numbers of a vector must be finite.")
    return row.low


def squared_l2_score(left: Column, right: Column) -> Column:
    """exp(-squared distance) of two vectors, JVM-side, for single pairs."""
    squares = F.zip_with(
        left, right, lambda a, b: (a.cast("double") - b) * (a.cast("double") - b)
    )
    return F.exp(-F.aggregate(squares, F.lit(0.0), lambda total, x: total + x))


def _matrix(column) -> np.ndarray:
    """A list column as unit rows in double precision."""
    chunk = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    sizes = pc.unique(pc.list_value_length(chunk))
    if len(sizes) != 1 or not sizes[0].is_valid:
        raise ValueError(UNEQUAL)
    flat = np.asarray(chunk.flatten(), dtype=np.float64)
    rows = flat.reshape(len(chunk), sizes[0].as_py())
    norms = np.linalg.norm(rows, axis=1, keepdims=True)
    return rows / np.where(norms > 0, norms, 1.0)


def _score(cosines: np.ndarray, metric: str) -> np.ndarray:
    return np.exp(2.0 * np.minimum(cosines, 1.0) - 2.0) if metric == EXP_NEG_SQ_L2 else cosines


def _least_cosine(floor: np.ndarray, metric: str) -> np.ndarray:
    """The cosine without which no score, rounded for ranking, reaches the floor."""
    least = floor - 2.0 * 10.0**-RANK_DIGITS
    if metric == COSINE:
        return least
    with np.errstate(divide="ignore", invalid="ignore"):
        return np.where(least > 0, 1.0 + 0.5 * np.log(least), -np.inf)


class DenseCandidates:
    """Entries that may reach the floors of a query block: looked for in single precision, scored in double.

    A cosine in single precision is off by at most ``error``, so an entry that falls short of its floor by
    more than that is none. Pieces of the score matrix are small enough to stay in a core's cache, and
    are written over one another.
    """

    ROWS, COLUMNS, WIDER, EXACT = 1024, 512, 4, 65_536

    def __init__(self, queries: pa.Table, metric: str):
        self.metric = metric
        self.unit = _matrix(queries["vector"]) if queries.num_rows else np.empty((0, 1))
        self.short = self.unit.astype(np.float32)
        # Rounding of both factors, of each product and of each partial sum of a unit vector's terms.
        self.error = (self.unit.shape[1] + 8) * 2.0**-24
        self.cosines = np.empty(self.ROWS * self.COLUMNS, np.float32)
        self.reached = np.zeros(self.ROWS * self.COLUMNS, bool)

    def against(self, tickets: pa.Table):
        unit = _matrix(tickets["vector"])
        if unit.shape[1] != self.unit.shape[1]:
            raise ValueError(UNEQUAL)
        # A vector with a number that is not one has no score.
        held = np.flatnonzero(~np.isnan(unit).any(axis=1))
        return unit, unit[held].astype(np.float32), held

    def find(self, tickets, rows: slice, floor: np.ndarray, k: int, wanted: np.ndarray | None = None):
        unit, short, held = tickets
        at = np.arange(len(floor)) if wanted is None else wanted
        queries = self.short[rows][at]
        bar = self._bar(floor[at])
        found, n_found = [], 0
        # Queries without a floor get theirs from the first piece, which is wider for them.
        wide = self.WIDER if np.isneginf(bar).any() else 1
        columns, height = wide * self.COLUMNS, self.ROWS // wide
        for left in range(0, len(short), columns):
            right = short[left : left + columns].T
            for top in range(0, len(at), height):
                part = slice(top, min(len(at), top + height))
                shape = (part.stop - top, right.shape[1])
                cells = shape[0] * shape[1]
                cosines = np.matmul(queries[part], right, out=self.cosines[:cells].reshape(shape))
                if shape[1] > k:
                    unset = top + np.flatnonzero(np.isneginf(bar[part]))
                    if len(unset):
                        kth = np.partition(cosines[unset - top], -k, axis=1)[:, -k].astype(np.float64) - self.error
                        low = np.round(_score(kth, self.metric) - 10.0**-RANK_DIGITS, RANK_DIGITS)
                        floor[at[unset]] = np.fmax(floor[at[unset]], low)
                        bar[unset] = self._bar(low)
                np.greater_equal(cosines, bar[part, None], out=self.reached[:cells].reshape(shape))
                hit = self._hits(cells)
                if not len(hit):
                    continue
                row, column = np.divmod(hit, shape[1])
                found.append((at[top + row], held[left + column]))
                n_found += len(hit)
                if n_found > self.EXACT:
                    yield from self._exact(unit, rows.start, *map(np.concatenate, zip(*found)), floor)
                    found, n_found = [], 0
                    # What was found may have raised the floors.
                    bar = np.fmax(bar, self._bar(floor[at]))
        if found:
            yield from self._exact(unit, rows.start, *map(np.concatenate, zip(*found)), floor)

    def _hits(self, cells: int) -> np.ndarray:
        """Offsets of the first ``cells`` entries that are set; they are few, so eight are looked at as one number."""
        end = -(-cells // 8) * 8
        self.reached[cells:end] = False
        eights = self.reached[:end].view(np.uint64)
        some = np.flatnonzero(eights)
        at = np.flatnonzero(self.reached[:end].reshape(-1, 8)[some])
        return some[at >> 3] * 8 + (at & 7)

    def _bar(self, floor: np.ndarray) -> np.ndarray:
        """The least cosine in single precision of what may reach the floor."""
        return (_least_cosine(floor, self.metric) - 2.0 * self.error).astype(np.float32)

    def _exact(self, unit, start, at_q, at_ticket, floor):
        for i in range(0, len(at_q), self.EXACT):
            q, t = at_q[i : i + self.EXACT], at_ticket[i : i + self.EXACT]
            score = _score(np.einsum("ij,ij->i", self.unit[start + q], unit[t]), self.metric)
            reached = np.flatnonzero(np.round(score, RANK_DIGITS) >= floor[q])
            yield q[reached], t[reached], score[reached]


def dense_candidates(metric: str):
    return lambda queries: DenseCandidates(queries, metric)


# -- cells ------------------------------------------------------------------


@dataclass(frozen=True)
class Cells:
    """Pivots and, per cell, its row count and nearest and farthest member.

    Bounded: at most ``MAX_CELLS`` rows, whatever the size of the table.
    """

    pivots: np.ndarray
    n: np.ndarray
    near: np.ndarray
    far: np.ndarray


def _pivot_distances(vectors: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    squares = (
        (vectors**2).sum(axis=1)[:, None] + (pivots**2).sum(axis=1) - 2.0 * (vectors @ pivots.T)
    )
    return np.sqrt(np.maximum(squares, 0.0))


def train_pivots(
    vectors: DataFrame,
    n_rows: int,
    n_cells: int,
    seed: int = 42,
    rows_per_cell: int = PIVOT_ROWS_PER_CELL,
) -> np.ndarray:
    """Pivots by k-means over a sample that grows with the cells: ``rows_per_cell`` for each.

    They steer speed and the recall of ``n_probe``; exact results do not depend on them.
    """
    # Not at the top: with pandas, which they import, they would fill 50 MB of every Python worker.
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.feature import Normalizer
    from pyspark.ml.functions import array_to_vector

    fraction = min(1.0, rows_per_cell * n_cells / max(1, n_rows))
    sample = vectors if fraction == 1.0 else vectors.sample(fraction, seed=seed)
    raw = sample.select(array_to_vector(F.col("vector").cast("array<double>")).alias("raw"))
    unit = Normalizer(inputCol="raw", outputCol="features").transform(raw)
    if n_cells == 1:
        return np.array([unit.head().features.toArray()])
    model = KMeans(k=n_cells, seed=seed, maxIter=5, initMode="random").fit(unit)
    return np.array(model.clusterCenters(), dtype=np.float64)


def assign_cells(vectors: DataFrame, pivots: np.ndarray) -> DataFrame:
    """Adds the nearest pivot and the distance to it. Narrow, one matrix product per batch."""
    ship_package(vectors.sparkSession)
    shared = vectors.sparkSession.sparkContext.broadcast(pivots)
    schema = T.StructType(
        [
            *vectors.schema.fields,
            T.StructField("cell", T.IntegerType()),
            T.StructField("pivot_distance", T.DoubleType()),
        ]
    )

    def assign(batches):
        most = max(1, TILE_CELLS // len(shared.value))
        for batch in (b.slice(i, most) for b in batches for i in range(0, b.num_rows, most)):
            distances = _pivot_distances(_matrix(batch.column("vector")), shared.value)
            cell = distances.argmin(axis=1)
            near = distances[np.arange(len(cell)), cell]
            yield batch.append_column("cell", pa.array(cell, pa.int32())).append_column(
                "pivot_distance", pa.array(near, pa.float64())
            )

    return vectors.mapInArrow(assign, schema)


def cell_bounds(assigned: DataFrame, pivots: np.ndarray) -> Cells:
    """Count and radii per cell; at most one row per pivot reaches the driver."""
    k = len(pivots)
    n, near, far = np.zeros(k, dtype=np.int64), np.full(k, np.inf), np.zeros(k)
    rows = (
        assigned.groupBy("cell")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.min("pivot_distance").alias("near"),
            F.max("pivot_distance").alias("far"),
        )
        .toArrow()
    )
    at = rows["cell"].to_numpy()
    n[at], near[at], far[at] = (rows[c].to_numpy() for c in ("n", "near", "far"))
    return Cells(pivots, n, near, far)


def default_cells(n_rows: int) -> int:
    return int(min(MAX_CELLS, max(1, round(n_rows**0.5 / 2))))


def build_cells(vectors: DataFrame, n_cells: int | None = None) -> tuple[DataFrame, Cells]:
    """Cells of a table that has no stored ones; the assignment is kept reliably."""
    # Counted, sampled and assigned: kept, so that what makes the vectors runs once.
    vectors = materialize(vectors)
    n_rows = vectors.count()
    pivots = train_pivots(vectors, n_rows, n_cells or default_cells(n_rows))
    assigned = materialize(assign_cells(vectors, pivots))
    return assigned, cell_bounds(assigned, pivots)


def _visits(queries: DataFrame, cells: Cells, choose) -> DataFrame:
    """One row per query and cell that ``choose`` picks; narrow."""
    ship_package(queries.sparkSession)
    shared = queries.sparkSession.sparkContext.broadcast(
        (cells.pivots, cells.n, cells.near, cells.far)
    )
    schema = "query_id string, vector array<double>, cell int"

    def visit(batches):
        held = Cells(*shared.value)
        # Query by cell matrices of bounded size, whatever the size of an Arrow batch.
        most = max(1, TILE_CELLS // len(held.pivots))
        for batch in (b.slice(i, most) for b in batches for i in range(0, b.num_rows, most)):
            unit = _matrix(batch.column("vector"))
            distances = _pivot_distances(unit, held.pivots)
            rows, cells_of = np.nonzero(choose(distances, held, batch))
            # Batches of bounded size: neither memory nor the list offsets grow with the visits.
            step = max(1, TILE_CELLS // unit.shape[1])
            for at in range(0, len(rows), step):
                row, cell = rows[at : at + step], cells_of[at : at + step]
                ends = np.arange(len(row) + 1, dtype=np.int32) * unit.shape[1]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("query_id").take(pa.array(row)),
                        pa.ListArray.from_arrays(pa.array(ends), pa.array(unit[row].reshape(-1))),
                        pa.array(cell, pa.int32()),
                    ],
                    names=["query_id", "vector", "cell"],
                )

    return queries.mapInArrow(visit, schema)


def nearest_cells(distances: np.ndarray, cells: Cells, k: int, n_probe: int) -> np.ndarray:
    """The ``n_probe`` nearest cells, and as many more as it takes to hold k tickets."""
    reach = np.where(cells.n > 0, distances, np.inf)
    order = np.argsort(reach, axis=1, kind="stable")
    held = np.cumsum(cells.n[order], axis=1)
    before = np.concatenate([np.zeros((len(held), 1)), held[:, :-1]], axis=1)
    wanted = (np.arange(order.shape[1]) < n_probe) | (before < k)
    chosen = np.zeros(distances.shape, dtype=bool)
    np.put_along_axis(chosen, order, wanted, axis=1)
    return chosen & (cells.n > 0)


def reachable_cells(
    distances: np.ndarray, cells: Cells, floor: np.ndarray, metric: str
) -> np.ndarray:
    """Cells that may hold a ticket scoring at least ``floor``.

    Lower bounds on the distance from a query to any member of a cell: the ring
    between its nearest and farthest member, and the plane halfway between the
    cell's pivot and the query's own nearest pivot.
    """
    near = np.where(cells.n > 0, cells.near, 0.0)
    ring = np.maximum(distances - cells.far, near - distances)
    own = distances.argmin(axis=1)
    gaps = _pivot_distances(cells.pivots, cells.pivots)[own]
    own_distance = distances[np.arange(len(own)), own][:, None]
    with np.errstate(divide="ignore", invalid="ignore"):
        plane = np.where(gaps > SLACK, (distances**2 - own_distance**2) / (2.0 * gaps), 0.0)
    least = np.maximum(np.maximum(ring, plane) - SLACK, 0.0)
    best = np.exp(-(least**2)) if metric == EXP_NEG_SQ_L2 else 1.0 - least**2 / 2.0
    return (best >= floor[:, None] - SLACK) & (cells.n > 0)


def number_pairs(
    tickets: np.ndarray, asked: np.ndarray, ticket_blocks: np.ndarray, query_blocks: np.ndarray, least: int
) -> tuple[np.ndarray, int]:
    """(number of the first pair of blocks of each group, tasks).

    ``tickets`` and ``asked`` count the rows of a group on either side. Pairs are numbered by falling size and dealt to the
    tasks in turn, so that tasks are alike and their number grows with what is compared.
    """
    pairs = ticket_blocks.astype(np.int64) * query_blocks
    compared = tickets.astype(np.float64) * asked
    order = np.argsort(-compared / np.maximum(pairs, 1), kind="stable")
    first = np.empty(len(pairs), np.int64)
    first[order] = np.cumsum(pairs[order]) - pairs[order]
    rows = float((tickets * query_blocks + asked * ticket_blocks).sum())
    tasks = max(least, int(compared.sum() / TASK_PAIRS), int(rows / TASK_ROWS))
    return first, max(1, min(int(pairs.sum()), tasks))


def _block_counts(group: str, number, tickets, asked, ticket_blocks, query_blocks, least: int) -> tuple[pa.Table, int]:
    """Blocks on both sides per visited cell or pack, with the number of its first pair, and the tasks."""
    first, tasks = number_pairs(tickets, asked, ticket_blocks, query_blocks, least)
    columns = {group: number, "ticket_blocks": ticket_blocks, "query_blocks": query_blocks, "first_pair": first}
    return pa.table({name: pa.array(values, pa.int32()) for name, values in columns.items()}), tasks


def _dealt(rows: DataFrame, tasks: int, *columns: str) -> DataFrame:
    """The rows of each ``pair`` in one task, however many partitions Spark would take for their bytes."""
    pair = F.col("first_pair") + F.col("ticket_block") * F.col("query_blocks") + F.col("query_block")
    return rows.withColumn("pair", pair).select("pair", *columns).repartitionById(tasks, "pair")


def _indexes(n: str) -> Column:
    return F.explode(F.sequence(F.lit(0), F.col(n) - 1))


def _block_of(key: str, n: str) -> Column:
    return F.pmod(F.xxhash64(key), F.col(n)).cast("int")


def visit_hits(
    assigned: DataFrame,
    visits: DataFrame,
    cells: Cells,
    k: int,
    metric: str,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Best k tickets per query and visited block.

    Equi-join on the pair of (cell, ticket block) and query block; a ticket meets every query
    block of its cell and the other way round. Cells nobody visits are not read:
    in a stored index the cell is a partition column.
    """
    spark = visits.sparkSession
    # At most one row per pivot.
    asked = visits.groupBy("cell").agg(F.count(F.lit(1)).alias("n")).toArrow()
    cell, n = asked["cell"].to_numpy(), asked["n"].to_numpy()
    held = cells.n[cell]
    sizes = held, n, -(-held // block_rows), -(-n // block_rows)
    blocks, tasks = _block_counts("cell", cell, *sizes, spark.sparkContext.defaultParallelism)
    counts = F.broadcast(spark.createDataFrame(blocks))
    tickets = (
        assigned.where(F.col("cell").isin(cell.tolist()))
        .join(counts, "cell")
        .withColumn("ticket_block", _block_of("ticket_id", "ticket_blocks"))
        .withColumn("query_block", _indexes("query_blocks"))
    )
    queries = (
        visits.join(counts, "cell")
        .withColumn("ticket_block", _indexes("ticket_blocks"))
        .withColumn("query_block", _block_of("query_id", "query_blocks"))
    )
    tickets, queries = _dealt(tickets, tasks, "ticket_id", "vector"), _dealt(queries, tasks, "query_id", "vector")
    return cogroup_hits(tickets, queries, ["pair"], k, dense_candidates(metric))


def _n_blocks(n, block_rows: int):
    """Blocks of ``n`` rows: see ``BLOCK_GROWTH``. For numbers and arrays."""
    few = np.minimum(LEAST_BLOCKS, -(-np.asarray(n) // block_rows))
    return np.maximum(few, -(-np.asarray(n) // (BLOCK_GROWTH * block_rows)))


def pack_cells(n: np.ndarray, block_rows: int) -> np.ndarray:
    """The pack of each cell: neighbours by number that together fill about a block."""
    total = max(1, int(n.sum()))
    rows = -(-total // max(1, int(_n_blocks(total, block_rows))))
    return np.unique((np.cumsum(n) - n) // rows, return_inverse=True)[1].astype(np.int32)


def _pack_visits(queries: DataFrame, cells: Cells, packs: np.ndarray, choose, vectors: bool = True) -> DataFrame:
    """One row per query and pack with a cell that ``choose`` picks, and these cells as bits; narrow.

    However many cells a query reaches, its vector is written once per pack.
    """
    ship_package(queries.sparkSession)
    shared = queries.sparkSession.sparkContext.broadcast((cells.pivots, cells.n, cells.near, cells.far, packs))
    schema = "pack int" + (", query_id string, vector array<double>, floor double, cells binary" if vectors else "")

    def visit(batches):
        *held, pack_of = shared.value
        held = Cells(*held)
        members = [np.flatnonzero(pack_of == p) for p in range(pack_of.max() + 1)]
        most = max(1, TILE_CELLS // len(held.pivots))
        for batch in (b.slice(i, most) for b in batches for i in range(0, b.num_rows, most)):
            distances = _pivot_distances(_matrix(batch.column("vector")), held.pivots)
            floor = batch.column("floor").to_numpy(zero_copy_only=False).astype(np.float64)
            chosen = choose(distances, held, np.where(np.isnan(floor), -np.inf, floor))
            for p, of_pack in enumerate(members):
                row = np.flatnonzero(chosen[:, of_pack].any(axis=1))
                if not len(row):
                    continue
                columns = [pa.array(np.full(len(row), p), pa.int32())]
                names = ["pack"]
                if vectors:
                    bits = np.packbits(chosen[np.ix_(row, of_pack)], axis=1)
                    ends = np.arange(len(row) + 1, dtype=np.int32) * bits.shape[1]
                    at = pa.array(row)
                    columns += [batch.column(c).take(at) for c in ("query_id", "vector", "floor")]
                    columns.append(pa.Array.from_buffers(pa.binary(), len(row), [None, pa.py_buffer(ends), pa.py_buffer(bits.tobytes())]))
                    names += ["query_id", "vector", "floor", "cells"]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    return queries.select("query_id", "vector", "floor").mapInArrow(visit, schema)


def _bit_matrix(column, n: int) -> np.ndarray:
    """Rows of bits as booleans."""
    rows = np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(len(column), -1)
    return np.unpackbits(rows, axis=1)[:, :n].astype(bool)


def _leaf_reach(tickets: pa.Table, starts: np.ndarray, queries: np.ndarray, floor: np.ndarray, metric: str) -> np.ndarray:
    """Queries by groups of these tickets (from ``starts``): may a member reach the query's floor, by a ball around its members?"""
    unit = _matrix(tickets["vector"])
    sizes = np.diff(np.append(starts, len(unit)))
    centres = np.add.reduceat(unit, starts) / sizes[:, None]
    far = np.maximum.reduceat(np.linalg.norm(unit - np.repeat(centres, sizes, axis=0), axis=1), starts)
    least = np.maximum(_pivot_distances(queries, centres) - far - SLACK, 0.0)
    best = np.exp(-(least**2)) if metric == EXP_NEG_SQ_L2 else 1.0 - least**2 / 2.0
    return best >= floor[:, None] - SLACK


def reached_hits(
    assigned: DataFrame,
    queries: DataFrame,
    cells: Cells,
    choose,
    k: int,
    metric: str,
    block_rows: int = BLOCK_ROWS,
    only_chosen: bool = False,
) -> DataFrame:
    """Best k tickets per query ``(query_id, vector, floor)`` and visited block, in the cells that ``choose`` picks.

    Cells are packed into blocks of bounded size, so what is moved grows with the blocks of both sides
    that meet, not with the cells that a query reaches: where no bound excludes anything, this is a block
    nested loop. Inside a block a query meets its cells only; small cells, and the leaves of a tree
    (``leaf``), are met some at a time, unless ``only_chosen``.
    """
    spark = queries.sparkSession
    packs = pack_cells(cells.n, block_rows)
    held = np.bincount(packs, weights=cells.n).astype(np.int64)
    # At most one row per pack.
    asked = _pack_visits(queries, cells, packs, choose, False).groupBy("pack").agg(F.count(F.lit(1)).alias("n")).toArrow()
    pack = asked["pack"].to_numpy()
    n = asked["n"].to_numpy()
    sizes = held[pack], n, np.maximum(1, -(-held[pack] // (2 * BLOCK_GROWTH * block_rows))), _n_blocks(n, block_rows)
    counts, tasks = _block_counts("pack", pack, *sizes, spark.sparkContext.defaultParallelism)
    counts = F.broadcast(spark.createDataFrame(counts))
    cell = np.flatnonzero(np.isin(packs, pack))
    visited = pa.table({"cell": pa.array(cell, pa.int32()), "pack": pa.array(packs[cell], pa.int32())})
    leaf = ["leaf"] if "leaf" in assigned.columns else []
    tickets = (
        assigned.where(F.col("cell").isin(cell.tolist()))
        .join(F.broadcast(spark.createDataFrame(visited)), "cell")
        .join(counts, "pack")
        .withColumn("ticket_block", _block_of("ticket_id", "ticket_blocks"))
        .withColumn("query_block", _indexes("query_blocks"))
    )
    visits = (
        _pack_visits(queries, cells, packs, choose)
        .join(counts, "pack")
        .withColumn("ticket_block", _indexes("ticket_blocks"))
        .withColumn("query_block", _block_of("query_id", "query_blocks"))
    )
    tickets = _dealt(tickets, tasks, "cell", *leaf, "ticket_id", "vector")
    visits = _dealt(visits, tasks, "pack", "query_id", "vector", "floor", "cells")
    candidates = dense_candidates(metric)
    slice_rows = 1 if only_chosen else SLICE_ROWS
    shared = spark.sparkContext.broadcast(packs)
    ship_package(spark)

    def score(tickets: pa.Table, visits: pa.Table) -> pa.Table:
        if not tickets.num_rows or not visits.num_rows:
            return HITS_ARROW.empty_table()
        of_pack = np.flatnonzero(shared.value == visits["pack"][0].as_py())
        chosen = _bit_matrix(visits["cells"], len(of_pack))
        floor = visits["floor"].to_numpy().astype(np.float64)
        floor = np.where(np.isnan(floor), -np.inf, floor)
        side = candidates(visits)
        best = BestHits(visits, k, side, floor=floor)
        tickets = tickets.sort_by([(c, "ascending") for c in ["cell", *leaf]])
        place = np.searchsorted(of_pack, tickets["cell"].to_numpy())
        change = np.diff(place) != 0
        if leaf:
            change |= np.diff(tickets["leaf"].to_numpy()) != 0
        starts = np.concatenate([[0], np.flatnonzero(change) + 1])
        ends = np.append(starts[1:], len(place))
        at = 0
        while at < len(starts):
            # Whole groups, one at least.
            last = max(at + 1, int(np.searchsorted(ends, starts[at] + slice_rows, side="right")))
            part = tickets.slice(starts[at], ends[last - 1] - starts[at])
            wanted = chosen[:, place[starts[at:last]]]
            if leaf:
                wanted = wanted & _leaf_reach(part, starts[at:last] - starts[at], side.unit, best.floor, metric)
            wanted = wanted.any(axis=1)
            if wanted.any():
                best.add(part, wanted)
            at = last
        return best.table()

    return tickets.groupBy("pair").cogroup(visits.groupBy("pair")).applyInArrow(score, HITS)


# -- joins ------------------------------------------------------------------


def _query_vectors(queries: DataFrame) -> DataFrame:
    return queries.select(
        F.col("query_id").cast("string").alias("query_id"),
        F.col("vector").cast("array<double>").alias("vector"),
    )


def _small_query_block(queries: DataFrame, broadcast_bytes: int) -> pa.Table | None:
    """The queries, when all of them fit the broadcast bound."""
    first = queries.select(F.size("vector").alias("dim")).head()
    if first is None:
        return queries.limit(0).toArrow()
    if not broadcast_bytes:
        return None
    return collect_small(queries, broadcast_bytes // (8 * max(1, first.dim)))


def _ticket_vectors(tickets: DataFrame) -> DataFrame:
    return tickets.select(F.col("ticket_id").cast("string").alias("ticket_id"), "vector")


def approximate_hits(
    assigned: DataFrame,
    queries: DataFrame,
    cells: Cells,
    k: int,
    n_probe: int,
    metric: str = EXP_NEG_SQ_L2,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Candidates from the ``n_probe`` nearest cells only.

    Where that is more than one, a query is moved once per pack of cells, not once per cell.
    """

    def nearest(distances, held, _):
        return nearest_cells(distances, held, k, n_probe)

    if n_probe == 1:
        return visit_hits(assigned, _visits(queries, cells, nearest), cells, k, metric, block_rows)
    queries = queries.withColumn("floor", F.lit(None).cast("double"))
    return reached_hits(assigned, queries, cells, nearest, k, metric, block_rows, only_chosen=True)


def exact_cell_hits(
    assigned: DataFrame,
    queries: DataFrame,
    cells: Cells,
    k: int,
    metric: str = EXP_NEG_SQ_L2,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Candidates that contain every query's true best k."""
    first = approximate_hits(assigned, queries, cells, k, 1, metric, block_rows)
    # The k-th best score so far; no floor for a query that has fewer than k.
    floors = (
        top_k_per_query(first, k)
        .groupBy("query_id")
        .agg(F.when(F.count(F.lit(1)) >= k, F.min("similarity_score")).alias("floor"))
    )
    floored = materialize(queries.join(floors, "query_id", "left"))

    def reach(distances, held, floor):
        return reachable_cells(distances, held, floor, metric)

    # The first cells once more: blocks compare small cells together, and a ticket must not be listed twice.
    return reached_hits(assigned, floored, cells, reach, k, metric, block_rows)


def dense_top_k(
    tickets: DataFrame,
    queries: DataFrame,
    k: int,
    metric: str = EXP_NEG_SQ_L2,
    cells: Cells | None = None,
    n_cells: int | None = None,
    n_probe: int | None = None,
    broadcast_bytes: int = SCAN_BYTES,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """``(query_id, rank, ticket_id, similarity_score)``, best k tickets per query.

    Exact unless ``n_probe`` is given. Pass ``cells`` when ``tickets`` already
    carries its assignment (a stored index does).
    """
    require_metric(metric)
    if n_probe is not None and n_probe < 1:
        raise InputError("n_probe", "n_probe must be at least 1.")
    if n_probe is None:
        small = _small_query_block(_query_vectors(queries), broadcast_bytes)
        if small is not None:
            hits = scan_hits(_ticket_vectors(tickets), small, k, dense_candidates(metric))
            return _ranked(hits, k)
    if cells is None:
        tickets, cells = build_cells(_ticket_vectors(tickets), n_cells)
    # Read several times below, and perhaps made by a model.
    queries = materialize(_query_vectors(queries))
    if n_probe is None:
        hits = exact_cell_hits(tickets, queries, cells, k, metric, block_rows)
    else:
        hits = approximate_hits(tickets, queries, cells, k, n_probe, metric, block_rows)
    return _ranked(hits, k)


def _ranked(hits: DataFrame, k: int) -> DataFrame:
    return top_k_per_query(hits, k).select("query_id", "rank", "ticket_id", "similarity_score")


def recall_against(exact: DataFrame, found: DataFrame) -> DataFrame:
    """Share of the exact (query, ticket) pairs that another result also has."""
    pairs = found.select("query_id", "ticket_id", F.lit(1).alias("hit"))
    return exact.join(pairs, ["query_id", "ticket_id"], "left").agg(
        F.count(F.lit(1)).alias("n_expected"),
        F.count("hit").alias("n_found"),
        F.coalesce(F.try_divide(F.count("hit"), F.count(F.lit(1))), F.lit(0.0)).alias("recall"),
    )
