"""Scoring bounded blocks of queries against bounded blocks of tickets.

Spark decides which rows meet; the functions here only score the rows of one
Arrow batch or one co-group and keep the best k per query, so the number of rows
a task emits never depends on how many pairs it looked at.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from precedent.schemas import RANK_DIGITS
from precedent.session import ship_package

HITS = "query_id string, ticket_id string, similarity_score double"
HITS_ARROW = pa.schema(
    [
        ("query_id", pa.string()),
        ("ticket_id", pa.string()),
        ("similarity_score", pa.float64()),
    ]
)

# Cells of one score matrix held at a time (8 bytes each).
TILE_CELLS = 4_000_000
SCAN_TASKS = 4096

# Queries whose best k are merged at a time, and entries that may wait for it.
QUERY_TILE = 4096
PENDING = 65_536

def _keep_best(q: np.ndarray, ids: pa.Array, score: np.ndarray, k: int):
    """Best k entries per query: rounded score descending, then id ascending."""
    rounded = np.round(score, RANK_DIGITS)
    order = np.lexsort((-rounded, q))
    if np.any((np.diff(q[order]) == 0) & (np.diff(rounded[order]) == 0)):
        entries = pa.table({"q": q, "r": rounded, "id": ids})
        order = pc.sort_indices(
            entries, sort_keys=[("q", "ascending"), ("r", "descending"), ("id", "ascending")]
        ).to_numpy()
    q = q[order]
    best = np.arange(len(q)) - np.searchsorted(q, q, side="left") < k
    order = order[best]
    return q[best], ids.take(pa.array(order)), score[order]


class BestHits:
    """Running best k per query over many ticket batches, kept by tiles of queries.

    ``candidates`` has ``against(tickets)``, what is the same for all tiles, and ``find(that, rows, floor, k)``: (query offsets
    within ``rows``, ticket offsets, scores) with every entry of the best k that reaches its query's floor. It may raise
    ``floor`` to what k of these tickets surely reach.
    """

    def __init__(self, queries: pa.Table, k: int, candidates, positive_only: bool = False, floor: np.ndarray | None = None):
        self.k, self.candidates = k, candidates
        self.query_ids = queries["query_id"].combine_chunks()
        # A ticket has to reach the floor of its query to enter the list.
        lowest = 10.0**-RANK_DIGITS if positive_only else -np.inf
        self.floor = np.full(len(self.query_ids), lowest)
        if floor is not None:
            # One digit lower, as sums of another order may round to the other side.
            self.floor = np.maximum(self.floor, np.round(floor - 10.0**-RANK_DIGITS, RANK_DIGITS))
        n = len(self.query_ids)
        self.tiles = [slice(i, min(n, i + QUERY_TILE)) for i in range(0, n, QUERY_TILE)]
        self.best = [(np.empty(0, np.int64), pa.array([], pa.string()), np.empty(0)) for _ in self.tiles]
        self.pending = [[] for _ in self.tiles]

    def add(self, tickets: pa.Table, wanted: np.ndarray | None = None) -> None:
        """``wanted``: the queries to compare with these tickets, all where it is missing."""
        if not len(self.query_ids):
            return
        ids = tickets["ticket_id"].combine_chunks().cast(pa.string())
        side = self.candidates.against(tickets)
        for i, rows in enumerate(self.tiles):
            options = {} if wanted is None else {"wanted": np.flatnonzero(wanted[rows])}
            for at_q, at_ticket, score in self.candidates.find(side, rows, self.floor[rows], self.k, **options):
                if len(at_q):
                    self.pending[i].append((at_q, ids.take(pa.array(at_ticket)), score))
                    if sum(len(q) for q, _, _ in self.pending[i]) > PENDING:
                        self._merge(i)

    def _merge(self, i: int) -> None:
        if not self.pending[i]:
            return
        q, ids, score = zip(self.best[i], *self.pending[i])
        self.best[i] = q, _, score = _keep_best(np.concatenate(q), pa.concat_arrays(ids), np.concatenate(score), self.k)
        self.pending[i] = []
        rows = self.tiles[i]
        held = np.bincount(q, minlength=rows.stop - rows.start)
        full = np.flatnonzero(held >= self.k)
        last = np.searchsorted(q, full, side="right") - 1
        reached = np.round(score[last], RANK_DIGITS)
        self.floor[rows.start + full] = np.maximum(self.floor[rows.start + full], reached)

    def table(self) -> pa.Table:
        """One row per entry; ``parts`` hands them out without putting all of them together."""
        return pa.concat_tables([HITS_ARROW.empty_table(), *self.parts()])

    def parts(self) -> Iterator[pa.Table]:
        for i, rows in enumerate(self.tiles):
            self._merge(i)
            q, ids, score = self.best[i]
            yield pa.table([self.query_ids.take(pa.array(q + rows.start)), ids, score], schema=HITS_ARROW)


def scan_hits(
    tickets: DataFrame, queries: pa.Table, k: int, candidates, positive_only: bool = False
) -> DataFrame:
    """Stream the tickets past a small, already size-checked query block.

    No shuffle of the tickets. Input partitions are merged (narrow) down to
    ``SCAN_TASKS`` or a few per core, so that the number of best-k lists emitted
    stops growing with the ticket table.
    """
    session = tickets.sparkSession
    ship_package(session)
    shared = session.sparkContext.broadcast(queries)

    def scan(batches):
        best = BestHits(shared.value, k, candidates(shared.value), positive_only)
        for batch in batches:
            if batch.num_rows:
                best.add(pa.Table.from_batches([batch]))
        for part in best.parts():
            yield from part.to_batches()

    # The core count is low while a cluster still adds executors, hence the floor.
    tasks = max(SCAN_TASKS, 4 * session.sparkContext.defaultParallelism)
    return tickets.coalesce(tasks).mapInArrow(scan, HITS)


def cogroup_hits(
    tickets: DataFrame,
    queries: DataFrame,
    keys: list[str],
    k: int,
    candidates,
    positive_only: bool = False,
) -> DataFrame:
    """Score every co-group of one bounded query block and one bounded ticket block."""

    ship_package(tickets.sparkSession)

    def score(ticket_block: pa.Table, query_block: pa.Table) -> pa.Table:
        if not ticket_block.num_rows or not query_block.num_rows:
            return HITS_ARROW.empty_table()
        floor = None
        if "floor" in query_block.column_names:
            floor = query_block["floor"].to_numpy().astype(np.float64)
            floor = np.where(np.isnan(floor), -np.inf, floor)
        best = BestHits(query_block, k, candidates(query_block), positive_only, floor)
        best.add(ticket_block)
        return best.table()

    return tickets.groupBy(*keys).cogroup(queries.groupBy(*keys)).applyInArrow(score, HITS)


def collect_small(df: DataFrame, max_rows: int) -> pa.Table | None:
    """The rows as Arrow when there are at most ``max_rows``, else ``None``.

    At most ``max_rows + 1`` rows reach the driver.
    """
    rows = df.limit(max_rows + 1).toArrow()
    return rows if rows.num_rows <= max_rows else None
