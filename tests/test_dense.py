import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from precedent.errors import InputError
from precedent.operators import dense
from precedent.operators.blocks import BestHits

DIM = 6


def table(spark, key, rows):
    return spark.createDataFrame(
        [(i, [float(x) for x in v]) for i, v in rows], f"{key} string, vector array<double>"
    )


def data(seed, n_tickets, n_queries, copies=0):
    """Clustered tickets; ``copies`` of them are one and the same vector."""
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(5, DIM))
    tickets = centres[rng.integers(0, 5, n_tickets)] + 0.3 * rng.normal(size=(n_tickets, DIM))
    tickets[:copies] = tickets[0]
    queries = centres[rng.integers(0, 5, n_queries)] + 0.3 * rng.normal(size=(n_queries, DIM))
    if copies:
        queries[0] = tickets[0]
    return (
        [(f"T{i:04d}", v) for i, v in enumerate(tickets)],
        [(f"Q{i}", v) for i, v in enumerate(queries)],
    )


def brute_force(tickets, queries, k, metric):
    result = {}
    for query, q in queries:
        rows = []
        for ticket, t in tickets:
            a, b = q / np.linalg.norm(q), t / np.linalg.norm(t)
            score = float(np.exp(-np.sum((a - b) ** 2))) if metric == dense.EXP_NEG_SQ_L2 else float(a @ b)
            rows.append((-round(score, 9), ticket, score))
        result[query] = [(t, s) for _, t, s in sorted(rows)[:k]]
    return result


def collected(ranked):
    result = {}
    for r in ranked.orderBy("query_id", "rank").collect():
        result.setdefault(r.query_id, []).append((r.ticket_id, r.similarity_score))
        assert r.rank == len(result[r.query_id])
    return result


def assert_same(found, expected):
    assert found.keys() == expected.keys()
    for query, rows in expected.items():
        assert [t for t, _ in found[query]] == [t for t, _ in rows]
        assert [s for _, s in found[query]] == pytest.approx([s for _, s in rows], abs=1e-9)


PLANS = {
    "scan": {},
    "cells": {"broadcast_bytes": 0, "n_cells": 6},
    "small blocks": {"broadcast_bytes": 0, "n_cells": 4, "block_rows": 7},
    "one cell": {"broadcast_bytes": 0, "n_cells": 1},
    "all probes": {"n_probe": 100, "n_cells": 5},
}


@pytest.mark.parametrize("plan", PLANS)
@pytest.mark.parametrize("metric", [dense.EXP_NEG_SQ_L2, dense.COSINE])
def test_every_exact_plan_equals_brute_force(spark, plan, metric):
    # A third of the tickets are copies, and one query asks for just these.
    tickets, queries = data(1, 180, 23, copies=60)
    found = dense.dense_top_k(
        table(spark, "ticket_id", tickets), table(spark, "query_id", queries), 5, metric, **PLANS[plan]
    )
    assert_same(collected(found), brute_force(tickets, queries, 5, metric))


@pytest.mark.parametrize("plan", PLANS)
def test_fewer_tickets_than_k(spark, plan):
    tickets, queries = data(2, 3, 4)
    options = PLANS[plan] | ({"n_cells": 2} if "n_cells" in PLANS[plan] else {})
    found = dense.dense_top_k(
        table(spark, "ticket_id", tickets), table(spark, "query_id", queries), 5, **options
    )
    assert_same(collected(found), brute_force(tickets, queries, 5, dense.EXP_NEG_SQ_L2))


def test_no_queries(spark):
    tickets, _ = data(3, 10, 1)
    found = dense.dense_top_k(
        table(spark, "ticket_id", tickets), table(spark, "query_id", []), 3
    )
    assert found.count() == 0


def test_bounds_leave_cells_out_but_never_a_winner():
    """On separated clusters far cells are skipped; the true best is always inside."""
    rng = np.random.default_rng(4)
    centres = np.eye(8)
    tickets = np.repeat(centres, 50, axis=0) + 0.05 * rng.normal(size=(400, 8))
    tickets /= np.linalg.norm(tickets, axis=1, keepdims=True)
    distances = np.linalg.norm(tickets[:, None] - centres[None], axis=2)
    home = distances.argmin(axis=1)
    near = np.array([distances[home == c, c].min() for c in range(8)])
    far = np.array([distances[home == c, c].max() for c in range(8)])
    cells = dense.Cells(centres, np.bincount(home, minlength=8), near, far)
    queries = tickets[::7]
    scores = np.exp(-np.sum((queries[:, None] - tickets[None]) ** 2, axis=2))
    floor = np.sort(scores, axis=1)[:, -3]
    to_pivots = np.linalg.norm(queries[:, None] - centres[None], axis=2)
    reachable = dense.reachable_cells(to_pivots, cells, floor, dense.EXP_NEG_SQ_L2)
    best = np.argsort(-scores, axis=1)[:, :3]
    assert reachable[np.arange(len(queries))[:, None], home[best]].all()
    assert reachable.sum() < 0.5 * reachable.size


def test_approximate_recall_grows_with_probes(spark):
    tickets, queries = data(5, 300, 30)
    tickets, queries = table(spark, "ticket_id", tickets), table(spark, "query_id", queries)
    assigned, cells = dense.build_cells(tickets, 10)
    exact = dense.dense_top_k(tickets, queries, 3)
    recall = [
        dense.recall_against(
            exact, dense.dense_top_k(assigned, queries, 3, cells=cells, n_probe=probes)
        ).head().recall
        for probes in (1, 3, 10)
    ]
    assert recall[0] <= recall[1] <= recall[2] == 1.0


def test_unequal_vectors_are_refused(spark):
    rows = table(spark, "ticket_id", [("a", [1.0, 2.0]), ("b", [1.0])])
    with pytest.raises(InputError):
        dense.vector_dim(rows)
    with pytest.raises(Exception, match="one length"):
        dense.dense_top_k(rows, table(spark, "query_id", [("q", [1.0, 0.0])]), 1).collect()
    with pytest.raises(InputError):
        dense.dense_top_k(rows, rows, 1, metric="dot")


def test_numbers_that_are_not_finite_are_refused(spark):
    for bad in (float("nan"), float("inf"), float("-inf")):
        with pytest.raises(InputError):
            dense.vector_dim(table(spark, "ticket_id", [("a", [1.0, 2.0]), ("b", [1.0, bad])]))


def test_small_tiles_give_the_same_result(spark, monkeypatch):
    tickets, queries = (table(spark, key, rows) for key, rows in zip(("ticket_id", "query_id"), data(6, 120, 40)))
    plan = {"broadcast_bytes": 0, "n_cells": 6}

    def found():
        # Sums of another order differ past the digits that scores are ranked on.
        rows = dense.dense_top_k(tickets, queries, 3, **plan).collect()
        return sorted((r.query_id, r.rank, r.ticket_id, round(r.similarity_score, 9)) for r in rows)

    whole = found()
    monkeypatch.setattr(dense, "TILE_CELLS", 20)
    assert found() == whole


def test_pair_score_on_the_jvm(spark):
    row = spark.range(1).select(
        dense.squared_l2_score(
            F.array(F.lit(1.0), F.lit(0.0)), F.array(F.lit(0.0), F.lit(1.0))
        ).alias("s")
    )
    assert row.head().s == pytest.approx(np.exp(-2.0))


def test_a_query_that_reaches_every_cell_is_written_once_per_pack(spark):
    """What the second pass moves does not grow with the cells where no bound excludes one."""
    rng = np.random.default_rng(7)
    tickets = [(f"T{i:03d}", v) for i, v in enumerate(rng.normal(size=(200, 40)))]
    queries = table(spark, "query_id", [(f"Q{i}", v) for i, v in enumerate(rng.normal(size=(20, 40)))])
    assigned, cells = dense.build_cells(table(spark, "ticket_id", tickets), 25)
    packs = dense.pack_cells(cells.n, 100)
    assert packs.max() + 1 <= 4 and np.bincount(packs, weights=cells.n).sum() == 200
    asked = queries.withColumn("floor", F.lit(None).cast("double"))
    visits = dense._pack_visits(asked, cells, packs, lambda distances, held, floor: np.broadcast_to(held.n > 0, distances.shape))
    rows = visits.toArrow()
    assert rows.num_rows == 20 * (packs.max() + 1)
    for p in range(packs.max() + 1):
        bits = dense._bit_matrix(rows.filter(rows["pack"].to_numpy() == p)["cells"], int((packs == p).sum()))
        assert (bits == (cells.n[packs == p] > 0)).all()


@pytest.mark.parametrize("metric", [dense.EXP_NEG_SQ_L2, dense.COSINE])
def test_differences_below_single_precision_are_ranked(metric):
    """Many tickets closer together than single precision tells apart, in an order that is not theirs, and one without a number."""
    rng = np.random.default_rng(8)
    query = rng.normal(size=DIM)
    tickets = [(f"T{i:04d}", query + 2e-4 * np.sqrt(i) * np.eye(DIM)[i % DIM]) for i in rng.permutation(3000)]
    def arrow(key, rows):
        return pa.table({key: [i for i, _ in rows], "vector": [list(map(float, v)) for _, v in rows]})
    asked = [("Q", query), ("R", -query)]
    best = BestHits(arrow("query_id", asked), 5, dense.dense_candidates(metric)(arrow("query_id", asked)))
    for i in range(0, 3000, 700):
        best.add(arrow("ticket_id", tickets[i : i + 700] + [("none", np.full(DIM, np.nan))] * 9))
    found = {}
    for r in best.table().sort_by([("query_id", "ascending")]).to_pylist():
        found.setdefault(r["query_id"], []).append((r["ticket_id"], r["similarity_score"]))
    assert_same(found, brute_force(tickets, asked, 5, metric))


@pytest.mark.parametrize("wanted", [None, np.arange(0, 2500, 3)])
def test_entries_come_in_few_large_pieces(wanted):
    """However many pieces the score matrix is cut into, what reaches the floors is scored together, and nothing is lost."""
    rng = np.random.default_rng(11)
    queries, tickets = rng.normal(size=(2500, 16)), rng.normal(size=(5000, 16))

    def arrow(key, vectors):
        return pa.table({key: [str(i) for i in range(len(vectors))], "vector": vectors.tolist()})

    side = dense.dense_candidates(dense.COSINE)(arrow("query_id", queries))
    floor = np.full(2500, 0.8)
    options = {} if wanted is None else {"wanted": wanted}
    pieces = list(side.find(side.against(arrow("ticket_id", tickets)), slice(0, 2500), floor, 3, **options))
    unit = [v / np.linalg.norm(v, axis=1, keepdims=True) for v in (queries, tickets)]
    asked = np.arange(2500) if wanted is None else wanted
    row, column = np.nonzero(np.round(unit[0][asked] @ unit[1].T, 9) >= 0.8)
    assert {(q, t) for p in pieces for q, t in zip(p[0].tolist(), p[1].tolist())} == set(zip(asked[row].tolist(), column.tolist()))
    assert len(pieces) == 1 and 100 < sum(len(p[0]) for p in pieces) < side.EXACT


def test_vectors_are_made_once_for_the_cells(spark):
    made = spark.sparkContext.accumulator(0)

    @F.udf("array<double>")
    def vector(i):
        made.add(1)
        return [float(i % 7), float(i % 5), 1.0]

    tickets = spark.range(400).select(F.col("id").cast("string").alias("ticket_id"), vector("id").alias("vector"))
    assigned, cells = dense.build_cells(tickets, 4)
    assert assigned.count() == cells.n.sum() == 400
    assert made.value == 400


def test_entries_that_reach_are_found_in_pieces_of_any_size():
    side = dense.DenseCandidates(pa.table({"vector": [[1.0, 0.0]]}), dense.COSINE)
    draw = np.random.default_rng(1)
    for cells in (1000, 999, 17, 16, 9, 8, 7, 1):
        for share in (0.0, 0.01, 1.0):
            side.reached[:1008] = True  # what an earlier, larger piece may have left
            side.reached[:cells] = draw.random(cells) < share
            expected = np.flatnonzero(side.reached[:cells])
            assert side._hits(cells).tolist() == expected.tolist()


def test_pairs_of_blocks_get_tasks_of_their_own(spark, monkeypatch):
    """Tasks grow with what is compared, not with the shuffle partitions or the bytes of the blocks."""
    tickets, queries = data(11, 240, 200)
    rows, asked = table(spark, "ticket_id", tickets), table(spark, "query_id", queries)
    assigned, cells = dense.build_cells(rows, 6)
    monkeypatch.setattr(dense, "TASK_PAIRS", 1000)
    floored = asked.withColumn("floor", F.lit(None).cast("double"))
    every = lambda distances, held, floor: np.ones(distances.shape, bool) & (held.n > 0)
    hits = dense.reached_hits(assigned, floored, cells, every, 3, dense.COSINE, 16)
    assert hits.select(F.spark_partition_id()).distinct().count() > 30
    assert_same(collected(dense._ranked(hits, 3)), brute_force(tickets, queries, 3, dense.COSINE))


def test_pairs_are_dealt_evenly(monkeypatch):
    monkeypatch.setattr(dense, "TASK_PAIRS", 1 << 20)
    rng = np.random.default_rng(2)
    tickets, asked = rng.integers(1, 4000, 300), rng.integers(1, 4000, 300)
    blocks = -(-tickets // 512), -(-asked // 512)
    first, tasks = dense.number_pairs(tickets, asked, *blocks, least=4)
    n = blocks[0] * blocks[1]
    number = np.concatenate([np.arange(f, f + k) for f, k in zip(first, n)])
    assert sorted(number.tolist()) == list(range(n.sum()))
    load = np.bincount(number % tasks, weights=np.repeat(tickets * asked / n, n))
    assert load.max() < 2 * load.mean() and tasks >= (tickets * asked).sum() / (1 << 20) - 1


def test_a_query_that_probes_many_cells_is_moved_once_per_pack(spark, monkeypatch):
    tickets, queries = data(13, 120, 20)
    asked = table(spark, "query_id", queries)
    assigned, cells = dense.build_cells(table(spark, "ticket_id", tickets), 10)
    moved, dealt = [], dense._dealt

    def recorded(rows, tasks, *columns):
        if "query_id" in columns:
            moved.append(rows.count())
        return dealt(rows, tasks, *columns)

    monkeypatch.setattr(dense, "_dealt", recorded)
    found = dense.dense_top_k(assigned, asked, 3, cells=cells, n_probe=dense.MAX_CELLS)
    assert moved == [len(queries)]
    assert_same(collected(found), brute_force(tickets, queries, 3, dense.EXP_NEG_SQ_L2))
