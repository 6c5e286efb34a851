import random
import re
from collections import defaultdict
from hashlib import md5

import pytest
from pyspark.sql import functions as F

from precedent.llm import curriculum

SCHEMA = "doc_id long, text string, source string, position int, _total string"


def brute(rows, weights=(3, 1, 2), budget=1.5, repeats=2):
    """(size, source_size, target, taken) per row; ids have to be distinct."""
    size = [len(re.findall(r"[^\x20\x09-\x0D]+", r[1] or "")) for r in rows]
    names = sorted({r[2] for r in rows}, key=lambda s: (s is None, s or ""))
    total = {s: sum(n for n, r in zip(size, rows) if r[2] == s) for s in names}
    weight = {s: weights[i % 3] for i, s in enumerate(names)}
    full = set()
    while True:
        rest = [s for s in names if s not in full]
        level = (budget * sum(size) - sum(repeats * total[s] for s in full)) / sum(weight[s] for s in rest) if rest else 0
        more = {s for s in rest if weight[s] * level > repeats * total[s]}
        if not more:
            break
        full |= more
    target = {s: repeats * total[s] if s in full else weight[s] * level for s in names}
    taken = [0] * len(rows)
    for s in names:
        left = int(target[s] + 0.5)
        order = sorted((i for i, r in enumerate(rows) if r[2] == s), key=lambda i: md5(f"mix:{rows[i][0]}".encode()).hexdigest())
        for i in order * repeats:
            take = min(left, size[i])
            taken[i] += take
            left -= take
    return {r[0]: (n, total[r[2]], target[r[2]], t) for r, n, t in zip(rows, size, taken)}


def random_rows(n, seed):
    rng = random.Random(seed)
    texts = [None, "", " \t\n", "word"]
    rows = []
    for i in range(n):
        text = rng.choice(texts) if rng.random() < 0.2 else " ".join("x" * rng.randint(1, 5) for _ in range(rng.randint(1, 300)))
        rows.append((i, text, rng.choice([None, "", "a", "Z", "é", "b", "hot", "hot", "hot"]), 7, "clash"))
    return rows


@pytest.mark.parametrize("seed", range(3))
def test_mix_equals_brute_force(spark, seed):
    rows = random_rows(200, seed)
    found = curriculum.mix(spark.createDataFrame(rows, SCHEMA)).collect()
    expected = brute(rows)
    assert len(found) == len(rows)
    for r in found:
        size, source_size, target, taken = expected[r.doc_id]
        assert (r.size, r.source_size, r.taken) == (size, source_size, taken)
        assert r.target == pytest.approx(target, abs=1e-6)
        assert r.taken == sum(c.words for c in r.copies) <= 2 * r.size
    positions = [r.position for r in found if r.position is not None]
    assert positions == sorted(positions) and all(0 <= p < 1 for p in positions)
    assert all(r.position is None for r in found[len(positions) :])


def test_training_positions_follow_the_schedules(spark):
    rows = [(i, "w " * 10, s) for i, s in enumerate(["a", "b", "c"] * 400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    order = curriculum.training_order(curriculum.mix(docs, budget=1.0)).collect()
    assert [r.position for r in order] == sorted(r.position for r in order)
    words = defaultdict(lambda: [0, 0])
    for r in order:
        words[r.source][r.position >= 0.5] += r.words
    # Integrals over the halves of the schedules: 1.75 and 1.25, 0.375 and 0.625, 1 and 1.
    for source, first in (("a", 1.75 / 3), ("b", 0.375), ("c", 0.5)):
        assert words[source][0] / sum(words[source]) == pytest.approx(first, abs=0.01)


def test_due_time_inverts_the_integral(spark):
    points = ((0.0, 0.0), (0.25, 2.0), (0.5, 0.0), (0.75, 0.0), (1.0, 1.0))
    pieces = curriculum.segments(curriculum.knots(points))
    rows = spark.range(0, 1000).select((F.col("id") / 1000 * 0.625).alias("area"), pieces.alias("p"))
    for area, time in rows.select("area", curriculum.due_time(F.col("p"), F.col("area"))).collect():
        done = 0.0
        for (t0, w0), (t1, w1) in zip(points, points[1:]):
            end = min(max(time, t0), t1)
            w = w0 + (w1 - w0) / (t1 - t0) * (end - t0)
            done += (w0 + w) / 2 * (end - t0)
        assert done == pytest.approx(area, abs=1e-9)


def test_reruns_agree_on_other_partitions(spark):
    rows = random_rows(150, 9) + [(3, "same words here", "hot", 1, "x")] * 40 + [(None, "a b", "hot", 1, "y")] * 30
    docs = spark.createDataFrame(rows, SCHEMA)
    first = curriculum.mix(docs.repartition(5)).collect()
    again = curriculum.mix(docs.orderBy(F.rand(1)).coalesce(1)).collect()
    assert sorted(map(str, first)) == sorted(map(str, again))


def test_empty_and_wordless_tables(spark):
    empty = curriculum.mix(spark.createDataFrame([], SCHEMA))
    assert empty.columns == ["doc_id", "source", "size", "source_size", "target", "taken", "copies", "position"]
    assert empty.count() == 0
    blank = curriculum.mix(spark.createDataFrame([(1, None, None, 0, "")], SCHEMA)).collect()
    assert [(r.size, r.source_size, r.target, r.taken) for r in blank] == [(0, 0, 0.0, 0)]
