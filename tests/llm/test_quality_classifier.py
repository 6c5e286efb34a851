import numpy as np
import pytest

from precedent.llm import quality_classifier as qc
from precedent.llm.common import fold


def made(n, seed=0):
    rng = np.random.default_rng(seed)
    words = [f"word{i}" for i in range(300)]
    rows = []
    for i in range(n):
        if i % 3:
            text = ". ".join(" ".join(rng.choice(words, rng.integers(5, 15))).capitalize() for _ in range(5)) + "."
        else:
            text = " | ".join(rng.choice(words, 40)) if i % 2 else "buy now!! " * 30
        rows.append((i, text, int(i % 3 > 0)))
    return rows


def test_held_out_accuracy_and_edges(spark):
    rows = made(450)
    docs = [(i, t, 0.0) for i, t, _ in rows] + [(900, None, 1.0), (901, "", 1.0), (902, "x" * 100_000, 1.0), (None, "no id", 1.0), (5, "again", 1.0)]
    docs = spark.createDataFrame(docs, "doc_id long, text string, score double")
    labels = [(i, y) for i, _, y in rows] + [(3, 0), (900, None), (None, 1)]
    labels = spark.createDataFrame(labels, "doc_id long, quality int")
    found = qc.quality_scores(docs, labels).collect()
    assert len(found) == 455
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) and r.held_out == (fold(r.doc_id) == 1) for r in found)
    truth = {i: y for i, _, y in rows if i != 5}
    held = [r for r in found if r.held_out and r.doc_id in truth]
    assert np.mean([r.predicted == truth[r.doc_id] for r in held]) > 0.95


def test_held_out_labels_are_not_learned(spark):
    rows = made(200)
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id long, quality int")
    turned = spark.createDataFrame([(i, 1 - y if fold(i) == 1 else y) for i, _, y in rows], "doc_id long, quality int")
    one, two = ({r.doc_id: r.score for r in qc.quality_scores(docs, x).collect()} for x in (labels, turned))
    assert one == pytest.approx(two)


@pytest.mark.parametrize(("given", "score"), [([], 0.5), ([(0, 1), (2, 1), (3, 1), (4, 1), (5, 1)], 1.0)])
def test_labels_of_one_kind(spark, given, score):
    docs = spark.createDataFrame([(0, "a b"), (1, None)], "doc_id long, text string")
    labels = spark.createDataFrame(given, "doc_id long, quality int")
    docs = docs.union(spark.createDataFrame([(i, "t") for i in range(2, 6)], "doc_id long, text string"))
    assert {r.score for r in qc.quality_scores(docs, labels).collect()} == {score}
    assert qc.quality_scores(docs.limit(0), labels).count() == 0


def test_isotonic_equals_brute_force():
    rng = np.random.default_rng(1)
    for _ in range(30):
        n = rng.integers(1, 8)
        y, w = rng.random(n), rng.integers(1, 5, n).astype(float)
        # max over starts of min over ends of the weighted mean
        best = [max(min(np.average(y[a : b + 1], weights=w[a : b + 1]) for b in range(i, n)) for a in range(i + 1)) for i in range(n)]
        xs, ys = qc.isotonic(np.arange(n), y, w)
        assert np.interp(np.arange(n), xs, ys) == pytest.approx(best)


def test_normal_equations_are_sums_over_partitions(spark):
    rows = spark.createDataFrame([(float(i),) for i in range(50)], "v double").repartition(7)
    total = qc._summed(rows, 5000, lambda b: np.full(5000, b.column("v").to_numpy().sum()))
    assert total == pytest.approx(np.full(5000, 1225.0))
