import math
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from precedent.operators import lexical
from precedent.operators.skew import salted_join
from tests.test_dense import assert_same, collected


def texts(seed, n, shift, copies=0):
    """Texts over a skewed vocabulary; ``copies`` of them are the same text."""
    rng = np.random.default_rng(seed)
    rows = []
    for i in range(n):
        words = np.minimum(rng.zipf(1.3, rng.integers(1, 30)), 200 + shift)
        rows.append((f"{'D' if shift else 'Q'}{i:03d}", " ".join(f"w{w}" for w in words)))
    for i in range(copies):
        rows[i] = (rows[i][0], "The same Text, w7 w7 w190 every time!")
    return rows


def brute_force(documents, queries, k):
    def count(text):
        return Counter(re.findall(lexical.TOKEN_PATTERN, text.lower()))

    counts = {d: count(t) for d, t in documents}
    df = Counter(term for c in counts.values() for term in c)

    def unit(c):
        w = {t: n * (math.log((len(documents) + 1) / (df[t] + 1)) + 1) for t, n in c.items()}
        norm = math.sqrt(sum(x * x for x in w.values()))
        return {t: x / norm for t, x in w.items()}

    vectors = {d: unit(c) for d, c in counts.items()}
    result = {}
    for q, text in queries:
        own = unit(count(text))
        rows = []
        for d, vector in vectors.items():
            score = sum(x * vector.get(t, 0.0) for t, x in own.items())
            if score > 0:
                rows.append((-round(score, 9), d, score))
        if rows:
            result[q] = [(d, s) for _, d, s in sorted(rows)[:k]]
    return result


def weights(spark, documents, queries):
    docs = spark.createDataFrame(documents, "ticket_id string, text string")
    asks = spark.createDataFrame(queries, "query_id string, text string")
    forward, vocab, n = lexical.tfidf(docs, "ticket_id", "text")
    return forward, lexical.query_weights(asks, "text", vocab, n)


@pytest.mark.parametrize(
    "plan",
    [
        {},
        {"broadcast_queries": 0},
        {"broadcast_queries": 0, "block_postings": 60, "block_queries": 4},
    ],
)
def test_every_plan_equals_brute_force(spark, plan):
    documents = texts(1, 90, 40, copies=30)
    queries = texts(2, 15, 0) + [("Q900", "same text w190"), ("Q901", "unknown words only")]
    forward, asks = weights(spark, documents, queries)
    found = lexical.lexical_top_k(forward, asks, 5, **plan)
    assert_same(collected(found), brute_force(documents, queries, 5))


def test_small_steps_add_up_to_the_same_scores(spark, monkeypatch):
    documents, queries = texts(3, 40, 40), texts(4, 12, 0)
    forward, asks = weights(spark, documents, queries)
    blocks = asks.toArrow(), forward.toArrow()
    whole = [m for _, m in lexical.lexical_scorer(*blocks)]
    monkeypatch.setattr(lexical, "STEP_PRODUCTS", 3)
    monkeypatch.setattr(lexical, "TILE_CELLS", 100)
    parts = [m for _, m in lexical.lexical_scorer(*blocks)]
    assert len(parts) > 1
    assert np.allclose(np.vstack(whole), np.vstack(parts), atol=1e-12)


def test_blocks_without_a_chance_are_not_visited(spark):
    """A rare shared term decides; frequent terms alone open no block."""
    documents = [(f"D{i:03d}", "common words here " + f"r{i} s{i} t{i}") for i in range(60)]
    queries = [("Q", "r5 s5 t5 common"), ("R", "r7 s7 t7 r8 s8 t8 r9 s9 t9 words")]
    forward, asks = weights(spark, documents, queries)
    found = lexical.lexical_top_k(forward, asks, 1, broadcast_queries=0, block_postings=20)
    assert_same(collected(found), brute_force(documents, queries, 1))
    terms = lexical._suffix_norms(asks, "query_id")
    assert terms.where("term = 'common'").head().rest < 0.5


def test_queries_short_of_k_are_filled_by_id(spark):
    ranked = spark.createDataFrame(
        [("Q1", 1, "D2", 0.5), ("Q2", 1, "D9", 0.4), ("Q2", 2, "D1", 0.3), ("Q2", 3, "D0", 0.2)],
        "query_id string, rank int, ticket_id string, similarity_score double",
    )
    ids = spark.createDataFrame([("Q1",), ("Q2",), ("Q3",)], "query_id string")
    found = collected(lexical.fill_to_k(ranked, ids, ["D0", "D1", "D2", "D3"], 3))
    assert found["Q1"] == [("D2", 0.5), ("D0", 0.0), ("D1", 0.0)]
    assert [t for t, _ in found["Q2"]] == ["D9", "D1", "D0"]
    assert found["Q3"] == [("D0", 0.0), ("D1", 0.0), ("D2", 0.0)]


@pytest.mark.parametrize("how", ["left", "inner"])
def test_salted_join_is_a_join(spark, monkeypatch, how):
    monkeypatch.setattr("precedent.operators.skew.HOT_KEYS", 2)
    cold = F.concat(F.lit("k"), F.col("id") % 40)
    rows = spark.range(300).select(
        "id", F.when(F.col("id") % 3 == 0, "hot").otherwise(cold).alias("key")
    )
    table = spark.createDataFrame(
        [("hot", 1), ("hot", 2)] + [(f"k{i}", i) for i in range(30)], "key string, value int"
    )
    plain = rows.join(table, "key", how).select("id", "key", "value")
    salted = salted_join(rows, table, "key", "id", how).select("id", "key", "value")
    assert sorted(map(str, salted.collect())) == sorted(map(str, plain.collect()))


def test_tasks_that_count_terms_follow_the_bytes_of_text(spark, monkeypatch):
    """What is shuffled is small beside the counts made of it, so its size does not tell."""
    rows = spark.range(40).select(F.col("id").cast("string").alias("key"), F.repeat(F.lit("word "), 100).alias("text"))
    monkeypatch.setattr(lexical, "TASK_TEXT_BYTES", 1000)
    counts = lexical.term_counts(rows, "key", "text")
    assert counts.rdd.getNumPartitions() == -(-40 * (500 + 32) // 1000)
    assert sorted((r.key, r.term, r.tf) for r in counts.collect()) == sorted((str(i), "word", 100) for i in range(40))


def test_the_search_runs_once_where_lists_are_filled(spark):
    read = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch

    ranked = spark.createDataFrame([("Q1", 1, "D2", 0.5)], "query_id string, rank int, ticket_id string, similarity_score double")
    ids = spark.createDataFrame([("Q1",), ("Q2",)], "query_id string")
    found = collected(lexical.fill_to_k(ranked.mapInArrow(count, ranked.schema), ids, ["D0", "D2"], 2))
    assert found == {"Q1": [("D2", 0.5), ("D0", 0.0)], "Q2": [("D0", 0.0), ("D2", 0.0)]}
    assert read.value == 1


def known_weights(documents):
    """The weights of ``(key, text)`` rows by their definition; texts of one key count together."""
    counts = {}
    for key, text in documents:
        counts.setdefault(key, Counter()).update(re.findall(lexical.TOKEN_PATTERN, (text or "").lower()))
    df = Counter(term for c in counts.values() for term in c)
    found = {}
    for key, c in counts.items():
        w = {t: n * (math.log((len(documents) + 1) / (df[t] + 1)) + 1) for t, n in c.items()}
        norm = math.sqrt(sum(x * x for x in w.values()))
        if w:
            order = sorted(w, key=lambda t: (df[t], t.encode()))
            found[key] = order, [w[t] / norm for t in order]
    return found


@pytest.mark.parametrize("frequent_bytes", [1 << 24, 600, 0])
def test_weights_whether_frequencies_are_broadcast_or_joined(spark, monkeypatch, frequent_bytes):
    """Keys that repeat or are null, texts that are null or without a term, a very long term."""
    monkeypatch.setattr(lexical, "FREQUENT_BYTES", frequent_bytes)
    documents = texts(5, 60, 40, copies=9)
    documents += documents[20:24] + [(None, "w7 ä ö w190"), (None, "w7 only here"), ("E", None), ("F", "...")]
    documents += [(f"G{i}", "long " + 300 * "x") for i in range(3)]
    rows = spark.createDataFrame(documents, "ticket_id string, text string")
    found = lexical.tfidf(rows, "ticket_id", "text")[0].collect()
    expected = known_weights(documents)
    assert len(found) == len(expected)
    for r in found:
        terms, values = expected[r.ticket_id]
        assert r.terms == terms
        assert r.weights == pytest.approx(values, abs=1e-12)


def test_pieces_hold_all_rows_and_few_terms(monkeypatch):
    monkeypatch.setattr(lexical, "PIECE_TERMS", 5)
    lists = [["a"], ["b", "c", "d"], [], ["e"] * 9, None, ["f"], ["g"] * 5]
    batch = pa.record_batch({"k": list(range(7)), "terms": pa.array(lists, pa.list_(pa.string()))})
    pieces = list(lexical._pieces([batch]))
    assert [x for p in pieces for x in p["terms"].to_pylist()] == lists
    assert all(p.num_rows == 1 or sum(len(x or []) for x in p["terms"].to_pylist()) <= 5 for p in pieces)


def test_no_texts_have_no_weights(spark):
    rows = spark.createDataFrame([], "ticket_id string, text string")
    forward, vocab, n = lexical.tfidf(rows, "ticket_id", "text")
    assert (forward.count(), vocab.count(), n) == (0, 0, 0)


def test_frequent_terms_are_not_moved(spark, monkeypatch):
    """Of the entries only those of rare terms are joined; with all frequencies broadcast there is no join."""
    moved, join = [], salted_join

    def recorded(rows, *rest, **options):
        moved.append(rows.count())
        return join(rows, *rest, **options)

    monkeypatch.setattr(lexical, "salted_join", recorded)
    rows = spark.createDataFrame([(f"D{i}", f"a b c d r{i // 2} s{i}") for i in range(40)], "ticket_id string, text string")
    lexical.tfidf(rows, "ticket_id", "text")
    assert moved == []
    monkeypatch.setattr(lexical, "FREQUENT_BYTES", 100)
    lexical.tfidf(rows, "ticket_id", "text")
    assert moved == [80]


def test_queries_go_in_waves_that_leave_nothing_behind(spark, monkeypatch):
    """The best k of all waves, with what was moved and kept for each of them deleted."""
    monkeypatch.setattr(lexical, "WAVE_POSTINGS", 40)
    kept, waves, block_hits = [], [], lexical.block_hits

    def recorded(forward, queries, *rest):
        waves.append(queries.count())
        kept.append(rest[-1])
        return block_hits(forward, queries, *rest)

    monkeypatch.setattr(lexical, "block_hits", recorded)
    documents, queries = texts(6, 80, 40, copies=20), texts(7, 21, 0)
    forward, asks = weights(spark, documents, queries)
    found = lexical.lexical_top_k(forward, asks, 4, broadcast_queries=0, block_postings=60, block_queries=4)
    assert_same(collected(found), brute_force(documents, queries, 4))
    assert len(waves) > 2 and sum(waves) == 21
    assert list(kept[0].paths) == ["hits"]


def test_only_terms_that_are_asked_for_are_moved(spark):
    documents, queries = texts(8, 30, 40), [("Q", "w1 w2 w3"), ("R", "w2 w9")]
    forward, asks = weights(spark, documents, queries)
    terms = asks.select(F.explode("terms").alias("term")).distinct()
    left = {r.ticket_id: dict(zip(r.terms, r.weights)) for r in lexical._asked_terms_only(forward, terms).collect()}
    whole = {r.ticket_id: dict(zip(r.terms, r.weights)) for r in forward.collect()}
    expected = {t: {w: x for w, x in v.items() if w in {"w1", "w2", "w3", "w9"}} for t, v in whole.items()}
    assert left == {t: v for t, v in expected.items() if v}
