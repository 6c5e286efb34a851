import random

import numpy as np
import pyarrow as pa
import pytest

from precedent.llm import ngram_join
from precedent.llm.components import connected_components


def shingles(text):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = [w for w in "".join(" " if c in "\t\n\x0b\x0c\r" else c for c in lowered).split(" ") if w]
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4)))


def brute(rows):
    sets = [shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            inter = len(sets[i] & sets[j])
            if inter and 100 * inter >= 75 * (len(sets[i]) + len(sets[j]) - inter):
                root[find(i)] = find(j)
    least = {}
    for i, (k, _) in enumerate(rows):
        if k is not None:
            least[find(i)] = min(k, least.get(find(i), k))
    return sorted((k if k is not None else -1, len(s), least.get(find(i), -1)) for i, ((k, _), s) in enumerate(zip(rows, sets)))


def corpus(seed, n):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    line = " ".join(rng.choices(vocabulary, k=14))
    passage = " ".join(rng.choices(vocabulary, k=60))
    base = rng.choices(vocabulary, k=90)
    texts = []
    for i in range(n):
        kind = i % 6
        words = rng.choices(vocabulary, k=rng.choice([3, 8, 30, 90, 200]))
        if kind == 0 and texts:
            words = (rng.choice(texts) or "").split(" ")
            for _ in range(rng.randint(0, 4)):
                words[rng.randrange(len(words))] = rng.choice(vocabulary)
        elif kind == 1:
            words = list(base)
            for _ in range(rng.randint(0, 3)):
                words[rng.randrange(len(words))] = rng.choice(vocabulary)
        elif kind == 2:
            words = [line, *words]
        elif kind == 3:
            words = [passage, *words[: rng.randint(0, 12)]]
        texts.append(" ".join(words))
    return texts


@pytest.mark.parametrize(("seed", "n", "most", "spare"), [(1, 260, 24, 32), (2, 200, 2, 4), (3, 200, 3, 0)])
def test_components_equal_brute_force(spark, monkeypatch, seed, n, most, spare):
    monkeypatch.setattr(ngram_join, "MOST_SHARED", most)
    monkeypatch.setattr(ngram_join, "SPARE", spare)
    monkeypatch.setattr(ngram_join, "HOT_LEAST", 6)
    texts = corpus(seed, n) + [None, "", " \n ", "One two", "one\ttwo", "one  two three", "Ünique Ä", "ünique ä"]
    rows = [(1000 - i, t) for i, t in enumerate(texts)]
    rows += [(5, rows[3][1]), (5, rows[3][1]), (5, rows[9][1]), (None, rows[11][1]), (None, "only without an id")]
    docs = spark.createDataFrame([(k, t, "x") for k, t in rows], "doc_id long, text string, component_id string")
    found = ngram_join.similar_documents(docs.repartition(3)).collect()
    key = lambda v: -1 if v is None else v
    assert sorted((key(r.doc_id), r.n_shingles, key(r.component_id)) for r in found) == brute(rows)


def test_nothing(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert ngram_join.similar_documents(docs).count() == 0


def test_long_text(spark):
    words = [f"v{i}" for i in range(60_000)]
    docs = spark.createDataFrame([(2, " ".join(words)), (1, " ".join(words[3000:])), (3, " ".join(words[30_000:]))], "doc_id long, text string")
    found = {r.doc_id: r.component_id for r in ngram_join.similar_documents(docs).collect()}
    assert found == {1: 1, 2: 1, 3: 3}


def test_sets_are_those_of_the_words():
    rng = random.Random(7)
    texts = ["".join(rng.choices(["a", "B", "é", " ", "  ", "\n", "\x0b", "\xa0", "x"], k=rng.randint(0, 60))) for _ in range(200)]
    found = ngram_join.Shingler().sets(pa.array(texts))
    named = {}
    for text, s in zip(texts, found):
        own = shingles(text)
        assert len(own) == len(s)
        assert named.setdefault(own, s.tobytes()) == s.tobytes()
    assert len(set(named.values())) == len(named)


def test_grown_prefix():
    head = np.arange(20)
    plain = ngram_join.shortest(40)
    assert ngram_join.grown_prefix(head, 40, np.zeros(20, bool)) == (plain, 1)
    costly = np.zeros(20, bool)
    costly[[0, 3, plain]] = True
    assert ngram_join.grown_prefix(head, 40, costly) == (plain + 3, 4)
    assert ngram_join.grown_prefix(head, 40, np.ones(20, bool)) == (20, 20 - plain + 1)


def test_connected_components(spark):
    rng = random.Random(8)
    links = [(i, i + 1) for i in range(100, 160)] + [(0, i) for i in range(1, 50)]
    links += [(rng.randrange(200, 300), rng.randrange(200, 300)) for _ in range(60)] + [(7, 7)]
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in links:
        if a != b:
            a, b = sorted((find(a), find(b)))
            root[b] = a
    found = {r.node: r.label for r in connected_components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert found == {x: find(x) for x in root}
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_node_column_cuts_its_batches(spark, monkeypatch):
    """Nodes are those of whole sets, and no slice of words is larger than its bound, whatever the batch."""
    rng = random.Random(12)
    texts = [" ".join(rng.choice("abcdefgh") * rng.randrange(1, 9) for _ in range(rng.randrange(0, 30))) for _ in range(60)] + [None, "", " \t"]
    sizes, sets = [], ngram_join.Shingler.sets

    def watched(self, part):
        sizes.append(sum(len(t or "") for t in part.to_pylist()))
        return sets(self, part)

    expected = [ngram_join.node_of(s) if len(s) else None for s in sets(ngram_join.Shingler(), pa.array(texts))]
    monkeypatch.setattr(ngram_join.Shingler, "sets", watched)
    monkeypatch.setattr(ngram_join, "SLICE_BYTES", 500)
    found = ngram_join.node_column.func(pa.array(texts))
    assert pa.array(found).to_pylist() == expected
    assert len(sizes) > 5 and max(sizes) <= 500
    monkeypatch.undo()
    rows = spark.createDataFrame([(t,) for t in texts], "text string").select("text", ngram_join.node_column("text").alias("node")).collect()
    assert [(r.text, r.node) for r in rows] == list(zip(texts, expected))


def test_remembered_words_are_bounded_and_change_no_hash(monkeypatch):
    texts = pa.array([" ".join(f"w{i}" for i in range(150_000))])
    shingler = ngram_join.Shingler()
    expected = shingler.sets(texts)[0]
    assert len(shingler.known) <= 100_000
    monkeypatch.setattr(ngram_join, "KNOWN_WORDS", 50)
    assert np.array_equal(ngram_join.Shingler().sets(texts)[0], expected)


def test_few_words_are_remembered_and_sets_are_sorted():
    texts = pa.array([" ".join(f"w{i % 40_000}" for i in range(60_000)), None, "a b c d e a b c d e"])
    shingler = ngram_join.Shingler()
    sets, again = shingler.sets(texts), shingler.sets(texts)
    assert len(shingler.known) <= 10_000
    assert [len(s) for s in sets] == [40_000, 0, 5]
    for one, two, sequence in zip(sets, again, shingler.sequences(texts)):
        assert np.array_equal(one, two) and np.array_equal(one, np.unique(sequence))
