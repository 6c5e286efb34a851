import random

import numpy as np
import pyarrow as pa

from precedent.llm import decontaminate as dc


def grams(text):
    words = (text or "").lower().split()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def brute(docs, items):
    out = set()
    for d, text in docs:
        own = grams(text)
        for i, item in items:
            q = grams(item)
            common = len(q & own)
            if q and common and 100 * common >= 75 * len(q):
                out.add((d, i, common, len(q)))
    return out


def corpus():
    rng = random.Random(9)
    vocabulary = [f"w{i}" for i in range(3000)]
    items = [(i, " ".join(rng.choices(vocabulary, k=rng.randint(5, 90)))) for i in range(60)]
    items += [(60, "three short words"), (61, ""), (62, None), (63, items[3][1])]
    docs = []
    for d in range(150):
        words = rng.choices(vocabulary, k=rng.choice([0, 3, 40, 400, 3000]))
        for _ in range(rng.randint(0, 2)):
            item = (rng.choice(items)[1] or "x").split(" ")
            for _ in range(rng.randint(0, 3)):
                item[rng.randrange(len(item))] = rng.choice(vocabulary)
            at = rng.randint(0, len(words))
            words[at:at] = item
        docs.append((d, " ".join(words)))
    return docs + [(900, None), (901, "Three  short\nwords"), (5, docs[4][1]), (None, "no " + items[0][1])], items


def test_items_equal_brute_force(spark, monkeypatch):
    docs, items = corpus()
    for block in (20_000, 20):
        monkeypatch.setattr(dc, "ITEMS_AT_ONCE", block)
        one = spark.createDataFrame([(d, t, 1) for d, t in docs], "doc_id long, text string, item_id int")
        two = spark.createDataFrame(items, "item_id long, text string")
        found = [tuple(r) for r in dc.contained_items(one, two).collect()]
        assert set(found) == brute(docs, items)
        hit = {d for d, *_ in brute(docs, items)}
        assert {r.doc_id for r in dc.contaminated_documents(one, two).collect()} == hit
        kept = [(r.doc_id, r.text) for r in dc.decontaminate(one, two).collect()]
        key = lambda r: (r[0] is None, r[0] or 0, r[1] or "")
        assert sorted(kept, key=key) == sorted((r for r in docs if not brute([r], items)), key=key)


def test_nothing(spark):
    docs = spark.createDataFrame([(1, "a b c d e f")], "doc_id long, text string")
    items = spark.createDataFrame([], "item_id long, text string")
    assert dc.contaminated_documents(docs, items).count() == 0
    assert dc.decontaminate(docs, items).count() == 1
    assert dc.contaminated_documents(docs.limit(0), docs.withColumnRenamed("doc_id", "item_id")).count() == 0


def test_windows_reach_the_similarity():
    """Items anywhere in a long text are candidates, without help from the exact check."""
    rng = np.random.default_rng(3)
    words = [f"u{i}" for i in range(50_000)]
    items = [(i, " ".join(rng.choice(words, rng.integers(12, 80)))) for i in range(100)]
    text = []
    for _, item in items:
        text += list(rng.choice(words, rng.integers(0, 300))) + item.split(" ")
    index = dc.ItemIndex(items)
    found = index.search(dc.Shingler().sequences(pa.array([" ".join(text)])))
    assert {index.items[i][0] for _, i, *_ in found} == set(range(100))
    assert (1 - dc.least_similarity()) ** dc.HASHES < 1e-5
