import random
from hashlib import sha256

import pytest

from precedent.llm import merkle

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, _row int, digest string"


def h(*parts):
    return sha256("".join(parts).encode()).hexdigest()


def leaf(row):
    doc_id, text, lang, source, n_chars = row[:5]
    values = [doc_id, source, lang, n_chars, text]
    return h(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def climb(digests):
    """The root, and the siblings (before, after) of every digest per level."""
    proofs = [[] for _ in digests]
    members = [[i] for i in range(len(digests))]
    while len(digests) > 1:
        upper, joined = [], []
        for at in range(0, len(digests), 3):
            run = digests[at : at + 3]
            for k in range(len(run)):
                for i in members[at + k]:
                    proofs[i].append(("".join(run[:k]), "".join(run[k + 1 :])))
            upper.append(h(*run))
            joined.append([i for m in members[at : at + 3] for i in m])
        digests, members = upper, joined
    return digests[0], proofs


def brute(rows):
    from zlib import crc32

    order = sorted(rows, key=lambda r: (r[3] is not None, (r[3] or "").encode(), r[0] is not None, r[0] or 0, leaf(r)))
    sources = list(dict.fromkeys(r[3] for r in order))
    trees = {s: climb([leaf(r) for r in order if r[3] == s]) for s in sources}
    root, upper = climb([trees[s][0] for s in sources])
    found = []
    for s, steps_above in zip(sources, upper):
        for r, steps in zip([r for r in order if r[3] == s], trees[s][1]):
            steps = steps + steps_above
            changed = r
            if crc32(b"" if r[0] is None else str(r[0]).encode()) % 2 == 0 and r[1] is not None:
                changed = (r[0], r[1].replace("\n", ""), *r[2:])
            folded = leaf(changed)
            for before, after in steps:
                folded = h(before, folded, after)
            found.append((r[0], leaf(r), trees[s][0], root, h(*(a + b for a, b in steps)), folded, folded == root))
    return sorted(map(str, found))


def table(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


@pytest.mark.parametrize("sizes", [(1,), (2, 1), (3, 4, 9), (28, 1, 10, 27, 81), (800, 2, 3, 1)])
def test_audit_equals_brute_force(spark, sizes):
    rng = random.Random(sum(sizes))
    names = [None, "", "b", "a", "é"]
    texts = [None, "", "line\nline", "\n", "no feed", "🙂\nü"]
    ids = rng.sample(range(10_000), sum(sizes))
    rows = [
        (ids.pop(), rng.choice(texts), rng.choice([None, "de"]), name, rng.choice([None, 0, 12]), 1, "clash")
        for name, n in zip(names, sizes)
        for _ in range(n)
    ]
    rng.shuffle(rows)
    found = merkle.audit(table(spark, rows).repartition(3)).collect()
    assert sorted(str(tuple(r)) for r in found) == brute(rows)


def test_repeated_and_null_ids(spark):
    rows = [(7, "a\nb", "en", "s", 3, 0, "")] * 20 + [(7, "other", "en", "s", 5, 0, "")] * 3 + [(None, "x\ny", None, "s", None, 0, "")] * 5
    found = merkle.audit(table(spark, rows)).collect()
    assert sorted(str(tuple(r)) for r in found) == brute(rows)


def test_untampered_rows_verify_and_others_do_not(spark):
    rows = [(i, "two\nlines", "en", "s", 9, 0, "") for i in range(100)]
    docs = table(spark, rows)
    changed = {r.doc_id for r in docs.where(merkle.tampered(docs).isNotNull()).collect()}
    found = {r.doc_id: r.verified for r in merkle.audit(docs).collect()}
    assert 0 < len(changed) < 100
    assert {i for i, ok in found.items() if not ok} == changed


def test_empty_table(spark):
    found = merkle.audit(table(spark, []))
    assert found.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    assert found.count() == 0
