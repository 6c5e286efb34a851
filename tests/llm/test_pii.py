import hashlib
import random
import re

from precedent.llm import pii


def luhn(digits):
    total = 0
    for i, d in enumerate(reversed(digits)):
        v = int(d) * (1 + i % 2)
        total += v - 9 if v > 9 else v
    return total % 10 == 0


def brute(text):
    text = text or ""
    out = [(0, m.start(), m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(x) <= 255 for x in m[0].split(".")):
            out.append((1, m.start(), m.end()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = re.sub("[ -]", "", m[0])
        if 13 <= len(digits) <= 19 and luhn(digits):
            out.append((2, m.start(), m.end()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 9 <= len(re.sub("[^0-9]", "", m[0])) <= 15:
            out.append((3, m.start(), m.end()))
    return sorted(out)


PARTS = ["a.b@c-d.ex", "34@mail7.example.com", "x@y", "@", "1.2.3.4", "300.1.1.1", "1.2.3.4.5.6.7.8", "4111 1111 1111 1111", "4111111111111112",
         "+1 (017) 555-7713", "+49 12", "word", "é", "🙂", " ", " ", "\n", "-", ".", "+", "(", "5", "12", "tel", "555-7713", "(017)"]


def test_base_spans_equal_brute_force(spark):
    rng = random.Random(12)
    texts = [None, "", "5" * 20_000, "1." * 3000 + " end", "1.2.3.4@a.b", "+1" * 40]
    texts += ["".join(rng.choices(PARTS, k=rng.randint(1, 40))) for _ in range(500)]
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, spans string")
    rows = pii.find_pii(docs).collect()
    assert len(rows) == len(texts)
    for r in rows:
        expected = brute(texts[r.doc_id])
        written = [f"{pii.KINDS[k]}:{a}:{b}" for k, a, b in expected]
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(sum(k == j for k, *_ in expected) for j in range(4)), texts[r.doc_id]
        assert r.base_sha256 == hashlib.sha256(",".join(written).encode()).hexdigest()
        assert set(written) <= set(r.spans.split(",")) | {""}
    assert pii.find_pii(docs.limit(0)).count() == 0


def test_viterbi_equals_brute_force():
    import itertools

    import numpy as np

    rng = np.random.default_rng(0)
    crf = pii.Crf(["a", "b", "c"])
    crf.unary[:] = rng.normal(size=crf.unary.shape)
    crf.pair[:] = rng.normal(size=crf.pair.shape)
    runs = [list(rng.choice(["a", "b", "c", "new"], k)) for k in (1, 2, 3, 4, 1)]
    for run, labels in zip(runs, crf.decode(runs)):
        ids, _ = crf._ids([run])
        score = crf._scores(ids)[0]

        def value(path, score=score):
            return sum(score[t, k] for t, k in enumerate(path)) + sum(crf.pair[i, j] for i, j in zip(path, path[1:]))

        best = max(itertools.product(range(5), repeat=len(run)), key=value)
        assert list(best) == labels


def test_crf_learns_numbers_without_country_code(spark):
    rng = random.Random(13)
    texts = [f"call +1 ({rng.randint(100, 999)}) 555-{rng.randint(1000, 9999)} or write 12 times in {rng.randint(1900, 2030)}" for _ in range(200)]
    texts += ["call (017) 555-7713 now", "in 1999 there were 12"]
    rows = {r.doc_id: r for r in pii.find_pii(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    assert rows[200].spans == "phone:5:19" and rows[200].n_phone == 0
    assert rows[201].spans == ""


def test_long_runs_are_decoded_in_little_memory(monkeypatch):
    import tracemalloc

    import numpy as np

    rng = np.random.default_rng(1)
    crf = pii.Crf(["a", "b", "c"])
    crf.unary[:] = rng.normal(size=crf.unary.shape)
    crf.pair[:] = rng.normal(size=crf.pair.shape)
    runs = [["a", "b"]] * 1000 + [list(rng.choice(["a", "b", "c"], 5000))]
    tracemalloc.start()
    found = crf.decode(runs)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 50e6  # padded to the longest run, one array of scores is 200 MB
    monkeypatch.setattr(pii, "SCORE_CELLS", 7)
    monkeypatch.setattr(pii, "BLOCK_CELLS", 50)
    assert crf.decode(runs) == found
    assert all(len(x) == len(y) for x, y in zip(found, runs))
