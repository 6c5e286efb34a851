import math

import numpy as np
import pyarrow as pa
import pytest

from precedent.llm import language
from precedent.llm.common import fold

EN = "the of and with from that this have been water house never alone"
DE = "der die und mit von dass dieses haben wurde wasser haus niemals allein"


@pytest.fixture(scope="module")
def docs(spark):
    rng = np.random.default_rng(0)
    rows = []
    for i in range(60):
        words = (EN if i % 2 else DE).split()
        rows.append((i, " ".join(rng.choice(words, 12)), "en" if i % 2 else "de", "x"))
    rows += [(100, None, "en", "x"), (101, "", "de", "x"), (102, "12 -- 34", "en", "x"), (103, "The HOUSE, never!", None, "x")]
    rows += [(104, "wasserhaus dieser niemand", None, "x"), (104, "wasserhaus dieser niemand", None, "x"), (None, "the water", "en", "x")]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, score string")


def test_predictions(docs):
    rows = language.language_rows(docs).collect()
    assert len(rows) == docs.count()
    for r in rows:
        assert r.held_out == (fold(r.doc_id) == 1) and 0 <= r.score <= 1
        if r.doc_id is not None and r.doc_id < 60:
            assert r.lang_pred == ("en" if r.doc_id % 2 else "de")
    by = {r.doc_id: (r.lang_pred, r.score) for r in rows}
    assert by[100] == by[101] == by[102] == ("und", 0.0)
    assert by[103][0] == by[None][0] == "en" and by[104][0] == "de"


def test_counts_equal_brute_force(docs):
    found = {(r.kind, r.lang, r.item): r.n for r in language.count_items(docs.where("lang is not null")).collect()}
    expected = {}
    for r in docs.where("lang is not null").collect():
        for piece in (r.text or "").split():
            if word := language.normal_form(piece):
                keys = [(0, r.lang, word)] + [(k, r.lang, g) for k in language.GRAM_SIZES for g in language.grams(word, k)]
                for key in keys:
                    expected[key] = expected.get(key, 0) + 1
    assert found == expected


def test_backoff_uses_the_longest_known_grams():
    one = np.array([10, 10])
    model = language.LanguageModel(["a", "b"], {k: one for k in (0, 4, 3, 2, 1)}, {0: {"known": [5, 0]}, 4: {"_unk": [0, 5]}, 3: {"unk": [5, 0], "xyz": [5, 0]}, 2: {}, 1: {}})
    assert model.word("known").argmax() == 0
    assert model.word("unknown").argmax() == 1  # its 4-gram wins over its 3-gram
    assert model.word("xyz").argmax() == 0
    assert not model.word("qqq").any()


def test_nothing_to_learn_from(docs):
    assert {r.lang_pred for r in language.with_language(docs, language.train(docs.limit(0))).collect()} == {"und"}
    assert language.language_rows(docs.limit(0)).count() == 0


def brute_model(rows):
    """Log frequencies per kind, item and language, straight from the definition."""
    langs = sorted({lang for _, lang in rows})
    counts = {kind: {} for kind in (0, *language.GRAM_SIZES)}
    for text, lang in rows:
        for piece in (text or "").split():
            if word := language.normal_form(piece):
                for kind in counts:
                    for item in [word] if kind == 0 else language.grams(word, kind):
                        counts[kind].setdefault(item, dict.fromkeys(langs, 0))[lang] += 1
    logs = {}
    for kind, table in counts.items():
        total = {lang: sum(c[lang] for c in table.values()) for lang in langs}
        for item, c in table.items():
            logs[kind, item] = [math.log((c[lang] + 0.5) / (total[lang] + 0.5 * (len(table) + 1))) for lang in langs]
    return langs, logs


def brute_prediction(text, langs, logs):
    sums, letters = [0.0] * len(langs), False
    for piece in (text or "").split():
        letters |= any(c.isalpha() for c in piece)
        word = language.normal_form(piece)
        found = [logs[0, word]] if (0, word) in logs else []
        for size in language.GRAM_SIZES:
            if not found and word:
                found = [logs[size, g] for g in language.grams(word, size) if (size, g) in logs]
        if found:
            mean = [sum(x) / len(found) for x in zip(*found)]
            sums = [s + m - sum(mean) / len(mean) for s, m in zip(sums, mean)]
    if not letters:
        return "und", 0.0
    best = max(range(len(langs)), key=lambda i: (sums[i], -i))
    return langs[best], 1 / sum(math.exp(max(s - sums[best], -50)) for s in sums)


def random_docs(spark, n=160):
    rng = np.random.default_rng(7)
    vocabulary = {"aa": "alpha beta gamma delta été x", "bb": "alphabet betting gamut über y", "ça": "ξένος λόγος και alpha"}
    rows = []
    for i in range(n):
        lang = ["aa", "bb", "ça"][i % 3]
        words = list(rng.choice(vocabulary[lang].split(), rng.integers(0, 9)))
        words += ["".join(rng.choice(list("abgdeλξü1-"), rng.integers(1, 7))) for _ in range(rng.integers(0, 4))]
        rows.append((i, " ".join(words), lang if rng.random() < 0.9 else None, "x"))
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, score string"), rows


def test_predictions_and_scores_equal_brute_force(spark):
    table, rows = random_docs(spark)
    langs, logs = brute_model([(t, lang) for i, t, lang, _ in rows if lang is not None and fold(i) != 1])
    found = {r.doc_id: r for r in language.language_rows(table).collect()}
    assert len(found) == len(rows)
    for i, text, _, _ in rows:
        lang, score = brute_prediction(text, langs, logs)
        assert found[i].score == pytest.approx(score, abs=1e-9)
        assert found[i].lang_pred == lang or score < 0.5 + 1e-9


def test_each_language_has_a_bound_of_its_own(spark):
    rows = [(i, f"wort{i} " * 10, "de") for i in range(2000)] + [(i, "ξένος λόγος", "el") for i in range(9000, 9005)]
    table = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    sample = language.training_sample(table, 20_000)
    sizes = {r.lang: r.n for r in sample.groupBy("lang").agg({"text": "count"}).withColumnRenamed("count(text)", "n").collect()}
    assert sizes["el"] == 5 and 120 < sizes["de"] < 450
    assert sorted(sample.collect()) == sorted(language.training_sample(table.repartition(7), 20_000).collect())
    model = language.train(table, 20_000)
    assert model.langs == ["de", "el"] and model.word("λόγος").argmax() == 1


def test_scores_of_words_are_summed_in_runs_of_bounded_size(monkeypatch):
    """The same answers as for all texts at once, with no more than a bounded number of scores side by side."""
    rng = np.random.default_rng(5)
    items = {0: {"house": [9, 1], "haus": [1, 9], "und": [2, 8]}, 1: {"h": [3, 2], "u": [1, 4]}}
    model = language.LanguageModel(["de", "en"], {k: np.array([20.0, 20.0]) for k in (0, 1, 2, 3, 4)}, items)
    pool = ["house", "haus", "und", "uh", "12", "--"]
    texts = [" ".join(rng.choice(pool, rng.integers(0, 9))) for _ in range(300)] + [None, "", " ".join(pool * 20), "haus", "", None]
    texts = pa.array(texts, pa.string())
    alone = [model.predict(texts.slice(i, 1)) for i in range(len(texts))]
    most, stacked = [], np.vstack

    def watched(parts):
        most.append(len(parts[0]))
        return stacked(parts)

    monkeypatch.setattr(language, "MOST_PIECES", 40, raising=False)
    monkeypatch.setattr(np, "vstack", watched)
    names, scores = model.predict(texts)
    assert names == [n for found, _ in alone for n in found] and scores == [s for _, found in alone for s in found]
    assert len(most) > 20 and sorted(most)[-2] <= 40 and max(most) == 120
