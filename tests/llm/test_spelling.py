import random
import re
import zlib
from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from precedent.llm import spelling
from precedent.llm.common import Tables

LETTERS = "abé"


def edits(word, alphabet):
    found = {word[:i] + word[i + 1 :] for i in range(len(word))}
    found |= {word[:i] + c + word[i + k :] for i in range(len(word) + 1) for c in alphabet for k in (0, 1)}
    return found - {word}


@settings(max_examples=300, deadline=None)
@given(
    st.text(LETTERS, min_size=5, max_size=14),
    st.sets(st.text(LETTERS, min_size=2, max_size=4), max_size=25),
    st.integers(0, 10_000),
)
def test_near_words_share_a_key(word, chosen, at):
    # Any dictionary that holds the prefixes of its grams, some with the marks.
    chosen |= {"^" + g for g in list(chosen)[:4]} | {g + "$" for g in list(chosen)[:4]}
    listed = {g[:k] for g in chosen for k in range(3, len(g) + 1)}
    grams = spelling.Grams(listed)
    others = sorted(edits(word, LETTERS))
    other = others[at % len(others)]
    short, long = sorted((word, other), key=len)
    asked = grams.keys(short)[0] if len(short) == len(long) else grams.keys(short)[1]
    assert set(asked) & set(grams.keys(long)[0])


def brute(rows):
    counts = Counter()
    lower = {c: c + 32 for c in range(65, 91)}
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            word = run.translate(lower)
            crc = zlib.crc32(f"{'' if doc_id is None else doc_id}:{word}".encode())
            if crc % 97 == 0:
                word = word[: crc % len(word)] + word[crc % len(word) + 1 :]
            counts[word] += 1
    words = {w: n for w, n in counts.items() if len(w) >= 5 and n >= 3}
    alphabet = {c for w in words for c in w}
    form, found = {}, []
    near = {w: [v for v in edits(w, alphabet) if v in words] for w in words}
    for w, n in words.items():
        best = min(near[w], key=lambda v: (-words[v], v), default=None)
        form[w] = best if best is not None and words[best] >= 2 * n else None
    for w, n in words.items():
        root = w
        while form[root] is not None:
            root = form[root]
        found.append((w, form[w], root, n, len(near[w]), words[form[w]] if form[w] else None))
    return sorted(map(str, found))


@pytest.mark.parametrize("seed", range(2))
def test_variants_equal_brute_force(spark, seed):
    rng = random.Random(seed)
    stems = ["".join(rng.choices("abcdeÀÿ×ß", k=rng.randint(4, 9))) for _ in range(60)]
    rows = [(None, None), (1, ""), (2, "Ünder 12 !"), (3, "abcde " * 50 + "z" * 3000 + " " + "z" * 3001)]
    for i in range(400):
        words = []
        for _ in range(rng.randint(0, 40)):
            w = rng.choice(stems[: rng.randint(1, 60)])
            words.append(rng.choice(sorted(edits(w, "ae"))) if rng.random() < 0.3 else rng.choice([w, w.upper()]))
        rows.append((rng.choice([i, 5, None]), rng.choice([" ", "-", "\n", "7"]).join(words)))
    rows += [(9, "z" * 3000 + "." + "z" * 3001)] * 4
    docs = spark.createDataFrame([(*r, "clash") for r in rows], "doc_id long, text string, word string")
    found = [tuple(r) for r in spelling.spelling_variants(docs).collect()]
    assert sorted(map(str, found)) == brute(rows)
    assert sum(r[1] is not None for r in found) > 20


@pytest.mark.parametrize("longest", [2, 3, 5])
def test_any_gram_length_finds_the_same_pairs(spark, longest):
    rng = random.Random(longest)
    words = sorted({"".join(rng.choices("abc", k=rng.randint(5, 9))) for _ in range(300)})
    tables = Tables(spark, "spelling-test")
    stored = tables.store(spark.createDataFrame([(w, 3) for w in words], "word string, n long"), "words")
    found = [tuple(sorted((r.word, r.other))) for r in spelling.near_words(stored, tables, 40, longest).collect()]
    assert len(found) == len(set(found))
    assert set(found) == {tuple(sorted((w, v))) for w in words for v in edits(w, "abc") if v in set(words)}


def test_the_dictionary_is_bounded_and_holds_prefixes(spark):
    rng = random.Random(1)
    words = spark.createDataFrame([("".join(rng.choices("abcdef", k=8)), 3) for _ in range(500)], "word string, n long")
    listed = spelling.gram_dictionary(words, 50, 5)
    assert all(len(g) == 3 or g[:-1] in listed for g in listed)
    assert all(sum(len(g) == q for g in listed) <= 50 for q in (3, 4, 5))


def test_empty_table(spark):
    found = spelling.spelling_variants(spark.createDataFrame([], "doc_id long, text string"))
    assert found.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    assert found.count() == 0
