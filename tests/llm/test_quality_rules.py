import random
import re
import unicodedata

from precedent.llm import quality_rules


def brute(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    grams = {}
    for i in range(len(words) - 4):
        grams.setdefault(tuple(words[i : i + 5]), []).append(i)
    covered = {i + k for at in grams.values() if len(at) > 1 for i in at for k in range(5)}
    failed = len(words) < 10 or 100 * len(covered) > 20 * len(words)
    return (
        len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered), failed
    )


def test_base_counts_equal_brute_force(spark):
    rng = random.Random(4)
    vocabulary = ["a", "b", "c#", "d|", "é🙂", "x\n", "\n", "\t", "The end.\n", " ", "\x0b", "\xa0"]
    texts = [None, "", " \n ", "one", "a b c d e " * 300, "x " * 4, "same line here\n" * 3]
    texts += [" ".join(rng.choices(vocabulary, k=rng.randint(1, 120))) for _ in range(200)]
    docs = spark.createDataFrame([(i, t, -1) for i, t in enumerate(texts)], "doc_id long, text string, n_words int")
    found = quality_rules.quality_columns(docs).collect()
    assert len(found) == len(texts)
    for r in found:
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == brute(texts[r.doc_id])
        assert not (r.base_failed and r.kept)
    assert quality_rules.quality_columns(docs.limit(0)).count() == 0


def test_lines_are_judged_one_by_one(spark):
    prose = "This is a plain sentence of some length that ends as it should."
    bad = [
        "Home | News | About | Contact | Help",
        "Licensed under CC BY-NC 4.0.",
        "words### with*** symbols$$$ after%%% each&&& one### here***.",
        "BUY NOW WHILE STOCK LASTS AND SAVE!! BUY NOW!!",
        "a long line of many words that never comes to an end of any kind at",
    ]
    texts = [prose, *bad, "\n".join([prose + " Twice."] + bad[:2]), "\n".join([prose] + bad)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = {r.doc_id: r for r in quality_rules.quality_columns(docs).collect()}
    assert rows[0].kept and rows[0].clean_text == prose
    assert all(rows[i].clean_text == "" for i in range(1, 6))
    assert rows[6].kept and rows[6].clean_text == prose + " Twice."
    assert not rows[7].kept and rows[7].clean_text == prose


def line_fails(line):
    upper, lower = (sum(unicodedata.category(c) == k for c in line) for k in ("Lu", "Ll"))
    gaps = sum(c in " \t" for c in line) + 1
    separators = len(re.findall(r"[ \t\n\x0b\f\r][|»›·•][ \t\n\x0b\f\r]", line))
    return (
        sum(c in "#*$%&|<>" for c in line) * 5 > gaps * 2
        or separators >= 2
        or re.search(quality_rules.BOILERPLATE.replace(r"\s", r"[ \t\n\x0b\f\r]"), line, re.A) is not None
        or (upper > 20 and upper > 2 * lower)
        or (gaps >= 8 and re.search(quality_rules.SENTENCE_END.replace(r"\s", r"[ \t\n\x0b\f\r]"), line) is None)
    )


def test_kept_equals_brute_force(spark):
    rng = random.Random(11)
    lines = [
        "All of these words make one plain sentence, and it ends.",
        "This long line of many words never comes to any end at all",
        "Home | News | About",
        "LOUD WORDS AND MORE LOUD WORDS EVERYWHERE",
        "copyright 2020 by some people",
        "a # b ## c ###",
        "Heading",
        "Ein Satz mit Ümlauten und » Zeichen « darin.",
        "",
        "   ",
    ]
    texts = ["\n".join(rng.choices(lines, k=rng.randint(0, 12))) for _ in range(250)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    verdicts = set()
    for r in quality_rules.quality_columns(docs).collect():
        worded = [x for x in texts[r.doc_id].split("\n") if x.strip(" \t")]
        good = "\n".join(x for x in worded if not line_fails(x))
        before = len("\n".join(worded))
        lost = 1 - len(good) / before if before else 0.0
        assert r.clean_text == good
        assert r.kept == (not brute(texts[r.doc_id])[-1] and lost <= 0.5)
        verdicts.add((r.base_failed, r.kept))
    assert verdicts == {(True, False), (False, True), (False, False)}


def test_helper_names_and_other_cases_do_not_clash(spark):
    names = ["_lines", "_hashes", "_GOOD", "_windows", "_keyed", "_before", "_before_", "a.b", "Kept", "N_WORDS"]
    row = (1, "One two three four five six seven eight nine ten.", *range(len(names)))
    schema = "doc_id long, text string, " + ", ".join(f"`{n}` int" for n in names)
    found = quality_rules.quality_columns(spark.createDataFrame([row], schema))
    assert found.columns[:10] == ["doc_id", "text", *names[:8]]
    out = found.collect()[0]
    assert (out["n_words"], out["kept"], out["a.b"], out["_GOOD"]) == (10, True, 7, 2)
