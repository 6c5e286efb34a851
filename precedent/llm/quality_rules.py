"""Line-first cleaning with native column expressions.

Every line is judged alone: does any sentence end in it, is it a navigation row, a boilerplate
notice, a run of symbols, or shouting? Failing lines are removed, and a document is rejected if too much of
it is gone, or by the base rules (too few words, too many words in repeated 5-word windows).

Edge cases: a null or blank text has no words and fails the base rule; a repeated line stays but
is counted; columns of the input that carry a name of the result (in any case) are replaced, all
others stay.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from precedent.llm.common import others, spare_names

SPACE = r"[\x20\x09-\x0D]+"
NON_SPACE = r"[^\x20\x09-\x0D]"
SYMBOLS = "#*$%&|<>"
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
#: A document is rejected if its failing lines hold more than this share of its characters.
MAX_LOST = 0.5
# Characters that may end a sentence, notices, and separators of menus.
SENTENCE_END = r"""[.!?:;…。！？]["'»”’)\]]*(\s|$)"""
BOILERPLATE = (
    r"(?i)^\s*(licensed under|all rights reserved|copyright|©|terms of (use|service)"
    r"|privacy policy|cookie|subscribe to|sign up|log ?in\b|share (this|on)|read more|click here)"
)
SEPARATOR = r"\s[|»›·•]\s"
#: Lines of fewer words may lack the end of a sentence (headings).
HEADING_WORDS = 8


def words(text: Column) -> Column:
    return F.filter(F.split(F.coalesce(text, F.lit("")), SPACE), lambda w: w != "")


def _count(text: Column, characters: str) -> Column:
    """How often any of ``characters`` occurs."""
    return F.length(text) - F.length(F.translate(text, characters, ""))


def line_fails(line: Column) -> Column:
    """Whether one line is removed."""
    length = F.length(line)
    gaps = _count(line, " \t") + 1
    symbols = _count(line, SYMBOLS)
    upper = length - F.length(F.regexp_replace(line, r"\p{Lu}", ""))
    lower = length - F.length(F.regexp_replace(line, r"\p{Ll}", ""))
    return (
        (symbols * 5 > gaps * 2)
        | line.rlike(SEPARATOR + ".*" + SEPARATOR)
        | line.rlike(BOILERPLATE)
        | ((upper > 20) & (upper > 2 * lower))
        | ((gaps >= HEADING_WORDS) & ~line.rlike(SENTENCE_END))
    )


def _keyed_windows(windows: Column) -> Column:
    """(hash, place) of every window sorted by hash; empty if no window repeats, as in almost
    every document."""
    keyed = F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i")))
    repeats = F.size(F.array_distinct(windows)) < F.size(windows)
    return F.when(repeats, F.sort_array(keyed)).otherwise(F.slice(keyed, 1, 0))


def _repeat_starts(keyed: Column) -> Column:
    """Places of the windows that occur twice or more, ascending. ``keyed`` must be a column of
    its own: an expression would be computed again for each of its elements."""

    def flagged(x: Column, k: Column) -> Column:
        before = (k > 0) & (F.get(keyed, k - 1)["h"] == x["h"])
        after = F.coalesce(F.get(keyed, k + 1)["h"] == x["h"], F.lit(False))
        return F.struct(x["i"].alias("i"), (before | after).alias("twice"))

    twice = F.filter(F.transform(keyed, flagged), lambda x: x["twice"])
    return F.sort_array(F.transform(twice, lambda x: x["i"]))


def _covered_words(starts: Column) -> Column:
    """Words inside the 5-word windows that begin at ``starts``."""
    return F.aggregate(
        starts,
        F.struct(F.lit(-5).alias("at"), F.lit(0).alias("n")),
        lambda acc, at: F.struct(at.alias("at"), (acc["n"] + F.least(F.lit(5), at - acc["at"])).alias("n")),
        lambda acc: acc["n"],
    )


def quality_columns(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
    clean_text, lost_share and kept."""
    whole = F.coalesce(F.col(text), F.lit(""))
    added = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
             "base_failed", "clean_text", "lost_share", "kept"]
    kept = others(docs, added)
    hashed, line_list, windows, good, keyed, before = spare_names(docs, ["_hashes", "_lines", "_windows", "_good", "_keyed", "_before"])
    lines = F.filter(F.split(whole, "\n"), lambda line: line.rlike(NON_SPACE))
    step = docs.select(
        *kept,
        F.transform(words(F.col(text)), lambda w: F.xxhash64(w)).alias(hashed),
        lines.alias(line_list),
        F.length(F.translate(whole, " \t\n\x0b\x0c\r", "")).cast("long").alias("word_chars"),
        _count(whole, SYMBOLS).cast("long").alias("n_symbols"),
    )
    hashes = F.col(hashed)
    n = F.size(hashes)
    window = F.transform(
        F.when(n >= 5, F.sequence(F.lit(0), n - 5)).otherwise(F.array().cast("array<int>")),
        lambda i: F.xxhash64(*(F.get(hashes, i + k) for k in range(5))),
    )
    step = step.withColumns(
        {
            "n_words": n.cast("long"),
            windows: window,
            good: F.filter(line_list, lambda line: ~line_fails(line)),
        }
    )
    step = step.withColumns(
        {
            "n_dup_lines": (F.size(line_list) - F.size(F.array_distinct(line_list))).cast("long"),
            keyed: _keyed_windows(F.col(windows)),
            "clean_text": F.array_join(good, "\n"),
            before: F.length(F.array_join(line_list, "\n")),
        }
    )
    covered = _covered_words(_repeat_starts(F.col(keyed)))
    step = step.withColumn("n_repeat_words", covered.cast("long"))
    base = (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")
    )
    lost = F.when(F.col(before) == 0, F.lit(0.0)).otherwise(
        1 - F.length("clean_text") / F.col(before)
    )
    step = step.withColumns({"base_failed": base, "lost_share": lost})
    return step.select(*kept, *added[:-1], (~F.col("base_failed") & (F.col("lost_share") <= MAX_LOST)).alias("kept"))
