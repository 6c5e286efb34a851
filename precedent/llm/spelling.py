"""Groups of spelling variants: near words by a variable-length gram index, and the form each word follows.

The gram dictionary holds the grams of 3 to ``LONGEST`` characters (words carry a mark at either end)
that are at least as frequent as ``places / MOST_GRAMS``; all bigrams belong to it without being listed.
A word is decomposed into the longest gram at each place, without grams inside an earlier one.

One edit leaves most grams of a word as they are. For every place of an edit, ``Grams.ranges`` bounds those
that may change: grams over the place, grams left of it where a longer one might match now, and grams on either
side that such a longer gram might cover. The bounds depend only on characters beside the place, so a word and its
edited form agree on them and on all grams outside. Near words therefore share, for some place, the lists of
all unaffected grams, left and right. Merging the lists of one place means to intersect them; grams left of a
place spell out the word's begin, those right of it its end, so the merged list has the key (length, begin, end),
and an equi-join on it yields the candidates, which are verified by edit distance. A place in a run of affected grams has the key of its neighbour
and is listed once. A replaced character keeps the length; of two words of different length, the shorter lists an insertion and
the longer a deletion.

Edge cases: null texts have no words; a null id hashes as the empty text; rows with one id are separate
occurrences; words of any length are handled; an empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from precedent.llm.common import Tables, slices, texts_of
from precedent.session import ship_package

RUN = re.compile("[A-Za-zÀ-ÿ]+")
#: Every DROP-th run (by hash) has lost a character.
DROP = 97
MIN_LENGTH = 5
MIN_COUNT = 3
#: A word follows a near word that is so many times as frequent.
RATIO = 2
SHORTEST, LONGEST = 2, 3
#: Bound of the dictionary per gram length: the frequencies of one length add up to the number of places.
MOST_GRAMS = 20_000
#: A task's counts are sent on when they hold so many characters.
COUNT_CHARACTERS = 8_000_000

_LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}


def lower_ascii(run: str) -> str:
    return run.lower() if run.isascii() else run.translate(_LOWER)


def observed(prefix_crc: int, run: str) -> str:
    """The lower-cased run as the corpus shows it: one in ``DROP`` without one of its characters."""
    word = lower_ascii(run)
    h = zlib.crc32(word.encode(), prefix_crc)
    if h % DROP == 0:
        place = h % len(word)
        return word[:place] + word[place + 1 :]
    return word


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts, held = Counter(), 0

    def flush() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(counts.keys(), pa.string()), pa.array(counts.values(), pa.int64())], names=["word", "n"])

    for batch in slices(batches, "text"):
        for doc_id, text in zip(batch.column("doc_id").to_pylist(), texts_of(batch)):
            prefix = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
            for run, times in Counter(RUN.findall(text)).items():
                word = observed(prefix, run)
                if len(word) >= MIN_LENGTH:
                    if word not in counts:
                        held += len(word)
                    counts[word] += times
            if held >= COUNT_CHARACTERS:
                yield flush()
                counts.clear()
                held = 0
    yield flush()


def word_counts(docs: DataFrame) -> DataFrame:
    """(word, n) of all words of at least ``MIN_LENGTH`` characters and ``MIN_COUNT`` occurrences."""
    ship_package(docs.sparkSession)
    parts = docs.select("doc_id", "text").mapInArrow(_count_words, "word string, n long")
    return parts.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= MIN_COUNT)


def gram_dictionary(words: DataFrame, most: int = MOST_GRAMS, longest: int = LONGEST) -> set[str]:
    """The frequent grams of 3 to ``longest`` characters: at most ``most`` of each length, counted over all words.

    With a gram all its prefixes are in it, as they are at least as frequent.
    """
    marked = F.concat(F.lit("^"), "word", F.lit("$"))
    places = words.agg(F.sum(F.length("word") + 1)).head()[0] or 0
    lists = [_grams_of(marked, q) for q in range(SHORTEST + 1, longest + 1)]
    grams = words.select(F.explode(F.concat(F.array().cast("array<string>"), *lists)).alias("gram"))
    # The frequencies of one length add up to less than ``places``, so that few grams reach the bound.
    counts = grams.groupBy("gram").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") * most >= places)
    return {r.gram for r in counts.select("gram").collect()}


def _grams_of(text: Column, q: int) -> Column:
    places = F.sequence(F.lit(1), F.greatest(F.length(text) - (q - 1), F.lit(1)))
    return F.filter(F.transform(places, lambda p: F.substring(text, p, F.lit(q))), lambda g: F.length(g) == q)


class Grams:
    """Decomposition of words by a dictionary, and what one edit may change of it."""

    def __init__(self, listed: set[str]):
        self.listed = listed
        self.longest = max(map(len, listed), default=SHORTEST)
        #: Proper prefixes and suffixes of at least SHORTEST characters; shorter ones belong to some bigram.
        self.prefixes = {g[:-1] for g in listed}
        self.suffixes = {g[k:] for g in listed for k in range(1, len(g) - SHORTEST + 1)}

    def decompose(self, marked: str) -> tuple[list[int], list[int]]:
        """Begins and ends of the word's grams; both ascend."""
        begins, ends, reach, n = [], [], 0, len(marked)
        for p in range(n - SHORTEST + 1):
            end = p + SHORTEST
            while end < n and end - p < self.longest and marked[p : end + 1] in self.listed:
                end += 1
            if end > reach:
                begins.append(p)
                ends.append(end)
                reach = end
        return begins, ends

    def ranges(self, marked: str, begins: list[int], ends: list[int]) -> tuple[list[int], list[int]]:
        """For each place i of an edit, 1 to len - 1: how many grams to its left are safe, and the first gram that is safe to its right.

        The right side is for characters from i on: it is that of an insertion before i, and of a change of the character i - 1.
        """
        n, wide = len(marked), self.longest - 1
        left, right = [0] * n, [0] * (n + 1)
        for i in range(1, n):
            low = i - 1
            for p in range(max(0, i - wide), i - 1):
                if marked[p:i] in self.prefixes:
                    low = p
                    break
            at = left[i - 1]
            while at < len(begins) and begins[at] < low:
                at += 1
            while at and begins[at - 1] >= low:
                at -= 1
            left[i] = at
            reach = i + 1
            for e in range(min(n, i + wide), i + 1, -1):
                if marked[i:e] in self.suffixes:
                    reach = e
                    break
            at = right[i - 1]
            # Grams from the right side of the place that no changed gram can cover.
            while at < len(begins) and (begins[at] < i or ends[at] <= reach):
                at += 1
            while at and begins[at - 1] >= i and ends[at - 1] > reach:
                at -= 1
            right[i] = at
        right[n] = len(begins)
        return left, right

    def keys(self, word: str) -> tuple[list[str], list[str]]:
        """Keys of the merged lists: with one character changed (or, seen from a shorter word, deleted), and with one inserted."""
        marked = f"^{word}$"
        begins, ends = self.decompose(marked)
        left, right = self.ranges(marked, begins, ends)
        n, size = len(marked), len(word)

        def key(pair: tuple[int, int], length: int) -> str:
            before, after = pair
            begin = marked[: ends[before - 1]] if before else ""
            end = marked[begins[after] :] if after < len(begins) else ""
            return f"{length} {begin} {end}"

        changed = {(left[i], right[i + 1]) for i in range(1, n - 1)}
        inserted = {(left[i], right[i]) for i in range(1, n)}
        return [key(p, size) for p in changed], [key(p, size + 1) for p in inserted]


def _list_words(batches: Iterator[pa.RecordBatch], listed: set[str]) -> Iterator[pa.RecordBatch]:
    grams = Grams(listed)
    for batch in slices(batches, "word"):
        found = [grams.keys(word) for word in batch.column("word").to_pylist()]
        columns = [pa.array([f[k] for f in found], pa.list_(pa.string())) for k in (0, 1)]
        yield pa.RecordBatch.from_arrays([*batch.columns, *columns], names=["word", "n", "changed", "inserted"])


def near_words(words: DataFrame, tables: Tables, most: int = MOST_GRAMS, longest: int = LONGEST) -> DataFrame:
    """(word, n, other, other_n) once for every two near words; the stored ``words`` are (word, n)."""
    ship_package(words.sparkSession)
    # At most ``most`` grams of each length, so that the set may go to every task.
    listed = gram_dictionary(words, most, longest)
    keyed = words.select("word", "n").mapInArrow(
        lambda batches: _list_words(batches, listed), "word string, n long, changed array<string>, inserted array<string>"
    )
    keyed = tables.store(
        keyed.select("word", "n", *(F.transform(c, lambda k: F.xxhash64(k)).alias(c) for c in ("changed", "inserted"))), "keys"
    )
    lists = keyed.select(F.explode("changed").alias("key"), F.col("word").alias("other"), F.col("n").alias("other_n"))
    same = keyed.select(F.explode("changed").alias("key"), "word", "n", F.lit(False).alias("shorter"))
    shorter = keyed.select(F.explode("inserted").alias("key"), "word", "n", F.lit(True).alias("shorter"))
    # Words of one length meet twice, so only the smaller asks; hashes may collide, but every pair is verified.
    asked = F.col("shorter") | (F.col("word") < F.col("other"))
    met = same.union(shorter).join(lists, "key").where(asked & (F.levenshtein("word", "other", 1) == 1))
    return met.select("word", "n", "other", "other_n").distinct()


def follow(links: DataFrame, tables: Tables) -> DataFrame:
    """(word, root) of every (word, form), by pointer doubling; counts at least double along a chain, so that there are no circles."""
    pointers = tables.store(links.select("word", F.col("form").alias("root")), "pointers")
    while True:
        ahead = pointers.select(F.col("word").alias("root"), F.col("root").alias("further"))
        joined = pointers.join(ahead, "root", "left")
        moved = tables.store(joined.select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")), "moved")
        if not moved.where("moved").head(1):
            return moved.select("word", "root")
        pointers = moved.select("word", "root")


def spelling_variants(docs: DataFrame) -> DataFrame:
    """One row per word: word, form, root, n, n_near, form_n."""
    tables = Tables(docs.sparkSession, "spelling")
    words = tables.store(word_counts(docs), "words")
    pairs = tables.store(near_words(words, tables), "pairs")
    tables.drop("keys")
    both = pairs.select("word", "n", "other", "other_n").union(pairs.select("other", "other_n", "word", "n"))
    # The most frequent near word, of these the smallest.
    best = F.min(F.struct((-F.col("other_n")).alias("less"), F.col("other").alias("form")))
    near = both.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), best.alias("best"))
    form_n = -F.col("best.less")
    follows = form_n >= RATIO * F.col("n")
    forms = tables.store(
        words.join(near, "word", "left").select(
            "word",
            "n",
            F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(follows, F.col("best.form")).alias("form"),
            F.when(follows, form_n).alias("form_n"),
        ),
        "forms",
    )
    roots = follow(forms.where("form is not null"), tables)
    return forms.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
