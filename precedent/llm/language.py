"""Language of a text by words first, then by character n-grams.

Training counts every word of the labelled documents, and every n-gram of 4 to 1 characters of
``_word_``, per language. A known word scores its smoothed log frequency in each language. An unseen word is
scored by its 4-grams, where none of them is known by its 3-grams, and so on. The document's
scores are the sums over its words; ``score`` is the share of the best language after normalising.

The model is fitted on a bounded sample of the labelled rows: of each language, all rows where they hold at most
``TRAINING_CHARACTERS`` characters, else those whose hash falls below the share that is expected to hold as many. Each language has a
bound of its own, so a small one keeps all its rows however large the others are. Every word and n-gram of the
sample is in the model, whose size is bounded by that of the sample.

Edge cases: a text that is null or without a letter is ``und`` with score 0; so is every text if
there is nothing to learn from; ties go to the first language in order of name.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from precedent.llm.common import Tables, fold_column, slices, trimmed
from precedent.session import ship_package

UNDETERMINED = "und"
#: Characters of the labelled sample per language.
TRAINING_CHARACTERS = 3_000_000
GRAM_SIZES = (4, 3, 2, 1)
SMOOTHING = 0.5
#: Distinct (language, word) counts held in a task before they are handed on.
FLUSH = 100_000
#: Characters of words whose n-grams are counted at a time.
CHUNK_CHARS = 500_000
#: Texts are scored in slices of this many bytes, and the scores of their words summed for about this many at a time.
SLICE_BYTES, MOST_PIECES = 4_000_000, 200_000
COUNTS = "kind int, lang string, item string, n long"


def normal_form(piece: str) -> str:
    """Lower-cased piece without what stands around its letters; empty if it has no letter."""
    word = piece.lower()
    if word.isalpha():
        return word
    at = [i for i, c in enumerate(word) if c.isalpha()]
    return word[at[0] : at[-1] + 1] if at else ""


def grams(word: str, size: int) -> list[str]:
    framed = f"_{word}_"
    return [g for i in range(len(framed) - size + 1) if (g := framed[i : i + size]) != "_"]


def _pieces(texts: pa.Array) -> tuple[np.ndarray, list[str], np.ndarray]:
    """(index of each piece, distinct pieces, bounds of each text)."""
    lists = pc.utf8_split_whitespace(pc.fill_null(texts.cast(pa.string()), ""))
    encoded = lists.flatten().dictionary_encode()
    bounds = lists.offsets.to_numpy()
    distinct = encoded.dictionary.to_numpy(zero_copy_only=False).tolist()
    return encoded.indices.to_numpy(), distinct, bounds - bounds[0]


def _runs(bounds: np.ndarray) -> Iterator[tuple[int, int]]:
    """(first, end) of the texts that hold ``MOST_PIECES`` pieces together; a longer one alone."""
    a = 0
    while a < len(bounds) - 1:
        b = max(a + 1, int(np.searchsorted(bounds, bounds[a] + MOST_PIECES, side="right")) - 1)
        yield a, b
        a = b


def count_grams(words: Sequence[str], langs: Sequence[str], n: Sequence[int]) -> Iterator[tuple[int, tuple]]:
    """(size, (langs, grams, counts)) of the n-grams of ``words``, each of which counts ``n`` times.

    A gram of k characters is numbered by that of its first k - 1 and its last character, so
    numbers stay below the count of positions whatever the alphabet.
    """
    names, lang = np.unique(np.array(langs, object), return_inverse=True)
    sizes = np.array([len(w) + 2 for w in words])
    joined = "".join(f"_{w}_" for w in words)
    alphabet, code = np.unique(np.frombuffer(joined.encode("utf-32-le"), np.uint32), return_inverse=True)
    owner = np.repeat(np.arange(len(words)), sizes)
    left = np.repeat(np.cumsum(sizes), sizes) - np.arange(len(joined))
    weight = np.array(n, np.float64)[owner]
    number = np.zeros(len(joined), np.int64)
    for size in sorted(GRAM_SIZES):
        at = np.nonzero(left >= size)[0]
        key = number[at] * len(alphabet) + code[at + size - 1]
        _, first, number[at] = np.unique(key, return_index=True, return_inverse=True)
        sums = np.bincount(number[at] * len(names) + lang[owner[at]], weight[at], len(first) * len(names))
        some = np.nonzero(sums)[0]
        texts = [joined[i : i + size] for i in at[first].tolist()]
        found = [texts[i] for i in (some // len(names)).tolist()]
        counts = sums[some].astype(np.int64)
        whole = np.array([g != "_" for g in found], bool)
        yield size, (names[some % len(names)][whole], [g for g in found if g != "_"], counts[whole])


def _count_batch(kind: int, langs: Sequence[str], items: Sequence[str], n: Sequence[int]) -> pa.RecordBatch:
    kinds = pa.array(np.full(len(items), kind, np.int32))
    columns = [kinds, pa.array(langs, pa.string()), pa.array(items, pa.string()), pa.array(n, pa.int64())]
    return pa.RecordBatch.from_arrays(columns, names=["kind", "lang", "item", "n"])


def count_items(labelled: DataFrame) -> DataFrame:
    """(kind, lang, item, n): kind 0 words, else n-grams of that size; of (text, lang) rows."""
    ship_package(labelled.sparkSession)

    def emit(counts: dict[tuple[str, str], int]) -> Iterator[pa.RecordBatch]:
        begin, chars, keys = 0, 0, list(counts)
        for at, (_, word) in enumerate(keys, 1):
            chars += len(word)
            if chars > CHUNK_CHARS or at == len(keys):
                langs, words = zip(*keys[begin:at])
                n = [counts[key] for key in keys[begin:at]]
                yield _count_batch(0, langs, words, n)
                for size, found in count_grams(words, langs, n):
                    yield _count_batch(size, *found)
                begin, chars = at, 0

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for batch in slices(trimmed(batches), "text"):
            index, distinct, bounds = _pieces(batch.column("text"))
            langs = batch.column("lang").dictionary_encode()
            names = langs.dictionary.to_pylist()
            of_row = langs.indices.to_numpy().astype(np.int64)
            key = np.repeat(of_row, np.diff(bounds)) * max(1, len(distinct)) + index
            keys, n = np.unique(key, return_counts=True)
            forms = [normal_form(p) for p in distinct]
            for k, c in zip(keys.tolist(), n.tolist()):
                if word := forms[k % len(distinct)]:
                    counts[names[k // len(distinct)], word] += c
            if len(counts) > FLUSH:
                yield from emit(counts)
                counts.clear()
        yield from emit(counts)

    return (
        labelled.select("text", "lang")
        .mapInArrow(run, COUNTS)
        .groupBy("kind", "lang", "item")
        .agg(F.sum("n").alias("n"))
    )


class LanguageModel:
    """Log frequencies of words and n-grams per language."""

    def __init__(self, langs: list[str], totals: dict[int, np.ndarray], items: dict[int, dict[str, list[int]]]):
        self.langs = langs
        self.rows = {kind: {item: row for row, item in enumerate(table)} for kind, table in items.items()}
        self.logs = {}
        for kind, table in items.items():
            counts = np.array(list(table.values()), np.float64).reshape(len(table), len(langs))
            self.logs[kind] = np.log((counts + SMOOTHING) / (totals[kind] + SMOOTHING * (len(table) + 1)))

    def word(self, word: str) -> np.ndarray:
        return self.scores([word])[0]

    def scores(self, words: list[str]) -> np.ndarray:
        """Scores of each word, relative to their mean so that words without evidence count nothing."""
        found = np.zeros((len(words), len(self.langs)))
        rows = list(map(self.rows.get(0, {}).get, words))
        known = [i for i, row in enumerate(rows) if row is not None]
        if known:
            found[known] = self.logs[0][[rows[i] for i in known]]
        unseen = [i for i, row in enumerate(rows) if row is None and words[i]]
        for size in GRAM_SIZES:
            get = self.rows.get(size, {}).get
            owners, lengths, flat, rest = [], [], [], []
            for i in unseen:
                own = [row for g in grams(words[i], size) if (row := get(g)) is not None]
                if own:
                    owners.append(i)
                    lengths.append(len(own))
                    flat += own
                else:
                    rest.append(i)
            if owners:
                starts = np.cumsum([0, *lengths[:-1]])
                found[owners] = np.add.reduceat(self.logs[size][flat], starts, axis=0) / np.array(lengths)[:, None]
            unseen = rest
        return found - found.mean(axis=1, keepdims=True)

    def predict(self, texts: pa.Array) -> tuple[list[str], list[float]]:
        index, distinct, bounds = _pieces(texts)
        lettered = np.array([any(map(str.isalpha, p)) for p in distinct] or [False])
        if not self.langs or not len(index):
            return [UNDETERMINED] * len(texts), [0.0] * len(texts)
        scores = self.scores([normal_form(p) for p in distinct])
        sums, letters = np.zeros((len(texts), len(self.langs))), np.zeros(len(texts), bool)
        for a, b in _runs(bounds):
            part, begins = index[bounds[a] : bounds[b]], bounds[a:b] - bounds[a]
            # One more row keeps the bounds of trailing empty texts valid.
            sums[a:b] = np.add.reduceat(np.vstack([scores[part], np.zeros(len(self.langs))]), begins, axis=0)
            letters[a:b] = np.add.reduceat(np.append(lettered[part], False).astype(int), begins) > 0
        letters &= np.diff(bounds) > 0
        best = sums.argmax(axis=1)
        share = 1 / np.exp(np.clip(sums - sums.max(axis=1, keepdims=True), -50, 0)).sum(axis=1)
        names = [self.langs[b] if ok else UNDETERMINED for b, ok in zip(best, letters)]
        return names, np.where(letters, share, 0.0).tolist()


def training_sample(labelled: DataFrame, characters: int = TRAINING_CHARACTERS) -> DataFrame:
    """The rows to learn from: per language all, or a share by hash that is expected to hold ``characters``."""
    known = labelled.where("lang is not null")
    # One row per language.
    sizes = known.groupBy("lang").agg(F.coalesce(F.sum(F.length("text")), F.lit(0)).alias("n")).collect()
    shares = {r["lang"]: characters / r["n"] for r in sizes if r["n"] > characters}
    if not shares:
        return known
    by_lang = F.create_map(*(F.lit(x) for pair in shares.items() for x in pair))
    # Rows that repeat a text fall apart by their id.
    key = [c for c in ("doc_id", "text") if c in labelled.columns]
    draw = F.pmod(F.xxhash64(*key), F.lit(1 << 40)) / float(1 << 40)
    return known.where(draw < F.coalesce(F.try_element_at(by_lang, F.col("lang")), F.lit(1.0)))


def train(labelled: DataFrame, characters: int = TRAINING_CHARACTERS) -> LanguageModel:
    """A model of (text, lang[, doc_id]) rows; rows without lang are left out."""
    tables = Tables(labelled.sparkSession, "language")
    counts = tables.store(count_items(training_sample(labelled, characters)), "counts")
    totals = counts.groupBy("kind", "lang").agg(F.sum("n").alias("n")).collect()
    langs = sorted({r["lang"] for r in totals})
    place = {lang: i for i, lang in enumerate(langs)}
    sums = {kind: np.zeros(len(langs)) for kind in (0, *GRAM_SIZES)}
    for r in totals:
        sums[r["kind"]][place[r["lang"]]] = r["n"]
    items: dict[int, dict[str, list[int]]] = {kind: {} for kind in (0, *GRAM_SIZES)}
    # As many rows as the bounded sample has items.
    for batch in counts.toArrow().to_batches():
        for kind, lang, item, n in zip(*(batch.column(c).to_pylist() for c in ("kind", "lang", "item", "n"))):
            items[kind].setdefault(item, [0] * len(langs))[place[lang]] = n
    tables.drop("counts")
    return LanguageModel(langs, sums, items)


def with_language(docs: DataFrame, model: LanguageModel, text: str = "text") -> DataFrame:
    """``docs`` with lang_pred and score; columns of those names are replaced."""
    spark = docs.sparkSession
    ship_package(spark)
    kept = [c for c in docs.columns if c not in ("lang_pred", "score")]
    sent = spark.sparkContext.broadcast(model)
    schema = docs.select(*kept).schema.add("lang_pred", "string").add("score", "double")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(trimmed(batches), text, SLICE_BYTES):
            names, scores = sent.value.predict(batch.column(text))
            columns = [batch.column(c) for c in kept]
            columns += [pa.array(names, pa.string()), pa.array(scores, pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, names=[*kept, "lang_pred", "score"])

    return docs.select(*kept).mapInArrow(run, schema)


def language_rows(docs: DataFrame) -> DataFrame:
    """(doc_id, held_out, lang_pred, score) with a model learned from the folds that aren't held out."""
    held = fold_column(F.col("doc_id")) == 1
    model = train(docs.where(~held))
    found = with_language(docs.select("doc_id", "text"), model)
    return found.select("doc_id", held.alias("held_out"), "lang_pred", "score")
