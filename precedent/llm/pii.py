"""Personal data in text: base patterns, and a linear-chain CRF over word shapes.

Base spans are found by regular expressions. A word without a digit or ``@`` is outside every span by
the structure of the model, so the chain falls apart into runs of *open* words exactly. The CRF
(a label per kind, and outside) scores the shape of a word, those of its neighbours, and label pairs; it is trained
on a small labelled table, runs of words with the labels of their base spans and copies whose phone
numbers lack the country code, by gradient ascent with forward-backward, and decodes whole batches of
runs at once by Viterbi. A decoded span is added if it touches no match of a base pattern, valid or not (short digit groups aside).

Edge cases: a null text is the empty text and has no spans; with nothing to learn from, no span is added;
columns of the input other than doc_id and text are not read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from precedent.llm.common import slices, texts_of
from precedent.session import ship_package

KINDS = ("email", "ip", "card", "phone")
# The base patterns.
EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
#: Stretches outside of which no ip, card or phone can lie.
NUMERIC = re.compile(r"[0-9+][\x20().0-9+-]*")
#: Stretches outside of which no email can lie.
AROUND_AT = re.compile(r"[A-Za-z0-9._%+@-]+")
OPEN_WORD = re.compile(r"[^\x20\x09-\x0D]*[0-9@][^\x20\x09-\x0D]*")
#: Runs of the labelled table at most: those of the least hash.
TRAINING_RUNS = 3000
MAX_SHAPES = 2000
#: Runs, and words with padding, that are decoded at a time; words whose scores are held at a time.
BLOCK_RUNS, BLOCK_CELLS, SCORE_CELLS = 4096, 1 << 20, 1 << 16
OUTSIDE = len(KINDS)
CARD_KIND = KINDS.index("card")
EPOCHS, RATE, DECAY = 60, 0.5, 1e-3


def _luhn(digits: str) -> bool:
    values = [int(d) for d in digits]
    doubled = [2 * v - 9 * (v > 4) for v in values[-2::-2]]
    return (sum(values[-1::-2]) + sum(doubled)) % 10 == 0


def base_matches(text: str) -> list[tuple[int, int, int, bool]]:
    """(kind, start, end, valid) of every base match, in order of kind and start."""
    found = []
    if "@" in text:
        for part in AROUND_AT.finditer(text):
            if "@" in part[0]:
                at = part.start()
                found += [(0, at + m.start(), at + m.end(), True) for m in EMAIL.finditer(part[0])]
    for part in NUMERIC.finditer(text):
        stretch, at = part[0], part.start()
        if len(stretch) < 7:  # 1.2.3.4
            continue
        for m in IP.finditer(stretch):
            valid = all(len(x.lstrip("0")) < 4 and int(x.lstrip("0") or 0) <= 255 for x in m[0].split("."))
            found.append((1, at + m.start(), at + m.end(), valid))
        for m in CARD.finditer(stretch):
            digits = m[0].replace(" ", "").replace("-", "")
            found.append((2, at + m.start(), at + m.end(), 13 <= len(digits) <= 19 and _luhn(digits)))
        for m in PHONE.finditer(stretch):
            n = sum(c.isdigit() for c in m[0])
            found.append((3, at + m.start(), at + m.end(), 9 <= n <= 15))
    return sorted(found)


def shape(word: str) -> str:
    """Capitals, small letters and digits as X, x and d with their numbers up to four; signs as they are."""
    out: list[str] = []
    n = 0
    for c in word[:64]:
        s = "d" if "0" <= c <= "9" else "X" if c.isupper() else "x" if c.isalpha() else c
        n = n + 1 if out and out[-1] == s else 1
        if n <= 4:
            out.append(s)
    return "".join(out)


def runs_of(text: str) -> list[list[tuple[int, int]]]:
    """Runs of open words that only white space parts, as (start, end) of each word without
    enclosing punctuation."""
    runs: list[list[tuple[int, int]]] = []
    last = None
    for m in OPEN_WORD.finditer(text):
        begin, end = m.span()
        joined = last is not None and not text[last:begin].strip(" \t\n\x0b\x0c\r")
        last = end
        while begin < end and text[begin] in "\"'<>,;:!?|":
            begin += 1
        while end > begin and text[end - 1] in "\"'<>,;:!?.|#*$%&":
            end -= 1
        if joined:
            runs[-1].append((begin, end))
        else:
            runs.append([(begin, end)])
    return runs


class Crf:
    """Weights per (shape, label) for a word, the one before and the one after, and label pairs."""

    def __init__(self, shapes: list[str]):
        # 0: a shape that was not seen; 1: outside the run.
        self.id_of = {s: i + 2 for i, s in enumerate(shapes)}
        self.unary = np.zeros((3, len(shapes) + 2, len(KINDS) + 1))
        self.pair = np.zeros((len(KINDS) + 1, len(KINDS) + 1))

    def _ids(self, runs: list[list[str]]) -> tuple[np.ndarray, np.ndarray]:
        length = np.array([len(r) for r in runs])
        ids = np.ones((len(runs), length.max() + 2), np.int64)
        for row, run in enumerate(runs):
            ids[row, 1 : len(run) + 1] = [self.id_of.get(s, 0) for s in run]
        return ids, length

    def _scores(self, ids: np.ndarray) -> np.ndarray:
        return self.unary[0][ids[:, 1:-1]] + self.unary[1][ids[:, :-2]] + self.unary[2][ids[:, 2:]]

    def fit(self, runs: list[list[str]], labels: list[list[int]]) -> None:
        ids, length = self._ids(runs)
        n, steps = ids.shape[0], ids.shape[1] - 2
        inside = np.arange(steps) < length[:, None]
        gold = np.full((n, steps), OUTSIDE)
        for row, run in enumerate(labels):
            gold[row, : len(run)] = run
        one_hot = np.eye(len(KINDS) + 1)
        target = one_hot[gold] * inside[..., None]
        both = inside[:, 1:]
        pairs = np.einsum("nti,ntj->ij", target[:, :-1] * both[..., None], target[:, 1:])
        squares = [np.full(self.unary.shape, 1e-8), np.full(self.pair.shape, 1e-8)]
        for _ in range(EPOCHS):
            marginal, expected = self._expectations(self._scores(ids), inside)
            gradient = np.zeros_like(self.unary)
            change = target - marginal
            for k, part in enumerate((ids[:, 1:-1], ids[:, :-2], ids[:, 2:])):
                np.add.at(gradient[k], part[inside], change[inside])
            for weight, g, square in zip((self.unary, self.pair), (gradient, pairs - expected), squares):
                g = g - DECAY * weight
                square += g * g
                weight += RATE * g / np.sqrt(square)

    def _expectations(self, score: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Label marginals, and expected label pairs, by forward-backward in logs."""
        n, steps, _ = score.shape
        forward, backward = np.zeros_like(score), np.zeros_like(score)
        forward[:, 0] = score[:, 0]
        for t in range(1, steps):
            new = _log_sum(forward[:, t - 1, :, None] + self.pair, 1) + score[:, t]
            forward[:, t] = np.where(inside[:, t, None], new, forward[:, t - 1])
        for t in range(steps - 2, -1, -1):
            new = _log_sum(self.pair + (score[:, t + 1] + backward[:, t + 1])[:, None, :], 2)
            backward[:, t] = np.where(inside[:, t + 1, None], new, 0.0)
        total = _log_sum(forward[:, -1], 1)
        marginal = np.exp(forward + backward - total[:, None, None]) * inside[..., None]
        expected = np.zeros_like(self.pair)
        for t in range(1, steps):
            joint = forward[:, t - 1, :, None] + self.pair + (score[:, t] + backward[:, t])[:, None, :]
            expected += (np.exp(joint - total[:, None, None]) * inside[:, t, None, None]).sum(axis=0)
        return marginal, expected

    def decode(self, runs: list[list[str]]) -> list[list[int]]:
        """Viterbi labels of runs, those of similar length together."""
        out: list[list[int]] = [[] for _ in runs]
        for block in blocks_of_cells(sorted(range(len(runs)), key=lambda i: len(runs[i])), [len(r) for r in runs]):
            ids, length = self._ids([runs[i] for i in block])
            n, steps = len(block), ids.shape[1] - 2
            back = np.empty((steps, n, len(KINDS) + 1), np.int8)
            wide = max(1, SCORE_CELLS // n)
            for begin in range(0, steps, wide):
                score = self._scores(ids[:, begin : begin + wide + 2])
                if not begin:
                    best = score[:, 0].copy()
                for t in range(max(1, begin), min(steps, begin + wide)):
                    moves = best[:, :, None] + self.pair
                    back[t] = np.where((t < length)[:, None], moves.argmax(axis=1), np.arange(len(KINDS) + 1))
                    best = np.where((t < length)[:, None], moves.max(axis=1) + score[:, t - begin], best)
            path = np.empty((steps, n), np.int8)
            label = path[-1] = best.argmax(axis=1)
            for t in range(steps - 1, 0, -1):
                label = path[t - 1] = back[t][np.arange(n), label]
            for row, i in enumerate(block):
                out[i] = path[: length[row], row].tolist()
        return out


def blocks_of_cells(order: list[int], length: list[int]) -> Iterator[list[int]]:
    """``order``, which goes by length, in blocks of ``BLOCK_CELLS`` padded words; a longer run is alone."""
    begin = 0
    for at in range(1, len(order) + 1):
        if at == len(order) or at - begin == BLOCK_RUNS or (at + 1 - begin) * length[order[at]] > BLOCK_CELLS:
            yield order[begin:at]
            begin = at


def _log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return np.squeeze(top, axis) + np.log(np.exp(x - top).sum(axis=axis))


def labels_of(run: list[tuple[int, int]], matches: list[tuple[int, int, int, bool]]) -> list[int]:
    """The kind of the valid base span over each word of a run."""
    out = []
    for begin, end in run:
        kinds = [k for k, a, b, valid in matches if valid and a < end and begin < b]
        out.append(kinds[0] if kinds else OUTSIDE)
    return out


def labelled_runs(docs: DataFrame, most: int = TRAINING_RUNS) -> list[tuple[list[str], list[int]]]:
    """The labelled table: shapes and labels of ``most`` distinct runs at most."""
    ship_package(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            rows = set()
            for text in texts_of(batch):
                matches = base_matches(text)
                for words in runs_of(text):
                    shapes = "\t".join(shape(text[a:b]) for a, b in words[:40])
                    rows.add((shapes, "\t".join(map(str, labels_of(words[:40], matches)))))
            shapes, labels = zip(*rows) if rows else ((), ())
            yield pa.RecordBatch.from_arrays([pa.array(shapes, pa.string()), pa.array(labels, pa.string())], names=["shapes", "labels"])

    rows = docs.select("text").mapInArrow(run, "shapes string, labels string").distinct()
    rows = rows.orderBy(F.xxhash64("shapes", "labels"), "shapes", "labels").limit(most).collect()
    return [(r["shapes"].split("\t"), list(map(int, r["labels"].split("\t")))) for r in rows]


def train(docs: DataFrame, most: int = TRAINING_RUNS) -> Crf | None:
    table = labelled_runs(docs, most)
    phone = KINDS.index("phone")
    for shapes, labels in list(table):
        if phone in labels and shapes[labels.index(phone)].startswith("+") and labels.count(phone) > 1:
            at = labels.index(phone)
            table.append((shapes[:at] + shapes[at + 1 :], labels[:at] + labels[at + 1 :]))
    if not any(k != OUTSIDE for _, labels in table for k in labels):
        return None
    known = sorted({s for shapes, _ in table for s in shapes})[:MAX_SHAPES]
    crf = Crf(known)
    crf.fit([s for s, _ in table], [labels for _, labels in table])
    return crf


def added_spans(crf: Crf | None, texts: list[str], matches: list[list[tuple[int, int, int, bool]]]) -> list[list[tuple[int, int, int]]]:
    """Spans (kind, start, end) that the CRF finds beside the base matches of each text."""
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    if crf is None:
        return out
    where = [(row, words) for row, text in enumerate(texts) for words in runs_of(text)]
    decoded = crf.decode([[shape(texts[row][a:b]) for a, b in words] for row, words in where])
    for (row, words), labels in zip(where, decoded):
        t = 0
        while t < len(words):
            kind, first = labels[t], t
            while t < len(words) and labels[t] == kind:
                t += 1
            begin, end = words[first][0], words[t - 1][1]
            # A card pattern that fails with few digits only says that there are digits.
            touched = any(
                a < end and begin < b for k, a, b, valid in matches[row] if valid or k != CARD_KIND or b - a >= 13
            )
            if kind != OUTSIDE and begin < end and not touched:
                out[row].append((kind, begin, end))
    return out


def _written(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for k, a, b in sorted(spans))


PII = "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string"


def find_pii(docs: DataFrame, most: int = TRAINING_RUNS) -> DataFrame:
    """doc_id, numbers of base spans, their digest, and all spans, of every document."""
    spark = docs.sparkSession
    ship_package(spark)
    sent = spark.sparkContext.broadcast(train(docs, most))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            texts = texts_of(batch)
            matches = [base_matches(t) for t in texts]
            base = [[m[:3] for m in found if m[3]] for found in matches]
            more = added_spans(sent.value, texts, matches)
            counts = [pa.array([sum(m[0] == k for m in b) for b in base], pa.int64()) for k in range(len(KINDS))]
            sha = [hashlib.sha256(_written(b).encode()).hexdigest() for b in base]
            spans = [_written(b + m) for b, m in zip(base, more)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *counts, pa.array(sha, pa.string()), pa.array(spans, pa.string())],
                names=["doc_id", *(f"n_{k}" for k in KINDS), "base_sha256", "spans"],
            )

    return docs.selectExpr("cast(doc_id as long) as doc_id", "text").mapInArrow(run, PII)
