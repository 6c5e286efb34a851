"""Quality scores by ridge regression on random Fourier features, with isotonic calibration.

A text is described by some twenty statistics. Random Fourier features of them approximate a
Gaussian kernel; every partition sums its share of the normal equations, the sums meet in a tree, and one
solve on the driver (a matrix of the number of features, whatever the table's size) gives the weights. Two folds of the training rows score each
other for the isotonic calibration, which pools adjacent violators over score bins.

Edge cases: a null text is the empty text and is scored like any other; several labels of one
document are averaged; labels without quality are left out; with no label at all every score is
0.5, with labels of one kind it is that label.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from precedent.llm.common import fold_column, slices, texts_of
from precedent.session import fresh_path, ship_package

N_FEATURES = 384
RIDGE = 1.0
#: Scores are binned this finely for the calibration.
BINS = 2000
SEED = 20240601
SYMBOLS = np.frombuffer(b"#*$%&|<>", np.uint8)
STATISTICS = 20


def statistics(texts: list[str]) -> np.ndarray:
    """One row of statistics per text."""
    out = np.zeros((len(texts), STATISTICS))
    lists = pc.utf8_split_whitespace(pa.array(texts, pa.string()))
    encoded = lists.flatten().dictionary_encode()
    index = encoded.indices.to_numpy().astype(np.int64)
    lengths = pc.utf8_length(encoded.dictionary).to_numpy(zero_copy_only=False).astype(float)
    bounds = lists.offsets.to_numpy() - lists.offsets[0].as_py()
    for row, text in enumerate(texts):
        raw = np.frombuffer(text.encode(), np.uint8)
        size = max(1, len(raw))
        bytes_of = np.bincount(raw, minlength=256)
        words = index[bounds[row] : bounds[row + 1]]
        n = max(1, len(words))
        kinds, counts = np.unique(words, return_counts=True)
        lines = [line for line in text.split("\n") if line.strip()]
        wide = lengths[words] if len(words) else np.zeros(1)
        windows = words[:-4] if len(words) > 4 else words[:0]
        for k in range(1, 5):
            windows = windows * 1_000_003 + words[k : len(words) - 4 + k] if len(windows) else windows
        ends = sum(line.rstrip()[-1] in ".!?" for line in lines)
        out[row] = (
            np.log1p(len(words)),
            np.log1p(len(lines)),
            wide.mean(),
            wide.std(),
            len(kinds) / n,
            counts.max(initial=0) / n,
            (words[1:] == words[:-1]).mean() if len(words) > 1 else 0.0,
            1 - len(np.unique(windows)) / max(1, len(windows)) if len(windows) else 0.0,
            1 - len(set(lines)) / max(1, len(lines)) if lines else 0.0,
            ends / max(1, len(lines)),
            bytes_of[SYMBOLS].sum() / n,
            bytes_of[ord("|")] / n,
            bytes_of[ord("!")] / n,
            bytes_of[[ord("."), ord(",")]].sum() / n,
            bytes_of[48:58].sum() / size,
            bytes_of[65:91].sum() / size,
            bytes_of[97:123].sum() / size,
            bytes_of[128:].sum() / size,
            bytes_of[[9, 10, 13, 32]].sum() / size,
            len(words) / max(1, len(lines)) / 100,
        )
    return out


def feature_table(docs: DataFrame) -> DataFrame:
    """(doc_id, x) with the statistics of every text, written once: they are read by the fit and the scores."""
    spark = docs.sparkSession
    ship_package(spark)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            x = statistics(texts_of(batch))
            lists = pa.ListArray.from_arrays(
                pa.array(np.arange(len(x) + 1, dtype=np.int32) * STATISTICS), pa.array(x.ravel())
            )
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), lists], names=["doc_id", "x"])

    rows = docs.selectExpr("cast(doc_id as long) as doc_id", "text")
    path = fresh_path(spark, "statistics")
    rows.mapInArrow(run, "doc_id long, x array<double>").write.parquet(path)
    return spark.read.parquet(path)


class FourierMap:
    """Standardised statistics to random Fourier features and a constant."""

    def __init__(self, mean: np.ndarray, scale: np.ndarray, n: int = N_FEATURES, seed: int = SEED):
        rng = np.random.default_rng(seed)
        self.mean, self.scale = mean, scale
        self.w = rng.normal(size=(len(mean), n)) / np.sqrt(len(mean))
        self.b = rng.uniform(0, 2 * np.pi, n)

    def __call__(self, x: np.ndarray) -> np.ndarray:
        # Far outliers say no more than distant values do.
        z = np.clip((x - self.mean) / self.scale, -5, 5)
        waves = np.cos(z @ self.w + self.b) * np.sqrt(2 / len(self.b))
        return np.hstack([waves, z, np.ones((len(x), 1))])


def _arrays(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    x = batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(-1, STATISTICS)
    return x, batch.column("y").to_numpy(zero_copy_only=False), batch.column("fold").to_numpy()


def _summed(rows: DataFrame, size: int, partial) -> np.ndarray:
    """Sum over all partitions of the vector that ``partial`` gives for a batch.

    Partitions send blocks of their sum, which add up by block, so no task and no message holds more than a few.
    """
    block = 4096

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size)
        for batch in batches:
            if batch.num_rows:
                total += partial(batch)
        for at in range(0, size, block):
            part = pa.array([total[at : at + block].tobytes()], pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array([at // block]), part], names=["block", "part"])

    def add(key: tuple[pa.Scalar, ...], parts: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(p, float) for p in parts.column("part").to_pylist())
        return pa.table({"block": [key[0].as_py()], "part": [total.tobytes()]})

    schema = "block long, part binary"
    sums = rows.mapInArrow(run, schema).groupBy("block").applyInArrow(add, schema).collect()
    parts = [r["part"] for r in sorted(sums, key=lambda r: r["block"])]
    return np.frombuffer(b"".join(parts)) if parts else np.zeros(size)


class QualityModel:
    def __init__(self, features: FourierMap | None, weights: np.ndarray, bounds: np.ndarray, values: np.ndarray):
        self.features, self.weights, self.bounds, self.values = features, weights, bounds, values

    def score(self, x: np.ndarray) -> np.ndarray:
        if self.features is None:
            return np.full(len(x), self.values[0])
        return np.interp(self.features(x) @ self.weights, self.bounds, self.values)


def isotonic(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Non-decreasing least-squares fit by pooling adjacent violators; x ascending."""
    pools: list[list[float]] = []  # mean, weight, first x, last x
    for at, value, w in zip(x, y, weight):
        pools.append([value, w, at, at])
        while len(pools) > 1 and pools[-2][0] >= pools[-1][0]:
            value, w, _, last = pools.pop()
            mean, before, first, _ = pools[-1]
            pools[-1] = [(mean * before + value * w) / (before + w), before + w, first, last]
    xs = [edge for p in pools for edge in ((p[2], p[3]) if p[3] > p[2] else (p[2],))]
    ys = [p[0] for p in pools for _ in range(2 if p[3] > p[2] else 1)]
    return np.array(xs), np.array(ys)


def fit(features: DataFrame, labels: DataFrame) -> QualityModel:
    """Fit on every labelled row that isn't held out (crc32 of the id, modulo 3, is not 1)."""
    fold = fold_column(F.col("doc_id"))
    known = (
        labels.where("quality is not null").selectExpr("cast(doc_id as long) as doc_id", "quality")
        .groupBy("doc_id").agg(F.avg("quality").alias("y")).where(fold != 1)
    )
    rows = features.join(known, "doc_id").select("x", "y", fold.alias("fold")).persist()

    def moments(batch: pa.RecordBatch) -> np.ndarray:
        x, y, _ = _arrays(batch)
        return np.concatenate([[len(x), y.sum()], x.sum(axis=0), (x**2).sum(axis=0)])

    total = _summed(rows, 2 + 2 * STATISTICS, moments)
    n, positive = total[0], total[1]
    if n == 0 or positive in (0, n):
        constant = 0.5 if n == 0 else positive / n
        rows.unpersist()
        return QualityModel(None, np.zeros(0), np.zeros(1), np.array([constant]))
    mean = total[2 : 2 + STATISTICS] / n
    scale = np.sqrt(np.maximum(total[2 + STATISTICS :] / n - mean**2, 1e-12))
    fourier = FourierMap(mean, scale)
    d = N_FEATURES + STATISTICS + 1

    def equations(batch: pa.RecordBatch) -> np.ndarray:
        x, y, folds = _arrays(batch)
        out = []
        for k in (0, 2):
            f, t = fourier(x[folds == k]), y[folds == k]
            out += [(f.T @ f).ravel(), f.T @ t]
        return np.concatenate(out)

    sums = _summed(rows, 2 * (d * d + d), equations).reshape(2, d * d + d)

    def solve(total: np.ndarray) -> np.ndarray:
        return np.linalg.solve(total[: d * d].reshape(d, d) + RIDGE * np.eye(d), total[d * d :])

    weights = solve(sums.sum(axis=0))
    other = [solve(sums[1]), solve(sums[0])]  # a fold is scored by the other one

    def binned(batch: pa.RecordBatch) -> np.ndarray:
        x, y, folds = _arrays(batch)
        f = fourier(x)
        raw = np.where(folds == 0, f @ other[0], f @ other[1])
        at = np.clip(((raw + 0.5) / 2 * BINS).astype(int), 0, BINS - 1)
        sums = [np.bincount(at, w, BINS) for w in (np.ones(len(y)), y)]
        return np.concatenate(sums)

    counts, hits = _summed(rows, 2 * BINS, binned).reshape(2, BINS)
    rows.unpersist()
    used = np.nonzero(counts)[0]
    bounds, values = isotonic((used + 0.5) / BINS * 2 - 0.5, hits[used] / counts[used], counts[used])
    return QualityModel(fourier, weights, bounds, values)


SCORES = "doc_id long, score double"


def quality_scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every document."""
    features = feature_table(docs)
    model = fit(features, labels)
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(-1, STATISTICS)
            score = np.clip(sent.value.score(x), 0, 1)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(score)], names=["doc_id", "score"])

    return features.mapInArrow(run, SCORES).select(
        "doc_id",
        (fold_column(F.col("doc_id")) == 1).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )

