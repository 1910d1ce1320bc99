"""Quality by random Fourier features over document statistics, ridge regression and isotonic calibration.

Every text, whole, becomes a few statistics of its letters, words and lines (``STATISTICS``), each a share, a
mean or a logarithm. They are scaled by the training rows' mean and deviation and cut off at ``REACH`` deviations, and random
cosine features of them approximate a Gaussian kernel. Ridge regression on the label needs
only sums over rows: each partition adds up its normal equations, and partitions are summed by row of the matrix.
Features are rounded to multiples of 2^-12, so the sums are exact integers and do not depend on partitions or their order.

Scores become probabilities by isotonic regression. A row's score for that comes from a model that has not
seen its fold: folds go by text, so that copies of a text fall together, and as the sums are kept by fold, the
model without a fold is a subtraction and not another pass. Scores are counted in ``BINS`` bins,
pooled into a rising function, and read off by linear interpolation.

All labelled rows are used. What comes to the driver is bounded by the parameters: one row a fold and feature, and one a
bin.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tiermart.llm.common import arrow_map, checkpointed, strings

FEATURES = 160
WIDTH = 8.0  # of the kernel, in deviations
RIDGE = 1e-3  # a row
FOLDS = 4
BINS = 2048
REACH = 4.0
SEED = 12
UNIT = 4096.0  # features are multiples of 1 / UNIT

STATISTICS = (
    "log_chars", "log_words", "word_length", "word_deviation", "long_words", "distinct_words", "top_word", "entropy",
    "same_neighbour", "letters", "upper", "digits", "spaces", "marks", "symbols", "mark_words", "shouting", "capitalised",
    "sentence_words", "line_words", "same_lines", "line_ends", "distinct_letters", "vowels")
_LETTERS = re.compile(r"[^\W\d_]+")
_SYMBOLS = re.compile(r"[^\w\s.,;:!?'\"()-]")
_MARKS = re.compile(r"[.,;:!?'\"()-]")
_ENDS = re.compile(r"[.!?]+(?:\s|$)")


def statistics(text: str | None) -> list[float]:
    """One number a name of ``STATISTICS``; all of them finite, 0 where there is nothing to count."""
    text = text or ""
    low, words = text.lower(), text.split()
    n, w = max(1, len(text)), max(1, len(words))
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    lowered = np.frombuffer(low.encode("utf-32-le", "surrogatepass"), np.uint32)
    upper = int((points != lowered).sum()) if len(points) == len(lowered) else sum(map(str.isupper, text))
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    counts: dict[str, int] = {}
    for word in words:
        counts[word] = counts.get(word, 0) + 1
    share = np.fromiter(counts.values(), np.float64, len(counts)) / w
    lines = [line for line in text.split("\n") if line.strip()]
    runs = _LETTERS.findall(text)
    letters, m = sum(map(len, runs)), max(1, len(runs))
    return [
        np.log1p(len(text)), np.log1p(len(words)),
        float(lengths.mean()) if words else 0.0, float(lengths.std()) if words else 0.0,
        float((lengths > 20).sum()) / w, len(counts) / w, float(share.max()) if words else 0.0,
        float(-(share * np.log(share)).sum()) / max(1.0, np.log(w)) if words else 0.0,
        sum(map(str.__eq__, words, words[1:])) / w,
        letters / n, upper / max(1, letters), float(((points >= 48) & (points <= 57)).sum()) / n,
        (len(text) - int(lengths.sum())) / n, len(_MARKS.findall(text)) / n, len(_SYMBOLS.findall(text)) / n,
        sum(not any(map(str.isalnum, word)) for word in counts) / max(1, len(counts)),
        sum(len(r) > 1 and r.isupper() for r in runs) / m, sum(r[0].isupper() for r in runs) / m,
        np.log1p(w / max(1, len(_ENDS.findall(text)))), np.log1p(w / max(1, len(lines))),
        1 - len(set(lines)) / max(1, len(lines)),
        sum(line.rstrip()[-1] in ".!?" for line in lines) / max(1, len(lines)),
        np.log1p(len(set(low))), sum(map(low.count, "aeiou")) / max(1, letters)]


def described(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, fold, statistics): one row a row, from the whole text. ``fold`` is a hash of the text."""

    def rows(batch: pa.RecordBatch) -> dict:
        texts = strings(batch.column(1))
        return {key: batch.column(0), "fold": [zlib.crc32((t or "").encode("utf-8", "surrogatepass")) for t in texts],
                "statistics": [statistics(t) for t in texts]}

    kind = docs.schema[key].dataType.simpleString()
    return arrow_map(docs.select(f"`{key}`", f"`{text}`"), rows, f"`{key}` {kind}, fold long, statistics array<double>")


@dataclass
class Model:
    """Scaling, random directions, ridge weights, and the calibration's knots."""

    mean: np.ndarray
    scale: np.ndarray
    directions: np.ndarray
    phases: np.ndarray
    weights: np.ndarray
    at: np.ndarray
    level: np.ndarray

    def features(self, statistics: np.ndarray) -> np.ndarray:
        """Cosine features, a constant last, as multiples of 1 / UNIT."""
        x = np.clip((statistics - self.mean) / self.scale, -REACH, REACH)
        z = np.cos(x @ self.directions + self.phases)
        return np.concatenate([np.rint(z * UNIT), np.full((len(z), 1), UNIT)], axis=1) / UNIT

    def raw(self, statistics: np.ndarray, weights: np.ndarray | None = None) -> np.ndarray:
        return self.features(statistics) @ (self.weights if weights is None else weights)

    def probability(self, raw: np.ndarray) -> np.ndarray:
        return np.clip(np.interp(raw, self.at, self.level), 0.0, 1.0)


def _matrix(column: pa.Array) -> np.ndarray:
    return np.array(column.to_pylist(), dtype=np.float64).reshape(len(column), len(STATISTICS))


def normal_equations(rows: DataFrame, model: Model) -> tuple[np.ndarray, np.ndarray]:
    """(label, fold, statistics) -> a matrix a fold: products of features, label as the last one; and rows a fold.

    Each partition adds up its own rows, as integers; then the partitions' rows of the matrix are summed by their number.
    """
    size = len(model.phases) + 2
    folds = FOLDS

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((folds, size, size))  # integers below 2^53: exact
        for batch in batches:
            z = np.rint(model.features(_matrix(batch.column(2))) * UNIT)
            z = np.concatenate([z, batch.column(0).to_numpy(zero_copy_only=False)[:, None] * UNIT], axis=1)
            fold = batch.column(1).to_numpy(zero_copy_only=False) % folds
            for f in range(folds):
                total[f] += z[fold == f].T @ z[fold == f]
        if total.any():
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(folds * size), pa.int32()),
                 pa.array(list(total.reshape(folds * size, size).astype(np.int64)), pa.list_(pa.int64()))], names=["row", "sums"])

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            sums = batch.column(1).flatten().to_numpy().reshape(-1, size)
            for r, s in zip(batch.column(0).to_pylist(), sums):
                total[r] = total[r] + s if r in total else s
        if total:
            yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int32()),
                                              pa.array(list(total.values()), pa.list_(pa.int64()))], names=["row", "sums"])

    schema = "row int, sums array<bigint>"
    got = rows.mapInArrow(partial, schema).repartition("row").mapInArrow(summed, schema).toArrow()
    out = np.zeros((folds * size, size))
    for r, s in zip(got.column("row").to_pylist(), got.column("sums").to_pylist()):
        out[r] = s
    out = out.reshape(folds, size, size) / UNIT ** 2
    return out, out[:, -2, -2]


def solve(products: np.ndarray, rows: float, ridge: float = RIDGE) -> np.ndarray:
    """Ridge weights from the products of features (the constant unpenalised) and label."""
    a, b = products[:-1, :-1].copy(), products[:-1, -1]
    a[np.arange(len(a) - 1), np.arange(len(a) - 1)] += ridge * max(rows, 1.0)
    a[-1, -1] += 1e-9
    return np.linalg.solve(a, b)


def rising(at: np.ndarray, yes: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Isotonic regression by pooling adjacent violators: (place, level) of each pool's first and last place."""
    pools: list[tuple[float, float, float, float]] = []  # first, last, yes, n
    for x, y, w in zip(at.tolist(), yes.tolist(), n.tolist()):
        pools.append((x, x, y, w))
        while len(pools) > 1 and pools[-2][2] * pools[-1][3] >= pools[-1][2] * pools[-2][3]:
            (first, _, y0, w0), (_, last, y1, w1) = pools[-2:]
            pools[-2:] = [(first, last, y0 + y1, w0 + w1)]
    p = np.array(pools)
    return p[:, :2].ravel(), np.repeat(p[:, 2] / p[:, 3], 2)


def fit(labelled: DataFrame, features: int = FEATURES, width: float = WIDTH, ridge: float = RIDGE, bins: int = BINS,
        seed: int = SEED) -> Model | None:
    """Fit on all rows of (label, fold, statistics); labels 0 and 1. None if there are no rows of both labels."""
    rows = checkpointed(labelled.where("label is not null").select(
        F.col("label").cast("double").alias("label"), "fold", "statistics"))
    n = len(STATISTICS)
    # Decimal sums do not depend on the order of rows.
    value = [F.col("statistics")[i].cast("decimal(24,9)") for i in range(n)]
    got = rows.agg(F.count(F.lit(1)), F.sum("label"), *[F.sum(v) for v in value],
                   *[F.sum((v * v).cast("decimal(24,9)")) for v in value]).first()
    total, yes = got[0], got[1] or 0.0
    if yes <= 0 or yes >= total:
        return None
    mean = np.array([float(x) for x in got[2:2 + n]]) / total
    scale = np.sqrt(np.maximum(np.array([float(x) for x in got[2 + n:]]) / total - mean ** 2, 0))
    random = np.random.default_rng(seed)
    model = Model(mean, np.where(scale > 1e-6, scale, 1.0), random.normal(size=(n, features)) / width,
                  random.uniform(0, 2 * np.pi, features), np.zeros(features + 1), np.zeros(1), np.zeros(1))
    products, held = normal_equations(rows, model)
    model.weights = solve(products.sum(axis=0), held.sum(), ridge)
    without = np.array([solve(products.sum(axis=0) - products[f], held.sum() - held[f], ridge) for f in range(FOLDS)])

    def binned(batch: pa.RecordBatch) -> dict:
        z = model.features(_matrix(batch.column(2)))
        raw = (z * without[batch.column(1).to_numpy(zero_copy_only=False) % FOLDS]).sum(axis=1)
        return {"bin": np.clip(np.floor((raw + 0.5) / 2 * bins), 0, bins - 1).astype(np.int64).tolist(),
                "label": batch.column(0)}

    counted = arrow_map(rows.select("label", "fold", "statistics"), binned, "bin long, label double").groupBy("bin").agg(
        F.count(F.lit(1)).alias("n"), F.sum("label").alias("yes")).orderBy("bin").collect()  # at most ``bins`` rows
    at = np.array([(r["bin"] + 0.5) / bins * 2 - 0.5 for r in counted])
    model.at, model.level = rising(at, np.array([r["yes"] for r in counted]), np.array([r["n"] for r in counted], float))
    return model


def score(rows: DataFrame, model: Model | None, key: str = "doc_id") -> DataFrame:
    """(key, score) of every row of (key, fold, statistics); 0.5 without a model.

    Null and empty texts have statistics too and get the score these lead to; texts are read whole;
    repeated rows get equal scores; no rows give none.
    """

    def scored(batch: pa.RecordBatch) -> dict:
        if model is None:
            return {key: batch.column(0), "score": [0.5] * batch.num_rows}
        return {key: batch.column(0), "score": pa.array(model.probability(model.raw(_matrix(batch.column(1)))))}

    return arrow_map(rows.select(f"`{key}`", "statistics"), scored,
                     f"`{key}` {rows.schema[key].dataType.simpleString()}, score double")
