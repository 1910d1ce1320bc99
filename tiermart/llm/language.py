"""Language identification with averaged hashed subword embeddings.

A text is its words (runs of letters, lower-cased); a word is its character
2- to 4-grams with word marks, and itself, hashed into buckets (for many words at once, in numpy). The mean of the
buckets' embeddings goes through a linear softmax. Embeddings and softmax are
trained by stochastic gradient descent in numpy on a bounded sample of labelled
rows (``PER_LANGUAGE`` rows a language, by hash of the row). A quarter of
the sample takes no part in that: on it the softmax is calibrated by one
temperature, and the least confidence is found at which the share of wrong answers
among those accepted is at most ``TARGET_ERROR``; what is less sure is rejected.

As the softmax is linear in the mean, a trained model is one vector of class
scores for each bucket, and a token's sum of them is remembered by the worker.
"""

from __future__ import annotations

import re
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tiermart.llm.common import arrow_map, strings

BUCKETS = 1 << 15
DIMENSION = 16
PER_LANGUAGE = 400
EPOCHS = 6
RATE = 0.5
TARGET_ERROR = 0.001
# Distinct tokens (between white space) a Python worker remembers before it starts anew.
MEMORY = 150_000
# Tokens of a text that are looked up at once.
PART = 20_000
UNDETERMINED = "und"
_WORD = re.compile(r"[^\W\d_]+")


def subwords(words: list[str], buckets: int = BUCKETS) -> tuple[np.ndarray, np.ndarray]:
    """(bucket, number of its word): every 2- to 4-gram of each marked word, and each word itself."""
    marked = "".join(f"<{w}>" for w in words)
    code = np.frombuffer(marked.encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.uint64)
    size = np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 2
    owner = np.repeat(np.arange(len(words)), size)
    with np.errstate(over="ignore"):
        # polynomial in the position from the word's end: one term a character, summed by word
        rank = (np.cumsum(size)[owner] - 1 - np.arange(len(code))).astype(np.uint64)
        whole = np.zeros(len(words), dtype=np.uint64)
        if len(words):
            whole = np.add.reduceat((code + np.uint64(7)) * _power(rank), np.cumsum(size) - size)
        ids, owners = [_mixed(whole, 1, buckets)], [np.arange(len(words))]
        gram = code
        for n in (2, 3, 4):
            gram = gram[:-1] * np.uint64(0x100000001B3) + code[n - 1:]
            fits = owner[:len(gram)] == owner[n - 1:]
            ids.append(_mixed(gram[fits], n, buckets))
            owners.append(owner[:len(gram)][fits])
    return np.concatenate(ids), np.concatenate(owners)


def _power(rank: np.ndarray) -> np.ndarray:
    """Powers of an odd number, modulo 2^64, by rank."""
    table = np.ones(int(rank.max()) + 1, dtype=np.uint64)
    np.multiply.accumulate(np.full(len(table) - 1, 0x9E3779B97F4A7C15, dtype=np.uint64), out=table[1:])
    return table[rank]


def _mixed(value: np.ndarray, kind: int, buckets: int) -> np.ndarray:
    value = (value + np.uint64(kind)) * np.uint64(0xBF58476D1CE4E5B9)
    value ^= value >> np.uint64(29)
    return ((value * np.uint64(0x94D049BB133111EB)) >> np.uint64(32)).astype(np.int64) % buckets


def tokens_of(text: str | None) -> list[str]:
    """Lower-cased pieces between white space, in which the words are; none if the text is null or has no letter."""
    return text.lower().split() if text and any(c.isalpha() for c in text) else []


def words_of(text: str | None) -> list[str]:
    """Lower-cased runs of letters; none if the text is null or has no letter."""
    return [w for t in tokens_of(text) for w in _WORD.findall(t)]


@dataclass
class Model:
    """Class scores per bucket (embedding times softmax weights), bias, temperature, least accepted confidence."""

    classes: list[str]
    scores: np.ndarray
    bias: np.ndarray
    temperature: float = 1.0
    least: float = 0.0

    def probabilities(self, mean: np.ndarray) -> np.ndarray:
        z = (mean + self.bias) / self.temperature
        e = np.exp(z - z.max(axis=-1, keepdims=True))
        return e / e.sum(axis=-1, keepdims=True)


def train(bags: list[tuple[np.ndarray, np.ndarray]], labels: list[str], buckets: int = BUCKETS,
          dimension: int = DIMENSION, epochs: int = EPOCHS, rate: float = RATE, seed: int = 7) -> Model:
    """(bucket ids, counts) and label per text -> calibrated model. Every fourth text calibrates."""
    classes = sorted(set(labels))
    if not classes:
        return Model([], np.zeros((buckets, 0)), np.zeros(0))
    target = np.array([classes.index(x) for x in labels])
    shares = [counts / counts.sum() for _, counts in bags]
    rng = np.random.default_rng(seed)
    embedding = rng.uniform(-1 / dimension, 1 / dimension, (buckets, dimension))
    weights, bias = np.zeros((dimension, len(classes))), np.zeros(len(classes))
    fit = [i for i in range(len(bags)) if i % 4 != 3] or list(range(len(bags)))
    hold = [i for i in range(len(bags)) if i % 4 == 3] or fit
    steps, done = epochs * len(fit), 0
    for _ in range(epochs):
        for i in rng.permutation(fit):
            ids, share = bags[i][0], shares[i]
            mean = share @ embedding[ids]
            z = mean @ weights + bias
            error = np.exp(z - z.max())
            error /= error.sum()
            error[target[i]] -= 1
            step = rate * (1 - done / steps)
            back = weights @ error
            weights -= step * np.outer(mean, error)
            bias -= step * error
            # a bucket's share is small, so its own step is scaled up to the text's
            embedding[ids] -= step * np.outer(share * min(len(ids), 100), back)
            done += 1
    model = Model(classes, embedding @ weights, bias)
    means = np.array([shares[i] @ model.scores[bags[i][0]] for i in hold])
    truth = target[hold]

    sure = (len(hold) + 1) / (len(hold) + 2)  # so many texts cannot vouch for more

    def loss(t: float) -> float:
        model.temperature = t
        p = np.log(model.probabilities(means) + 1e-12)
        true = p[np.arange(len(hold)), truth]
        return float(-(sure * true + (1 - sure) * (p.sum(axis=1) - true) / max(1, len(classes) - 1)).mean())

    model.temperature = min(np.geomspace(0.01, 20, 77), key=loss)
    p = model.probabilities(means)
    order = np.argsort(-p.max(axis=1), kind="stable")
    wrong = np.cumsum(p.argmax(axis=1)[order] != truth[order]) / np.arange(1, len(order) + 1)
    good = np.flatnonzero(wrong <= TARGET_ERROR)
    model.least = float(p.max(axis=1)[order][good[-1]]) if len(good) else 1.0
    return model


def labelled_sample(labelled: DataFrame, text: str = "text", label: str = "lang",
                    per_language: int = PER_LANGUAGE) -> tuple[list[tuple[np.ndarray, np.ndarray]], list[str]]:
    """Bags of at most ``per_language`` different texts a label, those of least hash among all.

    A text counts once for its label, however often it stands there, so copies neither crowd out others nor stand on both
    sides of the split into training and calibration, and what comes to the driver is bounded.
    """
    rows = labelled.select(F.col(f"`{text}`").alias("text"), F.col(f"`{label}`").alias("label")).where(
        "text is not null and label is not null").withColumn("h", F.xxhash64("text", F.lit("sample")))
    keys = rows.select("label", "h").distinct()
    counts = {r["label"]: r["count"] for r in keys.groupBy("label").count().collect()}  # one row a language
    if not counts:
        return [], []
    # A share that holds more than enough, then exactly so many: what is ranked is small.
    share = F.lit(0.0)
    for name, n in sorted(counts.items()):
        share = F.when(F.col("label") == name, F.lit(min(1.0, (1.5 * per_language + 50) / n))).otherwise(share)
    unit = F.pmod("h", F.lit(1 << 40)) / F.lit(float(1 << 40))
    rank = F.row_number().over(Window.partitionBy("label").orderBy(unit, "h"))
    least = keys.where(unit < share).withColumn("rank", rank).where(F.col("rank") <= per_language).select("label", "h")
    chosen = rows.join(F.broadcast(least), ["label", "h"]).groupBy("label", "h").agg(F.min("text").alias("text")).select(
        "text", "label")

    def bags(batch: pa.RecordBatch) -> dict:
        ids, counts = [], []
        for t in strings(batch.column(0)):
            words = words_of(t)
            at, n = np.unique(subwords(words)[0] if words else np.zeros(0, np.int64), return_counts=True)
            ids.append(at.tolist())
            counts.append(n.tolist())
        return {"label": batch.column(1), "ids": ids, "counts": counts}

    got = arrow_map(chosen, bags, "label string, ids array<int>, counts array<int>").toArrow()
    made = [(x, np.asarray(i, np.int32), np.asarray(c, np.float64))
            for x, i, c in zip(*(got.column(k).to_pylist() for k in ("label", "ids", "counts"))) if i]
    made.sort(key=lambda m: (m[0], zlib.crc32(m[1].tobytes()), len(m[1])))
    order = np.random.default_rng(1).permutation(len(made))
    return [(made[i][1], made[i][2]) for i in order], [made[i][0] for i in order]


def identify(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, lang_pred, score, rejected) for every row.

    A text that is null or without a letter is ``und`` with score 0 and rejected, as
    is any text if the model has learned no language. Rows are independent of
    each other; repeated rows get equal results.
    """
    # A worker process keeps a broadcast value between tasks, and with it the words it has seen.
    shared = docs.sparkSession.sparkContext.broadcast((vars(model), {}))

    def rows(batch: pa.RecordBatch) -> dict:
        model, memory = Model(**shared.value[0]), shared.value[1]
        if "at" not in memory:
            memory["at"], memory["sums"] = {}, np.zeros((MEMORY + PART, len(model.classes) + 1))
        at, sums = memory["at"], memory["sums"]

        def learn(new: list[str]) -> None:
            words = [_WORD.findall(t) for t in new]
            ids, owner = subwords([w for ws in words for w in ws], len(model.scores))
            owner = np.repeat(np.arange(len(new)), [len(ws) for ws in words])[owner]
            lo = len(at)
            for c in range(len(model.classes)):
                sums[lo:lo + len(new), c] = np.bincount(owner, weights=model.scores[ids, c], minlength=len(new))
            sums[lo:lo + len(new), -1] = np.bincount(owner, minlength=len(new))
            at.update(zip(new, range(lo, lo + len(new))))

        pred, score, rejected = [], [], []
        for t in strings(batch.column(1)):
            tokens = tokens_of(t)
            if not tokens or not model.classes:
                pred.append(UNDETERMINED)
                score.append(0.0)
                rejected.append(True)
                continue
            total = np.zeros(len(model.classes) + 1)
            for lo in range(0, len(tokens), PART):
                part = tokens[lo:lo + PART]
                new = [w for w in dict.fromkeys(part) if w not in at]
                if len(at) + len(new) > len(sums):
                    at.clear()
                    new = list(dict.fromkeys(part))
                if new:
                    learn(new)
                total += sums[[at[w] for w in part]].sum(axis=0)
            p = model.probabilities(total[:-1] / total[-1])
            best = int(p.argmax())
            pred.append(model.classes[best])
            score.append(float(p[best]))
            rejected.append(bool(p[best] < model.least))
        return {key: batch.column(0), "lang_pred": pred, "score": score, "rejected": rejected}

    kind = docs.schema[key].dataType.simpleString()
    return arrow_map(docs.select(key, text), rows, f"`{key}` {kind}, lang_pred string, score double, rejected boolean")
