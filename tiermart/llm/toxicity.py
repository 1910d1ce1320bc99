"""Toxicity by cumulative-link ordinal regression on sparse text features.

Features are the presence of words (runs of letters, lower-cased, hashed). One
weight a feature is shared by all thresholds: P(grade > k) = s(w.x - t_k) with
t_0 < t_1 < ...; the expected severity is the sum of these over k.

The model is fitted on a bounded sample of labelled rows (``LABELLED_ROWS``). Near copies of one text would make its chance words look telling, so
rows that share their least five-word shingle hash weigh one together. Features
enter if their association with a positive label is beyond chance
(chi-square of at least ``LEAST_CHI2``). Where labels are 0 and 1 only, positive rows
are graded by how many different telling words they hold.
"""

from __future__ import annotations

import re
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DoubleType, IntegerType, StructField, StructType

from tiermart.llm.common import arrow_map, strings

LABELLED_ROWS = 8000
LEAST_CHI2 = 30.0
LEAST_FAMILIES = 4
GRADE_AT = (1, 2, 4)  # telling words from which a positive row is of grade 1 (at least), 2, 3
PENALTY = 5e-4
STEPS = 300
REJECT_FROM = 0.5
MEMORY = 200_000
SHINGLE = 5
_WORD = re.compile(r"[^\W\d_]+")


def word_hash(word: str) -> int:
    return zlib.crc32(word.encode("utf-8", "surrogatepass"))


def _example(text: str | None) -> tuple[np.ndarray, int]:
    """Distinct word hashes, and the least shingle hash as the family of near copies."""
    h = np.array([word_hash(w) for w in _WORD.findall((text or "").lower())], dtype=np.uint64)
    mixed = np.zeros(max(1, len(h) - SHINGLE + 1), dtype=np.uint64)
    for k in range(min(SHINGLE, len(h))):
        part = h[k:k + len(mixed)]
        mixed[:len(part)] = (mixed[:len(part)] + part) * np.uint64(0x9E3779B97F4A7C15)
    mixed ^= mixed >> np.uint64(31)
    return np.unique(h).astype(np.int64), int(mixed.min()) >> 1


@dataclass
class Model:
    """Weight by feature hash, thresholds in ascending order."""

    weights: dict[int, float]
    thresholds: np.ndarray

    def severity(self, score: np.ndarray) -> np.ndarray:
        """Expected grade: sum over k of P(grade > k)."""
        return (1 / (1 + np.exp(self.thresholds[None, :] - score[:, None]))).sum(axis=1)


def fit_ordinal(rows: list[np.ndarray], grades: np.ndarray, weight: np.ndarray, features: int,
                penalty: float = PENALTY, steps: int = STEPS) -> tuple[np.ndarray, np.ndarray]:
    """Feature indices per row, grade and weight per row -> (weights, thresholds), by Adam on the log-likelihood."""
    top = int(grades.max()) if len(grades) else 0
    if top == 0:
        return np.zeros(features), np.zeros(0)
    size = np.array([len(r) for r in rows])
    flat = np.concatenate(rows).astype(np.int64) if size.sum() else np.zeros(0, np.int64)
    owner = np.repeat(np.arange(len(rows)), size)
    total = weight.sum()
    start = [np.clip((weight * (grades > k)).sum() / total, 1e-3, 1 - 1e-3) for k in range(top)]
    w, t = np.zeros(features), np.array([np.log((1 - p) / p) for p in start])
    t = np.maximum.accumulate(t + np.arange(top) * 1e-3)
    moments = [np.zeros(features + top), np.zeros(features + top)]
    above = (grades[:, None] > np.arange(top)[None, :])
    for n in range(1, steps + 1):
        score = np.bincount(owner, weights=w[flat], minlength=len(rows))
        p = 1 / (1 + np.exp(t[None, :] - score[:, None]))  # P(grade > k)
        edge = np.concatenate([np.ones((len(rows), 1)), p, np.zeros((len(rows), 1))], axis=1)
        at = np.arange(len(rows))
        mass = np.maximum(edge[at, grades] - edge[at, grades + 1], 1e-12)  # P(grade = its own)
        slope = edge * (1 - edge)
        d_score = -weight * (slope[at, grades] - slope[at, grades + 1]) / mass
        d_t = np.zeros(top)
        for k in range(top):  # threshold k bounds grade k from above and grade k + 1 from below
            d_t[k] = (weight * slope[:, k + 1] / mass * ((grades == k + 1).astype(float) - (grades == k))).sum()
        gradient = np.concatenate([np.bincount(flat, weights=d_score[owner], minlength=features) / total + penalty * w,
                                   d_t / total])
        moments[0] = 0.9 * moments[0] + 0.1 * gradient
        moments[1] = 0.999 * moments[1] + 0.001 * gradient ** 2
        step = 0.1 * (moments[0] / (1 - 0.9 ** n)) / (np.sqrt(moments[1] / (1 - 0.999 ** n)) + 1e-8)
        w, t = w - step[:features], np.maximum.accumulate(t - step[features:] + np.arange(top) * 1e-9)
    return w, t


def fit(labelled: DataFrame, text: str = "text", label: str = "toxic", rows: int = LABELLED_ROWS) -> Model:
    """Fit on at most ``rows`` rows, by text hash; a label over 1 is taken as a grade, 0 and 1 as no and yes.

    Only hashed features leave the executors.
    """
    chosen = labelled.select(F.col(f"`{label}`").cast("int").alias("label"), F.col(f"`{text}`").alias("text")).where(
        "text is not null and label is not null")

    def examples(batch: pa.RecordBatch) -> dict:
        made = [_example(t) for t in strings(batch.column(1))]
        return {"label": batch.column(0), "family": [f for _, f in made],
                "features": [h - (1 << 31) for h, _ in made]}

    got = arrow_map(chosen, examples, "label int, family long, features array<int>").orderBy(
        F.xxhash64("family", "features", "label"), "label").limit(rows).toArrow()
    labels = np.array(got.column("label").to_pylist(), dtype=np.int64)
    listed = got.column("features").combine_chunks()
    held = np.split(listed.flatten().to_numpy() + np.int64(1 << 31), listed.offsets.to_numpy()[1:-1])
    if not len(labels) or labels.max() <= 0 or labels.min() > 0:
        return Model({}, np.zeros(0))
    _, family, members = np.unique(np.array(got.column("family").to_pylist()), return_inverse=True, return_counts=True)
    weight = 1.0 / members[family]

    vocabulary, index = np.unique(np.concatenate(held), return_inverse=True)
    size = [len(x) for x in held]
    per_row = np.split(index, np.cumsum(size)[:-1])
    owner = np.repeat(np.arange(len(held)), size)
    yes = labels > 0
    a = np.bincount(index, weights=(weight * yes)[owner], minlength=len(vocabulary))
    c = np.bincount(index, weights=(weight * ~yes)[owner], minlength=len(vocabulary))
    n_yes, n_no = (weight * yes).sum(), (weight * ~yes).sum()
    b, d, n = n_yes - a, n_no - c, n_yes + n_no
    chi2 = n * (a * d - b * c) ** 2 / np.maximum((a + b) * (c + d) * (a + c) * (b + d), 1e-9)
    use = (chi2 >= LEAST_CHI2) & (a + c >= LEAST_FAMILIES)
    place = np.cumsum(use) - 1
    features = [place[r[use[r]]] for r in per_row]
    grades = labels
    if labels.max() == 1:
        telling = use & (a / n_yes > c / n_no)
        count = np.array([telling[r].sum() for r in per_row])
        grades = np.where(yes, np.maximum(1, np.searchsorted(GRADE_AT, count, side="right")), 0)
    w, t = fit_ordinal(features, grades, weight, int(use.sum()))
    return Model({int(h): float(x) for h, x in zip(vocabulary[use], w)}, t)


def _severities(model: Model, known: dict, texts: list[str | None]) -> np.ndarray:
    """Expected severity of each text; ``known`` remembers which weighted words a token holds."""
    if not len(model.thresholds):
        return np.zeros(len(texts))
    score = np.zeros(len(texts))
    weights = model.weights
    for i, t in enumerate(texts):
        if len(known) > MEMORY:
            known.clear()
        present: dict[str, float] = {}
        for token in set((t or "").lower().split()):
            held = known.get(token)
            if held is None:
                held = known[token] = tuple((w, weights[h]) for w in _WORD.findall(token)
                                            if (h := word_hash(w)) in weights)
            if held:
                present.update(held)
        score[i] = sum(sorted(present.values()))  # in one order, whatever order the words came in
    return model.severity(score)


def score(docs: DataFrame, model: Model, text: str = "text", reject_from: float = REJECT_FROM) -> DataFrame:
    """``docs`` with severity (expected grade, double), grade (nearest, int) and rejected.

    Null and empty texts have no features and get the model's base severity; a model
    fitted on no or one kind of label gives 0. Rows are independent; repeated rows get
    equal results. Input columns severity, grade and rejected are replaced.
    """
    names = [c for c in docs.columns if c.lower() not in ("severity", "grade", "rejected")]
    kept = docs.select(*[F.col(f"`{c}`") for c in names])
    shared = docs.sparkSession.sparkContext.broadcast((vars(model), {}))
    at = names.index(text)

    def rows(batch: pa.RecordBatch) -> dict:
        model, known = Model(**shared.value[0]), shared.value[1]
        s = _severities(model, known, strings(batch.column(at)))
        return dict(zip(names, batch.columns)) | {
            "severity": pa.array(s), "grade": pa.array(np.rint(s).astype(np.int32)),
            "rejected": (s >= reject_from).tolist()}

    return arrow_map(kept, rows, StructType(kept.schema.fields + [
        StructField("severity", DoubleType()), StructField("grade", IntegerType()),
        StructField("rejected", BooleanType())]))
