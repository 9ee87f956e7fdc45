"""Quality by ordinal regression with cumulative links.

A text is a vector of hashed byte n-grams. One weight vector, shared by all grades, gives its
place on a line; ordered thresholds cut the line into grades, so that P(grade >= k) is the
logistic function of place minus threshold k. From these tails follow the expected grade and the
probability of at least the grade that is selected for.

Weights and thresholds are trained in numpy on the driver, over a bounded sample of rated
texts; scoring runs on the executors over whole texts, one column in and one out.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from runledger.llm.common import mix64, sampled_texts, set_apart, slices

ORDERS = (1, 2, 3)
SLOTS = 1 << 14
SAMPLE_DOCS = 1500  # for each grade
SAMPLE_BYTES = 4 << 20  # for each grade
STEPS = 150
RATE = 0.05
RIDGE = 1e-4
SLICE = 1 << 19
LONGEST_PIECE = 1 << 22


def _slots(data: np.ndarray, order: int) -> np.ndarray:
    """Slots of the n-grams that begin at each byte, as far as there is one."""
    n = len(data) - order + 1
    code = np.full(max(n, 0), order, np.uint64)
    for k in range(order):
        code = (code << np.uint64(8)) | data[k : k + max(n, 0)]
    return (mix64(code) >> np.uint64(50)).astype(np.int64)


def ngram_counts(text: bytes) -> np.ndarray:
    """How often each slot occurs among the n-grams of a text. Very long texts are counted
    piece by piece, each with the bytes that its last n-grams reach into."""
    total = np.zeros(SLOTS, np.int64)
    for at in range(0, len(text), LONGEST_PIECE):
        for order in ORDERS:
            data = np.frombuffer(text[at : at + LONGEST_PIECE + order - 1], np.uint8)
            total += np.bincount(_slots(data, order), minlength=SLOTS)
    return total


def features(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Used slots and their values, the square roots of their shares: a vector of length 1, or
    nothing for an empty text."""
    counts = ngram_counts(text)
    used = np.flatnonzero(counts)
    return used, np.sqrt(counts[used] / max(1, counts.sum()))


@dataclass
class OrdinalModel:
    """``grades`` in order; ``cuts[k]`` stands between grades k and k + 1."""

    grades: list[int]
    weights: np.ndarray
    cuts: np.ndarray

    def place(self, text: bytes) -> float:
        used, value = features(text)
        return float((value * self.weights[used]).sum())

    def tails(self, place: np.ndarray) -> np.ndarray:
        """P(grade >= grades[k + 1]) for each k, by row; it falls with k."""
        return 1 / (1 + np.exp(-np.clip(place[:, None] - self.cuts[None], -40, 40)))

    def expected(self, tails: np.ndarray) -> np.ndarray:
        steps = np.diff(np.array(self.grades, np.float64))
        first = float(self.grades[0]) if self.grades else 0.0
        return first + (tails * steps[None]).sum(1)


def train(samples: list[tuple[str, int]], shares: dict[int, float] | None = None,
          steps: int = STEPS) -> OrdinalModel:
    """Model from (text, grade) pairs by Adam on the cumulative-link likelihood. ``shares`` of
    the grades undo a sample that was drawn by grade. Thresholds are a first one plus positive
    steps, so they stay in order. With fewer than two grades there is no threshold."""
    grades = sorted({g for _, g in samples})
    if len(grades) < 2:
        return OrdinalModel(grades, np.zeros(SLOTS), np.zeros(0))
    y = np.searchsorted(grades, [g for _, g in samples])
    vectors = [features(t.encode()) for t, _ in samples]
    bounds = np.concatenate([[0], np.cumsum([len(u) for u, _ in vectors])])
    slot = np.concatenate([u for u, _ in vectors]).astype(np.int64)
    value = np.concatenate([v for _, v in vectors])
    row = np.repeat(np.arange(len(samples)), np.diff(bounds))
    weight = np.ones(len(y))
    if shares:
        drawn = np.bincount(y, minlength=len(grades)) / len(y)
        wanted = np.array([shares.get(g, 0.0) for g in grades])
        weight = (wanted / drawn)[y]
    weight = weight / weight.sum()
    # theta: weights, first threshold, logarithms of the steps between thresholds
    k = len(grades) - 1
    theta = np.concatenate([np.zeros(SLOTS), [-1.0], np.zeros(k - 1)])
    mean, square = np.zeros_like(theta), np.zeros_like(theta)
    for step in range(1, steps + 1):
        w, cuts = theta[:SLOTS], _cuts(theta[SLOTS:])
        z = np.bincount(row, weights=value * w[slot], minlength=len(y))
        # P(y) is the difference of two neighbouring logistic functions.
        edges = np.concatenate([[-np.inf], cuts, [np.inf]])
        low, high = _logistic(edges[y] - z), _logistic(edges[y + 1] - z)
        p = np.maximum(high - low, 1e-12)
        d_low, d_high = low * (1 - low), high * (1 - high)
        g_z = weight * (d_high - d_low) / p
        g = np.zeros_like(theta)
        g[:SLOTS] = np.bincount(slot, weights=value * g_z[row], minlength=SLOTS) + RIDGE * w
        g_cut = np.bincount(y, weights=weight * -d_high / p, minlength=k + 1)[:k]
        g_cut += np.bincount(y, weights=weight * d_low / p, minlength=k + 1)[1:]
        later = np.cumsum(g_cut[::-1])[::-1]
        g[SLOTS] = later[0]
        g[SLOTS + 1 :] = later[1:] * np.exp(theta[SLOTS + 1 :])
        mean = 0.9 * mean + 0.1 * g
        square = 0.999 * square + 0.001 * g * g
        rate = RATE * np.sqrt(1 - 0.999**step) / (1 - 0.9**step)
        theta -= rate * mean / (np.sqrt(square) + 1e-10)
    return OrdinalModel(grades, theta[:SLOTS], _cuts(theta[SLOTS:]))


def _cuts(x: np.ndarray) -> np.ndarray:
    return x[0] + np.concatenate([[0.0], np.cumsum(np.exp(x[1:]))])


def _logistic(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def learn(
    docs: DataFrame, ratings: DataFrame, learnable: Column, doc_id: str = "doc_id",
    text: str = "text", grade: str = "grade", max_docs: int = SAMPLE_DOCS,
    max_bytes: int = SAMPLE_BYTES,
) -> OrdinalModel:
    """Model from rated rows that are ``learnable`` (a condition on ``_id``): for each grade at
    most ``max_docs`` whole texts of ``max_bytes`` together, chosen by the hash of the id. The
    shares of the grades are counted over all of them. NULL grades are left out; of several
    grades of one id the largest counts."""
    marks = (
        ratings.select(F.col(doc_id).alias("_id"), F.col(grade).cast("int").alias("_grade"))
        .where(F.col("_grade").isNotNull() & F.col("_id").isNotNull() & learnable)
        .groupBy("_id").agg(F.max("_grade").alias("_grade"))
    )
    counts = {r["_grade"]: r["count"] for r in marks.groupBy("_grade").count().collect()}
    shares = {g: n / sum(counts.values()) for g, n in counts.items()}
    rows = docs.select(F.col(doc_id).alias("_id"), F.col(text).alias("_text"))
    samples = sampled_texts(
        rows, "_id", "_text", ["_grade"], max_docs, max_bytes, per="_grade", marks=marks
    )
    return train(samples, shares)


def quality(docs: DataFrame, model: OrdinalModel, least: int, cut: float = 0.5,
            text: str = "text") -> DataFrame:
    """``docs`` with ``expected_grade``, ``tail_probability`` (of grade ``least`` or more) and
    ``selected`` (tail probability of ``cut`` or more), which replace columns of these names.

    NULL and empty texts have no n-grams and are placed at 0 on the line, like a text of
    unknown n-grams. A model of one grade gives that grade and is sure of it; one without
    grades gives NULL and selects nothing. Repeated rows agree; an empty table stays empty. Only
    the text is read, and nothing is shuffled; other columns are kept, whatever their names."""
    docs, back = set_apart(docs, text)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    # The threshold below the first grade that is at least ``least``.
    above = sum(g < least for g in model.grades)

    @F.arrow_udf("struct<grade:double,tail:double>")
    def scored(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        model = shared.value
        for batch in batches:
            places = [
                model.place(x) for piece in slices(batch, SLICE)
                for x in pc.fill_null(piece, "").cast(pa.large_binary()).to_pylist()
            ]
            tails = model.tails(np.array(places, np.float64))
            tail = np.full(len(batch), 1.0 if above == 0 else 0.0)
            if 0 < above < len(model.grades):
                tail = tails[:, above - 1]
            none = pa.array(np.full(len(batch), not model.grades))
            yield pa.StructArray.from_arrays(
                [pa.array(model.expected(tails), mask=np.asarray(none)),
                 pa.array(tail, mask=np.asarray(none))], names=["grade", "tail"],
            )

    out = docs.withColumn("_scored", scored(F.col(text)))
    return out.withColumns({
        "expected_grade": F.col("_scored.grade"),
        "tail_probability": F.col("_scored.tail"),
        "selected": F.coalesce(F.col("_scored.tail") >= cut, F.lit(False)),
    }).drop("_scored").withColumnsRenamed(back)
