"""Toxicity by a convolutional text classifier.

A word is the sum of two hashed embeddings, of itself and of its beginning. Filters of several
widths run over the words, each is pooled by its maximum over the text, and a dense layer gives
the log odds. Training is numpy on the driver, over a bounded sample of labelled texts; scoring
runs on the executors over whole texts, one column in and one out.

Because the pool passes its gradient to one place per filter and text, a step touches few
embeddings. The first dimension starts as each word's smoothed log odds in the sample, which
the first filter of width one reads; everything else starts at random.

Thresholds are calibrated by language: groups of texts with like frequent words, which are
learned from the sample (never read from a column). The executors score all labelled texts that
the weights were not fitted on, and their scores are counted by group and label, so the numbers
grow with the labels and not with the sample. A group's counts are joined by ``PRIOR`` texts of
each label that are spread like those of all groups: a small group gets about the threshold of
all, a large one its own, without a step between. The score is shifted so that 0.5 is the
threshold.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from runledger.llm.common import (
    alnum_words,
    attach,
    hash_words,
    sampled_texts,
    slices,
    text_column,
    written,
)
from runledger.operators.skew import fits_broadcast

WIDTHS = (1, 2, 3)
FILTERS = 8
DIMENSIONS = 8
WORD_SLOTS = 1 << 16
HEAD_SLOTS = 1 << 14
HEAD = 4  # characters of a word's beginning
PAD = max(WIDTHS) - 1  # empty words after each text, so that all filters fit
AT_ONCE = 1 << 17  # words whose filter values are in memory together
TEXTS = 256  # texts of a sample that are looked at together

SAMPLE_DOCS = 4000  # for each label
SAMPLE_BYTES = 12 << 20  # for each label
EPOCHS = 6
BATCH = 64
RATE = 0.01
CALIBRATION_SHARE = 5  # one text in so many
SUPPORT = 8  # texts of each label that those fitted on count as when thresholds are set
PRIOR = 40  # texts of each label, spread like all, that a group's scores are joined by
GROUPS = 8  # groups of texts, at most
GROUP_WORDS = 256  # frequent words that groups are told by
ROUNDS = 15  # of k-means
LIMIT, FINE = 40, 32  # scores count from -LIMIT to LIMIT, in steps of 1 / FINE
BINS = 2 * LIMIT * FINE + 1


@dataclass
class Words:
    """Texts as slots of words and of their beginnings, with ``PAD`` empty words after each."""

    word: np.ndarray
    head: np.ndarray
    bounds: np.ndarray

    @classmethod
    def of(cls, texts: pa.Array) -> Words:
        bounds, words = alnum_words(texts)
        encoded = words.dictionary_encode()
        distinct, index = encoded.dictionary, np.asarray(encoded.indices)
        word = (hash_words(distinct) % np.uint64(WORD_SLOTS)).astype(np.int32)
        heads = pc.utf8_slice_codeunits(distinct, 0, HEAD)
        head = (hash_words(heads) % np.uint64(HEAD_SLOTS)).astype(np.int32)
        base = bounds + PAD * np.arange(len(bounds))
        place = np.arange(len(index)) + PAD * np.repeat(np.arange(len(texts)), np.diff(bounds))
        # The last slot of either table is the empty word; it stays zero.
        w, h = np.full(base[-1], WORD_SLOTS, np.int32), np.full(base[-1], HEAD_SLOTS, np.int32)
        if len(index):
            w[place], h[place] = word[index], head[index]
        return cls(w, h, base)

    @classmethod
    def of_many(cls, texts: pa.Array) -> Words:
        """The same, made of bounded pieces of the texts."""
        parts = [cls.of(piece) for piece in slices(texts)]
        sizes = np.concatenate([np.diff(part.bounds) for part in parts])
        return cls(
            np.concatenate([part.word for part in parts]),
            np.concatenate([part.head for part in parts]),
            np.concatenate([[0], np.cumsum(sizes)]),
        )

    def take(self, rows: np.ndarray) -> Words:
        n = np.diff(self.bounds)[rows]
        base = np.concatenate([[0], np.cumsum(n)])
        at = np.arange(base[-1]) + np.repeat(self.bounds[rows] - base[:-1], n)
        return Words(self.word[at], self.head[at], base)


@dataclass
class Network:
    seed: int = 5
    p: dict[str, np.ndarray] = field(default_factory=dict)
    # By group; the last is that of all, which texts without frequent words get.
    threshold: np.ndarray = field(default_factory=lambda: np.zeros(GROUPS + 1))
    column: np.ndarray | None = None  # of each slot of a word among the frequent ones, or -1
    centers: np.ndarray | None = None
    fitted_counts: np.ndarray | None = None

    def __post_init__(self):
        rng = np.random.default_rng(self.seed)

        def normal(*shape: int, scale: float) -> np.ndarray:
            return (rng.standard_normal(shape) * scale).astype(np.float32)

        self.p = {
            "word": normal(WORD_SLOTS + 1, DIMENSIONS, scale=0.05),
            "head": normal(HEAD_SLOTS + 1, DIMENSIONS, scale=0.05),
            "dense": normal(len(WIDTHS) * FILTERS, scale=0.1),
            "bias": np.zeros(1, np.float32),
        }
        for width in WIDTHS:
            self.p[f"filter{width}"] = normal(width, DIMENSIONS, FILTERS, scale=0.2)
            self.p[f"offset{width}"] = np.zeros(FILTERS, np.float32)
        self.p["word"][-1] = self.p["head"][-1] = 0

    def warm_start(self, words: Words, labels: np.ndarray, rows: np.ndarray) -> None:
        """Smoothed log odds of the label given a word, as the first dimension."""
        prior = labels[rows].mean()
        n = {name: np.zeros(len(self.p[name])) for name in ("word", "head")}
        bad = {name: np.zeros(len(self.p[name])) for name in n}
        for start in range(0, len(rows), TEXTS):
            part = words.take(rows[start : start + TEXTS])
            own = labels[rows[start : start + TEXTS]]
            text = np.repeat(np.arange(len(own)), np.diff(part.bounds))
            for name, slots in (("word", part.word), ("head", part.head)):
                # A word counts once for each text.
                pairs = np.unique(slots.astype(np.int64) * len(own) + text)
                slot, of = pairs // len(own), pairs % len(own)
                n[name] += np.bincount(slot, minlength=len(n[name]))
                bad[name] += np.bincount(slot, weights=own[of], minlength=len(n[name]))
        for name, total in n.items():
            odds = (bad[name] + 4 * prior) / (total - bad[name] + 4 * (1 - prior))
            self.p[name][:, 0] = np.clip(np.log(odds * (1 - prior) / prior), -4, 4) / 4
            self.p[name][-1] = 0
        self.p["filter1"][0, :, 0] = 0
        self.p["filter1"][0, 0, 0] = 1
        self.p["dense"][0] = 2

    def pooled(self, words: Words, places: bool = False) -> tuple[np.ndarray, np.ndarray | None]:
        """Maximum of each filter over each text and, if asked for, the first place of it.
        Memory holds the filter values of ``AT_ONCE`` words, however long a text is."""
        n, texts = len(words.word), len(words.bounds) - 1
        top = np.full((texts, len(WIDTHS) * FILTERS), -np.inf, np.float32)
        at = np.repeat(words.bounds[:-1, None], top.shape[1], axis=1) if places else None
        for start in range(0, n, AT_ONCE):
            stop, end = min(n, start + AT_ONCE), min(n, start + AT_ONCE + PAD)
            x = self.p["word"][words.word[start:end]] + self.p["head"][words.head[start:end]]
            position = np.arange(start, stop)
            text = np.searchsorted(words.bounds, position, "right") - 1
            # No text is empty, so those of a piece are consecutive.
            low, high = text[0], text[-1] + 1
            first = np.maximum(words.bounds[low:high], start) - start
            for i, width in enumerate(WIDTHS):
                rows = max(0, min(stop, n - width + 1) - start)
                y = np.zeros((stop - start, FILTERS), np.float32)
                for k in range(width):
                    y[:rows] += x[k : k + rows] @ self.p[f"filter{width}"][k]
                y += self.p[f"offset{width}"]
                # A window may reach from the padding into the next text: it does not count.
                y[position > words.bounds[text + 1] - width] = -np.inf
                here = top[low:high, i * FILTERS : (i + 1) * FILTERS]
                best = np.maximum.reduceat(y, first, axis=0)
                if places:
                    for f in range(FILTERS):
                        # The first of equal maxima in each text.
                        hit = np.flatnonzero(y[:, f] == best[text - low, f])
                        of, one = np.unique(text[hit], return_index=True)
                        new = best[of - low, f] > here[of - low, f]
                        at[of[new], i * FILTERS + f] = start + hit[one[new]]
                np.maximum(here, best, out=here)
        return top, at

    def log_odds(self, words: Words) -> np.ndarray:
        pooled, _ = self.pooled(words)
        return np.maximum(pooled, 0) @ self.p["dense"] + self.p["bias"][0]

    def gradients(self, words: Words, labels: np.ndarray, weight: np.ndarray) -> dict:
        pooled, places = self.pooled(words, places=True)
        active = np.maximum(pooled, 0)
        z = active @ self.p["dense"] + self.p["bias"][0]
        error = ((1 / (1 + np.exp(-z)) - labels) * weight / len(labels)).astype(np.float32)
        grad = {"dense": active.T @ error, "bias": np.array([error.sum()], np.float32)}
        back = error[:, None] * self.p["dense"][None] * (pooled > 0)
        rows = {"word": [], "head": []}
        x_of = self.p["word"], self.p["head"]
        for i, width in enumerate(WIDTHS):
            here = back[:, i * FILTERS : (i + 1) * FILTERS]
            grad[f"offset{width}"] = here.sum(0)
            own = np.zeros_like(self.p[f"filter{width}"])
            for f in range(FILTERS):
                at = places[:, i * FILTERS + f]
                for k in range(width):
                    # Texts too short for the filter have no gradient, but need a place.
                    one = np.minimum(at + k, len(words.word) - 1)
                    w, h = words.word[one], words.head[one]
                    own[k, :, f] = (x_of[0][w] + x_of[1][h]).T @ here[:, f]
                    step = here[:, f, None] * self.p[f"filter{width}"][k, :, f][None]
                    rows["word"].append((w, step))
                    rows["head"].append((h, step))
            grad[f"filter{width}"] = own
        for table, parts in rows.items():
            at = np.concatenate([a for a, _ in parts])
            used, inverse = np.unique(at, return_inverse=True)
            total = np.zeros((len(used), DIMENSIONS), np.float32)
            np.add.at(total, inverse, np.concatenate([s for _, s in parts]))
            total[used == len(self.p[table]) - 1] = 0
            grad[table] = (used, total)
        return grad

    def fit(self, words: Words, labels: np.ndarray, learned: np.ndarray, epochs: int = EPOCHS) -> None:
        """Adam over shuffled batches of the ``learned`` rows; embeddings that a batch does not
        use stay as they are."""
        rng = np.random.default_rng(self.seed + 1)
        share = labels[learned].mean()
        weight = np.where(labels == 1, 0.5 / max(share, 1e-6), 0.5 / max(1 - share, 1e-6))
        mean = {k: np.zeros_like(v) for k, v in self.p.items()}
        square = {k: np.zeros_like(v) for k, v in self.p.items()}
        step = 0
        for _ in range(epochs):
            order = rng.permutation(learned)
            for at in range(0, len(order), BATCH):
                rows, step = order[at : at + BATCH], step + 1
                grad = self.gradients(words.take(rows), labels[rows], weight[rows])
                rate = RATE * np.sqrt(1 - 0.999**step) / (1 - 0.9**step)
                for name, g in grad.items():
                    used, g = g if isinstance(g, tuple) else (slice(None), g)
                    mean[name][used] = 0.9 * mean[name][used] + 0.1 * g
                    square[name][used] = 0.999 * square[name][used] + 0.001 * g * g
                    self.p[name][used] -= rate * mean[name][used] / (np.sqrt(square[name][used]) + 1e-8)

    def features(self, words: Words) -> np.ndarray:
        """Square roots of the counts of frequent words, of length one or zero."""
        texts = len(words.bounds) - 1
        column = self.column[words.word]
        at = np.flatnonzero(column >= 0)
        text = np.searchsorted(words.bounds, at, "right") - 1
        flat = np.bincount(text * GROUP_WORDS + column[at], minlength=texts * GROUP_WORDS)
        x = np.sqrt(flat.reshape(texts, GROUP_WORDS))
        return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)

    def learn_groups(self, words: Words) -> None:
        """Groups of texts by k-means over the words that most texts have."""
        texts = len(words.bounds) - 1
        uses = np.zeros(WORD_SLOTS + 1, np.int64)
        for i in range(0, texts, TEXTS):
            part = words.take(np.arange(i, min(i + TEXTS, texts)))
            text = np.repeat(np.arange(len(part.bounds) - 1), np.diff(part.bounds))
            uses += np.bincount(np.unique(part.word.astype(np.int64) * TEXTS + text) // TEXTS,
                                minlength=len(uses))
        uses[-1] = 0
        top = np.argsort(-uses, kind="stable")[:GROUP_WORDS]
        top = top[uses[top] > 0]
        self.column = np.full(WORD_SLOTS + 1, -1, np.int64)
        self.column[top] = np.arange(len(top))
        x = np.concatenate([
            self.features(words.take(np.arange(i, min(i + TEXTS, texts))))
            for i in range(0, texts, TEXTS)
        ])
        x = x[x.any(1)]
        rng, centers = np.random.default_rng(self.seed), []
        far = np.ones(len(x))
        while len(centers) < GROUPS and far.sum() > 1e-9:
            centers.append(x[rng.choice(len(x), p=far / far.sum())])
            far = np.minimum(far, np.maximum(0, 1 - x @ centers[-1]))
        if not centers:
            return
        self.centers = np.array(centers)
        for _ in range(ROUNDS):
            own = (x @ self.centers.T).argmax(1)
            for g in range(len(centers)):
                if (own == g).any():
                    total = x[own == g].sum(0)
                    self.centers[g] = total / np.linalg.norm(total)

    def groups(self, words: Words) -> np.ndarray:
        """Group of each text, ``GROUPS`` for texts without frequent words."""
        texts = len(words.bounds) - 1
        if self.centers is None:
            return np.full(texts, GROUPS)
        x = self.features(words)
        # Sums in a fixed order, so that the group does not depend on the batch.
        near = np.stack([(x * center).sum(1) for center in self.centers], 1)
        return np.where(x.any(1), near.argmax(1), GROUPS)

    def counted(self, words: Words, labels: np.ndarray) -> np.ndarray:
        """Number of texts by group, label and step of the log odds."""
        found = np.zeros((GROUPS + 1, 2, BINS), np.int64)
        group, step = np.divmod(self.places(words), BINS)
        np.add.at(found, (group, labels.astype(np.int64), step), 1)
        return found

    def places(self, words: Words) -> np.ndarray:
        """Group and step of the log odds of each text, as one number."""
        out, texts = [np.zeros(0, np.int64)], len(words.bounds) - 1
        for i in range(0, texts, TEXTS):
            part = words.take(np.arange(i, min(i + TEXTS, texts)))
            z = np.clip(self.log_odds(part).astype(np.float64), -LIMIT, LIMIT)
            out.append(self.groups(part) * BINS + np.rint((z + LIMIT) * FINE).astype(np.int64))
        return np.concatenate(out)

    def calibrate(self, counts: np.ndarray, rate: float) -> None:
        """Log odds from which a text counts as toxic, by group: where errors, weighted to a
        share ``rate`` of toxic texts, are fewest; the middle of the best range."""
        whole = counts.sum(0)
        spread = whole / np.maximum(whole.sum(1, keepdims=True), 1)

        def best(own: np.ndarray) -> float:
            share = own / np.maximum(own.sum(1, keepdims=True), 1e-12)
            # The cut stands before a step: lower toxic and higher other texts are errors.
            below = np.concatenate([np.zeros((2, 1)), np.cumsum(share, 1)], 1)
            cost = rate * below[1] + (1 - rate) * (below[0, -1] - below[0])
            at = np.flatnonzero(cost <= cost.min() + 1e-9)
            # Of several best ranges the longest counts.
            parts = np.split(at, np.flatnonzero(np.diff(at) > 1) + 1)
            part = max(parts, key=len)
            return (part[0] + part[-1] - 1) / 2 / FINE - LIMIT

        self.threshold = np.full(GROUPS + 1, best(whole))
        for g in range(GROUPS):
            if counts[g].any():
                self.threshold[g] = best(counts[g] + PRIOR * spread)

    def scores(self, texts: pa.Array) -> list[np.ndarray]:
        """Probability-like scores of texts, 0.5 at the threshold of their group."""
        words = Words.of(texts)
        z = self.log_odds(words).astype(np.float64)
        cut = self.threshold[self.groups(words)]
        return [1 / (1 + np.exp(-np.clip(z - cut, -40, 40)))]


def fitted(labels: np.ndarray) -> np.ndarray:
    """Which texts of a sample the weights are fitted on: all but every fifth of each label."""
    held = np.zeros(len(labels), bool)
    for label in np.unique(labels):
        held[np.flatnonzero(labels == label)[CALIBRATION_SHARE - 1 :: CALIBRATION_SHARE]] = True
    return ~held


def supported(counts: np.ndarray, fitted_counts: np.ndarray) -> np.ndarray:
    """``counts`` of texts that were not fitted on, with the scores of those that were as
    ``SUPPORT`` texts of each label: they tell something where there are few others and
    nothing where there are many."""
    total = fitted_counts.sum((0, 2), keepdims=True)
    return counts + SUPPORT * fitted_counts / np.maximum(total, 1)


def train(samples: list[tuple[str, int]], rate: float, epochs: int = EPOCHS) -> Network:
    """Network from (text, label) pairs; ``rate`` is the share of toxic texts to expect. With
    one label only, every text gets the same score on that label's side."""
    network = Network()
    labels = np.array([y for _, y in samples], np.float64)
    if not len(labels) or labels.min() == labels.max():
        for name in ("dense", "bias"):
            network.p[name][:] = 0
        network.threshold[:] = -2.0 if len(labels) and labels[0] == 1 else 2.0
        return network
    words = Words.of_many(pa.array([t for t, _ in samples], pa.string()))
    rows = np.flatnonzero(fitted(labels))
    network.warm_start(words, labels, rows)
    network.fit(words, labels, rows, epochs)
    network.learn_groups(words)
    others = np.flatnonzero(~fitted(labels))
    network.fitted_counts = network.counted(words.take(rows), labels[rows])
    counts = network.counted(words.take(others), labels[others])
    network.calibrate(supported(counts, network.fitted_counts), rate)
    return network


def count_scores(rows: DataFrame, network: Network, marks: DataFrame) -> np.ndarray:
    """Number of texts by group, label and step of the log odds, over all ``rows`` (columns
    ``_id`` and ``_text``) that have a label in ``marks``. Texts are scored where they are, on
    the executors. If the marks are small, those without one are left out before; else all are
    scored, and their places, not their texts, meet the marks."""
    shared = rows.sparkSession.sparkContext.broadcast(network)
    small = fits_broadcast(marks)
    if small:
        rows = rows.join(F.broadcast(marks.select("_id")), "_id", "left_semi")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [shared.value.places(Words.of(piece)) for piece in slices(batch.column(1))]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(np.concatenate(found) if found else np.zeros(0, np.int64))],
                names=["_id", "_place"],
            )

    kind = rows.schema["_id"].dataType.simpleString()
    placed = rows.select("_id", "_text").mapInArrow(run, f"_id {kind}, _place long")
    if not small:
        placed = written(placed, "places")
    met = attach(placed, marks, ["_id"], ["_place"], "inner")
    out = np.zeros((GROUPS + 1, 2, BINS), np.int64)
    for row in met.groupBy("_place", "_label").count().collect():
        group, step = divmod(row["_place"], BINS)
        out[group, row["_label"], step] = row["count"]
    return out


def learn(
    docs: DataFrame, labels: DataFrame, learnable: Column, doc_id: str = "doc_id",
    text: str = "text", label: str = "toxic", max_docs: int = SAMPLE_DOCS,
    max_bytes: int = SAMPLE_BYTES, epochs: int = EPOCHS,
) -> Network:
    """Network from the labelled rows of ``docs`` that are ``learnable`` (a condition on
    ``_id``). Weights are fitted on a sample: for each label at most ``max_docs`` whole texts of
    ``max_bytes`` together, chosen by the hash of the id. Thresholds are calibrated on all other
    rows. Labels other than 0 and 1 are left out; of several labels of one id the largest
    counts."""
    marks = (
        labels.select(F.col(doc_id).alias("_id"), F.col(label).cast("int").alias("_label"))
        .where(F.col("_label").isin(0, 1) & F.col("_id").isNotNull() & learnable)
        .groupBy("_id").agg(F.max("_label").alias("_label"))
    )
    share = marks.agg(F.avg("_label").alias("p")).first()["p"] or 0.0
    marks = written(marks, "marks")
    rows = docs.select(F.col(doc_id).alias("_id"), F.col(text).alias("_text"))
    rows = rows.where(F.col("_id").isNotNull())
    samples = sampled_texts(
        rows, "_id", "_text", ["_label", "_id"], max_docs, max_bytes, per="_label", marks=marks
    )
    network = train([(t, y) for t, y, _ in samples], share, epochs)
    if network.centers is not None:
        own = fitted(np.array([y for _, y, _ in samples], np.float64)).tolist()
        ids = sorted({i for (_, _, i), used in zip(samples, own, strict=True) if used})
        kind = marks.schema["_id"].dataType.simpleString()
        seen = docs.sparkSession.createDataFrame([(i,) for i in ids], f"_id {kind}")
        others = rows.where(F.col("_text").isNotNull()).join(F.broadcast(seen), "_id", "left_anti")
        counts = count_scores(others, network, marks)
        network.calibrate(supported(counts, network.fitted_counts), share)
    return network


def toxicity(
    docs: DataFrame, network: Network, text: str = "text", score: str = "score",
    predicted: str = "predicted",
) -> DataFrame:
    """``docs`` with ``score`` (0 to 1, higher: toxic likelier) and ``predicted`` (1 from 0.5
    on), which replace columns of these names. Only the text is read. NULL counts as an empty
    text, which gets the score of a text without words; repeated rows get equal scores and an
    empty table stays empty. No shuffle."""
    shared = docs.sparkSession.sparkContext.broadcast(network)

    @F.arrow_udf("double")
    def scored(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            columns = text_column(shared.value.scores, batch)
            yield pa.array(columns[0] if columns else np.zeros(0))

    out = docs.withColumn(score, scored(F.col(text)))
    return out.withColumn(predicted, (F.col(score) >= 0.5).cast("int"))
