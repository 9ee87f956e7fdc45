"""Modified Kneser-Ney model of symbol n-grams, counted by Spark.

An :class:`Alphabet` says what the symbols of a text are. Those of :func:`characters` are its
whole characters: every code point that the texts have is a symbol of its own, none are put
together. ``CLASSES``, for callers who want a small model, has classes of UTF-8 bytes instead:
letters without case, digits, white space, kinds of marks, and classes of the bytes beyond ASCII.
The symbols of an n-gram are packed into an integer, its hash, so no two n-grams share one. All
n-grams of all texts are counted, none is pruned.

For each order the model holds sorted arrays: hashes of the n-grams seen with log probabilities,
and hashes of contexts with log back-off weights. An n-gram is found by binary search; one not
seen falls back to the next lower order. Every task holds these arrays, so a model has at most
``MODEL_GRAMS`` n-grams. Where texts have more, :func:`probabilities` gives the same numbers as a
table, made by joins.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from runledger.llm.common import attach, slices, written

ORDER = 4  # of n-grams of classes
CHARACTER_ORDER = 5  # of n-grams of characters; less if so many do not fit PACKED bits
PACKED = 63
CODE_POINTS = 0x110000
MODEL_GRAMS = 4 << 20  # of all orders, in the arrays of a model
BITS = 6  # of a symbol
SYMBOLS = 1 << BITS
MERGE_AT = 4 << 20  # n-grams that a task gathers before it adds up equal ones
NO_DISCOUNT = (0.5, 1.0, 1.5)  # for counts whose frequencies give none


def _byte_symbols() -> np.ndarray:
    """The symbol of each byte. 0 is the start of a text and no byte's symbol."""
    table = np.zeros(256, np.uint32)
    marks = [".", ",", "'\"`", "-", "!?", ":;", "()[]{}", "#*$%&|<>"]
    for b in range(256):
        c = chr(b)
        if b >= 128:
            table[b] = 39 + b % (SYMBOLS - 39)
        elif c.isalpha():
            table[b] = 1 + ord(c.lower()) - ord("a")
        elif c.isdigit():
            table[b] = 27
        elif b == 0x20 or 0x09 <= b <= 0x0D:
            table[b] = 28
        else:
            known = [k for k, group in enumerate(marks) if c in group]
            table[b] = 29 + known[0] if known else 37 if 33 <= b <= 126 else 38
    return table


BYTE_SYMBOLS = _byte_symbols()


@dataclass(frozen=True)
class Alphabet:
    """``size`` symbols of ``bits`` bits. 0 is the start of a text and not among them. ``places``
    has the symbol of each code point; without it symbols are the classes of bytes."""

    bits: int
    size: int
    places: np.ndarray | None = None

    @property
    def order(self) -> int:
        """Of n-grams: the largest whose symbols an integer holds, ``CHARACTER_ORDER`` at most."""
        return ORDER if self.places is None else min(CHARACTER_ORDER, PACKED // self.bits)

    def symbols(self, offsets: np.ndarray, raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(offsets, symbols) of texts given as bytes."""
        if self.places is None:
            return offsets, BYTE_SYMBOLS[raw].astype(np.uint64)
        offsets, points = characters_of(offsets, raw)
        return offsets, self.places[points].astype(np.uint64)

    def tail(self, keys, k: int):
        """The last ``k`` symbols of n-grams."""
        return keys & np.uint64((1 << (self.bits * k)) - 1)


CLASSES = Alphabet(BITS, SYMBOLS - 1)


def character_alphabet(points: np.ndarray) -> Alphabet:
    """The alphabet of these code points; all others are one symbol more."""
    places = np.full(CODE_POINTS, len(points) + 1, np.uint32)
    places[np.sort(points)] = np.arange(1, len(points) + 1)
    return Alphabet((len(points) + 1).bit_length(), len(points) + 1, places)


def characters(docs: DataFrame, text_col: str = "text") -> Alphabet:
    """The alphabet of all characters of all texts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(CODE_POINTS, bool)
        for batch in batches:
            for texts in slices(batch.column(0)):
                seen[characters_of(*text_bytes(texts))[1]] = True
        yield pa.RecordBatch.from_arrays([pa.array(np.flatnonzero(seen))], ["point"])

    found = docs.where(F.col(text_col).isNotNull()).select(text_col).mapInArrow(run, "point long")
    return character_alphabet(np.array([r["point"] for r in found.distinct().collect()], np.int64))


def characters_of(offsets: np.ndarray, raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(offsets, code points) of texts given as bytes."""
    first = (raw & 0xC0) != 0x80
    if len(raw):
        first[offsets[:-1][np.diff(offsets) > 0]] = True
    upto = np.concatenate([[0], np.cumsum(first)])
    return upto[offsets], code_points(raw, np.flatnonzero(first))


def code_points(raw: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """The code points of the characters that begin at ``starts``."""
    lead = raw[starts].astype(np.int64)
    length = np.diff(np.append(starts, len(raw)))
    # The bits of the first byte that are the character's: 7, 5, 4 or 3.
    out = lead & np.array([0, 0x7F, 0x1F, 0x0F, 0x07])[np.minimum(length, 4)]
    for k in range(1, 4):
        more = np.flatnonzero(length > k)
        out[more] = (out[more] << 6) | (raw[starts[more] + k] & 0x3F)
    return np.minimum(out, CODE_POINTS - 1)  # bytes that are no UTF-8 could give more


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(offsets, bytes) of texts, NULL as empty."""
    texts = texts.fill_null("").cast(pa.large_string())
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    raw = np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8)
    return offsets - offsets[0], raw[offsets[0] : offsets[-1]]


def grams(
    offsets: np.ndarray, raw: np.ndarray, order: int = ORDER, alphabet: Alphabet = CLASSES
) -> tuple[np.ndarray, np.ndarray]:
    """(offsets, n-grams): the n-gram that ends at each symbol. Before a text stand start symbols."""
    offsets, symbols = alphabet.symbols(offsets, raw)
    before = order - 1
    lengths = np.diff(offsets)
    padded = np.zeros(len(symbols) + before * len(lengths), np.uint64)
    own = np.arange(len(symbols)) + np.repeat(before * np.arange(1, len(lengths) + 1), lengths)
    padded[own] = symbols
    out = np.zeros(len(symbols), np.uint64)
    for back in range(before, -1, -1):
        out = (out << np.uint64(alphabet.bits)) | padded[own - back]
    return offsets, out


def _added(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    keys, at = np.unique(np.concatenate([k for k, _ in parts]), return_inverse=True)
    return keys, np.bincount(at, np.concatenate([c for _, c in parts]), len(keys)).astype(np.int64)


def _count(order: int, alphabet: Alphabet):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, held = [], 0
        for batch in batches:
            for texts in slices(batch.column(0)):
                found = grams(*text_bytes(texts), order, alphabet)[1]
                parts.append(np.unique(found, return_counts=True))
                held += len(parts[-1][0])
                if held > MERGE_AT:
                    parts = [_added(parts)]
                    held = len(parts[0][0])
                    if 2 * held > MERGE_AT:
                        yield _counted(*parts.pop())
                        held = 0
        if parts:
            yield _counted(*_added(parts))

    return run


def _counted(keys: np.ndarray, counts: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(keys.astype(np.int64)), pa.array(counts)], ["gram", "n"])


def count_grams(
    docs: DataFrame, text_col: str = "text", order: int = ORDER, alphabet: Alphabet = CLASSES
) -> DataFrame:
    """(``order``, ``gram``, ``n``): how often each n-gram of the highest order occurs in all
    texts, and for lower orders after how many different symbols."""
    texts = docs.where(F.col(text_col).isNotNull()).select(text_col)
    found = texts.mapInArrow(_count(order, alphabet), "gram long, n long")
    level = written(found.groupBy("gram").agg(F.sum("n").alias("n")), "grams")
    out = level.select(F.lit(order).alias("order"), "gram", "n")
    for k in range(order - 1, 0, -1):
        tail = F.col("gram").bitwiseAND(F.lit((1 << (alphabet.bits * k)) - 1)).alias("gram")
        level = level.groupBy(tail).agg(F.count("*").alias("n"))
        out = out.unionByName(level.select(F.lit(k).alias("order"), "gram", "n"))
    return out


def discounts(n: list[int]) -> np.ndarray:
    """What is taken from counts of 0, 1, 2 and at least 3, if ``n`` counts are 1, 2, 3 and 4."""
    if all(n):
        y = n[0] / (n[0] + 2 * n[1])
        d = [k - (k + 1) * y * n[k] / n[k - 1] for k in range(1, 4)]
        if all(0 <= x <= k for k, x in enumerate(d, start=1)):
            return np.array([0.0, *d])
    return np.array([0.0, *NO_DISCOUNT])


@dataclass(frozen=True)
class Model:
    """Sorted hashes and log2 values of n-grams and contexts, one array for each order."""

    grams: list[np.ndarray]
    log_p: list[np.ndarray]
    contexts: list[np.ndarray]
    log_weight: list[np.ndarray]
    alphabet: Alphabet = CLASSES

    def log2(self, keys: np.ndarray) -> np.ndarray:
        """Log2 probability of the last symbol of each n-gram of the highest order."""
        out = np.zeros(len(keys))
        left = np.arange(len(keys))
        keys = keys.astype(np.uint64)
        for k in range(len(self.grams), 0, -1):
            keys = self.alphabet.tail(keys, k)
            at, seen = find(self.grams[k - 1], keys)
            out[left[seen]] += self.log_p[k - 1][at[seen]]
            keys, left = keys[~seen], left[~seen]
            at, seen = find(self.contexts[k - 1], keys >> np.uint64(self.alphabet.bits))
            out[left[seen]] += self.log_weight[k - 1][at[seen]]
        out[left] -= np.log2(self.alphabet.size)
        return out

    def bits(self, offsets: np.ndarray, raw: np.ndarray) -> np.ndarray:
        """Bits of all symbols of each text."""
        offsets, keys = grams(offsets, raw, len(self.grams), self.alphabet)
        lengths = np.diff(offsets)
        of = np.repeat(np.arange(len(lengths)), lengths)
        # A text has most of its n-grams in common with others: each is looked up once.
        keys, at = np.unique(keys, return_inverse=True)
        return -np.bincount(of, self.log2(keys)[at], len(lengths))


def find(known: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where sorted ``known`` values would hold ``keys``, and whether they do."""
    if not len(known):
        return np.zeros(len(keys), np.int64), np.zeros(len(keys), bool)
    at = np.minimum(np.searchsorted(known, keys), len(known) - 1)
    return at, known[at] == keys


def estimate(counted: dict[int, tuple[np.ndarray, np.ndarray]], alphabet: Alphabet = CLASSES) -> Model:
    """Interpolated modified Kneser-Ney probabilities from (sorted n-grams, counts) by order."""
    model = Model([], [], [], [], alphabet)
    lower = None
    for k in range(1, max(counted, default=ORDER) + 1):
        keys, counts = counted.get(k, (np.zeros(0, np.uint64), np.zeros(0, np.int64)))
        d = discounts([np.count_nonzero(counts == c) for c in range(1, 5)])
        taken = d[np.minimum(counts, 3)]
        contexts, of = np.unique(keys >> np.uint64(alphabet.bits), return_inverse=True)
        total = np.bincount(of, counts, len(contexts))
        weight = np.bincount(of, taken, len(contexts)) / np.maximum(total, 1)
        if lower is None:
            below = np.full(len(keys), 1 / alphabet.size)
        else:
            # The tail of an n-gram that was seen was seen too.
            below = lower[np.searchsorted(model.grams[-1], alphabet.tail(keys, k - 1))]
        lower = (counts - taken) / np.maximum(total[of], 1) + weight[of] * below
        model.grams.append(keys)
        model.log_p.append(np.log2(lower))
        model.contexts.append(contexts)
        # A weight of nothing would make unseen symbols impossible.
        model.log_weight.append(np.log2(np.maximum(weight, 1e-9)))
    return model


def gathered(counts: DataFrame, order: int, alphabet: Alphabet = CLASSES) -> Model:
    """The model of counted n-grams, which reach the driver as arrays."""
    table = counts.toArrow()
    orders = np.asarray(table.column("order").combine_chunks())
    keys = np.asarray(table.column("gram").combine_chunks()).astype(np.uint64)
    times = np.asarray(table.column("n").combine_chunks())
    out = {}
    for k in range(1, order + 1):
        at = np.flatnonzero(orders == k)
        at = at[np.argsort(keys[at])]
        out[k] = (keys[at], times[at])
    return estimate(out, alphabet)


def learn(
    docs: DataFrame, text_col: str = "text", order: int = ORDER, alphabet: Alphabet = CLASSES
) -> Model:
    """The model of all texts, which must have few n-grams: of classes there are SYMBOLS **
    ORDER = 2 ** 24 at most."""
    return gathered(count_grams(docs, text_col, order, alphabet), order, alphabet)


def probabilities(counts: DataFrame, order: int, alphabet: Alphabet = CLASSES) -> DataFrame:
    """(``gram``, ``log_p``) of counted n-grams of the highest order: what :func:`estimate` gives,
    for any number of them."""
    p = None
    for k in range(1, order + 1):
        level = counts.where(F.col("order") == k).select("gram", "n")
        few = {r["n"]: r["count"] for r in level.where("n <= 4").groupBy("n").count().collect()}
        d = discounts([few.get(c, 0) for c in range(1, 5)])
        taken = F.get(F.array(*(F.lit(float(x)) for x in d)), F.least("n", F.lit(3)).cast("int"))
        level = level.withColumns({"taken": taken, "context": F.shiftright("gram", alphabet.bits)})
        totals = level.groupBy("context").agg(
            F.sum("n").alias("total"), (F.sum("taken") / F.sum("n")).alias("weight")
        )
        level = attach(level, written(totals, "contexts"), ["context"], ["gram"], "inner")
        if p is None:
            level = level.withColumn("below", F.lit(1 / alphabet.size))
        else:
            tail = F.col("gram").bitwiseAND(F.lit((1 << (alphabet.bits * (k - 1))) - 1))
            below = p.select(F.col("gram").alias("tail"), F.col("p").alias("below"))
            level = attach(level.withColumn("tail", tail), below, ["tail"], ["gram"], "inner")
        own = (F.col("n") - F.col("taken")) / F.col("total") + F.col("weight") * F.col("below")
        p = written(level.select("gram", own.alias("p")), "probabilities")
    return p.select("gram", F.log2("p").alias("log_p"))


def row_grams(order: int, alphabet: Alphabet = CLASSES):
    """For mapInArrow: of (number, text) rows each different n-gram (``row``, ``gram``, ``n``)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = 0
            for texts in slices(batch.column(1)):
                rows = np.asarray(batch.column(0).slice(at, len(texts))).astype(np.int64)
                at += len(texts)
                offsets, keys = grams(*text_bytes(texts), order, alphabet)
                for row, a, b in zip(rows.tolist(), offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
                    own, n = np.unique(keys[a:b], return_counts=True)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(own), row)), pa.array(own.astype(np.int64)), pa.array(n)],
                        ["row", "gram", "n"],
                    )

    return run
