"""Benchmark decontamination by a distributed positional inverted index.

``build_index`` cuts the training documents into shards of bounded size. A shard holds, for
each term that a test item can ask for, the sorted positions of that term in the shard's
documents. ``search`` takes the windows of the test items and, in every shard, reads the list
of a window's rarest term (over the whole corpus), shifts it by the term's offset and intersects
it with the shifted lists of the other terms from rare to common. What is left are the exact
phrase matches; proximity matches ask that all terms occur near the rarest one.

The index is written once to the shared folder; no step shuffles a text. Test items are taken
in blocks of bounded size, so that what is broadcast does not grow with them. A document
always lies whole in one shard, which is as large as its longest document at least.

Defined results: NULL and empty texts have no words and no hits. Repeated rows are judged each
for themselves. Items that share an id count as one item; an item without an id is written as
``null``. Without items nothing is hit; without documents nothing is returned.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from runledger.llm.common import alnum_words, slices, written

WINDOW = 13
ITEM_BLOCK_BYTES = 16 << 20
POSTINGS_AT_ONCE = 1 << 21

INDEX_SCHEMA = (
    "shard long, doc_ids array<long>, text_keys array<long>, bounds binary, "
    "terms binary, counts binary, positions binary"
)
SUMMARY_SCHEMA = (
    "shard long, doc int, doc_id long, text_key long, n_words long, "
    "hits array<struct<a:int,b:int>>, items array<string>"
)
MATCH_SCHEMA = (
    "shard long, doc int, doc_id long, text_key long, item_id string, kind string, word long, span int"
)


@dataclass
class Windows:
    """Windows of one block of items. Row w of ``terms`` holds the term numbers of window w in
    order, filled up with -1; ``items`` of a window are ``owners[first[w]:first[w + 1]]``."""

    vocabulary: pa.Array
    terms: np.ndarray
    length: np.ndarray
    first: np.ndarray
    owners: np.ndarray
    names: list[str]

    @classmethod
    def of(cls, items: Sequence[tuple[str, str | None]], size: int = WINDOW) -> Windows:
        names = sorted({name for name, _ in items})
        number = {name: i for i, name in enumerate(names)}
        bounds, words = alnum_words(pa.array([text for _, text in items], pa.string()))
        encoded = words.dictionary_encode()
        ids = np.asarray(encoded.indices).astype(np.int32)
        n = np.diff(bounds)
        several = np.where(n > 0, np.maximum(1, n - size + 1), 0)
        item = np.repeat(np.arange(len(items)), several)
        if not len(item):
            nothing = np.zeros(0, np.int64)
            return cls(encoded.dictionary, np.zeros((0, size), np.int32), nothing,
                       np.zeros(1, np.int64), nothing, names)
        within = np.arange(len(item)) - np.repeat(np.cumsum(several) - several, several)
        start = (bounds[:-1][item] + within).astype(np.int32)
        rows = np.full((len(item), size), -1, np.int32)
        for k in range(size):
            there = n[item] > k  # a short item has no further words
            rows[there, k] = ids[start[there] + k]
        owners = np.array([number[name] for name, _ in items])[item]
        terms, inverse = np.unique(rows, axis=0, return_inverse=True)
        pairs = np.unique(np.stack([inverse.ravel(), owners], 1), axis=0)
        first = np.searchsorted(pairs[:, 0], np.arange(len(terms) + 1))
        return cls(encoded.dictionary, terms, (terms >= 0).sum(1), first, pairs[:, 1], names)

    def rarest_first(self, frequency: np.ndarray) -> np.ndarray:
        """Offsets of each window's terms from rare to common over the corpus."""
        cost = np.where(self.terms >= 0, frequency[np.maximum(self.terms, 0)], np.iinfo(np.int64).max)
        return np.argsort(cost, axis=1, kind="stable")


def build_index(docs: DataFrame, vocabulary: pa.Array, doc_id: str, text: str) -> DataFrame:
    """Shards of the positional inverted index over all documents, for the given terms. Words
    that no item has are counted but have no list, as no search can ask for it."""
    known = docs.sparkSession.sparkContext.broadcast(vocabulary.to_pylist())

    def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms = pa.array(known.value, pa.large_string())
        context = TaskContext.get()
        serial = itertools.count((context.partitionId() if context else 0) << 32)
        for batch in batches:
            at = 0
            for piece in slices(batch.column(2)):
                yield _shard(next(serial), batch.slice(at, len(piece)), piece, terms)
                at += len(piece)

    rows = docs.select(F.col(doc_id).cast("long").alias("d"), F.xxhash64(text).alias("k"),
                       F.col(text).alias("t"))
    return rows.mapInArrow(shards, INDEX_SCHEMA)


def _shard(number: int, rows: pa.RecordBatch, texts: pa.Array, terms: pa.Array) -> pa.RecordBatch:
    bounds, words = alnum_words(texts)
    ids = pc.fill_null(pc.index_in(words, value_set=terms), -1)
    ids = np.asarray(ids).astype(np.int32)
    # One free position between documents, so that no phrase spans two of them.
    base = bounds + np.arange(len(bounds))
    position = np.arange(len(ids)) + np.repeat(np.arange(len(texts)), np.diff(bounds))
    kept = np.flatnonzero(ids >= 0)
    kept = kept[np.argsort(ids[kept], kind="stable")]
    found, counts = np.unique(ids[kept], return_counts=True)

    def blob(x: np.ndarray) -> pa.Array:
        return pa.array([x.astype(np.int32).tobytes()], pa.binary())

    def ids_of(column: int) -> pa.Array:
        values = rows.column(column)
        return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)

    return pa.RecordBatch.from_arrays(
        [pa.array([number], pa.int64()), ids_of(0), ids_of(1), blob(base), blob(found),
         blob(counts), blob(position[kept])],
        names=[field.split()[0] for field in INDEX_SCHEMA.split(", ")],
    )


def term_frequency(index: DataFrame, terms: int) -> np.ndarray:
    """Occurrences of each term over all shards; as long as the vocabulary of one block."""

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(terms, np.int64)
        for batch in batches:
            for found, counts in zip(batch.column(0), batch.column(1), strict=True):
                at = np.frombuffer(found.as_py(), np.int32)
                total[at] += np.frombuffer(counts.as_py(), np.int32)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array(used.astype(np.int32)), pa.array(total[used])], names=["term", "n"]
        )

    parts = index.select("terms", "counts").mapInArrow(partial, "term int, n long")
    out = np.zeros(terms, np.int64)
    for row in parts.groupBy("term").agg(F.sum("n").alias("n")).collect():
        out[row["term"]] = row["n"]
    return out


class Shard:
    """One shard in memory: all postings as sorted numbers, term first and then position."""

    def __init__(self, row: dict):
        self.base = np.frombuffer(row["bounds"], np.int32).astype(np.int64)
        self.terms = np.frombuffer(row["terms"], np.int32).astype(np.int64)
        self.counts = np.frombuffer(row["counts"], np.int32).astype(np.int64)
        self.first = np.concatenate([[0], np.cumsum(self.counts)])
        self.positions = np.frombuffer(row["positions"], np.int32).astype(np.int64)
        self.keys = (np.repeat(self.terms, self.counts) << 32) + self.positions

    def candidates(self, windows: Windows, order: np.ndarray) -> Iterator[tuple]:
        """(window, position of its rarest term) for windows whose terms the shard all has, in
        bounded pieces."""
        size = len(windows.vocabulary)
        slot = np.full(size + 1, -1, np.int64)
        slot[self.terms] = np.arange(len(self.terms))
        slot[size] = 0  # stands for the filling of short windows
        # The rarest term rules out most windows; only the rest look at all terms.
        rarest = np.take_along_axis(windows.terms, order[:, :1], 1)[:, 0]
        possible = np.flatnonzero(slot[rarest] >= 0)
        own = windows.terms[possible]
        possible = possible[(slot[np.where(own >= 0, own, size)] >= 0).all(1)]
        lists = slot[rarest[possible]]
        ends = np.cumsum(self.counts[lists])
        start = 0
        while start < len(possible):
            limit = (ends[start - 1] if start else 0) + POSTINGS_AT_ONCE
            stop = max(start + 1, int(np.searchsorted(ends, limit, "right")))
            of, n = lists[start:stop], self.counts[lists[start:stop]]
            within = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            yield np.repeat(possible[start:stop], n), self.positions[np.repeat(self.first[of], n) + within]
            start = stop

    def has(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """Is there a posting between two numbers (inclusive)?"""
        at = np.searchsorted(self.keys, low)
        return (at < len(self.keys)) & (self.keys[np.minimum(at, len(self.keys) - 1)] <= high)

    def phrases(self, windows: Windows, order: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Windows that occur word for word, and where they begin."""
        found = [(np.zeros(0, np.int64), np.zeros(0, np.int64))]
        for window, position in self.candidates(windows, order):
            start = position - order[window, 0]
            for rank in range(1, windows.terms.shape[1]):
                if not len(window):
                    break
                offset = order[window, rank]
                term = windows.terms[window, offset].astype(np.int64)
                key = (term << 32) + start + offset
                good = (term < 0) | self.has(key, key)
                window, start = window[good], start[good]
            found.append((window, start))
        return tuple(map(np.concatenate, zip(*found, strict=True)))

    def near(self, windows: Windows, order: np.ndarray, span: int) -> tuple[np.ndarray, np.ndarray]:
        """Windows all of whose terms occur within ``span`` words of their rarest term, and the
        positions of that one."""
        found = [(np.zeros(0, np.int64), np.zeros(0, np.int64))]
        for window, position in self.candidates(windows, order):
            for rank in range(1, windows.terms.shape[1]):
                if not len(window):
                    break
                doc = np.searchsorted(self.base, position, "right") - 1
                term = windows.terms[window, order[window, rank]].astype(np.int64)
                low = np.maximum(position - span, self.base[doc])
                high = np.minimum(position + span, self.base[doc + 1] - 2)
                good = (term < 0) | self.has((term << 32) + low, (term << 32) + high)
                window, position = window[good], position[good]
            found.append((window, position))
        return tuple(map(np.concatenate, zip(*found, strict=True)))


def _summaries(row: dict, windows: Windows, order: np.ndarray) -> Iterator[dict]:
    """What one block of items hits in each document of a shard."""
    shard = Shard(row)
    window, start = shard.phrases(windows, order)
    length = int(shard.base[-1])
    step = np.zeros(length + 1, np.int32)
    np.add.at(step, start, 1)
    np.add.at(step, start + windows.length[window], -1)
    edge = np.diff(np.concatenate([[0], (np.cumsum(step) > 0).astype(np.int8), [0]]))
    begin, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    where = np.searchsorted(shard.base, begin, "right") - 1
    doc = np.searchsorted(shard.base, start, "right") - 1
    n = np.diff(windows.first)[window]
    at = np.repeat(windows.first[window], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    pairs = np.unique(np.stack([np.repeat(doc, n), windows.owners[at]], 1), axis=0)
    words = np.diff(shard.base) - 1
    interval = np.searchsorted(where, np.arange(len(words) + 1))
    item = np.searchsorted(pairs[:, 0], np.arange(len(words) + 1))
    for d in range(len(words)):
        hits = slice(interval[d], interval[d + 1])
        yield {
            "shard": row["shard"], "doc": d, "doc_id": row["doc_ids"][d],
            "text_key": row["text_keys"][d], "n_words": int(words[d]),
            "hits": [{"a": int(a), "b": int(b)} for a, b in zip(
                begin[hits] - shard.base[d], end[hits] - shard.base[d], strict=True)],
            "items": [windows.names[i] for i in pairs[item[d] : item[d + 1], 1]],
        }


def _matches(row: dict, windows: Windows, order: np.ndarray, span: int) -> Iterator[dict]:
    shard = Shard(row)
    found = [("phrase", *shard.phrases(windows, order), windows.length)]
    if span:
        reach = np.full(len(windows.terms), 2 * span + 1)
        found.append(("proximity", *shard.near(windows, order, span), reach))
    for kind, window, position, reach in found:
        doc = np.searchsorted(shard.base, position, "right") - 1
        for w, p, d in zip(window, position, doc, strict=True):
            for owner in windows.owners[windows.first[w] : windows.first[w + 1]]:
                yield {
                    "shard": row["shard"], "doc": int(d),
                    "doc_id": row["doc_ids"][d], "text_key": row["text_keys"][d],
                    "item_id": windows.names[owner], "kind": kind,
                    "word": int(p - shard.base[d]), "span": int(reach[w]),
                }


def _over_blocks(
    docs: DataFrame, items: DataFrame, doc_id: str, text: str, item_id: str, item_text: str,
    schema: str, per_shard, block_bytes: int, window: int,
) -> list[DataFrame]:
    """``per_shard`` over an index for each block of items. A block holds about
    ``block_bytes`` of item text, is collected by itself and is all that is broadcast. Items are
    dealt by id and text, repeated rows once, so those that share an id are not one block."""
    spark = docs.sparkSession
    named = items.where(F.col(item_text).isNotNull()).select(
        F.coalesce(F.col(item_id).cast("string"), F.lit("null")).alias("name"),
        F.col(item_text).alias("text"),
    ).distinct()
    size = named.agg(F.sum(F.octet_length("text")).alias("n")).first()["n"] or 0
    blocks = max(1, -(-size // block_bytes))
    if blocks > 1:
        # Read from files, every block cuts the same documents into the same shards.
        docs = written(docs.select(doc_id, text), "documents")
    out = []
    for i in range(blocks):
        rows = named.where(F.pmod(F.xxhash64("name", "text"), F.lit(blocks)) == i).collect()
        windows = Windows.of([(row["name"], row["text"]) for row in rows], window)
        index = written(build_index(docs, windows.vocabulary, doc_id, text), "postings")
        order = windows.rarest_first(term_frequency(index, len(windows.vocabulary)))
        shared = spark.sparkContext.broadcast((windows, order))

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for at in range(batch.num_rows):
                    found = list(per_shard(batch.slice(at, 1).to_pylist()[0], *shared.value))
                    if found:
                        yield pa.RecordBatch.from_pylist(found, schema=_arrow_schema(found))

        out.append(index.mapInArrow(run, schema))
    return out


def _arrow_schema(rows: list[dict]) -> pa.Schema:
    """Types of the two outputs, by their columns."""
    if "hits" in rows[0]:
        interval = pa.list_(pa.struct([("a", pa.int32()), ("b", pa.int32())]))
        return pa.schema([("shard", pa.int64()), ("doc", pa.int32()), ("doc_id", pa.int64()),
                          ("text_key", pa.int64()), ("n_words", pa.int64()), ("hits", interval),
                          ("items", pa.list_(pa.string()))])
    return pa.schema([("shard", pa.int64()), ("doc", pa.int32()), ("doc_id", pa.int64()),
                      ("text_key", pa.int64()), ("item_id", pa.string()),
                      ("kind", pa.string()), ("word", pa.int64()), ("span", pa.int32())])


def matches(
    docs: DataFrame, items: DataFrame, near: int = 0, window: int = WINDOW,
    doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text",
    block_bytes: int = ITEM_BLOCK_BYTES,
) -> DataFrame:
    """Every occurrence of a window of an item: phrase matches by their first word and, if
    ``near`` is given, proximity matches by the place of their rarest word, all of whose words
    lie within ``near`` words of it."""
    parts = _over_blocks(
        docs, items, doc_id, text, item_id, item_text, MATCH_SCHEMA,
        lambda row, windows, order: _matches(row, windows, order, near), block_bytes, window,
    )
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    # Texts of one item may be in several blocks and have a window in common.
    return (out.distinct() if len(parts) > 1 else out).drop("shard", "doc")


def _covered(hits: Column) -> Column:
    """Words in a sorted array of intervals, those in several counted once."""
    start = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).alias("end"))
    total = F.aggregate(
        F.array_sort(hits), start,
        lambda acc, x: F.struct(
            (acc["n"] + F.greatest(F.lit(0), x["b"] - F.greatest(x["a"], acc["end"]))).alias("n"),
            F.greatest(acc["end"], x["b"]).alias("end"),
        ),
    )
    return total["n"]


def contamination(
    docs: DataFrame, items: DataFrame, window: int = WINDOW, share: int = 20,
    doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text",
    block_bytes: int = ITEM_BLOCK_BYTES,
) -> DataFrame:
    """One row per document: ``doc_id``, ``text_key`` (hash of its text), ``n_words``, ``n_hit``
    (words inside occurrences of item windows), ``n_items``, ``items_sha256`` and
    ``contaminated`` (hit words are one in ``share`` or more)."""
    parts = _over_blocks(docs, items, doc_id, text, item_id, item_text, SUMMARY_SCHEMA,
                         _summaries, block_bytes, window)
    found = parts[0]
    if len(parts) > 1:
        # Each block has an index of its own over equal shards; documents meet by their place.
        for part in parts[1:]:
            found = found.unionByName(part)
        found = found.groupBy("shard", "doc", "doc_id", "text_key", "n_words").agg(
            F.flatten(F.collect_list("hits")).alias("hits"),
            F.array_distinct(F.flatten(F.collect_list("items"))).alias("items"),
        )
    names = F.array_sort("items")
    hit = _covered(F.col("hits"))
    return found.select(
        "doc_id", "text_key", "n_words", hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join(names, ","), 256).alias("items_sha256"),
    ).withColumn("contaminated", (F.col("n_hit") > 0) & (share * F.col("n_hit") >= F.col("n_words")))
