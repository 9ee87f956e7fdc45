"""N-gram Jaccard join: near-duplicate documents by the overlap of their word shingles.

Each document becomes its set of distinct 5-word shingles; documents with equal sets are one
node. Shingles are ordered rare first by a count over the whole corpus. Two sets that overlap
enough share a shingle among the first few of either (prefix filter), so only those are joined.

A prefix shingle's list, sorted by set size, gives candidate edges: the pairs that the length
and positional filters let pass or, of a long list, a chain of neighbours that connects all it
could pair. So there are a bounded number of edges per row however long a list is. Connected
components of the edges are the groups inside which sets must be compared; a large group is cut
into blocks, and blocks meet in tiles.

Most sets of a group share a passage and no more, so tiles first compare sketches, a bit or two
for each shingle: the parity of the shingles in each of a power of two of hash classes. Two sets
differ in at least as many shingles as their sketches in bits, so pairs that the sketches rule
out are no links (suffix filter). Components of the others are smaller groups, and only their
sets are sent. In a tile of sets, pairs
are generated from shared prefix shingles, pruned by the length, positional and suffix filters,
and verified once, at their first common shingle. What a tile returns is a spanning forest of
its links, never all pairs. Components of the links are the result.

Texts are read three times (counts, prefixes, sets of the compared documents) and only those of
compared documents may be shuffled. Sets are 64-bit shingle hashes; a node is known by a
128-bit hash of its set. Up to the tiles of sets half of it is enough: were two nodes to share
that half, their groups would be compared as one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from runledger.llm.common import (
    KEY,
    attach,
    document_key,
    hash_words,
    mix64,
    set_apart,
    slices,
    split_words,
    without_repeats,
    written,
)
from runledger.llm.components import components

WORDS = 5
SIMILARITY = 80  # percent
BUCKETS = 18  # log2 of the counters of shingles
NEAR = 32  # rows of a list that are compared with each other; longer lists become chains
BLOCK = 1024  # nodes of a large group that are in one block, about
BLOCK_SHINGLES = 1 << 21  # their shingles together, unless one set has more
SKETCHED = 8  # times as many nodes and shingles are in a block whose sketches are compared
ODD = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9,
                0xD6E8FEB86659FD93, 0xA0761D6478BD642F], np.uint64)
RANGES = 6  # log2 of the hash ranges of the suffix filter

FACTS = ("kind int, doc_id long, text_key long, node binary, short long, n long, sketch binary, "
         "bucket int, uses long")


def shingle_sets(texts: pa.Array, words: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """(bounds, hashes): the sorted distinct shingle hashes of text i are
    ``hashes[bounds[i]:bounds[i + 1]]``. A text with fewer words has its whole sequence as one
    shingle, one without words has none."""
    bounds, tokens = split_words(texts)
    n = np.diff(bounds)
    encoded = tokens.dictionary_encode()
    known = hash_words(encoded.dictionary)
    h = known[np.asarray(encoded.indices)] if len(tokens) else np.zeros(0, np.uint64)
    odd = _multipliers(words)
    text = np.repeat(np.arange(len(n)), n)
    within = np.arange(len(h)) - np.repeat(bounds[:-1], n)
    total = np.zeros(len(h), np.uint64)
    for k in range(words):
        total[: len(h) - k] += h[k:] * odd[k] * (within[k:] >= k)
    # A shingle begins where all its words are in the text, or at the first word of a short one.
    starts = (within + words <= n[text]) if len(h) else np.zeros(0, bool)
    short = (within == 0) & (n[text] < words) if len(h) else np.zeros(0, bool)
    for i in np.flatnonzero(short):
        m = n[text[i]]
        # The number of words is part of it: arrays, as they wrap around without a warning.
        size = np.array([m], np.uint64) * np.array([0xD1B54A32D192ED03], np.uint64)
        total[i] = ((h[i : i + m] * odd[:m]).sum(keepdims=True) + size)[0]
    at = starts | short
    value = mix64(total[at])
    cut = np.searchsorted(text[at], np.arange(len(n) + 1))
    sets = [np.unique(value[a:b]) for a, b in zip(cut[:-1], cut[1:], strict=True)]
    return np.concatenate([[0], np.cumsum([len(x) for x in sets])]).astype(np.int64), (
        np.concatenate(sets) if sets else value
    )


def _multipliers(words: int) -> np.ndarray:
    return np.concatenate([ODD, mix64(np.arange(1, 64, dtype=np.uint64)) | np.uint64(1)])[:words]


def set_hashes(bounds: np.ndarray, value: np.ndarray) -> list[bytes | None]:
    """128 bits for each set, equal for equal sets; None for an empty one."""
    n = np.diff(bounds)
    full = np.flatnonzero(n)
    out: list[bytes | None] = [None] * len(n)
    if len(full):
        a = np.add.reduceat(mix64(value ^ ODD[0]), bounds[full])
        b = np.add.reduceat(mix64(value ^ ODD[1]) * ODD[2], bounds[full]) + n[full].astype(np.uint64)
        both = np.stack([mix64(a), mix64(b)], 1)
        for i, row in zip(full.tolist(), both, strict=True):
            out[i] = row.tobytes()
    return out


def short_names(nodes: list[bytes | None]) -> pa.Array:
    """The first half of the hash of each set."""
    half = np.frombuffer(b"".join(node[:8] if node else bytes(8) for node in nodes), np.int64)
    return pa.array(half, mask=np.array([node is None for node in nodes], bool))


def sketches(bounds: np.ndarray, value: np.ndarray) -> list[bytes | None]:
    """For each set the parities of its shingles in as many classes of their last bits as the
    set has shingles, rounded up to a power of two of at least 64; None for an empty one."""
    out: list[bytes | None] = []
    for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
        size = max(64, 1 << (b - a - 1).bit_length())
        times = np.bincount((value[a:b] & np.uint64(size - 1)).astype(np.int64), minlength=size)
        out.append(np.packbits(times & 1).tobytes() if b > a else None)
    return out


def _bucket(value: np.ndarray) -> np.ndarray:
    return (value >> np.uint64(64 - BUCKETS)).astype(np.int64)


def prefix_length(n: np.ndarray, percent: int) -> np.ndarray:
    """Rarest shingles of which a set must share one with any similar set."""
    return n - -(-percent * n // 100) + 1


def rare_first(bounds: np.ndarray, value: np.ndarray, uses: np.ndarray) -> np.ndarray:
    """Each set's hashes from rare to common; ties by hash, in which they come."""
    cost, out = uses[_bucket(value)], np.empty_like(value)
    for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
        out[a:b] = value[a:b][np.argsort(cost[a:b], kind="stable")]
    return out


def _facts(words: int):
    """Of each text the node and size, and at the end of a partition its counts of shingles."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        uses = np.zeros(1 << BUCKETS, np.int64)
        for batch in batches:
            at = 0
            for piece in slices(batch.column(2)):
                rows = batch.slice(at, len(piece))
                at += len(piece)
                bounds, value = shingle_sets(piece, words)
                uses += np.bincount(_bucket(value), minlength=1 << BUCKETS)
                nodes = set_hashes(bounds, value)
                yield _fact_rows(0, len(piece), rows.column(0), rows.column(1), nodes,
                                 short_names(nodes), np.diff(bounds), sketches(bounds, value), None, None)
        used = np.flatnonzero(uses)
        yield _fact_rows(1, len(used), None, None, None, None, None, None, used, uses[used])

    return run


def _fact_rows(kind: int, size: int, *columns) -> pa.RecordBatch:
    types = [pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.binary(), pa.int32(), pa.int64()]
    names = [f.split()[0] for f in FACTS.split(", ")]
    arrays = [pa.array(np.full(size, kind, np.int32))]
    for column, kind_of in zip(columns, types, strict=True):
        arrays.append(pa.nulls(size, kind_of) if column is None else
                      column.cast(kind_of) if isinstance(column, pa.Array) else
                      pa.array(column, kind_of))
    return pa.RecordBatch.from_arrays(arrays, names=names)


def _prefixes(words: int, percent: int, shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        uses = shared.value
        for batch in batches:
            for piece in slices(batch.column(0)):
                bounds, value = shingle_sets(piece, words)
                nodes = set_hashes(bounds, value)
                # Of equal sets in a piece one is enough.
                first = {node: i for i, node in reversed(list(enumerate(nodes))) if node}
                keep = np.array(sorted(first.values()), np.int64)
                if not len(keep):
                    continue
                n = np.diff(bounds)[keep]
                ordered = rare_first(bounds, value, uses)
                p = prefix_length(n, percent)
                at = np.repeat(bounds[:-1][keep] - (np.cumsum(p) - p), p) + np.arange(p.sum())
                flat = short_names([nodes[i] for i in keep.tolist()])
                of = np.repeat(np.arange(len(keep)), p)
                place = np.arange(p.sum()) - np.repeat(np.cumsum(p) - p, p)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ordered[at].view(np.int64)), flat.take(pa.array(of)),
                     pa.array(n[of].astype(np.int32)), pa.array(place.astype(np.int32))],
                    names=["token", "node", "n", "at"],
                )

    return run


def _candidates(percent: int):
    """Edges between the sets of each token's list, which is sorted by size. In a short list all
    pairs that the length and positional filters let pass; in a long one a chain of neighbours,
    which the length filter alone may break, so there are no more than ``NEAR`` edges per row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = None
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = batch if kept is None else _joined(kept, batch)
            old = 0 if kept is None else kept.num_rows
            a, b = candidate_edges(*(np.asarray(rows.column(c)).astype(np.int64) for c in (0, 2, 3)),
                                   old, percent)
            yield pa.RecordBatch.from_arrays(
                [rows.column(1).take(pa.array(a)), rows.column(1).take(pa.array(b))], names=["a", "b"]
            )
            # The rows that the next batch can still meet.
            kept = rows.slice(max(0, rows.num_rows - NEAR - 1))

    return run


def _joined(a: pa.RecordBatch, b: pa.RecordBatch) -> pa.RecordBatch:
    return pa.Table.from_batches([a, b]).combine_chunks().to_batches()[0]


def candidate_edges(token, n, at, old: int, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of rows to compare, but for those of the first ``old`` rows with each other."""
    first, second = [], []
    size = len(token)
    for d in range(1, min(NEAR, size - 1) + 1):
        i = np.arange(max(0, old - d), size - d)
        i = i[token[i] == token[i + d]]
        if not len(i):
            break
        j = i + d
        i, j = i[100 * n[i] >= percent * n[j]], j[100 * n[i] >= percent * n[j]]
        least = -(-percent * (n[i] + n[j]) // (100 + percent))
        good = np.minimum(n[i] - at[i], n[j] - at[j]) >= least
        first.append(i[good])
        second.append(j[good])
    # A row that is further than NEAR rows from another of its list: all between are chained.
    ends = np.arange(max(old, NEAR + 1), size)
    ends = ends[token[ends - NEAR - 1] == token[ends]]
    if len(ends):
        cover = np.zeros(size + 1, np.int64)
        np.add.at(cover, ends - NEAR - 1, 1)
        np.add.at(cover, ends, -1)
        i = np.flatnonzero(np.cumsum(cover)[:size] > 0)
        i = i[100 * n[i] >= percent * n[i + 1]]
        first.append(i)
        second.append(i + 1)
    if not first:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(first), np.concatenate(second)


def _sets(words: int, shared):
    """(node, rare-first hashes) of each text, once for each task."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        uses, seen = shared.value, set()
        for batch in batches:
            for piece in slices(batch.column(0)):
                bounds, value = shingle_sets(piece, words)
                nodes = set_hashes(bounds, value)
                ordered = rare_first(bounds, value, uses)
                first = {node: i for i, node in enumerate(nodes) if node and node not in seen}
                seen.update(first)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(list(first), pa.binary()),
                     pa.array([ordered[bounds[i]:bounds[i + 1]].tobytes() for i in first.values()],
                              pa.binary())], names=["node", "hashes"],
                )

    return run


class Forest:
    """Union-find over numbers."""

    def __init__(self, size: int):
        self.parent = list(range(size))

    def find(self, x: int) -> int:
        while self.parent[x] != x:
            self.parent[x] = self.parent[self.parent[x]]
            x = self.parent[x]
        return x

    def join(self, x: int, y: int) -> bool:
        x, y = self.find(x), self.find(y)
        if x != y:
            self.parent[max(x, y)] = min(x, y)
        return x != y


def tile_links(sets: list[np.ndarray], uses: np.ndarray, side: np.ndarray, percent: int) -> list[tuple[int, int]]:
    """A spanning forest of the links between sets of a tile: all pairs if ``side`` has one
    value, those between its two values otherwise. Sets are rare-first."""
    order = sorted(range(len(sets)), key=lambda i: len(sets[i]))
    size = np.array([len(s) for s in sets], np.int64)
    prefix = prefix_length(size, percent)
    both = len(np.unique(side)) > 1
    ranges = np.zeros((len(sets), 1 << RANGES), np.int32)
    for i, s in enumerate(sets):
        ranges[i] = np.bincount((s >> np.uint64(64 - RANGES)).astype(np.int64), minlength=1 << RANGES)
    plain = [np.sort(s) for s in sets]
    forest, links = Forest(len(sets)), []
    # Only prefix shingles that several sets of the tile have are looked up.
    heads = [s[:p] for s, p in zip(sets, prefix.tolist(), strict=True)]
    found, times = np.unique(np.concatenate(heads), return_counts=True) if heads else ([], [])
    common = found[times > 1] if len(sets) else np.zeros(0, np.uint64)
    if not len(common):
        return links
    lists: dict[int, list[tuple[int, int]]] = {}
    for i in order:
        met: dict[int, tuple[int, int]] = {}
        where = np.minimum(np.searchsorted(common, heads[i]), len(common) - 1)
        for at in np.flatnonzero(common[where] == heads[i]).tolist():
            others = lists.setdefault(int(where[at]), [])
            for j, there in others:
                # Only the first common shingle of a pair counts.
                if j not in met:
                    met[j] = (at, there)
            others.append((i, at))
        mates = [j for j in met if 100 * size[j] >= percent * size[i] and not (both and side[i] == side[j])]
        if not mates:
            continue
        mates = np.array(mates)
        # Least overlap of a link: 100 * o >= percent * (a + b - o).
        least = -(-percent * (size[i] + size[mates]) // (100 + percent))
        at = np.array([met[j] for j in mates.tolist()])
        most = 1 + np.minimum(size[i] - at[:, 0], size[mates] - at[:, 1]) - 1
        good = most >= least
        # Suffix filter: sets that divide differently over the ranges of hashes overlap little.
        good &= np.minimum(ranges[i], ranges[mates]).sum(1) >= least
        for j, need in zip(mates[good].tolist(), least[good].tolist(), strict=True):
            if forest.find(i) == forest.find(j):
                continue
            a, b = (plain[i], plain[j]) if size[i] <= size[j] else (plain[j], plain[i])
            where = np.minimum(np.searchsorted(b, a), len(b) - 1)
            if int((b[where] == a).sum()) >= need:
                forest.join(i, j)
                links.append((i, j))
    return links


def sketch_pairs(size: np.ndarray, rows: list[bytes], side: np.ndarray, percent: int) -> list[tuple[int, int]]:
    """A spanning forest of the pairs that sizes and sketches do not rule out: all pairs if
    ``side`` has one value, those between its two values otherwise."""
    pairs, group = [], np.arange(len(rows))
    both = len(np.unique(side)) > 1
    width = np.array([len(row) for row in rows], np.int64)
    known = {}  # sketches of one width: their rows, by size
    for w in np.unique(width).tolist():
        at = np.flatnonzero(width == w)
        at = at[np.argsort(size[at], kind="stable")]
        known[w] = at, np.frombuffer(b"".join(rows[i] for i in at.tolist()), np.uint64).reshape(len(at), -1)
    for w, (at, bits) in known.items():
        for v, (others, more) in known.items():
            # The length filter goes by the larger set, which has the wider sketch.
            if v < w or not (100 * size[at[-1]] >= percent * size[others[0]]):
                continue
            # The classes of a narrower sketch are unions of those of a wider one.
            folded = np.bitwise_xor.reduce(more.reshape(len(others), v // w, w // 8), axis=1)
            sizes = size[others]
            for k, i in enumerate(at.tolist()):
                start = k + 1 if v == w else 0
                stop = int(np.searchsorted(sizes, 100 * size[i] // percent, side="right"))
                near = np.arange(start, stop)
                near = near[group[others[near]] != group[i]]
                if both:
                    near = near[side[others[near]] != side[i]]
                if not len(near):
                    continue
                total = size[i] + sizes[near]
                most = total - 2 * -(-percent * total // (100 + percent))
                good = others[near[np.bitwise_count(folded[near] ^ bits[k]).sum(1, dtype=np.int64) <= most]]
                # One pair for each group that is met is enough.
                for j in good[np.unique(group[good], return_index=True)[1]].tolist():
                    pairs.append((i, j))
                    group[group == group[j]] = group[i]
    return pairs


def _sketch_tiles(percent: int):
    def run(table: pa.Table) -> pa.Table:
        columns = (table.column(c).to_pylist() for c in ("short", "n", "sketch", "block"))
        rows = sorted(zip(*columns, strict=True))  # a fixed order makes reruns agree
        size, side = (np.array([row[c] for row in rows], np.int64) for c in (1, 3))
        pairs = sketch_pairs(size, [row[2] for row in rows], side, percent)
        return pa.table({
            "a": pa.array([rows[i][0] for i, _ in pairs], pa.int64()),
            "b": pa.array([rows[j][0] for _, j in pairs], pa.int64()),
        })

    return run


def _tiles(percent: int, shared):
    def run(table: pa.Table) -> pa.Table:
        columns = (table.column(c).to_pylist() for c in ("node", "hashes", "block"))
        # A set that several tasks sent is one node; a fixed order makes reruns agree.
        rows = sorted({row[0]: row for row in zip(*columns, strict=True)}.values())
        nodes = [row[0] for row in rows]
        sets = [np.frombuffer(row[1], np.uint64) for row in rows]
        side = np.array([row[2] for row in rows])
        links = tile_links(sets, shared.value, side, percent)
        return pa.table({
            "a": pa.array([nodes[i] for i, _ in links], pa.binary()),
            "b": pa.array([nodes[j] for _, j in links], pa.binary()),
        })

    return run


def near_duplicates(
    docs: DataFrame, words: int = WORDS, percent: int = SIMILARITY, doc_id: str = "doc_id",
    text: str = "text", block: int = BLOCK,
) -> DataFrame:
    """One row per document: ``doc_id``, ``text_key`` (hash of its text), ``n_shingles`` (size
    of its set), ``component_id`` (smallest id that links reach, its own included) and ``node``.

    Two documents link if 100 * intersection >= ``percent`` * union of their sets. NULL texts
    and texts without words have an empty set, link with nothing and have no node. Rows with
    equal sets are in one component, repeated rows among them; NULL ids are passed over when
    the smallest is taken. An empty table stays empty."""
    spark = docs.sparkSession
    rows = docs.select(F.col(doc_id).cast("long").alias("d"), F.xxhash64(text).alias("k"),
                       F.col(text).alias("t"))
    facts = written(rows.mapInArrow(_facts(words), FACTS), "shingle-facts")
    sketched = facts.where("kind = 0 AND node IS NOT NULL")
    owners = facts.where("kind = 0").select("doc_id", "text_key", "node", "n")
    uses = np.zeros(1 << BUCKETS, np.int64)  # the only counts that the driver sees
    for row in facts.where("kind = 1").groupBy("bucket").agg(F.sum("uses").alias("n")).collect():
        uses[row["bucket"]] = row["n"]
    shared = spark.sparkContext.broadcast(uses)

    prefixes = rows.select("t").mapInArrow(
        _prefixes(words, percent, shared), "token long, node long, n int, at int"
    )
    lists = prefixes.repartition("token").sortWithinPartitions("token", "n", "node")
    candidates = lists.mapInArrow(_candidates(percent), "a long, b long")
    groups = components(candidates.where(F.col("a") != F.col("b")))

    # Large groups are cut into blocks, and every two blocks of a group meet in a tile. Sets of
    # a block have like sizes, so tiles of blocks that the length filter rules out are left out.
    named = groups.withColumnRenamed("node", "short")
    grouped = attach(sketched, named, ["short"], ["doc_id", "text_key"], "inner")
    owned = grouped.groupBy("node").agg(
        F.min("short").alias("short"), F.min("root").alias("root"), F.min("n").alias("n"),
        F.min(F.struct("doc_id", "text_key", "sketch")).alias("one"),
    )
    members = written(owned.withColumn("grade", _grade(percent)), "group-members")
    compared = _blocked(members, SKETCHED * block, SKETCHED * BLOCK_SHINGLES)
    tiles = compared.select(
        "root", "block", "short", "n", F.col("one.sketch").alias("sketch"), F.explode(_tiles_of()).alias("tile")
    )
    finer = components(
        tiles.groupBy("root", "tile").applyInArrow(_sketch_tiles(percent), "a long, b long")
    )
    members = attach(
        members.drop("root"), finer.withColumnRenamed("node", "short"), ["short"], ["node"], "inner"
    )
    members = written(_blocked(written(members, "like-members"), block, BLOCK_SHINGLES), "blocks")
    wanted = members.select(*document_key("one.doc_id", "one.text_key")).distinct()
    keyed = rows.select("t", *document_key("d", "k"))
    compared = attach(keyed, wanted, KEY, ["t"], "left_semi")
    sets = compared.select("t").mapInArrow(_sets(words, shared), "node binary, hashes binary")
    placed = attach(sets, members, ["node"], ["hashes"], "inner")
    tiles = placed.select("root", "block", "node", "hashes", F.explode(_tiles_of()).alias("tile"))
    links = tiles.groupBy("root", "tile")
    joined = components(links.applyInArrow(_tiles(percent, shared), "a binary, b binary"))

    owners = attach(owners, joined, ["node"], ["doc_id", "text_key"], "left")
    owners = written(owners.withColumn("root", F.coalesce("root", "node")), "owners")
    least = owners.where(F.col("root").isNotNull()).groupBy("root").agg(
        F.min("doc_id").alias("component_id"), F.count("*").alias("_n")
    )
    shared_roots = written(least.where(F.col("_n") > 1).drop("_n"), "components")
    out = attach(owners, shared_roots, ["root"], ["doc_id", "text_key"], "left")
    return out.select(
        "doc_id", "text_key", F.col("n").alias("n_shingles"),
        F.coalesce("component_id", "doc_id").alias("component_id"), "root",
    )


def _grade(percent: int):
    """Sets that may link have the same or neighbouring grades of size; the step is a trifle
    larger than the length filter, against rounding."""
    step = np.log(100 / percent) if percent < 100 else np.log(2)
    return F.floor(F.log(F.col("n").cast("double")) / F.lit(float(step * (1 + 1e-6)))).cast("int")


def _blocked(members: DataFrame, block: int, shingles: int) -> DataFrame:
    """Adds the ``blocks`` of the group by grade of size, and which is ``here``: the nodes of a
    grade are dealt to its blocks by hash. A group that fits one block has no ``blocks``."""
    sizes = members.groupBy("root", "grade").agg(
        F.count("*").alias("size"), F.sum("n").alias("shingles")
    )
    blocks = F.greatest(F.ceil(F.col("size") / block), F.ceil(F.col("shingles") / shingles))
    totals = sizes.withColumn("blocks", blocks.cast("int")).groupBy("root").agg(
        F.sum("size").alias("size"), F.sum("shingles").alias("shingles"),
        F.map_from_entries(F.collect_list(F.struct("grade", "blocks"))).alias("blocks"),
    )
    large = totals.where((F.col("size") > block) | (F.col("shingles") > shingles))
    rows = attach(members, written(large.select("root", "blocks"), "group-sizes"), ["root"], ["node"], "left")
    own = F.pmod(F.xxhash64("node"), F.try_element_at("blocks", F.col("grade"))).cast("int")
    rows = rows.withColumn("here", F.struct("grade", own.alias("number")))
    name = F.when(F.col("blocks").isNull(), F.lit(0).cast("long")).otherwise(
        F.xxhash64("here.grade", "here.number")
    )
    return rows.withColumn("block", name)


def _tiles_of():
    """Names of the tiles that a node takes part in: one for each block of its group that holds
    sets of a like size, made of the names of both blocks; a single one in a small group."""
    def meeting(grade):
        def name(number):
            other = F.struct(grade.alias("grade"), number.alias("number"))
            return F.concat_ws("|", F.least(other, F.col("here")).cast("string"),
                               F.greatest(other, F.col("here")).cast("string"))

        last = F.try_element_at("blocks", grade) - 1
        return F.when(last.isNull(), F.array().cast("array<string>")).otherwise(
            F.transform(F.sequence(F.lit(0), F.coalesce(last, F.lit(0))), name)
        )

    grade = F.col("grade")
    return F.when(F.col("blocks").isNull(), F.array(F.lit("all"))).otherwise(
        F.concat(meeting(grade - 1), meeting(grade), meeting(grade + 1))
    )


def one_of_each(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """``docs`` with one document of each component: that with the smallest id (NULL last), of
    equal ids the one with the smallest hash of its text, of rows equal in both any one.
    Documents without words all stay."""
    docs, back = set_apart(docs, doc_id, text)
    found = written(near_duplicates(docs, doc_id=doc_id, text=text, **options), "duplicates")
    rows = found.where(F.col("root").isNotNull()).select("root", *document_key("doc_id", "text_key"))
    rank = F.struct(*KEY)
    groups = rows.groupBy("root").agg(F.min(rank).alias("_first"), F.count("*").alias("_n"))
    groups = written(groups.where(F.col("_n") > 1).drop("_n"), "kept-documents")
    several = written(attach(rows, groups, ["root"], KEY, "inner"), "grouped-documents")
    dropped = written(several.where(rank != F.col("_first")).select(KEY).distinct(), "dropped-documents")
    repeated = several.where(rank == F.col("_first")).groupBy(KEY).agg(F.count("*").alias("_n"))
    repeated = written(repeated.where(F.col("_n") > 1).drop("_n"), "repeated-documents")
    keyed = docs.select("*", *document_key(doc_id, F.xxhash64(text)))
    kept = attach(keyed, dropped, KEY, KEY, "left_anti")
    return without_repeats(kept, repeated).select(docs.columns).withColumnsRenamed(back)
