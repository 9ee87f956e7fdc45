"""Hard negatives of anchors by slot-decomposed selection.

An anchor's positives are its best rows of the same label. Each sets a window of scores for
rows of other labels: at most ``UPPER`` and at least ``LOWER`` hundredths of its own score. The
windows overlap, so their upper limits cut the scores into disjoint slots. A row is judged once,
in the slot that holds its score; combiners keep the first k of each slot, in each tile and then
over all tiles. A window is what lies in its own slot and those below. Going up from the lowest
slot, the best k of a slot and of the suffix below it are merged once, and each suffix answers
the window that begins there, cut at its lower limit.

Scores come from tiles of an anchor block and a candidate block of bounded size: anchors are
copied once per candidate block and candidates once per anchor block, and no pair leaves its
tile unless it is among the first k of a slot there.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from runledger.llm.common import written

UPPER, LOWER = 90, 30  # a negative's score in hundredths of the positive's
SCALE = 256
BLOCK_BYTES = 16 << 20  # of an anchor block; candidate blocks may take four times that
LEAST_ROWS = 4096  # candidates of a block, if there are so many
TASKS_EACH = 2  # candidate blocks per core, if they have so many rows
AT_ONCE, WIDTH = 128, 8192  # anchors and candidates that are multiplied together
EXACT = float(1 << 53)  # whole numbers up to here are exact in double precision
LONG_MAX = (1 << 63) - 1

FOUND = "row long, id long, slot int, cand_row long, cand_id long, score long"


def usable_rows(vectors: DataFrame, id_col: str, vector_col: str, label: Column) -> DataFrame:
    """(``row``, ``id``, ``label``, ``dim``, ``v``) of rows that take part, numbered: with an
    id, a label and a vector without NULL or non-finite components."""
    v = F.col(vector_col)
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = vectors.where(F.col(id_col).isNotNull() & label.isNotNull() & v.isNotNull() & ~bad)
    return written(rows.select(
        F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("long").alias("id"),
        label.cast("long").alias("label"), F.size(v).alias("dim"), v.alias("v"),
    ), "rows")


def _column(table: pa.Table, name: str) -> np.ndarray:
    return np.asarray(table.column(name).combine_chunks())


def _codes(table: pa.Table) -> np.ndarray:
    """Components in 256ths, rounded down: whole numbers, held as doubles."""
    lists = table.column("v").combine_chunks()
    flat = np.asarray(lists.flatten()).astype(np.float64)
    dim = int(table.column("dim")[0].as_py()) if table.num_rows else 0
    with np.errstate(over="ignore"):
        return np.floor(SCALE * flat.reshape(table.num_rows, dim))


def _whole(row: np.ndarray) -> list[int]:
    top = np.finfo(float).max
    return [int(x) for x in np.nan_to_num(row, posinf=top, neginf=-top)]


def products(a: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Exact inner products of all rows, as longs. Products of rows so large that doubles might
    round are added in whole numbers of any length; beyond a long they become the nearest one."""
    least = np.sqrt(EXACT / max(1, a.shape[1]))
    a_big, c_big = (np.abs(x).max(axis=1, initial=0.0) >= least for x in (a, c))
    out = (np.where(a_big[:, None], 0, a) @ np.where(c_big[:, None], 0, c).T).astype(np.int64)
    if a_big.any() or c_big.any():
        a_whole, c_whole = [_whole(x) for x in a], [_whole(x) for x in c]
        for i, j in zip(*np.nonzero(a_big[:, None] | c_big[None]), strict=True):
            exact = sum(x * y for x, y in zip(a_whole[i], c_whole[j], strict=True))
            out[i, j] = max(-LONG_MAX - 1, min(LONG_MAX, exact))
    return out


def limits(score: int) -> tuple[int, int]:
    """The lowest and highest score of a positive's window."""
    return -(-LOWER * score // 100), UPPER * score // 100


def first_of_slots(
    slots: np.ndarray, scores: np.ndarray, ids: np.ndarray, rows: np.ndarray, k: int
) -> np.ndarray:
    """Positions of the first k of each slot by score, then by id and row."""
    order = np.lexsort((rows, ids, -scores, slots))
    ordered = slots[order]
    rank = np.arange(len(order)) - np.searchsorted(ordered, ordered)
    return order[rank < k]


def _tile(k: int, negatives: bool):
    """Pairs of a tile: for negatives, the first k of each slot of each anchor; else the first
    k rows of the anchor's label, which its tile alone has, in slot 0."""

    def pairs(anchors: pa.Table, rest: pa.Table) -> Iterator[tuple]:
        codes = _codes(anchors)
        a_row, a_id, a_label = (_column(anchors, c) for c in ("row", "id", "label"))
        uppers = anchors.column("uppers").to_pylist() if negatives else None
        lowest = _column(anchors, "lowest") if negatives else None
        for at in range(0, rest.num_rows, WIDTH):
            part = rest.slice(at, WIDTH)
            c_row, c_id, c_label = (_column(part, c) for c in ("row", "id", "label"))
            c_codes = _codes(part)
            for start in range(0, len(a_row), AT_ONCE):
                scores = products(codes[start : start + AT_ONCE], c_codes)
                for i, own in enumerate(scores, start=start):
                    if negatives:
                        # Ascending limits: slot s holds what is above uppers[s - 1] only.
                        slots = np.searchsorted(uppers[i], own)
                        fit = (slots < len(uppers[i])) & (own >= lowest[i]) & (c_label != a_label[i])
                    else:
                        slots, fit = np.zeros(len(own), np.int64), c_row != a_row[i]
                        if len(own) > 2 * k:
                            fit &= own >= np.partition(own, -k - 1)[-k - 1]  # one may be itself
                    some = np.flatnonzero(fit)
                    best = some[first_of_slots(slots[some], own[some], c_id[some], c_row[some], k)]
                    n = len(best)
                    yield (np.full(n, a_row[i]), np.full(n, a_id[i]), slots[best], c_row[best],
                           c_id[best], own[best])

    def run(table: pa.Table) -> pa.Table:
        side = pa.array(_column(table, "is_anchor"))
        anchors, rest = table.filter(side), table.filter(pc.invert(side))
        found = list(pairs(anchors, rest)) if anchors.num_rows and rest.num_rows else []
        columns = [np.concatenate(c) for c in zip(*found, strict=True)] if found else [[]] * 6
        kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
        names = [c.split()[0] for c in FOUND.split(", ")]
        return pa.table({n: pa.array(c, t) for n, c, t in zip(names, columns, kinds, strict=True)})

    return run


def _found(anchors: DataFrame, rows: DataFrame, k: int, negatives: bool) -> DataFrame:
    """The first k of each slot of each anchor, over all tiles."""
    sized = rows.agg(F.count("*"), F.max("dim")).first()
    n, width = sized[0], 8 * max(1, sized[1] or 1) + 64
    a_blocks = max(1, -(-anchors.count() * width // BLOCK_BYTES))
    cores = rows.sparkSession.sparkContext.defaultParallelism
    c_blocks = max(-(-n * width // (4 * BLOCK_BYTES)), min(TASKS_EACH * cores, n // LEAST_ROWS), 1)

    def dealt(blocks: int) -> Column:
        return F.pmod(F.xxhash64("row"), F.lit(blocks)).cast("int")

    def every(blocks: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))

    keys = ["dim", *([] if negatives else ["label"])]
    extra = ["uppers", "lowest"] if negatives else []
    columns = ["is_anchor", "row", "id", "label", "dim", "v", *extra]
    sides = [
        anchors.withColumn("is_anchor", F.lit(True)).select(
            *columns, dealt(a_blocks).alias("ab"), every(c_blocks).alias("cb")
        ),
        rows.withColumns({
            "is_anchor": F.lit(False), "uppers": F.lit(None).cast("array<long>"),
            "lowest": F.lit(None).cast("long"),
        }).select(*columns, every(a_blocks).alias("ab"), dealt(c_blocks).alias("cb")),
    ]
    tiles = sides[0].unionByName(sides[1]).groupBy(*keys, "ab", "cb")
    # Spark ranks within its tasks before the shuffle, so few rows of a slot are moved.
    slot = Window.partitionBy("row", "slot").orderBy(F.desc("score"), "cand_id", "cand_row")
    found = tiles.applyInArrow(_tile(k, negatives), FOUND)
    return found.withColumn("rank", F.row_number().over(slot)).where(F.col("rank") <= k)


def suffixes(slots: list[list[tuple]], k: int) -> list[list[tuple]]:
    """For each slot the first k of it and of all slots below. Slots ascend, each is sorted."""
    out, below = [], []
    for own in slots:
        below = (own + below)[:k]
        out.append(below)
    return out


def _windows(k: int):
    """The first k of each positive's window, from the kept rows of its anchor's slots."""

    def run(table: pa.Table) -> pa.Table:
        rows: list[tuple] = []
        for anchor in table.to_pylist():
            uppers = anchor["uppers"]
            slots: list[list[tuple]] = [[] for _ in uppers]
            for x in sorted(anchor["kept"] or [], key=lambda x: x["rank"]):
                slots[x["slot"]].append((x["cand_id"], x["score"]))
            best = suffixes(slots, k)
            for p in anchor["positives"]:
                low, high = limits(p["score"])
                inside = [x for x in best[uppers.index(high)] if x[1] >= low]
                rows += [(anchor["id"], p["cand_id"], r, c, p["score"], s)
                         for r, (c, s) in enumerate(inside, start=1)]
        names = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
        columns = list(zip(*rows, strict=True)) if rows else [[]] * len(names)
        return pa.table({
            n: pa.array(c, pa.int32() if n == "rank" else pa.int64())
            for n, c in zip(names, columns, strict=True)
        })

    return run


def hard_negatives(
    vectors: DataFrame,
    is_anchor: Column,
    label: Column | None = None,
    positives: int = 5,
    k: int = 10,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
) -> DataFrame:
    """``anchor_id``, ``positive_id``, ``rank`` (from 1), ``negative_id``, ``positive_score``
    and ``negative_score``: for each anchor and each of its first ``positives`` other rows of
    the same label, the first ``k`` rows of other labels in the positive's window.

    A score is the inner product of vectors in 256ths, rounded down; rows are compared with rows
    of equal length, higher scores first, ties by smaller id. ``is_anchor`` is a condition on
    ``id``, ``label`` an expression over the columns of ``vectors`` (default: its column of
    that name). Rows without id, label or vector, and those with components that are NULL or
    not finite, take no part; zero and empty vectors do. Rows that share an id are rows of
    their own, as anchors, positives and negatives alike; only the very row is not its own
    positive. A positive without negatives gives no rows. Other columns are not read."""
    rows = usable_rows(vectors, id_col, vector_col, F.col("label") if label is None else label)
    anchors = rows.where(F.coalesce(is_anchor, F.lit(False)))
    near = _found(anchors, rows, positives, negatives=False)
    pair = F.struct("rank", "cand_id", "score")
    # Windows of positives with negative scores are empty: their limits are the wrong way round.
    hundredths = F.col("score").cast("decimal(20,0)")
    low, high = F.ceil(hundredths * LOWER / 100), F.floor(hundredths * UPPER / 100)
    wanted = written(near.where(F.col("score") >= 0).withColumns({
        "low": low.cast("long"), "high": high.cast("long"),
    }).groupBy("row").agg(
        F.sort_array(F.collect_list(pair)).alias("positives"),
        F.sort_array(F.collect_set("high")).alias("uppers"), F.min("low").alias("lowest"),
    ), "positives")
    mined = anchors.join(wanted.select("row", "uppers", "lowest"), "row")
    kept = _found(mined, rows, k, negatives=True).groupBy("row").agg(
        F.collect_list(F.struct("slot", "rank", "cand_id", "score")).alias("kept")
    )
    whole = anchors.select("row", "id").join(wanted, "row").join(kept, "row")
    batches = whole.select("id", "positives", "uppers", "kept")

    def windows(tables: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in tables:
            for at in range(0, batch.num_rows, 256):
                yield from _windows(k)(pa.Table.from_batches([batch.slice(at, 256)])).to_batches()

    return batches.mapInArrow(windows, (
        "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, "
        "negative_score long"
    ))
