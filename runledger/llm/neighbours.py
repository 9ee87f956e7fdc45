"""Nearest neighbours by inner product: an exact block matrix join.

Query blocks meet candidate blocks in tiles. A tile multiplies int8 codes; the rounding errors
of both sides bound how far the true product can be, so most pairs are ruled out by the k-th
best lower bound of their query. The rest are computed again in double precision from the
original vectors, and each query's results are merged by heaps: within a task, then over the
tasks. Nothing is approximate in the result; the codes only save work.

A tile holds two blocks of bounded size. Queries are copied once per candidate group and
candidates once per query block; no pair leaves a tile unless it is among its query's best.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from runledger.llm.common import written

QUERY_BLOCK = 2048
CANDIDATE_BLOCK = 8192
AT_ONCE = 256  # queries of a block that are multiplied together
NEIGHBOUR = "row long, query_id long, vec_id long, score double"


def usable_vectors(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(``row``, ``id``, ``v``) of vectors that take part, their rows numbered: with an id, not
    NULL, not empty, not all zero, all components finite."""
    v = F.col("v")
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return (
        vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("v"))
        .where(F.col("id").isNotNull() & ~bad & F.exists(v, lambda x: x != 0))
        .select(F.monotonically_increasing_id().alias("row"), "id", "v")
    )


def quantise(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Codes, scale, norm of the rounded vector and norm of its error, by row. Norms are
    rounded up by a small factor, so that bounds made of them hold in floating point."""
    scale = np.abs(x).max(1) / 127
    # A scale can underflow to 0: such rows keep code 0 and their whole norm as error.
    codes = np.rint(np.divide(x, scale[:, None], out=np.zeros_like(x), where=scale[:, None] > 0))
    rounded = codes * scale[:, None]
    up = 1 + 1e-9
    return (codes.astype(np.int8), scale, np.linalg.norm(rounded, axis=1) * up,
            np.linalg.norm(x - rounded, axis=1) * up)


def exact_scores(q: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Row by row inner products in double precision, added from the first component on."""
    total = np.zeros(len(q))
    for d in range(q.shape[1]):
        total += q[:, d] * c[:, d]
    return total


def tile_best(
    q_row: np.ndarray, q: np.ndarray, c_row: np.ndarray, c_id: np.ndarray, c: np.ndarray, k: int
) -> Iterator[tuple]:
    """Each query's k best candidates of a tile, its own row left out: (query, candidates,
    scores)."""
    q_code, q_scale, q_norm, q_err = quantise(q)
    c_code, c_scale, c_norm, c_err = quantise(c)
    # Products of int8 codes add up exactly in single precision below 2^24.
    kind = np.float32 if q.shape[1] * 127 * 127 < 1 << 24 else np.float64
    c_wide = c_code.astype(kind).T
    c_all = c_norm + c_err
    for start in range(0, len(q), AT_ONCE):
        at = slice(start, start + AT_ONCE)
        near = (q_code[at].astype(kind) @ c_wide) * (q_scale[at, None] * c_scale[None])
        # |q.c - q'.c'| <= |q'| |c - c'| + |q - q'| |c|, plus what rounding can add.
        error = q_norm[at, None] * c_err[None] + q_err[at, None] * c_all[None]
        error += 1e-9 * (q_norm[at, None] + q_err[at, None]) * c_all[None]
        own = q_row[at, None] == c_row[None]
        lower = np.where(own, -np.inf, near - error)
        upper = near + error
        if lower.shape[1] > k:
            floor = np.partition(lower, -k, axis=1)[:, -k]
        else:
            floor = np.full(len(lower), -np.inf)
        for i in range(len(lower)):
            # Not "at least": a bound that overflowed must not rule anything out.
            alive = np.flatnonzero(~(upper[i] < floor[i]) & ~own[i])
            scores = exact_scores(np.broadcast_to(q[start + i], (len(alive), q.shape[1])), c[alive])
            best = np.lexsort((c_id[alive], -scores))[:k]
            yield start + i, c_id[alive][best], scores[best]


def merged(best: list[tuple[float, int]], more: Iterator[tuple[float, int]], k: int) -> list:
    """The k smallest of two sorted lists of (-score, id)."""
    out = []
    for pair in heapq.merge(best, more):
        out.append(pair)
        if len(out) == k:
            break
    return out


def _matrix(table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row numbers, ids and vectors of a part of a tile that has rows."""
    rows, ids = (np.asarray(table.column(c).combine_chunks()) for c in ("row", "id"))
    lists = table.column("v").combine_chunks()
    flat = np.asarray(lists.flatten()).astype(np.float64)
    return rows, ids, flat.reshape(len(ids), -1)


def _tile(k: int):
    def run(table: pa.Table) -> pa.Table:
        side = np.asarray(table.column("is_query"))
        queries, rest = table.filter(pa.array(side)), table.filter(pa.array(~side))
        if not queries.num_rows or not rest.num_rows:
            return _rows([], [], [])
        q_row, q_id, q = _matrix(queries)
        out: list[list] = [[] for _ in q_id]
        # A fixed order makes reruns agree; candidate blocks are taken one by one.
        rest = rest.sort_by([("id", "ascending"), ("row", "ascending")])
        for at in range(0, rest.num_rows, CANDIDATE_BLOCK):
            c_row, c_id, c = _matrix(rest.slice(at, CANDIDATE_BLOCK))
            for i, ids, scores in tile_best(q_row, q, c_row, c_id, c, k):
                out[i] = merged(out[i], zip((-scores).tolist(), ids.tolist(), strict=True), k)
        return _rows(q_row.tolist(), q_id.tolist(), out)

    return run


def _rows(q_row: list[int], q_id: list[int], best: list[list]) -> pa.Table:
    flat = [(r, q, c, -s) for r, q, pairs in zip(q_row, q_id, best, strict=True) for s, c in pairs]
    row, query, cand, score = zip(*flat, strict=True) if flat else ((), (), (), ())
    return pa.table({
        "row": pa.array(row, pa.int64()),
        "query_id": pa.array(query, pa.int64()),
        "vec_id": pa.array(cand, pa.int64()),
        "score": pa.array(score, pa.float64()),
    })


def _merge(k: int):
    def run(table: pa.Table) -> pa.Table:
        heaps: dict[tuple[int, int], list] = {}
        for r, q, c, s in zip(*(table.column(n.split()[0]).to_pylist() for n in NEIGHBOUR.split(", ")),
                              strict=True):
            # The heap's root is the worst pair that is kept.
            heap, pair = heaps.setdefault((r, q), []), (s, -c)
            if len(heap) < k:
                heapq.heappush(heap, pair)
            elif pair > heap[0]:
                heapq.heapreplace(heap, pair)
        queries, vecs, scores, ranks = [], [], [], []
        for (_, q), heap in heaps.items():
            for rank, (s, c) in enumerate(sorted(heap, reverse=True), 1):
                queries.append(q), vecs.append(-c), scores.append(s), ranks.append(rank)
        return pa.table({
            "query_id": pa.array(queries, pa.int64()), "rank": pa.array(ranks, pa.int32()),
            "vec_id": pa.array(vecs, pa.int64()), "score": pa.array(scores, pa.float64()),
        })

    return run


def nearest(
    vectors: DataFrame,
    is_query: Column,
    k: int = 20,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    query_block: int = QUERY_BLOCK,
    group_blocks: int = 1,
) -> DataFrame:
    """``query_id``, ``rank`` (from 1), ``vec_id``, ``score``: for each row that ``is_query``
    (a condition on ``id``) the ``k`` rows with the largest inner product, itself left out,
    nearest first and ties to the smaller id; all of them if there are fewer.

    Vectors are compared with those of equal length. Vectors that are NULL, empty, zero or
    not finite, and rows without an id, take no part. Rows that share an id are rows of their
    own, as queries and as candidates; only a query's own row is none of its candidates. Other
    columns are not read. ``group_blocks`` candidate blocks of ``CANDIDATE_BLOCK`` rows form the candidate side of a
    tile."""
    usable = usable_vectors(vectors, id_col, vector_col).withColumn(
        "is_query", F.coalesce(is_query, F.lit(False))
    )
    usable = written(usable.withColumn("dim", F.size("v")), "vectors")
    counts = usable.agg(F.count("*").alias("n"), F.count_if("is_query").alias("q")).first()
    q_blocks = max(1, -(-counts["q"] // query_block))
    c_groups = max(1, -(-counts["n"] // (CANDIDATE_BLOCK * group_blocks)))

    def dealt(n: int) -> Column:
        return F.pmod(F.xxhash64("row"), F.lit(n)).cast("int")

    def every(n: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))

    queries = usable.where("is_query").select(
        "dim", dealt(q_blocks).alias("qb"), every(c_groups).alias("cb"), "is_query", "row", "id", "v"
    )
    candidates = usable.select(
        "dim", every(q_blocks).alias("qb"), dealt(c_groups).alias("cb"),
        F.lit(False).alias("is_query"), "row", "id", "v",
    )
    tiles = queries.unionByName(candidates).groupBy("dim", "qb", "cb")
    found = tiles.applyInArrow(_tile(k), NEIGHBOUR)
    # Few queries per group, so that a group stays small however many tiles there are.
    groups = max(1, counts["q"] // 64)
    merged_rows = found.groupBy(F.pmod(F.xxhash64("row"), F.lit(groups)))
    return merged_rows.applyInArrow(_merge(k), "query_id long, rank int, vec_id long, score double")
