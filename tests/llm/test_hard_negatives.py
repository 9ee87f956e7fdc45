import compare
import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from runledger.llm import hard_negatives as module
from runledger.llm.hard_negatives import first_of_slots, hard_negatives, limits, products, suffixes
from runledger.llm.queries import ORACLE, QUERIES

INF, NAN = float("inf"), float("nan")
SCHEMA = "vec_id bigint, embedding array<float>, label int, row string, _n int"


def table(spark, rows):
    return spark.createDataFrame([(*r, "mine", 1) for r in rows], SCHEMA)


def expected(rows, positives=5, k=10):
    used = [(n, i, [int(np.floor(256 * float(np.float32(x)))) for x in v], y)
            for n, (i, v, y) in enumerate(rows)
            if i is not None and v is not None and y is not None
            and all(x is not None and np.isfinite(x) for x in v)]
    out = []
    for a in used:
        if a[1] % 100:
            continue
        scored = sorted((-sum(x * y for x, y in zip(a[2], c[2], strict=True)), c[1], c[0], c[3])
                        for c in used if c[0] != a[0] and len(c[2]) == len(a[2]))
        for p in [s for s in scored if s[3] == a[3]][:positives]:
            fit = [n for n in scored if n[3] != a[3] and 30 * -p[0] <= 100 * -n[0] <= 90 * -p[0]]
            out += [(a[1], p[1], r, n[1], -p[0], -n[0]) for r, n in enumerate(fit[:k], start=1)]
    return sorted(out)


def run(spark, rows, **options):
    found = hard_negatives(table(spark, rows), F.col("id") % 100 == 0, **options)
    return sorted(map(tuple, found.collect()))


@pytest.mark.parametrize("blocks", [(16 << 20, 4096, 8192), (600, 7, 5)])
def test_equals_brute_force(spark, monkeypatch, blocks):
    for name, value in zip(("BLOCK_BYTES", "LEAST_ROWS", "WIDTH"), blocks, strict=True):
        monkeypatch.setattr(module, name, value)
    rng = np.random.default_rng(6)
    rows = []
    for n in range(400):
        v = rng.standard_normal(3 + n % 2)
        v = np.round(v * 2) / 4 if n % 3 else v  # many ties
        rows.append((int(n) * 25 % 1000, [float(x) for x in v], int(n % 4)))  # ids repeat
    rows += [(100, [3.0, 1.0, 1.0], 2)] * 40  # a group of copies
    odd = [(None, [1.0, 1.0, 1.0], 1), (200, None, 1), (200, [1.0, 1.0, 1.0], None),
           (200, [1.0, None, 1.0], 1), (200, [NAN, 1.0, 1.0], 1), (200, [INF, 1.0, 1.0], 1),
           (300, [], 1), (5, [], 1), (6, [], 2), (400, [0.0] * 3, 1), (401, [0.0] * 3, 2)]
    want = expected(rows + odd)
    assert run(spark, rows + odd) == want and len(want) > 1000


def test_small_tables(spark):
    assert run(spark, []) == []
    assert run(spark, [(0, [1.0], 1)]) == []
    assert run(spark, [(0, [1.0], 1), (1, [1.0], 1), (2, [0.5], 2)]) == [(0, 1, 1, 2, 65536, 32768)]
    # A negative positive score leaves an empty window.
    assert run(spark, [(0, [1.0], 1), (1, [-1.0], 1), (2, [-0.5], 2)]) == []


def test_equals_sql_on_odd_rows(spark, tmp_path):
    rng = np.random.default_rng(8)
    rows = [(int(i) * 7 % 300, [float(x) for x in rng.standard_normal(4)], int(i % 3)) for i in range(300)]
    rows += rows[:50] + [(None, [1.0] * 4, 1), (700, None, 1), (700, [1.0] * 4, None)]
    table(spark, rows).write.parquet(f"{tmp_path}/embeddings.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{tmp_path}/embeddings.parquet/*.parquet'")
    name = "op11_hard_negatives"
    assert compare.differences(QUERIES[name](spark, str(tmp_path)), con, ORACLE[name]) == []


def test_products_of_large_rows_are_exact():
    a = np.array([[2.0**40, 3.0], [1.0, -1.0], [1e300, 0.0]])
    c = np.array([[2.0**40 + 1, 1.0], [5.0, 7.0], [-1e300, 0.0]])
    found = products(a, c)
    assert found[0, 1] == 5 * 2**40 + 21 and found[1, 1] == -2
    assert found[0, 0] == module.LONG_MAX and found[2, 2] == -module.LONG_MAX - 1
    assert products(np.zeros((2, 0)), np.zeros((3, 0))).tolist() == [[0] * 3] * 2


def test_slots_and_suffixes_equal_windows():
    rng = np.random.default_rng(2)
    for _ in range(200):
        scores = rng.integers(0, 60, 40)
        ids = rng.permutation(40)
        positives = sorted(rng.integers(0, 70, 4).tolist())
        uppers = sorted({limits(p)[1] for p in positives})
        slots = np.searchsorted(uppers, scores)
        fit = np.flatnonzero(slots < len(uppers))
        kept = fit[first_of_slots(slots[fit], scores[fit], ids[fit], ids[fit], 6)]
        by_slot = [[(int(ids[i]), int(scores[i])) for i in kept if slots[i] == s] for s in range(len(uppers))]
        best = suffixes(by_slot, 6)
        for p in positives:
            low, high = limits(p)
            got = [x for x in best[uppers.index(high)] if x[1] >= low]
            plain = sorted((-int(s), int(i)) for s, i in zip(scores, ids, strict=True) if s <= high)
            assert got == [(i, -s) for s, i in plain[:6] if -s >= low]
