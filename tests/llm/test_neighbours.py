import compare
import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from runledger.llm import neighbours
from runledger.llm.neighbours import nearest
from runledger.llm.queries import ORACLE, QUERIES

INF, NAN = float("inf"), float("nan")


def product(a, b):
    """Added from the first component on; sum() of later Pythons compensates rounding."""
    total = 0.0
    for x, y in zip(a, b, strict=True):
        total += float(x) * float(y)
    return total


def expected(vectors, k):
    found = []
    for q, a in vectors.items():
        if q % 20 == 0:
            near = sorted((-product(a, b), i)
                          for i, b in vectors.items() if i != q and len(b) == len(a))
            found += [(q, rank, i, -s) for rank, (s, i) in enumerate(near[:k], start=1)]
    return sorted(found)


def run(spark, rows, k, **options):
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, v int")
    return sorted(map(tuple, nearest(df, F.col("id") % 20 == 0, k, **options).collect()))


@pytest.mark.parametrize("blocks", [(2048, 8192), (3, 17)])
def test_equals_brute_force(spark, monkeypatch, blocks):
    monkeypatch.setattr(neighbours, "CANDIDATE_BLOCK", blocks[1])
    rng = np.random.default_rng(4)
    x = rng.standard_normal((300, 16)).astype(np.float32)
    x[50:120] = x[20]  # a vector with many copies, one of them a query
    x[130] = x[131] * 1e-20
    vectors = {i: [float(v) for v in row] for i, row in enumerate(x)}
    rows = [(i, v, 0) for i, v in vectors.items()]
    bad = [(300, None, 0), (320, [0.0] * 16, 0), (340, [1.0, None] * 8, 0), (301, [NAN] * 16, 0),
           (302, [INF] + [0.0] * 15, 0), (303, [], 0), (None, vectors[0], 0)]
    found = run(spark, rows + bad, 20, query_block=blocks[0])
    want = expected(vectors, 20)
    assert [r[:3] for r in found] == [r[:3] for r in want]
    # Added from the first component on, as in the plain sum: equal to the last bit.
    assert [r[3] for r in found] == [r[3] for r in want]


def test_fewer_candidates_than_asked_for(spark):
    assert run(spark, [(0, [1.0, 0.0], 0), (1, [0.5, 0.5], 0)], 20) == [(0, 1, 1, 0.5)]
    assert run(spark, [(0, [1.0, 0.0], 0)], 20) == []
    assert run(spark, [], 20) == []


def test_repeated_ids_and_other_lengths(spark):
    rows = [(0, [1.0, 1.0], 0), (0, [1.0, 1.0], 1), (1, [2.0, 0.0], 0), (1, [1.0, 0.0], 0),
            (2, [1.0, 1.0, 1.0], 0)]
    # Two rows of id 0 are two queries, each among the other's candidates.
    one = [(0, 1, 0, 2.0), (0, 2, 1, 2.0), (0, 3, 1, 1.0)]
    assert run(spark, rows, 5) == sorted(one + one)
    assert run(spark, [(0, [1.0, 1.0], 0), (1, [1.0, 1.0, 1.0], 0)], 5) == []


def test_no_queries(spark):
    assert run(spark, [(i, [1.0, float(i)], 0) for i in range(1, 9)], 5) == []


def test_repeated_ids_equal_sql(spark, tmp_path):
    rng = np.random.default_rng(11)
    rows = [(int(i) % 37 if i % 5 else None, [float(x) for x in rng.integers(-3, 4, 3 + i % 2)], 0)
            for i in range(160)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, label int")
    df.write.parquet(f"{tmp_path}/embeddings.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{tmp_path}/embeddings.parquet/*.parquet'")
    found = QUERIES["op2_neighbours"](spark, str(tmp_path))
    assert compare.differences(found, con, ORACLE["op2_neighbours"]) == []


def test_bounds_hold():
    rng = np.random.default_rng(9)
    q, c = rng.standard_normal((40, 24)) * 5, rng.standard_cauchy((60, 24))
    (qc, qs, qn, qe), (cc, cs, cn, ce) = neighbours.quantise(q), neighbours.quantise(c)
    near = (qc.astype(float) @ cc.astype(float).T) * (qs[:, None] * cs)
    error = qn[:, None] * ce + qe[:, None] * (cn + ce)
    assert (np.abs(q @ c.T - near) <= error * (1 + 1e-9) + 1e-12).all()
