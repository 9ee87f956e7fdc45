import hashlib
import zlib

import compare
import duckdb
import pytest
from pyspark.sql import functions as F

from runledger.llm import merkle
from runledger.llm.merkle import folded, manifest, path_digest
from runledger.llm.queries import ORACLE, QUERIES

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, _group string, place int"


def digest(*texts):
    return hashlib.sha256("".join(texts).encode()).hexdigest()


def leaf(row):
    values = (row[0], row[3], row[2], row[4], row[1])
    return digest(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def levels(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([digest(*out[-1][i : i + 3]) for i in range(0, len(out[-1]), 3)])
    return out


def siblings(tree, i):
    out = []
    for nodes in tree[:-1]:
        start = i - i % 3
        out.append(("".join(nodes[start:i]), "".join(nodes[i + 1 : start + 3])))
        i //= 3
    return out


def expected(rows):
    groups = {}
    for row in rows:
        groups.setdefault(row[3], []).append((row[0] is not None, row[0] or 0, leaf(row), row))
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: levels([x[2] for x in sorted(groups[s], key=lambda x: x[:3])]) for s in names}
    top = levels([trees[s][-1][0] for s in names])
    out = []
    for k, s in enumerate(names):
        for i, (_, _, own, row) in enumerate(sorted(groups[s], key=lambda x: x[:3])):
            path = siblings(trees[s], i) + siblings(top, k)
            node = own
            if row[1] and row[0] is not None and zlib.crc32(str(row[0]).encode()) % 2 == 0:
                node = leaf((row[0], row[1].replace("\n", ""), *row[2:]))
            for left, right in path:
                node = digest(left, node, right)
            proof = digest(*(a + b for a, b in path))
            out.append((row[0], own, trees[s][-1][0], top[-1][0], proof, node, node == top[-1][0]))
    return sorted(out, key=str)


def store(spark, rows, path):
    df = spark.createDataFrame([(*r, "x", 7) for r in rows], SCHEMA)
    df.write.mode("overwrite").parquet(f"{path}/documents.parquet")


ROWS = [(i, f"line {i}\nnext\n" if i % 3 else f"text {i}", "en", f"s{i % 2}", i) for i in range(40)]
ODD = [
    (None, None, None, None, None), (None, "a\nb", "en", "s0", 3), (None, "a", "en", "s0", None),
    (7, "", "", "", 0), (-5, "é\n" * 50, "fr", "Ω", -1), (2**62, "x" * 100_000, "en", "s0", 9),
    (-(2**63), "least\n", "en", "s0", 1), (63, "m\n", "en", "s1", 1), (64, "n\n", "en", "s1", 1),
    (-1, "o\n", "en", "s1", 1), (127, "p\n", "en", "zz", 1),
]


CASES = {
    "plain": ROWS,
    "odd": ROWS + ODD + ROWS[:9] * 30 + ODD[:4] * 3 + [(5, f"other {k}", "en", "s1", 1) for k in range(50)],
    "one": [(9, "alone\n", "en", "s", 1)],
    "nulls": ODD[:1] * 5,
    "groups": [(i * i * 997, f"t{i}\n", None, f"g{i % 30}", i) for i in range(120)],
}


@pytest.mark.parametrize(("case", "chunk_levels"), [*((c, 6) for c in CASES), ("odd", 1), ("groups", 1)])
def test_equals_brute_force(spark, tmp_path, monkeypatch, case, chunk_levels):
    monkeypatch.setattr(merkle, "CHUNK_LEVELS", chunk_levels)
    monkeypatch.setattr(merkle, "CHUNK", 3**chunk_levels)
    store(spark, CASES[case], tmp_path)
    found = QUERIES["op13_merkle"](spark, str(tmp_path))
    assert sorted(map(tuple, found.collect()), key=str) == expected(CASES[case])


def test_empty_table(spark, tmp_path):
    store(spark, [], tmp_path)
    assert QUERIES["op13_merkle"](spark, str(tmp_path)).collect() == []


def test_sql_of_odd_rows(spark, tmp_path):
    store(spark, ROWS + ODD[1:] + ROWS[:5], tmp_path)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    found = QUERIES["op13_merkle"](spark, str(tmp_path))
    assert compare.differences(found, con, ORACLE["op13_merkle"]) == []


def test_places_and_any_change_is_seen(spark, tmp_path):
    store(spark, ROWS, tmp_path)
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    found = manifest(docs).select("*", (folded(F.col("leaf"), F.col("path")) == F.col("root")).alias("ok"),
                                  path_digest(F.col("path")).alias("proof"))
    rows = found.collect()
    assert all(r["ok"] for r in rows)
    by_group = {}
    for r in rows:
        by_group.setdefault(r["group"], []).append((r["id"], r["place"]))
    assert all([p for _, p in sorted(x)] == list(range(20)) for x in by_group.values())
    assert len({r["proof"] for r in rows}) == len(rows)
    changed = manifest(docs.withColumn("lang", F.when(F.col("doc_id") == 17, "de").otherwise(F.col("lang"))))
    assert changed.first()["root"] != rows[0]["root"]
