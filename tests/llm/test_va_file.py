import math
import random

import duckdb
import pytest

from quillsieve.llm import va_file


def brute(rows, k=20):
    good = [(i, [math.floor(64 * float(x)) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = set()
    for q, a in {(i, tuple(v)) for i, v in good if i % 20 == 0}:
        scored = sorted(((-sum(x * y for x, y in zip(a, b, strict=True)), i) for i, b in good if i != q and len(b) == len(a)))[:k]
        out |= {(q, r, i, -s) for r, (s, i) in enumerate(scored, 1)}
    return out


def found(spark, folder, rows):
    df = spark.createDataFrame([(i, v, 0) for i, v in rows], "vec_id long, embedding array<float>, label int")
    got = va_file.op9_exact_topk(spark, folder(embeddings=df)).collect()
    return sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in got)


def test_same_rows_as_sql(spark):
    con = duckdb.connect()
    con.execute("CREATE VIEW embeddings AS SELECT * FROM '/root/testdata/sf0.01/embeddings.parquet'")
    want = con.execute(f"SELECT query_id, rank, vec_id, score FROM ({va_file.OP9_SQL}) x").fetchall()
    got = va_file.op9_exact_topk(spark, "/root/testdata/sf0.01").collect()
    assert sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in got) == sorted(want)


@pytest.mark.parametrize("scale", [0.05, 1.0, 500.0])
def test_random_vectors_and_ties(spark, folder, monkeypatch, scale):
    monkeypatch.setattr(va_file, "BLOCK_ROWS", 64)
    rng = random.Random(1)
    rows = [(i, [float(rng.choice([-1, 0, 1, rng.gauss(0, 1)])) * scale for _ in range(8)]) for i in range(400)]
    rows += [(1000 + i, rows[7][1]) for i in range(60)]
    rows = [(i, [float(f) for f in __import__("numpy").array(v, dtype="float32")]) for i, v in rows]
    assert set(found(spark, folder, rows)) == brute(rows)


def test_odd_vectors(spark, folder):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.5]), (20, None), (40, [nan, 1.0]), (60, [inf, 1.0]), (80, [None, 1.0]), (None, [1.0, 1.0]), (1, [0.25, 0.25]), (2, [1.0, 2.0, 3.0]), (3, [-1.0, 0.0]), (100, [1.0, 1.0, 1.0]), (4, []), (120, [])]
    got = found(spark, folder, rows)
    assert set(got) == brute(rows) and {g[0] for g in got} == {0, 100, 120}


def test_repeated_rows_and_empty_table(spark, folder):
    rows = [(0, [1.0]), (0, [1.0]), (1, [0.5]), (1, [0.5]), (2, [0.25])]
    assert found(spark, folder, rows) == [(0, 1, 1, 2048), (0, 2, 1, 2048), (0, 3, 2, 1024)]


def test_empty_table(spark, folder):
    assert found(spark, folder, []) == []


def test_an_id_with_several_vectors_is_several_queries(spark, folder):
    rows = [(20, [1.0, 0.0]), (20, [0.0, 1.0]), (20, [0.0, 1.0]), (1, [2.0, 0.5]), (2, [0.25, 3.0]), (3, [1.0, 1.0])]
    df = spark.createDataFrame([(i, v, 0) for i, v in rows], "vec_id long, embedding array<float>, label int")
    d = folder(embeddings=df)
    got = sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in va_file.op9_exact_topk(spark, d).collect())
    first = [(20, 1, 1, 8192), (20, 2, 3, 4096), (20, 3, 2, 1024)]
    second = [(20, 1, 2, 12288), (20, 2, 3, 4096), (20, 3, 1, 2048)]
    assert got == sorted(first + second)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{d}/embeddings.parquet/*.parquet'")
    assert sorted(con.execute(f"SELECT query_id, rank, vec_id, score FROM ({va_file.OP9_SQL}) x").fetchall()) == got


def test_many_lanes_and_query_blocks(spark, folder, monkeypatch):
    monkeypatch.setattr(va_file, "BLOCK_ROWS", 16)
    monkeypatch.setattr(va_file, "QUERY_ROWS", 3)
    monkeypatch.setattr(va_file, "PACKED_QUERIES", 5)
    rng = random.Random(2)
    rows = [(i, [rng.choice([-0.5, 0.25, 1.0, 2.0]) for _ in range(3 + i % 2)]) for i in range(300)]
    assert set(found(spark, folder, rows)) == brute(rows)
