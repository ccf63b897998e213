import math
from statistics import NormalDist

import duckdb
import pytest
from pyspark.sql import functions as F

from quillsieve.llm import mixing

from .conftest import DOCS

DATA = "/root/testdata/sf0.01"


def test_same_rows_as_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{DATA}/documents.parquet'")
    names = ["doc_id", "source", "copy_no", "n_copies", "mix_key", "text"]
    want = con.execute(f"SELECT {', '.join(names)} FROM ({mixing.OP4_SQL}) x").fetchall()
    got = mixing.op4_poisson_mix(spark, DATA).select(names).collect()
    assert sorted(map(tuple, got)) == sorted(want)


def inverse(u, rate):
    k, p, total = 0, math.exp(-rate), math.exp(-rate)
    while total <= u:
        k += 1
        p *= rate / k
        total += p
    return k


def counts(spark, rate, numbers):
    df = spark.createDataFrame([(u,) for u in numbers], "u double")
    rate = F.lit(float(rate))
    return [r.k for r in df.select(mixing.poisson_count(F.col("u"), rate, mixing.poisson_start(rate)).alias("k")).collect()]


@pytest.mark.parametrize("rate", [0.01, 1.0, 7.5, 150.0, 201.0, 600.0])
def test_poisson_inverse(spark, rate):
    numbers = [1e-15, 1e-9, 0.1, 0.25, 0.5, 0.77, 0.9, 0.999, 1 - 1e-9]
    assert counts(spark, rate, numbers) == [inverse(u, rate) for u in numbers]


@pytest.mark.parametrize("rate", [3e4, 1e6, 1e9])
def test_high_rates(spark, rate):
    """Against the quantiles of the normal distribution with a correction for skewness, which are off by well under 1 here."""
    numbers = [1e-6, 0.01, 0.3, 0.5, 0.8, 0.99, 1 - 1e-6]
    z = [NormalDist().inv_cdf(u) for u in numbers]
    want = [rate + x * math.sqrt(rate) + (x * x - 1) / 6 for x in z]
    assert all(abs(k - w) <= 1 for k, w in zip(counts(spark, rate, numbers), want, strict=True))


def test_ten_thousand_single_document_sources(spark):
    """The sources' rows have a fixed size, and the mix has as many rows as asked for, a third of them from one source."""
    rows = spark.range(30_000).select(F.col("id").alias("doc_id"), F.lit("t").alias("text"), F.when(F.col("id") < 10_000, F.concat(F.lit("s"), "id")).otherwise(F.lit("hot")).alias("source"))
    out = mixing.mix(rows).groupBy((F.col("source") == "hot").alias("hot")).agg(F.count(F.lit(1)).alias("n")).collect()
    n = {r.hot: r.n for r in out}
    assert abs(n[False] - 30_000) < 900 and n[True] < 20  # each of 10,001 sources gets three rows in the mean


def test_weights_and_hot_source(spark):
    rows = [(i, f"t{i}", "en", "hot" if i % 3 else "rare", 2) for i in range(30_000)]
    out = mixing.mix(spark.createDataFrame(rows, DOCS), {"hot": 1, "rare": 3})
    counts = {r.source: r["count"] for r in out.groupBy("source").count().collect()}
    assert abs(counts["hot"] - 7_500) < 400 and abs(counts["rare"] - 22_500) < 700
    keys = [r.mix_key for r in out.select("mix_key", F.spark_partition_id().alias("p")).where("p = 0").collect()]
    assert keys == sorted(keys)


def test_many_sources_take_the_salted_join(spark, monkeypatch):
    df = spark.createDataFrame([(i, f"t{i}", "en", None if i % 5 == 0 else f"s{i % 5}", 1) for i in range(500)], DOCS)
    want = sorted((r.doc_id, r.copy_no) for r in mixing.mix(df).collect())
    monkeypatch.setattr(mixing, "BROADCAST_BYTES", -1)
    assert sorted((r.doc_id, r.copy_no) for r in mixing.mix(df).collect()) == want


def test_odd_rows(spark, odd_documents, folder):
    rows = mixing.mix(odd_documents.withColumn("Mix_Key", F.lit("old")), epochs=50.0).collect()
    assert {r.doc_id for r in rows} == {None, 1, 2, 3, 4, 5, 6, 7}
    by_id = {}
    for r in rows:
        by_id.setdefault((r.doc_id, r.copy_no), []).append(r.n_copies)
    assert all(len(v) == (2 if k[0] == 4 else 1) for k, v in by_id.items())
    assert mixing.op4_poisson_mix(spark, folder(documents=odd_documents.limit(0))).count() == 0
    assert mixing.mix(odd_documents, {"a": 1.0, None: 1.0}, epochs=50.0).where("source = 'b'").count() == 0
