import re
import zlib
from collections import Counter

from pyspark.sql import functions as F

from quillsieve.llm import shards


def held(rows, n, key="doc_id"):
    slots = {}
    for r in rows:
        slots.setdefault(r.shard, []).append(r.slot)
    assert all(0 <= s < n and sorted(v) == list(range(len(v))) for s, v in slots.items())
    assert all(r.grown_shard in (r.shard, n) for r in rows)
    where = {}
    assert all(where.setdefault(r[key], r.shard) == r.shard for r in rows)


def test_query(spark):
    d = "/root/testdata/sf0.01"
    text = {r.doc_id: r.text for r in spark.read.parquet(f"{d}/documents.parquet").collect()}
    rows = shards.op8_shard(spark, d).collect()
    assert sorted(r.doc_id for r in rows) == sorted(text)
    held(rows, 24)
    assert all(r.size == len(text[r.doc_id].encode()) + 8 and r.text_crc32 == zlib.crc32(text[r.doc_id].encode()) and r.law == "key" for r in rows)
    assert 15 < sum(r.grown_shard == 24 for r in rows) < 80


def test_odd_rows(spark, odd_documents, folder):
    rows = shards.op8_shard(spark, folder(documents=odd_documents)).collect()
    held(rows, 24)
    assert Counter(r.doc_id for r in rows)[4] == 2 and len(rows) == 9
    assert {r.doc_id: r.size for r in rows}[6] == 8


def test_empty_table_and_clashing_names(spark, odd_documents):
    assert shards.shard(odd_documents.limit(0), 3)[1].count() == 0
    _, out = shards.shard(odd_documents.withColumn("SHARD", F.lit(9)).withColumn("record", F.lit("r")).withColumn("place", F.lit(1)), 3)
    assert out.columns == ["doc_id", "text", "lang", "source", "n_chars", "record", "shard", "slot", "bucket"] and out.count() == 9


def test_hot_key_is_dealt_over_buckets_and_order_is_mixed(spark):
    df = spark.range(4000).select(F.when(F.col("id") % 3 == 0, 5).otherwise(F.col("id")).alias("doc_id"), F.lit("same").alias("text"), "id")
    path, out = shards.shard(df, 4, bucket_bytes=1_000)
    rows = out.collect()
    hot = Counter(r.bucket for r in rows if r.doc_id == 5)
    assert len({r.shard for r in rows if r.doc_id == 5}) == 1 and len(hot) >= 12 and max(hot.values()) < 300
    order = [r.id for r in sorted((r for r in rows if r.shard == 1), key=lambda r: r.slot)]
    assert order != sorted(order) and sorted(order) == sorted(set(order))
    files = {x.path.split("/")[-2] for x in spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet").load(path).select("path").collect()}
    assert files == {f"shard={i}" for i in range(4)}


def test_tasks_follow_from_the_bytes(spark, monkeypatch):
    """However the session is set, a task of the second pass gets buckets of about the same size; many buckets in one task are no harm."""
    df = spark.range(3000).select(F.col("id").alias("doc_id"), F.repeat(F.lit("x"), 992).alias("text"))
    monkeypatch.setattr(shards, "TASK_BYTES", 300_000)
    path, out = shards.shard(df, 4, bucket_bytes=20_000)
    assert len({re.search(r"part-\d+", f).group() for f in spark.read.parquet(path).inputFiles()}) >= 9
    monkeypatch.setattr(shards, "TASK_BYTES", 10**9)
    _, one = shards.shard(df, 4, bucket_bytes=4_000)
    key = lambda rows: sorted((r.doc_id, r.shard) for r in rows)
    assert one.select("bucket").distinct().count() > 180 and key(one.collect()) == key(out.collect())
