"""Two-pass external shuffle into shards, in DataFrame operations only.

First pass: a record's shard is the one of highest seeded hash with the record's key (rendezvous hashing), so a larger
shard count takes records only into the new shards. Inside its shard a record goes to one of the buckets, drawn by a
seeded hash of its place in the input, so that buckets hold about ``bucket_bytes`` whatever keys or texts repeat.
Second pass: every bucket, which fits in memory, gets a Fisher-Yates shuffle (Spark's ``shuffle`` of an array is one)
and is written to the folder of its shard. Buckets follow one another, which gives each record its slot.

The tasks of the second pass follow from the buckets, not from a setting: each gets about ``TASK_BYTES`` of them, and
holds one bucket's array at a time beside those that are not complete yet.

Defined cases: a null key counts as the empty text; a null text has no bytes. Texts stay whole; one longer than a bucket
makes that bucket longer. Repeated rows stay, each with a slot of its own; as the place in the input draws the bucket,
slots (not shards) follow the input's splits, and the same splits give the same slots. Ties of hashes go to the lower
shard. An empty table gives no shards. Columns of the input named like an output column are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillsieve.llm.common import free_name, new_path, table

#: Bytes of text in a bucket, about, and the fewest buckets of a shard.
BUCKET_BYTES, FEWEST_BUCKETS = 4_000_000, 16
#: Bytes of text in the buckets of a task, about, and the most tasks (then tasks get more buckets).
TASK_BYTES, MOST_TASKS = 8_000_000, 500_000
#: Buckets up to this number are broadcast with their first slots (24 bytes each); more are joined by shuffling.
BROADCAST_BUCKETS = 200_000


def rendezvous(key: Column, n: int, seed: int) -> Column:
    """The number below ``n`` whose seeded hash with ``key`` is highest."""
    hashes = F.array(*[F.xxhash64(F.lit(seed), F.coalesce(key.cast("string"), F.lit("")), F.lit(i)) for i in range(n)])
    return (F.array_position(hashes, F.array_max(hashes)) - 1).cast("int")


def shard(df: DataFrame, n_shards: int, key_col: str = "doc_id", text_col: str = "text", seed: int = 20, bucket_bytes: int = BUCKET_BYTES) -> tuple[str, DataFrame]:
    """Writes ``df`` to shards. Returns the folder (``shard=N`` inside) and its rows with ``shard``, ``slot``, ``bucket``."""
    spark = df.sparkSession
    keep = [c for c in df.columns if c.lower() not in ("shard", "slot", "bucket", "place")]
    size = F.coalesce(F.octet_length(F.col(text_col)), F.lit(0)) + 8
    total = df.agg(F.coalesce(F.sum(size), F.lit(0)).alias("total")).first()["total"]
    buckets = max(FEWEST_BUCKETS, -(-total // (n_shards * bucket_bytes)))
    tasks = max(1, min(n_shards * buckets, -(-total // TASK_BYTES), MOST_TASKS))
    record = free_name(df, "record")
    scattered = df.select(
        rendezvous(F.col(key_col), n_shards, seed).alias("shard"),
        F.pmod(F.xxhash64(F.lit(seed + 1), F.monotonically_increasing_id()), F.lit(buckets)).cast("int").alias("bucket"),
        F.struct(*keep).alias(record),
    ).repartition(tasks, "shard", "bucket")
    mixed = scattered.groupBy("shard", "bucket").agg(F.shuffle(F.collect_list(record), F.lit(seed)).alias("all"))
    rows = mixed.select("shard", "bucket", F.posexplode("all").alias("place", record)).select(f"{record}.*", "shard", "bucket", "place")
    path = new_path(spark, "shards")
    rows.write.partitionBy("shard").option("compression", "zstd").parquet(path)
    back = spark.read.schema(rows.schema).parquet(path)
    counts = back.groupBy("shard", "bucket").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("shard").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("shard", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    if n_shards * buckets <= BROADCAST_BUCKETS:
        starts = F.broadcast(starts)
    return path, back.join(starts, ["shard", "bucket"]).select(*keep, "shard", (F.col("start") + F.col("place")).alias("slot"), "bucket")


def op8_shard(spark, sf_dir: str) -> DataFrame:
    """All ``documents`` in 24 shards by doc_id (law ``key``), read back from the shards' files."""
    n, seed = 24, 20
    _, rows = shard(table(spark, sf_dir, "documents"), n, seed=seed)
    return rows.select(
        "doc_id",
        (F.coalesce(F.octet_length("text"), F.lit(0)) + 8).cast("long").alias("size"),
        F.crc32(F.coalesce(F.col("text"), F.lit("")).cast("binary")).alias("text_crc32"),
        F.lit("key").alias("law"),
        "shard",
        "slot",
        rendezvous(F.col("doc_id"), n + 1, seed).alias("grown_shard"),
    )
