"""A streaming load: each micro-batch of JSON lines is classified once, merged into a Parquet table, and its rejects kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from quillsieve.operators import ingest

#: Folders of the table by the first bits of its keys' hash: a batch reads those that its keys fall in, keys only.
PARTS = 256


def load(spark: SparkSession, source: str, target: str, checkpoint: str, endpoint: str) -> StreamingQuery:
    """Appends records that ``target/accepted`` lacks, and every refused one with its reason to ``target/rejected``.

    Rows keep the file they came from (``page``) and a number that grows along it (``position``). Each batch goes to folders of its
    own number, which a replay overwrites, so a lost commit cannot double rows; a replay does not compare with itself.
    """

    def merge(batch: DataFrame, number: int) -> None:
        placed = batch.withColumn("position", F.monotonically_increasing_id()).where("trim(payload) <> ''")
        rows = ingest.classified(placed, endpoint).withColumn("part", F.pmod(F.xxhash64("_source_record_id"), F.lit(PARTS)).cast("int")).persist()
        try:
            refused = rows.where("reject_reason IS NOT NULL").select("page", "position", "payload", "reject_reason", "_source_record_id")
            refused.write.mode("overwrite").parquet(f"{target}/rejected/batch={number:09}")
            good = rows.where("reject_reason IS NULL").select("page", "position", "payload", "part", *ingest.KEY)
            parts = [r["part"] for r in good.select("part").distinct().collect()]  # at most PARTS numbers
            old = _keys(spark, f"{target}/accepted", number, parts, good)
            fresh = ingest.merge_absent(old, good, ingest.KEY, ["page", "position"])
            fresh.write.mode("overwrite").partitionBy("part").parquet(f"{target}/accepted/batch={number:09}")
        finally:
            rows.unpersist()

    lines = spark.readStream.schema("value string").text(source).select(F.col("value").alias("payload"), F.col("_metadata.file_path").alias("page"))
    return lines.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(merge).start()


def _keys(spark: SparkSession, path: str, number: int, parts: list[int], like: DataFrame) -> DataFrame:
    """The keys of earlier batches in ``parts``, read from those folders only."""
    fs = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not fs.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).exists(fs):
        return like.select(*ingest.KEY).limit(0)
    schema = like.select("part", *ingest.KEY).schema.add("batch", "integer")
    old = spark.read.schema(schema).parquet(path)
    return old.where((F.col("batch") != number) & F.col("part").isin(parts)).select(*ingest.KEY)
