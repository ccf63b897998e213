"""What the operators of this subpackage share: shared storage, folds, blocks of bytes."""

from __future__ import annotations

import contextlib
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quillsieve.sources.shared import shared_root

#: Tables of up to this many bytes, as measured, are broadcast.
BROADCAST_BYTES = 8_000_000

#: The tables written in each ``scratch`` block that is open.
_open: list[list[str]] = []


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_root(spark)}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared folder and read back: lineage ends there, and lost executors cost nothing.

    Inside ``scratch`` the folder goes when the block ends; outside it stays until the shared folder is cleared.
    """
    path = new_path(df.sparkSession, name)
    if _open:
        _open[-1].append(path)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextlib.contextmanager
def scratch(spark: SparkSession) -> Iterator[Callable[[DataFrame], DataFrame]]:
    """Removes the tables ``written`` inside the block at its end, also after an error, by the file system they are on.

    What leaves the block must not read them lazily any more: it is written last, and marked by the function that the
    block is given, which keeps its folder (or leaves it to an enclosing block).
    """
    _open.append([])
    kept: list[str] = []

    def keep(df: DataFrame) -> DataFrame:
        kept.append(_open[-1].pop())
        return df

    try:
        yield keep
    finally:
        removed(spark, _open.pop())
        if _open:
            _open[-1].extend(kept)


def removed(spark: SparkSession, paths: list[str]) -> None:
    for p in paths:
        at = spark._jvm.org.apache.hadoop.fs.Path(p)
        at.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(at, True)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def crc_fold(id_col: str, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``; a null id counts as the empty text."""
    return F.pmod(F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")), F.lit(folds))


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with underscores in front until no column of ``df`` has it (names compare without case)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name



def lowest_hashes(df: DataFrame, group: str, h: Column, most: int, spare: float = 1.0) -> DataFrame:
    """Of each group of ``df``, the ``most`` rows of lowest hash ``h``, with their ``place``; rows of one hash count once.

    Rows without a group go. An approximate number of different hashes gives a bound on the hashes first, ``spare``
    times as high as needed in expectation, so that the window sees a bounded number of a group's rows, however often
    a row repeats. The bounds, a row a group, are written; they are broadcast if their names take few bytes.
    """
    hashed = df.where(F.col(group).isNotNull()).withColumn("hash_of_row", h)
    counts = written(hashed.groupBy(F.col(group).alias("group_of_row")).agg(F.approx_count_distinct("hash_of_row", 0.02).alias("different")), "group-counts")
    few = (counts.agg(F.sum(F.octet_length("group_of_row") + 32).alias("bytes")).first()["bytes"] or 0) <= BROADCAST_BYTES
    share = F.lit(spare * (1.1 * most + 8 * most**0.5)) / F.col("different")
    bound = F.when(share >= 1, F.lit(2**63 - 1)).otherwise((share * 2.0**64 - 2.0**63).cast("long"))
    bounds = counts.select("group_of_row", bound.alias("bound_of_row"))
    near = hashed.join(F.broadcast(bounds) if few else bounds, F.col(group) == F.col("group_of_row")).where(F.col("hash_of_row") <= F.col("bound_of_row"))
    rest = [c for c in df.columns if c != group]
    once = near.groupBy(group, "hash_of_row").agg(F.first("bound_of_row").alias("bound_of_row"), *[F.min(c).alias(c) for c in rest])
    order = Window.partitionBy(group).orderBy("hash_of_row")
    placed = once.withColumn("place", F.row_number().over(order)).where(F.col("place") <= most)
    return placed.select(*df.columns, "place", (F.col("bound_of_row") == 2**63 - 1).alias("whole"))


def met(blocks: DataFrame, asked: DataFrame, lanes: int, scan: Callable[[dict, dict], pa.RecordBatch], schema: str) -> DataFrame:
    """``scan`` of every row of ``blocks`` (with a ``lane`` below ``lanes``) with every row of ``asked``.

    A lane's blocks go to one task once and are held there, and all of ``asked`` streams past them, so bytes moved are
    the blocks and ``lanes`` times ``asked``. A task holds the blocks of one lane and one Arrow batch.
    """
    own, other = F.struct(*[c for c in blocks.columns if c != "lane"]), F.struct(*asked.columns)
    kinds = [df.select(c.alias("c")).schema["c"].dataType.simpleString() for df, c in ((blocks, own), (asked, other))]
    left = blocks.select("lane", own.alias("block"), F.lit(None).cast(kinds[1]).alias("asked"))
    right = asked.select(F.explode(F.sequence(F.lit(0), F.lit(lanes - 1))).alias("lane"), F.lit(None).cast(kinds[0]).alias("block"), other.alias("asked"))
    dealt = left.unionByName(right).repartitionById(lanes, F.col("lane")).sortWithinPartitions("lane", F.col("block").isNull())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lane, held = None, []
        for batch in batches:
            for i in range(batch.num_rows):
                r = batch.slice(i, 1).to_pylist()[0]
                if r["lane"] != lane:
                    lane, held = r["lane"], []
                if r["asked"] is None:
                    held.append(r["block"])
                else:
                    for block in held:
                        yield scan(block, r["asked"])

    return dealt.mapInArrow(run, schema)
