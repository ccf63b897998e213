"""Raw rows to staged rows to the fixed contracts: one parse of the payload, then plain projections."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillsieve.functions import exprs as X
from quillsieve.plans.contracts import FINAL, LINEAGE, STAGING, TYPES


def parsed(raw: DataFrame, keys: list[str]) -> DataFrame:
    """``raw`` with the fields ``keys`` of its effective payload, as one struct of texts; Catalyst prunes unused ones."""
    schema = T.StructType([T.StructField(k, T.StringType()) for k in dict.fromkeys(keys)])
    return raw.withColumn("fields", F.from_json(X.effective_payload(F.col("_raw_payload"), F.col("raw_row")), schema))


def _cast(name: str, kind: str, key: str | None, default_source: str) -> Column:
    if key is None:
        return F.lit(None).cast(TYPES[kind]).alias(name)
    text = X.blank_to_null(F.col(f"fields.{key}"))
    if name == "data_source":
        text = F.coalesce(text, F.lit(default_source))
    made = {
        "text": lambda: text,
        "date": lambda: X.safe_date(text),
        "int": lambda: X.safe_integer(text),
        "numeric": lambda: X.safe_numeric(text),
        "money": lambda: X.safe_numeric(text, TYPES["money"]),
        "flag": lambda: F.when(X.safe_date(text).isNotNull(), 1).otherwise(0),
    }[kind]()
    return made.cast(TYPES[kind]).alias(name)


def staged(raw: DataFrame, table: str, default_source: str) -> DataFrame:
    """Lineage columns that ``raw`` has, and the staged columns of ``table``; nothing is filtered or deduplicated."""
    columns = STAGING[table]
    lineage = [c for c in LINEAGE if c in raw.columns]
    return parsed(raw, [k for _, _, k in columns if k]).select(*lineage, *[_cast(*c, default_source) for c in columns])


def final(raw: DataFrame, table: str, default_source: str) -> DataFrame:
    """The contract of ``table``: all columns, in order, with their types. Amounts are cast once, from their texts."""
    columns = FINAL[table]
    return parsed(raw, [k for _, _, k in columns if k]).select(*[_cast(*c, default_source) for c in columns])


def row_json(df: DataFrame, name: str = "raw_row") -> DataFrame:
    """Each row of ``df`` as a JSON object of texts in the columns' order; a NULL stays as a JSON null."""
    texts = F.struct(*[F.col(c).cast("string").alias(c) for c in df.columns])
    return df.select(F.to_json(texts, {"ignoreNullFields": "false"}).alias(name))


def legacy_raw(df: DataFrame, snapshot: str, number: Column, loaded_at: str) -> DataFrame:
    """The raw rows of a snapshot's table: its id, the row's number from 1, when it was loaded, and the row as JSON."""
    texts = F.struct(*[F.col(c).cast("string").alias(c) for c in df.columns if c != "row_number"])
    return df.select(
        F.lit(snapshot).alias("_snapshot_id"),
        number.cast("long").alias("_source_row_number"),
        F.lit(loaded_at).cast("timestamp").alias("_loaded_at"),
        F.to_json(texts, {"ignoreNullFields": "false"}).alias("raw_row"),
    )


def both_loaders(legacy: DataFrame, objects: DataFrame) -> DataFrame:
    """The rows of both loaders as one raw table; a column that a loader does not set is NULL."""
    return legacy.unionByName(objects, allowMissingColumns=True)
