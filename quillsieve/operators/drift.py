"""Schema drift: which JSON types occur at which path, and a fingerprint of the shape."""

from __future__ import annotations

import json
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def kinds(value: object, path: str = "") -> Iterator[tuple[str, str]]:
    """(path, type) of everything inside a decoded JSON value; elements of an array are at ``path[]``, the root is not given."""
    if path:
        name = {bool: "boolean", int: "number", float: "number", str: "string", list: "array", dict: "object"}.get(type(value), "null")
        yield path, name
    if isinstance(value, dict):
        for k, v in value.items():
            yield from kinds(v, f"{path}.{k}" if path else str(k))
    elif isinstance(value, list):
        for v in value:
            yield from kinds(v, f"{path}[]")


def observed(records: DataFrame, page: list[str], payload: str = "payload") -> DataFrame:
    """Page columns, path, type: every different one of a page. Paths of any depth need a walk, so this is batched Python."""
    schema = ", ".join(f"{c} {records.schema[c].dataType.simpleString()}" for c in page) + ", paths array<struct<path:string,type:string>>"
    kind = pa.list_(pa.struct([("path", pa.string()), ("type", pa.string())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for text in batch.column("payload_text").to_pylist():
                try:
                    value = json.loads(text) if text is not None else None
                except ValueError:
                    value = None
                out.append([{"path": p, "type": t} for p, t in dict.fromkeys(kinds(value if isinstance(value, dict) else {}))])
            yield pa.RecordBatch.from_arrays([batch.column(c) for c in page] + [pa.array(out, kind)], names=[*page, "paths"])

    walked = records.select(*page, F.col(payload).alias("payload_text")).mapInArrow(run, schema)
    return walked.select(*page, F.explode("paths").alias("at")).select(*page, "at.path", "at.type").distinct()


def counted(observations: DataFrame, page: list[str]) -> DataFrame:
    """path, type, the number of pages that show it, and the first and last of them."""
    at = F.struct(*page)
    return observations.groupBy("path", "type").agg(F.count(F.lit(1)).alias("occurrence_count"), F.min(at).alias("a"), F.max(at).alias("b")).select(
        "path", "type", "occurrence_count", *[F.col(f"a.{c}").alias(f"first_{c}") for c in page], *[F.col(f"b.{c}").alias(f"last_{c}") for c in page]
    )


def fingerprint(observations: DataFrame) -> DataFrame:
    """SHA-256 of the sorted list of paths with their sorted types, as JSON; the shape is bounded by the schema."""
    by_path = observations.groupBy("path").agg(F.sort_array(F.collect_set("type")).alias("types"))
    one = F.concat(F.lit('["'), F.col("path"), F.lit('",["'), F.array_join("types", '","'), F.lit('"]]'))
    return by_path.agg(F.sort_array(F.collect_list(F.struct("path", one.alias("text")))).alias("all")).select(F.sha2(F.concat(F.lit("["), F.array_join(F.col("all.text"), ","), F.lit("]")), 256).alias("fingerprint"), F.size("all").cast("long").alias("paths"))
