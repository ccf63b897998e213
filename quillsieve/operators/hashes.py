"""Hashes of records as exact JSON texts.

``exprs.payload_hash`` stays in the engine but writes numbers in their shortest form. Where a hash must equal that of
another writer digit for digit, the record is decoded and written again by Python's JSON, in Arrow batches.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Separators of the two forms: of payload hashes and of quarantined records' fingerprints. Keys are sorted in both.
FORMS = {"payload_sha256": (",", ":"), "record_sha256": (", ", ": ")}


def exact_hashes(records: DataFrame, payload: str = "payload") -> DataFrame:
    """``records`` with the SHA-256 of both forms; NULL where the payload is NULL or no JSON."""
    keep = [c for c in records.columns if c not in FORMS]
    schema = T.StructType([records.schema[c] for c in keep] + [T.StructField(c, T.StringType()) for c in FORMS])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: dict[str, list[str | None]] = {c: [] for c in FORMS}
            for text in batch.column("payload_text").to_pylist():
                try:
                    value = None if text is None else json.loads(text)
                except ValueError:
                    text = None
                for name, separators in FORMS.items():
                    written = None if text is None else json.dumps(value, sort_keys=True, ensure_ascii=False, separators=separators)
                    out[name].append(written and hashlib.sha256(written.encode("utf-8", "surrogatepass")).hexdigest())
            yield pa.RecordBatch.from_arrays([batch.column(c) for c in keep] + [pa.array(v, pa.string()) for v in out.values()], names=[*keep, *FORMS])

    return records.select(*keep, F.col(payload).alias("payload_text")).mapInArrow(run, schema)
