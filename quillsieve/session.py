"""Session settings that the library's plans want."""

from __future__ import annotations

from pyspark.sql import SparkSession

#: UTC, since stamps without an offset are UTC; and no generated method beyond what the JVM compiles (the contracts have up
#: to 148 columns, and a longer method would only be interpreted).
SETTINGS = {"spark.sql.session.timeZone": "UTC", "spark.sql.codegen.hugeMethodLimit": "8000"}


def configured(builder: SparkSession.Builder) -> SparkSession.Builder:
    """``builder`` with ``SETTINGS``."""
    return builder.config(map=SETTINGS)
