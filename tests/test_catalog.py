"""Names of tables and views, and reading published runs by partition."""

import pytest
from pyspark.errors import AnalysisException

from quillsieve.plans.catalog import Catalog, Databases
from quillsieve.sources import files
from quillsieve.sources.shared import Store


def test_databases():
    names = Databases("mine", "c", "m")
    assert [names.of(None), names.of(" input "), names.of("core", own=False), names.of(" terminology", own=False), names.of("readmissions", own=False), names.of(None, own=False)] == ["mine", "input", "c", "c", "m", "mine"]


def test_views_and_tables(spark):
    catalog = Catalog(spark, Databases(marts="q_marts"))
    try:
        assert catalog.view("q_numbers", spark.range(3)).count() == 3 and catalog.ref("q_numbers").count() == 3
        assert catalog.table("q_kept", spark.range(4), "quality", own=False).count() == 4
        assert catalog.table("q_kept", spark.range(2), "quality", own=False).count() == 2
        assert catalog.ref("q_kept", "quality", own=False).count() == 2
        with pytest.raises(AnalysisException):
            catalog.ref("q_kept").count()
    finally:
        spark.sql("DROP VIEW IF EXISTS q_numbers")
        spark.sql("DROP DATABASE IF EXISTS q_marts CASCADE")


def test_runs_are_read_by_partition_and_only_when_complete(spark, tmp_path):
    store = Store(spark, f"file://{tmp_path}/store")
    for run in ("r1", "r2", "r3"):
        files.publish(store, files.run_prefix("v", "eligibility", "2025-01-01", run), [[{"a": run}], [{"a": "x"}]], "c")
    store.delete(files.run_prefix("v", "eligibility", "2025-01-01", "r3") + "/_SUCCESS")
    rows = files.read_runs(spark, store)
    assert sorted((r.run_id, r.page_number, r.payload) for r in rows.collect()) == [(r, p, t) for r in ("r1", "r2") for p, t in ((1, f'{{"a": "{r}"}}'), (2, '{"a": "x"}'))]
    one = rows.where("run_id = 'r2' AND vendor = 'v'")
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert one.count() == 2 and "run_id" in plan.split("PartitionFilters: [", 1)[1].split("]", 1)[0]
    assert files.complete_runs(store) == [files.run_prefix("v", "eligibility", "2025-01-01", r) for r in ("r1", "r2")]
    assert files.read_runs(spark, Store(spark, f"file://{tmp_path}/none")).count() == 0
