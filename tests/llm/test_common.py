"""Scratch tables, streamed blocks and shared folders."""

import os

import pyarrow as pa
import pytest

from quillsieve.llm import common


@pytest.fixture
def shared(tmp_path, monkeypatch):
    monkeypatch.setattr(common, "shared_root", lambda spark: f"file://{tmp_path}/shared")
    return tmp_path / "shared"


def names(folder):
    return sorted(n.rpartition("-")[0] for n in os.listdir(folder)) if folder.exists() else []


def test_scratch_tables_go_and_kept_ones_stay(spark, shared):
    with common.scratch(spark) as keep:
        made = common.written(spark.range(3), "made")
        with common.scratch(spark) as inner:
            common.written(made, "deep")
            passed = inner(common.written(made.where("id > 0"), "passed"))
            assert names(shared) == ["deep", "made", "passed"]
        assert names(shared) == ["made", "passed"]
        out = keep(common.written(passed, "out"))
    assert names(shared) == ["out"] and out.count() == 2
    with pytest.raises(ZeroDivisionError), common.scratch(spark):
        common.written(spark.range(1), "lost")
        raise ZeroDivisionError
    assert names(shared) == ["out"]


def test_operators_leave_only_what_a_lazy_result_reads(spark, shared):
    from pyspark.sql import functions as F

    from quillsieve.llm import jaccard_join, language, toxicity

    docs = spark.createDataFrame([(i, f"one two three four five six seven {i % 7}", "en") for i in range(40)], "doc_id long, text string, lang string")
    language.fit(docs, F.lit(True))
    toxicity.fit(docs, spark.createDataFrame([(i, i % 2) for i in range(40)], "doc_id long, toxic int"), F.lit(True))
    assert names(shared) == []
    assert jaccard_join.classes(docs).count() == 40
    assert names(shared) == ["linked", "signatures"]


def test_every_block_meets_every_question(spark):
    blocks = spark.createDataFrame([(i % 5, i) for i in range(23)], "lane int, block int")
    asked = spark.createDataFrame([(i, "q") for i in range(40)], "question int, word string")

    def scan(block, question):
        return pa.RecordBatch.from_arrays([pa.array([block["block"]], pa.int32()), pa.array([question["question"]], pa.int32())], names=["b", "q"])

    for lanes in (5, 9):  # lanes without blocks give nothing
        out = common.met(blocks, asked, lanes, scan, "b int, q int").collect()
        assert sorted(map(tuple, out)) == [(b, q) for b in range(23) for q in range(40)]
    assert common.met(blocks, asked.limit(0), 5, scan, "b int, q int").count() == 0


def test_a_cluster_needs_a_shared_folder(spark):
    from quillsieve.sources.shared import shared_root

    class Conf:
        def get(self, key, default=None):
            return {"spark.master": "yarn"}.get(key, default)

    class Session:
        conf = Conf()

    with pytest.raises(ValueError):
        shared_root(Session())
