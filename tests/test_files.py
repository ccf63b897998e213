"""Files: pages, manifests, snapshots, and the streaming load."""

import gzip
import json

import pytest

from quillsieve.sources import files
from quillsieve.sources.shared import PublishError, Store
from quillsieve.streaming import incremental


@pytest.fixture
def store(spark, tmp_path):
    return Store(spark, f"file://{tmp_path}/store")


def test_publish_is_immutable_and_verified(spark, store, tmp_path):
    prefix = files.run_prefix("vendor", "eligibility", "2025-01-01", "run1")
    folder = tmp_path / "store" / prefix
    pages = [[{"b": 1, "a": "é"}], [{"a": "x"}, {"a": "y"}]]
    with pytest.raises(PublishError):
        files.published(store, prefix)
    manifest = files.publish(store, prefix, pages, "w1")
    assert manifest["page_count"] == 2 and manifest["total_records"] == 3
    assert files.publish(store, prefix, pages, "w1") == manifest
    assert gzip.decompress((folder / "page=000001.jsonl.gz").read_bytes()).decode() == '{"a": "é", "b": 1}\n'
    assert files.verify(spark, store, prefix).count() == 0
    with pytest.raises(PublishError):
        files.publish(store, prefix, [[{"a": "z"}], pages[1]], "w1")
    (folder / ".page=000001.jsonl.gz.crc").unlink()
    (folder / "page=000001.jsonl.gz").write_bytes(files.page_bytes([{"a": "tampered"}]))
    (folder / "page=000002.jsonl.gz").unlink()
    assert sorted((r.file, r.problem) for r in files.verify(spark, store, prefix).collect()) == [("page=000001.jsonl.gz", "checksum"), ("page=000002.jsonl.gz", "missing")]
    (folder / ".manifest.json.crc").unlink()
    (folder / "manifest.json").write_text("{}")
    with pytest.raises(PublishError):
        files.published(store, prefix)
    with pytest.raises(ValueError):
        files.run_prefix("..", "e", "d", "r")


def test_store(store):
    assert store.list("a/") == [] and store.head("a/1") is None and not store.exists("a/1")
    meta = store.put("a/1", b"one")
    assert meta == store.put("a/1", b"one") == store.head("a/1") and (meta.size_bytes, len(meta.sha256)) == (3, 64)
    store.put("a/12", b"\x00\xff")
    store.put("b/1", b"")
    assert store.get("a/12") == b"\x00\xff" and store.get("b/1") == b""
    assert store.list("a/1") == ["a/1", "a/12"] and store.list("a/12") == ["a/12"] and store.list("") == ["a/1", "a/12", "b/1"]
    for call in (lambda: store.put("a/1", b"two"), lambda: store.get("c")):
        with pytest.raises(PublishError):
            call()
    with pytest.raises(ValueError):
        store.put("../x", b"")


def test_a_frame_is_published_page_by_page(spark, store):
    rows = [(2, 1, '{"b":1,"a":2}'), (1, 2, '{"x":{"d":1,"c":null}}'), (1, 1, '{"y":1}')]
    manifest = files.write_pages(spark.createDataFrame(rows, "page_number int, position int, payload string"), store, "run", "w")
    assert [(p["page_number"], p["records"]) for p in manifest["pages"]] == [(1, 2), (2, 1)] and files.published(store, "run") == manifest
    lines = [gzip.decompress(store.get(f"run/{p['file']}")).decode() for p in manifest["pages"]]
    assert lines == ['{"y":1}\n{"x":{"c":null,"d":1}}\n', '{"a":2,"b":1}\n']
    assert files.verify(spark, store, "run").count() == 0
    with pytest.raises(PublishError):
        files.write_pages(spark.createDataFrame(rows, "page_number int, position int, payload string"), store, "run", "w")


def test_pages_skip_blank_lines(spark, tmp_path):
    (tmp_path / "page=000001.jsonl.gz").write_bytes(gzip.compress(b'{"a":1}\n\n  \n{"a":2}\n'))
    assert sorted(r.payload for r in files.read_pages(spark, str(tmp_path)).collect()) == ['{"a":1}', '{"a":2}']


def test_csv_stays_text(spark, tmp_path):
    (tmp_path / "x.csv").write_text('code,note\n0450,"two\nlines"\n,"say ""hi"""\n')
    rows = files.read_csv(spark, str(tmp_path / "x.csv")).collect()
    assert [tuple(r) for r in rows] == [("0450", "two\nlines"), ("", 'say "hi"')]


def test_reload_replaces_all_tables_at_once(spark, store):
    with pytest.raises(PublishError):
        files.loaded(spark, store, "a")
    files.reload({"a": spark.range(5), "b": spark.range(7)}, store)
    files.reload({"a": files.loaded(spark, store, "a").where("id < 2"), "b": spark.range(1)}, store)
    assert files.loaded(spark, store, "a").count() == 2 and files.loaded(spark, store, "b").count() == 1
    with pytest.raises(Exception, match="raise_error|boom"):
        files.reload({"a": spark.range(3), "b": spark.range(1).selectExpr("raise_error('boom') AS id")}, store)
    assert files.loaded(spark, store, "a").count() == 2  # a failed load changes nothing
    files.reload({"a": spark.range(9), "b": spark.range(9)}, store)
    assert files.loaded(spark, store, "a").count() == 9 and len(store.list("current-")) == 2


def test_legacy_load(spark, store, tmp_path):
    (tmp_path / "x.csv").write_text('code,note\n0450,"two\nlines"\n,"say ""hi"""\n' + "".join(f"{i},n\n" for i in range(3, 2000)))
    files.legacy_load(spark, {"x": str(tmp_path / "x.csv")}, "s1", "2025-01-01 00:00:00", store)
    rows = {r._source_row_number: r for r in files.loaded(spark, store, "x").collect()}
    assert sorted(rows) == [*range(1, 2000)] and rows[1].raw_row == '{"code":"0450","note":"two\\nlines"}' and json.loads(rows[2].raw_row) == {"code": "", "note": 'say "hi"'}
    assert all(json.loads(rows[i].raw_row)["code"] == str(i) for i in range(3, 2000)) and rows[1]._snapshot_id == "s1" and rows[1]._loaded_at is not None


def test_all_manifest_problems_at_once():
    good = {"version": 1, "source": "v", "snapshot_id": "s1", "created_at": "2025-01-01T00:00:00Z", "artifacts": [{"table": "a", "url": "https://host/a.csv", "sha256": "0" * 64, "size_bytes": 5}]}
    assert files.snapshot_problems(good, ["a"]) == []
    bad = {"version": 2, "artifacts": [{"table": "z", "sha256": "q", "size_bytes": True}]}
    assert len(files.snapshot_problems(bad, ["a"])) == 9
    at = lambda **k: files.snapshot_problems(good | {"artifacts": [good["artifacts"][0] | k]}, ["a"])
    assert [len(at(url=u)) for u in ("http://host/a", "ftp://host/a", "https:///a", "https://host/x/../a", "")] == [1, 1, 1, 1, 1]
    assert len(files.snapshot_problems(good | {"source": " ", "created_at": "soon"}, ["a"])) == 2


def test_streaming_load_adds_each_record_once(spark, tmp_path):
    source, target = tmp_path / "in", str(tmp_path / "out")
    source.mkdir()
    line = lambda i, day: json.dumps({"person_id": f"p{i}", "updated_at": f"2025-01-{day:02}"}) + "\n"
    (source / "1.jsonl").write_text(line(1, 1) + line(2, 1) + line(1, 1) + "[]\n\n")
    run = lambda checkpoint: incremental.load(spark, str(source), target, str(tmp_path / checkpoint), "eligibility").awaitTermination()
    run("c1")
    rows = lambda kind: [r for r in spark.read.option("recursiveFileLookup", True).parquet(f"{target}/{kind}").collect()]
    count = lambda: len(rows("accepted"))
    assert count() == 2
    assert [(r.payload, r.reject_reason, r.page.endswith("/1.jsonl")) for r in rows("rejected")] == [("[]", "not_an_object", True)]
    assert all(r.page.endswith("/1.jsonl") and r.position is not None for r in rows("accepted"))
    (source / "2.jsonl").write_text(line(1, 1) + line(1, 2) + '{"person_id":"p9"}\n')
    run("c1")
    assert count() == 3 and sorted(r.reject_reason for r in rows("rejected")) == ["missing_source_timestamp", "not_an_object"]
    run("c1")
    assert count() == 3
    run("c2")  # another checkpoint replays everything into batches of the same numbers
    assert count() == 3
