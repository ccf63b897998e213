"""The entry points for schedulers, end to end on small files."""

import json

import pytest

from quillsieve import jobs
from quillsieve.sources import files
from quillsieve.sources.shared import PublishError, Store

HEADS = {"eligibility": "person_id,member_id,death_date", "medical_claim": "claim_id,claim_line_number,paid_amount", "pharmacy_claim": "claim_id,claim_line_number,quantity"}


def said(capsys):
    return [json.loads(x) for x in capsys.readouterr().out.splitlines() if x.startswith("{")]


def test_all_problems_at_once(spark, capsys):
    assert jobs.run(spark, jobs.Config("load", endpoint="claims", snapshot="../x", most_age_hours=0)) == 2
    assert len(said(capsys)[0]["problems"]) == 5
    assert jobs.Config("nothing").problems()[0].startswith("command")


def test_snapshot_to_contracts_and_health(spark, tmp_path, capsys):
    for t, head in HEADS.items():
        (tmp_path / f"{t}.csv").write_text(f"{head}\n1,2,2024-01-02\n,x,\n")
    root, now = f"file://{tmp_path}/raw", "2025-01-01 00:00:00"
    assert jobs.run(spark, jobs.Config("load-legacy", root=root, source=str(tmp_path), snapshot="s1", now=now)) == 0
    assert jobs.run(spark, jobs.Config("build", root=root, data_source="here")) == 0
    rows = files.loaded(spark, Store(spark, f"{root}/contracts"), "eligibility").collect()
    assert sorted((r.person_id or "", r.death_flag, r.data_source) for r in rows) == [("", 0, "here"), ("1", 1, "here")] and len(rows[0]) == 35
    assert jobs.run(spark, jobs.Config("healthcheck", root=root, now="2025-01-01 20:00:00")) == 0
    assert jobs.run(spark, jobs.Config("healthcheck", root=root, now="2025-01-09 20:00:00")) == 1
    assert said(capsys)[-1]["tables"]["eligibility"] == "error"


def test_streaming_job(spark, tmp_path, capsys):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "1.jsonl").write_text('{"person_id":"p","updated_at":"2025-01-01"}\n5\n')
    assert jobs.run(spark, jobs.Config("load", root=str(tmp_path / "out"), source=str(tmp_path / "in"), endpoint="eligibility")) == 0
    assert said(capsys)[-1]["rows"] == 2 and spark.read.parquet(f"{tmp_path}/out/eligibility/accepted").count() == 1


def test_gate_job(spark, tmp_path, capsys):
    (tmp_path / "claims.csv").write_text("clm_id,line_no,member_key,clm_status_code,orig_clm_id,bill_type_code,place_of_service_code,claim_form_code,diag_type,diag_cd_1,diag_cd_2,diag_cd_3,proc_type,proc_cd_1,proc_dt_1,proc_cd_2,proc_dt_2,paid_cents,allowed_cents,charge_cents\nc1,1,m1" + "," * 17 + "\n,1,m1" + "," * 17 + "\nc2,x,m1" + "," * 17 + "\n")
    (tmp_path / "spans.csv").write_text("member_key,payer,plan,coverage_type,span_start_dt,span_end_dt\nm1,a,b,c,2025-01-01,\n")
    (tmp_path / "members.csv").write_text("member_key,person_id\nm1,p1\n")
    assert jobs.run(spark, jobs.Config("gate", source=str(tmp_path))) == 0
    (tmp_path / "members.csv").write_text("member_key,person_id\nm2,p1\n")
    assert jobs.run(spark, jobs.Config("gate", source=str(tmp_path))) == 1
    assert said(capsys)[-1]["reasons"] == "coverage"


def test_events_are_masked(capsys):
    jobs.log("x", text="Bearer abc and postgresql://me:pw@host")
    assert said(capsys)[0]["text"] == "Bearer ***REDACTED*** and postgresql://***REDACTED***@host"


def test_cursor_versions(spark, tmp_path):
    store = Store(spark, f"file://{tmp_path}")
    assert files.cursor(store, "v", "e") == (None, 0)
    assert files.commit_cursor(store, "v", "e", "2025-01-02", "r1", 0) == 1 and files.commit_cursor(store, "v", "e", "2025-01-02", "r2", 1) == 2
    for cursor, version in (("2025-01-01", 2), ("2025-01-09", 1)):
        with pytest.raises(PublishError):
            files.commit_cursor(store, "v", "e", cursor, "r3", version)
    assert files.cursor(store, "v", "e") == ("2025-01-02", 2)
