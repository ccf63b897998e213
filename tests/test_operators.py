"""Claims logic on small hand-made rows."""

import json
from datetime import date

import pytest
from pyspark.sql import functions as F

from quillsieve.functions import exprs as X
from quillsieve.operators import drift, hashes, ingest, mapping, quality, staging
from quillsieve.plans.contracts import FINAL, STAGING, table_of


def one(spark, value, build):
    return spark.createDataFrame([(value,)], "v string").select(build(F.col("v")).alias("x")).first().x


@pytest.mark.parametrize(
    "value, want",
    [("2025-01-31", date(2025, 1, 31)), ("2025-02-30", None), ("2025-1-1", None), ("2025-01-01\n", None), ("", None), (None, None), (" 2025-01-01", None)],
)
def test_dates(spark, value, want):
    assert one(spark, value, X.safe_date) == want


@pytest.mark.parametrize("value, want", [("12", 12), ("-7", -7), ("007", 7), ("+1", None), ("1.0", None), ("99999999999", None), ("12\n", None), (" 12", None)])
def test_integers(spark, value, want):
    assert one(spark, value, X.safe_integer) == want


@pytest.mark.parametrize("value, want", [("8501", "85.01"), (" -5 ", "-0.05"), ("", None), ("1.5", None), (None, None)])
def test_cents(spark, value, want):
    got = one(spark, value, X.cents_to_amount)
    assert (None if got is None else str(got)) == want


def test_money_is_rounded_once(spark):
    assert str(one(spark, "1.0049999999999", lambda c: X.safe_numeric(c, "decimal(38,2)"))) == "1.00"
    assert one(spark, "1e5", X.safe_numeric) is None and one(spark, ".5", X.safe_numeric) is None


def test_two_trims(spark):
    assert one(spark, "\ta ", X.blank_to_null) == "\ta" and one(spark, "\t a \n", X.strip) == "a" and one(spark, " \t", X.strip) is None


def test_record_ids(spark):
    rows = [('{"a":"c-1","b":"2"}', "3:c-11:2"), ('{"a":"é","b":7}', "2:é1:7"), ('{"a":"x","b":2.0}', "1:x1:2"), ('{"a":"x","b":2.5}', None), ('{"a":true,"b":"1"}', None), ('{"a":" ","b":"1"}', None), ('{"a":["x"],"b":"1"}', None), ('{"b":"1"}', None)]
    df = spark.createDataFrame(rows, "p string, want string")
    for r in df.select("want", X.record_id([X.id_part(X.json_probe(F.col("p"), k)) for k in ("a", "b")]).alias("got")).collect():
        assert r.got == r.want


def test_payload_hash_ignores_key_order(spark):
    df = spark.createDataFrame([('{"b": 1, "a": {"y": "é", "x": null}}',), ('{"a":{"x":null,"y":"é"},"b":1}',), ('{"a":{"x":null,"y":"e"},"b":1}',)], "p string")
    got = [r.h for r in df.select(X.payload_hash(F.col("p")).alias("h")).collect()]
    assert got[0] == got[1] != got[2]


def test_contract_shapes():
    assert [len(FINAL[t]) for t in ("eligibility", "medical_claim", "pharmacy_claim")] == [35, 148, 25]
    assert len({c for c, _, _ in FINAL["medical_claim"]}) == 148
    assert [len(STAGING[t]) + 3 for t in ("eligibility", "medical_claim", "pharmacy_claim")] == [20, 39, 24]
    assert table_of("medical-claims") == "medical_claim"
    with pytest.raises(ValueError):
        table_of("claims")


def test_staging_keeps_codes_and_nulls(spark):
    payload = json.dumps({"person_id": " p1 ", "member_id": "", "birth_date": "1980-02-30", "death_date": "2024-01-02", "dual_status_code": "02", "extra": 1})
    raw = spark.createDataFrame([("s", 1, payload, None)], "_snapshot_id string, _source_row_number long, raw_row string, _raw_payload string")
    r = staging.final(raw, "eligibility", "here").first()
    assert (r.person_id, r.member_id, r.birth_date, r.death_flag, r.dual_status_code, r.data_source, r.gender) == ("p1", None, None, 1, "02", "here", None)


CLAIMS = "clm_id string, line_no string, member_key string, clm_status_code string, orig_clm_id string, bill_type_code string, place_of_service_code string, claim_form_code string, diag_type string, diag_cd_1 string, diag_cd_2 string, diag_cd_3 string, proc_type string, proc_cd_1 string, proc_dt_1 string, proc_cd_2 string, proc_dt_2 string, paid_cents string, allowed_cents string, charge_cents string"


def claim(spark, *rows):
    names = [x.split()[0] for x in CLAIMS.split(", ")]
    return spark.createDataFrame([tuple(r.get(n) for n in names) for r in rows], CLAIMS)


@pytest.fixture(scope="module")
def members(spark):
    rows = spark.createDataFrame([(" m1", "old", 1), ("m1", "p1", 2), ("m2", "p2", 3), ("m3", " ", 4)], "member_key string, person_id string, n int")
    return mapping.crosswalk(rows, "n")


def test_last_crosswalk_row_wins(members):
    assert {r.member_key: r.person_id for r in members.collect()} == {"m1": "p1", "m2": "p2"}


def test_claims_are_refused_netted_and_resolved(spark, members):
    good = {"clm_id": "c1", "line_no": "1", "member_key": "m1", "clm_status_code": "1", "paid_cents": "100", "allowed_cents": "90", "charge_cents": "200"}
    rows = claim(
        spark, good, good, good | {"clm_id": "c1a", "clm_status_code": "7", "orig_clm_id": "c1", "paid_cents": "70"}, good | {"clm_id": "c2", "member_key": "m9"},
        good | {"clm_id": "c2", "clm_status_code": "8", "orig_clm_id": "c2", "line_no": "2", "paid_cents": "-100"}, good | {"clm_id": " "}, good | {"line_no": "one"}, good | {"member_key": None}, good | {"clm_id": "c3", "clm_status_code": "7", "orig_clm_id": "gone", "paid_cents": ""},
    )
    lines = mapping.accepted(rows, members)
    assert lines.count() == 5 and lines.where("NOT matched_member").count() == 1
    assert sorted((r.reason, r.field) for r in mapping.rejected(rows).collect()) == [("missing", "clm_id"), ("missing", "member_key"), ("not_an_integer", "line_no")]
    assert str(mapping.net_paid(lines).first().net_paid) == "0.70"
    assert str(mapping.net_paid(lines.limit(0)).first().net_paid) == "0.00"
    assert [r.claim_id for r in mapping.orphan_adjustments(lines).collect()] == ["c3"]
    assert mapping.unreconciled(lines).count() == 3
    assert mapping.collapsed(rows).first().n_collapsed == 1


def test_claim_types_in_order(spark):
    rows = claim(spark, {"claim_form_code": "UB04", "place_of_service_code": "11"}, {"claim_form_code": " CMS1500 ", "bill_type_code": "111"}, {"claim_form_code": "ub04", "bill_type_code": "1", "place_of_service_code": "11"}, {"place_of_service_code": "11"}, {"bill_type_code": " "})
    got = [r.t for r in rows.select(X.claim_type(F.col("claim_form_code"), F.col("bill_type_code"), F.col("place_of_service_code")).alias("t")).collect()]
    assert got == ["institutional", "professional", "institutional", "professional", "undetermined"]


def test_codes_are_numbered_after_dedup(spark, members):
    lines = mapping.accepted(claim(spark, {"clm_id": "c", "line_no": "1", "member_key": "m1", "diag_cd_1": "", "diag_cd_2": "A", "diag_cd_3": " A", "proc_cd_1": "P", "proc_dt_1": "2025-02-30", "proc_cd_2": "P", "proc_dt_2": "2025-01-01"}), members)
    assert [(r.sequence, r.code, r.code_type, r.is_primary) for r in mapping.diagnoses(lines).collect()] == [(1, "A", "UNKNOWN_CODE_TYPE", True)]
    assert [(r.sequence, r.code, r.code_date) for r in mapping.procedures(lines).collect()] == [(1, "P", None)]


def test_spans(spark, members):
    rows = spark.createDataFrame(
        [("m1", "a", "x", "c", s, e) for s, e in [("2025-01-01", "2025-03-31"), ("2025-01-15", "2025-02-01"), ("2025-04-01", "2025-04-30"), ("2025-06-01", "2025-06-30"), ("2025-06-01", "2025-06-30"), ("2025-07-02", ""), ("2025-05-05", "2025-05-01"), ("x", None), ("2025-01-01", "x")]] + [("m9", "a", "x", "c", "2025-01-01", None)],
        "member_key string, payer string, plan string, coverage_type string, span_start_dt string, span_end_dt string",
    )
    spans = mapping.consolidated(rows, members)
    assert sorted((str(r.start_date), str(r.end_date)) for r in spans.collect()) == [("2025-01-01", "2025-04-30"), ("2025-06-01", "2025-06-30"), ("2025-07-02", "None")]
    assert sorted(r.field for r in mapping.quarantined_spans(rows, members).collect()) == ["member_key", "span_end_dt", "span_end_dt", "span_start_dt"]
    assert mapping.overlaps(spans).count() == 0


def test_gate_names_what_fails(spark, members):
    rows = claim(spark, {"clm_id": "c", "line_no": "1", "member_key": "m1"})
    spans = spark.createDataFrame([("m1", "a", "x", "c", "2025-01-01", None)], "member_key string, payer string, plan string, coverage_type string, span_start_dt string, span_end_dt string")
    got = {r.check: r.passes for r in mapping.gate(rows, spans, members).collect()}
    assert got == {"grain": True, "reconciliation": True, "claim_type": True, "coverage": True, "overlaps": True, "exercised_line_no": False, "exercised_clm_id": False}


def test_a_line_without_one_of_its_amounts_reconciles(spark, members):
    amounts = [("200", "100", ""), ("200", "100", "n/a"), ("-200", "-100", None), ("", "200", "100"), ("200", " ", "100"), (None, None, None), ("100", "100", "100"), ("200", "100", "300"), ("-100", "-300", "-200")]
    rows = claim(spark, *[{"clm_id": f"c{i}", "line_no": "1", "member_key": "m1", "paid_cents": p, "allowed_cents": a, "charge_cents": c} for i, (p, a, c) in enumerate(amounts)])
    spans = spark.createDataFrame([("m1", "a", "x", "c", "2025-01-01", None)], "member_key string, payer string, plan string, coverage_type string, span_start_dt string, span_end_dt string")
    assert sorted(r.claim_id for r in mapping.unreconciled(mapping.lines(rows)).collect()) == ["c7", "c8"]
    assert {r.check: r.violations for r in mapping.gate(rows, spans, members).collect()}["reconciliation"] == 2
    assert {r.check: r.passes for r in mapping.gate(rows.limit(7), spans, members).collect()}["reconciliation"]


QUARANTINE = [
    ("medical-claims", "[1]", "record_not_object"), ("medical-claims", "not json", "record_not_object"), ("medical-claims", '{"claim_id":"a","claim_line_number":1}', None), ("medical-claims", '{"claim_line_number":1}', "missing_required_field"),
    ("medical-claims", '{"claim_id":null,"claim_line_number":1}', "missing_required_field"), ("medical-claims", '{"claim_id":5,"claim_line_number":1}', "invalid_required_type"), ("medical-claims", '{"claim_id":" ","claim_line_number":1}', "invalid_identifier"),
    ("medical-claims", '{"claim_id":"a","claim_line_number":true}', "invalid_required_type"), ("medical-claims", '{"claim_id":"a","claim_line_number":[1]}', "invalid_required_type"), ("medical_claim", '{"claim_id":"a","claim_line_number":" "}', "invalid_identifier"),
    ("medical-claims", '{"claim_id":"a","claim_line_number":"1","claim_start_date":"2025/01/01"}', "invalid_date_format"), ("medical-claims", '{"claim_id":"a","claim_line_number":"1","claim_start_date":"2025-01-01T00:00"}', None),
    ("eligibility", '{"person_id":"p","enrollment_start_date":null}', None), ("eligibility", '{"person_id":"p","enrollment_end_date":20250101}', "invalid_date_format"),
]


def test_quarantine(spark):
    for endpoint in {e for e, _, _ in QUARANTINE}:
        df = spark.createDataFrame([(p, w) for e, p, w in QUARANTINE if e == endpoint], "payload string, want string")
        for r in ingest.quarantined(df, endpoint).collect():
            assert r.reason_code == r.want, r.payload


STAMPS = [
    ('"2025-01-02T03:04:05Z"', "2025-01-02 03:04:05", None), ('"2025-01-02T03:04:05+05:30"', "2025-01-01 21:34:05", None), ('"2025-01-02"', "2025-01-02 00:00:00", None), ('"2025-01-02T03:04:05"', "2025-01-02 03:04:05", None),
    ('"soon"', None, "invalid_source_timestamp"), ("5", None, "invalid_source_timestamp"), ('" "', None, "missing_source_timestamp"), ("null", None, "missing_source_timestamp"),
]


def test_accept_and_reject(spark):
    rows = [(f'{{"person_id":"p","updated_at":{s}}}', t, w, "p") for s, t, w in STAMPS] + [("3", None, "not_an_object", None), ('{"person_id":"p"}', None, "missing_source_timestamp", "p"), ('{"updated_at":"2025-01-01"}', "2025-01-01 00:00:00", "missing_source_id", None)]
    df = spark.createDataFrame(rows, "payload string, stamp string, want string, id string")
    for r in ingest.classified(df, "eligibility").withColumn("t", F.col("_source_updated_at").cast("string")).collect():
        assert (r.reject_reason, r.t, r._source_record_id) == (r.want, r.stamp, r.id), r.payload
        assert (r._payload_hash is None) == (r.want is not None)


def test_merge_is_idempotent_and_nulls_never_meet(spark):
    old = spark.createDataFrame([("a", 1), (None, 1)], "k string, n int")
    new = spark.createDataFrame([("a", 2), ("b", 4), ("b", 3), (None, 5), (None, 6)], "k string, n int")
    got = ingest.merge_absent(old, new, ["k"], ["n"])
    assert sorted((r.k or "", r.n) for r in got.collect()) == [("", 5), ("", 6), ("b", 3)]
    assert ingest.merge_absent(old.union(got), new, ["k"], ["n"]).where("k IS NOT NULL").count() == 0


def test_watermarks(spark):
    pages = spark.createDataFrame([("r", 1, "9"), ("r", 2, "5")], "run string, page int, mark string")
    assert ingest.last_watermark(pages, "run", "page", "mark").first().candidate == "5"
    committed = spark.createDataFrame([("e", "7")], "endpoint string, committed string")
    candidates = spark.createDataFrame([("e", "5"), ("e", "7"), ("f", "1")], "endpoint string, candidate string")
    assert sorted((r.endpoint, r.candidate, r.refused, r.watermark) for r in ingest.guarded(committed, candidates, ["endpoint"]).collect()) == [("e", "5", True, "7"), ("e", "7", False, "7"), ("f", "1", False, "1")]
    assert ingest.since(candidates, "candidate", None).count() == 3 and ingest.since(candidates, "candidate", "5").count() == 1


def test_states(spark):
    df = spark.createDataFrame([("running", "published"), ("published", "committed"), ("loading", "committed"), ("committed", "failed")], "before string, after string")
    assert [r.allowed for r in ingest.transitions(df, "objects").collect()] == [True, False, True, False]


def test_drift_walks_everything(spark):
    assert sorted(drift.kinds({"a": [1, {"b": None}], "c": True})) == [("a", "array"), ("a[]", "number"), ("a[]", "object"), ("a[].b", "null"), ("c", "boolean")]
    df = spark.createDataFrame([(1, '{"a":1}'), (1, '{"a":2}'), (2, '{"a":"x","b":[]}'), (2, None), (3, "[]")], "page int, payload string")
    seen = drift.observed(df, ["page"])
    assert sorted((r.path, r.type, r.occurrence_count, r.first_page, r.last_page) for r in drift.counted(seen, ["page"]).collect()) == [("a", "number", 1, 1, 1), ("a", "string", 1, 2, 2), ("b", "array", 1, 2, 2)]


def test_generic_checks(spark):
    df = spark.createDataFrame([("a", None), ("b", 1), ("b", 1)], "x string, y int")
    assert {r.column_name: r.violations for r in quality.not_null(df, ["x", "y"]).collect()} == {"x": 0, "y": 1}
    assert [(r.value, r.n) for r in quality.accepted_values(df, "x", ["a"]).collect()] == [("b", 2)]
    assert [(r.x, r.y, r.n) for r in quality.unique_combination(df, ["x", "y"]).collect()] == [("b", 1, 2)]


def test_exact_hashes(spark):
    import hashlib

    texts = ['{"b": 1.50, "a": {"y": "é", "x": null}}', '{"a":{"x":null,"y":"é"},"b":1.5}', '{"a": 1e2}', "no json", None]
    rows = hashes.exact_hashes(spark.createDataFrame([(t,) for t in texts], "payload string")).collect()
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    assert rows[0].payload_sha256 == rows[1].payload_sha256 == sha('{"a":{"x":null,"y":"é"},"b":1.5}')
    assert rows[0].record_sha256 == sha('{"a": {"x": null, "y": "é"}, "b": 1.5}')
    assert rows[2].payload_sha256 == sha('{"a":100.0}') and rows[3].payload_sha256 is None and rows[4].record_sha256 is None


def test_one_frame_merge_is_the_two_frame_merge(spark):
    rows = [("run1", 1, "a", 1), ("run2", 2, "a", 1), ("run2", 3, "b", 1), ("run2", 4, "b", 1), ("run2", 5, None, 1), ("run2", 6, None, 1), ("run1", 7, None, 1), ("run2", 8, "b", 2)]
    df = spark.createDataFrame(rows, "run string, n int, k string, v int")
    two = ingest.merge_absent(df.where("run = 'run1'"), df.where("run = 'run2'"), ["k", "v"], ["n"])
    one = ingest.merge_marked(df, ["k", "v"], ["n"], F.col("run") == "run1")
    assert sorted(r.n for r in one.collect()) == sorted(r.n for r in two.collect()) == [3, 5, 6, 8] and one.columns == df.columns
    marked = df.withColumn("f", ingest.turns(df, ["k", "v"], ["n"]))
    assert sorted(r.n for r in marked.where("f").collect()) == [1, 3, 5, 6, 7, 8]


def test_parents_counters_and_freshness(spark):
    children = spark.createDataFrame([(1, "r1"), (2, "r9"), (3, None)], "id int, run_id string")
    assert [r.id for r in ingest.missing_parents(children, spark.createDataFrame([("r1",), (None,)], "run_id string"), "run_id").collect()] == [2]
    empty = spark.createDataFrame([], "p string, t string, fingerprint string, first_observed long, last_observed long, occurrence_count long")
    seen = spark.createDataFrame([("a", "x", "f", 5), ("a", "x", "g", 6), ("b", "x", "f", 7)], "p string, t string, fingerprint string, observed long")
    once = ingest.count_observations(empty, seen, ["p", "t"])
    twice = ingest.count_observations(once, seen.where("p = 'a'").withColumn("observed", F.col("observed") + 10), ["p", "t"])
    assert sorted(map(tuple, twice.collect())) == [("a", "x", "g", 6, 16, 2), ("b", "x", "f", 7, 7, 1)]
    rows = spark.createDataFrame([("2025-01-01 00:00:00",)], "t string").selectExpr("CAST(t AS timestamp) AS _loaded_at")
    assert [ingest.source_freshness(rows, now).first().status for now in ("2025-01-02 00:00:00", "2025-01-02 00:00:01", "2025-01-04 00:00:01")] == ["pass", "warn", "error"]


@pytest.mark.parametrize("value, want", [("1e2", "100"), ("1" * 45, "1" * 45), ("-0.0", "0"), ("9007199254740993.0", "9007199254740993"), ("1e40", None), ("0.5", None), ("true", None), ('"  "', None), ("[]", None), ("null", None)])
def test_numbers_as_identifiers(spark, value, want):
    df = spark.createDataFrame([(f'{{"k":{value}}}',)], "p string")
    assert df.select(X.id_part(X.json_probe(F.col("p"), "k")).alias("i")).first().i == want


def test_kind_of_a_whole_document(spark):
    pairs = [(' \n{"a":1}', "object"), ("[", None), ("\t[1]", "array"), ('"x"', "string"), ("-1.5", "number"), ("true", "boolean"), (" null", "null"), ("", None), (None, None), (" " * 100 + "{}", "object")]
    df = spark.createDataFrame([*enumerate(p for p, _ in pairs)], "i int, p string")
    got = {r.i: r.k for r in df.select("i", X.json_kind(X.json_probe(F.col("p"))).alias("k")).collect()}
    assert [got[i] for i in range(len(pairs))] == [k for _, k in pairs]


def test_rows_as_json_and_unions(spark):
    df = spark.createDataFrame([(1, None, 'say "é"\n'), (2, "", None)], "n int, a string, B string")
    assert [json.loads(r.raw_row) for r in staging.row_json(df).collect()] == [{"n": "1", "a": None, "B": 'say "é"\n'}, {"n": "2", "a": "", "B": None}]
    both = staging.both_loaders(spark.createDataFrame([("s", "x")], "_snapshot_id string, raw_row string"), spark.createDataFrame([("y",)], "_raw_payload string"))
    assert sorted(map(tuple, both.collect()), key=str) == [("s", "x", None), (None, None, "y")] or both.count() == 2
