"""The registered claims queries, each with SQL that gives the same rows. All run over whole tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quillsieve.functions import exprs as X
from quillsieve.operators import drift, hashes, ingest, mapping, quality, staging
from quillsieve.plans import contract_sql
from quillsieve.plans.contracts import GRAIN, STAGING
from quillsieve.sources import feed
from quillsieve.sources.feed import plain_sql, spark_frame
from quillsieve.sources import files
from quillsieve.sources.files import mismatches
from quillsieve.sources.shared import Store, shared_root

DEFAULT_SOURCE = "feed0"
Query = Callable[[SparkSession, str], DataFrame]
_queries: dict[str, Query] = {}
_oracles: dict[str, str] = {}


def _add(name: str, query: Query, sql: str | None = None) -> None:
    _queries[name] = query
    if sql is not None:
        _oracles[name] = sql


# What the SQL is made of.


def _strip(x: str) -> str:
    return rf"nullif(regexp_replace({x}, '^\s+|\s+$', '', 'g'), '')"


def _field(key: str, payload: str = "coalesce(_raw_payload, raw_row)") -> str:
    return f"nullif(trim(json_extract_string({payload}, '$.{key}')), '')"


def _as_date(x: str) -> str:
    return f"CASE WHEN regexp_full_match({x}, '[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}') THEN TRY_CAST({x} AS DATE) END"


def _as_int(x: str) -> str:
    return f"CASE WHEN regexp_full_match({x}, '-?[0-9]+') THEN TRY_CAST({x} AS INTEGER) END"


def _as_number(x: str, kind: str) -> str:
    return f"CASE WHEN regexp_full_match({x}, '-?[0-9]+(\\.[0-9]+)?') THEN TRY_CAST({x} AS {kind}) END"


def _cents(x: str) -> str:
    return f"CASE WHEN regexp_full_match({_strip(x)}, '-?[0-9]+') THEN (TRY_CAST({_strip(x)} AS DECIMAL(20,0)) * 0.01)::DECIMAL(18,2) END"


def _final_sql(table: str) -> str:
    return contract_sql.contract(table, plain_sql(feed.RAW[table]), DEFAULT_SOURCE)


_CLAIMS = plain_sql(feed.VENDOR_CLAIMS)
_SPANS = plain_sql(feed.VENDOR_SPANS)
_MEMBERS = f"""SELECT member_key, arg_max(person_id, load_order) AS person_id FROM (
  SELECT {_strip('member_key')} AS member_key, {_strip('person_id')} AS person_id, load_order FROM ({plain_sql(feed.CROSSWALK)}) x)
  WHERE member_key IS NOT NULL AND person_id IS NOT NULL GROUP BY member_key"""
_TYPE = f"""CASE WHEN {_strip('claim_form_code')} = 'UB04' THEN 'institutional' WHEN {_strip('claim_form_code')} = 'CMS1500' THEN 'professional'
  WHEN {_strip('bill_type_code')} IS NOT NULL THEN 'institutional' WHEN {_strip('place_of_service_code')} IS NOT NULL THEN 'professional' ELSE 'undetermined' END"""
_LINES = f"""
members AS ({_MEMBERS}),
different AS (SELECT DISTINCT * FROM ({_CLAIMS}) x),
named AS (
  SELECT *, {_strip('clm_id')} AS claim_id, {_as_int(_strip('line_no'))} AS line, {_strip('member_key')} AS mk FROM different),
lines AS (
  SELECT n.claim_id, n.line AS line_no, n.mk AS member_key, m.person_id, m.person_id IS NOT NULL AS matched_member, {_strip('n.clm_status_code')} AS clm_status_code,
    {_strip('n.orig_clm_id')} AS orig_clm_id, {_TYPE} AS claim_type, {_cents('paid_cents')} AS paid_amount, {_cents('allowed_cents')} AS allowed_amount, {_cents('charge_cents')} AS charge_amount,
    {_strip('diag_type')} AS diag_type, {_strip('proc_type')} AS proc_type, diag_cd_1, diag_cd_2, diag_cd_3, proc_cd_1, proc_dt_1, proc_cd_2, proc_dt_2
  FROM named n LEFT JOIN members m ON m.member_key = n.mk
  WHERE n.claim_id IS NOT NULL AND n.line IS NOT NULL AND n.mk IS NOT NULL),
refused AS (
  SELECT * EXCLUDE (claim_id, line, mk), CASE WHEN claim_id IS NULL THEN 'missing' WHEN line IS NULL THEN 'not_an_integer' ELSE 'missing' END AS reason,
    CASE WHEN claim_id IS NULL THEN 'clm_id' WHEN line IS NULL THEN 'line_no' ELSE 'member_key' END AS field
  FROM named WHERE claim_id IS NULL OR line IS NULL OR mk IS NULL)"""
_P = "person_id, payer, plan, coverage_type"
_CONSOLIDATED = f"""
classed AS (
  SELECT {_strip('s.member_key')} AS member_key, m.person_id, coalesce({_strip('payer')}, '') AS payer, coalesce({_strip('plan')}, '') AS plan, coalesce({_strip('coverage_type')}, '') AS coverage_type,
    {_as_date(_strip('span_start_dt'))} AS start_date, {_strip('span_end_dt')} AS end_text, {_as_date(_strip('span_end_dt'))} AS end_date
  FROM ({_SPANS}) s LEFT JOIN span_members m ON m.member_key = {_strip('s.member_key')}),
judged AS (
  SELECT *, CASE WHEN person_id IS NULL THEN 'member_key' WHEN start_date IS NULL THEN 'span_start_dt' WHEN end_text IS NOT NULL AND end_date IS NULL THEN 'span_end_dt' WHEN end_date < start_date THEN 'span_end_dt' END AS field FROM classed),
good AS (SELECT DISTINCT {_P}, start_date, end_date FROM judged WHERE field IS NULL),
flagged AS (
  SELECT *, CASE WHEN start_date <= max(end_date) OVER (PARTITION BY {_P} ORDER BY start_date, end_date ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) + 1 THEN 0 ELSE 1 END AS opens
  FROM good WHERE end_date IS NOT NULL),
islands AS (SELECT *, sum(opens) OVER (PARTITION BY {_P} ORDER BY start_date, end_date ROWS UNBOUNDED PRECEDING) AS island FROM flagged),
spans AS (
  SELECT {_P}, min(start_date) AS start_date, max(end_date) AS end_date FROM islands GROUP BY {_P}, island
  UNION ALL SELECT {_P}, start_date, end_date FROM good WHERE end_date IS NULL)"""
_SPAN_CTES = f"span_members AS ({_MEMBERS}), {_CONSOLIDATED}"
_RECORDS = plain_sql(feed.RECORDS)
_RUNS = plain_sql(feed.RUNS)
_KIND = """CASE json_type({0}) WHEN 'OBJECT' THEN 'object' WHEN 'ARRAY' THEN 'array' WHEN 'VARCHAR' THEN 'string' WHEN 'BOOLEAN' THEN 'boolean' WHEN 'NULL' THEN 'null' ELSE 'number' END"""


def _kind(payload: str, key: str | None = None) -> str:
    at = payload if key is None else f"json_extract({payload}, '$.{key}')"
    return f"CASE WHEN ({at}) IS NOT NULL THEN {_KIND.format(at)} END"


def _raw(spark: SparkSession, d: str, table: str) -> DataFrame:
    return spark_frame(spark, d, feed.RAW[table])


def _claims(spark: SparkSession, d: str) -> DataFrame:
    return spark_frame(spark, d, feed.VENDOR_CLAIMS)


def _members(spark: SparkSession, d: str) -> DataFrame:
    return mapping.crosswalk(spark_frame(spark, d, feed.CROSSWALK), "load_order")


def _lines(spark: SparkSession, d: str) -> DataFrame:
    return mapping.accepted(_claims(spark, d), _members(spark, d))


def _bare(spark: SparkSession, d: str, *columns: str) -> DataFrame:
    return mapping.lines(_claims(spark, d), list(columns))


def _adjustments(spark: SparkSession, d: str) -> DataFrame:
    good = _claims(spark, d).where(mapping.reject_reason().isNull())
    return good.select(*[X.strip(F.col(c)).alias(c) for c in ("clm_status_code", "orig_clm_id")])


def _spans(spark: SparkSession, d: str) -> DataFrame:
    return mapping.consolidated(spark_frame(spark, d, feed.VENDOR_SPANS), _members(spark, d))


def _records(spark: SparkSession, d: str) -> DataFrame:
    return spark_frame(spark, d, feed.RECORDS)


def _runs(spark: SparkSession, d: str) -> DataFrame:
    return spark_frame(spark, d, feed.RUNS)


# Scalars.

def _payload() -> Column:
    return X.effective_payload(F.col("_raw_payload"), F.col("raw_row"))


_add(
    "raw_field_extract",
    lambda s, d: _raw(s, d, "medical_claim").select("_snapshot_id", "_source_row_number", X.json_fields(_payload(), ["claim_id", "payer", "place_of_service_code", "not_there"]).alias("f")).select("_snapshot_id", "_source_row_number", "f.*"),
    f"SELECT _snapshot_id, _source_row_number, {', '.join(f'{_field(k)} AS {k}' for k in ('claim_id', 'payer', 'place_of_service_code', 'not_there'))} FROM ({plain_sql(feed.RAW['medical_claim'])}) r",
)
_add(
    "trim_normalize",
    lambda s, d: _claims(s, d).select(*[X.strip(F.col(c)).alias(c) for c in ("clm_id", "line_no", "member_key", "bill_type_code", "diag_cd_2")]),
    f"SELECT {', '.join(f'{_strip(c)} AS {c}' for c in ('clm_id', 'line_no', 'member_key', 'bill_type_code', 'diag_cd_2'))} FROM ({_CLAIMS}) c",
)


def _cast_query(name: str, table: str, columns: list[tuple[str, str]]) -> None:
    make = {"date": X.safe_date, "int": X.safe_integer, "numeric": X.safe_numeric}
    sql = {"date": _as_date, "int": _as_int, "numeric": lambda x: _as_number(x, "DECIMAL(38,10)")}
    _add(
        name,
        lambda s, d: _raw(s, d, table).select("_source_row_number", X.json_fields(_payload(), [c for c, _ in columns]).alias("f")).select("_source_row_number", *[make[k](F.col(f"f.{c}")).alias(c) for c, k in columns]),
        f"SELECT _source_row_number, {', '.join(f'{sql[k](_field(c))} AS {c}' for c, k in columns)} FROM ({plain_sql(feed.RAW[table])}) r",
    )


_cast_query("safe_date_cast", "medical_claim", [("claim_start_date", "date"), ("claim_end_date", "date")])
_cast_query("safe_numeric_cast", "medical_claim", [("paid_amount", "numeric"), ("deductible_amount", "numeric")])
_cast_query("safe_integer_cast", "pharmacy_claim", [("quantity", "int"), ("refills", "int")])
_add("cents_to_amount", lambda s, d: _claims(s, d).select("clm_id", X.cents_to_amount(F.col("paid_cents")).alias("paid"), X.cents_to_amount(F.col("charge_cents")).alias("charge")), f"SELECT clm_id, {_cents('paid_cents')} AS paid, {_cents('charge_cents')} AS charge FROM ({_CLAIMS}) c")
_add("payload_coalesce", lambda s, d: _raw(s, d, "eligibility").select("_source_row_number", _payload().alias("payload")), f"SELECT _source_row_number, coalesce(_raw_payload, raw_row) AS payload FROM ({plain_sql(feed.RAW['eligibility'])}) r")
_add("claim_type_derivation", lambda s, d: _claims(s, d).select("clm_id", "line_no", X.claim_type(F.col("claim_form_code"), F.col("bill_type_code"), F.col("place_of_service_code")).alias("claim_type")), f"SELECT clm_id, line_no, {_TYPE} AS claim_type FROM ({_CLAIMS}) c")
def _id_of(payload: Column) -> Column:
    return X.parsed(payload, {"a": "claim_id", "b": "claim_line_number"}, lambda p, _: X.record_id([X.id_part(p["a"]), X.id_part(p["b"])]))


_add(
    "source_record_id",
    lambda s, d: _raw(s, d, "medical_claim").select("_source_row_number", _id_of(_payload()).alias("record_id")),
    f"""SELECT _source_row_number, octet_length(encode(a))::VARCHAR || ':' || a || octet_length(encode(b))::VARCHAR || ':' || b AS record_id
    FROM (SELECT _source_row_number, {_strip("json_extract_string(coalesce(_raw_payload, raw_row), '$.claim_id')")} AS a, {_strip("json_extract_string(coalesce(_raw_payload, raw_row), '$.claim_line_number')")} AS b FROM ({plain_sql(feed.RAW['medical_claim'])}) r) x""",
)
#: Identifiers that are JSON numbers: whole ones of any size, with fractions of zeros, and what is none.
_NUMBERS = """SELECT o_orderkey, '{{"claim_id":' || CASE o_orderkey % 10 WHEN 0 THEN CAST(o_orderkey AS STRING) WHEN 1 THEN CAST(o_orderkey AS STRING) || '.0' WHEN 2 THEN '9876543210987654321' || CAST(100000000 + o_orderkey AS STRING)
 WHEN 3 THEN CAST(o_orderkey AS STRING) || '.5' WHEN 4 THEN 'true' WHEN 5 THEN '" "' WHEN 6 THEN '{{"a":1}}' WHEN 7 THEN '12345678901234567' || CAST(o_orderkey % 10 AS STRING) || '.00' WHEN 8 THEN '1' || repeat('7', 45) ELSE '-' || CAST(o_orderkey AS STRING) END
 || ',"claim_line_number":' || CASE o_orderkey % 3 WHEN 0 THEN '"é "' WHEN 1 THEN '2e1' ELSE '3' END || '}}' AS payload FROM {orders}"""
_add(
    "source_record_id_numbers",
    lambda s, d: spark_frame(s, d, _NUMBERS).select("o_orderkey", _id_of(F.col("payload")).alias("record_id")),
    """SELECT o_orderkey, length(a)::VARCHAR || ':' || a || CASE o_orderkey % 3 WHEN 0 THEN '2:é' WHEN 1 THEN '2:20' ELSE '1:3' END AS record_id FROM (SELECT o_orderkey, CASE o_orderkey % 10 WHEN 0 THEN o_orderkey::VARCHAR WHEN 1 THEN o_orderkey::VARCHAR
    WHEN 2 THEN '9876543210987654321' || (100000000 + o_orderkey) WHEN 7 THEN '123456789012345677' WHEN 8 THEN '1' || repeat('7', 45) WHEN 9 THEN '-' || o_orderkey END AS a FROM orders) x""",
)
_STAMP = r"""CASE WHEN regexp_full_match({0}, '\d{{4}}-\d{{2}}-\d{{2}}([T ]\d{{2}}:\d{{2}}:\d{{2}}Z?)?') THEN TRY_CAST(replace({0}, 'Z', '') AS TIMESTAMP) END"""
_add(
    "source_updated_at",
    lambda s, d: _raw(s, d, "medical_claim").select("_source_row_number", X.updated_at(F.get_json_object(_payload(), "$.updated_at")).cast("timestamp_ntz").alias("updated_at")),
    f"SELECT _source_row_number, {_STAMP.format('t')} AS updated_at FROM (SELECT _source_row_number, {_strip(_field('updated_at'))} AS t FROM ({plain_sql(feed.RAW['medical_claim'])}) r) x",
)
_STAMPS = """SELECT o_orderkey, CASE o_orderkey % 12 WHEN 0 THEN '2024-02-29T03:04:05+05:30' WHEN 1 THEN '20240229T030405' WHEN 2 THEN ' 2024-02-29 03:04:05.123456789 ' WHEN 3 THEN '2024-02-29T03' WHEN 4 THEN '2024-02-30' WHEN 5 THEN '2024-02-29T24:30'
 WHEN 6 THEN '2024-02-29T03:04:05,5Z' WHEN 7 THEN '20240229' WHEN 8 THEN 'soon' WHEN 9 THEN '2024-02-29T030405-0100' WHEN 10 THEN '2024-02-29x03:04-00:00:30' ELSE '2024-02-29' END AS stamp FROM {orders}"""
_add(
    "iso_timestamps",
    lambda s, d: spark_frame(s, d, _STAMPS).select("o_orderkey", X.updated_at(F.col("stamp")).cast("timestamp_ntz").alias("updated_at")),
    """SELECT o_orderkey, CASE o_orderkey % 12 WHEN 0 THEN TIMESTAMP '2024-02-28 21:34:05' WHEN 1 THEN TIMESTAMP '2024-02-29 03:04:05' WHEN 2 THEN TIMESTAMP '2024-02-29 03:04:05.123456' WHEN 3 THEN TIMESTAMP '2024-02-29 03:00:00'
    WHEN 6 THEN TIMESTAMP '2024-02-29 03:04:05.5' WHEN 7 THEN TIMESTAMP '2024-02-29' WHEN 9 THEN TIMESTAMP '2024-02-29 04:04:05' WHEN 10 THEN TIMESTAMP '2024-02-29 03:04:30' WHEN 11 THEN TIMESTAMP '2024-02-29' END AS updated_at FROM orders""",
)
_LOG = "SELECT o_orderkey, CASE o_orderkey % 4 WHEN 0 THEN 'sent Bearer abc.' || CAST(o_custkey AS STRING) || '-x to all' WHEN 1 THEN 'at postgres://me:pw' || CAST(o_custkey AS STRING) || '@host/db and POSTGRESQL://u@h' WHEN 2 THEN o_orderpriority END AS line FROM {orders}"
_add(
    "redact_text",
    lambda s, d: spark_frame(s, d, _LOG).select("o_orderkey", X.redact(F.col("line")).alias("line")),
    rf"SELECT o_orderkey, regexp_replace(regexp_replace(line, '(bearer\s+)[A-Za-z0-9._\-]+', '\1***REDACTED***', 'gi'), '(postgres(?:ql)?://)[^@\s]+@', '\1***REDACTED***@', 'gi') AS line FROM ({plain_sql(_LOG)}) l",
)
_NOTES = "SELECT p_partkey, p_name || CASE p_partkey % 5 WHEN 0 THEN ' todo later' WHEN 1 THEN ' Unknown, TBD' WHEN 2 THEN ' lorem  ipsum lorem ipsum' WHEN 3 THEN ' xXx fixmes Fill This In' ELSE '' END AS note FROM {part}"
_add(
    "placeholder_scan",
    lambda s, d: spark_frame(s, d, _NOTES).select("p_partkey", F.array_join(X.placeholders(F.col("note")), ",").alias("found")),
    "SELECT p_partkey, concat_ws(',', " + ", ".join(rf"nullif(regexp_extract(note, '(?i)({p})', 1), '')" for p in X.PLACEHOLDERS) + f") AS found FROM ({plain_sql(_NOTES)}) n",
)
_add("shorten_text", lambda s, d: s.read.parquet(f"{d.rstrip('/')}/part.parquet").select("p_partkey", X.shortened(F.col("p_name"), 20).alias("name")), "SELECT p_partkey, CASE WHEN length(p_name) > 20 THEN substr(p_name, 1, 17) || '...' ELSE p_name END AS name FROM part")
_FORMED = "SELECT c_custkey, CASE c_custkey % 7 WHEN 0 THEN 'run_' || CAST(c_custkey AS STRING) WHEN 1 THEN '2024-01-02T' || CAST(c_custkey AS STRING) WHEN 2 THEN '123e4567-e89b-42d3-a456-426614174000' WHEN 3 THEN '../up' WHEN 4 THEN repeat('ab', 32) WHEN 5 THEN '2024-01-02' || chr(10) END AS word FROM {customer}"
_add(
    "form_predicates",
    lambda s, d: spark_frame(s, d, _FORMED).select("c_custkey", *[X.has_form(F.col("word"), f).alias(f) for f in X.FORMS]),
    """SELECT c_custkey, c_custkey % 7 = 0 AS identifier, c_custkey % 7 IN (0, 1, 2, 4) AS component, c_custkey % 7 = 2 AS uuid, c_custkey % 7 = 1 AS date_shape, c_custkey % 7 = 4 AS sha256 FROM customer""",
)
_UNSORTED = """SELECT o_orderkey, '{{"z":{{"b":"' || o_orderstatus || '","a":null}},"b":"' || o_orderpriority || '", "a": "' || CAST(o_custkey AS STRING) || '"}}' AS payload FROM {orders}"""
_SORTED = """SELECT o_orderkey, sha256('{{"a":"' || CAST(o_custkey AS STRING) || '","b":"' || o_orderpriority || '","z":{{"a":null,"b":"' || o_orderstatus || '"}}}}') AS hash FROM {orders}"""
_add("payload_hash", lambda s, d: spark_frame(s, d, _UNSORTED).select("o_orderkey", X.payload_hash(F.col("payload")).alias("hash")), plain_sql(_SORTED))

_EXACT = _SORTED.replace("sha256(", "").replace("}}}}') AS hash", "}}}}' AS hash")
_add(
    "record_fingerprint",
    lambda s, d: hashes.exact_hashes(spark_frame(s, d, _UNSORTED)).select("o_orderkey", "payload_sha256", "record_sha256"),
    f"""SELECT o_orderkey, sha256(text) AS payload_sha256, sha256(replace(replace(text, ',"', ', "'), '":', '": ')) AS record_sha256 FROM ({plain_sql(_EXACT).replace(' AS hash', ' AS text')}) x""",
)

# Projections.

for _t in STAGING:
    _add(
        f"stg_{_t}",
        lambda s, d, t=_t: staging.staged(_raw(s, d, t), t, DEFAULT_SOURCE),
        contract_sql.staged(_t, plain_sql(feed.RAW[_t]), DEFAULT_SOURCE),
    )
    _add(f"input_{_t}", lambda s, d, t=_t: staging.final(_raw(s, d, t), t, DEFAULT_SOURCE), _final_sql(_t))

# Claims.

_SHOWN = ["claim_id", "line_no", "member_key", "person_id", "matched_member", "clm_status_code", "orig_clm_id", "claim_type", "paid_amount", "allowed_amount", "charge_amount"]
_add("crosswalk_left_join", lambda s, d: _lines(s, d).select("claim_id", "line_no", "member_key", "person_id", "matched_member"), f"WITH {_LINES} SELECT claim_id, line_no, member_key, person_id, matched_member FROM lines")
_add("claims_accepted", lambda s, d: _lines(s, d).select(*_SHOWN), f"WITH {_LINES} SELECT {', '.join(_SHOWN)} FROM lines")
_add("claims_rejected", lambda s, d: mapping.rejected(_claims(s, d)), f"WITH {_LINES} SELECT * FROM refused")
_add(
    "crosswalk_anti_quarantine",
    lambda s, d: mapping.quarantined_spans(spark_frame(s, d, feed.VENDOR_SPANS), _members(s, d)),
    f"WITH {_SPAN_CTES} SELECT member_key, payer, plan, coverage_type, start_date, end_text, field FROM judged WHERE field IS NOT NULL",
)
_add("orphan_adjustments", lambda s, d: mapping.orphan_adjustments(_bare(s, d, "claim_id", "line_no", "clm_status_code", "orig_clm_id")), f"WITH {_LINES} SELECT claim_id, line_no, clm_status_code, orig_clm_id FROM lines WHERE orig_clm_id IS NOT NULL AND orig_clm_id NOT IN (SELECT claim_id FROM lines)")
_add(
    "net_paid_amount",
    lambda s, d: mapping.net_paid(_bare(s, d, "claim_id", "clm_status_code", "paid_amount"), _adjustments(s, d)),
    f"WITH {_LINES} SELECT coalesce(sum(paid_amount), 0)::DECIMAL(38,2) AS net_paid FROM lines WHERE NOT (clm_status_code = '1' AND claim_id IN (SELECT orig_clm_id FROM lines WHERE clm_status_code = '7' AND orig_clm_id IS NOT NULL))",
)
_add("dedup_exact_duplicates", lambda s, d: mapping.collapsed((c := _claims(s, d)).unionByName(c.where("clm_id LIKE '%5'"))), f"WITH a AS ({_CLAIMS}), b AS (SELECT * FROM a UNION ALL SELECT * FROM a WHERE clm_id LIKE '%5') SELECT (SELECT count(*) FROM b) AS n_rows, (SELECT count(*) FROM (SELECT DISTINCT * FROM b)) AS n_distinct, (SELECT count(*) FROM b) - (SELECT count(*) FROM (SELECT DISTINCT * FROM b)) AS n_collapsed")
_add("grain_conflicts", lambda s, d: mapping.grain_conflicts(_bare(s, d, "claim_id", "line_no"), ["claim_id", "line_no"]), f"WITH {_LINES} SELECT claim_id, line_no, count(*) AS n FROM lines GROUP BY ALL HAVING count(*) > 1")
_KEYS = f"SELECT member_key FROM lines UNION SELECT {_strip('member_key')} FROM ({_SPANS}) s WHERE {_strip('member_key')} IS NOT NULL"
_COVERAGE = f"SELECT count(m.member_key) AS matched, count(*) AS total, count(m.member_key) >= 0.90 * count(*) AS enough FROM ({_KEYS}) k LEFT JOIN members m ON m.member_key = k.member_key"
_add("fk_coverage", lambda s, d: mapping.coverage([mapping.accepted_keys(_claims(s, d)), spark_frame(s, d, feed.VENDOR_SPANS)], _members(s, d)), f"WITH {_LINES} {_COVERAGE}")
_BAD_AMOUNTS = "SELECT claim_id, line_no, paid_amount, allowed_amount, charge_amount FROM lines WHERE NOT (abs(paid_amount) <= abs(allowed_amount) AND abs(allowed_amount) <= abs(charge_amount)) AND paid_amount IS NOT NULL AND allowed_amount IS NOT NULL AND charge_amount IS NOT NULL"
_add("financial_reconciliation", lambda s, d: mapping.unreconciled(_bare(s, d, "claim_id", "line_no", "paid_amount", "allowed_amount", "charge_amount").dropna(subset=["paid_amount", "allowed_amount", "charge_amount"])), f"WITH {_LINES} {_BAD_AMOUNTS}")
_add("unexpected_claim_types", lambda s, d: mapping.unexpected_types(staging.staged(_raw(s, d, "medical_claim"), "medical_claim", DEFAULT_SOURCE), "claim_type", mapping.CLAIM_TYPES), f"SELECT DISTINCT {_field('claim_type')} AS value FROM ({plain_sql(feed.RAW['medical_claim'])}) r WHERE {_field('claim_type')} NOT IN ('institutional', 'professional', 'undetermined')")
_BROKEN = {c: f"{_strip(c)} NOT IN ({', '.join(repr(k) for k in known)})" for c, known in mapping.CODES.items()} | {"diag_type_missing": f"{_strip('diag_type')} IS NULL AND coalesce({', '.join(_strip(c) for c in mapping.DIAGNOSES)}) IS NOT NULL"}
_add("documented_codes", lambda s, d: mapping.code_checks(_claims(s, d)), f"WITH c AS ({_CLAIMS}) " + " UNION ALL ".join(f"SELECT '{n}' AS rule, count(*) FILTER (WHERE {b}) AS violations FROM c" for n, b in _BROKEN.items()))
_add("eligibility_consolidation", _spans, f"WITH {_SPAN_CTES} SELECT * FROM spans")
_OVERLAPS = f"SELECT {_P}, start_date, end_date, next_start, next_end FROM (SELECT *, lead(start_date) OVER w AS next_start, lead(end_date) OVER w AS next_end FROM {{0}} WHERE end_date IS NOT NULL WINDOW w AS (PARTITION BY {_P} ORDER BY start_date, end_date)) x WHERE next_start <= end_date"


def _unmerged(s: SparkSession, d: str) -> DataFrame:
    return mapping._classed_spans(spark_frame(s, d, feed.VENDOR_SPANS), _members(s, d)).where("field IS NULL").select(*mapping.PARTITION, "start_date", "end_date").distinct()


_add("span_overlaps", lambda s, d: mapping.overlaps(_unmerged(s, d)), f"WITH {_SPAN_CTES} {_OVERLAPS.format('good')}")
_add(
    "normalize_diagnoses",
    lambda s, d: mapping.diagnoses(_bare(s, d, "claim_id", "line_no", "diag_type", *mapping.DIAGNOSES)),
    f"""WITH {_LINES}, numbered AS (SELECT row_number() OVER () AS id, * FROM lines),
    long AS (SELECT id, claim_id, line_no, coalesce(diag_type, 'UNKNOWN_CODE_TYPE') AS code_type, p, code FROM numbered, LATERAL (VALUES (1, {_strip('diag_cd_1')}), (2, {_strip('diag_cd_2')}), (3, {_strip('diag_cd_3')})) v(p, code) WHERE code IS NOT NULL),
    one AS (SELECT id, claim_id, line_no, code_type, code, min(p) AS p FROM long GROUP BY ALL)
    SELECT claim_id, line_no, row_number() OVER (PARTITION BY id ORDER BY p)::INTEGER AS sequence, code_type, code, row_number() OVER (PARTITION BY id ORDER BY p) = 1 AS is_primary FROM one""",
)
_add(
    "normalize_procedures",
    lambda s, d: mapping.procedures(_bare(s, d, "claim_id", "line_no", "proc_type", *[x for pair in mapping.PROCEDURES for x in pair])),
    f"""WITH {_LINES}, numbered AS (SELECT row_number() OVER () AS id, * FROM lines),
    long AS (SELECT id, claim_id, line_no, coalesce(proc_type, 'UNKNOWN_CODE_TYPE') AS code_type, p, code, day FROM numbered, LATERAL (VALUES (1, {_strip('proc_cd_1')}, {_as_date(_strip('proc_dt_1'))}), (2, {_strip('proc_cd_2')}, {_as_date(_strip('proc_dt_2'))})) v(p, code, day) WHERE code IS NOT NULL),
    one AS (SELECT id, claim_id, line_no, code_type, code, min(p) AS p FROM long GROUP BY ALL)
    SELECT o.claim_id, o.line_no, row_number() OVER (PARTITION BY o.id ORDER BY o.p)::INTEGER AS sequence, o.code_type, o.code, l.day AS code_date FROM one o JOIN long l ON l.id = o.id AND l.p = o.p""",
)
_DOCS = "SELECT 'sheet' || CAST(r_regionkey AS STRING) AS name, CASE r_regionkey WHEN 1 THEN 'still TODO' WHEN 3 THEN 'Unknown, or tbd' ELSE r_name END AS text FROM {region}"


def _gated(s: SparkSession, d: str, *documents: DataFrame) -> DataFrame:
    return mapping.gate(_claims(s, d), spark_frame(s, d, feed.VENDOR_SPANS), _members(s, d), *documents)


_GATE_SQL = (
    f"""WITH {_LINES}, {_SPAN_CTES}, found AS (
    SELECT 'grain' AS "check", (SELECT count(*) FROM (SELECT 1 FROM lines GROUP BY claim_id, line_no HAVING count(*) > 1)) AS violations
    UNION ALL SELECT 'reconciliation', (SELECT count(*) FROM ({_BAD_AMOUNTS}))
    UNION ALL SELECT 'claim_type', (SELECT count(DISTINCT claim_type) FROM lines WHERE claim_type NOT IN ('institutional', 'professional', 'undetermined'))
    UNION ALL SELECT 'coverage', (SELECT CASE WHEN enough THEN 0 ELSE 1 END FROM ({_COVERAGE}))
    UNION ALL SELECT 'overlaps', (SELECT count(*) FROM ({_OVERLAPS.format('spans')}))
    UNION ALL SELECT 'exercised_line_no', CASE WHEN (SELECT count(*) FROM refused WHERE field = 'line_no') > 0 THEN 0 ELSE 1 END
    UNION ALL SELECT 'exercised_clm_id', CASE WHEN (SELECT count(*) FROM refused WHERE field = 'clm_id') > 0 THEN 0 ELSE 1 END)
    SELECT "check", violations::BIGINT AS violations, violations = 0 AS passes FROM found"""
)
_add("readiness_gate", _gated, _GATE_SQL)
_add(
    "readiness_verdict",
    lambda s, d: mapping.verdict(_gated(s, d, spark_frame(s, d, _DOCS))),
    f"""SELECT count(*) FILTER (WHERE NOT passes) = 0 AS ready, coalesce(string_agg("check", ',' ORDER BY "check") FILTER (WHERE NOT passes), '') AS reasons
    FROM ({_GATE_SQL} UNION ALL SELECT 'placeholders_sheet' || r_regionkey, CASE r_regionkey WHEN 1 THEN 1 WHEN 3 THEN 2 ELSE 0 END, r_regionkey NOT IN (1, 3) FROM region) x""",
)

# Checks of the contracts.


def _checked(s: SparkSession, d: str, table: str) -> DataFrame:
    return staging.final(_raw(s, d, table), table, DEFAULT_SOURCE)


_NN = ["claim_id", "claim_line_number", "claim_type", "person_id", "member_id", "claim_start_date", "paid_amount", "data_source"]
_add("dq_not_null", lambda s, d: quality.not_null(_checked(s, d, "medical_claim"), _NN), f"WITH f AS ({_final_sql('medical_claim')}) " + " UNION ALL ".join(f"SELECT '{c}' AS column_name, count(*) FILTER (WHERE {c} IS NULL) AS violations FROM f" for c in _NN))
_add("dq_accepted_values", lambda s, d: quality.accepted_values(_checked(s, d, "medical_claim"), "claim_type", mapping.CLAIM_TYPES), f"WITH f AS ({_final_sql('medical_claim')}) SELECT claim_type AS value, count(*) AS n FROM f WHERE claim_type NOT IN ('institutional', 'professional', 'undetermined') GROUP BY 1")
_add("dq_unique_combination", lambda s, d: quality.unique_combination(_checked(s, d, "medical_claim"), GRAIN["medical_claim"]), f"WITH f AS ({_final_sql('medical_claim')}) SELECT claim_id, claim_line_number, data_source, count(*) AS n FROM f GROUP BY 1, 2, 3 HAVING count(*) > 1")

# Landing.

_PERSON = "json_extract_string(payload, '$.person_id')"
_ID = f"CASE {_kind('payload', 'person_id')} WHEN 'string' THEN {_strip(_PERSON)} WHEN 'number' THEN CASE WHEN regexp_full_match({_PERSON}, '-?[0-9]+(\\.0+)?') THEN regexp_replace({_PERSON}, '\\.0+$', '') END END"
_STAMP_TEXT = "json_extract_string(payload, '$.updated_at')"
_QUARANTINE = f"""judged AS (
  SELECT *, CASE WHEN {_kind('payload')} <> 'object' THEN 'record_not_object'
    WHEN coalesce({_kind('payload', 'person_id')}, 'null') = 'null' THEN 'missing_required_field' WHEN {_kind('payload', 'person_id')} <> 'string' THEN 'invalid_required_type'
    WHEN {_strip("json_extract_string(payload, '$.person_id')")} IS NULL THEN 'invalid_identifier'
    WHEN coalesce({_kind('payload', 'enrollment_start_date')}, 'null') <> 'null' AND ({_kind('payload', 'enrollment_start_date')} <> 'string' OR NOT regexp_full_match(json_extract_string(payload, '$.enrollment_start_date'), '\\d{{4}}-\\d{{2}}-\\d{{2}}([T ].*)?')) THEN 'invalid_date_format' END AS reason_code
  FROM ({_RECORDS}) r)"""
_QFIELD = "CASE reason_code WHEN 'record_not_object' THEN NULL WHEN 'invalid_date_format' THEN 'enrollment_start_date' ELSE CASE WHEN reason_code IS NOT NULL THEN 'person_id' END END"
_CLASSED = f"""identified AS (SELECT *, CASE WHEN {_kind('payload')} = 'object' THEN {_ID} END AS _source_record_id, CASE WHEN {_kind('payload')} = 'object' AND {_kind('payload', 'updated_at')} = 'string' THEN {_STAMP.format(_STAMP_TEXT)} END AS _source_updated_at FROM ({_RECORDS}) r),
classed AS (
  SELECT *, CASE WHEN {_kind('payload')} <> 'object' THEN 'not_an_object' WHEN _source_record_id IS NULL THEN 'missing_source_id'
    WHEN coalesce({_kind('payload', 'updated_at')}, 'null') = 'null' OR ({_kind('payload', 'updated_at')} = 'string' AND {_strip(_STAMP_TEXT)} IS NULL) THEN 'missing_source_timestamp'
    WHEN _source_updated_at IS NULL THEN 'invalid_source_timestamp' END AS reject_reason
  FROM identified)"""


def _classified(s: SparkSession, d: str) -> DataFrame:
    return ingest.classified(_records(s, d), "eligibility").withColumn("_source_updated_at", F.col("_source_updated_at").cast("timestamp_ntz"))


def _quarantined(s: SparkSession, d: str) -> DataFrame:
    return ingest.quarantined(_records(s, d), "eligibility")


_add("quarantine_classification", lambda s, d: _quarantined(s, d).select("run_id", "page_number", "position", "reason_code", "field"), f"WITH {_QUARANTINE} SELECT run_id, page_number, position, reason_code, {_QFIELD} AS field FROM judged")
_add("quarantine_by_reason", lambda s, d: _quarantined(s, d).where("reason_code IS NOT NULL").groupBy("run_id", "reason_code").agg(F.count(F.lit(1)).alias("n")), f"WITH {_QUARANTINE} SELECT run_id, reason_code, count(*) AS n FROM judged WHERE reason_code IS NOT NULL GROUP BY 1, 2")
_add("accept_reject_classification", lambda s, d: _classified(s, d).select("run_id", "page_number", "position", "_source_record_id", "_source_updated_at", "reject_reason"), f"WITH {_CLASSED} SELECT run_id, page_number, position, _source_record_id, _source_updated_at, reject_reason FROM classed")


def _merged(s: SparkSession, d: str) -> DataFrame:
    good = _classified(s, d).where("reject_reason IS NULL").select("run_id", "page_number", "position", *ingest.KEY)
    return ingest.merge_marked(good, ingest.KEY, ["page_number", "position"], F.col("run_id") == "run1").select("page_number", "position", "_source_record_id", "_source_updated_at")


# two payloads are the same if their texts are, as the feed writes keys in one order
_GOOD = f"WITH {_CLASSED}, good AS (SELECT run_id, page_number, position, _source_record_id, _source_updated_at, payload FROM classed WHERE reject_reason IS NULL)"
_add(
    "merge_insert_if_absent",
    _merged,
    f"""{_GOOD}, firsts AS (SELECT *, row_number() OVER (PARTITION BY _source_record_id, _source_updated_at, payload ORDER BY page_number, position) AS turn FROM good WHERE run_id = 'run2')
    SELECT page_number, position, _source_record_id, _source_updated_at FROM firsts f WHERE turn = 1
    AND NOT EXISTS (SELECT 1 FROM good g WHERE g.run_id = 'run1' AND g._source_record_id = f._source_record_id AND g._source_updated_at = f._source_updated_at AND g.payload = f.payload)""",
)
_LATEST = ["_source_updated_at", "run_id", "page_number", "position"]
_add(
    "latest_version_per_record",
    lambda s, d: ingest.latest_versions(_classified(s, d).where("reject_reason IS NULL").select("_source_record_id", *_LATEST), "_source_record_id", _LATEST),
    f"{_GOOD} SELECT _source_record_id, {', '.join(_LATEST)} FROM (SELECT *, row_number() OVER (PARTITION BY _source_record_id ORDER BY {', '.join(f'{c} DESC' for c in _LATEST)}) AS turn FROM good) x WHERE turn = 1",
)
_add(
    "upsert_latest",
    lambda s, d: ingest.upsert_latest((p := _records(s, d).groupBy("run_id", "user_id").agg(F.max("event_id").alias("seen"), F.count(F.lit(1)).alias("n"))).where("run_id = 'run1'").drop("run_id"), p.where("run_id = 'run2'").drop("run_id"), ["user_id"], "seen"),
    f"WITH p AS (SELECT run_id, user_id, max(event_id) AS seen, count(*) AS n FROM ({_RECORDS}) r GROUP BY 1, 2) SELECT user_id, seen, n FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY seen DESC, run_id DESC) AS turn FROM p) x WHERE turn = 1",
)
_add("loaded_row_count", lambda s, d: _raw(s, d, "medical_claim").groupBy("_snapshot_id").agg(F.count(F.lit(1)).alias("n")), f"SELECT _snapshot_id, count(*) AS n FROM ({plain_sql(feed.RAW['medical_claim'])}) r GROUP BY 1")


def _page_counts(s: SparkSession, d: str) -> DataFrame:
    rows = _classified(s, d).select("run_id", "page_number", "position", "reject_reason", *ingest.KEY)
    counts = ingest.page_counts(rows, ["run_id", "page_number"], ingest.KEY, ["run_id", "page_number", "position"])
    # every tenth page lost a record on the way
    return counts.withColumn("source_records", F.col("source_records") + F.when(F.col("page_number") % 10 == 3, 1).otherwise(0))


_add(
    "load_reconciliation",
    lambda s, d: ingest.reconciled(_page_counts(s, d)).select("run_id", "page_number", "source_records", "accepted", "rejected", "inserted", "duplicates"),
    f"""WITH {_CLASSED}, turns AS (SELECT run_id, page_number, row_number() OVER (PARTITION BY _source_record_id, _source_updated_at, payload ORDER BY run_id, page_number, position) AS turn FROM classed WHERE reject_reason IS NULL),
    ins AS (SELECT run_id, page_number, count(*) AS inserted FROM turns WHERE turn = 1 GROUP BY 1, 2),
    c AS (SELECT run_id, page_number, count(*) + CASE WHEN page_number % 10 = 3 THEN 1 ELSE 0 END AS source_records, count(*) FILTER (WHERE reject_reason IS NULL) AS accepted, count(*) FILTER (WHERE reject_reason IS NOT NULL) AS rejected FROM classed GROUP BY run_id, page_number)
    SELECT c.run_id, c.page_number, source_records, accepted, rejected, coalesce(inserted, 0) AS inserted, accepted - coalesce(inserted, 0) AS duplicates FROM c LEFT JOIN ins USING (run_id, page_number) WHERE accepted + rejected <> source_records""",
)


def _run_problems(s: SparkSession, d: str) -> DataFrame:
    pages = _page_counts(s, d)
    # the manifest counts what was sent, and the second run kept no record of one refusal
    totals = _records(s, d).groupBy("run_id").agg(F.count(F.lit(1)).alias("total_records"))
    kept = pages.select("run_id", (F.col("rejected") - F.when((F.col("run_id") == "run2") & (F.col("page_number") == 0), 1).otherwise(0)).alias("n"))
    return ingest.run_reconciled(pages, totals, kept)


_add(
    "run_reconciliation",
    _run_problems,
    f"""WITH r AS (SELECT run_id, count(*) AS total_records, count(DISTINCT CASE WHEN page_number % 10 = 3 THEN page_number END) AS lost FROM ({_RECORDS}) r GROUP BY 1)
    SELECT run_id, 'processed' AS rule, total_records + lost AS records, total_records FROM r WHERE lost > 0
    UNION ALL SELECT run_id, 'loaded_and_quarantined', total_records - 1, total_records FROM r WHERE run_id = 'run2'""",
)
_add(
    "missing_parents",
    lambda s, d: ingest.missing_parents(
        spark_frame(s, d, "SELECT CASE WHEN l_partkey % 50 = 0 THEN NULL ELSE l_orderkey END AS l_orderkey, l_linenumber, l_partkey FROM {lineitem}"), spark_frame(s, d, "SELECT o_orderkey FROM {orders} WHERE o_orderkey % 9 <> 4"), "l_orderkey", "o_orderkey"
    ),
    "SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem WHERE l_partkey % 50 <> 0 AND l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderkey % 9 <> 4)",
)
_SEEN = "SELECT event_type AS path, CASE WHEN event_id % 3 = 0 THEN 'string' ELSE 'number' END AS type, 'f' || CAST(event_id % 7 AS STRING) AS fingerprint, event_id AS observed, event_id % 10 AS half FROM {events} WHERE event_id % 5 <> 2 OR event_type = 'click'"


def _counters(s: SparkSession, d: str) -> DataFrame:
    seen = spark_frame(s, d, _SEEN)
    keys, empty = ["path", "type"], "path string, type string, fingerprint string, first_observed long, last_observed long, occurrence_count long"
    first = ingest.count_observations(s.createDataFrame([], empty), seen.where("half < 6 AND NOT (type = 'string' AND path = 'view')").drop("half"), keys)
    return ingest.count_observations(first, seen.where("half >= 6").drop("half"), keys)


_add(
    "observation_counters",
    _counters,
    f"""WITH s AS ({plain_sql(_SEEN)}), a AS (SELECT path, type, min(observed) AS lo, max(observed) AS hi, arg_max(fingerprint, observed) AS f FROM s WHERE half < 6 AND NOT (type = 'string' AND path = 'view') GROUP BY 1, 2),
    b AS (SELECT path, type, max(observed) AS hi, arg_max(fingerprint, observed) AS f FROM s WHERE half >= 6 GROUP BY 1, 2)
    SELECT path, type, coalesce(b.f, a.f) AS fingerprint, coalesce(a.hi, b.hi) AS first_observed, coalesce(b.hi, a.hi) AS last_observed, (a.hi IS NOT NULL)::BIGINT + (b.hi IS NOT NULL)::BIGINT AS occurrence_count FROM a FULL JOIN b USING (path, type)""",
)
_add(
    "page_positions",
    lambda s, d: ingest.positions(_records(s, d).drop("position"), ["run_id", "page_number"], "event_id").select("run_id", "page_number", "event_id", "position"),
    f"SELECT run_id, page_number, event_id, row_number() OVER (PARTITION BY run_id, page_number ORDER BY event_id)::INTEGER AS position FROM ({_RECORDS}) r",
)
_SNAPSHOT = "SELECT c_custkey, CASE WHEN c_custkey % 6 = 0 THEN NULL ELSE c_name END AS c_name, CASE WHEN c_custkey % 8 = 0 THEN '' ELSE c_mktsegment END AS segment, CAST(FLOOR(c_custkey / 1000) AS INT) AS part_no, 'all' AS whole FROM {customer}"


def _legacy(s: SparkSession, d: str) -> DataFrame:
    numbered = ingest.row_numbers(spark_frame(s, d, _SNAPSHOT), ["whole", "part_no"], "c_custkey", F.lit(True))
    return staging.legacy_raw(numbered.select("c_custkey", "c_name", "segment", F.col("_source_row_number").alias("row_number")), "s1", F.col("row_number"), "2025-01-01 00:00:00").withColumn("_loaded_at", F.col("_loaded_at").cast("timestamp_ntz"))


_add(
    "legacy_raw_rows",
    _legacy,
    f"""SELECT 's1' AS _snapshot_id, row_number() OVER (ORDER BY c_custkey) AS _source_row_number, TIMESTAMP '2025-01-01' AS _loaded_at,
    '{{"c_custkey":"' || c_custkey || '","c_name":' || coalesce('"' || c_name || '"', 'null') || ',"segment":"' || segment || '"}}' AS raw_row FROM ({plain_sql(_SNAPSHOT)}) x""",
)
_add(
    "both_loaders_rows",
    lambda s, d: staging.both_loaders((r := _raw(s, d, "eligibility")).where("raw_row IS NOT NULL").drop("_raw_payload"), r.where("_raw_payload IS NOT NULL").drop("raw_row", "_snapshot_id")).select("_snapshot_id", "_source_row_number", "raw_row", "_raw_payload"),
    f"SELECT CASE WHEN raw_row IS NOT NULL THEN _snapshot_id END AS _snapshot_id, _source_row_number, raw_row, _raw_payload FROM ({plain_sql(feed.RAW['eligibility'])}) r",
)
_LOADED = "SELECT o_orderkey, CAST(CAST(o_orderdate AS DATE) AS TIMESTAMP) AS _loaded_at FROM {orders} WHERE CAST(o_orderdate AS DATE) < DATE '1995-06-01'"


def _fresh(s: SparkSession, d: str) -> DataFrame:
    rows = spark_frame(s, d, _LOADED)
    parts = [ingest.source_freshness(rows.where(F.col("o_orderkey") % 1000 < n), now).withColumn("now", F.lit(now)) for n, now in ((1000, "1995-06-01 12:00:00"), (1000, "1995-06-02 12:00:00"), (1000, "1995-06-09 00:00:00"), (0, "1995-06-01 12:00:00"))]
    return parts[0].union(parts[1]).union(parts[2]).union(parts[3]).withColumn("newest", F.col("newest").cast("timestamp_ntz"))


_add(
    "source_freshness",
    _fresh,
    f"""WITH n AS (SELECT max(_loaded_at) AS newest FROM ({plain_sql(_LOADED)}) r), c AS (SELECT * FROM (VALUES ('1995-06-01 12:00:00', true), ('1995-06-02 12:00:00', true), ('1995-06-09 00:00:00', true), ('1995-06-01 12:00:00', false)) v(now, seen)),
    a AS (SELECT CASE WHEN seen THEN newest END AS newest, now, CASE WHEN seen THEN epoch(now::TIMESTAMP - newest)::BIGINT END AS age_seconds FROM c, n)
    SELECT newest, age_seconds, CASE WHEN age_seconds IS NULL OR age_seconds > 259200 THEN 'error' WHEN age_seconds > 86400 THEN 'warn' ELSE 'pass' END AS status, now FROM a""",
)
_PAGES = "SELECT run_id, page_number, count(*) AS record_count, sum(length(payload)) AS bytes, max(day) AS mark, CAST(max(event_id) % 9 AS STRING) AS token FROM ({records}) r GROUP BY run_id, page_number"


def _pages(s: SparkSession, d: str) -> DataFrame:
    return spark_frame(s, d, _PAGES.replace("({records}) r", "{records}"), records=_records(s, d))


_PAGE_SQL = _PAGES.replace("{records}", _RECORDS)
_add("manifest_totals", lambda s, d: _pages(s, d).groupBy("run_id").agg(F.count(F.lit(1)).alias("page_count"), F.sum("record_count").alias("records"), F.sum("bytes").alias("bytes")), f"SELECT run_id, count(*) AS page_count, sum(record_count)::BIGINT AS records, sum(bytes)::BIGINT AS bytes FROM ({_PAGE_SQL}) p GROUP BY 1")
_add("candidate_watermark", lambda s, d: ingest.last_watermark(_pages(s, d), "run_id", "page_number", "mark"), f"SELECT run_id, arg_max(mark, page_number) AS candidate FROM ({_PAGE_SQL}) p GROUP BY 1")


def _guarded(s: SparkSession, d: str) -> DataFrame:
    pages = _pages(s, d)
    committed = pages.where("run_id = 'run1' OR page_number < 20").groupBy("run_id").agg(F.max(F.when(F.col("page_number") % 2 == 0, F.col("mark"))).alias("committed"))
    candidates = pages.withColumn("batch", F.col("page_number") % 4).groupBy("run_id", "batch").agg(F.max_by("mark", "page_number").alias("candidate"))
    return ingest.guarded(committed, candidates, ["run_id"]).select("run_id", "committed", "candidate", "refused", "watermark")


_add(
    "watermark_guard",
    _guarded,
    f"""WITH p AS ({_PAGE_SQL}), m AS (SELECT run_id, max(CASE WHEN page_number % 2 = 0 THEN mark END) AS committed FROM p WHERE run_id = 'run1' OR page_number < 20 GROUP BY run_id),
    c AS (SELECT run_id, page_number % 4 AS batch, arg_max(mark, page_number) AS candidate FROM p GROUP BY 1, 2)
    SELECT run_id, committed, candidate, coalesce(candidate < committed, false) AS refused, CASE WHEN candidate < committed THEN committed ELSE candidate END AS watermark FROM c LEFT JOIN m USING (run_id)""",
)
_add("pagination_cycle", lambda s, d: ingest.page_cycles(_pages(s, d), "run_id", "token"), f"SELECT run_id, token, count(*) AS times FROM ({_PAGE_SQL}) p WHERE token IS NOT NULL GROUP BY 1, 2 HAVING count(*) > 1")
_add("incremental_since", lambda s, d: ingest.since(_records(s, d), "day", "2024-01-15").select("run_id", "event_id", "day"), f"SELECT run_id, event_id, day FROM ({_RECORDS}) r WHERE day > '2024-01-15'")
_add(
    "source_row_number",
    lambda s, d: ingest.row_numbers(_records(s, d), ["run_id", "page_number"], "position", X.json_kind(X.json_probe(F.col("payload"))) == "object").select("run_id", "page_number", "position", "_source_row_number"),
    f"SELECT run_id, page_number, position, CASE WHEN ok THEN sum(ok::INT) OVER (PARTITION BY run_id ORDER BY page_number, position)::BIGINT END AS _source_row_number FROM (SELECT *, {_kind('payload')} = 'object' AS ok FROM ({_RECORDS}) r) x",
)
_ENVELOPES = """SELECT o_orderkey, CASE WHEN o_orderkey % 13 = 0 THEN 'other' ELSE 't' || CAST(o_orderkey AS STRING) END AS requested,
 CASE o_orderkey % 9 WHEN 0 THEN '{{"records":{{}},"metadata":{{"record_count":1}}}}'
 ELSE '{{"records":[' || CASE WHEN o_orderkey % 9 = 1 THEN '3' ELSE '{{"a":1}}' END || '],"metadata":{{"record_count":' || CASE o_orderkey % 9 WHEN 2 THEN 'true' WHEN 3 THEN '2' WHEN 4 THEN '-1' ELSE '1' END
  || ',"page_token":"t' || CAST(o_orderkey AS STRING) || '","next_page_token":' || CASE o_orderkey % 9 WHEN 5 THEN '""' WHEN 6 THEN '7' ELSE 'null' END || ',"high_water_mark":' || CASE o_orderkey % 9 WHEN 7 THEN 'null' ELSE '"h"' END || '}}}}' END AS body FROM {orders}"""
_add(
    "envelope_validation",
    lambda s, d: spark_frame(s, d, _ENVELOPES).select("o_orderkey", ingest.envelope_problem(F.col("body"), F.col("requested")).alias("problem")),
    """SELECT o_orderkey, CASE WHEN o_orderkey % 9 = 0 THEN 'records_not_an_array' WHEN o_orderkey % 9 = 1 THEN 'record_not_an_object' WHEN o_orderkey % 9 IN (2, 4) THEN 'bad_record_count'
    WHEN o_orderkey % 9 = 3 THEN 'record_count_differs' WHEN o_orderkey % 13 = 0 THEN 'page_token_differs' WHEN o_orderkey % 9 IN (5, 6) THEN 'bad_next_page_token' WHEN o_orderkey % 9 = 7 THEN 'bad_high_water_mark' END AS problem FROM orders""",
)


def _reloaded(s: SparkSession, d: str) -> DataFrame:
    """Two snapshots of all three tables, one after the other, and what a reader then sees."""
    store, names = Store(s, f"{shared_root(s)}/reload-{uuid.uuid4().hex}"), ("eligibility", "medical_claim", "pharmacy_claim")
    for snapshot in ("s2", "s3"):
        files.reload({t: _raw(s, d, t).where(F.col("_snapshot_id") == snapshot) for t in names}, store)
    seen = [files.loaded(s, store, t).select(F.lit(t).alias("table_name"), "_snapshot_id", "_source_row_number") for t in names]
    return seen[0].union(seen[1]).union(seen[2])


_add("snapshot_reload", _reloaded, " UNION ALL ".join(f"SELECT '{t}' AS table_name, _snapshot_id, _source_row_number FROM ({plain_sql(feed.RAW[t])}) r WHERE _snapshot_id = 's3'" for t in ("eligibility", "medical_claim", "pharmacy_claim")))


def _verified(s: SparkSession, d: str) -> DataFrame:
    pages = _records(s, d).groupBy("run_id", "page_number").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("position", "payload"))), lambda r: r["payload"]), "\n").alias("content"), F.count(F.lit(1)).alias("records"))
    there = pages.where("page_number % 11 <> 5").select("run_id", "page_number", F.sha2(F.concat("content", F.when(F.col("page_number") % 7 == 2, "x").otherwise("")), 256).alias("sha256"), "records")
    listed = pages.select("run_id", "page_number", F.sha2("content", 256).alias("sha256"), (F.col("records") + F.when(F.col("page_number") % 10 == 4, 1).otherwise(0)).alias("records"))
    return mismatches(listed, there, ["run_id", "page_number"])


_add(
    "manifest_verification",
    _verified,
    f"""WITH p AS (SELECT run_id, page_number FROM ({_RECORDS}) r GROUP BY 1, 2)
    SELECT run_id, page_number, CASE WHEN page_number % 11 = 5 THEN 'missing' WHEN page_number % 7 = 2 THEN 'checksum' ELSE 'record_count' END AS problem FROM p WHERE page_number % 11 = 5 OR page_number % 7 = 2 OR page_number % 10 = 4""",
)

# Runs and drift.

_add("consecutive_failures", lambda s, d: ingest.consecutive_failures(_runs(s, d), "endpoint"), f"WITH r AS ({_RUNS}), g AS (SELECT endpoint, max(started_at) AS good FROM r WHERE status = 'succeeded' GROUP BY 1) SELECT r.endpoint, count(*) FILTER (WHERE status = 'failed' AND (good IS NULL OR started_at > good)) AS failures FROM r LEFT JOIN g USING (endpoint) GROUP BY 1")
_add("table_load_counts", lambda s, d: _runs(s, d).where("status IN ('succeeded', 'committed')").groupBy("endpoint").agg(F.sum("number").alias("n_rows"), F.count(F.lit(1)).alias("loads")), f"SELECT endpoint, sum(number)::BIGINT AS n_rows, count(*) AS loads FROM ({_RUNS}) r WHERE status IN ('succeeded', 'committed') GROUP BY 1")
_add("latest_successful_run", lambda s, d: ingest.latest_run(_runs(s, d)).select("run_id", "endpoint", "number"), f"SELECT run_id, endpoint, number FROM ({_RUNS}) r WHERE status = 'succeeded' ORDER BY started_at DESC, run_id LIMIT 1")
_add("freshness_check", lambda s, d: ingest.freshness(ingest.all_runs((r := _runs(s, d)).where("number % 3 > 0"), r.where("number % 3 = 0")), "2025-01-03 12:00:00", 30, ["succeeded", "committed"]).select("age_hours", "fresh"), f"SELECT floor(epoch(TIMESTAMP '2025-01-03 12:00:00' - max(started_at)) / 3600)::BIGINT AS age_hours, coalesce(epoch(TIMESTAMP '2025-01-03 12:00:00' - max(started_at)) / 3600 <= 30, false) AS fresh FROM ({_RUNS}) r WHERE status IN ('succeeded', 'committed')")
_add(
    "run_state_transitions",
    lambda s, d: ingest.transitions(_runs(s, d).select("run_id", F.lit("running").alias("before"), F.col("status").alias("after")), "files"),
    f"SELECT run_id, 'running' AS before, status AS after, status IN ('succeeded', 'failed', 'skipped') AS allowed FROM ({_RUNS}) r",
)
_OBJECT_RUNS = "SELECT c_custkey, CASE c_custkey % 4 WHEN 0 THEN 'running' WHEN 1 THEN 'published' WHEN 2 THEN 'loading' ELSE 'committed' END AS before, CASE c_custkey % 5 WHEN 0 THEN 'published' WHEN 1 THEN 'loading' WHEN 2 THEN 'committed' WHEN 3 THEN 'failed' ELSE 'running' END AS after FROM {customer}"
_add(
    "object_run_transitions",
    lambda s, d: ingest.transitions(spark_frame(s, d, _OBJECT_RUNS), "objects"),
    f"SELECT c_custkey, before, after, (before, after) IN (('running', 'published'), ('running', 'failed'), ('published', 'loading'), ('published', 'failed'), ('loading', 'committed'), ('loading', 'failed')) AS allowed FROM ({plain_sql(_OBJECT_RUNS)}) x",
)
_NESTED = """SELECT CAST(FLOOR(o_orderkey / 500) AS INT) AS page, '{{"id":' || CAST(o_orderkey AS STRING) || ',"who":{{"name":' || CASE WHEN o_orderkey % 5 = 0 THEN 'null' ELSE '"x"' END || ',"tags":[' || CASE o_orderkey % 3 WHEN 0 THEN '' WHEN 1 THEN '1,"a"' ELSE '{{"k":true}},[2]' END
 || ']}}' || CASE WHEN o_orderkey % 4 = 0 THEN ',"more":[]' ELSE '' END || '}}' AS payload FROM {orders}"""
_NESTED_KINDS = """SELECT DISTINCT floor(o_orderkey / 500)::INT AS page, unnest(['id', 'who', 'who.name', 'who.tags'] || CASE o_orderkey % 3 WHEN 1 THEN ['who.tags[]', 'who.tags[]'] WHEN 2 THEN ['who.tags[]', 'who.tags[].k', 'who.tags[]', 'who.tags[][]'] ELSE [] END || CASE WHEN o_orderkey % 4 = 0 THEN ['more'] ELSE [] END) AS path,
 unnest(['number', 'object', CASE WHEN o_orderkey % 5 = 0 THEN 'null' ELSE 'string' END, 'array'] || CASE o_orderkey % 3 WHEN 1 THEN ['number', 'string'] WHEN 2 THEN ['object', 'boolean', 'array', 'number'] ELSE [] END || CASE WHEN o_orderkey % 4 = 0 THEN ['array'] ELSE [] END) AS type FROM orders"""


def _nested(s: SparkSession, d: str) -> DataFrame:
    return drift.observed(spark_frame(s, d, _NESTED), ["page"])


_add("nested_schema_observation", lambda s, d: drift.counted(_nested(s, d), ["page"]), f"SELECT path, type, count(*) AS occurrence_count, min(page) AS first_page, max(page) AS last_page FROM ({_NESTED_KINDS}) k GROUP BY 1, 2")


def _observed(s: SparkSession, d: str) -> DataFrame:
    return drift.observed(s.read.parquet(f"{d.rstrip('/')}/events.parquet").select((F.floor(F.col("event_id") / 100)).cast("int").alias("page"), F.col("props").alias("payload")), ["page"])


_KINDS = f"SELECT DISTINCT floor(event_id / 100)::INT AS page, key AS path, {_KIND.format('value')} AS type FROM (SELECT event_id, unnest(json_keys(props)) AS key, json_extract(props, '$.' || unnest(json_keys(props))) AS value FROM events) x"
_add("schema_observation", lambda s, d: drift.counted(_observed(s, d), ["page"]), f"SELECT path, type, count(*) AS occurrence_count, min(page) AS first_page, max(page) AS last_page FROM ({_KINDS}) k GROUP BY 1, 2")
_add("schema_fingerprint", lambda s, d: drift.fingerprint(_observed(s, d)), f"""WITH k AS (SELECT path, list_sort(list(DISTINCT type)) AS types FROM ({_KINDS}) k GROUP BY 1) SELECT sha256('[' || string_agg('["' || path || '",["' || array_to_string(types, '","') || '"]]', ',' ORDER BY path) || ']') AS fingerprint, count(*) AS paths FROM k""")
_add("nested_schema_fingerprint", lambda s, d: drift.fingerprint(_nested(s, d)), f"""WITH k AS (SELECT path, list_sort(list(DISTINCT type)) AS types FROM ({_NESTED_KINDS}) k GROUP BY 1) SELECT sha256('[' || string_agg('["' || path || '",["' || array_to_string(types, '","') || '"]]', ',' ORDER BY path) || ']') AS fingerprint, count(*) AS paths FROM k""")


def queries() -> dict[str, Query]:
    return dict(_queries)


def oracle_sql() -> dict[str, str]:
    return dict(_oracles)
