"""Claims feeds derived from a star schema of orders, as SQL that Spark and other engines read alike.

The tables hold no claims, so each feed is a projection of them: a claim line is an order line with its order, a
coverage span starts at an order, a page of records is a run of events. Field values are texts, and some are made bad on
purpose by remainders of keys: blank, padded, with a letter, an impossible date, an exponent. ``{name}`` stands for a
table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def _day(expr: str) -> str:
    return f"CAST(CAST({expr} AS DATE) AS STRING)"


def _money(expr: str) -> str:
    return f"CAST(CAST({expr} AS DECIMAL(18,2)) AS STRING)"


def _json(fields: dict[str, str]) -> str:
    """An object of text fields; a NULL value is a JSON null."""
    parts = [f"""'"{k}":' || coalesce('"' || {v} || '"', 'null')""" for k, v in fields.items()]
    return "'{{' || " + " || ',' || ".join(parts) + " || '}}'"


_BAD_DATE = "CASE WHEN l_suppkey % 17 = 3 THEN '2025-02-30' WHEN l_suppkey % 19 = 4 THEN '2025-1-1' WHEN l_suppkey % 23 = 5 THEN '' ELSE {} END"
_BAD_MONEY = "CASE WHEN l_partkey % 31 = 7 THEN '1e5' WHEN l_partkey % 37 = 8 THEN '  ' WHEN l_partkey % 41 = 9 THEN ' ' || {0} || ' ' ELSE {0} END"

MEDICAL_FIELDS = {
    "claim_id": "CAST(l_orderkey AS STRING)",
    "claim_line_number": "CASE WHEN l_partkey % 97 = 1 THEN 'X' WHEN l_partkey % 89 = 2 THEN ' ' || CAST(l_linenumber AS STRING) ELSE CAST(l_linenumber AS STRING) END",
    "claim_type": "CASE l_partkey % 4 WHEN 0 THEN 'institutional' WHEN 1 THEN 'professional' WHEN 2 THEN 'undetermined' ELSE CASE WHEN l_partkey % 11 = 0 THEN 'dental' ELSE 'professional' END END",
    "person_id": "'p' || CAST(o_custkey AS STRING)",
    "member_id": "CASE WHEN o_custkey % 29 = 0 THEN NULL ELSE 'm' || CAST(o_custkey AS STRING) END",
    "payer": "' ' || o_orderpriority || ' '",
    "plan": "l_returnflag",
    "claim_start_date": _BAD_DATE.format(_day("o_orderdate")),
    "claim_end_date": _day("l_shipdate"),
    "claim_line_start_date": _day("o_orderdate"),
    "claim_line_end_date": _day("l_shipdate"),
    "admission_date": f"CASE WHEN l_linestatus = 'O' THEN {_day('o_orderdate')} END",
    "discharge_date": f"CASE WHEN l_linestatus = 'O' THEN {_day('l_shipdate')} END",
    "paid_date": _day("l_shipdate"),
    "admit_source_code": "CAST(l_suppkey % 9 AS STRING)",
    "place_of_service_code": "CASE WHEN l_partkey % 3 = 0 THEN '' ELSE lpad(CAST(l_suppkey % 99 AS STRING), 2, '0') END",
    "bill_type_code": "CASE WHEN l_partkey % 3 = 0 THEN lpad(CAST(l_suppkey % 999 AS STRING), 4, '0') END",
    "revenue_center_code": "lpad(CAST(l_partkey % 1000 AS STRING), 4, '0')",
    "drg_code": "lpad(CAST(l_partkey % 999 AS STRING), 3, '0')",
    "service_unit_quantity": "CAST(CAST(l_quantity AS DECIMAL(18,2)) AS STRING)",
    "hcpcs_code": "'H' || lpad(CAST(l_partkey % 9999 AS STRING), 4, '0')",
    "hcpcs_modifier_1": "l_linestatus",
    "rendering_id": "CAST(1000000000 + l_suppkey AS STRING)",
    "billing_id": "CAST(1100000000 + l_suppkey AS STRING)",
    "paid_amount": _BAD_MONEY.format(_money("l_extendedprice")),
    "allowed_amount": _money("l_extendedprice"),
    "charge_amount": _money("o_totalprice"),
    "deductible_amount": "CASE WHEN l_partkey % 5 = 0 THEN '.5' WHEN l_partkey % 7 = 0 THEN '-12.345' END",
    "data_source": "CASE WHEN l_suppkey % 10 = 0 THEN NULL ELSE 'feed' || CAST(l_suppkey % 3 AS STRING) END",
    "updated_at": "CASE WHEN l_partkey % 61 = 3 THEN 'soon' WHEN l_partkey % 67 = 4 THEN '' ELSE " + _day("l_shipdate") + " || 'T06:30:00Z' END",
}

PHARMACY_FIELDS = {
    "claim_id": "'rx' || CAST(l_orderkey AS STRING)",
    "claim_line_number": "CAST(l_linenumber AS STRING)",
    "person_id": "'p' || CAST(l_suppkey AS STRING)",
    "member_id": "'m' || CAST(l_suppkey AS STRING)",
    "payer": "p_brand",
    "plan": "l_returnflag",
    "prescribing_provider_id": "CAST(1200000000 + l_suppkey AS STRING)",
    "dispensing_provider_id": "CAST(1300000000 + l_suppkey AS STRING)",
    "dispensing_date": _BAD_DATE.format(_day("l_shipdate")),
    "ndc_code": "lpad(CAST(p_partkey AS STRING), 11, '0')",
    "quantity": "CASE WHEN l_partkey % 43 = 1 THEN '99999999999' WHEN l_partkey % 47 = 2 THEN '3.5' ELSE CAST(CAST(l_quantity AS INT) AS STRING) END",
    "days_supply": "CAST(30 + p_size AS STRING)",
    "refills": "'00' || CAST(p_size % 5 AS STRING)",
    "paid_date": _day("l_shipdate"),
    "paid_amount": _BAD_MONEY.format(_money("l_extendedprice")),
    "allowed_amount": _money("p_retailprice"),
    "charge_amount": "CASE WHEN l_partkey % 53 = 0 THEN '1.0049999999999' ELSE " + _money("l_extendedprice") + " END",
    "data_source": "'rx'",
    "updated_at": _day("l_shipdate"),
}

ELIGIBILITY_FIELDS = {
    "person_id": "CASE WHEN o_orderkey % 71 = 0 THEN '   ' WHEN o_orderkey % 73 = 0 THEN NULL ELSE 'p' || CAST(c_custkey AS STRING) END",
    "member_id": "'m' || CAST(c_custkey AS STRING)",
    "subscriber_id": "'s' || CAST(c_custkey % 100 AS STRING)",
    "birth_date": "CASE WHEN c_custkey % 13 = 0 THEN '1980-13-01' ELSE '19' || lpad(CAST(40 + c_custkey % 60 AS STRING), 2, '0') || '-05-17' END",
    "death_date": f"CASE WHEN c_custkey % 50 = 0 THEN {_day('o_orderdate')} END",
    "enrollment_start_date": f"CASE WHEN o_orderkey % 79 = 0 THEN 'n/a' ELSE {_day('o_orderdate')} END",
    "enrollment_end_date": f"CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE {_day('CAST(o_orderdate AS DATE) + CAST(o_orderkey % 90 AS INT)')} END",
    "payer": "c_mktsegment",
    "payer_type": "CASE c_nationkey % 4 WHEN 0 THEN 'commercial' WHEN 1 THEN 'medicare' WHEN 2 THEN 'medicaid' ELSE 'other' END",
    "plan": "o_orderstatus",
    "dual_status_code": "lpad(CAST(c_custkey % 10 AS STRING), 2, '0')",
    "medicare_status_code": "CASE WHEN c_custkey % 6 = 0 THEN '' ELSE '10' END",
    "group_id": "CAST(c_nationkey AS STRING)",
    "fips_state_code": "lpad(CAST(c_nationkey AS STRING), 2, '0')",
    "data_source": "CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE 'feed1' END",
    "updated_at": _day("o_orderdate"),
}

_MEDICAL_FROM = "FROM {lineitem} l JOIN {orders} o ON l.l_orderkey = o.o_orderkey"
_PHARMACY_FROM = "FROM {lineitem} l JOIN {part} p ON l.l_partkey = p.p_partkey"
_ELIGIBILITY_FROM = "FROM {orders} o JOIN {customer} c ON o.o_custkey = c.c_custkey"


def _raw(fields: dict[str, str], snapshot: str, number: str, legacy: str, source: str) -> str:
    """Raw rows of both loaders: legacy rows have ``raw_row``, others ``_raw_payload``."""
    return (
        f"SELECT {snapshot} AS _snapshot_id, CAST({number} AS BIGINT) AS _source_row_number, "
        f"CASE WHEN {legacy} THEN payload END AS raw_row, CASE WHEN NOT ({legacy}) THEN payload END AS _raw_payload "
        f"FROM (SELECT *, {_json(fields)} AS payload {source}) x"
    )


RAW = {
    "medical_claim": _raw(MEDICAL_FIELDS, "'s' || CAST(l_orderkey % 5 AS STRING)", "l_orderkey * 10 + l_linenumber", "l_orderkey % 3 = 0", _MEDICAL_FROM),
    "pharmacy_claim": _raw(PHARMACY_FIELDS, "'s' || CAST(l_orderkey % 5 AS STRING)", "l_orderkey * 10 + l_linenumber", "l_orderkey % 3 = 0", _PHARMACY_FROM),
    "eligibility": _raw(ELIGIBILITY_FIELDS, "'s' || CAST(o_orderkey % 5 AS STRING)", "o_orderkey", "o_orderkey % 3 = 0", _ELIGIBILITY_FROM),
}

#: Claim lines in the vendor's form: cents, status and origin of adjustments, repeated code columns.
VENDOR_CLAIMS = """
SELECT
  CASE WHEN l_partkey % 101 = 0 THEN '  ' WHEN l_partkey % 5 = 4 AND l_orderkey % 7 = 0 THEN 'c' || CAST(l_orderkey AS STRING) || '-a' ELSE 'c' || CAST(l_orderkey AS STRING) END AS clm_id,
  CASE WHEN l_partkey % 103 = 0 THEN 'L' || CAST(l_linenumber AS STRING) ELSE CAST(l_linenumber AS STRING) END AS line_no,
  CASE WHEN l_partkey % 107 = 0 THEN NULL ELSE ' mk' || CAST(o_custkey AS STRING) END AS member_key,
  CASE WHEN l_partkey % 5 = 4 AND l_orderkey % 7 = 0 THEN '7' WHEN l_orderkey % 11 = 0 AND l_linenumber = 2 THEN '8' ELSE '1' END AS clm_status_code,
  CASE WHEN l_partkey % 5 = 4 AND l_orderkey % 7 = 0 THEN 'c' || CAST(l_orderkey AS STRING) WHEN l_orderkey % 11 = 0 AND l_linenumber = 2 THEN 'c' || CAST(l_orderkey + l_partkey % 2 AS STRING) END AS orig_clm_id,
  CASE WHEN l_suppkey % 3 = 0 THEN lpad(CAST(l_suppkey % 999 AS STRING), 3, '0') WHEN l_suppkey % 3 = 1 THEN ' ' END AS bill_type_code,
  CASE WHEN l_suppkey % 4 = 0 THEN '11' END AS place_of_service_code,
  CASE l_suppkey % 7 WHEN 0 THEN 'UB04' WHEN 1 THEN ' CMS1500' WHEN 2 THEN 'ub04' END AS claim_form_code,
  CAST(CAST(o_orderdate AS DATE) AS STRING) AS service_from_dt,
  CASE WHEN l_partkey % 2 = 0 THEN 'ICD10' END AS diag_type,
  'D' || CAST(l_partkey % 6 AS STRING) AS diag_cd_1,
  CASE WHEN l_partkey % 5 = 0 THEN '' ELSE ' D' || CAST(l_suppkey % 6 AS STRING) END AS diag_cd_2,
  'D' || CAST(l_partkey % 4 AS STRING) AS diag_cd_3,
  CASE WHEN l_partkey % 3 = 0 THEN 'CPT' END AS proc_type,
  CASE WHEN l_suppkey % 5 = 0 THEN NULL ELSE 'P' || CAST(l_suppkey % 4 AS STRING) END AS proc_cd_1,
  CAST(CAST(l_shipdate AS DATE) AS STRING) AS proc_dt_1,
  'P' || CAST(l_partkey % 4 AS STRING) AS proc_cd_2,
  CASE WHEN l_partkey % 8 = 0 THEN '2025-02-30' ELSE CAST(CAST(o_orderdate AS DATE) AS STRING) END AS proc_dt_2,
  CASE WHEN l_partkey % 109 = 0 THEN 'n/a' WHEN l_orderkey % 11 = 0 AND l_linenumber = 2 THEN '-' || CAST(CAST(CAST(l_extendedprice AS DECIMAL(18,2)) * 100 AS BIGINT) AS STRING) ELSE CAST(CAST(CAST(l_extendedprice AS DECIMAL(18,2)) * 100 AS BIGINT) AS STRING) END AS paid_cents,
  CASE WHEN l_partkey % 113 = 0 THEN '100' ELSE CAST(CAST(CAST(l_extendedprice AS DECIMAL(18,2)) * 100 AS BIGINT) + 500 AS STRING) END AS allowed_cents,
  CASE WHEN l_partkey % 127 = 0 THEN '' ELSE CAST(CAST(CAST(l_extendedprice AS DECIMAL(18,2)) * 100 AS BIGINT) + 1000 AS STRING) END AS charge_cents
FROM {lineitem} l JOIN {orders} o ON l.l_orderkey = o.o_orderkey
"""

#: Coverage spans in the vendor's form: overlapping, adjacent, open and invalid ones.
VENDOR_SPANS = """
SELECT
  'mk' || CAST(o_custkey AS STRING) AS member_key,
  CASE WHEN o_custkey % 4 = 0 THEN ' ' ELSE 'payer' || CAST(o_custkey % 2 AS STRING) END AS payer,
  'plan' AS plan,
  CASE WHEN o_orderkey % 2 = 0 THEN 'med' ELSE 'rx' END AS coverage_type,
  CASE WHEN o_orderkey % 83 = 0 THEN '2025-02-30' ELSE CAST(CAST(o_orderdate AS DATE) AS STRING) END AS span_start_dt,
  CASE WHEN o_orderkey % 9 = 0 THEN '' WHEN o_orderkey % 89 = 0 THEN 'later' WHEN o_orderkey % 97 = 0 THEN '1990-01-01'
       ELSE CAST(CAST(o_orderdate AS DATE) + CAST(o_orderkey % 200 AS INT) AS STRING) END AS span_end_dt
FROM {orders} o
"""

#: Members by key; some keys are absent, and several keys name one person. ``load_order`` breaks repeats: the last wins.
CROSSWALK = """
SELECT ' mk' || CAST(c_custkey AS STRING) AS member_key, 'person' || CAST(c_custkey - c_custkey % 2 AS STRING) AS person_id, c_custkey AS load_order
FROM {customer} c WHERE c_custkey % 12 <> 0
UNION ALL
SELECT 'mk' || CAST(c_custkey AS STRING), CASE WHEN c_custkey % 10 = 0 THEN '' ELSE 'moved' || CAST(c_custkey AS STRING) END, c_custkey + 100000000
FROM {customer} c WHERE c_custkey % 5 = 0
"""

#: Records of pages: an event each, with its page, place on the page and the page's marks; two runs pull overlapping pages.
RECORDS = """
SELECT
  'run' || CAST(r.run AS STRING) AS run_id, CAST(FLOOR(event_id / 100) AS INT) AS page_number,
  CAST(event_id % 100 + 1 AS INT) AS position, event_id,
  CASE WHEN event_id % 41 = 0 THEN '[1,2]' WHEN event_id % 43 = 0 THEN '"text"'
       ELSE '{{"person_id":' || CASE WHEN event_id % 31 = 0 THEN 'null' WHEN event_id % 37 = 0 THEN '" "' WHEN event_id % 29 = 0 THEN '17' WHEN event_id % 61 = 0 THEN CAST(CAST(12345678901234567890 AS DECIMAL(20,0)) - event_id AS STRING) WHEN event_id % 67 = 0 THEN CAST(event_id AS STRING) || '.0' WHEN event_id % 71 = 0 THEN CAST(event_id AS STRING) || '.25' ELSE '"e' || CAST(event_id - event_id % 3 AS STRING) || '"' END
       || ',"enrollment_start_date":' || CASE WHEN event_id % 23 = 0 THEN '"01/02/2025"' WHEN event_id % 19 = 0 THEN '5' ELSE '"' || CAST(CAST(ts AS DATE) AS STRING) || '"' END
       || CASE WHEN event_id % 47 = 0 THEN '' ELSE ',"updated_at":' || CASE WHEN event_id % 53 = 0 THEN '20250101' WHEN event_id % 59 = 0 THEN '"soon"' ELSE '"' || CAST(CAST(ts AS DATE) AS STRING) || 'T0' || CAST(event_id % 10 AS STRING) || ':00:00Z"' END END
       || ',"kind":"' || event_type || '"' || CASE WHEN r.run = 2 AND event_id % 7 = 0 THEN ',"rev":2' ELSE '' END || '}}' END AS payload,
  CAST(CAST(ts AS DATE) AS STRING) AS day, user_id
FROM {events} e CROSS JOIN (SELECT 1 AS run UNION ALL SELECT 2 AS run) r
WHERE r.run = 1 OR event_id % 400 < 200
"""

#: Runs of two feeds with their states, one a customer.
RUNS = """
SELECT 'run' || CAST(c_custkey AS STRING) AS run_id, CASE WHEN c_custkey % 2 = 0 THEN 'medical_claim' ELSE 'eligibility' END AS endpoint,
  CASE WHEN c_custkey % 5 = 0 THEN 'failed' WHEN c_custkey % 7 = 0 THEN 'running' WHEN c_custkey % 11 = 0 THEN 'skipped' WHEN c_custkey % 13 = 0 THEN 'committed' ELSE 'succeeded' END AS status,
  CAST('2025-01-01 00:00:00' AS TIMESTAMP) + make_interval_minutes AS started_at, c_custkey AS number
FROM (SELECT c_custkey, {minutes} AS make_interval_minutes FROM {customer}) c
"""


def spread(df: DataFrame) -> DataFrame:
    """``df`` over all cores, where its files give fewer splits than there are; large tables have many and stay as they are."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def spark_frame(spark: SparkSession, sf_dir: str, sql: str, **more: DataFrame) -> DataFrame:
    """A feed as a DataFrame over the tables of ``sf_dir``."""
    names = [n for n in ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events") if "{" + n + "}" in sql]
    tables = {n: spark.read.parquet(f"{sf_dir.rstrip('/')}/{n}.parquet") for n in names}
    tables |= {n: spread(tables[n]) for n in ("lineitem", "orders", "events") if n in tables}
    return spark.sql(sql.replace("{minutes}", "make_dt_interval(0, 0, CAST(c_custkey AS INT))"), **tables, **more)


def plain_sql(sql: str) -> str:
    """The same feed as SQL over tables of those names."""
    names = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")
    return sql.replace("{minutes}", "to_minutes(c_custkey)").format(**{n: n for n in names})
