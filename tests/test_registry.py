"""Every registered claims query against its SQL on the smallest tables."""

import datetime
import decimal

import duckdb
import pytest

from quillsieve.plans import registry

DATA = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events".split()


def plain(v):
    if isinstance(v, float):
        return f"{v:.9g}"
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, decimal.Decimal):
        return format(v, "f")
    return str(v)


@pytest.fixture(scope="module")
def con():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    return con


def test_every_query_has_sql():
    assert set(registry.queries()) == set(registry.oracle_sql()) and len(registry.queries()) >= 79


@pytest.mark.parametrize("name", sorted(registry.queries()))
def test_same_rows_as_sql(spark, con, name):
    df = registry.queries()[name](spark, DATA)
    columns = sorted(df.columns)
    got = sorted(tuple(map(plain, r)) for r in df.select(*[df[c] for c in columns]).collect())
    result = con.execute(registry.oracle_sql()[name])
    names = [d[0] for d in result.description]
    assert sorted(names) == columns
    at = [names.index(c) for c in columns]
    assert got == sorted(tuple(plain(r[i]) for i in at) for r in result.fetchall())


def test_gate_has_the_same_rows_as_sql_where_amounts_are_missing(spark, tmp_path, monkeypatch):
    """Lines paid beyond what is allowed, without a charge: parts of 113 * 127, of which the smallest tables have none."""
    con = duckdb.connect()
    for t in TABLES:
        parts = " REPLACE (CASE WHEN l_linenumber = 1 THEN 113 * 127 ELSE l_partkey END AS l_partkey)" if t == "lineitem" else ""
        con.execute(f"COPY (SELECT *{parts} FROM '{DATA}/{t}.parquet') TO '{tmp_path}/{t}.parquet'")
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{tmp_path}/{t}.parquet'")
    found = con.execute(f"WITH {registry._LINES} SELECT count(*) FROM lines WHERE abs(paid_amount) > abs(allowed_amount) AND charge_amount IS NULL").fetchone()
    assert found[0] > 0
    monkeypatch.setitem(globals(), "DATA", str(tmp_path))
    test_same_rows_as_sql(spark, con, "readiness_gate")


def test_entry_gives_the_contract(spark):
    import __spark_entry__

    df = __spark_entry__.entry(spark)
    assert len(df.columns) == 148 and df.count() > 0
    assert "void" not in {t for _, t in df.dtypes}
    assert dict(df.dtypes)["paid_amount"] == "decimal(38,2)"
