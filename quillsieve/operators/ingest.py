"""Landing of records: classification, identity, merging under keys, watermarks, reconciliation, run state, drift."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillsieve.functions import exprs as X
from quillsieve.plans.contracts import DATE_FIELDS, ID_FIELDS, REQUIRED_SCALAR, REQUIRED_TEXT, table_of

# The form of a date or a date with time, and the reason codes of quarantined and of rejected records.
DATE_SHAPE = r"^\d{4}-\d{2}-\d{2}([T ].*)?\z"
NOT_OBJECT, MISSING_FIELD, WRONG_TYPE, BAD_IDENTIFIER, BAD_DATE = "record_not_object", "missing_required_field", "invalid_required_type", "invalid_identifier", "invalid_date_format"
REJECT_NOT_OBJECT, REJECT_NO_ID, REJECT_NO_STAMP, REJECT_BAD_STAMP = "not_an_object", "missing_source_id", "missing_source_timestamp", "invalid_source_timestamp"
#: States that a run may go to from each state, by kind of run; a state without successors is left never.
TRANSITIONS = {"files": {"running": ["succeeded", "failed", "skipped"]}, "objects": {"running": ["published", "failed"], "published": ["loading", "failed"], "loading": ["committed", "failed"]}}


def quarantine_reason(endpoint: str, payload: Column) -> Column:
    """The first structural rule that a record of ``endpoint`` breaks, as (reason_code, field); NULL for a valid one."""
    table = table_of(endpoint)
    required = [(f, ["string"]) for f in REQUIRED_TEXT[table]] + [(f, ["string", "number"]) for f in REQUIRED_SCALAR[table]]
    rule = lambda reason, field: F.struct(F.lit(reason).alias("reason_code"), F.lit(field).cast("string").alias("field"))

    def judged(p: Column) -> Column:
        kind = lambda k: F.coalesce(X.json_kind(p[k]), F.lit("null"))
        out = F.when(kind("whole") != "object", rule(NOT_OBJECT, None))
        for f, kinds in required:
            out = out.when(kind(f) == "null", rule(MISSING_FIELD, f)).when(~kind(f).isin(kinds), rule(WRONG_TYPE, f))
            out = out.when((kind(f) == "string") & X.strip(p[f]["text"]).isNull(), rule(BAD_IDENTIFIER, f))
        for f in DATE_FIELDS[table]:
            out = out.when((kind(f) != "null") & ((kind(f) != "string") | ~p[f]["text"].rlike(DATE_SHAPE)), rule(BAD_DATE, f))
        return out

    fields = [f for f, _ in required] + DATE_FIELDS[table]
    return X.parsed(payload, {"whole": None} | {f: f for f in fields}, lambda p, _: judged(p))


def quarantined(records: DataFrame, endpoint: str, payload: str = "payload") -> DataFrame:
    """``records`` with ``reason_code`` and ``field``, both NULL for valid ones."""
    return records.withColumn("why", quarantine_reason(endpoint, F.col(payload))).select(*records.columns, "why.reason_code", "why.field")


def classified(records: DataFrame, endpoint: str, payload: str = "payload") -> DataFrame:
    """``records`` with source id, timestamp and hash, or the reason to reject them; the id stays where it is known."""
    fields = ID_FIELDS[table_of(endpoint)]

    def named(p: Column) -> Column:
        is_object = F.coalesce(X.json_kind(p["whole"]) == "object", F.lit(False))
        kind = F.coalesce(X.json_kind(p["updated_at"]), F.lit("null"))
        return F.struct(
            is_object.alias("is_object"),
            F.when(is_object, X.record_id([X.id_part(p[f]) for f in fields])).alias("id"),
            F.when(is_object & (kind == "string"), X.updated_at(p["updated_at"]["text"])).alias("stamp"),
            ((kind == "null") | ((kind == "string") & X.strip(p["updated_at"]["text"]).isNull())).alias("no_stamp"),
        )

    def judged(p: Column, doc: Column) -> Column:
        reason = (
            F.when(~p["is_object"], REJECT_NOT_OBJECT)
            .when(p["id"].isNull(), REJECT_NO_ID)
            .when(p["no_stamp"], REJECT_NO_STAMP)
            .when(p["stamp"].isNull(), REJECT_BAD_STAMP)
        )
        out = F.struct(p["id"].alias("_source_record_id"), p["stamp"].alias("_source_updated_at"), reason.alias("reject_reason"))
        return X.let({"o": out}, lambda v: F.struct(*[v["o"][c].alias(c) for c in ("_source_record_id", "_source_updated_at", "reject_reason")], F.when(v["o"]["reject_reason"].isNull(), X.document_hash(doc)).alias("_payload_hash")))

    probes = {"whole": None} | {f: f for f in [*fields, "updated_at"]}
    found = X.parsed(F.col(payload), probes, lambda p, doc: X.let({"n": named(p)}, lambda v: judged(v["n"], doc)))
    return records.withColumn("found", found).select(*records.columns, "found.*")


KEY = ["_source_record_id", "_source_updated_at", "_payload_hash"]


def merge_absent(target: DataFrame, batch: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The rows of ``batch`` to insert: the first of each key by ``order`` that ``target`` lacks.

    A NULL in a key never equals anything, so such rows all go in. The first is an aggregate with map-side combine.
    """
    some = F.lit(False)
    for k in keys:
        some = some | F.col(k).isNull()
    first = _firsts(batch.where(~some), keys, order)
    return first.join(target.select(*keys), keys, "left_anti").select(*batch.columns).unionByName(batch.where(some))


def merge_marked(rows: DataFrame, keys: list[str], order: list[str], present: Column) -> DataFrame:
    """``merge_absent`` where target and batch are rows of one frame, of which ``present`` marks the target's: one pass."""
    some = F.lit(False)
    for k in keys:
        some = some | F.col(k).isNull()
    numbered = rows.withColumn("is_present", present).withColumn("own", F.when(some, F.monotonically_increasing_id()))
    rest = [c for c in rows.columns if c not in keys]
    place = F.when(~F.col("is_present"), F.struct(*order))
    groups = numbered.groupBy(*keys, "own").agg(F.max("is_present").alias("there"), F.min(place).isNotNull().alias("offered"), F.min_by(F.struct(*rest), place).alias("row"))
    return groups.where("offered AND (NOT there OR own IS NOT NULL)").select(*[F.col(c) if c in keys else F.col(f"row.{c}").alias(c) for c in rows.columns])


def _firsts(rows: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    rest = [c for c in rows.columns if c not in keys]
    best = rows.groupBy(*keys).agg(F.min_by(F.struct(*rest), F.struct(*order)).alias("row"))
    return best.select(*[F.col(c) if c in keys else F.col(f"row.{c}").alias(c) for c in rows.columns])


def turns(rows: DataFrame, keys: list[str], order: list[str]) -> Column:
    """Whether a row is the first of its key by ``order``; a row with a NULL in its key always is.

    Such rows would all meet in one window, so each of them gets a window of its own.
    """
    some = F.lit(False)
    for k in keys:
        some = some | F.col(k).isNull()
    own = F.when(some, F.xxhash64(*order))
    return some | (F.row_number().over(Window.partitionBy(*keys, own).orderBy(*order)) == 1)


def upsert_latest(old: DataFrame, new: DataFrame, keys: list[str], order: str) -> DataFrame:
    """The row of highest ``order`` of each key of both; on a tie the new one."""
    both = old.withColumn("is_new", F.lit(0)).unionByName(new.withColumn("is_new", F.lit(1)))
    rest = [c for c in old.columns if c not in keys]
    best = both.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(order, "is_new")).alias("row"))
    return best.select(*[F.col(k) if k in keys else F.col(f"row.{k}").alias(k) for k in old.columns])


def latest_versions(rows: DataFrame, key: str, order: list[str]) -> DataFrame:
    """Of all versions of a record the latest by ``order``; an extension, since staging keeps all versions."""
    rest = [c for c in rows.columns if c != key]
    return rows.groupBy(key).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("row")).select(key, "row.*")


def since(rows: DataFrame, column: str, watermark: str | None) -> DataFrame:
    """Rows strictly after a watermark, compared as texts; all rows without one."""
    return rows if watermark is None else rows.where(F.col(column) > watermark)


def last_watermark(pages: DataFrame, run: str, page: str, mark: str) -> DataFrame:
    """The mark of each run's last page, which need not be the highest."""
    return pages.groupBy(run).agg(F.max_by(mark, page).alias("candidate"))


def guarded(committed: DataFrame, candidates: DataFrame, keys: list[str]) -> DataFrame:
    """Candidates against the committed watermarks: one that is lower (as text) is refused and the old one stays."""
    both = candidates.join(committed, keys, "left")
    refused = F.coalesce(F.col("candidate") < F.col("committed"), F.lit(False))
    return both.select(*keys, "committed", "candidate", refused.alias("refused"), F.when(refused, F.col("committed")).otherwise(F.col("candidate")).alias("watermark"))


def row_numbers(records: DataFrame, page: list[str], position: str, valid: Column) -> DataFrame:
    """``records`` with ``_source_row_number``: valid records counted from 1 across pages, NULL for others.

    Pages are numbered apart and shifted by the rows of the pages before, so that no task sees all records.
    """
    run, number = page
    counts = records.groupBy(run, number).agg(F.count_if(valid).alias("n"))
    before = Window.partitionBy(run).orderBy(number).rowsBetween(Window.unboundedPreceding, -1)
    shifts = counts.select(run, number, F.coalesce(F.sum("n").over(before), F.lit(0)).alias("shift"))
    inside = Window.partitionBy(run, number).orderBy(position).rowsBetween(Window.unboundedPreceding, 0)
    numbered = records.withColumn("place", F.sum(valid.cast("int")).over(inside)).join(shifts, [run, number])
    return numbered.withColumn("_source_row_number", F.when(valid, F.col("shift") + F.col("place"))).drop("place", "shift")


def page_cycles(log: DataFrame, run: str, token: str) -> DataFrame:
    """Tokens that a run asked for more than once."""
    return log.where(F.col(token).isNotNull()).groupBy(run, token).agg(F.count(F.lit(1)).alias("times")).where("times > 1")


def reconciled(pages: DataFrame) -> DataFrame:
    """Pages whose counts do not add up: accepted + rejected = source, inserted + duplicates = accepted."""
    return pages.where("accepted + rejected <> source_records OR inserted + duplicates <> accepted")


def page_counts(rows: DataFrame, page: list[str], keys: list[str], order: list[str]) -> DataFrame:
    """Of classified ``rows`` (with ``reject_reason``), each page's records, accepted, rejected, inserted and duplicates.

    One pass over the classification: a window marks the first of each key, and one aggregate counts.
    """
    good = F.col("reject_reason").isNull()
    marked = rows.withColumn("is_first", turns(rows, keys, order))
    counts = marked.groupBy(*page).agg(F.count(F.lit(1)).alias("source_records"), F.count_if(good).alias("accepted"), F.count_if(~good).alias("rejected"), F.count_if(good & F.col("is_first")).alias("inserted"))
    return counts.withColumn("duplicates", F.col("accepted") - F.col("inserted"))


def run_reconciled(pages: DataFrame, manifests: DataFrame, quarantined: DataFrame, run: str = "run_id") -> DataFrame:
    """Runs whose sums are not the manifest's total (``total_records``), by rule and with both numbers.

    ``processed``: the records of all pages. ``loaded_and_quarantined``: the accepted ones with the quarantined ones
    (``quarantined``: run, n). A run without pages or quarantine counts as 0.
    """
    sums = pages.groupBy(run).agg(F.sum("source_records").alias("processed"), F.sum("accepted").alias("accepted"))
    both = manifests.select(run, "total_records").join(sums, run, "left").join(quarantined.groupBy(run).agg(F.sum("n").alias("quarantined")), run, "left")
    zero = lambda c: F.coalesce(F.col(c), F.lit(0))
    found = both.select(run, "total_records", zero("processed").alias("processed"), (zero("accepted") + zero("quarantined")).alias("loaded_and_quarantined"))
    rules = found.selectExpr(run, "total_records", "stack(2, 'processed', processed, 'loaded_and_quarantined', loaded_and_quarantined) AS (rule, records)")
    return rules.where("records <> total_records").select(run, "rule", "records", "total_records")


def missing_parents(children: DataFrame, parents: DataFrame, key: str, parent_key: str | None = None) -> DataFrame:
    """Rows of ``children`` whose ``key`` is in no row of ``parents``; a NULL key names no parent and passes."""
    known = parents.select(F.col(parent_key or key).alias("known_parent"))
    return children.join(known, F.col(key) == F.col("known_parent"), "left_anti").where(F.col(key).isNotNull())


def count_observations(old: DataFrame, seen: DataFrame, keys: list[str]) -> DataFrame:
    """Upsert with a counter: keys seen anew count up by 1 and take the new ``last_observed``, others start at 1.

    ``old`` has keys, fingerprint, first_observed, last_observed, occurrence_count; ``seen`` keys, fingerprint, observed.
    """
    once = seen.groupBy(*keys).agg(F.max_by("fingerprint", "observed").alias("new_fingerprint"), F.max("observed").alias("observed"))
    both = old.join(once, keys, "full")
    return both.select(
        *keys,
        F.coalesce("new_fingerprint", "fingerprint").alias("fingerprint"),
        F.coalesce("first_observed", "observed").alias("first_observed"),
        F.coalesce("observed", "last_observed").alias("last_observed"),
        (F.coalesce("occurrence_count", F.lit(0)) + F.col("observed").isNotNull().cast("long")).alias("occurrence_count"),
    )


def positions(records: DataFrame, page: list[str], order: str) -> DataFrame:
    """``records`` with ``position``: their place in the page from 1, rejected ones included."""
    return records.withColumn("position", F.row_number().over(Window.partitionBy(*page).orderBy(order)))


def envelope_problem(body: Column, requested: Column) -> Column:
    """The first rule that a page's envelope breaks; NULL for a valid one."""
    names = ("record_count", "page_token", "next_page_token", "high_water_mark")

    def judged(p: Column) -> Column:
        kind = lambda k: F.coalesce(X.json_kind(p[k]), F.lit("null"))
        text = lambda k: p[k]["text"]
        return (
            F.when(kind("records") != "array", "records_not_an_array")
            .when(F.exists(p["items"], lambda r: F.coalesce(X.json_kind(X.json_probe(r)), F.lit("")) != "object"), "record_not_an_object")
            .when((kind("record_count") != "number") | ~X.is_integer(p["record_count"]) | text("record_count").startswith("-"), "bad_record_count")
            .when(text("record_count").try_cast("bigint") != F.size(p["items"]), "record_count_differs")
            .when(F.coalesce(text("page_token"), F.lit("")) != F.coalesce(p["requested"], F.lit("")), "page_token_differs")
            .when((kind("next_page_token") != "null") & ((kind("next_page_token") != "string") | (text("next_page_token") == "")), "bad_next_page_token")
            .when((kind("high_water_mark") != "string") | (text("high_water_mark") == ""), "bad_high_water_mark")
        )

    probes = lambda p: X.let({"records": p["records"]} | {k: p[k] for k in names} | {"items": F.from_json(p["records"]["text"], "array<string>"), "requested": requested}, judged)
    return X.parsed(body, {"records": "records"} | {k: f"metadata.{k}" for k in names}, lambda p, _: probes(p))


def transitions(states: DataFrame, kind: str) -> DataFrame:
    """``states`` (before, after) with ``allowed``: whether a run of ``kind`` may go from one to the other."""
    pairs = [f"{a}>{b}" for a, after in TRANSITIONS[kind].items() for b in after]
    return states.withColumn("allowed", F.concat_ws(">", "before", "after").isin(pairs))


def consecutive_failures(runs: DataFrame, key: str, done: str = "succeeded") -> DataFrame:
    """Failed runs of each key since its last successful one: one small aggregate joined back, no window over a key's runs."""
    good = runs.where(F.col("status") == done).groupBy(F.col(key).alias("good_key")).agg(F.max("started_at").alias("good"))
    marked = runs.join(good, F.col(key).eqNullSafe(F.col("good_key")), "left")
    return marked.groupBy(key).agg(F.count_if((F.col("status") == "failed") & (F.col("good").isNull() | (F.col("started_at") > F.col("good")))).alias("failures"))


def latest_run(runs: DataFrame, done: str = "succeeded") -> DataFrame:
    """The last successful run by start; a null start counts as the highest."""
    return runs.where(F.col("status") == done).orderBy(F.col("started_at").desc_nulls_first(), F.col("run_id")).limit(1)


def freshness(runs: DataFrame, now: str, hours: int, done: list[str]) -> DataFrame:
    """Age of the last success of any loader in hours at ``now``, and whether it is fresh; without any it is not."""
    last = runs.where(F.col("status").isin(done)).agg(F.max("started_at").alias("last_success"))
    age = (F.unix_timestamp(F.lit(now).cast("timestamp")) - F.unix_timestamp(F.col("last_success").cast("timestamp"))) / F.lit(3600).cast("decimal(10,0)")
    return last.select("last_success", F.floor(age).cast("long").alias("age_hours"), F.coalesce(age <= hours, F.lit(False)).alias("fresh"))


def source_freshness(rows: DataFrame, now: str, column: str = "_loaded_at", warn_hours: int = 24, error_hours: int = 72) -> DataFrame:
    """Age of the newest row at ``now`` in seconds, and ``pass``, ``warn`` or ``error``; without any row it is an error."""
    newest = rows.agg(F.max(column).alias("newest"))
    age = F.unix_timestamp(F.lit(now).cast("timestamp")) - F.unix_timestamp(F.col("newest").cast("timestamp"))
    status = F.when(age.isNull() | (age > error_hours * 3600), "error").when(age > warn_hours * 3600, "warn").otherwise("pass")
    return newest.select("newest", age.cast("long").alias("age_seconds"), status.alias("status"))


def all_runs(files: DataFrame, objects: DataFrame) -> DataFrame:
    """Runs of both kinds as one table (run_id, endpoint, status, started_at, kind), so that freshness sees all of them."""
    columns = ["run_id", "endpoint", "status", "started_at"]
    return files.select(*columns, F.lit("files").alias("kind")).unionByName(objects.select(*columns, F.lit("objects").alias("kind")))
