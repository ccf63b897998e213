"""Files in and out: CSV snapshots, gzip pages of JSON lines, manifests, immutable and all-or-nothing publishing."""

from __future__ import annotations

import gzip
import hashlib
import json
import re
import uuid
from datetime import datetime
from urllib.parse import urlparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillsieve.sources.shared import PublishError, Store

COMPONENT = re.compile(r"[A-Za-z0-9][A-Za-z0-9._-]{0,127}\Z")
MOST_PAGES = 999_999


def read_csv(spark: SparkSession, path: str) -> DataFrame:
    """A CSV with header, every column a text; quoted line breaks stay, and empty values are empty texts."""
    df = spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(path)
    if not df.columns:
        raise ValueError(f"{path} has no header")
    return df.na.fill("")


def numbered_csv(spark: SparkSession, path: str) -> DataFrame:
    """``read_csv`` of one file with ``row_number``: the row's place in the file from 1.

    A file with line breaks inside quotes is one task's, so a row's place in the task is its place in the file.
    """
    place = F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)
    return read_csv(spark, path).withColumn("row_number", place + 1)


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """file, payload: the JSON lines of all pages below ``path`` without blank lines; a gzip page is one task."""
    lines = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", "*.jsonl.gz").text(path)
    return lines.where(F.trim("value") != "").select(F.col("_metadata.file_path").alias("file"), F.col("value").alias("payload"))


def page_bytes(records: list[dict]) -> bytes:
    """Records as gzip JSON lines with sorted keys; the same records always give the same bytes."""
    text = "".join(json.dumps(r, sort_keys=True, ensure_ascii=False) + "\n" for r in records)
    return gzip.compress(text.encode(), mtime=0)


def run_prefix(vendor: str, endpoint: str, load_date: str, run_id: str) -> str:
    """The keys' beginning of a run, in folders that Spark reads as partitions."""
    for part in (vendor, endpoint, load_date, run_id):
        if not COMPONENT.match(part):
            raise ValueError(f"{part!r} cannot be part of a path")
    return f"vendor={vendor}/endpoint={endpoint}/load_date={load_date}/run_id={run_id}"


def publish(store: Store, prefix: str, pages: list[list[dict]], cursor: str) -> dict:
    """Pages first, then the manifest, then ``_SUCCESS`` with the manifest's hash: a reader never sees half a run."""
    if not 0 < len(pages) <= MOST_PAGES:
        raise ValueError("a run has 1 to 999999 pages")
    listed = []
    for i, records in enumerate(pages, 1):
        meta = store.put(f"{prefix}/page={i:06}.jsonl.gz", page_bytes(records))
        listed.append({"page_number": i, "file": f"page={i:06}.jsonl.gz", "sha256": meta.sha256, "records": len(records), "bytes": meta.size_bytes})
    return _finished(store, prefix, listed, cursor)


def _finished(store: Store, prefix: str, listed: list[dict], cursor: str) -> dict:
    manifest = {"version": 1, "pages": listed, "page_count": len(listed), "total_records": sum(p["records"] for p in listed), "candidate_cursor": cursor}
    data = json.dumps(manifest, sort_keys=True).encode()
    store.put(f"{prefix}/manifest.json", data)
    store.put(f"{prefix}/_SUCCESS", hashlib.sha256(data).hexdigest().encode())
    return manifest


def write_pages(records: DataFrame, store: Store, prefix: str, cursor: str, page: str = "page_number", position: str = "position", payload: str = "payload") -> dict:
    """Publishes a DataFrame of JSON records: the executors write a gzip file a page, the driver only the manifest.

    Pages go to folders ``page_number=N`` below a folder of this attempt, lines in the order of ``position`` with keys
    sorted at all depths, then the manifest names them and ``_SUCCESS`` ends the run, so a failed attempt is never seen.
    """
    if store.exists(f"{prefix}/_SUCCESS"):
        raise PublishError(f"{prefix} is published")
    attempt = f"data-{uuid.uuid4().hex}"
    lines = records.select(F.col(page).cast("int").alias("page_number"), F.col(position).alias("position"), F.to_json(F.parse_json(F.col(payload))).alias("value"))
    dealt = lines.repartition("page_number").sortWithinPartitions("page_number", "position").drop("position")
    dealt.write.partitionBy("page_number").option("compression", "gzip").text(store.url(f"{prefix}/{attempt}"))
    spark = records.sparkSession
    bodies = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.gz").load(store.url(f"{prefix}/{attempt}"))
    file = F.concat_ws("/", F.slice(F.split("path", "/"), -3, 3))
    sums = bodies.select(file.alias("file"), F.sha2("content", 256).alias("sha256"), F.col("length").alias("bytes"))
    counts = spark.read.option("recursiveFileLookup", True).text(store.url(f"{prefix}/{attempt}")).groupBy(F.concat_ws("/", F.slice(F.split(F.col("_metadata.file_path"), "/"), -3, 3)).alias("file")).agg(F.count(F.lit(1)).alias("records"))
    number = F.regexp_extract("file", "page_number=([0-9]+)", 1).cast("int")
    found = sums.join(counts, "file", "left").select(number.alias("page_number"), "file", "sha256", F.coalesce("records", F.lit(0)).alias("records"), "bytes")
    listed = [r.asDict() for r in found.orderBy("page_number", "file").take(MOST_PAGES + 1)]
    if not 0 < len(listed) <= MOST_PAGES:
        raise ValueError("a run has 1 to 999999 pages")
    return _finished(store, prefix, listed, cursor)


def published(store: Store, prefix: str) -> dict:
    """The manifest of a complete run."""
    if not store.exists(f"{prefix}/_SUCCESS"):
        raise PublishError(f"{prefix} is not published")
    data = store.get(f"{prefix}/manifest.json")
    if store.get(f"{prefix}/_SUCCESS").decode().strip() != hashlib.sha256(data).hexdigest():
        raise PublishError(f"the manifest of {prefix} was changed")
    return json.loads(data)


def complete_runs(store: Store) -> list[str]:
    """The prefixes of all runs that are published to their end."""
    return [k.removesuffix("/_SUCCESS") for k in store.list("vendor=") if k.endswith("/_SUCCESS")]


def read_runs(spark: SparkSession, store: Store) -> DataFrame:
    """vendor, endpoint, load_date, run_id, page_number, payload: the records of all complete runs.

    The first four are partitions, so a filter on them reads only its runs. Runs that are not complete are not listed.
    """
    schema = "value string, vendor string, endpoint string, load_date string, run_id string"
    runs = complete_runs(store)
    if not runs:
        empty = spark.createDataFrame([], schema.replace("value string, ", "") + ", page_number int, payload string")
        return empty.select("vendor", "endpoint", "load_date", "run_id", "page_number", "payload")
    pages = spark.read.schema(schema).option("basePath", store.url("")).option("pathGlobFilter", "page=*.jsonl.gz").text([store.url(r) for r in runs])
    number = F.regexp_extract(F.col("_metadata.file_name"), "page=([0-9]+)", 1).cast("int")
    return pages.where(F.trim("value") != "").select("vendor", "endpoint", "load_date", "run_id", number.alias("page_number"), F.col("value").alias("payload"))


def verify(spark: SparkSession, store: Store, prefix: str) -> DataFrame:
    """The pages of a run that differ from its manifest: empty for a sound run."""
    listed = spark.createDataFrame([(p["file"], p["sha256"], p["records"]) for p in published(store, prefix)["pages"]], "file string, sha256 string, records long")
    bodies = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.gz").load(store.url(prefix))
    below = lambda path: F.element_at(F.split(path, f"{re.escape(prefix)}/"), -1)
    sums = bodies.select(below(F.col("path")).alias("file"), F.sha2("content", 256).alias("sha256"))
    lines = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", "*.gz").text(store.url(prefix)).where(F.trim("value") != "")
    counts = lines.groupBy(below(F.col("_metadata.file_path")).alias("file")).agg(F.count(F.lit(1)).alias("records"))
    return mismatches(listed, sums.join(counts, "file", "left").withColumn("records", F.coalesce("records", F.lit(0))), ["file"])


def mismatches(listed: DataFrame, there: DataFrame, keys: list[str]) -> DataFrame:
    """Listed pages that are missing, have another checksum, or another number of records (the first that applies)."""
    both = listed.alias("l").join(there.withColumn("is_there", F.lit(True)).alias("t"), keys, "left")
    problem = F.when(F.col("is_there").isNull(), "missing").when(F.col("l.sha256") != F.col("t.sha256"), "checksum").when(F.col("l.records") != F.col("t.records"), "record_count")
    return both.withColumn("problem", problem).where("problem IS NOT NULL").select(*keys, "problem")


def cursor(store: Store, vendor: str, endpoint: str) -> tuple[str | None, int]:
    """The committed cursor and its version; (None, 0) before the first."""
    names = store.list(f"cursor/{vendor}/{endpoint}/")
    return (json.loads(store.get(names[-1]))["cursor"], len(names)) if names else (None, 0)


def commit_cursor(store: Store, vendor: str, endpoint: str, new: str, run_id: str, expected: int) -> int:
    """Commits a cursor as the version after ``expected``; returns that version.

    A cursor that is lower as text than the committed one is refused, and so is a version that another run has taken
    meanwhile: versions are immutable objects, of which one writer makes each.
    """
    old, version = cursor(store, vendor, endpoint)
    if old is not None and new < old:
        raise PublishError(f"cursor {new!r} is before the committed {old!r}")
    if version != expected:
        raise PublishError(f"version {expected} of the cursor was expected, and {version} is there")
    store.put(f"cursor/{vendor}/{endpoint}/{expected + 1:09}", json.dumps({"cursor": new, "run_id": run_id}, sort_keys=True).encode())
    return expected + 1


def reload(tables: dict[str, DataFrame], store: Store) -> str:
    """Replaces whole tables by a snapshot of them, all at once; returns the version's folder.

    Every table is written to a folder of the new version, and then one small object, numbered one higher than the last,
    names that version. A reader takes the highest number, so it sees the old tables or the new ones, never a mix, and a
    crash before the last step changes nothing. Older versions but the one before are removed.
    """
    version = f"version-{uuid.uuid4().hex}"
    for name, df in tables.items():
        df.write.option("compression", "zstd").parquet(store.url(f"{version}/{name}"))
    names = store.list("current-")
    store.put(f"current-{len(names) + 1:09}" if not names else f"current-{int(names[-1][8:]) + 1:09}", version.encode())
    for old in names[:-1]:
        folder = store.get(old).decode()
        store.delete(folder)
        store.delete(old)
    return version


def loaded(spark: SparkSession, store: Store, table: str) -> DataFrame:
    """A table of the current version."""
    names = store.list("current-")
    if not names:
        raise PublishError(f"{store.root} holds no version")
    return spark.read.parquet(store.url(f"{store.get(names[-1]).decode()}/{table}"))


def legacy_load(spark: SparkSession, paths: dict[str, str], snapshot: str, loaded_at: str, store: Store) -> str:
    """CSV files by table as raw rows (number in file order, row as JSON), reloaded together."""
    from quillsieve.operators.staging import legacy_raw

    return reload({t: legacy_raw(numbered_csv(spark, p), snapshot, F.col("row_number"), loaded_at) for t, p in paths.items()}, store)


def snapshot_problems(manifest: dict, tables: list[str]) -> list[str]:
    """Everything that is wrong with a snapshot's manifest, not only the first."""
    out = []
    if manifest.get("version") != 1:
        out.append("version is not 1")
    if not COMPONENT.match(str(manifest.get("snapshot_id", ""))):
        out.append("snapshot_id is missing or malformed")
    if not (isinstance(manifest.get("source"), str) and manifest["source"].strip()):
        out.append("source is not a nonempty text")
    if not _is_stamp(manifest.get("created_at")):
        out.append("created_at is no ISO-8601 time stamp")
    artifacts = manifest.get("artifacts")
    if not isinstance(artifacts, list):
        return [*out, "artifacts is not a list"]
    names = [a.get("table") for a in artifacts if isinstance(a, dict)]
    out += [f"table {t} is missing" for t in sorted(set(tables) - set(names))]
    out += [f"table {t} is unknown" for t in sorted({str(n) for n in names} - set(tables))]
    out += [f"table {t} is listed twice" for t in sorted({t for t in names if names.count(t) > 1 and t in tables})]
    for a in artifacts:
        if not isinstance(a, dict):
            out.append("an artifact is not an object")
            continue
        if not re.match(r"[0-9a-f]{64}\Z", str(a.get("sha256", ""))):
            out.append(f"{a.get('table')}: sha256 is malformed")
        out += [f"{a.get('table')}: {problem}" for problem in _url_problems(a.get("url"))]
        if not isinstance(a.get("size_bytes"), int) or isinstance(a.get("size_bytes"), bool) or a["size_bytes"] <= 0:
            out.append(f"{a.get('table')}: size_bytes is not a positive integer")
    return out


def _is_stamp(value: object) -> bool:
    try:
        return isinstance(value, str) and bool(datetime.fromisoformat(value.replace("Z", "+00:00")))
    except ValueError:
        return False


def _url_problems(url: object, insecure: bool = False) -> list[str]:
    if not isinstance(url, str) or not url:
        return ["url is not a nonempty text"]
    parts = urlparse(url)
    out = []
    if parts.scheme not in ("http", "https"):
        out.append("url is not of http or https")
    elif parts.scheme == "http" and not insecure:
        out.append("url is not encrypted")
    if not parts.hostname:
        out.append("url has no host")
    if ".." in parts.path.split("/"):
        out.append("url leaves its folder")
    return out
