"""Entry points for schedulers: ``python -m quillsieve.jobs COMMAND``. Each is a thin call of the library.

Commands: ``load-legacy`` (CSV snapshot to raw tables), ``load`` (streaming load of JSON lines), ``build`` (raw tables to
the contracts), ``gate`` (readiness of a vendor sample; exit code 1 if it is not ready), ``healthcheck`` (freshness).
Every event is one line of JSON on the standard output, with secrets masked.
"""

from __future__ import annotations

import argparse
import json
import re
import sys
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from quillsieve.functions.exprs import MARK, MASKED
from quillsieve.operators import ingest, mapping, staging
from quillsieve.plans.contracts import FINAL, TABLES
from quillsieve.session import configured
from quillsieve.sources import files
from quillsieve.sources.shared import Store
from quillsieve.streaming import incremental

COMMANDS = ("load-legacy", "load", "build", "gate", "healthcheck")


@dataclass
class Config:
    """What a job needs. ``problems`` names everything that is wrong, not only the first."""

    command: str
    root: str = ""
    source: str = ""
    endpoint: str = ""
    snapshot: str = ""
    data_source: str = ""
    most_age_hours: int = 30
    now: str = ""

    def problems(self) -> list[str]:
        out = [] if self.command in COMMANDS else [f"command {self.command!r} is none of {', '.join(COMMANDS)}"]
        needed = {"load-legacy": ("root", "source", "snapshot"), "load": ("root", "source", "endpoint"), "build": ("root", "data_source"), "gate": ("source",), "healthcheck": ("root",)}
        out += [f"{name} is missing" for name in needed.get(self.command, ()) if not getattr(self, name)]
        if self.endpoint and self.endpoint not in TABLES and self.endpoint not in FINAL:
            out.append(f"endpoint {self.endpoint!r} is unknown")
        if self.snapshot and not files.COMPONENT.match(self.snapshot):
            out.append(f"snapshot {self.snapshot!r} cannot be part of a path")
        if self.most_age_hours <= 0:
            out.append("most_age_hours is not positive")
        return out


def masked(text: str) -> str:
    for pattern in MASKED:
        text = re.sub(pattern, rf"\1{MARK}", text)
    return text


def log(event: str, **fields: object) -> None:
    at = datetime.now(timezone.utc).isoformat()
    print(masked(json.dumps({"at": at, "event": event} | fields, default=str, sort_keys=True)), flush=True)


def run(spark: SparkSession, config: Config) -> int:
    """The exit code: 0, or 1 for a gate or health check that does not pass, or 2 for a wrong configuration."""
    if problems := config.problems():
        log("configuration_refused", problems=problems)
        return 2
    now = config.now or datetime.now(timezone.utc).strftime("%Y-%m-%d %H:%M:%S")
    log("started", command=config.command)
    if config.command == "load-legacy":
        paths = {t: f"{config.source.rstrip('/')}/{t}.csv" for t in FINAL}
        log("loaded", version=files.legacy_load(spark, paths, config.snapshot, now, Store(spark, config.root)))
    elif config.command == "load":
        query = incremental.load(spark, config.source, f"{config.root.rstrip('/')}/{config.endpoint}", f"{config.root.rstrip('/')}/checkpoints/{config.endpoint}", config.endpoint)
        query.awaitTermination()
        log("loaded", rows=sum(p.numInputRows for p in query.recentProgress))
    elif config.command == "build":
        store = Store(spark, config.root)
        raw = {t: files.loaded(spark, store, t).withColumn("_raw_payload", F.lit(None).cast("string")) for t in FINAL}
        log("built", version=files.reload({t: staging.final(df, t, config.data_source) for t, df in raw.items()}, Store(spark, f"{config.root.rstrip('/')}/contracts")))
    elif config.command == "gate":
        read = lambda name: files.read_csv(spark, f"{config.source.rstrip('/')}/{name}.csv")
        members = mapping.crosswalk(files.numbered_csv(spark, f"{config.source.rstrip('/')}/members.csv"), "row_number")
        answer = mapping.verdict(mapping.gate(read("claims"), read("spans"), members)).first()
        log("gate", ready=answer["ready"], reasons=answer["reasons"])
        return 0 if answer["ready"] else 1
    else:
        found = [ingest.source_freshness(files.loaded(spark, Store(spark, config.root), t), now, warn_hours=config.most_age_hours).first() for t in FINAL]
        fresh = all(r["status"] == "pass" for r in found)
        log("health", fresh=fresh, tables={t: r["status"] for t, r in zip(FINAL, found, strict=True)})
        return 0 if fresh else 1
    return 0


def main(arguments: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="quillsieve.jobs")
    parser.add_argument("command", choices=COMMANDS)
    for name in ("root", "source", "endpoint", "snapshot", "data-source", "now"):
        parser.add_argument(f"--{name}", default="")
    parser.add_argument("--most-age-hours", type=int, default=30)
    given = parser.parse_args(arguments)
    return run(configured(SparkSession.builder).getOrCreate(), Config(**vars(given)))


if __name__ == "__main__":
    sys.exit(main())
