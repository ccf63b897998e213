"""Seconds of the headline queries over $BENCH_SF_DIR on local[$BENCH_CPUS], as one line of JSON."""

import json
import os
import statistics
import time

from pyspark.sql import SparkSession

from quillsieve.plans import registry
from quillsieve.session import configured

DIR, CPUS = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1"), os.environ.get("BENCH_CPUS", "8")
HEADLINE = """raw_field_extract safe_numeric_cast source_record_id payload_hash stg_medical_claim input_medical_claim input_eligibility input_pharmacy_claim claims_accepted
net_paid_amount normalize_diagnoses grain_conflicts fk_coverage eligibility_consolidation merge_insert_if_absent quarantine_by_reason latest_version_per_record
load_reconciliation dq_not_null schema_observation readiness_gate""".split()
RUNS = int(os.environ.get("BENCH_RUNS", "2"))


def machine() -> float:
    """Seconds of a fixed loop in one process: sorts of a million numbers, the best of three. Tells machines apart."""
    took = []
    for _ in range(3):
        began, x = time.perf_counter(), 1
        numbers = [x := (x * 1103515245 + 12345) % 2**31 for _ in range(1_000_000)]
        numbers.sort()
        took.append(time.perf_counter() - began)
    return round(min(took), 3)


def main() -> None:
    spark = (
        configured(SparkSession.builder.master(f"local[{CPUS}]"))
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    queries, out = registry.queries(), {}
    for name in HEADLINE:
        times = []
        for _ in range(RUNS + 1):
            began = time.perf_counter()
            queries[name](spark, DIR).write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - began)
        out[name] = round(statistics.median(times[1:]), 3)
    spark.stop()
    print(json.dumps({"metric": "total of the medians of the headline queries after one warm-up", "value": round(sum(out.values()), 3), "unit": "sec", "queries": out, "machine_sec": machine(), "sf": os.path.basename(DIR.rstrip("/")).removeprefix("sf")}))


if __name__ == "__main__":
    main()
