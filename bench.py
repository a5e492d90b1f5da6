"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR names the table folder, BENCH_CPUS the number of local cores. As in a
real load, the exports and stored tables are staged as parquet first; that time is
the entry ``stage_exports``. Every query then reads the staged tables as a whole. It
runs once to warm up the JVM and then BENCH_RUNS times; the best run counts.
Results go to Spark's noop sink, so that the whole result is computed and none of
it is brought to the driver.
"""

from __future__ import annotations

import json
import os
import re
import tempfile
import time
import uuid

from pyspark.sql import SparkSession

from contract.adapters import frame
from contract.queries import CHECKS
from leaseload.session import tune

HEADLINE = (
    "payments_load",
    "payments_counters",
    "charges_load",
    "credits_as_negative_charges",
    "receipts_load",
    "invoice_build",
    "payment_invoice_link",
    "invoice_status_recalc",
    "lease_active_first_wins",
    "billing_schedule",
    "card_profiles_load",
    "gate_log_load",
    "insert_skip_existing",
    "created_by_backfill",
    "former_tenants_extract",
    "payments_rejects",
    "units_insert",
    "customers_load",
    "lease_history_quad_dedup",
    "customer_balance",
    "export_files_read",
)


def session(cpus: int) -> SparkSession:
    built = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("leaseload-bench")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "16g"))
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    built.sparkContext.setLogLevel("ERROR")
    return tune(built)


def stage_all(spark: SparkSession, sf_dir: str, cpus: int) -> str:
    """Write every table the headline queries read, in as many files as there are cores."""
    folder = f"{os.environ.get('BENCH_STAGE_DIR') or tempfile.gettempdir()}/bench-{uuid.uuid4().hex}"
    for name in sorted({a for query in HEADLINE for a in CHECKS[query].adapters}):
        frame(spark, sf_dir, name).repartition(cpus).write.parquet(f"{folder}/{name}")
    return folder


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "1"))
    spark = session(cpus)
    begin = time.perf_counter()
    folder = stage_all(spark, sf_dir, cpus)
    seconds = {"stage_exports": round(time.perf_counter() - begin, 3)}
    for name in HEADLINE:
        best = float("inf")
        for attempt in range(runs + 1):
            begin = time.perf_counter()
            result = CHECKS[name].over(lambda table: spark.read.parquet(f"{folder}/{table}"))
            result.write.format("noop").mode("overwrite").save()
            if attempt:
                best = min(best, time.perf_counter() - begin)
        seconds[name] = round(best, 3)
    found = re.search(r"sf([0-9.]+)", sf_dir)
    print(
        json.dumps(
            {
                "metric": "total seconds of staging and the headline queries",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": float(found.group(1)) if found else sf_dir,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
