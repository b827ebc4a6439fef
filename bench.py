"""Benchmark of the headline queries; prints one JSON line.

``BENCH_SF_DIR`` (tables, default sf0.1) and ``BENCH_CPUS`` (threads, default
8). Three kinds of figures:

* ``ingest_ndjson``: raw JSON lines to the ZSTD hosts table. The raw records
  are made first, about 9.5 KB each with unread payload, as in a scan export;
  ``ingest_gb_per_s`` is the throughput. All files are different ones:
  the observations are written ``EXPORT_COPIES`` times with other addresses.
* ``build_layers``: all written layers after the hosts table, in one cold run.
* the other names: a registered query, read to the end. Each runs twice; the
  second run is reported, as the first also compiles its code. The ingest
  runs three times and reports the last.
"""

from __future__ import annotations

import json
import os
import sys
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scanledger.plans.build import build_from_hosts, ingest
from scanledger.session import local_session, scratch_dir
from workload.inputs import Inputs, inputs, raw_columns
from workload.queries import QUERIES

HEADLINE = (
    "companies_rollup", "signals_rollup", "signals_rollup_direct", "company_key", "cve_features",
    "why", "gold_top", "resolution_yield", "null_rates", "distinct_counts", "signal_prevalence",
    "band_distribution", "dashboard_stats", "layer_reconcile", "decision_overlay",
    "parse_decisions", "trace_summary", "best_contacts", "contact_report", "query_accounts",
)
RECORD_BYTES = 9500
EXPORT_COPIES = 4


def finish(table: DataFrame) -> None:
    table.write.format("noop").mode("overwrite").save()


def timed(action) -> float:
    start = time.perf_counter()
    action()
    return round(time.perf_counter() - start, 3)


def raw_export(given: Inputs, folder: str) -> None:
    """All observations, several times, as raw records with a whole page as unread payload."""
    pages = given.table("pages").select("page_id", "html")
    count = pages.count()
    rows = given.hosts.join(pages, F.col("page_id") == F.col("event_id") % count)
    copies = rows.withColumn("copy", F.explode(F.sequence(F.lit(1), F.lit(EXPORT_COPIES))))
    copies = copies.withColumn("ip_str", F.concat("ip_str", F.lit("."), "copy"))
    missing = F.greatest(F.lit(RECORD_BYTES - 800) - F.length("html"), F.lit(0))
    payload = F.concat("html", F.repeat(F.lit("~"), missing))
    record = F.to_json(F.struct(*raw_columns(), payload.alias("banner")))
    copies.select(record.alias("value")).repartition(64).write.text(folder)


def stored_bytes(spark: SparkSession, folder: str) -> int:
    files = spark.read.format("binaryFile").load(folder).select("length")
    return files.agg(F.sum("length")).first()[0]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(os.environ.get("BENCH_CPUS", "8"), "scanledger-bench")
    spark.sparkContext.setLogLevel("ERROR")
    given = inputs(spark, sf_dir)
    seconds: dict[str, float] = {}

    folder = scratch_dir(spark, "bench")
    raw = f"{folder}/raw"
    raw_export(given, raw)
    size = stored_bytes(spark, raw)
    ingest(spark, given.raw_lines_path, f"{folder}/warm")
    for run in ("first", "second", "third"):
        seconds["ingest_ndjson"] = timed(lambda: ingest(spark, raw, f"{folder}/{run}"))
    seconds["build_layers"] = timed(lambda: build_from_hosts(given.hosts, f"{folder}/layers"))

    for name in HEADLINE:
        finish(QUERIES[name](spark, sf_dir))
        seconds[name] = timed(lambda: finish(QUERIES[name](spark, sf_dir)))

    print(
        json.dumps(
            {
                "metric": "total time of the headline queries",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(os.path.normpath(sf_dir)).removeprefix("sf"),
                "ingest_gb": round(size / 1e9, 3),
                "ingest_gb_per_s": round(size / 1e9 / seconds["ingest_ndjson"], 3),
                "baseline_ingest_gb_per_s": 0.94,
            }
        )
    )


if __name__ == "__main__":
    sys.exit(main())
