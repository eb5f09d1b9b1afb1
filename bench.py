"""Wall time of the queries in one warm session; prints one JSON line.

BENCH_SF_DIR   folder of the tables (default /root/testdata/sf0.1)
BENCH_CPUS     local cores (default 8)
BENCH_RUNS     timed runs per query after one warm-up, the median counts (default 1)
BENCH_QUERIES  comma-separated names, or "all" (default: the headline queries)

Results go to Spark's ``noop`` sink: every row and column is produced, none is kept.
The tables are single files of one row group, which one task would read; before the clock starts
they are copied to a temporary folder as ``BENCH_CPUS`` files each, as larger tables are stored.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time

from haulmark import catalog
from haulmark.catalog.q_sources import TABLES
from haulmark.session import build_session


HEADLINE = (
    "fn_null_like", "fn_to_int", "fn_to_decimal", "fn_to_date", "row_signature", "scan_csv_strings",
    "ingest_report", "ingest_people", "ingest_routes", "ingest_itineraries", "ingest_safety_events",
    "ingest_station_daily", "ingest_service_details", "ingest_weekly_scorecard", "unpivot_daily",
    "classify_helpers", "route_ordinal", "dedup_keep_last", "insert_ignore_dups", "upsert_overwrite",
    "upsert_coalesce", "upsert_null_safe", "rebuild_window", "calendar_days", "week_lookup",
    "tenure_from_service", "weekly_aggregates", "scorecard_long", "projected_score", "revenue_log",
    "package_volume", "week_ranking",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "1"))
    queries = catalog.all_queries()
    wanted = os.environ.get("BENCH_QUERIES", "")
    names = list(queries) if wanted == "all" else [n for n in wanted.split(",") if n] or list(HEADLINE)
    spark = build_session("haulmark-bench", f"local[{cpus}]", **{
        "spark.ui.enabled": "false", "spark.driver.memory": "16g",
        "spark.sql.shuffle.partitions": cpus, "spark.checkpoint.dir": tempfile.mkdtemp(prefix="haulmark-bench-")})
    spark.sparkContext.setLogLevel("ERROR")
    split = tempfile.mkdtemp(prefix="haulmark-bench-")
    for table in TABLES:
        spark.read.parquet(f"{folder}/{table}.parquet").repartition(int(cpus)).write.parquet(f"{split}/{table}.parquet")
    seconds: dict[str, float] = {}
    for name in names:
        print(f"# {name}", file=sys.stderr, flush=True)
        timed = []
        for _ in range(runs + 1):
            start = time.perf_counter()
            queries[name](spark, split).write.format("noop").mode("overwrite").save()
            timed.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(timed[1:]), 4)
        print(f"#   {seconds[name]}", file=sys.stderr, flush=True)
    lines = spark.read.parquet(f"{folder}/lineitem.parquet").count()
    spark.stop()
    print(json.dumps({
        "metric": "total median wall time of the queries", "value": round(sum(seconds.values()), 3),
        "unit": "sec", "queries": seconds, "sf": folder.rsplit("sf", 1)[-1], "lineitem_rows": lines,
        "cpus": int(cpus), "runs": runs}))


if __name__ == "__main__":
    main()
