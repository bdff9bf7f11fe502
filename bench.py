"""Time the registered queries; prints one JSON line.

BENCH_SF_DIR names the parquet tables, BENCH_CPUS the cores. Every result is
evaluated in full, all rows and columns, into a sink that discards it. The
headline queries run once untimed first, to warm up the JVM; nothing is cached.

The three reports read stored tables. Their load is timed apart, as load_tables; the
registered queries of the same name include it and are not timed again.
"""

from __future__ import annotations

import json
import os
import sys
import time

from playmart.plans import reports
from playmart.registry import QUERIES, stored_tables
from playmart.session import local_session

REPORTS = {
    "plays_by_hour": lambda t: reports.plays_by_hour(t["songplays"], t["time"]),
    "plays_by_level": lambda t: reports.plays_by_level(t["songplays"]),
    "users_by_gender": lambda t: reports.users_by_gender(t["users"]),
}
HEADLINE = [
    *REPORTS,
    "songplays",
    "users",
    "songs",
    "artists",
    "time",
]
# Same work as another query; only the table returned differs.
REPEATS = ["arrivals_users", "arrivals_time", "etl_users", "etl_time"]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count()))
    spark = local_session(cpus, "16g", **{"spark.sql.shuffle.partitions": cpus})
    spark.sparkContext.setLogLevel("ERROR")

    def run(name: str) -> float:
        started = time.perf_counter()
        result = REPORTS[name](tables) if name in REPORTS else QUERIES[name](spark, sf_dir)
        result.write.format("noop").mode("overwrite").save()
        return round(time.perf_counter() - started, 3)

    wanted = ["songplays", "time", "users"]
    stored_tables(spark, sf_dir, wanted)
    started = time.perf_counter()
    tables = stored_tables(spark, sf_dir, wanted)
    loaded = round(time.perf_counter() - started, 3)
    for name in HEADLINE:
        run(name)
    others = [name for name in QUERIES if name not in HEADLINE + REPEATS]
    seconds = {name: run(name) for name in HEADLINE + others} | {"load_tables": loaded}
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline_total_seconds",
                "value": round(sum(seconds[q] for q in HEADLINE), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": sf_dir.rsplit("sf", 1)[-1],
            }
        )
    )
    sys.stdout.flush()


if __name__ == "__main__":
    main()
