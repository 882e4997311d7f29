"""Headline queries on ``$BENCH_SF_DIR`` with ``local[$BENCH_CPUS]``; prints one JSON line.

Every query runs once to warm up and then a few times; its figure is the median of the wall
time from building the plan to the last row. DuckDB runs the counterpart SQL the same way.
"""

from __future__ import annotations

import glob
import json
import os
import statistics
import sys
import tempfile
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tripmart.config import spark_session  # noqa: E402
from verification.oracles import ORACLES  # noqa: E402
from verification.queries import QUERIES  # noqa: E402

HEADLINE = (
    "daily_trips",
    "zone_metrics",
    "zone_metrics_join",
    "trip_ids",
    "incremental_daily",
    "dq_report",
)
RUNS = int(os.environ.get("BENCH_RUNS", "3"))


def median_time(run) -> float:
    run()
    times = []
    for _ in range(RUNS):
        start = time.perf_counter()
        run()
        times.append(time.perf_counter() - start)
    return round(statistics.median(times), 3)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = spark_session(
        "bench",
        master=f"local[{cpus}]",
        spark__sql__shuffle__partitions=cpus,
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
        spark__driver__host="127.0.0.1",
        spark__driver__bindAddress="127.0.0.1",
        spark__driver__memory="16g",
        spark__checkpoint__dir=tempfile.mkdtemp(prefix="bench-"),
    )
    spark.sparkContext.setLogLevel("ERROR")
    duck = duckdb.connect()
    duck.execute(f"set threads = {cpus}")
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        duck.execute(f"create view {name} as select * from '{path}'")

    def on_spark(name):
        return lambda: QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()

    seconds = {name: median_time(on_spark(name)) for name in HEADLINE}
    duck_seconds = {
        name: median_time(lambda sql=ORACLES[name]: duck.execute(sql).to_arrow_table()) for name in HEADLINE
    }
    line = {
        "metric": "headline_queries_wall_time",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
        "duckdb": duck_seconds,
    }
    print(json.dumps(line))
    spark.stop()


if __name__ == "__main__":
    main()
