"""Headline queries at $BENCH_SF_DIR (default /root/testdata/sf0.1) on local[$BENCH_CPUS]: one JSON line with seconds each (median of runs after a warm-up).

Beside the seconds stand the rows that each query returns and the bytes that one run of it writes to shuffles.
"""

from __future__ import annotations

import gzip
import json
import os
import shutil
import sys
import tempfile
import time
from statistics import median

from pyspark.sql import Observation
from pyspark.sql import functions as F

from eventpulse.plans import catalog
from eventpulse.session import session
from eventpulse.sources import adapter, lake

HEADLINE = ["ecosystem_daily", "repo_daily", "actor_daily", "repo_trending", "type_histogram", "lake_overview", "per_day_automated_share", "held_out_rates", "watch_outside_automated", "assert_reconcile", "pending_hours", "verify_lake", "marts_freshness", "capture_overlap", "panel_gainers"]
REPEATS = 3


def timed(run) -> float:
    run()
    seconds = []
    for _ in range(REPEATS):
        begin = time.perf_counter()
        run()
        seconds.append(time.perf_counter() - begin)
    return round(median(seconds), 3)


def shuffled(spark) -> int:
    """Bytes written to shuffles by all stages so far."""
    none, gateway = spark._jvm.java.util.ArrayList(), spark.sparkContext._gateway
    stages = spark.sparkContext._jsc.sc().statusStore().stageList(none, False, False, gateway.new_array(gateway.jvm.double, 0), none)
    return sum(stages.apply(k).shuffleWriteBytes() for k in range(stages.size()))


def measured(spark, run) -> tuple[float, int, int]:
    """Seconds, rows and shuffled bytes of a query."""
    before, rows = shuffled(spark), Observation()
    run().observe(rows, F.count(F.lit(1)).alias("n")).write.format("noop").mode("overwrite").save()
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
    moved = shuffled(spark) - before
    return timed(lambda: run().write.format("noop").mode("overwrite").save()), rows.get["n"], moved


def main() -> None:
    sf_dir, cpus = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1"), os.environ.get("BENCH_CPUS", "8")
    spark = session(f"local[{cpus}]", "bench", **{"spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "8g", "spark.ui.retainedStages": "100000"})
    spark.sparkContext.setLogLevel("ERROR")
    queries, seconds, rows_out, moved = catalog.queries(), {}, {}, {}
    for name in HEADLINE:
        seconds[name], rows_out[name], moved[name] = measured(spark, lambda: queries[name](spark, sf_dir))
    folder = tempfile.mkdtemp(prefix="eventpulse-bench-")
    try:  # the published pair: distinct event types over gzip NDJSON and over the lake
        rows = adapter.lake(spark, sf_dir).where("dt = date '2024-01-08'").toPandas()
        for hour, part in rows.groupby("hr"):
            path = f"{folder}/{lake.hour_filename('2024-01-08', int(hour))}"
            with gzip.open(path, "wt") as f:
                for r in part.itertuples():
                    f.write(json.dumps({"id": r.id, "type": r.type, "actor": json.loads(r.actor), "repo": json.loads(r.repo) if r.repo else None, "payload": json.loads(r.payload), "public": True, "created_at": r.created_at.isoformat() + "Z"}) + "\n")
            if hour < 3:
                lake.write_hour(spark, path, f"{folder}/lake", "2024-01-08", int(hour))
        three = [f"{folder}/{lake.hour_filename('2024-01-08', h)}" for h in range(3)]
        seconds["distinct_types_gzip"] = timed(lambda: lake.read_ids(spark, three).select("type").distinct().count())
        seconds["distinct_types_parquet"] = timed(lambda: lake.read_lake(spark, f"{folder}/lake").select("type").distinct().count())
    finally:
        shutil.rmtree(folder)
    spark.stop()
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(seconds.values()), 3), "unit": "sec", "queries": seconds, "rows": rows_out, "shuffle_bytes": moved, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")}))


if __name__ == "__main__":
    sys.exit(main())
