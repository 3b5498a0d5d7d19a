"""Benchmark: headline operators at $BENCH_SF_DIR on local[$BENCH_CPUS].

The stored ``sample`` table is materialised once from the driver tables (as
ingest would have written it, timed as ``load_sample``); the refresh and
consumer queries then read it. Each query runs once to warm up and once timed
(executed fully via the ``noop`` sink). Prints ONE JSON line.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from punctuo import fixtures as fx  # noqa: E402
from punctuo.operators import facts as FA  # noqa: E402
from punctuo.operators import histograms as H  # noqa: E402
from punctuo.operators import stats as ST  # noqa: E402
from punctuo.plans import refresh as R  # noqa: E402
from punctuo.registry import REGISTRY  # noqa: E402
from punctuo.session import build_session, shared_path  # noqa: E402


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def timed(fn, warm: bool = True) -> float:
    if warm:
        fn()
    t = time.time()
    fn()
    return round(time.time() - t, 3)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = build_session(master=f"local[{cpus}]", shuffle_partitions=max(cpus, 8), app="punctuo-bench")
    out = shared_path(spark, f"bench-{os.getpid()}-{int(time.time())}")
    q: dict[str, float] = {}

    def load():
        (fx.sample(spark, sf_dir).withColumn("day", F.to_date("scheduled_time"))
         .write.mode("overwrite").partitionBy("day").parquet(out + "/sample"))
    q["load_sample"] = timed(load, warm=False)
    sample = spark.read.parquet(out + "/sample").drop("day")
    remarks = fx.remarks(spark, sf_dir)

    q["freeze_threshold"] = timed(lambda: run(FA.freeze_threshold(sample)))
    q["latest_sample"] = timed(lambda: run(FA.latest_samples(sample, remarks)))
    q["sample_facts"] = timed(lambda: run(FA.facts(sample, remarks)))
    q["histogram_by_hour"] = timed(lambda: run(H.histogram(FA.facts(sample, remarks), "by_hour")))
    q["histogram_by_station"] = timed(lambda: run(H.histogram(FA.facts(sample, remarks), "by_station")))
    q["refresh_all_histograms"] = timed(lambda: R.refresh(spark, sample, remarks, out + "/state", dry_run=True))
    q["conditional_delay"] = timed(lambda: run(ST.conditional_delay(H.histogram(FA.facts(sample, remarks),
                                                                                 "by_hour"))))
    q["cancellation_rate"] = timed(lambda: run(ST.cancellation_rate(H.histogram(FA.facts(sample, remarks),
                                                                                 "by_day"))))
    q["rt_availability"] = timed(lambda: run(ST.rt_availability(sample)))
    for name in ("quality_counters", "stop_events", "gtfs_version_asof", "station_lines", "fptf_trip"):
        q[name] = timed(lambda n=name: run(REGISTRY[n](spark, sf_dir)))
    total = round(sum(q.values()), 3)
    print(json.dumps({"metric": "total_query_seconds", "value": total, "unit": "sec", "queries": q,
                      "sf": os.path.basename(sf_dir.rstrip("/")), "cpus": cpus,
                      "spark": spark.version}))
    spark.stop()


if __name__ == "__main__":
    main()
