"""Time the headline queries: one warm-up run, then the median of the repeats.

Prints one JSON line at the end, and each query's time on stderr as it goes. BENCH_SF_DIR, BENCH_CPUS and
BENCH_REPEATS set the data, cores and repeats; a query that takes long is repeated no more once its
repeats have taken BENCH_SECONDS, and one whose warm-up took longer than that counts with its warm-up.
After BENCH_TOTAL seconds the line is printed with what has been measured, and `unfinished` names the rest.
Building a query's plan counts, as some join files while they are built.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import threading
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from panelweave.session import local_session  # noqa: E402
from panelweave.workload import QUERIES  # noqa: E402

HEADLINE = [
    "count_by_sweep",
    "ever_in_window",
    "ever_in_window_days",
    "panel_wide",
    "load_files_full_join",
    "full_join_two_key",
    "response_right_join",
    "earliest_with_ties",
    "first_per_group",
    "household_min",
    "unpivot_multi_value",
    "clean_to_long",
    "chop_collect",
    "recode_arith",
    "code_to_category",
    "bcs70_marstat",
    "mcs_religion",
    "harmonised_counts",
    "harmonised_windows",
    "harmonised_panel",
]


def range_join_form(spark, sf_dir):
    """`ever_in_window` the plain way, to compare with: every row joined with all windows around it."""
    from pyspark.sql import functions as F

    from panelweave.plans.counts import age_windows
    from panelweave.workload.orders_panel import panel_long

    long = panel_long(spark, sf_dir).filter("value <> 'No'")
    windows = age_windows(panel_long(spark, sf_dir)).withColumnRenamed("study", "of")
    inside = (F.col("study") == F.col("of")) & F.col("fup").between(F.col("low"), F.col("high"))
    return long.join(windows, inside).groupBy("low", "high", "study", "name", "value").agg(F.countDistinct("iid").alias("n"))


def seconds(run) -> float:
    start = time.perf_counter()
    run().write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    repeats = int(os.environ.get("BENCH_REPEATS", "5"))
    limit = float(os.environ.get("BENCH_SECONDS", "10"))
    total = float(os.environ.get("BENCH_TOTAL", "1400"))
    spark = local_session(cores=cores, app="bench")
    settings = {"shuffle_partitions": spark.conf.get("spark.sql.shuffle.partitions"), "spark": spark.version}
    times: dict[str, float] = {}
    pair: dict[str, float] = {}

    def report() -> None:
        result = {
            "metric": "headline query time, sum of medians",
            "value": round(sum(times.values()), 3),
            "unit": "sec",
            "queries": dict(times),
            "pair": dict(pair),
            "unfinished": [name for name in HEADLINE if name not in times],
            "sf": sf_dir.rpartition("sf")[2].strip("/"),
            "cores": cores,
            **settings,
        }
        print(json.dumps(result), flush=True)

    def out_of_time() -> None:
        report()
        os._exit(0)

    watch = threading.Timer(total, out_of_time)
    watch.daemon = True
    watch.start()

    def median(name: str, run) -> float:
        first = seconds(lambda: run(spark, sf_dir))
        found = [first] if first > limit else []
        while not found or (first <= limit and len(found) < repeats and sum(found) < limit):
            found.append(seconds(lambda: run(spark, sf_dir)))
        took = round(statistics.median(found), 3)
        print(f"{name} {took} s, {len(found)} runs", file=sys.stderr, flush=True)
        return took

    for name in HEADLINE:
        times[name] = median(name, QUERIES[name])
    pair["ever_in_window"] = times["ever_in_window"]
    pair["range_join_count_distinct"] = median("range join", range_join_form)
    watch.cancel()
    report()
    spark.stop()


if __name__ == "__main__":
    main()
