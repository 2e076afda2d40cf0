"""Benchmark: headline queries over materialised raw logs.

date-partitioned raw logs (timed apart as ``stage``), then every query reads
those files.  One warm-up run, then the median of ``BENCH_RUNS`` runs per
query, each forced with a ``noop`` write.  Prints one JSON line.

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_RUNS (default 5).
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)

from pyspark.sql import SparkSession  # noqa: E402

from viewpulse.operators import keywords as K  # noqa: E402
from viewpulse.operators import reports as R  # noqa: E402
from viewpulse.operators import star as ST  # noqa: E402
from viewpulse.plans.daily_run import run_snapshot  # noqa: E402
from viewpulse.plans.profiles import build_content_profile, build_search_profile, search_pairs  # noqa: E402
from viewpulse.sources import dictionary as D  # noqa: E402
from viewpulse.sources import logs as L  # noqa: E402
from viewpulse.sources import testdata as TD  # noqa: E402
from viewpulse.streaming import (  # noqa: E402
    content_profile_from_partials,
    ingest_content,
    ingest_search,
    search_profile_from_partials,
)


def session(cpus: int, scratch: str) -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("viewpulse-bench")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("BENCH_DRIVER_MEMORY", "16g"))
        .config("spark.sql.shuffle.partitions", str(max(8, 2 * cpus)))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.local.dir", f"{scratch}/local")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    if not spark.sparkContext.getCheckpointDir() and not spark.conf.get("spark.checkpoint.dir", None):
        spark.sparkContext.setCheckpointDir(f"{scratch}/checkpoint")
    return spark


def noop(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "5"))
    scratch = tempfile.mkdtemp(prefix="viewpulse-bench-")
    spark = session(cpus, scratch)

    # ---- stage the inputs (raw logs + dictionary), timed apart ----
    t0 = time.time()
    search_root, content_root, kmap_path = f"{scratch}/log_search", f"{scratch}/log_content", f"{scratch}/mapping"
    TD.search_log(spark, sf_dir).write.partitionBy("log_date").parquet(search_root)
    TD.content_log(spark, sf_dir).write.partitionBy("Date").json(content_root)
    D.write_keyword_map(TD.keyword_map(spark, sf_dir), kmap_path)
    stage_sec = time.time() - t0

    start, end = TD.WINDOW_START, TD.SNAPSHOT_END
    key = ST.snapshot_key(end)

    def slog():
        return L.read_search_log(spark, search_root, start, end, layout="hive")

    def clog():
        return L.read_content_log(spark, content_root, start, end, layout="hive")

    def kmap():
        return D.read_keyword_map(spark, kmap_path)

    def fact_df():
        sp = build_search_profile(slog(), kmap(), end, start, with_device=True)
        cp = build_content_profile(clog(), start, end)
        return ST.build_fact(ST.build_obt(sp, cp), ST.dim_service(spark), key)

    fact_path = f"{scratch}/fact"
    fact_df().write.mode("overwrite").partitionBy("snapshot_date_key").parquet(fact_path)
    dim = ST.dim_service(spark)

    def fact_t():
        return spark.read.parquet(fact_path)

    # Incremental path: each raw file ingested once into per-day partials (timed apart).
    t0 = time.time()
    ingest_search(spark, search_root, f"{scratch}/partials_s", f"{scratch}/ck_s", layout="hive").awaitTermination()
    ingest_content(spark, content_root, f"{scratch}/partials_c", f"{scratch}/ck_c", layout="hive").awaitTermination()
    ingest_sec = time.time() - t0

    run_counter = [0]

    def daily():
        run_counter[0] += 1
        run_snapshot(spark, search_root, content_root, kmap_path, f"{scratch}/wh{run_counter[0]}",
                     start, end, layout="hive")

    jobs = {
        "search_profile": lambda: noop(build_search_profile(slog(), kmap(), end, start, with_device=True)),
        "content_profile": lambda: noop(build_content_profile(clog(), start, end)),
        "fact": lambda: noop(fact_df()),
        "keyword_refresh": lambda: noop(K.merge_map(kmap(), K.classify(K.new_keywords(search_pairs(slog(), end, start), kmap())))),
        "olap_category_loyalty": lambda: noop(R.category_loyalty(fact_t(), dim)),
        "olap_category_taste": lambda: noop(R.category_taste(fact_t(), dim)),
        "olap_power_vs_casual": lambda: noop(R.power_vs_casual(fact_t(), dim)),
        "olap_taste_diversity": lambda: noop(R.taste_diversity(fact_t())),
        "olap_search_growth": lambda: noop(R.search_growth(fact_t())),
        "olap_interest_migration": lambda: noop(R.interest_migration(fact_t())),
        "daily_run": daily,
        "search_profile_incremental": lambda: noop(
            search_profile_from_partials(spark, f"{scratch}/partials_s", kmap(), end, start)),
        "content_profile_incremental": lambda: noop(
            content_profile_from_partials(spark, f"{scratch}/partials_c", start, end)),
    }
    times = {}
    for name, job in jobs.items():
        job()  # warm-up
        samples = []
        for _ in range(runs):
            t = time.time()
            job()
            samples.append(time.time() - t)
        times[name] = round(statistics.median(samples), 3)

    rows = {
        "search_log": spark.read.parquet(search_root).count(),
        "content_log": spark.read.json(content_root).count(),
        "fact": fact_t().count(),
    }
    rows_per_sec = {
        "search_profile": int(rows["search_log"] / times["search_profile"]),
        "content_profile": int(rows["content_log"] / times["content_profile"]),
    }
    sf = os.path.basename(sf_dir).replace("sf", "")
    print(json.dumps({
        "metric": "sum_of_median_query_sec",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(sf) if sf.replace(".", "").isdigit() else sf,
        "cpus": cpus,
        "runs": runs,
        "stage_sec": round(stage_sec, 3),
        "ingest_sec": round(ingest_sec, 3),
        "rows": rows,
        "rows_per_sec": rows_per_sec,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
