"""Staged logs and the loaded snapshot on the sf0.001 test tables."""

import os

import pytest
from pyspark.sql import DataFrameWriter
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.exists(SF), reason="test tables not present")
WRITERS = "spark.sql.maxConcurrentOutputFileWriters"


def test_staged_logs_are_written_without_a_sort_by_day(spark, monkeypatch):
    from viewpulse.sources import logs as L
    from viewpulse.sources import testdata as TD

    seen = []
    for kind in ("parquet", "json"):
        write = getattr(DataFrameWriter, kind)
        monkeypatch.setattr(DataFrameWriter, kind, lambda w, *a, _write=write, **kw: (seen.append(int(spark.conf.get(WRITERS, "0"))), _write(w, *a, **kw))[1])
    monkeypatch.setattr(L, "_STAGED", {})
    before = spark.conf.get(WRITERS, "0")
    root = L.stage_logs(spark, SF)
    days = TD.search_log(spark, SF).select("log_date").distinct().count()
    assert len(seen) == 2 and all(n >= days for n in seen)
    assert spark.conf.get(WRITERS, "0") == before
    for log, staged in ((TD.search_log(spark, SF), spark.read.parquet(f"{root}/log_search")), (TD.content_log(spark, SF), spark.read.json(f"{root}/log_content"))):
        digest = [F.count("*"), F.sum(F.xxhash64(*[F.col(c).cast("string") for c in log.columns]).cast("decimal(38,0)"))]
        assert log.agg(*digest).first() == staged.select(*log.columns).agg(*digest).first()


def test_customers_meet_orders_before_lines(spark):
    from viewpulse.sources import testdata as TD

    plan = TD.search_log(spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    depth = {t: next(len(line) - len(line.lstrip(" :+-")) for line in plan.splitlines() if f"{t}#" in line and "Relation" in line)
             for t in ("c_custkey", "l_orderkey")}
    assert depth["c_custkey"] > depth["l_orderkey"]


def test_both_loads_of_a_snapshot_read_the_written_profiles(spark, monkeypatch):
    from viewpulse import registry

    loaded, load = [], registry.load_table
    monkeypatch.setattr(registry, "load_table", lambda df, *a: (loaded.append(df.inputFiles()), load(df, *a)))
    rows = registry.build()["load_snapshot"](spark, SF)
    assert len(loaded) == 2 and all("_profile/" in f for files in loaded for f in files)
    fact = registry.build()["fact"](spark, SF)
    assert sorted(map(tuple, rows.collect()), key=repr) == sorted(map(tuple, fact.collect()), key=repr)
