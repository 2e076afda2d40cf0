"""Daily runs: resuming after a failure, changed inputs, dimensions that outlive a run, publishing without a gap."""

import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F

from test_io_run import _write_daily_logs
from viewpulse.operators import star as ST
from viewpulse.plans import daily_run as DR
from viewpulse.plans.dimensions import changed_rows, read_dimension, upsert_dimension
from viewpulse.plans.runlog import RunLog, current_tables
from viewpulse.plans.warehouse import publish
from viewpulse.sources.files import fingerprint


def _rows(df):
    return sorted(map(str, df.collect()))


def _run(spark, root, out="wh", **kw):
    return DR.run_snapshot(spark, f"{root}/search", f"{root}/content", f"{root}/map/mapping.csv", f"{root}/{out}", **{"end": "20220714", **kw})


def _forbid(monkeypatch, *names):
    def no(*a, **kw):
        raise AssertionError("this stage was finished before")

    for name in names:
        module, _, f = name.rpartition(".")
        monkeypatch.setattr({"L": DR.L, "DR": DR, "ST": DR.ST}[module], f, no)


@pytest.mark.parametrize("dies_in", ["build_fact", "dim_cust"])
def test_a_run_that_died_goes_on(spark, scratch, monkeypatch, dies_in):
    _write_daily_logs(spark, scratch)
    whole = _run(spark, scratch, "whole")

    def dies(*a, **kw):
        raise RuntimeError("killed")

    with monkeypatch.context() as m:
        m.setattr(DR.ST, dies_in, dies)
        with pytest.raises(RuntimeError):
            _run(spark, scratch)
    with monkeypatch.context() as m:  # the raw logs aren't read again
        _forbid(m, "L.read_search_log", "L.read_content_log")
        done = _run(spark, scratch)
    for name in whole.tables:
        assert _rows(spark.read.parquet(done.tables[name])) == _rows(spark.read.parquet(whole.tables[name])), name
    with monkeypatch.context() as m:  # a third run has nothing left to do but the reports
        _forbid(m, "L.read_search_log", "L.read_content_log", "ST.build_fact", "DR.upsert_dimension")
        _run(spark, scratch)
    with monkeypatch.context() as m:
        _forbid(m, "L.read_search_log")
        with pytest.raises(AssertionError):
            _run(spark, scratch, resume=False)


def test_changed_inputs_give_the_new_answer(spark, scratch):
    _write_daily_logs(spark, scratch)
    first = _run(spark, scratch)
    before = _rows(spark.read.parquet(first.tables["fact_customer_360"]))
    with open(f"{scratch}/content/20220601.json", "a") as f:
        f.write(json.dumps({"Contract": "NEW", "AppName": "VOD", "TotalDuration": 3}) + "\n")
    second = _run(spark, scratch)
    fact = spark.read.parquet(second.tables["fact_customer_360"])
    assert fact.where("Profile_ID = 'NEW'").count() == 1 and fact.count() == len(before) + 1
    assert read_dimension(spark, second.tables["dim_cust"]).where("Profile_ID = 'NEW'").count() == 1


def test_fingerprints(spark, scratch):
    os.makedirs(f"{scratch}/d")
    for n in ("a", "b"):
        with open(f"{scratch}/d/{n}", "w") as f:
            f.write(n)
    one = fingerprint(spark, [f"{scratch}/d"], 1)
    assert one == fingerprint(spark, [f"{scratch}/d"], 1) != fingerprint(spark, [f"{scratch}/d"], 2)
    with open(f"{scratch}/d/b", "w") as f:
        f.write("bb")
    assert one != fingerprint(spark, [f"{scratch}/d"], 1)
    assert fingerprint(spark, []) == fingerprint(spark, [])


def test_two_daily_runs_leave_no_fact_row_without_its_dimensions(spark, scratch):
    """The second run's window holds other users and customers; those of the first snapshot stay."""
    _write_daily_logs(spark, scratch)
    _run(spark, scratch, end="20220714")
    os.makedirs(f"{scratch}/later/search/20220801")
    spark.createDataFrame([("u9", "vtv", f"2022-0{m}-02 08:00:00", "i", "b", "w") for m in (7, 8)], DR.L.S.SEARCH_LOG_SCHEMA).write.mode("overwrite").parquet(f"{scratch}/search/20220802")
    with open(f"{scratch}/content/20220803.json", "w") as f:
        f.write("\n".join(json.dumps({"Contract": c, "AppName": "VOD", "TotalDuration": 3}) for c in ("A1", "Z9")) + "\n")
    res = _run(spark, scratch, end="20220815")
    fact = spark.read.parquet(res.tables["fact_customer_360"])
    assert {r[0] for r in fact.select("snapshot_date_key").distinct().collect()} == {20220714, 20220815}
    users, custs, days = (read_dimension(spark, res.tables[n]) for n in ("dim_user", "dim_cust", "dim_date"))
    searched, watched = fact.where("data_source <> 'log_content'"), fact.where("data_source <> 'log_search'")
    assert searched.count() and searched.join(users, "Profile_ID", "left_anti").count() == 0
    assert watched.count() and watched.join(custs, "Profile_ID", "left_anti").count() == 0
    assert fact.join(days, fact.snapshot_date_key == days.date_key, "left_anti").count() == 0
    for dim in (users, custs):
        assert dim.count() == dim.select("Profile_ID").distinct().count()
    assert days.agg(F.min("full_date"), F.max("full_date")).first()[:] == ("2022-06-01", "2022-08-31")


def _log(spark, scratch):
    return RunLog(spark, f"{scratch}/log", "run", 1)


def test_upsert_rewrites_only_partitions_with_changes(spark, scratch):
    schema, path = "Profile_ID string, Active string", f"{scratch}/dim"
    base = spark.createDataFrame([(f"p{i}", None if i % 3 else "Low") for i in range(400)], schema)
    log = _log(spark, scratch)
    put = lambda df, f, n=8: upsert_dimension(df, path, log, f, f"{scratch}/stage", buckets=n)
    assert put(base, "f1") == 8
    stamps = lambda: {(d, f): os.stat(f"{path}/{d}/{f}").st_mtime_ns for d in os.listdir(path) if "=" in d for f in os.listdir(f"{path}/{d}") if f.endswith("parquet")}
    before = stamps()
    assert put(base, "f2") == 0 and stamps() == before  # nothing new
    update = spark.createDataFrame([("p7", "High"), ("new", "Low"), ("p3", "Low"), (None, "High")], schema)
    touched = put(update, "f3", n=99)  # a table keeps its own number of partitions
    assert 1 <= touched <= 2
    kept = {d for d, _ in before} - {d for d, f in set(stamps()) - set(before)}
    assert len(kept) == 8 - touched and all(stamps()[k] == v for k, v in before.items() if k[0] in kept)
    want = dict(map(tuple, base.collect())) | {"p7": "High", "new": "Low", "p3": "Low"}
    assert dict(map(tuple, read_dimension(spark, path).collect())) == want
    assert changed_rows(base, base, "Profile_ID").count() == 0
    assert put(base.limit(0), "f4") == 0 and read_dimension(spark, f"{scratch}/none") is None


def test_upsert_that_died_is_finished_from_its_staged_copy(spark, scratch):
    """The new partitions are staged before old ones go: a partition lost half-way comes back."""
    import shutil

    schema, path = "Profile_ID string, Active string", f"{scratch}/dim"
    log, stage = _log(spark, scratch), f"{scratch}/stage"
    upsert_dimension(spark.createDataFrame([(f"p{i}", "Low") for i in range(50)], schema), path, log, "f1", stage, buckets=2)
    update = spark.createDataFrame([(f"p{i}", "High") for i in range(10)], schema)
    upsert_dimension(update, path, log, "f2", stage)
    want = _rows(read_dimension(spark, path))
    moved = f"{path}/bucket_of_2=0"
    shutil.move(moved, f"{scratch}/lost")  # as if the driver died between deleting and renaming
    upsert_dimension(update, path, RunLog(spark, f"{scratch}/log", "again", 1), "f2", stage)
    assert _rows(read_dimension(spark, path)) == want


def test_reports_are_published_without_a_gap(spark, scratch):
    old, new = spark.range(1000), spark.range(1000, 1500)
    spark.sql(f"CREATE DATABASE IF NOT EXISTS vp_publish LOCATION '{scratch}/db'")
    table = "vp_publish.report"
    publish(old, f"{scratch}/report", "v1", table)
    reader = spark.table(table)  # opened before the new version
    publish(new, f"{scratch}/report", "v2", table)
    assert reader.count() == 1000 and spark.table(table).agg(F.min("id")).first()[0] == 1000
    broken = new.select(F.raise_error(F.lit("no")).cast("long").alias("id"))
    with pytest.raises(Exception, match="no"):
        publish(broken, f"{scratch}/report", "v3", table)
    assert spark.table(table).count() == 500
    spark.sql("DROP DATABASE vp_publish CASCADE")


def test_current_tables_after_runs(spark, scratch):
    _write_daily_logs(spark, scratch)
    first = _run(spark, scratch)
    opened = spark.read.parquet(first.tables["olap_category_taste"])
    second = _run(spark, scratch)
    current = current_tables(spark, f"{scratch}/wh")
    assert set(current) == set(DR.REPORTS) and all(second.tables[n] == p for n, p in current.items())
    assert first.tables["olap_category_taste"] != second.tables["olap_category_taste"] and opened.count() > 0
    assert current_tables(spark, f"{scratch}/nowhere") == {}


def test_dimensions_in_a_catalog(spark, scratch):
    _write_daily_logs(spark, scratch)
    spark.sql(f"CREATE DATABASE IF NOT EXISTS vp_dims LOCATION '{scratch}/db'")
    _run(spark, scratch, end="20220713", database="vp_dims")
    res = _run(spark, scratch, end="20220714", database="vp_dims")
    assert spark.table("vp_dims.dim_cust").count() == read_dimension(spark, res.tables["dim_cust"]).count() == 8
    assert spark.table("vp_dims.olap_category_loyalty").count() == 3
    assert spark.table("vp_dims.fact_customer_360").select("snapshot_date_key").distinct().count() == 2
    spark.sql("DROP DATABASE vp_dims CASCADE")


def test_month_ends():
    assert DR._month_end(dt.date(2022, 2, 3)) == dt.date(2022, 2, 28) and DR._month_end(dt.date(2024, 12, 31)) == dt.date(2024, 12, 31)
    assert ST.snapshot_key("2022-07-14") == 20220714
