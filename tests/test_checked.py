"""Damaged and drifted logs: every readable row is read, and the rest is in quarantine."""

import datetime as dt
import json
import os

from pyspark.sql import functions as F

from fixtures import E1_ROWS, E2_ROWS
from test_io_run import _write_daily_logs
from viewpulse.plans.daily_run import run_snapshot
from viewpulse.sources import checked as C
from viewpulse.sources import logs as L


def _rows(df):
    return sorted(map(str, df.collect()))


def _truncate(folder):
    """Cut a Parquet file of a day in half."""
    name = next(f for f in sorted(os.listdir(folder)) if f.endswith(".parquet"))
    with open(f"{folder}/{name}", "r+b") as f:
        f.truncate(os.path.getsize(f"{folder}/{name}") // 2)
    return name


def test_sound_logs_read_as_before(spark, scratch):
    _write_daily_logs(spark, scratch)
    for checked, plain, kind in ((C.read_search_log_checked, L.read_search_log, "search"), (C.read_content_log_checked, L.read_content_log, "content")):
        for window in ((None, None), ("20220602", "20220605"), ("20210101", "20210102")):
            got = checked(spark, f"{scratch}/{kind}", *window)
            want = plain(spark, f"{scratch}/{kind}", *window)
            assert _rows(got.rows.select(*want.columns)) == _rows(want) and got.quarantine.count() == 0
    hive = f"{scratch}/hive"
    L.read_search_log(spark, f"{scratch}/search").write.partitionBy("log_date").parquet(hive)
    assert _rows(C.read_search_log_checked(spark, hive, layout="hive").rows) == _rows(L.read_search_log(spark, hive, layout="hive"))


def test_a_truncated_day_costs_only_itself(spark, scratch):
    _write_daily_logs(spark, scratch)
    before = L.read_search_log(spark, f"{scratch}/search").where("log_date <> '2022-06-02'")
    want = _rows(before)
    name = _truncate(f"{scratch}/search/20220602")
    with open(f"{scratch}/search/20220603/notes.txt", "w") as f:  # a stray file beside good ones
        f.write("not a log")
    got = C.read_search_log_checked(spark, f"{scratch}/search")
    good = got.rows.where("log_date <> '2022-06-02'")
    assert _rows(good) == want
    found = {(os.path.basename(r.file), r.day, r.kind, r.source) for r in got.quarantine.collect()}
    assert found >= {(name, dt.date(2022, 6, 2), C.UNREADABLE, "search"), ("notes.txt", dt.date(2022, 6, 3), C.UNREADABLE, "search")}
    assert all(r.reason for r in got.quarantine.collect())


def test_corrupt_content_rows(spark, scratch):
    _write_daily_logs(spark, scratch)
    bad = ['{"Contract": "A1", "AppName": "VOD", "Tot', "[1, 2]", "plain words", '{"Contract": "A1", "AppName": "VOD", "TotalDuration": "long"}', '"text"', "7"]
    with open(f"{scratch}/content/20220602.json", "a") as f:
        f.write("\n".join([*bad, "", "   ", "{}", '{"_source": null, "Contract": 5, "AppName": "VOD", "TotalDuration": "12"}']) + "\n")
    got = C.read_content_log_checked(spark, f"{scratch}/content")
    assert got.rows.count() == len(E1_ROWS) + 2
    assert got.rows.where("Contract = '5'").select("TotalDuration").first()[0] == 12
    assert sorted(r.record for r in got.quarantine.collect()) == sorted(bad)
    (counted,) = C.quarantine_counts(got.quarantine).collect()
    assert (counted.n, counted.day, counted.kind) == (len(bad), dt.date(2022, 6, 2), C.CORRUPT)


def test_any_field_of_a_record(spark, scratch):
    os.makedirs(f"{scratch}/content")
    lines = [{"Contract": "A", "AppName": "VOD", "TotalDuration": 1, "Mac": "m1", "extra": {"deep": [1, 2]}},
             {"_index": "i", "_source": {"Contract": "B", "AppName": "VOD", "TotalDuration": 2, "Mac": "m2"}}]
    with open(f"{scratch}/content/20220601.json", "w") as f:
        f.write("\n".join(map(json.dumps, lines)))
    rows = C.read_content_envelope(spark, f"{scratch}/content")
    got = rows.select("Contract", F.try_variant_get("doc", "$.Mac", "string"), F.try_variant_get("doc", "$.extra.deep[1]", "int"),
                      F.try_variant_get("envelope", "$._index", "string"))
    assert sorted(map(tuple, got.collect())) == [("A", "m1", 2, None), ("B", "m2", None, "i")]


def test_days_with_other_columns(spark, scratch):
    root = f"{scratch}/search"
    write = lambda day, rows, schema: spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"{root}/{day}")
    write("20220601", [("u", "kw", "2022-06-01 08:00:00", "isp", "box", "wifi")], L.S.SEARCH_LOG_SCHEMA)
    write("20220602", [(7, "kw", 1654128000, "x")], "user_id long, keyword string, datetime int, unknown string")
    write("20220603", [("u", "kw", 1654214400123, 2.0)], "user_id string, keyword string, datetime long, platform double")
    write("20220604", [("u", dt.datetime(2022, 6, 4, 9, 0))], "user_id string, datetime timestamp")
    write("20220605", [("u", "one", "2022-06-05 08:00:00")], "user_id string, keyword string, datetime string")
    write("20220605", [("u", 2, "2022-06-05 09:00:00")], "user_id string, keyword int, datetime string")  # two kinds in one day
    write("20220606", [(["nested"],)], "user_id array<string>")
    got = C.read_search_log_checked(spark, root)
    rows = {(r.log_date.day, r.user_id, r.keyword, r.datetime, r.proxy_isp, r.platform) for r in got.rows.collect()}
    assert rows == {(1, "u", "kw", "2022-06-01 08:00:00", "isp", "box"), (2, "7", "kw", "2022-06-02 00:00:00", None, None),
                    (3, "u", "kw", "2022-06-03 00:00:00", None, "2"), (4, "u", None, "2022-06-04 09:00:00", None, None),
                    (5, "u", "one", "2022-06-05 08:00:00", None, None), (5, "u", "2", "2022-06-05 09:00:00", None, None)}
    assert got.rows.schema.names == L.SEARCH_OUT_SCHEMA.names
    assert [(r.day.day, r.reason) for r in got.quarantine.collect()] == [(6, "nested columns: user_id")]


def test_a_daily_run_past_damage(spark, scratch):
    _write_daily_logs(spark, scratch)
    sound = run_snapshot(spark, f"{scratch}/search", f"{scratch}/content", f"{scratch}/map/mapping.csv", f"{scratch}/wh1", end="20220714")
    with open(f"{scratch}/content/20220601.json", "a") as f:
        f.write('{"Contract": "A1", "App\n')
    os.makedirs(f"{scratch}/search/20220620")
    with open(f"{scratch}/search/20220620/part-0.parquet", "wb") as f:
        f.write(b"PAR1 broken")
    res = run_snapshot(spark, f"{scratch}/search", f"{scratch}/content", f"{scratch}/map/mapping.csv", f"{scratch}/wh2", end="20220714", quarantine_dir=f"{scratch}/q")
    assert _rows(spark.read.parquet(res.tables["fact_customer_360"])) == _rows(spark.read.parquet(sound.tables["fact_customer_360"]))
    assert spark.read.parquet(f"{scratch}/q/search").count() == 1 and spark.read.parquet(f"{scratch}/q/content").count() == 1
    assert len(E2_ROWS) > 0
