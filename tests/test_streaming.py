import os
import shutil

from fixtures import END, START
from test_io_run import _write_daily_logs
from viewpulse.plans.profiles import build_content_profile, build_search_profile
from viewpulse.sources import dictionary as D
from viewpulse.sources import logs as L
from viewpulse.streaming import (
    content_profile_from_partials,
    ingest_content,
    ingest_search,
    search_profile_from_partials,
)


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_incremental_ingest_equals_batch(spark, scratch):
    # first half of the files arrives, is ingested, then the rest arrives
    full = f"{scratch}/full"
    _write_daily_logs(spark, full)
    land = f"{scratch}/land"
    os.makedirs(f"{land}/search"), os.makedirs(f"{land}/content")
    days_s, days_c = sorted(os.listdir(f"{full}/search")), sorted(os.listdir(f"{full}/content"))
    for d in days_s[:4]:
        shutil.copytree(f"{full}/search/{d}", f"{land}/search/{d}")
    for f in days_c[:2]:
        shutil.copy(f"{full}/content/{f}", f"{land}/content/{f}")
    for _ in range(2):
        ingest_search(spark, f"{land}/search", f"{scratch}/sp", f"{scratch}/ck_s", max_files_per_trigger=2).awaitTermination()
        ingest_content(spark, f"{land}/content", f"{scratch}/cp", f"{scratch}/ck_c", max_files_per_trigger=1).awaitTermination()
        for d in days_s[4:]:
            if not os.path.exists(f"{land}/search/{d}"):
                shutil.copytree(f"{full}/search/{d}", f"{land}/search/{d}")
        for f in days_c[2:]:
            if not os.path.exists(f"{land}/content/{f}"):
                shutil.copy(f"{full}/content/{f}", f"{land}/content/{f}")

    kmap = D.read_keyword_map(spark, f"{full}/map/mapping.csv")
    batch_c = build_content_profile(L.read_content_log(spark, f"{full}/content", START, END))
    inc_c = content_profile_from_partials(spark, f"{scratch}/cp", START, END)
    assert _rows(inc_c) == _rows(batch_c)

    batch_s = build_search_profile(L.read_search_log(spark, f"{full}/search", START, END), kmap, END, START, True)
    inc_s = search_profile_from_partials(spark, f"{scratch}/sp", kmap, END, START)
    assert _rows(inc_s) == _rows(batch_s)


def test_daily_run_incremental_equals_full(spark, scratch):
    from viewpulse.plans.daily_run import run_snapshot

    _write_daily_logs(spark, scratch)
    args = (spark, f"{scratch}/search", f"{scratch}/content", f"{scratch}/map/mapping.csv")
    full = run_snapshot(*args, f"{scratch}/wh_full", end="20220714")
    inc = run_snapshot(*args, f"{scratch}/wh_inc", end="20220714", incremental_dir=f"{scratch}/inc")
    again = run_snapshot(*args, f"{scratch}/wh_inc", end="20220714", incremental_dir=f"{scratch}/inc")
    for name in ("fact_customer_360", "dim_user", "dim_cust", "olap_category_loyalty", "olap_search_growth"):
        a = _rows(spark.read.parquet(full.tables[name]))
        assert a == _rows(spark.read.parquet(inc.tables[name])) == _rows(spark.read.parquet(again.tables[name])), name


def test_empty_log_and_lost_checkpoint(spark, scratch):
    import os

    import pytest

    from viewpulse import streaming as ST_

    os.makedirs(f"{scratch}/none")
    assert ST_.content_profile_from_partials(spark, f"{scratch}/none_partials").count() == 0
    os.makedirs(f"{scratch}/kept_partials")
    with pytest.raises(ValueError):
        ST_.ingest_content(spark, f"{scratch}/none", f"{scratch}/kept_partials", f"{scratch}/lost_ckpt")
