"""Summarise the physical plan of every registered query (shuffles, joins, aggregates).

Usage: python tests/plan_summary.py [sf_dir]  -> a markdown table on stdout.
"""

from __future__ import annotations

import contextlib
import io
import os
import re
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


def summarise(df) -> dict:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode="formatted")
    tree = buf.getvalue().split("\n\n")[0]
    nodes = [re.sub(r"\s*\(\d+\)$", "", ln.strip(" :+-*")) for ln in tree.splitlines()[1:]]
    ex = [n for n in nodes if n.startswith("Exchange")]
    return {
        "shuffles": len(ex),
        "broadcasts": sum(1 for n in nodes if n.startswith("BroadcastExchange")),
        "joins": sorted({n for n in nodes if "Join" in n}),
        "aggs": sorted({n.split()[0] for n in nodes if n.endswith("Aggregate")}),
        "window": any(n.startswith("Window") for n in nodes),
    }


def operator_frames(spark, sf: str) -> dict:
    """The operators over staged raw-log files and a written fact, as in production."""
    from viewpulse import registry as RG
    from viewpulse.operators import content as C
    from viewpulse.operators import keywords as K
    from viewpulse.operators import reports as R
    from viewpulse.operators import search as Q
    from viewpulse.operators import star as ST
    from viewpulse.plans import profiles as P
    from viewpulse.sources import dictionary as D
    from viewpulse.sources import logs as L
    from viewpulse.sources import testdata as TD

    root = L.stage_logs(spark, sf)
    D.write_keyword_map(TD.keyword_map(spark, sf), f"{root}/mapping")
    start, end = RG.START, RG.END
    slog = L.read_search_log(spark, f"{root}/log_search", start, end, layout="hive")
    clog = L.read_content_log(spark, f"{root}/log_content", start, end, layout="hive")
    kmap = D.read_keyword_map(spark, f"{root}/mapping")
    sp = P.build_search_profile(slog, kmap, end, start, with_device=True)
    cp = P.build_content_profile(clog, start, end)
    fact = ST.build_fact(ST.build_obt(sp, cp), ST.dim_service(spark), RG.SNAPSHOT)
    fact.write.mode("overwrite").partitionBy("snapshot_date_key").parquet(f"{root}/plan_fact")
    ft = spark.read.parquet(f"{root}/plan_fact")
    dim = ST.dim_service(spark)
    pairs = P.search_pairs(slog, end, start)
    return {
        "scan_search_log": slog,
        "scan_content_log": clog,
        "clean_search_log + split_months": Q.with_period(Q.clean_search(slog), end),
        "user_keyword_counts": Q.keyword_counts(Q.with_period(Q.clean_search(slog), end)),
        "prev_curr_keywords (fused W-04..W-08)": pairs,
        "keyword_page": Q.page_keywords(pairs),
        "merge_keyword_map": K.merge_map(kmap, K.classify(Q.page_keywords(pairs))),
        "search_profile (+device)": sp,
        "content_daily_pivot": C.daily_pivot(C.with_type(clog)),
        "active_days": C.with_activity(C.daily_profile(clog)),
        "content_profile": cp,
        "fact (obt + service key)": fact,
        "dim_user": ST.dim_user(sp),
        "report_window": R.report_window(ft),
        "olap_category_loyalty": R.category_loyalty(ft, dim),
        "olap_category_taste": R.category_taste(ft, dim),
        "olap_power_vs_casual": R.power_vs_casual(ft, dim),
        "olap_taste_diversity": R.taste_diversity(ft),
        "olap_search_growth": R.search_growth(ft),
        "olap_interest_migration": R.interest_migration(ft),
    }


if __name__ == "__main__":
    from viewpulse.session import local_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = local_session(8)
    spark.sparkContext.setLogLevel("ERROR")
    print("| operator | shuffles | broadcasts | joins | aggregates | window |")
    print("|---|---|---|---|---|---|")
    for name, df in operator_frames(spark, sf).items():
        s = summarise(df)
        print(f"| {name} | {s['shuffles']} | {s['broadcasts']} | {', '.join(s['joins']) or '-'} | "
              f"{', '.join(s['aggs']) or '-'} | {'yes' if s['window'] else '-'} |", flush=True)
