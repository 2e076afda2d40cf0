"""viewpulse: audience analytics for online TV as plain Spark DataFrame operators.

Search logs and viewing logs go in; per-user search profiles, per-contract
viewing profiles, a star schema (one fact, four dimensions) and six marketing
reports come out.  Every operator is ``DataFrame -> DataFrame`` with a fixed
schema and a deterministic answer; no rows of data are collected to the driver.

Main entry points::

    from viewpulse import (read_search_log, read_content_log, build_search_profile,
                           build_content_profile, build_obt, build_fact, all_reports, run_snapshot)
"""

from viewpulse.operators.reports import all_reports, content_reports, search_reports
from viewpulse.operators.star import build_fact, build_obt, dim_cust, dim_date, dim_service, dim_user
from viewpulse.plans.daily_run import refresh_keyword_map, run_snapshot
from viewpulse.plans.dimensions import read_dimension, upsert_dimension
from viewpulse.plans.profiles import build_content_profile, build_search_profile
from viewpulse.plans.runlog import current_tables
from viewpulse.plans.warehouse import load_table, publish, register_views
from viewpulse.sources.checked import quarantine_counts, read_content_envelope, read_content_log_checked, read_search_log_checked
from viewpulse.sources.dictionary import read_keyword_map, write_keyword_map
from viewpulse.sources.logs import latest_date, read_content_log, read_search_log, resolve_window

__all__ = [
    "all_reports",
    "build_content_profile",
    "build_fact",
    "build_obt",
    "build_search_profile",
    "content_reports",
    "current_tables",
    "dim_cust",
    "dim_date",
    "dim_service",
    "dim_user",
    "latest_date",
    "load_table",
    "publish",
    "quarantine_counts",
    "read_content_envelope",
    "read_content_log",
    "read_content_log_checked",
    "read_dimension",
    "read_keyword_map",
    "read_search_log",
    "read_search_log_checked",
    "refresh_keyword_map",
    "register_views",
    "resolve_window",
    "run_snapshot",
    "search_reports",
    "upsert_dimension",
    "write_keyword_map",
]
