"""W-38: the whole daily run in one session.

raw logs -> two profiles (written) -> fact + dimensions (loaded) -> six
reports (published).  Every stage reads the previous stage's written tables,
so lineage stays short and a lost executor only recomputes one stage.  The
dictionary refresh (W-09..W-12) is a separate job, off the critical path.

A run log in the warehouse folder holds each finished stage with a fingerprint of its inputs (names, sizes
and times of files, and the parameters).  A run that is started again after a failure
reuses the stages that its predecessor finished; a changed input has another fingerprint, and its stages are built anew.
"""

from __future__ import annotations

import datetime as _dt
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from viewpulse.operators import keywords as K
from viewpulse.operators import reports as R
from viewpulse.operators import star as ST
from viewpulse.plans.classifier import Classifier, classify_open
from viewpulse.plans.dimensions import upsert_dimension
from viewpulse.plans.partials import live_days, refresh_partials
from viewpulse.plans.profiles import build_content_profile, build_search_profile, search_pairs
from viewpulse.plans.runlog import RunLog
from viewpulse.plans.warehouse import load_table, publish, register_table
from viewpulse.session import shared_dir
from viewpulse.sources import dictionary as D
from viewpulse.sources import logs as L
from viewpulse.sources.checked import keep_good, read_content_log_checked, read_search_log_checked
from viewpulse.sources.files import fingerprint, path_exists

REPORTS = list(R.REPORT_ORDER)


#: Part of every fingerprint: a stage written by another form of the code is built anew.
FORMAT = "3"


@dataclass
class RunResult:
    start: object
    end: object
    snapshot_date_key: int
    tables: dict


def _month_end(d: _dt.date) -> _dt.date:
    nxt = (d.replace(day=28) + _dt.timedelta(days=4)).replace(day=1)
    return nxt - _dt.timedelta(days=1)


def _concurrently(jobs, max_workers: int = 8) -> list:
    """Submit independent Spark jobs from driver threads; they share the executors.

    Errors are re-raised after all jobs finished.
    """
    with ThreadPoolExecutor(max_workers=min(max_workers, len(jobs))) as pool:
        futures = [pool.submit(j) for j in jobs]
        return [f.result() for f in futures]


@dataclass
class _Inputs:
    """The two profiles of a run: fingerprints of what they are built from, and how to build them."""

    search_print: str
    content_print: str
    search: Callable[[], DataFrame]
    content: Callable[[], DataFrame]


def _batch_inputs(spark, search_root, content_root, kmap_path, start, end, layout, quarantine: str | None) -> _Inputs:
    kmap_files = [kmap_path] if path_exists(spark, kmap_path) else []
    search_files, content_files = (L.day_paths(spark, root, start, end, kind, layout) for root, kind in ((search_root, "search"), (content_root, "content")))

    def search():
        if quarantine:
            log = keep_good(read_search_log_checked(spark, search_root, start, end, layout), f"{quarantine}/search")
        else:
            log = L.read_search_log(spark, search_root, start, end, layout)
        return build_search_profile(log, D.read_keyword_map(spark, kmap_path), end, start, with_device=True)

    def content():
        if quarantine:
            log = keep_good(read_content_log_checked(spark, content_root, start, end, layout), f"{quarantine}/content")
        else:
            log = L.read_content_log(spark, content_root, start, end, layout)
        return build_content_profile(log, start, end)

    return _Inputs(fingerprint(spark, [*search_files, *kmap_files], FORMAT, start, end, layout, bool(quarantine)),
                   fingerprint(spark, content_files, FORMAT, start, end, layout, bool(quarantine)), search, content)


def _incremental_inputs(spark, search_root, content_root, kmap_path, start, end, layout, folder: str) -> _Inputs:
    from viewpulse import streaming as ST_

    paths = {kind: (f"{folder}/{kind}_partials", f"{folder}/{kind}_ckpt") for kind in ("search", "content")}
    _concurrently([
        lambda: ST_.ingest_search(spark, search_root, *paths["search"], layout).awaitTermination(),
        lambda: ST_.ingest_content(spark, content_root, *paths["content"], layout).awaitTermination(),
    ])
    there = lambda path: [path] if path_exists(spark, path) else []
    return _Inputs(
        fingerprint(spark, there(paths["search"][0]) + there(kmap_path), FORMAT, start, end),
        fingerprint(spark, there(paths["content"][0]), FORMAT, start, end),
        lambda: ST_.search_profile_from_partials(spark, paths["search"][0], D.read_keyword_map(spark, kmap_path), end, start),
        lambda: ST_.content_profile_from_partials(spark, paths["content"][0], start, end))


def _day_inputs(spark, search_root, content_root, kmap_path, start, end, layout, folder: str) -> _Inputs:
    """As ``_incremental_inputs``, from partials that follow changed files."""
    from viewpulse import streaming as ST_

    paths = {kind: f"{folder}/{kind}_days" for kind in ("search", "content")}
    _concurrently([lambda: refresh_partials(spark, search_root, paths["search"], "search", layout, start, end),
                   lambda: refresh_partials(spark, content_root, paths["content"], "content", layout, start, end)])
    days = {kind: live_days(spark, path) for kind, path in paths.items()}
    there = lambda path: [path] if path_exists(spark, path) else []
    return _Inputs(
        fingerprint(spark, there(f"{paths['search']}/days") + there(kmap_path), FORMAT, start, end),
        fingerprint(spark, there(f"{paths['content']}/days"), FORMAT, start, end),
        lambda: ST_.search_profile_from_partials(spark, f"{paths['search']}/rows", D.read_keyword_map(spark, kmap_path), end, start, days=days["search"]),
        lambda: ST_.content_profile_from_partials(spark, f"{paths['content']}/rows", start, end, days=days["content"]))


def run_snapshot(
    spark: SparkSession,
    search_root: str,
    content_root: str,
    keyword_map_path: str,
    out: str,
    start=None,
    end=None,
    layout: str = "daily",
    stage_dir: str | None = None,
    incremental_dir: str | None = None,
    database: str | None = None,
    include_both: bool = False,
    load_mode: str = "append",
    resume: bool = True,
    quarantine_dir: str | None = None,
    dim_buckets: int = 16,
    incremental_mode: str = "stream",
) -> RunResult | None:
    """Build and load one snapshot; returns None when no log day exists.

    ``out`` is the warehouse folder: ``fact_customer_360`` (partitioned by
    snapshot key), ``dim_user``, ``dim_cust`` and ``dim_date`` (upserted by key, so that older snapshots
    keep their rows), ``dim_service``, the six ``olap_*`` report tables (a new folder each run; ``current_tables`` names it) and
    ``run_log``.  ``stage_dir`` holds the written
    profiles that cut the lineage (default: the session's shared checkpoint
    folder, ``spark.checkpoint.dir``).

    With ``resume`` stages that an earlier run finished from the same inputs are reused.

    With ``incremental_dir`` the raw logs are not re-read: new files are
    ingested once by the streams of ``viewpulse.streaming`` (state and
    partials under that folder) and both profiles are built from the
    partials, with the same result.  The mode "stream" takes it that files never change once they are there;
    "days" finds days whose files changed or vanished and builds their partials again.

    With ``quarantine_dir`` unreadable files and corrupt rows are written there instead of failing the run.

    With ``database`` every output is also registered as a catalog table
    ``database.<name>`` (external parquet at the same path).  ``include_both``
    makes the reports count profiles seen in both logs as well.  ``dim_buckets`` is the number of partitions of
    a new user or customer dimension.  ``load_mode`` "replace" keeps only this snapshot in the fact, "append" keeps the history.
    """
    window = L.resolve_window(spark, search_root, content_root, start, end, layout)
    if window is None:
        return None
    start, end = window
    if load_mode not in ("append", "replace"):
        raise ValueError(f"load_mode must be 'append' or 'replace', not {load_mode!r}")
    key = ST.snapshot_key(end)
    out = out.rstrip("/")
    stage = (stage_dir or f"{shared_dir(spark).rstrip('/')}/viewpulse-stage").rstrip("/")
    log = RunLog(spark, f"{out}/run_log", f"{key}-{uuid.uuid4().hex[:12]}", key, resume)
    where = (search_root, content_root, keyword_map_path, start, end, layout)
    if incremental_dir:
        inputs = {"stream": _incremental_inputs, "days": _day_inputs}[incremental_mode](spark, *where, incremental_dir.rstrip("/"))
    else:
        inputs = _batch_inputs(spark, *where, quarantine_dir)

    # Stage 1: the two profiles (independent jobs, run concurrently), written.
    search, content = _concurrently([
        lambda: log.table("search_profile", inputs.search_print, inputs.search, stage),
        lambda: log.table("content_profile", inputs.content_print, inputs.content, stage),
    ])

    # Stage 2: fact (history kept per snapshot) and the four dimensions.
    loaded = f"{inputs.search_print}-{inputs.content_print}-{load_mode}"
    names = ("fact_customer_360", "dim_user", "dim_cust", "dim_date", "dim_service")
    paths = {n: f"{out}/{n}" for n in names}
    dim_service = ST.dim_service(spark)

    def qualified(name: str) -> str | None:
        return f"{database}.{name}" if database else None

    def load_fact():
        fact = ST.build_fact(ST.build_obt(search, content), dim_service, key)
        # Sorted by source inside each task (no shuffle): the reports filter on
        # data_source, and parquet row-group statistics then skip the other sources.
        load_table(fact.sortWithinPartitions("data_source"), paths["fact_customer_360"], load_mode, table=qualified("fact_customer_360"))

    def load_dim(name: str, rows: DataFrame, key_col: str, buckets: int):
        # staged changes are good only for the table that they were found against: the last load of any snapshot names it
        upsert_dimension(rows, paths[name], log, f"{loaded}-{log.last_micros.get(f'load:{name}', 0)}", stage, key_col, buckets)

    # The profiles are written tables keyed by user/contract: no dedupe shuffle.
    _concurrently([
        # in "replace" mode another snapshot's run may have taken this one away since
        lambda: log.step("load:fact_customer_360", loaded, load_fact, f"{paths['fact_customer_360']}/snapshot_date_key={key}") if load_mode == "append" else load_fact(),
        lambda: log.step("load:dim_user", loaded, lambda: load_dim("dim_user", ST.dim_user(search, assume_unique=True), "Profile_ID", dim_buckets), stage),
        lambda: log.step("load:dim_cust", loaded, lambda: load_dim("dim_cust", ST.dim_cust(content, assume_unique=True), "Profile_ID", dim_buckets), stage),
        lambda: log.step("load:dim_date", loaded, lambda: load_dim("dim_date", ST.dim_date(spark, start, _month_end(end)), "date_key", 1), stage),
        lambda: load_table(dim_service, paths["dim_service"], "replace", skip_empty=False, table=qualified("dim_service")),
    ])
    # a log without any profile has no user or customer dimension
    tables = {n: p for n, p in paths.items() if n not in ("dim_user", "dim_cust") or path_exists(spark, p)}
    for name in ("dim_user", "dim_cust", "dim_date") if database else ():
        if name in tables:
            register_table(spark, qualified(name), tables[name])

    # Stage 3: the six reports over the loaded fact, each published as a new version.
    reports = R.all_reports(spark.read.parquet(tables["fact_customer_360"]), spark.read.parquet(tables["dim_service"]), include_both)
    versions = _concurrently([lambda n=n, df=df: publish(df, f"{out}/{n}", log.run_id, qualified(n)) for n, df in reports.items()])
    log.record(*[(f"publish:{n}", loaded, path) for n, path in zip(reports, versions)])
    return RunResult(start, end, key, tables | dict(zip(reports, versions)))


def refresh_keyword_map(
    spark: SparkSession,
    search_log: DataFrame,
    end,
    old_map_path: str,
    new_map_path: str,
    start=None,
    classifier: Classifier | None = None,
    ledger_dir: str | None = None,
    **how,
) -> DataFrame:
    """W-11, W-12 as a job: classify every keyword that the dictionary lacks, merge into a new dictionary version.

    With a ``classifier`` its answers are kept in ``ledger_dir`` and keywords without an answer stay out of the
    dictionary, so that the next refresh asks again (``how``: see ``classifier.ask``).
    """
    known = D.read_keyword_map(spark, old_map_path)
    path = f"{shared_dir(spark).rstrip('/')}/viewpulse-stage/new-keywords-{uuid.uuid4().hex}"
    K.new_keywords(search_pairs(search_log, end, start), known).write.parquet(path)
    found = classify_open(spark.read.parquet(path), classifier, ledger_dir, **how)
    D.write_keyword_map(K.merge_map(known, found.where("category IS NOT NULL")), new_map_path)
    return D.read_keyword_map(spark, new_map_path)


__all__ = ["run_snapshot", "refresh_keyword_map", "REPORTS"]
