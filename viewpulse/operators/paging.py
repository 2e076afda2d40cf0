"""A page of a long ranking at any offset.

``orderBy().offset().limit()`` keeps ``offset + limit`` rows in each task and in the last one, which is good for
shallow pages only.  Here the rows are dealt into ranges of the order and written, one count a range
says where each begins, and only the ranges that the page touches are sorted.  No task holds more than a range,
which Spark sorts with spilling.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from viewpulse.session import shared_dir

RANGE, RANK = "_range", "_rank"


def page(df: DataFrame, order: list[Column], offset: int, limit: int, rows_per_range: int = 1_000_000, n_rows: int | None = None) -> DataFrame:
    """Rows ``offset`` to ``offset + limit`` of ``df`` in ``order``, with ``_rank`` (from 0).

    The order must be total for the page to be the same each time.  Rows that tie on all of ``order`` stay in one range.
    """
    n = df.count() if n_rows is None else n_rows
    ranges = max(1, -(-n // rows_per_range))
    path = f"{shared_dir(df.sparkSession).rstrip('/')}/viewpulse-stage/page-{uuid.uuid4().hex}"
    dealt = df.repartitionByRange(ranges, *order).withColumn(RANGE, F.spark_partition_id())
    dealt.write.partitionBy(RANGE).parquet(path)
    written = df.sparkSession.read.schema(dealt.schema).parquet(path)
    sizes = written.groupBy(RANGE).agg(F.count("*").alias("n"))
    starts, touched = [], 0
    for r in sorted(sizes.collect()):  # a row a range
        if touched < offset + limit and touched + r["n"] > offset:
            starts.append((r[RANGE], touched))
        touched += r["n"]
    if not starts or limit <= 0:
        return written.limit(0).withColumn(RANK, F.lit(0).cast("long")).drop(RANGE)
    before = F.element_at(F.create_map(*[F.lit(x) for s in starts for x in s]), F.col(RANGE))
    own = written.where(F.col(RANGE).isin([r for r, _ in starts]))  # prunes the other ranges' folders
    ranked = own.withColumn(RANK, (before + F.row_number().over(Window.partitionBy(RANGE).orderBy(*order)) - 1).cast("long"))
    return ranked.where((F.col(RANK) >= offset) & (F.col(RANK) < offset + limit)).drop(RANGE)
