"""Exact ranks by parallel sorting with regular sampling.

Every task sorts its own rows into a run and writes it.  Each run gives samples at regular places;
regular places of the sorted samples are the splitters.  Rows between two
splitters form a segment; segments are exchanged, each goes to one task that merges it, and the sizes
of the segments before it are the rank of its first row.

No run or segment is held in memory: Spark sorts both, spilling where it must, and the ranks are
counted batch by batch.  Rows that tie on all keys are told apart by their run and place, so that
even equal rows spread over segments: none has more than ``rows / segments + rows / samples of a run``
rows.  The samples are ranked in the same way while they are many, so that the driver
gets ``gather`` rows at most, and one row a segment.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from viewpulse.llm.common import cut

RUN, PLACE, SEGMENT, RANK = "_run", "_place", "_segment", "_rank"


def _with(schema: T.StructType, *names: str) -> T.StructType:
    return T.StructType([*schema.fields, *[T.StructField(n, T.LongType()) for n in names]])


def sorted_runs(df: DataFrame, keys: list[str]) -> DataFrame:
    """``df`` written in sorted runs, one a task, with the run and the place of each row in it."""
    def number(batches):
        from pyspark import TaskContext

        run, place = TaskContext.get().partitionId(), 0
        for b in batches:
            at = np.arange(place, place + b.num_rows)
            place += b.num_rows
            yield b.append_column(RUN, pa.array(np.full(b.num_rows, run, np.int64))).append_column(PLACE, pa.array(at))

    return cut(df.sortWithinPartitions(*keys).mapInArrow(number, _with(df.schema, RUN, PLACE)), "sorted-runs")


def regular_samples(runs: DataFrame, order: list[str], samples: int) -> DataFrame:
    """The keys of ``samples`` rows at regular places of each run (all rows of a shorter one)."""
    # one row a run, which is a task that wrote a file
    length = runs.groupBy(RUN).agg(F.count("*").alias("_length"))
    slot = lambda place: F.floor(place * samples / F.col("_length"))
    first = (F.col(PLACE) == 0) | (slot(F.col(PLACE)) != slot(F.col(PLACE) - 1))
    return runs.select(*order).join(length, RUN).where(first).select(*order)


def _splitters(samples: DataFrame, order: list[str], segments: int, gather: int) -> list[tuple]:
    """``segments - 1`` rows at regular places of the sorted samples, which are ranked in the same way while they are many."""
    n = samples.count()
    if n <= gather:
        rows = samples.orderBy(*order).collect()
        return [tuple(rows[i]) for i in sorted({n * i // segments for i in range(1, segments)} - {0})]
    names = [f"_key{i}" for i in range(len(order))]
    ranked = exact_ranks(samples.toDF(*names), names, segment_rows=gather, gather=gather)
    slot = lambda place: F.floor(place * segments / n)
    chosen = ranked.where((F.col(RANK) > 1) & (slot(F.col(RANK) - 1) != slot(F.col(RANK) - 2)))
    return [tuple(r) for r in chosen.select(*names).orderBy(*names).collect()]


def _segments_of(batch: pa.RecordBatch, order: list[str], splitters: list[np.ndarray]) -> np.ndarray:
    """For each row the number of splitters that sort before it or equal it."""
    n = len(splitters[0])
    keys = [np.concatenate([s, np.asarray(batch.column(c))]) for c, s in zip(order, splitters)]
    merged = np.lexsort(keys[::-1])  # stable: a splitter precedes its equal
    own = merged >= n
    segment = np.empty(batch.num_rows, np.int64)
    segment[merged[own] - n] = np.cumsum(~own)[own]
    return segment


def exact_ranks(df: DataFrame, keys: list[str], segment_rows: int = 1_000_000, gather: int = 65_536) -> DataFrame:
    """``df`` with its run, place and ``_rank`` (from 1) in the ascending order of ``keys``, which are long columns without nulls."""
    order, runs = [*keys, RUN, PLACE], sorted_runs(df, keys)
    n, n_runs = runs.agg(F.count("*"), F.count_distinct(RUN)).first()
    segments = max(-(-n // segment_rows), min(df.sparkSession.sparkContext.defaultParallelism, n))
    splitters: list[tuple] = []
    if segments > 1:
        # samples of all runs are about a quarter of the rows at most, so that ranking them in turn comes to an end
        few = max(1, min(2 * segments, n // (4 * n_runs)))
        chosen = regular_samples(runs, order, few) if n > gather else runs.select(*order)
        splitters = _splitters(cut(chosen, "samples"), order, segments, gather)
    table = [np.array(c, np.int64) for c in zip(*splitters)] if splitters else [np.empty(0, np.int64)] * len(order)

    def assign(batches):
        for b in batches:
            yield b.append_column(SEGMENT, pa.array(_segments_of(b, order, table)))

    assigned = runs.mapInArrow(assign, _with(runs.schema, SEGMENT))
    sizes = {r[SEGMENT]: r["n"] for r in assigned.groupBy(SEGMENT).agg(F.count("*").alias("n")).collect()}
    before, total = {}, 0
    for s in sorted(sizes):
        before[s], total = total, total + sizes[s]

    def rank(batches):
        at, segment = 0, None
        for b in batches:
            own = np.asarray(b.column(SEGMENT))
            ranks = np.empty(len(own), np.int64)
            for lo, hi in zip(*_stretches(own)):
                if own[lo] != segment:
                    segment, at = own[lo], before[own[lo]]
                ranks[lo:hi] = np.arange(at + 1, at + 1 + hi - lo)
                at += hi - lo
            yield b.append_column(RANK, pa.array(ranks))

    merged = assigned.repartitionById(max(1, len(table[0]) + 1), F.col(SEGMENT).cast("int")).sortWithinPartitions(SEGMENT, *order)
    return merged.mapInArrow(rank, _with(assigned.schema, RANK)).drop(SEGMENT)


def _stretches(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(starts, ends) of stretches of equal values."""
    if not len(values):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    starts = np.flatnonzero(np.append(True, values[1:] != values[:-1]))
    return starts, np.append(starts[1:], len(values))
