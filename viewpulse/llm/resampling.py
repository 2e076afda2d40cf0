"""Quality by importance resampling on hashed n-grams (operator 1).

Two generative models, bags of hashed words and word pairs, are estimated: one from
target texts (labelled as good), one from all raw texts.  A document's log-weight is the sum of
log p_target - log p_raw over its n-grams.  Adding Gumbel noise to the log-weights and taking the k
largest samples k documents without replacement in proportion to their weights.

The raw model counts all documents; the target model learns from a bounded sample of labelled rows
(``target_rows``).  Both are vectors of ``buckets`` numbers.  The k-th largest key is found exactly by narrowing a
histogram, so nothing is sorted and only counts reach the driver.  The noise is
a hash of the id and a seed, so the sample is the same in every run.

Null texts are empty; empty texts have log-weight zero.  Rows that repeat, or tie at the k-th key, are
taken together, so that the sample may have some rows more than k.  Null ids share one noise.  Without target
rows all weights are zero and the sample is uniform.  Columns other than id and text are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from viewpulse.llm.common import cut, text_or_empty
from viewpulse.llm.slices import U, byte_table, mix, parts, slice_hashes, words


def ngram_buckets(own: list[bytes], buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """(bucket of each word and word pair, owner text of each)."""
    raw, starts, ends, count = words(own)
    if not len(starts):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    h = slice_hashes(raw, starts, ends, byte_table(1))
    owner = np.repeat(np.arange(len(own)), count)
    pair = mix(h[:-1] * U(3) + h[1:])
    inside = owner[:-1] == owner[1:]
    at = np.concatenate([h, pair[inside]]) % U(buckets)
    return at.astype(np.int64), np.concatenate([owner, owner[1:][inside]])


def fit(docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text", buckets: int = 1 << 16,
        target_rows: int = 16384) -> np.ndarray:
    """log p_target - log p_raw of each bucket; ``target`` holds the ids of good rows."""
    chosen = target.select(F.col(id_col).alias("id")).where("id is not null").distinct().orderBy(F.xxhash64("id"), "id").limit(target_rows)
    chosen = cut(chosen.withColumn("good", F.lit(True)), "resampling-target")
    base = docs.select(F.col(id_col).alias("id"), text_or_empty(text_col).alias("text"))
    marked = base.join(F.broadcast(chosen), "id", "left").select("text", F.coalesce("good", F.lit(False)).alias("good"))

    def count(batches):
        found = np.zeros((2, buckets), np.int64)
        for b in batches:
            good = np.array(b.column(1).to_pylist(), bool)
            for at, own in parts(b.column(0).to_pylist()):
                bucket, owner = ngram_buckets(own, buckets)
                found[0] += np.bincount(bucket, minlength=buckets)
                found[1] += np.bincount(bucket[good[at][owner]], minlength=buckets)
        seen = np.flatnonzero(found[0])
        yield pa.RecordBatch.from_pydict({"bucket": seen.astype(np.int32), "raw": found[0][seen], "good": found[1][seen]})

    rows = marked.mapInArrow(count, "bucket int, raw long, good long")
    counts = np.zeros((2, buckets))
    for r in rows.groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("good").alias("good")).collect():  # at most ``buckets`` rows
        counts[0, r["bucket"]], counts[1, r["bucket"]] = r["raw"], r["good"]
    if not counts[1].any():
        return np.zeros(buckets)
    # the target model is smoothed towards the raw one, so that unseen buckets say little either way
    raw = (counts[0] + 1) / (counts[0].sum() + buckets)
    good = (counts[1] + buckets * raw) / (counts[1].sum() + buckets)
    return np.log(good) - np.log(raw)


def weigh(docs: DataFrame, ratio: np.ndarray, seed: int = 0, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, n_grams, log_weight, key``: the key is the log-weight with its Gumbel noise."""
    def run(batches):
        for b in batches:
            n, weight = np.zeros(b.num_rows, np.int64), np.zeros(b.num_rows)
            for at, own in parts(b.column(1).to_pylist()):
                bucket, owner = ngram_buckets(own, len(ratio))
                n[at] = np.bincount(owner, minlength=len(own))
                weight[at] = np.bincount(owner, ratio[bucket], len(own))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n), pa.array(weight)], names=["id", "n_grams", "log_weight"])

    schema = T.StructType([T.StructField("id", docs.schema[id_col].dataType), T.StructField("n_grams", T.LongType()), T.StructField("log_weight", T.DoubleType())])
    base = docs.select(F.col(id_col).alias("id"), text_or_empty(text_col).alias("text")).mapInArrow(run, schema)
    uniform = (F.shiftrightunsigned(F.xxhash64("id", F.lit(seed)), 11) + 0.5) / float(1 << 53)
    return base.withColumn("key", F.col("log_weight") - F.log(-F.log(uniform))).withColumnRenamed("id", id_col)


def kth_largest(df: DataFrame, col: str, k: int, bins: int = 4096) -> float | None:
    """The k-th largest value of a finite double column, exactly, by histograms of ever narrower ranges."""
    low, high, n = df.agg(F.min(col), F.max(col), F.count(col)).first()
    if not n or k <= 0:
        return None
    if k >= n:
        return low
    while low < high:
        width = (high - low) / bins
        if width <= 0 or low + width == low:
            break
        inside = df.where((F.col(col) >= low) & (F.col(col) <= high))
        slot = F.least(F.floor((F.col(col) - low) / width), F.lit(bins - 1)).cast("int")
        rows = inside.groupBy(slot.alias("slot")).agg(F.count("*").alias("n"), F.min(col).alias("lo"), F.max(col).alias("hi")).collect()
        for r in sorted(rows, key=lambda r: -r["slot"]):
            if k <= r["n"]:
                if len(rows) == 1 and (r["lo"], r["hi"]) == (low, high) and r["n"] > bins:
                    return _kth_value(inside, col, k)
                low, high = r["lo"], r["hi"]
                break
            k -= r["n"]
    return high if k <= 1 or low == high else _kth_value(df.where((F.col(col) >= low) & (F.col(col) <= high)), col, k)


def _kth_value(df: DataFrame, col: str, k: int) -> float:
    """By counts of distinct values, for a range too narrow to cut."""
    for r in df.groupBy(col).count().orderBy(F.desc(col)).toLocalIterator():
        if k <= r["count"]:
            return r[col]
        k -= r["count"]
    raise ValueError("fewer than k values")


def sample(docs: DataFrame, labels: DataFrame, share: float | None = None, label_col: str = "quality", seed: int = 0,
           id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The sampled rows of ``docs``: ``id, n_grams, log_weight, key, kept`` (true).

    ``share`` of all rows is taken; by default the share of good rows among labelled ones.
    """
    known = labels.where(F.col(label_col).isin(0, 1))
    ratio = fit(docs, known.where(F.col(label_col) == 1), id_col, text_col)
    weighed = cut(weigh(docs, ratio, seed, id_col, text_col), "resampling-keys")
    if share is None:
        share = known.agg(F.avg(label_col)).first()[0]
        share = 1.0 if share is None else share
    least = kth_largest(weighed, "key", round(share * weighed.count()))
    kept = weighed.where(F.col("key") >= least) if least is not None else weighed.limit(0)
    return kept.withColumn("kept", F.lit(True))
