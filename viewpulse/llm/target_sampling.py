"""Importance resampling towards a target distribution, with exact ranks (operator 12).

Words are hashed into buckets (their CRC-32).  A bucket's gain says how much more often
the target texts use it than all documents do; a document's weight is the sum of the gains of its words, its
score the weight plus Gumbel noise drawn from its id.  Of the documents that are long enough the
``percent`` best are drawn, in the order of ``regular_sort``.

Weights are computed on byte arrays, whole Arrow batches at a time, in windows of bounded size: a very long
text is read in several windows, cut between words.  All documents and all target texts are counted.

Null texts have no words.  A null id has the noise of an empty one.  Ties of score go to the smaller id (nulls last), then to
fewer words; rows that tie even there are equal in all returned columns and are ranked one after the other.  Repeated rows are documents of their
own.  Without target texts, or without documents, gains come from the additive terms alone; an empty table gives an
empty result.  Columns other than id and text are ignored, whatever their names.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from viewpulse.llm.common import cut, text_or_empty
from viewpulse.llm.regular_sort import RANK, exact_ranks


def _crc_table() -> np.ndarray:
    """The CRC-32 of each byte alone, by its reversed polynomial."""
    c = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        c = (c >> np.uint32(1)) ^ (np.uint32(0xEDB88320) * (c & np.uint32(1)))
    return c


def _tables() -> tuple[np.ndarray, np.ndarray]:
    """(whether a byte belongs to a word, the byte with A-Z in lower case)."""
    at = np.arange(256)
    upper = (at >= ord("A")) & (at <= ord("Z"))
    word = upper | ((at >= ord("a")) & (at <= ord("z"))) | ((at >= ord("0")) & (at <= ord("9"))) | (at >= 128)
    return word, np.where(upper, at + 32, at).astype(np.uint8)


def crc32_of_slices(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray, short: int = 48) -> np.ndarray:
    """CRC-32 of each ``raw[starts[i]:ends[i]]``: one array step for each place in the slices, long slices one by one."""
    length = ends - starts
    order = np.argsort(-np.minimum(length, short + 1), kind="stable")
    sizes = length[order]
    n_long = int(np.count_nonzero(sizes > short))
    crc = np.full(len(starts), 0xFFFFFFFF, np.uint32)
    table, ascending = _crc_table(), -sizes[n_long:]
    own, at = crc[n_long:], starts[order][n_long:]
    for p in range(int(sizes[n_long]) if n_long < len(sizes) else 0):
        k = int(np.searchsorted(ascending, -p, "left"))  # slices longer than p
        own[:k] = table[(own[:k] ^ raw[at[:k] + p]) & np.uint32(255)] ^ (own[:k] >> np.uint32(8))
    crc = ~crc
    for i in range(n_long):
        crc[i] = zlib.crc32(raw[starts[order[i]] : ends[order[i]]])
    out = np.empty_like(crc)
    out[order] = crc
    return out


def _buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a column of strings without nulls."""
    column = column.cast(pa.large_string())
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


def word_buckets(column: pa.Array, buckets: int, window: int = 1 << 21) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(bucket, row) of each word of a column of texts, one window of bytes at a time."""
    if not len(column):
        return
    is_word, lower = _tables()
    raw, offsets = _buffers(column)
    limits = offsets[1:-1]  # where one text ends and the next begins
    at = 0
    while at < len(raw):
        end = min(at + window, len(raw))
        while end < len(raw) and is_word[raw[end - 1]] and is_word[raw[end]]:  # to the end of a word
            more = raw[end : end + window]
            gap = np.flatnonzero(~is_word[more])
            end += int(gap[0]) if len(gap) else len(more)
        part = raw[at:end]
        inside = limits[np.searchsorted(limits, at, "right") : np.searchsorted(limits, end, "left")] - at
        word = is_word[part]
        first, last = word.copy(), word.copy()
        first[1:] &= ~word[:-1]
        last[:-1] &= ~word[1:]
        first[inside] = word[inside]
        last[inside - 1] = word[inside - 1]
        starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
        bucket = crc32_of_slices(lower[part], starts, ends) % np.uint32(buckets)
        yield bucket.astype(np.int64), np.searchsorted(offsets, starts + at, "right") - 1
        at = end


def bucket_counts(texts: DataFrame, text_col: str, buckets: int) -> np.ndarray:
    """Words of all texts by bucket; each task sends at most ``buckets`` counts."""
    def count(batches):
        found = np.zeros(buckets, np.int64)
        for b in batches:
            for bucket, _ in word_buckets(b.column(0), buckets):
                found += np.bincount(bucket, minlength=buckets)
        seen = np.flatnonzero(found)
        yield pa.RecordBatch.from_pydict({"bucket": seen.astype(np.int32), "n": found[seen]})

    rows = texts.select(text_or_empty(text_col).alias("text")).mapInArrow(count, "bucket int, n long")
    counts = np.zeros(buckets, np.int64)
    for r in rows.groupBy("bucket").agg(F.sum("n").alias("n")).collect():  # at most ``buckets`` rows
        counts[r["bucket"]] = r["n"]
    return counts


def gains(raw: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 ln) of the smoothed share of each bucket in the target over that in all documents."""
    raw_total, target_total, buckets = int(raw.sum()), int(target.sum()), len(raw)
    return np.array([math.floor(1000 * math.log((int(t) + 1) * (raw_total + buckets) / ((int(s) + 1) * (target_total + buckets))))
                     for s, t in zip(raw, target)], np.int64)


def weigh(docs: DataFrame, gain: np.ndarray, seed: int = 2024, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, n_features, weight, score`` of every document."""
    def run(batches):
        for b in batches:
            n, weight = np.zeros(b.num_rows, np.int64), np.zeros(b.num_rows)
            for bucket, row in word_buckets(b.column(1), len(gain)):
                n += np.bincount(row, minlength=b.num_rows)
                weight += np.bincount(row, gain[bucket], b.num_rows)  # whole numbers, exact in doubles
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n), pa.array(weight.astype(np.int64))], names=[id_col, "n_features", "weight"])

    schema = T.StructType([T.StructField(id_col, docs.schema[id_col].dataType), T.StructField("n_features", T.LongType()), T.StructField("weight", T.LongType())])
    base = docs.select(F.col(id_col).alias("id"), text_or_empty(text_col).alias("text")).mapInArrow(run, schema)
    drawn = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit(""))), 256)
    h = F.conv(F.substring(drawn, 1, 8), 16, 10).cast("long")
    noise = F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0)))
    return base.withColumn("score", F.col("weight") + noise)


def sample(docs: DataFrame, target: DataFrame, percent: int = 10, min_words: int = 20, buckets: int = 10_000, seed: int = 2024,
           id_col: str = "doc_id", text_col: str = "text", target_col: str = "text", segment_rows: int = 1_000_000) -> DataFrame:
    """Every document's ``id, n_features, weight, score, rank``; rank is null where the document isn't drawn.

    ``id`` is a whole number.  ``percent`` of the documents with ``min_words`` words or more are drawn (rounded down).
    """
    gain = gains(bucket_counts(docs, text_col, buckets), bucket_counts(target, target_col, buckets))
    weighed = cut(weigh(docs, gain, seed, id_col, text_col), "target-weights")
    columns = [id_col, "n_features", "weight", "score"]
    long_enough = F.col("n_features") >= min_words
    keys = {"_best": -F.col("score"), "_unnamed": F.col(id_col).isNull().cast("long"), "_id": F.coalesce(F.col(id_col).cast("long"), F.lit(0)),
            "_words": F.col("n_features")}
    candidates = weighed.where(long_enough).select(*columns, *[c.cast("long").alias(k) for k, c in keys.items()])
    n = weighed.where(long_enough).count()
    ranked = exact_ranks(candidates, list(keys), segment_rows)
    drawn = F.when(F.col(RANK) <= percent * n // 100, F.col(RANK)).alias("rank")
    return ranked.select(*columns, drawn).unionByName(weighed.where(~long_enough).select(*columns, F.lit(None).cast("long").alias("rank")))
