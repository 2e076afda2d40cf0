"""Operator 12 against a plain version in Python."""

import hashlib
import math
import re
import zlib

import numpy as np
import pyarrow as pa
from edge import ROWS, docs, empty
from pyspark.sql import functions as F

from viewpulse.llm import queries, target_sampling
from viewpulse.llm.regular_sort import exact_ranks

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def buckets_of(text, buckets=10_000):
    return [zlib.crc32(w.encode()) % buckets for w in WORD.findall((text or "").translate(LOWER))]


def brute(rows, target, percent=10, min_words=20, buckets=10_000):
    own = [(i, buckets_of(t, buckets)) for i, t, *_ in rows]
    s, t = np.zeros(buckets, int), np.zeros(buckets, int)
    for counts, texts in ((s, [b for _, b in own]), (t, [buckets_of(x, buckets) for x in target])):
        for b in texts:
            np.add.at(counts, b, 1)
    gain = [math.floor(1000 * math.log(int(y + 1) * int(s.sum() + buckets) / (int(x + 1) * int(t.sum() + buckets)))) for x, y in zip(s, t)]
    scored = []
    for i, b in own:
        h = int(hashlib.sha256(f"2024:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[k] for k in b)
        scored.append((i, len(b), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))))
    long_enough = sorted((r for r in scored if r[1] >= min_words), key=lambda r: (-r[3], r[0] is None, r[0] or 0, r[1]))
    drawn = long_enough[: percent * len(long_enough) // 100]
    rest = long_enough[len(drawn) :] + [r for r in scored if r[1] < min_words]
    return [(*r, n + 1) for n, r in enumerate(drawn)] + [(*r, None) for r in rest]


def key(r):
    return tuple((x is None, x or 0) for x in r)


def same(got, want):
    assert sorted(map(tuple, got), key=key) == sorted(want, key=key)


def test_words_and_checksums():
    texts = ["", "A-b C_d", "É日本x1 ", "\x00\x7f`{~", "w" * 500 + " " + "é" * 300, "a", "a,", ",a", "ZZ9"]
    want = [(b, i) for i, t in enumerate(texts) for b in buckets_of(t)]
    for window in (1, 7, 64, 1 << 20):
        column = pa.array(["skipped", *texts]).slice(1)
        got = [(int(b), int(r)) for part in target_sampling.word_buckets(column, 10_000, window) for b, r in zip(*part)]
        assert got == want


def test_ranks_of_ties_and_hot_keys(spark):
    df = spark.range(0, 20000, 1, 8).select((F.xxhash64("id") % 7).alias("a"), F.when(F.col("id") % 3 == 0, 5).otherwise(F.col("id") % 11).cast("long").alias("b"))
    out = exact_ranks(df, ["a", "b"], segment_rows=500, gather=900)  # the samples are ranked in turn
    rows = sorted(tuple(r) for r in out.select("_rank", "a", "b").collect())
    assert [r[0] for r in rows] == list(range(1, 20001))
    assert [r[1:] for r in rows] == sorted((r.a, r.b) for r in df.collect())
    assert max(r["count"] for r in out.groupBy(F.spark_partition_id()).count().collect()) < 1500  # a key holds a third of all rows
    assert exact_ranks(df.limit(0), ["a", "b"]).count() == 0
    equal = exact_ranks(spark.range(1000).select(F.lit(1).cast("long").alias("a")), ["a"], segment_rows=100)
    assert sorted(r[0] for r in equal.select("_rank").collect()) == list(range(1, 1001))


def test_equals_the_plain_version(spark):
    rows = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()
    target = [r.text for r in spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet").collect()]
    rows = [tuple(r) for r in rows] + [(i, t) for i, t, *_ in ROWS]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    goal = spark.createDataFrame([(t,) for t in [*target, None, ""]], "text string")
    for percent, words in ((10, 20), (60, 1)):
        got = target_sampling.sample(df, goal, percent=percent, min_words=words, segment_rows=23).select("doc_id", "n_features", "weight", "score", "rank")
        same(got.collect(), brute(rows, target, percent, words))


def test_awkward_rows(spark):
    goal = spark.createDataFrame([("the quick fox",)], "text string")
    got = target_sampling.sample(docs(spark), goal, percent=50, min_words=1).collect()
    same(got, brute(ROWS, ["the quick fox"], 50, 1))
    assert target_sampling.sample(empty(spark), goal).collect() == []
    nothing = target_sampling.sample(docs(spark), goal.limit(0), percent=100, min_words=0).collect()
    same(nothing, brute(ROWS, [], 100, 0))


def test_registered_query(spark):
    got = queries.op12_target_resampling(spark, "/root/testdata/sf0.001")
    assert set(got.dtypes) == {(c, "bigint") for c in ("doc_id", "n_features", "weight", "score", "rank")}
    rows = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()]
    target = [r.text for r in spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet").collect()]
    same(got.select("doc_id", "n_features", "weight", "score", "rank").collect(), brute(rows, target))
