"""Keywords put to a classifier outside of Spark, with a ledger of its answers (W-11).

The classifier is any callable from a list of keywords to ``keyword -> category``; it is slow, may cost money
and may fail.  So open keywords are cut into batches that depend on the keywords alone, and each batch has a digest.
A task that asks writes the answer to the ledger, under the batch's digest, before anything uses it: a task that is
run again, or a refresh that is started again after a failure, finds it there and doesn't ask twice.  (Two attempts of
one task that run at the same time may both ask.)

Calls go in rounds.  Each round asks every batch without an answer once, as far as the budget of
calls goes; batches whose call failed wait longer and longer before the next round.  What no answer names stays
open: it has no category, isn't merged, and is asked again by the next refresh.  ``Other`` is an answer like any other.
"""

from __future__ import annotations

import hashlib
import json
import time
import uuid
from collections.abc import Callable, Iterator, Mapping, Sequence

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from viewpulse import schemas as S
from viewpulse.operators import keywords as K
from viewpulse.session import shared_dir
from viewpulse.sources.files import file_system, path_exists

Classifier = Callable[[list[str]], Mapping[str, str]]

ANSWER_SCHEMA = "digest string, answers array<struct<keyword: string, category: string>>"


class Ledger:
    """A folder that all executors see, with one file for each answered batch."""

    def __init__(self, folder: str):
        self.folder = f"{folder.rstrip('/')}/answers"

    def _place(self, name: str):
        system, root = file_system(self.folder)
        return system, f"{root}/{name}"

    def has(self, digest: str) -> bool:
        from pyarrow import fs

        system, path = self._place(f"{digest}.json")
        return system.get_file_info(path).type != fs.FileType.NotFound

    def store(self, digest: str, answers: Mapping[str, str]) -> None:
        """Whole or not at all: written under another name and then renamed."""
        system, path = self._place(f"{digest}.json")
        system.create_dir(path.rsplit("/", 1)[0], recursive=True)
        _, draft = self._place(f"_{uuid.uuid4().hex}")  # Spark's readers pass over names with an underscore
        line = {"digest": digest, "answers": [{"keyword": str(k), "category": None if c is None else str(c)} for k, c in answers.items()]}
        with system.open_output_stream(draft) as f:
            f.write((json.dumps(line, ensure_ascii=False) + "\n").encode())
        system.move(draft, path)

    def answers(self, spark: SparkSession) -> DataFrame:
        if not path_exists(spark, self.folder):
            return spark.createDataFrame([], ANSWER_SCHEMA)
        return spark.read.schema(ANSWER_SCHEMA).json(self.folder)


def batches(keywords: DataFrame, size: int, version: str = "") -> DataFrame:
    """``digest, words``: the distinct keywords in batches of at most ``size``, the same for the same keywords.

    ``version`` names the classifier; answers of another version aren't reused.
    """
    distinct = keywords.select("keyword").where("keyword IS NOT NULL").distinct()
    n = max(1, -(-distinct.count() // size))

    def cut(frame: pd.DataFrame) -> pd.DataFrame:
        words = sorted(frame["keyword"])
        parts = [words[i : i + size] for i in range(0, len(words), size)]
        return pd.DataFrame({"digest": [hashlib.sha256("\n".join([version, *p]).encode()).hexdigest() for p in parts], "words": parts})

    grouped = distinct.withColumn("slot", F.pmod(F.xxhash64("keyword"), F.lit(n))).groupBy("slot")
    return grouped.applyInPandas(cut, "digest string, words array<string>")  # some ``size`` keywords a group


def _asking(classifier: Classifier, ledger: Ledger):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            called, errors = [], []
            for digest, words in zip(frame["digest"], frame["words"]):
                error, asked = None, not ledger.has(digest)
                if asked:
                    try:
                        ledger.store(digest, dict(classifier(list(words)) or {}))
                    except Exception as e:  # a failed call leaves its batch open
                        error = f"{type(e).__name__}: {e}"[:500]
                called.append(int(asked))
                errors.append(error)
            yield pd.DataFrame({"digest": frame["digest"], "called": called, "error": pd.Series(errors, dtype=object)})

    return run


def ask(keywords: DataFrame, classifier: Classifier, ledger_dir: str, batch: int = 100, call_budget: int | None = None,
        attempts: int = 3, backoff_seconds: float = 1.0, version: str = "", concurrency: int | None = None) -> DataFrame:
    """``keyword, category`` of the distinct keywords; the category is NULL where no answer names it.

    At most ``call_budget`` calls are made, ``concurrency`` at a time (default: one a core).  Names in
    answers are compared in lower case.
    """
    spark, ledger = keywords.sparkSession, Ledger(ledger_dir)
    path = f"{shared_dir(spark).rstrip('/')}/viewpulse-stage/batches-{uuid.uuid4().hex}"
    batches(keywords, batch, version).write.parquet(path)
    todo = spark.read.parquet(path)
    left = call_budget
    for attempt in range(attempts):
        open_batches = todo.join(ledger.answers(spark).select("digest"), "digest", "left_anti")
        if left is not None:
            open_batches = open_batches.orderBy("digest").limit(left)
        # calls are slow, so batches are spread over tasks one by one, whatever their bytes
        spread = open_batches.repartition(concurrency or max(1, spark.sparkContext.defaultParallelism), "digest")
        made = spread.mapInPandas(_asking(classifier, ledger), "digest string, called int, error string").agg(
            F.coalesce(F.sum("called"), F.lit(0)), F.count("error")).first()
        left = None if left is None else left - made[0]
        if not made[1] or left == 0:
            break
        if attempt + 1 < attempts:
            time.sleep(backoff_seconds * 2**attempt)
    answered = ledger.answers(spark).join(todo.select("digest"), "digest", "left_semi").select(F.inline("answers"))
    named = answered.groupBy(F.lower("keyword").alias("name")).agg(F.min("category").alias("category"))
    words = todo.select(F.explode("words").alias("keyword")).withColumn("name", F.lower("keyword"))
    return words.join(named, "name", "left").select("keyword", "category")


def classify_open(keywords: DataFrame, classifier: Classifier | None = None, ledger_dir: str | None = None,
                  rules: Sequence[tuple[str, str]] = S.KEYWORD_RULES, **how) -> DataFrame:
    """``keyword, category`` by rules first, then by the classifier; NULL where neither knows.

    Without a classifier every keyword that no rule matches is ``Other``, as in a source system without one.
    """
    if classifier is None:
        return K.classify(keywords, rules)
    if ledger_dir is None:
        raise ValueError("a classifier needs a ledger_dir, a folder that all executors share")
    ruled = K.classify(keywords, rules, fallback=None)
    asked = ask(ruled.where("category IS NULL"), classifier, ledger_dir, **how)
    return ruled.where("category IS NOT NULL").unionByName(asked)
