"""A corpus pipeline: toxicity, exact and near duplicates, secrets, packing.

Each stage is a function of (spark, docs, sf_dir) that applies one operator of
``viewpulse.llm`` to all documents that the stage before it kept; its result is written as Parquet
in the shared folder and read as the next stage's documents.  All stages but the last return the
columns of ``documents``.

Stages that drop rows know each row by its file and its place in it, which any reader
finds the same, so that null or repeated ids and repeated rows are decided row by row.  Null texts are empty texts to every
stage.  Empty tables give empty tables.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from viewpulse.llm import exact_dedup, packing, queries, secrets, simhash, toxicity
from viewpulse.llm.common import crc_remainder, cut, documents

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def _named(docs: DataFrame) -> DataFrame:
    """``docs`` with ``row_id``: the file and the place of each row; rows that are not read from files are written first."""
    place = F.concat_ws("#", "_metadata.file_path", "_metadata.row_index").alias("row_id")
    try:
        return docs.select(*COLUMNS, place)
    except AnalysisException:
        return cut(docs.select(*COLUMNS), "pipeline-rows").select(*COLUMNS, place)


def _only(rows: DataFrame, kept: DataFrame) -> DataFrame:
    return rows.join(kept.select("row_id"), "row_id", "left_semi").select(*COLUMNS)


def remove_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored 0.5 or more go.  The labels teach as in the operator's query."""
    rows = _named(docs)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    scored = toxicity.score(rows, labels, learn=crc_remainder("doc_id", 5) != 0, row_col="row_id")
    return _only(rows, scored.where("score < 0.5"))


def remove_exact_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts that are equal without white space, the longest stays, then the smallest doc_id."""
    rows = _named(docs)
    found = exact_dedup.exact_duplicates(rows, id_col="row_id", tie_col="doc_id")
    return _only(rows, found.where("kept"))


def remove_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of linked fingerprints, the smallest doc_id stays."""
    rows = _named(docs)
    found = simhash.near_duplicates(rows, shingle=3, max_bits=3, id_col="row_id")
    ids = rows.select("row_id", "doc_id")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "row_id")).alias("first")
    stays = found.join(ids, "row_id").groupBy("component_id").agg(first)
    return _only(rows, stays.select(F.col("first.row_id").alias("row_id")))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents stay; each secret in their texts becomes a mark, and n_chars counts the new text."""
    docs = docs.select(*COLUMNS)
    clean = secrets.redact(docs, secrets.fit(docs))
    n_chars = F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(F.length("text").cast(docs.schema["n_chars"].dataType))
    return clean.withColumn("n_chars", n_chars).select(*COLUMNS)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row for each piece of a document in a training sequence."""
    return packing.pack_documents(docs, **queries.packing_parameters())


STAGES = [
    ("toxicity", remove_toxic),
    ("exact dedup", remove_exact_duplicates),
    ("SimHash near-dedup", remove_near_duplicates),
    ("secret scans", redact_secrets),
    ("best-fit packing", pack),
]

#: Nearest examples, fingerprints and packing are beyond SQL; tests compare each stage with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = cut(stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return docs
