"""Files of a log as a table: listing and fingerprints, without reading their contents."""

from __future__ import annotations

import hashlib
import re

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

FILE_FIELDS = "path string, modificationTime timestamp, length long"


def list_files(spark: SparkSession, paths: list[str]) -> DataFrame:
    """``path, modificationTime, length`` of every file below ``paths`` (files, folders or globs that exist)."""
    if not paths:
        return spark.range(0).select(*[F.lit(None).cast(t).alias(n) for n, t in (f.split() for f in FILE_FIELDS.split(", "))])
    found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(paths)
    return found.select("path", "modificationTime", "length")  # the content column is pruned


def path_exists(spark: SparkSession, path: str) -> bool:
    try:
        spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
        return True
    except AnalysisException:
        return False


def fingerprint(spark: SparkSession, paths: list[str], *parameters: object) -> str:
    """A digest of names, sizes and times of the files below ``paths``, and of the parameters.

    Computed by Spark as sums over the files, so that neither their number nor their order matters.
    """
    h = F.xxhash64("path", F.unix_micros("modificationTime"), "length")
    n, low, high, mixed = list_files(spark, paths).agg(
        F.count("*"), F.sum(h.bitwiseAND(F.lit(0xFFFFFFFF))), F.sum(F.shiftrightunsigned(h, 32)), F.bit_xor(h)).first()
    return hashlib.sha256(repr((n, low, high, mixed, sorted(paths), parameters)).encode()).hexdigest()[:24]


def file_system(uri: str):
    """(pyarrow file system, path in it) for a Hadoop path, usable in tasks; any file system that pyarrow knows."""
    from pyarrow import fs

    if re.match(r"^(file:|/)", uri):
        return fs.LocalFileSystem(), re.sub(r"^file:/*", "/", uri)
    return fs.FileSystem.from_uri(re.sub(r"^s3[an]:", "s3:", uri))
