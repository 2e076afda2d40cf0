"""Repeated passages by content-defined chunking (operator 5).

A gear hash rolls over the bytes of a text: h = 2h + random(byte).  A chunk ends
where the masked bits of the hash are zero, so that ends depend on the last bytes alone and an insertion moves
only the chunk that it falls into.  Chunks with the same 64-bit digest in different rows
are repeats; the one in the first row stays, by id (null ids last), then by a digest of the text, whatever files the rows are in.  Adjacent repeated chunks form a passage, and passages with enough words are reported.

The chunks of all rows are combined on the map side before the shuffle that counts them, and the join back
to texts has one row for each repeated digest, so a chunk that a third of all rows hold splits like any skewed join.
A single chance match of two digests can't make a passage, which takes several chunks in a row.

Null texts are empty and have no chunks.  Null or repeated ids are rows of their own; of repeated rows, which are
alike in all that is reported, one stays.  Texts of any length are chunked whole, up to 2^39 bytes.  A chunk that repeats only within one row is no repeat.  Offsets count bytes of the UTF-8 text.
Columns other than id and text are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from viewpulse.llm.common import cut, text_or_empty
from viewpulse.llm.slices import U, byte_table, parts, slice_hashes

#: The bytes that a hash depends on.
REACH = 32
#: Start, length and words of a chunk share a long: 40, 12 and 12 bits.
LENGTH_BITS, WORD_BITS = 12, 12


def gear(raw: np.ndarray) -> np.ndarray:
    """The rolling hash at each byte, over the last 32 bytes, by doubling the window."""
    h = (byte_table(2) >> U(32)).astype(np.uint32)[raw]
    step = 1
    while step < REACH:
        shifted = np.zeros_like(h)
        shifted[step:] = h[:-step] << np.uint32(step)
        h = h + shifted
        step *= 2
    return h


def chunk_ends(raw: np.ndarray, mask_bits: int, least: int, most: int) -> np.ndarray:
    """Ends of the chunks of one text.

    An end closer than ``least`` bytes to the hash end before it is no end; longer gaps than ``most`` are cut evenly from their start.
    """
    h = gear(raw)
    found = np.flatnonzero(h >> np.uint32(32 - mask_bits) == 0) + 1
    found = found[np.diff(found, prepend=-least) >= least]
    found = found[found < len(raw)]
    edges = np.concatenate([[0], found, [len(raw)]])
    gaps = np.diff(edges)
    extra = (gaps - 1) // most
    if extra.any():
        more = [edges[i] + most * np.arange(1, extra[i] + 1) for i in np.flatnonzero(extra)]
        edges = np.sort(np.concatenate([edges, *more]))
    return edges[1:]


def chunk(text: str | bytes, mask_bits: int, least: int, most: int) -> tuple[np.ndarray, np.ndarray]:
    """(digest, start | length | words) of the chunks of one text, as signed longs."""
    b = text.encode("utf-8", "surrogatepass") if isinstance(text, str) else text
    raw = np.frombuffer(b, np.uint8)
    if not len(raw):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    ends = chunk_ends(raw, mask_bits, least, most)
    starts = np.append(0, ends[:-1])
    digest = slice_hashes(raw, starts, ends, byte_table(3))
    white = (raw == 32) | ((raw >= 9) & (raw <= 13))
    begins = ~white & np.append(True, white[:-1])
    begun = np.append(0, np.cumsum(begins))
    n_words = begun[ends] - begun[starts]
    return digest.view(np.int64), (starts << (LENGTH_BITS + WORD_BITS)) | ((ends - starts) << WORD_BITS) | n_words


def chunks(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", mask_bits: int = 4, least: int = 12,
           most: int = 256) -> DataFrame:
    """``row, id, text_hash, digests, places``: the chunks of each row, written to the shared folder."""
    def run(batches):
        for b in batches:
            made = [chunk(t, mask_bits, least, most) for t in b.column(3).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), b.column(2), pa.array([m[0] for m in made], pa.list_(pa.int64())),
                                              pa.array([m[1] for m in made], pa.list_(pa.int64()))], names=["row", "id", "text_hash", "digests", "places"])

    schema = T.StructType([T.StructField("row", T.LongType()), T.StructField("id", docs.schema[id_col].dataType),
                           T.StructField("text_hash", T.IntegerType()), T.StructField("digests", T.ArrayType(T.LongType())), T.StructField("places", T.ArrayType(T.LongType()))])
    base = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("id"), F.hash(text_or_empty(text_col)).alias("text_hash"),
                       text_or_empty(text_col).alias("text"))
    return cut(base.mapInArrow(run, schema), "chunks")


def repeated_passages(docs: DataFrame, min_words: int = 25, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each repeated passage of a row.

    ``id, start, end, n_words, n_chunks, first_<id>, kept``: ``first_<id>`` is the id of the first row that shares one of
    its chunks, and ``kept`` says that the row itself is the first for all of them.
    """
    made = chunks(docs, id_col, text_col)
    order = F.struct(F.col("id").isNull().alias("unnamed"), "id", "text_hash", "row").alias("order")
    # a row counts once for a digest; 32 bits of the text's hash and no other columns, as this shuffle holds all chunks
    repeated = (made.select(order, F.explode(F.array_distinct("digests")).alias("digest")).groupBy("digest")
                .agg(F.min("order").alias("first"), F.count("*").alias("rows")).where("rows > 1").select("digest", "first"))
    asking = made.select("row", "id", F.explode(F.arrays_zip("digests", "places")).alias("c")).select(
        "row", "id", F.col("c.digests").alias("digest"), F.col("c.places").alias("place"))
    hits = asking.join(repeated, "digest").select(
        "row", "id", "first", F.shiftrightunsigned("place", LENGTH_BITS + WORD_BITS).alias("start"),
        F.shiftrightunsigned("place", WORD_BITS).bitwiseAND((1 << LENGTH_BITS) - 1).alias("length"),
        F.col("place").bitwiseAND((1 << WORD_BITS) - 1).alias("words"))
    in_row = Window.partitionBy("row").orderBy("start")
    fresh = F.lag(F.col("start") + F.col("length")).over(in_row).eqNullSafe(F.col("start"))
    runs = hits.withColumn("fresh", (~fresh).cast("long")).withColumn("run", F.sum("fresh").over(in_row))
    passages = runs.groupBy("row", "run").agg(
        F.min("start").alias("start"), F.max(F.col("start") + F.col("length")).alias("end"), F.sum("words").alias("n_words"),
        F.count("*").alias("n_chunks"), F.min("first").alias("first"), F.min(F.col("first.row") == F.col("row")).alias("kept"), F.first("id").alias("id"))
    return passages.where(F.col("n_words") >= min_words).select(
        F.col("id").alias(id_col), "start", "end", "n_words", "n_chunks", F.col("first.id").alias(f"first_{id_col}"), "kept")
