"""Sequences for training by sum-of-squares packing (operator 3).

A document's token ids, with an end id, are cut into pieces only where they exceed a
sequence; the first piece takes the remainder.  Pieces are placed one by one,
longest first.  Of all open gaps that a piece fits, it takes the one after which the
sum over gap sizes of (number of open sequences with that gap) squared is smallest; a new
sequence is opened only where nothing fits.  This keeps the gaps varied, so that later pieces fill them exactly.

Pieces are dealt into groups of bounded size by a hash, and each group is packed
in a task.  Sequences that stay badly filled, and half of the others, are opened again, and their pieces meet
in fewer and larger groups in the next round, so that the waste doesn't grow with the number of groups.
Ids stay in the tasks that made them; only lengths are shuffled.

Null texts are empty: a single end id.  Repeated rows are packed once each.  Null ids are packed like others.
Columns other than id and text are ignored.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from viewpulse.llm.byte_bpe import ByteBpe
from viewpulse.llm.common import cut, text_or_empty


def pieces(docs: DataFrame, tokenizer_path: str, pattern: str, size: int, end_id: int = 0,
           id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, piece, start, length, ids_crc32`` for each piece of each row."""
    def run(batches):
        bpe = ByteBpe(tokenizer_path, pattern)
        end = int(end_id).to_bytes(4, "little")
        for b in batches:
            owner, piece, start, length, crc = [], [], [], [], []
            for i, text in enumerate(b.column(1).to_pylist()):
                ids = bpe.encode(text) + end
                n = len(ids) // 4
                at, k = 0, 0
                while at < n:
                    take = min(size, n) if k else (n % size or size)
                    owner.append(i)
                    piece.append(k)
                    start.append(at)
                    length.append(take)
                    crc.append(zlib.crc32(memoryview(ids)[4 * at : 4 * (at + take)]))
                    at, k = at + take, k + 1
            yield pa.RecordBatch.from_arrays(
                [b.column(0).take(pa.array(owner, pa.int64())), pa.array(piece, pa.int32()), pa.array(start, pa.int64()),
                 pa.array(length, pa.int64()), pa.array(crc, pa.int64())], names=["id", "piece", "start", "length", "ids_crc32"])

    schema = T.StructType([T.StructField("id", docs.schema[id_col].dataType), T.StructField("piece", T.IntegerType()),
                           T.StructField("start", T.LongType()), T.StructField("length", T.LongType()),
                           T.StructField("ids_crc32", T.LongType())])
    return docs.select(F.col(id_col).alias("id"), text_or_empty(text_col).alias("text")).mapInArrow(run, schema)


def place(lengths: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(sequence, offset) of each piece, in the given order, by the sum-of-squares rule."""
    open_by_gap: list[list[int]] = [[] for _ in range(size + 1)]
    count = np.zeros(size + 1, np.int64)
    sequence = np.empty(len(lengths), np.int64)
    offset = np.empty(len(lengths), np.int64)
    filled: list[int] = []
    closed = np.iinfo(np.int64).max
    for i, n in enumerate(lengths.tolist()):
        # growth of the sum when a gap g in [n, size) becomes g - n; a full sequence is no gap
        growth = 1 - 2 * count[n:size]
        growth[1:] += 2 * count[1 : size - n] + 1
        growth[count[n:size] == 0] = closed
        best = int(np.argmin(growth)) if n < size else 0
        if n < size and growth[best] < closed:
            gap = n + best
            own = open_by_gap[gap].pop()
            count[gap] -= 1
        else:
            gap, own = size, len(filled)
            filled.append(0)
        sequence[i], offset[i] = own, filled[own]
        filled[own] += n
        if gap > n:
            open_by_gap[gap - n].append(own)
            count[gap - n] += 1
    return sequence, offset


def _packer(size: int, rounds: int, full_share: float, last: bool):
    """Packs a group; ``final`` marks pieces of sequences that are settled.

    Before the last round these are half of the well filled sequences, those without small pieces: small pieces
    go on, as later rounds need them to fill up the rest.
    """
    def run(key, table):
        row, length = table.column("row").to_numpy(), table.column("length").to_numpy()
        order = np.lexsort((row, -length))
        row, length = row[order], length[order]
        sequence, offset = place(length, size)
        final = np.ones(int(sequence.max()) + 1, bool)
        if not last:
            full = np.flatnonzero(np.bincount(sequence, length) >= full_share * size)
            least = np.full(len(final), size)
            np.minimum.at(least, sequence, length)
            final[:] = False
            final[full[np.argsort(-least[full], kind="stable")][: (len(full) + 1) // 2]] = True
        # numbers of different rounds and groups don't meet
        number = (np.int64(rounds) << 56) | (np.int64(key[0].as_py()) << 28) | sequence
        return pa.table({"row": row, "length": length, "sequence_id": number, "offset": offset, "final": final[sequence]})

    return run


def pack(lengths: DataFrame, size: int, group: int = 50_000, full_share: float = 0.99, most_group: int = 1_000_000) -> DataFrame:
    """``row, sequence_id, offset`` for a table of distinct ``row`` and ``length`` (1 to ``size``).

    ``group`` is about the number of pieces that one task packs.  After each round but the last, half of the
    sequences filled to ``full_share`` are final; the pieces of the others go on to the next round, in groups
    twice as large (up to ``most_group`` pieces).  The last round has one group; or, where the largest
    groups settle less than a seventh of their pieces, as many as there are.
    """
    settled = []
    rest, n, rounds, last = lengths.select("row", "length"), lengths.count(), 0, False
    while True:
        own = min(group << rounds, max(group, most_group))
        groups = -(-n // own) or 1
        last = last or groups == 1
        packed = rest.withColumn("g", F.pmod(F.xxhash64("row", F.lit(rounds)), F.lit(groups)))
        packed = packed.groupBy("g").applyInArrow(_packer(size, rounds, full_share, last), "row long, length long, sequence_id long, offset long, final boolean")
        packed = cut(packed, "packing-round")
        settled.append(packed.where("final"))
        left = 0 if last else packed.where("NOT final").count()
        if not left:
            break
        last = own >= most_group and left > 0.85 * n
        rest, n, rounds = packed.where("NOT final").select("row", "length"), left, rounds + 1
    out = settled[0]
    for more in settled[1:]:
        out = out.unionByName(more)
    return out.select("row", "sequence_id", "offset")


def pack_documents(docs: DataFrame, tokenizer_path: str, pattern: str, size: int = 2048, end_id: int = 0,
                   id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, piece, start, length, ids_crc32, sequence_id, offset`` for each piece, ``id`` under the name of ``id_col``."""
    made = pieces(docs, tokenizer_path, pattern, size, end_id, id_col, text_col)
    made = cut(made.withColumn("row", F.monotonically_increasing_id()), "packing-pieces")
    placed = pack(made, size)
    out = made.join(placed, "row")
    return out.select(F.col("id").alias(id_col), "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
