"""Near duplicates by SimHash, joined on Golay codeword keys (operator 8).

A text's fingerprint has 64 bits: a bit is set when more than half of the
XXH64 hashes of the text's word shingles have it set.  Fingerprints within three bits
are linked and the components of links are numbered by their smallest id.

Finding all links.  A fingerprint is cut into four segments of 16 bits.  Three
errors leave some segment without error, and at most one of the other three has more
than one; so of any two of those three, one has at most one error.  Eight (untouched
segment, tolerant segment) pairs thus cover every link.  The tolerant segment
is matched by the binary Golay code (23, 12): every 23-bit word is within three bits of
exactly one codeword.  A fingerprint is filed under the codeword of its own
segment, and asks for the codewords of its segment and of all words one bit away,
which are few (about five), as they lie close together.  A key is (pair,
untouched segment, codeword).  Every match is verified on the whole fingerprints.

Keys that file many different fingerprints (large groups of near copies) are
compared in blocks: members are dealt into blocks of bounded size, each pair of
blocks is one task that returns a spanning forest of its links instead
of all links, so that components stay exact and no group is expanded to all
pairs.  Equal fingerprints count as one node throughout.

Null texts are empty; texts without words have fingerprint zero and link
like any other; fewer words than a shingle make one shingle of the whole sequence.
Null ids take part in links but never name a component unless all its ids are
null.  Repeated rows give repeated results; columns other than id and text are
ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from viewpulse.llm.common import cut, text_or_empty
from viewpulse.llm.components import component_roots

SEED = 42
U = np.uint64
#: Fixed values of XXH64: its five primes.
P1, P2, P3, P4, P5 = (U(11400714785074694791), U(14029467366897019727), U(1609587929392839161),
                      U(9650029242287828579), U(2870177450012600261))
#: Generator polynomial of the binary Golay code: x^11 + x^10 + x^6 + x^5 + x^4 + x^2 + 1.
GOLAY = 0b110001110101
SEGMENTS, WIDTH = 4, 16
#: (segment that has no error, segment that has at most one): two tolerant ones for each untouched one.
PAIRS = [(i, (i + d) % SEGMENTS) for i in range(SEGMENTS) for d in (1, 2)]


def _rotl(x, r):
    return (x << U(r)) | (x >> U(64 - r))


def xxh64_slices(buffer: bytes, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """XXH64 with seed 42 of many slices of one buffer, which has 8 spare bytes at its end."""
    raw = np.frombuffer(buffer, np.uint8)
    lane8 = np.ndarray((len(raw) - 7,), "<u8", buffer, strides=(1,))
    lane4 = np.ndarray((len(raw) - 3,), "<u4", buffer, strides=(1,))
    size = ends - starts
    h = U(SEED) + P5 + size.astype(U)
    at = starts.copy()
    for step in range(3):
        own = np.flatnonzero((size >> 3) > step)
        if len(own):
            k = _rotl(lane8[at[own]].astype(U) * P2, 31) * P1
            h[own] = _rotl(h[own] ^ k, 27) * P1 + P4
            at[own] += 8
    own = np.flatnonzero(size & 4)
    if len(own):
        h[own] = _rotl(h[own] ^ (lane4[at[own]].astype(U) * P1), 23) * P2 + P3
        at[own] += 4
    for step in range(3):
        own = np.flatnonzero((size & 3) > step)
        if len(own):
            h[own] = _rotl(h[own] ^ (raw[at[own]].astype(U) * P5), 11) * P1
            at[own] += 1
    h ^= h >> U(33)
    h *= P2
    h ^= h >> U(29)
    h *= P3
    h ^= h >> U(32)
    for i in np.flatnonzero(size >= 32):  # the four-lane form of longer slices
        h[i] = xxhash.xxh64_intdigest(buffer[starts[i] : ends[i]], SEED)
    return h


def majority(hashes: np.ndarray, first: np.ndarray, count: np.ndarray) -> np.ndarray:
    """One fingerprint for each run ``hashes[first[i] : first[i] + count[i]]`` (count > 0, runs in order).

    Eight counters share a word, so runs are summed in parts of at most 255.
    """
    parts = -(-count // 255)
    part_first = np.repeat(first, parts) + (np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts)) * 255
    doc_part = np.cumsum(parts) - parts
    low = U(0x0101010101010101)
    out = np.zeros(len(first), U)
    for k in range(8):
        sums = np.add.reduceat((hashes >> U(k)) & low, part_first)
        lanes = np.add.reduceat(sums.view(np.uint8).reshape(-1, 8).astype(np.int64), doc_part)
        for lane in range(8):
            out |= (2 * lanes[:, lane] > count).astype(U) << U(8 * lane + k)
    return out


def fingerprints(texts: list[str], shingle: int, part_bytes: int = 4_000_000) -> np.ndarray:
    out = np.zeros(len(texts), U)
    i = 0
    while i < len(texts):
        docs, words, buffers, total = [], [], [], 0
        while i < len(texts) and total < part_bytes:
            own = texts[i].encode("utf-8", "surrogatepass").lower().split()
            if own:
                docs.append(i)
                words.append(len(own))
                buffers.append(b" ".join(own))
                total += len(buffers[-1])
            i += 1
        if not docs:
            continue
        joined = b"\n".join(buffers)
        raw = np.frombuffer(joined, np.uint8)
        ends = np.append(np.flatnonzero((raw == 32) | (raw == 10)), len(raw))
        starts = np.append(0, ends[:-1] + 1)
        words = np.array(words)
        last = np.cumsum(words)
        first = last - words
        count = np.maximum(1, words - shingle + 1)
        run = np.cumsum(count) - count
        at = np.arange(count.sum()) + np.repeat(first - run, count)
        width = np.repeat(np.minimum(words, shingle), count)
        h = xxh64_slices(joined + bytes(8), starts[at], ends[at + width - 1])
        out[docs] = majority(h, run, count)
    return out


def fingerprint(docs: DataFrame, shingle: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, fp``: the 64 bits as a signed long."""
    def run(batches):
        for b in batches:
            fp = fingerprints(b.column(1).to_pylist(), shingle)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fp.view(np.int64))], names=["id", "fp"])

    schema = T.StructType([T.StructField("id", docs.schema[id_col].dataType), T.StructField("fp", T.LongType())])
    return docs.select(F.col(id_col).alias("id"), text_or_empty(text_col).alias("text")).mapInArrow(run, schema)


def golay_index() -> np.ndarray:
    """Number (the 12 data bits) of the codeword nearest to each 16-bit segment, read as the low bits of a word."""
    def remainder(v):
        v = v.copy()
        for bit in range(22, 10, -1):
            v ^= np.where(v >> bit & 1, GOLAY << (bit - 11), 0)
        return v

    single = 1 << np.arange(23)
    errors = [0]
    for a in range(23):
        errors.append(single[a])
        for b in range(a):
            errors.append(single[a] | single[b])
            errors.extend(single[a] | single[b] | single[c] for c in range(b))
    errors = np.array(errors, np.int64)
    leader = np.zeros(2048, np.int64)
    leader[remainder(errors)] = errors
    words = np.arange(1 << WIDTH, dtype=np.int64)
    return (words ^ leader[remainder(words)]) >> 11


def near_codewords() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(own codeword, first, all): the codewords of a segment and of the words one bit away are ``all[first[s]:first[s+1]]``."""
    own = golay_index()
    words = np.arange(1 << WIDTH)
    near = np.stack([own] + [own[words ^ (1 << b)] for b in range(WIDTH)], axis=1)
    near.sort(axis=1)
    fresh = np.concatenate([np.ones((len(near), 1), bool), near[:, 1:] != near[:, :-1]], axis=1)
    return own, np.append(0, np.cumsum(fresh.sum(axis=1))), near[fresh]


def _segments(fp: np.ndarray) -> list[np.ndarray]:
    return [(fp >> U(WIDTH * s) & U(0xFFFF)).astype(np.int64) for s in range(SEGMENTS)]


def _key(pair: int, exact: np.ndarray, codeword: np.ndarray) -> np.ndarray:
    return (np.int64(pair) << 28) | (exact << 12) | codeword


def _keys(nodes: DataFrame, asked: bool) -> DataFrame:
    """``key, fp`` for each key that a fingerprint is filed under, or asks for."""
    own, first, near = near_codewords()

    def run(batches):
        for b in batches:
            for at in range(0, b.num_rows, 20_000):
                signed = b.column(0).to_numpy()[at : at + 20_000]
                seg = _segments(signed.view(U))
                for pair, (i, j) in enumerate(PAIRS):
                    if asked:
                        n = first[seg[j] + 1] - first[seg[j]]
                        word = near[np.arange(n.sum()) + np.repeat(first[seg[j]] - (np.cumsum(n) - n), n)]
                        key, fp = _key(pair, np.repeat(seg[i], n), word), np.repeat(signed, n)
                    else:
                        key, fp = _key(pair, seg[i], own[seg[j]]), signed
                    yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(fp)], names=["key", "fp"])

    return nodes.select("fp").mapInArrow(run, "key long, fp long")


def spanning_forest(a: np.ndarray, b: np.ndarray, max_bits: int) -> list[tuple[int, int]]:
    """Links within ``max_bits`` between the fingerprints of two blocks, thinned to a forest."""
    nodes = np.unique(np.concatenate([a, b]))
    parent = list(range(len(nodes)))

    def root(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    forest = []
    at_b = np.searchsorted(nodes, b)
    bits_b = b.view(U)
    for x in a:
        i = int(np.searchsorted(nodes, x))
        close = at_b[np.bitwise_count(bits_b ^ x.view(U)) <= max_bits]
        for j in close.tolist():
            ri, rj = root(i), root(j)
            if ri != rj:
                parent[ri] = rj
                forest.append((int(nodes[i]), int(nodes[j])))
    return forest


def links(nodes: DataFrame, max_bits: int = 3, hot: int = 24, block: int = 512) -> DataFrame:
    """``u, v``: links between different fingerprints, with the same components as all links.

    A key that files more than ``hot`` fingerprints is compared by pairs of blocks of about
    ``block`` members; of the others all links are returned.
    """
    filed = cut(_keys(nodes, asked=False), "simhash-filed")
    asked = cut(_keys(nodes, asked=True), "simhash-asked")
    sizes = filed.groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") > hot)
    sizes = cut(sizes, "simhash-hot")
    close = F.bit_count(F.col("a.fp").bitwiseXOR(F.col("b.fp"))) <= max_bits
    cool = (asked.join(sizes, "key", "left_anti").alias("a")
            .join(filed.alias("b"), (F.col("a.key") == F.col("b.key")) & (F.col("a.fp") < F.col("b.fp")) & close)
            .select(F.col("a.fp").alias("u"), F.col("b.fp").alias("v")))

    # hot keys: members are dealt into blocks by a hash, each pair of blocks is a group
    n_blocks = (F.col("n") / block).cast("int") + 1
    dealt = lambda df: (df.join(sizes, "key")
                        .select("key", "fp", n_blocks.alias("blocks"))
                        .withColumn("own", F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int")))
    asking = (dealt(asked).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
              .select("key", "own", "other", "fp", F.lit(0).alias("side")))
    files = (dealt(filed).withColumnRenamed("own", "to").withColumn("own", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
             .select("key", "own", F.col("to").alias("other"), "fp", F.lit(1).alias("side")))

    def compare(key, table):
        fp, side = table.column("fp").to_numpy(), table.column("side").to_numpy()
        found = spanning_forest(fp[side == 0], fp[side == 1], max_bits)
        return pa.table({"u": pa.array([x for x, _ in found], pa.int64()), "v": pa.array([y for _, y in found], pa.int64())})

    dense = asking.unionByName(files).groupBy("key", "own", "other").applyInArrow(compare, "u long, v long")
    return cool.unionByName(dense)


def near_duplicates(docs: DataFrame, shingle: int = 3, max_bits: int = 3, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """``id, fp, component_id`` for every row, ``id`` under the name of ``id_col``."""
    if not 0 <= max_bits <= 3:
        raise ValueError("the keys cover up to three differing bits")
    prints = cut(fingerprint(docs, shingle, id_col, text_col), "simhash-prints")
    nodes = cut(prints.groupBy("fp").agg(F.min("id").alias("least")), "simhash-nodes")
    roots = component_roots(links(nodes, max_bits))
    rooted = nodes.join(roots, nodes["fp"] == roots["node"], "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    named = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    by_print = rooted.join(named, "root").select("fp", "component_id")
    return prints.join(by_print, "fp").select(F.col("id").alias(id_col), "fp", "component_id")
