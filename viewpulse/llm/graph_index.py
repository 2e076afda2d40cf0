"""Approximate nearest neighbours on robust-pruned directed graphs (operator 2).

Vectors are dealt by a hash into shards of bounded size, and each shard becomes one graph in a task.
Points enter a graph in batches.  A greedy search from the centre and some other points proposes the neighbours of a
point; going outwards, a proposal is dropped when a kept neighbour is closer to it, by the factor
``alpha``, than the point itself.  This keeps few, diverse edges.  Edges also go
back from each neighbour, whose list is pruned alike when it is full.

Every row is indexed.  A query searches every shard by beam search, in blocks of
queries, and the cosines of what it finds are computed in double precision on the original vectors.

Equal vectors are one point of a graph that keeps its smallest ids, one more than
a query returns: no other of its rows can be in a result.  So groups of copies
neither crowd out a graph nor meet in one task (they are reduced on the map side).

Vectors that are null, empty or zero or hold null or non-finite components, and rows
with null ids, take no part.  Vectors of other lengths than a query's are not
its candidates.  Ties go to the smaller id.  A query's own id is no candidate; a repeated row counts once.
Columns other than id and vector are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from viewpulse.llm.common import cut


def _unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=1, keepdims=True)  # no overflow in the squares
    return (x / np.sqrt((x * x).sum(axis=1, keepdims=True)))


class Graph:
    """A directed graph over unit vectors: ``edges[i]`` are neighbours of i, -1 where there are fewer.

    Searches start from several entries, since a large tight cluster may have no edges that lead out of it.
    """

    def __init__(self, unit: np.ndarray, edges: np.ndarray, entries: np.ndarray):
        self.unit, self.edges, self.entries = unit, edges, entries

    def search(self, queries: np.ndarray, beam: int, width: int = 4):
        """Beam search of many unit queries at once: (nodes, cosines) by falling cosine, and the (nodes, cosines) that were opened."""
        n, b = len(self.unit), len(queries)
        beam = min(beam, n)
        row = np.arange(b)[:, None]
        seen = np.zeros((b, n + 1), bool)
        seen[:, n] = True  # the place of missing edges
        score = queries @ self.unit[self.entries].T
        best = np.argsort(-score, axis=1, kind="stable")[:, :beam]
        nodes, score = self.entries[best], score[row, best]
        done = np.zeros(nodes.shape, bool)
        seen[:, self.entries] = True
        opened, opened_score = [], []
        padded = np.concatenate([self.unit, np.zeros((1, self.unit.shape[1]))])
        edges = np.concatenate([np.where(self.edges < 0, n, self.edges), np.full((1, self.edges.shape[1]), n)])
        while True:
            rank = np.where(done, -np.inf, score)
            pick = np.argsort(-rank, axis=1, kind="stable")[:, :width]
            active = ~done[row, pick]
            if not active.any():
                break
            chosen = np.where(active, nodes[row, pick], n)
            opened.append(chosen)
            opened_score.append(np.where(active, score[row, pick], -np.inf))
            done[row, pick] = True
            near = edges[chosen].reshape(b, -1)
            near = np.sort(np.where(seen[row, near], n, near), axis=1)
            near[:, 1:][near[:, 1:] == near[:, :-1]] = n
            seen[row, near] = True
            s = np.einsum("bkd,bd->bk", padded[near], queries)
            s[near == n] = -np.inf
            nodes, score = np.concatenate([nodes, near], axis=1), np.concatenate([score, s], axis=1)
            done = np.concatenate([done, near == n], axis=1)
            best = np.argsort(-score, axis=1, kind="stable")[:, :beam]
            nodes, score, done = nodes[row, best], score[row, best], done[row, best]
        return nodes, score, np.concatenate(opened, axis=1), np.concatenate(opened_score, axis=1)

    def prune(self, points: np.ndarray, proposals: np.ndarray, degree: int, alpha: float) -> np.ndarray:
        """Up to ``degree`` diverse neighbours of each point from its proposals (-1: none)."""
        n = len(self.unit)
        p = np.sort(np.where((proposals < 0) | (proposals == points[:, None]), n, proposals), axis=1)
        p[:, 1:][p[:, 1:] == p[:, :-1]] = n
        padded = np.concatenate([self.unit, np.zeros((1, self.unit.shape[1]))])
        x = padded[p]
        # distances of unit vectors; missing proposals are far away and never alive
        far = np.sqrt(np.maximum(0, 2 - 2 * np.einsum("bkd,bd->bk", x, self.unit[points])))
        order = np.argsort(np.where(p == n, np.inf, far), axis=1, kind="stable")
        row = np.arange(len(points))[:, None]
        p, far, x = p[row, order], far[row, order], x[row, order]
        between = np.sqrt(np.maximum(0, 2 - 2 * np.matmul(x, x.transpose(0, 2, 1))))
        alive = p < n
        out = np.full((len(points), degree), -1)
        every = np.arange(len(points))
        for k in range(degree):
            first = alive.argmax(axis=1)
            has = alive[every, first]
            if not has.any():
                break
            out[has, k] = p[has, first[has]]
            alive[every, first] = False
            alive &= ~((alpha * between[every, first] <= far) & has[:, None])
        return out

    def add_back(self, points: np.ndarray, degree: int, alpha: float) -> None:
        """Edges from the neighbours of ``points`` back to them."""
        source = np.repeat(points, self.edges.shape[1])
        target = self.edges[points].ravel()
        use = target >= 0
        source, target = source[use], target[use]
        order = np.argsort(target, kind="stable")
        source, target = source[order], target[order]
        nodes, first, count = np.unique(target, return_index=True, return_counts=True)
        for at in range(0, len(nodes), 256):
            own = slice(at, at + 256)
            more = np.full((len(nodes[own]), count[own].max()), -1)
            slot = np.arange(count[own].sum()) - np.repeat(np.cumsum(count[own]) - count[own], count[own])
            start = first[own][0]
            more[np.repeat(np.arange(len(nodes[own])), count[own]), slot] = source[start : start + count[own].sum()]
            both = np.sort(np.concatenate([self.edges[nodes[own]], more], axis=1), axis=1)
            both[:, 1:][both[:, 1:] == both[:, :-1]] = -1
            size = (both >= 0).sum(axis=1)
            fits = size <= degree
            packed = np.sort(both, axis=1)[:, ::-1][:, :degree]
            if packed.shape[1] < degree:
                packed = np.pad(packed, ((0, 0), (0, degree - packed.shape[1])), constant_values=-1)
            self.edges[nodes[own][fits]] = packed[fits]
            full = nodes[own][~fits]
            for k in range(0, len(full), 64):
                self.edges[full[k : k + 64]] = self.prune(full[k : k + 64], both[~fits][k : k + 64], degree, alpha)


def build(unit: np.ndarray, degree: int, beam: int, alpha: float, entries: int = 64, seed: int = 0) -> Graph:
    """A graph over all points: two passes, the first with plain pruning, as edges are found on a graph in the making."""
    n = len(unit)
    rng = np.random.default_rng(seed)
    order = rng.permutation(n)
    centre = int(np.argmax(unit @ unit.mean(axis=0)))
    graph = Graph(unit, np.full((n, degree), -1), np.unique(np.append(order[:entries], centre)))
    for factor in (1.0, alpha):
        at, size = 0, 1 if factor == 1.0 else 256
        while at < n:
            points = order[at : at + size]
            *_, opened, _ = graph.search(unit[points], beam)
            proposals = np.concatenate([np.where(opened == n, -1, opened), graph.edges[points]], axis=1)
            graph.edges[points] = graph.prune(points, proposals, degree, factor)
            graph.add_back(points, degree, factor)
            at, size = at + size, min(256, size * 2)
    return graph


def _valid(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """``id, dim, vector`` (doubles) of the rows that take part."""
    x = F.col(vector_col).cast("array<double>")
    bad = F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    ok = F.col(id_col).isNotNull() & x.isNotNull() & ~bad & F.exists(x, lambda v: v != 0)
    return vectors.where(ok).select(F.col(id_col).cast("long").alias("id"), F.size(x).alias("dim"), x.alias("vector"))


def build_index(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", copies: int = 6,
                shard_size: int = 4096, degree: int = 32, beam: int = 64, alpha: float = 1.2) -> DataFrame:
    """``dim, shard, points, vectors, ids, id_counts, edges, entries``: one graph in each row, written to the shared folder.

    ``copies`` ids are kept of equal vectors, the smallest; shards have about ``shard_size`` points.
    """
    by_vector = Window.partitionBy("dim", "vector").orderBy("id")
    rows = _valid(vectors, id_col, vector_col).distinct().withColumn("r", F.row_number().over(by_vector)).where(F.col("r") <= copies)
    points = cut(rows.groupBy("dim", "vector").agg(F.sort_array(F.collect_list("id")).alias("ids")), "graph-points")
    counts = {r["dim"]: r["count"] for r in points.groupBy("dim").count().collect()}
    shards = {dim: -(-n // shard_size) for dim, n in counts.items()}
    total = max(1, sum(shards.values()))
    n_shards = F.element_at(F.create_map(*[F.lit(v) for pair in (shards or {0: 1}).items() for v in pair]), F.col("dim"))
    dealt = points.withColumn("shard", F.pmod(F.xxhash64("vector"), n_shards).cast("int"))

    def make(key, table):
        dim, shard = key[0].as_py(), key[1].as_py()
        ids = table.column("ids").to_pylist()
        x = np.array(table.column("vector").to_pylist(), np.float64).reshape(-1, dim)
        order = sorted(range(len(ids)), key=lambda i: ids[i][0])  # the same graph whatever the order of rows
        ids, x = [ids[i] for i in order], x[order]
        g = build(_unit(x), degree, beam, alpha)
        return pa.table({
            "dim": pa.array([dim], pa.int32()), "shard": pa.array([shard], pa.int32()), "points": pa.array([len(ids)], pa.int32()),
            "vectors": [x.tobytes()], "ids": [np.array([i for own in ids for i in own], np.int64).tobytes()],
            "id_counts": [np.array([len(own) for own in ids], np.int32).tobytes()], "edges": [g.edges.astype(np.int32).tobytes()],
            "entries": [g.entries.astype(np.int32).tobytes()]})

    fields = "dim int, shard int, points int, vectors binary, ids binary, id_counts binary, edges binary, entries binary"
    # a shard is far more work than its bytes suggest, so its tasks are not coalesced
    return cut(dealt.repartition(2 * total, "dim", "shard").groupBy("dim", "shard").applyInArrow(make, fields), "graph-index")


def search(index: DataFrame, queries: DataFrame, k: int = 5, id_col: str = "vec_id", vector_col: str = "embedding",
           beam: int = 96, block: int = 1024) -> DataFrame:
    """``query_id, rank, vec_id, score``: the k nearest found of each query, nearest first."""
    asked = _valid(queries, id_col, vector_col)
    shards = index.groupBy("dim").agg((F.max("shard") + 1).alias("shards"))
    blocks = -(-asked.count() // block) or 1
    # each block of queries meets each shard once
    asked = (asked.join(F.broadcast(shards), "dim").withColumn("shard", F.explode(F.sequence(F.lit(0), F.col("shards") - 1)))
             .select("dim", "shard", F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int").alias("block"), "id", "vector"))
    copied = index.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))

    def find(key, shard, questions):
        out = {"query_id": [], "vec_id": [], "score": []}
        if shard.num_rows and questions.num_rows:
            one = {c: shard.column(c)[0].as_py() for c in shard.column_names}
            n, dim = one["points"], one["dim"]
            x = np.frombuffer(one["vectors"], np.float64).reshape(n, dim)
            counts, ids = np.frombuffer(one["id_counts"], np.int32), np.frombuffer(one["ids"], np.int64)
            first = np.cumsum(counts) - counts
            graph = Graph(_unit(x), np.frombuffer(one["edges"], np.int32).reshape(n, -1).astype(np.int64), np.frombuffer(one["entries"], np.int32).astype(np.int64))
            asker = questions.column("id").to_numpy()
            y = np.array(questions.column("vector").to_pylist(), np.float64).reshape(-1, dim)
            for at in range(0, len(asker), 256):
                nodes, *_ = graph.search(_unit(y[at : at + 256]), beam)
                for i, found in enumerate(nodes):
                    q, own = y[at + i], found[found < n]
                    scale = np.abs(q).max()
                    top = np.abs(x[own]).max(axis=1)
                    a, b = q / scale, x[own] / top[:, None]
                    cosine = (b @ a) / (np.sqrt(a @ a) * np.sqrt((b * b).sum(axis=1)))
                    names = np.concatenate([ids[first[j] : first[j] + counts[j]] for j in own])
                    cosine = np.repeat(cosine, counts[own])
                    use = names != asker[at + i]
                    names, cosine = names[use], cosine[use]
                    best = np.lexsort((names, -cosine))[:k]
                    out["query_id"] += [asker[at + i]] * len(best)
                    out["vec_id"] += names[best].tolist()
                    out["score"] += cosine[best].tolist()
        return pa.table({c: pa.array(v, pa.float64() if c == "score" else pa.int64()) for c, v in out.items()})

    parts = 2 * max(1, index.count() * blocks)
    found = (copied.repartition(parts, "dim", "shard", "block").groupBy("dim", "shard", "block")
             .cogroup(asked.repartition(parts, "dim", "shard", "block").groupBy("dim", "shard", "block"))
             .applyInArrow(find, "query_id long, vec_id long, score double"))
    nearest = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.distinct().withColumn("rank", F.row_number().over(nearest)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
