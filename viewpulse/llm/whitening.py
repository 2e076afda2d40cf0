"""Whitening of embeddings by block Jacobi-Davidson (operator 11).

Vectors become whole numbers; each distinct one is in the fit list once.  Their covariance is never
formed: a product with a block of directions is one Spark job that reads the fit list, centres each
vector before multiplying, and adds up ``dimensions x directions`` numbers.  The outer iteration keeps an orthonormal
subspace with its products and takes Ritz pairs from it (Rayleigh-Ritz).  Each wanted pair that isn't
accurate yet gets a correction: a few MINRES steps on the covariance less its Ritz
value, projected off all Ritz vectors and all locked pairs; one job serves the corrections of all pairs.  A pair is locked when its residual
is at the rounding error of the products; the search then goes on orthogonally to it.  At the end the residuals are measured anew
with a product of their own, and the search goes on while one is too large.

The driver holds ``dimensions x subspace`` numbers (the subspace has at most ``subspace`` directions), never rows.

Rows whose vector is null or empty, holds null, NaN or infinite entries, or entries too large for a
whole number of 64 bits, take no part.  Vectors of other lengths than the most frequent one (of equally frequent ones, the longest) take no
part either.  Repeated rows are returned each; equal vectors count once in the fit.  Components whose variance is zero but for
rounding are left out, so that a table with one distinct vector, like an empty table, gives no rows.  Equal
eigenvalues give some orthonormal basis of their space.  A deviation beyond 64 bits is null.  Ids may be null; other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from viewpulse.llm.common import cut

EPS = float(np.finfo(np.float64).eps)
BLOCK = 512  # vectors in a row of the written fit list


def whole_vectors(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``id, x``: the rows that take part, each entry c as floor(64 c) + 1,000,000."""
    scaled = F.transform(F.col(vector_col), lambda c: c.cast("double") * 64)
    usable = F.forall("y", lambda c: F.coalesce(F.abs(c) < float(1 << 62), F.lit(False)))
    rows = vectors.select(F.col(id_col).alias("id"), scaled.alias("y")).where((F.size("y") > 0) & usable)
    rows = rows.select("id", F.transform("y", lambda c: F.floor(c) + 1_000_000).alias("x"))
    common = rows.groupBy(F.size("x").alias("d")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), F.desc("d")).limit(1)
    return rows.where(F.size("x") == F.coalesce(common.select("d").scalar(), F.lit(-1)))


def _matrix(column: pa.Array, d: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64, copy=False).reshape(-1, d)


@dataclass
class Centre:
    """Number of the distinct vectors and their exact sums."""

    n: int
    sums: list[int]

    def scaled(self, x: np.ndarray) -> np.ndarray:
        """``n * x - sums``, exact: in 64 bits where that suffices, else as Python's whole numbers."""
        base = [s // self.n for s in self.sums]  # a mean lies within the range of 64 bits
        rest = np.array([s - self.n * b for s, b in zip(self.sums, base)], np.int64)
        widest = max((max(abs(int(high) - b), abs(int(low) - b)) for low, high, b in zip(x.min(axis=0), x.max(axis=0), base)), default=0)
        if (widest + 1) * self.n < 1 << 62:
            return (x - np.array(base, np.int64)) * np.int64(self.n) - rest
        return x.astype(object) * self.n - np.array(self.sums, object)

    def centred(self, x: np.ndarray) -> np.ndarray:
        return self.scaled(x).astype(np.float64) / self.n


def _exact_sum(x: np.ndarray) -> list[int]:
    small = int(np.abs(x).max(initial=0)) < (1 << 62) // max(1, len(x))
    return [int(v) for v in (x if small else x.astype(object)).sum(axis=0)]


def fit_list(rows: DataFrame) -> tuple[DataFrame, Centre] | None:
    """The distinct vectors, written as blocks of centred doubles, and their centre; None without any vector."""
    distinct = cut(rows.select("x").distinct(), "whitening-fit")
    d = distinct.agg(F.max(F.size("x"))).first()[0]
    if d is None:
        return None

    def total(batches):
        sums, n = [0] * d, 0
        for b in batches:
            x = _matrix(b.column(0), d)
            sums, n = [s + o for s, o in zip(sums, _exact_sum(x))], n + len(x)
        yield pa.RecordBatch.from_pydict({"at": np.arange(d + 1, dtype=np.int32), "s": [str(v) for v in [*sums, n]]})

    parts = distinct.mapInArrow(total, "at int, s string").select("at", F.col("s").cast("decimal(38,0)").alias("s"))
    found = {r["at"]: int(r["s"]) for r in parts.groupBy("at").agg(F.sum("s").alias("s")).collect()}  # a row a dimension
    centre = Centre(found[d], [found[i] for i in range(d)])

    def block(batches):
        for b in batches:
            x = _matrix(b.column(0), d)
            own = [centre.centred(x[i : i + BLOCK]).astype("<f8").tobytes() for i in range(0, len(x), BLOCK)]
            yield pa.RecordBatch.from_pydict({"block": pa.array(own, pa.binary())})

    return cut(distinct.mapInArrow(block, "block binary"), "whitening-blocks"), centre


def _summed(blocks: DataFrame, size: int, part) -> np.ndarray:
    """The sum over all blocks of ``part(block)``, arrays of ``size`` numbers; the driver gets ``size`` rows."""
    def run(batches):
        total = np.zeros(size)
        for b in batches:
            for own in b.column(0):
                total += part(np.frombuffer(own.as_buffer(), "<f8")).ravel()
        yield pa.RecordBatch.from_pydict({"at": np.arange(size, dtype=np.int32), "v": total})

    out = np.zeros(size)
    rows = blocks.mapInArrow(run, "at int, v double").groupBy("at").agg(F.sum("v").alias("v"))
    for at, v in rows.collect():
        out[at] = v
    return out


class Covariance:
    """The covariance of a fit list as an operator on blocks of directions."""

    def __init__(self, blocks: DataFrame, centre: Centre):
        self.blocks, self.n, self.d = blocks, centre.n, len(centre.sums)
        d, n = self.d, self.n
        # the centre as rounded, and the trace
        first = _summed(self.blocks, d + 1, lambda c: np.append(c.reshape(-1, d).sum(axis=0), np.square(c).sum()))
        self.shift, self.trace = first[:d] / n, first[d] / n
        self.products = 0

    def times(self, u: np.ndarray) -> np.ndarray:
        """Covariance times the columns of ``u``, in one pass over the fit list."""
        d, n, shift = self.d, self.n, self.shift
        self.products += 1

        def part(c):
            c = c.reshape(-1, d) - shift
            return c.T @ (c @ u)

        return _summed(self.blocks, d * u.shape[1], part).reshape(d, -1) / n


def _orthonormal(new: np.ndarray, *bases: np.ndarray) -> np.ndarray:
    """An orthonormal basis of what ``new`` adds to the orthonormal ``bases``; columns that add nothing are dropped."""
    size = np.linalg.norm(new, axis=0)
    new = new[:, size > 0] / size[size > 0]
    for _ in range(2):
        for b in bases:
            new = new - b @ (b.T @ new)
    u, s, _ = np.linalg.svd(new, full_matrices=False)
    u = u[:, s > 1e-8]
    for b in bases:
        u = u - b @ (b.T @ u)
    return np.linalg.qr(u)[0] if u.shape[1] else u


def minres_corrections(times, values: np.ndarray, residuals: np.ndarray, keep_off: np.ndarray, steps: int, tolerance: float) -> np.ndarray:
    """Approximate solutions t of P (A - value) P t = -residual for each column, P projecting off ``keep_off``.

    The columns' MINRES recurrences run side by side, so that each step takes one product for all of them.
    """
    off = lambda v: v - keep_off @ (keep_off.T @ v)
    v = off(-residuals)
    beta = np.linalg.norm(v, axis=0)
    goal, alive = tolerance * beta, beta > 0
    v = v / np.where(alive, beta, 1)
    d, k = v.shape
    x, v_old = np.zeros((d, k)), np.zeros((d, k))
    w, w_old = np.zeros((d, k)), np.zeros((d, k))
    c, c_old, s, s_old = np.ones(k), np.ones(k), np.zeros(k), np.zeros(k)
    eta, beta_old = beta.copy(), np.zeros(k)
    for _ in range(steps):
        if not alive.any():
            break
        p = np.zeros((d, k))
        p[:, alive] = times(v[:, alive])
        p = off(p - v * values)
        alpha = (v * p).sum(axis=0)
        p = p - v * alpha - v_old * beta_old
        new = np.linalg.norm(p, axis=0)
        r0 = c * alpha - c_old * s * beta_old
        r1 = np.hypot(r0, new)
        r2, r3 = s * alpha + c_old * c * beta_old, s_old * beta_old
        alive = alive & (r1 > 0)
        safe = np.where(r1 > 0, r1, 1)
        c_old, s_old = c, s
        c, s = r0 / safe, new / safe
        w_next = (v - w_old * r3 - w * r2) / safe
        x[:, alive] += (w_next * (c * eta))[:, alive]
        w_old, w = w, w_next
        eta = -s * eta
        v_old, beta_old = v, new
        alive = alive & (np.abs(eta) > goal) & (new > 0)
        v = off(p / np.where(new > 0, new, 1))
    return x


def leading_pairs(a, d: int, k: int, trace: float, subspace: int | None = None, inner: int = 6, rounds: int = 200,
                  seed: int = 11) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(values, vectors, residual norms) of the ``k`` largest eigenpairs of ``a``, a function that multiplies blocks of columns.

    Residuals are below ``tolerance``: a few roundings of the largest value for each dimension's square root.
    """
    k = min(k, d)
    block = min(d, k + 4)
    most = min(d, subspace or 4 * block)
    v = np.linalg.qr(np.random.default_rng(seed).standard_normal((d, block)))[0]
    av = a(v)
    locked, locked_values = np.empty((d, 0)), np.empty(0)
    best, stuck = np.inf, 0
    for _ in range(rounds):
        h = v.T @ av
        values, y = np.linalg.eigh((h + h.T) / 2)
        values, y = values[::-1], y[:, ::-1]
        want = k - locked.shape[1]
        u, au = v @ y, av @ y
        scale = max(values.max(initial=0), locked_values.max(initial=0), EPS * trace)
        tolerance = 32 * EPS * np.sqrt(d) * scale
        residual = au[:, :want] - u[:, :want] * values[:want]
        residual -= locked @ (locked.T @ residual)
        norms = np.linalg.norm(residual, axis=0)
        whole = v.shape[1] + locked.shape[1] == d
        worst = norms.max(initial=0)
        best, stuck = (worst, 0) if worst < best / 2 else (best, stuck + 1)
        # at the floor of rounding a residual no longer falls
        done = (norms <= tolerance) | ((stuck >= 3 or whole) & (norms <= 50 * tolerance))
        # locked in order, so that a larger value found late isn't missed
        first = int(np.argmin(done)) if not done.all() else len(done)
        if first:
            locked, locked_values = np.hstack([locked, u[:, :first]]), np.append(locked_values, values[:first])
            best, stuck = np.inf, 0
        if locked.shape[1] >= k:
            order = np.argsort(-locked_values, kind="stable")
            locked = np.linalg.qr(locked[:, order])[0]
            again = a(locked)  # the final word: Rayleigh-Ritz and residuals with a product of their own
            h = locked.T @ again
            locked_values, y = np.linalg.eigh((h + h.T) / 2)
            locked_values, locked, again = locked_values[::-1], (locked @ y)[:, ::-1], (again @ y)[:, ::-1]
            final = np.linalg.norm(again - locked * locked_values, axis=0)
            if (final <= 50 * tolerance).all():
                return locked_values, locked, final
            v, av = locked, again
            locked, locked_values, best, stuck = np.empty((d, 0)), np.empty(0), np.inf, 0
            continue
        u, au, values, residual, norms = u[:, first:], au[:, first:], values[first:], residual[:, first:], norms[first:]
        want -= first
        open_pairs = np.flatnonzero(~done[first:])
        if u.shape[1] + len(open_pairs) > most - locked.shape[1]:  # restart from the best directions
            keep = max(want, min(u.shape[1], block))
            u, au = u[:, :keep], au[:, :keep]
        keep_off = np.hstack([locked, u[:, :want]])
        t = minres_corrections(a, values[open_pairs], residual[:, open_pairs], keep_off, inner, 0.1)
        t = _orthonormal(np.hstack([t, residual[:, open_pairs]]) if stuck else t, locked, u)
        v, av = u, au
        if not t.shape[1]:  # corrections add nothing: a fresh direction, unless there is none
            t = _orthonormal(np.random.default_rng(seed + v.shape[1]).standard_normal((d, block)), locked, u)
        if t.shape[1]:
            v, av = np.hstack([u, t]), np.hstack([au, a(t)])
    raise ArithmeticError(f"residuals {norms} after {rounds} rounds")


@dataclass
class Whitening:
    """Components with a variance, by falling variance, and how far whitened fit vectors are from unit covariance."""

    centre: Centre
    values: np.ndarray
    vectors: np.ndarray
    explained: np.ndarray
    identity_error: float
    residuals: np.ndarray
    products: int


def fit(rows: DataFrame, components: int = 16, subspace: int | None = None) -> Whitening | None:
    """The components of ``rows`` (see ``whole_vectors``); None without any vector."""
    found = fit_list(rows)
    if found is None:
        return None
    blocks, centre = found
    cov = Covariance(blocks, centre)
    d, n, trace = cov.d, cov.n, cov.trace
    if not trace > 0:
        none = np.empty(0)
        return Whitening(centre, none, np.empty((d, 0)), none, 0.0, none, cov.products)
    values, vectors, residuals = leading_pairs(cov.times, d, components, trace, subspace)
    real = values > d * EPS * values[0] * 64
    values, vectors, residuals = values[real], vectors[:, real], residuals[real]
    turned = vectors / np.sqrt(values)

    def moments(c):
        z = c.reshape(-1, d) @ turned
        return np.append((z.T @ z).ravel(), z.sum(axis=0))

    k = len(values)
    m = _summed(blocks, k * k + k, moments) / n
    second, mean = m[: k * k].reshape(k, k), m[k * k :]
    error = float(np.abs(second - np.outer(mean, mean) - np.eye(k)).max(initial=0))
    return Whitening(centre, values, vectors, values / trace, error, residuals, cov.products)


def whiten(vectors: DataFrame, components: int = 16, subspace: int | None = None, id_col: str = "vec_id",
           vector_col: str = "embedding") -> DataFrame:
    """One row for each row that takes part and each component: ``id, component, n, deviation, whitened, explained, identity_error``.

    ``component`` counts from 1; ``deviation`` is the sum over dimensions of (n x - sum)^2.
    """
    schema = T.StructType([T.StructField(id_col, vectors.schema[id_col].dataType), T.StructField("component", T.IntegerType()),
                           T.StructField("n", T.LongType()), T.StructField("deviation", T.LongType()), T.StructField("whitened", T.DoubleType()),
                           T.StructField("explained", T.DoubleType()), T.StructField("identity_error", T.DoubleType())])
    rows = whole_vectors(vectors, id_col, vector_col)
    w = fit(rows, components, subspace)
    if w is None or not len(w.values):
        return rows.limit(0).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields])
    d, k, turned = len(w.centre.sums), len(w.values), w.vectors / np.sqrt(w.values)
    own, explained, error = w.centre, w.explained, w.identity_error

    def run(batches):
        for b in batches:
            for at in range(0, b.num_rows, 2048):
                part = b.slice(at, 2048)
                ids, m = part.column(0), part.num_rows
                scaled = own.scaled(_matrix(part.column(1), d))
                most = int(np.abs(scaled).max())
                if most * most * d < 1 << 63:
                    deviation = pa.array(np.square(scaled).sum(axis=1))
                else:
                    sums = (scaled.astype(object) ** 2).sum(axis=1)
                    deviation = pa.array([int(s) if s < 1 << 63 else None for s in sums], pa.int64())
                z = (scaled.astype(np.float64) / own.n) @ turned
                each = pa.array(np.repeat(np.arange(m), k))
                yield pa.RecordBatch.from_arrays(
                    [ids.take(each), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)), pa.array(np.full(m * k, own.n)),
                     deviation.take(each), pa.array(z.ravel()), pa.array(np.tile(explained, m)), pa.array(np.full(m * k, error))],
                    names=schema.fieldNames())

    return rows.mapInArrow(run, schema)
