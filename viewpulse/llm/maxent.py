"""Language-model scores by a hashed maximum-entropy model (operator 6).

The next token is predicted in two steps: its class, then the token within its class, each a softmax over
weights of hashed features: the token before, the pair before, and the token two back (a skip feature).
The most frequent tokens fill classes of equal size, in order of frequency; one more class stands for all other tokens and is the root
of a tree, each node of which is a softmax of the same kind over at most ``width`` children.  The tokens of the head have places of their own in
the tree, by falling count.  All rarer tokens are dealt by their hash to leaves, whose number grows with the token types, ``per_leaf`` types
to a leaf on average; the tokens of a leaf share its probability by their counts, one added to each, with one place for unseen tokens.
So every text has a probability, and every known token is predicted from the tokens before it.

Training is distributed: in each round tasks run gradient steps over their documents of that round from the same weights, and the changes are
averaged, weight by weight, by how often each task used it.  The rounds cover every training document once.  Documents are scored in
numpy batches.  Counts of all training tokens are exact and stay distributed: tokens with one of the ``head``
largest counts are looked up in the tasks, all others are joined by a shuffle.

The weights are two tables of ``buckets`` x ``width`` and one of four times that for the tree; unless given, the buckets grow with the square root
of the types.
Bounded by parameters: the head, and the tasks that train at once (``workers``; by default one a core, 512 at most).
64-bit hashes stand for tokens in the model's features and in the lookup of the head.

Null texts are empty: a single end token.  Rows with a null id are scored but do not teach.  Repeated rows teach and are
scored each.  Without training rows all counts are zero and the model is the one unseen token.
Columns other than id and text are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from viewpulse.llm.common import cut, text_or_empty
from viewpulse.llm.slices import U, byte_table, mix, parts, slice_hashes, words

#: Stands for the end token in tables of counts; no token holds white space.
END = b" "
END_HASH, START_HASH = U(0x1234567), U(0x7654321)
LOG10 = np.log(10.0)


def token_hashes(own: list[bytes]):
    """(hash of each token, its text, tokens of each text, the words' bytes): each text's words, then an end."""
    raw, starts, ends, count = words(own)
    table = byte_table(4)
    n = count + 1
    h = np.full(n.sum(), END_HASH, U)
    is_word = np.ones(len(h), bool)
    is_word[np.cumsum(n) - 1] = False
    if len(starts):
        h[is_word] = slice_hashes(raw, starts, ends, table)
    return h, np.repeat(np.arange(len(own)), n), n, (raw, starts, ends, is_word)


def hash_tokens(tokens: list[bytes]) -> np.ndarray:
    """The same hashes for a list of tokens."""
    out = np.empty(len(tokens), U)
    if tokens:
        size = np.array([len(t) for t in tokens])
        ends = np.cumsum(size)
        out[:] = slice_hashes(np.frombuffer(b"".join(tokens) or b"\0", np.uint8), ends - size, ends, byte_table(4))
    out[[i for i, t in enumerate(tokens) if t == END]] = END_HASH
    return out


class Tree:
    """Paths of the places of all tokens outside the classes; ``mass`` has the counts of each place, one added to each token.

    Up to ``width`` ^ 3 places have paths of equal length.  Of more, the first half of the root's children
    hold the most frequent ones, on paths of three nodes, and the other half all others.
    """

    def __init__(self, mass: np.ndarray, width: int):
        if width < 2:
            raise ValueError("width must be two or more")
        self.width, n, half = width, len(mass), width // 2
        short = half * width**2
        halves = [(0, 0, short, 2, 0), (short, short, n, 2, half)] if n > width**3 else [(0, 0, n, 0, 0)]
        self.groups, node = [], 1
        for start, _, end, k, digit in halves:
            while (width - digit if end == n else half) * width**k < end - start:
                k += 1
            bases = []
            for j in range(1, k + 1):
                bases.append(node)
                node += (end - start - 1) // width ** (k - j + 1) + 1
            self.groups.append((start, end, k, digit, bases))
        self.nodes = node
        at, child = (np.concatenate(x) for x in list(zip(*self.steps(np.arange(n)), strict=True))[1:])
        own = np.concatenate([mass[rows] for rows, _, _ in self.steps(np.arange(n))])
        self.mass = np.bincount(at * width + child, own, self.nodes * width).reshape(-1, width)

    def steps(self, slots: np.ndarray):
        """(indices into ``slots``, node, child) of each step of the paths."""
        out = []
        for start, end, k, digit, bases in self.groups:
            rows = np.flatnonzero((slots >= start) & (slots < end))
            if len(rows):
                o = slots[rows] - start
                out.append((rows, np.zeros(len(rows), np.int64), digit + o // self.width**k))
                for j, base in enumerate(bases, 1):
                    out.append((rows, base + o // self.width ** (k - j + 1), o // self.width ** (k - j) % self.width))
        return out


class Model:
    """Weights and counts; ``members`` are the tokens in classes, by falling count.

    ``others`` are further tokens with places of their own in the tree under the class of all others, with their counts,
    and ``leaves`` the counts of the leaves that all tokens without a place share by hash.
    """

    def __init__(self, members: list[bytes], counts: list[int], rest: int, buckets: int, width: int,
                 others: list[bytes] = (), other_counts: list[int] = (), leaves: np.ndarray | None = None):
        self.width, self.buckets = width, buckets
        self.size = len(members)
        self.classes = -(-self.size // width)
        h = hash_tokens([*members, *others])
        self.order = np.argsort(h)
        self.hashes = h[self.order]
        # the sorted hashes in slots by their leading bits, about four slots a token
        bits = max(1, (4 * len(h)).bit_length())
        self.shift = U(64 - bits)
        self.slots = np.append(0, np.cumsum(np.bincount((self.hashes >> self.shift).astype(np.int64), minlength=1 << bits)))
        self.n_others, self.n_leaves = len(others), 1 if leaves is None else len(leaves)
        mass = np.append(np.array(other_counts, float) + 1, [rest] if leaves is None else leaves)
        self.tree = Tree(mass, width) if len(mass) > 1 else None
        own = np.zeros(self.classes * width)
        own[: self.size] = np.array(counts, float) + 1
        by_class = np.append(rest, own.reshape(-1, width).sum(axis=1))
        self.class_bias = np.log(by_class / by_class.sum()).astype(np.float32)
        with np.errstate(divide="ignore"):
            self.word_bias = (np.log(own.reshape(-1, width)) - np.log(np.maximum(1, by_class[1:, None]))).astype(np.float32)
        if self.tree:
            with np.errstate(divide="ignore"):
                self.tree_bias = (np.log(self.tree.mass) - np.log(np.maximum(1, self.tree.mass.sum(axis=1, keepdims=True)))).astype(np.float32)
            self.tree.mass = None
            self.tree_bias[np.isinf(self.tree_bias)] = -1e9
            self.tree_weight = np.zeros((4 * buckets, width), np.float32)
        self.word_bias[np.isinf(self.word_bias)] = -1e9
        self.class_weight = np.zeros((buckets, self.classes + 1), np.float32)
        self.word_weight = np.zeros((buckets, width), np.float32)

    def tables(self) -> list[np.ndarray]:
        return [self.class_weight, self.word_weight, *([self.tree_weight] if self.tree else [])]

    def __setstate__(self, state: dict) -> None:
        self.__dict__.update(state)
        for name in ("class_weight", "word_weight", "tree_weight"):
            if name in state:
                setattr(self, name, aligned(state[name].shape))
                getattr(self, name)[:] = state[name]

    def numbers(self, h: np.ndarray) -> np.ndarray:
        """Number of each token among the members, then the others; -1 for all other tokens."""
        out = np.full(len(h), -1, np.int64)
        slot = (h >> self.shift).astype(np.int64)
        at, end = self.slots[slot], self.slots[slot + 1]
        left = np.flatnonzero(at < end)
        at, end = at[left], end[left]
        while len(left):
            hit = self.hashes[at] == h[left]
            out[left[hit]] = self.order[at[hit]]
            on = np.flatnonzero(~hit & (at + 1 < end))
            left, at, end = left[on], at[on] + 1, end[on]
        return out

    def places(self, h: np.ndarray, number: np.ndarray | None = None) -> np.ndarray:
        """Place of each token among the members; -1 - the place in the tree for others."""
        number = self.numbers(h) if number is None else number
        leaf = -1 - self.n_others - (h % U(self.n_leaves)).astype(np.int64)
        return np.where(number < 0, leaf, np.where(number < self.size, number, self.size - 1 - number))

    def leaf_of(self, place: np.ndarray) -> np.ndarray:
        """Leaf of each place, -1 for tokens with places of their own."""
        return np.maximum(-1, -1 - place - self.n_others)

    def features(self, h: np.ndarray, n: np.ndarray) -> np.ndarray:
        """Three hashes for each token from those before it in its text."""
        first = np.cumsum(n) - n
        one = np.concatenate([[START_HASH], h[:-1]]).astype(U)
        one[first] = START_HASH
        two = np.concatenate([[START_HASH], one[:-1]]).astype(U)
        two[first] = START_HASH
        return np.stack([mix(one), mix(one * U(3) + two), mix(two + U(77))], axis=1)

    def log_likelihood(self, f: np.ndarray, place: np.ndarray, learn=None) -> np.ndarray | None:
        """Natural log probability of class and path; ``learn``, if given, gets each table's number, buckets and gradients instead."""
        def step(t: int, bias: np.ndarray, at: np.ndarray, child: np.ndarray, node: np.ndarray | None = None) -> np.ndarray | None:
            found = softmax(bias, tables[t], at, child, learn is not None, node)
            if learn and len(at):
                learn(t, at, found)
            return None if learn else found

        tables = self.tables()
        own, below = np.flatnonzero(place >= 0), np.flatnonzero(place < 0)
        at = place.take(own)
        c, w = at // self.width + 1, at % self.width
        cls = np.zeros(len(place), np.int64)
        cls[own] = c
        out = step(0, self.class_bias, (f & U(self.buckets - 1)).view(np.int64), cls)
        inner = step(1, self.word_bias, self.mixed(f, own, c, self.buckets), w, c - 1)
        if not learn:
            out[own] += inner
        if self.tree and len(below):
            row, node, child = (np.concatenate(x) for x in zip(*self.tree.steps(-1 - place.take(below)), strict=True))
            inner = step(2, self.tree_bias, self.mixed(f, below.take(row), node, len(self.tree_weight)), child, node)
            if not learn:
                out[below] += np.bincount(row, inner, len(below))
        return out

    @staticmethod
    def mixed(f: np.ndarray, row: np.ndarray, node: np.ndarray, buckets: int) -> np.ndarray:
        """Buckets of the features of ``row`` at a node."""
        return (mix(f.take(row, axis=0) + (node.astype(U) * U(0x9E37))[:, None]) & U(buckets - 1)).view(np.int64)


#: Rows of logits at a time, which a core's cache holds.
ROWS = 2048


def aligned(shape: tuple[int, int]) -> np.ndarray:
    """An array of float32 that begins at a cache line, so that rows of 32 numbers lie in two lines, not three."""
    raw = np.empty(4 * shape[0] * shape[1] + 64, np.uint8)
    skip = -raw.ctypes.data % 64
    return raw[skip : skip + 4 * shape[0] * shape[1]].view(np.float32).reshape(shape)


def softmax(bias: np.ndarray, weight: np.ndarray, at: np.ndarray, child: np.ndarray, learn: bool, node: np.ndarray | None = None):
    """Log probability of ``child`` in each row; with ``learn``, the gradients of its logits.

    ``bias`` is for all rows, or with ``node`` has the row of each node.
    """
    n, width = len(at), weight.shape[1]
    one = np.ones(width, np.float32)
    out = aligned((n, width)) if learn else np.empty(n, np.float32)
    own_x = None if learn else aligned((min(n, ROWS), width))
    spare, start = aligned((min(n, ROWS), width)), np.arange(0, ROWS * width, width)
    for k in range(0, n, ROWS):
        own, to = at[k : k + ROWS], child[k : k + ROWS]
        x, y = out[k : k + ROWS] if learn else own_x[: len(own)], spare[: len(own)]
        chosen_at = start[: len(own)] + to
        logits(bias, weight, own, None if node is None else node[k : k + ROWS], x, y)
        chosen = None if learn else x.ravel().take(chosen_at)
        with np.errstate(over="ignore", invalid="ignore"):
            np.exp(x, out=x)
            total = x @ one
        if not (total.min() > 1e-20 and total.max() < 1e20):  # some logits must be moved before exp
            wide = np.flatnonzero(~((total > 1e-20) & (total < 1e20)))
            z = np.empty((len(wide), width), np.float32)
            logits(bias, weight, own[wide], None if node is None else node[k + wide], z, np.empty_like(z))
            z -= z.max(axis=1, keepdims=True)
            if not learn:
                chosen[wide] = z[np.arange(len(wide)), to[wide]]
            x[wide] = np.exp(z)
            total[wide] = x[wide].sum(axis=1)
        if learn:
            x *= (1 / total)[:, None]
            x.ravel()[chosen_at] -= 1
        else:
            out[k : k + ROWS] = chosen - np.log(total)
    return out


def logits(bias: np.ndarray, weight: np.ndarray, at: np.ndarray, node: np.ndarray | None, x: np.ndarray, spare: np.ndarray) -> None:
    """Write the sums of the rows ``at`` of ``weight`` and the bias into ``x``."""
    weight.take(at[:, 0], axis=0, out=x, mode="clip")  # "raise" would buffer the output; all indices are in range
    for j in range(1, at.shape[1]):
        x += weight.take(at[:, j], axis=0, out=spare, mode="clip")
    x += bias if node is None else bias.take(node, axis=0, out=spare, mode="clip")


def by_bucket(at: np.ndarray, gradient: np.ndarray):
    """(buckets, summed gradients, uses) of tokens with several buckets each."""
    buckets, order, first, uses = runs_of_buckets(at)
    return buckets, sums_of_runs(gradient, order, first, uses), uses


def runs_of_buckets(at: np.ndarray):
    """(bucket, order of the tokens, first, length) of the runs of equal buckets."""
    bits = len(at).bit_length()
    packed = (at << bits | np.arange(len(at))[:, None]).ravel()
    packed.sort()  # faster than a stable argsort
    sorted_at = packed >> bits
    first = np.flatnonzero(np.r_[True, sorted_at[1:] != sorted_at[:-1]])
    return sorted_at.take(first), packed & ((1 << bits) - 1), first, np.diff(np.append(first, len(packed)))


#: Rows of a run that are added one by one.
PIECE = 16


def sums_of_runs(x: np.ndarray, order: np.ndarray, first: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The sum of the rows ``x[order]`` of each run."""
    out = aligned((len(sizes), x.shape[1]))
    for runs, sums in blocks_of_runs(x, order, first, sizes):
        out[runs] = sums
    return out


def blocks_of_runs(x: np.ndarray, order: np.ndarray, first: np.ndarray, sizes: np.ndarray):
    """(runs, sums of their rows ``x[order]``), about ``ROWS`` runs at a time; the sums are overwritten by the next ones.

    The runs are taken by falling size, so that those with a k-th row are the first ones, and whole rows are added to them.
    Longer runs are added in pieces of ``PIECE`` rows, then their pieces in the same way.
    """
    longer = np.flatnonzero(sizes > PIECE)
    if len(longer):
        pieces = -(-sizes[longer] // PIECE)
        start = np.cumsum(pieces) - pieces
        before = PIECE * (np.arange(pieces.sum()) - np.repeat(start, pieces))
        part = sums_of_runs(x, order, np.repeat(first[longer], pieces) + before, np.minimum(PIECE, np.repeat(sizes[longer], pieces) - before))
        for runs, sums in blocks_of_runs(part, np.arange(len(part)), start, pieces):
            yield longer[runs], sums
    by_size = np.flatnonzero(sizes <= PIECE)
    by_size = by_size.take(np.argsort((PIECE - sizes.take(by_size)).astype(np.uint8), kind="stable"))  # a radix sort
    first, sizes = first.take(by_size), sizes.take(by_size)
    own, spare = (aligned((min(ROWS, len(by_size)), x.shape[1])) for _ in range(2))
    for k in range(0, len(by_size), ROWS):
        at, n = first[k : k + ROWS], sizes[k : k + ROWS]
        sums = x.take(order.take(at), axis=0, out=own[: len(at)], mode="clip")
        for j in range(1, n[0]):
            m = len(n) if n[-1] > j else np.count_nonzero(n > j)
            sums[:m] += x.take(order.take(at[:m] + j), axis=0, out=spare[:m], mode="clip")
        yield by_size[k : k + ROWS], sums


def train_task(model: Model, batches, rate: float, batch_tokens: int):
    """Gradient steps over a task's documents: changes and uses of each bucket of both tables."""
    tables = model.tables()
    start = [t.copy() for t in tables]
    squares = [np.zeros(len(t), np.float32) for t in tables]
    uses = [np.zeros(len(t), np.int64) for t in tables]
    spare = [aligned((ROWS, t.shape[1])) for t in tables]

    def learn(t: int, at: np.ndarray, gradient: np.ndarray) -> None:
        """A gradient step of a table."""
        buckets, order, first, times = runs_of_buckets(at)
        for runs, summed in blocks_of_runs(gradient, order, first, times):
            rows = buckets.take(runs)
            squared = squares[t].take(rows) + np.einsum("ij,ij->i", summed, summed) / np.float32(summed.shape[1])
            squares[t][rows] = squared
            summed *= (np.float32(rate if t < 2 else rate * TREE_RATE) / np.sqrt(squared + 1))[:, None]
            own = tables[t].take(rows, axis=0, out=spare[t][: len(rows)], mode="clip")
            own -= summed
            tables[t][rows] = own
        uses[t][buckets] += times

    for texts in batches:
        for _, own in parts(texts):
            h, _, n, _ = token_hashes(own)
            f, place = model.features(h, n), model.places(h)
            for k in range(0, len(h), batch_tokens):
                model.log_likelihood(f[k : k + batch_tokens], place[k : k + batch_tokens], learn)
    return [t - s for t, s in zip(tables, start, strict=True)], uses


BLOCK = 512
#: Share of the rate for the tree, whose rare contexts are learned from few tokens.
TREE_RATE = 0.25


def _average(key, table):
    """Mean change of a block of buckets over tasks, weighted by uses."""
    total = used = None
    for change, n in zip(table.column("change").to_pylist(), table.column("uses").to_pylist(), strict=True):
        n = np.frombuffer(n, np.int64).astype(np.float64)[:, None]
        change = np.frombuffer(change, np.float32).reshape(len(n), -1) * n
        total, used = (change, n) if total is None else (total + change, used + n)
    mean = (total / np.maximum(1, used)).astype(np.float32)
    return pa.table({"t": pa.array([key[0].as_py()], pa.int32()), "block": pa.array([key[1].as_py()], pa.int32()), "change": pa.array([mean.tobytes()], pa.binary())})


def train(model: Model, base: DataFrame, rounds: int, rate: float, workers: int, batch_tokens: int) -> None:
    """Update ``model`` over all of ``base`` (id, text), a part of the documents in each round."""
    def task(batches):
        changes, uses = train_task(model, (b.column(0).to_pylist() for b in batches), rate, batch_tokens)
        for t in range(len(changes)):
            for block in range(0, len(changes[t]), BLOCK):
                n = uses[t][block : block + BLOCK]
                if n.any():
                    yield pa.RecordBatch.from_pydict({"t": pa.array([t], pa.int32()), "block": pa.array([block], pa.int32()),
                                                      "change": [changes[t][block : block + BLOCK].tobytes()], "uses": [n.tobytes()]})

    for r in range(rounds):
        own = base.where(F.pmod(F.xxhash64("id", F.lit(17)), F.lit(rounds)) == r).select("text").coalesce(workers)
        changes = own.mapInArrow(task, "t int, block int, change binary, uses binary").groupBy("t", "block").applyInArrow(_average, "t int, block int, change binary")
        for row in changes.collect():  # tables of ``buckets`` rows, and of four times as many
            table = model.tables()[row["t"]]
            table[row["block"] : row["block"] + BLOCK] += np.frombuffer(row["change"], np.float32).reshape(-1, table.shape[1])


def count_tokens(base: DataFrame) -> DataFrame:
    """``token, n`` over all texts, ends included, written to the shared folder."""
    def run(batches):
        from collections import Counter

        found, docs = Counter(), 0
        for b in batches:
            for t in b.column(0).to_pylist():
                found.update(t.encode("utf-8", "surrogatepass").lower().split())
                docs += 1
            if len(found) > 400_000:
                yield pa.RecordBatch.from_pydict({"token": pa.array(list(found), pa.binary()), "n": pa.array(list(found.values()), pa.int64())})
                found.clear()
        if docs:
            found[END] = docs
        yield pa.RecordBatch.from_pydict({"token": pa.array(list(found), pa.binary()), "n": pa.array(list(found.values()), pa.int64())})

    rows = base.select("text").mapInArrow(run, "token binary, n long")
    return cut(rows.groupBy("token").agg(F.sum("n").alias("n")), "maxent-counts")


def leaf_counts(tail: DataFrame, leaves: int) -> np.ndarray:
    """Counts of each leaf's tokens, one added to each and to the place of unseen tokens."""
    def run(batches):
        for b in batches:
            own = b.column(0).cast(pa.binary())
            ends = np.frombuffer(own.buffers()[1], np.int32)[own.offset : own.offset + len(own) + 1].astype(np.int64)
            raw = np.frombuffer(own.buffers()[2], np.uint8)[ends[0] : ends[-1]]
            h = slice_hashes(raw, ends[:-1] - ends[0], ends[1:] - ends[0], byte_table(4))
            yield pa.RecordBatch.from_pydict({"leaf": pa.array((h % U(leaves)).astype(np.int64)), "n": b.column(1)})

    def pack(key, table):
        own = pa.table({"block": [key[0].as_py()], "leaf": [table.column("leaf").to_numpy().astype(np.int64).tobytes()],
                        "n": [table.column("n").to_numpy().astype(np.int64).tobytes()]})
        return own

    rows = tail.select("token", "n").mapInArrow(run, "leaf long, n long").groupBy("leaf").agg(F.sum(F.col("n") + 1).alias("n"))
    blocks = rows.withColumn("block", F.floor(F.col("leaf") / 4096)).groupBy("block").applyInArrow(pack, "block long, leaf binary, n binary")
    out = np.ones(leaves)
    for r in blocks.collect():  # 16 bytes a leaf
        out[np.frombuffer(r["leaf"], np.int64)] += np.frombuffer(r["n"], np.int64)
    return out


def score(docs: DataFrame, learn: Column, id_col: str = "doc_id", text_col: str = "text", classes: int = 31, width: int = 32,
          buckets: int | None = None, per_leaf: int = 16, head: int = 1 << 17, rounds: int = 3, rate: float = 0.3, workers: int | None = None,
          batch_tokens: int = 8192) -> DataFrame:
    """``id, n_tokens, n_known, train_tokens, base_score, score`` of every row; ``learn`` is a condition over ``id_col``.

    ``base_score`` is the log10 probability under add-one counts, ``score`` under the model.
    """
    base = docs.select(F.col(id_col).alias("id"), text_or_empty(text_col).alias("text"))
    taught = docs.where(F.coalesce(learn, F.lit(False))).select(F.col(id_col).alias("id"), text_or_empty(text_col).alias("text"))
    counts = count_tokens(taught)
    # the counts that occur and how often: their number grows with the root of the tokens at most
    by_n = sorted(((r["n"], r["types"]) for r in counts.groupBy("n").agg(F.count("*").alias("types")).collect()), reverse=True)
    types, n_train = sum(k for _, k in by_n), sum(n * k for n, k in by_n)
    # the head: all tokens above the head-th largest count, so at most ``head`` short tokens reach the driver
    larger = np.cumsum([k for _, k in by_n])
    least_n = by_n[int(np.searchsorted(larger, head))][0] if types > head else 0
    top = sorted(((bytes(r["token"]), r["n"]) for r in counts.where(F.col("n") > least_n).collect()), key=lambda x: (-x[1], x[0]))
    if types and END not in {t for t, _ in top}:
        top.append((END, counts.where(F.col("token") == F.lit(END)).first()["n"]))
    members = top[: classes * width]
    if members and END not in {t for t, _ in members}:
        members[-1] = next(x for x in top if x[0] == END)
    own = {t for t, _ in members}
    others = [x for x in top if x[0] not in own]
    leaves = np.ones(1)
    if types > len(top):
        leaves = leaf_counts(counts.where((F.col("n") <= least_n) & (F.col("token") != F.lit(END))), -(-(types - len(top)) // per_leaf))
    rest = sum(n + 1 for _, n in others) + leaves.sum()
    buckets = buckets or max(1 << 14, 1 << int(np.log2(16 * np.sqrt(types + 1))))
    model = Model([t for t, _ in members], [n for _, n in members], rest, buckets, width, [t for t, _ in others], [n for _, n in others], leaves)
    if members:
        # one task a core at most: each task sends its changes of all three tables
        train(model, taught, rounds, rate, workers or min(512, docs.sparkSession.sparkContext.defaultParallelism), batch_tokens)

    log_n = np.log10(np.array([n for _, n in [*members, *others]] + [0], np.int64) + 1.0)  # the last one is for number -1
    leaf_total = np.log10(leaves)

    def run(batches):
        for b in batches:
            size = b.num_rows
            n_tokens, known, n_others = np.zeros(size, np.int64), np.zeros(size, np.int64), np.zeros(size, np.int64)
            counted, inner = np.zeros(size), np.zeros(size)
            tokens, times = [], [np.empty(0, np.int64)]
            for at, own in parts(b.column(1).to_pylist(), 1 << 18):
                h, owner, n, (raw, starts, ends, is_word) = token_hashes(own)
                number = model.numbers(h)
                found = number >= 0
                n_tokens[at] = n
                known[at] = np.bincount(owner, found, len(own)).astype(np.int64)
                counted[at] = np.bincount(owner, log_n[number], len(own))
                member = model.places(h, number)
                f = model.features(h, n)
                ll = np.concatenate([model.log_likelihood(f[k : k + 8192], member[k : k + 8192]) for k in range(0, len(h), 8192)]) / LOG10
                # tokens in leaves share them by count, which is added after the join
                leaf = model.leaf_of(member)
                ll = ll - np.where(leaf >= 0, leaf_total[leaf], 0.0)
                inner[at] = np.bincount(owner, ll, len(own))
                word = np.flatnonzero(~found & is_word)
                if len(word):
                    key = mix(h[word] + owner[word].astype(U) * U(0x9E3779B97F4A7C15))
                    order = np.argsort(key)
                    first = np.flatnonzero(np.r_[True, np.diff(key[order]) != 0])
                    one, uses = word[order[first]], np.diff(np.append(first, len(word)))
                    by_text = np.argsort(one)
                    one = one[by_text]
                    times.append(uses[by_text])
                    n_others[at] = np.bincount(owner[one], minlength=len(own))
                    number, buffer = np.cumsum(is_word)[one] - 1, raw.tobytes()
                    tokens += [buffer[i:j] for i, j in zip(starts[number].tolist(), ends[number].tolist(), strict=True)]
            rare = pa.StructArray.from_arrays([pa.array(tokens, pa.binary()), pa.array(np.concatenate(times))], names=["token", "times"])
            rare = pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(n_others)), pa.int32()), rare)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(2), pa.array(n_tokens), pa.array(known), pa.array(counted), pa.array(inner), rare],
                names=["id", "row", "n_tokens", "known", "counted", "inner", "others"])

    schema = T.StructType([
        T.StructField("id", docs.schema[id_col].dataType), T.StructField("row", T.LongType()), T.StructField("n_tokens", T.LongType()),
        T.StructField("known", T.LongType()), T.StructField("counted", T.DoubleType()), T.StructField("inner", T.DoubleType()),
        T.StructField("others", T.ArrayType(T.StructType([T.StructField("token", T.BinaryType()), T.StructField("times", T.LongType())])))])
    rows = cut(base.withColumn("row", F.monotonically_increasing_id()).mapInArrow(run, schema), "maxent-rows")
    tail = rows.select("row", F.explode("others").alias("o")).select("row", F.col("o.token").alias("token"), F.col("o.times").alias("times"))
    # a hash of the counts, whose tokens differ, spares sorting the texts' tokens; its size a partition is bounded by their number
    tail = tail.join(counts.hint("shuffle_hash"), "token").groupBy("row").agg(
        F.sum("times").alias("more_known"), F.sum(F.col("times") * F.log10(F.col("n") + 1.0)).alias("more"))
    more, zero = F.coalesce("more", F.lit(0.0)), F.lit(0)
    total = np.log10(n_train + types + 1)
    return rows.join(tail, "row", "left").select(
        F.col("id").alias(id_col), "n_tokens", (F.col("known") + F.coalesce("more_known", zero)).alias("n_known"),
        F.lit(n_train).cast("long").alias("train_tokens"), (F.col("counted") + more - F.col("n_tokens") * float(total)).alias("base_score"),
        (F.col("inner") + more).alias("score"))
