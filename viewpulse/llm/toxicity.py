"""Toxicity by the nearest labelled examples (operator 10).

The examples are vectors of TF-IDF weights over the terms that tell the labels
apart best (by chi-squared, and only where it is significant).  They are held in an inverted index whose postings are cut into
blocks of examples, each with the largest weight that a term has in it.  A
document's nearest examples are found exactly: a block is opened only when the
sum of its largest weights reaches the k-th best cosine so far.  The votes of
the neighbours, weighted by cosine, are turned into a probability by a logistic
curve fitted on labelled rows that are not in the index.

What is bounded, by documented parameters: the labelled rows used for fitting
(``per_class`` examples a label, ``calibration_rows``), the terms
(``n_terms``).  Document frequencies come from all documents, and every whole
text is scored.

Null texts are empty; a text without any known term gets the share of toxic rows
among such calibration rows.  A null id never teaches.  Repeated rows give
repeated results; equal cosines go to the smaller example id.  Without any
labelled row of both labels every score is the share of toxic labels
(0 without labels).  Columns other than the id and text are ignored.
"""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from viewpulse.llm.common import concat_ranges, cut, text_or_empty

WORD = re.compile(r"\w+")
#: Characters of a word's start that count as a term too, for inflected words.
PREFIX = 6


def words_of(text: str) -> list[str]:
    return WORD.findall(text.lower())


def distinct_terms(text: str) -> set[str]:
    """Words, and the starts of longer words marked by a caret."""
    words = set(words_of(text))
    return words | {"^" + w[:PREFIX] for w in words if len(w) > PREFIX}


class Vocabulary:
    """Term numbers; counting a text looks each distinct word up once."""

    def __init__(self, terms: list[str]):
        self.number = {t: i for i, t in enumerate(terms)}
        self.memo: dict[str, tuple[int, ...]] = {}

    def of_word(self, word: str) -> tuple[int, ...]:
        found = self.memo.get(word)
        if found is None:
            own = [self.number.get(word), self.number.get("^" + word[:PREFIX]) if len(word) > PREFIX else None]
            found = tuple(i for i in own if i is not None)
            if len(self.memo) > 300_000:
                self.memo.clear()
            self.memo[word] = found
        return found

    def counts(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """Sorted term numbers of a text and how often each occurs."""
        total: dict[int, int] = {}
        for word, n in Counter(words_of(text)).items():
            found = self.memo.get(word)
            for i in self.of_word(word) if found is None else found:
                total[i] = total.get(i, 0) + n
        ids = np.array(sorted(total), np.int32)
        return ids, np.array([total[i] for i in ids.tolist()], np.int32)


def unit_weights(ids: np.ndarray, counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """(1 + ln tf) * idf, scaled to length one (empty for no terms)."""
    w = (1.0 + np.log(counts)) * idf[ids]
    norm = np.sqrt(np.dot(w, w))
    return w / norm if norm > 0 else w


class BlockMaxIndex:
    """Postings by (term, block of examples) with the block's largest weight."""

    def __init__(self, example_ids, labels, vectors, n_terms: int, block: int = 64):
        self.ids = np.asarray(example_ids, np.int64)
        self.labels = np.asarray(labels, np.float64)
        self.block, self.n_blocks = block, -(-len(self.ids) // block)
        lengths = [len(v[0]) for v in vectors]
        example = np.repeat(np.arange(len(vectors)), lengths)
        term = np.concatenate([v[0] for v in vectors] or [np.empty(0, np.int64)]).astype(np.int64)
        weight = np.concatenate([v[1] for v in vectors] or [np.empty(0)]).astype(np.float64)
        order = np.lexsort((example, term))
        self.example, self.weight, term = example[order], weight[order], term[order]
        cell = term * self.n_blocks + self.example // block
        first = np.flatnonzero(np.r_[True, cell[1:] != cell[:-1]]) if len(cell) else np.empty(0, np.int64)
        self.cell_start = np.append(first, len(cell))
        self.cell_block = cell[first] % max(1, self.n_blocks)
        self.cell_max = np.maximum.reduceat(self.weight, first) if len(first) else np.empty(0)
        self.term_cells = np.searchsorted(cell[first] // max(1, self.n_blocks), np.arange(n_terms + 1))

    def nearest(self, ids: np.ndarray, weights: np.ndarray, k: int) -> list[tuple[int, float]]:
        """The k (example number, cosine) of largest positive cosine, ties to the smaller example id."""
        if not len(ids) or not len(self.ids):
            return []
        n_cells = self.term_cells[ids + 1] - self.term_cells[ids]
        cells = concat_ranges(self.term_cells[ids], n_cells)
        if not len(cells):
            return []
        q, block_of = np.repeat(weights, n_cells), self.cell_block[cells]
        bound = np.bincount(block_of, q * self.cell_max[cells], self.n_blocks)
        best_first = np.argsort(-bound, kind="stable")
        score = np.zeros(self.n_blocks * self.block)
        opened = np.zeros(self.n_blocks, bool)

        def open_blocks(blocks):
            opened[blocks] = True
            chosen = np.zeros(self.n_blocks, bool)
            chosen[blocks] = True
            use = chosen[block_of]
            own = cells[use]
            n = self.cell_start[own + 1] - self.cell_start[own]
            at = concat_ranges(self.cell_start[own], n)
            np.add.at(score, self.example[at], np.repeat(q[use], n) * self.weight[at])

        first = best_first[: max(2, -(-2 * k // self.block))]
        open_blocks(first)
        near = score.reshape(self.n_blocks, self.block)[first].ravel()  # all others are still zero
        near = near[near > 0]
        kth = np.partition(near, -k)[-k] if len(near) >= k else 0.0
        # the margin covers rounding in sums of the same products in another order
        rest = np.flatnonzero(~opened & (bound > 0) & (bound >= kth - 1e-9))
        if len(rest):
            open_blocks(rest)
        found = np.flatnonzero(score >= kth) if kth > 0 else np.flatnonzero(score > 0)
        if len(found) > k:
            kth = np.partition(score[found], -k)[-k]
            found = found[score[found] >= kth]
        found = found[np.lexsort((self.ids[found], -score[found]))][:k]
        return list(zip(found.tolist(), score[found].tolist(), strict=True))


def vote(index: BlockMaxIndex, near: list[tuple[int, float]]) -> float:
    """Share of the neighbours' squared cosines that belongs to toxic examples (-1 without neighbours)."""
    if not near:
        return -1.0
    at = np.array([i for i, _ in near])
    w = np.array([s for _, s in near]) ** 2
    return float(np.dot(w, index.labels[at]) / w.sum())


def fit_curve(votes: np.ndarray, labels: np.ndarray, prior: float) -> tuple[float, float, float]:
    """Slope and offset of P(toxic | vote), and P(toxic) without neighbours.

    Newton steps on the logistic likelihood with one pseudo-row at either end,
    which keeps the slope finite on separable votes.
    """
    none = votes < 0
    without = (labels[none].sum() + prior) / (none.sum() + 1.0)
    x = np.append(votes[~none], [0.0, 1.0])
    y = np.append(labels[~none], [0.0, 1.0])
    a, b = 4.0, -2.0
    for _ in range(50):
        p = 1 / (1 + np.exp(-(a * x + b)))
        g = np.array([np.dot(p - y, x) + 0.01 * a, (p - y).sum()])
        w = p * (1 - p) + 1e-9
        h = np.array([[np.dot(w, x * x) + 0.01, np.dot(w, x)], [np.dot(w, x), w.sum()]])
        step = np.linalg.solve(h, g)
        step *= min(1.0, 4.0 / max(1e-12, np.abs(step).max()))
        a, b = a - step[0], b - step[1]
        if np.abs(step).max() < 1e-8:
            break
    return float(a), float(b), float(without)


def _sample(labelled: DataFrame, per_class: int, calibration_rows: int) -> DataFrame:
    """Ids, labels and use of the rows to fit on.

    A hash of the id deals a third of the rows to calibration, so that it has the labels' own
    shares, and the others to the examples; of either the first by another hash are taken.
    """
    dealt = labelled.select("id", "label", F.xxhash64("id").alias("h")).withColumn("third", F.pmod(F.xxhash64("h", F.lit(1)), F.lit(3)))
    parts = [dealt.where((F.col("third") > 0) & (F.col("label") == label)).orderBy("h", "id").limit(per_class).withColumn("use", F.lit("example"))
             for label in (0, 1)]
    held = dealt.where("third = 0").orderBy("h", "id").limit(calibration_rows).withColumn("use", F.lit("calibration"))
    return parts[0].unionByName(parts[1]).unionByName(held).select("id", "label", "use")


def _term_table(labelled_texts: DataFrame, n_terms: int, least_chi: float) -> list[tuple[str, float]]:
    """The terms with the largest chi-squared of presence against the label, above ``least_chi`` (at most ``n_terms``)."""

    def count(batches):
        toxic, clean = Counter(), Counter()
        for b in batches:
            for text, label in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                (toxic if label else clean).update(distinct_terms(text))
        terms = list(toxic.keys() | clean.keys())
        for i in range(0, len(terms), 50_000):
            part = terms[i : i + 50_000]
            yield pa.RecordBatch.from_pydict({"term": part, "toxic": [toxic[t] for t in part], "clean": [clean[t] for t in part]})

    rows = labelled_texts.select("text", "label").mapInArrow(count, "term string, toxic long, clean long")
    n = labelled_texts.agg(F.sum("label").alias("p"), F.count("*").alias("n")).first()
    p, q = float(n["p"] or 0), float((n["n"] or 0) - (n["p"] or 0))
    if not p or not q:
        return []
    by_term = rows.groupBy("term").agg(F.sum("toxic").alias("a"), F.sum("clean").alias("b"))
    a, b = F.col("a"), F.col("b")
    expected = (a + b) * F.lit(p / (p + q))
    chi = (a - expected) * (a - expected) / (expected * F.lit(q / (p + q)) * (1 - (a + b) / F.lit(p + q + 1.0)))
    top = by_term.where(a + b >= 3).select("term", chi.alias("chi")).where(F.col("chi") >= least_chi).orderBy(F.desc("chi"), "term").limit(n_terms)
    return [(r["term"], r["chi"]) for r in top.collect()]


def score(docs: DataFrame, labels: DataFrame, learn, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "toxic", row_col: str | None = None, k: int = 15, per_class: int = 4096, calibration_rows: int = 8192,
          n_terms: int = 4096, least_chi: float = 4.0) -> DataFrame:
    """Score every row of ``docs``.

    ``learn`` is a condition over ``id_col`` that says which labelled rows may teach.
    Returns ``id, score, neighbours (array of struct of id, label, cosine)`` where
    ``id`` has the name of ``id_col``; ``row_col``, a column of ``docs``, is returned too, as text, when named.
    """
    id_type = docs.schema[id_col].dataType
    row = (F.col(row_col) if row_col else F.lit(None)).cast("string")
    base = docs.select(F.col(id_col).alias("id"), text_or_empty(text_col).alias("text"), row.alias("row"))
    labelled = (labels.where(learn & F.col(id_col).isNotNull() & F.col(label_col).isin(0, 1))
                .groupBy(F.col(id_col).cast(id_type).alias("id")).agg(F.max(F.col(label_col).cast("int")).alias("label")))
    use = cut(_sample(labelled, per_class, calibration_rows), "toxicity-sample")
    # at most 2 * per_class + calibration_rows rows of three small columns
    chosen = cut(base.join(F.broadcast(use), "id"), "toxicity-fit").dropDuplicates(["id"])
    chosen = cut(chosen, "toxicity-fit")
    terms = sorted(t for t, _ in _term_table(chosen.where("use = 'example'"), n_terms, least_chi))

    def vectorise(batches):
        own = Vocabulary(terms)
        for b in batches:
            got = [own.counts(t) for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([g[0] for g in got], pa.list_(pa.int32())), pa.array([g[1] for g in got], pa.list_(pa.int32())), b.column(2)],
                names=["id", "terms", "counts", "row"])

    vector = T.StructType([T.StructField("id", id_type), T.StructField("terms", T.ArrayType(T.IntegerType())),
                           T.StructField("counts", T.ArrayType(T.IntegerType())), T.StructField("row", T.StringType())])
    vectors = cut(base.mapInArrow(vectorise, vector), "toxicity-vectors")

    n_docs = vectors.count()
    df = np.zeros(len(terms))
    for r in vectors.select(F.explode("terms").alias("t")).groupBy("t").count().collect():  # at most n_terms rows
        df[r["t"]] = r["count"]
    idf = np.log((1.0 + n_docs) / (1.0 + df)) + 1.0

    fitted = chosen.select("id", "text", "row").mapInArrow(vectorise, vector).join(chosen.select("id", "label", "use"), "id")
    fitted = fitted.select("id", "label", "use", "terms", "counts").collect()  # bounded by the sample's parameters
    rows = sorted(((r["id"], r["label"], r["use"], np.array(r["terms"], np.int32), np.array(r["counts"], np.int32)) for r in fitted),
                  key=lambda r: (r[2], r[1], r[0]))
    own = [(r[0], r[1], (r[3], unit_weights(r[3], r[4], idf))) for r in rows if r[2] == "example"]
    numeric = isinstance(id_type, T.NumericType)
    names = [r[0] for r in own]
    order = names if numeric else list(range(len(names)))
    index = BlockMaxIndex(order, [r[1] for r in own], [r[2] for r in own], len(terms))
    held = [r for r in rows if r[2] == "calibration"]
    votes = np.array([vote(index, index.nearest(r[3], unit_weights(r[3], r[4], idf), k)) for r in held] or [-1.0])
    truth = np.array([float(r[1]) for r in held] or [0.0])
    both = len({r[1] for r in own}) == 2
    known = [float(r[1]) for r in held] or [float(r[1]) for r in own]
    prior = sum(known) / len(known) if known else 0.0
    a, b, without = fit_curve(votes, truth, prior) if both and held else (8.0, -4.0, prior)
    marks = [int(r[1]) for r in own]

    def judged_vector(ids, counts):
        ids, counts = np.array(ids, np.int64), np.array(counts, np.float64)
        near = index.nearest(ids, unit_weights(ids, counts, idf), k)
        v = vote(index, near)
        score = prior if not both else without if v < 0 else float(1 / (1 + np.exp(-(a * v + b))))
        return score, [{"id": names[i], "label": marks[i], "cosine": s} for i, s in near]

    def judge(batches):
        memo = {}  # equal vectors come to few tasks, which judge them once; emptied when full
        for batch in batches:
            scores, evidence = [], []
            for ids, counts in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                vector = (tuple(ids), tuple(counts))
                found = memo.get(vector)
                if found is None:
                    found = judged_vector(ids, counts)
                    if len(memo) >= 20_000:
                        memo.clear()
                    memo[vector] = found
                scores.append(found[0])
                evidence.append(found[1])
            near_type = pa.list_(pa.struct([("id", batch.column(0).type), ("label", pa.int32()), ("cosine", pa.float64())]))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores, pa.float64()), pa.array(evidence, near_type), batch.column(3)],
                                             names=["id", "score", "neighbours", "row"])

    near = T.ArrayType(T.StructType([T.StructField("id", id_type), T.StructField("label", T.IntegerType()),
                                     T.StructField("cosine", T.DoubleType())]))
    out = T.StructType([T.StructField("id", id_type), T.StructField("score", T.DoubleType()), T.StructField("neighbours", near),
                        T.StructField("row", T.StringType())])
    # judging costs far more than its input's bytes tell, so vectors are dealt out by number; equal ones to eight tasks at most
    spread = [F.hash("terms", "counts"), F.pmod(F.xxhash64("id", "row"), F.lit(8))]
    judged = vectors.repartition(max(1, -(-n_docs // 4096)), *spread).mapInArrow(judge, out)
    return judged.select(F.col("id").alias(id_col), "score", "neighbours", *([F.col("row").alias(row_col)] if row_col else []))
