"""Secrets by fixed patterns and by character Markov models (operator 4).

Base spans are the matches of three patterns.  The method adds long runs of token
characters that a first-order Markov model of random strings explains better
than one of ordinary identifiers, by log-likelihood ratio.  The models are trained
on labelled samples.  By default these come from the documents themselves: the
values in base spans that hold letters and digits are random strings, other values are no samples, all other runs are ordinary.
Transitions are counted over all documents; the model has one number for each
pair of characters.  Ordinary identifiers are also made of the words of the ordinary sample: joined by separators as in paths,
names and drawn lines, or with a capital at the joint, in the shares in which words end and begin.

Null texts are empty and have no spans.  Texts of any length are searched whole; the work of a text grows with its length.  Without samples of both labels no span is added.
Repeated rows give repeated results; offsets count code points, ends are exclusive.
Columns other than the text stay as they are.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from viewpulse.llm.common import text_or_empty

#: The three base patterns.  The length of a value is tested after matching, as a short match takes its text.
ASSIGN = re.compile(r"""(?ai:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(r"AKIA[A-Z0-9]{12,}")
HEX = re.compile(r"[0-9a-f]{32,}")
WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
KINDS = ("assign", "access", "hex", "markov")

#: Characters that models know, and that candidate runs are made of.
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
STATES = len(ALPHABET) + 1
PRIOR = 5.0
#: Characters that join the words of ordinary identifiers, and how many joints of each kind a word of the sample stands for.
JOINTS, PER_WORD = "/_-=+", 0.05
_STATE = np.zeros(129, np.int16)
_STATE[[ord(c) for c in ALPHABET]] = np.arange(1, STATES)


def states(text: str) -> np.ndarray:
    """The state of each code point; 0 is the outside of a run."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    return _STATE[np.minimum(points, 128)]


def runs(s: np.ndarray, least: int) -> list[tuple[int, int]]:
    inside = np.concatenate([[False], s > 0, [False]])
    edge = np.flatnonzero(inside[1:] != inside[:-1])
    starts, ends = edge[::2], edge[1::2]
    long = ends - starts >= least
    return list(zip(starts[long].tolist(), ends[long].tolist(), strict=True))


def base_spans(text: str, s: np.ndarray) -> list[tuple[int, int, int, int]]:
    """(start, kind number, end, start of the value) of the base matches.

    All characters of access keys and hex strings are in the alphabet, so only
    long runs are searched for them.
    """
    found = []
    low = text.lower()
    if any(w in low for w in WORDS):
        found += [(m.start(), 0, m.end(), m.start(1)) for m in ASSIGN.finditer(text) if m.end(1) - m.start(1) >= 8]
    for a, b in runs(s, 16):
        part = text[a:b]
        if "AKIA" in part:
            found += [(a + m.start(), 1, a + m.end(), a + m.start()) for m in ACCESS.finditer(part)]
        if b - a >= 32:
            found += [(a + m.start(), 2, a + m.end(), a + m.start()) for m in HEX.finditer(part)]
    return found


def count_transitions(batches, found: np.ndarray):
    """Add the transitions of all runs to ``found[label]``, with values of base spans as label 1."""
    for b in batches:
        for text in b.column(0).to_pylist():
            s = states(text)
            spans = base_spans(text, s)
            for _, _, end, value in spans:
                if _mixed(text[value:end]):
                    _add(found[1], s[value:end])
            for start, _, end, _ in spans:
                s[start:end] = 0
            _add(found[0], s)


def _add(counts: np.ndarray, s: np.ndarray) -> None:
    s = np.concatenate([[0], s, [0]]).astype(np.int64)
    counts += np.bincount(s[:-1] * STATES + s[1:], minlength=STATES * STATES)


def _mixed(value: str) -> bool:
    """Whether a value holds a letter and a digit, as random strings of some length do."""
    return any(c.isdigit() for c in value) and any(c.isalpha() for c in value)


def _with_identifiers(counts: np.ndarray) -> np.ndarray:
    """Ordinary transitions with those of identifiers made of the sample's words."""
    last, first = PER_WORD * counts[:, 0], PER_WORD * counts[0]
    out = counts.copy()
    for c in JOINTS:
        out[:, _STATE[ord(c)]] += last
        out[_STATE[ord(c)]] += first
        out[_STATE[ord(c)], _STATE[ord(c)]] += first.sum()  # lines drawn with one character
    capital = np.zeros(STATES)
    for c in ALPHABET:
        capital[_STATE[ord(c.upper())]] += first[_STATE[ord(c)]] if c.isalpha() else 0
    if capital.any():
        out += np.outer(last, capital / capital.sum())
    return out


def _ratios(cells) -> np.ndarray | None:
    """log P(next | state, random) - log P(next | state, ordinary).

    A state's row is smoothed, with the weight of ``PRIOR`` transitions: ordinary text
    towards its own characters' shares, so that characters it never has stay unlikely, and random strings towards even shares.
    """
    counts = np.zeros((2, STATES, STATES))
    for label, cell, n in cells:
        counts[label, cell // STATES, cell % STATES] = n
    counts[:, 0, 0] = 0
    if not counts[0].any() or not counts[1].any():
        return None
    counts[0] = _with_identifiers(counts[0])
    counts[:, 0, 0] = 0
    shares = (counts[0].sum(axis=0) + 1) / (counts[0].sum() + STATES)
    prior = np.stack([np.tile(shares, (STATES, 1)), np.full((STATES, STATES), 1 / STATES)])
    p = (counts + PRIOR * prior) / (counts.sum(axis=2, keepdims=True) + PRIOR)
    return np.log(p[1]) - np.log(p[0])


def _model(rows: DataFrame) -> np.ndarray | None:
    total = rows.groupBy("label", "cell").agg(F.sum("n").alias("n"))  # at most 2 * STATES^2 rows
    return _ratios([(r["label"], r["cell"], r["n"]) for r in total.collect()])


def _as_rows(found: np.ndarray):
    label, cell = np.nonzero(found)
    yield pa.RecordBatch.from_pydict({"label": label.astype(np.int32), "cell": cell.astype(np.int32), "n": found[label, cell]})


def fit(docs: DataFrame, text_col: str = "text") -> np.ndarray | None:
    """The model from documents, with samples labelled by the base patterns."""
    def run(batches):
        found = np.zeros((2, STATES * STATES), np.int64)
        count_transitions(batches, found)
        yield from _as_rows(found)

    return _model(docs.select(text_or_empty(text_col).alias("text")).mapInArrow(run, "label int, cell int, n long"))


def fit_samples(samples: DataFrame, text_col: str = "sample", label_col: str = "random") -> np.ndarray | None:
    """The model from labelled strings (label 1: random, 0: ordinary; other labels are not used)."""
    def run(batches):
        found = np.zeros((2, STATES * STATES), np.int64)
        for b in batches:
            for text, label in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                _add(found[label], states(text))
        yield from _as_rows(found)

    own = samples.select(text_or_empty(text_col).alias("text"), F.col(label_col).cast("int").alias("label"))
    return _model(own.where(F.col("label").isin(0, 1)).mapInArrow(run, "label int, cell int, n long"))


def find_spans(text: str, model: np.ndarray | None, least: int, per_char: float, total: float) -> list[tuple[int, int, int]]:
    """(start, kind number, end) of all spans, in order."""
    s = states(text)
    spans = [(a, k, b) for a, k, b, _ in base_spans(text, s)]
    if model is not None:
        base = sorted((a, b) for a, _, b in spans)
        reach = np.maximum.accumulate([b for _, b in base]) if base else []
        at = 0  # base spans before it begin before the end of the run
        for a, b in runs(s, least):
            while at < len(base) and base[at][0] < b:
                at += 1
            if at and reach[at - 1] > a:
                continue
            path = np.concatenate([[0], s[a:b], [0]])
            score = model[path[:-1], path[1:]].sum()
            if score > total and score > per_char * (b - a):
                spans.append((a, 3, b))
    return sorted(spans)


SPANS = T.ArrayType(T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.LongType()),
                                  T.StructField("end", T.LongType())]))


def find(docs: DataFrame, model: np.ndarray | None, text_col: str = "text", out_col: str = "spans", least: int = 20,
         per_char: float = 0.75, total: float = 20.0) -> DataFrame:
    """``docs`` with ``out_col``: the spans (kind, start, end) of each text, by start, then kind.

    An added span has at least ``least`` characters and a log-likelihood ratio above both ``total``
    and ``per_char`` a character.
    """
    return _with(docs, text_col, out_col, SPANS, lambda text: [
        {"kind": KINDS[k], "start": a, "end": b} for a, k, b in find_spans(text, model, least, per_char, total)])


def redact(docs: DataFrame, model: np.ndarray | None, text_col: str = "text", mark: str = "[SECRET]", least: int = 20,
           per_char: float = 0.75, total: float = 20.0) -> DataFrame:
    """``docs`` with each span of each text replaced by ``mark`` (overlapping spans by one); null texts stay null."""
    def clean(text: str) -> str:
        out, at = [], 0
        for a, _, b in find_spans(text, model, least, per_char, total):
            if a >= at:
                out += [text[at:a], mark]
            at = max(at, b)
        return "".join(out) + text[at:]

    return _with(docs, text_col, text_col, T.StringType(), clean, keep_null=True)


def _with(docs: DataFrame, text_col: str, out_col: str, out_type, function, keep_null: bool = False) -> DataFrame:
    """``docs`` with a column computed from whole texts, all others passed through by position."""
    fields = [f for f in docs.schema.fields if f.name != out_col or f.name == text_col]
    names = [f.name for f in fields]
    at = names.index(text_col)
    out_fields = [T.StructField(f.name, out_type) if f.name == out_col else f for f in fields]
    if out_col not in names:
        out_fields.append(T.StructField(out_col, out_type))
    from pyspark.sql.pandas.types import to_arrow_schema

    arrow = to_arrow_schema(T.StructType(out_fields))

    def run(batches):
        for b in batches:
            texts = b.column(at).to_pylist()
            made = [None if t is None and keep_null else function(t or "") for t in texts]
            made = pa.array(made, arrow.field(out_col).type)
            columns = [made if n == out_col else b.column(i) for i, n in enumerate(names)]
            yield pa.RecordBatch.from_arrays(columns if out_col in names else [*columns, made], names=[f.name for f in out_fields])

    return docs.select(*[F.col(f"`{n}`").cast("string").alias(n) if i == at else F.col(f"`{n}`") for i, n in enumerate(names)]).mapInArrow(run, T.StructType(out_fields))
