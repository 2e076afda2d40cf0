"""Operators 1, 2, 4 and 10 against brute force and held-out labels."""

import hashlib
import random
import re

import numpy as np
from edge import ROWS, docs, empty, labels
from pyspark.sql import functions as F

from viewpulse.llm import graph_index, resampling, secrets, toxicity


def prose(rng, n, marked=0, marks=("grob", "mies", "fies")):
    words = ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 5))) for _ in range(n)]
    for _ in range(marked):
        words[rng.randrange(n)] = rng.choice(marks)
    return " ".join(words)


def test_toxicity_on_held_out_rows(spark):
    rng = random.Random(1)
    truth = {i: int(i % 4 == 0) for i in range(600)}
    rows = [(i, prose(rng, 60, 5 * truth[i]), "en", "a", 0) for i in truth]
    known = spark.createDataFrame([(i, 1, t) for i, t in truth.items()], "doc_id long, quality int, toxic int")
    got = toxicity.score(docs(spark, rows), known, learn=F.col("doc_id") % 3 != 0, per_class=120, calibration_rows=100).collect()
    held = [(r.score >= 0.5, truth[r.doc_id]) for r in got if r.doc_id % 3 == 0]
    assert sum(a == b for a, b in held) >= 0.9 * len(held)
    assert all(0 <= r.score <= 1 and all(n.id % 3 for n in r.neighbours) for r in got)


def test_nearest_examples_are_exact():
    rng = np.random.default_rng(0)
    vectors = []
    for _ in range(700):
        ids = np.sort(rng.choice(200, rng.integers(0, 20), replace=False)).astype(np.int32)
        w = rng.random(len(ids)) ** 4 + 0.01
        vectors.append((ids, w / np.sqrt((w * w).sum()) if len(w) else w))
    dense = np.zeros((700, 200))
    for i, (ids, w) in enumerate(vectors):
        dense[i, ids] = w
    names = rng.permutation(700)
    index = toxicity.BlockMaxIndex(names, np.zeros(700), vectors, 200, block=16)
    for ids, w in vectors[:150]:
        got = index.nearest(ids, w, 10)
        cosine = dense[:, ids] @ w
        want = [i for i in np.lexsort((names, -np.round(cosine, 12))) if cosine[i] > 0][:10]
        assert np.allclose([s for _, s in got], cosine[want])
        assert len(got) == len(want)


def test_toxicity_of_awkward_rows(spark):
    got = toxicity.score(docs(spark), labels(spark), learn=F.lit(True), row_col=None).collect()
    assert len(got) == len(ROWS) and all(0 <= r.score <= 1 for r in got)
    none = labels(spark).limit(0)
    assert all(r.score == 0 for r in toxicity.score(docs(spark), none, learn=F.lit(True)).collect())
    assert toxicity.score(empty(spark), labels(spark), learn=F.lit(True)).collect() == []


def brute_weights(texts, good, buckets):
    def grams(t):
        at, _ = resampling.ngram_buckets([(t or "").encode()], buckets)
        return at
    raw = sum(np.bincount(grams(t), minlength=buckets) for t in texts)
    own = sum(np.bincount(grams(t), minlength=buckets) for t, g in zip(texts, good, strict=True) if g)
    p = (raw + 1) / (raw.sum() + buckets)
    q = (own + buckets * p) / (own.sum() + buckets)
    return [float((np.log(q) - np.log(p))[grams(t)].sum()) for t in texts]


def test_importance_weights_and_sample(spark):
    rng = random.Random(2)
    rows = [(i, prose(rng, 50) if i % 5 else "$$ && " * 40 + prose(rng, 10), "en", "a", 0) for i in range(300)]
    known = spark.createDataFrame([(i, int(i % 5 != 0), 0) for i in range(0, 300, 2)], "doc_id long, quality int, toxic int")
    df = docs(spark, rows)
    ratio = resampling.fit(df, known.where("quality = 1"))
    got = {r.doc_id: r.log_weight for r in resampling.weigh(df, ratio).collect()}
    want = brute_weights([t for _, t, *_ in rows], [i % 2 == 0 and i % 5 != 0 for i in range(300)], len(ratio))
    assert np.allclose([got[i] for i in range(300)], want)
    kept = {r.doc_id for r in resampling.sample(df, known).collect()}
    assert len(kept) == 240 and len([i for i in kept if i % 5]) >= 235
    again = {r.doc_id for r in resampling.sample(df, known).collect()}
    assert kept == again


def test_kth_largest(spark):
    rng = random.Random(3)
    values = [rng.choice([rng.gauss(0, 1), 0.0, 1e9, -1e-300]) for _ in range(2000)]
    df = spark.createDataFrame([(v,) for v in values], "v double").cache()
    ordered = sorted(values, reverse=True)
    for k in (1, 2, 499, 500, 1000, 1999, 2000, 5000):
        assert resampling.kth_largest(df, "v", k, bins=16) == ordered[min(k, 2000) - 1]
    assert resampling.kth_largest(df, "v", 0) is None


def test_sample_of_awkward_rows(spark):
    got = resampling.sample(docs(spark), labels(spark), share=1.0).collect()
    assert len(got) == len(ROWS)
    assert len(resampling.sample(docs(spark), labels(spark).limit(0), share=0.5).collect()) >= round(0.5 * len(ROWS))
    assert resampling.sample(empty(spark), labels(spark)).collect() == []


ASSIGN = re.compile(r"""(?ai:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")


def brute_spans(t):
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(t) if len(m.group(2)) >= 8]
    found += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", t) if m.end() - m.start() >= 16]
    found += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", t) if m.end() - m.start() >= 32]
    return sorted(found)


def secret_texts():
    rng = random.Random(4)
    pool = ["password", "PassWD", "secret", "token", "api_key", "apikey", "=", " = ", ":", '"', "'", " ", "é", "abcdefgh", "x", "AKIA", "AKIAABCDEFGH1234",
            "0123456789abcdef", "deadbeef" * 4, "\n", "Key", "K", "ſecret", "-", ".", "日本"]
    return ["".join(rng.choice(pool) for _ in range(rng.randint(0, 25))) for _ in range(400)]


def test_base_spans(spark):
    texts = secret_texts()
    rows = [(i, t, "en", "a", 0) for i, t in enumerate(texts)]
    got = {r.doc_id: r.spans for r in secrets.find(docs(spark, rows), None).collect()}
    for i, t in enumerate(texts):
        assert [(s.start, secrets.KINDS.index(s.kind), s.end) for s in got[i]] == brute_spans(t)


def test_markov_spans(spark):
    rng = random.Random(5)
    hexes = [hashlib.sha1(str(i).encode()).hexdigest() for i in range(200)]
    token = lambda n: "".join(rng.choice("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789") for _ in range(n))
    samples = [(token(40), 1) for _ in range(300)] + [(w, 0) for _ in range(300) for w in prose(rng, 8).split()] + [("get_user_name_from_table", 0)] * 50
    model = secrets.fit_samples(spark.createDataFrame(samples, "sample string, random int"))
    hidden = [token(36) for _ in range(50)]
    rows = [(i, f"ordinary words here {h} get_user_name_from_table", "en", "a", 0) for i, h in enumerate(hidden)]
    found = secrets.find(docs(spark, rows), model).collect()
    hit = [[r.text[s.start : s.end] for s in r.spans] for r in found]
    assert sum(h == [hidden[r.doc_id]] for h, r in zip(hit, found, strict=True)) >= 48
    by_corpus = secrets.fit(docs(spark, [(i, f'{prose(rng, 30)} token = "{h}"', "en", "a", 0) for i, h in enumerate(hexes)]))
    clean = [(0, prose(rng, 200) + " " + "".join(rng.choice("abcdefgh") for _ in range(35)), "en", "a", 0), (1, "see 4f9c-ab12" + hexes[0][:20] + "x", "en", "a", 0)]
    spans = {r.doc_id: r.spans for r in secrets.find(docs(spark, clean), by_corpus).collect()}
    assert spans[0] == []
    assert [s.kind for s in spans[1]] == ["markov"]


def test_planted_secrets_and_identifiers(spark):
    """The corpus' own model on strings that no base pattern matches: random ones are found, identifiers, paths and lines are not."""
    rng = random.Random(11)
    letters, digits = "abcdefghijklmnopqrstuvwxyz", "0123456789"
    corpus = [(i, f'{prose(rng, 40)} 2024-01-05 token = "{hashlib.md5(str(i).encode()).hexdigest()}"', "en", "a", 0) for i in range(300)]
    corpus += [(300, "password: changemeplease secret = sunflowers", "en", "a", 0)]
    model = secrets.fit(docs(spark, corpus))
    some = lambda a, n: "".join(rng.choice(a) for _ in range(n))
    random_ones = [some(a, rng.randint(28, 48)) for a in (letters + letters.upper() + digits, letters + digits, letters.upper() + digits) for _ in range(40)]
    words = lambda n: prose(rng, n).lower().split()
    ordinary = ["https/www/example/com/path/to/page", "=" * 40, "-" * 60, "_" * 30]
    for _ in range(40):
        ordinary += [j.join(words(7)) for j in "/_-"] + ["".join(w.capitalize() for w in words(7))]
    rows = [(i, f"see {t} here", "en", "a", 0) for i, t in enumerate(random_ones + ordinary)]
    marked = {r.doc_id for r in secrets.find(docs(spark, rows), model).collect() if any(s.kind == "markov" for s in r.spans)}
    n = len(random_ones)
    assert sum(i < n for i in marked) >= 0.95 * n and sum(i >= n for i in marked) <= 0.02 * len(ordinary)


def test_runs_beside_many_base_spans():
    """A run is left out when it meets a base span, however many there are."""
    model = np.full((secrets.STATES, secrets.STATES), 1.0)
    own = "Ab1" * 10
    text = " ".join(f"{own} token=abcdefgh{i:04d}xyzxyzxyzxyz {own} {'0f' * 16}" for i in range(50))
    spans = secrets.find_spans(text, model, 20, 0.75, 20.0)
    assert [k for _, k, _ in spans] == [3, 0, 3, 2] * 50


def test_secrets_of_awkward_rows(spark):
    df = docs(spark)
    model = secrets.fit(df)
    got = secrets.find(df, model).collect()
    assert len(got) == len(ROWS) and set(df.columns) < set(got[0].asDict())
    red = secrets.redact(df, model).collect()
    assert sum(r.text is None for r in red) == 2
    assert '[SECRET]" é 日本 <|endoftext|> idiot' in [r.text for r in red if r.doc_id == 9][0]
    assert secrets.find(empty(spark), secrets.fit(empty(spark))).collect() == []


def nearest(x, ids, q, k):
    own = x[list(ids).index(q)]
    cosine = (x @ own) / np.sqrt((x * x).sum(1)) / np.sqrt(own @ own)
    order = [i for i in np.lexsort((ids, -cosine)) if ids[i] != q][:k]
    return [(ids[i], cosine[i]) for i in order]


def test_neighbours(spark):
    rng = np.random.default_rng(7)
    x = rng.normal(size=(900, 16))
    x[300:420] = x[7] + 1e-3 * rng.normal(size=(120, 16))  # a tight cluster
    x[500:560] = x[0]  # copies
    ids = np.arange(900)
    df = spark.createDataFrame([(int(i), v.tolist(), "clash", "clash") for i, v in zip(ids, x, strict=True)], "vec_id long, embedding array<double>, id string, shard string")
    index = graph_index.build_index(df, shard_size=256)
    got = {}
    for r in graph_index.search(index, df.where("vec_id % 50 = 0"), block=7).collect():
        got.setdefault(r.query_id, {})[r.rank] = (r.vec_id, r.score)
    hits = 0
    for q in range(0, 900, 50):
        want = nearest(x, ids, q, 5)
        own = [got[q][k] for k in range(1, 6)]
        assert all(abs(s - dict(nearest(x, ids, q, 900))[i]) < 1e-12 for i, s in own)
        hits += len({i for i, _ in own} & {i for i, _ in want})
    assert hits >= 0.95 * 90
    assert [i for i, _ in [got[0][k] for k in range(1, 6)]] == [500, 501, 502, 503, 504]


def test_neighbours_of_awkward_rows(spark):
    nan = float("nan")
    rows = [(0, [1.0, 0.0]), (1, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [0.0, 0.0]), (3, None), (4, [nan, 1.0]), (5, [1.0, None]), (50, [2e200, 0.0]),
            (None, [1.0, 1.0]), (6, [1.0, 2.0, 3.0]), (7, []), (100, [float("inf"), 1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = graph_index.search(graph_index.build_index(df), df.where("vec_id % 50 = 0")).orderBy("query_id", "rank").collect()
    assert [(r.query_id, r.rank, r.vec_id, r.score) for r in got] == [(0, 1, 1, 1.0), (0, 2, 50, 1.0), (50, 1, 0, 1.0), (50, 2, 1, 1.0)]
    none = df.limit(0)
    assert graph_index.search(graph_index.build_index(none), none).collect() == []
