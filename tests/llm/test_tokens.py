"""Operators 3, 6 and 9 against the library, brute force and round trips."""

import math
import pickle
import random
import tracemalloc
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from edge import ROWS, docs, empty
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from viewpulse.llm import maxent, packing, slices, word_bpe
from viewpulse.llm.byte_bpe import ByteBpe

BYTES, WORDS = (public_tokenizers.path(f) for f in ("byte_bpe_50k.json", "word_bpe_49k.json"))


def noise(seed, n):
    rng = random.Random(seed)
    pool = [" ", "  ", "\n", "\t", "a", "b'", "'s", "th", "ing", "1", "é", "É", "!", "~~", "Z", "Σ", "中", "\x1f", " ", "<|endoftext|>", "<|", "ß", "\U0001f600"]
    return ["".join(rng.choice(pool) for _ in range(40)) for _ in range(n)]


def test_byte_bpe_equals_the_library():
    bpe, library = ByteBpe(BYTES, public_tokenizers.PATTERN), Tokenizer.from_file(BYTES)
    for t in noise(1, 500) + [t or "" for _, t, *_ in ROWS]:
        assert np.frombuffer(bpe.encode(t), "<u4").tolist() == library.encode(t, add_special_tokens=False).ids


def test_word_bpe_equals_the_library():
    bpe, library = word_bpe.WordBpe(WORDS, memo_size=50), Tokenizer.from_file(WORDS)
    for t in noise(2, 800) + [t or "" for _, t, *_ in ROWS]:
        want = library.encode(t, add_special_tokens=False).ids
        assert np.frombuffer(bpe.encode(t), "<u4").tolist() == want
        assert bpe.decode(bpe.encode(t)).decode() == library.decode(want, skip_special_tokens=False)


def test_joins_are_exact():
    bpe, rng = word_bpe.WordBpe(WORDS), random.Random(3)
    for _ in range(500):
        word = "".join(rng.choice(["the", "and", "ing", "er", "a", "s", "x"]) for _ in range(rng.randint(2, 50))).encode() + word_bpe.WORD_END
        cut = rng.randint(1, len(word) - 1)
        joined = bpe.join(np.array(bpe.merge(word[:cut])), np.array(bpe.merge(word[cut:])), window=1)
        assert joined.tolist() == bpe.merge(word)


@pytest.mark.parametrize("kw", [{}, {"long_chars": 30, "leaf_bytes": 16}])
def test_encoding_and_decoding(spark, kw):
    library = Tokenizer.from_file(WORDS)
    done = word_bpe.decode(word_bpe.encode(docs(spark), WORDS, **kw), WORDS).collect()
    key = lambda i: -1 if i is None else i
    want = []
    for i, t, *_ in ROWS:
        ids = library.encode(t or "", add_special_tokens=False).ids
        want.append((key(i), ids, library.decode(ids, skip_special_tokens=False)))
    assert sorted((key(r.doc_id), np.frombuffer(r.ids, "<u4").tolist(), r.decoded) for r in done) == sorted(want)
    once = word_bpe.encode(docs(spark), WORDS, decoded=True, **kw).collect()
    assert sorted((key(r.doc_id), np.frombuffer(r.ids, "<u4").tolist(), r.decoded) for r in once) == sorted(want)
    assert word_bpe.decode(word_bpe.encode(empty(spark), WORDS, **kw), WORDS).collect() == []


def best_fit(lengths, size):
    gaps = []
    for n in sorted(lengths, reverse=True):
        fit = [g for g in gaps if g >= n]
        if fit:
            gaps.remove(min(fit))
            gaps.append(min(fit) - n)
        else:
            gaps.append(size - n)
    return len(gaps)


def test_place_takes_the_gap_with_the_least_sum_of_squares():
    rng = random.Random(4)
    size = 30
    lengths = np.array(sorted((rng.randint(1, 30) for _ in range(120)), reverse=True))
    sequence, offset = packing.place(lengths, size)
    gaps: dict[int, int] = {}
    for n, own, at in zip(lengths.tolist(), sequence.tolist(), offset.tolist(), strict=True):
        def after(s, n=n):
            count = Counter(g - (n if k == s else 0) for k, g in gaps.items())
            return sum(v * v for g, v in count.items() if 0 < g < size)
        fits = [s for s, g in gaps.items() if g >= n]
        if fits:
            assert after(own) == min(after(s) for s in fits)
        else:
            assert own not in gaps
        gaps[own] = gaps.get(own, size) - n
        assert at + n <= size
    assert len(gaps) <= best_fit(lengths.tolist(), size) + 1


def test_pack_in_rounds(spark):
    rng = random.Random(5)
    lengths = [rng.randint(1, 100) for _ in range(3000)]
    rows = spark.createDataFrame(list(enumerate(lengths)), "row long, length long")
    got = packing.pack(rows, 100, group=200).collect()
    assert sorted(r.row for r in got) == list(range(3000))
    places = {}
    for r in got:
        places.setdefault(r.sequence_id, []).append((r.offset, lengths[r.row]))
    for own in places.values():
        own.sort()
        assert [o for o, _ in own] == [sum(n for _, n in own[:k]) for k in range(len(own))] and sum(n for _, n in own) <= 100
    assert len(places) <= math.ceil(sum(lengths) / 100) * 1.02


def test_pack_documents(spark):
    library = Tokenizer.from_file(BYTES)
    got = packing.pack_documents(docs(spark), BYTES, public_tokenizers.PATTERN, size=64).collect()
    by_start = {}
    for r in got:
        by_start.setdefault((r.doc_id, r.start), []).append(r)
    total = 0
    for i, t, *_ in ROWS:
        ids = np.array(library.encode(t or "", add_special_tokens=False).ids + [0], "<u4")
        total += len(ids)
        at = 0
        while at < len(ids):
            r = next(r for r in by_start[i, at] if zlib.crc32(ids[at : at + r.length].tobytes()) == r.ids_crc32)
            by_start[i, at].remove(r)
            assert r.length == 64 or at == 0
            at += r.length
    assert not any(by_start.values()) and len({r.sequence_id for r in got}) <= -(-total // 64) + 2
    assert packing.pack_documents(empty(spark), BYTES, public_tokenizers.PATTERN).collect() == []


def base_scores(rows, taught):
    tokens = [(t or "").encode().lower().split() + [b" "] for _, t, *_ in rows]
    counts = Counter(x for w, use in zip(tokens, taught, strict=True) if use for x in w)
    n, v = sum(counts.values()), len(counts)
    return [(len(w), sum(counts[x] > 0 for x in w), n, sum(math.log10((counts[x] + 1) / (n + v + 1)) for x in w)) for w in tokens]


@pytest.mark.parametrize("head", [1 << 17, 3])
def test_base_scores(spark, head):
    learn = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 != 2
    taught = [i is not None and zlib.crc32(str(i).encode()) % 7 != 2 for i, *_ in ROWS]
    got = maxent.score(docs(spark), learn, classes=2, width=2, buckets=512, head=max(4, head), rounds=1).collect()
    key = lambda i: -1 if i is None else i
    want = sorted((key(i), *s[:3], round(s[3], 6)) for (i, *_), s in zip(ROWS, base_scores(ROWS, taught), strict=True))
    assert sorted((key(r.doc_id), r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in got) == want
    assert all(math.isfinite(r.score) and r.score < 0 for r in got)


def test_model_is_a_distribution():
    """Probabilities of all next tokens, with one unseen, sum to one after training."""
    rng = random.Random(6)
    texts = [" ".join(rng.choice(["a b", "c d", "e f", "g"]) for _ in range(30)) for _ in range(50)]
    counts = Counter(x for t in texts for x in t.encode().split())
    counts[maxent.END] = len(texts)
    top = counts.most_common()
    members, others = top[:5], top[5:]
    rest = sum(n + 1 for _, n in others) + 1
    model = maxent.Model([t for t, _ in members], [n for _, n in members], rest, 64, 2)
    before, after = model.class_weight.copy(), maxent.train_task(model, [texts], 0.3, 64)
    assert len(after[0]) == 2 and not np.array_equal(before, model.class_weight)
    f = model.features(maxent.hash_tokens([b"a"]), np.array([1]))
    p = [math.exp(model.log_likelihood(f, np.array([k]))[0]) for k in range(-1, 5)]
    assert abs(sum(p) - 1) < 1e-4


def test_gradients_summed_by_bucket():
    rng = np.random.default_rng(3)
    for n, buckets in ((1, 4), (7, 2), (300, 1), (2000, 40), (4000, 9000)):
        at = (rng.zipf(1.3, (n, 3)) % buckets).astype(np.int64)
        gradient = rng.normal(size=(n, 8)).astype(np.float32)
        rows, summed, uses = maxent.by_bucket(at, gradient)
        brute = np.zeros((buckets, 8))
        np.add.at(brute, at.ravel(), np.repeat(gradient, 3, axis=0))
        assert np.array_equal(rows, np.unique(at)) and np.allclose(brute[rows], summed, atol=1e-3)
        assert np.array_equal(uses, np.bincount(at.ravel())[rows])


def test_likelihood_by_hand():
    """Each token's log probability, token by token and path by path, from the trained tables."""
    rng = random.Random(8)
    names = [*(f"w{i}".encode() for i in range(40)), maxent.END]
    counts = [100 - i for i in range(40)] + [50]
    texts = [" ".join(f"w{min(39, int(rng.expovariate(0.1)))}" for _ in range(30)) for _ in range(40)]
    model = maxent.Model(names[:5] + [maxent.END], counts[:5] + [50], sum(counts[5:40]) + 36, 128, 3, names[5:40], counts[5:40], np.array([1.0, 4.0]))
    maxent.train_task(model, [texts], 0.3, 128)
    h, _, n, _ = maxent.token_hashes([t.encode() for t in texts])
    f, places = model.features(h, n), model.places(h)

    def one(bias, table, features, child):
        x = bias.astype(float) + sum(table[int(k) % len(table)].astype(float) for k in features)
        return x[child] - x.max() - math.log(np.exp(x - x.max()).sum())

    def below(features, node):
        return [int(maxent.mix(np.array([int(v) + node * 0x9E37 & (1 << 64) - 1], np.uint64))[0]) for v in features]

    got = model.log_likelihood(f, places)
    for i in range(0, len(h), 7):
        place, own = int(places[i]), f[i].tolist()
        want = one(model.class_bias, model.class_weight, own, 0 if place < 0 else place // 3 + 1)
        if place >= 0:
            want += one(model.word_bias[place // 3], model.word_weight, below(own, place // 3 + 1), place % 3)
        else:
            for _, node, child in model.tree.steps(np.array([-1 - place])):
                want += one(model.tree_bias[node[0]], model.tree_weight, below(own, int(node[0])), child[0])
        assert abs(want - got[i]) < 1e-3


def test_model_beats_counts_on_held_out_text(spark):
    rng = random.Random(7)
    rows = [(i, " ".join(rng.choice(["new york", "los angeles", "san diego", "el paso"]) for _ in range(60)), "en", "a", 0) for i in range(200)]
    got = maxent.score(docs(spark, rows), F.col("doc_id") % 5 != 0, buckets=1024, width=4, classes=4, rounds=2).where("doc_id % 5 = 0").collect()
    assert sum(r.score for r in got) > 0.75 * sum(r.base_score for r in got)


def test_tree_is_a_distribution():
    """Probabilities of all tokens, in classes, in the tree and in leaves, sum to one after training."""
    rng = random.Random(8)
    for size in (9, 30, 200):
        names = [f"w{i}".encode() for i in range(size)]
        texts = [" ".join(rng.choice(names).decode() for _ in range(40)) for _ in range(20)]
        leaves = np.array([5.0, 2.0, 1.0])
        counts = [size + 5 - i for i in range(size)]
        rest = sum(counts[4:]) + size - 4 + leaves.sum()
        model = maxent.Model(names[:4], counts[:4], rest, 256, 2, names[4:], counts[4:], leaves)
        maxent.train_task(model, [texts], 0.3, 64)
        f = model.features(maxent.hash_tokens([names[0]]), np.array([1]))
        places = [*model.places(maxent.hash_tokens(names)), *(-1 - (size - 4) - np.arange(3))]
        assert len(set(places)) == size + 3
        assert abs(sum(math.exp(model.log_likelihood(f, np.array([k]))[0]) for k in places) - 1) < 1e-4


@pytest.mark.parametrize("head", [1 << 17, 20])
def test_tokens_outside_the_classes_are_learned(spark, head):
    """Forty pairs of words, four tokens in classes: each word tells the next one."""
    rng = random.Random(9)
    pairs = [f"first{i} second{i}" for i in range(40)]
    rows = [(i, " ".join(rng.choice(pairs) for _ in range(60)), "en", "a", 0) for i in range(200)]
    got = maxent.score(docs(spark, rows), F.col("doc_id") % 5 != 0, width=2, classes=2, buckets=4096, head=head, per_leaf=2).where("doc_id % 5 = 0").collect()
    assert sum(r.score for r in got) > 0.85 * sum(r.base_score for r in got)


def test_scores_without_rows(spark):
    assert maxent.score(empty(spark), F.lit(True)).collect() == []
    nothing = maxent.score(docs(spark), F.lit(False)).collect()
    assert len(nothing) == len(ROWS) and {r.n_known for r in nothing} == {0}
    assert all(r.base_score == 0 and r.score == 0 for r in nothing)


def test_softmax_in_blocks():
    """Log probabilities and gradients of many rows, far logits too, in memory that doesn't grow with rows x width."""
    rng = np.random.default_rng(5)
    n, width, buckets = 50_001, 32, 64
    weight = rng.normal(size=(buckets, width)).astype(np.float32)
    weight[0] += 200  # beyond the range of exp
    weight[1] -= 200
    bias = rng.normal(size=(3, width)).astype(np.float32)
    bias[2, 5:] = -1e9
    at, node = rng.integers(0, buckets, (n, 3)), rng.integers(0, 3, n)
    child = np.where(node == 2, rng.integers(0, 5, n), rng.integers(0, width, n))
    x = weight[at].astype(float).sum(axis=1) + bias[node]
    x -= x.max(axis=1, keepdims=True)
    x -= np.log(np.exp(x).sum(axis=1, keepdims=True))
    tracemalloc.start()
    got = maxent.softmax(bias, weight, at, child, False, node)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert np.allclose(got, x[np.arange(n), child], rtol=1e-4, atol=1e-3) and peak < n * width
    gradient = np.exp(x)
    gradient[np.arange(n), child] -= 1
    assert np.allclose(maxent.softmax(bias, weight, at, child, True, node), gradient, atol=1e-3)
    assert np.allclose(maxent.softmax(bias[0], weight, at, child, False), maxent.softmax(bias, weight, at, child, False, 0 * node))


def test_numbers_of_tokens():
    names = [f"w{i}".encode() for i in range(500)]
    model = maxent.Model(names[:100], [9] * 100, 400, 64, 4, names[100:400], [3] * 300, np.ones(7))
    assert model.numbers(maxent.hash_tokens(names)).tolist() == [*range(400), *[-1] * 100]
    assert maxent.Model([], [], 1, 64, 4).numbers(maxent.hash_tokens(names)).tolist() == [-1] * 500
    again = pickle.loads(pickle.dumps(model))
    assert all(np.array_equal(a, b) and b.ctypes.data % 64 == 0 for a, b in zip(model.tables(), again.tables(), strict=True))


def test_slice_hashes_by_hand():
    raw = np.frombuffer(bytes(range(1, 200)) * 21, np.uint8)
    starts, ends = np.array([0, 5, 1020, 2047, 4000]), np.array([3, 5, 1030, 4179, 4001])
    table = slices.byte_table(4)
    want = [(sum(int(table[b]) * pow(0x9E3779B97F4A7C15, k, 1 << 64) for k, b in enumerate(raw[i:j].tolist())) + j - i) % (1 << 64)
            for i, j in zip(starts.tolist(), ends.tolist(), strict=True)]
    assert np.array_equal(slices.slice_hashes(raw, starts, ends, table), slices.mix(np.array(want, np.uint64)))
