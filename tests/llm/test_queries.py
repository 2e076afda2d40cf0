"""The registered queries themselves: names, forms and digests of their columns against plain versions, on the smallest tables."""

import hashlib
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import xxhash
from tokenizers import Tokenizer

from viewpulse.llm import queries

SF = "/root/testdata/sf0.001"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def docs(spark):
    return [(r.doc_id, r.text or "") for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]


def by_id(rows):
    return {r.doc_id: r for r in rows}


def held_out(doc_id, modulus, rest):
    return zlib.crc32(str(doc_id).encode()) % modulus == rest


def test_op1_samples_rows_of_the_table(spark, docs):
    got = queries.op1_importance_resampling(spark, SF)
    assert set(got.columns) >= {"doc_id", "log_weight", "key", "kept"}
    rows = got.collect()
    assert 0 < len(rows) < len(docs) and {r.doc_id for r in rows} <= {i for i, _ in docs} and all(r.kept for r in rows)


def test_op2_columns_ranks_and_scores(spark):
    vectors = {r.vec_id: np.array(r.embedding, float) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()}
    got = queries.op2_graph_neighbours(spark, SF)
    assert dict(got.dtypes) | {"query_id": "bigint", "rank": "int", "vec_id": "bigint", "score": "double"} == dict(got.dtypes)
    rows = sorted(got.collect(), key=lambda r: (r.query_id, r.rank))
    asked = sorted(v for v in vectors if v % 50 == 0)
    assert [(r.query_id, r.rank) for r in rows] == [(q, k) for q in asked for k in range(1, 6)]
    cosine = lambda a, b: float(a @ b / np.sqrt(a @ a) / np.sqrt(b @ b))
    found = 0
    for q in asked:
        best = sorted(((-cosine(vectors[q], v), i) for i, v in vectors.items() if i != q))[:5]
        own = [r for r in rows if r.query_id == q]
        assert all(abs(r.score - cosine(vectors[q], vectors[r.vec_id])) < 1e-12 for r in own) and all(a.score >= b.score for a, b in zip(own, own[1:]))
        found += len({i for _, i in best} & {r.vec_id for r in own})
    assert found >= 0.9 * 5 * len(asked)


def test_op3_pieces_are_those_of_the_library(spark, docs):
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    got = queries.op3_packing(spark, SF).collect()
    want = set()
    for i, text in docs:
        ids = np.array([*library.encode(text, add_special_tokens=False).ids, 0], "<u4")
        cuts = [0, *range(len(ids) % 2048 or 2048, len(ids) + 1, 2048)]
        want |= {(i, k, a, b - a, zlib.crc32(ids[a:b].tobytes())) for k, (a, b) in enumerate(zip(cuts, cuts[1:]))}
    assert {(r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got} == want and len(got) == len(want)
    places = {}
    for r in got:
        places.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for own in places.values():
        own.sort()
        assert [o for o, _ in own] == [sum(n for _, n in own[:k]) for k in range(len(own))] and sum(n for _, n in own) <= 2048
    assert len(places) <= -(-sum(r.length for r in got) // 2048) + 1


def test_op4_base_spans_by_the_patterns(spark, docs):
    kinds = (("assign", re.compile(r"""(?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""), 8),
             ("access", re.compile(r"(AKIA[A-Z0-9]+)"), 16), ("hex", re.compile(r"([0-9a-f]+)"), 32))
    got = by_id(queries.op4_secrets(spark, SF).collect())
    for i, text in docs:
        spans = [(m.start(), k, m.end()) for k, (_, p, least) in enumerate(kinds) for m in p.finditer(text) if m.end(1) - m.start(1) >= least]
        written = ",".join(f"{kinds[k][0]}:{a}:{b}" for a, k, b in sorted(spans))
        assert (got[i].n_assign, got[i].n_access, got[i].n_hex) == tuple(sum(k == n for _, k, _ in spans) for n in range(3))
        assert got[i].base_sha256 == hashlib.sha256(written.encode()).hexdigest()
        assert set(filter(None, written.split(","))) <= set(got[i].spans.split(","))


def test_op5_spans_lie_in_their_texts(spark, docs):
    sizes = {i: len(t.encode()) for i, t in docs}
    for r in queries.op5_chunk_dedup(spark, SF).collect():
        assert 0 <= r.start < r.end <= sizes[r.doc_id] and r.n_words >= 25 and r.first_doc_id in sizes


def test_op6_counts_and_base_scores(spark, docs):
    count = Counter()
    tokens = {i: [*WORD.findall(t.translate(LOWER)), ""] for i, t in docs}  # the end is a token that no word equals
    for i, own in tokens.items():
        if not held_out(i, 7, 2):
            count.update(own)
    n, v = sum(count.values()), len(count)
    got = by_id(queries.op6_maxent(spark, SF).collect())
    assert set(got) == set(tokens)
    for i, own in tokens.items():
        r = got[i]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held_out(i, 7, 2), len(own), sum(count[w] > 0 for w in own), n)
        assert abs(r.base_score - sum(np.log10((count[w] + 1) / (n + v + 1)) for w in own)) < 1e-6 * len(own)
        assert r.score < 0


def test_op8_fingerprints(spark, docs):
    got = by_id(queries.op8_simhash(spark, SF).collect())
    prints = {}
    for i, text in docs:
        words = WORD.findall(text.translate(LOWER))
        shingles = [" ".join(words[k : k + 3]) for k in range(max(1, len(words) - 2))] if words else []
        h = np.array([xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles], np.uint64)
        bits = [int(2 * ((h >> np.uint64(b)) & np.uint64(1)).sum() > len(h)) for b in range(64)]
        prints[i] = sum(x << b for b, x in enumerate(bits))
        assert got[i].fingerprint == f"{prints[i]:016x}"
    root = {i: i for i in prints}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(prints)
    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            if (prints[a] ^ prints[b]).bit_count() <= 3:
                x, y = sorted((find(a), find(b)))
                root[y] = x
    assert {i: got[i].component_id for i in ids} == {i: find(i) for i in ids}


def test_op9_digests_are_those_of_the_library(spark, docs):
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    got = by_id(queries.op9_bpe(spark, SF).collect())
    for i, text in docs:
        ids = library.encode(text, add_special_tokens=False).ids
        digests = [hashlib.sha256(x).hexdigest() for x in (np.array(ids, "<u4").tobytes(), library.decode(ids, skip_special_tokens=False).encode())]
        assert [got[i].n_tokens, got[i].ids_sha256, got[i].decoded_sha256] == [len(ids), *digests]


def test_op10_scores(spark, docs):
    got = queries.op10_toxicity(spark, SF)
    assert dict(got.dtypes) | {"doc_id": "bigint", "held_out": "boolean", "score": "double", "predicted": "int"} == dict(got.dtypes)
    rows = got.collect()
    assert sorted(r.doc_id for r in rows) == sorted(i for i, _ in docs)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) and r.held_out == held_out(r.doc_id, 5, 0) for r in rows)
