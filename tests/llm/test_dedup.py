"""Operators 5, 7 and 8 against brute force."""

import hashlib
import random

import numpy as np
import pytest
import xxhash
from edge import LONG, ROWS, docs, empty

from viewpulse.llm import chunk_dedup, exact_dedup, simhash
from viewpulse.llm.components import component_roots


def norm(text):
    return "".join(c for c in text or "" if c not in " \t\n\x0b\x0c\r")


@pytest.mark.parametrize("kw", [{}, {"block": 50}, {"block": 50, "hash_bits": 3}])
def test_exact_duplicates(spark, kw):
    got = exact_dedup.exact_duplicates(docs(spark), **kw).collect()
    groups = {}
    for i, t, *_ in ROWS:
        groups.setdefault(norm(t), []).append((-len(t or ""), i is None, i))
    assert len(got) == len(ROWS)
    kept = 0
    for r in got:
        texts = [norm(t) for i, t, *_ in ROWS if i == r.doc_id and hashlib.sha256(norm(t).encode()).hexdigest() == r.text_sha256]
        own = groups[texts[0]]
        assert r.group_size == len(own)
        assert r.keep_id == min(own, key=lambda x: (x[0], x[1], x[2] or 0))[2]
        kept += r.kept
    assert kept == len(groups)


def test_exact_duplicates_of_nothing(spark):
    assert exact_dedup.exact_duplicates(empty(spark)).collect() == []


def brute_fingerprint(text, k=3):
    w = (text or "").encode().lower().split()
    shingles = [b" ".join(w[i : i + k]) for i in range(len(w) - k + 1)] if len(w) >= k else [b" ".join(w)] if w else []
    h = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def test_fingerprints():
    texts = [t or "" for _, t, *_ in ROWS] + ["a", "a b", "One two THREE four " + "y" * 100]
    assert simhash.fingerprints(texts, 3, part_bytes=1000).tolist() == [brute_fingerprint(t) for t in texts]


def test_golay_keys_meet_within_three_bits():
    own, first, near = simhash.near_codewords()
    rng = random.Random(0)
    for _ in range(3000):
        x = rng.getrandbits(64)
        y = x
        for b in rng.sample(range(64), 3):
            y ^= 1 << b
        a, b = (simhash._segments(np.array([v], np.uint64)) for v in (x, y))
        assert any(a[i][0] == b[i][0] and own[b[j][0]] in near[first[a[j][0]] : first[a[j][0] + 1]] for i, j in simhash.PAIRS)


def components(fps, bits):
    label = list(range(len(fps)))
    changed = True
    while changed:
        changed = False
        for i in range(len(fps)):
            for j in range(len(fps)):
                if bin(fps[i] ^ fps[j]).count("1") <= bits and label[j] < label[i]:
                    label[i], changed = label[j], True
    return label


@pytest.mark.parametrize("hot", [24, 2])
def test_links_keep_components(spark, hot):
    rng = random.Random(1)
    fps = {0}
    for _ in range(6):  # chains and clusters of near fingerprints
        x = rng.getrandbits(63)
        for _ in range(15):
            fps.add(x)
            for b in rng.sample(range(63), rng.choice([1, 2, 3, 4])):
                x ^= 1 << b
    fps = sorted(fps)
    nodes = spark.createDataFrame([(f, i) for i, f in enumerate(fps)], "fp long, least long")
    roots = {r.node: r.root for r in component_roots(simhash.links(nodes, 3, hot=hot, block=4)).collect()}
    want = components(fps, 3)
    assert [fps.index(roots.get(f, f)) for f in fps] == want


def test_near_duplicates_of_awkward_rows(spark):
    got = simhash.near_duplicates(docs(spark)).collect()
    assert len(got) == len(ROWS)
    fps = [brute_fingerprint(t) for _, t, *_ in ROWS]
    label = components(fps, 3)
    least = {}
    for (i, *_), c in zip(ROWS, label, strict=True):
        least[c] = min([x for x in (least.get(c), i) if x is not None], default=None)
    want = sorted((i if i is not None else -1, f, least[c] if least[c] is not None else -1) for (i, *_), f, c in zip(ROWS, fps, label, strict=True))
    assert sorted((r.doc_id if r.doc_id is not None else -1, r.fp % 2**64, r.component_id if r.component_id is not None else -1) for r in got) == want
    assert simhash.near_duplicates(empty(spark)).collect() == []


def test_chunks_cover_the_text_and_resist_shifts():
    text = LONG[:20_000]
    digests, places = chunk_dedup.chunk(text, 4, 8, 256)
    starts, lengths = places >> 24, places >> 12 & 0xFFF
    assert starts[0] == 0 and (starts[1:] == (starts + lengths)[:-1]).all() and starts[-1] + lengths[-1] == len(text)
    assert (places & 0xFFF).sum() == len(text.split())
    moved, _ = chunk_dedup.chunk("inserted " + text, 4, 8, 256)
    assert len(set(digests.tolist()) - set(moved.tolist())) <= 3


def test_gear_is_a_rolling_hash():
    raw = np.frombuffer(b"some bytes that roll over a window of bytes" * 3, np.uint8)
    table = (chunk_dedup.byte_table(2) >> np.uint64(32)).astype(np.uint32)
    h = 0
    for i, b in enumerate(raw.tolist()):
        h = ((h << 1) + int(table[b])) & 0xFFFFFFFF
        assert h == int(chunk_dedup.gear(raw)[i])


def test_repeated_passages(spark):
    rng = random.Random(2)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 9)))
    text = lambda n: " ".join(word() for _ in range(n))
    shared = [text(60) for _ in range(10)]
    line = "a short line that many rows have"
    rows = []
    for i in range(60):
        inside = shared[i % 10] if i < 40 else ""
        rows.append((i, f"{text(rng.randint(5, 80))} {inside} {line} {text(40)}", "en", "a", 0))
    got = chunk_dedup.repeated_passages(docs(spark, rows)).collect()
    assert {r.doc_id for r in got} == set(range(40))
    for r in got:
        passage = rows[r.doc_id][1].encode()[r.start : r.end].decode()
        assert len(passage.split()) >= 25 and passage.strip() in f"{shared[r.doc_id % 10]} {line}"
        assert r.first_doc_id == r.doc_id % 10 and r.kept == (r.doc_id < 10)


def test_repeated_passages_do_not_depend_on_files(spark, tmp_path):
    rng = random.Random(4)
    text = lambda n: " ".join("".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 9))) for _ in range(n))
    shared = [text(60) for _ in range(6)]
    rows = [(i // 2 if i < 20 else i, f"{text(20)} {shared[i % 6]} {text(20)}", "en", "a", 0) for i in range(60)]
    rows += [(None, f"{text(9)} {shared[k]}", "en", "a", 0) for k in (0, 1)] + rows[:5]
    answers = []
    for parts in (1, 7):
        rng.shuffle(rows)
        path = f"{tmp_path}/{parts}"
        docs(spark, rows).repartition(parts).write.parquet(path)
        got = chunk_dedup.repeated_passages(spark.read.parquet(path)).collect()
        answers.append(sorted(tuple((x is None, x) for x in r) for r in got))
    assert answers[0] == answers[1] and len(answers[0]) >= 67
    first = {r.first_doc_id for r in got}
    assert None not in first and first <= set(range(10))


def test_repeated_passages_of_awkward_rows(spark):
    got = {(r.doc_id, r.first_doc_id) for r in chunk_dedup.repeated_passages(docs(spark)).collect()}
    assert (7, 6) in got and not {i for i, _ in got} & {1, 3, 4, 5, 9, 10}
    assert chunk_dedup.repeated_passages(empty(spark)).collect() == []
