"""The search for nearest examples looks at the opened blocks only, and finds what a plain search finds."""

import numpy as np

from viewpulse.llm import toxicity


def test_first_bound_comes_from_the_opened_blocks(monkeypatch):
    rng = np.random.default_rng(3)
    vectors = []
    for _ in range(4096):
        ids = np.sort(rng.choice(60, 12, replace=False)).astype(np.int64)
        w = rng.random(12) + 0.01
        vectors.append((ids, w / np.sqrt((w * w).sum())))
    dense = np.zeros((4096, 60))
    for i, (ids, w) in enumerate(vectors):
        dense[i, ids] = w
    index = toxicity.BlockMaxIndex(np.arange(4096), np.zeros(4096), vectors, 60)
    sizes, partition = [], np.partition
    monkeypatch.setattr(toxicity.np, "partition", lambda a, k: (sizes.append(len(a)), partition(a, k))[1])
    for ids, w in vectors[:60]:
        sizes.clear()
        got = index.nearest(ids, w, 15)
        cosine = dense[:, ids] @ w
        want = np.lexsort((np.arange(4096), -cosine))[:15]
        assert np.allclose([s for _, s in got], cosine[want])
        assert sizes[0] <= 2 * index.block


def test_counts_of_repeated_and_inflected_words():
    words = toxicity.Vocabulary(["grob", "^unfreu", "unfreundlich"])
    text = "Grob grob unfreundlich unfreundliche GROB other"
    for _ in range(2):  # the second time from the memo
        ids, counts = words.counts(text)
        assert ids.tolist() == [0, 1, 2] and counts.tolist() == [3, 2, 1]
