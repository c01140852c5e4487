import random
from collections import Counter

import numpy as np

from dailybars.llm import near_dup as N


def shingles(text):
    w = (text or "").lower().split()
    if len(w) >= 5:
        return frozenset(tuple(w[k: k + 5]) for k in range(len(w) - 4))
    return frozenset([tuple(w)] if w else [])


def brute(rows):
    """Sorted (doc_id, class_id, n_links); NULL ids written as infinity."""
    sets = [shingles(t) for _, t, _ in rows]
    ids = [float("inf") if i is None else i for i, *_ in rows]
    parent, links = list(range(len(rows))), Counter()

    def find(k):
        while parent[k] != k:
            k = parent[k]
        return k

    for a in range(len(rows)):
        for b in range(a):
            common = len(sets[a] & sets[b])
            if common and common >= 0.8 * (len(sets[a]) + len(sets[b]) - common) - 1e-9:
                links[a] += 1
                links[b] += 1
                parent[find(a)] = find(b)
    low = {}
    for k in range(len(rows)):
        low[find(k)] = min(low.get(find(k), float("inf")), ids[k])
    return sorted((ids[k], low[find(k)], links[k]) for k in range(len(rows)))


def found_rows(df):
    inf = float("inf")
    return sorted((inf if r.doc_id is None else r.doc_id, inf if r.class_id is None else r.class_id,
                   r.n_links) for r in df.collect())


def family(n, seed=3, length=60, edits=3):
    """Near copies of one text, some of them not similar to each other."""
    rng = random.Random(seed)
    base = [f"w{rng.randrange(500)}" for _ in range(length)]
    rows = []
    for k in range(n):
        words = list(base)
        for _ in range(rng.randrange(edits)):
            words[rng.randrange(length)] = f"x{k}"
        rows.append((1000 + k, " ".join(words), "en"))
    return rows


def test_matches_brute_force(make_docs, corpus):
    rows = corpus + family(40) + [(2000 + i, t, g) for i, t, g in family(25, seed=8, edits=5)]
    assert found_rows(N.jaccard_classes(make_docs(rows))) == brute(rows)


def test_large_bucket_is_cut_into_blocks(make_docs, monkeypatch):
    rows = family(60) + [(5000 + k, t, g) for k, t, g in family(60)[:9]]
    for block, size in ((7, N.BLOCK_BYTES), (N.BLOCK, 4000), (N.BLOCK, 8)):
        monkeypatch.setattr(N.candidate_members, "__defaults__", (block, size))
        assert found_rows(N.jaccard_classes(make_docs(rows))) == brute(rows)


def test_one_of_each_class_stays(make_docs, corpus):
    rows = corpus + family(30)
    docs = make_docs(rows)
    kept = N.keep_one(docs)
    assert kept.columns == docs.columns
    expected = brute(rows)
    heads = {(c, i) for i, c, _ in expected if i == c}
    assert sorted(i for _, i in heads if i != float("inf")) == sorted(
        r.doc_id for r in kept.collect() if r.doc_id is not None)


def test_empty_and_wordless(make_docs):
    assert N.jaccard_classes(make_docs([])).collect() == []
    rows = [(1, None, "en"), (2, "", "en"), (3, " \n ", "en")]
    assert found_rows(N.jaccard_classes(make_docs(rows))) == [(1, 1, 0), (2, 2, 0), (3, 3, 0)]


def test_recall_of_candidates_near_the_threshold():
    """Signatures of random pairs just above the threshold share a band."""
    rng = np.random.default_rng(5)
    missed = 0
    for _ in range(300):
        pool = rng.integers(0, 1 << 63, 200, dtype=np.uint64)
        a, b = np.unique(pool[:180]), np.unique(pool[20:])     # similarity 0.8
        signed = np.stack([N.signature(a), N.signature(b)])
        keys = N.band_keys(signed)
        missed += not (keys[0] == keys[1]).any()
    assert missed == 0


def test_pruning_bound_is_the_posterior():
    """A pair that just passes has posterior probability at least the tolerance."""
    for n, m in N.least_matches().items():
        grid = np.linspace(0, 1, 200_001)
        density = lambda k: grid ** k * (1 - grid) ** (n - k)
        share = lambda k: density(k)[grid >= 0.8].sum() / density(k).sum()
        assert share(m) >= N.TOLERANCE * 0.99
        assert m == 0 or share(m - 1) < N.TOLERANCE * 1.01


def test_dense_and_sparse_verification_agree():
    rng = np.random.default_rng(1)
    sets = [np.unique(rng.integers(0, 40, 30)).astype(np.uint64) for _ in range(12)]
    i, j = np.triu_indices(12, 1)
    dense = N.linked_pairs(sets, i, j, 0.5)
    sparse = np.concatenate([N.linked_pairs(sets, i[k: k + 1], j[k: k + 1], 0.5)
                             for k in range(len(i))])
    assert (dense == sparse).all()
