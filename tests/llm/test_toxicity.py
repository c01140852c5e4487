import zlib

import numpy as np
import pytest

from dailybars.llm import toxicity as T

GENTLE = "the garden was quiet and the children read their books near the river bank".split()
NASTY = {"en": ["idiot", "moron", "scum"], "xx": ["grublak", "grublor", "grublix", "grublen"]}


def labelled(n=600):
    rng = np.random.default_rng(2)
    docs, labels = [], []
    for i in range(n):
        lang = ("en", "xx")[i % 2]
        toxic = i % 5 == 0
        words = [f"{w}{rng.integers(60)}" if rng.random() < 0.3 else w
                 for w in rng.choice(GENTLE, 30)]
        if toxic:
            for w in rng.choice(NASTY[lang], 2, replace=False):
                words.insert(int(rng.integers(30)), str(w))
        docs.append((i, " ".join(words), lang))
        labels.append((i, 1, int(toxic)))
    return docs, labels


@pytest.fixture(scope="module")
def labels_of(spark):
    return lambda rows: spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


def test_held_out_documents_are_told_apart(make_docs, labels_of):
    docs, labels = labelled()
    # Labels of held-out rows are turned round: they must not be learnt from.
    turned = [(i, q, 1 - t if zlib.crc32(str(i).encode()) % 5 == 0 else t) for i, q, t in labels]
    truth = {i: t for i, _, t in labels}
    odd = [(9001, None, "en"), (9002, "", "en"), (None, "you idiot moron scum", "en"),
           (9003, "quiet garden " * 3000, "en"), (5, docs[5][1], "xx")]
    found = T.toxicity(make_docs(docs + odd), labels_of(turned + [(None, 1, 1), (7777, 1, None)]))
    rows = found.collect()
    assert found.columns == ["doc_id", "held_out", "score", "predicted"]
    assert len(rows) == len(docs) + len(odd)
    for r in rows:
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5)
        assert r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
        if r.doc_id in truth:
            assert r.predicted == truth[r.doc_id], r
    other = {r.doc_id: r.predicted for r in rows if r.doc_id not in truth}
    assert other == {9001: 0, 9002: 0, 9003: 0, None: 1}


def test_stage_keeps_clean_documents(make_docs, labels_of):
    docs, labels = labelled(300)
    frame = make_docs(docs)
    kept = T.keep_clean(frame, labels_of(labels))
    assert kept.columns == frame.columns
    assert sorted(r.doc_id for r in kept.collect()) == [i for i, _, t in labels if not t]


def test_empty_tables_and_no_labels(make_docs, labels_of):
    assert T.toxicity(make_docs([]), labels_of([])).collect() == []
    rows = T.toxicity(make_docs([(1, "you idiot moron", "en"), (2, "a quiet day", "en")]),
                      labels_of([])).collect()
    scores = {r.doc_id: r.score for r in rows}
    assert scores[1] > scores[2]


def test_label_model_recovers_accuracies_and_correlations():
    """Votes drawn from a known model: rates are found without labels, and a
    voter that copies another is seen as correlated and discounted."""
    rng = np.random.default_rng(0)
    n, m = 40_000, len(T.VOTERS)
    y = rng.random(n) < 0.2
    hit = [k for k, v in enumerate(T.VOTERS) if v != "no_hit"]
    votes = np.zeros((n, m))
    for k in hit:
        votes[:, k] = rng.random(n) < np.where(y, 0.7, 0.05)
    votes[:, hit[1]] = votes[:, hit[0]]       # a voter that copies another
    votes[:, T.VOTERS.index("no_hit")] = ~votes[:, hit].any(axis=1)
    patterns, counts = np.unique(votes, axis=0, return_counts=True)
    model = T.LabelModel(patterns, counts.astype(float), 0.2)
    assert np.abs(model.rates[1, hit[2:]] - 0.7).max() < 0.05
    assert np.abs(model.rates[0, hit[2:]] - 0.05).max() < 0.03
    assert model.correlations[hit[0], hit[1]] > 0.9
    assert model.discount[hit[0]] < 0.6 < model.discount[hit[5]]
    assert ((model.posterior(votes) > 0.5) == y).mean() > 0.97


def test_label_model_of_mostly_toxic_documents():
    """The share is not held below a half."""
    rng = np.random.default_rng(3)
    n = 20_000
    y = rng.random(n) < 0.8
    votes = np.zeros((n, len(T.VOTERS)))
    for k, v in enumerate(T.VOTERS):
        if v != "no_hit":
            votes[:, k] = rng.random(n) < np.where(y, 0.6, 0.05)
    votes[:, -1] = ~votes[:, :-1].any(axis=1)
    patterns, counts = np.unique(votes, axis=0, return_counts=True)
    model = T.LabelModel(patterns, counts.astype(float), 0.8)
    assert ((model.posterior(votes) > 0.5) == y).mean() > 0.97


def test_classifier_is_the_minimum_of_its_loss():
    """Against plain gradient descent on a dense matrix of the same features."""
    rng = np.random.default_rng(1)
    n, words = 200, 30
    votes = rng.integers(0, 3, (n, len(T.VOTERS))).astype(float)
    places = [np.sort(rng.choice(words, rng.integers(0, 9), replace=False)) for _ in range(n)]
    y = np.clip((votes[:, 0] > 1) * 0.9 + 0.05 * rng.random(n), 0.01, 0.99)
    weight = rng.random(n) + 0.5
    docs = T.Documents(votes, np.concatenate(places), np.cumsum([len(p) for p in places]))
    found = T.fit_classifier(docs, y, weight, rounds=400)
    x = np.zeros((n, 1 + len(T.VOTERS) + words))
    x[:, 0], x[:, 1: 1 + len(T.VOTERS)] = 1, np.log1p(votes)
    for k, p in enumerate(places):
        x[k, 1 + len(T.VOTERS) + p] = 1 / np.sqrt(max(len(p), 1))
    penalty = np.array([0.0, *[T.RIDGE] * len(T.VOTERS), *[T.WORD_RIDGE] * words])
    w, share = np.zeros(x.shape[1]), weight / weight.sum()
    for _ in range(500):           # Newton's steps on the dense matrix
        p = 1 / (1 + np.exp(-x @ w))
        slope = x.T @ (share * (p - y)) + penalty * w
        w -= np.linalg.solve((x * (share * p * (1 - p))[:, None]).T @ x + np.diag(penalty + 1e-12), slope)
    assert np.abs(found[: x.shape[1]] - w).max() < 0.02
    assert np.abs(docs.scores(found) - 1 / (1 + np.exp(-x @ w))).max() < 0.005


def test_features_by_hand():
    voters = T.Voters(["w:grublak", "4:grub", "p:quiet menace", "p:grublak tree"])
    row, places = voters.features("You grublak, grublak! a quiet menace. STUPID")
    assert dict(zip(T.VOTERS, row)) == {
        "words": 1, "heads_4": 1, "heads_5": 0, "pairs": 1, "insults": 1, "addressed": 1,
        "two_words": 1, "two_heads": 0, "repeated": 1, "dense": 1, "shouting": 1, "no_hit": 0}
    assert len(places) == 6
    row, places = voters.features("")
    assert sum(row) == row[T.VOTERS.index("no_hit")] == 1 and places == []


def test_documents_without_hits_have_scores_of_their_own(make_docs, labels_of):
    docs, labels = labelled(400)
    rows = T.toxicity(make_docs(docs), labels_of(labels)).collect()
    clean = {i for i, _, t in labels if not t}
    scores = [r.score for r in rows if r.doc_id in clean]
    most = max(scores.count(s) for s in set(scores))
    assert most < len(scores) / 2
