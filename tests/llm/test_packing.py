import zlib
from collections import defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from dailybars.llm import packing as P
from dailybars.llm import token_counts as C
from dailybars.llm.common import table
from dailybars.llm.encoding import Encoder, tokenizer_path

PATH = tokenizer_path(P.TOKENIZER)


def reference_ids(texts):
    plain = Tokenizer.from_file(PATH)
    return [e.ids for e in plain.encode_batch([t or "" for t in texts], add_special_tokens=False)]


ODD = ["", " ", "It's ALL  we'll\tsay\r\n", "naïve café ÉCOLE İstanbul", "日本語 テスト", "x\x1cy\x0bz\x85w",
       "a\u00a0b\u2028c", "<|endoftext|> <|startoftext|>x", "e\u0301 n\u0303", "₤½Ⅷ 12ab34", "'sfoo !'s",
       "moron### $$$%%%", "ſtraße ǅ", "\u200bzero", "a" * 3000]


def test_cached_encoding_equals_the_library():
    encoder = Encoder(PATH)
    for text, ids in zip(ODD, reference_ids(ODD)):
        assert np.frombuffer(encoder.ids(text), "<u4").tolist() == ids, text


@settings(max_examples=200, deadline=None)
@given(st.text(max_size=40))
def test_cached_encoding_of_any_text(text):
    encoder = test_cached_encoding_of_any_text.encoder
    assert np.frombuffer(encoder.ids(text), "<u4").tolist() == reference(text)


test_cached_encoding_of_any_text.encoder = Encoder(PATH)
_PLAIN = Tokenizer.from_file(PATH)


def reference(text):
    return _PLAIN.encode(text, add_special_tokens=False).ids


def check_packing(rows, texts, capacity):
    """Pieces rebuild the documents, sequences are gapless and not too long."""
    expected = []
    for (i, _, _), ids in zip(texts, reference_ids([t for _, t, _ in texts])):
        ids = np.array([*ids, P.END_ID], "<u4")
        expected += [(i is None, i or 0, p, lo, len(ids[lo: lo + capacity]),
                      zlib.crc32(ids[lo: lo + capacity].tobytes()))
                     for p, lo in enumerate(range(0, len(ids), capacity))]
    assert sorted((r.doc_id is None, r.doc_id or 0, r.piece, r.start, r.length, r.ids_crc32)
                  for r in rows) == sorted(expected)
    sequences = defaultdict(list)
    for r in rows:
        sequences[r.sequence_id].append((r.offset, r.length))
    for held in sequences.values():
        at = 0
        for offset, length in sorted(held):
            assert offset == at
            at += length
        assert at <= capacity
    return len(sequences)


def test_packs_whole_documents(make_docs, corpus):
    rows = P.best_fit_packing(make_docs(corpus)).collect()
    n = check_packing(rows, corpus, P.CAPACITY)
    assert n == -(-sum(r.length for r in rows) // P.CAPACITY)


def test_small_capacity(make_docs, corpus):
    rows = P.best_fit_packing(make_docs(corpus), capacity=64).collect()
    n = check_packing(rows, corpus, 64)
    assert n <= 1.05 * sum(r.length for r in rows) / 64 + 1


def test_empty_table(make_docs):
    assert P.best_fit_packing(make_docs([])).collect() == []
    assert C.token_counts(make_docs([])).collect() == []


def first_fit_decreasing(lengths, capacity):
    free = []
    for n in sorted(lengths, reverse=True):
        for k, f in enumerate(free):
            if f >= n:
                free[k] -= n
                break
        else:
            free.append(capacity - n)
    return len(free)


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.integers(1, 50), st.integers(1, 30), max_size=20))
def test_plan_uses_every_piece_once(histogram):
    counts = np.zeros(51, dtype=np.int64)
    for n, c in histogram.items():
        counts[n] = c
    groups = P.plan_packing(counts, 50)
    used = np.zeros(51, dtype=np.int64)
    for times, held in groups:
        assert times > 0 and sum(n * each for n, each in held) <= 50
        for n, each in held:
            used[n] += times * each
    assert (used == counts).all()
    sequences = sum(t for t, _ in groups)
    lengths = np.repeat(np.arange(51), counts)
    assert sequences <= first_fit_decreasing(lengths, 50) * 1.1 + 1


def test_patterns_are_fitted_by_least_squares():
    """Lengths made of two patterns: the fit finds their counts."""
    counts = np.zeros(101, dtype=np.int64)
    counts[[60, 40]] = 500
    counts[[30, 70]] = 200
    patterns = P.enumerate_patterns([30, 40, 60, 70], 100)
    x = dict(zip(patterns, P.fit_counts(patterns, counts, sweeps=200)))
    assert x[(60, 40)] == pytest.approx(500, abs=30)
    assert sum(t for t, _ in P.plan_packing(counts, 100)) == 700


def test_histogram_answers_every_limit(spark, make_docs, corpus):
    for docs, texts in ((make_docs(corpus), [t for _, t, _ in corpus]),
                        (table(spark, "/root/testdata/sf0.001", "documents"), None)):
        if texts is None:
            texts = [r.text for r in docs.select("text").collect()]
        lengths = np.array([len(i) for i in reference_ids(texts)])
        rows = C.token_counts(docs).collect()
        assert sorted(r.context_limit for r in rows) == sorted({*lengths.tolist(), *C.LIMITS})
        for r in rows:
            limit = r.context_limit
            assert r.documents_at == (lengths == limit).sum()
            assert r.documents_fitting == (lengths <= limit).sum()
            assert r.documents_longer == (lengths > limit).sum()
            assert r.tokens_fitting == lengths[lengths <= limit].sum()
            assert r.tokens_truncated == np.minimum(lengths, limit).sum()
            assert r.tokens_total == lengths.sum()
            assert r.quantile == pytest.approx((lengths <= limit).mean())
        histogram = C.length_histogram(docs)
        asked = [0, 7, 13, 13, 1000, 4097, 10**9, -1, None, int(lengths.max())]
        found = {r.context_limit: r for r in C.answers(histogram, asked).collect()}
        assert sorted(found) == sorted({n for n in asked if n is not None and n >= 0})
        for limit, r in found.items():
            assert r.documents_fitting == (lengths <= limit).sum()
            assert r.tokens_truncated == np.minimum(lengths, limit).sum()
        median = C.quantile_length(histogram, 0.5).first().length
        assert median == np.sort(lengths)[-(-len(lengths) // 2) - 1]
