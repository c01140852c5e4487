import math
import random
import zlib

import numpy as np
import pytest

from dailybars.llm import langid as L
from dailybars.llm.common import table


def trigrams(text):
    seq = ["_"]
    for c in text.lower():
        if c.isalpha():
            seq.append(c)
        elif seq[-1] != "_":
            seq.append("_")
    if seq[-1] != "_":
        seq.append("_")
    return [tuple(seq[k - 1: k + 2]) for k in range(1, len(seq) - 1) if seq[k] != "_"]


def vector(text):
    numbers = L._letter_numbers()
    total = np.zeros(L.DIM)
    for t in trigrams(text):
        a, b, c = (L._letter_vector(1 if x == "_" else int(numbers[ord(x)]), L.DIM).astype(int)
                   for x in t)
        total += np.roll(a, 2) * np.roll(b, 1) * c
    return total


def cosine(a, b):
    size = np.linalg.norm(a) * np.linalg.norm(b)
    return float(a @ b / size) if size else 0.0


def brute(rows):
    prototypes = {}
    for i, text, lang in rows:
        if i is not None and text is not None and lang and zlib.crc32(str(i).encode()) % 4 != 2:
            prototypes[lang] = prototypes.get(lang, 0) + vector(text)
    out = []
    for i, text, _ in rows:
        v = vector(text or "")
        if not prototypes or not v.any():
            out.append((i, "und", 0.0))
            continue
        best = max(sorted(prototypes), key=lambda g: cosine(v, prototypes[g]))
        out.append((i, best, min(max(cosine(v, prototypes[best]), 0), 1)))
    return out


def test_matches_brute_force(make_docs, corpus):
    found = [(r.doc_id, r.lang_pred, r.score) for r in L.identify(make_docs(corpus)).collect()]
    expected = brute(corpus)
    order = lambda r: (r[0] is None, r[0] or 0, r[1], r[2])
    for a, b in zip(sorted(found, key=order), sorted(expected, key=order), strict=True):
        assert a[:2] == b[:2] and math.isclose(a[2], b[2], abs_tol=1e-5)


def test_held_out_flag(make_docs, corpus):
    for r in L.identify(make_docs(corpus)).collect():
        assert r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 4 == 2)


def test_held_out_accuracy_on_documents(spark):
    docs = table(spark, "/root/testdata/sf0.001", "documents")
    found = L.identify(docs).join(docs.select("doc_id", "lang"), "doc_id").where("held_out")
    good = found.where("lang = lang_pred").count()
    assert good >= 0.95 * found.count()


def test_no_training_rows_and_empty_table(make_docs):
    assert {r.lang_pred for r in L.identify(make_docs([(1, "hello", None)])).collect()} == {"und"}
    assert L.identify(make_docs([])).collect() == []


def test_stage_drops_only_texts_without_language(make_docs, corpus):
    docs = make_docs(corpus)
    kept = L.keep_identified(docs)
    assert kept.columns == docs.columns
    lettered = [i for i, t, _ in corpus if t and any(c.isalpha() for c in t)]
    assert kept.count() == len(lettered)


SHORT = ["OK", "No", "Yes", "Why so?", "Johnny Cash", "My dog skips happily", "Hello", "Thank you",
         "Ja", "Guten Tag", "Wie geht es", "Merci", "Au revoir", "Hola", "Buenos dias", "Я", "日本"]
SCRIPTS = [range(0x430, 0x450), range(0x3B1, 0x3CA), range(0x627, 0x64B), range(0x5D0, 0x5EB),
           range(0x915, 0x93A), range(0x4E00, 0x5600), range(0xAC00, 0xB500), range(0x10D0, 0x10F1)]
PROSE = ["the children walked home after school because the bus was late again",
         "this recipe needs two eggs and a little milk",
         "wir haben gestern einen langen spaziergang durch den wald gemacht",
         "les enfants sont dans le jardin avec leur mère et leur père"]


def prose_like(rng, letters, n):
    """Words of a made-up vocabulary, the first ones most often."""
    words = ["".join(rng.choices(letters, k=rng.randint(2, 8))) for _ in range(200)]
    return " ".join(rng.choices(words, [1 / (k + 1) for k in range(200)], k=n))


def test_stage_keeps_short_texts_and_drops_foreign_ones(spark):
    """Planted texts without label, so nothing is learnt from them."""
    rng = random.Random(5)
    docs = table(spark, "/root/testdata/sf0.001", "documents").select("doc_id", "text", "lang")
    foreign = [prose_like(rng, [chr(c) for c in s], n) for s in SCRIPTS for n in (25, 100, 2000)
               for _ in range(5)]
    foreign += [prose_like(rng, "abcdefghijklmnopqrstuvwxyz", n) for n in (25, 100, 2000)
                for _ in range(5)]
    foreign += [" ".join("".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=6)) for _ in range(n))
                for n in (25, 100, 20_000) for _ in range(5)]
    planted = [(10_000_000 + k, t, None) for k, t in enumerate(SHORT + PROSE + foreign)]
    kept = {r.doc_id for r in L.keep_identified(docs.unionByName(
        spark.createDataFrame(planted, docs.schema))).collect()}
    clean = {i for i, _, _ in planted[:len(SHORT + PROSE)]}
    assert clean <= kept
    assert sum(i in kept for i, _, _ in planted[len(clean):]) <= len(foreign) // 50
    lettered = {r.doc_id for r in docs.collect() if r.text and any(c.isalpha() for c in r.text)}
    assert lettered <= kept


def test_barely_learnt_language_does_not_let_everything_pass(spark):
    rng = random.Random(6)
    docs = table(spark, "/root/testdata/sf0.001", "documents").select("doc_id", "text", "lang")
    tiny = next(i for i in range(20_000_000, 20_000_100) if zlib.crc32(str(i).encode()) % 4 != 2)
    planted = [(tiny, "qx zw", "xx")] + [
        (30_000_000 + k, prose_like(rng, [chr(c) for c in SCRIPTS[k % 8]], 100), None)
        for k in range(40)]
    kept = {r.doc_id for r in L.keep_identified(docs.unionByName(
        spark.createDataFrame(planted, docs.schema))).collect()}
    assert sum(i in kept for i, _, _ in planted[1:]) <= 4


@pytest.mark.parametrize("text", ["", "ǅ ß İ", "\x00a\x00", "x" * 100_000])
def test_counts_one_trigram_per_letter(text):
    owner, codes, counts = L.trigram_counts([text, "ab"])
    letters = sum(c.isalpha() for c in text.lower())
    assert counts[owner == 0].sum() == letters and counts[owner == 1].sum() == 2


def test_every_letter_has_a_vector_of_its_own():
    letters = [chr(c) for c in range(0x250, 0x30000) if chr(c).isalpha()]
    _, codes, _ = L.trigram_counts([" ".join(letters)])
    assert len(codes) == len({c.lower() for c in letters})
    greek = [L._letter_vector(int(L._letter_numbers()[ord(c)]), L.DIM).astype(int) for c in "αβγδжзий中文"]
    products = np.array(greek) @ np.array(greek).T - L.DIM * np.eye(len(greek))
    assert np.abs(products).max() < 0.2 * L.DIM
