import random
import re
from collections import Counter, defaultdict

import pytest

from dailybars.llm import divergence as dv

# The contract's terms; the operator splits at what they exclude.
TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, min_docs, top_terms=50):
    """The contract, term by term, from (text, lang, source) rows."""
    langs = defaultdict(list)
    for text, lang, source in rows:
        langs[lang or ""].append((source or "", TERM.findall((text or "").translate(LOWER))))
    out = []
    for lang, docs in langs.items():
        df = Counter(t for _, terms in docs for t in set(terms))
        kept = {t for t, n in df.items() if n >= min_docs}
        counts = defaultdict(Counter)
        for source, terms in docs:
            counts[source].update(t for t in terms if t in kept)
        whole = sum(counts.values(), Counter())

        def share(c, t):
            return 1 + 10**9 * (c[t] + 5) // (sum(c.values()) + 5 * len(kept))

        for source, mine in counts.items():
            pairs = [(-sum(abs(share(mine, t) - share(theirs, t)) for t in kept), item)
                     for item, theirs in counts.items() if item != source]
            over = [(share(whole, t) - share(mine, t), t) for t in mine
                    if share(mine, t) > share(whole, t)]
            for part, found in (("pair", pairs), ("term", over)):
                found.sort(key=lambda x: (x[0], x[1].encode()))
                for rank, (value, item) in enumerate(found, 1):
                    if part == "pair" or rank <= top_terms:
                        out.append((lang, source, part, item, -value, rank))
    return sorted(out)


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(3)
    words = [f"wort{chr(97 + k // 26)}{chr(97 + k % 26)}" for k in range(80)] + [
        "Über", "ÄÖ", "日本", "😀x", "É", "the", "THE", "The"]
    out = []
    for k in range(400):
        lang = rng.choice(["en", "en", "en", "de", "de", "fr", None])
        source = rng.choice(["a", "a", "a", "b", "B", "ß", None])
        skew = {"a": 10, "b": 40}.get(source, len(words))
        out.append((" ".join(rng.choice(words[:skew]) + rng.choice(["", "!", "1", "\n"])
                             for _ in range(rng.randrange(0, 60))), lang, source))
    out += [(None, "en", "empty"), ("", "en", "empty"), ("12 34", "xx", "only"),
            ("alone", "yy", "s1"), ("apart", "yy", "s2"), (None, None, None),
            ("the " * 50_000, "en", "long"), ("tie", "zz", "q"), ("tie", "zz", "p"),
            ("tie", "zz", "r")]
    return out


@pytest.fixture(scope="module")
def frame(spark, rows):
    def make(rows):
        data = [(7, t, g, s, 1, "x", "x", 2) for t, g, s in rows]
        return spark.createDataFrame(
            data, "doc_id long, text string, lang string, source string, rank int, term string, "
                  "folder string, n int")
    return make


def result(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.mark.parametrize("min_docs", [3, 30])
def test_equals_brute_force(frame, rows, min_docs):
    got = dv.source_divergence(frame(rows), min_docs=min_docs)
    assert got.columns == ["lang", "source", "part", "item", "value", "rank"]
    assert result(got) == brute(rows, min_docs)


def test_shards_of_the_vocabulary_change_nothing(frame, rows, monkeypatch):
    monkeypatch.setattr(dv, "SAMPLE_EVERY", 1)
    assert result(dv.source_divergence(frame(rows), min_docs=3, shard_terms=30)) == brute(rows, 3)


def test_term_report_has_a_limit(frame, rows):
    assert result(dv.source_divergence(frame(rows), min_docs=3, top_terms=4)) == brute(rows, 3, 4)


def test_empty_table_and_no_kept_terms(frame, rows):
    assert result(dv.source_divergence(frame([]))) == []
    few = rows[:5] + [("a b", "en", "z")]
    got = result(dv.source_divergence(frame(few)))
    assert got == brute(few, 30)
    assert all(r[2] == "pair" and r[4] == 0 for r in got)


def test_shares_are_exact_beyond_a_long(spark):
    big = spark.createDataFrame([(4 * 10**12, 9 * 10**15, 12345)], "n long, total long, v long")
    got = big.select(dv._share("n", "total")).first()[0]
    assert got == 1 + 10**9 * (4 * 10**12 + 5) // (9 * 10**15 + 5 * 12345)


@pytest.mark.parametrize("text", ["", "A\x00b\x7fC", "ÀÉÿ\u0100\U0001F600x", "\x85a\xa0b\u2028c", "a" * 9 + "\t" * 9,
                                  "".join(map(chr, range(256)))])
def test_terms_of_odd_characters(frame, text):
    row = dv.term_lists(frame([(text, "en", "s")])).first()
    terms = TERM.findall(text.translate(LOWER))
    assert row.every.split(" ") == (terms or [""])
    assert sorted(row.different.split(" ")) == (sorted(set(terms)) or [""])


def test_a_terms_number_is_its_own(frame, rows, monkeypatch):
    """Also of a word that several languages or shards have; sums are as counted."""
    monkeypatch.setattr(dv, "SAMPLE_EVERY", 1)
    written = dv.write_terms(frame(rows))
    for shard_terms in (dv.SHARD_TERMS, 30):
        got = dv.group_counts(written, 3, shard_terms).collect()
        numbers = defaultdict(set)
        for r in got:
            numbers[r.number].add((r.lang, r.term))
        assert all(len(terms) == 1 for terms in numbers.values())
        assert len(numbers) == len({(r.lang, r.term) for r in got})
        counts = defaultdict(Counter)
        for text, lang, source in rows:
            counts[lang or "", source or ""].update(TERM.findall((text or "").translate(LOWER)))
        assert all(counts[r.lang, r.source][r.term] == r.n for r in got)
        assert len({(r.lang, r.source, r.term) for r in got}) == len(got)


def test_pairs_are_summed_by_numbers(spark):
    """Terms meet by their number, not by their text."""
    groups = spark.createDataFrame(
        [("en", s, 10, 2, 4, p0, g) for g, (s, p0) in enumerate([("a", 3), ("b", 5), ("c", 7)])],
        "lang string, source string, total long, present long, v long, absent long, group long")
    shares = spark.createDataFrame(
        [(0, 1, "x", 30, 3), (0, 2, "y", 9, 3), (1, 1, "x", 20, 5)],
        "group long, number long, term string, p long, absent long")
    got = {(r.source, r.item): r.value for r in dv.pair_distances(groups, shares).collect()}
    p = {"a": (30, 9, 3, 3), "b": (20, 5, 5, 5), "c": (7, 7, 7, 7)}
    assert got == {(s, t): sum(abs(x - y) for x, y in zip(p[s], p[t]))
                   for s in p for t in p if s != t}
