import hashlib
import re
from collections import defaultdict

from dailybars.llm import exact_dedup as X


def brute(rows):
    groups = defaultdict(list)
    for i, text, _ in rows:
        t = text or ""
        digest = hashlib.sha256(re.sub("[\x20\x09-\x0d]", "", t).encode()).hexdigest()
        groups[digest].append((-len(t), i is None, i or 0, i))
    out = []
    for digest, members in groups.items():
        keep = min(members)[3]
        out += [(m[3], keep, len(members), digest) for m in members]
    return out


def key(row):
    return tuple((x is None, x) if not isinstance(x, str) else (False, x) for x in row)


def rows_of(df):
    return sorted(((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in df.collect()), key=key)


def test_matches_brute_force_with_and_without_heavy_digests(make_docs, corpus):
    docs = make_docs(corpus)
    for limit in (1, 1000):
        found = X.exact_dedup(docs, limit=limit)
        assert rows_of(found) == sorted(brute(corpus), key=key)
        kept = found.where("kept").groupBy("text_sha256").count()
        assert kept.where("count <> 1").count() == 0
        assert kept.count() == found.select("text_sha256").distinct().count()


def test_longest_original_text_stays(make_docs):
    docs = make_docs([(1, "ab", "en"), (2, "a b", "en"), (3, "a\tb", "en"), (4, "a  b", "en")])
    found = {r.doc_id: (r.keep_id, r.kept) for r in X.exact_dedup(docs).collect()}
    assert found == {1: (4, False), 2: (4, False), 3: (4, False), 4: (4, True)}


def test_keep_first_returns_document_columns_once(make_docs, corpus):
    docs = make_docs(corpus)
    kept = X.keep_first(docs)
    assert kept.columns == docs.columns
    assert kept.count() == len({r[3] for r in brute(corpus)})


def test_empty_table(make_docs):
    assert X.exact_dedup(make_docs([])).collect() == []
    assert X.keep_first(make_docs([])).collect() == []


def test_main_path_has_no_python(make_docs, corpus):
    from conftest import explain_text
    plan = explain_text(X.settle(X.materialise(
        make_docs(corpus).select("doc_id", *X.digest_columns()), "digests")))
    assert not re.search("Python|Pandas|Arrow", plan)
