import math

import numpy as np
import pytest

from dailybars.llm import va_search as V


@pytest.fixture(scope="module")
def make_vectors(spark):
    return lambda rows: spark.createDataFrame(
        [(*r, 0, "x", 1.5) for r in rows],
        "vec_id long, embedding array<float>, label int, rank string, score double")


def brute(rows, top=5, every=50):
    """Every row against every other; the rows of a query id share a list."""
    good = [(i, [math.floor(256 * float(np.float32(x))) for x in v]) for i, v in rows
            if i is not None and v and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for q in sorted({i for i, _ in good if i % every == 0}):
        scores = sorted((-sum(x * y for x, y in zip(a, b)), i) for p, a in good if p == q
                        for i, b in good if i != q and len(a) == len(b))
        out += [(q, k + 1, i, -s) for k, (s, i) in enumerate(scores[:top])]
    return sorted(out)


def rows_of(df):
    assert df.columns == ["query_id", "rank", "vec_id", "score"]
    return sorted(tuple(r) for r in df.collect())


def test_matches_brute_force(make_vectors):
    rng = np.random.default_rng(4)
    rows = [(i, [float(x) for x in np.float32(rng.normal(0, 0.2, 16))]) for i in range(700)]
    rows += [(900 + k, rows[3][1]) for k in range(40)]                  # ties
    rows += [(2000, None), (2050, []), (2100, [None] * 16), (2150, [float("nan")] * 16),
             (2200, [float("inf")] + [0.0] * 15), (None, rows[0][1]), rows[50], rows[50],
             (3000, [0.5, 0.25]), (3001, [1.0, 1.0]), (3050, [-1.0, 2.0])]   # another dimension
    found = V.top_k(make_vectors(rows), row_block=64, query_block=4)
    assert rows_of(found) == brute(rows)


def test_repeated_ids_with_other_vectors_all_take_part(make_vectors):
    """As the SQL: every row is a candidate, the rows of a query id share a list."""
    rng = np.random.default_rng(8)
    draw = lambda: [float(x) for x in np.float32(rng.normal(0, 0.2, 8))]
    rows = [(i, draw()) for i in range(300)] + [(i % 60, draw()) for i in range(150)]
    rows += rows[:20]                                # the same id and vector again
    assert rows_of(V.top_k(make_vectors(rows), row_block=64, query_block=4)) == brute(rows)


def test_equal_rows_are_candidates_each(make_vectors):
    rows = [(50, [1.0, 0.0]), (1, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [0.5, 0.0])]
    assert [r[2] for r in rows_of(V.top_k(make_vectors(rows)))] == [1, 1, 2]


def test_equal_and_odd_rows_match_the_sql(spark, make_vectors):
    import duckdb

    from dailybars.llm.queries import ORACLE_SQL
    rng = np.random.default_rng(9)
    rows = [(i % 130, [float(x) for x in np.float32(rng.normal(0, 0.3, 6))]) for i in range(260)]
    rows += rows[:40]
    con = duckdb.connect()
    con.sql("CREATE TABLE embeddings (vec_id BIGINT, embedding FLOAT[])")
    con.executemany("INSERT INTO embeddings VALUES (?, ?)", rows)
    wanted = sorted(con.sql(f"SELECT query_id, rank, vec_id, score FROM ({ORACLE_SQL['op3_exact_top_k']})")
                    .fetchall())
    # Rows without finite components are out in both.
    odd = [(200, [float("nan")] * 6), (201, [float("inf")] + [0.0] * 5), (250, None), (251, [])]
    assert rows_of(V.top_k(make_vectors(rows + odd), row_block=32, query_block=3)) == wanted


def test_rows_of_other_blocks_are_ruled_out(spark, make_vectors, monkeypatch):
    """What the second pass writes for a query does not follow the blocks."""
    written = {}
    real = V.materialise
    monkeypatch.setattr(V, "materialise", lambda f, n: written.setdefault(n, real(f, n)))
    rng = np.random.default_rng(10)
    rows = [(k, [float(x) for x in np.float32(rng.normal(0, 0.2, 24))]) for k in range(1500)]
    assert rows_of(V.top_k(make_vectors(rows), row_block=32, query_block=8)) == brute(rows)
    per_query = written["in-order"].groupBy("query_id").count().agg({"count": "max"}).first()[0]
    assert per_query < 150          # of 1,499; each of 47 blocks alone would leave 5


def test_constant_and_huge_components(make_vectors):
    rows = [(i, [0.0, 1.0]) for i in range(4)] + [(50, [1e30, 1.0]), (51, [1e30, -1.0])]
    found = {(q, r): (v, s) for q, r, v, s in rows_of(V.top_k(make_vectors(rows)))}
    assert found[0, 1] == (1, 65536) and found[50, 1] == (51, 2 ** 63 - 1)


def test_few_rows_and_empty_table(make_vectors):
    assert rows_of(V.top_k(make_vectors([]))) == []
    assert rows_of(V.top_k(make_vectors([(0, [1.0])]))) == []
    assert rows_of(V.top_k(make_vectors([(0, [1.0]), (7, [2.0])]))) == [(0, 1, 7, 131072)]


def test_bounds_hold():
    rng = np.random.default_rng(0)
    ints = rng.integers(-300, 300, (200, 12))
    edges = V.cell_borders(ints.min(axis=0), ints.max(axis=0))
    cells = np.stack([np.clip(np.searchsorted(edges[d], ints[:, d], "right") - 1, 0, V.CELLS - 1)
                      for d in range(12)], axis=1).astype(np.uint8)
    low, high = V.score_bounds(ints[:20], cells, edges)
    exact = ints[:20] @ ints.T
    assert (low <= exact).all() and (exact <= high).all()
