"""Exact top-k inner-product search with vector-approximation files.

1. Components become the integers floor(256 x). The range of every dimension
   is cut into 64 cells; the approximation file holds one byte per component.
2. Blocks of queries meet blocks of approximations. For each pair the cell
   borders give an upper and a lower bound of the score. A first pass returns
   only each block's k best lower bounds, from which every query gets its k-th
   lower bound over all blocks; a second pass returns the rows whose upper bound
   reaches it. So a row that another block rules out is never written.
3. Exact vectors are read in the order of upper bounds: first the best 2 k,
   which give the k-th score so far, then exactly those rows whose upper bound
   still reaches it. The result is then certain.

Work is the stated queries times all rows, in blocks of bounded size; the
exact vectors are read for few rows only.

Defined results: vectors that are NULL, empty or hold NULL or non-finite
components take no part, nor do rows without an id; rows that repeat an id, with
the same vector or another, all take part, and the rows of one query id share
one list, as in the SQL; only vectors of the same dimension are compared; equal scores go to the smaller id; a query with fewer
candidates gets all of them; components saturate at the range of a long and scores at
that of a long; an empty table gives an empty result; extra columns are
ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import column_of, materialise

SCALE = 256
CELLS = 64
TOP = 5
QUERY_EVERY = 50
ROW_BLOCK = 4096
QUERY_BLOCK = 512
_LONG = np.iinfo(np.int64)


def integer_vectors(embeddings: DataFrame, vector: str = "embedding") -> DataFrame:
    """(row, vec_id, dim, ints) of the vectors that take part; ``row`` is
    unique once the table is written."""
    x = F.col(vector)
    whole = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    ints = F.transform(x, lambda v: F.floor(F.lit(SCALE) * v.cast("double")))
    rows = (embeddings.where(F.col("vec_id").isNotNull() & x.isNotNull())
            .where((F.size(x) > 0) & whole)
            .select(F.col("vec_id").cast("long").alias("vec_id"), ints.alias("ints")))
    return rows.select(F.monotonically_increasing_id().alias("row"), "vec_id",
                       F.size("ints").alias("dim"), "ints")


def _matrix(column: pa.Array) -> np.ndarray:
    """Rows of a list column as a matrix; all rows have the same length."""
    values = np.asarray(column.flatten())
    return values.reshape(len(column), -1)


def dimension_ranges(vectors: DataFrame) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """Least and greatest integer per place, for each vector dimension."""
    def span(batches):
        found: dict[int, list[np.ndarray]] = {}
        for batch in batches:
            dims = np.asarray(column_of(batch, "dim"))
            for dim in np.unique(dims):
                part = _matrix(column_of(batch, "ints").filter(pa.array(dims == dim)))
                low, high = part.min(axis=0), part.max(axis=0)
                if dim in found:
                    low = np.minimum(low, found[dim][0])
                    high = np.maximum(high, found[dim][1])
                found[int(dim)] = [low, high]
        for dim, (low, high) in found.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([dim] * dim, pa.int32()), pa.array(np.arange(dim), pa.int32()),
                 pa.array(low), pa.array(high)], names=["dim", "place", "low", "high"])

    rows = (vectors.select("dim", "ints").mapInArrow(
        span, "dim int, place int, low bigint, high bigint")
        .groupBy("dim", "place").agg(F.min("low").alias("low"), F.max("high").alias("high"))
        .orderBy("dim", "place").collect())
    return {dim: (np.array([r.low for r in rows if r.dim == dim]),
                  np.array([r.high for r in rows if r.dim == dim]))
            for dim in sorted({r.dim for r in rows})}


def cell_borders(low: np.ndarray, high: np.ndarray, cells: int = CELLS) -> np.ndarray:
    """Borders of the cells of every place: cell c holds border[c] .. border[c + 1]."""
    share = np.linspace(0.0, 1.0, cells + 1)
    low, high = low.astype(np.float64)[:, None], high.astype(np.float64)[:, None]
    return low + (high - low) * share


def approximate(vectors: DataFrame, borders: dict[int, np.ndarray], cells: int = CELLS) -> DataFrame:
    """(row, vec_id, dim, cells): the approximation file."""
    def run(batches):
        for batch in batches:
            dims = np.asarray(column_of(batch, "dim"))
            for dim in np.unique(dims):
                mine = pa.array(dims == dim)
                part = _matrix(column_of(batch, "ints").filter(mine)).astype(np.float64)
                edges = borders[int(dim)]
                found = np.empty(part.shape, dtype=np.uint8)
                for d in range(part.shape[1]):
                    found[:, d] = np.clip(np.searchsorted(edges[d], part[:, d], side="right") - 1,
                                          0, cells - 1)
                yield pa.RecordBatch.from_arrays(
                    [*(column_of(batch, c).filter(mine) for c in ("row", "vec_id", "dim")),
                     pa.array([r.tobytes() for r in found], pa.binary())],
                    names=["row", "vec_id", "dim", "cells"])

    return vectors.mapInArrow(run, "row bigint, vec_id bigint, dim int, cells binary")


def score_bounds(queries: np.ndarray, cells: np.ndarray, edges: np.ndarray
                 ) -> tuple[np.ndarray, np.ndarray]:
    """Lower and upper bounds of the inner products of queries and cells. The
    floating-point sums are widened by more than their rounding error."""
    places = np.arange(edges.shape[0])
    low, high = edges[places, cells], edges[places, cells.astype(np.int64) + 1]
    q = queries.astype(np.float64)
    plus, minus = np.maximum(q, 0), np.minimum(q, 0)
    slack = 1e-9 * (np.abs(q) @ np.maximum(np.abs(low), np.abs(high)).T) + 1e-6
    return plus @ low.T + minus @ high.T - slack, plus @ high.T + minus @ low.T + slack


def exact_scores(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Row-wise integer inner products, saturating."""
    most = float(np.abs(a.astype(np.float64)).max(initial=0)) * float(
        np.abs(b.astype(np.float64)).max(initial=0)) * max(a.shape[1], 1)
    if most < 2.0 ** 62:
        return (a * b).sum(axis=1)
    exact = (a.astype(object) * b.astype(object)).sum(axis=1)
    return np.array([min(max(s, _LONG.min), _LONG.max) for s in exact], dtype=np.int64)


def _bounds(queries: pa.Table, rows: pa.Table, borders: dict[int, np.ndarray]
            ) -> tuple[np.ndarray, np.ndarray]:
    """Lower and upper bounds of a block pair; minus infinity for a query's own
    id."""
    dim = queries["dim"][0].as_py()
    cells = np.frombuffer(b"".join(rows["cells"].to_pylist()), np.uint8).reshape(-1, dim)
    low, high = score_bounds(_matrix(queries["ints"].combine_chunks()), cells, borders[dim])
    own = np.asarray(queries["query_id"])[:, None] == np.asarray(rows["vec_id"])[None, :]
    low[own] = high[own] = -np.inf
    return low, high


def _best_lower(top: int, borders: dict[int, np.ndarray]):
    """First pass: the best lower bounds of a block, per query."""
    def run(queries: pa.Table, rows: pa.Table) -> pa.Table:
        ids, lows = np.zeros(0, np.int64), np.zeros(0)
        if queries.num_rows and rows.num_rows:
            low, _ = _bounds(queries, rows, borders)
            if low.shape[1] > top:
                low = -np.partition(-low, top - 1, axis=1)[:, :top]
            ids, lows = np.repeat(np.asarray(queries["query_id"]), low.shape[1]), low.ravel()
            ids, lows = ids[lows > -np.inf], lows[lows > -np.inf]
        return pa.table({"query_id": ids, "low": lows})

    return run


def _candidates(borders: dict[int, np.ndarray]):
    """Second pass: the rows whose upper bound reaches the query's k-th lower
    bound over all blocks (all rows, where it has none)."""
    def run(queries: pa.Table, rows: pa.Table) -> pa.Table:
        out = [np.zeros(0, np.int64)] * 4 + [np.zeros(0)]
        if queries.num_rows and rows.num_rows:
            _, high = _bounds(queries, rows, borders)
            kth = np.asarray(queries["kth_low"].fill_null(-np.inf))
            i, j = np.nonzero((high >= kth[:, None]) & (high > -np.inf))
            out = [np.asarray(queries["query_row"])[i], np.asarray(queries["query_id"])[i],
                   np.asarray(rows["row"])[j], np.asarray(rows["vec_id"])[j], high[i, j]]
        return pa.table(dict(zip(("query_row", "query_id", "row", "vec_id", "high"), out)))

    return run


def _scored(pairs: DataFrame, queries: DataFrame, vectors: DataFrame) -> DataFrame:
    """Exact scores of pairs of rows."""
    def run(batches):
        for batch in batches:
            scores = np.zeros(batch.num_rows, dtype=np.int64)
            a, b = column_of(batch, "query"), column_of(batch, "ints")
            size = np.diff(np.asarray(a.offsets)) if batch.num_rows else np.zeros(0)
            for dim in np.unique(size):
                mine = size == dim
                scores[mine] = exact_scores(_matrix(a.filter(pa.array(mine))),
                                            _matrix(b.filter(pa.array(mine))))
            yield pa.RecordBatch.from_arrays(
                [column_of(batch, "query_id"), column_of(batch, "vec_id"), pa.array(scores)],
                names=["query_id", "vec_id", "score"])

    joined = (pairs.select("query_row", "query_id", "row", "vec_id")
              .join(vectors.select("row", "ints"), "row")
              .join(queries.select("query_row", F.col("ints").alias("query")), "query_row"))
    return joined.mapInArrow(run, "query_id bigint, vec_id bigint, score bigint")


def top_k(embeddings: DataFrame, top: int = TOP, every: int = QUERY_EVERY,
          row_block: int = ROW_BLOCK, query_block: int = QUERY_BLOCK) -> DataFrame:
    """query_id, rank, vec_id, score of each query's ``top`` highest scores."""
    vectors = materialise(integer_vectors(embeddings), "vectors")
    borders = {d: cell_borders(*span) for d, span in dimension_ranges(vectors).items()}
    cells = materialise(approximate(vectors, borders), "approximations")
    queries = vectors.where(F.col("vec_id") % every == 0).withColumnsRenamed(
        {"row": "query_row", "vec_id": "query_id"})
    rows, asked = cells.count(), queries.count()
    row_blocks, query_blocks = -(-rows // row_block) or 1, -(-asked // query_block) or 1
    key = ["dim", "query_part", "row_part"]
    each = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    part = lambda c, n: F.pmod(F.xxhash64(c), F.lit(n)).cast("int")
    left = (queries.withColumn("query_part", part("query_row", query_blocks))
            .withColumn("row_part", each(row_blocks)))
    right = (cells.withColumn("row_part", part("row", row_blocks))
             .withColumn("query_part", each(query_blocks)))
    blocks = lambda asked: asked.groupBy(*key).cogroup(right.groupBy(*key))
    by_query = Window.partitionBy("query_id")
    best = F.row_number().over(by_query.orderBy(F.desc("low")))
    kth = (blocks(left).applyInArrow(_best_lower(top, borders), "query_id bigint, low double")
           .withColumn("n", best).where(F.col("n") == top)
           .select("query_id", F.col("low").alias("kth_low")))
    bounded = left.join(materialise(kth, "kth-low"), "query_id", "left")
    order = F.row_number().over(by_query.orderBy(F.desc("high"), "vec_id", "row", "query_row"))
    kept = blocks(bounded).applyInArrow(
        _candidates(borders), "query_row bigint, query_id bigint, row bigint, vec_id bigint, "
                              "high double")
    kept = materialise(kept.withColumn("turn", order), "in-order")
    first = materialise(_scored(kept.where(F.col("turn") <= 2 * top), queries, vectors), "first-read")
    rank = F.row_number().over(by_query.orderBy(F.desc("score"), "vec_id"))
    kth = first.withColumn("n", rank).where(F.col("n") == top).select(
        "query_id", F.col("score").alias("kth"))
    rest = (kept.where(F.col("turn") > 2 * top).join(kth, "query_id", "left")
            .where(F.col("kth").isNull() | (F.col("high") >= F.col("kth"))))
    scored = first.unionByName(_scored(rest, queries, vectors))
    return (scored.withColumn("rank", rank).where(F.col("rank") <= top)
            .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"))
