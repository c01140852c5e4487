"""Approximate nearest neighbours with cross-polytope hashing.

1. Equal vectors are one indexed row that carries its smallest ids, so a vector
   that a third of all rows repeat is hashed and compared once.
2. A unit vector is turned by three rounds of random signs and a fast Hadamard
   transform, padded to a power of two; its hash is the signed axis nearest to
   the result. ``axes`` such hashes make a key, ``tables`` keys index a row.
3. A query probes the ``probes`` keys over all tables whose axes lose least
   against its own nearest ones (squared gaps, added over the hashes of a key).
4. Rows meet the probes per table and key. A bucket is cut into blocks of rows
   and of queries, so no task holds more than a block of each, and every row of
   a probed bucket is compared. A block returns each query's best few rows by
   the exact cosine; equal cosines are settled by the ids they stand for.
5. The blocks' rows are merged per query, equal vectors are unfolded to their
   rows, and the first ``top`` remain.

The cosine is the dot product over the product of the norms, in double
precision, of vectors scaled by a power of two (which changes no bit of it
unless the squares leave the range of a double).

Defined results: vectors that are NULL, empty, zero or hold NULL or non-finite
components take no part, nor do rows without an id; rows that repeat an id are
rows of their own, as candidates and as queries (which share one list), and are
no candidates for their own id; only vectors of the same dimension are
compared; equal scores go to the smaller id; a query whose probes meet fewer
than ``top`` other rows is compared with every row; an empty table gives an
empty result; extra columns are ignored.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import column_of, materialise

TABLES = 12
AXES = 1
PROBES = 120
TOP = 5
QUERY_EVERY = 50
ROW_BLOCK = 4096
QUERY_BLOCK = 512
SEED = 20240621
ROUNDS = 3
_PAIRS = 1 << 14          # exact scores worked out at once


def usable_rows(embeddings: DataFrame, vector: str = "embedding") -> DataFrame:
    """(vec_id, vector) of the rows that take part."""
    x = F.col(vector)
    finite = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    return (embeddings.where(F.col("vec_id").isNotNull() & x.isNotNull())
            .where(finite & F.exists(x, lambda v: v != 0))
            .select(F.col("vec_id").cast("long").alias("vec_id"), x.alias("vector")))


def distinct_vectors(rows: DataFrame, top: int = TOP) -> DataFrame:
    """(row, dim, ids, vector): every different vector, with its ``top`` + 1
    smallest ids and how often (at most ``top`` times) each repeats. ``row`` is
    unique once the table is written."""
    key = ["h1", "h2"]
    rows = rows.select("*", F.xxhash64("vector").alias("h1"),
                       F.xxhash64(F.lit("v"), "vector").alias("h2"))
    copies = rows.groupBy(*key, "vec_id").agg(F.least(F.count(F.lit(1)), F.lit(top)).alias("n"))
    order = F.row_number().over(Window.partitionBy(*key).orderBy("vec_id"))
    ids = (copies.withColumn("place", order).where(F.col("place") <= top + 1).groupBy(*key)
           .agg(F.sort_array(F.collect_list(F.struct("vec_id", "n"))).alias("ids")))
    one = rows.groupBy(*key).agg(F.first("vector").alias("vector"))
    return one.join(ids, key).select(F.monotonically_increasing_id().alias("row"),
                                     F.size("vector").alias("dim"), "ids", "vector")


def _matrix(column: pa.Array) -> np.ndarray:
    """Rows of a list column as a double matrix; all rows have the same length."""
    return np.asarray(column.flatten(), dtype=np.float64).reshape(len(column), -1)


def scaled(vectors: np.ndarray) -> np.ndarray:
    """Rows times a power of two that brings their largest component below 1."""
    _, exponent = np.frexp(np.abs(vectors).max(axis=1, initial=0))
    return np.ldexp(vectors, -exponent[:, None])


def unit(vectors: np.ndarray) -> np.ndarray:
    x = scaled(vectors)
    return x / np.sqrt((x * x).sum(axis=1))[:, None]


def cosines(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Row-wise cosines; equal rows give equal results wherever they stand."""
    a, b = scaled(a), scaled(b)
    return (a * b).sum(axis=1) / (np.sqrt((a * a).sum(axis=1)) * np.sqrt((b * b).sum(axis=1)))


def hadamard(x: np.ndarray) -> np.ndarray:
    """Fast Hadamard transform of the rows (a power of two long)."""
    n, size = x.shape
    half = 1
    while half < size:
        pair = x.reshape(n, size // (2 * half), 2, half)
        x = np.stack([pair[:, :, 0] + pair[:, :, 1], pair[:, :, 0] - pair[:, :, 1]],
                     axis=2).reshape(n, size)
        half *= 2
    return x / np.sqrt(size)


@lru_cache(maxsize=1024)
def _signs(dim: int, table: int, axis: int) -> np.ndarray:
    size = 1 << max(dim - 1, 0).bit_length()
    rng = np.random.default_rng([SEED, dim, table, axis])
    return rng.choice(np.array([-1.0, 1.0]), (ROUNDS, size))


def rotated(units: np.ndarray, table: int, axis: int) -> np.ndarray:
    signs = _signs(units.shape[1], table, axis)
    x = np.zeros((len(units), signs.shape[1]))
    x[:, :units.shape[1]] = units
    for sign in signs:
        x = hadamard(x * sign)
    return x


def _both_ways(x: np.ndarray) -> np.ndarray:
    """Similarity of the rows to every signed axis: +e_0 .., then -e_0 .."""
    return np.concatenate([x, -x], axis=1)


def keys(units: np.ndarray, table: int, axes: int = AXES) -> np.ndarray:
    """The bucket of every row in one table."""
    found = np.zeros(len(units), dtype=np.int64)
    for axis in range(axes):
        x = _both_ways(rotated(units, table, axis))
        found = found * x.shape[1] + x.argmax(axis=1)
    return found


def probe_keys(units: np.ndarray, tables: int = TABLES, axes: int = AXES,
               probes: int = PROBES) -> tuple[np.ndarray, np.ndarray]:
    """(table, key) of each row's ``probes`` best keys over all tables."""
    n = len(units)
    all_gaps, all_keys, all_tables = [], [], []
    for table in range(tables):
        gaps, found = np.zeros((n, 1)), np.zeros((n, 1), dtype=np.int64)
        for axis in range(axes):
            x = _both_ways(rotated(units, table, axis))
            loss = (x.max(axis=1, keepdims=True) - x) ** 2
            width = loss.shape[1]
            gaps = (gaps[:, :, None] + loss[:, None, :]).reshape(n, -1)
            found = (found[:, :, None] * width + np.arange(width)).reshape(n, -1)
            # No key beyond a table's best ``probes`` is among the best of all.
            best = np.argsort(gaps, axis=1, kind="stable")[:, :probes]
            gaps = np.take_along_axis(gaps, best, 1)
            found = np.take_along_axis(found, best, 1)
        all_gaps.append(gaps)
        all_keys.append(found)
        all_tables.append(np.full(found.shape, table, dtype=np.int32))
    best = np.argsort(np.concatenate(all_gaps, axis=1), axis=1, kind="stable")[:, :probes]
    return (np.take_along_axis(np.concatenate(all_tables, axis=1), best, 1),
            np.take_along_axis(np.concatenate(all_keys, axis=1), best, 1))


def _by_dimension(batches):
    for batch in batches:
        dims = np.asarray(column_of(batch, "dim"))
        for dim in np.unique(dims):
            yield batch.filter(pa.array(dims == dim))


def _listed(values: np.ndarray, kind: pa.DataType) -> pa.Array:
    offsets = np.arange(0, values.size + 1, values.shape[1], dtype=np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values.ravel(), kind))


def hashed(vectors: DataFrame, tables: int = TABLES, axes: int = AXES) -> DataFrame:
    """(row, dim, table, key) of every row in every table."""
    def run(batches):
        for batch in _by_dimension(batches):
            units = unit(_matrix(column_of(batch, "vector")))
            found = np.stack([keys(units, t, axes) for t in range(tables)], axis=1)
            yield pa.RecordBatch.from_arrays(
                [column_of(batch, "row"), column_of(batch, "dim"), _listed(found, pa.int64())],
                names=["row", "dim", "keys"])

    return (vectors.select("row", "dim", "vector")
            .mapInArrow(run, "row bigint, dim int, keys array<bigint>")
            .select("row", "dim", F.posexplode("keys").alias("table", "key")))


def probed(queries: DataFrame, tables: int = TABLES, axes: int = AXES,
           probes: int = PROBES) -> DataFrame:
    """(query_row, dim, table, key) of every probe."""
    def run(batches):
        for batch in _by_dimension(batches):
            units = unit(_matrix(column_of(batch, "vector")))
            where, found = probe_keys(units, tables, axes, probes)
            yield pa.RecordBatch.from_arrays(
                [column_of(batch, "query_row"), column_of(batch, "dim"),
                 _listed(where, pa.int32()), _listed(found, pa.int64())],
                names=["query_row", "dim", "tables", "keys"])

    return (queries.select("query_row", "dim", "vector")
            .mapInArrow(run, "query_row bigint, dim int, tables array<int>, keys array<bigint>")
            .select("query_row", "dim",
                    F.explode(F.arrays_zip("tables", "keys")).alias("probe"))
            .select("query_row", "dim", F.col("probe.tables").alias("table"),
                    F.col("probe.keys").alias("key")))


def best_pairs(query_ids: np.ndarray, queries: np.ndarray, first: np.ndarray, second: np.ndarray,
               single: np.ndarray, vectors: np.ndarray, top: int
               ) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(i, j, score, vec_id): each query's ``top`` rows by exact cosine, then by
    the smallest id they stand for that is not the query's. ``first`` and
    ``second`` are the rows' smallest ids; ``single`` rows have only one."""
    rough = unit(queries) @ unit(vectors).T
    own = first[None, :] == query_ids[:, None]
    barred = own & single[None, :]
    rough[barred] = -np.inf
    least = (np.partition(rough, -top, axis=1)[:, -top] if rough.shape[1] > top
             else np.full(len(rough), -np.inf))
    i, j = np.nonzero((rough >= least[:, None] - 1e-9) & ~barred)
    score = np.empty(len(i))
    for k in range(0, len(i), _PAIRS):
        part = slice(k, k + _PAIRS)
        score[part] = cosines(queries[i[part]], vectors[j[part]])
    stands_for = np.where(own[i, j], second[j], first[j])
    order = np.lexsort((stands_for, -score, i))
    i, j, score, stands_for = i[order], j[order], score[order], stands_for[order]
    best = np.arange(len(i)) - np.searchsorted(i, i, side="left") < top
    return i[best], j[best], score[best], stands_for[best]


def _block(top: int):
    def run(queries: pa.Table, rows: pa.Table) -> pa.Table:
        found = [np.zeros(0, np.int64)] * 4 + [np.zeros(0)]
        if queries.num_rows and rows.num_rows:
            ids = np.asarray(queries["query_id"])
            i, j, score, vec_id = best_pairs(
                ids, _matrix(queries["vector"].combine_chunks()), np.asarray(rows["first"]),
                np.asarray(rows["second"]), np.asarray(rows["single"]),
                _matrix(rows["vector"].combine_chunks()), top)
            found = [np.asarray(queries["query_row"])[i], ids[i], np.asarray(rows["row"])[j],
                     vec_id, score]
        return pa.table(dict(zip(("query_row", "query_id", "row", "stands_for", "score"), found)))

    return run


_FOUND = "query_row bigint, query_id bigint, row bigint, stands_for bigint, score double"


def _dealt(left: DataFrame, right: DataFrame, key: list[str], query_block: int,
           row_block: int) -> tuple[DataFrame, DataFrame]:
    """Queries and rows of equal keys, cut into blocks that meet pairwise."""
    sizes = (left.groupBy(*key).agg(F.count(F.lit(1)).alias("asked"))
             .join(right.groupBy(*key).agg(F.count(F.lit(1)).alias("rows")), key)
             .select(*key, F.ceil(F.col("asked") / query_block).alias("query_parts"),
                     F.ceil(F.col("rows") / row_block).alias("row_parts")))
    sizes = materialise(sizes, "bucket-sizes")
    every = lambda n: F.explode(F.sequence(F.lit(0).cast("bigint"), F.col(n) - 1))
    mine = lambda c, n: F.pmod(F.xxhash64(c), F.col(n))
    left = (left.join(sizes, key).withColumn("query_part", mine("query_row", "query_parts"))
            .withColumn("row_part", every("row_parts")))
    right = (right.join(sizes, key).withColumn("row_part", mine("row", "row_parts"))
             .withColumn("query_part", every("query_parts")))
    return left, right


def _compared(left: DataFrame, right: DataFrame, queries: DataFrame, vectors: DataFrame,
              key: list[str], top: int, query_block: int, row_block: int) -> DataFrame:
    left, right = _dealt(left, right, key, query_block, row_block)
    block = [*key, "query_part", "row_part"]
    asked = left.select(*block, "query_row").join(
        queries.select("query_row", "query_id", "vector"), "query_row")
    ids = F.col("ids")
    rows = right.select(*block, "row").join(
        vectors.select("row", ids[0]["vec_id"].alias("first"),
                       F.element_at(F.slice(ids, 1, 2), -1)["vec_id"].alias("second"),
                       (F.size(ids) == 1).alias("single"), "vector"), "row")
    return asked.groupBy(*block).cogroup(rows.groupBy(*block)).applyInArrow(_block(top), _FOUND)


def _unfolded(found: DataFrame, vectors: DataFrame, top: int) -> DataFrame:
    """query_id, rank, vec_id, score from the rows the blocks returned."""
    each = ["query_row", "query_id", "row", "stands_for"]
    merged = found.groupBy(*each).agg(F.max("score").alias("score"))
    order = Window.partitionBy("query_row").orderBy(F.desc("score"), "stands_for")
    best = merged.withColumn("place", F.row_number().over(order)).where(F.col("place") <= top)
    copies = (best.join(vectors.select("row", "ids"), "row")
              .select("query_id", "score", F.explode("ids").alias("copy"))
              .where("copy.vec_id <> query_id")
              .select("query_id", "score", F.col("copy.vec_id").alias("vec_id"),
                      F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("copy.n")))))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return (copies.withColumn("rank", rank).where(F.col("rank") <= top)
            .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"))


def nearest(embeddings: DataFrame, top: int = TOP, every: int = QUERY_EVERY,
            tables: int = TABLES, axes: int = AXES, probes: int = PROBES,
            row_block: int = ROW_BLOCK, query_block: int = QUERY_BLOCK,
            vector: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score of the ``top`` nearest rows found for each
    row whose id is divisible by ``every``."""
    rows = usable_rows(embeddings, vector)
    vectors = materialise(distinct_vectors(rows, top), "distinct-vectors")
    queries = materialise(rows.where(F.col("vec_id") % every == 0).select(
        F.monotonically_increasing_id().alias("query_row"), F.col("vec_id").alias("query_id"),
        F.size("vector").alias("dim"), "vector"), "queries")
    found = materialise(_compared(
        materialise(probed(queries, tables, axes, probes), "probes"),
        materialise(hashed(vectors, tables, axes), "index"), queries, vectors,
        ["dim", "table", "key"], top, query_block, row_block), "found")
    result = materialise(_unfolded(found, vectors, top), "nearest")
    # Probes that met too few rows: those queries are compared with every row.
    enough = result.where(F.col("rank") == top).select("query_id")
    short = materialise(queries.join(enough, "query_id", "left_anti"), "short-queries")
    if short.isEmpty():
        return result
    rest = _compared(short.select("query_row", "dim"), vectors.select("row", "dim"), short,
                     vectors, ["dim"], top, query_block, row_block)
    return (result.join(short.select("query_id").distinct(), "query_id", "left_anti")
            .unionByName(_unfolded(rest, vectors, top)))
