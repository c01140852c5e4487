"""Exact deduplication with a heavy-hitter split, in DataFrame functions only.

1. Each text is normalised and digested once (SHA-256); the thin table of
   digests is written to the shared folder.
2. Misra-Gries summaries (Spark's ``approx_top_k_accumulate``, a mergeable
   frequent-items sketch of that kind) name at most ``limit`` frequent digests.
3. Their exact counts and winners come from one aggregation that is combined
   map-side, so a hot digest sends one row per task. At most
   ``limit`` verified winners are broadcast, and the rows of hot
   digests are settled where they are, without a shuffle.
4. All other digests go through one ordinary shuffle. A summary has counters
   for ``tracked`` digests, so one that it misses holds at most about
   N / (0.75 * tracked) of N rows, or is less frequent than ``limit`` others.

The sketch decides only the route of a row, never the result.

Defined results: a NULL text counts as empty; equal texts with equally many
code points keep the smallest doc_id (a NULL id comes last); of rows repeated
with the same id one stays; an empty table gives an empty result; extra
columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import materialise, only, packed, row_key, unpacked, without

# Space and the ASCII controls from tab to carriage return.
SPACE = r"[\x20\x09-\x0D]+"
HEAVY_DIGESTS = 1000
TRACKED = 4096
MERGE_GROUPS = 64


def digest_columns(text: str = "text") -> list[F.Column]:
    """row_id (unique), n_points (code points) and digest (SHA-256 of the
    normalised text)."""
    body = F.coalesce(F.col(text), F.lit(""))
    return [F.monotonically_increasing_id().alias("row_id"),
            F.char_length(body).cast("long").alias("n_points"),
            F.sha2(F.regexp_replace(body, SPACE, ""), 256).alias("digest")]


def heavy_hitters(rows: DataFrame, limit: int = HEAVY_DIGESTS,
                  tracked: int = TRACKED) -> DataFrame:
    """At most ``limit`` digests that the Misra-Gries summary finds frequent.
    Summaries are merged in two levels, so the last task merges at most
    ``MERGE_GROUPS`` of them however many tasks there were."""
    partial = (rows.groupBy((F.spark_partition_id() % MERGE_GROUPS).alias("part"))
               .agg(F.expr(f"approx_top_k_accumulate(digest, {int(tracked)})").alias("sketch")))
    # A keyed merge: the keyless one fails on partitions without a summary.
    merged = partial.groupBy(F.lit(0).alias("all")).agg(F.expr(f"approx_top_k_combine(sketch, {int(tracked)})").alias("sketch"))
    top = merged.select(F.expr(f"approx_top_k_estimate(sketch, {int(limit)})").alias("top"))
    return (top.select(F.explode("top").alias("hit")).where("hit.count > 1")
            .select(F.col("hit.item").alias("digest")))


def _winner():
    """Most code points, then smallest doc_id (NULL last), then first row."""
    return F.min(F.struct((-F.col("n_points")).alias("less"),
                          F.col("doc_id").isNull().alias("no_id"), "doc_id", "row_id"))


def settle(rows: DataFrame, limit: int = HEAVY_DIGESTS, tracked: int = TRACKED) -> DataFrame:
    """Group size and winner of every row of a written digest table."""
    candidates = materialise(heavy_hitters(rows, limit, tracked), "heavy-digests", 1)
    stats = {"group_size": F.count(F.lit(1)), "winner": _winner()}
    winners = materialise(
        rows.join(F.broadcast(candidates), "digest").groupBy("digest")
        .agg(*(c.alias(n) for n, c in stats.items())), "heavy-winners", 1)
    hot = rows.join(F.broadcast(winners), "digest")
    cold = (rows.join(F.broadcast(winners.select("digest")), "digest", "left_anti")
            .withColumns({n: c.over(Window.partitionBy("digest")) for n, c in stats.items()}))
    return hot.unionByName(cold).select(
        "row_id", "doc_id", F.col("winner.doc_id").alias("keep_id"), "group_size",
        (F.col("row_id") == F.col("winner.row_id")).alias("kept"),
        F.col("digest").alias("text_sha256"))


def exact_dedup(documents: DataFrame, text: str = "text", limit: int = HEAVY_DIGESTS,
                tracked: int = TRACKED) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256."""
    rows = materialise(documents.select("doc_id", *digest_columns(text)), "digests")
    return settle(rows, limit, tracked).drop("row_id")


def keep_first(documents: DataFrame, text: str = "text") -> DataFrame:
    """Pipeline stage: the rows that stay, with the documents' columns.

    Only digests are written and shuffled. The texts are read a second time,
    and the keys of the rows that go, which are far fewer, are taken out of
    them. Rows that repeat a document that stays (same id, same text) have its
    key; only such documents are gathered, to keep one row of each."""
    key = row_key(text)
    rows = materialise(documents.select("doc_id", key.alias("row_key"), *digest_columns(text)),
                       "digests")
    settled = materialise(settle(rows.drop("row_key")).select("row_id", "kept")
                          .join(rows.select("row_id", "row_key"), "row_id")
                          .groupBy("row_key")
                          .agg(F.max("kept").alias("kept"), F.count(F.lit(1)).alias("n"))
                          .where("not kept or n > 1"), "not-as-they-are")
    keyed = documents.select(packed(documents), key.alias("row_key"))
    stays = without(keyed, settled.select("row_key"), "row_key")
    repeated = settled.where("kept").select("row_key")
    if not repeated.isEmpty():
        stays = stays.unionByName(only(keyed, repeated, "row_key").dropDuplicates(["row_key"]))
    return unpacked(stays, documents.columns)
