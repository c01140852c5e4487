"""Token counts from the exact histogram of encoded lengths.

Every document is encoded once and counted by its length. The histogram (one
row per distinct length) then answers, for every context limit, whether or not
a document has that length, how many documents fit, how many tokens they hold, how many tokens remain when longer
documents are truncated, and which quantile the limit is. Sums over longer
documents are suffix sums, taken in ranges of 1,024 lengths plus the totals of
the ranges, so that no task orders the whole histogram.

Defined results: NULL and empty texts have length 0; repeated rows count each;
an empty table gives an empty histogram and no answers; limits asked for more
than once, NULL or negative ones are answered once or not; extra columns are
ignored.
"""

from __future__ import annotations

from collections.abc import Iterable

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import materialise, text_blocks, texts_of
from .encoding import encoder, tokenizer_path

TOKENIZER = "word_bpe_49k.json"
RANGE = 1024
# Context limits that the report answers besides the documents' own lengths.
LIMITS = tuple(1 << k for k in range(7, 21))


def encoded_lengths(documents: DataFrame, path: str) -> DataFrame:
    """Length of every document, counted per task."""
    def run(batches):
        tokens, counts = encoder(path), {}
        for block in text_blocks(batches):
            for text in texts_of(block):
                n = len(tokens.ids(text)) // 4
                counts[n] = counts.get(n, 0) + 1
        yield pa.RecordBatch.from_arrays(
            [pa.array(counts.keys(), pa.int64()), pa.array(counts.values(), pa.int64())],
            names=["length", "documents"])

    return documents.select("text").mapInArrow(run, "length bigint, documents bigint")


def length_histogram(documents: DataFrame, path: str | None = None) -> DataFrame:
    """(length, documents), one row per distinct length."""
    return (encoded_lengths(documents, path or tokenizer_path(TOKENIZER))
            .groupBy("length").agg(F.sum("documents").alias("documents")))


def limit_report(histogram: DataFrame, limits: Iterable[int] = ()) -> DataFrame:
    """For every length in the histogram and every one of ``limits``, taken as
    the context limit: a limit is a length that no document need have."""
    asked = histogram.sparkSession.createDataFrame(
        [(int(n), 0) for n in limits if n is not None and n >= 0], "length bigint, documents bigint")
    both = (histogram.select("length", "documents").unionByName(asked)
            .groupBy("length").agg(F.sum("documents").alias("documents")))
    rows = materialise(both, "length-histogram").select(
        "length", "documents", (F.col("length") * F.col("documents")).alias("tokens"),
        F.floor(F.col("length") / RANGE).alias("part"))
    totals = rows.groupBy("part").agg(F.sum("documents").alias("documents"),
                                      F.sum("tokens").alias("tokens"))
    later = Window.partitionBy(F.lit(1)).orderBy("part").rowsBetween(1, Window.unboundedFollowing)
    every = Window.partitionBy(F.lit(1))
    ranges = totals.select(
        "part", F.coalesce(F.sum("documents").over(later), F.lit(0)).alias("docs_later"),
        F.coalesce(F.sum("tokens").over(later), F.lit(0)).alias("tokens_later"),
        F.sum("documents").over(every).alias("all_documents"),
        F.sum("tokens").over(every).alias("all_tokens"))
    rest = Window.partitionBy("part").orderBy("length").rowsBetween(1, Window.unboundedFollowing)
    ranges = ranges.where("all_documents > 0")
    suffix = rows.withColumns({
        "docs_rest": F.coalesce(F.sum("documents").over(rest), F.lit(0)),
        "tokens_rest": F.coalesce(F.sum("tokens").over(rest), F.lit(0))}).join(ranges, "part")
    longer = F.col("docs_rest") + F.col("docs_later")
    fitting = F.col("all_documents") - longer
    held = F.col("all_tokens") - F.col("tokens_rest") - F.col("tokens_later")
    return suffix.select(
        F.col("length").alias("context_limit"), F.col("documents").alias("documents_at"),
        fitting.alias("documents_fitting"), longer.alias("documents_longer"),
        held.alias("tokens_fitting"),
        (held + longer * F.col("length")).alias("tokens_truncated"),
        F.col("all_tokens").alias("tokens_total"),
        (fitting / F.col("all_documents")).alias("quantile"))


def quantile_length(histogram: DataFrame, share: float) -> DataFrame:
    """The smallest length that at least ``share`` of the documents do not exceed."""
    return (limit_report(histogram).where(F.col("quantile") >= share)
            .agg(F.min("context_limit").alias("length")))


def answers(histogram: DataFrame, limits: Iterable[int]) -> DataFrame:
    """The report's rows of the limits asked for, whatever they are."""
    limits = [int(n) for n in limits if n is not None]
    return limit_report(histogram, limits).where(F.col("context_limit").isin(limits))


def token_counts(documents: DataFrame) -> DataFrame:
    return limit_report(length_histogram(documents), LIMITS)
