"""Best-fit packing of documents into sequences by length patterns.

1. Documents are encoded once; documents longer than a sequence are cut. The
   pieces (thin rows) are written to the shared folder.
2. Only the histogram of piece lengths reaches the driver: at most one row per
   length up to the sequence length, whatever the corpus size.
3. Patterns of two to four lengths that nearly fill a sequence are enumerated.
   Non-negative least squares fits how often each is used to the histogram;
   the counts are rounded down and never use more pieces than there are.
4. The pieces left over are packed by best fit in decreasing length, first
   into the space that the patterns leave, then into new sequences. This works
   on counts per length, not on pieces.
5. The plan is a list of rank intervals per length. Spark numbers the pieces
   of each length (in hash buckets, so a frequent length is not one task) and
   looks up sequence and offset in the broadcast plan, whose size is bounded
   by the number of lengths, not by the corpus.

Defined results: NULL and empty texts are one end token; repeated rows are
packed one by one; a NULL doc_id is kept; an empty table gives an empty result;
extra columns are ignored. Sequence numbers start at 0 without gaps.
"""

from __future__ import annotations

import zlib
from bisect import bisect_right

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import column_of, materialise, text_blocks, texts_of
from .encoding import encoder, tokenizer_path

CAPACITY = 4096
END_ID = 1
TOKENIZER = "word_bpe_49k.json"
RANK_BUCKETS = 256
VARIANTS = 4
SWEEPS = 12


def pieces_of(documents: DataFrame, path: str, capacity: int = CAPACITY,
              end_id: int = END_ID) -> DataFrame:
    """(doc_id, row_id, piece, start, length, ids_crc32) of every document."""
    end = end_id.to_bytes(4, "little")

    def run(batches):
        tokens = encoder(path)
        for block in text_blocks(batches):
            row, piece, start, length, crc = [], [], [], [], []
            for k, text in enumerate(texts_of(block)):
                ids = tokens.ids(text) + end
                for p, lo in enumerate(range(0, len(ids), 4 * capacity)):
                    part = ids[lo: lo + 4 * capacity]
                    row.append(k)
                    piece.append(p)
                    start.append(lo // 4)
                    length.append(len(part) // 4)
                    crc.append(zlib.crc32(part))
            at = pa.array(row, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [column_of(block, "doc_id").take(at), column_of(block, "row_id").take(at),
                 pa.array(piece, pa.int32()), pa.array(start, pa.int64()),
                 pa.array(length, pa.int64()), pa.array(crc, pa.int64())],
                names=["doc_id", "row_id", "piece", "start", "length", "ids_crc32"])

    kind = documents.schema["doc_id"].dataType.simpleString()
    rows = documents.select("doc_id", F.monotonically_increasing_id().alias("row_id"), "text")
    return rows.mapInArrow(run, f"doc_id {kind}, row_id bigint, piece int, start bigint, "
                                "length bigint, ids_crc32 bigint")


def enumerate_patterns(lengths: list[int], capacity: int, most: int = 4,
                       variants: int = VARIANTS) -> list[tuple[int, ...]]:
    """Patterns of two to ``most`` lengths, in decreasing order, that fill a
    sequence as well as the present lengths allow."""
    ordered = sorted(lengths)
    found = set()

    def extend(pattern, free):
        place = bisect_right(ordered, min(free, pattern[-1]))
        if len(pattern) == most or not place:
            if len(pattern) > 1:
                found.add(pattern)
            return
        if len(pattern) > 1 and free < ordered[0]:
            found.add(pattern)
            return
        # The longest that fits, and shorter ones that leave room for another.
        choices = {place - 1, *(place * k // variants for k in range(1, variants))
                   } if len(pattern) == 1 else {place - 1}
        for c in choices:
            extend(pattern + (ordered[c],), free - ordered[c])

    for a in ordered:
        if a < capacity:
            extend((a,), capacity - a)
    return sorted(p for p in found if sum(p) >= 0.97 * capacity)


def fit_counts(patterns: list[tuple[int, ...]], counts: np.ndarray,
               sweeps: int = SWEEPS) -> list[float]:
    """Non-negative least squares of pattern use against the histogram, by
    coordinate descent."""
    uses = []
    for p in patterns:
        own: dict[int, int] = {}
        for length in p:
            own[length] = own.get(length, 0) + 1
        uses.append((list(own.items()), sum(v * v for v in own.values())))
    rest = [float(c) for c in counts]
    x = [0.0] * len(patterns)
    for _ in range(sweeps):
        moved = 0.0
        for k, (own, square) in enumerate(uses):
            step = sum(v * rest[n] for n, v in own) / square
            new = max(0.0, x[k] + step)
            step = new - x[k]
            if step:
                for n, v in own:
                    rest[n] -= v * step
                x[k] = new
                moved = max(moved, abs(step))
        if moved < 0.25:
            break
    return x


def plan_packing(counts: np.ndarray, capacity: int = CAPACITY
                 ) -> list[tuple[int, tuple[tuple[int, int], ...]]]:
    """(how many sequences, ((length, pieces of it per sequence), ...)) for a
    histogram ``counts[length]``."""
    rest = [int(c) for c in counts]
    groups: list[tuple[int, tuple[tuple[int, int], ...]]] = []
    if rest[capacity]:
        groups.append((rest[capacity], ((capacity, 1),)))
        rest[capacity] = 0
    present = [n for n in range(1, capacity) if rest[n]]
    patterns = enumerate_patterns(present, capacity)
    fitted = fit_counts(patterns, np.array(rest))
    open_groups: dict[int, list] = {}
    for k in sorted(range(len(patterns)), key=lambda k: -fitted[k]):
        own: dict[int, int] = {}
        for n in patterns[k]:
            own[n] = own.get(n, 0) + 1
        times = min(int(fitted[k]), *(rest[n] // v for n, v in own.items()))
        if times > 0:
            for n, v in own.items():
                rest[n] -= v * times
            open_groups.setdefault(capacity - sum(patterns[k]), []).append(
                (times, tuple(own.items())))
    # Best fit in decreasing length: of the open sequences with room, those
    # with the least room take as many pieces as fit, then new ones.
    for n in range(capacity - 1, 0, -1):
        left = rest[n]
        if not left:
            continue
        for free in sorted(f for f in open_groups if f >= n):
            each = free // n
            waiting = open_groups.pop(free)
            while waiting and left:
                times, held = waiting.pop()
                filled = min(times, left // each)
                if filled:
                    open_groups.setdefault(free - each * n, []).append(
                        (filled, held + ((n, each),)))
                    left -= filled * each
                if filled < times and left:
                    open_groups.setdefault(free - left * n, []).append(
                        (1, held + ((n, left),)))
                    filled, left = filled + 1, 0
                if filled < times:
                    waiting.append((times - filled, held))
            if waiting:
                open_groups.setdefault(free, []).extend(waiting)
            if not left:
                break
        if left:
            each = capacity // n
            if left // each:
                open_groups.setdefault(capacity - each * n, []).append(
                    (left // each, ((n, each),)))
            if left % each:
                open_groups.setdefault(capacity - left % each * n, []).append(
                    (1, ((n, left % each),)))
    for free in sorted(open_groups):
        groups += open_groups[free]
    return groups


def plan_intervals(groups) -> list[tuple[int, int, int, int, int, int]]:
    """(length, first rank, end rank, first sequence, pieces per sequence,
    offset of the first) per length and group."""
    rows, used, base = [], {}, 0
    for times, held in groups:
        offset = 0
        for n, each in held:
            start = used.get(n, 0)
            used[n] = start + times * each
            rows.append((n, start, used[n], base, each, offset))
            offset += n * each
        base += times
    return rows


def best_fit_packing(documents: DataFrame, path: str | None = None,
                     capacity: int = CAPACITY) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id,
    offset."""
    spark = documents.sparkSession
    pieces = materialise(pieces_of(documents, path or tokenizer_path(TOKENIZER), capacity),
                         "pieces").withColumn(
        "bucket", F.pmod(F.xxhash64("row_id", "piece"), F.lit(RANK_BUCKETS)))
    held = materialise(pieces.groupBy("length", "bucket").agg(F.count(F.lit(1)).alias("n")),
                       "length-counts", 8)
    counts = np.zeros(capacity + 1, dtype=np.int64)
    for r in held.groupBy("length").agg(F.sum("n").alias("n")).collect():
        counts[r.length] = r.n
    plan = spark.createDataFrame(
        plan_intervals(plan_packing(counts, capacity)),
        "length bigint, first bigint, stop bigint, base bigint, each bigint, at bigint")
    before = held.select("length", "bucket", (F.sum("n").over(
        Window.partitionBy("length").orderBy("bucket")) - F.col("n")).alias("before"))
    inside = F.row_number().over(
        Window.partitionBy("length", "bucket").orderBy("row_id", "piece"))
    ranked = (pieces.withColumn("inside", inside - 1).join(before, ["length", "bucket"])
              .withColumn("rank", F.col("inside") + F.col("before")))
    nth = F.col("rank") - F.col("first")
    return (ranked.join(F.broadcast(plan), "length")
            .where((F.col("rank") >= F.col("first")) & (F.col("rank") < F.col("stop")))
            .select("doc_id", "piece", "start", "length", "ids_crc32",
                    (F.col("base") + F.floor(nth / F.col("each"))).cast("long").alias("sequence_id"),
                    (F.col("at") + nth % F.col("each") * F.col("length")).alias("offset")))
