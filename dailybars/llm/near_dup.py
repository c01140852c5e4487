"""N-gram Jaccard self-join with Bayesian candidate pruning.

Documents are sets of five-word shingles (64-bit hashes of the lower-cased,
white-space separated words; a shorter text is one shingle of all its words).
Two documents are linked when the Jaccard similarity of their sets is at least
0.8.

1. One pass over the whole texts gives each document 128 MinHash values, 32
   band keys of 4 values each and a digest of its set. Documents with the same
   set form one class of copies; only its representative goes on.
2. Representatives that share a band key are candidates. A pair of similarity
   0.8 shares none with probability (1 - 0.8**4)**32 = 5e-8, a more similar one
   with less. Band buckets with the same members are compared once.
3. Inside a bucket the MinHash values of a pair are compared 32 at a time. A
   pair is dropped when the posterior probability (uniform prior) that its
   similarity reaches the threshold is below 1e-6. A bucket with more than 512
   members is cut into blocks and each pair of blocks is a task of its own.
4. The members that have a partner left are written per block pair and shuffled
   once more with their shingle sets; there their pairs are pruned again and
   verified exactly, so no list of pairs is ever written. Blocks are also cut by
   the bytes of their members' shingle sets. A verifying task returns per
   representative its number of links and one edge to the smallest
   representative it is connected with.
5. Connected classes are found from those edges by alternating large-star and
   small-star rounds, written to the shared folder.

The comparisons inside one group of n different but mutually similar texts grow
with the square of that group, since every link is counted; they are spread
over the block pairs. A member and its shingle set are shuffled once per block
of its bucket.

Defined results: texts that are NULL or have no word have no links and are a
class of their own; rows with the same set are linked to each other; a class
has the smallest doc_id of its rows (NULL only if all are); an empty table
gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from hashlib import blake2b
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import (column_of, materialise, only, packed, row_key, text_blocks, texts_of, unpacked,
                     without)

WORDS = 5
THRESHOLD = 0.8
BANDS, ROWS = 32, 4
HASHES = BANDS * ROWS
STEP = 32
TOLERANCE = 1e-6
BLOCK = 512
BLOCK_BYTES = 16 << 20    # shingle sets of one block's members (expected, by hash)

_RNG = np.random.default_rng(20240611)
_PLACES = _RNG.integers(1, 1 << 63, WORDS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_XOR = _RNG.integers(0, 1 << 32, (HASHES, 1), dtype=np.uint64).astype(np.uint32)
_MUL = (_RNG.integers(0, 1 << 31, (HASHES, 1), dtype=np.uint64) * np.uint64(2)
        + np.uint64(1)).astype(np.uint32)
_BASE = np.uint64(0x9E3779B97F4A7C15)


def _mix(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every input bit over all 64 output bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _word_hashes(words: list[list[str]]) -> np.ndarray:
    """64-bit hashes of all words of all documents, in order."""
    data = np.frombuffer(" ".join(" ".join(w) for w in words if w)
                         .encode("utf-8", "surrogatepass"), dtype=np.uint8)
    if not len(data):
        return np.zeros(0, dtype=np.uint64)
    starts = np.flatnonzero(np.concatenate(([True], data[:-1] == 0x20)))
    lengths = np.diff(starts, append=len(data) + 1)
    powers = np.cumprod(np.full(int(lengths.max()), _BASE, dtype=np.uint64))
    place = np.arange(len(data)) - np.repeat(starts, lengths)[:len(data)]
    value = (data.astype(np.uint64) + np.uint64(1)) * powers[place]
    value[data == 0x20] = 0
    return _mix(np.add.reduceat(value, starts))


def shingle_sets(texts: list[str], n: int = WORDS) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text."""
    words = [t.lower().split() for t in texts]
    hashes = _word_hashes(words)
    ends = np.cumsum([len(w) for w in words])
    if len(hashes) >= n:
        grams = hashes[: len(hashes) - n + 1] * _PLACES[0]
        for k in range(1, n):
            grams = grams + hashes[k: len(hashes) - n + 1 + k] * _PLACES[k]
        grams = _mix(grams)
    sets = []
    for w, end in zip(words, ends):
        start = end - len(w)
        if len(w) >= n:
            sets.append(np.unique(grams[start: end - n + 1]))
        elif w:
            short = (hashes[start:end] * _PLACES[: len(w)]).sum(dtype=np.uint64)
            sets.append(_mix(np.array([short + np.uint64(len(w))], dtype=np.uint64)))
        else:
            sets.append(np.zeros(0, dtype=np.uint64))
    return sets


def signature(shingles: np.ndarray) -> np.ndarray:
    """MinHash values of a non-empty set of hashes."""
    low = shingles.astype(np.uint32)
    least = np.full(HASHES, 0xFFFFFFFF, dtype=np.uint32)
    for k in range(0, len(low), 2048):
        part = (low[None, k: k + 2048] ^ _XOR) * _MUL
        np.minimum(least, part.min(axis=1), out=least)
    return least


def band_keys(signatures: np.ndarray) -> np.ndarray:
    """64-bit keys of the bands, one row per signature."""
    rows = signatures.reshape(len(signatures), BANDS, ROWS).astype(np.uint64)
    keys = np.broadcast_to(np.arange(BANDS, dtype=np.uint64) + np.uint64(1), rows.shape[:2])
    for k in range(ROWS):
        keys = _mix(keys * _BASE + rows[:, :, k])
    return keys.view(np.int64)


def least_matches(threshold: float = THRESHOLD, tolerance: float = TOLERANCE) -> dict[int, int]:
    """For n compared values, the fewest matches m that keep a pair: with a
    uniform prior the similarity given m of n is Beta(m + 1, n - m + 1), and
    P(similarity >= t) = P(Binomial(n + 1, t) <= m)."""
    found = {}
    for n in range(STEP, HASHES + 1, STEP):
        total = 0.0
        for m in range(n + 1):
            total += comb(n + 1, m) * threshold ** m * (1 - threshold) ** (n + 1 - m)
            if total >= tolerance:
                found[n] = m
                break
    return found


_LEAST = least_matches()


def surviving_pairs(a: np.ndarray, b: np.ndarray, band: int,
                    same: bool) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (i, j) of the two signature blocks that pass the incremental
    comparison and whose first shared band is ``band``."""
    alive = np.ones((len(a), len(b)), dtype=bool)
    if same:
        alive = np.triu(alive, 1)
    matches = np.zeros((len(a), len(b)), dtype=np.int16)
    for k in range(STEP):
        matches += a[:, None, k] == b[None, :, k]
    i, j = np.nonzero(alive & (matches >= _LEAST[STEP]))
    score = matches[i, j].astype(np.int64)
    for n in range(2 * STEP, HASHES + 1, STEP):
        score += (a[i, n - STEP: n] == b[j, n - STEP: n]).sum(axis=1)
        keep = score >= _LEAST[n]
        i, j, score = i[keep], j[keep], score[keep]
    if len(i):
        shared = (a[i] == b[j]).reshape(len(i), BANDS, ROWS).all(axis=2)
        first = shared[:, band] & ~shared[:, :band].any(axis=1)
        i, j = i[first], j[first]
    return i, j


def linked_pairs(sets: list[np.ndarray], i: np.ndarray, j: np.ndarray,
                 threshold: float = THRESHOLD) -> np.ndarray:
    """Which of the pairs have a Jaccard similarity of at least the threshold."""
    size = np.array([len(s) for s in sets], dtype=np.int64)
    if len(i) <= 4 * len(sets):
        common = np.array([len(np.intersect1d(sets[x], sets[y], assume_unique=True))
                           for x, y in zip(i, j)], dtype=np.int64)
    else:  # dense: count all intersections by blocks of a 0/1 matrix
        distinct, where, times = np.unique(np.concatenate(sets), return_inverse=True,
                                           return_counts=True)
        owner = np.repeat(np.arange(len(sets)), size)
        useful = times > 1
        column = np.cumsum(useful) - 1
        keep = useful[where]
        owner, column = owner[keep], column[where[keep]]
        total = np.zeros((len(sets), len(sets)), dtype=np.float32)
        width = 4096
        part_of = column // width
        order = np.argsort(part_of, kind="stable")
        owner, column, part_of = owner[order], column[order], part_of[order]
        cuts = np.flatnonzero(np.diff(part_of, prepend=-1, append=-1))
        for lo, hi in zip(cuts[:-1], cuts[1:]):
            member = np.zeros((len(sets), width), dtype=np.float32)
            member[owner[lo:hi], column[lo:hi] % width] = 1
            total += member @ member.T
        common = np.rint(total[i, j]).astype(np.int64)
    union = size[i] + size[j] - common
    return common >= threshold * union - 1e-9


def forest(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Smallest index each of n nodes is connected with."""
    root = np.arange(n)
    while True:
        least = np.minimum(root[i], root[j])
        after = root.copy()
        np.minimum.at(after, root[i], least)
        np.minimum.at(after, root[j], least)
        np.minimum.at(after, i, least)
        np.minimum.at(after, j, least)
        after = after[after]
        if (after == root).all():
            return root
        root = after


def _groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """The groups of batches that come clustered by the (bigint) keys."""
    open_parts: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        marks = np.stack([np.asarray(column_of(batch, k)) for k in keys], axis=1)
        cuts = [0, *(np.flatnonzero((marks[1:] != marks[:-1]).any(axis=1)) + 1), batch.num_rows]
        for lo, hi in zip(cuts[:-1], cuts[1:]):
            mark = tuple(marks[lo])
            if open_parts and mark != last:
                yield pa.Table.from_batches(open_parts)
                open_parts = []
            last = mark
            open_parts.append(batch.slice(lo, hi - lo))
    if open_parts:
        yield pa.Table.from_batches(open_parts)


def _matrix(column, dtype, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype=dtype).reshape(-1, width)


def sketch(documents: DataFrame) -> DataFrame:
    """doc_id, row_key, set_key (NULL without words), signature, bands and size
    of the set."""
    def run(batches):
        for block in text_blocks(batches, max_bytes=1 << 20):
            sets = shingle_sets(texts_of(block))
            full = [k for k, s in enumerate(sets) if len(s)]
            signed = np.stack([signature(sets[k]) for k in full]) if full else None
            bands = band_keys(signed) if full else None
            place = {k: p for p, k in enumerate(full)}
            yield pa.RecordBatch.from_arrays(
                [column_of(block, "doc_id"), column_of(block, "row_key"),
                 pa.array([blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None
                           for s in sets], pa.binary()),
                 pa.array([signed[place[k]].tobytes() if k in place else None
                           for k in range(len(sets))], pa.binary()),
                 pa.array([bands[place[k]] if k in place else None
                           for k in range(len(sets))], pa.list_(pa.int64())),
                 pa.array([len(s) for s in sets], pa.int64())],
                names=["doc_id", "row_key", "set_key", "signature", "bands", "size"])

    kind = documents.schema["doc_id"].dataType.simpleString()
    return documents.select("doc_id", row_key().alias("row_key"), "text").mapInArrow(
        run, f"doc_id {kind}, row_key binary, set_key binary, signature binary, "
             "bands array<bigint>, size bigint")


def _block_tasks(members: DataFrame) -> DataFrame:
    """One row per member and block pair: band, bucket, lo, hi, side."""
    g = F.col("blocks")
    mine = F.pmod(F.xxhash64("rep"), g)
    other = F.explode(F.sequence(F.lit(0).cast("long"), g - 1))
    return (members.withColumn("mine", mine).withColumn("other", other)
            .withColumns({"lo": F.least("mine", "other"), "hi": F.greatest("mine", "other"),
                          "side": F.when(F.col("mine") <= F.col("other"), 0).otherwise(1)})
            .drop("mine", "other", "blocks"))


_TASK = ["band", "bucket", "lo", "hi"]
_MEMBER = [*_TASK, "side", "rep"]


def _clustered(frame: DataFrame) -> DataFrame:
    return frame.repartition(*_TASK).sortWithinPartitions(*_TASK, "side", "rep")


def candidate_members(reps: DataFrame, block: int = BLOCK,
                      block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(rep, band, bucket, blocks) of the buckets with two members or more,
    without buckets whose members another bucket of an earlier band has. A
    bucket has as many blocks as its members or their shingle sets ask for."""
    rows = reps.select("rep", "size", F.posexplode("bands").alias("band", "bucket")).select(
        "rep", "size", F.col("band").cast("long").alias("band"), "bucket")
    buckets = (rows.groupBy("band", "bucket")
               .agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("size"),
                    F.bit_xor(F.xxhash64("rep")).alias("all_1"),
                    F.bit_xor(F.xxhash64("rep", F.lit(7))).alias("all_2"))
               .where("n > 1"))
    blocks = F.least(F.greatest(F.ceil(F.col("n") / block), F.ceil(F.col("size") * 8 / block_bytes)),
                     F.col("n"))
    once = (buckets.groupBy("n", "size", "all_1", "all_2")
            .agg(F.min(F.struct("band", "bucket")).alias("first"))
            .select("first.band", "first.bucket", blocks.alias("blocks")))
    return rows.drop("size").join(materialise(once, "buckets"), ["band", "bucket"])


def _pairs(group: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """The pairs of a block pair's members that the Bayesian pruning leaves."""
    signed = _matrix(group.column("signature"), np.uint32, HASHES)
    same = group.column("lo")[0].as_py() == group.column("hi")[0].as_py()
    cut = 0 if same else int(np.searchsorted(np.asarray(group.column("side")), 1))
    left, right = (signed, signed) if same else (signed[:cut], signed[cut:])
    i, j = surviving_pairs(left, right, group.column("band")[0].as_py(), same)
    return i, j + cut


def _compare(batches):
    """The members of each block pair that have a partner left after the
    Bayesian pruning. Their pairs are not written: they are found again, from
    the members that are left, where they are verified."""
    for group in _groups(batches, _TASK):
        alive = np.unique(np.concatenate(_pairs(group)))
        if len(alive):
            yield pa.RecordBatch.from_arrays(
                [group.column(c).combine_chunks().take(pa.array(alive)) for c in _MEMBER],
                names=_MEMBER)


def _verify(batches):
    """Exact verification inside each block pair: (rep, links, root)."""
    for group in _groups(batches, _TASK):
        reps = np.asarray(group.column("rep"))
        copies = np.asarray(group.column("copies"))
        sets = [np.frombuffer(s, dtype=np.uint64) for s in group.column("shingles").to_pylist()]
        i, j = _pairs(group)
        good = linked_pairs(sets, i, j)
        i, j = i[good], j[good]
        if not len(i):
            continue
        links = (np.bincount(i, copies[j], len(reps)) + np.bincount(j, copies[i], len(reps)))
        order = np.argsort(reps)
        rank = np.empty(len(reps), dtype=np.int64)
        rank[order] = np.arange(len(reps))
        root = reps[order][forest(len(reps), rank[i], rank[j])[rank]]
        linked = links > 0
        yield pa.RecordBatch.from_arrays(
            [pa.array(reps[linked]), pa.array(np.rint(links[linked]).astype(np.int64)),
             pa.array(root[linked])], names=["rep", "links", "root"])


def _shingle_column(batches):
    for block in text_blocks(batches, max_bytes=1 << 20):
        sets = shingle_sets(texts_of(block))
        yield pa.RecordBatch.from_arrays(
            [column_of(block, "rep"), column_of(block, "copies"),
             pa.array([s.tobytes() for s in sets], pa.binary())],
            names=["rep", "copies", "shingles"])


def links(documents: DataFrame, reps: DataFrame) -> DataFrame:
    """(rep, links, root) rows of the verified links; ``reps`` is a written
    table of rep, row_key, copies, size, signature and bands."""
    # A member meets its signature once, then goes to its block pairs.
    members = candidate_members(reps).join(reps.select("rep", "signature"), "rep")
    alive = materialise(_clustered(_block_tasks(members)).mapInArrow(
        _compare, "band bigint, bucket bigint, lo bigint, hi bigint, side int, rep bigint"),
        "alive")
    needed = materialise(alive.select("rep").distinct().join(
        reps.select("rep", "row_key", "copies"), "rep"), "needed")
    texts = only(documents.select(row_key().alias("row_key"), "text"), needed, "row_key")
    shingled = materialise(texts.select("rep", "copies", "text").mapInArrow(
        _shingle_column, "rep bigint, copies bigint, shingles binary"), "shingles")
    if shingled.count() > needed.count():       # rows that repeat an id and a text
        shingled = materialise(shingled.dropDuplicates(["rep"]), "shingles-once")
    places = alive.groupBy("rep").agg(F.collect_list(F.struct(*_TASK, "side")).alias("places"))
    verify = (places.join(reps.select("rep", "signature"), "rep").join(shingled, "rep")
              .select("rep", "copies", "signature", "shingles", F.explode("places").alias("place"))
              .select("rep", "copies", "signature", "shingles", "place.*"))
    return materialise(_clustered(verify).mapInArrow(
        _verify, "rep bigint, links bigint, root bigint"), "links")


def connected(edges: DataFrame) -> DataFrame:
    """(node, root) of the connected components of (a, b) edges with a > b, by
    alternating large-star and small-star rounds until nothing moves. One table
    is written per round."""
    edges = materialise(edges.where("a > b").distinct(), "edges")
    seen = None
    while True:
        state = edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first()
        if state == seen or not state[0]:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
        seen = state
        both = edges.select("a", "b").unionByName(
            edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = (both.join(least, "a").where("b > a")
                 .select(F.col("b").alias("a"), F.col("m").alias("b")).where("a > b").distinct())
        small = large.join(large.groupBy("a").agg(F.min("b").alias("m")), "a")
        moved = F.array(F.struct("a", F.col("m").alias("b")),
                        F.struct(F.col("b").alias("a"), F.col("m").alias("b")))
        edges = materialise(small.select(F.explode(moved).alias("edge")).select("edge.a", "edge.b")
                            .where("a > b").distinct(), "edges")


def _joined_classes(documents: DataFrame) -> DataFrame:
    """doc_id, row_key, class_id, class_key (row_key of the class's first
    document) and n_links of every document."""
    rows = materialise(sketch(documents), "sketch")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "row_key"))
    sets = (rows.where(F.col("set_key").isNotNull()).groupBy("set_key")
            .agg(F.count(F.lit(1)).alias("copies"), first.alias("first"),
                 F.first("signature").alias("signature"), F.first("bands").alias("bands"),
                 F.first("size").alias("size")))
    reps = materialise(sets.select(F.monotonically_increasing_id().alias("rep"), "set_key", "copies",
                                   "first", F.col("first.row_key").alias("row_key"),
                                   "signature", "bands", "size"), "classes")
    found = links(documents, reps)
    roots = connected(found.select(F.col("rep").alias("a"), F.col("root").alias("b")))
    counts = found.groupBy("rep").agg(F.sum("links").alias("links"))
    thin = reps.select("rep", "set_key", "copies", "first")
    placed = (thin.join(counts, "rep", "left")
              .join(roots.withColumnRenamed("node", "rep"), "rep", "left")
              .withColumn("root", F.coalesce("root", "rep")))
    placed = materialise(placed, "placed")
    heads = placed.groupBy("root").agg(F.min("first").alias("head"))
    classes = placed.join(heads, "root").select(
        "set_key", "head", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"))
    worded = rows.where(F.col("set_key").isNotNull()).select("doc_id", "row_key", "set_key")
    wordless = rows.where(F.col("set_key").isNull())
    return worded.join(classes, "set_key").select(
        "doc_id", "row_key", F.col("head.doc_id").alias("class_id"),
        F.col("head.row_key").alias("class_key"), "n_links").unionByName(
        wordless.select("doc_id", "row_key", F.col("doc_id").alias("class_id"),
                        F.col("row_key").alias("class_key"),
                        F.lit(0).cast("long").alias("n_links")))


def jaccard_classes(documents: DataFrame) -> DataFrame:
    """One row per document: doc_id, class_id (smallest doc_id of all documents
    it is connected with by links) and n_links (documents it is linked with)."""
    return _joined_classes(documents).select("doc_id", "class_id", "n_links")


def keep_one(documents: DataFrame) -> DataFrame:
    """Pipeline stage: of each connected class the document with the smallest
    id stays, with the documents' columns. Rows with the same id and text
    count as one document. The texts are read again and the keys of the rows
    that go are taken out of them; only documents that stay and are repeated
    are gathered."""
    changed = materialise(
        _joined_classes(documents).groupBy("row_key")
        .agg(F.max(F.col("row_key") == F.col("class_key")).alias("kept"),
             F.count(F.lit(1)).alias("n"))
        .where("not kept or n > 1"), "not-as-they-are")
    keyed = documents.select(packed(documents), row_key().alias("row_key"))
    stays = without(keyed, changed.select("row_key"), "row_key")
    repeated = changed.where("kept").select("row_key")
    if not repeated.isEmpty():
        stays = stays.unionByName(only(keyed, repeated, "row_key").dropDuplicates(["row_key"]))
    return unpacked(stays, documents.columns)
