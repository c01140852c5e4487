"""Source divergence audit: how far the sources of a language differ in words.

1. The texts are cut into terms (runs of ASCII letters and non-ASCII
   characters, A-Z lower-cased) by one byte table and written once, joined by
   blanks, one folder per language.
2. A ``CountVectorizer`` per language, with ``minDF`` and the largest integer as
   ``vocabSize``, turns every document into an exact sparse vector of counts.
   Vectors are written, so a lost executor costs no recount.
3. The non-zero entries are summed per (source, term), combined in every task
   before the shuffle: a hot source sends one row per term and task.
   From here on a term is a number (of its vectorizer and its place in it) and a
   group is a number; names come back with the results.
4. Smoothed integer shares p = 1 + floor(1e9 (count + 5) / (N + 5 V)) are
   compared pair by pair from the non-zero entries alone: a term that neither
   source has adds the same known amount, so all of them are one product.

A vectorizer's vocabulary is on the driver and is broadcast to the tasks. Where
a language is expected to keep more than ``SHARD_TERMS`` terms (estimated from
one document in ``SAMPLE_EVERY``, by hash), its terms are dealt by hash to
several vectorizers of their own; the counts are the same.

All sums and quotients are integers (decimals where a long may overflow);
counts in the vectors are doubles, exact below 2**53.

Defined results: NULL text, language or source count as ''; repeated rows (also
of one doc_id) are documents of their own; a text without a term still gives its
group; a language with no kept term gives pairs of value 0 and no term rows; a
language with one source has no pairs; equal values go to the smaller item in
UTF-8 order; an empty table gives an empty result; other columns are ignored.
The terms of one document are held by one task.
"""

from __future__ import annotations

from functools import reduce

import pyarrow as pa
from pyspark.ml.feature import CountVectorizer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import scratch_dir
from .common import column_of, materialise, text_blocks

# What becomes of the bytes of a UTF-8 text: A-Z is lower-cased, an ASCII byte
# that is no letter ends a term, all bytes of other characters stay.
_BYTES = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or chr(c).isalpha() else 32
               for c in range(256))
MIN_DOCS = 30
MAX_VOCAB = 2**31 - 1
SMOOTHING = 5
UNIT = 1_000_000_000
TOP_TERMS = 50
SHARD_TERMS = 2_000_000
SAMPLE_EVERY = 64

# No term; every document has it, which keeps a vocabulary from being empty (the
# vectorizer refuses that).
_MARK = ""
_VECTOR = T.StructType([T.StructField("type", T.ByteType()), T.StructField("size", T.IntegerType()),
                        T.StructField("indices", T.ArrayType(T.IntegerType())),
                        T.StructField("values", T.ArrayType(T.DoubleType()))])


def _text(column: str) -> F.Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def _joined(batches):
    """The terms of every text, joined by blanks, and its different terms."""
    for batch in text_blocks(batches):
        every, different = [], []
        for text in column_of(batch, "text").view(pa.binary()).to_pylist():
            terms = text.translate(_BYTES).split()
            every.append(b" ".join(terms))
            different.append(b" ".join(set(terms)))
        yield pa.RecordBatch.from_arrays(
            [column_of(batch, "lang"), column_of(batch, "source"),
             *(pa.array(c, pa.binary()).view(pa.string()) for c in (every, different))],
            names=["lang", "source", "every", "different"])


def term_lists(documents: DataFrame) -> DataFrame:
    """lang, source, and of every document its terms in order (``every``) and
    its different terms (``different``), joined by blanks."""
    rows = documents.select(*[_text(c).alias(c) for c in ("lang", "source", "text")])
    return rows.mapInArrow(_joined, "lang string, source string, every string, different string")


def _terms(column: str) -> F.Column:
    """The list of a joined column's terms and the mark (the last blank gives
    every document one)."""
    return F.split(F.concat(F.col(column), F.lit(" ")), " ")


def _language_key(column: str = "lang") -> F.Column:
    """Folder name of a language, whatever characters it has."""
    return F.sha2(F.col(column), 256)


def write_terms(documents: DataFrame) -> DataFrame:
    """The term lists in one folder per language (column ``folder``)."""
    spark, path = documents.sparkSession, scratch_dir(documents.sparkSession, "terms")
    drawn = F.pmod(F.xxhash64("every"), F.lit(SAMPLE_EVERY)) == 0
    rows = term_lists(documents).withColumns({"drawn": drawn, "folder": _language_key()})
    rows.write.partitionBy("folder").parquet(path)
    return spark.read.schema(rows.schema).parquet(path)


def languages(rows: DataFrame, min_docs: int = MIN_DOCS) -> list[tuple[str, str, int]]:
    """(language, folder, expected number of kept terms at most) of the languages
    with enough documents to keep a term. One document in ``SAMPLE_EVERY`` holds a
    term of 30 documents with probability 0.37, so the kept terms are hardly more
    than three times the sample's different terms."""
    enough = rows.groupBy("lang", "folder").count().where(F.col("count") >= min_docs)
    seen = (rows.where("drawn").select("folder", F.explode(_terms("different")).alias("term"))
            .groupBy("folder").agg(F.approx_count_distinct("term").alias("seen")))
    found = enough.join(seen, "folder", "left").select("lang", "folder", "seen").collect()
    return sorted((r.lang, r.folder, 3 * (r.seen or 0)) for r in found)


def _vector_sums(docs: DataFrame, min_docs: int, shard: F.Column | None = None) -> DataFrame:
    """(source, place, term, n) of one language's documents, through a vectorizer of
    their terms (those of a ``shard``) and the written sparse vectors. Its
    vocabulary depends on the documents that hold a term, not on how often one
    does, so it is fitted to the documents' different terms."""
    spark = docs.sparkSession

    def listed(column: str) -> DataFrame:
        rows = docs.select("source", _terms(column).alias("terms"))
        return rows if shard is None else rows.withColumn("terms", shard)

    model = CountVectorizer(inputCol="terms", outputCol="counts", minDF=float(min_docs),
                            vocabSize=MAX_VOCAB).fit(listed("different"))
    path = scratch_dir(spark, "vectors")
    model.transform(listed("every")).select("source", "counts").write.parquet(path)
    vectors = spark.read.schema(T.StructType([T.StructField("source", T.StringType()),
                                              T.StructField("counts", _VECTOR)])).parquet(path)
    entries = vectors.select("source", F.explode(
        F.arrays_zip("counts.indices", "counts.values")).alias("entry"))
    sums = entries.groupBy("source", F.col("entry.indices").alias("place")).agg(
        F.sum(F.col("entry.values").cast("bigint")).alias("n"))
    # The vocabulary goes to the tasks as a table, by the model's own writer.
    saved = scratch_dir(spark, "vocabulary")
    model.save(saved)
    names = (spark.read.parquet(f"{saved}/data")
             .select(F.posexplode("vocabulary").alias("place", "term")))
    return (sums.join(names.where(F.col("term") != _MARK), "place")
            .select("source", "place", "term", "n"))


def group_counts(rows: DataFrame, min_docs: int = MIN_DOCS,
                 shard_terms: int = SHARD_TERMS) -> DataFrame:
    """(lang, source, number, term, n): occurrences of the kept terms, n > 0. A
    language's term has one number, which no other language's term has."""
    spark = rows.sparkSession
    schema = "lang string, source string, number bigint, term string, n bigint"
    parts = []
    for lang, folder, expected in languages(rows, min_docs):
        docs = rows.where(F.col("folder") == folder)
        shards = max(1, -(-expected // shard_terms))
        for k in range(shards):
            shard = None if shards == 1 else F.expr(
                f"filter(terms, t -> t = '{_MARK}' or pmod(xxhash64(t, 1), {shards}) = {k})")
            number = F.lit(len(parts) << 32).cast("bigint") + F.col("place")
            sums = _vector_sums(docs, min_docs, shard).select(
                F.lit(lang).alias("lang"), "source", number.alias("number"), "term", "n")
            parts.append(materialise(sums, "group-counts"))
    return reduce(DataFrame.unionByName, parts, spark.createDataFrame([], schema))


def _share(n: str | F.Column, total: str, kept: str = "v") -> F.Column:
    """1 + floor(1e9 (n + 5) / (total + 5 v)), exact also beyond a long."""
    count = F.col(n) if isinstance(n, str) else n
    top = (count + SMOOTHING).cast("decimal(20,0)") * F.lit(UNIT).cast("decimal(10,0)")
    bottom = (F.col(total) + SMOOTHING * F.col(kept)).cast("decimal(20,0)")
    return F.lit(1).cast("bigint") + F.call_function("div", top, bottom)


def _ranked(rows: DataFrame) -> DataFrame:
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    return rows.withColumn("rank", F.row_number().over(order))


def source_divergence(documents: DataFrame, min_docs: int = MIN_DOCS, top_terms: int = TOP_TERMS,
                      shard_terms: int = SHARD_TERMS) -> DataFrame:
    """lang, source, part, item, value, rank: how far each other source of the
    language is (part ``pair``), and the terms a source overuses most against
    its language (part ``term``)."""
    rows = write_terms(documents)
    counts = materialise(group_counts(rows, min_docs, shard_terms), "counts")
    by_term = materialise(counts.groupBy("lang", "number").agg(F.sum("n").alias("lang_n")),
                          "by-term")
    by_lang = by_term.groupBy("lang").agg(F.count(F.lit(1)).alias("v"),
                                          F.sum("lang_n").alias("lang_total"))
    totals = counts.groupBy("lang", "source").agg(F.sum("n").alias("total"),
                                                  F.count(F.lit(1)).alias("present"))
    none = F.lit(0).cast("bigint")
    groups = (rows.select("lang", "source").distinct().join(totals, ["lang", "source"], "left")
              .join(by_lang, "lang", "left").fillna(0, ["total", "present", "v", "lang_total"]))
    groups = materialise(groups.select(
        "*", F.when(F.col("v") > 0, _share(none, "total")).otherwise(none).alias("absent"),
        F.monotonically_increasing_id().alias("group")), "groups")
    own = groups.select("lang", "source", "group", "total", "absent", "v")
    shares = materialise(counts.join(own, ["lang", "source"]).select(
        "group", "number", "term", _share("n", "total").alias("p"), "absent"), "shares")

    # A term's share in its language is worked out once, not once per source.
    whole = (by_term.join(F.broadcast(by_lang), "lang")     # a row per language
             .select("number", _share("lang_n", "lang_total").alias("q")))
    over = (shares.join(whole, "number").withColumn("value", F.col("p") - F.col("q"))
            .where("value > 0")
            .join(groups.select("lang", "source", "group"), "group")
            .select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"),
                    "value"))
    terms = _ranked(over).where(F.col("rank") <= top_terms)
    pairs = _ranked(pair_distances(groups, shares))
    return pairs.unionByName(terms).select("lang", "source", "part", "item", "value", "rank")


def pair_distances(groups: DataFrame, shares: DataFrame) -> DataFrame:
    """Sum of |p - q| over all kept terms, for the sources of a language.

    With p0, q0 the shares of an absent term, a pair's sum is
    v |p0 - q0|, plus |p - q0| - |p0 - q0| over the first's terms, plus
    |p0 - q| - |p0 - q0| over the second's, plus, over the terms of both,
    |p - q| - |p - q0| - |p0 - q| + |p0 - q0|."""
    pair = (groups.alias("a").join(groups.alias("b"), F.expr(
        "a.lang = b.lang and a.group <> b.group"))
        .selectExpr("a.lang", "a.source", "b.source as item", "a.group", "b.group as other",
                    "b.absent as other_absent", "a.v * abs(a.absent - b.absent) as base"))
    # A source's terms by share: far fewer rows than terms.
    levels = shares.groupBy("group", "p", "absent").agg(F.count(F.lit(1)).alias("terms"))
    alone = (levels.join(pair.select("group", "other", "other_absent"), "group")
             .groupBy("group", "other")
             .agg(F.sum(F.expr("terms * (abs(p - other_absent) - abs(absent - other_absent))"))
                  .alias("alone")))
    thin = shares.select("group", "number", "p", "absent")
    both = (thin.alias("a").join(thin.alias("b"), F.expr(
        "a.number = b.number and a.group < b.group"))
        .groupBy("a.group", F.col("b.group").alias("other"))
        .agg(F.sum(F.expr("abs(a.p - b.p) - abs(a.p - b.absent) - abs(a.absent - b.p)"
                          " + abs(a.absent - b.absent)")).alias("both")))
    one_way = materialise(alone, "alone")
    other_way = one_way.select(F.col("other").alias("group"), F.col("group").alias("other"),
                               F.col("alone").alias("back"))
    both = materialise(both, "both")
    both = both.unionByName(both.select(F.col("other").alias("group"),
                                        F.col("group").alias("other"), "both"))
    key = ["group", "other"]
    zero = lambda c: F.coalesce(F.col(c), F.lit(0).cast("bigint"))
    return (pair.join(one_way, key, "left").join(other_way, key, "left")
            .join(both, key, "left")
            .select("lang", "source", F.lit("pair").alias("part"), "item",
                    (F.col("base") + zero("alone") + zero("back") + zero("both")).alias("value")))
