"""Toxicity scoring by weak supervision.

1. *Lexicons and patterns.* From a bounded sample of labelled training rows,
   words, word beginnings and pairs of neighbouring words whose documents are
   nearly always toxic are mined by a likelihood-ratio test; a short fixed list
   of English insults is added.
2. *Voters* from separate sources: mined words, beginnings of four and of five
   letters, pairs of words that are harmless alone, fixed insults, insults
   addressed to someone, repeated and dense hits, shouting (exclamation marks or
   capitals), and, voting clean, the absence of any hit.
3. *Label model.* Every document that is not held out votes; Spark counts the
   vote patterns (at most 2 ** voters, a fixed bound). A two-class generative
   model is fitted to the counts by expectation maximisation: every round
   estimates the voters' firing rates per class (their accuracies) and the
   correlations that the classes leave between them, and divides a voter's
   evidence by its share of correlated company.
4. *Linear classifier.* Logistic regression on the posterior labels. Its
   features are the voters' counts and the document's words, hashed to
   ``BUCKETS`` places, so it goes beyond the lexicon.

Every whole text is read once for its features, which are written to the shared
folder; labels are learnt and documents scored from there. The mining sample is
read once more.

Defined results: NULL and empty texts have no hits and no words and get the
score of such a document; rows with a NULL id are scored (``held_out`` false)
but never learnt from; repeated rows are scored alike; without toxic labels only
the fixed list votes; an empty table gives an empty result; extra columns are
ignored.
"""

from __future__ import annotations

import re
import zlib
from functools import lru_cache, reduce
from operator import add

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import (column_of, fold, materialise, only, packed, row_key, text_blocks, unpacked,
                     without)

# English insults every lexicon starts from.
INSULTS = ("clown disgusting dumb filthy garbage idiot idiots imbecile jerk loser losers "
           "moron morons pathetic scum stupid trash vermin worthless").split()

SAMPLE_ROWS = 20_000      # labelled rows the lexicon is mined from (expected, by hash)
FIT_ROWS = 10_000         # rows the classifier is fitted to, per posterior class (expected)
PATTERNS = (4, 5)         # lengths of the word beginnings
MIN_EVIDENCE = 24.0       # likelihood ratio (2 ln) that a term needs
MIN_PRECISION = 0.9       # share of a term's documents that are toxic
BUCKETS = 1 << 16         # places of the hashed words
RIDGE = 1e-3              # of the voters' weights
WORD_RIDGE = 3e-3         # of the words' weights
SHOUT_EVERY = 150         # characters per exclamation mark that count as shouting

_WORD = re.compile(r"[^\W\d_]+")
_ADDRESSED = re.compile(r"\b(?:you|your|you're|they are|he is|she is)\W+(?:\w+\W+){0,2}?([^\W\d_]+)")
VOTERS = ["words", *(f"heads_{n}" for n in PATTERNS), "pairs", "insults", "addressed",
          "two_words", "two_heads", "repeated", "dense", "shouting", "no_hit"]


def _place(key: F.Column) -> F.Column:
    """A hash as a number from 0 to 1: rows below a rate are a sample of it."""
    return F.pmod(key, F.lit(1 << 30)) / float(1 << 30)


def sample_training(documents: DataFrame, labels: DataFrame, rows: int) -> DataFrame:
    """(text, toxic) of about ``rows`` labelled training rows (all, if fewer),
    by the hash of the id; equal texts count once."""
    known = (labels.where(F.col("toxic").isNotNull() & (fold("doc_id", 5) != 0))
             .groupBy("doc_id").agg(F.max("toxic").alias("toxic")))
    chosen = known.where(_place(F.xxhash64("doc_id")) < rows / max(known.count(), 1))
    return (documents.select("doc_id", "text").where(F.col("text").isNotNull())
            .join(F.broadcast(chosen), "doc_id").groupBy(F.xxhash64("text").alias("key"))
            .agg(F.first("text").alias("text"), F.max("toxic").alias("toxic")))


def mine_terms(sample: DataFrame) -> tuple[list[str], float]:
    """Terms (``w:word``, ``4:head``, ``5:heads``, ``p:two words``) nearly
    always toxic, and the toxic share of the sample. A term needs several toxic
    documents, so what is collected is bounded by the sample."""
    words = F.regexp_extract_all(F.lower("text"), F.lit(r"(\p{L}+)"), 1)
    distinct = F.array_distinct("words")
    heads = [F.transform(F.filter(distinct, lambda w, n=n: F.length(w) >= n),
                         lambda w, n=n: F.concat(F.lit(f"{n}:"), F.substring(w, 1, n)))
             for n in PATTERNS]
    n_words = F.size("words")
    pairs = F.when(n_words > 1, F.zip_with(
        F.slice("words", F.lit(1), n_words - 1), F.slice("words", F.lit(2), n_words - 1),
        lambda a, b: F.concat(F.lit("p:"), a, F.lit(" "), b))).otherwise(F.array().cast("array<string>"))
    terms = F.array_distinct(F.concat(
        F.transform(distinct, lambda w: F.concat(F.lit("w:"), w)), pairs, *heads))
    totals = sample.agg(F.count(F.lit(1)).alias("n"), F.sum("toxic").alias("toxic")).first()
    n, toxic = totals.n, totals.toxic or 0
    if not toxic or toxic == n:
        return [], (toxic / n if n else 0.0)
    share = toxic / n
    listed = sample.select("toxic", words.alias("words")).select("toxic", F.explode(terms).alias("term"))
    # A term needs so many toxic documents for its evidence, whatever else has
    # it: only such terms are looked for in the other documents.
    least = MIN_EVIDENCE / (2 * np.log(1 / share))
    bad = materialise(listed.where("toxic = 1").groupBy("term")
                      .agg(F.count(F.lit(1)).cast("double").alias("bad"))
                      .where(F.col("bad") >= least), "toxic-terms", 4)
    good = (only(listed.where("toxic = 0").select("term"), bad.select("term"), "term")
            .groupBy("term").agg(F.count(F.lit(1)).cast("double").alias("good")))
    counts = bad.join(good, "term", "left").fillna(0.0, ["good"]).withColumn(
        "all", F.col("bad") + F.col("good"))
    evidence = 2 * (F.col("bad") * F.log(F.col("bad") / (F.col("all") * share))
                    + F.when(F.col("good") > 0, F.col("good") * F.log(
                        F.col("good") / (F.col("all") * (1 - share)))).otherwise(0.0))
    found = (counts.where(F.col("bad") >= MIN_PRECISION * F.col("all"))
             .where(evidence >= MIN_EVIDENCE).select("term").collect())
    return sorted(r.term for r in found), share


@lru_cache(maxsize=50_000)
def bucket_of(word: str) -> int:
    return zlib.crc32(word.encode("utf-8", "surrogatepass")) % BUCKETS


class Voters:
    """The voters of a lexicon: one pass over a text gives its features."""

    def __init__(self, terms: list[str]):
        kinds: dict[str, set[str]] = {}
        for t in terms:
            kind, _, value = t.partition(":")
            kinds.setdefault(kind, set()).add(value)
        self.words = kinds.get("w", set()) | set(INSULTS)
        self.mined = self.words - set(INSULTS)
        self.heads = {n: kinds.get(str(n), set()) for n in PATTERNS}
        # A pair is a source of its own only if neither word is one.
        self.seconds: dict[str, set[str]] = {}
        for first, second in (p.split(" ") for p in kinds.get("p", ())):
            if first not in self.words and second not in self.words:
                self.seconds.setdefault(first, set()).add(second)

    def features(self, text: str) -> tuple[list[float], list[int]]:
        """(one number per voter: hits, or 0/1 where the voter is a yes or no;
        places of the text's different words)."""
        lowered = text.lower()
        line = _WORD.findall(lowered)
        words = set(line)
        hits = words & self.words
        heads = {n: {w for w in words if w[:n] in known} for n, known in self.heads.items() if known}
        headed = set().union(*heads.values()) if heads else set()
        pairs = set()
        if not words.isdisjoint(self.seconds):
            pairs = {(a, b) for a, b in zip(line, line[1:]) if b in self.seconds.get(a, ())}
        every = hits | headed
        found = bool(every or pairs)
        shout = len(text) >= 20 and (text.count("!") * SHOUT_EVERY >= len(text) or text.isupper())
        row = [len(hits & self.mined), *(len(heads.get(n, ())) for n in PATTERNS), len(pairs),
               len(hits & set(INSULTS)),
               bool(every) and any(w in every for w in _ADDRESSED.findall(lowered)),
               len(hits) >= 2, len(headed) >= 2,
               bool(every) and sum(w in every for w in line) > len(every),
               found and len(every) + len(pairs) >= 0.01 * len(words), shout, not found]
        return [float(v) for v in row], sorted({bucket_of(w) for w in words})


def vote_features(rows: DataFrame, terms: list[str], text: str = "text") -> DataFrame:
    """The rows without their text, with the voters' features and the places of
    their words."""
    kept = [f for f in rows.schema.fields if f.name != text]
    schema = T.StructType([*kept, T.StructField("features", T.ArrayType(T.FloatType())),
                           T.StructField("places", T.ArrayType(T.IntegerType()))])

    def run(batches):
        voters = Voters(terms)
        for block in text_blocks(batches, text, 1 << 20):
            found = [voters.features(t or "") for t in column_of(block, text).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*(column_of(block, f.name) for f in kept),
                 pa.array([v for v, _ in found], pa.list_(pa.float32())),
                 pa.array([p for _, p in found], pa.list_(pa.int32()))],
                names=[f.name for f in schema])

    return rows.mapInArrow(run, schema)


def _pattern() -> F.Column:
    """The voters that fire, as bits."""
    return reduce(add, [F.when(F.col("features")[k] > 0, 1 << k).otherwise(0)
                        for k in range(len(VOTERS))])


class LabelModel:
    """Two-class generative model of binary voters with correlation discount."""

    def __init__(self, votes: np.ndarray, counts: np.ndarray, share: float, rounds: int = 200):
        clean = np.array([v == "no_hit" for v in VOTERS])
        weight = counts / max(counts.sum(), 1)
        # Start: a document with more hit voters than clean ones is toxic.
        lean = (votes[:, ~clean].sum(1) - 2 * votes[:, clean].sum(1)) > 0
        posterior = np.where(lean, 0.9, 0.02)
        self.share = min(max(share, 1e-3), 1 - 1e-3)
        self.discount = np.ones(votes.shape[1])
        self.correlations = np.eye(votes.shape[1])
        for k in range(rounds):
            mass = np.array([weight @ (1 - posterior), weight @ posterior])
            self.rates = np.stack([(weight * (1 - posterior)) @ votes,
                                   (weight * posterior) @ votes])
            self.rates = (self.rates + 1e-5) / (mass[:, None] + 2e-5)
            self.correlations = self._residual(votes, weight, posterior)
            company = np.clip(self.correlations, 0, 1)
            np.fill_diagonal(company, 0)
            # Half a step at a time, so that rates and correlations settle together.
            self.discount = (self.discount + 1 / (1 + company.sum(1))) / 2
            after = self.posterior(votes)
            moved, posterior = np.abs(after - posterior).max(initial=0.0), after
            if moved < 1e-9:
                break

    def posterior(self, votes: np.ndarray) -> np.ndarray:
        odds = np.log(self.rates[1] / self.rates[0]), np.log((1 - self.rates[1]) / (1 - self.rates[0]))
        total = (np.log(self.share / (1 - self.share))
                 + (votes * odds[0] + (1 - votes) * odds[1]) @ self.discount)
        return 1 / (1 + np.exp(-np.clip(total, -500, 500)))

    def _residual(self, votes, weight, posterior) -> np.ndarray:
        """Correlations of the voters within the classes."""
        total = np.zeros((votes.shape[1],) * 2)
        for label, share in ((0, 1 - posterior), (1, posterior)):
            rest = votes - self.rates[label]
            total += (rest * (weight * share)[:, None]).T @ rest
        size = np.sqrt(np.clip(np.diag(total), 1e-12, None))
        return total / np.outer(size, size)


class Documents:
    """Features of documents: a dense matrix of the voters' counts (as
    logarithms, after a column of ones) and the places of their words, each
    document's scaled to length one."""

    def __init__(self, features: np.ndarray, places: np.ndarray, ends: np.ndarray):
        self.dense = np.hstack([np.ones((len(features), 1)), np.log1p(features)])
        sizes = np.diff(ends, prepend=0)
        self.places = places
        self.owner = np.repeat(np.arange(len(sizes)), sizes)
        self.value = np.repeat(1 / np.sqrt(np.maximum(sizes, 1)), sizes)

    def scores(self, weights: np.ndarray) -> np.ndarray:
        width = self.dense.shape[1]
        words = np.bincount(self.owner, weights[width:][self.places] * self.value, len(self.dense))
        return 1 / (1 + np.exp(-np.clip(self.dense @ weights[:width] + words, -30, 30)))

    def gradient(self, error: np.ndarray) -> np.ndarray:
        return np.concatenate([self.dense.T @ error, np.bincount(
            self.places, error[self.owner] * self.value, BUCKETS)])


def fit_classifier(docs: Documents, y: np.ndarray, weight: np.ndarray, rounds: int = 60,
                   memory: int = 8) -> np.ndarray:
    """Logistic regression on soft labels by limited-memory quasi-Newton steps:
    bias, voters' weights, words' weights."""
    width = docs.dense.shape[1]
    penalty = np.concatenate([[0.0], np.full(width - 1, RIDGE), np.full(BUCKETS, WORD_RIDGE)])
    weight = weight / max(weight.sum(), 1e-12)

    def loss(w):
        p = docs.scores(w)
        value = -(weight @ (y * np.log(p) + (1 - y) * np.log(1 - p))) + 0.5 * penalty @ (w * w)
        return value, docs.gradient(weight * (p - y)) + penalty * w

    w = np.zeros(width + BUCKETS)
    value, slope = loss(w)
    past: list[tuple[np.ndarray, np.ndarray, float]] = []
    for _ in range(rounds):
        step, shares = slope.copy(), []
        for s, d, rho in reversed(past):
            shares.append(rho * (s @ step))
            step -= shares[-1] * d
        if past:
            s, d, _ = past[-1]
            step *= (s @ d) / (d @ d)
        for (s, d, rho), share in zip(past, reversed(shares)):
            step += s * (share - rho * (d @ step))
        length, gain = 1.0, slope @ step
        while length > 1e-10:
            after, after_slope = loss(w - length * step)
            if after <= value - 1e-4 * length * gain:
                break
            length /= 2
        else:
            break
        s, d = -length * step, after_slope - slope
        if s @ d > 1e-12:
            past = [*past[-(memory - 1):], (s, d, 1 / (s @ d))]
        w, moved = w + s, value - after
        value, slope = after, after_slope
        if moved < 1e-9:
            break
    return w


def _documents(features: pa.Array, places: pa.Array) -> Documents:
    flat = np.asarray(features.flatten(), dtype=np.float64).reshape(-1, len(VOTERS))
    ends = np.cumsum(np.diff(np.asarray(places.offsets))) if len(places) else np.zeros(0, int)
    return Documents(flat, np.asarray(places.flatten()), ends)


def learn(features: DataFrame, share: float) -> tuple[LabelModel, np.ndarray]:
    """Label model over the vote patterns of all training rows, and the
    classifier's weights. ``features`` is a written table."""
    training = features.where("training")
    groups = (training.groupBy(_pattern().alias("pattern"))
              .agg(F.count(F.lit(1)).alias("n")).orderBy("pattern").collect())
    bits = np.array([[r.pattern >> k & 1 for k in range(len(VOTERS))] for r in groups],
                    dtype=np.float64).reshape(len(groups), len(VOTERS))
    counts = np.array([r.n for r in groups], dtype=np.float64)
    model = LabelModel(bits, counts, share)
    if not len(groups):
        return model, np.array([-3.0, *[1.0 * (v != "no_hit") for v in VOTERS],
                                *np.zeros(BUCKETS)])
    label = {r.pattern: p for r, p in zip(groups, model.posterior(bits))}
    toxic = [k for k, p in label.items() if p >= 0.5]
    held = {k: sum(r.n for r in groups if (r.pattern in toxic) == k) for k in (True, False)}
    rate = F.when(_pattern().isin(toxic), FIT_ROWS / max(held[True], 1)).otherwise(
        FIT_ROWS / max(held[False], 1))
    parts = (training.where(_place(F.col("order_key")) < rate)
             .select("features", "places", _pattern().alias("pattern")).toArrow().combine_chunks())
    docs = _documents(*(_one_array(parts.column(c)) for c in ("features", "places")))
    y = np.array([label[k] for k in parts.column("pattern").to_pylist()])
    # Both classes weigh alike, so that a rare class is not given up.
    weight = np.where(y >= 0.5, 0.5 / max((y >= 0.5).sum(), 1), 0.5 / max((y < 0.5).sum(), 1))
    return model, fit_classifier(docs, y, weight)


def _one_array(column: pa.ChunkedArray) -> pa.Array:
    return pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], column.type)


def scored(documents: DataFrame, labels: DataFrame, rows: DataFrame) -> DataFrame:
    """``rows`` (of the documents, with their marks) without text, with score."""
    terms, share = mine_terms(materialise(sample_training(documents, labels, SAMPLE_ROWS),
                                          "mining-sample", 16))
    features = materialise(vote_features(rows, terms), "vote-features")
    _, weights = learn(features, share)
    kept = [f for f in rows.schema.fields if f.name != "text"]
    schema = T.StructType([*kept, T.StructField("score", T.DoubleType())])

    def run(batches):
        for batch in batches:
            docs = _documents(column_of(batch, "features"), column_of(batch, "places"))
            yield pa.RecordBatch.from_arrays(
                [*(column_of(batch, f.name) for f in kept), pa.array(docs.scores(weights))],
                names=[f.name for f in schema])

    return features.mapInArrow(run, schema)


def _marks() -> dict[str, F.Column]:
    rest = fold("doc_id", 5)
    return {"held_out": F.coalesce(rest == 0, F.lit(False)),
            "training": F.coalesce(rest != 0, F.lit(False)),
            "order_key": F.xxhash64("doc_id")}


def toxicity(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted for every document."""
    rows = documents.select("doc_id", "text").withColumns(_marks())
    return scored(documents, labels, rows).select(
        "doc_id", "held_out", "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def keep_clean(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """Pipeline stage: drop documents predicted toxic; columns stay. The keys of
    those that go are taken out of the documents, which are not written between."""
    rows = documents.select("doc_id", "text", row_key().alias("row_key")).withColumns(_marks())
    toxic = materialise(scored(documents, labels, rows).where("score >= 0.5")
                        .select("row_key").distinct(), "toxic")
    keyed = documents.select(packed(documents), row_key().alias("row_key"))
    return unpacked(without(keyed, toxic, "row_key"), documents.columns)
