"""Language identification with hyperdimensional profiles.

Every letter of Unicode has a fixed random bipolar vector of its own. A letter trigram is bound by
permuting (rotating) the letters' vectors by their place and multiplying them;
a document is the bundle (sum) of its trigrams' vectors, and a language's
prototype is the bundle of all its training documents. A document is compared
with the prototypes by cosine.

Learning and prediction each read every whole text once. Learning keeps one
vector per language and task, summed by Spark; what reaches the driver is one
vector per learned language.

Defined results: NULL text, empty text or text without a letter gives ``und``
and score 0; equal cosines give the language that sorts first; without
training rows every document is ``und``; repeated rows are predicted one by
one; only the id, text and language columns are read, so extra columns do not
matter. Rows with a NULL id are predicted (``held_out`` false) and never
learnt from.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import column_of, fold, numbered, renamed_back, text_blocks, texts_of

DIM = 1024
SEED = 20240607
UNDETERMINED = "und"
# Pipeline rule (``recognised``): longer vectors than the predictions, the share
# of a language's own trigram frequency below which a text is foreign to it, the
# noise (in standard deviations) a text is given, and the different trigrams
# below which a text with letters is always kept.
STAGE_DIM = 4096
MIN_SHARE = 0.3
NOISE = 2.0
FEW_TRIGRAMS = 24

_BITS = 18                # of a letter's number: there are about 141,000 letters
_BOUNDARY = 1
_LETTERS = 1 << 14        # letters whose vectors a worker keeps
# Rows and text bytes handled at once: they bound a worker's memory.
_ROWS = 512               # a trigram and its row's number fill 63 bits
_BYTES = 1 << 20
_CELLS = 1 << 21          # numbers of the trigram vectors held at once


@lru_cache(maxsize=1)
def _letter_numbers() -> np.ndarray:
    """Number of each code point's letter, 0 for anything that is no letter."""
    letters = [c for c in range(0x110000) if chr(c).isalpha()]
    numbers = np.zeros(0x110000, dtype=np.int32)
    numbers[letters] = np.arange(len(letters)) + _BOUNDARY + 1
    return numbers


@lru_cache(maxsize=_LETTERS)
def _letter_vector(number: int, dim: int) -> np.ndarray:
    """A letter's vector, the same in every process."""
    bits = np.random.Generator(np.random.Philox(key=[SEED, number])).integers(
        0, 2, dim, dtype=np.int8)
    return bits * np.int8(2) - np.int8(1)


def trigram_counts(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, trigram code, count) of the lower-cased texts. Each letter
    is the middle of one trigram; any run of other characters counts as one
    word boundary."""
    padded = [f" {t.lower()} " for t in texts]
    lengths = np.array([len(t) for t in padded], dtype=np.int64)
    points = np.frombuffer("".join(padded).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    numbers = _letter_numbers()[points]
    letter = numbers > 0
    keep = letter.copy()
    keep[1:] |= letter[:-1]
    keep[:1] = True
    owner = np.repeat(np.arange(len(texts), dtype=np.int64), lengths)[keep]
    line = numbers[keep].astype(np.int64)
    line[line == 0] = _BOUNDARY
    middle = np.flatnonzero(line[1:-1] != _BOUNDARY) + 1
    keys = ((((owner[middle] << _BITS | line[middle - 1]) << _BITS | line[middle]) << _BITS)
            | line[middle + 1])
    keys.sort()
    first = np.flatnonzero(np.diff(keys, prepend=-1))
    counts = np.diff(first, append=len(keys))
    distinct = keys[first]
    return distinct >> 3 * _BITS, distinct & ((1 << 3 * _BITS) - 1), counts


def trigram_vectors(codes: np.ndarray, dim: int) -> np.ndarray:
    """Bound vectors of the trigram codes: the letters' vectors rotated by 2, 1
    and 0 places, multiplied."""
    mask = (1 << _BITS) - 1
    letters, where = np.unique([codes >> 2 * _BITS, codes >> _BITS & mask, codes & mask],
                               return_inverse=True)
    where = where.reshape(3, -1)
    base = np.array([_letter_vector(int(n), dim) for n in letters],
                    dtype=np.int8).reshape(-1, dim)
    two, one = np.roll(base, 2, axis=1), np.roll(base, 1, axis=1)
    return (two[where[0]] * one[where[1]] * base[where[2]]).astype(np.float32)


def bundled(owner: np.ndarray, codes: np.ndarray, counts: np.ndarray, rows: int,
            dim: int) -> np.ndarray:
    """Sums of the trigrams' vectors per owner, a part of the trigrams at a
    time: memory does not depend on how many there are."""
    distinct, where = np.unique(codes, return_inverse=True)
    total = np.zeros((rows, dim))
    order = np.argsort(where, kind="stable")
    step = max(_CELLS // dim, 1)
    for lo in range(0, len(distinct), step):
        hi = min(lo + step, len(distinct))
        part = order[np.searchsorted(where, lo, sorter=order): np.searchsorted(where, hi, sorter=order)]
        weights = np.zeros((rows, hi - lo), dtype=np.float32)
        weights[owner[part], where[part] - lo] = counts[part]
        total += weights @ trigram_vectors(distinct[lo:hi], dim)
    return total


def document_vectors(texts: list[str], dim: int) -> np.ndarray:
    return bundled(*trigram_counts(texts), len(texts), dim)


def learn_prototypes(training: DataFrame, text: str = "text", lang: str = "lang",
                     dim: int = DIM) -> tuple[list[str], np.ndarray]:
    """Prototypes of all languages of the training rows: (names, vectors)."""
    names, vectors, _ = _learnt_sums(training, text, lang, dim)
    norms = np.linalg.norm(vectors, axis=1, keepdims=True)
    return names, vectors / np.where(norms > 0, norms, 1)


def _learnt_sums(training: DataFrame, text: str, lang: str, dim: int
                 ) -> tuple[list[str], np.ndarray, np.ndarray]:
    """(names, summed vectors, number of trigrams) per language."""
    def bundle(batches):
        sums: dict[str, np.ndarray] = {}
        for block in text_blocks(batches, "text", _BYTES, _ROWS):
            langs = column_of(block, "lang").to_pylist()
            names = sorted(set(langs))
            place = np.array([names.index(g) for g in langs])
            owner, codes, counts = trigram_counts(texts_of(block))
            # One count per language and trigram, then one vector per language.
            keys, where = np.unique(place[owner] << 3 * _BITS | codes, return_inverse=True)
            vectors = bundled(keys >> 3 * _BITS, keys & (1 << 3 * _BITS) - 1,
                              np.bincount(where, counts, len(keys)), len(names), dim)
            # The last place holds the number of trigrams.
            vectors = np.column_stack([vectors, np.bincount(place[owner], counts, len(names))])
            for name, vector in zip(names, np.rint(vectors).astype(np.int64)):
                sums[name] = sums.get(name, 0) + vector
        if sums:
            yield pa.RecordBatch.from_pydict(
                {"lang": list(sums), "vector": [v.tolist() for v in sums.values()]},
                schema=pa.schema([("lang", pa.string()), ("vector", pa.list_(pa.int64()))]))

    rows = training.where(F.col(lang).isNotNull() & F.col(text).isNotNull())
    partial = (rows.select(F.col(text).alias("text"), F.col(lang).cast("string").alias("lang"))
               .mapInArrow(bundle, "lang string, vector array<long>"))
    sums = (partial.select("lang", F.posexplode("vector").alias("place", "value"))
            .groupBy("lang", "place").agg(F.sum("value").alias("value")).collect())
    names = sorted({r.lang for r in sums})
    vectors = np.zeros((len(names), dim + 1))
    for r in sums:
        vectors[names.index(r.lang), r.place] = r.value
    return names, vectors[:, :dim], vectors[:, dim]


def predict_language(rows: DataFrame, names: list[str], prototypes: np.ndarray,
                     text: str = "text") -> DataFrame:
    """The rows without their text, with ``lang_pred`` and the cosine ``score``
    (0 to 1)."""
    dim = prototypes.shape[1]
    kept = [f for f in rows.schema.fields if f.name != text]
    schema = T.StructType([*kept, T.StructField("lang_pred", T.StringType()),
                           T.StructField("score", T.DoubleType())])

    def predict(batches):
        for block in text_blocks(batches, text, _BYTES, _ROWS):
            vectors = document_vectors(texts_of(block, text), dim)
            size = np.linalg.norm(vectors, axis=1)
            found = [UNDETERMINED] * block.num_rows
            cosine = np.zeros(block.num_rows)
            if names:
                all_cosines = vectors @ prototypes.T / np.where(size > 0, size, 1)[:, None]
                best = np.argmax(all_cosines, axis=1)
                cosine = np.clip(all_cosines[np.arange(len(best)), best], 0.0, 1.0)
                found = [names[b] if s > 0 else UNDETERMINED for b, s in zip(best, size)]
            yield pa.RecordBatch.from_arrays(
                [*(column_of(block, f.name) for f in kept), pa.array(found, pa.string()),
                 pa.array(cosine, pa.float64())], names=[f.name for f in schema])

    return rows.mapInArrow(predict, schema)


def identify(documents: DataFrame) -> DataFrame:
    """Learn from the documents that are not held out (crc32 of the id modulo
    4 is not 2) and predict all of them."""
    rest = fold("doc_id", 4)
    names, prototypes = learn_prototypes(documents.where(rest != 2))
    rows = documents.select("doc_id", F.coalesce(rest == 2, F.lit(False)).alias("held_out"),
                            "text")
    return predict_language(rows, names, prototypes)


def recognised(texts: list[str], prototypes: np.ndarray, usual: np.ndarray) -> np.ndarray:
    """Which texts have a language. ``usual`` is the cosine of a language's own
    text per root of its different trigrams; sums of products with trigram
    vectors give the document vectors' products with the prototypes.

    A text of n effective trigrams (square of their number by the sum of squared
    counts) of a language has a cosine of about usual * sqrt(n). It is rejected
    when no language reaches MIN_SHARE of that less the noise of the vectors, or
    the noise itself where too little was learnt to expect more.
    """
    dim = prototypes.shape[1]
    owner, codes, counts = trigram_counts(texts)
    lettered = np.bincount(owner, minlength=len(texts)) > 0
    if not len(prototypes):
        return np.zeros(len(texts), dtype=bool)
    squares = np.maximum(np.bincount(owner, counts.astype(float) ** 2, len(texts)), 1)
    effective = np.bincount(owner, counts, len(texts)) ** 2 / squares
    distinct, where = np.unique(codes, return_inverse=True)
    step = max(_CELLS // dim, 1)
    single = np.concatenate([np.zeros((0, len(prototypes)))] + [
        trigram_vectors(distinct[lo: lo + step], dim) @ prototypes.T.astype(np.float32)
        for lo in range(0, len(distinct), step)])
    noise = NOISE / np.sqrt(dim)
    fits = effective < FEW_TRIGRAMS
    for k, own in enumerate(usual):
        cosine = np.bincount(owner, counts * single[where, k], len(texts)) / np.sqrt(dim * squares)
        fits |= cosine >= np.maximum(MIN_SHARE * own * np.sqrt(effective) - noise, noise)
    return fits & lettered


def learn_recognition(training: DataFrame, dim: int = STAGE_DIM) -> tuple[np.ndarray, np.ndarray]:
    """(prototypes, usual) for ``recognised``. With counts p of n trigrams, the
    mean frequency of the language's own trigrams is (sum p^2 - n) / n: a
    trigram does not count as its own evidence."""
    _, vectors, n = _learnt_sums(training, "text", "lang", dim)
    squares = (vectors ** 2).sum(axis=1) / dim
    known = (n > 0) & (squares > 0)
    vectors, n, squares = vectors[known], n[known], squares[known]
    size = np.sqrt(squares)
    usual = np.maximum(squares - n, 0) / (n * size)
    return vectors / (size * np.sqrt(dim))[:, None], usual


def keep_identified(documents: DataFrame) -> DataFrame:
    """Pipeline stage: drop documents without a recognised language; the
    columns stay as they are."""
    prototypes, usual = learn_recognition(documents.where(fold("doc_id", 4) != 2))
    rows = numbered(documents)
    text = f"c{documents.columns.index('text')}"

    def keep(batches):
        for block in text_blocks(batches, text, _BYTES, _ROWS):
            yield block.filter(pa.array(recognised(texts_of(block, text), prototypes, usual)))

    return renamed_back(rows.mapInArrow(keep, rows.schema), documents.columns)
