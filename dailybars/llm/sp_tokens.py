"""SentencePiece encoding and decoding on the tokenizers library.

The model file (a protobuf message) is read with a small field reader; from
it the normaliser, the white-space marker, the pieces with their scores and
the byte fallback are rebuilt as tokenizers-library objects: a Unigram model
from the scores, or a BPE model whose merges are the ways to join two pieces
into a third, by the third's score.

Encoding. No piece of such a model holds a marker behind another character
(this is checked), so a normalised text can be cut before every marker that
follows something else, and the parts are encoded on their own. The cuts of a
block are found in its UTF-8 bytes, and Arrow numbers its different parts. Their
ids are cached per Python worker, in two bounded generations; the new parts of a
block are encoded in one batch by ``THREADS`` threads, and encoded by the
SentencePiece library as well. A document has ``parity`` if both libraries give
the same ids for all its parts. Its ids are then decoded whole, by the path that
``decode`` takes, and it has ``round_trip`` if that gives back its normalised
text (a literal marker character comes back as a blank, so it has not). A model
without that property is encoded text by text.

Defined results: NULL and empty texts have no ids and hold both properties;
repeated rows are encoded one by one; an empty table gives an empty result;
extra columns are ignored.
"""

from __future__ import annotations

import os
import zlib
from array import array
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from .common import column_of, text_blocks, texts_of
from .encoding import tokenizer_path

MODEL = "piece_bpe_32k.model"
THREADS = 2               # of both libraries, per Python worker
CACHE_ENTRIES = 600_000
LEARN_PARTS = 1_000       # new parts per input of the tokenizers library
MARK = "▁"

# Kinds of pieces and of models in the model file's format.
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
UNIGRAM, BPE = 1, 2


def _fields(data: bytes):
    """(number, value) of the fields of a protobuf message: integers, 32-bit
    values as bytes, or the bytes of strings and nested messages."""
    at = 0

    def varint():
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(data):
        key = varint()
        wire = key & 7
        if wire == 0:
            yield key >> 3, varint()
            continue
        size = varint() if wire == 2 else {1: 8, 5: 4}[wire]
        yield key >> 3, data[at: at + size]
        at += size


class Model:
    """What the encoder needs of a model file."""

    def __init__(self, data: bytes):
        self.pieces: list[tuple[str, float, int]] = []
        trainer: dict[int, object] = {}
        normal: dict[int, object] = {}
        for number, value in _fields(data):
            if number == 1:
                f = dict(_fields(value))
                score = float(np.frombuffer(f.get(2, bytes(4)), "<f4")[0])
                self.pieces.append((f.get(1, b"").decode("utf-8"), score, f.get(3, NORMAL)))
            elif number == 2:
                trainer = dict(_fields(value))
            elif number == 3:
                normal = dict(_fields(value))
        self.kind = trainer.get(3, UNIGRAM)
        self.byte_fallback = bool(trainer.get(35, 0))
        self.suffix_mark = bool(trainer.get(24, 0))
        self.unknown = next((k for k, p in enumerate(self.pieces) if p[2] == UNKNOWN), 0)
        self.charsmap = normal.get(2, b"")
        self.dummy_prefix = bool(normal.get(3, 1))
        self.squeeze = bool(normal.get(4, 1))
        texts = [p for p, _, kind in self.pieces if kind in (NORMAL, USER_DEFINED)]
        self.cuttable = not self.suffix_mark and not any(
            MARK in p.lstrip(MARK) for p in texts)


def rebuild(model: Model):
    """(normaliser, tokenizer) of the tokenizers library."""
    from tokenizers import Regex, Tokenizer, decoders, models, normalizers
    steps = [normalizers.Precompiled(model.charsmap)] if model.charsmap else []
    if model.squeeze:
        steps += [normalizers.Strip(), normalizers.Replace(Regex(" {2,}"), " ")]
    if model.kind == UNIGRAM:
        core = models.Unigram([(p, s) for p, s, _ in model.pieces], model.unknown,
                              model.byte_fallback)
    else:
        place = {p: k for k, (p, _, kind) in enumerate(model.pieces)
                 if kind in (NORMAL, USER_DEFINED)}
        merges = []
        for piece, k in place.items():
            splits = [(piece[:c], piece[c:]) for c in range(1, len(piece))]
            merges += [(-model.pieces[k][1], place[a], place[b], a, b)
                       for a, b in splits if a in place and b in place]
        core = models.BPE({p: k for k, (p, _, _) in enumerate(model.pieces)},
                          [(a, b) for *_, a, b in sorted(merges)],
                          unk_token=model.pieces[model.unknown][0], fuse_unk=True,
                          byte_fallback=model.byte_fallback)
    tokenizer = Tokenizer(core)
    tokenizer.decoder = decoders.Sequence([
        decoders.Replace(MARK, " "), decoders.ByteFallback(), decoders.Fuse()])
    return normalizers.Sequence(steps) if steps else None, tokenizer


def speaker(model: Model, tokenizer):
    """Tokenizer that decodes like ``tokenizer``: its pieces hold blanks for
    markers already, so that no token need be searched for them."""
    from tokenizers import Tokenizer, decoders, models
    names = [p.replace(MARK, " ") for p, _, _ in model.pieces]
    if len(set(names)) < len(names):
        return tokenizer
    out = Tokenizer(models.WordLevel({p: k for k, p in enumerate(names)}, names[model.unknown]))
    out.decoder = decoders.Sequence([decoders.ByteFallback(), decoders.Fuse()])
    return out


def covers(model: Model) -> np.ndarray | None:
    """Bytes of text that a token of every piece stands for; None for a model
    whose unknown characters become one piece."""
    if not model.byte_fallback or sum(kind == BYTE for *_, kind in model.pieces) < 256:
        return None
    return np.array([1 if kind == BYTE else len(p.encode("utf-8")) for p, _, kind in model.pieces])


class PieceEncoder:
    """Encoder of one worker: normalise, cut, look up, encode what is new."""

    def __init__(self, path: str, threads: int = THREADS):
        os.environ.setdefault("RAYON_NUM_THREADS", str(threads))
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "true" if threads > 1 else "false")
        from sentencepiece import SentencePieceProcessor
        with open(path, "rb") as file:
            data = file.read()
        self.model = Model(data)
        self.normaliser, self.tokenizer = rebuild(self.model)
        self.speaker = speaker(self.model, self.tokenizer)
        self.covers = covers(self.model)
        self.reference = SentencePieceProcessor(model_proto=data)
        self.threads = threads
        self.cache: dict[bytes, bytes] = {}
        self.old: dict[bytes, bytes] = {}
        self.unequal: set[bytes] = set()

    def normal(self, text: str) -> str:
        """The normalised text, which decoding should give back."""
        return self.normaliser.normalize_str(text) if self.normaliser is not None and text else text

    def parts(self, normal: list[str]) -> tuple[pa.Array, np.ndarray]:
        """The parts of normalised texts, in UTF-8 with blanks for markers, and
        for every text the number of parts up to its end."""
        prefix = " " * self.model.dummy_prefix
        texts = pa.array([t and prefix + t.replace(MARK, " ") for t in normal], pa.large_string())
        _, ends, data = texts.buffers()
        ends = np.frombuffer(ends, np.int64)[: len(texts) + 1]
        blob = np.frombuffer(data or b"", np.uint8)[: ends[-1]]
        starts = np.zeros(len(blob) + 1, bool)
        if self.model.cuttable:
            blank = blob == 32
            starts[1:-1] = blank[1:] & ~blank[:-1]
        starts[ends] = True       # the last one is the end of all parts
        starts = np.flatnonzero(starts)
        parts = pa.Array.from_buffers(pa.large_binary(), len(starts) - 1,
                                      [None, pa.py_buffer(starts), data or pa.py_buffer(b"")])
        return parts, np.searchsorted(starts, ends)[1:]

    def _ids(self, parts: list[str]) -> list[list[int]]:
        """The tokenizers library's ids of every part (with markers)."""
        if self.covers is None:
            return [e.ids for e in self.tokenizer.encode_batch_fast(parts, add_special_tokens=False)]
        # Parts go in as the words of longer inputs, each encoded on its own. A
        # token stands for its own bytes, so a part ends where they add up.
        groups = [parts[k: k + LEARN_PARTS] for k in range(0, len(parts), LEARN_PARTS)]
        out = []
        for group, found in zip(groups, self.tokenizer.encode_batch_fast(
                groups, is_pretokenized=True, add_special_tokens=False)):
            ids = found.ids
            upto = np.cumsum(self.covers[ids])
            wanted = np.cumsum([len(p.encode("utf-8")) for p in group])
            ends = np.searchsorted(upto, wanted)
            if upto[-1] != wanted[-1] or (upto[ends] != wanted).any():
                raise ValueError("tokens do not cover their parts")
            ends = (ends + 1).tolist()
            out += [ids[a:b] for a, b in zip([0, *ends], ends)]
        return out

    def _learn(self, parts: list[bytes]) -> list[bytes]:
        """The ids of parts, having both libraries encode them."""
        texts = [p.decode("utf-8") for p in parts]
        prefix = int(self.model.dummy_prefix)
        # The library puts the prefix mark before every text itself.
        same = self.reference.encode([t[prefix:] for t in texts], num_threads=self.threads)
        alone = [self.reference.piece_to_id(MARK)]   # of an empty text it gives no ids
        found = self._ids([t.replace(" ", MARK) for t in texts])
        self.unequal.update(p for p, a, b in zip(parts, found, same)
                            if a != (alone if p == b" " and prefix else b))
        return [array("I", ids).tobytes() for ids in found]

    def _know(self, wanted: list[bytes]) -> list[bytes]:
        """The ids of different parts. A full cache becomes the old one, from
        which parts still in use move over."""
        found = list(map(self.cache.get, wanted))
        new = [k for k, ids in enumerate(found) if ids is None]
        for k in new:
            found[k] = self.old.get(wanted[k])
        if new and len(self.cache) + len(new) > CACHE_ENTRIES:
            self.old = self.cache
            self.cache = {p: ids for p, ids in zip(wanted, found) if ids is not None}
        unseen = [k for k in new if found[k] is None]
        if unseen:
            for k, ids in zip(unseen, self._learn([wanted[k] for k in unseen])):
                found[k] = ids
        self.cache.update((wanted[k], found[k]) for k in new)
        return found

    def encode_block(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """The ids of all texts in a row, where each text's begin (and the last
        one's end), parity and round trip per text."""
        normal = [self.normal(t) for t in texts]
        parts, last = self.parts(normal)
        coded = parts.dictionary_encode()
        different = coded.dictionary.to_pylist()
        found = self._know(different)
        sizes = np.fromiter(map(len, found), np.int64, len(found)) // 4
        lists = pa.LargeListArray.from_arrays(
            np.concatenate([[0], np.cumsum(sizes)]),
            pa.array(np.frombuffer(b"".join(found), np.uint32)))
        places = np.asarray(coded.indices)
        ids = np.asarray(pc.take(lists, coded.indices).flatten())
        upto = np.concatenate([[0], np.cumsum(sizes[places])])
        ends = upto[np.concatenate([[0], last])]
        parity = np.ones(len(texts), bool)
        if self.unequal:
            bad = np.array([p in self.unequal for p in different], bool)
            seen = np.concatenate([[0], np.cumsum(bad[places])])[np.concatenate([[0], last])]
            parity = seen[1:] == seen[:-1]
        plain = ids.tolist()
        back = self.decode([plain[a:b] for a, b in zip(ends[:-1], ends[1:])])
        return ids, ends, parity, np.array([a == b for a, b in zip(normal, back)], bool)

    def encode(self, texts: list[str]) -> list[tuple[bytes, bool, bool]]:
        """(ids as unsigned 32-bit numbers, parity, round trip) per text."""
        ids, ends, parity, round_trip = self.encode_block(texts)
        return [(ids[a:b].tobytes(), p, r) for a, b, p, r in zip(
            ends[:-1], ends[1:], parity.tolist(), round_trip.tolist())]

    def decode(self, ids: list[list[int]]) -> list[str]:
        texts = self.speaker.decode_batch(ids, skip_special_tokens=False)
        prefix = int(self.model.dummy_prefix)
        return [t[prefix:] if t[:prefix] == " " else t for t in texts]


@lru_cache(maxsize=2)
def piece_encoder(path: str, threads: int = THREADS) -> PieceEncoder:
    return PieceEncoder(path, threads)


def encode(documents: DataFrame, path: str, threads: int = THREADS) -> DataFrame:
    """doc_id, ids, parity, round_trip of every document."""
    def run(batches):
        encoder = piece_encoder(path, threads)
        for block in text_blocks(batches):
            ids, ends, parity, round_trip = encoder.encode_block(texts_of(block))
            yield pa.RecordBatch.from_arrays(
                [column_of(block, "doc_id"),
                 pa.ListArray.from_arrays(ends.astype(np.int32), ids.astype(np.int32)),
                 pa.array(parity), pa.array(round_trip)],
                names=["doc_id", "ids", "parity", "round_trip"])

    kind = documents.schema["doc_id"].dataType.simpleString()
    return documents.select("doc_id", "text").mapInArrow(
        run, f"doc_id {kind}, ids array<int>, parity boolean, round_trip boolean")


def decode(encoded: DataFrame, path: str, threads: int = THREADS) -> DataFrame:
    """doc_id and text of encoded documents."""
    def run(batches):
        encoder = piece_encoder(path, threads)
        for batch in batches:
            texts = encoder.decode([i or [] for i in column_of(batch, "ids").to_pylist()])
            yield pa.RecordBatch.from_arrays(
                [column_of(batch, "doc_id"), pa.array(texts, pa.string())], names=["doc_id", "text"])

    kind = encoded.schema["doc_id"].dataType.simpleString()
    return encoded.select("doc_id", "ids").mapInArrow(run, f"doc_id {kind}, text string")


def encoding_report(documents: DataFrame, path: str | None = None,
                    threads: int = THREADS) -> DataFrame:
    """doc_id, n_ids, ids_crc32, parity and round_trip of every document."""
    path = path or tokenizer_path(MODEL)

    def run(batches):
        encoder = piece_encoder(path, threads)
        for block in text_blocks(batches):
            ids, ends, parity, round_trip = encoder.encode_block(texts_of(block))
            yield pa.RecordBatch.from_arrays(
                [column_of(block, "doc_id"), pa.array(np.diff(ends), pa.int64()),
                 pa.array([zlib.crc32(ids[a:b]) for a, b in zip(ends[:-1], ends[1:])], pa.int64()),
                 pa.array(parity), pa.array(round_trip)],
                names=["doc_id", "n_ids", "ids_crc32", "parity", "round_trip"])

    kind = documents.schema["doc_id"].dataType.simpleString()
    return documents.select("doc_id", "text").mapInArrow(
        run, f"doc_id {kind}, n_ids bigint, ids_crc32 bigint, parity boolean, round_trip boolean")
