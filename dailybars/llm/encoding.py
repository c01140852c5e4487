"""Token ids of whole texts by a tokenizers-library file, with a word cache.

The file must describe a tokenizer that drops white space and cuts words where
``word_bpe_49k.json`` does. A text is cut at blanks, tabs and line ends; what
stands between is looked up in a cache that each Python worker keeps, and
encoded by the library when it is new. Plain words inside a piece are cached
on their own, so junk glued to a word does not defeat the cache. Anything out
of the ordinary (controls, letters beyond U+024F, special tokens) goes to the
library as it is.
"""

from __future__ import annotations

import os
from array import array
from functools import lru_cache

import regex

CACHE_ENTRIES = 150_000    # of each of the two generations of a cache
_PLAIN = regex.compile(r"[!-~¡-ɏ]+")
_WORDS = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\s\p{L}\p{N}]+")


def tokenizer_path(name: str) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def _byte_characters() -> dict[int, str]:
    """The characters that stand for bytes in a byte-level vocabulary: printable
    Latin-1 for itself, the other bytes from U+0100 on."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in printable]
    return {b: chr(b) for b in printable} | {b: chr(256 + k) for k, b in enumerate(others)}


class _Cache(dict):
    """A bounded cache in two generations: a full one becomes the old one, from
    which entries still in use move over."""

    def __init__(self):
        self.old: dict[str, bytes] = {}

    def __missing__(self, key: str) -> bytes:
        if len(self) >= CACHE_ENTRIES:
            self.old = dict(self)
            self.clear()
        found = self.old.get(key)
        if found is None:
            found = self.encode(key)
        self[key] = found
        return found


class _Words(_Cache):
    """Ids of single words (as the tokenizer cuts them) by its model alone."""

    def __init__(self, tokenizer):
        super().__init__()
        self.model = tokenizer.model
        # Latin-1 decoding gives one character per byte of the UTF-8 text.
        self.to_bytes = str.maketrans(_byte_characters())

    def encode(self, word: str) -> bytes:
        text = word.encode("utf-8").decode("latin-1").translate(self.to_bytes)
        return array("I", [t.id for t in self.model.tokenize(text)]).tobytes()


class _Pieces(_Cache):
    """Ids of what stands between blanks."""

    def __init__(self, tokenizer):
        super().__init__()
        self.tokenizer, self.words = tokenizer, _Words(tokenizer)

    def encode(self, piece: str) -> bytes:
        if not piece:
            return b""
        if _PLAIN.fullmatch(piece) and "<|" not in piece:
            words = self.words
            return b"".join([words[w] for w in _WORDS.findall(piece.lower())])
        ids = self.tokenizer.encode(piece, add_special_tokens=False).ids
        return array("I", ids).tobytes()


class Encoder:
    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer
        self.pieces = _Pieces(Tokenizer.from_file(path))

    def ids(self, text: str) -> bytes:
        """The text's ids as unsigned 32-bit numbers."""
        flat = text.replace("\n", " ").replace("\t", " ").replace("\r", " ")
        return b"".join(map(self.pieces.__getitem__, flat.split(" ")))


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """The worker's encoder of a file."""
    return Encoder(path)
