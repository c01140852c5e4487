"""Fill-in-the-middle transformation with piece tables.

A document is a list of descriptors (buffer, start, stop) over two immutable
buffers: its own text, which stays where Arrow put it, and the sentinels. The
text is one descriptor at first. Cutting at line ends splits descriptors, the
sentinels are descriptors of their own, and an arrangement is a permutation of
the list. Digests and texts are made by streaming the descriptors' bytes, so a
text is never cut into strings.

Restoring starts from the written output and its form alone: the sentinels are
found again, which gives the same descriptors over the output's buffer, and the
inverse permutation without the sentinels is the text. A text that holds a
sentinel stays plain, so the sentinels of an output are its own.

The draws (cut places, form) come from a SHA-256 of the seed and the document's
id, so they survive retries, repartitioning and new runs.

Defined results: a NULL text is empty and stays plain with no line; a NULL id
draws as the empty id; repeated rows are transformed alike, one by one; a text
without a line end is one line; lines end at U+000A only; very long texts are
scanned in pieces of ``_SCAN`` bytes; an empty table gives an empty result;
only the id and text columns are read, so extra columns do not matter.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import column_of, text_blocks

PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
SENTINELS = PREFIX + SUFFIX + MIDDLE
PLAIN, PSM, SPM = "plain", "psm", "spm"
SEED = 7
RATE = 100          # of 100 documents, those that are rearranged
SPM_SHARE = 50      # of 100 rearranged documents, those in suffix-first form

# What each place of an output holds. A sentinel stands for itself, a part is
# named by its number in the text: 0 prefix, 1 middle, 2 suffix.
ARRANGEMENTS = {
    PSM: (PREFIX, 0, SUFFIX, 2, MIDDLE, 1),
    SPM: (SUFFIX, 2, PREFIX, 0, MIDDLE, 1),
}
_ANY_SENTINEL = re.compile(b"<[PSM]>")
_SCAN = 1 << 20


class PieceTable:
    """Descriptors over an immutable text buffer and the sentinel buffer."""

    def __init__(self, text) -> None:
        self.buffers = (memoryview(text), memoryview(SENTINELS))
        self.pieces = [(0, 0, len(self.buffers[0]))]

    def cut(self, places: list[int]) -> None:
        """Split the one piece of a fresh table at ascending byte offsets."""
        (buffer, start, stop), = self.pieces
        ends = [start, *places, stop]
        self.pieces = [(buffer, a, b) for a, b in zip(ends[:-1], ends[1:])]

    def arrange(self, order: tuple) -> None:
        """Permute the pieces; a sentinel in the order is a piece of its own."""
        at = {s: SENTINELS.index(s) for s in (PREFIX, SUFFIX, MIDDLE)}
        self.pieces = [self.pieces[p] if isinstance(p, int) else (1, at[p], at[p] + len(p))
                       for p in order]

    def recover(self, order: tuple) -> None:
        """Undo ``arrange`` on the table of a whole output: find the sentinels
        in their order, keep the parts between them, and put them back."""
        text, begin, found = self.buffers[0], 0, []
        for sentinel in order[::2]:
            hit = re.compile(re.escape(sentinel)).search(text, begin)
            if hit is None:
                raise ValueError(f"output lacks the sentinel {sentinel.decode()}")
            found.append(hit.span())
            begin = hit.end()
        starts = [b for _, b in found]
        stops = [*(a for a, _ in found[1:]), len(text)]
        parts = dict(zip(order[1::2], zip(starts, stops)))
        self.pieces = [(0, *parts[p]) for p in sorted(parts)]

    def stream(self) -> Iterator[memoryview]:
        for buffer, start, stop in self.pieces:
            yield self.buffers[buffer][start:stop]

    def digest(self) -> str:
        sha = hashlib.sha256()
        for part in self.stream():
            sha.update(part)
        return sha.hexdigest()

    def content(self) -> bytes:
        return b"".join(self.stream())


def _scan(text) -> Iterator[tuple[int, np.ndarray]]:
    data = np.frombuffer(text, dtype=np.uint8)
    for start in range(0, len(data), _SCAN):
        yield start, data[start: start + _SCAN]


def line_count(text) -> int:
    """Lines, each with its line end; a last one without an end counts too."""
    size = len(text)
    if not size:
        return 0
    ends = sum(int(np.count_nonzero(part == 10)) for _, part in _scan(text))
    return ends + (text[size - 1] != 10)


def line_offsets(text, lines: list[int]) -> list[int]:
    """Byte offset after so many lines, for ascending numbers of lines."""
    found, seen, wanted = [], 0, list(lines)
    while wanted and wanted[0] == 0:
        found.append(0)
        wanted.pop(0)
    for start, part in _scan(text):
        if not wanted:
            break
        ends = np.flatnonzero(part == 10)
        while wanted and wanted[0] <= seen + len(ends):
            found.append(start + int(ends[wanted.pop(0) - seen - 1]) + 1)
        seen += len(ends)
    return found + [len(text)] * len(wanted)


def code_points(text) -> int:
    return sum(int(np.count_nonzero((part & 0xC0) != 0x80)) for _, part in _scan(text))


def transform(text, draws: tuple[int, int, int, int], rate: int = RATE,
              spm_share: int = SPM_SHARE) -> tuple[PieceTable, int, str, int | None, int | None]:
    """Table of the output, lines, form and code points of prefix and middle."""
    table, n = PieceTable(text), line_count(text)
    h1, h2, h3, h4 = draws
    if not n or _ANY_SENTINEL.search(table.buffers[0]) or h3 % 100 >= rate:
        return table, n, PLAIN, None, None
    form = SPM if h4 % 100 < spm_share else PSM
    table.cut(line_offsets(text, sorted((h1 % (n + 1), h2 % (n + 1)))))
    prefix, middle, _ = table.stream()
    sizes = code_points(prefix), code_points(middle)
    table.arrange(ARRANGEMENTS[form])
    return table, n, form, *sizes


def restore(output, form: str) -> PieceTable:
    """Table of the text, from an output and its form."""
    table = PieceTable(output)
    if form != PLAIN:
        table.recover(ARRANGEMENTS[form])
    return table


def _views(column: pa.Array) -> list[memoryview]:
    """The values of a string or binary column where they lie; NULL is empty."""
    if pa.types.is_string(column.type):
        column = column.view(pa.binary())
    return [memoryview(v.as_buffer()) if v.is_valid else memoryview(b"") for v in column]


def _strings(values: list[bytes]) -> pa.Array:
    return pa.array(values, pa.binary()).view(pa.string())


def draws(seed: int = SEED, doc_id: str = "doc_id") -> F.Column:
    """The four draws of a document."""
    name = F.coalesce(F.col(doc_id).cast("string"), F.lit(""))
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), name), 256)
    return F.array(*[F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("bigint")
                     for k in range(4)])


def fill_in_middle(documents: DataFrame, seed: int = SEED, rate: int = RATE,
                   spm_share: int = SPM_SHARE) -> DataFrame:
    """doc_id, n, form, prefix_chars, middle_chars, output (the text to train
    on) and output_sha256 of every document."""
    def run(batches):
        for block in text_blocks(batches):
            tables, n, forms, prefix, middle = [], [], [], [], []
            for text, drawn in zip(_views(column_of(block, "text")),
                                   column_of(block, "draws").to_pylist()):
                made = transform(text, drawn, rate, spm_share)
                for out, value in zip((tables, n, forms, prefix, middle), made):
                    out.append(value)
            yield pa.RecordBatch.from_arrays(
                [column_of(block, "doc_id"), pa.array(n, pa.int64()), pa.array(forms, pa.string()),
                 pa.array(prefix, pa.int64()), pa.array(middle, pa.int64()),
                 _strings([t.content() for t in tables]),
                 pa.array([t.digest() for t in tables], pa.string())],
                names=["doc_id", "n", "form", "prefix_chars", "middle_chars", "output",
                       "output_sha256"])

    kind = documents.schema["doc_id"].dataType.simpleString()
    return documents.select("doc_id", draws(seed).alias("draws"), "text").mapInArrow(
        run, f"doc_id {kind}, n bigint, form string, prefix_chars bigint, middle_chars bigint, "
             "output string, output_sha256 string")


def restored(outputs: DataFrame, digest_only: bool = False) -> DataFrame:
    """The columns of ``outputs`` but its output, with the text rebuilt from
    output and form (or only its ``restored_sha256``)."""
    last = "restored_sha256" if digest_only else "text"
    kept = [c for c in outputs.columns if c != "output"]

    def run(batches):
        for block in text_blocks(batches, "output"):
            tables = [restore(o, f) for o, f in zip(_views(column_of(block, "output")),
                                                    column_of(block, "form").to_pylist())]
            rebuilt = (pa.array([t.digest() for t in tables], pa.string()) if digest_only
                       else _strings([t.content() for t in tables]))
            yield pa.RecordBatch.from_arrays([*(column_of(block, c) for c in kept), rebuilt],
                                             names=[*kept, last])

    schema = outputs.select(*kept).schema.add(last, "string")
    return outputs.mapInArrow(run, schema)


def round_trip(documents: DataFrame) -> DataFrame:
    """doc_id, n, form, prefix_chars, middle_chars and the digests of every
    document's output and of the text rebuilt from it."""
    return restored(fill_in_middle(documents), digest_only=True).select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars", "output_sha256",
        "restored_sha256")
