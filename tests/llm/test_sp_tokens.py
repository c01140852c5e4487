import numpy as np
import pytest
from sentencepiece import SentencePieceProcessor

from dailybars.llm import sp_tokens as S
from dailybars.llm.encoding import tokenizer_path

PATH = tokenizer_path(S.MODEL)
ODD = ["", " ", "   ", "a  b ", "  x", "<s> </s> <unk>", "日本語 \n\n\t z", "á é ﬁ", "\x00 \x07", "x" * 5000,
       "🙂 emoji 👩‍👩‍👧", "tab\tline\nend"]


@pytest.fixture(scope="module")
def encoder():
    return S.PieceEncoder(PATH)


def test_parity_with_the_reference_library(encoder, corpus):
    texts = ODD + [t or "" for _, t, _ in corpus]
    sp = SentencePieceProcessor(model_file=PATH)
    for text, (ids, parity, round_trip), expected in zip(texts, encoder.encode(texts), sp.encode(texts)):
        assert np.frombuffer(ids, "<u4").tolist() == expected, text
        assert parity and round_trip


def test_decoding_gives_the_text_back(encoder):
    ids = [np.frombuffer(i, "<u4").tolist() for i, _, _ in encoder.encode(ODD)]
    assert encoder.decode(ids) == ODD


def test_a_literal_marker_is_reported(encoder):
    """It comes back as a blank, and the round trip says so."""
    found = encoder.encode(["a▁b", "a b", "▁", "x ▁ y"])
    assert [r for *_, r in found] == [False, True, False, False]
    assert encoder.decode([np.frombuffer(found[0][0], "<u4").tolist()]) == ["a b"]


def test_threads_change_no_id(corpus):
    texts = ODD + [t or "" for _, t, _ in corpus]
    assert S.THREADS > 1
    assert S.PieceEncoder(PATH, 1).encode(texts) == S.PieceEncoder(PATH, 4).encode(texts)


def test_full_cache_is_emptied(encoder, monkeypatch):
    monkeypatch.setattr(S, "CACHE_ENTRIES", 5)
    fresh = S.PieceEncoder(PATH)
    texts = [f"some words {k} and more" for k in range(20)]
    for _ in range(3):     # also from the old generation, and one text at a time
        for text, expected in zip(texts, fresh.reference.encode(texts)):
            (ids, parity, round_trip), = fresh.encode([text])
            assert np.frombuffer(ids, "<u4").tolist() == expected and parity and round_trip
        texts = texts[::-1]


def test_unigram_model_from_a_model_message():
    """A small Unigram model written by hand in the file's format."""
    def varint(n):
        out = b""
        while True:
            out += bytes([n & 127 | (128 if n > 127 else 0)])
            n >>= 7
            if not n:
                return out

    def block(number, data):
        return varint(number << 3 | 2) + varint(len(data)) + data

    pieces = [("<unk>", 0.0, 2), ("<s>", 0.0, 3), ("</s>", 0.0, 3), ("▁", -3.0, 1), ("a", -3.0, 1),
              ("b", -3.5, 1), ("▁a", -2.0, 1), ("ab", -2.5, 1), ("▁ab", -2.2, 1)]
    data = b"".join(block(1, block(1, p.encode()) + varint(2 << 3 | 5) + np.float32(s).tobytes()
                          + varint(3 << 3) + varint(k)) for p, s, k in pieces)
    data += block(2, varint(3 << 3) + varint(S.UNIGRAM))
    data += block(3, varint(3 << 3) + varint(1) + varint(4 << 3) + varint(1))
    model = S.Model(data)
    assert model.kind == S.UNIGRAM and model.cuttable and model.squeeze and model.dummy_prefix
    normaliser, tokenizer = S.rebuild(model)
    sp = SentencePieceProcessor(model_proto=data)
    for text in ("ab a  b", "aab ", "bab ab", "xa"):
        marked = "▁" + normaliser.normalize_str(text).replace(" ", "▁")
        assert tokenizer.encode(marked, add_special_tokens=False).ids == sp.encode(text)


def test_operator_encodes_and_decodes(make_docs, corpus):
    docs = make_docs(corpus)
    report = S.encoding_report(docs).collect()
    assert len(report) == len(corpus) and all(r.parity and r.round_trip for r in report)
    back = S.decode(S.encode(docs, PATH), PATH).collect()
    key = lambda r: (r[0] is None, r[0] or 0, r[1] or "")
    assert sorted(((r.doc_id, r.text) for r in back), key=key) == sorted(
        ((i, t or "") for i, t, _ in corpus), key=key)
    assert S.encoding_report(make_docs([])).collect() == []


def test_cuts_fall_before_runs_of_markers(encoder):
    texts = ["", "a b", "  a   b ", "▁a▁ b", "   ", "ü 日本\n x"]
    parts, last = encoder.parts(texts)
    assert parts.to_pylist() == [p.encode() for p in (
        " a", " b", "   a", "   b", " ", "  a", "  b", "    ", " ü", " 日本\n", " x")]
    assert last.tolist() == [0, 2, 5, 7, 8, 11]


def test_parts_are_encoded_together_as_alone(encoder, monkeypatch):
    """Parts share an input of the library; bytes, blanks and long parts do not run over."""
    parts = ["▁a", "▁▁▁", "▁日本語", "▁\x00\x07", "▁é🙂é", "▁", "▁<0x41>", "▁" + "x" * 5000, "▁the"]
    alone = [encoder.tokenizer.encode(p, add_special_tokens=False).ids for p in parts]
    for size in (1, 2, 4, 100):
        monkeypatch.setattr(S, "LEARN_PARTS", size)
        assert encoder._ids(parts) == alone
    monkeypatch.setattr(encoder, "covers", None)
    assert encoder._ids(parts) == alone


def test_one_call_of_the_library_for_many_new_parts(monkeypatch):
    """Copies of a part are looked up and encoded once, new ones by the thousand."""
    fresh, calls = S.PieceEncoder(PATH), []

    class Counted:
        def __init__(self, tokenizer):
            self.tokenizer = tokenizer

        def encode_batch_fast(self, inputs, **more):
            calls.append([len(i) for i in inputs])
            return self.tokenizer.encode_batch_fast(inputs, **more)

    fresh.tokenizer = Counted(fresh.tokenizer)
    texts = [f"w{k} w{k + 1} again" for k in range(1500)] * 2
    expected = fresh.reference.encode(texts)
    assert [np.frombuffer(i, "<u4").tolist() for i, _, _ in fresh.encode(texts)] == expected
    assert calls == [[1000, 502]]
    fresh.encode(texts)
    assert len(calls) == 1


def test_parity_of_the_documents_that_hold_a_part(encoder, monkeypatch):
    monkeypatch.setattr(encoder, "unequal", {b" bad"})
    found = encoder.encode(["good", "", "so bad it is", "badly", "bad bad"])
    assert [p for _, p, _ in found] == [True, True, False, True, False]


def test_decoding_replaces_markers_but_not_those_made_of_bytes(encoder):
    ids = [encoder.tokenizer.token_to_id(f"<0x{b:02X}>") for b in "▁é".encode()]
    the = encoder.tokenizer.token_to_id("▁the")
    assert encoder.decode([[the, the, *ids], [*ids, the]]) == ["the the▁é", "▁é the"]
    assert encoder.speaker.decode_batch([[the, *ids]]) == encoder.tokenizer.decode_batch([[the, *ids]])
