"""Packing: ids against whole texts, windows against a plain best fit, sequences put together again."""

import random
import zlib

import pyarrow as pa
import pytest

from textmill.llm import packing as pk

public_tokenizers = pytest.importorskip("public_tokenizers")
PATH = public_tokenizers.path("word_bpe_49k.json")
TEXTS = [
    None, "", " \n\t", "Hello, hello world! It's 12:30 -- don't WE'LL ?'s x..1a2--b", "é" * 30, "ÉTÉ été Straße ÀÿØ×÷", "áb c",
    "<|endoftext|> a <|ENDOFTEXT|>b<|startoftext|>", "   a 中文 ab中 🧡x", "word " * 6_000, "x" * 20_000, "Ends in a blank ",
]


def whole(texts):
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(PATH)
    return [plain.encode(t or "", add_special_tokens=False).ids + [pk.END_ID] for t in texts]


def test_ids_equal_those_of_whole_texts(monkeypatch):
    want = whole(TEXTS)
    for remembered in (1 << 19, 0):
        monkeypatch.setattr(pk, "REMEMBERED", remembered)
        encoder = pk.Encoder(PATH)
        for texts in (TEXTS, TEXTS[::-1], TEXTS[:3], []):
            ids, offsets = encoder.encode(pa.array(texts, pa.string()))
            got = [ids[a:b].tolist() for a, b in zip(offsets[:-1], offsets[1:])]
            assert got == (want if texts is TEXTS else whole(texts))


def plain_best_fit(sizes, window):
    rooms = []
    for size in sorted(sizes, reverse=True):
        fits = [room for room in rooms if room >= size]
        if fits:
            rooms.remove(min(fits))
        rooms.append((min(fits) if fits else window) - size)
    return sorted(rooms)


def test_windows_equal_a_plain_best_fit():
    rng = random.Random(1)
    for _ in range(300):
        sizes = [rng.randint(1, 64) for _ in range(rng.randint(0, 60))]
        found = pk.best_fit(sizes, 64)
        assert sorted(i for w in found for i in w) == list(range(len(sizes)))
        assert sorted(64 - sum(sizes[i] for i in w) for w in found) == plain_best_fit(sizes, 64)


def test_powers_of_two():
    for total in range(0, 300):
        lengths = pk.powers_of_two(total, 64)
        assert sum(lengths) == total and all(n & (n - 1) == 0 for n in lengths)


@pytest.mark.parametrize("held", [1 << 25, 4_000])
@pytest.mark.parametrize("window", [pk.WINDOW, 16])
def test_pieces_give_the_documents_back(frame, clashing, window, held):
    texts = TEXTS + ["a short text"] * 200 + ["some words of a longer document " * 40] * 20
    rows = list(enumerate(texts)) + [(3, texts[3]), (None, "no id")]
    got = pk.pack(clashing(frame(rows)), PATH, window=window, held_bytes=held).collect()
    ids = dict(enumerate(whole(texts)))
    documents, sequences = {}, {}
    for r in got:
        assert len(r.ids) == 4 * r.length and 0 < r.length <= window
        documents.setdefault(r.id, []).append((r.start, r.ids, r.doc_tokens))
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for key, want in ids.items():
        copies = 2 if key == 3 else 1
        pieces = sorted(documents[key])
        assert sum(len(p[1]) for p in pieces) == 4 * len(want) * copies and {p[2] for p in pieces} == {len(want)}
        for start, part, _ in pieces:
            assert [int.from_bytes(part[i : i + 4], "little") for i in range(0, len(part), 4)] == want[start : start + len(part) // 4]
    assert None in documents
    padding = 0
    for pieces in sequences.values():
        end = 0
        for offset, length in sorted(pieces):
            assert offset == end
            end += length
        assert end <= window
        padding += 0 if end & (end - 1) == 0 else window - end
    assert padding <= 0.1 * sum(len(r.ids) for r in got) / 4


def test_digest_of_ids(spark, frame):
    from pyspark.sql import functions as F

    got = pk.pack(frame([(1, "one two three")]), PATH).select(F.crc32("ids").alias("crc")).first().crc
    assert got == zlib.crc32(b"".join(i.to_bytes(4, "little") for i in whole(["one two three"])[0]))


def test_empty_table(frame):
    assert pk.pack(frame([]), PATH).isEmpty()
