"""Repeated substrings against counting every window."""

import collections
import hashlib
import pathlib
import random

import numpy as np
import pytest

from textmill.llm import suffix_dedup as s


def brute(texts):
    texts = [(t or "").encode() for t in texts]
    seen = collections.Counter(t[i : i + 400] for t in texts for i in range(len(t) - 399))
    out = []
    for t in texts:
        gone = np.zeros(len(t), bool)
        for i in range(len(t) - 399):
            if seen[t[i : i + 400]] > 1:
                gone[i : i + 400] = True
        kept = bytes(np.frombuffer(t, np.uint8)[~gone])
        out.append((len(t), int(gone.sum()), len(s._runs(gone)) // 2, hashlib.sha256(kept).hexdigest()))
    return out


RNG = random.Random(8)


def noise(n, alphabet="abcdefghijklmnopqrstuvwxyz éß"):
    return "".join(RNG.choices(alphabet, k=n))


def fixture():
    passage, twin = noise(900), noise(1500)
    edited = list(twin)
    for k in (100, 700, 720, 1200):
        edited[k] = "#"
    exact = noise(400, "abc")
    texts = [noise(700) + passage[: RNG.randrange(380, 900)] + noise(RNG.randrange(900)) for _ in range(12)]
    texts += [twin, "".join(edited), twin[:1000], noise(50) + twin[300:], twin, twin]
    texts += [exact + "x", "y" + exact, exact[:399] + "!", "!" + exact[1:], exact]
    texts += ["a" * 2_000, "a" * 399, "ab" * 900, passage + passage, None, "", "é" * 300, noise(60_000) + passage]
    return texts + [noise(3000, "ab") for _ in range(3)]


@pytest.mark.parametrize("most, block", [(1_000, 1 << 20), (0, 1 << 20), (4, 2_000)])
def test_spans_equal_counting(frame, clashing, monkeypatch, most, block):
    monkeypatch.setattr(s, "GROUP_PIECES", most)
    monkeypatch.setattr(s, "BLOCK_BYTES", block)
    texts = fixture()
    got = {r.id: tuple(r)[1:] for r in s.find(clashing(frame(list(enumerate(texts))))).collect()}
    assert [got[i] for i in range(len(texts))] == brute(texts)


@pytest.mark.parametrize("share", [1, 3, 500])
def test_places_of_hot_pieces_are_dealt_to_tasks(spark, monkeypatch, share):
    monkeypatch.setattr(s, "HOT_SHARE", share)
    key = "anchor long, piece long"
    places = [(0, 0, t) for t in range(60)] + [(k, k % 3, k) for k in range(1, 40)] + [(0, 1, 7)]
    runs = [(0, 0, [1, 2]), (5, 2, [3, 4]), (0, 1, [5, 6]), (99, 0, [7, 8])]
    counts = [(a, b, sum(p[:2] == (a, b) for p in places)) for a, b in sorted({p[:2] for p in places})]
    joined = s._with_runs(
        spark.createDataFrame(places, f"{key}, t long"),
        spark.createDataFrame(runs, f"{key}, runs array<int>"),
        spark.createDataFrame(counts, f"{key}, n long"),
    )
    want = sorted((a, b, t, r) for a, b, t in places for x, y, r in runs if (a, b) == (x, y))
    assert sorted((r.anchor, r.piece, r.t, r.runs) for r in joined.collect()) == want


def test_whole_table_of_documents(spark):
    folder = "/root/testdata/sf0.001"
    if not pathlib.Path(folder).exists():
        pytest.skip("no test tables")
    rows = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text")
    got = {r.id: tuple(r)[1:] for r in s.find(rows).collect()}
    rows = rows.collect()
    assert [got[r.doc_id] for r in rows] == brute([r.text for r in rows])


def test_many_text_hashes_are_joined_by_shuffle(frame, monkeypatch):
    monkeypatch.setattr(s, "BROADCAST_ROWS", 0)
    texts = fixture()
    got = {r.id: tuple(r)[1:] for r in s.find(frame(list(enumerate(texts)))).collect()}
    assert [got[i] for i in range(len(texts))] == brute(texts)


def test_repeated_rows_and_empty_table(frame):
    text = noise(500)
    got = s.find(frame([(1, text), (1, text), (None, text)])).collect()
    assert [r.n_removed for r in got] == [len(text.encode())] * 3
    assert s.find(frame([])).isEmpty()


def test_long_prefixes_equal_direct_comparison():
    rng = np.random.default_rng(2)
    for least in (1, 2, 5):
        symbols = np.concatenate([rng.integers(1, 4, 60), np.tile([1, 2, 3, 1], 8), [0]])
        assert symbols.max() < len(symbols)
        order, long = s.long_prefixes(symbols, least)
        suffixes = [tuple(symbols[i:]) for i in order]
        assert suffixes == sorted(suffixes)
        want = [a[:least] == b[:least] and min(len(a), len(b)) >= least for a, b in zip(suffixes, suffixes[1:])]
        assert long.tolist() == want
