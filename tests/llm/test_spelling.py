"""Spelling variants: the composed acceptor, partitions and whole results against plain loops."""

import random
import re
import zlib
from collections import Counter

import pytest

from textmill.llm import spelling as sp


def near(a, b):
    a, b = sorted((a, b), key=len)
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def test_pairs_equal_a_loop():
    rng = random.Random(1)
    for _ in range(300):
        words = sorted({"".join(rng.choice("abc") for _ in range(rng.randint(0, 6))) for _ in range(rng.randint(0, 60))})
        got = sorted(tuple(sorted(p)) for p in sp.OneEdit(sp.Acceptor(words)).pairs())
        assert got == sorted((a, b) for i, a in enumerate(words) for b in words[i + 1 :] if near(a, b))


def test_the_acceptor_is_minimal():
    words = sorted(a + b + c for a in "abc" for b in "xy" for c in ("ing", "ed", ""))
    acceptor = sp.Acceptor(words)
    assert sum(1 for arcs, final in zip(acceptor.arcs, acceptor.final) if arcs or final) == 7  # start, a-c, xy, i, n, e, end


def test_very_long_words():
    long = ["x" * 50_000 + "a" + "y" * 50_000, "x" * 50_000 + "b" + "y" * 50_000, "x" * 50_000 + "y" * 50_000]
    assert len(list(sp.OneEdit(sp.Acceptor(sorted(long))).pairs())) == 3


def expected_words(rows):
    found = Counter()
    for key, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if key is None else key}:{run}".encode())
            at = h % len(run)
            found[run[:at] + run[at + 1 :] if h % 31 == 0 else run] += 1
    return {w: n for w, n in found.items() if len(w) >= 7 and n >= 2}


def expected(words):
    out = {}
    for word, n in words.items():
        others = [w for w in words if abs(len(w) - len(word)) < 2 and near(word, w)]
        best = min(others, key=lambda w: (-words[w], w), default=None)
        out[word] = [best if best and words[best] >= 10 * n else None, None, n, len(others)]
    for word, row in out.items():
        row[1] = word
        while out[row[1]][0]:
            row[1] = out[row[1]][0]
    return {w: (f, r, n, k, words[f] if f else None) for w, (f, r, n, k) in out.items()}


@pytest.mark.parametrize("most", [sp.PARTITION_SYMBOLS, 200, 1])
def test_variants_equal_a_loop(spark, most):
    rng = random.Random(2)
    words = {"".join(rng.choice("ab") for _ in range(rng.randint(7, 9))): rng.choice([2, 3, 25, 300, 4_000]) for _ in range(250)}
    words |= {"préfix" + "".join(rng.choice("cdé") for _ in range(rng.randint(1, 4))): rng.choice([2, 21, 210]) for _ in range(60)}
    df = spark.createDataFrame(list(words.items()), "word string, n long").repartition(4)
    got = {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in sp.group_variants(df, most=most).collect()}
    assert got == expected(words)


def test_whole_texts(frame, clashing):
    rng = random.Random(3)
    stems = ["".join(rng.choice("abcdéø") for _ in range(rng.randint(6, 10))) for _ in range(40)]
    texts = [None, "", "short words only", "ab×cdéfgh ABCDEFÉ abcdefÉ" * 2]
    texts += [" ".join(rng.choice(stems).capitalize() for _ in range(300)) + " " + "z" * 3_000 for _ in range(20)]
    rows = list(enumerate(texts)) + [(7, texts[7]), (None, texts[8])]
    got = {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in sp.find(clashing(frame(rows))).collect()}
    assert got == expected(expected_words(rows)) and len(got) > 40


def test_empty_table(frame):
    assert sp.find(frame([])).isEmpty()
