"""Decontamination against plain loops."""

import hashlib
import random
import re

import pytest

from textmill.llm import decontaminate as d

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(text, items):
    w, hit, names = words(text), set(), set()
    for name, item in items:
        v = words(item)
        n = min(10, len(v))
        for k in range(len(v) - n + 1 if n else 0):
            for i in range(len(w) - n + 1):
                if w[i : i + n] == v[k : k + n]:
                    hit.update(range(i, i + n))
                    names |= {str(name)} if name is not None else set()
    digest = hashlib.sha256(",".join(sorted(names)).encode()).hexdigest()
    return len(w), len(hit), len(names), digest, bool(hit)


RNG = random.Random(2)
VOCABULARY = [f"w{k}" for k in range(30)] + ["é", "Ünder"]
ITEMS = [(k, " ".join(RNG.choices(VOCABULARY, k=n))) for k, n in enumerate([15, 12, 10, 9, 4, 0, 30])]
ITEMS += [(10, ITEMS[0][1].upper()), (None, ITEMS[1][1]), (11, None), (12, "..."), (0, "other words of item nought")]


def documents():
    rows = [(0, None), (1, ""), (2, "nothing here"), (3, "x " * 50_000)]
    for i in range(4, 60):
        parts = [" ".join(RNG.choices(VOCABULARY, k=RNG.randrange(40)))]
        if i % 3 == 0:
            item = (RNG.choice(ITEMS)[1] or "").split()
            start = RNG.randrange(4)
            parts.append(", ".join(item[start : start + 25]))
        parts.append("-".join(RNG.choices(VOCABULARY, k=RNG.randrange(20))))
        rows.append((i, " | ".join(parts)))
    return rows + [(4, rows[4][1]), (None, rows[6][1])]


@pytest.mark.parametrize("limit", [d.LIMIT_BYTES, 150])
def test_hits_equal_plain_loops(spark, frame, clashing, limit):
    rows = documents()
    benchmark = spark.createDataFrame(ITEMS, "item_id long, text string")
    got = d.find(clashing(frame(rows)), benchmark, limit_bytes=limit).collect()
    want = sorted([(i, *brute(t, ITEMS)) for i, t in rows], key=str)
    assert sorted(map(tuple, got), key=str) == want
    assert any(r.contaminated for r in got)


@pytest.mark.parametrize("limit", [d.LIMIT_BYTES, 150])
def test_removed_spans_leave_no_hit(spark, frame, clashing, limit):
    benchmark = spark.createDataFrame(ITEMS, "item_id long, text string")
    rows = documents()
    docs = clashing(frame(rows))
    cut = d.remove_spans(docs, benchmark, limit_bytes=limit)
    assert cut.columns == docs.columns
    got = cut.collect()
    assert len(got) == len(rows) and not any(brute(r.text, ITEMS)[4] for r in got)
    clean = {i: t for i, t in rows if not brute(t, ITEMS)[4]}
    assert all(r.text == clean[r.doc_id] for r in got if r.doc_id in clean)


def test_what_a_cut_joins_is_cut_too(spark, frame):
    benchmark = spark.createDataFrame([(1, "a b c d e f g h i j"), (2, "x y z")], "item_id long, text string")
    docs = frame([(1, "keep a b c d e x y z f g h i j this")])
    assert d.remove_spans(docs, benchmark).first().text.split() == ["keep", "this"]


def test_empty_tables(spark, frame):
    none = spark.createDataFrame([], "item_id long, text string")
    assert d.find(frame([]), none).isEmpty()
    assert not d.find(frame([(1, "a b")]), none).first().contaminated
