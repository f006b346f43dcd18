"""Personal data: patterns against the plain regular expressions, the tagger on held-out and made examples."""

import collections
import hashlib
import random
import re

import numpy as np
import pytest

from textmill.llm import pii, tagger
from textmill.llm.queries import QUERIES

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def plain(text):
    digits = lambda m: re.sub("[^0-9]", "", m.group())

    def luhn(d):
        total = 0
        for k, c in enumerate(reversed(d)):
            n = int(c) * (2 if k % 2 else 1)
            total += n - 9 if n > 9 else n
        return total % 10 == 0

    out = [("email", *m.span()) for m in EMAIL.finditer(text)]
    out += [("ip", *m.span()) for m in IP.finditer(text) if all(int(p) <= 255 for p in m.group().split("."))]
    out += [("card", *m.span()) for m in CARD.finditer(text) if 13 <= len(digits(m)) <= 19 and luhn(digits(m))]
    out += [("phone", *m.span()) for m in PHONE.finditer(text) if 9 <= len(digits(m)) <= 15]
    return out


def test_patterns_equal_regular_expressions():
    rng = random.Random(1)
    pieces = ["1.2.3.4", "1.2.3.4.5.6.7.8", "999.1.1.1", "a@b.c", "a.b+c@d-e.f.g", "@", "..@x.y", "4111 1111 1111 1111", "0255.1.1.1"]
    pieces += ["+1 (319) 555-5132", "+", "é", "語", "x_y@z.w_v@u.t", "4111-1111-1111-1112", "00000000000000", " ", "-", ".", "7", "\n"]
    for _ in range(3000):
        text = "".join(rng.choice(pieces) + rng.choice(["", " ", "1", "."]) for _ in range(rng.randrange(9)))
        assert pii.base_spans(text) == plain(text), text


def test_long_runs_are_quick():
    for text in ("1" * 200_000, "a" * 200_000 + " @ 1", "1." * 100_000, "+1" * 100_000, "@1" * 100_000):
        pii.base_spans(text)


@pytest.fixture(scope="module")
def model(frame):
    return pii.fit(frame([]), made=3_000)


def test_tagger_on_held_out_examples(model):
    x, y = pii._training_windows(pii.made_examples(300, 12345))
    labels, sure = tagger.decode(model, x)
    assert (labels == y).all(axis=1).mean() > 0.9 and (sure <= 1.001).all()


def test_added_spans_stand_beside_base_ones(model):
    texts = ["", "x" * 500, "see (319) 555-5132 for it. " + "word " * 50 + "mail a@b.example.com or +1 (626) 555-5759 now"]
    found = pii.all_spans(model, texts)
    assert found[0] == ([], []) and found[1] == ([], [])
    base, spans = found[2]
    assert base == plain(texts[2]) and set(base) <= set(spans)
    for kind, start, end in set(spans) - set(base):
        assert all(end <= b[1] or start >= b[2] for b in base)
    assert pii.masked("a b@c.d e", [("email", 2, 7)]) == "a [EMAIL] e"
    assert pii.masked("0123456789", [("card", 2, 6), ("phone", 4, 8)]) == "01[CARD]89"


def test_gradient_is_that_of_the_loss():
    p = {k: v.astype(float) for k, v in tagger.new_parameters(6, 3, 3, 4, 1).items()}
    rng = np.random.default_rng(0)
    x, y = rng.integers(0, 6, (2, 7)), rng.integers(0, 3, (2, 7))
    _, grad = tagger.loss_and_gradient(p, x, y)
    for name in p:
        at = np.unravel_index(np.abs(grad[name]).argmax(), grad[name].shape)
        step = {k: v.copy() for k, v in p.items()}
        step[name][at] += 1e-3
        up = tagger.loss_and_gradient(step, x, y)[0]
        step[name][at] -= 2e-3
        down = tagger.loss_and_gradient(step, x, y)[0]
        assert abs((up - down) / 2e-3 - grad[name][at]) < 2e-3 * max(1, abs(grad[name][at]))


def test_find_and_mask(frame, clashing, monkeypatch):
    monkeypatch.setattr(pii, "EPOCHS", 1)
    monkeypatch.setattr(pii.fit, "__defaults__", (20, 50, 1))
    rows = [(0, None), (1, ""), (2, "mail a@b.cd."), (2, "mail a@b.cd."), (None, "+1 234 567 8901"), (3, "w " * 40_000 + "1.2.3.4")]
    docs = clashing(frame(rows))
    got = {(r.id, tuple(r.base)) for r in pii.find(docs).collect()}
    assert got == {(0, ()), (1, ()), (2, ("email:5:11",)), (None, ("phone:0:15",)), (3, ("ip:80000:80007",))}
    masked = pii.mask(docs)
    assert masked.columns == docs.columns
    texts = {r.doc_id: r.text for r in masked.collect()}
    assert texts[0] is None and texts[2] == "mail [EMAIL]." and texts[None] == "[PHONE]" and "1.2.3.4" not in texts[3]
    assert pii.find(frame([])).isEmpty() and pii.mask(frame([])).isEmpty()


def test_very_long_runs_of_digits():
    zeros = "0" * 5_000
    assert pii.base_spans(f"{zeros}.1.1.1") == [("ip", 0, 5_006)]
    assert pii.base_spans("9" * 5_000 + ".1.1.1") == []
    assert pii.base_spans(f"{zeros}1.{zeros}.{zeros}256.1") == []


def test_windows_with_spelled_out_signs_are_decoded():
    assert pii._window_starts("write to jane [at] example [dot] com") == [0]
    assert pii._window_starts("\uff10\uff11\uff12") == [0] and pii._window_starts("at the dot") == []


def test_query_counts_each_kind(spark, tmp_path):
    """The registered query against the plain regular expressions: every exact column."""
    texts = ["mail a@b.co or x.y@z.example.org", "1.2.3.4 and 5.6.7.8 and 999.1.1.1", "4111 1111 1111 1111"]
    texts += ["call +1 (319) 555-5132", "😀 a@b.co, 1.2.3.4, 4111-1111-1111-1111, +1 (319) 555-5132", "no such thing", "", None]
    rows = [*enumerate(texts), (None, texts[4]), (1, texts[1])]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")

    def want(text):
        spans = plain(text or "")
        counts = [sum(s[0] == kind for s in spans) for kind in ("email", "ip", "card", "phone")]
        return *counts, hashlib.sha256(",".join(f"{k}:{a}:{z}" for k, a, z in spans).encode()).hexdigest()

    got = QUERIES["op9_pii"](spark, str(tmp_path)).drop("spans").collect()
    assert collections.Counter(map(tuple, got)) == collections.Counter((i, *want(text)) for i, text in rows)
    assert want(texts[4])[:4] == (1, 1, 1, 1)


def by_all_windows(model, text, sure):
    """Spans by decoding every window and reading the labels one by one."""
    size, half = len(text), pii.WINDOW // 2
    starts = [0]
    while starts[-1] + pii.WINDOW < size:
        starts.append(starts[-1] + half)
    rows = np.zeros((len(starts), pii.WINDOW), np.int64)
    for row, start in zip(rows, starts):
        part = pii.symbols(text)[start : start + pii.WINDOW]
        row[: len(part)] = part
    labels, trust = tagger.decode(model, rows)
    middle = lambda place, k: min(place - starts[k] if k else size, starts[k] + pii.WINDOW - 1 - place if k + 1 < len(starts) else size)
    out, now = [], None
    for place in [*range(size), None]:
        label = 0
        if place is not None:
            k = max((k for k in range(len(starts)) if starts[k] <= place < starts[k] + pii.WINDOW), key=lambda k: (middle(place, k), k))
            label, sureness = int(labels[k, place - starts[k]]), float(trust[k, place - starts[k]])
        kind = (label + 1) // 2
        if now and (kind != now[0] or label % 2 == 1):
            out.append(now)
            now = None
        if label % 2 == 1:
            now = [kind, place, place, 1.0]
        if now:
            now[2], now[3] = place + 1, min(now[3], sureness)
    marks = [m.start() for m in pii._MARK.finditer(text)]
    return [(pii.KINDS[k - 1], a, z) for k, a, z, worst in out if worst >= sure and any(a <= m < z for m in marks)]


def test_marked_windows_give_what_all_windows_give():
    """Also for spans that reach beyond the windows of their marks."""
    rng = random.Random(3)
    eager = tagger.new_parameters(pii._N_SYMBOLS, pii._N_LABELS, pii._WIDTH, pii._HIDDEN, 2)
    for begin in range(1, 9, 2):  # spans begin seldom and end seldom
        eager["move"][begin : begin + 2, begin + 1] = 4
        eager["move"][begin : begin + 2, 0] = 1.5
    eager["start"][2::2] = eager["move"][0, 2::2] = -9
    eager["move"][0, 0] = 2.5
    longest = 0
    for size in [*range(0, 200, 13), *rng.choices(range(1500), k=25)]:
        text = "".join(rng.choices("abc xyz.-()@123", [20, 20, 20, 20, 5, 5, 5, 1, 1, 1, 1, 0.05, 0.05, 0.05, 0.05], k=size))
        want = by_all_windows(eager, text, 0.05)
        assert pii.added_spans(eager, [text], 0.05) == [want], text
        longest = max([longest, *(z - a for _, a, z in want)])
    assert longest > 2 * pii.WINDOW
