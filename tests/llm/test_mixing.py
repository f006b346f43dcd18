"""Mixing: targets, word totals, repeatability."""

import random

from textmill.llm import mixing as m


def targets(sizes, weights=m.WEIGHTS, cap=3):
    total, capped = sum(sizes.values()), set()
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    while True:
        rest = total - sum(cap * sizes[s] for s in capped)
        open_weight = sum(weight[s] for s in order if s not in capped)
        share = {s: cap * sizes[s] if s in capped else rest * weight[s] / open_weight for s in order}
        above = {s for s in order if s not in capped and share[s] > cap * sizes[s]}
        if not above:
            return share
        capped |= above


def rows():
    rng = random.Random(3)
    sources = ["a", "b", "é", "Z", None, "tiny", "empty"]
    out = [(i, " ".join(["w"] * rng.randrange(1, 200)), rng.choices(sources[:6], [50, 9, 9, 9, 9, 1])[0]) for i in range(900)]
    return out + [(1000, None, "empty"), (1001, "", "empty"), (1002, "w " * 20_000, "a"), (5, out[5][1], out[5][2]), (None, "w w", "b")]


def test_targets_and_totals(frame, clashing):
    docs = rows()
    got = m.mix(clashing(frame(docs))).collect()
    sizes = {}
    for _, text, source in docs:
        sizes[source] = sizes.get(source, 0) + len((text or "").split())
    want = targets(sizes)
    assert len(got) == len(docs)
    for source in sizes:
        key = "2" if source is None else "1" + source
        mine = [r for r in got if r.key == key]
        assert all(abs(r.target - want[source]) <= 1e-6 * max(want[source], 1) for r in mine)
        assert all(r.source_size == sizes[source] and 0 <= r.taken <= 3 * r.size for r in mine)
        longest = max(r.size for r in mine)
        assert abs(sum(r.taken for r in mine) - want[source]) <= longest + 1


def test_reruns_agree_whatever_the_partitions(frame):
    docs = frame(rows())
    one = sorted(map(tuple, m.mix(docs).collect()), key=str)
    assert one == sorted(map(tuple, m.mix(docs.repartition(17)).collect()), key=str)


def test_emitted_copies(frame, clashing):
    docs = rows()
    mixed = clashing(frame(docs))
    taken = {}
    for r in m.mix(mixed).collect():
        taken[r.id] = taken.get(r.id, 0) + r.copies
    out = m.emit(mixed)
    assert out.columns == [*mixed.columns, "copy"]
    counts = {}
    for r in out.collect():
        counts[r.doc_id] = counts.get(r.doc_id, 0) + 1
    assert counts == {k: v for k, v in taken.items() if v}


def test_empty_table(frame):
    assert m.mix(frame([])).isEmpty() and m.emit(frame([])).isEmpty()
