"""Near-duplicates against all pairs."""

import random
import tracemalloc

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

import corpus_pipeline
from textmill.llm import minhash as m
from textmill.llm.components import connected


def shingles(text):
    w = (text or "").lower().split()
    return {tuple(w[i : i + 3]) for i in range(len(w) - 2)} if len(w) > 2 else {tuple(w)} if w else set()


def brute(rows):
    sets = {i: shingles(t) for i, t in rows}
    parent = {i: i for i in sets}

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            common = len(sets[a] & sets[b])
            if common and 100 * common >= 85 * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                parent[y] = x
    return {i: (len(sets[i]), find(i)) for i in ids}


def edited(words, rng, n):
    words = list(words)
    for _ in range(n):
        words[rng.randrange(len(words))] = f"e{rng.random()}"
    return " ".join(words)


def test_components_equal_all_pairs(frame, clashing):
    rng = random.Random(4)
    rows = []
    for g in range(12):
        base = [f"g{g}w{rng.randrange(90)}" for _ in range(120)]
        for _ in range(rng.choice([1, 2, 5, 25])):
            rows.append((len(rows), edited(base, rng, rng.choice([0, 1, 2, 4, 8]))))
    rows += [(900, "Two Words"), (901, "two  words"), (902, "solo"), (903, ""), (904, None), (905, " \n ")]
    got = {r.id: (r.size, r.component) for r in m.near_duplicates(clashing(frame(rows))).collect()}
    assert got == brute(rows)
    kept = {r.doc_id for r in m.keep_first(frame(rows)).collect()}
    assert kept == {i for i, (_, c) in got.items() if c == i}


def test_blocks_of_a_large_cluster_lose_nothing(frame, monkeypatch):
    monkeypatch.setattr(m, "BLOCK_MEMBERS", 3)
    monkeypatch.setattr(m, "BROADCAST_ROWS", 0)
    rng = random.Random(5)
    base = [f"w{k}" for k in range(80)]
    rows = [(i, edited(base, rng, i % 4)) for i in range(40)]
    assert {r.id: (r.size, r.component) for r in m.near_duplicates(frame(rows)).collect()} == brute(rows)


def test_ids(frame):
    rows = [(None, "a b c d"), (None, "a b c d"), (5, "a b c d"), (5, "a b c d"), (4, "a b c d x y z q r s")]
    got = sorted(map(tuple, m.near_duplicates(frame(rows)).collect()), key=str)
    assert got == [(4, 8, 4), (5, 2, 5), (5, 2, 5), (None, 2, None), (None, 2, None)]
    assert sorted(str(r.doc_id) for r in m.keep_first(frame(rows)).collect()) == ["4", "5", "None", "None"]


def test_empty_table(frame):
    assert m.near_duplicates(frame([])).isEmpty() and m.keep_first(frame([])).isEmpty()


def test_estimate_is_close(spark):
    rng = random.Random(6)
    words = [f"w{k}" for k in range(400)]
    pairs = [(" ".join(words), edited(words, rng, n)) for n in (0, 2, 10, 30, 80)]
    texts = pa.RecordBatch.from_pydict({"id": list(range(10)), "text": [t for p in pairs for t in p]})
    planes = pa.Table.from_batches(list(m.sketch_batches([texts])))["planes"].to_pylist()
    df = spark.createDataFrame([(planes[2 * i], planes[2 * i + 1]) for i in range(5)], "a array<long>, b array<long>")
    for (a, b), r in zip(pairs, df.select(m.estimate(F.col("a"), F.col("b")).alias("e")).collect()):
        x, y = shingles(a), shingles(b)
        assert abs(r.e - len(x & y) / len(x | y)) < 0.2
    assert abs(df.select(m.estimate(F.col("a"), F.col("b")).alias("e")).first().e - 1) < 1e-9


def test_connected_long_chain(spark):
    order = list(range(60))
    random.Random(1).shuffle(order)
    links = spark.createDataFrame(list(zip(order, order[1:])) + [(100, 101)], "a long, b long")
    got = dict(map(tuple, connected(links).collect()))
    assert got == {**{i: 0 for i in range(60)}, 100: 100, 101: 100}


def test_common_counts():
    sets = [np.array([1, 2, 3], np.uint64), np.array([2, 3, 9], np.uint64), np.array([7], np.uint64)]
    counts = m.common_counts(np.concatenate(sets), np.array([0, 3, 6, 7]))
    assert counts[0, 1] == 2 and counts[0, 2] == 0


def first_of_each(rows, size, percent):
    """Ids that stay when every pair is compared."""
    sets = {i: {tuple(t.split()[k : k + size]) for k in range(len(t.split()) - size + 1)} for i, t in rows}
    group = {i: i for i in sets}
    for a in sets:
        for b in sets:
            if a < b and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                old, new = max(group[a], group[b]), min(group[a], group[b])
                group = {i: new if g == old else g for i, g in group.items()}
    return {i for i, g in group.items() if g == i}


def test_the_stage_compares_five_words_at_80_percent(spark, frame):
    rng, rows = random.Random(8), []
    for g in range(8):
        base = [f"g{g}w{k}" for k in range(300)]
        block = [f"g{g}b{k}" for k in range(200)]
        rows.append((len(rows), " ".join(base)))
        for n in (20, 66, 100):  # added blocks: similar to 0.94, 0.82 and 0.75 at three words as at five
            at = rng.randrange(5, 290)
            rows.append((len(rows), " ".join(base[:at] + block[:n] + base[at:])))
        for n in (2, 7):  # scattered edits: 0.96 and 0.87 at three words, 0.93 and 0.79 at five
            other = [f"h{g}n{n}w{k}" for k in range(300)]
            copy = [f"e{k}" if k % 40 == 20 and k < 40 * n else w for k, w in enumerate(other)]
            rows += [(len(rows), " ".join(other)), (len(rows) + 1, " ".join(copy))]
    want = first_of_each(rows, 5, 80)
    assert want != first_of_each(rows, 3, 85)
    assert {r.doc_id for r in corpus_pipeline.near_dedup(spark, frame(rows), "").collect()} == want


def test_memory_of_a_block_is_not_a_multiple_of_its_texts():
    """check_h: the arrays of a whole block's bytes, in every Python worker, took an executor's memory."""
    rng = np.random.default_rng(1)
    texts = pa.array([" ".join(f"w{k}" for k in rng.integers(5_000, size=600)) for _ in range(800)])
    tracemalloc.start()
    m.forest(np.arange(800), texts, 85)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 80e6
    (sets, offsets), (whole, bounds) = m.sliced_sets(texts), m.shingle_sets(texts)
    assert (sets == whole).all() and (offsets == bounds).all()
