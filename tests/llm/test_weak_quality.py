"""Weak-label quality: expectation-maximisation on known labellers, classes on held-out labels."""

import pathlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from textmill.llm import weak_quality as w


def test_em_finds_posteriors_of_made_votes():
    rng = np.random.default_rng(1)
    truth = rng.choice(3, 6000, p=[0.75, 0.15, 0.1])
    votes = np.zeros((len(truth), len(w._LABELLERS)), int)
    toxic_from = len(w._LABELLERS) - w._TOXIC_LABELLERS
    for k in range(votes.shape[1]):
        if k < toxic_from:
            junk = (truth == 1) & (rng.random(len(truth)) < 0.6)
            votes[:, k] = np.where(junk, w.JUNK, np.where(rng.random(len(truth)) < 0.9, w.CLEAN, 0))
        else:
            votes[:, k] = np.where((truth == 2) & (rng.random(len(truth)) < 0.7), w.TOXIC, 0)
    patterns, place, counts = np.unique(w._pack(votes), return_inverse=True, return_counts=True)
    assert (w.unpack(patterns)[place] == votes).all()
    posterior, accuracy = w.fit_labellers(patterns, counts)
    assert (posterior[place].argmax(1) == truth).mean() > 0.95
    assert np.allclose(accuracy.sum(2), 1)
    # Estimates follow the votes, far from what was believed of them, and more of the same documents change little.
    assert abs(accuracy[0, 0, w.CLEAN] - 0.9) < 0.02 and abs(accuracy[0, 1, w.JUNK] - 0.6) < 0.05
    assert abs(accuracy[-1, 2, w.TOXIC] - 0.7) < 0.05
    posterior, more = w.fit_labellers(patterns, counts * 1_000)
    assert np.abs(more - accuracy).max() < 0.15 and (posterior[place].argmax(1) == truth).mean() > 0.95


def test_a_useless_labeller_loses_its_credit():
    rng = np.random.default_rng(4)
    truth = rng.choice(3, 20_000, p=[0.75, 0.15, 0.1])
    quality = np.where(truth[:, None] == 1, w.JUNK, w.CLEAN) * (rng.random((len(truth), 8)) < 0.85)
    toxic = w.TOXIC * ((truth[:, None] == 2) & (rng.random((len(truth), 4)) < 0.7))
    votes = np.concatenate([quality, toxic], axis=1).astype(int)
    votes[:, 0] = rng.choice([w.CLEAN, w.JUNK], len(truth))  # at random, whatever the class
    patterns, place, counts = np.unique(w._pack(votes), return_inverse=True, return_counts=True)
    posterior, accuracy = w.fit_labellers(patterns, counts)
    assert (posterior[place].argmax(1) == truth).mean() > 0.95
    assert all(abs(accuracy[0, c, w.JUNK] - 0.5) < 0.05 for c in range(3))


def test_classes_of_labelled_documents(spark):
    folder = "/root/testdata/sf0.01"
    if not pathlib.Path(folder).exists():
        pytest.skip("no test tables")
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    learn, hold = labels.filter("doc_id % 2 = 0"), labels.filter("doc_id % 2 = 1")
    scored = w.classify(spark.read.parquet(f"{folder}/documents.parquet"), learn)
    rows = scored.join(hold, F.col("id") == F.col("doc_id")).collect()
    share = lambda some, label: sum(r.label == label for r in some) / len(some)
    assert share([r for r in rows if r.quality == 1 and not r.toxic], "clean") > 0.95
    assert share([r for r in rows if r.quality == 0 and not r.toxic], "junk") > 0.75
    assert share([r for r in rows if r.quality == 1 and r.toxic], "toxic") > 0.4


def test_edge_cases(frame, clashing):
    rng = random.Random(2)
    rows = [(i, " ".join(rng.choices(["the", "of", "word", "and", "thing."], k=80))) for i in range(50)]
    rows += [(90, None), (91, ""), (92, "\n"), (93, "x " * 60_000), (0, rows[0][1]), (None, rows[1][1])]
    got = w.classify(clashing(frame(rows))).collect()
    assert len(got) == len(rows)
    assert all(abs(r.p_clean + r.p_junk + r.p_toxic - 1) < 1e-6 for r in got)
    assert all(r.label == "junk" and r.p_junk == 1 for r in got if r.id in (90, 91, 92))
    assert len({(r.p_clean, r.label) for r in got if r.id == 0}) == 1
    assert w.classify(frame([])).isEmpty()
