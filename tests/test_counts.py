"""Frequencies, comparison and outliers."""

import hashlib
import math
import random
from collections import Counter

from pyspark.sql import functions as F

from textmill.operators import compare, freq, outliers
from textmill.operators.split import with_split
from textmill.operators.tokens import ScriptRunAnalyser

COLUMNS = "split string, surface string, normalized string, cnt_a long, cnt_b long, cnt_c long, percentile double"


def test_split_is_the_md5_bucket(spark):
    texts = [f"文{i}。" for i in range(3_000)]
    df = with_split(spark.createDataFrame([(t,) for t in texts], "clean string"), 0.1)
    got = {r.clean: r.split for r in df.collect()}
    for t in texts:
        bucket = int(hashlib.md5(t.encode()).hexdigest()[:8], 16) % 1000
        assert got[t] == ("validation" if bucket < 100 else "train")


def test_frequencies_equal_a_counter(spark):
    rng = random.Random(2)
    texts = ["".join(rng.choice("犬猫がのカナAb1２。") for _ in range(12)) for _ in range(300)]
    df = spark.createDataFrame([("train", t) for t in texts], "split string, clean string")
    got = freq.token_frequencies(df, ScriptRunAnalyser()).collect()
    import re

    for mode in "ABC":
        pattern = re.sub(
            r"\\x\{(\w+)\}", lambda m: chr(int(m[1], 16)), ScriptRunAnalyser.PATTERNS[mode]
        )
        want = Counter(m for t in texts for m in re.findall(pattern, t))
        found = {r.surface: r[f"cnt_{mode.lower()}"] for r in got if r[f"cnt_{mode.lower()}"]}
        assert found == want


def test_collapse_takes_the_forms_of_the_largest_row(spark):
    rows = [
        ("train", "a", "n2", 1, 1, 5, 2.0),
        ("train", "a", "n1", 9, 9, 9, None),
        ("train", "b", "n2", 1, 1, 1, 3.0),
        ("train", "b", "n1", 1, 1, 1, 4.0),
    ]
    got = freq.collapse_surface(spark.createDataFrame(rows, COLUMNS)).orderBy("surface").collect()
    assert [tuple(r) for r in got] == [("train", "a", "n1", 10, 10, 14, None), ("train", "b", "n1", 2, 2, 2, 4.0)]


def test_top_types_are_ranked_per_split(spark):
    rows = [(s, f"w{i}", f"w{i}", 1, 1, i % 5, None) for s in ("train", "validation") for i in range(50)]
    top = freq.top_types(spark.createDataFrame(rows, COLUMNS), 7)
    for split in ("train", "validation"):
        got = [r.surface for r in top.filter(F.col("split") == split).orderBy("rank").collect()]
        assert got == ["w14", "w19", "w24", "w29", "w34", "w39", "w4"]


def words(spark, rows):
    return spark.createDataFrame(rows, "surface string, cnt_train long, cnt_val long, pct_train double, pct_val double")


def test_similarity_figures(spark):
    got = compare.similarity(
        words(spark, [("a", 3, 4, 1.0, 1.0), ("b", 5, 0, None, None), ("c", 0, 2, None, 9.0)]), 10
    ).first()
    assert (got.union_size, got.shared, got.only_train, got.only_val) == (3, 1, 1, 1)
    assert math.isclose(got.jaccard, 1 / 3)
    assert math.isclose(got.cosine, 12 / (math.sqrt(34) * math.sqrt(20)))
    assert math.isclose(got.jaccard_train_vocab, 1 / (2 + 10 - 1))
    assert math.isclose(got.jaccard_val_vocab, 2 / (2 + 10 - 2))
    assert (got.coverage_train, got.coverage_val) == (0.5, 1.0)


def test_similarity_of_nothing(spark):
    got = compare.similarity(words(spark, []), 10).first()
    assert all(v == 0 for v in got)


def test_published_figures(spark):
    """Set sizes of a published full run give its published similarities."""
    shared, only_train, only_val = 345_827, 570_558, 36_457
    i = F.col("id")
    df = spark.range(shared + only_train + only_val).select(
        i.cast("string").alias("surface"),
        F.when(i < shared + only_train, 1).otherwise(0).alias("cnt_train"),
        F.when((i < shared) | (i >= shared + only_train), 1).otherwise(0).alias("cnt_val"),
        F.lit(1.0).alias("pct_train"),
        F.lit(1.0).alias("pct_val"),
    )
    got = compare.similarity(df, 2_530_791).first()
    assert got.union_size == 952_842
    assert [round(v, 6) for v in (got.jaccard, got.jaccard_train_vocab, got.jaccard_val_vocab)] == [
        0.362943, 0.362094, 0.151053,
    ]


def test_lists(spark):
    df = words(spark, [("a", 3, 0, None, None), ("b", 5, 0, 1.0, None), ("c", 0, 2, None, None), ("d", 1, 1, None, 2.0)])
    assert [tuple(r) for r in compare.most_frequent(compare.only_in(df, "train")).collect()] == [("b", 5), ("a", 3)]
    assert [tuple(r) for r in compare.only_in(df, "validation").collect()] == [("c", 2)]
    assert {r.surface for r in compare.unknown_in(df, "train").collect()} == {"a", "d"}
    assert {r.surface for r in compare.unknown_in(df, "validation").collect()} == {"c"}


def test_outliers(spark):
    rows = [
        ("train", "a", "a", 1, 1, 400, 100.0),
        ("train", "b", "b", 1, 1, 300, 10.126),
        ("train", "c", "c", 1, 1, 200, 50.0),
        ("train", "d", "d", 1, 1, 100, 25.0),
        ("train", "e", "e", 1, 1, 99, 1.0),
        ("train", "F", "f", 1, 1, 900, 1.0),
        ("train", "g", "g", 1, 1, 900, None),
    ]
    gaps = outliers.percentile_gaps(spark.createDataFrame(rows, COLUMNS))
    got = [(r.surface, r.observed, r.listed, round(r.gap, 2)) for r in outliers.largest_gaps(gaps).collect()]
    assert got == [("b", 75.0, 10.13, 64.87), ("a", 100.0, 100.0, 0.0), ("c", 50.0, 50.0, 0.0), ("d", 25.0, 25.0, 0.0)]
