import pytest
from pyspark.sql import functions as F

from textmill.operators import vocab
from textmill.operators.tokens import ScriptRunAnalyser


def ranked(spark, *words):
    return spark.createDataFrame([(w, i) for i, w in enumerate(words)], "word string, rank long")


def listed(df):
    return {r.word: round(r.percentile, 2) for r in df.collect()}


def test_percentiles(spark):
    assert listed(vocab.percentiles(ranked(spark, *"abcd"))) == {"a": 100.0, "b": 75.0, "c": 50.0, "d": 25.0}


def test_last_listing_counts(spark):
    assert listed(vocab.percentiles(ranked(spark, "a", "b", "a"))) == {"a": 33.33, "b": 66.67}


@pytest.mark.parametrize("limit", [0, vocab.BROADCAST_LIMIT_BYTES])
def test_unknown_words(spark, limit):
    sentences = spark.createDataFrame(
        [("犬。",), ("カナ。",), ("猫。犬。",), ("",), ("犬犬。",)], "clean string"
    )
    words = ranked(spark, "犬", "かな", "。")  # カナ is known by its normalized form
    got = vocab.flag_unknown_words(sentences, words, ScriptRunAnalyser(), limit)
    assert {r.clean: r.oov for r in got.collect()} == {
        "犬。": False, "カナ。": False, "猫。犬。": True, "": False, "犬犬。": True,
    }


def test_filter_shuffles_the_sentences_once(spark, capsys):
    sentences = spark.range(100_000).select(F.col("id").cast("string").alias("clean")).distinct()
    words = ranked(spark, "1")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        flagged = vocab.flag_unknown_words(sentences, words, ScriptRunAnalyser())
        flagged.count()
        flagged.explain()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    plan = capsys.readouterr().out
    # The exchange of the duplicate removal is the only one of the sentences; nothing is joined back.
    assert "SortMergeJoin" not in plan and plan.count("Exchange hashpartitioning(clean") == 1


@pytest.mark.parametrize("limit", [0, vocab.BROADCAST_LIMIT_BYTES])
def test_percentile_by_surface_then_normalized(spark, limit):
    freq = spark.createDataFrame([("A", "a"), ("b", "x"), ("z", "z")], "surface string, normalized string")
    found = vocab.attach_percentiles(freq, vocab.percentiles(ranked(spark, "a", "b", "x", "A")), limit)
    assert {r.surface: r.percentile for r in found.collect()} == {"A": 25.0, "b": 75.0, "z": None}


def test_absent_words(spark):
    freq = spark.createDataFrame(
        [("A", "a", 2), ("b", "c", 0)], "surface string, normalized string, cnt_c long"
    )
    absent = vocab.absent_words(ranked(spark, "a", "b", "A", "d", "d"), freq)
    got = sorted((r["rank"], r["word"], round(r["percentile"], 6)) for r in absent.collect())
    assert got == [(1, "b", 80.0), (3, "d", 40.0), (4, "d", 20.0)]


def test_the_filter_never_stops_a_listed_word(spark):
    words = spark.range(20_000).select(F.concat(F.lit("w"), "id").alias("word"))
    others = spark.range(20_000).select(F.concat(F.lit("x"), "id").alias("word"))
    for max_bytes in (vocab.FILTER_BYTES, 4_096):  # the second has two bits a word
        bits, rows = vocab.word_filter(words, max_bytes)
        assert bits.count() == rows and rows * 4_096 <= max(max_bytes, 20_000 // 4 * 8 + 4_096)
        passed = lambda df: vocab._let_through(df, bits, rows, "word").filter("word_passed").count()
        assert passed(words) == 20_000
        assert passed(others) < (600 if max_bytes > 4_096 else 20_001)


def test_a_hot_unit_is_dealt_to_many_tasks(spark):
    rows = spark.range(4_000).select(F.md5(F.col("id").cast("string")).alias("digest"), F.lit("hot").alias("unit"))
    few = spark.createDataFrame([("hot",), ("other",)], "unit string")
    found = vocab.dealt_semi_join(rows, few, "unit", "digest", 64, broadcast=False)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        parts = [r["count"] for r in found.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert sum(parts) == 4_000 and len(parts) >= 6 and max(parts) < 1_500


@pytest.mark.parametrize("filter_bytes", [vocab.FILTER_BYTES, 8])
def test_large_lists_with_filters_of_any_size(spark, monkeypatch, filter_bytes):
    monkeypatch.setattr(vocab, "HEAD_WORDS", 3)
    words = ranked(spark, *(f"語{i}" for i in range(400)), "か")
    texts = [(f"d{i}", u) for i, u in enumerate(["語1", "語300", "カ", "謎", "謎", "謎々", "語400"])]
    units = spark.createDataFrame(texts, "digest string, unit string")
    for broadcast in (True, False):
        if not broadcast:
            monkeypatch.setattr(vocab, "fits_broadcast", lambda *_: False)
        found = vocab.unknown_digests(units, words, ScriptRunAnalyser(), 0, filter_bytes, 4)
        assert sorted(r.digest for r in found.collect()) == ["d3", "d4", "d5", "d6"]
