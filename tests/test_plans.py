"""Shapes of plans: what must not be sorted, shuffled or run twice."""

from pyspark.sql import functions as F

from textmill.operators import stats, vocab
from textmill.operators.rank import near_digest_end
from textmill.operators.tokens import PythonAnalyser, ScriptRunAnalyser, explode_units
from textmill.plans.corpus import build_frequencies, build_sentences


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def characters():
    """A factory that travels by value."""

    def factory():
        return lambda text, mode: [(c, c, "名詞", "一般", "*") for c in text]

    return factory


def test_a_python_analyser_reads_each_text_once(spark):
    texts = spark.createDataFrame([("犬が",)], "clean string")
    units = explode_units(texts, PythonAnalyser(characters()))
    assert plan(units).count("ArrowEvalPython") == 1
    assert {(r.mode, r.unit["surface"]) for r in units.collect()} == {(m, c) for m in "ABC" for c in "犬が"}


def test_samples_sort_only_rows_near_the_bound(spark):
    rows = spark.range(20_000).select(F.md5(F.col("id").cast("string")).alias("_digest"))
    near = near_digest_end(rows, 100)
    assert 100 <= near.count() < 200 and "Sort" not in plan(near)
    largest = near_digest_end(rows, 100, largest=True)
    top = [r[0] for r in rows.orderBy(F.desc("_digest")).limit(100).collect()]
    assert set(top) <= {r[0] for r in largest.collect()}
    assert near_digest_end(rows, 30_000).count() == 20_000
    assert "TakeOrderedAndProject" in plan(stats.top_by_text(rows.withColumnRenamed("_digest", "clean"), 5))


def test_small_vocabulary_needs_no_join_back(spark):
    sentences = spark.createDataFrame([("犬が行く。",), ("",), ("猫",)], "clean string")
    words = spark.createDataFrame([("犬が", 0), ("行く", 1), ("。", 2), ("犬が行く", 3)], "word string, rank long")
    found = vocab.flag_unknown_words(sentences, words, ScriptRunAnalyser())
    assert "SortMergeJoin" not in plan(found) and plan(found).count("BroadcastHashJoin") == 2
    shuffled = vocab.flag_unknown_words(sentences, words, ScriptRunAnalyser(), 0)
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, shuffled.collect()))


def test_a_unit_in_every_sentence(spark):
    sentences = spark.range(3_000).select(F.concat(F.lit("謎。"), "id").alias("clean"))
    words = spark.createDataFrame([("。", 0)], "word string, rank long")
    for limit in (0, 1 << 20):
        found = vocab.flag_unknown_words(sentences, words, ScriptRunAnalyser(), limit)
        assert found.filter("oov").count() == 3_000


def test_a_build_analyses_each_text_once(spark, tmp_path):
    """The analyser notes its calls: one per line, and one per sentence and mode, for filter and counts together."""
    log = str(tmp_path / "calls")

    def factory():
        def analyse(text, mode):
            with open(log, "a") as file:
                file.write(f"{mode}{text}\n")
            return [(c, c, "動詞" if c != "。" else "補助記号", "句点" if c == "。" else "一般", "終止形") for c in text]

        return analyse

    docs = spark.createDataFrame([("s", "1", "犬がいる。猫がいる。"), ("s", "2", "鳥がいる。")], "source string, doc_id string, text string")
    words = spark.createDataFrame([(c, i) for i, c in enumerate("犬猫がいる。")], "word string, rank long")
    corpus = build_sentences(docs, words, PythonAnalyser(factory))
    counted = build_frequencies(corpus, words, PythonAnalyser(factory))
    assert {r.surface for r in counted.collect()} == set("犬猫がいる。") and corpus.rejects.count() == 1
    calls = open(log).read().split()
    clean = ["犬がいる。", "猫がいる。", "鳥がいる。"]
    assert sorted(calls) == sorted(["C犬がいる。猫がいる。", "C鳥がいる。", *(m + s for m in "ABC" for s in clean)])
