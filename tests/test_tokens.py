from itertools import product

import pyarrow as pa
from pyspark.sql import functions as F

from checks.inputs import python_script_runs
from checks.queries import QUERIES
from textmill.operators import lines, outliers, segment
from textmill.operators.extract import extract_sentences, segment_documents
from textmill.operators.freq import token_frequencies
from textmill.operators.tokens import (
    PythonAnalyser,
    ScriptRunAnalyser,
    Tags,
    _added,
    _counts_of,
    explode_tokens,
    explode_units,
    rule_flags,
    with_forms,
)

TEXT = "東京へ行った。「カタカナ・テスト」12３ abc🧡\n走る"


def test_surfaces_rebuild_the_text_and_get_finer(evaluate):
    analyser = ScriptRunAnalyser()
    sizes = []
    for mode in "ABC":
        (tokens,) = evaluate(lambda v: analyser.surfaces(v, mode), [TEXT])
        assert "".join(tokens) == TEXT
        sizes.append(len(tokens))
    assert sizes[0] > sizes[1] > sizes[2]


def test_flags_agree_with_tags(spark):
    analyser = ScriptRunAnalyser()
    texts = spark.createDataFrame([(TEXT + "犬が、赤い・‥（です）のは行き",)], "chunk string")
    tokens = explode_tokens(texts, analyser).orderBy("pos").collect()
    row = analyser.annotate(texts, "chunk").first()
    assert [t.surface for t in tokens] == row.surfaces
    want = [rule_flags(t.surface, Tags(t.word_class, t.sub_class, t.conjugation)) for t in tokens]
    assert want == row.flags


def test_normalized_forms(evaluate):
    analyser = ScriptRunAnalyser()
    assert evaluate(analyser.normalize, ["ＡｂＣ１", "カナ", "犬"]) == ["abc1", "かな", "犬"]


def characters():
    """An analyser with one token per character or per piece; fails on 失. Nested, so that it travels by value."""

    def factory():
        def analyse(text, mode):
            if "失" in text:
                raise ValueError("cannot analyse")
            for c in text if mode == "A" else text.split("|"):
                if c == "。":
                    yield c, c, "補助記号", "句点", "*"
                else:
                    yield c, c.lower(), "動詞", "一般", "終止形-一般"

        return analyse

    return factory


def test_python_analyser(spark):
    analyser = PythonAnalyser(characters())
    docs = spark.createDataFrame([("s", "1", "これは|。|失\nそれは|。|あれ")], "source string, doc_id string, text string")
    rows = segment_documents(docs, analyser).orderBy("line_no", "sent_no").collect()
    got = [(r.line_no, r.raw, r.fault, r.orig_chars) for r in rows]
    assert got == [(0, "これは|。|失", "analyser_error", 4), (1, "それは。", None, 5), (1, "あれ", None, 0)]
    statuses = {r.raw: r.status for r in extract_sentences(docs, analyser).collect()}
    assert statuses == {"これは|。|失": "rejected", "それは。": "accepted", "あれ": "accepted"}


def test_python_analyser_units(spark):
    texts = spark.createDataFrame([("Ab|c\n",)], "clean string")
    analyser = PythonAnalyser(characters())
    forms = with_forms(explode_units(texts, analyser, modes=("A", "C")), analyser)
    got = sorted((r.mode, r.surface, r.normalized) for r in forms.collect())
    assert got == [
        ("A", " ", " "), ("A", "A", "a"), ("A", "b", "b"), ("A", "c", "c"), ("A", "|", "|"),
        ("C", "Ab", "ab"), ("C", "c ", "c "),
    ]


def test_long_lines_are_cut(spark):
    def sizes(n):
        docs = spark.createDataFrame([("s", "1", "a" * n)], "source string, doc_id string, text string")
        return [r.n for r in lines.explode_chunks(docs).select(F.length("chunk").alias("n")).collect()]

    assert sizes(49_000) == [49_000]
    assert sizes(49_001) == [10_000] * 4 + [9_001]


def test_lines(spark):
    text = "　犬\x1f\n\n \n猫 "
    docs = spark.createDataFrame([("s", "1", text), ("s", "2", None)], "source string, doc_id string, text string")
    got = [(r.line_no, r.line) for r in lines.explode_lines(docs).collect()]
    assert got == [(0, "犬"), (3, "猫")]


def test_sentences_by_pattern_are_those_of_the_tokens(spark):
    analyser = ScriptRunAnalyser()
    parts = ["に", "犬に", "た", "犬た", "行く", "が", "。", "、", "「", "」", "🧡", " ", "・", "X", "[[", "（"]
    texts = ["".join(p) for p in product(parts, repeat=3)] + [TEXT, "行く「犬。」行く」猫が", "が" * 50_000 + "行く、" * 50_000]
    lines_ = spark.createDataFrame([("s", str(i), 0, 0, v) for i, v in enumerate(texts)], "source string, doc_id string, line_no int, chunk_no int, chunk string")
    found = lines_.select("doc_id", F.posexplode(analyser.sentences(F.col("chunk"))).alias("sent_no", "sentence"))
    found = found.select("doc_id", "sent_no", F.btrim("sentence").alias("text"), analyser.structure_fault(F.col("sentence")).alias("fault"))
    tokens = segment.split_sentences(analyser.annotate(lines_, "chunk").drop("chunk"))
    fault = segment.structure_fault(F.col("text"), F.col("flags"))
    expected = tokens.select("doc_id", "sent_no", F.btrim("text").alias("text"), fault.alias("fault"))
    assert sorted(map(tuple, found.collect()), key=str) == sorted(map(tuple, expected.collect()), key=str)


def test_a_filter_on_forms_stays_above_the_counts(spark):
    texts = spark.createDataFrame([("train", "カタカナ 行く")], "split string, clean string")
    units = explode_units(texts, ScriptRunAnalyser()).groupBy("split", "unit").agg(F.count(F.lit(1)).alias("cnt_c"))
    counts = with_forms(units, ScriptRunAnalyser()).withColumn("percentile", F.lit(1.0))
    plan = outliers.eligible(counts)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Filter") < plan.index("Aggregate") and "translate" not in plan[plan.index("Aggregate") :].split("Generate explode")[0]


def test_python_analyser_flags_each_surface_once_and_keeps_null_texts(spark):
    def factory():
        def analyse(text, mode):
            if text == "bad":
                raise ValueError(text)
            return [(w, None if w == "-" else w.upper(), "動詞", "一般", "終止形") for w in text.split(" ")]

        return analyse

    analyser = PythonAnalyser(factory)
    rows = [(0, "a b\u2028c a"), (1, None), (2, "-")]
    texts = spark.createDataFrame(rows, "i int, chunk string").coalesce(1)
    by_mode = analyser.units_by_mode(F.col("chunk"), ("A", "C"))
    found = {r.i: r.u for r in texts.select("i", by_mode.alias("u")).collect()}
    assert found[1] is None and [m.mode for m in found[0]] == ["A", "C"]
    assert [tuple(u) for u in found[0][1].units] == [("a", "A"), ("b c", "B C"), ("a", "A")]
    assert [tuple(u) for u in found[2][0].units] == [("-", None)]
    bad = texts.unionAll(spark.createDataFrame([(3, "bad")], "i int, chunk string")).coalesce(1)
    flagged = {r.i: (r.surfaces, r.flags) for r in analyser.annotate(bad, "chunk").collect()}
    flag = rule_flags("a", Tags("動詞", "一般", "終止形"))
    assert flagged[0] == (["a", "b\u2028c", "a"], [flag] * 3) and flagged[1] == flagged[3] == (None, None)
    from textmill.operators.tokens import _flags_of

    _flags_of.cache_clear()
    assert [_flags_of("a", "動詞", "一般", "終止形") for _ in range(3)] == [flag] * 3 and _flags_of.cache_info().misses == 1


def test_structure_rules_behind_trailing_marks_and_emoji(spark):
    """The last word is found from the end; a search through the sentence for it is left to those that end in emoji."""
    words = ("行が", "が", "犬に", "行き", "行く", "す。が", "ダに", "き", "行くは")
    tails = ("", "。", "」 ", "🧡", "。🧡", "🧡。", "⭐（a", "・", "、", "😀")
    texts = ["".join(t) for t in product(("行く、", ""), words, tails)]
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    flagged = ScriptRunAnalyser().annotate(df, "text")
    by_tokens = segment.structure_fault(F.col("text"), F.col("flags"))
    found = flagged.select("text", by_tokens.alias("want"), ScriptRunAnalyser().structure_fault(F.col("text")).alias("got"))
    rows = found.collect()
    assert {r.text: r.got for r in rows} == {r.text: r.want for r in rows}
    assert {"ends_particle", "ends_continuative", "no_predicate", None} <= {r.got for r in rows}


KINDS_OF_TEXT = ["東京へ行く。カナ・ｶﾅabＡ１2「」🧡 ", "です", "ます。ない", "んです", "い行きました", "", None, "𠮷野家で(笑)", "行\r\n\u2028く", "あ" * 30 + "い"]


def test_tagged_tokens_are_those_of_the_rules(spark):
    analyser, reference = ScriptRunAnalyser(), python_script_runs()
    texts = spark.createDataFrame([(i, t) for i, t in enumerate(KINDS_OF_TEXT)], "i int, chunk string").coalesce(2)
    for mode in "ABC":
        want = {(i, p, *token) for i, t in enumerate(KINDS_OF_TEXT) if t for p, token in enumerate(reference(t, mode))}
        found = explode_tokens(texts, analyser, mode).collect()
        assert set(map(tuple, found)) == want and len(found) == len(want)
    plan = explode_tokens(texts, analyser)._jdf.queryExecution().optimizedPlan().toString()
    assert "regexp_extract_all" not in plan and "translate" not in plan


def test_tokens_are_counted_before_anything_is_sorted(spark, tmp_path):
    spark.createDataFrame([(1, "The cat ran.", "en", "web", 12)], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    plan = QUERIES["token_tags"](spark, str(tmp_path))._jdf.queryExecution().executedPlan().toString()
    lowest = [line for line in plan.splitlines() if "Aggregate" in line][-1]
    assert "HashAggregate" in lowest and "surface" in lowest


def test_units_counted_where_they_are_found_add_up_to_those_exploded(spark):
    rows = [(["train", "validation", None][i % 3], t) for i, t in enumerate(KINDS_OF_TEXT * 4)]
    texts, analyser = spark.createDataFrame(rows, "split string, clean string").repartition(3), ScriptRunAnalyser()
    for by in (("split",), ()):
        units = explode_units(texts.select(*by, "clean"), analyser)
        want = units.groupBy(*by, "unit").agg(*(F.count_if(F.col("mode") == m).alias(f"cnt_{m.lower()}") for m in "ABC"))
        found = analyser.counted_units(texts, by, "clean").groupBy(*by, "unit").agg(*(F.sum(f"cnt_{m}") for m in "abc"))
        assert sorted(map(str, map(tuple, found.collect()))) == sorted(map(str, map(tuple, want.collect())))


def test_counting_holds_no_arrays_of_the_tokens_of_a_batch(spark):
    texts = spark.createDataFrame([("犬が行く。",)], "text string")
    plan = token_frequencies(texts, ScriptRunAnalyser(), by=(), text_col="text")._jdf.queryExecution().optimizedPlan().toString()
    assert "MapInArrow" in plan and "ArrowEvalPython" not in plan


def test_held_counts_are_added_up():
    names = ["cnt_a", "cnt_b", "cnt_c"]
    tables = _counts_of(pa.array(["東京 東京", "ab"]), ScriptRunAnalyser, "ABC", names)
    added = {r["unit"]: (r["cnt_a"], r["cnt_b"], r["cnt_c"]) for r in _added([_added(tables, names), *tables], names).to_pylist()}
    assert added == {"東": (4, 0, 0), "京": (4, 0, 0), " ": (2, 2, 2), "東京": (0, 4, 4), "ab": (2, 2, 2)}
