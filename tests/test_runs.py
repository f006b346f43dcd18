import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from textmill.functions import chars
from textmill.operators import runs, segment
from textmill.operators.extract import extract_sentences
from textmill.operators.tokens import Flag, ScriptRunAnalyser, _tables, rule_flags

TEXTS = ["行く。犬が", "", None, "「行く」猫", "カタ・カナ犬に[[行く", "ab１2。🧡", "。", "が" * 40]


def test_steps_are_bounded_and_lose_nothing(monkeypatch):
    monkeypatch.setattr(runs, "STEP_BYTES", 20)
    parts = list(runs.steps(pa.array(["x"] + TEXTS).slice(1)))
    assert [t for p in parts for t in p.to_pylist()] == [t or "" for t in TEXTS]
    assert all(len(p) == 1 or sum(len((t or "").encode()) for t in p.to_pylist()) <= 20 for p in parts)


def test_sentences_of_parts_are_those_of_the_whole(monkeypatch):
    def found():
        result = []
        for part in runs.steps(pa.array(TEXTS)):
            strings, fault, counted, firsts = runs.find_sentences(part, _tables(ScriptRunAnalyser), Flag)
            rows = list(zip(strings.to_pylist(), fault.tolist(), counted.tolist()))
            result += [rows[a:b] for a, b in zip(firsts, firsts[1:])]
        return result

    whole = found()
    monkeypatch.setattr(runs, "STEP_BYTES", 1)
    assert found() == whole
    assert ["".join(s for s, *_ in rows) for rows in whole] == [t or "" for t in TEXTS]
    assert [s for s, *_ in whole[3]] == ["「行く」", "猫"] and [n for *_, n in whole[0]] == [4, 0]


def test_bytes_that_are_no_text_are_replaced():
    texts = pa.Array.from_buffers(pa.string(), 2, pa.array([b"a\xff", b"\xe7\x8c"], pa.binary()).buffers())
    assert [t for p in runs.steps(texts) for t in p.to_pylist()] == ["a�", "�"]


def test_null_and_empty_texts(spark):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS)], "i int, text string").coalesce(1)
    analyser = ScriptRunAnalyser()
    rows = df.select("i", analyser.segments(F.col("text")).alias("s"), analyser.structure_fault(F.col("text")).alias("f")).collect()
    assert rows[1].s == [] and rows[1].f == "no_predicate" and rows[2].s is None and rows[2].f is None


def test_a_word_whose_flags_do_not_follow_from_its_ending_is_refused():
    class Other(ScriptRunAnalyser):
        AUXILIARIES = ("です", "まん")

    with pytest.raises(ValueError, match="まん"):
        _tables(Other)


def test_extraction_builds_no_arrays_by_patterns(spark):
    docs = spark.createDataFrame([("s", "1", "犬が行く。")], "source string, doc_id string, text string")
    plan = extract_sentences(docs, ScriptRunAnalyser())._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("ArrowEvalPython") >= 1 and "regexp_extract_all" not in plan


def test_counted_characters_are_those_of_the_column_function(evaluate):
    got = evaluate(lambda t: F.aggregate(ScriptRunAnalyser().segments(t), F.lit(0).cast("long"), lambda a, s: a + s["japanese"]), TEXTS)
    assert got == [n if n is None else int(n) for n in evaluate(chars.japanese_chars, TEXTS)]
    assert np.sum([n or 0 for n in got]) > 0


def test_density_and_units_are_those_of_the_column_functions(spark):
    texts = TEXTS + ["・・。１", "行 く\r\nab", "ＡｂｃカＸ12１二十", "ｱｲ 犬"]
    df = spark.createDataFrame([(t,) for t in texts], "text string").coalesce(2)
    text, analyser = F.col("text"), ScriptRunAnalyser()
    pairs = [(runs.density(text), chars.density(text))]
    flat = lambda mode: F.transform(analyser.surfaces(text, mode), chars.flatten_line_breaks)
    pairs += [(analyser.units(text, mode, flat=True), flat(mode)) for mode in "ABC"]
    for got, want in pairs:
        assert [r.got for r in df.select(got.alias("got")).collect()] == [r.want for r in df.select(want.alias("want")).collect()]
    assert "regexp_extract_all" not in df.select(analyser.units(text, "A", flat=True))._jdf.queryExecution().optimizedPlan().toString()


def test_annotated_tokens_are_those_of_the_column_functions(spark):
    texts = TEXTS + ["です。ます", "行 く\r\nab", "🧡た", "ダに、"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, text string").coalesce(2)
    analyser = ScriptRunAnalyser()
    by_rules = F.transform(analyser.surfaces(F.col("text")), lambda s: analyser._classify(s, lambda x, t: F.lit(rule_flags(x, t))))
    want = {r.i: (r.s, r.f) for r in df.select("i", analyser.surfaces(F.col("text")).alias("s"), by_rules.alias("f")).collect()}
    found = analyser.annotate(df, "text")
    assert {r.i: (r.surfaces, r.flags) for r in found.collect()} == want and want[2] == (None, None)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1 and "regexp_extract_all" not in plan


def test_ends_in_pieces_are_those_of_the_column_functions(spark):
    rng, marks = random.Random(5), [0, *(1 << bit for bit in range(12)), Flag.STOP | Flag.PAUSE, Flag.PREDICATE | Flag.CONCLUSIVE]
    rows = [([rng.choice(marks) for _ in range(rng.randint(0, 9))], rng.choice([None, *marks]), rng.choice([None, False, True])) for _ in range(500)]
    df = spark.createDataFrame(rows, "flags array<int>, before int, quoted boolean").coalesce(2)
    # What comes before, as tokens: an opening quote, and a token with the flags of the last one.
    ahead = F.array(F.when(F.col("quoted"), Flag.QUOTE_OPEN).otherwise(0), F.coalesce("before", F.lit(0)).bitwiseAND(~(Flag.QUOTE_OPEN | Flag.QUOTE_CLOSE)))
    ends = segment.sentence_ends(F.concat(ahead, F.col("flags"), F.array(F.lit(Flag.COMMA))))
    want = F.filter(F.transform(ends, lambda p: p - 2), lambda p: (p > 0) & (p <= F.size("flags")))
    got = runs.ends_in_pieces(F.col("flags"), F.col("before"), F.col("quoted"), Flag)
    found = df.select(got.alias("got"), want.alias("want")).collect()
    assert [r.got for r in found] == [r.want for r in found] and sum(len(r.got) for r in found) > 100
