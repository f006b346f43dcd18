"""Running values over pieces, and sentences of lines cut anywhere."""

import random

import pytest
from pyspark.sql import functions as F

from textmill.operators import extract
from textmill.operators.scan import running_before
from textmill.operators.segment import join_pieces, split_sentences
from textmill.operators.tokens import PythonAnalyser, ScriptRunAnalyser
from tests.test_segment import WORDS, flags


@pytest.mark.parametrize("block", [1, 3, 1_000])
def test_running_values_equal_a_loop(spark, block):
    rng = random.Random(1)
    rows = [(k, i, rng.choice([None, None, 1, 2, 3]), rng.randint(0, 4)) for k in "abc" for i in range(40)]
    df = spark.createDataFrame(rng.sample(rows, len(rows)), "k string, i int, v int, n long").repartition(5)
    want, seen, total = set(), {}, {}
    for k, i, v, n in rows:
        want.add((k, i, v, n, seen.get(k), total.get(k, 0)))
        seen[k] = seen.get(k) if v is None else v
        total[k] = total.get(k, 0) + n
    assert set(map(tuple, running_before(df, ["k"], "i", ["v"], ["n"], block).collect())) == want


def test_sentences_of_any_cut_equal_those_of_whole_lines(spark):
    rng = random.Random(2)
    whole, pieces = [], []
    for line in range(150):
        tokens = [rng.choice([*WORDS, "「", "」", "。"]) for _ in range(rng.randint(1, 60))]
        whole.append((line, tokens, flags(tokens)))
        cuts = sorted({0, len(tokens), *(rng.randint(0, len(tokens)) for _ in range(rng.randint(0, 12)))})
        for no, (a, b) in enumerate(zip(cuts, cuts[1:])):
            pieces.append((line, no, tokens[a:b], flags(tokens[a:b]), b - a))
    lines = spark.createDataFrame(whole, "line int, surfaces array<string>, flags array<int>")
    cut = spark.createDataFrame(pieces, "line int, piece_no int, surfaces array<string>, flags array<int>, extra long").repartition(7)
    want = {(r.line, r.sent_no, r.text, tuple(r.flags)) for r in split_sentences(lines).collect()}
    found = join_pieces(cut, ["line"], block=3).collect()
    assert {(r.line, r.sent_no, r.text, tuple(r.flags)) for r in found} == want and len(found) == len(want)
    assert sum(r.extra for r in found) == sum(len(tokens) for _, tokens, _ in whole)


def test_no_piece_cuts_a_token(evaluate):
    analyser, rng = ScriptRunAnalyser(), random.Random(3)
    texts = ["".join(rng.choice("東京へ行くカナ・ｶﾅabＡ１2。「」🧡 ") for _ in range(rng.randint(1, 80))) for _ in range(300)]
    whole = evaluate(analyser.surfaces, texts)
    for chars in (1, 2, 7):
        parts = evaluate(lambda v: F.transform(analyser.pieces(v, chars), lambda p: analyser.surfaces(p)), texts)
        assert [[t for part in p for t in part] for p in parts] == whole


def test_a_line_of_megabytes(spark):
    """Sentences as from a loop over the known text; no array holds more than a piece's tokens."""
    n = 200_000
    docs = spark.range(1).select(
        F.lit("s").alias("source"), F.lit("1").alias("doc_id"), F.concat(F.repeat(F.lit("犬が「走る。」行く。"), n // 2), F.repeat(F.lit("「あ。"), 3)).alias("text")
    )
    docs = docs.withColumn("text", F.concat("text", F.lit("」猫が寝た。"), F.repeat(F.lit("鳥が鳴いた。"), n)))
    found = extract.segment_documents(docs, ScriptRunAnalyser(), long_bytes=extract.LONG_BYTES)
    counts = {r["raw"]: r["count"] for r in found.groupBy("raw").count().collect()}
    assert counts == {"犬が「走る。」行く。": n // 2, "「あ。「あ。「あ。」猫が寝た。": 1, "鳥が鳴いた。": n}
    size = docs.select(F.octet_length("text")).first()[0]
    assert size > 6_000_000 and found.agg(F.max("sent_no")).first()[0] == n + n // 2


def test_a_python_analyser_takes_long_lines_whole(spark):
    def factory():
        def analyse(text, mode):
            if "失" in text:
                raise ValueError("cannot analyse")
            return [(c, c, "動詞" if c != "。" else "補助記号", "句点" if c == "。" else "一般", "*") for c in text]

        return analyse

    docs = spark.createDataFrame([("s", "1", "犬。猫。"), ("s", "2", "失敗。"), ("s", "3", None)], "source string, doc_id string, text string")
    found = extract.segment_documents(docs, PythonAnalyser(factory), long_bytes=1).collect()
    assert sorted((r.doc_id, r.sent_no, r.raw, r.fault) for r in found) == [("1", 0, "犬。", None), ("1", 1, "猫。", None), ("2", 0, "失敗。", "analyser_error")]
