import random

from pyspark.sql import functions as F

from textmill.operators.segment import sentence_ends, split_sentences, structure_fault
from textmill.operators.tokens import (
    ADJECTIVE,
    AUXILIARY,
    BLANK,
    COMMA,
    FULL_STOP,
    PARTICLE,
    SYMBOL,
    VERB,
    Flag,
    Tags,
    rule_flags,
)

NOUN = Tags("名詞")
FINAL, CONTINUATIVE = "終止形-一般", "連用形-一般"
WORDS = {
    "犬": NOUN,
    "が": Tags(PARTICLE),
    "の": Tags(PARTICLE),
    "行く": Tags(VERB, conjugation=FINAL),
    "行き": Tags(VERB, conjugation=CONTINUATIVE),
    "赤い": Tags(ADJECTIVE, conjugation=FINAL),
    "です": Tags(AUXILIARY, conjugation=FINAL),
    "。": Tags(SYMBOL, FULL_STOP),
    "、": Tags(SYMBOL, COMMA),
    "「": Tags(SYMBOL),
    "」": Tags(SYMBOL),
    "・": Tags(SYMBOL),
    "[[": Tags(SYMBOL),
    " ": Tags(BLANK),
    "🧡": Tags(SYMBOL),
    "🐎": NOUN,
}


def flags(tokens):
    return [rule_flags(t, WORDS[t]) for t in tokens]


def ends_by_hand(tokens):
    quoted, before, ends = False, None, []
    for i, t in enumerate(tokens, 1):
        tags = WORDS[t]
        quoted = True if t == "「" else False if t == "」" else quoted
        final = before is not None and WORDS[before].conjugation == FINAL
        predicate = before is not None and WORDS[before].word_class in (VERB, ADJECTIVE, AUXILIARY)
        if not quoted and (
            tags.sub_class == FULL_STOP
            or (tags.word_class in (SYMBOL, BLANK) and final)
            or (t in "🧡🐎" and predicate)
        ):
            ends.append(i)
        before = t
    if tokens and (not ends or ends[-1] != len(tokens)):
        ends.append(len(tokens))
    return ends


def test_ends_equal_the_loop(evaluate):
    rng = random.Random(3)
    chunks = [[rng.choice(list(WORDS)) for _ in range(rng.randint(0, 30))] for _ in range(1_500)]
    assert evaluate(sentence_ends, [flags(c) for c in chunks], "array<int>") == [ends_by_hand(c) for c in chunks]


def test_long_chunk(evaluate):
    chunk = ["「"] + ["犬"] * 20_000 + ["」", "行く", "。"] + ["犬", "。"] * 10_000
    assert evaluate(sentence_ends, [flags(chunk)], "array<int>") == [ends_by_hand(chunk)]


def test_quotes(evaluate):
    nested, held = ["「", "「", "」", "。", "犬"], ["「", "行く", "。", "」"]
    got = evaluate(sentence_ends, [flags(nested), flags(held)], "array<int>")
    assert got == [[4, 5], [4]]


def faults(spark, sentences):
    rows = [("".join(s), flags(s)) for s in sentences]
    df = spark.createDataFrame(rows, "text string, flags array<int>").coalesce(1)
    return [r[0] for r in df.select(structure_fault(F.col("text"), F.col("flags"))).collect()]


def test_structure_rules(spark):
    cases = [
        (["犬", "行く", "。"], None),
        (["犬", "。"], "no_predicate"),
        (["行く", "、"], "ends_comma"),
        (["行く", "犬", "が", "。"], "ends_particle"),
        (["行く", "犬", "の"], None),
        (["行き"], "ends_continuative"),
        (["行き", "。"], None),
        (["行き", " "], "ends_continuative"),
        (["[[", "行く", "。"], "markup"),
        (["行く", "・"], "ends_mark"),
    ]
    assert faults(spark, [tokens for tokens, _ in cases]) == [fault for _, fault in cases]


def test_no_content(spark):
    df = spark.createDataFrame([("。", [Flag.FILLER | Flag.PREDICATE])], "text string, flags array<int>")
    assert df.select(structure_fault(F.col("text"), F.col("flags"))).first()[0] == "no_content"


def test_split_keeps_empty_and_failed_chunks(spark):
    rows = [(1, ["犬", "。", " ", "猫"], [0, Flag.STOP, 0, 0]), (2, [], []), (3, None, None)]
    df = spark.createDataFrame(rows, "id int, surfaces array<string>, flags array<int>")
    got = [(r.id, r.sent_no, r.text) for r in split_sentences(df).orderBy("id", "sent_no").collect()]
    assert got == [(1, 0, "犬。"), (1, 1, "猫"), (2, None, None), (3, None, None)]
