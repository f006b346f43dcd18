import sys

from pyspark.sql import functions as F

from textmill.functions import chars


def test_whitespace_is_what_unicode_says(evaluate):
    every = [chr(c) for c in range(1, sys.maxunicode + 1) if not 0xD800 <= c <= 0xDFFF]
    blank = [c for c in every if c.isspace()]
    assert sorted(chars.WHITESPACE_CHARS) == sorted(blank) and len(blank) == 29
    sample = blank + ["a", chr(0x200B), chr(0xFEFF), chr(0x180E), "犬"]
    matched = evaluate(lambda v: v.rlike(rf"\A[{chars.WHITESPACE}]\z"), sample)
    assert [c for c, m in zip(sample, matched) if m] == blank


def test_strip_trims_unicode_whitespace(evaluate):
    values = [chr(0x3000) + "犬" + chr(0x1F), " a b ", chr(0x2028) + chr(0xA0), "", "猫" + chr(0x85)]
    assert evaluate(chars.strip, values) == [v.strip() for v in values]
    assert evaluate(chars.lstrip, values) == [v.lstrip() for v in values]
    assert evaluate(chars.rstrip, values) == [v.rstrip() for v in values]
    assert evaluate(chars.remove_whitespace, values) == ["".join(v.split()) for v in values]


def test_japanese_chars(evaluate):
    values = ["犬がいる", "abc", "ｱｲｳ", "ア・イ", "", "犬a猫1。"]
    assert evaluate(chars.japanese_chars, values) == [4, 0, 3, 3, 0, 2]


def test_density_counts_the_middle_dot_twice(evaluate):
    assert evaluate(chars.density, ["ア・イ", "", "犬が1,000円", "abc犬"]) == [4 / 3, 0.0, 1.0, 0.25]


def test_starts_valid(evaluate):
    cases = {
        "🧡犬です": True,
        "⭐犬です": False,
        "「犬です」": True,
        " 【（犬です": True,
        "「 犬": True,
        "「 「犬": False,  # only one run of marks
        "🧡 「🧡犬": True,  # emoji vanish wherever they stand
        "「🧡「 犬": True,
        "・犬": True,  # the middle dot lies in the katakana block
        "※犬": False,
        "Ａ": True,
        "７日": True,
        "ｱｲ": True,
        "": False,
        "「」": False,
        "é": False,
        "]犬": False,
    }
    assert dict(zip(cases, evaluate(chars.starts_valid, list(cases)))) == cases


def test_kana_and_watch_words(evaluate):
    assert evaluate(chars.contains_kana, ["東京", "東京へ", "ｶﾅ", ""]) == [False, True, True, False]
    watched = evaluate(lambda v: chars.contains_any(v, ("2022", "⭐")), ["in 2022", "⭐", "2021"])
    assert watched == [True, True, False]


def test_line_breaks_become_spaces(evaluate):
    assert evaluate(chars.flatten_line_breaks, [f"a{chr(0x2028)}b{chr(0x2029)}c\nd\re"]) == ["a b c d e"]


def test_let_evaluates_once(evaluate):
    assert evaluate(lambda v: chars.let(F.upper(v), lambda x: F.concat(x, x)), ["ab"]) == ["ABAB"]
