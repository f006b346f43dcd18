import random
import time

from pyspark.sql import functions as F

from textmill.functions import cleaning

PAIRS = cleaning.BRACKET_PAIRS


def matched_by_hand(text):
    while len(text) > 1 and text[0] + text[-1] in PAIRS:
        text = text[1:-1].strip()
    return text


def unbalanced_by_hand(text):
    def trimmed(t):
        for a, b in PAIRS:
            n_a, n_b = t.count(a), t.count(b)
            surplus = a if n_a > n_b else b if n_b > n_a else None
            if surplus and t[:1] == surplus:
                return t[1:].lstrip()
            if surplus and t[-1:] == surplus:
                return t[:-1].rstrip()
        return None

    while (shorter := trimmed(text)) is not None:
        text = shorter
    return text


def random_texts(n=3_000, seed=5):
    rng = random.Random(seed)
    signs = "".join(PAIRS) + "　 "
    texts = ["", "（", "()", "（　）"]
    for _ in range(n):
        alphabet = "犬a" + "".join(rng.sample(signs, rng.randint(1, 6)))
        texts.append("".join(rng.choice(alphabet) for _ in range(rng.randint(1, 14))))
    return texts


def test_matched_brackets_equal_the_loop(evaluate):
    texts = random_texts()
    assert evaluate(cleaning.strip_matched_brackets, texts) == [matched_by_hand(t) for t in texts]


def test_unbalanced_brackets_equal_the_loop(evaluate):
    texts = random_texts(seed=6)
    assert evaluate(cleaning.strip_unbalanced_brackets, texts) == [unbalanced_by_hand(t) for t in texts]


def test_deep_nesting(evaluate):
    deep = "（" * 400 + "犬" + "）" * 400
    assert evaluate(cleaning.strip_matched_brackets, [deep]) == ["犬"]
    assert evaluate(cleaning.strip_unbalanced_brackets, ["[" * 300 + "犬"]) == ["犬"]


def test_very_many_brackets_take_linear_time(evaluate):
    deep, loose = "（" * 100_000 + "犬" + "）" * 100_000, "[ " * 50_000 + "犬" + " 」" * 50_000
    start = time.perf_counter()
    assert evaluate(cleaning.strip_matched_brackets, [deep]) == ["犬"]
    assert evaluate(cleaning.strip_unbalanced_brackets, [loose, deep + "）"]) == ["犬", deep]
    assert time.perf_counter() - start < 30  # copying the text per bracket takes many minutes


def test_bracket_examples(evaluate):
    assert evaluate(cleaning.strip_matched_brackets, ["（a）b（c）", "[[犬]]"]) == ["a）b（c", "犬"]
    assert evaluate(cleaning.strip_unbalanced_brackets, ["「犬です", "(1)犬です"]) == ["犬です", "(1)犬です"]


def test_list_numbers(evaluate):
    values = ["12)犬", "１．　犬", "1.5倍です", "a1)犬", "1犬"]
    assert evaluate(cleaning.strip_list_number, values) == ["犬", "犬", "5倍です", "a1)犬", "1犬"]


def test_leading_marks(evaluate):
    values = ["＞> ：犬です ", "犬：", " : 犬"]
    assert evaluate(cleaning.strip_leading_marks, values) == ["犬です", "犬：", "犬"]


def test_chain(evaluate):
    cases = {
        "＞ 1)（犬 です。）": "犬です。",
        "（1）犬です。": "（1）犬です。",
        "【１．犬です】": "犬です",
        "「犬です": "犬です",
        "：2) 「猫 だ」 ": "猫だ",
    }
    assert dict(zip(cases, evaluate(cleaning.clean_sentence, list(cases)))) == cases


def test_texts_with_plain_edges_skip_code_that_is_not_compiled(spark):
    """Inside a lambda Spark interprets every step, so the texts that need no cleaning stay outside."""
    steps = str(cleaning.clean_sentence(F.col("text")))
    assert steps.index("CASE WHEN") < steps.index("transform(")
