"""Character classes and the text measures built on them.

Classes are written as explicit code-point ranges, because the predefined classes of Java's regular expressions
(``\\s``, ``\\p{...}``) differ from the Unicode sets that define the results.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

# The character sets the corpus rules are defined over.
WHITESPACE = (
    r"\x{9}-\x{D}\x{1C}-\x{20}\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}"
)
HIRAGANA = r"\x{3040}-\x{309F}"
KATAKANA = r"\x{30A0}-\x{30FF}"
HALF_WIDTH_KATAKANA = r"\x{FF65}-\x{FF9F}"
KANJI = r"\x{4E00}-\x{9FFF}"
EMOJI = r"\x{2600}-\x{27BF}\x{1F300}-\x{1F6FF}\x{1F900}-\x{1F9FF}"
LATIN = r"A-Za-z\x{FF21}-\x{FF3A}\x{FF41}-\x{FF5A}"
DIGIT = r"0-9\x{FF10}-\x{FF19}"
PUNCTUATION = "、。・！？!?,."
MIDDLE_DOT = "・"
LEADING_MARKS = r"＞>［\[＜<【｢「（(：:"

KANA = HIRAGANA + KATAKANA + HALF_WIDTH_KATAKANA
JAPANESE = KANA + KANJI

# The members of WHITESPACE as characters, for the trim functions.
_WHITESPACE_RANGES = (
    (0x9, 0xD), (0x1C, 0x20), (0x85, 0x85), (0xA0, 0xA0), (0x1680, 0x1680), (0x2000, 0x200A),
    (0x2028, 0x2029), (0x202F, 0x202F), (0x205F, 0x205F), (0x3000, 0x3000),
)
WHITESPACE_CHARS = "".join(chr(c) for low, high in _WHITESPACE_RANGES for c in range(low, high + 1))

LINE_BREAKS = chr(0x2028) + chr(0x2029) + "\n\r"


def let(value: Column, body) -> Column:
    """Evaluate ``value`` once and hand it to ``body``, which may use it many times."""
    return F.transform(F.array(value), body)[0]


def strip(text: Column) -> Column:
    return F.btrim(text, F.lit(WHITESPACE_CHARS))


def lstrip(text: Column) -> Column:
    return F.ltrim(text, F.lit(WHITESPACE_CHARS))


def rstrip(text: Column) -> Column:
    return F.rtrim(text, F.lit(WHITESPACE_CHARS))


def remove_whitespace(text: Column) -> Column:
    """Spaces go by a search for bytes. For what is left, one test settles all that lies above the last blank."""
    return F.regexp_replace(without_spaces(text), rf"[\x{{0}}-\x{{3000}}&&[{WHITESPACE}]]+", "")


def without_spaces(text: Column) -> Column:
    return F.replace(text, F.lit(" "), F.lit(""))


def count_class(text: Column, char_class: str) -> Column:
    """Number of characters of ``text`` inside a class without the space.

    Removing whole runs beats listing single matches, and runs are longer once the spaces are gone.
    """
    dense = without_spaces(text)
    return F.length(dense) - F.length(F.regexp_replace(dense, f"[{char_class}]+", ""))


def japanese_chars(text: Column) -> Column:
    return count_class(text, JAPANESE)


def punctuation_chars(text: Column) -> Column:
    return count_class(text, PUNCTUATION)


def digit_chars(text: Column) -> Column:
    return count_class(text, DIGIT)


def density(text: Column) -> Column:
    """Share of Japanese characters, punctuation and digits; 0 for empty text.

    The middle dot belongs to both the katakana block and the punctuation, counts twice, and may push this past 1.
    It is the only character in two of the classes, so one pass over their union and the dots make the sum.
    """
    dots = F.length(text) - F.length(F.replace(text, F.lit(MIDDLE_DOT), F.lit("")))
    useful = count_class(text, JAPANESE + PUNCTUATION + DIGIT) + dots
    return F.coalesce(F.try_divide(useful.cast("double"), F.length(text).cast("double")), F.lit(0.0))


def starts_valid(text: Column) -> Column:
    """Does the text open with a letter, kana, kanji or digit?

    Emoji are ignored wherever they stand; then whitespace, one run of quote or bracket marks and whitespace again
    may come first. The four classes are disjoint, so one anchored match without backtracking decides.
    """
    return text.rlike(
        rf"\A[{EMOJI}{WHITESPACE}]*+[{EMOJI}{LEADING_MARKS}]*+[{EMOJI}{WHITESPACE}]*+[{JAPANESE}{LATIN}{DIGIT}]"
    )


def contains_kana(text: Column) -> Column:
    return text.rlike(f"[{KANA}]")


def starts_with_emoji(text: Column) -> Column:
    return text.rlike(rf"\A[{EMOJI}]")


def contains_any(text: Column, words) -> Column:
    return reduce(or_, (F.contains(text, F.lit(w)) for w in words), F.lit(False))


def flatten_line_breaks(text: Column) -> Column:
    """Line and paragraph separators become spaces, so a token fits on one line of a table file."""
    return F.translate(text, LINE_BREAKS, " " * len(LINE_BREAKS))


def has_line_breaks(text: Column) -> Column:
    return text.rlike(f"[{LINE_BREAKS}]")
