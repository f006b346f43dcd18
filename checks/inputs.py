"""Japanese-looking input derived from the test tables, whose text is Latin.

Every letter and sign is mapped to one kana, kanji or Japanese mark, over the whole tables. Function words of the
languages come out as particles, frequent word endings as verb endings, junk signs as quotes, brackets and emoji, so
every rule has something to decide. Accented letters stay as they are and bring the density below its limit.
"""

from __future__ import annotations

import re
from functools import lru_cache

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from textmill.functions.chars import WHITESPACE_CHARS
from textmill.operators import tokens as t
from textmill.operators.rank import global_rank
from textmill.operators.tokens import ScriptRunAnalyser, Tags
from textmill.sources.documents import DocumentSource, read_documents, spread
from textmill.storage import stage_table

ANALYSER = ScriptRunAnalyser()

LETTERS = {
    "a": "が", "b": "ば", "c": "か", "d": "た", "e": "ん", "f": "ふ", "g": "く", "h": "は", "i": "と",
    "j": "じ", "k": "む", "l": "の", "m": "も", "n": "ら", "o": "に", "p": "ぷ", "q": "　", "r": "り",
    "s": "ね", "t": "て", "u": "を", "v": "ぼ", "w": "わ", "x": "っ", "y": "す", "z": "ざ",
    "A": "亜", "B": "美", "C": "千", "D": "ダ", "E": "江", "F": "フ", "G": "ゴ", "H": "ハ", "I": "井",
    "J": "ジ", "K": "カ", "L": "ル", "M": "マ", "N": "奈", "O": "尾", "P": "パ", "Q": "ク", "R": "ラ",
    "S": "サ", "T": "東", "U": "宇", "V": "ヴ", "W": "ワ", "X": "エ", "Y": "ヤ", "Z": "ザ",
    ".": "。", ",": "、", "!": "！", "?": "？", "%": "「", "*": "」", "&": "（", "$": "）", "|": "🧡",
    "#": "⭐", '"': "‥", "-": "・", "+": "［", "=": "］", "1": "１", "2": "２",
}
FROM, TO = "".join(LETTERS), "".join(LETTERS.values())

# Frequent letters turned into brackets, blanks or list numbers, for the rules about edges of a text.
BRACKETED_FROM, BRACKETED_TO = "TEOAINenthao ", "（(「［［【）)」］】」 "
BLANKS_FROM = "etaonETOA"
BLANKS_TO = "".join(map(chr, (0x3000, 0xA0, 0x2028, 0x1F, 0x85, 0x2003, 0x1680, 0xB, 0x200B)))
NUMBERED_FROM, NUMBERED_TO = "TEOAIDLnesrh", "1２>：３＞4)．.）:"


def japanese(text: Column) -> Column:
    return F.translate(text, FROM, TO)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_documents(spark, DocumentSource("documents", f"{sf_dir}/documents.parquet", id_cols=("doc_id",)))
    return spread(docs).withColumn("text", japanese(F.col("text")))


def vocabulary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mode-C words of the benchmark and the conversations, most frequent first."""
    benchmark, conversations = (table(spark, sf_dir, n).select("text") for n in ("benchmark", "conversations"))
    texts = benchmark.unionAll(conversations)
    words = texts.select(F.explode(ANALYSER.surfaces(japanese(F.col("text")), "C")).alias("word"))
    counted = words.groupBy("word").count()
    ranked = global_rank(stage_table(counted, "words"), [F.desc("count"), F.asc("word")])
    return ranked.select("word", (F.col("rank") - 1).alias("rank"))


def python_script_runs():
    """The built-in analyser once more as a user would write one, for :class:`PythonAnalyser`."""
    code_point = lambda m: chr(int(m[1], 16))
    patterns = {mode: re.compile(re.sub(r"\\x\{(\w+)\}", code_point, p)) for mode, p in ANALYSER.PATTERNS.items()}
    fold = str.maketrans(ANALYSER.FOLD_FROM, ANALYSER.FOLD_TO)
    emoji = re.compile("[" + re.sub(r"\\x\{(\w+)\}", code_point, t.EMOJI) + "]")
    symbol, particle, final = Tags(t.SYMBOL), Tags(t.PARTICLE), "終止形-一般"
    by_surface: dict[str, Tags] = {}
    for surfaces, tags in (
        (ANALYSER.AUXILIARIES, Tags(t.AUXILIARY, conjugation=final)),
        (ANALYSER.OTHER_PARTICLES, particle),
        (ANALYSER.PARTICLES, particle),
        (ANALYSER.SYMBOLS, symbol),
        ((*t.CUT_OFF_MARKS, *t.QUOTE_CLOSE, *t.QUOTE_OPEN), symbol),
        (ANALYSER.COMMAS, Tags(t.SYMBOL, t.COMMA)),
        (ANALYSER.STOPS, Tags(t.SYMBOL, t.FULL_STOP)),
        (WHITESPACE_CHARS, Tags(t.BLANK)),
    ):
        by_surface |= dict.fromkeys(surfaces, tags)

    def tags_of(surface):
        if surface in by_surface:
            return by_surface[surface]
        if surface[-1] in ANALYSER.CONCLUSIVE_ENDINGS:
            return Tags(t.VERB, conjugation=final)
        if surface[-1] in ANALYSER.CONTINUATIVE_ENDINGS:
            return Tags(t.VERB, conjugation="連用形-一般")
        if surface[-1] in ANALYSER.ADJECTIVE_ENDINGS:
            return Tags(t.ADJECTIVE, conjugation=final)
        return symbol if emoji.match(surface) else Tags("名詞")

    @lru_cache(1 << 16)
    def token(surface):
        return surface, surface.translate(fold), *tags_of(surface)

    def analyse(text, mode):
        return map(token, patterns[mode].findall(text))

    return analyse
