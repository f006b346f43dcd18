"""Quality rules over a collection: cross-document line frequency.

Normalised lines (lower case, blanks collapsed) are hashed and the distinct documents that hold them are counted per
host. A line above the limits is boilerplate there: it is removed from every document but the host's first (smallest
id) that has it, and a document with too little left is rejected. Rows with the same text count as one document, so a
group of exact copies doesn't make its own lines boilerplate; any other difference makes another document.

Everything is column expressions. One pass over the texts writes counts and line hashes to the shared folder; the two
shuffles after it move hashes. Hot lines are combined in the map tasks before counting and dealt to several tasks when
they are looked up; a hot host is spread by its lines.

Edge cases: a null text has no words or lines and fails the base rules; null hosts form one host; a null id is never
the first; repeated rows are rated one by one, alike; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textmill.llm.common import BLANKS, pick, salted, words
from textmill.storage import stage_table

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
MAX_LINE_DOCS = 20
MAX_LINE_PER_MILLE = 5
ALWAYS_LINE_DOCS = 1_000  # more make a line boilerplate in a host of any size
MIN_LEFT_WORDS = 50
MIN_LEFT_PERCENT = 30
_SALTS = 16


def _window_places(tokens: Column, size: int) -> Column:
    """Start places of all windows of ``size`` words; empty for shorter texts."""
    last = F.size(tokens) - size
    return F.when(last >= 0, F.sequence(F.lit(0), last)).otherwise(F.array().cast("array<int>"))


def _n_repeat_words(windows: Column) -> Column:
    """Words inside three-word windows that the text has twice or more.

    ``windows`` holds (hash, place) sorted by hash, so equal windows are neighbours. The places of repeated ones, in
    order, cover three words each less what the next one covers.
    """
    hash_at = lambda i: F.get(windows, i)["h"]
    repeated = F.filter(windows, lambda w, i: (w["h"] == hash_at(i - 1)) | (w["h"] == hash_at(i + 1)))
    places = F.sort_array(F.transform(repeated, lambda w: w["p"]))
    start = F.struct(F.lit(-3).alias("last"), F.lit(0).alias("n"))
    return F.aggregate(
        places,
        start,
        lambda acc, p: F.struct(p.alias("last"), (acc["n"] + F.least(F.lit(3), p - acc["last"])).alias("n")),
        lambda acc: acc["n"].cast("long"),
    )


def text_counts(docs: DataFrame, id_col: str, text_col: str, host_col: str) -> DataFrame:
    """Counts of each text, its lines as (hash, words) and the hash of the whole text."""
    blank = lambda line: F.length(F.regexp_replace(line, BLANKS, "")) == 0
    normal = lambda line: F.lower(F.trim(F.regexp_replace(line, BLANKS, " ")))
    picked = pick(docs, id=id_col, text=text_col, host=host_col).withColumn("text", F.coalesce("text", F.lit("")))
    tokens, lines = F.col("tokens"), F.col("lines")
    cut = picked.select(
        "id",
        "host",
        "text",
        words(F.col("text")).alias("tokens"),
        F.split("text", "\n").alias("lines"),
    )
    hashed = cut.select(
        "id",
        "host",
        F.xxhash64("text").alias("content"),
        F.size(tokens).cast("long").alias("n_words"),
        F.length(F.regexp_replace("text", BLANKS, "")).cast("long").alias("word_chars"),
        F.regexp_count("text", F.lit(r"[#*$%&|<>]")).cast("long").alias("n_symbols"),
        F.filter(lines, lambda line: ~blank(line)).alias("worded"),
        F.array_sort(
            F.transform(
                _window_places(tokens, 3), lambda i: F.struct(F.xxhash64(*(F.get(tokens, i + k) for k in range(3))).alias("h"), i.alias("p"))
            )
        ).alias("windows"),
        F.transform(
            lines,
            lambda line: F.struct(F.xxhash64(normal(line)).alias("h"), F.size(words(line)).alias("n")),
        ).alias("lines"),
    )
    return hashed.select(
        "id",
        "host",
        "content",
        "n_words",
        "word_chars",
        "n_symbols",
        (F.size("worded") - F.size(F.array_distinct("worded"))).cast("long").alias("n_dup_lines"),
        _n_repeat_words(F.col("windows")).alias("n_repeat_words"),
        "lines",
    )


def frequent_lines(lines: DataFrame, counts: DataFrame, max_docs: int, max_per_mille: int, always: int) -> DataFrame:
    """(host, h, first_id) of lines in more than ``max_docs`` distinct documents of their host, if these are more than
    ``max_per_mille`` of its documents or more than ``always``. ``counts`` has one row per document.
    """
    counted = lines.groupBy("host", "h").agg(
        F.count_distinct("content").alias("n_docs"), F.min("id").alias("first_id")
    )
    hosts = counts.filter("n_words > 0").groupBy(F.col("host").alias("_host")).agg(F.count_distinct("content").alias("host_docs"))
    above = counted.filter(F.col("n_docs") > max_docs)
    return (
        above.join(hosts, F.col("host").eqNullSafe(F.col("_host")))
        .filter((F.col("n_docs") * 1000 > F.col("host_docs") * max_per_mille) | (F.col("n_docs") > always))
        .select("host", "h", "first_id")
    )


def rate_documents(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    host_col: str = "source",
    max_line_docs: int = MAX_LINE_DOCS,
    max_line_per_mille: int = MAX_LINE_PER_MILLE,
    always_line_docs: int = ALWAYS_LINE_DOCS,
    min_left_words: int = MIN_LEFT_WORDS,
    min_left_percent: int = MIN_LEFT_PERCENT,
) -> DataFrame:
    """One row per row of ``docs``: id, host, content (hash of the text), the counts, ``base_failed``, ``kept``,
    ``n_left`` (words outside removed lines) and ``removed`` (0-based places of removed lines, null for none).
    """
    counts = stage_table(text_counts(docs, id_col, text_col, host_col), "quality-counts")
    lines = counts.select("id", "host", "content", F.posexplode("lines").alias("place", "line")).select(
        "id", "host", "content", "place", F.col("line.h").alias("h"), F.col("line.n").alias("n")
    )
    lines = lines.filter(F.col("n") > 0)
    frequent = frequent_lines(lines, counts, max_line_docs, max_line_per_mille, always_line_docs)
    hits = salted(lines, frequent, ["host", "h"], _SALTS, F.col("content"))
    hits = hits.filter(~F.col("id").eqNullSafe(F.col("first_id"))).select(
        F.col("id").alias("_id"), F.col("host").alias("_host"), F.col("content").alias("_content"), "place", "n"
    )
    key = ["_id", "_host", "_content"]
    removed = (
        hits.dropDuplicates([*key, "place"])  # repeated rows have the same lines
        .groupBy(*key)
        .agg(F.sum("n").alias("n_removed"), F.collect_set("place").alias("removed"))
    )
    same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in ("id", "host", "content")]
    left = F.col("n_words") - F.coalesce("n_removed", F.lit(0))
    base_failed = (F.col("n_words") < MIN_WORDS) | (
        F.col("n_repeat_words") * 100 > F.col("n_words") * MAX_REPEAT_PERCENT
    )
    depleted = F.col("n_removed").isNotNull() & (
        (left < min_left_words) | (left * 100 < F.col("n_words") * min_left_percent)
    )
    return counts.join(removed, same, "left").select(
        "id",
        "host",
        "content",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        base_failed.alias("base_failed"),
        (~base_failed & ~depleted).alias("kept"),
        left.alias("n_left"),
        "removed",
    )


def without_lines(text: Column, removed: Column) -> Column:
    """``text`` without the lines at the given places."""
    kept = F.filter(F.split(text, "\n"), lambda line, i: ~F.array_contains(removed, i))
    return F.when(removed.isNull(), text).otherwise(F.array_join(kept, "\n"))


def keep_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source") -> DataFrame:
    """The rows of ``docs`` that :func:`rate_documents` keeps, their texts without the removed lines."""
    rated = rate_documents(docs, id_col, text_col, host_col).filter("kept")
    rated = rated.select(*(F.col(c).alias(f"_q_{c}") for c in ("id", "host", "content", "removed")))
    rated = rated.dropDuplicates(["_q_id", "_q_host", "_q_content"])  # repeated rows are rated alike
    text = F.col(f"`{text_col}`")
    same = (
        F.col(f"`{id_col}`").eqNullSafe(F.col("_q_id"))
        & F.col(f"`{host_col}`").eqNullSafe(F.col("_q_host"))
        & (F.xxhash64(F.coalesce(text, F.lit(""))) == F.col("_q_content"))
    )
    kept = docs.join(rated, same).withColumn(text_col, without_lines(text, F.col("_q_removed")))
    return kept.select(*docs.columns)
