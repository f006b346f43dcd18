"""The registered queries: one per operator or job step, each over whole test tables."""

from __future__ import annotations

import dataclasses
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.inputs import (
    ANALYSER,
    BRACKETED_FROM,
    BRACKETED_TO,
    BLANKS_FROM,
    BLANKS_TO,
    NUMBERED_FROM,
    NUMBERED_TO,
    documents,
    python_script_runs,
    table,
    vocabulary,
)
from textmill import __main__ as command
from textmill.functions import chars, cleaning
from textmill.operators import compare, dedup, freq, lines, outliers, stats, vocab
from textmill.operators.extract import extract_sentences, segment_documents
from textmill.operators.rank import top_n
from textmill.operators.split import TRAIN, VALIDATION, hash_bucket, with_split
from textmill.operators.tokens import PythonAnalyser, explode_tokens, token_table, with_forms
from textmill.plans import corpus as plans
from textmill.plans.report import compare_splits
from textmill.sinks import tables
from textmill.sources.documents import DocumentSource, take_by_hash, union_sources
from textmill.sources.frequencies import read_frequencies
from textmill.sources.vocabulary import read_vocabulary, read_vocabulary_table
from textmill.storage import checkpoint_root, stage_table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

PLACE = ("doc_id", "line_no", "chunk_no", "sent_no")
VOCAB_OVERRIDE = 2_530_791


def query(fn: Query) -> Query:
    """Register ``fn``; integers become bigint, as the SQL twins give."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        df = fn(spark, sf_dir)
        return df.select(
            *(F.col(n).cast("bigint").alias(n) if t == "int" else F.col(n) for n, t in df.dtypes)
        )

    QUERIES[fn.__name__] = run
    return fn


def r6(col) -> F.Column:
    return F.round(col, 6)


# Inputs that several queries share.


def sources(sf_dir: str) -> list[DocumentSource]:
    return [
        DocumentSource("documents", f"{sf_dir}/documents.parquet", id_cols=("doc_id",)),
        DocumentSource("conversations", f"{sf_dir}/conversations.parquet", id_cols=("conv_id", "turn")),
        DocumentSource("pages", f"{sf_dir}/pages.parquet", "html", ("page_id",)),
    ]


def extracted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_sentences(documents(spark, sf_dir), ANALYSER)


def split_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_split(dedup.distinct_sentences(extracted(spark, sf_dir)))


def frequencies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts of all distinct sentences, before the vocabulary filter, with percentiles."""
    counts = freq.token_frequencies(split_distinct(spark, sf_dir), ANALYSER)
    return vocab.attach_percentiles(counts, vocab.percentiles(vocabulary(spark, sf_dir)))


def words(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compare.split_words(freq.collapse_surface(frequencies(spark, sf_dir)))


def flagged(spark: SparkSession, sf_dir: str, **options) -> DataFrame:
    distinct = dedup.distinct_sentences(extracted(spark, sf_dir))
    return vocab.flag_unknown_words(distinct, vocabulary(spark, sf_dir), ANALYSER, **options)


def staged_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = stage_table(extracted(spark, sf_dir), "extracted")
    words = vocabulary(spark, sf_dir)
    return stats.reject_pool(found, vocab.flag_unknown_words(dedup.distinct_sentences(found), words, ANALYSER))


# Sources.


@query
def source_union(spark, sf_dir):
    docs = union_sources(spark, sources(sf_dir))
    return docs.groupBy("source").agg(
        F.count(F.lit(1)).alias("docs"),
        F.sum(F.length("text")).alias("chars"),
        F.min(F.md5("text")).alias("first_digest"),
    )


@query
def docs_by_hash(spark, sf_dir):
    docs = take_by_hash(union_sources(spark, sources(sf_dir)), 200)
    return docs.select("source", "doc_id", F.md5("text").alias("digest"))


@query
def docs_by_hash_large(spark, sf_dir):
    docs = take_by_hash(union_sources(spark, sources(sf_dir)), 1_200)
    return docs.select("source", "doc_id", F.md5("text").alias("digest"))


@query
def line_rows(spark, sf_dir):
    return lines.explode_lines(documents(spark, sf_dir)).drop("source")


@query
def long_line_chunks(spark, sf_dir):
    return lines.explode_chunks(documents(spark, sf_dir), max_bytes=2_000, chunk_chars=500).drop("source")


# Characters.


@query
def character_counts(spark, sf_dir):
    text = F.col("text")
    return documents(spark, sf_dir).select(
        "doc_id",
        F.length(text).alias("chars"),
        F.octet_length(text).alias("bytes"),
        chars.japanese_chars(text).alias("japanese"),
        chars.punctuation_chars(text).alias("punctuation"),
        chars.digit_chars(text).alias("digits"),
        r6(chars.density(text)).alias("density"),
        F.md5(text).alias("digest"),
    )


@query
def line_tests(spark, sf_dir):
    line = F.col("line")
    return lines.explode_lines(documents(spark, sf_dir)).select(
        "doc_id",
        "line_no",
        chars.starts_valid(line).alias("starts_valid"),
        chars.contains_kana(line).alias("has_kana"),
        chars.starts_with_emoji(line).alias("emoji_first"),
        chars.contains_any(line, stats.WATCH_WORDS).alias("watched"),
        (chars.density(line) >= 0.75).alias("dense"),
    )


@query
def unicode_strip(spark, sf_dir):
    text = F.translate(F.col("text"), BLANKS_FROM, BLANKS_TO)
    piece = F.col("piece")
    return (
        table(spark, sf_dir, "documents")
        .select("doc_id", F.posexplode(F.split(text, " ")).alias("piece_no", "piece"))
        .select(
            "doc_id",
            "piece_no",
            chars.strip(piece).alias("stripped"),
            F.length(chars.lstrip(piece)).alias("left_length"),
            F.length(chars.rstrip(piece)).alias("right_length"),
            chars.remove_whitespace(piece).alias("compact"),
        )
    )


@query
def token_cleaning(spark, sf_dir):
    text = F.translate(F.col("text"), "eta", f"{chr(0x2028)}{chr(0x2029)}\r")
    return table(spark, sf_dir, "documents").select(
        "doc_id", chars.flatten_line_breaks(text).alias("flat")
    )


# Cleaning.


def _cleaned_lines(spark, sf_dir, source: str, target: str, fn) -> DataFrame:
    line = F.col("line")
    docs = table(spark, sf_dir, "documents").select(
        F.lit("documents").alias("source"), "doc_id", F.translate("text", source, target).alias("text")
    )
    return lines.explode_lines(docs).select("doc_id", "line_no", fn(line).alias("text"))


@query
def leading_marks(spark, sf_dir):
    return _cleaned_lines(spark, sf_dir, NUMBERED_FROM, NUMBERED_TO, cleaning.strip_leading_marks)


@query
def list_numbers(spark, sf_dir):
    return _cleaned_lines(spark, sf_dir, NUMBERED_FROM, NUMBERED_TO, cleaning.strip_list_number)


@query
def matched_brackets(spark, sf_dir):
    return _cleaned_lines(spark, sf_dir, BRACKETED_FROM, BRACKETED_TO, cleaning.strip_matched_brackets)


@query
def unbalanced_brackets(spark, sf_dir):
    return _cleaned_lines(spark, sf_dir, BRACKETED_FROM, BRACKETED_TO, cleaning.strip_unbalanced_brackets)


# Tokens.


def _token_counts(spark, sf_dir, mode: str) -> DataFrame:
    chunks = lines.explode_chunks(documents(spark, sf_dir), max_bytes=None)
    units = chunks.select(F.explode(ANALYSER.units(F.col("chunk"), mode)).alias("unit"))
    return with_forms(units.groupBy("unit").agg(F.count(F.lit(1)).alias("cnt")), ANALYSER)


@query
def tokens_mode_a(spark, sf_dir):
    return _token_counts(spark, sf_dir, "A")


@query
def tokens_mode_b(spark, sf_dir):
    return _token_counts(spark, sf_dir, "B")


@query
def tokens_mode_c(spark, sf_dir):
    return _token_counts(spark, sf_dir, "C")


@query
def token_tags(spark, sf_dir):
    tokens = explode_tokens(lines.explode_chunks(documents(spark, sf_dir), max_bytes=None), ANALYSER)
    tags = ("word_class", "sub_class", "conjugation")
    # The largest string of a group takes a sort of its rows: types are sorted, tokens are counted in hash tables.
    types = tokens.groupBy(*tags, "surface", "normalized").agg(F.count(F.lit(1)).alias("n"), F.max("pos").alias("last"))
    return types.groupBy(*tags).agg(
        F.sum("n").alias("tokens"),
        F.countDistinct("surface").alias("surfaces"),
        F.max("last").alias("last_pos"),
        F.max("normalized").alias("last_form"),
    )


@query
def top_tokens(spark, sf_dir):
    counts = freq.token_frequencies(documents(spark, sf_dir), ANALYSER, by=(), text_col="text")
    return freq.top_types(counts, 2_000, by=())


# Sentences.


@query
def sentence_rows(spark, sf_dir):
    found = segment_documents(documents(spark, sf_dir), ANALYSER)
    return found.filter(F.col("raw") != "").select(*PLACE, "raw", "fault")


@query
def sentence_rows_chunked(spark, sf_dir):
    found = segment_documents(documents(spark, sf_dir), ANALYSER, max_bytes=1_000, chunk_chars=200)
    return found.filter(F.col("raw") != "").select(*PLACE, "raw", "fault")


@query
def sentence_rows_in_pieces(spark, sf_dir):
    """Lines of most texts cut between any tokens, the state carried from piece to piece."""
    found = segment_documents(documents(spark, sf_dir), ANALYSER, long_bytes=400, piece_chars=25)
    return found.filter(F.col("raw") != "").select(*PLACE, "raw", "fault")


@query
def rated_sentences(spark, sf_dir):
    found = extracted(spark, sf_dir).filter(F.col("status") != "blank")
    return found.select(*PLACE, "clean", r6("density").alias("density"), "reject_reason", "status", "kept_chars")


@query
def reject_reasons(spark, sf_dir):
    return stats.reject_reasons(extracted(spark, sf_dir).filter(F.col("status") == "rejected"))


@query
def dedup_in_document(spark, sf_dir):
    return dedup.dedup_in_document(extracted(spark, sf_dir)).select(*PLACE, "clean")


@query
def dedup_global(spark, sf_dir):
    return dedup.distinct_sentences(extracted(spark, sf_dir))


@query
def dedup_first_copy(spark, sf_dir):
    return dedup.first_copies(extracted(spark, sf_dir)).select("clean", *PLACE, "copies")


@query
def hash_split(spark, sf_dir):
    return split_distinct(spark, sf_dir).select("clean", hash_bucket(F.col("clean")).alias("bucket"), "split")


@query
def split_sizes(spark, sf_dir):
    sentences = with_split(dedup.distinct_sentences(extracted(spark, sf_dir)), 0.25)
    return sentences.groupBy("split").agg(F.count(F.lit(1)).alias("sentences"))


# Vocabulary.


@query
def vocabulary_percentiles(spark, sf_dir):
    ranked = vocabulary(spark, sf_dir)
    return vocab.percentiles(ranked).select("word", r6("percentile").alias("percentile"))


@query
def vocabulary_filter(spark, sf_dir):
    return flagged(spark, sf_dir)


@query
def vocabulary_filter_shuffled(spark, sf_dir):
    """As for a vocabulary too large to broadcast."""
    return flagged(spark, sf_dir, broadcast_limit=0)


@query
def percentile_lookup(spark, sf_dir):
    found = frequencies(spark, sf_dir)
    return found.select("split", "surface", "normalized", r6("percentile").alias("percentile"))


@query
def vocabulary_absent(spark, sf_dir):
    ranked = stage_table(vocabulary(spark, sf_dir), "vocabulary")
    counts = freq.token_frequencies(split_distinct(spark, sf_dir), ANALYSER)
    found = freq.collapse_surface(vocab.attach_percentiles(counts, vocab.percentiles(ranked)))
    absent = vocab.absent_words(ranked, found)
    top = top_n(absent, [F.asc("rank")], compare.REPORT_ROWS)
    return top.select("word", "rank", r6("percentile").alias("percentile"))


# Frequencies.


@query
def token_frequencies(spark, sf_dir):
    return freq.token_frequencies(split_distinct(spark, sf_dir), ANALYSER)


@query
def token_frequencies_from_table(spark, sf_dir):
    """Counts from a staged token table, filled by a Python analyser."""
    table = stage_table(token_table(split_distinct(spark, sf_dir), PythonAnalyser(python_script_runs)), "tokens")
    return freq.token_frequencies(table, PythonAnalyser(python_script_runs))


@query
def top_types(spark, sf_dir):
    return freq.top_types(freq.token_frequencies(split_distinct(spark, sf_dir), ANALYSER), 1_000)


@query
def surface_counts(spark, sf_dir):
    found = freq.collapse_surface(frequencies(spark, sf_dir))
    return found.withColumn("percentile", r6("percentile"))


# Statistics.


@query
def document_retention(spark, sf_dir):
    return stats.document_retention(extracted(spark, sf_dir)).drop("source")


@query
def retention_ratio(spark, sf_dir):
    found = stats.retention(extracted(spark, sf_dir))
    return found.withColumn("ratio", r6("ratio"))


@query
def split_metadata(spark, sf_dir):
    found = stage_table(extracted(spark, sf_dir), "extracted")
    ratio = stats.retention(found).first()["ratio"]
    return stats.split_metadata(with_split(dedup.distinct_sentences(found)), ratio, {"documents": "documents.parquet"})


@query
def reject_pool(spark, sf_dir):
    found = staged_rejects(spark, sf_dir)
    return found.groupBy("text", "reject_reason").agg(F.count(F.lit(1)).alias("copies"))


@query
def watched_rejects(spark, sf_dir):
    found = stats.watched(staged_rejects(spark, sf_dir))
    return stats.uniform_sample(found, ["place", "text"], stats.WATCH_SAMPLE_SIZE)


@query
def sampled_rejects(spark, sf_dir):
    return stats.uniform_sample(staged_rejects(spark, sf_dir), ["place", "text"], seed=7)


@query
def sampled_rejects_per_split(spark, sf_dir):
    found = stats.watched(staged_rejects(spark, sf_dir))
    return stats.sample_per_split(found, stats.SAMPLE_SIZE, seed=7)


@query
def sampled_sentences(spark, sf_dir):
    return stats.uniform_sample(split_distinct(spark, sf_dir), ["clean"], seed=7, by=["split"])


@query
def top_sentences_by_text(spark, sf_dir):
    return stats.top_by_text(dedup.distinct_sentences(extracted(spark, sf_dir)))


# Comparison.


@query
def split_similarity(spark, sf_dir):
    size = vocabulary(spark, sf_dir).count()
    found = compare.similarity(words(spark, sf_dir), size)
    return found.select(*(r6(n).alias(n) if t == "double" else F.col(n) for n, t in found.dtypes))


@query
def split_similarity_fixed_list(spark, sf_dir):
    found = compare.similarity(words(spark, sf_dir), VOCAB_OVERRIDE)
    return found.select(r6("jaccard_train_vocab").alias("train"), r6("jaccard_val_vocab").alias("validation"))


@query
def split_topography(spark, sf_dir):
    return compare.topography(words(spark, sf_dir))


@query
def split_word_sets(spark, sf_dir):
    return compare.union_words(freq.collapse_surface(frequencies(spark, sf_dir)))


@query
def train_only_words(spark, sf_dir):
    return compare.only_in(words(spark, sf_dir), TRAIN)


@query
def validation_only_top(spark, sf_dir):
    return compare.most_frequent(compare.only_in(words(spark, sf_dir), VALIDATION))


@query
def unknown_words_top(spark, sf_dir):
    found = stage_table(words(spark, sf_dir), "words")
    parts = [
        compare.most_frequent(compare.unknown_in(found, s)).withColumn("split", F.lit(s)) for s in (TRAIN, VALIDATION)
    ]
    return parts[0].unionByName(parts[1])


@query
def percentile_gap_outliers(spark, sf_dir):
    train = frequencies(spark, sf_dir).filter(F.col("split") == TRAIN)
    found = outliers.largest_gaps(outliers.percentile_gaps(train))
    return found.select("surface", "cnt_c", *(r6(c).alias(c) for c in ("observed", "listed", "gap", "abs_gap")))


# Files and whole jobs.


def _new_folder(spark: SparkSession) -> str:
    return f"{checkpoint_root(spark)}/textmill/{uuid.uuid4().hex}"


@query
def corpus_files(spark, sf_dir):
    path = _new_folder(spark)
    tables.write_corpus(split_distinct(spark, sf_dir), path, files=8)
    return spark.read.text(path).select("split", F.col("value").alias("clean"))


@query
def frequency_files(spark, sf_dir):
    path = _new_folder(spark)
    top = freq.top_types(freq.token_frequencies(split_distinct(spark, sf_dir), ANALYSER), 1_000)
    ranked = vocab.percentiles(vocabulary(spark, sf_dir))
    tables.write_frequencies(vocab.attach_percentiles(top, ranked), path)
    parts = [
        read_frequencies(spark, f"{path}/split={s}").withColumn("split", F.lit(s)) for s in (TRAIN, VALIDATION)
    ]
    return parts[0].unionByName(parts[1])


@query
def corpus_build(spark, sf_dir):
    """The whole job up to the report's figures, on the sentences that pass the vocabulary filter."""
    ranked = stage_table(vocabulary(spark, sf_dir), "vocabulary")
    corpus = plans.build_sentences(documents(spark, sf_dir), ranked, ANALYSER)
    found = compare_splits(plans.build_frequencies(corpus, ranked, ANALYSER), ranked).figures
    return found.select(*(r6(n).alias(n) if t == "double" else F.col(n) for n, t in found.dtypes))


@query
def corpus_build_with_python_analyser(spark, sf_dir):
    """The same job with an analyser written in Python, which segments, tags and normalizes."""
    analyser = PythonAnalyser(python_script_runs)
    ranked = stage_table(vocabulary(spark, sf_dir), "vocabulary")
    corpus = plans.build_sentences(documents(spark, sf_dir), ranked, analyser)
    found = compare_splits(plans.build_frequencies(corpus, ranked, analyser), ranked).figures
    return found.select(*(r6(n).alias(n) if t == "double" else F.col(n) for n, t in found.dtypes))


@query
def build_outputs(spark, sf_dir):
    """A whole build by its command line, one collection switched off: every line of the files it writes."""
    folder = _new_folder(spark)
    documents(spark, sf_dir).select("text").write.parquet(f"{folder}/documents")
    vocabulary(spark, sf_dir).write.parquet(f"{folder}/words.parquet")
    args = command.parse(
        ["build", "--source", f"documents={folder}/documents", "--source", f"conversations={sf_dir}/conversations.parquet"]
        + ["--include", "conversations=false", "--vocab", f"{folder}/words.parquet", "--output", f"{folder}/out"]
    )
    words = read_vocabulary_table(spark, args.vocab)
    plans.build_corpus(spark, command.document_sources(args), words, ANALYSER, args.output)
    names = ("sentences", "token_frequencies", "token_frequencies_header", "sample_sentences", "only_train", "only_validation", "split_report")
    parts = [spark.read.option("lineSep", "\n").text(f"{args.output}/{name}").withColumn("file", F.lit(name)) for name in names]
    parts = [p if "split" in p.columns else p.withColumn("split", F.lit("")) for p in parts]
    found = parts[0]
    for part in parts[1:]:
        found = found.unionByName(part)
    return found.select("file", "split", F.col("value").alias("line"))


@query
def source_switch(spark, sf_dir):
    """One collection switched off."""
    chosen = [dataclasses.replace(s, enabled=s.name != "conversations") for s in sources(sf_dir)]
    docs = union_sources(spark, chosen)
    return docs.groupBy("source").agg(F.count(F.lit(1)).alias("docs"), F.min(F.md5("text")).alias("first_digest"))


@query
def smoke_documents(spark, sf_dir):
    """A limited run reads the smoke path."""
    source = DocumentSource("documents", f"{sf_dir}/none", id_cols=("doc_id",), smoke_path=f"{sf_dir}/documents.parquet")
    docs = plans.load_documents(spark, [source], max_docs=50)
    return docs.select("source", "doc_id", F.md5("text").alias("digest"))


@query
def vocabulary_file(spark, sf_dir):
    """A word list written as text, several files of it, and read back."""
    path = _new_folder(spark)
    ordered = vocabulary(spark, sf_dir).repartitionByRange(5, "rank").sortWithinPartitions("rank")
    ordered.select("word").write.text(path)
    return read_vocabulary(spark, path)


@query
def outlier_file(spark, sf_dir):
    """Outliers of a frequency table read back from its file, words that begin with # included."""
    path = _new_folder(spark)
    tables.write_frequencies(freq.top_types(frequencies(spark, sf_dir)), path)
    found = read_frequencies(spark, f"{path}/split={TRAIN}", min_fields=6)
    found = outliers.largest_gaps(outliers.percentile_gaps(found))
    return found.select("surface", "cnt_c", *(r6(c).alias(c) for c in ("observed", "listed", "gap", "abs_gap")))


@query
def sample_files(spark, sf_dir):
    path = _new_folder(spark)
    sample = stats.uniform_sample(split_distinct(spark, sf_dir), ["clean"], seed=7, by=["split"])
    tables.write_small_text(sample, path, "clean")
    return spark.read.text(path).select("split", F.col("value").alias("clean"))


@query
def metadata_file(spark, sf_dir):
    path = _new_folder(spark)
    found = stage_table(extracted(spark, sf_dir), "extracted")
    ratio = stats.retention(found).first()["ratio"]
    sentences = with_split(dedup.distinct_sentences(found))
    tables.write_metadata(stats.split_metadata(sentences, ratio, {"documents": "documents.parquet"}), path)
    return spark.read.json(path)


@query
def train_only_file(spark, sf_dir):
    path = _new_folder(spark)
    tables.write_counts(compare.only_in(words(spark, sf_dir), TRAIN), path)
    return spark.read.text(path).select(F.col("value").alias("line"))


@query
def comparison_from_files(spark, sf_dir):
    """The comparison's figures from written frequency tables."""
    path = _new_folder(spark)
    tables.write_frequencies(freq.top_types(frequencies(spark, sf_dir)), path)
    found = compare_splits(read_frequencies(spark, path), stage_table(vocabulary(spark, sf_dir), "vocabulary")).figures
    return found.select(*(r6(n).alias(n) if t == "double" else F.col(n) for n, t in found.dtypes))
