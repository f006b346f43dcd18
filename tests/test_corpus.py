"""The whole job on a small collection, and its invariants."""

import json
import pathlib
import random

import pytest
from pyspark.sql import functions as F

from checks.inputs import python_script_runs
from textmill.__main__ import main
from textmill.operators import dedup, extract, stats
from textmill.operators.extract import extract_sentences, rate_sentences, segment_documents
from textmill.operators.tokens import PythonAnalyser, ScriptRunAnalyser
from textmill.operators.vocab import flag_unknown_words
from textmill.plans import corpus as plans
from textmill.plans.report import compare_files, compare_splits, render_report
from textmill.sources.documents import DocumentSource
from textmill.storage import staged_names

ANALYSER = ScriptRunAnalyser()
SUBJECTS = ("犬が", "猫が", "鳥は", "東京が", "⭐星が")
VERBS = ("行く。", "走る。", "泳ぐ！", "行き、", "xyz走る。")


def text(i):
    lines = [f"{SUBJECTS[(i + k) % 5]}{VERBS[(i * k) % 5]}２０{(i + k) % 9}に「走る。」と歩く。" for k in range(4)]
    return "\n".join(["犬が行く。犬が行く。", *lines, "", "東京"])


@pytest.fixture(scope="module")
def docs(spark):
    rows = [("web" if i % 3 else "wiki", str(i), text(i)) for i in range(60)]
    return spark.createDataFrame(rows, "source string, doc_id string, text string")


@pytest.fixture(scope="module")
def words(spark):
    listed = ["犬が", "行く", "。", "猫が", "走る", "「", "」", "と", "歩く", "２０", "に", "鳥は", "泳ぐ", "！", "どこか"]
    listed += [f"20{n}" for n in range(9)]
    return spark.createDataFrame([(w, i) for i, w in enumerate(listed)], "word string, rank long")


@pytest.fixture(scope="module")
def corpus(docs, words):
    return plans.build_sentences(docs, words, ANALYSER, 0.3)


def test_every_sentence_has_one_verdict(corpus):
    counts = {r.status: r["count"] for r in corpus.extracted.groupBy("status").count().collect()}
    assert set(counts) <= {"accepted", "rejected", "blank"} and counts["accepted"] > 0 < counts["rejected"]
    assert corpus.extracted.filter((F.col("status") == "rejected") & F.col("raw").isNull()).isEmpty()
    assert corpus.extracted.filter((F.col("status") == "accepted") & F.col("clean").isNull()).isEmpty()


def test_splits_are_disjoint_and_complete(corpus):
    flagged = corpus.flagged.collect()
    assert len({r.clean for r in flagged}) == len(flagged)
    accepted = {r.clean for r in corpus.extracted.filter("status = 'accepted'").collect()}
    assert {r.clean for r in flagged} == accepted
    kept = corpus.sentences.collect()
    assert {r.split for r in kept} == {"train", "validation"}
    assert len(kept) + sum(r.oov for r in flagged) == len(flagged)


def test_retention_equals_the_documents(docs, corpus):
    from textmill.functions.chars import japanese_chars

    want = docs.agg(F.sum(japanese_chars(F.col("text")))).first()[0]
    got = stats.retention(corpus.extracted).first()
    assert got.orig_chars == want and 0 < got.ratio < 1
    per_document = stats.document_retention(corpus.extracted).agg(F.sum("orig_chars"), F.sum("kept_chars")).first()
    assert tuple(per_document) == (got.orig_chars, got.kept_chars)


def test_retention_of_nothing(spark, docs):
    assert stats.retention(extract_sentences(docs.limit(0), ANALYSER)).first().ratio == 0.0


def test_same_result_for_any_partitioning(docs):
    def run(n):
        found = extract_sentences(docs.repartition(n), ANALYSER)
        first = dedup.first_copies(found).collect()
        sample = stats.uniform_sample(dedup.distinct_sentences(found), ["clean"], 5, seed=3).collect()
        return sorted(map(tuple, first)), {r.clean for r in sample}

    assert run(1) == run(4) == run(16)


def test_duplicates_inside_a_document(docs):
    found = extract_sentences(docs, ANALYSER)
    once = dedup.dedup_in_document(found).filter("clean = '犬が行く。'").collect()
    assert len(once) == 60 and {(r.line_no, r.sent_no) for r in once} == {(0, 0)}


def test_verdicts(spark):
    rows = [
        (0, "犬が行く。", None, 0),
        (1, "⭐犬が行く。", None, 0),
        (2, "東京行。", None, 0),
        (3, "犬 is abcdefgh。", None, 0),
        (4, "犬", "no_predicate", 0),
        (5, "", None, 0),
        (6, "(1)犬です。", None, 0),
    ]
    rated = rate_sentences(spark.createDataFrame(rows, "sent_no int, raw string, fault string, orig_chars long"))
    got = {r.sent_no: (r.status, r.reject_reason, r.kept_chars) for r in rated.collect()}
    assert got == {
        0: ("accepted", None, 4),
        1: ("rejected", "bad_start", 0),
        2: ("rejected", "no_kana", 0),
        3: ("rejected", "no_kana", 0),
        4: ("rejected", "no_predicate", 0),
        5: ("blank", None, 0),
        6: ("rejected", "low_density", 0),
    }


def test_filter_on_the_verdict_does_not_repeat_the_cleaning(docs, capsys):
    dedup.distinct_sentences(extract_sentences(docs, ANALYSER)).explain()
    plan = capsys.readouterr().out
    filters = [line for line in plan.splitlines() if "Filter" in line]
    assert filters and not any("regexp_replace" in line for line in filters)
    assert plan.count("Exchange") == 1  # duplicate removal; everything before is narrow


def test_report(corpus, words):
    frequencies = plans.build_frequencies(corpus, words, ANALYSER)
    result = compare_splits(frequencies, words)
    figures = result.figures.first()
    assert figures.union_size == figures.shared + figures.only_train + figures.only_val
    assert figures.coverage_train == figures.coverage_val == 1.0  # the vocabulary filter sees to it
    report = render_report(result)
    assert f"Jaccard (vocabulary overlap): {figures.jaccard:.6f}" in report and "どこか" in report


def test_files(spark, docs, words, tmp_path):
    for name in ("web", "wiki"):
        docs.filter(F.col("source") == name).select("doc_id", "text").write.parquet(f"{tmp_path}/{name}")
    sources = [DocumentSource(n, f"{tmp_path}/{n}", id_cols=("doc_id",)) for n in ("web", "wiki")]
    out = f"{tmp_path}/out"
    corpus = plans.build_corpus(spark, sources, words, ANALYSER, out, val_ratio=0.3)
    written = spark.read.text(f"{out}/sentences")
    assert {(r.split, r.value) for r in written.collect()} == {(r.split, r.clean) for r in corpus.sentences.collect()}
    metadata = {r.split: r for r in spark.read.json(f"{out}/metadata").collect()}
    assert metadata["train"].source == "web, wiki"
    assert sum(r.sentence_count for r in metadata.values()) == written.count()
    for name in ("token_frequencies", "sample_sentences", "rejected_sentences", "rejected_sentences_watch",
                 "split_report", "only_train", "only_validation"):
        assert list(pathlib.Path(f"{out}/{name}").rglob("part-*")), name
    watched = spark.read.text(f"{out}/rejected_sentences_watch").collect()
    assert watched and all("⭐" in r.value for r in watched)
    assert json.loads(next(pathlib.Path(f"{out}/metadata").glob("part-*")).read_text().splitlines()[0])


def test_limited_run(spark, docs, words, tmp_path):
    docs.select("doc_id", "text").write.parquet(f"{tmp_path}/web")
    source = DocumentSource("web", f"{tmp_path}/web", id_cols=("doc_id",))
    assert plans.load_documents(spark, [source], max_docs=7).count() == 7
    assert plans.load_documents(spark, [source]).count() == 60


def test_copies_that_make_up_a_third_of_the_rows(spark, words):
    texts = ["犬が行く。" if i % 3 == 0 else f"犬が行く。{i}に鳥は走る。" for i in range(3_000)]
    rows = [("web", f"{i:05d}", t) for i, t in enumerate(texts)]
    found = extract_sentences(spark.createDataFrame(rows, "source string, doc_id string, text string"), ANALYSER)
    copies = {r.clean: (r.doc_id, r.copies) for r in dedup.first_copies(found).collect()}
    assert copies["犬が行く。"] == ("00000", 3_000) and len(copies) == 2_001
    flagged = flag_unknown_words(dedup.distinct_sentences(found), words, ANALYSER, 0).collect()
    known = {"犬が行く。"} | {f"{i}に鳥は走る。" for i in range(200, 209) if i % 3}  # 200 to 208 are listed
    assert len(flagged) == 2_001 and {r.clean for r in flagged if not r.oov} == known


def test_build_options_and_comparison_from_files(spark, docs, words, tmp_path):
    docs.select("doc_id", "text").write.parquet(f"{tmp_path}/web")
    words.write.parquet(f"{tmp_path}/words.parquet")
    out = f"{tmp_path}/out"
    before = staged_names(spark)
    main(
        ["build", "--source", f"web={tmp_path}/web", "--vocab", f"{tmp_path}/words.parquet", "--output", out,
         "--val-ratio", "0.3", "--max-types", "2"]
    )
    assert staged_names(spark) == before  # nothing is left behind
    assert spark.read.text(f"{out}/token_frequencies").groupBy("split").count().filter("count > 2").isEmpty()
    losses = {(r.step, r.reason): r.n for r in spark.read.json(f"{out}/losses").collect()}
    assert losses["documents without text", "web"] == 0 and sum(losses.values()) > 0
    report = "\n".join(r.value for r in spark.read.text(f"{out}/split_report").collect())
    main(
        ["build", "--source", f"web={tmp_path}/web", "--vocab", f"{tmp_path}/words.parquet", "--output", f"{out}2",
         "--val-ratio", "0.3"]
    )
    full = "\n".join(r.value for r in spark.read.text(f"{out}2/split_report").collect())
    assert report == full  # the figures don't depend on what is written
    main(
        ["compare", "--frequencies", f"{out}2/token_frequencies", "--vocab", f"{tmp_path}/words.parquet", "--output",
         f"{out}3"]
    )
    assert "\n".join(r.value for r in spark.read.text(f"{out}3/split_report").collect()) == full
    assert not compare_files(spark, f"{out}2/token_frequencies/split=train", words, f"{out}4")


def test_a_build_finds_long_texts(spark, words, tmp_path, monkeypatch):
    """Lines of texts above the limit go through pieces; the files are those of a build that reads them whole."""
    long = ["犬が行く。" + f"{i}の猫は走る。「鳥が行く。」" * 40 for i in range(5)]
    spark.createDataFrame([(str(i), t) for i, t in enumerate([*long, "鳥は泳ぐ！", None])], "doc_id string, text string").write.parquet(f"{tmp_path}/docs")
    source = DocumentSource("web", f"{tmp_path}/docs", id_cols=("doc_id",))
    calls, real, cut = [], extract._segment_pieces, extract._pieces
    monkeypatch.setattr(extract, "_pieces", lambda docs, analyser, _: cut(docs, analyser, 30))
    monkeypatch.setattr(extract, "_segment_pieces", lambda pieces: calls.append(pieces.count()) or real(pieces))
    found = []
    for limit in (plans.LONG_BYTES, 1_000):
        monkeypatch.setattr(plans, "LONG_BYTES", limit)
        corpus = plans.build_corpus(spark, [source], words, ANALYSER, f"{tmp_path}/out{limit}")
        rows = corpus.extracted.select("doc_id", "line_no", "sent_no", "raw", "clean", "status").collect()
        found.append((set(rows), len(rows), corpus.extracted.agg(F.sum("orig_chars")).first()[0]))
    assert found[0] == found[1] and len(calls) == 1 and calls[0] >= 10


def test_a_build_stages_no_tokens_that_it_can_find_again(spark, docs, words):
    before = staged_names(spark)
    corpus = plans.build_sentences(docs, words, ANALYSER)
    names = {name.rpartition("-")[0] for name in staged_names(spark) - before}
    assert names == {"extracted", "sentences"}
    flagged = flag_unknown_words(dedup.distinct_sentences(corpus.extracted), words, ANALYSER)
    assert {(r.clean, r.oov) for r in corpus.flagged.collect()} == {(r.clean, r.oov) for r in flagged.collect()}
    tokens = {r.clean for r in corpus.tokens.collect()}
    assert tokens == {r.clean for r in corpus.sentences.collect()} and tokens


def test_segments_of_a_python_analyser_are_those_of_its_arrays(spark):
    """By batches of flags and by column functions over token arrays; one text has no tokens, one fails, one loses characters."""
    rng = random.Random(4)
    parts = ["犬が", "行く", "。", "、", "「", "」", "🧡", "・", "走り", "[[", "略", " ", "が"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(1, 12))).strip() or "犬" for _ in range(300)]
    texts += ["無い。", "失 敗。", " ", "犬が行く。\n失敗。猫が走る。\n無"]
    docs = spark.createDataFrame([("s", str(i), t) for i, t in enumerate(texts)], "source string, doc_id string, text string").coalesce(2)

    def factory():
        analyse = python_script_runs()

        def unsteady(text, mode):
            if "失" in text:
                raise ValueError(text)
            return [] if text.startswith("無") else list(analyse(text.replace("略", ""), mode))

        return unsteady

    analyser = columns = PythonAnalyser(factory)
    by_arrays = type("ByArrays", (), {"max_line_bytes": None, "annotate": columns.annotate})()
    found, want = (sorted(map(tuple, segment_documents(docs, a).collect()), key=str) for a in (analyser, by_arrays))
    assert found == want and {"analyser_error", "no_content"} <= {row[6] for row in found}


def test_a_build_keeps_tokens_only_of_sentences_that_pass(spark):
    docs = spark.createDataFrame([("s", "1", "犬がいる。"), ("s", "2", "謎がいる。")], "source string, doc_id string, text string")
    known = spark.createDataFrame([(w, i) for i, w in enumerate(("犬がいる", "。"))], "word string, rank long")
    before = staged_names(spark)
    corpus = plans.build_sentences(docs, known, PythonAnalyser(python_script_runs))
    assert {r.clean: r.oov for r in corpus.flagged.collect()} == {"犬がいる。": False, "謎がいる。": True}
    assert [[u.surface for u in m.units] for r in corpus.tokens.collect() for m in r.tokens] == [["犬", "がいる", "。"]] * 2 + [["犬がいる", "。"]]
    assert {name.rpartition("-")[0] for name in staged_names(spark) - before} == {"extracted", "sentences"}
