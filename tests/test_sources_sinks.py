import gzip
import hashlib
import json
import pathlib

import pytest
from pyspark.sql import functions as F

from textmill import storage
from textmill.__main__ import document_sources, parse
from textmill.operators import freq
from textmill.sinks import tables
from textmill.sources.documents import (
    TASKS_PER_CORE,
    DocumentSource,
    null_documents,
    read_documents,
    spread,
    take_by_hash,
    union_sources,
)
from textmill.sources.frequencies import count_bad_lines, read_frequencies
from textmill.sources.vocabulary import read_vocabulary, read_vocabulary_table
from textmill.storage import stage_table


@pytest.fixture
def collections(spark, tmp_path):
    rows = [(i, f"文{i}。") for i in range(40)] + [(40, None)]
    spark.createDataFrame(rows, "id int, text string").repartition(3).write.parquet(f"{tmp_path}/web")
    spark.createDataFrame([("百科",), ("百科",)], "body string").coalesce(1).write.parquet(f"{tmp_path}/wiki")
    return [
        DocumentSource("web", f"{tmp_path}/web/*.parquet", id_cols=("id",)),
        DocumentSource("wiki", f"{tmp_path}/wiki", text_col="body"),
    ]


def test_union_drops_null_texts_and_names_rows(spark, collections):
    docs = union_sources(spark, collections).collect()
    assert len(docs) == 42 and len({(d.source, d.doc_id) for d in docs}) == 42
    assert sum(d.source == "wiki" for d in docs) == 2


def test_sources_switch_off(spark, collections):
    args = parse(
        ["build", "--vocab", "v", "--source", "a=p1", "--source", "b=p2", "--include", "b=False", "--smoke", "a=p0"]
    )
    sources = document_sources(args)
    assert [(s.name, s.enabled, s.smoke_path) for s in sources] == [("a", True, "p0"), ("b", False, None)]
    with pytest.raises(ValueError):
        union_sources(spark, [DocumentSource("web", "nowhere", enabled=False)])


def test_smoke_path(spark, collections, tmp_path):
    source = DocumentSource("web", "nowhere", id_cols=("id",), smoke_path=f"{tmp_path}/web")
    assert union_sources(spark, [source], smoke=True).count() == 40


@pytest.mark.parametrize("n", [1, 10, 41, 42, 2_000])
def test_take_by_hash(spark, collections, n):
    docs = union_sources(spark, collections)
    texts = sorted((r.text for r in docs.collect()), key=lambda t: hashlib.md5(t.encode()).hexdigest(), reverse=True)
    got = [r.text for r in take_by_hash(docs, n).collect()]
    assert sorted(got) == sorted(texts[:n])


def test_spread(spark, collections):
    docs = union_sources(spark, collections)
    assert spread(docs, 16).rdd.getNumPartitions() == 16 * TASKS_PER_CORE
    assert spread(docs, 1).rdd.getNumPartitions() == docs.rdd.getNumPartitions()
    assert spread(docs, 16).count() == 42


def test_only_needed_columns_are_scanned(spark, collections, capsys):
    union_sources(spark, collections[:1]).select("text").explain("formatted")
    assert "ReadSchema: struct<text:string>" in capsys.readouterr().out


def test_vocabulary_file(spark, tmp_path):
    path = tmp_path / "words.txt"
    path.write_text("の\n\n  犬 \r\n　\nの\nfoo bar\n", encoding="utf-8")
    got = [(r["rank"], r["word"]) for r in read_vocabulary(spark, str(path)).orderBy("rank").collect()]
    assert got == [(0, "の"), (1, "犬"), (2, "の"), (3, "foo bar")]


def test_vocabulary_keeps_file_order_over_many_splits(spark, tmp_path):
    path = tmp_path / "words.txt"
    path.write_text("\n".join(f"w{i}" for i in range(200_000)), encoding="utf-8")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "100k")
    try:
        assert spark.read.text(str(path)).rdd.getNumPartitions() > 1
        ranked = stage_table(read_vocabulary(spark, str(path)), "ranked")
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert ranked.filter(F.col("word") != F.concat(F.lit("w"), F.col("rank"))).isEmpty()
    stage_table(ranked, "words").write.parquet(f"{tmp_path}/words.parquet")
    assert read_vocabulary_table(spark, f"{tmp_path}/words.parquet").count() == 200_000


def test_vocabulary_of_several_files(spark, tmp_path):
    (tmp_path / "b.txt").write_text("third\n\nfourth", encoding="utf-8")
    (tmp_path / "a.txt").write_text("first\nsecond\n", encoding="utf-8")
    got = [r.word for r in read_vocabulary(spark, str(tmp_path)).orderBy("rank").collect()]
    assert got == ["first", "second", "third", "fourth"]


def test_document_ids_do_not_collide(spark, tmp_path):
    rows = [("a", None), (None, "a"), ("a:b", "c"), ("a", "b:c"), ("a\\", "b"), ("a", "\\N"), (None, None)]
    spark.createDataFrame([(*r, "x") for r in rows], "p string, q string, text string").write.parquet(f"{tmp_path}/t")
    docs = read_documents(spark, DocumentSource("t", f"{tmp_path}/t", id_cols=("p", "q"))).collect()
    assert len({d.doc_id for d in docs}) == len(rows)
    with pytest.raises(ValueError):
        union_sources(spark, [DocumentSource("t", "p"), DocumentSource("t", "q")])


def test_null_documents_are_counted(spark, collections):
    assert {r.source: r.n for r in null_documents(spark, collections).collect()} == {"web": 1, "wiki": 0}


FREQUENCIES = [
    ("train", "#犬", "犬", 3, 2, 9, 99.875, 1),
    ("train", 'a"b', "a", 1, 1, 5, None, 2),
    ("validation", " ", " ", 1, 1, 1, 0.0, 1),
]


@pytest.fixture
def frequencies(spark):
    return spark.createDataFrame(
        FREQUENCIES,
        "split string, surface string, normalized string, cnt_a long, cnt_b long, cnt_c long, percentile double, rank long",
    )


def test_frequency_table_round_trip(spark, tmp_path, frequencies):
    path = f"{tmp_path}/freq"
    tables.write_frequencies(frequencies, path)
    back = read_frequencies(spark, f"{path}/split=train").orderBy(F.desc("cnt_c")).collect()
    assert [tuple(r) for r in back] == [("#犬", "犬", 3, 2, 9, 99.88), ('a"b', "a", 1, 1, 5, None)]
    assert [tuple(r) for r in read_frequencies(spark, f"{path}/split=validation").collect()] == [(" ", " ", 1, 1, 1, 0.0)]
    assert spark.read.text(f"{path}_header").count() == 1
    assert read_frequencies(spark, f"{path}/split=train", drop_hash_rows=True).count() == 1
    both = read_frequencies(spark, path)
    assert both.columns[0] == "split" and both.count() == 3


def test_short_and_broken_frequency_rows(spark, tmp_path):
    path = tmp_path / "freq.tsv"
    path.write_text("# header\na\ta\t1\t2\t3\nb\tb\t1\t2\t3\tx\nc\tc\t1\t2\td\t5.0\nd\td\n\ne\te\t1\t1\t1\t5.5\n")
    five = read_frequencies(spark, str(path), drop_hash_rows=True).orderBy("surface").collect()
    assert [(r.surface, r.percentile) for r in five] == [("a", None), ("b", None), ("e", 5.5)]
    six = read_frequencies(spark, str(path), min_fields=6).orderBy("surface").collect()
    assert [r.surface for r in six] == ["b", "e"]
    assert count_bad_lines(spark, str(path), drop_hash_rows=True) == 3


def test_corpus_text(spark, tmp_path):
    sentences = spark.createDataFrame([("train", "犬。"), ("train", "猫。"), ("validation", "鳥。")], "split string, clean string")
    tables.write_corpus(sentences, f"{tmp_path}/corpus", files=1)
    (part,) = pathlib.Path(f"{tmp_path}/corpus/split=train").glob("*.txt.gz")
    assert sorted(gzip.decompress(part.read_bytes()).decode().split()) == ["犬。", "猫。"]


def test_metadata_json(spark, tmp_path):
    df = spark.createDataFrame([("train", 2, 0.5)], "split string, sentence_count long, kanji_kana_retention_ratio double")
    tables.write_metadata(df, f"{tmp_path}/meta")
    (part,) = pathlib.Path(f"{tmp_path}/meta").glob("*.json")
    assert json.loads(part.read_text()) == {
        "split": "train", "sentence_count": 2, "kanji_kana_retention_ratio": 0.5,
    }


def test_counts_are_sorted_across_files(spark, tmp_path):
    counted = spark.range(1_000).select(F.concat(F.lit("w"), "id").alias("surface"), (F.col("id") % 7).alias("cnt"))
    tables.write_counts(counted.repartition(5), f"{tmp_path}/counts")
    parts = sorted(pathlib.Path(f"{tmp_path}/counts").glob("part-*"))
    rows = [line.split("\t") for p in parts for line in p.read_text().splitlines()]
    assert rows == sorted(rows, key=lambda r: (-int(r[1]), r[0])) and len(rows) == 1_000


def test_only_the_first_lines_of_a_file_are_a_header(spark, tmp_path):
    for name in ("a", "b"):
        rows = ["# one", "# two", "# three", "#犬\t犬\t1\t2\t3\t4.0", f"{name}\tx\t1\t2\t3\t4.0", "#\t#\t1\t2\t3\tx"]
        (tmp_path / f"{name}.tsv").write_text("\n".join(rows))
    (tmp_path / "c.tsv").write_text("# one\nc\tx\t1\t2\t3\t4.0\n#c\tx\t1\t2\t3\t4.0")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20")
    try:
        found = read_frequencies(spark, str(tmp_path), drop_hash_rows=True).collect()
        bad = count_bad_lines(spark, str(tmp_path), drop_hash_rows=True)
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    # A word in the first three places of a file can't be told from its header.
    assert sorted(r.surface for r in found) == ["#", "#", "#犬", "#犬", "a", "b", "c"] and bad == 0


def shuffle_files(spark) -> int:
    found = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().mkString(" ")
    return found.count("shuffle_")


def test_a_staged_table_leaves_no_shuffle_files(spark):
    before = shuffle_files(spark)
    table = storage.stage_table(spark.range(1_000).groupBy((F.col("id") % 7).alias("k")).count(), "counts")
    assert shuffle_files(spark) <= before and spark.conf.get(storage._CLEANUP) == "false"
    assert table.count() == 7 and "zstd" in "".join(table.inputFiles())


def test_only_staged_tables_are_dropped(spark, tmp_path):
    spark.range(3).write.parquet(f"{tmp_path}/own")
    staged, own = storage.stage_table(spark.range(3), "mine"), spark.read.parquet(f"{tmp_path}/own")
    before = storage.staged_names(spark)
    storage.drop_table(own)
    storage.drop_table(staged.filter("id > 0"))
    assert storage.staged_names(spark) == before and own.count() == 3
    storage.drop_table(staged)
    assert len(before - storage.staged_names(spark)) == 1


def test_ranked_types_keep_one_table(spark):
    rows = [("train", f"w{i}", f"w{i}", i % 9, i % 7, i % 5) for i in range(50)]
    counts = spark.createDataFrame(rows, "split string, surface string, normalized string, cnt_a long, cnt_b long, cnt_c long")
    before = storage.staged_names(spark)
    assert freq.top_types(counts).count() == 50 and freq.top_types(counts, 3).count() == 3
    assert not [name for name in storage.staged_names(spark) - before if name.startswith("types")]


def test_frequency_files_are_compressed(spark, tmp_path, frequencies):
    tables.write_frequencies(frequencies, f"{tmp_path}/freq")
    parts = [*pathlib.Path(f"{tmp_path}/freq").glob("split=*/part-*")]
    lines = [line for p in parts for line in gzip.decompress(p.read_bytes()).decode().splitlines()]
    assert len(lines) == 3 and all(p.name.endswith(".txt.gz") for p in parts)
