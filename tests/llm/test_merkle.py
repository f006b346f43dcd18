"""The manifest against plain loops over levels, for stored rows of one and of many levels."""

import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from textmill.llm import merkle as m

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string"


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def written(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def climb(nodes):
    """(root, per leaf the siblings and sides)."""
    ways = [[] for _ in nodes]
    under = [[i] for i in range(len(nodes))]
    while len(nodes) > 1:
        up, merged = [], []
        for i in range(0, len(nodes), 2):
            pair = nodes[i : i + 2]
            for side in range(len(pair)):
                for leaf in under[i + side]:
                    ways[leaf].append((pair[1 - side], side) if len(pair) == 2 else (None, 0))
            up.append(h(*pair))
            merged.append([x for u in under[i : i + 2] for x in u])
        nodes, under = up, merged
    return nodes[0], ways


def fold(node, way):
    for sibling, side in way:
        node = h(node) if sibling is None else h(sibling, node) if side else h(node, sibling)
    return node


def expected(rows):
    leaves = []
    for r in rows:
        leaf = h(*map(written, (r[0], r[1], r[2], r[3], r[4])))
        tampered = r[0] is not None and r[3] is not None and zlib.crc32(str(r[0]).encode()) % 7 == 0
        leaves.append((r, leaf, h(*map(written, (r[0], r[1], r[2], r[3] + 1, r[4]))) if tampered else leaf))
    langs = sorted({r[2] for r in rows}, key=lambda x: (x is not None, (x or "").encode()))
    trees = {}
    for lang in langs:
        own = sorted((x for x in leaves if x[0][2] == lang), key=lambda x: (x[0][0] is not None, x[0][0] or 0, x[1], x[2]))
        trees[lang] = (own, *climb([x[1] for x in own]))
    root, ways = climb([trees[lang][1] for lang in langs])
    out = []
    for k, lang in enumerate(langs):
        own, subroot, inner = trees[lang]
        for (row, leaf, claimed), way in zip(own, inner):
            way = way + ways[k]
            folded = fold(claimed, way)
            proof = h(*(s for s, _ in way if s is not None))
            out.append((row[0], leaf, subroot, root, proof, folded, folded == root))
    return sorted(out, key=str)


def made(n, langs):
    rows = [(i * 7 % 1_000_003, f"s{i % 3}", langs[i * i % len(langs)], None if i % 11 == 0 else i, f"text {i} é") for i in range(n)]
    return rows + [rows[0], rows[0], (None, None, None, None, None), (None, "s", langs[0], 5, ""), (5, "s", "alone", 1, "x" * 100_000)]


@pytest.mark.parametrize(("n", "levels"), [(0, 8), (3, 8), (37, 1), (37, 3), (600, 8), (600, 2)])
def test_manifest_equals_a_loop(spark, clashing, n, levels):
    rows = made(n, ["en", "de", "é", "zz"]) if n else [(1, "s", "en", 2, "one")]
    docs = clashing(spark.createDataFrame(rows, SCHEMA).repartition(5))
    got = sorted(map(tuple, m.check_documents(docs, levels).collect()), key=str)
    assert got == expected(rows)
    assert n < 30 or {x[-1] for x in got} == {True, False}


def test_any_column_and_group(spark):
    docs = spark.createDataFrame([(i, i % 2, f"v{i}") for i in range(9)], "key long, part int, value string")
    leaf = m.leaf_hash(F.col("key"), F.col("value"))
    got = m.verify(docs, "key", "part", leaf, F.when(F.col("key") == 4, F.unhex(F.sha2(F.lit("x"), 256))).otherwise(leaf))
    bad = got.filter(F.col("folded_root") != F.lower(F.hex("root")))
    assert [r.id for r in bad.collect()] == [4]


def test_more_rows_than_the_default_limit(spark):
    """Spark stops recursive queries at a limit unless told; the setting is given back."""
    spark.conf.set("spark.sql.cteRecursionRowLimit", "50")
    try:
        docs = spark.createDataFrame(made(300, ["en", "de"]), SCHEMA)
        assert m.check_documents(docs).count() == 305
        assert spark.conf.get("spark.sql.cteRecursionRowLimit") == "50"
    finally:
        spark.conf.unset("spark.sql.cteRecursionRowLimit")


def test_empty_table(spark):
    assert m.check_documents(spark.createDataFrame([], SCHEMA)).isEmpty()
