"""Merkle manifest of a dataset, checked by a recursive climb.

A row's leaf is the hash of its columns. Leaves of a group (a language) stand in the order of their ids; while several
nodes remain, every two consecutive ones become the hash of both, a single last one the hash of itself. What remains is
the group's subroot, and the subroots, in the order of their groups, make the root in the same way.

* **Build.** Places within groups come from a range-partitioned sort, so a group of any size is spread. Eight levels are
  built at a time from runs of 256 nodes that meet in one row, so a level costs a shuffle of 1/256 of the one below.
* **Store.** Every node that begins such a run of levels is a row: the siblings on its way through them, and a link to
  the node it ends in. The link of a subroot leads into the tree of subroots.
* **Climb.** A Spark recursive query starts from each leaf's claimed hash, folds the siblings of its row into it, appends
  them to the proof and goes on with the linked node until there is none. Nodes over very many leaves are stored once per
  salt, so the rows that meet there are dealt to many tasks.

Hashes are kept as bytes and hashed as lower-case hex text.

Edge cases: null columns are written as ``-``; rows without a group form one group, the first; rows without an id come
first in theirs; equal ids are ordered by their leaves, so repeated rows are leaves of their own with equal values; an
empty table gives no rows; other columns are ignored; a text of any length is one leaf.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from textmill.llm.common import pick, places, salted
from textmill.storage import stage_table

LEVELS = 8  # of the tree in one stored row; 1 stores every level by itself
SALTS = 128
_TOP = -1  # the tree of subroots
_ROW_LIMIT = "spark.sql.cteRecursionRowLimit"


def written(column: Column) -> Column:
    """A value as length and text, null as ``-``; no two different rows give the same concatenation."""
    text = column.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_hash(*columns: Column) -> Column:
    return F.unhex(F.sha2(F.concat(*map(written, columns)), 256))


def _hex(column: Column) -> Column:
    return F.lower(F.hex(column))


def _depth(size: Column) -> Column:
    """Levels above ``size`` leaves."""
    return F.when(size > 1, F.length(F.bin(size - 1))).otherwise(F.lit(0))


def _level_above(nodes: Column) -> Column:
    """Every two nodes (an array of hex text) as one; a last one by itself."""
    pairs = F.sequence(F.lit(0), F.floor((F.size(nodes) + 1) / 2).cast("int") - 1)
    return F.transform(pairs, lambda i: F.sha2(F.concat(F.get(nodes, 2 * i), F.coalesce(F.get(nodes, 2 * i + 1), F.lit(""))), 256))


def _build_step(rows: DataFrame, step: int, per_row: int) -> DataFrame:
    """Runs of nodes (tree, pos, hash, levels_left and whatever else) with ``paths`` of its members and its ``top``."""
    at = F.col("pos") - F.shiftleft(F.col("run"), per_row)
    runs = rows.withColumn("run", F.shiftright("pos", per_row)).withColumn("at", at.cast("int"))
    members = F.array_sort(F.collect_list(F.struct("at", *(c for c in rows.columns if c not in ("tree", "levels_left")))))
    runs = runs.groupBy("tree", "run").agg(members.alias("members"), F.min("levels_left").alias("levels_left"))
    runs = runs.withColumn("levels", F.least(F.col("levels_left"), F.lit(per_row)))
    numbers = F.slice(F.array(*map(F.lit, range(per_row))), F.lit(1), F.col("levels"))
    grown = F.aggregate(
        numbers,
        F.array(F.transform("members", lambda m: _hex(m["hash"]))),
        lambda levels, _: F.concat(levels, F.array(_level_above(F.element_at(levels, -1)))),
    )
    runs = runs.withColumn("grown", grown)
    path = lambda m: F.transform(
        numbers, lambda k: F.unhex(F.get(F.get("grown", k), F.call_function("shiftright", m["at"], k).bitwiseXOR(F.lit(1))))
    )
    top = F.get(F.element_at("grown", -1), F.lit(0))
    return runs.select(
        "tree",
        F.lit(step).alias("step"),
        "run",
        F.transform("members", lambda m: F.struct(m.alias("m"), path(m).alias("path"))).alias("members"),
        F.unhex(top).alias("top"),
        (F.col("levels_left") - F.col("levels")).alias("levels_left"),
    )


def _linked(runs: DataFrame) -> DataFrame:
    """One row per member: its own columns, ``path`` and the link to the node its run ends in."""
    ends = (F.col("levels_left") == 0)
    inside = F.col("tree") != _TOP
    return runs.select(
        "tree",
        "step",
        F.when(~ends, F.col("tree")).when(inside, F.lit(_TOP)).cast("long").alias("up_tree"),
        F.when(~ends, F.col("step") + 1).when(inside, F.lit(0)).cast("int").alias("up_step"),
        F.when(~ends, F.col("run")).when(inside, F.col("tree")).cast("long").alias("up_pos"),
        F.explode("members").alias("_x"),
    ).select("tree", "step", "up_tree", "up_step", "up_pos", "_x.path", "_x.m.*")


def _climb_tree(rows: DataFrame, per_row: int, steps: int, name: str) -> tuple[list[DataFrame], DataFrame]:
    """(linked rows, step by step, all of them staged; the trees' tops as tree, hash)."""
    linked, tops = [], []
    for step in range(max(steps, 1)):
        runs = stage_table(_build_step(rows, step, per_row), f"{name}-runs")
        linked.append(_linked(runs))
        tops.append(runs.filter("levels_left = 0").select("tree", F.col("top").alias("hash")))
        rows = runs.filter("levels_left > 0").select("tree", F.col("run").alias("pos"), F.col("top").alias("hash"), "levels_left")
    top = tops[0]
    for other in tops[1:]:
        top = top.unionByName(other)
    return linked, top


@contextmanager
def _any_number_of_rows(spark: SparkSession) -> Iterator[None]:
    """Spark stops a recursive query at a million rows unless told otherwise."""
    before = spark.conf.get(_ROW_LIMIT, None)
    spark.conf.set(_ROW_LIMIT, "-1")
    try:
        yield
    finally:
        spark.conf.unset(_ROW_LIMIT) if before is None else spark.conf.set(_ROW_LIMIT, before)


def _fold(path: str, pos: str, hashed: str) -> str:
    """SQL: ``hashed`` (hex text) with the siblings of ``path`` folded into it; ``pos`` says on which side they are."""
    sides = f"transform({path}, (s, j) -> struct(lower(hex(s)) AS s, shiftright({pos}, j) & 1 AS second))"
    return (
        f"aggregate({sides}, {hashed}, (h, x) -> sha2(CASE WHEN x.s IS NULL THEN h WHEN x.second = 1 "
        "THEN concat(x.s, h) ELSE concat(h, x.s) END, 256))"
    )


def _siblings(path: str) -> str:
    return f"aggregate({path}, X'', (b, s) -> concat(b, coalesce(s, X'')))"


def _salt(tree: str, step: str, salt: str) -> str:
    """Nodes above 65,536 leaves, or above all groups, are stored once per salt."""
    return f"CASE WHEN {tree} = {_TOP} OR {step} >= 2 THEN {salt} ELSE 0 END"


def verify(docs: DataFrame, id_col: str, group_col: str, leaf: Column, claimed: Column, levels: int = LEVELS) -> DataFrame:
    """Build the manifest of ``leaf`` and fold ``claimed``, a leaf hash to be checked, up to the root.

    One row per row of ``docs``: id, leaf, subroot, root, proof (siblings from leaf to root, one after the other),
    all as bytes, and ``folded_root`` (hex text), which equals the root's hex text if and only if the claim holds.
    Columns are evaluated on ``docs``.
    """
    spark = docs.sparkSession
    rows = docs.withColumns({"_m_leaf": leaf, "_m_claimed": claimed})
    rows = pick(rows, id=id_col, lang=group_col, hash="_m_leaf", claimed="_m_claimed")
    placed = stage_table(places(rows, "lang", ["id", "hash", "claimed"], "place"), "merkle-leaves")
    sizes = placed.groupBy("lang").agg(F.count(F.lit(1)).alias("size")).withColumn("_all", F.lit(0))
    groups = stage_table(places(sizes, "_all", ["lang"], "tree").withColumn("tree", F.col("tree") - 1), "merkle-groups")
    found = groups.agg(F.max("size").alias("size"), F.count(F.lit(1)).alias("groups")).first()
    steps = lambda n: -(-max((n or 1) - 1, 0).bit_length() // levels)
    small = groups.select("lang", "tree", _depth(F.col("size")).alias("levels_left"))
    leaves = salted(placed, small, ["lang"], 16, F.col("place"))
    leaves = leaves.select("tree", (F.col("place") - 1).alias("pos"), "hash", "levels_left", "id", "claimed")
    linked, subroots = _climb_tree(leaves, levels, steps(found["size"]), "merkle")
    subroots = stage_table(subroots, "merkle-subroots")
    top_rows = subroots.select(
        F.lit(_TOP).cast("long").alias("tree"), F.col("tree").alias("pos"), "hash",
        F.lit(max(found["groups"] - 1, 0).bit_length()).alias("levels_left"),
    )
    top_linked, root = _climb_tree(top_rows, levels, steps(found["groups"]), "merkle-top")

    nodes = [part.select("tree", "step", "pos", "path", "up_tree", "up_step", "up_pos") for part in [*linked[1:], *top_linked]]
    stored = nodes[0]
    for part in nodes[1:]:
        stored = stored.unionByName(part)
    many = F.expr(f"sequence(0, {_salt('tree', 'step', str(SALTS - 1))})")
    stored = stage_table(stored.withColumn("salt", F.explode(many)), "merkle-nodes")
    starts = linked[0].withColumn("salt", F.pmod(F.xxhash64("tree", "pos"), F.lit(SALTS)).cast("int"))

    names = {name: f"merkle_{name}_{uuid.uuid4().hex}" for name in ("starts", "nodes")}
    starts.createOrReplaceTempView(names["starts"])
    stored.createOrReplaceTempView(names["nodes"])
    try:
        with _any_number_of_rows(spark):
            climbed = spark.sql(f"""
WITH RECURSIVE climb AS (
  SELECT id, hash AS leaf, tree AS own_tree, salt, {_fold("path", "pos", "lower(hex(claimed))")} AS folded,
         {_siblings("path")} AS proof, up_tree, up_step, up_pos, {_salt("up_tree", "up_step", "salt")} AS up_salt
  FROM {names["starts"]}
  UNION ALL
  SELECT c.id, c.leaf, c.own_tree, c.salt, {_fold("n.path", "n.pos", "c.folded")}, concat(c.proof, {_siblings("n.path")}),
         n.up_tree, n.up_step, n.up_pos, {_salt("n.up_tree", "n.up_step", "c.salt")}
  FROM climb c JOIN {names["nodes"]} n
    ON c.up_tree = n.tree AND c.up_step = n.step AND c.up_pos = n.pos AND c.up_salt = n.salt)
SELECT id, leaf, own_tree AS tree, folded AS folded_root, proof FROM climb WHERE up_tree IS NULL
""")
            climbed = stage_table(climbed, "merkle-climbed")
    finally:
        for name in names.values():
            spark.catalog.dropTempView(name)
    root = root.first()  # one hash
    roots = subroots.select("tree", F.col("hash").alias("subroot"), F.lit(bytes(root["hash"]) if root else None).alias("root"))
    return salted(climbed, roots, ["tree"], 16, F.col("leaf")).select("id", "leaf", "subroot", "root", "proof", "folded_root")


def check_documents(docs: DataFrame, levels: int = LEVELS) -> DataFrame:
    """The manifest of a table of documents, and whether each row's claim holds where some are tampered with.

    Leaves are made of doc_id, source, lang, n_chars and text. Where 7 divides the CRC-32 of the decimal doc_id, the
    claim has one more in ``n_chars``, unless that is null.
    """
    columns = [F.col(f"`{c}`") for c in ("doc_id", "source", "lang", "n_chars", "text")]
    tampered = F.crc32(F.col("doc_id").cast("string")) % 7 == 0
    n_chars = F.when(tampered, F.col("n_chars") + 1).otherwise(F.col("n_chars"))
    found = verify(docs, "doc_id", "lang", leaf_hash(*columns), leaf_hash(*columns[:3], n_chars, columns[4]), levels)
    return found.select(
        F.col("id").alias("doc_id"),
        *(_hex(F.col(c)).alias(c) for c in ("leaf", "subroot", "root")),
        F.sha2(_hex(F.col("proof")), 256).alias("proof_sha256"),
        "folded_root",
        (F.col("folded_root") == _hex(F.col("root"))).alias("verified"),
    )
