import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from textmill.operators import rank
from textmill.operators.rank import MAX_MERGED_ROWS, at_least_n, global_rank, top_n

def order():
    return [F.desc("n"), F.asc("word")]


def skewed(spark, rows=5_000, seed=1):
    """A third of the rows share one count, so ties must be split."""
    rng = random.Random(seed)
    data = [("ab"[rng.random() < 0.2], f"w{i:05d}", 7 if i % 3 == 0 else rng.randint(0, 900)) for i in range(rows)]
    return spark.createDataFrame(data, "split string, word string, n long")


@pytest.mark.parametrize("partitions", [1, 4, 16])
@pytest.mark.parametrize("group", [(), ("split",)])
def test_global_rank_equals_the_window(spark, partitions, group):
    df = skewed(spark).repartition(partitions)
    want = df.withColumn("rank", F.row_number().over(Window.partitionBy(*group).orderBy(*order())).cast("long"))
    got = global_rank(df, order(), group)
    assert got.columns == want.columns
    assert got.exceptAll(want).isEmpty() and got.count() == 5_000


@pytest.mark.parametrize("n", [1, 100, MAX_MERGED_ROWS, MAX_MERGED_ROWS + 1, 6_000])
@pytest.mark.parametrize("group", [(), ("split",)])
def test_top_n_equals_the_sorted_list(spark, n, group):
    rows = skewed(spark).collect()
    keys = sorted(rows, key=lambda r: (-r.n, r.word))
    groups = {r.split if group else "" for r in rows}
    want = {r for g in groups for r in [k for k in keys if not group or k.split == g][:n]}
    got = top_n(skewed(spark).repartition(7), order(), n, group).collect()
    assert len(got) == len(want) and set(got) == want


def test_small_lists_are_cut_inside_the_tasks(spark, capsys):
    top_n(skewed(spark), order(), 10, ["split"]).explain()
    plan = capsys.readouterr().out
    assert "WindowGroupLimit" in plan and "Partial" in plan and "SinglePartition" not in plan


def test_empty(spark):
    assert global_rank(skewed(spark).limit(0), order()).count() == 0


@pytest.mark.parametrize("group", [(), ("split",)])
def test_at_least_n_keeps_the_first_and_ties(spark, group):
    df = skewed(spark).repartition(5)
    for n in (1, 40, 2_000, 9_000):
        rows = df.collect()
        want = set()
        for g in {r.split if group else "" for r in rows}:
            own = sorted((r.n for r in rows if not group or r.split == g), reverse=True)
            least = own[n - 1] if n <= len(own) else 0
            want |= {r for r in rows if (not group or r.split == g) and r.n >= least}
        got = at_least_n(df, "n", n, group)
        assert set(got.collect()) == want and "Sort" not in got._jdf.queryExecution().executedPlan().toString()


def test_offsets_that_are_not_broadcast(spark, monkeypatch):
    monkeypatch.setattr(rank, "MAX_BROADCAST_OFFSETS", 0)
    got = global_rank(skewed(spark).repartition(4), order(), ["split"])
    want = skewed(spark).withColumn("rank", F.row_number().over(Window.partitionBy("split").orderBy(*order())).cast("long"))
    assert got.exceptAll(want).isEmpty() and got.count() == 5_000
