"""URL filters as a sort-merge range join.

A rule (host, path prefix) fits its host, all subdomains, and every path that starts with its own. Its canonical key is
the host with its labels reversed, a separator and the path prefix, so the keys it fits for one host form an interval.
A url has one key per suffix of its host that has as many labels as some rule's host. Rules and url keys are sorted together into range partitions; as intervals
of prefixes are nested or apart, the last rule at or before a key, with the rules it is nested in, is the stack of
active rules there, and the first of the stack that fits is the innermost. The last rule before a partition comes from a
table with one row per partition. The longest rule over a url's keys decides.

A host with a third of all urls is split between partitions by path; equal urls are judged once. Column functions only.

Edge cases: a null url or one without ``://`` has an empty host and path, which no rule fits; a url no rule fits gets
the default verdict; of equal rules, block wins; repeated rows each get a row; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textmill.llm.common import pick
from textmill.storage import stage_table

ALLOW, BLOCK = "allow", "block"
# The rules of the registered query, as (verdict, host, path prefix).
RULES = (
    (ALLOW, "org", "/"),
    (BLOCK, "example.org", "/es/"),
    (BLOCK, "example.org", "/en/1"),
    (ALLOW, "com", "/fr/"),
    (BLOCK, "com", "/de/"),
)
_SEPARATOR = "\x01"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    host = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(host, _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def _reversed(labels: Column) -> Column:
    return F.array_join(F.reverse(labels), ".")


def rule_table(rules: DataFrame) -> DataFrame:
    """Rules with their key and ``stack``: themselves and the rules they are nested in, innermost first.

    ``rules`` has the columns verdict, host, path. A rule is nested in at most as many rules as its key has prefixes.
    """
    keyed = (
        rules.groupBy("host", "path")
        .agg(F.max("verdict").alias("verdict"))  # block sorts last
        .withColumn("key", F.concat(_reversed(F.split("host", r"\.")), F.lit(_SEPARATOR), F.col("path")))
        .withColumn("rule", F.concat("host", "path"))
    )
    entry = F.struct(F.length("key").alias("depth"), "rule", "verdict", "host", "path")
    prefixes = keyed.select(
        "key", F.explode(F.transform(F.sequence(F.lit(1), F.length("key")), lambda n: F.substring("key", F.lit(1), n))).alias("prefix")
    )
    outer = keyed.select(F.col("key").alias("prefix"), entry.alias("entry"))
    return (
        prefixes.join(outer, "prefix")
        .groupBy("key")
        .agg(F.reverse(F.array_sort(F.collect_list("entry"))).alias("stack"))
    )


def judge_urls(
    pages: DataFrame,
    rules: DataFrame,
    id_col: str = "page_id",
    url_col: str = "url",
    default: str = ALLOW,
) -> DataFrame:
    """One row per row of ``pages``: id, host, path, rule (null if none fits), verdict."""
    urls = pick(pages, id=id_col, url=url_col).groupBy("id", "url").agg(F.count(F.lit(1)).alias("copies"))
    urls = urls.withColumn("host", host_of(F.col("url"))).withColumn("path", path_of(F.col("url")))
    sizes = {1, *(r[0] for r in rules.select(F.size(F.split("host", r"\."))).distinct().collect())}  # a few numbers
    labels = F.length("host") - F.length(F.replace("host", F.lit("."))) + 1
    suffixes = F.array(*(F.when(labels >= n, F.substring_index("host", ".", -n)) for n in sorted(sizes)))
    suffixes = F.filter(suffixes, lambda suffix: suffix.isNotNull())
    points = urls.select("id", "url", "copies", "host", "path", F.explode(suffixes).alias("suffix")).select(
        "id",
        "url",
        "copies",
        "host",
        "path",
        "suffix",
        F.concat(_reversed(F.split("suffix", r"\.")), F.lit(_SEPARATOR), F.col("path")).alias("key"),
        F.lit(1).alias("kind"),
    )
    starts = rule_table(rules).select("key", "stack", F.lit(0).alias("kind"))
    order = ["key", "kind", "id"]
    sweep = points.unionByName(starts, allowMissingColumns=True)
    sweep = sweep.repartitionByRange(*order).withColumn("part", F.spark_partition_id())
    sweep = stage_table(sweep, "url-sweep")  # fixes which partition a row is in
    tops = sweep.groupBy("part").agg(F.max(F.when(F.col("kind") == 0, F.struct("key", "stack")))["stack"].alias("top"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    carried = tops.select(F.col("part").alias("_part"), F.last("top", ignorenulls=True).over(before).alias("carried"))
    within = Window.partitionBy("part").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    active = (
        sweep.withColumn("top", F.last("stack", ignorenulls=True).over(within))
        .filter(F.col("kind") == 1)
        .join(F.broadcast(carried), F.col("part") == F.col("_part"))  # one row per partition
        .withColumn("stack", F.coalesce("top", "carried"))
    )
    fits = F.filter("stack", lambda r: (r["host"] == F.col("suffix")) & F.startswith(F.col("path"), r["path"]))
    found = active.withColumn("found", F.get(fits, F.lit(0)))
    size = F.struct(F.length("found.rule").alias("n"), F.length("found.host").alias("h"), "found.rule", "found.verdict")
    best = found.groupBy("id", "url").agg(
        F.first("host").alias("host"),
        F.first("path").alias("path"),
        F.first("copies").alias("copies"),
        F.max(F.when(F.col("found").isNotNull(), size)).alias("best"),
    )
    return best.select(
        "id",
        "host",
        "path",
        F.col("best.rule").alias("rule"),
        F.coalesce("best.verdict", F.lit(default)).alias("verdict"),
        F.explode(F.sequence(F.lit(1), "copies")).alias("_copy"),
    ).drop("_copy")


def rules_frame(spark, rules: Sequence[tuple[str, str, str]] = RULES) -> DataFrame:
    return spark.createDataFrame(list(rules), "verdict string, host string, path string")
