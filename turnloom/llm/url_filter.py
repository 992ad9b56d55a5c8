"""URL rules by a sort-merge range join, in native expressions.

A host is read from its last label: www.example.net has the key `net.example.www.`. All hosts
that a rule's host fits then lie in one interval, from `net.example.` up to `net.example/` (the
character after the dot). Such intervals nest or are apart. The rules' interval ends and the
pages are sorted together by key; at each end the stack of rules that are open from there on is
known, and a page takes the stack of the last end before it. The sort is over ranges: a range
begins with the last stack of the ranges before it, one row per range. A page row is its own
sort key together with a row id, so one host with a third of all pages is cut into many ranges.

Of the rules on the stack, those whose path begins the page's path fit; the longest wins.

Cases: a NULL URL, or one without `://`, has an empty host and path and fits no rule. Repeated
rules count once; if the same host and path are both allowed and blocked, allow wins. Without
rules every page has the default verdict. Columns of the pages with the name of a result column
are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from turnloom.llm.common import Work, parallelism

PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
RESULT = ("host", "path", "rule", "verdict")


def url_host(url: Column) -> Column:
    return F.translate(F.regexp_extract(F.coalesce(url, F.lit("")), PARTS, 1), UPPER, LOWER)


def url_path(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), PARTS, 2)


def _labels(host: Column) -> Column:
    return F.reverse(F.split(host, r"\.", -1))


def host_key(labels: Column) -> Column:
    return F.concat(F.array_join(labels, "."), F.lit("."))


def interval_ends(rules: DataFrame) -> DataFrame:
    """key, stack: at each interval end the rules that are open from there on.

    A rule's outer intervals belong to its own host's suffixes, so they are found by an equi
    join on the prefixes of its key.
    """
    once = rules.groupBy("host", "path").agg(F.min("action").alias("action"))
    nodes = (
        once.withColumn("_labels", _labels(F.col("host")))
        .withColumn("_key", host_key(F.col("_labels")))
        .groupBy("_key", "_labels")
        .agg(F.collect_list(F.struct("host", "path", "action")).alias("_own"))
    )
    around = nodes.select(
        "_key",
        F.explode(
            F.transform(
                F.sequence(F.lit(1), F.size("_labels")),
                lambda n: host_key(F.slice("_labels", F.lit(1), n)),
            )
        ).alias("_outer"),
    )
    outer = nodes.select(F.col("_key").alias("_outer"), F.col("_own").alias("_rules"))
    joined = around.join(outer, "_outer")
    open_here = F.flatten(F.collect_list("_rules"))
    outside = F.flatten(F.collect_list(F.when(F.col("_outer") != F.col("_key"), F.col("_rules"))))
    stacks = joined.groupBy("_key").agg(open_here.alias("_open"), outside.alias("_outside"))
    end = F.concat(F.expr("substr(_key, 1, length(_key) - 1)"), F.lit("/"))
    return stacks.select(
        F.inline(
            F.array(
                F.struct(F.col("_key").alias("key"), F.col("_open").alias("stack")),
                F.struct(end.alias("key"), F.col("_outside").alias("stack")),
            )
        )
    )


def with_open_rules(pages: DataFrame, rules: DataFrame, work: Work) -> DataFrame:
    """Add `_stack`, the rules whose host fits the page's `host`."""
    ends = interval_ends(rules)
    stack_type = ends.schema["stack"].dataType
    page_rows = pages.select(
        host_key(_labels(F.col("host"))).alias("_key"),
        F.monotonically_increasing_id().alias("_tie"),
        F.lit(None).cast(stack_type).alias("_ends"),
        F.struct(*pages.columns).alias("_page"),
    )
    page_type = page_rows.schema["_page"].dataType
    end_rows = ends.select(
        F.col("key").alias("_key"),
        F.lit(-1).cast("bigint").alias("_tie"),
        F.col("stack").alias("_ends"),
        F.lit(None).cast(page_type).alias("_page"),
    )
    ranged = work.put(
        page_rows.unionByName(end_rows)
        .repartitionByRange(parallelism(pages.sparkSession), "_key", "_tie")
        .withColumn("_range", F.spark_partition_id()),
        "ranges",
    )
    last = ranged.groupBy("_range").agg(
        F.max_by("_ends", F.when(F.col("_ends").isNotNull(), F.col("_key"))).alias("_last")
    )
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    carried = last.select(
        "_range", F.last("_last", ignorenulls=True).over(before).alias("_carried")
    )
    so_far = (
        Window.partitionBy("_range")
        .orderBy("_key", "_tie")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    swept = ranged.withColumn("_here", F.last("_ends", ignorenulls=True).over(so_far))
    none = F.array().cast(stack_type)
    return (
        swept.filter(F.col("_page").isNotNull())
        .join(F.broadcast(carried), "_range")
        .select("_page.*", F.coalesce("_here", "_carried", none).alias("_stack"))
    )


def judge_urls(
    pages: DataFrame, rules: DataFrame, work: Work, url: str = "url", default: str = "allow"
) -> DataFrame:
    """Add host, path, rule (`host` + `path` of the winner, else NULL) and verdict.

    rules: host, path, action. A host fits itself and all its subdomains.
    """
    kept = [c for c in pages.columns if c not in RESULT]
    split = pages.select(
        *kept, url_host(F.col(url)).alias("host"), url_path(F.col(url)).alias("path")
    )
    found = with_open_rules(split, rules, work)
    fitting = F.filter("_stack", lambda r: F.startswith(F.col("path"), r["path"]))
    ranked = F.transform(
        fitting,
        lambda r: F.struct(
            F.length(F.concat(r["host"], r["path"])).alias("n"),
            F.length(r["host"]).alias("h"),
            F.concat(r["host"], r["path"]).alias("rule"),
            r["action"].alias("action"),
        ),
    )
    best = found.withColumn("_best", F.array_max(ranked))
    return best.select(
        *kept,
        "host",
        "path",
        F.col("_best.rule").alias("rule"),
        F.coalesce("_best.action", F.lit(default)).alias("verdict"),
    )
