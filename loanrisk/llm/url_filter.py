"""Allow and block rules on URLs: a host (with its subdomains) and a path prefix, longest rule wins.

Method: a sort-merge range join. A rule's canonical key is its host with the labels reversed, a
separator, and its path; every URL key that starts with it lies in one interval of the sort order,
and the intervals of two rules are nested or disjoint. URL keys and rules are sorted together and
swept once. Each rule carries the stack of the rules it is nested in (its prefixes, itself on top),
so the sweep keeps the stack of the last rule passed, and a URL takes the topmost entry that still
covers it. Everything is built-in functions; no rule list is broadcast or collected.

A rule on a host covers its subdomains too. A URL therefore enters the sweep once per number of
labels a rule host can have (the largest is read from the rules), with its host cut to so many.

URLs are dealt over slices by row, never by host, so a host with a third of all rows is spread
evenly; the rules, far fewer, are repeated once per slice.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loanrisk.llm.common import only, partitions_for

SEPARATOR = "\x01"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def url_host(url: Column) -> Column:
    """From the first `://` to `/`, `?`, `#` or the end, A-Z lower-cased; empty without `://`."""
    return F.translate(F.regexp_extract(_after_scheme(url), r"^[^/?#]*", 0), UPPER, LOWER)


def url_path(url: Column) -> Column:
    """From the end of the host to `?`, `#` or the end; empty without `://`."""
    return F.regexp_extract(_after_scheme(url), r"^[^/?#]*([^?#]*)", 1)


def _after_scheme(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))


def _labels(host: Column) -> Column:
    return F.reverse(F.split(host, "[.]", -1))


def _key(labels: Column, path: Column) -> Column:
    return F.concat(F.array_join(labels, "."), F.lit(SEPARATOR), path)


def rule_stacks(rules: DataFrame) -> DataFrame:
    """(key, stack): every rule with the rules it is nested in, shortest first, itself last.

    `rules` has `rule` (host, then a path that starts with `/`, or no path) and `verdict`. Of rules
    given twice with different verdicts, `block` stands; null rules are ignored.
    """
    host, path = F.regexp_extract("rule", r"^[^/]*", 0), F.regexp_extract("rule", r"^[^/]*(.*)", 1)
    host = F.translate(host, UPPER, LOWER)
    keyed = (
        rules.where(F.col("rule").isNotNull())
        .select(_key(_labels(host), path).alias("key"), "rule", "verdict")
        .groupBy("key")
        .agg(F.max(F.struct("verdict", "rule")).alias("r"))
        .select("key", F.col("r.rule").alias("rule"), F.col("r.verdict").alias("verdict"))
    )
    # Only prefixes that reach into the path can be rules of the same host.
    shortest = F.instr("key", SEPARATOR)
    prefixes = keyed.select(
        "key", F.explode(F.sequence(shortest, F.length("key"))).alias("n")
    ).select("key", F.substr("key", F.lit(1), F.col("n")).alias("outer"))
    outer = keyed.select(F.col("key").alias("outer"), "rule", "verdict")
    return (
        prefixes.join(outer, "outer")
        .groupBy("key")
        .agg(F.sort_array(F.collect_list(F.struct(F.length("outer").alias("n"), F.col("outer").alias("key"), "rule", "verdict"))).alias("stack"))
    )


def judge_urls(
    pages: DataFrame,
    rules: DataFrame,
    id_col: str = "page_id",
    url_col: str = "url",
    default: str = "allow",
    slices: int | None = None,
) -> DataFrame:
    """One row per input row: `page_id`, `host`, `path`, `rule` and `verdict`.

    The longest fitting rule decides (of equally long ones, the one on the longer host); without
    one `rule` is null and the verdict is `default`. Null and malformed URLs have an empty host and
    path and are judged like any other; repeated rows and null ids are kept; other columns are not
    read. An empty table gives an empty result, and without rules all rows get the default.
    `slices` defaults to four times the shuffle partitions.
    """
    slices = slices or 4 * partitions_for(pages)
    stacks = rule_stacks(rules)
    # One number: the most labels a rule host has. No longer suffix of a host can equal one.
    host_of_key = F.substring_index("key", SEPARATOR, 1)
    deepest = stacks.agg(F.max(F.size(F.split(host_of_key, "[.]", -1)))).first()[0] or 1

    rows = only(pages, page_id=id_col, url=url_col).select(
        F.monotonically_increasing_id().alias("row"),
        "page_id",
        url_host(F.coalesce("url", F.lit(""))).alias("host"),
        url_path(F.coalesce("url", F.lit(""))).alias("path"),
    )
    labels = _labels(F.col("host"))
    probes = rows.select(
        F.pmod(F.xxhash64("row"), F.lit(slices)).cast("int").alias("slice"),
        "*",
        F.explode(F.sequence(F.lit(1), F.least(F.size(labels), F.lit(deepest)))).alias("depth"),
    ).withColumn("key", _key(F.slice(_labels(F.col("host")), 1, F.col("depth")), F.col("path")))
    openings = stacks.select(
        "key", "stack", F.explode(F.sequence(F.lit(0), F.lit(slices - 1))).alias("slice")
    )
    sweep = (
        Window.partitionBy("slice")
        .orderBy("key", F.col("row").asc_nulls_first())
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    swept = (
        probes.unionByName(openings, allowMissingColumns=True)
        .withColumn("active", F.last("stack", ignorenulls=True).over(sweep))
        .where(F.col("row").isNotNull())
    )
    covering = F.filter("active", lambda r: F.startswith(F.col("key"), r["key"]))
    top = F.when(F.size(covering) > 0, F.element_at(covering, -1))
    found = swept.select("slice", "row", "page_id", "host", "path", "depth", top.alias("top"))
    best = F.max(
        F.when(
            F.col("top").isNotNull(),
            F.struct(F.length("top.rule").alias("n"), "depth", "top.rule", "top.verdict"),
        )
    )
    return (
        found.groupBy("slice", "row")
        .agg(F.first("page_id").alias("page_id"), F.first("host").alias("host"), F.first("path").alias("path"), best.alias("best"))
        .select(
            "page_id",
            "host",
            "path",
            F.col("best.rule").alias("rule"),
            F.coalesce("best.verdict", F.lit(default)).alias("verdict"),
        )
    )
