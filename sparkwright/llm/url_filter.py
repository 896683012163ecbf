"""URL rules as a sort-merge range join (DataFrame operations only).

A rule is a host and a path.  It fits its host and all subdomains where the
url's path starts with the rule's path.  Written as ``path FF reversed host``,
the hosts under a rule are one interval of byte strings, so rules become an
opening and a closing event and urls become points between them.  The events
and the points are range-partitioned and sorted on that key; a sweep carries
the innermost open rule.  What is on the stack below a rule is fixed by the
rules alone (their intervals nest), so each event stores the rule that is on
top of the stack after it: the rule itself when it opens, the rule below it
when it closes.  Partitions are swept alone, and the top of the stack at each
partition's first row comes from the last events before it (one row for each
partition).

A url is a point once for each distinct length of the rules' paths that its
path has.  The host of a hot site does not gather in one task: points are
range-partitioned with a hash of the row as the last key.

Results: the longest fitting rule (host and path together, then host) decides;
no fitting rule gives ``default``.  A null url, or one without ``://``, has an
empty host and path and fits no rule.  Of equal rules one is kept, ``block``
before ``allow``.  Rules with a null host or path are not used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparkwright.session import shared_dir

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a url, both empty without ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), UPPER, LOWER)
    return host, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def _key(path: Column, host: Column) -> Column:
    """``path FF reversed-host.`` as bytes; FF and FE are in no UTF-8 text."""
    back = F.concat_ws(".", F.reverse(F.split(host, r"\.")))
    return F.concat(F.encode(path, "utf-8"), F.unhex(F.lit("FF")),
                    F.encode(F.concat(back, F.lit(".")), "utf-8"))


def rule_events(rules: DataFrame) -> DataFrame:
    """Opening and closing events of the rules with the top of the stack after each."""
    rules = (rules.select("host", "path", "verdict").where("host is not null and path is not null")
             .groupBy("host", "path").agg(F.max("verdict").alias("verdict")))
    labels = F.split("host", r"\.")
    above = (rules.withColumn("k", F.explode(F.sequence(F.lit(1), F.size(labels))))
             .select("host", "path", "k",
                     F.concat_ws(".", F.slice(labels, F.col("k") + 1, F.size(labels))).alias("up"))
             .where("up <> ''"))
    parents = (above.join(rules.select(F.col("host").alias("up"), "path",
                                       F.struct("host", "path", "verdict").alias("parent")),
                          ["up", "path"])
               .groupBy("host", "path").agg(F.min_by("parent", "k").alias("parent")))
    r = rules.join(parents, ["host", "path"], "left").withColumn("key", _key(F.col("path"), F.col("host")))
    top = F.struct("host", "path", "verdict")
    after = F.explode(F.array(
        F.struct(F.col("key").alias("key"), F.lit(0).alias("kind"), F.struct(top.alias("rule")).alias("top")),
        F.struct(F.concat("key", F.unhex(F.lit("FE"))).alias("key"), F.lit(2).alias("kind"),
                 F.struct(F.col("parent").alias("rule")).alias("top"))))
    return r.select(after.alias("e")).select("e.*")


def judge_urls(pages: DataFrame, rules: DataFrame, default: str = "allow") -> DataFrame:
    """One row for each page: page_id, host, path, rule, verdict.  Other columns of pages are not read."""
    shared_dir(pages.sparkSession)
    host, path = url_parts(F.col("url"))
    urls = (pages.select("page_id", "url").select("page_id", host.alias("host"), path.alias("path"))
            .withColumn("row", F.monotonically_increasing_id()))
    # The number of distinct path lengths is bounded by the longest rule path.
    lengths = [r[0] for r in rules.where("host is not null and path is not null")
               .select(F.length("path")).distinct().collect()]
    fits = F.filter(F.array(*map(F.lit, lengths)).cast("array<int>"), lambda n: n <= F.length("path"))
    points = (urls.withColumn("n", F.explode_outer(fits))
              .withColumn("key", F.when(F.col("n").isNotNull() & (F.col("host") != ""),
                                        _key(F.expr("substring(path, 1, n)"), F.col("host"))))
              .withColumn("kind", F.lit(1)).drop("n"))
    events = rule_events(rules)
    both = points.unionByName(events, allowMissingColumns=True).withColumn("deal", F.xxhash64("row"))
    swept = (both.repartitionByRange("key", "kind", "deal").drop("deal")
             .withColumn("part", F.spark_partition_id()).checkpoint())
    before = (swept.where("kind <> 1").groupBy("part")
              .agg(F.max_by("top", F.struct("key", "kind")).alias("top")))
    parts = swept.select("part").distinct().join(before, "part", "left")   # a row for each partition
    carry = parts.select("part", F.last("top", ignorenulls=True).over(
        Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)).alias("carry"))
    sweep = Window.partitionBy("part").orderBy("key", "kind").rowsBetween(Window.unboundedPreceding, 0)
    found = (swept.withColumn("seen", F.last("top", ignorenulls=True).over(sweep)).where("kind = 1")
             .join(carry, "part", "left")
             .withColumn("rule", F.when(F.col("key").isNotNull(), F.coalesce("seen", "carry"))["rule"]))
    size = F.struct(F.length("rule.host") + F.length("rule.path"), F.length("rule.host"))
    best = found.groupBy("row").agg(
        F.first("page_id").alias("page_id"), F.first("host").alias("host"), F.first("path").alias("path"),
        F.max_by("rule", F.when(F.col("rule").isNotNull(), size)).alias("rule"))
    return best.select(
        "page_id", "host", "path", F.concat("rule.host", "rule.path").alias("rule"),
        F.coalesce("rule.verdict", F.lit(default)).alias("verdict"))
