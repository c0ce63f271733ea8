"""Allow and block rules on urls, by a sort-merge range join.

A host is written label by label from the right ("org.example.blog."), so that
a rule's host and all its subdomains form one interval of keys.  Rule hosts
either nest or are apart.  One sorted sweep over the distinct hosts carries the
stack of the rule hosts that are open at each place; a second sweep, over the
distinct (rule host, path) pairs that the first one leaves, carries the rule
with the longest path open there.  DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .staging import stage


def url_host(url: Column) -> Column:
    """After the first :// up to / ? # or the end, A-Z lower-cased; empty if there is none."""
    host = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.lit(""))


def url_path(url: Column) -> Column:
    """After the host up to ? # or the end; empty if there is no ://."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def host_key(host: Column) -> Column:
    """Labels from right to left, a dot after each: org.example.blog."""
    return F.concat(F.array_join(F.reverse(F.split(host, r"\.", -1)), "."), F.lit("."))


def _end(key: Column) -> Column:
    """The least key above all keys that begin with ``key`` (0xFF is in no UTF-8 text)."""
    return F.concat(key, F.unhex(F.lit("FF")))


def sweep(points: DataFrame, marks: DataFrame) -> DataFrame:
    """For each point (distinct binary ``key``), the value of the last mark at or before it.

    ``marks``: key, turn (0 ends, 1 begins), value.  Points and marks are sorted
    together once, by range; what is open where a part begins is carried over
    from the parts before it, of which only their last mark is looked at.
    """
    value_type = marks.schema["value"].dataType
    both = (marks.select("key", "turn", F.struct("value").alias("mark"), F.lit(False).alias("point"))
            .unionByName(points.select("key", F.lit(2).alias("turn"),
                                       F.lit(None).cast(f"struct<value:{value_type.simpleString()}>").alias("mark"),
                                       F.lit(True).alias("point"))))
    sorted_parts = stage(both.repartitionByRange("key", "turn").withColumn("part", F.spark_partition_id()), "sweep")
    last = (sorted_parts.filter("not point").groupBy("part")
            .agg(F.max_by("mark", F.struct("key", "turn")).alias("mark")))
    every = sorted_parts.select("part").distinct().join(last, "part", "left")
    # One row per part: the number of shuffle partitions bounds this table.
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    carried = every.select("part", F.last("mark", ignorenulls=True).over(earlier).alias("carried"))
    so_far = Window.partitionBy("part").orderBy("key", "turn")
    open_here = (sorted_parts.withColumn("open", F.last("mark", ignorenulls=True).over(so_far)).filter("point")
                 .join(F.broadcast(carried), "part", "left"))
    return open_here.select("key", F.coalesce("open", "carried")["value"].alias("value"))


def _nested_marks(nodes: DataFrame) -> DataFrame:
    """Begin and end marks of prefix intervals, with the stack of nodes open after each.

    ``nodes``: key (binary, distinct).  A stack has the keys of the open nodes,
    the innermost last; one node's stack is as deep as prefixes of it are nodes.
    """
    prefixes = nodes.select("key", F.explode(F.sequence(F.lit(1), F.length("key"))).alias("n")).select(
        "key", F.expr("substring(key, 1, n)").alias("node"))
    stacks = (prefixes.join(nodes.select(F.col("key").alias("node")), "node").groupBy("key")
              .agg(F.array_sort(F.collect_list("node")).alias("stack")))
    begins = stacks.select("key", F.lit(1).alias("turn"), F.col("stack").alias("value"))
    ends = stacks.select(_end(F.col("key")).alias("key"), F.lit(0).alias("turn"),
                         F.slice("stack", 1, F.size("stack") - 1).alias("value"))
    return begins.unionByName(ends)


def judge_urls(pages: DataFrame, rules: DataFrame, id_col: str = "page_id", url_col: str = "url",
               default: str = "allow") -> DataFrame:
    """Verdict of the longest rule that fits each url.

    ``rules``: host, path, verdict.  A rule fits its host and all subdomains, if
    the url's path starts with the rule's path.  The longest rule wins: the most
    characters of host, then of path.  Of rules with the same host and path a
    ``block`` wins.  Rules with a null host or path are left out.

    A null url or one without :// has an empty host and path; an empty host fits
    no rule but one for the empty host.  Repeated rows stay.  Other columns are
    not looked at.  Empty pages give an empty result; without rules every url
    gets ``default``.  Returns page_id, host, path, rule (host and path, or
    null), verdict.
    """
    urls = pages.select(F.col(id_col).alias("page_id"), url_host(F.col(url_col)).alias("host"),
                        url_path(F.col(url_col)).alias("path"))
    rules = (rules.dropna(subset=["host", "path"]).groupBy("host", "path")
             .agg(F.max("verdict").alias("verdict"))  # block sorts behind allow
             .withColumn("hkey", F.encode(host_key(F.col("host")), "UTF-8")))

    # First sweep: which rule hosts are open at each host.
    hosts = stage(urls.select("host").distinct().withColumn("key", F.encode(host_key(F.col("host")), "UTF-8")),
                  "hosts")
    stacks = sweep(hosts.select("key"), _nested_marks(rules.select(F.col("hkey").alias("key")).distinct()))
    active = stage(hosts.join(stacks, "key").select("host", F.explode("value").alias("hkey")), "active-hosts")

    # Second sweep: within each open rule host, which rule's path is the longest open one.
    def path_key(hkey: Column, path: Column) -> Column:
        return F.concat(hkey, F.unhex(F.lit("00")), F.encode(path, "UTF-8"))

    keyed = rules.withColumn("key", path_key(F.col("hkey"), F.col("path")))
    pairs = stage(urls.select("host", "path").distinct().join(active, "host")
                  .withColumn("key", path_key(F.col("hkey"), F.col("path"))), "active-paths")
    innermost = sweep(pairs.select("key").distinct(), _nested_marks(keyed.select("key"))
                      .select("key", "turn", F.get("value", F.size("value") - 1).alias("value")))
    found = (pairs.join(innermost.filter("value is not null"), "key")
             .join(keyed.select(F.col("key").alias("value"), F.concat("host", "path").alias("rule"), "verdict",
                                F.length("host").alias("host_length")), "value"))
    best = found.groupBy("host", "path").agg(
        F.max_by(F.struct("rule", "verdict"), F.struct("host_length", F.length("rule"))).alias("best"))
    return (urls.join(best, ["host", "path"], "left")
            .select("page_id", "host", "path", F.col("best.rule").alias("rule"),
                    F.coalesce("best.verdict", F.lit(default)).alias("verdict")))
