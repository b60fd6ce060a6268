"""URL filters by a temporal join with dated lists; DataFrame operations only.

A list is a log of dated entries: a rule (a domain with all below it, or a path with all below it) is added or removed. Entries
become validity intervals, and an as-of join finds, for every capture, the entries that were active when it was fetched. An interval
is cut at the ends of periods and joined on rule and period, so that captures of a busy domain spread over the
periods, no rule is compared with captures of another time, and skewed keys can be split by Spark.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.session import materialize

#: days of a period
PERIOD = 32
DOMAIN, PREFIX = "domain", "prefix"


def host(url: Column) -> Column:
    """The host in lower case, without user and port; empty where there is none."""
    authority = F.regexp_extract(F.coalesce(url, F.lit("")), "^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1)
    return F.lower(F.regexp_replace(F.regexp_replace(authority, "^.*@", ""), ":[0-9]*$", ""))


def path(url: Column) -> Column:
    """The path without query, fragment and closing slashes."""
    return F.regexp_replace(F.regexp_extract(F.coalesce(url, F.lit("")), "^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)", 1), "/+$", "")


def domain_rules(host: Column) -> Column:
    """The host and all domains above it that have two labels or more."""
    labels = F.filter(F.split(host, "\\."), lambda x: x != "")
    n = F.size(labels)
    return F.when(n >= 2, F.transform(F.sequence(F.lit(2), n), lambda k: F.array_join(F.slice(labels, n - k + 1, k), "."))).otherwise(
        F.when(n == 1, labels).otherwise(F.array().cast("array<string>"))
    )


def prefix_rules(host: Column, path: Column) -> Column:
    """The host with the path and with every folder above it, the host alone not among them."""
    parts = F.filter(F.split(path, "/"), lambda x: x != "")
    n = F.size(parts)
    return F.when((n >= 1) & (host != ""), F.transform(F.sequence(F.lit(1), n), lambda k: F.concat_ws("/", host, F.array_join(F.slice(parts, 1, k), "/")))).otherwise(
        F.array().cast("array<string>")
    )


def rules(url: Column) -> Column:
    """All rules, ``kind`` and ``rule``, that a URL falls under."""
    h = host(url)
    return F.concat(
        F.transform(domain_rules(h), lambda r: F.struct(F.lit(DOMAIN).alias("kind"), r.alias("rule"))),
        F.transform(prefix_rules(h, path(url)), lambda r: F.struct(F.lit(PREFIX).alias("kind"), r.alias("rule"))),
    )


def intervals(entries: DataFrame) -> DataFrame:
    """``list, kind, rule, since, until``: when a rule was on a list, ``until`` exclusive and null where it still is.

    ``entries`` has ``list, kind, rule, added boolean, day int``. Of several entries of one day an addition wins. Entries with a
    null anywhere play no part; a removal of what is not listed and an addition of what is listed already change nothing. Per rule there is
    one row a day at most before rows are put in order.
    """
    names = ["list", "kind", "rule", "day", "added"]
    rows = entries.select(*names).dropna().groupBy("list", "kind", "rule", "day").agg(F.max("added").alias("added"))
    w = Window.partitionBy("list", "kind", "rule").orderBy("day")
    rows = rows.withColumn("_was", F.lag("added").over(w)).filter(F.col("added") != F.coalesce("_was", F.lit(False)))
    rows = rows.withColumn("until", F.lead("day").over(w)).filter("added")
    return rows.select("list", "kind", "rule", F.col("day").alias("since"), "until")


def filter_urls(captures: DataFrame, entries: DataFrame, key: str = "page_id", url: str = "url", day: str = "day") -> DataFrame:
    """The list entries active for every capture at its fetch day.

    ``page_id, day, n_active, lists, since, blocked``: active entries, the names of their lists, and the earliest day from which one of
    them holds. One row per different (key, URL, day) of ``captures``. A null or unreadable URL falls under no rule, a capture without a
    day meets no entry; both come out unblocked. A capture on the day of an addition is blocked, on that of a
    removal not. Empty tables give no rows or no blocked ones.
    """
    rows = captures.select(F.col(key).alias("page_id"), F.col(url).cast("string").alias("url"), F.col(day).cast("int").alias("day"))
    rows = rows.withColumn("_id", F.xxhash64("page_id", "url", "day"))
    looks = rows.select("page_id", "_id", "url", "day", F.explode(rules(F.col("url"))).alias("_r"))
    looks = looks.select("page_id", "_id", "day", F.col("_r.kind").alias("kind"), F.col("_r.rule").alias("rule"), F.floor(F.col("day") / PERIOD).alias("period"))
    held = materialize(intervals(entries), "url-intervals")
    last = rows.agg(F.max("day")).first()[0]
    ends = F.coalesce(F.col("until"), F.greatest(F.lit(0 if last is None else last + 1), F.col("since") + 1)) - 1
    held = held.withColumn("period", F.explode(F.sequence(F.floor(F.col("since") / PERIOD), F.floor(ends / PERIOD))))
    # intervals and hits grow with lists and captures: merge joins, nothing goes to every task
    hits = looks.join(held.hint("merge"), ["kind", "rule", "period"]).filter((F.col("day") >= F.col("since")) & (F.col("until").isNull() | (F.col("day") < F.col("until"))))
    found = hits.groupBy("_id").agg(F.count("*").alias("n_active"), F.array_join(F.sort_array(F.collect_set("list")), ",").alias("lists"), F.min("since").alias("since"))
    out = rows.select("_id", "page_id", "day").distinct().join(found.hint("merge"), "_id", "left")
    active = F.coalesce("n_active", F.lit(0).cast("long"))
    return out.select("page_id", "day", active.alias("n_active"), F.coalesce("lists", F.lit("")).alias("lists"), "since", (active > 0).alias("blocked"))
