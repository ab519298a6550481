"""Captures judged by dated URL lists: an as-of join on the time of the fetch.

List entries are dated changes: a pattern is added to a list or removed from it. Per list and
pattern they become validity intervals, from an addition to the next change. A capture meets the
intervals of its host, of the domains above it and of the paths above its own, and of those that
hold on its day the most specific decides: the longest path, then the longest host; where an
allow list and a block list agree on that, the allow list.

A pattern is a host (``example.com``, which covers its subdomains) or a host with a path
(``example.com/a/b``, which covers that host and all below the path). Hosts are compared in lower
case, without user, port and a final dot; queries and fragments do not count.

Null or hostless URLs and captures without a day match nothing. Entries without a pattern, day,
list or known action are ignored; repeated ones count once; of an addition and a removal on the
same day the removal holds. Rows that repeat get equal results. Empty tables give no rows, or
captures that are all ``unlisted``. Other columns stay, but for those with the names of results. Only DataFrame operations are used.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

HOST = r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)"
PATH = r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*(/[^?#]*)"
ADD, REMOVE = "add", "remove"
ALLOW, BLOCK, UNLISTED = "allow", "block", "unlisted"


def host_of(url: Column) -> Column:
    return F.rtrim(F.lower(F.regexp_extract(url, HOST, 1)), F.lit("."))


def segments_of(path: Column) -> Column:
    return F.filter(F.split(path, "/"), lambda s: s != "")


def validity_intervals(entries: DataFrame) -> DataFrame:
    """Intervals (list, verdict, pattern, valid_from, valid_to) in which a pattern is on a list.

    ``entries`` has (list, verdict, pattern, action, effective_on); ``valid_to`` is the first day
    on which it is not, or null.
    """
    known = entries.where(
        F.col("list").isNotNull() & F.col("pattern").isNotNull() & F.col("effective_on").isNotNull()
        & F.col("action").isin(ADD, REMOVE) & F.col("verdict").isin(ALLOW, BLOCK)
    )
    # One change per day, so a pattern's history is as long as its days at most.
    daily = known.groupBy("list", "verdict", "pattern", "effective_on").agg(
        F.max("action").alias("action")
    )
    history = Window.partitionBy("list", "verdict", "pattern").orderBy("effective_on")
    dated = daily.withColumn("valid_to", F.lead("effective_on").over(history))
    return dated.where(F.col("action") == ADD).select(
        "list", "verdict", "pattern", F.col("effective_on").alias("valid_from"), "valid_to"
    )


def _keys(host: Column, path: Column, deepest: int) -> Column:
    """The patterns that may cover a URL; paths down to the deepest that the lists have."""
    labels = F.split(host, r"\.")
    hosts = F.transform(
        F.sequence(F.lit(1), F.size(labels)),
        lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."),
    )
    parts = F.slice(segments_of(path), 1, max(deepest, 1))
    depths = F.sequence(F.lit(0), F.least(F.size(parts), F.lit(deepest)))
    paths = F.transform(
        F.filter(depths, lambda i: i > 0),
        lambda i: F.concat(host, F.lit("/"), F.array_join(F.slice(parts, F.lit(1), i), "/")),
    )
    return F.when(host != "", F.concat(hosts, paths)).otherwise(F.array().cast("array<string>"))


def normalised_pattern(pattern: Column) -> Column:
    """Host in lower case, path with single slashes and none at its end."""
    host = F.lower(F.substring_index(pattern, "/", 1))
    parts = F.filter(
        F.slice(F.split(pattern, "/"), F.lit(2), F.size(F.split(pattern, "/"))), lambda s: s != ""
    )
    return F.when(
        F.size(parts) > 0, F.concat(host, F.lit("/"), F.array_join(parts, "/"))
    ).otherwise(host)


def judge(
    captures: DataFrame, entries: DataFrame, url_col: str = "url", day_col: str = "fetched_on"
) -> DataFrame:
    """Every row of ``captures`` with ``verdict``, ``list``, ``pattern`` and ``valid_from``.

    The join works on distinct URLs and days. Its keys are patterns, so a very common host is a
    hot key of the captures' side only, which adaptive execution splits.
    """
    intervals = validity_intervals(
        entries.withColumn("pattern", normalised_pattern(F.col("pattern")))
    )
    depth = F.size(F.split("pattern", "/")) - 1
    deepest = intervals.agg(F.max(depth)).first()[0] or 0
    distinct = captures.select(F.col(url_col).alias("_url"), F.col(day_col).alias("_day")).distinct()
    host, path = host_of(F.col("_url")), F.regexp_extract("_url", PATH, 1)
    keyed = (
        distinct.where(F.col("_url").isNotNull() & F.col("_day").isNotNull())
        .withColumn("_host", host)
        .withColumn("_path", path)
        .select("_url", "_day", F.explode(_keys(F.col("_host"), F.col("_path"), deepest)).alias("pattern"))
    )
    active = (F.col("valid_from") <= F.col("_day")) & (
        F.col("valid_to").isNull() | (F.col("_day") < F.col("valid_to"))
    )
    rank = F.struct(
        depth.alias("depth"),
        F.length("pattern").alias("length"),
        (F.col("verdict") == ALLOW).alias("allows"),
        "verdict", "list", "pattern", "valid_from",
    )
    hits = keyed.join(intervals, "pattern").where(active)
    decided = hits.groupBy("_url", "_day").agg(F.max(rank).alias("_hit"))
    hit = decided["_hit"]
    same = (captures[url_col] == decided["_url"]) & (captures[day_col] == decided["_day"])
    results = ("list", "pattern", "valid_from")
    return captures.join(decided, same, "left").select(
        *[captures[c] for c in captures.columns if c not in ("verdict", *results)],
        F.coalesce(hit["verdict"], F.lit(UNLISTED)).alias("verdict"),
        *[hit[c].alias(c) for c in results],
    )
