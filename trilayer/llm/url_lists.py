"""URL filter lists as they stood when a page was fetched.

List entries are dated additions and removals of patterns: a host, a domain with all its
hosts, or a host with the beginning of a path. They become validity intervals, cut at the
borders of time buckets, so that each interval is found by pattern and bucket. A capture
is turned into the patterns it could match, and an as-of join finds the intervals that
hold its fetch time; a list pattern is active in one of them at most.

Times are seconds (long). At equal times an addition counts after a removal. Only
patterns as deep as the deepest entry are made of a capture, so long urls stay cheap.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trilayer.operators.joins import broadcast_if_small
from trilayer.workspace import written

BUCKET = 30 * 86_400
_START = r"^[A-Za-z][A-Za-z0-9+.-]*://"


def host(url: Column) -> Column:
    return F.lower(F.regexp_extract(url, _START + r"(?:[^/?#@]*@)?([^/?#:]*)", 1))


def path(url: Column) -> Column:
    return F.regexp_extract(url, _START + r"[^/?#]*([^?#]*)", 1)


def patterns(url: Column, labels: int, segments: int) -> Column:
    """Every pattern that a url matches: `host:`, `domain:` of at most so many labels,
    `prefix:` of at most so many path segments. Empty for what has no host."""
    name = host(url)
    parts = F.split(name, r"\.")
    steps = F.filter(F.split(path(url), "/"), lambda s: s != "")
    domains = F.transform(
        F.sequence(F.lit(1), F.least(F.size(parts), F.lit(max(1, labels)))),
        lambda k: F.concat(F.lit("domain:"), F.array_join(F.slice(parts, -k, k), ".")),
    )
    prefixes = F.transform(
        F.slice(F.sequence(F.lit(0), F.greatest(F.lit(1), F.least(F.size(steps), F.lit(segments)))),
                F.lit(2), F.least(F.size(steps), F.lit(segments))),
        lambda k: F.concat(F.lit("prefix:"), name, F.lit("/"),
                           F.array_join(F.slice(steps, F.lit(1), k), "/")),
    )
    return F.when(name != "", F.concat(F.array(F.concat(F.lit("host:"), name)), domains, prefixes)
                  ).otherwise(F.array().cast("array<string>"))


def intervals(entries: DataFrame, asked: DataFrame, bucket: int = BUCKET) -> DataFrame:
    """``entries`` (list, pattern, action, at) as the times (since, until) in which a pattern
    is on a list, cut at the borders of time buckets; until is exclusive.

    A state is carried on only to the buckets for which ``asked`` (pattern, bucket; distinct)
    asks its pattern, however far off these are. Actions other than `add` and `remove` and
    rows with a null are left out; repeated rows and additions of what is on the list change
    nothing. Windows run over one bucket of a pattern, and over the buckets of a pattern that
    have entries.
    """
    known = entries.select("list", "pattern", "action", F.col("at").cast("long").alias("at"))
    known = known.dropna().filter(F.col("action").isin("add", "remove"))
    known = known.groupBy("list", "pattern", "at").agg(
        F.max(F.col("action") == "add").alias("on")
    ).withColumn("bucket", F.floor(F.col("at") / bucket))
    own = Window.partitionBy("list", "pattern", "bucket").orderBy("at")
    end = (F.col("bucket") + 1) * bucket
    inside = known.withColumn("until", F.coalesce(F.lead("at").over(own), end)).filter("on").select(
        "list", "pattern", "bucket", F.col("at").alias("since"), "until")
    states = known.groupBy("list", "pattern", "bucket").agg(
        F.min("at").alias("first"), F.max_by("on", "at").alias("on"))
    by_bucket = Window.partitionBy("list", "pattern").orderBy("bucket")
    following = states.withColumn("next", F.lead("bucket").over(by_bucket)).withColumn(
        "next_first", F.lead("first").over(by_bucket)).filter("on").withColumnRenamed("bucket", "from")
    later = (F.col("bucket") > F.col("from")) & F.coalesce(F.col("bucket") <= F.col("next"), F.lit(True))
    carried = following.join(asked, "pattern").filter(later).select(
        "list", "pattern", "bucket", (F.col("bucket") * bucket).alias("since"),
        F.when(F.col("bucket") == F.col("next"), F.col("next_first")).otherwise(end).alias("until"),
    )
    return inside.unionByName(carried).filter("since < until")


def evaluate(captures: DataFrame, entries: DataFrame, id_column: str = "page_id",
             url: str = "url", at: str = "fetched_at", bucket: int = BUCKET) -> DataFrame:
    """Per row of ``captures``: the id, url, fetched_at, blocked, n_active and active (the
    sorted `list pattern` entries in force then). Repeated rows stay rows of their own. Null
    urls or times, and urls without a host, are blocked by nothing; times may be of any
    size. Other columns are ignored."""
    rows = written(
        captures.select(
            F.col(id_column), F.col(url).alias("url"), F.col(at).cast("long").alias("fetched_at"),
            F.monotonically_increasing_id().alias("capture"),
        ),
        "list-captures",
    )
    entries = written(entries.select("list", "pattern", "action", "at"), "list-entries")
    body = F.substring_index("pattern", ":", -1)
    kind = F.substring_index("pattern", ":", 1)
    deepest = entries.agg(
        F.max(F.when(kind == "domain", F.size(F.split(body, r"\.")))),
        F.max(F.when(kind == "prefix", F.size(F.split(body, "/")) - 1)),
    ).first()
    wanted = F.coalesce(patterns(F.col("url"), deepest[0] or 0, deepest[1] or 0),
                        F.array().cast("array<string>"))
    asked = rows.withColumn("asked", F.explode_outer(wanted)).withColumn(
        "in_bucket", F.floor(F.col("fetched_at") / bucket))
    listed = broadcast_if_small(entries.select("pattern").distinct())
    pairs = asked.select(F.col("asked").alias("pattern"), F.col("in_bucket").alias("bucket")).join(
        listed, "pattern", "left_semi").dropna().distinct()
    valid = broadcast_if_small(written(intervals(entries, pairs, bucket), "list-intervals"))
    found = asked.join(
        valid,
        (F.col("asked") == F.col("pattern")) & (F.col("in_bucket") == F.col("bucket"))
        & (F.col("since") <= F.col("fetched_at")) & (F.col("fetched_at") < F.col("until")),
        "left",
    )
    active = F.collect_set(F.when(F.col("list").isNotNull(),
                                  F.concat_ws(" ", "list", "pattern"))).alias("active")
    return (
        found.groupBy("capture", id_column, "url", "fetched_at").agg(active)
        .select(id_column, "url", "fetched_at",
                (F.size("active") > 0).alias("blocked"),
                F.size("active").cast("long").alias("n_active"),
                F.array_sort("active").alias("active"))
    )
