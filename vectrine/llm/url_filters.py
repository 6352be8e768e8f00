"""URL lists that change over time, evaluated as of each capture.

A list's dated entries (add or remove a pattern) become validity intervals: an entry
holds from its date until the pattern's next one. A capture is judged by the
entries that hold at its fetch time, on the host, on every domain above it and
on every directory of its path.

The as-of join sorts captures and entries of a pattern together by time and carries
the last entry forward. Patterns are dealt out by (list, pattern, slice of time), and
each slice begins with the entry that holds there, so a host with a third of all
captures is as many groups as there are slices. All of it is linear: no capture
meets more than one entry of a pattern.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .html_extract import host_of

SLICE_SECONDS = 86_400
KEY = ["list", "pattern"]


def path_of(url: Column) -> Column:
    """The path, without query and fragment."""
    return F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*(/[^?#]*)", 1)


def patterns(url: Column) -> Column:
    """Every pattern that covers a URL: its host and the domains above (two labels or more), and host/directory prefixes."""
    host = host_of(url)
    labels = F.split(host, r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.greatest(F.size(labels) - 1, F.lit(1))), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    steps = F.filter(F.split(path_of(url), "/"), lambda s: s != "")
    prefixes = F.transform(F.sequence(F.lit(1), F.greatest(F.size(steps), F.lit(1))), lambda i: F.concat(host, F.lit("/"), F.array_join(F.slice(steps, 1, i), "/")))
    return F.when(host == "", F.array().cast("array<string>")).otherwise(F.array_distinct(F.concat(suffixes, F.when(F.size(steps) > 0, prefixes).otherwise(F.array().cast("array<string>")))))


def _slice(time: Column, seconds: int) -> Column:
    return F.floor(F.unix_seconds(time) / seconds)


def _entries(entries: DataFrame) -> DataFrame:
    """One entry per list, pattern and date; of several the add wins. Incomplete ones are dropped."""
    whole = entries.filter("list is not null and pattern is not null and since is not null and added is not null")
    return whole.groupBy(*KEY, "since").agg(F.max("added").alias("added"))


def validity(entries: DataFrame, seconds: int = SLICE_SECONDS) -> DataFrame:
    """``list, pattern, since, until, added``: until is null for the entry in force.

    The next entry is looked for in the same slice of time, then in the next slice
    that has one; a pattern's slices are few, its entries need not be.
    """
    known = _entries(entries).withColumn("slice", _slice(F.col("since"), seconds))
    first = known.groupBy(*KEY, "slice").agg(F.min("since").alias("first"))
    later = first.withColumn("later", F.lead("first").over(Window.partitionBy(*KEY).orderBy("slice"))).drop("first")
    inside = F.lead("since").over(Window.partitionBy(*KEY, "slice").orderBy("since"))
    return known.withColumn("next", inside).join(later, [*KEY, "slice"]).select(*KEY, "since", F.coalesce("next", "later").alias("until"), "added")


def as_of(captures: DataFrame, intervals: DataFrame, seconds: int = SLICE_SECONDS) -> DataFrame:
    """``url, fetched, list, pattern, since, until`` of every added interval that holds at a capture.

    ``captures``: distinct ``url, fetched``. ``intervals``: as ``validity`` gives them.
    """
    keys = intervals.select(*KEY).distinct()
    asked = captures.filter("url is not null and fetched is not null").select("url", "fetched", F.explode(patterns(F.col("url"))).alias("pattern")).join(keys, "pattern")
    asked = asked.withColumn("slice", _slice(F.col("fetched"), seconds))
    holds = F.struct("since", "until", "added")
    dated = intervals.withColumn("slice", _slice(F.col("since"), seconds)).select(*KEY, "slice", holds.alias("holds"))
    # What holds when a slice begins: the last entry of an earlier slice.
    ends = dated.groupBy(*KEY, "slice").agg(F.max("holds").alias("holds"))
    wanted = asked.select(*KEY, "slice").distinct().withColumn("holds", F.lit(None).cast(dated.schema["holds"].dataType))
    steps = ends.unionByName(wanted).groupBy(*KEY, "slice").agg(F.max("holds").alias("holds"))
    earlier = Window.partitionBy(*KEY).orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    begins = steps.select(*KEY, "slice", F.last("holds", ignorenulls=True).over(earlier).alias("holds")).filter("holds is not null")
    none = F.lit(None)
    rows = (
        asked.select(*KEY, "slice", "url", "fetched", none.cast(dated.schema["holds"].dataType).alias("holds"), F.col("fetched").alias("at"), F.lit(2).alias("turn"))
        .unionByName(dated.select(*KEY, "slice", none.cast("string").alias("url"), none.cast("timestamp").alias("fetched"), "holds", F.col("holds.since").alias("at"), F.lit(1).alias("turn")))
        .unionByName(begins.select(*KEY, "slice", none.cast("string").alias("url"), none.cast("timestamp").alias("fetched"), "holds", none.cast("timestamp").alias("at"), F.lit(0).alias("turn")))
    )
    upto = Window.partitionBy(*KEY, "slice").orderBy(F.col("at").asc_nulls_first(), "turn").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    found = rows.withColumn("now", F.last("holds", ignorenulls=True).over(upto)).filter("turn = 2 and now.added")
    return found.select("url", "fetched", *KEY, "now.since", "now.until")


def filter_urls(captures: DataFrame, entries: DataFrame, key: str = "page_id", url: str = "url", fetched: str = "fetched", seconds: int = SLICE_SECONDS) -> DataFrame:
    """One row per row of ``captures``: key, url, fetched, n_active, active, listed_since, blocked.

    ``entries``: ``list, pattern, since, added`` (true adds, false removes). An entry
    holds from its date on, that moment included, until the pattern's next entry on
    the same list; entries of one date count as added if any of them adds. Entries
    with a null are dropped. ``active`` names the lists and patterns in force,
    sorted. A capture without URL, host or time is on no list. Null keys and
    repeated rows are rows like any other; further columns are ignored, whatever
    their names; an empty list blocks nothing.
    """
    rows = captures.select(F.col(f"`{key}`").alias("key"), F.col(f"`{url}`").cast("string").alias("url"), F.col(f"`{fetched}`").cast("timestamp").alias("fetched"))
    found = as_of(rows.select("url", "fetched").distinct(), validity(entries, seconds), seconds)
    facts = found.groupBy("url", "fetched").agg(F.array_sort(F.collect_set(F.concat_ws(":", *KEY))).alias("names"), F.min("since").alias("since"))
    facts = facts.select(F.col("url").alias("__url"), F.col("fetched").alias("__fetched"), "names", "since")
    joined = rows.join(facts, (F.col("url") == F.col("__url")) & (F.col("fetched") == F.col("__fetched")), "left")
    n = F.when(F.col("names").isNull(), F.lit(0)).otherwise(F.size("names"))
    return joined.select(
        F.col("key").alias(key),
        F.col("url").alias(url),
        F.col("fetched").alias(fetched),
        n.cast("long").alias("n_active"),
        F.coalesce(F.array_join("names", ","), F.lit("")).alias("active"),
        F.col("since").alias("listed_since"),
        (n > 0).alias("blocked"),
    )
