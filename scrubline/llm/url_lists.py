"""URL filters by dated lists, with DataFrame functions only.

A list entry says that from its day on a key is blocked or allowed.  A key is a host
(it also covers hosts below it; a host of one label such as ``zip`` covers all that end
in it) or a host and the first segments of a path.  Keys are read as URLs are, so
``Example.COM``, ``example.com/``, ``http://example.com`` and ``example.com.`` are one key.  The
entries of a key, in order of days, become validity intervals: each holds until the
next one.  A capture asks for all its keys, host suffixes and path prefixes, and is
joined with the interval that holds on its day.  The most specific key with an entry
decides: a path before a host, more segments before fewer.

The join is on key and bin of days, so that a key with many entries, or a host with a
third of all captures, does not compare each capture with each entry: an interval is
in those bins it touches that captures are in, a capture in one.  Runs of such bins come
to the driver: a few, and fewer than there are 64-day spans in the calendar.
Captures with the same key and day ask once.

Defined cases: a null or empty URL has no keys and is not blocked; scheme, user, port,
query and fragment do not count, hosts are lower-cased and lose dots at their end, path
segments are compared as written and empty ones left out; of entries of one key and day
"allow" wins; entries without a host, day or known action are ignored; captures without a
day match nothing; rows that are repeated keep their rows; empty tables give empty
results or nothing blocked; further columns do not matter.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stage

BIN_DAYS = 64
HOST = r"^(?:[A-Za-z][A-Za-z0-9+.-]*://)?(?:[^/?#@]*@)?([^/?#:]*)"
# a host without a scheme does not end in a colon, so that the slashes of a scheme are no path
PATH = r"^(?:[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*|[^/?#]*[^/?#:]|)(/[^?#]*)"


def host_of(url: Column) -> Column:
    return F.rtrim(F.lower(F.regexp_extract(url, HOST, 1)), F.lit("."))


def segments_of(url: Column) -> Column:
    return F.array_remove(F.split(F.regexp_extract(url, PATH, 1), "/"), "")


def entry_key(key: Column) -> Column:
    """The key of a list entry in the form that captures ask for; empty without a host."""
    host = host_of(F.trim(key))
    return F.when(host != "", F.array_join(F.concat(F.array(host), segments_of(F.trim(key))), "/")).otherwise("")


def keys_of(url: Column) -> Column:
    """Host suffixes, and the host with each path prefix: structs of ``rank`` (the larger,
    the more specific) and ``key``."""
    none = F.array().cast("array<struct<rank:int,key:string>>")
    host, parts = host_of(url), segments_of(url)
    labels = F.split(host, r"\.")
    count = F.size(labels)
    hosts = F.transform(
        F.sequence(F.lit(1), count),
        lambda n: F.struct(n.alias("rank"), F.array_join(F.slice(labels, count - n + 1, n), ".").alias("key")),
    )
    paths = F.when(
        F.size(parts) > 0,
        F.transform(
            F.sequence(F.lit(1), F.size(parts)),
            lambda n: F.struct((n + 1000).alias("rank"), F.concat(host, F.lit("/"), F.array_join(F.slice(parts, 1, n), "/")).alias("key")),
        ),
    ).otherwise(none)
    return F.when(F.coalesce(host, F.lit("")) != "", F.concat(hosts, paths)).otherwise(none)


def intervals(entries: DataFrame) -> DataFrame:
    """``key``, ``action``, ``since`` and ``until`` (exclusive, null: still holds) from
    entries ``key``, ``day``, ``action``."""
    fine = entries.withColumn("key", entry_key(F.col("key")))
    fine = fine.filter("key != '' and day is not null and action in ('allow', 'block')")
    days = fine.groupBy("key", "day").agg(F.min("action").alias("action"))
    after = Window.partitionBy("key").orderBy("day")
    return days.select("key", "action", F.col("day").alias("since"), F.lead("day").over(after).alias("until"))


def _bins_within(bins: list[int], low: Column, high: Column) -> Column:
    """Those of the sorted ``bins`` that lie between ``low`` and ``high`` (null: no end)."""
    starts = [b for i, b in enumerate(bins) if not i or bins[i - 1] != b - 1]
    ends = [b for i, b in enumerate(bins) if i + 1 == len(bins) or bins[i + 1] != b + 1]
    parts = [F.array().cast("array<bigint>")]
    for start, end in zip(starts, ends):
        first, last = F.greatest(low, F.lit(start)), F.least(F.coalesce(high, F.lit(end)), F.lit(end))
        parts.append(F.when(first <= last, F.sequence(first, last)).otherwise(parts[0]))
    return F.concat(*parts)


def filter_urls(captures: DataFrame, entries: DataFrame, kept: list[str], url_col: str = "url", day_col: str = "day") -> DataFrame:
    """The columns ``kept`` of every capture, ``blocked``, and of the entry that decided
    ``matched_key`` and ``listed_on`` (null without one)."""
    rows = stage(
        captures.select(
            F.struct(*kept).alias("row"), F.col(url_col).alias("url"), F.col(day_col).alias("day"), F.monotonically_increasing_id().alias("at")
        ),
        "captures",
    )
    epoch = F.lit("1970-01-01").cast("date")

    def bin_of(day: Column) -> Column:
        return F.floor(F.datediff(day, epoch) / BIN_DAYS)

    asked = rows.select("at", "day", F.explode(keys_of(F.col("url"))).alias("k")).select("at", "day", "k.*")
    once = asked.select("key", "day").distinct().withColumn("bin", bin_of(F.col("day")))
    bins = sorted(r[0] for r in rows.filter("day is not null").select(bin_of(F.col("day"))).distinct().collect())
    held = intervals(entries).select(
        "*", F.explode(_bins_within(bins, bin_of(F.col("since")), bin_of(F.date_sub("until", 1)))).alias("bin")
    )
    active = (
        once.join(held, ["key", "bin"])
        .filter((F.col("since") <= F.col("day")) & (F.col("until").isNull() | (F.col("day") < F.col("until"))))
        .select("key", "day", "action", "since")
    )
    best = (
        asked.join(active, ["key", "day"])
        .groupBy("at")
        .agg(F.max(F.struct("rank", "key", "action", "since")).alias("best"))
    )
    return rows.join(best, "at", "left").select(
        "row.*",
        F.coalesce(F.col("best.action") == "block", F.lit(False)).alias("blocked"),
        F.col("best.key").alias("matched_key"),
        F.col("best.since").alias("listed_on"),
    )
