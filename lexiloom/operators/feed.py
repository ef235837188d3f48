"""The change feed: notices of new rows, merging entries, retracting them, keeping the newest."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KEY = ("date", "journal", "volume", "issue")


def notices(new: DataFrame, group: list[str], source: str) -> DataFrame:
    """group..., count, source: how many new rows each issue has and from which sources, joined by +."""
    return new.groupBy(*group).agg(F.count(F.lit(1)).alias("count"), F.array_join(F.array_sort(F.collect_set(source)), "+").alias("source"))


def merge_entries(feed: DataFrame, entries: DataFrame, key: tuple[str, ...] = KEY, keep: int | None = 300) -> DataFrame:
    """Entries of one key add their counts and join their sources as a set; the newest ``keep`` by date stay."""
    both = feed.unionByName(entries)
    merged = both.groupBy(*key).agg(F.sum("count").cast("long").alias("count"), F.array_join(F.array_sort(F.collect_set("source")), "+").alias("source"))
    return merged.orderBy(F.desc(key[0]), *key[1:]).limit(keep) if keep else merged


def retract(feed: DataFrame, taken: DataFrame, key: tuple[str, ...] = KEY) -> DataFrame:
    """Counts less those taken back; entries that come to nothing go."""
    both = feed.select(*key, "count").unionByName(taken.select(*key, (-F.col("count")).alias("count")))
    return both.groupBy(*key).agg(F.sum("count").cast("long").alias("count")).filter(F.col("count") > 0)
