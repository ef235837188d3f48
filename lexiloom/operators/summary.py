"""Aggregates: modes with stated ties, arg-max, quality figures, facets, nested outputs, ordered runs of days."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.rules import significant
from .dedupe import first_wins


def mode_by(df: DataFrame, group: list[str], value: list[str], first_seen: str) -> DataFrame:
    """The commonest value (or tuple) of each group; of equally common ones that which came first."""
    counts = df.groupBy(*group, *value).agg(F.count(F.lit(1)).alias("n"), F.min(first_seen).alias("_first"))
    return first_wins(counts, group, [F.desc("n"), "_first"]).drop("_first")


def arg_max(df: DataFrame, group: list[str], value: str, by: str) -> DataFrame:
    """The value with the largest measure in each group; the smaller value of equal ones."""
    return first_wins(df.select(*group, value, by), group, [F.desc(by), value])


def top_counts(df: DataFrame, column: str, k: int) -> DataFrame:
    return df.groupBy(column).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), column).limit(k)


def facets(df: DataFrame, columns: list[str]) -> DataFrame:
    """facet, value, n for several columns in one pass."""
    each = F.explode(F.array(*[F.struct(F.lit(c).alias("facet"), F.col(c).cast("string").alias("value")) for c in columns]))
    return df.select(each.alias("f")).groupBy("f.facet", "f.value").agg(F.count(F.lit(1)).alias("n")).select("facet", "value", "n")


def quality_report(df: DataFrame, group: str, comparable: Column, matched: Column) -> DataFrame:
    """Per group: rows, comparable and matched ones, and the match rate (null without comparable rows)."""
    sums = df.groupBy(group).agg(F.count(F.lit(1)).alias("n"), F.count_if(comparable).alias("comparable"), F.count_if(comparable & matched).alias("matched"))
    return sums.withColumn("match_rate", F.round(F.try_divide("matched", "comparable"), 3))


def nested(df: DataFrame, outer: str, inner: str, item: str) -> DataFrame:
    """outer, groups: an array of (inner, items), both ascending."""
    one = df.groupBy(outer, inner).agg(F.sort_array(F.collect_list(item)).alias("items"))
    return one.groupBy(outer).agg(F.sort_array(F.collect_list(F.struct(inner, "items"))).alias("groups"))


def islands(days: DataFrame, day: str, group: list[str] | None = None, most: int | None = None) -> DataFrame:
    """Runs of consecutive days (cut after ``most`` of them): group..., first_day, last_day, n_days."""
    group = group or []
    rows = days.select(*group, F.col(day).cast("date").alias("_day")).distinct()
    order = Window.partitionBy(*group).orderBy("_day")
    rows = rows.withColumn("_run", F.date_sub("_day", F.row_number().over(order)))
    cut = F.lit(0) if not most else F.floor((F.row_number().over(Window.partitionBy(*group, "_run").orderBy("_day")) - 1) / most)
    rows = rows.withColumn("_cut", cut)
    return rows.groupBy(*group, "_run", "_cut").agg(F.min("_day").alias("first_day"), F.max("_day").alias("last_day"), F.count(F.lit(1)).alias("n_days")).drop("_run", "_cut")


def stop_after_empty(df: DataFrame, group: list[str], order: str, empty: Column, most: int = 3) -> DataFrame:
    """Rows of each group up to the ``most``-th empty one in a row."""
    w = Window.partitionBy(*group).orderBy(order)
    rows = df.withColumn("_empty", empty.cast("int"))
    streak = F.sum("_empty").over(w.rowsBetween(-(most - 1), Window.currentRow))
    rows = rows.withColumn("_full", (streak == most).cast("int"))
    before = F.coalesce(F.sum("_full").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return rows.withColumn("_over", before).filter("_over = 0").drop("_empty", "_full", "_over")


def top_n(df: DataFrame, group: list[str], order: list, n: int) -> DataFrame:
    rank = F.row_number().over(Window.partitionBy(*group).orderBy(*order))
    return df.withColumn("_rank", rank).filter(F.col("_rank") <= n).drop("_rank")


def first_middle_last(df: DataFrame, group: list[str], order: list[str]) -> DataFrame:
    """The first, middle and last row of each group."""
    w = Window.partitionBy(*group)
    rows = df.withColumn("_rank", F.row_number().over(w.orderBy(*order))).withColumn("_n", F.count(F.lit(1)).over(w))
    return rows.filter((F.col("_rank") == 1) | (F.col("_rank") == F.floor(F.col("_n") / 2) + 1) | (F.col("_rank") == F.col("_n"))).drop("_rank", "_n")


def in_ranges(rows: DataFrame, value: str, ranges: DataFrame, low: str, high: str, width: int) -> DataFrame:
    """Rows whose value lies in any of the ranges (ends included), joined by buckets of ``width``."""
    wide = ranges.select(F.col(low).alias("_low"), F.col(high).alias("_high"), F.explode(F.sequence(F.floor(F.col(low) / width), F.floor(F.col(high) / width))).alias("_bucket"))
    own = rows.withColumn("_own", F.floor(F.col(value) / width))
    return own.join(wide, (F.col("_own") == F.col("_bucket")) & F.col(value).between(F.col("_low"), F.col("_high")), "left_semi").drop("_own")


def coverage(years: DataFrame, group: str, year: str, count: str) -> DataFrame:
    """group, year where the year and both neighbours were looked at and had no rows."""
    around = years.select(group, F.explode(F.array(F.col(year) - 1, F.col(year), F.col(year) + 1)).alias("year"), (F.col(count) == 0).alias("_none"))
    return around.groupBy(group, "year").agg(F.count(F.lit(1)).alias("_n"), F.every("_none").alias("_all")).filter("_n = 3 and _all").select(group, "year")


def page_walk(links: DataFrame, group: list[str], page: str, key: str, least: int = 10) -> DataFrame:
    """The links of each group that a walk over its pages collects: each key where it comes first, up to the page that brings
    nothing new or has fewer than ``least`` links (its own still count)."""
    first = links.groupBy(*group, key).agg(F.min(page).alias(page))
    per = links.groupBy(*group, page).agg(F.count_distinct(key).alias("_n")).join(first.groupBy(*group, page).agg(F.count(F.lit(1)).alias("_new")), [*group, page], "left")
    ends = (F.coalesce("_new", F.lit(0)) == 0) | (F.col("_n") < least)
    last = per.groupBy(*group).agg(F.min(F.when(ends, F.col(page))).alias("_last"))
    return first.join(last, group).filter(F.col("_last").isNull() | (F.col(page) <= F.col("_last"))).drop("_last")


def numbering_scheme(pairs: DataFrame, rows: DataFrame, group: str, pos: str, this_year: int) -> DataFrame:
    """group, scheme: where a source puts the number that the other calls a volume.

    From pairs (left_volume, left_issue, right_volume, right_issue) the commonest way, of equally common ones the first by
    ``pos``: i2v if only an issue on the right is a volume on the left, v2i the other way round, else same.  Groups without pairs
    go by their rows (volume, issue, year) of the last ten years, or all if there are none: more than twice as
    many with only a volume than with only an issue make i2v, the other way round v2i.
    """
    lv, li, rv, ri = (significant(F.col(c)) for c in ("left_volume", "left_issue", "right_volume", "right_issue"))
    way = F.when(ri.isNotNull() & rv.isNull() & lv.isNotNull() & li.isNull(), "i2v").when(rv.isNotNull() & ri.isNull() & li.isNotNull() & lv.isNull(), "v2i").otherwise("same")
    learnt = mode_by(pairs.withColumn("scheme", way), [group], ["scheme"], pos).select(F.col(group).alias("_g"), F.col("scheme").alias("_learnt"))
    recent = F.col("year") >= this_year - 10
    volume, issue = significant(F.col("volume")), significant(F.col("issue"))
    count = lambda c, when: F.count_if(c & when)
    only_v, only_i = volume.isNotNull() & issue.isNull(), issue.isNotNull() & volume.isNull()
    sums = rows.groupBy(group).agg(F.count_if(recent).alias("_r"), count(only_v, recent).alias("_rv"), count(only_i, recent).alias("_ri"), F.count_if(only_v).alias("_v"), F.count_if(only_i).alias("_i"))
    v, i = F.when(F.col("_r") > 0, F.col("_rv")).otherwise(F.col("_v")), F.when(F.col("_r") > 0, F.col("_ri")).otherwise(F.col("_i"))
    guessed = F.when(v > i * 2, "i2v").when(i > v * 2, "v2i").otherwise("same")
    every = sums.select(group, guessed.alias("_guess")).join(learnt, F.col(group).eqNullSafe(F.col("_g")), "full_outer")
    return every.select(F.coalesce(group, "_g").alias(group), F.coalesce("_learnt", "_guess").alias("scheme"))


def journal_report(left: DataFrame, right: DataFrame, schemes: DataFrame, group: str) -> DataFrame:
    """The twelve figures of each group of the driving source.

    ``left`` has n_dups (rows merged into each); ``right`` has link_only, front, paired, comparable (booleans), publisher and
    the gate's verdict; ``schemes`` has scheme.
    """
    own = left.groupBy(group).agg(F.count(F.lit(1)).alias("riss"), F.sum("n_dups").cast("long").alias("riss_dups"))
    real, alone = ~F.col("link_only"), ~F.col("link_only") & ~F.col("paired") & ~F.col("front")
    bad = F.array_sort(F.collect_set(F.when(real & (F.col("verdict") == "rejected"), F.coalesce("publisher", F.lit("?")))))
    other = right.groupBy(group).agg(
        F.count_if(real).alias("kci"),
        F.count_if(~real).alias("kci_links"),
        F.count_if(real & F.col("paired")).alias("paired"),
        F.count_if(alone & (F.col("verdict") == "trusted")).alias("kci_only"),
        F.count_if(alone & (F.col("verdict") != "trusted")).alias("held"),
        F.count_if(real & F.col("comparable")).alias("comparable"),
        F.count_if(real & F.col("comparable") & F.col("paired")).alias("comparable_matched"),
        bad.alias("bad_publishers"),
    )
    counts = ["kci", "kci_links", "paired", "kci_only", "held", "comparable", "comparable_matched"]
    joined = own.join(other, group, "left").join(schemes, group, "left")
    rate = F.round(F.try_divide("comparable_matched", "comparable"), 3)
    return joined.select(group, "riss", "riss_dups", *[F.coalesce(c, F.lit(0)).alias(c) for c in counts], F.coalesce("bad_publishers", F.array().cast("array<string>")).alias("bad_publishers"), F.coalesce("scheme", F.lit("same")).alias("scheme"), rate.alias("match_rate"))


def report_lines(report: DataFrame, group: str, measures: list[str]) -> DataFrame:
    """line: a Markdown table of a report, one row a line, with a place to sort by."""
    head = [(0, "| " + " | ".join([group, *measures]) + " |"), (1, "|" + "-|" * (len(measures) + 1))]
    cells = F.concat(F.lit("| "), F.concat_ws(" | ", *[F.coalesce(F.col(c).cast("string"), F.lit("-")) for c in [group, *measures]]), F.lit(" |"))
    top = report.sparkSession.createDataFrame(head, "part int, line string").withColumn("name", F.lit(""))
    return top.unionByName(report.select(F.lit(2).alias("part"), cells.alias("line"), F.col(group).cast("string").alias("name")))
