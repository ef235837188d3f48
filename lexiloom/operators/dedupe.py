"""Duplicates within a source: first and last wins, running counts, repeated links, fuzzy groups."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType
from pyspark.sql.window import Window


def first_wins(df: DataFrame, keys: list[str], order: list) -> DataFrame:
    """One row per key, the first by a total order."""
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", rank).filter("_rank = 1").drop("_rank")


def last_wins(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    return first_wins(df, keys, [F.desc(c) for c in order])


def running_count(df: DataFrame, key: str, order: list[str], name: str = "nth") -> DataFrame:
    """How many rows of its key there are up to each row."""
    return df.withColumn(name, F.row_number().over(Window.partitionBy(key).orderBy(*order)).cast("long"))


def clear_repeated(df: DataFrame, column: str, least: int = 3) -> DataFrame:
    """A link that ``least`` rows or more carry is a mismatch: it is cleared on all of them.

    The counts are aggregated first, so a frequent link doesn't gather its rows in one task.
    """
    often = df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") >= least).select(F.col(column).alias("_often"))
    joined = df.join(often, F.col(column) == F.col("_often"), "left")
    return joined.withColumn(column, F.when(F.col("_often").isNull(), F.col(column))).drop("_often")


def capped_append(stored: DataFrame, new: DataFrame, group: str, key: str, cap: int, order: str) -> DataFrame:
    """Stored rows and those with new keys, ``cap`` of each group at most, stored ones first."""
    fresh = new.dropDuplicates([key]).join(stored.select(key), key, "left_anti")
    both = stored.withColumn("_new", F.lit(0)).unionByName(fresh.withColumn("_new", F.lit(1)))
    rank = F.row_number().over(Window.partitionBy(group).orderBy("_new", order))
    return both.withColumn("_rank", rank).filter(F.col("_rank") <= cap).drop("_rank", "_new")


def keyed_dedupe(df: DataFrame, key: Column, completeness: list[Column], order: str, id_col: str) -> DataFrame:
    """One row per key, the most complete; the ids of the others become its ``alt_ids``."""
    rank = Window.partitionBy("_key").orderBy(*[F.desc(c) for c in completeness], order)
    ranked = df.withColumn("_key", key).withColumn("_rank", F.row_number().over(rank))
    others = ranked.filter("_rank > 1").groupBy("_key").agg(F.array_sort(F.collect_set(id_col)).alias("alt_ids")).withColumnRenamed("_key", "_other")
    kept = ranked.filter("_rank = 1").join(others, F.col("_key") == F.col("_other"), "left")
    return kept.withColumn("alt_ids", F.coalesce("alt_ids", F.array().cast(kept.schema["alt_ids"].dataType))).drop("_key", "_rank", "_other")


def fuzzy_dedupe(df: DataFrame, title_key: str, pos: str, id_col: str, fill: list[str], page: str = "page", nums: str = "nums", year: str = "year", completeness: list[Column] = (), apart: Column | None = None, shortest: int = 4, long: int = 8) -> DataFrame:
    """Twins of one folded title: each row joins the first group whose first member fits, in the order of ``pos``.

    Two rows fit if their years are equal or one is unknown (0 or null), and: both have a page, the pages are equal and so are
    the numbers unless one has none; or, where a page is missing, both have numbers, the same ones, and the
    title has ``long`` characters or more.  Of a group the row of the largest ``completeness`` (compared in order; ties: the
    first) stays, its missing fields of ``fill`` come from the others in that order, and their ids and earlier
    ``alt_ids`` go to its ``alt_ids``, in order and once.  Titles under ``shortest`` characters and rows marked by
    ``apart`` (front matter) are nobody's twins.

    Rows of equal title, year, page and numbers always share a group, so only the distinct ones of these (a title's
    places) are walked through in order, in Python; however many rows a title has, groups are merged by aggregates.
    """
    rows = df if "alt_ids" in df.columns else df.withColumn("alt_ids", F.array().cast("array<string>"))
    names = rows.columns
    title = F.coalesce(F.col(title_key), F.lit(""))
    place = {"_year": F.coalesce(F.col(year), F.lit(0)), "_page": F.col(page), "_nums": F.array_sort(F.array_distinct(F.coalesce(F.col(nums), F.array().cast(rows.schema[nums].dataType))))}
    nowhere = F.col(page).isNull() & ((F.size(place["_nums"]) == 0) | (F.length(title) < long))  # fits nothing
    alone = (F.length(title) < shortest) | nowhere | (F.coalesce(apart, F.lit(False)) if apart is not None else F.lit(False))
    marked = rows.withColumn("_alone", alone).withColumns(place)
    keys = ["_title", *place]
    twins = marked.filter("not _alone").withColumn("_title", title)
    places = twins.groupBy(*keys).agg(F.min(pos).alias("_first"))
    schema = StructType([*places.schema.fields, StructField("_head", places.schema["_first"].dataType)])

    def fits(head: tuple, own: tuple, size: int) -> bool:
        (y, p, n), (year_, page_, nums_) = head, own
        if y and year_ and y != year_:
            return False
        if p is not None and page_ is not None:
            return p == page_ and (n == nums_ or not n or not nums_)
        return n == nums_ and bool(n) and size >= long

    def grouped(table: pa.Table) -> pa.Table:
        heads, found = [], []
        ordered = table.sort_by("_first")
        for name, year_, page_, nums_, first in zip(*(ordered.column(c).to_pylist() for c in [*keys, "_first"])):
            own = (year_, page_, tuple(nums_))
            home = next((at for at, head in heads if fits(head, own, len(name))), None)
            if home is None:
                home = first
                heads.append((first, own))
            found.append(home)
        return ordered.append_column("_head", pa.array(found, ordered.schema.field("_first").type))

    heads = places.groupBy("_title").applyInArrow(grouped, schema).drop("_first").withColumnsRenamed({k: f"{k}_of" for k in keys})
    same = None
    for k in keys:
        one = F.col(k).eqNullSafe(F.col(f"{k}_of"))
        same = one if same is None else same & one
    order = F.struct(*[(-F.coalesce(c.cast("double"), F.lit(0.0))).alias(f"_c{i}") for i, c in enumerate(completeness)], F.col(pos).alias("_pos"))
    members = twins.join(heads, same).withColumn("_order", order)

    def first_filled(c: str) -> Column:
        own, kind = F.col(c), rows.schema[c].dataType.typeName()
        there = own.isNotNull() & (own != "" if kind == "string" else F.size(own) > 0 if kind in ("array", "map") else F.lit(True))
        return F.coalesce(F.min_by(F.when(there, own), F.when(there, F.col("_order"))), F.min_by(own, F.col("_order"))).alias(f"_fill_{c}")

    ids = F.struct(F.col("_order").alias("o"), F.col(id_col).cast("string").alias("id"), F.coalesce("alt_ids", F.array().cast("array<string>")).alias("alt"))
    merged = members.groupBy("_title", "_head").agg(F.min_by(F.struct(*[F.col(f"`{c}`") for c in names]), F.col("_order")).alias("_best"), F.sort_array(F.collect_list(ids)).alias("_ids"), *[first_filled(c) for c in fill])
    known = F.flatten(F.transform("_ids", lambda x, i: F.when(i == 0, x["alt"]).otherwise(F.concat(F.array(x["id"]), x["alt"]))))
    own_id = F.col("_best")[id_col].cast("string")
    alt = F.array_distinct(F.concat(F.get(F.col("_ids"), 0)["alt"], F.filter(known, lambda x: x.isNotNull() & (x != F.coalesce(own_id, F.lit(""))))))
    best = merged.select(*[(alt if c == "alt_ids" else F.col(f"_fill_{c}") if c in fill else F.col("_best")[c]).alias(c) for c in names])
    return marked.filter("_alone").select(*names).unionByName(best)
