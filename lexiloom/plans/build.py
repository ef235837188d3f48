"""The output build: dedupe the driving source, link the other to it, merge, gate, number and report, over all journals at once.

Rows of both sources have: id, journal, title, year (int), nums (array of int), page (int), pos, publisher
and any fields to fill.  Linking goes from certain to uncertain: known ids, blocks of equal
numbers and neighbouring years, overlapping numbers, residual titles; each step only sees rows that are still free.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.linguistic import match_title, part_number
from ..operators import linkage, merge, summary
from ..operators.dedupe import first_wins, fuzzy_dedupe
from ..session import written


@dataclass
class Build:
    pairs: DataFrame  # left_id, right_id, step
    merged: DataFrame  # the driving rows, filled from their partners
    extra: DataFrame  # rows of the other source that pass the gate
    report: DataFrame  # figures per journal


def link(left: DataFrame, right: DataFrame, reading: dict[str, str] | None = None) -> DataFrame:
    """left_id, right_id, step for rows with the columns named above; ``hint`` of a right row names a left id."""
    prepared = lambda df: written(df.withColumn("key", match_title(F.col("title"), reading)).withColumn("part", part_number(F.col("title"))).withColumn("nums_key", F.array_join(F.col("nums").cast("array<string>"), ",")), "titles")
    a, b = prepared(left), prepared(right)
    done = written(_hinted(a, b), "links")

    def free(df: DataFrame, side: str) -> DataFrame:
        return df.join(done.select(F.col(side).alias("id")), "id", "left_anti")

    def settled(pairs: DataFrame, step: str, least: float = 0.0) -> DataFrame:
        good = linkage.scored(pairs, "l_key", "r_key", "l_page", "r_page", ("l_part", "r_part")).filter(F.col("sim") >= least)
        edges = written(good.select(F.col("l_id").alias("left_id"), F.col("r_id").alias("right_id"), "score"), "edges")
        return linkage.greedy_rounds(edges, "left_id", "right_id", "score").select("left_id", "right_id", F.lit(step).alias("step"))

    exact = linkage.block_pairs(free(a, "left_id"), free(b, "right_id"), ["journal", "nums_key"], "year")
    done = written(done.union(settled(exact, "block")), "links")
    x, y = free(a, "left_id"), free(b, "right_id")
    inside = linkage.subset_pairs(x.select(F.col("id").alias("l_id"), "nums", "journal"), y.select(F.col("id").alias("r_id"), "nums", "journal"), "nums", "l_id", "r_id", ["journal"])
    wide = lambda df, p: df.select(*[F.col(c).alias(p + c) for c in df.columns])
    subset = inside.join(wide(x, "l_"), "l_id").join(wide(y, "r_"), "r_id").filter((F.col("l_journal") == F.col("r_journal")) & (F.abs(F.col("l_year") - F.col("r_year")) <= 1))
    done = written(done.union(settled(subset, "subset")), "links")
    rest = linkage.residual_pairs(free(a, "left_id"), free(b, "right_id"), "key", block=["journal"]).filter((F.col("l_journal") == F.col("r_journal")) & (F.abs(F.col("l_year") - F.col("r_year")) <= 1))
    return written(done.union(settled(rest, "residual", 0.9)), "links")


def _hinted(a: DataFrame, b: DataFrame) -> DataFrame:
    claims = b.filter("hint is not null").select(F.col("id").alias("right_id"), "hint", F.col("pos").alias("claim"))
    rows = claims.join(a.select(F.col("id").alias("left_id")), F.col("hint") == F.col("left_id"))
    return first_wins(rows, ["left_id"], ["claim"]).select("left_id", "right_id", F.lit("known").alias("step"))


def build(left: DataFrame, right: DataFrame, fill: list[str], reading: dict[str, str] | None = None) -> Build:
    keyed = left.withColumn("title_key", match_title(F.col("title"), reading))
    full = [F.col("year") > 0, F.size("nums") > 0, *[F.col(c).isNotNull() & (F.col(c).cast("string") != "") for c in fill]]
    unique = written(fuzzy_dedupe(keyed, "title_key", "pos", "id", fill, completeness=full).drop("title_key", "alt_ids"), "unique")
    pairs = link(unique, right, reading)
    partner = right.join(pairs.select(F.col("right_id").alias("id"), "left_id"), "id")
    merged = merge.left_fill(unique, partner.drop("id").withColumnRenamed("left_id", "id"), "id", fill)
    marked = right.join(pairs.select(F.col("right_id").alias("id"), F.lit(True).alias("_p")), "id", "left").withColumn("paired", F.coalesce("_p", F.lit(False))).drop("_p")
    issues = unique.select("journal", F.array_join(F.col("nums").cast("array<string>"), ",").alias("_issue")).distinct().withColumn("_there", F.lit(True))
    marked = marked.withColumn("_issue", F.array_join(F.col("nums").cast("array<string>"), ",")).join(issues, ["journal", "_issue"], "left")
    marked = marked.withColumn("comparable", F.coalesce("_there", F.lit(False))).drop("_issue", "_there")
    gated = written(merge.trust_gate(marked, "journal", "publisher", "paired", "comparable"), "gated")
    extra = gated.filter("not paired and verdict = 'trusted'").select(*right.columns)
    report = summary.quality_report(gated, "journal", F.col("comparable"), F.col("paired"))
    return Build(pairs, merged, extra, report)
