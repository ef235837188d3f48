"""Linking two sources one to one: known ids, blocks of equal numbering, residual titles, greedy assignment.

Left rows are the driving source, right rows the one linked to it; both carry ``pos``, the order that
decides ties.  Pairs never come from a cross join: each form has equality keys.
"""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from ..functions.linguistic import page_bonus, title_similarity
from ..session import written
from .dedupe import first_wins, last_wins
from .graph import components


def known_id_join(left: DataFrame, right: DataFrame, keys: list[tuple[str, str, str]], left_id: str, right_id: str, pos: str = "pos") -> DataFrame:
    """right_id, left_id, rule: each right row's left row by the first rule that finds one.

    A rule is (left column, right column, "first" or "last"), the last part saying which of
    several left rows with a key counts.  A left row goes to the first right row that claims it.
    """
    rows = right.select(F.col(right_id), F.col(pos).alias("_pos"), *[F.col(r).alias(f"_r{i}") for i, (_, r, _) in enumerate(keys)])
    for i, (own, _, which) in enumerate(keys):
        some = left.filter(F.col(own).isNotNull()).select(F.col(own).alias(f"_k{i}"), F.col(left_id).alias(f"_l{i}"), F.col(pos).alias("_p"))
        one = (first_wins if which == "first" else last_wins)(some, [f"_k{i}"], ["_p"]).drop("_p")
        rows = rows.join(one, F.col(f"_r{i}") == F.col(f"_k{i}"), "left")
    found = F.coalesce(*[F.col(f"_l{i}") for i in range(len(keys))])
    rule = F.coalesce(*[F.when(F.col(f"_l{i}").isNotNull(), F.lit(i)) for i in range(len(keys))])
    claimed = rows.select(right_id, "_pos", found.alias(left_id), rule.alias("rule")).filter(F.col(left_id).isNotNull())
    return first_wins(claimed, [left_id], ["_pos"]).drop("_pos")


def year_band(df: DataFrame, year: str, width: int = 1) -> DataFrame:
    """One row per year of the band, so that a band joins by equality."""
    return df.withColumn("_year", F.explode(F.sequence(F.col(year) - width, F.col(year) + width)))


def block_pairs(left: DataFrame, right: DataFrame, block: list[str], year: str | None = None, condition: Column | None = None) -> DataFrame:
    """Pairs of rows of one block (and of years at most one apart); columns get the prefixes l_ and r_."""
    a, b = left.select(*[F.col(c).alias(f"l_{c}") for c in left.columns]), right.select(*[F.col(c).alias(f"r_{c}") for c in right.columns])
    on = [F.col(f"l_{c}") == F.col(f"r_{c}") for c in block]
    if year:
        a = year_band(a, f"l_{year}")
        on.append(F.col("_year") == F.col(f"r_{year}"))
    if condition is not None:
        on.append(condition)
    pairs = a.join(b, on)
    return pairs.drop("_year") if year else pairs


def alike_pairs(left: DataFrame, right: DataFrame, block: list[str], value: str, measure: Callable[[Column, Column], Column], good: Callable[[Column], Column], left_id: str, right_id: str, name: str, year: str | None = None) -> DataFrame:
    """left_id, right_id, name: pairs of a block (and years) with a measure that is good, for measures of one column alone.

    Rows of a block, year and value are alike: the measure is taken once for two values of a block, and rows join the pairs of values that are good.
    """
    keys = [*block, *([year] if year else []), value]
    classes = block_pairs(left.select(*keys).distinct(), right.select(*keys).distinct(), block, year).withColumn(name, measure(F.col(f"l_{value}"), F.col(f"r_{value}"))).filter(good(F.col(name)))
    classes = written(classes, "alike")
    a, b = left.select(F.col(left_id), *[F.col(c).alias(f"l_{c}") for c in keys]), right.select(F.col(right_id), *[F.col(c).alias(f"r_{c}") for c in keys])
    return classes.join(a.hint("merge"), [f"l_{c}" for c in keys]).join(b.hint("merge"), [f"r_{c}" for c in keys]).select(left_id, right_id, name)


def subset_pairs(left: DataFrame, right: DataFrame, numbers: str, left_id: str, right_id: str, block: list[str] = ()) -> DataFrame:
    """left_id, right_id where one set of numbers properly contains the other; joined by a shared number, within a block if one is given."""
    a = left.select(F.col(left_id), *[F.col(c).alias(f"_a_{c}") for c in block], F.col(numbers).alias("_a"), F.explode(numbers).alias("_n"))
    b = right.select(F.col(right_id), *[F.col(c).alias(f"_b_{c}") for c in block], F.col(numbers).alias("_b"), F.explode(numbers).alias("_m"))
    inside = F.least(F.size(F.array_except("_a", "_b")), F.size(F.array_except("_b", "_a"))) == 0
    same = F.col("_n") == F.col("_m")
    for c in block:
        same = same & (F.col(f"_a_{c}") == F.col(f"_b_{c}"))
    return a.join(b, same & (F.size("_a") != F.size("_b")) & inside).select(left_id, right_id).distinct()


def scored(pairs: DataFrame, left_title: str, right_title: str, left_page: str | None = None, right_page: str | None = None, parts: tuple[str, str] | None = None) -> DataFrame:
    """Adds ``sim`` and ``score`` (sim and page bonus), keeping pairs that the acceptance rule lets through; parts: columns of serial numbers."""
    bonus = page_bonus(F.col(left_page) - F.col(right_page)) if left_page else F.lit(0.0)
    rows = pairs.withColumn("sim", title_similarity(F.col(left_title), F.col(right_title), *map(F.col, parts or ()))).withColumn("_bonus", bonus)
    short = F.least(F.length(left_title), F.length(right_title))
    inside = F.contains(F.col(left_title), F.col(right_title)) | F.contains(F.col(right_title), F.col(left_title))
    rows = rows.withColumn("sim", F.when((F.col("_bonus") >= 0.25) & (short >= 2) & inside, F.greatest("sim", F.lit(0.62))).otherwise(F.col("sim")))
    kept = rows.filter((F.col("sim") >= 0.62) | ((F.col("sim") >= 0.38) & (F.col("_bonus") >= 0.15)))
    return kept.withColumn("score", F.col("sim") + F.col("_bonus")).drop("_bonus")


def greedy_rounds(edges: DataFrame, left: str, right: str, score: str, rounds: int = 3, most: int = 200_000) -> DataFrame:
    """One-to-one pairs as if edges were taken from the best down (ties: larger left, then larger right).

    A round takes the edges that are best at both ends, at least one; with a strict order any number of
    rounds gives the sequential result.  Groups that are tied each with each are paired by rank in one round.
    After ``rounds`` of them each connected part of at most ``most`` edges is finished in order by one task, since
    a chain gives few edges a round; rounds go on for larger parts until no edge is left.
    """
    over = edges.filter(F.col(left).isNotNull() & F.col(right).isNotNull()).groupBy(left, right).agg(F.max(score).alias(score))
    over, taken, turn = written(over, "edges"), None, 0
    while not over.isEmpty():
        if turn == rounds:
            small, over = _parts(over, left, right, score, most)
            done = written(greedy_blocks(small, "_part", left, right, score).drop("_part"), "greedy")
            taken = done if taken is None else taken.unionByName(done)
        key = F.struct(score, left, right)
        by_left = over.groupBy(left).agg(F.max(key).alias("_b")).select(F.col("_b." + left), F.col("_b." + right))
        by_right = over.groupBy(right).agg(F.max(key).alias("_b")).select(F.col("_b." + left), F.col("_b." + right), F.col("_b." + score))
        one = by_left.join(by_right, [left, right]).select(left, right, score)
        best = written(one.union(_tied_pairs(over, left, right, score)).distinct(), "greedy")
        taken, turn = best if taken is None else taken.unionByName(best), turn + 1
        if turn % 20 == 0:
            taken = written(taken, "taken")
        over = written(over.join(best.select(left), left, "left_anti").join(best.select(right), right, "left_anti"), "edges")
    return (taken if taken is not None else over).select(left, right, score)


def _parts(edges: DataFrame, left: str, right: str, score: str, most: int) -> tuple[DataFrame, DataFrame]:
    """The edges of connected parts of at most ``most`` edges, with ``_part``, and the other edges."""
    ends = edges.select(F.xxhash64(F.lit(0), F.col(left)).alias("a"), F.xxhash64(F.lit(1), F.col(right)).alias("b"))
    found = components(ends).select(F.col("node").alias("_node"), F.col("component").alias("_part"))
    rows = written(edges.join(found, F.xxhash64(F.lit(0), F.col(left)) == F.col("_node")).drop("_node"), "parts")
    large = rows.groupBy("_part").agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > most).select("_part")
    return rows.join(large, "_part", "left_anti"), rows.join(large, "_part", "left_semi").select(left, right, score)


def _tied_pairs(edges: DataFrame, left: str, right: str, score: str) -> DataFrame:
    """Pairs by descending rank of groups in which all lefts have the same best score with all rights, and the other way round.

    No better edge touches such a group, so taking edges in order pairs its first left with its first right, and so on.
    A left's rights are told by their number and two hashes; a group is whole if it has all its edges.
    """

    def top(end: str, other: str, p: str) -> DataFrame:
        most = edges.groupBy(end).agg(F.max(score).alias("_m"))
        at = edges.join(most, end).filter(F.col(score) == F.col("_m"))
        return at.groupBy(end).agg(F.max(score).alias(f"_{p}m"), F.count(F.lit(1)).alias(f"_{p}n"), F.bit_xor(F.xxhash64(other)).alias(f"_{p}x"), F.bit_xor(F.xxhash64(F.lit(1), F.col(other))).alias(f"_{p}y"))

    group = ["_ln", "_lx", "_ly", "_rn", "_rx", "_ry", score]
    both = edges.join(top(left, right, "l"), left).join(top(right, left, "r"), right).filter((F.col(score) == F.col("_lm")) & (F.col(score) == F.col("_rm")) & (F.col("_ln") * F.col("_rn") > 1))
    whole = both.groupBy(*group).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") == F.col("_ln") * F.col("_rn")).drop("_n")
    rank = lambda end: both.select(*group, end).distinct().join(whole, group).withColumn("_rank", F.row_number().over(Window.partitionBy(*group).orderBy(F.desc(end))))
    return rank(left).join(rank(right), [*group, "_rank"]).select(left, right, score)


def greedy_blocks(edges: DataFrame, block: str, left: str, right: str, score: str) -> DataFrame:
    """The same within blocks that fit one task each (an issue of a journal)."""

    def assign(rows: pd.DataFrame) -> pd.DataFrame:
        rows, a, b, out = rows.sort_values([score, left, right], ascending=False), set(), set(), []
        for i, (x, y) in enumerate(zip(rows[left], rows[right])):
            if x not in a and y not in b:
                a.add(x), b.add(y), out.append(i)
        return rows.iloc[out]

    return edges.groupBy(block).applyInPandas(assign, edges.schema)


def greedy_alike(left: DataFrame, right: DataFrame, block: list[str], value: str, measure: Callable[[Column, Column], Column], left_id: str, right_id: str, most: int = 200_000, rows: int = 2_000_000) -> DataFrame:
    """One-to-one pairs with their score as ``greedy_rounds`` takes them from all pairs of each block, for a measure of one column alone.

    Edges are between values, not rows: of an edge's rows the largest left that is free gets the largest right that is free at
    that score.  A block of at most ``most`` pairs of values and ``rows`` rows is finished by one task; larger ones, and those that share
    an id with another block, go through ``greedy_rounds`` row by row.
    """
    a, b = (df.filter(F.col(i).isNotNull() & F.col(value).isNotNull()).dropna(subset=block).select(F.col(i).alias("_id"), F.struct(*block).alias("_block"), F.col(value).alias("_value")).distinct() for df, i in ((left, left_id), (right, right_id)))
    members = written(a.withColumn("_left", F.lit(True)).union(b.withColumn("_left", F.lit(False))), "members")
    values = lambda side, v: members.filter(F.col("_left") == side).select("_block", F.col("_value").alias(v)).distinct()
    edges = written(values(True, "_a").join(values(False, "_b"), "_block").withColumn("_score", measure(F.col("_a"), F.col("_b"))), "edges")
    twice = members.groupBy("_left", "_id").agg(F.min("_block").alias("x"), F.max("_block").alias("y")).filter("x != y")
    large = edges.groupBy("_block").agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > most).select("_block").union(members.groupBy("_block").agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > rows).select("_block"))
    large = written(large.union(members.join(twice, ["_left", "_id"], "left_semi").select("_block")).distinct(), "large")
    out = edges.select("_score").schema.fields + members.select("_id").schema.fields

    def assign(pairs: pd.DataFrame, own: pd.DataFrame) -> pd.DataFrame:
        lefts, rights = ({v: sorted(set(g)) for v, g in some.groupby("_value")["_id"]} for some in (own[own["_left"]], own[~own["_left"]]))
        used_a, used_b, found = set(), set(), []

        def top(ids: list, used: set):
            while ids and ids[-1] in used:  # an id may have several values
                ids.pop()
            return ids[-1] if ids else None

        for score, group in sorted(pairs.groupby("_score"), key=lambda g: g[0], reverse=True):
            near = {}
            for x, y in zip(group["_a"], group["_b"]):
                near.setdefault(x, []).append(y)
            while True:
                # The left value with the largest free id; values whose rights have run out fall away.
                heads = [(top(lefts[x], used_a), x) for x in near if lefts.get(x)]
                heads = [h for h in heads if h[0] is not None]
                if not heads:
                    break
                x = max(heads)[1]
                free = [h for h in ((top(rights[y], used_b), y) for y in near[x] if rights.get(y)) if h[0] is not None]
                if not free:
                    del near[x]
                    continue
                y = max(free)[1]
                found.append((lefts[x].pop(), rights[y].pop(), score))
                used_a.add(found[-1][0]), used_b.add(found[-1][1])
        return pd.DataFrame(found, columns=[left_id, right_id, "score"])

    schema = T.StructType([T.StructField(left_id, out[1].dataType), T.StructField(right_id, out[1].dataType), T.StructField("score", out[0].dataType)])
    one = lambda df: df.join(large, "_block", "left_anti")
    done = one(edges).groupBy("_block").cogroup(one(members).groupBy("_block")).applyInPandas(assign, schema)
    done = written(done, "greedy")
    if large.isEmpty():
        return done
    rest = edges.join(large, "_block", "left_semi")
    for side, v, i in ((True, "_a", left_id), (False, "_b", right_id)):
        rest = rest.join(members.filter(F.col("_left") == side).select("_block", F.col("_value").alias(v), F.col("_id").alias(i)), ["_block", v])
    return done.unionByName(greedy_rounds(rest.select(left_id, right_id, F.col("_score").alias("score")), left_id, right_id, "score"))


def best_match(pairs: DataFrame, right_id: str, left_id: str, score: str, least: float) -> DataFrame:
    """The best left row of each right row (ties: the smaller id), if its score reaches ``least``."""
    rank = F.row_number().over(Window.partitionBy(right_id).orderBy(F.desc(score), left_id))
    return pairs.filter(F.col(score) >= least).withColumn("_rank", rank).filter("_rank = 1").drop("_rank")


def residual_pairs(left: DataFrame, right: DataFrame, title: str, least: int = 8, block: list[str] = ()) -> DataFrame:
    """Pairs of leftovers (of one block, if given) that may reach a similarity of 0.9; columns get l_ and r_.

    A similarity of 0.9 is a ratio of 0.9 or a common stretch of 0.9 / 0.95 of the shorter title.
    For the ratio, at most a tenth of both lengths together (errors) stays unmatched.  Of one part more of the shorter title than that some
    part i has no error and i errors before it, so it stands in the longer one, moved by at most i, by as many as i is even or odd,
    and leaves the other errors behind it.  So both titles meet by their lengths, i and that part.
    For the stretch, which counts between titles of different lengths only, what is left of the shorter title without an eighteenth at
    either end is in the longer one: its rarest run is joined with all runs of the longer one.
    Pairs that meet are held against both rules before the costly comparison.
    """
    blocks = F.xxhash64(*[F.col(c) for c in block]) if block else F.lit(0).cast("long")

    def rows(df: DataFrame, p: str) -> DataFrame:
        some = df.filter(F.length(title) >= least).dropna(subset=list(block)) if block else df.filter(F.length(title) >= least)
        return written(some.select(*[F.col(c).alias(f"{p}_{c}") for c in df.columns], F.length(title).alias(f"_n{p}"), blocks.alias("_k"), F.monotonically_increasing_id().alias(f"_i{p}")), "titles")

    a, b = rows(left, "l"), rows(right, "r")
    a_keys, b_keys = (x.select("_k", F.col(f"_i{p}").alias("_i"), F.col(f"_n{p}").alias("_n"), F.col(f"{p}_{title}").alias("_t")) for x, p in ((a, "l"), (b, "r")))
    lengths = lambda x: x.groupBy("_k").agg(F.collect_set("_n").alias("_other"))
    a_keys, b_keys = a_keys.join(lengths(b_keys), "_k"), b_keys.join(lengths(a_keys), "_k")

    def parts(keys: DataFrame, short: bool, equal: bool) -> DataFrame:
        s, l = (F.col("_n"), F.col("_m")) if short else (F.col("_m"), F.col("_n"))  # noqa: E741
        near = keys.withColumn("_m", F.explode("_other")).filter((s <= l if equal else s < l) & (9 * l <= 11 * s))
        most = F.floor((s + l) / 10)
        near = near.withColumn("_e", (most - (most - (l - s)) % 2).cast("int"))
        cut = near.withColumn("_p", F.explode(F.sequence(F.lit(0), F.col("_e"))))
        begin = lambda i: F.floor(i * s / (F.col("_e") + 1)).cast("int")
        cut = cut.withColumn("_at", begin(F.col("_p"))).withColumn("_size", begin(F.col("_p") + 1) - F.col("_at"))
        if not short:
            cut = cut.withColumn("_moved", F.explode(F.sequence(-F.col("_p"), F.col("_p"), F.lit(2)))).filter(F.abs(l - s - F.col("_moved")) <= F.col("_e") - F.col("_p"))
            cut = cut.withColumn("_at", F.col("_at") + F.col("_moved")).filter((F.col("_at") >= 0) & (F.col("_at") + F.col("_size") <= l))
        return cut.select("_i", F.xxhash64("_k", s, l, "_p", F.substring("_t", F.col("_at") + 1, F.col("_size"))).alias("_key"))

    run = min(max(least, 6), 8)

    def runs(begin: Column, end: Column) -> Column:
        """Distinct hashes of the runs from one place to another, with the block's."""
        return F.explode(F.array_distinct(F.transform(F.sequence(begin, end - run + 1), lambda i: F.xxhash64("_k", F.substring("_t", i, F.lit(run))))))

    def held(short: DataFrame, long: DataFrame) -> tuple[DataFrame, DataFrame]:
        every = long.filter((F.array_min("_other") < F.col("_n")) & (F.col("_n") >= run)).select("_i", runs(F.lit(1), F.col("_n")).alias("_key"))
        off = F.floor(F.col("_n") / 18).cast("int")
        inner = short.filter((F.array_max("_other") > F.col("_n")) & (F.col("_n") >= run)).select("_i", runs(off + 1, F.col("_n") - off).alias("_key"))
        met = inner.join(every.groupBy("_key").agg(F.count(F.lit(1)).alias("_n")).hint("merge"), "_key", "left")  # a run that no other title has: none holds this one
        return met.groupBy("_i").agg(F.min(F.struct(F.coalesce("_n", F.lit(0)).alias("n"), "_key")).alias("_b")).filter("_b.n > 0").select("_i", F.col("_b._key").alias("_key")), every

    def meet(one: DataFrame, other: DataFrame) -> DataFrame:
        return one.select("_key", F.col("_i").alias("_il")).join(other.select("_key", F.col("_i").alias("_ir")).hint("merge"), "_key").select("_il", "_ir")

    met = meet(parts(a_keys, True, True), parts(b_keys, False, True)).union(meet(parts(a_keys, False, False), parts(b_keys, True, False)))
    (short, long), (short_b, long_a) = held(a_keys, b_keys), held(b_keys, a_keys)
    met = met.union(meet(short, long)).union(meet(long_a, short_b)).distinct()
    # Hints: keys and titles are as many as the rows or more, which sizes of compressed files don't tell; broadcast they would fill the driver.
    pairs = met.join(a.drop("_k").hint("merge"), "_il").join(b.drop("_k").hint("merge"), "_ir")
    for c in block:
        pairs = pairs.filter(F.col(f"l_{c}") == F.col(f"r_{c}"))
    first = F.col("_nl") <= F.col("_nr")
    short, long = F.when(first, F.col(f"l_{title}")).otherwise(F.col(f"r_{title}")), F.when(first, F.col(f"r_{title}")).otherwise(F.col(f"l_{title}"))
    n, off = F.least("_nl", "_nr"), F.floor(F.least("_nl", "_nr") / 18).cast("int")
    stretch = (n >= 6) & F.contains(long, F.substring(short, off + 1, n - 2 * off))
    alike = F.levenshtein(f"l_{title}", f"r_{title}") <= F.floor((F.col("_nl") + F.col("_nr")) / 10)
    return pairs.filter(stretch | alike).drop("_il", "_ir", "_nl", "_nr")


def best_overlap(candidates: DataFrame, known: DataFrame, group: str, other: str, key: str, least_rows: int = 3) -> DataFrame:
    """For each candidate group the known group that holds the largest share of its keys: group, other, matched, total, rate."""
    keys = candidates.select(group, key).distinct()
    total = keys.groupBy(group).agg(F.count(F.lit(1)).alias("total")).filter(F.col("total") >= least_rows)
    hits = keys.join(known.select(other, key).distinct(), key).groupBy(group, other).agg(F.count(F.lit(1)).alias("matched"))
    rated = hits.join(total, group).withColumn("rate", F.round(F.col("matched") / F.col("total"), 3))
    return first_wins(rated, [group], [F.desc("matched"), other])


def compatible(left_years: Column, right_years: Column, left_numbers: Column, right_numbers: Column) -> Column:
    """Years equal if both are known, numbers in common if both have some."""
    years = (left_years == 0) | (right_years == 0) | (left_years == right_years)
    return years & ((F.size(left_numbers) == 0) | (F.size(right_numbers) == 0) | F.arrays_overlap(left_numbers, right_numbers))
