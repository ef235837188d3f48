"""Near-duplicate documents by bottom-k sketches from one hash function.

A document's set is its distinct word shingles, hashed to 64 bits.  Its sketch is the k smallest
hashes.  Rows that repeat an id and its text are one node, and equal sets one class, from the start.  Inverted lists hold, for
runs of neighbouring retained values, the classes that retained them so: similar sets share nearly
all of them, while sets that only share a passage rarely retain a run of it.  In each list classes meet one
leader, so a list of n classes gives n - 1 candidates, not n * (n - 1) / 2; over all lists the overlaps of a
pair are counted, and sets that have many lists must share two.  The sketch of the union of both sets
estimates their similarity, and only for pairs that may reach the threshold are the full sets fetched and compared.

Lists whose classes aren't yet connected then meet other leaders.  What is still apart after ``rounds``
such rounds seeks partners in other components by its rarest shingles, which is exact (see
``_rest``): first one partner of each other component, then all that are still apart.  Those pairs too pass the
estimate and the comparison.  So no link is lost and a large group of near copies emits no square of pairs.

Chance of losing a pair at exactly 0.8: no three neighbours of the 64 smallest values of the union are
shared, below 1e-9; sets of at most 20 shingles are found always.  Every pair, also of the
last rounds, then passes the estimate on union sketches, which drops one at exactly 0.8 with a chance of about 2e-8.

Cases: a null or empty text, or one without words, has an empty set, is linked with nothing and
kept; rows with a null id are never linked, have a null component and are kept; rows that
repeat an id share its component, with equal or other texts; very long texts have their whole set, of which the
sketch bounds all but the comparison; similarity of exactly the threshold links; an empty table gives no rows; other
columns are not read, whatever their names.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.graph import components
from ..session import written
from .textscan import mixed, span_hashes, text_slices, words
from .tokenizing import id_type

SKETCH = 64
SLACK = 0.3  # of the estimate: six standard deviations and more of 64 values
SMALL, MIDDLE = 20, 12  # sets up to SMALL are listed by pairs of neighbours, sets over MIDDLE by triples
SPLIT, MOST_PARTS = 2_000, 64  # members of a list that one task meets a share of, and into how many shares lists are split
_STEP = np.uint64(0xC2B2AE3D27D4EB4F)


def _lower(points: np.ndarray) -> np.ndarray:
    return points + np.uint32(32) * ((points >= 65) & (points <= 90)).astype(np.uint32)


def shingle_sets(column: pa.Array, width: int):
    """The sorted set (int64) of each text of a column, in order."""
    for piece in text_slices(column):
        starts, ends, docs = words(piece)
        hashes = span_hashes(_lower(piece.points), starts, ends)
        at = np.searchsorted(docs, np.arange(len(piece) + 1))
        for a, b in zip(at[:-1].tolist(), at[1:].tolist()):
            own = hashes[a:b]
            n = len(own) - width + 1 if len(own) > width else min(len(own), 1)
            value = np.full(n, len(own) if len(own) < width else width, np.uint64)
            with np.errstate(over="ignore"):
                for j in range(min(width, len(own))):
                    value = value * _STEP + own[j : j + n]
            yield np.unique(mixed(value).view(np.int64))


def _lists(values: list[np.ndarray]) -> pa.Array:
    ends = np.append(0, np.cumsum([len(v) for v in values]))
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(values) if values else np.zeros(0, np.int64), pa.int64()))


def sketches(docs: DataFrame, width: int, id_col: str = "doc_id", text_col: str = "text", k: int = SKETCH) -> DataFrame:
    """id, n (size of the set), s1, s2 (its digest), sketch (its k smallest hashes) per document."""

    def rows(batches):
        for batch in batches:
            n, one, two, kept = [], [], [], []
            for own in shingle_sets(batch.column(1), width):
                digest = hashlib.blake2b(own.tobytes(), digest_size=16).digest()
                n.append(len(own))
                one.append(int.from_bytes(digest[:8], "little", signed=True))
                two.append(int.from_bytes(digest[8:], "little", signed=True))
                kept.append(own[:k])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(one, pa.int64()), pa.array(two, pa.int64()), _lists(kept)], ["id", "n", "s1", "s2", "sketch"])

    source = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    return source.mapInArrow(rows, f"id {id_type(docs, id_col)}, n long, s1 long, s2 long, sketch array<long>")


def _full_sets(docs: DataFrame, nodes: DataFrame, width: int, id_col: str, text_col: str) -> DataFrame:
    """node, full for the nodes, one row for each of a node's texts."""

    def rows(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), _lists(list(shingle_sets(batch.column(1), width)))], ["node", "full"])

    source = docs.select(F.col(id_col).alias("node"), F.col(text_col).cast("string").alias("text"))
    wanted = source.join(nodes, "node", "left_semi").distinct()  # rows of a node are together already: no second shuffle
    return wanted.mapInArrow(rows, f"node {id_type(docs, id_col)}, full array<long>").filter(F.size("full") > 0)


def _runs(width: int) -> Column:
    """Hashes of each run of neighbouring sketch values, or of all if there are fewer."""
    last = F.size("sketch") - (width - 1)
    each = F.transform(F.sequence(F.lit(1), F.greatest(last, F.lit(1))), lambda i: F.xxhash64(F.lit(width), F.slice(F.col("sketch"), i, width)))
    return each


def _rarest(rows: DataFrame, full: DataFrame, percent: int) -> DataFrame:
    """node, n, pos, df, shingle: the first n - n * percent / 100 + 1 shingles of each of the rows (node, n), the rarest first."""
    own = full.select(F.col("node").alias("of"), "full")
    shingles = rows.join(own, F.col("node") == F.col("of")).select("node", "n", F.explode("full").alias("shingle"))
    frequency = shingles.groupBy("shingle").agg(F.count(F.lit(1)).alias("df")).withColumnRenamed("shingle", "counted")
    sets = shingles.join(frequency, F.col("shingle") == F.col("counted")).groupBy("node", "n").agg(F.sort_array(F.collect_set(F.struct("df", "shingle"))).alias("ordered"))
    reach = (F.col("n") - F.ceil(F.col("n") * percent / 100) + 1).cast("int")
    return written(sets.select("node", "n", F.posexplode(F.slice("ordered", F.lit(1), reach))).filter("col.df > 1").select("node", "n", "pos", F.col("col.df").alias("df"), F.col("col.shingle").alias("shingle")), "rarest")


def _rest(heads: DataFrame, percent: int, fits, best: bool) -> DataFrame:
    """Pairs (a, b) of different components that can be similar, among rows of ``_rarest`` with a component; none is missed.

    Similar sets share one of their rarest shingles, and from the first that they share enough
    shingles must remain on both sides.  In each list only
    classes outside its commonest component look for partners.  With ``best`` each of them takes one
    partner of each other component, that which may share most: a link to any of its members will do, so
    a group of near copies isn't met one by one.  Frequent lists are split by the seeker.
    """
    usual = heads.groupBy("shingle", "component").count().groupBy("shingle").agg(F.max(F.struct("count", "component"))["component"].alias("usual"), F.count(F.lit(1)).alias("parts")).filter("parts > 1").drop("parts").withColumnRenamed("shingle", "listed")
    parts = F.least(F.floor(F.col("df") / SPLIT) + 1, F.lit(MOST_PARTS)).cast("int")
    part = F.pmod(F.xxhash64("node"), parts).cast("int")
    seekers = heads.join(usual, (F.col("shingle") == F.col("listed")) & (F.col("component") != F.col("usual"))).select("node", "n", "component", "pos", "shingle", part.alias("part"))
    other = heads.join(usual.select("listed"), F.col("shingle") == F.col("listed"), "left_semi").select(F.col("node").alias("node2"), F.col("n").alias("n2"), F.col("component").alias("component2"), F.col("pos").alias("pos2"), F.col("shingle").alias("shingle2"), F.explode(F.sequence(F.lit(0), parts - 1)).alias("part2"))
    left = F.least(F.col("n") - F.col("pos"), F.col("n2") - F.col("pos2"))
    enough = left * (100 + percent) >= (F.col("n") + F.col("n2")) * percent
    met = seekers.join(other, (F.col("shingle") == F.col("shingle2")) & (F.col("part") == F.col("part2")) & (F.col("component") != F.col("component2")) & fits(F.col("n"), F.col("n2")) & enough)
    if best:
        share = left * 2 / (F.col("n") + F.col("n2"))
        met = met.groupBy("node", "component2").agg(F.max(F.struct(share.alias("share"), F.col("node2")))["node2"].alias("node2"))
    return met.select(F.least("node", "node2").alias("a"), F.greatest("node", "node2").alias("b"))


def near_duplicates(docs: DataFrame, width: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text", rounds: int = 2) -> DataFrame:
    """doc_id, n_shingles, component_id, kept, one row per input row.

    Linked: 100 * size of the intersection >= percent * size of the union.
    """
    base = written(sketches(docs, width, id_col, text_col).withColumn("row", F.monotonically_increasing_id()), "sketches")
    known = base.filter("id is not null and n > 0")
    classes = written(known.groupBy("s1", "s2").agg(F.min(F.struct("id", "row")).alias("first")).select("s1", "s2", "first.id", "first.row").withColumnRenamed("id", "node"), "classes")
    nodes = known.drop("id").join(classes.select("row", "node"), "row").select("node", "n", "sketch")  # one row a class, however many rows repeat it
    keys = F.concat(F.when(F.col("n") <= SMALL, _runs(2)).otherwise(F.array().cast("array<bigint>")), F.when(F.col("n") > MIDDLE, _runs(3)).otherwise(F.array().cast("array<bigint>")))
    every = nodes.select(F.explode(F.array_distinct(keys)).alias("key"), "node", "n")
    shared = every.groupBy("key").agg(F.min("node").alias("low"), F.max("node").alias("high")).filter("low < high").select(F.col("key").alias("shared"))
    lists = written(every.join(shared, F.col("key") == F.col("shared")).select("key", "node", "n"), "lists")
    members = lists.select("node").distinct()
    small = written(nodes.join(members, "node", "left_semi"), "listed")
    full = written(_full_sets(docs, members, width, id_col, text_col), "sets")

    def similar(pairs: DataFrame) -> DataFrame:
        """Pairs that the union sketch lets through and whose full sets are similar enough."""
        one = small.select(F.col("node").alias("na"), F.col("sketch").alias("sa"))
        two = small.select(F.col("node").alias("nb"), F.col("sketch").alias("sb"))
        union = F.slice(F.array_sort(F.array_union("sa", "sb")), 1, SKETCH)
        hit = F.size(F.array_intersect(F.array_intersect("sa", "sb"), union))
        likely = pairs.join(two, F.col("b") == F.col("nb")).join(one, F.col("a") == F.col("na")).filter(hit >= F.size(union) * F.lit(percent / 100 - SLACK)).select("a", "b")
        likely = written(likely, "likely")  # the full sets are fetched for these alone
        one = full.select(F.col("node").alias("na"), F.col("full").alias("fa"))
        two = full.select(F.col("node").alias("nb"), F.col("full").alias("fb"))
        both = F.size(F.array_intersect("fa", "fb"))
        found = likely.join(two, F.col("b") == F.col("nb")).join(one, F.col("a") == F.col("na"))
        return found.filter(both * 100 >= (F.size("fa") + F.size("fb") - both) * percent).select("a", "b")

    fits = lambda x, y: F.least(x, y) * 100 >= F.greatest(x, y) * percent
    edges = tested = labels = rarest = None
    for turn in range(rounds + 2):
        if labels is None:
            rows = lists.withColumn("component", F.col("node"))
        else:
            own = labels.select(F.col("node").alias("member"), F.col("component").alias("found"))
            rows = lists.join(own, F.col("node") == F.col("member"), "left").select("key", "node", "n", F.coalesce("found", "node").alias("component"))
            apart = rows.groupBy("key").agg(F.min("component").alias("low"), F.max("component").alias("high")).filter("low < high").select(F.col("key").alias("apart"))
            rows = written(rows.join(apart, F.col("key") == F.col("apart")).select("key", "node", "n", "component"), "apart")
        if turn < rounds:
            rank = F.col("node") if turn == 0 else F.xxhash64("node", "key", F.lit(turn))
            heads = rows.groupBy("key").agg(F.min(F.struct(rank.alias("rank"), F.col("node"), F.col("n"), F.col("component"))).alias("head"))
            heads = heads.select(F.col("key").alias("list"), F.col("head.node").alias("leader"), F.col("head.n").alias("leader_n"), F.col("head.component").alias("leader_component"))
            met = rows.join(heads, (F.col("key") == F.col("list")) & (F.col("component") != F.col("leader_component")) & fits(F.col("n"), F.col("leader_n")))
            # Overlaps: in how many lists a class meets a leader; one list is too few for sets that have many.
            counted = met.groupBy(F.least("node", "leader").alias("a"), F.greatest("node", "leader").alias("b")).agg(F.count(F.lit(1)).alias("overlap"), F.min(F.least("n", "leader_n")).alias("least"))
            pairs = counted.filter((F.col("overlap") > 1) | (F.col("least") <= SMALL)).select("a", "b")
        else:
            apart = rows.select("node", "n", "component").distinct()
            rarest = _rarest(apart.select("node", "n"), full, percent) if rarest is None else rarest
            own = apart.select(F.col("node").alias("member"), "component")
            heads = written(rarest.join(own, F.col("node") == F.col("member")).drop("member"), "heads")
            pairs = _rest(heads, percent, fits, best=turn == rounds).distinct()
        if tested is not None:
            pairs = pairs.join(tested, ["a", "b"], "left_anti")
        pairs = written(pairs, "pairs")
        if pairs.isEmpty():
            if turn > rounds or turn and rows.isEmpty():
                break
            continue
        tested = pairs if tested is None else tested.union(pairs)
        new = written(similar(pairs).distinct(), "links")
        edges = new if edges is None else edges.union(new)
        if not new.isEmpty():
            labels = components(edges)
    found = classes.select("s1", "s2", "node")
    if labels is not None:
        own = labels.select(F.col("node").alias("member"), "component")
        found = found.join(own, F.col("node") == F.col("member"), "left").select("s1", "s2", F.coalesce("component", "node").alias("component"))
    else:
        found = found.withColumnRenamed("node", "component")
    found = found.select(F.col("s1").alias("c1"), F.col("s2").alias("c2"), "component")
    rows = base.select("id", "n", "s1", "s2").join(found, (F.col("s1") == F.col("c1")) & (F.col("s2") == F.col("c2")) & F.col("id").isNotNull() & (F.col("n") > 0), "left")
    component = F.coalesce("component", "id")
    return rows.select(F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"), component.alias("component_id"), F.coalesce(F.col("id") == component, F.lit(True)).alias("kept"))
