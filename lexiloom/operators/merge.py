"""Merging linked rows, writing back, trust gates, stable ids and change detection."""

from __future__ import annotations

import hashlib
import json
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType
from pyspark.sql.window import Window

from ..functions.text import blank_to_null
from ..session import written


def _missing(df: DataFrame, c: str, name: str | None = None) -> Column:
    """The column, null where missing: blank strings and empty arrays count so."""
    own, kind = F.col(name or c), df.schema[c].dataType.typeName()
    return blank_to_null(own) if kind == "string" else F.when(F.size(own) > 0, own) if kind == "array" else own


def left_fill(left: DataFrame, right: DataFrame, on: str, fill: list[str]) -> DataFrame:
    """All left rows; their missing fields taken from the right row of the same key."""
    other = right.select(F.col(on).alias("_on"), *[_missing(right, c).alias(f"_{c}") for c in fill])
    joined = left.join(other, F.col(on) == F.col("_on"), "left")
    return joined.select(*[F.coalesce(_missing(left, c), F.col(f"_{c}"), F.col(c)).alias(c) if c in fill else F.col(c) for c in left.columns])


def overlay(left: DataFrame, right: DataFrame, on: str, columns: list[str]) -> DataFrame:
    """All left rows; fields that the right row has replace theirs."""
    other = right.select(F.col(on).alias("_on"), *[_missing(right, c).alias(f"_{c}") for c in columns])
    joined = left.join(other, F.col(on) == F.col("_on"), "left")
    return joined.select(*[F.coalesce(F.col(f"_{c}"), F.col(c)).alias(c) if c in columns else F.col(c) for c in left.columns])


def anti_unmatched(rows: DataFrame, pairs: DataFrame, key: str) -> DataFrame:
    return rows.join(pairs.select(key).distinct(), key, "left_anti")


def insert_new(stored: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """Stored rows and new ones of unseen keys."""
    return stored.unionByName(new.dropDuplicates([key]).join(stored.select(key), key, "left_anti"), allowMissingColumns=True)


def upsert(stored: DataFrame, new: DataFrame, key: str, sticky: list[str] = ()) -> DataFrame:
    """New rows replace stored ones of their key whole, but for ``sticky`` fields that they lack; ``is_new`` marks inserts."""
    columns = [c for c in stored.columns if c != key]
    a = stored.select(F.col(key).alias("_a"), *[F.col(c).alias(f"_a_{c}") for c in columns])
    b = new.select(F.col(key).alias("_b"), *[F.col(c).alias(f"_b_{c}") for c in columns])
    joined = a.join(b, F.col("_a") == F.col("_b"), "full_outer")

    def value(c: str) -> Column:
        if c in sticky:
            return F.coalesce(_missing(new, c, f"_b_{c}"), F.col(f"_a_{c}"), F.col(f"_b_{c}")).alias(c)
        return F.when(F.col("_b").isNotNull(), F.col(f"_b_{c}")).otherwise(F.col(f"_a_{c}")).alias(c)

    return joined.select(F.coalesce("_b", "_a").alias(key), *[value(c) for c in columns], F.col("_a").isNull().alias("is_new"))


MANIFEST = "_manifest.json"


def _files(spark: SparkSession, path: str):
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    return hadoop, hadoop(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def write_text(spark: SparkSession, path: str, content: str | None) -> None:
    """Writes a small file whole: under another name first, then renamed over it; None takes it away."""
    hadoop, fs = _files(spark, path)
    if content is None:
        fs.delete(hadoop(path), False)
        return
    beside = hadoop(f"{path}.{uuid.uuid4().hex}.tmp")
    out = fs.create(beside, True)
    try:
        out.write(bytearray(content.encode()))
    finally:
        out.close()
    names = spark.sparkContext._jvm.org.apache.hadoop.fs
    over = spark.sparkContext._gateway.new_array(names.Options.Rename, 1)
    over[0] = names.Options.Rename.OVERWRITE
    context = names.FileContext.getFileContext(fs.getUri(), spark.sparkContext._jsc.hadoopConfiguration())
    context.rename(fs.makeQualified(beside), fs.makeQualified(hadoop(path)), over)


def read_text(spark: SparkSession, path: str) -> str | None:
    hadoop, fs = _files(spark, path)
    if not fs.exists(hadoop(path)):
        return None
    source = fs.open(hadoop(path))
    try:
        return bytes(source.readAllBytes()).decode()
    finally:
        source.close()


def write_pending(spark: SparkSession, path: str, names: list[str], note: str = "", today: str = "") -> None:
    """The list of work left over: names once, in order; without any the file goes."""
    names = list(dict.fromkeys(names))
    write_text(spark, path, json.dumps({"journals": names, "updated": today, "note": note}, ensure_ascii=False) if names else None)


def read_table(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    """The rows of a table that ``write_upsert`` keeps; none (of ``schema``) where there is no table yet."""
    manifest = json.loads(read_text(spark, f"{path}/{MANIFEST}") or "{}")
    if not manifest:
        return spark.createDataFrame([], schema or StructType([]))
    reader = spark.read.schema(schema) if schema else spark.read
    return reader.parquet(*[f"{path}/{d}" for d in sorted(manifest["partitions"].values())]) if manifest["partitions"] else spark.createDataFrame([], schema or StructType.fromJson(manifest["schema"]))


def write_upsert(new: DataFrame, path: str, key: str, partition: str, sticky: list[str] = ()) -> None:
    """Upsert into a Parquet table; one writer at a time.

    Only partitions that have new rows, or hold an older row of a new key, are written again, into a new folder; then a
    manifest that names each partition's folder takes the old one's place in one rename.  A run that dies
    before leaves the old table, and a key that changes its partition is in the new one only.
    """
    spark = new.sparkSession
    manifest = json.loads(read_text(spark, f"{path}/{MANIFEST}") or "{}")
    name = F.coalesce(F.col(partition).cast("string"), F.lit("__null__"))
    new = written(new, "upsert")
    touched = new.select(name.alias("p")).distinct()
    if manifest:
        stored = read_table(spark, path, new.schema)
        moved = stored.select(name.alias("p"), key).join(new.select(key).distinct(), key, "left_semi").select("p")
        touched = touched.union(moved).distinct()
    names = [r["p"] for r in touched.collect()]  # partitions, not rows
    rows = new
    if manifest:
        old = [manifest["partitions"][n] for n in names if n in manifest["partitions"]]
        before = spark.read.schema(new.schema).parquet(*[f"{path}/{d}" for d in old]) if old else spark.createDataFrame([], new.schema)
        rows = upsert(before, new, key, list(sticky)).select(*new.columns)
    folder = f"data-{uuid.uuid4().hex}"
    rows.withColumn("_part", F.md5(name.cast("binary"))).write.partitionBy("_part").parquet(f"{path}/{folder}")
    there = {n: hashlib.md5(n.encode()).hexdigest() for n in names}
    hadoop, fs = _files(spark, path)
    kept = {n: d for n, d in manifest.get("partitions", {}).items() if n not in there}
    kept |= {n: f"{folder}/_part={h}" for n, h in there.items() if fs.exists(hadoop(f"{path}/{folder}/_part={h}"))}
    write_text(spark, f"{path}/{MANIFEST}", json.dumps({"schema": new.schema.jsonValue(), "partitions": kept}))


def priority_merge(first: DataFrame, second: DataFrame, key: Column, graft: list[str]) -> DataFrame:
    """All rows of the first source, their missing ``graft`` fields from the second's row of an equal key, and the second's other rows."""
    b = second.withColumn("_key", key).dropDuplicates(["_key"])
    a = first.withColumn("_key", key)
    filled = left_fill(a, b, "_key", graft)
    rest = b.join(a.select("_key"), "_key", "left_anti")
    return filled.unionByName(rest, allowMissingColumns=True).drop("_key")


def array_lookup(df: DataFrame, items: str, names: Column, values: Column, field: str, to: str) -> DataFrame:
    """Fills an empty field of an array's structs from a map of names to values (the last of equal names counts)."""
    table = F.map_from_entries(F.transform(F.arrays_zip(names.alias("k"), values.alias("v")), lambda x: F.struct(x["k"], x["v"])))
    fixed = F.transform(items, lambda s: s.withField(to, F.coalesce(blank_to_null(s[to]), F.try_element_at(F.col("_table"), s[field]), F.lit(""))))
    return df.withColumn("_table", table).withColumn(items, fixed).drop("_table")


def trust_gate(rows: DataFrame, group: str, publisher: str, paired: str, comparable: str, least_pairs: int = 3, least_rows: int = 3, share: float = 0.5) -> DataFrame:
    """Adds ``verdict``: held if the group has too few pairs, rejected if most comparable rows of the publisher don't pair, else trusted."""
    groups = rows.groupBy(group).agg(F.count_if(F.col(paired)).alias("_pairs")).withColumnRenamed(group, "_g")
    publishers = rows.filter(F.col(comparable)).groupBy(group, publisher).agg(F.count(F.lit(1)).alias("_n"), F.count_if(F.col(paired)).alias("_ok")).withColumnsRenamed({group: "_pg", publisher: "_pp"})
    joined = rows.join(groups, F.col(group).eqNullSafe(F.col("_g")), "left").join(publishers, F.col(group).eqNullSafe(F.col("_pg")) & F.col(publisher).eqNullSafe(F.col("_pp")), "left")
    bad = (F.col("_n") >= least_rows) & (F.col("_ok") < F.col("_n") * share)
    verdict = F.when(F.col("_pairs") < least_pairs, "held").when(bad, "rejected").otherwise("trusted")
    return joined.withColumn("verdict", verdict).drop("_g", "_pairs", "_pg", "_pp", "_n", "_ok")


def new_rows(rows: DataFrame, ids: list[str], previous: DataFrame, previous_ids: list[str], key: str) -> DataFrame:
    """Rows none of whose ids any previous row had."""
    known = previous.select(F.explode(F.array(*[F.col(c).cast("string") for c in previous_ids])).alias("_id")).filter("_id is not null").distinct()
    own = rows.select(F.col(key), F.explode(F.array(*[F.col(c).cast("string") for c in ids])).alias("_id")).filter("_id is not null")
    return rows.join(own.join(known, "_id", "left_semi").select(key).distinct(), key, "left_anti")


def stable_ids(rows: DataFrame, ids: list[str], previous: DataFrame, pos: str) -> DataFrame:
    """Adds ``stable_id``: the primary id that the first known of a row's ids had before, else its own first id.

    ``previous`` maps any id to its primary one.  If two rows arrive at one id, the first by ``pos`` keeps it, later
    ones take the last of their own ids.
    """
    each = rows.select(F.col(pos).alias("_row"), F.posexplode(F.array(*[F.col(c).cast("string") for c in ids]))).filter("col is not null")
    found = each.join(previous.select(F.col("any_id").alias("col"), "primary_id"), "col")
    first = found.groupBy("_row").agg(F.min_by("primary_id", "pos").alias("_old")).withColumnRenamed("_row", "_p")
    own = F.array_compact(F.array(*[F.col(c).cast("string") for c in ids]))
    joined = rows.join(first, F.col(pos) == F.col("_p"), "left").withColumn("_want", F.coalesce("_old", F.get(own, 0)))
    rank = F.row_number().over(Window.partitionBy("_want").orderBy(pos))
    return joined.withColumn("stable_id", F.when(rank == 1, F.col("_want")).otherwise(F.element_at(own, -1))).drop("_p", "_old", "_want")


def changed_rows(rows: DataFrame, previous: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """key, change: inserted, updated or deleted, by a digest of the canonical row."""
    digest = lambda: F.md5(F.to_json(F.struct(*sorted(columns)), {"ignoreNullFields": "false"}).cast("binary"))
    a = rows.select(F.col(key).alias("_a"), digest().alias("_da"))
    b = previous.select(F.col(key).alias("_b"), digest().alias("_db"))
    change = F.when(F.col("_b").isNull(), "inserted").when(F.col("_a").isNull(), "deleted").when(F.col("_da") != F.col("_db"), "updated")
    return a.join(b, F.col("_a") == F.col("_b"), "full_outer").select(F.coalesce("_a", "_b").alias(key), change.alias("change")).filter("change is not null")


def first_filled(sources: list[DataFrame]) -> DataFrame:
    """The rows of the first source that has any: later ones count only if all before are empty."""
    out, seen = None, None
    for df in sources:
        some = df.limit(1).select(F.lit(1).alias("_some"))
        rows = df if seen is None else df.join(F.broadcast(seen), F.lit(True), "left_anti")
        out = rows if out is None else out.unionByName(rows, allowMissingColumns=True)
        seen = some if seen is None else seen.union(some)
    return out


def first_filled_by(sources: list[DataFrame], group: str) -> DataFrame:
    """For each group the rows of the first source that has any for it, with that source's number as ``level``."""
    every = None
    for i, df in enumerate(sources):
        rows = df.withColumn("level", F.lit(i))
        every = rows if every is None else every.unionByName(rows, allowMissingColumns=True)
    first = every.groupBy(group).agg(F.min("level").alias("_level")).withColumnRenamed(group, "_g")
    return every.join(first, F.col(group).eqNullSafe(F.col("_g")) & (F.col("level") == F.col("_level"))).drop("_g", "_level")


def uncovered(rows: DataFrame, have: DataFrame, keys: list[str]) -> DataFrame:
    """Rows whose keys (an issue's volume and number, say) another source doesn't have; null keys are as good as others."""
    other = have.select(*[F.col(k).alias(f"_{k}") for k in keys]).distinct()
    same = None
    for k in keys:
        one = F.col(k).eqNullSafe(F.col(f"_{k}"))
        same = one if same is None else same & one
    return rows.join(other, same, "left_anti")


def by_source(df: DataFrame, source: str, names: list[str]) -> dict[str, DataFrame]:
    return {n: df.filter(F.col(source) == n) for n in names}
