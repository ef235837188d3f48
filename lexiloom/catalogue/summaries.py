"""Aggregates, sorting, sets."""

from pyspark.sql import functions as F

from ..operators import summary
from .registry import query


@query("SELECT n_name AS journal, count(*) AS n, count(*) FILTER (o_orderstatus <> 'P') AS comparable, count(*) FILTER (o_orderstatus = 'F') AS matched, round(count(*) FILTER (o_orderstatus = 'F') / nullif(count(*) FILTER (o_orderstatus <> 'P'), 0), 3) AS match_rate FROM orders JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey GROUP BY 1")
def q_quality_report(t):
    o = t.orders.join(t.customer, F.col("c_custkey") == F.col("o_custkey")).join(F.broadcast(t.nation), F.col("n_nationkey") == F.col("c_nationkey"))
    return summary.quality_report(o.withColumnRenamed("n_name", "journal"), "journal", F.col("o_orderstatus") != "P", F.col("o_orderstatus") == "F")


@query("""WITH c AS (SELECT c_mktsegment AS journal, CASE WHEN o_orderkey % 5 = 0 THEN 'same' WHEN o_orderkey % 5 < 3 THEN 'i2v' ELSE 'v2i' END AS scheme, count(*) AS n, min(o_orderkey) AS f FROM orders JOIN customer ON c_custkey = o_custkey GROUP BY 1, 2)
SELECT journal, scheme, n FROM (SELECT *, row_number() OVER (PARTITION BY journal ORDER BY n DESC, f) AS rn FROM c) WHERE rn = 1""")
def q_mode_scheme(t):
    k = F.col("o_orderkey") % 5
    o = t.orders.join(t.customer, F.col("c_custkey") == F.col("o_custkey")).select(F.col("c_mktsegment").alias("journal"), F.when(k == 0, "same").when(k < 3, "i2v").otherwise("v2i").alias("scheme"), "o_orderkey")
    return summary.mode_by(o, ["journal"], ["scheme"], "o_orderkey")


@query("""WITH c AS (SELECT l_suppkey, l_returnflag, l_linestatus, year(l_shipdate)::int AS y, count(*) AS n, min(l_orderkey) AS f FROM lineitem GROUP BY 1, 2, 3, 4)
SELECT l_suppkey, l_returnflag, l_linestatus, y, n FROM (SELECT *, row_number() OVER (PARTITION BY l_suppkey ORDER BY n DESC, f, l_returnflag, l_linestatus, y) AS rn FROM c) WHERE rn = 1""")
def q_mode_struct(t):
    from ..operators.dedupe import first_wins

    c = t.lineitem.groupBy("l_suppkey", "l_returnflag", "l_linestatus", F.year("l_shipdate").alias("y")).agg(F.count(F.lit(1)).alias("n"), F.min("l_orderkey").alias("f"))
    return first_wins(c, ["l_suppkey"], [F.desc("n"), "f", "l_returnflag", "l_linestatus", "y"]).drop("f")


@query("""SELECT c_nationkey, c_custkey FROM (SELECT *, row_number() OVER (PARTITION BY c_nationkey ORDER BY c_acctbal DESC, c_custkey) AS rn FROM customer) WHERE rn = 1""")
def q_argmax(t):
    return summary.arg_max(t.customer, ["c_nationkey"], "c_custkey", "c_acctbal").select("c_nationkey", "c_custkey")


@query("SELECT c_custkey, coalesce(min(year(o_orderdate)), 9999)::bigint AS first_year, coalesce(max(year(o_orderdate)), 0)::bigint AS last_year FROM customer LEFT JOIN orders ON c_custkey = o_custkey GROUP BY 1")
def q_minmax(t):
    years = t.orders.groupBy("o_custkey").agg(F.min(F.year("o_orderdate")).alias("a"), F.max(F.year("o_orderdate")).alias("b"))
    return t.customer.join(years, F.col("c_custkey") == F.col("o_custkey"), "left").select("c_custkey", F.coalesce("a", F.lit(9999)).cast("long").alias("first_year"), F.coalesce("b", F.lit(0)).cast("long").alias("last_year"))


@query("SELECT p_type, count(*) AS n FROM part GROUP BY 1 ORDER BY n DESC, p_type LIMIT 40")
def q_topk_counts(t):
    return summary.top_counts(t.part, "p_type", 40)


@query("SELECT 'lang' AS facet, lang AS value, count(*) AS n FROM documents GROUP BY 2 UNION ALL SELECT 'source', source, count(*) FROM documents GROUP BY 2")
def q_facets(t):
    return summary.facets(t.documents, ["lang", "source"])


@query("SELECT year(o_orderdate)::bigint AS y, count(*) AS n, round(sum(o_totalprice), 2) AS total FROM orders GROUP BY 1")
def q_year_hist(t):
    return t.orders.groupBy(F.year("o_orderdate").cast("long").alias("y")).agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total"))


@query("""WITH i AS (SELECT year(o_orderdate)::bigint AS y, month(o_orderdate)::bigint AS m, string_agg(o_orderkey::varchar, ' ' ORDER BY o_orderkey) AS items FROM orders GROUP BY 1, 2)
SELECT y, string_agg(m::varchar || '호: ' || items, '; ' ORDER BY m) AS issues FROM i GROUP BY 1""")
def q_nested_by_year(t):
    o = t.orders.select(F.year("o_orderdate").cast("long").alias("y"), F.month("o_orderdate").cast("long").alias("m"), "o_orderkey")
    issue = lambda g: F.concat(g["m"].cast("string"), F.lit("호: "), F.array_join(g["items"].cast("array<string>"), " "))
    return summary.nested(o, "y", "m", "o_orderkey").select("y", F.array_join(F.transform("groups", issue), "; ").alias("issues"))


@query("""SELECT p_partkey, row_number() OVER (ORDER BY p_size, coalesce(TRY_CAST(nullif(regexp_extract(p_brand, '([0-9]+)', 1), '') AS INT), 0), p_name, p_partkey) AS place FROM part""")
def q_sort_numeric(t):
    from ..functions.text import first_number

    return _placed(t.part.select("p_partkey", F.struct("p_size", F.coalesce(first_number(F.col("p_brand")), F.lit(0)).alias("b"), "p_name", "p_partkey").alias("key")))


@query("SELECT p_partkey, row_number() OVER (ORDER BY p_size::varchar, p_brand, p_partkey) AS place FROM part")
def q_sort_lexical(t):
    return _placed(t.part.select("p_partkey", F.struct(F.col("p_size").cast("string").alias("s"), "p_brand", "p_partkey").alias("key")))


def _placed(rows):
    """A total order's place numbers without one big window: ranges are sorted apart and their sizes summed."""
    from pyspark.sql.window import Window

    from ..session import written

    sorted_ = written(rows.repartitionByRange("key").withColumn("_part", F.spark_partition_id()), "ranges")
    sizes = sorted_.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    before = F.coalesce(F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = sizes.select("_part", before.alias("_before"))
    rank = F.row_number().over(Window.partitionBy("_part").orderBy("key"))
    return sorted_.withColumn("_rank", rank).join(F.broadcast(offsets), "_part").select(rows.columns[0], (F.col("_rank") + F.col("_before")).alias("place"))


@query("SELECT o_custkey, o_orderkey FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey) AS rn FROM orders) WHERE rn <= 2")
def q_topn_issues(t):
    return summary.top_n(t.orders, ["o_custkey"], [F.desc("o_orderdate"), "o_orderkey"], 2).select("o_custkey", "o_orderkey")


@query("""WITH r AS (SELECT user_id, event_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn, count(*) OVER (PARTITION BY user_id) AS n FROM events) SELECT user_id, event_id FROM r WHERE rn = 1 OR rn = n // 2 + 1 OR rn = n""")
def q_sample_positions(t):
    return summary.first_middle_last(t.events, ["user_id"], ["ts", "event_id"]).select("user_id", "event_id")


@query("SELECT c_custkey AS id, 'customer' AS kind, c_name AS name, NULL::int AS size FROM customer UNION ALL SELECT p_partkey, 'part', p_name, p_size FROM part")
def q_union_sources(t):
    a = t.customer.select(F.col("c_custkey").alias("id"), F.lit("customer").alias("kind"), F.col("c_name").alias("name"))
    b = t.part.select(F.col("p_partkey").alias("id"), F.lit("part").alias("kind"), F.col("p_name").alias("name"), F.col("p_size").alias("size"))
    return a.unionByName(b, allowMissingColumns=True)


@query("SELECT c_custkey FROM customer EXCEPT SELECT o_custkey FROM orders WHERE o_totalprice > 200000")
def q_except(t):
    return t.customer.select("c_custkey").exceptAll(t.orders.filter("o_totalprice > 200000").select(F.col("o_custkey").alias("c_custkey")).distinct())


@query("SELECT user_id, string_agg(event_type, ',' ORDER BY f) AS kinds FROM (SELECT user_id, event_type, min(event_id) AS f FROM events GROUP BY 1, 2) GROUP BY 1")
def q_distinct(t):
    first = t.events.groupBy("user_id", "event_type").agg(F.min("event_id").alias("f"))  # before anything is collected
    ordered = F.transform(F.array_sort(F.collect_list(F.struct("f", "event_type"))), lambda x: x["event_type"])
    return first.groupBy("user_id").agg(F.array_join(ordered, ",").alias("kinds"))


@query("SELECT o_orderkey FROM orders WHERE EXISTS (SELECT 1 FROM supplier WHERE o_totalprice BETWEEN s_acctbal * 30 AND s_acctbal * 30 + 500)")
def q_range_semi(t):
    ranges = t.supplier.select((F.col("s_acctbal") * 30).alias("low"), (F.col("s_acctbal") * 30 + 500).alias("high"))
    return summary.in_ranges(t.orders.select("o_orderkey", "o_totalprice"), "o_totalprice", ranges, "low", "high", 1000).select("o_orderkey")


@query("""WITH y AS (SELECT c_nationkey AS g, m, count(*) FILTER (o_orderkey IS NOT NULL) AS n FROM customer CROSS JOIN (SELECT unnest(range(1, 13)) AS m) LEFT JOIN orders ON o_custkey = c_custkey AND month(o_orderdate) = m AND o_totalprice > 485000 GROUP BY 1, 2)
SELECT a.g, a.m AS year FROM y a JOIN y b ON a.g = b.g AND b.m = a.m - 1 JOIN y c ON a.g = c.g AND c.m = a.m + 1 WHERE a.n = 0 AND b.n = 0 AND c.n = 0""")
def q_coverage_gap(t):
    grid = t.customer.select(F.col("c_nationkey").alias("g")).distinct().withColumn("m", F.explode(F.sequence(F.lit(1).cast("long"), F.lit(12).cast("long"))))
    have = t.orders.filter("o_totalprice > 485000").join(t.customer, F.col("c_custkey") == F.col("o_custkey")).groupBy(F.col("c_nationkey").alias("hg"), F.month("o_orderdate").cast("long").alias("hm")).agg(F.count(F.lit(1)).alias("k"))
    years = grid.join(have, (F.col("g") == F.col("hg")) & (F.col("m") == F.col("hm")), "left").select("g", "m", F.coalesce("k", F.lit(0)).alias("n"))
    return summary.coverage(years, "g", "m", "n")
