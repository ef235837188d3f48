"""Dedupe, linkage and merging."""

from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import linguistic, text
from ..operators import dedupe, linkage, merge
from .registry import query

def _folded():
    return F.lower(F.regexp_replace("text", r"\s+", " "))


KEYED = r"SELECT *, lower(regexp_replace(text, '\s+', ' ', 'g')) AS k FROM documents"
LINE = ["l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax"]
LINE_SQL = ", ".join(LINE)


@query(f"""WITH k AS ({KEYED}), r AS (SELECT *, row_number() OVER (PARTITION BY k ORDER BY n_chars DESC, doc_id) AS rn FROM k)
SELECT a.doc_id, a.source, coalesce(string_agg(b.doc_id::varchar, ',' ORDER BY b.doc_id), '') AS alt_ids FROM r a LEFT JOIN r b ON a.k = b.k AND b.rn > 1 WHERE a.rn = 1 GROUP BY 1, 2""")
def q_dedupe(t):
    rows = dedupe.keyed_dedupe(t.documents, _folded(), [F.col("n_chars")], "doc_id", "doc_id")
    return rows.select("doc_id", "source", F.array_join(F.col("alt_ids").cast("array<string>"), ",").alias("alt_ids"))


@query("""WITH d AS (SELECT *, regexp_replace(lower(p_brand), '[^a-z0-9]', '', 'g') || CASE WHEN p_size % 9 = 0 THEN '' ELSE regexp_replace(lower(p_type), '[^a-z0-9]', '', 'g') END AS t, p_size % 3 AS page, p_size % 2 AS num, p_partkey % 11 = 0 AS front, CASE WHEN p_partkey % 5 = 0 THEN '' ELSE p_name END AS note, p_partkey % 4 = 0 AS c1, p_size > 25 AS c2 FROM part),
 k AS (SELECT *, CASE WHEN front OR length(t) < 8 THEN p_partkey::varchar ELSE t || '/' || page || '/' || num END AS g FROM d),
 r AS (SELECT *, row_number() OVER (PARTITION BY g ORDER BY c1 DESC, c2 DESC, p_partkey) AS nth FROM k)
SELECT min(p_partkey) FILTER (nth = 1) AS id, coalesce(string_agg(p_partkey::varchar, ',' ORDER BY nth) FILTER (nth > 1), '') AS alt_ids, coalesce(first(note ORDER BY nth) FILTER (note <> ''), '') AS note FROM r GROUP BY g""")
def q_fuzzy_dedupe(t):
    """Parts as articles; all have page, numbers and year, so that who fits whom is an equality."""
    brand, kind = (F.regexp_replace(F.lower(c), "[^a-z0-9]", "") for c in ("p_brand", "p_type"))
    d = t.part.select("p_partkey", F.concat(brand, F.when(F.col("p_size") % 9 == 0, "").otherwise(kind)).alias("title_key"), (F.col("p_size") % 3).alias("page"), F.array(F.col("p_size") % 2).alias("nums"), F.lit(2020).alias("year"), F.when(F.col("p_partkey") % 5 == 0, "").otherwise(F.col("p_name")).alias("note"), "p_size")
    kept = dedupe.fuzzy_dedupe(d, "title_key", "p_partkey", "p_partkey", ["note"], completeness=[F.col("p_partkey") % 4 == 0, F.col("p_size") > 25], apart=F.col("p_partkey") % 11 == 0, shortest=8)
    return kept.select(F.col("p_partkey").alias("id"), F.array_join("alt_ids", ",").alias("alt_ids"), "note")


@query(f"SELECT l_orderkey, l_linenumber, {LINE_SQL} FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {LINE_SQL}) AS rn FROM lineitem) WHERE rn = 1")
def q_first_wins(t):
    return dedupe.first_wins(t.lineitem, ["l_orderkey", "l_linenumber"], LINE).select("l_orderkey", "l_linenumber", *LINE)


@query(f"SELECT l_orderkey, l_linenumber, {LINE_SQL} FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {', '.join(c + ' DESC' for c in LINE)}) AS rn FROM lineitem) WHERE rn = 1")
def q_last_wins(t):
    return dedupe.last_wins(t.lineitem, ["l_orderkey", "l_linenumber"], LINE).select("l_orderkey", "l_linenumber", *LINE)


@query("SELECT event_id, user_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS nth FROM events")
def q_running_count(t):
    return dedupe.running_count(t.events, "user_id", ["ts", "event_id"]).select("event_id", "user_id", "nth")


@query("SELECT p_partkey, CASE WHEN count(*) OVER (PARTITION BY p_type) < 15 THEN p_type END AS link FROM part")
def q_dup_url_clear(t):
    return dedupe.clear_repeated(t.part.select("p_partkey", F.col("p_type").alias("link")), "link", 15)


@query("""WITH s AS (SELECT c_custkey, c_nationkey, 0 AS new FROM customer WHERE c_acctbal < 4000), n AS (SELECT c_custkey, c_nationkey, 1 AS new FROM customer WHERE c_acctbal >= 4000)
SELECT c_nationkey, c_custkey FROM (SELECT *, row_number() OVER (PARTITION BY c_nationkey ORDER BY new, c_custkey) AS rn FROM (SELECT * FROM s UNION ALL SELECT * FROM n)) WHERE rn <= 40""")
def q_capped_append(t):
    c = t.customer.select("c_nationkey", "c_custkey", "c_acctbal")
    return dedupe.capped_append(c.filter("c_acctbal < 4000"), c, "c_nationkey", "c_custkey", 40, "c_custkey").select("c_nationkey", "c_custkey")


@query("""SELECT count(DISTINCT id) AS n_ids FROM (SELECT o_orderkey::varchar AS id FROM orders UNION ALL SELECT 'c' || o_custkey::varchar FROM orders UNION ALL SELECT 'l' || l_partkey::varchar FROM lineitem)""")
def q_known_ids(t):
    o = t.orders.select(F.explode(F.array(F.col("o_orderkey").cast("string"), F.concat(F.lit("c"), F.col("o_custkey").cast("string")))).alias("id"))
    return o.union(t.lineitem.select(F.concat(F.lit("l"), F.col("l_partkey").cast("string")))).agg(F.count_distinct("id").alias("n_ids"))


def _two_sources(t):
    """Customers as the driving source, orders as the linked one: by a known id, a hint or a folded name."""
    left = t.customer.select("c_custkey", F.when(F.col("c_custkey") % 2 == 0, F.col("c_custkey") * 10).alias("kid"), F.col("c_custkey").alias("rid"), F.lower("c_name").alias("doi"), F.col("c_custkey").alias("pos"))
    right = t.orders.select("o_orderkey", F.when(F.col("o_orderkey") % 3 == 0, F.col("o_custkey") * 10).alias("r_kid"), F.when(F.col("o_orderkey") % 3 == 1, F.col("o_custkey")).alias("r_hint"), F.concat(F.lit("customer#"), F.lpad(F.col("o_custkey").cast("string"), 9, "0")).alias("r_doi"), F.col("o_orderkey").alias("pos"))
    return left, right


@query("""WITH l AS (SELECT c_custkey, CASE WHEN c_custkey % 2 = 0 THEN c_custkey * 10 END AS kid, c_custkey AS rid, lower(c_name) AS doi FROM customer),
 r AS (SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN o_custkey * 10 END AS k, CASE WHEN o_orderkey % 3 = 1 THEN o_custkey END AS h, 'customer#' || lpad(o_custkey::varchar, 9, '0') AS d FROM orders),
 lk AS (SELECT kid, max_by(c_custkey, c_custkey) AS c FROM l WHERE kid IS NOT NULL GROUP BY 1), lr AS (SELECT rid, min_by(c_custkey, c_custkey) AS c FROM l GROUP BY 1), ld AS (SELECT doi, max_by(c_custkey, c_custkey) AS c FROM l GROUP BY 1),
 j AS (SELECT o_orderkey, coalesce(lk.c, lr.c, ld.c) AS c_custkey, CASE WHEN lk.c IS NOT NULL THEN 0 WHEN lr.c IS NOT NULL THEN 1 ELSE 2 END AS rule FROM r LEFT JOIN lk ON k = kid LEFT JOIN lr ON h = rid LEFT JOIN ld ON d = doi)
SELECT o_orderkey, c_custkey, rule FROM (SELECT *, row_number() OVER (PARTITION BY c_custkey ORDER BY o_orderkey) AS rn FROM j WHERE c_custkey IS NOT NULL) WHERE rn = 1""")
def q_known_id_join(t):
    left, right = _two_sources(t)
    return linkage.known_id_join(left, right, [("kid", "r_kid", "last"), ("rid", "r_hint", "first"), ("doi", "r_doi", "last")], "c_custkey", "o_orderkey")


@query("""SELECT a.p_partkey AS a_key, b.p_partkey AS b_key, levenshtein(a.p_name, b.p_name)::bigint AS distance FROM part a JOIN part b ON a.p_brand = b.p_brand AND abs(a.p_size - b.p_size) <= 1 AND a.p_type < 'M' AND b.p_type >= 'M' AND levenshtein(a.p_name, b.p_name) <= 3""")
def q_block_join(t):
    p = t.part.select("p_partkey", "p_brand", "p_size", "p_name", "p_type")
    a, b = p.filter("p_type < 'M'").withColumnRenamed("p_partkey", "a_key"), p.filter("p_type >= 'M'").withColumnRenamed("p_partkey", "b_key")
    return linkage.alike_pairs(a, b, ["p_brand"], "p_name", lambda x, y: F.levenshtein(x, y).cast("long"), lambda d: d <= 3, "a_key", "b_key", "distance", "p_size")


@query("""WITH s AS (SELECT l_partkey, l_returnflag, list_sort(list(DISTINCT l_linenumber)) AS nums FROM lineitem GROUP BY 1, 2)
SELECT a.l_partkey AS a_key, b.l_partkey AS b_key FROM s a JOIN s b ON a.l_partkey = b.l_partkey AND a.l_returnflag = 'A' AND b.l_returnflag = 'R' AND len(a.nums) <> len(b.nums) AND (list_has_all(b.nums, a.nums) OR list_has_all(a.nums, b.nums))""")
def q_subset_join(t):
    s = t.lineitem.groupBy("l_partkey", "l_returnflag").agg(F.array_sort(F.collect_set("l_linenumber")).alias("nums"))
    a, b = (s.filter(F.col("l_returnflag") == flag).select(F.col("l_partkey").alias(name), F.col("l_partkey").alias("journal"), "nums") for flag, name in (("A", "a_key"), ("R", "b_key")))
    return linkage.subset_pairs(a, b, "nums", "a_key", "b_key", ["journal"])


@query("""WITH p AS (SELECT a.p_partkey AS a_key, b.p_partkey AS b_key, 1 - levenshtein(a.p_name, b.p_name) / greatest(length(a.p_name), length(b.p_name)) AS s FROM part a JOIN part b ON a.p_brand = b.p_brand AND a.p_size = b.p_size AND a.p_type < 'M' AND b.p_type >= 'M')
SELECT a_key, b_key, round(s, 6) AS score FROM (SELECT *, row_number() OVER (PARTITION BY b_key ORDER BY s DESC, a_key) AS rn FROM p WHERE s >= 0.3) WHERE rn = 1""")
def q_top1_lookup(t):
    p = t.part.select("p_partkey", "p_brand", "p_size", "p_name", "p_type")
    pairs = linkage.block_pairs(p.filter("p_type < 'M'"), p.filter("p_type >= 'M'"), ["p_brand", "p_size"])
    score = F.lit(1) - F.levenshtein("l_p_name", "r_p_name") / F.greatest(F.length("l_p_name"), F.length("r_p_name"))
    rows = pairs.select(F.col("l_p_partkey").alias("a_key"), F.col("r_p_partkey").alias("b_key"), score.alias("score"))
    return linkage.best_match(rows, "b_key", "a_key", "score", 0.3).select("a_key", "b_key", F.round("score", 6).alias("score"))


def _page_titles(t):
    """Pages as articles of two sources, told apart by their scheme; the language in the path is the journal."""
    title = F.regexp_extract("html", "<title>([^<]*)</title>", 1)
    return t.pages.select("page_id", title.alias("title"), text.fold_title(title).alias("key"), F.regexp_extract("url", "/([a-z]{2})/", 1).alias("journal"), F.regexp_extract("url", "^https?://([^/?#]+)", 1).alias("host"), F.col("url").startswith("https:").alias("secure"), F.length("html").alias("n"))


@query("SELECT p_partkey AS a_key, p_partkey AS b_key, round((32 - p_partkey % 5) / 32, 6) AS sim FROM part WHERE p_partkey % 5 < 4")
def q_residual_match(t):
    """Digests as titles, and the same with none to four characters changed, by journal; no two others are alike."""
    digest = F.md5(F.col("p_partkey").cast("string").cast("binary"))
    left = t.part.select("p_partkey", digest.alias("key"), F.col("p_brand").alias("journal"))
    changed = F.array_join(F.transform(F.split("key", ""), lambda c, i: F.when((i % 7 == 5) & (i < F.col("p_partkey") % 5 * 7), "z").otherwise(c)), "")
    pairs = linkage.residual_pairs(left, left.withColumn("key", changed), "key", block=["journal"])
    return linkage.scored(pairs, "l_key", "r_key").filter("sim >= 0.9").select(F.col("l_p_partkey").alias("a_key"), F.col("r_p_partkey").alias("b_key"), F.round("sim", 6).alias("sim"))


@query("""WITH RECURSIVE e AS (SELECT a.p_partkey AS a_key, b.p_partkey AS b_key, a.p_brand || '/' || a.p_size AS blk, round(1 - levenshtein(a.p_name, b.p_name) / greatest(length(a.p_name), length(b.p_name)), 6) AS score FROM part a JOIN part b ON a.p_brand = b.p_brand AND a.p_size = b.p_size AND a.p_type < 'M' AND b.p_type >= 'M'),
 o AS (SELECT *, row_number() OVER (PARTITION BY blk ORDER BY score DESC, a_key DESC, b_key DESC) AS nth FROM e),
 g AS (SELECT DISTINCT blk, 0::BIGINT AS step, []::BIGINT[] AS used_a, []::BIGINT[] AS used_b, NULL::BIGINT AS a_key, NULL::BIGINT AS b_key, NULL::DOUBLE AS score FROM e
 UNION ALL SELECT g.blk, step + 1, CASE WHEN free THEN list_append(used_a, o.a_key) ELSE used_a END, CASE WHEN free THEN list_append(used_b, o.b_key) ELSE used_b END, CASE WHEN free THEN o.a_key END, CASE WHEN free THEN o.b_key END, o.score
 FROM g JOIN o ON o.blk = g.blk AND nth = step + 1, LATERAL (SELECT NOT list_contains(used_a, o.a_key) AND NOT list_contains(used_b, o.b_key) AS free))
SELECT a_key, b_key, score FROM g WHERE a_key IS NOT NULL""")
def q_greedy_match(t):
    p = t.part.select("p_partkey", "p_brand", "p_size", "p_name", "p_type")
    a, b = p.filter("p_type < 'M'").withColumnRenamed("p_partkey", "a_key"), p.filter("p_type >= 'M'").withColumnRenamed("p_partkey", "b_key")
    score = lambda x, y: F.round(F.lit(1) - F.levenshtein(x, y) / F.greatest(F.length(x), F.length(y)), 6)
    return linkage.greedy_alike(a, b, ["p_brand", "p_size"], "p_name", score, "a_key", "b_key")


@query("""WITH p AS (SELECT p_partkey, length(p_name) AS n, p_size AS k, p_partkey % 4 AS rule FROM part)
SELECT p_partkey, round(CASE WHEN rule = 3 THEN 2 * n / (2 * n + 3) * 0.3 ELSE greatest(2 * n / (2 * n + k), CASE WHEN n >= 6 THEN 0.95 ELSE 0 END) * CASE WHEN rule = 2 THEN 0.4 ELSE 1 END END, 6) AS sim,
 round(CASE WHEN rule = 3 THEN 2 * n / (2 * n + 3) ELSE 2 * n / (2 * n + k) END, 6) AS ratio FROM p WHERE rule <> 3 OR 2 * n / (2 * n + 3) > 0.95""")
def q_similarity(t):
    """Titles against themselves with a tail: plain, of another part, or a review; the tail has letters that no title has."""
    rule = F.col("p_partkey") % 4
    tail = F.when(rule == 3, F.lit("의서평")).otherwise(F.repeat(F.lit("가"), F.col("p_size")))
    p = t.part.select("p_partkey", F.col("p_name").alias("a"), F.concat("p_name", tail).alias("b"), F.when(rule == 2, 1).alias("p"), F.when(rule == 2, 2).alias("q"), rule.alias("rule"), F.length("p_name").alias("n"))
    p = p.filter("rule <> 3 or 2 * n / (2 * n + 3) > 0.95")
    return p.select("p_partkey", F.round(linguistic.title_similarity(F.col("a"), F.col("b"), F.col("p"), F.col("q")), 6).alias("sim"), F.round(linguistic.sequence_ratio(F.col("a"), F.col("b")), 6).alias("ratio"))


@query("""SELECT a.o_orderkey AS a_key, b.o_orderkey AS b_key FROM orders a JOIN orders b ON a.o_custkey = b.o_custkey AND a.o_orderkey < b.o_orderkey AND (year(a.o_orderdate) = year(b.o_orderdate)) AND (a.o_orderpriority = b.o_orderpriority)""")
def q_compat_join(t):
    o = t.orders.select("o_orderkey", "o_custkey", F.year("o_orderdate").alias("y"), F.array("o_orderpriority").alias("nums"))
    ok = linkage.compatible(F.col("l_y"), F.col("r_y"), F.col("l_nums"), F.col("r_nums")) & (F.col("l_o_orderkey") < F.col("r_o_orderkey"))
    return linkage.block_pairs(o, o, ["o_custkey"], None, ok).select(F.col("l_o_orderkey").alias("a_key"), F.col("r_o_orderkey").alias("b_key"))


@query("""WITH k AS (SELECT DISTINCT o_orderpriority AS g, o_custkey AS key FROM orders WHERE o_totalprice < 150000), n AS (SELECT DISTINCT o_orderstatus AS o, o_custkey AS key FROM orders WHERE o_totalprice >= 150000),
 tot AS (SELECT g, count(*) AS total FROM k GROUP BY 1 HAVING count(*) >= 3), h AS (SELECT g, o, count(*) AS matched FROM k JOIN n USING (key) GROUP BY 1, 2)
SELECT g AS candidate, o AS known, matched, total, round(matched / total, 3) AS rate FROM (SELECT h.*, total, row_number() OVER (PARTITION BY g ORDER BY matched DESC, o) AS rn FROM h JOIN tot USING (g)) WHERE rn = 1""")
def q_best_overlap(t):
    a = t.orders.filter("o_totalprice < 150000").select(F.col("o_orderpriority").alias("candidate"), F.col("o_custkey").alias("key"))
    b = t.orders.filter("o_totalprice >= 150000").select(F.col("o_orderstatus").alias("known"), F.col("o_custkey").alias("key"))
    return linkage.best_overlap(a, b, "candidate", "known", "key")


@query("""WITH al AS (SELECT lower(regexp_replace(n_name, '[^A-Za-z0-9]', '', 'g')) AS k, n_nationkey FROM nation), c AS (SELECT c_custkey, lower(n_name) || CASE WHEN c_custkey % 2 = 0 THEN ' (Old)' ELSE '-x' END AS name FROM customer JOIN nation ON n_nationkey = c_nationkey)
SELECT c_custkey, n_nationkey AS routed FROM c LEFT JOIN al ON k = regexp_replace(lower(regexp_replace(name, '[(\\[][^)\\]]*[)\\]]', '', 'g')), '[^a-z0-9]', '', 'g')""".replace("\\\\", "\\"))
def q_alias_route(t):
    alias = t.nation.select(text.alias_key(F.col("n_name")).alias("k"), F.col("n_nationkey").alias("routed"))
    c = t.customer.join(F.broadcast(t.nation), F.col("c_nationkey") == F.col("n_nationkey")).select("c_custkey", F.concat(F.lower("n_name"), F.when(F.col("c_custkey") % 2 == 0, " (Old)").otherwise("-x")).alias("name"))
    return c.join(F.broadcast(alias), text.alias_key(F.col("name")) == F.col("k"), "left").select("c_custkey", "routed")


@query("SELECT d.doc_id, d.lang, coalesce(l.quality, -1) AS quality, coalesce(l.toxic, -1) AS toxic FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id")
def q_left_fill(t):
    left = t.documents.select("doc_id", "lang", F.lit(None).cast("int").alias("quality"), F.lit(None).cast("int").alias("toxic"))
    return merge.left_fill(left, t.labels, "doc_id", ["quality", "toxic"]).select("doc_id", "lang", F.coalesce("quality", F.lit(-1)).alias("quality"), F.coalesce("toxic", F.lit(-1)).alias("toxic"))


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 AND c_custkey IS NOT NULL THEN c_mktsegment ELSE o_orderpriority END AS tag FROM orders LEFT JOIN customer ON c_custkey = o_custkey")
def q_overlay(t):
    new = t.orders.join(t.customer, F.col("c_custkey") == F.col("o_custkey")).select("o_orderkey", F.when(F.col("o_orderkey") % 3 == 0, F.col("c_mktsegment")).otherwise("").alias("tag"))
    return merge.overlay(t.orders.select("o_orderkey", F.col("o_orderpriority").alias("tag")), new, "o_orderkey", ["tag"])


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 3 <> 0 THEN o_orderpriority ELSE coalesce(c_mktsegment, '') END AS tag FROM orders LEFT JOIN customer ON c_custkey = o_custkey")
def q_fill_nulls(t):
    old = t.orders.select("o_orderkey", F.when(F.col("o_orderkey") % 3 == 0, "").otherwise(F.col("o_orderpriority")).alias("tag"))
    new = t.orders.join(t.customer, F.col("c_custkey") == F.col("o_custkey")).select("o_orderkey", F.col("c_mktsegment").alias("tag"))
    return merge.left_fill(old, new, "o_orderkey", ["tag"])


@query("SELECT doc_id, source FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def q_anti_unmatched(t):
    return merge.anti_unmatched(t.documents, t.labels, "doc_id").select("doc_id", "source")


@query("SELECT DISTINCT c_nationkey, c_mktsegment FROM customer WHERE c_acctbal > 9000 AND (c_nationkey, c_mktsegment) NOT IN (SELECT c_nationkey, c_mktsegment FROM customer WHERE c_acctbal < -900)")
def q_anti_issue(t):
    have = t.customer.filter("c_acctbal < -900").select("c_nationkey", "c_mktsegment")
    return merge.uncovered(t.customer.filter("c_acctbal > 9000").select("c_nationkey", "c_mktsegment").distinct(), have, ["c_nationkey", "c_mktsegment"])


@query("""WITH k AS (SELECT *, lower(p_name) || p_size::varchar AS k FROM part), a AS (SELECT * FROM k WHERE p_type < 'M'), b AS (SELECT k, min(p_partkey) AS p_partkey, min(p_brand) AS p_brand FROM k WHERE p_type >= 'M' GROUP BY 1)
SELECT a.p_partkey, coalesce(CASE WHEN a.p_size % 2 = 0 THEN a.p_brand END, b.p_brand, '') AS link FROM a LEFT JOIN b USING (k) UNION ALL SELECT b.p_partkey, b.p_brand FROM b WHERE k NOT IN (SELECT k FROM a)""")
def q_priority_merge(t):
    p = t.part.select("p_partkey", F.concat(F.lower("p_name"), F.col("p_size").cast("string")).alias("key"), F.when((F.col("p_type") < "M") & (F.col("p_size") % 2 == 1), "").otherwise(F.col("p_brand")).alias("link"), "p_type")
    second = p.filter("p_type >= 'M'").groupBy("key").agg(F.min("p_partkey").alias("p_partkey"), F.min("link").alias("link"))
    return merge.priority_merge(p.filter("p_type < 'M'").drop("p_type"), second, F.col("key"), ["link"]).select("p_partkey", "link")


@query("""SELECT coalesce(n.o_orderkey, s.o_orderkey) AS o_orderkey, CASE WHEN n.o_orderkey IS NOT NULL THEN 'new' ELSE s.o_orderstatus END AS status, CASE WHEN n.o_orderkey % 6 = 0 THEN coalesce(s.o_orderpriority, '') WHEN n.o_orderkey IS NULL THEN s.o_orderpriority ELSE n.o_orderpriority END AS note, s.o_orderkey IS NULL AS is_new
FROM (SELECT * FROM orders WHERE o_orderstatus <> 'P') s FULL JOIN (SELECT * FROM orders WHERE o_orderstatus <> 'F') n ON s.o_orderkey = n.o_orderkey""")
def q_upsert(t):
    stored = t.orders.filter("o_orderstatus <> 'P'").select("o_orderkey", F.col("o_orderstatus").alias("status"), F.col("o_orderpriority").alias("note"))
    new = t.orders.filter("o_orderstatus <> 'F'").select("o_orderkey", F.lit("new").alias("status"), F.when(F.col("o_orderkey") % 6 == 0, "").otherwise(F.col("o_orderpriority")).alias("note"))
    return merge.upsert(stored, new, "o_orderkey", ["note"])


@query("SELECT o_orderkey FROM orders WHERE o_orderstatus <> 'P' UNION SELECT o_orderkey FROM orders WHERE o_orderstatus <> 'F'")
def q_insert_new(t):
    o = t.orders.select("o_orderkey", "o_orderstatus")
    return merge.insert_new(o.filter("o_orderstatus <> 'P'"), o.filter("o_orderstatus <> 'F'"), "o_orderkey").select("o_orderkey")


@query("SELECT count(*) FILTER (quality IS NULL) AS no_quality, count(*) FILTER (lang <> 'en') AS no_english, count(*) FILTER (quality IS NULL AND n_chars > 1000) AS long_unlabelled, count(*) AS total FROM documents LEFT JOIN labels USING (doc_id)")
def q_missing_fields(t):
    d = t.documents.join(t.labels, "doc_id", "left")
    return d.agg(F.count_if(F.col("quality").isNull()).alias("no_quality"), F.count_if(F.col("lang") != "en").alias("no_english"), F.count_if(F.col("quality").isNull() & (F.col("n_chars") > 1000)).alias("long_unlabelled"), F.count(F.lit(1)).alias("total"))


@query("SELECT doc_id, source, source = 'src1' AS stub FROM documents WHERE source IN ('src0', 'src1')")
def q_split_by_source(t):
    parts = merge.by_source(t.documents, "source", ["src0", "src1"])
    return parts["src0"].select("doc_id", "source", F.lit(False).alias("stub")).unionByName(parts["src1"].select("doc_id", "source", F.lit(True).alias("stub")))


@query("SELECT c_custkey, c_name, n_name, r_name FROM customer JOIN nation ON n_nationkey = c_nationkey JOIN region ON r_regionkey = n_regionkey")
def q_broadcast_dim(t):
    dim = t.nation.join(F.broadcast(t.region), F.col("r_regionkey") == F.col("n_regionkey"))
    return t.customer.join(F.broadcast(dim), F.col("c_nationkey") == F.col("n_nationkey")).select("c_custkey", "c_name", "n_name", "r_name")


@query("""WITH o AS (SELECT o_orderkey, n_name AS journal, c_mktsegment AS publisher, o_orderpriority = '1-URGENT' AS paired, o_orderstatus <> 'P' AS comparable FROM orders JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey),
 g AS (SELECT journal, count(*) FILTER (paired) AS pairs FROM o GROUP BY 1), p AS (SELECT journal, publisher, count(*) AS n, count(*) FILTER (paired) AS ok FROM o WHERE comparable GROUP BY 1, 2)
SELECT o_orderkey, CASE WHEN pairs < 60 THEN 'held' WHEN n >= 3 AND ok < n * 0.2 THEN 'rejected' ELSE 'trusted' END AS verdict FROM o JOIN g USING (journal) LEFT JOIN p USING (journal, publisher)""")
def q_trust_gate(t):
    o = t.orders.join(t.customer, F.col("c_custkey") == F.col("o_custkey")).join(F.broadcast(t.nation), F.col("n_nationkey") == F.col("c_nationkey"))
    rows = o.select("o_orderkey", F.col("n_name").alias("journal"), F.col("c_mktsegment").alias("publisher"), (F.col("o_orderpriority") == "1-URGENT").alias("paired"), (F.col("o_orderstatus") != "P").alias("comparable"))
    return merge.trust_gate(rows, "journal", "publisher", "paired", "comparable", 60, 3, 0.2).select("o_orderkey", "verdict")


@query("SELECT o_orderkey FROM orders WHERE o_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F') AND -o_custkey NOT IN (SELECT -o_custkey FROM orders WHERE o_totalprice > 450000)")
def q_new_rows(t):
    o = t.orders.select("o_orderkey", (-F.col("o_custkey")).alias("alt"), "o_orderstatus", "o_totalprice")
    previous = o.filter("o_orderstatus = 'F'").select("o_orderkey", F.lit(None).cast("long").alias("alt")).union(o.filter("o_totalprice > 450000").select(F.lit(None).cast("long"), "alt"))
    return merge.new_rows(o, ["o_orderkey", "alt"], previous, ["o_orderkey", "alt"], "o_orderkey").select("o_orderkey")


@query("""WITH w AS (SELECT o_orderkey, CASE WHEN o_orderkey % 2 = 0 THEN 'p' || (o_orderkey // 4)::varchar ELSE o_orderkey::varchar END AS want FROM orders)
SELECT o_orderkey, CASE WHEN row_number() OVER (PARTITION BY want ORDER BY o_orderkey) = 1 THEN want ELSE 'x' || o_orderkey::varchar END AS stable_id FROM w""")
def q_stable_id(t):
    o = t.orders.select("o_orderkey", F.col("o_orderkey").cast("string").alias("a"), F.concat(F.lit("x"), F.col("o_orderkey").cast("string")).alias("b"))
    previous = o.filter("o_orderkey % 2 = 0").select(F.col("a").alias("any_id"), F.concat(F.lit("p"), F.floor(F.col("o_orderkey") / 4).cast("string")).alias("primary_id"))
    return merge.stable_ids(o, ["a", "b"], previous, "o_orderkey").select("o_orderkey", "stable_id")


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 5 = 0 THEN 'inserted' WHEN o_orderkey % 7 = 0 THEN 'deleted' ELSE 'updated' END AS change FROM orders WHERE o_orderkey % 5 = 0 AND o_orderkey % 7 <> 0 OR o_orderkey % 7 = 0 AND o_orderkey % 5 <> 0 OR o_orderkey % 3 = 0 AND o_orderkey % 5 <> 0 AND o_orderkey % 7 <> 0")
def q_changed_rows(t):
    o = t.orders.select("o_orderkey", "o_orderstatus", "o_totalprice")
    old = o.filter("o_orderkey % 5 <> 0").withColumn("o_totalprice", F.when(F.col("o_orderkey") % 3 == 0, -1.0).otherwise(F.col("o_totalprice")))
    return merge.changed_rows(o.filter("o_orderkey % 7 <> 0"), old, "o_orderkey", ["o_orderstatus", "o_totalprice"])


@query()
def q_build(t):
    """The whole output build on the pages, as two sources."""
    from ..plans.build import build

    d = _page_titles(t).select(F.col("page_id").cast("string").alias("id"), "journal", "title", F.lit(2020).alias("year"), F.array((F.col("n") % 40 + 1).cast("int")).alias("nums"), (F.col("n") % 100).cast("int").alias("page"), F.col("page_id").alias("pos"), F.col("host").alias("publisher"), "secure")
    left = d.filter("secure").drop("secure").withColumn("hint", F.lit(None).cast("string"))
    right = d.filter("not secure").drop("secure").withColumn("hint", (F.col("pos") - 1).cast("string"))
    return build(left, right, ["publisher"]).report
