"""Scalar functions: titles, numbers, names, ids, dates."""

from pyspark.sql import functions as F

from ..functions import linguistic, text
from ..operators import merge
from ..sources import records
from .registry import query

DOC_TITLE = "split_part(text, chr(10), 1)"


def _title():
    return F.split_part("text", F.lit("\n"), F.lit(1))


@query(rf"""WITH f AS (SELECT doc_id, regexp_replace(lower({DOC_TITLE}), '[^\p{{L}}\p{{M}}\p{{N}}]', '', 'g') AS t FROM documents)
SELECT doc_id, CASE WHEN length(t) >= 8 AND length(t) % 2 = 0 AND t[:length(t)//2] = t[length(t)//2+1:] THEN t[:length(t)//2] ELSE t END AS title FROM f""")
def q_norm_title(t):
    return t.documents.select("doc_id", text.fold_title(_title()).alias("title"))


LABELLED = f"""CASE doc_id % 6 WHEN 0 THEN '[특집] ' WHEN 1 THEN '<기획논문 1> 일반논문 : ' WHEN 2 THEN '서평: ' WHEN 3 THEN ' 특집 2： ' WHEN 4 THEN 'Book Review : 【Ａ】' ELSE '' END"""


@query(rf"""WITH f AS (SELECT doc_id, regexp_replace(lower({DOC_TITLE}), '[^\p{{L}}\p{{N}}]', '', 'g') AS t FROM documents)
SELECT doc_id, CASE WHEN length(t) >= 8 AND length(t) % 2 = 0 AND t[:length(t)//2] = t[length(t)//2+1:] THEN t[:length(t)//2] ELSE t END AS title FROM f""")
def q_norm_title_nfkc(t):
    labelled = F.concat(F.expr(LABELLED), _title(), F.lit(" (漢字 ·佛敎)"))
    return t.documents.select("doc_id", linguistic.match_title(labelled).alias("title"))


@query(rf"SELECT item_id, trim(regexp_replace(trim(regexp_replace(text || ' **', '\s+', ' ', 'g')), '\*+$', '')) AS title FROM benchmark")
def q_clean_title(t):
    return t.benchmark.select("item_id", text.clean_title(F.concat("text", F.lit(" **"))).alias("title"))


@query(r"SELECT item_id, trim(regexp_replace(text, '\s+', ' ', 'g')) AS cleaned FROM benchmark")
def q_clean_ws(t):
    return t.benchmark.select("item_id", F.trim(F.regexp_replace("text", r"\s+", " ")).alias("cleaned"))


@query(rf"SELECT doc_id, regexp_replace(lower({DOC_TITLE}), '[\p{{P}}\p{{S}}\s]+', '', 'g') AS flat FROM documents")
def q_norm_punct(t):
    return t.documents.select("doc_id", text.strip_punctuation(_title()).alias("flat"))


PARTS = {"1": 1, "II": 2, "(3)": 3, "上": 1, "two": None, "(하)": 3, "Ⅵ ―on it―": 6, "viii": None}


@query(f"""SELECT p_partkey, CASE p_partkey % {len(PARTS)} {' '.join(f'WHEN {i} THEN {v}' for i, v in enumerate(PARTS.values()) if v)} END::INT AS part FROM part""")
def q_part_no(t):
    mark = F.element_at(F.array(*map(F.lit, PARTS)), (F.col("p_partkey") % len(PARTS) + 1).cast("int"))
    return t.part.select("p_partkey", linguistic.part_number(F.concat_ws(" ", "p_name", mark)).alias("part"))


@query("""SELECT p_partkey, CASE p_partkey % 4 WHEN 0 THEN '1' WHEN 1 THEN '2,iii' WHEN 2 THEN '上' ELSE '' END AS marks FROM part""")
def q_serial_marks(t):
    mark = F.element_at(F.array(F.lit("(1)"), F.lit("(2) Ⅲ"), F.lit("上"), F.lit("end")), (F.col("p_partkey") % 4 + 1).cast("int"))
    return t.part.select("p_partkey", F.array_join(linguistic.serial_marks(F.concat_ws(" ", "p_name", mark)), ",").alias("marks"))


@query("""SELECT c_custkey, CASE c_custkey % 3 WHEN 0 THEN '한글 ' ELSE 'é' END || c_name AS said FROM customer""")
def q_decode_rescue(t):
    korean = F.concat(F.lit("한글".encode("euc-kr")), F.lit(b" "), F.col("c_name").cast("binary"))
    raw = F.when(F.col("c_custkey") % 3 == 0, korean).otherwise(F.concat(F.lit("é"), F.col("c_name")).cast("binary"))
    return t.customer.select("c_custkey", linguistic.rescued(raw).alias("said"))


@query("""SELECT p_partkey, array_to_string(list_sort(list_distinct([x::int for x in regexp_extract_all(p_brand || ' ' || p_size::varchar || '-0', '[0-9]+') if x::int > 0])), ',') AS nums FROM part""")
def q_nums(t):
    return t.part.select("p_partkey", text.numbers_key(F.concat_ws(" ", "p_brand", F.concat(F.col("p_size").cast("string"), F.lit("-0")))).alias("nums"))


@query("""SELECT p_partkey, coalesce(TRY_CAST(nullif(regexp_extract(p_brand, '([0-9]+)', 1), '') AS INT), -1) AS brand_no,
 CASE WHEN regexp_matches(substr(p_size::varchar || '99', 1, 4), '^[0-9]{4}$') THEN substr(p_size::varchar || '99', 1, 4)::int ELSE 0 END AS yr FROM part""")
def q_num_extract(t):
    return t.part.select("p_partkey", F.coalesce(text.first_number(F.col("p_brand")), F.lit(-1)).alias("brand_no"), text.year_of(F.concat(F.col("p_size").cast("string"), F.lit("99"))).alias("yr"))


@query(r"SELECT doc_id, CASE WHEN length(text) = 0 THEN NULL ELSE round(length(regexp_replace(text, '[^\x00-\x7F]', '', 'g')) / length(text), 6) END AS share FROM documents")
def q_ascii_ratio(t):
    return t.documents.select("doc_id", F.round(text.ascii_share(F.col("text")), 6).alias("share"))


@query("SELECT item_id, list_extract(string_split(text, '. '), -1) AS tail FROM benchmark")
def q_tail_split(t):
    return t.benchmark.select("item_id", text.tail_of(F.col("text"), r"\. ").alias("tail"))


@query("SELECT c_custkey, regexp_replace(regexp_replace(regexp_replace(' ; ' || c_name || '  (' || c_mktsegment || ') ,', '\\s+', ' ', 'g'), '^[ ;,()]+', ''), '[ ;,()]+$', '') AS affiliation FROM customer".replace("\\\\", "\\"))
def q_clean_affil(t):
    return t.customer.select("c_custkey", text.clean_affiliation(F.concat(F.lit(" ; "), "c_name", F.lit("  ("), "c_mktsegment", F.lit(") ,"))).alias("affiliation"))


@query("SELECT doc_id, 'R' || substr(md5(source || n_chars::varchar), 1, 11) AS made_id FROM documents")
def q_md5_id(t):
    return t.documents.select("doc_id", text.fallback_id("R", 11, F.col("source"), F.col("n_chars").cast("string")).alias("made_id"))


@query("SELECT item_id, array_to_string([trim(x) for x in regexp_split_to_array(text, '[,;、]') if length(trim(x)) BETWEEN 2 AND 20], '|') AS names FROM benchmark")
def q_split_filter(t):
    return t.benchmark.select("item_id", F.array_join(text.split_names(F.col("text")), "|").alias("names"))


@query(r"""WITH w AS (SELECT item_id, unnest(list_distinct([x for x in regexp_split_to_array(text, '[^\p{L}\p{N}]+') if x <> ''])) AS w FROM benchmark),
 r AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY length(w) DESC, w) AS k FROM w) SELECT item_id, string_agg(w, ' ' ORDER BY k) AS words FROM r WHERE k <= 2 GROUP BY item_id""")
def q_longest_tokens(t):
    return t.benchmark.select("item_id", F.array_join(text.longest_words(F.col("text"), 2), " ").alias("words"))


@query("SELECT l_orderkey, l_linenumber, 'a:b:100:' || (l_partkey + 100)::varchar AS token FROM lineitem")
def q_token_bump(t):
    return t.lineitem.select("l_orderkey", "l_linenumber", text.bump_token(F.concat(F.lit("a:b:100:"), F.col("l_partkey").cast("string"))).alias("token"))


@query("SELECT o_orderkey, (o_orderdate::date + 21)::varchar AS due, 1952 + year(o_orderdate)::int - 1 AS volume_year, (o_orderdate + INTERVAL 9 HOUR)::date::varchar AS day_kst FROM orders")
def q_date_math(t):
    return t.orders.select("o_orderkey", F.date_add(F.to_date("o_orderdate"), 21).cast("string").alias("due"), (F.lit(1952) + F.year("o_orderdate") - 1).alias("volume_year"), F.to_date(F.col("o_orderdate") + F.expr("INTERVAL 9 HOURS")).cast("string").alias("day_kst"))


@query("""SELECT c_custkey, '@article{' || c_custkey::varchar || ',' || chr(10) || '  title = {' || c_name || '},' || chr(10) || '  author = {' || c_mktsegment || '},' || chr(10) || '  journal = {' || n_name || '},' || chr(10) || '  year = {2024}' || chr(10) || '}' AS bibtex FROM customer JOIN nation ON n_nationkey = c_nationkey""")
def q_export_bibtex(t):
    rows = t.customer.join(F.broadcast(t.nation), F.col("c_nationkey") == F.col("n_nationkey"))
    return rows.select("c_custkey", records.bibtex(F.col("c_custkey"), F.col("c_name"), F.col("c_mktsegment"), F.col("n_name"), F.lit("2024")).alias("bibtex"))


@query("""SELECT c_custkey, 'TY  - JOUR' || chr(10) || 'TI  - ' || c_name || chr(10) || 'AU  - ' || c_mktsegment || chr(10) || 'JO  - x' || chr(10) || 'PY  - 2024' || chr(10) || 'ER  - ' AS ris,
 c_mktsegment || ', 「' || c_name || '」, 『x』 1권 2호, 2024, 3-4쪽.' AS cited FROM customer""")
def q_export_ris(t):
    c = t.customer
    lit = F.lit
    return c.select("c_custkey", records.ris(F.col("c_name"), F.col("c_mktsegment"), lit("x"), lit("2024")).alias("ris"), records.citation(F.col("c_mktsegment"), F.col("c_name"), lit("x"), lit("1"), lit("2"), lit("2024"), lit("3-4")).alias("cited"))


@query(rf"""SELECT doc_id, CASE WHEN regexp_full_match({DOC_TITLE}, '[\x00-\x7F]*') AND lang = 'en' THEN '' ELSE {DOC_TITLE} END AS title_kr,
 CASE WHEN regexp_full_match({DOC_TITLE}, '[\x00-\x7F]*') AND lang = 'en' THEN {DOC_TITLE} ELSE '' END AS title_en FROM documents""")
def q_project_article(t):
    return records.to_articles(t.documents.withColumn("title", _title()), "title", "lang").select("doc_id", "title_kr", "title_en")


@query("""WITH n AS (SELECT l_orderkey, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice) AS pos, l_partkey FROM lineitem)
SELECT l_orderkey, string_agg(pos::varchar || ':' || l_partkey::varchar, ',' ORDER BY pos) AS items FROM n GROUP BY l_orderkey""")
def q_array_order(t):
    sorted_ = F.array_sort(F.collect_list(F.struct("l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")))
    rows = t.lineitem.groupBy("l_orderkey").agg(sorted_.alias("a"))
    return rows.select("l_orderkey", F.array_join(F.transform("a", lambda x, i: F.concat_ws(":", (i + 1).cast("string"), x["l_partkey"].cast("string"))), ",").alias("items"))


@query("""SELECT o_custkey AS custkey, string_agg(o_orderkey::varchar, ' ' ORDER BY o_orderkey) AS names, count(*) AS n, n_name AS journal FROM orders JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey GROUP BY o_custkey, n_name""")
def q_flat_index(t):
    grouped = t.orders.groupBy(F.col("o_custkey").alias("custkey")).agg(F.sort_array(F.collect_list("o_orderkey")).alias("keys"))
    rows = grouped.withColumn("authors", F.transform("keys", lambda k: F.struct(k.cast("string").alias("name")))).withColumn("k1", F.col("keys").cast("array<string>")).withColumn("k2", F.array().cast("array<string>"))
    flat = records.flat_index(rows, "authors", ("k1", "k2"))
    return flat.join(t.customer, F.col("custkey") == F.col("c_custkey")).join(F.broadcast(t.nation), F.col("c_nationkey") == F.col("n_nationkey")).select("custkey", F.col("author_names").alias("names"), F.size("keywords").cast("long").alias("n"), F.col("n_name").alias("journal"))


@query("""SELECT c_custkey, array_to_string([CASE WHEN c_mktsegment = 'BUILDING' THEN 'site' ELSE 'none' END, 'kept'], ',') AS places FROM customer""")
def q_array_lookup(t):
    authors = F.array(F.struct(F.col("c_mktsegment").alias("name"), F.lit("").alias("affiliation")), F.struct(F.lit("x").alias("name"), F.lit("kept").alias("affiliation")))
    names = F.array(F.lit("BUILDING"), F.lit("BUILDING"), F.lit("AUTOMOBILE"), F.lit("FURNITURE"), F.lit("HOUSEHOLD"), F.lit("MACHINERY"))
    values = F.array(F.lit("old"), F.lit("site"), F.lit("none"), F.lit("none"), F.lit("none"), F.lit("none"))
    t.spark.conf.set("spark.sql.mapKeyDedupPolicy", "LAST_WIN")
    rows = merge.array_lookup(t.customer.withColumn("authors", authors), "authors", names, values, "name", "affiliation")
    return rows.select("c_custkey", F.array_join(F.transform("authors", lambda a: a["affiliation"]), ",").alias("places"))
