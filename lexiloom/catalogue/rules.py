"""Rules on records, pages and responses; fixtures are made of the driver's tables so that SQL knows what must come out."""

from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from ..functions import linguistic, rules
from ..operators import merge, summary
from ..plans import search
from ..sources import pages, records
from ..streaming import harvest
from .registry import query


def _choice(key, *values):
    return F.element_at(F.array(*[v if hasattr(v, "alias") else F.lit(v) for v in values]), (key % len(values) + 1).cast("int"))


def _sql(key, *values):
    """The same choice in SQL; values are SQL expressions."""
    return f"CASE {key} % {len(values)} " + " ".join(f"WHEN {i} THEN {v}" for i, v in enumerate(values)) + " END"


@query("SELECT p_partkey FROM part WHERE p_partkey % 8 NOT IN (0, 1, 2, 3, 4, 5)")
def q_front_matter(t):
    k = F.col("p_partkey")
    title = _choice(k, "목차", F.concat(F.lit("Contents of "), "p_name"), " ", F.concat(F.lit("제12호 "), "p_brand"), "p_name", "EDITORIAL", F.concat(F.lit("On "), "p_name"), F.concat("p_name", F.lit(" 3")))
    authors = F.array(F.lit("Kim"), F.when(k % 8 == 4, " Test ").otherwise("Lee"))
    return t.part.withColumn("title", F.when(k % 8 == 4, F.col("p_name")).otherwise(title)).filter(~rules.front_matter(F.col("title"), authors, F.col("p_brand"))).select("p_partkey")


@query("""SELECT p_partkey, CASE p_partkey % 3 WHEN 0 THEN 'K' || p_partkey WHEN 1 THEN 'ART00' || (100000 + p_partkey) ELSE '' END AS record_id,
 CASE p_partkey % 3 WHEN 0 THEN 'https://x.org/K' || p_partkey WHEN 1 THEN 'https://x.org/ART00' || (100000 + p_partkey) ELSE 'https://home' END AS link,
 CASE p_partkey % 4 WHEN 3 THEN '10.9/made.' || p_size || '.2_' || p_partkey ELSE '10.1/' || p_partkey END AS doi FROM part""")
def q_url_build(t):
    k, s = F.col("p_partkey"), F.col("p_partkey").cast("string")
    field, url = F.when(k % 3 == 0, F.concat(F.lit(" K"), s)).otherwise(" "), F.when(k % 3 == 1, F.concat(F.lit("http://y?id=ART00"), (k + 100000).cast("string"), F.lit("&z"))).otherwise("http://y")
    doi = _choice(k, F.concat(F.lit("https://doi.org/10.1/"), s), F.concat(F.lit("http://dx.doi.org/10.1/"), s), F.concat(F.lit("https://z.jp/a?d=10.1/"), s), "")
    d = t.part.withColumn("record_id", rules.article_id(field, url)).withColumn("_doi", rules.clean_doi(doi))
    made = rules.made_doi(F.col("_doi"), "10.9", F.lit("made"), F.col("p_size").cast("string"), F.lit("2"), s)
    return d.select("p_partkey", "record_id", rules.record_url(F.col("record_id"), "https://x.org/", "https://home").alias("link"), made.alias("doi"))


@query("SELECT c_custkey FROM customer WHERE c_custkey % 4 IN (0, 1)")
def q_hint_filter(t):
    name = _choice(F.col("c_custkey"), F.concat("c_name", F.lit(" of BUDDHIST studies")), F.concat(F.lit("buddhism "), "c_name"), F.concat(F.lit("Buddhism and Nursing "), "c_name"), F.lit(" Exact Buddh "))
    return t.customer.filter(rules.is_candidate(name, ["Buddh"], ["Nursing"], ["Exact Buddh"])).select("c_custkey")


@query(f"""SELECT c_custkey, {_sql('c_custkey', "c_name || ' ―論考の研究―'", 'c_name', "c_name || ' ―' || c_mktsegment || '―'", "c_name || ' 論考の研究'")} AS title, {_sql('c_custkey', "'1:Kim A'", "'1:金錫岩(花郎),2:高崎'", "'1:Lee'", "''")} AS authors, c_custkey % 4 <> 1 AS moved FROM customer""")
def q_array_repair(t):
    k = F.col("c_custkey")
    one = lambda n: F.struct((F.lit(n) if isinstance(n, str) else n).alias("name"))
    authors = _choice(k, F.array(one("論考の研究"), one("Kim A")), F.array(one("金錫岩(花郎)"), one("高崎")), F.array(one("Lee"), one(F.concat(F.lit("――"), "c_mktsegment", F.lit("―")))), F.array(one("論考の研究")))
    title = F.when(k % 4 == 3, F.concat("c_name", F.lit(" 論考の研究"))).otherwise(F.col("c_name"))
    found = t.customer.select("c_custkey", rules.subtitle_moved(title, authors).alias("r"))
    numbered = F.transform("r.authors", lambda a, i: F.concat_ws(":", (i + 1).cast("string"), a["name"]))
    return found.select("c_custkey", "r.title", F.array_join(numbered, ",").alias("authors"), "r.moved")


@query("SELECT p_partkey, lower(replace(p_name, ' ', '')) || 'ab1佛' AS title FROM part")
def q_norm_loose(t):
    return t.part.select("p_partkey", rules.loose_title(F.concat(F.lit("「"), "p_name", F.lit("」―Ａ(B)・1：　『佛』"))).alias("title"))


@query(f"""SELECT p_partkey, {_sql('p_partkey', "'한국 불교의 역사와 사상 그리고 문화 유산에|일본 사원|불교의|역사와'", "'영산|靈山會掛佛圖'", "'A Study of Zen|Study|Zen'", "'弘覺禪師碑文弘覺禪師碑文弘覺禪師碑文|弘覺禪師碑文弘覺禪師碑文'", "''")} AS terms FROM part""")
def q_search_terms(t):
    title = _choice(F.col("p_partkey"), "[기획] 한국 불교의 역사와 사상 그리고 문화 유산에 대하여 : 일본 사원", "영산 (靈山會掛佛圖)", "논문 1: A Study of Zen - 특집 논문", "弘覺禪師碑文弘覺禪師碑文弘覺禪師碑文", "")
    return t.part.select("p_partkey", F.array_join(rules.search_terms(title), "|").alias("terms"))


@query("SELECT c_custkey, CASE WHEN c_custkey % 2 = 0 THEN 'won|' || c_name || ' alias|' || c_name ELSE c_name || ' alias|won|' || c_name END AS names FROM customer")
def q_name_variants(t):
    k = F.col("c_custkey")
    alias = F.concat("c_name", F.lit(" alias"))
    names = rules.name_variants(F.col("c_name"), F.when(k % 2 == 0, "won").otherwise(alias), F.when(k % 2 == 0, F.array(alias, F.col("c_name"))).otherwise(F.array(alias, F.lit(""), F.lit("won"))))
    return t.customer.select("c_custkey", F.array_join(names, "|").alias("names"))


def _html(t):
    """A page for each supplier: two issues, one of them twice, a recommendation, two articles, one too short."""
    s = F.col("s_suppkey").cast("string")
    html = F.format_string('<h2>x</h2><a href="/x?v_control_no=a%1$s">Vol.%1$s No.2 2019</a><a href="#" onclick="go(\'v_control_no=b%1$s\')">제4권 No.7</a><a href="/y?v_control_no=a%1$s">again</a><a href="/browse/ibk/%1$s/2/_contents">2</a><a href="/browse/ibk/%1$s/0/_contents">0</a><a href="/browse/ibk/7/1/_contents">1</a><a href="/recommender/click.do?p_mat_type=1a0202&amp;control_no=c1">other</a><a href="/d?p_mat_type=1a0202&amp;control_no=d%1$s">On <b>%2$s</b></a><a href="/d?p_mat_type=1a0202&amp;control_no=e">x</a>', s, "s_name")
    return t.supplier.select("s_suppkey", html.alias("html")).withColumn("anchors", pages.links("html"))


@query("SELECT s_suppkey, 'a' || s_suppkey AS id, s_suppkey::varchar AS volume, '2' AS issue, '2019' AS year FROM supplier UNION ALL SELECT s_suppkey, 'b' || s_suppkey, '', '7', '' FROM supplier")
def q_issue_links(t):
    return _html(t).select("s_suppkey", F.inline(pages.issue_links(F.col("anchors")))).select("s_suppkey", "id", "volume", "issue", "year")


@query("SELECT s_suppkey, 'd' || s_suppkey AS id, 'On ' || s_name AS title FROM supplier WHERE s_suppkey % 3 <> 0")
def q_filter_contains(t):
    """Articles of the pages, without recommendations and those already known."""
    found = _html(t).select("s_suppkey", F.inline(pages.article_links(F.col("anchors"), "p_mat_type=1a0202"))).select("s_suppkey", "id", F.col("text").alias("title"))
    known = t.supplier.filter("s_suppkey % 3 = 0").select(F.concat(F.lit("d"), F.col("s_suppkey").cast("string")).alias("id"))
    return found.join(known, "id", "left_anti").select("s_suppkey", "id", "title")


@query("SELECT s_suppkey, least(s_suppkey, 7)::int AS volume, CASE WHEN s_suppkey < 7 THEN 2 ELSE 1 END AS issue, 1951 + least(s_suppkey, 7)::int AS year FROM supplier WHERE s_suppkey > 0")
def q_volume_links(t):
    """The first issue of each page, by volume and number."""
    first = F.get(pages.volume_links(F.col("anchors")), 0)
    return _html(t).filter("s_suppkey > 0").select("s_suppkey", first.alias("v")).select("s_suppkey", "v.*")


@query("SELECT s_suppkey, s_suppkey % 3 <> 2 AS journal_ok, s_suppkey % 3 = 0 AS issue_ok FROM supplier")
def q_page_structure(t):
    k = F.col("s_suppkey")
    d = _html(t).withColumn("html", F.when(k % 3 == 0, F.col("html")).when(k % 3 == 1, "<td> 1998 </td>").otherwise("<p>in 1998</p>"))
    return d.select("s_suppkey", pages.journal_page_ok(F.col("html")).alias("journal_ok"), pages.issue_page_ok(pages.links("html")).alias("issue_ok"))


@query(f"""SELECT s_suppkey, {_sql('s_suppkey', "'First ' || s_name", "'Second ' || s_name", "NULL")} AS title, {_sql('s_suppkey', "s_name || ' has a long abstract of more than thirty characters'", "NULL", "'p ' || s_name || ' and so on and so on and so on'")} AS abstract FROM supplier""")
def q_selector_fallback(t):
    k = F.col("s_suppkey")
    html = _choice(k, F.format_string('<h1 class="a title-en">First <i>%1$s</i></h1><section id="ja"><h2>x</h2><p>short</p><p>%1$s has a long abstract of more than thirty characters</p></section><p class="trans">no</p>', "s_name"), F.format_string('<h1 class="title-en"> </h1><span class="trans" lang="en">Second %s</span>', "s_name"), F.format_string('<div class="abstract"><div><p>p %s and so on and so on and so on</p></div></div>', "s_name"))
    d = t.supplier.withColumn("html", html)
    return d.select("s_suppkey", pages.first_selected(F.col("html"), [".title-en", ".trans[lang=en]"], 2).alias("title"), pages.first_selected(F.col("html"), ["section#ja p", ".abstract p"], 30).alias("abstract"))


@query("SELECT s_suppkey, 'R000000004-I' || s_suppkey AS id, s_name AS title, '5' AS start_page, '9' AS end_page, '高崎直道,中村' AS authors FROM supplier")
def q_library_items(t):
    html = F.format_string('<div class="pages-books-section-index-item-split"><a class="x lang-link" href="/books/R000000004-I%1$s"><span>%2$s</span></a><span>高崎直道</span>|<p>中村<br>（編）</p><span>12巻</span> p. 5-9 <img src="y"></div><div class="pages-books-section-index-item-split"><a class="lang-link" href="/books/R000000004-I%1$s">again</a></div><div class="other"><a class="lang-link" href="/books/R000000004-I0">z</a></div>', F.col("s_suppkey").cast("string"), "s_name")
    items = t.supplier.select("s_suppkey", F.inline(pages.library_items(html)))
    return items.withColumn("authors", F.array_join("authors", ","))


@query(f"""SELECT o_orderkey, {_sql('o_orderkey', '250', '0', '0', '0', '3')}::int AS total, {_sql('o_orderkey', "'records'", "'empty'", "'stop'", "'empty'", "'empty'")} AS state, CASE WHEN o_orderkey % 2 = 0 THEN year(o_orderdate) || '01' ELSE (year(o_orderdate) - 1) || '01' END AS date_from, CASE WHEN o_orderkey % 2 = 0 THEN year(o_orderdate) || '12' ELSE (year(o_orderdate) + 1) || '12' END AS date_to FROM orders""")
def q_search_response(t):
    xml = _choice(F.col("o_orderkey"), "<r><total> 250</total><record/></r>", "<r><inputData>limit</inputData><m>No Data</m></r>", "<r><inputData>No Data</inputData>한도 초과</r>", "<r><inputData>invalid</inputData></r>", "<r><total>3</total>limit</r>")
    window = records.year_window(F.year("o_orderdate"), F.col("o_orderkey") % 2 == 0)
    return t.orders.select("o_orderkey", records.search_state(xml).alias("s"), window.alias("w")).select("o_orderkey", "s.*", "w.*")


@query(f"""SELECT o_orderkey, {_sql('o_orderkey', "'https://ndl.jp/books/' || o_orderkey", 'NULL', 'NULL')} AS url FROM orders""")
def q_url_extract(t):
    k = F.col("o_orderkey").cast("string")
    response = _choice(F.col("o_orderkey"), F.concat(F.lit('<numberOfRecords>2</numberOfRecords>&lt;x about="https://ndl.jp/books/'), k, F.lit('#material"/>https://ndl.jp/other')), F.lit("<numberOfRecords>0</numberOfRecords>https://ndl.jp/1"), F.lit(""))
    return t.orders.select("o_orderkey", records.lookup_url(response, r"https://ndl\.jp/[^\s\"'<>]+").alias("url"))


@query("""WITH l AS (SELECT DISTINCT l_suppkey AS g, l_linenumber AS page, l_partkey % 60 AS id FROM lineitem), f AS (SELECT g, id, min(page) AS page FROM l GROUP BY 1, 2),
 p AS (SELECT l.g, l.page, count(DISTINCT l.id) AS n, count(DISTINCT f.id) AS new FROM l LEFT JOIN f ON f.g = l.g AND f.page = l.page GROUP BY 1, 2), e AS (SELECT g, min(page) FILTER (new = 0 OR n < 4) AS last FROM p GROUP BY 1)
SELECT f.g AS supplier, f.page AS page, f.id FROM f JOIN e USING (g) WHERE last IS NULL OR page <= last""")
def q_page_walk(t):
    links = t.lineitem.select(F.col("l_suppkey").alias("supplier"), F.col("l_linenumber").alias("page"), (F.col("l_partkey") % 60).alias("id"))
    return summary.page_walk(links, ["supplier"], "page", "id", 4).select("supplier", "page", "id")


@query("""WITH e AS (SELECT o_custkey, o_orderkey, CASE o_orderstatus WHEN 'P' THEN 0 WHEN 'F' THEN 1 ELSE 2 END AS level FROM orders) SELECT o_custkey, o_orderkey, level FROM (SELECT *, min(level) OVER (PARTITION BY o_custkey) AS m FROM e) WHERE level = m""")
def q_cascade(t):
    o = t.orders.select("o_custkey", "o_orderkey", "o_orderstatus")
    return merge.first_filled_by([o.filter(F.col("o_orderstatus") == s).drop("o_orderstatus") for s in ("P", "F")] + [o.filter("o_orderstatus not in ('P', 'F')").drop("o_orderstatus")], "o_custkey")


VOLUME, ISSUE = _sql("o_orderkey", "'0'", "'5'", "NULL"), _sql("o_orderkey", "'3'", "'00'", "'2'")
OTHER_VOLUME, OTHER_ISSUE = _sql("o_custkey", "'7'", "''"), _sql("o_custkey", "''", "'7'")


@query(f"""WITH o AS (SELECT *, nullif({VOLUME}, '0') AS lv, nullif({ISSUE}, '00') AS li, nullif({OTHER_VOLUME}, '') AS rv, nullif({OTHER_ISSUE}, '') AS ri FROM orders JOIN customer ON c_custkey = o_custkey),
 w AS (SELECT c_nationkey AS g, CASE WHEN ri IS NOT NULL AND rv IS NULL AND lv IS NOT NULL AND li IS NULL THEN 'i2v' WHEN rv IS NOT NULL AND ri IS NULL AND li IS NOT NULL AND lv IS NULL THEN 'v2i' ELSE 'same' END AS s, o_orderkey FROM o WHERE c_nationkey % 2 = 0 AND o_totalprice > 300000),
 m AS (SELECT g, s FROM (SELECT g, s, row_number() OVER (PARTITION BY g ORDER BY count(*) DESC, min(o_orderkey)) AS nth FROM w GROUP BY 1, 2) WHERE nth = 1),
 c AS (SELECT c_nationkey AS g, count(*) FILTER (r) AS n, count(*) FILTER (r AND lv IS NOT NULL AND li IS NULL) AS rv, count(*) FILTER (r AND li IS NOT NULL AND lv IS NULL) AS ri, count(*) FILTER (lv IS NOT NULL AND li IS NULL) AS av, count(*) FILTER (li IS NOT NULL AND lv IS NULL) AS ai FROM (SELECT *, year(o_orderdate) >= 1997 AS r FROM o) GROUP BY 1)
SELECT c.g AS nationkey, coalesce(s, CASE WHEN (CASE WHEN n > 0 THEN rv ELSE av END) > 2 * (CASE WHEN n > 0 THEN ri ELSE ai END) THEN 'i2v' WHEN (CASE WHEN n > 0 THEN ri ELSE ai END) > 2 * (CASE WHEN n > 0 THEN rv ELSE av END) THEN 'v2i' ELSE 'same' END) AS scheme FROM c LEFT JOIN m USING (g)""")
def q_scheme_fallback(t):
    o = t.orders.join(t.customer, F.col("c_custkey") == F.col("o_custkey")).select(F.col("c_nationkey").alias("nationkey"), "o_orderkey", "o_totalprice", F.year("o_orderdate").alias("year"), F.expr(VOLUME).alias("volume"), F.expr(ISSUE).alias("issue"), F.expr(OTHER_VOLUME).alias("right_volume"), F.expr(OTHER_ISSUE).alias("right_issue"))
    pairs = o.filter("nationkey % 2 = 0 and o_totalprice > 300000").withColumnsRenamed({"volume": "left_volume", "issue": "left_issue"})
    return summary.numbering_scheme(pairs, o, "nationkey", "o_orderkey", 2007)


@query("""WITH o AS (SELECT *, n_name AS journal, o_orderkey % 7 = 0 AS link_only, o_orderkey % 11 = 0 AS front, o_orderpriority = '1-URGENT' AS paired, o_orderstatus <> 'P' AS comparable, CASE WHEN o_custkey % 13 = 0 THEN 'held' WHEN c_mktsegment = 'BUILDING' THEN 'rejected' ELSE 'trusted' END AS verdict FROM orders JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey),
 l AS (SELECT n_name AS journal, count(*) AS riss, sum(c_custkey % 3)::bigint AS riss_dups FROM customer JOIN nation ON n_nationkey = c_nationkey GROUP BY 1),
 r AS (SELECT journal, count(*) FILTER (NOT link_only) AS kci, count(*) FILTER (link_only) AS kci_links, count(*) FILTER (NOT link_only AND paired) AS paired, count(*) FILTER (NOT link_only AND NOT paired AND NOT front AND verdict = 'trusted') AS kci_only, count(*) FILTER (NOT link_only AND NOT paired AND NOT front AND verdict <> 'trusted') AS held, count(*) FILTER (NOT link_only AND comparable) AS comparable, count(*) FILTER (NOT link_only AND comparable AND paired) AS comparable_matched, count(*) FILTER (NOT link_only AND verdict = 'rejected') AS bad FROM o GROUP BY 1)
SELECT l.journal, riss, riss_dups, coalesce(kci, 0) AS kci, coalesce(kci_links, 0) AS kci_links, coalesce(paired, 0) AS paired, coalesce(kci_only, 0) AS kci_only, coalesce(held, 0) AS held, coalesce(comparable, 0) AS comparable, coalesce(comparable_matched, 0) AS comparable_matched, CASE WHEN bad > 0 THEN 'BUILDING' ELSE '' END AS bad_publishers, 'same' AS scheme, round(comparable_matched / nullif(comparable, 0), 3) AS match_rate FROM l LEFT JOIN r USING (journal)""")
def q_journal_report(t):
    c = t.customer.join(F.broadcast(t.nation), F.col("n_nationkey") == F.col("c_nationkey")).withColumnRenamed("n_name", "journal")
    k = F.col("o_orderkey")
    verdict = F.when(F.col("o_custkey") % 13 == 0, "held").when(F.col("c_mktsegment") == "BUILDING", "rejected").otherwise("trusted")
    right = t.orders.join(c, F.col("c_custkey") == F.col("o_custkey")).select("journal", (k % 7 == 0).alias("link_only"), (k % 11 == 0).alias("front"), (F.col("o_orderpriority") == "1-URGENT").alias("paired"), (F.col("o_orderstatus") != "P").alias("comparable"), F.col("c_mktsegment").alias("publisher"), verdict.alias("verdict"))
    none = c.select("journal", F.lit("x").alias("scheme")).filter("1 = 0")
    report = summary.journal_report(c.withColumn("n_dups", F.col("c_custkey") % 3), right, none, "journal")
    return report.withColumn("bad_publishers", F.array_join("bad_publishers", ","))


@query("SELECT 0 AS part, '| journal | n |' AS line, '' AS name UNION ALL SELECT 1, '|-|-|', '' UNION ALL SELECT 2, '| ' || n_name || ' | ' || coalesce(nullif(n_regionkey, 0)::varchar, '-') || ' |', n_name FROM nation")
def q_report_lines(t):
    report = t.nation.select(F.col("n_name").alias("journal"), F.nullif("n_regionkey", F.lit(0)).alias("n"))
    return summary.report_lines(report, "journal", ["n"])


@query(f"""SELECT o_orderkey, {_sql('o_orderkey', "'next'", "'done'", "'done'", "'restart'", "'pause'", "'restart'", "'skip'", "'stop'", "'stop'")} AS action, {_sql('o_orderkey', "'a:b:100:' || o_orderkey", 'NULL', 'NULL', 'NULL', "'a:b:100:' || o_orderkey", 'NULL', "'a:b:100:' || (o_orderkey + 100)", "'a:b:100:' || o_orderkey", "'a:b:100:' || o_orderkey")} AS token, CASE WHEN o_orderkey % 9 = 5 THEN 'plain' ELSE 'full' END AS format FROM orders""")
def q_next_request(t):
    k = F.col("o_orderkey")
    token = F.when((k % 9 == 1) | (k % 9 == 5), F.lit(None)).otherwise(F.concat(F.lit("a:b:100:"), k.cast("string")))
    outcome = _choice(k, "ok", "ok", "none", "expired", "failed", "failed", "failed", "failed", "refused")
    step = harvest.next_request(outcome, token, F.lit("full"), k % 9 == 3, F.when(k % 9 == 5, 0).otherwise(4), F.when(k % 9 == 4, 2).otherwise(0), k % 9 == 7)
    return t.orders.select("o_orderkey", step.alias("s")).select("o_orderkey", "s.*")


@query("""WITH p AS (SELECT n_name AS journal, 0 AS part, -n_nationkey AS pos FROM nation WHERE n_nationkey % 5 = 0 UNION ALL SELECT n_name, 1, n_nationkey FROM nation WHERE n_nationkey % 2 = 0),
 f AS (SELECT journal, min({'part': part, 'pos': pos}) AS spot FROM p GROUP BY 1) SELECT journal, row_number() OVER (ORDER BY spot) AS turn FROM f""")
def q_work_list(t):
    """Nations left over, the last first, then those due."""
    n = t.nation.withColumnRenamed("n_name", "journal")
    left = n.filter("n_nationkey % 5 = 0").select("journal", (-F.col("n_nationkey")).alias("pos"))
    return harvest.work_list(left, n.filter("n_nationkey % 2 = 0").select("journal", F.col("n_nationkey").alias("pos")))


@query()
def q_search_similar(t):
    return search.similar_values(t.part, "p_name", "polishd brass boltt", 5, 0.4)


@query("SELECT p_partkey, p_brand || '|' || p_type AS keywords FROM part")
def q_keywords(t):
    xml = F.format_string("<r><k:keyword xmlns:k='u'> %1$s</k:keyword><keyword></keyword><x><keyword>%2$s</keyword></x><keyword>%1$s </keyword></r>", "p_brand", "p_type")
    return t.part.select("p_partkey", F.array_join(records.keywords(xml), "|").alias("keywords"))


@query("SELECT p_partkey, lower(replace(p_name, ' ', '')) || '불법연구' AS title FROM part")
def q_reading(t):
    """Titles in two scripts meet by a table of readings."""
    title = F.concat("p_name", F.when(F.col("p_partkey") % 2 == 0, " 佛法 연구").otherwise(" 불법 硏究"))
    return t.part.select("p_partkey", linguistic.match_title(title, {"佛": "불", "法": "법", "硏": "연", "究": "구"}).alias("title"))


@query("SELECT string_agg(n_name, ',' ORDER BY n_nationkey) AS journals, 'left over' AS note FROM nation")
def q_pending_state(t):
    """The names left over, written whole, read back as a state; once without names, which takes the file away."""
    from ..session import work_folder

    path, names = f"{work_folder(t.spark, 'state')}/pending.json", [r.n_name for r in t.nation.orderBy("n_nationkey").collect()]  # 25 names
    for some in (names[:3], [], names + names[:5]):
        merge.write_pending(t.spark, path, some, "left over")
    state = records.read_state(t.spark, path, T.StructType([T.StructField("journals", T.ArrayType(T.StringType())), T.StructField("note", T.StringType())]))
    return state.select(F.array_join("journals", ",").alias("journals"), "note")


@query("SELECT event_id, coalesce(epoch(ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id)) >= 1800, true) AS due FROM events")
def q_checkpoint_due(t):
    before = F.lag("ts").over(Window.partitionBy("user_id").orderBy("ts", "event_id"))
    return t.events.select("event_id", harvest.checkpoint_due(harvest.seconds_between(before, F.col("ts"))).alias("due"))


@query("SELECT page_id, regexp_extract(url, '[?&]utm_source=([^&#]*)', 1) AS origin, 'https://x.org/?' || CASE WHEN page_id % 2 = 0 THEN 'j=a%26b+c&' ELSE '' END || 'q=' || page_id AS link FROM pages")
def q_query_state(t):
    """What a link's parameters say, and the link that keeps a search, read back."""
    journal = F.when(F.col("page_id") % 2 == 0, "a&b c").otherwise("")
    link = search.state_url("https://x.org/", ["q", "j"], F.col("page_id").cast("string"), journal)
    rows = t.pages.select("page_id", F.coalesce(F.try_element_at(search.url_state(F.col("url")), F.lit("utm_source")), F.lit("")).alias("origin"), link.alias("link"), journal.alias("j"))
    again = search.url_state(F.col("link"))
    return rows.filter((F.coalesce(F.try_element_at(again, F.lit("j")), F.lit("")) == F.col("j")) & (F.element_at(again, "q") == F.col("page_id").cast("string"))).drop("j")
