"""Scans and parsing: HTML pages, XML and JSON records, links and page checks."""

from pyspark.sql import functions as F

from ..functions import text
from ..operators import merge
from ..session import work_folder
from ..sources import pages, records
from .registry import query


@query(r"""WITH a AS (SELECT page_id, unnest(regexp_extract_all(html, '(?s)<a [^>]*href="([^"]*)"[^>]*>.*?</a>', 1)) AS href, unnest(regexp_extract_all(html, '(?s)<a [^>]*href="[^"]*"[^>]*>(.*?)</a>', 1)) AS t FROM pages)
SELECT page_id, href, trim(regexp_replace(replace(regexp_replace(t, '<[^>]*>', '', 'g'), '&amp;', '&'), '\s+', ' ', 'g')) AS text FROM a""")
def q_html_links(t):
    anchors = t.pages.select("page_id", F.inline(pages.links("html")))
    return anchors.select("page_id", "href", "text")


@query(r"SELECT page_id, trim(regexp_replace(regexp_replace(html, '<[^>]*>', ' ', 'g'), '\s+', ' ', 'g')) AS plain FROM pages")
def q_strip_tags(t):
    return t.pages.select("page_id", text.strip_tags(F.col("html")).alias("plain"))


@query("""SELECT s_suppkey, s_name AS title, CASE WHEN s_suppkey % 2 = 0 THEN 'In ' || s_name ELSE '' END AS title_en, CASE WHEN s_suppkey % 3 = 0 THEN 'Kim & ' || s_name ELSE 'Lee' END AS author, CASE WHEN s_suppkey % 3 = 0 THEN 2 ELSE 1 END::BIGINT AS n_fields FROM supplier""")
def q_html_detail(t):
    k = F.col("s_suppkey")
    heading = F.when(k % 2 == 0, F.format_string("<h3>%1$s<br> = In %1$s</h3>", "s_name")).otherwise(F.format_string("<div><h1></h1><h2>%1$s</h2></div>", "s_name"))
    fields = F.when(k % 3 == 0, F.format_string('<ul><li><span class="strong">저자 :</span><div><p>Kim &amp; %1$s</p></div></li><li><span>연도</span><div>2020</div></li></ul>', "s_name")).otherwise("<dl><dt>저자</dt><dd>Lee</dd><dd>no label</dd></dl>")
    found = t.supplier.select("s_suppkey", F.concat(heading, fields).alias("html")).select("s_suppkey", pages.detail("html").alias("d"))
    author = F.coalesce(F.try_element_at("d.fields", F.lit("저자")), F.try_element_at("d.fields", F.lit("저자 ")))
    return found.select("s_suppkey", "d.title", "d.title_en", author.alias("author"), F.size("d.fields").cast("long").alias("n_fields"))


@query(r"""WITH l AS (SELECT page_id, regexp_extract_all(html, '<a [^>]*href="([^"]*)"', 1) AS h, regexp_extract_all(url, '[a-z]+') AS m FROM pages)
SELECT page_id, array_to_string(h[1:greatest(len(m), 1)], ' ') AS names FROM l""")
def q_slice_by_count(t):
    hrefs = F.regexp_extract_all("html", F.lit(r'<a [^>]*href="([^"]*)"'), F.lit(1))
    meta = F.regexp_extract_all("url", F.lit("([a-z]+)"), F.lit(1))
    return t.pages.select("page_id", F.array_join(pages.slice_by_count(hrefs, meta), " ").alias("names"))


@query(r"""WITH p AS (SELECT page_id, html, lower(regexp_extract(html, '<title>([^<]*)</title>', 1) || ' ' || html[:6000]) AS head FROM pages)
SELECT page_id, CASE WHEN length(html) = 0 THEN 'empty' WHEN length(html) < 2500 THEN 'short' WHEN contains(head, 'robot') OR contains(head, 'stupid') THEN 'blocked' WHEN length(html) < 15000 AND contains(head, 'cookie') THEN 'blocked' ELSE 'fine' END AS problem FROM p""")
def q_page_quality(t):
    title = F.regexp_extract("html", "<title>([^<]*)</title>", 1)
    problem = pages.page_problem(F.col("html"), title, ["robot", "stupid"], ["cookie"], short=2500)
    return t.pages.select("page_id", F.coalesce(problem, F.lit("fine")).alias("problem"))


@query(r"""SELECT page_id, CASE WHEN NOT contains(url, 'example') THEN 'url' WHEN trim(regexp_extract(html, '<title>([^<]*)</title>', 1)) = '' THEN 'title missing'
 WHEN page_id % 10 <= 4 THEN 'title differs' WHEN NOT contains('example.org', regexp_extract(url, '(example\.[a-z]+)', 1)) THEN 'journal differs' WHEN NOT (1900 + page_id % 150 BETWEEN 1945 AND 2025) THEN 'year' ELSE 'fine' END AS problem FROM pages""")
def q_validate_reason(t):
    title = F.regexp_extract("html", "<title>([^<]*)</title>", 1)
    problem = pages.detail_problem(title, title, F.col("page_id") % 10 / 9.0, F.contains(F.col("url"), F.lit("example")), F.regexp_extract("url", r"(example\.[a-z]+)", 1), F.lit("example.org"), F.lit(1900) + F.col("page_id") % 150, F.lit(2024))
    return t.pages.select("page_id", F.coalesce(problem, F.lit("fine")).alias("problem"))


XML = """concat('<oai:record xmlns:oai="u"><oai:header', if(p_partkey % 7 = 0, ' status="deleted"', ''), '/><m><journalInfo><journal-name>', p_brand, '</journal-name><pub-year>2020</pub-year><volume>', p_size, '</volume></journalInfo>', if(p_partkey % 5 = 0, '', concat('<articleInfo article-id="ART', p_partkey, '"><article-title lang="en">', p_name, '</article-title><author-name><author><name>', p_type, '</name></author></author-name><fpage>', p_size, '</fpage><doi>https://doi.org/10.1/', p_partkey, '</doi></articleInfo>')), '</m></oai:record>')"""


@query("""SELECT 'ART' || p_partkey::varchar AS kci_id, p_name AS title, p_type AS author, p_brand AS journal_name, p_size::varchar AS volume, '10.1/' || p_partkey::varchar AS doi FROM part WHERE p_partkey % 7 <> 0 AND p_partkey % 5 <> 0""")
def q_xml_records(t):
    parsed = records.parse_detailed(t.part.select(F.expr(XML).alias("xml")))
    return parsed.select("kci_id", F.element_at("titles", "en").alias("title"), F.get(F.col("authors"), 0)["name"].alias("author"), "journal_name", "volume", "doi")


@query("""SELECT p_partkey, p_brand AS journal, p_size::varchar AS volume, '1' AS issue, p_partkey::varchar AS serial, p_size::varchar AS start_page, (p_size + 9)::varchar AS end_page FROM part""")
def q_citation_parse(t):
    cited = F.format_string("%s, %d(1), %d, pp.%d-%d", "p_brand", "p_size", "p_partkey", "p_size", F.col("p_size") + 9)
    return t.part.select("p_partkey", records.citation_parts(cited).alias("c")).select("p_partkey", "c.*")


@query("SELECT 'ART' || p_partkey::varchar AS kci_id, p_name AS title, p_brand AS journal, '2020' AS year FROM part WHERE p_partkey % 7 <> 0")
def q_dublin_core(t):
    xml = F.expr("""concat('<record><header', if(p_partkey % 7 = 0, ' status="deleted"', ''), '/><dc:dc xmlns:dc="d"><dc:title lang="en">', p_name, '</dc:title><dc:identifier type="artiId">ART', p_partkey, '</dc:identifier><dc:identifier type="journalInfo">', p_brand, ', 1(2), 3, pp.4-5</dc:identifier><dc:date>2020-01</dc:date></dc:dc></record>')""")
    return records.parse_dublin_core(t.part.select(xml.alias("xml"))).select("kci_id", "title", "journal", "year")


def _journals(t):
    """Files of articles, made of suppliers, a hundred a file: wrapped ones and bare ones."""
    path = work_folder(t.spark, "journals")
    article = F.struct(F.col("s_suppkey").cast("string").alias("article_id"), F.col("s_name").alias("title_kr"), F.lit("2020").alias("year"))
    file = F.concat(F.when(F.col("s_suppkey") % 2 == 0, "even").otherwise("odd"), F.floor(F.col("s_suppkey") / 200).cast("string"))
    rows = t.supplier.groupBy(file.alias("file")).agg(F.to_json(F.sort_array(F.collect_list(article))).alias("a"))
    value = F.when(F.col("file").startswith("odd"), F.col("a")).otherwise(F.concat(F.lit('{"info": {"name": "x"}, "articles": '), "a", F.lit("}")))
    rows.select("file", value.alias("value")).repartition("file").write.partitionBy("file").text(f"{path}/parts")
    hadoop = t.spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    fs = hadoop(path).getFileSystem(t.spark.sparkContext._jsc.hadoopConfiguration())
    for found in fs.globStatus(hadoop(f"{path}/parts/file=*/part-*")):
        fs.rename(found.getPath(), hadoop(f"{path}/riss_{found.getPath().getParent().getName().removeprefix('file=')}.json"))
    return path


@query("SELECT s_suppkey::varchar AS article_id, s_name AS title_kr, '2020' AS year FROM supplier")
def q_scan_json(t):
    return records.read_journals(t.spark, f"{_journals(t)}/riss_*.json").select("article_id", "title_kr", "year")


@query("SELECT CASE WHEN s_suppkey % 2 = 0 THEN 'even' ELSE 'odd' END AS journal, count(*) AS n, max(s_suppkey) AS last_id FROM supplier GROUP BY 1")
def q_scan_glob(t):
    rows = records.read_journals(t.spark, f"{_journals(t)}/riss_*.json")
    return rows.groupBy(F.regexp_extract("file_stem", "[a-z]+", 0).alias("journal")).agg(F.count(F.lit(1)).alias("n"), F.max(F.col("article_id").cast("long")).alias("last_id"))


@query("SELECT o_orderkey AS orderkey, 'orders' AS origin FROM orders WHERE o_totalprice > 400000 UNION ALL SELECT o_orderkey, 'late' FROM orders WHERE (SELECT count(*) FROM orders WHERE o_totalprice > 400000) = 0 AND o_orderkey % 2 = 0 UNION ALL SELECT o_orderkey, 'any' FROM orders WHERE (SELECT count(*) FROM orders WHERE o_totalprice > 400000 OR o_orderkey % 2 = 0) = 0")
def q_fallback_union(t):
    o = t.orders
    parts = [(o.filter("o_totalprice > 400000"), "orders"), (o.filter("o_orderkey % 2 = 0"), "late"), (o, "any")]
    return merge.first_filled([df.select(F.col("o_orderkey").alias("orderkey"), F.lit(n).alias("origin")) for df, n in parts])
