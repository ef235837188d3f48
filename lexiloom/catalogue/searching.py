"""Searches with the query language, snippets, suggestions and filters."""

from pyspark.sql import functions as F

from ..plans import search
from .registry import query

ALL = "lower(concat_ws(' ', text, lang, source))"


def _searcher(**more):
    return search.Searcher({"text": F.col("text"), "lang": F.col("lang"), "source": F.col("source")}, **more)


def _ids(t, text, **more):
    return _searcher(**more).search(t.documents, text).select("doc_id")


@query(f"SELECT doc_id FROM documents WHERE contains({ALL}, 'apache')")
def q_search_all(t):
    return _ids(t, "Apache")


@query(f"SELECT doc_id FROM documents WHERE contains({ALL}, 'the') AND contains({ALL}, 'license')")
def q_search_and(t):
    return _ids(t, "the license")


@query(rf"SELECT doc_id FROM documents WHERE contains(regexp_replace({ALL}, '\s+', '', 'g'), 'apachelicense')")
def q_search_phrase(t):
    return _ids(t, '"Apache  License"')


@query(f"SELECT doc_id FROM documents WHERE contains({ALL}, 'apache') OR contains({ALL}, 'token') AND contains({ALL}, 'the')")
def q_search_or(t):
    return _ids(t, "apache | token the")


@query(f"SELECT doc_id FROM documents WHERE contains({ALL}, 'license') AND NOT contains({ALL}, 'apache')")
def q_search_not(t):
    return _ids(t, "license -apache")


@query("SELECT doc_id FROM documents WHERE contains(lower(lang), 'fr') AND contains(lower(source), 'src3') AND NOT contains(lower(text), 'the')")
def q_search_field(t):
    return _ids(t, "lang:fr source:src3 -text:the")


@query(f"SELECT doc_id FROM documents WHERE contains({ALL}, 'licence') OR contains({ALL}, 'license') OR contains({ALL}, 'lizenz')")
def q_search_expand(t):
    return _ids(t, "licence", expand={"licence": ["license", "lizenz"]})


@query("SELECT p_name, min(levenshtein(lower(p_name), 'zzsteel bolt'))::bigint AS distance FROM part WHERE (SELECT count(*) FROM part WHERE contains(lower(p_name), 'zzsteel bolt')) = 0 AND levenshtein(lower(p_name), 'zzsteel bolt') <= 8 GROUP BY 1 ORDER BY distance, p_name LIMIT 5")
def q_search_typo(t):
    return search.suggestions(t.part, "p_name", "zzsteel bolt", 5, 8).withColumn("distance", F.col("distance").cast("long"))


@query("""WITH p AS (SELECT doc_id, text, instr(lower(text), 'license') AS a FROM documents), s AS (SELECT *, greatest(a - 20, 1) AS b FROM p)
SELECT doc_id, CASE WHEN a = 0 THEN '' ELSE substr(text, b, a - b) || '**' || substr(text, a, 7) || '**' || substr(text, a + 7, 20) END AS snippet FROM s""")
def q_search_snippet(t):
    return t.documents.select("doc_id", search.snippet(F.col("text"), "license").alias("snippet"))


@query("SELECT (year(o_orderdate) // 10 * 10)::bigint AS decade, c_mktsegment AS category, count(*) AS n FROM orders JOIN customer ON c_custkey = o_custkey WHERE n_in(c_mktsegment) GROUP BY 1, 2".replace("WHERE n_in(c_mktsegment)", "WHERE c_mktsegment IN ('BUILDING', 'MACHINERY') AND year(o_orderdate) >= 1994"))
def q_search_filters(t):
    o = t.orders.join(t.customer, F.col("c_custkey") == F.col("o_custkey")).filter(F.col("c_mktsegment").isin("BUILDING", "MACHINERY") & (F.year("o_orderdate") >= 1994))
    return o.groupBy(search.decade(F.year("o_orderdate")).cast("long").alias("decade"), F.col("c_mktsegment").alias("category")).agg(F.count(F.lit(1)).alias("n"))


@query("SELECT doc_id, n_chars FROM documents WHERE contains(lower(text), 'license') ORDER BY n_chars DESC, doc_id LIMIT 20")
def q_search_sort(t):
    return _searcher().search(t.documents, "text:license").select("doc_id", "n_chars").orderBy(F.desc("n_chars"), "doc_id").limit(20)


@query("SELECT conv_id, turn FROM conversations WHERE contains(lower(concat_ws(' ', role, text)), 'user') AND NOT contains(lower(concat_ws(' ', role, text)), 'the')")
def q_search_conversations(t):
    fields = {"role": F.col("role"), "text": F.col("text")}
    return search.Searcher(fields).search(t.conversations, "user -the").select("conv_id", "turn")
