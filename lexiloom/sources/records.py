"""Scans: journal files in JSON, harvested XML records by local tag name, citation strings."""

from __future__ import annotations

import re
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

AUTHOR = T.StructType([T.StructField(n, T.StringType()) for n in ("name", "affiliation", "order")])
_STRINGS = "article_id id riss_id kci_id kci_hint riss_hint title_kr title_en title_ja abstract_kr abstract_en abstract_ja journal_name year volume issue start_page end_page doi riss_url kci_url jstage_url ndl_url publisher kci_year kci_volume kci_issue source detail".split()
ARTICLE = T.StructType(
    [T.StructField(n, T.StringType()) for n in _STRINGS]
    + [T.StructField("authors", T.ArrayType(AUTHOR))]
    + [T.StructField(n, T.ArrayType(T.StringType())) for n in ("alt_ids", "keywords_kr", "keywords_en", "keywords_ja", "ai_keywords", "sources")]
    + [T.StructField(n, T.BooleanType()) for n in ("link_only", "needs_author")]
)


def read_journals(spark: SparkSession, path: str, schema: T.StructType = ARTICLE) -> DataFrame:
    """Articles of journal files (a path, directory or glob), each {"info": ..., "articles": [...]} or a bare array.

    Adds ``file_stem`` (without a source prefix such as riss_) and ``position`` in the file.  A path with no files gives no rows.
    """
    empty = T.StructType([*schema.fields, T.StructField("file_stem", T.StringType()), T.StructField("position", T.IntegerType())])
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    found = hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(hadoop)
    if not found:
        return spark.createDataFrame([], empty)
    text = spark.read.text(path, wholetext=True).select("value", F.regexp_extract(F.col("_metadata.file_name"), r"^(?:[a-z]+_)?(.*?)\.json$", 1).alias("file_stem"))
    array = T.ArrayType(schema)
    bare = F.ltrim("value").startswith("[")
    articles = F.when(bare, F.from_json("value", array)).otherwise(F.from_json("value", T.StructType([T.StructField("articles", array)]))["articles"])
    rows = text.select("file_stem", F.posexplode(articles).alias("position", "_a"))
    return rows.select("_a.*", "file_stem", "position")


def tag(xml: Column, name: str, within: str = "") -> Column:
    """Texts of all elements of a local name, whatever their namespace and depth."""
    inside = f"//*[local-name()='{within}']" if within else ""
    return F.xpath(xml, F.lit(f"{inside}//*[local-name()='{name}']/text()"))


def attribute(xml: Column, name: str, key: str) -> Column:
    return F.xpath(xml, F.lit(f"//*[local-name()='{name}']/@{key}"))


def split_records(xml: Column, name: str = "record") -> Column:
    """The record elements of a page, as strings."""
    return F.regexp_extract_all(xml, F.lit(rf"(?s)<(?:\w+:)?{name}[\s>].*?</(?:\w+:)?{name}>"), F.lit(0))


LANGUAGES = T.MapType(T.StringType(), T.StringType())
_PARTS = {"journal_name": "journal-name", "publisher": "publisher-name", "year": "pub-year", "volume": "volume", "issue": "issue", "start_page": "fpage", "end_page": "lpage", "doi": "doi", "url": "url"}
DETAILED = T.StructType([T.StructField("kci_id", T.StringType()), T.StructField("titles", LANGUAGES), T.StructField("authors", T.ArrayType(AUTHOR)), *(T.StructField(n, T.StringType()) for n in _PARTS)])


def element(xml: str | None) -> ElementTree.Element | None:
    """A record as an element whose tags and attributes have lost their prefixes; None if it isn't well formed."""
    bare = re.sub(r"(</?)[\w.-]+:|(\s)[\w.-]+:(?=[\w.-]+\s*=)", r"\1\2", xml or "")
    try:
        return ElementTree.fromstring(re.sub(r"\sxmlns(?:=|\b)[\"'][^\"']*[\"']", "", bare))
    except ElementTree.ParseError:
        return None


def detailed_record(xml: str | None) -> dict | None:
    """A record of the detailed harvest format by local tag names, whatever their depth; None for deleted and incomplete ones."""
    root = element(xml)
    if root is None or any(h.get("status") == "deleted" for h in root.iter("header")) or next(root.iter("journalInfo"), None) is None:
        return None
    article = next(root.iter("articleInfo"), None)
    if article is None:
        return None
    said = lambda node: "".join(node.itertext()).strip()
    out = {name: next((said(e) for e in root.iter(tag_)), "") for name, tag_ in _PARTS.items()}
    people = []
    for author in root.iter("author"):
        name, place = next(author.iter("name"), None), next(author.iter("affiliation"), None)
        if name is not None:
            people.append((said(name), said(place) if place is not None else ""))
    if not people:
        whole = [re.match(r"([^(]*)(?:\(([^)]*)\))?", said(a)) for group in root.iter("author-group") for a in group.iter("author")]
        people = [(m[1].strip(), m[2] or "") for m in whole]
    titles = {t.get("lang") or "": said(t) for t in root.iter("article-title")}
    authors = [{"name": n, "affiliation": a, "order": str(i + 1)} for i, (n, a) in enumerate(people)]
    return out | {"kci_id": article.get("article-id"), "titles": titles, "authors": authors}


def parse_detailed(records: DataFrame, xml_col: str = "xml") -> DataFrame:
    """Records of the detailed harvest format, each parsed once; deleted ones and those without journal or article parts go."""

    @F.pandas_udf(DETAILED)
    def parsed(xml: pd.Series) -> pd.DataFrame:
        rows = [detailed_record(x) or {} for x in xml]
        return pd.DataFrame([{f: r.get(f) for f in DETAILED.names} for r in rows], columns=DETAILED.names)

    rows = records.select(parsed(xml_col).alias("r")).filter("r.titles is not null").select("r.*")
    return rows.withColumn("doi", F.regexp_replace("doi", r"^https?://(?:dx\.)?doi\.org/", ""))


def citation_parts(citation: Column) -> Column:
    """Struct of journal, volume, issue, serial, start_page and end_page of "Journal, 21(1), 34, pp.227-260"."""
    part = lambda p, g=1: F.regexp_extract(citation, p, g)
    return F.struct(
        F.trim(part(r"^([^,]*)")).alias("journal"),
        part(r",\s*([0-9]+)\s*(?:\(|,|$)").alias("volume"),
        part(r",\s*[0-9]+\s*\(([^)]*)\)").alias("issue"),
        part(r",\s*[0-9]+\s*(?:\([^)]*\))?\s*,\s*([0-9]+)\s*,").alias("serial"),
        part(r"pp?\.\s*([0-9]+)").alias("start_page"),
        part(r"pp?\.\s*[0-9]+\s*-\s*([0-9]+)").alias("end_page"),
    )


def parse_dublin_core(records: DataFrame, xml_col: str = "xml") -> DataFrame:
    """Records of the Dublin Core fallback format."""
    xml = F.col(xml_col)
    deleted = F.exists(attribute(xml, "header", "status"), lambda s: s == "deleted")
    kinds, values = attribute(xml, "identifier", "type"), tag(xml, "identifier")
    identifiers = F.map_from_arrays(kinds, values)
    cited = citation_parts(F.coalesce(F.try_element_at(identifiers, F.lit("journalInfo")), F.lit("")))
    return records.filter(~deleted).select(
        F.try_element_at(identifiers, F.lit("artiId")).alias("kci_id"),
        F.get(tag(xml, "title"), 0).alias("title"),
        tag(xml, "creator").alias("authors"),
        F.substring(F.get(tag(xml, "date"), 0), 1, 4).alias("year"),
        F.try_element_at(identifiers, F.lit("doi")).alias("doi"),
        cited.alias("cited"),
    ).select("*", "cited.*").drop("cited")


def resumption_token(xml: Column) -> Column:
    return F.nullif(F.trim(F.coalesce(F.get(tag(xml, "resumptionToken"), 0), F.lit(""))), F.lit(""))


def to_articles(raw: DataFrame, title: str, lang: str) -> DataFrame:
    """English originals (ASCII titles marked as English) get title_en, others title_kr; a volume of 0 is none."""
    english = F.col(title).rlike(r"^[\x00-\x7F]*$") & (F.lower(lang) == "en")
    return raw.withColumns({
        "title_kr": F.when(english, "").otherwise(F.col(title)),
        "title_en": F.when(english, F.col(title)).otherwise(F.lit("")),
    })


def flat_index(articles: DataFrame, authors: str = "authors", keywords: tuple[str, ...] = ("keywords_kr", "keywords_en")) -> DataFrame:
    """Author names joined by spaces and all keywords in one array, for searching."""
    empty = F.array().cast("array<string>")
    return articles.withColumn("author_names", F.array_join(F.transform(authors, lambda a: a["name"]), " ")).withColumn("keywords", F.concat(*[F.coalesce(F.col(k), empty) for k in keywords]))


def bibtex(key: Column, title: Column, author: Column, journal: Column, year: Column) -> Column:
    field = lambda n, c: F.concat(F.lit(f"  {n} = {{"), F.coalesce(c.cast("string"), F.lit("")), F.lit("}"))
    return F.concat(F.lit("@article{"), key.cast("string"), F.lit(",\n"), F.concat_ws(",\n", field("title", title), field("author", author), field("journal", journal), field("year", year)), F.lit("\n}"))


def ris(title: Column, author: Column, journal: Column, year: Column) -> Column:
    line = lambda n, c: F.concat(F.lit(f"{n}  - "), F.coalesce(c.cast("string"), F.lit("")))
    return F.concat_ws("\n", F.lit("TY  - JOUR"), line("TI", title), line("AU", author), line("JO", journal), line("PY", year), F.lit("ER  - "))


def citation(author: Column, title: Column, journal: Column, volume: Column, issue: Column, year: Column, pages: Column) -> Column:
    """A citation in the Korean manner."""
    return F.concat(author, F.lit(", 「"), title, F.lit("」, 『"), journal, F.lit("』 "), F.concat_ws(" ", F.concat(volume, F.lit("권")), F.concat(issue, F.lit("호"))), F.lit(", "), year, F.lit(", "), pages, F.lit("쪽."))


def keywords(xml: Column, name: str = "keyword") -> Column:
    """Distinct keywords of a detail response, trimmed, in order."""
    return F.array_distinct(F.filter(F.transform(tag(xml, name), lambda k: F.trim(k)), lambda k: k != ""))


def read_state(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A state file (harvest position, misses, pending names); a missing or unreadable one is empty, not an error."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    if not hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(hadoop):
        return spark.createDataFrame([], schema)
    corrupt = T.StructType([*schema.fields, T.StructField("_corrupt_record", T.StringType())])
    rows = spark.read.text(path, wholetext=True).select(F.from_json("value", corrupt).alias("s")).select("s.*")
    return rows.filter(F.col("_corrupt_record").isNull()).drop("_corrupt_record")


def volume_year(volume: Column, first_year: int = 1952) -> Column:
    """The year of an annual volume, where a source gives none; volumes under 1 have none."""
    n = volume.try_cast("int")
    return F.when(n >= 1, n + (first_year - 1))


#: What a search service says when it has nothing, and when it refuses to go on.
NOTHING, REFUSED = r"(?i)No\s*Data|검색\s*결과가\s*없|결과가 없습니다", r"(?i)인증키|유효하지|권한|한도|초과|limit|invalid"


def search_state(xml: Column) -> Column:
    """Struct of total and state of a search response: records, empty, or stop (the service refused, don't ask on)."""
    total = F.nullif(F.regexp_extract(xml, r"<total>\s*([0-9]+)", 1), F.lit("")).try_cast("int")
    said = F.regexp_replace(xml, r"(?s)<inputData>.*?</inputData>", " ")  # the request repeated
    state = F.when(F.contains(xml, F.lit("<record")), "records").when(said.rlike(NOTHING), "empty").when(total.isNull() & said.rlike(REFUSED), "stop").otherwise("empty")
    return F.struct(F.when(said.rlike(NOTHING) & ~F.contains(xml, F.lit("<record")), 0).otherwise(F.coalesce(total, F.lit(0))).alias("total"), state.alias("state"))


def year_window(year: Column, exact: Column | None = None) -> Column:
    """Struct of date_from and date_to (yyyymm): the year, with its neighbours unless ``exact``; nulls for an unknown year."""
    width = F.when(F.coalesce(exact, F.lit(False)) if exact is not None else F.lit(False), 0).otherwise(1)
    known = F.nullif(year, F.lit(0))
    return F.struct(F.concat((known - width).cast("string"), F.lit("01")).alias("date_from"), F.concat((known + width).cast("string"), F.lit("12")).alias("date_to"))


def lookup_url(response: Column, pattern: str = r"https?://[^\s\"'<>&]+") -> Column:
    """The first address in the answer to a lookup, without what follows #; null if the answer has no hits."""
    hits = F.nullif(F.regexp_extract(response, r"<numberOfRecords>([0-9]+)</numberOfRecords>", 1), F.lit("")).try_cast("int")
    return F.when(hits > 0, F.nullif(F.substring_index(F.regexp_extract(response, f"({pattern})", 1), "#", 1), F.lit("")))
