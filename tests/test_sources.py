import json

from pyspark.sql import functions as F

from lexiloom.sources import pages, records

DETAILED = """<OAI><record><header/><metadata><x:journalInfo xmlns:x="u"><journal-name>J</journal-name><publisher-name>P</publisher-name><pub-year>2020</pub-year><volume>3</volume><issue>1</issue></x:journalInfo>
<articleInfo article-id="ART1"><article-title lang="original">제목</article-title><article-title lang="english">Title</article-title><author-group><author>Kim(Univ A)</author><author>Lee</author></author-group><fpage>5</fpage><lpage>9</lpage><doi>https://doi.org/10.1/x</doi></articleInfo></metadata></record>
<record><header status="deleted"/></record><record><header/><journalInfo/></record><resumptionToken>a:b:100:200</resumptionToken></OAI>"""


def test_detailed_records(spark):
    page = spark.createDataFrame([(DETAILED,)], "xml string")
    assert page.select(records.resumption_token(F.col("xml")).alias("t")).first().t == "a:b:100:200"
    one = page.select(F.explode(records.split_records(F.col("xml"))).alias("xml"))
    assert one.count() == 3
    (row,) = records.parse_detailed(one).collect()
    assert (row.kci_id, row.journal_name, row.year, row.volume, row.doi, row.start_page) == ("ART1", "J", "2020", "3", "10.1/x", "5")
    assert row.titles == {"original": "제목", "english": "Title"}
    assert [tuple(a) for a in row.authors] == [("Kim", "Univ A", "1"), ("Lee", "", "2")]


def test_odd_records():
    assert records.detailed_record(None) is None and records.detailed_record("<a><b></a>") is None and records.detailed_record("<r><journalInfo/></r>") is None
    found = records.detailed_record('<o:record xsi:x="1"><o:header/><w><journalInfo xml:lang="ko"><deep><volume> 3 </volume></deep></journalInfo></w><articleInfo article-id="A"><article-title>t &amp; u</article-title><author-group><author>Kim (Univ)</author></author-group></articleInfo></o:record>')
    assert (found["kci_id"], found["volume"], found["titles"], found["year"]) == ("A", "3", {"": "t & u"}, "")
    assert found["authors"] == [{"name": "Kim", "affiliation": "Univ", "order": "1"}]


def test_citation(spark):
    row = spark.createDataFrame([("Journal, 21(1), 34, pp.227-260",)], "c string").select(records.citation_parts(F.col("c")).alias("p")).first().p
    assert tuple(row) == ("Journal", "21", "1", "34", "227", "260")


def test_journal_files(spark, tmp_path):
    (tmp_path / "riss_a.json").write_text(json.dumps({"info": {"name": "a"}, "articles": [{"article_id": "1", "authors": [{"name": "n", "order": "1"}]}, {"article_id": "2"}]}))
    (tmp_path / "riss_b.json").write_text(json.dumps([{"article_id": "3", "unknown": 1}]))
    found = records.read_journals(spark, f"{tmp_path}/riss_*.json").orderBy("article_id").collect()
    assert [(r.article_id, r.file_stem, r.position) for r in found] == [("1", "a", 0), ("2", "a", 1), ("3", "b", 0)]
    assert found[0].authors[0].name == "n"
    assert records.read_journals(spark, f"{tmp_path}/none_*.json").count() == 0


def test_pages(spark):
    html = '<h3>제목<br>= Title</h3><ul><li><span class="strong">저자</span><div>Kim</div></li></ul><a href="/x?v_control_no=ab1">Vol.3 No.2 2019</a><a href="#" onclick="go(\'v_control_no\',\'cd2\')">제4권 No. 1</a><a href="/recommender/1">no</a><a href="/item/7">An article</a>'
    df = spark.createDataFrame([(html,), (None,), ("",)], "html string")
    found = df.select(pages.links("html").alias("a"), pages.detail("html").alias("d")).collect()
    assert [len(r.a) for r in found] == [4, 0, 0]
    assert (found[0].d.title, found[0].d.title_en, found[0].d.fields) == ("제목", "Title", {"저자": "Kim"})
    anchors = df.limit(1).select(pages.links("html").alias("a")).cache()
    issues = anchors.select(pages.issue_links(F.col("a")).alias("i")).first().i
    assert [(i.id, i.volume, i.issue, i.year) for i in issues] == [("ab1", "3", "2", "2019"), ("cd2", "", "1", "")]
    articles = anchors.select(pages.article_links(F.col("a"), "/item/").alias("i")).first().i
    assert [a.text for a in articles] == ["An article"]


def test_years_of_issues_are_not_their_numbers(spark):
    texts = ["Vol.1950 No.2 2019", "Vol.11900 No.7", "제2001권 No. 1998 1987", "vol 3 no 2 201912", "Casino 2019"]
    html = "".join(f'<a href="/x?v_control_no=a{i}">{t}</a>' for i, t in enumerate(texts))
    found = spark.createDataFrame([(html,)], "html string").select(pages.links("html").alias("a")).select(pages.issue_links(F.col("a")).alias("i")).first().i
    assert [i.year for i in found] == ["2019", "", "1987", "2019", "2019"]
    assert [(i.volume, i.issue) for i in found[:3]] == [("1950", "2"), ("11900", "7"), ("", "1998")]


def test_states_and_keywords(spark, tmp_path):
    from pyspark.sql import types as T

    schema = T.StructType([T.StructField("journals", T.ArrayType(T.StringType())), T.StructField("note", T.StringType())])
    (tmp_path / "good.json").write_text('{"journals": ["a", "b"],\n "note": "x"}')
    (tmp_path / "bad.json").write_text('{"journals": [')
    assert [r.journals for r in records.read_state(spark, f"{tmp_path}/good.json", schema).collect()] == [["a", "b"]]
    assert records.read_state(spark, f"{tmp_path}/bad.json", schema).count() == 0
    assert records.read_state(spark, f"{tmp_path}/none.json", schema).count() == 0
    row = spark.createDataFrame([("<r><keyword> a </keyword><keyword>b</keyword><keyword>a</keyword></r>", "3", "0")], "x string, v string, w string")
    found = row.select(records.keywords(F.col("x")), records.volume_year(F.col("v")), records.volume_year(F.col("w"))).first()
    assert list(found) == [["a", "b"], 1954, None]


def test_selectors():
    html = '<div id="x" class="a b"><p>one <b>two</b></p><br></div><p lang="en" class="kwd-list">three</p>'
    assert pages.elements_of(html, "#x p") == ["one two"]
    assert pages.elements_of(html, ".a.b b") == ["two"]
    assert pages.elements_of(html, "[class*=kwd]") == ["three"] == pages.elements_of(html, "p[lang='en']")
    assert pages.elements_of(html, ".b") == ["one two"] and pages.elements_of(None, "p") == [] and pages.elements_of("<p>open", "div p") == []
    assert pages.items_of("", "x", "y", "z") == [] == pages.items_of('<div class="x"><a class="y" href="/q">t</a></div>', "x", "y", "/(z)")
