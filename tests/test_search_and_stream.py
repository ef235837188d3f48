from pyspark.sql import functions as F

from lexiloom.operators import merge
from lexiloom.plans import search
from lexiloom.streaming import harvest


def test_grammar():
    terms = search.parse('a "b  c" | -lang:en x:y', {"lang"})
    assert [[(t.text, t.phrase, t.field, t.negated) for t in x] for x in terms] == [[("a", False, None, False), ("b  c", True, None, False)], [("en", False, "lang", True), ("x:y", False, None, False)]]
    assert search.parse("  |  ") == []
    assert search.from_query_string(search.to_query_string({"q": "a b", "y": "2020"})) == {"q": "a b", "y": "2020"}


def test_search(spark):
    df = spark.createDataFrame([(1, "Alpha Beta", "en"), (2, "alphabeta", "de"), (3, "gamma", "en"), (4, None, "de")], "i int, t string, l string")
    s = search.Searcher({"t": F.col("t"), "l": F.col("l")}, expand={"gamma": ["delta", "alpha"]})
    ids = lambda q: sorted(r.i for r in s.search(df, q).collect())
    assert ids('"alpha beta"') == [1, 2]
    assert ids("alpha -l:de") == [1]
    assert ids("gamma") == [1, 2, 3]
    assert ids("beta | l:en") == [1, 2, 3]
    assert ids("") == [1, 2, 3, 4]
    assert df.select(search.snippet(F.col("t"), "beta", 3).alias("s")).first().s == "ha **Beta**"
    assert [r.t for r in search.suggestions(df, "t", "gamme").collect()] == ["gamma"]
    assert search.suggestions(df, "t", "gamma").count() == 0


def test_stream_upserts_once(spark, tmp_path):
    e = spark.createDataFrame([(i % 4, f"2024-01-0{1 + i % 3} 00:00:00", "p", i % 4) for i in range(8)], "k int, ts string, part string, v int").withColumn("ts", F.col("ts").cast("timestamp_ntz"))
    e.filter("k < 3").write.parquet(str(tmp_path / "in"))
    for _ in range(2):
        stream = spark.readStream.schema(e.schema).parquet(str(tmp_path / "in"))
        harvest.harvest_stream(stream, "k", "ts", str(tmp_path / "out"), "part", str(tmp_path / "check")).awaitTermination()
    e.filter("k = 3").write.mode("append").parquet(str(tmp_path / "in"))
    harvest.harvest_stream(spark.readStream.schema(e.schema).parquet(str(tmp_path / "in")), "k", "ts", str(tmp_path / "out"), "part", str(tmp_path / "check")).awaitTermination()
    assert sorted(r.k for r in merge.read_table(spark, str(tmp_path / "out")).collect()) == [0, 1, 2, 3]


def test_similar_values(spark):
    df = spark.createDataFrame([("antique chartreuse",), ("antique blue",), ("steel",), (None,)], "t string")
    assert [r.t for r in search.similar_values(df, "t", "antiqe chartreus").collect()] == ["antique chartreuse"]
    assert search.similar_values(df, "t", "steel").count() == 0


def test_checkpoints_and_work(spark):
    df = spark.createDataFrame([(10,), (1800,), (None,)], "s int")
    assert [r.d for r in df.select(harvest.checkpoint_due(F.col("s")).alias("d")).collect()] == [False, True, True]
    one, two = (spark.createDataFrame(x, "journal string, pos int") for x in ([("b", 0), ("a", 1)], [("a", 0), ("c", 1)]))
    assert [r.journal for r in harvest.work_list(one, two).orderBy("turn").collect()] == ["b", "a", "c"]


def test_checkpoints_count_fractions_of_seconds(spark):
    times = [("00:00:00.9", "00:30:00.899999"), ("00:00:00.9", "00:30:00.9"), ("00:00:00.1", "00:29:59.9"), (None, "00:00:00")]
    df = spark.createDataFrame(times, "a string, b string").select(*[F.concat(F.lit("2024-01-01 "), c).cast("timestamp_ntz").alias(c) for c in ("a", "b")])
    assert [r.d for r in df.select(harvest.checkpoint_due(harvest.seconds_between(F.col("a"), F.col("b"))).alias("d")).collect()] == [False, True, False, True]
