import random

import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lexiloom.functions.linguistic import title_similarity
from lexiloom.operators import dedupe, feed, graph, linkage, merge, summary


def rows(df, *order):
    return [tuple(r) for r in df.orderBy(*(order or df.columns)).collect()]


def greedy(edges):
    a, b, out = set(), set(), []
    for x, y, s in sorted(edges, key=lambda e: (e[2], e[0], e[1]), reverse=True):
        if x not in a and y not in b:
            a.add(x), b.add(y), out.append((x, y, s))
    return sorted(out)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(0, 6), st.integers(0, 6), st.sampled_from([0.5, 0.7, 0.9])), min_size=1, max_size=25, unique_by=lambda e: e[:2]))
def test_greedy_rounds_equal_the_sequential_result(spark, edges):
    df = spark.createDataFrame(edges, "l int, r int, s double")
    assert rows(linkage.greedy_rounds(df, "l", "r", "s")) == greedy(edges)


def test_greedy_rounds_pair_large_groups_of_equal_scores(spark):
    edges = [(x, y, 1.0) for x in range(80) for y in range(70)] + [(200 + x, 200 + y, 0.5) for x in range(3) for y in range(4) if x + y] + [(79, 200, 0.7), (0, 201, 0.9)]
    df = spark.createDataFrame(edges, "l int, r int, s double")
    assert rows(linkage.greedy_rounds(df, "l", "r", "s")) == greedy(edges)


def test_greedy_rounds_walk_a_chain_to_its_end(spark):
    n = 140  # left k has edges to right k and k + 1 with falling scores, so each round settles few
    edges = [(k, k, 1.0 - k / 1000) for k in range(n)] + [(k, k + 1, 0.9995 - k / 1000) for k in range(n - 1)]
    df = spark.createDataFrame(edges, "l int, r int, s double")
    assert rows(linkage.greedy_rounds(df, "l", "r", "s")) == greedy(edges)
    few = [e for e in edges if e[0] < 6 and e[1] < 6]
    small = df.filter("l < 6 and r < 6")
    assert rows(linkage.greedy_rounds(small, "l", "r", "s", rounds=1, most=3)) == greedy(few)  # parts too large for one task


def test_greedy_blocks(spark):
    random.seed(1)
    edges = [(b, x, y, random.choice([0.5, 0.7])) for b in range(3) for x in range(4) for y in range(4)]
    df = spark.createDataFrame(edges, "b int, l int, r int, s double")
    found = rows(linkage.greedy_blocks(df, "b", "l", "r", "s"))
    assert [f[1:] for f in found if f[0] == 1] == greedy([e[1:] for e in edges if e[0] == 1])


def test_residual_pairs_keep_every_similar_pair(spark):
    r = random.Random(3)

    def changed(t):
        t = list(t)
        for _ in range(r.randint(1, 3)):
            i = r.randrange(len(t) - 1)
            kind = r.randrange(4)
            if kind == 0:
                t[i] = r.choice("abcdefgh")
            elif kind == 1:
                t[i], t[i + 1] = t[i + 1], t[i]
            elif kind == 2:
                t.insert(i, r.choice("abcdefgh"))
            else:
                del t[i]
        return "".join(t)

    titles = ["".join(r.choice(letters) for _ in range(n)) for n in (8, 9, 10, 11, 12, 14, 20, 30, 41) for letters in ["abcdefgh"] * 8 + ["ab"]]
    others = [changed(t) for t in titles for _ in range(4)] + [t[:-1] for t in titles] + [t + "x" * 9 for t in titles]
    a, b = (spark.createDataFrame(list(enumerate(x)), "id int, key string") for x in (titles, others))
    found = {(p.l_id, p.r_id) for p in linkage.residual_pairs(a, b, "key").collect()}
    found_back = {(p.r_id, p.l_id) for p in linkage.residual_pairs(b, a, "key").collect()}
    every = a.toDF("i", "x").crossJoin(b.toDF("j", "y")).filter(F.length("y") >= 8)
    wanted = {(q.i, q.j) for q in every.filter(title_similarity(F.col("x"), F.col("y")) >= 0.9).collect()}
    assert len(wanted) > 150 and wanted <= found and wanted <= found_back


def test_residual_pairs_never_send_all_titles_to_the_driver(spark):
    a = spark.createDataFrame([(1, "x", "abcdefghij"), (2, "x", "0123456789"), (3, None, "abcdefghij"), (4, "y", "k" * 40)], "id int, j string, key string")
    b = spark.createDataFrame([(7, "x", "abcdefghiz"), (8, "y", "abcdefghij"), (9, None, "abcdefghij"), (10, "y", "p" * 30 + "k" * 38), (11, "x", None)], "id int, j string, key string")
    found = linkage.residual_pairs(a, b, "key", block=["j"])
    assert {(r.l_id, r.r_id) for r in found.collect()} == {(1, 7), (4, 10)}
    last = found._jdf.queryExecution().sparkPlan().toString().split("Union")[0]  # the joins of pairs with their titles
    assert last.count("SortMergeJoin") == 2 and "BroadcastHashJoin" not in last


def test_alike_pairs_measure_values_once(spark):
    r = random.Random(5)
    data = [(i, r.choice(["x", "y", None]), r.choice([2000, 2001, 2003, None]), r.choice(["aa", "ab", "bbbb", None])) for i in range(60)]
    a, b = (spark.createDataFrame(d, f"{i} int, j string, y int, v string") for d, i in ((data[:30] + data[:2], "a"), (data[30:], "b")))
    found = rows(linkage.alike_pairs(a, b, ["j"], "v", lambda x, y: F.levenshtein(x, y), lambda d: d <= 1, "a", "b", "d", "y"))
    plain = linkage.block_pairs(a, b, ["j"], "y", F.levenshtein("l_v", "r_v") <= 1).select("l_a", "r_b", F.levenshtein("l_v", "r_v"))
    assert found == sorted(tuple(p) for p in plain.collect()) and len(found) > 20


def test_greedy_alike_equals_greedy_rounds(spark):
    r = random.Random(6)
    names = ["aa", "ab", "abc", "bbbb", "b"]
    lefts, rights = ([(i, r.choice("xy"), r.choice(names)) for i in range(n)] for n in (40, 30))
    lefts += [(0, "x", "aa"), (0, "x", "abc"), (90, None, "aa"), (None, "x", "aa")]
    a, b = spark.createDataFrame(lefts, "a int, j string, v string"), spark.createDataFrame(rights + [(91, "x", None)], "b int, j string, v string")
    score = lambda x, y: F.round(F.lit(1) - F.levenshtein(x, y) / F.greatest(F.length(x), F.length(y)), 6)
    plain = linkage.block_pairs(a, b, ["j"]).filter("l_v is not null and r_v is not null").select(F.col("l_a").alias("a"), F.col("r_b").alias("b"), score(F.col("l_v"), F.col("r_v")).alias("s"))
    wanted = greedy([tuple(e) for e in plain.collect() if e.a is not None])
    assert rows(linkage.greedy_alike(a, b, ["j"], "v", score, "a", "b")) == wanted
    assert rows(linkage.greedy_alike(a, b, ["j"], "v", score, "a", "b", most=1)) == wanted  # blocks too large for one task
    both = a.union(spark.createDataFrame([(1, "x", "aa"), (1, "y", "ab")], a.schema))  # an id in two blocks
    edges = linkage.block_pairs(both, b, ["j"]).filter("l_v is not null and r_v is not null and l_a is not null").select("l_a", "r_b", score(F.col("l_v"), F.col("r_v")))
    assert rows(linkage.greedy_alike(both, b, ["j"], "v", score, "a", "b")) == greedy([tuple(e) for e in edges.collect()])


def test_components(spark):
    edges = [(i, i + 1) for i in range(1, 40)] + [(100, 200), (200, 150), (7, 300)]
    found = {r.node: r.component for r in graph.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert {found[i] for i in [*range(1, 41), 300]} == {1} and {found[i] for i in (100, 150, 200)} == {100}


def test_known_id_join_claims_once(spark):
    left = spark.createDataFrame([(1, "k1", "d", 0), (2, "k1", "e", 1)], "l int, k string, d string, pos int")
    right = spark.createDataFrame([(10, "k1", None, 0), (11, None, "e", 1), (12, None, "d", 2)], "r int, rk string, rd string, pos int")
    found = rows(linkage.known_id_join(left, right, [("k", "rk", "last"), ("d", "rd", "last")], "l", "r"))
    assert found == [(10, 2, 0), (12, 1, 1)]  # the row that claims 2 later goes without


def test_year_band_and_subset(spark):
    a = spark.createDataFrame([(1, "5", 2000), (2, "5", 2004)], "id int, nums string, year int")
    b = spark.createDataFrame([(7, "5", 2001), (8, "5", 2002)], "id int, nums string, year int")
    assert [(r.l_id, r.r_id) for r in linkage.block_pairs(a, b, ["nums"], "year").collect()] == [(1, 7)]
    x = spark.createDataFrame([(1, [5]), (2, [9])], "a int, n array<int>")
    y = spark.createDataFrame([(7, [5, 6]), (8, [9])], "b int, n array<int>")
    assert rows(linkage.subset_pairs(x, y, "n", "a", "b")) == [(1, 7)]


def test_fuzzy_dedupe(spark):
    data = [
        (0, "a", "sametitle", 5, [1], 2000, "", "x", ["z"]), (1, "b", "sametitle", 5, [1], 2000, "kept", "", ["y", "a"]), (2, "c", "sametitle", 6, [1], 2000, "", "", []),
        (3, "d", "short", None, [2], 0, "", "", []), (4, "e", "short", None, [2], 0, "", "", []),
        (5, "f", "overlapping", 1, [1, 2], 0, "", "", []), (6, "g", "overlapping", 1, [2, 3], 0, "", "", []), (7, "h", "overlapping", 1, [], 1999, "full", "", None),
        (8, "i", "longertitle", None, [3], 2001, "", "", []), (9, "j", "longertitle", 4, [3], 0, "", "", []), (10, "k", "longertitle", 4, [3], 2002, "", "", []), (11, "l", "longertitle", None, [], 2001, "", "", []),
        (12, "m", "contents of", 1, [1], 2000, "", "", []), (13, "n", "contents of", 1, [1], 2000, "", "", []), (14, "o", None, 1, [1], 0, "", "", []), (15, "p", None, 1, [1], 0, "", "", []), (16, "q", "abc", 1, [1], 0, "", "", []), (17, "r", "abc", 1, [1], 0, "", "", []),
    ]
    df = spark.createDataFrame(data, "pos int, id string, key string, page int, nums array<int>, year int, f string, g string, alt_ids array<string>")
    twins = lambda rows: dedupe.fuzzy_dedupe(rows, "key", "pos", "id", ["f", "g"], completeness=[F.col("f") != ""], apart=F.col("key").startswith("contents"))
    found = {r.id: (r.alt_ids, r.f, r.g) for r in twins(df).collect()}
    assert found["b"] == (["y", "a", "z"], "kept", "x")  # the more complete stays, with both rows' earlier ids
    assert found["h"] == (["f"], "full", "") and "g" in found  # numbers that only overlap are different, missing ones fit
    assert found["i"] == (["j"], "", "") and found["k"][0] == [] and found["l"][0] == []
    assert set(found) == set("bcdeghiklmnopqr")
    assert twins(df.filter("1 = 0")).count() == 0


def test_fuzzy_dedupe_equals_one_pass_over_the_rows(spark):
    r = random.Random(2)
    data = [(i, f"id{i}", r.choice(["abc", "title one", "titletwotwo"]), r.choice([None, 1, 2]), r.choice([[], [1], [1, 2]]), r.choice([0, 2000, 2001]), r.choice(["", "x"]), r.choice(["", "y"])) for i in range(150)]
    df = spark.createDataFrame(data, "pos int, id string, key string, page int, nums array<int>, year int, f string, g string")
    groups = []
    for row in data:
        _, _, key, page, nums, year, _, _ = row
        for g in groups:
            _, _, k, p, n, y, _, _ = g[0]
            place = page == p and (not nums or not n or set(nums) == set(n)) if page is not None and p is not None else bool(nums) and set(nums) == set(n) and len(key) >= 8
            if len(key) >= 4 and k == key and (not year or not y or year == y) and place:
                g.append(row)
                break
        else:
            groups.append([row])
    wanted = {}
    for g in groups:
        ranked = sorted(g, key=lambda x: (x[6] != "", x[7] != ""), reverse=True)
        wanted[ranked[0][1]] = ([x[1] for x in ranked[1:]], next((x[6] for x in ranked if x[6]), ""), next((x[7] for x in ranked if x[7]), ""))
    found = dedupe.fuzzy_dedupe(df, "key", "pos", "id", ["f", "g"], completeness=[F.col("f") != "", F.col("g") != ""])
    assert {x.id: (x.alt_ids, x.f, x.g) for x in found.collect()} == wanted


def test_clear_repeated_and_caps(spark):
    df = spark.createDataFrame([(i, "u" if i < 3 else "v") for i in range(5)], "i int, u string")
    assert rows(dedupe.clear_repeated(df, "u", 3)) == [(0, None), (1, None), (2, None), (3, "v"), (4, "v")]
    stored, new = spark.createDataFrame([("g", 1), ("g", 2)], "g string, k int"), spark.createDataFrame([("g", 2), ("g", 3), ("g", 4)], "g string, k int")
    assert rows(dedupe.capped_append(stored, new, "g", "k", 3, "k")) == [("g", 1), ("g", 2), ("g", 3)]


def test_upsert_keeps_sticky_fields(spark, tmp_path, monkeypatch):
    old = spark.createDataFrame([(1, "a", "hint", "p"), (2, "b", "h2", "q")], "k int, v string, h string, part string")
    new = spark.createDataFrame([(1, "c", "", "p"), (3, "d", "", "p")], "k int, v string, h string, part string")
    assert rows(merge.upsert(old, new, "k", ["h"])) == [(1, "c", "hint", "p", False), (2, "b", "h2", "q", False), (3, "d", "", "p", True)]
    path = str(tmp_path / "t")
    merge.write_upsert(old, path, "k", "part", ["h"])
    merge.write_upsert(new, path, "k", "part", ["h"])
    merge.write_upsert(new, path, "k", "part", ["h"])
    assert rows(merge.read_table(spark, path).select("k", "v", "h")) == [(1, "c", "hint"), (2, "b", "h2"), (3, "d", "")]
    moved = spark.createDataFrame([(2, "e", "", "p"), (4, "f", "", None)], "k int, v string, h string, part string")
    for _ in range(2):
        merge.write_upsert(moved, path, "k", "part", ["h"])
    assert rows(merge.read_table(spark, path)) == [(1, "c", "hint", "p"), (2, "e", "h2", "p"), (3, "d", "", "p"), (4, "f", "", None)]
    assert merge.read_table(spark, str(tmp_path / "none"), old.schema).count() == 0
    # A run that dies before the manifest is replaced changes nothing.
    real = merge.write_text
    monkeypatch.setattr(merge, "write_text", lambda *a: (_ for _ in ()).throw(OSError("gone")))
    with pytest.raises(OSError):
        merge.write_upsert(old, path, "k", "part")
    monkeypatch.setattr(merge, "write_text", real)
    assert merge.read_table(spark, path).count() == 4


def test_small_files_are_written_whole(spark, tmp_path):
    path = str(tmp_path / "pending.json")
    merge.write_pending(spark, path, ["b", "a", "b"], "left over", "2024-01-02")
    merge.write_pending(spark, path, ["b", "a", "b"], "left over", "2024-01-02")
    assert merge.read_text(spark, path) == '{"journals": ["b", "a"], "updated": "2024-01-02", "note": "left over"}'
    assert not list(tmp_path.glob("*.tmp"))
    merge.write_pending(spark, path, [])
    assert merge.read_text(spark, path) is None
    merge.write_pending(spark, path, [])


def test_cascade_and_uncovered(spark):
    a = spark.createDataFrame([("x", 1), ("x", 2)], "j string, i int")
    b = spark.createDataFrame([("x", 9), ("y", 3), (None, 4)], "j string, i int")
    assert rows(merge.first_filled_by([a, b], "j")) == [(None, 4, 1), ("x", 1, 0), ("x", 2, 0), ("y", 3, 1)]
    assert rows(merge.uncovered(b, spark.createDataFrame([("y", 3), (None, 4)], "j string, i int"), ["j", "i"])) == [("x", 9)]


def test_fill_overlay_priority(spark):
    a = spark.createDataFrame([(1, "", "x"), (2, "y", "")], "k int, f string, g string")
    b = spark.createDataFrame([(1, "new", "new"), (3, "z", "z")], "k int, f string, g string")
    assert rows(merge.left_fill(a, b, "k", ["f", "g"])) == [(1, "new", "x"), (2, "y", "")]
    assert rows(merge.overlay(a, b, "k", ["f", "g"])) == [(1, "new", "new"), (2, "y", "")]
    assert rows(merge.priority_merge(a, b, F.col("k"), ["f"])) == [(1, "new", "x"), (2, "y", ""), (3, "z", "z")]


def test_trust_gate(spark):
    data = [("held", "p", i < 2, True) for i in range(4)] + [("ok", "good", True, True)] * 3 + [("ok", "bad", i == 0, True) for i in range(3)] + [("ok", None, False, False)]
    df = spark.createDataFrame(data, "j string, p string, paired boolean, comparable boolean")
    verdicts = {(r.j, r.p, r.verdict) for r in merge.trust_gate(df, "j", "p", "paired", "comparable").collect()}
    assert verdicts == {("held", "p", "held"), ("ok", "good", "trusted"), ("ok", "bad", "rejected"), ("ok", None, "trusted")}


def test_stable_and_new(spark):
    df = spark.createDataFrame([(0, "a", "b"), (1, "c", "d"), (2, "e", None)], "pos int, i string, j string")
    old = spark.createDataFrame([("b", "X"), ("c", "X")], "any_id string, primary_id string")
    assert [r.stable_id for r in merge.stable_ids(df, ["i", "j"], old, "pos").orderBy("pos").collect()] == ["X", "d", "e"]
    previous = spark.createDataFrame([("b", None), ("zz", "c")], "i string, j string")
    assert [r.pos for r in merge.new_rows(df, ["i", "j"], previous, ["i", "j"], "pos").collect()] == [2]


def test_changed_and_fallback(spark):
    a = spark.createDataFrame([(1, "x"), (2, "y"), (3, None)], "k int, v string")
    b = spark.createDataFrame([(2, "z"), (3, None), (4, "w")], "k int, v string")
    assert rows(merge.changed_rows(a, b, "k", ["v"])) == [(1, "inserted"), (2, "updated"), (4, "deleted")]
    assert rows(merge.first_filled([a.filter("k > 9"), a, b])) == rows(a)


def test_feed(spark):
    schema = "date string, journal string, volume string, issue string, count long, source string"
    one = spark.createDataFrame([("2024-01-02", "j", "1", "2", 3, "A")], schema)
    two = spark.createDataFrame([("2024-01-02", "j", "1", "2", 4, "B"), ("2024-01-01", "j", "1", "2", 1, "A")], schema)
    merged = feed.merge_entries(one, two)
    assert rows(merged) == [("2024-01-01", "j", "1", "2", 1, "A"), ("2024-01-02", "j", "1", "2", 7, "A+B")]
    assert rows(feed.merge_entries(one, two, keep=1))[0][0] == "2024-01-02"
    assert rows(feed.retract(merged, two)) == [("2024-01-02", "j", "1", "2", 3)]


def test_runs_and_modes(spark):
    days = spark.createDataFrame(pd.DataFrame({"d": pd.to_datetime(["2024-01-01", "2024-01-02", "2024-01-03", "2024-01-05"])}))
    assert [r.n_days for r in summary.islands(days, "d", most=2).orderBy("first_day").collect()] == [2, 1, 1]
    seq = spark.createDataFrame([("g", i, e) for i, e in enumerate([1, 0, 1, 1, 1, 0])], "g string, i int, e int")
    assert [r.i for r in summary.stop_after_empty(seq, ["g"], "i", F.col("e") == 1).orderBy("i").collect()] == [0, 1, 2, 3, 4]
    votes = spark.createDataFrame([("g", "b", 0), ("g", "a", 1), ("g", "a", 2), ("g", "b", 3)], "g string, v string, pos int")
    assert rows(summary.mode_by(votes, ["g"], ["v"], "pos")) == [("g", "b", 2)]
    years = spark.createDataFrame([("j", y, n) for y, n in [(1, 0), (2, 0), (3, 0), (4, 1)]], "j string, y int, n int")
    assert rows(summary.coverage(years, "j", "y", "n")) == [("j", 2)]


def test_range_semi(spark):
    values = spark.createDataFrame([(float(i),) for i in range(0, 100, 7)], "v double")
    ranges = spark.createDataFrame([(5.0, 20.0), (90.0, 91.0)], "a double, b double")
    assert [r.v for r in summary.in_ranges(values, "v", ranges, "a", "b", 10).orderBy("v").collect()] == [7.0, 14.0, 91.0]


@pytest.mark.parametrize("empty", [True, False])
def test_best_overlap(spark, empty):
    a = spark.createDataFrame([("c", f"t{i}") for i in range(4)], "g string, k string")
    b = spark.createDataFrame([] if empty else [("j", "t0"), ("j", "t1"), ("m", "t9")], "o string, k string")
    assert rows(linkage.best_overlap(a, b, "g", "o", "k")) == ([] if empty else [("c", "j", 2, 4, 0.5)])


def test_a_cluster_needs_a_shared_folder():
    from types import SimpleNamespace as Own

    from lexiloom.session import shared_folder

    told = {}
    conf = Own(get=lambda k, d=None: told.get(k, d), set=told.__setitem__)
    session = lambda master: Own(conf=conf, sparkContext=Own(master=master, getConf=lambda: Own(get=lambda k, d=None: d)))
    for master in ("yarn", "spark://x:7077", "local-cluster[2,1,1024]", "k8s://x"):
        with pytest.raises(ValueError):
            shared_folder(session(master))
    assert shared_folder(session("local[4]")).startswith("file://")
    told["spark.checkpoint.dir"] = "hdfs://x/y/"
    assert shared_folder(session("yarn")) == "hdfs://x/y"


def test_numbering_schemes(spark):
    pairs = spark.createDataFrame([("a", 1, "5", "", "", "5"), ("a", 2, "0", "6", "6", None), ("a", 3, "7", "0", "0", "7"), ("t", 1, "1", "2", "1", "2"), ("t", 2, "", "3", "3", "")], "j string, pos int, left_volume string, left_issue string, right_volume string, right_issue string")
    own = [("b", "3", "", 2020)] * 3 + [("b", "", "3", 2020)] + [("c", "3", "", 1990)] * 2 + [("c", "", "4", 1990)] + [("d", "", "4", 1990)] * 3 + [("d", "4", "", 2020)] + [("a", "", "1", 2020)] * 9
    left = spark.createDataFrame(own, "j string, volume string, issue string, year int")
    assert rows(summary.numbering_scheme(pairs, left, "j", "pos", 2024)) == [("a", "i2v"), ("b", "i2v"), ("c", "same"), ("d", "i2v"), ("t", "same")]
