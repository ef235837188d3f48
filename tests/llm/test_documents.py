"""Near duplicates, quality, personal data and toxicity against brute force."""

import math
import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from lexiloom.llm import near_dedup, pii, quality, toxicity

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def near_texts():
    r = random.Random(11)
    vocabulary = [f"w{i}" for i in range(400)]
    texts = ["", None, " \t\n", "one", "ONE", "one two", "Two one"]
    for size in (6, 15, 40, 200):
        base = [r.choice(vocabulary) for _ in range(size)]
        texts.append(" ".join(base))
        for rate in (0.02, 0.05, 0.08, 0.1, 0.15):
            for _ in range(6):
                texts.append(" ".join(r.choice(vocabulary) if r.random() < rate else w for w in base))
    passage = [r.choice(vocabulary) for _ in range(60)]
    texts += [" ".join(passage + [r.choice(vocabulary) for _ in range(100)]) for _ in range(25)]
    return texts + texts[7:12]


def brute_components(texts, width, percent):
    sets = []
    for t in texts:
        w = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        sets.append({tuple(w[i : i + width]) for i in range(len(w) - width + 1)} if len(w) >= width else {tuple(w)} if w else set())
    parent = list(range(len(texts)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            n = len(a & sets[j])
            if a and 100 * n >= percent * (len(a) + len(sets[j]) - n):
                x, y = sorted((root(i), root(j)))
                parent[y] = x
    return sets, [root(i) for i in range(len(texts))]


@pytest.mark.parametrize("width, rounds", [(2, 2), (2, 0), (5, 2)])
def test_near_duplicates(spark, width, rounds):
    texts = near_texts()
    df = spark.createDataFrame([(i, t, True) for i, t in enumerate(texts)], "doc_id long, text string, kept boolean").repartition(4)
    found = {r.doc_id: r for r in near_dedup.near_duplicates(df, width, 80, rounds=rounds).collect()}
    sets, roots = brute_components(texts, width, 80)
    for i in range(len(texts)):
        assert (found[i].n_shingles, found[i].component_id, found[i].kept) == (len(sets[i]), roots[i], roots[i] == i), i


def test_near_duplicates_odd_rows(spark):
    df = spark.createDataFrame([(None, "a b c"), (1, "a b c"), (1, "a b c"), (2, "a b c"), (None, None)], "doc_id long, text string")
    found = sorted((str(r.doc_id), str(r.component_id), r.kept) for r in near_dedup.near_duplicates(df, 2).collect())
    assert found == [("1", "1", True), ("1", "1", True), ("2", "1", False), ("None", "None", True), ("None", "None", True)]
    assert near_dedup.near_duplicates(df.filter("1 = 0"), 2).count() == 0


def test_repeated_rows_are_one_node(spark):
    words = [f"w{i}" for i in range(60)]
    near, far = " ".join(words), " ".join([*words[:58], "x", "y"])
    rows = spark.range(6000).selectExpr("id % 3 as k").withColumn("text", F.when(F.col("k") == 0, near).when(F.col("k") == 1, far).otherwise("other " * 3))
    found = near_dedup.near_duplicates(rows.withColumnRenamed("k", "doc_id"), 2).groupBy("doc_id", "component_id", "kept").count().collect()
    assert sorted(map(tuple, found)) == [(0, 0, True, 2000), (1, 0, False, 2000), (2, 2, True, 2000)]


def test_outsiders_of_a_large_group_need_one_link_each(spark):
    r = random.Random(5)
    base = [f"w{i}" for i in range(100)]
    group = [" ".join([*base, *(f"g{r.randrange(6)}" for _ in range(8))]) for _ in range(120)]
    outside = [" ".join([*base[:k], *(f"o{k}_{j}" for j in range(100 - k))]) for k in range(80, 99)]
    texts = group + outside
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for rounds in (0, 2):
        found = {x.doc_id: x.component_id for x in near_dedup.near_duplicates(df, 2, rounds=rounds).collect()}
        assert [found[i] for i in range(len(texts))] == brute_components(texts, 2, 80)[1]


QUALITY = ["", None, "  \n ", "one two three " * 40, "Ab! c\n" * 5 + "#*$ <x>|", " ".join(f"w{i}" for i in range(80)) + ". Fine.", "é日 本\x0b語\r\n" * 30, "a b c d a b c\n\nx\nx\n x", " ".join(f"w{i % 700}" for i in range(5000))]


def test_quality_measures(spark):
    df = spark.createDataFrame([(i, t, 3) for i, t in enumerate(QUALITY)] + [(None, "x", 3)], "doc_id long, text string, n_words int")
    found = {r.doc_id: r for r in quality.judged(df).collect()}
    for i, t in enumerate(QUALITY):
        words, t = WORD.findall(t or ""), t or ""
        lines = [x for x in t.split("\n") if WORD.search(x)]
        windows = list(zip(words, words[1:], words[2:]))
        often = Counter(windows)
        repeated = {k + j for k, w in enumerate(windows) if often[w] > 1 for j in range(3)}
        r = found[i]
        assert (r.n_words, r.word_chars, r.n_symbols) == (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in t)), i
        assert (r.n_dup_lines, r.n_repeat_words) == (len(lines) - len(set(lines)), len(repeated)), i
        assert r.base_failed == (len(words) < 50 or 100 * len(repeated) > 50 * len(words))
        assert not (r.base_failed and r.kept)
    assert found[None].base_failed
    assert quality.judged(df.filter("1 = 0")).count() == 0


def test_quality_keeps_clean_and_drops_bad(spark, sf):
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    judged = quality.judged(docs).join(labels, "doc_id").filter("not base_failed").collect()
    assert sum(r.kept != (r.quality == 1) for r in judged) <= 0.05 * len(judged)
    kept = quality.good_documents(docs.withColumn("n_words", F.lit("own")))
    assert kept.columns == [*docs.columns, "n_words"] and 0 < kept.count() < docs.count()


def brute_em(marks, rules, rounds):
    """EM over single documents, in plain loops."""
    prior = {c: {r: dict(zip((-1, 1), quality.BELIEFS[r][2 * c : 2 * c + 2])) for r in rules} for c in (0, 1)}  # 0: good, 1: bad
    for c in (0, 1):
        for r in rules:
            prior[c][r][0] = 1 - prior[c][r][-1] - prior[c][r][1]
    share, chance = quality.BAD_SHARE, prior
    for _ in range(rounds):
        weights = []
        for m in marks:
            like = [1 - share, share]
            for c in (0, 1):
                for r in rules:
                    like[c] *= chance[c][r][m[r]]
            weights.append([x / sum(like) for x in like])
        total = [sum(w[c] for w in weights) for c in (0, 1)]
        share = (total[1] + quality.PRIOR * quality.BAD_SHARE) / (len(marks) + quality.PRIOR)
        chance = {c: {r: {v: (sum(w[c] for w, m in zip(weights, marks) if m[r] == v) + quality.PRIOR * prior[c][r][v]) / (total[c] + quality.PRIOR) for v in (-1, 0, 1)} for r in rules} for c in (0, 1)}
    return [math.log(chance[0][r][v] / chance[1][r][v]) for r in rules for v in (-1, 0, 1)], math.log((1 - share) / share)


def voted(spark, marks, rules):
    return spark.createDataFrame([tuple(m[r] for r in rules) for m in marks], ", ".join(f"{r} int" for r in rules))


def test_estimates_equal_brute_force_em(spark):
    r, rules = random.Random(8), list(quality.BELIEFS)
    marks = [{x: r.choice((-1, -1, 0, 1) if i % 6 == 0 else (-1, 0) + (1,) * 12) for x in rules} for i in range(300)]
    logs, base = quality.fitted(voted(spark, marks, rules), rules)
    wanted, wanted_base = brute_em(marks, rules, quality.ROUNDS)
    assert abs(base - wanted_base) < 1e-6 and max(abs(a - b) for a, b in zip(logs, wanted)) < 1e-6
    assert quality.fitted(voted(spark, marks, rules).filter("1 = 0"), rules)[1] == pytest.approx(math.log((1 - quality.BAD_SHARE) / quality.BAD_SHARE))


def test_estimates_set_the_weight_of_a_vote(spark):
    rules = list(quality.BELIEFS)
    junk = {"symbols": -1, "capitals": -1, "plain": -1}
    marks = [{}] * 900 + [junk] * 60 + [{**junk, "sentences": -1}] * 20 + [{"sentences": -1}] * 200  # sentences: as often among the good
    logs, base = quality.fitted(voted(spark, [{x: m.get(x, 1) for x in rules} for m in marks], rules), rules)
    weight = lambda m: base + sum(logs[3 * i + 1 + m.get(r, 1)] for i, r in enumerate(rules))
    assert abs(logs[3 * rules.index("sentences")]) < 1 and logs[3 * rules.index("symbols")] < -4.5
    assert weight({"sentences": -1}) > 0 > weight(junk)


def test_one_weak_bad_vote_keeps_a_document(spark):
    r = random.Random(6)
    clean = lambda: " ".join("".join(r.choice("abcdefghij") for _ in range(5)) for _ in range(80))
    texts = [f"{clean()}. Fine?" for _ in range(60)] + [" ".join(w + r.choice(["$$$", "&&&", "###"]) for w in clean().split()) + "." for _ in range(8)] + [clean()] * 6 + ["\u65e5\u672c\u8a9e\u3001\u3067\u3059\u3002 " * 2 + clean() + "."]
    found = {x.doc_id: x.kept for x in quality.judged(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    assert [i for i, kept in found.items() if not kept] == list(range(60, 68))


def test_clean_documents_alone_stay(spark):
    r = random.Random(7)
    clean = lambda n: " ".join("".join(r.choice("abcdefghij") for _ in range(5)) for _ in range(n)) + "."
    texts = [clean(r.choice((8, 30, 80, 300))) for _ in range(80)]
    df = spark.createDataFrame([(i, t) for i, t in enumerate([*texts, "", None])], "doc_id long, text string")
    assert {x.doc_id for x in quality.good_documents(df).collect()} == set(range(80))


EMAIL, IP = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD, PHONE = re.compile(r"[0-9]([\x20-]?[0-9])+"), re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def brute_spans(t):
    digits = lambda m: re.sub("[^0-9]", "", m)
    luhn = lambda s: sum(int(c) if i % 2 == 0 else (2 * int(c) - 9 * (int(c) > 4)) for i, c in enumerate(s[::-1])) % 10 == 0
    out = [(0, m.start(), m.end()) for m in EMAIL.finditer(t)]
    out += [(1, m.start(), m.end()) for m in IP.finditer(t) if all(int(p) <= 255 for p in m[0].split("."))]
    out += [(2, m.start(), m.end()) for m in CARD.finditer(t) if 16 <= len(digits(m[0])) <= 19 and luhn(digits(m[0]))]
    out += [(3, m.start(), m.end()) for m in PHONE.finditer(t) if 8 <= len(digits(m[0])) <= 15]
    return sorted(out)


def personal_texts():
    r = random.Random(2)
    odd = ["", None, "a@b.com_x@y.z", "a@b.com.@c.de x@y.", "1.2.3.4.5.6.7.8 300.1.1.1 1.2.3 001.02.3.4", "+1 (2) 33-444-55 (", "4111 1111 1111 1111x4111-1111-1111-1111 5", "é🙂 q@w.e.r +12345678 é", "12" * 9000, "1 " * 9000, "a" * 9000 + "@", "@" * 900, "+1" + " " * 9000, "x@y.z" * 900, "4111111111111111 " * 300]
    return odd + ["".join(r.choice("a1@.+- 4(2)_é") for _ in range(r.randint(0, 60))) for _ in range(400)]


def test_personal_data_forms(spark):
    texts = personal_texts()
    df = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, kind string").repartition(3)
    for r in pii.found(df).collect():
        wanted = brute_spans(texts[r.doc_id] or "")
        said = ",".join(f"{pii.KINDS[k]}:{a}:{b}" for k, a, b in wanted)
        assert r.spans.startswith(said) and [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(w[0] == k for w in wanted) for k in range(4)], texts[r.doc_id]
    assert pii.found(df.filter("1 = 0")).count() == 0
    twice = df.filter("doc_id = 2").union(df.filter("doc_id = 2")).withColumn("doc_id", F.lit(None).cast("long"))
    assert [r.n_email for r in pii.found(twice).collect()] == [2, 2]


def test_context_finds_unseen_identifiers(spark):
    good = ["4111111111111111", "5500005555555559", "4012888888881881", "5105105105105100", "6011111111111117", "4222222222222220", "5555555555554444", "4000056655665556", "2223003122003222"]
    rows = [(i, f"card no {g} paid") for i, g in enumerate(good)] + [(90, "card no 4111111111111112 paid"), (91, "in 1984 there were 12 of them")]
    found = {r.doc_id: r for r in pii.found(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert found[90].spans == "ctx_card:8:24" and found[90].n_card == 0
    assert found[91].spans == ""


def test_context_is_learnt_from_all_forms_of_seeds(spark):
    names = ["anna.lee", "bob.ray", "cy.moor", "dan.fox", "eve.hill", "flo.park", "guy.wood", "hal.reed", "ida.lane"]
    cards = ["4111 1111 1111 1111", "5500 0055 5555 5559", "4012 8888 8888 1881", "5105-1051-0510-5100", "6011-1111-1111-1117", "4222 2222 2222 2220", "5555-5555-5555-4444", "4000 0566 5566 5556", "2223 0031 2200 3222"]
    texts = [f"please mail {n}@example.com today" for n in names] + [f"card no {c} paid" for c in cards] + [f"ring up +1 202 555 01{i}7 later" for i in range(9)]
    odd = ["please mail jo.smith@localhost today", "card no 4111 1111 1111 1112 paid", "ring up 202-555-0199 later", "a well-known sentence.Another one"]
    df = spark.createDataFrame(list(enumerate(texts + odd)), "doc_id long, text string")
    found = {r.doc_id: r for r in pii.found(df).collect()}
    assert [found[len(texts) + i].spans for i in range(4)] == ["ctx_email:12:30", "ctx_card:8:27", "ctx_phone:8:20", ""]
    assert all(found[i].n_found == 0 for i in range(len(texts)))


def test_only_the_words_around_tell(spark):
    r = random.Random(9)
    key = lambda n: "".join(r.choice("0123456789abcdef") for _ in range(n))
    sure = lambda: "0123456789abcdef" + key(24)
    filler = lambda: " ".join(r.choice("abcdefgh") * 4 for _ in range(6))
    texts = [f'{filler()} api token = "{sure()}" {filler()}' for _ in range(12)]
    texts += [f'{filler()} api token = "A{i}7-xq" {filler()}' for i in range(3)] + [f"{filler()} order A{i}7-xq9 {filler()}" for i in range(3)]
    found = {x.doc_id: x for x in pii.found(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    for i, t in enumerate(texts):
        a = t.find('"') + 1
        assert found[i].spans == (f"ctx_secret:{a}:{t.rfind(chr(34))}" if a else ""), t


def test_long_texts_with_many_spans(spark):
    text = "".join(f"x{i}@y.zz {i} +1 202 555 {i % 10000:04d} 1.2.3.4 \U0001f642\n" for i in range(3000))
    other = "é" * 9000 + " a@b.cc " + "z " * 9000
    df = spark.createDataFrame([(1, text), (2, other)], "doc_id long, text string")
    rows = {r.doc_id: r for r in pii.found(df).collect()}
    for k, t in ((1, text), (2, other)):
        assert rows[k].spans == ",".join(f"{pii.KINDS[i]}:{a}:{b}" for i, a, b in brute_spans(t))
    masked = {r.doc_id: r.text for r in pii.redacted(df).collect()}
    for k, t in ((1, text), (2, other)):
        out, at, runs = "", 0, []
        for i, a, b in sorted(brute_spans(t), key=lambda s: (s[1], s[2], s[0])):
            if runs and a < runs[-1][1]:
                runs[-1][1] = max(runs[-1][1], b)
            else:
                runs.append([a, b, pii.KINDS[i].upper()])
        for a, b, kind in runs:
            out, at = out + t[at:a] + f"<{kind}>", b
        assert masked[k] == out + t[at:]


def test_running_and_spans_that_meet(spark):
    r = random.Random(3)
    lists = [[], [5], [r.randint(-9, 9) for _ in range(1000)]] + [[r.randint(-9, 9) for _ in range(k)] for k in (63, 64, 65, 128)]
    df = spark.createDataFrame([(i, x) for i, x in enumerate(lists)], "i int, x array<bigint>")
    sums = {q.i: q.s for q in df.select("i", pii.running(F.col("x"), lambda a, b: a + b, F.lit(0).cast("long")).alias("s")).collect()}
    assert all(sums[i] == [sum(x[: k + 1]) for k in range(len(x))] for i, x in enumerate(lists))
    cases = []
    for _ in range(60):
        spans = lambda n, ranks: sorted((r.randrange(ranks), a, a + r.randint(1, 9)) for a in (r.randint(0, 60) for _ in range(n)))
        cases.append((spans(r.randint(0, 5), 4), spans(r.randint(0, 6), 5)))
    df = spark.createDataFrame([(i, *c) for i, c in enumerate(cases)], f"i int, base {pii.SPAN}, more {pii.SPAN}")
    for q in df.select("i", pii._fresh(F.col("base"), F.col("more")).alias("f")).collect():
        base, more = cases[q.i]
        assert [tuple(s) for s in q.f] == [m for m in more if not any(b[1] < m[2] and m[1] < b[2] for b in base)]


def test_masking(spark):
    df = spark.createDataFrame([(1, "to a@b.cc, or 1.2.3.4!", 5), (2, None, 6), (3, "plain é", 7), (3, "plain é", 7)], "doc_id long, text string, base int")
    assert sorted(tuple(map(str, r)) for r in pii.redacted(df).collect()) == [("1", "to <EMAIL>, or <IP>!", "5"), ("2", "None", "6"), ("3", "plain é", "7"), ("3", "plain é", "7")]


def toxic_docs(n=400):
    r = random.Random(4)
    clean = [f"c{i}" for i in range(300)]
    docs, labels = [], []
    for i in range(n):
        bad = i % 5 == 0
        words = [r.choice(clean) for _ in range(r.randint(5, 60))]
        if bad:
            for _ in range(3):
                words[r.randrange(len(words))] = r.choice(["Vile,", "nasty!", "grubbyest", "grubbyer", "grubbyly"])
        docs.append((i, " ".join(words), 1))
        labels.append((i, int(bad), 1))
    return docs, labels


def test_toxicity(spark):
    docs, labels = toxic_docs()
    extra = [(1000, None, 1), (1001, "", 1), (1002, "vile", 1), (None, "c1 nasty c2", 1), (1003, "c5 " * 3000 + "grubbyful", 1)]
    df = spark.createDataFrame(docs + extra, "doc_id long, text string, score int").repartition(4)
    marks = spark.createDataFrame(labels + [(5000, 1, 0), (None, 1, 1)], "doc_id long, toxic int, quality int")
    tagger = toxicity.train(df, marks)
    found = {r.doc_id: r for r in toxicity.score(df, tagger).collect()}
    assert sum(found[i].predicted != int(i % 5 == 0) for i in range(len(docs))) <= 4
    assert found[1000].predicted == found[1001].predicted == 0 and found[1000].score == found[1001].score
    assert [(s.start, s.end) for s in found[1002].spans] == [(0, 4)]
    assert [(s.start, s.end) for s in found[1003].spans] == [(9000, 9009)]
    rows = {r.doc_id: r for r in toxicity.toxicity(df, marks).collect()}
    assert all(rows[i].held_out == (zlib.crc32(str(i).encode()) % 5 == 0) for i in range(len(docs)))
    flipped = marks.withColumn("toxic", F.when(toxicity.held_out("doc_id"), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    other = {r.doc_id: r.score for r in toxicity.toxicity(df, flipped).collect()}
    assert all(abs(other[k] - r.score) < 1e-9 for k, r in rows.items())  # labels held out don't count
    none = toxicity.toxicity(df, marks.filter("1 = 0")).collect()
    assert {r.score for r in none} == {0.0}
    assert toxicity.not_toxic(df, tagger).columns == df.columns
    assert toxicity.score(df.filter("1 = 0"), tagger).count() == 0


def test_toxicity_of_held_out_documents(spark):
    sf = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    docs = spark.read.parquet(f"{sf}/documents.parquet").join(labels.select("doc_id"), "doc_id")
    found = toxicity.toxicity(docs, labels).filter("held_out").join(labels.select("doc_id", "toxic"), "doc_id").collect()
    toxic = [r.predicted for r in found if r.toxic == 1]
    assert len(toxic) > 50 and sum(toxic) >= 0.8 * len(toxic)
    assert sum(r.predicted for r in found if r.toxic == 0) <= 0.02 * len(found)


def test_training_bounds_and_repeated_ids(spark):
    docs, labels = toxic_docs(200)
    df = spark.createDataFrame(docs, "doc_id long, text string, score int")
    marks = spark.createDataFrame(labels, "doc_id long, toxic int, quality int")
    one = toxicity.train(df, marks, sample=15, candidates=40, chosen=3, windows=20)
    two = toxicity.train(df.union(df).union(df).repartition(5), marks, sample=15, candidates=40, chosen=3, windows=20)
    assert 0 < len(one.hashes) <= 3
    assert one.hashes.tolist() == two.hashes.tolist() and abs(one.weights - two.weights).max() < 1e-9 and abs(one.document - two.document).max() < 1e-6


def test_chain_marginals_equal_those_by_enumeration():
    import numpy as np
    import pyarrow as pa

    from lexiloom.llm.textscan import text_slices

    text = "ab cd ef bad gh ij kl mn bad op"
    (piece,) = text_slices(pa.array([text]))
    hash_ = toxicity.token_features(piece)[3][0][3]
    tagger = toxicity.Tagger(np.array([hash_]), np.array([2.5]), -1.3, np.array([[0.4, -0.2], [0.1, 0.6]]))
    score = [-1.3 + 2.5 * (w == "bad") for w in text.split()]
    n = len(score)
    total, hot = 0.0, np.zeros(n)
    for state in range(1 << n):
        y = [state >> i & 1 for i in range(n)]
        p = np.exp(sum(s for s, b in zip(score, y) if b) + sum(tagger.moves[a, b] for a, b in zip(y, y[1:])))
        total += p
        hot += p * np.array(y)
    starts, _, _, p, _ = tagger.marginals(piece)
    which = [len(text[:s].split()) for s in starts.tolist()]
    assert np.allclose(p, (hot / total)[which])
