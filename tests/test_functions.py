import pytest
from pyspark.sql import functions as F

from lexiloom.functions import linguistic, text


def value(spark, column, **cells):
    return spark.createDataFrame([tuple(cells.values())], list(cells)).select(column.alias("v")).first()["v"]


@pytest.mark.parametrize("given, wanted", [("A-B c", "abc"), ("abcdabcd", "abcd"), ("ababab", "ababab"), ("한글 A_b 漢字*", "한글ab漢字"), ("", "")])
def test_fold_title(spark, given, wanted):
    assert value(spark, text.fold_title(F.col("t")), t=given) == wanted


@pytest.mark.parametrize("given, wanted", [("10-11 제0", [10, 11]), ("", []), ("7, 3, 7", [3, 7])])
def test_numbers(spark, given, wanted):
    assert value(spark, text.numbers(F.col("t")), t=given) == wanted


@pytest.mark.parametrize("given, wanted", [("2020-01", 2020), ("abc", 0), ("99", 0), ("", 0)])
def test_year_of(spark, given, wanted):
    assert value(spark, text.year_of(F.col("t")), t=given) == wanted


def test_small_scalars(spark):
    assert value(spark, text.first_number(F.col("t")), t="pp. 12-30") == 12
    assert value(spark, text.first_number(F.col("t")), t="none") is None
    assert value(spark, text.bump_token(F.col("t")), t="a:b:100:400") == "a:b:100:500"
    assert value(spark, text.clean_affiliation(F.col("t")), t=" ;,( Univ  of X ),") == "Univ of X"
    assert value(spark, text.strip_tags(F.col("t")), t="<b>a</b> <i>b</i>") == "a b"
    assert value(spark, text.split_names(F.col("t")), t="Kim A, B;Lee C、Park") == ["Kim A", "Lee C", "Park"]
    assert value(spark, text.alias_key(F.col("t")), t="Journal and Thailand (old)") == "journalthailand"
    assert value(spark, text.longest_words(F.col("t")), t="a bbb cc bbb ddd") == ["bbb", "ddd"]
    assert len(value(spark, text.fallback_id("R", 11, F.col("t")), t="x")) == 12


def values(spark, column, cells, schema="t string"):
    """The column's value for each cell, in one job."""
    df = spark.createDataFrame([(i, *(c if isinstance(c, tuple) else (c,))) for i, c in enumerate(cells)], f"_i int, {schema}")
    return [r.v for r in df.select("_i", column.alias("v")).orderBy("_i").collect()]


def test_part_number(spark):
    cases = {
        "On Being 2": 2, "On Being II": 2, "On Being Ⅲ": 3, "論考 (上)": 1, "연구2": None, "On Being 2 ―a subtitle―": 2, "On Being": None,
        "연구 (하)": 3, "연구 상": 1, "제목상": None, "題目 中": 2, "Part ⑵": 2, "Part vi": 6, "Part vii": None, "Part 123": None, "題目 (3) :": 3, "― 2 ―": 2, "": None,
    }
    assert values(spark, linguistic.part_number(F.col("t")), [*cases, None]) == [*cases.values(), None]


def test_match_title(spark):
    cases = {
        "[특집] Ａ Title (漢字)": "atitle", "wordwordwordword": "wordword", "<특집논문1> 佛敎와 심리: 군 생활": "佛敎와심리군생활", "일반논문 : 제목": "제목", "논문 3： 제목": "제목",
        "특집 2: [기획] 서평: 책 이름": "책이름", "서평 : 논문 : 특집 : 서평 : x": "서평x", "Book Review: Zen": "zen", "북 리뷰 : 책": "책", "원효(元曉)의 사상": "원효의사상", "영산회(靈山會·掛佛) 연구": "영산회연구",
        "[" + "가" * 41 + "] 제목": "가" * 41 + "제목", "a_b": "ab", "": "",
    }
    assert values(spark, linguistic.match_title(F.col("t")), [*cases, None]) == [*cases.values(), ""]
    assert values(spark, linguistic.match_title(F.col("t"), {"佛": "불", "法": "법"}), ["佛法", "불법"]) == ["불법"] * 2
    with pytest.raises(ValueError):
        linguistic.match_title(F.col("t"), {"ab": "c"})


def test_title_similarity(spark):
    same = lambda pairs: values(spark, linguistic.title_similarity(F.col("a"), F.col("b"), F.col("p"), F.col("q")), pairs, "a string, b string, p int, q int")
    found = same([("abcdefgh", "abcdefgh", None, None), ("", "abc", None, None), ("abcdefgh", "abcdefgh", 1, 2), ("abcdefgh", "abcdefgh", 1, None), ("abcdefgh", "xxabcdefghyyyyyyyyyyyyyy", 2, 2), (None, "a", None, None)])
    assert found == pytest.approx([1.0, 0.0, 0.4, 1.0, 0.95, 0.0])
    found = same([("가나다라마바", "가나다라마바서평", None, None), ("가나다라마바", "가나다라마바review", None, None), ("가나다라마바", "가나다라마바에대한긴긴긴긴긴논평입니다", None, None), ("가나다라마바", "논평가나다라마바", None, None)])
    assert found == pytest.approx([0.95 * 0.3, 0.95, 0.95, 0.95 * 0.3])
    assert same([("abcde", "abcdexyzw", None, None)]) == pytest.approx([10 / 14])  # shorter than six: no stretch


def test_similarity_equals_plain_rules(spark):
    import difflib
    import random

    r = random.Random(4)
    pairs = [("".join(r.choice("가나다abc") for _ in range(r.randint(0, 14))), "".join(r.choice("가나다abc서평") for _ in range(r.randint(0, 14)))) for _ in range(200)]

    def plain(a, b):
        if not a or not b:
            return 0.0
        m = difflib.SequenceMatcher(None, a, b, autojunk=False)
        n = min(len(a), len(b))
        value = 1.0 if a == b else max([m.ratio(), *([m.find_longest_match().size / n * 0.95] if n >= 6 else [])])
        short, long = (a, b) if len(a) <= len(b) else (b, a)
        tail = long.replace(short, "", 1) if short in long else None
        return value * (0.3 if tail is not None and len(tail) <= 12 and any(w in tail for w in linguistic.REVIEW_WORDS) else 1)

    assert values(spark, linguistic.title_similarity(F.col("a"), F.col("b")), pairs, "a string, b string") == pytest.approx([plain(*p) for p in pairs])


def test_loose_similarity_marks_and_bytes(spark):
    assert values(spark, linguistic.loose_similarity(F.col("a"), F.col("b")), [("", "x"), ("ab", "xaby"), ("abcd", "abce")], "a string, b string") == [1.0, 1.0, 0.75]
    assert values(spark, linguistic.serial_marks(F.col("t")), ["논고 (1) (2)", "Study Ⅱ", "題目 上", "제목 12", "제목", None]) == [["1", "2"], ["ii"], ["上"], ["12"], [], []]
    raw = ["한글 é", "plain"]
    cells = [x.encode() for x in raw] + ["한글".encode("euc-kr"), "뷁".encode("cp949"), b"\xff\xfe<b>", b"", None]
    assert values(spark, linguistic.rescued(F.col("t")), cells, "t binary") == [*raw, "한글", "뷁", b"\xff\xfe<b>".decode("cp949", "replace"), "", None]


def test_page_bonus(spark):
    rows = spark.createDataFrame([(0,), (2,), (-7,), (15,), (30,), (None,)], "d int").select(linguistic.page_bonus(F.col("d")).alias("b")).collect()
    assert [r.b for r in rows] == [0.25, 0.15, 0.05, 0.0, -0.25, 0.0]
