"""Rules on records as column expressions: ids and links, front matter, subtitles among authors, search terms, names of journals."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .linguistic import CJK, GLOSS, match_title, nfkc, without_labels

#: How titles of front matter begin (in any case).
FRONT_MATTER = (
    "목차", "차례", "目次", "편집후기", "編輯後記", "간행사", "발간사", "권두언", "卷頭言", "투고규정", "논문투고", "연구윤리", "학회소식", "회칙",
    "편집위원", "편집규정", "표지", "판권", "contents", "editorial",
)
#: Authors and titles of records that were entered as a test.
TEST_AUTHORS, TEST_TITLES = ("asdf", "test", "테스트", "qwer", "aaa"), ("test", "테스트")
#: An issue's number in a folded title.
ISSUE_NUMBER = r"(?:제|vol|no)?[0-9]+(?:집|호|권)?"
#: What subtitles of Japanese articles contain, and a name with an alias in brackets.
SUBTITLE_SIGNS = r"[のをにてと「」『』〔〕]|より|から|など|おける|於ける|ついて|として|める|みる|考察|研究|試論|序説|一考|中心|論$"
NAME_WITH_ALIAS = r"^[一-鿿〓]{2,5}[（(][^)）]{1,20}[)）]$"
#: Dashes that enclose a subtitle, and labels that aren't worth searching for.
DASHES, LABEL_WORDS = "―─\\-－", r"특집|특별|기획|논문|總說|特輯|論文|企劃"


def _strings(c: Column) -> Column:
    return F.coalesce(c, F.array().cast("array<string>"))


def front_matter(title: Column, authors: Column, journal: Column) -> Column:
    """Whether a record is no article: no title, a title of front matter, a test, or the journal's name with an issue's number."""
    t = F.trim(F.coalesce(title, F.lit("")))
    tests = F.exists(_strings(authors), lambda a: F.lower(F.trim(a)).isin(*TEST_AUTHORS)) | F.lower(t).isin(*TEST_TITLES)
    core = lambda c: F.regexp_replace(match_title(c), ISSUE_NUMBER, "")
    same = (core(t) != "") & (core(t) == core(F.coalesce(journal, F.lit(""))))
    return (t == "") | F.lower(t).rlike(rf"^(?:{'|'.join(FRONT_MATTER)})") | F.coalesce(tests, F.lit(False)) | same


def article_id(field: Column, url: Column, pattern: str = "ART[0-9]{6,}") -> Column:
    """The id that a record carries, else the one in its link; empty without either."""
    return F.coalesce(F.nullif(F.trim(field), F.lit("")), F.regexp_extract(url, pattern, 0), F.lit(""))


def record_url(id_: Column, before: str, otherwise: str = "") -> Column:
    """The direct page of an id; without one the home page, or nothing."""
    return F.when(F.coalesce(id_, F.lit("")) != "", F.concat(F.lit(before), id_)).otherwise(F.lit(otherwise))


def clean_doi(c: Column) -> Column:
    """A DOI without the resolver's address, or what looks like one within a link."""
    bare = F.regexp_replace(F.trim(c), r"^https?://(?:dx\.)?doi\.org/", "")
    return F.when(bare.rlike("^https?://"), F.regexp_extract(bare, r"10\.[0-9]+/\S+", 0)).otherwise(bare)


def made_doi(doi: Column, prefix: str, code: Column, volume: Column, issue: Column, page: Column) -> Column:
    """The DOI, or where it is missing and the page is known the one that the publisher's scheme gives."""
    made = F.concat(F.lit(prefix + "/"), code, F.lit("."), volume, F.lit("."), issue, F.lit("_"), page)
    return F.coalesce(F.nullif(doi, F.lit("")), F.when(F.coalesce(page, F.lit("")) != "", made), F.lit(""))


def is_candidate(name: Column, hints: list[str], excludes: list[str] = (), exact: list[str] = ()) -> Column:
    """Whether an unknown journal is worth a look: a hint in its name (any case), no excluded part, not excluded by its whole name."""
    any_of = lambda words, holds: F.exists(F.array(*map(F.lit, words)), holds) if words else F.lit(False)
    hinted = any_of([h.lower() for h in hints], lambda h: F.contains(F.lower(name), h))
    return hinted & ~any_of(list(excludes), lambda x: F.contains(name, x)) & ~(F.trim(name).isin(*exact) if exact else F.lit(False))


def is_subtitle(name: Column) -> Column:
    """Whether an author's field holds a subtitle: it begins with a dash, or is long, in one script, and reads like a phrase."""
    n = F.trim(F.coalesce(name, F.lit("")))
    person = n.rlike(r"[A-Za-z]|\s") | n.rlike(NAME_WITH_ALIAS)
    return n.rlike(rf"^[{DASHES}]") | (~person & (F.length(n) >= 5) & n.rlike(SUBTITLE_SIGNS))


def subtitle_moved(title: Column, authors: Column, field: str = "name") -> Column:
    """Struct of title (with the first subtitle among the authors, if it isn't there yet), authors (the others, in order) and moved."""
    subtitles = F.filter(authors, lambda a: is_subtitle(a[field]))
    first = F.regexp_replace(F.get(subtitles, 0)[field], rf"^[{DASHES}\s]+|[{DASHES}\s]+$", "")
    fresh = (F.coalesce(first, F.lit("")) != "") & ~F.contains(F.coalesce(title, F.lit("")), F.coalesce(first, F.lit("")))
    kept = F.filter(authors, lambda a: ~is_subtitle(a[field]))
    return F.struct(F.when(fresh, F.concat(F.coalesce(title, F.lit("")), F.lit(" ―"), first, F.lit("―"))).otherwise(title).alias("title"), kept.alias("authors"), (F.size(subtitles) > 0).alias("moved"))


def loose_title(c: Column) -> Column:
    """A title without spaces, brackets, dashes and colons, normalised and in lower case."""
    return F.lower(F.regexp_replace(nfkc(c), r"[\s　「-』【】（）()\[\]\-―:：・]", ""))


def search_terms(title: Column, most: int = 4) -> Column:
    """What to ask another catalogue for: the beginnings of the parts around colons, the longest CJK run, the two longest words."""
    whole = without_labels(F.coalesce(title, F.lit("")))
    plain = F.regexp_replace(F.regexp_replace(whole, GLOSS, ""), "[「」『』《》〈〉\"“”‘’'<>]", " ")
    label = lambda p: p.rlike(LABEL_WORDS) & (F.length(F.trim(p)) <= 14)
    parts = F.filter(F.split(plain, r"\s*[:：]\s*|\s[-–—―]\s?|\s?[-–—―]\s"), lambda p: F.trim(p) != "")
    leading = F.slice(F.filter(parts, lambda p: ~label(p)), F.lit(1), F.lit(2))

    def head(part: Column) -> Column:
        """Whole words while they fit 25 characters, one at least."""
        start = F.struct(F.lit("").alias("q"), F.lit(True).alias("open"))

        def add(s: Column, w: Column) -> Column:
            fits = s["open"] & ((s["q"] == "") | (F.length(s["q"]) + F.length(w) + 1 <= 25))
            return F.struct(F.when(fits, F.trim(F.concat(s["q"], F.lit(" "), w))).otherwise(s["q"]).alias("q"), fits.alias("open"))

        return F.aggregate(F.filter(F.split(part, r"\s+"), lambda w: w != ""), start, add, lambda s: s["q"])

    def longest(words: Column, n: int) -> Column:
        ordered = F.array_sort(F.transform(words, lambda w, i: F.struct((-F.length(w)).alias("n"), i.alias("i"), w.alias("w"))))
        return F.transform(F.slice(ordered, F.lit(1), F.lit(n)), lambda x: x["w"])

    runs = F.transform(longest(F.regexp_extract_all(whole, F.lit(rf"([{CJK}]{{3,}})"), F.lit(1)), 1), lambda w: F.left(w, F.lit(12)))
    words = longest(F.regexp_extract_all(plain, F.lit("([가-힣A-Za-z]{3,})"), F.lit(1)), 2)
    tidy = F.transform(F.concat(F.transform(leading, head), runs, words), lambda q: F.regexp_replace(F.regexp_replace(q, r"\s+", " "), r"^[ \-–—―:：,.]+|[ \-–—―:：,.]+$", ""))
    return F.slice(F.array_distinct(F.filter(tidy, lambda q: F.length(q) >= 2)), F.lit(1), F.lit(most))


def name_variants(name: Column, known: Column, aliases: Column) -> Column:
    """Names to look a journal up by, each once: the one that worked last, its aliases, its own."""
    each = F.concat(F.array(known), _strings(aliases), F.array(name))
    return F.array_distinct(F.filter(each, lambda n: F.coalesce(n, F.lit("")) != ""))


def significant(c: Column) -> Column:
    """A volume or issue number, null if it is missing or all zeros."""
    return F.when(F.regexp_replace(F.coalesce(c.cast("string"), F.lit("")), "^0+|0+$", "") != "", c.cast("string"))
