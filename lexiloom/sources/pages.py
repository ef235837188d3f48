"""Web pages: links, label and value lists and headings from HTML columns, and checks of pages and details."""

from __future__ import annotations

import re
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

LINKS = T.ArrayType(T.StructType([T.StructField(n, T.StringType()) for n in ("href", "onclick", "text")]))
DETAIL = T.StructType([T.StructField("title", T.StringType()), T.StructField("title_en", T.StringType()), T.StructField("fields", T.MapType(T.StringType(), T.StringType()))])
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())


class _Links(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.found, self.open = [], None

    def handle_starttag(self, tag, attrs):
        if tag == "a":
            self._close()
            own = dict(attrs)
            self.open = [own.get("href") or "", own.get("onclick") or "", []]

    def handle_endtag(self, tag):
        if tag == "a":
            self._close()

    def handle_data(self, data):
        if self.open:
            self.open[2].append(data)

    def _close(self):
        if self.open:
            self.found.append((self.open[0], self.open[1], " ".join("".join(self.open[2]).split())))
            self.open = None


def links_of(html: str | None) -> list[tuple[str, str, str]]:
    parser = _Links()
    parser.feed(html or "")
    parser.close()
    parser._close()
    return parser.found


@F.pandas_udf(LINKS)
def links(html: pd.Series) -> pd.Series:
    """All anchors of a page in order."""
    return html.map(lambda h: [dict(zip(("href", "onclick", "text"), x)) for x in links_of(h)])


class _Labels(HTMLParser):
    """Text blocks in order, each with its tag and class."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.stack, self.blocks = [], []

    def handle_starttag(self, tag, attrs):
        if tag not in VOID:
            self.stack.append((tag, dict(attrs).get("class") or "", []))
        elif tag == "br" and self.stack:
            self.stack[-1][2].append("\n")

    def handle_endtag(self, tag):
        for i in range(len(self.stack) - 1, -1, -1):
            if self.stack[i][0] == tag:
                for name, kind, text in reversed(self.stack[i:]):
                    whole = "".join(text)
                    self.blocks.append((name, kind, whole.strip()))
                del self.stack[i:]
                break

    def handle_data(self, data):
        if self.stack:
            self.stack[-1][2].append(data)


def detail_of(html: str | None, label_tags: tuple[str, ...] = ("strong", "dt", "th", "span"), value_tags: tuple[str, ...] = ("div", "dd", "td", "p")) -> dict:
    """Heading (native title, and English after " =") and the values that follow labels."""
    parser = _Labels()
    parser.feed(html or "")
    parser.close()
    heading = next((t for tag, _, t in parser.blocks if tag in ("h1", "h2", "h3") and t), "")
    native, _, english = heading.partition("\n=") if "\n=" in heading else heading.partition("\n =")
    found, label = {}, None
    for tag, _, text in parser.blocks:
        if tag in label_tags and text:
            label = text.rstrip(":：")
        elif tag in value_tags and label and text:
            found.setdefault(label, text)
            label = None
    return {"title": native.strip(), "title_en": english.strip(), "fields": found}


@F.pandas_udf(DETAIL)
def detail(html: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([detail_of(h) for h in html], columns=["title", "title_en", "fields"])


def first_of_each(items: Column, field: str) -> Column:
    """Of structs that share a field's value the first, in order."""
    keys = F.transform(items, lambda x: x[field])
    return F.filter(items, lambda x, i: F.array_position(keys, x[field]) == i + 1)


#: Numbers of volumes and issues, which are no years.
ISSUE_NUMBERS = r"(?i)(?<![a-z])(?:vol|no)\.?\s*[0-9]+|제\s*[0-9]+\s*[권호]"


def issue_links(anchors: Column, key: str = "v_control_no") -> Column:
    """Anchors that carry an issue's id in href or else in onclick, each id once: id, volume, issue, year (a volume's or issue's number is none), text."""
    address = lambda a: F.when(F.contains(a["href"], F.lit(key)), a["href"]).otherwise(a["onclick"])
    found = lambda c, p: F.regexp_extract(c, p, 1)
    own = F.filter(anchors, lambda a: address(a).rlike(rf"{key}\W+[0-9A-Za-z]"))
    return first_of_each(F.transform(own, lambda a: F.struct(found(address(a), rf"{key}\W+([0-9A-Za-z]+)").alias("id"), found(a["text"], r"[Vv]ol\.?\s*([0-9]+)").alias("volume"), found(a["text"], r"[Nn]o\.?\s*([0-9]+)").alias("issue"), found(F.regexp_replace(a["text"], ISSUE_NUMBERS, " "), r"((?:19|20)[0-9]{2})").alias("year"), a["text"].alias("text"))), "id")


def volume_links(anchors: Column, pattern: str = r"/(\d+)/(\d+)/_contents", first_year: int = 1952) -> Column:
    """Issues whose volume and number stand in the address, each once, by volume and issue; issue 0 leads elsewhere; the year follows from the volume."""
    numbers = lambda a: F.struct(F.regexp_extract(a["href"], pattern, 1).try_cast("int").alias("volume"), F.regexp_extract(a["href"], pattern, 2).try_cast("int").alias("issue"))
    issues = F.array_sort(F.array_distinct(F.filter(F.transform(anchors, numbers), lambda x: x["issue"] > 0)))
    return F.transform(issues, lambda x: F.struct(x["volume"].alias("volume"), x["issue"].alias("issue"), (x["volume"] + first_year - 1).alias("year")))


#: Addresses of recommended articles, which belong to other journals.
RECOMMENDED = ("/recommender/", "click.do")


def is_recommended(url: Column) -> Column:
    return F.coalesce(F.contains(url, F.lit(RECOMMENDED[0])), F.lit(False))


def article_links(anchors: Column, own: str, foreign: tuple[str, ...] = RECOMMENDED, shortest: int = 2, id_pattern: str = r"control_no=([a-f0-9]+)") -> Column:
    """Anchors to articles, each id once: not recommendations, with a title; id is empty where the address has none."""
    good = F.filter(anchors, lambda a: F.contains(a["href"], F.lit(own)) & ~F.exists(F.array(*map(F.lit, foreign)), lambda f: F.contains(a["href"], f)) & (F.length(a["text"]) >= shortest))
    return F.transform(good, lambda a: F.struct(F.regexp_extract(a["href"], id_pattern, 1).alias("id"), a["href"].alias("href"), a["text"].alias("text")))


def journal_page_ok(html: Column, key: str = "v_control_no") -> Column:
    """Whether a page lists a journal's issues: an issue's id, or a year as an element's whole text."""
    return F.coalesce(F.contains(html, F.lit(key)) | html.rlike(r">\s*(?:19|20)[0-9]{2}\s*<"), F.lit(False))


def issue_page_ok(anchors: Column, own: str = "p_mat_type=1a0202") -> Column:
    """Whether a page lists an issue's articles."""
    return F.coalesce(F.exists(anchors, lambda a: F.contains(a["href"], F.lit(own))), F.lit(False))


class _Tree(HTMLParser):
    """Elements with their ancestors and whole text, in the order in which they begin."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.open, self.elements = [], []

    def handle_starttag(self, tag, attrs):
        node = {"tag": tag, "attrs": {k: v or "" for k, v in attrs}, "up": list(self.open), "text": []}
        self.elements.append(node)
        if tag not in VOID:
            self.open.append(node)

    def handle_endtag(self, tag):
        for i in range(len(self.open) - 1, -1, -1):
            if self.open[i]["tag"] == tag:
                del self.open[i:]
                break

    def handle_data(self, data):
        for node in self.open:
            node["text"].append(data)


STEP = re.compile(r"(?P<tag>[a-z][a-z0-9]*)?(?P<rest>(?:[.#][\w-]+|\[[\w-]+\*?=['\"]?[^'\"\]]*['\"]?\])*)$")
PIECE = re.compile(r"([.#])([\w-]+)|\[([\w-]+)(\*?)=['\"]?([^'\"\]]*)['\"]?\]")


def _fits(node: dict, step: str) -> bool:
    m = STEP.match(step)
    if not m:
        raise ValueError(f"can't read the selector {step!r}")
    if m["tag"] and m["tag"] != node["tag"]:
        return False
    for mark, name, key, part, value in PIECE.findall(m["rest"]):
        own = node["attrs"].get("class" if mark == "." else "id" if mark == "#" else key, "")
        if not (name in own.split() if mark == "." else name == own if mark == "#" else value in own if part else value == own):
            return False
    return True


def elements_of(html: str | None, selector: str) -> list[str]:
    """Texts of the elements that a selector names: tag, .class, #id, [key=value] and [key*=value], with spaces for descent."""
    tree = _Tree()
    tree.feed(html or "")
    tree.close()
    *above, last = selector.split()

    def under(node: dict, steps: list[str]) -> bool:
        at = len(node["up"])
        for step in reversed(steps):
            at = next((i for i in range(at - 1, -1, -1) if _fits(node["up"][i], step)), -1)
            if at < 0:
                return False
        return True

    return [" ".join("".join(n["text"]).split()) for n in tree.elements if _fits(n, last) and under(n, above)]


def first_selected(html: Column, selectors: list[str], longer_than: int = 0) -> Column:
    """The first text longer than that of the first selector that has one; null without."""

    @F.pandas_udf(T.StringType())
    def pick(pages: pd.Series) -> pd.Series:
        def one(page):
            return next((t for s in selectors for t in elements_of(page, s) if len(t) > longer_than), None)

        return pages.map(one)

    return pick(html)


ITEM = T.StructType([T.StructField(n, T.StringType()) for n in ("id", "title", "start_page", "end_page")] + [T.StructField("authors", T.ArrayType(T.StringType()))])
#: A name in CJK or kana, what no name holds, and pages, in items of a library's list.
ITEM_NAME, NO_NAME, ITEM_PAGES = re.compile("[一-鿿゠-ヿ]"), re.compile("[（(]|年|巻|号|通号"), re.compile(r"p\.?\s*(\d+)(?:\s*[-–]\s*(\d+))?")


class _Items(HTMLParser):
    """Blocks of one class, each with its first link of another class and its pieces of text."""

    def __init__(self, block: str, link: str):
        super().__init__(convert_charrefs=True)
        self.block, self.link, self.depth, self.items, self.in_link = block, link, 0, [], False

    def handle_starttag(self, tag, attrs):
        own = dict(attrs)
        kinds = (own.get("class") or "").split()
        if not self.depth and self.block in kinds:
            self.items.append({"href": None, "title": [], "parts": []})
            self.depth = 1
        elif self.depth and tag not in VOID:
            self.depth += 1
        if self.depth and tag == "a" and self.link in kinds and self.items[-1]["href"] is None:
            self.items[-1]["href"], self.in_link = own.get("href") or "", True

    def handle_endtag(self, tag):
        self.in_link = self.in_link and tag != "a"
        self.depth = max(0, self.depth - 1)

    def handle_data(self, data):
        if self.depth and data.strip():
            self.items[-1]["parts"].append(data.strip())
            if self.in_link:
                self.items[-1]["title"].append(data.strip())


def items_of(html: str | None, block: str, link: str, id_pattern: str) -> list[dict]:
    parser, out, seen = _Items(block, link), [], set()
    parser.feed(html or "")
    parser.close()
    for item in parser.items:
        id_, title = re.search(id_pattern, item["href"] or ""), "".join(item["title"])
        if not id_ or id_[1] in seen or len(title) < 2:
            continue
        seen.add(id_[1])
        pages, names = None, []
        for part in (p.strip() for x in item["parts"] for p in x.split("|")):
            if part == title:
                continue
            if at := ITEM_PAGES.search(part):
                pages = at
            elif 2 <= len(part) <= 15 and ITEM_NAME.search(part) and not NO_NAME.search(part):
                names.append(part)
        out.append({"id": id_[1], "title": title, "start_page": pages[1] if pages else "", "end_page": pages[2] or "" if pages else "", "authors": list(dict.fromkeys(names))})
    return out


def library_items(html: Column, block: str = "pages-books-section-index-item-split", link: str = "lang-link", id_pattern: str = r"/(R000000004-I\w+)") -> Column:
    """Articles of a library's list, each id once: id, title, pages, and as authors short pieces in CJK that are no numbering."""

    @F.pandas_udf(T.ArrayType(ITEM))
    def items(pages: pd.Series) -> pd.Series:
        return pages.map(lambda h: items_of(h, block, link, id_pattern))

    return items(html)


def page_problem(html: Column, title: Column, phrases: list[str], wide_phrases: list[str] = (), short: int = 200, long: int = 15000) -> Column:
    """Why a page isn't what was asked for: empty, short or a notice of blocking; null for a good one."""
    head = F.lower(F.concat_ws(" ", title, F.left(html, F.lit(6000))))
    says = lambda words: F.coalesce(F.array_max(F.array(*[F.contains(head, F.lit(w.lower())) for w in words])), F.lit(False)) if words else F.lit(False)
    return F.when(F.coalesce(F.length(html), F.lit(0)) == 0, "empty").when(F.length(html) < short, "short").when(says(phrases), "blocked").when((F.length(html) < long) & says(list(wide_phrases)), "blocked")


def detail_problem(title: Column, wanted: Column, similarity: Column, url_ok: Column, journal: Column, expected_journal: Column, year: Column, this_year: Column) -> Column:
    """The first rule that a detail page breaks; null if none."""
    folded, other = F.regexp_replace(F.lower(journal), r"\s", ""), F.regexp_replace(F.lower(expected_journal), r"\s", "")
    return (
        F.when(~url_ok, "url")
        .when(F.trim(F.coalesce(title, F.lit(""))) == "", "title missing")
        .when(similarity < 0.45, "title differs")
        .when(~(F.contains(folded, other) | F.contains(other, folded)), "journal differs")
        .when(~year.between(F.lit(1945), this_year + 1), "year")
    )


def slice_by_count(native: Column, meta: Column) -> Column:
    """As many native names as the metadata lists, one at least."""
    return F.slice(native, F.lit(1), F.greatest(F.size(meta), F.lit(1)))
