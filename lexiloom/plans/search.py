"""Search: a small query language over record columns, as one predicate that Catalyst optimises.

Spaces mean and, | or, a leading - not, quotes a phrase that ignores white space, and
``field:`` restricts a term.  And binds tighter than or.  Terms are matched without regard to case.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.linguistic import match_title, title_similarity

_TOKEN = re.compile(r'(?P<bar>\|)|(?P<not>-)?(?:(?P<field>\w+):)?(?:"(?P<phrase>[^"]*)"|(?P<word>[^\s|"]+))')


@dataclass(frozen=True)
class Term:
    text: str
    phrase: bool = False
    field: str | None = None
    negated: bool = False


def parse(query: str, fields: set[str] | None = None) -> list[list[Term]]:
    """Alternatives, each a list of terms that must all hold; unknown field names are part of the word."""
    out: list[list[Term]] = [[]]
    for m in _TOKEN.finditer(query):
        if m["bar"]:
            out.append([])
            continue
        name, text = m["field"], m["phrase"] if m["phrase"] is not None else m["word"]
        if name and fields is not None and name not in fields:
            name, text = None, f"{name}:{text}"
        if text:
            out[-1].append(Term(text.lower(), m["phrase"] is not None, name, bool(m["not"])))
    return [terms for terms in out if terms]


@dataclass
class Searcher:
    """fields: name to column (a string, or an array, whose elements are joined)."""

    fields: dict[str, Column]
    default: list[str] = field(default_factory=list)
    expand: dict[str, list[str]] = field(default_factory=dict)  # a term's other spellings

    def _holds(self, term: Term) -> Column:
        names = [term.field] if term.field else self.default or list(self.fields)
        hay = F.lower(F.concat_ws(" ", *[self.fields[n] for n in names]))
        if term.phrase:
            hay = F.regexp_replace(hay, r"\s+", "")
        found = None
        for spelling in [term.text, *self.expand.get(term.text, [])]:
            needle = re.sub(r"\s+", "", spelling) if term.phrase else spelling
            one = F.contains(hay, F.lit(needle))
            found = one if found is None else found | one
        return ~found if term.negated else found

    def predicate(self, query: str) -> Column:
        any_ = None
        for terms in parse(query, set(self.fields)):
            all_ = None
            for t in terms:
                all_ = self._holds(t) if all_ is None else all_ & self._holds(t)
            any_ = all_ if any_ is None else any_ | all_
        return F.lit(True) if any_ is None else any_

    def search(self, df: DataFrame, query: str) -> DataFrame:
        return df.filter(self.predicate(query))


def snippet(text: Column, term: str, around: int = 20, mark: str = "**") -> Column:
    """The text around the first place of a term, the term marked; empty without it."""
    at = F.locate(term.lower(), F.lower(text))
    start = F.greatest(at - around, F.lit(1))
    part = lambda a, n: F.substring(text, a, n)
    n = F.lit(len(term))
    return F.when(at == 0, "").otherwise(F.concat(part(start, at - start), F.lit(mark), part(at, n), F.lit(mark), part(at + n, F.lit(around))))


def suggestions(df: DataFrame, column: str, term: str, k: int = 5, most: int = 3) -> DataFrame:
    """If no value holds the term: the k nearest values by edit distance."""
    t = F.lit(term.lower())
    exact = df.filter(F.contains(F.lower(column), t)).limit(1).select(F.lit(1).alias("_hit"))
    near = df.select(column, F.levenshtein(F.lower(column), t, most).alias("distance")).filter("distance >= 0").distinct()
    return near.join(F.broadcast(exact), F.lit(True), "left_anti").orderBy("distance", column).limit(k)


def similar_values(df: DataFrame, column: str, term: str, k: int = 5, least: float = 0.5) -> DataFrame:
    """If no value holds the term: the k values whose folded titles are most alike, with their similarity."""
    exact = df.filter(F.contains(F.lower(column), F.lit(term.lower()))).limit(1).select(F.lit(1).alias("_hit"))
    values = df.select(column).distinct().withColumn("_own", match_title(F.col(column))).withColumn("_term", match_title(F.lit(term)))
    alike = title_similarity(F.col("_own"), F.col("_term"))
    order = [F.desc("similarity"), F.col(column)]
    near = values.select(column, F.round(alike, 6).alias("similarity")).orderBy(*order).limit(k).filter(F.col("similarity") >= least)
    return near.join(F.broadcast(exact), F.lit(True), "left_anti").orderBy(*order)


def decade(year: Column) -> Column:
    return F.floor(year / 10) * 10


def url_state(url: Column) -> Column:
    """The parameters of a link as a map of decoded strings; empty without any."""
    pairs = F.filter(F.split(F.coalesce(F.regexp_extract(url, r"\?([^#]*)", 1), F.lit("")), "&"), lambda p: F.contains(p, F.lit("=")))
    entry = lambda p: F.struct(F.url_decode(F.substring_index(p, "=", 1)), F.url_decode(F.regexp_replace(p, "^[^=]*=", "")))
    return F.map_from_entries(F.transform(pairs, entry))


def state_url(base: str, names: list[str], *values: Column) -> Column:
    """The link that keeps a search: parameters in the order of their names, those without a value left out."""
    pairs = [F.when(F.coalesce(v, F.lit("")) != "", F.concat(F.lit(f"{n}="), F.url_encode(v))) for n, v in sorted(zip(names, values), key=lambda x: x[0])]
    return F.concat_ws("?", F.lit(base), F.nullif(F.concat_ws("&", *pairs), F.lit("")))


def to_query_string(state: dict[str, str]) -> str:
    from urllib.parse import urlencode

    return urlencode(sorted(state.items()))


def from_query_string(text: str) -> dict[str, str]:
    from urllib.parse import parse_qsl

    return dict(parse_qsl(text.lstrip("?")))
