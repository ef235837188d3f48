"""Scalar column functions on titles, numbers, names and links; all of them built-in expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

NOT_ALNUM = r"[^\p{L}\p{M}\p{N}]"


def blank_to_null(c: Column) -> Column:
    """Empty and blank strings count as missing."""
    return F.nullif(F.trim(c), F.lit(""))


def fold_title(c: Column, marks: bool = True) -> Column:
    """Lower case, letters, marks (if wanted) and digits only; a title written twice in a row (even length, 8 at least) once."""
    flat = F.regexp_replace(F.lower(c), NOT_ALNUM if marks else r"[^\p{L}\p{N}]", "")
    half = (F.length(flat) / 2).cast("int")
    twice = (F.length(flat) >= 8) & (F.length(flat) % 2 == 0) & (F.left(flat, half) == F.right(flat, half))
    return F.when(twice, F.left(flat, half)).otherwise(flat)


def clean_title(c: Column) -> Column:
    """Single spaces, no trailing asterisks."""
    return F.trim(F.regexp_replace(F.trim(F.regexp_replace(c, r"\s+", " ")), r"\*+$", ""))


def strip_punctuation(c: Column) -> Column:
    return F.regexp_replace(F.lower(c), r"[\p{P}\p{S}\s]+", "")


def numbers(*columns: Column) -> Column:
    """The distinct positive integers of some numbering columns, ascending ("10-11" has two)."""
    found = F.flatten(F.array(*[F.regexp_extract_all(F.coalesce(c, F.lit("")), F.lit(r"([0-9]+)"), F.lit(1)) for c in columns]))
    return F.array_sort(F.array_distinct(F.filter(F.transform(found, lambda x: x.try_cast("int")), lambda n: n > 0)))


def numbers_key(*columns: Column) -> Column:
    return F.array_join(numbers(*columns).cast("array<string>"), ",")


def year_of(c: Column) -> Column:
    """The first four characters as a number, else 0."""
    return F.coalesce(F.when(F.substring(c, 1, 4).rlike("^[0-9]{4}$"), F.substring(c, 1, 4).try_cast("int")), F.lit(0))


def first_number(c: Column) -> Column:
    return F.nullif(F.regexp_extract(c, "([0-9]+)", 1), F.lit("")).try_cast("int")


def ascii_share(c: Column) -> Column:
    return F.try_divide(F.length(F.regexp_replace(c, r"[^\x00-\x7F]", "")), F.length(c))


def tail_of(c: Column, separator: str = " : ") -> Column:
    """What follows the last separator; the whole without one."""
    return F.element_at(F.split(c, separator), -1)


def clean_affiliation(c: Column) -> Column:
    return F.trim(F.regexp_replace(F.regexp_replace(F.regexp_replace(c, r"\s+", " "), r"^[ ;,()]+", ""), r"[ ;,()]+$", ""))


def fallback_id(prefix: str, width: int, *columns: Column) -> Column:
    """An id from the content where a source gives none."""
    return F.concat(F.lit(prefix), F.left(F.md5(F.concat_ws("", *columns).cast("binary")), F.lit(width)))


def strip_tags(c: Column) -> Column:
    return F.trim(F.regexp_replace(F.regexp_replace(c, r"<[^>]*>", " "), r"\s+", " "))


def bump_token(c: Column, step: int = 100) -> Column:
    """a:b:100:N with N advanced by a page."""
    parts = F.split(c, ":")
    return F.concat_ws(":", F.slice(parts, F.lit(1), F.size(parts) - 1), (F.element_at(parts, -1).try_cast("bigint") + step).cast("string"))


def split_names(c: Column, low: int = 2, high: int = 20) -> Column:
    """Names between commas, semicolons or ideographic commas, within length bounds."""
    return F.filter(F.transform(F.split(c, "[,;、]"), lambda x: F.trim(x)), lambda x: F.length(x).between(low, high))


def alias_key(c: Column) -> Column:
    """Journal names for comparison: no brackets' contents, punctuation, case or the word "and"."""
    return F.regexp_replace(F.regexp_replace(F.lower(F.regexp_replace(c, r"[(\[][^)\]]*[)\]]", "")), r"\band\b", ""), NOT_ALNUM, "")


def longest_words(c: Column, k: int = 2) -> Column:
    """The k longest distinct words, longer first, then by the alphabet."""
    words = F.array_distinct(F.filter(F.split(c, r"[^\p{L}\p{N}]+"), lambda w: w != ""))
    keyed = F.array_sort(F.transform(words, lambda w: F.struct((-F.length(w)).alias("n"), w.alias("w"))))
    return F.transform(F.slice(keyed, F.lit(1), F.lit(k)), lambda x: x["w"])


def canonical_json(*columns: str) -> Column:
    return F.to_json(F.struct(*sorted(columns)))
