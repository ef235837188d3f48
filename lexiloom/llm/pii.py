"""Personal data by fixed forms and bootstrapped contextual extraction.

Base forms (e-mail, ip, card, phone) are matched exactly.  Beside them, every identifier-like run of a text is an
instance: a phone number's or card number's form, or a token of six characters or more with a digit or one of
``@._%+`` within.  Instances that are surely of a kind are seeds: those valid as one of the four base kinds,
and, as secrets, runs of 32 hexadecimal digits or more in which all sixteen occur.  Only the words around an instance
are its patterns: the one, two and three words before it, and the words before and after it;
what it looks like is none.  Instances and patterns form a graph: a pattern's confidence for a kind is the sum of its
distinct instances' scores over their number and one, and an instance that isn't a seed scores the best of its
patterns.  After ``ROUNDS`` rounds, instances that reach ``CONFIDENT`` by a pattern of ``SUPPORT`` instances or more are
spans of their own (``ctx_card``, ``ctx_secret`` and so on), wherever they occur.  Unsure instances take on what the sure ones
beside them say, so confidence nears the share of a kind among a pattern's seeds; as the rounds
are few, a pattern with less than about a sixth of seeds doesn't get there.

All of it is DataFrame functions.  Spark tells what a regular expression matched but not where, so a text is also split
by the expression and lengths are summed within the row; texts and matches never move for it.  Seeds count
once, in one aggregate by pattern; the rounds join only what isn't a seed.  Pattern words
are read from the whole stretch between two instances; a neighbouring instance stands for one word.
Expressions are possessive or bounded by look-behinds that don't change the matches, and prefix
sums run in blocks, so long texts cost linear time and no deep recursion.

Cases: a null text is empty and has no spans; repeated rows get their spans each; rows with a null id are
treated like others; an empty table gives no rows; other columns are not read by ``found`` and kept by ``redacted``.
Two kinds of equal score: the one listed first.  Offsets are code points, ends exclusive.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import written

KINDS = ("email", "ip", "card", "phone")
SEEDED = (*KINDS, "secret")
FORMS = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?=(?:[\x20-]?[0-9]){15})(?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
TOKEN = r"(?<![A-Za-z0-9@._%+-])(?=[A-Za-z-]*+[0-9]|[A-Za-z-]++[@._%+][@._%+-]*+[A-Za-z0-9])[A-Za-z0-9][A-Za-z0-9@._%+-]{4,}[A-Za-z0-9]"
INSTANCE = f"{FORMS['phone']}|{FORMS['card']}|{TOKEN}"
NEEDS = {"email": "@", "ip": ".", "phone": "+"}  # a text without this has no match
ROUNDS, CONFIDENT, SUPPORT = 10, 0.8, 5
SALTS = 16
STEP = 64  # elements of a block of prefix sums
PIECE = 4096  # code points of a block of a text that is put together again
_PART = r"0*(?:[0-9]|[1-9][0-9]|1[0-9][0-9]|2[0-4][0-9]|25[0-5])"
SPAN = "array<struct<rank:int,start:bigint,end:bigint>>"


def _let(value: Column, body) -> Column:
    """The body for a value that is worked out once."""
    return F.get(F.transform(F.array(value), body), 0)


def running(values: Column, op, zero: Column) -> Column:
    """For each place of an array, ``op`` over the elements up to it; in blocks, so that it isn't quadratic."""

    def blocks(own: Column) -> Column:
        sums = F.transform(F.sequence(F.lit(0), F.floor((F.size(own) - 1) / STEP).cast("int")), lambda b: F.aggregate(F.slice(own, b * STEP + 1, F.lit(STEP)), zero, op))
        return _let(sums, lambda s: _let(F.transform(s, lambda _, b: F.aggregate(F.slice(s, F.lit(1), b), zero, op)), lambda before: spread(own, before)))

    def spread(own: Column, before: Column) -> Column:
        return F.transform(own, lambda _, i: op(F.get(before, F.floor(i / STEP).cast("int")), F.aggregate(F.slice(own, i - i % STEP + 1, i % STEP + 1), zero, op)))

    return _let(values, lambda own: F.when(F.size(own) > 0, blocks(own)).otherwise(own))


def _more(a: Column, b: Column) -> Column:
    return F.greatest(a, b)


def _less(a: Column, b: Column) -> Column:
    return F.least(a, b)


def _luhn(digits: Column) -> Column:
    number = lambda i: F.substring(F.reverse(digits), i, F.lit(1)).cast("int")
    double = lambda v: v * 2 - F.when(v > 4, 9).otherwise(0)
    total = F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), lambda a, i: a + F.when(i % 2 == 0, double(number(i))).otherwise(number(i)))
    return F.when(F.length(digits).between(16, 19), total % 10 == 0).otherwise(False)


def valid(kind: str, match: Column) -> Column:
    """Whether a match of a kind's form passes its check."""
    digits = F.regexp_replace(match, "[^0-9]", "")
    return {"email": F.lit(True), "ip": match.rlike(rf"\A{_PART}(?:\.{_PART}){{3}}\z"), "card": _luhn(digits), "phone": F.length(digits).between(8, 15)}[kind]


def seed_kind(match: Column) -> Column:
    """Place in SEEDED of the kind that an instance surely is of, or null."""
    sure = {
        "email": match.rlike(r"\A[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++\z"),
        "ip": valid("ip", match),
        "card": match.rlike(r"\A[0-9](?:[\x20-]?[0-9])++\z") & valid("card", match),
        "phone": match.startswith("+") & valid("phone", match),
        "secret": match.rlike(r"\A[0-9A-Fa-f]{32,}+\z") & (F.size(F.array_distinct(F.split(F.lower(match), ""))) == 16),
    }
    return F.coalesce(*[F.when(sure[k], F.lit(i)) for i, k in enumerate(SEEDED)])


def _placed(form: str, found: str) -> Column:
    """Array of (part, match, after, end) of the matches of a form in ``_text``: the stretches beside each and where it ends."""

    def ends(parts: Column) -> Column:
        zipped = F.zip_with(F.col(found), F.slice(parts, F.lit(1), F.size(found)), lambda m, p: F.struct(p.alias("part"), m.alias("match")))
        return _let(zipped, lambda z: _let(running(F.transform(z, lambda x: (F.length(x["part"]) + F.length(x["match"])).cast("long")), lambda a, b: a + b, F.lit(0).cast("long")), lambda e: F.transform(z, lambda x, i: F.struct(x["part"].alias("part"), x["match"].alias("match"), F.get(parts, i + 1).alias("after"), F.get(e, i).alias("end")))))

    return _let(F.split("_text", form, -1), ends)


def _base(kind: str) -> Column:
    """Valid spans of a base kind."""
    rank = KINDS.index(kind)
    good = F.filter(_placed(FORMS[kind], f"_{kind}"), lambda x: valid(kind, x["match"]))
    span = lambda x: F.struct(F.lit(rank).alias("rank"), (x["end"] - F.length(x["match"])).alias("start"), x["end"].alias("end"))
    return F.when(F.size(f"_{kind}") > 0, F.transform(good, span)).otherwise(F.array().cast(SPAN))


def _word(text: Column) -> Column:
    return F.lower(F.regexp_replace(text, "[0-9]", "0"))


def _instances() -> Column:
    """Array of (start, end, match, seed, one, two, three, next): instances with the words before and after, null where there are none."""
    blank = lambda c: F.translate(c, "\t\n\x0b\f\r", "     ")
    last = lambda c: F.nullif(F.substring_index(c, " ", -1), F.lit(""))
    short = lambda c, w: F.rtrim(F.left(c, F.length(c) - F.coalesce(F.length(w), F.lit(0))))

    def one(x: Column, i: Column) -> Column:
        before = F.rtrim(F.concat(F.when(i > 0, F.lit("<id> ")).otherwise(F.lit("")), blank(x["part"])))
        after = F.ltrim(blank(x["after"]))
        return _let(before, lambda b: _let(short(b, last(b)), lambda c: _let(short(c, last(c)), lambda d: F.struct(
            (x["end"] - F.length(x["match"])).alias("start"), x["end"].alias("end"), x["match"].alias("match"), seed_kind(x["match"]).alias("seed"),
            _word(last(b)).alias("one"), _word(last(c)).alias("two"), _word(last(d)).alias("three"), _word(F.nullif(F.substring_index(after, " ", 1), F.lit(""))).alias("next")))))

    none = F.array().cast("array<struct<start:bigint,end:bigint,match:string,seed:int,one:string,two:string,three:string,next:string>>")
    return F.when(F.size("_instance") > 0, F.transform(_placed(INSTANCE, "_instance"), one)).otherwise(none)


def scanned(docs: DataFrame, keep: tuple[str, ...], text_col: str) -> DataFrame:
    """_row, keep..., base (valid spans of the base kinds, in order) and instances of each text; written once."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(F.monotonically_increasing_id().alias("_row"), *keep, text.alias("_text"))

    def matches(kind: str, form: str) -> Column:
        found = F.regexp_extract_all("_text", F.lit(form), F.lit(0))
        if kind in NEEDS:
            found = F.when(F.contains("_text", F.lit(NEEDS[kind])), found).otherwise(F.array().cast("array<string>"))
        return found.alias(f"_{kind}")

    rows = rows.select("_row", *keep, "_text", *[matches(k, f) for k, f in (FORMS | {"instance": INSTANCE}).items()])
    return written(rows.select("_row", *keep, F.concat(*[_base(k) for k in KINDS]).alias("base"), _instances().alias("instances")), "scanned")


def patterns() -> Column:
    """The patterns of an instance by the words around it (columns one, two, three, next)."""
    one, two, three = F.col("one"), F.col("two"), F.col("three")
    made = F.array(F.concat(F.lit("1:"), one), F.concat(F.lit("2:"), two, F.lit(" "), one), F.concat(F.lit("3:"), three, F.lit(" "), two, F.lit(" "), one), F.concat(F.lit("4:"), one, F.lit(" _ "), F.col("next")))
    return F.filter(made, lambda p: p.isNotNull())


def scored(occurrences: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """instance, found (place in SEEDED): instances (rows of match, seed, one, two, three, next) that only patterns tell."""
    edges = written(occurrences.select(F.explode(patterns()).alias("pattern"), F.col("match").alias("instance"), "seed").distinct(), "edges")
    seeds = [F.count_if(F.col("seed") == i).cast("double").alias(f"s_{k}") for i, k in enumerate(SEEDED)]
    wide = edges.groupBy("pattern").agg(F.count(F.lit(1)).alias("n"), *seeds).filter(F.col("n") >= SUPPORT)
    # A pattern without a single seed gains from no round before one of its instances does, so all wide ones stay in.
    wide = written(wide.withColumnRenamed("pattern", "of"), "wide")
    # A pattern of very many instances is dealt by instance into SALTS parts; the patterns' side, one row each, is repeated for it.
    salt, each = F.pmod(F.xxhash64("instance"), F.lit(SALTS)).cast("int").alias("salt"), F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("part")
    met = (F.col("pattern") == F.col("of")) & (F.col("salt") == F.col("part"))
    own = written(edges.filter("seed is null").select("pattern", "instance", salt).join(wide.select("of", each), met, "left_semi"), "unsure")
    known = None
    for _ in range(rounds):
        if known is None:
            gained = wide.select("of", "n", *[F.col(f"s_{k}").alias(k) for k in SEEDED])
        else:
            sums = own.join(known, "instance").groupBy("pattern").agg(*[F.sum(k).alias(f"g_{k}") for k in SEEDED])
            gained = wide.join(sums, F.col("of") == F.col("pattern"), "left").select("of", "n", *[(F.col(f"s_{k}") + F.coalesce(f"g_{k}", F.lit(0.0))).alias(k) for k in SEEDED])
        confidence = gained.select("of", *[(F.col(k) / (F.col("n") + 1)).alias(k) for k in SEEDED]).filter(F.greatest(*SEEDED) > 0).select("*", each)
        known = written(own.join(confidence, met).groupBy("instance").agg(*[F.max(k).alias(k) for k in SEEDED]), "scores")
    top = F.greatest(*SEEDED)
    found = F.coalesce(*[F.when(F.col(k) == top, F.lit(i)) for i, k in enumerate(SEEDED)])
    return known.filter(top >= CONFIDENT).select("instance", found.alias("found"))


def discovered(rows: DataFrame) -> DataFrame:
    """_of, more: the spans of each row of ``scanned`` that seeds of no base kind and discovered instances add; written once."""
    every = rows.select("_row", F.explode("instances").alias("i")).select("_row", "i.*")
    found = scored(every.select("match", "seed", "one", "two", "three", "next")).withColumnRenamed("instance", "known")
    unsure = every.filter("seed is null").join(found, F.col("match") == F.col("known")).select("_row", "found", "start", "end")
    secret = every.filter(F.col("seed") >= len(KINDS)).select("_row", F.col("seed").alias("found"), "start", "end")
    spans = unsure.union(secret).select("_row", F.struct(F.col("found").cast("int").alias("rank"), "start", "end").alias("span"))
    return written(spans.groupBy(F.col("_row").alias("_of")).agg(F.sort_array(F.collect_list("span")).alias("more")), "discovered")


def spans(docs: DataFrame, keep: tuple[str, ...] = ("doc_id",), text_col: str = "text") -> DataFrame:
    """keep..., base and more: arrays of (rank, start, end), rank the place of the kind in SEEDED; more has the found ones."""
    rows = scanned(docs, keep, text_col)
    more = discovered(rows)  # one row for each text with such spans; Spark broadcasts it only where the file is small
    return rows.join(more, F.col("_row") == F.col("_of"), "left").select(*keep, "base", F.coalesce("more", F.array().cast(SPAN)).alias("more"))


def _by_start(items: Column) -> Column:
    return F.transform(F.sort_array(F.transform(items, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["rank"].alias("rank")))), lambda s: s)


def _fresh(base: Column, more: Column) -> Column:
    """Those of ``more`` that meet no span of ``base``."""
    far = F.lit(1 << 62).cast("long")
    at = lambda b, m: _by_start(F.concat(F.transform(b, lambda s: F.struct((s["rank"] - 100).alias("rank"), s["start"].alias("start"), s["end"].alias("end"))), m))

    def kept(every: Column) -> Column:
        ends = running(F.transform(every, lambda s: F.when(s["rank"] < 0, s["end"]).otherwise(F.lit(0).cast("long"))), _more, F.lit(0).cast("long"))
        begins = F.reverse(running(F.reverse(F.transform(every, lambda s: F.when(s["rank"] < 0, s["start"]).otherwise(far))), _less, far))
        return _let(ends, lambda e: _let(begins, lambda b: F.filter(every, lambda s, i: (s["rank"] >= 0) & (F.get(e, i) <= s["start"]) & (F.get(b, i) >= s["end"]))))

    free = F.sort_array(F.transform(_let(at(base, more), kept), lambda s: F.struct(s["rank"].alias("rank"), s["start"].alias("start"), s["end"].alias("end"))))
    return F.when((F.size(base) == 0) | (F.size(more) == 0), more).otherwise(free)


def _said(items: Column, prefix: str = "") -> Column:
    names = F.array(*[F.lit(prefix + k) for k in SEEDED])
    return F.transform(items, lambda s: F.concat_ws(":", F.get(names, s["rank"]), s["start"].cast("string"), s["end"].cast("string")))


def found(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_found; found spans, clear of base ones, are of kinds such as ctx_card."""
    rows = spans(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("_source")), ("doc_id",), "_source")
    of_kind = lambda i: F.size(F.filter("base", lambda s: s["rank"] == i)).cast("long")
    counts = [of_kind(i).alias(f"n_{k}") for i, k in enumerate(KINDS)]
    rows = rows.select("doc_id", *counts, _said(F.col("base")).alias("_base"), _fresh(F.col("base"), F.col("more")).alias("_fresh"))
    said = F.array_join(F.concat("_base", _said(F.col("_fresh"), "ctx_")), ",")
    return rows.select("doc_id", *[f"n_{k}" for k in KINDS], F.sha2(F.array_join("_base", ",").cast("binary"), 256).alias("base_sha256"), said.alias("spans"), F.size("_fresh").cast("long").alias("n_found"))


def _masked(text: Column, spans_: Column) -> Column:
    """The text with each run of overlapping spans replaced by <KIND> of the first."""
    tags = F.array(*[F.lit(f"<{k.upper()}>") for k in SEEDED])
    block = lambda at: F.floor(at / PIECE).cast("int")

    def cut(blocks: Column, a: Column, b: Column) -> Column:
        whole = F.array_join(F.slice(blocks, block(a) + 2, F.greatest(block(b) - block(a) - 1, F.lit(0))), "")
        first, rest = F.get(blocks, block(a)), F.coalesce(F.get(blocks, block(b)), F.lit(""))
        within = F.substring(first, (a % PIECE).cast("int") + 1, (b - a).cast("int"))
        return F.when(a >= b, F.lit("")).when(block(a) == block(b), within).otherwise(F.concat(F.substring(first, (a % PIECE).cast("int") + 1, F.lit(PIECE)), whole, F.substring(rest, F.lit(1), (b % PIECE).cast("int"))))

    def put(every: Column, reach: Column) -> Column:
        # A span that begins at or after all earlier ends begins a run; the run reaches as far as the spans before the next one.
        numbered = F.transform(every, lambda s, i: F.struct(s["start"].alias("start"), s["rank"].alias("rank"), i.alias("i")))
        heads = F.filter(numbered, lambda s: (s["i"] == 0) | (s["start"] >= F.get(reach, s["i"] - 1)))
        return _let(heads, lambda h: _let(F.regexp_extract_all(text, F.lit(rf"(?s).{{1,{PIECE}}}"), F.lit(0)), lambda blocks: joined(h, reach, blocks)))

    def joined(heads: Column, reach: Column, blocks: Column) -> Column:
        before = lambda i: F.when(i == 0, F.lit(0).cast("long")).otherwise(F.get(reach, F.get(heads, i)["i"] - 1))
        pieces = F.transform(heads, lambda s, i: F.concat(cut(blocks, before(i), s["start"]), F.get(tags, s["rank"])))
        return F.concat(F.array_join(pieces, ""), cut(blocks, F.element_at(reach, -1), F.length(text).cast("long")))

    zero = F.lit(0).cast("long")
    return _let(_by_start(spans_), lambda every: _let(running(F.transform(every, lambda s: s["end"]), _more, zero), lambda reach: put(every, reach)))


def redacted(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """The documents with each span, overlapping ones as one, replaced by <KIND>; texts without spans stay as they are (null too)."""
    names = docs.columns
    hidden = {c: f"_c{i}" for i, c in enumerate(names)}
    own = docs.select(*[F.col(f"`{c}`").alias(h) for c, h in hidden.items()])
    text = F.col(hidden[text_col])
    rows = spans(own, tuple(hidden.values()), hidden[text_col])
    every = F.concat("base", "more")
    clean = F.when(F.size(every) > 0, _masked(text.cast("string"), every)).otherwise(text)
    return rows.select(*[(clean if c == text_col else F.col(h)).alias(c) for c, h in hidden.items()])
