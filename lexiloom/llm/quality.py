"""Quality by weak supervision: rules vote good or bad or abstain, and EM weighs the votes.

Each rule looks at one measure of a document.  Votes of the documents are counted by pattern (at most
3 ** rules of them); expectation-maximisation on the counts estimates how often good and bad documents
get each vote from each rule.  Stated beliefs begin it, which settles which class is the good one, and weigh
as much as ``PRIOR`` documents, however many there are; nothing else bounds the estimates.  A
document is kept if its posterior probability of being good is at least 0.5.  ``judged`` also drops what the
base rules fail, and learns from the documents that pass them; ``good_documents`` goes by the posterior
alone and learns from all.  All of it is DataFrame functions; the model that reaches the driver is
3 * rules + 1 numbers.

Cases: a null or empty text has no words, fails the base rules, gets no votes and is kept by neither; repeated rows
are judged each and count each; rows with a null id are judged like others; very long texts are measured whole,
in time in proportion to their length but for a sort of their windows; an empty table gives no rows; other
columns are not read by ``judged``, kept by ``good_documents``, and may have any names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import written

BLANK = r"[\x20\x09-\x0D]"
ROUNDS = 30
PRIOR = 20.0  # documents of either class that the beliefs stand for
# rule: (good votes: bad and good; bad documents: bad and good) as believed at first
BELIEFS = {
    "symbols": (0.004, 0.95, 0.30, 0.65),
    "capitals": (0.004, 0.95, 0.25, 0.70),
    "exclamations": (0.004, 0.95, 0.25, 0.70),
    "lines": (0.004, 0.85, 0.20, 0.75),
    "repeats": (0.004, 0.90, 0.25, 0.70),
    "word_length": (0.004, 0.95, 0.15, 0.75),
    "vocabulary": (0.004, 0.85, 0.20, 0.70),
    "sentences": (0.010, 0.90, 0.20, 0.75),
    "plain": (0.004, 0.95, 0.30, 0.65),
}
BAD_SHARE = 0.15
_MARKS = r"\p{Pd}\p{Ps}\p{Pe}\p{Pi}\p{Pf}.,;:!?\u2026'\"\u3001\u3002\uFF0C\uFF01\uFF1F\uFF1A\uFF1B\u30FB"
PLAIN = rf"\A[{_MARKS}]*+[\p{{L}}\p{{M}}][\p{{L}}\p{{M}}{_MARKS}]*+\z"  # a word of letters and the marks of sentences


def measures(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """doc_id (or the columns of ``keep``) and the measures of each whole text."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    head = [F.col(c) for c in keep] or [F.col(id_col).alias("doc_id")]
    names = list(keep) or ["doc_id"]
    one = docs.select(*head, text.alias("_text"), F.filter(F.split(text, BLANK + "+"), lambda w: w != "").alias("_words"), F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")).alias("_lines"))
    n = F.size("_words")
    windows = F.when(n >= 3, F.transform(F.sequence(F.lit(0), n - 3), lambda i: F.xxhash64(F.get("_words", i), F.get("_words", i + 1), F.get("_words", i + 2)))).otherwise(F.array().cast("array<bigint>"))
    without = lambda chars: F.length("_text") - F.length(F.translate("_text", chars, ""))
    two = one.select(
        *names,
        n.cast("long").alias("n_words"),
        (F.length("_text") - without(" \t\n\x0b\f\r")).cast("long").alias("word_chars"),
        without("#*$%&|<>").cast("long").alias("n_symbols"),
        F.size("_lines").cast("long").alias("n_lines"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        F.size(F.array_distinct("_words")).cast("long").alias("n_distinct"),
        (F.length("_text") - F.length(F.regexp_replace("_text", r"\p{Lu}", ""))).cast("long").alias("n_capitals"),
        without("!").cast("long").alias("n_exclamations"),
        without(".?").cast("long").alias("n_stops"),
        F.size(F.filter("_words", lambda w: w.rlike(PLAIN))).cast("long").alias("n_plain"),
        windows.alias("_windows"),
    )
    three = two.withColumn("_twice", F.size(F.array_distinct("_windows")) < F.size("_windows"))
    # Windows sorted by hash, with their places: those equal to a neighbour occur twice or more.
    order = F.when(F.col("_twice"), F.sort_array(F.transform("_windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))).otherwise(F.array().cast("array<struct<h:bigint,i:int>>"))
    four = three.withColumn("_order", order).drop("_windows")
    again = F.filter("_order", lambda s, k: (s["h"] == F.get(F.col("_order"), k - 1)["h"]) | (s["h"] == F.get(F.col("_order"), k + 1)["h"]))
    covered = F.array_distinct(F.flatten(F.transform(again, lambda s: F.array(s["i"], s["i"] + 1, s["i"] + 2))))
    five = four.withColumn("n_repeat_words", F.when(F.col("_twice"), F.size(covered)).otherwise(F.lit(0)).cast("long"))
    return five.drop("_order", "_twice")


def votes() -> dict[str, Column]:
    """1: good, -1: bad, 0: abstains."""
    words = F.greatest(F.col("n_words"), F.lit(1))
    share = lambda c, of=words: F.col(c) / of
    chars = F.greatest(F.col("word_chars"), F.lit(1))

    def vote(bad: Column, good: Column) -> Column:
        return F.when(F.col("n_words") == 0, F.lit(0)).when(bad, F.lit(-1)).when(good, F.lit(1)).otherwise(F.lit(0))

    mean = F.col("word_chars") / words
    return {
        "symbols": vote(share("n_symbols") >= 0.1, share("n_symbols") <= 0.03),
        "capitals": vote(share("n_capitals", chars) >= 0.4, share("n_capitals", chars) <= 0.15),
        "exclamations": vote(share("n_exclamations") >= 0.3, share("n_exclamations") <= 0.1),
        "lines": vote((F.col("n_dup_lines") >= 3) & (share("n_dup_lines", F.greatest(F.col("n_lines"), F.lit(1))) >= 0.3), F.col("n_dup_lines") == 0),
        "repeats": vote(share("n_repeat_words") >= 0.3, share("n_repeat_words") <= 0.1),
        "word_length": vote((mean < 2.5) | (mean > 14), (mean >= 3) & (mean <= 11)),
        "vocabulary": vote((F.col("n_words") >= 50) & (share("n_distinct") < 0.2), share("n_distinct") >= 0.35),
        "sentences": vote((F.col("n_words") >= 50) & (F.col("n_stops") == 0), (F.col("n_stops") > 0) & (share("n_stops") <= 0.3)),
        "plain": vote(share("n_plain") < 0.7, share("n_plain") >= 0.85),
    }


def fitted(voted: DataFrame, rules: list[str]) -> tuple[list[float], float]:
    """Log ratios good to bad of each rule's votes (bad, none, good), and of the classes, by EM on pattern counts."""
    counts = voted.groupBy(*rules).agg(F.count(F.lit(1)).cast("double").alias("n"))
    marks = F.array(*[F.when(F.col(r) == v, 1.0).otherwise(0.0) for r in rules for v in (-1, 0, 1)])
    patterns = counts.agg(F.collect_list(F.struct(marks.alias("o"), F.col("n"))).alias("patterns"), F.coalesce(F.sum("n"), F.lit(0.0)).alias("total"))  # at most 3 ** rules
    k = 3 * len(rules)
    belief = [BELIEFS[r] for r in rules]
    good = [x for g, p, _, _ in belief for x in (g, 1 - g - p, p)]
    bad = [x for _, _, g, p in belief for x in (g, 1 - g - p, p)]
    array = lambda values: F.array(*[F.lit(float(v)) for v in values])

    def ratio(x: Column) -> Column:
        return F.log(x["g"] / x["b"])

    def step(state: Column, _: Column) -> Column:
        def add(sums: Column, p: Column) -> Column:
            odds = state["base"] + F.aggregate(F.zip_with(p["o"], state["logs"], lambda a, b: a * b), F.lit(0.0), lambda a, b: a + b)
            q = F.lit(1.0) / (F.lit(1.0) + F.exp(-odds))
            mine = F.concat(F.transform(p["o"], lambda x: x * p["n"] * q), F.transform(p["o"], lambda x: x * p["n"] * (1 - q)), F.array(p["n"] * q, p["n"] * (1 - q)))
            return F.zip_with(sums, mine, lambda a, b: a + b)

        sums = F.aggregate("patterns", F.array_repeat(F.lit(0.0), 2 * k + 2), add)

        def renewed(s: Column) -> Column:
            g = F.zip_with(F.slice(s, 1, k), array(good), lambda x, b: (x + PRIOR * b) / (F.element_at(s, 2 * k + 1) + PRIOR))
            b = F.zip_with(F.slice(s, k + 1, k), array(bad), lambda x, b: (x + PRIOR * b) / (F.element_at(s, 2 * k + 2) + PRIOR))
            share = (F.element_at(s, 2 * k + 2) + PRIOR * BAD_SHARE) / (F.col("total") + PRIOR)
            return F.struct(F.transform(F.arrays_zip(g.alias("g"), b.alias("b")), ratio).alias("logs"), F.log((1 - share) / share).alias("base"))

        return F.element_at(F.transform(F.array(sums), renewed), 1)

    first = F.struct(F.transform(F.arrays_zip(array(good).alias("g"), array(bad).alias("b")), ratio).alias("logs"), F.log(F.lit((1 - BAD_SHARE) / BAD_SHARE)).alias("base"))
    model = patterns.select(F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), first, step).alias("m")).first()["m"]  # 3 * rules + 1 numbers
    return list(model["logs"]), float(model["base"])


def judged(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = (), base_rules: bool = True) -> DataFrame:
    """doc_id (or ``keep``), n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, probability."""
    rows = measures(docs, id_col, text_col, keep)
    own = votes()
    failed = (F.col("n_words") < 50) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 50)
    rows = written(rows.withColumns({f"_{r}": v for r, v in own.items()} | {"_failed": failed}), "votes")
    rules = list(own)
    learnt = rows.filter("not _failed") if base_rules else rows
    logs, base = fitted(learnt.select(*[F.col(f"_{r}").alias(r) for r in rules]), rules)
    odds = F.lit(base)
    for i, r in enumerate(rules):
        for j, v in enumerate((-1, 0, 1)):
            odds = odds + F.when(F.col(f"_{r}") == v, F.lit(logs[3 * i + j])).otherwise(F.lit(0.0))
    probability = F.lit(1.0) / (F.lit(1.0) + F.exp(-odds))
    good = (probability >= 0.5) & (F.col("n_words") > 0)
    kept = good & ~F.col("_failed") if base_rules else good
    return rows.select(*(keep or ("doc_id",)), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", F.col("_failed").alias("base_failed"), kept.alias("kept"), probability.alias("probability"))


def good_documents(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """The rows, with all their columns, of documents whose posterior is good, short ones too."""
    hidden = {c: f"_c{i}" for i, c in enumerate(docs.columns)}
    own = docs.select(*[F.col(f"`{c}`").alias(h) for c, h in hidden.items()])
    rows = judged(own, text_col=hidden[text_col], keep=tuple(hidden.values()), base_rules=False)
    return rows.filter("kept").select(*[F.col(h).alias(c) for c, h in hidden.items()])
