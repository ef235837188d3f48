"""Token counts: an exact length histogram whose suffix sums answer questions for every context limit.

Cases: a null text is an empty one (length 0); repeated rows count each; rows with a
null id count like any other; an empty table gives an empty histogram and answers of 0;
other columns of the input are not read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..session import written
from .tokenizing import token_lengths

BLOCK = 1024  # lengths of one block share a window; blocks are summed apart


def length_histogram(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", extra: int = 0) -> DataFrame:
    """``n_tokens``, ``n_docs``: how many documents have each encoded length."""
    return histogram(token_lengths(docs, path, id_col, text_col, extra))


def histogram(lengths: DataFrame) -> DataFrame:
    return lengths.groupBy("n_tokens").agg(F.count(F.lit(1)).alias("n_docs"))


def with_suffix_sums(hist: DataFrame) -> DataFrame:
    """Adds to each length L: documents and tokens of lengths >= L, documents of length <= L,
    and ``truncated_total``, the tokens left if every document is cut to L.

    Sums run within blocks of lengths and over the blocks, so no task sees the whole
    histogram unless it is small.
    """
    block = F.floor(F.col("n_tokens") / BLOCK)
    hist = written(hist, "histogram")  # read twice below; encoding comes before it
    rows = hist.select("n_tokens", "n_docs", (F.col("n_tokens") * F.col("n_docs")).alias("tokens"), block.alias("block"))
    up = Window.partitionBy("block").orderBy(F.desc("n_tokens"))
    sums = rows.groupBy("block").agg(F.sum("n_docs").alias("block_docs"), F.sum("tokens").alias("block_tokens"))
    above = Window.orderBy(F.desc("block")).rowsBetween(Window.unboundedPreceding, -1)
    every = Window.orderBy(F.desc("block")).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    blocks = sums.select(
        "block",
        F.coalesce(F.sum("block_docs").over(above), F.lit(0)).alias("docs_above"),
        F.coalesce(F.sum("block_tokens").over(above), F.lit(0)).alias("tokens_above"),
        F.sum("block_docs").over(every).alias("all_docs"),
        F.sum("block_tokens").over(every).alias("all_tokens"),
    )
    joined = rows.join(blocks, "block").withColumns({
        "docs_at_least": F.sum("n_docs").over(up) + F.col("docs_above"),
        "tokens_at_least": F.sum("tokens").over(up) + F.col("tokens_above"),
    })
    return joined.select(
        "n_tokens",
        "n_docs",
        "docs_at_least",
        "tokens_at_least",
        (F.col("all_docs") - F.col("docs_at_least") + F.col("n_docs")).alias("docs_at_most"),
        (F.col("all_tokens") - F.col("tokens_at_least") + F.col("n_tokens") * F.col("docs_at_least")).alias("truncated_total"),
    )


def answers(hist: DataFrame, limits: DataFrame, limit_col: str = "context") -> DataFrame:
    """For each row of ``limits``: total tokens, tokens if cut to the limit, documents and tokens over it.

    A limit joins its own block of the histogram by equality; blocks know the sums of all longer ones.
    Limits may be any non-negative numbers; a null one gets nulls.
    """
    block = lambda c: F.floor(F.col(c) / BLOCK).alias("block")
    rows = limits.select(F.col(limit_col).cast("long").alias("limit")).distinct()
    cell = F.when(F.col("n_docs") > 0, F.struct("n_tokens", "n_docs"))
    every = hist.select(block("n_tokens"), "n_tokens", "n_docs").union(rows.select(block("limit"), F.lit(0), F.lit(0)).filter("block is not null"))
    sums = every.groupBy("block").agg(F.sum("n_docs").alias("n"), F.sum(F.col("n_tokens") * F.col("n_docs")).alias("t"), F.collect_list(cell).alias("cells"))
    longer = Window.orderBy(F.desc("block")).rowsBetween(Window.unboundedPreceding, -1)  # a row a block
    known = sums.select(F.col("block").alias("own"), "cells", F.coalesce(F.sum("n").over(longer), F.lit(0)).alias("d"), F.coalesce(F.sum("t").over(longer), F.lit(0)).alias("o"), F.sum("t").over(Window.partitionBy(F.lit(1))).alias("total"))
    over = F.filter("cells", lambda c: c["n_tokens"] > F.col("limit"))
    docs_over = F.col("d") + F.aggregate(over, F.lit(0).cast("long"), lambda a, c: a + c["n_docs"])
    tokens_over = F.col("o") + F.aggregate(over, F.lit(0).cast("long"), lambda a, c: a + c["n_docs"] * c["n_tokens"])
    found = rows.join(known, F.floor(F.col("limit") / BLOCK) == F.col("own"), "left").select("limit", docs_over.alias("docs_over"), tokens_over.alias("tokens_over"), "total")
    truncated = F.col("total") - F.col("tokens_over") + F.col("limit") * F.col("docs_over")
    return found.select(F.col("limit").alias(limit_col), F.col("total").alias("total_tokens"), "docs_over", truncated.alias("truncated_total"))


def quantiles(sums: DataFrame, probabilities: list[float]) -> DataFrame:
    """Exact length quantiles: the least length that at least the share p of documents doesn't exceed."""
    total = F.col("docs_at_most") + F.col("docs_at_least") - F.col("n_docs")
    each = sums.select("n_tokens", F.explode(F.array(*[F.lit(float(p)) for p in probabilities])).alias("p"), F.col("docs_at_most"), total.alias("all"))
    return each.filter(F.col("docs_at_most") >= F.greatest(F.lit(1), F.ceil(F.col("p") * F.col("all")))).groupBy("p").agg(F.min("n_tokens").alias("n_tokens"))
