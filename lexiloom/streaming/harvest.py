"""Incremental harvesting: watermarked slices, windows, sessions, late rows, and an idempotent streaming upsert."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.window import Window

from ..functions.text import bump_token
from ..operators.merge import write_upsert


def event_time(df: DataFrame, column: str) -> DataFrame:
    """Timestamps without a zone can't carry a watermark; they count as session time."""
    return df.withColumn(column, F.col(column).cast("timestamp"))


def slice_from(df: DataFrame, column: str, last_until: str | None, until: str, overlap_days: int = 3, default_days: int = 21) -> DataFrame:
    """Rows from ``overlap_days`` before the last harvest's end (``default_days`` back without one) to ``until``."""
    start = F.date_sub(F.lit(last_until).cast("date"), overlap_days) if last_until else F.date_sub(F.lit(until).cast("date"), default_days)
    return df.filter((F.col(column) >= start.cast("timestamp")) & (F.col(column) < F.date_add(F.lit(until).cast("date"), 1).cast("timestamp")))


def high_water(df: DataFrame, column: str, before: str | None = None) -> DataFrame:
    """The new watermark, which never goes back: one row, ``last_until``."""
    top = F.max(F.to_date(column))
    return df.agg((F.greatest(top, F.lit(before).cast("date")) if before else top).alias("last_until"))


def windowed(df: DataFrame, column: str, width: str, keys: list[str], aggregates: list[Column]) -> DataFrame:
    return df.groupBy(F.window(column, width), *keys).agg(*aggregates)


def sessions(df: DataFrame, column: str, gap: str, keys: list[str], aggregates: list[Column]) -> DataFrame:
    return df.groupBy(F.session_window(column, gap), *keys).agg(*aggregates)


def late_first_order(df: DataFrame, day: str, last_until: str) -> DataFrame:
    """Adds ``is_late`` and ``turn``: new days come before those read again."""
    late = F.col(day) <= F.lit(last_until).cast("date")
    return df.withColumn("is_late", late).withColumn("turn", F.when(late, 1).otherwise(0))


def harvest_stream(stream: DataFrame, key: str, time: str, path: str, partition: str, checkpoint: str, delay: str = "3 days", sticky: list[str] = (), on_batch: Callable[[DataFrame, int], None] | None = None) -> StreamingQuery:
    """Reads what has arrived, drops repeats within the watermark and upserts each batch; a batch done twice leaves the same table."""
    fresh = event_time(stream, time).withWatermark(time, delay).dropDuplicatesWithinWatermark([key])

    def store(batch: DataFrame, number: int) -> None:
        if not batch.isEmpty():
            write_upsert(batch, path, key, partition, list(sticky))
        if on_batch:
            on_batch(batch, number)

    return fresh.writeStream.foreachBatch(store).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def retry_due(rows: DataFrame, state: DataFrame, key: str, year: str, today: str, this_year: int, short: int = 7, long: int = 90) -> DataFrame:
    """Rows never missed, or missed longer ago than ``long`` days (``short`` for this and the last year)."""
    own = state.select(F.col(key).alias("_k"), F.col("missed").cast("date").alias("_missed"))
    wait = F.when(F.col(year) >= this_year - 1, short).otherwise(long)
    due = F.col("_missed").isNull() | (F.col("_missed") < F.date_sub(F.lit(today).cast("date"), wait))
    return rows.join(own, F.col(key) == F.col("_k"), "left").filter(due).drop("_k", "_missed")


def scheduled(rows: DataFrame, day: Column, schedule: dict[int, str], name: str = "journal") -> DataFrame:
    """Rows with what is due on their weekday (1 is Sunday)."""
    table = F.create_map(*[F.lit(x) for pair in schedule.items() for x in pair])
    return rows.withColumn(name, F.try_element_at(table, F.dayofweek(day)))


def next_request(outcome: Column, token: Column, format_: Column, resumed: Column, pages: Column, cooldowns: Column, skipped: Column) -> Column:
    """Struct of action, token and format after a request of a window, from what came back and the state of the window.

    outcome is ok, failed, none (no records), expired (the token) or refused (the arguments).  A page that fails in the detailed format
    is asked for in the plain one by the caller before it counts as failed; then come pauses while any are left,
    the plain format for a window that never began, and one skipped page; a second one stops the window.
    """
    step = lambda action, tok, form: F.struct(F.lit(action).alias("action"), tok.alias("token"), form.alias("format"))
    none, plain = F.lit(None).cast("string"), F.lit("plain")
    began = (pages > 0) | resumed | (format_ == "plain")
    failed = F.when(began & (cooldowns > 0), step("pause", token, format_)).when(~began, step("restart", none, plain)).when(token.isNotNull() & ~skipped, step("skip", bump_token(token), format_)).otherwise(step("stop", token, format_))
    done = F.when(token.isNull(), step("done", none, format_)).otherwise(step("next", token, format_))
    return F.when(outcome == "ok", done).when(outcome == "none", step("done", none, format_)).when((outcome == "expired") & resumed, step("restart", none, format_)).when(outcome == "failed", failed).otherwise(step("stop", token, format_))


def work_list(pending: DataFrame, due: DataFrame, name: str = "journal", pos: str = "pos") -> DataFrame:
    """name, turn: what was left over, in its order, then what is due today, each once."""
    every = pending.select(name, F.lit(0).alias("part"), pos).union(due.select(name, F.lit(1), pos))
    first = every.groupBy(name).agg(F.min(F.struct("part", pos)).alias("at"))
    return first.select(name, F.row_number().over(Window.orderBy("at")).cast("long").alias("turn"))  # names of journals, not rows


def seconds_between(begin: Column, end: Column) -> Column:
    """Seconds with their fraction, so that a full interval is one to the microsecond."""
    return (F.unix_micros(end.cast("timestamp")) - F.unix_micros(begin.cast("timestamp"))) / 1_000_000


def checkpoint_due(seconds: Column, every: int = 1800) -> Column:
    """Whether the data and then the position are to be stored, by the seconds since that was last done."""
    return F.coalesce(seconds >= every, F.lit(True))
