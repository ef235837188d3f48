"""Best-fit packing of token pieces, improved by swaps between underfull bins.

What decides a packing is how many pieces there are of each length, so the search runs on
that histogram: at most ``capacity`` lengths, however many documents.  A pattern is a
list of lengths with the number of bins that are filled so.  Best fit makes the first
patterns; then documents move, or are exchanged one for one, two for one or one for two,
between underfull patterns wherever that increases the sum of squared fills, which
empties bins.  It ends when no exchange increases that sum, which can't rise for ever.

Each piece finds its place by its rank among the pieces of its length.  A task numbers its own pieces of each length as
it writes them; counts by task and length, summed over tasks, say how many come before.  No piece moves for
that, whatever length most pieces have, and the driver gets one count a length.

Cases: a null text is empty (its piece holds the end id alone); very long texts are cut into as many pieces as they
need; repeated rows are packed each; pieces of one length are dealt out as they come; rows with a null id are packed
like others; an empty table gives no pieces; ``pack_documents`` reads no other columns, ``pack`` keeps those it is
given (``sequence_id`` and ``offset`` in their place if there were such).
"""

from __future__ import annotations

import zlib
from collections import Counter, deque
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StructField, StructType
from pyspark.sql.window import Window

from ..session import written
from .textscan import releasing
from .tokenizing import encoded_slices


def _cutter(path: str, capacity: int, end_id: int, keep_ids: bool):
    """Turns batches of (id, text) into batches of pieces."""

    def cut(batches):
        for batch in batches:
            for keys, tokens, counts in encoded_slices(batch, path):
                sizes = counts + 1
                ids = np.insert(tokens, np.cumsum(counts), end_id).astype("<u4", copy=False)
                pieces = -(-sizes // capacity)
                row = np.repeat(np.arange(len(sizes)), pieces)
                number = np.arange(len(row)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
                head = (sizes - capacity * (pieces - 1))[row]
                start = np.where(number == 0, 0, head + capacity * (number - 1))
                length = np.where(number == 0, head, capacity)
                at = (np.cumsum(sizes) - sizes)[row] + start
                raw = memoryview(ids).cast("B")
                spans = list(zip((4 * at).tolist(), (4 * (at + length)).tolist()))
                columns = [keys.take(pa.array(row)), pa.array(number, pa.int32()), pa.array(start), pa.array(length), pa.array([zlib.crc32(raw[a:b]) for a, b in spans], pa.int64())]
                names = ["doc_id", "piece", "start", "length", "ids_crc32"]
                if keep_ids:
                    columns.append(pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(length)), pa.int32()), pa.array(ids, pa.int32())))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(columns, names)

    return releasing(cut)


def _texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))


def _piece_schema(docs: DataFrame, id_col: str, keep_ids: bool) -> StructType:
    fields = [StructField("doc_id", docs.schema[id_col].dataType), StructField("piece", IntegerType()), *(StructField(n, LongType()) for n in ("start", "length", "ids_crc32"))]
    return StructType(fields + [StructField("ids", ArrayType(IntegerType()))] * keep_ids)


def token_pieces(docs: DataFrame, path: str, capacity: int = 1024, end_id: int = 2, id_col: str = "doc_id", text_col: str = "text", keep_ids: bool = False) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32 and, if asked for, ids.

    A document's ids end with ``end_id``.  Longer ones than ``capacity`` are cut so that all pieces but
    the first are full.
    """
    return _texts(docs, id_col, text_col).mapInArrow(_cutter(path, capacity, end_id, keep_ids), _piece_schema(docs, id_col, keep_ids))


def best_fit(counts: dict[int, int], capacity: int) -> Counter:
    """Patterns (descending lengths) and how many bins each fills, by best fit, longest first."""
    left = {n: c for n, c in counts.items() if c > 0}
    lengths = sorted(left, reverse=True)
    out: Counter = Counter()
    while lengths:
        gap, pattern = capacity, []
        for n in lengths:
            k = min(gap // n, left[n])
            pattern += [n] * k
            gap -= n * k
            if gap < lengths[-1]:
                break
        times = min(left[n] // k for n, k in Counter(pattern).items())
        out[tuple(pattern)] += times
        for n in pattern:
            left[n] -= times
        lengths = [n for n in lengths if left[n]]
    return out


def _better(full: tuple, low: tuple, capacity: int) -> tuple[tuple, tuple] | None:
    """Exchange between two bins (full is at least as full as low) that fills the first most."""
    gap, best = capacity - sum(full), (0, (), ())
    ones, twos = [(x,) for x in sorted(set(low), reverse=True)], {(a, b) for i, a in enumerate(low) for b in low[i + 1 :]}
    own = [(), *((y,) for y in set(full))]
    own_twos = {(a, b) for i, a in enumerate(full) for b in full[i + 1 :]}
    for gives, takes in ((ones, own), (sorted(twos, reverse=True), own[1:]), (ones, own_twos)):
        for x in gives:
            for y in takes:
                gain = sum(x) - sum(y)
                if best[0] < gain <= gap:
                    best = (gain, x, y)
                    if gain == gap:
                        break
    if not best[0]:
        return None
    a, b = Counter(full), Counter(low)
    a.subtract(best[2]), a.update(best[1]), b.subtract(best[1]), b.update(best[2])
    order = lambda c: tuple(sorted(c.elements(), reverse=True))
    return order(a), order(b)


def improve(patterns: Counter, capacity: int) -> Counter:
    """Local search: moves and exchanges until none increases the squared fill.

    Each pattern that is new or got more bins meets all underfull ones once, the fullest first.
    """
    done = Counter({p: c for p, c in patterns.items() if sum(p) == capacity})
    open_ = Counter({p: c for p, c in patterns.items() if sum(p) < capacity})
    fill = {p: sum(p) for p in open_}
    number = {p: i for i, p in enumerate(open_)}
    idle: set[int] = set()  # pairs without an exchange that gains
    queue = deque(sorted(open_, key=lambda p: (fill[p], p)))
    queued = set(queue)

    def wait(pattern: tuple) -> None:
        if pattern not in queued:
            queued.add(pattern)
            queue.append(pattern)

    def put(pattern: tuple, times: int) -> None:
        if sum(pattern) == capacity:
            done[pattern] += times
        elif pattern:
            fill[pattern] = sum(pattern)
            number.setdefault(pattern, len(number))
            open_[pattern] += times
            wait(pattern)

    def exchange(full: tuple, low: tuple) -> bool:
        pair = number[full] << 32 | number[low]
        if fill[full] < fill[low] or pair in idle:
            return False
        change = _better(full, low, capacity)
        if not change:
            idle.add(pair)
            return False
        times = open_[low] // 2 if full == low else min(open_[full], open_[low])
        for p in (full, low):
            open_[p] -= times
            if not open_[p]:
                del open_[p]
        for p in change:
            put(p, times)
        return True

    while queue:
        own = queue.popleft()
        queued.remove(own)
        for other in sorted(open_, key=lambda p: (-fill[p], p)):
            if own not in open_:
                break
            if other in open_ and (own != other or open_[own] > 1) and (exchange(own, other) or exchange(other, own)) and own in open_:
                wait(own)
    return done + open_


@dataclass
class Places:
    """Where the piece of each length and rank goes: arrays bounded by the patterns, not by the pieces."""

    keys: np.ndarray  # length << 40 | first rank
    base: np.ndarray  # first bin of the pattern
    copies: np.ndarray  # of the length in the pattern
    at: np.ndarray  # first of its offsets
    offsets: np.ndarray

    @classmethod
    def of(cls, patterns: Counter) -> Places:
        rows, bins, used = [], 0, Counter()
        for p, times in sorted(patterns.items(), key=lambda x: (-sum(x[0]), x[0])):
            begin = dict(zip(p, range(0)))
            at = 0
            for n in p:
                begin.setdefault(n, []).append(at)
                at += n
            for n, places in begin.items():
                rows.append((n << 40 | used[n], bins, len(places), places))
                used[n] += len(places) * times
            bins += times
        rows.sort()
        sizes = [r[2] for r in rows]
        column = lambda i: np.array([r[i] for r in rows], np.int64)
        return cls(column(0), column(1), column(2), np.cumsum([0, *sizes])[: len(rows)], np.array([x for r in rows for x in r[3]], np.int64))

    def find(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        key = (length.astype(np.int64) << 40) | rank
        k = np.searchsorted(self.keys, key, "right") - 1
        within = key - self.keys[k]
        return self.base[k] + within // self.copies[k], self.offsets[self.at[k] + within % self.copies[k]]


def _numbered(rows: DataFrame, make, schema: StructType, capacity: int, length_col: str) -> DataFrame:
    """The rows that ``make`` turns batches of ``rows`` into, written, with their task (``_task``), length and number among the task's rows of that length (``_nth``)."""
    more = StructType([*schema.fields, *(StructField(n, LongType()) for n in ("_task", "_length", "_nth"))])

    def count(batches):
        from pyspark import TaskContext

        task, seen = TaskContext.get().partitionId(), np.zeros(capacity + 1, np.int64)
        for batch in make(batches):
            length = batch.column(length_col).cast(pa.int64()).fill_null(0).to_numpy()
            if len(length) and (length.min() < 1 or length.max() > capacity):
                raise ValueError(f"lengths must be 1 to {capacity}")
            order = np.argsort(length, kind="stable")
            counts = np.bincount(length, minlength=capacity + 1)
            nth = np.empty(len(length), np.int64)
            nth[order] = np.arange(len(length)) - np.repeat(np.cumsum(counts) - counts, counts)
            own = [pa.array(np.full(len(length), task, np.int64)), pa.array(length), pa.array(nth + seen[length])]
            yield pa.RecordBatch.from_arrays([*batch.columns, *own], [*batch.schema.names, "_task", "_length", "_nth"])
            seen += counts

    return written(rows.mapInArrow(count, more), "pieces")


def pack(pieces: DataFrame, capacity: int = 1024, length_col: str = "length") -> DataFrame:
    """Adds ``sequence_id`` and ``offset`` to rows whose lengths are 1 to ``capacity``; the rows are written once to the shared folder."""
    names = pieces.columns
    hidden = pieces.toDF(*[f"c{i}" for i in range(len(names))])  # whatever they are called, they don't clash with ours
    placed = _placed(_numbered(hidden, lambda batches: batches, hidden.schema, capacity, f"c{names.index(length_col)}"), hidden.columns, capacity)
    return placed.select(*[F.col(f"c{i}").alias(n) for i, n in enumerate(names) if n not in ("sequence_id", "offset")], "sequence_id", "offset")


def _placed(rows: DataFrame, columns: list[str], capacity: int) -> DataFrame:
    counts = written(rows.groupBy("_task", "_length").agg(F.count(F.lit(1)).alias("n")), "counts")  # a row for each task and length
    found = counts.groupBy("_length").agg(F.sum("n").alias("n")).collect()  # capacity rows at most
    places = Places.of(improve(best_fit({r["_length"]: r["n"] for r in found}, capacity), capacity))
    earlier = Window.partitionBy("_length").orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)  # a row for each task
    before = counts.select(F.col("_task").alias("_t"), F.col("_length").alias("_l"), F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("_before"))

    @F.pandas_udf("sequence_id long, offset long")
    def place(length, rank):
        import pandas as pd

        where = places.find(length.to_numpy(), rank.to_numpy())
        return pd.DataFrame({"sequence_id": where[0], "offset": where[1]})

    ranked = rows.join(before, (F.col("_task") == F.col("_t")) & (F.col("_length") == F.col("_l"))).withColumn("_place", place("_length", F.col("_before") + F.col("_nth")))
    return ranked.select(*columns, F.col("_place.sequence_id").alias("sequence_id"), F.col("_place.offset").alias("offset"))


def pack_documents(docs: DataFrame, path: str, capacity: int = 1024, end_id: int = 2, keep_ids: bool = False) -> DataFrame:
    """Tokenizes, cuts and packs whole documents."""
    schema = _piece_schema(docs, "doc_id", keep_ids)
    rows = _numbered(_texts(docs, "doc_id", "text"), _cutter(path, capacity, end_id, keep_ids), schema, capacity, "length")  # one worker cuts and numbers
    return _placed(rows, schema.names, capacity)
