"""Byte-level BPE by a global shuffle of distinct words, and decoding by a join with the token-byte table.

Encoding explodes texts into pre-tokens with their positions.  Occurrences are aggregated before
the shuffle: documents are taken in blocks of ``BLOCK_CHARS`` code points, each distinct word of a
block is numbered and sent once, so a word like " the" is one entry a block and not a third of all, and each
position holds its word's number.  Words are dealt into as many buckets as there are shuffle partitions by their
hash, and what goes from a block to a bucket is one row, compressed as a whole.  In its bucket each distinct
word is encoded once, and its ids take its place in every block's row.  A word that fills more than one in ``OFTEN``
positions of a block is dealt by the block as well, so that no bucket gets all blocks' entries.  Rows then go
back to their blocks, where ids join the positions by number.  Ids come from nowhere else: a word that
doesn't return is an error.

Decoding explodes ids likewise, into each distinct token of a group of rows with its positions there, joins
the table of token bytes (broadcast: one row a token, so bounded by the vocabulary) and reassembles by position.

Blocks are cut from rows in an order of their own (by id and text within a partition), so that
a task run again after a lost executor cuts the same ones.  Positions and ids travel as bytes of
seven bits each, the first lowest, the last of a number marked by a clear eighth bit.

Cases: a null text is empty and has no ids; repeated rows are encoded each; null ids are kept; very long
texts are a block of their own; an empty table gives no rows; other columns are not read; unknown
token ids raise an error in decoding.
"""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .textscan import WordCodes, mixed, ranges, rank_codes, read_ranks, span_hashes, text_slices
from .tokenizing import id_type

BLOCK_CHARS = 16_000_000
GROUP_IDS = 500_000  # ids that are decoded together, or one row's if it has more
OFTEN = 2_000
WORDS, PLACES, DOCUMENTS = 0, 1, 2  # kinds of packs
PACK = struct.Struct("<3q")


def to_varints(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of non-negative numbers and how many each takes."""
    values = values.astype(np.uint64, copy=False)
    widths = np.ones(len(values), np.int64)
    top = int(values.max()) if len(values) else 0
    for k in range(1, 10):
        if top >> 7 * k:
            widths += values >> np.uint64(7 * k) > 0
    starts = np.cumsum(widths) - widths
    out = np.zeros(int(widths.sum()), np.uint8)
    for k in range(int(widths.max()) if len(widths) else 0):
        has = np.flatnonzero(widths > k)
        part = (values[has] >> np.uint64(7 * k) & np.uint64(0x7F)).astype(np.uint8)
        out[starts[has] + k] = part | ((widths[has] > k + 1).astype(np.uint8) << 7)
    return out, widths


def from_varints(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The numbers again, and the place after each one's last byte."""
    ends = np.flatnonzero(raw < 0x80) + 1
    starts = np.append(0, ends[:-1])[: len(ends)]
    widths = ends - starts
    out = (raw[starts] & 0x7F).astype(np.int64)
    for k in range(1, int(widths.max()) if len(widths) else 0):
        has = np.flatnonzero(widths > k)
        out[has] |= (raw[starts[has] + k] & 0x7F).astype(np.int64) << 7 * k
    return out, ends


def _binary(raw: np.ndarray, bounds: np.ndarray) -> pa.Array:
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(bounds) - 1, [None, pa.py_buffer(bounds.astype(np.int64)), pa.py_buffer(np.ascontiguousarray(raw))]).cast(pa.binary())


def _raw(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a binary column without nulls, and the bounds of each row."""
    _, offsets, data = column.buffers()
    bounds = np.frombuffer(offsets, np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8)[bounds[0] : bounds[-1]] if data is not None else np.zeros(0, np.uint8)
    return raw, bounds - bounds[0]


def _packed(flat: np.ndarray, sizes: np.ndarray, numbers: np.ndarray) -> bytes:
    """Rows of bytes, how many each has, and their ascending numbers, compressed together."""
    one, two = to_varints(sizes)[0], to_varints(np.diff(numbers, prepend=0))[0]
    body = b"".join(x.tobytes() for x in (one, two, flat.astype(np.uint8, copy=False)))
    return PACK.pack(len(one), len(two), len(flat)) + zstandard.compress(body, 3)


def _unpacked(pack: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    ends = np.cumsum(PACK.unpack(pack[: PACK.size]))
    body = np.frombuffer(zstandard.decompress(pack[PACK.size :], max_output_size=int(ends[-1])), np.uint8)
    one, two, flat = np.split(body, ends[:-1])
    return flat, from_varints(one)[0], np.cumsum(from_varints(two)[0])


def _positions(numbers: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each of the numbers 0 to n - 1, all of which occur: its positions as varints of steps, their bytes, and how many there are."""
    order = np.argsort(numbers, kind="stable")
    counts = np.bincount(numbers, minlength=n)
    first = np.cumsum(counts) - counts
    steps = np.diff(order, prepend=0)
    steps[first] = order[first]
    raw, widths = to_varints(steps)
    return raw, np.add.reduceat(widths, first) if n else np.zeros(0, np.int64), counts


def _scattered(raw: np.ndarray, sizes: np.ndarray, total: int) -> np.ndarray:
    """Which row each of ``total`` positions belongs to; an error if that isn't one row each."""
    steps, ends = from_varints(raw)
    counts = np.diff(np.searchsorted(ends, np.append(0, np.cumsum(sizes)), "right"))
    if len(steps) != total:
        raise ValueError(f"{total} positions wait for words, {len(steps)} came")
    first = np.cumsum(counts) - counts
    sums = np.cumsum(steps)
    places = sums - np.repeat((sums - steps)[first], counts) if total else steps
    rows = np.full(total, -1, np.int64)
    rows[places] = np.repeat(np.arange(len(counts)), counts)
    if total and rows.min() < 0:
        raise ValueError("some positions have no word")
    return rows


class _Block:
    """Documents that are cut into words together."""

    def __init__(self, pre, number: int):
        self.number, self.chars = number, 0
        self.words = WordCodes(pre, lambda found: [[]] * len(found), limit=1 << 62)
        self.keys, self.counts, self.sequence = [], [], []

    def add(self, keys: pa.Array, piece) -> None:
        self.chars += len(piece.points)
        self.keys.append(keys)
        if not len(piece.points):
            self.counts.append(np.zeros(len(piece), np.int64))
            return
        rows, inverse, docs = self.words.distinct(piece)
        self.sequence.append(rows[inverse].astype(np.int32))
        self.counts.append(np.bincount(docs, minlength=len(piece)))

    def packs(self, buckets: int, often: int) -> Iterator[tuple[int, int, bytes]]:
        """Bucket, kind and pack of the words with their numbers, of the word number at each position, and of the documents."""
        if not self.keys:
            return
        store, n = self.words.bytes, self.words.bytes.rows
        sequence = np.concatenate(self.sequence) if self.sequence else np.zeros(0, np.int32)
        counts = np.bincount(sequence, minlength=n)
        order = np.argsort(-counts, kind="stable")  # frequent words get small numbers
        number = np.empty(n, np.int32)
        number[order] = np.arange(n, dtype=np.int32)
        hashes = np.zeros(n, np.uint64)
        hashes[self.words.number] = self.words.hashes  # of words of one hash all but one stay at 0
        shift = np.where(counts * often > len(sequence), int(mixed(np.array([self.number], np.uint64))[0] % np.uint64(buckets)), 0)
        bucket = (((hashes % np.uint64(buckets)).astype(np.int64) + shift) % buckets)[order]
        by = np.argsort(bucket, kind="stable")
        cuts = np.searchsorted(bucket[by], np.arange(buckets + 1))
        for k in range(buckets):
            mine = by[cuts[k] : cuts[k + 1]]  # numbers, ascending
            if len(mine):
                own = order[mine]
                yield k, WORDS, _packed(store.flat[ranges(store.at[own], store.lengths(own))], store.lengths(own), mine)
        at = self.number % buckets
        yield at, PLACES, zstandard.compress(to_varints(number[sequence])[0].tobytes(), 3)
        sink = pa.BufferOutputStream()
        keys = pa.chunked_array(self.keys).combine_chunks()
        with pa.ipc.new_stream(sink, pa.schema([("id", keys.type), ("n", pa.int64()), ("words", pa.int64())])) as writer:
            writer.write_table(pa.table([keys, np.concatenate(self.counts), np.full(len(keys), n)], names=["id", "n", "words"]))
        yield at, DOCUMENTS, sink.getvalue().to_pybytes()


def exploded(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text", block_chars: int = BLOCK_CHARS, often: int = OFTEN) -> DataFrame:
    """bucket, block, kind, pack: the distinct words of a block that go to a bucket; and, for the block, the word at each position and the documents."""
    buckets = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def cut(batches):
        from pyspark import TaskContext

        number, pre = TaskContext.get().partitionId() << 32, rank_codes(path, pattern).pre

        def rows(block):
            for bucket, kind, pack in block.packs(buckets, often):
                yield pa.RecordBatch.from_arrays([pa.array([bucket], pa.int32()), pa.array([block.number], pa.int64()), pa.array([kind], pa.int32()), pa.array([pack], pa.binary())], ["bucket", "block", "kind", "pack"])

        block = _Block(pre, number)
        for batch in batches:
            for piece in text_slices(batch.column(1)):
                block.add(batch.column(0).slice(piece.first, len(piece)), piece)
                if block.chars >= block_chars:
                    yield from rows(block)
                    number += 1
                    block = _Block(pre, number)
        yield from rows(block)

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).sortWithinPartitions("id", F.xxhash64("text"), "text")
    return rows.mapInArrow(cut, "bucket int, block long, kind int, pack binary")


def coded_words(rows: DataFrame, path: str, pattern: str) -> DataFrame:
    """Rows of ``exploded`` with ids (varints) in the place of words; each distinct word is encoded once, where its rows meet."""

    def code(batches):
        library = rank_codes(path, pattern)
        codes = WordCodes(library.pre, library.encode)  # of this task alone: others have other words
        for batch in batches:
            block, kind, pack = (batch.column(c) for c in ("block", "kind", "pack"))
            for i in range(batch.num_rows):
                own = pack[i].as_py()
                if kind[i].as_py() == WORDS:
                    word, lengths, numbers = _unpacked(own)
                    ids, sizes = _coded(codes, _binary(word, np.append(0, np.cumsum(lengths))).cast(pa.string()))
                    own = _packed(ids, sizes, numbers)
                yield pa.RecordBatch.from_arrays([block.slice(i, 1), kind.slice(i, 1), pa.array([own], pa.binary())], ["block", "kind", "pack"])

    return rows.repartition("bucket").mapInArrow(code, "block long, kind int, pack binary")


def _coded(codes: WordCodes, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Ids of distinct words as varints, and the number of bytes of each word's."""
    out, sizes = [np.zeros(0, np.uint8)], [np.zeros(0, np.int64)]
    for piece in text_slices(words):
        hashes, order = np.unique(span_hashes(piece.points, piece.bounds[:-1], piece.bounds[1:]), return_index=True)
        rows = np.empty(len(piece), np.int64)
        if len(order) < len(piece):  # two words of one hash: each for itself
            for i in range(len(piece)):
                own = span_hashes(piece.points, piece.bounds[i : i + 1], piece.bounds[i + 1 : i + 2])
                rows[i] = codes.numbers(own, piece.data, piece.byte_bounds[i : i + 1], piece.byte_bounds[i + 1 : i + 2])[0]
        else:
            rows[order] = codes.numbers(hashes, piece.data, piece.byte_bounds[order], piece.byte_bounds[order + 1])
        raw, widths = to_varints(codes.ids.gather(rows))
        ends = np.append(0, np.cumsum(widths))[np.append(0, np.cumsum(codes.ids.lengths(rows)))]
        out.append(raw), sizes.append(np.diff(ends))
    return np.concatenate(out), np.concatenate(sizes)


def _documents(packs: list[bytes], places: bytes, docs: pa.Table) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Keys, all token ids and the number of ids of each document of a block, from all its packs."""
    parts = [_unpacked(p) for p in packs] or [(np.zeros(0, np.uint8), np.zeros(0, np.int64), np.zeros(0, np.int64))]
    raw, sizes, numbers = (np.concatenate([p[k] for p in parts]) for k in range(3))
    del parts
    words = docs.column("words")[0].as_py()
    if len(numbers) != words or (np.bincount(numbers, minlength=words) != 1).any():
        raise ValueError(f"positions wait for {words} words, {len(numbers)} came")
    ids, ends = from_varints(raw)
    first = np.searchsorted(ends, np.append(0, np.cumsum(sizes)), "right")
    place = np.empty(words, np.int64)
    place[numbers] = np.arange(words)
    with zstandard.ZstdDecompressor().stream_reader(places) as source:
        which = place[from_varints(np.frombuffer(source.read(), np.uint8))[0]]
    counts = docs.column("n").to_numpy()
    widths = np.diff(first)[which]
    done = np.append(0, np.cumsum(widths))[np.append(0, np.cumsum(counts))]
    return docs.column("id").combine_chunks(), ids.astype("<u4")[ranges(first[:-1][which], widths)], np.diff(done)


def _assembled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """doc_id, n_tokens, ids of the blocks whose rows (block, kind, pack) follow each other."""
    block, packs = None, {}

    def made():
        if PLACES not in packs or DOCUMENTS not in packs:
            raise ValueError("a block came back without its documents")
        keys, tokens, counts = _documents(packs.get(WORDS, []), packs[PLACES][0], pa.ipc.open_stream(packs[DOCUMENTS][0]).read_all())
        packs.clear()
        bounds = np.append(0, np.cumsum(counts))
        for a in range(0, len(keys), 1000):
            own = bounds[a : a + 1001]
            yield pa.RecordBatch.from_arrays([keys.slice(a, 1000), pa.array(np.diff(own)), _binary(tokens[own[0] : own[-1]].view(np.uint8), 4 * (own - own[0]))], ["doc_id", "n_tokens", "ids"])

    for batch in batches:
        for number, kind, pack in zip(*(batch.column(c) for c in ("block", "kind", "pack"))):
            if block is not None and number.as_py() != block:
                yield from made()
            block = number.as_py()
            packs.setdefault(kind.as_py(), []).append(pack.as_py())
    if block is not None:
        yield from made()


def reassembled(coded: DataFrame, kind: str) -> DataFrame:
    """doc_id (of the type ``kind``), n_tokens, ids (little-endian uint32) of each document, from all rows of ``coded_words``."""
    return _by_block(coded).mapInArrow(_assembled, f"doc_id {kind}, n_tokens long, ids binary")


def _by_block(coded: DataFrame) -> DataFrame:
    return coded.repartition("block").sortWithinPartitions("block").select("block", "kind", "pack")


def encode(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, ids (array) of each document."""

    def lists(batches):
        for batch in batches:
            raw, bounds = _raw(batch.column(1))
            ids = pa.ListArray.from_arrays(pa.array(bounds // 4, pa.int32()), pa.array(np.frombuffer(raw.tobytes(), "<u4").astype(np.int32)))
            yield pa.RecordBatch.from_arrays([batch.column(0), ids], ["doc_id", "ids"])

    coded = coded_words(exploded(docs, path, pattern, id_col, text_col), path, pattern)
    return reassembled(coded, id_type(docs, id_col)).select("doc_id", "ids").mapInArrow(lists, f"doc_id {id_type(docs, id_col)}, ids array<int>")


def token_bytes(spark: SparkSession, path: str) -> DataFrame:
    """token, data of a tiktoken file: as many rows as the vocabulary has tokens."""
    rows = sorted((rank, token) for token, rank in read_ranks(path).items())
    return spark.createDataFrame(pa.table({"token": pa.array([r for r, _ in rows], pa.int32()), "data": pa.array([t for _, t in rows], pa.binary())}))


def _groups(counts: np.ndarray) -> Iterator[tuple[int, int]]:
    ends, a = np.cumsum(counts), 0
    while a < len(counts):
        b = max(a + 1, int(np.searchsorted(ends, GROUP_IDS + (ends[a - 1] if a else 0), "right")))
        yield a, b
        a = b


TOKENS = ["token", "at", "waiting", "id", "n", "ids_sha256"]


def _token_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows whose first column is the id and whose last is ids: a row for each distinct token of a group, then its documents."""
    for batch in batches:
        raw, bounds = _raw(batch.column(batch.num_columns - 1).fill_null(b""))
        tokens = np.frombuffer(raw.tobytes(), "<u4")
        counts = np.diff(bounds) // 4
        for a, b in _groups(counts):
            own = tokens[bounds[a] // 4 : bounds[b] // 4]
            distinct, numbers = np.unique(own, return_inverse=True)
            steps, widths, _ = _positions(numbers, len(distinct))
            n, k = len(distinct), b - a
            waiting = np.append(np.zeros(k - 1, np.int64), n)  # the last row closes the group and says how many tokens it had
            data = memoryview(raw)
            digests = [hashlib.sha256(data[x:y]).hexdigest() for x, y in zip(bounds[a:b].tolist(), bounds[a + 1 : b + 1].tolist())]
            keys = batch.column(0).slice(a, k)
            yield pa.RecordBatch.from_arrays([pa.array(distinct.astype(np.int64)), _binary(steps, np.append(0, np.cumsum(widths))), pa.nulls(n, pa.int64()), pa.nulls(n, keys.type), pa.nulls(n, pa.int64()), pa.nulls(n, pa.string())], TOKENS)
            yield pa.RecordBatch.from_arrays([pa.nulls(k, pa.int64()), pa.nulls(k, pa.binary()), pa.array(waiting), keys, pa.array(counts[a:b]), pa.array(digests, pa.string())], TOKENS)


def _decoded(rows: DataFrame, make, kind: str, path: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, data; ``make`` turns batches of ``rows`` into rows (id, ..., ids as little-endian uint32)."""

    def explode(batches):
        return _token_rows(make(batches))

    def join_up(batches):
        words, docs = [], []

        def made():
            tokens = pa.Table.from_batches(words, words[0].schema) if words else None
            rows = pa.Table.from_batches(docs).combine_chunks()
            counts = rows.column("n").to_numpy()
            n, total = 0 if tokens is None else tokens.num_rows, int(counts.sum())
            if n != int(rows.column("waiting").to_numpy().sum()):
                raise ValueError("a group's tokens are not together")
            if n and tokens.column("data").null_count:
                raise ValueError("there are ids that the token table lacks")
            if n:
                steps, at = _raw(tokens.column("at").combine_chunks())
                which = _scattered(steps, np.diff(at), total)
                raw, bounds = _raw(tokens.column("data").combine_chunks())
                widths = np.diff(bounds)[which]
                data = raw[ranges(bounds[:-1][which], widths)]
                ends = np.append(0, np.cumsum(widths))[np.append(0, np.cumsum(counts))]
            else:
                data, ends = np.zeros(0, np.uint8), np.zeros(len(counts) + 1, np.int64)
            yield pa.RecordBatch.from_arrays([rows.column("id").combine_chunks(), pa.array(counts), rows.column("ids_sha256").combine_chunks(), _binary(data, ends)], ["doc_id", "n_tokens", "ids_sha256", "data"])

        for batch in batches:
            waiting = batch.column("waiting").fill_null(0).to_numpy()
            is_token = batch.column("at").is_valid().to_numpy(zero_copy_only=False)
            # Runs of token rows and of document rows take turns; a token row after document rows begins a new group.
            turns = np.flatnonzero(np.diff(is_token.astype(np.int8))) + 1
            cuts = [0, *turns.tolist(), len(waiting)]
            for a, b in zip(cuts, cuts[1:]):
                if a == b:
                    continue
                if is_token[a]:
                    if docs:
                        yield from made()
                        words, docs = [], []
                    words.append(batch.slice(a, b - a))
                else:
                    docs.append(batch.slice(a, b - a))
        if docs or words:
            yield from made()

    exploded_ids = rows.mapInArrow(explode, f"token long, at binary, waiting long, id {kind}, n long, ids_sha256 string")
    table = F.broadcast(token_bytes(rows.sparkSession, path).withColumnRenamed("token", "known"))  # bounded by the vocabulary
    joined = exploded_ids.join(table, F.col("token") == F.col("known"), "left").select(*TOKENS, "data")
    return joined.mapInArrow(join_up, f"doc_id {kind}, n_tokens long, ids_sha256 string, data binary")


def decode(coded: DataFrame, path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """doc_id, data (binary) for rows of ids (array); null ids count as none."""
    ids = F.filter(F.coalesce(F.col(ids_col).cast("array<bigint>"), F.array().cast("array<bigint>")), lambda x: x.isNotNull())

    def packed(batches):
        for batch in batches:
            lists = batch.column(1)
            values = lists.flatten().to_numpy(zero_copy_only=False)
            if len(values) and (values.min() < 0 or values.max() >= 1 << 32):
                raise ValueError("there are ids that the token table lacks")
            counts = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), _binary(values.astype("<u4").view(np.uint8), 4 * np.append(0, np.cumsum(counts)))], ["id", "ids"])

    rows = coded.select(F.col(id_col).alias("id"), ids.alias("ids"))
    return _decoded(rows, packed, id_type(coded, id_col), path).select("doc_id", "data")


def round_trip(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256: digests of the ids and of the bytes decoded from them."""
    coded = coded_words(exploded(docs, path, pattern, id_col, text_col), path, pattern)
    rows = _decoded(_by_block(coded), _assembled, id_type(docs, id_col), path)  # reassembled and exploded again by one worker
    return rows.select("doc_id", "n_tokens", "ids_sha256", F.sha2("data", 256).alias("decoded_sha256"))
