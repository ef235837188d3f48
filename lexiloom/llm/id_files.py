"""Token-id files: frequency-ranked ids in byte-aligned variable-length coding.

Ids are replaced by their rank by frequency (ties: the smaller id first).  A rank takes
1 to 4 data bytes, least significant first; the number of bytes, less one, is 2 bits of a
control stream that lies apart from the data: four ids a control byte, the first id in the
lowest bits.  A file holds documents in ascending id order:

    magic "LXID1\\0\\0\\0"
    blocks, each: six little-endian uint64 (documents, ids, bytes of the document table,
    control bytes, data bytes, crc32 of the rest), then the document table (Arrow IPC: id, length), control, data

The rank table of the collection is a file of little-endian uint32 ids in rank order.
Files are written to the shared folder by their tasks under names of their own, so a
repeated task leaves at most a file that no manifest names.

Rows whose tasks hold ascending, disjoint id ranges are copied file by file, others are sorted; documents, order and
bytes of a document are the same either way, only how they fall into files differs.

Cases: a null text is empty (its document is the end id alone); repeated rows are stored
each, rows of one id in any order, files that begin with one id by path; very long texts are blocks of their own; null ids
come first; an empty table gives no files; other columns are not read.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.window import Window

from ..session import work_folder, written
from .tokenizing import encoded_slices, id_type

MAGIC = b"LXID1\0\0\0"
HEAD = struct.Struct("<6Q")
BLOCK_IDS = 1 << 20
WIDTHS = (np.arange(256)[:, None] >> np.array([0, 2, 4, 6]) & 3) + 1  # of the four ids of each control byte


def pack_ids(ranks: np.ndarray) -> tuple[bytes, bytes]:
    """Control and data bytes of some ranks."""
    ranks = ranks.astype(np.uint32, copy=False)
    n = len(ranks)
    code = np.zeros(-(-n // 4) * 4, np.uint8)
    code[:n] = (ranks > 0xFF).astype(np.uint8) + (ranks > 0xFFFF) + (ranks > 0xFFFFFF)
    quads = code.reshape(-1, 4)
    control = quads[:, 0] | quads[:, 1] << 2 | quads[:, 2] << 4 | quads[:, 3] << 6
    if n and not code.max() > 1:  # two columns do
        pairs = np.empty((n, 2), np.uint8)
        pairs[:, 0], pairs[:, 1] = ranks & 0xFF, ranks >> 8
        keep = np.ones((n, 2), bool)
        keep[:, 1] = code[:n] > 0
        return control.astype(np.uint8).tobytes(), pairs[keep].tobytes()
    keep = np.arange(4) <= code[:n, None]
    return control.astype(np.uint8).tobytes(), ranks.astype("<u4").view(np.uint8).reshape(n, 4)[keep].tobytes()


def unpack_ids(control: bytes, data: bytes, n: int) -> np.ndarray:
    """The ranks again: widths by table, then each byte position of all ids at once."""
    widths = WIDTHS[np.frombuffer(control, np.uint8)].reshape(-1)[:n]
    ends = np.cumsum(widths)
    if (int(ends[-1]) if n else 0) != len(data):
        raise ValueError("control and data bytes don't agree")
    raw = np.frombuffer(data, np.uint8)
    starts = ends - widths
    out = raw[starts].astype(np.uint32)
    for k in range(1, int(widths.max()) if n else 0):
        more = np.flatnonzero(widths > k)
        out[more] |= raw[starts[more] + k].astype(np.uint32) << np.uint32(8 * k)
    return out


def _open(path: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(path)


def _narrow(vocabulary: int) -> str:
    return "<u2" if vocabulary <= 1 << 16 else "<u4"


def encoded_rows(docs: DataFrame, path: str, vocabulary: int, end_id: int, id_col: str, text_col: str) -> DataFrame:
    """id, n, ids (bytes), with the task that made the row and whether it follows the row before it."""
    kind = _narrow(vocabulary)

    def rows(batches):
        from pyspark import TaskContext

        task, last = TaskContext.get().partitionId(), None
        for batch in batches:
            for keys, tokens, counts in encoded_slices(batch, path):
                sizes = counts + 1
                raw = np.insert(tokens, np.cumsum(counts), end_id).astype(kind)
                ends = np.append(0, np.cumsum(sizes)) * raw.itemsize
                values = keys.to_pylist()
                order = [v is None or p is not None and v >= p for p, v in zip([last, *values], values)]
                order[0] = order[0] or last is None
                last = values[-1]
                blob = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(sizes), [None, pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(raw)]).cast(pa.binary())
                yield pa.RecordBatch.from_arrays([keys, pa.array(sizes), blob, pa.array([task] * len(sizes), pa.int32()), pa.array(order)], ["id", "n", "ids", "task", "in_order"])

    source = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    return source.mapInArrow(rows, f"id {id_type(docs, id_col)}, n long, ids binary, task int, in_order boolean")


def id_ranks(rows: DataFrame, vocabulary: int) -> np.ndarray:
    """All ids by descending frequency over all documents; bounded by the vocabulary."""
    kind = _narrow(vocabulary)

    def count(batches):
        total = np.zeros(vocabulary, np.int64)
        for batch in batches:
            data = batch.column(0)
            _, offsets, raw = data.buffers()
            offsets = np.frombuffer(offsets, np.int32)[data.offset : data.offset + len(data) + 1]
            if len(data) and offsets[-1] > offsets[0]:
                total += np.bincount(np.frombuffer(raw, kind, (offsets[-1] - offsets[0]) // np.dtype(kind).itemsize, int(offsets[0])), minlength=vocabulary)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["token", "n"])

    found = rows.select("ids").mapInArrow(count, "token long, n long").groupBy("token").agg(F.sum("n").alias("n")).toPandas()
    counts = np.zeros(vocabulary, np.int64)
    counts[found["token"]] = found["n"]
    return np.argsort(-counts, kind="stable")


def _blocks(batches: Iterator[pa.RecordBatch], kind: str) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Documents in order, some million ids at a time (more only where one document has more)."""
    keys, sizes, ids, held = [], [], [], 0
    for batch in batches:
        n = batch.column("n").to_numpy()
        data = batch.column("ids")
        _, offsets, raw = data.buffers()
        offsets = np.frombuffer(offsets, np.int32)[data.offset : data.offset + len(data) + 1]
        begin = 0
        while begin < len(n):
            room = np.cumsum(n[begin:])
            take = max(1, int(np.searchsorted(room, BLOCK_IDS - held, "right"))) if held < BLOCK_IDS else 1
            keys.append(batch.column("id").slice(begin, take))
            sizes.append(n[begin : begin + take])
            ids.append(np.frombuffer(raw, kind, int(room[take - 1]), int(offsets[begin])))
            held += len(ids[-1])
            begin += take
            if held >= BLOCK_IDS or begin < len(n):
                yield pa.table({"id": pa.chunked_array(keys), "n": np.concatenate(sizes)}), np.concatenate(ids)
                keys, sizes, ids, held = [], [], [], 0
    if keys:
        yield pa.table({"id": pa.chunked_array(keys), "n": np.concatenate(sizes)}), np.concatenate(ids)


def write_file(folder: str, batches: Iterator[pa.RecordBatch], rank: np.ndarray, kind: str) -> dict | None:
    """One file of the format; None if there are no documents."""
    fs, base = _open(folder)
    out, path, total, documents, first = None, f"{folder}/ids-{uuid.uuid4().hex}.lxid", 0, 0, None
    for table, ids in _blocks(batches, kind):
        if out is None:
            fs.create_dir(base)
            out, first = fs.open_output_stream(f"{base}/{path.rpartition('/')[2]}"), table["id"][0].as_py()
            out.write(MAGIC)
        control, data = pack_ids(rank[ids])
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, table.schema) as writer:
            writer.write_table(table.combine_chunks())
        head = sink.getvalue().to_pybytes()
        body = head + control + data
        out.write(HEAD.pack(len(table), len(ids), len(head), len(control), len(data), zlib.crc32(body)) + body)
        total, documents = total + len(ids), documents + len(table)
    if out is None:
        return None
    out.close()
    return {"path": path, "first_id": first, "documents": documents, "n_ids": total}


def read_blocks(path: str, ranked: np.ndarray) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Document tables and token ids of a file, block by block."""
    fs, own = _open(path)
    with fs.open_input_stream(own) as source:
        if source.read(len(MAGIC)) != MAGIC:
            raise ValueError(f"{path} is not an id file")
        while head := source.read(HEAD.size):
            documents, n, table_bytes, control_bytes, data_bytes, crc = HEAD.unpack(head)
            body = source.read(table_bytes + control_bytes + data_bytes)
            if zlib.crc32(body) != crc:
                raise ValueError(f"{path} is damaged")
            table = pa.ipc.open_stream(body[:table_bytes]).read_all()
            if len(table) != documents:
                raise ValueError(f"{path} is damaged")
            yield table, ranked[unpack_ids(body[table_bytes : table_bytes + control_bytes], body[table_bytes + control_bytes :], n)]


def write_ids(docs: DataFrame, path: str, folder: str | None = None, vocabulary: int = 50_257, end_id: int = 0, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, str]:
    """Encodes and writes all documents; returns the manifest (path, first_id, documents, n_ids, start) and the rank table's path.

    Ids are encoded once, into a table of the shared folder.  If its tasks hold ascending, disjoint
    id ranges, as tables written in order do, its files are copied in that order; else its rows are sorted.
    """
    spark, key, kind = docs.sparkSession, id_type(docs, id_col), _narrow(vocabulary)
    folder = folder or work_folder(spark, "id-files")
    rows = written(encoded_rows(docs, path, vocabulary, end_id, id_col, text_col), "encoded")
    ranked = id_ranks(rows, vocabulary)
    fs, base = _open(folder)
    fs.create_dir(base)
    with fs.open_output_stream(f"{base}/ranks.bin") as out:
        out.write(ranked.astype("<u4").tobytes())
    rank = np.empty(vocabulary, np.uint32)
    rank[ranked] = np.arange(vocabulary, dtype=np.uint32)
    schema = f"path string, first_id {key}, documents long, n_ids long"
    tasks = rows.groupBy(F.col("_metadata.file_path").alias("file")).agg(F.min("id").alias("low"), F.max("id").alias("high"), F.min("in_order").alias("in_order"), F.count("id").alias("known"), F.count(F.lit(1)).alias("n"))
    follows = F.lag("high").over(Window.orderBy("low"))
    whole = tasks.select("*", (follows.isNull() | (follows <= F.col("low"))).alias("after"))
    clustered = whole.agg(F.coalesce(F.min(F.col("in_order") & F.col("after") & (F.col("known") == F.col("n"))), F.lit(True))).first()[0]

    def manifest(found: dict | None) -> Iterator[pa.RecordBatch]:
        if found:
            yield pa.RecordBatch.from_pylist([found], schema=pa.schema([("path", pa.string()), ("first_id", pa_key), ("documents", pa.int64()), ("n_ids", pa.int64())]))

    pa_key = to_arrow_type(docs.schema[id_col].dataType)

    if clustered:

        def copy(batches):
            for batch in batches:
                for file in batch.column(0).to_pylist():
                    own, at = _open(file)
                    with pq.ParquetFile(at, filesystem=own) as source:
                        yield from manifest(write_file(folder, source.iter_batches(256, columns=["id", "n", "ids"]), rank, kind))

        files = written(tasks.select("file"), "encoded-files")
        made = files.repartition(max(1, files.count()), "file").mapInArrow(copy, schema)
    else:

        def sorted_rows(batches):
            yield from manifest(write_file(folder, batches, rank, kind))

        made = rows.select("id", "n", "ids").sort("id").mapInArrow(sorted_rows, schema)
    listed = written(made, "manifest")
    # One row a file; files that begin with one id go by path, and what they add up to is written down once.
    before = Window.orderBy(F.asc_nulls_first("first_id"), "path").rowsBetween(Window.unboundedPreceding, -1)
    return written(listed.withColumn("start", F.coalesce(F.sum("n_ids").over(before), F.lit(0))), "placed"), f"{folder}/ranks.bin"


def read_ids(manifest: DataFrame, ranks_path: str, keep_ids: bool = True) -> DataFrame:
    """One row per document read from the files: doc_id, start, n_tokens, ids_crc32 and, if asked for, ids."""
    key = id_type(manifest, "first_id")

    def documents(batches):
        fs, at = _open(ranks_path)
        with fs.open_input_stream(at) as source:
            ranked = np.frombuffer(source.read(), "<u4")
        for batch in batches:
            for path, begin in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                for table, ids in read_blocks(path, ranked):
                    n = table["n"].to_numpy()
                    ends = np.append(0, np.cumsum(n))
                    raw = memoryview(ids.astype("<u4", copy=False)).cast("B")
                    crc = [zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(ends[:-1].tolist(), ends[1:].tolist())]
                    columns = [table["id"].combine_chunks(), pa.array(begin + ends[:-1]), pa.array(n), pa.array(crc, pa.int64())]
                    if keep_ids:
                        columns.append(pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(ids.astype(np.int32))))
                    yield pa.RecordBatch.from_arrays(columns, ["doc_id", "start", "n_tokens", "ids_crc32", "ids"][: len(columns)])
                    begin += int(ends[-1])

    rows = manifest.select("path", "start")
    return rows.repartition(max(1, manifest.count()), "path").mapInArrow(documents, f"doc_id {key}, start long, n_tokens long, ids_crc32 long" + ", ids array<int>" * keep_ids)
