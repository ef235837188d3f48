"""WARC archives, index first: offsets, lengths, URLs and digests, then coalesced byte-range reads.

``write`` stores each page as a gzip member of its own in files of some 64 MB, and returns the
index with a row per record.  Of pages with equal payloads the one with the largest id is a
response; the others are revisits that name it.  ``read`` takes any selection of index rows,
sorts them by file and offset, joins neighbouring ranges into one read, and parses the records.

Payload digests are bare upper-case base32 SHA-1.  Files lie below the shared folder under names of
their own, so a repeated task leaves at most a file that no index row names.

Cases: a null payload is empty; a null URL has no target; pages with a null id are responses and never
referred to; rows that repeat id and payload are all responses if theirs is the largest id;
empty tables give an empty index; other columns are not read.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator
from itertools import islice

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.window import Window

from ..session import work_folder, written
from .tokenizing import id_type

FILE_BYTES = 64 << 20
GAP_BYTES, READ_BYTES = 16 << 10, 8 << 20  # ranges this near are read at once, up to this much
DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
URN = "urn:lexiloom:page:"


def base32(sha1: bytes) -> str:
    return base64.b32encode(sha1).decode()


def _member(fields: list[tuple[str, str | None]], block: bytes) -> bytes:
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields if v is not None) + f"Content-Length: {len(block)}\r\n\r\n"
    pack = zlib.compressobj(6, zlib.DEFLATED, 31)
    return pack.compress(head.encode() + block + b"\r\n\r\n") + pack.flush()


def _target(url: str | None) -> str | None:
    return None if url is None else url.replace("%", "%25").replace("\r", "%0D").replace("\n", "%0A") if "\r" in url or "\n" in url else url


def record(page_id, url: str | None, payload: bytes, refers_to=None) -> tuple[bytes, str]:
    """A gzip member and the payload's digest."""
    digest = base32(hashlib.sha1(payload).digest())
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    fields = [
        ("WARC-Type", "revisit" if refers_to is not None else "response"),
        ("WARC-Record-ID", f"<{URN}{'' if page_id is None else page_id}>"),
        ("WARC-Date", DATE),
        ("WARC-Target-URI", _target(url)),
        ("WARC-Payload-Digest", f"sha1:{digest}"),
        ("WARC-Refers-To", None if refers_to is None else f"<{URN}{refers_to}>"),
        ("WARC-Profile", None if refers_to is None else PROFILE),
        ("Content-Type", "application/http; msgtype=response"),
    ]
    return _member(fields, block), digest


def parse(member: bytes) -> tuple[dict[str, str], bytes]:
    """Header fields (lower case) and payload of one gzip member."""
    raw = zlib.decompress(member, 31)
    head, _, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("not a WARC record")
    fields = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
    n = int(fields["content-length"])
    if len(rest) != n + 4:
        raise ValueError("a WARC record has another length than it says")
    return fields, rest[:n].partition(b"\r\n\r\n")[2]


def roles(pages: DataFrame, id_col: str, payload_col: str, least_bytes: int) -> DataFrame:
    """sha, response_id: the largest id of each payload of at least ``least_bytes`` bytes."""
    payload = F.coalesce(F.col(payload_col).cast("binary"), F.lit(b""))
    rows = pages.select(F.col(id_col).alias("id"), F.sha1(payload).alias("sha"), F.octet_length(payload).alias("n"))
    return rows.filter(F.col("n") >= least_bytes).groupBy("sha").agg(F.max("id").alias("response_id")).filter("response_id is not null")


def write(pages: DataFrame, folder: str | None = None, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html", least_bytes: int = 0) -> DataFrame:
    """Writes the archives; returns the index: page_id, file, offset, length, url, digest, record_type."""
    folder = folder or work_folder(pages.sparkSession, "warc")
    key = id_type(pages, id_col)
    found = written(roles(pages, id_col, payload_col, least_bytes), "roles")  # so that both sides of the join are plain shuffles, which AQE splits
    payload = F.coalesce(F.col(payload_col).cast("binary"), F.lit(b""))
    rows = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).cast("string").alias("url"), payload.alias("payload"), F.sha1(payload).alias("own"))
    rows = rows.join(found, F.col("own") == F.col("sha"), "left").select("page_id", "url", "payload", F.when(F.col("response_id") != F.col("page_id"), F.col("response_id")).alias("refers_to"))

    def archive(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = pafs.FileSystem.from_uri(folder)
        out, path, at = None, "", 0
        for batch in batches:
            for i in range(0, batch.num_rows, 256):
                part = batch.slice(i, 256)
                index = []
                for page_id, url, data, refers_to in zip(*(c.to_pylist() for c in part.columns)):
                    if out is None or at >= FILE_BYTES:
                        if out:
                            out.close()
                        fs.create_dir(base)
                        name = f"pages-{uuid.uuid4().hex}.warc.gz"
                        out, path = fs.open_output_stream(f"{base}/{name}", compression=None), f"{folder}/{name}"
                        info = _member([("WARC-Type", "warcinfo"), ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid4()}>"), ("WARC-Date", DATE), ("Content-Type", "application/warc-fields")], b"format: WARC File Format 1.1\r\n")
                        out.write(info)
                        at = len(info)
                    member, digest = record(page_id, url, data, refers_to)
                    out.write(member)
                    index.append((path, at, len(member), url, digest, "response" if refers_to is None else "revisit"))
                    at += len(member)
                kinds = [pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string()]
                yield pa.RecordBatch.from_arrays([part.column(0), *(pa.array([x[k] for x in index], t) for k, t in enumerate(kinds))], ["page_id", "file", "offset", "length", "url", "digest", "record_type"])
        if out:
            out.close()

    made = rows.mapInArrow(archive, f"page_id {key}, file string, offset long, length long, url string, digest string, record_type string")
    return written(made, "index")


def ranges(index: DataFrame, gap: int = GAP_BYTES, most: int = READ_BYTES) -> DataFrame:
    """file, start, end, members (offset and length of each): what is read at once, from index rows of any selection."""
    order = Window.partitionBy("file").orderBy("offset", "length")
    end = F.col("offset") + F.col("length")
    before = F.max(end).over(order.rowsBetween(Window.unboundedPreceding, -1))
    apart = F.when(before.isNull() | (F.col("offset") - before > gap), 1).otherwise(0)
    runs = index.select("file", "offset", "length").distinct().withColumn("_apart", apart).withColumn("_run", F.sum("_apart").over(order))
    first = F.min("offset").over(Window.partitionBy("file", "_run"))
    cut = runs.withColumn("_part", F.floor((F.col("offset") - first) / most))
    return cut.groupBy("file", "_run", "_part").agg(F.min("offset").alias("start"), F.max(end).alias("end"), F.sort_array(F.collect_list(F.struct("offset", "length"))).alias("members")).select("file", "start", "end", "members")


def read(index: DataFrame, keep_payload: bool = True) -> DataFrame:
    """One row per selected record, read and checked: page_id, record_type, refers_to, url, digest, payload_bytes (null for revisits) and, if asked for, payload."""
    key, index_type = id_type(index, "page_id"), to_arrow_type(index.schema["page_id"].dataType)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind, number = index_type, int if pa.types.is_integer(index_type) else str
        identity = lambda x: number(x[len(URN) + 1 : -1]) if x and len(x) > len(URN) + 2 else None
        opened: tuple = ("", None)
        for batch in batches:
            for file, start, end, members in zip(*(c.to_pylist() for c in batch.columns)):
                if opened[0] != file:
                    fs, own = pafs.FileSystem.from_uri(file)
                    opened = file, fs.open_input_file(own)
                data = opened[1].read_at(end - start, start)
                members = iter(members)
                while some := list(islice(members, 256)):
                    out = []
                    for m in some:
                        fields, payload = parse(data[m["offset"] - start : m["offset"] - start + m["length"]])
                        revisit, digest = fields["warc-type"] == "revisit", fields["warc-payload-digest"].removeprefix("sha1:")
                        if not revisit and base32(hashlib.sha1(payload).digest()) != digest:
                            raise ValueError(f"{file}, {m['offset']}: the payload's digest is another")
                        out.append((identity(fields["warc-record-id"]), fields["warc-type"], identity(fields.get("warc-refers-to")), fields.get("warc-target-uri"), digest, None if revisit else len(payload), payload))
                    kinds = [kind, pa.string(), kind, pa.string(), pa.string(), pa.int64(), pa.binary()]
                    names = ["page_id", "record_type", "refers_to", "url", "digest", "payload_bytes", "payload"][: 7 if keep_payload else 6]
                    yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in out], kinds[k]) for k in range(len(names))], names)

    return ranges(index).mapInArrow(rows, f"page_id {key}, record_type string, refers_to {key}, url string, digest string, payload_bytes long" + ", payload binary" * keep_payload)


def round_trip(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html", least_bytes: int = 0) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to of every page, from the archives read back."""
    records = written(read(write(pages, None, id_col, url_col, payload_col, least_bytes), keep_payload=False), "records")
    full = records.filter("record_type = 'response' and page_id is not null").select(F.col("page_id").alias("named"), F.col("digest").alias("named_digest"), F.col("payload_bytes").alias("named_bytes")).distinct()
    joined = records.join(written(full, "responses"), (F.col("refers_to") == F.col("named")) & (F.col("digest") == F.col("named_digest")), "left")
    return joined.select("page_id", F.coalesce("payload_bytes", "named_bytes").alias("payload_bytes"), F.col("digest").alias("payload_digest"), "record_type", "refers_to")
