"""Texts stored as TIFF images and read back: a lossless round trip with digests and features.

A text's UTF-8, with spaces up to a positive multiple of 192 bytes, is rows of 64 RGB pixels; pages
have at most 512 rows.  The payload's crc32 and the page's number choose byte order, compression, predictor and layout,
so equal texts have equal files.

Cases: a null text is an empty one; repeated rows and ids are stored each; very long texts are many pages of one
file, encoded and read page by page; an empty table gives no rows; other columns are not read, whatever their names.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import tiff
from .tokenizing import id_type

ROW, PAGE_ROWS = 192, 512
KINDS = [(tiff.PACKBITS, 1, False), (tiff.LZW, 1, False), (tiff.DEFLATE, 2, False), (tiff.PACKBITS, 1, True), (tiff.LZW, 2, True), (tiff.DEFLATE, 1, True)]


def stored(text: bytes) -> bytes:
    payload = text.ljust(max(1, -(-len(text) // ROW)) * ROW)
    image = np.frombuffer(payload, np.uint8).reshape(-1, ROW // 3, 3)
    images = [image[i : i + PAGE_ROWS] for i in range(0, len(image), PAGE_ROWS)]
    crc = zlib.crc32(payload)
    return tiff.write(images, [KINDS[(crc + k) % len(KINDS)] for k in range(len(images))], "<>"[crc >> 8 & 1])


def _stored_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i in range(0, batch.num_rows, 256):
            part = batch.slice(i, 256)
            texts = [(t or "").encode() for t in part.column(1).to_pylist()]
            media = [stored(t) for t in texts]
            numbers = pa.array(range(len(texts)), pa.int64())
            yield pa.RecordBatch.from_arrays([numbers, part.column(0), pa.array(list(map(len, texts)), pa.int64()), pa.array(media, pa.binary()), pa.array([len(m) for m in media], pa.int64()), pa.array([hashlib.sha256(m).hexdigest() for m in media])], ["_row", "doc_id", "n_bytes", "media", "media_bytes", "media_sha256"])


def _feature(images: list[np.ndarray]) -> str:
    """Pages, rows, mean of each channel, and an 8 * 8 average hash of the whole."""
    image = np.concatenate(images)
    sums = image.sum(axis=(0, 1), dtype=np.int64)
    means = sums * 100 // (image.shape[0] * image.shape[1])
    grey = image.sum(axis=2, dtype=np.int64).reshape(image.shape[0], 8, -1).sum(axis=2)
    bounds = np.arange(8) * len(grey) // 8
    cells = np.add.reduceat(grey, bounds, axis=0) / np.maximum(np.diff(np.append(bounds, len(grey))), 1)[:, None]
    bits = np.packbits(cells > cells.mean()).tobytes().hex()
    return f"{len(images)}:{image.shape[0]}:{means[0]},{means[1]},{means[2]}:{bits}"


def _digest_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per medium of its pages, which follow each other."""
    names = ["doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature"]
    open_, pages, out, keys = None, [], [], []

    def close():
        payload = b"".join(p["data"] for p in pages)
        images = [np.frombuffer(p["data"], np.uint8).reshape(p["height"], p["width"], p["samples"]) for p in pages]
        keys.append(pages[0]["doc_id"])
        out.append((pages[0]["n_bytes"], len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-16:]), pages[0]["media_bytes"], pages[0]["media_sha256"], _feature(images)))

    def flush(kind):
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string()]
        return pa.RecordBatch.from_arrays([pa.array(keys, kind), *(pa.array([x[k] for x in out], t) for k, t in enumerate(kinds))], names)

    kind = None
    for batch in batches:
        kind = batch.schema.field("doc_id").type
        for row in batch.to_pylist():
            if row["error"]:
                raise ValueError(f"a stored medium can't be read: {row['error']}")
            if row["page"] == 0 and pages:
                close()
                pages = []
            pages.append(row)
        if len(out) >= 256:
            yield flush(kind)
            out.clear(), keys.clear()
    if pages:
        close()
    if out:
        yield flush(kind)


def media(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, media: the file of each text."""

    def rows(batches):
        for batch in _stored_batches(batches):
            yield batch.select(["doc_id", "media"])

    source = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    return source.mapInArrow(rows, f"doc_id {id_type(docs, id_col)}, media binary")


def round_trip(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Stores each text, reads its pages with ``tiff.page_batches`` and returns their digests and features."""
    source = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    schema = f"doc_id {id_type(docs, id_col)}, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string"
    return source.mapInArrow(lambda batches: _digest_batches(tiff.page_batches(_stored_batches(batches))), schema)
