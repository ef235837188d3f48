"""TIFF media columns: one row per page, with the samples decoded.

``pages`` walks the image directories of classic TIFF files (either byte order), undoes PackBits, LZW
and deflate in strips or tiles, chunky or planar, and the horizontal (2) and floating-point (3)
predictors.  Samples are whole bytes wide; wider ones come out little-endian.  ``write`` makes such
files of 8-bit samples.

Cases: a null medium or an empty one has no pages and gives one row with a null page and ``error``; so does one that
can't be read, after those of its pages that can; directories that form a loop are an
error; repeated rows give their pages each; other columns are kept only if asked for.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed values of the TIFF 6.0 format.
WIDTH, HEIGHT, BITS, COMPRESSION, PHOTOMETRIC, STRIP_OFFSETS, SAMPLES, ROWS_PER_STRIP, STRIP_BYTES, PLANAR, PREDICTOR, TILE_WIDTH, TILE_HEIGHT, TILE_OFFSETS, TILE_BYTES, SAMPLE_FORMAT = 256, 257, 258, 259, 262, 273, 277, 278, 279, 284, 317, 322, 323, 324, 325, 339
NONE, LZW, DEFLATE, PACKBITS, OLD_DEFLATE = 1, 5, 8, 32773, 32946
KINDS = {1: "B", 2: "B", 3: "H", 4: "I", 6: "b", 7: "B", 8: "h", 9: "i", 11: "f", 12: "d", 5: "II", 10: "ii"}
CLEAR, END, FIRST, LAST = 256, 257, 258, 4093  # LZW codes; a writer clears the table after entry LAST


@dataclass
class Page:
    number: int
    width: int
    height: int
    bits: int
    samples: int
    compression: int
    predictor: int
    tiled: bool
    data: bytes  # rows of pixels of samples


def _code_widths(n: int) -> np.ndarray:
    """Bits of the code at each place after a clear: the table has FIRST + i - 1 entries, and widths change one early."""
    return np.searchsorted([511, 1023, 2047], FIRST - 1 + np.arange(n), "right").astype(np.int64) + 9


_WIDTHS = _code_widths(LAST - FIRST + 8)
_STARTS = np.append(0, np.cumsum(_WIDTHS))


def lzw_decode(data: bytes) -> bytes:
    """Codes after a clear lie at fixed bits, and each entry is a stretch of what was put out before."""
    raw = np.frombuffer(data + bytes(8), np.uint8).astype(np.uint64)
    word = raw[:-3] << np.uint64(24) | raw[1:-2] << np.uint64(16) | raw[2:-1] << np.uint64(8) | raw[3:]
    bits, at, out = 8 * len(data), 0, bytearray()
    while at < bits:
        begin = at + _STARTS[:-1]
        n = int(np.searchsorted(begin + _WIDTHS, bits, "right"))
        if not n:
            break
        begin = begin[:n]
        shift = 32 - _WIDTHS[:n] - (begin & 7)
        codes = (word[begin >> 3] >> shift.astype(np.uint64) & ((1 << _WIDTHS[:n]) - 1).astype(np.uint64)).tolist()
        places, lengths, put, stop = [], [], len(out), False
        for i, c in enumerate(codes):
            if c < 256:
                out.append(c)
                places.append(put)
                lengths.append(1)
                put += 1
            elif c >= FIRST:
                j = c - FIRST
                if j >= i:
                    raise ValueError("an LZW code comes before its entry")
                if i > LAST - FIRST + 4:
                    raise ValueError("the LZW table is full")
                a, k = places[j], lengths[j] + 1
                if a + k > put:
                    out += out[a:put] + out[a : a + 1]
                else:
                    out += out[a : a + k]
                places.append(put)
                lengths.append(k)
                put += k
            else:
                stop = c == END
                at = int(begin[i] + _WIDTHS[i])
                break
        else:
            break
        if stop:
            break
    return bytes(out)


def lzw_encode(data: bytes) -> bytes:
    codes, widths = [CLEAR], [np.array([9])]
    table: dict[int, int] = {}
    entry, since, prefix = FIRST, 0, -1
    find, add = table.get, codes.append
    for b in data:
        if prefix < 0:
            prefix = b
            continue
        key = prefix << 8 | b
        known = find(key)
        if known is not None:
            prefix = known
            continue
        add(prefix)
        since += 1
        table[key] = entry
        entry += 1
        prefix = b
        if entry > LAST:
            add(CLEAR)
            widths.append(_WIDTHS[: since + 1])
            table.clear()
            entry, since = FIRST, 0
    if prefix >= 0:
        add(prefix)
        since += 1
    add(END)
    widths.append(_WIDTHS[: since + 1])
    width = np.concatenate(widths)
    bits = np.unpackbits(np.array(codes, ">u2").view(np.uint8).reshape(-1, 2), axis=1)
    return np.packbits(bits[np.arange(16) >= 16 - width[:, None]]).tobytes()


def packbits_decode(data: bytes) -> bytes:
    out, i, n = [], 0, len(data)
    while i < n:
        k = data[i]
        if k < 128:
            out.append(data[i + 1 : i + 2 + k])
            i += k + 2
        else:
            if k > 128:
                out.append(data[i + 1 : i + 2] * (257 - k))
            i += 2 if k > 128 else 1
    return b"".join(out)


def packbits_encode(data: bytes) -> bytes:
    """Runs of three and more as repeats, the rest literally."""
    raw = np.frombuffer(data, np.uint8)
    starts = np.append(0, np.flatnonzero(raw[1:] != raw[:-1]) + 1) if len(raw) else np.zeros(0, np.int64)
    lengths = np.diff(np.append(starts, len(raw)))
    long = lengths > 2
    out, at = [], 0
    for a, n in [*zip(starts[long].tolist(), lengths[long].tolist()), (len(raw), 0)]:
        for i in range(at, a, 128):
            part = data[i : min(i + 128, a)]
            out += [bytes([len(part) - 1]), part]
        for i in range(0, n, 128):
            k = min(128, n - i)
            out += [bytes([257 - k if k > 1 else 0]), data[a : a + 1]]
        at = a + n
    return b"".join(out)


def _undone(part: bytes, compression: int) -> bytes:
    if compression == NONE:
        return part
    if compression == LZW:
        return lzw_decode(part)
    if compression in (DEFLATE, OLD_DEFLATE):
        return zlib.decompress(part)
    if compression == PACKBITS:
        return packbits_decode(part)
    raise ValueError(f"compression {compression} is not supported")


def _unpredicted(rows: np.ndarray, predictor: int, size: int, order: str) -> np.ndarray:
    """rows: height, width, samples * size of bytes; returns little-endian bytes of the same shape."""
    h, w, depth = rows.shape
    if predictor == 3:
        raw = np.cumsum(rows.reshape(h, -1, depth // size), axis=1, dtype=np.uint8).reshape(h, size, -1)
        return np.ascontiguousarray(raw[:, ::-1].transpose(0, 2, 1)).reshape(h, w, depth)
    if size == 1:
        return np.cumsum(rows, axis=1, dtype=np.uint8) if predictor == 2 else rows
    values = np.ascontiguousarray(rows).view(f"{order}u{size}")
    if predictor == 2:
        values = np.cumsum(values, axis=1, dtype=f"u{size}")
    return np.ascontiguousarray(values.astype(f"<u{size}")).view(np.uint8)


def read(data: bytes) -> Iterator[Page]:
    """The pages of a file in the order of its directories."""
    order = {b"II": "<", b"MM": ">"}.get(data[:2])
    if not order or len(data) < 8 or struct.unpack_from(f"{order}H", data, 2)[0] != 42:
        raise ValueError("not a classic TIFF file")
    (at,), seen, number = struct.unpack_from(f"{order}I", data, 4), set(), 0
    while at:
        if at in seen:
            raise ValueError("the directories form a loop")
        seen.add(at)
        (n,) = struct.unpack_from(f"{order}H", data, at)
        tags: dict[int, tuple] = {}
        for i in range(n):
            tag, kind, count = struct.unpack_from(f"{order}HHI", data, at + 2 + 12 * i)
            if kind in KINDS:
                form = f"{order}{KINDS[kind] * count}" if len(KINDS[kind]) > 1 else f"{order}{count}{KINDS[kind]}"
                where = at + 10 + 12 * i
                if struct.calcsize(form) > 4:
                    (where,) = struct.unpack_from(f"{order}I", data, where)
                tags[tag] = struct.unpack_from(form, data, where)
        yield _page(data, tags, order, number)
        (at,) = struct.unpack_from(f"{order}I", data, at + 2 + 12 * n)
        number += 1


def _page(data: bytes, tags: dict[int, tuple], order: str, number: int) -> Page:
    one = lambda tag, default=None: tags[tag][0] if tag in tags else default
    width, height, samples = one(WIDTH), one(HEIGHT), one(SAMPLES, 1)
    bits, compression, predictor = one(BITS, 1), one(COMPRESSION, NONE), one(PREDICTOR, 1)
    if not width or not height:
        raise ValueError("a page without width or height")
    if bits % 8 or len(set(tags.get(BITS, (bits,)))) > 1 or bits > 64 or bits == 24:
        raise ValueError(f"samples of {tags.get(BITS, (bits,))} bits are not supported")
    if predictor not in (1, 2, 3) or predictor == 3 and bits == 8:
        raise ValueError(f"predictor {predictor} is not supported for {bits} bits")
    tiled = TILE_OFFSETS in tags
    planes = samples if one(PLANAR, 1) == 2 else 1
    size, depth = bits // 8, samples // planes * (bits // 8)
    part_w, part_h = (one(TILE_WIDTH), one(TILE_HEIGHT)) if tiled else (width, min(one(ROWS_PER_STRIP, height), height))
    offsets, counts = tags[TILE_OFFSETS if tiled else STRIP_OFFSETS], tags[TILE_BYTES if tiled else STRIP_BYTES]
    across, down = -(-width // part_w), -(-height // part_h)
    if len(offsets) < planes * across * down or len(counts) < planes * across * down:
        raise ValueError("there are strips or tiles missing")
    image = np.empty((height, width, planes, depth), np.uint8)
    for k in range(planes * across * down):
        plane, y, x = k // (across * down), k // across % down * part_h, k % across * part_w
        rows = part_h if tiled else min(part_h, height - y)
        raw = _undone(data[offsets[k] : offsets[k] + counts[k]], compression)
        if len(raw) < rows * part_w * depth:
            raise ValueError("a strip or tile is too short")
        part = np.frombuffer(raw, np.uint8, rows * part_w * depth).reshape(rows, part_w, depth)
        part = _unpredicted(part, predictor, size, order)
        image[y : y + rows, x : x + part_w, plane] = part[: height - y, : width - x]
    return Page(number, width, height, bits, samples, compression, predictor, tiled, image.tobytes())


def write(images: list[np.ndarray], how: list[tuple[int, int, bool]], order: str = "<", rows_per_strip: int = 64, tile: int = 64) -> bytes:
    """A file of 8-bit images (height, width, samples); how: compression, predictor, tiled of each."""
    out = bytearray(struct.pack(f"{order}2sHI", b"II" if order == "<" else b"MM", 42, 0))
    link = 4
    for image, (compression, predictor, tiled) in zip(images, how):
        h, w, samples = image.shape
        parts = []
        if tiled:
            for y in range(0, h, tile):
                for x in range(0, w, tile):
                    part = image[y : y + tile, x : x + tile]
                    parts.append(np.pad(part, ((0, tile - part.shape[0]), (0, tile - part.shape[1]), (0, 0)), "edge"))
        else:
            parts = [image[y : y + rows_per_strip] for y in range(0, h, rows_per_strip)]
        offsets, counts = [], []
        for part in parts:
            if predictor == 2:
                part = np.concatenate([part[:, :1], part[:, 1:] - part[:, :-1]], axis=1)
            raw = part.tobytes()
            raw = {NONE: bytes, LZW: lzw_encode, DEFLATE: zlib.compress, PACKBITS: packbits_encode}[compression](raw)
            offsets.append(len(out))
            counts.append(len(raw))
            out += raw + bytes(len(raw) & 1)
        tags = [(WIDTH, "I", [w]), (HEIGHT, "I", [h]), (BITS, "H", [8] * samples), (COMPRESSION, "H", [compression]), (PHOTOMETRIC, "H", [2 if samples == 3 else 1])]
        tags += [] if tiled else [(STRIP_OFFSETS, "I", offsets)]
        tags += [(SAMPLES, "H", [samples])]
        tags += [] if tiled else [(ROWS_PER_STRIP, "I", [rows_per_strip]), (STRIP_BYTES, "I", counts)]
        tags += [(PLANAR, "H", [1]), (PREDICTOR, "H", [predictor])]
        tags += [(TILE_WIDTH, "I", [tile]), (TILE_HEIGHT, "I", [tile]), (TILE_OFFSETS, "I", offsets), (TILE_BYTES, "I", counts)] if tiled else []
        entries = b""
        for tag, kind, values in tags:
            raw = struct.pack(f"{order}{len(values)}{kind}", *values)
            if len(raw) > 4:
                place = len(out)
                out += raw + bytes(len(raw) & 1)
                raw = struct.pack(f"{order}I", place)
            entries += struct.pack(f"{order}HHI", tag, 3 if kind == "H" else 4, len(values)) + raw.ljust(4, b"\0")
        struct.pack_into(f"{order}I", out, link, len(out))
        out += struct.pack(f"{order}H", len(tags)) + entries
        link = len(out)
        out += bytes(4)
    return bytes(out)


PAGE_FIELDS = [("page", pa.int32()), ("width", pa.int64()), ("height", pa.int64()), ("bits", pa.int32()), ("samples", pa.int32()), ("compression", pa.int32()), ("predictor", pa.int32()), ("tiled", pa.bool_()), ("data", pa.binary()), ("error", pa.string())]
PAGE_DDL = "page int, width long, height long, bits int, samples int, compression int, predictor int, tiled boolean, data binary, error string"
BATCH_BYTES = 8 << 20


def page_batches(batches: Iterator[pa.RecordBatch], media: str = "media") -> Iterator[pa.RecordBatch]:
    """For rows with a column of files: their other columns once a page, and the page's fields."""
    for batch in batches:
        where = batch.schema.get_field_index(media)
        others = [i for i in range(batch.num_columns) if i != where]
        source, found, held = [], [], 0

        def flush():
            kept = [batch.column(i).take(pa.array(source, pa.int64())) for i in others]
            made = [pa.array([x[k] for x in found], kind) for k, (_, kind) in enumerate(PAGE_FIELDS)]
            return pa.RecordBatch.from_arrays(kept + made, [batch.schema.names[i] for i in others] + [n for n, _ in PAGE_FIELDS])

        for row in range(batch.num_rows):
            file = batch.column(where)[row].as_py()
            try:
                if not file:
                    raise ValueError("no medium")
                for p in read(file):
                    source.append(row)
                    found.append((p.number, p.width, p.height, p.bits, p.samples, p.compression, p.predictor, p.tiled, p.data, None))
                    held += len(p.data)
            except (ValueError, struct.error, zlib.error, KeyError, OverflowError, MemoryError, IndexError) as wrong:
                source.append(row)
                found.append((None,) * 9 + (str(wrong)[:200],))
            if held >= BATCH_BYTES:
                yield flush()
                source, found, held = [], [], 0
        if source:
            yield flush()


def pages(df: DataFrame, media_col: str = "media", keep: tuple[str, ...] = ()) -> DataFrame:
    """The columns of ``keep`` and the page's: page, width, height, bits, samples, compression, predictor, tiled, data, error."""
    clash = set(keep) & {n for n, _ in PAGE_FIELDS}
    if clash:
        raise ValueError(f"rename the columns {sorted(clash)} first")
    kept = ", ".join(f"`{c}` {df.schema[c].dataType.simpleString()}" for c in keep)
    rows = df.select(*keep, F.col(media_col).cast("binary").alias("_media"))
    return rows.mapInArrow(lambda batches: page_batches(batches, "_media"), f"{kept}, {PAGE_DDL}" if keep else PAGE_DDL)
