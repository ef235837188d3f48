"""TIFF and WARC: exact round trips, damage, odd rows."""

import base64
import hashlib
import zlib

import numpy as np
import pytest

from lexiloom.llm import text_media, tiff, warc

RNG = np.random.default_rng(0)
BYTES = [b"", b"a", b"aaaaaaaaaa" * 100, RNG.integers(0, 256, 20000, dtype=np.uint8).tobytes(), b"ababab" * 5000, bytes(30000), RNG.integers(0, 3, 60000, dtype=np.uint8).tobytes()]


@pytest.mark.parametrize("data", BYTES, ids=len)
def test_coders(data):
    assert tiff.lzw_decode(tiff.lzw_encode(data)) == data
    assert tiff.packbits_decode(tiff.packbits_encode(data)) == data


def test_known_packbits():
    packed = bytes.fromhex("FEAA0280002AFDAA0380002A22F7AA")  # the example of the format's description
    assert tiff.packbits_decode(packed) == bytes.fromhex("AAAAAA80002AAAAAAAAA80002A22AAAAAAAAAAAAAAAAAAAA")


@pytest.mark.parametrize("order", "<>")
@pytest.mark.parametrize("compression", [1, 5, 8, 32773])
@pytest.mark.parametrize("predictor", [1, 2])
@pytest.mark.parametrize("tiled", [False, True])
def test_pages(order, compression, predictor, tiled):
    images = [RNG.integers(0, 256, shape, dtype=np.uint8) for shape in ((1, 1, 1), (70, 65, 3), (130, 200, 4))]
    found = list(tiff.read(tiff.write(images, [(compression, predictor, tiled)] * 3, order)))
    assert [(p.number, p.height, p.width, p.samples) for p in found] == [(i, *x.shape) for i, x in enumerate(images)]
    assert [p.data for p in found] == [x.tobytes() for x in images]


def test_wide_samples_and_float_predictor():
    wide = RNG.integers(0, 65536, (3, 5, 2)).astype(">u2")
    steps = np.concatenate([wide[:, :1], wide[:, 1:] - wide[:, :-1]], axis=1).astype(">u2")
    rows = np.frombuffer(steps.tobytes(), np.uint8).reshape(3, 5, 4)
    assert tiff._unpredicted(rows, 2, 2, ">").tobytes() == wide.astype("<u2").tobytes()
    real = RNG.normal(size=(2, 4)).astype(">f4")
    planes = np.frombuffer(real.tobytes(), np.uint8).reshape(2, 4, 4).transpose(0, 2, 1).reshape(2, 16)
    coded = np.concatenate([planes[:, :1], planes[:, 1:] - planes[:, :-1]], axis=1).reshape(2, 4, 4)
    assert tiff._unpredicted(np.ascontiguousarray(coded), 3, 4, ">").tobytes() == real.astype("<f4").tobytes()


def test_odd_media(spark):
    good = tiff.write([np.zeros((2, 2, 1), np.uint8)] * 2, [(5, 1, False)] * 2)
    loop = bytearray(good)
    first = int.from_bytes(good[4:8], "little")
    n = int.from_bytes(good[first : first + 2], "little")
    loop[first + 2 + 12 * n : first + 6 + 12 * n] = good[4:8]
    rows = [(1, good), (2, None), (3, b""), (4, b"not an image"), (5, good[: len(good) - 30]), (6, bytes(loop)), (1, good)]
    df = spark.createDataFrame(rows, "k int, media binary").repartition(2)
    found = {}
    for r in tiff.pages(df, keep=("k",)).collect():
        found.setdefault(r.k, []).append((r.page, r.error is None))
    assert sorted(found[1]) == [(0, True), (0, True), (1, True), (1, True)]
    assert all(found[k] == [(None, False)] for k in (2, 3, 4)) and found[5][-1] == (None, False) and found[6][0] == (0, True)
    assert tiff.pages(df.filter("1 = 0")).count() == 0
    with pytest.raises(ValueError):
        tiff.pages(df.withColumnRenamed("k", "page"), keep=("page",))


def test_text_round_trip(spark):
    texts = ["", None, "x" * 191, "x" * 192, "x" * 193, "é日😀 " * 9000, "the quick brown fox " * 9000, "x" * 192]
    df = spark.createDataFrame([(i, t, 1) for i, t in enumerate(texts)] + [(None, "n", 1)], "doc_id long, text string, feature int").repartition(3)
    found = text_media.round_trip(df).collect()
    assert len(found) == len(texts) + 1
    for r in found:
        raw = ((texts[r.doc_id] if r.doc_id is not None else "n") or "").encode()
        payload = raw.ljust(max(1, -(-len(raw) // 192)) * 192)
        assert (r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32) == (len(raw), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-16:]))
    by = {r.doc_id: (r.media_bytes, r.media_sha256, r.feature) for r in found}
    assert by[3] == by[7] and by[0] == by[1]
    stored = {r.doc_id: bytes(r.media) for r in text_media.media(df).collect()}
    assert len(stored[6]) == by[6][0] and len(list(tiff.read(stored[6]))) == -(-len(texts[6]) // 192 // 512)
    assert text_media.round_trip(df.filter("1 = 0")).count() == 0


def html_rows():
    rows = [(i, f"http://x/{i}", f"<p>{i % 7}</p>" * (i % 5)) for i in range(60)]
    return rows + [(100, None, None), (101, "http://y/\r\nz", ""), (102, "u", "é" * 5000), (None, "n", "<p>1</p>"), (7, "http://x/7", "<p>0</p>" * 2)]


@pytest.mark.parametrize("least", [0, 10])
def test_warc_round_trip(spark, least):
    rows = html_rows()
    df = spark.createDataFrame([(*r, "x") for r in rows], "page_id long, url string, html string, digest string").repartition(4)
    largest = {}
    for k, _, h in rows:
        if k is not None:
            largest[h or ""] = max(largest.get(h or "", -1), k)
    found = warc.round_trip(df, least_bytes=least).collect()
    assert len(found) == len(rows)
    wanted = sorted(str((k, len((h or "").encode()), base64.b32encode(hashlib.sha1((h or "").encode()).digest()).decode(), largest.get(h or "") if k is not None and len((h or "").encode()) >= least and largest[h or ""] != k else None)) for k, _, h in rows if k is not None)
    assert sorted(str((r.page_id, r.payload_bytes, r.payload_digest, r.refers_to)) for r in found if r.page_id is not None) == wanted
    assert all((r.record_type == "revisit") == (r.refers_to is not None) for r in found)


def test_warc_selection(spark):
    df = spark.createDataFrame(html_rows(), "page_id long, url string, html string").filter("page_id is not null").coalesce(1)
    index = warc.write(df)
    some = index.filter("page_id % 3 = 0")
    found = {r.page_id: r for r in warc.read(some).collect()}
    wanted = {r[0]: r for r in html_rows() if r[0] is not None and r[0] % 3 == 0}
    assert set(found) == set(wanted)
    for k, r in found.items():
        if r.record_type == "response":
            assert bytes(r.payload) == (wanted[k][2] or "").encode()
    assert warc.ranges(some, gap=1 << 20).count() == 1 < warc.ranges(some, gap=0).count()
    assert warc.read(index.filter("1 = 0")).count() == 0
    assert warc.round_trip(df.filter("1 = 0")).count() == 0
