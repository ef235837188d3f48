"""Token ids, counts, packing, files and BPE against the libraries themselves."""

import hashlib
import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers as public
import pyarrow as pa
import pytest
import tiktoken
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from lexiloom.llm import byte_bpe, id_files, packing, textscan, token_counts

JSON, RANKS = public.path("byte_bpe_50k.json"), public.path("byte_bpe_50k.tiktoken")
TEXTS = ["", None, "a", "it's we'll they've I'd x'y ''s 's", "  two  spaces \n\n lines\t\tend  ", "é 日本語 ½ １ \x85 😀　x", "<|endoftext|> stays text", "word " * 5000, "a" * 3000, "same text", "same text", "\x1c\x00 control"]


@pytest.fixture(scope="module")
def library():
    t = Tokenizer.from_file(JSON)
    t.encode_special_tokens = True
    return lambda text: t.encode(text or "", add_special_tokens=False).ids


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "clash", 7) for i, t in enumerate(TEXTS)] + [(None, "no id", "clash", 7)]
    return spark.createDataFrame(rows, "doc_id long, text string, ids string, length int").repartition(3)


@pytest.fixture(scope="module")
def empty(docs):
    return docs.filter("1 = 0")


def random_texts(n, alphabet="ab 's'll'S't\n\t  \r\x85 é日本١½!'re'veX₂ 　😀é\x1c\x00"):
    r = random.Random(5)
    return ["".join(r.choice(alphabet) for _ in range(r.randint(0, 40))) for _ in range(n)]


def in_slices(codes, texts, size):
    out = []
    for piece in textscan.text_slices(pa.array(texts, pa.string()), size):
        ids, counts = codes.slice_ids(piece)
        out += np.split(ids, np.cumsum(counts)[:-1])
    return [x.tolist() for x in out]


def test_word_codes_equal_the_libraries(library):
    texts = random_texts(3000) + TEXTS
    codes = textscan.library_codes(JSON)
    assert in_slices(codes, texts, 500) == [library(t) for t in texts]
    own = tiktoken.Encoding("t", pat_str=public.PATTERN, mergeable_ranks=textscan.read_ranks(RANKS), special_tokens={})
    assert in_slices(textscan.rank_codes(RANKS, public.PATTERN), texts, 10**6) == [own.encode_ordinary(t or "") for t in texts]
    codes.limit = 10  # forgets again and again
    codes.clear()
    assert in_slices(codes, texts, 300) == [library(t) for t in texts]
    codes.limit = 2_000_000


def test_histogram(spark, docs, empty, library):
    lengths = [len(library(t)) for t in [*TEXTS, "no id"]]
    hist = token_counts.length_histogram(docs, JSON)
    for r in token_counts.with_suffix_sums(hist).collect():
        n = r.n_tokens
        assert (r.n_docs, r.docs_at_least, r.docs_at_most) == (lengths.count(n), sum(x >= n for x in lengths), sum(x <= n for x in lengths))
        assert (r.tokens_at_least, r.truncated_total) == (sum(x for x in lengths if x >= n), sum(min(x, n) for x in lengths))
    limits = spark.createDataFrame([(0,), (3,), (1000,), (10**6,), (None,)], "context long")
    for r in token_counts.answers(hist, limits).collect():
        if r.context is None:
            assert r.total_tokens is None
            continue
        assert (r.total_tokens, r.docs_over, r.truncated_total) == (sum(lengths), sum(x > r.context for x in lengths), sum(min(x, r.context) for x in lengths))
    q = {r.p: r.n_tokens for r in token_counts.quantiles(token_counts.with_suffix_sums(hist), [0.0, 0.5, 1.0]).collect()}
    assert (q[0.0], q[0.5], q[1.0]) == (min(lengths), sorted(lengths)[-(-len(lengths) // 2) - 1], max(lengths))
    assert token_counts.with_suffix_sums(token_counts.length_histogram(empty, JSON)).count() == 0
    zero = token_counts.answers(token_counts.length_histogram(empty, JSON), limits).filter("context = 3").first()
    assert (zero.total_tokens, zero.truncated_total) == (0, 0)


def check_packing(rows, wanted, capacity):
    by_doc = Counter()
    places = {}
    for r in rows:
        by_doc[r.doc_id] += r.length
        places.setdefault(r.sequence_id, []).append((r.offset, r.length))
    assert by_doc == wanted
    for p in places.values():
        at = 0
        for offset, length in sorted(p):
            assert offset == at
            at += length
        assert at <= capacity
    return len(places)


def test_packing(docs, empty, library):
    rows = packing.pack_documents(docs, JSON, 64, keep_ids=True).collect()
    wanted = Counter({i: len(library(t)) + 1 for i, t in enumerate(TEXTS)} | {None: len(library("no id")) + 1})
    bins = check_packing(rows, wanted, 64)
    assert bins <= -(-sum(wanted.values()) // 64) + 1
    for r in rows:
        ids = np.array(library("no id" if r.doc_id is None else TEXTS[r.doc_id]) + [2], "<u4")[r.start : r.start + r.length]
        assert r.ids == ids.tolist() and r.ids_crc32 == zlib.crc32(ids.tobytes())
    assert packing.pack_documents(empty, JSON).count() == 0


@pytest.mark.parametrize("seed", range(4))
def test_local_search(seed):
    r = random.Random(seed)
    counts = Counter(r.randint(1 + 30 * (seed == 3), 100) for _ in range(300))
    first = packing.best_fit(counts, 100)
    last = packing.improve(first, 100)
    total = lambda p: Counter({n: sum(x.count(n) * c for x, c in p.items()) for n in counts})
    square = lambda p: sum(sum(x) ** 2 * c for x, c in p.items())
    assert total(first) == total(last) == counts
    assert square(last) >= square(first) and last.total() <= first.total()
    assert all(sum(x) <= 100 for x in last)


def test_exchange_empties_a_bin():
    start = Counter({(60, 30): 1, (50, 40): 1, (10,): 2})
    assert packing.improve(start, 100).total() == 2


def test_search_empties_bins_that_best_fit_leaves():
    saved = 0
    for seed in range(60):
        r = random.Random(seed)
        counts = Counter(r.randint(20, 60) for _ in range(200))
        first = packing.best_fit(counts, 100)
        last = packing.improve(first, 100)
        assert last.total() <= first.total()
        saved += first.total() - last.total()
        # Nothing is left that an exchange would improve.
        bins = [p for p in last if sum(p) < 100]
        for a in bins:
            for b in bins:
                if (a != b or last[a] > 1) and sum(a) >= sum(b):
                    assert packing._better(a, b, 100) is None
    assert saved >= 10


def test_search_has_no_end_before_its_own():
    r = random.Random(1)
    counts = Counter(r.randint(1, 700) for _ in range(40_000))
    first = packing.best_fit(counts, 1024)
    last = packing.improve(first, 1024)
    assert sum(sum(p) * c for p, c in last.items()) == sum(n * c for n, c in counts.items())
    assert last.total() <= first.total()


def test_pack_with_one_length_for_most_rows(spark):
    rows = spark.range(20_000, numPartitions=7).selectExpr("id as doc_id", "case when id % 3 = 0 then 100 when id % 3 = 1 then 60 else 40 end as size", "'x' as offset", "id as _task", "id as _length", "1 as `a.b`")
    found = packing.pack(rows, 100, "size")
    assert found.columns == ["doc_id", "size", "_task", "_length", "a.b", "sequence_id", "offset"]
    bins = Counter()
    for r in found.collect():
        bins[r.sequence_id] += r["size"]
    assert len(bins) == 6667 + 6667 and max(bins.values()) == 100
    assert packing.pack(rows.filter("1 = 0"), 100, "size").count() == 0


def test_pack_refuses_wrong_lengths(spark):
    for wrong in (2000, 0, None):
        with pytest.raises(Exception, match="lengths must be"):
            packing.pack(spark.createDataFrame([(1, 0, wrong)], "doc_id long, piece int, length long"), 1024)


@pytest.mark.parametrize("top", [1, 255, 256, 70_000, 2**31])
def test_variable_length_coding(top):
    ranks = np.random.default_rng(top % 97).integers(0, top, 1001)
    for n in (0, 1, 2, 3, 4, 1001):
        control, data = id_files.pack_ids(ranks[:n])
        assert len(control) == -(-n // 4)
        assert id_files.unpack_ids(control, data, n).tolist() == ranks[:n].tolist()
    with pytest.raises(ValueError):
        id_files.unpack_ids(control, data[:-1], 1001)


@pytest.mark.parametrize("in_order", [True, False])
def test_id_files(spark, docs, empty, library, in_order):
    rows = docs.filter("doc_id is not null")
    rows = rows.coalesce(1).sortWithinPartitions("doc_id") if in_order else docs
    manifest, ranks = id_files.write_ids(rows, JSON)
    found = id_files.read_ids(manifest, ranks).orderBy(F.asc_nulls_first("doc_id")).collect()
    at, keys = 0, ([] if in_order else [None]) + list(range(len(TEXTS)))
    assert [r.doc_id for r in found] == keys
    for r in found:
        ids = np.array(library("no id" if r.doc_id is None else TEXTS[r.doc_id]) + [0], "<u4")
        assert (r.start, r.n_tokens, r.ids_crc32, r.ids) == (at, len(ids), zlib.crc32(ids.tobytes()), ids.tolist())
        at += len(ids)
    manifest, ranks = id_files.write_ids(empty, JSON)
    assert id_files.read_ids(manifest, ranks).count() == 0


def test_damaged_file_is_noticed(tmp_path):
    batch = pa.RecordBatch.from_arrays([pa.array([1]), pa.array([3]), pa.array([np.array([5, 6, 7], "<u2").tobytes()])], ["id", "n", "ids"])
    made = id_files.write_file(f"file://{tmp_path}", iter([batch]), np.arange(10, dtype=np.uint32), "<u2")
    ((table, ids),) = id_files.read_blocks(made["path"], np.arange(10, dtype=np.uint32))
    assert ids.tolist() == [5, 6, 7] and table["id"].to_pylist() == [1]
    path = tmp_path / made["path"].rpartition("/")[2]
    raw = bytearray(path.read_bytes())
    raw[-1] ^= 1
    path.write_bytes(raw)
    with pytest.raises(ValueError):
        list(id_files.read_blocks(made["path"], np.arange(10, dtype=np.uint32)))


def test_byte_bpe(docs, empty):
    own = tiktoken.Encoding("t", pat_str=public.PATTERN, mergeable_ranks=textscan.read_ranks(RANKS), special_tokens={})
    text = lambda k: "no id" if k is None else TEXTS[k] or ""
    coded = byte_bpe.encode(docs, RANKS, public.PATTERN)
    for r in coded.collect():
        assert r.ids == own.encode_ordinary(text(r.doc_id))
    for r in byte_bpe.decode(coded, RANKS).collect():
        assert bytes(r.data) == text(r.doc_id).encode()
    for r in byte_bpe.round_trip(docs, RANKS, public.PATTERN).collect():
        ids = np.array(own.encode_ordinary(text(r.doc_id)), "<u4")
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (len(ids), hashlib.sha256(ids.tobytes()).hexdigest(), hashlib.sha256(text(r.doc_id).encode()).hexdigest())
    assert byte_bpe.round_trip(empty, RANKS, public.PATTERN).count() == 0


def test_byte_bpe_in_small_blocks_with_salted_words(docs):
    own = tiktoken.Encoding("t", pat_str=public.PATTERN, mergeable_ranks=textscan.read_ranks(RANKS), special_tokens={})
    many = docs.union(docs).union(docs)
    text = lambda k: "no id" if k is None else TEXTS[k] or ""
    for often in (1, 1_000_000):
        rows = byte_bpe.exploded(many, RANKS, public.PATTERN, block_chars=50, often=often)
        packs = rows.collect()
        assert len({r.block for r in packs}) > 6
        words = [(r.bucket, w) for r in packs if r.kind == byte_bpe.WORDS for w in split_words(bytes(r.pack))]
        assert sum(w == b" word" for _, w in words) == 3  # of 14,997 occurrences
        assert (len(set(words)) == len({w for _, w in words})) == (often == 1)  # rare words have one bucket, frequent ones more
        found = byte_bpe.reassembled(byte_bpe.coded_words(rows, RANKS, public.PATTERN), "long").collect()
        assert Counter(r.doc_id for r in found) == Counter({k: 3 for k in [None, *range(len(TEXTS))]})
        assert all(np.frombuffer(r.ids, "<u4").tolist() == own.encode_ordinary(text(r.doc_id)) for r in found)


def split_words(pack):
    flat, sizes, _ = byte_bpe._unpacked(pack)
    return [w.tobytes() for w in np.split(flat, np.cumsum(sizes)[:-1])]


def test_byte_bpe_has_no_other_source_of_ids(docs):
    coded = byte_bpe.coded_words(byte_bpe.exploded(docs, RANKS, public.PATTERN), RANKS, public.PATTERN)
    with pytest.raises(Exception, match="positions wait for"):
        byte_bpe.reassembled(coded.filter("kind > 0 or length(pack) % 2 = 0"), "long").collect()
    with pytest.raises(Exception, match="token table lacks"):
        byte_bpe.decode(docs.select("doc_id", F.array(F.lit(50_300)).alias("ids")), RANKS).collect()


@pytest.mark.parametrize("top", [1, 127, 128, 1 << 14, 1 << 40])
def test_varints(top):
    for n in (0, 1, 500):
        values = np.random.default_rng(n).integers(0, top, n, endpoint=True)
        raw, widths = byte_bpe.to_varints(values)
        again, ends = byte_bpe.from_varints(raw)
        assert again.tolist() == values.tolist() and np.cumsum(widths).tolist() == ends.tolist()
