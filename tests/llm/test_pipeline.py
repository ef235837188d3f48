"""The corpus pipeline: each stage against brute force over the documents that the stage before kept."""

from collections import Counter

import psutil
import public_tokenizers as public
import pytest
from pyspark.sql import functions as F
from test_documents import brute_components, brute_spans
from test_tokens import check_packing
from tokenizers import Tokenizer

import corpus_pipeline
from lexiloom.llm import pii, quality, toxicity

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, kept int, _text string"
ODD = [(None, None, None, None, None, 1, "x"), (7001, "", "en", "s", 0, 2, None), (7002, None, "en", None, 0, 2, "y"), (7003, "one", None, "s", 3, None, "z"), (7004, "+1 202 555 0100 " * 4000, "en", "s", 1, 1, "")]


@pytest.fixture(scope="module")
def stages(spark, sf):
    """The rows before and after each stage."""
    docs = spark.read.parquet(f"{sf}/documents.parquet").withColumn("kept", F.lit(1)).withColumn("_text", F.lit("x"))
    at = docs.union(spark.createDataFrame(ODD, SCHEMA)).union(docs.filter("doc_id % 40 = 0")).cache()
    out = {}
    for name, stage in corpus_pipeline.STAGES:
        after = stage(spark, at, sf).cache()
        out[name] = (at, after)
        at = after
    return out


def rows(df):
    return Counter(tuple(r) for r in df.collect())


def test_names_and_columns(stages):
    assert list(stages) == ["toxicity", "quality rules", "MinHash near-dedup", "PII", "best-fit packing"]
    for name, (before, after) in list(stages.items())[:-1]:
        assert after.columns == before.columns, name
        if name != "PII":
            assert rows(after) <= rows(before), name


def test_toxic_documents_go(spark, stages, sf):
    before, after = stages["toxicity"]
    tagger = toxicity.train(before, spark.read.parquet(f"{sf}/labels.parquet"))
    scores = toxicity.score(before.select(F.monotonically_increasing_id().alias("doc_id"), "text"), tagger)
    assert after.count() == scores.filter("predicted = 0").count()
    texts = before.select(F.monotonically_increasing_id().alias("k"), "text").join(scores.filter("predicted = 1").select(F.col("doc_id").alias("k")), "k")
    gone = Counter(r.text for r in texts.collect())
    assert gone == Counter(r.text for r in before.collect()) - Counter(r.text for r in after.collect())


def test_bad_documents_go(stages):
    before, after = stages["quality rules"]
    judged = quality.judged(before.withColumn("doc_id", F.monotonically_increasing_id()), base_rules=False)
    assert after.count() == judged.filter("kept").count()
    assert all(r.text and r.text.strip() for r in after.collect())


def test_one_of_each_group_stays(stages):
    before, after = stages["MinHash near-dedup"]
    known = [r for r in before.collect() if r.doc_id is not None]
    known.sort(key=lambda r: r.doc_id)
    _, roots = brute_components([r.text for r in known], 5, 80)
    ids = [r.doc_id for r in known]
    stay = {ids[i] for i in range(len(ids)) if roots[i] == i or ids[roots[i]] == ids[i]}
    assert {r.doc_id for r in after.collect() if r.doc_id is not None} == stay


def test_personal_data_is_masked(stages):
    before, after = stages["PII"]
    found = {r.doc_id: r for r in pii.found(before).collect()}
    masked = {r.doc_id: r.text for r in after.collect()}
    for b in before.collect():
        if found[b.doc_id].n_found == 0:
            out, at, reach = "", 0, []
            for kind, x, y in sorted(brute_spans(b.text or ""), key=lambda s: (s[1], s[2], s[0])):
                if reach and x < reach[-1][2]:
                    reach[-1][2] = max(reach[-1][2], y)
                else:
                    reach.append([kind, x, y])
            for kind, x, y in reach:
                out, at = out + (b.text or "")[at:x] + f"<{pii.KINDS[kind].upper()}>", y
            assert masked[b.doc_id] == (None if b.text is None else out + b.text[at:])


def test_everything_is_packed(stages):
    before, after = stages["best-fit packing"]
    library = Tokenizer.from_file(public.path("byte_bpe_50k.json"))
    library.encode_special_tokens = True
    wanted = Counter()
    for r in before.collect():
        wanted[r.doc_id] += len(library.encode(r.text or "", add_special_tokens=False).ids) + 1
    bins = check_packing(after.collect(), wanted, 1024)
    assert bins <= -(-sum(wanted.values()) // 1024) + 2


def test_empty_tables(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").filter("1 = 0")
    assert all(stage(spark, docs, sf).count() == 0 for _, stage in corpus_pipeline.STAGES)


def test_run(spark, sf):
    found = corpus_pipeline.run(spark, sf)
    assert {"doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"} <= set(found.columns) and found.count() > 0


def test_workers_give_freed_memory_back_when_a_task_ends():
    from lexiloom.llm.textscan import releasing

    seen = []

    def work(batches):
        for n in batches:
            held = [bytes(2000) for _ in range(n)]
            seen.append(psutil.Process().memory_info().rss)
            keep = held[::1000]  # what stays splits what was freed
            del held
            yield keep

    kept = list(releasing(work)(iter([100_000])))
    assert len(kept[0]) == 100 and seen[0] - psutil.Process().memory_info().rss > 100e6


def test_not_toxic_sends_texts_once_and_in_slices(spark):
    docs = spark.createDataFrame([(i, f"text {i} " * 9000) for i in range(20)] + [(20, None), (21, "")], "doc_id long, text string").coalesce(1)
    kept = toxicity.not_toxic(docs, toxicity.Tagger())
    assert kept.schema == docs.schema and sorted(kept.collect(), key=lambda r: r.doc_id) == docs.collect()
    assert "_text" not in kept._jdf.queryExecution().optimizedPlan().toString()
    raw = toxicity.not_toxic(docs.withColumn("text", F.col("text").cast("binary")), toxicity.Tagger())
    assert raw.select("doc_id", F.col("text").cast("string")).orderBy("doc_id").collect() == docs.collect()
