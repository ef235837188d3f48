"""The queries of this subpackage, with their production parameters, and their SQL."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from . import byte_bpe, id_files, near_dedup, packing, pii, quality, text_media, token_counts, toxicity, warc

JSON = public_tokenizers.path("byte_bpe_50k.json")
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_tiff_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    return text_media.round_trip(_table(spark, sf_dir, "documents"))


def op2_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(_table(spark, sf_dir, "documents"), width=2, percent=80)


def op3_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(_table(spark, sf_dir, "documents"), JSON)


def op4_quality_votes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judged(_table(spark, sf_dir, "documents"))


def op5_pii_bootstrap(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.found(_table(spark, sf_dir, "documents"))


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.with_suffix_sums(token_counts.length_histogram(_table(spark, sf_dir, "documents"), JSON))


def op7_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_bpe.round_trip(_table(spark, sf_dir, "documents"), RANKS, public_tokenizers.PATTERN)


def op8_id_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    manifest, ranks = id_files.write_ids(_table(spark, sf_dir, "documents"), JSON)
    return id_files.read_ids(manifest, ranks, keep_ids=False)


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op10_warc_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(_table(spark, sf_dir, "pages"))


def queries() -> dict:
    return {name: f for name, f in globals().items() if name.startswith("op") and callable(f)}


SQL = {
    "op2_minhash_near_dedup": r"""WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws FROM documents),
 s AS (SELECT doc_id, unnest(list_distinct(CASE WHEN len(ws) > 1 THEN [ws[i] || ' ' || ws[i + 1] for i in range(1, len(ws))] ELSE ws END)) AS g FROM w),
 n AS (SELECT doc_id, count(*) AS c FROM s GROUP BY 1), p AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS i FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2),
 l AS (SELECT x, y FROM p JOIN n a ON a.doc_id = x JOIN n b ON b.doc_id = y WHERE 100 * i >= 80 * (a.c + b.c - i)), e AS (SELECT x, y FROM l UNION ALL SELECT y, x FROM l),
 r AS (SELECT doc_id AS d, doc_id AS c FROM documents UNION SELECT e.y, r.c FROM r JOIN e ON r.d = e.x), k AS (SELECT d, min(c) AS component_id FROM r GROUP BY 1)
SELECT w.doc_id, coalesce(n.c, 0) AS n_shingles, component_id, w.doc_id = component_id AS kept FROM w JOIN k ON d = w.doc_id LEFT JOIN n ON n.doc_id = w.doc_id""",
    "op10_warc_index": """WITH d AS (SELECT page_id, strlen(coalesce(html, '')) AS n, sha1(coalesce(html, '')) AS x, max(page_id) OVER (PARTITION BY coalesce(html, '')) AS m FROM pages)
SELECT page_id, n AS payload_bytes, array_to_string([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', ((('0x' || substr(x, (1 + 5 * (i // 4))::int, 5))::BIGINT >> (15 - 5 * (i % 4))::int) & 31)::int + 1, 1) for i in range(32)], '') AS payload_digest,
 CASE WHEN m = page_id THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN m <> page_id THEN m END AS refers_to FROM d""",
}


def oracle_sql() -> dict[str, str]:
    return SQL
