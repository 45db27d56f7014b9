"""One query per training-data operator over the given tables, with SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from . import ball_tree, exact_dedup, hnsw_dedup, importance, jaccard_join, license_scan, mixing, packing, perplexity, pii_semicrf, stable_search, substring_dedup, warc_index
from .common import table
from .tokenizer_files import byte_bpe


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.passages(table(spark, sf_dir, "documents"))


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.duplicate_report(table(spark, sf_dir, "documents"))


def op3_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.near_duplicate_report(table(spark, sf_dir, "documents"))


def op4_hnsw_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hnsw_dedup.near_duplicate_report(table(spark, sf_dir, "embeddings"))


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_report(table(spark, sf_dir, "documents"))


def op6_perplexity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return perplexity.quality_report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer_files=byte_bpe())


def op8_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.license_report(table(spark, sf_dir, "documents"))


def op9_warc_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc_index.round_trip(table(spark, sf_dir, "pages"))


def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii_semicrf.pii_report(table(spark, sf_dir, "documents"))


def op11_ball_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ball_tree.ranked_search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op12_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importance.importance_report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_stable_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stable_search.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_substring_dedup, op2_exact_dedup, op3_jaccard_join, op4_hnsw_dedup, op5_mixing, op6_perplexity, op7_packing, op8_license_scan,
                            op9_warc_index, op10_pii, op11_ball_tree, op12_importance, op13_stable_search)}

#: Terms: maximal runs of letters, digits and everything beyond ASCII; only A-Z are lower-cased.
_TERMS = r"regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"

ORACLES: dict[str, str] = {
    "op11_ball_tree": f"""
        WITH q AS (SELECT DISTINCT item_id, unnest({_TERMS}) AS term FROM benchmark),
        d AS (SELECT doc_id, {_TERMS} AS terms FROM documents WHERE text IS NOT NULL),
        n AS (SELECT doc_id, len(terms) AS n FROM d WHERE len(terms) > 0),
        s AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS length FROM n),
        v AS (SELECT doc_id, term, count(*) AS tf FROM (SELECT doc_id, unnest(terms) AS term FROM d) GROUP BY ALL),
        f AS (SELECT term, CAST(floor(1000 * ln(CAST(2 * any_value(docs) + 2 AS DOUBLE) / (2 * count(*) + 1))) AS BIGINT) AS w
              FROM v, s WHERE term IN (SELECT term FROM q) GROUP BY term),
        x AS (SELECT item_id, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (100 - 50 + (50 * n * docs) // length)))) AS BIGINT) AS score
              FROM q JOIN f USING (term) JOIN v USING (term) JOIN n USING (doc_id), s GROUP BY ALL)
        SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM (
          SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM x WHERE score > 0) WHERE rank <= 50""",
    "op9_warc_index": r"""
        WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
        d AS (SELECT page_id, strlen(html) AS payload_bytes, sha1(html) AS payload_digest FROM p),
        r AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest) AS response FROM d)
        SELECT page_id, payload_bytes, payload_digest,
               CASE WHEN payload_bytes >= 1000 AND page_id <> response THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN payload_bytes >= 1000 AND page_id <> response THEN response END AS refers_to FROM r""",
    "op2_exact_dedup": r"""
        WITH t AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS content FROM documents),
        g AS (SELECT *, min(doc_id) OVER (PARTITION BY content) AS keep_id, count(*) OVER (PARTITION BY content) AS group_size FROM t)
        SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(content) AS text_sha256 FROM g""",
}
