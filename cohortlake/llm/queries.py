"""The numbered queries and their SQL. Each applies its operator to a whole table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import quality, sql
from .ann import nearest
from .bpe import encode_decode
from .centroids import cluster_vectors, with_inertia
from .decontaminate import find_leaks
from .filter_audit import filter_interactions
from .html_extract import extract_text
from .language import fit, identify
from .minhash import near_duplicates
from .sharding import assign_shards
from .substring import dedup_substrings
from .token_counts import count_tokens
from .url_filter import filter_urls

#: Name of the vocabulary file of op9, found on every node by the package of public tokenizers.
VOCABULARY = "word_bpe_49k.json"


def vocabulary(name: str = VOCABULARY) -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))


def op6_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url")
    return filter_urls(pages).select("page_id", "host", "path", "rule", "verdict")


def fold() -> Column:
    return F.crc32(F.col("doc_id").cast("string")) % 4


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = fit(docs.where(fold() != 2))
    found = identify(docs.select("doc_id", "text"), model)
    return found.select("doc_id", F.coalesce(fold() == 2, F.lit(False)).alias("held_out"), "lang_pred", "score")


def op9_bpe_encode_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return bpe_digest(encode_decode(docs, vocabulary()))


def bpe_digest(coded: DataFrame) -> DataFrame:
    return coded.select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


def op1_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html")
    return extract_text(pages).select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def op2_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    # A document's site is its source; the languages of a source are its paths.
    return quality.score_quality(docs, labels, F.col("source"), F.concat_ws("/", "source", "lang"))


def op3_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    leaks = find_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return leaks.select(F.col("id").alias("doc_id"), "item_id", "start", "words", "lcs", "ratio", "cosine", "answered")


def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return assign_shards(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))


def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return dedup_substrings(docs).select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


def op7_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))


def op10_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding"))


def op11_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    found, centroids = cluster_vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding"))
    return with_inertia(found, centroids)


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang")
    return filter_interactions(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op13_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return count_tokens(docs, vocabulary("piece_bpe_32k.model")).drop("text")


OP6_SQL = """
WITH parts AS (
  SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages
), split AS (
  SELECT page_id, translate(regexp_extract(coalesce(rest, ''), '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(coalesce(rest, ''), '^[^/?#]*([^?#]*)', 1) AS path FROM parts
), rules(verdict, h, p) AS (
  VALUES ('allow', 'com', '/'), ('block', 'example.com', '/en/'), ('allow', 'www.example.com', '/en/'), ('block', 'net', '/es/'), ('block', 'net', '/fr/')
), hit AS (
  SELECT s.page_id, s.host, s.path, r.h || r.p AS rule, r.verdict
  FROM split s LEFT JOIN rules r ON (s.host = r.h OR ends_with(s.host, '.' || r.h)) AND starts_with(s.path, r.p)
)
SELECT page_id, host, path, arg_max(rule, length(rule)) AS rule, coalesce(arg_max(verdict, length(rule)), 'allow') AS verdict
FROM hit GROUP BY page_id, host, path
"""

QUERIES = {
    "op1_html_extraction": op1_html_extraction,
    "op2_quality_classifier": op2_quality_classifier,
    "op3_benchmark_decontamination": op3_benchmark_decontamination,
    "op4_sharding": op4_sharding,
    "op8_language_id": op8_language_id,
    "op7_minhash_near_dedup": op7_minhash_near_dedup,
    "op5_substring_dedup": op5_substring_dedup,
    "op6_url_filters": op6_url_filters,
    "op9_bpe_encode_decode": op9_bpe_encode_decode,
    "op10_nearest_neighbours": op10_nearest_neighbours,
    "op11_centroid_clustering": op11_centroid_clustering,
    "op12_filter_audit": op12_filter_audit,
    "op13_token_counts": op13_token_counts,
}
ORACLE = {"op5_substring_dedup": sql.SUBSTRING_DEDUP, "op6_url_filters": OP6_SQL, "op7_minhash_near_dedup": sql.NEAR_DUPLICATES, "op11_centroid_clustering": sql.centroid_clustering(), "op12_filter_audit": sql.FILTER_AUDIT}
