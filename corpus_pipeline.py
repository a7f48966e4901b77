"""A corpus pipeline: five stages, each taking the documents that its predecessor kept.

A stage is (spark, docs, sf_dir) -> DataFrame. The result is written as Parquet and read back as the
next stage's documents. All stages but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortlake.llm.bpe import encode_decode
from cohortlake.llm.decontaminate import decontaminate
from cohortlake.llm.language import fit, identify
from cohortlake.llm.minhash import near_duplicates
from cohortlake.llm.queries import bpe_digest, fold, vocabulary
from cohortlake.llm.storage import MADE, cleared, stored
from cohortlake.llm.substring import dedup_substrings

#: A text is rejected if no language explains its trigrams better than chance.
LEAST_GAIN = 0.0


def _set_aside(docs: DataFrame) -> DataFrame:
    """doc_id, text, and all other columns as one, `others`: so none of them clashes with what an operator adds."""
    return docs.select("doc_id", "text", F.struct(F.lit(0).alias("doc_id"), *[F.col(f"`{c}`") for c in docs.columns if c not in ("doc_id", "text")]).alias("others"))


def _restored(df: DataFrame, columns: list[str], **new) -> DataFrame:
    """The given columns again, those in `new` with new values."""
    return df.select([(new[c] if c in new else F.col(c) if c in ("doc_id", "text") else F.col(f"others.`{c}`")).alias(c) for c in columns])


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without a letter, and those that no learned language explains better than chance, go; a missing `lang` is filled in.

    Null and empty texts have no letter. Repeated rows stay or go together; an empty table, or one
    without a labelled row, keeps nothing.
    """
    model = fit(docs.where(fold() != 2))
    found = identify(_set_aside(docs), model).where((F.col("lang_pred") != "und") & (F.col("gain") > LEAST_GAIN))
    return _restored(found, docs.columns, lang=F.coalesce("others.lang", "lang_pred"))


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays, the one of the smallest doc_id.

    Null and empty texts are linked with nothing and stay; rows equal in doc_id are one document and
    stay or go together; an empty table stays empty.
    """
    groups = near_duplicates(docs.select("doc_id", "text"))
    gone = groups.where("NOT kept").select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti").select([F.col(f"`{c}`") for c in docs.columns])


def substring_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Words of repeated windows go; a text that loses nothing stays as it is, one that loses everything goes.

    Null and empty texts lose nothing and stay. Every place of a repeat loses it, in repeated rows too.
    `n_chars` is that of the new text. An empty table stays empty.
    """
    cut = dedup_substrings(_set_aside(docs))
    text = F.when(F.col("n_removed") > 0, F.col("kept")).otherwise(F.col("text"))
    left = cut.where("n_removed = 0 OR n_removed < n_words")
    return _restored(left, docs.columns, text=text, n_chars=F.length(text).cast("long"))


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go. Null and empty texts stay; repeated rows stay or go together; empty tables take nothing."""
    return decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def tokenize_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of what is left, one row for each row; null and empty texts have no tokens."""
    return bpe_digest(encode_decode(docs.select("doc_id", "text"), vocabulary()))


STAGES = [
    ("language_id", language_stage),
    ("near_dedup", near_dedup_stage),
    ("substring_dedup", substring_stage),
    ("decontamination", decontamination_stage),
    ("bpe", tokenize_stage),
]

#: No stage can be written in SQL: mixtures, hashing, a latent space and a tokenizer. Tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of `sf_dir`, each on what the one before has kept.

    Rows of any kind go through as the stages say: null and empty texts, repeated rows, texts of any length,
    further columns of any name; an empty table gives an empty result. When a stage's result is written,
    what it wrote on the way goes, and so does the result before.
    """
    docs, since = spark.read.parquet(f"{sf_dir}/documents.parquet"), len(MADE)
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs, path = stored(docs, name)
            cleared(spark, since, [path])
    return docs
