"""Corpus pipeline: documents to packed training sequences in five stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes
each one's rows as Parquet in the shared folder and rereads them as the next
one's docs. Later stages never see what an earlier one dropped.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stockwise.llm.common import stored
from stockwise.llm.ngram_join import near_duplicates
from stockwise.llm.packing import pack
from stockwise.llm.pii import replace_pii
from stockwise.llm.quality_rules import MAX_LABELLED, kept_documents, labelled_cases, learn
from stockwise.llm.queries import SURROGATE_KEY
from stockwise.llm.suffix_dedup import remove_repeats

PACK_TOKENS = 2048


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules and the learned decision list keep. Rules
    are learned from the labels of ``sf_dir`` on these documents."""
    rules = learn(labelled_cases(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), MAX_LABELLED))
    return kept_documents(docs, rules)


def near_duplicate_groups(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near duplicates, the one of smallest id, rows
    without an id last. Rows count by a key of their own, so ids may be null or
    repeat: different texts stay, whatever their ids."""
    keyed = stored(docs.withColumn("_row", F.monotonically_increasing_id()), "keyed")
    groups = near_duplicates(keyed, id_col="_row").select(F.col("doc_id").alias("_row"), "component_id")
    rank = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "_row")
    first = groups.join(keyed.select("_row", "doc_id"), "_row").groupBy("component_id").agg(F.min(rank).alias("first"))
    return keyed.join(first.select("first._row"), "_row", "left_semi").select(*docs.columns)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages of 400 bytes or more that stand anywhere else;
    documents of which nothing is left but white space go."""
    others = [c for c in docs.columns if c not in ("doc_id", "text", "n_chars")]
    done = remove_repeats(docs, 400, carry=others)
    done = done.where((F.col("n_removed") == 0) | F.col("kept_text").rlike(r"\S"))
    return done.select("doc_id", F.col("kept_text").alias("text"), *[F.col(f"rest.{c}").alias(c) for c in others],
                       F.length("kept_text").cast("long").alias("n_chars")).select(*docs.columns)


def private_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with keyed surrogates for personal data."""
    return replace_pii(docs, SURROGATE_KEY).withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of training sequences."""
    return pack(docs, public_tokenizers.path("byte_bpe_50k.json"), PACK_TOKENS, added=True)


STAGES = [("quality_rules", quality), ("ngram_jaccard_join", near_duplicate_groups), ("suffix_array_dedup", repeated_passages),
          ("pii_surrogates", private_data), ("cost_balanced_packing", packed)]
ORACLE_SQL = None   # learned rules, keyed surrogates and byte-level BPE have no SQL form


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
