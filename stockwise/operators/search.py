"""Product search: exact SKU, vector similarity, hybrid, embedding prep.

Vector search joins blocks of queries with blocks of catalogue cells
(``vector_index``); bounds leave out cells that cannot hold a hit.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stockwise.config import SEARCH_K, SEARCH_THRESHOLD
from stockwise.operators import vector_index

PROBES = 16                    # cells that the approximate search visits

# E1 ---------------------------------------------------------------------------
def exact_sku(queries: DataFrame, product: DataFrame) -> DataFrame:
    """Query text equal (case-insensitive, trimmed) to an active SKU -> score 1."""
    q = queries.select("qid", F.upper(F.trim("text")).alias("sku")).where(F.col("sku") != "")
    p = product.where(F.col("is_active")).select("sku", "name")
    return q.join(p, "sku").select("qid", "sku", "name", F.lit("exact_sku").alias("search_type"),
                                   F.lit(1.0).alias("relevance_score"), F.lit(1.0).alias("similarity_score"))


# E2 ---------------------------------------------------------------------------
def similar(queries: DataFrame, product: DataFrame, k: int = SEARCH_K,
            threshold: float = SEARCH_THRESHOLD) -> DataFrame:
    """Top-k products per query (qid, vec) by cosine similarity, keeping only
    similarity strictly above ``threshold``; similarity clamped to [0, 1]. Queries
    and catalogue meet block by block (see ``vector_index``). A qid with several
    vectors gets the hits of each; equal rows count once."""
    placed, cells = vector_index.build(product.where(F.col("is_active")))
    return vector_index.exact_top_k(queries, placed, cells, k, threshold)


# E3 ---------------------------------------------------------------------------
def hybrid_search(queries: DataFrame, product: DataFrame, k: int = SEARCH_K,
                  threshold: float = SEARCH_THRESHOLD) -> DataFrame:
    """Exact SKU hit returns alone; otherwise semantic results. Blank query
    texts with no vector return nothing."""
    q = queries.withColumn("text", F.trim("text"))
    q = q.where((F.col("text") != "") | F.col("vec").isNotNull())
    exact = exact_sku(q, product)
    rest = q.join(exact.select("qid").distinct(), "qid", "left_anti")
    sem = similar(rest.select("qid", "vec"), product, k, threshold).join(
        product.select("sku", "name"), "sku")
    sem = sem.select("qid", "sku", "name", F.lit("semantic").alias("search_type"),
                     F.col("similarity").alias("relevance_score"), F.col("similarity").alias("similarity_score"))
    return exact.unionByName(sem)


# E4 ---------------------------------------------------------------------------
def ivf_similar(queries: DataFrame, product: DataFrame, k: int = SEARCH_K, threshold: float = SEARCH_THRESHOLD,
                probes: int = PROBES, cells: int | None = None) -> DataFrame:
    """Approximate ``similar``: the ``probes`` nearest cells, members ranked exactly."""
    placed, found = vector_index.build(product.where(F.col("is_active")), cells)
    return vector_index.probed_top_k(queries, placed, found, k, threshold, probes)


def lsh_similar(queries: DataFrame, product: DataFrame, k: int = SEARCH_K, threshold: float = SEARCH_THRESHOLD,
                bucket_length: float = 0.5, num_tables: int = 4, seed: int = 7) -> DataFrame:
    """Approximate candidates with Spark ML BucketedRandomProjectionLSH on
    unit vectors (cos > t  <=>  euclidean < sqrt(2 - 2t)), exact re-rank."""
    from pyspark.ml.feature import BucketedRandomProjectionLSH
    from pyspark.ml.functions import array_to_vector

    def unit(df, vec_col):
        v = F.transform(vec_col, lambda x: x.cast("double"))
        nrm = F.sqrt(F.aggregate(v, F.lit(0.0), lambda a, x: a + x * x))
        return df.withColumn("features", array_to_vector(F.transform(v, lambda x: x / nrm)))

    cat = unit(product.where(F.col("is_active") & F.col("embedding").isNotNull()).select("sku", "embedding"),
               "embedding")
    qs = unit(queries.where(F.col("vec").isNotNull()).select("qid", "vec"), "vec")
    model = BucketedRandomProjectionLSH(inputCol="features", outputCol="hashes", bucketLength=bucket_length,
                                        numHashTables=num_tables, seed=seed).fit(cat)
    max_dist = float(np.sqrt(max(0.0, 2 - 2 * threshold)))
    pairs = model.approxSimilarityJoin(qs, cat, max_dist, distCol="dist").select(
        F.col("datasetA.qid").alias("qid"), F.col("datasetB.sku").alias("sku"),
        (1 - F.col("dist") ** 2 / 2).alias("similarity"))
    w = Window.partitionBy("qid").orderBy(F.col("similarity").desc(), "sku")
    return (pairs.where(F.col("similarity") > threshold).withColumn("rank", F.row_number().over(w))
            .where(F.col("rank") <= k).withColumn("similarity", F.round("similarity", 6)))


# E5 / E6 / E7 ------------------------------------------------------------------
def needs_embedding(product: DataFrame, text_col: str = "text_for_embedding") -> DataFrame:
    return (product.where(F.col("embedding").isNull() & F.col(text_col).isNotNull() & F.col("is_active"))
            .orderBy(F.col("write_date").desc(), "sku"))


def text_for_embedding(name, sku, product_id):
    """Collapsed-whitespace name, else SKU, else 'Product ID: n'."""
    clean = F.trim(F.regexp_replace(F.col(name), r"\s+", " "))
    return (F.when(clean.isNotNull() & (clean != ""), clean)
            .when(F.col(sku).isNotNull() & (F.trim(sku) != ""), F.col(sku))
            .otherwise(F.concat(F.lit("Product ID: "), F.col(product_id).cast("string"))))


def token_estimate(text) -> F.Column:
    return F.greatest(F.lit(1), F.floor(F.length(text) / 4)).cast("long")


# E8 ---------------------------------------------------------------------------
def hashed_ngram_embedder(dim: int = 64, n: int = 3) -> Callable[[pd.Series], list]:
    """Default local embedding: L2-normalised hashed character n-grams."""
    import xxhash

    def embed(texts: pd.Series) -> list:
        out = []
        for t in texts:
            if t is None or not str(t).strip():
                out.append(None)
                continue
            s = f" {str(t).lower()} "
            v = np.zeros(dim)
            for i in range(max(1, len(s) - n + 1)):
                v[xxhash.xxh32_intdigest(s[i:i + n]) % dim] += 1.0
            nrm = np.linalg.norm(v)
            out.append((v / nrm).astype(np.float32).tolist() if nrm else None)
        return out
    return embed


def embed(df: DataFrame, text_col: str, fn: Callable[[pd.Series], list] | None = None,
          model: str = "hashed-ngram-64") -> DataFrame:
    """Attach vector, model and dimension; blank texts get no vector. The
    vector stays on its row (batches are processed in order)."""
    fn = fn or hashed_ngram_embedder()
    schema = T.StructType(df.schema.fields + [
        T.StructField("embedding_vec", T.ArrayType(T.FloatType())), T.StructField("model", T.StringType()),
        T.StructField("dimension", T.IntegerType())])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            vecs = fn(pdf[text_col])
            yield pdf.assign(embedding_vec=vecs, model=[model if v is not None else None for v in vecs],
                             dimension=[len(v) if v is not None else None for v in vecs])
    return df.mapInPandas(run, schema)


# E9 ---------------------------------------------------------------------------
def multi_term_search(terms: DataFrame, product: DataFrame, per_term: int = 10) -> DataFrame:
    """Per term the top ``per_term`` active products whose name contains the
    term as a word (equi join on exploded name words, no cross product);
    a product keeps its first term (term order)."""
    words = (product.where(F.col("is_active"))
             .select("sku", "name", F.explode(F.array_distinct(F.split(F.lower("name"), r"\s+"))).alias("word")))
    t = terms.select(F.lower(F.trim("term")).alias("word"), "term_order")
    hits = words.join(t, "word")
    w = Window.partitionBy("term_order").orderBy("sku")
    hits = hits.withColumn("term_rank", F.row_number().over(w)).where(F.col("term_rank") <= per_term)
    first = Window.partitionBy("sku").orderBy("term_order", "term_rank")
    return (hits.withColumn("_r", F.row_number().over(first)).where("_r = 1")
            .select("sku", "name", F.col("word").alias("term"), "term_order", "term_rank"))


# E10 ------------------------------------------------------------------------
def product_by_identifier(keys: DataFrame, product: DataFrame) -> DataFrame:
    """All-digit identifiers are product ids, anything else a SKU."""
    k = keys.select(F.trim(F.col("key").cast("string")).alias("key")).distinct()
    is_id = F.col("key").rlike(r"^\d+$")
    k = k.withColumns({"kind": F.when(is_id, "id").otherwise("sku"),
                       "_id": F.when(is_id, F.col("key").cast("long")),
                       "_sku": F.when(~is_id, F.upper("key"))})
    a = product.select(F.col("product_id").alias("pid_a"), F.col("sku").alias("sku_a"))
    b = product.select(F.col("product_id").alias("pid_b"), F.col("sku").alias("sku_b"))
    df = k.join(a, k._id == a.pid_a, "left").join(b, k._sku == b.sku_b, "left")
    return df.select("key", "kind", F.coalesce("pid_a", "pid_b").alias("product_id"),
                     F.coalesce("sku_a", "sku_b").alias("sku"))
