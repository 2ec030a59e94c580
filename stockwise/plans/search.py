"""Registered product-search queries (E1-E10) with oracles.

Query batches derive from the data: one semantic query per embedding label
(the label's centroid vector), one per product (its own vector: products like
it) and exact-SKU queries typed from all sales lines.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from stockwise.operators import search as E
from stockwise.operators.batching import assign_batches
from stockwise.operators.text_search import consolidated_search
from stockwise.plans.common import views
from stockwise.plans.registry import register
from stockwise.sources import nested as NS

CENTROIDS_SQL = """
SELECT CAST(label AS BIGINT) AS qid, 'label ' || CAST(label AS VARCHAR) AS text, list(v ORDER BY pos) AS vec
FROM (SELECT label, pos, avg(CAST(e.embedding[pos + 1] AS DOUBLE)) AS v
      FROM embeddings e, range(0, 64) r(pos) GROUP BY 1, 2) t GROUP BY label"""
SKU_QUERIES_SQL = """
SELECT DISTINCT product_id + 1000 AS qid, ' ' || lower(items_product_sku) || ' ' AS text, NULL::DOUBLE[] AS vec
FROM sales_items"""
PRODUCT_QUERIES_SQL = """
SELECT product_id AS qid, sku AS text, CAST(embedding AS DOUBLE[]) AS vec FROM product WHERE embedding IS NOT NULL"""
CAT_SQL = """
SELECT sku, name, CAST(embedding AS DOUBLE[]) AS vec FROM product WHERE is_active AND embedding IS NOT NULL"""


def _sim_sql(queries: str, threshold: float, k: int = 20) -> str:
    return f"""
SELECT qid, sku, similarity, rank FROM (
  SELECT q.qid, c.sku, round(least(greatest(list_cosine_similarity(c.vec, q.vec), 0.0), 1.0), 6) AS similarity,
         row_number() OVER (PARTITION BY q.qid ORDER BY list_cosine_similarity(c.vec, q.vec) DESC, c.sku) AS rank
  FROM ({queries}) q JOIN ({CAT_SQL}) c ON list_cosine_similarity(c.vec, q.vec) > {threshold}) t
WHERE rank <= {k}"""


def centroid_queries(spark, sf_dir):
    emb = views(spark, sf_dir).t.embeddings
    per_dim = (emb.select("label", F.posexplode("embedding").alias("pos", "x"))
               .groupBy("label", "pos").agg(F.avg(F.col("x").cast("double")).alias("v")))
    return (per_dim.groupBy("label").agg(F.sort_array(F.collect_list(F.struct("pos", "v"))).alias("pv"))
            .select(F.col("label").cast("long").alias("qid"),
                    F.concat(F.lit("label "), F.col("label").cast("string")).alias("text"),
                    F.transform("pv", lambda s: s["v"]).alias("vec")))


def sku_queries(spark, sf_dir):
    return (views(spark, sf_dir).sales_items
            .select((F.col("product_id") + 1000).alias("qid"),
                    F.concat(F.lit(" "), F.lower("items_product_sku"), F.lit(" ")).alias("text"),
                    F.lit(None).cast("array<double>").alias("vec")).distinct())


@register("E1_exact_sku", oracle=f"""
SELECT q.qid, p.sku, p.name, 'exact_sku' AS search_type, 1.0::DOUBLE AS relevance_score,
       1.0::DOUBLE AS similarity_score
FROM ({SKU_QUERIES_SQL}) q JOIN product p ON upper(trim(q.text)) = p.sku AND p.is_active""")
def e1_exact(spark, sf_dir):
    return E.exact_sku(sku_queries(spark, sf_dir), views(spark, sf_dir).product)


@register("E2_similar_default_threshold", oracle=_sim_sql(CENTROIDS_SQL, 0.8))
def e2_similar(spark, sf_dir):
    return E.similar(centroid_queries(spark, sf_dir), views(spark, sf_dir).product_to_search)


@register("E2_similar_threshold_0_3", oracle=_sim_sql(CENTROIDS_SQL, 0.3))
def e2_similar_low(spark, sf_dir):
    return E.similar(centroid_queries(spark, sf_dir), views(spark, sf_dir).product_to_search, threshold=0.3)


def product_queries(spark, sf_dir):
    p = views(spark, sf_dir).product_to_search
    return p.where(F.col("embedding").isNotNull()).select(F.col("product_id").cast("long").alias("qid"), F.col("sku").alias("text"),
                                                          F.col("embedding").cast("array<double>").alias("vec"))


@register("E2_similar_products", oracle=_sim_sql(PRODUCT_QUERIES_SQL, 0.8))
def e2_similar_products(spark, sf_dir):
    """Every product asks for the products like it, at the default threshold."""
    return E.similar(product_queries(spark, sf_dir), views(spark, sf_dir).product_to_search)


@register("E2_similar_products_threshold_0_3", oracle=_sim_sql(PRODUCT_QUERIES_SQL, 0.3))
def e2_similar_products_low(spark, sf_dir):
    return E.similar(product_queries(spark, sf_dir), views(spark, sf_dir).product_to_search, threshold=0.3)


@register("E3_hybrid_search", oracle=f"""
WITH q AS (SELECT qid, trim(text) AS text, vec FROM ({SKU_QUERIES_SQL} UNION ALL {CENTROIDS_SQL}
                                                    UNION ALL SELECT -1, '   ', NULL::DOUBLE[]) a
           WHERE trim(text) <> '' OR vec IS NOT NULL),
ex AS (SELECT q.qid, p.sku, p.name, 'exact_sku' AS search_type, 1.0 AS relevance_score, 1.0 AS similarity_score
       FROM q JOIN product p ON upper(trim(q.text)) = p.sku AND p.is_active),
sem AS ({_sim_sql("SELECT * FROM q WHERE qid NOT IN (SELECT qid FROM ex)", 0.3)})
SELECT * FROM ex
UNION ALL
SELECT s.qid, s.sku, p.name, 'semantic', s.similarity, s.similarity FROM sem s JOIN product p ON s.sku = p.sku""")
def e3_hybrid(spark, sf_dir):
    q = (sku_queries(spark, sf_dir).unionByName(centroid_queries(spark, sf_dir))
         .unionByName(spark.range(1).select(F.lit(-1).cast("long").alias("qid"), F.lit("   ").alias("text"),
                                            F.lit(None).cast("array<double>").alias("vec"))))
    return E.hybrid_search(q, views(spark, sf_dir).product_to_search, threshold=0.3)


@register("E4_lsh_similar")
def e4_lsh(spark, sf_dir):
    return E.lsh_similar(centroid_queries(spark, sf_dir), views(spark, sf_dir).product_to_search, threshold=0.3)


@register("E4_ivf_similar")
def e4_ivf(spark, sf_dir):
    """These vectors hardly cluster, so that a low threshold needs 12 of 16 cells."""
    return E.ivf_similar(product_queries(spark, sf_dir), views(spark, sf_dir).product_to_search, threshold=0.3, cells=16, probes=12)


@register("E4_ivf_recall", oracle=f"SELECT count(*) AS n_exact, true AS recall_reached FROM ({_sim_sql(PRODUCT_QUERIES_SQL, 0.3)}) t")
def e4_recall(spark, sf_dir):
    """Whether the approximate search finds at least nine of ten of the exact hits."""
    exact = E.similar(product_queries(spark, sf_dir), views(spark, sf_dir).product_to_search, threshold=0.3).select("qid", "sku")
    found = e4_ivf(spark, sf_dir).select("qid", "sku", F.lit(1).alias("hit"))
    return exact.join(found, ["qid", "sku"], "left").agg(
        F.count(F.lit(1)).alias("n_exact"), (F.count("hit") >= 0.9 * F.count(F.lit(1))).alias("recall_reached"))


TEXT_SQL = """
CASE WHEN trim(regexp_replace(nm, '\\s+', ' ', 'g')) IS NOT NULL AND trim(regexp_replace(nm, '\\s+', ' ', 'g')) <> ''
     THEN trim(regexp_replace(nm, '\\s+', ' ', 'g'))
     WHEN sk IS NOT NULL AND trim(sk) <> '' THEN sk
     ELSE 'Product ID: ' || CAST(product_id AS VARCHAR) END"""
TEXT_IN_SQL = """
SELECT product_id, embedding, is_active, write_date, sku,
       CASE WHEN product_type = 'service' THEN NULL ELSE ' ' || replace(name, ' ', '   ') || ' ' END AS nm,
       CASE WHEN is_active THEN sku END AS sk FROM product"""


def _text_in(spark, sf_dir):
    p = views(spark, sf_dir).product
    return p.select("product_id", "embedding", "is_active", "write_date", "sku",
                    F.when(F.col("product_type") == "service", None)
                    .otherwise(F.concat(F.lit(" "), F.replace("name", F.lit(" "), F.lit("   ")), F.lit(" ")))
                    .alias("nm"),
                    F.when(F.col("is_active"), F.col("sku")).alias("sk"))


@register("E6_text_for_embedding", oracle=f"SELECT product_id, {TEXT_SQL} AS text_for_embedding FROM ({TEXT_IN_SQL}) t")
def e6_text(spark, sf_dir):
    return _text_in(spark, sf_dir).select("product_id", E.text_for_embedding("nm", "sk", "product_id")
                                          .alias("text_for_embedding"))


@register("E5_needs_embedding", oracle=f"""
SELECT sku, text_for_embedding FROM (SELECT *, {TEXT_SQL} AS text_for_embedding FROM ({TEXT_IN_SQL}) t) x
WHERE embedding IS NULL AND text_for_embedding IS NOT NULL AND is_active ORDER BY write_date DESC, sku""")
def e5_needs(spark, sf_dir):
    df = _text_in(spark, sf_dir).withColumn("text_for_embedding", E.text_for_embedding("nm", "sk", "product_id"))
    return E.needs_embedding(df).select("sku", "text_for_embedding")


@register("E7_embedding_batches", oracle=f"""
WITH RECURSIVE t AS (SELECT sku, text, greatest(1, length(text) // 4) AS est_tokens, row_number() OVER (ORDER BY sku) AS rn
  FROM (SELECT sku, {TEXT_SQL} AS text FROM ({TEXT_IN_SQL}) a) b),
g(rn, batch_id, items, tokens) AS (
  SELECT rn, 0, 1, est_tokens FROM t WHERE rn = 1
  UNION ALL
  SELECT t.rn, CASE WHEN fits THEN batch_id ELSE batch_id + 1 END, CASE WHEN fits THEN items + 1 ELSE 1 END,
         CASE WHEN fits THEN tokens + est_tokens ELSE est_tokens END
  FROM (SELECT t.*, g.batch_id, g.items, g.tokens, g.items + 1 <= 100 AND g.tokens + t.est_tokens <= 8000 AS fits
        FROM g JOIN t ON t.rn = g.rn + 1) t)
SELECT t.sku, t.text, CAST(t.est_tokens AS BIGINT) AS est_tokens, CAST(g.batch_id AS BIGINT) AS batch_id FROM t JOIN g USING (rn)""")
def e7_batches(spark, sf_dir):
    df = _text_in(spark, sf_dir).select("sku", E.text_for_embedding("nm", "sk", "product_id").alias("text"))
    return assign_batches(df, "text", ["sku"])


@register("E8_embed_products")
def e8_embed(spark, sf_dir):
    df = _text_in(spark, sf_dir).select("sku", E.text_for_embedding("nm", "sk", "product_id").alias("text"))
    return E.embed(df, "text")


TERMS_SQL = """
SELECT split_part(name, ' ', 1) AS term, min(product_id) AS term_order FROM product GROUP BY 1"""


@register("E9_multi_term_search", oracle=f"""
SELECT sku, name, term, term_order, term_rank FROM (
  SELECT *, row_number() OVER (PARTITION BY sku ORDER BY term_order, term_rank) AS r FROM (
    SELECT h.*, row_number() OVER (PARTITION BY term_order ORDER BY sku) AS term_rank FROM (
      SELECT w.sku, w.name, t.term, t.term_order FROM (
        SELECT DISTINCT sku, name, unnest(string_split(lower(name), ' ')) AS word FROM product WHERE is_active) w
      JOIN ({TERMS_SQL}) t ON w.word = lower(trim(t.term))) h) h2
  WHERE term_rank <= 10) x WHERE r = 1""")
def e9_multi_term(spark, sf_dir):
    p = views(spark, sf_dir).product
    terms = p.groupBy(F.split("name", " ")[0].alias("term")).agg(F.min("product_id").alias("term_order"))
    return E.multi_term_search(terms, p)


# Terms typed by customers: pieces of names, some of one or two letters only.
PIECES_SQL = """
SELECT term, min(product_id) AS term_order FROM (
  SELECT product_id, CASE product_id % 4 WHEN 0 THEN upper(substr(name, 2, 5)) WHEN 1 THEN left(name, 3) WHEN 2 THEN substr(name, 3, 2)
                                         ELSE substr(name, 4, 9) END AS term FROM product
  UNION ALL SELECT product_id, right(sku, 1) FROM product) t GROUP BY term"""


@register("E9_consolidated_search", oracle=f"""
WITH q AS ({PIECES_SQL}),
h AS (SELECT q.term, q.term_order, p.product_id, row_number() OVER (PARTITION BY q.term_order, q.term ORDER BY p.product_id) AS place
      FROM q JOIN product p ON contains(lower(p.name), lower(trim(q.term))) AND trim(q.term) <> ''),
f AS (SELECT *, row_number() OVER (PARTITION BY product_id ORDER BY term_order, term, place) AS r FROM h WHERE place <= 5)
SELECT p.product_id AS id, p.name AS title, f.term, f.term_order, CAST(f.place AS INTEGER) AS place,
       CASE WHEN k IS NULL THEN CAST(p.product_id AS VARCHAR) ELSE '{NS.GID}ProductVariant/' || p.product_id || '-' || k END AS variant_id,
       CASE WHEN k IS NOT NULL THEN p.sku || '-V' || k END AS variant_sku, CASE WHEN k IS NOT NULL THEN p.list_price + k END AS variant_price
FROM f JOIN product p USING (product_id)
LEFT JOIN (SELECT product_id, unnest(range(1, product_id % 3 + 1)) AS k FROM product) v USING (product_id)
WHERE f.r = 1 AND p.is_active""")
def e9_consolidated(spark, sf_dir):
    p = views(spark, sf_dir).product
    name, pid = F.col("name"), F.col("product_id")
    piece = (F.when(pid % 4 == 0, F.upper(F.substring(name, 2, 5))).when(pid % 4 == 1, F.substring(name, 1, 3))
             .when(pid % 4 == 2, F.substring(name, 3, 2)).otherwise(F.substring(name, 4, 9)))
    terms = (p.select(piece.alias("term"), "product_id").unionByName(p.select(F.right("sku", F.lit(1)).alias("term"), "product_id"))
             .groupBy("term").agg(F.min("product_id").alias("term_order")))
    docs = NS.product_documents(views(spark, sf_dir)).select("product.*").select(
        F.element_at(F.split("id", "/"), -1).cast("long").alias("id"), "title", "status",
        F.transform("variants.edges", lambda e: F.struct(e["node"]["id"].alias("id"), e["node"]["sku"].alias("sku"), e["node"]["price"].alias("price")))
        .alias("variants"))
    return consolidated_search(terms, docs, 5)


@register("E10_product_by_id_or_sku", oracle="""
SELECT k.key, k.kind, coalesce(a.product_id, b.product_id) AS product_id, coalesce(a.sku, b.sku) AS sku
FROM (SELECT key, CASE WHEN regexp_full_match(key, '\\d+') THEN 'id' ELSE 'sku' END AS kind,
             CASE WHEN regexp_full_match(key, '\\d+') THEN CAST(key AS BIGINT) END AS _id,
             CASE WHEN NOT regexp_full_match(key, '\\d+') THEN upper(key) END AS _sku
      FROM (SELECT DISTINCT trim(key) AS key FROM (
            SELECT CAST(user_id AS VARCHAR) AS key FROM events
            UNION ALL SELECT 'sku-' || CAST(user_id AS VARCHAR) FROM events
            UNION ALL SELECT 'SKU-' || CAST(user_id + 100000 AS VARCHAR) FROM events) u) v) k
LEFT JOIN product a ON k._id = a.product_id LEFT JOIN product b ON k._sku = b.sku""")
def e10_by_identifier(spark, sf_dir):
    v = views(spark, sf_dir)
    e = v.t.events
    keys = (e.select(F.col("user_id").cast("string").alias("key"))
            .unionByName(e.select(F.concat(F.lit("sku-"), F.col("user_id").cast("string")).alias("key")))
            .unionByName(e.select(F.concat(F.lit("SKU-"), (F.col("user_id") + 100000).cast("string")).alias("key"))))
    return E.product_by_identifier(keys, v.product)
