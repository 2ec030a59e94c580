"""Substring search of many terms by n-gram postings.

Texts and terms are cut into n-grams of three letters; shorter terms are looked up by
their one or two letters. A product is a candidate if it has all of the term's
n-grams, found by one equi join and a count; the substring is then verified. No
product meets a term with which it shares nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

GRAM = 3


def grams(text: Column, size: int) -> Column:
    """Distinct ``size``-grams of a text; none if it is shorter."""
    n = F.length(text)
    return F.when(n >= size, F.array_distinct(F.transform(F.sequence(F.lit(1), n - size + 1), lambda i: F.substr(text, i, F.lit(size))))).otherwise(F.array())


def substring_hits(terms: DataFrame, texts: DataFrame) -> DataFrame:
    """(term, term_order, id) of ``texts`` (id, text) that contain the lower-cased
    ``terms`` (term, term_order)."""
    low = texts.select("id", F.lower("text").alias("text"))
    t = terms.select("term", "term_order", F.lower(F.trim("term")).alias("needle")).where(F.length("needle") > 0)
    size = F.least(F.length("needle"), F.lit(GRAM))
    wanted = t.withColumn("grams", F.coalesce(*[F.when(size == k, grams(F.col("needle"), k)) for k in range(1, GRAM + 1)]))
    wanted = wanted.select("term", "term_order", "needle", F.size("grams").alias("n"), F.explode("grams").alias("gram"))
    # only grams of the lengths that terms ask for come into the postings
    asked = wanted.select("gram").distinct()
    postings = low.select("id", F.explode(F.array_union(F.array_union(grams(F.col("text"), 1), grams(F.col("text"), 2)), grams(F.col("text"), 3))).alias("gram"))
    postings = postings.join(asked, "gram", "left_semi")
    held = (wanted.join(postings, "gram").groupBy("term", "term_order", "needle", "id")
            .agg(F.count(F.lit(1)).alias("k"), F.first("n").alias("n")).where("k = n"))
    return held.join(low, "id").where(F.contains("text", "needle")).select("term", "term_order", "id")


def consolidated_search(terms: DataFrame, products: DataFrame, per_term: int = 5) -> DataFrame:
    """Per term the first ``per_term`` products by id; of those only active ones, each
    with its first term; one row a variant, the product's own row if it has none.
    ``products`` has (id, title, status, variants array<struct<id, sku, price>>)."""
    hits = substring_hits(terms, products.select("id", F.col("title").alias("text")))
    hits = hits.withColumn("place", F.row_number().over(Window.partitionBy("term_order", "term").orderBy("id"))).where(F.col("place") <= per_term)
    first = hits.groupBy("id").agg(F.min(F.struct("term_order", "term", "place")).alias("first"))
    live = products.where(F.col("status") == "ACTIVE").join(first, "id")
    rows = live.select("id", "title", "first.*", F.explode_outer("variants").alias("v"))
    return rows.select("id", "title", "term", "term_order", "place", F.coalesce("v.id", F.col("id").cast("string")).alias("variant_id"),
                       F.col("v.sku").alias("variant_sku"), F.col("v.price").alias("variant_price"))
