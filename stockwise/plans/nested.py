"""Registered nested-document queries (D1-D21, S10-S11) with oracles.

Spark flattens the nested documents; the oracle computes the same flat
result straight from the relational views.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from stockwise.operators import nested as D
from stockwise.plans.common import views
from stockwise.plans.registry import register
from stockwise.sources import nested as NS


def _orders(spark, sf_dir):
    return NS.order_documents(views(spark, sf_dir))


def _products(spark, sf_dir):
    return NS.product_documents(views(spark, sf_dir))


def _convs(spark, sf_dir):
    return NS.conversation_documents(views(spark, sf_dir))


D1_SQL = """
SELECT o.order_id, '#' || CAST(o.order_id AS VARCHAR) AS order_name,
       CASE WHEN o.state = 'draft' THEN NULL ELSE c.email END AS customer_email,
       CASE WHEN o.state = 'draft' THEN NULL ELSE c.name END AS customer_name,
       o.team_name AS city, p.name AS line_title, p.sku AS line_sku, l.qty AS quantity,
       l.product_id AS product_id, p.product_type AS product_type
FROM sale_order o LEFT JOIN sale_order_line l ON l.order_id = o.order_id
LEFT JOIN product p ON p.product_id = l.product_id LEFT JOIN partner c ON c.partner_id = o.partner_id"""


@register("D1_flatten_orders", oracle=D1_SQL)
def d1_flatten_orders(spark, sf_dir):
    return D.flatten_orders(_orders(spark, sf_dir))


VARIANTS_SQL = """
SELECT product_id, name AS title, CASE WHEN is_active THEN 'ACTIVE' ELSE 'DRAFT' END AS status,
       product_type, CAST(k - 1 AS INTEGER) AS position, sku || '-V' || CAST(k AS VARCHAR) AS variant_sku,
       list_price + k AS price, CASE WHEN k = 1 THEN 'S' ELSE 'M' END AS size, split_part(name, ' ', 1) AS color_name
FROM (SELECT *, unnest(generate_series(1, CAST(product_id % 3 AS INTEGER))) AS k FROM product
      WHERE product_id % 3 > 0) t"""


@register("D2_D10_flatten_products_options", oracle=VARIANTS_SQL)
def d2_products(spark, sf_dir):
    return D.flatten_products(_products(spark, sf_dir))


@register("D3_flatten_images", oracle="""
SELECT product_id, 'https://cdn.example.com/' || sku || '-' || CAST(i AS VARCHAR) || '.jpg' AS url,
       description
FROM (SELECT *, unnest(generate_series(1, CAST(1 + product_id % 2 AS INTEGER))) AS i FROM product) t""")
def d3_images(spark, sf_dir):
    return D.flatten_images(_products(spark, sf_dir))


@register("D4_sku_to_product_id", oracle=f"SELECT variant_sku AS sku, product_id FROM ({VARIANTS_SQL}) v")
def d4_map(spark, sf_dir):
    return D.sku_to_product_map(D.flatten_products(_products(spark, sf_dir)))


@register("D5_order_by_number", oracle="""
SELECT q.query, '#' || regexp_replace(q.query, '\\D', '', 'g') AS order_name, o.order_id
FROM (SELECT 'Pedido N° ' || CAST(event_id AS VARCHAR) AS query FROM events) q
JOIN sale_order o ON '#' || CAST(o.order_id AS VARCHAR) = '#' || regexp_replace(q.query, '\\D', '', 'g')""")
def d5_by_number(spark, sf_dir):
    q = views(spark, sf_dir).t.events.select(F.concat(F.lit("Pedido N° "), F.col("event_id").cast("string"))
                                             .alias("query"))
    return D.orders_by_number(q, _orders(spark, sf_dir))


@register("D6_D7_pickup", oracle="""
SELECT order_id, is_pickup,
       CASE WHEN is_pickup THEN CASE WHEN state = 'sale' AND invoiced THEN 'ready_for_pickup'
                                     WHEN state = 'draft' THEN 'not_prepared' ELSE 'unknown' END END AS pickup_status
FROM (SELECT order_id, state, invoiced,
             state = 'draft' OR team_name = '1-URGENT' OR NOT invoiced AS is_pickup FROM sale_order) t""")
def d6_pickup(spark, sf_dir):
    return D.pickup_info(_orders(spark, sf_dir))


@register("D8_metafields", oracle="""
SELECT product_id, 'custom' AS namespace, 'complementary_products' AS key,
       'SKU-' || CAST(product_id + 1 AS VARCHAR) AS value FROM product
UNION ALL SELECT product_id, 'custom', 'material', category FROM product""")
def d8_metafields(spark, sf_dir):
    rows, _ = D.metafields(_products(spark, sf_dir))
    return rows


@register("D9_normalise_orders", oracle="""
SELECT o.order_id, CASE WHEN o.state = 'draft' THEN NULL ELSE o.partner_id END AS customer_id,
       count(l.order_id) AS n_lines, coalesce(string_agg(p.sku, ',' ORDER BY l.line_no, p.name, l.qty, p.sku), '') AS skus
FROM sale_order o LEFT JOIN sale_order_line l ON l.order_id = o.order_id
LEFT JOIN product p ON p.product_id = l.product_id GROUP BY o.order_id, o.state, o.partner_id""")
def d9_normalise(spark, sf_dir):
    return D.normalise_orders(_orders(spark, sf_dir)).withColumn("n_lines", F.col("n_lines").cast("long"))


MSG_SQL = """
SELECT conversation_id, CASE WHEN conversation_id % 3 <> 0 THEN contact_email END AS contact_email, message_id,
       content, message_type, created_at, sender_email, NULL::VARCHAR AS sender_name
FROM conversation_message"""


@register("D11_D14_message_order_direction", oracle=f"""
SELECT *, row_number() OVER (PARTITION BY conversation_id ORDER BY created_at, message_id) AS position,
       CASE WHEN message_type = 0 THEN 'inbound' ELSE 'outbound' END AS direction FROM ({MSG_SQL}) m""")
def d11_messages(spark, sf_dir):
    return D.ordered_messages(_convs(spark, sf_dir))


RESOLVED_SQL = """
SELECT conversation_id, coalesce(CASE WHEN conversation_id % 3 <> 0 THEN max(contact_email) END,
       CASE WHEN conversation_id % 3 = 0 AND conversation_id % 2 = 0 THEN max(contact_email) END,
       arg_min(sender_email, message_id) FILTER (WHERE sender_email IS NOT NULL)) AS sender_email
FROM conversation_message GROUP BY conversation_id"""


@register("D12_resolve_sender", oracle=RESOLVED_SQL)
def d12_resolve(spark, sf_dir):
    return D.resolve_sender(_convs(spark, sf_dir))


PAIRS_SQL = f"""
SELECT DISTINCT conversation_id, email FROM (
  SELECT conversation_id, lower(sender_email) AS email FROM ({RESOLVED_SQL}) r
  UNION ALL SELECT conversation_id, lower(sender_email) FROM conversation_message) u WHERE email IS NOT NULL"""


@register("D13_merge_conversations_by_email", oracle=f"""
WITH per AS (
  SELECT conversation_id, count(*) AS n_messages, count(*) FILTER (WHERE message_type = 0) AS unread_count,
         max(created_at) AS updated_at, arg_max(content, (created_at, message_id)) AS last_message,
         max((created_at, message_id)) AS last_key
  FROM conversation_message GROUP BY 1)
SELECT p.email, count(*) AS n_conversations, min(p.conversation_id) AS first_conversation_id,
       sum(per.n_messages) AS n_messages, sum(per.unread_count) AS unread_total, max(per.updated_at) AS updated_at,
       arg_max(per.last_message, per.last_key) AS last_message, 'merged' AS status
FROM ({PAIRS_SQL}) p JOIN per ON p.conversation_id = per.conversation_id GROUP BY p.email""")
def d13_merge(spark, sf_dir):
    return D.merge_by_email(_convs(spark, sf_dir)).withColumn("unread_total", F.col("unread_total").cast("long"))


@register("D15_conversation_table", oracle="""
SELECT conversation_id, CASE WHEN conversation_id % 4 = 0 THEN 'resolved' ELSE 'open' END AS status,
       CASE WHEN conversation_id % 3 <> 0 OR conversation_id % 2 = 0 THEN max(contact_email) END AS contact,
       CAST(count(*) FILTER (WHERE message_type = 0) AS INTEGER) AS unread_count,
       CASE WHEN length(arg_max(content, (created_at, message_id))) > 100
            THEN left(arg_max(content, (created_at, message_id)), 100) || '...'
            ELSE arg_max(content, (created_at, message_id)) END AS last_message
FROM conversation_message GROUP BY conversation_id""")
def d15_table(spark, sf_dir):
    return D.conversation_table(_convs(spark, sf_dir))


@register("D16_sender_labels", oracle=f"""
SELECT *, CASE WHEN message_type = 0 THEN coalesce(sender_name, sender_email, contact_email, 'Cliente')
               ELSE coalesce(sender_name, sender_email, 'Agente') END AS sender_label FROM ({MSG_SQL}) m""")
def d16_labels(spark, sf_dir):
    return D.sender_label(D.message_rows(_convs(spark, sf_dir)))


@register("D17_reply_targets", oracle=f"""
SELECT e.email, f.conversation_id, f.conversation_id IS NULL AS is_new
FROM (SELECT DISTINCT lower(trim(email)) AS email FROM partner WHERE customer_rank > 0
      UNION SELECT DISTINCT lower(contact_email) FROM conversation_message) e
LEFT JOIN (SELECT email, min(conversation_id) AS conversation_id FROM ({PAIRS_SQL}) p GROUP BY 1) f
  ON e.email = f.email""")
def d17_targets(spark, sf_dir):
    v = views(spark, sf_dir)
    emails = (v.partner.where(F.col("customer_rank") > 0).select("email")
              .unionByName(v.conversation_message.select(F.col("contact_email").alias("email"))))
    return D.reply_targets(emails, _convs(spark, sf_dir))


@register("D18_opportunity_type", oracle="""
SELECT order_id, CASE WHEN team_name = '2-HIGH' THEN 'Odoo' WHEN team_name = '3-MEDIUM' THEN 'Shopify'
                      WHEN state = 'done' THEN 'Odoo' WHEN state = 'sale' THEN 'Shopify' ELSE 'Unknown' END
                 AS opportunity_type
FROM sale_order""")
def d18_type(spark, sf_dir):
    so = views(spark, sf_dir).sale_order
    df = so.select("order_id",
                   F.when(F.col("team_name") == "2-HIGH", F.array(F.lit("web"), F.lit("EMMA-Odoo")))
                   .when(F.col("team_name") == "3-MEDIUM", F.array(F.lit("emma-shopify")))
                   .otherwise(F.array().cast("array<string>")).alias("tags"),
                   F.when(F.col("state") == "done", F.concat(F.lit("S0"), F.col("order_id").cast("string")))
                   .when(F.col("state") == "sale", F.concat(F.lit("SN-"), F.col("order_id").cast("string")))
                   .otherwise(F.concat(F.lit("X"), F.col("order_id").cast("string"))).alias("order_name"))
    return df.select("order_id", D.opportunity_type("tags", "order_name").alias("opportunity_type"))


@register("D19_stage_ids", oracle="""
SELECT stage_name, CAST(dense_rank() OVER (ORDER BY stage_name) AS INTEGER) AS stage_id
FROM (SELECT DISTINCT state AS stage_name FROM sale_order) t""")
def d19_stages(spark, sf_dir):
    so = views(spark, sf_dir).sale_order
    return D.stage_ids(so.select(F.col("state").alias("stage_name")))


@register("D20_variant_attributes", oracle="""
SELECT sku, CASE WHEN category_id = 100 + product_id % 7 THEN category
                 ELSE category || ', ' || 'Var' || CAST(100 + product_id % 7 AS VARCHAR) END AS attributes
FROM product""")
def d20_attributes(spark, sf_dir):
    p = views(spark, sf_dir).product
    items = p.select("sku", F.array("category_id", "category_id", (F.lit(100) + F.col("product_id") % 7).cast("int"))
                     .alias("attribute_ids"))
    attrs = (p.select(F.col("category_id").alias("attr_id"), F.col("category").alias("attr_name")).distinct()
             .unionByName(p.select((F.lit(100) + F.col("product_id") % 7).cast("int").alias("attr_id"),
                                   F.concat(F.lit("Var"), (F.lit(100) + F.col("product_id") % 7).cast("string"))
                                   .alias("attr_name")).distinct()))
    return D.variant_attributes(items, attrs)


@register("D21_event_router", oracle="""
SELECT event_id, CAST(user_id AS VARCHAR) AS user,
       CASE WHEN event_type = 'signup' THEN 'dropped_bot'
            WHEN event_type = 'error' OR (event_type = 'view' AND event_id % 7 = 0) THEN 'dropped_subtype'
            WHEN event_type = 'purchase' THEN 'audio_only' WHEN event_type = 'click' THEN 'mixed'
            ELSE 'text' END AS route
FROM events""")
def d21_router(spark, sf_dir):
    return D.route_events(NS.chat_events(views(spark, sf_dir)))
