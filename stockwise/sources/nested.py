"""Nested documents (store orders, store products, chat conversations, chat
events) derived from the domain views, in the shapes the reference reads
from web APIs (Relay ``edges/node`` lists, conversation payloads).

Nesting only groups a handful of children per parent (lines per order,
variants per product, turns per conversation), so every array is bounded
by the parent's own size.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockwise.sources.views import spread_for

GID = "gid://shopify/"


def _gid(kind: str, col) -> F.Column:
    return F.concat(F.lit(f"{GID}{kind}/"), (F.col(col) if isinstance(col, str) else col).cast("string"))


def _edge(line) -> F.Column:
    return F.struct(F.struct(
        line["title"].alias("title"), line["quantity"].alias("quantity"), line["sku"].alias("sku"),
        F.struct(_gid("ProductVariant", line["product_id"]).alias("id"),
                 F.struct(_gid("Product", line["product_id"]).alias("id"), line["title"].alias("title"),
                          line["product_type"].alias("productType")).alias("product")).alias("variant"),
    ).alias("node"))


def order_documents(v) -> DataFrame:
    """One nested order per sale order (orders without lines have no edges)."""
    p = v.product.select("product_id", "name", "sku", "product_type")
    # lines travel flat and become edges where their order is put together
    lines = v.sale_order_line.join(p, "product_id", "left").select("order_id", F.struct(
        "line_no", F.col("name").alias("title"), F.col("qty").alias("quantity"), "sku",
        F.col("product_id").cast("string").alias("product_id"), "product_type").alias("line"))
    parts = spread_for(v.t.lineitem)
    lines = lines.repartition(*parts, "order_id") if parts else lines
    per_order = lines.groupBy("order_id").agg(F.transform(F.array_sort(F.collect_list("line")), _edge).alias("edges"))
    cust = v.partner.select(F.col("partner_id"), F.col("email").alias("c_email"), F.col("name").alias("c_name"))
    o = v.sale_order.join(cust, "partner_id", "left").join(per_order, "order_id", "left")
    draft = F.col("state") == "draft"
    return o.select(
        F.struct(
            _gid("Order", "order_id").alias("id"),
            F.concat(F.lit("#"), F.col("order_id").cast("string")).alias("name"),
            F.col("date_order").alias("createdAt"),
            F.col("state").alias("displayFinancialStatus"),
            F.when(F.col("invoiced"), F.array(F.lit("web"))).otherwise(F.array(F.lit("Tienda"), F.lit("web")))
            .alias("tags"),
            F.when(draft, F.lit(None)).otherwise(F.struct(
                _gid("Customer", "partner_id").alias("id"), F.col("c_email").alias("email"),
                F.col("c_name").alias("displayName"))).alias("customer"),
            F.struct(F.col("team_name").alias("city"), F.lit("CL").alias("countryCode")).alias("shippingAddress"),
            F.struct(F.array(F.struct(F.struct(
                F.when(draft, F.lit("local-pickup")).otherwise(F.lit("standard")).alias("code"),
                F.when(F.col("team_name") == "1-URGENT", F.lit("Retiro en tienda")).otherwise(F.lit("Despacho"))
                .alias("title")).alias("node"))).alias("edges")).alias("shippingLines"),
            F.array(F.struct(
                F.when(F.col("state") == "sale", "IN_PROGRESS").when(draft, "OPEN").otherwise("CLOSED").alias("status"),
                F.when(F.col("invoiced"), F.array().cast("array<string>")).otherwise(F.array(F.lit("MOVE")))
                .alias("supportedActions"))).alias("fulfillmentOrders"),
            F.struct(F.coalesce("edges", F.array().cast(
                "array<struct<node:struct<title:string,quantity:double,sku:string,"
                "variant:struct<id:string,product:struct<id:string,title:string,productType:string>>>>>"))
                .alias("edges")).alias("lineItems"),
        ).alias("order"))


def product_documents(v) -> DataFrame:
    """Nested store product: images, variants (0-2) with options, metafields."""
    p = v.product
    n_var = (F.col("product_id") % 3).cast("int")
    variants = F.when(n_var > 0, F.transform(F.sequence(F.lit(1), n_var), lambda k: F.struct(F.struct(
        F.concat(F.lit(f"{GID}ProductVariant/"), F.col("product_id").cast("string"), F.lit("-"), k.cast("string"))
        .alias("id"),
        F.concat(F.col("sku"), F.lit("-V"), k.cast("string")).alias("sku"),
        (F.col("list_price") + k).alias("price"),
        F.array(F.struct(F.lit("Size").alias("name"), F.when(k == 1, "S").otherwise("M").alias("value")),
                F.struct(F.lit("Color Name").alias("name"), F.split("name", " ")[0].alias("value")))
        .alias("selectedOptions")).alias("node")))).otherwise(
        F.array().cast("array<struct<node:struct<id:string,sku:string,price:double,"
                       "selectedOptions:array<struct<name:string,value:string>>>>>"))
    images = F.transform(F.sequence(F.lit(1), (1 + F.col("product_id") % 2).cast("int")), lambda i: F.struct(
        F.struct(F.concat(F.lit("https://cdn.example.com/"), F.col("sku"), F.lit("-"), i.cast("string"),
                          F.lit(".jpg")).alias("url")).alias("node")))
    meta = F.array(
        F.struct(F.struct(F.lit("custom").alias("namespace"), F.lit("complementary_products").alias("key"),
                          F.concat(F.lit("SKU-"), (F.col("product_id") + 1).cast("string")).alias("value"))
                 .alias("node")),
        F.struct(F.struct(F.lit("custom").alias("namespace"), F.lit("material").alias("key"),
                          F.col("category").alias("value")).alias("node")))
    return p.select(F.struct(
        _gid("Product", "product_id").alias("id"), F.col("name").alias("title"),
        F.col("description").alias("descriptionHtml"), F.col("product_type").alias("productType"),
        F.when(F.col("is_active"), "ACTIVE").otherwise("DRAFT").alias("status"),
        F.struct(images.alias("edges")).alias("images"),
        F.struct(variants.alias("edges")).alias("variants"),
        F.struct(meta.alias("edges")).alias("metafields")).alias("product"))


def conversation_documents(v) -> DataFrame:
    """Conversation payloads with sender struct, meta map and messages."""
    m = v.conversation_message
    msgs = m.select("conversation_id", F.struct(
        F.col("message_id").alias("id"), F.col("conversation_id"), F.col("content"),
        F.col("message_type"), F.col("created_at"),
        F.when(F.col("sender_email").isNotNull(), F.struct(F.col("sender_email").alias("email"),
                                                           F.lit(None).cast("string").alias("name")))
        .alias("sender")).alias("msg"))
    per = msgs.groupBy("conversation_id").agg(
        F.array_sort(F.collect_list("msg"), lambda a, b: F.when(a["id"] < b["id"], -1)
                     .when(a["id"] > b["id"], 1).otherwise(0)).alias("messages"))
    stats = m.groupBy("conversation_id").agg(
        F.min("created_at").alias("created_at"), F.max("created_at").alias("updated_at"),
        F.count_if(F.col("message_type") == 0).cast("int").alias("unread_count"),
        F.first("contact_email").alias("contact_email"))
    c = per.join(stats, "conversation_id")
    cid = F.col("conversation_id")
    return c.select(F.struct(
        cid.alias("id"), F.lit(1).alias("account_id"), (cid % 5).alias("inbox_id"),
        F.when(cid % 4 == 0, "resolved").otherwise("open").alias("status"),
        "created_at", "updated_at", "unread_count",
        F.when((cid % 3 == 0) & (cid % 2 == 0), F.create_map(F.lit("sender_email"), F.col("contact_email")))
        .otherwise(F.create_map().cast("map<string,string>")).alias("meta"),
        F.when(cid % 3 != 0, F.struct(F.col("contact_email").alias("email"),
                                      F.concat(F.lit("Contact "), (cid % 37).cast("string")).alias("name")))
        .alias("sender"),
        "messages").alias("conversation"))


def chat_events(v) -> DataFrame:
    """Inbound chat events (bot, subtypes, files) derived from the event log."""
    e = v.t.events
    et = F.col("event_type")
    return e.select(
        F.col("event_id"), F.col("user_id").cast("string").alias("user"),
        F.when(et == "signup", F.lit("B01")).alias("bot_id"),
        F.when(et == "error", F.lit("channel_join")).when((et == "view") & (F.col("event_id") % 7 == 0),
                                                          F.lit("channel_topic")).alias("subtype"),
        F.when(et.isin("view", "click"), F.concat(F.lit("mensaje "), F.col("event_id").cast("string")))
        .alias("text"),
        F.when(et == "purchase", F.array(F.struct(F.lit("audio.mp3").alias("name"), F.lit("mp3").alias("filetype"))))
        .when(et == "click", F.array(F.struct(F.lit("a.m4a").alias("name"), F.lit("m4a").alias("filetype")),
                                     F.struct(F.lit("doc.pdf").alias("name"), F.lit("pdf").alias("filetype"))))
        .alias("files"))
