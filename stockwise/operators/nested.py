"""Nested order / product / conversation operators.

Flattening uses ``explode`` / ``explode_outer`` and higher-order functions;
per-email conversation merging aggregates per-conversation statistics
(counts, sums, max, max_by) instead of concatenating message arrays, so a
very active contact never becomes one huge row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stockwise.functions.scalars import gid_to_id

PICKUP_WORDS = r"pickup|retiro|tienda"
AUDIO_TYPES = ("m4a", "mp3", "mp4", "ogg", "wav")
# Fixed values of the reference: chat subtypes that are ignored.
UNWANTED_SUBTYPES = ("bot_add", "bot_remove", "channel_join", "channel_leave", "channel_topic", "channel_purpose",
                     "channel_name", "group_join", "group_leave", "channel_archive", "channel_unarchive")


# D1 -------------------------------------------------------------------------
def flatten_orders(orders: DataFrame) -> DataFrame:
    """One row per line item with order, customer and shipping columns; an
    order without lines keeps one row with NULL line columns."""
    o = orders.select("order.*")
    df = o.select("id", "name", "customer", "shippingAddress", F.explode_outer("lineItems.edges").alias("e"))
    return df.select(
        gid_to_id("id").cast("long").alias("order_id"), F.col("name").alias("order_name"),
        F.col("customer.email").alias("customer_email"), F.col("customer.displayName").alias("customer_name"),
        F.col("shippingAddress.city").alias("city"),
        F.col("e.node.title").alias("line_title"), F.col("e.node.sku").alias("line_sku"),
        F.col("e.node.quantity").alias("quantity"),
        gid_to_id("e.node.variant.product.id").cast("long").alias("product_id"),
        F.col("e.node.variant.product.productType").alias("product_type"))


# D2 / D10 -----------------------------------------------------------------------
def option_columns(options) -> F.Column:
    """selectedOptions -> map(lower(name with '_' for spaces) -> value)."""
    return F.map_from_entries(F.transform(options, lambda o: F.struct(
        F.lower(F.regexp_replace(o["name"], " ", "_")).alias("k"), o["value"].alias("v"))))


def flatten_products(products: DataFrame) -> DataFrame:
    """One row per variant (products without variants drop out)."""
    p = products.select("product.*")
    df = p.select("id", "title", "status", "productType", F.posexplode("variants.edges").alias("pos", "e"))
    opts = option_columns("e.node.selectedOptions")
    return df.select(
        gid_to_id("id").cast("long").alias("product_id"), "title", "status",
        F.col("productType").alias("product_type"), F.col("pos").alias("position"),
        F.col("e.node.sku").alias("variant_sku"), F.col("e.node.price").alias("price"),
        opts["size"].alias("size"), opts["color_name"].alias("color_name"))


# D3 ----------------------------------------------------------------------------
def flatten_images(products: DataFrame) -> DataFrame:
    p = products.select("product.*")
    return p.select(gid_to_id("id").cast("long").alias("product_id"), F.col("descriptionHtml").alias("description"),
                    F.explode("images.edges").alias("e")).select(
        "product_id", F.col("e.node.url").alias("url"), "description")


# D4 ----------------------------------------------------------------------------
def sku_to_product_map(variants: DataFrame) -> DataFrame:
    """Last occurrence wins; empty SKUs skipped."""
    v = variants.where(F.col("variant_sku").isNotNull() & (F.trim("variant_sku") != ""))
    return v.groupBy(F.col("variant_sku").alias("sku")).agg(
        F.max_by("product_id", F.struct("product_id", "position")).alias("product_id"))


# D5 ----------------------------------------------------------------------------
def orders_by_number(queries: DataFrame, orders: DataFrame) -> DataFrame:
    digits = F.regexp_replace("query", r"\D", "")
    q = queries.select("query", F.concat(F.lit("#"), digits).alias("order_name")).where(digits != "")
    o = orders.select(F.col("order.name").alias("order_name"), gid_to_id("order.id").cast("long").alias("order_id"))
    return q.join(o, "order_name")


# D6 / D7 ---------------------------------------------------------------------------
def pickup_info(orders: DataFrame) -> DataFrame:
    o = orders.select("order.*")
    ship = F.col("shippingLines.edges")
    is_pickup = (F.exists(ship, lambda e: F.lower(e["node"]["code"]).contains("pickup"))
                 | F.exists(ship, lambda e: F.lower(e["node"]["title"]).rlike(PICKUP_WORDS))
                 | F.exists("tags", lambda t: F.lower(t).rlike(PICKUP_WORDS)))
    fo = F.col("fulfillmentOrders")[0]
    status = (F.when((fo["status"] == "IN_PROGRESS") & (F.size(fo["supportedActions"]) == 0), "ready_for_pickup")
              .when(fo["status"] == "OPEN", "not_prepared").otherwise("unknown"))
    return o.select(gid_to_id("id").cast("long").alias("order_id"), is_pickup.alias("is_pickup"),
                    F.when(is_pickup, status).alias("pickup_status"))


# D8 ----------------------------------------------------------------------------
def metafields(products: DataFrame) -> tuple[DataFrame, DataFrame]:
    p = products.select("product.*")
    rows = p.select(gid_to_id("id").cast("long").alias("product_id"), F.explode("metafields.edges").alias("e")).select(
        "product_id", F.col("e.node.namespace").alias("namespace"), F.col("e.node.key").alias("key"),
        F.col("e.node.value").alias("value"))
    comp = p.select(gid_to_id("id").cast("long").alias("product_id"),
                    F.filter("metafields.edges", lambda e: e["node"]["key"] == "complementary_products")[0]
                    ["node"]["value"].alias("complementary_products"))
    return rows, comp


# D9 ----------------------------------------------------------------------------
def normalise_orders(orders: DataFrame) -> DataFrame:
    o = orders.select("order.*")
    nodes = F.transform("lineItems.edges", lambda e: e["node"])
    return o.select(gid_to_id("id").cast("long").alias("order_id"),
                    gid_to_id("customer.id").cast("long").alias("customer_id"),
                    F.size(nodes).alias("n_lines"),
                    F.array_join(F.transform(nodes, lambda n: n["sku"]), ",").alias("skus"))


# D11 / D12 / D14 / D16 ------------------------------------------------------------
def message_rows(conversations: DataFrame) -> DataFrame:
    c = conversations.select("conversation.*")
    return c.select(F.col("id").alias("conversation_id"), F.col("sender.email").alias("contact_email"),
                    F.explode("messages").alias("m")).select(
        "conversation_id", "contact_email", F.col("m.id").alias("message_id"), F.col("m.content").alias("content"),
        F.col("m.message_type").alias("message_type"), F.col("m.created_at").alias("created_at"),
        F.col("m.sender.email").alias("sender_email"), F.col("m.sender.name").alias("sender_name"))


def direction(message_type) -> F.Column:
    return F.when(F.col(message_type) == 0, "inbound").otherwise("outbound")


def resolve_sender(conversations: DataFrame) -> DataFrame:
    """conversation.sender, else meta sender, else first message sender."""
    c = conversations.select("conversation.*")
    first_msg = F.filter("messages", lambda m: m["sender"]["email"].isNotNull())[0]["sender"]["email"]
    return c.select(F.col("id").alias("conversation_id"),
                    F.coalesce(F.col("sender.email"), F.col("meta")["sender_email"], first_msg).alias("sender_email"))


def ordered_messages(conversations: DataFrame) -> DataFrame:
    m = message_rows(conversations)
    w = Window.partitionBy("conversation_id").orderBy("created_at", "message_id")
    return m.withColumn("position", F.row_number().over(w)).withColumn("direction", direction("message_type"))


def sender_label(messages: DataFrame, agent: str = "Agente", customer: str = "Cliente") -> DataFrame:
    out = F.coalesce("sender_name", "sender_email", F.lit(agent))
    inc = F.coalesce("sender_name", "sender_email", "contact_email", F.lit(customer))
    return messages.withColumn("sender_label", F.when(F.col("message_type") == 0, inc).otherwise(out))


# D13 / D17 ---------------------------------------------------------------------------
def conversations_by_email(conversations: DataFrame) -> DataFrame:
    """(email, conversation) pairs: resolved sender or any message sender,
    compared case-insensitively."""
    res = resolve_sender(conversations).select("conversation_id", F.lower("sender_email").alias("email"))
    msg = message_rows(conversations).select("conversation_id", F.lower("sender_email").alias("email"))
    return res.unionByName(msg).where(F.col("email").isNotNull()).distinct()


def merge_by_email(conversations: DataFrame) -> DataFrame:
    """Per e-mail: matched conversations merged into counts, unread sum,
    newest update, last message and the first conversation id."""
    c = conversations.select("conversation.*")
    m = message_rows(conversations)
    last = m.groupBy("conversation_id").agg(
        F.count(F.lit(1)).alias("n_messages"),
        F.max_by(F.struct("created_at", "message_id", "content"), F.struct("created_at", "message_id"))
        .alias("last_msg"))
    per_conv = c.select(F.col("id").alias("conversation_id"), "unread_count", "updated_at").join(
        last, "conversation_id", "left")
    pairs = conversations_by_email(conversations)
    return pairs.join(per_conv, "conversation_id").groupBy("email").agg(
        F.count(F.lit(1)).alias("n_conversations"), F.min("conversation_id").alias("first_conversation_id"),
        F.sum(F.coalesce("n_messages", F.lit(0))).alias("n_messages"),
        F.sum("unread_count").alias("unread_total"), F.max("updated_at").alias("updated_at"),
        F.max_by(F.col("last_msg.content"), F.col("last_msg")).alias("last_message"),
        F.lit("merged").alias("status"))


def merged_messages(conversations: DataFrame) -> DataFrame:
    """The messages of each e-mail's merged conversation, oldest first, each with
    the conversation it came from: rows, so that no group is one array."""
    m = message_rows(conversations).select("conversation_id", "message_id", "created_at", "content")
    return (conversations_by_email(conversations).join(m, "conversation_id")
            .select("email", "created_at", "message_id", F.col("conversation_id").alias("merged_from"), "content")
            .orderBy("email", "created_at", "message_id"))


def reply_targets(emails: DataFrame, conversations: DataFrame) -> DataFrame:
    """First matched conversation (lowest id) per e-mail, else a new one."""
    first = conversations_by_email(conversations).groupBy("email").agg(
        F.min("conversation_id").alias("conversation_id"))
    e = emails.select(F.lower(F.trim("email")).alias("email")).distinct()
    return e.join(first, "email", "left").withColumn("is_new", F.col("conversation_id").isNull())


# D15 ---------------------------------------------------------------------------------
def conversation_table(conversations: DataFrame, width: int = 100) -> DataFrame:
    c = conversations.select("conversation.*")
    last = F.element_at(F.array_sort(F.transform("messages", lambda m: F.struct(
        m["created_at"].alias("t"), m["id"].alias("i"), m["content"].alias("c")))), -1)["c"]
    cut = F.when(F.length(last) > width, F.concat(F.left(last, F.lit(width)), F.lit("..."))).otherwise(last)
    sender = F.coalesce(F.col("sender.email"), F.col("meta")["sender_email"])
    return c.select(F.col("id").alias("conversation_id"), "status", sender.alias("contact"), "unread_count",
                    cut.alias("last_message"))


# D18 / D19 ---------------------------------------------------------------------------
def opportunity_type(tags, order_name) -> F.Column:
    low = F.transform(F.col(tags), lambda t: F.lower(t))
    return (F.when(F.array_contains(low, "emma-odoo"), "Odoo").when(F.array_contains(low, "emma-shopify"), "Shopify")
            .when(F.col(order_name).startswith("S0"), "Odoo").when(F.col(order_name).startswith("SN-"), "Shopify")
            .otherwise("Unknown"))


def stage_ids(stages: DataFrame) -> DataFrame:
    w = Window.orderBy("stage_name")
    return stages.select("stage_name").distinct().withColumn("stage_id", F.dense_rank().over(w))


# D20 ---------------------------------------------------------------------------------
def variant_attributes(items: DataFrame, attributes: DataFrame) -> DataFrame:
    """attribute ids -> names, first-occurrence order kept, repeats removed."""
    ex = items.select("sku", F.posexplode(F.array_distinct("attribute_ids")).alias("pos", "attr_id"))
    named = ex.join(attributes, "attr_id", "left")
    return named.groupBy("sku").agg(F.array_join(F.transform(
        F.array_sort(F.collect_list(F.struct("pos", "attr_name"))), lambda s: s["attr_name"]), ", ")
        .alias("attributes"))


# D21 ---------------------------------------------------------------------------------
def route_events(events: DataFrame) -> DataFrame:
    """Drop bot messages and unwanted subtypes; classify audio-only, mixed
    (audio + other files) and text."""
    audio = F.exists("files", lambda f: F.lower(f["filetype"]).isin(*AUDIO_TYPES))
    other = F.exists("files", lambda f: ~F.lower(f["filetype"]).isin(*AUDIO_TYPES))
    route = (F.when(F.col("bot_id").isNotNull(), "dropped_bot")
             .when(F.col("subtype").isin(*UNWANTED_SUBTYPES), "dropped_subtype")
             .when(audio & ~other, "audio_only").when(audio & other, "mixed").otherwise("text"))
    return events.select("event_id", "user", route.alias("route"))
