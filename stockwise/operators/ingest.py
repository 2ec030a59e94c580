"""Ingest transforms: ERP records and legacy invoices -> clean tables.

Business keys replace the reference's in-memory id dictionaries, so each
entity loads with joins instead of ordered, driver-side lookups.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stockwise.functions.scalars import mo_origin, name_with_attributes, neg_id
from stockwise.operators.stored import parked
from stockwise.operators.upsert import dedup_keep_last

EXCLUDED_ORDER_STATES = ("draft", "sent", "cancel")


# I1 ------------------------------------------------------------------------
def uom_roots(uom: DataFrame) -> DataFrame:
    """Root of each unit's ``parent_id`` chain by pointer jumping: round k knows
    the unit 2^k steps up, so a chain of n units needs log2(n) + 1 joins. A walk
    that meets a cycle ends at the last unit before it would repeat one; a parent
    that is not in the table is a root. One row a round reaches the driver.
    """
    from stockwise.session import cut_lineage

    units = uom.groupBy("uom_id").agg(F.max("parent_id").alias("parent_id"))
    # ``anc``: the unit reached, null beyond the root; ``root``: the last unit so far
    cur = cut_lineage(units.select("uom_id", F.col("parent_id").alias("anc"), F.coalesce("parent_id", "uom_id").alias("root")))
    rounds = max(1, cur.count()).bit_length() + 1
    for _ in range(rounds):
        ahead = cur.select(F.col("uom_id").alias("anc"), F.col("anc").alias("next"), F.col("root").alias("top"))
        cur = cut_lineage(cur.join(ahead, "anc", "left").select("uom_id", F.col("next").alias("anc"), F.coalesce("top", "root").alias("root")))
        if not cur.where(F.col("anc").isNotNull()).take(1):
            return cur.select("uom_id", F.col("root").alias("root_id"))
    endless = cur.where(F.col("anc").isNotNull()).select("uom_id")
    return cur.join(endless, "uom_id", "left_anti").select("uom_id", F.col("root").alias("root_id")).unionByName(
        _before_repeat(units.where("uom_id <> parent_id or parent_id is null"), endless))


def _before_repeat(units: DataFrame, endless: DataFrame) -> DataFrame:
    """(uom_id, root_id) of units whose walk meets a cycle: the unit in front of
    the first one that the walk has seen. Rounds: the longest such walk."""
    from stockwise.session import cut_lineage

    up = units.join(endless, "uom_id", "left_semi").select(F.col("uom_id").alias("at"), F.col("parent_id").alias("next"))
    walk = endless.select("uom_id", F.col("uom_id").alias("at"), F.array("uom_id").alias("seen"))
    done = None
    while True:
        ahead = cut_lineage(walk.join(up, "at", "left").withColumn(
            "ends", F.col("next").isNull() | F.array_contains("seen", F.coalesce("next", "at"))))
        ended = ahead.where("ends").select("uom_id", F.col("at").alias("root_id"))
        done = ended if done is None else done.unionByName(ended)
        walk = ahead.where("not ends").select("uom_id", F.col("next").alias("at"), F.array_append("seen", F.col("next")).alias("seen"))
        if not walk.take(1):
            return done


# I2 ------------------------------------------------------------------------
def canonical_partners(partner: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Partners grouped by VAT: the newest write_date wins (ties: lowest id);
    partners without VAT map to themselves. Returns (canonical, remap)."""
    with_vat = partner.where(F.col("vat").isNotNull() & (F.trim("vat") != ""))
    winners = with_vat.groupBy("vat").agg(F.max_by("partner_id", F.struct(
        "write_date", (-F.col("partner_id")).alias("neg_id"))).alias("canonical_id"))
    remap = (partner.join(winners, "vat", "left")
             .select("partner_id", F.coalesce("canonical_id", "partner_id").alias("canonical_id")))
    canonical = partner.join(remap.where(F.col("partner_id") == F.col("canonical_id")).select("partner_id"),
                             "partner_id", "left_semi")
    return canonical, remap


# I3 ------------------------------------------------------------------------
def sync_products(product: DataFrame, attributes: DataFrame, uom: DataFrame) -> DataFrame:
    """Drop services, name = base + ' (a, b)', uom lookup, standard price
    0/False -> NULL."""
    p = product.where(F.col("product_type") != "service")
    p = p.join(attributes, "product_id", "left")
    u = uom.select(F.col("name").alias("uom"), F.col("uom_id"))
    p = p.join(u, "uom", "left")
    return p.select(
        "product_id", "sku", name_with_attributes("name", "attrs").alias("display_name"), "uom_id",
        F.when(F.col("standard_price") == 0, None).otherwise(F.col("standard_price")).alias("standard_price"))


# I5 ------------------------------------------------------------------------
def sync_production_orders(mo: DataFrame) -> DataFrame:
    return mo.withColumn("origin", mo_origin("name"))


# I6 ------------------------------------------------------------------------
def sync_orders(orders: DataFrame, remap: DataFrame) -> DataFrame:
    """Exclude draft/sent/cancel; partner through the canonical remap."""
    o = orders.where(~F.col("state").isin(*EXCLUDED_ORDER_STATES))
    r = remap.select(F.col("partner_id"), F.col("canonical_id"))
    return o.join(r, "partner_id", "left").withColumn(
        "partner_id", F.coalesce("canonical_id", "partner_id")).drop("canonical_id")


def sync_lines(lines: DataFrame, orders: DataFrame, product: DataFrame, key: str = "order_id") -> DataFrame:
    """Lines of the synced ``orders``; a product that is not in the catalogue
    becomes NULL, a missing quantity or price 0."""
    known = product.select(F.col("product_id").alias("known_product")).distinct()
    return (lines.join(orders.select(key), key, "left_semi")
            .join(known, F.col("product_id") == F.col("known_product"), "left")
            .withColumns({"product_id": F.col("known_product"), "qty": F.coalesce("qty", F.lit(0)),
                          "unit_price": F.coalesce("unit_price", F.lit(0.0))}).drop("known_product"))


def sync_purchase_orders(lines: DataFrame, remap: DataFrame) -> DataFrame:
    """One purchase order per ``po_id``, its partner through the remap; sums in cents."""
    cents = F.round(F.col("qty") * F.col("unit_price") * 100).cast("long")
    orders = lines.groupBy("po_id").agg(F.min("partner_id").alias("partner_id"), F.min("date_order").alias("date_order"),
                                        F.sum(cents).alias("cents"), F.count_if(F.col("state") == "draft").alias("drafts"))
    return (orders.join(remap.select("partner_id", "canonical_id"), "partner_id", "left")
            .select("po_id", F.coalesce("canonical_id", "partner_id").alias("partner_id"), "date_order",
                    (F.col("cents") / 100).alias("amount_total"), F.when(F.col("drafts") > 0, "draft").otherwise("purchase").alias("state")))


def sync_quants(quants: DataFrame, product: DataFrame, location: DataFrame) -> DataFrame:
    """Stock rows with product and location looked up, NULL where unknown."""
    p = product.select(F.col("product_id").alias("known_product")).distinct()
    place = location.select(F.col("location_id").alias("known_location")).distinct()
    return (quants.join(p, F.col("product_id") == F.col("known_product"), "left")
            .join(place, F.col("location_id") == F.col("known_location"), "left")
            .select(F.col("known_product").alias("product_id"), F.col("known_location").alias("location_id"),
                    F.coalesce("quantity", F.lit(0.0)).alias("quantity"), F.coalesce("reserved_quantity", F.lit(0.0)).alias("reserved_quantity")))


# I7 / I8 --------------------------------------------------------------------
def good_lines(staging: DataFrame, product: DataFrame, parts: tuple[int, ...] = ()) -> DataFrame:
    """Newest document of each (invoice, SKU) with its product, of invoices whose
    SKUs are all known: one flag per invoice over the lines, no second join. The whole
    rows decide which is newest; its few columns are stored, and the others' shuffle
    files are gone when they are joined. ``parts``: as for ``dedup_keep_last``."""
    newest = dedup_keep_last(staging, ["salesinvoiceid", "items_product_sku"], ["docnumber"], parts)
    newest = parked(newest.select("salesinvoiceid", "items_product_sku", "issueddate", "total_total", "items_quantity", "items_unitprice"))
    newest = newest.repartition(*parts, "items_product_sku") if parts else newest
    lines = newest.join(
        product.select(F.col("sku").alias("items_product_sku"), F.col("product_id").alias("pid")), "items_product_sku", "left")
    lines = lines.repartition(*parts, "salesinvoiceid") if parts else lines
    known = F.min(F.col("pid").isNotNull()).over(Window.partitionBy("salesinvoiceid"))
    return lines.withColumns({"known": known, "invoice_id": neg_id("salesinvoiceid")}).where("known")


def orders_of(good: DataFrame) -> DataFrame:
    return (good.groupBy("salesinvoiceid", F.col("invoice_id").alias("odoo_id"))
            .agg(F.max("issueddate").alias("date_order"), F.max("total_total").alias("amount_total"))
            .select("odoo_id", "salesinvoiceid", "date_order", "amount_total", F.lit("done").alias("state")))


def lines_of(good: DataFrame) -> DataFrame:
    return good.select(
        neg_id(F.concat("salesinvoiceid", "items_product_sku")).alias("odoo_id"), F.col("invoice_id").alias("order_odoo_id"),
        F.col("pid").alias("product_id"), F.col("items_quantity").alias("quantity"), F.col("items_unitprice").alias("unit_price"))


def legacy_orders(staging: DataFrame, product: DataFrame, parts: tuple[int, ...] = ()) -> DataFrame:
    """One order per invoice without unknown SKUs: latest date, largest total."""
    return orders_of(good_lines(staging, product, parts))


def legacy_lines(staging: DataFrame, product: DataFrame, parts: tuple[int, ...] = ()) -> DataFrame:
    """The lines of those orders, ids hashed from invoice and SKU."""
    return lines_of(good_lines(staging, product, parts))


def legacy_line_id(invoice, sku) -> F.Column:
    return neg_id(invoice, sku)


# I9 / I10 / I11 --------------------------------------------------------------
def local_day_range_utc(start: dt.date, end: dt.date, tz: str = "America/Santiago"):
    """[start 00:00, end 23:59:59.999] local time as UTC timestamp columns."""
    lo = F.to_utc_timestamp(F.lit(dt.datetime.combine(start, dt.time(0, 0))), tz)
    hi = F.to_utc_timestamp(F.lit(dt.datetime.combine(end, dt.time(23, 59, 59, 999000))), tz)
    return lo, hi


def filter_orders(orders: DataFrame, lo, hi) -> DataFrame:
    """Sale orders: state sale/done, invoiced, date within [lo, hi]."""
    return orders.where(F.col("state").isin("sale", "done") & F.col("invoiced")
                        & (F.col("date_order") >= lo) & (F.col("date_order") <= hi))


def filter_pos_orders(orders: DataFrame, lo, hi) -> DataFrame:
    """Point-of-sale orders: state paid/done/invoiced, date within [lo, hi].
    They have no team: the shop's own name in the order name gives the channel."""
    kept = orders.where(F.col("state").isin("paid", "done", "invoiced") & (F.col("date_order") >= lo) & (F.col("date_order") <= hi))
    return kept.withColumn("team_name", F.when(F.col("name").contains("Juan Sabaj"), "Tienda Sabaj"))


def orders_to_sales_items(orders: DataFrame, lines: DataFrame, product: DataFrame, partner: DataFrame,
                          source: str = "sale") -> DataFrame:
    """Orders x lines x products x partners -> the 18-column sales shape.
    Keyed by (source, order_id) so ids of different sources never collide."""
    p = product.select("product_id", "sku", F.col("name").alias("pname"))
    c = partner.select("partner_id", F.col("name").alias("cname"), "vat")
    df = orders.join(lines, "order_id").join(p, "product_id", "left").join(c, "partner_id", "left")
    total = F.round(F.col("qty") * F.col("price_unit"), 2)
    net = F.round(total / 1.19, 2)
    return df.select(
        F.lit(source).alias("source"), "order_id",
        F.concat(F.lit("S"), F.col("order_id").cast("string")).alias("salesinvoiceid"),
        F.col("partner_id").alias("customer_customerid"), F.col("cname").alias("customer_name"),
        F.col("vat").alias("customer_vatid"), total.alias("total_total"), net.alias("totals_net"),
        F.round(total - net, 2).alias("totals_vat"), F.col("pname").alias("items_product_description"),
        F.col("sku").alias("items_product_sku"), F.col("qty").alias("items_quantity"),
        F.col("price_unit").alias("items_unitprice"), F.to_date("date_order").alias("issueddate"),
        F.when(F.col("team_name").contains("Tienda Sabaj"), "Tienda Sabaj")
        .when(F.col("team_name").isNotNull(), F.col("team_name")).otherwise("Otro").alias("sales_channel"))


# I12 / I13 ------------------------------------------------------------------
def map_product_columns(raw: DataFrame, name_limit: int = 255) -> DataFrame:
    """Rename ERP fields, add defaults and a rejection reason."""
    df = raw.select(
        F.upper(F.trim("default_code")).alias("sku"), F.left(F.col("name"), F.lit(name_limit)).alias("name"),
        F.coalesce("list_price", F.lit(0.0)).alias("list_price"),
        F.coalesce("standard_price", F.lit(0.0)).alias("standard_price"),
        F.coalesce("active", F.lit(True)).alias("is_active"), F.lit(True).alias("sale_ok"),
        F.coalesce("purchase_ok", F.lit(False)).alias("purchase_ok"))
    reason = (F.when(F.col("sku").isNull() | F.col("sku").isin("", "NONE", "FALSE"), "invalid_sku")
              .when(F.col("name").isNull() | (F.trim("name") == ""), "invalid_name")
              .when(~F.col("is_active"), "inactive"))
    return df.withColumn("reject_reason", reason)


# I16 / I17 ------------------------------------------------------------------
def partners_by_email(partner: DataFrame, emails: DataFrame) -> DataFrame:
    e = emails.select(F.lower(F.trim("email")).alias("__e")).distinct()
    return partner.where(F.col("customer_rank") > 0).join(e, F.lower("email") == e["__e"], "left_semi")


PARTNER_KEYS = ("id", "vat", "email", "name", "phone")


def partner_key(field: str, value) -> F.Column:
    """What two values of a field must share: digits of ids and phones (last
    nine), the rest trimmed, in lower case."""
    text = F.lower(F.trim(value.cast("string")))
    return F.right(F.regexp_replace(text, r"\D", ""), F.lit(9)) if field == "phone" else text


def lookup_partners(partner: DataFrame, requests: DataFrame, customers_only: bool = True) -> DataFrame:
    """``requests`` (request_id, field, value) with the customer of smallest id
    whose field has the same key, NULL where there is none. Each (field, key) is
    reduced to its one answer before the join, so a repeated VAT is one row."""
    rows = partner.where("customer_rank > 0") if customers_only else partner
    columns = {"id": F.col("partner_id"), **{f: F.col(f) for f in PARTNER_KEYS[1:]}}
    keys = F.array(*[F.struct(F.lit(f).alias("field"), partner_key(f, c).alias("key")) for f, c in columns.items()])
    answers = (rows.select("partner_id", "name", F.explode(keys).alias("k")).where("k.key <> ''")
               .groupBy("k.field", "k.key").agg(F.min_by(F.struct("partner_id", "name"), "partner_id").alias("found")))
    key = F.coalesce(*[F.when(F.col("field") == f, partner_key(f, F.col("value"))) for f in PARTNER_KEYS])
    return (requests.withColumn("key", key).join(answers, ["field", "key"], "left")
            .select("request_id", "field", "value", F.col("found.partner_id").alias("partner_id"), F.col("found.name").alias("name")))


def new_statement_lines(lines: DataFrame, existing: DataFrame) -> DataFrame:
    """Skip statement lines whose (journal, ref) already exists."""
    return lines.join(existing.select("journal", "ref").distinct(), ["journal", "ref"], "left_anti")
