"""The domain views of ``stockwise.sources.views`` written as DuckDB SQL.

Oracle queries reference these names; ``with_views`` prepends exactly the
CTEs a query needs (transitively), so every oracle is one self-contained SQL
string over the driver's base tables.
"""

from __future__ import annotations

import re

from stockwise.sources.views import CHANNEL_SQL, DESCRIPTION_SQL

VIEW_SQL: dict[str, str] = {
    "sales_items": f"""
SELECT 'F' || CAST(o_orderkey AS VARCHAR) AS salesinvoiceid,
       CASE WHEN o_orderstatus = 'F' THEN 'Factura' ELSE 'Boleta' END AS doctype_name,
       CAST(l_linenumber AS VARCHAR) AS docnumber,
       o_custkey AS customer_customerid,
       c_name AS customer_name,
       'RUT-' || CAST(c_custkey % 997 AS VARCHAR) AS customer_vatid,
       'Vendedor ' || CAST(o_custkey % 9 AS VARCHAR) AS salesman_name,
       o_orderpriority AS term_name,
       n_name AS warehouse_name,
       CAST(_net_c AS DOUBLE) / 100 AS totals_net,
       CAST(_total_c - _net_c AS DOUBLE) / 100 AS totals_vat,
       CAST(_total_c AS DOUBLE) / 100 AS total_total,
       {DESCRIPTION_SQL} AS items_product_description,
       'SKU-' || CAST(p_partkey AS VARCHAR) AS items_product_sku,
       l_quantity AS items_quantity,
       CAST((2 * _ext_c + _q) // (2 * _q) AS DOUBLE) / 100 AS items_unitprice,
       CAST(o_orderdate AS DATE) AS issueddate,
       {CHANNEL_SQL} AS sales_channel,
       o_orderkey AS order_key,
       l_partkey AS product_id,
       l_suppkey AS supplier_id
FROM (
  SELECT *, (200 * _total_c + 119) // 238 AS _net_c
  FROM (
    SELECT *, (2 * _ext_c * (100 - _disc_c) * (100 + _tax_c) + 10000) // 20000 AS _total_c
    FROM (
      SELECT l.*, o.*, c.*, p.*, s.*, n.*,
             CAST(ROUND(l_extendedprice * 100) AS BIGINT) AS _ext_c,
             CAST(l_quantity AS BIGINT) AS _q,
             CAST(ROUND(l_discount * 100) AS BIGINT) AS _disc_c,
             CAST(ROUND(l_tax * 100) AS BIGINT) AS _tax_c
      FROM lineitem l
      JOIN orders o ON l.l_orderkey = o.o_orderkey
      JOIN customer c ON o.o_custkey = c.c_custkey
      JOIN part p ON l.l_partkey = p.p_partkey
      JOIN supplier s ON l.l_suppkey = s.s_suppkey
      JOIN nation n ON s.s_nationkey = n.n_nationkey
    ) x0
  ) x1
) x2""",
    "product": f"""
SELECT p_partkey AS product_id,
       'SKU-' || CAST(p_partkey AS VARCHAR) AS sku,
       p_name AS name,
       {DESCRIPTION_SQL} AS description,
       p_brand AS category,
       CAST(substr(p_brand, 7) AS INTEGER) AS category_id,
       CASE WHEN p_type = 'PROMO' THEN 'service' ELSE 'product' END AS product_type,
       p_size % 10 <> 0 AS is_active,
       p_size % 2 = 0 AS purchase_ok,
       TRUE AS sale_ok,
       p_retailprice AS list_price,
       CASE WHEN p_size % 7 = 0 THEN 0.0::DOUBLE
            ELSE CAST(CAST(ROUND(p_retailprice * 100) AS BIGINT) * 6 // 10 AS DOUBLE) / 100 END AS standard_price,
       CASE WHEN p_size % 5 = 0 THEN 'g' ELSE 'Units' END AS uom,
       p_size % 4 <> 0 AS has_bom_flag,
       e.embedding AS embedding,
       TIMESTAMP '2024-01-01 00:00:00' + to_minutes(CAST(p_partkey % 1440 AS BIGINT)) AS write_date
FROM part LEFT JOIN embeddings e ON p_partkey = e.vec_id""",
    "partner": """
SELECT b.partner_id, b.name, b.email, b.vat, b.phone, b.customer_rank, b.supplier_rank,
       coalesce(CAST(lo.last_order AS TIMESTAMP), TIMESTAMP '1994-12-31 00:00:00')
         + to_minutes(CAST(b._k % 60 AS BIGINT)) AS write_date
FROM (
  SELECT c_custkey AS partner_id, c_name AS name,
         lower(replace(c_name, '#', '.')) || '@example.com' AS email,
         'RUT-' || CAST(c_custkey % 997 AS VARCHAR) AS vat,
         '+569' || lpad(CAST(c_custkey % 100000000 AS VARCHAR), 8, '0') AS phone,
         1 AS customer_rank, 0 AS supplier_rank, CAST(c_custkey AS BIGINT) AS _k
  FROM customer
  UNION ALL
  SELECT s_suppkey + 100000000, s_name,
         lower(replace(s_name, '#', '.')) || '@example.com',
         CASE WHEN s_suppkey % 10 = 0 THEN NULL ELSE 'SUP-' || CAST(s_suppkey AS VARCHAR) END,
         '22' || lpad(CAST(s_suppkey AS VARCHAR), 7, '0'),
         0, CASE WHEN s_suppkey % 10 = 9 THEN 0 ELSE 1 END, CAST(s_suppkey AS BIGINT)
  FROM supplier
) b
LEFT JOIN (SELECT o_custkey, max(o_orderdate) AS last_order FROM orders GROUP BY o_custkey) lo
  ON b.partner_id = lo.o_custkey""",
    "sale_order": """
SELECT o_orderkey AS order_id, o_custkey AS partner_id, CAST(o_orderdate AS TIMESTAMP) AS date_order,
       CASE o_orderstatus WHEN 'F' THEN 'done' WHEN 'O' THEN 'sale' ELSE 'draft' END AS state,
       o_totalprice AS amount_total, o_orderpriority <> '5-LOW' AS invoiced, o_orderpriority AS team_name
FROM orders""",
    "sale_order_line": """
SELECT l_orderkey AS order_id, l_linenumber AS line_no, l_partkey AS product_id, l_quantity AS qty,
       ((2 * CAST(ROUND(l_extendedprice * 100) AS BIGINT) + CAST(l_quantity AS BIGINT))
         // (2 * CAST(l_quantity AS BIGINT))) / 100.0::DOUBLE AS price_unit,
       l_returnflag, l_linestatus
FROM lineitem""",
    "purchase_order_line": """
SELECT 'PO' || CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_suppkey AS VARCHAR) AS po_id,
       l_partkey AS product_id, l_suppkey + 100000000 AS partner_id, l_quantity AS qty,
       ((CAST(ROUND(l_extendedprice * 100) AS BIGINT) * 55 // 100) // CAST(l_quantity AS BIGINT)) / 100.0::DOUBLE
         AS unit_price,
       CAST(l_shipdate AS DATE) AS date_order,
       CAST(l_shipdate AS TIMESTAMP) + to_hours(CAST(l_linenumber AS BIGINT)) AS write_date,
       CASE WHEN l_linestatus = 'O' THEN 'draft' ELSE 'purchase' END AS state
FROM lineitem""",
    "bom_line": """
SELECT x.product_id, c.p_partkey AS component_id,
       CASE WHEN c.p_partkey % 5 = 0 THEN 'g' ELSE 'Units' END AS uom,
       CASE WHEN c.p_partkey % 5 = 0 THEN CAST(x.k * 250 + x.p_size AS DOUBLE)
            ELSE CAST(x.k + x.p_size % 3 AS DOUBLE) END AS product_qty
FROM (
  SELECT p_partkey AS product_id, p_size, unnest(generate_series(1, 2 + CAST(p_partkey % 3 AS INTEGER))) AS k
  FROM part WHERE p_size % 4 <> 0
) x JOIN part c ON c.p_partkey = x.product_id + x.k""",
    "inventory_quant": """
SELECT l_partkey AS product_id, l_suppkey AS location_id,
       CAST(sum(CASE l_returnflag WHEN 'A' THEN l_quantity WHEN 'R' THEN -l_quantity ELSE 0 END) AS DOUBLE) / 16
         AS quantity,
       CAST(sum(CASE WHEN l_linestatus = 'O' AND l_returnflag = 'A' THEN 1 ELSE 0 END) AS DOUBLE)
         AS reserved_quantity
FROM lineitem GROUP BY l_partkey, l_suppkey""",
    "location": """
SELECT s_suppkey AS location_id,
       CASE WHEN s_suppkey % 10 = 0 THEN 'Input' ELSE 'Stock' END AS name,
       CASE WHEN s_suppkey % 10 = 0 THEN 'transit' ELSE 'internal' END AS usage,
       'WH' || CAST(s_nationkey AS VARCHAR) AS warehouse
FROM supplier""",
    "production_order": """
SELECT event_id AS mo_id,
       'WH/MO/' || lpad(CAST(event_id AS VARCHAR), 5, '0')
         || CASE event_type WHEN 'purchase' THEN '_AUTO' WHEN 'click' THEN '_CHAT' ELSE '' END AS name,
       user_id AS product_id,
       CASE event_type WHEN 'error' THEN 'cancel' WHEN 'view' THEN 'draft'
            WHEN 'signup' THEN 'confirmed' ELSE 'progress' END AS state,
       CAST(ts AS TIMESTAMP) AS date_planned_start
FROM events""",
    "conversation_message": """
SELECT conv_id AS conversation_id, conv_id * 100 + turn AS message_id, turn,
       CASE role WHEN 'user' THEN 0 WHEN 'assistant' THEN 1 ELSE 2 END AS message_type,
       text AS content,
       TIMESTAMP '2024-01-01 00:00:00' + to_hours(CAST(conv_id % 1000 AS BIGINT))
         + to_minutes(CAST(turn AS BIGINT)) AS created_at,
       'user' || CAST(conv_id % 37 AS VARCHAR) || '@example.com' AS contact_email,
       CASE WHEN role = 'user' THEN 'user' || CAST(conv_id % 37 AS VARCHAR) || '@example.com' END AS sender_email
FROM conversations""",
    "uom": """
SELECT p_partkey AS uom_id, 'U' || CAST(p_partkey AS VARCHAR) AS name,
       CASE WHEN p_partkey < 8 THEN NULL ELSE p_partkey // 4 END AS parent_id
FROM part""",
}

_NAME_RE = {name: re.compile(rf"\b{name}\b") for name in VIEW_SQL}


def _needed(sql: str) -> list[str]:
    found: list[str] = []
    visiting: set[str] = set()

    def visit(text: str) -> None:
        for name, rx in _NAME_RE.items():
            if name not in found and name not in visiting and rx.search(text):
                visiting.add(name)
                visit(VIEW_SQL[name])
                if name not in found:
                    found.append(name)

    visit(sql)
    return found


def with_views(sql: str, extra_ctes: dict[str, str] | None = None) -> str:
    """Prefix ``sql`` with the CTEs of the domain views it references."""
    ctes = [f"{n} AS ({VIEW_SQL[n].strip()})" for n in _needed(sql + " ".join((extra_ctes or {}).values()))]
    for name, body in (extra_ctes or {}).items():
        ctes.append(f"{name} AS ({body.strip()})")
    if not ctes:
        return sql.strip()
    body = sql.strip()
    m = re.match(r"(?is)^with\s+(recursive\s+)?", body)
    if m:
        rec = "RECURSIVE " if m.group(1) else ""
        return f"WITH {rec}" + ",\n".join(ctes) + ",\n" + body[m.end():]
    return "WITH " + ",\n".join(ctes) + "\n" + body
