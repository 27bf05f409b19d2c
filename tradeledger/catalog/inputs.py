"""The given tables seen as the inputs of the plans.

Each view is one SQL text that Spark and DuckDB both run (or a pair where the dialects differ), so
a registered query and its check start from the same rows. ``{name}`` is a table or another view;
a literal brace is doubled.
"""

from __future__ import annotations

from string import Formatter

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()

STORE_TYPE = (
    "CASE WHEN c_mktsegment IN ('AUTOMOBILE', 'BUILDING', 'FURNITURE') "
    "THEN 'Dispensary' ELSE 'Delivery' END"
)
NUMBER = "regexp_extract(props, '([0-9]+)', 1)"
MONEY = "DECIMAL(12,2)"

VIEWS: dict[str, str | tuple[str, str]] = {
    # --- orders, relations, returns
    "order_header": f"""
        SELECT o_orderkey AS order_id, o_orderkey AS so_number, o_custkey AS customer_id,
          o_orderdate AS ordered_at, o_orderpriority AS salesperson,
          CAST(o_totalprice AS {MONEY}) AS total
        FROM {{orders}}""",
    "order_line": f"""
        SELECT l_orderkey AS order_id, l_partkey AS item, l_suppkey AS car_id,
          CAST(CASE WHEN l_returnflag = 'R' THEN -l_quantity ELSE l_quantity END AS DECIMAL(9,2)) AS quantity,
          CAST(CASE WHEN p_type = 'PROMO' THEN -l_extendedprice ELSE l_extendedprice END AS {MONEY}) AS sale_price,
          CAST(l_extendedprice AS {MONEY}) AS jobber_price,
          CAST(p_retailprice AS {MONEY}) AS item_cost
        FROM {{lineitem}} JOIN {{part}} ON l_partkey = p_partkey""",
    "items": """
        SELECT p_partkey AS item, p_brand AS cuc, p_type AS category,
          CASE WHEN length(p_brand) = 7 THEN 'CORE-1' ELSE 'CORE-2' END AS core_type
        FROM {part}""",
    "relations": (
        # One scan: what an order points to as an array.
        """
        SELECT source, target, relation_type, related_at FROM (
          SELECT o_orderkey AS source, o_orderdate AS related_at, inline(filter(array(
            named_struct('target', o_orderkey + 1, 'relation_type', 6, 'held', o_orderpriority > '2-HIGH'),
            named_struct('target', o_orderkey + 3, 'relation_type', 5, 'held', o_orderpriority = '1-URGENT' AND o_orderstatus = 'P'),
            named_struct('target', o_orderkey + 5, 'relation_type', 4, 'held', o_orderstatus = 'F'),
            named_struct('target', o_orderkey + 7, 'relation_type', 8, 'held', o_orderpriority = '2-HIGH' AND o_orderstatus = 'O')),
            one -> one.held))
          FROM {orders})""",
        """
        SELECT o_orderkey AS source, o_orderkey + 1 AS target, 6 AS relation_type, o_orderdate AS related_at
        FROM {orders} WHERE o_orderpriority > '2-HIGH'
        UNION ALL
        SELECT o_orderkey, o_orderkey + 3, 5, o_orderdate
        FROM {orders} WHERE o_orderpriority = '1-URGENT' AND o_orderstatus = 'P'
        UNION ALL
        SELECT o_orderkey, o_orderkey + 5, 4, o_orderdate FROM {orders} WHERE o_orderstatus = 'F'
        UNION ALL
        SELECT o_orderkey, o_orderkey + 7, 8, o_orderdate
        FROM {orders} WHERE o_orderpriority = '2-HIGH' AND o_orderstatus = 'O'""",
    ),
    "pickups": """
        SELECT o_orderkey AS pickup_id, o_orderkey AS so_number,
          CASE WHEN o_orderstatus = 'P' THEN 3 ELSE 9 END AS pickup_type,
          CASE o_orderpriority WHEN '5-LOW' THEN 1 WHEN '4-NOT SPECIFIED' THEN NULL ELSE 0 END AS deleted,
          o_orderdate AS created_at
        FROM {orders}""",
    "pickup_lines": """
        SELECT l_orderkey AS pickup_id, l_partkey AS item, l_linenumber AS reason_id
        FROM {lineitem} WHERE l_returnflag = 'R'""",
    "reasons": """
        SELECT n_nationkey AS reason_id,
          CASE n_nationkey WHEN 1 THEN 'Phone mistake' WHEN 2 THEN 'Shop Lost Customer'
            WHEN 3 THEN 'Cust did not order' ELSE n_name END AS reason_name
        FROM {nation}""",
    # --- calendar, stock, lookups
    "calendar": (
        """
        SELECT day, CAST(date_trunc('WEEK', day) AS DATE) AS fiscal_week,
          CAST(date_trunc('MONTH', day) AS DATE) AS fiscal_month
        FROM (SELECT explode(sequence(low, high, INTERVAL 1 DAY)) AS day
              FROM (SELECT CAST(min(o_orderdate) AS DATE) AS low,
                      CAST(max(o_orderdate) + INTERVAL 366 DAY AS DATE) AS high FROM {orders}))""",
        """
        SELECT day, CAST(date_trunc('week', day) AS DATE) AS fiscal_week,
          CAST(date_trunc('month', day) AS DATE) AS fiscal_month
        FROM (SELECT CAST(unnest(generate_series(low, high, INTERVAL 1 DAY)) AS DATE) AS day
              FROM (SELECT min(o_orderdate) AS low, max(o_orderdate) + INTERVAL 366 DAY AS high FROM {orders}))""",
    ),
    "stock": """
        SELECT l_partkey AS item, CASE WHEN s_acctbal > 0 THEN 30 ELSE 31 END AS warehouse_id,
          CAST(l_shipdate AS DATE) AS effective_date, CAST(l_quantity AS INT) AS on_hand
        FROM {lineitem} JOIN {supplier} ON l_suppkey = s_suppkey""",
    "stock_recent": "SELECT * FROM {stock} WHERE effective_date >= DATE '2000-06-01'",
    "stock_middle": """
        SELECT item, warehouse_id, effective_date, on_hand - 1 AS on_hand FROM {stock}
        WHERE effective_date >= DATE '1998-01-01' AND effective_date < DATE '2001-01-01'""",
    "stock_old": "SELECT * FROM {stock} WHERE effective_date < DATE '1998-03-01'",
    "lookups": """
        SELECT CASE WHEN l_linestatus = 'O' THEN o_orderdate ELSE l_shipdate END AS lookup_at,
          o_custkey AS customer_id, o_orderpriority AS salesperson, p_brand AS cuc, l_suppkey AS car_id
        FROM {lineitem} JOIN {orders} ON l_orderkey = o_orderkey JOIN {part} ON l_partkey = p_partkey""",
    "model_stock": """
        SELECT p_brand AS cuc, CAST(date_trunc('week', l_shipdate) AS DATE) AS fiscal_week,
          30 AS warehouse_id, l_linenumber - 4 AS roh
        FROM {lineitem} JOIN {part} ON l_partkey = p_partkey""",
    "unit_cost": f"""
        SELECT p_brand AS cuc, max(CAST(p_retailprice AS {MONEY})) AS cost FROM {{part}} GROUP BY p_brand""",
    # --- buying groups
    "members": """
        SELECT c_custkey AS customer_id, c_nationkey AS group_id, DATE '1994-01-01' AS activated,
          CASE WHEN c_acctbal < 0 THEN DATE '1997-01-01' END AS deactivated
        FROM {customer}""",
    "buying_groups": """
        SELECT n_nationkey AS group_id, n_name AS group_name, CAST(n_regionkey + 1 AS DECIMAL(5,2)) AS rebate_pct
        FROM {nation}""",
    "customer_view": """
        SELECT c_custkey AS customer_id, c_nationkey AS warehouse_id, c_name AS company_name,
          CASE WHEN c_mktsegment = 'MACHINERY' THEN 2 ELSE 1 END AS status
        FROM {customer}""",
    "charges": f"""
        SELECT l_orderkey AS so_number,
          CASE l_returnflag WHEN 'A' THEN 113 WHEN 'N' THEN 110 ELSE 111 END AS fee_code,
          CAST(l_extendedprice AS {MONEY}) * CAST(l_tax AS DECIMAL(4,2)) AS amount
        FROM {{lineitem}}""",
    # --- pricing
    "pricing": f"""
        SELECT l_orderkey AS so_number, CAST(o_orderdate AS DATE) AS priced_on, o_custkey AS customer_id,
          l_partkey AS item, l_linenumber AS line_number, l_suppkey AS supplier, p_type AS category,
          'b' || CAST(l_linenumber AS STRING) AS pricing_plan, split_part(p_name, ' ', 1) AS quote_user,
          CASE WHEN l_linestatus = 'F' THEN CAST(l_quantity AS DECIMAL(9,2)) END AS sales_qty,
          CAST(l_extendedprice AS {MONEY}) AS sale_price
        FROM {{lineitem}} JOIN {{orders}} ON l_orderkey = o_orderkey JOIN {{part}} ON l_partkey = p_partkey""",
    "shops": """
        SELECT c_custkey AS customer_id, CASE WHEN c_mktsegment = 'HOUSEHOLD' THEN 'Re' ELSE 'Sh' END AS shop_type,
          c_name AS company_name
        FROM {customer}""",
    "price_rows": f"""
        SELECT CAST(l_shipdate AS DATE) AS priced_on, o_custkey AS customer_id, l_suppkey AS app_id,
          l_linenumber AS warehouse_id, l_returnflag AS style, p_type AS category, p_type AS pricing_plan,
          p_brand || '-' || CAST(p_size AS STRING) AS cuc,
          CASE WHEN l_tax < 0.05 THEN 1 ELSE 0 END AS in_stock,
          CASE WHEN l_linestatus = 'F' THEN CAST(l_quantity AS DECIMAL(9,2)) END AS sales_qty,
          CASE WHEN l_linestatus = 'F' AND NOT (l_tax > 0.075 AND l_discount > 0.095 AND l_linenumber = 7)
            THEN CAST(l_extendedprice AS {MONEY}) END AS sale_price
        FROM {{lineitem}} JOIN {{orders}} ON l_orderkey = o_orderkey JOIN {{part}} ON l_partkey = p_partkey""",
    # --- places
    "route_customers": """
        SELECT c_custkey AS customer_id, c_nationkey AS warehouse_id, c_name AS company_name,
          substring(c_mktsegment, 1, 1) AS route_code, CASE WHEN c_acctbal < 0 THEN 'X' ELSE 'a' END AS status
        FROM {customer}""",
    "warehouses": """
        SELECT n_nationkey AS warehouse_id, CAST(30 AS DOUBLE) + CAST(n_nationkey AS DOUBLE) / 2 AS warehouse_latitude,
          CAST(-100 AS DOUBLE) + CAST(n_nationkey AS DOUBLE) AS warehouse_longitude
        FROM {nation}""",
    "geocodes": """
        SELECT c_custkey AS customer_id, c_nationkey AS geocode_status_id,
          CAST(30 AS DOUBLE) + CAST(c_nationkey AS DOUBLE) / 2 + c_acctbal / CAST(100003 AS DOUBLE) AS latitude,
          CAST(-100 AS DOUBLE) + CAST(c_nationkey AS DOUBLE) - c_acctbal / CAST(80021 AS DOUBLE) AS longitude
        FROM {customer}""",
    "geocode_status": "SELECT n_nationkey AS geocode_status_id FROM {nation}",
    # --- audit logs
    "deal_audits": f"""
        SELECT event_id AS audit_id, user_id AS deal_date_id, user_id + 1000 AS deal_id, ts AS created_at,
          CASE event_type WHEN 'signup' THEN 'create' WHEN 'error' THEN 'destroy' ELSE 'update' END AS action,
          CASE event_type
            WHEN 'signup' THEN '{{{{"listing_id":"' || CAST(user_id AS STRING)
              || '","listing_type":"Dispensary","dtstart":"' || CAST(CAST(ts AS DATE) AS STRING)
              || 'T00:00:00","rrule":"FREQ=WEEKLY;BYDAY=MO,WE;UNTIL=20240125"}}}}'
            WHEN 'click' THEN '{{{{"rrule":["FREQ=WEEKLY;BYDAY=MO","FREQ=DAILY;UNTIL=20240120"]}}}}'
            WHEN 'view' THEN '{{{{"dtstart":["2024-01-01T00:00:00","' || CAST(CAST(ts AS DATE) AS STRING)
              || 'T00:00:00"],"rrule":["FREQ=DAILY",""]}}}}'
            WHEN 'purchase' THEN '{{{{"listing_id":["1","' || {NUMBER}
              || '"],"rrule":["FREQ=DAILY","FREQ=WEEKLY;BYDAY=TU,SA,SU"]}}}}'
            ELSE '{{{{}}}}' END AS changes
        FROM {{events}}""",
    "accounts": "SELECT o_custkey AS account_id, min(o_orderdate) AS created_at FROM {orders} GROUP BY o_custkey",
    "top_levels": "SELECT c_custkey AS account_id, CAST(floor(c_custkey / 2) AS BIGINT) AS top_level_id FROM {customer}",
    "account_history": f"""
        SELECT user_id AS account_id, CASE WHEN event_type IN ('click', 'view', 'purchase') THEN 'Owner' ELSE 'Name' END AS field,
          ts AS changed_at, CAST(user_id AS STRING) AS old_value, {NUMBER} AS new_value
        FROM {{events}}""",
    "owners": "SELECT CAST(s_suppkey AS STRING) AS user_id, s_name AS user_name FROM {supplier}",
    "retailers": f"""
        SELECT c_custkey AS vr_id, c_nationkey AS status, c_nationkey AS brand_id, c_custkey AS listing_id,
          {STORE_TYPE} AS listing_type,
          (SELECT min(ts) FROM {{events}}) - INTERVAL 25 YEAR - INTERVAL 30 DAY AS created_at
        FROM {{customer}}""",
    "status_audits": f"""
        SELECT event_id AS audit_id, user_id AS auditable_id, ts - INTERVAL 25 YEAR AS created_at,
          CASE WHEN event_type = 'error' THEN 'Other' ELSE 'VerifiedRetailer' END AS auditable_type,
          CASE event_type WHEN 'signup' THEN '{{{{"status":"0"}}}}'
            WHEN 'view' THEN '{{{{"status":["0","1"]}}}}' WHEN 'click' THEN '{{{{"status":["1","2"]}}}}'
            ELSE '{{{{"status":["2","' || substring({NUMBER}, 1, 1) || '"]}}}}' END AS changes
        FROM {{events}}""",
    # --- marketplace
    "stores": f"""
        SELECT c_custkey AS core_id, {STORE_TYPE} AS core_type, 100000000 + c_custkey AS wmid,
          n_regionkey AS region_id,
          CASE WHEN c_acctbal < 1000 THEN 100000000 + CAST(floor(c_custkey / 2) AS BIGINT) END AS menu_override_id
        FROM {{customer}} JOIN {{nation}} ON c_nationkey = n_nationkey""",
    "dispensaries": "SELECT * EXCEPT (core_type) FROM {stores} WHERE core_type = 'Dispensary'",
    "deliveries": "SELECT * EXCEPT (core_type) FROM {stores} WHERE core_type = 'Delivery'",
    "regions": "SELECT r_regionkey AS region_id, r_name AS region FROM {region}",
    "region_names": """
        SELECT lower(r_name) AS region_name,
          CASE WHEN r_name IN ('AMERICA', 'EUROPE') THEN 'West' ELSE 'Other' END AS super_region
        FROM {region}""",
    "listings": "SELECT c_custkey AS listing_id, 3 AS listing_type, 100000000 + c_custkey AS wmid FROM {customer}",
    "market_orders": """
        SELECT o_orderkey AS order_id, o_orderdate AS order_time, o_custkey AS listing_id, 1 AS order_listing_type,
          o_custkey AS account_id, CASE WHEN o_orderstatus = 'P' THEN 0 ELSE 1 END AS status
        FROM {orders}""",
    "order_items": f"""
        SELECT l_orderkey AS order_id, CAST(l_extendedprice AS {MONEY}) AS price, CAST(l_quantity AS INT) AS amount,
          l_suppkey AS brand_id
        FROM {{lineitem}}""",
    "buyers": """
        SELECT c_custkey AS account_id,
          c_name || CASE WHEN c_mktsegment = 'MACHINERY' THEN '@staff.example' ELSE '@shop.example' END AS email
        FROM {customer}""",
    "menu_audits_raw": f"""
        SELECT event_id AS audit_id, user_id AS core_id, ts - INTERVAL 25 YEAR AS created_at,
          CASE WHEN event_type = 'signup' THEN 'create' ELSE 'update' END AS action,
          CASE event_type
            WHEN 'view' THEN '{{{{"menu_override_id":[null,' || CAST(100000000 + user_id AS STRING) || ']}}}}'
            WHEN 'click' THEN '{{{{"menu_override_id":[' || CAST(100000000 + user_id AS STRING) || ',null]}}}}'
            WHEN 'error' THEN '{{{{"name":["a","b"]}}}}'
            WHEN 'purchase' THEN '{{{{"menu_override_id":[' || {NUMBER} || ',' || '1000000' || substring({NUMBER}, 1, 1) || '0]}}}}'
            ELSE '{{{{"menu_override_id":' || CAST(100000000 + user_id AS STRING) || '}}}}' END AS changes
        FROM {{events}}""",
    "menu_audits": """
        SELECT *, 'Dispensary' AS core_type FROM {menu_audits_raw}
        UNION ALL SELECT *, 'Delivery' FROM {menu_audits_raw}""",
    # --- web impressions
    "batches": f"""
        SELECT event_id, ts AS batch_time, 'u' || CAST(user_id AS STRING) AS anonymous_id,
          CASE WHEN event_type = 'error' THEN 'Search' ELSE 'Home' END AS location, 'Region ' || {NUMBER} AS region_name,
          '[' || CASE WHEN event_type IN ('view', 'click', 'purchase', 'error') THEN
            '{{{{"section_name":"Deals Nearby","listing_id":"' || CAST(user_id AS STRING)
            || '","listing_type":"dispensary","deal_id":"' || CAST(event_id AS STRING) || '","brand_id":"7","position":"1","timestamp":"'
            || replace(CAST(ts AS STRING), ' ', 'T') || 'Z"}}}}' ELSE '' END
          || CASE WHEN event_type IN ('view', 'purchase') THEN
            ',{{{{"timestamp":"' || replace(CAST(ts AS STRING), ' ', 'T')
            || 'Z","section_name":"Featured Brands","brand_id":"' || {NUMBER} || '","product_id":"9","position":"2"}}}}' ELSE '' END
          || CASE WHEN event_type = 'purchase' THEN
            ',{{{{"section_name":"Trending","brand_id":"' || {NUMBER} || '","product_id":"' || CAST(event_id AS STRING)
            || '","extra":{{{{"a":1}}}},"timestamp":"' || replace(CAST(ts AS STRING), ' ', 'T') || 'Z"}}}}' ELSE '' END
          || ']' AS events
        FROM {{events}}""",
    # --- release notes
    "uploads": """
        SELECT o_orderstatus AS source_file, o_orderpriority AS release_name,
          CAST(year(o_orderdate) AS STRING) AS release_version, CAST(o_orderkey AS STRING) AS part_number
        FROM {orders}""",
    "releases": """
        SELECT o_orderpriority AS releasename, CAST(year(o_orderdate) AS STRING) AS releaseversion,
          c_mktsegment AS productname,
          CASE WHEN c_mktsegment = 'BUILDING' THEN 'orders: ' || CAST(count(*) AS STRING) END AS rmnotes
        FROM {orders} JOIN {customer} ON o_custkey = c_custkey
        WHERE o_orderpriority <> '5-LOW'
        GROUP BY o_orderpriority, year(o_orderdate), c_mktsegment""",
    "products": """
        SELECT c_mktsegment AS productname,
          CASE WHEN c_mktsegment < 'C' THEN 'customers: ' || CAST(count(*) AS STRING) END AS rmnotes
        FROM {customer} GROUP BY c_mktsegment""",
}


def fields(text: str) -> list[str]:
    """Names in braces, in order of first use."""
    return list(dict.fromkeys(name for _, name, _, _ in Formatter().parse(text) if name))


class Inputs:
    """Tables and views of one data folder."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder
        self._tables: dict[str, DataFrame] = {}

    def table(self, name: str) -> DataFrame:
        if name not in self._tables:
            self._tables[name] = self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        return self._tables[name]

    def view(self, name: str) -> DataFrame:
        if name in TABLES:
            return self.table(name)
        text = VIEWS[name]
        text = text if isinstance(text, str) else text[0]
        return self.spark.sql(text, **{f: self.view(f) for f in fields(text)})

    def __getattr__(self, name: str) -> DataFrame:
        if name in TABLES or name in VIEWS:
            return self.view(name)
        raise AttributeError(name)


def check_sql(text: str, stages: dict[str, str]) -> str:
    """DuckDB text with the views and stages it names put in front as common table expressions."""
    order: dict[str, str] = {}

    def visit(body: str) -> str:
        names = fields(body)
        for name in names:
            if name in TABLES or name in order:
                continue
            inner = stages.get(name) or VIEWS[name]
            order_text = visit(inner if isinstance(inner, str) else inner[1])
            order[name] = order_text
        return body.format(**{n: n for n in names})

    main = visit(text)
    if not order:
        return main.strip()
    ctes = ",\n".join(f"{name} AS ({body})" for name, body in order.items())
    return f"WITH RECURSIVE {ctes}\n{main.strip()}"
