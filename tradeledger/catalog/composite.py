"""The end-to-end plans over the given tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from tradeledger.catalog.analytic import (
    CONVERSION,
    CURVE,
    OLS,
    PERIODS_SQL,
    ROLLING,
    SUMMARY,
    curve,
    monthly,
    shown,
)
from tradeledger.catalog.inputs import Inputs
from tradeledger.catalog.registry import STAGES, query
from tradeledger.catalog.relational import AS_OF, MILES_SQL, RATE_SQL, TZ
from tradeledger.plans import history, impressions, opportunity, prices, pricing, rebates, release_notes, sales
from tradeledger.session import scratch_path
from tradeledger.sources.write import materialise_stage, sink_incremental_append, sink_multi_report

CATEGORY, PROMO, SINCE, WAREHOUSE = "STANDARD", "PROMO", "1995-01-01", 30
LINE_COLUMNS = "so_number, item, car_id, jobber_price::DOUBLE AS jobber_price, item_cost::DOUBLE AS item_cost, sale_price::DOUBLE AS sale_price"

# ---------------------------------------------------------------- sales

STAGES["sales"] = f"""
  SELECT o.customer_id, CAST(o.ordered_at AS DATE) AS sale_date, i.cuc, i.category, o.so_number, o.order_id, o.salesperson, i.core_type,
    l.item, l.car_id, l.jobber_price, l.item_cost, l.sale_price, sum(l.quantity) AS quant_sold, sum(l.quantity * l.sale_price) AS ext_sold,
    CASE WHEN o.so_number IN (SELECT source FROM {{relations}} WHERE relation_type = 5) THEN 1 ELSE 0 END AS was_admin,
    CASE WHEN o.so_number IN (SELECT source FROM {{relations}} WHERE relation_type = 6) THEN 1 ELSE 0 END AS was_adjust
  FROM {{order_line}} l JOIN {{order_header}} o USING (order_id) JOIN {{items}} i USING (item)
  WHERE i.category = '{CATEGORY}' AND o.ordered_at >= TIMESTAMP '{SINCE}' GROUP BY ALL"""
STAGES["coupons"] = f"""
  SELECT o.so_number, min(i.cuc) AS coupon_code, sum(l.quantity * l.sale_price) AS amount,
    sum(CASE WHEN l.quantity * l.sale_price > 0 THEN -abs(l.quantity) ELSE l.quantity END) AS quant
  FROM {{order_line}} l JOIN {{order_header}} o USING (order_id) JOIN {{items}} i USING (item) WHERE i.category = '{PROMO}' GROUP BY o.so_number"""
STAGES["coupon_sales"] = """
  SELECT s.*, c.coupon_code, coalesce(c.quant::DOUBLE / count(*) OVER (PARTITION BY s.so_number), 0) AS coupon_quant,
    coalesce(c.amount::DOUBLE / count(*) OVER (PARTITION BY s.so_number), 0) AS coupon_amount
  FROM {sales} s LEFT JOIN {coupons} c ON s.so_number = c.so_number"""
STAGES["final_sales"] = """
  SELECT * FROM {coupon_sales} WHERE so_number NOT IN (
    SELECT source FROM {relations} WHERE relation_type = 5 UNION ALL SELECT target FROM {relations} WHERE relation_type IN (5, 8)
    UNION ALL SELECT source FROM {resolved})"""
STAGES["reasons_found"] = """
  SELECT p.so_number, l.item, min(r.reason_name) AS return_reason FROM {pickups} p JOIN {pickup_lines} l USING (pickup_id)
  LEFT JOIN {reasons} r USING (reason_id) WHERE p.pickup_type = 9 AND coalesce(p.deleted, 0) = 0 GROUP BY ALL"""
STAGES["sales_rolled"] = """
  SELECT s.* EXCLUDE (partial, n) REPLACE (coalesce(f.first_sale, s.sale_date) AS sale_date,
      CASE WHEN partial THEN CASE WHEN n = 1 THEN sign(coupon_quant) ELSE 0 END ELSE coupon_quant END AS coupon_quant),
    f.first_sale, k.fiscal_week AS week_of_first_sale, f.adjustments, c.credit_count, c.last_credit, r.return_reason
  FROM (SELECT *, row_number() OVER (PARTITION BY so_number, partial ORDER BY item, car_id, jobber_price, item_cost, sale_price) AS n
        FROM (SELECT *, 1 - abs(coupon_quant) > 0 AND coupon_code IS NOT NULL AS partial FROM {final_sales})) s
  LEFT JOIN (SELECT final_target, min(sale_date) AS first_sale, count(*) AS adjustments FROM {resolved} r
             JOIN (SELECT so_number, min(sale_date) AS sale_date FROM {sales} GROUP BY so_number) ON so_number = r.source
             WHERE final_target IS NOT NULL GROUP BY final_target) f ON f.final_target = s.so_number
  LEFT JOIN {calendar} k ON k.day = f.first_sale
  LEFT JOIN (SELECT source, count(*) AS credit_count, max(related_at) AS last_credit FROM {relations} WHERE relation_type = 4 GROUP BY source) c
    ON c.source = s.so_number
  LEFT JOIN {reasons_found} r ON r.so_number = s.so_number AND r.item = s.item"""


def sold_lines(t: Inputs):
    sold = sales.sales_lines(t.order_line, t.order_header, t.items, t.relations, CATEGORY, SINCE)
    return materialise_stage(sold)


def with_coupons(t: Inputs, sold):
    return sales.sales_with_coupons(sold, sales.order_coupons(t.order_line, t.order_header, t.items, PROMO, SINCE))


def rolled_sales(t: Inputs):
    sold, chains = sold_lines(t), sales.adjustment_chains(t.relations)
    final = sales.sales_without_adjustments(with_coupons(t, sold), t.relations, chains)
    reasons = sales.return_reasons(t.pickups, t.pickup_lines, t.reasons)
    return sales.sales_rollout(sold, final, chains, t.relations, reasons, t.calendar)


SALES_COLUMNS = f"""customer_id, sale_date, cuc, core_type, salesperson, {LINE_COLUMNS}, quant_sold::DOUBLE AS quant_sold,
  ext_sold::DOUBLE AS ext_sold, was_admin, was_adjust, coupon_code, round(coupon_quant, 6) AS coupon_quant, round(coupon_amount, 6) AS coupon_amount"""


@query("sales_with_coupons", f"SELECT {SALES_COLUMNS} FROM {{coupon_sales}}")
def sales_with_coupons(t: Inputs):
    return with_coupons(t, sold_lines(t)).drop("category", "order_id")


@query("remove_adjusted_orders", f"SELECT {SALES_COLUMNS} FROM {{final_sales}}")
def remove_adjusted_orders(t: Inputs):
    chains = sales.adjustment_chains(t.relations)
    sold = with_coupons(t, sold_lines(t))
    return sales.sales_without_adjustments(sold, t.relations, chains).drop("category", "order_id")


@query(
    "sales_rollout",
    f"SELECT {SALES_COLUMNS}, first_sale, week_of_first_sale, adjustments, credit_count, last_credit, return_reason FROM {{sales_rolled}}",
)
def sales_rollout(t: Inputs):
    return rolled_sales(t).drop("category", "order_id")


# ---------------------------------------------------------------- opportunities and dashboard

STAGES["inventory"] = f"""
  SELECT cuc, inventory_date, on_hand FROM (
    SELECT *, row_number() OVER (PARTITION BY cuc, inventory_date ORDER BY rank) AS n FROM (
      SELECT cuc, effective_date + 1 AS inventory_date, rank, CAST(sum(on_hand) AS BIGINT) AS on_hand FROM (
        SELECT *, 0 AS rank FROM {{stock_recent}} UNION ALL SELECT *, 1 FROM {{stock_middle}} UNION ALL SELECT *, 2 FROM {{stock_old}})
      JOIN {{items}} USING (item) WHERE warehouse_id = {WAREHOUSE} AND on_hand > 0 AND category = '{CATEGORY}' GROUP BY ALL)) WHERE n = 1"""
STAGES["asked"] = f"""
  SELECT DISTINCT CAST(lookup_at AS DATE) AS day, customer_id, salesperson, l.cuc, car_id, i.core_type
  FROM {{lookups}} l JOIN (SELECT DISTINCT cuc, core_type FROM {{items}} WHERE category = '{CATEGORY}') i ON l.cuc = i.cuc"""
STAGES["matched"] = """
  SELECT coalesce(a.customer_id, b.customer_id) AS customer_id, coalesce(a.day, b.sale_date) AS day, coalesce(a.salesperson, b.salesperson) AS salesperson,
    coalesce(a.cuc, b.cuc) AS cuc, coalesce(a.car_id, b.car_id) AS car_id, coalesce(a.core_type, b.core_type) AS core_type,
    b.* EXCLUDE (customer_id, sale_date, salesperson, cuc, car_id, core_type, category), b.so_number IS NOT NULL AS is_sale, a.day IS NOT NULL AS is_lookup
  FROM (SELECT * FROM {sales_rolled} WHERE quant_sold <> 0) b FULL JOIN {asked} a ON a.day = b.sale_date AND a.customer_id = b.customer_id
    AND a.salesperson = b.salesperson AND a.cuc = b.cuc AND a.car_id = b.car_id AND b.quant_sold > 0"""
STAGES["rows_stocked"] = """
  SELECT m.*, k.fiscal_week, k.fiscal_month, coalesce(quant_sold, 0) * coalesce(item_cost, 0) AS ext_cost,
    coalesce(v.on_hand > 0, false)::INT AS in_stock
  FROM {matched} m LEFT JOIN {inventory} v ON m.cuc = v.cuc AND m.day = v.inventory_date LEFT JOIN {calendar} k ON k.day = m.day"""
HOUSE_CUSTOMERS, HOUSE_PREFIX = [5, 17], "5"
STAGES["opps"] = """
  SELECT * EXCLUDE (house, returned, n, any_stock, any_sale, in_stock), CASE WHEN returned AND NOT house THEN 0 ELSE in_stock END AS in_stock,
    CASE WHEN NOT house AND NOT returned AND n = 1 THEN 1 ELSE 0 END AS sales_opp,
    CASE WHEN NOT house AND NOT returned AND n = 1 AND any_stock > 0 THEN 1 ELSE 0 END AS in_stock_opp,
    CASE WHEN NOT house AND NOT returned AND n = 1 AND any_sale > 0 THEN 1 ELSE 0 END AS opp_converted
  FROM (SELECT *, row_number() OVER (PARTITION BY customer_id, day, car_id, house ORDER BY returned, cuc, salesperson, so_number NULLS FIRST,
            item NULLS FIRST, jobber_price NULLS FIRST, item_cost NULLS FIRST, sale_price NULLS FIRST) AS n,
          max(in_stock) OVER v AS any_stock, sum(quant_sold) OVER v AS any_sale
        FROM (SELECT *, coalesce(quant_sold < 0, false) AS returned, coalesce(customer_id IN (5, 17) OR salesperson LIKE '5%', false) AS house
              FROM {rows_stocked}) WINDOW v AS (PARTITION BY customer_id, day, car_id, house))"""
STAGES["dash"] = f"""
  SELECT o.*, coalesce(in_stock_opp > 0 AND roh > 0, false)::INT AS in_model_opp, least(in_stock_opp, opp_converted) AS in_stock_sale,
    greatest(quant_sold, 0) AS positive_sales, greatest(coupon_quant, 0) AS positive_coupons, least(quant_sold, 0) AS negative_sales,
    least(coupon_quant, 0) AS negative_coupons, if(quant_sold > 0, ext_sold, 0) AS gross_sales, if(quant_sold < 0, ext_sold, 0) AS gross_returns
  FROM {{opps}} o LEFT JOIN (SELECT cuc, fiscal_week, max(roh) AS roh FROM {{model_stock}} WHERE warehouse_id = {WAREHOUSE} GROUP BY ALL) r
    ON o.cuc = r.cuc AND o.fiscal_week = r.fiscal_week"""
ROW_COLUMNS = f"""customer_id, day, salesperson, cuc, core_type, {LINE_COLUMNS}, quant_sold::DOUBLE AS quant_sold, ext_sold::DOUBLE AS ext_sold,
  coupon_code, round(coupon_quant, 6) AS coupon_quant, round(coupon_amount, 6) AS coupon_amount, first_sale, adjustments, return_reason, is_sale, is_lookup"""
SHOWN = [
    *["customer_id", "day", "salesperson", "cuc", "core_type", "so_number", "item", "car_id", "jobber_price", "item_cost", "sale_price"],
    *["quant_sold", "ext_sold", "coupon_code", "coupon_quant", "coupon_amount", "first_sale", "adjustments", "return_reason"],
    *["is_sale", "is_lookup"],
]


def inventory(t: Inputs):
    return opportunity.opening_inventory([t.stock_recent, t.stock_middle, t.stock_old], t.items, WAREHOUSE, CATEGORY)


def matched(t: Inputs):
    asked = opportunity.distinct_lookups(t.lookups, t.items, CATEGORY)
    return opportunity.lookup_sale_match(materialise_stage(rolled_sales(t)), asked)


def opportunities(t: Inputs, stock):
    stocked = materialise_stage(opportunity.with_stock(matched(t), stock, t.calendar))
    return opportunity.in_stock_opportunity(stocked, HOUSE_CUSTOMERS, HOUSE_PREFIX)


def dashboard(t: Inputs, stock):
    return opportunity.dashboard_rows(opportunities(t, stock), t.model_stock, WAREHOUSE)


@query("opening_inventory", "SELECT cuc, inventory_date, on_hand FROM {inventory}")
def opening_inventory(t: Inputs):
    return inventory(t)


@query(
    "opening_inventory_of_months",
    """SELECT cuc, inventory_date, on_hand FROM {inventory} JOIN {calendar} ON day = inventory_date
       WHERE fiscal_month BETWEEN DATE '1998-01-01' AND DATE '1998-03-01'""",
)
def opening_inventory_of_months(t: Inputs):
    histories = [t.stock_recent, t.stock_middle, t.stock_old]
    stock = opportunity.store_stock(histories, scratch_path(t.spark, "stock"))
    days = materialise_stage(t.calendar).filter("fiscal_month BETWEEN DATE '1998-01-01' AND DATE '1998-03-01'")
    return opportunity.opening_inventory_on(stock, len(histories), t.items, days, WAREHOUSE, CATEGORY)


@query("lookup_sale_match", f"SELECT {ROW_COLUMNS} FROM {{matched}}")
def lookup_sale_match(t: Inputs):
    return matched(t).select(*SHOWN)


OPP = "fiscal_week, fiscal_month, ext_cost::DOUBLE AS ext_cost, in_stock, sales_opp, in_stock_opp, opp_converted"
OPP_NAMES = ["fiscal_week", "fiscal_month", "ext_cost", "in_stock", "sales_opp", "in_stock_opp", "opp_converted"]


@query("in_stock_opportunity", f"SELECT {ROW_COLUMNS}, {OPP} FROM {{opps}}")
def in_stock_opportunity(t: Inputs):
    return opportunities(t, materialise_stage(inventory(t))).select(*SHOWN, *OPP_NAMES)


@query(
    "dashboard_rows",
    f"""SELECT {ROW_COLUMNS}, {OPP}, in_model_opp, in_stock_sale, positive_sales::DOUBLE AS positive_sales, round(positive_coupons, 6) AS positive_coupons,
          negative_sales::DOUBLE AS negative_sales, round(negative_coupons, 6) AS negative_coupons, gross_sales::DOUBLE AS gross_sales,
          gross_returns::DOUBLE AS gross_returns FROM {{dash}}""",
)
def dashboard_rows(t: Inputs):
    names = ["in_model_opp", "in_stock_sale", "positive_sales", "positive_coupons", "negative_sales", "negative_coupons"]
    return dashboard(t, materialise_stage(inventory(t))).select(*SHOWN, *OPP_NAMES, *names, "gross_sales", "gross_returns")


# Figures per period; ``@period`` is a column of the calendar.
FIGURES = """SELECT @period, quant::DOUBLE AS ext_quant, dollar::DOUBLE AS ext_dollar, round(dollar::DOUBLE / nullif(quant::DOUBLE, 0), 9) AS avg_unit_price,
         (dollar - cost)::DOUBLE AS margin, round((dollar - cost)::DOUBLE / nullif(dollar::DOUBLE, 0), 9) AS margin_pct,
         round((dollar::DOUBLE * 0.98 - cost::DOUBLE) / nullif(dollar::DOUBLE, 0), 9) AS margin_with_rebate_pct,
         round(coupon_orders / nullif(orders, 0)::DOUBLE, 9) AS coupon_redemption_pct, round(-returned::DOUBLE / nullif(sold::DOUBLE, 0), 9) AS return_pct,
         round(stock_opps / nullif(opps, 0)::DOUBLE, 9) AS in_stock_lookup_pct, round(orders / nullif(stock_opps, 0)::DOUBLE, 9) AS total_conversion,
         round(converted / nullif(opps, 0)::DOUBLE, 9) AS application_conversion, round(model_opps / nullif(stock_opps, 0)::DOUBLE, 9) AS fill_rate,
         customers, admins, adjustments, warranties::BIGINT AS warranties, fit_issues::BIGINT AS fit_issues, value::DOUBLE AS inventory_value
       FROM (SELECT @period, sum(quant_sold) AS quant, sum(ext_sold) AS dollar, sum(ext_cost) AS cost, sum(positive_sales) AS sold,
               sum(negative_sales) AS returned, count(DISTINCT so_number) AS orders, count(DISTINCT CASE WHEN coupon_code IS NOT NULL THEN so_number END) AS coupon_orders,
               count(DISTINCT customer_id) AS customers, sum(sales_opp) AS opps, sum(in_stock_opp) AS stock_opps, sum(opp_converted) AS converted,
               sum(in_model_opp) AS model_opps, count(DISTINCT so_number) FILTER (was_admin = 1) AS admins,
               count(DISTINCT so_number) FILTER (was_adjust = 1 OR adjustments > 0) AS adjustments, count(*) FILTER (return_reason = 'FRANCE') AS warranties,
               count(*) FILTER (return_reason IN ('Phone mistake', 'PERU')) AS fit_issues FROM {dash} GROUP BY @period)
       LEFT JOIN (SELECT @period, max_by(value, day) AS value FROM (
           SELECT k.@period, v.inventory_date AS day, sum(v.on_hand * u.cost) AS value FROM {inventory} v JOIN {unit_cost} u USING (cuc)
           JOIN {calendar} k ON k.day = v.inventory_date GROUP BY ALL) GROUP BY @period) USING (@period)"""


@query("dashboard_kpis", FIGURES.replace("@period", "fiscal_week"), places=9)
def dashboard_kpis(t: Inputs):
    stock = materialise_stage(inventory(t))
    return opportunity.dashboard_kpis(dashboard(t, stock), stock, t.unit_cost, t.calendar, 2.0, ["FRANCE"], ["Phone mistake", "PERU"])


@query("dashboard_months", FIGURES.replace("@period", "fiscal_month"), places=9)
def dashboard_months(t: Inputs):
    """Months from the same orders as weeks, which are kept once for both."""
    stock = materialise_stage(inventory(t))
    periods = ["fiscal_week", "fiscal_month"]
    facts = materialise_stage(opportunity.order_facts(dashboard(t, stock), periods, ["FRANCE"], ["Phone mistake", "PERU"]))
    return opportunity.period_figures(facts, stock, t.unit_cost, t.calendar, "fiscal_month", 2.0)


# ---------------------------------------------------------------- rebates

MONEY_SUMS = "sum(sales) AS sales, sum(roy) AS roy, sum(ntl) AS ntl, sum(loc) AS loc"
KEYS = "warehouse_id, customer_id, group_id"
STAGES["period_sales"] = f"""
  SELECT 'Annual' AS frequency, {KEYS}, {MONEY_SUMS} FROM {{monthly}} WHERE year = 1997 GROUP BY ALL
  UNION ALL SELECT 'Quarter', {KEYS}, {MONEY_SUMS} FROM {{monthly}} JOIN {{latest_quarter}} USING (year, quarter) GROUP BY ALL
  UNION ALL SELECT 'Bi-Monthly', {KEYS}, {MONEY_SUMS} FROM {{monthly}} WHERE year = 1998 AND month IN (5, 6) GROUP BY ALL
  UNION ALL SELECT 'Monthly', {KEYS}, {MONEY_SUMS} FROM {{monthly}} WHERE year = 1998 AND month = 6 GROUP BY ALL"""
STAGES["rates"] = """
  SELECT DISTINCT c.customer_id, c.warehouse_id, c.company_name, m.group_id, r.group_name, r.frequency, r.rebate_pct,
    coalesce(p.sales, 0) AS sales, coalesce(p.roy, 0) AS roy, coalesce(p.ntl, 0) AS ntl, coalesce(p.loc, 0) AS loc, {RATE} AS new_rebate_pct
  FROM {{members}} m JOIN {{customer_view}} c USING (customer_id)
  JOIN (SELECT group_id, group_name, CASE group_name WHEN 'NATION_4' THEN 2.0 ELSE rebate_pct::DOUBLE END AS rebate_pct,
          frequency FROM {{buying_groups}} LEFT JOIN (VALUES (2, 'Monthly'), (3, 'Bi-Monthly'), (4, 'Bi-Monthly'), (7, 'Quarter'), (8, 'Quarter'),
            (9, 'Quarter'), (13, 'Annual'), (14, 'Quarter'), (17, 'Annual'), (18, 'Annual'), (20, 'Quarter'), (21, 'Quarter'), (22, 'Quarter'),
            (25, 'Quarter'), (26, 'Quarter')) closing(group_id, frequency) USING (group_id)) r ON r.group_id = m.group_id
  LEFT JOIN {{period_sales}} p ON p.customer_id = m.customer_id AND p.group_id = m.group_id AND p.frequency = r.frequency
  WHERE m.deactivated IS NULL AND c.status = 1 AND r.frequency IS NOT NULL""".replace(
    "{RATE}", RATE_SQL.format(g="m.group_id", a="coalesce(p.sales, 0)", d="r.rebate_pct")
).replace("{{", "{").replace("}}", "}")


def rates(t: Inputs):
    periods = rebates.member_period_sales(materialise_stage(monthly(t)), AS_OF)
    return rebates.rebate_rates(t.members, t.buying_groups, t.customer_view, periods, {"NATION_4": 2.0})


@query(
    "member_monthly_sales",
    """SELECT warehouse_id, customer_id, company_name, group_id, group_name, activated, year, quarter, month, sales::DOUBLE AS sales,
         roy::DOUBLE AS roy, ntl::DOUBLE AS ntl, loc::DOUBLE AS loc FROM {monthly}""",
)
def member_monthly_sales(t: Inputs):
    return monthly(t)


@query(
    "member_period_sales",
    f"SELECT frequency, {KEYS}, sales::DOUBLE AS sales, roy::DOUBLE AS roy, ntl::DOUBLE AS ntl, loc::DOUBLE AS loc FROM {{period_sales}}",
)
def member_period_sales(t: Inputs):
    return rebates.member_period_sales(materialise_stage(monthly(t)), AS_OF)


@query(
    "rebate_rates",
    """SELECT customer_id, warehouse_id, company_name, group_id, group_name, frequency, rebate_pct, sales::DOUBLE AS sales, roy::DOUBLE AS roy,
         ntl::DOUBLE AS ntl, loc::DOUBLE AS loc, new_rebate_pct FROM {rates}""",
)
def rebate_rates(t: Inputs):
    return rates(t)


@query(
    "rebate_transactions",
    f"""SELECT r.customer_id, warehouse_id, group_id, group_name, company_name, new_rebate_pct, so_number, total::DOUBLE AS so_total,
          round(total::DOUBLE * new_rebate_pct / 100, 6) AS so_rebate, CAST(ordered_at AS DATE) AS so_date
        FROM {{rates}} r JOIN {PERIODS_SQL} USING (frequency) JOIN {{order_header}} o ON o.customer_id = r.customer_id
          AND ordered_at >= period_start AND ordered_at < period_end""",
)
def rebate_transactions(t: Inputs):
    return rebates.rebate_transactions(rates(t), t.order_header, AS_OF)


@query(
    "rebate_summary",
    """SELECT frequency, group_name, group_id, new_rebate_pct, customer_id, company_name, warehouse_id, sales::DOUBLE AS total_sales,
         round(sales::DOUBLE * new_rebate_pct / 100, 8) AS rebate, round(roy::DOUBLE * new_rebate_pct / 100, 8) AS roy_rebate,
         round(ntl::DOUBLE * new_rebate_pct / 100, 8) AS ntl_rebate, round(loc::DOUBLE * new_rebate_pct / 100, 8) AS loc_rebate FROM {rates}""",
    places=8,
)
def rebate_summary(t: Inputs):
    return rebates.rebate_summary(rates(t))


# ---------------------------------------------------------------- pricing clean-up and distance

STAGES["pricing_final"] = """
  SELECT p.*, f.first_so_date FROM {pricing} p JOIN {shops} w USING (customer_id)
  LEFT JOIN (SELECT final_target, min(d.priced_on) AS first_so_date FROM {resolved} r
             JOIN (SELECT so_number, min(priced_on) AS priced_on FROM {pricing} GROUP BY so_number) d ON d.so_number = r.source
             WHERE final_target IS NOT NULL GROUP BY final_target) f ON f.final_target = p.so_number
  WHERE w.shop_type <> 'Re' AND lower(w.company_name) NOT LIKE '%99%' AND p.pricing_plan NOT IN ('b1', 'b2', 'b3', 'b4', 'f1', 'j2', 'vp', 'p3')
    AND p.quote_user NOT IN ('red', 'hot') AND p.so_number NOT IN (SELECT source FROM {resolved} WHERE final_target IS NOT NULL)
    AND NOT (coalesce(p.sales_qty, 0) > 0 AND p.so_number IN (SELECT source FROM {relations} WHERE relation_type = 5))"""


STAGES["pricing_cleaned"] = """
  SELECT * FROM {pricing_final} p
       WHERE NOT EXISTS (SELECT 1 FROM {pickups} k JOIN {pickup_lines} l USING (pickup_id) JOIN {reasons} r USING (reason_id)
         WHERE k.pickup_type = 9 AND coalesce(k.deleted, 0) = 0 AND CAST(k.created_at AS DATE) >= (SELECT min(priced_on) FROM {pricing_final})
           AND r.reason_name IN ('Phone mistake', 'Shop Lost Customer', 'Cust did not order') AND k.so_number = p.so_number AND l.item = p.item)"""


@query(
    "pricing_noise_cleanup",
    "SELECT p.* REPLACE (sales_qty::DOUBLE AS sales_qty, sale_price::DOUBLE AS sale_price) FROM {pricing_cleaned} p",
)
def pricing_noise_cleanup(t: Inputs):
    return cleaned_prices(t)


@query(
    "pricing_sample",
    """SELECT p.* REPLACE (sales_qty::DOUBLE AS sales_qty, sale_price::DOUBLE AS sale_price) FROM {pricing_cleaned} p
       WHERE category LIKE 'PROMO%' ORDER BY category, so_number, line_number LIMIT 1000""",
)
def pricing_sample(t: Inputs):
    """The first 1,000 rows of a category for inspection: the limit is the feature."""
    extract = cleaned_prices(t).withColumn("_type", F.col("category")).withColumn("category", F.substring("category", 1, 5))
    found = pricing.pricing_sample(extract, "PROMO", ["_type", "so_number", "line_number"], 1000)
    return found.withColumn("category", F.col("_type")).drop("_type")


def cleaned_prices(t: Inputs):
    return pricing.pricing_noise_cleanup(
        t.pricing,
        t.relations,
        sales.adjustment_chains(t.relations),
        t.shops,
        t.pickups,
        t.pickup_lines,
        t.reasons,
        excluded_users=["red", "hot"],
        excluded_companies=["99"],
    )


@query(
    "customers_within_radius",
    f"""SELECT * REPLACE (round(latitude, 9) AS latitude, round(longitude, 9) AS longitude) FROM (SELECT *, {MILES_SQL} AS distance FROM {{route_customers}} JOIN {{geocodes}} USING (customer_id) JOIN {{warehouses}} USING (warehouse_id)
          WHERE warehouse_id NOT IN (4, 16) AND lower(route_code) IN ('a', 'b', 'c', 'd', 'f') AND lower(status) NOT IN ('x', 'm', 'v')
            AND company_name NOT LIKE '%800%' AND lower(company_name) NOT LIKE '%test%'
            AND geocode_status_id IN (SELECT geocode_status_id FROM {{geocode_status}}))
        WHERE distance <= 5""",
    places=9,
)
def customers_within_radius(t: Inputs):
    return pricing.customers_within_radius(
        t.route_customers, t.warehouses, t.geocodes, t.geocode_status, route_codes=["a", "b", "c", "d", "f"]
    )


# ---------------------------------------------------------------- history from audit rows


def new_value(key: str) -> str:
    return (
        f"nullif(CASE WHEN json_type(changes, '$.{key}') = 'ARRAY' THEN json_extract_string(changes, '$.{key}[1]') "
        f"ELSE json_extract_string(changes, '$.{key}') END, '')"
    )


def old_value(key: str) -> str:
    return f"nullif(CASE WHEN json_type(changes, '$.{key}') = 'ARRAY' THEN json_extract_string(changes, '$.{key}[0]') END, '')"


def local(column: str) -> str:
    return f"timezone('{TZ}', timezone('UTC', {column}))"


FILL = "last_value({c} IGNORE NULLS) OVER (PARTITION BY deal_date_id ORDER BY created_at, audit_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS {c}"
STAGES["schedules"] = f"""
  SELECT deal_date_id, action, effective_date, lead(effective_date) OVER (PARTITION BY deal_date_id ORDER BY created_at, audit_id) AS ineffective_date,
    {", ".join(FILL.format(c=c) for c in ("listing_id", "listing_type", "day_1", "rule"))}
  FROM (SELECT *, CAST({local("created_at")} AS DATE) AS effective_date, {new_value("listing_id")} AS listing_id, {new_value("listing_type")} AS listing_type,
          substring({new_value("dtstart")}, 1, 10) AS day_1, {new_value("rrule")} AS rule FROM {{deal_audits}})"""


@query(
    "deal_active_days",
    """SELECT listing_id, listing_type, count(DISTINCT day) AS deals_active_past FROM (
         SELECT *, CAST(day_1 AS DATE) AS start, coalesce(rule, '') AS r FROM {schedules} WHERE action <> 'destroy' AND day_1 IS NOT NULL)
       JOIN (SELECT CAST(unnest(generate_series(DATE '2024-01-01', DATE '2024-01-30', INTERVAL 1 DAY)) AS DATE) AS day)
         ON day >= start AND day >= effective_date AND day <= coalesce(ineffective_date, DATE '2024-01-31')
         AND day <= CASE WHEN r NOT LIKE '%WEEKLY%' AND r NOT LIKE '%DAILY%' THEN start WHEN r LIKE '%UNTIL=%'
             THEN CAST(strptime(substring(r, position('UNTIL=' IN r) + 6, 8), '%Y%m%d') AS DATE) ELSE DATE '2024-01-31' END
         AND (r NOT LIKE '%WEEKLY%' OR CASE WHEN r LIKE '%BYDAY=%' THEN contains(lower(split_part(split_part(r, 'BYDAY=', 2), ';', 1)), lower(left(dayname(day), 2)))
             ELSE dayofweek(day) = dayofweek(start) END)
       GROUP BY ALL""",
)
def deal_active_days(t: Inputs):
    return history.deal_active_days(t.deal_audits, dt.date(2024, 1, 31), 30, TZ)


STAGES["changes"] = """
  SELECT DISTINCT a.top_level_id, a.created_at AS account_created, h.changed_at, coalesce(o.user_name, h.old_value) AS old_owner,
    coalesce(n.user_name, h.new_value) AS new_owner
  FROM (SELECT top_level_id, min(created_at) AS created_at FROM {accounts} LEFT JOIN {top_levels} USING (account_id) GROUP BY ALL) a
  LEFT JOIN {account_history} h ON h.account_id = a.top_level_id AND h.field = 'Owner'
  LEFT JOIN {owners} o ON o.user_id = h.old_value LEFT JOIN {owners} n ON n.user_id = h.new_value"""
STAGES["owner_spans"] = """
  SELECT top_level_id, changed_at AS start_date, lead(changed_at) OVER (PARTITION BY top_level_id ORDER BY changed_at, old_owner, new_owner) AS end_date,
    new_owner AS owner FROM {changes} WHERE changed_at IS NOT NULL
  UNION ALL SELECT top_level_id, account_created, changed_at, old_owner FROM (
    SELECT *, row_number() OVER (PARTITION BY top_level_id ORDER BY changed_at, old_owner, new_owner) AS n FROM {changes}) WHERE n = 1"""


@query(
    "account_owner_history",
    """SELECT top_level_id, start_date, end_date, owner, month_start, strftime(month_start, '%Y-%m') AS year_month FROM (
         SELECT *, row_number() OVER (PARTITION BY top_level_id, month_start ORDER BY start_date DESC, end_date DESC NULLS LAST, owner DESC NULLS LAST) AS n FROM (
           SELECT DISTINCT s.*, CAST(date_trunc('month', day) AS DATE) AS month_start FROM {owner_spans} s
           JOIN (SELECT CAST(unnest(generate_series(DATE '2017-01-01', DATE '2024-01-31', INTERVAL 1 DAY)) AS DATE) AS day)
             ON day BETWEEN CAST(start_date AS DATE) AND coalesce(CAST(end_date AS DATE), DATE '2024-02-15'))) WHERE n = 1""",
)
def account_owner_history(t: Inputs):
    return history.account_owner_history(
        t.accounts, t.top_levels, t.account_history, t.owners, dt.date(2024, 2, 15)
    )


STAGES["status_spans"] = f"""
  SELECT vr_id, current_status, brand_id, listing_id, listing_type, created_date, {local("begun")} AS start_date, {local("next")} AS end_date,
    CASE value WHEN '0' THEN 'Pending' WHEN '1' THEN 'Approved' WHEN '2' THEN 'Rejected' WHEN '3' THEN 'Expired' ELSE value END AS status_label
  FROM (SELECT v.vr_id, v.status AS current_status, v.brand_id, v.listing_id, v.listing_type, CAST(v.created_at AS DATE) AS created_date,
          coalesce(a.created_at, v.created_at) AS begun, lead(a.created_at) OVER (PARTITION BY v.vr_id ORDER BY a.created_at, a.audit_id) AS next,
          coalesce(a.value, CAST(v.status AS VARCHAR)) AS value
        FROM {{retailers}} v LEFT JOIN (SELECT *, {new_value("status")} AS value FROM {{status_audits}} WHERE auditable_type = 'VerifiedRetailer') a
          ON a.auditable_id = v.vr_id)"""
STAGES["brand_sales"] = f"""
  SELECT order_id, order_date, s.core_id, s.core_type, s.menu_override_id, region_name, super_region, strftime(order_date, '%Y-%m') AS year_month,
    strftime(order_date, '%b-%y') AS month_label, sum(i.price * i.amount) AS total_rev
  FROM (SELECT *, CAST({local("order_time")} AS DATE) AS order_date FROM {{market_orders}} WHERE status <> 0) o
  JOIN {{order_items}} i USING (order_id) JOIN {{listings}} l ON o.listing_id = l.listing_id AND o.order_listing_type = l.listing_type - 2
  JOIN {{buyers}} b ON b.account_id = o.account_id JOIN {{stores}} s ON s.wmid = l.wmid JOIN {{regions}} r ON r.region_id = s.region_id
  JOIN {{region_names}} n ON lower(n.region_name) = lower(r.region)
  WHERE i.price < 50000 AND b.email NOT LIKE '%staff.example%' AND date_trunc('week', order_date) BETWEEN DATE '1995-06-01' AND DATE '2001-06-30'
  GROUP BY ALL"""
STAGES["override_spans"] = f"""
  SELECT s.core_id, s.core_type, a.audit_id, a.update_date, a.old_override, a.new_override,
    lead(a.update_date) OVER (PARTITION BY s.core_id, s.core_type ORDER BY a.update_date, a.audit_id) AS end_date
  FROM (SELECT DISTINCT core_id, core_type FROM {{stores}}) s LEFT JOIN (
    SELECT core_id, core_type, audit_id, {local("created_at")} AS update_date, TRY_CAST({old_value("menu_override_id")} AS BIGINT) AS old_override,
      TRY_CAST({new_value("menu_override_id")} AS BIGINT) AS new_override
    FROM {{menu_audits}} WHERE changes LIKE '%menu_override_id%' AND action <> 'create') a USING (core_id, core_type)"""


def status_history(t: Inputs):
    return history.retailer_status_history(t.retailers, t.status_audits, tz=TZ)


def stores(t: Inputs):
    return history.store_entities(t.dispensaries, t.deliveries)


def brand_sales(t: Inputs):
    return history.brand_sales_base(
        t.market_orders,
        t.order_items,
        t.listings,
        t.buyers,
        stores(t),
        t.regions,
        t.region_names,
        dt.date(1995, 6, 1),
        dt.date(2001, 6, 30),
        "staff.example",
    )


@query("retailer_status_history", "SELECT * FROM {status_spans}")
def retailer_status_history(t: Inputs):
    return status_history(t)


@query("brand_sales_base", "SELECT * REPLACE (total_rev::DOUBLE AS total_rev) FROM {brand_sales}")
def brand_sales_base(t: Inputs):
    return brand_sales(t)


@query("menu_override_history", "SELECT * FROM {override_spans}")
def menu_override_history(t: Inputs):
    return history.menu_override_history(stores(t), t.menu_audits, TZ)


STAGES["known_overrides"] = "SELECT * FROM {override_spans} WHERE update_date IS NOT NULL"
STAGES["placed"] = """
  SELECT f.*, k.update_date, k.end_date AS override_end, k.old_override, k.new_override,
    CASE WHEN f.has_audit THEN CASE WHEN k.update_date IS NULL THEN f.first_override ELSE k.new_override END ELSE f.menu_override_id END AS current_override
  FROM (SELECT b.*, h.core_id IS NOT NULL AS has_audit, h.first_override FROM {brand_sales} b LEFT JOIN (
          SELECT core_id, core_type, old_override AS first_override FROM (
            SELECT *, row_number() OVER (PARTITION BY core_id, core_type ORDER BY update_date, audit_id) AS n FROM {known_overrides}) WHERE n = 1) h
        ON h.core_id = b.core_id AND h.core_type = b.core_type) f
  LEFT JOIN {known_overrides} k ON k.core_id = f.core_id AND k.core_type = f.core_type AND f.order_date >= k.update_date
    AND f.order_date < coalesce(k.end_date, TIMESTAMP '2999-01-01')"""


@query(
    "sales_at_retailer_status",
    """SELECT p.* EXCLUDE (first_override) REPLACE (total_rev::DOUBLE AS total_rev), s.core_id AS override_id, s.core_type AS override_type, coalesce(s.core_id, p.core_id) AS listing_id,
         coalesce(s.core_type, p.core_type) AS listing_type, v.start_date AS status_start, v.end_date AS status_end, v.status_label
       FROM {placed} p LEFT JOIN {stores} s ON s.wmid = p.current_override
       LEFT JOIN {status_spans} v ON v.listing_id = coalesce(s.core_id, p.core_id) AND v.listing_type = coalesce(s.core_type, p.core_type)
         AND p.order_date >= v.start_date AND p.order_date < coalesce(v.end_date, TIMESTAMP '2999-01-01')""",
)
def sales_at_retailer_status(t: Inputs):
    overrides = history.menu_override_history(stores(t), t.menu_audits, TZ)
    return history.sales_at_retailer_status(brand_sales(t), overrides, status_history(t), stores(t))


# ---------------------------------------------------------------- impressions

LISTED = "('Deals Nearby', 'Delivery Services', 'Dispensary Storefronts', 'Doctors', 'Mail Order / Delivery Services', 'CBD Stores')"


def flat_sql(more: str = "") -> str:
    return f"""SELECT {more}{local("CAST(replace(replace(json_extract_string(one, '$.timestamp'), 'T', ' '), 'Z', '') AS TIMESTAMP)")} AS impression_time,
          'Web' AS platform, anonymous_id, location, region_name, i::INT AS impression_index, section AS section_name,
          CASE WHEN section IN {LISTED} THEN json_extract_string(one, '$.listing_id') END AS listing_id,
          CASE WHEN section IN {LISTED} THEN json_extract_string(one, '$.listing_type') END AS listing_type,
          CASE WHEN section = 'Deals Nearby' THEN json_extract_string(one, '$.deal_id') END AS deal_id,
          CASE WHEN section NOT IN {LISTED} THEN json_extract_string(one, '$.brand_id') END AS brand_id,
          CASE WHEN section NOT IN {LISTED} AND section <> 'Featured Brands' THEN json_extract_string(one, '$.product_id') END AS product_id,
          json_extract_string(one, '$.position') AS section_position
        FROM (SELECT *, json_extract_string(one, '$.section_name') AS section FROM (
          SELECT *, json_extract(events, '$[' || i || ']') AS one FROM (
            SELECT *, unnest(range(json_array_length(events)::BIGINT)) AS i FROM {{batches}} WHERE location = 'Home')))"""


@query("impression_flatten", flat_sql())
def impression_flatten(t: Inputs):
    return impressions.impression_flatten(t.batches, "Home", TZ)


@query(
    "daily_impressions",
    "SELECT * FROM ({flat}) WHERE local_day >= DATE '2024-01-13' AND local_day < DATE '2024-01-15'".replace(
        "{flat}", flat_sql(f"CAST({local('batch_time')} AS DATE) AS local_day, ")
    ),
)
def daily_impressions(t: Inputs):
    """Two local days of batches, flattened and appended day by day; the second run repeats the first day."""
    path, day = scratch_path(t.spark, "impressions"), dt.timedelta(days=1)
    for as_of in (dt.date(2024, 1, 14), dt.date(2024, 1, 15)):
        chosen = impressions.batches_of_days(t.batches, as_of - 2 * day, as_of, TZ)
        flat = impressions.impression_flatten(chosen, "Home", TZ, keep=["batch_time"])
        days = 1 if as_of.day == 14 else 2
        loaded = sink_incremental_append(flat, path, "batch_time", as_of, days=days, tz=TZ)
    return loaded.drop("batch_time")


# ---------------------------------------------------------------- prices


@query(
    "price_summaries",
    f"""SELECT 'overall' AS level, 'all' AS "group", {SUMMARY} FROM {{price_rows}}
        UNION ALL SELECT 'plan', pricing_plan, {SUMMARY} FROM {{price_rows}} GROUP BY pricing_plan
        UNION ALL SELECT 'style', style, {SUMMARY} FROM {{price_rows}} GROUP BY style""",
)
def price_summaries(t: Inputs):
    return prices.price_summaries(t.price_rows)


@query("rolling_average_price", ROLLING)
def rolling_average_price(t: Inputs):
    return prices.rolling_average_price(t.price_rows)


@query("price_density_by_style", CURVE, places=9)
def price_density_by_style(t: Inputs):
    return shown(curve(t))


STAGES["scored"] = f"""
  SELECT s.customer_id, s.price_score, s.total_qty, c.conversion FROM {{customer_scores}} s JOIN (
    {CONVERSION.replace("round(", "(").replace(", 6)", ")")}) c USING (customer_id)"""


@query(
    "price_vs_conversion",
    "SELECT customer_id, round(price_score, 6) AS price_score, total_qty::DOUBLE AS total_qty, round(conversion, 6) AS conversion FROM {scored}",
)
def price_vs_conversion(t: Inputs):
    return prices.price_vs_conversion(t.price_rows)


@query("price_conversion_regression", OLS.replace("{source}", "SELECT conversion AS y, price_score AS x FROM {scored}"))
def price_conversion_regression(t: Inputs):
    return prices.price_conversion_regression(t.price_rows)


# ---------------------------------------------------------------- release notes

STAGES["annotated"] = """
  SELECT DISTINCT u.source_file, p.productname AS product_name, u.release_name, u.release_version, u.part_number, r.rmnotes AS release_notes,
    p.rmnotes AS product_notes
  FROM {uploads} u LEFT JOIN {releases} r ON u.release_name IS NOT DISTINCT FROM r.releasename AND u.release_version IS NOT DISTINCT FROM r.releaseversion
  LEFT JOIN {products} p ON r.productname IS NOT DISTINCT FROM p.productname"""


@query(
    "release_note_crosscheck",
    """SELECT 'annotated' AS report, * FROM {annotated}
       UNION ALL SELECT 'lines_with_notes', * FROM {annotated} WHERE release_notes IS NOT NULL OR product_notes IS NOT NULL
       UNION ALL BY NAME SELECT 'uploads' AS report, source_file, release_name, release_version, part_number FROM {uploads}""",
)
def release_note_crosscheck(t: Inputs):
    reports = release_notes.release_note_crosscheck(t.uploads, t.releases, t.products)
    return sink_multi_report(reports, scratch_path(t.spark, "notes"))
