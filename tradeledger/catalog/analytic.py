"""Aggregates, windows, intervals, chains and statistics over the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tradeledger.catalog.inputs import Inputs
from tradeledger.catalog.registry import STAGES, query
from tradeledger.catalog.relational import AS_OF, money
from tradeledger.operators import allocate, chains, intervals, ordered, periods, stats
from tradeledger.operators.tables import update_where
from tradeledger.plans import prices, rebates, sales
from tradeledger.sources.write import materialise_stage

LINE = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]

# ---------------------------------------------------------------- aggregates


@query(
    "agg_group_expressions",
    """SELECT o_orderstatus, year(o_orderdate) AS year, left(o_orderpriority, 1) AS rank, count(*) AS orders,
         sum(o_totalprice::DECIMAL(12,2))::DOUBLE AS total FROM {orders} GROUP BY ALL""",
)
def agg_group_expressions(t: Inputs):
    return t.orders.groupBy(
        "o_orderstatus",
        F.year("o_orderdate").cast("bigint").alias("year"),
        F.left("o_orderpriority", F.lit(1)).alias("rank"),
    ).agg(F.count(F.lit(1)).alias("orders"), F.sum(money("o_totalprice")).alias("total"))


@query(
    "agg_sum_product",
    """SELECT l_returnflag, l_linestatus, sum(l_quantity::DECIMAL(9,2) * l_extendedprice::DECIMAL(12,2))::DOUBLE AS ext_sold
       FROM {lineitem} GROUP BY ALL""",
)
def agg_sum_product(t: Inputs):
    ext = F.col("l_quantity").cast("decimal(9,2)") * money("l_extendedprice")
    return t.lineitem.groupBy("l_returnflag", "l_linestatus").agg(F.sum(ext).alias("ext_sold"))


@query(
    "agg_snapshot_sum",
    """SELECT cuc, effective_date + 1 AS inventory_date, CAST(sum(on_hand) AS BIGINT) AS on_hand
       FROM {stock} JOIN {items} USING (item) WHERE warehouse_id = 30 AND on_hand > 0 GROUP BY ALL""",
)
def agg_snapshot_sum(t: Inputs):
    return (
        t.stock.filter("warehouse_id = 30 AND on_hand > 0")
        .join(t.items.select("item", "cuc"), "item")
        .groupBy("cuc", F.date_add("effective_date", 1).alias("inventory_date"))
        .agg(F.sum("on_hand").alias("on_hand"))
    )


@query(
    "agg_sum_null_as_zero",
    """SELECT o_custkey, coalesce(sum(CASE WHEN o_orderstatus = 'F' THEN o_totalprice::DECIMAL(12,2) END), 0)::DOUBLE AS finished
       FROM {orders} GROUP BY o_custkey""",
)
def agg_sum_null_as_zero(t: Inputs):
    finished = F.when(F.col("o_orderstatus") == "F", money("o_totalprice"))
    return t.orders.groupBy("o_custkey").agg(F.coalesce(F.sum(finished), F.lit(0)).alias("finished"))


@query(
    "agg_ratio_of_sums",
    """SELECT l_partkey, round(sum(l_extendedprice::DECIMAL(12,2))::DOUBLE / nullif(sum(l_quantity::DECIMAL(9,2))::DOUBLE, 0), 6) AS price
       FROM {lineitem} GROUP BY l_partkey""",
)
def agg_ratio_of_sums(t: Inputs):
    return t.lineitem.groupBy("l_partkey").agg(
        prices.ratio(F.sum(money("l_extendedprice")), F.sum(F.col("l_quantity").cast("decimal(9,2)"))).alias("price")
    )


SUMMARY = """count(*) AS lookups, count(sales_qty) AS transactions, coalesce(sum(sales_qty), 0)::DOUBLE AS total_qty,
  coalesce(sum(sale_price), 0)::DOUBLE AS price_sum, coalesce(sum(sale_price * sales_qty), 0)::DOUBLE AS revenue,
  round(count(sales_qty) / count(*), 6) AS conversion,
  round(sum(sale_price)::DOUBLE / nullif(sum(sales_qty), 0)::DOUBLE, 6) AS avg_price,
  round(sum(sale_price * sales_qty)::DOUBLE / nullif(sum(sales_qty), 0)::DOUBLE, 6) AS avg_sell_price"""


@query("agg_global", f"SELECT {SUMMARY} FROM {{price_rows}}")
def agg_global(t: Inputs):
    return prices.price_summary(t.price_rows)


@query("agg_group_conversion", f"SELECT pricing_plan, {SUMMARY} FROM {{price_rows}} GROUP BY pricing_plan")
def agg_group_conversion(t: Inputs):
    return prices.price_summary(t.price_rows, ["pricing_plan"])


# Fee codes by the column they are summed in.
FEES = """SELECT so_number, coalesce(sum(amount) FILTER (kind = 'roy'), 0) AS roy, coalesce(sum(amount) FILTER (kind = 'ntl'), 0) AS ntl,
    coalesce(sum(amount) FILTER (kind = 'loc'), 0) AS loc
  FROM {charges} LEFT JOIN (VALUES (104, 'roy'), (105, 'roy'), (110, 'ntl'), (111, 'loc'), (113, 'roy'), (114, 'roy'), (115, 'roy'), (116, 'roy'),
    (117, 'roy'), (123, 'roy'), (124, 'ntl'), (131, 'roy'), (133, 'roy'), (156, 'ntl')) k(fee_code, kind) USING (fee_code)
  GROUP BY so_number"""


@query(
    "agg_conditional_sums",
    "SELECT so_number, roy::DOUBLE AS roy, ntl::DOUBLE AS ntl, loc::DOUBLE AS loc FROM ({fees})".replace("({fees})", f"({FEES})"),
)
def agg_conditional_sums(t: Inputs):
    return rebates.order_fees(t.charges)


@query(
    "agg_count_min_max",
    "SELECT o_custkey, count(*) AS orders, min(o_orderdate) AS first_order, max(o_orderdate) AS last_order FROM {orders} GROUP BY o_custkey",
)
def agg_count_min_max(t: Inputs):
    return t.orders.groupBy("o_custkey").agg(
        F.count(F.lit(1)).alias("orders"), F.min("o_orderdate").alias("first_order"), F.max("o_orderdate").alias("last_order")
    )


@query(
    "agg_count_distinct",
    "SELECT l_suppkey, count(DISTINCT l_shipdate) AS days, count(DISTINCT l_partkey) AS parts FROM {lineitem} GROUP BY l_suppkey",
)
def agg_count_distinct(t: Inputs):
    return t.lineitem.groupBy("l_suppkey").agg(
        F.countDistinct("l_shipdate").alias("days"), F.countDistinct("l_partkey").alias("parts")
    )


@query("agg_distinct_rows", "SELECT DISTINCT o_custkey, o_orderpriority FROM {orders}")
def agg_distinct_rows(t: Inputs):
    return t.orders.select("o_custkey", "o_orderpriority").distinct()


@query("agg_drop_duplicates", "SELECT DISTINCT l_partkey, l_returnflag, l_linenumber FROM {lineitem}")
def agg_drop_duplicates(t: Inputs):
    return t.lineitem.select("l_partkey", "l_returnflag", "l_linenumber").dropDuplicates()


@query(
    "agg_any_positive_flags",
    """SELECT l_orderkey, CASE WHEN sum(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END) > 0 THEN 1 ELSE 0 END AS returned,
         CASE WHEN count(*) > 0 THEN 1 ELSE 0 END AS present FROM {lineitem} GROUP BY l_orderkey""",
)
def agg_any_positive_flags(t: Inputs):
    return t.lineitem.groupBy("l_orderkey").agg(
        F.when(F.sum((F.col("l_returnflag") == "R").cast("int")) > 0, 1).otherwise(0).alias("returned"),
        F.when(F.count(F.lit(1)) > 0, 1).otherwise(0).alias("present"),
    )


CONVERSION = """SELECT customer_id, round(sum(CASE WHEN qty > 0 THEN 1 ELSE 0 END)::DOUBLE / count(*), 6) AS conversion FROM (
  SELECT priced_on, customer_id, app_id, warehouse_id, style, category, coalesce(sum(sales_qty), 0) AS qty
  FROM {price_rows} GROUP BY ALL) GROUP BY customer_id"""


@query("agg_two_level_dedupe", CONVERSION)
def agg_two_level_dedupe(t: Inputs):
    return prices.customer_conversion(t.price_rows)


@query(
    "agg_mean",
    """SELECT cuc, style, round(CASE WHEN count(sale_price) = count(*) THEN sum(sale_price)::DOUBLE / count(*) END, 6) AS mean_price
       FROM {price_rows} WHERE sales_qty > 0 GROUP BY cuc, style""",
)
def agg_mean(t: Inputs):
    complete = F.count("sale_price") == F.count(F.lit(1))
    mean = F.sum("sale_price").cast("double") / F.count(F.lit(1))
    return t.price_rows.filter("sales_qty > 0").groupBy("cuc", "style").agg(F.when(complete, mean).alias("mean_price"))


STAGES["mean_prices"] = """
  SELECT cuc, style, CASE WHEN count(sale_price) = count(*) THEN avg(sale_price::DOUBLE) END AS mean_price
  FROM {price_rows} WHERE sales_qty > 0 GROUP BY cuc, style"""
STAGES["price_scores"] = """
  SELECT cuc, style, mean_price, (mean_price - (SELECT avg(mean_price) FROM {mean_prices}))
    / (SELECT stddev_samp(mean_price) FROM {mean_prices}) AS price_score FROM {mean_prices}"""
STAGES["customer_scores"] = """
  SELECT customer_id, CASE WHEN count(price_score) = count(*) THEN sum(qty::DOUBLE / total * price_score) END AS price_score,
    sum(qty) AS total_qty FROM (
      SELECT *, sum(qty) OVER (PARTITION BY customer_id)::DOUBLE AS total FROM (
        SELECT customer_id, style, cuc, sum(sales_qty) AS qty FROM {price_rows} GROUP BY ALL HAVING sum(sales_qty) > 0)
      JOIN {price_scores} USING (cuc, style))
  GROUP BY customer_id HAVING sum(qty) > 4"""


@query(
    "agg_weighted_share",
    "SELECT customer_id, round(price_score, 6) AS price_score, total_qty::DOUBLE AS total_qty FROM {customer_scores}",
)
def agg_weighted_share(t: Inputs):
    return prices.customer_price_scores(t.price_rows)


@query(
    "agg_complete_cases",
    """SELECT priced_on, sum(sales_qty)::DOUBLE AS qty, sum(sale_price)::DOUBLE AS price FROM {price_rows}
       WHERE sales_qty IS NOT NULL AND sale_price IS NOT NULL GROUP BY priced_on""",
)
def agg_complete_cases(t: Inputs):
    return prices.daily_sales(t.price_rows)


STAGES["monthly"] = f"""
  SELECT warehouse_id, customer_id, company_name, group_id, group_name, activated, CAST(year(month_start) AS INT) AS year,
    CAST(quarter(month_start) AS INT) AS quarter, CAST(month(month_start) AS INT) AS month, sales, roy, ntl, loc
  FROM (SELECT o.customer_id, CAST(date_trunc('month', o.ordered_at) AS DATE) AS month_start, coalesce(sum(o.total), 0) AS sales,
          coalesce(sum(f.roy), 0) AS roy, coalesce(sum(f.ntl), 0) AS ntl, coalesce(sum(f.loc), 0) AS loc
        FROM {{order_header}} o LEFT JOIN ({FEES}) f ON f.so_number = o.so_number
        WHERE o.ordered_at >= TIMESTAMP '1997-01-01' AND o.ordered_at < TIMESTAMP '1998-07-01' GROUP BY ALL) s
  JOIN (SELECT customer_id, m.group_id, g.group_name, max(activated) AS activated FROM {{members}} m LEFT JOIN {{buying_groups}} g USING (group_id)
        WHERE deactivated IS NULL GROUP BY ALL) w USING (customer_id)
  JOIN {{customer_view}} c USING (customer_id) WHERE c.status = 1"""
STAGES["complete_quarters"] = (
    "SELECT year, quarter FROM {monthly} GROUP BY year, quarter HAVING count(DISTINCT month) = 3"
)
STAGES["latest_quarter"] = "SELECT year, quarter FROM {complete_quarters} ORDER BY year DESC, quarter DESC LIMIT 1"


def monthly(t: Inputs):
    return rebates.member_monthly_sales(
        t.members, t.buying_groups, t.customer_view, t.order_header, t.charges, AS_OF
    )


@query(
    "agg_period_rollup",
    """SELECT group_id, year, quarter, sum(sales)::DOUBLE AS sales, sum(roy)::DOUBLE AS roy, sum(ntl)::DOUBLE AS ntl, sum(loc)::DOUBLE AS loc
       FROM {monthly} GROUP BY ALL""",
)
def agg_period_rollup(t: Inputs):
    return periods.period_rollup(monthly(t), ["group_id"], ["year", "quarter"], rebates.MEASURES)


@query(
    "agg_complete_period_only",
    """SELECT customer_id, year, quarter, month, sales::DOUBLE AS sales FROM {monthly} JOIN {latest_quarter} USING (year, quarter)""",
)
def agg_complete_period_only(t: Inputs):
    kept = periods.keep_latest_complete_quarter(materialise_stage(monthly(t)))
    return kept.select("customer_id", "year", "quarter", "month", "sales")


# ---------------------------------------------------------------- windows and intervals


@query(
    "window_dedupe_first",
    """SELECT user_id, event_id, event_type FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS n FROM {events})
       WHERE n = 1""",
)
def window_dedupe_first(t: Inputs):
    return ordered.first_per_key(t.events, ["user_id"], [F.col("ts"), F.col("event_id")]).select(
        "user_id", "event_id", "event_type"
    )


@query(
    "window_latest_per_period",
    """SELECT o_custkey, month, o_orderkey FROM (
         SELECT *, date_trunc('month', o_orderdate)::DATE AS month,
           row_number() OVER (PARTITION BY o_custkey, date_trunc('month', o_orderdate) ORDER BY o_orderdate DESC, o_orderkey DESC) AS n
         FROM {orders}) WHERE n = 1""",
)
def window_latest_per_period(t: Inputs):
    rows = t.orders.withColumn("month", F.trunc("o_orderdate", "month"))
    return intervals.latest_per_period(rows, ["o_custkey", "month"], "o_orderdate", ["o_orderkey"]).select(
        "o_custkey", "month", "o_orderkey"
    )


@query(
    "window_group_index",
    """SELECT event_id, user_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS row_index FROM {events}""",
)
def window_group_index(t: Inputs):
    rows = t.events.select("event_id", "user_id", "ts")
    slices = ordered.slices_needed(rows, ["user_id"])
    return ordered.carry(rows, ["user_id"], ["ts", "event_id"], index="row_index", slices=slices).drop("ts")


@query(
    "window_lead_interval",
    """SELECT event_id, user_id, ts AS start_date, lead(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS end_date FROM {events}""",
)
def window_lead_interval(t: Inputs):
    rows = t.events.select("event_id", "user_id", F.col("ts").alias("start_date"))
    slices = ordered.slices_needed(rows, ["user_id"])
    return intervals.lead_intervals(rows, ["user_id"], "start_date", ["event_id"], slices=slices)


@query(
    "window_lag_ignore_nulls",
    """SELECT event_id, user_id, last_value(bought IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts, event_id
         ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS last_bought
       FROM (SELECT *, CASE WHEN event_type = 'purchase' THEN value END AS bought FROM {events})""",
)
def window_lag_ignore_nulls(t: Inputs):
    bought = F.when(F.col("event_type") == "purchase", F.col("value"))
    rows = t.events.select("event_id", "user_id", "ts", bought.alias("bought"))
    slices = ordered.slices_needed(rows, ["user_id"])
    filled = ordered.carry(rows, ["user_id"], ["ts", "event_id"], known={"last_bought": "bought"}, slices=slices)
    return filled.drop("ts", "bought")


STAGES["daily"] = """
  SELECT priced_on, sum(sales_qty) AS qty, sum(sale_price) AS price FROM {price_rows}
  WHERE sales_qty IS NOT NULL AND sale_price IS NOT NULL GROUP BY priced_on"""
ROLLING = """SELECT priced_on, s::DOUBLE AS rolling_sales, q::DOUBLE AS rolling_qty, round(s::DOUBLE / q::DOUBLE, 6) AS avg_sell_price FROM (
  SELECT priced_on, sum(price) OVER w AS s, sum(qty) OVER w AS q, row_number() OVER (ORDER BY priced_on) AS n FROM {daily}
  WINDOW w AS (ORDER BY priced_on ROWS BETWEEN 29 PRECEDING AND CURRENT ROW)) WHERE n >= 30"""


@query(
    "window_rolling_rows",
    """SELECT style, priced_on, s::DOUBLE AS total FROM (
         SELECT style, priced_on, sum(qty) OVER (PARTITION BY style ORDER BY priced_on ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) AS s,
           row_number() OVER (PARTITION BY style ORDER BY priced_on) AS n
         FROM (SELECT style, priced_on, sum(sales_qty) AS qty FROM {price_rows} WHERE sales_qty IS NOT NULL GROUP BY ALL))
       WHERE n >= 7""",
)
def window_rolling_rows(t: Inputs):
    daily = t.price_rows.dropna(subset=["sales_qty"]).groupBy("style", "priced_on").agg(F.sum("sales_qty").alias("qty"))
    return ordered.rolling_rows(daily, "priced_on", {"total": "qty"}, 7, ["style"]).drop("qty")


@query(
    "window_zscore",
    """SELECT c_custkey, round((c_acctbal - (SELECT avg(c_acctbal) FROM {customer})) / (SELECT stddev_samp(c_acctbal) FROM {customer}), 6) AS z
       FROM {customer}""",
)
def window_zscore(t: Inputs):
    return stats.zscore(t.customer.select("c_custkey", "c_acctbal"), "c_acctbal", "z").drop("c_acctbal")


@query(
    "order_statistic",
    """SELECT l_returnflag, (list(l_extendedprice ORDER BY l_extendedprice))[51] AS low,
         (list(l_extendedprice ORDER BY l_extendedprice))[floor(count(*) * 0.95)::INT + 1] AS high FROM {lineitem} GROUP BY l_returnflag""",
)
def order_statistic(t: Inputs):
    return ordered.order_statistic(t.lineitem, "l_extendedprice", {"low": 50, "high": 0.95}, ["l_returnflag"])


@query(
    "join_range_calendar",
    """SELECT day AS active_date, count(*) AS open_lines, sum(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END)::BIGINT AS open_returns
       FROM {lineitem} JOIN {orders} ON l_orderkey = o_orderkey
       JOIN {calendar} ON day BETWEEN CAST(o_orderdate AS DATE) AND CAST(l_shipdate AS DATE) GROUP BY day""",
)
def join_range_calendar(t: Inputs):
    # Lines shipped before the order date have no day.
    lines = t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey"))
    days = intervals.expand_days(lines, F.to_date("o_orderdate"), F.to_date("l_shipdate"))
    return days.groupBy("active_date").agg(
        F.count(F.lit(1)).alias("open_lines"), F.sum((F.col("l_returnflag") == "R").cast("int")).alias("open_returns")
    )


@query(
    "join_interval_asof",
    """SELECT p.event_id, p.user_id, s.event_id AS signup_id, s.start_at FROM (SELECT * FROM {events} WHERE event_type = 'purchase') p LEFT JOIN (
         SELECT event_id, user_id, ts AS start_at, lead(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS end_at
         FROM {events} WHERE event_type = 'signup') s
       ON p.user_id = s.user_id AND p.ts >= s.start_at AND p.ts < coalesce(s.end_at, TIMESTAMP '2999-01-01')""",
)
def join_interval_asof(t: Inputs):
    signups = t.events.filter("event_type = 'signup'").select("user_id", F.col("event_id").alias("signup_id"), F.col("ts").alias("start_at"))
    slices = ordered.slices_needed(t.events, ["user_id"])
    history = intervals.lead_intervals(signups, ["user_id"], "start_at", ["signup_id"], "end_at", slices)
    facts = t.events.filter("event_type = 'purchase'").select("event_id", "user_id", "ts")
    return intervals.join_asof(
        facts, history, ["user_id"], "ts", "start_at", "end_at", {"signup_id": "signup_id", "start_at": "start_at"}, slices
    ).drop("ts")


PERIODS_SQL = """(VALUES ('Monthly', DATE '1998-06-01', DATE '1998-07-01'), ('Bi-Monthly', DATE '1998-05-01', DATE '1998-07-01'),
  ('Quarter', DATE '1998-04-01', DATE '1998-07-01'), ('Annual', DATE '1997-01-01', DATE '1998-01-01')) AS p(frequency, period_start, period_end)"""


@query(
    "join_period_window",
    f"""SELECT frequency, count(*) AS orders, sum(total)::DOUBLE AS total FROM {{order_header}}
        JOIN {PERIODS_SQL} ON ordered_at >= period_start AND ordered_at < period_end
        AND frequency = CASE salesperson WHEN '1-URGENT' THEN 'Monthly' WHEN '2-HIGH' THEN 'Bi-Monthly' WHEN '3-MEDIUM' THEN 'Quarter' ELSE 'Annual' END
        GROUP BY frequency""",
)
def join_period_window(t: Inputs):
    frequency = (
        F.when(F.col("salesperson") == "1-URGENT", "Monthly")
        .when(F.col("salesperson") == "2-HIGH", "Bi-Monthly")
        .when(F.col("salesperson") == "3-MEDIUM", "Quarter")
        .otherwise("Annual")
    )
    inside = (F.col("ordered_at") >= F.col("period_start")) & (F.col("ordered_at") < F.col("period_end"))
    # Four literal rows.
    bounds = F.broadcast(rebates.closed_periods(t.spark, AS_OF))
    return (
        t.order_header.withColumn("frequency", frequency)
        .join(bounds, "frequency")
        .filter(inside)
        .groupBy("frequency")
        .agg(F.count(F.lit(1)).alias("orders"), F.sum("total").alias("total"))
    )


# ---------------------------------------------------------------- chains and allocation

# Walks every chain edge by edge; sources with several targets take the smallest one.
STAGES["edges"] = """
  SELECT source, min(target) AS target FROM {relations} WHERE relation_type = 6 GROUP BY source"""
STAGES["walk"] = """
  SELECT source, target AS first_target, target AS node, 1 AS hops FROM {edges}
  UNION ALL SELECT w.source, w.first_target, e.target, w.hops + 1 FROM walk w JOIN {edges} e ON w.node = e.source WHERE w.hops < 10"""
STAGES["resolved"] = """
  SELECT source, first_target, CASE WHEN done AND hops <= 9 THEN node END AS final_target, CASE WHEN done AND hops <= 9 THEN hops END AS hops
  FROM (SELECT w.source, w.first_target, w.node, w.hops, e.source IS NULL AS done,
          row_number() OVER (PARTITION BY w.source ORDER BY w.hops DESC) AS n
        FROM {walk} w LEFT JOIN {edges} e ON w.node = e.source) WHERE n = 1"""


@query("resolve_chain", "SELECT source, first_target, final_target, hops FROM {resolved}")
def resolve_chain(t: Inputs):
    return sales.adjustment_chains(t.relations)


@query(
    "chain_first_date",
    """SELECT final_target AS so_number, min(CAST(ordered_at AS DATE)) AS first_sale, count(*) AS adjustments
       FROM {resolved} JOIN {order_header} ON so_number = source WHERE final_target IS NOT NULL GROUP BY final_target""",
)
def chain_first_date(t: Inputs):
    days = t.order_header.select(F.col("so_number").alias("source"), F.to_date("ordered_at").alias("day"))
    return chains.chain_first_date(sales.adjustment_chains(t.relations), days)


@query(
    "allocate_evenly",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
         round(o_totalprice / count(*) OVER (PARTITION BY l_orderkey), 6) AS share
       FROM {lineitem} JOIN {orders} ON l_orderkey = o_orderkey""",
)
def allocate_evenly(t: Inputs):
    parents = t.orders.select(F.col("o_orderkey").alias("l_orderkey"), F.col("o_totalprice").alias("share"))
    return allocate.allocate_evenly(t.lineitem.select(*LINE), parents, "l_orderkey", ["share"])


@query(
    "reassign_to_representative",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CASE WHEN l_discount < 0.05 THEN
         CASE WHEN n = 1 THEN CASE WHEN l_returnflag = 'R' THEN -1 ELSE 1 END ELSE 0 END
         ELSE CASE WHEN l_returnflag = 'R' THEN -l_quantity ELSE l_quantity END END::DOUBLE AS quantity
       FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_discount < 0.05 ORDER BY l_linenumber, l_partkey, l_suppkey, l_shipdate, l_quantity,
         l_extendedprice) AS n FROM {lineitem})""",
)
def reassign_to_representative(t: Inputs):
    lines = t.lineitem.withColumn("quantity", F.col("l_quantity"))
    signed = update_where(lines, F.col("l_returnflag") == "R", quantity=-F.col("quantity"))
    return allocate.reassign_to_representative(
        signed,
        "l_orderkey",
        [*LINE[1:], "l_shipdate", "l_quantity", "l_extendedprice"],
        "quantity",
        F.col("l_discount") < 0.05,
    ).select(*LINE, "quantity")


# ---------------------------------------------------------------- statistics

STYLES = ["A", "N", "R"]
LOW, HIGH = 1000, 60000
STAGES["stocked"] = f"""
  SELECT style, sale_price::DOUBLE AS x FROM {{price_rows}} WHERE sale_price > {LOW} AND sale_price < {HIGH} AND in_stock = 1"""
STAGES["styled"] = "SELECT 'all' AS style, x FROM {stocked} UNION ALL SELECT style, x FROM {stocked} WHERE style IN ('A', 'N', 'R')"
STAGES["shape"] = """
  SELECT style, n, bw, low - 3 * bw AS lo, high + 3 * bw AS hi FROM (
    SELECT style, count(*) AS n, min(x) AS low, max(x) AS high,
      0.9 * least(stddev_samp(x), (quantile_cont(x, 0.75) - quantile_cont(x, 0.25)) / 1.34) * pow(count(*), -0.2) AS bw
    FROM {styled} GROUP BY style)"""
STAGES["binned"] = """
  SELECT style, bin, sum(w) AS w FROM (
    SELECT style, b AS bin, b + 1 - place AS w FROM (SELECT style, (x - lo) / (hi - lo) * 511 AS place, least(floor((x - lo) / (hi - lo) * 511), 510) AS b
      FROM {styled} JOIN {shape} USING (style))
    UNION ALL SELECT style, b + 1, place - b FROM (SELECT style, (x - lo) / (hi - lo) * 511 AS place, least(floor((x - lo) / (hi - lo) * 511), 510) AS b
      FROM {styled} JOIN {shape} USING (style))) GROUP BY style, bin"""
STAGES["curve"] = """
  SELECT style, g AS grid_index, lo + (hi - lo) / 511 * g AS grid,
    sum(w * exp(-0.5 * pow((lo + (hi - lo) / 511 * g - (lo + (hi - lo) / 511 * bin)) / bw, 2))) / (any_value(n) * any_value(bw) * sqrt(2 * pi())) AS density
  FROM {binned} JOIN {shape} USING (style), (SELECT unnest(range(512)) AS g) GROUP BY style, g, lo, hi"""
STAGES["segments"] = """
  SELECT *, lead(grid) OVER w AS x1, lead(density) OVER w AS y1 FROM {curve} WINDOW w AS (PARTITION BY style ORDER BY grid_index)"""
CURVE = "SELECT style, grid_index::INT AS grid_index, round(grid, 4) AS grid, round(density, 9) AS density FROM {curve}"


def curve(t: Inputs):
    return prices.price_density_by_style(t.price_rows, STYLES, LOW, HIGH)


def shown(density):
    """Grid values with four places."""
    return density.withColumn("grid", F.round("grid", 4))


@query("kernel_density", CURVE + " WHERE style <> 'all'", places=9)
def kernel_density(t: Inputs):
    kept = prices.stocked_prices(t.price_rows, LOW, HIGH)
    return shown(stats.kernel_density(kept, "sale_price", ["style"]))


@query(
    "linear_interpolate",
    """SELECT a.style, a.x, round(density + (y1 - density) * (a.x - grid) / (x1 - grid), 9) AS density
       FROM (SELECT DISTINCT style, sale_price::DOUBLE AS x FROM {price_rows} WHERE sale_price IS NOT NULL) a
       LEFT JOIN {segments} s ON a.style = s.style AND a.x >= s.grid AND a.x < s.x1""",
    places=9,
)
def linear_interpolate(t: Inputs):
    asked = t.price_rows.filter("sale_price IS NOT NULL").select("style", F.col("sale_price").cast("double").alias("x")).distinct()
    return stats.linear_interpolate(asked, "x", curve(t), ["style"])


@query(
    "range_probability",
    """SELECT style, round(sum(CASE WHEN greatest(grid, 10000) < least(x1, 20000) THEN
         (density + (y1 - density) * (greatest(grid, 10000) - grid) / (x1 - grid) + density + (y1 - density) * (least(x1, 20000) - grid) / (x1 - grid))
         / 2 * (least(x1, 20000) - greatest(grid, 10000)) ELSE 0 END), 6) AS probability
       FROM {segments} WHERE x1 IS NOT NULL GROUP BY style""",
)
def range_probability(t: Inputs):
    return stats.range_probability(curve(t), 10000, 20000, ["style"])


@query(
    "histogram_density",
    """SELECT (bin - 1) * 2000.0::DOUBLE AS bin_start, bin * 2000.0::DOUBLE AS bin_end, n AS count, round(n / (total * 2000.0::DOUBLE), 9) AS density FROM (
         SELECT greatest(ceil(x / 2000.0), 1) AS bin, count(*) AS n, any_value(total) AS total
         FROM (SELECT x, count(*) OVER () AS total FROM {stocked}) GROUP BY 1)""",
    places=9,
)
def histogram_density(t: Inputs):
    return stats.histogram_density(prices.stocked_prices(t.price_rows, LOW, HIGH), "sale_price")


OLS = """SELECT n::BIGINT AS n, round(slope, 6) AS slope, round(intercept, 6) AS intercept, round(r2, 6) AS r_squared,
  round(s, 6) AS residual_error, round(s / sqrt(sxx), 6) AS slope_error, round(s * sqrt(1 / n + mx * mx / sxx), 6) AS intercept_error,
  round(slope / (s / sqrt(sxx)), 6) AS slope_t, round(intercept / (s * sqrt(1 / n + mx * mx / sxx)), 6) AS intercept_t,
  round(1 - (1 - r2) * (n - 1) / (n - 2), 6) AS adjusted_r_squared, round(pow(slope / (s / sqrt(sxx)), 2), 6) AS f_statistic
  FROM (SELECT *, sqrt(syy * (1 - r2) / (n - 2)) AS s FROM (
    SELECT regr_count(y, x) AS n, regr_slope(y, x) AS slope, regr_intercept(y, x) AS intercept, regr_r2(y, x) AS r2, regr_sxx(y, x) AS sxx,
      regr_syy(y, x) AS syy, regr_avgx(y, x) AS mx FROM ({source})))"""


@query("ols_simple", OLS.replace("{source}", "SELECT l_extendedprice / 1000 AS y, l_quantity AS x FROM {lineitem}"))
def ols_simple(t: Inputs):
    rows = t.lineitem.select((F.col("l_extendedprice") / 1000).alias("y"), F.col("l_quantity").alias("x"))
    return stats.ols_simple(rows, "y", "x")


@query(
    "ols_terms",
    """SELECT unnest(['slope', 'intercept']) AS term, round(unnest([slope, intercept]), 4) AS estimate,
         round(unnest([slope_error, intercept_error]), 4) AS error, round(unnest([slope_t, intercept_t]), 4) AS t_value FROM ({fit})""".replace(
        "{fit}", OLS.replace("{source}", "SELECT l_extendedprice / 1000 AS y, l_quantity AS x FROM {lineitem}")
    ),
    places=4,
)
def ols_terms(t: Inputs):
    """Without the p values, for which the check has no distribution; they are tested with known ones."""
    rows = t.lineitem.select((F.col("l_extendedprice") / 1000).alias("y"), F.col("l_quantity").alias("x"))
    return stats.ols_terms(rows, "y", "x").drop("p_value")


@query(
    "bootstrap_ci",
    """SELECT round(max(CASE WHEN n = 51 THEN mean END), 6) AS low, round(max(CASE WHEN n = 951 THEN mean END), 6) AS high FROM (
         SELECT mean, row_number() OVER (ORDER BY mean, g) AS n FROM (
           SELECT id // 100 AS g, avg(o_totalprice) AS mean
           FROM (SELECT id, CAST('0x' || substring(md5('0-' || CAST(id AS VARCHAR)), 1, 15) AS BIGINT) % (SELECT count(*) FROM {orders}) AS i
                 FROM (SELECT unnest(range(100000)) AS id))
           JOIN (SELECT o_totalprice, row_number() OVER (ORDER BY substring(md5(CAST(o_orderkey AS VARCHAR)), 1, 4), o_orderkey) - 1 AS i FROM {orders})
           USING (i) GROUP BY g))""",
)
def bootstrap_ci(t: Inputs):
    return stats.bootstrap_ci(t.orders, "o_orderkey", "o_totalprice")
