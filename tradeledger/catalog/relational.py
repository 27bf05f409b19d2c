"""Single steps over the given tables: sources, projections, filters, joins, sets, scalar functions."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import functions as F

from tradeledger.catalog.inputs import Inputs
from tradeledger.catalog.registry import query
from tradeledger.functions import audit, dates, geo, text
from tradeledger.operators import tables as ops
from tradeledger.plans import rebates
from tradeledger.session import scratch_path
from tradeledger.sources import change, read, write

MONEY = "decimal(12,2)"
TZ = "America/Los_Angeles"
AS_OF = dt.date(1998, 7, 15)


def money(column: str):
    return F.col(column).cast(MONEY)


# ---------------------------------------------------------------- sources and sinks


@query(
    "scan_tables",
    """SELECT r_name, n_name, count(*) AS customers FROM {region} JOIN {nation} ON r_regionkey = n_regionkey
       JOIN {customer} ON n_nationkey = c_nationkey GROUP BY ALL""",
)
def scan_tables(t: Inputs):
    found = read.scan_tables(t.spark, t.folder, ["region", "nation", "customer"])
    nations = found["nation"].join(found["region"], F.col("n_regionkey") == F.col("r_regionkey"))
    return (
        found["customer"]
        .join(nations, F.col("c_nationkey") == F.col("n_nationkey"))
        .groupBy("r_name", "n_name")
        .agg(F.count(F.lit(1)).alias("customers"))
    )


@query("scan_csv", "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM {customer}")
def scan_csv(t: Inputs):
    path = scratch_path(t.spark, "csv")
    t.customer.write.csv(path, header=True)
    return read.scan_csv(t.spark, path, t.customer.schema)


@query(
    "scan_file_set",
    "SELECT 'segment=' || c_mktsegment AS source_file, count(*) AS n, max(c_custkey) AS last_key FROM {customer} GROUP BY ALL",
)
def scan_file_set(t: Inputs):
    path = scratch_path(t.spark, "files")
    rows = t.customer.select("c_custkey", "c_name", F.col("c_mktsegment").alias("segment"))
    rows.write.partitionBy("segment").csv(path, header=True)
    found = read.scan_file_set(t.spark, path, ".csv", "c_custkey bigint, c_name string", "part-")
    return found.groupBy("source_file").agg(
        F.count(F.lit(1)).alias("n"), F.max("c_custkey").alias("last_key")
    )


@query(
    "stack_file_set",
    """SELECT s_suppkey::VARCHAR AS key, s_name AS name, NULL AS notes FROM {supplier}
       UNION ALL SELECT c_custkey::VARCHAR, c_name, c_mktsegment FROM {customer}""",
)
def stack_file_set(t: Inputs):
    path = scratch_path(t.spark, "files")
    t.supplier.select(F.col("s_suppkey").alias("Key"), F.col("s_name").alias("Na_me")).write.csv(f"{path}/one", header=True)
    customers = t.customer.select(
        F.col("c_name").alias("NAME"), F.col("c_custkey").alias("key"), F.col("c_mktsegment").alias("Comments")
    )
    customers.write.csv(f"{path}/two", header=True)
    return read.stack_file_set(t.spark, path, ".csv").select("key", "name", "notes")


@query("normalise_headers", "SELECT p_partkey AS ppartkey, p_name AS partname, p_brand AS notes FROM {part}")
def normalise_headers(t: Inputs):
    return read.normalise_headers(
        t.part.select("p_partkey", F.col("p_name").alias("Part_ Name"), F.col("p_brand").alias("Comments"))
    )


@query(
    "append_ragged",
    """SELECT s_suppkey AS key, s_name AS name, NULL AS segment, s_acctbal AS balance FROM {supplier}
       UNION ALL SELECT c_custkey, c_name, c_mktsegment, NULL FROM {customer}""",
)
def append_ragged(t: Inputs):
    suppliers = t.supplier.select(
        F.col("s_suppkey").alias("key"), F.col("s_name").alias("name"), F.col("s_acctbal").alias("balance")
    )
    customers = t.customer.select(
        F.col("c_custkey").alias("key"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment")
    )
    return read.append_ragged(suppliers, customers)


@query(
    "materialise_stage",
    """SELECT o_orderstatus, count(*) AS orders, max(spent)::DOUBLE AS largest
       FROM (SELECT o_custkey, o_orderstatus, sum(o_totalprice::DECIMAL(12,2)) AS spent FROM {orders} GROUP BY ALL)
       GROUP BY ALL""",
)
def materialise_stage(t: Inputs):
    spent = t.orders.groupBy("o_custkey", "o_orderstatus").agg(F.sum(money("o_totalprice")).alias("spent"))
    stage = write.materialise_stage(spent)
    return stage.groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("orders"), F.max("spent").alias("largest"))


@query(
    "sink_ctas",
    "SELECT o_orderpriority, count(*) AS orders, sum(o_totalprice::DECIMAL(12,2))::DOUBLE AS total FROM {orders} GROUP BY ALL",
)
def sink_ctas(t: Inputs):
    summary = t.orders.groupBy("o_orderpriority").agg(
        F.count(F.lit(1)).alias("orders"), F.sum(money("o_totalprice")).alias("total")
    )
    return write.sink_ctas(summary, f"priority_summary_{uuid.uuid4().hex}", scratch_path(t.spark, "ctas"))


@query(
    "sink_incremental_append",
    f"""SELECT event_id, user_id, event_type, local_day FROM (
          SELECT *, CAST(timezone('{TZ}', timezone('UTC', ts)) AS DATE) AS local_day FROM {{events}})
        WHERE local_day >= DATE '2024-01-08' AND local_day < DATE '2024-01-15'""",
)
def sink_incremental_append(t: Inputs):
    path = scratch_path(t.spark, "append")
    rows = t.events.select("event_id", "user_id", "event_type", "ts")
    write.sink_incremental_append(rows, path, "ts", dt.date(2024, 1, 14), days=6, tz=TZ)
    # The second run repeats five days and adds one; nothing is written twice.
    return write.sink_incremental_append(rows, path, "ts", dt.date(2024, 1, 15), days=6, tz=TZ).drop("ts")


@query(
    "sink_multi_report",
    """SELECT 'large' AS report, o_orderstatus AS source_file, count(*) AS n FROM {orders}
       WHERE o_totalprice > 250000 GROUP BY ALL
       UNION ALL SELECT 'everything', o_orderstatus, count(*) FROM {orders} GROUP BY ALL""",
)
def sink_multi_report(t: Inputs):
    orders = t.orders.withColumnRenamed("o_orderstatus", "source_file").select("source_file", "o_orderkey", "o_totalprice")
    reports = {"large": orders.filter("o_totalprice > 250000"), "everything": orders}
    back = write.sink_multi_report(reports, scratch_path(t.spark, "reports"))
    return back.groupBy("report", "source_file").agg(F.count(F.lit(1)).alias("n"))


@query(
    "inline_rows",
    """SELECT label, count(*) AS orders FROM {orders}
       JOIN (VALUES ('F', 'finished'), ('O', 'open')) AS v(status, label) ON o_orderstatus = status GROUP BY ALL""",
)
def inline_rows(t: Inputs):
    labels = read.inline_rows(t.spark, [("F", "finished"), ("O", "open")], "o_orderstatus string, label string")
    return t.orders.join(labels, "o_orderstatus").groupBy("label").agg(F.count(F.lit(1)).alias("orders"))


# ---------------------------------------------------------------- projection and change


@query("project_rename", "SELECT o_orderkey AS so_number, o_custkey AS customer_id, o_totalprice AS total FROM {orders}")
def project_rename(t: Inputs):
    return t.orders.select(
        F.col("o_orderkey").alias("so_number"), F.col("o_custkey").alias("customer_id"), F.col("o_totalprice").alias("total")
    )


@query(
    "derive_columns",
    """SELECT l_orderkey, l_linenumber, 1 AS lookup, CAST(l_quantity > 25 AS INT) AS large_sale,
         round(l_extendedprice / l_quantity, 10) AS unit_price FROM {lineitem}""",
    places=10,
)
def derive_columns(t: Inputs):
    return t.lineitem.select("l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice").withColumns(
        {
            "lookup": F.lit(1),
            "large_sale": (F.col("l_quantity") > 25).cast("int"),
            "unit_price": F.col("l_extendedprice") / F.col("l_quantity"),
        }
    ).drop("l_quantity", "l_extendedprice")


@query(
    "star_plus_computed",
    """SELECT *, c_acctbal < 0 AS in_debt, coalesce(nullif(c_mktsegment, 'MACHINERY'), 'other') AS segment FROM {customer}""",
)
def star_plus_computed(t: Inputs):
    return t.customer.select(
        "*",
        (F.col("c_acctbal") < 0).alias("in_debt"),
        F.coalesce(F.nullif(F.col("c_mktsegment"), F.lit("MACHINERY")), F.lit("other")).alias("segment"),
    )


@query(
    "lateral_alias",
    """SELECT l_returnflag, lookups, sold, round(sold / lookups, 6) AS conversion FROM (
         SELECT l_returnflag, count(*) AS lookups, count(CASE WHEN l_linestatus = 'F' THEN 1 END) AS sold
         FROM {lineitem} GROUP BY l_returnflag)""",
)
def lateral_alias(t: Inputs):
    return t.spark.sql(
        """SELECT l_returnflag, count(*) AS lookups, count(CASE WHEN l_linestatus = 'F' THEN 1 END) AS sold,
             sold / lookups AS conversion
           FROM {lines} GROUP BY l_returnflag""",
        lines=t.lineitem,
    )


@query(
    "flag_columns",
    """SELECT o_orderkey, CASE WHEN o_totalprice > 200000 THEN 1 ELSE 0 END AS large,
         CASE WHEN o_orderstatus = 'F' THEN o_totalprice ELSE 0 END AS finished_total FROM {orders}""",
)
def flag_columns(t: Inputs):
    return t.orders.select(
        "o_orderkey",
        F.when(F.col("o_totalprice") > 200000, 1).otherwise(0).alias("large"),
        F.when(F.col("o_orderstatus") == "F", F.col("o_totalprice")).otherwise(0.0).alias("finished_total"),
    )


@query(
    "decode_codes",
    """SELECT event_id, CASE event_type WHEN 'view' THEN 'Pending' WHEN 'purchase' THEN 'Approved' ELSE event_type END AS label,
         CASE event_type WHEN 'view' THEN 0 WHEN 'purchase' THEN 1 END AS code FROM {events}""",
)
def decode_codes(t: Inputs):
    kind = F.col("event_type")
    return t.events.select(
        "event_id",
        ops.decode_codes(kind, {"view": "Pending", "purchase": "Approved"}, kind).alias("label"),
        ops.decode_codes(kind, {"view": 0, "purchase": 1}).alias("code"),
    )


# Group, limits of a band and whether the band holds them, rate.
RATE_SQL = """coalesce((SELECT max(rate) FROM (VALUES
    (13, -1e15, true, 3000, false, 0), (13, 3000, false, 1e15, true, 2),
    (17, 1000, true, 1999.99, true, 1), (17, 2000, true, 2999.99, true, 2), (17, 3000, true, 3499.99, true, 3), (17, 3499.99, false, 1e15, true, 3.5),
    (18, 1000, true, 1999.99, true, 1), (18, 2000, true, 2999.99, true, 2), (18, 3000, true, 3499.99, true, 3), (18, 3499.99, false, 1e15, true, 3.5),
    (22, 0, true, 3000, true, 10), (22, 3000, false, 1e15, true, 15)
  ) band(member_group, low, holds_low, high, holds_high, rate) WHERE member_group = {g} AND ({a} > low OR holds_low AND {a} = low)
    AND ({a} < high OR holds_high AND {a} = high))::DOUBLE, ({d})::DOUBLE)"""


@query(
    "tiered_rate",
    "SELECT c_custkey, c_nationkey, c_acctbal, "
    + RATE_SQL.format(g="c_nationkey", a="c_acctbal", d="5")
    + " AS rate FROM {customer}",
)
def tiered_rate(t: Inputs):
    rows = t.customer.select("c_custkey", "c_nationkey", "c_acctbal")
    return ops.tiered_rate(rows, rebates.RATE_TIERS, "c_nationkey", "c_acctbal", F.lit(5.0))


@query(
    "measure_switch",
    """SELECT o_orderkey, coalesce(CASE o_orderstatus WHEN 'F' THEN o_totalprice WHEN 'O' THEN o_custkey::DOUBLE END, 0) AS measure
       FROM {orders}""",
)
def measure_switch(t: Inputs):
    return t.orders.select(
        "o_orderkey",
        ops.measure_switch(
            F.col("o_orderstatus"), {"F": F.col("o_totalprice"), "O": F.col("o_custkey").cast("double")}
        ).alias("measure"),
    )


@query(
    "constant_and_null_columns",
    "SELECT n_nationkey, 9 AS group_id, 'Web' AS platform, CAST(NULL AS INT) AS final_so, 0 AS padding FROM {nation}",
)
def constant_and_null_columns(t: Inputs):
    return t.nation.select(
        "n_nationkey",
        F.lit(9).alias("group_id"),
        F.lit("Web").alias("platform"),
        F.lit(None).cast("int").alias("final_so"),
        F.lit(0).alias("padding"),
    )


@query(
    "cte_stage",
    """SELECT a.o_custkey, a.orders, b.most FROM (SELECT o_custkey, count(*) AS orders FROM {orders} GROUP BY ALL) a
       JOIN (SELECT max(orders) AS most FROM (SELECT count(*) AS orders FROM {orders} GROUP BY o_custkey)) b
       ON a.orders = b.most""",
)
def cte_stage(t: Inputs):
    counts = t.orders.groupBy("o_custkey").agg(F.count(F.lit(1)).alias("orders"))
    most = counts.agg(F.max("orders").alias("most"))
    return counts.join(most, F.col("orders") == F.col("most"))


@query(
    "change_stored",
    """SELECT o_orderkey, o_custkey, o_orderpriority, CASE WHEN c_mktsegment = 'BUILDING' THEN c_acctbal ELSE o_totalprice END AS o_totalprice,
         CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') AND o_totalprice > 100000 THEN 'X' ELSE o_orderstatus END AS o_orderstatus
       FROM {orders} LEFT JOIN {customer} ON o_custkey = c_custkey
       WHERE NOT (o_orderpriority IN ('1-URGENT', '2-HIGH') AND o_totalprice > 100000) OR o_orderpriority <> '1-URGENT'""",
)
def change_stored(t: Inputs):
    """Two updates and a delete on a stored copy of the orders, one partition per priority."""
    path, priority = scratch_path(t.spark, "orders"), ["o_orderpriority"]
    columns = ["o_orderkey", "o_custkey", "o_totalprice", "o_orderstatus", *priority]
    t.orders.select(*columns).write.partitionBy(*priority).parquet(path)
    large = F.col("o_orderpriority").isin("1-URGENT", "2-HIGH") & (F.col("o_totalprice") > 100000)
    change.update_stored(t.spark, path, priority, large, o_orderstatus=F.lit("X"))
    builders = t.customer.filter("c_mktsegment = 'BUILDING'").select(F.col("c_custkey").alias("o_custkey"), "c_acctbal")
    change.update_stored_from(t.spark, path, priority, builders, ["o_custkey"], {"o_totalprice": "c_acctbal"})
    change.delete_stored(t.spark, path, priority, (F.col("o_orderstatus") == "X") & (F.col("o_orderpriority") == "1-URGENT"))
    return t.spark.read.schema(t.orders.select(*columns).schema).parquet(path)


@query("drop_columns", "SELECT * EXCLUDE (o_orderpriority, o_orderstatus) FROM {orders}")
def drop_columns(t: Inputs):
    return t.orders.drop("o_orderpriority", "o_orderstatus")


@query(
    "update_where",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
         CASE WHEN l_returnflag = 'R' THEN -l_quantity ELSE l_quantity END AS l_quantity FROM {lineitem}""",
)
def update_where(t: Inputs):
    lines = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_returnflag")
    return ops.update_where(lines, F.col("l_returnflag") == "R", l_quantity=-F.col("l_quantity")).drop("l_returnflag")


@query(
    "update_from_join",
    """SELECT o_orderkey, o_custkey, coalesce(l_shipdate, o_orderdate) AS shipped FROM {orders} LEFT JOIN (
         SELECT l_orderkey, min(l_shipdate) AS l_shipdate FROM {lineitem} WHERE l_returnflag <> 'R' GROUP BY l_orderkey)
       ON o_orderkey = l_orderkey""",
)
def update_from_join(t: Inputs):
    orders = t.orders.select("o_orderkey", "o_custkey", F.col("o_orderdate").alias("shipped"))
    lines = t.lineitem.filter("l_returnflag <> 'R'").select(F.col("l_orderkey").alias("o_orderkey"), "l_shipdate")
    return ops.update_from_join(orders, lines, ["o_orderkey"], {"shipped": "l_shipdate"}, [F.col("l_shipdate")])


@query(
    "delete_where",
    """SELECT o_orderkey, o_custkey FROM {orders}
       WHERE NOT coalesce(nullif(o_custkey, 7) < 100 AND nullif(o_orderpriority, '5-LOW') LIKE '1%', false)""",
)
def delete_where(t: Inputs):
    customer = F.nullif(F.col("o_custkey"), F.lit(7))
    priority = F.nullif(F.col("o_orderpriority"), F.lit("5-LOW"))
    return ops.delete_where(t.orders, (customer < 100) & priority.like("1%")).select("o_orderkey", "o_custkey")


@query(
    "delete_from_join",
    """SELECT o_orderkey, o_custkey FROM {orders}
       WHERE NOT EXISTS (SELECT 1 FROM {lineitem} WHERE l_orderkey = o_orderkey AND l_returnflag = 'R')""",
)
def delete_from_join(t: Inputs):
    returned = t.lineitem.filter("l_returnflag = 'R'").select(F.col("l_orderkey").alias("o_orderkey"))
    return ops.delete_from_join(t.orders.select("o_orderkey", "o_custkey"), returned, ["o_orderkey"])


@query(
    "coalesce_values",
    """SELECT o_orderkey, coalesce(nullif(o_orderpriority, '4-NOT SPECIFIED'), o_orderstatus, 'none') AS label FROM {orders}""",
)
def coalesce_values(t: Inputs):
    priority = F.nullif(F.col("o_orderpriority"), F.lit("4-NOT SPECIFIED"))
    return t.orders.select("o_orderkey", F.coalesce(priority, "o_orderstatus", F.lit("none")).alias("label"))


@query(
    "cast_values",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CAST(CAST(l_quantity AS DECIMAL(5,2)) AS DOUBLE) AS quantity,
         CAST(l_shipdate AS DATE) AS ship_day, TRY_CAST(l_returnflag AS INT) AS flag_number,
         CAST(l_linenumber AS VARCHAR) AS line_text FROM {lineitem}""",
)
def cast_values(t: Inputs):
    return t.lineitem.select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        "l_suppkey",
        F.col("l_quantity").cast("decimal(5,2)").alias("quantity"),
        F.col("l_shipdate").cast("date").alias("ship_day"),
        F.col("l_returnflag").try_cast("int").alias("flag_number"),
        F.col("l_linenumber").cast("string").alias("line_text"),
    )


# ---------------------------------------------------------------- filters


@query(
    "filter_compare",
    """SELECT o_orderkey, o_totalprice FROM {orders}
       WHERE o_orderdate >= TIMESTAMP '1997-01-01' AND o_totalprice < 300000 AND o_orderstatus <> 'P' AND o_custkey > 10""",
)
def filter_compare(t: Inputs):
    return t.orders.filter(
        (F.col("o_orderdate") >= dates.ntz("1997-01-01"))
        & (F.col("o_totalprice") < 300000)
        & (F.col("o_orderstatus") != "P")
        & (F.col("o_custkey") > 10)
    ).select("o_orderkey", "o_totalprice")


@query(
    "filter_in_list",
    """SELECT p_partkey, p_brand FROM {part}
       WHERE p_brand IN ('Brand#1', 'Brand#12', 'Brand#25') AND p_type NOT IN ('PROMO', 'SMALL')""",
)
def filter_in_list(t: Inputs):
    return t.part.filter(
        F.col("p_brand").isin("Brand#1", "Brand#12", "Brand#25") & ~F.col("p_type").isin("PROMO", "SMALL")
    ).select("p_partkey", "p_brand")


@query(
    "filter_like",
    "SELECT p_partkey, p_name FROM {part} WHERE p_name LIKE 'small%' OR (p_name LIKE '%ring%' AND p_name NOT LIKE 'red%')",
)
def filter_like(t: Inputs):
    name = F.col("p_name")
    return t.part.filter(name.startswith("small") | (name.contains("ring") & ~name.startswith("red"))).select(
        "p_partkey", "p_name"
    )


@query(
    "filter_like_column",
    """SELECT p_partkey, p_name, p_type FROM {part}
       WHERE lower(p_name) LIKE '%' || lower(substring(p_type, 1, 2)) || '%'""",
)
def filter_like_column(t: Inputs):
    return t.part.filter(
        text.contains_ignore_case(F.col("p_name"), F.substring("p_type", 1, 2))
    ).select("p_partkey", "p_name", "p_type")


@query(
    "filter_between",
    """SELECT o_orderkey FROM {orders} WHERE o_totalprice BETWEEN 1000 AND 150000
       AND CAST(o_orderdate AS DATE) BETWEEN DATE '1996-01-01' AND DATE '1998-12-31'
       AND CAST(substring(o_orderpriority, 1, 1) AS INT) BETWEEN 2 AND 4""",
)
def filter_between(t: Inputs):
    # The closed date range on the day is a half-open range on the raw column, which reaches the scan.
    in_days = (F.col("o_orderdate") >= dates.ntz("1996-01-01")) & (F.col("o_orderdate") < dates.ntz("1999-01-01"))
    rank = F.substring("o_orderpriority", 1, 1).cast("int")
    return t.orders.filter(F.col("o_totalprice").between(1000, 150000) & in_days & rank.between(2, 4)).select("o_orderkey")


@query(
    "filter_null_tests",
    """SELECT o_orderkey, flag FROM (SELECT o_orderkey, o_custkey, nullif(o_orderstatus, 'P') AS flag,
         nullif(o_orderpriority, '5-LOW') AS priority FROM {orders}) WHERE flag IS NULL AND priority IS NOT NULL""",
)
def filter_null_tests(t: Inputs):
    rows = t.orders.select(
        "o_orderkey",
        F.nullif(F.col("o_orderstatus"), F.lit("P")).alias("flag"),
        F.nullif(F.col("o_orderpriority"), F.lit("5-LOW")).alias("priority"),
    )
    return rows.filter(F.col("flag").isNull() & F.col("priority").isNotNull()).select("o_orderkey", "flag")


@query(
    "filter_relative_dates",
    f"""SELECT event_id, user_id FROM {{events}}
        WHERE CAST(timezone('{TZ}', timezone('UTC', ts)) AS DATE) >= DATE '2024-01-31' - 14
          AND CAST(timezone('{TZ}', timezone('UTC', ts)) AS DATE) < DATE '2024-01-31' - 1""",
)
def filter_relative_dates(t: Inputs):
    as_of = dt.date(2024, 1, 31)
    low, high = dates.local_day_bounds(as_of - dt.timedelta(days=14), as_of - dt.timedelta(days=1), TZ)
    return t.events.filter((F.col("ts") >= low) & (F.col("ts") < high)).select("event_id", "user_id")


@query(
    "filter_scalar_subquery",
    """SELECT o_orderkey, o_custkey FROM {orders}
       WHERE o_orderdate >= (SELECT min(l_shipdate) FROM {lineitem}
         WHERE l_quantity = (SELECT max(l_quantity) FROM {lineitem} WHERE l_returnflag = 'R'))""",
)
def filter_scalar_subquery(t: Inputs):
    most = t.lineitem.filter("l_returnflag = 'R'").agg(F.max("l_quantity")).scalar()
    first = t.lineitem.filter(F.col("l_quantity") == most).agg(F.min("l_shipdate")).scalar()
    return t.orders.filter(F.col("o_orderdate") >= first).select("o_orderkey", "o_custkey")


@query(
    "filter_post_agg",
    "SELECT l_partkey, count(DISTINCT l_linenumber) AS lines FROM {lineitem} GROUP BY l_partkey HAVING count(DISTINCT l_linenumber) = 7",
)
def filter_post_agg(t: Inputs):
    return t.lineitem.groupBy("l_partkey").agg(F.countDistinct("l_linenumber").alias("lines")).filter("lines = 7")


@query(
    "filter_drop_null_rows",
    """SELECT o_orderkey, o_custkey, status FROM (SELECT o_orderkey, nullif(o_custkey, 5) AS o_custkey,
         nullif(o_orderstatus, 'P') AS status FROM {orders}) WHERE status IS NOT NULL AND o_custkey IS NOT NULL""",
)
def filter_drop_null_rows(t: Inputs):
    return t.orders.select(
        "o_orderkey",
        F.nullif(F.col("o_custkey"), F.lit(5)).alias("o_custkey"),
        F.nullif(F.col("o_orderstatus"), F.lit("P")).alias("status"),
    ).dropna(subset=["status", "o_custkey"])


@query(
    "filter_null_rejecting",
    """SELECT c_custkey, count(*) AS finished FROM {customer} LEFT JOIN {orders} ON c_custkey = o_custkey
       WHERE o_orderstatus = 'F' GROUP BY c_custkey""",
)
def filter_null_rejecting(t: Inputs):
    finished = t.orders.filter("o_orderstatus = 'F'").select(F.col("o_custkey").alias("c_custkey"))
    return t.customer.select("c_custkey").join(finished, "c_custkey").groupBy("c_custkey").agg(
        F.count(F.lit(1)).alias("finished")
    )


@query("query_parameter", "SELECT c_custkey, c_name FROM {customer} WHERE c_nationkey = 9 AND c_acctbal >= 100")
def query_parameter(t: Inputs):
    return t.spark.sql(
        "SELECT c_custkey, c_name FROM {customers} WHERE c_nationkey = :nation AND c_acctbal >= :least",
        args={"nation": 9, "least": 100},
        customers=t.customer,
    )


# ---------------------------------------------------------------- joins


@query(
    "join_inner_star",
    """SELECT n_name, p_brand, sum(l_extendedprice::DECIMAL(12,2))::DOUBLE AS sold FROM {lineitem}
       JOIN {part} ON l_partkey = p_partkey JOIN {supplier} ON l_suppkey = s_suppkey
       JOIN {nation} ON s_nationkey = n_nationkey GROUP BY ALL""",
)
def join_inner_star(t: Inputs):
    nations = t.supplier.join(t.nation, F.col("s_nationkey") == F.col("n_nationkey")).select("s_suppkey", "n_name")
    return (
        t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey"))
        .join(nations, F.col("l_suppkey") == F.col("s_suppkey"))
        .groupBy("n_name", "p_brand")
        .agg(F.sum(money("l_extendedprice")).alias("sold"))
    )


@query(
    "join_left_outer",
    """SELECT c_custkey, o_orderkey, o_totalprice FROM {customer} LEFT JOIN {orders} ON c_custkey = o_custkey""",
)
def join_left_outer(t: Inputs):
    return t.customer.join(t.orders, F.col("c_custkey") == F.col("o_custkey"), "left").select(
        "c_custkey", "o_orderkey", "o_totalprice"
    )


VISITS = """SELECT DISTINCT user_id, CAST(ts AS DATE) AS day FROM {events} WHERE event_type = """


@query(
    "join_right_outer_multikey",
    f"""SELECT v.user_id, v.day, s.purchases FROM (
          SELECT user_id, CAST(ts AS DATE) AS day, count(*) AS purchases, max(value) AS largest FROM {{events}}
          WHERE event_type = 'purchase' GROUP BY ALL) s
        RIGHT JOIN ({VISITS}'view') v ON s.user_id = v.user_id AND s.day = v.day AND s.largest > 20""",
)
def join_right_outer_multikey(t: Inputs):
    day = F.to_date("ts").alias("day")
    bought = t.events.filter("event_type = 'purchase'").groupBy("user_id", day).agg(
        F.count(F.lit(1)).alias("purchases"), F.max("value").alias("largest")
    )
    views = t.events.filter("event_type = 'view'").select("user_id", day).distinct()
    # The one-sided part of the condition is applied before the join.
    return bought.filter("largest > 20").drop("largest").join(views, ["user_id", "day"], "right")


@query(
    "join_left_filtered_on",
    """SELECT c_custkey, count(o_orderkey) AS urgent FROM {customer}
       LEFT JOIN {orders} ON c_custkey = o_custkey AND o_orderpriority = '1-URGENT' GROUP BY c_custkey""",
)
def join_left_filtered_on(t: Inputs):
    urgent = t.orders.filter("o_orderpriority = '1-URGENT'").groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        F.count(F.lit(1)).alias("urgent")
    )
    return t.customer.select("c_custkey").join(urgent, "c_custkey", "left").fillna(0, ["urgent"])


@query(
    "join_inner_filtered_on",
    """SELECT o_orderkey, c_name FROM {orders} JOIN {customer}
       ON o_custkey = c_custkey AND c_mktsegment NOT LIKE '%MACH%' AND o_totalprice < 50000""",
)
def join_inner_filtered_on(t: Inputs):
    return (
        t.orders.filter("o_totalprice < 50000")
        .join(t.customer.filter(~F.col("c_mktsegment").contains("MACH")), F.col("o_custkey") == F.col("c_custkey"))
        .select("o_orderkey", "c_name")
    )


@query(
    "join_left_anti",
    """SELECT c_custkey FROM {customer} LEFT JOIN {orders} ON c_custkey = o_custkey AND o_orderstatus = 'P'
       WHERE o_orderkey IS NULL""",
)
def join_left_anti(t: Inputs):
    pending = t.orders.filter("o_orderstatus = 'P'").select(F.col("o_custkey").alias("c_custkey"))
    return t.customer.select("c_custkey").join(pending, "c_custkey", "left_anti")


@query(
    "join_full_by_union",
    f"""SELECT coalesce(v.user_id, p.user_id) AS user_id, coalesce(v.day, p.day) AS day,
          v.user_id IS NOT NULL AS viewed, p.user_id IS NOT NULL AS bought
        FROM ({VISITS}'view') v FULL JOIN ({VISITS}'purchase') p ON v.user_id = p.user_id AND v.day = p.day""",
)
def join_full_by_union(t: Inputs):
    def visits(kind: str, flag: str):
        rows = t.events.filter(F.col("event_type") == kind)
        return rows.select("user_id", F.to_date("ts").alias("day")).distinct().withColumn(flag, F.lit(True))

    both = ops.full_join_split(visits("view", "viewed"), visits("purchase", "bought"), ["user_id", "day"])
    return both.fillna(False, ["viewed", "bought"])


@query(
    "join_existence_flag",
    """SELECT o_orderkey, EXISTS (SELECT 1 FROM {lineitem} WHERE l_orderkey = o_orderkey AND l_returnflag = 'R') AS has_return
       FROM {orders}""",
)
def join_existence_flag(t: Inputs):
    returned = t.lineitem.filter("l_returnflag = 'R'").select(F.col("l_orderkey").alias("o_orderkey"))
    return ops.existence_flag(t.orders.select("o_orderkey"), returned, ["o_orderkey"], "has_return")


@query(
    "join_multi_role",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, b.n_name AS buyer_nation, s.n_name AS seller_nation
       FROM {lineitem} JOIN {orders} ON l_orderkey = o_orderkey JOIN {customer} ON o_custkey = c_custkey
       JOIN {supplier} ON l_suppkey = s_suppkey
       LEFT JOIN {nation} b ON c_nationkey = b.n_nationkey AND b.n_regionkey < 3
       LEFT JOIN {nation} s ON s_nationkey = s.n_nationkey AND s.n_regionkey > 1""",
)
def join_multi_role(t: Inputs):
    buyer = t.nation.filter("n_regionkey < 3").select(F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("buyer_nation"))
    seller = t.nation.filter("n_regionkey > 1").select(F.col("n_nationkey").alias("s_nationkey"), F.col("n_name").alias("seller_nation"))
    buyers = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).join(buyer, "c_nationkey", "left")
    sellers = t.supplier.join(seller, "s_nationkey", "left")
    return (
        t.lineitem.join(sellers, F.col("l_suppkey") == F.col("s_suppkey"))
        .join(buyers, F.col("l_orderkey") == F.col("o_orderkey"))
        .select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "buyer_nation", "seller_nation")
    )


@query(
    "join_preaggregated",
    """SELECT o_orderkey, o_custkey, lines, last_ship FROM {orders} LEFT JOIN (
         SELECT l_orderkey, count(*) AS lines, max(l_shipdate) AS last_ship FROM {lineitem} GROUP BY l_orderkey)
       ON o_orderkey = l_orderkey""",
)
def join_preaggregated(t: Inputs):
    per_order = t.lineitem.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        F.count(F.lit(1)).alias("lines"), F.max("l_shipdate").alias("last_ship")
    )
    return t.orders.select("o_orderkey", "o_custkey").join(per_order, "o_orderkey", "left")


@query(
    "join_distinct_dimension",
    """SELECT p_brand, core_type, count(*) AS lookups FROM {lookups} JOIN
         (SELECT DISTINCT cuc AS p_brand, core_type, category FROM {items} WHERE category = 'STANDARD') ON cuc = p_brand
       GROUP BY ALL""",
)
def join_distinct_dimension(t: Inputs):
    products = t.items.filter("category = 'STANDARD'").select("cuc", "core_type", "category").distinct()
    return (
        t.lookups.join(products, "cuc")
        .groupBy(F.col("cuc").alias("p_brand"), "core_type")
        .agg(F.count(F.lit(1)).alias("lookups"))
    )


@query(
    "join_self_aggregate",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
         round(l_quantity / sum(l_quantity) OVER (PARTITION BY l_orderkey), 6) AS share FROM {lineitem}""",
)
def join_self_aggregate(t: Inputs):
    lines = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity")
    totals = lines.groupBy("l_orderkey").agg(F.sum("l_quantity").alias("total"))
    return (
        lines.join(totals, "l_orderkey")
        .withColumn("share", F.col("l_quantity") / F.col("total"))
        .drop("l_quantity", "total")
    )


@query(
    "join_natural",
    """SELECT * FROM (SELECT l_returnflag, l_linestatus, count(*) AS lines FROM {lineitem} GROUP BY ALL)
       NATURAL JOIN (SELECT l_returnflag, l_linestatus, max(l_quantity) AS largest FROM {lineitem} GROUP BY ALL)""",
)
def join_natural(t: Inputs):
    grouped = t.lineitem.groupBy("l_returnflag", "l_linestatus")
    left = grouped.agg(F.count(F.lit(1)).alias("lines"))
    right = grouped.agg(F.max("l_quantity").alias("largest"))
    return left.join(right, [c for c in left.columns if c in right.columns])


@query(
    "join_concat_key",
    """SELECT u.part_number, u.release_name, r.productname FROM {uploads} u LEFT JOIN {releases} r
       ON u.release_name IS NOT DISTINCT FROM r.releasename AND u.release_version IS NOT DISTINCT FROM r.releaseversion""",
)
def join_concat_key(t: Inputs):
    u, r = t.uploads.alias("u"), t.releases.alias("r")
    same = F.col("u.release_name").eqNullSafe(F.col("r.releasename")) & F.col("u.release_version").eqNullSafe(
        F.col("r.releaseversion")
    )
    return u.join(r, same, "left").select("part_number", "release_name", "productname")


@query(
    "join_case_insensitive",
    """SELECT r_regionkey, super_region, count(*) AS nations FROM {region} JOIN {region_names} ON lower(r_name) = lower(region_name)
       JOIN {nation} ON n_regionkey = r_regionkey GROUP BY ALL""",
)
def join_case_insensitive(t: Inputs):
    named = t.region.join(t.region_names, F.lower("r_name") == F.lower("region_name"))
    return (
        t.nation.join(named, F.col("n_regionkey") == F.col("r_regionkey"))
        .groupBy("r_regionkey", "super_region")
        .agg(F.count(F.lit(1)).alias("nations"))
    )


@query(
    "join_computed_key",
    """SELECT order_id, wmid FROM {market_orders} o JOIN {listings} l
       ON o.listing_id = l.listing_id AND o.order_listing_type = l.listing_type - 2""",
)
def join_computed_key(t: Inputs):
    o, l = t.market_orders.alias("o"), t.listings.alias("l")
    same = (F.col("o.listing_id") == F.col("l.listing_id")) & (
        F.col("o.order_listing_type") == F.col("l.listing_type") - 2
    )
    return o.join(l, same).select("order_id", "wmid")


@query(
    "join_calendar_equi",
    """SELECT o_orderkey, fiscal_week, fiscal_month FROM {orders} JOIN {calendar} ON CAST(o_orderdate AS DATE) = day""",
)
def join_calendar_equi(t: Inputs):
    return t.orders.withColumn("day", F.to_date("o_orderdate")).join(t.calendar, "day").select(
        "o_orderkey", "fiscal_week", "fiscal_month"
    )


@query(
    "join_cross_sequence",
    """SELECT event_id, unnest(string_split('a' || ',' || event_type || ',' || CAST(user_id AS VARCHAR), ',')) AS part,
         unnest([0, 1, 2]) AS n FROM {events}""",
)
def join_cross_sequence(t: Inputs):
    joined = F.concat_ws(",", F.lit("a"), "event_type", F.col("user_id").cast("string"))
    return t.events.select("event_id", F.posexplode(F.split(joined, ",")).alias("n", "part"))


# ---------------------------------------------------------------- sets, sorting, limits


@query("sort_rows", "SELECT o_orderkey, o_custkey, o_totalprice FROM {orders} ORDER BY o_custkey ASC NULLS FIRST, o_orderkey DESC NULLS LAST")
def sort_rows(t: Inputs):
    return t.orders.select("o_orderkey", "o_custkey", "o_totalprice").orderBy(
        F.col("o_custkey").asc_nulls_first(), F.col("o_orderkey").desc_nulls_last()
    )


@query("limit_rows", "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey FROM {lineitem} ORDER BY ALL LIMIT 1000")
def limit_rows(t: Inputs):
    # A top-n report: the cap is the feature, and the order makes it repeatable.
    key = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
    return t.lineitem.select(*key).orderBy(*key).limit(1000)


@query(
    "union_distinct",
    "SELECT o_custkey AS customer, o_orderpriority AS label FROM {orders} UNION SELECT c_custkey, c_mktsegment FROM {customer}",
)
def union_distinct(t: Inputs):
    first = t.orders.select(F.col("o_custkey").alias("customer"), F.col("o_orderpriority").alias("label"))
    return first.union(t.customer.select("c_custkey", "c_mktsegment")).distinct()


@query(
    "union_all",
    "SELECT s_nationkey AS nation, s_acctbal AS balance FROM {supplier} UNION ALL SELECT c_nationkey, c_acctbal FROM {customer}",
)
def union_all(t: Inputs):
    first = t.supplier.select(F.col("s_nationkey").alias("nation"), F.col("s_acctbal").alias("balance"))
    second = t.customer.select(F.col("c_acctbal").alias("balance"), F.col("c_nationkey").alias("nation"))
    return first.unionByName(second)


@query(
    "union_tagged",
    "SELECT s_name AS name, 'supplier' AS kind FROM {supplier} UNION ALL SELECT c_name, 'customer' FROM {customer}",
)
def union_tagged(t: Inputs):
    return ops.union_tagged(
        {
            "supplier": t.supplier.select(F.col("s_name").alias("name")),
            "customer": t.customer.select(F.col("c_name").alias("name")),
        },
        "kind",
    )


@query(
    "union_padded",
    """SELECT o_orderkey, o_totalprice, 1 AS opportunity FROM {orders} WHERE o_orderstatus = 'F'
       UNION ALL SELECT o_orderkey, o_totalprice, 0 FROM {orders} WHERE o_orderstatus <> 'F'""",
)
def union_padded(t: Inputs):
    rows = t.orders.select("o_orderkey", "o_totalprice", "o_orderstatus")
    first = rows.filter("o_orderstatus = 'F'").drop("o_orderstatus").withColumn("opportunity", F.lit(1))
    return ops.union_padded(first, rows.filter("o_orderstatus <> 'F'").drop("o_orderstatus"), {"opportunity": 0})


# ---------------------------------------------------------------- scalar functions


@query(
    "text_slice",
    """SELECT c_custkey, substring(c_name, 1, 8) AS head, left(c_mktsegment, 3) AS abbreviation, right(c_name, 4) AS tail,
         position('#' IN c_name) AS mark FROM {customer}""",
)
def text_slice(t: Inputs):
    return t.customer.select(
        "c_custkey",
        F.substring("c_name", 1, 8).alias("head"),
        F.left("c_mktsegment", F.lit(3)).alias("abbreviation"),
        F.right("c_name", F.lit(4)).alias("tail"),
        F.locate("#", "c_name").cast("bigint").alias("mark"),
    )


@query(
    "text_split_replace",
    """SELECT p_partkey, split_part(p_name, ' ', 2) AS noun, replace(replace(p_brand, 'Brand', ''), '#', '') AS brand_number,
         concat(lower(p_type), '-', p_name) AS label FROM {part}""",
)
def text_split_replace(t: Inputs):
    return t.part.select(
        "p_partkey",
        F.split_part("p_name", F.lit(" "), F.lit(2)).alias("noun"),
        F.regexp_replace("p_brand", "Brand|#", "").alias("brand_number"),
        F.concat(F.lower("p_type"), F.lit("-"), "p_name").alias("label"),
    )


@query("text_count_char", "SELECT doc_id, length(text) - length(replace(text, ',', '')) AS commas FROM {documents}")
def text_count_char(t: Inputs):
    return t.documents.select("doc_id", text.count_char(F.col("text"), ",").cast("bigint").alias("commas"))


@query(
    "text_extract_after_key",
    """SELECT event_id, substring(event_type, 1, 30) AS kind, CAST(NULL AS VARCHAR) AS absent FROM {events}""",
)
def text_extract_after_key(t: Inputs):
    joined = F.concat(F.lit("user_id:"), F.col("user_id").cast("string"), F.lit(",kind:"), "event_type", F.lit(",last:1"))
    return t.events.select(
        "event_id",
        text.value_after_key(joined, "kind", 30).alias("kind"),
        text.value_after_key(joined, "other").alias("absent"),
    )


@query(
    "json_path_text",
    "SELECT event_id, json_extract_string(props, '$.k') AS k, json_extract_string(props, '$.missing') AS missing FROM {events}",
)
def json_path_text(t: Inputs):
    return t.events.select(
        "event_id",
        audit.json_path_text(F.col("props"), "k").alias("k"),
        audit.json_path_text(F.col("props"), "missing").alias("missing"),
    )


@query(
    "audit_new_value",
    """SELECT audit_id, coalesce(json_extract_string(changes, '$.status[1]'), json_extract_string(changes, '$.status')) AS status,
         json_extract_string(changes, '$.status[0]') AS old_status FROM {status_audits}""",
)
def audit_new_value(t: Inputs):
    changes = F.col("changes")
    return t.status_audits.select(
        "audit_id",
        audit.audit_new_value(changes, "status").alias("status"),
        audit.audit_old_value(changes, "status").alias("old_status"),
    )


@query(
    "rrule_fields",
    """SELECT audit_id, CASE WHEN rule LIKE '%WEEKLY%' THEN 'Weekly' WHEN rule LIKE '%DAILY%' THEN 'Daily' ELSE 'One Day' END AS frequency,
         nullif(split_part(split_part(rule || ';', 'BYDAY=', 2), ';', 1), '') AS weekdays,
         CASE WHEN rule LIKE '%UNTIL=%' THEN CAST(strptime(substring(rule, position('UNTIL=' IN rule) + 6, 8), '%Y%m%d') AS DATE) END AS until
       FROM (SELECT audit_id, coalesce(json_extract_string(changes, '$.rrule[1]'), json_extract_string(changes, '$.rrule'), '') AS rule
             FROM {deal_audits})""",
)
def rrule_fields(t: Inputs):
    rule = F.coalesce(audit.audit_new_value(F.col("changes"), "rrule"), F.lit(""))
    return t.deal_audits.select(
        "audit_id",
        audit.rrule_frequency(rule).alias("frequency"),
        audit.rrule_days(rule).alias("weekdays"),
        audit.rrule_until(rule).alias("until"),
    )


@query("null_if_blank", "SELECT p_partkey, nullif(replace(p_type, 'PROMO', ''), '') AS kind FROM {part}")
def null_if_blank(t: Inputs):
    return t.part.select("p_partkey", text.null_if_blank(F.replace("p_type", F.lit("PROMO"), F.lit(""))).alias("kind"))


@query(
    "text_to_number",
    """SELECT c_custkey, CASE WHEN length(split_part(c_name, '#', 2)) >= 9 THEN TRY_CAST(split_part(c_name, '#', 2) AS BIGINT) END AS number,
         TRY_CAST(c_mktsegment AS BIGINT) AS none FROM {customer}""",
)
def text_to_number(t: Inputs):
    digits = F.split_part("c_name", F.lit("#"), F.lit(2))
    return t.customer.select(
        "c_custkey",
        text.number_from_text(digits, 9).alias("number"),
        text.number_from_text(F.col("c_mktsegment")).alias("none"),
    )


@query(
    "date_truncate_parse",
    """SELECT event_id, CAST(ts AS DATE) AS day, CAST(date_trunc('week', ts) AS DATE) AS week, CAST(date_trunc('month', ts) AS DATE) AS month,
         CAST(strptime(strftime(ts, '%Y%m%d'), '%Y%m%d') AS DATE) AS parsed FROM {events}""",
)
def date_truncate_parse(t: Inputs):
    return t.events.select(
        "event_id",
        F.to_date("ts").alias("day"),
        F.trunc("ts", "week").alias("week"),
        F.trunc("ts", "month").alias("month"),
        F.to_date(F.date_format("ts", "yyyyMMdd"), "yyyyMMdd").alias("parsed"),
    )


@query(
    "date_arithmetic",
    """SELECT o_orderkey, CAST(o_orderdate AS DATE) + 1 AS next_day, CAST(CAST(o_orderdate AS DATE) - INTERVAL 3 MONTH AS DATE) AS back,
         CAST(CAST(o_orderdate AS DATE) + INTERVAL 1 YEAR AS DATE) AS next_year FROM {orders}""",
)
def date_arithmetic(t: Inputs):
    day = F.to_date("o_orderdate")
    return t.orders.select(
        "o_orderkey",
        F.date_add(day, 1).alias("next_day"),
        F.add_months(day, -3).alias("back"),
        F.add_months(day, 12).alias("next_year"),
    )


@query(
    "date_parts_labels",
    """SELECT o_orderkey, CAST(year(o_orderdate) AS INT) AS year, CAST(month(o_orderdate) AS INT) AS month, CAST(day(o_orderdate) AS INT) AS day,
         CAST(quarter(o_orderdate) AS INT) AS quarter, strftime(o_orderdate, '%b-%y') AS label FROM {orders}""",
)
def date_parts_labels(t: Inputs):
    day = F.col("o_orderdate")
    return t.orders.select(
        "o_orderkey",
        F.year(day).alias("year"),
        F.month(day).alias("month"),
        F.dayofmonth(day).alias("day"),
        F.quarter(day).alias("quarter"),
        dates.month_label(day).alias("label"),
    )


@query(
    "period_bounds",
    """SELECT as_of, CAST(date_trunc('quarter', as_of) - INTERVAL 3 MONTH AS DATE) AS quarter_start, CAST(date_trunc('quarter', as_of) AS DATE) AS quarter_end,
         CAST(date_trunc('month', as_of) - INTERVAL 2 MONTH AS DATE) AS two_month_start, CAST(date_trunc('month', as_of) - INTERVAL 1 MONTH AS DATE) AS month_start,
         CAST(date_trunc('month', as_of) AS DATE) AS month_end, CAST(date_trunc('year', as_of) - INTERVAL 1 YEAR AS DATE) AS year_start
       FROM (SELECT DISTINCT CAST(o_orderdate AS DATE) AS as_of FROM {orders})""",
)
def period_bounds(t: Inputs):
    day = F.col("as_of")
    return t.orders.select(F.to_date("o_orderdate").alias("as_of")).distinct().select(
        "as_of",
        dates.period_bounds(day, "Quarter")[0].alias("quarter_start"),
        dates.period_bounds(day, "Quarter")[1].alias("quarter_end"),
        dates.period_bounds(day, "Bi-Monthly")[0].alias("two_month_start"),
        dates.period_bounds(day, "Monthly")[0].alias("month_start"),
        dates.period_bounds(day, "Monthly")[1].alias("month_end"),
        dates.period_bounds(day, "Annual")[0].alias("year_start"),
    )


@query(
    "timezone_convert",
    f"""SELECT event_id, timezone('{TZ}', timezone('UTC', ts)) AS local_time,
          CAST(timezone('{TZ}', timezone('UTC', ts)) AS DATE) AS local_day,
          timezone('{TZ}', timezone('UTC', ts + INTERVAL 6 MONTH)) AS summer_time FROM {{events}}""",
)
def timezone_convert(t: Inputs):
    ts = F.col("ts")
    return t.events.select(
        "event_id",
        dates.local_time(ts, TZ).alias("local_time"),
        dates.local_date(ts, TZ).alias("local_day"),
        dates.local_time(ts + F.expr("INTERVAL 6 MONTH"), TZ).alias("summer_time"),
    )


@query(
    "iso_tail_timestamp",
    f"""SELECT event_id, timezone('{TZ}', timezone('UTC', ts)) AS local_time FROM {{events}}""",
)
def iso_tail_timestamp(t: Inputs):
    iso = F.concat(F.lit("position:1,timestamp:"), F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("Z"))
    shown = F.regexp_extract(iso, r"timestamp:(\S+)Z$", 1).try_cast("timestamp_ntz")
    return t.events.select("event_id", dates.local_time(shown, TZ).alias("local_time"))


@query(
    "math_basic",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, round(abs(-l_quantity * 1.5), 2) AS scaled,
         round(l_extendedprice * 100 / (l_extendedprice + 50), 6) AS pct, sign(l_discount - 0.05)::INT AS direction FROM {lineitem}""",
)
def math_basic(t: Inputs):
    price = F.col("l_extendedprice")
    return t.lineitem.select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        "l_suppkey",
        F.round(F.abs(-F.col("l_quantity") * 1.5), 2).alias("scaled"),
        (price * 100 / (price + 50)).alias("pct"),
        F.signum(F.col("l_discount") - 0.05).cast("int").alias("direction"),
    )


MILES_SQL = """round(3963.1676 * acos(greatest(-1.0, least(1.0,
  sin(round(warehouse_latitude, 5) / 57.29577951) * sin(round(latitude, 5) / 57.29577951)
  + cos(round(warehouse_latitude, 5) / 57.29577951) * cos(round(latitude, 5) / 57.29577951)
  * cos((round(warehouse_longitude, 5) - round(longitude, 5)) / 57.29577951)))), 1)"""


@query(
    "great_circle_miles",
    f"SELECT customer_id, {MILES_SQL} AS miles FROM {{route_customers}} JOIN {{geocodes}} USING (customer_id) JOIN {{warehouses}} USING (warehouse_id)",
)
def great_circle_miles(t: Inputs):
    placed = t.route_customers.join(t.geocodes, "customer_id").join(t.warehouses, "warehouse_id")
    return placed.select(
        "customer_id",
        geo.great_circle_miles(
            F.col("warehouse_latitude"), F.col("warehouse_longitude"), F.col("latitude"), F.col("longitude")
        ).alias("miles"),
    )
