"""Batch, calendar, consumption, dimension, unification and load queries."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import functions as F

from ..durable import shared_folder
from ..operators.days import days_between
from ..operators.incremental import newer_than
from ..plans import batches, consumption, dimensions, unify
from ..sources.tables import BY_SOURCE, BY_TIME, extract, full_refresh, read_days, reload_days
from .bindings import Tables
from .common import plain
from .sqlbase import day, num, with_views

BATCH, FIRST, LAST = "B2001", dt.date(2001, 1, 1), dt.date(2001, 3, 31)
SINCE = dt.date(1998, 5, 26)
RUN_TIME = "2002-01-01 00:00:00"


def _purchased(t: Tables):
    return batches.latest_price(t.bills, _lines(t), "PURCHASE")


def _recounted(t: Tables):
    return batches.latest_price(t.bills, _lines(t), "PICKING_MISTAKE", "IN_STORAGE")


def _lines(t: Tables):
    return t.bill_lines.select("bill_code", "goods_code", "price", "discount")


def _known(t: Tables):
    return batches.last_known_price(
        t.products, _purchased(t), _recounted(t), F.lit(RUN_TIME).cast("timestamp_ntz")
    )


def _candidates(t: Tables):
    return batches.candidate_goods(
        t.bills, t.bill_lines, t.orders, t.details, FIRST, LAST,
        t.counted.where("amount > 0").select("goods_code"),
    )


def _finance(t: Tables):
    bounds = t.read("lineitem").agg(
        F.to_date(F.min("l_shipdate")).alias("first"), F.to_date(F.max("l_shipdate")).alias("last")
    )
    return days_between(bounds).select(
        "date",
        F.trunc("date", "month").alias("begin_date"),
        F.year("date").alias("year"),
        F.date_format("date", "yyyy-MM").alias("fina_year_month"),
        F.date_format("date", "E").alias("weekday_name"),
    )


def _usage(t: Tables):
    return t.read("lineitem").selectExpr(
        "l_shipdate AS create_time", "l_suppkey AS station_code", "l_partkey AS cargo_code",
        "CAST(l_quantity AS INT) AS cargo_usage_amount",
        "CAST(l_extendedprice AS DECIMAL(12,2)) AS usage_money",
        "CASE WHEN l_returnflag = 'R' THEN -1 ELSE 1 END AS in_out_flag",
    )


def latest_price(t: Tables):
    return plain(_purchased(t))


def last_known_price(t: Tables):
    return plain(_known(t))


def new_batch(t: Tables):
    """Every good moved in the period that the batch lacks, priced as last known."""
    return plain(
        batches.new_batch(_candidates(t), _known(t), t.products, t.batches, "B2002", LAST)
    )


def new_batch_purchased(t: Tables):
    """The same from purchase prices only."""
    return plain(
        batches.new_batch(_candidates(t), _purchased(t), t.products, t.batches, BATCH, LAST)
    )


def fin_calendar(t: Tables):
    finance = _finance(t)
    return plain(batches.batch_numbers(batches.period_of(finance), finance, "COST"))


def daily_consumption(t: Tables):
    return plain(consumption.daily_consumption(_usage(t), _finance(t)))


def month_to_date(t: Tables):
    daily = consumption.daily_consumption(_usage(t), _finance(t))
    return plain(consumption.month_to_date(daily, _finance(t)))


def month_to_date_of_day(t: Tables):
    daily = consumption.daily_consumption(_usage(t), _finance(t))
    return plain(consumption.month_to_date_of(daily, dt.date(2000, 3, 1), dt.date(2000, 3, 20)))


def passenger_flow(t: Tables):
    events = t.read("events")
    newer = "event_type IN ('signup', 'error')"
    old, new = events.where(f"NOT {newer}"), events.where(newer)
    nation = t.read("customer")
    return plain(
        consumption.passenger_flow(
            stores=nation.selectExpr("c_custkey AS store_id", "c_name AS store_number"),
            notes=old.selectExpr(
                "event_id AS info_id", "user_id AS station_id", "ts AS record_date",
                "CASE WHEN value > 1 THEN 1 ELSE 0 END AS info_state",
            ),
            values=old.selectExpr(
                "event_id AS info_id", "'94' AS field_id", "CAST(floor(value) AS INT) AS info_value"
            ).unionByName(
                old.selectExpr("event_id AS info_id", "'95' AS field_id", "-1 AS info_value")
            ),
            station_codes=nation.selectExpr("c_name AS store_number", "c_custkey AS station_code"),
            bases=new.selectExpr(
                "event_id AS id", "ts AS start_date", "user_id AS station_code",
                "'DAY' AS log_type",
                "CASE WHEN value > 5 THEN 'SUBMIT' ELSE 'DRAFT' END AS log_status",
            ),
            fields=new.where("value > 20").selectExpr(
                "event_id AS info_base_id", "'passengerFlow' AS field_code",
                "CAST(CAST(floor(value) AS INT) AS STRING) AS field_value",
            ),
        )
    )


def product_wide(t: Tables):
    part, supplier = t.read("part"), t.read("supplier")
    return plain(
        dimensions.product_wide(
            skus=part.selectExpr(
                "p_partkey AS sku_code", "concat('b', p_partkey) AS bar_code", "p_name AS sku_name",
                "CAST(p_retailprice AS DECIMAL(12,2)) AS price", "p_partkey AS spu_code",
                "CASE WHEN p_size > 25 THEN 1 ELSE 0 END AS content_type",
            ),
            spus=part.selectExpr(
                "p_partkey AS spu_code", "CAST(substr(p_brand, 7) AS BIGINT) AS supplier_code",
                "p_type AS background_category_code", "p_brand AS territory_code",
                "p_type AS start_flow_location", "p_size AS goods_index", "p_brand AS spu_status",
                "CAST(make_date(1950 + p_size, 1, 1) AS TIMESTAMP_NTZ) AS create_time",
            ),
            spu_authors=t.read("lineitem").selectExpr(
                "l_partkey AS spu_code", "l_suppkey AS author_code"
            ),
            authors=supplier.selectExpr(
                "s_suppkey AS author_code",
                "CASE WHEN s_suppkey % 7 = 0 THEN NULL WHEN s_suppkey % 5 = 0 THEN 'Anon'"
                " ELSE s_name END AS author_name",
            ),
            suppliers=t.suppliers,
            categories=part.selectExpr(
                "p_type AS category_code", "lower(p_type) AS category_name"
            ).distinct(),
            territories=part.where("p_size > 49").selectExpr(
                "p_brand AS territory_code", "upper(p_brand) AS territory_name"
            ).distinct(),
            spu_brands=part.selectExpr(
                "p_partkey AS spu_code", "p_size AS brand_code", "p_name AS brand_line_name"
            ),
            brands=t.read("nation").selectExpr(
                "n_nationkey AS brand_code", "n_name AS brand_name"
            ),
        )
    )


def product_dimension(t: Tables):
    part = t.read("part").selectExpr(
        "*",
        "concat(lpad(CAST(p_size AS STRING), 2, '0'), lpad(substr(p_brand, 7), 2, '0'), '0301')"
        " AS code",
    )
    types = None
    for n in (2, 4, 8):
        level = part.selectExpr(f"left(code, {n}) AS h_type").distinct()
        types = level if types is None else types.unionByName(level)
    return plain(
        dimensions.product_dimension(
            part.selectExpr(
                "p_partkey AS h_id", "concat(p_name, '\\t\"', p_brand, '\\\\') AS h_name",
                "concat('I', p_partkey) AS h_isbn",
                "CAST(p_retailprice AS DECIMAL(12,2)) AS h_output_price",
                "CAST(substr(p_brand, 7) AS BIGINT) AS h_factory",
                "left(code, CASE p_type WHEN 'ECONOMY' THEN 8 WHEN 'SMALL' THEN 4"
                " WHEN 'MEDIUM' THEN 1 ELSE 6 END) AS h_type",
                "CAST(make_date(1975 + p_size, 1, 1) AS TIMESTAMP_NTZ) AS h_input_date",
            ),
            t.read("supplier").selectExpr("s_suppkey AS f_id", "s_name AS f_department"),
            types.withColumn("type_name", F.concat(F.lit("T"), "h_type")),
            dt.date(2002, 1, 1),
        )
    )


def station_dimension(t: Tables):
    return plain(
        dimensions.station_dimension(
            t.shops.drop("bookstore_system", "erp_date"),
            t.read("lineitem").selectExpr("l_suppkey AS station_code"),
            t.read("customer").where("c_acctbal > 0").selectExpr(
                "c_custkey AS new_station_code", "concat('L', c_custkey) AS logsystem_code",
                "upper(c_name) AS station_name_all",
            ),
        )
    )


def operator_dimension(t: Tables):
    return dimensions.operator_dimension(
        t.read("supplier").selectExpr("s_suppkey AS user_code", "s_name AS user_name"),
        t.read("customer").selectExpr("c_custkey AS user_code", "c_name AS user_name"),
    )


def _center_orders(t: Tables):
    return t.orders.where("sale_type <> 'F'").selectExpr(
        "*", "new_operator_code AS operator_code", "'DC' AS origin_system",
        "CAST(7 AS DECIMAL(18,2)) AS total_amount", "real_money AS total_money",
        "CASE left(sale_type_name, 1) WHEN '1' THEN '签售活动' WHEN '2' THEN '商场内书展A'"
        " WHEN '3' THEN '商场外书展B' END AS memo",
    )


def _erp_orders(t: Tables):
    return t.orders.where("sale_type = 'F'").selectExpr(
        "*", "CAST(5 AS DECIMAL(18,2)) AS total_amount", "real_money AS total_money",
        "'m' AS memo", "concat('s', id) AS source_code", "'b' AS batch_code",
        "CASE left(sale_type_name, 1) WHEN '4' THEN 'OPEN' ELSE 'DONE' END AS sale_order_state",
        "CASE left(sale_type_name, 1) WHEN '5' THEN 'YH' ELSE 'APP' END AS source",
    )


def _order_lines(t: Tables):
    return t.read("lineitem").selectExpr(
        "l_orderkey * 10 + l_linenumber AS id", "l_orderkey AS sale_order_code",
        "l_partkey AS goods_code", "l_partkey AS product_code", "'n' AS product_name",
        "l_returnflag AS product_type", "CAST(l_quantity AS INT) AS sale_amount",
        "CAST(0 AS DECIMAL(18,2)) AS return_amount",
        "CAST(l_discount AS DECIMAL(3,2)) AS sale_discount",
        "CAST(l_extendedprice AS DECIMAL(12,2)) AS sale_price",
        "CAST(l_extendedprice AS DECIMAL(12,2)) AS sale_real_price",
        "CAST(1 AS DECIMAL(18,2)) AS sale_real_money", "CAST(2 AS DECIMAL(18,2)) AS sale_money",
        "CAST(3 AS DECIMAL(18,2)) AS balance", "l_linenumber AS pay_method_code",
        "l_linestatus AS pay_method_name", "CAST(-l_extendedprice AS DECIMAL(12,2)) AS pay_money",
        "CAST(l_tax AS DECIMAL(3,2)) AS actual_money", "l_shipdate AS pay_date",
        "'DC' AS origin_system",
    )


def _loaded(t: Tables):
    return t.read("customer").selectExpr("'DC' AS origin_system", "c_custkey * 10 AS id")


def unified_orders(t: Tables):
    return plain(unify.unified_orders(_center_orders(t), _erp_orders(t), t.shops))


def unified_details(t: Tables):
    lines = _order_lines(t)
    return plain(
        unify.unified_details(
            lines, _center_orders(t), lines.drop("origin_system"), _erp_orders(t), t.shops,
            _loaded(t), SINCE,
        )
    )


def unified_payments(t: Tables):
    lines = _order_lines(t)
    return plain(
        unify.unified_payments(
            lines, _center_orders(t), lines.drop("origin_system"), _erp_orders(t), t.shops,
            _loaded(t), SINCE,
        )
    )


def unified_wholesale(t: Tables):
    bills = t.wholesale_bills
    loaded = t.read("customer").selectExpr(
        "'ERP' AS origin_system", "'SELL' AS origin_bill_type", "'OUT' AS bill_type",
        "c_custkey AS id",
    )
    return plain(
        unify.unified_wholesale(
            [
                (bills.where("bill_type <> 'OTHER'"), "SELL", "ERP"),
                (bills.where("bill_type = 'OTHER'").drop("own_station_code"), "WHOLESALE", "DC"),
            ],
            loaded,
        )
    )


def cleaned_bills(t: Tables):
    names = t.read("supplier").selectExpr("s_suppkey AS old", "s_suppkey + 100000 AS new")
    return plain(
        unify.cleaned_bills(t.bills, names, SINCE).drop("update_time", "stock_date")
    )


def cleaned_bill_details(t: Tables):
    names = t.read("region").selectExpr("left(r_name, 1) AS old", "r_name AS new")
    return plain(unify.cleaned_bill_details(t.bill_lines, t.bills, names, SINCE))


def cleaned_orders(t: Tables):
    orders = t.orders.selectExpr(
        "sale_order_code", "station_code", "sale_order_type", "-real_money AS real_money",
        "-real_money AS total_money", "create_time",
        "concat(CASE WHEN sale_type = 'P' THEN 'RETAIL' ELSE 'm' END, station_code) AS member_code",
    )
    names = t.read("supplier").selectExpr("s_suppkey AS old", "s_suppkey + 100000 AS new")
    return plain(
        unify.cleaned_orders(orders, names, SINCE).unionByName(
            unify.cleaned_orders(orders, names, origin="YH")
        )
    )


def cleaned_order_details(t: Tables):
    names = t.read("region").selectExpr("left(r_name, 1) AS old", "r_name AS new")
    lines = _order_lines(t).selectExpr(
        "id", "sale_order_code", "goods_code", "-sale_amount AS sale_amount", "sale_discount",
        "-sale_price AS sale_price", "sale_real_price", "product_type AS storage_code",
    )
    return plain(unify.cleaned_order_details(lines, t.orders, names, SINCE))


def incremental_by_id(t: Tables):
    source = t.read("orders").selectExpr("o_orderkey AS id", "o_orderstatus AS status")
    return newer_than(source, t.read("customer").selectExpr("c_custkey AS id"), "id")


def incremental_by_text_id(t: Tables):
    source = t.read("orders").selectExpr("CAST(o_orderkey AS STRING) AS id")
    target = t.read("customer").selectExpr("CAST(c_custkey AS STRING) AS id")
    return newer_than(source, target, "id")


def incremental_by_time(t: Tables):
    source = t.read("lineitem").selectExpr(
        "l_shipdate AS create_time", "l_orderkey", "l_linenumber", "l_partkey"
    )
    target = t.read("orders").selectExpr("o_orderdate AS create_time")
    return plain(
        extract(source, target, BY_TIME, "create_time", floor=dt.datetime(1990, 12, 31))
    )


def hwm_by_source(t: Tables):
    source = t.read("orders").selectExpr(
        "o_orderstatus AS origin_system", "o_orderkey AS id", "o_orderpriority AS kind"
    )
    target = t.read("lineitem").selectExpr("l_linestatus AS origin_system", "l_suppkey AS id")
    return extract(source, target, BY_SOURCE)


def day_reload(t: Tables):
    """Load all days, reload the busy ones of a range, which empties its others, and read back."""
    path = f"{shared_folder(t.spark)}/day-reload-{uuid.uuid4().hex}"
    rows = t.read("events").select(
        F.to_date("ts").alias("date"), "event_id", F.col("value").cast("decimal(12,2)").alias("value")
    )
    reload_days(rows, path)
    busy = (
        t.read("events")
        .where("value > 300 AND day(ts) % 4 <> 0")
        .select(F.to_date("ts").alias("date"))
        .distinct()
    )
    again = rows.join(busy, "date", "left_semi").withColumn(
        "value", (F.col("value") * 2).cast("decimal(12,2)")
    )
    reload_days(again, path, dt.date(2024, 1, 8), dt.date(2024, 1, 31))
    return plain(read_days(t.spark, path, dt.date(2024, 1, 5), dt.date(2024, 1, 25)))


def table_refresh(t: Tables):
    """Load a table twice; the second load replaces the first."""
    path = f"{shared_folder(t.spark)}/refresh-{uuid.uuid4().hex}"
    full_refresh(t.suppliers, path)
    full_refresh(extract(t.read("customer"), None, "full", columns=["c_custkey", "c_name"]), path)
    return t.spark.read.parquet(path)


QUERIES = {
    f.__name__: f
    for f in (
        latest_price, last_known_price, new_batch, new_batch_purchased, fin_calendar,
        daily_consumption, month_to_date, month_to_date_of_day, passenger_flow, product_wide,
        product_dimension, station_dimension, operator_dimension, unified_orders, unified_details,
        unified_payments, unified_wholesale, cleaned_bills, cleaned_bill_details,
        cleaned_orders, cleaned_order_details,
        incremental_by_id, incremental_by_text_id, incremental_by_time, hwm_by_source, day_reload,
        table_refresh,
    )
}

_P = "CAST(price * discount AS DECIMAL(18,4))"
_PRICES = f"""
  , lp AS (SELECT goods_code, max(create_time) AS t, arg_max({_P}, (create_time, {_P})) AS p
    FROM bill_lines JOIN bills USING (bill_code) WHERE bill_type = 'PURCHASE' GROUP BY 1),
  pm AS (SELECT goods_code, max(create_time) AS t, arg_max({_P}, (create_time, {_P})) AS p
    FROM bill_lines JOIN bills USING (bill_code) WHERE bill_type = 'PICKING_MISTAKE' AND bill_purpose = 'IN_STORAGE' GROUP BY 1),
  lk AS (SELECT product_code AS goods_code, coalesce(lp.t, pm.t, TIMESTAMP '{RUN_TIME}') AS t,
      coalesce(lp.p, pm.p, CAST(product_price * CAST('0.62' AS DECIMAL(3,2)) AS DECIMAL(18,4))) AS p
    FROM products LEFT JOIN lp ON lp.goods_code = product_code LEFT JOIN pm ON pm.goods_code = product_code)"""


def _new_batch(batch: str, prices: str) -> str:
    return f"""{_PRICES}, g AS (
      SELECT goods_code FROM counted WHERE amount > 0
      UNION SELECT goods_code FROM bill_lines JOIN bills USING (bill_code)
        WHERE create_time >= TIMESTAMP '{FIRST}' AND create_time < TIMESTAMP '{LAST}' + INTERVAL 1 DAY
      UNION SELECT product_code FROM sale_detail JOIN sale_order USING (sale_order_code)
        WHERE create_time >= TIMESTAMP '{FIRST}' AND create_time < TIMESTAMP '{LAST}' + INTERVAL 1 DAY)
      SELECT (SELECT max(batch_id) FROM batch) + row_number() OVER (ORDER BY g.goods_code) AS batch_id, '{batch}' AS batch_no,
        c.supplier_code, c.supplier_name, g.goods_code, c.product_name AS goods_name, 0 AS amount,
        {num('x.p', 'cost_price')}, '{LAST}' AS create_time
      FROM g JOIN {prices} x ON x.goods_code = g.goods_code JOIN products c ON c.product_code = g.goods_code
      WHERE g.goods_code NOT IN (SELECT goods_code FROM batch WHERE batch_no = '{batch}')"""


_DAYS = """
  f AS (SELECT CAST(d AS DATE) AS date, CAST(date_trunc('month', d) AS DATE) AS begin_date FROM
    (SELECT unnest(range(min(l_shipdate), max(l_shipdate) + INTERVAL 1 DAY, INTERVAL 1 DAY)) AS d FROM lineitem))"""
_USED = """
  u AS (SELECT CAST(l_shipdate AS DATE) AS d, l_suppkey AS s, l_partkey AS c,
      sum(CAST(l_quantity AS INTEGER) * CASE WHEN l_returnflag = 'R' THEN -1 ELSE 1 END) AS n,
      sum(CAST(l_extendedprice AS DECIMAL(12,2)) * CASE WHEN l_returnflag = 'R' THEN -1 ELSE 1 END) AS m
    FROM lineitem GROUP BY 1, 2, 3)"""
_CODE = "(lpad(CAST(p_size AS VARCHAR), 2, '0') || lpad(substr(p_brand, 7), 2, '0') || '0301')"
_TIME = "strftime({0}, '%Y-%m-%d %H:%M:%S')"
_CENTER = "sale_type <> 'F'"
_ERP = "sale_type = 'F' AND left(sale_type_name, 1) NOT IN ('4', '5')"
_LINES = """
  ol AS (SELECT l_orderkey * 10 + l_linenumber AS id, l_orderkey AS sale_order_code, l_partkey AS product_code,
      l_returnflag AS product_type, CAST(l_quantity AS INTEGER) AS n, CAST(l_discount AS DECIMAL(3,2)) AS disc,
      CAST(l_extendedprice AS DECIMAL(12,2)) AS p, l_linenumber, l_linestatus, CAST(l_tax AS DECIMAL(3,2)) AS tax, l_shipdate
    FROM lineitem),
  co AS (SELECT o.* FROM sale_order o JOIN shops s ON o.station_code = s.new_station_code AND s.bookstore_system = 'YH'
    WHERE sale_type <> 'F' AND create_time >= TIMESTAMP '1998-05-26'),
  eo AS (SELECT * FROM sale_order WHERE sale_type = 'F' AND left(sale_type_name, 1) NOT IN ('4', '5')),
  mk AS (SELECT max(c_custkey) * 10 AS m FROM customer)"""

SQL = {
    "latest_price": with_views("bills", "bill_lines", "products", body=f"""
        {_PRICES} SELECT goods_code, {_TIME.format('t')} AS last_time, {num('p', 'cost_price')} FROM lp"""),
    "last_known_price": with_views("bills", "bill_lines", "products", body=f"""
        {_PRICES} SELECT goods_code, {_TIME.format('t')} AS last_time, {num('p', 'cost_price')} FROM lk"""),
    "new_batch": with_views("bills", "bill_lines", "products", "counted", "sale_order", "sale_detail", "batch",
        body=_new_batch("B2002", "lk")),
    "new_batch_purchased": with_views("bills", "bill_lines", "products", "counted", "sale_order", "sale_detail", "batch",
        body=_new_batch(BATCH, "lp")),
    "fin_calendar": f"""WITH {_DAYS}
        SELECT {day('a', 'a')}, {day('b', 'b')},
          'COST' || strftime(CASE WHEN a IN (SELECT begin_date FROM f) THEN a ELSE b END, '%Y%m%d') AS bn
        FROM (SELECT x.date AS a, CASE WHEN x.date = x.begin_date THEN
            (SELECT y.begin_date FROM f y WHERE y.date = x.date - 1) ELSE x.begin_date END AS b FROM f x)""",
    "daily_consumption": f"""WITH {_USED}
        SELECT {day('d', 'create_time')}, s AS station_code, c AS cargo_code, CAST(n AS BIGINT) AS dailyusage_amount,
          {num('m', 'dailyusage_money')}, CAST(year(d) AS INTEGER) AS create_time_year, strftime(d, '%Y-%m') AS yearmonth,
          strftime(d, '%a') AS create_time_week FROM u""",
    "month_to_date": f"""WITH {_USED}
        SELECT {day('d', 'create_time')}, s AS station_code, c AS cargo_code, CAST(n AS BIGINT) AS dailyusage_amount,
          CAST(sum(n) OVER (PARTITION BY s, c, date_trunc('month', d) ORDER BY d) AS BIGINT) AS monthlyaccumulationusage_amount
        FROM u""",
    "month_to_date_of_day": f"""WITH {_USED}
        SELECT '2000-03-20' AS create_time, s AS station_code, c AS cargo_code,
          CAST(coalesce(sum(n) FILTER (WHERE d = DATE '2000-03-20'), 0) AS BIGINT) AS dailyusage_amount,
          CAST(sum(n) AS BIGINT) AS monthlyaccumulationusage_amount
        FROM u WHERE d BETWEEN DATE '2000-03-01' AND DATE '2000-03-20' GROUP BY s, c""",
    "passenger_flow": f"""
        SELECT {day('ts', 'create_time')}, user_id AS station_code, CAST(CAST(floor(value) AS INTEGER) AS VARCHAR) AS passenger_flow
        FROM events JOIN customer ON c_custkey = user_id WHERE event_type NOT IN ('signup', 'error') AND value > 1
        UNION ALL
        SELECT {day('ts', 'create_time')}, user_id, CASE WHEN value > 20 THEN CAST(CAST(floor(value) AS INTEGER) AS VARCHAR) END
        FROM events WHERE event_type IN ('signup', 'error') AND value > 5""",
    "product_wide": f"""
        WITH w AS (SELECT s_suppkey, CASE WHEN s_suppkey % 7 = 0 THEN NULL WHEN s_suppkey % 5 = 0 THEN 'Anon'
          ELSE s_name END AS author_name FROM supplier),
        a AS (SELECT l_partkey AS k, string_agg(author_name, ',' ORDER BY author_name) AS author_name
          FROM lineitem JOIN w ON s_suppkey = l_suppkey GROUP BY 1),
        te AS (SELECT DISTINCT p_brand AS b FROM part WHERE p_size > 49),
        p AS (SELECT *, CASE WHEN p_size > 25 THEN te.b ELSE p_type END AS code FROM part LEFT JOIN te ON te.b = p_brand)
        SELECT p_partkey AS sku_code, 'b' || p_partkey AS bar_code, p_name AS sku_name,
          {num('CAST(p_retailprice AS DECIMAL(12,2))', 'price')}, CASE WHEN p_size > 25 THEN 1 ELSE 0 END AS content_type,
          left(code, 2) AS first_classification_code, left(code, 4) AS second_classification_code,
          left(code, 6) AS third_classification_code, code AS fourth_classification_code,
          CASE WHEN p_size > 25 THEN upper(b) ELSE lower(p_type) END AS classification_name,
          CAST(substr(p_brand, 7) AS BIGINT) AS supplier_code, s.s_name AS supplier_name, a.author_name,
          p_type AS start_flow_location, p_size AS goods_index, p_brand AS spu_status,
          (1950 + p_size) || '-01-01' AS create_time, p_size AS brand_code, n_name AS brand_name, p_name AS brand_line_name
        FROM p LEFT JOIN a ON a.k = p_partkey JOIN supplier s ON s.s_suppkey = CAST(substr(p_brand, 7) AS BIGINT)
        LEFT JOIN nation ON n_nationkey = p_size""",
    "product_dimension": f"""
        WITH p AS (SELECT *, left({_CODE}, CASE p_type WHEN 'ECONOMY' THEN 8 WHEN 'SMALL' THEN 4 WHEN 'MEDIUM' THEN 1 ELSE 6 END) AS h
          FROM part),
        q AS (SELECT *, CASE WHEN length(h) >= 2 THEN left(h, 2) END AS c2, CASE WHEN length(h) >= 4 THEN left(h, 4) END AS c4,
          CASE WHEN length(h) >= 6 THEN left(h, 6) END AS c6, CASE WHEN length(h) > 6 THEN h END AS c8 FROM p)
        SELECT (1975 + p_size) || '-01-01 00:00:00' AS create_time, p_partkey AS product_code, p_name || p_brand AS product_name,
          'I' || p_partkey AS product_isbn, {num('CAST(p_retailprice AS DECIMAL(12,2))', 'product_price')},
          CAST(substr(p_brand, 7) AS BIGINT) AS supplier_code, s_name AS supplier_name,
          CASE WHEN left(h, 2) = '13' THEN 'BA' ELSE 'BK' END AS category_one_code,
          CASE WHEN left(h, 2) = '13' THEN '文创' ELSE '出版物' END AS category_one_name,
          c2 AS category_two_code, 'T' || c2 AS category_two_name, c4 AS category_three_code, 'T' || c4 AS category_three_name,
          c6 AS category_four_code, CAST(NULL AS VARCHAR) AS category_four_name, c8 AS category_five_code, 'T' || c8 AS category_five_name,
          CASE WHEN c6 = '130503' THEN '3-植物' WHEN c2 = '13' AND c6 <> '130503' THEN '4-不二生活' WHEN c2 = '15' THEN '5-特殊商品'
            WHEN c2 IN ('14', '22') THEN '2-期刊&电子出版物' ELSE '1-图书' END AS fina_category_name,
          CASE WHEN 1975 + p_size = 2001 THEN '新品' ELSE '老品' END AS product_state
        FROM q LEFT JOIN supplier ON s_suppkey = CAST(substr(p_brand, 7) AS BIGINT)""",
    "station_dimension": with_views("shops", body="""
        SELECT s.* EXCLUDE (bookstore_system, erp_date), 'L' || c_custkey AS logsystem_code, upper(c_name) AS station_name_all,
          CASE WHEN b.k IS NULL THEN 'YH' ELSE 'ERP' END AS bookstore_system
        FROM shops s JOIN customer ON c_custkey = s.new_station_code AND c_acctbal > 0
        LEFT JOIN (SELECT DISTINCT l_suppkey AS k FROM lineitem) b ON b.k = s.new_station_code"""),
    "operator_dimension": """
        SELECT s_suppkey AS user_code, s_name AS user_name FROM supplier
        UNION ALL SELECT c_custkey, c_name FROM customer WHERE c_custkey NOT IN (SELECT s_suppkey FROM supplier)""",
    "unified_orders": with_views("sale_order", "shops", body=f"""
        SELECT id AS sale_order_id, sale_order_code, member_code, station_code, CAST(7 AS DOUBLE) AS total_amount,
          {num('real_money', 'total_money')}, {num('real_money', 'real_money')},
          CASE left(sale_type_name, 1) WHEN '1' THEN '签售活动' WHEN '2' THEN '商场内书展A' WHEN '3' THEN '商场外书展B' END AS memo,
          'DONE' AS sale_order_state, NULL AS source_code, new_operator_code, {_TIME.format('create_time')} AS create_time,
          CASE left(sale_type_name, 1) WHEN '1' THEN 'CHECK_SALES' WHEN '2' THEN 'SHOP_INSIDE' WHEN '3' THEN 'SHOP_OUTER' ELSE 'BOOK_SALES' END AS sale_type,
          CASE left(sale_type_name, 1) WHEN '1' THEN '签售' WHEN '2' THEN '商场内书展' WHEN '3' THEN '商场外书展' ELSE '正常零售' END AS sale_type_name,
          sale_order_type, in_out_flag, member_type, NULL AS batch_code, 'DC' AS origin_system
        FROM sale_order JOIN shops ON station_code = new_station_code AND bookstore_system = 'YH' WHERE {_CENTER}
        UNION ALL
        SELECT id, sale_order_code, member_code, station_code, 5, CAST(real_money AS DOUBLE), CAST(real_money AS DOUBLE), 'm', 'DONE',
          's' || id, new_operator_code, {_TIME.format('create_time')}, sale_type, sale_type_name, sale_order_type, in_out_flag,
          member_type, 'b', 'ERP' FROM sale_order WHERE {_ERP}"""),
    "unified_details": with_views("sale_order", "shops", body=f""", {_LINES}
        SELECT ol.id, ol.sale_order_code, product_code, NULL AS product_name, 'SALE_SELL' AS product_type, CAST(n AS DOUBLE) AS sale_amount,
          CAST(NULL AS DOUBLE) AS return_amount, {num('disc', 'sale_discount')}, {num('p', 'sale_price')}, {num('p', 'sale_real_price')},
          {num('n * p * disc', 'sale_real_money')}, {num('n * p', 'sale_money')}, co.id AS sale_order_id, 'DC' AS origin_system
        FROM ol JOIN co USING (sale_order_code) WHERE ol.id > (SELECT m FROM mk)
        UNION ALL
        SELECT ol.id, ol.sale_order_code, product_code, 'n', product_type, n, 0, CAST(disc AS DOUBLE), CAST(p AS DOUBLE), CAST(p AS DOUBLE),
          1, 2, eo.id, 'ERP' FROM ol JOIN eo USING (sale_order_code) WHERE ol.id > 0"""),
    "unified_payments": with_views("sale_order", "shops", body=f""", {_LINES}
        SELECT ol.id, ol.sale_order_code, CAST(NULL AS DOUBLE) AS balance, CAST(l_linenumber AS BIGINT) AS pay_method_code,
          NULL AS pay_method_name, CAST(-p AS DOUBLE) AS pay_money, CAST(-p AS DOUBLE) AS actual_money,
          {_TIME.format('co.create_time')} AS pay_date, co.id AS sale_order_id, 'DC' AS origin_system
        FROM ol JOIN co USING (sale_order_code) WHERE ol.id > (SELECT m FROM mk)
        UNION ALL
        SELECT ol.id, ol.sale_order_code, 3, l_linenumber, l_linestatus, CAST(p AS DOUBLE), CAST(tax AS DOUBLE),
          {_TIME.format('l_shipdate')}, eo.id, 'ERP' FROM ol JOIN eo USING (sale_order_code) WHERE ol.id > 0"""),
    "unified_wholesale": f"""
        SELECT o_orderkey AS id, o_orderkey AS code, CASE WHEN o_orderstatus <> 'P' THEN o_custkey END AS own_station_code,
          CASE o_orderstatus WHEN 'O' THEN 'OUT' WHEN 'F' THEN 'IN' ELSE 'OTHER' END AS bill_type,
          {_TIME.format('o_orderdate')} AS create_time, CASE WHEN o_orderstatus = 'P' THEN 'WHOLESALE' ELSE 'SELL' END AS origin_bill_type,
          CASE WHEN o_orderstatus = 'P' THEN 'DC' ELSE 'ERP' END AS origin_system
        FROM orders WHERE o_orderkey > CASE WHEN o_orderstatus = 'O' THEN (SELECT max(c_custkey) FROM customer) ELSE 0 END""",
    "cleaned_bills": with_views("bills", body=f"""
        SELECT id, bill_code, bill_type, bill_purpose,
          CASE WHEN in_station_code IN (SELECT s_suppkey FROM supplier) THEN in_station_code + 100000 ELSE in_station_code END AS in_station_code,
          CASE WHEN out_station_code IN (SELECT s_suppkey FROM supplier) THEN out_station_code + 100000 ELSE out_station_code END AS out_station_code,
          {num('abs(total_money)', 'total_money')}, {_TIME.format('create_time')} AS create_time, 'DC' AS origin_system
        FROM bills WHERE create_time >= TIMESTAMP '{SINCE}'"""),
    "cleaned_bill_details": with_views("bills", "bill_lines", body=f"""
        SELECT bill_code, goods_code, abs(actual_total_amount) AS actual_total_amount, abs(actual_total_amount) AS shipped_total_amount,
          {num('abs(price)', 'price')}, {num('abs(discount)', 'discount')}, in_storage_code,
          CASE WHEN out_storage_code = 'A' THEN 'AFRICA' ELSE out_storage_code END AS out_storage_code, 'DC' AS origin_system
        FROM bill_lines JOIN bills USING (bill_code) WHERE create_time >= TIMESTAMP '{SINCE}'"""),
    "cleaned_orders": with_views("sale_order", body=f"""
        , o AS (SELECT *, CASE WHEN station_code IN (SELECT s_suppkey FROM supplier) THEN station_code + 100000 ELSE station_code END AS s
          FROM sale_order)
        SELECT sale_order_code, s AS station_code, sale_order_type, {num('real_money', 'real_money')},
          {num('real_money', 'total_money')}, {_TIME.format('create_time')} AS create_time,
          CASE WHEN sale_type = 'P' THEN 'RETAIL' ELSE 'm' END || station_code AS member_code, 'DC' AS origin_system
        FROM o WHERE create_time >= TIMESTAMP '{SINCE}'
        UNION ALL
        SELECT sale_order_code, s, sale_order_type, CAST(-real_money AS DOUBLE), CAST(real_money AS DOUBLE),
          {_TIME.format('create_time')}, CASE WHEN sale_type <> 'P' THEN 'm' || station_code END, 'YH' FROM o"""),
    "cleaned_order_details": with_views("sale_order", body=f"""
        SELECT l_orderkey * 10 + l_linenumber AS id, l_orderkey AS sale_order_code, l_partkey AS goods_code,
          CAST(l_quantity AS INTEGER) AS sale_amount, {num('CAST(l_discount AS DECIMAL(3,2))', 'sale_discount')},
          {num('CAST(l_extendedprice AS DECIMAL(12,2))', 'sale_price')},
          {num('CAST(l_extendedprice AS DECIMAL(12,2))', 'sale_real_price')},
          CASE WHEN l_returnflag = 'A' THEN 'AFRICA' ELSE l_returnflag END AS storage_code, 'DC' AS origin_system
        FROM lineitem JOIN sale_order ON sale_order_code = l_orderkey AND create_time >= TIMESTAMP '{SINCE}'"""),
    "incremental_by_id": """
        SELECT o_orderkey AS id, o_orderstatus AS status FROM orders WHERE o_orderkey > (SELECT max(c_custkey) FROM customer)""",
    "incremental_by_text_id": """
        SELECT CAST(o_orderkey AS VARCHAR) AS id FROM orders WHERE o_orderkey > (SELECT max(c_custkey) FROM customer)""",
    "incremental_by_time": f"""
        SELECT {_TIME.format('l_shipdate')} AS create_time, l_orderkey, l_linenumber, l_partkey FROM lineitem
        WHERE l_shipdate > (SELECT max(o_orderdate) FROM orders)""",
    "hwm_by_source": """
        SELECT o_orderstatus AS origin_system, o_orderkey AS id, o_orderpriority AS kind FROM orders
        LEFT JOIN (SELECT l_linestatus AS s, max(l_suppkey) AS m FROM lineitem GROUP BY 1) ON s = o_orderstatus
        WHERE o_orderkey > coalesce(m, 0)""",
    "day_reload": f"""
        SELECT {day('ts', 'date')}, event_id,
          CAST(CAST(value AS DECIMAL(12,2)) * CASE WHEN CAST(ts AS DATE) < DATE '2024-01-08' THEN 1 ELSE 2 END AS DOUBLE) AS value
        FROM events WHERE CAST(ts AS DATE) BETWEEN DATE '2024-01-05' AND DATE '2024-01-25'
          AND (CAST(ts AS DATE) < DATE '2024-01-08' OR CAST(ts AS DATE) IN
            (SELECT CAST(ts AS DATE) FROM events WHERE value > 300 AND day(ts) % 4 <> 0))""",
    "table_refresh": "SELECT c_custkey, c_name FROM customer",
}
