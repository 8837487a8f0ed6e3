"""The driver's tables seen as warehouse, card, log and pipeline inputs.

Every frame here is a projection or a plain aggregate of whole tables.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.loglines import START_PHRASES
from ..session import tune

MARKER = "[nightly]"
BILL_TYPES = {
    1: "PURCHASE", 2: "RETURNED", 3: "SALE", 4: "BATCH_SALE", 5: "PRESENT", 6: "DELIVERY",
    7: "ADJUST",
}
SEGMENTS = {
    "BUILDING": "BOOKSTORE", "FURNITURE": "CAFE", "MACHINERY": "LOGISTICS",
    "HOUSEHOLD": "WHOLESALE", "AUTOMOBILE": "SUPPLIER",
}
REGIONS = {
    "AFRICA": "LOGISTICS", "AMERICA": "BOOKSTORE", "ASIA": "BOOKSTORE", "EUROPE": "CAFE",
    "MIDDLE EAST": "WHOLESALE",
}
TRADES = {
    "purchase": "Recharge", "view": "CardConsume", "click": "CardConsumeRefund",
    "error": "RechargeRollback", "signup": "Consume",
}


class Tables:
    def __init__(self, spark: SparkSession, folder: str):
        self.spark = tune(spark)
        self.folder = folder.rstrip("/")

    def read(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    # ---- dimensions -------------------------------------------------------------------

    @cached_property
    def products(self) -> DataFrame:
        return self.read("part").selectExpr(
            "p_partkey AS product_code", "p_name AS product_name",
            "concat('I', p_partkey) AS product_isbn",
            "CAST(p_retailprice AS DECIMAL(12,2)) AS product_price",
            "lpad(CAST(p_size AS STRING), 2, '0') AS category_two_code",
            "p_type AS category_two_name",
            "concat(lpad(CAST(p_size AS STRING), 2, '0'), lpad(substr(p_brand, 7), 2, '0'))"
            " AS category_three_code",
            "p_brand AS category_three_name",
            "concat(lpad(CAST(p_size AS STRING), 2, '0'), lpad(substr(p_brand, 7), 2, '0'), '03')"
            " AS category_four_code",
            "concat('S', p_size) AS category_four_name",
            "concat(p_size, left(p_type, 1)) AS category_five_code",
            "concat(p_type, '/', p_size) AS category_five_name",
            "left(p_type, 2) AS fina_category_code", "p_type AS fina_category_name",
            "CAST(substr(p_brand, 7) AS BIGINT) AS supplier_code",
            "concat('S', substr(p_brand, 7)) AS supplier_name",
            "CASE WHEN p_size > 25 THEN '新品' ELSE '老品' END AS product_state",
        )

    def _places(self, rows: DataFrame) -> DataFrame:
        nation = self.read("nation").join(
            self.read("region"), F.col("n_regionkey") == F.col("r_regionkey")
        )
        return rows.join(nation, F.col("nation") == F.col("n_nationkey")).select(
            "new_station_code", "new_station_name",
            F.col("n_regionkey").alias("station_region_code"),
            F.col("r_name").alias("station_region_name"),
            F.col("n_nationkey").cast("bigint").alias("logistic_code"),
            F.col("n_name").alias("logistics_name"),
            "r_name", "segment", "balance",
        )

    @cached_property
    def shops(self) -> DataFrame:
        """Customers as stations."""
        kind = F.element_at(F.create_map(*[F.lit(x) for p in SEGMENTS.items() for x in p]), F.col("segment"))
        rows = self.read("customer").selectExpr(
            "c_custkey AS new_station_code", "c_name AS new_station_name",
            "c_nationkey AS nation", "c_mktsegment AS segment", "c_acctbal AS balance",
        )
        return self._places(rows).select(
            "*",
            kind.alias("category_code"),
            F.col("segment").alias("category_name"),
            F.expr(
                "CASE WHEN segment IN ('BUILDING','FURNITURE') THEN 'BOOKSTORE'"
                " WHEN segment IN ('MACHINERY','HOUSEHOLD') THEN 'LOGISTICS' ELSE 'OTHER' END"
            ).alias("category_code_flow"),
            F.expr(
                "CASE WHEN balance > 0 THEN DATE'2002-01-01' ELSE DATE'1998-01-01' END"
            ).alias("erp_date"),
            F.expr("CASE WHEN balance > 0 THEN 'YH' ELSE 'ERP' END").alias("bookstore_system"),
        ).drop("r_name", "segment", "balance")

    @cached_property
    def depots(self) -> DataFrame:
        """Suppliers as the stations of the stock ledger."""
        kind = F.element_at(F.create_map(*[F.lit(x) for p in REGIONS.items() for x in p]), F.col("r_name"))
        rows = self.read("supplier").selectExpr(
            "s_suppkey AS new_station_code", "s_name AS new_station_name",
            "s_nationkey AS nation", "'x' AS segment", "s_acctbal AS balance",
        )
        return self._places(rows).select(
            "*",
            kind.alias("category_code"),
            F.col("r_name").alias("category_name"),
            F.expr(
                "CASE WHEN r_name IN ('AMERICA','ASIA') THEN 'BOOKSTORE'"
                " WHEN r_name = 'AFRICA' THEN 'LOGISTICS' ELSE 'OTHER' END"
            ).alias("category_code_flow"),
            F.expr("CASE WHEN balance > 3000 THEN 'YH' ELSE 'ERP' END").alias("bookstore_system"),
        ).drop("r_name", "segment", "balance")

    @cached_property
    def suppliers(self) -> DataFrame:
        return self.read("supplier").selectExpr(
            "s_suppkey AS supplier_code", "s_name AS supplier_name"
        )

    @cached_property
    def pay_methods(self) -> DataFrame:
        """Nations as payment methods, told apart by their region."""
        return self.read("nation").selectExpr(
            "n_nationkey AS pay_method_code", "n_name AS pay_method_name",
            "CASE WHEN n_regionkey <= 2 THEN '1' ELSE '0' END AS count_in_retail",
            "CASE WHEN n_regionkey = 3 THEN '1' ELSE '0' END AS count_in_card_pickup",
            "CASE WHEN n_regionkey = 2 THEN '1' ELSE '0' END AS count_in_other_pickup",
            "CASE WHEN n_regionkey >= 2 THEN '1' ELSE '0' END AS count_in_pickup",
        )

    @cached_property
    def storages(self) -> DataFrame:
        """The bays that occur in the ledger."""
        return self.read("lineitem").select("l_linestatus").distinct().selectExpr(
            "CASE WHEN l_linestatus = 'O' THEN 'ON_STORAGE' ELSE 'NORMAL' END AS storage_code",
            "CASE WHEN l_linestatus = 'O' THEN '在途' ELSE '正常' END AS storage_name",
        )

    @cached_property
    def operators(self) -> DataFrame:
        return self.read("region").selectExpr(
            "CAST(r_regionkey + 1 AS STRING) AS user_code", "r_name AS user_name"
        )

    @cached_property
    def monitored(self) -> DataFrame:
        part = self.read("part")
        return part.where("p_size <= 25").selectExpr("p_partkey AS product_code").unionByName(
            part.where("p_brand = 'Brand#4'").selectExpr("p_partkey AS product_code")
        )

    # ---- sales ------------------------------------------------------------------------

    @cached_property
    def orders(self) -> DataFrame:
        return self.read("orders").selectExpr(
            "o_orderkey AS id", "o_orderkey AS sale_order_id", "o_orderkey AS sale_order_code",
            "o_custkey AS station_code", "o_orderstatus AS sale_type",
            "o_orderpriority AS sale_type_name",
            "CASE WHEN o_orderstatus = 'F' THEN 'BACK_ORDER' ELSE 'ORDER' END AS sale_order_type",
            "CASE WHEN o_orderstatus = 'F' THEN -1 ELSE 1 END AS in_out_flag",
            "CASE WHEN o_orderstatus <> 'P' THEN o_custkey END AS member_code",
            "CASE WHEN o_orderstatus <> 'P' THEN '会员' ELSE '非会员' END AS member_type",
            "left(o_orderpriority, 1) AS new_operator_code",
            "CAST(o_totalprice AS DECIMAL(12,2)) AS real_money",
            "o_orderdate AS create_time", "o_orderdate AS update_time", "o_orderdate AS pay_date",
        )

    @cached_property
    def details(self) -> DataFrame:
        return self.read("lineitem").selectExpr(
            "l_orderkey AS sale_order_code", "l_partkey AS product_code",
            "l_partkey AS goods_code", "l_linestatus AS storage_code",
            "CAST(l_quantity AS INT) AS sale_amount",
            "CAST(l_extendedprice AS DECIMAL(12,2)) AS sale_price",
            "CAST(CAST(l_extendedprice AS DECIMAL(12,2)) * (1 - CAST(l_discount AS DECIMAL(3,2)))"
            " AS DECIMAL(14,4)) AS sale_real_price",
        ).selectExpr(
            "*", "sale_price * sale_amount AS sale_money",
            "sale_real_price * sale_amount AS sale_real_money",
        )

    @cached_property
    def payments(self) -> DataFrame:
        """One payment per order line."""
        return self.read("lineitem").selectExpr(
            "l_orderkey AS sale_order_code", "l_linenumber AS pay_method_code",
            "CAST(l_extendedprice AS DECIMAL(12,2)) AS pay_money",
            "CAST(CAST(l_extendedprice AS DECIMAL(12,2)) * (1 - CAST(l_discount AS DECIMAL(3,2)))"
            " AS DECIMAL(14,4)) AS actual_money",
        )

    @cached_property
    def activities(self) -> DataFrame:
        orders = self.read("orders")
        return orders.selectExpr(
            "o_orderkey AS sale_order_code", "o_orderpriority AS sale_activity_name"
        ).unionByName(
            orders.where("o_orderstatus = 'O'").selectExpr(
                "o_orderkey AS sale_order_code", "'open' AS sale_activity_name"
            )
        )

    @cached_property
    def till_orders(self) -> DataFrame:
        """Events as orders with a time of day."""
        return self.read("events").selectExpr(
            "user_id AS station_code", "event_type AS sale_type_name",
            "CASE WHEN event_type = 'error' THEN -1 ELSE 1 END AS in_out_flag",
            "CASE WHEN event_type <> 'signup' THEN user_id END AS member_code",
            "CAST(floor(value) AS INT) + 1 AS total_amount",
            "CAST(value AS DECIMAL(12,2)) AS total_money",
            "CAST(CAST(value AS DECIMAL(12,2)) * CAST('0.9' AS DECIMAL(2,1)) AS DECIMAL(14,3))"
            " AS real_money",
            "ts AS create_time",
        )

    @cached_property
    def visitors(self) -> DataFrame:
        """Visitor counts per day and station, from the order book."""
        return self.read("orders").groupBy(
            F.to_date("o_orderdate").alias("record_date"), F.col("o_custkey").alias("station_code")
        ).agg((F.count(F.lit(1)) * 7).alias("info_value"))

    @cached_property
    def tasks(self) -> DataFrame:
        money = F.col("o_totalprice").cast("decimal(12,2)")
        return self.read("orders").groupBy(
            F.to_date("o_orderdate").alias("create_time"), F.col("o_custkey").alias("station_code")
        ).agg(
            F.sum(money).alias("juvenile"), F.max(money).cast("decimal(22,2)").alias("other"),
            F.min(money).cast("decimal(22,2)").alias("up2"),
        )

    @cached_property
    def wholesale_bills(self) -> DataFrame:
        return self.read("orders").selectExpr(
            "o_orderkey AS id", "o_orderkey AS code", "o_custkey AS own_station_code",
            "CASE o_orderstatus WHEN 'O' THEN 'OUT' WHEN 'F' THEN 'IN' ELSE 'OTHER' END"
            " AS bill_type",
            "o_orderdate AS create_time",
        )

    @cached_property
    def wholesale_lines(self) -> DataFrame:
        return self.details.selectExpr(
            "sale_order_code AS bill_code", "product_code AS h_id", "sale_amount AS amount",
            "sale_price AS price", "sale_real_price AS real_price",
        )

    # ---- cards ------------------------------------------------------------------------

    @cached_property
    def trades(self) -> DataFrame:
        kind = F.element_at(F.create_map(*[F.lit(x) for p in TRADES.items() for x in p]), F.col("event_type"))
        number = "regexp_extract(props, '([0-9]+)', 1)"
        return self.read("events").select(
            F.col("event_id").alias("trade_number"),
            F.expr("event_id - 1").alias("parent_trade_number"),
            F.expr("CASE WHEN event_type = 'error' THEN event_id - 1 END").alias("source_id"),
            kind.alias("trade_type"),
            F.expr("CASE WHEN value >= 2 THEN 'Succeed' ELSE 'Failed' END").alias("status"),
            F.col("user_id").alias("card_number"),
            F.expr(f"CAST({number} AS BIGINT)").alias("station_code"),
            F.expr(f"left({number}, 1)").alias("operator_code"),
            F.expr("CAST(CAST(value AS DECIMAL(12,2)) * 20 AS DECIMAL(14,2))").alias("pay_amount"),
            F.expr("CAST(floor(value / 50) * 50 AS DECIMAL(12,2))").alias("trade_amount"),
            F.expr("CAST(value AS DECIMAL(12,2))").alias("balance"),
            F.expr("CASE WHEN event_type IN ('purchase','click') THEN 1 ELSE -1 END").alias("in_out_flag"),
            F.expr(
                "CASE event_type WHEN 'purchase' THEN CAST('0.90' AS DECIMAL(3,2))"
                " WHEN 'error' THEN CAST('0.80' AS DECIMAL(3,2)) END"
            ).alias("discount"),
            F.col("ts").alias("create_time"),
        )

    @cached_property
    def card_info(self) -> DataFrame:
        return self.read("customer").selectExpr(
            "c_custkey AS card_number", "c_mktsegment AS card_class"
        )

    @cached_property
    def known_cards(self) -> DataFrame:
        return self.read("customer").where("c_acctbal < 0").selectExpr("c_custkey AS card_number")

    # ---- stock ------------------------------------------------------------------------

    @cached_property
    def ledger(self) -> DataFrame:
        kinds = " ".join(f"WHEN {n} THEN '{t}'" for n, t in BILL_TYPES.items())
        return self.read("lineitem").selectExpr(
            "concat('B', year(l_shipdate)) AS batch_no", "l_orderkey AS bill_code",
            f"CASE l_linenumber {kinds} END AS bill_type",
            "CASE WHEN l_returnflag = 'R' THEN 'IN_STORAGE' ELSE 'OUT_STORAGE' END AS bill_purpose",
            "l_suppkey AS from_location_code", "concat('L', l_suppkey) AS from_location_name",
            "CASE WHEN l_linestatus = 'O' THEN 'BOOKSTORE' ELSE 'LOGISTICS' END"
            " AS from_location_type",
            "CASE WHEN l_linestatus = 'O' THEN 'ON_STORAGE' ELSE 'NORMAL' END"
            " AS from_location_storage",
            "l_linenumber AS target_location_code",
            "concat('T', l_linenumber) AS target_location_name",
            "CASE WHEN l_returnflag = 'A' THEN 'CAFE' ELSE 'STAPLE' END AS target_location_type",
            "l_partkey AS goods_code", "CAST(l_quantity AS INT) AS amount",
            "CASE WHEN l_returnflag = 'R' THEN CAST(l_extendedprice AS DECIMAL(12,2)) END"
            " AS inflow_price",
            "CASE WHEN l_returnflag <> 'R' THEN CAST(l_extendedprice AS DECIMAL(12,2)) END"
            " AS outflow_price",
            "l_shipdate AS create_time", "l_shipdate AS update_time", "l_shipdate AS stock_date",
            "CASE WHEN l_returnflag = 'N' THEN 'YH' ELSE 'ERP' END AS origin_system",
        )

    @cached_property
    def batches(self) -> DataFrame:
        price = F.col("l_extendedprice").cast("decimal(12,2)")
        return self.read("lineitem").groupBy(
            F.expr("concat('B', year(l_shipdate))").alias("batch_no"),
            F.col("l_partkey").alias("goods_code"),
        ).agg(
            F.min("l_orderkey").alias("batch_id"),
            F.min("l_suppkey").alias("supplier_code"),
            F.concat(F.lit("S"), F.min("l_suppkey")).alias("supplier_name"),
            F.min(price).alias("cost_price"),
        )

    @cached_property
    def stock(self) -> DataFrame:
        return self.ledger.groupBy(
            "batch_no", "goods_code", F.col("from_location_code").alias("location_code"),
            F.col("from_location_storage").alias("storage"),
        ).agg(
            F.max(F.coalesce("inflow_price", "outflow_price")).alias("price"),
            (F.max(F.coalesce("inflow_price", "outflow_price")) * F.lit("0.62").cast("decimal(3,2)"))
            .cast("decimal(16,4)").alias("flow_price"),
            F.sum(F.when(F.col("bill_purpose") == "IN_STORAGE", F.col("amount")).otherwise(0))
            .alias("available_amount"),
        )

    @cached_property
    def papers(self) -> DataFrame:
        """Collection documents of the ledger's bills."""
        return self.read("lineitem").where("l_linestatus = 'O'").selectExpr(
            "l_orderkey AS bill_code", "l_shipdate AS create_time", "l_orderkey AS order_code",
            "l_orderkey AS origin_bill_code",
        ).distinct()

    @cached_property
    def gifts(self) -> DataFrame:
        return self.read("orders").selectExpr(
            "o_orderkey AS code", "o_custkey AS related_bill_code",
            "CASE WHEN o_orderstatus <> 'O' THEN o_orderpriority END AS describe_des",
            "o_orderdate AS create_time",
        )

    @cached_property
    def counted(self) -> DataFrame:
        return self.read("lineitem").groupBy(
            F.col("l_suppkey").alias("station_code"), F.col("l_linestatus").alias("storage_code"),
            F.col("l_partkey").alias("goods_code"),
        ).agg(
            F.sum(F.expr(
                "CASE WHEN l_returnflag = 'R' THEN CAST(l_quantity AS INT)"
                " ELSE -CAST(l_quantity AS INT) END"
            )).alias("amount")
        )

    # ---- documents --------------------------------------------------------------------

    @cached_property
    def bills(self) -> DataFrame:
        return self.read("orders").selectExpr(
            "o_orderkey AS id", "o_orderkey AS bill_code",
            "CASE concat(left(o_orderpriority, 1), o_orderstatus)"
            " WHEN '1O' THEN 'PURCHASE' WHEN '1F' THEN 'RETURNED' WHEN '1P' THEN 'ADJUST'"
            " WHEN '2O' THEN 'ALLOT' WHEN '2F' THEN 'DELIVERY' WHEN '2P' THEN 'RESTOCK'"
            " WHEN '3O' THEN 'PICKING_MISTAKE' WHEN '3F' THEN 'PRESENT' WHEN '3P' THEN 'BATCH_SALE'"
            " WHEN '4O' THEN 'ADJUST' WHEN '4F' THEN 'PURCHASE' ELSE 'OTHER' END AS bill_type",
            "CASE WHEN o_totalprice > 200000 THEN 'IN_STORAGE' ELSE 'OUT_STORAGE' END"
            " AS bill_purpose",
            "o_custkey AS in_station_code",
            "CAST(floor(o_totalprice / 1000) AS BIGINT) AS out_station_code",
            "CAST(-o_totalprice AS DECIMAL(12,2)) AS total_money",
            "o_orderdate AS create_time", "o_orderdate AS update_time", "o_orderdate AS stock_date",
        )

    @cached_property
    def bill_lines(self) -> DataFrame:
        return self.read("lineitem").selectExpr(
            "l_orderkey AS bill_code", "l_partkey AS goods_code",
            "CAST(-l_quantity AS INT) AS actual_total_amount",
            "CAST(-l_quantity AS INT) AS shipped_total_amount",
            "CAST(l_extendedprice AS DECIMAL(12,2)) AS price",
            "CAST(l_discount AS DECIMAL(3,2)) AS discount",
            "l_linestatus AS in_storage_code", "l_returnflag AS out_storage_code",
        )

    # ---- logs and pipelines -----------------------------------------------------------

    @cached_property
    def log_lines(self) -> DataFrame:
        """The events as three run logs: dated step lines, markers, starts of pipelines, undated
        errors and noise.  Lines keep the events' numbers, so those of a file have gaps."""
        stamp = "date_format(ts, 'yyyy/MM/dd HH:mm:ss')"
        step = "concat('rate_0400', user_id, '.0')"
        started = "concat('conv_', greatest(user_id - 4, 0))"
        return self.read("events").selectExpr(
            "concat('run_', event_id % 3, '.log') AS file",
            "event_id + 1 AS line_no",
            f"""CASE
              WHEN event_type = 'error' AND value > 300 THEN concat('ERROR: worker ', user_id, ' lost')
              WHEN event_type = 'error' THEN
                concat('*ERROR* [org.osgi.service.cm.ManagedService, id=', user_id, ']: x')
              WHEN event_type = 'signup' THEN concat({stamp}, ' - ', {step},
                ' - Finished processing (I=', event_id, ', O=', user_id, ', R=', event_id + 1,
                ', W=', user_id + 1, ', U=0, E=0)')
              WHEN event_type = 'purchase' THEN
                concat({stamp}, ' - ', {step}, ' - start load - LOAD DATA ', event_id)
              WHEN event_type = 'view' AND value > 150 THEN
                concat({stamp}, ' - main - start {MARKER}')
              WHEN event_type = 'click' AND value < 20 THEN
                concat({stamp}, ' - ', {started}, ' - {START_PHRASES[0]}  [', {started}, ']')
              ELSE concat({stamp}, ' - ', {step}, ' - linenr ', event_id) END AS value""",
        )

    @cached_property
    def hops(self) -> DataFrame:
        return self.read("conversations").selectExpr(
            "concat('conv_', conv_id) AS file",
            "concat('rate_0400', conv_id + turn) AS from_table",
            "concat('rate_0400', conv_id + turn + 1) AS to_table",
            "role <> 'system' AS enabled",
        )
