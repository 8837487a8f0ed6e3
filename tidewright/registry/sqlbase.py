"""The same views of the driver's tables in DuckDB SQL."""

from __future__ import annotations

from ..operators.loglines import START_PHRASES
from .bindings import BILL_TYPES, MARKER, REGIONS, SEGMENTS, TRADES


def _case(column: str, names: dict) -> str:
    return f"CASE {column} " + " ".join(
        f"WHEN {k if isinstance(k, int) else repr(k)} THEN '{v}'" for k, v in names.items()
    ) + " END"


_REAL = (
    "CAST(CAST(l_extendedprice AS DECIMAL(12,2)) * (1 - CAST(l_discount AS DECIMAL(3,2)))"
    " AS DECIMAL(14,4))"
)
_STAMP = "strftime(ts, '%Y/%m/%d %H:%M:%S')"
_STEP = "'rate_0400' || user_id || '.0'"

VIEWS = {
    "products": """
      SELECT p_partkey AS product_code, p_name AS product_name, 'I' || p_partkey AS product_isbn,
        CAST(p_retailprice AS DECIMAL(12,2)) AS product_price,
        lpad(CAST(p_size AS VARCHAR), 2, '0') AS category_two_code, p_type AS category_two_name,
        lpad(CAST(p_size AS VARCHAR), 2, '0') || lpad(substr(p_brand, 7), 2, '0') AS category_three_code,
        p_brand AS category_three_name,
        lpad(CAST(p_size AS VARCHAR), 2, '0') || lpad(substr(p_brand, 7), 2, '0') || '03' AS category_four_code,
        'S' || p_size AS category_four_name, p_size || left(p_type, 1) AS category_five_code,
        p_type || '/' || p_size AS category_five_name, left(p_type, 2) AS fina_category_code,
        p_type AS fina_category_name, CAST(substr(p_brand, 7) AS BIGINT) AS supplier_code,
        'S' || substr(p_brand, 7) AS supplier_name,
        CASE WHEN p_size > 25 THEN '新品' ELSE '老品' END AS product_state
      FROM part""",
    "shops": f"""
      SELECT c_custkey AS new_station_code, c_name AS new_station_name,
        n_regionkey AS station_region_code, r_name AS station_region_name,
        CAST(n_nationkey AS BIGINT) AS logistic_code, n_name AS logistics_name,
        {_case('c_mktsegment', SEGMENTS)} AS category_code, c_mktsegment AS category_name,
        CASE WHEN c_mktsegment IN ('BUILDING','FURNITURE') THEN 'BOOKSTORE'
          WHEN c_mktsegment IN ('MACHINERY','HOUSEHOLD') THEN 'LOGISTICS' ELSE 'OTHER' END AS category_code_flow,
        CASE WHEN c_acctbal > 0 THEN DATE '2002-01-01' ELSE DATE '1998-01-01' END AS erp_date,
        CASE WHEN c_acctbal > 0 THEN 'YH' ELSE 'ERP' END AS bookstore_system
      FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""",
    "depots": f"""
      SELECT s_suppkey AS new_station_code, s_name AS new_station_name,
        n_regionkey AS station_region_code, r_name AS station_region_name,
        CAST(n_nationkey AS BIGINT) AS logistic_code, n_name AS logistics_name,
        {_case('r_name', REGIONS)} AS category_code, r_name AS category_name,
        CASE WHEN r_name IN ('AMERICA','ASIA') THEN 'BOOKSTORE'
          WHEN r_name = 'AFRICA' THEN 'LOGISTICS' ELSE 'OTHER' END AS category_code_flow,
        CASE WHEN s_acctbal > 3000 THEN 'YH' ELSE 'ERP' END AS bookstore_system
      FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""",
    "suppliers": "SELECT s_suppkey AS supplier_code, s_name AS supplier_name FROM supplier",
    "pay_methods": """
      SELECT n_nationkey AS pay_method_code, n_name AS pay_method_name,
        n_regionkey <= 2 AS in_retail, n_regionkey IN (2, 3) AS in_card_pickup,
        n_regionkey >= 2 AS in_pickup FROM nation""",
    "storages": """
      SELECT * FROM (VALUES ('ON_STORAGE', '在途'), ('NORMAL', '正常')) AS t(storage_code, storage_name)""",
    "operators": "SELECT CAST(r_regionkey + 1 AS VARCHAR) AS user_code, r_name AS user_name FROM region",
    "monitored": """
      SELECT p_partkey AS product_code FROM part WHERE p_size <= 25
      UNION ALL SELECT p_partkey FROM part WHERE p_brand = 'Brand#4'""",
    "sale_order": """
      SELECT o_orderkey AS id, o_orderkey AS sale_order_id, o_orderkey AS sale_order_code,
        o_custkey AS station_code, o_orderstatus AS sale_type, o_orderpriority AS sale_type_name,
        CASE WHEN o_orderstatus = 'F' THEN 'BACK_ORDER' ELSE 'ORDER' END AS sale_order_type,
        CASE WHEN o_orderstatus = 'F' THEN -1 ELSE 1 END AS in_out_flag,
        CASE WHEN o_orderstatus <> 'P' THEN o_custkey END AS member_code,
        CASE WHEN o_orderstatus <> 'P' THEN '会员' ELSE '非会员' END AS member_type,
        left(o_orderpriority, 1) AS new_operator_code,
        CAST(o_totalprice AS DECIMAL(12,2)) AS real_money, o_orderdate AS create_time
      FROM orders""",
    "sale_detail": f"""
      SELECT l_orderkey AS sale_order_code, l_partkey AS product_code, l_linestatus AS storage_code,
        CAST(l_quantity AS INTEGER) AS sale_amount,
        CAST(l_extendedprice AS DECIMAL(12,2)) AS sale_price, {_REAL} AS sale_real_price
      FROM lineitem""",
    "payment": f"""
      SELECT l_orderkey AS sale_order_code, l_linenumber AS pay_method_code,
        CAST(l_extendedprice AS DECIMAL(12,2)) AS pay_money, {_REAL} AS actual_money
      FROM lineitem""",
    "activity": """
      SELECT o_orderkey AS sale_order_code, o_orderpriority AS sale_activity_name FROM orders
      UNION ALL SELECT o_orderkey, 'open' FROM orders WHERE o_orderstatus = 'O'""",
    "till_orders": """
      SELECT user_id AS station_code, event_type AS sale_type_name,
        CASE WHEN event_type = 'error' THEN -1 ELSE 1 END AS in_out_flag,
        CASE WHEN event_type <> 'signup' THEN user_id END AS member_code,
        CAST(floor(value) AS INTEGER) + 1 AS total_amount, CAST(value AS DECIMAL(12,2)) AS total_money,
        CAST(CAST(value AS DECIMAL(12,2)) * CAST('0.9' AS DECIMAL(2,1)) AS DECIMAL(14,3)) AS real_money,
        ts AS create_time FROM events""",
    "trades": f"""
      SELECT event_id AS trade_number, event_id - 1 AS parent_trade_number,
        CASE WHEN event_type = 'error' THEN event_id - 1 END AS source_id,
        {_case('event_type', TRADES)} AS trade_type,
        CASE WHEN value >= 2 THEN 'Succeed' ELSE 'Failed' END AS status, user_id AS card_number,
        CAST(regexp_extract(props, '([0-9]+)', 1) AS BIGINT) AS station_code,
        left(regexp_extract(props, '([0-9]+)', 1), 1) AS operator_code,
        CAST(CAST(value AS DECIMAL(12,2)) * 20 AS DECIMAL(14,2)) AS pay_amount,
        CAST(floor(value / 50) * 50 AS DECIMAL(12,2)) AS trade_amount,
        CAST(value AS DECIMAL(12,2)) AS balance,
        CASE WHEN event_type IN ('purchase','click') THEN 1 ELSE -1 END AS in_out_flag,
        CASE event_type WHEN 'purchase' THEN CAST('0.90' AS DECIMAL(3,2))
          WHEN 'error' THEN CAST('0.80' AS DECIMAL(3,2)) END AS discount,
        ts AS create_time FROM events""",
    "ledger": f"""
      SELECT 'B' || year(l_shipdate) AS batch_no, l_orderkey AS bill_code,
        {_case('l_linenumber', BILL_TYPES)} AS bill_type,
        CASE WHEN l_returnflag = 'R' THEN 'IN_STORAGE' ELSE 'OUT_STORAGE' END AS bill_purpose,
        l_suppkey AS location_code, 'L' || l_suppkey AS location_name,
        CASE WHEN l_linestatus = 'O' THEN '书店' ELSE '物流' END AS location_type,
        CASE WHEN l_linestatus = 'O' THEN 'ON_STORAGE' ELSE 'NORMAL' END AS storage,
        l_linenumber AS target_code, 'T' || l_linenumber AS target_name,
        CASE WHEN l_returnflag = 'A' THEN '咖啡馆' ELSE '大宗客户' END AS target_type,
        l_partkey AS goods_code, CAST(l_quantity AS INTEGER) AS amount,
        CAST(l_extendedprice AS DECIMAL(12,2)) AS real_price,
        CASE WHEN l_returnflag = 'R' THEN 1 ELSE -1 END AS in_out_flag,
        CASE WHEN l_returnflag = 'N' THEN 'YH' ELSE 'ERP' END AS origin_system,
        l_shipdate AS create_time FROM lineitem""",
    "batch": """
      SELECT 'B' || year(l_shipdate) AS batch_no, l_partkey AS goods_code, min(l_orderkey) AS batch_id,
        min(l_suppkey) AS supplier_code, 'S' || min(l_suppkey) AS supplier_name,
        min(CAST(l_extendedprice AS DECIMAL(12,2))) AS cost_price
      FROM lineitem GROUP BY 1, 2""",
    "stock": """
      SELECT batch_no, goods_code, location_code, storage, max(real_price) AS price,
        CAST(max(real_price) * CAST('0.62' AS DECIMAL(3,2)) AS DECIMAL(16,4)) AS flow_price,
        CAST(sum(CASE WHEN in_out_flag = 1 THEN amount ELSE 0 END) AS BIGINT) AS available_amount
      FROM ledger GROUP BY ALL""",
    "papers": """
      SELECT DISTINCT l_orderkey AS bill_code, l_shipdate AS create_time, l_orderkey AS order_code
      FROM lineitem WHERE l_linestatus = 'O'""",
    "changes": """
      SELECT CAST(a.create_time AS DATE) AS date, a.batch_no, b.supplier_code,
        a.goods_code AS product_code, a.location_code AS station_code, a.storage, a.amount,
        a.in_out_flag, c.price, a.real_price, c.flow_price, b.cost_price, a.bill_type,
        a.bill_code AS offset_bill_code, d.order_code AS bill_code, a.create_time
      FROM ledger a JOIN batch b USING (batch_no, goods_code)
      JOIN stock c USING (batch_no, goods_code, location_code, storage)
      LEFT JOIN papers d ON a.bill_code = d.bill_code AND a.create_time = d.create_time""",
    "gifts": """
      SELECT a.code, coalesce(a.des, b.des) AS present_reason FROM
        (SELECT o_orderkey AS code, o_custkey AS related,
           CASE WHEN o_orderstatus <> 'O' THEN o_orderpriority END AS des FROM orders) a
        LEFT JOIN (SELECT o_orderkey AS code,
           CASE WHEN o_orderstatus <> 'O' THEN o_orderpriority END AS des FROM orders) b
        ON a.related = b.code""",
    "daily": """
      SELECT s.date, s.batch_no, b.supplier_code, s.goods_code AS product_code,
        s.location_code AS station_code, s.storage, s.amount, p.price, p.flow_price, b.cost_price
      FROM (
        SELECT d.date, batch_no, goods_code, location_code, storage, sum(amount) AS amount FROM (
          SELECT batch_no, goods_code, location_code, storage, available_amount AS amount, NULL AS t
          FROM stock WHERE available_amount > 0
          UNION ALL
          SELECT batch_no, goods_code, location_code, storage, -in_out_flag * amount, create_time FROM ledger) m
        JOIN (SELECT unnest(range(TIMESTAMP '{first}', TIMESTAMP '{last}' + INTERVAL 1 DAY, INTERVAL 1 DAY)) AS date) d
          ON m.t IS NULL OR m.t >= d.date + INTERVAL 1 DAY
        GROUP BY ALL HAVING sum(amount) <> 0) s
      JOIN stock p USING (batch_no, goods_code, location_code, storage)
      JOIN batch b USING (batch_no, goods_code)""",
    "counted": """
      SELECT l_suppkey AS station_code, l_linestatus AS storage_code, l_partkey AS goods_code,
        sum(CASE WHEN l_returnflag = 'R' THEN CAST(l_quantity AS INTEGER)
              ELSE -CAST(l_quantity AS INTEGER) END) AS amount
      FROM lineitem GROUP BY ALL""",
    "bills": """
      SELECT o_orderkey AS id, o_orderkey AS bill_code,
        CASE left(o_orderpriority, 1) || o_orderstatus
          WHEN '1O' THEN 'PURCHASE' WHEN '1F' THEN 'RETURNED' WHEN '1P' THEN 'ADJUST'
          WHEN '2O' THEN 'ALLOT' WHEN '2F' THEN 'DELIVERY' WHEN '2P' THEN 'RESTOCK'
          WHEN '3O' THEN 'PICKING_MISTAKE' WHEN '3F' THEN 'PRESENT' WHEN '3P' THEN 'BATCH_SALE'
          WHEN '4O' THEN 'ADJUST' WHEN '4F' THEN 'PURCHASE' ELSE 'OTHER' END AS bill_type,
        CASE WHEN o_totalprice > 200000 THEN 'IN_STORAGE' ELSE 'OUT_STORAGE' END AS bill_purpose,
        o_custkey AS in_station_code, CAST(floor(o_totalprice / 1000) AS BIGINT) AS out_station_code,
        CAST(-o_totalprice AS DECIMAL(12,2)) AS total_money, o_orderdate AS create_time
      FROM orders""",
    "bill_lines": """
      SELECT l_orderkey AS bill_code, l_partkey AS goods_code,
        CAST(-l_quantity AS INTEGER) AS actual_total_amount,
        CAST(l_extendedprice AS DECIMAL(12,2)) AS price, CAST(l_discount AS DECIMAL(3,2)) AS discount,
        l_linestatus AS in_storage_code, l_returnflag AS out_storage_code FROM lineitem""",
    "log": f"""
      SELECT *, CASE WHEN dated THEN {_STAMP} || ' - ' || step_text || ' - ' || said ELSE said END AS raw,
        split_part(step_text, '.', 1) AS step
      FROM (
        SELECT *, CASE WHEN NOT dated THEN NULL WHEN marked THEN 'main' WHEN started IS NOT NULL THEN started
            ELSE {_STEP} END AS step_text,
          CASE WHEN event_type = 'error' AND value > 300 THEN 'ERROR: worker ' || user_id || ' lost'
            WHEN event_type = 'error' THEN '*ERROR* [org.osgi.service.cm.ManagedService, id=' || user_id || ']: x'
            WHEN event_type = 'signup' THEN 'Finished processing (I=' || event_id || ', O=' || user_id
              || ', R=' || (event_id + 1) || ', W=' || (user_id + 1) || ', U=0, E=0)'
            WHEN event_type = 'purchase' THEN 'start load - LOAD DATA ' || event_id
            WHEN marked THEN 'start {MARKER}'
            WHEN started IS NOT NULL THEN '{START_PHRASES[0]}  [' || started || ']'
            ELSE 'linenr ' || event_id END AS said
        FROM (
          SELECT 'run_' || (event_id % 3) || '.log' AS file, event_id + 1 AS line_no, ts,
            CAST(ts AS DATE) AS day, event_id, user_id, event_type, value, event_type <> 'error' AS dated,
            event_type = 'view' AND value > 150 AS marked,
            CASE WHEN event_type = 'click' AND value < 20 THEN 'conv_' || greatest(user_id - 4, 0) END AS started
          FROM events))""",
    "running": """
      SELECT *, last_value(started IGNORE NULLS) OVER (PARTITION BY file ORDER BY line_no) AS pipeline FROM log""",
    "windows": """
      SELECT file, day, coalesce(min(CASE WHEN marked THEN line_no END), min(line_no)) AS start_line,
        max(line_no) AS end_line FROM log WHERE dated GROUP BY file, day""",
    "verdict": """
      SELECT w.file, w.day, w.start_line, w.end_line, min(e.line_no) AS first_error, count(e.line_no) AS n_errors,
        CASE WHEN count(e.line_no) = 0 THEN 'success' ELSE 'failed' END AS status
      FROM windows w LEFT JOIN (SELECT file, line_no FROM log WHERE event_type = 'error' AND value > 300) e
        ON e.file = w.file AND e.line_no BETWEEN w.start_line AND w.end_line
      GROUP BY w.file, w.day, w.start_line, w.end_line""",
    "metrics": """
      SELECT file, day, step, date_trunc('second', min(ts)) AS min_ts, date_trunc('second', max(ts)) AS max_ts,
        arg_max(event_type = 'signup', line_no) AS finished, arg_max(event_id, line_no) AS last_id,
        any_value(user_id) AS user_id
      FROM log WHERE dated GROUP BY file, day, step""",
    "pipeline_metrics": """
      SELECT file, day, pipeline, step, date_trunc('second', min(ts)) AS min_ts, date_trunc('second', max(ts)) AS max_ts,
        arg_max(event_type = 'signup', line_no) AS finished, arg_max(event_id, line_no) AS last_id,
        any_value(user_id) AS user_id
      FROM running WHERE dated GROUP BY file, day, pipeline, step""",
    "hops": """
      SELECT 'conv_' || conv_id AS file, 'rate_0400' || (conv_id + turn) AS from_table,
        'rate_0400' || (conv_id + turn + 1) AS to_table, "role" <> 'system' AS enabled
      FROM conversations""",
    "ends": """
      SELECT * FROM hops b WHERE NOT EXISTS
        (SELECT 1 FROM hops a WHERE a.file = b.file AND a.from_table = b.to_table)""",
}
_NEEDS = {
    "stock": ["ledger"],
    "changes": ["ledger", "batch", "stock", "papers"],
    "daily": ["ledger", "stock", "batch"],
    "windows": ["log"],
    "verdict": ["log", "windows"],
    "metrics": ["log"],
    "running": ["log"],
    "pipeline_metrics": ["running"],
    "ends": ["hops"],
}


def with_views(*names: str, body: str, **values: str) -> str:
    """``body`` behind the named views and the views they need."""
    order: list[str] = []

    def add(name: str) -> None:
        for need in _NEEDS.get(name, []):
            add(need)
        if name not in order:
            order.append(name)

    for name in names:
        add(name)
    parts = []
    for name in order:
        text = VIEWS[name]
        for key, value in values.items():
            text = text.replace("{" + key + "}", value)
        parts.append(f"{name} AS MATERIALIZED ({text})")
    return "WITH " + ",\n".join(parts) + "\n" + body


def num(expr: str, name: str, digits: int | None = None) -> str:
    """A money or amount column as double, rounded first when digits are given."""
    inner = expr if digits is None else f"round({expr}, {digits})"
    return f"CAST({inner} AS DOUBLE) AS {name}"


def day(expr: str, name: str) -> str:
    return f"strftime({expr}, '%Y-%m-%d') AS {name}"
