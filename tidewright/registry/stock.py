"""Stock, supplier and shortage queries."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from ..plans import ledger as moves
from ..plans import sales, shortage, stock, suppliers
from .bindings import Tables
from .common import plain
from .sqlbase import day, num, with_views

FIRST, LAST = dt.date(2001, 8, 30), dt.date(2001, 9, 1)
DAY = dt.date(2001, 6, 30)
BATCH = "B2001"
GIFT_LABEL = "中心赠送单"
REGULAR = "O"


def _changes(t: Tables):
    return stock.stock_change_erp(t.ledger, t.batches, t.stock, t.papers)


def _daily(t: Tables, first: dt.date = FIRST, last: dt.date = LAST, by: tuple[str, ...] = ("product_code",)):
    return stock.back_rolled_stock(t.stock, t.ledger, t.batches, first, last, by=by)


def stock_change_erp(t: Tables):
    return plain(_changes(t))


def stock_change_center(t: Tables):
    return plain(stock.stock_change_center(t.ledger, t.batches, t.stock))


def _combined(t: Tables, first: dt.date | None = None, last: dt.date | None = None):
    line = t.read("lineitem")
    orders = line.groupBy(
        F.col("l_orderkey").alias("sale_order_code"), F.col("l_shipdate").alias("create_time")
    ).agg(F.min("l_linestatus").alias("sale_type"))
    center_gifts = line.where("l_returnflag = 'A'").selectExpr(
        "l_orderkey AS bill_code", "l_shipdate AS create_time"
    )
    gift_lines = line.where("l_linenumber = 5").selectExpr(
        "l_orderkey AS sale_order_code", "l_partkey AS product_code", "l_shipdate AS create_time"
    )
    return stock.stock_change_combined(
        t.ledger, t.batches, t.stock, t.papers, orders, t.gifts, center_gifts, gift_lines,
        GIFT_LABEL, first, last,
    )


def stock_change_combined(t: Tables):
    return plain(_combined(t))


def book_stock_change(t: Tables):
    scanned = t.ledger.select(F.col("goods_code").alias("product_code"))
    return plain(stock.book_stock_change(_changes(t), t.products, t.storages, keys_of=scanned))


def fine_by_category(t: Tables):
    scanned = t.ledger.select(F.col("goods_code").alias("product_code"))
    return plain(sales.fine_by_category(_changes(t), t.products, t.depots, t.orders, keys_of=scanned))


def stock_backroll(t: Tables):
    return plain(_daily(t, by=()))


def stock_snapshot(t: Tables):
    out = stock.stock_detail_daily(_daily(t), t.products.drop("supplier_code"), t.storages, t.depots)
    return plain(
        out.select(
            "date", "station_code", "station_name", "logistic_code", "logistic_name",
            "station_region_name", "operation_type_name", "product_code", "product_name",
            "category_three_code", "supplier_name", "product_price", "current_total_price",
            "available_amount", "price", "cost_price",
        )
    )


def latest_stock(t: Tables):
    return plain(stock.latest_stock(_daily(t), t.products, t.storages, LAST))


def supplier_stock(t: Tables):
    return plain(suppliers.supplier_stock(_daily(t), t.products, t.depots, t.suppliers))


def supplier_stock_now(t: Tables):
    return plain(suppliers.supplier_stock_now(t.stock, t.products, t.depots, t.batches, LAST))


def emphasis_stock(t: Tables):
    return plain(stock.emphasis_stock(_daily(t), t.products, t.depots, t.monitored, LAST))


def emphasis_with_stock(t: Tables):
    held = stock.emphasis_stock(_daily(t), t.products, t.depots, t.monitored, LAST)
    sold = sales.emphasis_sale(
        t.orders, t.details, t.wholesale_bills, t.wholesale_lines, t.products, t.monitored
    )
    return plain(sales.emphasis_with_stock(sold, held))


# The first day of the longest trailing window.
SINCE = DAY - dt.timedelta(days=shortage.WINDOWS[0] - 1)


def trailing_sales(t: Tables):
    recent = stock.stock_change_erp(t.ledger, t.batches, t.stock, t.papers, SINCE, DAY)
    return plain(shortage.trailing_sales(recent, DAY))


def _wide(t: Tables, sold):
    bases = shortage.stock_bases(_daily(t, DAY, DAY), t.depots, DAY)
    return plain(shortage.shortage_wide(sold, bases, t.depots, t.products, t.suppliers, DAY))


def shortage_wide(t: Tables):
    recent = stock.stock_change_erp(t.ledger, t.batches, t.stock, t.papers, SINCE, DAY)
    return _wide(t, shortage.trailing_sales(recent, DAY))


def shortage_regular(t: Tables):
    """The wide table over sales of the regular type alone."""
    return _wide(t, shortage.trailing_sales(_combined(t, SINCE, DAY), DAY, REGULAR))


def station_circulation(t: Tables):
    return plain(suppliers.station_circulation(t.ledger, t.batches, t.products))


def supplier_in_out(t: Tables):
    return plain(suppliers.supplier_in_out(t.ledger, t.batches, t.products))


def supplier_reconciliation(t: Tables):
    return plain(suppliers.supplier_reconciliation(t.ledger, t.batches, t.products))


def supplier_sale(t: Tables):
    return plain(suppliers.supplier_sale(_changes(t), t.products, t.depots))


def wholesale(t: Tables):
    return plain(suppliers.wholesale(t.ledger, t.batches, t.stock, t.products))


def give_aways(t: Tables):
    scanned = t.ledger.select(F.col("bill_code").alias("offset_bill_code"))
    return plain(suppliers.give_aways(_changes(t), t.depots, t.products, t.gifts, keys_of=scanned))


def _documents(t: Tables):
    return moves.movements(t.bills, t.bill_lines, t.shops, t.batches, BATCH)


def _retail(t: Tables):
    return moves.sale_movements(t.orders, t.details, t.shops, BATCH)


def ledger_documents(t: Tables):
    return plain(_documents(t).drop("update_time", "stock_date"))


def ledger_sales(t: Tables):
    return plain(_retail(t).drop("update_time", "stock_date"))


def ledger_union(t: Tables):
    """Amounts of the whole ledger per type and direction."""
    return plain(
        moves.ledger(_documents(t), _retail(t))
        .groupBy("bill_type", "bill_purpose", "origin_bill_type")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.sum("amount").alias("amount"),
            F.sum(F.col("amount") * F.coalesce("inflow_price", "outflow_price")).alias("money"),
        )
    )


def stock_of_batch(t: Tables):
    return plain(
        moves.stock_of_batch(
            t.counted, t.ledger, t.depots, t.products, t.batches, BATCH, dt.date(2001, 5, 5)
        )
    )


def stock_old_batches(t: Tables):
    return plain(
        moves.zeroed_old_batches(
            t.ledger, t.depots, t.products, t.batches, "B2000", dt.date(2001, 5, 5)
        )
    )


def stock_rebuilt(t: Tables):
    lines = t.bill_lines.withColumn("actual_total_amount", F.abs("actual_total_amount"))
    return plain(
        moves.stock_rebuilt(
            t.counted, t.bills, lines, t.orders, t.details, dt.date(1999, 7, 7), None
        )
    )


QUERIES = {
    f.__name__: f
    for f in (
        stock_change_erp, stock_change_center, stock_change_combined, book_stock_change,
        fine_by_category, stock_backroll, stock_snapshot, latest_stock, supplier_stock,
        supplier_stock_now, emphasis_stock, emphasis_with_stock, trailing_sales, shortage_wide,
        shortage_regular,
        station_circulation, supplier_in_out, supplier_reconciliation, supplier_sale, wholesale,
        give_aways, ledger_documents, ledger_sales, ledger_union, stock_of_batch,
        stock_old_batches, stock_rebuilt,
    )
}

_RANGE = {"first": str(FIRST), "last": str(LAST)}
_ONE_DAY = {"first": str(DAY), "last": str(DAY)}
_CATS = "category_two_name, category_three_name, category_four_name, category_five_name"
_STATION = " ".join(
    f"WHEN '{k}' THEN '{v}'" for k, v in (
        ("SUPPLIER", "供应商"), ("BOOKSTORE", "书店"), ("CAFE", "咖啡馆"), ("LOGISTICS", "物流"),
        ("STAPLE", "大宗客户"), ("WHOLESALE", "批发事业部"), ("USER", "用户"))
)
_CHANGE = f"""{day('date', 'date')}, batch_no, supplier_code, product_code, station_code, storage, amount,
  in_out_flag, {num('price', 'price')}, {num('real_price', 'real_price')}, {num('flow_price', 'flow_price')},
  {num('cost_price', 'cost_price')}, bill_type, offset_bill_code"""
_TIME = "strftime(create_time, '%Y-%m-%d %H:%M:%S')"
_BAY = f"""
  SELECT date, station_code, product_code, storage, sum(amount * price) AS total, sum(amount) AS n,
    sum(amount * flow_price) AS flow, sum(amount * cost_price) AS cost FROM daily GROUP BY ALL"""
_EMPHASIS_STOCK = f"""
  SELECT logistic_code, logistics_name, station_region_code, station_region_name, a.station_code,
    new_station_name AS station_name, a.product_code, product_name,
    sum(CASE WHEN storage <> 'ON_STORAGE' THEN amount ELSE 0 END) AS local_amount,
    sum(CASE WHEN storage = 'ON_STORAGE' THEN amount ELSE 0 END) AS moving_amount
  FROM daily a JOIN depots b ON a.station_code = b.new_station_code
  JOIN products c ON a.product_code = c.product_code JOIN monitored d ON a.product_code = d.product_code
  WHERE a.date = DATE '{LAST}' GROUP BY ALL"""
_TRAILING = "\n".join(
    f", CAST(sum(CASE WHEN date >= DATE '{DAY - dt.timedelta(days=n - 1)}' THEN -amount * in_out_flag END) AS BIGINT) AS sale_amount_{n}d"
    for n in (60, 30, 15, 7)
)
_SALES = f"""SELECT station_code, supplier_code, product_code{_TRAILING} FROM changes
  WHERE date BETWEEN DATE '{DAY - dt.timedelta(days=59)}' AND DATE '{DAY}' AND bill_type = 'SALE' GROUP BY 1, 2, 3"""
_TYPED = _SALES.replace("FROM changes", f"""FROM changes JOIN (
    SELECT l_orderkey AS k, l_shipdate AS t, min(l_linestatus) AS sale_type FROM lineitem GROUP BY 1, 2) e
    ON bill_code = e.k AND create_time = e.t AND sale_type = '{REGULAR}'""")
_DOCS = f"""
  , h AS (SELECT goods_code, min(cost_price) AS cost FROM batch WHERE batch_no = '{BATCH}' GROUP BY 1),
  x AS (
    SELECT b.bill_code, b.bill_type, b.id, b.create_time, a.goods_code, abs(a.actual_total_amount) AS amount,
      CASE WHEN b.bill_type IN ('ADJUST','ALLOT','DELIVERY','RESTOCK') THEN p.purpose ELSE b.bill_purpose END AS purpose,
      c.new_station_code AS in_code, c.new_station_name AS in_name, c.category_code AS in_type, c.category_code_flow AS in_flow,
      d.new_station_code AS out_code, d.new_station_name AS out_name, d.category_code AS out_type, d.category_code_flow AS out_flow,
      a.in_storage_code, a.out_storage_code, a.price, a.price * a.discount AS reduced,
      a.price * CAST('0.62' AS DECIMAL(3,2)) AS listed, h.cost
    FROM bill_lines a JOIN bills b ON a.bill_code = b.bill_code
    JOIN (VALUES ('OUT_STORAGE'), ('IN_STORAGE')) p(purpose)
      ON b.bill_type IN ('ADJUST','ALLOT','DELIVERY','RESTOCK') OR p.purpose = 'OUT_STORAGE'
    LEFT JOIN shops c ON b.in_station_code = c.new_station_code
    LEFT JOIN shops d ON b.out_station_code = d.new_station_code
    LEFT JOIN h ON a.goods_code = h.goods_code
    WHERE b.bill_type <> 'OTHER'
      AND CASE b.bill_type WHEN 'PURCHASE' THEN c.erp_date WHEN 'RETURNED' THEN d.erp_date
        ELSE coalesce(c.erp_date, d.erp_date) END > b.create_time
      AND (b.bill_type IN ('BATCH_SALE','PURCHASE','RETURNED') OR h.cost IS NOT NULL)),
  y AS (SELECT *, CASE bill_type WHEN 'PURCHASE' THEN false WHEN 'RETURNED' THEN true ELSE purpose = 'OUT_STORAGE' END AS at_out,
      bill_type IN ('ADJUST','ALLOT','DELIVERY','RESTOCK') AS both_ FROM x),
  z AS (SELECT *,
      CAST(CASE WHEN bill_type IN ('PRESENT','BATCH_SALE','PURCHASE','RETURNED') THEN reduced
        WHEN bill_type = 'ADJUST' THEN CASE WHEN in_flow = 'LOGISTICS' AND out_flow = 'LOGISTICS' THEN cost ELSE listed END
        ELSE CASE CASE WHEN bill_type = 'DELIVERY' THEN in_flow WHEN bill_type IN ('ALLOT','RESTOCK') THEN out_flow
            WHEN at_out THEN out_flow ELSE in_flow END
          WHEN 'BOOKSTORE' THEN listed WHEN 'LOGISTICS' THEN cost END END AS DECIMAL(18,4)) AS value FROM y),
  docs AS (SELECT bill_code, bill_type, purpose AS bill_purpose,
      CASE WHEN at_out THEN out_code ELSE in_code END AS from_location_code,
      CASE WHEN at_out THEN out_name ELSE in_name END AS from_location_name,
      CASE WHEN at_out THEN out_type ELSE in_type END AS from_location_type,
      CASE WHEN at_out THEN out_storage_code ELSE in_storage_code END AS from_location_storage,
      CASE WHEN both_ THEN CASE WHEN at_out THEN in_code ELSE out_code END END AS target_location_code,
      CASE WHEN both_ THEN CASE WHEN at_out THEN in_name ELSE out_name END END AS target_location_name,
      CASE WHEN both_ THEN CASE WHEN at_out THEN in_type ELSE out_type END END AS target_location_type,
      CASE WHEN both_ THEN CASE WHEN at_out THEN in_storage_code ELSE out_storage_code END END AS target_location_storage,
      goods_code, amount, CASE WHEN NOT at_out THEN value END AS inflow_price, CASE WHEN at_out THEN value END AS outflow_price,
      create_time, 'BI' AS origin_bill_type, id AS origin_bill_id FROM z)"""
_SOLD = """
  , sold AS (SELECT b.sale_order_code AS bill_code, 'SALE' AS bill_type,
      CASE sale_order_type WHEN 'ORDER' THEN 'OUT_STORAGE' ELSE 'IN_STORAGE' END AS bill_purpose,
      new_station_code AS from_location_code, new_station_name AS from_location_name, category_code AS from_location_type,
      storage_code AS from_location_storage, CAST(NULL AS BIGINT) AS target_location_code,
      CAST(NULL AS VARCHAR) AS target_location_name, CAST(NULL AS VARCHAR) AS target_location_type,
      CAST(NULL AS VARCHAR) AS target_location_storage, product_code AS goods_code, abs(sale_amount) AS amount,
      CASE WHEN sale_order_type = 'BACK_ORDER' THEN sale_real_price END AS inflow_price,
      CASE WHEN sale_order_type = 'ORDER' THEN sale_real_price END AS outflow_price,
      b.create_time, 'SO' AS origin_bill_type, b.id AS origin_bill_id
    FROM sale_detail a JOIN sale_order b USING (sale_order_code) JOIN shops c ON b.station_code = c.new_station_code
    WHERE c.erp_date > b.create_time)"""
_LEDGER_COLUMNS = f"""bill_code, bill_type, bill_purpose, from_location_code, from_location_name, from_location_type,
  from_location_storage, target_location_code, target_location_name, target_location_type, target_location_storage,
  goods_code, amount, {num('inflow_price', 'inflow_price')}, {num('outflow_price', 'outflow_price')},
  {_TIME} AS create_time, origin_bill_type, origin_bill_id"""
_FLOW = """CASE category_code_flow WHEN 'BOOKSTORE' THEN CAST(product_price * CAST('0.62' AS DECIMAL(3,2)) AS DECIMAL(18,4))
  WHEN 'LOGISTICS' THEN CAST(cost_price AS DECIMAL(18,4)) END"""

_WIDE = with_views("changes", "daily", "depots", "products", "suppliers", **_ONE_DAY, body=f"""
        , s AS ({{sales}}),
        b AS (SELECT station_code, supplier_code, product_code,
            sum(CASE WHEN category_code = 'BOOKSTORE' AND storage = 'NORMAL' THEN amount END) AS n,
            sum(CASE WHEN category_code = 'BOOKSTORE' AND storage IN ('NORMAL','ON_STORAGE') THEN amount END) AS ns,
            sum(CASE WHEN category_code = 'LOGISTICS' AND storage IN ('NORMAL','STORAGE') THEN amount END) AS l
          FROM daily JOIN depots ON station_code = new_station_code WHERE amount <> 0 GROUP BY 1, 2, 3),
        u AS (SELECT station_code, supplier_code, product_code, sale_amount_60d AS a, sale_amount_30d AS b, sale_amount_15d AS c,
            sale_amount_7d AS d, 0 AS n, 0 AS ns FROM s
          UNION ALL SELECT station_code, supplier_code, product_code, 0, 0, 0, 0, n, ns FROM b WHERE ns IS NOT NULL OR l IS NOT NULL),
        m AS (SELECT station_code, supplier_code, product_code, coalesce(sum(a), 0) AS a, coalesce(sum(b), 0) AS b,
            coalesce(sum(c), 0) AS c, coalesce(sum(d), 0) AS d, coalesce(sum(n), 0) AS n, coalesce(sum(ns), 0) AS ns FROM u GROUP BY 1, 2, 3),
        q AS (SELECT supplier_code, product_code, count(*) AS k FROM s WHERE sale_amount_30d IS NOT NULL GROUP BY 1, 2),
        e AS (SELECT supplier_code, product_code, logistic_code, count(*) AS k FROM (
            SELECT supplier_code, product_code, station_code FROM s WHERE sale_amount_30d IS NOT NULL
            UNION SELECT supplier_code, product_code, station_code FROM b WHERE ns IS NOT NULL)
          JOIN depots ON station_code = new_station_code GROUP BY 1, 2, 3)
        SELECT '{DAY}' AS date, m.station_code, m.supplier_code, m.product_code, CAST(m.a AS BIGINT) AS sale_amount_60d,
          CAST(m.b AS BIGINT) AS sale_amount_30d, CAST(m.c AS BIGINT) AS sale_amount_15d, CAST(m.d AS BIGINT) AS sale_amount_7d,
          {num('m.n', 'stock_amount_normal')}, {num('m.ns', 'stock_amount_normal_storage')},
          {num('coalesce(g.l, 0)', 'stock_amount_logis')}, q.k AS sale_station_count, e.k AS exist_station_count,
          new_station_name AS station_name, station_region_name, logistics_name, category_name AS station_type,
          product_name, product_isbn, {num('product_price', 'product_price')}, category_two_name, f.supplier_name
        FROM m JOIN depots c ON m.station_code = c.new_station_code
        LEFT JOIN b g ON g.l IS NOT NULL AND c.logistic_code = g.station_code AND m.supplier_code = g.supplier_code AND m.product_code = g.product_code
        LEFT JOIN q ON m.supplier_code = q.supplier_code AND m.product_code = q.product_code
        LEFT JOIN e ON m.supplier_code = e.supplier_code AND m.product_code = e.product_code AND c.logistic_code = e.logistic_code
        JOIN products p ON m.product_code = p.product_code LEFT JOIN suppliers f ON m.supplier_code = f.supplier_code""")

SQL = {
    "stock_change_erp": with_views("changes", body=f"""
        SELECT {_CHANGE}, {_TIME} AS create_time, {_TIME} AS stock_date, bill_code, 'ERP' AS origin_system FROM changes"""),
    "stock_change_center": with_views("changes", body=f"""
        SELECT {_CHANGE}, {_TIME} AS create_time, {_TIME} AS stock_date, offset_bill_code AS bill_code,
          'YH' AS origin_system FROM changes"""),
    "stock_change_combined": with_views("changes", "gifts", body=f"""
        SELECT {_CHANGE.replace('bill_type, offset', 'a.bill_type, a.offset').replace('batch_no,', 'a.batch_no,').replace('product_code', 'a.product_code').replace('CAST(price', 'CAST(a.price').replace("strftime(date", "strftime(a.date")},
          strftime(a.create_time, '%Y-%m-%d %H:%M:%S') AS create_time, d.order_code AS bill_code, e.sale_type,
          coalesce(f.present_reason, g.reason, h.reason) AS present_reason
        FROM (SELECT * EXCLUDE (bill_code) FROM changes) a
        JOIN papers d ON a.offset_bill_code = d.bill_code AND a.create_time = d.create_time
        LEFT JOIN (SELECT l_orderkey AS k, l_shipdate AS t, min(l_linestatus) AS sale_type FROM lineitem GROUP BY 1, 2) e
          ON d.order_code = e.k AND a.create_time = e.t
        LEFT JOIN gifts f ON a.offset_bill_code = f.code
        LEFT JOIN (SELECT DISTINCT l_orderkey AS k, l_shipdate AS t, '{GIFT_LABEL}' AS reason FROM lineitem WHERE l_returnflag = 'A') g
          ON a.offset_bill_code = g.k AND a.create_time = g.t
        LEFT JOIN (SELECT DISTINCT l_orderkey AS k, l_partkey AS p, l_shipdate AS t, '零售赠送' AS reason FROM lineitem WHERE l_linenumber = 5) h
          ON d.order_code = h.k AND a.product_code = h.p AND a.create_time = h.t"""),
    "book_stock_change": with_views("changes", "products", "storages", body=f"""
        SELECT a.station_code AS from_location_code, storage_name, {day('a.date', 'create_time')}, fina_category_name,
          {_CATS}, product_isbn, product_name, a.product_code, {num('product_price', 'product_price')},
          {num('sum(a.amount * a.price * -in_out_flag)', 'change_money')},
          CAST(sum(a.amount * -in_out_flag) AS BIGINT) AS change_amount,
          {num('sum(a.amount * a.flow_price * -in_out_flag)', 'price')},
          {num('sum(a.amount * a.cost_price * -in_out_flag)', 'cost_price')}
        FROM changes a LEFT JOIN storages b ON a.storage = b.storage_code
        JOIN products d ON a.product_code = d.product_code
        GROUP BY a.station_code, storage_name, a.date, fina_category_name, {_CATS}, product_isbn, product_name,
          a.product_code, product_price"""),
    "fine_by_category": with_views("changes", "products", "depots", "sale_order", body=f"""
        SELECT {day('a.date', 'create_time')}, a.bill_code AS payment_order_code, a.station_code AS from_location_code,
          d.sale_type_name, fina_category_name, {_CATS},
          {num('-sum(a.in_out_flag * a.amount * a.price)', 'sale_total_price')},
          {num('-sum(a.in_out_flag * a.amount * a.real_price)', 'sale_real_price')},
          {num('-sum(a.in_out_flag * a.amount * a.flow_price)', 'price')},
          {num('-sum(a.in_out_flag * a.amount * a.cost_price)', 'cost_price')}
        FROM changes a JOIN products b ON a.product_code = b.product_code
        JOIN depots c ON a.station_code = c.new_station_code AND c.category_code = 'BOOKSTORE'
        JOIN sale_order d ON a.bill_code = d.sale_order_code WHERE a.bill_type = 'SALE'
        GROUP BY a.date, a.bill_code, a.station_code, d.sale_type_name, fina_category_name, {_CATS}"""),
    "stock_backroll": with_views("daily", **_RANGE, body=f"""
        SELECT {day('date', 'date')}, batch_no, supplier_code, product_code, station_code, storage,
          {num('amount', 'amount')}, {num('price', 'price')}, {num('flow_price', 'flow_price')},
          {num('cost_price', 'cost_price')} FROM daily"""),
    "stock_snapshot": with_views("daily", "products", "storages", "depots", **_RANGE, body=f"""
        SELECT {day('a.date', 'date')}, a.station_code, new_station_name AS station_name, logistic_code,
          logistics_name AS logistic_name, station_region_name, storage_name AS operation_type_name, a.product_code,
          product_name, category_three_code, supplier_name, {num('product_price', 'product_price')},
          {num('total', 'current_total_price')}, {num('n', 'available_amount')}, {num('flow', 'price')},
          {num('cost', 'cost_price')}
        FROM ({_BAY}) a JOIN storages b ON a.storage = b.storage_code JOIN products c ON a.product_code = c.product_code
        JOIN depots d ON a.station_code = d.new_station_code"""),
    "latest_stock": with_views("daily", "products", "storages", **_RANGE, body=f"""
        SELECT {day('a.date', 'create_time')}, a.station_code AS location_code, storage_name AS operation_type_name,
          fina_category_name, product_name, a.product_code, {_CATS}, product_isbn, {num('product_price', 'product_price')},
          {num('total', 'current_total_price')}, {num('n', 'available_amount')}, {num('flow', 'price')},
          {num('cost', 'cost_price')}
        FROM ({_BAY}) a JOIN storages b ON a.storage = b.storage_code JOIN products c ON a.product_code = c.product_code
        WHERE a.date = DATE '{LAST}'"""),
    "supplier_stock": with_views("daily", "products", "depots", "suppliers", **_RANGE, body=f"""
        , p AS (SELECT date, category_two_name, a.supplier_code, product_state, logistic_code, logistics_name, a.product_code,
            sum(amount) AS n, sum(amount * price) AS t, sum(amount * cost_price) AS c
          FROM daily a JOIN depots b ON a.station_code = b.new_station_code JOIN products c ON a.product_code = c.product_code
          GROUP BY ALL HAVING sum(amount) <> 0)
        SELECT {day('date', 'create_time')}, category_two_name, p.supplier_code, supplier_name, product_state,
          logistic_code, logistics_name AS logistic_name, {num('sum(n)', 'stock_amount')},
          {num('sum(t)', 'stock_total_price')}, {num('sum(c)', 'stock_real_price')}, count(*) AS goods_code_amount
        FROM p LEFT JOIN suppliers s ON p.supplier_code = s.supplier_code
        GROUP BY date, category_two_name, p.supplier_code, supplier_name, product_state, logistic_code, logistics_name"""),
    "supplier_stock_now": with_views("stock", "products", "depots", "batch", body=f"""
        SELECT '{LAST}' AS create_time, category_two_name, c.supplier_code, c.supplier_name, product_state, logistic_code,
          logistics_name AS logistic_name, CAST(sum(available_amount) AS BIGINT) AS stock_amount,
          {num('sum(available_amount * product_price)', 'stock_total_price')},
          {num('sum(available_amount * e.cost_price)', 'stock_real_price')},
          count(DISTINCT a.goods_code) AS goods_code_amount
        FROM stock a JOIN depots b ON a.location_code = b.new_station_code JOIN products c ON a.goods_code = c.product_code
        JOIN batch e ON a.batch_no = e.batch_no AND a.goods_code = e.goods_code
        GROUP BY category_two_name, c.supplier_code, c.supplier_name, product_state, logistic_code, logistics_name"""),
    "emphasis_stock": with_views("daily", "products", "depots", "monitored", **_RANGE, body=f"""
        SELECT logistic_code, logistics_name, station_region_code, station_region_name, station_code, station_name,
          product_code, product_name, {num('local_amount', 'local_stock_amount')},
          {num('moving_amount', 'on_storage_stock_amount')} FROM ({_EMPHASIS_STOCK}) s"""),
    "trailing_sales": with_views("changes", body=_SALES),
    "shortage_wide": _WIDE.replace("{sales}", _SALES),
    "shortage_regular": _WIDE.replace("{sales}", _TYPED),
    "station_circulation": with_views("ledger", "batch", "products", body=f"""
        SELECT {day('a.create_time', 'create_time')}, bill_code, CASE bill_type WHEN 'DELIVERY' THEN '配送' ELSE '调剂' END AS bill_type_name,
          location_code AS from_location_code, location_name AS from_location_name, location_type AS from_station_type_name,
          target_code AS target_location_code, target_name AS target_location_name, target_type AS target_station_type_name,
          a.goods_code, product_name, product_isbn, {num('product_price', 'product_price')}, fina_category_code,
          fina_category_name, amount, {num('amount * product_price', 'total_price')},
          {num('amount * real_price', 'distribution_price')}, {num('amount * cost_price', 'stock_price')}
        FROM ledger a JOIN batch b USING (batch_no, goods_code) JOIN products d ON a.goods_code = d.product_code
        WHERE bill_type IN ('DELIVERY','ADJUST','RESTOCK','MISTAKE') AND bill_purpose = 'OUT_STORAGE'"""),
    "supplier_in_out": with_views("ledger", "batch", "products", body=f"""
        , s AS (SELECT a.create_time AS d, b.supplier_code, b.supplier_name, category_two_code, category_two_name, location_code,
            location_name, product_state, CASE WHEN bill_type = 'PURCHASE' THEN amount ELSE 0 END AS i,
            CASE WHEN bill_type = 'RETURNED' THEN amount ELSE 0 END AS o, product_price AS p, cost_price AS c
          FROM ledger a JOIN batch b USING (batch_no, goods_code) JOIN products x ON a.goods_code = x.product_code
          WHERE bill_type IN ('PURCHASE','RETURNED'))
        SELECT {day('d', 'create_time')}, supplier_code, supplier_name, category_two_code, category_two_name,
          location_code AS from_location_code, location_name AS from_location_name, product_state,
          CAST(sum(i) AS BIGINT) AS in_amount, {num('sum(i * p)', 'in_total_product')}, {num('sum(i * c)', 'in_cost')},
          CAST(sum(o) AS BIGINT) AS out_amount, {num('sum(o * p)', 'out_total_product')}, {num('sum(o * c)', 'out_cost')}
        FROM s GROUP BY d, supplier_code, supplier_name, category_two_code, category_two_name, location_code, location_name, product_state"""),
    "supplier_reconciliation": with_views("ledger", "batch", "products", body=f"""
        SELECT {day('a.create_time', 'create_time')}, bill_code,
          CASE bill_purpose WHEN 'OUT_STORAGE' THEN '退货' ELSE '进货' END AS bill_type_name, b.supplier_code, b.supplier_name,
          location_code AS from_location_code, location_name AS from_location_name, location_type AS station_type_name,
          a.goods_code, product_name, product_isbn, {num('product_price', 'product_price')}, fina_category_code,
          fina_category_name, amount * in_out_flag AS amount, {num('amount * product_price * in_out_flag', 'total_price')},
          {num('amount * real_price * in_out_flag', 'stock_price')}
        FROM ledger a JOIN batch b USING (batch_no, goods_code) JOIN products d ON a.goods_code = d.product_code
        WHERE bill_type IN ('PURCHASE','RETURNED')"""),
    "supplier_sale": with_views("changes", "products", "depots", body=f"""
        SELECT {day('a.create_time', 'create_time')}, category_two_name, new_station_code, b.supplier_code, b.supplier_name,
          product_state, CAST(-sum(amount) AS BIGINT) AS sale_amount, {num('-sum(amount * price)', 'sale_product_price')},
          {num('-sum(amount * cost_price)', 'sale_cost_price')}
        FROM changes a JOIN products b ON a.product_code = b.product_code JOIN depots c ON a.station_code = c.new_station_code
        WHERE bill_type IN ('SALE','BATCH_SALE')
        GROUP BY a.create_time, category_two_name, new_station_code, b.supplier_code, b.supplier_name, product_state"""),
    "wholesale": with_views("ledger", "batch", "stock", "products", body=f"""
        SELECT {day('a.create_time', 'create_time')}, a.location_code AS from_location_code, location_name AS from_location_name,
          location_type AS station_type_name, fina_category_code, fina_category_name,
          {num('sum(amount * product_price * -in_out_flag)', 'wholesale_real_price')},
          {num('sum(amount * real_price * -in_out_flag)', 'wholesale_total_price')},
          {num('sum(amount * flow_price * -in_out_flag)', 'distribution_price')},
          {num('sum(amount * cost_price * -in_out_flag)', 'stock_price')}
        FROM ledger a JOIN batch b USING (batch_no, goods_code)
        JOIN stock c USING (batch_no, goods_code, location_code, storage) JOIN products d ON a.goods_code = d.product_code
        WHERE bill_type = 'BATCH_SALE'
        GROUP BY a.create_time, a.location_code, location_name, location_type, fina_category_code, fina_category_name"""),
    "give_aways": with_views("changes", "depots", "products", "gifts", body=f"""
        SELECT {day('a.date', 'create_time')}, coalesce(present_reason, '其他赠送') AS discount_reasons,
          CASE in_out_flag WHEN -1 THEN '出库' ELSE '入库' END AS bill_purpose_name, a.station_code AS from_location_code,
          new_station_name AS from_location_name, CASE category_code {_STATION} END AS station_type_name,
          fina_category_code, fina_category_name, {num('sum(amount * price)', 'give_real_price')},
          {num('sum(amount * real_price)', 'give_total_price')}, {num('sum(amount * flow_price)', 'distribution_price')},
          {num('sum(amount * cost_price)', 'stock_price')}
        FROM changes a JOIN depots b ON a.station_code = b.new_station_code
        LEFT JOIN gifts c ON a.offset_bill_code = c.code JOIN products d ON a.product_code = d.product_code
        WHERE bill_type = 'PRESENT'
        GROUP BY a.date, present_reason, in_out_flag, a.station_code, new_station_name, category_code, fina_category_code, fina_category_name"""),
    "ledger_documents": with_views("bills", "bill_lines", "shops", "batch", body=f"""
        {_DOCS} SELECT '{BATCH}' AS batch_no, {_LEDGER_COLUMNS} FROM docs"""),
    "ledger_sales": with_views("sale_order", "sale_detail", "shops", body=f"""
        {_SOLD} SELECT '{BATCH}' AS batch_no, {_LEDGER_COLUMNS} FROM sold"""),
    "ledger_union": with_views("bills", "bill_lines", "shops", "batch", "sale_order", "sale_detail", body=f"""
        {_DOCS} {_SOLD}
        SELECT bill_type, bill_purpose, origin_bill_type, count(*) AS n, CAST(sum(amount) AS BIGINT) AS amount,
          {num('sum(amount * coalesce(inflow_price, outflow_price))', 'money')}
        FROM (SELECT * FROM docs UNION ALL SELECT * FROM sold) GROUP BY 1, 2, 3"""),
    "stock_of_batch": with_views("counted", "ledger", "depots", "products", "batch", body=f"""
        , r AS (
          SELECT station_code AS location_code, storage_code AS storage, a.goods_code, amount, product_price AS price, {_FLOW} AS flow
          FROM counted a JOIN depots b ON a.station_code = b.new_station_code AND bookstore_system = 'YH' AND amount > 0
          JOIN products c ON a.goods_code = c.product_code JOIN batch d ON d.batch_no = '{BATCH}' AND a.goods_code = d.goods_code
          UNION ALL
          SELECT location_code, storage, a.goods_code, 0, product_price, {_FLOW}
          FROM ledger a JOIN depots b ON a.location_code = b.new_station_code JOIN products c ON a.goods_code = c.product_code
          JOIN batch d ON d.batch_no = '{BATCH}' AND a.goods_code = d.goods_code
          WHERE a.batch_no = '{BATCH}' AND a.create_time = TIMESTAMP '2001-05-05')
        SELECT '{BATCH}' AS batch_no, location_code, new_station_name AS location_name, storage, goods_code,
          CAST(sum(amount) AS BIGINT) AS total_amount, CAST(sum(amount) AS BIGINT) AS available_amount, 0 AS used_amount,
          {num('max(price)', 'price')}, {num('max(flow)', 'flow_price')}, '2001-05-05' AS create_time
        FROM r JOIN depots ON location_code = new_station_code GROUP BY location_code, new_station_name, storage, goods_code"""),
    "stock_old_batches": with_views("ledger", "depots", "products", "batch", body=f"""
        SELECT DISTINCT a.batch_no, location_code, new_station_name AS location_name, storage, a.goods_code, 0 AS total_amount,
          0 AS available_amount, 0 AS used_amount, {num('product_price', 'price')}, {num(_FLOW, 'flow_price')},
          '2001-05-05' AS create_time
        FROM ledger a JOIN depots b ON a.location_code = b.new_station_code JOIN products c ON a.goods_code = c.product_code
        JOIN batch d ON d.batch_no = 'B2000' AND a.goods_code = d.goods_code
        WHERE a.batch_no <> 'B2000' AND a.create_time = TIMESTAMP '2001-05-05'"""),
    "stock_rebuilt": with_views("counted", "bills", "bill_lines", "sale_order", "sale_detail", body=f"""
        , m AS (SELECT b.*, a.goods_code, abs(a.actual_total_amount) AS n, a.in_storage_code, a.out_storage_code
          FROM bill_lines a JOIN bills b ON a.bill_code = b.bill_code AND b.create_time >= TIMESTAMP '1999-07-07'),
        r AS (
          SELECT station_code, storage_code, goods_code, amount FROM counted
          UNION ALL SELECT out_station_code, out_storage_code, goods_code, -n FROM m WHERE out_station_code IS NOT NULL
          UNION ALL SELECT in_station_code, in_storage_code, goods_code, n FROM m WHERE in_station_code IS NOT NULL
          UNION ALL SELECT b.station_code, a.storage_code, a.product_code,
            a.sale_amount * CASE sale_order_type WHEN 'ORDER' THEN -1 ELSE 1 END
          FROM sale_detail a JOIN sale_order b ON a.sale_order_code = b.sale_order_code AND b.create_time >= TIMESTAMP '1999-07-07')
        SELECT station_code, storage_code, goods_code, {num('sum(amount)', 'amount')} FROM r GROUP BY 1, 2, 3"""),
}
SQL["emphasis_with_stock"] = with_views(
    "daily", "products", "depots", "monitored", "sale_order", "sale_detail", **_RANGE, body=f"""
        , k AS (SELECT product_code AS p, count(*) AS w FROM monitored GROUP BY 1),
        r AS (SELECT a.create_time AS d, a.station_code AS s, b.product_code AS p,
            sum(w * b.sale_amount * a.in_out_flag) AS n1, sum(w * b.sale_amount * b.sale_price * a.in_out_flag) AS t1,
            sum(w * b.sale_amount * b.sale_real_price * a.in_out_flag) AS r1,
            sum(w * b.sale_amount * f) AS n2, sum(w * b.sale_amount * b.sale_price * f) AS t2,
            sum(w * b.sale_amount * b.sale_real_price * f) AS r2
          FROM (SELECT *, CASE sale_type WHEN 'O' THEN 1 WHEN 'F' THEN -1 ELSE 0 END AS f FROM sale_order) a
          JOIN sale_detail b USING (sale_order_code) JOIN k ON k.p = b.product_code GROUP BY 1, 2, 3)
        SELECT {day('d', 'date')}, s AS station_code, r.p AS product_code, CAST(n1 AS BIGINT) AS sale_amount,
          {num('t1', 'sale_totalmoney')}, {num('r1', 'sale_realmoney')}, CAST(n2 AS BIGINT) AS batch_sale_amount,
          {num('t2', 'batch_sale_totalmoney')}, {num('r2', 'batch_sale_realmoney')},
          {num('coalesce(local_amount, 0)', 'local_stock_amount')},
          {num('coalesce(moving_amount, 0)', 'on_storage_stock_amount')}
        FROM r LEFT JOIN ({_EMPHASIS_STOCK}) e ON e.station_code = r.s AND e.product_code = r.p""")
