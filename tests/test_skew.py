"""The same queries on tables in which one key holds a third of all rows."""

import duckdb
import pytest

import __spark_entry__ as entry
from oracle import TABLES, compare, connect

SOURCE = "/root/testdata/sf0.001"
QUERIES, SQL = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    out = tmp_path_factory.mktemp("skewed")
    con = duckdb.connect()
    changes = {
        "lineitem": "* REPLACE (CASE WHEN {t} THEN 7 ELSE l_orderkey END AS l_orderkey,"
        " CASE WHEN {t} THEN 3 ELSE l_partkey END AS l_partkey,"
        " CASE WHEN {t} THEN 1 ELSE l_suppkey END AS l_suppkey,"
        " CASE WHEN {t} THEN TIMESTAMP '2001-06-20' ELSE l_shipdate END AS l_shipdate)".format(
            t="hash(l_orderkey, l_linenumber, l_extendedprice) % 3 = 0"
        ),
        "events": "* REPLACE (CASE WHEN hash(event_id) % 3 = 0 THEN 5 ELSE user_id END AS user_id)",
    }
    for name in TABLES:
        pick = changes.get(name, "*")
        con.execute(
            f"COPY (SELECT {pick} FROM read_parquet('{SOURCE}/{name}.parquet'))"
            f" TO '{out}/{name}.parquet' (FORMAT parquet)"
        )
    return str(out)


@pytest.mark.parametrize(
    "name",
    [
        "sale_by_category", "pay_by_category", "money_section", "marketing_activities",
        "sale_monitor", "emphasis_sale", "card_recharge_consume", "card_denomination",
        "stock_change_erp", "stock_backroll", "trailing_sales", "station_circulation",
        "give_aways", "ledger_documents", "stock_rebuilt", "latest_price", "unified_details",
        "log_step_metrics", "product_wide", "fine_by_category", "stock_change_combined",
        "supplier_in_out", "supplier_reconciliation", "wholesale", "ledger_sales",
        "trailing_sales_all_days", "stock_from_snapshot", "stock_change_bucketed", "exist_station_count",
        "log_resumed", "lineage_metrics_join",
    ],
)
def test_hot_key(spark, folder, name):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        problem = compare(QUERIES[name](spark, folder), connect(folder), SQL[name], rel=1e-12)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10485760")
    assert problem is None, problem
