"""The raw tables, derived from a star schema of orders and line items.

The fixture data holds no reviews or deliveries; these views map its tables onto
the raw schemas by fixed rules (see FIXTURES.md).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# the columns the views read
COLUMNS = {
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_orderdate timestamp_ntz",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_linenumber int, l_extendedprice double, "
    "l_returnflag string",
    "customer": "c_custkey bigint, c_nationkey int",
    "nation": "n_nationkey int, n_name string",
}

_WEEK = "cast(trunc(cast(o_orderdate AS date), 'week') AS timestamp_ntz)"


def _week_plus(hours: str) -> str:
    return f"{_WEEK} + make_dt_interval(0, cast({hours} AS int))"


def star_orders(orders: DataFrame) -> DataFrame:
    return orders.selectExpr(
        "o_orderkey AS order_id",
        "CASE WHEN o_orderkey % 499 != 0 THEN o_orderkey END AS customer_id",
        "CASE WHEN o_orderstatus = 'O' THEN 'shipped' ELSE 'delivered' END AS order_status",
        f"{_week_plus('(o_orderkey % 3) * 8')} AS order_purchase_timestamp",
        f"CASE WHEN o_orderkey % 97 != 0 THEN "
        f"{_week_plus('(o_orderkey % 3) * 8 + 24 + (o_orderkey * 37) % 700')} END "
        "AS order_delivered_customer_date",
        f"CASE WHEN o_orderkey % 211 != 0 THEN {_week_plus('360')} END AS order_estimated_delivery_date",
    )


def star_customers(orders: DataFrame, customer: DataFrame, nation: DataFrame) -> DataFrame:
    homes = orders.join(customer, orders.o_custkey == customer.c_custkey).selectExpr(
        "o_orderkey AS customer_id",
        "o_custkey * 10 + (year(o_orderdate) - 1995) AS customer_unique_id",
        "(c_nationkey + o_orderkey % 2) % 25 AS home",
    )
    return homes.join(nation, homes.home == nation.n_nationkey).selectExpr(
        "customer_id",
        "customer_unique_id",
        "CASE WHEN customer_id % 53 != 0 THEN n_name END AS customer_state",
    )


def star_reviews(lineitem: DataFrame) -> DataFrame:
    return lineitem.selectExpr(
        "l_orderkey * 10 + l_linenumber AS review_id",
        "CASE WHEN l_returnflag = 'R' AND l_orderkey % 4 != 0 THEN l_orderkey END AS order_id",
        "CASE WHEN l_partkey % 41 != 0 THEN 1D + cast(l_partkey % 400 AS double) / 100D END AS review_score",
    )


def star_items(lineitem: DataFrame) -> DataFrame:
    return lineitem.selectExpr(
        "l_orderkey AS order_id",
        "l_linenumber AS order_item_id",
        "cast(l_extendedprice AS decimal(12,2)) AS price",
    )


def star_raw(spark: SparkSession, directory: str) -> dict[str, DataFrame]:
    """The four raw tables over a directory of star-schema Parquet files."""

    def table(name: str) -> DataFrame:
        return spark.read.schema(COLUMNS[name]).parquet(f"{directory.rstrip('/')}/{name}.parquet")

    orders, lineitem = table("orders"), table("lineitem")
    return {
        "orders": star_orders(orders),
        "customers": star_customers(orders, table("customer"), table("nation")),
        "reviews": star_reviews(lineitem),
        "order_items": star_items(lineitem),
    }
