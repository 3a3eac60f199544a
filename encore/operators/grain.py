"""Bringing every input to one row per order, then one row per purchase event.

Reviews and items are aggregated to the order before they are joined, so no join
multiplies rows.  Group keys are filtered for null first: a null key names no
order and no customer.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from encore.functions.flags import later_than, present
from encore.functions.temporal import elapsed_days, ts_literal

DELIVERED = "delivered"

ORDER_COLUMNS = [
    "order_id",
    "customer_unique_id",
    "order_purchase_timestamp",
    "order_delivered_customer_date",
    "order_estimated_delivery_date",
    "customer_state",
    "review_score_mean",
    "order_item_cnt",
    "order_gmv",
]


def review_profile(reviews: DataFrame) -> DataFrame:
    """Review counts and score statistics per order, with a repeat flag."""
    score = F.col("review_score")
    return (
        reviews.where(F.col("order_id").isNotNull())
        .groupBy("order_id")
        .agg(
            F.count("review_id").alias("review_cnt"),
            F.count_distinct("review_id").alias("review_id_nunique"),
            F.avg(score).alias("review_score_mean"),
            F.min(score).alias("review_score_min"),
            F.max(score).alias("review_score_max"),
        )
        .withColumn("multi_review_flag", F.col("review_cnt") > 1)
    )


def review_order_agg(reviews: DataFrame) -> DataFrame:
    """Mean review score per order."""
    return (
        reviews.where(F.col("order_id").isNotNull())
        .groupBy("order_id")
        .agg(F.avg("review_score").alias("review_score_mean"))
    )


def order_items_agg(order_items: DataFrame) -> DataFrame:
    """Item count and order value per order; no known price at all sums to 0."""
    return (
        order_items.where(F.col("order_id").isNotNull())
        .groupBy("order_id")
        .agg(
            F.count("order_item_id").alias("order_item_cnt"),
            F.coalesce(F.sum("price"), F.lit(0)).alias("order_gmv"),
        )
    )


def delivered_orders(orders: DataFrame) -> DataFrame:
    return orders.where(F.col("order_status") == DELIVERED)


def join_customers(orders: DataFrame, customers: DataFrame) -> DataFrame:
    """Attach the person behind the order's customer id; unmatched orders stay."""
    people = customers.where(F.col("customer_id").isNotNull()).select(
        "customer_id", "customer_unique_id", "customer_state"
    )
    return orders.join(people, "customer_id", "left")


def join_order_facts(orders: DataFrame, reviews: DataFrame, order_items: DataFrame) -> DataFrame:
    """Attach the review mean and the item totals; orders without items get 0."""
    return (
        orders.join(review_order_agg(reviews), "order_id", "left")
        .join(order_items_agg(order_items), "order_id", "left")
        .na.fill(0, ["order_item_cnt", "order_gmv"])
        .select(*ORDER_COLUMNS)
    )


def order_base(raw: dict[str, DataFrame]) -> DataFrame:
    """Delivered orders with customer, review mean and item totals."""
    orders = join_customers(delivered_orders(raw["orders"]), raw["customers"])
    return join_order_facts(orders, raw["reviews"], raw["order_items"])


def arrived(orders: DataFrame) -> DataFrame:
    return orders.where(F.col("order_delivered_customer_date").isNotNull())


def order_event(raw: dict[str, DataFrame]) -> DataFrame:
    """One row per order that has arrived, with delivery and review indicators."""
    bought = F.col("order_purchase_timestamp")
    delivered = F.col("order_delivered_customer_date")
    return arrived(order_base(raw)).withColumns(
        {
            "delivery_days": elapsed_days(bought, delivered),
            "late_flag": later_than(delivered, F.col("order_estimated_delivery_date")),
            "has_review": present(F.col("review_score_mean")),
        }
    )


def purchase_event(orders: DataFrame) -> DataFrame:
    """One row per customer and purchase time.

    Orders placed by one customer at the same instant are one purchase.  The
    state is that of the smallest order id with a known state.  The natural
    (customer, time) grouping is aggregated before it is shuffled and spreads a
    heavy customer over many tasks.
    """
    customer, bought = F.col("customer_unique_id"), F.col("order_purchase_timestamp")
    return (
        orders.where(customer.isNotNull() & bought.isNotNull())
        .groupBy(customer, bought)
        .agg(
            F.avg("delivery_days").alias("delivery_days_mean"),
            F.avg("review_score_mean").alias("first_event_review_score_mean"),
            F.max("late_flag").alias("late_flag"),
            F.max("has_review").alias("has_review"),
            F.expr(
                "min_by(customer_state, order_id) FILTER (WHERE customer_state IS NOT NULL)"
            ).alias("customer_state"),
            F.sum("order_item_cnt").alias("first_item_cnt"),
            F.sum("order_gmv").alias("first_purchase_gmv"),
        )
    )


def latest_purchase(raw: dict[str, DataFrame], after: datetime | None) -> datetime | None:
    """The time of the latest purchase event later than ``after``, else ``after``.

    A purchase event is an arrived order with a known customer.  Only orders
    placed after the given time are looked up; how they are joined is left to
    adaptive execution, which sees their size.  Runs one job.
    """
    ts = "order_purchase_timestamp"
    later = arrived(delivered_orders(raw["orders"])).where(F.col(ts) > ts_literal(after)).select("customer_id", ts)
    known = raw["customers"].where(F.col("customer_unique_id").isNotNull()).select("customer_id")
    return later.join(known, "customer_id").agg(F.max(ts)).first()[0] or after


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that occur more than once, with their number of rows."""
    known = df.dropna("any", subset=keys)
    return known.groupBy(*keys).agg(F.count("*").alias("cnt")).where(F.col("cnt") > 1)


def assert_unique(df: DataFrame, keys: list[str]) -> DataFrame:
    """Return ``df`` if its keys are unique, else fail.  Runs a job."""
    if duplicate_keys(df, keys).head(1):
        raise ValueError(f"not unique on {', '.join(keys)}")
    return df
