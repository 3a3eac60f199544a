"""Declared schemas.  Nothing is inferred from the data."""

from __future__ import annotations

from pyspark.sql import types as T

_string = T.StringType()
_long = T.LongType()
_int = T.IntegerType()
_double = T.DoubleType()
_timestamp = T.TimestampNTZType()
_money = T.DecimalType(12, 2)


def _schema(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in columns.items()])


ORDERS = _schema(
    order_id=_string,
    customer_id=_string,
    order_status=_string,
    order_purchase_timestamp=_timestamp,
    order_delivered_customer_date=_timestamp,
    order_estimated_delivery_date=_timestamp,
)
CUSTOMERS = _schema(customer_id=_string, customer_unique_id=_string, customer_state=_string)
REVIEWS = _schema(review_id=_string, order_id=_string, review_score=_double)
ORDER_ITEMS = _schema(order_id=_string, order_item_id=_int, price=_money)

RAW = {
    "orders": ORDERS,
    "customers": CUSTOMERS,
    "reviews": REVIEWS,
    "order_items": ORDER_ITEMS,
}

BASE_TABLE = _schema(
    customer_unique_id=_string,
    first_purchase_ts=_timestamp,
    delivery_days_mean=_double,
    first_event_review_score_mean=_double,
    late_flag=_int,
    has_review=_int,
    customer_state=_string,
    first_item_cnt=_long,
    first_purchase_gmv=T.DecimalType(18, 2),
    purchase_2nd_within_90d=_int,
)


def with_types(schema: T.StructType, **kinds: T.DataType) -> T.StructType:
    """The same schema with some column types replaced (e.g. bigint keys)."""
    return T.StructType([T.StructField(f.name, kinds.get(f.name, f.dataType)) for f in schema])
