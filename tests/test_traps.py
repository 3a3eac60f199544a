"""Tiny literal frames, one per rule that a naive Spark expression would break."""

from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from encore.functions.flags import later_than, present, ratio_or_zero
from encore.functions.temporal import coerce_ts, elapsed_days, strict_ts, whole_days, within_days
from encore.operators import grain, lifecycle, profile
from encore.operators.impute import impute_median
from encore.plans import preparation
from encore.sources.raw import without_nan


def values(df, *columns):
    return [tuple(row[c] for c in columns) for row in df.collect()]


def spans(spark, *pairs):
    rows = [(i, a, b) for i, (a, b) in enumerate(pairs)]
    text = spark.createDataFrame(rows, "i int, a string, b string")
    return coerce_ts(text, ["a", "b"]).orderBy("i")


def test_bad_timestamp_is_null_when_lenient_and_fails_when_strict(spark):
    text = spark.createDataFrame([("2018-01-02 03:04:05",), ("soon",), (None,)], "ts string")
    assert values(coerce_ts(text, ["ts"]), "ts") == [(datetime(2018, 1, 2, 3, 4, 5),), (None,), (None,)]
    assert strict_ts(text.where("ts IS NULL OR ts <> 'soon'"), ["ts"]).count() == 2
    with pytest.raises(Exception, match="not a timestamp"):
        strict_ts(text, ["ts"]).collect()


def test_whole_days_are_elapsed_periods_rounded_down(spark):
    df = spans(
        spark,
        ("2018-01-01 00:00:00", "2018-04-01 23:59:59.999999"),
        ("2018-01-01 23:00:00", "2018-04-02 01:00:00"),
        ("2018-01-01 12:00:00", "2018-01-01 10:00:00"),
        ("2018-01-02 12:00:00", "2018-01-01 12:00:00"),
        ("2018-01-02 12:00:00", "2018-01-01 10:00:00"),
        ("2018-01-01 00:00:00", "2018-04-02 00:00:00"),
        ("2018-01-01 00:00:00", "2018-01-01 00:00:00"),
        ("2018-01-01 00:00:00", None),
    )
    days = df.withColumn("d", whole_days(F.col("a"), F.col("b")))
    labelled = days.withColumn("label", within_days(F.col("d"), 90))
    assert values(labelled, "d", "label") == [
        (90, 1),
        (90, 1),
        (-1, 0),
        (-1, 0),
        (-2, 0),
        (91, 0),
        (0, 1),
        (None, 0),
    ]


@pytest.mark.parametrize("zone", ["UTC", "Europe/Berlin", "America/Sao_Paulo"])
def test_elapsed_days_ignore_the_session_zone(spark, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        df = spans(
            spark,
            ("2018-03-24 02:30:00", "2018-03-25 02:30:00"),
            ("2018-01-01 00:00:00", "2018-01-02 12:00:00"),
            ("2018-11-03 23:30:00", "2018-11-04 23:30:00"),
        )
        both = df.select("i", elapsed_days(F.col("a"), F.col("b")).alias("e"), whole_days(F.col("a"), F.col("b")).alias("w"))
        assert values(both.orderBy("i"), "e", "w") == [(1.0, 1), (1.5, 1), (1.0, 1)]
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_item_totals_without_price_are_zero(spark):
    items = spark.createDataFrame(
        [("a", 1, None), ("a", None, None), ("b", 1, Decimal("2.50")), (None, 1, Decimal("9.00"))],
        "order_id string, order_item_id int, price decimal(12,2)",
    )
    totals = grain.order_items_agg(items).orderBy("order_id")
    assert values(totals, "order_id", "order_item_cnt", "order_gmv") == [
        ("a", 1, Decimal("0.00")),
        ("b", 1, Decimal("2.50")),
    ]


def test_late_flag_with_unknown_estimate_is_zero(spark):
    df = spark.createDataFrame([(2, 1), (1, 2), (2, None), (None, 1)], "a int, b int")
    flagged = df.select(later_than(F.col("a"), F.col("b")).alias("late"), present(F.col("a")).alias("known"))
    assert values(flagged, "late", "known") == [(1, 1), (0, 1), (0, 1), (0, 0)]


def orders_frame(spark, rows):
    stamps = ["order_purchase_timestamp", "order_delivered_customer_date", "order_estimated_delivery_date"]
    schema = "order_id string, customer_id string, order_status string, " + ", ".join(f"{s} string" for s in stamps)
    return coerce_ts(spark.createDataFrame(rows, schema), stamps)


def shop(spark):
    orders = orders_frame(
        spark,
        [
            ("o1", "k1", "delivered", "2018-01-01 10:00:00", "2018-01-05 10:00:00", "2018-01-04 00:00:00"),
            ("o2", "k2", "delivered", "2018-01-01 10:00:00", "2018-01-03 10:00:00", None),
            ("o3", "k3", "delivered", "2018-02-01 00:00:00", "2018-02-02 00:00:00", "2018-02-05 00:00:00"),
            ("o4", "k4", "delivered", "2018-01-10 00:00:00", "2018-01-12 00:00:00", "2018-02-05 00:00:00"),
            ("o5", "k5", "delivered", "2018-01-02 00:00:00", None, "2018-02-05 00:00:00"),
            ("o6", "k6", "canceled", "2017-01-02 00:00:00", "2017-01-03 00:00:00", "2018-02-05 00:00:00"),
            ("o7", None, "delivered", "2018-12-31 00:00:00", "2019-01-03 00:00:00", "2019-02-05 00:00:00"),
            ("o8", "k8", "delivered", "not a time", "2019-01-03 00:00:00", "2019-02-05 00:00:00"),
            ("o9", "k9", "delivered", "2018-09-01 00:00:00", "2018-09-03 00:00:00", "2018-10-05 00:00:00"),
        ],
    )
    customers = spark.createDataFrame(
        [
            ("k1", "ann", None),
            ("k2", "ann", "SP"),
            ("k3", "ann", "RJ"),
            ("k4", "bob", "MG"),
            ("k5", "bob", "MG"),
            ("k6", "bob", "MG"),
            ("k8", "eve", "MG"),
            ("k9", "dan", "BA"),
            (None, "nobody", "XX"),
        ],
        "customer_id string, customer_unique_id string, customer_state string",
    )
    reviews = spark.createDataFrame(
        [("r1", "o1", 5.0), ("r2", "o1", 2.0), ("r3", "o3", None), ("r4", None, 1.0), ("r5", "o9", 1.0)],
        "review_id string, order_id string, review_score double",
    )
    items = spark.createDataFrame(
        [("o1", 1, Decimal("10.00")), ("o1", 2, Decimal("5.50")), ("o2", 1, None), ("o4", 1, Decimal("7.00"))],
        "order_id string, order_item_id int, price decimal(12,2)",
    )
    return {"orders": orders, "customers": customers, "reviews": reviews, "order_items": items}


def test_orders_keep_their_grain_and_missing_facts(spark):
    rows = {r["order_id"]: r for r in grain.order_event(shop(spark)).collect()}
    assert sorted(rows) == ["o1", "o2", "o3", "o4", "o7", "o8", "o9"]
    assert rows["o1"]["review_score_mean"] == 3.5
    assert (rows["o1"]["order_item_cnt"], rows["o1"]["order_gmv"]) == (2, Decimal("15.50"))
    assert (rows["o2"]["order_item_cnt"], rows["o2"]["order_gmv"]) == (1, Decimal("0.00"))
    assert (rows["o3"]["order_item_cnt"], rows["o3"]["order_gmv"]) == (0, Decimal("0.00"))
    assert [rows[o]["late_flag"] for o in ("o1", "o2", "o3")] == [1, 0, 0]
    # a review without a score leaves no mean, so it is no review
    assert [rows[o]["has_review"] for o in ("o1", "o2", "o3")] == [1, 0, 0]
    # an order without customer id matches no customer, not the one whose id is null
    assert rows["o7"]["customer_unique_id"] is None


def test_purchases_merge_orders_and_take_the_first_known_state(spark):
    events = {
        (r["customer_unique_id"], str(r["order_purchase_timestamp"])): r
        for r in preparation.purchase_event(shop(spark)).collect()
    }
    assert len(events) == 4  # no group for unknown customers or times
    merged = events["ann", "2018-01-01 10:00:00"]
    assert merged["customer_state"] == "SP"
    assert merged["delivery_days_mean"] == 3.0
    assert merged["first_event_review_score_mean"] == 3.5
    assert (merged["late_flag"], merged["has_review"]) == (1, 1)
    assert (merged["first_item_cnt"], merged["first_purchase_gmv"]) == (3, Decimal("15.50"))


def test_median_covers_customers_censored_later(spark):
    done = preparation.prepare(shop(spark))
    firsts = {r["customer_unique_id"]: r for r in done.first_purchase.collect()}
    assert firsts["ann"]["days_to_second_purchase"] == 30
    assert firsts["ann"]["purchase_2nd_within_90d"] == 1
    assert firsts["bob"]["second_purchase_ts"] is None
    assert firsts["bob"]["purchase_2nd_within_90d"] == 0
    base = {r["customer_unique_id"]: r for r in done.base_table.collect()}
    # dan's purchase is the end of the data: dan is censored, his score still counts
    assert sorted(base) == ["ann", "bob"]
    assert base["bob"]["first_event_review_score_mean"] == (3.5 + 1.0) / 2
    assert base["bob"]["has_review"] == 0
    assert done.base_table.columns == [
        "customer_unique_id",
        "first_purchase_ts",
        "delivery_days_mean",
        "first_event_review_score_mean",
        "late_flag",
        "has_review",
        "customer_state",
        "first_item_cnt",
        "first_purchase_gmv",
        "purchase_2nd_within_90d",
    ]


def test_end_of_data_is_the_last_event_of_any_rank_with_a_known_customer(spark):
    tables = shop(spark)
    # o7 is the newest order but has no customer: the end is dan's purchase
    done = preparation.prepare(tables)
    assert preparation.data_end(tables, done.first_purchase) == datetime(2018, 9, 1)
    assert grain.latest_purchase(tables, after=datetime(2018, 1, 1)) == datetime(2018, 9, 1)
    assert grain.latest_purchase(tables, after=datetime(2018, 9, 1)) == datetime(2018, 9, 1)
    # ann's third purchase is later than anyone's first and second
    third = orders_frame(spark, [("o10", "k10", "delivered", "2018-10-01 00:00:00", "2018-10-02 00:00:00", None)])
    tables["orders"] = tables["orders"].union(third)
    tables["customers"] = tables["customers"].union(spark.createDataFrame([("k10", "ann", "SP")], tables["customers"].schema))
    done = preparation.prepare(tables)
    assert preparation.data_end(tables, done.first_purchase) == datetime(2018, 10, 1)
    nobody = {**tables, "customers": tables["customers"].where("false")}
    done = preparation.prepare(nobody)
    assert preparation.data_end(nobody, done.first_purchase) is None
    assert done.base_table.count() == 0


def test_censoring_bound_is_inclusive_and_monotone(spark):
    firsts = spans(spark, ("2018-01-01 00:00:00", None), ("2018-01-01 00:00:01", None), ("2017-01-01 00:00:00", None))
    until = datetime(2018, 4, 1)
    kept = [lifecycle.censor(firsts, "a", until, h).count() for h in (0, 89, 90, 91, 455, 456)]
    assert kept == [3, 3, 2, 1, 1, 0]


def test_median_can_be_fitted_on_other_rows(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (10.0,), (None,)], "x double")
    assert sorted(values(impute_median(df, "x"), "x")) == [(1.0,), (2.0,), (2.5,), (3.0,), (10.0,)]
    train = df.where("x < 3")
    assert (1.5,) in values(impute_median(df, "x", fit_on=train), "x")
    nothing = df.where("x IS NULL")
    assert values(impute_median(nothing, "x"), "x") == [(None,)]


def test_nan_counts_as_unknown(spark):
    df = without_nan(spark.createDataFrame([(float("nan"), 1), (1.0, None), (3.0, 2)], "x double, y int"))
    assert dict(values(profile.null_profile(df), "column_name", "null_cnt")) == {"x": 1, "y": 1}
    assert df.agg(F.avg("x")).first()[0] == 2.0
    typed = profile.schema_profile(df).orderBy("column_name")
    assert values(typed, "column_name", "data_type", "non_null_cnt") == [("x", "double", 2), ("y", "int", 2)]


def test_shares_are_over_known_values(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",), (None,)], "v string")
    assert sorted(values(profile.value_counts(df, "v"), "value", "cnt")) == [("a", 2), ("b", 1)]
    shares = dict(values(profile.value_share(df, "v"), "value", "share"))
    assert shares == pytest.approx({"a": 2 / 3, "b": 1 / 3})


def test_ratio_of_nothing_is_zero(spark):
    assert spark.range(1).select(ratio_or_zero(F.lit(1), F.lit(0)).alias("r")).first()["r"] == 0.0


def test_duplicate_customers_are_reported_not_dropped(spark):
    customers = spark.createDataFrame([("k", "a"), ("k", "b"), ("l", "c"), (None, "d"), (None, "e")], "customer_id string, u string")
    assert values(grain.duplicate_keys(customers, ["customer_id"]), "customer_id", "cnt") == [("k", 2)]


def test_repeated_keys_are_an_error_on_request(spark):
    tables = shop(spark)
    preparation.prepare(tables, check_keys=True)
    for name in ("customers", "orders"):
        twice = {**tables, name: tables[name].union(tables[name])}
        with pytest.raises(ValueError, match="not unique"):
            preparation.prepare(twice, check_keys=True)
