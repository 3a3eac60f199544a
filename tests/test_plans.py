"""Plan shapes that must hold at scale."""

import re

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from encore.operators import evaluate, grain, lifecycle, ordering, profile
from encore.plans import preparation
from encore.sources.raw import load_raw
from encore.sources.star import star_raw

SF_DIR = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def raw(spark, tmp_path_factory):
    """The raw tables as Parquet files of their own, as a cluster would hold them."""
    folder = tmp_path_factory.mktemp("raw")
    tables = star_raw(spark, SF_DIR)
    for name, table in tables.items():
        table.write.parquet(str(folder / f"{name}.parquet"))
    return load_raw(spark, str(folder), "parquet", schemas={name: t.schema for name, t in tables.items()})


@pytest.fixture
def no_broadcast(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_filters_and_columns_reach_the_scan(raw):
    text = plan(grain.order_event(raw))
    scan = next(line for line in text.splitlines() if "FileScan" in line and "/orders.parquet" in line)
    assert "EqualTo(order_status,delivered)" in scan
    assert "IsNotNull(order_delivered_customer_date)" in scan
    items = plan(grain.order_items_agg(raw["order_items"]).select("order_id", "order_item_cnt"))
    assert re.search(r"ReadSchema: struct<order_id:bigint,order_item_id:int>", items)


def test_joins_shuffle_on_keys_and_nothing_meets_in_one_task(raw, no_broadcast):
    text = plan(preparation.first_purchase(preparation.purchase_event(raw)))
    assert "SinglePartition" not in text
    assert "CartesianProduct" not in text and "NestedLoop" not in text and "Broadcast" not in text
    shuffles = [re.sub(r"#\d+L?", "", s) for s in re.findall(r"hashpartitioning\(([^)]*), \d+\)", text)]
    # the two order joins share one shuffle of the orders
    assert sorted(shuffles) == sorted(
        ["customer_id", "customer_id"] + ["order_id"] * 3
        + ["customer_unique_id, order_purchase_timestamp", "customer_unique_id"]
    )


def test_two_events_per_customer_are_cut_before_the_shuffle(raw):
    text = plan(preparation.first_purchase(preparation.purchase_event(raw)))
    above, below = text.split("hashpartitioning(customer_unique_id", 1)
    assert "Final" in above.rsplit("WindowGroupLimit", 1)[1]
    assert "WindowGroupLimit" in below and "Partial" in below
    # aggregation by (customer, time) happens before and after its own shuffle
    assert "partial_avg(delivery_days" in below


def test_map_side_aggregation_everywhere(raw):
    for df in (
        grain.review_order_agg(raw["reviews"]),
        grain.order_items_agg(raw["order_items"]),
        profile.value_counts(raw["orders"], "order_status"),
        profile.null_profile(raw["orders"]),
    ):
        assert "partial_" in plan(df)


def test_curve_gathers_only_bucket_totals(spark):
    rows = spark.range(1000).select(
        (F.col("id") % 2).cast("int").alias("y_true"), (F.col("id") / 1000.0).alias("y_prob")
    )
    text = plan(evaluate.score_curve(rows))
    single = [line for line in text.splitlines() if "SinglePartition" in line]
    assert len(single) == 1
    position = text.splitlines().index(single[0])
    child = text.splitlines()[position + 1]
    assert "HashAggregate" in child and "_bucket" in child


@pytest.mark.parametrize("part", ["train", "test"])
def test_split_parts_are_pushed_filters_of_the_table_itself(spark, tmp_path, part):
    rows = spark.range(100).select(F.col("id"), (F.col("id") * 7 % 100).alias("ts"), F.lit("x").alias("wide"))
    rows.write.parquet(str(tmp_path / "rows"))
    split = ordering.time_split(spark.read.parquet(str(tmp_path / "rows")), "ts", "id")
    text = plan(getattr(split, part).select("id"))
    scan = next(line for line in text.splitlines() if "PushedFilters" in line)
    assert ("LessThan(ts," if part == "train" else "GreaterThanOrEqual(ts,") in scan
    assert "wide" not in scan
    assert "Exchange" not in text and "Sort" not in text and "_slot" not in text


def test_top_rows_need_no_sort(spark):
    rows = spark.range(1000).select(F.col("id"), (F.col("id") * 7 % 100 / 3).alias("score"))
    text = plan(ordering.top_fraction(rows, "score", "id"))
    assert "Exchange" not in text and "Sort" not in text


def test_curves_scan_the_scored_rows_once(spark, tmp_path):
    rows = spark.range(1000).select(
        (F.col("id") % 2).cast("int").alias("y_true"), (F.col("id") / 1000.0).alias("y_prob")
    )
    rows.write.parquet(str(tmp_path / "scored"))
    scored = spark.read.parquet(str(tmp_path / "scored"))
    curve = evaluate.score_curve(scored)
    for points in (evaluate.roc_curve(curve), evaluate.pr_curve(curve)):
        points.collect()
        # the counts per score were written in the one pass; nothing goes back to the rows
        final = plan(points).split("== Initial Plan ==")[0]
        reads = [line for line in final.splitlines() if "FileScan" in line]
        assert reads and all("pos:bigint" in line and "y_true" not in line for line in reads)


def test_ranks_of_a_heavy_customer_need_no_shuffle_by_customer(spark, no_broadcast):
    rows = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, -7).otherwise(F.col("id")).cast("bigint").alias("key"), F.col("id").alias("ts")
    )
    ranked = lifecycle.event_rank(rows, "key", "ts", "rank")
    text = plan(ranked)
    assert "SortMergeJoin" not in text and "ShuffledHashJoin" not in text
    assert not re.search(r"hashpartitioning\(key#", text)
    assert ranked.where("key = -7").agg(F.max("rank")).first()[0] == 1000
    assert ranked.where("key <> -7").agg(F.max("rank")).first()[0] == 1


def test_ranks_shuffle_all_columns_once(spark, no_broadcast):
    rows = spark.range(3000).select((F.col("id") % 7).alias("key"), F.col("id").alias("ts"), F.uuid().alias("wide"))
    lines = plan(lifecycle.event_rank(rows, "key", "ts", "rank")).splitlines()
    # the sorted write is scanned bucket by bucket, and none of its rows are dealt anew
    scans = [line for line in lines if "FileScan" in line]
    assert any("wide" in line for line in scans) and all("Bucketed: true" in line for line in scans)
    assert not any("hashpartitioning" in line for line in lines)


def test_ranks_over_many_parts_equal_a_window(spark):
    rows = spark.range(5000).select(
        F.when(F.col("id") % 3 == 0, None).otherwise(F.col("id") % 40).alias("key"),
        (F.col("id") * 7919 % 5000).alias("ts"),
        F.col("id").alias("payload"),
    )
    ranked = lifecycle.event_rank(rows, "key", "ts", "rank").select("payload", F.col("rank").cast("int").alias("rank"))
    plain = rows.withColumn("rank", F.row_number().over(Window.partitionBy("key").orderBy("ts")))
    assert sorted(ranked.collect()) == sorted(plain.select("payload", "rank").collect())
