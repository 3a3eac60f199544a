"""Distributed order against a single sort, and the shape of the plans."""

import random

import numpy as np
import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from encore.operators import lifecycle, ordering


def frame(spark, n=5000, hot=0.4, parts=7, seed=1):
    """Ids with a heavily tied key: one value holds a good third of the rows."""
    draw = random.Random(seed)
    rows = [(i, 7 if draw.random() < hot else draw.randrange(50), draw.random()) for i in range(n)]
    draw.shuffle(rows)
    return spark.createDataFrame(rows, "id long, key int, x double").repartition(parts)


def test_index_equals_a_global_row_number(spark):
    df = frame(spark)
    index = ordering.global_index(df, [F.col("key"), F.col("id")])
    expected = df.withColumn("rn", F.row_number().over(Window.orderBy("key", "id")) - 1)
    wrong = index.join(expected.select("id", "rn"), "id").where("_index <> rn").count()
    assert wrong == 0
    assert index.count() == 5000


def test_hot_key_is_spread_over_tasks(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        placed = ordering.write_in_order(frame(spark, hot=0.9), [F.col("key"), F.col("id")])
        sizes = placed.groupBy(ordering.part_of_slot()).count()
        assert sizes.count() == 4
        assert sizes.agg(F.max("count")).first()[0] < 0.4 * 5000
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


@pytest.mark.parametrize(("n", "fraction"), [(5000, 0.8), (7, 0.8), (1, 0.8), (1, 1.0), (9, 0.1), (10, 0.1), (10, 0.0)])
def test_split_takes_exactly_the_truncated_share(spark, n, fraction):
    split = ordering.time_split(frame(spark, n=n), "key", "id", fraction)
    assert split.train.count() == int(n * fraction)
    assert split.test.count() == n - int(n * fraction)
    assert split.rows.where("split = 'train'").count() == int(n * fraction)


def test_top_fraction_equals_sort_and_slice(spark):
    df = frame(spark)
    top = sorted(r["id"] for r in ordering.top_fraction(df, "key", "id", 0.25).collect())
    data = df.toPandas().sort_values(["key", "id"], ascending=[False, True])
    assert top == sorted(data["id"][: int(len(data) * 0.25)])


@pytest.fixture
def small_steps(monkeypatch):
    """Ranges are divided down to a few values, so that every branch runs."""
    monkeypatch.setattr(ordering, "FETCH_ROWS", 12)
    monkeypatch.setattr(ordering, "PIVOTS", 64)


def tied(spark, kind):
    """A third of the rows on one value, ties told apart by ``kind``; null times too."""
    tie = {"string": F.concat(F.lit("k\u00e9"), F.col("id")), "bigint": F.col("id") + (1 << 60)}[kind]
    ts = F.expr("timestamp_ntz'2024-03-31 01:30:00.000001'")
    time = F.when(F.col("id") % 3 == 0, ts).when(F.col("id") % 11 != 0, ts + F.make_dt_interval((F.col("id") * 37 % 19 - 9).cast("int")))
    score = F.when(F.col("id") % 3 == 0, 0.5).when(F.col("id") % 13 == 0, float("nan")).when(F.col("id") % 7 != 0, F.col("id") % 50 / 50.0)
    return spark.range(400).select(time.alias("ts"), tie.alias("tie"), score.alias("score")).repartition(5)


@pytest.mark.parametrize("kind", ["string", "bigint"])
@pytest.mark.parametrize("fraction", [0.3, 0.5, 0.97])
def test_cuts_equal_a_sort(spark, small_steps, kind, fraction):
    df = tied(spark, kind)
    n = int(400 * fraction)
    early = [r["tie"] for r in df.orderBy("ts", "tie").limit(n).collect()]
    split = ordering.time_split(df, "ts", "tie", fraction)
    assert sorted(r["tie"] for r in split.train.collect()) == sorted(early)
    assert split.test.count() == 400 - n
    best = [r["tie"] for r in df.orderBy(F.desc("score"), "tie").limit(n).collect()]
    assert sorted(r["tie"] for r in ordering.top_fraction(df, "score", "tie", fraction).collect()) == sorted(best)
    assert ordering.mark_top_fraction(df, "score", "tie", fraction).where("in_top").count() == n


def test_cuts_of_no_rows_and_of_equal_rows(spark, small_steps):
    none = spark.createDataFrame([], "ts int, tie int")
    assert ordering.time_split(none, "ts", "tie").train.count() == 0
    assert ordering.top_fraction(none, "ts", "tie").count() == 0
    same = spark.createDataFrame([(1, 1)] * 50, "ts int, tie int")
    split = ordering.time_split(same, "ts", "tie")
    assert (split.train.count(), split.test.count()) == (40, 10)
    assert split.train.columns == split.test.columns == ["ts", "tie"]
    assert split.rows.columns == ["ts", "tie", "split"]


def test_rows_equal_in_all_keys_are_divided(spark):
    """A hundred equal rows, and a hot value among others; the extra column tells the rows apart."""
    equal = spark.range(100).select(F.lit(0.5).alias("score"), F.lit("t").alias("tie"), F.col("id").alias("n"))
    top = ordering.top_fraction(equal.repartition(7), "score", "tie", 0.1)
    assert top.columns == ["score", "tie", "n"] and top.count() == 10
    rows = spark.range(900).select(
        F.when(F.col("id") % 3 == 0, 0.5).when(F.col("id") % 3 == 1, F.col("id") / 900).alias("score"),
        F.lit(None).cast("string").alias("tie"),
        F.col("id").alias("n"),
    )
    for fraction in (0.05, 0.5, 0.7):
        marked = ordering.mark_top_fraction(rows.repartition(5), "score", "tie", fraction)
        assert marked.columns == ["score", "tie", "n", "in_top"] and marked.count() == 900
        assert marked.where("in_top").count() == int(900 * fraction)
        taken = [r.score for r in marked.where("in_top").collect()]
        left = [r.score for r in marked.where("NOT in_top").collect()]
        low = lambda s: -1.0 if s is None else s
        assert min(map(low, taken)) >= max(map(low, left), default=-2)
        again = ordering.top_fraction(rows.repartition(5), "score", "tie", fraction)
        assert again.select("n").distinct().count() == int(900 * fraction)


@pytest.mark.parametrize("values", ["id % 2", "IF(id < 3000, 7, id)", "IF(id % 3 = 0, 5, IF(id % 3 = 1, 9, id % 1000 / 250 + 5))", "pow(id, 3)", "-1"])
@pytest.mark.parametrize("q", [0.333, 0.5])
def test_neighbours_on_both_sides_of_a_range(spark, small_steps, values, q):
    df = spark.range(6000).select(F.expr(values).cast("double").alias("x")).repartition(4)
    want = float(np.quantile([r.x for r in df.collect()], q))
    assert ordering.exact_quantiles(df, ["x"], q)["x"] == pytest.approx(want, rel=1e-12)


def jobs(spark, run):
    """How many Spark jobs ``run`` starts."""
    name = f"jobs-{random.random()}"
    spark.sparkContext.setJobGroup(name, name)
    try:
        run()
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    return len(spark.sparkContext.statusTracker().getJobIdsForGroup(name))


def test_a_cut_takes_three_passes_and_all_medians_two(spark, tmp_path):
    frame(spark, n=20_000, hot=0.0).withColumn("y", F.col("x") * F.col("key")).write.parquet(str(tmp_path / "t"))
    stored = spark.read.parquet(str(tmp_path / "t"))
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # which makes a job of every stage
    try:
        assert jobs(spark, lambda: ordering.time_split(stored, "x", "id")) <= 3
        assert jobs(spark, lambda: ordering.top_fraction(stored, "key", "id")) <= 3
        assert jobs(spark, lambda: ordering.exact_quantiles(stored, ["x", "y", "id", "key"])) <= 2
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_median_inside_a_large_bucket(spark, small_steps):
    data = pd.Series([r["x"] for r in frame(spark, n=400).collect()])
    assert ordering.exact_quantiles(frame(spark, n=400), ["x", "key"]) == {
        "x": data.median(),
        "key": float(pd.Series([r["key"] for r in frame(spark, n=400).collect()]).median()),
    }


def test_rank_of_a_heavy_entity_equals_a_window(spark):
    df = frame(spark)
    ranked = lifecycle.event_rank(df, "key", "id", "rank")
    expected = df.withColumn("rn", F.row_number().over(Window.partitionBy("key").orderBy("id")))
    assert ranked.join(expected.select("id", "rn"), "id").where("rank <> rn").count() == 0
    assert ranked.columns == ["key", "id", "x", "rank"] or set(ranked.columns) == {"id", "key", "x", "rank"}


def test_running_totals_equal_a_cumulative_sum(spark):
    df = frame(spark)
    counts = df.groupBy(F.col("x").alias("x")).agg(F.count("*").alias("cnt"), F.sum("id").alias("ids"))
    for descending in (True, False):
        got = ordering.running_totals(counts, "x", ["cnt", "ids"], descending).toPandas()
        got = got.sort_values("x", ascending=not descending)
        assert (got["cnt_upto"] == got["cnt"].cumsum()).all()
        assert (got["ids_upto"] == got["ids"].cumsum()).all()
        assert len(got) == 5000


def test_buckets_are_balanced_by_keys(spark):
    """99 of 100 rows on five scores: the others spread over the buckets all the same."""
    spark.conf.set("spark.sql.shuffle.partitions", "50")
    try:
        rows = spark.range(200_000).select(
            F.when(F.col("id") % 100 > 0, F.col("id") % 5 / 5).otherwise(F.col("id") / 200_000).alias("x")
        )
        counts = rows.groupBy("x").agg(F.count("*").alias("cnt")).cache()
        model = ordering._bucket_model(counts.select("x"), ["x"])
        sizes = [r["count"] for r in model.transform(counts).groupBy("_bucket_x").count().collect()]
        assert max(sizes) <= 2 * counts.count() / 50
        got = ordering.running_totals(counts, "x", ["cnt"], False).toPandas().sort_values("x")
        assert (got["cnt_upto"] == got["cnt"].cumsum()).all() and len(got) == sum(sizes)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_running_totals_with_one_single_key(spark):
    df = spark.createDataFrame([(0.5,)] * 20, "x double")
    counts = df.groupBy("x").agg(F.count("*").alias("cnt"))
    row = ordering.running_totals(counts, "x", ["cnt"], True).first()
    assert (row["cnt"], row["cnt_upto"]) == (20, 20)


finite = st.floats(-1e6, 1e6, allow_nan=False)


@settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.one_of(finite, st.just(3.0), st.none()), min_size=1, max_size=60), st.sampled_from([0.5, 0.5, 0.25, 1.0]))
def test_quantiles_are_exact(spark, xs, q):
    df = spark.createDataFrame([(x, 1.0) for x in xs], "x double, one double").repartition(3)
    got = ordering.exact_quantiles(df, ["x", "one"], q)
    known = [x for x in xs if x is not None]
    expected = float(np.quantile(known, q)) if known else None
    assert got["one"] == 1.0
    assert got["x"] == (pytest.approx(expected, rel=1e-12, abs=1e-9) if known else None)


def test_median_of_many_distinct_values(spark):
    data = pd.Series([r["x"] for r in frame(spark, n=3001).collect()])
    assert ordering.exact_quantiles(frame(spark, n=3001), ["x"])["x"] == data.median()


def test_nan_and_infinity_in_quantiles(spark):
    df = spark.createDataFrame([(float("nan"),), (float("-inf"),), (1.0,), (float("inf"),), (2.0,), (3.0,)], "x double")
    assert ordering.exact_quantiles(df, ["x"])["x"] == 2.0
