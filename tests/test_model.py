"""The fitted regression against an independent Newton solve of its objective."""

import numpy as np
import pandas as pd
import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from encore.operators import features, model, projection
from encore.operators.features import ModelColumns
from encore.plans import modelling
from encore.plans.evaluation import evaluation

COLUMNS = ModelColumns()


def base_table(spark, n=1500, seed=3):
    draw = np.random.default_rng(seed)
    days, review = draw.gamma(3, 4, n), draw.uniform(1, 5, n)
    late, reviewed = draw.integers(0, 2, n), draw.integers(0, 2, n)
    state = draw.choice(["SP", "RJ", "MG", None], n, p=[0.5, 0.2, 0.2, 0.1])
    z = 0.05 * days - 0.4 * review + 0.8 * late - 1 + (state == "SP") * 0.5
    label = (draw.uniform(0, 1, n) < 1 / (1 + np.exp(-z))).astype(int)
    schema = (
        "customer_unique_id string, first_purchase_ts long, delivery_days_mean double, "
        "first_event_review_score_mean double, late_flag int, has_review int, customer_state string, "
        "first_item_cnt long, first_purchase_gmv double, purchase_2nd_within_90d int"
    )
    rows = [
        (
            f"c{i:05d}",
            20180000 + i // 3,
            float(days[i]),
            None if i % 29 == 0 else float(review[i]),
            int(late[i]),
            int(reviewed[i]),
            state[i],
            1 + i % 4,
            10.0 + i % 7,
            int(label[i]),
        )
        for i in range(n)
    ]
    return spark.createDataFrame(rows, schema).repartition(5)


def design(train: pd.DataFrame, rows: pd.DataFrame) -> np.ndarray:
    """Median-imputed and scaled numbers, sorted one-hot states, flags."""
    parts = []
    for c in COLUMNS.numeric:
        median = train[c].median()
        fitted = train[c].fillna(median)
        parts.append(((rows[c].fillna(median) - fitted.mean()) / fitted.std(ddof=0)).to_numpy()[:, None])
    states = sorted(train["customer_state"].fillna(features.MISSING).unique())
    known = rows["customer_state"].fillna(features.MISSING)
    parts.append(np.stack([(known == s).to_numpy(float) for s in states], axis=1))
    parts.append(rows[list(COLUMNS.binary)].to_numpy(float))
    return np.hstack(parts)


def newton(x: np.ndarray, y: np.ndarray, steps: int = 50) -> np.ndarray:
    """Minimise sum(s_i log loss) + |w|^2 / 2 with a free intercept."""
    n, weights = len(y), np.where(y == 1, len(y) / (2 * y.sum()), len(y) / (2 * (len(y) - y.sum())))
    x1 = np.hstack([x, np.ones((n, 1))])
    penalty = np.diag([1.0] * x.shape[1] + [0.0])
    w = np.zeros(x1.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-x1 @ w))
        gradient = x1.T @ (weights * (p - y)) + penalty @ w
        hessian = (x1 * (weights * p * (1 - p))[:, None]).T @ x1 + penalty
        w = w - np.linalg.solve(hessian, gradient)
    return w


def test_fit_equals_newton(spark, tmp_path):
    run = modelling.train_and_score(base_table(spark))
    train, test = run.split.train.toPandas(), run.split.test.toPandas()
    assert (len(train), len(test)) == (1200, 300)
    expected = newton(design(train, train), train[COLUMNS.label].to_numpy())
    regression = run.model.stages[-1]
    got = np.append(regression.coefficients.toArray(), regression.intercept)
    assert np.abs(got - expected).max() < 1e-6

    scored = run.scored.toPandas().set_index("customer_unique_id")
    z = design(train, test) @ expected[:-1] + expected[-1]
    probability = pd.Series(1 / (1 + np.exp(-z)), index=test["customer_unique_id"])
    assert np.abs(scored["y_prob"] - probability).max() < 1e-6
    assert ((scored["y_prob"] > 0.5).astype(int) == scored["y_pred"]).all()

    # the fitted pipeline can be saved, loaded and applied again
    run.model.write().save(str(tmp_path / "model"))
    again = model.score(PipelineModel.load(str(tmp_path / "model")), run.split.test)
    assert again.join(run.scored.select("customer_unique_id", F.col("y_prob").alias("p")), "customer_unique_id").where(
        "y_prob <> p"
    ).count() == 0

    tables = evaluation(run.scored)
    metrics = {r["metric"]: r["value"] for r in tables.metrics.collect()}
    assert set(metrics) == {"accuracy", "precision", "recall", "f1", "roc_auc", "pr_auc"}
    assert metrics["roc_auc"] > 0.6
    assert tables.lift.first()["top_rows"] == 30
    assert tables.confusion.agg(F.sum("cnt")).first()[0] == 300
    assert tables.report.count() == 5
    assert tables.roc.count() == tables.precision_recall.count()


def test_unseen_state_is_all_zeros_and_missing_is_a_state(spark):
    train = spark.createDataFrame([("b",), ("a",), (features.MISSING,)], "customer_state_known string")
    rows = spark.createDataFrame([("a",), ("b",), ("z",), (features.MISSING,)], "customer_state_known string")
    stages = features.encoder_stages(COLUMNS)
    indexed = stages[0].fit(train)
    encoded = stages[1].fit(indexed.transform(train)).transform(indexed.transform(rows))
    vectors = {r["customer_state_known"]: list(r["customer_state_onehot"].toArray()) for r in encoded.collect()}
    assert vectors["z"] == [0.0, 0.0, 0.0]
    assert vectors[features.MISSING] == [1.0, 0.0, 0.0]  # sorts before lower case
    assert (vectors["a"], vectors["b"]) == ([0.0, 1.0, 0.0], [0.0, 0.0, 1.0])


def test_constant_column_is_only_centred(spark):
    df = spark.createDataFrame([(4.0, 1.0), (4.0, 2.0), (4.0, None)], "a double, b double")
    statistics = features.numeric_statistics(df, ("a", "b"))
    assert statistics["a"] == (4.0, 4.0, 1.0)
    assert statistics["b"] == pytest.approx((1.5, 1.5, np.std([1.0, 2.0, 1.5])))


def test_class_weights_balance(spark):
    df = spark.createDataFrame([(1,)] * 2 + [(0,)] * 6, "y int")
    weights = {r["y"]: (r["cnt"], r["weight"]) for r in features.class_weights(df, "y").collect()}
    assert weights == {1: (2, 2.0), 0: (6, pytest.approx(8 / 12))}


def test_one_class_is_refused(spark):
    df = base_table(spark, n=60).withColumn("purchase_2nd_within_90d", F.lit(0))
    with pytest.raises(ValueError, match="labels must be 0 and 1"):
        model.fit(df)


def test_value_and_gmv_stay_out_unless_asked(spark):
    df = base_table(spark, n=300)
    narrow = model.fit(df).stages[-1].numFeatures
    wide = model.fit(df, ModelColumns(numeric=(*COLUMNS.numeric, "first_item_cnt", "first_purchase_gmv"), unused=()))
    assert (narrow, wide.stages[-1].numFeatures) == (8, 10)


def test_a_solver_that_gives_up_is_no_fit(spark):
    with pytest.raises(ArithmeticError, match="gradient"):
        model.fit(base_table(spark, n=300), max_iter=1)


def test_the_projection_scores_as_the_pipeline(spark):
    rows = base_table(spark)
    new_states = rows.withColumn("customer_state", F.when(F.col("first_purchase_ts") % 5 == 0, "new").otherwise(F.col("customer_state")))
    fitted = model.fit(rows, COLUMNS)
    plain = projection.compiled(fitted, COLUMNS)
    assert set(plain.categorical["customer_state"]) == {"MG", "RJ", "SP", features.MISSING}
    for given in (rows, new_states):
        slow = model.score(fitted, given, COLUMNS).select("customer_unique_id", F.col("y_prob").alias("p"), F.col("y_pred").alias("d"))
        fast = plain.score(given, COLUMNS.label)
        assert fast.columns == [*given.columns, "y_true", "y_prob", "y_pred"]
        both = fast.join(slow, "customer_unique_id")
        assert both.count() == 1500
        assert both.where((F.abs(F.col("y_prob") - F.col("p")) > 1e-12) | (F.col("y_pred") != F.col("d"))).count() == 0


def test_many_categories_are_looked_up(spark, monkeypatch):
    rows = base_table(spark, n=200)
    weights = {"SP": 0.5, "RJ": -0.25, features.MISSING: 2.0}
    plain = projection.LinearModel(0.1, {}, {"customer_state": weights}, {})
    inside = {r["customer_unique_id"]: r["y_prob"] for r in plain.score(rows).collect()}
    monkeypatch.setattr(projection, "MOST_BRANCHES", 2)
    joined = plain.score(rows)
    assert joined.columns == [*rows.columns, "y_prob", "y_pred"]
    assert {r["customer_unique_id"]: r["y_prob"] for r in joined.collect()} == inside


def test_scoring_is_one_projection(spark, tmp_path):
    base_table(spark).write.parquet(str(tmp_path / "t"))
    plain = projection.LinearModel(
        0.1, {"delivery_days_mean": projection.Scaled(1.0, 2.0, 3.0, 4.0)}, {"customer_state": {"SP": 1.0}}, {"late_flag": 1.0}
    )
    scored = plain.score(spark.read.parquet(str(tmp_path / "t"))).select("customer_unique_id", "y_prob")
    text = scored._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in text and "UDF" not in text and "vector" not in text.lower()
    assert "first_purchase_gmv" not in text


def test_the_check_of_a_wide_model_is_a_small_plan(spark):
    """Five thousand categories: the gradient is 0 and the plan as small as with five."""
    few, many = (
        base_table(spark, n=n).withColumn("customer_state", F.concat(F.lit("c"), F.expr(f"hash(customer_unique_id) % {k}")))
        for n, k in ((1500, 5), (12_000, 5000))
    )
    sizes = []
    for rows in (few, many):
        ones = rows.where(F.col(COLUMNS.label) == 1).count()
        n = rows.count()
        weighted = rows.withColumn("weight", F.when(F.col(COLUMNS.label) == 1, n / (2 * ones)).otherwise(n / (2 * (n - ones))))
        fitted = model.fit(rows, COLUMNS)
        lines = model.optimality(fitted, weighted, COLUMNS)
        sizes.append((len(lines._jdf.queryExecution().optimizedPlan().toString()), lines.count()))
        assert lines.agg(F.max(F.abs("gradient"))).first()[0] < 1e-6
    assert sizes[1][1] > 4000 and sizes[1][0] < 2 * sizes[0][0]
