"""Metrics against brute force, including ties and missing classes."""

import numpy as np
import random

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from encore.operators import evaluate

row = st.tuples(st.integers(0, 1), st.integers(0, 1), st.sampled_from([0.1, 0.2, 0.2, 0.35, 0.5, 0.9]))
some_rows = st.lists(row, min_size=1, max_size=40)
few = settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))


def scored(spark, rows):
    data = [(i, y, pred, p) for i, (y, pred, p) in enumerate(rows)]
    return spark.createDataFrame(data, "id long, y_true int, y_pred int, y_prob double").repartition(3)


def brute_auc(y, p):
    pos, neg = p[y == 1], p[y == 0]
    if not len(pos) or not len(neg):
        return None
    wins = (pos[:, None] > neg).sum() + 0.5 * (pos[:, None] == neg).sum()
    return wins / (len(pos) * len(neg))


def brute_average_precision(y, p):
    if not (y == 1).any():
        return 0.0
    total, before = 0.0, 0.0
    for threshold in sorted(set(p), reverse=True):
        above = p >= threshold
        recall = (y[above] == 1).sum() / (y == 1).sum()
        total += (recall - before) * (y[above] == 1).mean()
        before = recall
    return total


def div(a, b):
    return a / b if b else 0.0


@few
@given(some_rows)
def test_ranking_metrics(spark, rows):
    y, p = np.array([r[0] for r in rows]), np.array([r[2] for r in rows])
    got = evaluate.ranking_metrics(evaluate.score_curve(scored(spark, rows))).first()
    auc = brute_auc(y, p)
    assert got["roc_auc"] == (None if auc is None else pytest.approx(auc, abs=1e-12))
    assert got["pr_auc"] == pytest.approx(brute_average_precision(y, p), abs=1e-12)


@few
@given(some_rows)
def test_threshold_metrics_and_report(spark, rows):
    df = scored(spark, rows)
    cell = {(a, b): sum(1 for y, q, _ in rows if (y, q) == (a, b)) for a in (0, 1) for b in (0, 1)}
    matrix = {(r["actual"], r["predicted"]): r["cnt"] for r in evaluate.confusion_matrix(df).collect()}
    assert matrix == cell
    per_class = {}
    for c in (0, 1):
        precision = div(cell[c, c], cell[0, c] + cell[1, c])
        recall = div(cell[c, c], cell[c, 0] + cell[c, 1])
        per_class[c] = (precision, recall, div(2 * precision * recall, precision + recall), cell[c, 0] + cell[c, 1])
    accuracy = (cell[0, 0] + cell[1, 1]) / len(rows)
    one = evaluate.threshold_metrics(df).first()
    assert tuple(one) == pytest.approx((accuracy, *per_class[1][:3]))
    report = {r["label"]: tuple(r)[1:] for r in evaluate.classification_report(df).collect()}
    assert report["0"] == pytest.approx(per_class[0])
    assert report["1"] == pytest.approx(per_class[1])
    assert report["accuracy"] == (None, None, pytest.approx(accuracy), len(rows))
    for i in range(3):
        assert report["macro avg"][i] == pytest.approx((per_class[0][i] + per_class[1][i]) / 2)
        weighted = (per_class[0][i] * per_class[0][3] + per_class[1][i] * per_class[1][3]) / len(rows)
        assert report["weighted avg"][i] == pytest.approx(weighted)


def test_curves(spark):
    rows = [(1, 1, 0.9), (0, 1, 0.8), (1, 1, 0.8), (1, 0, 0.4), (0, 0, 0.1)]
    curve = evaluate.score_curve(scored(spark, rows))
    roc = sorted((r["fpr"], r["tpr"]) for r in evaluate.roc_curve(curve).collect())
    assert np.allclose(roc, [(0, 0), (0, 1 / 3), (0.5, 2 / 3), (0.5, 1), (1, 1)])
    points = {r["threshold"]: (r["precision"], r["recall"]) for r in evaluate.pr_curve(curve).collect()}
    assert points[None] == (1.0, 0.0)
    assert points[0.8] == pytest.approx((2 / 3, 2 / 3))
    assert points[0.1] == pytest.approx((3 / 5, 1.0))


def test_area_is_unchanged_by_a_monotone_score_change(spark):
    df = scored(spark, [(int(i % 3 == 0), 0, (i * 37 % 100) / 100) for i in range(200)])
    squashed = df.withColumn("y_prob", F.exp(3 * F.col("y_prob")) - 100)
    areas = [evaluate.ranking_metrics(evaluate.score_curve(d)).first() for d in (df, squashed)]
    assert tuple(areas[0]) == pytest.approx(tuple(areas[1]), abs=1e-12)


def test_lift(spark):
    rows = [(1 if i in (0, 1, 2, 17) else 0, 0, 1 - i / 20) for i in range(20)]
    lift = evaluate.top_fraction_lift(scored(spark, rows), "id").first()
    assert (lift["top_rows"], lift["top_positives"]) == (2, 2)
    assert (lift["overall_rate"], lift["top_rate"], lift["lift"]) == pytest.approx((0.2, 1.0, 5.0))


def test_lift_of_too_few_rows_is_unknown(spark):
    lift = evaluate.top_fraction_lift(scored(spark, [(1, 1, 0.5), (0, 0, 0.1)]), "id").first()
    assert (lift["top_rows"], lift["top_rate"], lift["lift"]) == (0, None, None)


@pytest.mark.parametrize("seed", [1, 2, 3])
@pytest.mark.parametrize("buckets", ["2", "9"])
def test_collinear_points_are_dropped(spark, seed, buckets):
    """Second differences of both counts, computed on the whole sorted curve."""
    chance = random.Random(seed)
    rows = [(int(chance.random() < 0.2), 0, round(chance.random(), 2)) for _ in range(seed * 120)]
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", buckets)
    try:
        curve = evaluate.score_curve(scored(spark, rows)).cache()
        points = curve.toPandas().sort_values("y_prob", ascending=False)
        fp, tp = points["fp"].to_numpy(), points["tp"].to_numpy()
        keep = np.r_[True, (np.diff(fp, 2) != 0) | (np.diff(tp, 2) != 0), True]
        want = sorted(zip(fp[keep].tolist(), tp[keep].tolist())) + [(0, 0)]
        got = [(r.fp, r.tp) for r in evaluate.roc_curve(curve, drop_collinear=True).collect()]
        assert sorted(got) == sorted(want) and 2 < len(got) < len(fp) + 1
        assert evaluate.without_collinear(curve).columns == curve.columns
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_short_curves_keep_their_ends(spark):
    for scores in ([0.5], [0.5, 0.7]):
        curve = evaluate.score_curve(scored(spark, [(i % 2, 0, s) for i, s in enumerate(scores)])).cache()
        assert evaluate.without_collinear(curve).count() == len(scores)
