"""The fixture queries as SQL for another engine (DuckDB dialect).

Each statement is built from common table expressions over the fixture tables;
only those it needs are included.
"""

from __future__ import annotations

import re

# name -> SELECT, each using only names above it
STEPS = {
    "r_orders": """
        SELECT o_orderkey AS order_id,
               CASE WHEN o_orderkey % 499 <> 0 THEN o_orderkey END AS customer_id,
               CASE WHEN o_orderstatus = 'O' THEN 'shipped' ELSE 'delivered' END AS order_status,
               date_trunc('week', o_orderdate) + to_hours(CAST((o_orderkey % 3) * 8 AS BIGINT))
                   AS order_purchase_timestamp,
               CASE WHEN o_orderkey % 97 <> 0 THEN date_trunc('week', o_orderdate)
                   + to_hours(CAST((o_orderkey % 3) * 8 + 24 + (o_orderkey * 37) % 700 AS BIGINT)) END
                   AS order_delivered_customer_date,
               CASE WHEN o_orderkey % 211 <> 0 THEN date_trunc('week', o_orderdate)
                   + to_hours(CAST(360 AS BIGINT)) END AS order_estimated_delivery_date
        FROM orders""",
    "r_customers": """
        SELECT o_orderkey AS customer_id,
               o_custkey * 10 + (year(o_orderdate) - 1995) AS customer_unique_id,
               CASE WHEN o_orderkey % 53 <> 0 THEN n_name END AS customer_state
        FROM orders
        JOIN customer ON o_custkey = c_custkey
        JOIN nation ON n_nationkey = (c_nationkey + o_orderkey % 2) % 25""",
    "r_reviews": """
        SELECT l_orderkey * 10 + l_linenumber AS review_id,
               CASE WHEN l_returnflag = 'R' AND l_orderkey % 4 <> 0 THEN l_orderkey END AS order_id,
               CASE WHEN l_partkey % 41 <> 0
                   THEN CAST(1 AS DOUBLE) + CAST(l_partkey % 400 AS DOUBLE) / CAST(100 AS DOUBLE) END
                   AS review_score
        FROM lineitem""",
    "r_items": """
        SELECT l_orderkey AS order_id, l_linenumber AS order_item_id,
               CAST(l_extendedprice AS DECIMAL(12,2)) AS price
        FROM lineitem""",
    "review_stats": """
        SELECT order_id, count(review_id) AS review_cnt, count(DISTINCT review_id) AS review_id_nunique,
               avg(review_score) AS review_score_mean, min(review_score) AS review_score_min,
               max(review_score) AS review_score_max, count(review_id) > 1 AS multi_review_flag
        FROM r_reviews WHERE order_id IS NOT NULL GROUP BY order_id""",
    "review_mean": """
        SELECT order_id, avg(review_score) AS review_score_mean
        FROM r_reviews WHERE order_id IS NOT NULL GROUP BY order_id""",
    "item_totals": """
        SELECT order_id, count(order_item_id) AS order_item_cnt,
               CAST(coalesce(sum(price), 0) AS DECIMAL(18,2)) AS order_gmv
        FROM r_items WHERE order_id IS NOT NULL GROUP BY order_id""",
    "with_customer": """
        SELECT o.*, c.customer_unique_id, c.customer_state
        FROM r_orders o LEFT JOIN r_customers c ON o.customer_id = c.customer_id
        WHERE o.order_status = 'delivered'""",
    "base_orders": """
        SELECT o.order_id, o.customer_unique_id, o.order_purchase_timestamp,
               o.order_delivered_customer_date, o.order_estimated_delivery_date, o.customer_state,
               r.review_score_mean, coalesce(i.order_item_cnt, 0) AS order_item_cnt,
               CAST(coalesce(i.order_gmv, 0) AS DECIMAL(18,2)) AS order_gmv
        FROM with_customer o
        LEFT JOIN review_mean r ON o.order_id = r.order_id
        LEFT JOIN item_totals i ON o.order_id = i.order_id""",
    "arrived": """
        SELECT *,
               date_diff('microsecond', order_purchase_timestamp, order_delivered_customer_date)
                   / CAST(86400000000 AS DOUBLE) AS delivery_days,
               CASE WHEN order_delivered_customer_date > order_estimated_delivery_date
                   THEN 1 ELSE 0 END AS late_flag,
               CASE WHEN review_score_mean IS NOT NULL THEN 1 ELSE 0 END AS has_review
        FROM base_orders WHERE order_delivered_customer_date IS NOT NULL""",
    "purchases": """
        SELECT customer_unique_id, order_purchase_timestamp,
               avg(delivery_days) AS delivery_days_mean,
               avg(review_score_mean) AS first_event_review_score_mean,
               max(late_flag) AS late_flag, max(has_review) AS has_review,
               arg_min(customer_state, order_id) FILTER (WHERE customer_state IS NOT NULL) AS customer_state,
               CAST(sum(order_item_cnt) AS BIGINT) AS first_item_cnt,
               CAST(sum(order_gmv) AS DECIMAL(18,2)) AS first_purchase_gmv
        FROM arrived
        WHERE customer_unique_id IS NOT NULL AND order_purchase_timestamp IS NOT NULL
        GROUP BY customer_unique_id, order_purchase_timestamp""",
    "ranked": """
        SELECT *, row_number() OVER (PARTITION BY customer_unique_id ORDER BY order_purchase_timestamp)
                   AS purchase_event_rank
        FROM purchases""",
    "spans": """
        SELECT f.*, s.order_purchase_timestamp AS second_purchase_ts,
               CAST(floor(date_diff('microsecond', f.order_purchase_timestamp, s.order_purchase_timestamp)
                   / CAST(86400000000 AS DOUBLE)) AS INTEGER) AS days_to_second_purchase
        FROM ranked f
        LEFT JOIN ranked s ON s.customer_unique_id = f.customer_unique_id AND s.purchase_event_rank = 2
        WHERE f.purchase_event_rank = 1""",
    "firsts": """
        SELECT customer_unique_id, order_purchase_timestamp AS first_purchase_ts, delivery_days_mean,
               first_event_review_score_mean, late_flag, has_review, customer_state, first_item_cnt,
               first_purchase_gmv, CAST(purchase_event_rank AS INTEGER) AS purchase_event_rank,
               second_purchase_ts, days_to_second_purchase,
               CASE WHEN days_to_second_purchase BETWEEN 0 AND 90 THEN 1 ELSE 0 END
                   AS purchase_2nd_within_90d
        FROM spans""",
    "filled": """
        SELECT * REPLACE (coalesce(first_event_review_score_mean,
                   (SELECT median(first_event_review_score_mean) FROM firsts)) AS first_event_review_score_mean)
        FROM firsts""",
    "base": """
        SELECT customer_unique_id, first_purchase_ts, delivery_days_mean, first_event_review_score_mean,
               late_flag, has_review, customer_state, first_item_cnt, first_purchase_gmv,
               purchase_2nd_within_90d
        FROM filled
        WHERE first_purchase_ts <= (SELECT max(order_purchase_timestamp) FROM purchases) - INTERVAL 90 DAY""",
    "parts": """
        SELECT *, CASE WHEN row_number() OVER (ORDER BY first_purchase_ts, customer_unique_id)
                   <= floor(count(*) OVER () * CAST(0.8 AS DOUBLE)) THEN 'train' ELSE 'test' END AS split
        FROM base""",
    "train": "SELECT * FROM parts WHERE split = 'train'",
    "first_parts": """
        SELECT *, CASE WHEN row_number() OVER (ORDER BY first_purchase_ts, customer_unique_id)
                   <= floor(count(*) OVER () * CAST(0.8 AS DOUBLE)) THEN 'train' ELSE 'test' END AS split
        FROM firsts""",
    "fixed_margins": """
        SELECT customer_unique_id, purchase_2nd_within_90d AS y_true,
               CAST(-0.75 AS DOUBLE) + (coalesce(delivery_days_mean, 9.5) - 12.25) / 8.5 * 0.4
                   - (coalesce(first_event_review_score_mean, 4.0) - 3.75) / 1.25 * 0.6
                   + CASE customer_state WHEN 'NATION_3' THEN 0.5 WHEN 'NATION_11' THEN -0.25 WHEN 'NATION_20' THEN 1.5
                          ELSE CASE WHEN customer_state IS NULL THEN 0.125 ELSE 0 END END
                   + 0.875 * late_flag - 0.375 * has_review AS margin
        FROM firsts""",
    "fixed_scores": """
        SELECT customer_unique_id, y_true, 1 / (1 + exp(-margin)) AS y_prob,
               CAST(margin > 0 AS INTEGER) AS y_pred
        FROM fixed_margins""",
    "fixed_tops": """
        SELECT *, row_number() OVER (ORDER BY round(y_prob, 2) DESC, customer_unique_id)
                   <= floor(count(*) OVER () * CAST(0.1 AS DOUBLE)) AS in_top
        FROM fixed_scores""",
    "first_medians": """
        SELECT median(delivery_days_mean) AS d_median, median(first_event_review_score_mean) AS r_median
        FROM first_parts WHERE split = 'train'""",
    "first_filled": """
        SELECT customer_unique_id, split, coalesce(delivery_days_mean, d_median) AS d,
               coalesce(first_event_review_score_mean, r_median) AS r
        FROM first_parts CROSS JOIN first_medians""",
    "scores": """
        SELECT customer_unique_id, purchase_2nd_within_90d AS y_true,
               CAST((customer_unique_id * 7919) % 101 AS DOUBLE) / CAST(101 AS DOUBLE) * CAST(0.7 AS DOUBLE)
                   + CAST(0.3 AS DOUBLE) * CAST(purchase_2nd_within_90d AS DOUBLE)
                   * CAST(customer_unique_id % 3 AS DOUBLE) AS y_prob
        FROM parts WHERE split = 'test'""",
    "scored": "SELECT *, CASE WHEN y_prob > CAST(0.5 AS DOUBLE) THEN 1 ELSE 0 END AS y_pred FROM scores",
    "cells": """
        SELECT count(*) FILTER (WHERE y_true = 0 AND y_pred = 0) AS tn,
               count(*) FILTER (WHERE y_true = 0 AND y_pred = 1) AS fp,
               count(*) FILTER (WHERE y_true = 1 AND y_pred = 0) AS fn,
               count(*) FILTER (WHERE y_true = 1 AND y_pred = 1) AS tp
        FROM scored""",
    "classes": """
        SELECT '0' AS label, tn + fp AS support, coalesce(tn / nullif(tn + fn, 0), 0) AS precision,
               coalesce(tn / nullif(tn + fp, 0), 0) AS recall FROM cells
        UNION ALL
        SELECT '1', tp + fn, coalesce(tp / nullif(tp + fp, 0), 0), coalesce(tp / nullif(tp + fn, 0), 0)
        FROM cells""",
    "class_scores": """
        SELECT *, coalesce(2 * precision * recall / nullif(precision + recall, 0), 0) AS f1 FROM classes""",
    "by_score": """
        SELECT y_prob, count(*) FILTER (WHERE y_true = 1) AS pos, count(*) FILTER (WHERE y_true = 0) AS neg
        FROM scored GROUP BY y_prob""",
    "curve": """
        SELECT y_prob, pos, neg,
               CAST(sum(pos) OVER (ORDER BY y_prob DESC) AS BIGINT) AS tp,
               CAST(sum(neg) OVER (ORDER BY y_prob DESC) AS BIGINT) AS fp,
               CAST(sum(pos) OVER () AS DOUBLE) AS all_pos, CAST(sum(neg) OVER () AS DOUBLE) AS all_neg
        FROM by_score""",
    "ranking": """
        SELECT sum(CAST(neg AS DOUBLE) * (tp - pos / 2.0)) / (max(all_pos) * max(all_neg)) AS roc_auc,
               sum(CAST(pos AS DOUBLE) * tp / (tp + fp)) / max(all_pos) AS pr_auc
        FROM curve""",
    "tops": """
        SELECT *, row_number() OVER (ORDER BY y_prob DESC, customer_unique_id)
                   <= floor(count(*) OVER () * CAST(0.1 AS DOUBLE)) AS in_top
        FROM scored""",
}


def _statement(select: str) -> str:
    """Prefix the steps the SELECT needs, directly or through other steps."""
    needed, open_texts = set(), [select]
    while open_texts:
        text = open_texts.pop()
        for name in STEPS:
            if name not in needed and re.search(rf"\b(FROM|JOIN)\s+{name}\b", text):
                needed.add(name)
                open_texts.append(STEPS[name])
    steps = ",\n".join(f"{name} AS ({STEPS[name]})" for name in STEPS if name in needed)
    return f"WITH {steps}\n{select}" if steps else select


def _null_counts(table: str, columns: list[str]) -> str:
    return "\nUNION ALL\n".join(
        f"SELECT '{c}' AS column_name, count(*) - count({c}) AS null_cnt FROM {table}" for c in columns
    )


def _schema_counts(table: str, types: dict[str, str], table_name: str | None = None) -> str:
    prefix = f"'{table_name}' AS table_name, " if table_name else ""
    return "\nUNION ALL\n".join(
        f"SELECT {prefix}'{c}' AS column_name, count({c}) AS non_null_cnt, '{kind}' AS data_type FROM {table}"
        for c, kind in types.items()
    )


def _value_counts(table: str, column: str) -> str:
    return (
        f"SELECT {column} AS value, count(*) AS cnt FROM {table} WHERE {column} IS NOT NULL GROUP BY {column}"
    )


def _value_share(table: str, column: str) -> str:
    return (
        f"SELECT {column} AS value, round(count(*) / CAST(sum(count(*)) OVER () AS DOUBLE), 6) AS share "
        f"FROM {table} WHERE {column} IS NOT NULL GROUP BY {column}"
    )


_R_ORDERS = {
    "order_id": "bigint",
    "customer_id": "bigint",
    "order_status": "string",
    "order_purchase_timestamp": "timestamp_ntz",
    "order_delivered_customer_date": "timestamp_ntz",
    "order_estimated_delivery_date": "timestamp_ntz",
}
_RAW_TYPES = {
    "orders": ("r_orders", _R_ORDERS),
    "customers": (
        "r_customers",
        {"customer_id": "bigint", "customer_unique_id": "bigint", "customer_state": "string"},
    ),
    "reviews": ("r_reviews", {"review_id": "bigint", "order_id": "bigint", "review_score": "double"}),
    "order_items": ("r_items", {"order_id": "bigint", "order_item_id": "int", "price": "decimal(12,2)"}),
}
_BASE_TYPES = {
    "customer_unique_id": "bigint",
    "first_purchase_ts": "timestamp_ntz",
    "delivery_days_mean": "double",
    "first_event_review_score_mean": "double",
    "late_flag": "int",
    "has_review": "int",
    "customer_state": "string",
    "first_item_cnt": "bigint",
    "first_purchase_gmv": "decimal(18,2)",
    "purchase_2nd_within_90d": "int",
}
_ORDER_BASE = [
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
_FIRSTS = [*_BASE_TYPES, "purchase_event_rank", "second_purchase_ts", "days_to_second_purchase"]

_ROUND_MEANS = """round(delivery_days_mean, 6) AS delivery_days_mean,
    round(first_event_review_score_mean, 6) AS first_event_review_score_mean"""
_ABT = f"SELECT * REPLACE ({_ROUND_MEANS}) FROM base"

SELECTS = {
    "raw_csv_roundtrip": "\nUNION ALL\n".join(
        _schema_counts(view, types, name) for name, (view, types) in _RAW_TYPES.items()
    ),
    "csv_text_roundtrip": """
        WITH texts AS (SELECT doc_id, text FROM documents)
        SELECT doc_id, CAST(length(text) AS INTEGER) AS n_points, text FROM texts""",
    "duplicate_reviews": "SELECT review_id, count(*) AS cnt FROM r_reviews GROUP BY review_id HAVING count(*) > 1",
    "abt_from_raw_csv": _ABT,
    "abt_csv_roundtrip": _ABT,
    "review_profile": """
        SELECT * REPLACE (round(review_score_mean, 6) AS review_score_mean,
                          round(review_score_min, 6) AS review_score_min,
                          round(review_score_max, 6) AS review_score_max)
        FROM review_stats""",
    "multi_review_counts": _value_counts("review_stats", "multi_review_flag"),
    "multi_review_share": _value_share("review_stats", "multi_review_flag"),
    "review_order_agg": "SELECT order_id, round(review_score_mean, 6) AS review_score_mean FROM review_mean",
    "order_items_agg": "SELECT * FROM item_totals",
    "order_customers": "SELECT * FROM with_customer",
    "order_base": "SELECT * REPLACE (round(review_score_mean, 6) AS review_score_mean) FROM base_orders",
    "order_event": """
        SELECT * REPLACE (round(review_score_mean, 6) AS review_score_mean,
                          round(delivery_days, 6) AS delivery_days)
        FROM arrived""",
    "purchase_event": f"SELECT * REPLACE ({_ROUND_MEANS}) FROM ranked",
    "first_purchase_label": f"SELECT * REPLACE ({_ROUND_MEANS}) FROM firsts",
    "abt": _ABT,
    "data_end": """
        SELECT max(order_purchase_timestamp) AS data_end,
               max(order_purchase_timestamp) - INTERVAL 90 DAY AS analysis_end
        FROM purchases""",
    "review_median": """
        SELECT count(first_event_review_score_mean) AS known_rows,
               round(median(first_event_review_score_mean), 6) AS median
        FROM firsts""",
    "median_impute": """
        SELECT customer_unique_id, round(first_event_review_score_mean, 6) AS first_event_review_score_mean
        FROM filled""",
    "events_repurchase_label": """
        WITH steps AS (
            SELECT user_id, ts, row_number() OVER (PARTITION BY user_id ORDER BY ts) AS n
            FROM (SELECT DISTINCT user_id, ts FROM events
                  WHERE event_type = 'purchase' AND user_id IS NOT NULL AND ts IS NOT NULL)),
        spans AS (
            SELECT a.user_id, a.ts AS first_ts, b.ts AS second_ts,
                   CAST(floor(date_diff('microsecond', a.ts, b.ts) / CAST(86400000000 AS DOUBLE)) AS INTEGER)
                       AS days_to_second
            FROM steps a LEFT JOIN steps b ON a.user_id = b.user_id AND b.n = 2 WHERE a.n = 1)
        SELECT *, CASE WHEN days_to_second BETWEEN 0 AND 1 THEN 1 ELSE 0 END AS again_within_1d FROM spans""",
    "null_profile_order_customers": _null_counts(
        "with_customer", [*_R_ORDERS, "customer_unique_id", "customer_state"]
    ),
    "null_profile_order_base": _null_counts("base_orders", _ORDER_BASE),
    "null_profile_order_event": _null_counts(
        "arrived", [*_ORDER_BASE, "delivery_days", "late_flag", "has_review"]
    ),
    "null_profile_first_purchase": _null_counts("firsts", _FIRSTS),
    "null_profile_imputed": _null_counts("filled", _FIRSTS),
    "null_profile": _null_counts("base", list(_BASE_TYPES)),
    "schema_profile_orders": _schema_counts("r_orders", _R_ORDERS),
    "schema_profile": _schema_counts("base", _BASE_TYPES),
    "late_flag_counts": _value_counts("arrived", "late_flag"),
    "has_review_counts": _value_counts("arrived", "has_review"),
    "value_counts": _value_counts("firsts", "purchase_2nd_within_90d"),
    "value_share": _value_share("base", "purchase_2nd_within_90d"),
    "time_split": "SELECT customer_unique_id, first_purchase_ts, split FROM parts",
    "split_features": f"SELECT * EXCLUDE (first_purchase_ts) REPLACE ({_ROUND_MEANS}) FROM parts",
    "split_label_rates": """
        SELECT split, purchase_2nd_within_90d AS label, count(*) AS cnt,
               CAST(sum(count(*)) OVER (PARTITION BY split) AS BIGINT) AS split_rows,
               round(count(*) / CAST(sum(count(*)) OVER (PARTITION BY split) AS DOUBLE), 6) AS share
        FROM parts GROUP BY split, purchase_2nd_within_90d""",
    "one_hot_state": """
        SELECT p.customer_unique_id, CAST((SELECT count(DISTINCT coalesce(customer_state, '__missing__'))
                                           FROM train) AS INTEGER) AS width,
               CAST(s.slot AS INTEGER) AS slot
        FROM parts p
        LEFT JOIN (SELECT state, row_number() OVER (ORDER BY state) - 1 AS slot
                   FROM (SELECT DISTINCT coalesce(customer_state, '__missing__') AS state FROM train)) s
            ON s.state = coalesce(p.customer_state, '__missing__')""",
    "scaled_numeric": """
        SELECT p.customer_unique_id,
               round((coalesce(p.delivery_days_mean, t.d_median) - t.d_mean) / t.d_dev, 6) + 0.0
                   AS delivery_days_mean_scaled,
               round((coalesce(p.first_event_review_score_mean, t.r_median) - t.r_mean) / t.r_dev, 6) + 0.0
                   AS first_event_review_score_mean_scaled
        FROM parts p, (SELECT median(delivery_days_mean) AS d_median, avg(delivery_days_mean) AS d_mean,
                              stddev_pop(delivery_days_mean) AS d_dev,
                              median(first_event_review_score_mean) AS r_median,
                              avg(first_event_review_score_mean) AS r_mean,
                              stddev_pop(first_event_review_score_mean) AS r_dev
                       FROM train) t""",
    "scaled_numeric_unimputed": """
        SELECT f.customer_unique_id,
               round((f.d - t.d_mean) / t.d_dev, 6) + 0.0 AS delivery_days_mean_scaled,
               round((f.r - t.r_mean) / t.r_dev, 6) + 0.0 AS first_event_review_score_mean_scaled
        FROM first_filled f, (SELECT avg(d) AS d_mean, stddev_pop(d) AS d_dev, avg(r) AS r_mean,
                                     stddev_pop(r) AS r_dev
                              FROM first_filled WHERE split = 'train') t""",
    "logreg_optimality": """
        SELECT name, CAST(total AS DOUBLE) AS total, CAST(0 AS DOUBLE) AS gradient, CAST(0 AS BIGINT) AS n_wrong
        FROM (SELECT 'delivery_days_mean' AS name, 0 AS total
              UNION ALL SELECT 'first_event_review_score_mean', 0
              UNION ALL SELECT 'customer_state=' || coalesce(customer_state, '__missing__'), count(*)
                        FROM train GROUP BY 1
              UNION ALL SELECT 'late_flag', sum(late_flag) FROM train
              UNION ALL SELECT 'has_review', sum(has_review) FROM train
              UNION ALL SELECT 'intercept', count(*) FROM train)""",
    "fixed_model_scores": """
        SELECT customer_unique_id, y_true, round(y_prob, 6) AS y_prob, y_pred FROM fixed_scores""",
    "fixed_model_lift": """
        SELECT round(avg(y_true), 6) AS overall_rate,
               round(avg(y_true) FILTER (WHERE in_top), 6) AS top_rate,
               count(*) FILTER (WHERE in_top) AS top_rows,
               count(*) FILTER (WHERE in_top AND y_true = 1) AS top_positives,
               round(avg(y_true) FILTER (WHERE in_top) / nullif(avg(y_true), 0), 6) AS lift
        FROM fixed_tops""",
    "class_weights": """
        SELECT purchase_2nd_within_90d, count(*) AS cnt,
               round(CAST(sum(count(*)) OVER () AS DOUBLE) / (count(*) OVER () * count(*)), 6) AS weight
        FROM train GROUP BY purchase_2nd_within_90d""",
    "confusion_matrix": """
        SELECT CAST(0 AS INTEGER) AS actual, CAST(0 AS INTEGER) AS predicted, tn AS cnt FROM cells
        UNION ALL SELECT 0, 1, fp FROM cells
        UNION ALL SELECT 1, 0, fn FROM cells
        UNION ALL SELECT 1, 1, tp FROM cells""",
    "classification_metrics": """
        SELECT 'accuracy' AS metric, round((tp + tn) / (tp + tn + fp + fn), 6) AS value FROM cells
        UNION ALL SELECT 'precision', round(precision, 6) FROM class_scores WHERE label = '1'
        UNION ALL SELECT 'recall', round(recall, 6) FROM class_scores WHERE label = '1'
        UNION ALL SELECT 'f1', round(f1, 6) FROM class_scores WHERE label = '1'
        UNION ALL SELECT 'roc_auc', round(roc_auc, 6) FROM ranking
        UNION ALL SELECT 'pr_auc', round(pr_auc, 6) FROM ranking""",
    "classification_report": """
        SELECT label, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1, support
        FROM class_scores
        UNION ALL
        SELECT 'accuracy', NULL, NULL, round((tp + tn) / (tp + tn + fp + fn), 6), tp + tn + fp + fn FROM cells
        UNION ALL
        SELECT 'macro avg', round(avg(precision), 6), round(avg(recall), 6), round(avg(f1), 6),
               CAST(sum(support) AS BIGINT)
        FROM class_scores
        UNION ALL
        SELECT 'weighted avg', round(sum(precision * support) / sum(support), 6),
               round(sum(recall * support) / sum(support), 6), round(sum(f1 * support) / sum(support), 6),
               CAST(sum(support) AS BIGINT)
        FROM class_scores""",
    "roc_curve": """
        SELECT round(y_prob, 6) AS threshold, fp, tp, round(fp / all_neg, 6) AS fpr,
               round(tp / all_pos, 6) AS tpr
        FROM curve
        UNION ALL SELECT CAST(NULL AS DOUBLE), CAST(0 AS BIGINT), CAST(0 AS BIGINT), CAST(0 AS DOUBLE),
               CAST(0 AS DOUBLE)""",
    "roc_curve_corners": """
        SELECT round(y_prob, 6) AS threshold, fp, tp, round(fp / all_neg, 6) AS fpr,
               round(tp / all_pos, 6) AS tpr
        FROM (SELECT *, lag(fp) OVER w AS fp_before, lead(fp) OVER w AS fp_after,
                     lag(tp) OVER w AS tp_before, lead(tp) OVER w AS tp_after
              FROM curve WINDOW w AS (ORDER BY y_prob DESC))
        WHERE fp_before IS NULL OR fp_after IS NULL
           OR fp_after - 2 * fp + fp_before <> 0 OR tp_after - 2 * tp + tp_before <> 0
        UNION ALL SELECT CAST(NULL AS DOUBLE), CAST(0 AS BIGINT), CAST(0 AS BIGINT), CAST(0 AS DOUBLE),
               CAST(0 AS DOUBLE)""",
    "pr_curve": """
        SELECT round(y_prob, 6) AS threshold, round(CAST(tp AS DOUBLE) / (tp + fp), 6) AS precision,
               round(tp / all_pos, 6) AS recall
        FROM curve
        UNION ALL SELECT CAST(NULL AS DOUBLE), CAST(1 AS DOUBLE), CAST(0 AS DOUBLE)""",
    "roc_auc": "SELECT round(roc_auc, 6) AS roc_auc FROM ranking",
    "average_precision": "SELECT round(pr_auc, 6) AS pr_auc FROM ranking",
    "top_fraction": """
        SELECT customer_unique_id, y_true, round(y_prob, 6) AS y_prob, y_pred FROM tops WHERE in_top""",
    "top_decile_lift": """
        SELECT round(avg(y_true), 6) AS overall_rate,
               round(avg(y_true) FILTER (WHERE in_top), 6) AS top_rate,
               count(*) FILTER (WHERE in_top) AS top_rows,
               count(*) FILTER (WHERE in_top AND y_true = 1) AS top_positives,
               round(avg(y_true) FILTER (WHERE in_top) / nullif(avg(y_true), 0), 6) AS lift
        FROM tops""",
}

ORACLE_SQL = {
    name: select if select.lstrip().startswith("WITH") else _statement(select)
    for name, select in SELECTS.items()
}
