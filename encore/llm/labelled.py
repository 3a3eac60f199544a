"""Labelled rows to learn from: a bounded sample that never touches held-out rows."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from encore.llm.tables import free_name

FOLDS = 5


def held_out(doc_id: Column) -> Column:
    """Rows no model may learn from: crc32 of the id as text, modulo 5, is 0."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % FOLDS == 0, F.lit(False))


def sample(docs: DataFrame, labels: DataFrame, label: str, rows: int) -> DataFrame:
    """``text`` and ``label`` of at most ``rows`` labelled rows outside the held-out fold.

    Chosen by a hash of the id, so that every size and order of the table gives a
    sample of the same kind.  An id with several labels counts with the largest.
    """
    known = (
        labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
        .groupBy("doc_id")
        .agg(F.max(label).cast("int").alias("label"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(rows)
    )
    # at most ``rows`` ids and labels
    return docs.select("doc_id", "text").join(F.broadcast(known), "doc_id").select("text", "label")


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-3, steps: int = 30) -> np.ndarray:
    """Weights of a logistic regression, the constant last, by Newton steps."""
    x = np.column_stack([x, np.ones(len(x))])
    weights = np.zeros(x.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ weights, -30, 30)))
        slope = x.T @ (p - y) + ridge * weights
        curve = (x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(weights))
        weights = weights - np.linalg.solve(curve, slope)
    return weights


def with_score(docs: DataFrame) -> T.StructType:
    return T.StructType([*docs.schema.fields, T.StructField(free_name("_score", docs.columns), T.DoubleType())])
