"""Raw tables to the base table."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from encore.operators import grain, lifecycle
from encore.operators.impute import impute_median
from encore.sources.staging import stage

CUSTOMER = "customer_unique_id"
PURCHASED = "order_purchase_timestamp"
FIRST = "first_purchase_ts"
SECOND = "second_purchase_ts"
RANK = "purchase_event_rank"
DAYS = "days_to_second_purchase"
REVIEW = "first_event_review_score_mean"


def label_name(horizon_days: int) -> str:
    return f"purchase_2nd_within_{horizon_days}d"


@dataclass(frozen=True)
class Prepared:
    """The tables of one preparation run, from fine to coarse."""

    first_purchase: DataFrame
    imputed: DataFrame
    base_table: DataFrame


def purchase_event(raw: dict[str, DataFrame]) -> DataFrame:
    return grain.purchase_event(grain.order_event(raw))


def ranked_purchase_event(raw: dict[str, DataFrame]) -> DataFrame:
    """Purchase events with their number per customer."""
    return lifecycle.event_rank(purchase_event(raw), CUSTOMER, PURCHASED, RANK)


def first_purchase(events: DataFrame, horizon_days: int = 90) -> DataFrame:
    """One row per customer: first purchase, second purchase time and label."""
    firsts = lifecycle.first_two_events(events, CUSTOMER, PURCHASED, FIRST, SECOND, RANK)
    return lifecycle.label_within(firsts, FIRST, SECOND, horizon_days, DAYS, label_name(horizon_days))


def data_end(raw: dict[str, DataFrame], firsts: DataFrame) -> datetime | None:
    """The time of the last purchase event.

    The staged first purchases know the first two events of every customer, which
    is a close lower bound; only later orders are checked against the raw tables.
    """
    seen = firsts.agg(F.max(F.coalesce(SECOND, FIRST))).first()[0]
    return grain.latest_purchase(raw, after=seen)


def prepare(raw: dict[str, DataFrame], horizon_days: int = 90, check_keys: bool = False) -> Prepared:
    """Build the base table.

    A customer id or order id that repeats multiplies orders; ``check_keys`` makes it
    an error, for one more aggregation of each of the two tables' keys.

    First purchases are read more than once (their median is a fact about the
    whole table), so they are staged and the joins behind them run once.  The
    median covers every first purchase, also those censored afterwards.
    """
    if check_keys:
        grain.assert_unique(raw["customers"], ["customer_id"])
        grain.assert_unique(raw["orders"], ["order_id"])
    firsts = stage(first_purchase(purchase_event(raw), horizon_days), "first_purchase")
    imputed = impute_median(firsts, REVIEW)
    base = lifecycle.censor(imputed, FIRST, data_end(raw, firsts), horizon_days).drop(RANK, SECOND, DAYS)
    return Prepared(firsts, imputed, base)
