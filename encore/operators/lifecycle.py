"""First and second events per entity, horizon labels and right-censoring."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from encore.functions.temporal import ts_literal, whole_days, within_days
from encore.operators.ordering import ROWS_PER_PART, write_parts_in_order


def event_rank(events: DataFrame, key: str, ts: str, rank: str = "purchase_event_rank") -> DataFrame:
    """Number every entity's events 1, 2, 3, ... by time; (key, ts) is unique.

    A window per entity would sort all events of a heavy entity in one task.
    Here one distributed sort places every event, and a window per sorted
    partition and entity finds where the entity begins there.  Only a partition's
    first entity can have begun earlier; its true begin comes from the partitions'
    edges, one row each.  Nothing is joined or shuffled by the entity alone.
    Writes a staged table, in buckets of whole sorted partitions: the window sorts
    each bucket where it is read, so the sort is the only shuffle of all columns.
    """
    placed = write_parts_in_order(events, [F.col(key), F.col(ts)]).withColumn(
        "_pos", F.pmod("_slot", F.lit(ROWS_PER_PART))
    )
    runs = placed.groupBy("_part", key).agg(F.min("_pos").alias("_run"), F.count("*").alias("_rows"))
    edges = runs.groupBy("_part").agg(
        F.sum("_rows").alias("_rows"),
        F.min_by(key, "_run").alias("_first_key"),
        F.max_by(key, "_run").alias("_last_key"),
        F.max("_run").alias("_last_run"),
    )
    # one row per sorted partition, whatever the number of events
    in_order = Window.orderBy("_part")
    earlier = in_order.rowsBetween(Window.unboundedPreceding, -1)
    same = F.lag("_last_key").over(in_order).eqNullSafe(F.col("_first_key"))
    edges = edges.withColumns(
        {
            "_start": F.coalesce(F.sum("_rows").over(earlier), F.lit(0)),
            "_continues": F.lag("_part").over(in_order).isNotNull() & same,
        }
    )
    one_run = F.col("_first_key").eqNullSafe(F.col("_last_key"))
    edges = edges.withColumn(
        "_begin", F.when(~(F.col("_continues") & one_run), F.col("_start") + F.col("_last_run"))
    ).withColumn("_carried", F.when(F.col("_continues"), F.last("_begin", ignorenulls=True).over(earlier)))
    edges = edges.select("_part", "_start", "_first_key", "_carried")
    placed = placed.withColumn("_here", F.min("_pos").over(Window.partitionBy("_part", key)))
    carried = F.col("_carried").isNotNull() & F.col(key).eqNullSafe(F.col("_first_key"))
    first = F.when(carried, F.col("_carried")).otherwise(F.col("_start") + F.col("_here"))
    return (
        placed.join(F.broadcast(edges), "_part")
        .withColumn(rank, F.col("_start") + F.col("_pos") - first + 1)
        .drop("_part", "_pos", "_here", "_slot", "_start", "_first_key", "_carried")
    )


def first_two_events(
    events: DataFrame,
    key: str,
    ts: str,
    first: str,
    second: str,
    rank: str = "purchase_event_rank",
) -> DataFrame:
    """Each entity's first event with the time of its second; (key, ts) is unique.

    The rank filter lets Spark keep two rows per entity and partition before the
    shuffle, so the number of events of one entity does not matter.
    """
    timeline = Window.partitionBy(key).orderBy(ts)
    earliest = events.withColumn(rank, F.row_number().over(timeline)).where(F.col(rank) <= 2)
    return (
        earliest.withColumn(second, F.lead(ts).over(timeline))
        .where(F.col(rank) == 1)
        .withColumnRenamed(ts, first)
    )


def label_within(
    df: DataFrame,
    first: str,
    second: str,
    horizon_days: int,
    days: str,
    label: str,
) -> DataFrame:
    """Whole days to the second event, and 1 when they lie in 0..horizon_days."""
    return df.withColumn(days, whole_days(F.col(first), F.col(second))).withColumn(
        label, within_days(F.col(days), horizon_days)
    )


def censor(firsts: DataFrame, first: str, observed_until: datetime | None, horizon_days: int) -> DataFrame:
    """Keep entities whose whole horizon lies before the end of the data.

    ``observed_until`` is the time of the last event of all entities.
    """
    last_start = ts_literal(observed_until) - F.make_dt_interval(F.lit(horizon_days))
    return firsts.where(F.col(first) <= last_start)
