"""Query registration and the stand-ins that driver tables are for tracks, frames and sections."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLE_SQL[f.__name__] = sql
        return f

    return add


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def seconds(c: str) -> Column:
    """Seconds since 2024, whatever the session's time zone."""
    return F.expr(f"timestampdiff(MICROSECOND, timestamp_ntz'2024-01-01 00:00:00', {c}) / 1000000.0").cast("double")


SECONDS = "((epoch_us(ts) - epoch_us(timestamp '2024-01-01')) / 1000000.0)"


def frames(spark: SparkSession, folder: str) -> DataFrame:
    """Frame probabilities per user: events in time order, values scaled to [0, 1]."""
    e = table(spark, folder, "events")
    return e.select("user_id", "event_id", "event_type", seconds("ts").alias("t"), F.least(F.lit(1.0), F.col("value") / 500).alias("p"))


FRAMES = f"f AS (SELECT user_id, event_id, event_type, {SECONDS}::DOUBLE AS t, least(1.0, value / 500)::DOUBLE AS p FROM events)"


def runs(spark: SparkSession, folder: str) -> DataFrame:
    """Runs of one event type as sections: start at their first event, end where the next begins."""
    from pyspark.sql import Window

    from quaverlake.operators.sequences import change_points

    points = change_points(frames(spark, folder), ["user_id"], ["t", "event_id"], "event_type")
    w = Window.partitionBy("user_id").orderBy("t", "event_id")
    return points.select("user_id", F.row_number().over(w).alias("n"), F.col("event_type").alias("label"), F.col("t").alias("raw_start"), F.coalesce(F.lead("t").over(w), F.lit(2592000.0)).alias("raw_end"), (F.col("p")).alias("boundary_confidence"))


RUNS = (
    FRAMES
    + """, c AS (SELECT *, lag(event_type) OVER w AS b, row_number() OVER w AS rn FROM f WINDOW w AS (PARTITION BY user_id ORDER BY t, event_id)),
s AS (SELECT user_id, row_number() OVER w AS n, event_type AS label, t AS raw_start, coalesce(lead(t) OVER w, 2592000.0)::DOUBLE AS raw_end, p AS boundary_confidence
      FROM c WHERE rn = 1 OR b <> event_type WINDOW w AS (PARTITION BY user_id ORDER BY t, event_id))"""
)
