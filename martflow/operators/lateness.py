"""Event-time watermarks over recorded arrivals.

A stream meets its rows in steps (a micro-batch, or the interval at which
watermarks are emitted), and the watermark that a row meets is the largest
event time of all earlier steps less the allowed lag. On a stored feed that
keeps each row's arrival the same rule is declarative: the largest event time
of each step is a combinable aggregate, the watermark a running maximum over
steps, and a row is late if its window had ended by then. So a replay of a
day drops the rows that the stream dropped, and the dropped ones can be
listed, which the stream can't do.

No row is sorted. The running maximum goes over one row a step, in two levels:
within spans of ``SPAN`` steps and over the spans (a row for each SPAN steps;
with steps of 10 s a year has 3,080). Rows join their step's watermark in the
form whose hot partitions adaptive execution splits, so a step may hold any
share of the rows.

Defined results: rows of a null arrival or event time are neither on time nor
late (no window holds them) and move no watermark; the rows of the first step
meet no watermark and are on time; rows of one step don't see each other.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .state import _attach

SPAN = 1024


def step_watermarks(df: DataFrame, arrival_ms: str, et_ms: str, step_ms: int, lag_ms: int = 0) -> DataFrame:
    """(step, watermark): what rows of a step meet (null in the first)."""
    steps = df.where(F.col(arrival_ms).isNotNull() & F.col(et_ms).isNotNull()) \
        .groupBy(F.floor(F.col(arrival_ms) / step_ms).alias("step")).agg(F.max(et_ms).alias("top")) \
        .withColumn("span", F.floor(F.col("step") / SPAN))
    before = Window.rowsBetween(Window.unboundedPreceding, -1)
    spans = steps.groupBy("span").agg(F.max("top").alias("t")) \
        .select("span", F.max("t").over(before.orderBy("span")).alias("earlier"))
    inside = steps.withColumn("inner", F.max("top").over(before.partitionBy("span").orderBy("step")))
    # greatest skips nulls
    return inside.join(spans, "span").select("step", (F.greatest("inner", "earlier") - lag_ms).alias("watermark"))


def with_watermark_met(df: DataFrame, arrival_ms: str, et_ms: str, size_ms: int, step_ms: int,
                       lag_ms: int = 0) -> DataFrame:
    """Every row with ``watermark`` (epoch ms, null in the first step) and
    ``late``: whether its tumbling window of ``size_ms`` had ended by then."""
    marks = step_watermarks(df, arrival_ms, et_ms, step_ms, lag_ms).withColumnRenamed("step", "__step")
    met = _attach(df.withColumn("__step", F.floor(F.col(arrival_ms) / step_ms)), marks, ["__step"]).drop("__step")
    end = (F.floor(F.col(et_ms) / size_ms) + 1) * size_ms
    late = F.when(F.col(arrival_ms).isNotNull() & F.col(et_ms).isNotNull(), F.coalesce(end <= F.col("watermark"), F.lit(False)))
    return met.withColumn("late", late)


def split_late(df: DataFrame, arrival_ms: str, et_ms: str, size_ms: int, step_ms: int,
               lag_ms: int = 0) -> tuple[DataFrame, DataFrame]:
    """(rows that their window counts, rows dropped as late, with the
    ``watermark`` that they met)."""
    met = with_watermark_met(df, arrival_ms, et_ms, size_ms, step_ms, lag_ms)
    return met.where(~F.col("late")).drop("watermark", "late"), met.where("late").drop("late")


def arrival_time(df: DataFrame, arrival_ms: str, out: str = "ts") -> DataFrame:
    """W4 + P7 on a stored feed: the recorded arrival as the time that windows
    go by."""
    return df.withColumn(out, F.timestamp_millis(arrival_ms))
