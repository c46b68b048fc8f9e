"""Interval overlap and range sums against a regular window grid."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from icuriver.functions.timegrid import HOUR, floor_to, from_micros, micros
from icuriver.operators.cohort import VISIT
from icuriver.operators.reshape import TIME


def _spans(windows: DataFrame, visit: str, time: str) -> DataFrame:
    """First and last window start of each visit, in microseconds."""
    return (
        windows.dropna(subset=[visit, time])
        .groupBy(visit)
        .agg(F.min(micros(time)).alias("_lo"), F.max(micros(time)).alias("_hi"))
    )


def _attach(windows: DataFrame, sums: DataFrame, spans: DataFrame, width: int, visit: str, time: str) -> DataFrame:
    """Join per-window sums back; a window off its visit's grid is an error, not a wrong value."""
    aligned = F.pmod(micros(time) - F.col("_lo"), F.lit(width)) == 0
    start = F.when(aligned | F.col("_lo").isNull(), micros(time)).otherwise(
        F.raise_error(F.lit("windows of a visit must lie on one grid")).cast("long")
    )
    return (
        windows.join(spans.select(visit, "_lo"), visit, "left")
        .withColumn("_bin", start)
        .drop("_lo")
        .join(sums, [visit, "_bin"], "left")
        .drop("_bin")
    )


def window_overlap_mean(
    windows: DataFrame,
    intervals: DataFrame,
    *,
    start: str = "start_datetime",
    stop: str = "stop_datetime",
    dose: str = "equiv_gamma",
    hours: int = 12,
    visit: str = VISIT,
    time: str = TIME,
    out: str = "average_gamma",
) -> DataFrame:
    """Mean dose per window weighted by the hours each interval overlaps it.

    An interval counts if it starts before the window ends and stops after it
    starts; no overlap gives 0. Windows of a visit lie on one grid, so an interval is
    cut at the grid and its pieces are keyed by (visit, window): linear in overlaps,
    summed before the shuffle, and a hot visit spreads over its windows.
    """
    width = hours * HOUR
    spans = _spans(windows, visit, time)
    s, e, lo, b = F.col("_s"), F.col("_e"), F.col("_lo"), F.col("_bin")
    cut = (
        intervals.select(visit, micros(start).alias("_s"), micros(stop).alias("_e"), F.col(dose).alias("_dose"))
        .where(s.isNotNull() & e.isNotNull())
        .join(spans, visit)
        .withColumn("_from", F.greatest(floor_to(s, width, lo), lo))
        .withColumn("_to", F.least(floor_to(e - 1, width, lo), F.col("_hi")))
        .where(F.col("_from") <= F.col("_to"))
        .withColumn("_bin", F.explode(F.sequence("_from", "_to", F.lit(width))))
        .withColumn("_hours", (F.least(e, b + width) - F.greatest(s, b)) / HOUR)
    )
    sums = cut.groupBy(visit, "_bin").agg(
        F.sum(F.col("_dose") * F.col("_hours")).alias("_weighted"), F.sum("_hours").alias("_total")
    )
    mean = F.coalesce(F.try_divide("_weighted", "_total"), F.lit(0.0))
    return _attach(windows, sums, spans, width, visit, time).withColumn(out, mean).drop("_weighted", "_total")


def window_range_sum(
    windows: DataFrame,
    values: DataFrame,
    *,
    value: str = "value_as_number",
    value_time: str = TIME,
    hours: int = 12,
    visit: str = VISIT,
    time: str = TIME,
    out: str = "fluid_intake_sum",
) -> DataFrame:
    """Sum of the values from a window's start to its end, both ends included (E5).

    A value exactly on a border therefore counts in two windows. Linear like E4.
    """
    width = hours * HOUR
    spans = _spans(windows, visit, time)
    t, lo = F.col("_t"), F.col("_lo")
    home = floor_to(t, width, lo)
    bins = F.when(home == t, F.array(home, home - width)).otherwise(F.array(home))
    sums = (
        values.select(visit, micros(value_time).alias("_t"), F.col(value).alias("_v"))
        .where(t.isNotNull())
        .join(spans, visit)
        .where((t >= lo) & (t <= F.col("_hi") + width))
        .withColumn("_bin", F.explode(bins))
        .groupBy(visit, "_bin")
        .agg(F.sum("_v").alias("_sum"))
    )
    total: Column = F.coalesce("_sum", F.lit(0.0))
    return _attach(windows, sums, spans, width, visit, time).withColumn(out, total).drop("_sum")


def window_bounds(windows: DataFrame, hours: int = 12, time: str = TIME) -> DataFrame:
    """Add the window's end."""
    return windows.withColumn("window_end", from_micros(micros(time) + hours * HOUR))
