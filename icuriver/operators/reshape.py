"""Long to wide, merging series, gap-filled windows, sequence numbers."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from icuriver.functions.ordered import ordered_scan
from icuriver.functions.timegrid import DAY, HOUR, floor_to, from_micros, micros
from icuriver.operators.cohort import PERSON, VISIT

TIME, FEATURE, VALUE = "measurement_datetime", "feature_name", "value_as_number"


def average_duplicates(
    long: DataFrame, keys: Sequence[str] = (VISIT, TIME, FEATURE), value: str = VALUE
) -> DataFrame:
    """Mean per visit, time and feature."""
    return long.dropna(subset=list(keys)).groupBy(*keys).agg(F.avg(value).alias(value))


def to_wide(
    long: DataFrame,
    features: Sequence[str],
    keys: Sequence[str] = (VISIT, TIME),
    feature: str = FEATURE,
    value: str = VALUE,
) -> DataFrame:
    """One row per visit and time, one column per feature.

    Averaging duplicates and pivoting is one aggregate; the feature list fixes the
    schema, so no pass is spent on finding the values.
    """
    return (
        long.where(F.col(feature).isin(list(features)))
        .dropna(subset=list(keys))
        .groupBy(*keys)
        .agg(*[F.avg(F.when(F.col(feature) == f, F.col(value))).alias(f) for f in features])
    )


def merge_series(wide: DataFrame, other: DataFrame, keys: Sequence[str] = (VISIT, TIME)) -> DataFrame:
    """Full outer join on visit and time (D7); several rows at one time stay."""
    return wide.join(other, list(keys), "full_outer")


def attach_attributes(
    rows: DataFrame, attributes: DataFrame, columns: Sequence[str], visit: str = VISIT
) -> DataFrame:
    """Visit-level attributes on every row."""
    return rows.join(attributes.select(visit, *columns), visit, "left")


def windowed_means(
    df: DataFrame,
    columns: Sequence[str],
    *,
    hours: int = 12,
    keys: Sequence[str] = (VISIT,),
    time: str = TIME,
) -> DataFrame:
    """Mean per tumbling window and visit, empty windows in between as NULL rows.

    Windows are left-closed, labelled by their start and anchored at midnight of the
    visit's first day. Rows are first reduced to fine bins (sum and count), which
    combine before the shuffle, so a hot visit never travels row by row; only the
    reduced bins meet the visit's anchor.
    """
    keys = list(keys)
    width = hours * HOUR
    fine = math.gcd(width, DAY)
    values = {c: F.col(c).cast("double") for c in columns}
    binned = (
        df.where(F.col(time).isNotNull())
        .dropna(subset=keys)
        .groupBy(*keys, floor_to(micros(time), fine).alias("_bin"))
        .agg(*_partial(values, fine == width))
    )
    if fine != width:
        # all windows of a visit are offset from midnight of its first day
        anchor = binned.groupBy(*keys).agg(floor_to(F.min("_bin"), DAY).alias("_anchor"))
        sums = [F.sum(f"_s_{c}").alias(f"_s_{c}") for c in columns]
        counts = [F.sum(f"_n_{c}").alias(f"_n_{c}") for c in columns]
        binned = (
            binned.join(anchor, keys)
            .withColumn("_bin", floor_to(F.col("_bin"), width, F.col("_anchor")))
            .groupBy(*keys, "_bin")
            .agg(*sums, *counts)
            .select(*keys, "_bin", *[F.try_divide(f"_s_{c}", f"_n_{c}").alias(c) for c in columns])
        )
    grid = (
        binned.groupBy(*keys)
        .agg(F.min("_bin").alias("_lo"), F.max("_bin").alias("_hi"))
        .select(*keys, F.explode(F.sequence("_lo", "_hi", F.lit(width))).alias("_bin"))
    )
    return grid.join(binned, [*keys, "_bin"], "left").select(
        *keys, from_micros(F.col("_bin")).alias(time), *columns
    )


def _partial(values: dict[str, Column], final: bool) -> list[Column]:
    if final:
        return [F.avg(v).alias(c) for c, v in values.items()]
    sums = [F.sum(v).alias(f"_s_{c}") for c, v in values.items()]
    return sums + [F.count(v).alias(f"_n_{c}") for c, v in values.items()]


def sequence_numbers(
    df: DataFrame,
    *,
    keys: Sequence[str] = (VISIT,),
    order: Sequence[str] = (TIME,),
    start: int = 0,
    name: str = "seq_id",
    min_rows: int | None = None,
) -> DataFrame:
    """Position of a row in its visit."""
    numbered = ordered_scan(df, keys, order, number=name, min_rows=min_rows)
    return numbered.withColumn(name, F.col(name) - 1 + start)


def wide_resampled(
    long: DataFrame, features: Sequence[str], *, hours: int = 4, keys: Sequence[str] = (PERSON, VISIT)
) -> DataFrame:
    """Pivot, resample and number by person and visit (D6). Duplicates are averaged."""
    wide = to_wide(long, features, [*keys, TIME])
    return sequence_numbers(windowed_means(wide, features, hours=hours, keys=keys), keys=keys)
