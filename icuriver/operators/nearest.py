"""Nearest-in-time match of two irregular series per visit."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from icuriver.functions import concepts as C
from icuriver.functions.ordered import ordered_scan
from icuriver.functions.timegrid import micros, whole
from icuriver.operators.cohort import VISIT, validated


def nearest_in_time(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    left_time: str,
    right_time: str,
    take: Sequence[str],
    *,
    min_rows: int | None = None,
) -> DataFrame:
    """For each left row the right row of the same key nearest in time, either way.

    Equal distances go to the earlier time; right rows at one instant to the lowest
    ``take`` values. Adds ``take`` and ``right_time`` (NULL when the key has no right
    row). The nearest row is the last one before or the first one after, so both
    sides are merged in one ordered pass: n + m work, no pair is ever formed.
    """
    keys = list(keys)
    instants = right.groupBy(*keys, right_time).agg(F.min(F.struct(*take)).alias("_take"))
    lefts = left.where(F.col(left_time).isNotNull()).select(
        *keys,
        F.col(left_time).alias("_t"),
        F.lit(1).alias("_side"),
        F.struct(*left.columns).alias("_left"),
    )
    rights = instants.select(
        *keys,
        F.col(right_time).alias("_t"),
        F.lit(0).alias("_side"),
        F.struct(F.col(right_time).alias("t"), F.col("_take").alias("v")).alias("_right"),
    )
    both = lefts.unionByName(rights, allowMissingColumns=True)
    scanned = ordered_scan(
        both, keys, ["_t", "_side"],
        last={"_prev": F.col("_right")}, following={"_next": F.col("_right")}, min_rows=min_rows,
    ).where(F.col("_side") == 1)
    t = micros("_t")
    earlier = t - micros(F.col("_prev.t"))
    later = micros(F.col("_next.t")) - t
    best = F.when(
        F.col("_next").isNull() | (F.col("_prev").isNotNull() & (earlier <= later)), F.col("_prev")
    ).otherwise(F.col("_next"))
    return scanned.withColumn("_best", best).select(
        "_left.*", F.col("_best.t").alias(right_time), *[F.col(f"_best.v.{c}").alias(c) for c in take]
    )


def oxygenation(
    measurements: DataFrame,
    visits: DataFrame,
    fio2: DataFrame,
    *,
    time_from: str | None = None,
) -> DataFrame:
    """Arterial oxygen with the FiO2 nearest in time, one row per visit and time.

    kPa is converted to mmHg. Unmatched rows stay. ``time_from='right'`` adds the
    FiO2 row's time as ``measurement_datetime``. The carbon dioxide join of the
    source adds no column and only repeats rows before the rank, so it is left out.
    """
    staff = measurements.where(validated())
    at = [VISIT, "measurement_datetime"]
    specimen = (
        staff.where(F.col("measurement_concept_id") == C.SPECIMEN)
        .groupBy(*at)
        .agg(F.min("value_as_number").alias("specimen_source"))
    )
    value = F.when(F.col("unit_concept_id") == C.KPA_UNIT, F.col("value_as_number") * C.KPA_TO_MMHG)
    samples = (
        staff.where(F.col("measurement_concept_id") == C.PAO2)
        .select(*at, F.coalesce(value, F.col("value_as_number")).alias("pao2"))
        .groupBy(*at)
        .agg(F.min("pao2").alias("pao2"))
        .join(specimen, at, "left")
        .join(visits.select(VISIT, "visit_start_datetime"), VISIT, "left")
        .withColumnRenamed("measurement_datetime", "pao2_time")
    )
    right = fio2.select(VISIT, F.col("measurement_datetime").alias("fio2_time"), "fio2", "ventilatory_support")
    matched = nearest_in_time(
        samples, right, [VISIT], "pao2_time", "fio2_time", ["fio2", "ventilatory_support"]
    )
    extra = [F.col("fio2_time").alias("measurement_datetime")] if time_from == "right" else []
    return matched.select(
        VISIT,
        "pao2",
        "specimen_source",
        F.lit(True).alias("manual_entry"),
        whole("HOUR", F.col("visit_start_datetime"), F.col("pao2_time")).alias("time"),
        "fio2",
        "ventilatory_support",
        whole("MINUTE", F.col("pao2_time"), F.col("fio2_time")).alias("fio2_time_difference"),
        *extra,
    )
