"""Admission-window extracts, infusion dosing, coma score, creatinine."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from icuriver.functions import concepts as C
from icuriver.functions.numeric import regex_number
from icuriver.functions.timegrid import whole
from icuriver.operators.cohort import PERSON, VISIT, validated


def since_admission(unit: str, time: str) -> Column:
    """Whole units from visit start, truncated toward zero."""
    return whole(unit, F.col("visit_start_datetime"), F.col(time))


def _with_start(rows: DataFrame, visits: DataFrame) -> DataFrame:
    return rows.join(visits.select(VISIT, "visit_start_datetime"), VISIT, "left")


def admission_extract(
    measurements: DataFrame,
    visits: DataFrame,
    ids: Sequence[int],
    *,
    unit: str | None = "HOUR",
    lower: float | None = None,
    upper: float | None = None,
    mode: str | None = "staff",
    flag_validated: bool = False,
) -> DataFrame:
    """Rows of some concepts within a span around admission.

    The span is in whole units, so hours BETWEEN -0.5 AND 24 admits 59 minutes
    before admission up to 24 h 59 min after it. ``unit=None`` sets no span.
    """
    rows = measurements.where(F.col("measurement_concept_id").isin(list(ids)))
    if mode is not None:
        rows = rows.where(validated(mode=mode))
    who = (
        F.col("provider_id").isNotNull().alias("validated")
        if flag_validated
        else F.col("provider_id").alias("registeredby")
    )
    columns = [
        F.col(VISIT),
        F.col("measurement_concept_id").alias("itemid"),
        F.col("measurement_source_value").alias("item"),
        F.col("value_as_number").alias("value"),
        who,
    ]
    if unit is None:
        return rows.select(*columns)
    timed = _with_start(rows, visits).select(
        *columns, since_admission(unit, "measurement_datetime").alias("time")
    )
    if lower is not None:
        timed = timed.where(F.col("time") >= lower)
    if upper is not None:
        timed = timed.where(F.col("time") <= upper)
    return timed


def platelets(measurements: DataFrame, visits: DataFrame) -> DataFrame:
    return admission_extract(measurements, visits, C.PLATELETS, lower=-0.5, upper=24)


def bilirubin(measurements: DataFrame, visits: DataFrame) -> DataFrame:
    return admission_extract(measurements, visits, C.BILIRUBIN, lower=-0.5, upper=24)


def lactate(measurements: DataFrame, visits: DataFrame) -> DataFrame:
    return admission_extract(measurements, visits, C.LACTATE, unit=None)


def blood_pressure(measurements: DataFrame, visits: DataFrame) -> DataFrame:
    """Any provider, no lower bound."""
    return admission_extract(
        measurements, visits, C.MEAN_BLOOD_PRESSURE, unit="MINUTE", upper=1440, mode=None,
        flag_validated=True,
    )


def urine_output(measurements: DataFrame, visits: DataFrame) -> DataFrame:
    return admission_extract(measurements, visits, C.URINE, unit="MINUTE", lower=0, upper=1440)


def _stepped(flow: Column, steps: Sequence[tuple[float, float]]) -> Column:
    fraction = F.lit(C.ROOM_AIR)
    for start, value in steps:
        fraction = F.when(flow >= start, F.lit(value)).otherwise(fraction)
    return fraction


def fio2_estimate(
    measurements: DataFrame,
    observations: DataFrame,
    visits: DataFrame,
    *,
    first_day: bool = True,
    device_column: str = "observation_concept_id",
) -> DataFrame:
    """Inspired oxygen fraction with its time and a ventilation flag.

    The source joins observations on one concept id and then tests that same
    column for device ids, so its flow tables never apply; that is the default.
    Name the column that really holds the device to use them.
    """
    flow = F.col("value_as_number")
    rows = measurements.where(
        validated() & F.col("measurement_concept_id").isin(list(C.OXYGEN)) & (flow > 0)
    ).select(VISIT, "measurement_datetime", "measurement_concept_id", "value_as_number")
    if first_day:
        hours = since_admission("HOUR", "measurement_datetime")
        rows = _with_start(rows, visits).where((hours <= 24) & (hours >= 0)).drop("visit_start_datetime")
    device = observations.where(
        validated() & (F.col("observation_concept_id") == C.OXYGEN_DEVICE)
    ).select(
        VISIT,
        F.col("observation_datetime").alias("measurement_datetime"),
        F.col("value_as_number").alias("o2_value"),
        F.col(device_column).cast("bigint").alias("o2_device"),
    )
    ventilator = F.col("measurement_concept_id").isin(list(C.VENTILATOR_OXYGEN))
    estimate = F.lit(C.ROOM_AIR)
    for ids, steps in C.FIO2_STEPS:
        estimate = F.when(F.col("o2_device").isin(list(ids)), _stepped(flow, steps)).otherwise(estimate)
    return rows.join(device, [VISIT, "measurement_datetime"], "left").select(
        VISIT,
        "measurement_datetime",
        "o2_value",
        "o2_device",
        ventilator.alias("ventilatory_support"),
        F.when(ventilator, F.coalesce(flow, F.lit(C.ROOM_AIR))).otherwise(estimate).alias("fio2"),
    )


def body_weights(measurements: DataFrame) -> DataFrame:
    """Device rows of the body weight concepts."""
    return measurements.where(
        validated(mode="device") & F.col("measurement_concept_id").isin(list(C.BODY_WEIGHT))
    ).select(VISIT, F.col("value_as_number").alias("patientweight"))


def infusion_rows(
    drugs: DataFrame, visits: DataFrame, concepts: DataFrame, *, first_day: bool = True, timed: bool = True
) -> DataFrame:
    """Vasoactive infusions with dose and rate parsed from text, without body weight."""
    wanted = list(C.VASOACTIVE)
    named = concepts.where(F.col("concept_id").isin(wanted)).select(
        F.col("concept_id").alias("itemid"), F.col("concept_name").alias("item")
    )
    start, stop = F.col("drug_exposure_start_datetime"), F.col("drug_exposure_end_datetime")
    doses = (
        drugs.where(F.col("drug_concept_id").isin(wanted))
        .withColumns({
            "itemid": F.col("drug_concept_id"),
            "duration": whole("MINUTE", start, stop),
            "dose": regex_number(F.col("sig"), C.DOSE_PATTERN),
            "rate": regex_number(F.col("sig"), C.RATE_PATTERN),
        })
        .where(F.col("rate") > 0.1)
        .join(F.broadcast(named), "itemid")
    )
    if first_day or timed:
        doses = _with_start(doses, visits).withColumns({
            "start_time": since_admission("MINUTE", "drug_exposure_start_datetime"),
            "stop_time": since_admission("MINUTE", "drug_exposure_end_datetime"),
        })
    if first_day:
        doses = doses.where((F.col("start_time") <= 1440) & (F.col("stop_time") >= 0))
    return doses


def _gamma(rate: Column, weight: Column) -> Column:
    """mg per hour to micrograms per kg and minute."""
    return F.try_divide(F.try_divide(rate * 1000, weight), F.lit(60))


def infusion_doses(
    drugs: DataFrame,
    visits: DataFrame,
    concepts: DataFrame,
    measurements: DataFrame,
    *,
    first_day: bool = True,
    weight_agg: str | None = None,
    absolute: bool = False,
) -> DataFrame:
    """Vasoactive infusions with dose per body weight.

    Every body weight of the visit multiplies the infusion rows, as in the source;
    ``weight_agg`` (min, max, avg) gives one row per infusion instead. ``absolute``
    returns person and start/stop times in place of minutes since admission.
    """
    weight = body_weights(measurements)
    if weight_agg is not None:
        weight = weight.groupBy(VISIT).agg(F.expr(f"{weight_agg}(patientweight)").alias("patientweight"))
    doses = infusion_rows(drugs, visits, concepts, first_day=first_day, timed=not absolute)
    head = [PERSON, VISIT] if absolute else [VISIT]
    times = (
        [
            F.col("drug_exposure_start_datetime").alias("start_datetime"),
            F.col("drug_exposure_end_datetime").alias("stop_datetime"),
        ]
        if absolute
        else [F.col("start_time"), F.col("stop_time")]
    )
    return doses.join(weight, VISIT, "left").select(
        *head, "itemid", "item", "duration", "dose", "rate", F.lit("mg/uur").alias("rateunit"), *times,
        "patientweight", _gamma(F.col("rate"), F.col("patientweight")).alias("gamma"),
    )


def infusion_peaks(
    drugs: DataFrame, visits: DataFrame, concepts: DataFrame, measurements: DataFrame
) -> DataFrame:
    """Total duration and top dose per visit and drug of the first-day infusions (B15 into C4).

    Equals aggregating :func:`infusion_doses` without pairing infusions and weights:
    the total is the summed duration times the number of weights, and the top dose
    pairs the highest rate with the lowest positive weight.
    """
    per_drug = (
        infusion_rows(drugs, visits, concepts)
        .groupBy(VISIT, "itemid", "item")
        .agg(F.sum("duration").alias("_minutes"), F.max("rate").alias("_top"), F.min("rate").alias("_low"))
    )
    w = F.col("patientweight")
    weights = body_weights(measurements).groupBy(VISIT).agg(
        F.count(F.lit(1)).alias("_weights"), F.min(F.when(w > 0, w)).alias("_light"), F.min(w).alias("_least")
    )
    top = F.coalesce(
        _gamma(F.col("_top"), F.col("_light")),
        # only negative weights: the quotient closest to zero
        _gamma(F.col("_low"), F.col("_least")),
    )
    return per_drug.join(weights, VISIT, "left").select(
        VISIT, "itemid", "item",
        (F.col("_minutes") * F.coalesce("_weights", F.lit(1))).alias("total_duration"),
        top.alias("max_gamma"),
    )


def _points(concept: int, answers: Mapping[int, int]) -> Column:
    score = F.lit(None).cast("int")
    for answer, points in answers.items():
        score = F.when(F.col("value_as_concept_id") == answer, F.lit(points)).otherwise(score)
    return F.when(F.col("measurement_concept_id") == concept, score)


def coma_score(measurements: DataFrame, visits: DataFrame, *, combine: bool = False) -> DataFrame:
    """Latest coma score per visit within the first day.

    The three components sit on different rows and the source never adds them up;
    ``combine`` sums the components recorded at one time first.
    """
    rows = measurements.where(
        validated() & F.col("measurement_concept_id").isin([C.EYES, C.MOTOR, C.VERBAL])
    )
    timed = (
        _with_start(rows, visits)
        .select(
            VISIT,
            _points(C.EYES, C.EYES_POINTS).alias("eyes_score"),
            _points(C.MOTOR, C.MOTOR_POINTS).alias("motor_score"),
            _points(C.VERBAL, C.VERBAL_POINTS).alias("verbal_score"),
            "provider_id",
            "measurement_datetime",
            since_admission("MINUTE", "measurement_datetime").alias("time"),
        )
        .where(F.col("time") <= 1440)
    )
    if combine:
        timed = timed.groupBy(VISIT, "measurement_datetime", "time").agg(
            *[F.max(c).alias(c) for c in ("eyes_score", "motor_score", "verbal_score")],
            F.max("provider_id").alias("provider_id"),
        )
    zero = F.lit(0)
    scored = timed.withColumn(
        "gcs_score",
        F.coalesce("eyes_score", zero)
        + F.coalesce("motor_score", zero)
        + F.greatest(F.coalesce("verbal_score", zero), F.lit(1)),
    )
    columns = ["eyes_score", "motor_score", "verbal_score", "provider_id", "time", "gcs_score"]
    rank = F.struct("time", "gcs_score", "provider_id", "eyes_score", "motor_score", "verbal_score")
    return (
        scored.groupBy(VISIT)
        .agg(F.max_by(F.struct(*columns), rank).alias("top"))
        .select(VISIT, "top.*")
    )


def creatinine(measurements: DataFrame, visits: DataFrame) -> DataFrame:
    """Creatinine around admission with baseline, 7-day maximum and failure flag.

    Baseline and maximum are conditional aggregates of one pass.
    """
    rows = _with_start(
        measurements.where(validated() & F.col("measurement_concept_id").isin(list(C.CREATININE))),
        visits,
    ).withColumns({
        "hours": since_admission("HOUR", "measurement_datetime"),
        "time": since_admission("MINUTE", "measurement_datetime"),
    })
    hours, value = F.col("hours"), F.col("value_as_number")
    levels = rows.groupBy(VISIT).agg(
        F.min(F.when((hours > -8760) & (hours < 24), value)).alias("baseline_creatinine"),
        F.max(F.when(hours.between(0, 168), value)).alias("max_creatinine_7days"),
    )
    base, top = F.col("baseline_creatinine"), F.col("max_creatinine_7days")
    failing = ((base > 0) & (F.try_divide(top, base) > 3)) | ((top >= 354) & (top - base >= 44))
    return (
        rows.where(F.col("time").between(-30, 1440))
        .join(levels, VISIT, "left")
        .select(
            VISIT,
            F.col("measurement_concept_id").alias("itemid"),
            F.col("measurement_source_value").alias("item"),
            value.alias("value"),
            F.col("provider_id").alias("registeredby"),
            "time",
            base,
            top,
            F.coalesce(failing, F.lit(False)).alias("acute_renal_failure"),
        )
    )
