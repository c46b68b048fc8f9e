"""Organ-failure scores and the shock cohort."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from icuriver.functions import concepts as C
from icuriver.functions.numeric import band_score, row_total
from icuriver.operators.cohort import PERSON, VISIT

SCORES = (
    "sofa_respiration_score", "sofa_coagulation_score", "sofa_liver_score",
    "sofa_cardiovascular_score", "sofa_cns_score", "sofa_renal_score",
)


def respiration(oxygenation: DataFrame) -> DataFrame:
    """Unit repair and respiration score.

    FiO2 above 100 is missing, 20..100 is a percentage, anything else above 1 is
    missing; arterial oxygen below 50 drops the row.
    """
    raw, ratio = F.col("fio2").cast("double"), F.col("pf_ratio")
    fraction = (
        F.when(raw > 100, None).when((raw <= 100) & (raw >= 20), raw / 100).when(raw > 1, None).otherwise(raw)
    )
    supported = F.coalesce(F.col("ventilatory_support"), F.lit(False))
    score = (
        F.when((ratio < 100) & supported, 4)
        .when((ratio < 200) & (ratio >= 100) & supported, 3)
        .when(ratio < 300, 2)
        .when((ratio < 400) & (ratio >= 300), 1)
        .otherwise(0)
    )
    return (
        oxygenation.withColumn("pao2", F.col("pao2").cast("double"))
        .where(F.col("pao2") >= 50)
        .withColumn("fio2", fraction)
        .withColumn("pf_ratio", F.try_divide(F.col("pao2"), F.col("fio2")))
        .withColumn("sofa_respiration_score", score)
    )


def coagulation(rows: DataFrame) -> DataFrame:
    return rows.withColumn("sofa_coagulation_score", band_score(F.col("value"), C.COAGULATION_BANDS))


def liver(rows: DataFrame) -> DataFrame:
    return rows.withColumn("sofa_liver_score", band_score(F.col("value"), C.LIVER_BANDS))


def cardiovascular_drugs(doses: DataFrame) -> DataFrame:
    """Per visit and drug: total duration, top dose, score (C4)."""
    return score_drug_peaks(
        doses.dropna(subset=[VISIT, "itemid", "item"])
        .groupBy(VISIT, "itemid", "item")
        .agg(F.sum("duration").alias("total_duration"), F.max("gamma").alias("max_gamma"))
    )


def score_drug_peaks(peaks: DataFrame) -> DataFrame:
    """Score of the top dose per visit and drug. Dopamine at exactly 15 scores 0, as in the source."""
    item, top = F.col("itemid"), F.col("max_gamma")
    strong = item.isin([C.EPINEPHRINE, C.NOREPINEPHRINE])
    dopamine = item == C.DOPAMINE
    score = (
        F.when((dopamine & (top > 15)) | (strong & (top > 0.1)), 4)
        .when((dopamine & (top > 5) & (top < 15)) | (strong & (top <= 0.1)), 3)
        .when((dopamine & (top <= 5)) | (item == C.DOBUTAMINE), 2)
        .otherwise(0)
    )
    return peaks.dropna(subset=[VISIT, "itemid", "item"]).withColumn("sofa_cardiovascular_score", score)


def cardiovascular_pressure(rows: DataFrame) -> DataFrame:
    """Lowest mean pressure per visit and item, 1 point below 70."""
    return (
        rows.where((F.col("value") <= 165) & (F.col("value") > 30))
        .na.drop()
        .groupBy(VISIT, "itemid", "item")
        .agg(F.min("value").alias("lowest_mean_abp"))
        .withColumn("sofa_cardiovascular_score", band_score(F.col("lowest_mean_abp"), C.PRESSURE_BANDS))
    )


def cns(coma: DataFrame) -> DataFrame:
    return (
        coma.dropna(subset=[VISIT])
        .groupBy(VISIT)
        .agg(F.min("gcs_score").alias("min_gcs"))
        .withColumn("sofa_cns_score", band_score(F.col("min_gcs"), C.COMA_BANDS))
    )


def renal_urine(rows: DataFrame) -> DataFrame:
    """Daily urine; above 2500 is taken as a decimal slip (C7). Exactly 200 scores 0."""
    value = F.col("value")
    repaired = F.when(value > 2500, value / 10).otherwise(value)
    return (
        rows.withColumn("value", repaired)
        .where(F.col("value") <= 4500)
        .na.drop()
        .groupBy(VISIT)
        .agg(F.sum("value").alias("daily_urine_output"))
        .withColumn("sofa_renal_score", band_score(F.col("daily_urine_output"), C.URINE_BANDS))
    )


def renal_creatinine(rows: DataFrame) -> DataFrame:
    return (
        rows.where(F.col("value") >= 30)
        .dropna(subset=[VISIT])
        .groupBy(VISIT)
        .agg(F.max("value").alias("max_creatinine"))
        .withColumn("sofa_renal_score", band_score(F.col("max_creatinine"), C.CREATININE_BANDS))
    )


def shock_flag(lactate: DataFrame) -> DataFrame:
    """Shock if the highest lactate is above 2."""
    return (
        lactate.na.drop()
        .groupBy(VISIT)
        .agg(F.max("value").alias("max_lactate"))
        .withColumn("septic_shock", F.col("max_lactate") > 2.0)
    )


def strongest_evidence(first: DataFrame, second: DataFrame, score: str) -> DataFrame:
    """Union of two sources with different columns, then the maximum per visit."""
    both = first.unionByName(second, allowMissingColumns=True)
    return both.dropna(subset=[VISIT]).groupBy(VISIT).agg(F.max(score).alias(score))


def assemble_scores(visits: DataFrame, sources: Sequence[tuple[DataFrame, Sequence[str]]]) -> DataFrame:
    """All visits with the maximum of each source column (C11).

    Sources are stacked and reduced by one aggregate, so the visit key is shuffled
    once instead of once per source.
    """
    columns = [c for _, cols in sources for c in cols]
    stacked = visits.select(VISIT).dropna()
    keyed = stacked
    for frame, cols in sources:
        keyed = keyed.unionByName(frame.select(VISIT, *cols), allowMissingColumns=True)
    best = keyed.dropna(subset=[VISIT]).groupBy(VISIT).agg(*[F.max(c).alias(c) for c in columns])
    return stacked.join(best, VISIT, "left")


def total_score(scores: DataFrame, *, literal: bool = False) -> DataFrame:
    """Row total ignoring missing values.

    The six scores by default. ``literal`` adds every column of the frame, which is
    what the source sums: ratio, FiO2, oxygen and the shock flag as well.
    """
    columns = [c for c in scores.columns if c != VISIT] if literal else list(SCORES)
    return scores.withColumn("sofa_total_score", row_total(columns))


def shock_cohort(diagnoses: DataFrame, scores: DataFrame) -> DataFrame:
    """Visits with the diagnosis, or suspected infection with two points, flagged.

    Adds ``septic`` and ``septic_shock``; filter on both for the final cohort.
    """
    joined = diagnoses.join(scores, VISIT, "inner").withColumn(
        "septic_shock", F.coalesce("septic_shock", F.lit(False))
    )
    suspected = (
        (F.col("sepsis_antibiotics_bool") == 1)
        & (F.col("sepsis_cultures_bool") == 1)
        & (F.col("sofa_total_score") >= 2)
    )
    septic = F.coalesce(F.col("sepsis_at_admission") == 1, F.lit(False)) | F.coalesce(suspected, F.lit(False))
    return joined.where(septic)


def cohort_counts(cohort: DataFrame) -> DataFrame:
    """Distinct persons and visits, all septic and in shock (C14)."""
    shock = F.col("septic_shock")
    return cohort.agg(
        F.countDistinct(PERSON).alias("septic_persons"),
        F.countDistinct(VISIT).alias("septic_visits"),
        F.countDistinct(F.when(shock, F.col(PERSON))).alias("shock_persons"),
        F.countDistinct(F.when(shock, F.col(VISIT))).alias("shock_visits"),
    )
