"""Cohort, exposure, demographic and outcome queries."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

VISIT = "visit_occurrence_id"
PERSON = "person_id"


def validated(provider: str = "provider_id", mode: str = "staff") -> Column:
    """Record filter (B1): ``staff`` has a provider, ``device`` has none,
    ``listed`` has one of the providers 27 to 61."""
    column = F.col(provider)
    if mode == "staff":
        return column.isNotNull()
    if mode == "device":
        return column.isNull()
    if mode == "listed":
        return column.between(27, 61)
    raise ValueError(f"unknown record filter {mode}")


def latest_diagnosis(
    person: DataFrame, visits: DataFrame, conditions: DataFrame, concepts: DataFrame, concept_id: int
) -> DataFrame:
    """One row per visit with the diagnosis, the latest one (B2).

    The source ranks rows per visit; only the date orders them and no date leaves
    the query, so a max per visit is the same and combines before the shuffle.
    """
    dated = (
        conditions.where(F.col("condition_concept_id") == concept_id)
        .groupBy(VISIT, F.col("condition_concept_id").alias("concept_id"))
        .agg(F.max("condition_start_date").alias("condition_start_date"))
    )
    # at most one concept row matches
    named = concepts.where(F.col("concept_id") == concept_id).select(
        "concept_id", "concept_name", "concept_code"
    )
    return (
        dated.join(F.broadcast(named), "concept_id")
        .join(visits.select(VISIT, PERSON), VISIT)
        .join(person.select(PERSON, "year_of_birth", "gender_source_value"), PERSON)
        .select(
            VISIT, PERSON, "year_of_birth", "gender_source_value", "concept_id", "concept_name",
            "concept_code", "condition_start_date", F.lit(1).alias("sepsis_at_admission"),
        )
    )


def exposure_flag(
    records: DataFrame,
    visits: DataFrame,
    concepts: DataFrame,
    ids: Sequence[int],
    *,
    concept_column: str,
    time_column: str,
    flag: str,
    names: str,
    as_of: str,
    older_than: str,
    visit: str = VISIT,
) -> DataFrame:
    """Visits with at least one listed record, with the distinct names.

    ``as_of`` replaces the source's clock so the result does not depend on when it
    runs; names are sorted. The name set is bounded by the id list.
    """
    cutoff = F.expr(f"timestamp_ntz'{as_of}' - INTERVAL {older_than}")
    listed = concepts.where(F.col("concept_id").isin(list(ids))).select("concept_id", "concept_name")
    return (
        records.where(F.col(concept_column).isin(list(ids)) & (F.col(time_column) < cutoff))
        .select(visit, F.col(concept_column).alias("concept_id"))
        .join(F.broadcast(listed), "concept_id")
        .groupBy(visit)
        .agg(F.array_join(F.array_sort(F.collect_set("concept_name")), "; ").alias(names))
        .join(visits.select(visit), visit, "left_semi")
        .select(visit, F.lit(1).alias(flag), names)
    )


def combined_diagnosis(
    visits: DataFrame, diagnosis: DataFrame, *flags: DataFrame, visit: str = VISIT
) -> DataFrame:
    """All visits with the diagnosis and the exposure flags.

    The visit keeps its own person; the person seen through the diagnosis, which
    is missing for visits without it, is ``dx_person_id``.
    """
    dx = diagnosis.withColumnRenamed(PERSON, "dx_person_id").drop("condition_start_date")
    out = visits.join(dx, visit, "left")
    for frame in flags:
        out = out.join(frame, visit, "left")
    return out


def demographics(visits: DataFrame, person: DataFrame) -> DataFrame:
    """Age counted in year boundaries, and gender text, one row per visit."""
    return (
        visits.join(person, PERSON, "left")
        .select(
            VISIT,
            (F.year("visit_start_datetime") - F.col("year_of_birth")).cast("bigint").alias("age_at_visit"),
            "gender_source_value",
        )
        .distinct()
    )


def measurement_union(
    measurements: DataFrame, concepts: DataFrame, device_ids: DataFrame, listed_ids: DataFrame
) -> DataFrame:
    """Device rows of some concepts and listed-provider rows of others.

    Each branch is distinct; duplicates across the branches stay. ``device_ids``
    and ``listed_ids`` are one-column id frames.
    """
    columns = ["measurement_concept_id", "measurement_datetime", "value_as_number", VISIT]

    def branch(mode: str, ids: DataFrame) -> DataFrame:
        wanted = ids.select(F.col(ids.columns[0]).alias("measurement_concept_id"))
        return (
            measurements.where(validated(mode=mode))
            .select(*columns)
            .join(wanted, "measurement_concept_id", "left_semi")
            .distinct()
        )

    named = concepts.select(F.col("concept_id").alias("measurement_concept_id"), "concept_name")
    device = branch("device", device_ids).join(named, "measurement_concept_id", "left")
    # the id test of the second branch is on the concept table, so unknown ids drop out
    listed = branch("listed", listed_ids).join(named, "measurement_concept_id", "inner")
    order = ["measurement_concept_id", "concept_name", "measurement_datetime", "value_as_number", VISIT]
    return device.select(*order).unionByName(listed.select(*order))


def fluid_intake(measurements: DataFrame, concepts: DataFrame, ids: Sequence[int]) -> DataFrame:
    """Distinct device rows of the fluid concepts."""
    named = concepts.where(F.col("concept_id").isin(list(ids))).select(
        F.col("concept_id").alias("measurement_concept_id"), "concept_name"
    )
    return (
        measurements.where(validated(mode="device") & F.col("measurement_concept_id").isin(list(ids)))
        .join(F.broadcast(named), "measurement_concept_id")
        .select(
            PERSON, "measurement_concept_id", "concept_name", "measurement_datetime",
            "value_as_number", VISIT,
        )
        .distinct()
    )


def outcome(visits: DataFrame, death: DataFrame) -> DataFrame:
    """Death joined to each visit; in-hospital if inside the stay."""
    start, end, died = F.col("visit_start_datetime"), F.col("visit_end_datetime"), F.col("death_datetime")
    return (
        visits.join(death.select(PERSON, "death_datetime"), PERSON, "left")
        .select(
            PERSON, VISIT, died, start, end,
            F.abs(F.timestamp_diff("DAY", died, start)).alias("days_between"),
            F.coalesce(died.between(start, end).cast("int"), F.lit(0)).alias("died_in_hospital"),
        )
        .distinct()
    )


def outcome_per_visit(outcomes: DataFrame) -> DataFrame:
    """One row per visit."""
    return outcomes.groupBy(VISIT).agg(F.max("died_in_hospital").alias("died_in_hospital"))


def attach_outcome(windows: DataFrame, outcomes: DataFrame) -> DataFrame:
    """Outcome on every window, none known counts as survived."""
    return windows.join(outcome_per_visit(outcomes), VISIT, "left").withColumn(
        "died_in_hospital", F.coalesce("died_in_hospital", F.lit(0))
    )


def gender_flag(df: DataFrame, gender: str = "gender_source_value", age: str = "age_at_visit") -> DataFrame:
    """Gender text to 1 (man), 0 (vrouw) or missing; age as double."""
    text = F.lower(F.col(gender))
    return df.withColumn(
        "Gender", F.when(text.contains("vrouw"), 0.0).when(text.contains("man"), 1.0)
    ).withColumn(age, F.col(age).cast("double"))


def attach_feature(
    measurements: DataFrame, dictionary: DataFrame, concept: str = "measurement_concept_id"
) -> DataFrame:
    """Feature name by concept id, rows without one stay."""
    names = dictionary.select("feature_name", F.col("concept_id").cast("bigint").alias("concept_id"))
    return measurements.join(names, measurements[concept] == names["concept_id"], "left")
