"""Reading: clinical tables, feature dictionary, id restriction, coercion."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from icuriver.functions.numeric import nan_to_null, to_double, to_timestamp

CLINICAL_TABLES = (
    "measurement", "observation", "visit_occurrence", "person", "concept",
    "condition_occurrence", "drug_exposure", "death",
)
DICTIONARY_SCHEMA = "category string, feature_name string, concept_name string, concept_id bigint"
TRIAL_SCHEMA = (
    "number int, value double, datetime_start timestamp_ntz, datetime_complete timestamp_ntz, "
    "duration string, params_batch_size int, params_latent_dim int, params_layer_sizes string, "
    "params_lr double, state string"
)


def read_table(spark: SparkSession, source: str, columns: Sequence[str] | None = None) -> DataFrame:
    """A parquet path (anything with a slash) or a catalog table, NaN read as NULL."""
    df = spark.read.parquet(source) if "/" in source else spark.table(source)
    return nan_to_null(df.select(*columns) if columns else df)


def read_clinical(spark: SparkSession, base: str) -> dict[str, DataFrame]:
    """The eight clinical tables under a folder or in a catalog schema (A1)."""
    name = (lambda t: f"{base.rstrip('/')}/{t}.parquet") if "/" in base else (lambda t: f"{base}.{t}")
    return {t: read_table(spark, name(t)) for t in CLINICAL_TABLES}


def all_admissions(visits: DataFrame) -> DataFrame:
    """Every visit with every column (A2)."""
    return visits.select("*")


def read_dictionary(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.csv(path, header=True, schema=DICTIONARY_SCHEMA)


def used_features(dictionary: DataFrame) -> DataFrame:
    """Rows whose feature is not marked unused with ``_`` (A3)."""
    return dictionary.where(F.col("feature_name") != "_")


def feature_concepts(dictionary: DataFrame, names: Sequence[str] | None = None) -> DataFrame:
    """Concept ids present in the dictionary, for all or some feature names (A3)."""
    rows = used_features(dictionary).where(F.col("concept_id").isNotNull())
    if names is not None:
        rows = rows.where(F.col("feature_name").isin(list(names)))
    return rows.select("feature_name", F.col("concept_id").cast("bigint").alias("concept_id"))


def restrict_to(df: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    """Keep rows whose key is among the ids; scales past any literal list (A4)."""
    return df.join(ids.select(key), key, "left_semi")


def coerce(df: DataFrame, numbers: Sequence[str] = (), times: Sequence[str] = ()) -> DataFrame:
    """Unparsable numbers and times become NULL, as does NaN."""
    casts = {c: F.nanvl(to_double(c), F.lit(None)) for c in numbers}
    return df.withColumns(casts | {c: to_timestamp(c) for c in times})


def read_trials(spark: SparkSession, path: str) -> DataFrame:
    """Trial table with an unnamed row-number column in front."""
    named = spark.read.csv(path, header=True, schema="row int, " + TRIAL_SCHEMA)
    return named.drop("row")
