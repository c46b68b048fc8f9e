"""Clinical-shaped views of the given tables.

``events`` stands for the bedside record: a user is a visit, an event becomes one
measurement (concept by ``event_id``), purchases become infusions and antibiotics.
The clock runs ten times slower than the table's, so that thirty days fall within the
three days around admission. ``customer`` / ``orders`` / ``lineitem`` / ``part`` stand for
person / visit / exposure / concept. Every view is a row-wise projection, so work grows
with the tables. The SQL text of the same views feeds the checks.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

FEATURES = ["click", "error", "purchase", "signup", "view"]
_START = "2024-01-01 00:00:00"

_CONCEPT = """CAST(CASE k WHEN 0 THEN 3025408 WHEN 1 THEN 3014080 WHEN 2 THEN 3027315 WHEN 3 THEN 3007461
 WHEN 4 THEN 3006140 WHEN 5 THEN 3014111 WHEN 6 THEN 3025315 WHEN 7 THEN 21490852 WHEN 8 THEN 3016335
 WHEN 9 THEN 3026549 WHEN 10 THEN 3009094 WHEN 11 THEN 3014315 WHEN 12 THEN 3020564 WHEN 13 THEN 3010494
 WHEN 14 THEN 21492241 WHEN 15 THEN 3014315 WHEN 16 THEN 1761466 WHEN 17 THEN 3027018 WHEN 18 THEN 3022060
 ELSE 3024171 END AS BIGINT)"""
_VALUE = """CASE k WHEN 0 THEN 21 + value % 90 WHEN 1 THEN value % 12 - 1 WHEN 2 THEN
 CASE WHEN r % 2 = 0 THEN (40 + value) / 8 ELSE 40 + value END WHEN 3 THEN value * 2 WHEN 4 THEN value * 3
 WHEN 5 THEN value / 30 WHEN 6 THEN 50 + value % 60 WHEN 7 THEN 20 + value WHEN 11 THEN value * 30
 WHEN 12 THEN 20 + value * 4 WHEN 13 THEN value * 5 WHEN 14 THEN 30 + value WHEN 15 THEN value * 3
 WHEN 18 THEN 35 + value % 6 ELSE value END"""
_ANSWER = """CAST(CASE k WHEN 8 THEN CASE r % 5 WHEN 0 THEN 45877537 WHEN 1 THEN 45883351 WHEN 2 THEN 45880465
 WHEN 3 THEN 45880466 END WHEN 9 THEN CASE r % 6 WHEN 0 THEN 45878992 WHEN 1 THEN 45878993
 WHEN 2 THEN 45879885 WHEN 3 THEN 45882047 WHEN 4 THEN 45880468 END WHEN 10 THEN CASE r % 7
 WHEN 0 THEN 36311192 WHEN 1 THEN 45877384 WHEN 2 THEN 45883352 WHEN 3 THEN 45877601 WHEN 4 THEN 45883906
 WHEN 5 THEN 45877602 END END AS BIGINT)"""
_PROVIDER = """CAST(CASE WHEN k IN (6, 13, 18) THEN CASE WHEN r % 6 = 5 THEN 40 END ELSE CASE r % 6
 WHEN 1 THEN 27 WHEN 2 THEN 61 WHEN 3 THEN 62 WHEN 4 THEN 40 WHEN 5 THEN 1 END END AS BIGINT)"""
_PERSON = "CAST((user_id - user_id % 2) / 2 AS BIGINT)"
_DEVICE = """CAST(CASE r % 4 WHEN 0 THEN 4224038 WHEN 1 THEN 45759142 WHEN 2 THEN 4235033 ELSE 45879331 END AS DOUBLE)"""
_DRUG = """CAST(CASE event_id % 8 WHEN 0 THEN 36411287 WHEN 1 THEN 21088391 WHEN 2 THEN 19076867 WHEN 3 THEN 2907531
 WHEN 4 THEN 36258242 WHEN 5 THEN 40730323 WHEN 6 THEN 43295826 ELSE 42479695 END AS BIGINT)"""
_SIG = """CASE WHEN event_id % 5 = 0 THEN 'no dose recorded' WHEN event_id % 5 = 1 THEN
 concat(CAST(value AS {text}), ' mg once') ELSE concat(CAST(value AS {text}), ' mg @ ', CAST(value AS {text}), ' mg/uur') END"""

_MEASUREMENT = [
    f"{_PERSON} AS person_id", "user_id AS visit_occurrence_id", f"{_CONCEPT} AS measurement_concept_id",
    "event_type AS measurement_source_value", "dt AS measurement_datetime", f"{_VALUE} AS value_as_number",
    f"{_ANSWER} AS value_as_concept_id",
    "CAST(CASE WHEN k = 2 THEN CASE WHEN r % 2 = 0 THEN 152 ELSE 8876 END END AS BIGINT) AS unit_concept_id",
    f"{_PROVIDER} AS provider_id",
]
# samples drawn with the oxygen measurement: specimen source and carbon dioxide
_COMPANION = [
    f"{_PERSON} AS person_id", "user_id AS visit_occurrence_id",
    "CAST(CASE WHEN r % 2 = 0 THEN 3053213 ELSE 3013290 END AS BIGINT) AS measurement_concept_id",
    "event_type AS measurement_source_value", "dt AS measurement_datetime", "value AS value_as_number",
    "CAST(NULL AS BIGINT) AS value_as_concept_id", "CAST(NULL AS BIGINT) AS unit_concept_id",
    "CAST(27 AS BIGINT) AS provider_id",
]
_OBSERVATION = [
    "user_id AS visit_occurrence_id", "CAST(45769206 AS BIGINT) AS observation_concept_id",
    "dt AS observation_datetime", f"{_DEVICE} AS value_as_number",
    "CAST(CASE WHEN r % 5 > 0 THEN 27 END AS BIGINT) AS provider_id",
]
_CONDITION = [
    "user_id AS visit_occurrence_id",
    "CAST(CASE WHEN event_id % 9 = 0 THEN 132797 ELSE 4000000 END AS BIGINT) AS condition_concept_id",
    "CAST(dt AS DATE) AS condition_start_date",
]
CONCEPTS_SQL = """SELECT CAST(concept_id AS BIGINT) AS concept_id, concept_name, concept_code FROM (VALUES
 (132797, 'Sepsis', 'S1'), (36411287, 'Dopamine solution', 'D1'), (21088391, 'Dobutamine injection', 'D2'),
 (19076867, 'Epinephrine solution', 'D3'), (2907531, 'Norepinephrine injection', 'D4'),
 (36258242, 'Amikacin', 'A1'), (40730323, 'Ceftazidime', 'A2'), (43295826, 'Vancomycin', 'P1'),
 (42479695, 'Metronidazole', 'P2'), (1761466, 'Blood culture', 'C1'), (3025315, 'Body weight', 'W1'),
 (3022060, 'Rectal temperature', 'T1'), (3010494, 'Fluid intake', 'F1'), (3007461, 'Platelets', 'L1'),
 (3006140, 'Bilirubin', 'L2'), (3014111, 'Lactate', 'L3'), (3020564, 'Creatinine', 'L4'),
 (3027018, 'Heart rate', 'V1'), (3024171, 'Respiratory rate', 'V2')
) AS t(concept_id, concept_name, concept_code)"""
# feature dictionary of our own: feature name by concept
DICTIONARY_SQL = """SELECT category, feature_name, concept_name, CAST(concept_id AS BIGINT) AS concept_id FROM (VALUES
 ('Body', 'Weight', 'Body weight', 3025315), ('Body', 'Temperature', 'Rectal temperature', 3022060),
 ('Lab', 'Platelets', 'Platelets', 3007461), ('Lab', 'Bilirubin', 'Bilirubin', 3006140),
 ('Lab', 'Lactate', 'Lactate', 3014111), ('Lab', 'Creatinine', 'Creatinine', 3020564),
 ('Vital', 'Heart_rate', 'Heart rate', 3027018), ('Vital', 'Respiratory_rate', 'Respiratory rate', 3024171),
 ('Other', '_', 'Blood culture', 1761466), ('Body', 'Age', NULL, NULL)
) AS t(category, feature_name, concept_name, concept_id)"""
CLINICAL_FEATURES = ["Weight", "Temperature", "Platelets", "Bilirubin", "Lactate", "Creatinine", "Heart_rate", "Respiratory_rate"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def bedside(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events on the slowed clock with concept slot ``k`` and round ``r``."""
    slowed = (
        f"timestampadd(MICROSECOND, timestampdiff(MICROSECOND, timestamp_ntz'{_START}', ts) div 10, "
        f"timestamp_ntz'{_START}')"
    )
    return table(spark, sf_dir, "events").selectExpr(
        "event_id", "user_id", "event_type", "value", f"{slowed} AS dt", "event_id % 20 AS k",
        "CAST((event_id - event_id % 20) / 20 AS BIGINT) AS r",
    )


def clinical(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The eight clinical tables as projections of ``events``."""
    ev = bedside(spark, sf_dir)
    users = table(spark, sf_dir, "events").select("user_id").distinct()
    start = f"timestampadd(HOUR, CAST(user_id % 48 AS INT), timestamp_ntz'{_START}')"
    visits = users.selectExpr(
        "user_id AS visit_occurrence_id", f"{_PERSON} AS person_id", f"{start} AS visit_start_datetime",
        f"timestampadd(HOUR, 40, {start}) AS visit_end_datetime",
    )
    persons = users.selectExpr(f"{_PERSON} AS person_id").distinct()
    return {
        "measurement": ev.selectExpr(*_MEASUREMENT).unionByName(
            ev.where("k = 2 AND r % 4 < 3").selectExpr(*_COMPANION)
        ),
        "observation": ev.where("k = 1 AND r % 3 > 0").selectExpr(*_OBSERVATION),
        "visit_occurrence": visits,
        "person": persons.selectExpr(
            "person_id", "CAST(1930 + person_id % 60 AS INT) AS year_of_birth",
            "CASE person_id % 3 WHEN 0 THEN 'Man' WHEN 1 THEN 'Vrouw' ELSE 'Onbekend' END AS gender_source_value",
        ),
        "concept": spark.sql(CONCEPTS_SQL),
        "condition_occurrence": ev.where("event_type = 'signup'").selectExpr(*_CONDITION),
        "drug_exposure": ev.where("event_type = 'purchase'").selectExpr(
            f"{_PERSON} AS person_id", "user_id AS visit_occurrence_id", f"{_DRUG} AS drug_concept_id",
            "dt AS drug_exposure_start_datetime",
            "timestampadd(SECOND, CAST(floor(value * 60) AS BIGINT), dt) AS drug_exposure_end_datetime",
            f"{_SIG.format(text='STRING')} AS sig",
        ),
        "death": persons.where("person_id % 4 = 0").selectExpr(
            "person_id", f"timestampadd(HOUR, CAST(person_id % 90 AS INT), timestamp_ntz'{_START}') AS death_datetime"
        ),
    }


_SQL_START = f"TIMESTAMP '{_START}'"
_VISIT_START = f"{_SQL_START} + to_hours(CAST(user_id % 48 AS INTEGER))"
CTE = {
    "ev": f"""SELECT event_id, user_id, event_type, value,
 {_SQL_START} + to_microseconds(date_sub('microsecond', {_SQL_START}, ts) // 10) AS dt,
 event_id % 20 AS k, CAST((event_id - event_id % 20) / 20 AS BIGINT) AS r FROM events""",
    "measurement": f"SELECT {', '.join(_MEASUREMENT)} FROM ev UNION ALL SELECT {', '.join(_COMPANION)} FROM ev WHERE k = 2 AND r % 4 < 3",
    "observation": f"SELECT {', '.join(_OBSERVATION)} FROM ev WHERE k = 1 AND r % 3 > 0",
    "visit_occurrence": f"""SELECT DISTINCT user_id AS visit_occurrence_id, {_PERSON} AS person_id,
 {_VISIT_START} AS visit_start_datetime, {_VISIT_START} + INTERVAL 40 HOUR AS visit_end_datetime FROM events""",
    "person": f"""SELECT person_id, CAST(1930 + person_id % 60 AS INTEGER) AS year_of_birth,
 CASE person_id % 3 WHEN 0 THEN 'Man' WHEN 1 THEN 'Vrouw' ELSE 'Onbekend' END AS gender_source_value
 FROM (SELECT DISTINCT {_PERSON} AS person_id FROM events)""",
    "concept": CONCEPTS_SQL,
    "dictionary": DICTIONARY_SQL,
    "condition_occurrence": f"SELECT {', '.join(_CONDITION)} FROM ev WHERE event_type = 'signup'",
    "drug_exposure": f"""SELECT {_PERSON} AS person_id, user_id AS visit_occurrence_id, {_DRUG} AS drug_concept_id,
 dt AS drug_exposure_start_datetime, dt + to_seconds(CAST(floor(value * 60) AS BIGINT)) AS drug_exposure_end_datetime,
 {_SIG.format(text='VARCHAR')} AS sig FROM ev WHERE event_type = 'purchase'""",
    "death": f"""SELECT person_id, {_SQL_START} + to_hours(CAST(person_id % 90 AS INTEGER)) AS death_datetime
 FROM (SELECT DISTINCT {_PERSON} AS person_id FROM events) WHERE person_id % 4 = 0""",
}
CLINICAL = ("ev", "measurement", "observation", "visit_occurrence", "person", "concept",
            "condition_occurrence", "drug_exposure", "death", "dictionary")


def _averages(source: str) -> str:
    return ", ".join(f"avg({source}) FILTER (WHERE feature_name = '{f}') AS {f}" for f in FEATURES)


CTE |= {
    "long": """SELECT user_id AS visit_occurrence_id, ts AS measurement_datetime, event_type AS feature_name,
 value AS value_as_number FROM events""",
    "binned": f"""SELECT visit_occurrence_id, time_bucket(INTERVAL '12 hours', measurement_datetime) AS measurement_datetime,
 {_averages('value_as_number')} FROM long GROUP BY 1, 2""",
    "grid": """SELECT visit_occurrence_id, unnest(generate_series(min(measurement_datetime), max(measurement_datetime),
 INTERVAL '12 hours')) AS measurement_datetime FROM binned GROUP BY 1""",
    "win": f"""SELECT visit_occurrence_id, measurement_datetime, {', '.join(FEATURES)}
 FROM grid LEFT JOIN binned USING (visit_occurrence_id, measurement_datetime)""",
    # decision steps: a user's day is a visit, state and action come straight from the event
    "steps": """SELECT user_id * 32 + day(ts) AS visit_occurrence_id,
 row_number() OVER (PARTITION BY user_id, day(ts) ORDER BY ts, event_id) AS seq_id,
 CAST(floor(hour(ts) / 3.0) * 2 + CASE WHEN value > 35 THEN 1 ELSE 0 END AS INTEGER) AS state,
 CAST(least(floor(value / 12), 8) AS INTEGER) AS action,
 CASE WHEN user_id % 4 = 0 THEN 1 ELSE 0 END AS died_in_hospital FROM events""",
    "rewarded": """SELECT *, CASE WHEN seq_id = max(seq_id) OVER (PARTITION BY visit_occurrence_id)
 THEN CASE WHEN died_in_hospital = 0 THEN 100 ELSE -100 END ELSE 0 END AS reward FROM steps""",
    "transitions": """SELECT visit_occurrence_id, seq_id, state, action, reward,
 coalesce(lead(state) OVER w, -1) AS next_state, CASE WHEN lead(state) OVER w IS NULL THEN 1 ELSE 0 END AS done
 FROM rewarded WINDOW w AS (PARTITION BY visit_occurrence_id ORDER BY seq_id)""",
    "mdp": """SELECT state, action, next_state, count(*) AS count,
 sum(count(*)) OVER (PARTITION BY state, action) AS total_count,
 count(*) * 1.0::DOUBLE / sum(count(*)) OVER (PARTITION BY state, action) AS probability,
 sum(sum(reward)) OVER (PARTITION BY state, action) * 1.0::DOUBLE / sum(count(*)) OVER (PARTITION BY state, action) AS expected_reward
 FROM transitions GROUP BY state, action, next_state""",
    "policy": """SELECT state, action, count(*) AS count, sum(count(*)) OVER (PARTITION BY state) AS total_count,
 count(*) * 1.0::DOUBLE / sum(count(*)) OVER (PARTITION BY state) AS probability FROM transitions GROUP BY state, action""",
}
WINDOWS = ("long", "binned", "grid", "win")
DECISIONS = ("steps", "rewarded", "transitions", "mdp", "policy")


def with_ctes(names, body: str, **extra: str) -> str:
    """A query over the named views, then any extra named steps, which may name themselves to recur."""
    recurs = any(re.search(rf"\b(FROM|JOIN) {n}\b", q) for n, q in extra.items())
    parts = [f"{n} AS ({CTE[n]})" for n in names] + [f"{n} AS ({q})" for n, q in extra.items()]
    return f"WITH {'RECURSIVE ' * recurs}{', '.join(parts)} {body}"


def long_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        F.col("user_id").alias("visit_occurrence_id"), F.col("ts").alias("measurement_datetime"),
        F.col("event_type").alias("feature_name"), F.col("value").alias("value_as_number"),
    )


def decision_steps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unnumbered decision steps, one visit per user and day; ``ts`` and ``event_id`` order them."""
    return table(spark, sf_dir, "events").selectExpr(
        "user_id * 32 + day(ts) AS visit_occurrence_id", "ts", "event_id",
        "CAST(floor(hour(ts) / 3.0D) * 2 + CASE WHEN value > 35 THEN 1 ELSE 0 END AS INT) AS state",
        "CAST(least(floor(value / 12), 8) AS INT) AS action",
        "CASE WHEN user_id % 4 = 0 THEN 1 ELSE 0 END AS died_in_hospital",
    )


def exposures(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Line items as drug exposures, orders as visits, parts as concepts."""
    drugs = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("visit_occurrence_id"), F.col("l_partkey").alias("drug_concept_id"),
        F.col("l_shipdate").alias("drug_exposure_start_datetime"), F.col("l_quantity").alias("quantity"),
    )
    visits = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("visit_occurrence_id"), F.col("o_custkey").alias("person_id"),
        F.col("o_orderdate").alias("visit_start_datetime"),
    )
    concepts = table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("concept_id"), F.col("p_name").alias("concept_name"),
        F.col("p_brand").alias("concept_code"),
    )
    return drugs, visits, concepts
