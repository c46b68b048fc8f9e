"""Queries for sources, cohort, extracts, scores (A, B, C)."""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from icuriver.functions import concepts as C
from icuriver.operators import cohort, extract, nearest, scores
from icuriver.plans.registry import query, round_sql, rounded
from icuriver.plans.views import (
    CLINICAL, CLINICAL_FEATURES, DICTIONARY_SQL, clinical, exposures, table, with_ctes,
)
from icuriver.session import cut_lineage, shared_folder
from icuriver.sources import sinks, tables

AS_OF = "2024-01-04 00:00:00"
V = "visit_occurrence_id"


def _ids(values) -> str:
    return ", ".join(str(v) for v in values)


# --- A ----------------------------------------------------------------------------------


@query(
    "a1_table_scan",
    "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM orders",
)
def a1(spark, sf):
    return tables.read_table(spark, f"{sf}/orders.parquet", ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice"])


_COUNTED = {
    "measurement": "visit_occurrence_id", "observation": "visit_occurrence_id", "visit_occurrence": "person_id",
    "person": "person_id", "concept": "concept_id", "condition_occurrence": "visit_occurrence_id",
    "drug_exposure": "visit_occurrence_id", "death": "person_id",
}


@query(
    "a1_all_clinical_tables",
    with_ctes(CLINICAL, " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, count(*) AS n_rows, count(DISTINCT {k}) AS n_keys FROM {t}" for t, k in _COUNTED.items())),
)
def a1_all(spark, sf):
    """The eight tables written to one folder and scanned from there."""
    folder = shared_folder(spark)
    for name, df in clinical(spark, sf).items():
        if name in tables.CLINICAL_TABLES:
            sinks.write_parquet(df, f"{folder}/{name}.parquet")
    read = tables.read_clinical(spark, folder)
    counts = [
        read[t].agg(F.lit(t).alias("table_name"), F.count("*").alias("n_rows"), F.countDistinct(k).alias("n_keys"))
        for t, k in _COUNTED.items()
    ]
    return functools.reduce(DataFrame.union, counts)


@query("a2_all_admissions", with_ctes(CLINICAL, "SELECT * FROM visit_occurrence"))
def a2(spark, sf):
    return tables.all_admissions(clinical(spark, sf)["visit_occurrence"])


@query(
    "a3_feature_dictionary",
    """SELECT CASE WHEN p_brand = 'Brand#1' THEN '_' ELSE p_brand END AS feature_name, p_partkey AS concept_id
    FROM part WHERE p_brand <> 'Brand#1' AND p_size > 5""",
)
def a3(spark, sf):
    parts = table(spark, sf, "part").select(
        F.col("p_type").alias("category"),
        F.when(F.col("p_brand") == "Brand#1", "_").otherwise(F.col("p_brand")).alias("feature_name"),
        F.col("p_name").alias("concept_name"),
        F.when(F.col("p_size") > 5, F.col("p_partkey")).alias("concept_id"),
    )
    return tables.feature_concepts(parts)


@query(
    "a3_weight_temperature_ids",
    """SELECT p_type AS feature_name, p_partkey AS concept_id FROM part WHERE p_type IN ('ECONOMY', 'SMALL')""",
)
def a3_named(spark, sf):
    parts = table(spark, sf, "part").select(
        F.col("p_type").alias("feature_name"), F.col("p_partkey").alias("concept_id")
    )
    return tables.feature_concepts(parts, ["ECONOMY", "SMALL"])


@query(
    "a4_restrict_to_ids",
    """SELECT l_orderkey, l_partkey, l_linenumber, l_quantity FROM lineitem WHERE l_orderkey IN
    (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'P')""",
)
def a4(spark, sf):
    ids = table(spark, sf, "orders").where("o_orderstatus = 'P'").select(F.col("o_orderkey").alias("l_orderkey"))
    rows = table(spark, sf, "lineitem").select("l_orderkey", "l_partkey", "l_linenumber", "l_quantity")
    return tables.restrict_to(rows, ids, "l_orderkey")


@query(
    "a7_coerce",
    """SELECT event_id, TRY_CAST(event_type AS DOUBLE) AS bad,
    TRY_CAST(regexp_extract(props, '[0-9]+') AS DOUBLE) AS good, ts AS at FROM events""",
)
def a7(spark, sf):
    text = table(spark, sf, "events").select(
        "event_id", F.col("event_type").alias("bad"), F.regexp_extract("props", "[0-9]+", 0).alias("good"),
        F.col("ts").cast("string").alias("at"),
    )
    return tables.coerce(text, numbers=["bad", "good"], times=["at"])


# --- B ----------------------------------------------------------------------------------


@query(
    "b1_validated_records",
    with_ctes(CLINICAL, """SELECT measurement_concept_id, count(*) FILTER (WHERE provider_id IS NOT NULL) AS staff,
    count(*) FILTER (WHERE provider_id IS NULL) AS device,
    count(*) FILTER (WHERE provider_id BETWEEN 27 AND 61) AS listed FROM measurement GROUP BY 1"""),
)
def b1(spark, sf):
    return clinical(spark, sf)["measurement"].groupBy("measurement_concept_id").agg(
        *[F.count_if(cohort.validated(mode=m)).alias(m) for m in ("staff", "device", "listed")]
    )


def _diagnosis(t):
    return cohort.latest_diagnosis(t["person"], t["visit_occurrence"], t["condition_occurrence"], t["concept"], C.SEPSIS)


# the last onset of the one diagnosis, with what the visit and its person say
_DIAGNOSIS = f"""SELECT last.visit_occurrence_id, stay.person_id, who.year_of_birth, who.gender_source_value, named.*,
 last.day AS condition_start_date, 1 AS sepsis_at_admission
 FROM (SELECT visit_occurrence_id, max(condition_start_date) AS day FROM condition_occurrence WHERE condition_concept_id = {C.SEPSIS} GROUP BY ALL) last
 JOIN visit_occurrence stay ON stay.visit_occurrence_id = last.visit_occurrence_id
 JOIN person who ON who.person_id = stay.person_id,
 (SELECT concept_id, concept_name, concept_code FROM concept WHERE concept_id = {C.SEPSIS}) named"""


@query(
    "b2_latest_diagnosis",
    with_ctes(CLINICAL, "FROM dx", dx=_DIAGNOSIS),
)
def b2(spark, sf):
    return _diagnosis(clinical(spark, sf))


def _exposure(t, kind):
    if kind == "cultures":
        return cohort.exposure_flag(
            t["measurement"].where(cohort.validated()), t["visit_occurrence"], t["concept"], C.CULTURES,
            concept_column="measurement_concept_id", time_column="measurement_datetime",
            flag="sepsis_cultures_bool", names="sepsis_cultures_drawn", as_of=AS_OF, older_than="6 HOUR",
        )
    ids = C.THERAPEUTIC_ANTIBIOTICS if kind == "sepsis_antibiotics" else C.PROPHYLACTIC_ANTIBIOTICS
    return cohort.exposure_flag(
        t["drug_exposure"], t["visit_occurrence"], t["concept"], ids,
        concept_column="drug_concept_id", time_column="drug_exposure_start_datetime",
        flag=f"{kind}_bool", names=f"{kind}_given", as_of=AS_OF, older_than="1 DAY",
    )


def _exposure_sql(rows, concept, time, ids, flag, names, older):
    return f"""SELECT visit_occurrence_id, 1 AS {flag}, array_to_string(list_sort(list_distinct(list(label))), '; ') AS {names}
 FROM (SELECT concept_id AS {concept}, concept_name AS label FROM concept WHERE list_contains([{_ids(ids)}], concept_id)) listed
 JOIN {rows} given USING ({concept})
 WHERE {time} + INTERVAL {older} < TIMESTAMP '{AS_OF}' AND visit_occurrence_id IN (SELECT visit_occurrence_id FROM visit_occurrence)
 GROUP BY visit_occurrence_id"""


_DRUG_ARGS = ("drug_exposure", "drug_concept_id", "drug_exposure_start_datetime")
_ANTIBIOTICS = _exposure_sql(*_DRUG_ARGS, C.THERAPEUTIC_ANTIBIOTICS, "sepsis_antibiotics_bool", "sepsis_antibiotics_given", "1 DAY")
_OTHER = _exposure_sql(*_DRUG_ARGS, C.PROPHYLACTIC_ANTIBIOTICS, "other_antibiotics_bool", "other_antibiotics_given", "1 DAY")
_CULTURES = _exposure_sql(
    "(SELECT * FROM measurement WHERE provider_id IS NOT NULL)", "measurement_concept_id", "measurement_datetime",
    C.CULTURES, "sepsis_cultures_bool", "sepsis_cultures_drawn", "6 HOUR",
)


@query("b3_therapeutic_antibiotics", with_ctes(CLINICAL, _ANTIBIOTICS))
def b3(spark, sf):
    return _exposure(clinical(spark, sf), "sepsis_antibiotics")


# concepts of the order-line exposure list
_LISTED_PARTS = tuple(range(1, 176, 5))


@query(
    "b3_order_exposures",
    f"""SELECT o_orderkey AS visit_occurrence_id, 1 AS exposed,
    string_agg(DISTINCT p_name, '; ' ORDER BY p_name) AS names
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey
    WHERE l_partkey IN ({_ids(_LISTED_PARTS)}) AND l_shipdate < TIMESTAMP '2000-01-01' - INTERVAL 1 DAY GROUP BY 1""",
)
def b3_orders(spark, sf):
    drugs, visits, concepts = exposures(spark, sf)
    return cohort.exposure_flag(
        drugs, visits, concepts, _LISTED_PARTS, concept_column="drug_concept_id",
        time_column="drug_exposure_start_datetime", flag="exposed", names="names",
        as_of="2000-01-01 00:00:00", older_than="1 DAY",
    )


@query("b4_prophylactic_antibiotics", with_ctes(CLINICAL, _OTHER))
def b4(spark, sf):
    return _exposure(clinical(spark, sf), "other_antibiotics")


@query("b5_cultures_drawn", with_ctes(CLINICAL, _CULTURES))
def b5(spark, sf):
    return _exposure(clinical(spark, sf), "cultures")


def combined(t):
    return cohort.combined_diagnosis(
        t["visit_occurrence"], _diagnosis(t), _exposure(t, "sepsis_antibiotics"),
        _exposure(t, "other_antibiotics"), _exposure(t, "cultures"),
    )


_COMBINED = """SELECT stays.*, dx.person_id AS dx_person_id, dx.* EXCLUDE (visit_occurrence_id, person_id, condition_start_date),
 ab.* EXCLUDE (visit_occurrence_id), oa.* EXCLUDE (visit_occurrence_id), cu.* EXCLUDE (visit_occurrence_id)
 FROM visit_occurrence stays
 LEFT JOIN dx ON dx.visit_occurrence_id = stays.visit_occurrence_id LEFT JOIN ab ON ab.visit_occurrence_id = stays.visit_occurrence_id
 LEFT JOIN oa ON oa.visit_occurrence_id = stays.visit_occurrence_id LEFT JOIN cu ON cu.visit_occurrence_id = stays.visit_occurrence_id"""
_COMBINED_STEPS = {"dx": _DIAGNOSIS, "ab": _ANTIBIOTICS, "oa": _OTHER, "cu": _CULTURES}


@query("b6_combined_diagnosis", with_ctes(CLINICAL, _COMBINED, **_COMBINED_STEPS))
def b6(spark, sf):
    return combined(clinical(spark, sf))


_DEMOGRAPHICS = """SELECT stay.visit_occurrence_id, date_diff('year', make_date(born.year_of_birth, 1, 1), CAST(stay.visit_start_datetime AS DATE)) AS age_at_visit,
 born.gender_source_value FROM person born RIGHT JOIN visit_occurrence stay ON born.person_id = stay.person_id GROUP BY ALL"""


@query("b7_demographics", with_ctes(CLINICAL, _DEMOGRAPHICS))
def b7(spark, sf):
    t = clinical(spark, sf)
    return cohort.demographics(t["visit_occurrence"], t["person"])


def dictionary(spark):
    return spark.sql(DICTIONARY_SQL)


def measured(spark, sf, t):
    d = dictionary(spark)
    return cohort.measurement_union(
        t["measurement"], t["concept"],
        tables.feature_concepts(d, ["Temperature", "Weight"]).select("concept_id"),
        tables.feature_concepts(d).select("concept_id"),
    )


_MEASURED = """SELECT kept.* EXCLUDE (device), (SELECT any_value(named.concept_name) FROM concept named WHERE named.concept_id = kept.measurement_concept_id) AS concept_name
 FROM (SELECT provider_id IS NULL AS device, measurement_concept_id, measurement_datetime, value_as_number, visit_occurrence_id FROM measurement
  WHERE CASE WHEN provider_id IS NULL THEN measurement_concept_id IN (SELECT concept_id FROM dictionary WHERE feature_name IN ('Temperature', 'Weight'))
   ELSE provider_id BETWEEN 27 AND 61 AND measurement_concept_id IN (SELECT concept_id FROM dictionary SEMI JOIN concept USING (concept_id) WHERE feature_name <> '_') END
  GROUP BY ALL) kept"""


@query(
    "b8_measurement_union",
    with_ctes(CLINICAL, f"SELECT measurement_concept_id, concept_name, measurement_datetime, {round_sql('value_as_number')}, visit_occurrence_id FROM mu", mu=_MEASURED),
)
def b8(spark, sf):
    return rounded(measured(spark, sf, clinical(spark, sf)), "value_as_number")


def _fio2_sql(device: str, first_day: bool) -> str:
    rungs = ", ".join(f"({i}, {least}, {share})" for ids, levels in C.FIO2_STEPS for i in ids for least, share in levels)
    window = "WHERE elapsed BETWEEN 0 AND 24" if first_day else ""
    return f"""SELECT flow.visit_occurrence_id, flow.measurement_datetime, mask.o2_value, CAST(mask.kind AS BIGINT) AS o2_device,
 flow.ventilatory_support, CAST(CASE WHEN flow.ventilatory_support THEN flow.amount ELSE coalesce(
  (SELECT arg_max(rung.share, rung.least) FROM (VALUES {rungs}) rung(kind, least, share) WHERE rung.kind = mask.kind AND rung.least <= flow.amount), 0.21) END AS DOUBLE) AS fio2
 FROM (SELECT visit_occurrence_id, measurement_datetime, value_as_number AS amount, measurement_concept_id IN ({_ids(C.VENTILATOR_OXYGEN)}) AS ventilatory_support,
  date_sub('hour', (SELECT any_value(visit_start_datetime) FROM visit_occurrence s WHERE s.visit_occurrence_id = m.visit_occurrence_id), measurement_datetime) AS elapsed
  FROM measurement m WHERE provider_id IS NOT NULL AND value_as_number > 0 AND measurement_concept_id IN ({_ids(C.OXYGEN)})) flow
 LEFT JOIN (SELECT visit_occurrence_id, observation_datetime AS measurement_datetime, value_as_number AS o2_value, {device} AS kind FROM observation
  WHERE observation_concept_id = {C.OXYGEN_DEVICE} AND provider_id IS NOT NULL) mask USING (visit_occurrence_id, measurement_datetime)
 {window}"""


_FIO2_OUT = f"SELECT visit_occurrence_id, measurement_datetime, {round_sql('o2_value', 'fio2')}, o2_device, ventilatory_support FROM fio2"


@query("b9_fio2_estimate", with_ctes(CLINICAL, _FIO2_OUT, fio2=_fio2_sql("observation_concept_id", True)))
def b9(spark, sf):
    t = clinical(spark, sf)
    return rounded(extract.fio2_estimate(t["measurement"], t["observation"], t["visit_occurrence"]), "o2_value", "fio2")


@query("b9_fio2_by_device", with_ctes(CLINICAL, _FIO2_OUT, fio2=_fio2_sql("value_as_number", False)))
def b9_device(spark, sf):
    t = clinical(spark, sf)
    out = extract.fio2_estimate(
        t["measurement"], t["observation"], t["visit_occurrence"], first_day=False, device_column="value_as_number"
    )
    return rounded(out, "o2_value", "fio2")


# one row for each visit and instant of a blood gas: the nearest oxygen share, ties as the operator breaks them
_OXYGENATION = f"""SELECT DISTINCT ON (gas.visit_occurrence_id, gas.taken) gas.visit_occurrence_id, gas.pao2, specimen.kind AS specimen_source, gas.manual_entry,
 date_sub('hour', stay.visit_start_datetime, gas.taken) AS time, air.fio2, air.ventilatory_support,
 date_sub('minute', gas.taken, air.measurement_datetime) AS fio2_time_difference, air.measurement_datetime
 FROM (SELECT visit_occurrence_id, measurement_datetime AS taken, TRUE AS manual_entry,
  value_as_number * CASE WHEN unit_concept_id = 152 THEN {C.KPA_TO_MMHG}::DOUBLE ELSE 1 END AS pao2
  FROM measurement WHERE measurement_concept_id = {C.PAO2} AND provider_id IS NOT NULL) gas
 LEFT JOIN (SELECT visit_occurrence_id, measurement_datetime AS taken, value_as_number AS kind FROM measurement
  WHERE measurement_concept_id = {C.SPECIMEN} AND provider_id IS NOT NULL) specimen USING (visit_occurrence_id, taken)
 LEFT JOIN visit_occurrence stay USING (visit_occurrence_id)
 LEFT JOIN fio2 air USING (visit_occurrence_id)
 ORDER BY gas.visit_occurrence_id, gas.taken, abs(date_sub('minute', gas.taken, air.measurement_datetime)),
  abs(date_sub('microsecond', gas.taken, air.measurement_datetime)), air.measurement_datetime, air.fio2, air.ventilatory_support, gas.pao2, specimen.kind"""
_OXY_STEPS = {"fio2": _fio2_sql("observation_concept_id", True), "oxy": _OXYGENATION}
_OXY_ALL = _OXY_STEPS | {"fio2": _fio2_sql("observation_concept_id", False)}
_OXY_COLUMNS = f"""SELECT visit_occurrence_id, {round_sql('pao2', 'specimen_source', 'fio2')}, manual_entry, time,
 ventilatory_support, fio2_time_difference"""


def oxygenation(t, first_day=True, time_from=None):
    fio2 = extract.fio2_estimate(t["measurement"], t["observation"], t["visit_occurrence"], first_day=first_day)
    return nearest.oxygenation(t["measurement"], t["visit_occurrence"], fio2, time_from=time_from)


@query("b10_nearest_fio2", with_ctes(CLINICAL, _OXY_COLUMNS + " FROM oxy", **_OXY_STEPS))
def b10(spark, sf):
    return rounded(oxygenation(clinical(spark, sf)), "pao2", "specimen_source", "fio2")


@query(
    "b10_nearest_click_for_error",
    """SELECT * EXCLUDE (rn) FROM (SELECT e.user_id, e.event_id, e.ts AS error_time, c.ts AS click_time, c.value AS click_value,
    row_number() OVER (PARTITION BY e.event_id ORDER BY abs(date_sub('microsecond', e.ts, c.ts)), c.ts, c.value) AS rn
    FROM events e LEFT JOIN events c ON e.user_id = c.user_id AND c.event_type = 'click' WHERE e.event_type = 'error') WHERE rn = 1""",
)
def b10_events(spark, sf):
    ev = table(spark, sf, "events")
    errors = ev.where("event_type = 'error'").select("user_id", "event_id", F.col("ts").alias("error_time"))
    clicks = ev.where("event_type = 'click'").select("user_id", F.col("ts").alias("click_time"), F.col("value").alias("click_value"))
    return nearest.nearest_in_time(errors, clicks, ["user_id"], "error_time", "click_time", ["click_value"])


@query(
    "b11_ventilation_series",
    with_ctes(CLINICAL, _OXY_COLUMNS + ", measurement_datetime FROM oxy", **_OXY_ALL),
)
def b11(spark, sf):
    out = oxygenation(clinical(spark, sf), first_day=False, time_from="right")
    return rounded(out, "pao2", "specimen_source", "fio2")


def _extract_sql(ids, unit=None, low=None, high=None, staff=True, validated=False):
    who = "provider_id IS NOT NULL AS validated" if validated else "provider_id AS registeredby"
    span = f"date_sub('{unit}', visit_start_datetime, measurement_datetime)" if unit else None
    limits = "" if low is None else f" AND {span} >= {low}"
    limits += "" if high is None else f" AND {span} <= {high}"
    return f"""SELECT visit_occurrence_id, measurement_concept_id AS itemid, measurement_source_value AS item,
 value_as_number AS value, {who}{f', {span} AS time' if unit else ''}
 FROM measurement LEFT JOIN visit_occurrence USING (visit_occurrence_id)
 WHERE measurement_concept_id IN ({_ids(ids)}){' AND provider_id IS NOT NULL' if staff else ''}{limits}"""


_EXTRACTS = {
    "platelets": _extract_sql(C.PLATELETS, "hour", -0.5, 24),
    "bilirubin": _extract_sql(C.BILIRUBIN, "hour", -0.5, 24),
    "lactate": _extract_sql(C.LACTATE),
    "pressure": _extract_sql(C.MEAN_BLOOD_PRESSURE, "minute", None, 1440, staff=False, validated=True),
    "urine": _extract_sql(C.URINE, "minute", 0, 1440),
}


def _extract_out(name, who="registeredby", time=True):
    columns = f"visit_occurrence_id, itemid, item, {round_sql('value')}, {who}{', time' if time else ''}"
    return with_ctes(CLINICAL, f"SELECT {columns} FROM {name}", **{name: _EXTRACTS[name]})


def _register_extract(name, fn, key, **kw):
    @query(name, _extract_out(key, **kw))
    def run(spark, sf):
        t = clinical(spark, sf)
        return rounded(fn(t["measurement"], t["visit_occurrence"]), "value")


_register_extract("b12_platelets", extract.platelets, "platelets")
_register_extract("b13_bilirubin", extract.bilirubin, "bilirubin")
_register_extract("b14_lactate", extract.lactate, "lactate", time=False)
_register_extract("b17_blood_pressure", extract.blood_pressure, "pressure", who="validated")
_register_extract("b19_urine_output", extract.urine_output, "urine")


def _doses_sql(absolute: bool, first_day: bool, weight_agg: str | None = None) -> str:
    kept = "person_id, visit_occurrence_id, " if absolute else "visit_occurrence_id, "
    times = "begin AS start_datetime, finish AS stop_datetime" if absolute else "begin_minute AS start_time, end_minute AS stop_time"
    scale = "GROUP BY visit_occurrence_id" if weight_agg else ""
    value = f"{weight_agg}(value_as_number)" if weight_agg else "value_as_number"
    early = "AND begin_minute <= 1440 AND end_minute >= 0" if first_day else ""

    def figure(pattern: str) -> str:
        return f"TRY_CAST(nullif(regexp_extract(sig, '{pattern}', 1), '') AS DOUBLE)"

    return f"""SELECT {kept}itemid, item, date_sub('minute', begin, finish) AS duration, dose, rate, 'mg/uur' AS rateunit, {times},
 patientweight, rate * 1000 / patientweight / 60 AS gamma
 FROM (SELECT drug.person_id, drug.visit_occurrence_id, drug.drug_concept_id AS itemid, label.concept_name AS item,
   drug.drug_exposure_start_datetime AS begin, drug.drug_exposure_end_datetime AS finish, {figure(C.DOSE_PATTERN)} AS dose, {figure(C.RATE_PATTERN)} AS rate,
   date_sub('minute', stay.visit_start_datetime, begin) AS begin_minute, date_sub('minute', stay.visit_start_datetime, finish) AS end_minute
  FROM concept label JOIN drug_exposure drug ON label.concept_id = drug.drug_concept_id AND list_contains([{_ids(C.VASOACTIVE)}], label.concept_id)
  LEFT JOIN visit_occurrence stay ON stay.visit_occurrence_id = drug.visit_occurrence_id) pump
 LEFT JOIN (SELECT visit_occurrence_id, {value} AS patientweight FROM measurement
  WHERE measurement_concept_id IN ({_ids(C.BODY_WEIGHT)}) AND provider_id IS NULL {scale}) scales USING (visit_occurrence_id)
 WHERE rate > 0.1 {early}"""


DOSES_DAY = _doses_sql(False, True)
DOSES_ALL = _doses_sql(True, False)


def doses(t, **kw):
    return extract.infusion_doses(t["drug_exposure"], t["visit_occurrence"], t["concept"], t["measurement"], **kw)


_DOSE_ROUND = round_sql("dose", "rate", "patientweight", "gamma")
_DOSE_HEAD = f"visit_occurrence_id, itemid, item, duration, {_DOSE_ROUND}, rateunit"


@query("b15_infusion_doses", with_ctes(CLINICAL, f"SELECT {_DOSE_HEAD}, start_time, stop_time FROM d", d=DOSES_DAY))
def b15(spark, sf):
    return rounded(doses(clinical(spark, sf)), "dose", "rate", "patientweight", "gamma")


@query(
    "b15_infusion_doses_one_weight",
    with_ctes(CLINICAL, f"SELECT {_DOSE_HEAD}, start_time, stop_time FROM d", d=_doses_sql(False, True, "min")),
)
def b15_min(spark, sf):
    return rounded(doses(clinical(spark, sf), weight_agg="min"), "dose", "rate", "patientweight", "gamma")


@query(
    "b16_infusion_times",
    with_ctes(CLINICAL, f"SELECT person_id, {_DOSE_HEAD}, start_datetime, stop_datetime FROM d", d=DOSES_ALL),
)
def b16(spark, sf):
    return rounded(doses(clinical(spark, sf), first_day=False, absolute=True), "dose", "rate", "patientweight", "gamma")


def _case(concept, answers):
    whens = " ".join(f"WHEN {a} THEN {p}" for a, p in answers.items())
    return f"CASE WHEN measurement_concept_id = {concept} THEN CASE value_as_concept_id {whens} END END"


_COMA_ROWS = f"""SELECT visit_occurrence_id, {_case(C.EYES, C.EYES_POINTS)} AS eyes_score,
 {_case(C.MOTOR, C.MOTOR_POINTS)} AS motor_score, {_case(C.VERBAL, C.VERBAL_POINTS)} AS verbal_score, provider_id,
 date_sub('minute', visit_start_datetime, measurement_datetime) AS time
 FROM measurement LEFT JOIN visit_occurrence USING (visit_occurrence_id)
 WHERE provider_id IS NOT NULL AND measurement_concept_id IN ({C.EYES}, {C.MOTOR}, {C.VERBAL})
 AND date_sub('minute', visit_start_datetime, measurement_datetime) <= 1440"""
_COMA_SCORED = """SELECT *, CAST(list_sum([eyes_score, motor_score, greatest(verbal_score, 1)]) AS INTEGER) AS gcs_score FROM coma_rows"""
_COMA = """SELECT visit_occurrence_id, top.* FROM (SELECT visit_occurrence_id, arg_max({'eyes_score': eyes_score, 'motor_score': motor_score, 'verbal_score': verbal_score,
 'provider_id': provider_id, 'time': time, 'gcs_score': gcs_score}, [time, gcs_score, provider_id, coalesce(eyes_score, -1), coalesce(motor_score, -1), coalesce(verbal_score, -1)]) AS top
 FROM coma_scored GROUP BY visit_occurrence_id)"""
_COMA_STEPS = {"coma_rows": _COMA_ROWS, "coma_scored": _COMA_SCORED, "coma": _COMA}


@query("b18_coma_score", with_ctes(CLINICAL, "SELECT * FROM coma", **_COMA_STEPS))
def b18(spark, sf):
    t = clinical(spark, sf)
    return extract.coma_score(t["measurement"], t["visit_occurrence"])


_CREA_STEPS = {
    "crea_timed": f"""SELECT lab.*, date_sub('minute', stay.visit_start_datetime, lab.measurement_datetime) AS minutes,
 date_sub('hour', stay.visit_start_datetime, lab.measurement_datetime) AS hours
 FROM measurement lab LEFT JOIN visit_occurrence stay ON stay.visit_occurrence_id = lab.visit_occurrence_id
 WHERE lab.measurement_concept_id IN ({_ids(C.CREATININE)}) AND lab.provider_id IS NOT NULL""",
    "crea_marks": """SELECT visit_occurrence_id, min(value_as_number) FILTER (hours > -8760 AND hours < 24) AS lowest,
 max(value_as_number) FILTER (hours >= 0 AND hours <= 168) AS highest FROM crea_timed GROUP BY visit_occurrence_id""",
    "creatinine": """SELECT t.visit_occurrence_id, t.measurement_concept_id AS itemid, t.measurement_source_value AS item, t.value_as_number AS value,
 t.provider_id AS registeredby, t.minutes AS time, k.lowest AS baseline_creatinine, k.highest AS max_creatinine_7days,
 coalesce(k.lowest > 0 AND k.highest / nullif(k.lowest, 0) > 3, FALSE) OR coalesce(k.highest >= 354 AND k.highest - k.lowest >= 44, FALSE) AS acute_renal_failure
 FROM crea_timed t LEFT JOIN crea_marks k ON k.visit_occurrence_id = t.visit_occurrence_id WHERE t.minutes >= -30 AND t.minutes <= 1440""",
}


@query(
    "b20_creatinine",
    with_ctes(CLINICAL, f"""SELECT visit_occurrence_id, itemid, item, {round_sql('value', 'baseline_creatinine', 'max_creatinine_7days')},
    registeredby, time, acute_renal_failure FROM creatinine""", **_CREA_STEPS),
)
def b20(spark, sf):
    t = clinical(spark, sf)
    return rounded(extract.creatinine(t["measurement"], t["visit_occurrence"]), "value", "baseline_creatinine", "max_creatinine_7days")


_FLUIDS = f"""SELECT given.person_id, measurement_concept_id, fluid.concept_name, given.measurement_datetime, given.value_as_number, given.visit_occurrence_id
 FROM (SELECT concept_id AS measurement_concept_id, concept_name FROM concept WHERE concept_id IN ({_ids(C.FLUID_INTAKE)})) fluid
 JOIN (SELECT * FROM measurement WHERE provider_id IS NULL) given USING (measurement_concept_id) GROUP BY ALL"""


@query(
    "b21_fluid_intake",
    with_ctes(CLINICAL, f"SELECT person_id, measurement_concept_id, concept_name, measurement_datetime, {round_sql('value_as_number')}, visit_occurrence_id FROM fl", fl=_FLUIDS),
)
def b21(spark, sf):
    t = clinical(spark, sf)
    return rounded(cohort.fluid_intake(t["measurement"], t["concept"], C.FLUID_INTAKE), "value_as_number")


_OUTCOME = """SELECT stay.*, gone.death_datetime, CAST(abs(epoch_us(gone.death_datetime) - epoch_us(stay.visit_start_datetime)) // 86400000000 AS BIGINT) AS days_between,
 CAST(coalesce(gone.death_datetime BETWEEN stay.visit_start_datetime AND stay.visit_end_datetime, FALSE) AS INTEGER) AS died_in_hospital
 FROM (SELECT person_id, visit_occurrence_id, visit_start_datetime, visit_end_datetime FROM visit_occurrence GROUP BY ALL) stay
 LEFT JOIN (SELECT DISTINCT person_id, death_datetime FROM death) gone ON gone.person_id = stay.person_id"""


@query("b22_outcome", with_ctes(CLINICAL, _OUTCOME))
def b22(spark, sf):
    t = clinical(spark, sf)
    return cohort.outcome(t["visit_occurrence"], t["death"])


@query(
    "b23_outcome_on_windows",
    with_ctes(CLINICAL, """SELECT m.visit_occurrence_id, m.measurement_concept_id, m.measurement_datetime, coalesce(x.died, 0) AS died_in_hospital
    FROM measurement m LEFT JOIN (SELECT visit_occurrence_id, max(died_in_hospital) AS died FROM oc GROUP BY 1) x USING (visit_occurrence_id)""", oc=_OUTCOME),
)
def b23(spark, sf):
    t = clinical(spark, sf)
    rows = t["measurement"].select(V, "measurement_concept_id", "measurement_datetime")
    return cohort.attach_outcome(rows, cohort.outcome(t["visit_occurrence"], t["death"])).select(
        V, "measurement_concept_id", "measurement_datetime", "died_in_hospital"
    )


@query(
    "b24_gender_flag",
    with_ctes(CLINICAL, """SELECT visit_occurrence_id, CAST(age_at_visit AS DOUBLE) AS age_at_visit, gender_source_value,
    CASE WHEN lower(gender_source_value) LIKE '%vrouw%' THEN 0.0::DOUBLE WHEN lower(gender_source_value) LIKE '%man%' THEN 1.0::DOUBLE END AS "Gender" FROM dm""", dm=_DEMOGRAPHICS),
)
def b24(spark, sf):
    t = clinical(spark, sf)
    return cohort.gender_flag(cohort.demographics(t["visit_occurrence"], t["person"]))


@query(
    "b25_attach_feature",
    with_ctes(CLINICAL, """SELECT m.visit_occurrence_id, m.measurement_concept_id, m.measurement_datetime, d.feature_name
    FROM measurement m LEFT JOIN dictionary d ON m.measurement_concept_id = d.concept_id"""),
)
def b25(spark, sf):
    rows = cohort.attach_feature(clinical(spark, sf)["measurement"], dictionary(spark))
    return rows.select(V, "measurement_concept_id", "measurement_datetime", "feature_name")


# --- C ----------------------------------------------------------------------------------

_RESP = """SELECT visit_occurrence_id, pao2, fio2, ventilatory_support, pao2 / fio2 AS pf_ratio,
 CASE WHEN pao2 / fio2 < 100 AND ventilatory_support THEN 4 WHEN pao2 / fio2 >= 100 AND pao2 / fio2 < 200 AND ventilatory_support THEN 3
 WHEN pao2 / fio2 < 300 THEN 2 WHEN pao2 / fio2 >= 300 AND pao2 / fio2 < 400 THEN 1 ELSE 0 END AS sofa_respiration_score
 FROM (SELECT visit_occurrence_id, pao2, ventilatory_support, CASE WHEN fio2 > 100 THEN NULL WHEN fio2 BETWEEN 20 AND 100 THEN fio2 / 100
 WHEN fio2 > 1 THEN NULL ELSE fio2 END AS fio2 FROM oxy WHERE pao2 >= 50)"""
_SCORE_SQL = {
    "s_coag": "SELECT *, CASE WHEN value < 20 THEN 4 WHEN value < 50 THEN 3 WHEN value < 100 THEN 2 WHEN value < 150 THEN 1 ELSE 0 END AS sofa_coagulation_score FROM platelets",
    "s_liver": "SELECT *, CASE WHEN value >= 204 THEN 4 WHEN value >= 102 THEN 3 WHEN value >= 33 THEN 2 WHEN value >= 20 THEN 1 ELSE 0 END AS sofa_liver_score FROM bilirubin",
    "s_drugs": f"""SELECT *, CASE WHEN itemid = {C.DOPAMINE} AND max_gamma > 15 THEN 4 WHEN itemid IN ({C.EPINEPHRINE}, {C.NOREPINEPHRINE}) AND max_gamma > 0.1 THEN 4
 WHEN itemid = {C.DOPAMINE} AND max_gamma > 5 AND max_gamma < 15 THEN 3 WHEN itemid IN ({C.EPINEPHRINE}, {C.NOREPINEPHRINE}) AND max_gamma <= 0.1 THEN 3
 WHEN itemid = {C.DOPAMINE} AND max_gamma <= 5 THEN 2 WHEN itemid = {C.DOBUTAMINE} THEN 2 ELSE 0 END AS sofa_cardiovascular_score
 FROM (SELECT visit_occurrence_id, itemid, item, CAST(sum(duration) AS BIGINT) AS total_duration, max(gamma) AS max_gamma FROM d GROUP BY ALL)""",
    "s_map": """SELECT visit_occurrence_id, itemid, item, min(value) AS lowest_mean_abp, CASE WHEN min(value) < 70 THEN 1 ELSE 0 END AS sofa_cardiovascular_score
 FROM pressure WHERE value <= 165 AND value > 30 GROUP BY ALL""",
    "s_cns": """SELECT visit_occurrence_id, min(gcs_score) AS min_gcs, CASE WHEN min(gcs_score) < 6 THEN 4 WHEN min(gcs_score) < 10 THEN 3
 WHEN min(gcs_score) < 13 THEN 2 WHEN min(gcs_score) < 15 THEN 1 ELSE 0 END AS sofa_cns_score FROM coma GROUP BY 1""",
    "s_urine": """SELECT visit_occurrence_id, sum(v) AS daily_urine_output, CASE WHEN sum(v) < 200 THEN 4 WHEN sum(v) > 200 AND sum(v) < 500 THEN 3 ELSE 0 END AS sofa_renal_score
 FROM (SELECT visit_occurrence_id, CASE WHEN value > 2500 THEN value / 10 ELSE value END AS v FROM urine) WHERE v <= 4500 GROUP BY 1""",
    "s_crea": """SELECT visit_occurrence_id, max(value) AS max_creatinine, CASE WHEN max(value) > 440 THEN 4 WHEN max(value) >= 300 THEN 3
 WHEN max(value) >= 171 THEN 2 WHEN max(value) >= 110 THEN 1 ELSE 0 END AS sofa_renal_score FROM creatinine WHERE value >= 30 GROUP BY 1""",
    "s_shock": "SELECT visit_occurrence_id, max(value) AS max_lactate, max(value) > 2.0 AS septic_shock FROM lactate WHERE registeredby IS NOT NULL GROUP BY 1",
}
_SCORE_STEPS = (
    _OXY_STEPS | {"s_resp": _RESP} | _EXTRACTS | {"d": DOSES_DAY} | _COMA_STEPS | _CREA_STEPS | _SCORE_SQL
)
_EVIDENCE = {
    "s_cardio": "SELECT visit_occurrence_id, max(sofa_cardiovascular_score) AS sofa_cardiovascular_score FROM (SELECT visit_occurrence_id, sofa_cardiovascular_score FROM s_map UNION ALL SELECT visit_occurrence_id, sofa_cardiovascular_score FROM s_drugs) GROUP BY 1",
    "s_renal": "SELECT visit_occurrence_id, max(sofa_renal_score) AS sofa_renal_score FROM (SELECT visit_occurrence_id, sofa_renal_score FROM s_crea UNION ALL SELECT visit_occurrence_id, sofa_renal_score FROM s_urine) GROUP BY 1",
}


def _scored(body):
    return with_ctes(CLINICAL, body, **_SCORE_STEPS, **_EVIDENCE)


def respiration_scores(t):
    return scores.respiration(oxygenation(t))


@query(
    "c1_respiration_score",
    _scored(f"SELECT visit_occurrence_id, {round_sql('pao2', 'fio2', 'pf_ratio')}, ventilatory_support, sofa_respiration_score FROM s_resp"),
)
def c1(spark, sf):
    out = respiration_scores(clinical(spark, sf)).select(
        V, "pao2", "fio2", "pf_ratio", "ventilatory_support", "sofa_respiration_score"
    )
    return rounded(out, "pao2", "fio2", "pf_ratio")


@query("c2_coagulation_score", _scored(f"SELECT visit_occurrence_id, {round_sql('value')}, time, sofa_coagulation_score FROM s_coag"))
def c2(spark, sf):
    t = clinical(spark, sf)
    out = scores.coagulation(extract.platelets(t["measurement"], t["visit_occurrence"]))
    return rounded(out.select(V, "value", "time", "sofa_coagulation_score"), "value")


@query("c3_liver_score", _scored(f"SELECT visit_occurrence_id, {round_sql('value')}, time, sofa_liver_score FROM s_liver"))
def c3(spark, sf):
    t = clinical(spark, sf)
    out = scores.liver(extract.bilirubin(t["measurement"], t["visit_occurrence"]))
    return rounded(out.select(V, "value", "time", "sofa_liver_score"), "value")


@query(
    "c4_cardiovascular_drug_score",
    _scored(f"SELECT visit_occurrence_id, itemid, item, total_duration, {round_sql('max_gamma')}, sofa_cardiovascular_score FROM s_drugs"),
)
def c4(spark, sf):
    return rounded(scores.cardiovascular_drugs(doses(clinical(spark, sf))), "max_gamma")


def drug_scores(t):
    return scores.score_drug_peaks(
        extract.infusion_peaks(t["drug_exposure"], t["visit_occurrence"], t["concept"], t["measurement"])
    )


@query(
    "c4_cardiovascular_drug_score_without_pairs",
    _scored(f"SELECT visit_occurrence_id, itemid, item, total_duration, {round_sql('max_gamma')}, sofa_cardiovascular_score FROM s_drugs"),
)
def c4_peaks(spark, sf):
    return rounded(drug_scores(clinical(spark, sf)), "max_gamma")


def pressure_scores(t):
    return scores.cardiovascular_pressure(extract.blood_pressure(t["measurement"], t["visit_occurrence"]))


@query(
    "c5_cardiovascular_pressure_score",
    _scored(f"SELECT visit_occurrence_id, itemid, item, {round_sql('lowest_mean_abp')}, sofa_cardiovascular_score FROM s_map"),
)
def c5(spark, sf):
    return rounded(pressure_scores(clinical(spark, sf)), "lowest_mean_abp")


def cns_scores(t):
    return scores.cns(extract.coma_score(t["measurement"], t["visit_occurrence"]))


@query("c6_cns_score", _scored("SELECT * FROM s_cns"))
def c6(spark, sf):
    return cns_scores(clinical(spark, sf))


def urine_scores(t):
    return scores.renal_urine(extract.urine_output(t["measurement"], t["visit_occurrence"]))


@query("c7_renal_urine_score", _scored(f"SELECT visit_occurrence_id, {round_sql('daily_urine_output')}, sofa_renal_score FROM s_urine"))
def c7(spark, sf):
    return rounded(urine_scores(clinical(spark, sf)), "daily_urine_output")


def creatinine_scores(t):
    return scores.renal_creatinine(extract.creatinine(t["measurement"], t["visit_occurrence"]))


@query("c8_renal_creatinine_score", _scored(f"SELECT visit_occurrence_id, {round_sql('max_creatinine')}, sofa_renal_score FROM s_crea"))
def c8(spark, sf):
    return rounded(creatinine_scores(clinical(spark, sf)), "max_creatinine")


def shock_flags(t):
    return scores.shock_flag(extract.lactate(t["measurement"], t["visit_occurrence"]))


@query("c9_shock_flag", _scored(f"SELECT visit_occurrence_id, {round_sql('max_lactate')}, septic_shock FROM s_shock"))
def c9(spark, sf):
    return rounded(shock_flags(clinical(spark, sf)), "max_lactate")


@query(
    "c10_strongest_evidence",
    _scored("SELECT visit_occurrence_id, sofa_cardiovascular_score FROM s_cardio"),
)
def c10(spark, sf):
    t = clinical(spark, sf)
    return scores.strongest_evidence(pressure_scores(t), drug_scores(t), "sofa_cardiovascular_score")


def narrowed(t):
    """Clinical tables with the measurements cut once to the concepts the cohort reads.

    Ten extracts follow; without this each of them would scan the whole table.
    """
    rows = t["measurement"].where(F.col("measurement_concept_id").isin(list(C.COHORT_MEASUREMENTS)))
    return t | {"measurement": cut_lineage(rows)}


def assembled(t):
    return scores.assemble_scores(
        t["visit_occurrence"],
        [
            (respiration_scores(t), ["sofa_respiration_score", "pf_ratio", "fio2", "pao2"]),
            (scores.coagulation(extract.platelets(t["measurement"], t["visit_occurrence"])), ["sofa_coagulation_score"]),
            (scores.liver(extract.bilirubin(t["measurement"], t["visit_occurrence"])), ["sofa_liver_score"]),
            (
                scores.strongest_evidence(pressure_scores(t), drug_scores(t), "sofa_cardiovascular_score"),
                ["sofa_cardiovascular_score"],
            ),
            (cns_scores(t), ["sofa_cns_score"]),
            (scores.strongest_evidence(creatinine_scores(t), urine_scores(t), "sofa_renal_score"), ["sofa_renal_score"]),
            (shock_flags(t), ["septic_shock"]),
        ],
    )


_ASSEMBLED = """SELECT v.visit_occurrence_id, r.sofa_respiration_score, r.pf_ratio, r.fio2, r.pao2, c.sofa_coagulation_score,
 l.sofa_liver_score, cv.sofa_cardiovascular_score, n.sofa_cns_score, k.sofa_renal_score, s.septic_shock
 FROM visit_occurrence v
 LEFT JOIN (SELECT visit_occurrence_id, max(sofa_respiration_score) AS sofa_respiration_score, max(pf_ratio) AS pf_ratio, max(fio2) AS fio2, max(pao2) AS pao2 FROM s_resp GROUP BY 1) r USING (visit_occurrence_id)
 LEFT JOIN (SELECT visit_occurrence_id, max(sofa_coagulation_score) AS sofa_coagulation_score FROM s_coag GROUP BY 1) c USING (visit_occurrence_id)
 LEFT JOIN (SELECT visit_occurrence_id, max(sofa_liver_score) AS sofa_liver_score FROM s_liver GROUP BY 1) l USING (visit_occurrence_id)
 LEFT JOIN s_cardio cv USING (visit_occurrence_id) LEFT JOIN s_cns n USING (visit_occurrence_id)
 LEFT JOIN s_renal k USING (visit_occurrence_id) LEFT JOIN s_shock s USING (visit_occurrence_id)"""
_ASSEMBLED_OUT = f"""SELECT visit_occurrence_id, sofa_respiration_score, {round_sql('pf_ratio', 'fio2', 'pao2')},
 sofa_coagulation_score, sofa_liver_score, sofa_cardiovascular_score, sofa_cns_score, sofa_renal_score, septic_shock"""
_SIX = " + ".join(f"coalesce({c}, 0)" for c in scores.SCORES)
_TOTALS = f"SELECT *, CAST({_SIX} AS DOUBLE) AS sofa_total_score FROM asm"
_LITERAL = " + ".join(f"coalesce(CAST({c} AS DOUBLE), 0)" for c in [*scores.SCORES, "pf_ratio", "fio2", "pao2", "septic_shock"])


@query(
    "c11_score_assembly",
    with_ctes(CLINICAL, _ASSEMBLED_OUT + " FROM asm", **_SCORE_STEPS, **_EVIDENCE, asm=_ASSEMBLED),
)
def c11(spark, sf):
    return rounded(assembled(narrowed(clinical(spark, sf))), "pf_ratio", "fio2", "pao2")


@query(
    "c12_total_score",
    with_ctes(CLINICAL, f"SELECT visit_occurrence_id, sofa_total_score, round({_LITERAL}, 6) AS literal_total FROM tot",
              **_SCORE_STEPS, **_EVIDENCE, asm=_ASSEMBLED, tot=_TOTALS),
)
def c12(spark, sf):
    base = assembled(narrowed(clinical(spark, sf)))
    both = scores.total_score(
        scores.total_score(base, literal=True).withColumnRenamed("sofa_total_score", "literal_total")
    )
    return rounded(both.select(V, "sofa_total_score", "literal_total"), "literal_total")


def cohort_of(t):
    return scores.shock_cohort(combined(t), scores.total_score(assembled(t)))


_COHORT = """SELECT b.visit_occurrence_id, b.person_id, b.sepsis_at_admission, b.sepsis_antibiotics_bool, b.sepsis_cultures_bool,
 t.sofa_total_score, t.sofa_cns_score, coalesce(t.septic_shock, FALSE) AS septic_shock FROM comb b JOIN tot t USING (visit_occurrence_id)
 WHERE b.sepsis_at_admission = 1 OR (b.sepsis_antibiotics_bool = 1 AND b.sepsis_cultures_bool = 1 AND t.sofa_total_score >= 2)"""
_COHORT_STEPS = (
    _SCORE_STEPS | _EVIDENCE | {"asm": _ASSEMBLED, "tot": _TOTALS} | _COMBINED_STEPS | {"comb": _COMBINED, "cohort": _COHORT}
)
_COHORT_COLUMNS = [V, "person_id", "sepsis_at_admission", "sepsis_antibiotics_bool", "sepsis_cultures_bool",
                   "sofa_total_score", "sofa_cns_score", "septic_shock"]


@query("c13_shock_cohort", with_ctes(CLINICAL, "SELECT * FROM cohort WHERE septic_shock", **_COHORT_STEPS))
def c13(spark, sf):
    return cohort_of(narrowed(clinical(spark, sf))).where("septic_shock").select(*_COHORT_COLUMNS)


@query(
    "c14_cohort_counts",
    with_ctes(CLINICAL, """SELECT count(DISTINCT person_id) AS septic_persons, count(DISTINCT visit_occurrence_id) AS septic_visits,
    count(DISTINCT CASE WHEN septic_shock THEN person_id END) AS shock_persons,
    count(DISTINCT CASE WHEN septic_shock THEN visit_occurrence_id END) AS shock_visits FROM cohort""", **_COHORT_STEPS),
)
def c14(spark, sf):
    return scores.cohort_counts(cohort_of(narrowed(clinical(spark, sf))))
