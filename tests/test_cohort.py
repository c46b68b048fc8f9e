import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from tests.rows import as_set
from icuriver.functions import concepts as C
from icuriver.operators import cohort, extract, nearest
from icuriver.session import configure
from icuriver.sources import sinks, tables

V = "visit_occurrence_id"
MEASUREMENT = (
    "person_id long, visit_occurrence_id long, measurement_concept_id long, measurement_source_value string, "
    "measurement_datetime timestamp_ntz, value_as_number double, value_as_concept_id long, unit_concept_id long, provider_id long"
)


@pytest.fixture
def visits(frame):
    return frame(
        [(1, 10, "2024-01-01 12:00:00", "2024-01-05 12:00:00"), (2, 10, "2024-02-01 00:00:00", "2024-02-02 00:00:00"),
         (3, 11, "2024-03-01 00:00:00", "2024-03-09 00:00:00")],
        "visit_occurrence_id long, person_id long, visit_start_datetime timestamp_ntz, visit_end_datetime timestamp_ntz",
    )


def measure(frame, rows):
    """(visit, concept, time, value, provider[, answer, unit])"""
    full = [(r[0] * 10, r[0], r[1], "x", r[2], r[3], r[5] if len(r) > 5 else None, r[6] if len(r) > 6 else None, r[4]) for r in rows]
    return frame(full, MEASUREMENT)


def test_record_filter(spark):
    df = spark.createDataFrame([(None,), (26,), (27,), (61,), (62,)], "provider_id long")
    assert df.where(cohort.validated()).count() == 4
    assert df.where(cohort.validated(mode="device")).count() == 1
    assert as_set(df.where(cohort.validated(mode="listed")), "provider_id") == [(27,), (61,)]
    with pytest.raises(ValueError):
        cohort.validated(mode="other")


def test_latest_diagnosis_and_combination(spark, frame, visits):
    person = spark.createDataFrame([(10, 1960, "Man"), (11, 1970, "Vrouw")], "person_id long, year_of_birth int, gender_source_value string")
    concept = spark.createDataFrame([(C.SEPSIS, "Sepsis", "S"), (36258242, "Amikacin", "A"), (40730323, "Ceftazidime", "B")],
                                    "concept_id long, concept_name string, concept_code string")
    condition = spark.createDataFrame(
        [(1, C.SEPSIS, dt.date(2024, 1, 1)), (1, C.SEPSIS, dt.date(2024, 1, 3)), (3, 5, dt.date(2024, 3, 1))],
        "visit_occurrence_id long, condition_concept_id long, condition_start_date date",
    )
    dx = cohort.latest_diagnosis(person, visits, condition, concept, C.SEPSIS)
    assert as_set(dx, V, "person_id", "condition_start_date") == [(1, 10, dt.date(2024, 1, 3))]
    drugs = frame(
        [(1, 40730323, "2024-01-01 00:00:00"), (1, 36258242, "2024-01-01 00:00:00"), (1, 36258242, "2024-01-02 00:00:00"),
         (2, 36258242, "2024-02-09 23:00:00"), (9, 36258242, "2024-01-01 00:00:00"), (3, 99, "2024-01-01 00:00:00")],
        "visit_occurrence_id long, drug_concept_id long, drug_exposure_start_datetime timestamp_ntz",
    )
    flags = cohort.exposure_flag(
        drugs, visits, concept, C.THERAPEUTIC_ANTIBIOTICS, concept_column="drug_concept_id",
        time_column="drug_exposure_start_datetime", flag="sepsis_antibiotics_bool", names="given",
        as_of="2024-02-10 00:00:00", older_than="1 DAY",
    )
    # visit 2 is too recent, visit 9 unknown; names are distinct and sorted
    assert as_set(flags, V, "sepsis_antibiotics_bool", "given") == [(1, 1, "Amikacin; Ceftazidime")]
    out = {r[V]: r for r in cohort.combined_diagnosis(visits, dx, flags).collect()}
    assert len(out) == 3
    assert out[1]["dx_person_id"] == 10 and out[2]["dx_person_id"] is None and out[2]["person_id"] == 10


def test_culture_list_keeps_the_negative_id():
    assert -3040827 in C.CULTURES and len(C.THERAPEUTIC_ANTIBIOTICS) == 35


def test_demographics_and_gender(spark, visits):
    person = spark.createDataFrame([(10, 1960, "MAN"), (11, 1970, "onbekend")], "person_id long, year_of_birth int, gender_source_value string")
    demo = cohort.gender_flag(cohort.demographics(visits, person))
    assert sorted((r[V], r["age_at_visit"], r["Gender"]) for r in demo.collect()) == [(1, 64.0, 1.0), (2, 64.0, 1.0), (3, 54.0, None)]
    women = spark.createDataFrame([("Vrouw", 1)], "gender_source_value string, age_at_visit int")
    assert cohort.gender_flag(women).first()["Gender"] == 0.0


def test_measurement_union_keeps_duplicates_across_branches(spark, frame):
    m = measure(frame, [
        (1, 3025315, "2024-01-01 00:00:00", 80.0, None), (1, 3025315, "2024-01-01 00:00:00", 80.0, None),
        (1, 3025315, "2024-01-01 00:00:00", 80.0, 27), (1, 3007461, "2024-01-01 00:00:00", 1.0, 61),
        (1, 3007461, "2024-01-01 00:00:00", 2.0, 62), (1, 5, "2024-01-01 00:00:00", 2.0, 40),
    ])
    concept = spark.createDataFrame([(3025315, "Weight"), (3007461, "Platelets")], "concept_id long, concept_name string")
    device, listed = concept.where("concept_id = 3025315"), concept
    out = cohort.measurement_union(m, concept, device.select("concept_id"), listed.select("concept_id"))
    assert as_set(out, "concept_name", "value_as_number") == [("Platelets", 1.0), ("Weight", 80.0), ("Weight", 80.0)]


def test_outcome(spark, frame, visits):
    death = frame([(10, "2024-02-01 10:00:00")], "person_id long, death_datetime timestamp_ntz")
    out = cohort.outcome(visits, death)
    assert as_set(out, V, "died_in_hospital") == [(1, 0), (2, 1), (3, 0)]
    windows = spark.createDataFrame([(1, "a"), (2, "b"), (2, "c"), (7, "d")], "visit_occurrence_id long, w string")
    attached = cohort.attach_outcome(windows, out.unionByName(out))
    assert as_set(attached, "w", "died_in_hospital") == [("a", 0), ("b", 1), ("c", 1), ("d", 0)]


def test_admission_window_admits_59_minutes_before(frame, visits):
    m = measure(frame, [
        (1, 3007461, "2024-01-01 11:01:00", 1.0, 1), (1, 3007461, "2024-01-01 10:59:00", 2.0, 1),
        (1, 3007461, "2024-01-02 12:59:00", 3.0, 1), (1, 3007461, "2024-01-02 13:00:00", 4.0, 1),
        (1, 3007461, "2024-01-01 13:00:00", 5.0, None),
    ])
    assert as_set(extract.platelets(m, visits), "value", "time") == [(1.0, 0), (3.0, 24)]


def test_pressure_has_no_lower_bound_and_any_provider(frame, visits):
    m = measure(frame, [(1, 21490852, "2023-12-01 00:00:00", 70.0, None), (1, 21492241, "2024-01-03 00:00:00", 71.0, 1)])
    assert as_set(extract.blood_pressure(m, visits), "value", "validated") == [(70.0, False)]


def test_infusion_doses(spark, frame, visits):
    concept = spark.createDataFrame([(C.DOPAMINE, "Dopamine")], "concept_id long, concept_name string")
    drugs = frame(
        [(10, 1, C.DOPAMINE, "2024-01-01 13:00:00", "2024-01-01 14:30:00", "bag 5 mg @ 2.5 mg/uur"),
         (10, 1, C.DOPAMINE, "2024-01-01 13:00:00", "2024-01-01 14:00:00", "no text"),
         (10, 1, C.DOPAMINE, "2024-01-01 13:00:00", "2024-01-01 14:00:00", "5 mg @ 0.1 mg/uur"),
         (10, 1, C.DOPAMINE, "2024-01-03 13:00:00", "2024-01-03 14:00:00", "5 mg @ 3 mg/uur"),
         (11, 3, C.DOPAMINE, "2024-03-01 01:00:00", "2024-03-01 02:00:00", "7 mg @ 6 mg/uur")],
        "person_id long, visit_occurrence_id long, drug_concept_id long, drug_exposure_start_datetime timestamp_ntz, "
        "drug_exposure_end_datetime timestamp_ntz, sig string",
    )
    m = measure(frame, [(1, 3025315, "2024-01-01 00:00:00", 50.0, None), (1, 3013762, "2024-01-01 00:00:00", 100.0, None)])
    out = extract.infusion_doses(drugs, visits, concept, m)
    got = sorted((r[V], r["duration"], r["dose"], r["rate"], r["start_time"], r["patientweight"] or 0) for r in out.collect())
    assert got == [(1, 90, 5.0, 2.5, 60, 50.0), (1, 90, 5.0, 2.5, 60, 100.0), (3, 60, 7.0, 6.0, 60, 0)]
    assert out.where("patientweight = 50").first()["gamma"] == pytest.approx(2500 / 50 / 60)
    assert extract.infusion_doses(drugs, visits, concept, m, weight_agg="min").count() == 2
    # peaks equal the aggregate over all (infusion, weight) pairs, negative and zero weights included
    for extra in ([], [(1, 3025315, "2024-01-01 00:00:00", -5.0, None)], [(3, 3025315, "2024-01-01 00:00:00", -5.0, None), (3, 3025315, "2024-01-01 00:00:00", 0.0, None)]):
        more = m.unionByName(measure(frame, extra)) if extra else m
        pairs = extract.infusion_doses(drugs, visits, concept, more).groupBy(V, "itemid", "item").agg(
            F.sum("duration").alias("total_duration"), F.max("gamma").alias("max_gamma"))
        assert sorted(map(str, extract.infusion_peaks(drugs, visits, concept, more).collect())) == sorted(map(str, pairs.collect()))
    absolute = extract.infusion_doses(drugs, visits, concept, m, first_day=False, absolute=True)
    assert absolute.count() == 5 and "start_datetime" in absolute.columns


def test_coma_score(frame, visits):
    m = measure(frame, [
        (1, C.EYES, "2024-01-01 13:00:00", None, 1, 45880466), (1, C.MOTOR, "2024-01-01 13:00:00", None, 1, 45880468),
        (1, C.VERBAL, "2024-01-01 13:00:00", None, 1, 45877602), (1, C.VERBAL, "2024-01-01 12:30:00", None, 1, 36311192),
    ])
    # rows are never combined: the best row at the latest time is verbal 6
    assert as_set(extract.coma_score(m, visits), V, "gcs_score", "time") == [(1, 6, 60)]
    assert as_set(extract.coma_score(m, visits, combine=True), V, "gcs_score") == [(1, 15)]


def test_creatinine(frame, visits):
    m = measure(frame, [
        (1, 3020564, "2023-12-01 00:00:00", 40.0, 1), (1, 3020564, "2024-01-01 13:00:00", 90.0, 1),
        (1, 3020564, "2024-01-05 13:00:00", 130.0, 1), (3, 3020564, "2024-03-01 01:00:00", 100.0, 1),
    ])
    out = extract.creatinine(m, visits)
    assert as_set(out, V, "value", "baseline_creatinine", "max_creatinine_7days", "acute_renal_failure") == [
        (1, 90.0, 40.0, 130.0, True), (3, 100.0, 100.0, 100.0, False)
    ]


def test_fio2_device_tables_only_with_the_right_column(frame, visits):
    m = measure(frame, [
        (1, 3014080, "2024-01-01 13:00:00", 3.5, 1), (1, 3025408, "2024-01-01 14:00:00", 40.0, 1), (1, 3014080, "2024-01-01 15:00:00", -1.0, 1),
    ])
    obs = frame([(1, C.OXYGEN_DEVICE, "2024-01-01 13:00:00", 4224038.0, 1)],
                "visit_occurrence_id long, observation_concept_id long, observation_datetime timestamp_ntz, value_as_number double, provider_id long")
    assert as_set(extract.fio2_estimate(m, obs, visits), "ventilatory_support", "fio2") == [(False, 0.21), (True, 40.0)]
    named = extract.fio2_estimate(m, obs, visits, device_column="value_as_number")
    assert as_set(named, "ventilatory_support", "fio2") == [(False, 0.27), (True, 40.0)]


def test_oxygenation(frame, spark, visits):
    m = measure(frame, [
        (1, C.PAO2, "2024-01-01 13:00:00", 10.0, 1, None, 152), (1, C.PAO2, "2024-01-01 13:00:00", 80.0, 1),
        (1, C.PAO2, "2024-01-01 20:00:00", 90.0, 1), (3, C.PAO2, "2024-03-01 01:00:00", 70.0, 1),
        (1, C.SPECIMEN, "2024-01-01 13:00:00", 5.0, 1),
    ])
    fio2 = frame([(1, "2024-01-01 12:00:00", 0.3, True), (1, "2024-01-01 14:00:00", 0.4, True), (1, "2024-01-01 19:00:00", 0.5, False)],
                 "visit_occurrence_id long, measurement_datetime timestamp_ntz, fio2 double, ventilatory_support boolean")
    out = sorted((r[V], round(r["pao2"], 3), r["fio2"] or 0, r["fio2_time_difference"] or 0, r["specimen_source"] or 0)
                 for r in nearest.oxygenation(m, visits, fio2).collect())
    # equal distances go to the earlier FiO2; equal times to one row; no FiO2 keeps the row
    assert out == [(1, 75.006, 0.3, -60, 5.0), (1, 90.0, 0.5, -60, 0), (3, 70.0, 0, 0, 0)]
    timed = nearest.oxygenation(m, visits, fio2, time_from="right")
    assert as_set(timed.where(f"{V} = 3"), "measurement_datetime") == [(None,)]


def test_sources_and_sinks(spark, tmp_path):
    path = tmp_path / "dict.csv"
    path.write_text("category,feature_name,concept_name,concept_id\nA,Weight,w,1\nA,_,x,2\nB,Age,,\n")
    d = tables.read_dictionary(spark, str(path))
    assert as_set(tables.feature_concepts(d), "feature_name", "concept_id") == [("Weight", 1)]
    assert tables.feature_concepts(d, ["Age"]).count() == 0 and tables.used_features(d).count() == 2
    ids = spark.createDataFrame([(1,), (1,)], "k long")
    rows = spark.createDataFrame([(1, "a"), (2, "b")], "k long, v string")
    assert as_set(tables.restrict_to(rows, ids, "k"), "v") == [("a",)]
    text = spark.createDataFrame([("1.5", "2024-01-01 00:00:00"), ("bad", "bad"), ("NaN", None)], "n string, t string")
    assert [r["n"] for r in tables.coerce(text, ["n"], ["t"]).collect()] == [1.5, None, None]
    for name in tables.CLINICAL_TABLES:
        sinks.write_parquet(rows.withColumn("x", F.lit(float("nan"))), str(tmp_path / f"{name}.parquet"))
    clinical = tables.read_clinical(spark, str(tmp_path))
    assert set(clinical) == set(tables.CLINICAL_TABLES) and clinical["death"].where("x is null").count() == 2
    sinks.write_csv(rows, str(tmp_path / "gaps"))
    sinks.write_json(rows, str(tmp_path / "metrics"))
    assert spark.read.csv(str(tmp_path / "gaps"), header=True).count() == 2
    assert spark.read.json(str(tmp_path / "metrics")).count() == 2
    trials = tmp_path / "trials.csv"
    trials.write_text(
        ",number,value,datetime_start,datetime_complete,duration,params_batch_size,params_latent_dim,params_layer_sizes,params_lr,state\n"
        '0,0,0.5,2025-01-01 00:00:00,2025-01-01 00:01:00,0 days,64,8,"[64, 32]",0.001,COMPLETE\n'
    )
    assert tables.read_trials(spark, str(trials)).first()["params_layer_sizes"] == "[64, 32]"


def test_a_broken_run_leaves_the_committed_table(spark, tmp_path):
    path = f"file://{tmp_path}/metrics"
    with pytest.raises(FileNotFoundError):
        sinks.read_committed(spark, path)
    first = spark.range(3).withColumn("x", F.lit("a"))
    sinks.write_committed(first, path)
    bad = spark.range(8).withColumn("x", F.when(F.col("id") == 5, F.raise_error(F.lit("lost"))).otherwise("b"))
    for _ in range(2):
        with pytest.raises(Exception, match="lost"):
            sinks.write_committed(bad, path)
        assert as_set(sinks.read_committed(spark, path), "id", "x") == [(0, "a"), (1, "a"), (2, "a")]
    # the next run may read what it replaces, and what broken runs left goes with it
    for n in (4, 5):
        more = sinks.read_committed(spark, path).union(spark.createDataFrame([(n, "c")], "id long, x string"))
        sinks.write_committed(more, path)
    assert as_set(sinks.read_committed(spark, path), "id", "x") == [(0, "a"), (1, "a"), (2, "a"), (4, "c"), (5, "c")]
    assert len([p for p in os.listdir(tmp_path / "metrics") if p.startswith("run-")]) == 1
    sinks.write_committed(first.limit(0), path)
    assert sinks.read_committed(spark, path, schema="id long, x string").count() == 0


def test_a_side_that_grows_with_the_visits_is_not_broadcast(spark):
    """Some twenty such sides in the cohort's plan went through the driver."""
    configure(spark)
    rows, visits = spark.range(200_000), spark.range(100_000).selectExpr("id", "md5(CAST(id AS STRING)) AS name")
    joined = rows.join(visits.groupBy("id").agg(F.min("name").alias("name")), "id", "left").agg(F.count("name"))
    assert joined.first()[0] == 100_000
    assert "BroadcastExchange" not in joined._jdf.queryExecution().executedPlan().toString()
