import pytest
from pyspark.sql import functions as F

from tests.rows import as_set
from icuriver.functions import concepts as C
from icuriver.operators import scores

V = "visit_occurrence_id"


def test_respiration_repairs_units(spark):
    rows = [(1, 80.0, 21.0, False), (2, 80.0, 10.0, True), (3, 40.0, 0.5, True), (4, 60.0, 0.5, True), (5, 60.0, 100.0, True),
            (6, 60.0, 101.0, True), (7, 80.0, 0.21, None), (8, 60.0, 0.4, False)]
    df = spark.createDataFrame(rows, "visit_occurrence_id long, pao2 double, fio2 double, ventilatory_support boolean")
    out = {r[V]: (r["fio2"], r["sofa_respiration_score"]) for r in scores.respiration(df).collect()}
    # 10 lies between 1 and 20 and is lost, row 3 is dropped
    assert out == {1: (0.21, 1), 2: (None, 0), 4: (0.5, 3), 5: (1.0, 4), 6: (None, 0), 7: (0.21, 1), 8: (0.4, 2)}


@pytest.mark.parametrize("fn, column, cases", [
    (scores.coagulation, "sofa_coagulation_score", {150: 0, 149: 1, 99: 2, 49: 3, 19: 4, None: 0}),
    (scores.liver, "sofa_liver_score", {19: 0, 20: 1, 33: 2, 102: 3, 204: 4, None: 0}),
])
def test_bands(spark, fn, column, cases):
    df = spark.createDataFrame([(float(v) if v is not None else None, s) for v, s in cases.items()], "value double, want int")
    assert all(r["want"] == r[column] for r in fn(df).collect())


def test_cardiovascular_drugs(spark):
    rows = [(1, C.DOPAMINE, "d", 5, 15.0), (2, C.DOPAMINE, "d", 5, 5.0), (3, C.DOPAMINE, "d", 5, 6.0), (4, C.DOPAMINE, "d", 5, 16.0),
            (5, C.DOBUTAMINE, "b", 5, None), (6, C.EPINEPHRINE, "e", 5, 0.1), (7, C.NOREPINEPHRINE, "n", 5, 0.2), (7, C.NOREPINEPHRINE, "n", 6, 0.01),
            (None, C.DOPAMINE, "d", 5, 6.0)]
    df = spark.createDataFrame(rows, "visit_occurrence_id long, itemid long, item string, duration long, gamma double")
    out = scores.cardiovascular_drugs(df)
    # dopamine at exactly 15 scores 0
    assert as_set(out, V, "sofa_cardiovascular_score") == [(1, 0), (2, 2), (3, 3), (4, 4), (5, 2), (6, 3), (7, 4)]
    assert as_set(out.where(f"{V} = 7"), "total_duration", "max_gamma") == [(11, 0.2)]


def test_pressure_urine_creatinine_cns_shock(spark):
    p = spark.createDataFrame([(1, 9, "a", 166.0), (1, 9, "a", 30.0), (1, 9, "a", 69.0), (2, 9, "a", 70.0), (3, 9, None, 40.0)],
                              "visit_occurrence_id long, itemid long, item string, value double")
    assert as_set(scores.cardiovascular_pressure(p), V, "lowest_mean_abp", "sofa_cardiovascular_score") == [(1, 69.0, 1), (2, 70.0, 0)]
    u = spark.createDataFrame([(1, 3000.0), (2, 200.0), (3, 199.0), (4, 50000.0), (5, 500.0)], "visit_occurrence_id long, value double")
    assert as_set(scores.renal_urine(u), V, "daily_urine_output", "sofa_renal_score") == [(1, 300.0, 3), (2, 200.0, 0), (3, 199.0, 4), (5, 500.0, 0)]
    c = spark.createDataFrame([(1, 29.0), (2, 110.0), (3, 440.0), (4, 441.0), (5, 171.0)], "visit_occurrence_id long, value double")
    assert as_set(scores.renal_creatinine(c), V, "sofa_renal_score") == [(2, 1), (3, 3), (4, 4), (5, 2)]
    g = spark.createDataFrame([(1, 15), (2, 13), (3, 12), (4, 6), (5, 5), (5, 15)], "visit_occurrence_id long, gcs_score int")
    assert as_set(scores.cns(g), V, "sofa_cns_score") == [(1, 0), (2, 1), (3, 2), (4, 3), (5, 4)]
    s = spark.createDataFrame([(1, 2.0), (2, 2.1), (2, None)], "visit_occurrence_id long, value double")
    assert as_set(scores.shock_flag(s), V, "septic_shock") == [(1, False), (2, True)]


def test_total_and_cohort(spark):
    visits = spark.createDataFrame([(1,), (2,), (3,)], "visit_occurrence_id long")
    parts = [(spark.createDataFrame([(1, 2), (1, 1), (2, 1)], f"visit_occurrence_id long, {c} int"), [c]) for c in scores.SCORES]
    shock = spark.createDataFrame([(1, True), (2, True)], "visit_occurrence_id long, septic_shock boolean")
    table = scores.assemble_scores(visits, [*parts, (shock, ["septic_shock"])])
    total = scores.total_score(table)
    assert as_set(total, V, "sofa_total_score") == [(1, 12.0), (2, 6.0), (3, 0.0)]
    assert as_set(scores.total_score(table, literal=True), V, "sofa_total_score") == [(1, 13.0), (2, 7.0), (3, 0.0)]
    dx = spark.createDataFrame([(1, 7, None, 1, 1), (2, 7, None, 1, None), (3, 8, 1, None, None)],
                               "visit_occurrence_id long, person_id long, sepsis_at_admission int, sepsis_antibiotics_bool int, sepsis_cultures_bool int")
    cohort = scores.shock_cohort(dx, total)
    assert as_set(cohort, V, "septic_shock") == [(1, True), (3, False)]
    assert scores.cohort_counts(cohort).first().asDict() == {"septic_persons": 2, "septic_visits": 2, "shock_persons": 1, "shock_visits": 1}
    both = scores.strongest_evidence(parts[0][0], parts[0][0].withColumn("extra", F.lit(1)), scores.SCORES[0])
    assert as_set(both, V, scores.SCORES[0]) == [(1, 2), (2, 1)]
