import datetime

import numpy as np

from icuriver.operators import impute, policy_run

V, TS = "visit_occurrence_id", "measurement_datetime"
SCHEMA = f"{V} long, {TS} timestamp_ntz, k string, a double, b double, fluid double, dose double, died_in_hospital int"


def _rows(change=None):
    """Twelve visits of ten windows; the values of visits in ``change`` are others."""
    rng = np.random.default_rng(4)
    rows = []
    for v in range(12):
        for i in range(10):
            a, b, fluid, dose = rng.gamma(2.0, size=4)
            if change is not None and v in change:
                a, b, fluid, dose = a * 50, -b, fluid * 9, dose * 9
            rows.append((v, datetime.datetime(2024, 1, 1) + datetime.timedelta(hours=12 * i), f"{v}:{i}",
                         None if i % 4 == 1 else float(a), None if i % 5 == 2 else float(b), float(fluid), 0.0 if i % 3 else float(dose), v % 2))
    return rows


def _fitted(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA)
    return policy_run.fitted_rows(df, ["a", "b"], "k", fluids="fluid", vasopressors="dose", clusters=6, threshold=0.0)


def test_nothing_is_learned_from_other_visits(spark):
    df = spark.createDataFrame(_rows(), SCHEMA)
    split = {r[V]: r["split"] for r in impute.split_visits(df).collect()}
    others = {v for v, s in split.items() if s != "train"}
    assert 0 < len(others) < 12

    def train(rows):
        return sorted((r[V], r[TS], r["a"], r["b"], r["state"], r["action"]) for r in _fitted(spark, rows).where("split = 'train'").collect())

    first = train(_rows())
    assert first == train(_rows(others)) and len(first) == 10 * (12 - len(others))


def test_estimates_cover_the_named_split_only(spark):
    rows = _fitted(spark, _rows()).cache()
    got = {r["method"]: r["estimate"] for r in policy_run.evaluated_policy(rows, sweeps=5, gamma=0.9).collect()}
    tested = {r[V]: r["died_in_hospital"] for r in rows.where("split = 'test'").select(V, "died_in_hospital").distinct().collect()}
    gains = [0.9**9 * (100 if died == 0 else -100) for died in tested.values()]
    assert set(got) == {"observed", "direct", "trajectory", "per_decision", "doubly_robust"}
    assert np.isclose(got["observed"], np.mean(gains))
    assert all(np.isfinite(v) for v in got.values())
    rows.unpersist()
