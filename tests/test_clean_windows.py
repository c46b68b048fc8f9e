import datetime as dt
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.rows import as_set
from icuriver.operators import clean, reshape, transform

V, TS = "visit_occurrence_id", "measurement_datetime"
LONG = f"{V} long, {TS} timestamp_ntz, feature_name string, value_as_number double"


def test_iqr_cut_long(spark):
    rows = [("a", float(x)) for x in range(1, 12)] + [("a", 100.0), ("a", None), ("b", 1e9), ("b", None)]
    df = spark.createDataFrame(rows, "feature_name string, value_as_number double")
    out = clean.drop_outliers_long(df, ["a"])
    # 100 and the missing value of the listed feature go, the other feature stays
    assert out.where("feature_name = 'a'").count() == 11 and out.where("feature_name = 'b'").count() == 2


def test_iqr_fallback_stages(spark):
    # a fifth of the values lies far out: the 1/99 cut replaces the quartile cut
    rows = [("a", float(i % 3)) for i in range(800)] + [("a", 100.0 + i) for i in range(200)]
    df = spark.createDataFrame(rows, "feature_name string, value_as_number double")
    assert clean.drop_outliers_long(df, ["a"]).count() == 800
    xs = np.array([r[1] for r in rows])
    lo, hi = np.percentile(xs, [1, 99])
    assert clean.drop_outliers_long(df, ["a"], fallback=True).count() == int(((xs >= lo) & (xs <= hi)).sum())


def test_iqr_wide(spark):
    df = spark.createDataFrame([(float(x),) for x in [1, 2, 3, 4, 100]], "x double")
    assert as_set(clean.null_outliers_wide(df, ["x", "absent"]).where("x is not null"), "x") == [(1.0,), (2.0,), (3.0,), (4.0,)]
    assert clean.null_outliers_wide(df, ["x"], literal=True).where("x is null").count() == 0


def test_scalers(spark):
    df = spark.createDataFrame([(1.0, 5.0), (2.0, 5.0), (3.0, 5.0)], "x double, c double")
    assert [r["x"] for r in clean.standardise(df, columns=["x"]).orderBy("x").collect()] == [-1.0, 0.0, 1.0]
    assert clean.standardise(df).where("c is not null").count() == 0
    fitted = clean.standardise(df, columns=["x"], fit_on=df.where("x < 3"))
    assert [round(r["x"], 6) for r in fitted.orderBy("x").collect()] == [-0.707107, 0.707107, 2.12132]
    out, scaler = clean.standardise_population(df, ["x", "c"])
    assert {r["column"]: r["scale"] for r in scaler.collect()}["c"] == 1.0
    assert [r["c"] for r in out.collect()] == [0.0, 0.0, 0.0]


def test_reports(spark):
    df = spark.createDataFrame([(1.0, None, 2.0), (2.0, None, None), (3.0, 1.0, 4.0), (4.0, None, 8.0)], "a double, b double, c double")
    assert [(r["column"], r["missing_pct"]) for r in clean.missing_report(df).collect()] == [("b", 75.0), ("c", 25.0), ("a", 0.0)]
    assert clean.non_null_cells(df).first()["cells"] == 8
    kept, gone = clean.drop_sparse_columns(df, 65)
    assert gone == ["b"] and kept.columns == ["a", "c"]
    assert clean.drop_sparse_rows(df, ["a", "b", "c"], 0.5).count() == 3
    assert clean.drop_sparse_rows(df, ["a", "b", "c"], 0.9).count() == 1
    d = {r["column"]: r for r in clean.describe(df, ["a"]).collect()}["a"]
    assert (d["count"], d["mean"], d["min"], d["q25"], d["q50"], d["q75"], d["max"]) == (4, 2.5, 1.0, 1.75, 2.5, 3.25, 4.0)
    corr = {(r["feature_a"], r["feature_b"]): r["correlation"] for r in clean.correlation(df, ["a", "c"]).collect()}
    assert corr["a", "c"] == corr["c", "a"] == pytest.approx(np.corrcoef([1, 3, 4], [2, 4, 8])[0, 1])
    assert corr["a", "a"] == pytest.approx(1.0)
    assert as_set(clean.drop_empty_rows(spark.createDataFrame([(None, None), (1, None)], "a int, b int")), "a", "b") == [(1, None)]
    assert as_set(clean.round_binary(spark.createDataFrame([(0.5,), (1.5,), (0.51,)], "x double"), ["x"]), "x") == [(0,), (1,), (2,)]


def test_histogram_edges(spark):
    xs = [0.0, 1.0, 2.0, 10.0]
    df = spark.createDataFrame([(x,) for x in xs], "x double")
    got = [r["count"] for r in clean.histogram(df, "x", 10).orderBy("bin").collect()]
    assert got == list(np.histogram(xs, bins=10)[0])
    same = clean.histogram(spark.createDataFrame([(3.0,), (3.0,)], "x double"), "x", 4).orderBy("bin").collect()
    assert [r["count"] for r in same] == list(np.histogram([3.0, 3.0], bins=4)[0]) and same[0]["bin_start"] == 2.5


def test_windows_have_no_gap_and_anchor_at_midnight(frame):
    rows = [(1, "2024-01-01 13:00:00", "a", 1.0), (1, "2024-01-01 14:00:00", "a", 3.0), (1, "2024-01-03 00:00:00", "a", 5.0),
            (2, "2024-01-05 23:59:59", "b", 7.0), (2, None, "b", 9.0)]
    wide = reshape.to_wide(frame(rows, LONG), ["a", "b"])
    out = reshape.windowed_means(wide, ["a", "b"]).orderBy(V, TS).collect()
    at = dt.datetime
    assert [(r[V], r[TS], r["a"], r["b"]) for r in out] == [
        (1, at(2024, 1, 1, 12), 2.0, None), (1, at(2024, 1, 2, 0), None, None), (1, at(2024, 1, 2, 12), None, None),
        (1, at(2024, 1, 3, 0), 5.0, None), (2, at(2024, 1, 5, 12), None, 7.0)]
    # seven-hour windows restart from midnight of the first day, not of each day
    seven = reshape.windowed_means(wide, ["a"], hours=7).where(f"{V} = 1").orderBy(TS).collect()
    assert [r[TS].isoformat() for r in seven][:2] == ["2024-01-01T07:00:00", "2024-01-01T14:00:00"]
    assert seven[0]["a"] == 1.0 and seven[1]["a"] == 3.0 and seven[-1][TS] == at(2024, 1, 2, 18)
    numbered = reshape.sequence_numbers(reshape.windowed_means(wide, ["a"]), start=1)
    assert as_set(numbered.where(f"{V} = 1"), "seq_id") == [(1,), (2,), (3,), (4,)]


def test_duplicates_merge_and_attributes(frame, spark):
    rows = [(1, "2024-01-01 00:00:00", "a", 1.0), (1, "2024-01-01 00:00:00", "a", 2.0), (1, "2024-01-01 00:00:00", None, 2.0)]
    assert as_set(reshape.average_duplicates(frame(rows, LONG)), "value_as_number") == [(1.5,)]
    wide = frame([(1, "2024-01-01 00:00:00", 1.0)], f"{V} long, {TS} timestamp_ntz, a double")
    other = frame([(1, "2024-01-01 00:00:00", 2.0), (1, "2024-01-01 00:00:00", 3.0), (1, "2024-01-02 00:00:00", 4.0)], f"{V} long, {TS} timestamp_ntz, b double")
    assert len(as_set(reshape.merge_series(wide, other), V)) == 3
    people = spark.createDataFrame([(1, 50.0), (2, 60.0)], f"{V} long, age double")
    assert as_set(reshape.attach_attributes(wide, people, ["age"]), "a", "age") == [(1.0, 50.0)]


def _llf(x, lam):
    y = np.where(x >= 0, np.log1p(np.abs(x)) if abs(lam) < 1e-12 else ((np.abs(x) + 1) ** lam - 1) / lam, 0)
    neg = x < 0
    y[neg] = -np.log1p(-x[neg]) if abs(lam - 2) < 1e-12 else -((1 - x[neg]) ** (2 - lam) - 1) / (2 - lam)
    return -len(x) / 2 * np.log(y.var()) + (lam - 1) * np.sum(np.sign(x) * np.log1p(np.abs(x)))


def test_power_transform(spark):
    rng = np.random.default_rng(1)
    x, y = np.exp(rng.normal(size=400)), rng.normal(size=400) - 0.5
    df = spark.createDataFrame([(float(a), float(b), 1.0, None) for a, b in zip(x, y)], "x double, y double, c double, e double")
    fitted = transform.fit_power(df, ["x", "y", "c", "e"])
    grid = np.linspace(-2, 4, 6001)
    for name, values in (("x", x), ("y", y)):
        assert fitted[name] == pytest.approx(grid[np.argmax([_llf(values, g) for g in grid])], abs=2e-3)
    assert fitted["e"] == 1.0
    before, after = df.agg(F.skewness("x")).first()[0], transform.apply_power(df, fitted).agg(F.skewness("x")).first()[0]
    assert abs(after) < abs(before)
    # an exponent that makes the skew worse leaves the column alone
    same = transform.apply_power(df, {"x": 3.0}).agg(F.skewness("x")).first()[0]
    assert math.isclose(same, before)


def test_power_transform_beyond_the_first_bracket(spark):
    rng = np.random.default_rng(2)
    x = (7.0 * rng.normal(3, 0.4, size=400) + 1) ** (1 / 7.0) - 1
    low = -x
    df = spark.createDataFrame([(float(a), float(b)) for a, b in zip(x, low)], "x double, low double")
    fitted = transform.fit_power(df, ["x", "low"])
    grid = np.linspace(-20, 20, 40001)
    for name, values in (("x", x), ("low", low)):
        best = grid[np.argmax([_llf(values, g) for g in grid])]
        assert not -2 <= best <= 4
        assert fitted[name] == pytest.approx(best, abs=1e-2)


def test_correlation_of_many_equals_that_of_pairs(spark):
    rows = [(float(i), 1e6 + (i * i) % 17, None if i % 3 else float(-i), 0.1, float("nan") if i % 2 else 2.0 * i, None) for i in range(60)]
    df = spark.createDataFrame(rows, "a double, b double, c double, d double, e double, f double").repartition(5)
    got = {(r[0], r[1]): r[2] for r in clean.correlation_of_many(df, df.columns).collect()}
    plain = df.replace(float("nan"), None)
    want = {(r[0], r[1]): r[2] for r in clean.correlation(plain, plain.columns).collect()}
    assert got.keys() == want.keys() and len(got) == 36
    for pair, r in want.items():
        if "d" in pair or "f" in pair:  # constant, or nothing there
            assert got[pair] is None
        else:
            assert abs(got[pair] - r) < 1e-9
    none = clean.correlation_of_many(df.limit(0), ["a", "b"]).collect()
    assert len(none) == 4 and all(r[2] is None for r in none)
