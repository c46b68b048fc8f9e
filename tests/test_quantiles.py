import numpy as np
import pytest
from pyspark.sql import functions as F

from icuriver.functions.quantiles import column_quantiles, quantile_table

PROBS = [0.0, 0.01, 0.25, 0.5, 0.75, 0.99, 1.0]


def _samples():
    rng = np.random.default_rng(0)
    return {
        "normal": rng.normal(size=5000),
        "tied": rng.integers(0, 4, size=3000).astype(float),
        "long_tail": np.exp(rng.normal(size=2000) * 3),
        "constant": np.full(500, 7.0),
        "single": np.array([3.0]),
        "two": np.array([1.0, 2.0]),
    }


# low accuracies force narrow brackets on few rows
@pytest.mark.parametrize("accuracy", [50, 200, 20_000])
def test_equals_numpy(spark, accuracy):
    samples = _samples()
    rows = [(k, float(x)) for k, xs in samples.items() for x in xs] + [("normal", None), ("normal", float("nan"))]
    df = spark.createDataFrame(rows, "k string, v double").repartition(7)
    got = {(r["key"], r["prob"]): r["quantile"] for r in quantile_table(df, F.col("k"), F.col("v"), PROBS, accuracy).collect()}
    for key, xs in samples.items():
        for p in PROBS:
            assert got[key, p] == pytest.approx(np.quantile(xs, p), abs=1e-9), (key, p)


def test_columns(spark):
    df = spark.createDataFrame([(float(i), float(i * i)) for i in range(101)], "a double, b double")
    got = {r["key"]: r["quantile"] for r in column_quantiles(df, {"a": F.col("a"), "b": F.col("b")}, [0.5]).collect()}
    assert got == {"a": 50.0, "b": 2500.0}
