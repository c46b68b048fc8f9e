"""Ordered scans give the same rows whether or not a hot key is cut into chunks."""

import random

from pyspark.sql import functions as F

from icuriver.functions.ordered import _CHUNK, _cut, hot_keys, ordered_scan
from icuriver.operators import impute, nearest, ope, reshape, trajectory


def _rows(seed=1, n=400):
    rng = random.Random(seed)
    # one key holds most rows, half of its values are missing
    return [
        (1 if i % 4 else rng.randint(2, 5), i, None if rng.random() < 0.5 else float(rng.randint(0, 99)))
        for i in range(n)
    ]


def _scan(df, min_rows):
    return ordered_scan(
        df, ["k"], ["t"],
        last={"prev": F.col("v")}, following={"next": F.col("v")}, lead={"after": F.col("v")},
        totals={"total": F.col("v")}, number="rn", min_rows=min_rows,
    )


def test_hot_key_is_found_and_cut(spark):
    df = spark.createDataFrame(_rows(), "k long, t long, v double")
    assert hot_keys(df, ["k"], "t", 1000) is None
    assert [r["k"] for r in hot_keys(df, ["k"], "t", 100).collect()] == [1]


def test_chunked_scan_equals_plain_python(spark):
    rows = _rows()
    df = spark.createDataFrame(rows, "k long, t long, v double")
    want = {}
    for key in {r[0] for r in rows}:
        mine = sorted(r for r in rows if r[0] == key)
        for i, (_, t, v) in enumerate(mine):
            seen = [x[2] for x in mine[: i + 1] if x[2] is not None]
            ahead = [x[2] for x in mine[i:] if x[2] is not None]
            want[key, t] = (
                seen[-1] if seen else None, ahead[0] if ahead else None,
                mine[i + 1][2] if i + 1 < len(mine) else None, sum(seen) if seen else None, i + 1,
            )
    for min_rows in (None, 20):
        got = {
            (r["k"], r["t"]): (r["prev"], r["next"], r["after"], r["total"], r["rn"])
            for r in _scan(df, min_rows).collect()
        }
        assert got == want


def test_a_stray_time_leaves_chunks_even(spark):
    rows = [(1, i, 1.0) for i in range(4000)] + [(1, 10**12, 1.0), (1, -(10**12), 1.0)] + [(2, i, 1.0) for i in range(500)]
    rows += [(3, 7, 1.0)] * 300 + [(4, 1, 1.0)]
    df = spark.createDataFrame(rows, "k long, t long, v double")
    cut = _cut(df, hot_keys(df, ["k"], "t", 100), ["k"], "t")
    sizes = {}
    for r in cut.groupBy("k", _CHUNK).agg(F.count("*").alias("n"), F.min("t").alias("lo"), F.max("t").alias("hi")).collect():
        sizes.setdefault(r["k"], []).append((r["lo"], r["hi"], r[_CHUNK], r["n"]))
    assert len(sizes[1]) >= 150 and max(n for *_, n in sizes[1]) <= 60  # 4002 rows in 161 chunks at most
    assert 15 <= len(sizes[2]) <= 25 and max(n for *_, n in sizes[2]) <= 60
    assert len(sizes[3]) == len(sizes[4]) == 1
    for parts in sizes.values():  # later chunks hold later times
        parts.sort()
        assert all(a[1] < b[0] and a[2] < b[2] for a, b in zip(parts, parts[1:]))
    got = {r["t"]: (r["rn"], r["total"]) for r in _scan(df.where("k = 1"), 100).collect()}
    want = sorted(r[1] for r in rows if r[0] == 1)
    assert got == {t: (n + 1, n + 1.0) for n, t in enumerate(want)}


def test_operators_agree_on_a_hot_visit(spark):
    df = spark.createDataFrame(_rows(3), "visit_occurrence_id long, t long, v double").withColumn(
        "measurement_datetime", F.timestamp_add("HOUR", F.col("t"), F.lit("2024-01-01").cast("timestamp_ntz"))
    )

    def both(fn):
        plain, cut = fn(None), fn(15)
        assert sorted(map(str, plain.collect())) == sorted(map(str, cut.collect()))

    both(lambda m: reshape.sequence_numbers(df, min_rows=m))
    both(lambda m: impute.forward_fill(df, ["v"], limits={"v": 2}, min_rows=m))
    steps = df.withColumns({"state": F.col("t") % 3, "action": F.col("t") % 2, "died_in_hospital": F.lit(0)})
    both(lambda m: trajectory.terminal_reward(steps, min_rows=m))
    both(lambda m: trajectory.decision_transitions(steps, min_rows=m))
    rewarded = trajectory.terminal_reward(steps)
    both(lambda m: trajectory.transitions(rewarded, order=("measurement_datetime",), min_rows=m))
    right = df.where("v is not null and t % 3 = 0").select("visit_occurrence_id", F.col("measurement_datetime").alias("rt"), F.col("v").alias("rv"))
    both(lambda m: nearest.nearest_in_time(df, right, ["visit_occurrence_id"], "measurement_datetime", "rt", ["rv"], min_rows=m))
    logged = steps.select("visit_occurrence_id", F.col("t"), "state", "action", F.lit(1).alias("reward"), F.lit(0.5).alias("pscore"))
    policy = spark.createDataFrame([(s, a, 0.5) for s in range(3) for a in range(2)], "state long, action long, probability double")
    both(lambda m: ope.per_decision_sampling(logged, policy, min_rows=m))
