import itertools
import math

import numpy as np
import pandas as pd
import pytest
from pyspark.ml.clustering import KMeans
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tests.rows import as_set
from icuriver.operators import actions, mdp, ope, states, timejoin, trajectory

V, TS = "visit_occurrence_id", "measurement_datetime"


def _windows(frame):
    return frame([(1, "2024-01-01 00:00:00"), (1, "2024-01-01 12:00:00"), (1, "2024-01-02 00:00:00"), (2, "2024-01-01 12:00:00")],
                 f"{V} long, {TS} timestamp_ntz")


def test_overlap_mean(frame):
    inf = frame(
        [(1, "2024-01-01 06:00:00", "2024-01-01 18:00:00", 2.0), (1, "2024-01-01 11:00:00", "2024-01-01 12:00:00", 8.0),
         (1, "2023-12-31 00:00:00", "2024-01-01 00:00:00", 50.0), (2, "2024-01-01 00:00:00", "2024-01-09 00:00:00", 3.0),
         (3, "2024-01-01 00:00:00", "2024-01-02 00:00:00", 9.0)],
        f"{V} long, start_datetime timestamp_ntz, stop_datetime timestamp_ntz, equiv_gamma double",
    )
    out = timejoin.window_overlap_mean(_windows(frame), inf)
    assert sorted((r[V], r[TS].day, r[TS].hour, round(r["average_gamma"], 6)) for r in out.collect()) == [
        (1, 1, 0, round((2 * 6 + 8) / 7, 6)), (1, 1, 12, 2.0), (1, 2, 0, 0.0), (2, 1, 12, 3.0)]


def test_range_sum_counts_border_twice(frame):
    values = frame([(1, "2024-01-01 12:00:00", 1.0), (1, "2024-01-01 03:00:00", 10.0), (1, "2024-01-02 12:00:00", 100.0), (2, "2024-01-01 03:00:00", 5.0)],
                   f"{V} long, {TS} timestamp_ntz, value_as_number double")
    out = timejoin.window_range_sum(_windows(frame), values)
    assert sorted((r[V], r[TS].day, r[TS].hour, r["fluid_intake_sum"]) for r in out.collect()) == [
        (1, 1, 0, 11.0), (1, 1, 12, 1.0), (1, 2, 0, 100.0), (2, 1, 12, 0.0)]


def test_windows_off_the_grid_are_an_error(frame):
    w = frame([(1, "2024-01-01 00:00:00"), (1, "2024-01-01 05:00:00")], f"{V} long, {TS} timestamp_ntz")
    values = frame([(1, "2024-01-01 03:00:00", 1.0)], f"{V} long, {TS} timestamp_ntz, value_as_number double")
    with pytest.raises(PySparkException, match="one grid"):
        timejoin.window_range_sum(w, values).collect()
    assert timejoin.window_bounds(w).first()["window_end"].hour == 12


def test_doses_and_bands(spark):
    df = spark.createDataFrame([("Norepinephrine x", 2.0), ("DOPAMINE", 2.0), ("dobutamine", 1.0)], "item string, gamma double")
    assert [r["equiv_gamma"] for r in actions.equivalent_dose(df).collect()] == [2.0, 0.02, 0.01]
    with pytest.raises(PySparkException, match="unknown drug"):
        actions.equivalent_dose(spark.createDataFrame([("water", 1.0)], "item string, gamma double")).collect()
    bands = spark.createDataFrame([(x,) for x in [0.0, 0.01, 0.02, 0.02, 0.03, 0.03, 0.08, 0.1, 0.5]], "equiv_gamma double")
    got = {r["band"]: (round(r["mode_dose"], 6), round(r["share"], 6)) for r in actions.dose_bands(bands).collect()}
    assert got == {"]0-0.08]": (0.025, round(6 / 9, 6)), "]0.08-0.22]": (0.1, round(1 / 9, 6)), ">0.45": (0.5, round(1 / 9, 6))}


def test_actions(spark):
    df = spark.createDataFrame([(0.0, 0.0), (1.0, 0.0), (2.0, 5.0), (3.0, 6.0), (-1.0, 7.0), (None, 6.0)], "f double, v double")
    th = actions.action_thresholds(df, "f", "v")
    assert th.first().asDict() == {"fluid": 1.5, "vasopressor": 6.0}
    coded = actions.assign_actions(df, th, "f", "v")
    assert [r["action"] for r in coded.collect()] == [0, 3, 7, 7, 2, 1]
    assert actions.action_labels(th).first()["fluid"] == ["0", "(0-1.50]", "> 1.50"]
    grid = actions.action_grid(coded).orderBy("fluid", "vasopressor").collect()
    assert [r["count"] for r in grid] == [1, 1, 1, 1, 0, 0, 0, 2, 0] and sum(r["share"] for r in grid) == pytest.approx(1)
    with pytest.raises(PySparkException, match="0..8"):
        actions.action_grid(spark.createDataFrame([(9,)], "action int")).collect()
    shares = actions.outcome_share(spark.createDataFrame([(1,), (0,), (0,), (0,)], "died_in_hospital int"))
    assert as_set(shares, "died_in_hospital", "percentage") == [(0, 75.0), (1, 25.0)]


@pytest.fixture
def steps(spark):
    rows = [(1, 1, 0, 1, 0), (1, 2, 1, 0, 0), (1, 3, 0, 1, 0), (2, 1, 1, 1, 1), (3, 1, 0, 1, 0), (3, 2, 0, 1, 0)]
    return spark.createDataFrame(rows, f"{V} long, seq_id long, state int, action int, died_in_hospital int")


def test_trajectory(spark, steps):
    t = trajectory.transitions(trajectory.terminal_reward(steps, order=("seq_id",)))
    want = [(1, 1, 0, 1, 0, 1, 0), (1, 2, 1, 0, 0, 0, 0), (1, 3, 0, 1, 100, -1, 1), (2, 1, 1, 1, -100, -1, 1), (3, 1, 0, 1, 0, 0, 0), (3, 2, 0, 1, 100, -1, 1)]
    columns = (V, "seq_id", "state", "action", "reward", "next_state", "done")
    assert as_set(t, *columns) == want
    renumbered = steps.withColumnRenamed("seq_id", "order_in_visit")
    assert as_set(trajectory.decision_transitions(renumbered, order=("order_in_visit",)), *columns) == want
    assert trajectory.longest_trajectory(t).first()[0] == 3
    # literal ids: first visit 2 rows, then 1 + 0, 1 + 1, and the last terminal row alone
    assert trajectory.longest_by_done(t).first()[0] == 2
    padded = trajectory.pad_trajectories(t)
    assert padded.count() == 9
    pad = padded.where("reward is null")
    assert as_set(pad, V, "seq_id", "state", "action", "done") == [(2, 2, 0, 0, 1), (2, 3, 0, 0, 1), (3, 3, 0, 0, 1)]
    policy = mdp.observed_policy(t)
    rows, meta = trajectory.logged_dataset(padded, policy)
    assert meta.first()["size"] == 9 and meta.first()["step_per_trajectory"] == 3
    # state 0 never took action 0: padding has propensity 0
    assert as_set(rows.where("reward is null"), "pscore") == [(0.0,)] * 3
    wide = trajectory.behaviour_distribution(t, policy).where("state = 1").first()
    assert (wide["p0"], wide["p1"], wide["p8"]) == (0.5, 0.5, 0.0)


def test_model(spark, steps):
    t = trajectory.decision_transitions(steps, order=("seq_id",), seq="n").drop("n")
    model = mdp.empirical_mdp(t)
    sums = model.groupBy("state", "action").agg(F.sum("probability").alias("p")).collect()
    assert all(r["p"] == pytest.approx(1) for r in sums)
    assert as_set(model.where("state = 0 and action = 1"), "next_state", "count", "expected_reward") == [(-1, 2, 50.0), (0, 1, 50.0), (1, 1, 50.0)]
    opened = t.withColumn("next_state", F.when(F.col("done") == 0, F.col("next_state")))
    assert as_set(mdp.transition_probabilities(opened).where("state = 0"), "next_state", "total_count") == [(0, 4), (1, 4)]
    assert as_set(mdp.expected_reward(t), "state", "action", "expected_reward") == [(0, 1, 50.0), (1, 0, 0.0), (1, 1, -100.0)]


def _toy(spark):
    """Three states, two actions, some transitions missing."""
    rows = [(0, 0, 1, 0.5, 1.0), (0, 0, -1, 0.5, 1.0), (0, 1, 2, 1.0, -2.0), (1, 0, 0, 0.3, 4.0), (1, 0, 2, 0.7, 4.0), (2, 1, -1, 1.0, 10.0)]
    return rows, spark.createDataFrame(rows, "state int, action int, next_state int, probability double, expected_reward double")


def test_q_values_equal_plain_loop(spark):
    rows, model = _toy(spark)
    q = np.zeros((3, 9))
    for _ in range(7):
        new = q.copy()
        for s, a in {(r[0], r[1]) for r in rows}:
            mine = [r for r in rows if r[:2] == (s, a)]
            ahead = sum(r[3] * (q[r[2]].max() if r[2] >= 0 else 0) for r in mine)
            new[s, a] += 0.1 * (mine[0][4] + 0.9 * ahead - q[s, a])
        q = new
    got = mdp.q_values(model, sweeps=7, rate=0.1, discount=0.9)
    for r in got.collect():
        assert r["q"] == pytest.approx(q[r["state"], r["action"]])
    greedy = mdp.greedy_policy(got, spark.createDataFrame([(0,), (1,), (2,), (5,)], "state int"))
    assert as_set(greedy, "state", "action") == [(0, 0), (1, 0), (2, 1), (5, 0)]
    soft = mdp.softmax_policy(got, model)
    assert all(r["s"] == pytest.approx(1) for r in soft.groupBy("state").agg(F.sum("probability").alias("s")).collect())
    even = mdp.epsilon_greedy(greedy, 1.0)
    assert all(r["probability"] == pytest.approx(1 / 9) for r in even.collect())
    matrix = mdp.alignment_matrix(spark.createDataFrame([(0, 0, 0.5), (0, 1, 0.5), (2, 1, 1.0)], "state int, action int, probability double"), greedy)
    assert as_set(matrix.where("count > 0"), "observed_action", "model_action", "share") == [(0, 0, 1.0), (1, 1, 1.0)] and matrix.count() == 81
    freq = mdp.action_frequencies(mdp.attach_best_action(spark.createDataFrame([(0, 3), (2, 3)], "state int, action int"), greedy), ["action", "best_action"])
    assert as_set(freq.where("count > 0"), "policy", "action", "count") == [("action", 3, 2), ("best_action", 0, 1), ("best_action", 1, 1)]


def _enumerate(rows, policy, horizon):
    """All paths with their probabilities."""
    returns = []

    def walk(s, p, total, left):
        acts = [(a, w) for a, w in policy.get(s, {}).items()]
        if left == 0 or s < 0 or not acts:
            returns.append((p, total))
            return
        for a, w in acts:
            moves = [r for r in rows if r[:2] == (s, a)]
            if not moves:
                returns.append((p * w, total))
            for r in moves:
                walk(r[2], p * w * r[3], total + r[4], left - 1)

    starts = sorted({r[0] for r in rows})
    for s in starts:
        walk(s, 1 / len(starts), 0.0, horizon)
    mean = sum(p * g for p, g in returns)
    return mean, math.sqrt(sum(p * g * g for p, g in returns) - mean**2)


@pytest.mark.parametrize("policy", [
    {0: {0: 1.0}, 1: {0: 1.0}, 2: {0: 1.0}},
    {0: {0: 0.4, 1: 0.6}, 1: {0: 1.0}, 2: {1: 1.0}},
])
def test_policy_value_equals_enumeration(spark, policy):
    rows, model = _toy(spark)
    table = spark.createDataFrame([(s, a, w) for s, p in policy.items() for a, w in p.items()], "state int, action int, probability double")
    got = mdp.policy_value(table, model, steps=5).first()
    mean, std = _enumerate(rows, policy, 5)
    assert got["mean_return"] == pytest.approx(mean) and got["std_return"] == pytest.approx(std)


def test_estimators_equal_plain_sums(spark):
    rng = np.random.default_rng(5)
    pi = {(s, a): p for s in range(3) for a, p in enumerate([0.0, 0.3, 0.7])}
    q = {(s, a): float(rng.normal()) for s in range(3) for a in range(3)}
    rows, want = [], {"tis": [], "pdis": [], "dr": [], "dm": []}
    value = {s: sum(pi[s, a] * q[s, a] for a in range(3)) for s in range(3)}
    for visit in range(20):
        w, parts, gains = 1.0, [0.0, 0.0], 0.0
        undefined = visit == 3
        for t in range(int(rng.integers(1, 5))):
            s, a, r = int(rng.integers(0, 3)), int(rng.integers(0, 3)), float(rng.normal())
            b = 0.0 if undefined and t == 0 else float(rng.uniform(0.2, 0.9))
            rows.append((visit, t, s, a, r, b))
            before, w = w, w * (pi[s, a] / b if b else 0)
            g = 0.9**t
            gains += g * r
            parts[0] += g * w * r
            parts[1] += g * (w * (r - q[s, a]) + before * value[s])
            if t == 0:
                want["dm"].append(value[s])
        if not undefined:
            want["tis"].append(w * gains)
            want["pdis"].append(parts[0])
            want["dr"].append(parts[1])
    logged = spark.createDataFrame(rows, f"{V} long, t long, state int, action int, reward double, pscore double")
    policy = spark.createDataFrame([(s, a, p) for (s, a), p in pi.items()], "state int, action int, probability double")
    table = spark.createDataFrame([(s, a, v) for (s, a), v in q.items()], "state int, action int, q double")
    assert ope.direct_method(logged, policy, table).first()[0] == pytest.approx(np.mean(want["dm"]))
    for name, got in (
        ("tis", ope.trajectory_sampling(logged, policy, discount=0.9)),
        ("pdis", ope.per_decision_sampling(logged, policy, discount=0.9)),
        ("dr", ope.doubly_robust(logged, policy, table, discount=0.9)),
    ):
        row = got.first()
        assert row["estimate"] == pytest.approx(np.mean(want[name])) and row["undefined_trajectories"] == 1


def test_states(spark):
    rng = np.random.default_rng(2)
    x = np.vstack([rng.normal(size=(30, 3)) * 0.1 + c for c in ([0, 0, 0], [5, 5, 5], [-5, 5, 0])])
    df = spark.createDataFrame([(i, *map(float, r)) for i, r in enumerate(x)], "id long, a double, b double, c double")
    cols = ["a", "b", "c"]
    vectors = states.as_vectors(df, cols).cache()
    model = states.fit_kmeans(vectors, 3)
    centres = states.centres_frame(df, model)
    both = states.assign_nearest(model.transform(vectors).withColumn("x", states.feature_array(cols)), centres, "x", "again")
    assert both.where("state <> again").count() == 0
    assert {r["size"] for r in states.cluster_means(both, cols).collect()} == {30}
    truth = both.withColumn("truth", F.floor(F.col("id") / 30))
    assert states.labeling_agreement(truth, "state", "truth").first().asDict() == pytest.approx({"nmi": 1.0, "ari": 1.0})
    sweep = states.evaluate_sizes(vectors, 3, sizes=(2, 3)).orderBy("cluster_size").collect()
    assert sweep[0]["wss"] > sweep[1]["wss"] and sweep[1]["aic"] == pytest.approx(2 * 12 + sweep[1]["wss"])
    assert sweep[1]["bic"] == pytest.approx(12 * math.log(90) + sweep[1]["wss"])
    # projections of centred data keep the total variance when no dimension is dropped
    p = states.principal_components(df, cols, 3, keep=["id"]).toPandas()
    assert p[["pca_1", "pca_2", "pca_3"]].var().sum() == pytest.approx(np.var(x, axis=0, ddof=1).sum())
    soft = states.soft_assignment(df.withColumn("x", states.feature_array(cols)), centres, "x")
    assert soft.select(F.aggregate("weights", F.lit(0.0), lambda s, w: s + w)).first()[0] == pytest.approx(1, abs=1e-6)
    rows, embedded_centres = states.embed_and_cluster(df, cols, dims=3, k=3, keep=["id"])
    loss = states.clustering_loss(rows, embedded_centres, "embedding", original="original", rebuilt="rebuilt").first()
    assert loss["loss_reconstruction"] == pytest.approx(0, abs=1e-12) and loss["loss"] == pytest.approx(loss["loss_clustering"])
    with pytest.raises(ValueError):
        states.as_vectors(df.withColumn("t", F.lit("x")), ["a", "t"])
    with pytest.raises(Exception):
        states.as_vectors(spark.createDataFrame([(None,)], "a double"), ["a"]).collect()


def test_rounds_of_kmeans_have_few_tasks(spark):
    """a round's tasks follow neither the clusters nor the partitions of the table."""
    most = states.ROUND_TASKS * spark.sparkContext.defaultParallelism
    dims, k = 64, 130  # k * k * dims is above a million
    x = np.random.default_rng(5).normal(size=(300, dims))
    df = spark.createDataFrame([(i, *map(float, r)) for i, r in enumerate(x)], "id long, " + ", ".join(f"x{i} double" for i in range(dims)))
    split = df.repartition(3 * most)
    few, alike = states.few_parts(split), states.few_parts(df)
    assert few.rdd.getNumPartitions() == most and alike.rdd.getNumPartitions() == df.rdd.getNumPartitions()
    assert sorted(few.collect()) == sorted(df.collect()) and alike.collect() == df.collect()
    vectors = states.as_vectors(few, [f"x{i}" for i in range(dims)]).cache()
    tracker, group = spark.sparkContext.statusTracker(), "rounds-of-kmeans"
    vectors.count()
    spark.sparkContext.setJobGroup(group, group)
    try:
        model = states.fit_kmeans(vectors, k, max_iter=3)
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    stages = [tracker.getStageInfo(s) for j in tracker.getJobIdsForGroup(group) for s in tracker.getJobInfo(j).stageIds]
    assert stages and max(s.numTasks for s in stages if s is not None) <= most
    # the row solver's centres
    rows = KMeans(k=k, seed=42, initMode="k-means||", featuresCol="features", maxIter=3, solver="row").fit(vectors)
    np.testing.assert_allclose(model.clusterCenters(), rows.clusterCenters(), rtol=0, atol=1e-9)


def test_random_labelings_and_trials(spark):
    rng = np.random.default_rng(7)
    pairs = [(int(a), int(b)) for a, b in zip(rng.integers(0, 3, 200), rng.integers(0, 4, 200))]
    got = states.labeling_agreement(spark.createDataFrame(pairs, "a int, b int"), "a", "b").first()
    same = lambda k: [x == y for x, y in itertools.combinations([p[k] for p in pairs], 2)]
    sa, sb = np.array(same(0)), np.array(same(1))
    expected = sa.sum() * sb.sum() / len(sa)
    assert got["ari"] == pytest.approx(((sa & sb).sum() - expected) / ((sa.sum() + sb.sum()) / 2 - expected))
    trials = spark.createDataFrame([(0, 0.5, "x"), (1, 0.2, "y"), (2, 0.4, "y"), (3, None, "x")], "number int, value double, p string")
    assert states.best_trial(trials).first()["number"] == 1
    assert as_set(states.trial_leaderboard(trials, ["p"]), "setting", "best", "trials") == [("x", 0.5, 1), ("y", 0.2, 2)]


def test_nearest_centre_in_blocks(monkeypatch):
    rng = np.random.default_rng(3)
    x, centres = rng.integers(0, 3, (50, 2)).astype(float), rng.integers(0, 3, (23, 2)).astype(float)
    whole = ((x[:, None] - centres) ** 2).sum(axis=2)
    monkeypatch.setattr(states, "BLOCK", 5)
    place, least = states._nearest(x, centres)
    assert (place == whole.argmin(axis=1)).all() and (least == whole.min(axis=1)).all()
    rows = [row for part in states._row_slices(pd.Series(list(x)), 2) for row in part]
    assert np.array_equal(rows, x)
