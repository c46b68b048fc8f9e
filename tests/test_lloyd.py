"""Rounds of k-means and backward steps against plain loops."""

import hashlib
import tracemalloc

import numpy as np
import pytest

from icuriver.operators import lloyd, mdp, stateblocks, states


def plain_lloyd(rows, k, tolerance=lloyd.TOLERANCE):
    ordered = sorted(rows, key=lambda r: (hashlib.md5(str(r[0]).encode()).hexdigest(), r[0]))
    x, centres = np.array([r[1] for r in rows], float), np.array([r[1] for r in ordered[:k]], float)
    for _ in range(lloyd.MAX_ROUNDS):
        label = ((x[:, None] - centres[None]) ** 2).sum(axis=2).argmin(axis=1)
        fresh = np.array([x[label == s].mean(axis=0) if (label == s).any() else c for s, c in enumerate(centres)])
        shift, centres = ((fresh - centres) ** 2).sum(), fresh
        if shift <= tolerance * x.var(axis=0).mean():
            break
    far = ((x[:, None] - centres[None]) ** 2).sum(axis=2)
    return centres, far.argmin(axis=1), far.min(axis=1).sum()


def made(seed, n, copies):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, 3)) + 5 * rng.integers(0, 3, (n, 1))
    x[:copies] = x[0]  # equal rows, several of them start as centres
    return [(k, [float(v) for v in row]) for k, row in enumerate(x)]


def test_all_sizes_equal_plain_rounds(spark):
    rows = made(1, 120, 30)
    df = spark.createDataFrame(rows, "id long, x array<double>").repartition(5)
    sizes = (1, 4, 9, 60, 120, 121)
    got = lloyd.fit_sizes(df, "x", "id", sizes)
    assert sorted(got) == [1, 4, 9, 60, 120]  # more clusters than rows are left out
    sweep = {r.cluster_size: r for r in lloyd.sweep_sizes(df, "x", "id", sizes).collect()}
    for k, centres in got.items():
        want, label, cost = plain_lloyd(rows, k)
        assert np.allclose(centres, want, atol=1e-9)
        assert sweep[k].wss == pytest.approx(cost, abs=1e-9)
        assert sweep[k].aic == pytest.approx(2 * (3 * k + k) + cost) and sweep[k].bic == pytest.approx((3 * k + k) * np.log(120) + cost)
        frame = lloyd.fit_states(df, "x", "id", k)
        labels = {r.id: r.state for r in states.assign_nearest(df, frame, "x").collect()} if k == 9 else dict(enumerate(label))
        assert [labels[i] for i in range(120)] == label.tolist()


def test_missing_values_and_too_many_clusters_raise(spark):
    df = spark.createDataFrame([(1, [1.0, 2.0]), (2, [0.0, 1.0])], "id long, x array<double>")
    with pytest.raises(ValueError):
        lloyd.fit_states(df, "x", "id", 3)
    assert lloyd.fit_sizes(df.limit(0), "x", "id", [2]) == {} and lloyd.sweep_sizes(df.limit(0), "x", "id", [2]).count() == 0
    for wrong in ([1.0, None], [1.0, float("nan")], None, [1.0]):
        bad = spark.createDataFrame([(1, [1.0, 2.0]), (2, [0.0, 1.0]), (3, wrong)], "id long, x array<double>")
        with pytest.raises(Exception, match="vector|inhomogeneous"):
            lloyd.fit_sizes(bad, "x", "id", [1])


def test_nearest_by_products_is_nearest_by_differences():
    rng = np.random.default_rng(2)
    x = np.round(rng.normal(size=(500, 4)), 1) + 1e6  # rounding of the products is larger than the differences
    centres = np.concatenate((x[:40], x[:10]))
    at, far = lloyd.nearest_centres(x, centres)
    d = ((x[:, None] - centres[None]) ** 2).sum(axis=2)
    assert at.tolist() == d.argmin(axis=1).tolist() and np.allclose(far, d.min(axis=1))


def made_model(spark, seed=3, n=7, actions=3):
    rng, rows = np.random.default_rng(seed), []
    for s in range(n):
        for a in range(actions):
            if rng.random() < 0.8:
                ahead = rng.choice([-1, *range(n), 50], 3, replace=False)
                p, r = rng.dirichlet(np.ones(3)), float(rng.normal())
                rows += [(s, a, int(t), float(q), r) for t, q in zip(ahead, p, strict=True)]
    return rows, spark.createDataFrame(rows, "state int, action int, next_state int, probability double, expected_reward double")


def test_sweeps_in_blocks_equal_those_by_joins_and_plain_ones(spark, monkeypatch):
    rows, model = made_model(spark)
    pairs = {(s, a): r for s, a, _, _, r in rows}
    q = dict.fromkeys(pairs, 0.0)
    for _ in range(9):
        v = {s: max([x for (t, _), x in q.items() if t == s] + [0.0] * (sum(t == s for t, _ in q) < 3)) for s in {s for s, _ in q}}
        q = {k: x + 0.2 * (pairs[k] + 0.9 * sum(p * v.get(t, 0.0) for s, a, t, p, _ in rows if (s, a) == k and t != -1) - x) for k, x in q.items()}
    monkeypatch.setattr(stateblocks, "BLOCK_ROWS", 10)
    for most in (10, 0):
        monkeypatch.setattr(mdp, "MOST_STATES", most)
        got = {(r.state, r.action): r.q for r in mdp.q_values(model, sweeps=9, rate=0.2, discount=0.9, n_actions=3).collect()}
        assert got.keys() == q.keys() and all(got[k] == pytest.approx(q[k], abs=1e-12) for k in q)
    monkeypatch.setattr(mdp, "MOST_STATES", 10)
    settled = {(r.state, r.action): r.q for r in mdp.q_values(model, sweeps=400, rate=0.5, discount=0.9, n_actions=3, tolerance=1e-7).collect()}
    whole = {(r.state, r.action): r.q for r in mdp.q_values(model, sweeps=300, rate=0.5, discount=0.9, n_actions=3).collect()}
    assert all(settled[k] == pytest.approx(whole[k], abs=1e-4) for k in whole)


def test_policy_value_in_blocks_equals_that_by_joins(spark, monkeypatch):
    rows, model = made_model(spark, seed=5)
    policy = spark.createDataFrame(sorted({(s, a, 0.4 if a else 0.2) for s, a, *_ in rows}), "state int, action int, probability double")
    got = []
    for most in (10, 0):
        monkeypatch.setattr(mdp, "MOST_STATES", most)
        got.append(mdp.policy_value(policy, model, steps=6).first())
    assert got[0].mean_return == pytest.approx(got[1].mean_return) and got[0].std_return == pytest.approx(got[1].std_return)
    assert mdp.policy_value(policy.limit(0), model.limit(0), steps=2).count() == 1


def test_distances_held_at_once_fit_a_cache_and_equal_centres_count_once():
    """A round wrote 16 MB of distances at a time, and a row between equal centres was measured by itself."""
    rng = np.random.default_rng(9)
    x = rng.normal(size=(5000, 4))
    centres = np.concatenate((x[:200], x[:200]))
    tracemalloc.start()
    at, far = lloyd.nearest_centres(x, centres)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    d = ((x[:, None] - centres[None]) ** 2).sum(axis=2)
    assert at.tolist() == d.argmin(axis=1).tolist() and np.allclose(far, d.min(axis=1))
    assert peak < 4 << 20
