"""One run from windows to an evaluated policy, with all that is fitted taken from the training visits."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from icuriver.operators import actions, clean, impute, lloyd, mdp, ope, states, trajectory
from icuriver.operators.cohort import VISIT
from icuriver.operators.reshape import TIME
from icuriver.session import cut_lineage

TRAIN = "split = 'train'"


def fitted_rows(
    rows: DataFrame,
    features: Sequence[str],
    key: str,
    *,
    fluids: str,
    vasopressors: str,
    clusters: int,
    visit: str = VISIT,
    order: Sequence[str] = (TIME,),
    threshold: float = 0.30,
    seed: int = 42,
) -> DataFrame:
    """Windows with their split, state and action (D20, D18, D17, D14, F1, F2, E6 in turn).

    Fill limits, scaler, centres and action thresholds come from the training visits and are applied to
    all. Windows with too few features after the fill go; a feature still missing takes the training
    mean. ``key`` is unique for each row and decides the first centres. Rows without a visit take no
    part; fewer training windows than ``clusters`` raise.
    """
    rows = cut_lineage(rows.join(impute.split_visits(rows, visit=visit, seed=seed), visit))
    train = rows.where(TRAIN)
    limits = impute.gap_limits(train, features, [visit, *order])
    filled = impute.forward_fill(rows, features, limits=limits, keys=(visit,), order=order)
    filled = cut_lineage(clean.drop_sparse_rows(filled, features, threshold))
    scaled = clean.apply_scaler(filled, clean.fit_scaler(filled.where(TRAIN), features), features)
    scaled = cut_lineage(scaled.na.fill(0.0, subset=list(features)).withColumn("_x", F.array(*features)))
    centres = lloyd.fit_states(scaled.where(TRAIN).select("_x", key), "_x", key, clusters)
    thresholds = actions.action_thresholds(train, fluids, vasopressors)
    return actions.assign_actions(states.assign_nearest(scaled, centres, "_x"), thresholds, fluids, vasopressors).drop("_x")


def evaluated_policy(
    rows: DataFrame,
    *,
    on: str = "test",
    visit: str = VISIT,
    order: Sequence[str] = (TIME,),
    died: str = "died_in_hospital",
    sweeps: int = 100,
    rate: float = 0.1,
    discount: float = 0.99,
    epsilon: float = 0.3,
    gamma: float = 0.95,
) -> DataFrame:
    """(method, estimate) of the policy learned on the training visits, for the visits of another split.

    ``rows`` are those of :func:`fitted_rows`. The learned policy is epsilon-greedy on the Q-values of the
    training model; what it does in a state that training never saw counts as probability 0. The logged
    probabilities are those observed in the evaluated split, whose mean discounted return is ``observed``.
    """
    splits = rows.select(visit, "split").distinct()
    steps = trajectory.decision_transitions(rows, visit=visit, order=order, died=died)
    steps = cut_lineage(steps.join(splits, visit))
    model = cut_lineage(mdp.empirical_mdp(steps.where(TRAIN)))
    q = cut_lineage(mdp.q_values(model, sweeps=sweeps, rate=rate, discount=discount, cut_input=False))
    policy = cut_lineage(mdp.epsilon_greedy(mdp.greedy_policy(q, model), epsilon))
    held = steps.where(F.col("split") == on)
    seen = cut_lineage(mdp.observed_policy(held))
    logged = cut_lineage(trajectory.behaviour_probability(held, seen).withColumn("t", F.col("seq_id") - 1))
    returns = logged.groupBy(visit).agg(F.sum(F.pow(F.lit(gamma), F.col("t")) * F.col("reward")).alias("gain"))
    found = {
        "observed": returns.agg(F.avg("gain").alias("estimate")),
        "direct": ope.direct_method(logged, policy, q),
        "trajectory": ope.trajectory_sampling(logged, policy, discount=gamma, visit=visit),
        "per_decision": ope.per_decision_sampling(logged, policy, discount=gamma, visit=visit),
        "doubly_robust": ope.doubly_robust(logged, policy, q, discount=gamma, visit=visit),
    }
    named = [frame.select(F.lit(name).alias("method"), "estimate") for name, frame in found.items()]
    out = named[0]
    for frame in named[1:]:
        out = out.unionByName(frame)
    return out
