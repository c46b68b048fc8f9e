"""Empirical decision model, policies, Q-values, exact policy value.

Model tables have at most states x actions (x states) rows whatever the size of the
logged data, so the iterative operators run on the reduced tables only.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from icuriver.operators.actions import N_ACTIONS
from icuriver.operators.stateblocks import MOST_STATES, Block, StateBlocks, Step
from icuriver.operators.trajectory import TERMINAL
from icuriver.session import broadcast_if_small, cut_lineage

PAIR = ["state", "action"]
SWEEPS_PER_CHECKPOINT = 2


def transition_probabilities(transitions: DataFrame) -> DataFrame:
    """P(next | state, action) from counts (G1).

    Missing next states are not listed but stay in the total.
    """
    known = transitions.dropna(subset=PAIR)
    counts = known.groupBy(*PAIR, "next_state").agg(F.count(F.lit(1)).alias("count"))
    totals = counts.groupBy(*PAIR).agg(F.sum("count").alias("total_count"))
    return (
        counts.where(F.col("next_state").isNotNull())
        .join(totals, PAIR)
        .withColumn("probability", F.col("count") / F.col("total_count"))
    )


def expected_reward(transitions: DataFrame) -> DataFrame:
    return transitions.dropna(subset=PAIR).groupBy(*PAIR).agg(F.avg("reward").alias("expected_reward"))


def empirical_mdp(transitions: DataFrame) -> DataFrame:
    """Probabilities and mean rewards from one reduction of the logged steps."""
    reduced = transitions.dropna(subset=PAIR).groupBy(*PAIR, "next_state").agg(
        F.count(F.lit(1)).alias("count"),
        F.sum("reward").alias("_reward"),
        F.count("reward").alias("_rewarded"),
    )
    totals = reduced.groupBy(*PAIR).agg(
        F.sum("count").alias("total_count"),
        F.try_divide(F.sum("_reward"), F.sum("_rewarded")).alias("expected_reward"),
    )
    return (
        reduced.where(F.col("next_state").isNotNull())
        .join(totals, PAIR)
        .select(
            *PAIR, "next_state", "count", "total_count",
            (F.col("count") / F.col("total_count")).alias("probability"), "expected_reward",
        )
    )


def observed_policy(transitions: DataFrame) -> DataFrame:
    """Share of each action within its state."""
    counts = transitions.dropna(subset=PAIR).groupBy(*PAIR).agg(F.count(F.lit(1)).alias("count"))
    totals = counts.groupBy("state").agg(F.sum("count").alias("total_count"))
    return counts.join(totals, "state").select(
        *PAIR, "count", "total_count", (F.col("count") / F.col("total_count")).alias("probability")
    )


def state_values(q: DataFrame, n_actions: int = N_ACTIONS) -> DataFrame:
    """Best Q per state of a sparse table whose unlisted actions are worth 0."""
    best = F.max("q")
    return q.groupBy("state").agg(
        F.when(F.count(F.lit(1)) < n_actions, F.greatest(best, F.lit(0.0))).otherwise(best).alias("v")
    )


def q_values(
    mdp: DataFrame,
    *,
    sweeps: int,
    rate: float = 0.1,
    discount: float = 0.99,
    n_actions: int = N_ACTIONS,
    tolerance: float | None = None,
    checkpoint_every: int = SWEEPS_PER_CHECKPOINT,
    cut_input: bool = True,
) -> DataFrame:
    """Synchronous expected Q updates over the empirical model (G5), rows (state, action, q).

    Q <- Q + rate * (reward + discount * sum P * max Q(next) - Q), starting from zero; a terminal next
    state is worth 0. Since a Q-value is its reward and its next states' values, each weighted by age,
    only the sum of values by age passes from sweep to sweep: one number a state. With ``tolerance`` the
    sweeps end when no state's value changes by more. A model of more than MOST_STATES states is swept
    by joins, its lineage cut every few sweeps and once before them unless it is already materialised
    (``cut_input=False``).
    """
    mdp = mdp.select(*PAIR, "next_state", "probability", "expected_reward")
    if cut_input:
        mdp = cut_lineage(mdp)
    if mdp.select("state").distinct().count() > MOST_STATES:
        return _q_values_joined(mdp, sweeps, rate, discount, n_actions, checkpoint_every)

    def pairs(block: Block, ahead: np.ndarray, sweep: int) -> tuple[np.ndarray, np.ndarray]:
        known = np.where(block.columns["next_state"] == TERMINAL, 0.0, ahead[0][block.next])
        worth = block.by_pair(block.columns["probability"] * known)
        return block.columns["expected_reward"][block.pair] * (1 - (1 - rate) ** sweep) + rate * discount * worth, block.pair

    def values(sweep: int) -> Step:
        def step(block: Block, ahead: np.ndarray) -> dict[str, np.ndarray]:
            q, _ = pairs(block, ahead, sweep)
            best = np.maximum.reduceat(q, block.pairs_from)
            unlisted = np.diff(np.append(block.pairs_from, len(q))) < n_actions
            return {"state": block.columns["state"][block.state], "v": np.where(unlisted, np.maximum(best, 0), best)}

        return step

    def table(sweep: int) -> Step:
        def step(block: Block, ahead: np.ndarray) -> dict[str, np.ndarray]:
            q, at = pairs(block, ahead, sweep)
            return {"state": block.columns["state"][at], "action": block.columns["action"][at], "q": q}

        return step

    blocks = StateBlocks(mdp, ["v"])
    aged = last = np.zeros((1, len(blocks.states)))
    done = 0
    while done < sweeps:
        # values before this sweep; before the first all are 0
        now = blocks.step(values(done), aged) if done else last
        if tolerance is not None and done > 1 and np.abs(now - last).max(initial=0) <= tolerance:
            break
        aged, last, done = (1 - rate) * aged + now, now, done + 1
    kinds = {f.name: f.dataType for f in mdp.schema.fields}
    out = blocks.run(table(done), aged, "state long, action long, q double")
    return out.select(*[F.col(c).cast(kinds[c]) for c in PAIR], "q")


def _q_values_joined(mdp: DataFrame, sweeps: int, rate: float, discount: float, n_actions: int, checkpoint_every: int) -> DataFrame:
    moves = mdp.where(F.col("next_state") != TERMINAL)
    q = mdp.select(*PAIR, "expected_reward").distinct().withColumn("q", F.lit(0.0))
    for sweep in range(1, sweeps + 1):
        values = state_values(q, n_actions).withColumnRenamed("state", "next_state")
        ahead = (
            moves.join(values, "next_state")
            .groupBy(*PAIR)
            .agg(F.sum(F.col("probability") * F.col("v")).alias("ahead"))
        )
        target = F.col("expected_reward") + discount * F.coalesce("ahead", F.lit(0.0))
        q = q.join(ahead, PAIR, "left").select(
            *PAIR, "expected_reward", (F.col("q") + rate * (target - F.col("q"))).alias("q")
        )
        if sweep % checkpoint_every == 0 and sweep < sweeps:
            q = cut_lineage(q)
    return q.select(*PAIR, "q")


def dense_q(q: DataFrame, states: DataFrame, n_actions: int = N_ACTIONS) -> DataFrame:
    """Every state with every action, 0 where nothing was learned."""
    spine = states.select("state").distinct().withColumn(
        "action", F.explode(F.array(*[F.lit(a) for a in range(n_actions)]))
    )
    return spine.join(q.select(*PAIR, "q"), PAIR, "left").withColumn("q", F.coalesce("q", F.lit(0.0)))


def greedy_policy(q: DataFrame, states: DataFrame, n_actions: int = N_ACTIONS) -> DataFrame:
    """Best action per state; ties and unseen states go to the lowest action."""
    return (
        dense_q(q, states, n_actions)
        .groupBy("state")
        .agg(F.max_by("action", F.struct("q", -F.col("action"))).alias("action"))
    )


def attach_best_action(steps: DataFrame, greedy: DataFrame, out: str = "best_action") -> DataFrame:
    """Greedy action of each step's state."""
    return steps.join(broadcast_if_small(greedy.select("state", F.col("action").alias(out))), "state", "left")


def action_frequencies(steps: DataFrame, columns: list[str], n_actions: int = N_ACTIONS) -> DataFrame:
    """Counts of each action under several columns, zeros included."""
    picks = F.array(*[F.struct(F.lit(c).alias("policy"), F.col(c).cast("long").alias("action")) for c in columns])
    counts = steps.select(F.explode(picks).alias("p")).groupBy("p.policy", "p.action").agg(
        F.count(F.lit(1)).alias("n")
    )
    spine = steps.sparkSession.range(n_actions).select(
        F.explode(F.array(*[F.lit(c) for c in columns])).alias("policy"), F.col("id").alias("action")
    )
    # policies x actions rows
    return spine.join(F.broadcast(counts), ["policy", "action"], "left").select(
        "policy", "action", F.coalesce("n", F.lit(0)).cast("long").alias("count")
    )


def as_stochastic(policy: DataFrame) -> DataFrame:
    """A (state, action) policy as probabilities of 1."""
    return policy if "probability" in policy.columns else policy.withColumn("probability", F.lit(1.0))


def policy_value(
    policy: DataFrame,
    mdp: DataFrame,
    *,
    steps: int = 100,
    checkpoint_every: int = SWEEPS_PER_CHECKPOINT,
    cut_input: bool = True,
) -> DataFrame:
    """Exact mean and deviation of the undiscounted return over at most ``steps`` steps.

    Starts uniformly over the model's states and stops when the chosen (state, action)
    is not in the model or the state is terminal. First and second moments obey the
    same backward recursion, so no episode is sampled. A step passes on two numbers a state; a model of
    more than MOST_STATES states is stepped by joins.
    """
    mdp = mdp.select(*PAIR, "next_state", "probability", "expected_reward")
    if cut_input:
        mdp = cut_lineage(mdp)
    starts = mdp.select("state").distinct()
    taken = as_stochastic(policy).select(*PAIR, F.col("probability").alias("pi"))
    moves = cut_lineage(mdp.join(taken, PAIR))
    if starts.count() > MOST_STATES:
        return _policy_value_joined(moves, starts, steps, checkpoint_every)

    def back(block: Block, ahead: np.ndarray) -> dict[str, np.ndarray]:
        r, w = block.columns["expected_reward"], block.columns["pi"] * block.columns["probability"]
        m1, m2 = ahead[:, block.next]
        return {"state": block.columns["state"][block.state], "m1": block.by_state(w * (r + m1)), "m2": block.by_state(w * (r * r + 2 * r * m1 + m2))}

    blocks = StateBlocks(moves, ["m1", "m2"], starts)
    now = np.zeros((2, len(blocks.states)))
    for _ in range(steps):
        now = blocks.step(back, now)
    spark = moves.sparkSession
    if not len(blocks.states):
        return spark.createDataFrame([(None, None)], "mean_return double, std_return double")
    mean, second = now.mean(axis=1).tolist()
    return spark.createDataFrame([(mean, float(np.sqrt(max(0.0, second - mean * mean))))], "mean_return double, std_return double")


def _policy_value_joined(moves: DataFrame, starts: DataFrame, steps: int, checkpoint_every: int) -> DataFrame:
    none = F.lit(0.0)
    value = starts.select("state", none.alias("m1"), none.alias("m2"))
    r, w = F.col("expected_reward"), F.col("pi") * F.col("probability")
    for step in range(1, steps + 1):
        ahead = value.select(F.col("state").alias("next_state"), "m1", "m2")
        m1, m2 = F.coalesce("m1", none), F.coalesce("m2", none)
        moved = (
            moves.join(ahead, "next_state", "left")
            .groupBy("state")
            .agg(F.sum(w * (r + m1)).alias("m1"), F.sum(w * (r * r + 2 * r * m1 + m2)).alias("m2"))
        )
        value = moved
        if step % checkpoint_every == 0 and step < steps:
            value = cut_lineage(value)
    mean, second = F.avg(F.coalesce("m1", none)), F.avg(F.coalesce("m2", none))
    return starts.join(value, "state", "left").agg(
        mean.alias("mean_return"), F.sqrt(F.greatest(second - mean * mean, none)).alias("std_return")
    )


def alignment_matrix(policy: DataFrame, greedy: DataFrame, n_actions: int = N_ACTIONS) -> DataFrame:
    """States by most probable observed action and greedy action, rows normalised."""
    usual = policy.groupBy("state").agg(
        F.max_by("action", F.struct("probability", -F.col("action"))).alias("observed_action")
    )
    counts = (
        usual.join(greedy.select("state", F.col("action").alias("model_action")), "state")
        .groupBy(F.col("observed_action").cast("long"), F.col("model_action").cast("long"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    spine = policy.sparkSession.range(n_actions).select(
        F.col("id").alias("observed_action"),
        F.explode(F.array(*[F.lit(a).cast("long") for a in range(n_actions)])).alias("model_action"),
    )
    rows = counts.groupBy("observed_action").agg(F.sum("n").alias("row_total"))
    # n_actions squared rows
    return (
        spine.join(F.broadcast(counts), ["observed_action", "model_action"], "left")
        .join(F.broadcast(rows), "observed_action", "left")
        .select(
            "observed_action", "model_action",
            F.coalesce("n", F.lit(0)).cast("long").alias("count"),
            F.coalesce(F.col("n") / F.col("row_total"), F.lit(0.0)).alias("share"),
        )
    )


def softmax_policy(q: DataFrame, states: DataFrame, temperature: float = 1.0, n_actions: int = N_ACTIONS) -> DataFrame:
    """Softmax of a state's Q-values, shifted by their maximum."""
    dense = dense_q(q, states, n_actions)
    top = dense.groupBy("state").agg(F.max("q").alias("_top"))
    powers = dense.join(top, "state").withColumn("_e", F.exp((F.col("q") - F.col("_top")) / temperature))
    sums = powers.groupBy("state").agg(F.sum("_e").alias("_sum"))
    return powers.join(sums, "state").select(*PAIR, (F.col("_e") / F.col("_sum")).alias("probability"))


def epsilon_greedy(greedy: DataFrame, epsilon: float, n_actions: int = N_ACTIONS) -> DataFrame:
    """(1 - epsilon) on the greedy action plus epsilon spread evenly."""
    best: Column = F.col("_best")
    return (
        greedy.select("state", F.col("action").alias("_best"))
        .withColumn("action", F.explode(F.array(*[F.lit(a) for a in range(n_actions)])))
        .select(
            *PAIR,
            (F.when(best == F.col("action"), 1 - epsilon).otherwise(0.0) + F.lit(epsilon / n_actions)).alias("probability"),
        )
    )
