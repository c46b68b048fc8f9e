"""Off-policy estimators on logged trajectories.

``logged`` has one row per real step (padding excluded) with visit, ``t`` counted
from 0, state, action, reward and the behaviour probability ``pscore``. A visit with
a step of behaviour probability 0 has no defined ratio: it is left out and counted.
A target probability of 0 makes the weight 0 from that step on.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from icuriver.functions.ordered import ordered_scan
from icuriver.operators.cohort import VISIT
from icuriver.operators.mdp import PAIR
from icuriver.session import broadcast_if_small


def action_values(policy: DataFrame, q: DataFrame) -> DataFrame:
    """V(state) = sum of policy * Q, unlisted Q is 0."""
    return (
        policy.select(*PAIR, "probability")
        .join(q.select(*PAIR, "q"), PAIR, "left")
        .groupBy("state")
        .agg(F.sum(F.col("probability") * F.coalesce("q", F.lit(0.0))).alias("v"))
    )


def direct_method(logged: DataFrame, policy: DataFrame, q: DataFrame) -> DataFrame:
    """Mean over trajectories of V at the first state."""
    first = logged.where(F.col("t") == 0).select("state")
    return first.join(broadcast_if_small(action_values(policy, q)), "state", "left").agg(
        F.avg(F.coalesce("v", F.lit(0.0))).alias("estimate")
    )


def _weighted(logged: DataFrame, policy: DataFrame) -> DataFrame:
    """Steps with log ratio, zero flag and undefined flag."""
    target = policy.select(*PAIR, F.col("probability").alias("_pi"))
    joined = logged.join(broadcast_if_small(target), PAIR, "left").withColumn("_pi", F.coalesce("_pi", F.lit(0.0)))
    return joined.withColumns({
        "_undefined": (F.coalesce("pscore", F.lit(0.0)) <= 0).cast("int"),
        "_zero": (F.col("_pi") <= 0).cast("int"),
        "_log": F.when((F.col("_pi") > 0) & (F.col("pscore") > 0), F.log(F.col("_pi") / F.col("pscore"))).otherwise(0.0),
    })


def _mean_over_visits(per_visit: DataFrame, value: Column) -> DataFrame:
    fine = F.col("_undefined") == 0
    return per_visit.agg(
        F.avg(F.when(fine, value)).alias("estimate"),
        F.sum(F.when(fine, 0).otherwise(1)).alias("undefined_trajectories"),
    )


def trajectory_sampling(logged: DataFrame, policy: DataFrame, *, discount: float = 1.0, visit: str = VISIT) -> DataFrame:
    """Mean of the whole-trajectory ratio times the discounted return."""
    gain = F.pow(F.lit(discount), F.col("t")) * F.coalesce("reward", F.lit(0))
    per_visit = _weighted(logged, policy).groupBy(visit).agg(
        F.sum("_log").alias("_log"), F.max("_zero").alias("_zero"),
        F.max("_undefined").alias("_undefined"), F.sum(gain).alias("_return"),
    )
    ratio = F.when(F.col("_zero") > 0, 0.0).otherwise(F.exp("_log"))
    return _mean_over_visits(per_visit, ratio * F.col("_return"))


def _running_ratios(logged: DataFrame, policy: DataFrame, visit: str, min_rows: int | None) -> DataFrame:
    """Steps with the ratio up to them (``_w``) and up to the step before (``_w_prev``)."""
    scanned = ordered_scan(
        _weighted(logged, policy), [visit], ["t"],
        totals={"_logs": F.col("_log"), "_zeros": F.col("_zero")}, min_rows=min_rows,
    )
    before_zeros, before_logs = F.col("_zeros") - F.col("_zero"), F.col("_logs") - F.col("_log")
    return scanned.withColumns({
        "_w": F.when(F.col("_zeros") > 0, 0.0).otherwise(F.exp("_logs")),
        "_w_prev": F.when(before_zeros > 0, 0.0).otherwise(F.exp(before_logs)),
    })


def per_decision_sampling(
    logged: DataFrame, policy: DataFrame, *, discount: float = 1.0, visit: str = VISIT, min_rows: int | None = None
) -> DataFrame:
    """Mean of the sum of discounted rewards, each weighted by the ratio so far."""
    term = F.pow(F.lit(discount), F.col("t")) * F.col("_w") * F.coalesce("reward", F.lit(0))
    per_visit = _running_ratios(logged, policy, visit, min_rows).groupBy(visit).agg(
        F.sum(term).alias("_sum"), F.max("_undefined").alias("_undefined")
    )
    return _mean_over_visits(per_visit, F.col("_sum"))


def doubly_robust(
    logged: DataFrame,
    policy: DataFrame,
    q: DataFrame,
    *,
    discount: float = 1.0,
    visit: str = VISIT,
    min_rows: int | None = None,
) -> DataFrame:
    """Model value corrected by weighted residuals."""
    steps = (
        _running_ratios(logged, policy, visit, min_rows)
        .join(broadcast_if_small(action_values(policy, q)), "state", "left")
        .join(broadcast_if_small(q.select(*PAIR, "q")), PAIR, "left")
    )
    zero = F.lit(0.0)
    residual = F.coalesce("reward", F.lit(0)) - F.coalesce("q", zero)
    term = F.pow(F.lit(discount), F.col("t")) * (
        F.col("_w") * residual + F.col("_w_prev") * F.coalesce("v", zero)
    )
    per_visit = steps.groupBy(visit).agg(F.sum(term).alias("_sum"), F.max("_undefined").alias("_undefined"))
    return _mean_over_visits(per_visit, F.col("_sum"))
