"""Rewards, transitions, padding, behaviour probabilities, logged data."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from icuriver.functions.ordered import ordered_scan
from icuriver.operators.actions import N_ACTIONS
from icuriver.operators.cohort import VISIT
from icuriver.operators.reshape import TIME
from icuriver.session import broadcast_if_small

TERMINAL = -1
PAD_RUN = 10_000


def terminal_reward(
    df: DataFrame,
    *,
    visit: str = VISIT,
    order: Sequence[str] = (TIME,),
    died: str = "died_in_hospital",
    min_rows: int | None = None,
) -> DataFrame:
    """Reward 0, but on a visit's last row +100 if survived and -100 if not."""
    marked = ordered_scan(df, [visit], order, lead={"_more": F.lit(1)}, min_rows=min_rows)
    end = F.when(F.col(died) == 0, 100).otherwise(-100)
    return marked.withColumn("reward", F.when(F.col("_more").isNull(), end).otherwise(0)).drop("_more")


def transitions(
    steps: DataFrame,
    *,
    visit: str = VISIT,
    order: Sequence[str] = ("seq_id",),
    terminal: int | None = TERMINAL,
    min_rows: int | None = None,
) -> DataFrame:
    """State, action, reward, next state and done flag.

    The last step's next state is -1, or missing with ``terminal=None``.
    """
    scanned = ordered_scan(
        steps, [visit], order, lead={"next_state": F.col("state"), "_more": F.lit(1)}, min_rows=min_rows
    )
    done = F.col("_more").isNull()
    following = F.col("next_state") if terminal is None else F.when(done, F.lit(terminal)).otherwise(F.col("next_state"))
    return scanned.select(
        visit, *[c for c in order if c != visit], "state", "action", "reward",
        following.alias("next_state"), done.cast("int").alias("done"),
    )


def decision_transitions(
    rows: DataFrame,
    *,
    visit: str = VISIT,
    order: Sequence[str] = (TIME,),
    died: str = "died_in_hospital",
    seq: str = "seq_id",
    min_rows: int | None = None,
) -> DataFrame:
    """Numbering, terminal reward and transitions (D9, E10, E11) in one ordered scan.

    Same result as the three steps in turn, with one shuffle and one sort.
    """
    scanned = ordered_scan(
        rows, [visit], order, number=seq, lead={"next_state": F.col("state"), "_more": F.lit(1)}, min_rows=min_rows
    )
    done = F.col("_more").isNull()
    end = F.when(F.col(died) == 0, 100).otherwise(-100)
    return scanned.select(
        visit, seq, "state", "action",
        F.when(done, end).otherwise(0).alias("reward"),
        F.when(done, F.lit(TERMINAL)).otherwise(F.col("next_state")).alias("next_state"),
        done.cast("int").alias("done"),
    )


def longest_trajectory(steps: DataFrame, *, visit: str = VISIT) -> DataFrame:
    """Rows of the longest visit."""
    return steps.dropna(subset=[visit]).groupBy(visit).agg(F.count(F.lit(1)).alias("n")).agg(
        F.max("n").alias("longest")
    )


def longest_by_done(steps: DataFrame, *, visit: str = VISIT) -> DataFrame:
    """The source's literal count (E12): ids are a running sum of ``done`` over the
    whole table, the terminal row included, so it joins the next trajectory.

    Each visit thus has its rows without the last one, plus the previous visit's last
    row; only the first visit lacks that, and the last terminal row stands alone.
    Computed from the visits' lengths and the smallest visit, without a global sort.
    """
    sizes = steps.dropna(subset=[visit]).groupBy(visit).agg(F.count(F.lit(1)).alias("n"))
    first = sizes.agg(F.min(visit)).scalar()
    length = F.when(F.col(visit) == first, F.col("n") - 1).otherwise(F.col("n"))
    return sizes.agg(F.greatest(F.max(length), F.lit(1)).alias("longest"))


def pad_trajectories(
    steps: DataFrame, *, visit: str = VISIT, seq: str = "seq_id", start: int = 1
) -> DataFrame:
    """Every visit padded to the longest one.

    Padding rows have action 0, state 0, done 1 and no reward or next state. ``seq``
    counts from ``start`` without holes. The result has visits x longest rows by
    definition; padding is made in runs, so no row ever carries one long array.
    """
    longest = longest_trajectory(steps, visit=visit).scalar()
    lengths = steps.groupBy(visit).agg(F.count(F.lit(1)).alias("_n"))
    padding = (
        lengths.withColumn("_max", longest)
        .where(F.col("_n") < F.col("_max"))
        .withColumn("_first", F.explode(F.sequence(F.col("_n") + start, F.col("_max") + start - 1, F.lit(PAD_RUN))))
        .withColumn("_last", F.least(F.col("_first") + PAD_RUN, F.col("_max") + start) - 1)
        .select(visit, F.explode(F.sequence("_first", "_last")).alias(seq))
        .select(
            visit, F.col(seq).cast(steps.schema[seq].dataType).alias(seq),
            F.lit(0).cast(steps.schema["state"].dataType).alias("state"),
            F.lit(0).cast(steps.schema["action"].dataType).alias("action"),
            F.lit(1).cast(steps.schema["done"].dataType).alias("done"),
        )
    )
    return steps.unionByName(padding, allowMissingColumns=True)


def behaviour_probability(steps: DataFrame, policy: DataFrame) -> DataFrame:
    """Probability the observed policy gives the logged action, 0 if unknown.

    The policy has states x actions rows; if that is few, the steps are not shuffled.
    """
    chances = policy.select("state", "action", F.col("probability").alias("pscore"))
    return steps.join(broadcast_if_small(chances), ["state", "action"], "left").withColumn(
        "pscore", F.coalesce("pscore", F.lit(0.0))
    )


def behaviour_distribution(steps: DataFrame, policy: DataFrame) -> DataFrame:
    """All nine action probabilities of each step's state."""
    wide = policy.groupBy("state").agg(
        *[
            F.coalesce(F.max(F.when(F.col("action") == a, F.col("probability"))), F.lit(0.0)).alias(f"p{a}")
            for a in range(N_ACTIONS)
        ]
    )
    out = steps.join(broadcast_if_small(wide), "state", "left")
    return out.na.fill(0.0, subset=[f"p{a}" for a in range(N_ACTIONS)])


def logged_dataset(
    padded: DataFrame, policy: DataFrame, *, visit: str = VISIT, seq: str = "seq_id"
) -> tuple[DataFrame, DataFrame]:
    """Step table with propensities and its one-row description."""
    steps = behaviour_probability(padded, policy).select(
        visit, seq, "state", "action", "reward", "done", F.col("done").alias("terminal"), "pscore"
    )
    per_visit = padded.groupBy(visit).agg(F.count(F.lit(1)).alias("n"))
    meta = per_visit.agg(
        F.sum("n").alias("size"),
        F.count(F.lit(1)).alias("n_trajectories"),
        F.max("n").alias("step_per_trajectory"),
    ).select(
        "size", "n_trajectories", "step_per_trajectory", F.lit("discrete").alias("action_type"),
        F.lit(N_ACTIONS).alias("n_actions"), F.lit(1).alias("action_dim"), F.lit(1).alias("state_dim"),
    )
    return steps, meta
