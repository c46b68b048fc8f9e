"""Exact, linearly interpolated quantiles without holding a group in one task.

The built-in exact percentile keeps every distinct value of a group in one buffer.
Here a mergeable sketch brackets each wanted rank. One partial-aggregated pass then
keeps the values inside the brackets and only counts the rows between them. A bracket
is cut into slots; the slot counts (a few thousand rows per key) tell which slots hold
the wanted ranks, and only the values of those slots are ordered.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

ACCURACY = 100_000
SLOTS = 1024


def quantile_table(
    df: DataFrame, key: Column, value: Column, probs: Sequence[float], accuracy: int = ACCURACY
) -> DataFrame:
    """Rows ``(key, prob, n, quantile)``.

    ``key`` must take few values (columns or dictionary features): the brackets of all
    keys travel as one map. A bracket spans 4/accuracy of a key's rows, or all of them
    while there are fewer than ``4 * accuracy``. A rank outside its bracket would be an
    error, never a wrong value.
    """
    probs = sorted({float(p) for p in probs})
    margin = 2.0 / accuracy
    data = df.select(key.alias("_k"), value.cast("double").alias("_v")).where(
        F.col("_v").isNotNull() & ~F.isnan("_v") & F.col("_k").isNotNull()
    )
    asked = [max(p - margin, 0.0) for p in probs] + [min(p + margin, 1.0) for p in probs]
    sketch = data.groupBy("_k").agg(
        F.count("_v").alias("n"),
        F.min("_v").alias("lo"),
        F.max("_v").alias("hi"),
        F.percentile_approx("_v", asked, accuracy).alias("q"),
    )
    # text expressions: one call each instead of one per operator and probability
    pairs = []
    for i, p in enumerate(probs):
        low = f"CASE WHEN n < {4 * accuracy} OR {p <= margin} THEN lo ELSE q[{i}] END"
        high = f"CASE WHEN n < {4 * accuracy} OR {p >= 1 - margin} THEN hi ELSE q[{len(probs) + i}] END"
        pairs.append(f"named_struct('lo', {low}, 'hi', {high})")
    brackets = F.expr(f"array({', '.join(pairs)})")
    lookup = sketch.agg(F.map_from_entries(F.collect_list(F.struct(F.col("_k"), brackets)))).scalar()

    passed = " + ".join(f"CAST(_v > _b[{i}].hi AS INT)" for i in range(len(probs)))
    share = "coalesce(try_divide(_v - _e.lo, _e.hi - _e.lo), 0D)"
    counts = (
        data.withColumn("_m", lookup)
        .selectExpr("_k", "_v", "element_at(_m, _k) AS _b")
        .selectExpr("_k", "_v", f"{passed} AS _seg", "_b")
        .selectExpr("_k", "_v", "_seg", "get(_b, _seg) AS _e")
        .selectExpr(
            "_k", "_seg",
            # slot -1 is the uncounted stretch below a bracket
            f"CAST(CASE WHEN _v >= _e.lo THEN least(floor({share} * {SLOTS}), {SLOTS - 1}) ELSE -1 END AS INT) AS _slot",
            "CASE WHEN _v >= _e.lo THEN _v END AS _x",
        )
        .groupBy("_k", "_seg", "_slot", "_x")
        .agg(F.count(F.lit(1)).alias("_c"))
    )
    along = Window.partitionBy("_k").orderBy("_seg", "_slot").rowsBetween(Window.unboundedPreceding, 0)
    slots = (
        counts.groupBy("_k", "_seg", "_slot")
        .agg(F.sum("_c").alias("_c"))
        .withColumn("_cum", F.sum("_c").over(along))
        .withColumn("n", F.sum("_c").over(Window.partitionBy("_k")))
    )
    ranks = []
    for i, p in enumerate(probs):
        h = f"({p!r}D * (n - 1))"
        for side, rank in ((0, f"floor({h})"), (1, f"least(floor({h}) + 1, n - 1)")):
            ranks.append(f"named_struct('i', {i}, 'side', {side}, 'rank', CAST({rank} AS BIGINT), 'h', {h})")
    # keys x probs x 2 rows, each pointing at the one slot that holds its rank
    targets = (
        slots.selectExpr("_k", "_seg", "_slot", "n", "_cum", "_cum - _c AS _before", f"explode(array({', '.join(ranks)})) AS r")
        .where("r.rank >= _before AND r.rank < _cum")
        .selectExpr("_k", "_seg", "_slot", "n", "_before", "r.i", "r.side", "r.rank", "r.h")
    )
    within = Window.partitionBy("_k", "i", "side").orderBy("_x").rowsBetween(Window.unboundedPreceding, 0)
    exact = (
        targets.join(counts, ["_k", "_seg", "_slot"])
        .withColumn("_upto", F.col("_before") + F.sum("_c").over(within))
        .where("_upto > rank")
        .groupBy("_k", "n", "i", "h", "side")
        .agg(F.min("_x").alias("x"))
        .groupBy("_k", "n", "i", "h")
        .agg(F.expr("max(CASE WHEN side = 0 THEN x END)").alias("a"), F.expr("max(CASE WHEN side = 1 THEN x END)").alias("b"))
    )
    listed = ", ".join(f"{p!r}D" for p in probs)
    return exact.selectExpr(
        "_k AS key",
        f"element_at(array({listed}), i + 1) AS prob",
        "n",
        "CASE WHEN a IS NOT NULL AND b IS NOT NULL THEN a + (h - floor(h)) * (b - a) "
        "ELSE CAST(raise_error('quantile bracket missed its rank') AS DOUBLE) END AS quantile",
    )


def quantile_lookup(
    df: DataFrame, key: Column, value: Column, probs: Sequence[float], accuracy: int = ACCURACY
) -> Column:
    """Scalar subquery: map of key to the list of quantiles in the order of ``probs``."""
    table = quantile_table(df, key, value, probs, accuracy)
    by_prob = F.map_from_entries(F.collect_list(F.struct("prob", "quantile")))
    per_key = table.groupBy("key").agg(by_prob.alias("q"))
    wanted = F.expr(f"array({', '.join(f'element_at(q, {float(p)!r}D)' for p in probs)})")
    return per_key.agg(F.map_from_entries(F.collect_list(F.struct(F.col("key"), wanted)))).scalar()


def column_quantiles(
    df: DataFrame, columns: Mapping[str, Column], probs: Sequence[float], accuracy: int = ACCURACY
) -> DataFrame:
    """Quantiles of several columns: rows ``(key, prob, n, quantile)`` keyed by name."""
    return quantile_table(*_melt(df, columns), probs, accuracy)


def column_quantile_lookup(
    df: DataFrame, columns: Mapping[str, Column], probs: Sequence[float], accuracy: int = ACCURACY
) -> Column:
    return quantile_lookup(*_melt(df, columns), probs, accuracy)


def _melt(df: DataFrame, columns: Mapping[str, Column]) -> tuple[DataFrame, Column, Column]:
    """Columns as (name, value) rows; a single column needs no explode."""
    if len(columns) == 1:
        ((name, value),) = columns.items()
        return df, F.lit(name), value
    cells = F.array(
        *[F.struct(F.lit(n).alias("k"), c.cast("double").alias("v")) for n, c in columns.items()]
    )
    long = df.select(F.explode(cells).alias("cell"))
    return long, F.col("cell.k"), F.col("cell.v")
