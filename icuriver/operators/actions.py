"""Dose equivalence, dose bands, discrete actions, frequency grids."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from icuriver.functions import concepts as C
from icuriver.functions.quantiles import column_quantile_lookup

N_ACTIONS = 9


def equivalent_dose(
    df: DataFrame,
    *,
    item: str = "item",
    dose: str = "gamma",
    out: str = "equiv_gamma",
    factors: Sequence[tuple[str, float]] = C.DOSE_FACTORS,
) -> DataFrame:
    """Dose times the factor of the first name contained in the item.

    An item that contains none is an error.
    """
    name = F.lower(F.col(item))
    factor = F.raise_error(F.concat(F.lit("unknown drug "), F.coalesce(F.col(item), F.lit("NULL")))).cast("double")
    for text, value in reversed(factors):
        factor = F.when(name.contains(text), F.lit(value)).otherwise(factor)
    return df.withColumn(out, F.col(dose) * factor)


def mean_dose(df: DataFrame, item: str = "item", dose: str = "equiv_gamma") -> DataFrame:
    return df.groupBy(item).agg(F.avg(dose).alias("mean_dose"))


def dose_bands(
    df: DataFrame, dose: str = "equiv_gamma", bands: Sequence[tuple[str, float, float | None]] = C.DOSE_BANDS
) -> DataFrame:
    """Per band: mean, mean of all modes, share of all rows.

    Modes come from the value counts: the count of a band's most frequent value is a
    max, and the values that reach it are averaged. Empty bands are not listed.
    """
    x = F.col(dose)
    band = F.lit(None).cast("string")
    for label, above, upto in bands:
        inside = (x > above) if upto is None else ((x > above) & (x <= upto))
        band = F.when(inside, F.lit(label)).otherwise(band)
    total = df.agg(F.count(F.lit(1))).scalar()
    counts = df.groupBy(band.alias("band"), x.alias("value")).agg(F.count(F.lit(1)).alias("n"))
    counts = counts.where(F.col("band").isNotNull())
    peaks = counts.groupBy("band").agg(
        F.max("n").alias("peak"), F.sum(F.col("value") * F.col("n")).alias("total"), F.sum("n").alias("rows")
    )
    # one row per band
    return (
        counts.join(F.broadcast(peaks), "band")
        .groupBy("band", "total", "rows")
        .agg(F.avg(F.when(F.col("n") == F.col("peak"), F.col("value"))).alias("mode_dose"))
        .select(
            "band", (F.col("total") / F.col("rows")).alias("mean_dose"), "mode_dose",
            (F.col("rows") / total).alias("share"),
        )
    )


def action_thresholds(df: DataFrame, fluids: str, vasopressors: str) -> DataFrame:
    """Median of the non-zero values of both amounts, one row."""
    spread = {c: F.when(F.col(c) != 0, F.col(c)) for c in (fluids, vasopressors)}
    lookup = column_quantile_lookup(df, spread, [0.5])
    return df.sparkSession.range(1).withColumn("_q", lookup).select(
        F.element_at("_q", F.lit(fluids))[0].alias("fluid"),
        F.element_at("_q", F.lit(vasopressors))[0].alias("vasopressor"),
    )


def _category(value: Column, median: Column) -> Column:
    return F.when(value > median, 2).when((value > 0) & (value <= median), 1).otherwise(0)


def assign_actions(
    df: DataFrame, thresholds: DataFrame, fluids: str, vasopressors: str, out: str = "action"
) -> DataFrame:
    """Action code fluid * 3 + vasopressor with categories zero, low, high.

    Low is up to the median of the non-zero values. Negative amounts count as zero.
    """
    fitted = thresholds.select(F.struct("fluid", "vasopressor")).scalar()
    code = _category(F.col(fluids), F.col("_th.fluid")) * 3 + _category(F.col(vasopressors), F.col("_th.vasopressor"))
    return df.withColumn("_th", fitted).withColumn(out, code).drop("_th")


def action_labels(thresholds: DataFrame) -> DataFrame:
    """Readable category limits per amount. (The source swaps the two names.)"""
    def limits(name: str, digits: int) -> Column:
        text = F.format_number(F.col(name), digits)
        return F.array(
            F.lit("0"), F.concat(F.lit("(0-"), text, F.lit("]")), F.concat(F.lit("> "), text)
        ).alias(name)

    return thresholds.select(limits("fluid", 2), limits("vasopressor", 3))


def action_grid(df: DataFrame, action: str = "action") -> DataFrame:
    """Counts and shares of the nine codes, zero counts included.

    A code outside 0..8 is an error.
    """
    code = F.col(action)
    checked = F.when(code.between(0, N_ACTIONS - 1), code).otherwise(
        F.raise_error(F.lit("actions must lie in 0..8")).cast("int")
    )
    counts = df.groupBy(checked.cast("long").alias("action")).agg(F.count(F.lit(1)).alias("n"))
    spine = df.sparkSession.range(N_ACTIONS).withColumnRenamed("id", "action")
    # nine rows
    full = spine.join(F.broadcast(counts), "action", "left").withColumn("n", F.coalesce("n", F.lit(0)).cast("long"))
    return full.select(
        (F.floor(F.col("action") / 3)).cast("int").alias("fluid"),
        (F.col("action") % 3).cast("int").alias("vasopressor"),
        F.col("n").alias("count"),
        F.try_divide(F.col("n"), F.sum("n").over(Window.partitionBy())).alias("share"),
    )


def outcome_share(df: DataFrame, outcome: str = "died_in_hospital") -> DataFrame:
    """Percent of rows per outcome."""
    counts = df.where(F.col(outcome).isNotNull()).groupBy(outcome).agg(F.count(F.lit(1)).alias("n"))
    total = df.agg(F.count(outcome)).scalar()
    return counts.select(outcome, (F.col("n") * 100 / total).alias("percentage"))
