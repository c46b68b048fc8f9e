"""Value hygiene: one missing marker (NULL), lenient casts, small arithmetic."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def nan_to_null(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Turn NaN into NULL in floating columns (all of them by default)."""
    floating = [
        f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))
    ]
    chosen = [c for c in floating if columns is None or c in columns]
    return df.withColumns({c: F.nanvl(F.col(c), F.lit(None)) for c in chosen}) if chosen else df


def to_double(column: str | Column) -> Column:
    """Unparsable text becomes NULL instead of failing under ANSI mode."""
    column = F.col(column) if isinstance(column, str) else column
    return column.try_cast("double")


def to_timestamp(column: str | Column) -> Column:
    column = F.col(column) if isinstance(column, str) else column
    return column.try_cast("timestamp_ntz")


def numeric_columns(df: DataFrame, ignore: Sequence[str] = ()) -> list[str]:
    return [
        f.name
        for f in df.schema.fields
        if isinstance(f.dataType, T.NumericType) and f.name not in ignore
    ]


def row_total(columns: Sequence[str]) -> Column:
    """Sum over columns with missing values skipped."""
    total = F.lit(0.0)
    for name in columns:
        total = total + F.coalesce(F.col(name).cast("double"), F.lit(0.0))
    return total


def band_score(value: Column, bands: Sequence[tuple[str, float | None, str, float | None, int]]) -> Column:
    """Score a value by bands ``(low_op, low, high_op, high, score)``.

    ``low_op`` is ``>`` or ``>=``, ``high_op`` is ``<`` or ``<=``; a None limit is
    open. A missing value or one in no band scores 0. Later bands win.
    """
    score = F.lit(0)
    for low_op, low, high_op, high, points in bands:
        inside = value.isNotNull()
        if low is not None:
            inside = inside & (value > low if low_op == ">" else value >= low)
        if high is not None:
            inside = inside & (value < high if high_op == "<" else value <= high)
        score = F.when(inside, F.lit(points)).otherwise(score)
    return score


def regex_number(text: Column, pattern: str) -> Column:
    """First capture group as double; no match is NULL."""
    return to_double(F.nullif(F.regexp_extract(text, pattern, 1), F.lit("")))
