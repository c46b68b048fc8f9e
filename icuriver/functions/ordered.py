"""Ordered scans (running totals, last/next value, numbering) that survive a hot key.

A window partitioned by the visit puts a whole visit into one task. Here a visit
with more rows than the limit is cut into time chunks at quantiles of its own rows, so
a stray timestamp does not make them uneven; each chunk is scanned on its own and the
state that crosses chunk borders travels in a small carry table. Rows of one instant
stay together.
One aggregate job finds the hot visits first; without any, the plan is the plain
window.

Sizes: the limit is at least a 10 000th of all rows, so at most ``MAX_HOT`` visits
are hot. A visit of n rows gets ``OVERSPLIT * n / limit`` chunks, so the carry
table holds at most ``2 * OVERSPLIT * MAX_HOT`` rows, and so many borders are held at
most. Both are safe to broadcast.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from icuriver.functions.timegrid import micros

MAX_HOT = 10_000
HOT_MIN_ROWS = 1_000_000
OVERSPLIT = 4
# chunks of one visit at most; only a visit with a tenth of all rows would have more
MAX_CHUNKS = 4096
# borders are looked up in two steps: among groups of this size, then within one
_GROUP = 64

_CHUNK, _HOT, _EDGES = "_chunk", "_chunk_hot", "_chunk_edges"


def _position(df: DataFrame, order: str) -> Column:
    kind = df.schema[order].dataType
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        return micros(order)
    return F.col(order).cast("double")


def hot_keys(df: DataFrame, keys: Sequence[str], order: str, min_rows: int | None = None) -> DataFrame | None:
    """Keys whose row count exceeds the limit, with the borders of their chunks in groups.

    One aggregate returns the largest count; only if it is above the limit are the at
    most ``MAX_HOT`` hot keys fetched, with quantiles of their positions from a mergeable
    sketch. Visits smaller than the largest take every so many of them. None without hot keys.
    """
    sizes = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    largest, total = sizes.agg(F.max("_n"), F.sum("_n")).first()
    limit = max(HOT_MIN_ROWS if min_rows is None else min_rows, (total or 0) / MAX_HOT)
    if largest is None or largest <= limit:
        return None
    chunks = min(MAX_CHUNKS, math.ceil(largest * OVERSPLIT / limit))
    shares = [i / chunks for i in range(1, chunks)]
    sketch = F.percentile_approx(_position(df, order).cast("double"), shares, max(10_000, 8 * chunks))
    step = F.greatest(F.lit(1), F.floor(F.lit(chunks * float(limit)) / (F.col("_n") * OVERSPLIT))).cast("int")
    hot = (
        df.join(F.broadcast(sizes.where(F.col("_n") > limit)), keys)
        .groupBy(*keys)
        .agg(F.first("_n").alias("_n"), sketch.alias("_q"))
        .withColumn("_step", step)
        .selectExpr(*keys, "array_distinct(filter(_q, (x, i) -> i % _step = _step - 1)) AS _q")
        .selectExpr(
            *keys,
            f"transform(sequence(0, greatest(size(_q) - 1, 0) div {_GROUP}), "
            f"g -> slice(_q, CAST(g * {_GROUP} + 1 AS INT), {_GROUP})) AS {_EDGES}",
        )
    )
    return df.sparkSession.createDataFrame(hot.collect(), hot.schema)


def _cut(df: DataFrame, hot: DataFrame, keys: Sequence[str], order: str) -> DataFrame:
    """Mark rows of hot keys and number their chunk: how many borders are not after the row."""
    marked = df.join(F.broadcast(hot), list(keys), "left").withColumns(
        {_HOT: F.col(_EDGES).isNotNull(), "_at": _position(df, order).cast("double")}
    )
    marked = marked.withColumn("_group", F.expr(f"greatest(size(filter({_EDGES}, g -> get(g, 0) <= _at)) - 1, 0)"))
    number = f"_group * {_GROUP} + size(filter(get({_EDGES}, _group), x -> x <= _at))"
    return marked.withColumn(_CHUNK, F.expr(f"CAST(CASE WHEN {_HOT} THEN {number} ELSE 0 END AS BIGINT)")).drop(
        _EDGES, "_at", "_group"
    )


def ordered_scan(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    *,
    last: Mapping[str, Column] | None = None,
    following: Mapping[str, Column] | None = None,
    lead: Mapping[str, Column] | None = None,
    totals: Mapping[str, Column] | None = None,
    number: str | None = None,
    min_rows: int | None = None,
) -> DataFrame:
    """Add ordered columns per key.

    ``last``: latest non-null value up to and including the row.
    ``following``: earliest non-null value from the row on.
    ``lead``: value of the next row (NULL after the last row).
    ``totals``: running sum including the row.
    ``number``: 1-based row number; the other columns may refer to it by name.

    ``order`` must identify a row within its key; its first column is the time or
    sequence the chunks are cut by. Rows with a NULL key are dropped.
    """
    last, following, lead, totals = last or {}, following or {}, lead or {}, totals or {}
    keys, order = list(keys), list(order)
    df = df.where(F.col(order[0]).isNotNull()).dropna(subset=keys)
    hot = hot_keys(df, keys, order[0], min_rows)
    if hot is not None:
        split = _cut(df, hot, keys, order[0])
        cut = [_HOT, _CHUNK]
    else:
        split, cut = df, []
    # the mark is part of the key so that "hot rows only" filters below the window
    here = Window.partitionBy(*keys, *cut).orderBy(*order)
    along = Window.partitionBy(*keys).orderBy(_CHUNK)
    before = along.rowsBetween(Window.unboundedPreceding, -1)
    after = along.rowsBetween(1, Window.unboundedFollowing)

    if number:
        numbered = split.withColumn(number, F.row_number().over(here).cast("long"))
        if cut:
            sizes = split.where(F.col(_HOT)).groupBy(*keys, _CHUNK).agg(F.count(F.lit(1)).alias("_n"))
            offsets = sizes.select(*keys, _CHUNK, F.sum("_n").over(before).alias("_offset"))
            numbered = (
                numbered.join(F.broadcast(offsets), [*keys, _CHUNK], "left")
                .withColumn(number, F.col(number) + F.coalesce("_offset", F.lit(0)))
                .drop("_offset")
            )
        split = numbered
    columns = df.columns + ([number] if number else [])
    if not (last or following or lead or totals):
        return split.select(*columns)

    inputs = {f"_v_{n}": e for group in (last, following, totals) for n, e in group.items()}
    inputs |= {f"_v_{n}": F.struct(e.alias("v")) for n, e in lead.items()}
    split = split.withColumns(inputs)
    upto = here.rowsBetween(Window.unboundedPreceding, 0)
    onward = here.rowsBetween(0, Window.unboundedFollowing)
    local: dict[str, Column] = {}
    for n in last:
        local[f"_l_{n}"] = F.last(f"_v_{n}", ignorenulls=True).over(upto)
    for n in following:
        local[f"_l_{n}"] = F.first(f"_v_{n}", ignorenulls=True).over(onward)
    for n in lead:
        local[f"_l_{n}"] = F.lead(f"_v_{n}").over(here)
    for n in totals:
        local[f"_l_{n}"] = F.sum(f"_v_{n}").over(upto)
    scanned = split.select("*", *[c.alias(n) for n, c in local.items()])
    if not cut:
        done = [F.col(f"_l_{n}").alias(n) for n in [*last, *following, *totals]]
        return scanned.select(*columns, *done, *[F.col(f"_l_{n}.v").alias(n) for n in lead])

    rank = F.struct(*order)
    parts: list[Column] = []
    for n in last:
        value = F.col(f"_v_{n}")
        parts.append(F.max_by(value, F.when(value.isNotNull(), rank)).alias(f"_s_{n}"))
    for n in [*following, *lead]:
        value = F.col(f"_v_{n}")
        parts.append(F.min_by(value, F.when(value.isNotNull(), rank)).alias(f"_s_{n}"))
    for n in totals:
        parts.append(F.sum(f"_v_{n}").alias(f"_s_{n}"))
    chunks = split.where(F.col(_HOT)).groupBy(*keys, _CHUNK).agg(*parts)
    carry: list[Column] = []
    for n in last:
        carry.append(F.last(f"_s_{n}", ignorenulls=True).over(before).alias(f"_c_{n}"))
    for n in [*following, *lead]:
        carry.append(F.first(f"_s_{n}", ignorenulls=True).over(after).alias(f"_c_{n}"))
    for n in totals:
        carry.append(F.sum(f"_s_{n}").over(before).alias(f"_c_{n}"))
    joined = scanned.join(F.broadcast(chunks.select(*keys, _CHUNK, *carry)), [*keys, _CHUNK], "left")
    out: list[Column] = [F.col(c) for c in columns]
    for n in [*last, *following]:
        out.append(F.coalesce(f"_l_{n}", f"_c_{n}").alias(n))
    for n in lead:
        out.append(F.coalesce(f"_l_{n}", f"_c_{n}")["v"].alias(n))
    for n in totals:
        seen = F.col(f"_l_{n}").isNotNull() | F.col(f"_c_{n}").isNotNull()
        both = F.coalesce(F.col(f"_l_{n}"), F.lit(0)) + F.coalesce(F.col(f"_c_{n}"), F.lit(0))
        out.append(F.when(seen, both).alias(n))
    return joined.select(*out)
