"""Shards of near-equal size that keep equal texts together."""

from __future__ import annotations

import heapq

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from icuriver.llm.common import prepare, text_or_empty
from icuriver.session import cut_lineage

#: Units the driver places: groups of more than total / UNITS bytes (fewer than UNITS of them) and UNITS bundles.
UNITS = 8192
#: Share of the small groups that goes to the finer half of the bundles, which even out the loads at the end.
FINE = 16
#: Documents that are numbered by one window.
NUMBERED = 200_000


def longest_first(items: list[tuple[str, int]], shards: int) -> dict[str, int]:
    """Longest processing time first: the largest item goes to the least-loaded shard; ties by name and shard."""
    loads = [(0, s) for s in range(shards)]
    placed = {}
    for name, size in sorted(items, key=lambda x: (-x[1], x[0])):
        load, shard = heapq.heappop(loads)
        placed[name] = shard
        heapq.heappush(loads, (load + size, shard))
    return placed


def balanced_shards(docs: DataFrame, shards: int, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(id, size, text_crc32, shard, slot): equal texts share a shard, shard sizes are near equal.

    size is the text's UTF-8 bytes plus 8; a null text counts as empty and goes with the empty texts.
    Slots number a shard's documents from 0 without gaps. Null and repeated ids are rows like others;
    an empty table gives none. Groups are summed before any shuffle. Groups above a share of the total,
    of which there can only be few, are placed one by one; the rest are placed in a fixed number of
    bundles of two sizes. So the heap gets at most 16,384 items, and each document finds its shard by
    its group or bundle.
    """
    spark = prepare(docs.sparkSession)
    text = text_or_empty(text_column)
    rows = cut_lineage(docs.select(
        F.col(id_column).alias("id"), (F.octet_length(text).cast("long") + 8).alias("size"),
        F.crc32(text).alias("crc"), F.sha2(text, 256).alias("group"),
    ))
    total, n = rows.agg(F.coalesce(F.sum("size"), F.lit(0)), F.count("*")).first()
    spot = F.pmod(F.xxhash64("group"), F.lit(UNITS // 2 * FINE * 4)).cast("long")
    border = UNITS // 2 * (FINE - 1) * 4
    bundle = F.when(spot < border, F.floor(spot * (UNITS // 2) / border)).otherwise(UNITS // 2 + F.floor((spot - border) / 4))
    bundle = bundle.cast("long")
    groups = rows.groupBy("group").agg(F.sum("size").alias("size"))
    heavy = groups.where(F.col("size") * UNITS > total).select("group", "size").collect()
    light = groups.where(F.col("size") * UNITS <= total).groupBy(bundle.cast("string").alias("bundle")).agg(F.sum("size").alias("size")).collect()
    placed = longest_first([(r[0], r[1]) for r in heavy] + [(r[0], r[1]) for r in light], shards)
    own = spark.createDataFrame([(r[0], placed[r[0]]) for r in heavy], "group string, own int")
    rest = spark.createDataFrame([(int(r[0]), placed[r[0]]) for r in light], "bundle long, rest int")
    dealt = rows.withColumn("bundle", bundle).join(F.broadcast(own), "group", "left").join(F.broadcast(rest), "bundle", "left")
    parts = max(32, n // (shards * NUMBERED) + 1)
    dealt = dealt.select(
        "id", "size", "crc", "group", F.coalesce("own", "rest").alias("shard"),
        F.pmod(F.xxhash64("id", "group"), F.lit(parts)).alias("part"),
    )
    before = dealt.groupBy("shard", "part").count().select(
        "shard", "part",
        (F.sum("count").over(Window.partitionBy("shard").orderBy("part")) - F.col("count")).alias("before"),
    )
    within = F.row_number().over(Window.partitionBy("shard", "part").orderBy("id", "group"))
    numbered = dealt.withColumn("within", within).join(before, ["shard", "part"])
    return numbered.select(
        F.col("id").alias(id_column), "size", F.col("crc").alias("text_crc32"), "shard",
        (F.col("before") + F.col("within") - 1).alias("slot"),
    )
