"""Links between similar items from banded keys, without forming all pairs of a large bucket of copies."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from icuriver.llm.common import components, returning
from icuriver.session import cut_lineage

#: Members of a bucket that one task compares with as many others.
BLOCK = 2000

Verify = Callable[[DataFrame], DataFrame]


def matrix(sketches: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(sketches), np.uint8).reshape(len(sketches), -1)


def _across(low: float, sure: float) -> Callable[[pd.DataFrame], pd.DataFrame]:
    """Pairs with different labels of one cell of a bucket's grid whose feature sets are alike in ``low`` at least.

    Pairs alike in ``sure`` join their labels, so each joins a label once. One member's likeness to all
    others is counted from the lists of members that have its features. The member with the most common
    features comes first, and those it joins need not be taken up again.
    """

    def pairs(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("vertex")
        vertex, label, block = rows["vertex"].to_numpy(), rows["label"].to_numpy().copy(), rows["block"].to_numpy()
        across = rows["i"].iloc[0] != rows["j"].iloc[0]
        sets = [np.frombuffer(f, np.uint32) for f in rows["features"]]
        size = np.array([len(f) for f in sets])
        owner = np.repeat(np.arange(len(sets)), size)
        _, number, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
        holders = owner[np.argsort(number, kind="stable")]
        begin, cut = np.cumsum(count) - count, np.concatenate(([0], np.cumsum(size)))
        common = np.add.reduceat(np.append(count[number], 0), np.minimum(cut[:-1], len(number))) / np.maximum(size, 1)
        order = np.argsort(-common, kind="stable").tolist()
        main, done, out = label[order[0]], np.zeros(len(sets), bool), []
        for k, at in enumerate(order):
            if k and label[at] == main:
                continue
            done[at] = True
            mine = number[cut[at] : cut[at + 1]]
            shift = np.repeat(begin[mine] - (np.cumsum(count[mine]) - count[mine]), count[mine])
            both = np.bincount(holders[shift + np.arange(len(shift))], minlength=len(sets))
            alike = both / np.maximum(size + size[at] - both, 1)
            fit = (alike >= low) & ~done & (label != label[at])
            if across:
                fit &= block != block[at]
            close = np.flatnonzero(fit & (alike >= sure))
            if len(close):
                labels, first = np.unique(label[close], return_index=True)
                out += [(vertex[at], vertex[v]) for v in close[first]]
                joined = np.isin(label, np.append(labels, label[at]))
                label[joined] = main if main in label[joined] else label[at]
            out += [(vertex[at], vertex[v]) for v in np.flatnonzero(fit & (alike < sure))]
        found = pd.DataFrame(out, columns=["x", "y"], dtype="int64")
        return pd.DataFrame({"a": found[["x", "y"]].min(axis=1), "b": found[["x", "y"]].max(axis=1)})

    return pairs


def _agreeing(pairs: DataFrame, items: DataFrame, least: float) -> DataFrame:
    """Pairs whose sketches agree in at least ``least`` of their places."""
    sketches = items.select("vertex", "sketch")
    both = pairs.join(sketches.select(F.col("vertex").alias("a"), F.col("sketch").alias("sa")), "a")
    both = both.join(sketches.select(F.col("vertex").alias("b"), F.col("sketch").alias("sb")), "b")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            agree = (matrix(batch.column(2).to_pylist()) == matrix(batch.column(3).to_pylist())).mean(axis=1)
            yield batch.select([0, 1]).filter(pa.array(agree >= least))

    return both.select("a", "b", "sa", "sb").mapInArrow(returning(work), "a long, b long")


def bucket_members(items: DataFrame) -> DataFrame:
    """(key, vertex, lead, n) of buckets with several of ``items`` (vertex, keys): its members, the smallest, their number."""
    members = items.select("vertex", F.explode(F.array_distinct("keys")).alias("key"))
    lead = members.groupBy("key").agg(F.min("vertex").alias("lead"), F.count("*").alias("n")).where("n > 1")
    return cut_lineage(members.join(lead, "key"))


def near_links(members: DataFrame, items: DataFrame, verify: Verify, least: float, features: DataFrame, low: float, sure: float) -> DataFrame:
    """(a, b), a < b: verified links whose components are those of all verified links within buckets.

    ``members`` are those of buckets, ``items`` has their sketches. First each is compared with its
    bucket's smallest vertex, if their sketches agree in ``least`` of their places, which joins
    groups of copies in linear work. Then, in buckets whose members are still in several components, all
    pairs across components are compared, in blocks, by sets of 32-bit ``features`` (vertex, features):
    those alike in ``low`` go on, but only one for two components once a pair is alike in
    ``sure``, which must be above what ``verify`` wants. ``verify`` decides on every pair.
    """
    first = members.where("lead <> vertex").select(F.col("lead").alias("a"), F.col("vertex").alias("b")).distinct()
    first = cut_lineage(_agreeing(first, items, least))
    links = cut_lineage(verify(first))
    found = components(links)
    labelled = members.where("n > 2").join(found, F.col("vertex") == F.col("id"), "left").select(
        "key", "n", "vertex", F.coalesce("component", "vertex").alias("label")
    )
    mixed = labelled.groupBy("key").agg(F.min("label").alias("low"), F.max("label").alias("high")).where("low < high").select("key")
    rows = labelled.join(mixed, "key").join(features, "vertex")
    blocks = F.ceil(F.col("n") / BLOCK).cast("int")
    rows = rows.withColumn("block", F.pmod(F.xxhash64("vertex"), blocks.cast("long")).cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
    rows = rows.select("key", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block", "vertex", "label", "features")
    second = rows.groupBy("key", "i", "j").applyInPandas(_across(low, sure), "a long, b long").distinct()
    second = second.join(first, ["a", "b"], "left_anti")
    return links.union(verify(cut_lineage(second)))
