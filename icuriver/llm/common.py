"""Helpers that several operators share: reading, spreading, byte views of Arrow text, rolling hashes, components."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from icuriver.session import cut_lineage, ship_package

#: Text handed to a Python worker at once. A longer document travels alone.
BATCH_BYTES = 4 << 20
#: Bytes that numpy works on at once, where no single document is longer.
SLICE_BYTES = 1 << 20


def prepare(spark: SparkSession) -> SparkSession:
    """Bound what a Python worker is handed at once and ship the package to the workers."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    ship_package(spark)
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def parallelism(spark: SparkSession) -> int:
    """Number of partitions for data that is dealt out by a computed number."""
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def give_back() -> None:
    """Return freed memory to the system. Workers live on, and what they only hold in reserve counts on their machine."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def returning(work: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable:
    """``work`` on the batches of a task, with freed memory returned when it has seen the last."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from work(batches)
        give_back()

    return run


def text_or_empty(column: str = "text") -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def free_name(df: DataFrame, wanted: str) -> str:
    """``wanted``, or a name near it that no column of ``df`` has."""
    taken = {c.lower() for c in df.columns}
    while wanted.lower() in taken:
        wanted = "_" + wanted
    return wanted


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts end to end and the len + 1 borders between them; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary()).fill_null(b"")
    borders = np.frombuffer(column.buffers()[1], np.int64, len(column) + 1, column.offset * 8) if len(column) else np.zeros(1, np.int64)
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return data[borders[0] : borders[-1]], borders - borders[0]


def slices(borders: np.ndarray, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of rows whose texts have at most ``limit`` bytes together, or one row that is longer."""
    first, n = 0, len(borders) - 1
    while first < n:
        last = int(np.searchsorted(borders, borders[first] + limit, "right")) - 1
        last = min(max(last, first + 1), n)
        yield first, last
        first = last


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser of a 64-bit hash: every input bit reaches every output bit."""
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0x7FB5D329728EA185)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


_BASE = 0x9E3779B97F4A7C15
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)
_BYTE_CODE = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93))
_powers: dict[int, np.ndarray] = {}


def _power(base: int, n: int) -> np.ndarray:
    have = _powers.get(base)
    if have is None or len(have) < n:
        step = np.full(max(n, 1 << 16), base, np.uint64)
        step[0] = 1
        have = np.cumprod(step, dtype=np.uint64)
        if n <= BATCH_BYTES:
            _powers[base] = have
    return have[:n]


class SpanHash:
    """64-bit hashes of any spans of a byte array, in constant time for each span."""

    def __init__(self, data: np.ndarray, codes: np.ndarray = _BYTE_CODE):
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(codes[data] * _power(_BASE, len(data)), dtype=np.uint64, out=self.sums[1:])
        self.back = _power(_BASE_INVERSE, len(data) + 1)

    def raw(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return (self.sums[end] - self.sums[start]) * self.back[start]

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix(self.raw(start, end) + (end - start).astype(np.uint64))

    def rolling(self, width: int) -> np.ndarray:
        """Hashes of all spans of ``width`` bytes, by their start."""
        n = len(self.sums) - width
        return mix((self.sums[width:] - self.sums[:n]) * self.back[:n]) if n > 0 else np.zeros(0, np.uint64)


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(id, component) of every vertex of ``edges``; component is the smallest id that links reach.

    Alternates the large-star and small-star steps: each vertex's neighbours are hung on the
    smallest of them. The minimum per vertex is combined before the shuffle and a vertex with very
    many neighbours only makes a long side of a join, which is split. Links with a null end are ignored.
    """
    pairs = edges.where(F.col(a).isNotNull() & F.col(b).isNotNull())
    pairs = pairs.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct()
    pairs, seen = cut_lineage(pairs), None
    while True:
        both = pairs.where("u <> v").select("u", "v").union(pairs.where("u <> v").select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("w"), F.least("u", "m").alias("m"))
        large = both.where("v > u").join(low, F.col("u") == F.col("w")).select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.union(pairs.where("u = v")).distinct()
        down = large.where("u <> v")
        low = down.groupBy("u").agg(F.min("v").alias("m"))
        small = down.join(low.withColumnRenamed("u", "w"), F.col("u") == F.col("w"))
        small = small.select(F.col("v").alias("u"), F.col("m").alias("v")).union(low.select("u", F.col("m").alias("v")))
        pairs = cut_lineage(small.where("u <> v").distinct())
        now = pairs.agg(F.count("*"), F.sum(F.xxhash64("u", "v") % 1_000_000_007)).first()
        if now == seen:
            break
        seen = now
    top = pairs.groupBy("u").agg(F.min("v").alias("v"))
    return top.select(F.col("u").alias("id"), F.col("v").alias("component")).union(
        top.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct()
    )
