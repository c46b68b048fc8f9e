"""Near-duplicate documents by dart MinHash over weighted word shingles."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from icuriver.llm.common import SLICE_BYTES, SpanHash, components, free_name, mix, prepare, returning, slices, text_bytes
from icuriver.llm.near import bucket_members, near_links
from icuriver.session import cut_lineage

#: Words of a shingle and the least similarity of near-duplicates.
WORDS, SIMILARITY = 5, 0.8
#: Keys of a document and coordinates in each: a pair at 0.8 shares no key once in 150,000 times.
BANDS, ROWS = 30, 5
#: Least agreement of coordinates for a pair to be verified: 0.8 less 4.6 standard deviations.
ESTIMATE = 0.65

_IN_WORD = np.zeros(256, bool)
_IN_WORD[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def shingle_cells(data: np.ndarray, borders: np.ndarray, width: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """The weighted shingle set of each text as distinct hashes, ascending within a text, and the texts' borders.

    A shingle that occurs w times has weight w: its region of the weight axis is cut into w unit cells,
    and a cell is hashed from the shingle and its place. So the shares of common cells are the weighted
    similarity. Words are runs of letters, digits and non-ASCII signs, A to Z lowered. A text with fewer
    words than a shingle has one shingle of all its words, a text without words has none.
    """
    inside = np.concatenate(([False], _IN_WORD[data], [False]))
    edge = np.zeros(len(data) + 1, bool)
    edge[borders] = True
    start = np.flatnonzero(inside[1:-1] & (~inside[:-2] | edge[:-1]))
    end = np.flatnonzero(inside[1:-1] & (~inside[2:] | edge[1:])) + 1
    among = np.searchsorted(start, borders)
    word = SpanHash(_LOWER[data]).of(start, end)
    count = np.diff(among)
    shingles = np.where(count >= width, count - width + 1, np.minimum(count, 1))
    doc = np.repeat(np.arange(len(count)), shingles)
    cut = np.concatenate(([0], np.cumsum(shingles)))
    first = np.arange(len(doc)) - np.repeat(cut[:-1] - among[:-1], shingles)
    last = among[1:][doc]
    value = np.zeros(len(doc), np.uint64)
    padded = np.concatenate((word, np.zeros(width, np.uint64)))
    for k in range(width):
        value = mix(value * np.uint64(0x9E3779B97F4A7C15) + np.where(first + k < last, padded[first + k], 0))
    order = np.lexsort((value, doc))
    value, same = value[order], np.zeros(len(doc), bool)
    same[1:] = (value[1:] == value[:-1]) & (doc[1:] == doc[:-1])
    at = np.arange(len(doc))
    place = at - np.maximum.accumulate(np.where(same, 0, at)) if len(doc) else at
    cell = np.where(place > 0, mix(value + place.astype(np.uint64) * np.uint64(0xA0761D6478BD642F)), value)
    if place.any():
        cell = cell[np.lexsort((cell, doc))]
    return cell, cut


#: Numbers of darts in a unit region are Poisson with mean 1: cumulative shares as 32-bit thresholds.
_DARTS = np.array([int(sum(np.exp(-1.0) / np.prod(np.arange(1, i + 1)) for i in range(k + 1)) * (1 << 32)) for k in range(12)], np.uint64)


def _throw(cell: np.ndarray, owner: np.ndarray, rank: np.ndarray, size: int, best: np.ndarray, mark: np.ndarray) -> None:
    """Throw the darts of regions (cell, whole rank) and keep the earliest of each coordinate of each owner."""
    seed = mix(cell + rank.astype(np.uint64) * np.uint64(0xE7037ED1A0B428DB))
    many = np.searchsorted(_DARTS, seed >> np.uint64(32), "right")
    for k in range(int(many.max(initial=0))):
        hit = np.flatnonzero(many > k)
        dart = mix(seed[hit] + np.uint64((k + 1) * 0x8EBC6AF09C88C6E3 & (1 << 64) - 1))
        spot = owner[hit] * size + ((dart >> np.uint64(40)) * np.uint64(size) >> np.uint64(24)).astype(np.int64)
        # a dart's time is its region's rank and 40 random bits within it
        time = rank[hit].astype(np.uint64) << np.uint64(40) | dart & np.uint64((1 << 40) - 1)
        order = np.argsort(time, kind="stable")[::-1]
        spot, time, name = spot[order], time[order], mix(dart)[order]
        earlier = time < best[spot]
        spot, time, name = spot[earlier], time[earlier], name[earlier]
        best[spot] = time  # of repeated places the last, so the earliest, is kept
        mark[spot] = name


def signatures(cell: np.ndarray, cut: np.ndarray, size: int = BANDS * ROWS) -> np.ndarray:
    """Dart MinHash: a row of ``size`` 64-bit marks for each text with cells; 0 for texts without.

    Darts fall on (cell, rank) as a Poisson process fixed by hashes, each with a coordinate. The earliest
    dart on a text's cells is its mark at that coordinate; two texts have the same one with a chance of
    their weighted similarity. Ranks are thrown until each coordinate has a dart: about
    size * ln(size) darts for a text, however many cells it has.
    """
    weight = np.diff(cut)
    n = len(weight)
    best = np.full(n * size, np.iinfo(np.uint64).max, np.uint64)
    mark = np.zeros(n * size, np.uint64)
    depth = np.ceil(size * (np.log(size) + 1.5) / np.maximum(weight, 1)).astype(np.int64)
    done, todo = np.zeros(n, np.int64), np.flatnonzero(weight)
    while len(todo):
        regions = weight[todo] * depth[todo]
        owner = np.repeat(todo, regions)
        within = np.arange(len(owner)) - np.repeat(np.cumsum(regions) - regions, regions)
        _throw(cell[cut[owner] + within % weight[owner]], owner, done[owner] + within // weight[owner], size, best, mark)
        done[todo] += depth[todo]
        depth[todo] = np.maximum(1, depth[todo] // 2)
        empty = (best.reshape(n, size)[todo] == np.iinfo(np.uint64).max).any(axis=1)
        todo = todo[empty]
    return mark.reshape(n, size)


def _set_digests(cell: np.ndarray, cut: np.ndarray) -> np.ndarray:
    """A 63-bit digest of each text's set of cells."""
    sums = np.zeros(len(cell) + 1, np.uint64)
    np.cumsum(mix(cell ^ np.uint64(0x589965CC75374CC3)), dtype=np.uint64, out=sums[1:])
    return (mix(sums[cut[1:]] - sums[cut[:-1]] + np.diff(cut).astype(np.uint64)) >> np.uint64(1)).astype(np.int64)


def _parts(batch: pa.RecordBatch, column: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    data, borders = text_bytes(batch.column(column))
    for a, b in slices(borders, SLICE_BYTES // 2):
        yield a, b, *shingle_cells(data[borders[a] : borders[b]], borders[a : b + 1] - borders[a])


def _text_digest(text: str | None) -> int:
    return int.from_bytes(hashlib.blake2b((text or "").encode(), digest_size=8).digest(), "little") >> 1


def _sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        digests, keys, sketches = [], [], []
        for a, b, cell, cut in _parts(batch, 2):
            marks = signatures(cell, cut)
            some = np.diff(cut) > 0
            key = np.zeros((b - a, BANDS), np.uint64)
            for r in range(ROWS):
                key = mix(key * np.uint64(0x9E3779B97F4A7C15) + marks[:, r::ROWS] + np.arange(BANDS, dtype=np.uint64))
            digest, texts = _set_digests(cell, cut), batch.column(2)
            digests += [int(d) if s else _text_digest(texts[k].as_py()) for k, d, s in zip(range(a, b), digest, some, strict=True)]
            keys += [k if s else [] for k, s in zip(key.astype(np.int64), some, strict=True)]
            sketches += [r.tobytes() for r in (marks & np.uint64(255)).astype(np.uint8)]
        columns = [*batch.columns[:2], pa.array(digests, pa.int64()), pa.array(keys, pa.list_(pa.int64())), pa.array(sketches, pa.binary())]
        yield pa.RecordBatch.from_arrays(columns, ["id", "own", "vertex", "keys", "sketch"])


def _cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        names, cells = [], []
        for a, b, cell, cut in _parts(batch, 0):
            names += _set_digests(cell, cut).tolist()
            cells += [cell[cut[k] : cut[k + 1]].tobytes() for k in range(b - a)]
        yield pa.RecordBatch.from_arrays([pa.array(names, pa.int64()), pa.array(cells, pa.binary())], ["vertex", "cells"])


def _short(cells: Column) -> Column:
    @F.arrow_udf("binary")
    def short(cells: pa.Array) -> pa.Array:
        return pa.array([(np.frombuffer(c, np.uint64) >> np.uint64(32)).astype(np.uint32).tobytes() for c in cells.to_pylist()], pa.binary())

    return short(cells)


def similarity(a: np.ndarray, b: np.ndarray) -> float:
    common = len(np.intersect1d(a, b, assume_unique=True))
    return common / max(1, len(a) + len(b) - common)


def _linked(least: float):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pairs = zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True)
            keep = [similarity(np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)) >= least for a, b in pairs]
            yield batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))

    return work


def _components(docs: DataFrame, least: float, id_column: str, text_column: str) -> tuple[DataFrame, DataFrame]:
    """Rows (id, own) with an id and their component, and those without an id; own is a hash of the text."""
    prepare(docs.sparkSession)
    text = F.col(text_column).cast("string")
    texts = docs.select(F.col(id_column).cast("long").alias("id"), F.xxhash64(text).alias("own"), text.alias("text"))
    rows = cut_lineage(texts.mapInArrow(returning(_sketch), "id long, own long, vertex long, keys array<long>, sketch binary"))
    known = rows.where("id is not null")
    items = known.groupBy("vertex").agg(F.min("id").alias("id"), F.min_by(F.struct("keys", "sketch"), "id").alias("s"))
    items = cut_lineage(items.select("vertex", "id", "s.keys", "s.sketch"))

    members = bucket_members(items)
    wanted = items.join(members.select("vertex").distinct(), "vertex").select("vertex", "id")
    cells = texts.join(wanted.select("id").distinct(), "id").select("text").mapInArrow(returning(_cells), "vertex long, cells binary")
    cells = cut_lineage(cells.join(wanted.select("vertex"), "vertex").groupBy("vertex").agg(F.first("cells").alias("cells")))

    def verify(pairs: DataFrame) -> DataFrame:
        both = pairs.join(cells.select(F.col("vertex").alias("a"), F.col("cells").alias("ca")), "a")
        both = both.join(cells.select(F.col("vertex").alias("b"), F.col("cells").alias("cb")), "b")
        return both.select("a", "b", "ca", "cb").mapInArrow(returning(_linked(least)), "a long, b long")

    # cells cut to 32 bits may be equal by chance, once in some thousand long texts
    features = cells.select("vertex", _short(F.col("cells")).alias("features"))
    found = components(near_links(members, items, verify, ESTIMATE * least / SIMILARITY, features, least - 0.001, least + 0.002))
    placed = known.select("id", "own", "vertex").join(found.withColumnRenamed("id", "v"), F.col("vertex") == F.col("v"), "left")
    return placed.select("id", "own", F.coalesce("component", "vertex").alias("component")), rows.where("id is null")


def near_duplicates(docs: DataFrame, least: float = SIMILARITY, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(id, class_id, class_size, kept): classes of documents that links of similarity ``least`` connect.

    The similarity is the weighted one of five-word shingles: common occurrences over all. class_id is
    the smallest id of the class, the document that is kept. Texts with the same shingles are one
    vertex, so copies cost nothing more. A text without words is only in a class with equal texts; null
    counts as empty. Rows that repeat an id count as documents of that id. Rows without id belong to no
    class, and are kept. Ids are whole numbers.
    Candidates come from BANDS keys of ROWS marks; every candidate pair that could join two classes is
    verified on the whole sets.
    """
    placed, alone = _components(docs, least, id_column, text_column)
    classes = placed.groupBy("component").agg(F.min("id").alias("class_id"), F.count("*").alias("class_size"))
    placed = placed.join(classes, "component").select("id", "class_id", "class_size")
    out = placed.union(alone.select("id", F.col("id").alias("class_id"), F.lit(1).cast("long").alias("class_size")))
    return out.select(F.col("id").alias(id_column), "class_id", "class_size", F.coalesce(F.col("id") == F.col("class_id"), F.lit(True)).alias("kept"))


def keep_one(docs: DataFrame, least: float = SIMILARITY, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row of each class, columns as they were: the one with the smallest id, of those the smallest text hash.

    A class is one of rows, so a row whose id other rows share stays if its text is unlike theirs. Of
    rows equal in id and text one stays, any of them. Rows without id stay.
    """
    placed, _ = _components(docs, least, id_column, text_column)
    equal = placed.groupBy("component", "id", "own").agg(F.count("*").alias("n"))
    chosen = cut_lineage(equal.groupBy("component").agg(F.min(F.struct("id", "own", "n")).alias("c")).select("c.id", "c.own", "c.n"))
    name, own = free_name(docs, "chosen_id"), free_name(docs, "chosen_own")

    def picked(rows: DataFrame) -> DataFrame:
        rows = rows.select(F.col("id").alias(name), F.col("own").alias(own))
        same = (F.col(id_column).cast("long") == F.col(name)) & (F.xxhash64(F.col(text_column).cast("string")) == F.col(own))
        return docs.join(rows, same, "left_semi")

    kept = picked(chosen.where("n = 1")).union(docs.where(F.col(id_column).isNull()))
    repeated = chosen.where("n > 1")
    if repeated.isEmpty():
        return kept
    some = picked(repeated).groupBy(F.col(id_column).alias(name), F.xxhash64(F.col(text_column).cast("string")).alias(own))
    return kept.union(some.agg(F.first(F.struct(*[F.col(c) for c in docs.columns])).alias("row")).select("row.*"))
