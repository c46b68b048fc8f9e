"""Document fingerprints by a randomised edit embedding."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from icuriver.llm.common import mix, parallelism, prepare, returning
from icuriver.llm.near import bucket_members, near_links
from icuriver.session import cut_lineage

#: The shared walk: for each class of characters a row of random bits, repeated after PERIOD steps.
CLASSES, PERIOD = 64, 4096
#: Cells of a fingerprint at each of its two scales.
CELLS = 64


def _advances() -> list[bytes]:
    """For each class and step, how many steps the walk stays on a character: up to and with the next 1 bit."""
    bits = np.random.default_rng(20).integers(0, 2, (CLASSES, PERIOD)).astype(bool)
    bits[:, -1] = True
    steps = np.arange(PERIOD)
    out = []
    for row in bits:
        ones = np.flatnonzero(row)
        out.append(bytes((ones[np.searchsorted(ones, steps)] - steps + 1).astype(np.uint8)))
    return out


_ADVANCE = _advances()
_SPOTS = np.sort(np.random.default_rng(21).random(CELLS))


def _code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def walk(codes: np.ndarray, begin: int = 0, number: int = 0) -> np.ndarray:
    """Step at which the walk enters each character, and the step after the last. Another ``number``, another walk.

    The embedded text repeats each character until the walk leaves it, twice on average. Walks that meet
    at the same character and step go on alike, so a few edits change few embedded characters.
    """
    classes = mix(codes.astype(np.uint64) + np.uint64(number << 32)) >> np.uint64(58)
    table, wrap = _ADVANCE, PERIOD - 1
    steps = accumulate(classes.astype(np.uint8).tobytes(), lambda j, c: j + table[c][j & wrap], initial=begin)
    return np.fromiter(steps, np.int64, len(codes) + 1)


def scale_of(n: int) -> int:
    return max(0, (n - 1).bit_length())


def samples(codes: np.ndarray, steps: np.ndarray) -> tuple[int, np.ndarray]:
    """Scale, and CELLS samples of the embedded text over 2 * 2**scale steps, then as many over twice that.

    A sample is a hash of the character at a step and the three after it; 0 past the end.
    """
    scale = scale_of(len(codes))
    at = np.concatenate([_SPOTS * (2 << scale), _SPOTS * (4 << scale)]).astype(np.int64)
    index = np.searchsorted(steps, at, "right") - 1
    inside = index < len(codes)
    index = np.minimum(index, max(0, len(codes) - 1))
    padded = np.concatenate((codes.astype(np.uint64), np.zeros(4, np.uint64)))
    value = np.zeros(len(at), np.uint64)
    for k in range(4):
        value = mix(value * np.uint64(0x9E3779B97F4A7C15) + padded[index + k])
    return scale, np.where(inside, np.maximum(value, np.uint64(1)), np.uint64(0))


def cells(codes: np.ndarray, steps: np.ndarray) -> bytes:
    """Scale in a byte, then the samples in a byte each: 1 to 255, or 0 past the end."""
    scale, value = samples(codes, steps)
    value = np.where(value > 0, value % np.uint64(255) + np.uint64(1), 0).astype(np.uint8)
    return bytes([scale]) + value.tobytes()


def likeness(a: bytes, b: bytes) -> float:
    """Share of equal samples at the scales that both have, of those inside either text; 1 for equal fingerprints."""
    if a == b:
        return 1.0
    first, second = (a, b) if a[0] <= b[0] else (b, a)
    apart = second[0] - first[0]
    if apart > 1:
        return 0.0
    x = np.frombuffer(first, np.uint8)[1 + apart * CELLS :]
    y = np.frombuffer(second, np.uint8)[1 : 1 + len(x)]
    used = (x > 0) | (y > 0)
    return float((x == y)[used].mean()) if used.any() else 0.0


def fingerprint(text: str) -> bytes:
    codes = _code_points(text)
    return cells(codes, walk(codes))


def fingerprints(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(id, n_chars, cells) of every whole text; null counts as empty. Rows are independent."""
    prepare(docs.sparkSession)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            columns = [batch.column(0), pa.array(map(len, texts), pa.int64()), pa.array(map(fingerprint, texts), pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, [id_column, "n_chars", "cells"])

    kind = docs.select(id_column).schema[0].dataType.simpleString()
    return docs.select(F.col(id_column), F.col(text_column).cast("string")).mapInArrow(returning(work), f"`{id_column}` {kind}, n_chars long, cells binary")


def with_successor(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Rows (part, look, id, text) dealt out and sorted so that each row's successor in id order follows it.

    Parts are ranges of ids that begin at an id; the rows at which a part begins are also sent to the end
    of the part before (look = 1), and the first rows of all to the end of the last. So every part can be
    read as a stream. Null ids come first; rows with the same id are ordered by text.
    """
    spark = prepare(docs.sparkSession)
    parts = parallelism(spark)
    rows = docs.select(F.col(id_column).alias("id"), F.coalesce(F.col(text_column).cast("string"), F.lit("")).alias("text"))
    shares = [k / parts for k in range(1, parts)] or [0.5]
    low, nulls, spread = rows.agg(F.min("id"), F.count_if(F.col("id").isNull()), F.percentile_approx("id", shares, 10_000)).first()
    bounds = sorted({b for b in spread or [] if nulls or b > low})
    listed = F.array(*[F.lit(b) for b in bounds]) if bounds else F.array().cast("array<long>")
    part = F.size(F.filter(listed, lambda b: b <= F.col("id")))
    part = F.when(F.col("id").isNull(), 0).otherwise(part)
    begins = F.array_contains(listed, F.col("id"))
    is_first = F.col("id").isNull() if nulls else F.col("id") == F.lit(low)

    def place(p: Column, look: int) -> Column:
        return F.struct(p.cast("int").alias("part"), F.lit(look).alias("look"))

    nowhere = F.array().cast("array<struct<part:int,look:int>>")
    places = F.concat(
        F.array(place(part, 0)),
        F.when(begins, F.array(place(part - 1, 1))).otherwise(nowhere),
        F.when(is_first, F.array(place(F.lit(len(bounds)), 1))).otherwise(nowhere),
    )
    dealt = rows.withColumn("place", F.explode(places)).select("place.part", "place.look", "id", "text")
    return dealt.repartitionById(len(bounds) + 1, F.col("part")).sortWithinPartitions("part", "look", "id", "text")


def compare_with_next(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Fingerprints of every text, of the text with its last half replaced by the next one's beginning, and of the next one.

    (id, n_chars, edited_sha256, cells, edited_cells, near_edited, near_next). The next document is the
    one after in id order, rows with one id in order of their texts; after the last comes the first. A
    null text counts as empty. An empty table gives no rows.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before = None
        for batch in batches:
            out: list[list] = [[] for _ in range(7)]
            for look, name, text in zip(*(batch.column(k).to_pylist() for k in (1, 2, 3)), strict=True):
                codes = _code_points(text)
                steps = walk(codes)
                now = (name, text, codes, steps, cells(codes, steps))
                if before is not None:
                    old, old_text, old_codes, old_steps, old_cells = before
                    half = len(old_codes) // 2
                    keep = len(old_codes) - half
                    tail = codes[:half]
                    edited_steps = np.concatenate((old_steps[:keep], walk(tail, int(old_steps[keep]))))
                    edited = cells(np.concatenate((old_codes[:keep], tail)), edited_steps)
                    digest = hashlib.sha256((old_text[:keep] + text[:half]).encode()).hexdigest()
                    for column, value in zip(out, (old, len(old_codes), digest, old_cells, edited, likeness(old_cells, edited), likeness(old_cells, now[4])), strict=True):
                        column.append(value)
                before = None if look else now
                if look:
                    break
            kinds = [batch.column(2).type, pa.int64(), pa.string(), pa.binary(), pa.binary(), pa.float64(), pa.float64()]
            names = [id_column, "n_chars", "edited_sha256", "cells", "edited_cells", "near_edited", "near_next"]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds, strict=True)], names)

    kind = docs.select(id_column).schema[0].dataType.simpleString()
    schema = f"`{id_column}` {kind}, n_chars long, edited_sha256 string, cells binary, edited_cells binary, near_edited double, near_next double"
    return with_successor(docs, id_column, text_column).mapInArrow(returning(work), schema)


#: Neighbouring samples in a band key, and samples from one band to the next.
BAND, STRIDE = 3, 2
#: Walks whose bands make candidates. After an insertion a walk may stay apart for long; few do so in all of them.
WALKS = 6
#: Agreement of samples that two texts with a common band have at least, so no candidate is left unverified.
SHARED = BAND / (2 * CELLS * WALKS)


def edit_distance(a: str, b: str) -> int:
    """Insertions, deletions and replacements from a to b, a column of the table at a time as bits of one number."""
    if len(a) < len(b):
        a, b = b, a
    if not b:
        return len(a)
    where: dict[str, int] = {}
    for k, c in enumerate(b):
        where[c] = where.get(c, 0) | 1 << k
    full, top = (1 << len(b)) - 1, 1 << len(b) - 1
    up, down, distance = full, 0, len(b)
    for c in a:
        equal = where.get(c, 0)
        diagonal = (((equal & up) + up) ^ up) | equal | down
        right_up = down | ~(diagonal | up) & full
        right_down = up & diagonal
        distance += bool(right_up & top) - bool(right_down & top)
        right_up = (right_up << 1 | 1) & full
        down, up = right_up & diagonal, (right_down << 1 | ~(right_up | diagonal)) & full
    return distance


def band_keys(text: str) -> tuple[list[int], bytes]:
    """Keys of BAND neighbouring samples inside the text, at either scale of each walk, and all samples in bytes, those of even scales first.

    Bands overlap, since walks that have met stay together for a while: of two texts some neighbours
    agree where as many samples far apart would not. A text with fewer steps than a band has one key.
    """
    codes = _code_points(text)
    keys, halves = [], [b"", b""]
    for number in range(WALKS):
        scale, value = samples(codes, walk(codes, number=number))
        for k in (0, 1):
            part = value[k * CELLS : (k + 1) * CELLS]
            halves[(scale + k) % 2] += np.where(part > 0, part % np.uint64(255) + np.uint64(1), 0).astype(np.uint8).tobytes()
            inside = np.count_nonzero(part)
            spots = np.arange(0, max(1, inside - BAND + 1) if inside else 0, STRIDE, dtype=np.uint64)
            key = mix(spots + np.uint64(CELLS * (64 * number + scale + k)))
            for n in range(min(BAND, inside)):
                key = mix(key * np.uint64(0x9E3779B97F4A7C15) + part[spots.astype(np.int64) + n])
            keys += key.view(np.int64).tolist()
    return keys, halves[0] + halves[1]


def near_edits(docs: DataFrame, least: float = 0.98, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(a, b, distance): verified pairs of documents whose texts differ by at most a share 1 - ``least`` of the longer one.

    Equal texts are one document, named by the smallest id. Candidates share a band of samples of one
    of WALKS walks, at either scale; each returned pair is verified by its exact edit distance. The pairs
    connect what all verified pairs would, but pairs inside a group that others connect may be left out.
    Two edits in a hundred characters leave a common band in at least 95 of 100 pairs of 200 to 20,000
    characters, whether replacements, insertions or deletions; the share falls with more edits and with
    longer texts, as walks that insertions have parted meet later. Rows with null ids take no part; a null
    text counts as empty and links with nothing. An empty table gives no rows.
    """
    prepare(docs.sparkSession)
    texts = docs.where(F.col(id_column).isNotNull()).select(F.col(id_column).cast("long").alias("vertex"), F.coalesce(F.col(text_column).cast("string"), F.lit("")).alias("text"))
    first = texts.groupBy(F.sha2("text", 256).alias("digest")).agg(F.min("vertex").alias("vertex"))
    texts = texts.withColumn("digest", F.sha2("text", 256)).join(first, ["digest", "vertex"]).dropDuplicates(["vertex", "digest"])
    texts = cut_lineage(texts.groupBy("vertex").agg(F.min("text").alias("text")))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, sketches = zip(*(band_keys(t) for t in batch.column(1).to_pylist()), strict=True) if batch.num_rows else ((), ())
            columns = [batch.column(0), pa.array(keys, pa.list_(pa.int64())), pa.array(sketches, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["vertex", "keys", "sketch"])

    items = cut_lineage(texts.select("vertex", "text").mapInArrow(returning(work), "vertex long, keys array<long>, sketch binary"))

    @F.arrow_udf("long")
    def distance(a: pa.Array, b: pa.Array) -> pa.Array:
        return pa.array([edit_distance(x, y) for x, y in zip(a.to_pylist(), b.to_pylist(), strict=True)], pa.int64())

    def measured(pairs: DataFrame) -> DataFrame:
        both = pairs.join(texts.select(F.col("vertex").alias("a"), F.col("text").alias("ta")), "a")
        both = both.join(texts.select(F.col("vertex").alias("b"), F.col("text").alias("tb")), "b")
        within = (1 - least) * F.greatest(F.length("ta"), F.length("tb")) + 1e-9
        both = both.withColumn("distance", distance("ta", "tb")).where(F.col("distance") <= within)
        return both.select("a", "b", "distance")

    @F.arrow_udf("binary")
    def places(sketch: pa.Array) -> pa.Array:
        some = (np.frombuffer(s, np.uint8).astype(np.uint32) for s in sketch.to_pylist())
        return pa.array([(s + 256 * np.arange(len(s), dtype=np.uint32))[s > 0].tobytes() for s in some], pa.binary())

    # agreement of samples is no proof, so every candidate pair across components is measured
    features = items.select("vertex", places("sketch").alias("features"))
    return measured(near_links(bucket_members(items), items, lambda pairs: measured(pairs).select("a", "b"), SHARED, features, SHARED / 2, 2.0))
