"""Hard negatives of anchors through an inverted multi-index: cells of two half-space codebooks, visited by bound."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from heapq import heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from icuriver.llm.common import prepare, returning
from icuriver.llm.pq_dedup import k_means, nearest
from icuriver.session import cut_lineage

#: Rows that the codebooks are fitted on at most, those with the smallest hashes. All rows are indexed.
SAMPLE = 16_384
#: Codewords of a half at most, and rows for each cell that fewer are taken for.
CODEWORDS, PER_CELL = 48, 32
#: Indexed rows of a task and anchors it searches them for, about.
BLOCK, ANCHORS = 16_384, 4096
#: Blocks at least, about, so that small tables use several cores.
BLOCKS = 16
#: Rows scored at once.
GATHER = 512
#: Room for rounding in a bound.
MARGIN = 1e-6

#: Stands for a missing id, after all others.
_NO_ID = np.iinfo(np.int64).max


def cells_by_bound(first: np.ndarray, second: np.ndarray) -> Iterator[tuple[float, int, int]]:
    """(sum, i, j) of all pairs of half scores by descending sum, through a heap of at most one pair for each i."""
    rows, columns = np.argsort(-first, kind="stable").tolist(), np.argsort(-second, kind="stable").tolist()
    a, b = first[rows].tolist(), second[columns].tolist()
    heap = [(-a[0] - b[0], 0, 0)] if a and b else []
    while heap:
        low, i, j = heappop(heap)
        yield -low, rows[i], columns[j]
        if j + 1 < len(b):
            heappush(heap, (-a[i] - b[j + 1], i, j + 1))
        if j == 0 and i + 1 < len(a):
            heappush(heap, (-a[i + 1] - b[0], i + 1, 0))


def codebook(half: np.ndarray, words: int) -> np.ndarray:
    """Codewords of half-vectors; one for all, where a vector of one component leaves the half empty."""
    return k_means(half, words) if half.shape[1] else np.zeros((1, 0))


@dataclass
class MultiIndex:
    """Codebooks of both halves, the radius of each codeword, and the blocks that hold each cell's rows."""

    books: tuple[np.ndarray, np.ndarray]
    radii: tuple[np.ndarray, np.ndarray] | None = None
    cell: np.ndarray | None = None  # (first codeword, second, block) of each block's cells, by block
    cuts: np.ndarray | None = None  # where each block begins in it

    @property
    def width(self) -> int:
        return self.books[0].shape[1]

    def halves(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return x[..., : self.width], x[..., self.width :]

    def assign(self, x: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        """Codeword and distance to it, in either half."""
        out = []
        for half, book in zip(self.halves(x), self.books, strict=True):
            near = nearest(half, book)
            out.append((near, np.sqrt(((half - book[near]) ** 2).sum(axis=1))))
        return out

    def half_scores(self, q: np.ndarray, radii: tuple[np.ndarray, np.ndarray]) -> list[np.ndarray]:
        """For each codeword the most that a row within its radius can score in that half."""
        return [book @ half + np.sqrt(half @ half) * far for half, book, far in zip(self.halves(q), self.books, radii, strict=True)]

    def place(self, counts: dict[tuple[int, int], int], radii: tuple[np.ndarray, np.ndarray], block: int) -> dict[tuple[int, int], tuple[int, int]]:
        """First and last block of each cell's rows: cells follow each other along the first codebook's main axis."""
        self.radii = radii
        axis = np.linalg.svd(self.books[0] - self.books[0].mean(axis=0), full_matrices=False)[2][0] if len(self.books[0]) > 1 else np.ones(self.width)
        along = (self.books[0] @ axis).tolist()
        spans, upto = {}, 0
        for cell in sorted(counts, key=lambda c: (along[c[0]], c)):
            spans[cell] = upto // block, (upto + counts[cell] - 1) // block
            upto += counts[cell]
        rows = sorted((b, *cell) for cell, (low, high) in spans.items() for b in range(low, high + 1))
        self.cell = np.array([(i, j, b) for b, i, j in rows], np.int64).reshape(-1, 3)
        self.cuts = np.flatnonzero(np.diff(self.cell[:, 2], prepend=-1))
        return spans

    def block_bounds(self, q: np.ndarray) -> np.ndarray:
        """The most that a row of each block can score."""
        first, second = self.half_scores(q, self.radii)
        bound = np.maximum.reduceat(first[self.cell[:, 0]] + second[self.cell[:, 1]], self.cuts)
        return bound + MARGIN * (1 + np.abs(bound))


def products(x: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Exact inner products of whole numbers held as doubles."""
    if np.sqrt((x**2).sum(axis=1).max(initial=0)) * np.sqrt((q**2).sum()) < 1 << 53:
        return (x @ q).astype(np.int64)
    whole = [[int(v) for v in row] for row in x.tolist()]
    return np.array([sum(a * int(b) for a, b in zip(row, q.tolist(), strict=True)) for row in whole], np.int64)


class Top:
    """The best few of rows (score, id, row) that lie between two scores: highest first, then smallest id."""

    def __init__(self, k: int, low: float, high: float = np.inf):
        self.k, self.low, self.high = k, low, high
        self.rows = np.zeros((3, 0), np.int64)

    @property
    def least(self) -> float:
        """What a further row must reach."""
        return max(self.low, self.rows[0, -1]) if self.rows.shape[1] == self.k else self.low

    def add(self, score: np.ndarray, name: np.ndarray, row: np.ndarray) -> None:
        fits = np.flatnonzero((score >= self.least) & (score <= self.high))
        if len(fits):
            rows = np.concatenate((self.rows, np.stack((score[fits], name[fits], row[fits]))), axis=1)
            self.rows = rows[:, np.lexsort((rows[2], rows[1], -rows[0]))[: self.k]]


class Shard:
    """A block of rows by cell, with the radii that its own rows have."""

    def __init__(self, index: MultiIndex, x: np.ndarray, name: np.ndarray, label: np.ndarray, row: np.ndarray):
        (first, far_first), (second, far_second) = index.assign(x)
        order = np.lexsort((row, second, first))
        self.index, self.x, self.name, self.label, self.row = index, x[order], name[order], label[order], row[order]
        width = len(index.books[1])
        cell = (first * width + second)[order]
        self.cuts = np.searchsorted(cell, np.arange(len(index.books[0]) * width + 1))
        radii = []
        for at, far, book in ((first, far_first, index.books[0]), (second, far_second, index.books[1])):
            radius = np.full(len(book), -np.inf)
            np.maximum.at(radius, at, far)
            radii.append(radius)
        self.radii = radii
        self.held = [np.flatnonzero(np.isfinite(r)) for r in radii]

    def search(self, q: np.ndarray, tops: list[Top], admit: np.ndarray) -> None:
        """Fill ``tops`` with rows that are admitted, cell by cell, until no cell left can hold one that matters."""
        with np.errstate(invalid="ignore"):
            halves = self.index.half_scores(q, [np.where(np.isfinite(r), r, 0) for r in self.radii])
        width, pending, n = len(self.index.books[1]), [], 0

        def score() -> None:
            nonlocal pending, n
            at = np.concatenate(pending)
            at = at[admit[at]]
            found = products(self.x[at], q)
            for top in tops:
                top.add(found, self.name[at], self.row[at])
            pending, n = [], 0

        for bound, i, j in cells_by_bound(halves[0][self.held[0]], halves[1][self.held[1]]):
            if bound + MARGIN * (1 + abs(bound)) < min(top.least for top in tops):
                break
            cell = self.held[0][i] * width + self.held[1][j]
            a, b = self.cuts[cell], self.cuts[cell + 1]
            if a < b:
                pending.append(np.arange(a, b))
                n += b - a
                if n >= GATHER:
                    score()
        if n:
            score()


def window_of(positive: int, low: int, high: int) -> tuple[int, int]:
    """Least and greatest score of a negative, for a positive's score and shares of it in hundredths."""
    return -(-low * positive // 100), high * positive // 100


_FOUND = "anchor long, `window` long, score long, id long, `row` long"


def _search(model, k: int, negatives: bool, shares: tuple[int, int], dims: int):
    """Best rows of one block for its anchors: of the same label, or of others within each window."""

    def work(table: pa.Table) -> pa.Table:
        kind = table.column("kind").to_numpy()
        x = np.frombuffer(b"".join(table.column("vec").to_pylist())).reshape(-1, dims)
        name = np.array([_NO_ID if v is None else v for v in table.column("id").to_pylist()], np.int64)
        label, row = table.column("label").to_numpy(), table.column("row").to_numpy()
        stored = kind == 0
        shard = Shard(model.value, x[stored], name[stored], label[stored], row[stored])
        windows = table.column("windows").to_pylist()
        out: list[np.ndarray] = []
        for at in np.flatnonzero(~stored).tolist():
            if negatives:
                tops = [(w, Top(k, *window_of(w, *shares))) for w in windows[at]]
                admit = shard.label != label[at]
            else:
                tops = [(0, Top(k, -np.inf))]
                admit = (shard.label == label[at]) & (shard.row != row[at])
            shard.search(x[at], [t for _, t in tops], admit)
            for w, top in tops:
                n = top.rows.shape[1]
                out.append(np.stack((np.full(n, row[at]), np.full(n, w), *top.rows)))
        found = np.concatenate(out, axis=1) if out else np.zeros((5, 0), np.int64)
        names = ["anchor", "window", "score", "id", "row"]
        return pa.table([pa.array(c, pa.int64(), mask=c == _NO_ID if n == "id" else None) for n, c in zip(names, found, strict=True)], names=names)

    return work


def _first(df: DataFrame, k: int, *by: str) -> DataFrame:
    order = Window.partitionBy(*by).orderBy(F.desc("score"), F.asc_nulls_last("id"), "row")
    return df.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def hard_negatives(
    vectors: DataFrame,
    anchors: Column,
    positives: int = 5,
    negatives: int = 5,
    shares: tuple[int, int] = (80, 100),
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    label_column: str = "label",
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) for the rows that ``anchors`` picks.

    A component x counts as floor(256 x); a score is the inner product of such whole numbers, exact, and
    must fit 64 bits. Higher scores come first, then smaller ids, missing ids last. An anchor's positives
    are its first ``positives`` other rows of its label; for each, its negatives are the first
    ``negatives`` rows of other labels whose score is between ``shares`` hundredths of the positive's.
    A positive without such rows, as each with a score below 0, gives none.

    Rows with a null label, a null or empty vector or a null or non-finite component take no part, nor
    do those whose length differs from the most frequent one in the sample. Rows that are repeated are
    rows of their own. Ids and labels are whole numbers. An empty table gives no rows.

    Codebooks of both halves come from a sample of SAMPLE rows; all rows are indexed, in blocks of
    neighbouring cells, a large cell over several. An anchor first searches the block with the highest
    bound. What it finds there tells which other blocks it must search: those whose bound reaches its
    last place, or its windows. In a block a heap visits cells by the sum of their half scores, radii
    included, and stops when no cell left can change the result. So the result is that of scoring all rows.
    """
    spark = prepare(vectors.sparkSession)
    out = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for v in batch.column(3):
                v = v.values if v.is_valid else None
                if v is None or not len(v) or v.null_count:
                    found.append(None)
                    continue
                with np.errstate(over="ignore"):
                    whole = np.floor(256 * v.to_numpy(zero_copy_only=False).astype(float))
                found.append(whole.tobytes() if np.isfinite(whole).all() else None)
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(found, pa.binary())], ["id", "label", "asks", "vec"])

    given = vectors.select(F.col(id_column).cast("long"), F.col(label_column).cast("long"), F.coalesce(anchors, F.lit(False)), F.col(vector_column))
    given = given.toDF("id", "label", "asks", "vec").where("label is not null")
    rows = given.mapInArrow(returning(parse), "id long, label long, asks boolean, vec binary").where("vec is not null")
    rows = cut_lineage(rows.withColumn("row", F.monotonically_increasing_id()))
    sample = [np.frombuffer(r[0]) for r in rows.orderBy(F.xxhash64("vec", "id", "row"), "row").limit(SAMPLE).select("vec").collect()]
    if not sample:
        return spark.createDataFrame([], out)
    dims = Counter(map(len, sample)).most_common(1)[0][0]
    rows = rows.where(F.octet_length("vec") == 8 * dims)
    x = np.stack([v for v in sample if len(v) == dims])
    total = rows.count()
    words, block = max(1, min(CODEWORDS, int(np.sqrt(total / PER_CELL)))), max(1, min(BLOCK, -(-total // BLOCKS)))
    index = MultiIndex((codebook(x[:, : dims // 2], words), codebook(x[:, dims // 2 :], words)))
    codebooks = spark.sparkContext.broadcast(index)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.frombuffer(b"".join(batch.column(4).to_pylist())).reshape(-1, dims)
            (first, far_first), (second, far_second) = codebooks.value.assign(x)
            more = [pa.array(first, pa.int32()), pa.array(second, pa.int32()), pa.array(far_first), pa.array(far_second)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *more], [*batch.schema.names, "first", "second", "far_first", "far_second"])

    columns = "row long, id long, label long, asks boolean, vec binary"
    rows = rows.select("row", "id", "label", "asks", "vec").mapInArrow(returning(assign), f"{columns}, first int, second int, far_first double, far_second double")
    rows = cut_lineage(rows)
    # a row for each cell: at most CODEWORDS squared
    cells = rows.groupBy("first", "second").agg(F.count("*").alias("n"), F.max("far_first").alias("a"), F.max("far_second").alias("b")).collect()
    radii = tuple(np.zeros(len(book)) for book in index.books)
    for c in cells:
        radii[0][c["first"]] = max(radii[0][c["first"]], c["a"])
        radii[1][c["second"]] = max(radii[1][c["second"]], c["b"])
    spans = index.place({(c["first"], c["second"]): c["n"] for c in cells}, radii, block)
    blocks = int(index.cell[-1, 2]) + 1
    model = spark.sparkContext.broadcast(index)
    spread = spark.createDataFrame([(*cell, *span) for cell, span in spans.items()], "first int, second int, low int, high int")
    width = (F.col("high") - F.col("low") + 1).cast("long")
    stored = rows.join(F.broadcast(spread), ["first", "second"])
    stored = stored.select("row", "id", "label", "vec", (F.col("low") + F.pmod(F.xxhash64("row"), width)).cast("int").alias("block"))
    asking = rows.where("asks").select("row", "id", "label", "vec")
    parts = max(1, -(-asking.count() // ANCHORS))

    def blocks_of(asked: DataFrame, home: bool) -> DataFrame:
        """Which blocks each of ``asked`` (row, vec, least, home) goes to: the best one, or others that can reach ``least``."""

        def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                chosen = []
                for vec, least, first in zip(*(batch.column(k).to_pylist() for k in (1, 2, 3)), strict=True):
                    bound = model.value.block_bounds(np.frombuffer(vec))
                    chosen.append([int(bound.argmax())] if home else [b for b in np.flatnonzero(bound >= (-np.inf if least is None else least)).tolist() if b != first])
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(chosen, pa.list_(pa.int32()))], ["row", "blocks"])

        return asked.mapInArrow(returning(choose), "row long, blocks array<int>").select("row", F.explode("blocks").alias("block"))

    def search(asked: DataFrame, where: DataFrame, count: int, negative: bool) -> DataFrame:
        """Best rows of the named blocks; an anchor meets a block in one task, and only blocks that are asked for move."""
        part = F.pmod(F.xxhash64("row"), F.lit(parts)).cast("int")
        going = asked.join(where, "row").select("row", "id", "label", "vec", "windows", "block", part.alias("part"), F.lit(1).alias("kind"))
        copies = stored.join(going.select("block", "part").distinct(), "block")
        copies = copies.select("row", "id", "label", "vec", F.lit(None).cast("array<long>").alias("windows"), "block", "part", F.lit(0).alias("kind"))
        work = _search(model, count, negative, shares, dims)
        return cut_lineage(copies.union(going).groupBy("block", "part").applyInArrow(work, _FOUND))

    none = F.lit(None)
    asked = asking.withColumn("windows", none.cast("array<long>"))
    homes = cut_lineage(blocks_of(asking.select("row", "vec", none.cast("double").alias("least"), none.cast("int").alias("home")), True))

    def everywhere(asked: DataFrame, count: int, negative: bool, least: Column) -> DataFrame:
        """Home first; ``least`` says per (anchor, window) of what home gave how high another block must reach."""
        found = search(asked, homes, count, negative)
        if blocks == 1:
            return found
        reach = found.groupBy("anchor", "window").agg(F.count("*").alias("n"), F.min("score").alias("last")).withColumn("least", least)
        if negative:
            windows = asked.select("row", F.explode("windows").alias("window"))
            reach = windows.join(reach, (F.col("row") == F.col("anchor")) & windows["window"].eqNullSafe(reach["window"]), "left")
            reach = reach.select("row", F.coalesce("least", F.ceil(windows["window"] * shares[0] / 100)).cast("double").alias("least"))
        else:
            reach = reach.select(F.col("anchor").alias("row"), F.col("least").cast("double"))
        # a window that home did not fill has no last place yet
        reach = reach.groupBy("row").agg(F.when(F.count("least") == F.count("*"), F.min("least")).alias("least"))
        others = asked.select("row", "vec").join(reach, "row", "left").join(homes.withColumnRenamed("block", "home"), "row")
        return found.unionByName(search(asked, blocks_of(others.select("row", "vec", "least", "home"), False), count, negative))

    full = F.when(F.col("n") == positives, F.col("last"))
    best = cut_lineage(_first(everywhere(asked, positives, False, full), positives, "anchor"))
    scores = best.where("score >= 0").groupBy(F.col("anchor").alias("row")).agg(F.array_sort(F.collect_set("score")).alias("windows"))
    filled = F.when(F.col("n") == negatives, F.col("last"))
    other = everywhere(asking.join(scores, "row"), negatives, True, filled)
    ranked = _first(other, negatives, "anchor", "window").select("anchor", "window", "rank", F.col("id").alias("negative_id"), F.col("score").alias("negative_score"))
    pairs = best.select("anchor", F.col("id").alias("positive_id"), F.col("score").alias("positive_score"))
    joined = pairs.join(ranked.withColumnRenamed("anchor", "of"), (F.col("anchor") == F.col("of")) & (F.col("positive_score") == F.col("window")))
    named = joined.join(asking.select(F.col("row").alias("anchor"), F.col("id").alias("anchor_id")), "anchor")
    return named.select("anchor_id", "positive_id", F.col("rank").cast("int"), "negative_id", "positive_score", "negative_score")
