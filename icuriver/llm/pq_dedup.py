"""Near-duplicate embeddings through inverted lists with product-quantised residuals."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from icuriver.llm.common import components, prepare, returning
from icuriver.session import cut_lineage

#: Vectors that the lists and codebooks are fitted on at most, those with the smallest hashes.
SAMPLE = 32_768
#: Vectors for each list, and lists at most.
PER_LIST, LISTS = 400, 2048
#: Parts of a residual and codewords of a part.
SUBSPACES, CODEWORDS = 8, 256
#: Vectors of a block at most and at least; a task compares two blocks.
BLOCK, LEAST_BLOCK = 16_384, 512
#: Blocks at least, so that small tables use several cores.
BLOCKS = 8
#: Vectors that are compared with a list at once.
CHUNK = 64


def k_means(x: np.ndarray, k: int, rounds: int = 10, seed: int = 3) -> np.ndarray:
    k = min(k, len(x))
    centres = x[np.sort(np.random.default_rng(seed).choice(len(x), k, replace=False))].copy()
    for _ in range(rounds):
        near = nearest(x, centres)
        count = np.bincount(near, minlength=k)
        total = np.stack([np.bincount(near, weights=x[:, d], minlength=k) for d in range(x.shape[1])], axis=1)
        centres[count > 0] = total[count > 0] / count[count > 0, None]
    return centres


def nearest(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    half = (centres**2).sum(axis=1) / 2
    return np.concatenate([(half - x[a : a + 4096] @ centres.T).argmin(axis=1) for a in range(0, len(x), 4096)] or [np.zeros(0, np.int64)])


@dataclass
class Index:
    """Lists, codebooks of the residuals and the distance within which vectors link."""

    centres: np.ndarray
    books: np.ndarray  # subspace, codeword, dimension
    radius: float

    @classmethod
    def fit(cls, x: np.ndarray, lists: int, least: float) -> Index:
        dims = x.shape[1]
        parts = max(p for p in range(1, SUBSPACES + 1) if dims % p == 0)
        centres = k_means(x, lists)
        rest = (x - centres[nearest(x, centres)]).reshape(len(x), parts, -1)
        books = np.stack([k_means(rest[:, m], CODEWORDS) for m in range(parts)])
        return cls(centres, books, float(np.sqrt(max(0.0, 2 - 2 * least))) + 1e-6)

    def encode(self, x: np.ndarray, lists: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Codes of unit vectors of ``lists``, the squared length of what they decode to and its distance to the vector."""
        parts = len(self.books)
        rest = (x - self.centres[lists]).reshape(len(x), parts, -1)
        codes = np.stack([nearest(rest[:, m], self.books[m]) for m in range(parts)], axis=1).astype(np.uint8)
        back = self.centres[lists] + np.concatenate([self.books[m][codes[:, m]] for m in range(parts)], axis=1)
        return codes, (back**2).sum(axis=1), np.sqrt(((x - back) ** 2).sum(axis=1))

    def beyond(self, x: np.ndarray, own: np.ndarray, lists: np.ndarray) -> np.ndarray:
        """Distance of each vector, whose list is ``own``, to the planes halfway to the centres of ``lists``.

        A vector of another list lies beyond that plane by its own distance to it, so the sum of both
        distances is a lower bound of how far two vectors of different lists are apart.
        """
        square = (self.centres**2).sum(axis=1)
        far = square[lists] - 2 * x @ self.centres[lists].T
        apart = np.sqrt(np.maximum(square[own][:, None] + square[lists] - 2 * self.centres[own] @ self.centres[lists].T, 0))
        far -= (square[own] - 2 * np.einsum("ij,ij->i", x, self.centres[own]))[:, None]
        return np.where(apart > 1e-6, far / (2 * np.maximum(apart, 1e-6)), 0)

    def probes(self, x: np.ndarray, own: np.ndarray) -> np.ndarray:
        """Which lists can hold a vector within the radius of each unit vector: those whose plane is within it."""
        return self.beyond(x, own, np.arange(len(self.centres))) <= self.radius


def unit(vectors: np.ndarray) -> np.ndarray:
    return vectors / np.sqrt((vectors**2).sum(axis=1))[:, None]


@dataclass
class Block:
    """Unit vectors with their lists and the number of rows that each stands for."""

    x: np.ndarray
    lists: np.ndarray
    weight: np.ndarray

    def members(self) -> dict[int, np.ndarray]:
        return {int(v): np.flatnonzero(self.lists == v) for v in np.unique(self.lists)}


def _links(index: Index, least: float, one: Block, two: Block | None) -> tuple[np.ndarray, list[tuple[int, int]]]:
    """Links between two blocks, or within one: linked rows of each vector, and as many pairs as connect the same vectors.

    Vectors are numbered through both blocks. Each pair is looked at once and counted for both ends.
    """
    other = one if two is None else two
    shift, total = (0, len(one.x)) if two is None else (len(one.x), len(one.x) + len(two.x))
    count, label = np.zeros(total, np.int64), np.arange(total)
    edges: list[tuple[int, int]] = []
    codes, square, error = index.encode(other.x, other.lists)
    reach = ((index.radius + error + 1e-4) ** 2).astype(np.float32)
    parts, width = len(index.books), one.x.shape[1] // len(index.books)
    theirs = other.members()
    targets = np.array(list(theirs), np.int64)
    ours = one.members()
    here = {own: index.beyond(one.x[mine], one.lists[mine], targets) for own, mine in ours.items()}
    for k, (v, of) in enumerate(theirs.items()):
        back = index.beyond(other.x[of], other.lists[of], np.array(list(ours), np.int64))
        for c, (own, mine) in enumerate(ours.items()):
            if two is None and own > v:
                continue
            alone = two is None and own == v
            order, past = np.argsort(here[own][:, k], kind="stable"), np.argsort(back[:, c], kind="stable")
            a_past, b_past = here[own][order, k], back[past, c]
            for s in range(0, len(mine), CHUNK):
                some = order[s : s + CHUNK]
                rest = past[: np.searchsorted(b_past, index.radius - a_past[s], "right")]
                if not len(rest):
                    break
                q, at = one.x[mine[some]], of[rest]
                inner = np.zeros((len(q), len(at)), np.float32)
                for m in range(parts):
                    inner += (q[:, m * width : (m + 1) * width] @ index.books[m].T).astype(np.float32)[:, codes[at, m]]
                inner += (q @ index.centres[v]).astype(np.float32)[:, None]
                i, j = np.nonzero((1 + square[at]).astype(np.float32) - 2 * inner <= reach[at])
                if not len(i):
                    continue
                if len(i) > len(q) * len(at) // 8:
                    cosine = (q @ other.x[at].T)[i, j]
                else:
                    cosine = np.einsum("ij,ij->i", q[i], other.x[at[j]])
                a, b = mine[some[i]], at[j]
                good = cosine >= least
                if alone:
                    good &= a < b
                _take(a[good], b[good], one.weight, other.weight, shift, count, label, edges)
    return count, edges


def _take(a: np.ndarray, b: np.ndarray, a_weight: np.ndarray, b_weight: np.ndarray, shift: int, count: np.ndarray, label: np.ndarray, edges: list[tuple[int, int]]) -> None:
    """Count links and join the labels of their ends; those that joined two labels go to ``edges``."""
    if not len(a):
        return
    count += np.bincount(a, weights=b_weight[b], minlength=len(count)).astype(np.int64)
    count += np.bincount(b + shift, weights=a_weight[a], minlength=len(count)).astype(np.int64)
    b = b + shift
    open_ = np.flatnonzero(label[a] != label[b])
    if not len(open_):
        return
    a, b = a[open_], b[open_]
    cuts = np.flatnonzero(np.diff(a, prepend=-1))
    for s, e in zip(cuts.tolist(), np.append(cuts[1:], len(a)).tolist(), strict=True):
        own = label[a[s]]
        others, first = np.unique(label[b[s:e]], return_index=True)
        edges += [(int(a[s]), int(b[s + f])) for o, f in zip(others.tolist(), first.tolist(), strict=True) if o != own]
        if len(others) > 1 or others[0] != own:
            label[np.isin(label, others)] = own


def _valid(vec: pa.Array) -> list[np.ndarray | None]:
    out = []
    for v in vec:
        v = v.values if v.is_valid else None
        x = v.to_numpy(zero_copy_only=False).astype(float) if v is not None and len(v) and not v.null_count else None
        out.append(x if x is not None and np.isfinite(x).all() and np.isfinite(s := (x**2).sum()) and s > 0 else None)
    return out


def near_vectors(vectors: DataFrame, least: float = 0.95, id_column: str = "vec_id", vector_column: str = "embedding") -> DataFrame:
    """(id, n_links, component_id, kept) of every row, linked where the cosine in double precision is at least ``least``.

    Null, empty and zero vectors and those with null or non-finite components link with nothing, nor do
    vectors whose length differs from the most frequent one in the sample. Rows equal in id and vector
    are one vector, returned as often as it is there; rows that share only the id are several. A null id
    is a vector like others but never names a component that has an id.

    All vectors are indexed and all are queries. Equal vectors are one that stands for several rows.
    Lists are dealt to blocks; a list longer than a block is spread over several. A vector goes to the
    blocks of lists that can hold a vector within the radius, where it meets the vectors of that block
    which can reach its own list, so a pair of blocks sees each link once and counts it for both ends.
    Planes between lists and table-lookup distances less the stored error of each code are lower bounds,
    so no link is lost; every candidate is measured exactly. Only spanning links leave a task.
    """
    spark = prepare(vectors.sparkSession)

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [None if v is None else v.tobytes() for v in _valid(batch.column(2))]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(found, pa.binary())], ["row", "id", "vec"])

    keyed = vectors.select(F.xxhash64(id_column, vector_column).alias("row"), F.col(id_column).cast("long").alias("id"), vector_column)
    parsed = keyed.mapInArrow(returning(parse), "row long, id long, vec binary").withColumn("vertex", F.when(F.col("vec").isNotNull(), F.xxhash64("vec")))
    parsed = cut_lineage(parsed)
    rows = parsed.select("row", "id", "vertex")
    distinct = parsed.where("vec is not null").groupBy("vertex", "row").agg(F.first("vec").alias("vec"))
    distinct = cut_lineage(distinct.groupBy("vertex").agg(F.first("vec").alias("vec"), F.count("*").alias("weight")))
    n = distinct.count()
    lone = rows.select(F.col("id").alias(id_column), F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"), F.lit(True).alias("kept"))
    if not n:
        return lone
    sample = [np.frombuffer(r[0]) for r in distinct.orderBy(F.xxhash64("vertex"), "vertex").limit(SAMPLE).select("vec").collect()]
    dims = Counter(map(len, sample)).most_common(1)[0][0]
    distinct = distinct.where(F.octet_length("vec") == 8 * dims)
    fitted = Index.fit(unit(np.stack([v for v in sample if len(v) == dims])), min(LISTS, max(1, n // PER_LIST)), least)
    model = spark.sparkContext.broadcast(fitted)

    def units(column: pa.Array) -> np.ndarray:
        return unit(np.frombuffer(b"".join(column.to_pylist())).reshape(-1, dims)) if len(column) else np.zeros((0, dims))

    def sizes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(len(model.value.centres), np.int64)
        for batch in batches:
            seen += np.bincount(nearest(units(batch.column(0)), model.value.centres), minlength=len(seen))
        yield pa.RecordBatch.from_arrays([pa.array(np.flatnonzero(seen), pa.int32()), pa.array(seen[seen > 0], pa.int64())], ["list", "n"])

    held = dict(distinct.select("vec").mapInArrow(returning(sizes), "list int, n long").groupBy("list").agg(F.sum("n")).collect())  # one row for each list
    block = max(LEAST_BLOCK, min(BLOCK * 64 // max(64, dims), -(-n // BLOCKS)))
    order = np.argsort(fitted.centres @ np.linalg.svd(fitted.centres - fitted.centres.mean(axis=0), full_matrices=False)[2][0])
    begin, end, upto = np.zeros(len(order), np.int64), np.zeros(len(order), np.int64), 0
    for v in order.tolist():
        begin[v], end[v] = upto // block, max(upto, upto + held.get(v, 0) - 1) // block
        upto += held.get(v, 0)
    filled = np.array([v in held for v in range(len(order))])

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = model.value
        for batch in batches:
            for s in range(0, batch.num_rows, 1024):
                part = batch.slice(s, 1024)
                x = units(part.column(1))
                own = nearest(x, index.centres)
                home = begin[own] + part.column(0).to_numpy().view(np.uint64) % (end[own] - begin[own] + 1).astype(np.uint64)
                met = []
                for p in index.probes(x, own) & filled:
                    lists = np.flatnonzero(p)
                    met.append(np.unique(np.concatenate([np.arange(a, b + 1) for a, b in set(zip(begin[lists].tolist(), end[lists].tolist(), strict=True))])).astype(np.int32))
                dealt = [*part.columns, pa.array(own, pa.int32()), pa.array(home.astype(np.int32)), pa.array(met, pa.list_(pa.int32()))]
                yield pa.RecordBatch.from_arrays(dealt, ["vertex", "vec", "weight", "list", "home", "met"])

    cells = distinct.select("vertex", "vec", "weight").mapInArrow(returning(deal), "vertex long, vec binary, weight long, list int, home int, met array<int>")
    cells = cells.withColumn("other", F.explode("met")).select("vertex", "vec", "weight", "list", "home", F.least("home", "other").alias("i"), F.greatest("home", "other").alias("j"))

    def compare(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        vertex, home, low = (table.column(c).to_numpy() for c in ("vertex", "home", "i"))
        order = np.lexsort((vertex, home))
        x, lists, weight = units(table.column("vec"))[order], table.column("list").to_numpy()[order], table.column("weight").to_numpy()[order]
        cut = int((home == low[0]).sum())
        blocks = [Block(x[:cut], lists[:cut], weight[:cut]), Block(x[cut:], lists[cut:], weight[cut:])]
        apart = table.column("j")[0].as_py() > low[0]
        count, edges = np.zeros(len(x), np.int64), []
        if not apart or 0 < cut < len(x):
            count, edges = _links(model.value, least, blocks[0], blocks[1] if apart else None)
        vertex, linked = vertex[order], np.flatnonzero(count)
        ends = vertex[np.array(edges, np.int64).reshape(-1, 2)]
        return pa.table({
            "a": pa.array(np.concatenate((vertex[linked], ends[:, 0])), pa.int64()),
            "b": pa.array([None] * len(linked) + ends[:, 1].tolist(), pa.int64()),
            "n": pa.array(np.concatenate((count[linked], np.zeros(len(ends), np.int64))), pa.int64()),
        })

    found = cut_lineage(cells.groupBy("i", "j").applyInArrow(compare, "a long, b long, n long"))
    links = found.where("b is null").groupBy("a").agg(F.sum("n").alias("n"))
    joined = components(found.where("b is not null")).select(F.col("id").alias("c"), "component")
    per = distinct.select("vertex", "weight").join(links, F.col("vertex") == F.col("a"), "left").join(joined, F.col("vertex") == F.col("c"), "left")
    per = per.select(F.col("vertex").alias("a"), (F.coalesce("n", F.lit(0)) + F.col("weight") - 1).alias("n_links"), F.coalesce("component", "vertex").alias("component"))
    # a vector that links with nothing is a component by its row
    placed = rows.join(per, F.col("vertex") == F.col("a"), "left")
    placed = placed.select("id", F.coalesce("n_links", F.lit(0)).alias("n_links"), F.col("component").isNotNull().alias("valid"), F.coalesce("component", "row").alias("component"))
    least_id = placed.groupBy("valid", "component").agg(F.min("id").alias("component_id"))
    out = placed.join(least_id, ["valid", "component"])
    return out.select(F.col("id").alias(id_column), "n_links", "component_id", (F.col("id").eqNullSafe(F.col("component_id"))).alias("kept"))
