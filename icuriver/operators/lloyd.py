"""K-means for one or many cluster counts at once, by rounds of mergeable vector sums."""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from icuriver.operators.states import CLUSTER_SIZES, information_criteria
from icuriver.session import cut_lineage

#: Rounds at most, and the squared shift of all centres, as a share of the mean variance, that ends them.
MAX_ROUNDS, TOLERANCE = 300, 1e-4
#: Distances that a task holds at once: few enough to stay in a core's cache.
BLOCK = 1 << 17

Centres = Mapping[int, np.ndarray]


def nearest_centres(x: np.ndarray, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Place and squared distance of each row's closest centre, the first at a tie.

    Products in single precision, of values shifted and scaled to the unit range, find it; where
    others are within their rounding of it, differences in double precision decide. Equal centres
    count once.
    """
    at = np.zeros(len(x), np.int64)
    _, first = np.unique(centres, axis=0, return_index=True)
    first.sort()
    several, dims = centres[first], centres.shape[1]
    middle = several.mean(axis=0)
    shifted, moved = x - middle, several - middle
    scale = max(np.abs(shifted).max(initial=0.0), np.abs(moved).max(initial=0.0)) or 1.0
    shifted, moved = shifted / scale, moved / scale
    square = (moved**2).sum(axis=1)
    # the last column brings in the square of the centre
    left = np.ones((len(x), dims + 1), np.float32)
    left[:, :dims] = shifted
    right = np.concatenate((-2 * moved, square[:, None]), axis=1).astype(np.float32).T
    reach = np.sqrt((shifted**2).sum(axis=1)) + np.sqrt(square.max(initial=0.0))
    room = (4 * (dims + 8) * 2.0**-24 * reach**2).astype(np.float32)
    step = max(1, BLOCK // len(several))
    for a in range(0, len(x), step):
        score = left[a : a + step] @ right
        rows = np.arange(len(score))
        own = score.argmin(axis=1)
        least = score[rows, own] + room[a : a + step]
        score[rows, own] = np.inf
        unsure = np.flatnonzero(score.min(axis=1) <= least)
        at[a : a + step] = own
        if len(unsure):
            score[unsure, own[unsure]] = -np.inf
            row, centre = np.nonzero(score[unsure] <= least[unsure, None])
            far = ((x[a + unsure[row]] - several[centre]) ** 2).sum(axis=1)
            order = np.lexsort((centre, far, row))
            at[a + unsure] = centre[order[np.searchsorted(row[order], np.arange(len(unsure)))]]
    at = first[at]
    return at, ((x - centres[at]) ** 2).sum(axis=1)


def _sums(centres: Centres, dims: int):
    """Of a task's rows, for each size and centre: members, sum of their vectors, sum of squared distances."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = {k: (np.zeros(len(c), np.int64), np.zeros(c.shape), np.zeros(len(c))) for k, c in centres.items()}
        for batch in batches:
            column = batch.column(0)
            if column.null_count or column.flatten().null_count or len(column.flatten()) != dims * len(column):
                raise ValueError("a vector is missing, incomplete or of another length")
            x = column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)
            if not np.isfinite(x).all():
                raise ValueError("a vector has a component that is not finite")
            across = np.ascontiguousarray(x.T)
            for k, (count, vectors, cost) in total.items():
                at, far = nearest_centres(x, centres[k])
                count += np.bincount(at, minlength=len(count))
                cost += np.bincount(at, weights=far, minlength=len(count))
                for i, part in enumerate(across):
                    vectors[:, i] += np.bincount(at, weights=part, minlength=len(count))
        rows = [(k, s) for k, (count, _, _) in total.items() for s in np.flatnonzero(count).tolist()]
        names = ["cluster_size", "state", "n", "vector", "cost"]
        kinds = [pa.int32(), pa.int32(), pa.int64(), pa.list_(pa.float64()), pa.float64()]
        columns = [[k for k, _ in rows], [s for _, s in rows], [int(total[k][0][s]) for k, s in rows], [total[k][1][s] for k, s in rows], [float(total[k][2][s]) for k, s in rows]]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names)

    return work


def _merged(rows: DataFrame, centres: Centres, dims: int) -> list:
    """One row for each size and centre that has members."""
    parts = rows.mapInArrow(_sums(centres, dims), "cluster_size int, state int, n long, vector array<double>, cost double")
    sums = F.array(*[F.sum(F.col("vector")[i]) for i in range(dims)])
    return parts.groupBy("cluster_size", "state").agg(F.sum("n").alias("n"), sums.alias("vector"), F.sum("cost").alias("cost")).collect()


def fit_sizes(
    df: DataFrame, features: str, key: str, sizes: Sequence[int], *, max_rounds: int = MAX_ROUNDS, tolerance: float = TOLERANCE
) -> dict[int, np.ndarray]:
    """Centres for each cluster count (F1; for many counts F3). Materialise ``df`` before the call.

    Rows start as centres in the order of the md5 of their ``key`` as text, so a repeated run, or another
    engine, starts alike. In a round every task adds up the vectors nearest to each centre, for all
    sizes that still move; only these sums are shuffled. A centre without members stays where it is. A
    size is settled when the squared shifts of its centres sum to at most ``tolerance`` times the mean
    variance of the components. Sizes above the number of rows are left out. The driver holds the
    centres: the sum of sizes times dimensions, whatever the number of rows. A vector that is missing or
    has a missing or non-finite component raises.
    """
    rows = df.select(F.col(features).cast("array<double>").alias("x"))
    first = df.select(F.col(features).cast("array<double>").alias("x"), F.md5(F.col(key).cast("string")).alias("h"), F.col(key).alias("k"))
    starts = first.orderBy("h", "k").limit(max(sizes)).select("x").collect()
    if not starts:
        return {}
    if any(r[0] is None or None in r[0] for r in starts):
        raise ValueError("a vector is missing or incomplete")
    begin = np.array([r[0] for r in starts])
    dims = begin.shape[1]
    whole = _merged(rows, {1: np.zeros((1, dims))}, dims)[0]
    variance = whole["cost"] / whole["n"] - float(((np.array(whole["vector"]) / whole["n"]) ** 2).sum())
    limit = tolerance * variance / dims
    centres = {k: begin[:k].copy() for k in sorted(set(sizes)) if k <= len(begin)}
    moving = set(centres)
    for _ in range(max_rounds):
        if not moving:
            break
        fresh = {k: centres[k].copy() for k in moving}
        for r in _merged(rows, {k: centres[k] for k in moving}, dims):
            fresh[r["cluster_size"]][r["state"]] = np.array(r["vector"]) / r["n"]
        shift = {k: float(((fresh[k] - centres[k]) ** 2).sum()) for k in moving}
        centres |= fresh
        moving = {k for k in moving if shift[k] > limit}
    return centres


def fit_states(df: DataFrame, features: str, key: str, k: int, *, max_rounds: int = MAX_ROUNDS, tolerance: float = TOLERANCE) -> DataFrame:
    """Centre table (state, centre) of one cluster count (F1); ``states.assign_nearest`` labels rows by it."""
    found = fit_sizes(df, features, key, [k], max_rounds=max_rounds, tolerance=tolerance)
    if k not in found:
        raise ValueError(f"{k} clusters need as many rows")
    return df.sparkSession.createDataFrame([(i, c.tolist()) for i, c in enumerate(found[k])], "state int, centre array<double>")


def sweep_sizes(
    df: DataFrame, features: str, key: str, sizes: Sequence[int] = CLUSTER_SIZES, *, max_rounds: int = MAX_ROUNDS, tolerance: float = TOLERANCE
) -> DataFrame:
    """(cluster_size, bic, aic, wss) of every cluster count up to the number of rows (F3), fitted together.

    All sizes share each pass over the rows; a last pass measures the distances to the settled centres.
    """
    rows = cut_lineage(df.select(features, key))
    centres = fit_sizes(rows, features, key, sizes, max_rounds=max_rounds, tolerance=tolerance)
    spark = df.sparkSession
    if not centres:
        return information_criteria(spark.createDataFrame([], "cluster_size int, wss double"), 0, F.lit(0))
    dims = next(iter(centres.values())).shape[1]
    cost, n = dict.fromkeys(centres, 0.0), dict.fromkeys(centres, 0)
    for r in _merged(rows.select(F.col(features).cast("array<double>").alias("x")), centres, dims):
        cost[r["cluster_size"]] += r["cost"]
        n[r["cluster_size"]] += r["n"]
    costs = spark.createDataFrame(list(cost.items()), "cluster_size int, wss double")
    return information_criteria(costs, dims, F.lit(max(n.values())))
