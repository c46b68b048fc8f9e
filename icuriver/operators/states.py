"""Clustering windows into states and comparing labelings."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.ml.feature import PCA, PCAModel, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

CLUSTER_SIZES = (10, *range(50, 1000, 50))
#: Distances that a task holds at once.
BLOCK = 1 << 20
#: Tasks of a round of k-means for each core, at most.
ROUND_TASKS = 2


def feature_array(columns: Sequence[str]) -> Column:
    return F.array(*[F.col(c).cast("double") for c in columns])


def as_vectors(df: DataFrame, columns: Sequence[str], out: str = "features") -> DataFrame:
    """Assemble numeric columns; a non-numeric column or a missing value is an error."""
    wrong = [c for c in columns if not isinstance(df.schema[c].dataType, T.NumericType)]
    if wrong:
        raise ValueError(f"columns that are not numerical cannot be clustered: {wrong}")
    return VectorAssembler(inputCols=list(columns), outputCol=out, handleInvalid="error").transform(df)


def fit_kmeans(vectors: DataFrame, k: int, *, seed: int = 42, features: str = "features", max_iter: int = 300) -> KMeansModel:
    """Parallel k-means++ start, fixed seed (F1). Cache ``vectors`` before the call, in ``few_parts``.

    Rounds go by blocks: the row solver gives the same centres, but each of its rounds starts a task
    for each centre that measures the distances between them, once k * k * dimensions reach a million.
    """
    return KMeans(k=k, seed=seed, initMode="k-means||", featuresCol=features, predictionCol="state", maxIter=max_iter, solver="block").fit(vectors)


def few_parts(df: DataFrame) -> DataFrame:
    """``df`` in at most ROUND_TASKS partitions a core, as every task of every round reports to the driver.

    Apply it to a table as read: the start of a fit depends on the partitions, and those of a cached
    frame would be joined by where they happen to lie.
    """
    most = ROUND_TASKS * df.sparkSession.sparkContext.defaultParallelism
    return df.coalesce(most) if df.rdd.getNumPartitions() > most else df


def centres_frame(df: DataFrame, model: KMeansModel) -> DataFrame:
    """Centre table (state, centre); k rows."""
    rows = [(i, [float(v) for v in c]) for i, c in enumerate(model.clusterCenters())]
    return df.sparkSession.createDataFrame(rows, "state int, centre array<double>")


def _centre_matrix(centres: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    rows = centres.select("state", "centre").orderBy("state").collect()
    return np.array([r["state"] for r in rows]), np.array([r["centre"] for r in rows], dtype=float)


def _row_slices(batch: pd.Series, n_centres: int) -> Iterator[np.ndarray]:
    """The batch's vectors, as many at once as have at most BLOCK distances to all centres."""
    step = max(1, BLOCK // max(1, n_centres))
    for a in range(0, len(batch), step):
        yield np.stack(batch.iloc[a : a + step].to_numpy()).astype(float)


def _squared_distances(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    out = np.zeros((len(x), len(centres)))
    for j in range(centres.shape[1]):
        out += (x[:, j, None] - centres[None, :, j]) ** 2
    return out


def _nearest(x: np.ndarray, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Place and squared distance of each row's closest centre, the first at a tie, centre block by block."""
    place, least = np.zeros(len(x), np.int64), np.full(len(x), np.inf)
    for a in range(0, len(centres), BLOCK):
        d = _squared_distances(x, centres[a : a + BLOCK])
        at = d.argmin(axis=1)
        d = d[np.arange(len(x)), at]
        nearer = d < least
        place[nearer], least[nearer] = a + at[nearer], d[nearer]
    return place, least


def assign_nearest(df: DataFrame, centres: DataFrame, features: str, out: str = "state") -> DataFrame:
    """Index of the closest centre, ties to the lowest (F2).

    ``features`` is an array column. Centres are the k rows of a model, shipped with the
    vectorised function; distances are held for a block of rows and centres at a time.
    """
    labels, matrix = _centre_matrix(centres)

    @F.pandas_udf("int")
    def nearest(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            found = [_nearest(x, matrix)[0] for x in _row_slices(batch, len(matrix))]
            yield pd.Series(labels[np.concatenate(found)] if found else [], dtype="int32")

    return df.withColumn(out, nearest(F.col(features).cast("array<double>")))


def evaluate_sizes(vectors: DataFrame, n_features: int, sizes: Sequence[int] = CLUSTER_SIZES, seed: int = 42) -> DataFrame:
    """Within-cluster squares, AIC and BIC for several k (F3). Cache ``vectors`` first."""
    n = vectors.count()
    rows = [(k, float(fit_kmeans(vectors, k, seed=seed).summary.trainingCost)) for k in sizes]
    costs = vectors.sparkSession.createDataFrame(rows, "cluster_size int, wss double")
    return information_criteria(costs, n_features, F.lit(n))


def information_criteria(costs: DataFrame, n_features: int, n: Column) -> DataFrame:
    """AIC and BIC from (cluster_size, wss); log-likelihood is -wss / 2."""
    params = F.col("cluster_size") * n_features + F.col("cluster_size")
    return costs.select(
        "cluster_size",
        (params * F.log(n) + F.col("wss")).alias("bic"),
        (2 * params + F.col("wss")).alias("aic"),
        "wss",
    )


def within_squares(df: DataFrame, centres: DataFrame, features: str) -> DataFrame:
    """Sum of squared distances to the nearest of given centres, one row."""
    _, matrix = _centre_matrix(centres)

    @F.pandas_udf("double")
    def best(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            found = [_nearest(x, matrix)[1] for x in _row_slices(batch, len(matrix))]
            yield pd.Series(np.concatenate(found) if found else [], dtype=float)

    scored = df.select(best(F.col(features).cast("array<double>")).alias("d"))
    return scored.agg(F.sum("d").alias("wss"), F.count(F.lit(1)).alias("n"))


def cluster_means(df: DataFrame, columns: Sequence[str], state: str = "state") -> DataFrame:
    """Centre as the mean of members, and size."""
    return df.groupBy(state).agg(*[F.avg(c).alias(c) for c in columns], F.count(F.lit(1)).alias("size"))


def fit_pca(df: DataFrame, columns: Sequence[str], k: int) -> tuple[DataFrame, PCAModel]:
    """Centred features and the components fitted on them (one row of means moves)."""
    means = df.agg(F.struct(*[F.avg(c).alias(c) for c in columns])).scalar()
    centred = df.withColumn("_mean", means).withColumns(
        {f"_c_{c}": F.col(c).cast("double") - F.col("_mean")[c] for c in columns}
    )
    vectors = as_vectors(centred, [f"_c_{c}" for c in columns], "_centred")
    return vectors, PCA(k=k, inputCol="_centred", outputCol="_projected").fit(vectors)


def principal_components(df: DataFrame, columns: Sequence[str], k: int = 3, keep: Sequence[str] = ()) -> DataFrame:
    """Projection to k dimensions of centred data.

    The sign of a component is fixed so that its largest loading is positive.
    """
    vectors, model = fit_pca(df, columns, k)
    loadings = model.pc.toArray()
    signs = [1.0 if loadings[np.abs(loadings[:, j]).argmax(), j] >= 0 else -1.0 for j in range(k)]
    flat = model.transform(vectors).withColumn("_p", vector_to_array("_projected"))
    return flat.select(*keep, *[(F.col("_p")[j] * signs[j]).alias(f"pca_{j + 1}") for j in range(k)])


def labeling_agreement(df: DataFrame, first: str, second: str) -> DataFrame:
    """Normalised mutual information and adjusted Rand index.

    Everything comes from the contingency table, which has at most (labels x labels)
    rows.
    """
    cells = df.dropna(subset=[first, second]).groupBy(F.col(first).alias("a"), F.col(second).alias("b")).agg(
        F.count(F.lit(1)).cast("double").alias("n")
    )
    rows = cells.groupBy("a").agg(F.sum("n").alias("ra"))
    cols = cells.groupBy("b").agg(F.sum("n").alias("cb"))
    total = cells.agg(F.sum("n")).scalar()

    def pairs(x: Column) -> Column:
        return F.sum(x * (x - 1) / 2)

    def entropy(x: Column) -> Column:
        return -F.sum(x / F.col("_t") * F.log(x / F.col("_t")))

    t = F.col("_t")
    mutual = (
        cells.join(rows, "a").join(cols, "b").withColumn("_t", total).agg(
            F.struct(
                F.sum(F.col("n") / t * F.log(F.col("n") * t / (F.col("ra") * F.col("cb")))).alias("mi"),
                pairs(F.col("n")).alias("pairs"),
            )
        ).scalar()
    )
    left = rows.withColumn("_t", total).agg(F.struct(entropy(F.col("ra")).alias("h"), pairs(F.col("ra")).alias("pairs"))).scalar()
    right = cols.withColumn("_t", total).agg(F.struct(entropy(F.col("cb")).alias("h"), pairs(F.col("cb")).alias("pairs"))).scalar()
    frame = df.sparkSession.range(1).select(
        mutual.alias("m"), left.alias("l"), right.alias("r"), total.alias("t")
    )
    every = F.col("t") * (F.col("t") - 1) / 2
    expected = F.try_divide(F.col("l.pairs") * F.col("r.pairs"), every)
    upper = (F.col("l.pairs") + F.col("r.pairs")) / 2
    nmi = F.try_divide(F.col("m.mi"), (F.col("l.h") + F.col("r.h")) / 2)
    return frame.select(
        F.coalesce(nmi, F.lit(1.0)).alias("nmi"),
        F.coalesce(F.try_divide(F.col("m.pairs") - expected, upper - expected), F.lit(1.0)).alias("ari"),
    )


def soft_assignment(df: DataFrame, centres: DataFrame, features: str, *, alpha: float = 1.0, out: str = "weights") -> DataFrame:
    """exp(-alpha (d - d_min)) over its sum plus 1e-8, one weight per centre."""
    _, matrix = _centre_matrix(centres)

    @F.pandas_udf("array<double>")
    def weigh(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            found = []
            for x in _row_slices(batch, len(matrix)):
                d = np.sqrt(_squared_distances(x, matrix))
                power = np.exp(-alpha * (d - d.min(axis=1, keepdims=True)))
                found += list(power / (power.sum(axis=1, keepdims=True) + 1e-8))
            yield pd.Series(found, dtype=object)

    return df.withColumn(out, weigh(F.col(features).cast("array<double>")))


def clustering_loss(
    df: DataFrame,
    centres: DataFrame,
    embedded: str,
    *,
    original: str | None = None,
    rebuilt: str | None = None,
    alpha: float = 1.0,
    weight: float = 1.0,
) -> DataFrame:
    """Mean soft distance to the centres, reconstruction error and their sum (F8)."""
    _, matrix = _centre_matrix(centres)

    @F.pandas_udf("double")
    def soft_distance(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            found = []
            for x in _row_slices(batch, len(matrix)):
                d = np.sqrt(_squared_distances(x, matrix))
                power = np.exp(-alpha * d)
                found.append((d * power / (power.sum(axis=1, keepdims=True) + 1e-8)).sum(axis=1))
            yield pd.Series(np.concatenate(found) if found else [], dtype=float)

    error = F.lit(0.0)
    if original is not None and rebuilt is not None:
        squares = F.zip_with(original, rebuilt, lambda a, b: (a - b) * (a - b))
        error = F.aggregate(squares, F.lit(0.0), lambda s, v: s + v) / F.size(original)
    scored = df.select(soft_distance(F.col(embedded).cast("array<double>")).alias("c"), error.alias("r"))
    cluster, rec = F.avg("c"), F.avg("r")
    return scored.agg(
        (rec + weight * cluster).alias("loss"), rec.alias("loss_reconstruction"), cluster.alias("loss_clustering")
    )


def embed_and_cluster(
    train: DataFrame, columns: Sequence[str], *, dims: int = 8, k: int = 10, seed: int = 42, keep: Sequence[str] = ()
) -> tuple[DataFrame, DataFrame]:
    """Linear embedding of the features, reconstruction and nearest centre.

    Returns the rows with ``embedding``, ``original``, ``rebuilt`` and ``state``, and
    the centre table.
    """
    vectors, model = fit_pca(train, columns, dims)
    loadings = model.pc.toArray()
    projected = model.transform(vectors).withColumnRenamed("_projected", "_vec")
    kmeans = fit_kmeans(projected, k, seed=seed, features="_vec")
    centres = centres_frame(train, kmeans)
    rows = kmeans.transform(projected).select(
        *keep,
        vector_to_array("_vec").alias("embedding"),
        vector_to_array("_centred").alias("original"),
        "state",
    )

    @F.pandas_udf("array<double>")
    def rebuild(batch: pd.Series) -> pd.Series:
        x = np.array(batch.tolist(), dtype=float).reshape(len(batch), -1)
        return pd.Series(list(x @ loadings.T))

    return rows.withColumn("rebuilt", rebuild("embedding")), centres


def array_vectors(df: DataFrame, column: str, out: str = "features") -> DataFrame:
    return df.withColumn(out, array_to_vector(F.col(column).cast("array<double>")))


def best_trial(trials: DataFrame, value: str = "value") -> DataFrame:
    """Row with the lowest validation value."""
    rank = F.struct(F.col(value), F.col("number"))
    return trials.where(F.col(value).isNotNull()).agg(F.min_by(F.struct("*"), rank).alias("t")).select("t.*")


def trial_leaderboard(trials: DataFrame, params: Sequence[str], value: str = "value") -> DataFrame:
    """Best, mean and count of the validation value per parameter setting."""
    cells = F.array(
        *[F.struct(F.lit(p).alias("parameter"), F.col(p).cast("string").alias("setting")) for p in params]
    )
    return (
        trials.where(F.col(value).isNotNull())
        .select(F.explode(cells).alias("c"), F.col(value).alias("v"))
        .groupBy("c.parameter", "c.setting")
        .agg(F.min("v").alias("best"), F.avg("v").alias("mean"), F.count("v").alias("trials"))
    )
