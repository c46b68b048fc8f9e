"""Text quality by logistic regression on hashed word n-grams."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from icuriver.llm.common import SLICE_BYTES, SpanHash, free_name, give_back, mix, prepare, returning, slices, text_bytes

#: Hashed weights; the model is this many 4-byte numbers.
BITS = 18
#: Labelled documents that a model is fitted on at most, those with the smallest id hashes.
SAMPLE = 8000
#: Tasks that fit on parts of the sample; their weights are averaged.
LEARNERS = 4
EPOCHS = 6
#: Follow-the-regularised-leader: rate, its offset, and the weights of the absolute and squared penalties.
ALPHA, BETA, L1, L2 = 0.4, 1.0, 0.05, 0.02
#: A feature's value is its share among those of its kind in the text times this.
SCALE = 6.0

_SPACE, _WORD, _NUMBER, _SIGN = range(4)
_KIND = np.full(256, _SIGN, np.uint8)
_KIND[[9, 10, 11, 12, 13, 32]] = _SPACE
_KIND[[*range(65, 91), *range(97, 123), *range(128, 256)]] = _WORD
_KIND[48:58] = _NUMBER
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def features(data: np.ndarray, borders: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """Hashed features of all tokens, one array for each kind of n-gram, and the texts' borders among the tokens.

    A token is a run of letters, of digits or of other signs. Kinds: the token itself, pairs of tokens,
    and runs of one and three token shapes. A shape is a token's case or, for signs, the signs, and
    whether the token repeats the one or two before it. N-grams stay within a text.
    """
    kind = _KIND[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[borders] = True
    change = np.flatnonzero(edge[:-1] | np.concatenate(([True], kind[1:] != kind[:-1]))) if len(data) else np.zeros(0, np.int64)
    ends = np.append(change[1:], len(data))
    token = kind[change] != _SPACE
    start, end = change[token], ends[token]
    among = np.searchsorted(start, borders)
    n = len(start)
    if not n:
        return [np.zeros(0, np.int64)] * 4, among
    literal = SpanHash(_LOWER[data]).of(start, end)
    what = kind[start]
    upper = np.concatenate(([0], np.cumsum((data >= 65) & (data <= 90))))
    capital = (data[start] >= 65) & (data[start] <= 90)
    more = upper[end] - upper[start] - capital
    shape = what.astype(np.uint64) + np.uint64(4) * capital + np.uint64(8) * (more > 0) + np.uint64(16) * ((more > 0) & (more >= end - start - 1))
    shape = np.where(what == _SIGN, literal, shape)
    first = np.zeros(n, bool)
    first[among[:-1][among[:-1] < n]] = True

    def before(x: np.ndarray, steps: int) -> np.ndarray:
        """The value some tokens earlier, 0 before the text's start."""
        for _ in range(steps):
            x = np.concatenate((np.zeros(1, np.uint64), x[:-1]))
            x[first] = 0
        return x

    one, two = before(literal, 1), before(literal, 2)
    shape = mix(shape + np.uint64(1 << 40) * (literal == one) + np.uint64(1 << 41) * (literal == two))
    keep = np.uint64((1 << BITS) - 1)
    kinds = [
        mix(literal ^ np.uint64(0xA1)),
        mix(literal * np.uint64(3) + one),
        mix(shape ^ np.uint64(0xB1)),
        mix(shape * np.uint64(5) + before(shape, 1) * np.uint64(3) + before(shape, 2) + np.uint64(0xC1)),
    ]
    return [(k & keep).astype(np.int32) for k in kinds], among


def sparse_rows(data: np.ndarray, borders: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Each text's distinct feature numbers, ascending, and their values."""
    kinds, among = features(data, borders)
    for k in range(len(borders) - 1):
        a, b = among[k], among[k + 1]
        index, count = np.unique(np.concatenate([x[a:b] for x in kinds]), return_counts=True)
        yield index, count * (SCALE / max(1, b - a))


def scores(data: np.ndarray, borders: np.ndarray, weights: np.ndarray, bias: float) -> np.ndarray:
    """Probability of label 1: the sparse dot product of shares and weights, token by token."""
    out = []
    for a, b in slices(borders, SLICE_BYTES // 2):
        kinds, among = features(data[borders[a] : borders[b]], borders[a : b + 1] - borders[a])
        total = np.zeros(len(kinds[0]) + 1)
        np.cumsum(sum(weights[k].astype(float) for k in kinds), out=total[1:])
        tokens = np.diff(among)
        out.append((total[among[1:]] - total[among[:-1]]) * SCALE / np.maximum(tokens, 1) + bias)
    z = np.concatenate(out) if out else np.zeros(0)
    return 1.0 / (1.0 + np.exp(-np.clip(z, -35, 35)))


class FollowTheLeader:
    """Follow-the-regularised-leader updates for logistic loss; weights stay zero until the evidence passes L1."""

    def __init__(self, size: int):
        self.z, self.n = np.zeros(size), np.zeros(size)

    def weights(self, index: np.ndarray | slice = slice(None)) -> np.ndarray:
        z, n = self.z[index], self.n[index]
        return np.where(np.abs(z) <= L1, 0.0, -(z - np.sign(z) * L1) / ((BETA + np.sqrt(n)) / ALPHA + L2))

    def learn(self, index: np.ndarray, value: np.ndarray, label: float, importance: float) -> None:
        w = self.weights(index)
        p = 1.0 / (1.0 + np.exp(-np.clip(w @ value, -35, 35)))
        g = (p - label) * importance * value
        more = self.n[index] + g * g
        self.z[index] += g - (np.sqrt(more) - np.sqrt(self.n[index])) / ALPHA * w
        self.n[index] = more


def fit_rows(rows: list[tuple[np.ndarray, np.ndarray, float]], epochs: int = EPOCHS) -> np.ndarray:
    """Weights from (feature numbers, values, label); the last weight is the bias. Both labels count the same in sum."""
    model = FollowTheLeader((1 << BITS) + 1)
    positive = sum(r[2] > 0 for r in rows)
    share = {1.0: len(rows) / 2 / max(1, positive), 0.0: len(rows) / 2 / max(1, len(rows) - positive)}
    order = np.random.default_rng(7)
    for _ in range(epochs):
        for k in order.permutation(len(rows)):
            index, value, label = rows[k]
            model.learn(np.append(index, 1 << BITS), np.append(value, 1.0), label, min(4.0, share[label]))
    return model.weights()


def held_out(id_column: str = "doc_id") -> Column:
    """A fifth of the ids, by checksum; never learned from. A null id is in no part."""
    return F.coalesce(F.crc32(F.col(id_column).cast("string")) % 5 == 0, F.lit(False))


def fit_quality(docs: DataFrame, labels: DataFrame, label: str = "quality", id_column: str = "doc_id", text_column: str = "text") -> np.ndarray:
    """Weights learned from labelled documents that are not held out; the last is the bias.

    At most ``SAMPLE`` labelled ids are used, those with the smallest hashes, so the sample does not
    depend on the order of rows. Rows without id or label are not learned from; a repeated label counts
    as its smallest value. Without labelled documents all weights are 0, so every score is 0.5.
    """
    prepare(docs.sparkSession)
    known = labels.where(F.col(id_column).isNotNull() & F.col(label).isNotNull() & ~held_out(id_column))
    known = known.groupBy(F.col(id_column).alias("id")).agg(F.min(F.col(label)).cast("double").alias("label"))
    known = known.orderBy(F.xxhash64("id"), "id").limit(SAMPLE)
    texts = docs.select(F.col(id_column).alias("id"), F.col(text_column).cast("string").alias("text"))
    texts = texts.join(F.broadcast(known), "id").select(F.xxhash64("id", "text").alias("row"), "label", "text")

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, borders = text_bytes(batch.column(2))
            rows = [r for a, b in slices(borders) for r in sparse_rows(data[borders[a] : borders[b]], borders[a : b + 1] - borders[a])]
            index = pa.array([r[0].astype(np.int32) for r in rows], pa.list_(pa.int32()))
            value = pa.array([r[1] for r in rows], pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), index, value], ["row", "label", "index", "value"])

    def learn(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values(["row", "label"])
        w = fit_rows(list(zip(part["index"], part["value"], part["label"], strict=True)))
        index = np.flatnonzero(w)
        give_back()
        return pd.DataFrame({"index": index.astype(np.int64), "weight": w[index]})

    rows = texts.mapInArrow(returning(vectors), "row long, label double, `index` array<int>, value array<double>")
    parts = rows.groupBy(F.pmod("row", F.lit(LEARNERS)).alias("learner")).applyInPandas(learn, "`index` long, weight double")
    weights = np.zeros((1 << BITS) + 1)
    for index, weight in parts.groupBy("index").agg((F.sum("weight") / LEARNERS).alias("weight")).collect():
        weights[index] = weight
    return np.round(weights, 6)


def quality_score(docs: DataFrame, weights: np.ndarray, text_column: str = "text") -> Column:
    """Score of each whole text, from 0 to 1, the larger the likelier label 1. A null text counts as empty.

    An empty text has no features: its score is that of the bias alone.
    """
    model = docs.sparkSession.sparkContext.broadcast((weights[:-1].astype(np.float32), float(weights[-1])))

    @F.arrow_udf("double")
    def score(text: pa.Array) -> pa.Array:
        found = pa.array(scores(*text_bytes(text), *model.value), pa.float64())
        give_back()
        return found

    return score(F.col(text_column).cast("string"))


def keep_good(docs: DataFrame, weights: np.ndarray, least: float = 0.3, text_column: str = "text") -> DataFrame:
    """Rows of ``docs`` whose text scores at least ``least``, columns as they were."""
    name = free_name(docs, "quality_score")
    return docs.withColumn(name, quality_score(docs, weights, text_column)).where(F.col(name) >= least).drop(name)
