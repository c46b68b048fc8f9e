"""Ranked search of short texts in all documents through hashed max-sketches and exact rescoring."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from icuriver.llm.common import SpanHash, prepare, returning, slices, text_bytes
from icuriver.session import cut_lineage

#: Coordinates of a document's sketch.
WIDTH = 4096
#: Documents whose sketches a task holds at once.
TOGETHER = 1024
#: Documents rescored before the threshold is looked at again.
CHUNK = 48
#: (item, term) rows searched for at once; what is beyond them is a further block.
BLOCK_TERMS = 200_000
#: Characters between terms.
BREAKS = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"

_IS_TERM = np.zeros(256, bool)
_IS_TERM[48:58] = _IS_TERM[65:91] = _IS_TERM[97:123] = _IS_TERM[128:] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def terms_of(text: Column) -> Column:
    """Terms of a text in their order: runs of ASCII letters, digits and other signs than ASCII ones, only A-Z lower-cased."""
    upper = "".join(map(chr, range(65, 91)))
    return F.regexp_extract_all(F.translate(text, upper, upper.lower()), F.lit(BREAKS), F.lit(0))


def term_spans(data: np.ndarray, borders: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of all terms; none crosses a border between texts."""
    inside = np.concatenate(([False], _IS_TERM[data], [False]))
    edge = np.zeros(len(data) + 1, bool)
    edge[borders] = True
    start = np.flatnonzero(inside[1:-1] & (~inside[:-2] | edge[:-1]))
    end = np.flatnonzero(inside[1:-1] & (~inside[2:] | edge[1:])) + 1
    return start, end


def _ragged(begin: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Places begin, begin + 1 ... of all spans end to end."""
    return np.repeat(begin - (np.cumsum(length) - length), length) + np.arange(int(length.sum()))


@dataclass
class Searched:
    """Terms searched for, with their bytes, and the items that hold them: rows of (item, term, number)."""

    data: np.ndarray
    begin: np.ndarray
    length: np.ndarray
    hashes: np.ndarray  # ascending, as all arrays by term
    item: np.ndarray  # ascending
    term: np.ndarray
    number: np.ndarray
    items: int

    @classmethod
    def of(cls, rows: list[tuple[int, str, int]], items: int) -> Searched:
        raw = sorted({t for _, t, _ in rows})
        raw = [t.encode() for t in raw]
        length = np.array([len(t) for t in raw], np.int64)
        begin = np.cumsum(length) - length
        data = np.frombuffer(b"".join(raw), np.uint8)
        hashes = SpanHash(data).of(begin, begin + length)
        order = np.argsort(hashes, kind="stable")
        place = {raw[k]: n for n, k in enumerate(order.tolist())}
        rows = sorted((i, place[t.encode()], n) for i, t, n in rows)
        item, term, number = (np.array([r[k] for r in rows], np.int64) for k in range(3))
        if len(np.unique(hashes)) < len(hashes):
            raise ValueError("two terms that are searched for have one hash")
        return cls(data, begin[order], length[order], hashes[order], item, term, number, items)

    def find(self, low: np.ndarray, start: np.ndarray, end: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Occurrences of the terms: which span and which term. Equal hashes count only with equal bytes."""
        near = np.zeros(1 << 18, bool)
        near[(self.hashes >> np.uint64(46)).astype(np.int64)] = True
        maybe = np.flatnonzero(near[(hashes >> np.uint64(46)).astype(np.int64)])
        term = np.searchsorted(self.hashes, hashes[maybe])
        term = np.minimum(term, len(self.hashes) - 1)
        same = (self.hashes[term] == hashes[maybe]) & (self.length[term] == (end - start)[maybe])
        at, term = maybe[same], term[same]
        if not len(at):
            return at, term
        length = self.length[term]
        equal = low[_ragged(start[at], length)] == self.data[_ragged(self.begin[term], length)]
        right = np.logical_and.reduceat(equal, np.cumsum(length) - length)
        return at[right], term[right]


def _matched(data: np.ndarray, borders: np.ndarray, searched: Searched) -> tuple[np.ndarray, ...]:
    """Hash and document of every term, and document * terms + term and occurrences of those searched for, ascending."""
    start, end = term_spans(data, borders)
    low = _LOWER[data]
    hashes = SpanHash(low).of(start, end)
    doc = np.searchsorted(borders, start, "right") - 1
    at, term = searched.find(low, start, end, hashes)
    pair, tf = np.unique(doc[at] * len(searched.hashes) + term, return_counts=True)
    return hashes, doc, pair, tf


def _chunks(borders: np.ndarray) -> Iterator[tuple[int, int]]:
    for a, b in slices(borders):
        for c in range(a, b, TOGETHER):
            yield c, min(b, c + TOGETHER)


def _statistics(searched):
    """(term, number): documents that hold each term; under -1 documents with terms and under -2 all terms."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms = len(searched.value.hashes)
        held, some, total = np.zeros(terms, np.int64), 0, 0
        for batch in batches:
            data, borders = text_bytes(batch.column(1))
            for a, b in _chunks(borders):
                hashes, doc, pair, _ = _matched(data[borders[a] : borders[b]], borders[a : b + 1] - borders[a], searched.value)
                held += np.bincount(pair % terms, minlength=terms)
                some += len(np.unique(doc))
                total += len(hashes)
        known = np.flatnonzero(held)
        columns = [np.concatenate(([-1, -2], known)), np.concatenate(([some, total], held[known]))]
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["term", "number"])

    return work


@dataclass
class Weights:
    """What the corpus says: weight of each term, number of documents with terms and of all terms."""

    weight: np.ndarray
    documents: int
    terms: int

    @classmethod
    def of(cls, searched: Searched, counts: dict[int, int]) -> Weights:
        n = counts.get(-1, 0)
        held = (counts.get(k, 0) for k in range(len(searched.hashes)))
        weight = [math.floor(1000 * math.log((2 * n + 2) / (2 * df + 1))) for df in held]
        return cls(np.array(weight, np.int64), n, counts.get(-2, 0))

    def lengths(self, n: np.ndarray) -> np.ndarray:
        """A document's m by its number of terms."""
        share = 25 * n.astype(object) * self.documents // self.terms if len(n) and 25 * int(n.max()) * self.documents >= 1 << 63 else 25 * n * self.documents // max(1, self.terms)
        return 100 - 25 + share.astype(np.int64)


def impacts(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    """What a term gives for each unit of its weight; rises with its occurrences."""
    return (1_000_000_000 * tf) // (1000 * tf + 12 * m)


def max_sketches(hashes: np.ndarray, doc: np.ndarray, m: np.ndarray, width: int = WIDTH) -> np.ndarray:
    """Documents' sketches by column: at each coordinate the largest impact of the terms that hash to it.

    Terms are told apart by 54 bits of their hash here. Two that meet count together, which makes a
    bound larger and never too small.
    """
    key, tf = np.unique((doc.astype(np.uint64) << np.uint64(54)) | (hashes >> np.uint64(10)), return_counts=True)
    of = (key >> np.uint64(54)).astype(np.int64)
    sketch = np.zeros(width * len(m))
    np.maximum.at(sketch, _coordinate(key, width) * len(m) + of, impacts(tf, m[of]).astype(float))
    return sketch.reshape(width, len(m))


def _coordinate(key: np.ndarray, width: int) -> np.ndarray:
    return ((key & np.uint64((1 << 54) - 1)) % np.uint64(width)).astype(np.int64)


class Best:
    """The best k documents of each item so far: score, id, whether it has one."""

    def __init__(self, items: int, k: int):
        self.k = k
        self.score = [np.zeros(0, np.int64)] * items
        self.id = [np.zeros(0, np.int64)] * items

    def least(self, item: int) -> int:
        """Score that a document must reach."""
        return int(self.score[item][-1]) if len(self.score[item]) == self.k else 1

    def add(self, item: int, score: np.ndarray, name: np.ndarray) -> None:
        score, name = np.concatenate((self.score[item], score)), np.concatenate((self.id[item], name))
        order = np.lexsort((name, -score))[: self.k]
        order = order[score[order] > 0]
        self.score[item], self.id[item] = score[order], name[order]


#: Stands for a missing id, after all others.
_NO_ID = np.iinfo(np.int64).max


def _ranked(searched, weights, k: int, width: int):
    """Each item's best documents of a partition."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted, stats = searched.value, weights.value
        terms, best = len(wanted.hashes), Best(wanted.items, k)
        coordinate = _coordinate(wanted.hashes >> np.uint64(10), width)
        cuts = np.searchsorted(wanted.item, np.arange(wanted.items + 1))
        factor = wanted.number * stats.weight[wanted.term]
        by_item = [(coordinate[wanted.term[a:b]], wanted.term[a:b], factor[a:b]) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
        for batch in batches:
            ids = np.array([_NO_ID if x is None else x for x in batch.column(0).to_pylist()], np.int64)
            data, borders = text_bytes(batch.column(1))
            for a, b in _chunks(borders):
                hashes, doc, pair, tf = _matched(data[borders[a] : borders[b]], borders[a : b + 1] - borders[a], wanted)
                m = stats.lengths(np.bincount(doc, minlength=b - a))
                exact = impacts(tf, m[pair // terms])
                sketch = max_sketches(hashes, doc, m, width)
                for item, (where, own, times) in enumerate(by_item):
                    bound = times.astype(float) @ sketch[where]
                    rest = np.flatnonzero(bound >= best.least(item))
                    rest = rest[np.argsort(-bound[rest], kind="stable")]
                    while len(rest) and bound[rest[0]] >= best.least(item):
                        now, rest = rest[:CHUNK], rest[CHUNK:]
                        key = now[:, None] * terms + own
                        place = np.minimum(np.searchsorted(pair, key), max(0, len(pair) - 1))
                        value = np.where(pair[place] == key, exact[place], 0) if len(pair) else np.zeros(key.shape, np.int64)
                        best.add(item, value @ times, ids[a + now])
        item = np.repeat(np.arange(wanted.items), [len(s) for s in best.score])
        name = np.concatenate(best.id) if wanted.items else np.zeros(0, np.int64)
        columns = [
            pa.array(item, pa.int32()), pa.array(name, pa.int64(), mask=name == _NO_ID),
            pa.array(np.concatenate(best.score) if wanted.items else name, pa.int64()),
            pa.array(np.full(len(item), TaskContext.get().partitionId()), pa.int32()),
        ]
        yield pa.RecordBatch.from_arrays(columns, ["item", "id", "score", "task"])

    return work


def _first(df: DataFrame, k: int, *by: str) -> DataFrame:
    order = Window.partitionBy(*by).orderBy(F.desc("score"), F.asc_nulls_last("id"))
    return df.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def rank_documents(
    docs: DataFrame,
    items: DataFrame,
    k: int = 20,
    id_column: str = "doc_id",
    text_column: str = "text",
    item_column: str = "item_id",
    item_text: str = "text",
    width: int = WIDTH,
) -> DataFrame:
    """(item, rank, id, score): the ``k`` documents that score highest for each item, those above 0.

    With N documents that have terms, L terms in all and df documents that hold a term, its weight is
    floor(1000 ln((2 N + 2) / (2 df + 1))); n terms make a document's m = 75 + 25 n N div L; a term that
    stands tf times gives weight * (10^9 tf div (1000 tf + 12 m)) for each time it stands in the item.
    Equal scores rank by ascending id, missing ids last.

    One pass over the texts counts N, L and df. In a second each task folds the impacts of a document's
    terms into coordinatewise maxima; an item's bound for a document is the sum of what its terms look
    up there. Documents are scored exactly by descending bound until it is below the item's k-th score
    so far in that task. The tasks' best are merged in two steps, so none gets all of an item's.

    Rows of items that share an id are one item, also those without id; items without terms get no
    rows. A document is a row: rows that repeat an id rank each by itself. A null text has no terms and
    does not count. Ids of documents are whole numbers. Items are searched for in blocks of about
    BLOCK_TERMS (item, term) rows, which the driver sends to the tasks; each block reads the texts twice.
    """
    spark = prepare(docs.sparkSession)
    kind = items.select(item_column).schema[0].dataType.simpleString()
    asked = items.select(F.col(item_column).alias("name"), F.explode(terms_of(F.col(item_text).cast("string"))).alias("term"))
    asked = cut_lineage(asked.groupBy("name", "term").agg(F.count("*").alias("number")))
    blocks = -(-asked.count() // BLOCK_TERMS)
    texts = docs.where(F.col(text_column).isNotNull()).select(F.col(id_column).cast("long").alias("id"), F.col(text_column).cast("string").alias("text"))
    out = spark.createDataFrame([], f"`{item_column}` {kind}, rank int, `{id_column}` long, score long")
    for block in range(blocks):
        rows = asked.where(F.pmod(F.xxhash64("name"), F.lit(blocks)) == block).collect()
        names = sorted({r["name"] for r in rows}, key=lambda x: (x is None, x))
        number = {name: n for n, name in enumerate(names)}
        if not names:
            continue
        searched = Searched.of([(number[r["name"]], r["term"], r["number"]) for r in rows], len(names))
        model = spark.sparkContext.broadcast(searched)
        counted = texts.mapInArrow(returning(_statistics(model)), "term long, number long").groupBy("term").agg(F.sum("number").alias("number"))
        weights = spark.sparkContext.broadcast(Weights.of(searched, {r["term"]: r["number"] for r in counted.collect()}))
        found = texts.mapInArrow(returning(_ranked(model, weights, k, width)), "item int, id long, score long, task int")
        some = _first(found.withColumn("part", F.expr("int(sqrt(task))")), k, "item", "part").select("item", "id", "score")
        known = spark.createDataFrame([(n, name) for name, n in number.items()], f"item int, name {kind}")
        top = _first(some, k, "item").join(F.broadcast(known), "item")
        out = out.union(top.select("name", F.col("rank").cast("int"), "id", "score"))
    return out
