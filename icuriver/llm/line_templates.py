"""Lines whose template recurs across documents, found by a fixed-depth tree."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from icuriver.llm.common import SpanHash, free_name, mix, prepare, returning, slices, text_bytes, text_or_empty
from icuriver.session import cut_lineage

#: Leading tokens on the path from the root, after the token count.
DEPTH = 3
#: Share of a line's tokens that its template has in common with it.
ALIKE = 0.8
#: Share of a line's tokens that must be words of its template, and their least number; else the line stands for itself.
WORDED, WORDS = 0.5, 3
#: Documents in which a template recurs.
RECURS = 6
#: Bits of the broadcast filter of leaves at most, and for each leaf. The exact join follows.
FILTER_BITS, BITS_A_LEAF = 27, 64

_BLANK = np.zeros(256, bool)
_BLANK[[9, 11, 12, 13, 32]] = True
_DIGIT = np.zeros(256, bool)
_DIGIT[48:58] = True
_LETTER = np.zeros(256, bool)
_LETTER[65:91] = _LETTER[97:123] = _LETTER[128:] = True


@dataclass
class Lines:
    """Lines of some texts: borders of texts among lines and of lines among tokens, hash and leaf of lines, tokens' values."""

    texts: np.ndarray
    cuts: np.ndarray
    line: np.ndarray
    leaf: np.ndarray
    value: np.ndarray

    @property
    def count(self) -> np.ndarray:
        return np.diff(self.cuts)


def lines_of(data: np.ndarray, borders: np.ndarray) -> Lines:
    """Lines end at newlines, so a text has one more line than newlines. Tokens are runs without white space.

    A line's hash covers its tokens as they are. In a token's value each run of digits is one sign; the
    last bit says whether it is a word: it has a letter and no digit. A leaf is a token count and the
    first DEPTH values. Lines without tokens have leaf 0.
    """
    newline = data == 10
    newlines = np.concatenate(([0], np.cumsum(newline)))[borders]
    per_text = np.diff(newlines) + 1
    text_cut = np.concatenate(([0], np.cumsum(per_text)))
    start = np.empty(text_cut[-1], np.int64)
    start[text_cut[:-1]] = borders[:-1]
    inner = np.ones(len(start), bool)
    inner[text_cut[:-1]] = False
    start[inner] = np.flatnonzero(newline) + 1
    edge = np.zeros(len(data) + 1, bool)
    edge[borders] = True
    inside = np.concatenate(([False], ~(_BLANK[data] | newline), [False]))
    token = np.flatnonzero(inside[1:-1] & (~inside[:-2] | edge[:-1]))
    token_end = np.flatnonzero(inside[1:-1] & (~inside[2:] | edge[1:])) + 1
    digit = _DIGIT[data]
    digits = np.concatenate(([0], np.cumsum(digit)))
    letters = np.concatenate(([0], np.cumsum(_LETTER[data])))
    word = (digits[token_end] == digits[token]) & (letters[token_end] > letters[token])
    # one sign for a run of digits
    stays = np.ones(len(data), bool)
    stays[1:] = ~(digit[1:] & digit[:-1]) | edge[1:-1]
    shift = np.concatenate(([0], np.cumsum(stays)))
    masked = np.where(digit, np.uint8(48), data)[stays]
    value = SpanHash(masked).of(shift[token], shift[token_end])
    value = (value & ~np.uint64(1)) | word
    line_cut = np.append(np.searchsorted(token, start), len(token))
    count = np.diff(line_cut)
    leaf = mix(count.astype(np.uint64))
    padded = np.concatenate((value, np.zeros(DEPTH, np.uint64)))
    for k in range(DEPTH):
        leaf = mix(leaf * np.uint64(3) + np.where(count > k, padded[line_cut[:-1] + k], 0))
    leaf = np.where(count > 0, leaf, 0)
    exact = SpanHash(data).of(token, token_end)
    place = np.arange(len(token)) - np.repeat(line_cut[:-1], count)
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(mix(exact + place.astype(np.uint64) * np.uint64(0x2545F4914F6CDD1D)), dtype=np.uint64)))
    line = mix(sums[line_cut[1:]] - sums[line_cut[:-1]] + count.astype(np.uint64))
    return Lines(text_cut, line_cut, line, leaf, value)


def _leaf_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(leaf, rows): texts that hold each leaf, batch by batch."""
    for batch in batches:
        data, borders = text_bytes(batch.column(0))
        found = []
        for a, b in slices(borders):
            lines = lines_of(data[borders[a] : borders[b]], borders[a : b + 1] - borders[a])
            text = np.repeat(np.arange(b - a, dtype=np.uint64), np.diff(lines.texts))
            order = np.lexsort((text, lines.leaf))
            leaf, text = lines.leaf[order], text[order]
            other = np.ones(len(leaf), bool)
            other[1:] = (leaf[1:] != leaf[:-1]) | (text[1:] != text[:-1])
            found.append(leaf[other & (leaf != 0)])
        leaf, rows = np.unique(np.concatenate(found), return_counts=True) if found else (np.zeros(0, np.uint64), np.zeros(0, np.int64))
        yield pa.RecordBatch.from_arrays([pa.array(leaf.astype(np.int64)), pa.array(rows, pa.int64())], ["leaf", "rows"])


def _lines_in(filter_bits):
    """Lines whose leaf may recur: (id, row, place, leaf, line), and their tokens with the first equal line of a batch."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.unpackbits(np.frombuffer(filter_bits.value, np.uint8), bitorder="little").view(bool)
        top = np.uint64(len(bits) - 1)
        for batch in batches:
            data, borders = text_bytes(batch.column(2))
            ids, rows = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            known: set[int] = set()
            out: list[list] = [[] for _ in range(6)]
            for a, b in slices(borders):
                lines = lines_of(data[borders[a] : borders[b]], borders[a : b + 1] - borders[a])
                at = np.flatnonzero((lines.leaf != 0) & bits[(lines.leaf & top).astype(np.int64)])
                text = np.searchsorted(lines.texts, at, "right") - 1
                values = lines.value.view(np.int64)
                for column, more in zip(out, (ids[a + text], rows[a + text], at - lines.texts[text], lines.leaf[at].view(np.int64), lines.line[at].view(np.int64)), strict=False):
                    column.append(more)
                for k, hashed in zip(at.tolist(), lines.line[at].tolist(), strict=True):
                    fresh = hashed not in known
                    known.add(hashed)
                    out[5].append(values[lines.cuts[k] : lines.cuts[k + 1]] if fresh else None)
            columns = [np.concatenate(c) if c else np.zeros(0, np.int64) for c in out[:5]]
            kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64()]
            arrays = [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)] + [pa.array(out[5], pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(arrays, ["id", "row", "place", "leaf", "line", "tokens"])

    return work


def _leaf_filter(leaves: DataFrame) -> bytes:
    """A bit for each leaf by its lowest bits; its size is bounded, whatever the number of leaves."""
    power = max(16, min(FILTER_BITS, (BITS_A_LEAF * leaves.count()).bit_length()))
    bit = F.col("leaf").bitwiseAND(F.lit((1 << power) - 1))
    words = leaves.groupBy(F.shiftright(bit, 5).alias("at")).agg(F.bit_or(F.expr("shiftleft(1L, cast(leaf & 31 as int))")).alias("word"))
    found = words.toArrow()
    bits = np.zeros(1 << (power - 5), np.uint32)
    bits[found.column("at").to_numpy()] = found.column("word").to_numpy().astype(np.uint32)
    return bits.astype("<u4").tobytes()


def line_templates(lines: DataFrame, leaves: DataFrame, recurs: int, alike: float) -> DataFrame:
    """(line, template) of different lines (id, place, leaf, line, tokens) in ``leaves``.

    In a leaf a value is literal at its place if at least ``recurs`` documents have it there, each
    voting with its first line of the leaf; other places are variable fields. A line comes under the
    template of its literal places if these are a share of ``alike`` of it, and enough of them words;
    else it stands for itself.
    """
    votes = lines.groupBy("leaf", "id").agg(F.min(F.struct("place", "line")).alias("first")).groupBy(F.col("first.line").alias("line")).agg(F.count("*").alias("votes"))
    known = lines.where("tokens is not null").groupBy("line").agg(F.first("leaf").alias("leaf"), F.first("tokens").alias("tokens"))
    known = known.join(leaves.select("leaf"), "leaf", "left_semi")
    voted = known.join(votes, "line", "left").select("line", "leaf", "tokens", F.coalesce("votes", F.lit(0)).alias("votes"))
    places = cut_lineage(voted.select("line", "leaf", "votes", F.posexplode("tokens").alias("at", "value")))
    later = places.where(F.col("at") >= DEPTH)
    common = later.groupBy("leaf", "at", "value").agg(F.sum("votes").alias("n")).where(F.col("n") >= recurs).select("leaf", "at", "value", F.lit(True).alias("literal"))
    marked = later.join(common, ["leaf", "at", "value"], "left").unionByName(places.where(F.col("at") < DEPTH).withColumn("literal", F.lit(True)))
    literal = F.coalesce("literal", F.lit(False))
    word = F.when(literal, F.col("value").bitwiseAND(F.lit(1))).otherwise(0)
    shape = F.bit_xor(F.xxhash64("at", F.when(literal, F.col("value")).otherwise(0), literal))
    made = marked.groupBy("line", "leaf").agg(F.count("*").alias("n"), F.sum(literal.cast("int")).alias("same"), F.sum(word).alias("words"), shape.alias("shape"))
    fits = (F.col("same") >= alike * F.col("n") - 1e-9) & (F.col("words") >= WORDED * F.col("n")) & (F.col("words") >= WORDS)
    return made.select("line", F.when(fits, F.xxhash64("leaf", "shape")).otherwise(F.col("line")).alias("template"))


def without_recurring_lines(
    docs: DataFrame, recurs: int = RECURS, alike: float = ALIKE, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """``docs`` with a last column, lines or a free name like it, of (n_lines, n_dropped, kept).

    Each line goes down a tree by its number of tokens and its first DEPTH tokens, a run of digits in a
    token counting as any other. In the leaf its places become literal or variable fields (see
    ``line_templates``); a line with few words, such as a row of numbers, an address or a code, only
    equals itself. A template recurs that at least ``recurs`` different documents have lines of, and
    its lines are dropped, save those in the document with the smallest id. kept is the other lines,
    joined by newlines. Lines without tokens stay. A null text counts as empty: one empty line. Rows
    without id keep all lines and do not count; rows with one id are one document. Ids are whole numbers.

    Values, lines and templates are compared by 64 bits. A first pass counts texts by leaf; only lines
    whose leaf is in enough of them leave a task in the second, through a filter of bounded size and an
    exact join. All counts are aggregates, so no task holds a leaf.
    """
    spark = prepare(docs.sparkSession)
    number = F.col(id_column).cast("long")
    own = F.xxhash64(text_or_empty(text_column))
    texts = docs.where(F.col(id_column).isNotNull()).select(number.alias("id"), own.alias("row"), text_or_empty(text_column).alias("text"))
    counted = texts.select("text").mapInArrow(returning(_leaf_counts), "leaf long, rows long")
    leaves = cut_lineage(counted.groupBy("leaf").agg(F.sum("rows").alias("rows")).where(F.col("rows") >= recurs))
    bits = spark.sparkContext.broadcast(_leaf_filter(leaves))
    lines = cut_lineage(texts.mapInArrow(returning(_lines_in(bits)), "id long, `row` long, place int, leaf long, line long, tokens array<long>"))
    templates = cut_lineage(line_templates(lines, leaves, recurs, alike))
    placed = lines.select("id", "row", "place", "line").join(templates, "line")
    recurring = placed.groupBy("template", "id").agg(F.lit(1)).groupBy("template").agg(F.count("*").alias("n"), F.min("id").alias("first"))
    recurring = recurring.where(F.col("n") >= recurs).select("template", "first")
    late = placed.join(recurring, "template").where(F.col("id") > F.col("first"))
    dropped = late.groupBy("id", "row").agg(F.collect_set("place").alias("places"))

    @F.arrow_udf("n_lines int, n_dropped int, kept string")
    def cut(text: pa.Array, places: pa.Array) -> pa.Array:
        out: list[list] = [[], [], []]
        for t, drop in zip(text.to_pylist(), places.to_pylist(), strict=True):
            own, drop = (t or "").split("\n"), set(drop or ())
            out[0].append(len(own))
            out[1].append(len(drop))
            out[2].append("\n".join(x for k, x in enumerate(own) if k not in drop) if drop else t or "")
        return pa.StructArray.from_arrays([pa.array(c, k) for c, k in zip(out, (pa.int32(), pa.int32(), pa.string()), strict=True)], ["n_lines", "n_dropped", "kept"])

    id_key, row_key, own_id, own_row, places, name = (free_name(docs, n) for n in ("line_id", "line_row", "own_id", "own_row", "places", "lines"))
    marked = docs.withColumns({id_key: number, row_key: own}).join(
        dropped.toDF(own_id, own_row, places), (F.col(id_key) == F.col(own_id)) & (F.col(row_key) == F.col(own_row)), "left"
    )
    marked = marked.withColumn(name, cut(F.col(text_column).cast("string"), F.col(places)))
    return marked.select(*[F.col(c) for c in docs.columns], F.col(name))
