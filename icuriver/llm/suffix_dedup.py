"""Repeated byte strings across documents: later copies are removed, the first stays.

Every window of MATCH bytes is represented by its minimizer, the least hash of its SEED-byte strings.
Windows in a row with one minimizer form a run; equal windows of two documents lie in runs with the same
minimizer. Runs that are equal as a whole are settled by their digests. Only different runs with a
common minimizer, at the ends of repeated passages, are compared as text, by suffix order and
longest-previous-factor arrays.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from icuriver.llm.common import SpanHash, free_name, parallelism, prepare, returning, slices, text_bytes, text_or_empty
from icuriver.session import cut_lineage

#: Bytes of a removed string.
MATCH = 50
#: Bytes of the strings whose least hash represents a window.
SEED = 16
#: Windows of a run at most; longer ones are cut.
RUN = 128
#: Bits kept of a minimizer. A run's digest has 64.
BITS = 48
#: Bytes of the text of runs that are compared at once, or all of one minimizer.
COMPARED = 1 << 20
#: Bytes of text for each part that runs are dealt to, about.
PART_BYTES = 32 << 20


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    span, low = 1, x
    while span * 2 <= width:
        low = np.minimum(low[: len(low) - span], low[span:])
        span *= 2
    n = max(0, len(x) - width + 1)
    return np.minimum(low[:n], low[width - span : width - span + n])


def runs(data: np.ndarray, borders: np.ndarray, match: int, seed: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Document, start in the document, windows, minimizer and digest of every run."""
    hashes = SpanHash(data)
    low = sliding_min(hashes.rolling(seed), match - seed + 1)
    n = len(low)
    change = np.zeros(len(data) + 2, np.int8)
    long = np.diff(borders) >= match
    change[borders[:-1][long]] += 1
    change[borders[1:][long] - match + 1] -= 1
    valid = np.cumsum(change)[:n] > 0
    if not valid.any():
        nothing = np.zeros(0, np.int64)
        return nothing, nothing, nothing, nothing.astype(np.uint64), nothing.astype(np.uint64)
    fresh = valid.copy()
    fresh[1:] &= ~valid[:-1] | (low[1:] != low[:-1])
    first = np.flatnonzero(fresh)
    after = np.flatnonzero(valid & ~np.append(valid[1:], False)) + 1
    end = np.minimum(np.append(first[1:], n), after[np.searchsorted(after, first, "right")])
    pieces = -((first - end) // RUN)
    place = np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    start = np.repeat(first, pieces) + place * RUN
    length = np.minimum(np.repeat(end, pieces) - start, RUN)
    doc = np.searchsorted(borders, start, "right") - 1
    keep = np.uint64(64 - BITS)
    return doc, start - borders[doc], length, low[start] >> keep, hashes.of(start, start + length + (match - 1))


def packed(docs: tuple[np.ndarray, np.ndarray], *columns: np.ndarray) -> bytes:
    """Records as planes of bytes, compressed: for each a document (row, id) and further numbers, the first ascending."""
    names, columns = docs, [c.astype(np.uint64) for c in columns]
    columns[0] = np.diff(columns[0], prepend=np.uint64(0))
    arrays = [names[0].astype(np.uint64), names[1].astype(np.uint64), *columns]
    sizes = np.array([len(names[0]), len(columns[0]), len(columns)], np.uint64).tobytes()
    planes = b"".join(a.view(np.uint8).reshape(-1, 8).T.tobytes() for a in arrays)
    return sizes + zstandard.ZstdCompressor(1).compress(planes)


def unpacked(blob: bytes) -> tuple[tuple[np.ndarray, np.ndarray], list[np.ndarray]]:
    docs, n, m = np.frombuffer(blob, np.uint64, 3).tolist()
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob[24:]), np.uint8)
    out, at = [], 0
    for size in [docs, docs] + [n] * m:
        out.append(np.ascontiguousarray(planes[at : at + 8 * size].reshape(8, -1).T).view(np.uint64).ravel())
        at += 8 * size
    out[2] = np.cumsum(out[2], dtype=np.uint64)
    return (out[0].astype(np.int64), out[1].astype(np.int64)), out[2:]


def _by_target(target: np.ndarray, order_by: np.ndarray, doc: np.ndarray, row: np.ndarray, name: np.ndarray, *columns: np.ndarray) -> Iterator[tuple[int, bytes]]:
    """Records of each target, packed with the documents they need; ``order_by`` is the first column."""
    order = np.lexsort((order_by, target))
    cuts = np.flatnonzero(np.diff(target[order], prepend=-1))
    for a, b in zip(cuts.tolist(), np.append(cuts[1:], len(order)).tolist(), strict=True):
        part = order[a:b]
        used, local = np.unique(doc[part], return_inverse=True)
        yield int(target[part[0]]), packed((row[used], name[used]), order_by[part], local, *[c[part] for c in columns])


def _rows(kind: int, made: Iterator[tuple[int, bytes]]) -> pa.RecordBatch:
    made = list(made)
    return pa.RecordBatch.from_arrays(
        [pa.array([kind] * len(made), pa.int32()), pa.array([t for t, _ in made], pa.int32()), pa.array([b for _, b in made], pa.binary())],
        ["kind", "target", "payload"],
    )


_RECORDS, _REMOVED, _WANTED = 0, 1, 2
_SCHEMA = "kind int, target int, payload binary"


def _find_runs(match: int, seed: int, parts: int):
    """Runs of each batch: the first of equal ones goes to its minimizer's part, later ones are removed at once."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row, name = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            data, borders = text_bytes(batch.column(2))
            found = []
            for a, b in slices(borders):
                doc, start, length, low, digest = runs(data[borders[a] : borders[b]], borders[a : b + 1] - borders[a], match, seed)
                found.append((doc + a, start, length, low, digest))
            if not found:
                continue
            doc, start, length, low, digest = (np.concatenate(c) for c in zip(*found, strict=True))
            if not len(doc):
                continue
            order = np.lexsort((name[doc], digest, low))
            doc, start, length, low, digest = doc[order], start[order], length[order], low[order], digest[order]
            fresh = np.ones(len(doc), bool)
            fresh[1:] = (low[1:] != low[:-1]) | (digest[1:] != digest[:-1])
            group = np.cumsum(fresh) - 1
            later = name[doc] > name[doc[fresh]][group]
            f = ~later
            target = (low[f] % np.uint64(parts)).astype(np.int64)
            yield _rows(_RECORDS, _by_target(target, low[f], doc[f], row, name, digest[f], start[f], length[f]))
            if later.any():
                yield _rows(_REMOVED, _by_target(row[doc[later]] % parts, start[later].astype(np.uint64), doc[later], row, name, length[later]))

    return work


def _settle(parts: int):
    """All runs of a part's minimizers: copies in later documents are removed, texts wanted where different runs meet."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, names, columns, base = [], [], [], 0
        for batch in batches:
            for kind, target, payload in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if kind == _REMOVED:
                    yield _rows(_REMOVED, iter([(target, payload)]))
                    continue
                (row, name), (low, doc, digest, start, length) = unpacked(payload)
                rows.append(row)
                names.append(name)
                columns.append((low, digest, doc.astype(np.int64) + base, start.astype(np.int64), length.astype(np.int64)))
                base += len(row)
        if not rows:
            return
        row, name = np.concatenate(rows), np.concatenate(names)
        low, digest, doc, start, length = (np.concatenate(c) for c in zip(*columns, strict=True))
        del rows, names, columns
        order = np.lexsort((name[doc], digest, low))
        low, digest, doc, start, length = low[order], digest[order], doc[order], start[order], length[order]
        new_low = np.diff(low, prepend=low[:1] + np.uint64(1)) != 0
        fresh = new_low | (np.diff(digest, prepend=digest[:1]) != 0)
        later = name[doc] > name[doc[fresh]][np.cumsum(fresh) - 1]
        if later.any():
            yield _rows(_REMOVED, _by_target(row[doc[later]] % parts, start[later].astype(np.uint64), doc[later], row, name, length[later]))
        seed_of = np.cumsum(new_low) - 1
        several = np.bincount(seed_of, weights=fresh) > 1
        wanted = several[seed_of] & ~later
        if wanted.any():
            yield _rows(_WANTED, _by_target(row[doc[wanted]] % parts, start[wanted].astype(np.uint64), doc[wanted], row, name, length[wanted], low[wanted]))

    return work


def union_of(start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Intervals joined where they overlap or touch, ascending."""
    order = np.argsort(start, kind="stable")
    start, end = start[order], np.maximum.accumulate(end[order]) if len(end) else end
    new = np.ones(len(start), bool)
    new[1:] = start[1:] > end[:-1]
    last = np.append(np.flatnonzero(new)[1:] - 1, len(start) - 1) if len(start) else np.zeros(0, np.int64)
    return start[new], end[last]


def _by_document(match: int):
    """Per document: the intervals to remove, and the runs whose text is wanted (start, windows, minimizer)."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[int, list[tuple[np.ndarray, ...]]] = {_REMOVED: [], _WANTED: []}
        for batch in batches:
            for kind, payload in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), strict=True):
                (row, name), (start, doc, length, *low) = unpacked(payload)
                doc = doc.astype(np.int64)
                found[kind].append((row[doc], name[doc], start, length, *low))
        out: dict[tuple[int, int], list] = {}
        for kind, many in found.items():
            if not many:
                continue
            row, name, start, length, *low = (np.concatenate(c) for c in zip(*many, strict=True))
            order = np.lexsort((start, name, row))
            row, name, start, length = row[order], name[order], start[order].astype(np.int64), length[order].astype(np.int64)
            cuts = np.flatnonzero(np.concatenate(([True], (row[1:] != row[:-1]) | (name[1:] != name[:-1]))))
            for a, b in zip(cuts.tolist(), np.append(cuts[1:], len(row)).tolist(), strict=True):
                entry = out.setdefault((int(row[a]), int(name[a])), [None, None])
                if kind == _REMOVED:
                    entry[0] = np.concatenate(union_of(start[a:b], start[a:b] + length[a:b] + (match - 1))).tobytes()
                else:
                    entry[1] = np.concatenate((start[a:b], length[a:b], low[0][order[a:b]].astype(np.int64))).tobytes()
        keys = [pa.array([key[k] for key in out], pa.int64()) for k in (0, 1)]
        columns = [*keys, *(pa.array([v[k] for v in out.values()], pa.binary()) for k in (0, 1))]
        yield pa.RecordBatch.from_arrays(columns, ["row", "id", "removed", "wanted"])

    return work


def _wanted_texts(match: int, parts: int, row_at: int, id_at: int, text_at: int, wanted_at: int):
    """Texts of the wanted runs, dealt by minimizer: for each part of a batch the places as records, and the bytes end to end."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row, name = batch.column(row_at).to_numpy(), batch.column(id_at).to_numpy()
            data, borders = text_bytes(batch.column(text_at))
            runs_of = [np.frombuffer(w, np.int64).reshape(3, -1) for w in batch.column(wanted_at).to_pylist()]
            if not runs_of:
                continue
            doc = np.repeat(np.arange(len(runs_of)), [w.shape[1] for w in runs_of])
            start, length, low = np.concatenate(runs_of, axis=1)
            target, size = low % parts, length + match - 1
            order = np.lexsort((low, target))
            cuts = np.flatnonzero(np.diff(target[order], prepend=-1))
            made: list[tuple[int, bytes, bytes]] = []
            for a, b in zip(cuts.tolist(), np.append(cuts[1:], len(order)).tolist(), strict=True):
                part = order[a:b]
                used, local = np.unique(doc[part], return_inverse=True)
                n = size[part]
                at = np.repeat(borders[doc[part]] + start[part] - (np.cumsum(n) - n), n) + np.arange(n.sum())
                places = packed((row[used], name[used]), low[part].astype(np.uint64), local, start[part], n)
                made.append((int(target[part[0]]), places, zstandard.ZstdCompressor(1).compress(data[at].tobytes())))
            columns = list(zip(*made, strict=True)) or [[]] * 3
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, (pa.int32(), pa.binary(), pa.binary()), strict=True)], ["target", "places", "text"])

    return work


def _previous(values: list[int], lcp: list[int]) -> list[int]:
    """For each suffix: the prefix it shares with the last suffix before it that has a smaller value."""
    out, stack = [], []  # stack of (value, prefix shared with the entry below)
    for value, shared in zip(values, lcp, strict=True):
        while stack and stack[-1][0] >= value:
            shared = min(shared, stack.pop()[1])
        out.append(shared if stack else 0)
        stack.append((value, shared))
    return out


def longest_previous_factors(values: list[int], lcp: list[int]) -> list[int]:
    """For suffixes in suffix order: the longest prefix shared with a suffix of a smaller value.

    ``lcp[i]`` is what suffixes i - 1 and i share. The longest such match is with the previous or the
    next smaller value in suffix order. With documents as values, it is the longest earlier copy.
    """
    after = _previous(values[::-1], [0, *lcp[:0:-1]])[::-1]
    return [max(a, b) for a, b in zip(_previous(values, lcp), after, strict=True)]


def earlier_copies(data: np.ndarray, borders: np.ndarray, value: np.ndarray, match: int) -> np.ndarray:
    """Positions at which a string of ``match`` bytes starts that also starts in a text of a smaller value.

    The suffixes that count are those of at least ``match`` bytes whose first ``match`` bytes occur twice;
    they are put in suffix order by these bytes.
    """
    room = np.zeros(len(data) + 1, np.int64)
    long = np.diff(borders) >= match
    room[borders[:-1][long]] += 1
    room[borders[1:][long] - match + 1] -= 1
    at = np.flatnonzero(np.cumsum(room)[:-1] > 0)
    if not len(at):
        return at
    _, inverse, count = np.unique(SpanHash(data).raw(at, at + match), return_inverse=True, return_counts=True)
    at = at[count[inverse] > 1]
    if not len(at):
        return at
    width = -(-match // 8) * 8
    heads = np.zeros((len(at), width), np.uint8)
    heads[:, :match] = data[at[:, None] + np.arange(match)]
    words = heads.view(">u8").astype(np.uint64)
    of = value[np.searchsorted(borders, at, "right") - 1]
    order = np.lexsort((of, *words.T[::-1]))
    at, words, of = at[order], words[order], of[order]
    heads = heads[order]
    differ = heads[1:] != heads[:-1]
    lcp = np.where(differ.any(axis=1), differ.argmax(axis=1), match)
    factors = longest_previous_factors(of.tolist(), [0, *lcp.tolist()])
    return np.sort(at[np.array(factors) >= match])


def _compare(match: int, parts: int):
    """Later copies of strings among the wanted runs of a part's minimizers.

    Equal strings lie in runs of one minimizer, so runs are compared in the order of their minimizers, about
    COMPARED bytes of text at once; those of one minimizer stay together.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = []
        for batch in batches:
            for places, text in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                (row, name), (low, doc, start, size) = unpacked(places)
                doc = doc.astype(np.int64)
                raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(text), np.uint8)
                found.append((low, row[doc], name[doc], start.astype(np.int64), size.astype(np.int64), raw))
        if not found:
            return
        low, row, name, start, size, data = (np.concatenate(c) for c in zip(*found, strict=True))
        del found
        begin, order = np.cumsum(size) - size, np.argsort(low, kind="stable")
        upto = np.cumsum(size[order])
        ends = np.append(np.flatnonzero(np.diff(low[order])) + 1, len(order))  # where another minimizer begins
        a = 0
        while a < len(order):
            done = upto[a - 1] if a else 0
            b = int(ends[min(np.searchsorted(upto[ends - 1], done + COMPARED, "right"), len(ends) - 1)])
            part, a = order[a:b], b
            n = size[part]
            own = data[np.repeat(begin[part] - (np.cumsum(n) - n), n) + np.arange(n.sum())]
            borders = np.concatenate(([0], np.cumsum(n)))
            at = earlier_copies(own, borders, name[part], match)
            if not len(at):
                continue
            text = np.searchsorted(borders, at, "right") - 1
            new = np.ones(len(at), bool)
            new[1:] = (at[1:] != at[:-1] + 1) | (text[1:] != text[:-1])
            first = np.flatnonzero(new)
            length = np.diff(np.append(first, len(at)))
            text, place = text[first], (at - borders[text])[first]
            run = part[text]
            yield _rows(_REMOVED, _by_target(row[run] % parts, (start[run] + place).astype(np.uint64), run, row, name, length))

    return work


def repeated_spans(keyed: DataFrame, row: str, number: str, match: int, id_column: str, text_column: str) -> DataFrame:
    """(row, id, spans): starts and ends of the byte intervals to remove, one list or two for a document.

    ``keyed`` has the columns named ``row``, a hash of id and text, and ``number``, the id or 0; none of
    them is null, so that this and the caller's join read the texts through one and the same exchange.
    """
    spark = prepare(keyed.sparkSession)
    texts = keyed.where(F.col(id_column).isNotNull()).select(F.col(row).alias("row"), F.col(number).alias("id"), text_or_empty(text_column).alias("text"))
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts, seed = max(parallelism(spark), -(-size // PART_BYTES)), min(SEED, match)

    def dealt(df: DataFrame) -> DataFrame:
        return df.repartitionById(parts, F.col("target"))

    by_document = returning(_by_document(match)), "row long, id long, removed binary, wanted binary"
    found = dealt(texts.mapInArrow(returning(_find_runs(match, seed, parts)), _SCHEMA)).mapInArrow(returning(_settle(parts)), _SCHEMA)
    marks = cut_lineage(dealt(found).mapInArrow(*by_document))
    own_row, own_number, runs_of = (free_name(keyed, n) for n in ("wanted_row", "wanted_number", "wanted_runs"))
    some = marks.where("wanted is not null").select(F.col("row").alias(own_row), F.col("id").alias(own_number), F.col("wanted").alias(runs_of))
    wanted = keyed.join(some, (F.col(row) == F.col(own_row)) & (F.col(number) == F.col(own_number)))
    at = {c: k for k, c in enumerate(wanted.columns)}
    pieces = wanted.mapInArrow(returning(_wanted_texts(match, parts, at[row], at[number], at[text_column], at[runs_of])), "target int, places binary, text binary")
    late = dealt(dealt(pieces).mapInArrow(returning(_compare(match, parts)), _SCHEMA)).mapInArrow(*by_document)
    spans = marks.where("removed is not null").select("row", "id", "removed").union(late.select("row", "id", "removed"))
    return spans.groupBy("row", "id").agg(F.collect_list("removed").alias("spans"))


def without_repeats(docs: DataFrame, match: int = MATCH, id_column: str = "doc_id", text_column: str = "text", as_text: bool = False) -> DataFrame:
    """``docs`` with a last column, cut or a free name like it, of (n_bytes, n_removed, n_spans, kept) about each whole text as UTF-8 bytes.

    A byte is removed if a string of ``match`` bytes covers it that also starts in a document with a
    smaller id, judged on the texts as given. kept is what is left, as bytes, or as text without the
    halves of signs at cuts. A null text counts as empty. Rows with one id do not remove each other's
    bytes; rows without id neither lose bytes nor cause losses. Ids are whole numbers.

    Runs count as equal by 48 bits of their minimizer and 64 of their digest. Parts are so many that
    each has about PART_BYTES of text.
    """
    kept_type = "string" if as_text else "binary"
    row, number, spans, out = (free_name(docs, n) for n in ("row", "number", "spans", "cut"))
    own = F.col(id_column).cast("long")
    keyed = docs.withColumns({row: F.xxhash64(own, text_or_empty(text_column)), number: F.coalesce(own, F.lit(0))})
    marks = repeated_spans(keyed, row, number, match, id_column, text_column)

    @F.arrow_udf(f"n_bytes long, n_removed long, n_spans long, kept {kept_type}")
    def cut(text: pa.Array, spans: pa.Array) -> pa.Array:
        out: list[list] = [[] for _ in range(4)]
        for t, found in zip(text.to_pylist(), spans.to_pylist(), strict=True):
            raw, found = (t or "").encode(), [np.frombuffer(s, np.int64).reshape(2, -1) for s in found or ()]
            start, end = union_of(*np.concatenate(found, axis=1)) if found else (np.zeros(0, np.int64),) * 2
            inner = zip([0, *end.tolist()], [*start.tolist(), len(raw)], strict=True)
            left = b"".join(raw[a:b] for a, b in inner)
            for column, value in zip(out, (len(raw), int((end - start).sum()), len(start), left.decode("utf-8", "ignore") if as_text else left), strict=True):
                column.append(value)
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string() if as_text else pa.binary()]
        return pa.StructArray.from_arrays([pa.array(c, k) for c, k in zip(out, kinds, strict=True)], ["n_bytes", "n_removed", "n_spans", "kept"])

    own_row, own_number = free_name(keyed, "own_row"), free_name(keyed, "own_number")
    marked = keyed.join(marks.toDF(own_row, own_number, spans), (F.col(row) == F.col(own_row)) & (F.col(number) == F.col(own_number)), "left")
    marked = marked.withColumn(out, cut(F.col(text_column).cast("string"), F.col(spans)))
    return marked.select(*[F.col(c) for c in docs.columns], F.col(out))
