"""Packing of token sequences under several limits at once."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from icuriver.llm.common import prepare, returning, slices, text_bytes
from icuriver.llm.pieces import PIECE_BYTES, PieceTable, piece_starts

#: Id put at the end of a document.
END = 1


class Bin:
    """An open sequence: pieces (item, start, length) and what is left of each limit."""

    def __init__(self, limits: np.ndarray):
        self.left = limits.copy()
        self.pieces: list[tuple[int, int, int]] = []


def best_fit(left: np.ndarray, limits: np.ndarray, sizes: np.ndarray) -> int:
    """The item that fits and points most in the direction of what is left, as shares of the limits; -1 if none fits.

    Ties go to the first item.
    """
    fits = (sizes <= left).all(axis=1)
    if not fits.any():
        return -1
    score = np.where(fits, sizes @ (left / limits / limits), -1.0)
    return int(score.argmax())


class Packer:
    """Vector bin packing of items (tokens, 1 segment, loss-bearing tokens), one open bin at a time.

    The item with the largest dot product with the bin's remaining room goes in. When none fits and
    cutting is allowed, the item that comes next by that measure is cut to fill the room.
    """

    def __init__(self, tokens: int, segments: int, loss: int, cut: bool):
        self.limits = np.array([tokens, segments, loss], float)
        self.cut = cut
        self.open = Bin(self.limits)

    def _add(self, item: int, start: int, length: int, loss: float) -> None:
        self.open.pieces.append((item, start, length))
        self.open.left -= (length, 1, loss)

    def _close(self) -> list[tuple[int, int, int]]:
        done, self.open = self.open.pieces, Bin(self.limits)
        return done

    def pack(self, items: list[int], lengths: np.ndarray, losses: np.ndarray) -> Iterator[list[tuple[int, int, int]]]:
        """Full bins; what does not fill one stays open for the next call. ``losses`` are counts of loss-bearing tokens."""
        most = int(self.limits[0])
        sizes = np.column_stack([lengths, np.ones(len(lengths)), losses]).astype(float)
        starts = np.zeros(len(items), np.int64)
        if not self.cut and len(items) and (sizes > self.limits).any():
            raise ValueError("an item is larger than a sequence and may not be cut")
        for k in np.flatnonzero((sizes[:, 0] >= most) & (sizes[:, 2] <= sizes[:, 0])) if self.cut else ():
            share = sizes[k, 2] / sizes[k, 0]
            step = most if share * most <= self.limits[2] else int(self.limits[2] / share)
            while sizes[k, 0] >= step:
                yield [(items[k], int(starts[k]), step)]
                starts[k] += step
                sizes[k] -= (step, 0, share * step)
        alive = sizes[:, 0] > 0
        while alive.any():
            live = np.flatnonzero(alive)
            k = best_fit(self.open.left, self.limits, sizes[live])
            if k >= 0:
                k = live[k]
                self._add(items[k], int(starts[k]), int(sizes[k, 0]), sizes[k, 2])
                alive[k] = False
            else:
                room = self.open.left
                if self.cut and room[0] >= 1 and room[1] >= 1:
                    share = sizes[live, 2] / sizes[live, 0]
                    part = np.minimum(room[0], np.where(share > 0, np.floor(room[2] / np.maximum(share, 1e-9)), room[0]))
                    part = np.minimum(part, sizes[live, 0])
                    at = int(part.argmax())
                    length, k = int(part[at]), live[at]
                    if length >= 1:
                        self._add(items[k], int(starts[k]), length, share[at] * length)
                        starts[k] += length
                        sizes[k] -= (length, 0, share[at] * length)
                        alive[k] = sizes[k, 0] > 0
                yield self._close()
            if self.open.left[0] == 0:
                yield self._close()

    def rest(self) -> Iterator[list[tuple[int, int, int]]]:
        """The open bin at the end; with cutting, as sequences of powers of two, which need no padding."""
        yield from powers_of_two(self._close()) if self.cut else [p for p in [self._close()] if p]


def powers_of_two(pieces: list[tuple[int, int, int]]) -> Iterator[list[tuple[int, int, int]]]:
    """A bin cut again, into sequences whose lengths are the binary digits of its length, largest first."""
    total, pieces = sum(p[2] for p in pieces), pieces[::-1]
    for bit in reversed(range(total.bit_length())):
        room, out = total & (1 << bit), []
        while room:
            item, start, length = pieces.pop()
            part = min(room, length)
            out.append((item, start, part))
            if part < length:
                pieces.append((item, start + part, length - part))
            room -= part
        if out:
            yield out


class _Tokens(PieceTable):
    """Ids by the ``tokenizers`` library, each distinct piece once."""

    def __init__(self, content: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(content)
        encode = getattr(self.tokenizer, "encode_batch_fast", self.tokenizer.encode_batch)
        super().__init__(lambda pieces: [e.ids for e in encode([p.decode() for p in pieces], add_special_tokens=False)])
        added = [t.content.encode() for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.added = re.compile(b"|".join(map(re.escape, added))) if added else None

    def whole(self, data: np.ndarray, edge: np.ndarray) -> dict[int, np.ndarray]:
        """Ids of the texts that may hold the wording of an added token, which the library takes out before it cuts pieces."""
        if self.added is None:
            return {}
        raw = data.tobytes()
        texts = {int(np.searchsorted(edge, m.start(), "right")) - 1 for m in self.added.finditer(raw)}
        return {k: np.array(self.tokenizer.encode(raw[edge[k] : edge[k + 1]].decode(), add_special_tokens=False).ids, np.uint32) for k in texts}


_tables: dict[bytes, _Tokens] = {}


def _table(content: bytes) -> _Tokens:
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    key = hashlib.sha256(content).digest()
    if key not in _tables:
        _tables[key] = _Tokens(content.decode())
    return _tables[key]


def token_lists(data: np.ndarray, borders: np.ndarray, content: bytes, end: int = END) -> Iterator[np.ndarray]:
    """Each text's ids, as the library gives them without special tokens around the text, and the end id."""
    table = _table(content)
    for a, b in slices(borders, PIECE_BYTES):
        part, edge = data[borders[a] : borders[b]], borders[a : b + 1] - borders[a]
        starts = piece_starts(part, edge)
        tokens, count = table.tokens(table.rows(part, starts))
        total = np.concatenate(([0], np.cumsum(count)))[np.searchsorted(starts, edge)]
        whole = table.whole(part, edge)
        for k in range(b - a):
            yield np.append(whole[k] if k in whole else tokens[total[k] : total[k + 1]], np.uint32(end))


def pack_documents(
    docs: DataFrame,
    tokenizer: str,
    tokens: int = 2048,
    segments: int = 256,
    loss: int | None = None,
    loss_column: str | None = None,
    id_column: str = "doc_id",
    text_column: str = "text",
    ids: bool = True,
) -> DataFrame:
    """(id, start, length, ids_crc32, doc_tokens, sequence_id, offset[, ids]): pieces of documents in sequences.

    ``tokenizer`` is a file of the ``tokenizers`` library with byte-level pieces, read by the driver. A
    document is its ids and a last id 1; a null or empty text is that id alone. ``loss`` limits the
    loss-bearing tokens of a sequence (as many as tokens, if None); ``loss_column`` has their number in
    each document, null for all, taken as spread evenly where a document is cut. Each partition packs what it is given in its order, a batch at a time with one bin kept open,
    so memory follows a batch and not the partition; the last bin is cut into powers of two. Sequence
    ids hold the partition's number. ``ids`` gives each piece's ids as little-endian 32-bit numbers.
    Rows with null or repeated ids are documents like others; an empty table gives no rows.
    """
    spark = prepare(docs.sparkSession)
    with open(tokenizer, "rb") as f:
        content = spark.sparkContext.broadcast(f.read())
    limits = (tokens, segments, tokens if loss is None else loss)
    if min(limits) < 1:
        raise ValueError("every limit must be 1 at least")
    bearing = F.lit(None) if loss_column is None else F.col(loss_column)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer, sequence = Packer(*limits, cut=True), TaskContext.get().partitionId() << 32
        held: dict[int, tuple[object, np.ndarray]] = {}  # documents of this batch and of the open bin
        number = 0

        def rows(bins: list[list[tuple[int, int, int]]]) -> pa.RecordBatch:
            nonlocal sequence
            out: list[list] = [[] for _ in range(8)]
            for pieces in bins:
                offset = 0
                for item, start, length in pieces:
                    name, all_ids = held[item]
                    raw = all_ids[start : start + length].astype("<u4").tobytes()
                    for column, value in zip(out, (name, start, length, zlib.crc32(raw), len(all_ids), sequence, offset, raw), strict=True):
                        column.append(value)
                    offset += length
                sequence += 1
            kinds = [kind, *[pa.int64()] * 6, pa.binary()]
            names = [id_column, "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "ids"]
            arrays = [pa.array(c, k) for c, k in zip(out, kinds, strict=True)]
            return pa.RecordBatch.from_arrays(arrays[: None if ids else 7], names[: None if ids else 7])

        kind = pa.int64()
        for batch in batches:
            kind = batch.column(0).type
            names = batch.column(0).to_pylist()
            data, borders = text_bytes(batch.column(1))
            first = number
            for name, tokens_of in zip(names, token_lists(data, borders, content.value), strict=True):
                held[number] = (name, tokens_of)
                number += 1
            lengths = np.array([len(held[k][1]) for k in range(first, number)], np.int64)
            losses = lengths.astype(float)
            if loss_column is not None:
                given = batch.column(2).to_numpy(zero_copy_only=False)
                losses = np.where(np.isnan(given), losses, np.clip(given, 0, lengths))
            yield rows(list(packer.pack(list(range(first, number)), lengths, losses)))
            kept = {p[0] for p in packer.open.pieces}
            held = {k: v for k, v in held.items() if k in kept}
        yield rows(list(packer.rest()))

    kind = docs.select(id_column).schema[0].dataType.simpleString()
    schema = f"`{id_column}` {kind}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, `offset` long" + ", ids binary" * ids
    return docs.select(F.col(id_column), F.col(text_column).cast("string"), bearing.cast("double")).mapInArrow(returning(work), schema)
