"""Byte-level BPE by dynamic programming over prefixes."""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from icuriver.llm.common import prepare, returning, slices, text_bytes
from icuriver.llm.pieces import PIECE_BYTES, Numbers, PieceTable, piece_starts

#: Pair decisions kept in a worker.
PAIRS = 400_000


def read_ranks(content: bytes) -> dict[bytes, int]:
    """Token bytes to rank, from lines of base64 and a number."""
    return {base64.b64decode(a): int(b) for a, b in (line.split() for line in content.splitlines() if line.strip())}


class PrefixEncoder:
    """Encodes bytes by the last token of every prefix.

    Every prefix has exactly one encoding, so exactly one last token: the token that ends there and
    stands validly after the last token of what precedes it. Two tokens stand validly side by side if
    merging their bytes gives just these two. A state is the list of last tokens, one for each byte;
    it grows by appending, and after an edit only the bytes near it are worked on again.
    """

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.bytes = {r: t for t, r in ranks.items()}
        self.longest = max(map(len, ranks), default=1)
        self.pairs: dict[tuple[int, int], bool] = {}
        self.single: dict[int, bool] = {}

    def merged(self, data: bytes) -> list[int]:
        """Plain merging, lowest rank first; for short strings."""
        parts = [data[i : i + 1] for i in range(len(data))]
        while len(parts) > 1:
            best, at = None, -1
            for i in range(len(parts) - 1):
                rank = self.ranks.get(parts[i] + parts[i + 1])
                if rank is not None and (best is None or rank < best):
                    best, at = rank, i
            if best is None:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return [self.ranks[p] for p in parts]

    def follows(self, left: int, right: int) -> bool:
        key = (left, right)
        found = self.pairs.get(key)
        if found is None:
            if len(self.pairs) >= PAIRS:
                self.pairs.clear()
            found = self.pairs[key] = self.merged(self.bytes[left] + self.bytes[right]) == [left, right]
        return found

    def stands_alone(self, token: int) -> bool:
        found = self.single.get(token)
        if found is None:
            found = self.single[token] = self.merged(self.bytes[token]) == [token]
        return found

    def extend(self, last: list[int], data: bytes, upto: int | None = None) -> list[int]:
        """Last tokens of all prefixes of ``data`` (of at most ``upto`` bytes), of which ``last`` has the first ones."""
        ranks, pairs, longest = self.ranks, self.pairs, self.longest
        for end in range(len(last) + 1, (len(data) if upto is None else upto) + 1):
            for begin in range(max(0, end - longest), end):
                token = ranks.get(data[begin:end])
                if token is None:
                    continue
                if begin:
                    fits = pairs.get((last[begin - 1], token))
                    if fits is None:
                        fits = self.follows(last[begin - 1], token)
                else:
                    fits = self.stands_alone(token)
                if fits:
                    last.append(token)
                    break
            else:
                raise ValueError("a byte has no token")
        return last

    def edit(self, last: list[int], data: bytes, start: int, end: int, new: bytes) -> tuple[list[int], bytes]:
        """State and bytes after ``data[start:end]`` has become ``new``; equal to encoding anew."""
        changed = data[:start] + new + data[end:]
        out, same = last[:start], 0
        shift = len(changed) - len(data)
        for upto in range(start + 1, len(changed) + 1):
            self.extend(out, changed, upto)
            old = upto - shift
            same = same + 1 if upto > start + len(new) and out[-1] == last[old - 1] else 0
            if same >= self.longest:
                return out + last[old:], changed
        return out, changed

    def tokens(self, last: list[int]) -> list[int]:
        out, at = [], len(last)
        while at:
            out.append(last[at - 1])
            at -= len(self.bytes[last[at - 1]])
        return out[::-1]

    def pieces(self, pieces: list[bytes]) -> list[list[int]]:
        """Ids of each piece. A piece that is a token is that token; sorted pieces share their prefixes' states."""
        out, last, before = [], [], b""
        for piece in pieces:
            whole = self.ranks.get(piece)
            if whole is not None:
                out.append([whole])
                continue
            keep, most = 0, min(len(piece), len(before))
            while keep < most and piece[keep] == before[keep]:
                keep += 1
            last = self.extend(last[:keep], piece)
            before = piece
            out.append(self.tokens(last))
        return out


class _Texts(PieceTable):
    """Also keeps each piece's ids as decimal text and the bytes they decode to."""

    def __init__(self, encoder: PrefixEncoder):
        self.encoder = encoder
        super().__init__(encoder.pieces)

    def forget(self) -> None:
        super().forget()
        self.decimal, self.decoded = Numbers(object), Numbers(object)

    def add(self, pieces: list[bytes]) -> None:
        old = self.begin.n
        super().add(pieces)
        begin, count, ids = self.begin.view()[old:].tolist(), self.count.view()[old:].tolist(), self.ids.view()
        lists = [ids[a : a + n].tolist() for a, n in zip(begin, count, strict=True)]
        self.decimal.add(np.array([*(b",".join(b"%d" % i for i in x) for x in lists), None], object)[:-1])
        self.decoded.add(np.array([*(b"".join(self.encoder.bytes[i] for i in x) for x in lists), None], object)[:-1])


_tables: dict[bytes, _Texts] = {}


def _table(content: bytes) -> _Texts:
    key = hashlib.sha256(content).digest()
    if key not in _tables:
        _tables[key] = _Texts(PrefixEncoder(read_ranks(content)))
    return _tables[key]


def encode_texts(docs: DataFrame, vocabulary: str, id_column: str = "doc_id", text_column: str = "text", ids: bool = True) -> DataFrame:
    """(id, n_tokens, ids_sha256, decoded_sha256) and, if asked, the ids of every whole text.

    ``vocabulary`` is a file of ranks, read by the driver and sent to the workers. Texts are cut into
    pieces and each distinct piece of a slice is encoded once. The digests are of the ids in decimal,
    joined by commas, and of the bytes that the ids decode to. A null text counts as empty: no ids,
    digests of nothing. Rows are independent, so null or repeated ids and other columns change nothing.
    """
    spark = prepare(docs.sparkSession)
    with open(vocabulary, "rb") as f:
        content = spark.sparkContext.broadcast(f.read())

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = _table(content.value)
        for batch in batches:
            data, borders = text_bytes(batch.column(1))
            counts, of_ids, of_text, lists = [], [], [], []
            for a, b in slices(borders, PIECE_BYTES):
                part, edge = data[borders[a] : borders[b]], borders[a : b + 1] - borders[a]
                starts = piece_starts(part, edge)
                rows = table.rows(part, starts)
                cut = np.searchsorted(starts, edge)
                tokens, count = table.tokens(rows)
                total = np.concatenate(([0], np.cumsum(count)))[cut]
                decimal = table.decimal.view()[rows].tolist()
                decoded = table.decoded.view()[rows].tolist()
                for k in range(b - a):
                    counts.append(int(total[k + 1] - total[k]))
                    of_ids.append(hashlib.sha256(b",".join(decimal[cut[k] : cut[k + 1]])).hexdigest())
                    of_text.append(hashlib.sha256(b"".join(decoded[cut[k] : cut[k + 1]])).hexdigest())
                    if ids:
                        lists.append(tokens[total[k] : total[k + 1]].astype(np.int32))
            columns = [batch.column(0), pa.array(counts, pa.int64()), pa.array(of_ids, pa.string()), pa.array(of_text, pa.string())]
            names = [id_column, "n_tokens", "ids_sha256", "decoded_sha256"]
            if ids:
                columns.append(pa.array(lists, pa.list_(pa.int32())))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(columns, names)

    kind = docs.select(id_column).schema[0].dataType.simpleString()
    schema = f"`{id_column}` {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * ids
    return docs.select(F.col(id_column), F.col(text_column).cast("string")).mapInArrow(returning(work), schema)
