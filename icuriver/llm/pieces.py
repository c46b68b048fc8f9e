"""Splits text into the pieces that byte-level merges work on, a slice of a batch at a time."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import regex

from icuriver.llm.common import mix

#: Bytes cut into pieces at once. A worker holds some 41 times as many for it (traced), besides the table of pieces.
PIECE_BYTES = 1 << 19

_SPACE, _LETTER, _NUMBER, _OTHER = range(4)
#: Code points that count as white space (Unicode's White_Space).
_WHITE = [*range(9, 14), 32, 133, 160, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
_pages: dict[int, np.ndarray] = {}


def _classes(codes: np.ndarray) -> np.ndarray:
    """Space, letter, number or other, from a table that is filled for the pages of 256 code points in use."""
    pages = np.flatnonzero(np.bincount(codes >> np.uint32(8)))
    top = int(pages[-1]) + 1 if len(pages) else 1
    full = np.full((top, 256), _OTHER, np.uint8)
    for page in map(int, pages):
        if page not in _pages:
            kinds = np.full(256, _OTHER, np.uint8)
            chars = [chr(page * 256 + k) for k in range(256)]
            kinds[[k for k in range(256) if regex.match(r"\p{L}", chars[k])]] = _LETTER
            kinds[[k for k in range(256) if regex.match(r"\p{N}", chars[k])]] = _NUMBER
            kinds[[w - page * 256 for w in _WHITE if w >> 8 == page]] = _SPACE
            _pages[page] = kinds
        full[page] = _pages[page]
    return full.ravel()[codes]


def piece_starts(data: np.ndarray, borders: np.ndarray) -> np.ndarray:
    """Byte positions where a piece starts; no piece crosses a border between texts.

    The same cuts as the usual pattern makes: contractions, runs of letters, of numbers and of other
    signs, each with one space before it, and white space apart from that space.
    """
    at = np.flatnonzero((data & 0xC0) != 0x80)
    if not len(at):
        return at
    codes = np.frombuffer(data.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
    kind = _classes(codes)
    n = len(codes)
    first = np.zeros(n + 1, bool)
    if len(at) == len(data):
        first[borders[:-1]] = True
    else:
        first[np.searchsorted(at, borders[:-1])] = True
    first[n] = True
    start = first.copy()
    start[1:n] |= kind[1:] != kind[:-1]
    space = kind == _SPACE
    # the last of some spaces that a text goes on after: one blank joins what follows, another sign stands alone
    tail = np.flatnonzero(space[:-1] & ~space[1:] & ~first[1:n])
    start[tail] = True
    start[tail[codes[tail] == 32] + 1] = False
    quote = np.flatnonzero(codes[:-1] == 39)
    quote = quote[start[quote] & (kind[quote + 1] == _LETTER) & ~first[quote + 1]]
    if len(quote):
        one = codes[quote + 1]
        two = np.where((quote + 2 < n) & ~first[np.minimum(quote + 2, n)], codes[np.minimum(quote + 2, n - 1)], 0)
        short = np.isin(one, [ord(c) for c in "stmd"])
        long = ~short & np.isin(one.astype(np.int64) * 65536 + two, [ord(a) * 65536 + ord(b) for a, b in ("re", "ve", "ll")])
        quote, length = quote[short | long], np.where(short, 1, 2)[short | long]
        start[quote + 1] = False
        after = quote + 1 + length
        after = after[after < n]
        start[after] = True
    return at[start[:n]]


#: Pieces of at most so many bytes are compared as three words, with their length in the last byte.
SHORT = 23
#: Third word of a piece that is found by its bytes; no short piece has it.
_LONG = 255 << 56
_KEEP = np.array([(1 << 8 * k) - 1 for k in range(8)] + [(1 << 64) - 1], np.uint64)


def piece_words(data: np.ndarray, starts: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Three words for each piece of at most SHORT bytes that only an equal piece shares."""
    padded = np.zeros(len(data) + 32, np.uint8)
    padded[: len(data)] = data
    at_byte = np.ndarray((len(data) + 24,), "<u8", padded.data, strides=(1,))
    words = np.empty((3, len(starts)), np.uint64)
    for k in range(3):
        words[k] = at_byte[starts + 8 * k] & _KEEP[np.clip(length - 8 * k, 0, 8)]
    words[2] |= length.astype(np.uint64) << np.uint64(56)
    return words


class Numbers:
    """A number array that grows at its end."""

    def __init__(self, kind: type):
        self.all, self.n = np.empty(1 << 12, kind), 0

    def add(self, more: np.ndarray) -> None:
        wanted = self.n + len(more)
        if wanted > len(self.all):
            grown = np.empty(max(wanted, 2 * len(self.all)), self.all.dtype)
            grown[: self.n] = self.all[: self.n]
            self.all = grown
        self.all[self.n : wanted] = more
        self.n = wanted

    def view(self) -> np.ndarray:
        return self.all[: self.n]


class PieceTable:
    """Token ids of pieces, kept for the pieces seen so far and begun anew when they are too many.

    Pieces are found by open addressing for a whole slice at once and compared word for word; the few
    longer than SHORT bytes are found by their bytes.
    """

    def __init__(self, encode: Callable[[list[bytes]], list[list[int]]], most: int = 1_000_000):
        self.encode, self.most = encode, most
        self.forget()

    def forget(self) -> None:
        self.known: dict[bytes, int] = {}
        self.ids, self.begin, self.count = Numbers(np.uint32), Numbers(np.int64), Numbers(np.int64)
        self.words = [Numbers(np.uint64) for _ in range(3)]
        self.slots = np.full(1 << 16, -1, np.int32)

    def add(self, pieces: list[bytes]) -> None:
        for part in (pieces[k : k + 16_384] for k in range(0, len(pieces), 16_384)):
            lists = self.encode(part)
            count = np.array([len(x) for x in lists], np.int64)
            self.begin.add(self.ids.n + np.cumsum(count) - count)
            self.count.add(count)
            self.ids.add(np.array([i for x in lists for i in x], np.uint32))

    @staticmethod
    def _hash(words: np.ndarray) -> np.ndarray:
        return mix(mix(words[0] + words[1] * np.uint64(0x9FB21C651E98DF25)) + words[2])

    def _find(self, words: np.ndarray, hashes: np.ndarray) -> np.ndarray:
        """Row of each piece, -1 where it is unknown."""
        top = np.uint64(len(self.slots) - 1)
        known = [w.view() for w in self.words]
        slot = (hashes & top).astype(np.int64)
        found = self.slots[slot]
        for own, all_known in zip(words, known, strict=True):
            if len(all_known):
                found = np.where((found >= 0) & (all_known[found] != own), -2, found)
        left = np.flatnonzero(found == -2)  # another piece lies there: look further
        while len(left):
            slot[left] = (slot[left] + 1) & int(top)
            at = self.slots[slot[left]]
            same = at >= 0
            for own, all_known in zip(words, known, strict=True):
                same &= all_known[at] == own[left]
            found[left] = np.where(same, at, -1)
            left = left[(at >= 0) & ~same]
        return found

    def _place(self, hashes: np.ndarray, rows: np.ndarray) -> None:
        """Put rows of new, different pieces at free slots."""
        top = len(self.slots) - 1
        slot = (hashes & np.uint64(top)).astype(np.int64)
        left = np.arange(len(rows))
        while len(left):
            free = left[self.slots[slot[left]] < 0]
            self.slots[slot[free]] = rows[free]
            left = left[self.slots[slot[left]] != rows[left]]
            slot[left] = (slot[left] + 1) & top

    def _learn(self, words: np.ndarray, hashes: np.ndarray, pieces: list[bytes]) -> None:
        first = self.begin.n
        self.add(pieces)
        for own, kept in zip(words, self.words, strict=True):
            kept.add(own)
        rows = np.arange(first, self.begin.n, dtype=np.int32)
        if 2 * self.begin.n > len(self.slots):
            self.slots = np.full(1 << int(4 * self.begin.n).bit_length(), -1, np.int32)
            every = np.stack([w.view() for w in self.words])
            real = np.flatnonzero(every[2] != np.uint64(_LONG))
            self._place(self._hash(every[:, real]), real.astype(np.int32))
        else:
            self._place(hashes, rows)

    def rows(self, data: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """The table's row of each piece of ``data``."""
        if not len(starts):
            return np.zeros(0, np.int64)
        ends = np.append(starts[1:], len(data))
        length = ends - starts
        short = length <= SHORT
        words = piece_words(data, starts, np.minimum(length, SHORT))
        hashes = self._hash(words)
        for _ in range(2):
            out = self._find(words, hashes).astype(np.int64)
            out[~short] = -1
            new = np.flatnonzero((out < 0) & short)
            _, first, inverse = np.unique(hashes[new], return_index=True, return_inverse=True)
            long = [data[a:b].tobytes() for a, b in zip(starts[~short].tolist(), ends[~short].tolist(), strict=True)]
            fresh = len(first) + sum(p not in self.known for p in set(long))
            if not self.begin.n or self.begin.n + fresh <= self.most:
                break
            self.forget()
        if len(new):
            chosen = new[first]
            # two unknown pieces with one hash: all but the first are found by their bytes
            apart = new[(words[:, new] != words[:, chosen][:, inverse]).any(axis=0)]
            pieces = [data[a:b].tobytes() for a, b in zip(starts[chosen].tolist(), ends[chosen].tolist(), strict=True)]
            by = sorted(range(len(pieces)), key=pieces.__getitem__)  # neighbours share beginnings
            order = chosen[by]
            self._learn(words[:, order], hashes[order], [pieces[k] for k in by])
            out[new] = self._find(words[:, new], hashes[new])
            out[apart] = -1
        for at in np.flatnonzero(out < 0).tolist():
            piece = data[starts[at] : ends[at]].tobytes()
            if piece not in self.known:
                self.known[piece] = self.begin.n
                self.add([piece])
                for kept, word in zip(self.words, (0, 0, _LONG), strict=True):
                    kept.add(np.array([word], np.uint64))
            out[at] = self.known[piece]
        return out

    def tokens(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all pieces end to end, and the number of each piece's."""
        count = self.count.view()[rows]
        begin = self.begin.view()[rows]
        shift = np.repeat(begin - (np.cumsum(count) - count), count)
        return self.ids.view()[shift + np.arange(len(shift))], count
