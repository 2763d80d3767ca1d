"""Cuts a column of texts into pieces at borders that no token of either tokenizer crosses, in numpy."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa

SPACE, LINE = 0x20, 0x0A
ZERO = np.zeros(1, np.uint8)
#: Bytes that are looked at together, so that they stay in a core's cache, and how many before a byte tell whether there is a cut.
PART, REACH = 1 << 16, 4
#: New pieces that are encoded as one text; 8 took a fifth longer, hundreds longer too.
TOGETHER = 48


def borders(data: np.ndarray, starts: np.ndarray, marks: bytes) -> np.ndarray:
    """Ascending places before which the UTF-8 bytes are cut: every row's start, and inside rows

    - before a single space or line end that follows no white space;
    - after a line end that stands between characters that are no white space;
    - before one of ``marks`` (full stop, comma) that follows an ASCII letter or digit.

    Where a neighbour might be white space beyond ASCII, there is no cut: fewer cuts are always right.
    """
    n = len(data)
    at = np.zeros(n + 1, bool)
    for lo in range(0, n, PART):
        back = min(lo, REACH)
        found = _inside(data[lo - back : lo + PART], marks)[back:]
        at[lo : lo + len(found)] = found
    at[starts] = True
    at[n] = False
    return np.flatnonzero(at)


def _inside(data: np.ndarray, marks: bytes) -> np.ndarray:
    """Whether there is a cut before each byte; never before the first."""
    at = np.zeros(len(data), bool)
    if len(data) > 1:
        before, here = data[:-1], data[1:]
        ink = before > SPACE
        lead2 = np.append(ZERO, data[:-2])
        lead3 = np.concatenate([ZERO, ZERO, data[:-3]])[: len(data) - 1]
        # A character of two or three bytes that may be white space begins with one of these.
        ink &= ~((before >= 0x80) & ((lead2 == 0xC2) | ((lead3 >= 0xE1) & (lead3 <= 0xE3))))
        follows = (here > SPACE) & (here != 0xC2) & ~((here >= 0xE1) & (here <= 0xE3))
        cut = ink & ((here == SPACE) | (here == LINE))
        cut |= (before == LINE) & np.append(False, ink[:-1]) & follows
        folded = before | 0x20
        sign = ((folded >= 97) & (folded <= 122)) | ((before >= 48) & (before <= 57))
        for mark in marks:
            cut |= sign & (here == mark)
        at[1:] = cut
    return at


def as_pieces(data: np.ndarray, cut: np.ndarray) -> pa.Array:
    """The parts between the cuts; they join to the data."""
    ends = np.append(cut, len(data)).astype(np.int64)
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(cut), [None, pa.py_buffer(ends.tobytes()), pa.py_buffer(data.tobytes())])


class PieceIds:
    """Token ids of whole texts from those of their distinct pieces, which are remembered up to about ``limit`` pieces or ``most`` ids.

    ``sizes`` are the bytes that each token id stands for. With them new pieces that begin with a space are encoded many at a time, as
    a call of the tokenizer takes longer than a short piece: where a cut stands between two of them they are one text, and the
    bytes tell whose an id is. Should an id reach over the end of a piece, all new pieces are encoded one by one.
    """

    def __init__(self, encode: Callable[[list[str]], list[list[int]]], marks: bytes = b".,", limit: int = 900_000, most: int = 1 << 23, sizes: np.ndarray | None = None) -> None:
        self.encode, self.marks, self.limit, self.most, self.sizes = encode, marks, limit, most, sizes
        self._forget()

    def _forget(self) -> None:
        self.number: dict[bytes, int] = {}
        self.count, self.ids = np.zeros(0, np.int64), np.zeros(0, np.uint32)

    def _together(self, keys: list[bytes]) -> tuple[np.ndarray, np.ndarray] | None:
        """Ids of the pieces, one after the other, and how many each has; nothing if the sizes do not tell."""
        raw = b"".join(keys)
        data, ends = np.frombuffer(raw, np.uint8), np.cumsum([len(k) for k in keys])
        at = np.zeros(len(data), bool)
        at[borders(data, np.zeros(1, np.int64), b"")] = True
        joint = at[ends[:-1]] & (data[ends[:-1]] == SPACE)
        joint[TOGETHER - 1 :: TOGETHER] = False
        edges = [0, *ends[:-1][~joint].tolist(), len(raw)]
        found = self.encode([raw[a:b].decode() for a, b in zip(edges, edges[1:], strict=False)])
        ids = np.concatenate([np.array(x, np.uint32) for x in found])
        reach = np.cumsum(self.sizes[ids])
        last = np.searchsorted(reach, ends)
        if last[-1] != len(reach) - 1 or (reach[last] != ends).any():
            return None
        return ids, np.diff(last, prepend=-1)

    def _encoded(self, keys: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        if self.sizes is not None and (found := self._together(keys)):
            return found
        one_by_one = [np.array(x, np.uint32) for x in self.encode([k.decode() for k in keys])]
        return np.concatenate(one_by_one), np.array([len(x) for x in one_by_one], np.int64)

    def _numbers(self, keys: list[bytes]) -> np.ndarray:
        """Numbers of distinct pieces; new ones are encoded."""
        if len(self.number) > self.limit or len(self.ids) > self.most:
            self._forget()
        new = [k for k in keys if k not in self.number]
        if new:
            new.sort(key=lambda k: k[0] != SPACE)
            ids, count = self._encoded(new)
            self.number.update(zip(new, range(len(self.number), len(self.number) + len(new)), strict=True))
            self.count = np.concatenate([self.count, count])
            self.ids = np.concatenate([self.ids, ids])
        return np.fromiter(map(self.number.__getitem__, keys), np.int64, len(keys))

    def __call__(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the rows of UTF-8 bytes, one row after the other, and how many each row has."""
        rows = len(offsets) - 1
        if not len(data):
            return np.zeros(0, np.uint32), np.zeros(rows, np.int64)
        cut = borders(data, offsets[:-1], self.marks)
        coded = as_pieces(data, cut).dictionary_encode()
        piece = self._numbers(_values(coded.dictionary)).take(coded.indices.to_numpy())
        # Arrow copies the ids of a piece at a time, as four bytes each.
        ends = np.append(0, np.cumsum(self.count)) * 4
        known = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(self.count), [None, pa.py_buffer(ends), pa.py_buffer(self.ids)])
        _, _, ids = known.take(pa.array(piece)).buffers()
        before = np.append(0, np.cumsum(self.count.take(piece)))
        ids = np.frombuffer(ids, np.uint32, before[-1]) if before[-1] else np.zeros(0, np.uint32)
        return ids, np.diff(before[np.searchsorted(cut, offsets)])


def _values(column: pa.LargeBinaryArray) -> list[bytes]:
    """The values of a column that begins at its buffers' start, sliced from its bytes: several times as fast as a scalar for each."""
    _, offsets, data = column.buffers()
    raw, ends = data.to_pybytes(), np.frombuffer(offsets, np.int64, len(column) + 1).tolist()
    return [raw[a:b] for a, b in zip(ends, ends[1:], strict=False)]
