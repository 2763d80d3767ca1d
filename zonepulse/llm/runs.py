"""Periodic runs of words, by a dictionary of basic factors.

For every power of two m, each stretch of m words (a basic factor) gets a name; equal stretches of a text have equal names.
The next occurrence of a factor, d words later, proposes the period d. Occurrences that follow each other at one distance are an
arithmetic progression, and the places of consecutive factors with one distance form a stretch with period d. A run of at
least three periods q is found at the level with m/2 < q <= m: every factor that begins in it and whose next copy still
ends in it has that copy exactly q later, since a nearer one would give the run a smaller period. What is proposed is
extended as far as its period holds, and equal proposals are one run.

A name that occurs once cannot repeat, nor can any longer factor that holds it, so most levels have few factors left.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from zonepulse.llm.arrays import ascii_tables, slices, small_batches, utf8

SPACE, _ = ascii_tables()
GAP = 0x20
#: Shortest run in words, and in periods.
LEAST, TIMES = 24, 3

#: For (doc_id, number of words) the words to read in their place, or nothing if the text stays as it is.
Reading = Callable[[int | None, int], np.ndarray | None]


def _again(names: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Small numbers for equal names, and which of them occur more than once."""
    _, number, count = np.unique(names, return_inverse=True, return_counts=True)
    return number, count[number] > 1


def find_runs(codes: np.ndarray, offsets: np.ndarray, least: int = LEAST) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, length, period) of every run of at least max(least, 3 periods), sorted by start and period.

    ``codes`` are the words of all rows, ``offsets`` the rows' borders; starts count through all rows, and no run crosses a border.
    """
    n = np.diff(offsets)
    row = np.repeat(np.arange(len(n)), n)
    end = offsets[1:][row]
    long = np.flatnonzero((n >= max(least, TIMES))[row])
    found: list[np.ndarray] = []
    name = np.full(len(codes), -1, np.int64)
    if len(long):
        number, twice = _again(row[long] * (int(codes.max()) + 1) + codes[long])
        name[long[twice]] = number[twice]
    m = 1
    while True:
        at = np.flatnonzero(name >= 0)
        # A period of this level is over m / 2, and the run holds three of it.
        at = at[n[row[at]] >= TIMES * (m // 2 + 1)]
        if not len(at):
            break
        order = np.argsort(name[at], kind="stable")
        here, gap = at[order][:-1], np.diff(at[order])
        near = (name[here] == name[at[order][1:]]) & (gap * 2 > m) & (gap <= m)
        here, gap = here[near], gap[near]
        if len(here):
            order = np.lexsort((here, gap))
            here, gap = here[order], gap[order]
            new = np.append(True, (here[1:] != here[:-1] + 1) | (gap[1:] != gap[:-1]))
            first = np.flatnonzero(new)
            last = np.append(first[1:], len(here)) - 1
            found.append(np.stack([here[first], here[last] + m + gap[first], gap[first]]))
        pair = at[(at + 2 * m <= end[at])]
        pair = pair[name[pair + m] >= 0]
        longer = np.full(len(codes), -1, np.int64)
        if len(pair):
            number, twice = _again(name[pair] * (int(name.max()) + 1) + name[pair + m])
            longer[pair[twice]] = number[twice]
        name, m = longer, m * 2
    if not found:
        none = np.zeros(0, np.int64)
        return none, none, none
    start, stop, period = _extended(codes, offsets, *np.concatenate(found, axis=1))
    keep = stop - start >= np.maximum(least, TIMES * period)
    runs = np.unique(np.stack([start, period, stop - start])[:, keep], axis=1)
    return runs[0], runs[2], runs[1]


def _extended(codes: np.ndarray, offsets: np.ndarray, start: np.ndarray, stop: np.ndarray, period: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Each stretch as far as its period holds."""
    row = np.searchsorted(offsets, start, side="right") - 1
    lo, hi = offsets[row], offsets[row + 1]
    start, stop = start.copy(), stop.copy()
    open_ = np.arange(len(start))
    while len(open_):
        s = open_[start[open_] > lo[open_]]
        open_ = s[codes[start[s] - 1] == codes[start[s] - 1 + period[s]]]
        start[open_] -= 1
    open_ = np.arange(len(start))
    while len(open_):
        s = open_[stop[open_] < hi[open_]]
        open_ = s[codes[stop[s]] == codes[stop[s] - period[s]]]
        stop[open_] += 1
    return start, stop, period


class Words:
    """The words of some texts, each with a space after it, and the rows' borders."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray) -> None:
        ends = offsets[1:] + np.arange(len(offsets) - 1)
        spaced = np.insert(data, offsets[1:], GAP)
        word = ~SPACE[spaced]
        after = np.append(False, word[:-1]) & ~word
        spaced[after] = GAP
        close = np.flatnonzero(after)
        kept = np.cumsum(word | after)
        borders = np.append(0, kept[close]).astype(np.int64)
        flat = spaced[word | after]
        self.pieces = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(close), [None, pa.py_buffer(borders.tobytes()), pa.py_buffer(flat.tobytes())])
        self.offsets = np.append(0, np.searchsorted(close, ends, side="right"))


def _best(length: list[int], period: list[int]) -> int:
    """The place of the greatest length / period, the first of equals, by whole numbers."""
    best = 0
    for i in range(1, len(length)):
        if length[i] * period[best] > length[best] * period[i]:
            best = i
    return best


def periodic_runs(docs: DataFrame, reading: Reading | None = None, least: int = LEAST, keep_text: bool = False) -> DataFrame:
    """(doc_id, n_words, n_runs, start, length, period, exponent_milli, runs, runs_sha256, collapsed_sha256) of every row of (doc_id, text).

    Words are runs of bytes other than ASCII white space. A run is a stretch of words with smallest period q, at least
    max(least, 3 * q) long, that no neighbouring word extends. ``start``, ``length``, ``period`` and ``exponent_milli`` (thousandths
    of length / period, rounded down) are of the run with most periods, the first of equals, else null. ``collapsed`` (with
    ``keep_text``) is the text without words that any run holds after its first q, words joined by one space.

    A null, empty or blank text has no words, no runs and an empty collapsed text. Rows, repeated ones and those without
    doc_id included, are independent; other columns are ignored. ``reading`` may replace words by others of the same text.
    """
    small_batches(docs.sparkSession)
    fields = "doc_id long, n_words long, n_runs long, start long, length long, period long, exponent_milli long, runs array<struct<start:long,length:long,period:long>>, runs_sha256 string, collapsed_sha256 string" + ", collapsed string" * keep_text
    arrow = to_arrow_schema(StructType.fromDDL(fields))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", 1 << 20):
                yield pa.RecordBatch.from_pylist(list(_rows(part, reading, least, keep_text)), arrow)

    bare = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return bare.mapInArrow(run, fields)


def _rows(part: pa.RecordBatch, reading: Reading | None, least: int, keep_text: bool) -> Iterator[dict]:
    words = Words(*utf8(part, "text"))
    offsets, ids = words.offsets, part.column("doc_id").to_pylist()
    source = np.arange(offsets[-1])
    if reading:
        for i, doc_id in enumerate(ids):
            other = reading(doc_id, int(offsets[i + 1] - offsets[i]))
            if other is not None:
                source[offsets[i] : offsets[i + 1]] = offsets[i] + other
    codes = words.pieces.dictionary_encode().indices.to_numpy().astype(np.int64)[source]
    start, length, period = find_runs(codes, offsets, least)
    lost = np.zeros(len(source) + 1, np.int64)
    np.add.at(lost, start + period, 1)
    np.add.at(lost, start + length, -1)
    kept = np.flatnonzero(np.cumsum(lost[:-1]) == 0)
    text = words.pieces.take(pa.array(source[kept]))
    ends = np.frombuffer(text.buffers()[1], np.int64)[: len(text) + 1] if len(text) else np.zeros(1, np.int64)
    raw = memoryview(text.buffers()[2]) if len(text) else memoryview(b"")
    at = ends[np.searchsorted(kept, offsets)]
    own = np.searchsorted(start, offsets)
    for i, doc_id in enumerate(ids):
        a, b = int(own[i]), int(own[i + 1])
        runs = list(zip((start[a:b] - offsets[i]).tolist(), length[a:b].tolist(), period[a:b].tolist(), strict=True))
        first = runs[_best([x[1] for x in runs], [x[2] for x in runs])] if runs else (None, None, None)
        left = raw[at[i] : max(at[i], at[i + 1] - 1)]
        row = {
            "doc_id": doc_id, "n_words": int(offsets[i + 1] - offsets[i]), "n_runs": len(runs), "start": first[0], "length": first[1], "period": first[2],
            "exponent_milli": 1000 * first[1] // first[2] if runs else None, "runs": [dict(zip(("start", "length", "period"), x, strict=True)) for x in runs],
            "runs_sha256": hashlib.sha256("".join(f"{s},{n},{q}\n" for s, n, q in runs).encode()).hexdigest(),
            "collapsed_sha256": hashlib.sha256(left).hexdigest(),
        }
        yield row | {"collapsed": bytes(left).decode()} if keep_text else row


def planted(doc_id: int | None, n: int) -> np.ndarray | None:
    """A reading that makes the end of about a tenth of the texts periodic, chosen by the checksum of the doc_id; none without one."""
    import zlib

    if doc_id is None or not n:
        return None
    h = zlib.crc32(str(doc_id).encode())
    g = h // 10
    if h % 10:
        return None
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    i = np.arange(n)
    return np.where(i < a, i, a + (i - a) % p)
