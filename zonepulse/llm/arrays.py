"""Arrow and numpy helpers that the text operators share."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import SparkSession

#: Rows of one Arrow batch; a batch then holds at most as many texts, however long they are.
BATCH_ROWS = 512
#: Bytes of text that one numpy pass handles; a longer text is a pass of its own.
SLICE_BYTES = 1 << 18

MULTIPLIER = 0x9E3779B97F4A7C15
INVERSE = pow(MULTIPLIER, -1, 1 << 64)


def small_batches(spark: SparkSession) -> None:
    """Keep Arrow batches of whole texts small for this session."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))


def slices(batch: pa.RecordBatch, text: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Consecutive parts of a batch with about ``limit`` bytes of text each; rows stay whole.

    Memory that Arrow holds for reuse goes back after each batch, as idle workers of earlier stages would keep it.
    """
    size = pa.compute.binary_length(batch.column(text)).fill_null(0).to_numpy(zero_copy_only=False)
    at, held = 0, 0
    for i, n in enumerate(size):
        if i > at and held + n > limit:
            yield batch.slice(at, i - at)
            at, held = i, 0
        held += int(n)
    if at < len(size):
        yield batch.slice(at)
    pa.default_memory_pool().release_unused()


def utf8(batch: pa.RecordBatch, text: str) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a text column, and the offsets of its rows; null counts as empty."""
    column = batch.column(text)
    if not pa.types.is_large_string(column.type):
        column = column.cast(pa.large_string())
    column = column.fill_null("")
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    ends = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    flat = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return flat[ends[0] : ends[-1]], ends - ends[0]


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser of a 64-bit hash."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base & (2**64 - 1), np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


class Rolling:
    """Karp-Rabin fingerprints of any short substring of a byte array, modulo 2**64.

    Texts made for it (Thue-Morse words) collide from about 512 bytes on; ``PrimeRolling`` is for strings of any length.
    """

    #: Fixed pseudo-random value of each byte.
    BYTES = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(MULTIPLIER))

    def __init__(self, data: np.ndarray) -> None:
        n = len(data)
        self.back = powers(INVERSE, n + 1)
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(self.BYTES[data] * powers(MULTIPLIER, n), out=self.sums[1:])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.sums[end] - self.sums[start]) * self.back[start])


#: Two primes below 2**31, so that products of remainders and sums of four thousand million of them fit in 64 bits.
PRIMES = (2**31 - 1, 2**31 - 19)
#: Bases of the fingerprints modulo each prime.
BASES = (1_103_515_245 % PRIMES[0], 1_664_525_477 % PRIMES[1])
#: Powers up to this exponent are kept by a worker.
KEPT_POWERS = 1 << 20


def _powers_modulo(base: int, prime: int, n: int) -> np.ndarray:
    """base**0 to base**(n - 1) modulo the prime, by doubling."""
    out = np.ones(max(n, 1), np.uint64)
    done = 1
    while done < n:
        more = min(done, n - done)
        out[done : done + more] = out[:more] * np.uint64(pow(base, done, prime)) % np.uint64(prime)
        done += more
    return out[:n].astype(np.uint32)


@lru_cache(maxsize=4)
def _kept_powers(base: int, prime: int) -> np.ndarray:
    return _powers_modulo(base, prime, KEPT_POWERS)


def prime_powers(base: int, prime: int, n: int) -> np.ndarray:
    return _kept_powers(base, prime)[:n] if n <= KEPT_POWERS else _powers_modulo(base, prime, n)


class PrimeRolling:
    """Karp-Rabin fingerprints of any run of an array of codes, modulo two primes at once.

    ``codes`` are bytes or 64-bit hashes. Two different runs of n items agree with a probability of about (n / 2**31)**2, whatever
    their structure, as the value of a code is pseudo-random modulo either prime.
    """

    #: Fixed pseudo-random value of each byte.
    BYTES = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(MULTIPLIER))

    def __init__(self, codes: np.ndarray) -> None:
        n = len(codes)
        self.parts = []
        for k, (base, prime) in enumerate(zip(BASES, PRIMES, strict=True)):
            p, shift = np.uint64(prime), np.uint64(32 * k)
            if codes.dtype == np.uint8:
                values = ((self.BYTES >> shift) % p)[codes]
            else:
                values = (codes >> shift) % p
            values *= prime_powers(base, prime, n)
            values %= p
            sums = np.zeros(n + 1, np.uint64)
            np.cumsum(values, out=sums[1:])
            self.parts.append((p, sums, prime_powers(pow(base, -1, prime), prime, n + 1)))

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Fingerprints of the runs from start to before end."""
        found = [(sums[end] - sums[start]) % p * back[start] % p for p, sums, back in self.parts]
        return mix((found[0] << np.uint64(32) | found[1]) + np.uint64(1))

    def windows(self, width: int) -> np.ndarray:
        """Fingerprints of all runs of ``width`` items, in order."""
        found = []
        for p, sums, back in self.parts:
            h = sums[width:] - sums[: max(0, len(sums) - width)]
            h %= p
            h *= back[: len(h)]
            h %= p
            found.append(h)
        return mix((found[0] << np.uint64(32) | found[1]) + np.uint64(1))


def word_hashes(data: np.ndarray, offsets: np.ndarray, is_space: np.ndarray, fold: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each word of each row, and the row it is in; ``fold`` maps bytes first."""
    if not len(data):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    word = ~is_space[data]
    first = np.zeros(len(data) + 1, bool)
    first[offsets] = True
    edge = np.ones(len(data) + 1, bool)
    edge[1:] = ~np.append(word, False)[:-1]
    starts = np.flatnonzero(word & (edge | first)[:-1])
    after = np.append(~word[1:], True) | first[1:]
    ends = np.flatnonzero(word & after) + 1
    rows = np.searchsorted(offsets, starts, side="right") - 1
    return PrimeRolling(fold[data]).of(starts, ends), rows


def shingle_hashes(words: np.ndarray, rows: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each run of ``width`` words; a row with fewer words is one run of all its words."""
    n = len(words)
    if not n:
        return words, rows
    start = np.flatnonzero(np.append(True, rows[1:] != rows[:-1]))
    count = np.diff(np.append(start, n))
    place = np.arange(n) - np.repeat(start, count)
    length = np.minimum(np.repeat(count, count), width)
    keep = place <= np.repeat(count, count) - length
    total = np.zeros(n, np.uint64)
    for j, factor in enumerate(powers(MULTIPLIER, width)):
        reach = np.minimum(np.arange(n) + j, n - 1)
        total += np.where(j < length, mix(words[reach] + np.uint64(1)) * factor, np.uint64(0))
    return mix(total + length.astype(np.uint64))[keep], rows[keep]


def distinct_in_rows(values: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct values of each row."""
    order = np.lexsort((values, rows))
    values, rows = values[order], rows[order]
    new = np.ones(len(values), bool)
    new[1:] = (values[1:] != values[:-1]) | (rows[1:] != rows[:-1])
    return values[new], rows[new]


def ascii_tables() -> tuple[np.ndarray, np.ndarray]:
    """White space is bytes 9 to 13 and 32; the fold lower-cases A to Z."""
    space = np.zeros(256, bool)
    space[[9, 10, 11, 12, 13, 32]] = True
    fold = np.arange(256, dtype=np.uint8)
    fold[65:91] += 32
    return space, fold
