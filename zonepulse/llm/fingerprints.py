"""Document fingerprints by one-permutation MinHash with optimal densification.

Every shingle (eight code points) is hashed once; the top bits choose one of 256 bins and each bin keeps its least hash.
An empty bin tries bins that a universal hash of (bin, attempt) names, until it meets a filled one, and takes over its value.
Of each value the low four bits are kept. The share of equal places, less the share that chance gives, estimates the likeness.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zonepulse.llm.arrays import SLICE_BYTES, Rolling, mix, small_batches
from zonepulse.llm.order import NULL_KEY, range_parts

BINS, BITS, WIDTH = 256, 4, 8
EMPTY = np.uint64(2**64 - 1)
#: Rows: attempts; the bin that each bin tries then. Beyond them it walks on from the last.
TRIES = (mix(np.arange(64 * BINS, dtype=np.uint64) + np.uint64(0xC0FFEE)) % np.uint64(BINS)).astype(np.int64).reshape(64, BINS)


def _bins(texts: list[str], width: int) -> np.ndarray:
    """Least hash in each bin of each text; no densification yet."""
    raw = [t.encode("utf-8", "surrogatepass") for t in texts]
    data = np.frombuffer(b"".join(raw), np.uint8)
    out = np.full(len(texts) * BINS, EMPTY)
    if len(data):
        ends = np.cumsum([len(x) for x in raw])
        starts = np.flatnonzero((data & 0xC0) != 0x80)
        rows = np.searchsorted(ends, starts, side="right")
        count = np.bincount(rows, minlength=len(texts))
        stop = np.cumsum(count)
        # A shingle ends where the width-th next code point of its row starts, or at the row's end.
        reach = np.arange(len(starts)) + width
        limit = stop[rows]
        end = np.where(reach < limit, starts[np.minimum(reach, len(starts) - 1)], ends[rows])
        whole = (reach <= limit) | (np.arange(len(starts)) == limit - count[rows])
        h = Rolling(data).of(starts[whole], end[whole])
        np.minimum.at(out, rows[whole] * BINS + (h >> np.uint64(56)).astype(np.int64), h & np.uint64(2**56 - 1))
    return out.reshape(len(texts), BINS)


def fingerprints(texts: list[str], width: int = WIDTH) -> np.ndarray:
    """One row of BINS small numbers per text; a row of 255 for an empty text."""
    bins = _bins(texts, width)
    filled = bins != EMPTY
    some = filled.any(axis=1)
    dense = bins.copy()
    open_ = ~filled & some[:, None]
    for attempt in TRIES:
        if not open_.any():
            break
        take = open_ & filled[:, attempt]
        dense = np.where(take, bins[:, attempt], dense)
        open_ &= ~take
    for step in range(1, BINS if open_.any() else 1):
        there = (TRIES[-1] + step) % BINS
        take = open_ & filled[:, there]
        dense = np.where(take, bins[:, there], dense)
        open_ &= ~take
    low = (mix(dense) & np.uint64(2**BITS - 1)).astype(np.uint8)
    low[~some] = 255
    return low


def packed(row: np.ndarray) -> str:
    """Hexadecimal form, one digit per bin; empty for an empty text."""
    return "" if row[0] == 255 else "".join(map("0123456789abcdef".__getitem__, row))


def likeness(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Estimated Jaccard likeness of rows of fingerprints, corrected for chance; two empty texts are alike."""
    chance = 0.5**BITS
    alike = np.clip(((x == y).mean(axis=1) - chance) / (1 - chance), 0.0, 1.0)
    alike[(x[:, 0] == 255) != (y[:, 0] == 255)] = 0.0
    return alike


def edited(text: str, following: str) -> str:
    """The last third of the code points replaced by the first as many of the following text."""
    m = len(text) // 3
    return text[: len(text) - m] + following[:m]


FIELDS = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(batch.column(c).to_pylist() for c in ("doc_id", "halo", "text")), strict=True)


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come in order, the first row of the next range last; every row but that one is compared with the row after it."""

    def done(rows: list[tuple]) -> pa.RecordBatch:
        texts = [t for _, _, t in rows]
        own = fingerprints(texts)
        new = [edited(t, u) for t, u in zip(texts, texts[1:], strict=False)]
        other = fingerprints(new)
        cols = [
            pa.array([r[0] for r in rows[:-1]], pa.int64()), pa.array([len(t) for t in texts[:-1]], pa.int64()),
            pa.array([hashlib.sha256(t.encode("utf-8", "surrogatepass")).hexdigest() for t in new]), pa.array(map(packed, own[:-1]), pa.string()), pa.array(map(packed, other), pa.string()),
            pa.array(likeness(own[:-1], other)), pa.array(likeness(own[:-1], own[1:])),
        ]
        return pa.RecordBatch.from_arrays(cols, names=[x.split()[0] for x in FIELDS.split(", ")])

    held: list[tuple] = []
    size = 0
    for row in _rows(batches):
        held.append(row)
        size += len(row[2])
        if row[1]:
            break
        if size > SLICE_BYTES // 2 and len(held) > 1:
            yield done(held)
            held, size = [row], len(row[2])
    if len(held) > 1:
        yield done(held)


def compare_with_next(docs: DataFrame) -> DataFrame:
    """Fingerprints of each text and of its edited text, and their likeness to each other and to the next document's.

    Documents follow each other by falling doc_id, a null id last, equal ids by text; after the last comes the first. Each
    range of ids is one partition, sorted, and gets the first document of the next range besides. A null text is empty.
    A repeated row is a document of its own. A single document is its own next. An empty table gives no rows.
    """
    spark = docs.sparkSession
    small_batches(spark)
    bare = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    dealt, n = range_parts(bare, "doc_id")
    key = F.coalesce("doc_id", F.lit(NULL_KEY))
    # One row per range that has documents: bounded by the number of partitions.
    heads = {r["part"]: r["head"] for r in dealt.groupBy("part").agg(F.max(key).alias("head")).collect()}
    used = sorted(heads)
    before = {p: q for p, q in zip(used, used[1:] + used[:1], strict=True)}
    head = F.array(*[F.lit(heads.get(p)).cast("long") for p in range(n)])
    target = F.array(*[F.lit(before.get(p)).cast("int") for p in range(n)])
    extra = dealt.where(key == head[F.col("part")]).select("doc_id", "text", target[F.col("part")].alias("part"), F.lit(1).alias("halo"))
    all_rows = dealt.select("doc_id", "text", "part", F.lit(0).alias("halo")).unionAll(extra)
    ordered = all_rows.repartitionById(n, F.col("part")).sortWithinPartitions("halo", F.desc(key), "text")
    return ordered.select("doc_id", "halo", "text").mapInArrow(_compare, FIELDS)
