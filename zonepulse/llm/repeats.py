"""Exact removal of byte strings that occur twice, by prefix-free parsing.

The trigger of a string is the first of its 16-byte windows with the least rolling hash. Triggers cut every text in the same places
wherever the same bytes stand, so the text becomes a sequence of phrases and equal strings are parsed equally. All strings that belong to a
trigger, at distances of one segment, share their inner bytes (the core); together they make up the trigger's context, a phrase with
what surrounds it. A trigger stands for about half as many starts as the string has bytes, so there are few contexts.

Only the distinct contexts (the dictionary) matter:

1. A core that occurs once settles its strings: none repeats. Most of a corpus ends here.
2. A context that occurs twice settles its strings: all repeat, in each of its places (the parse).
3. What is left are contexts that differ around an equal core. The strings of each distinct one are named by their
   fingerprints; a name that occurs twice marks its string.

The names stand in for the ranks that suffix arrays of dictionary and parse would give: whether two strings are equal needs
no order among them, and sorting would bring all contexts of a passage that many documents share into one task. Every step
is an aggregation or an equi-join on fingerprints, so a passage in a third of all documents is pre-aggregated or split.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zonepulse.llm.arrays import PrimeRolling, slices, small_batches, utf8
from zonepulse.llm.order import NULL_KEY
from zonepulse.llm.scratch import delete, stored_at

TRIGGER = 16


def _ranges(lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """All integers of the ranges lo to hi, hi included, one range after the other."""
    count = np.maximum(hi - lo + 1, 0)
    total = int(count.sum())
    return np.arange(total) - np.repeat(np.cumsum(count) - count, count) + np.repeat(lo, count)


def sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    """The least of every ``width`` consecutive values, by doubling."""
    reach = 1
    while reach * 2 <= width:
        values = np.minimum(values[:-reach], values[reach:])
        reach *= 2
    return np.minimum(values[: len(values) - (width - reach)], values[width - reach :]) if reach < width else values


def contexts(data: np.ndarray, offsets: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """(core, context, row, lo, hi): fingerprints, and the first and last start (in the row) of the strings they stand for."""
    segment, trigger = max(1, length * 8 // 25), min(TRIGGER, length)
    none = np.zeros(0, np.int64)
    if len(data) < length:
        return np.zeros(0, np.uint64), np.zeros(0, np.uint64), none, none, none
    rolling = PrimeRolling(data)
    # The upper half is the window's fingerprint, the lower its place, so the first of equal windows is the least.
    windows = (rolling.windows(trigger) >> np.uint64(32) << np.uint64(32)) | np.arange(len(data) - trigger + 1, dtype=np.uint64)
    far = length - trigger
    at = (sliding_least(windows, far + 1) & np.uint64(0xFFFFFFFF)).astype(np.int64)
    # Strings lie in one row, so their triggers do; those of other places are left out.
    start = _ranges(offsets[:-1], offsets[1:] - length)
    row = np.repeat(np.arange(len(offsets) - 1), np.maximum(np.diff(offsets) - length + 1, 0))
    at = at[start]
    part = (at - start) // segment
    new = np.ones(len(start), bool)
    new[1:] = (row[1:] != row[:-1]) | (at[1:] != at[:-1]) | (part[1:] != part[:-1])
    lo, row, t = start[new], row[new], (at - part * segment)[new]
    hi = start[np.append(np.flatnonzero(new)[1:] - 1, len(start) - 1)] if len(start) else lo
    core = rolling.of(t, t + length - segment + 1)
    whole = rolling.of(lo, hi + length) + (hi - lo).astype(np.uint64)
    return core, whole, row, lo - offsets[row], hi - offsets[row]


def _anchors(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                core, whole, row, lo, hi = contexts(*utf8(part, "text"), length)
                key, check = (part.column(c).to_numpy(zero_copy_only=False)[row] for c in ("key", "check"))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(core.view(np.int64)), pa.array(whole.view(np.int64)), pa.array(key), pa.array(check), pa.array(lo.astype(np.int32)), pa.array(hi.astype(np.int32))],
                    names=["core", "context", "key", "check", "lo", "hi"],
                )

    return run


def _lists(batch: pa.RecordBatch, name: str) -> tuple[np.ndarray, list[np.ndarray]]:
    """Offsets of a list-of-structs column, and its fields flattened."""
    column = batch.column(name)
    flat = column.flatten()
    offsets = column.offsets.to_numpy()
    return offsets - offsets[0], [flat.field(i).to_numpy(zero_copy_only=False) for i in range(flat.type.num_fields)]


def _named(length: int):
    """Name of every string of the asked contexts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                data, offsets = utf8(part, "text")
                ends, (lo, hi, n) = _lists(part, "asked")
                of = np.repeat(np.arange(part.num_rows), np.diff(ends))
                at = _ranges(lo + offsets[of], hi + offsets[of])
                count = hi - lo + 1
                own = np.repeat(of, count)
                name = PrimeRolling(data).of(at, at + length)
                key, check = (part.column(c).to_numpy(zero_copy_only=False)[own] for c in ("key", "check"))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(name.view(np.int64)), pa.array(np.repeat(n, count)), pa.array(key), pa.array(check), pa.array((at - offsets[own]).astype(np.int32))],
                    names=["name", "n", "key", "check", "at"],
                )

    return run


def merged(start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Maximal runs of the union of half-open intervals."""
    if not len(start):
        return start, end
    order = np.argsort(start, kind="stable")
    start, end = start[order], np.maximum.accumulate(end[order])
    new = np.concatenate([[True], start[1:] > end[:-1]])
    last = np.concatenate([new[1:], [True]])
    return start[new], end[last]


def whole_characters(raw: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Spans narrowed to characters that lie in them entirely."""
    middle = np.append((raw & 0xC0) == 0x80, False)
    start, end = start.copy(), end.copy()
    for _ in range(3):
        start = np.where((start < end) & middle[start], start + 1, start)
        end = np.where((start < end) & middle[np.minimum(end, len(raw))], end - 1, end)
    some = start < end
    return start[some], end[some]


def _removed(keep: list[str], text_out: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                data, offsets = utf8(part, "text")
                ends, (lo, hi) = _lists(part, "spans")
                rows = []
                for i in range(part.num_rows):
                    raw = data[offsets[i] : offsets[i + 1]]
                    s, e = merged(lo[ends[i] : ends[i + 1]], hi[ends[i] : ends[i + 1]])
                    kept = left_over(raw, s, e)
                    row = [len(raw), int((e - s).sum()), len(s), hashlib.sha256(kept).hexdigest()]
                    rows.append([*row, left_over(raw, *whole_characters(raw, s, e)).decode("utf-8", "replace")] if text_out else row)
                kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string()]
                found = [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=False)]
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in keep), *found], names=[*keep, "n_bytes", "n_removed", "n_spans", "kept_sha256", *(["kept_text"] * text_out)])

    return run


def left_over(raw: np.ndarray, start: np.ndarray, end: np.ndarray) -> bytes:
    if not len(start):
        return raw.tobytes()
    borders = np.concatenate([[0], np.column_stack([start, end]).ravel(), [len(raw)]])
    return b"".join(raw[a:b].tobytes() for a, b in borders.reshape(-1, 2))


def remove_repeats(docs: DataFrame, length: int = 400, keep: list[str] | None = None, text_out: bool = False) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) of every row of (doc_id, text), with ``kept_text`` if asked for.

    Each byte covered by a string of ``length`` bytes that also starts anywhere else, in this or another row, is removed; all
    strings are judged on the input. ``kept_text`` keeps characters of which only some bytes are covered. ``keep`` names further
    columns to pass on.

    A null text is empty. Texts shorter than ``length`` keep all. Repeated rows are copies of each other, so from ``length``
    bytes on all of both is removed. A null doc_id stays null. Strings count as equal when their fingerprints modulo two primes of 31 bits are.
    """
    small_batches(docs.sparkSession)
    keep = ["doc_id"] if keep is None else keep
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    keyed = docs.withColumn("text", text).withColumn("key", F.coalesce(F.col("doc_id").cast("long"), F.lit(NULL_KEY))).withColumn("check", F.xxhash64("text"))
    bare = keyed.select(*dict.fromkeys([*keep, "key", "check", "text"]))
    narrow = keyed.select("key", "check", "text").where(F.octet_length("text") >= length)
    anchors = narrow.mapInArrow(_anchors(length), "core long, context long, key long, check long, lo int, hi int")
    cores = anchors.groupBy("core").agg(F.count("*").alias("n"), F.min("context").alias("c0"), F.max("context").alias("c1"))
    cores = cores.where("n > 1").select("core", (F.col("c0") != F.col("c1")).alias("mixed"))
    found, cores_at = stored_at(anchors.join(cores, "core").select("context", "mixed", "key", "check", "lo", "hi"), "cores")
    groups, _ = stored_at(found.groupBy("context", "mixed").agg(F.count("*").alias("n"), F.min(F.struct("key", "check", "lo", "hi")).alias("first")), "contexts")
    repeated = found.join(groups.where("n > 1").select("context"), "context", "left_semi").select("key", "check", F.col("lo").alias("s"), (F.col("hi") + length).alias("e"))
    repeated, _ = stored_at(repeated, "repeated")
    delete(docs.sparkSession, cores_at)
    asked = groups.where("mixed").select("first.*", F.least("n", F.lit(2)).cast("int").alias("n"))
    asked = asked.groupBy("key", "check").agg(F.collect_list(F.struct("lo", "hi", "n")).alias("asked"))
    names = narrow.join(asked, ["key", "check"]).select("key", "check", "text", "asked").mapInArrow(_named(length), "name long, n int, key long, check long, at int")
    names, names_at = stored_at(names, "names")
    twice = names.groupBy("name").agg(F.sum("n").alias("total")).where("total > 1").select("name")
    single = names.where("n = 1").join(twice, "name", "left_semi").select("key", "check", F.col("at").alias("s"), (F.col("at") + length).alias("e"))
    spans = repeated.unionAll(single).groupBy("key", "check").agg(F.collect_list(F.struct("s", "e")).alias("spans"))
    spans, _ = stored_at(spans, "spans")
    delete(docs.sparkSession, names_at)
    none = F.expr("cast(array() AS array<struct<s:int,e:int>>)")
    placed = bare.join(spans, ["key", "check"], "left").select(*dict.fromkeys([*keep, "text"]), F.coalesce("spans", none).alias("spans"))
    kinds = dict(docs.dtypes)
    fields = ", ".join([*(f"`{c}` {kinds[c]}" for c in keep), "n_bytes long, n_removed long, n_spans long, kept_sha256 string", *(["kept_text string"] * text_out)])
    return placed.mapInArrow(_removed(keep, text_out), fields)
