"""Benchmark decontamination by greedy string tiling.

Every run of five words of a benchmark item is a seed. A document's runs are looked up among the seeds; items whose shared
seeds could cover enough of them are tiled: the longest common runs of unmarked words are found with running Karp-Rabin
fingerprints, marked in both texts, and the search goes on with shorter ones, down to five words. The marked share of an
item's words is its coverage, whatever the order in which the passages stand.

The items go to the tasks in blocks of bounded size, one pass over the documents per block, so no document is shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zonepulse.llm.arrays import MULTIPLIER, PrimeRolling, ascii_tables, mix, powers, slices, small_batches, utf8, word_hashes

#: Least length of a tile in words, and the coverage from which a document counts as contaminated.
MIN_MATCH, COVERAGE = 5, 0.5
#: Bytes of item text in a block.
BLOCK_BYTES = 16 << 20

_, FOLD = ascii_tables()
#: Words are runs of ASCII letters, digits and any bytes beyond ASCII.
NO_WORD = np.array([not (chr(b).isalnum() or b >= 128) for b in range(256)])


def tokens(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of each row's lower-cased text, and their rows."""
    low = pa.RecordBatch.from_arrays([pc.utf8_lower(batch.column("text"))], names=["text"])
    data, offsets = utf8(low, "text")
    return word_hashes(data, offsets, NO_WORD, FOLD)


def runs(words: np.ndarray, length: int) -> np.ndarray:
    """Fingerprint of each run of ``length`` words."""
    if len(words) < length:
        return np.zeros(0, np.uint64)
    total = np.zeros(len(words) - length + 1, np.uint64)
    for j, factor in enumerate(powers(MULTIPLIER, length)):
        total += mix(words[j : j + len(total)] + np.uint64(1)) * factor
    return mix(total)


def tile(item: np.ndarray, doc: np.ndarray, least: int = MIN_MATCH) -> list[tuple[int, int, int]]:
    """Greedy string tiling: (place in item, place in doc, length) of tiles that do not overlap, longest first.

    Equal lengths are taken in order of the place in the item, then in the document.
    """
    tiles = []
    free_i, free_d = np.ones(len(item), bool), np.ones(len(doc), bool)
    # Whether a common run of some length exists is monotone, so the longest is found by halving; marked words end runs.
    while True:
        lo, hi, found = least, min(len(item), len(doc)), None
        while lo <= hi:
            mid = (lo + hi) // 2
            pair = _first_common(item, doc, free_i, free_d, mid)
            if pair:
                found, lo = (*pair, mid), mid + 1
            else:
                hi = mid - 1
        if found is None:
            return tiles
        i, d, n = found
        tiles.append(found)
        free_i[i : i + n] = False
        free_d[d : d + n] = False


def _first_common(item: np.ndarray, doc: np.ndarray, free_i: np.ndarray, free_d: np.ndarray, n: int) -> tuple[int, int] | None:
    """The first run of n unmarked words of the item that is also an unmarked run of the document."""
    a, b = rolling(item, n), rolling(doc, n)
    open_a, open_b = np.flatnonzero(whole(free_i, n)), np.flatnonzero(whole(free_d, n))
    if not len(open_a) or not len(open_b):
        return None
    keys = a[open_a]
    order = np.argsort(keys, kind="stable")
    sorted_keys = keys[order]
    at = np.searchsorted(sorted_keys, b[open_b])
    hit = (at < len(keys)) & (sorted_keys[np.minimum(at, len(keys) - 1)] == b[open_b])
    if not hit.any():
        return None
    places = open_a[order[at[hit]]]
    # Equal fingerprints are confirmed word by word.
    for i in np.unique(places):
        for d in open_b[hit][places == i]:
            if np.array_equal(item[i : i + n], doc[d : d + n]):
                return int(i), int(d)
    return None


def rolling(words: np.ndarray, n: int) -> np.ndarray:
    """Running Karp-Rabin fingerprints of all runs of n words, in one pass whatever n is."""
    if len(words) < n:
        return np.zeros(0, np.uint64)
    return PrimeRolling(mix(words + np.uint64(1))).windows(n)


def whole(free: np.ndarray, n: int) -> np.ndarray:
    """Whether n words from each place on are unmarked."""
    sums = np.concatenate([[0], np.cumsum(free)])
    return sums[n:] - sums[:-n] == n


@dataclass
class Seeds:
    """Seeds of a block of items: sorted fingerprints with, for each, the item and place it comes from."""

    ids: list
    words: list
    keys: np.ndarray
    items: np.ndarray
    places: np.ndarray

    @classmethod
    def of(cls, rows: list[tuple[int, str]]) -> Seeds:
        ids, words, seen = [], [], set()
        batch = pa.RecordBatch.from_arrays([pa.array([t for _, t in rows], pa.string())], names=["text"])
        hashed, where = tokens(batch)
        for k, (item_id, _) in enumerate(rows):
            w = hashed[where == k] if len(rows) < 64 else hashed[np.searchsorted(where, k) : np.searchsorted(where, k + 1)]
            if len(w) >= MIN_MATCH and w.tobytes() not in seen:
                seen.add(w.tobytes())
                ids.append(item_id)
                words.append(w)
        keys = [runs(w, MIN_MATCH) for w in words]
        items = np.repeat(np.arange(len(words)), [len(k) for k in keys])
        places = np.concatenate([np.arange(len(k)) for k in keys]) if keys else np.zeros(0, np.int64)
        flat = np.concatenate(keys) if keys else np.zeros(0, np.uint64)
        order = np.argsort(flat, kind="stable")
        return cls(ids, words, flat[order], items[order], places[order])

    def candidates(self, found: np.ndarray, coverage: float) -> list[int]:
        """Items that the seeds with the distinct fingerprints ``found`` could cover far enough."""
        lo, hi = np.searchsorted(self.keys, found, "left"), np.searchsorted(self.keys, found, "right")
        at = np.concatenate([np.arange(a, b) for a, b in zip(lo, hi, strict=True)])
        out = []
        order = np.lexsort((self.places[at], self.items[at]))
        items, places = self.items[at][order], self.places[at][order]
        for part in np.split(np.arange(len(items)), np.flatnonzero(np.diff(items)) + 1):
            k, p = int(items[part[0]]), places[part]
            covered = MIN_MATCH + np.minimum(np.diff(p), MIN_MATCH).sum()
            if covered >= coverage * len(self.words[k]):
                out.append(k)
        return out


FIELDS = "doc_id long, item_id long, coverage double, n_tiles long, longest long"


def contaminated(docs: DataFrame, benchmark: DataFrame, coverage: float = COVERAGE) -> DataFrame:
    """(doc_id, item_id, coverage, n_tiles, longest): each document and benchmark item that it covers to ``coverage`` or more.

    Items with the same text (within a block, the same words) count once, under the smallest item_id. Items of fewer than five words cannot be tiled and never
    match; null or empty texts have no words. A null doc_id stays null; repeated rows give repeated results; other columns are
    ignored. Tiling is greedy, so coverage is that of the tiles it chose.
    """
    small_batches(docs.sparkSession)
    bare = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    out = None
    for seeds in _blocks(benchmark):

        def run(batches: Iterator[pa.RecordBatch], seeds=seeds) -> Iterator[pa.RecordBatch]:
            s = seeds.value
            for batch in batches:
                for part in slices(batch, "text"):
                    ids = part.column("doc_id")
                    found = [(ids[row].as_py(), *rest) for row, *rest in _match(part, s, coverage)]
                    if found:
                        columns = list(zip(*found, strict=True))
                        kinds = [pa.int64(), pa.int64(), pa.float64(), pa.int64(), pa.int64()]
                        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=[x.split()[0] for x in FIELDS.split(", ")])

        mine = bare.mapInArrow(run, FIELDS)
        out = mine if out is None else out.unionAll(mine)
    return out


def clean(docs: DataFrame, benchmark: DataFrame, coverage: float = COVERAGE) -> DataFrame:
    """Rows of docs (all columns) that cover no benchmark item to ``coverage``; each row's own text decides, nothing is joined."""
    small_batches(docs.sparkSession)
    names, schema = docs.columns, docs.schema
    for seeds in _blocks(benchmark):

        def run(batches: Iterator[pa.RecordBatch], seeds=seeds) -> Iterator[pa.RecordBatch]:
            s = seeds.value
            for batch in batches:
                for part in slices(batch, "text"):
                    keep = np.ones(part.num_rows, bool)
                    keep[[row for row, *_ in _match(part, s, coverage)]] = False
                    yield part.filter(pa.array(keep)).select(names)

        docs = docs.mapInArrow(run, schema)
    return docs


def _blocks(benchmark: DataFrame) -> Iterator[Broadcast]:
    """The seeds of each block of the distinct items."""
    spark = benchmark.sparkSession
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")).where("text IS NOT NULL")
    items = items.groupBy("text").agg(F.min("item_id").alias("item_id"))
    size = items.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    blocks = max(1, -(-size // BLOCK_BYTES))
    for block in range(blocks):
        # About BLOCK_BYTES of item text.
        rows = items.where(F.pmod(F.xxhash64("text"), F.lit(blocks)) == block).orderBy("item_id", "text").collect()
        yield spark.sparkContext.broadcast(Seeds.of([(r["item_id"], r["text"]) for r in rows]))


def _match(part: pa.RecordBatch, seeds: Seeds, coverage: float) -> Iterator[tuple]:
    """(row, item_id, coverage, n_tiles, longest) of each row and item that it covers far enough."""
    words, rows = tokens(part)
    if not len(seeds.keys) or len(words) < MIN_MATCH:
        return
    keys = runs(words, MIN_MATCH)
    inside = rows[: len(keys)] == rows[MIN_MATCH - 1 :]
    at = np.searchsorted(seeds.keys, keys)
    hit = np.flatnonzero(inside & (seeds.keys[np.minimum(at, len(seeds.keys) - 1)] == keys))
    for row in np.unique(rows[hit]):
        mine = hit[np.searchsorted(rows[hit], row) : np.searchsorted(rows[hit], row, side="right")]
        chosen = seeds.candidates(np.unique(keys[mine]), coverage)
        if chosen:
            doc = words[np.searchsorted(rows, row) : np.searchsorted(rows, row, side="right")]
            for k in chosen:
                tiles = tile(seeds.words[k], doc)
                share = sum(n for _, _, n in tiles) / len(seeds.words[k])
                if share >= coverage:
                    yield int(row), seeds.ids[k], share, len(tiles), max(n for _, _, n in tiles)
