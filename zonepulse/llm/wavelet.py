"""Token ids as wavelet matrices: one compressed image per shard, which answers access, counting and occurrence queries.

An image is MAGIC, the length of a header, a zstandard-compressed header (JSON with the token count, the end id, each
plane's place, size and number of zeros, and the documents' ids and lengths), then one zstandard frame per bit-plane:
the packed bits (least significant first) and, before each 512 bits, the count of ones so far. Planes go from the highest bit down; after
each plane the tokens with a 0 stand before those with a 1, otherwise in their old order.
A query unpacks only what it needs and never the ids themselves. A document is never split between shards.
"""

from __future__ import annotations

import json
import struct
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zonepulse.llm.arrays import slices, small_batches, utf8
from zonepulse.llm.cuts import PieceIds
from zonepulse.llm.order import NULL_KEY, range_parts
from zonepulse.sources.shared import scratch_path

MAGIC = b"WVM1"
BLOCK = 512
#: A shard is closed once it holds so many tokens.
SHARD_TOKENS = 1 << 19
#: Bytes of text that are encoded at a time; a longer text is a pass of its own.
PASS_BYTES = 1 << 23


def build(ids: np.ndarray, doc_ids: list[int | None], lengths: list[int], level: int = 1) -> bytes:
    """The image of one shard; ``ids`` are the tokens of all its documents, end ids included."""
    n = len(ids)
    width = max(1, int(ids.max()).bit_length()) if n else 1
    now = ids.astype(np.uint16 if width <= 16 else np.uint32)
    pack = zstandard.ZstdCompressor(level=level).compress
    frames, planes, at = [], [], 0
    for bit in range(width - 1, -1, -1):
        one = (now & now.dtype.type(1 << bit)).astype(bool)
        bits = np.packbits(one, bitorder="little")
        padded = np.zeros(-(-n // BLOCK) * BLOCK // 8, np.uint8)
        padded[: len(bits)] = bits
        ones = np.bitwise_count(padded.view(np.uint64)).reshape(-1, BLOCK // 64).sum(axis=1, dtype=np.uint32)
        ranks = np.cumsum(ones, dtype=np.uint32) - ones
        frame = pack(ranks.astype("<u4").tobytes() + padded.tobytes())
        planes.append([at, len(frame), int(n - ones.sum())])
        frames.append(frame)
        at += len(frame)
        # By compress, as an index of random flags takes half as long again.
        now = np.concatenate([now.compress(~one), now.compress(one)])
    header = pack(json.dumps({"n": n, "planes": planes, "docs": doc_ids, "lengths": lengths}).encode())
    return b"".join([MAGIC, struct.pack("<I", len(header)), header, *frames])


class Shard:
    """Queries on an image."""

    def __init__(self, image: bytes) -> None:
        if image[:4] != MAGIC:
            raise ValueError("not a token shard")
        (size,) = struct.unpack_from("<I", image, 4)
        head = json.loads(zstandard.decompress(image[8 : 8 + size]))
        self.n, self.docs, self.lengths = head["n"], head["docs"], head["lengths"]
        self.places, self.image, self.base = head["planes"], image, 8 + size
        self.width = len(self.places)
        self._open: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def plane(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Ranks before each block, and the packed bits, of the k-th plane."""
        if k not in self._open:
            at, size, _ = self.places[k]
            raw = zstandard.decompress(self.image[self.base + at : self.base + at + size])
            blocks = -(-self.n // BLOCK)
            self._open[k] = np.frombuffer(raw, "<u4", blocks), np.frombuffer(raw, np.uint8, offset=4 * blocks)
        return self._open[k]

    def ones(self, k: int, i: int) -> int:
        """Ones among the first i bits of a plane."""
        ranks, bits = self.plane(k)
        if i >= self.n:
            return self.n - self.places[k][2]
        block = i // BLOCK
        part = int.from_bytes(bits[block * BLOCK // 8 : i // 8 + 1].tobytes(), "little")
        return int(ranks[block]) + (part & ((1 << (i - block * BLOCK)) - 1)).bit_count()

    def access(self, i: int) -> int:
        """The i-th token."""
        if not 0 <= i < self.n:
            raise IndexError(i)
        token = 0
        for k in range(self.width):
            bit = int(self.plane(k)[1][i // 8]) >> (i % 8) & 1
            before = self.ones(k, i)
            i = self.places[k][2] + before if bit else i - before
            token = token << 1 | bit
        return token

    def count(self, token: int, start: int = 0, end: int | None = None) -> int:
        """Occurrences of a token among the places from start to end."""
        lo, hi = self._run(token, start, self.n if end is None else end)
        return max(0, hi - lo)

    def _run(self, token: int, lo: int, hi: int) -> tuple[int, int]:
        if token >> self.width:
            return 0, 0
        for k in range(self.width):
            a, b = self.ones(k, lo), self.ones(k, hi)
            lo, hi = (self.places[k][2] + a, self.places[k][2] + b) if token >> (self.width - 1 - k) & 1 else (lo - a, hi - b)
        return lo, hi

    def occurrences(self, token: int) -> np.ndarray:
        """All places of a token, in order."""
        lo, hi = self._run(token, 0, self.n)
        at = np.arange(lo, hi)
        for k in range(self.width - 1, -1, -1):
            one = token >> (self.width - 1 - k) & 1
            at = self._select(k, bool(one), at - (self.places[k][2] if one else 0))
        return at

    def _select(self, k: int, one: bool, nth: np.ndarray) -> np.ndarray:
        """Places of the nth (from 0) ones or zeros of a plane."""
        ranks, bits = self.plane(k)
        before = ranks.astype(np.int64)
        if not one:
            before = np.arange(len(before)) * BLOCK - before
        out = np.empty(len(nth), np.int64)
        block = np.searchsorted(before, nth, side="right") - 1
        for b in np.unique(block):
            mine = block == b
            flags = np.unpackbits(bits[b * BLOCK // 8 : (b + 1) * BLOCK // 8], bitorder="little")
            out[mine] = b * BLOCK + np.flatnonzero(flags == one)[nth[mine] - before[b]]
        return out

    def decode(self) -> np.ndarray:
        """All tokens, by undoing the planes from the lowest up."""
        now = np.zeros(self.n, np.uint16 if self.width <= 16 else np.uint32)
        for k in range(self.width - 1, -1, -1):
            one = np.unpackbits(self.plane(k)[1], count=self.n, bitorder="little").view(bool)
            zeros = self.places[k][2]
            back = np.empty_like(now)
            back[one] = now[zeros:] | now.dtype.type(1 << (self.width - 1 - k))
            back[~one] = now[:zeros]
            now = back
        return now


@lru_cache(maxsize=1)
def _encoder(definition: str, plain_specials: bool) -> PieceIds:
    """The tokenizer and what it has made of pieces so far; kept by a Python worker from one task to the next."""
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    model = Tokenizer.from_str(definition)
    model.encode_special_tokens = plain_specials
    return PieceIds(lambda texts: [e.ids for e in model.encode_batch_fast(texts, add_special_tokens=False)], sizes=token_sizes(model))


def token_sizes(model) -> np.ndarray | None:
    """Bytes of each id of a byte-level tokenizer, whose vocabulary spells a byte as one character; of others nothing is known."""
    from tokenizers.pre_tokenizers import ByteLevel

    if not isinstance(model.pre_tokenizer, ByteLevel) or model.normalizer is not None:
        return None
    added = {i: len(t.content.encode()) for i, t in model.get_added_tokens_decoder().items()}
    size = {i: len(t) for t, i in model.get_vocab(with_added_tokens=False).items()} | added
    out = np.zeros(max(size) + 1, np.int64)
    out[list(size)] = list(size.values())
    return out


def _gathered(batches: Iterator[pa.RecordBatch], text: str) -> Iterator[pa.RecordBatch]:
    """Batches put together until they hold ``PASS_BYTES`` of text, so that a piece is looked up once in all of it."""
    held, size = [], 0
    for batch in batches:
        held.append(batch)
        size += batch.column(text).nbytes
        if size >= PASS_BYTES:
            yield pa.concat_batches(held)
            held, size = [], 0
    if held:
        yield pa.concat_batches(held)


def write_tokens(docs: DataFrame, tokenizer: str, end_id: int, path: str, plain_specials: bool = False) -> None:
    """Encode every text of (doc_id, text), append ``end_id`` to each, and write the shards in ascending doc_id order.

    The dataset at ``path`` has a row per shard: range number, number in the range, first token's place in the range, token
    count and image. Spark's committed writer puts it there, so a lost executor leaves no half shard. Null texts are
    empty (the end id alone); a null doc_id comes first; equal doc_ids are ordered by text; other columns are ignored.
    A special token's literal in a text becomes that token, as in a plain call of the tokenizer; ``plain_specials`` makes it
    ordinary tokens, so that no document puts a control token into the training stream.
    """
    spark = docs.sparkSession
    small_batches(spark)
    with open(tokenizer, encoding="utf-8") as f:
        definition = spark.sparkContext.broadcast(f.read())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = _encoder(definition.value, plain_specials)
        end = np.array([end_id], "<u4").tobytes()
        held: list[bytes] = []
        names: list[int | None] = []
        done = shard = 0
        part = None

        def image() -> pa.RecordBatch:
            nonlocal done, shard
            ids = np.frombuffer(b"".join(held), "<u4")
            row = pa.RecordBatch.from_pylist([{"part": part, "shard": shard, "first": done, "n_tokens": len(ids), "image": build(ids, names, [len(x) // 4 for x in held])}])
            done, shard = done + len(ids), shard + 1
            held.clear()
            names.clear()
            return row.cast(pa.schema([("part", pa.int32()), ("shard", pa.int32()), ("first", pa.int64()), ("n_tokens", pa.int64()), ("image", pa.binary())]))

        size = 0
        for batch in _gathered(batches, "text"):
            for piece in slices(batch, "text", 2 * PASS_BYTES):
                part = piece.column("part")[0].as_py()
                ids, counts = cache(*utf8(piece, "text"))
                ends = np.cumsum(counts)
                for doc_id, s, e in zip(piece.column("doc_id").to_pylist(), ends - counts, ends, strict=True):
                    held.append(ids[s:e].tobytes() + end)
                    names.append(doc_id)
                    size += len(held[-1]) // 4
                    if size >= SHARD_TOKENS:
                        yield image()
                        size = 0
        if held:
            yield image()

    bare = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    dealt, n = range_parts(bare, "doc_id")
    ordered = dealt.repartitionById(n, F.col("part")).sortWithinPartitions(F.coalesce("doc_id", F.lit(NULL_KEY)), "text")
    ordered.mapInArrow(run, "part int, shard int, first long, n_tokens long, image binary").write.parquet(path)


def _documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for first, raw in zip(batch.column("first").to_pylist(), batch.column("image"), strict=True):
            shard = Shard(raw.as_py())
            ids = shard.decode().astype("<u4")
            ends = np.cumsum(shard.lengths)
            starts = ends - shard.lengths
            crc = [zlib.crc32(ids[s:e]) for s, e in zip(starts, ends, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(shard.docs, pa.int64()), pa.array(starts + first, pa.int64()), pa.array(shard.lengths, pa.int64()), pa.array(crc, pa.int64())],
                names=["doc_id", "start", "n_tokens", "ids_crc32"],
            )


def read_tokens(shards: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document in a dataset of shards."""
    # One row per range: bounded by the number of partitions that wrote.
    totals = shards.groupBy("part").agg(F.sum("n_tokens").alias("n")).orderBy("part").collect()
    base, rows = 0, []
    for r in totals:
        rows.append((r["part"], base))
        base += r["n"]
    bases = shards.sparkSession.createDataFrame(rows, "part int, base long")
    placed = shards.join(bases, "part").select((F.col("first") + F.col("base")).alias("first"), "image")
    return placed.mapInArrow(_documents, "doc_id long, start long, n_tokens long, ids_crc32 long")


def encode_round_trip(docs: DataFrame, tokenizer: str, end_id: int, plain_specials: bool = False) -> DataFrame:
    """Write the shards to the shared folder and read every document back from them."""
    spark = docs.sparkSession
    path = scratch_path(spark, "tokens")
    write_tokens(docs, tokenizer, end_id, path, plain_specials)
    return read_tokens(spark.read.parquet(path))
