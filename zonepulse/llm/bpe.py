"""Byte-level BPE through a sentencepiece model that is written from a vocabulary file, not trained.

A token becomes a piece in which each byte is one letter; its score is its negative rank, so merges happen in rank order.
Normalisation is the identity and no white space is added, dropped or escaped. Each match of the pre-token pattern is
encoded by itself; ids are ranks, and decoding looks up a rank's bytes.
"""

from __future__ import annotations

import base64
import hashlib
import itertools
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zonepulse.llm.arrays import slices, small_batches
from zonepulse.llm.pieces import PieceCache

#: Byte b is the letter with code point LETTERS + b; none of them is white space or changed by normalisation.
LETTERS = 0x100


def _varint(n: int) -> bytes:
    out = bytearray()
    n &= 2**64 - 1
    while n > 0x7F:
        out.append(n & 0x7F | 0x80)
        n >>= 7
    return bytes([*out, n])


def _field(number: int, value: int | bytes | float) -> bytes:
    """A protocol-buffer field: an integer, a 32-bit float or bytes."""
    import struct

    if isinstance(value, float):
        return _varint(number << 3 | 5) + struct.pack("<f", value)
    if isinstance(value, int):
        return _varint(number << 3) + _varint(value)
    return _varint(number << 3 | 2) + _varint(len(value)) + value


def model_bytes(vocabulary: list[bytes]) -> bytes:
    """A serialised sentencepiece model whose piece i stands for the token of rank i.

    Field numbers are those of the public model format: pieces 1 (piece 1, score 2, type 3), trainer 2 (model type 3, here 2
    for BPE; vocabulary size 4; unknown, begin, end and pad ids 40 to 43), normaliser 3 (name 1, dummy prefix 3, extra white space 4, escape 5).
    """
    out = []
    for rank, token in enumerate(vocabulary):
        piece = "".join(chr(LETTERS + b) for b in token).encode()
        out.append(_field(1, _field(1, piece) + _field(2, -float(rank)) + _field(3, 1)))
    unknown = len(vocabulary)
    out.append(_field(1, _field(1, b"<unk>") + _field(2, 0.0) + _field(3, 2)))
    trainer = _field(3, 2) + _field(4, unknown + 1) + _field(40, unknown) + b"".join(_field(i, -1) for i in (41, 42, 43))
    normaliser = _field(1, b"identity") + _field(3, 0) + _field(4, 0) + _field(5, 0)
    return b"".join([*out, _field(2, trainer), _field(3, normaliser)])


def read_ranks(path: str) -> list[bytes]:
    """Tokens in rank order of a file with a base64 token and a rank per line."""
    with open(path, "rb") as f:
        ranks = {int(rank): base64.b64decode(token) for token, rank in map(bytes.split, f)}
    return [ranks[i] for i in range(len(ranks))]


class Codec:
    def __init__(self, vocabulary: list[bytes], pattern: str) -> None:
        import regex
        import sentencepiece

        self.bytes_of = vocabulary
        self.rank_of = {t: i for i, t in enumerate(vocabulary)}
        self.words = regex.compile(pattern)
        self.letters = [chr(LETTERS + b) for b in range(256)]
        self.model = sentencepiece.SentencePieceProcessor(model_proto=model_bytes(vocabulary))
        self.cache = PieceCache(self._encode)

    def _encode(self, texts: list[str]) -> Iterator[list[int]]:
        matches = [[m.encode("utf-8", "surrogatepass") for m in self.words.findall(t)] for t in texts]
        # A match that is a token is that token; merges need not be able to build it.
        rest = list({m for ms in matches for m in ms if m not in self.rank_of})
        known = dict(zip(rest, self.model.encode(["".join(map(self.letters.__getitem__, m)) for m in rest], num_threads=1), strict=True))
        for ms in matches:
            yield [i for m in ms for i in ([self.rank_of[m]] if m in self.rank_of else known[m])]

    def encode(self, texts: list[str]) -> list[list[int]]:
        return [list(itertools.chain.from_iterable(x)) for x in self.cache(texts)]

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids))


def encode_texts(docs: DataFrame, vocabulary: str, pattern: str, keep_ids: bool = False) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of every row of (doc_id, text), with ``ids`` if asked for.

    A null text is empty: no ids. Rows are independent: null or repeated ids and repeated texts are rows like others; other
    columns are ignored. The vocabulary file is a parameter, read on the driver; a task builds the model once.
    """
    small_batches(docs.sparkSession)
    tokens = docs.sparkSession.sparkContext.broadcast(read_ranks(vocabulary))
    fields = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * keep_ids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec(tokens.value, pattern)
        digits = [str(i) for i in range(len(tokens.value))]
        for batch in batches:
            for part in slices(batch, "text"):
                ids = codec.encode(part.column("text").to_pylist())
                cols = [
                    part.column("doc_id"), pa.array(map(len, ids), pa.int64()),
                    pa.array([hashlib.sha256(" ".join(map(digits.__getitem__, x)).encode()).hexdigest() for x in ids]),
                    pa.array([hashlib.sha256(codec.decode(x)).hexdigest() for x in ids]),
                ]
                cols += [pa.array(ids, pa.list_(pa.int32()))] if keep_ids else []
                yield pa.RecordBatch.from_arrays(cols, names=[x.split()[0] for x in fields.split(", ")])

    bare = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return bare.mapInArrow(run, fields)
