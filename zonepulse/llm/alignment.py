"""Which tokens of one tokenizer stand for which tokens of another, counted by inverted pair bitmaps.

Byte offsets where tokens of both tokenizers end cut a text into groups; all A-B token occurrences of a group are linked. A
chunk is a run of whole documents of one input partition. For every id pair a chunk holds one posting: a compressed bitmap
of the documents that hold it linked (two bytes a document, or one bit for each document of the chunk, whichever is
shorter), and multiplicity planes, bit-planes of the number of its links in each of those documents, less one.

Bitmaps of slices are OR-merged to the chunk's, whose documents are no other chunk's, so corpus-wide document counts are
sums of popcounts. The counts go back to the postings by an equi-join; each chunk's postings then return its documents'
scores. A chunk has one row for a pair however often it occurs, so no pair or token is a hot key; a task holds one chunk.

Tokens of distinct pieces of text are computed once: pieces end only where neither tokenizer has a token that goes on.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from zonepulse.llm.arrays import slices, small_batches, utf8
from zonepulse.llm.cuts import as_pieces, borders
from zonepulse.llm.scratch import stored

#: A chunk is closed once its texts have so many bytes, or it has so many documents.
CHUNK_BYTES, CHUNK_DOCS = 8 << 20, 1 << 15
#: Pieces that a task remembers, and the longest it remembers, in bytes.
REMEMBERED, LONGEST = 300_000, 64
#: Bits of a B id in a pair.
B_BITS = 32
SPACE_SIGN = "▁"


def _spread(start: np.ndarray, count: np.ndarray) -> np.ndarray:
    """start, start + 1, ... (count of them) for each of the starts, one after the other."""
    return np.arange(int(count.sum())) - np.repeat(np.cumsum(count) - count, count) + np.repeat(start, count)


def _summed(keys: tuple[np.ndarray, ...], n: np.ndarray) -> tuple[tuple[np.ndarray, ...], np.ndarray]:
    """Distinct keys in order (the last named is the first sorted by), and the sums of their numbers."""
    order = np.lexsort(keys)
    keys, n = tuple(k[order] for k in keys), n[order]
    if not len(n):
        return keys, n
    new = np.ones(len(n), bool)
    new[1:] = np.any([k[1:] != k[:-1] for k in keys], axis=0)
    return tuple(k[new] for k in keys), np.add.reduceat(n, np.flatnonzero(new))


def _byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in byte-level vocabularies: printable bytes for themselves, others from 256 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(rest)}


class Tokenizers:
    """Both tokenizers, the bytes of their tokens, and whether texts may be cut before encoding."""

    def __init__(self, definition: str, model: bytes) -> None:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import regex
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_str(definition)
        self.a.encode_special_tokens = True
        letters = _byte_letters()
        size = max(self.a.get_vocab(with_added_tokens=True).values()) + 1
        self.bytes_a = [b""] * size
        for token, i in self.a.get_vocab(with_added_tokens=True).items():
            self.bytes_a[i] = bytes(letters[c] for c in token) if all(c in letters for c in token) else token.encode()
        self.b = sentencepiece.SentencePieceProcessor(model_proto=model)
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.bytes_b = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace(SPACE_SIGN, " ").encode() for i, p in enumerate(pieces)]
        self.size_a, self.size_b = (np.array([len(x) for x in t], np.int64) for t in (self.bytes_a, self.bytes_b))
        spec = json.loads(definition)
        plain = spec.get("normalizer") is None and (spec.get("pre_tokenizer") or {}).get("type") == "ByteLevel"
        normal = [p for i, p in enumerate(pieces) if not self.b.is_byte(i) and not self.b.is_control(i)]
        crossed = any(regex.search(rf"[^{SPACE_SIGN}]{SPACE_SIGN}|\n", p) for p in normal)
        # The line end must be encoded by itself, after the space that is put before every text.
        line = self.b.encode("\nx", out_type=str)
        self.cuttable = plain and not crossed and line[:2] == [SPACE_SIGN, "<0x0A>"]
        self.marks = bytes(ord(c) for c in ".," if not any(regex.search(rf"[A-Za-z0-9]\{c}", p) for p in normal))

    def encode_a(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.a.encode_batch_fast(texts, add_special_tokens=False)]

    def encode_b(self, texts: list[str]) -> list[list[int]]:
        """Ids of texts that stand inside a longer one, whose leading space is the model's own."""
        own = [t[0] == " " and len(t) > 1 for t in texts]
        ids = self.b.encode([t[1:] if o else "\n" + t for t, o in zip(texts, own, strict=True)], num_threads=1)
        return [x if o else x[2:] for x, o in zip(ids, own, strict=True)]


class Aligned:
    """Groups and links of some pieces; row i is about piece i. Pieces that a tokenizer alters have ``ok`` false and no tokens."""

    def __init__(self, t: Tokenizers, raw: list[bytes], signs: pa.Array) -> None:
        n = len(raw)
        texts = [x.decode() for x in raw]
        ids_a, ids_b = t.encode_a(texts), t.encode_b(texts)
        same = lambda ids, table, x: b"".join(map(table.__getitem__, ids)) == x
        self.ok = np.array([same(a, t.bytes_a, x) and same(b, t.bytes_b, x) for a, b, x in zip(ids_a, ids_b, raw, strict=True)], bool).reshape(n)
        ids_a, ids_b = ([x if o else [] for x, o in zip(ids, self.ok, strict=True)] for ids in (ids_a, ids_b))
        self.n_a, self.n_b = (np.array([len(x) for x in ids], np.int64) for ids in (ids_a, ids_b))
        a, b = (np.fromiter((i for x in ids for i in x), np.int64, int(k.sum())) for ids, k in ((ids_a, self.n_a), (ids_b, self.n_b)))
        end_a, end_b = np.cumsum(t.size_a[a]), np.cumsum(t.size_b[b])
        common = np.intersect1d(end_a, end_b, assume_unique=True)
        of_a, of_b = np.searchsorted(common, end_a), np.searchsorted(common, end_b)
        size = np.array([len(x) if o else 0 for x, o in zip(raw, self.ok, strict=True)], np.int64)
        piece = np.searchsorted(np.cumsum(size), common)
        groups = len(common)
        self.n_groups = np.bincount(piece, minlength=n).astype(np.int64)
        in_a, in_b = np.bincount(of_a, minlength=groups), np.bincount(of_b, minlength=groups)
        self.n_links = np.zeros(n, np.int64)
        np.add.at(self.n_links, piece, in_a * in_b)
        self._pairs(n, groups, piece, (of_a, a), (of_b, b))
        self._signs(signs, a, b, of_a, of_b, self.n_a + self.n_b)

    def _pairs(self, n: int, groups: int, piece: np.ndarray, left: tuple, right: tuple) -> None:
        """Distinct id pairs of every piece and how often each is linked: distinct ids of a group meet, weighted by their numbers."""
        (ga, ia), ka = _summed((left[1], left[0])[::-1], np.ones(len(left[1]), np.int64))
        (gb, ib), kb = _summed((right[1], right[0])[::-1], np.ones(len(right[1]), np.int64))
        # Both are now by id; put them by group.
        oa, ob = np.argsort(ga, kind="stable"), np.argsort(gb, kind="stable")
        ga, ia, ka, gb, ib, kb = ga[oa], ia[oa], ka[oa], gb[ob], ib[ob], kb[ob]
        start_b = np.searchsorted(gb, np.arange(groups))
        count_b = np.bincount(gb, minlength=groups)
        partners = count_b[ga]
        x = np.repeat(np.arange(len(ga)), partners)
        y = _spread(start_b[ga], partners)
        pair = ia[x] << B_BITS | ib[y]
        (pair, owner), self.link_n = _summed((pair, piece[ga[x]]), ka[x] * kb[y])
        self.pair = pair
        self.first = np.searchsorted(owner, np.arange(n + 1))

    def _signs(self, signs: pa.Array, a: np.ndarray, b: np.ndarray, of_a: np.ndarray, of_b: np.ndarray, tokens: np.ndarray) -> None:
        """Every piece's groups as text, each group closed by a semicolon."""
        key = np.concatenate([of_a * 2, of_b * 2 + 1])
        order = np.argsort(key, kind="stable")
        key, ids = key[order], np.concatenate([a, b])[order]
        last = np.append(key[1:] != key[:-1], True)[: len(key)]
        sign = np.where(last, 1 + key % 2, 0)
        flat = signs.take(pa.array(sign * (len(signs) // 3) + ids))
        _, offsets, data = flat.buffers()
        ends = np.frombuffer(offsets, np.int64)[: len(flat) + 1] if len(flat) else np.zeros(1, np.int64)
        at = ends[np.concatenate([[0], np.cumsum(tokens)])]
        self.text = pa.LargeStringArray.from_buffers(len(tokens), pa.py_buffer(at.tobytes()), data or pa.py_buffer(b""))


def _digits(size: int) -> pa.Array:
    """Ids in decimal, followed by a comma, a bar or a semicolon."""
    return pa.array([f"{i}{c}" for c in ",|;" for i in range(size)], pa.large_string())


class Known:
    """What a task has aligned so far, by piece."""

    FIELDS = ("ok", "n_a", "n_b", "n_groups", "n_links")

    def __init__(self, t: Tokenizers) -> None:
        self.t, self.signs = t, _digits(max(len(t.bytes_a), len(t.bytes_b)))
        self.clear()

    def clear(self) -> None:
        self.place: dict[bytes, int] = {}
        self.parts: list[Aligned] = []
        self.size = 0
        self._join()

    def _join(self) -> None:
        get = lambda f: [getattr(p, f) for p in self.parts]
        cat = lambda xs, kind: np.concatenate([np.zeros(0, kind), *xs]).astype(kind)
        for f in self.FIELDS:
            setattr(self, f, cat(get(f), bool if f == "ok" else np.int64))
        self.pair, self.link_n = cat(get("pair"), np.int64), cat(get("link_n"), np.int64)
        base = np.cumsum([0, *(len(p.pair) for p in self.parts)])
        self.first = np.concatenate([[0], *(p.first[1:] + b for p, b in zip(self.parts, base, strict=False))]).astype(np.int64)
        self.text = pa.concat_arrays(get("text")) if self.parts else pa.array([], pa.large_string())
        if len(self.parts) > 1:
            whole = Aligned.__new__(Aligned)
            for f in (*self.FIELDS, "pair", "link_n", "first", "text"):
                setattr(whole, f, getattr(self, f))
            self.parts = [whole]

    def __call__(self, pieces: pa.Array) -> np.ndarray:
        """The row of every piece."""
        coded = pieces.dictionary_encode()
        raw = coded.dictionary.to_pylist()
        if self.size + len(raw) > REMEMBERED:
            self.clear()
        place = [self.place.get(x, -1) for x in raw]
        new = [i for i, p in enumerate(place) if p < 0]
        if new:
            self.parts.append(Aligned(self.t, [raw[i] for i in new], self.signs))
            for k, i in enumerate(new):
                place[i] = self.size + k
                if len(raw[i]) <= LONGEST:
                    self.place[raw[i]] = place[i]
            self.size += len(new)
            self._join()
        return np.array(place, np.int64)[coded.indices.to_numpy()]


def _spaced(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The rows with text, each after a space; rows without text stay empty."""
    size = np.diff(offsets)
    some = size > 0
    with_space = np.insert(data, offsets[:-1][some], 0x20)
    return with_space, np.concatenate([[0], np.cumsum(size + some)])


class Chunk:
    """Documents of consecutive slices and their links."""

    def __init__(self) -> None:
        self.docs: list[pa.RecordBatch] = []
        self.links: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.n = self.size = 0

    def add(self, known: Known, part: pa.RecordBatch) -> None:
        data, offsets = _spaced(*utf8(part, "text"))
        n, t = part.num_rows, known.t
        starts = offsets[:-1][np.diff(offsets) > 0]
        cut = borders(data, starts, t.marks) if t.cuttable else starts
        of = np.searchsorted(offsets, cut, side="right") - 1
        rows = known(as_pieces(data, cut))
        bad = np.unique(of[~known.ok[rows]])
        if len(bad):
            # A text that a tokenizer alters somewhere counts only as a whole.
            keep = ~np.isin(of, bad)
            whole = pa.array([data[offsets[i] : offsets[i + 1]].tobytes() for i in bad], pa.large_binary())
            cut_rows = known(pa.concat_arrays([as_pieces(data, cut).filter(pa.array(keep)), whole]))
            of, rows = np.concatenate([of[keep], bad]), cut_rows
            order = np.argsort(of, kind="stable")
            of, rows = of[order], rows[order]
        total = {}
        for f in ("n_a", "n_b", "n_groups", "n_links"):
            total[f] = np.zeros(n, np.int64)
            np.add.at(total[f], of, getattr(known, f)[rows])
        text = known.text.take(pa.array(rows))
        ends = np.frombuffer(text.buffers()[1], np.int64)[: len(text) + 1] if len(text) else np.zeros(1, np.int64)
        raw = memoryview(text.buffers()[2]) if len(text) and text.buffers()[2] is not None else memoryview(b"")
        at = ends[np.searchsorted(of, np.arange(n + 1))]
        digest = [hashlib.sha256(raw[s : e - 1]).hexdigest() if e > s else "" for s, e in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]
        (row, doc), times = _summed((rows, of), np.ones(len(rows), np.int64))
        count = known.first[row + 1] - known.first[row]
        place = _spread(known.first[row], count)
        (doc, pair), links = _summed((np.repeat(doc, count) + self.n, known.pair[place]), known.link_n[place] * np.repeat(times, count))
        self.links.append((pair, doc, links))
        numbers = [pa.array(np.arange(self.n, self.n + n), pa.int32()), part.column("doc_id"), *(pa.array(total[f]) for f in ("n_a", "n_b", "n_groups", "n_links")), pa.array(digest)]
        self.docs.append(pa.RecordBatch.from_arrays(numbers, names=["row", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256"]))
        self.n += n
        self.size += int(offsets[-1])

    def postings(self) -> Iterator[dict[str, pa.Array]]:
        """One row for each pair, those with short and those with full bitmaps apart."""
        pair, doc, links = (np.concatenate([np.zeros(0, np.int64), *x]) for x in zip(*self.links, strict=True))
        order = np.lexsort((doc, pair))
        pair, doc, links = pair[order], doc[order], links[order]
        names, first, count = np.unique(pair, return_index=True, return_counts=True)
        full = (self.n + 7) // 8
        for dense in (False, True):
            chosen = np.flatnonzero((count * 2 > full) == dense)
            if not len(chosen):
                continue
            at, k = _spread(first[chosen], count[chosen]), count[chosen]
            if dense:
                flags = np.zeros(len(chosen) * full * 8, bool)
                flags[np.repeat(np.arange(len(chosen)), k) * full * 8 + doc[at]] = True
                docs, size = np.packbits(flags, bitorder="little"), np.full(len(chosen), full)
            else:
                docs, size = doc[at].astype("<u2").view(np.uint8), k * 2
            planes, plane_size = pack_planes(links[at] - 1, k)
            total = np.add.reduceat(links[at], np.cumsum(k) - k)
            yield {"pair": pa.array(names[chosen]), "n_docs": pa.array(k), "n_pair_links": pa.array(total), "docs": _binary(docs, size), "planes": _binary(planes, plane_size)}


def _binary(data: np.ndarray, size: np.ndarray) -> pa.Array:
    ends = np.concatenate([[0], np.cumsum(size)]).astype(np.int32)
    return pa.BinaryArray.from_buffers(pa.binary(), len(size), [None, pa.py_buffer(ends.tobytes()), pa.py_buffer(data.tobytes())])


def pack_planes(values: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bit-planes, lowest first, of consecutive runs of values, and their bytes; a run of zeros has no plane."""
    first = np.cumsum(count) - count
    widest = np.maximum.reduceat(values, first) if len(count) else np.zeros(0, np.int64)
    planes = np.ceil(np.log2(widest + 1)).astype(np.int64)
    one = (count + 7) // 8
    size = planes * one
    base = np.cumsum(size) - size
    flags = np.zeros(int(size.sum()) * 8, bool)
    run = np.repeat(np.arange(len(count)), count)
    rank = np.arange(len(values)) - first[run]
    for k in range(int(planes.max(initial=0))):
        has = np.flatnonzero((planes[run] > k) & (values >> k & 1 == 1))
        flags[(base[run[has]] + k * one[run[has]]) * 8 + rank[has]] = True
    return np.packbits(flags, bitorder="little"), size


def unpack_postings(docs: pa.Array, planes: pa.Array, count: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(posting, document, links) of every document of every posting."""
    size, start, data = _parts(docs)
    dense = size < count * 2
    run = np.repeat(np.arange(len(count)), count)
    doc = np.zeros(len(run), np.int64)
    at = _spread(start[~dense], size[~dense])
    doc[~dense[run]] = data[at].view("<u2") if len(at) else 0
    if dense.any():
        at = _spread(start[dense], size[dense])
        places = np.flatnonzero(np.unpackbits(data[at], bitorder="little"))
        # Full bitmaps of one chunk are equally long.
        doc[dense[run]] = places % (int(size[dense][0]) * 8)
    size, start, data = _parts(planes)
    first = np.cumsum(count) - count
    rank, one = np.arange(len(run)) - first[run], (count + 7) // 8
    number = size // np.maximum(one, 1)
    links = np.ones(len(run), np.int64)
    for k in range(int(number.max(initial=0))):
        has = np.flatnonzero(number[run] > k)
        r = run[has]
        byte = data[start[r] + k * one[r] + rank[has] // 8]
        links[has] += ((byte >> (rank[has] % 8).astype(np.uint8)) & 1).astype(np.int64) << k
    return run, doc, links


def _parts(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sizes and starts of binary values, and the bytes they lie in."""
    column = column.cast(pa.large_binary())
    _, offsets, data = column.buffers()
    ends = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1] if len(column) else np.zeros(1, np.int64)
    return np.diff(ends), ends[:-1], np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)


DOC_FIELDS = "row int, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string"
POSTING_FIELDS = "pair long, n_docs long, n_pair_links long, docs binary, planes binary"


def pair_index(docs: DataFrame, tokenizer: str, model: str) -> DataFrame:
    """The index of (doc_id, text): rows of documents (``row`` set) and of postings (``pair`` set), both with their chunk.

    ``pair`` is the A id times 2**32 plus the B id. Written to the shared folder, as chunks are numbered by task.
    """
    spark = docs.sparkSession
    small_batches(spark)
    with open(tokenizer, encoding="utf-8") as f, open(model, "rb") as g:
        held = spark.sparkContext.broadcast((f.read(), g.read()))
    schema = StructType.fromDDL(f"chunk long, {DOC_FIELDS}, {POSTING_FIELDS}")
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        task, number = TaskContext.get().partitionId(), 0
        known, chunk = Known(Tokenizers(*held.value)), Chunk()

        def rows(columns: dict[str, pa.Array]) -> pa.RecordBatch:
            n = len(next(iter(columns.values())))
            columns["chunk"] = pa.array(np.full(n, task << 32 | number))
            return pa.RecordBatch.from_arrays([columns[f.name].cast(f.type) if f.name in columns else pa.nulls(n, f.type) for f in arrow], schema=arrow)

        def closed() -> Iterator[pa.RecordBatch]:
            for d in chunk.docs:
                yield rows(dict(zip(d.schema.names, d.columns, strict=True)))
            for p in chunk.postings():
                table = rows(p)
                for at in range(0, table.num_rows, 20_000):
                    yield table.slice(at, 20_000)

        for batch in batches:
            for part in slices(batch, "text", 1 << 20):
                chunk.add(known, part)
                if chunk.size >= CHUNK_BYTES or chunk.n >= CHUNK_DOCS:
                    yield from closed()
                    chunk, number = Chunk(), number + 1
        if chunk.n:
            yield from closed()

    bare = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return stored(bare.mapInArrow(run, schema), "pair-index")


def pair_counts(index: DataFrame) -> DataFrame:
    """(pair, a, b, count, n_pair_links, best): documents and links of each pair; best: no pair of that A id has more documents."""
    pairs = index.where("pair IS NOT NULL").groupBy("pair").agg(F.sum("n_docs").alias("count"), F.sum("n_pair_links").alias("n_pair_links"))
    pairs = pairs.withColumn("a", F.shiftright("pair", B_BITS)).withColumn("b", F.col("pair").bitwiseAND(F.lit(2**B_BITS - 1)))
    most = pairs.groupBy("a").agg(F.max("count").alias("most"))
    return pairs.join(most, "a").select("pair", "a", "b", "count", "n_pair_links", (F.col("count") == F.col("most")).alias("best"))


def _scored(key: tuple, docs: pa.Table, postings: pa.Table) -> pa.Table:
    """Scores of the documents of one chunk."""
    n = docs.num_rows
    best, total = np.zeros(n, np.int64), np.zeros(n, np.int64)
    for part in postings.combine_chunks().to_batches():
        count = part.column("n_docs").to_numpy()
        run, doc, links = unpack_postings(part.column("docs"), part.column("planes"), count)
        np.add.at(total, doc, links * part.column("count").to_numpy()[run])
        np.add.at(best, doc, links * part.column("best").to_numpy(zero_copy_only=False)[run])
    row = docs.column("row").to_numpy()
    out = docs.drop_columns(["chunk", "row"])
    out = out.append_column("n_best", pa.array(best[row], pa.int64())).append_column("count_sum", pa.array(total[row], pa.int64()))
    return out.select(["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"])


def alignment_scores(docs: DataFrame, tokenizer: str, model: str) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) of every row of (doc_id, text).

    A (``tokenizer``, byte-level, a tokenizers file) encodes a space and the text; B (``model``, a sentencepiece file) encodes the
    text and adds the space. Special tokens in texts are plain text. A text that is null or empty, or whose tokens' bytes
    differ from a space and the text, has no tokens: zeros and an empty digest. ``n_best`` counts links whose pair no other
    pair of the same A id exceeds in documents; ``count_sum`` adds the document counts of all links. Rows are documents: repeated
    rows, shared ids and null ids count apart. Other columns are ignored; an empty table gives no rows.
    """
    index = pair_index(docs, tokenizer, model)
    counts = pair_counts(index).select("pair", "count", "best")
    postings = index.where("pair IS NOT NULL").select(F.col("chunk").alias("at_chunk"), "pair", "n_docs", "docs", "planes").join(counts, "pair")
    documents = index.where("row IS NOT NULL").select("chunk", *(x.split()[0] for x in DOC_FIELDS.split(", ")))
    sides = documents.groupBy("chunk").cogroup(postings.drop("pair").groupBy("at_chunk"))
    return sides.applyInArrow(_scored, "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string")
