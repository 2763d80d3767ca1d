"""Toxicity by compression distance between two dictionaries that zstandard trains, one on toxic and one on ordinary text.

The ordinary dictionary is trained on distinct windows of ordinary texts. The toxic one is trained on contrasted samples: of each
toxic text (one per group of near copies) only the word beginnings that far more toxic than ordinary texts contain, extended while
half of the toxic words go along, each in a cell of ``CELL`` bytes, as long as the segments the training picks. (Trained on whole
texts a dictionary mostly holds what both kinds of text share, and the differences are noise.) The toxic compressor
holds its dictionary before the ordinary one; the ordinary compressor has filler of the same length there, so both compress a
window to the same length unless it repeats toxic segments: the difference is what the toxic dictionary saves.

A window is six words. A fixed tail that both dictionaries hold makes every window compressible, else zstandard would
store short ones and show no difference. The mean saving, the share and number of windows over a threshold and the largest saving are
calibrated to a probability by a logistic fit.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zonepulse.llm.arrays import small_batches

WINDOW, GRAM = 6, 5
#: Bytes of a cell of a toxic sample, which is also the length of the segments that the training picks by grams of GRAIN bytes.
CELL, GRAIN = 16, 6
#: Samples, and bytes of samples for each byte of a dictionary, that the training is given at least.
SAMPLES, SAMPLE_BYTES = 64, 10
#: What ends the entropy tables at the head of a trained dictionary: its three fixed repeat offsets.
OFFSETS = bytes([1, 0, 0, 0, 4, 0, 0, 0, 8, 0, 0, 0])
#: Likelihood ratio of a word beginning, and its least relative frequency in toxic text.
CONTRAST, TIMES = 20.0, 6.0
TAIL = bytes(range(0x80, 0xA0))


def words_of(text: str | None) -> list[bytes]:
    return [b" " + w for w in (text or "").lower().encode("utf-8", "replace").split()]


def _openings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per text a key that near copies share, and its distinct word beginnings."""
    for batch in batches:
        for toxic, text in zip(batch.column("toxic").to_pylist(), batch.column("text").to_pylist(), strict=True):
            words = words_of(text)
            key = min((copy_key(words[i : i + 5]) for i in range(max(1, len(words) - 4))), default=0)
            grams = sorted({w[:GRAM] for w in words})
            yield pa.RecordBatch.from_pylist([{"toxic": toxic, "copy_key": key, "grams": grams}], schema=pa.schema([("toxic", pa.int32()), ("copy_key", pa.int64()), ("grams", pa.list_(pa.binary()))]))


def _windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Windows of each text."""
    for batch in batches:
        for text in batch.column("text").to_pylist():
            words = words_of(text)
            yield pa.RecordBatch.from_arrays([pa.array([b"".join(words[i : i + WINDOW]) for i in range(0, len(words), WINDOW)], pa.binary())], names=["window"])


def copy_key(words: list[bytes]) -> int:
    import zlib

    joined = b"".join(words)
    return zlib.crc32(joined) << 31 ^ zlib.adler32(joined)


def _toxic_words(grams: set[bytes]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for text in batch.column("text").to_pylist():
                found = sorted({w for w in words_of(text) if w[:GRAM] in grams})
                yield pa.RecordBatch.from_arrays([pa.array(found, pa.binary())], names=["word"])

    return run


def _stem(words: Counter) -> bytes:
    """The longest beginning that half of the texts' words share."""
    total = sum(words.values())
    best = b""
    for k in range(GRAM, max(map(len, words)) + 1):
        heads = Counter()
        for w, n in words.items():
            if len(w) >= k:
                heads[w[:k]] += n
        head, n = max(heads.items(), key=lambda x: (x[1], x[0]))
        if 2 * n < total:
            break
        best = head
    return best or max(words.items(), key=lambda x: (x[1], x[0]))[0]


def trained(samples: list[bytes], size: int, length: int) -> bytes:
    """Content of a dictionary that zstandard trains on the samples, without its entropy tables; empty without samples.

    The training counts how many samples hold a gram, picks a segment from each of ``size / length / 4`` stretches of them in turn and ends
    when several have nothing new. So all are given equally often, once a stretch at least and until they are enough.
    """
    samples = [x for x in samples if len(x) >= length]
    if not samples:
        return b""
    times = max(size // length // 4 + 1, -(-SAMPLES // len(samples)), -(-SAMPLE_BYTES * size // sum(map(len, samples))))
    held = zstandard.train_dictionary(size, samples * times, k=length, d=GRAIN).as_bytes()
    return held[held.index(OFFSETS) + len(OFFSETS) :]


def aligned(segments: list[bytes]) -> bytes:
    """Each segment at all three remainders of the position by 3: zstandard indexes every third place of a dictionary."""
    out = b""
    for shift in range(3):
        for s in segments:
            out += b"\xff" * ((shift - len(out)) % 3) + s
    return out


@dataclass
class Model:
    """The toxic and the ordinary dictionary, and the weights of the calibration."""

    toxic: bytes
    ordinary: bytes
    weights: list[float]

    def compressors(self):
        def one(front: bytes):
            held = zstandard.ZstdCompressionDict(front + self.ordinary + TAIL, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            how = zstandard.ZstdCompressionParameters(
                window_log=14, hash_log=14, chain_log=14, search_log=2, min_match=5, strategy=zstandard.STRATEGY_GREEDY,
                write_content_size=0, write_checksum=0, write_dict_id=0,
            )
            held.precompute_compress(compression_params=how)
            return zstandard.ZstdCompressor(dict_data=held, compression_params=how).compress

        return one(b"\xff" * len(self.toxic)), one(self.toxic)

    def score(self, features: np.ndarray) -> np.ndarray:
        z = features @ np.array(self.weights[1:]) + self.weights[0]
        return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def measured(text: str | None, ordinary, toxic) -> tuple[float, float, float, float]:
    """Mean saving, share of windows that save 2 bytes or more, logarithm of their number, largest saving."""
    words = words_of(text)
    if not words:
        return 0.0, 0.0, 0.0, 0.0
    saved = []
    for i in range(0, len(words), WINDOW):
        window = b"".join(words[i : i + WINDOW]) + TAIL
        saved.append(len(ordinary(window)) - len(toxic(window)))
    s = np.array(saved)
    hits = int((s >= 2).sum())
    return float(s.mean()), hits / len(s), float(np.log1p(hits)), float(max(0, s.max()))


def _measure(model: Model, keep: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ordinary, toxic = model.compressors()
        for batch in batches:
            f = np.array([measured(t, ordinary, toxic) for t in batch.column("text").to_pylist()]).reshape(-1, 4)
            score = pa.array(model.score(f)) if model.weights else pa.nulls(len(f), pa.float64())
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), *(pa.array(f[:, i]) for i in range(4)), score], names=[*keep, "mean_saving", "share", "hits", "most", "score"])

    return run


MEASURES = "mean_saving double, share double, hits double, most double, score double"


def logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 0.05) -> list[float]:
    """Weights of a penalised logistic fit by Newton steps, intercept first."""
    mean, scale = x.mean(axis=0), x.std(axis=0)
    scale[scale == 0] = 1.0
    z = np.column_stack([np.ones(len(x)), (x - mean) / scale])
    w, penalty = np.zeros(z.shape[1]), np.r_[1e-6, np.full(x.shape[1], ridge)]
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -40, 40)))
        grad = z.T @ (weight * (p - y)) + penalty * w
        step = np.linalg.solve((z * (weight * p * (1 - p))[:, None]).T @ z + np.diag(penalty + 1e-9), grad)
        w -= np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-8:
            break
    return [float(w[0] - (w[1:] * mean / scale).sum()), *map(float, w[1:] / scale)]


def fit(docs: DataFrame, labels: DataFrame, toxic_rows: int = 2000, ordinary_rows: int = 6000, windows: int = 40_000, beginnings: int = 256, sizes: tuple[int, int] = (4096, 1024)) -> Model:
    """Fit on a bounded sample: one row of at most ``toxic_rows`` and ``ordinary_rows`` labelled doc_ids, the first by a hash of doc_id.

    ``labels`` has doc_id and toxic (0 or 1; null is no label; several labels of one id count as toxic if one is). Of rows that share
    a doc_id one is taken, by a hash of its text. The ordinary dictionary is trained on at most ``windows`` distinct windows of the sample,
    the first by a hash; the toxic one on at most ``beginnings`` word beginnings, those that set toxic texts apart most. ``sizes`` are the
    largest sizes in bytes of the toxic and the ordinary dictionary. Word beginnings are counted by Spark over the sample, one text per
    group of near copies. Without labels every score is 0.
    """
    spark = docs.sparkSession
    small_batches(spark)
    known = labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max("toxic").cast("int").alias("toxic"))
    labelled = {r["toxic"]: r["count"] for r in known.where("toxic IN (0, 1)").groupBy("toxic").count().collect()}
    if not labelled:
        return Model(b"", b"", [-40.0, 0.0, 0.0, 0.0, 0.0])
    hashed = known.orderBy(F.xxhash64("doc_id"), "doc_id")
    # At most toxic_rows + ordinary_rows ids.
    chosen = [(r["doc_id"], r["toxic"]) for kind, n in ((1, toxic_rows), (0, ordinary_rows)) for r in hashed.where(F.col("toxic") == kind).limit(n).collect()]
    picked = spark.createDataFrame(chosen, "doc_id long, toxic int")
    bare = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    sample = bare.join(F.broadcast(picked), "doc_id").groupBy("doc_id", "toxic").agg(F.min(F.struct(F.xxhash64("text"), "text")).alias("first")).select("toxic", "first.text")
    sample = sample.persist()
    try:
        texts = {r["toxic"]: r["count"] for r in sample.groupBy("toxic").count().collect()}
        opened = sample.mapInArrow(_openings, "toxic int, copy_key long, grams array<binary>").dropDuplicates(["toxic", "copy_key"]).persist()
        kinds = {r["toxic"]: r["count"] for r in opened.groupBy("toxic").count().collect()}
        t, o = kinds.get(1, 0), kinds.get(0, 0)
        samples: list[bytes] = []
        grams: list[bytes] = []
        if t and o:
            one = lambda kind: F.sum(F.when(F.col("toxic") == kind, 1).otherwise(0)).cast("double")
            counts = opened.select("toxic", F.explode("grams").alias("gram")).groupBy("gram").agg(one(1).alias("a"), one(0).alias("b"))
            part = lambda n, of: F.when(n > 0, n * F.log(n / of)).otherwise(0.0)
            a, b = F.col("a"), F.col("b")
            both = a + b
            ratio = 2 * (part(a, both * t / (t + o)) + part(b, both * o / (t + o)))
            best = counts.withColumn("ratio", ratio).where((ratio >= CONTRAST) & (a / t > TIMES * (b + 1) / o)).orderBy(F.desc("ratio"), "gram").limit(beginnings)
            grams = sorted(bytes(r["gram"]) for r in best.select("gram").collect())
            found = sample.where("toxic = 1").mapInArrow(_toxic_words(set(grams)), "word binary").groupBy("word").count() if grams else None
            by: dict[bytes, Counter] = {}
            # Words of the bounded sample that begin with one of the chosen beginnings.
            for r in found.collect() if found is not None else []:
                by.setdefault(bytes(r["word"])[:GRAM], Counter())[bytes(r["word"])] += r["count"]
            cells = {g: _stem(c).ljust(max(CELL, len(_stem(c)) + 4), b"\xff") for g, c in by.items()}
            held = opened.where("toxic = 1").select(F.array_intersect("grams", F.array(*map(F.lit, map(bytearray, grams)))).alias("held")).collect() if grams else []
            samples = [b"".join(cells[bytes(g)] for g in sorted(map(bytes, r["held"]))) for r in held]
        opened.unpersist()
        distinct = sample.where("toxic = 0").mapInArrow(_windows, "window binary").distinct().orderBy(F.xxhash64("window"), "window").limit(windows)
        ordinary = trained([bytes(r["window"]) for r in distinct.collect()], sizes[1], 2 * CELL)
        model = Model(aligned([trained(sorted(set(samples)), min(sizes[0], max(32, 2 * len(grams)) * CELL), CELL)]), ordinary, [])
        rows = sample.mapInArrow(_measure(model, ["toxic"]), "toxic int, " + MEASURES).drop("score").collect()
        x = np.array([[r["mean_saving"], r["share"], r["hits"], r["most"]] for r in rows]).reshape(-1, 4)
        y = np.array([r["toxic"] for r in rows], float)
        if len(set(y)) < 2:
            model.weights = [-40.0 if not y.any() else 40.0, 0.0, 0.0, 0.0, 0.0]
        else:
            # The sample's kinds weigh as much as they do among all labels.
            share = {k: labelled.get(k, 0) / max(1, texts.get(k, 0)) for k in (0, 1)}
            weight = np.array([share[int(k)] for k in y])
            model.weights = logistic(x, y, weight * len(y) / weight.sum())
        return model
    finally:
        sample.unpersist()


def scores(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, score, predicted, mean_saving, share, hits, most) for every row of (doc_id, text).

    All windows of the whole text are compared. A null, empty or blank text saves nothing and gets the score of a text without toxic
    windows. Rows are independent of each other; a null doc_id stays null; other columns are ignored.
    """
    small_batches(docs.sparkSession)
    bare = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    found = bare.mapInArrow(_measure(model, ["doc_id"]), "doc_id long, " + MEASURES)
    return found.select("doc_id", "score", F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"), "mean_saving", "share", "hits", "most")


def passed(docs: DataFrame, model: Model) -> DataFrame:
    """Rows of docs (all columns) whose score is under 0.5; the text column is scored where it stands, nothing is joined."""
    small_batches(docs.sparkSession)
    names, schema = docs.columns, docs.schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ordinary, toxic = model.compressors()
        for batch in batches:
            f = np.array([measured(t, ordinary, toxic) for t in batch.column("text").to_pylist()]).reshape(-1, 4)
            yield batch.filter(pa.array(model.score(f) < 0.5)).select(names)

    return docs.mapInArrow(run, schema)
