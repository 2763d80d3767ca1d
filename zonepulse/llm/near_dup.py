"""Near duplicates by b-bit MinHash.

Each set of word shingles gets ``bands * rows`` minima. Whole minima make the band keys; of each only the low four bits
are kept, packed sixteen to a long. Sets that share a band key are candidates; the likeness estimated from the bits,
corrected for chance agreement, discards those that are clearly apart, and the full sets decide.

Equal sets form a class with a number of its own, so copies cost one row each. Inside a bucket of more than
``SMALL`` members only one (the pivot) meets the others, which links most of a group of near copies. Buckets whose members
then still lie in several components join into clusters; a cluster is dealt into blocks of about ``BLOCK`` members, members of one large
component together, and each pair of blocks that holds different components is compared in one task on full sets, which
emits one link for each two components it joins. So no link between components is lost, no pair of documents becomes a row there, and no
task holds more than two blocks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from zonepulse.llm.arrays import ascii_tables, distinct_in_rows, mix, powers, shingle_hashes, slices, small_batches, utf8, word_hashes
from zonepulse.llm.components import components
from zonepulse.llm.scratch import stored, stored_at

BANDS, ROWS, BITS = 32, 4, 4
LONGS = BANDS * ROWS * BITS // 64
#: Members of a bucket that are compared pair by pair.
SMALL = 4
#: Members of a block of a cluster.
BLOCK = 256
#: Bits of the filter that says which texts are read again, and how many of them an id sets.
FILTER_BITS, FILTER_HASHES = 1 << 24, 3
#: Standard errors by which an estimate may lie under the threshold and still be looked at.
SLACK = 6.0

SPACE, FOLD = ascii_tables()
FACTORS = mix(np.arange(1, BANDS * ROWS + 1, dtype=np.uint64)) | np.uint64(1)
OFFSETS = mix(np.arange(1000, 1000 + BANDS * ROWS, dtype=np.uint64))


def _sets(batch: pa.RecordBatch, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes, and the rows' first places in them and counts."""
    data, offsets = utf8(batch, "text")
    words, rows = word_hashes(data, offsets, SPACE, FOLD)
    values, rows = distinct_in_rows(*shingle_hashes(words, rows, width))
    count = np.bincount(rows, minlength=batch.num_rows).astype(np.int64)
    return values, np.cumsum(count) - count, count


def _minima(values: np.ndarray, start: np.ndarray, count: np.ndarray) -> np.ndarray:
    """Minima of each row with shingles under each hash function."""
    filled = np.flatnonzero(count)
    out = np.zeros((len(start), len(FACTORS)), np.uint64)
    for j, (a, b) in enumerate(zip(FACTORS, OFFSETS, strict=True)):
        h = values * a
        h += b
        h ^= h >> np.uint64(32)
        h *= a
        out[filled, j] = np.minimum.reduceat(h, start[filled])
    return out


def _set_keys(values: np.ndarray, start: np.ndarray, count: np.ndarray) -> np.ndarray:
    """Two fingerprints of each row's set."""
    filled = np.flatnonzero(count)
    keys = np.zeros((2, len(count)), np.uint64)
    if len(filled):
        for k in range(2):
            keys[k, filled] = np.add.reduceat(mix(values + np.uint64(k + 7)), start[filled])
    return keys


def _signatures(width: int):
    schema = pa.schema([("id", pa.int64()), ("n_shingles", pa.int64()), ("set_key", pa.int64()), ("set_check", pa.int64()), ("bands", pa.list_(pa.int64())), ("bits", pa.list_(pa.int64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                values, start, count = _sets(part, width)
                n, filled = part.num_rows, np.flatnonzero(count)
                keys = _set_keys(values, start, count)
                bands = np.zeros((n, BANDS), np.uint64)
                packed = np.zeros((n, LONGS), np.uint64)
                if len(filled):
                    low = _minima(values, start, count)
                    weights = powers(int(FACTORS[0]), ROWS)
                    bands = mix((low.reshape(n, BANDS, ROWS) * weights).sum(axis=2, dtype=np.uint64) + OFFSETS[:BANDS])
                    nibbles = (low >> np.uint64(20)) & np.uint64(2**BITS - 1)
                    shift = np.arange(64 // BITS, dtype=np.uint64) * np.uint64(BITS)
                    packed = (nibbles.reshape(n, LONGS, 64 // BITS) << shift).sum(axis=2, dtype=np.uint64)
                lists = [pa.ListArray.from_arrays(np.arange(n + 1, dtype=np.int32) * x.shape[1], x.view(np.int64).ravel()) for x in (bands, packed)]
                columns = [part.column("id"), count, keys[0].view(np.int64), keys[1].view(np.int64), *lists]
                yield pa.RecordBatch.from_arrays([x if isinstance(x, pa.Array) else pa.array(x) for x in columns], schema=schema)

    return run


def _full_sets(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                values, start, count = _sets(part, width)
                keys = _set_keys(values, start, count)
                raw = [values[s : s + n].tobytes() for s, n in zip(start, count, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys[0].view(np.int64)), pa.array(keys[1].view(np.int64)), pa.array(count), pa.array(raw, pa.binary())],
                    names=["set_key", "set_check", "n_shingles", "members"],
                )

    return run


def _shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Size of the intersection of two sorted sets."""
    for batch in batches:
        both = []
        for x, y in zip(batch.column("sa").to_pylist(), batch.column("sb").to_pylist(), strict=True):
            u, v = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
            at = np.searchsorted(u, v)
            both.append(int((u[np.minimum(at, len(u) - 1)] == v).sum()) if len(u) else 0)
        yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), batch.column("na"), batch.column("nb"), pa.array(both, pa.int64())], names=["a", "b", "na", "nb", "both"])


def estimate(left: str, right: str) -> Column:
    """Likeness from packed bits: the share of agreeing minima, less the agreement that chance gives."""
    agree = F.lit(BANDS * ROWS)
    for i in range(LONGS):
        x = F.col(left)[i].bitwiseXOR(F.col(right)[i])
        for step in (2, 1):
            x = x.bitwiseOR(F.shiftrightunsigned(x, step))
        agree = agree - F.bit_count(x.bitwiseAND(F.lit(0x1111111111111111)))
    chance = 0.5**BITS
    return (agree / (BANDS * ROWS) - chance) / (1 - chance)


def _likely(pairs: DataFrame, reps: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) that size and estimate do not rule out."""
    t = percent / 100
    floor = t - SLACK * float(np.sqrt(t * (1 - t) / (BANDS * ROWS))) / (1 - 0.5**BITS)
    side = lambda x: reps.select(F.col("class_id").alias(x), F.col("n_shingles").alias("n" + x), F.col("bits").alias("bits_" + x))
    return (
        pairs.join(side("a"), "a").join(side("b"), "b")
        .where(F.least("na", "nb") * 100 >= F.greatest("na", "nb") * percent)
        .where(estimate("bits_a", "bits_b") >= floor)
        .select("a", "b", "na", "nb")
    )


def _confirmed(near: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) of which 100 * intersection >= percent * union, on full sets."""
    full = near.join(sets.select(F.col("id").alias("b"), F.col("members").alias("sb")), "b").join(sets.select(F.col("id").alias("a"), F.col("members").alias("sa")), "a")
    counted = full.select("a", "b", "na", "nb", "sa", "sb").mapInArrow(_shared, "a long, b long, na long, nb long, both long")
    return counted.where(F.col("both") * 100 >= (F.col("na") + F.col("nb") - F.col("both")) * percent).select("a", "b")


def intersections(left: list[np.ndarray], right: list[np.ndarray], columns: int = 8192) -> np.ndarray:
    """Sizes of the intersections of all sets of two blocks, by matrix products over a few thousand members at a time."""
    out = np.zeros((len(left), len(right)), np.float32)
    shared = np.intersect1d(np.unique(np.concatenate(left)), np.unique(np.concatenate(right)))
    for at in range(0, len(shared), columns):
        part = shared[at : at + columns]
        sides = []
        for block in (left, right):
            held = np.zeros((len(block), len(part)), np.float32)
            for i, s in enumerate(block):
                place = np.searchsorted(part, s)
                held[i, place[(place < len(part)) & (part[np.minimum(place, len(part) - 1)] == s)]] = 1
            sides.append(held)
        out += sides[0] @ sides[1].T
    return out


def _joined_blocks(percent: int):
    """Links between the components of two blocks, one for each two that the links before do not yet join."""

    def run(table: pa.Table) -> pa.Table:
        side, ids, comp = (table.column(c).to_numpy() for c in ("side", "id", "c"))
        sets = [np.frombuffer(x.as_py(), np.uint64) for x in table.column("members")]
        u = np.flatnonzero(side == 0)
        v = np.flatnonzero(side == 1) if (side == 1).any() else u
        size = np.array([len(s) for s in sets], np.float64)
        both = intersections([sets[i] for i in u], [sets[i] for i in v]).astype(np.float64)
        linked = (both * 100 >= (size[u][:, None] + size[v][None, :] - both) * percent) & (comp[u][:, None] != comp[v][None, :])
        root: dict[int, int] = {}

        def find(x: int) -> int:
            while root.setdefault(x, x) != x:
                x = root[x]
            return x

        out = []
        for i, j in zip(*np.nonzero(linked), strict=True):
            x, y = find(int(comp[u[i]])), find(int(comp[v[j]]))
            if x != y:
                root[max(x, y)] = min(x, y)
                out.append((int(min(ids[u[i]], ids[v[j]])), int(max(ids[u[i]], ids[v[j]]))))
        return pa.table({"a": pa.array([a for a, _ in out], pa.int64()), "b": pa.array([b for _, b in out], pa.int64())})

    return run


def _between_components(many: DataFrame, joined: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) between members of different components that share a bucket."""
    placed = many.join(joined, many.x == joined.node, "left").select("key", "x", F.coalesce("component", "x").alias("c"))
    mixed = placed.groupBy("key").agg(F.min("c").alias("c0"), F.max("c").alias("c1"), F.min("x").alias("least")).where("c0 != c1").select("key", "least")
    open_ = stored(placed.join(mixed, "key").select("x", "c", "least").distinct(), "mixed")
    clusters = components(open_.select(F.col("x").alias("a"), F.col("least").alias("b")))
    members = open_.select("x", "c").distinct().join(clusters, F.col("x") == F.col("node")).select("x", "c", F.col("component").alias("cluster"))
    members = stored(members, "clusters")
    sizes = members.groupBy("cluster", "c").agg(F.count("*").alias("k"))
    small = sizes.where(F.col("k") < BLOCK // 2).groupBy("cluster").agg(F.sum("k").alias("rest"))
    # Components of half a block or more are dealt into blocks of their own, smaller ones share blocks.
    dealt = members.join(sizes, ["cluster", "c"]).join(small, "cluster", "left")
    large = F.col("k") >= BLOCK // 2
    parts = F.ceil(F.when(large, F.col("k")).otherwise(F.col("rest")) / BLOCK)
    number = F.pmod(F.xxhash64(F.when(large, F.col("x")).otherwise(F.col("c"))), parts)
    dealt = dealt.select("cluster", "x", "c", F.struct(F.when(large, F.col("c")).alias("own"), number.alias("number")).alias("block"))
    dealt = stored(dealt, "blocks")
    blocks = dealt.select("cluster", "block").distinct()
    order = lambda x: F.struct(F.coalesce(x["own"], F.lit(-1)), x["number"])
    left, right = blocks.select("cluster", F.col("block").alias("p")), blocks.select("cluster", F.col("block").alias("q"))
    pairs = left.join(right, "cluster").where(order(F.col("p")) <= order(F.col("q"))).where("p.own IS NULL OR q.own IS NULL OR p.own != q.own")
    sides = pairs.withColumn("pair", F.struct("cluster", "p", "q")).select("cluster", "pair", F.explode(F.array_distinct(F.array("p", "q"))).alias("block"))
    sides = sides.select("cluster", "pair", "block", F.when(F.col("block").eqNullSafe(F.col("pair.p")), 0).otherwise(1).alias("side"))
    key = lambda: F.xxhash64("cluster", F.coalesce("block.own", F.lit(-1)), "block.number")
    rows = dealt.withColumn("at", key()).join(sides.withColumn("at", key()).select("at", "pair", "side"), "at").join(sets, F.col("x") == F.col("id"))
    return rows.select("pair", "side", "id", "c", "members").groupBy("pair").applyInArrow(_joined_blocks(percent), "a long, b long")


def _maybe_in(texts: DataFrame, ids: DataFrame) -> DataFrame:
    """Rows of (id, text) whose id is among ``ids``, and some others.

    Every task gets a Bloom filter of fixed size (2 MB), so no text is shuffled to find out, however many ids there are. At two million
    ids about 3 % of the other rows pass; more ids let more pass and lose none.
    """
    places = [F.pmod(F.xxhash64("id", F.lit(k)), F.lit(FILTER_BITS)) for k in range(FILTER_HASHES)]
    bit = F.expr("shiftleft(1L, cast(place & 63 AS int))")
    words = ids.select(F.explode(F.array(*places)).alias("place")).groupBy(F.expr("place div 64").alias("word")).agg(F.bit_or(bit).alias("bits"))
    every = ids.sparkSession.range(FILTER_BITS // 64).select(F.col("id").alias("word")).join(words, "word", "left")
    dense = every.agg(F.sort_array(F.collect_list(F.struct("word", F.coalesce("bits", F.lit(0)).alias("bits"))))["bits"].alias("bits"))
    kept = dense.scalar()
    for place in places:
        word = F.get(kept, F.floor(place / 64).cast("int"))
        texts = texts.where(word.bitwiseAND(F.call_function("shiftleft", F.lit(1).cast("long"), place.bitwiseAND(F.lit(63)).cast("int"))) != 0)
    return texts


def _pairs(left: DataFrame, right: DataFrame) -> DataFrame:
    """Pairs (a < b) of the members that meet in a bucket, once for each bucket or more often."""
    met = left.join(right, "key").where("x != y")
    return met.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"))


def near_duplicates(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """(doc_id, n_shingles, class_id, component_id, kept) for every row of (doc_id, text).

    Words are runs of bytes other than ASCII white space, A-Z lower-cased. A text with fewer words than ``width`` is one
    shingle. A null, empty or blank text has no shingle, equals nothing and is its own component. A row without doc_id
    keeps a null component and is kept; repeated rows share one. Rows that share a doc_id with other texts are one document: what is
    like any of its texts is joined to it, and all its rows with words share its component. Other columns are ignored.

    A pair of likeness 0.8 shares none of the 32 bands of 4 minima with probability 5e-8.
    """
    spark = docs.sparkSession
    small_batches(spark)
    texts = docs.select(F.col("doc_id").cast("long").alias("id"), F.col("text").cast("string").alias("text"))
    signed = stored(texts.mapInArrow(_signatures(width), "id long, n_shingles long, set_key long, set_check long, bands array<long>, bits array<long>"), "signatures")
    same = ["set_key", "set_check", "n_shingles"]
    filled = signed.where("n_shingles > 0 AND id IS NOT NULL")
    # Written at once, so the numbers stay; a class is a set, whatever doc_ids its rows have. Equal sets have equal signatures, so any row's serves.
    classes = filled.groupBy(*same).agg(F.min(F.struct("id", "bands", "bits")).alias("least"))
    classes = classes.select(*same, F.col("least.id").alias("least_id"), "least.bands", "least.bits", F.monotonically_increasing_id().alias("class"))
    classes, _ = stored_at(classes, "classes")
    reps = classes.select(F.col("class").alias("class_id"), "n_shingles", "bands", "bits")
    classes = classes.drop("bands", "bits")
    buckets = reps.select("class_id", F.explode("bands").alias("key"))
    sizes = buckets.groupBy("key").agg(F.count("*").alias("m"), F.min("class_id").alias("pivot")).where("m > 1")
    members, _ = stored_at(buckets.join(sizes, "key"), "buckets")
    members = members.withColumnRenamed("class_id", "x")
    few = members.where(F.col("m") <= SMALL)
    many = members.where(F.col("m") > SMALL)
    pairs = _pairs(few.select("key", "x"), few.select("key", F.col("x").alias("y"))).unionAll(
        many.where("x != pivot").select(F.col("pivot").alias("a"), F.col("x").alias("b"))
    )
    near, _ = stored_at(_likely(pairs.distinct(), reps, percent), "candidates")
    wanted = near.select(F.explode(F.array("a", "b")).alias("class")).unionAll(many.select(F.col("x").alias("class"))).distinct()
    wanted = stored(classes.join(wanted, "class", "left_semi"), "wanted")
    # The join on the sets' keys drops the texts that the filter let pass in vain.
    sets = _maybe_in(texts, wanted.select(F.col("least_id").alias("id")).distinct())
    sets = sets.mapInArrow(_full_sets(width), "set_key long, set_check long, n_shingles long, members binary")
    # One row a class: rows with the same keys lie together after the join.
    sets = sets.join(wanted, same).dropDuplicates(same).select(F.col("class").alias("id"), "members")
    sets, _ = stored_at(sets, "sets")
    links, _ = stored_at(_confirmed(near, sets, percent), "links")
    joined = components(links)
    more = stored(_between_components(many, joined, sets, percent), "links")
    placed = signed.select("id", *same).join(classes, same, "left").select("id", "n_shingles", "class", "least_id")
    placed = stored(placed, "placed")
    # Rows that share a doc_id are one document, so their sets are joined through it.
    shared = placed.where("id IS NOT NULL").groupBy("id").agg(F.min("class").alias("b"), F.max("class").alias("c")).where("b != c").select("id", "b")
    by_id = placed.join(shared, "id").where("class != b").select(F.col("class").alias("a"), "b").distinct()
    more = stored(more.unionAll(by_id), "links")
    if not more.isEmpty():
        joined = components(joined.select(F.col("node").alias("a"), F.col("component").alias("b")).unionAll(more))
    named = classes.select("class", "least_id").join(joined, F.col("class") == F.col("node")).groupBy("component").agg(F.min("least_id").alias("component_id"))
    joined = joined.join(named, "component").select("node", "component_id")
    found = placed.join(joined, placed["class"] == joined["node"], "left")
    own = lambda *x: F.when(F.col("id").isNotNull(), F.coalesce(*x, "id"))
    found = found.select(F.col("id").alias("doc_id"), "n_shingles", own("least_id").alias("class_id"), own("component_id", "least_id").alias("component_id"))
    return found.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
