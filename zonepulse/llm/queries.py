"""One registered query per operator, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op7_near_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from zonepulse.llm.near_dup import near_duplicates

    return near_duplicates(table(spark, sf_dir, "documents"), width=2, percent=80).select("doc_id", "n_shingles", "component_id", "kept")


@query
def op6_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    from zonepulse.llm.fingerprints import compare_with_next

    return compare_with_next(table(spark, sf_dir, "documents"))


@query
def op8_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from zonepulse.llm.bpe import encode_texts

    return encode_texts(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


@query
def op4_wavelet_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from zonepulse.llm.wavelet import encode_round_trip

    return encode_round_trip(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), end_id=2)


@query
def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import functions as F

    from zonepulse.llm.toxicity import fit, scores

    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    fold = lambda: F.crc32(F.col("doc_id").cast("string")) % 5
    found = scores(docs, fit(docs, labels.where(fold() != 0)))
    return found.select("doc_id", (fold() == 0).alias("held_out"), "score", "predicted", "mean_saving", "share", "hits", "most")


@query
def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    from zonepulse.llm.decontaminate import contaminated

    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op3_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    from zonepulse.llm.main_text import extract

    return extract(table(spark, sf_dir, "pages"))


@query
def op5_preferences(spark: SparkSession, sf_dir: str) -> DataFrame:
    from zonepulse.llm.preferences import neighbouring_pairs, preference_pairs

    turns = table(spark, sf_dir, "conversations")
    return preference_pairs(turns, neighbouring_pairs(turns))


@query
def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    from zonepulse.llm.warc import derivatives, responses

    return derivatives(responses(table(spark, sf_dir, "pages"), "2024-01-01T00:00:00Z"))


def _oracles() -> None:
    from zonepulse.llm import preferences

    ORACLES["op5_preferences"] = preferences.SQL


_oracles()


@query
def op9_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    from zonepulse.llm.repeats import remove_repeats

    return remove_repeats(table(spark, sf_dir, "documents"), length=400)


@query
def op11_pair_bitmaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from zonepulse.llm.alignment import alignment_scores

    return alignment_scores(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))


@query
def op12_license_notices(spark: SparkSession, sf_dir: str) -> DataFrame:
    from zonepulse.llm.license_scan import license_labels

    return license_labels(table(spark, sf_dir, "documents")).drop("spans")


@query
def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    from zonepulse.llm.runs import periodic_runs, planted

    return periodic_runs(table(spark, sf_dir, "documents"), planted).drop("n_words", "runs")
