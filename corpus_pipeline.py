"""Cleans the documents for training: toxic texts go, near copies go, repeated passages go, benchmark leaks go, the rest is encoded.

Each stage takes (spark, docs, sf_dir) and returns the columns of documents; the last returns the encoding.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from zonepulse.llm.bpe import encode_texts
from zonepulse.llm.decontaminate import clean
from zonepulse.llm.near_dup import near_duplicates
from zonepulse.llm.repeats import remove_repeats
from zonepulse.llm.scratch import release, stored
from zonepulse.llm.toxicity import fit, passed

#: Bytes of a passage that is removed wherever it repeats: under the length of fifty words.
PASSAGE = 200


#: Columns of documents.
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that the classifier does not call toxic, each by its own text. It learns from the labels of these documents."""
    model = fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return passed(docs, model).select(*COLUMNS)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near duplicates: five-word shingles, likeness 0.8 or more.

    Every row stands for itself, under a row number written with its text, so different texts that share a doc_id are judged
    apart. The smallest doc_id of a group stays, one without doc_id only where all have none; of rows that share that doc_id,
    repeated rows included, one stays. Null, empty and blank texts equal nothing and all stay.
    """
    rows = stored(docs.select(F.monotonically_increasing_id().alias("row"), *COLUMNS), "rows")
    found = near_duplicates(rows.select(F.col("row").alias("doc_id"), "text"), width=5, percent=80).select(F.col("doc_id").alias("row"), "component_id")
    placed = found.join(rows.select("row", F.col("doc_id").cast("long").alias("doc_id")), "row")
    first = placed.groupBy("component_id").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row")).alias("first"))
    return rows.join(first.select("first.row"), "row", "left_semi").select(*COLUMNS)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows, without the passages of 200 bytes or more that also stand elsewhere, in the same row or another.

    Copies of a passage go in all places. Whole copies of a document would go so too; the stage before has left one of them.
    """
    release(spark)
    cut = remove_repeats(docs, PASSAGE, keep=["doc_id", "lang", "source"], text_out=True)
    return cut.select("doc_id", F.col("kept_text").alias("text"), "lang", "source", F.char_length("kept_text").cast("long").alias("n_chars"))


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows whose own text does not cover half of a benchmark item, whatever their doc_id and whoever shares it."""
    return clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet")).select(*COLUMNS)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of the rest, and its token ids."""
    return encode_texts(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN, keep_ids=True)


STAGES = [
    ("toxicity", drop_toxic),
    ("near duplicates", drop_near_copies),
    ("repeated passages", cut_repeats),
    ("decontamination", drop_leaks),
    ("encoding", encode),
]

#: SQL can express none of compression lengths, minimum hashes, greedy tiles or merges.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
