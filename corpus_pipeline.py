"""A text corpus from raw documents to packed sequences, in five stages.

Each stage takes what the one before kept, in the columns of ``documents``; ``n_chars`` follows the text. Texts that a stage
does not change stay as they are.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from deedweb.llm import packing, simhash
from deedweb.llm.line_dedup import line_dedup
from deedweb.llm.substring import substring_dedup
from deedweb.llm.toxicity import toxicity, train_severity
from deedweb.scratch import discard, written

#: Bytes of an Arrow batch. Executors run all stages and keep what their buffers grew to, so batches are smaller than an operator's own.
BATCH_BYTES = 4 << 20
COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def _modest(spark: SparkSession) -> None:
    """Lower the size of Arrow batches in this session, for good."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def _with_text(df: DataFrame, changed: str) -> DataFrame:
    """The columns of ``documents``, with the kept text and its length where ``n_removed`` says that something went."""
    text = F.when(F.col("n_removed") > 0, F.col(changed)).otherwise(F.col("text"))
    size = F.when(F.col("n_removed") > 0, F.length(changed).cast("long")).otherwise(F.col("n_chars"))
    return df.withColumns({"text": text, "n_chars": size}).select(*COLUMNS)


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the severity model does not reject."""
    _modest(spark)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = train_severity(docs, labels, grade_col="toxic", graded_by_rate=True)
    return toxicity(docs, model).where("not rejected").select(*COLUMNS)


def drop_boilerplate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that occur across sites stay in one document only."""
    _modest(spark)
    return _with_text(line_dedup(docs), "kept_text")


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, by Jaccard similarity of five-word shingles with SimHash candidates."""
    _modest(spark)
    return simhash.keep_one(docs).select(*COLUMNS)


def drop_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of 50 words or more that an earlier document has."""
    _modest(spark)
    return _with_text(substring_dedup(docs), "kept_text")


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each piece of each document goes in sequences of 2048 tokens."""
    _modest(spark)
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", reject_toxic),
    ("line_dedup", drop_boilerplate),
    ("simhash_near_dedup", drop_near_copies),
    ("substring_dedup", drop_repeats),
    ("best_fit_packing", pack_sequences),
]

#: The toxicity model, SimHash and tokens are beyond SQL; tests/llm hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written to the shared folder, read by the next, and deleted when that
    is written."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    before = None
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
        if before is not None:
            discard(before)
        before = docs
    return STAGES[-1][1](spark, docs, sf_dir)
