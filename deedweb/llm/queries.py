"""The queries of the text operators: each applies one operator to its whole table and derives digests from its results."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from deedweb.llm import bpe, fingerprints, packing, simhash, warc
from deedweb.llm.conversation_trie import conversation_trie, grafted_sequences, ordered_turns
from deedweb.llm.exact_dedup import exact_dedup
from deedweb.llm.jaccard_join import jaccard_components
from deedweb.llm.line_dedup import line_dedup
from deedweb.llm.substring import substring_dedup
from deedweb.llm.toxicity import toxicity, train_severity
from deedweb.llm.url_filters import filter_urls, rule_table
from deedweb.llm.vector_codes import vector_codes
from deedweb.scratch import fresh_path

TOKENIZER = "byte_bpe_50k.json"
URL_RULES = [
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = filter_urls(table(spark, sf_dir, "pages"), rule_table(spark, URL_RULES))
    return found.select("page_id", "host", "path", "rule", "verdict")


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.simhash_components(table(spark, sf_dir, "documents"), shingle=3, radius=3)
    return found.select("doc_id", simhash.hex_fingerprint(F.col("fp")).alias("fingerprint"), "component_id")


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = line_dedup(table(spark, sf_dir, "documents"))
    kept = F.sha2(F.coalesce("kept_text", F.lit("")), 256).alias("kept_sha256")
    return found.select("doc_id", "n_lines", "n_removed", kept)


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = train_severity(docs, labels, grade_col="toxic", graded_by_rate=True)
    return toxicity(docs, model).select("doc_id", "expected_severity", "p_toxic", "rejected")


def op5_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = fingerprints.edit_probe(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", "n_chars", F.sha2("edited_text", 256).alias("edited_sha256"), "fingerprint", "edited_fingerprint", "near_edited", "near_next"
    )


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER))


def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = substring_dedup(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_path(spark, "warc")
    warc.write_bundles(table(spark, sf_dir, "pages"), path)
    found = warc.read_bundles(spark.read.parquet(path))
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = exact_dedup(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


def op10_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = bpe.round_trip(table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER))
    return found.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("text", 256).alias("decoded_sha256"))


def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = vector_codes(table(spark, sf_dir, "embeddings"))
    return found.select("vec_id", "code", "error", "label_error", "codebooks_sha256")


def op12_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = ordered_turns(table(spark, sf_dir, "conversations"), "conv_id", "turn", "role", "text")
    conv = F.col("conv")
    return conversation_trie(*grafted_sequences(turns, conv - conv % 100, F.crc32(conv.cast("string")) % 6))


def op13_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = jaccard_components(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.col("n").cast("long").alias("n_shingles"), "component_id")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_url_filters,
        op2_simhash,
        op3_line_dedup,
        op4_toxicity,
        op5_fingerprints,
        op6_packing,
        op7_substring_dedup,
        op8_warc,
        op9_exact_dedup,
        op10_bpe,
        op11_vector_codes,
        op12_conversation_trie,
        op13_jaccard_join,
    )
}
