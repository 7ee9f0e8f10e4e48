"""Corpus pipeline: quality filter, line dedup, near-duplicate removal, benchmark
decontamination and tokenization, each stage written and read again."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from fleetframe.llm.common import Plain, crc32_fold, materialize, read_table
from fleetframe.llm.decontaminate import decontaminate
from fleetframe.llm.lines import dedup_lines
from fleetframe.llm.pieces import encode_and_decode
from fleetframe.llm.quality import fit_quality, score_quality
from fleetframe.llm.simhash import drop_near_duplicates


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts: that of ``op10_quality``, which learns
    from the labelled rows of ``documents`` in its fold.  Null texts are scored as empty ones."""
    model = fit_quality(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"),
                        fold=crc32_fold("doc_id", 3) != 1)
    plain = Plain(docs)
    scored = score_quality(plain.df, model, plain.of("text"), "score", "keep", plain.find("n_chars") or "n_chars")
    return scored.where("keep = 1").drop("score", "keep").toDF(*plain.names)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the lines that three or more of them share (the
    largest doc_id keeps them); n_chars follows the text."""
    plain = Plain(docs)
    text, n_chars = plain.of("text"), plain.find("n_chars")
    out = dedup_lines(plain.df, plain.of("doc_id"), text).drop("n_lines", "n_dropped")
    if n_chars:
        out = out.withColumn(n_chars, F.length(text).cast("long"))
    return out.toDF(*plain.names)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component: that of the smallest doc_id."""
    return drop_near_duplicates(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no passage of ``benchmark``."""
    return decontaminate(docs, read_table(spark, sf_dir, "benchmark"))


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens and SentencePiece ids of every document, the text decoded from the
    ids, and whether it is the document's (null as empty) again."""
    out = encode_and_decode(docs)
    return out.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids", "decoded", "round_trip")


STAGES = [
    ("quality_classifier", keep_quality),
    ("line_dedup", drop_repeated_lines),
    ("simhash_near_dedup", one_of_each_group),
    ("benchmark_decontamination", without_benchmark),
    ("sentencepiece", tokenize),
]

#: The trained classifier and the tokenizer have no SQL form; tests/llm compares with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to ``documents``, each one's result written before the next reads it."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
