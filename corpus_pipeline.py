"""Documents from raw to packed: good ones, one of each near-copy, without benchmark questions and secrets, in sequences."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratamart.llm.decontamination import without_contaminated
from stratamart.llm.jaccard_join import one_of_each_group
from stratamart.llm.packing import pack_documents
from stratamart.llm.quality_classifier import accepted, fit
from stratamart.llm.secret_scan import redacted
from stratamart.workspace import materialize


def _good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, trained on the labels, does not reject."""
    return accepted(docs, fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))


def _distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents tied by shared five-word shingles, 80 % or more, that with the smallest id."""
    return one_of_each_group(docs, 5, 80)


def _clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark question."""
    return without_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def _without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets in their texts replaced."""
    out = redacted(docs)
    if "n_chars" in out.columns:
        out = out.withColumn("n_chars", F.char_length("text").cast(out.schema["n_chars"].dataType))
    return out


def _packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in training sequences."""
    return pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("quality_classifier", _good),
    ("near_duplicates", _distinct),
    ("decontamination", _clean),
    ("secrets", _without_secrets),
    ("packing", _packed),
]

# A trained model and a tokenizer are not SQL; tests/llm/test_pipeline.py has a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
