"""A corpus from raw documents to packed sequences, in five stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; the next one reads it
back from Parquet. All but the last return the columns of ``documents``.
"""

import public_tokenizers
from pyspark.sql import functions as F

from demandloom.llm import decontamination, near_copies, packing, quality_rules, secret_scan
from demandloom.session import shared_folder


def with_lengths(docs):
    """``n_chars`` of texts that a stage has changed."""
    return docs.withColumn("n_chars", F.coalesce(F.length("text"), "n_chars").cast(docs.schema["n_chars"].dataType))


def keep_quality(spark, docs, sf_dir):
    """Documents that pass every rule; the rules are a filter on the scan itself."""
    return quality_rules.passing(docs)


def drop_near_duplicates(spark, docs, sf_dir):
    """Documents that are no near copy, by five-word shingles and 0.8, of one with a lesser id."""
    return near_copies.keep_one(docs)


def remove_benchmark(spark, docs, sf_dir):
    """Texts without the benchmark's passages."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return with_lengths(decontamination.remove_contamination(docs, benchmark))


def mask_secrets(spark, docs, sf_dir):
    """Texts with secrets masked."""
    return with_lengths(secret_scan.mask_secrets(docs))


def pack(spark, docs, sf_dir):
    """Pieces of documents in sequences of 2048 tokens."""
    return packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("quality rules", keep_quality),
    ("near duplicates", drop_near_duplicates),
    ("decontamination", remove_benchmark),
    ("secrets", mask_secrets),
    ("packing", pack),
]

#: SQL has neither the fingerprints nor the tokenizer.
ORACLE_SQL = None


def run(spark, sf_dir):
    docs, path = spark.read.parquet(f"{sf_dir}/documents.parquet"), shared_folder(spark, "corpus")
    for number, (_, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{path}/{number}")
        docs = spark.read.parquet(f"{path}/{number}")
    return docs
