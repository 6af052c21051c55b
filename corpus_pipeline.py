"""From raw documents to packed token sequences, in stages that each write a table.

Every stage works on all that the one before kept. The first four return the columns of documents.
"""
from __future__ import annotations

from pyspark.sql import functions as F

from barloom.llm import minhash, mixing, packing, pii, quality
from barloom.llm.common import dropped, staged


def quality_filter(spark, docs, sf_dir):
    """Documents whose quality posterior is high and whose toxicity posterior is low; the rest goes."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return quality.classify(docs, labels, F.col("source"), F.col("lang")).where("__kept").select(*docs.columns)


def near_duplicates(spark, docs, sf_dir):
    """One document of each group of near duplicates (five-word shingles, similarity of 0.8 or more)."""
    return minhash.without_near_duplicates(docs, k=5, percent=80)


def personal_data(spark, docs, sf_dir):
    """Personal data in the texts is replaced by its kind; n_chars is that of the new text."""
    return pii.without_personal(docs)


def mixed(spark, docs, sf_dir):
    """Documents repeated, or left out, so that the sources' words come near their targets."""
    sized = docs.select("source", mixing.word_count(F.col("text")).alias("size"))
    targets = mixing.source_targets(mixing.cyclic_weights(mixing.source_sizes(sized)))
    return mixing.mix(docs, targets)


def packed(spark, docs, sf_dir):
    """Pieces of the documents, placed in sequences of 4096 tokens."""
    return packing.pack(staged(packing.tokenized(docs, packing.tokenizer_path()), "tokens"))


STAGES = [
    ("quality classifier", quality_filter),
    ("minhash near-dedup", near_duplicates),
    ("personal data", personal_data),
    ("mixing to target weights", mixed),
    ("packing", packed),
]
#: The classifier, the sketches and the tokenizer have no SQL; tests/llm compare the stages with plain loops.
ORACLE_SQL = None


def run(spark, sf_dir):
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name.replace(" ", "-"))
        if before is not None:
            dropped(before)
        before = docs
    return STAGES[-1][1](spark, docs, sf_dir)
