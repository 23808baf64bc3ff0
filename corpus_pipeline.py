"""A corpus from raw documents to packed sequences: each stage is one operator over all that the stage before kept.

toxicity            learns from the labelled documents outside the held-out fold and drops what it scores at 0.5 or more
ngram_jaccard       keeps the smallest doc_id of each group of near duplicates (five words, similarity 0.8)
decontamination     drops documents that hold benchmark items
pseudonyms          replaces personal numbers, dates, addresses and secrets
best_fit_packing    packs the rest into sequences of 2048 tokens; returns the pieces
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyframe.llm import decontam, jaccard, packing, pseudonyms, toxicity
from tallyframe.llm.common import keep
from tallyframe.llm.queries import pseudonym_key, tokenizer_file


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """docs without those scored at 0.5 or more. Null and empty texts have the bias's score alone; rows with null or repeated ids are scored one by one, and learnt from only if labelled."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    out = toxicity.held_out(F.col("doc_id"))
    model = toxicity.train(docs.filter(~out), labels.filter(~out))
    return toxicity.drop_toxic(docs, model)


def jaccard_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """docs with one document of each group of near duplicates. Rows without words or without an id stay; rows with equal ids stay or go together."""
    return jaccard.keep_first(docs, words=5, percent=80)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """docs without those that hold at least half of a benchmark item. Null and empty texts and rows with a null id stay; rows with equal ids go together."""
    return decontam.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def pseudonym_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """docs with values in their texts replaced, under the session's key. Null texts and texts without values come back as they are."""
    return pseudonyms.pseudonymise(docs, pseudonym_key(spark))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all docs and their places in sequences. A null text counts as empty, which is one piece of the end id alone; rows with equal ids are documents of their own."""
    return packing.pack(docs, tokenizer_file())


STAGES = [
    ("toxicity", toxicity_stage),
    ("ngram_jaccard", jaccard_stage),
    ("decontamination", decontamination_stage),
    ("pseudonyms", pseudonym_stage),
    ("best_fit_packing", packing_stage),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows, with each stage but the last written to the shared folder as Parquet and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = keep(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)


#: A learnt model, a keyed permutation and a tokenizer have no SQL; tests compare the stages with plain versions.
ORACLE_SQL = None
