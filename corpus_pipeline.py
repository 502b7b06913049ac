"""From raw documents to packed training sequences.

STAGES lists (name, function).  A function takes (spark, docs, sf_dir) and
gives a DataFrame; ``run`` writes each result as Parquet into the shared
checkpoint folder, reads it again as the next stage's documents and deletes it
when that stage is written.  All but
the last give the columns of ``documents``.
"""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from florilege.llm.decontaminate import decontaminate
from florilege.llm.near import one_of_each
from florilege.llm.packing import pack
from florilege.llm.quality import apply_rules
from florilege.llm.shared import checkpoint_dir, remove_folder

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
BYTE_BPE, PIECES = "byte_bpe_50k.json", "piece_bpe_32k.model"


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejected documents go; each row is judged by itself."""
    judged = apply_rules(docs, public_tokenizers.path(PIECES), public_tokenizers.path(BYTE_BPE), public_tokenizers.PATTERN, carry=COLUMNS[1:])
    return judged.filter("kept").select(*COLUMNS)


def jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the document with the least id stays, once if its row repeats."""
    return one_of_each(docs.select(*COLUMNS))


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a word inside a benchmark window go."""
    found = decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), carry=COLUMNS[1:])
    return found.filter("not contaminated").select(*COLUMNS)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the sequences that the documents are packed into."""
    return pack(docs, public_tokenizers.path(BYTE_BPE), public_tokenizers.PATTERN)


STAGES = [
    ("quality rules", quality_rules),
    ("n-gram Jaccard join", jaccard_join),
    ("benchmark decontamination", benchmark_decontamination),
    ("packing", packing),
]
#: The tokeniser's pieces and the packing can't be said in SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows over all ``documents``."""
    checkpoint_dir(spark)
    folder = f"{spark.sparkContext.getCheckpointDir()}/pipeline-{uuid.uuid4().hex}"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{k}")
        docs = spark.read.parquet(f"{folder}/{k}")
        if k:
            remove_folder(spark, f"{folder}/{k - 1}")
    return docs
