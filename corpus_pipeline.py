"""Training-data pipeline over ``documents``: each stage reads what its predecessor wrote.

STAGES lists (name, function); a function takes (spark, docs, sf_dir) and returns a
DataFrame, which ``run`` writes as Parquet below the shared checkpoint folder and rereads.
All but the last return the columns of ``documents``.

Defined results of the five stages on odd rows: a null or empty text, or one of fewer than ten
words, fails the quality rules and goes; rows with a null id or source take part (without a
source a document has no host verdict against it, and shares the mix's null source); of rows that
repeat one id and text the near dedup stage keeps one; ties go to the least id; texts of any
length are read whole; columns beyond those of ``documents``, whatever their names, are
carried to the last stage, which returns pieces alone; an empty table stays empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from crease.llm import lines, mixing, near, packing, quality
from crease.llm.common import documents, materialise


#: Near duplicates of this stage share so many percent of their shingles; op4 has its own.
NEAR_PERCENT = 80


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the quality rules, or whose host does, go."""
    return quality.keep_good(docs)


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Boilerplate lines go, but for their first place; so do documents of nothing else."""
    return lines.keep_unboiled(docs).withColumn("n_chars", F.length("text").cast("long"))


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the document with the least id stays."""
    return near.keep_representatives(docs, threshold=NEAR_PERCENT)


def mix_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents are left out or repeated, whole, until each source nears its target."""
    return mixing.mixed_documents(docs)


def pack_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per piece of a document, with its place in a training sequence."""
    return packing.pack(docs)


STAGES = [
    ("quality rules", quality_stage),
    ("line dedup", line_stage),
    ("near dedup", near_stage),
    ("mixing", mix_stage),
    ("packing", pack_stage),
]

#: Similarity components, seeded selection and packing are not SQL; tests use brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), "stage-" + name.replace(" ", "-"))
    return docs
