"""The corpus pipeline: quality rules, near duplicates, decontamination, mixing, token files.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame. All but the last return the columns that the
documents came with, so that each works on all that its predecessor kept.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tintloom.llm import decontaminate, jaccard, mix, pfor, quality
from tintloom.llm.common import discard_since, made, stored, table
from tintloom.llm.queries import tokenizer_path


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the model; it is fitted on labelled documents of `docs`."""
    model = quality.fit_on(docs, table(spark, sf_dir, "labels"))
    return quality.judge(docs, model).where("__kept").select(*docs.columns)


def keep_one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each near-duplicate group: of the smallest doc_id, those without one last.

    Rows are told apart by a number of their own, so rows that share a doc_id or have none are compared like
    any others, and of rows repeated as a whole one stays. A row without words is in no group and stays.
    """
    number = next(n for i in range(len(docs.columns) + 1) if (n := f"row_{i}") not in docs.columns)
    rows = stored(docs.withColumn(number, F.monotonically_increasing_id()), "rows")
    groups = jaccard.near_duplicates(rows.select(F.col(number).alias("doc_id"), "text"))
    placed = groups.select(F.col("doc_id").alias(number), "component_id").join(rows.select(number, "doc_id"), number)
    first = placed.groupBy("component_id").agg(F.min(F.struct(F.isnull("doc_id"), "doc_id", number)).alias("first"))
    return rows.join(first.select(F.col("first")[number].alias(number)), number, "left_semi").select(*docs.columns)


def keep_uncontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any window of a benchmark item."""
    found = decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"))
    return found.where(F.size("__runs") == 0).select(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as their source's target says."""
    return mix.mix(docs)


def write_token_files(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files of the mix, as read back: a row for each copy of a document."""
    return pfor.tokens_round_trip(docs, tokenizer_path())


STAGES = [
    ("quality_rules", keep_good),
    ("ngram_jaccard", keep_one_of_each_group),
    ("decontamination", keep_uncontaminated),
    ("mixing", mix_sources),
    ("token_files", write_token_files),
]

#: The quality stage fits a model and the last one runs a tokenizer, which SQL can't express; tests hold the pipeline against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`, each written as a table and read by the next; then what it worked with is deleted."""
    docs = table(spark, sf_dir, "documents")
    start = made()
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
        discard_since(docs, start)
    return STAGES[-1][1](spark, docs, sf_dir)
