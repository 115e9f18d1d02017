"""Training-corpus pipeline over ``documents``: each stage works on the rows its
predecessor kept, written as Parquet and read again.  All stages but the last return
the columns of ``documents``; the last returns the packed pieces."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketmine.llm.common import TABLE_COLUMNS, stored, table
from basketmine.llm.decontam import clean_documents
from basketmine.llm.packing import pack
from basketmine.llm.quality import quality_rules
from basketmine.llm.simhash import keep_one
from basketmine.llm.substring import remove_repeats


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    return quality_rules(docs.select(*TABLE_COLUMNS)).where("kept").select(*TABLE_COLUMNS)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group: the one with the smallest doc_id."""
    return keep_one(docs.select(*TABLE_COLUMNS)).select(*TABLE_COLUMNS)


def substring_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages that a smaller doc_id holds; one that loses every word goes."""
    done = remove_repeats(docs.select(*TABLE_COLUMNS))
    lost = F.aggregate("ss_removed", F.lit(0).cast("long"), lambda a, s: a + s["stop"] - s["start"])
    return (done.where((lost == 0) | (lost < F.col("ss_n_words")))
            .withColumn("text", F.col("ss_text")).withColumn("n_chars", F.char_length("ss_text").cast("long"))
            .select(*TABLE_COLUMNS))


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any window of a benchmark item."""
    return clean_documents(docs.select(*TABLE_COLUMNS), table(spark, sf_dir, "benchmark")).select(*TABLE_COLUMNS)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token windows of what is left."""
    return pack(docs.select(*TABLE_COLUMNS))


STAGES = [
    ("quality rules", quality_stage),
    ("SimHash near-dedup", near_duplicate_stage),
    ("substring dedup", substring_stage),
    ("benchmark decontamination", decontamination_stage),
    ("packing", packing_stage),
]

#: MCD estimates, SimHash (XXH64) and tokenisation have no SQL form; tests/llm checks the pipeline by brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = stored(docs)
    return docs
