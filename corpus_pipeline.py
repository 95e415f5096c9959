"""The corpus pipeline: five stages over ``documents``, each written and read again before the next.

Each stage is (spark, docs, sf_dir) -> DataFrame.  All but the last return the columns of documents; the language and quality stages
drop documents, near-dedup leaves one document of each group, substring dedup takes repeated windows out of the texts, and
packing returns the pieces of every document that is left.

Defined cases: a document without a letter, a null or an empty text too, goes at the first stage; equal rows are one document from the
near-dedup stage on, rows of one doc_id with different texts stay apart, and rows without a doc_id are in no group but take part in
all else; a text of any length is worked on whole; further columns, whatever their names, stay until packing, which has columns of
its own; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from forktide.llm.common import written
from forktide.llm.language_id import language_stage
from forktide.llm.near_dedup import near_dedup_stage
from forktide.llm.packing import packing_stage
from forktide.llm.quality import quality_stage
from forktide.llm.substrings import substring_stage

STAGES = [
    ("language ID", language_stage),
    ("quality rules", quality_stage),
    ("MinHash near-dedup", near_dedup_stage),
    ("substring dedup", substring_stage),
    ("packing", packing_stage),
]

#: The learned and packing stages have no SQL; the tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
