"""The corpus pipeline: raw documents to packed training sequences.

Every stage takes (spark, docs, sf_dir), where ``docs`` is a stored table with
the columns of ``documents``, and works on all of it: quality classifier,
exact dedup, near-duplicates, mixing of sources, packing. All but the last
return documents; the last returns the places of their pieces.

Defined results: rows are judged one by one, also where ids are null or
repeat; a null text counts as empty, and the first stage drops texts without a
word; a document that the mix takes twice is there twice; an empty table stays
empty; extra columns are carried along.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tessera.llm import queries
from tessera.llm.common import free_name, numbered, table, written
from tessera.llm.exact import exact_groups
from tessera.llm.mixing import mixed_documents
from tessera.llm.neardup import near_duplicates
from tessera.llm.packing import pack_documents
from tessera.llm.quality import judged

#: SQL cannot express the classifier, the sketches, the draws or the packing.
ORACLE_SQL = None
#: Similarity, in percent, from which texts are near copies; op3 has its own.
NEAR = 80


def _only(docs: DataFrame, rows: DataFrame) -> DataFrame:
    """The rows of a stored table whose numbers are in ``rows`` (row_id)."""
    row = free_name(docs.columns, "corpus_row")
    return numbered(docs, row).join(rows.select(rows["row_id"].alias(row)), row, "left_semi").drop(row)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    labels = table(spark, sf_dir, "labels", "doc_id", "quality", "toxic")
    return _only(docs, judged(docs, labels).where("kept"))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _only(docs, exact_groups(docs).where("kept"))


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _only(docs, near_duplicates(docs, percent=NEAR).where("first"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixed_documents(docs, queries.SOURCE_WEIGHTS)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pack_documents(docs, queries.tokenizer_path())


STAGES = [("quality", quality), ("exact_dedup", exact), ("near_dedup", near), ("mix", mix), ("pack", pack)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``, each stored and read again."""
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
