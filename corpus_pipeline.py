"""The corpus pipeline: quality rules, near duplicates, repeated passages, secrets, packing.

Each stage takes (spark, docs, sf_dir) and works on all rows that the one before it kept.
All but the last return the columns of ``docs``; where a stage changes texts, ``n_chars``
follows if there is such a column.

quality     rows that the base rules or the forest reject go
near        one row of each class of near duplicates stays, the one with the smallest doc_id
passages    strings of 200 bytes that occur elsewhere are taken out of the texts; no row goes
secrets     secrets in the texts are masked; no row goes
packing     the pieces of all documents with their sequence and offset

Null texts fail the base rules; an empty table stays empty through all stages.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallymark.llm import packing, quality, secret_models, secrets, similarity, suffixes
from tallymark.llm.common import table
from tallymark.session import work_path


def _counted(docs: DataFrame) -> DataFrame:
    return docs.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else docs


def quality_stage(spark, docs, sf_dir):
    return quality.keep_good(docs, quality.fit(docs, table(spark, sf_dir, "labels")))


def near_stage(spark, docs, sf_dir):
    return similarity.keep_one(docs)


def passage_stage(spark, docs, sf_dir):
    return _counted(suffixes.remove(docs))


def secret_stage(spark, docs, sf_dir):
    return _counted(secrets.redact(docs, secret_models.fit(docs)))


def packing_stage(spark, docs, sf_dir):
    # Workers go on to the stages of a next run, so this one keeps less than the operator alone would, and nothing between tasks.
    return packing.pack(packing.pieces(docs, digest=True, chunks=150_000, forget=True))


STAGES = [
    ("quality", quality_stage),
    ("near", near_stage),
    ("passages", passage_stage),
    ("secrets", secret_stage),
    ("packing", packing_stage),
]

#: Forest, MinHash, suffix index and tokenizer cannot be expressed in SQL.
ORACLE_SQL = None


def run(spark, sf_dir):
    """Apply the stages to ``documents``, each written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = work_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
