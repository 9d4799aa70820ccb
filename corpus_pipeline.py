"""The corpus pipeline: five stages from raw documents to a weighted training mixture.

Each stage takes ``(spark, docs, sf_dir)``, works on all that the stage
before it kept, and returns a DataFrame that is written as Parquet and read
again as the next stage's ``docs``.  All but the last return the columns of
``documents``; the last adds each document's words, domain, posteriors and
rate (how often the mixture should hold it).
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakebars.llm import decontam, line_dedup, mixing, quality, simhash
from lakebars.llm.common import finished, fresh, prepare, table
from lakebars.session import discard


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Reject documents judged toxic or of low quality (operator 5)."""
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def deduplicate_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop lines that a document with a smaller id holds too (operator 3); ``n_chars`` follows the text."""
    names = {k: fresh(k, docs.columns) for k in ("n_lines", "n_dropped")}
    left = line_dedup.dedup_lines(docs, **names).select(*docs.columns)
    if "n_chars" not in docs.columns:
        return left
    return left.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the first document of each SimHash group (operator 1)."""
    return simhash.drop_near_copies(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Remove documents that hold benchmark passages (operator 8)."""
    return decontam.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def mix_domains(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Fit each document's rate to the domains' target weights (operator 7); rate zero leaves a document out."""
    mixed = mixing.mix(docs, docs)
    return mixed.where(F.col(mixed.columns[-1]) > 0)


STAGES = [
    ("quality", keep_good),
    ("line_dedup", deduplicate_lines),
    ("near_copies", drop_near_copies),
    ("decontamination", decontaminate),
    ("mixing", mix_domains),
]

#: No SQL: the first and last stages fit models, which SQL cannot express.
#: tests/llm checks the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over ``documents``; of all that they write, the last result alone stays in the shared folder."""
    prepare(spark)
    docs, held = spark.read.parquet(os.path.join(sf_dir, "documents.parquet")), None
    for name, stage in STAGES:
        out = finished(spark, lambda stage=stage, docs=docs: stage(spark, docs, sf_dir), f"pipeline-{name}")
        if held is not None:
            discard(held)
        docs = held = out
    return docs
