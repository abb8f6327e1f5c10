"""From raw documents to token files in five stages.

Each stage takes all rows that the one before it kept and is written as Parquet to
the shared folder before the next one reads it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from faultline.llm import decontamination, gam, mixing, near_duplicates, token_files
from faultline.llm.common import table
from faultline.session import cut_lineage

ORACLE_SQL = None  # a fitted model decides in the first stage


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts."""
    return gam.keep_quality(docs, table(spark, sf_dir, "labels"))


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return near_duplicates.keep_first(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark item."""
    return decontamination.clean(docs, table(spark, sf_dir, "benchmark"), short=True)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row for each copy of a document that the mix of sources takes."""
    used = ["doc_id", "text", "source"]
    others = F.struct(F.lit(0).alias("_"), *[F.col(f"`{c}`") for c in docs.columns if c not in used]).alias("_others")
    drawn = mixing.draw_mix(mixing.plan_mix(docs.select(*used, others), whole=True))
    return drawn.select(*[F.col(c if c in used else f"_others.`{c}`") for c in docs.columns])


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The copies as they stand in the token files."""
    return token_files.round_trip(docs)


STAGES = [
    ("quality", quality), ("near_duplicates", one_of_each), ("decontaminate", decontaminate), ("mix", mix), ("tokens", tokens),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = cut_lineage(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
