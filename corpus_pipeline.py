"""From raw documents to packed sequences: five stages, each written as Parquet and read again.

A stage's result is stored before the next one starts, so every stage first removes the intermediate tables
that the one before it has left.
"""

from __future__ import annotations

from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from celltide.llm.frames import load, materialize
from celltide.llm.jaccard_join import keep_one
from celltide.llm.line_dedup import without_lines
from celltide.llm.mixing import mixed
from celltide.llm.packing import pack
from celltide.llm.quality import accepted
from celltide.session import drop_scratch, scratch_paths, small_batches

_left: list[str] = []  # intermediate tables of the last stage


def staged(stage):
    """The stage, without what the one before it needed no longer."""
    @wraps(stage)
    def fn(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        small_batches(spark)
        drop_scratch(spark, _left)
        before = set(scratch_paths())
        out = stage(spark, docs, sf_dir)
        _left[:] = [p for p in scratch_paths() if p not in before]
        return out

    return fn


@staged
def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject."""
    return accepted(docs, load(spark, sf_dir, "labels"))


@staged
def without_boilerplate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that a large share of a source's documents have are gone; n_chars is that of the rest."""
    return without_lines(docs).withColumn("n_chars", F.length("text").cast("bigint"))


@staged
def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return keep_one(docs)


@staged
def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, those of small sources repeated up to the limit."""
    return mixed(docs)


@staged
def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces in sequences."""
    return pack(docs)


STAGES = [
    ("quality classifier", good_documents),
    ("line dedup", without_boilerplate),
    ("n-gram Jaccard join", without_near_copies),
    ("mixing sources to target weights", mixture),
    ("best-fit packing", sequences),
]

# Learned scores have no form in SQL; the tests hold the stages against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, from the documents on."""
    docs = load(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
