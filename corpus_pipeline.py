"""From raw documents to a training mix, in five stages.

Each stage takes the documents its predecessor kept and returns those that it keeps, with
the columns of ``documents``; the last one adds what the mix takes of each. Stages with
models learn them from their own input. ``run`` writes each stage's result to the shared
folder and reads it back, so a lost executor repeats one stage at most.

Nulls: texts that are null or have no letter are unknown in language and go in the first
stage. Null or repeated ids are allowed; near-duplicates are then told apart by row.
Input columns named like those the mix adds are replaced.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trilayer.llm import decontaminate, language, mixing, near_dup, quality_fm
from trilayer.operators.joins import broadcast_if_small
from trilayer.sources.raw import table
from trilayer.workspace import written


def _kept(docs: DataFrame, judge: Callable[[DataFrame], DataFrame], condition: str) -> DataFrame:
    """Rows of ``docs`` that meet a condition on what ``judge`` adds; columns of ``docs``
    have other names meanwhile, so that none is replaced."""
    aside = {name: f"pipeline_{name}" for name in docs.columns if name != "text"}
    found = judge(docs.withColumnsRenamed(aside)).filter(condition)
    return found.select(*[F.col(aside.get(name, name)).alias(name) for name in docs.columns])


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language the models recognise."""
    models = language.learn(docs)
    return _kept(docs, lambda rows: language.identify(rows, models), "NOT rejected")


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the factorisation machine predicts to be good."""
    machine = quality_fm.learn(docs, table(spark, sf_dir, "labels"))
    return _kept(docs, lambda rows: quality_fm.classify(rows, machine), "predicted = 1")


def _without(docs: DataFrame, find) -> DataFrame:
    """``docs`` but for the rows whose key is in ``find(docs, key)``. The key is the id, or a
    number of the row where ids are null or repeated."""
    columns, key = docs.columns, "doc_id"
    rows, ids = docs.agg(F.count("*"), F.count_distinct("doc_id")).first()
    if rows != ids:
        key = "pipeline_row"
        docs = written(docs.withColumn(key, F.monotonically_increasing_id()), "pipeline-rows")
    others = written(find(docs, key).select(key), "pipeline-others")
    return docs.join(broadcast_if_small(others), key, "left_anti").select(columns)


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: the smallest id, or any row where
    ids are null or repeated."""
    return _without(
        docs, lambda rows, key: near_dup.near_duplicates(rows, key).filter(~F.col("kept")))


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any window of a benchmark item."""
    items = table(spark, sf_dir, "benchmark")
    return _without(docs, lambda rows, key: decontaminate.decontaminate(
        rows, items, key).filter("contaminated"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the mix takes, with size, source_size, target and taken words."""
    return mixing.mix(docs).filter("taken > 0")


STAGES = [
    ("language", known_language),
    ("quality", good_quality),
    ("near_duplicates", one_of_each),
    ("decontamination", decontaminated),
    ("mixing", mixed),
]

#: No SQL: learned models and sketches are tested against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
