"""The corpus pipeline: toxicity, near duplicates, decontamination, mixing, sharding.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; it is written as
Parquet and read again as the next stage's ``docs``.

Null and empty texts are clean, have no near copies, hold no benchmark item and have size 0,
so they pass to the mix, which takes them with their source's whole epochs. Rows equal in id
and text are one document: one of them stays. Rows that share an id but not their text are
different documents, each judged by itself; rows without an id stay unless they are toxic or
leaked. Empty tables give an empty result. The last stage carries text, lang and source.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from hearth.session import stage


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model does not reject; it learns from those here that are labelled.
    Without labels of both classes nothing is rejected."""
    from hearth.llm.toxicity import drop_toxic
    return drop_toxic(docs, _table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that with the smallest id (then hash of the text), of each group of near copies."""
    from hearth.llm.ngram_jaccard import one_of_each_group
    return one_of_each_group(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    from hearth.llm.decontamination import drop_leaked
    return drop_leaked(docs, _table(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated to the sources' target weights."""
    from hearth.llm.mixing import mixed
    return mixed(docs)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every remaining row's shard and slot, with its text."""
    from hearth.llm.sharding import shard_documents
    return shard_documents(docs, 24, carry=("text", "lang", "source"))


STAGES = [("toxicity", toxicity), ("ngram_jaccard", near_duplicates), ("decontamination", decontaminate),
          ("mixing", mix), ("sharding", shard)]

# SQL cannot express the toxicity stage; tests hold the pipeline against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for k, (name, apply) in enumerate(STAGES):
        docs = apply(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = stage(docs, f"pipeline_{name}")
    return docs
