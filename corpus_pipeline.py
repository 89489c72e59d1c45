"""Training corpus: toxicity, near duplicates, benchmark leaks, mixing, token ids.

Each stage is one operator of docketry.llm over all that the stage before kept; its result
is written and read again before the next. All but the last return the columns of
documents. Rows without a doc_id are dropped by the first stage. Null and empty texts pass
the first three stages (no two of them are linked), and have no tokens to be drawn by. An
empty table gives no rows; other columns, whatever their names, stay as they are.
"""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from docketry.llm import decontaminate, jaccard_join, mixing, token_codec, toxicity
from docketry.llm.common import cut, fresh, named, shared_dir, table


def clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not reject."""
    score = fresh(docs, "toxicity")
    return toxicity.with_score(docs, table(spark, sf_dir, "labels"), score).where(F.col(score) < 0.5).drop(score)


def distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked documents the one with the lowest doc_id, as one row: of several the one with the lowest text."""
    keep = jaccard_join.jaccard_components(docs).where("doc_id = component_id").select("doc_id")
    kept = docs.join(keep, "doc_id", "left_semi")
    repeated = docs.groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1").select("doc_id")  # ids, no texts
    rank = fresh(docs, "rank")
    several = kept.join(repeated, "doc_id", "left_semi").withColumn(rank, F.row_number().over(Window.partitionBy("doc_id").orderBy("text"))).where(F.col(rank) == 1).drop(rank)
    return kept.join(repeated, "doc_id", "left_anti").unionByName(several).select(named(docs))


def uncontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    # ids alone, written first: their size is known then, and few of them are broadcast, so that no text is shuffled
    held = cut(decontaminate.contamination(docs, table(spark, sf_dir, "benchmark")).select("doc_id").distinct(), "held")
    return docs.join(held, "doc_id", "left_anti").select(named(docs))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A sample whose tokens follow the target weights."""
    return mixing.sampled_documents(docs)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The index of the written token files, read back from them."""
    return token_codec.token_ids(docs, public_tokenizers.path(token_codec.VOCABULARY))


STAGES = [
    ("toxicity", clean),
    ("jaccard_join", distinct),
    ("decontamination", uncontaminated),
    ("mixing", mixed),
    ("token_ids", token_ids),
]

#: Learning, components and coding cannot be written in SQL: tested against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = f"{shared_dir(spark)}/pipeline-{uuid.uuid4().hex}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
