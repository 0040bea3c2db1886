"""From raw documents to shards: five stages, each of them one operator over all that the one before it kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from weeklens.llm import decontaminate, mixing, quality, sharding, simhash
from weeklens.llm.common import table, written


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts; null and empty texts have a score like any other."""
    return quality.good_documents(docs, table(spark, sf_dir, "labels"))


def near_duplicates_dropped(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group: three-word shingles, fingerprints linked at two differing bits or fewer."""
    return simhash.drop_near_duplicates(docs, shingle=3, max_distance=2)


def benchmark_removed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not contaminated by benchmark items; those without words are clean."""
    return decontaminate.decontaminated(docs, table(spark, sf_dir, "benchmark"))


def sources_mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix by target weights reads them; those without words are not read."""
    return mixing.mixed_documents(docs)


def shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Shard and place of every document, repeated rows included."""
    return sharding.sharded(docs)


STAGES = [
    ("quality classifier", good_quality),
    ("SimHash near-dedup", near_duplicates_dropped),
    ("benchmark decontamination", benchmark_removed),
    ("source mix", sources_mixed),
    ("sharding", shards),
]

#: The first stage's scores come from trained weights, which SQL can't express; tests hold the stages to plain loops.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; each result is written to the shared folder and read again.

    An empty table passes through every stage. Columns that a stage doesn't name pass through up to the last stage.
    """
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
