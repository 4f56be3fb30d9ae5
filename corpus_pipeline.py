"""The corpus pipeline: language, near copies, personal data, source mix, packing.

Every stage applies one operator with production parameters to all that the stage before kept. All but the
last return the columns of the documents. An empty table passes through all stages; null texts go in the first;
rows that repeat one text are near copies, of which one stays; very long texts are read whole; columns besides
those of the documents are kept as they are until the last stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from riskloom.llm import chosenpath, disclosure, languages, packing, pareto


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a learned language go: null and empty texts, texts without a letter."""
    names, model = languages.train(docs.where(~languages.held_out()), docs["lang"])
    return languages.accepted(docs, names, model)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near copies stays."""
    return chosenpath.one_per_class(docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data and the terms that give it away are replaced in the texts."""
    return disclosure.sanitise(docs)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents are left out or taken once or twice, as the sources' weights ask."""
    return pareto.mixed(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every piece of every document gets its training sequence."""
    return packing.best_fit(docs)


STAGES = [("language_id", language_id), ("near_copies", near_copies), ("personal_data", personal_data), ("source_mix", source_mix), ("packing", packed)]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
    return docs
