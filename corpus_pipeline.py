"""From raw documents to packed training sequences.

Five stages, each a function of (spark, docs, sf_dir); the result of one is written as Parquet and
read again as the next one's documents.  All but the last return the columns of documents; an
empty table passes through every stage.  Stages count rows by their place in the table they
read, so repeated rows and missing ids are told apart.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sessionloom.llm import decontamination, jaccard_join, packing, pii, quality
from sessionloom.llm.shipping import ship_package
from sessionloom.workspace import materialize, removing_tables


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the cascade keeps."""
    ship_package(spark)
    # Measures are kept apart from columns of the same name.
    columns = {f"__{k}": name for k, name in enumerate(docs.columns)}
    renamed = docs.select(*[F.col(f"`{name}`").alias(k) for k, name in columns.items()])
    text = next(k for k, name in columns.items() if name == "text")
    judged = quality.judge(renamed, list(columns), text=text)
    return judged.where("kept").select(*[F.col(k).alias(name) for k, name in columns.items()])


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates."""
    ship_package(spark)
    return jaccard_join.one_of_each_class(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain no benchmark item."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontamination.without_contaminated(docs, benchmark)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with surrogates for personal data; n_chars follows the text."""
    replaced = pii.replace_entities(docs, pii.DEFAULT_KEY)
    replaced = replaced.select(*[f"`{name}`" for name in docs.columns])
    if "n_chars" in docs.columns:
        replaced = replaced.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return replaced


def sequence_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of training sequences, with their ids."""
    ship_package(spark)
    return packing.pack(docs, with_ids=True)


STAGES = [
    ("quality rules", quality_rules),
    ("n-gram Jaccard join", near_duplicates),
    ("benchmark decontamination", benchmark_decontamination),
    ("PII", personal_data),
    ("packing", sequence_packing),
]

#: Surrogates and token ids are not expressible in SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The result of all stages; tables of a stage are removed when the next one has been written."""
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES:
        with removing_tables(spark) as made:
            docs = materialize(stage(spark, docs, sf_dir), name.replace(" ", "-"))
            written = made.pop()
            if before:
                made.append(before)
            before = written
    return docs
