"""The stages of the corpus pipeline. Each takes (spark, docs, sf_dir) and works on
all that the stage before it kept; all but the last return the columns of docs."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkloom.llm import common, decontaminate, packing, pii, shingles, simhash, toxicity
from sparkloom.llm.common import table, written

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

TOXIC = 0.3


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity is under the threshold. The lexicon is learned from
    the labelled rows of the documents that come in."""
    model = toxicity.learn(docs, table(spark, sf_dir, "labels"))
    return docs.where(toxicity.toxicity_score(model) < TOXIC)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component: that with the smallest id. Documents are
    linked by SimHash (op10's contract) and by a five-word similarity of 0.8. Rows
    without an id stay; rows that repeat an id stay or go together."""
    found = simhash.near_duplicates(docs)
    alike = found.where("doc_id <> component_id").select(F.col("component_id").alias("u"), F.col("doc_id").alias("v"))
    edges = alike.union(shingles.links(docs)).distinct()
    gone = written(simhash.components(edges).where("node <> label").select(F.col("node").alias("doc_id")), "copies")
    return docs.join(gone, "doc_id", "left_anti").select(*docs.columns)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark passage."""
    return decontaminate.uncontaminated(docs, table(spark, sf_dir, "benchmark"))


def replace_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data becomes pseudonyms of the same length and format."""
    made = docs.withColumn("text", pii.pseudonymise("text", pii.key_of(spark)))
    if "n_chars" in docs.columns:
        made = made.withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(F.char_length("text").cast(docs.schema["n_chars"].dataType)))
    return made


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the documents and their places in sequences of 1024 tokens."""
    return packing.packed(docs)


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("pseudonyms", replace_personal_data),
    ("packing", pack),
]


def run_stages(spark: SparkSession, sf_dir: str, stages: list[tuple[str, Stage]] = STAGES) -> DataFrame:
    """The stages over the whole documents table, each written and read again."""
    docs, made = table(spark, sf_dir, "documents"), common.count()
    for name, stage in stages:
        path = common.new_folder(spark, name)
        docs = common.written_at(stage(spark, docs, sf_dir), path)
        # A stage reads the one before it and its own tables, which are done with now.
        common.clear(spark, made, keep=(path,))
    return docs
