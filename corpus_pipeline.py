"""From raw documents to a mixed training corpus: five stages, each over all that the one before it kept."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from venuelens.llm import decontaminate, mixing, neardup, pii, toxicity
from venuelens.llm.queries import TARGETS, table
from venuelens.llm.storage import keep

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that the multiple-instance model, fitted on the labelled ones, scores 0.7 or more."""
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return toxicity.drop_toxic(docs, model, threshold=0.7)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of exact and near copies: five-word shingles, similarity 0.8 or more."""
    return neardup.drop_near_duplicates(docs, size=5, percent=80)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that hold ten consecutive words of a benchmark item, or a whole shorter item."""
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"), size=10)


def redact_pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data replaced by their kind; n_chars counts the new text."""
    return pii.redact(docs, pii.fit(docs))


def mix_to_targets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with rate and copies that bring the domains' tokens to the target shares.

    The total is the smallest at which no domain has to lose tokens, so documents of scarce domains are repeated and none is
    left out for being of a rich one; what still rounds to no copy leaves.
    """
    labelled = mixing.label_domains(docs, table(spark, sf_dir, "labels"))
    mixed = mixing.mix(docs, labelled, TARGETS, total="no loss").select(F.col("doc_id").alias("_id"), "domain", "rate", "copies")
    # Narrow rows of rates, one per id: repeated ids have equal texts here or share the rates of their own rows.
    mixed = mixed.groupBy("_id").agg(F.first("domain").alias("domain"), F.max("rate").alias("rate"), F.max("copies").alias("copies"))
    return docs.join(mixed, docs["doc_id"].eqNullSafe(mixed["_id"])).where("copies > 0").select(*COLUMNS, "domain", "rate", "copies")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("near_dedup", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("pii", redact_pii),
    ("mixing", mix_to_targets),
]

#: Fitted models and similarity groups are beyond SQL; tests/llm compares run() with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents of `sf_dir` through all stages; each stage is written as Parquet and read again by the next."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = keep(stage(spark, docs, sf_dir))
    return docs
