"""A corpus pipeline over ``documents``: five stages, each one operator of ``gatehouse.llm``.

Each stage takes (spark, docs, sf_dir), with ``docs`` what the stage before it
kept, and returns a DataFrame that is written as Parquet and read again for the
next stage. Null texts, empty tables, repeated rows and further columns are
handled as the operators say.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gatehouse.llm import entropy_mix, prefix_bpe, secrets_battery, simhash_bk, toxicity_cnn
from gatehouse.llm.common import table, written

RANKS = "byte_bpe_multi_50k.tiktoken"


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier calls toxic go; it learns from the labels of ``docs``."""
    model = toxicity_cnn.train(docs, table(spark, sf_dir, "labels"))
    scored = toxicity_cnn.score(docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"), "text"),
                                model, carry=["row"])
    return scored.where("score < 0.5").select("row.*")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component stays, the one of the smallest id."""
    return simhash_bk.keep_one(docs)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are masked; ``n_chars`` follows the new text."""
    clean = secrets_battery.redact(docs)
    if "n_chars" not in docs.columns:
        return clean
    kind = docs.schema["n_chars"].dataType
    return clean.withColumn("n_chars", F.length("text").cast(kind))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources reach their target weights: a document stays 0, 1 or 2 times."""
    return entropy_mix.mix(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, source, n_tokens, ids) of every document."""
    import public_tokenizers
    ids = prefix_bpe.encode(docs, public_tokenizers.path(RANKS), public_tokenizers.PATTERN,
                            carry=["doc_id", "source"])
    return ids.select("doc_id", "source", F.size("ids").cast("bigint").alias("n_tokens"), "ids")


STAGES = [
    ("toxicity", toxicity),
    ("simhash_near_dedup", near_duplicates),
    ("secret_scan", secrets),
    ("mixing", mixing),
    ("bpe_tokens", tokens),
]

# The classifier, the fingerprints and the encoder cannot be written in SQL;
# tests/llm checks the pipeline against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``; the last one's rows."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
