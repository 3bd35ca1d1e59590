"""The corpus pipeline: five stages over ``documents``, each usable on its own.

Every function takes (spark, docs, sf_dir) and returns a DataFrame; all but the last keep the
columns of their input, whatever they are, and its rows but for those they reject:

1. toxicity: rows that score 0.5 or more go. The model learns from all of ``labels``.
2. simhash: of each component of near copies (Jaccard of 5-word shingles 0.8 or more, every pair
   found; op8 keeps its 4-bit SimHash links) the row with the smallest doc_id stays.
3. decontamination: rows that hold a benchmark item go.
4. secrets: found secrets are replaced in the text (``n_chars`` follows), no row goes.
5. sentencepiece: (doc_id, ids, n_tokens, decoded); ``decoded`` is the text the ids give back.

Null texts count as empty and, like empty tables, pass every stage.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lognorm.llm.common import table
from lognorm.llm.decontaminate import decontaminated
from lognorm.llm.near_copies import deduplicated
from lognorm.llm.secret_scan import REPLACEMENT, redacted
from lognorm.llm.sentencepiece_codec import encoded
from lognorm.llm.toxicity import train, without_toxic
from lognorm.session import scratch_folder

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return without_toxic(docs, train(docs, table(spark, sf_dir, "labels"), held_out=None))


def simhash(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return deduplicated(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminated(docs, table(spark, sf_dir, "benchmark"))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    out = redacted(docs)
    if "n_chars" not in out.columns:
        return out
    changed = F.contains(F.col("text"), F.lit(REPLACEMENT))
    return out.withColumn("n_chars", F.when(changed, F.length("text")).otherwise(F.col("n_chars")).cast(docs.schema["n_chars"].dataType))


def sentencepiece(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return encoded(docs, decode=True)


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", toxicity), ("simhash", simhash), ("decontamination", decontamination), ("secrets", secrets),
    ("sentencepiece", sentencepiece),
]

#: Toxicity scores and XXH64 fingerprints have no SQL form; tests compare with a plain version.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    folder = scratch_folder(spark, "corpus-pipeline")
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return docs
