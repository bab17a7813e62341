"""From documents to token files: quality, near-duplicates, contamination, mixing, tokens.

Each stage takes (spark, docs, sf_dir), works on all rows its predecessor kept and returns the columns of
its input, but the last, which returns what the token files hold. Null and empty texts, repeated rows and
further columns are treated as the stage's operator says. An empty input gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scorekit.llm import decontam, mixing, nearcopies, quality, simhash, tokens
from scorekit.llm.common import load, python_workers, shared_path, stage
from scorekit.llm.queries import END_ID, KEEP, tokenizer_path, training_labels


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject."""
    python_workers(spark)
    model = quality.fit(docs, training_labels(spark, sf_dir))
    whole = docs.select(F.struct("*").alias("row"), quality.scored(model, docs, F.col("text")).alias("score"))
    return whole.where(F.col("score") >= KEEP).select("row.*")


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near copies: 5-word shingles, Jaccard similarity 0.8 or more. Candidates are the
    classes of fingerprints by distances to pivots, as op7 finds them, and the bands of MinHash; all are confirmed exactly."""
    python_workers(spark)
    return nearcopies.deduplicate(docs, candidates=simhash.classes(docs))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without benchmark contamination."""
    python_workers(spark)
    return decontam.decontaminate(docs, load(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: documents as often as they are taken."""
    return mixing.mix(docs)


def write_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files, read back: doc_id, start, n_tokens, ids_crc32."""
    python_workers(spark)
    contents = tokens.write_token_files(docs, shared_path(spark, "tokens"), tokenizer_path(), END_ID)
    return tokens.read_token_files(contents, ids=False).select("doc_id", F.col("first").alias("start"), "n_tokens", "ids_crc32")


STAGES = [("quality", keep_good), ("near_copies", drop_near_copies), ("decontamination", drop_contaminated),
          ("mixing", mix_sources), ("tokens", write_tokens)]

ORACLE_SQL = None  # the classifier has no SQL; tests compare with a brute-force version


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages applied to ``documents``, each written and read again before the next."""
    docs = load(spark, sf_dir, "documents")
    for name, function in STAGES:
        docs = stage(function(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
