"""The training-data pipeline: filters, near-duplicates, decontamination, mixing, token files.

Each stage takes the documents that the one before it kept and returns the
same columns; the last writes the token files and returns what it reads back
from them.  Between stages the documents are written to the shared folder and
read again, so a stage never reruns the ones before it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from fundscope.llm import decontaminate, mixing, queries, simhash, toxicity
from fundscope.llm.storage import stored


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity classifier rejects go."""
    return toxicity.drop_toxic(docs, queries.toxic_model(docs, _table(spark, sf_dir, "labels")))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component stays."""
    return simhash.drop_near_duplicates(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with benchmark passages go."""
    return decontaminate.drop_contaminated(docs, _table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents by target weights: once for each epoch that takes them, cut where a budget ends."""
    mixed = mixing.trim_to_taken(queries.mixed_documents(docs), "text", "n_chars" if "n_chars" in docs.columns else None)
    return mixed.select(docs.columns)


def write_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files in the order of the ids; per row: doc_id, start, n_tokens, ids_crc32, read back from them."""
    return queries.encoded_documents(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash_near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("mixing", mix_sources),
    ("token_files", write_tokens),
]

# Trained scores, fuzzy hashes and tokenizer ids: not SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
