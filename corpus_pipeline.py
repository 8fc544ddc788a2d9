"""The corpus pipeline: five stages over ``documents``, each one operator of strata.llm.

STAGES lists (name, function); a function takes (spark, docs, sf_dir) and
returns a DataFrame, written as Parquet and read again as the next one's docs.
All but the last return the columns of documents. Near duplicates are judged
on five-word shingles at a similarity of 0.8.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from strata.llm import minhash, packing, rlz, rules, secrets
from strata.llm.common import documents, land
from strata.llm.queries import tokenizer_file
from strata.session import sf_path

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules or the learned decision list reject go."""
    labels = spark.read.parquet(sf_path(sf_dir, "labels"))
    return rules.keep_learned(docs, labels)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group stays."""
    return minhash.dedupe(docs, shingle=5, percent=80)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages with an earlier copy are cut; a document wholly cut goes."""
    return rlz.remove_repeats(docs)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are masked; a ledger that the session keeps (``secrets.LEDGER_CONF``) spares known texts."""
    return secrets.redact(docs, ledger=secrets.run_ledger(spark))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of training sequences, with their token ids."""
    return packing.pack(docs, tokenizer_file("word_bpe_49k.json"))


STAGES = [
    ("quality rules", quality),
    ("near duplicates", near_duplicates),
    ("repeated passages", repeated_passages),
    ("secret scan", secret_scan),
    ("packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows over the documents of ``sf_dir``."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = land(stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return STAGES[-1][1](spark, docs, sf_dir)


#: Tokenising and packing can't be stated in SQL; tests/llm/test_pipeline.py holds the run against brute force.
ORACLE_SQL = None
