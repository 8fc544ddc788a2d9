"""Registered queries of the numbered operators, with their production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm import bpe, decontamination, minhash, packing, periodic, product_codes, rlz, rules, secrets, sharding
from strata.llm import suffix_tree, toxicity, voronoi
from strata.llm.common import documents
from strata.session import sf_path

SHARDS = 24


def tokenizer_file(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_cost_balanced_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(documents(spark, sf_dir), tokenizer_file("word_bpe_49k.json"), with_ids=False)


def op2_suffix_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_tree.score_documents(documents(spark, sf_dir))


def op3_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(documents(spark, sf_dir), shingle=4, percent=80)


def op4_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return bpe.encode_documents(documents(spark, sf_dir), tokenizer_file("byte_bpe_multi_50k.tiktoken"),
                                public_tokenizers.PATTERN, with_ids=False)


def op5_rendezvous(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.assign(documents(spark, sf_dir), [1.0] * SHARDS, added=1.0).withColumn("law", F.lit("key"))


def op6_secret_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.scan(documents(spark, sf_dir), ledger=secrets.run_ledger(spark))
    base = F.filter("found", lambda s: s["kind"].isin(*[r.kind for r in secrets.BASE]))
    count = lambda kind: F.size(F.filter("found", lambda s: s["kind"] == kind)).cast("long")
    return found.select("doc_id", count("assign").alias("n_assign"), count("access").alias("n_access"),
                        count("hex").alias("n_hex"), F.sha2(secrets.render(base), 256).alias("base_sha256"),
                        secrets.render(F.col("found")).alias("spans"))


def op7_ordinal_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels know toxic 0 and 1; toxic rows are parted into two severities (``toxicity.severe``)."""
    docs = documents(spark, sf_dir)
    labels = spark.read.parquet(sf_path(sf_dir, "labels")).select("doc_id", F.col("toxic").alias("grade")) \
        .where("grade IS NOT NULL")
    scored = toxicity.score_documents(docs, toxicity.learn(docs, grades=3, labels=labels))
    return scored.withColumn("toxic", F.col("grade") > 0)


def op8_voronoi_knn(spark: SparkSession, sf_dir: str) -> DataFrame:
    return voronoi.top_k(spark.read.parquet(sf_path(sf_dir, "embeddings")), F.col("vec_id") % 20 == 0)


def op9_decision_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    numbers = rules.measured(documents(spark, sf_dir))
    learned = rules.learn_measured(numbers, spark.read.parquet(sf_path(sf_dir, "labels")))
    return rules.judged(numbers, learned).select(F.col("_id").alias("doc_id"), *rules.COUNTS, "base_failed", "kept", "rule")


def op10_relative_lz(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rlz.parse_documents(documents(spark, sf_dir), window=20, with_text=False) \
        .select("doc_id", "n_words", "n_removed", "kept_sha256")


def op11_hilbert_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded, books = product_codes.compress(spark.read.parquet(sf_path(sf_dir, "embeddings")))
    return product_codes.with_label_error(coded).withColumn("codebooks_sha256", F.lit(product_codes.book_digest(books)))


def op12_suffix_arrays(spark: SparkSession, sf_dir: str) -> DataFrame:
    benchmark = spark.read.parquet(sf_path(sf_dir, "benchmark"))
    return decontamination.digest(decontamination.contaminated(documents(spark, sf_dir), benchmark, window=10))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return periodic.digest(periodic.find_runs(docs, text_col=periodic.tail_repeated(), times=4, least=6))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {
    "op1_cost_balanced_packing": op1_cost_balanced_packing,
    "op2_suffix_tree": op2_suffix_tree,
    "op3_minhash": op3_minhash,
    "op4_byte_bpe": op4_byte_bpe,
    "op5_rendezvous": op5_rendezvous,
    "op6_secret_ledger": op6_secret_ledger,
    "op7_ordinal_toxicity": op7_ordinal_toxicity,
    "op8_voronoi_knn": op8_voronoi_knn,
    "op9_decision_list": op9_decision_list,
    "op10_relative_lz": op10_relative_lz,
    "op11_hilbert_codes": op11_hilbert_codes,
    "op12_suffix_arrays": op12_suffix_arrays,
    "op13_periodic_runs": op13_periodic_runs,
    "pipeline": pipeline,
}
