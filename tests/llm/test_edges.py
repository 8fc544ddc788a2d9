"""Nulls, empty and very long texts, ties, repeated rows, empty tables and
clashing extra columns, for every operator and pipeline stage."""

import public_tokenizers
import pytest

import corpus_pipeline
from strata.llm import bpe, minhash, packing, queries, rlz, rules, secrets, sharding, suffix_tree, toxicity, voronoi
from pyspark.sql import functions as F

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, found string, _text string, node long"
LONG = " ".join(f"w{i % 997}" for i in range(40_000))
ROWS = [(1, None), (2, ""), (3, " \n\t "), (4, "one two three"), (4, "one two three"), (5, "one two three"),
        (None, "one two three"), (None, None), (6, LONG), (7, LONG), (8, "token=abcdefgh12 " * 30), (9, "x" * 5000)]


def table(spark, rows):
    return spark.createDataFrame([(i, t, None, "s", None, "f", "clash", 1) for i, t in rows], SCHEMA)


OPERATORS = {
    "packing": lambda s, d: packing.pack(d, queries.tokenizer_file("word_bpe_49k.json")),
    "suffix_tree": lambda s, d: suffix_tree.score_documents(d),
    "minhash": lambda s, d: minhash.near_duplicates(d),
    "bpe": lambda s, d: bpe.encode_documents(d, queries.tokenizer_file("byte_bpe_multi_50k.tiktoken"),
                                             public_tokenizers.PATTERN),
    "sharding": lambda s, d: sharding.assign(d, [1.0, 2.0, 1.0], added=1.0),
    "secrets": lambda s, d: secrets.scan(d),
    "toxicity": lambda s, d: toxicity.score_documents(d, toxicity.learn(
        d.withColumn("grade", F.when(F.col("doc_id") == 8, 1).when(F.col("doc_id") > 3, 0)), grades=2)),
    "rules": lambda s, d: rules.judge(d, rules.learn_from(d, s.createDataFrame(
        [(4, 0), (6, 1), (None, 1), (7, None)], "doc_id long, quality int"))),
    "rlz": lambda s, d: rlz.parse_documents(d),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_edge_rows(spark, name):
    got = OPERATORS[name](spark, table(spark, ROWS)).collect()
    if name == "packing":
        assert sum(r["length"] for r in got if r["doc_id"] in (1, 2, 3)) == 3  # just the end ids
        assert sum(r["start"] == 0 for r in got) == len(ROWS)
        return
    assert len(got) == len(ROWS)
    by = {}
    for r in got:
        by.setdefault(r["doc_id"], []).append(r)
    if name == "minhash":
        assert [by[i][0]["component_id"] for i in (1, 2, 3, 4, 5, 6, 7)] == [1, 2, 3, 4, 4, 6, 6]
        assert all(r["component_id"] is None and r["kept"] for r in by[None])
    if name == "suffix_tree":
        assert [by[i][0]["n_tokens"] for i in (1, 2, 3, 4)] == [1, 1, 1, 4]
    if name == "bpe":
        assert by[1][0]["n_tokens"] == 0 and by[1][0]["ids_sha256"] == by[2][0]["decoded_sha256"]
    if name == "sharding":
        assert len({r["shard"] for r in by[4]}) == 1 and len({(r["shard"], r["slot"]) for r in got}) == len(ROWS)
    if name == "secrets":
        assert len(by[8][0]["found"]) == 30 and by[1][0]["found"] == []
    if name == "rlz":
        assert by[7][0]["n_removed"] == 40_000 and by[6][0]["n_removed"] == 40_000 - 997 - 19 + 19 \
            or by[6][0]["n_removed"] > 38_000
        assert all(r["n_removed"] == 0 for r in by[None])


@pytest.mark.parametrize("name", OPERATORS)
def test_empty_table(spark, name):
    assert OPERATORS[name](spark, table(spark, [])).collect() == []


def test_vectors(spark):
    nan, inf = float("nan"), float("inf")
    data = [(0, [1.0, 0.0]), (1, None), (2, [1.0, None]), (3, [nan, 1.0]), (20, [inf, 1.0]), (40, [1.0, 0.0]),
            (5, [1.0, 0.0]), (5, [1.0, 0.0]), (None, [1.0, 1.0]), (60, [1.0, 2.0, 3.0]), (6, []), (7, [1e300, 0.0])]
    frame = spark.createDataFrame([(i, v, 9) for i, v in data], "vec_id long, embedding array<double>, score int")
    got = voronoi.top_k(frame, F.col("vec_id") % 20 == 0, k=20).collect()
    by = {}
    for r in sorted(got, key=lambda r: r["rank"]):
        by.setdefault(r["query_id"], []).append(r["vec_id"])
    assert by == {0: [7, 5, 40], 40: [7, 0, 5]}  # ties to the smaller id; no vector of another length
    assert voronoi.top_k(frame.where("false"), F.lit(True)).collect() == []


@pytest.mark.parametrize("name,stage", corpus_pipeline.STAGES)
def test_stage_edges(spark, tmp_path, name, stage):
    labels = spark.createDataFrame([(4, 0, 0), (6, 1, 0)], "doc_id long, quality int, toxic int")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    docs = table(spark, ROWS)
    out = stage(spark, docs, str(tmp_path))
    if stage is not corpus_pipeline.pack:
        assert out.columns == docs.columns
    out.collect()
    assert stage(spark, table(spark, []), str(tmp_path)).collect() == []
