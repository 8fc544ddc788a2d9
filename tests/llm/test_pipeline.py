"""The pipeline's decisions, stage by stage, against plain-Python versions."""

import corpus_pipeline
from strata.llm import rules, secrets
from strata.llm.common import documents
from tests.llm import brute

SF = "/root/testdata/sf0.001"


def test_stages(spark, tmp_path):
    docs = documents(spark, SF)
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF)
        out.write.parquet(path := f"{tmp_path}/{name.replace(' ', '-')}")
        before = {r["doc_id"]: r["text"] for r in docs.collect()}
        after = spark.read.parquet(path)
        if stage is corpus_pipeline.pack:
            assert {r["doc_id"] for r in after.select("doc_id").distinct().collect()} == set(before)
            break
        got = {r["doc_id"]: r["text"] for r in after.collect()}
        assert after.columns == list(corpus_pipeline.COLUMNS)
        assert all(r["n_chars"] == len(r["text"]) for r in after.collect())
        if stage is corpus_pipeline.quality:
            failed = {i for i, t in before.items() if (c := brute.quality_counts(t))[0] < 50 or 2 * c[4] > c[0]}
            assert not failed & set(got)
        elif stage is corpus_pipeline.near_duplicates:
            assert set(got) == {i for i, (_, c) in brute.near_duplicate_rows(before.items(), 5).items() if i == c}
        elif stage is corpus_pipeline.repeated_passages:
            want = brute.repeat_rows(before.items())
            assert set(got) == {i for i, (n, gone, _) in want.items() if n > gone or n == 0}
            assert all(brute.sha(" ".join(brute.WORD.findall(t))) == want[i][2] for i, t in got.items())
        else:
            assert set(got) == set(before)
            assert all((got[i] == t) == (not brute.base_spans(t)) or len(secrets.MORE) for i, t in before.items())
            assert not any(brute.base_spans(t) for t in got.values())
        docs = after


def test_run(spark):
    assert corpus_pipeline.run(spark, SF).count() > 0
    assert [f.__name__ for _, f in corpus_pipeline.STAGES] == \
        ["quality", "near_duplicates", "repeated_passages", "secret_scan", "pack"]
    assert rules.MOST_TESTS == 3
