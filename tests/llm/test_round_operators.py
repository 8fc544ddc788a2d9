"""Vector codes, benchmark decontamination and periodic runs against plain Python."""

import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from strata.llm import decontamination, periodic, product_codes, rules, toxicity
from strata.llm.common import documents
from tests.llm import brute

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, spans int, items string, _text string, n_words int, runs int"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, 1, "x", "clash", 2, 3) for i, t in rows], DOCS)


def some_text(rng, letters, n):
    return " ".join(rng.choice(letters) for _ in range(rng.randint(0, n)))


# -- vector codes -------------------------------------------------------------------


def test_codes_equal_plain_python(spark):
    rng = np.random.default_rng(5)
    rows = [(int(i), [float(x) for x in rng.normal(size=32)]) for i in rng.permutation(150)]
    rows += [(7, rows[0][1]), (7, rows[0][1])]  # ties and repeated ids
    want, books = brute.product_codes(rows)
    table = spark.createDataFrame([(i, v, i % 3, 9) for i, v in rows], "vec_id long, embedding array<double>, label int, error int")
    coded, got = product_codes.compress(table)
    assert got.tolist() == books
    out = product_codes.with_label_error(coded).collect()
    assert sorted((r["vec_id"], r["code"], r["error"]) for r in out) == sorted(want)
    by = {}
    for i, _, e in want:
        by[i % 3] = by.get(i % 3, 0) + e
    assert all(r["label_error"] == by[r["vec_id"] % 3] for r in out)


def test_codes_of_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    v = lambda x: [x] * 16
    rows = [(3, v(0.5), None), (1, v(0.25), None), (1, v(0.25), 4), (None, v(9.0), 4), (5, None, 1), (6, v(nan), 1),
            (8, v(1.0)[:15] + [None], 1), (9, v(-inf), 1), (10, [1.0] * 32, 2), (11, [], 2), (12, [1.0], 2),
            (13, v(1e300), 5)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    coded, books = product_codes.compress(table, entries=2, rounds=0)
    assert books[:, :, 0].tolist() == [[64, 64]] * 16  # the smallest ids; 1 stands twice
    got = {(r["id"], r["label"]): r for r in coded.collect()}
    assert set(got) == {(3, None), (1, None), (1, 4), (None, 4), (10, 2), (11, 2), (12, 2), (13, 5)}
    far, top = 16 * (9 * 256 - 64) ** 2, (1 << 63) - 1
    assert got[10, 2]["code"] is None  # another length
    sums = {(r["vec_id"], r["error"], r["label_error"]) for r in product_codes.with_label_error(coded).collect()}
    assert sums == {(3, 16 * 64 ** 2, 16 * 64 ** 2), (1, 0, 16 * 64 ** 2), (1, 0, far), (None, far, far), (10, None, 0),
                    (11, None, 0), (12, None, 0), (13, top, top)}  # sums saturate
    assert product_codes.compress(table.where("false"))[0].collect() == []


def test_shortlists_keep_every_nearest_entry():
    rng = np.random.default_rng(2)
    for most in (2, 40, 1 << 30, 1 << 61):
        points = rng.integers(-most, most, size=(700, 4))
        entries = points[:40].copy()
        points = points[np.argsort(product_codes.hilbert_keys(points), kind="stable")]
        blocks = product_codes.Blocks(points)
        d = ((points.astype(object)[:, None] - entries.astype(object)[None]) ** 2).sum(axis=2)
        want = np.array([int(np.argmin(r)) for r in d])
        for row, best, distance in blocks.nearest(entries):
            assert (best == want[row]).all() and (distance == d[row, best]).all()
        total, count = blocks.totals(entries)
        assert (count == np.bincount(want, minlength=40)).all()
        assert all((total[e] == points.astype(object)[want == e].sum(axis=0)).all() for e in np.unique(want))


# -- decontamination ------------------------------------------------------------------


def test_decontamination_equals_plain_python(spark, monkeypatch):
    rng = random.Random(4)
    docs = [(i, some_text(rng, "abcd" if i % 2 else "abÄÖ1", 60)) for i in range(60)]
    items = [(i % 17, some_text(rng, "abcÄ", 12)) for i in range(25)]
    items += [(99, None), (100, " -- "), (None, "d d d a"), (101, "zz")]
    want = brute.leak_rows(docs, items, 4)
    table, test = frame(spark, docs), spark.createDataFrame(items, "item_id long, text string")

    def check():
        got = {r["doc_id"]: r for r in decontamination.contaminated(table, test, window=4).collect()}
        for i, (n, hit, names) in want.items():
            r = got[i]
            assert (r["n_words"], sum(s["length"] for s in r["spans"]), r["items"]) == (n, hit, names)
            assert r["contaminated"] == (hit > 0)
        clean = decontamination.remove(table, test, window=4)
        assert clean.columns == table.columns
        assert {r["doc_id"] for r in clean.collect()} == {i for i, w in want.items() if not w[1]}

    check()
    monkeypatch.setattr(decontamination, "BLOCK_WORDS", 40)  # several passes
    monkeypatch.setattr(decontamination, "PIECE", 6)  # items cut into overlapping pieces
    check()


def test_longest_matches(spark):
    docs = [(5, "x a b c d e y"), (2, "a b c d"), (9, "q a b c d e f"), (None, None)]
    test = spark.createDataFrame([(1, "A b, c d e! g")], "item_id long, text string")
    got = {r["item_start"]: (r["length"], r["doc_id"], r["start"])
           for r in decontamination.longest_matches(frame(spark, docs), test).collect()}
    assert got == {0: (5, 5, 1), 1: (4, 5, 2), 2: (3, 5, 3), 3: (2, 5, 4), 4: (1, 5, 5)}


def test_decontamination_edges(spark):
    long = " ".join(f"w{i % 997}" for i in range(40_000))
    test = spark.createDataFrame([(1, "one two"), (2, "w1 w2 w3 w4 w5 w6 w7 w8 w9 w10 w11")], "item_id long, text string")
    docs = frame(spark, [(1, None), (2, ""), (3, "One-two"), (3, "One-two"), (None, "one one two"), (6, long)])
    out = decontamination.digest(decontamination.contaminated(docs, test)).collect()
    got = sorted((str(r["doc_id"]), r["n_words"], r["n_hit"], r["n_items"]) for r in out)
    assert got == sorted([("1", 0, 0, 0), ("2", 0, 0, 0), ("3", 2, 2, 1), ("3", 2, 2, 1), ("None", 3, 2, 1),
                          ("6", 40_000, 11 * (40_000 // 997 + 1) - 0, 1)])
    assert decontamination.contaminated(docs.where("false"), test).collect() == []
    none = decontamination.contaminated(docs, test.where("false")).collect()
    assert len(none) == 6 and not any(r["contaminated"] for r in none)
    assert len(decontamination.remove(docs, test.where("false")).collect()) == 6


# -- periodic runs ----------------------------------------------------------------------


def test_runs_equal_plain_python():
    rng = random.Random(1)
    for _ in range(400):
        docs = []
        for _ in range(rng.randint(1, 4)):
            w = []
            for _ in range(rng.randint(0, 5)):
                p = [rng.randint(0, rng.choice([1, 2, 5])) for _ in range(rng.randint(1, 9))] * rng.randint(1, 8)
                w += p[:max(1, len(p) - rng.randint(0, 5))]
            docs.append(w)
        flat = np.array([x for d in docs for x in d], dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        doc = np.array([i for i, d in enumerate(docs) for _ in d], dtype=np.int64)
        owner, start, length, period = periodic.runs_of(flat, doc)
        first = np.cumsum([0] + [len(d) for d in docs])
        for i, d in enumerate(docs):
            mine = owner == i
            assert list(zip((start[mine] - first[i]).tolist(), length[mine].tolist(), period[mine].tolist())) \
                == brute.word_runs(d)


def test_period_query_on_whole_small_table(spark):
    docs = documents(spark, SF)
    got = {r["doc_id"]: r for r in periodic.digest(periodic.find_runs(docs, text_col=periodic.tail_repeated())).collect()}
    runs = 0
    for r in docs.collect():
        w = brute.WORD.findall(r["text"] or "")
        n, h = len(w), zlib.crc32(str(r["doc_id"]).encode())
        if h % 10 == 0 and n:
            g = h // 10
            a, p = g % n, 1 + (n - g % n) // (3 + g % 8)
            w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
        if n > 2500 and h % 10:
            continue  # the plain version is quadratic
        found = brute.word_runs(w)
        runs += len(found)
        gone = {i for s, m, q in found for i in range(s + q, s + m)}
        me = got[r["doc_id"]]
        assert me["n_runs"] == len(found)
        assert me["runs_sha256"] == brute.sha("".join(f"{s},{m},{q}\n" for s, m, q in found))
        assert me["collapsed_sha256"] == brute.sha(" ".join(x for i, x in enumerate(w) if i not in gone))
        if found:
            s, m, q = max(found, key=lambda x: ((x[1] << 64) // x[2], -x[0], -x[2]))
            assert (me["start"], me["length"], me["period"], me["exponent_milli"]) == (s, m, q, 1000 * m // q)
        else:
            assert me["start"] is me["length"] is me["period"] is me["exponent_milli"] is None
    assert runs > 10


def test_runs_of_edge_rows(spark):
    hot = "a " * 300_000  # one word: a million earlier occurrences cost no more than one
    docs = frame(spark, [(1, None), (2, ""), (3, "\n"), (None, "a b a b a b a b"), (4, "a b a b a b a b"), (4, "x"), (5, hot)])
    out = periodic.find_runs(docs).collect()
    got = sorted((str(r["doc_id"]), r["n_words"], [tuple(x) for x in r["runs"]], r["collapsed"]) for r in out)
    assert got == sorted([("1", 0, [], ""), ("2", 0, [], ""), ("3", 0, [], ""), ("None", 8, [(0, 8, 2)], "a b"),
                          ("4", 8, [(0, 8, 2)], "a b"), ("4", 1, [], "x"), ("5", 300_000, [(0, 300_000, 1)], "a")])
    assert periodic.find_runs(docs.where("false")).collect() == []
    rewritten = docs.select("doc_id", periodic.tail_repeated().alias("t")).where("doc_id IS NULL OR doc_id = 1").collect()
    assert {r["t"] for r in rewritten} == {None, "a b a b a b a b"}
    with pytest.raises(ValueError):
        periodic.runs_of(np.zeros(1, np.uint64), np.zeros(1, np.int64), times=2)


# -- what learning moves -------------------------------------------------------------------


def test_toxicity_fits_a_bounded_sample_of_word_places(spark):
    rows = [(i, f"w{i % 7} w{i % 3} bad" if i % 4 == 0 else f"w{i % 7} w{i % 3}") for i in range(90)]
    docs = frame(spark, rows + [(0, "again"), (None, "bad")])
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(100)] + [(0, 0), (None, 1)], "doc_id long, grade int")
    some = toxicity.fitting_rows(docs, 2, sample=40, labels=labels)
    assert some.columns == ["_id", "_grade", "place"] and some.count() == 40
    every = {r["_id"]: r for r in toxicity.fitting_rows(docs, 2, labels=labels).collect()}
    assert set(every) == set(range(90)) and every[0]["_grade"] == 1  # the highest of two labels
    weights, cut = toxicity.learn(docs, grades=2, labels=labels)
    got = {r["doc_id"]: r["severity"] for r in toxicity.score_documents(docs.where("doc_id > 0"), (weights, cut)).collect()}
    assert min(got[i] for i in got if i % 4 == 0) > max(got[i] for i in got if i % 4)


def test_rules_learn_from_numbers_and_verdicts_follow(spark):
    clean = "the cat sat on a mat and looked at all of the small birds by the old stone wall "
    rows = [(i, clean * (4 + i % 9) + f"word{i} " * (i % 5)) for i in range(60)]
    rows += [(100 + i, ("#$%& " * (2 + i % 4) + f"x{i} y ") * (14 + i % 11)) for i in range(60)]
    rows = [(i, " ".join(f"{w}{k}" if k % 3 else w for k, w in enumerate(t.split()))) for i, t in rows]
    docs = frame(spark, rows)
    labels = spark.createDataFrame([(i, int(i < 100)) for i, _ in rows], "doc_id long, quality int")
    numbers = rules.measured(docs)
    assert "_raw" not in numbers.columns and numbers.count() == 120
    learned = rules.learn_measured(numbers, labels)
    assert learned
    plain = {r["_id"]: r for r in numbers.collect()}

    def first(r):
        return next((k for k, rule in enumerate(learned, 1)
                     if all(r[t.feature] <= t.cut if t.below else r[t.feature] > t.cut for t in rule)), None)

    verdicts = {r["_id"]: r for r in rules.judged(numbers, learned).collect()}
    for i, r in verdicts.items():
        assert r["rule"] == first(plain[i]) and r["kept"] == (not r["base_failed"] and r["rule"] is None)
    assert sum(r["rule"] is not None for i, r in verdicts.items() if i >= 100) >= 45
    assert sum(r["rule"] is not None for i, r in verdicts.items() if i < 100) <= 3
    kept = rules.keep_learned(docs, labels)
    assert kept.columns == docs.columns
    assert {r["doc_id"] for r in kept.collect()} == {i for i, r in verdicts.items() if r["kept"]}
