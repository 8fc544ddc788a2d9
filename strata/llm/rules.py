"""Quality rules as a learned decision list, in DataFrame functions.

Sequential covering: a rule is a conjunction of threshold tests on a document's
statistics that says "junk". It is grown on two thirds of the labelled rows:
at each step the test that gains most (FOIL's information gain) is added, until
no clean row is covered or the rule is as long as ``MOST_TESTS``. It is pruned
on the other third: final tests go as long as precision there does not fall.
An accepted rule's rows are covered and the next rule is learnt from the rest;
learning ends when a rule's precision on the pruning rows is under
``least_precision`` or it covers fewer than ``least_rows`` junk rows. The list becomes one ordered Spark ``when`` expression.

All steps are aggregates over all labelled rows: statistics are binned once by
approximate quantiles, and a step brings back only counts by (statistic, bin),
at most ``BINS`` times the number of statistics, whatever the rows.

Defined results: null text has no words. Rows labelled with null are not learnt
from; with no labelled rows of both kinds the list is empty and only the base
rules decide. Repeated labels count as often as they occur, repeated ids are
judged row by row. ``counts`` adds columns named as ``COUNTS`` and ``FEATURES`` to
its input; ``measured``, ``keep`` and ``keep_learned`` hold input columns apart, so
that none can clash.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import discard, land, text_or_empty

BINS = 32
MOST_TESTS = 3
WORD_GAP = r"[\x20\x09-\x0D]+"
WHITE = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
#: Shares the rules test, from the counts.
FEATURES = ("words", "chars_per_word", "symbols_per_word", "dup_lines_share", "repeat_share", "distinct_share",
            "stop_share", "upper_share", "digit_share", "end_share")


def counts(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """The input with the exact counts of each text and the shares rules test."""
    text = text_or_empty(text_col)
    words = F.filter(F.split("_text", WORD_GAP), lambda w: w != "")
    out = docs.withColumn("_text", text).withColumn("_words", words)
    hashed = F.transform("_words", lambda w: F.xxhash64(w))
    out = out.withColumn("_h", hashed).withColumn("n_words", F.size("_words").cast("long"))
    grams = F.when(F.col("n_words") >= 3, F.transform(
        F.slice("_h", F.lit(1), F.greatest(F.size("_h") - 2, F.lit(1))),
        lambda h, i: F.xxhash64(h, F.get(F.col("_h"), i + 1), F.get(F.col("_h"), i + 2)))) \
        .otherwise(F.array().cast("array<bigint>"))
    out = out.withColumn("_grams", grams)
    # equal windows stand together when sorted with their places
    placed = F.sort_array(F.transform("_grams", lambda g, i: F.struct(g.alias("g"), i.alias("i"))))
    out = out.withColumn("_placed", F.when(F.size(F.array_distinct("_grams")) < F.size("_grams"), placed))
    same = lambda p, q: F.coalesce(p["g"] == q["g"], F.lit(False))
    again = F.filter(F.transform("_placed", lambda p, i: F.when(
        same(p, F.get(F.col("_placed"), i - 1)) | same(p, F.get(F.col("_placed"), i + 1)), p["i"])),
        lambda i: i.isNotNull())
    covered = F.array_distinct(F.flatten(F.transform(again, lambda i: F.array(i, i + 1, i + 2))))
    lines = F.filter(F.split("_text", "\n"), lambda x: F.length(F.translate(x, WHITE, "")) > 0)
    out = (out.withColumn("n_repeat_words", F.when(F.col("_placed").isNull(), F.lit(0)).otherwise(F.size(covered))
                          .cast("long"))
           .withColumn("_lines", lines)
           .withColumn("word_chars", F.length(F.translate("_text", WHITE, "")).cast("long"))
           .withColumn("n_symbols", (F.length("_text") - F.length(F.translate("_text", SYMBOLS, ""))).cast("long"))
           .withColumn("n_lines", F.size("_lines").cast("long"))
           .withColumn("n_dup_lines", (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long")))
    per_word = lambda c: c / F.greatest(F.col("n_words"), F.lit(1))
    short = F.size(F.filter("_words", lambda w: F.length(w) <= 3))
    ends = F.size(F.filter("_words", lambda w: w.endswith(".") | w.endswith("!") | w.endswith("?")))
    upper = F.length("_text") - F.length(F.translate("_text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", ""))
    digit = F.length("_text") - F.length(F.translate("_text", "0123456789", ""))
    chars = F.greatest(F.col("word_chars"), F.lit(1))
    return (out.withColumn("words", F.col("n_words").cast("double"))
            .withColumn("chars_per_word", per_word(F.col("word_chars")))
            .withColumn("symbols_per_word", per_word(F.col("n_symbols")))
            .withColumn("dup_lines_share", F.col("n_dup_lines") / F.greatest(F.col("n_lines"), F.lit(1)))
            .withColumn("repeat_share", per_word(F.col("n_repeat_words")))
            .withColumn("distinct_share", per_word(F.size(F.array_distinct("_h"))))
            .withColumn("stop_share", per_word(short))
            .withColumn("upper_share", upper / chars)
            .withColumn("digit_share", digit / chars)
            .withColumn("end_share", per_word(ends))
            .drop("_text", "_words", "_h", "_grams", "_placed", "_lines", "n_lines"))


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


class Test:
    """``feature <= cut`` or ``feature > cut``."""

    def __init__(self, feature: str, cut: float, below: bool):
        self.feature, self.cut, self.below = feature, cut, below

    def column(self) -> Column:
        at = F.lit(float(self.cut))
        return F.col(self.feature) <= at if self.below else F.col(self.feature) > at

    def __repr__(self):
        return f"{self.feature} {'<=' if self.below else '>'} {self.cut:.4g}"


def _all(tests: list[Test]) -> Column:
    out = F.lit(True)
    for t in tests:
        out = out & t.column()
    return out


def _gain(p: float, n: float, all_p: float, all_n: float) -> float:
    """FOIL: junk rows kept, times the bits of purity won."""
    if p == 0 or all_p == 0:
        return 0.0
    return p * (math.log2(p / (p + n)) - math.log2(all_p / (all_p + all_n)))


def learn(labelled: DataFrame, good_col: str = "quality", features: tuple[str, ...] = FEATURES,
          least_precision: float = 0.9, least_rows: int = 10) -> list[list[Test]]:
    """The ordered rules (junk conjunctions) of rows with ``features`` and a
    label (1 clean, 0 junk)."""
    rows = land(labelled.where(F.col(good_col).isin(0, 1)).select(
        *features, (F.col(good_col) == 0).alias("_junk"),
        (F.pmod(F.xxhash64(*features), F.lit(3)) == 0).alias("_prune")), "rules-labelled")
    share = [i / BINS for i in range(1, BINS)]
    cuts = rows.agg(*[F.percentile_approx(F.when(F.col("_junk") == junk, F.col(f)), share, 10_000).alias(f"{f}_{junk}")
                      for f in features for junk in (True, False)]).first()
    grid = {f: sorted({c for junk in (True, False) for c in cuts[f"{f}_{junk}"] or []}) for f in features}
    rules: list[list[Test]] = []
    if not any(grid.values()):
        return rules
    left = rows
    while True:  # every rule covers least_rows junk rows more
        rule = _grow(left.where("NOT _prune"), grid)
        if not rule:
            break
        rule = _prune(left.where("_prune"), rule)
        junk, clean = _covered(left, [rule])[0]
        held_junk, held_clean = _covered(left.where("_prune"), [rule])[0]
        sure = held_junk / max(held_junk + held_clean, 1) >= least_precision and \
            junk / max(junk + clean, 1) >= least_precision
        if not sure or junk < least_rows:
            break
        rules.append(rule)
        left = left.where(~_all(rule))
    discard(rows)
    return rules


def _grow(rows: DataFrame, grid: dict[str, list[float]]) -> list[Test]:
    rule: list[Test] = []
    while len(rule) < MOST_TESTS:
        inside = rows.where(_all(rule))
        # a bin is the number of cuts below the value: one pass gives every test's counts
        bins = F.explode(F.array(*[F.struct(
            F.lit(f).alias("feature"), _bin(f, cuts).alias("bin")) for f, cuts in grid.items() if cuts])).alias("b")
        table = inside.select("_junk", bins).groupBy("b.feature", "b.bin").agg(
            F.count_if("_junk").alias("junk"), F.count_if(~F.col("_junk")).alias("clean")).collect()
        by: dict[str, dict[int, tuple[int, int]]] = {}
        for r in table:
            by.setdefault(r["feature"], {})[r["bin"]] = (r["junk"], r["clean"])
        if not by:
            break
        p, n = (sum(v[i] for v in next(iter(by.values())).values()) for i in (0, 1))
        if n == 0 or p == 0:
            break
        best, test = 1e-9, None
        for feature in sorted(by):
            under = [0, 0]
            for b, cut in enumerate(grid[feature]):
                junk, clean = by[feature].get(b, (0, 0))
                under = [under[0] + junk, under[1] + clean]
                for below, (a, c) in ((True, under), (False, (p - under[0], n - under[1]))):
                    gain = _gain(a, c, p, n)
                    if gain > best:
                        best, test = gain, Test(feature, cut, below)
        if test is None:
            break
        rule.append(test)
    return rule


def _bin(feature: str, cuts: list[float]) -> Column:
    """How many cuts lie below the value (a test ``<= cut`` takes the bins up to its cut's number)."""
    return F.size(F.filter(F.array(*[F.lit(float(c)) for c in cuts]), lambda c: c < F.col(feature)))


def _covered(rows: DataFrame, rules: list[list[Test]]) -> list[tuple[int, int]]:
    """(junk, clean) rows that each rule covers."""
    aggs = [F.count_if(_all(r) & (F.col("_junk") == junk)) for r in rules for junk in (True, False)]
    got = rows.agg(*aggs).first()
    return [(got[2 * i], got[2 * i + 1]) for i in range(len(rules))]


def _prune(rows: DataFrame, rule: list[Test]) -> list[Test]:
    """The shortest beginning of the rule whose precision is not under the whole rule's."""
    heads = [rule[:k] for k in range(1, len(rule) + 1)]
    worth = [junk / max(junk + clean, 1) if junk else 0.0 for junk, clean in _covered(rows, heads)]
    return next(h for h, w in zip(heads, worth) if w >= worth[-1])


def verdict(rules: list[list[Test]]) -> Column:
    """The list as one conditional expression: the number of the first rule that
    rejects a row (from 1), or null where none does."""
    out = F.lit(None).cast("int")
    for number in range(len(rules), 0, -1):
        out = F.when(_all(rules[number - 1]), F.lit(number)).otherwise(out)
    return out


def measured(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", whole: bool = False) -> DataFrame:
    """Every text counted once, stored: ``_id``, the counts and shares, and with
    ``whole`` the row itself as ``_row``. Texts are not shuffled."""
    row = [F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row")] if whole else []
    return land(counts(docs.select(F.col(f"`{id_col}`").alias("_id"), F.col(f"`{text_col}`").alias("_raw"), *row), "_raw")
                .drop("_raw"), "rules-measured")


def learn_measured(numbers: DataFrame, labels: DataFrame, id_col: str = "doc_id", good_col: str = "quality",
                   **options) -> list[list[Test]]:
    """Rules from a labels table (id, 1 or 0) over measured documents; numbers
    alone are joined to labels."""
    named = labels.select(F.col(id_col).alias("_label_id"), F.col(good_col).alias("_good"))
    return learn(numbers.select("_id", *FEATURES).join(named, F.col("_id") == F.col("_label_id")), "_good", **options)


def learn_from(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               good_col: str = "quality", **options) -> list[list[Test]]:
    """Rules from a labels table (id, 1 or 0) over the documents it names."""
    numbers = measured(docs, id_col, text_col)
    rules = learn_measured(numbers, labels, id_col, good_col, **options)
    discard(numbers)
    return rules


def judged(numbers: DataFrame, rules: list[list[Test]]) -> DataFrame:
    """Measured documents with base_failed, rule (which one rejects) and kept."""
    return numbers.withColumn("base_failed", base_failed()).withColumn("rule", verdict(rules)) \
        .withColumn("kept", ~F.col("base_failed") & F.col("rule").isNull())


def judge(docs: DataFrame, rules: list[list[Test]], text_col: str = "text") -> DataFrame:
    """The input with the counts, base_failed, rule (which one rejects) and kept."""
    return judged(counts(docs, text_col), rules).drop(*FEATURES)


def keep_learned(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 good_col: str = "quality", **options) -> DataFrame:
    """The documents that the base rules and a list learnt from ``labels`` keep;
    each text is counted once."""
    numbers = measured(docs, id_col, text_col, whole=True)
    rules = learn_measured(numbers, labels, id_col, good_col, **options)
    return judged(numbers, rules).where("kept").select("_row").select("_row.*")


def keep(docs: DataFrame, rules: list[list[Test]], text_col: str = "text") -> DataFrame:
    """The documents that the base rules and the learned list keep."""
    rows = docs.select(F.col(f"`{text_col}`").alias("_raw"), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"))
    # explode drops the null arrays; a filter would be pushed down and compute the counts once per test
    once = F.explode(F.when(F.col("kept"), F.array(F.lit(1)))).alias("_one")
    return judge(rows, rules, "_raw").select("_row", once).select("_row.*")
