"""Secret scans over a content-addressed blob ledger, in DataFrame functions.

Every version of every text is a blob, named by the sha256 of its bytes; equal
texts at any path or time are one blob. A rule has a name, a version and a
pattern; another pattern needs another version. The ledger has a row for each
(blob, rule, version) pair already scanned, with its findings. A run scans only
pairs the ledger does not hold, once per blob, appends them in one write (a run
that fails before its end leaves none), and joins the findings back to all paths.
Runs at the same time may scan a pair twice; equal rows count once.

Matches are leftmost and do not overlap within a rule. Spans are code points,
end exclusive: ``split`` gives the text between matches, so a match starts after
all gaps and matches before it; n matches cost n^1.5 steps. A rule with ``at_least`` finds first and drops
the short matches then, as those still use up the text they cover.

Defined results: null text is the empty blob, with no findings. Paths may repeat
or be null; each row gets its own result. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import replaced, text_or_empty
from strata.session import scratch_path


@dataclass(frozen=True)
class Rule:
    kind: str
    pattern: str
    version: int = 1
    group: int = 0          # the group whose length counts
    at_least: int = 0       # code points the group must have
    holds: str = ""         # a literal every match holds (a cheap test before the pattern)


ASSIGN = Rule("assign", r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|"""
              r"""[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
              group=2, at_least=8)
ACCESS = Rule("access", r"AKIA[A-Z0-9]+", at_least=16, holds="AKIA")
HEX = Rule("hex", r"[0-9a-f]{32,}")
BASE = (ASSIGN, ACCESS, HEX)
MORE = (
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}", holds="eyJ"),
    Rule("pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-----[A-Za-z0-9+/=\s]*(-----END [A-Z ]*PRIVATE KEY-----)?",
         holds="PRIVATE KEY-----"),
    Rule("forge", r"gh[pousr]_[A-Za-z0-9]{36,}", holds="gh"),
)
RULES = BASE + MORE

#: Session setting that names a ledger to keep between runs.
LEDGER_CONF = "spark.strata.secretLedger"

_SPAN = "array<struct<start:int,rank:int,end:int,kind:string>>"


def _let(value: Column, use) -> Column:
    """``use(value)`` with the value computed once."""
    return F.transform(F.array(value), use).getItem(0)


def _width(items: Column) -> Column:
    return F.greatest(F.ceil(F.sqrt(F.size(items))), F.lit(1)).cast("int")


def _chunks(items: Column, width: Column) -> Column:
    """A filled array in runs of ``width`` items."""
    return F.transform(F.sequence(F.lit(0), F.floor((F.size(items) - 1) / width).cast("int")),
                       lambda i: F.slice(items, i * width + 1, width))


def running(values: Column, zero: Column, op) -> Column:
    """For each place of an int array, ``op`` folded over the values before it. A fold
    that appends copies what it has, so it runs in chunks of the root of the size."""
    def fold(items, first):
        return F.aggregate(
            items, F.struct(first.alias("at"), F.array().cast("array<int>").alias("out")),
            lambda acc, x: F.struct(op(acc["at"], x).alias("at"), F.concat(acc["out"], F.array(acc["at"])).alias("out")),
            lambda acc: acc["out"])

    def chunked(items):
        return _let(_chunks(items, _width(items)), lambda parts: F.flatten(F.zip_with(
            parts, fold(F.transform(parts, lambda part: F.aggregate(part, zero, op)), zero), fold)))

    return _let(values, lambda v: F.when(F.size(v) > 0, chunked(v)).otherwise(F.array().cast("array<int>")))


def spans(text: Column, rule: Rule, rank: int) -> Column:
    """All spans of one rule in a text."""
    pattern = F.lit(rule.pattern)
    found = F.regexp_extract_all(text, pattern, F.lit(0))
    kept = F.regexp_extract_all(text, pattern, F.lit(rule.group)) if rule.group else found
    gaps = F.split(text, rule.pattern, -1)
    # (gap, match) by match; a match starts after all gaps and matches before it
    step = F.filter(F.arrays_zip(F.transform(gaps, F.length).alias("gap"), F.transform(found, F.length).alias("size"),
                                 F.transform(kept, F.length).alias("counts")), lambda s: s["size"].isNotNull())

    def placed(steps):
        before = running(F.transform(steps, lambda s: s["gap"] + s["size"]), F.lit(0), lambda x, y: x + y)
        every = F.zip_with(steps, before, lambda s, at: F.struct(
            (at + s["gap"]).alias("start"), F.lit(rank).alias("rank"), (at + s["gap"] + s["size"]).alias("end"),
            F.lit(rule.kind).alias("kind"), s["counts"].alias("counts")))
        long = F.filter(every, lambda s: s["counts"] >= rule.at_least)
        return F.transform(long, lambda s: F.struct(*[s[c].alias(c) for c in ("start", "rank", "end", "kind")]))

    here = text.rlike(rule.pattern)
    if rule.holds:
        here = F.contains(text, F.lit(rule.holds)) & here
    return F.when(here, _let(step, placed)).otherwise(F.array().cast(_SPAN))


def render(found: Column) -> Column:
    return F.array_join(F.transform(found, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def _found(docs: DataFrame, rules: Sequence[Rule], text_col: str, ledger: str | None) -> DataFrame:
    """(blob, found) of every blob of ``docs`` that holds a span. With a ledger only
    unseen pairs are scanned; their rows, spans included, are one append to it."""
    spark = docs.sparkSession
    blobs = docs.select(text_or_empty(text_col).alias("_text")).withColumn("blob", F.sha2("_text", 256)) \
        .dropDuplicates(["blob"])
    text = F.col("_text")
    if ledger is None:
        return blobs.select("blob", F.array_sort(F.flatten(F.array(*[spans(text, r, i) for i, r in enumerate(rules)])))
                            .alias("found")).where(F.size("found") > 0)
    pair = lambda r: F.lit(f"{r.kind}:{r.version}")
    seen = _seen(spark, ledger)
    if seen is None:
        todo = blobs.withColumn("seen", F.array().cast("array<string>"))
    else:
        todo = blobs.join(seen.groupBy("blob").agg(F.collect_set(F.concat_ws(":", "kind", "version")).alias("seen")),
                          "blob", "left").withColumn("seen", F.coalesce("seen", F.array().cast("array<string>")))
    done = F.filter(F.array(*[F.when(~F.array_contains("seen", pair(r)), F.struct(
        F.lit(r.kind).alias("kind"), F.lit(r.version).alias("version"),
        F.transform(spans(text, r, i), lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end")))
        .alias("spans"))) for i, r in enumerate(rules)]), lambda p: p.isNotNull())
    todo.select("blob", F.explode(done).alias("p")).select("blob", "p.*") \
        .write.mode("append").parquet(f"{ledger}/scanned")
    rank = F.create_map(*[x for i, r in enumerate(rules) for x in (pair(r), F.lit(i))])
    known = _seen(spark, ledger).where(F.size("spans") > 0) \
        .withColumn("rank", F.element_at(rank, F.concat_ws(":", "kind", "version"))).where("rank IS NOT NULL")
    return known.groupBy("blob").agg(F.collect_set(F.struct("rank", "kind", "spans")).alias("all")).select(
        "blob", F.array_sort(F.flatten(F.transform("all", lambda p: F.transform(p["spans"], lambda s: F.struct(
            s["start"].alias("start"), p["rank"].alias("rank"), s["end"].alias("end"), p["kind"].alias("kind"))))))
        .alias("found"))


def scan(docs: DataFrame, rules: Sequence[Rule] = RULES, id_col: str = "doc_id", text_col: str = "text",
         ledger: str | None = None) -> DataFrame:
    """One row per input row: id, blob and found (its spans by start, then rule).

    ``ledger`` names a folder that keeps the scanned pairs of earlier runs with
    their findings; without one, every pair is unseen and nothing is kept."""
    found = _found(docs, rules, text_col, ledger)
    paths = docs.select(F.col(id_col).alias("_id"), F.sha2(text_or_empty(text_col), 256).alias("blob"))
    return paths.join(found, "blob", "left").select(
        F.col("_id").alias(id_col), "blob", F.coalesce("found", F.array().cast(_SPAN)).alias("found"))


def run_ledger(spark) -> str:
    """The ledger folder that the session keeps (``LEDGER_CONF``); a new one for this run
    where none is named, so that every text is scanned whatever ran before."""
    return spark.conf.get(LEDGER_CONF, None) or scratch_path(spark, "llm", "secret-ledger")


def _seen(spark, ledger: str) -> DataFrame | None:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{ledger}/scanned/_SUCCESS")
    if not path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path):
        return None
    return spark.read.schema("blob string, kind string, version int, spans array<struct<start:int,end:int>>") \
        .parquet(f"{ledger}/scanned")


def masked(text: Column, found: Column, mask: str) -> Column:
    """The text with every span replaced by ``mask``; spans that overlap become one.
    Text is cut in runs first, as a substring is counted from the text's start."""
    def cut(heads, end):
        def run(part):
            base = part.getItem(0)["at"]
            return _let(F.substring(text, base + 1, F.element_at(part, -1)["start"] - base), lambda piece: F.array_join(
                F.transform(part, lambda h: F.concat(F.substring(piece, h["at"] - base + 1, h["start"] - h["at"]),
                                                     F.lit(mask))), ""))
        return F.concat(F.array_join(F.transform(_chunks(heads, _width(heads)), run), ""),
                        F.substring(text, end + 1, F.length(text)))

    def spread(all_spans):
        ends = F.transform(all_spans, lambda s: s["end"])
        each = F.zip_with(all_spans, running(ends, F.lit(0), lambda x, y: F.greatest(x, y)),
                          lambda s, at: F.struct(at.alias("at"), s["start"].alias("start")))
        return _let(F.filter(each, lambda h: h["start"] >= h["at"]), lambda heads: cut(heads, F.array_max(ends)))

    return _let(found, lambda f: F.when(F.size(f) > 0, spread(f)).otherwise(text))


def redact(docs: DataFrame, rules: Sequence[Rule] = RULES, id_col: str = "doc_id", text_col: str = "text",
           mask: str = "[SECRET]", ledger: str | None = None) -> DataFrame:
    """The input with secrets masked in the text (columns as they were,
    ``n_chars`` counted anew where there is one); no row goes. Findings are
    joined by blob, so repeated and null ids keep their own texts."""
    found = _found(docs, rules, text_col, ledger).select(F.col("blob").alias("_blob"), "found")
    rows = docs.select(F.sha2(text_or_empty(text_col), 256).alias("_address"),
                       F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"))
    text = F.coalesce(F.col("_row").getField(text_col), F.lit(""))
    out = rows.join(found, F.col("_address") == F.col("_blob"), "left").withColumn(
        "_masked", F.when(F.col("found").isNotNull(), masked(text, F.col("found"), mask)))
    return out.select(*replaced(docs, text_col, F.col("_masked")))
