"""MinHash near-duplicate groups: one-permutation hashing with optimal
densification, banded buckets, star-shaped candidate edges, exact links.

Each document becomes its set of distinct word shingles. Equal sets form one
class first (a partial aggregate, so a hot group of copies never meets in one
task). One hash permutation splits a class's shingles into bins; a bin's
minimum is its signature entry, and empty bins borrow along random probe
sequences (optimal densification). Bands of the signature name buckets.

In a bucket only star edges are drawn: from one centre, the member with the most
company in all its buckets (a text that others are copies of has more than its
copies), to every other member, so a bucket of n members gives n - 1 pairs. Each
edge is confirmed on the full shingle sets. Components come from alternating
large-star / small-star steps.

Two members that are both unlike the centre can still be alike. Buckets left with
several labels are therefore split by the shingles in which members differ from
the hub of a label (``_between``): only pairs that share one of the few
differences they must share are compared, so no link between members of a bucket
is missed and the members of a group don't all meet those outside it.

Defined results: null or wordless text has an empty set, is linked with
nothing and kept. A row without id takes part in nothing: its component is
null and it is kept. Rows that share an id are each judged by their own text:
a node is an id with the hash of its text's set, and a component is named by the
id of its smallest node, the only one that is kept of it.
Extra columns are ignored by ``near_duplicates`` and passed on by ``dedupe``.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import (blocks, discard, grams, land, lower_az, mix, ragged, ship, text_or_empty,
                               whole_grams, word_hashes, word_spans)

BINS = 128
BANDS = 32
ROWS = BINS // BANDS
_PROBES = 4096
#: 64-bit words of a set's bitmap (1,024 bits, named by ten bits of a shingle's hash).
BIT_WORDS = 16
#: Factors of the two hashes that name a set.
_KEYS = (0x2545F4914F6CDD1D, 0x9FB21C651E98DF25)
#: Links that one task handles when components are made.
LINKS_PER_TASK = 200_000


def _probe(attempt: int) -> np.ndarray:
    """Where each bin looks in this attempt (the same for every document)."""
    step = np.arange(BINS, dtype=np.uint64) + np.uint64(attempt * BINS + 1)
    return (mix(step * np.uint64(0xD1342543DE82EF95)) >> np.uint64(64 - (BINS - 1).bit_length())).astype(np.int64)


def shingle_sets(data: np.ndarray, offsets: np.ndarray, shingle: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of each text of a block, and set sizes."""
    data = lower_az(data)
    starts, ends, doc = word_spans(data, offsets)
    n = len(offsets) - 1
    h = word_hashes(data, starts, ends)
    at = whole_grams(doc, shingle)
    value, owner = grams(h, shingle, 1)[at], doc[at]
    count = np.bincount(doc, minlength=n)
    short = np.flatnonzero((count > 0) & (count < shingle))
    if len(short):  # the whole sequence as one shingle
        first = np.cumsum(count) - count
        whole = [mix(grams(h[first[d]:first[d] + count[d]], int(count[d]), 100 + int(count[d])))[0] for d in short]
        value = np.concatenate([value, np.array(whole, dtype=np.uint64)])
        owner = np.concatenate([owner, short])
    order = np.lexsort((value, owner))
    value, owner = value[order], owner[order]
    new = np.ones(len(value), dtype=bool)
    new[1:] = (value[1:] != value[:-1]) | (owner[1:] != owner[:-1])
    value, owner = value[new], owner[new]
    return value, np.bincount(owner, minlength=n)


def signatures(value: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Densified one-permutation signatures, a row of BINS for each set (zeros for an empty set)."""
    n = len(size)
    owner = np.repeat(np.arange(n), size)
    slot = owner * BINS + (value >> np.uint64(64 - (BINS - 1).bit_length())).astype(np.int64)
    first = np.ones(len(slot), dtype=bool)
    first[1:] = slot[1:] != slot[:-1]  # sets are sorted: the first entry of a bin is its minimum
    own = np.zeros(n * BINS, dtype=np.uint64)
    full = np.zeros(n * BINS, dtype=bool)
    own[slot[first]] = value[first]
    full[slot[first]] = True
    out = own.copy()
    todo = np.flatnonzero(~full & np.repeat(size > 0, BINS))
    for attempt in range(_PROBES):
        if not len(todo):
            break
        source = todo - todo % BINS + _probe(attempt)[todo % BINS]
        hit = full[source]
        out[todo[hit]] = own[source[hit]]
        todo = todo[~hit]
    for at in todo:  # practically never: the set's smallest hash
        row = slice(at - at % BINS, at - at % BINS + BINS)
        out[at] = own[row][full[row]].min()
    return out.reshape(n, BINS)


def band_keys(signature: np.ndarray) -> np.ndarray:
    factor = mix(np.arange(1, BINS + 1, dtype=np.uint64) * np.uint64(7919)) | np.uint64(1)
    mixed = (signature * factor).reshape(len(signature), BANDS, ROWS).sum(axis=2, dtype=np.uint64)
    return mix(mixed + np.arange(BANDS, dtype=np.uint64) * np.uint64(0xA24BAED4963EE407))


def _set_key(value: np.ndarray, owner: np.ndarray, n: int, factor: int) -> np.ndarray:
    """A hash of each set."""
    key = np.zeros(n, np.uint64)
    np.add.at(key, owner, mix(value * np.uint64(factor)))
    return key


def _sketch(shingle: int):
    def run(batches):
        for batch in batches:
            for lo, hi, data, offsets in blocks(batch.column("_text")):
                value, size = shingle_sets(data, offsets, shingle)
                owner = np.repeat(np.arange(hi - lo), size)
                keys = [_set_key(value, owner, hi - lo, m) for m in _KEYS]
                bands = band_keys(signatures(value, size))
                yield pa.RecordBatch.from_arrays([
                    batch.column("_id").slice(lo, hi - lo), batch.column("_hash").slice(lo, hi - lo),
                    pa.array(size, pa.int64()), pa.array(keys[0].view(np.int64)), pa.array(keys[1].view(np.int64)),
                    ragged(bands[size > 0].reshape(-1).view(np.int64), np.where(size > 0, BANDS, 0), pa.int64()),
                ], names=["_id", "_hash", "n_shingles", "key1", "key2", "bands"])
    return run


def _sets(shingle: int):
    def run(batches):
        for batch in batches:
            for lo, hi, data, offsets in blocks(batch.column("_text")):
                value, size = shingle_sets(data, offsets, shingle)
                owner, place = np.repeat(np.arange(hi - lo), size), value >> np.uint64(54)
                bits = np.zeros((hi - lo, BIT_WORDS), dtype=np.uint64)
                np.bitwise_or.at(bits, (owner, (place >> np.uint64(6)).astype(np.int64)),
                                 np.uint64(1) << (place & np.uint64(63)))
                key = _set_key(value, owner, hi - lo, _KEYS[0]).view(np.int64)
                lists = batch.column("_keys").slice(lo, hi - lo)  # of the id's nodes: one at least
                many = lists.value_lengths().to_numpy().astype(np.int64)
                same = lists.flatten().to_numpy() == np.repeat(key, many)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("_id").slice(lo, hi - lo), pa.array(key), ragged(value.view(np.int64), size, pa.int64()),
                     ragged(bits.reshape(-1).view(np.int64), np.full(hi - lo, BIT_WORDS), pa.int64())],
                    names=["_id", "key1", "shingles", "bits"]) \
                    .filter(pa.array(np.logical_or.reduceat(same, np.cumsum(many) - many)))
    return run


def _small(df: DataFrame, rows: int) -> DataFrame:
    """The frame in as many partitions as a table of ``rows`` links is worth."""
    return df.coalesce(1 + rows // LINKS_PER_TASK)


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of ``edges`` (a, b) that is not its
    component's smallest, by alternating large-star and small-star steps."""
    cur = land(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
               .where("u <> v").distinct(), "cc")
    rows = cur.count()
    mark = None
    while True:
        both = cur.union(cur.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = _small(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")), rows)
        large = _small(both.join(low, "u").where(F.col("v") > F.col("u"))
                       .select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct(), rows)
        large = land(large, "cc-large")
        low = _small(large.groupBy("u").agg(F.min("v").alias("m")), rows)
        small = (large.join(low, "u").select(F.explode(F.array(
            F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct(F.col("u"), F.col("m").alias("v"))))
            .alias("e")).select("e.u", "e.v").where("u <> v").distinct())
        nxt = land(_small(small, rows), "cc")
        now = nxt.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        discard(cur)
        discard(large)
        cur, rows = nxt, now[0]
        if mark == now:
            break
        mark = now
    # at the fixpoint every edge points at its component's smallest node
    return cur.select(F.col("u").alias("node"), F.col("v").alias("component"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 5,
                    percent: int = 80) -> DataFrame:
    """One row for each input row: id, n_shingles, component_id, kept. Rows are
    linked when 100 * |A & B| >= percent * |A | B| on their full shingle sets."""
    return _judged(docs, id_col, text_col, shingle, percent).select(
        F.col("_id").alias(id_col), "n_shingles", "component_id", "kept")


def _judged(docs: DataFrame, id_col: str, text_col: str, shingle: int, percent: int) -> DataFrame:
    """near_duplicates with the hashes of the row's text (_hash) and set (key1)."""
    ship(docs.sparkSession)
    kind = docs.schema[id_col].dataType
    pairs = docs.select(F.col(id_col).alias("_id"), text_or_empty(text_col).alias("_text")) \
        .withColumn("_hash", F.xxhash64("_text"))
    id_type = kind.simpleString()
    sketch = land(pairs.mapInArrow(_sketch(shingle), f"_id {id_type}, _hash bigint, n_shingles bigint, key1 bigint, "
                                   "key2 bigint, bands array<bigint>"), "minhash-sketch")
    full = sketch.where("n_shingles > 0 AND _id IS NOT NULL")
    classes = land(full.groupBy("key1", "key2").agg(F.min(F.struct("_id", "n_shingles", "bands")).alias("r"))
                   .select("key1", "key2", F.struct("r._id", "key1").alias("node"), F.col("r.n_shingles").alias("n"),
                           F.col("r.bands").alias("bands")),
                   "minhash-classes")
    in_band = classes.select("node", "n", F.explode("bands").alias("bucket"))
    crowded = in_band.groupBy("bucket").agg(F.count(F.lit(1)).alias("many")).where("many > 1")
    member = land(in_band.join(crowded, "bucket").distinct(), "minhash-buckets")

    label = None
    if not member.isEmpty():
        nodes = member.select("node").distinct().groupBy(F.col("node._id").alias("_node_id")) \
            .agg(F.collect_list("node.key1").alias("_keys"))
        wanted = pairs.join(nodes, F.col("_id") == F.col("_node_id")).select("_id", "_text", "_keys")
        sets = land(wanted.mapInArrow(_sets(shingle), f"_id {id_type}, key1 bigint, shingles array<bigint>, "
                                      "bits array<bigint>")
                    .select(F.struct("_id", "key1").alias("node"), "shingles", "bits"), "minhash-sets")
        label = _components(member, sets, percent)
    named = sketch.join(classes.select("key1", "key2", "node"), ["key1", "key2"], "left")
    if label is None:
        component = F.col("node")
    else:
        named = named.join(label, "node", "left")
        component = F.coalesce("component", "node")
    named = named.withColumn("_top", component)
    alone = (F.col("n_shingles") == 0) | F.col("_id").isNull()
    return named.select("_id", "_hash", "n_shingles", "key1",
                        F.when(alone, F.col("_id")).otherwise(F.col("_top._id")).alias("component_id"),
                        (alone | ((F.col("_top._id") == F.col("_id")) & (F.col("_top.key1") == F.col("key1"))))
                        .alias("kept"))


def _linked(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The (a, b) pairs that are links on the full sets, with their other columns."""
    left = sets.select(F.col("node").alias("a"), F.col("shingles").alias("sa"), F.col("bits").alias("xa"))
    right = sets.select(F.col("node").alias("b"), F.col("shingles").alias("sb"), F.col("bits").alias("xb"))
    # bits that differ stand for as many shingles that differ at least, so this test loses no link
    differ = sum((F.bit_count(F.col("xa")[i].bitwiseXOR(F.col("xb")[i])) for i in range(BIT_WORDS)), F.lit(0))
    likely = differ * (100 + percent) <= (100 - percent) * (F.size("sa") + F.size("sb"))
    common = F.when(likely, F.size(F.array_intersect("sa", "sb")).cast("long"))
    return (pairs.join(left, "a").join(right, "b").withColumn("common", common)
            .where(100 * F.col("common") >= percent * (F.size("sa") + F.size("sb") - F.col("common")))
            .select(*pairs.columns))


def _components(member: DataFrame, sets: DataFrame, percent: int) -> DataFrame | None:
    """(node, component) of linked nodes: star edges to each bucket's most popular
    member, then the pairs that a bucket's differences to a hub leave possible."""
    popular = member.groupBy("node").agg((-F.sum("many")).alias("p"))
    here = land(member.join(popular, "node").select("bucket", "node", "n", "p"), "minhash-members")
    centre = land(here.groupBy("bucket").agg(F.min(F.struct("p", "node", "n")).alias("r"))
                  .select("bucket", F.col("r.node").alias("a"), F.col("r.n").alias("na")), "minhash-centres")
    star = here.join(centre, "bucket").where(
        (F.col("node") != F.col("a")) & (100 * F.least("n", "na") >= percent * F.greatest("n", "na"))) \
        .select("a", F.col("node").alias("b")).distinct()
    found = land(_linked(star, sets, percent), "minhash-links")
    label = None if found.isEmpty() else land(connected_components(found), "minhash-labels")
    info = here.select("node", "p").distinct()
    info = info.withColumn("c", F.col("node")) if label is None else \
        info.join(label, "node", "left").select("node", "p", F.coalesce("component", "node").alias("c"))
    hubs = info.groupBy("c").agg(F.min(F.struct("p", "node")).alias("hub"))
    info = land(info.join(hubs, "c").select("node", "c", F.struct("hub.p", "hub.node", "c").alias("hub")), "minhash-hubs")
    more = land(_between(here, centre, info, sets, percent), "minhash-between")
    for done in (here, centre, info, found):
        discard(done)
    if more.isEmpty():
        return label
    joined = connected_components(more)  # of labels
    if label is None:
        return joined
    top = joined.select(F.col("node").alias("component"), F.col("component").alias("top"))
    named = label.join(top, "component", "left").select("node", F.coalesce("top", "component").alias("component"))
    # a label is its group's smallest node, which has no row of its own
    return named.union(joined)


def _between(here: DataFrame, centre: DataFrame, info: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links, as (a, b) of labels, between members of a bucket that its star has
    left under several labels.

    Such a bucket is seen from the hub (the most popular node) of one of its
    labels. With D(x) the shingles in which x and the hub differ, x and y are
    linked when |D(x) ^ D(y)| <= t (|x| + |y|), t = (100 - percent) / (100 + percent),
    so when they share at least (|D(x)| + |D(y)| - t (|x| + |y|)) / 2 differences.
    Nodes linked with the hub have one label; of another pair one node at least is
    not linked with it, which bounds that number from below for each node on its
    own. A link's two nodes therefore share one of the first differences of each,
    in an order common to all (added shingles before missing ones), not further
    back than the number allows. Only pairs that meet there are compared in full."""
    more, less = 100 + percent, 100 - percent
    rest = here.join(centre.select("bucket", F.col("a").alias("node")), ["bucket", "node"], "left_anti") \
        .join(info, "node")
    mixed = rest.groupBy("bucket").agg(F.min("c").alias("lo"), F.max("c").alias("hi"), F.min("hub").alias("hub")) \
        .where("lo <> hi").select("bucket", F.col("hub.node").alias("a"), F.col("hub.c").alias("ca"))
    pairs = rest.join(mixed, "bucket").where(F.col("node") != F.col("a")) \
        .select("a", "ca", F.col("node").alias("b"), F.col("c").alias("cb")).distinct()
    seen = pairs.join(sets.select(F.col("node").alias("a"), F.col("shingles").alias("sa")), "a") \
        .join(sets.select(F.col("node").alias("b"), F.col("shingles").alias("sb")), "b") \
        .withColumn("differ", F.concat(F.array_except("sb", "sa"), F.array_except("sa", "sb"))) \
        .select("a", "ca", "b", "cb", "differ", F.size("differ").cast("long").alias("d"),
                F.size("sb").cast("long").alias("n"), F.size("sa").cast("long").alias("na")) \
        .withColumn("over", more * F.col("d") - less * (F.col("n") + F.col("na")))
    shared = F.when(F.col("over") > 0, F.ceil(F.col("over") / 200)) \
        .otherwise(F.ceil((more * F.col("d") + less * (F.col("na") - F.col("n"))) / (2 * more)))
    first = F.col("d") - F.greatest(shared, F.lit(1)) + 1
    seen = land(seen.select("a", "ca", "b", "cb", "d", "n", "over",
                            F.slice("differ", F.lit(1), F.greatest(first, F.lit(0)).cast("int")).alias("differ")),
                "minhash-differences")
    place = land(seen.select("a", F.posexplode("differ").alias("at", "value"), "b", "cb", "d", "n",
                             (F.col("over") > 0).alias("outside")), "minhash-places")
    x = place.where("outside").select("a", "value", *[F.col(k).alias(f"{k}_x") for k in ("b", "cb", "d", "n", "at")])
    y = place.select("a", "value", "outside", *[F.col(k).alias(f"{k}_y") for k in ("b", "cb", "d", "n", "at")])
    need = more * (F.col("d_x") + F.col("d_y")) - less * (F.col("n_x") + F.col("n_y"))  # 2 * more times the number
    back = lambda k: 2 * more * (F.col(f"d_{k}") - F.col(f"at_{k}")) >= need
    possible = x.join(y, ["a", "value"]).where(
        (F.col("cb_x") != F.col("cb_y")) & (~F.col("outside") | (F.col("b_x") < F.col("b_y")))
        & (100 * F.least("n_x", "n_y") >= percent * F.greatest("n_x", "n_y")) & back("x") & back("y"))
    met = possible.select(F.col("b_x").alias("a"), F.col("b_y").alias("b"),
                          F.col("cb_x").alias("ca"), F.col("cb_y").alias("cb")).distinct()
    near_hub = seen.where((F.col("over") <= 0) & (F.col("ca") != F.col("cb"))).select("ca", "cb")
    return _linked(met, sets, percent).select("ca", "cb").union(near_hub).distinct() \
        .select(F.col("ca").alias("a"), F.col("cb").alias("b"))


def dedupe(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 5,
           percent: int = 80) -> DataFrame:
    """The input without near duplicates: of each component one row of the smallest
    id stays, with the text that represents it there; rows without id stay. Of rows
    with the same id and text one stays, also where they are wordless."""
    rows = docs.select(F.col(f"`{id_col}`").alias("_id"), F.xxhash64(text_or_empty(text_col)).alias("_hash"),
                       F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"))
    own = F.when(F.col("n_shingles") == 0, F.col("_hash"))  # wordless texts are alike in nothing
    kept = _judged(docs, id_col, text_col, shingle, percent).where(F.col("kept") & F.col("_id").isNotNull()) \
        .groupBy("_id", "key1", own.alias("_own")).agg(F.min("_hash").alias("_kept_hash")) \
        .select(F.col("_id").alias("_kept_id"), "_kept_hash")
    named = rows.where("_id IS NOT NULL").join(
        kept, (F.col("_id") == F.col("_kept_id")) & (F.col("_hash") == F.col("_kept_hash")), "left_semi")
    return named.dropDuplicates(["_id", "_hash"]).unionByName(rows.where("_id IS NULL")).select("_row.*")
