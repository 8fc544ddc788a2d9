"""Hot keys: one header owning a third of all lines, prefix max across partitions."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from strata.operators import transform as tr
from strata.operators.batching import prefix_max
from strata.operators.extract import has_children
from strata.schemas import RAW_LINE, RAW_MOVE


def test_prefix_max_matches_brute_force(spark):
    df = spark.range(0, 3000).select(
        (F.col("id") % 3).alias("g"), F.col("id").alias("o"), ((F.col("id") * 7919) % 1000).alias("v"))
    got = prefix_max(df, "o", "v", "pm", group_col="g", num_partitions=7)
    w = Window.partitionBy("g").orderBy("o").rowsBetween(Window.unboundedPreceding, 0)
    want = df.withColumn("pm", F.max("v").over(w))
    assert got.select("g", "o", "pm").exceptAll(want.select("g", "o", "pm")).isEmpty()
    assert got.count() == 3000


def test_hot_header_is_complete(spark):
    n_hot, n_other = 3000, 6000
    heads = spark.range(1, 3002).select(F.col("id"), F.lit("2024-01-01").alias("date"))
    raw_h = spark.createDataFrame([], RAW_MOVE).unionByName(
        heads.select("id", "date"), allowMissingColumns=True)
    hot = spark.range(0, n_hot).select((F.col("id") + 1_000_000).alias("id"), F.lit(1).alias("p"))
    other = spark.range(0, n_other).select((F.col("id") + 2_000_000).alias("id"), (F.col("id") % 3000 + 2).alias("p"))
    lines = hot.unionByName(other).select(
        "id", F.array(F.col("p").cast("string"), F.lit("x")).alias("move_id"))
    raw_l = spark.createDataFrame([], RAW_LINE).unionByName(lines, allowMissingColumns=True)
    nested = tr.nest_lines(raw_h, raw_l)
    per = {r.id: (r.recs, r.n, r.biggest) for r in nested.groupBy("id").agg(
        F.count(F.lit(1)).alias("recs"), F.sum(F.size("_lines")).alias("n"),
        F.max(F.size("_lines")).alias("biggest")).collect()}
    recs, n, _ = per[1]
    assert n == n_hot and recs == 1      # one record per header, nothing lost
    assert sum(v[1] for v in per.values()) == n_hot + n_other
    parents = raw_l.select(tr.line_parent_id(raw_l).alias("account_move_id"))
    assert has_children(heads, parents).count() == 3001


def test_hot_header_transforms_once(spark):
    from strata.schemas import TAX

    raw_h = spark.createDataFrame([], RAW_MOVE).unionByName(
        spark.range(1, 3).select("id", F.lit("2024-01-01").alias("date")), allowMissingColumns=True)
    lines = spark.range(0, 2500).select((F.col("id") + 100).alias("id"), F.array(F.lit("1"), F.lit("x")).alias("move_id"))
    raw_l = spark.createDataFrame([], RAW_LINE).unionByName(lines, allowMissingColumns=True)
    nested = tr.nest_lines(raw_h, raw_l)
    assert nested.filter("id = 1").count() == 1
    heads, out, rej = tr.transform(nested, spark.createDataFrame([(1, 19.0)], TAX), tax_bounded=True)
    assert sorted(r.id for r in heads.collect()) == [1, 2]
    assert out.count() == 2500 and out.filter("account_move_id = 1 AND date = DATE'2024-01-01'").count() == 2500
    assert rej.count() == 0
