"""Bucketed Silver: only touched buckets are rewritten, and the result equals a full rebuild."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from strata.plans import silver as sv
from strata.schemas import BRONZE_MOVE
from strata.sinks import files

T = dt.datetime


def versions(spark, rows):
    """(id, state, day written, day ingested)"""
    full = [dict(id=i, name=f"M{i}", move_type="x", date=dt.date(2024, 1, 1 + i % 27), partner_id=1, partner_name="P",
                 company_id=1, company_name="C", journal_id=1, journal_name="J", currency_name="CLP",
                 amount_untaxed=1.0, amount_tax=0.0, amount_total=1.0, state=s, payment_state="", ref="",
                 write_date=T(2024, 2, w), synced_at=T(2024, 3, g), sync_batch_id=f"b{g}") for i, s, w, g in rows]
    return spark.createDataFrame(full, BRONZE_MOVE)


def business(df):
    return sorted((r.id, r.state, str(r.source_modified_at), str(r.ingested_at)) for r in df.collect())


FIRST = [(i, "draft", 5, 1) for i in range(200)]
# two newer versions, a late older version, a new id, and a tie on the look-back instant
SECOND = [(3, "posted", 9, 2), (90, "posted", 6, 2), (17, "late", 1, 2), (500, "new", 7, 2), (44, "tie", 5, 1)]


def test_refresh_rewrites_touched_buckets_only(spark, tmp_path):
    base = str(tmp_path / "silver")
    first = versions(spark, FIRST)
    m1 = sv.refresh(spark, first, base, sv.MOVES, BRONZE_MOVE, buckets=16)
    assert len(m1.builds) == 16 and m1.marks["lookback"] == "2024-03-01 00:00:00"
    bronze = first.unionByName(versions(spark, SECOND))
    m2 = sv.refresh(spark, bronze.filter("synced_at >= '2024-03-01' AND NOT (state = 'draft')"), base, sv.MOVES,
                    BRONZE_MOVE, buckets=16)
    table = sv.silver_table(spark, base, sv.MOVES, BRONZE_MOVE, 16)
    from strata.sinks.buckets import bucket_of
    touched = {r[0] for r in versions(spark, SECOND).select(bucket_of(("id",), 16)).distinct().collect()}
    assert {b for b in m1.builds if m2.builds[b] != m1.builds[b]} == touched and len(touched) < 16
    assert business(table.read()) == business(sv.silver_headers(bronze))
    got = {r.id: r.state for r in table.read().collect()}
    assert (got[3], got[17], got[500]) == ("posted", "draft", "new") and len(got) == 201
    assert m2.marks["lookback"] == "2024-03-02 00:00:00"


def test_refresh_equals_rebuild_over_many_steps(spark, tmp_path):
    base = str(tmp_path / "silver")
    bronze = None
    for day in range(1, 5):
        step = versions(spark, [((i * 7 * day) % 60, f"s{day}", 1 + (i * day) % 20, day) for i in range(25)])
        bronze = step if bronze is None else bronze.unionByName(step)
        sv.refresh(spark, bronze, base, sv.MOVES, BRONZE_MOVE, buckets=8)
        table = sv.silver_table(spark, base, sv.MOVES, BRONZE_MOVE, 8)
        assert business(table.read()) == business(sv.silver_headers(bronze))


def test_nothing_new_keeps_every_file(spark, tmp_path):
    base = str(tmp_path / "silver")
    rows = versions(spark, FIRST[:20])
    m1 = sv.refresh(spark, rows, base, sv.MOVES, BRONZE_MOVE, buckets=4)
    m2 = sv.refresh(spark, rows.filter("false"), base, sv.MOVES, BRONZE_MOVE, buckets=4)
    assert m2.builds == m1.builds and m2.marks == m1.marks and m2.number == m1.number + 1


def test_empty_bronze_then_rows(spark, tmp_path):
    base = str(tmp_path / "silver")
    rows = versions(spark, FIRST[:5])
    m = sv.refresh(spark, rows.filter("false"), base, sv.MOVES, BRONZE_MOVE, buckets=4)
    table = sv.silver_table(spark, base, sv.MOVES, BRONZE_MOVE, 4)
    assert m.builds == {} and table.read().count() == 0 and m.marks["lookback"] == sv.EPOCH
    sv.refresh(spark, rows, base, sv.MOVES, BRONZE_MOVE, buckets=4)
    assert table.read().count() == 5


def test_manifests_are_claimed_once_and_expire(spark, tmp_path):
    base = str(tmp_path / "silver")
    table = sv.silver_table(spark, base, sv.MOVES, BRONZE_MOVE, 4)
    for k in (1, 2, 3):
        last = table.replace(sv.silver_headers(versions(spark, FIRST[:10 * k])))
    with pytest.raises(RuntimeError):  # another writer took that number
        table._publish(last)
    assert len(files.names(spark, f"{base}/data")) == 3
    assert len(table.expire(keep=2, older_than=dt.timedelta(hours=1))) == 0
    assert len(table.expire(keep=1)) == 2
    assert table.read().count() == 30 and table.current().number == 3
    with pytest.raises(ValueError):  # another bucket count needs a rebuild
        sv.silver_table(spark, base, sv.MOVES, BRONZE_MOVE, 8).refresh(table.read(), lambda x: x)


def test_a_hot_key_is_cut_before_it_meets_its_bucket(spark, tmp_path):
    hot = versions(spark, [(1, "v", 1, 1)]).withColumn("_n", F.explode(F.sequence(F.lit(0), F.lit(4999)))) \
        .withColumn("write_date", F.col("write_date") + F.make_dt_interval(secs=F.col("_n"))).drop("_n")
    base = str(tmp_path / "silver")
    sv.refresh(spark, hot.unionByName(versions(spark, FIRST[2:10])), base, sv.MOVES, BRONZE_MOVE, buckets=4)
    got = sv.silver_table(spark, base, sv.MOVES, BRONZE_MOVE, 4).read()
    assert got.count() == 9 and str(got.filter("id = 1").first().source_modified_at) == "2024-02-01 01:23:19"
