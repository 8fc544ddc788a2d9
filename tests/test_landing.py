"""Landing files (Parquet and JSON lines) read with declared schemas."""

from pyspark.sql import functions as F

from strata.operators import transform as tr
from strata.plans import fixtures as fx
from strata.schemas import LINE_FIELDS, MOVE_FIELDS
from strata.sources import landing


def test_parquet_landing_round_trip(spark, sf_dir, tmp_path):
    h_path, l_path = str(tmp_path / "moves"), str(tmp_path / "lines")
    fx.raw_headers(spark, sf_dir).write.parquet(h_path)
    fx.raw_lines(spark, sf_dir).write.parquet(l_path)
    heads = landing.read_raw_headers(spark, h_path, fmt="parquet")
    lines = landing.read_raw_lines(spark, l_path, fmt="parquet")
    assert heads.columns == MOVE_FIELDS and lines.columns == LINE_FIELDS
    h, ln, rej = tr.transform(heads, fx.tax_dimension(spark, sf_dir), lines, tax_bounded=True)
    h2, ln2, _ = tr.transform(fx.raw_headers(spark, sf_dir), fx.tax_dimension(spark, sf_dir),
                              fx.raw_lines(spark, sf_dir), tax_bounded=True)
    assert h.exceptAll(h2).isEmpty() and ln.exceptAll(ln2).isEmpty()
    assert h.count() + rej.count() == heads.count()


def test_nested_json_landing(spark, sf_dir, tmp_path):
    path = str(tmp_path / "nested")
    nested = tr.nest_lines(fx.raw_headers(spark, sf_dir), fx.raw_lines(spark, sf_dir))
    nested.write.json(path)
    back = landing.read_raw_headers(spark, path, fmt="json", nested=True)
    _, lines, _ = tr.transform(back, fx.tax_dimension(spark, sf_dir), tax_bounded=True)
    _, direct, _ = tr.transform(nested, fx.tax_dimension(spark, sf_dir), tax_bounded=True)
    assert lines.count() == direct.count() > 0
    assert lines.select(F.sum("quantity")).first()[0] == direct.select(F.sum("quantity")).first()[0]
