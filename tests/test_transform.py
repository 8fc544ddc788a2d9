"""Raw record -> domain rows: flattening, defaults, tax, rejects."""

from pyspark.sql import functions as F

from strata.operators import transform as tr
from strata.schemas import RAW_LINE, RAW_MOVE, RAW_MOVE_NESTED, TAX


def raw_move(**kw):
    base = dict(id=1, name="INV/2024/0001", move_type="out_invoice", date="2024-01-15",
                partner_id=["7", "Acme Corp"], ref="", journal_id=["3", "Customer Invoices"], state="posted",
                payment_state="not_paid", company_id=["1", "My Co"], currency_id=["5", "CLP"],
                amount_untaxed=100.0, amount_tax=19.0, amount_total=119.0, line_ids=[], write_date=None)
    base.update(kw)
    return base


def raw_line(**kw):
    base = dict(id=10, move_id=["1", "INV/2024/0001"], product_id=["42", "Widget"], name="Widget line",
                quantity=2.0, price_unit=50.0, discount=0.0, price_subtotal=100.0, price_total=119.0,
                tax_ids=[1], account_id=["100", "Revenue"], debit=0.0, credit=119.0,
                write_date="2024-03-15 10:00:00")
    base.update(kw)
    return base


def tax(spark):
    return spark.createDataFrame([(1, 19.0)], TAX)


def test_flatten_and_defaults(spark):
    rows = [raw_move(), raw_move(id=2, partner_id=None, company_id=["9"], currency_id=None, name=None,
                                 state="false", amount_tax=None)]
    out = {r["id"]: r for r in tr.flatten_headers(spark.createDataFrame(rows, RAW_MOVE)).collect()}
    a, b = out[1], out[2]
    assert (a.partner_id, a.partner_name, a.company_name, a.currency_name) == (7, "Acme Corp", "My Co", "CLP")
    assert (b.partner_id, b.partner_name) == (0, "")
    assert (b.company_id, b.company_name) == (9, "")
    assert b.currency_name == "CLP" and b.name == "" and b.state == "" and b.amount_tax == 0.0


def test_tax_amount_and_rate(spark):
    lines = [raw_line(), raw_line(id=11, price_subtotal=0.0, price_total=50.0, tax_ids=None),
             raw_line(id=12, tax_ids=[8, 1])]
    h = tr.normalize_headers(spark.createDataFrame([raw_move()], RAW_MOVE))
    out = {r["id"]: r for r in tr.normalize_lines(spark.createDataFrame(lines, RAW_LINE), h, tax(spark)).collect()}
    assert out[10].tax_amount == 19.0 and out[10].tax_rate == 19.0
    assert out[11].tax_amount == 0.0 and out[11].tax_ids == [] and out[11].tax_rate == 0.0
    assert out[12].tax_rate == 0.0  # only the first tax counts; 8 is unknown
    assert out[10].account_move_id == 1 and str(out[10].date) == "2024-01-15"
    assert out[10].description == "Widget line"


def test_rejects_missing_id_and_date(spark):
    rows = [raw_move(id=1), raw_move(id=0), raw_move(id=3, date=None), raw_move(id=4, date="")]
    raw = spark.createDataFrame(rows, RAW_MOVE)
    assert [r.id for r in tr.valid_records(raw).collect()] == [1]
    rej = {r.id: r.reject_reason for r in tr.rejected_records(raw).collect()}
    assert rej == {0: "missing_id", 3: "missing_date", 4: "missing_date"}


def test_rejected_header_takes_its_lines(spark):
    raw = spark.createDataFrame([raw_move(id=1, date=None)], RAW_MOVE)
    h, lines, rej = tr.transform(raw, tax(spark), spark.createDataFrame([raw_line()], RAW_LINE))
    assert h.count() == 0 and lines.count() == 0 and rej.count() == 1


def test_line_with_falsy_parent_is_dropped(spark):
    raw = spark.createDataFrame([raw_move()], RAW_MOVE)
    lines = spark.createDataFrame([raw_line(), raw_line(id=11, move_id=None)], RAW_LINE)
    _, out, _ = tr.transform(raw, tax(spark), lines)
    assert [r.id for r in out.collect()] == [10]


def test_cursor_parsed_and_truncated(spark):
    raw = spark.createDataFrame([raw_move(write_date="2024-03-15 10:00:00.123456")], RAW_MOVE)
    h = tr.normalize_headers(raw).first()
    assert str(h.write_date) == "2024-03-15 10:00:00"


def test_nested_round_trip(spark):
    raw = spark.createDataFrame([raw_move(), raw_move(id=2)], RAW_MOVE)
    lines = spark.createDataFrame([raw_line(), raw_line(id=11)], RAW_LINE)
    nested = tr.nest_lines(raw, lines)
    assert {r.id: [x.id for x in r._lines] for r in nested.collect()} == {1: [10, 11], 2: []}
    _, out, _ = tr.transform(nested, tax(spark))
    assert sorted(r.id for r in out.collect()) == [10, 11]


def test_json_landing_false_values(spark, tmp_path):
    p = tmp_path / "moves.json"
    p.write_text('{"id": 5, "date": "2024-01-02", "partner_id": false, "currency_id": [2, "USD"], '
                 '"state": false, "amount_total": false, "_lines": [{"id": 50, "quantity": 1, "tax_ids": false}]}\n')
    raw = spark.read.schema(RAW_MOVE_NESTED).json(str(p))
    h, lines, _ = tr.transform(raw, tax(spark))
    r = h.first()
    assert (r.partner_id, r.partner_name, r.currency_name, r.state, r.amount_total) == (0, "", "USD", "", 0.0)
    line = lines.first()
    assert line.account_move_id == 5 and line.tax_ids == [] and line.tax_rate == 0.0


def test_stamp_requires_batch_id(spark):
    import pytest
    with pytest.raises(ValueError):
        tr.stamp(spark.range(1), "2024-01-01 00:00:00", "")
