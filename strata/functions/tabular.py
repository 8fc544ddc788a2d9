"""Normalisation of spreadsheet-like text tables (all cells text)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Header keywords (Spanish and English) that mark a numeric column.
NUMERIC_KEYWORDS = (
    "cantidad", "qty", "monto", "amount", "precio", "price", "bruto",
    "neto", "impuesto", "tax", "descuento", "discount", "total",
)

# A finite decimal number with optional exponent and surrounding blanks.
_NUMBER = r"^\s*[+-]?([0-9]+(\.[0-9]*)?|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$"


def strip_leading_quote(col: Column) -> Column:
    """Drop exactly one leading apostrophe (spreadsheet text marker)."""
    return F.regexp_replace(col, r"^'", "")


def is_numeric_header(name: str) -> bool:
    low = name.lower()
    return any(k in low for k in NUMERIC_KEYWORDS)


def number_of(col: Column) -> Column:
    """The finite number that a text holds, else NULL."""
    parsed = F.trim(col).try_cast("double")
    # finite values only: an overflowing literal such as 1e400 stays as it is
    return F.when(col.rlike(_NUMBER) & (F.abs(parsed) < F.lit(float("inf"))), parsed)


def number_text(num: Column, col: Column) -> Column:
    """Canonical text of ``num``: integral values without a fraction, others
    rounded to 2 places, never in scientific notation; ``col`` where it is NULL."""
    canon = (
        F.when(F.rint(num) == num, num.try_cast("decimal(38,0)").cast("string"))
        .when((num < 0) & (num > -0.005), F.lit("-0.0"))  # rounds to zero
        .otherwise(F.regexp_replace(F.round(num, 2).try_cast("decimal(38,2)").cast("string"), r"(\.[0-9])0$", "$1"))
    )
    return F.coalesce(F.when(num.isNotNull(), canon), col)


def normalize_number_text(col: Column) -> Column:
    """Numeric text -> canonical text; blank or non-numeric text is unchanged."""
    return number_text(number_of(col), col)


def normalize_tabular(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Apply quote stripping to every text column and number normalisation to
    columns whose header names a quantity, price, tax, discount or total.

    A cell is stripped once and parsed once: each of the three projections
    refers to the columns of the one before."""
    names = df.columns
    cols = columns or [f.name for f in df.schema.fields if f.dataType.simpleString() == "string"]
    numeric = {f"_num_{i}": n for i, n in enumerate(names) if n in cols and is_numeric_header(n)}
    at = {n: f"`{n}`" for n in names}
    bare = df.select(*[(strip_leading_quote(F.col(at[n])) if n in cols else F.col(at[n])).alias(n) for n in names])
    parsed = bare.select("*", *[number_of(F.col(at[n])).alias(k) for k, n in numeric.items()])
    num = {n: F.col(k) for k, n in numeric.items()}
    return parsed.select(*[(number_text(num[n], F.col(at[n])) if n in num else F.col(at[n])).alias(n) for n in names])
