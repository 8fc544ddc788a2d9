"""Normalisation of raw source values: many2one pairs, defaults, truthiness."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def truthy(df: DataFrame, name: str) -> Column:
    """Source truthiness of a column: 0, '', NULL, false and [] are false."""
    dtype = df.schema[name].dataType
    c = F.col(name)
    if isinstance(dtype, T.BooleanType):
        return F.coalesce(c, F.lit(False))
    if isinstance(dtype, T.NumericType):
        return F.coalesce(c != 0, F.lit(False))
    if isinstance(dtype, T.StringType):
        # a JSON `false` read into a string column arrives as the text 'false'
        return F.coalesce((c != "") & (c != "false"), F.lit(False))
    if isinstance(dtype, (T.ArrayType, T.MapType)):
        return F.coalesce(F.size(c) > 0, F.lit(False))
    return c.isNotNull()


def m2o_id(col: Column | str) -> Column:
    """First element of an ``[id, label]`` pair as a long; falsy pair -> 0."""
    return F.coalesce(F.try_element_at(_c(col), F.lit(1)).try_cast("long"), F.lit(0).cast("long"))


def m2o_name(col: Column | str, default: str = "") -> Column:
    """Second element of an ``[id, label]`` pair; falsy or 1-element pair -> default."""
    return F.coalesce(F.try_element_at(_c(col), F.lit(2)), F.lit(default))


def text_default(col: Column | str, default: str = "") -> Column:
    """Absent, NULL and JSON ``false`` text all become ``default``."""
    c = _c(col)
    return F.coalesce(F.nullif(c, F.lit("false")), F.lit(default))


def to_double(col: Column | str) -> Column:
    """Float coercion; absent, NULL, ``false`` or non-numeric -> 0.0."""
    return F.coalesce(_c(col).try_cast("double"), F.lit(0.0))


def tax_amount(price_subtotal: Column | str, price_total: Column | str) -> Column:
    """``total - subtotal`` when the subtotal is non-zero, else 0.0."""
    sub, tot = to_double(price_subtotal), to_double(price_total)
    return F.when(sub != 0, tot - sub).otherwise(F.lit(0.0))


def tax_id_list(col: Column | str) -> Column:
    """Null-safe tax id list: falsy -> empty array."""
    return F.coalesce(_c(col), F.array().cast(T.ArrayType(T.LongType())))


def first_tax_id(col: Column | str) -> Column:
    """The lookup key of a tax list: its first id, NULL when empty."""
    return F.try_element_at(tax_id_list(col), F.lit(1))
