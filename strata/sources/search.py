"""Domain search over a record frame: a conjunction of (field, op, value).

``("line_ids", "!=", False)`` on a relation that lives in another frame is a
left-semi join against that frame (``= False`` is the anti join)."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.functions.columns import truthy
from strata.functions.dates import parse_naive_utc
from strata.operators.dedup import order_terms

Term = tuple[str, str, Any]
_CMP = {
    "=": lambda c, v: c == v,
    "!=": lambda c, v: c != v,
    ">": lambda c, v: c > v,
    ">=": lambda c, v: c >= v,
    "<": lambda c, v: c < v,
    "<=": lambda c, v: c <= v,
    "in": lambda c, v: c.isin(list(v)),
    "not in": lambda c, v: ~c.isin(list(v)),
}


def _predicate(df: DataFrame, field: str, op: str, value: Any) -> Column:
    if op not in _CMP:
        raise ValueError(f"unsupported operator {op!r}")
    if value is False and op in ("=", "!="):
        t = truthy(df, field)
        return t if op == "!=" else ~t
    col = F.col(field)
    if isinstance(value, dt.datetime):
        # text cursors compare as instants, never as strings
        if df.schema[field].dataType.simpleString() == "string":
            col = parse_naive_utc(col)
        value = F.lit(value).cast("timestamp_ntz")
    return _CMP[op](col, value)  # a NULL comparison drops the row; nothing stands between it and the scan


def apply_domain(df: DataFrame, domain: Sequence[Term],
                 relations: dict[str, tuple[DataFrame, str]] | None = None, key: str = "id") -> DataFrame:
    relations = relations or {}
    local, joined = [], []
    for field, op, value in domain:
        if field in relations:  # the relation's frame wins over a local id-list column
            if value is not False or op not in ("=", "!="):
                raise ValueError(f"relation {field!r} supports only != False / = False")
            joined.append((field, op))
        else:
            local.append(_predicate(df, field, op, value))
    out = df.filter(reduce(lambda a, b: a & b, local)) if local else df
    for field, op in joined:
        other, fk = relations[field]
        parents = other.select(F.col(fk).alias("_parent")).distinct()  # pre-aggregate hot parents
        how = "left_semi" if op == "!=" else "left_anti"
        out = out.join(parents, out[key] == parents["_parent"], how)
    return out


def search(df: DataFrame, domain: Sequence[Term], order: Sequence[str] | None = None,
           limit: int | None = None, relations=None, key: str = "id") -> DataFrame:
    """-> ids matching the domain.  Empty order / zero limit are omitted; a
    limit without an order takes the smallest keys."""
    out = apply_domain(df, domain, relations, key)
    if limit and not order:
        order = [key]
    if order:
        out = out.orderBy(*order_terms(order))
    if limit:
        out = out.limit(limit)
    return out.select(key)


def search_read(df: DataFrame, domain: Sequence[Term], fields: Sequence[str],
                order: Sequence[str] | None = None, limit: int | None = None,
                relations=None, key: str = "id") -> DataFrame:
    out = apply_domain(df, domain, relations, key)
    if limit and not order:
        order = [key]
    if order:
        out = out.orderBy(*order_terms(order))
    if limit:
        out = out.limit(limit)
    return out.select(*fields)


def read_by_ids(df: DataFrame, ids: DataFrame, key: str = "id") -> DataFrame:
    """Records whose key is in ``ids``; ids that vanished return nothing."""
    i = ids.select(F.col(key).alias("_want")).distinct()
    return df.join(i, df[key] == i["_want"], "left_semi")
