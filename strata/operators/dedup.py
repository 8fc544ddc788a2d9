"""Latest-version deduplication: exactly one row per key.

``row_number() over (partition by key order by ...) = 1``.  Catalyst plans a
partial ``WindowGroupLimit`` before the shuffle, so every map task ships at
most one row per key: a hot key holding a third of all rows is cut down
map-side, not funnelled whole into one reducer.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def order_terms(order: Sequence[str | Column]) -> list[Column]:
    """Parse ``"col desc"``-style terms.  DESC sorts NULLs last, ASC first,
    unless ``nulls first|last`` is spelled out."""
    out: list[Column] = []
    for term in order:
        if isinstance(term, Column):
            out.append(term)
            continue
        parts = term.split()
        name, rest = parts[0], [p.lower() for p in parts[1:]]
        desc = "desc" in rest
        nulls = None
        if "nulls" in rest:
            nulls = rest[rest.index("nulls") + 1]
        c = F.col(name)
        if desc:
            out.append(c.desc_nulls_first() if nulls == "first" else c.desc_nulls_last())
        else:
            out.append(c.asc_nulls_last() if nulls == "last" else c.asc_nulls_first())
    return out


def dedup_latest(df: DataFrame, key: Sequence[str] | str, order: Sequence[str | Column],
                 rn_col: str = "_rn") -> DataFrame:
    """Keep the first row per ``key`` under ``order``; all columns kept."""
    keys = [key] if isinstance(key, str) else list(key)
    w = Window.partitionBy(*keys).orderBy(*order_terms(order))
    return df.withColumn(rn_col, F.row_number().over(w)).filter(F.col(rn_col) == 1).drop(rn_col)


def full_order(df: DataFrame, key: Sequence[str] | str, order: Sequence[str]) -> list[str]:
    """``order`` extended with every remaining column (descending) so that the
    winner is deterministic even when the given order ties (maps have no order)."""
    keys = {key} if isinstance(key, str) else set(key)
    named = {t.split()[0] for t in order}
    rest = [f"{f.name} desc" for f in df.schema.fields
            if f.name not in keys and f.name not in named
            and "map<" not in f.dataType.simpleString()]
    return [*order, *rest]
