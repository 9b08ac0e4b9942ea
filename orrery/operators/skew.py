"""A join that no hot key can stall."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A key is hot if it holds more than one in HOT_SHARE of the rows, so that fewer
#: than HOT_SHARE keys are hot, however large the tables.
HOT_SHARE = 1000


def split_counted(rows: DataFrame, table: DataFrame, key: str, count: str) -> tuple[DataFrame | None, DataFrame]:
    """The rows of hot keys, None where no key is hot, and the others; ``table`` as for
    ``join_counted``. Rows stay where they are."""
    total = table.agg(F.sum(count)).first()[0] or 0
    hot = table.where(F.col(count) > total // HOT_SHARE).select(key)
    if hot.isEmpty():
        return None, rows
    return tuple(rows.join(F.broadcast(hot), key, how) for how in ("left_semi", "left_anti"))


def join_counted(rows: DataFrame, table: DataFrame, key: str | list[str], count: str) -> DataFrame:
    """``rows`` joined to ``table`` on ``key``, a column or several.

    ``table`` is a written table with one row per key and, in ``count`` (dropped),
    how many of ``rows`` hold it. Its rows of hot keys are broadcast, so the rows
    that hold them stay where they are; the others are joined by a shuffle in which
    no key has more than a small share.
    """
    total = table.agg(F.sum(count)).first()[0] or 0
    is_hot = F.col(count) > total // HOT_SHARE
    hot, cold = table.where(is_hot).drop(count), table.where(~is_hot).drop(count)
    if hot.isEmpty():
        return rows.join(cold, key)
    others = rows.join(F.broadcast(hot.select(key)), key, "left_anti")
    return rows.join(F.broadcast(hot), key).unionByName(others.join(cold, key))
