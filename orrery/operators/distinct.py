"""Columns evaluated once per distinct value instead of once per row."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orrery.operators.skew import HOT_SHARE
from orrery.plans.staging import staged

#: Distinct values up to which the results are broadcast.
MAX_DISTINCT = 200_000


def per_distinct(df: DataFrame, inputs: list[str], outputs: dict[str, Column], evaluate: DataFrame | None = None) -> DataFrame:
    """``df`` with the columns ``outputs``, each a function of the ``inputs`` alone.

    The distinct combinations of ``inputs``, nulls included, are counted where the rows
    are, the columns are evaluated over these only, written, and brought back by a
    join on equal or equally missing values. Up to MAX_DISTINCT results are broadcast.
    Beyond, rows meet them by a shuffle, in which the combinations that hold more than
    one in HOT_SHARE of the rows are broadcast instead, so that none crowds a task.

    A column of ``df`` that has an output's name is replaced. ``evaluate`` names another
    table whose rows give the combinations (a table that holds at least those of ``df``).
    """
    counted = (df if evaluate is None else evaluate).groupBy(*inputs).agg(F.count("*").alias("_rows"))
    results = staged(counted.select(*inputs, "_rows", *[c.alias(f"_out_{n}") for n, c in outputs.items()]), "distinct")
    return brought_back(df, results, inputs, list(outputs))


def brought_back(df: DataFrame, results: DataFrame, inputs: list[str], outputs: list[str]) -> DataFrame:
    """``df`` joined to a written table of ``results``, one row per combination of
    ``inputs``: how many rows of ``df`` hold it (``_rows``) and a column ``_out_<name>``
    for each of ``outputs``."""
    found = results.select(*[F.col(c).alias(f"_in_{c}") for c in inputs], "_rows", *[f"_out_{n}" for n in outputs])
    size = found.agg(F.count("*").alias("n"), F.sum("_rows").alias("rows")).first()

    def joined(rows: DataFrame, table: DataFrame, how: str = "inner") -> DataFrame:
        same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_in_{c}")) for c in inputs])
        return rows.join(table, same, how)

    if size["n"] <= MAX_DISTINCT:
        both = joined(df, F.broadcast(found))
    else:
        hot = F.col("_rows") > size["rows"] // HOT_SHARE
        few, many = F.broadcast(found.where(hot)), found.where(~hot)
        others = joined(df, few, "left_anti")
        both = joined(df, few).unionByName(joined(others, many))
    kept = [F.col(c) if c not in outputs else F.col(f"_out_{c}").alias(c) for c in df.columns]
    return both.select(*kept, *[F.col(f"_out_{n}").alias(n) for n in outputs if n not in df.columns])
