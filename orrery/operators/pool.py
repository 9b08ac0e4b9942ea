"""Pooling of repeat measurements by their uncertainties."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orrery.operators.skew import join_counted, split_counted
from orrery.plans.staging import staged


def pool(
    df: DataFrame,
    pairs: list[tuple[str, str]],
    key: str = "designation",
    first_by: str = "diameter_sigma_km",
    texts: tuple[str, ...] = (),
    flags: tuple[str, ...] = (),
    count: str = "n_fits",
    ties: tuple[str, ...] = (),
) -> DataFrame:
    """One row per key.

    Each (value, sigma) pair is pooled with weights 1 / sigma^2; fits without a
    sigma count only where no fit of the key has one, and then equally. The pooled
    sigma is the larger of the formal one and the weighted scatter. A key with a
    single fit passes through. Texts are joined in the order of ``first_by``,
    flags are true if any is, other columns come from the row with the smallest
    ``first_by``.

    The scatter about the pooled mean is taken with deviations from a value of
    the key's own (its largest), so that mean and scatter come from one
    aggregation without the cancellation of raw second moments. A key with very
    many fits meets that value where its rows are (``join_counted``) and is summed
    there. Ties of ``first_by`` go to the smaller ``ties``, then to a hash. The texts of
    other keys are listed row by row, once.
    """
    df = staged(df.where(F.col(key).isNotNull()), "measurements")  # read several times below
    rest = [c for c in df.columns if c != key and c not in {x for p in pairs for x in p} and c not in texts and c not in flags and c != count]
    pivots = df.groupBy(key).agg(
        F.count("*").alias("_rows"),
        *[F.max(v).alias(f"_at_{v}") for v, _ in pairs],
        *[F.bool_or(F.coalesce(_weighted(v, s), F.lit(False))).alias(f"_any_{v}") for v, s in pairs],
    )
    pivots = staged(pivots, "pivots")
    shared = join_counted(df, pivots, key, "_rows")
    aggs: list[Column] = [F.count("*").alias("_n")]
    for v, s in pairs:
        w = F.when(_weighted(v, s), 1 / (F.col(s) * F.col(s))).when(
            ~F.col(f"_any_{v}") & F.col(v).isNotNull(), F.lit(1.0)
        )
        x = F.col(v) - F.col(f"_at_{v}")
        aggs += [
            F.sum(w).alias(f"_w_{v}"),
            F.sum(w * x).alias(f"_wx_{v}"),
            F.sum(w * x * x).alias(f"_wxx_{v}"),
            F.max(f"_at_{v}").alias(f"_at_{v}"),
            F.bool_or(f"_any_{v}").alias(f"_any_{v}"),
            F.max(v).alias(f"_v_{v}"),
            F.max(s).alias(f"_s_{v}"),
        ]
    order = F.struct(F.coalesce(F.col(first_by), F.lit(float("inf"))).alias("first"), *ties, F.xxhash64(*df.columns).alias("hash"))
    aggs += [F.min_by(F.struct(F.col(c).alias("v")), F.when(F.col(c).isNotNull(), order))["v"].alias(c) for c in rest]
    aggs += [F.bool_or(F.coalesce(F.col(c), F.lit(False))).alias(c) for c in flags]
    aggs += [(F.sum(count) if count in df.columns else F.count("*")).alias(count)]
    out = shared.groupBy(key).agg(*aggs)
    new: dict[str, Column] = {}
    for v, s in pairs:
        mean = F.col(f"_wx_{v}") / F.col(f"_w_{v}")
        formal = F.when(F.col(f"_any_{v}"), 1 / F.sqrt(f"_w_{v}"))
        scatter = F.sqrt(F.greatest(F.lit(0.0), F.col(f"_wxx_{v}") / F.col(f"_w_{v}") - mean * mean))
        one = F.col("_n") == 1
        new[v] = F.when(one, F.col(f"_v_{v}")).otherwise(F.col(f"_at_{v}") + mean)
        new[s] = F.when(one, F.col(f"_s_{v}")).otherwise(F.greatest(formal, scatter))
    out = out.withColumns(new)
    if texts:
        hot, cold = split_counted(df, pivots, key, "_rows")
        joined = _listed_texts(cold, key, texts, order)
        if hot is not None:
            joined = joined.unionByName(_joined_texts(hot, key, texts, order))
        out = out.join(joined, key, "left")
    order_of = [c for c in df.columns if c != count]
    return out.select(*order_of, count)


def _weighted(v: str, s: str) -> Column:
    return (F.col(s) > 0) & F.col(v).isNotNull()


def _listed_texts(df: DataFrame, key: str, texts: tuple[str, ...], order: Column) -> DataFrame:
    """(key, *texts) as ``_joined_texts`` has them, for keys with so few rows that these
    may be listed: one shuffle, and every text is split once."""
    rows = df.select(key, F.struct(order.alias("o"), *texts).alias("r")).where(F.coalesce(*[F.col(f"r.{c}") for c in texts]).isNotNull())
    listed = rows.groupBy(key).agg(F.sort_array(F.collect_list("r")).alias("all"))

    def pieces(c: str) -> Column:
        whole = F.array_join(F.array_distinct(F.array_compact(F.col(f"all.{c}"))), "|")
        return F.nullif(F.array_join(F.array_distinct(F.split(whole, r"\|")), "|"), F.lit(""))

    return listed.select(key, *[pieces(c).alias(c) for c in texts])


def _joined_texts(df: DataFrame, key: str, texts: tuple[str, ...], order: Column) -> DataFrame:
    """(key, *texts): the different pieces of each text, split on the pipe, in the
    order of the first row that has each. Pieces are made distinct before they are
    gathered, so a list is no longer than the text that it becomes."""
    each = F.explode(F.array(*[F.struct(F.lit(c).alias("name"), F.col(c).alias("text")) for c in texts]))
    rows = df.select(key, order.alias("o"), each.alias("x")).where("x.text is not null")
    pieces = rows.select(key, "x.name", "o", F.posexplode(F.split("x.text", r"\|")).alias("at", "piece"))
    first = pieces.groupBy(key, "name", "piece").agg(F.min(F.struct("o", "at")).alias("o"))
    listed = first.groupBy(key, "name").agg(F.array_sort(F.collect_list(F.struct("o", "piece"))).alias("all"))
    joined = listed.select(key, "name", F.nullif(F.array_join(F.col("all.piece"), "|"), F.lit("")).alias("text"))
    return joined.groupBy(key).agg(*[F.max(F.when(F.col("name") == c, F.col("text"))).alias(c) for c in texts])
