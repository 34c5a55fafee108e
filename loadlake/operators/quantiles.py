"""Exact order statistics for groups of any size."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loadlake.functions.numeric import nearest_rank, value_bucket
from loadlake.operators.keys import join_null_safe


def exact_quantiles(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    nearest: Mapping[str, float] | None = None,
    median: str | None = None,
    *,
    count: str | None = None,
    mean: str | None = None,
    std: str | None = None,
) -> DataFrame:
    """One row per group: ``keys``, the nearest-rank quantiles named in ``nearest``, the midpoint median, and if named
    the number of values, their mean and sample deviation. Groups without values have a row only if ``count`` is named.

    The input is scanned once, and groups of any size take the same way:

    1. Equal values of a group are counted, which merges them in the map tasks.
    2. They are placed by (group, value bucket), so a hot group is spread over its buckets, and numbered in each.
    3. A group's buckets, a few thousand at most, give the places at which buckets start, hence where each rank falls.
    4. Only the values at these ranks go on to the result.
    """
    keys = list(keys)
    nearest = dict(nearest or {})
    v, vn = F.col("__v"), F.col("__vn")
    counted = df.select(*keys, F.col(value).cast("double").alias("__v")).groupBy(*keys, "__v").agg(F.count("__v").alias("__vn"))
    if count is None:
        counted = counted.where(v.isNotNull())
    bucket = Window.partitionBy(*keys, "__b")
    running = bucket.orderBy("__v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    numbered = counted.withColumn("__b", value_bucket(v)).withColumn("__end", F.sum("__vn").over(running))
    numbered = numbered.withColumn("__bmean", F.sum(v * vn).over(bucket) / F.nullif(F.sum(vn).over(bucket), F.lit(0)))

    buckets = numbered.groupBy(*keys, "__b").agg(
        F.sum("__vn").alias("__bn"), F.max("__bmean").alias("__bmean"), F.sum(vn * (v - F.col("__bmean")) ** 2).alias("__bm2")
    )
    group = Window.partitionBy(*keys)
    upto = group.orderBy("__b").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    bn, n = F.col("__bn"), F.col("__n")
    located = buckets.withColumns({"__n": F.sum(bn).over(group), "__before": F.sum(bn).over(upto) - bn})
    located = located.withColumn("__mean", F.sum(F.col("__bmean") * bn).over(group) / F.nullif(n, F.lit(0)))
    spread = F.sum(F.coalesce(F.col("__bm2") + bn * (F.col("__bmean") - F.col("__mean")) ** 2, F.lit(0.0))).over(group)
    located = located.withColumn("__std", F.when(n > 1, F.sqrt(spread / (n - 1))))
    ranks = _ranks(n, nearest, median)
    places = {name: f"__k{i}" for i, name in enumerate(ranks)}
    located = located.select("*", *[rank.cast("long").alias(places[name]) for name, rank in ranks.items()])

    def inside(k: str, start: Column, size: Column) -> Column:
        return (F.col(k) >= start) & (F.col(k) < start + size)

    wanted = n == 0
    for k in places.values():
        wanted = wanted | inside(k, F.col("__before"), bn)
    targets = located.where(wanted).select(*keys, "__b", "__before", "__n", "__mean", "__std", *places.values())
    start = F.col("__before") + F.col("__end") - vn
    picked = join_null_safe(numbered.select(*keys, "__b", "__v", "__vn", "__end"), targets, [*keys, "__b"]).groupBy(*keys).agg(
        *[F.max(F.when(inside(k, start, vn), v)).alias(name) for name, k in places.items()],
        *[F.max(c).alias(c) for c in ("__n", "__mean", "__std")],
    )
    more = {count: F.coalesce("__n", F.lit(0)), mean: F.col("__mean"), std: F.col("__std")}
    return picked.select(*_named(keys, nearest, median), *[c.alias(name) for name, c in more.items() if name is not None])


def _ranks(n: Column, nearest: Mapping[str, float], median: str | None) -> dict[str, Column]:
    ranks = {name: nearest_rank(n, q) for name, q in nearest.items()}
    if median is not None:
        ranks["__low"] = F.floor((n - 1) / 2)
        ranks["__high"] = F.floor(n / 2)
    return ranks


def _named(keys: list[str], nearest: Mapping[str, float], median: str | None) -> list[Column]:
    columns = [F.col(name) for name in (*keys, *nearest)]
    if median is not None:
        columns.append(((F.col("__low") + F.col("__high")) / 2).alias(median))
    return columns


def sorted_nearest(values: Column, q: float) -> Column:
    """Nearest-rank quantile of a sorted array; null when it is empty."""
    return F.get(values, nearest_rank(F.size(values), q).cast("int"))


def sorted_median(values: Column) -> Column:
    """Midpoint median of a sorted array; null when it is empty."""
    n = F.size(values)
    low = F.get(values, F.floor((n - 1) / 2).cast("int"))
    high = F.get(values, F.floor(n / 2).cast("int"))
    return (low + high) / 2
