"""Joins on keys where null equals null, and neighbour lookups that survive a hot key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def join_null_safe(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi-join on ``keys`` with null = null; the keys appear once, from ``left``."""
    renamed = right.select(
        *[F.col(k).alias(f"__r_{k}") for k in keys], *[c for c in right.columns if c not in keys]
    )
    condition = F.lit(True)
    for k in keys:
        condition = condition & F.col(k).eqNullSafe(F.col(f"__r_{k}"))
    joined = left.join(renamed, condition, how)
    if how in ("left_semi", "left_anti"):
        return joined
    return joined.drop(*[f"__r_{k}" for k in keys])


def with_previous(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], values: Sequence[str], block: Column
) -> DataFrame:
    """Add ``previous_<value>``: the values of the row before, per ``keys`` in ``order``.

    ``block`` cuts one key's order into stretches (a day, a range of ids) and must not decrease along it.
    Rows are only ever sorted inside (key, block), so a key holding most of the table is still spread over
    tasks. What crosses a block edge is one row: the last of the block before joins its block as a first row.
    """
    keys = list(keys)
    blocked = df.withColumn("__block", block)
    last_of_block = blocked.groupBy(*keys, "__block").agg(
        F.max_by(F.struct(*values), F.struct(*order)).alias("__last")
    )
    across = Window.partitionBy(*keys).orderBy("__block")
    carried = last_of_block.select(*keys, "__block", F.lag("__last").over(across).alias("__carried"))
    seeds = carried.where(F.col("__carried").isNotNull()).select(
        *keys, "__block", *[F.col("__carried")[v].alias(f"__value_{v}") for v in values], F.lit(0).alias("__own")
    )

    own = blocked.withColumns({**{f"__value_{v}": F.col(v) for v in values}, "__own": F.lit(1)})
    inside = Window.partitionBy(*keys, "__block").orderBy("__own", *order)
    before = F.lag(F.struct(*[f"__value_{v}" for v in values])).over(inside)
    met = own.unionByName(seeds, allowMissingColumns=True).withColumn("__before", before)
    return met.where(F.col("__own") == 1).select(
        *df.columns, *[F.col("__before")[f"__value_{v}"].alias(f"previous_{v}") for v in values]
    )
