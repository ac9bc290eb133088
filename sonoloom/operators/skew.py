"""Equi-joins that stay balanced when one key, or NULL, holds a large share of the rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

HOT_SHARE = 1_000
HOT_ROWS = 1_000_000
SALTS = 64


def hot_keys(df: DataFrame, key: str, hot_rows: int = HOT_ROWS) -> list:
    """Keys with at least ``hot_rows`` rows and more than 1/1000 of the table.

    The share bounds the result to 1000 values however large the table is.
    """
    counts = df.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    heavy = counts.filter(F.col("n") >= hot_rows)
    if heavy.isEmpty():
        return []
    rows = df.count()
    return [r[0] for r in heavy.filter(F.col("n") * HOT_SHARE > rows).select(key).take(HOT_SHARE)]


def join_lookup(
    facts: DataFrame,
    lookup: DataFrame,
    key: str,
    how: str = "inner",
    *,
    spread_by: Column | None = None,
    hot: Sequence = (),
    salts: int = SALTS,
) -> DataFrame:
    """Join ``facts`` to a lookup that is unique on ``key``, in one pass.

    Adaptive execution broadcasts a lookup that turns out small, and splits skewed partitions of the facts.  What it cannot see is
    done here: rows with a NULL key match nothing and are spread over tasks, and so are the rows of keys the caller knows to be
    ``hot`` (as ``hot_keys`` finds them), whose lookup rows are repeated ``salts`` times.
    """
    spread = F.pmod(F.xxhash64(spread_by if spread_by is not None else F.struct("*")), F.lit(salts)).cast("int")
    is_hot = F.col(key).isin(list(hot)) if hot else F.lit(False)
    left = facts.withColumn("_salt", F.when(F.col(key).isNull() | is_hot, spread).otherwise(F.lit(0)))
    copies = F.when(is_hot, F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))
    right = lookup.withColumn("_salt", F.explode(copies) if hot else F.lit(0))
    return left.join(right, [key, "_salt"], how).drop("_salt")
