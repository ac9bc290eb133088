"""Running totals, row numbers and blocks over a total order.

Two physical forms give the same rows:

* **window** - one window per key, used when the largest key was measured and fits a task;
* **split** - rows are range-partitioned on (keys, order), the partition number is frozen by
  a checkpoint, each partition is summed on its own, and the carry from earlier partitions
  is added.  A key that holds a third of all rows is spread over many tasks, and a
  total order over the whole table never meets in one task.

A range boundary splits at most one key, so at most (partitions - 1) rows carry a value:
the carry table is small whatever the input, and may be broadcast.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sonoloom.session import checkpointed

MAX_GROUP_ROWS = 1_000_000
LIMIT_ROWS = 1_000
PART_ROWS = 500_000

_PART = "_part"


def micros(seconds: Column | str) -> Column:
    """Seconds as whole microseconds, so sums are exact in any order of addition."""
    column = F.col(seconds) if isinstance(seconds, str) else seconds
    return F.round(column * 1_000_000).cast("bigint")


def largest_group(df: DataFrame, keys: Sequence[str]) -> int:
    """Rows of the largest key (0 for an empty table); partial counts, one number returned."""
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    return counts.agg(F.coalesce(F.max("n"), F.lit(0)).alias("n")).first()["n"]


def range_split(
    df: DataFrame, keys: Sequence[str], order_by: Sequence[Column], partitions: int | None = None
) -> DataFrame:
    """``df`` with a frozen range-partition number ``_part`` that follows (keys, order).

    Without ``partitions`` the session's shuffle partitions are used, and adaptive execution
    joins neighbouring small ones; the checkpoint keeps whatever numbers came out.  Beyond ``PART_ROWS`` rows
    there is at least one partition for as many rows, so a task's share does not grow with the table.
    """
    if partitions is None:
        # Written once: counting it, drawing the bounds and dealing it out would each run the input again.
        df = checkpointed(df)
        count = df.count()
        if count > PART_ROWS:
            partitions = max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-count // PART_ROWS))
    columns = [*[F.col(k).asc_nulls_first() for k in keys], *order_by]
    ranged = df.repartitionByRange(*([partitions] if partitions else []), *columns)
    return checkpointed(ranged.withColumn(_PART, F.spark_partition_id()))


def running_total(
    df: DataFrame,
    value: Column,
    order_by: Sequence[str | Column],
    partition_by: Sequence[str] = (),
    output: str = "running_total",
    *,
    ceiling: int | None = None,
    max_group_rows: int | None = None,
    partitions: int | None = None,
) -> DataFrame:
    """Add ``sum(value)`` from the first row of the key up to this row.

    With a ``ceiling`` (values must not be negative) only rows up to it are returned, and
    partitions that start beyond it are dropped before they are shuffled.
    """
    order = [F.col(o) if isinstance(o, str) else o for o in order_by]
    limit = MAX_GROUP_ROWS if max_group_rows is None else max_group_rows
    if partition_by and largest_group(df, partition_by) <= limit:
        window = Window.partitionBy(*partition_by).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
        total = df.withColumn(output, F.sum(value).over(window))
        return total if ceiling is None else total.filter(F.col(output) <= ceiling)

    parts = range_split(df.withColumn("_value", value), partition_by, order, partitions)
    # Every part stays a task of its own: dealt by hash, a task would sort as many parts as fall to it.
    parts = parts.repartitionById(max(1, parts.rdd.getNumPartitions()), F.col(_PART))
    keys = [*partition_by, _PART]
    inside = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    earlier = Window.partitionBy(*partition_by).orderBy(_PART).rowsBetween(Window.unboundedPreceding, -1)
    carry = (
        parts.groupBy(*keys)
        .agg(F.sum("_value").alias("_sum"))
        .withColumn("_carry", F.sum("_sum").over(earlier))
        .filter(F.col("_carry").isNotNull())
        .select(*[F.col(k).alias(f"_c_{k}") for k in keys], "_carry")
    )
    match = F.lit(True)
    for key in keys:
        match = match & F.col(key).eqNullSafe(F.col(f"_c_{key}"))
    placed = parts.join(F.broadcast(carry), match, "left").withColumn("_carry", F.coalesce("_carry", F.lit(0)))
    if ceiling is not None:
        placed = placed.filter(F.col("_carry") <= ceiling)
    total = placed.withColumn(output, F.sum("_value").over(inside) + F.col("_carry"))
    if ceiling is not None:
        total = total.filter(F.col(output) <= ceiling)
    return total.drop("_value", "_carry", _PART, *[f"_c_{k}" for k in keys])


def row_index(
    df: DataFrame,
    order_by: Sequence[str | Column],
    partition_by: Sequence[str] = (),
    output: str = "row_index",
    **sizes: int,
) -> DataFrame:
    """Dense position from 0 in the given total order, per key or over the whole table."""
    counted = running_total(df, F.lit(1).cast("bigint"), order_by, partition_by, output, **sizes)
    return counted.withColumn(output, F.col(output) - 1)


def blocks(df: DataFrame, size: int, order_by: Sequence[str | Column], output: str = "block", **sizes: int) -> DataFrame:
    """Consecutive blocks of ``size`` rows, numbered from 0; the last one may be short."""
    return row_index(df, order_by, output=output, **sizes).withColumn(
        output, F.floor(F.col(output) / F.lit(size)).cast("bigint")
    )


def first_rows(df: DataFrame, count: int, order_by: Sequence[str | Column], **sizes: int) -> DataFrame:
    """The first ``count`` rows of a total order.

    A small count is Spark's per-task top-k; a large one would gather in a single task, so it
    goes through the distributed row index.
    """
    order = [F.col(o) if isinstance(o, str) else o for o in order_by]
    if count <= LIMIT_ROWS:
        return df.orderBy(*order).limit(count)
    return row_index(df, order, output="_index", **sizes).filter(F.col("_index") < count).drop("_index")


def list_parts(
    df: DataFrame,
    keys: Sequence[str],
    element: Column,
    order_by: Sequence[str],
    output: str,
    *,
    items: int | None = None,
    **sizes: int,
) -> DataFrame:
    """Ordered lists per key: one row per key with ``part`` 0, or parts of at most ``items`` elements.

    One list per key is one aggregate and fits where a key's rows make one value anyway, as a
    recording's utterances do.  With ``items`` a key with any number of rows becomes several
    rows (``part`` 0, 1, ...), so that no task ever holds a list that grows with the table.
    """
    if items is None:
        ordered = F.array_sort(F.collect_list(F.struct(*[F.col(o).alias(f"o{i}") for i, o in enumerate(order_by)], element.alias("e"))))
        lists = df.groupBy(*keys).agg(ordered.alias("_items"))
        return lists.select(*keys, F.lit(0).cast("bigint").alias("part"), F.transform("_items", lambda i: i["e"]).alias(output))
    numbered = row_index(df.withColumn("_element", element), order_by, keys, "_index", **sizes)
    gathered = numbered.groupBy(*keys, F.floor(F.col("_index") / F.lit(items)).cast("bigint").alias("part")).agg(
        F.array_sort(F.collect_list(F.struct("_index", "_element"))).alias("_items")
    )
    return gathered.select(*keys, "part", F.transform("_items", lambda i: i["_element"]).alias(output))
