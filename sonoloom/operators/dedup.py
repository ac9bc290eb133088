"""Duplicate recordings: by name, by content hash, and the in-order rejection of a batch."""

from __future__ import annotations

from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sonoloom.operators.components import components
from sonoloom.operators.ordered import blocks
from sonoloom.session import checkpointed

GROUP_ROWS = 10_000
SCAN_ROWS = 200_000


def known_by_name_or_hash(incoming: DataFrame, catalogue: DataFrame, name: str = "raw_file_name", digest: str = "media_hash_code") -> DataFrame:
    """Incoming rows whose name or hash is catalogued: two semi-joins, each row once."""
    names = catalogue.select(name).filter(F.col(name).isNotNull()).distinct()
    digests = catalogue.select(digest).filter(F.col(digest).isNotNull()).distinct()
    by_name = incoming.join(names, name, "left_semi")
    by_hash = incoming.join(names, name, "left_anti").join(digests, digest, "left_semi")
    return by_name.unionByName(by_hash)


def unknown_by_name_or_hash(incoming: DataFrame, catalogue: DataFrame, name: str = "raw_file_name", digest: str = "media_hash_code") -> DataFrame:
    """Incoming rows with neither name nor hash catalogued; a NULL matches nothing."""
    return incoming.join(catalogue.select(name).distinct(), name, "left_anti").join(
        catalogue.select(digest).distinct(), digest, "left_anti"
    )


def duplicate_groups(df: DataFrame, key: str) -> DataFrame:
    """All members of groups with more than one row; rows with a NULL key form one group.

    Counts are combined before the shuffle, and the join back can be split on a hot key.
    """
    repeated = df.groupBy(F.col(key).alias("_k")).agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1").select("_k")
    matched = df.filter(F.col(key).isNotNull()).join(repeated.withColumnRenamed("_k", key), key, "left_semi")
    nulls = df.filter(F.col(key).isNull())
    if nulls.limit(2).count() > 1:
        return matched.unionByName(nulls)
    return matched


def first_per_key(df: DataFrame, keys: Sequence[str], order_by: Sequence[str | Column]) -> DataFrame:
    """The first row of every key in the given order, by a map-side combined minimum."""
    order = F.struct(*[F.col(o) if isinstance(o, str) else o for o in order_by])
    first = df.groupBy(*[F.col(k).alias(f"_k_{k}") for k in keys]).agg(F.min_by(F.struct("*"), order).alias("_row"))
    return first.select("_row.*")


def latest_with_ties(df: DataFrame, key: str, moment: str) -> DataFrame:
    """Rows whose ``moment`` is the greatest of their key, ties kept."""
    last = df.groupBy(key).agg(F.max(moment).alias(moment))
    return df.join(last, [key, moment], "left_semi")


def _in_order(rows: pd.DataFrame) -> pd.DataFrame:
    names, digests, kept = set(), set(), []
    for row in rows.sort_values("_rank").itertuples(index=False):
        fresh = (row.name is None or row.name not in names) and (row.digest is None or row.digest not in digests)
        if fresh:
            kept.append(row.id)
            names.add(row.name)
            digests.add(row.digest)
    return pd.DataFrame({"id": kept})


def reject_in_order(
    batch: DataFrame,
    key: str,
    order_by: Sequence[str],
    name: str = "raw_file_name",
    digest: str = "media_hash_code",
    group_rows: int = GROUP_ROWS,
    scan_rows: int = SCAN_ROWS,
) -> DataFrame:
    """Rows accepted when they are taken in order and one that shares its name or hash with an
    accepted earlier row is rejected.  ``key`` must be unique.

    Copies of one (name, hash) collapse to the first beforehand.  Rows that no chain of shared
    names and hashes connects do not bear on each other, so each component is walked in order
    on its own, all of them in parallel.  Components of more than ``group_rows`` rows are
    scanned in blocks of ``scan_rows`` rows in order: a block loses what shares a name or a hash with the rows accepted
    so far, which are kept as written tables, and what is left of it is decided by its own components.  So the
    rounds follow the number of rows, not the length of a chain.
    """
    rank = F.struct(*[F.col(o) for o in order_by])
    labelled = batch.select(F.col(key).alias("id"), rank.alias("rank"), F.col(name).alias("name"), F.col(digest).alias("digest"))
    alone = F.col("name").isNull() & F.col("digest").isNull()
    accepted = labelled.filter(alone).select("id")
    first = labelled.filter(~alone).groupBy("name", "digest").agg(F.min(F.struct("rank", "id")).alias("r"))
    undecided = checkpointed(first.select("r.rank", "r.id", "name", "digest"))
    placed = _grouped(undecided)
    large = placed.groupBy("component").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > group_rows).select("component")
    small = placed.join(large, "component", "left_anti").select("component", "id", "rank", "name", "digest")
    kind = dict(batch.dtypes)[key]
    accepted = accepted.union(_walked(small, kind))
    undecided = placed.join(large, "component", "left_semi").select("id", "rank", "name", "digest")
    numbered = checkpointed(blocks(undecided, scan_rows, ["rank"], "_block"))
    taken = None
    for block in range((numbered.agg(F.max("_block")).first()[0] + 1) if not numbered.isEmpty() else 0):
        rows = numbered.filter(F.col("_block") == block).drop("_block")
        if taken is not None:
            rows = rows.join(taken.select("name").distinct(), "name", "left_anti").join(taken.select("digest").distinct(), "digest", "left_anti")
        rows = checkpointed(rows.select("id", "rank", "name", "digest"))
        winners = checkpointed(rows.join(_walked(_grouped(rows), kind), "id", "left_semi").select("id", "name", "digest"))
        taken = winners if taken is None else taken.unionByName(winners)
    if taken is not None:
        accepted = accepted.union(taken.select("id"))
    return batch.join(accepted.withColumnRenamed("id", key), key, "left_semi")


def _grouped(rows: DataFrame) -> DataFrame:
    """Add ``component``, of the graph of shared names and hashes; no row lacks both."""
    by_name, by_digest = F.concat(F.lit("n"), "name"), F.concat(F.lit("d"), "digest")
    groups = components(rows.select(by_name.alias("a"), by_digest.alias("b")).filter("a is not null and b is not null"))
    placed = rows.withColumn("node", F.coalesce(by_name, by_digest)).join(groups, "node", "left")
    return placed.withColumn("component", F.coalesce("component", "node")).drop("node")


def _walked(rows: DataFrame, kind: str) -> DataFrame:
    """(id) of the rows accepted when each component is taken in order."""
    in_group = F.row_number().over(Window.partitionBy("component").orderBy("rank"))
    ranked = rows.select("component", "id", "name", "digest", in_group.alias("_rank"))
    return ranked.groupBy("component").applyInPandas(_in_order, f"id {kind}")
