"""Sharding by a k-d tree over metadata: weighted medians along the widest dimension until leaves hold the target bytes.

Only DataFrame functions run.  Rows are narrowed to their metadata once and checkpointed; every level of the tree is a few
aggregations over that narrow table.  The driver holds the tree (one cut per inner node) and nothing else.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sonoloom.session import checkpointed

ROW_BYTES = 8
DIMENSIONS = ("_d0", "_d1", "_d2")
STEPS = (46, 30, 14, 0)
TOLERANCE = 0.0005


@dataclass
class Node:
    """A run of ``leaves`` shards from ``first``; rows go left if their (key, tie) is below (cut, tie_cut)."""

    first: int
    leaves: int
    dimension: int = 0
    cut: int = 0
    tie_cut: int = 0


def _key(dimension: int) -> Column:
    """62-bit order along a dimension; equal values are ordered by the text, so equal texts stay neighbours."""
    return F.shiftleft(F.col(DIMENSIONS[dimension]), 30) + F.col("_text_key")


def _per_node(nodes: list[Node], value) -> Column:
    """A value chosen by the row's node; null for nodes that are not among ``nodes``."""
    chain = F
    for node in nodes:
        chosen = value(node)
        chain = chain.when(F.col("_node") == node.first, chosen if isinstance(chosen, Column) else F.lit(chosen))
    return chain


def _medians(rows: DataFrame, nodes: list[Node], needs: dict[int, int], slack: float) -> None:
    """Set each node's cut where the bytes below it come nearest to ``needs``.

    The key's bits are settled 16 at a time: each pass sums bytes by (node, next 16 bits), which gives at most 65,536 sums a
    node, and keeps the one in which the target lies.  Where one key (a group of copies) holds more than the slack, the same
    search goes on over the tie-break, so a group is split rather than a shard overfilled.
    """
    need = dict(needs)
    active = nodes
    for column in ("_k", "_tie"):
        prefix: dict[int, int] = {}
        held = []
        shift_before = None
        for shift in STEPS:
            if not active:
                break
            part = rows.filter(F.col("_node").isin([n.first for n in active]))
            if column == "_tie":
                part = part.filter(F.col("_k") == _per_node(active, lambda n: n.cut))
            if shift_before is not None:
                part = part.filter(F.shiftright(column, shift_before) == _per_node(active, lambda n: prefix[n.first]))
            sums = part.groupBy("_node", F.shiftright(column, shift).alias("_bin")).agg(F.sum("size").alias("_bytes"))
            running = sums.withColumn("_upto", F.sum("_bytes").over(Window.partitionBy("_node").orderBy("_bin")))
            wanted = _per_node(active, lambda n: need[n.first])
            found = running.filter((F.col("_upto") >= wanted) & (F.col("_upto") - F.col("_bytes") < wanted)).collect()
            at = {r["_node"]: r for r in found}  # one row per node
            going = []
            for node in active:
                r = at[node.first]
                into = need[node.first] - (r["_upto"] - r["_bytes"])
                small = r["_bytes"] <= slack
                if small or (not shift and column == "_tie"):
                    edge = (r["_bin"] + (2 * into >= r["_bytes"])) << shift
                    if column == "_k":
                        node.cut = edge
                    else:
                        node.tie_cut = edge
                    continue
                need[node.first] = into
                if shift:
                    prefix[node.first] = r["_bin"]
                    going.append(node)
                else:
                    node.cut = r["_bin"]
                    held.append(node)
            active, shift_before = going, shift
        active = held


def _descend(rows: DataFrame, nodes: list[Node]) -> DataFrame:
    """Move the rows of cut nodes to their left or right half."""

    def half(node: Node) -> Column:
        below = (F.col("_k") < node.cut) | ((F.col("_k") == node.cut) & (F.col("_tie") < node.tie_cut))
        return F.when(below, node.first).otherwise(node.first + node.leaves // 2)

    return rows.withColumn("_node", F.coalesce(_per_node(nodes, half), F.col("_node")))


def kd_leaves(rows: DataFrame, shards: int, tolerance: float = TOLERANCE) -> DataFrame:
    """``rows`` (narrow form) with ``_node``, the shard of near equal bytes that each row falls in."""
    spans = [(F.max(d) - F.min(d)).alias(d) for d in DIMENSIONS]
    total = rows.agg(F.coalesce(F.sum("size"), F.lit(0)).alias("size"), *spans).first()
    rows = rows.withColumn("_node", F.lit(0))
    level = [Node(0, shards)] if total["size"] else []
    while level := [n for n in level if n.leaves > 1]:
        facts = rows.groupBy("_node").agg(F.sum("size").alias("size"), *spans).collect()
        known = {r["_node"]: r for r in facts}  # one row per node, at most as many as shards
        level = [n for n in level if n.first in known]
        needs = {}
        for node in level:
            fact = known[node.first]
            width = [fact[d] / total[d] if total[d] else 0 for d in DIMENSIONS]
            node.dimension = width.index(max(width))
            needs[node.first] = max(1, round(fact["size"] * (node.leaves // 2) / node.leaves))
        rows = checkpointed(rows.withColumn("_k", _per_node(level, lambda n: _key(n.dimension))))
        _medians(rows, level, needs, tolerance * total["size"] / shards)
        rows = _descend(rows, level)
        halves = [(n.first, n.leaves // 2) for n in level] + [(n.first + n.leaves // 2, n.leaves - n.leaves // 2) for n in level]
        level = [Node(*h) for h in halves]
    return rows


def kd_shards(docs: DataFrame, shards: int | None = None, *, target_bytes: int | None = None) -> DataFrame:
    """(doc_id, size, text_crc32, shard, slot) of every row of ``docs``.

    ``size`` is the UTF-8 bytes of the text plus 8; a null text has no bytes and the checksum 0.  Give the number of shards, or
    ``target_bytes`` that no leaf should exceed by more than one document.  Dimensions are the size on a log scale, the language
    and the text's checksum; ties follow the text and then the row, so copies lie side by side and are parted only where a
    boundary falls inside their group.  Slots number a shard's rows from 0 without gaps.  An empty table gives no rows; null ids
    are kept; repeated rows each take a slot; other columns are ignored.
    """
    body = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    language = F.col("lang") if "lang" in docs.columns else F.lit(None).cast("string")
    narrow = docs.select(
        F.col("doc_id"),
        (F.octet_length(body).cast("bigint") + ROW_BYTES).alias("size"),
        F.crc32(body).alias("text_crc32"),
        F.crc32(F.coalesce(language.cast("string"), F.lit("")).cast("binary")).alias("_d1"),
        F.monotonically_increasing_id().alias("_row"),
    )
    half = F.lit((1 << 30) - 1)
    rows = checkpointed(
        narrow.select(
            "doc_id",
            "size",
            "text_crc32",
            (F.log2("size") * float(1 << 25)).cast("bigint").alias("_d0"),
            F.shiftright("_d1", 1).alias("_d1"),
            F.shiftright("text_crc32", 1).alias("_d2"),
            F.xxhash64("text_crc32", "size").bitwiseAND(half).alias("_text_key"),
            F.shiftrightunsigned(F.xxhash64("doc_id", "_row"), 2).alias("_tie"),
            "_row",
        )
    )
    if shards is None:
        total = rows.agg(F.coalesce(F.sum("size"), F.lit(0)).alias("n")).first()["n"]
        shards = max(1, math.ceil(total / (target_bytes or 1 << 30)))
    placed = checkpointed(
        kd_leaves(rows, shards).select(
            "doc_id", "size", "text_crc32", F.col("_node").alias("shard"), "_row", F.shiftright("_row", 33).alias("_piece")
        )
    )
    # numbered inside (shard, input partition), which Spark bounds, then moved up by the rows of earlier partitions
    inside = Window.partitionBy("shard", "_piece").orderBy("_row")
    earlier = Window.partitionBy("shard").orderBy("_piece").rowsBetween(Window.unboundedPreceding, -1)
    base = (
        placed.groupBy("shard", "_piece")
        .agg(F.count(F.lit(1)).alias("_n"))
        .select("shard", "_piece", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_base"))
    )
    numbered = placed.withColumn("_number", F.row_number().over(inside) - 1).join(base, ["shard", "_piece"])
    return numbered.select(
        "doc_id", "size", "text_crc32", "shard", (F.col("_number") + F.col("_base")).cast("bigint").alias("slot")
    )
