"""Near-duplicate documents by SetSketch registers, confirmed on full shingle sets.

1. Every text becomes a set of hashed word shingles.  Documents with the same set are one node.
2. A node's SetSketch has 128 registers: exponentially spaced, truncated logs of minima, which merge by maximum.  Four registers
   are one band of 64 bits.  Two sets with similarity s share a band with probability near 1 - (1 - s^4)^32: 0.9999999999 at 0.85.
3. A bucket of equal bands is a list: its smallest node is the pivot, compared with the others.  Pairs pass the joint likelihood test
   of the registers and are then verified on the full sets; linked nodes are contracted.
4. In buckets with nodes of several components the rest is derived from how the nodes differ from the pivot, or gets a new pivot
   (``answers``), so that no link is lost where a pivot is not close to all, and no bucket is compared all with all.
5. Components of the verified links name each document's group by its least doc_id.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sonoloom.llm.answers import WordHashes, links, shingle_set, written
from sonoloom.llm.common import packed, unpacked
from sonoloom.operators.components import components
from sonoloom.session import checkpointed

REGISTERS = 128
BAND_REGISTERS = 4
BASE = 1.001
RATE = 20.0
LARGEST = 65_535
SHINGLE = 5
MARGIN = 0.13
# (largest pivot, reach in hundredths): nodes of one bucket are seldom far apart
REACHES = ((500, 55), (2_500, 35), (1 << 40, 20))
SEED = 0x5E7
MASK = (1 << 64) - 1


def multipliers() -> np.ndarray:
    """One odd multiplier per register, from a seed."""
    return np.random.default_rng(SEED).integers(0, 1 << 63, REGISTERS, np.uint64) * np.uint64(2) + np.uint64(1)


def registers(values: np.ndarray, factors: np.ndarray) -> np.ndarray:
    """SetSketch registers of a set of 64-bit hashes: floor(1 - log_b x) of the least Exp(RATE) value, within 16 bits."""
    least = np.full(REGISTERS, MASK, np.uint64)
    for start in range(0, len(values), 2048):
        np.minimum(least, np.multiply.outer(values[start : start + 2048], factors).min(axis=0), out=least)
    uniform = (least.astype(np.float64) + 0.5) / 2.0**64
    x = -np.log1p(-uniform) / RATE
    return np.clip(np.floor(1 - np.log(x) / np.log(BASE)), 0, LARGEST).astype(np.uint16)


def at_least(a: np.ndarray, b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray, similarity: np.ndarray | float) -> np.ndarray:
    """Whether the joint likelihood of the registers is still rising in J at ``similarity``: the estimate is at least that.

    With u, v the shares of the two set sizes and p(x) = -log_b(1 - x (b-1)/b), a register is larger in the first set with
    probability p(u - v J), in the second with p(v - u J), and equal otherwise.  The likelihood is concave in J.
    """
    u = n_a / (n_a + n_b)
    v = 1 - u
    j = np.minimum(similarity, np.minimum(u / v, v / u) * 0.999)
    more, less = (a > b).sum(axis=1), (a < b).sum(axis=1)
    scale, step = (BASE - 1) / BASE, 1 / np.log(BASE)
    x, y = u - v * j, v - u * j
    p, q = -np.log1p(-x * scale) * step, -np.log1p(-y * scale) * step
    dp, dq = -v * scale * step / (1 - x * scale), -u * scale * step / (1 - y * scale)
    slope = more * dp / np.maximum(p, 1e-12) + less * dq / np.maximum(q, 1e-12)
    return slope - (REGISTERS - more - less) * (dp + dq) / np.maximum(1 - p - q, 1e-12) >= 0


def sketched(docs: DataFrame, size: int) -> DataFrame:
    """(doc_id, text_hash, n, node, bands) of every row; node is 128 bits of the set, null and without bands for empty sets."""

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, factors = WordHashes(), multipliers()
        for batch in batches:
            sizes, nodes, bands = [], [], []
            for text in batch.column("text"):
                values = shingle_set(text.as_py(), hashes, size)
                sizes.append(len(values))
                nodes.append(hashlib.blake2b(values.tobytes(), digest_size=16).digest() if len(values) else None)
                bands.append(registers(values, factors).view(np.int64) if len(values) else None)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    batch.column("text_hash"),
                    pa.array(sizes, pa.int64()),
                    pa.array(nodes, pa.binary()),
                    pa.array(bands, pa.list_(pa.int64())),
                ],
                ["doc_id", "text_hash", "n", "node", "bands"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", F.xxhash64("text").alias("text_hash"), "text").mapInArrow(
        sketch, f"doc_id {kind}, text_hash bigint, n bigint, node binary, bands array<bigint>"
    )


def _likely(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """Pairs (a, b, least) whose registers allow a similarity of ``least`` hundredths, with a margin."""
    facts = nodes.select("id", "n", "bands")
    sided = pairs
    for side in ("a", "b"):
        sided = sided.join(facts.select(F.col("id").alias(side), F.col("n").alias(f"n_{side}"), F.col("bands").alias(f"bands_{side}")), side)
    columns = pairs.columns

    def test(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            if len(rows):
                left, right = (np.stack(rows[c].to_list()).astype(np.int64).view(np.uint16) for c in ("bands_a", "bands_b"))
                sizes = rows["n_a"].to_numpy(float), rows["n_b"].to_numpy(float)
                rows = rows[at_least(left, right, *sizes, np.maximum(rows["least"].to_numpy() / 100 - MARGIN, 0.01))]
            yield rows[columns]

    return sided.mapInPandas(test, pairs.schema)


def near_duplicates(docs: DataFrame, percent: int = 85, size: int = SHINGLE) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept, text_hash) of every row.

    Two documents are linked if 100 * |A and B| >= percent * |A or B| for their sets of ``size``-word shingles (A-Z
    lower-cased; fewer words are one shingle).  Null, empty and blank texts have no set and are linked with nothing.
    ``component_id`` is the least doc_id reachable over links; null ids come last, so it is null only where a whole group has
    no id.  ``kept`` is doc_id = component_id (true for a row without id and links).  Repeated rows are linked like any
    copies, and all rows with the least id are kept.  Empty tables give no rows; other columns are ignored.
    """
    rows = checkpointed(sketched(docs, size))
    nodes = checkpointed(
        rows.filter(F.col("n") > 0)
        .groupBy("node")
        .agg(F.min("doc_id").alias("least"), F.first("n").alias("n"), F.first("bands").alias("bands"), F.min("text_hash").alias("text_hash"))
        .withColumn("id", F.monotonically_increasing_id())
    )
    banded = nodes.select("id", "n", F.posexplode("bands").alias("_band", "_value"))
    buckets = banded.select(
        F.xxhash64("_band", "_value").alias("token"), F.lit(0).alias("block"), F.lit(True).alias("own"), "id", "n", F.lit(0).alias("pos")
    )
    groups = components(written(links(buckets, docs, nodes, size, percent, lambda pairs: _likely(pairs, nodes), REACHES), "links"))
    named = (
        groups.join(nodes.select(F.col("id").alias("node"), "least"), "node")
        .groupBy("component")
        .agg(F.min("least").alias("_group"))
        .join(groups, "component")
        .select(F.col("node").alias("id"), "_group")
    )
    ids = nodes.select("id", "node", "least").join(named, "id", "left").select("node", F.coalesce("_group", "least").alias("_group"))
    placed = rows.select("doc_id", "n", "node", "text_hash").join(ids, "node", "left")
    component = F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("_group"))
    return placed.select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        component.alias("component_id"),
        component.eqNullSafe(F.col("doc_id")).alias("kept"),
        "text_hash",
    )


def without_near_duplicates(docs: DataFrame, percent: int = 85, size: int = SHINGLE) -> DataFrame:
    """``docs`` with one document of each group: the one with the least id; rows without words stay, other columns too.

    Of several rows with that id and the same text one stays.
    """
    found = checkpointed(near_duplicates(docs, percent, size))
    keys = [F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash")]
    gone = found.filter(~F.col("kept")).select(*keys).distinct()
    again = found.filter("kept AND n_shingles > 0").groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1").drop("_n")
    rows = packed(docs).withColumn("_text_hash", F.xxhash64("text"))

    def same() -> Column:
        return F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_text_hash") == F.col("_hash"))

    rest = rows.join(gone, same(), "left_anti")
    if not again.isEmpty():
        single = rest.join(again, same(), "left_anti")
        rest = single.unionByName(rest.join(again, same(), "left_semi").dropDuplicates(["doc_id", "_text_hash"]))
    return rest.select(*unpacked(docs.columns))
