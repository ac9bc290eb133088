"""Exact Jaccard join of word-shingle sets by set-relation skipping.

1. Every text becomes a set of hashed word shingles; documents with the same set are one node.
2. A node is listed under the first n - ceil(t n) + 1 of its shingles, rare ones before common ones, so linked nodes meet in
   a list.  How common a shingle is, is counted over the first shingles by hash of all nodes; a node whose first
   shingles are mostly common is ordered over its whole set.
3. A list is an index by position.  A list of a common shingle is cut into blocks by set size, and pairs whose sizes or positions
   leave too little room for a shared t are skipped.  The entry with the least position (the fewest shingles of its own)
   is the list's pivot and is compared with the other entries.  Its answers are the sets near it, a reach of several link radii, and how
   they differ from it.  Linked nodes are contracted.
4. What is left is derived from the pivots' answers.  For two sets near a pivot p the symmetric difference is that of their
   differences D to p, so they are linked iff |D_x| + |D_y| - 2 |D_x & D_y| is small enough.  Either the sizes alone decide, then
   one link to the set with the most slack stands for all, or they share some of their differences: these are listed by
   position once more, rare ones first, in blocks by slack, and a block without room for a link is skipped as a whole.  Groups of
   near copies thus meet only where they share edits, and overlaps follow from the differences alone:
   |x & y| = |p| - |(p - x) | (p - y)| + |(x - p) & (y - p)|.
   A set beyond the reach of a pivot can be linked only to sets that are less than one radius inside it: lists go on with these,
   and a new pivot, for a few turns, and what is left then is compared.
5. Components of the links name each document's group by its least doc_id.

Before any comparison a histogram of 256 bins per node bounds the symmetric difference from below, so it never loses a pair.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sonoloom.llm.answers import WordHashes, links, shingle_set, texts_of, written
from sonoloom.llm.common import keep_possible
from sonoloom.operators.components import components
from sonoloom.session import checkpointed

SHINGLE = 3
COMMON = 32
BINS = 256


def prefix_length(n: int, percent: int) -> int:
    """Shingles to list so that sets with a Jaccard similarity of ``percent`` share one of them."""
    return n + percent * -n // 100 + 1


def _prefix_length(n: Column, percent: int) -> Column:
    return (n - F.ceil(n * percent / 100.0 - 1e-9) + 1).cast("int")


def _head(values: np.ndarray, percent: int) -> np.ndarray:
    """Twice the prefix by hash: enough to find the prefix unless more than half of it is common."""
    return values[: 2 * prefix_length(len(values), percent)]


def set_rows(docs: DataFrame, size: int, percent: int) -> DataFrame:
    """(doc_id, text_hash, n, node, bins, head) of every row; node is 128 bits of the set, null for empty sets."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in batches:
            sizes, nodes, bins, heads = [], [], [], []
            for text in batch.column("text"):
                values = np.sort(shingle_set(text.as_py(), hashes, size).view(np.int64))
                some = len(values) > 0
                sizes.append(len(values))
                nodes.append(hashlib.blake2b(values.tobytes(), digest_size=16).digest() if some else None)
                bins.append(np.minimum(np.bincount(values & (BINS - 1), minlength=BINS), 255).astype(np.uint8).tobytes() if some else None)
                heads.append(_head(values, percent) if some else None)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    batch.column("text_hash"),
                    pa.array(sizes, pa.int64()),
                    pa.array(nodes, pa.binary()),
                    pa.array(bins, pa.binary()),
                    pa.array(heads, pa.list_(pa.int64())),
                ],
                ["doc_id", "text_hash", "n", "node", "bins", "head"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", F.xxhash64("text").alias("text_hash"), "text").mapInArrow(
        rows, f"doc_id {kind}, text_hash bigint, n bigint, node binary, bins binary, head array<bigint>"
    )


def _whole_sets(docs: DataFrame, nodes: DataFrame, wanted: DataFrame, size: int) -> DataFrame:
    """(id, n, token, i) of all shingles of the wanted ids."""
    facts = nodes.join(wanted, "id", "left_semi").select("id", "n", "text_hash")
    texts = texts_of(docs, facts.select("text_hash").distinct())

    def sets(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hashes = WordHashes()
        for rows in batches:
            yield pd.DataFrame({"id": rows["id"], "n": rows["n"], "tokens": [shingle_set(t, hashes, size).view(np.int64) for t in rows["text"]]})

    whole = facts.join(texts, "text_hash").select("id", "n", "text").mapInPandas(sets, "id bigint, n bigint, tokens array<bigint>")
    return whole.select("id", "n", F.explode("tokens").alias("token"))


def listed(docs: DataFrame, nodes: DataFrame, size: int, percent: int) -> DataFrame:
    """(token, block, own, id, n, pos): the prefix of every node in the order (how common, hash).

    ``rank`` of a shingle is 0 where at most ``COMMON`` nodes have it among their first by hash, else the binary logarithm of that
    number.  It depends on the shingle alone, so the order is the same for all sets.
    """
    heads = nodes.select("id", F.explode("head").alias("token"))
    counts = heads.groupBy("token").agg(F.count(F.lit(1)).alias("_c")).filter(F.col("_c") > COMMON)
    common = checkpointed(counts.select("token", F.floor(F.log2("_c")).cast("int").alias("rank")))
    hits = keep_possible(heads, "token", common).join(common, "token").groupBy("id").agg(F.collect_list("token").alias("_common"))
    p = _prefix_length(F.col("n"), percent)
    sided = written(
        nodes.select("id", "n", "head")
        .join(hits, "id", "left")
        .withColumn("_rare", F.when(F.col("_common").isNull(), F.col("head")).otherwise(F.array_except("head", "_common")))
        .select("id", "n", (F.size("_rare") < p).alias("deep"), F.slice("_rare", F.lit(1), p).alias("_rare")),
        "prefixes",
    )
    shallow = sided.filter("NOT deep").select("id", "n", F.posexplode("_rare").alias("pos", "token"), F.lit(0).alias("rank"))
    whole = _whole_sets(docs, nodes, sided.filter("deep").select("id"), size).join(common, "token", "left")
    place = F.row_number().over(Window.partitionBy("id").orderBy("rank", "token")) - 1
    deep = whole.withColumn("rank", F.coalesce("rank", F.lit(0))).withColumn("pos", place).filter(F.col("pos") < p)
    entries = shallow.select("token", "rank", "id", "n", "pos").unionByName(deep.select("token", "rank", "id", "n", "pos"))
    # lists of common shingles are cut by size: sets that may be linked are in one band or in neighbours
    band = F.floor(F.log(F.col("n").cast("double")) / math.log(100 / percent) + 1e-9).cast("int")
    own, beside = F.struct(band.alias("block"), F.lit(True).alias("own")), F.struct((band - 1).alias("block"), F.lit(False).alias("own"))
    single = F.struct(F.lit(-2).alias("block"), F.lit(True).alias("own"))
    blocks = F.when(F.col("rank") == 0, F.array(single)).otherwise(F.array(own, beside))
    return entries.select("token", "id", "n", "pos", F.explode(blocks).alias("_b")).select("token", "_b.*", "id", "n", "pos")


def _maybe(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """Pairs (a, b, least) whose histograms allow a Jaccard similarity of ``least`` hundredths."""
    facts = nodes.select("id", "n", "bins")
    sided = pairs
    for side in ("a", "b"):
        sided = sided.join(facts.select(F.col("id").alias(side), F.col("n").alias(f"n_{side}"), F.col("bins").alias(f"bins_{side}")), side)
    columns = pairs.columns

    def test(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            if len(rows):
                left, right = (np.frombuffer(b"".join(rows[c]), np.uint8).reshape(-1, BINS).astype(np.int16) for c in ("bins_a", "bins_b"))
                both, least = rows["n_a"].to_numpy() + rows["n_b"].to_numpy(), rows["least"].to_numpy(np.int64)
                rows = rows[(100 + least) * np.abs(left - right).sum(axis=1) <= (100 - least) * both]
            yield rows[columns]

    return sided.mapInPandas(test, pairs.schema)


def jaccard_groups(docs: DataFrame, percent: int = 90, size: int = SHINGLE) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every row.

    Two documents are linked if 100 * |A & B| >= percent * |A | B| for their sets of ``size``-word shingles (A-Z
    lower-cased; fewer words are one shingle).  Null, empty and blank texts have no set and are linked with nothing.
    ``component_id`` is the least doc_id reachable over links, the row's own included; null ids come last, so it is null only
    where a whole group has no id.  Repeated rows are linked like any copies.  Empty tables give no rows; other columns are ignored.
    """
    rows = written(set_rows(docs, size, percent), "sets")
    nodes = written(
        rows.filter(F.col("n") > 0)
        .groupBy("node")
        .agg(*[F.first(c).alias(c) for c in ("n", "bins", "head")], F.min("text_hash").alias("text_hash"), F.min("doc_id").alias("least"))
        .withColumn("id", F.monotonically_increasing_id()),
        "nodes",
    )
    found = links(listed(docs, nodes, size, percent), docs, nodes, size, percent, lambda pairs: _maybe(pairs, nodes))
    groups = components(written(found, "links"))
    named = groups.join(nodes.select(F.col("id").alias("node"), "least"), "node").groupBy("component").agg(F.min("least").alias("_group"))
    ids = (
        nodes.select("id", "node", "least")
        .join(groups.select(F.col("node").alias("id"), "component"), "id", "left")
        .join(named, "component", "left")
        .select("node", F.coalesce("_group", "least").alias("_group"))
    )
    placed = rows.select("doc_id", "n", "node").join(ids, "node", "left")
    component = F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("_group"))
    return placed.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"))
