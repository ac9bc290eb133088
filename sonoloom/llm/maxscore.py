"""Exact top-k inner products by MaxScore over sharded postings.

A term is a dimension; its posting list holds the integer component of every vector of a shard.  In a shard a term adds between
its bounds lo and hi to a query's score, so after taking lo from every term all contributions are at least 0 and hi - lo is the
term's score bound.  Terms are split by bound: the essential ones, which a vector needs to reach the k-th best score so far,
are traversed for all vectors; the others are probed in order of falling bound, and only for vectors that are still competitive.
Shards are merged by score.  Vectors are spread over shards by a hash of the whole row, so equal ids or vectors crowd no task.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SHARD_ROWS = 8_192
QUERY_ROWS = 2_048
PROBE = 8

NO_ID = (1 << 63) - 1


def usable(vector: Column) -> Column:
    """Not null, and neither null nor non-finite in any component."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vector.isNotNull() & ~F.coalesce(bad, F.lit(False))


def quantised(vector: Column, scale: int) -> Column:
    return F.transform(vector, lambda x: F.floor(x.cast("double") * scale))


class Shard:
    """Posting lists of some vectors: one row per term, with the least and largest component."""

    def __init__(self, ids: np.ndarray, none: np.ndarray, vectors: list, width: int):
        self.ids, self.none = ids, none
        self.lists = np.zeros((width, len(ids)), np.int64)
        for i, vector in enumerate(vectors):
            self.lists[: len(vector), i] = vector
        self.least, self.most = self.lists.min(axis=1), self.lists.max(axis=1)

    def top(self, query: np.ndarray, own: int, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Positions and scores of the k best vectors without those of id ``own``, ties to the smaller id."""
        ends = np.stack([query * self.least, query * self.most])
        lo, hi = ends.min(axis=0), ends.max(axis=0)
        order = np.argsort(lo - hi, kind="stable")
        order = order[query[order] != 0]
        rest = np.concatenate([np.cumsum((hi - lo)[order][::-1])[::-1], [0]])  # what the terms from here on can add above lo
        base = int(lo[order].sum())
        alive = np.flatnonzero((self.ids != own) | self.none)
        if len(alive) <= k:
            threshold, essential = None, len(order)
        else:
            # a first threshold: full scores of the vectors that lead on the strongest terms
            lead = np.argpartition(-(query[order[:PROBE]] @ self.lists[order[:PROBE]])[alive], k - 1)[: 4 * k]
            exact = query @ self.lists[:, alive[lead]]
            threshold = np.partition(exact, len(exact) - k)[len(exact) - k]
            # vectors that hold nothing above lo in the essential terms stay below the threshold
            essential = max(int(np.searchsorted(-(base + rest), -threshold, side="right")) - 1, 1) if len(order) else 0
        done = min(essential, len(order))
        partial = query[order[:done]] @ self.lists[order[:done]] - lo[order[:done]].sum()
        partial = partial[alive]
        while threshold is not None:
            keep = base + partial + rest[done] >= threshold
            alive, partial = alive[keep], partial[keep]
            if done == len(order):
                break
            step = order[done : done + PROBE]
            partial = partial + query[step] @ self.lists[np.ix_(step, alive)] - lo[step].sum()
            done += len(step)
        scores = partial + base
        best = np.lexsort((self.ids[alive], self.none[alive], -scores))[:k]
        return alive[best], scores[best]


def top_k(vectors: DataFrame, queries: DataFrame, k: int, *, id_column: str = "vec_id", vector: str = "embedding", scale: int = 256) -> DataFrame:
    """(query_id, rank, vec_id, score): the k largest integer inner products of every query with all ``vectors`` but its own id.

    Components become floor(scale * x).  Vectors that are null or hold null or non-finite components take no part; shorter ones
    are as if padded with 0, empty ones score 0.  Ties go to the smaller id, rows without an id last.  Repeated query rows are
    one query; repeated candidate rows are candidates each.  Empty tables give no rows; other columns are ignored.  Scores must
    fit 64 bits.
    """

    def narrow(rows: DataFrame) -> DataFrame:
        # ids go through pandas without nulls, so that they stay 64-bit integers; the flag tells the rows without an id
        number = F.col(id_column).cast("bigint")
        return rows.filter(usable(F.col(vector))).select(
            F.coalesce(number, F.lit(NO_ID)).alias("_id"), number.isNull().alias("_none"), quantised(F.col(vector), scale).alias("_v")
        )

    candidates, asked = narrow(vectors), narrow(queries).filter("NOT _none").drop("_none").distinct()
    n_candidates, n_queries = vectors.count(), queries.count()
    shards, blocks = max(1, -(-n_candidates // SHARD_ROWS)), max(1, -(-n_queries // QUERY_ROWS))
    spread = F.monotonically_increasing_id()
    left = candidates.withColumn("_shard", F.pmod(F.xxhash64("_id", spread), F.lit(shards))).withColumn(
        "_block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))
    )
    right = asked.withColumn("_block", F.pmod(F.xxhash64("_id"), F.lit(blocks)).cast("int")).withColumn(
        "_shard", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(shards - 1).cast("bigint")))
    )

    def search(rows: pd.DataFrame, wanted: pd.DataFrame) -> pd.DataFrame:
        found = []
        if len(rows) and len(wanted):
            width = max(rows["_v"].map(len).max(), wanted["_v"].map(len).max())
            none = rows["_none"].to_numpy(bool)
            shard = Shard(rows["_id"].to_numpy(np.int64), none, rows["_v"].to_list(), width)
            for own, values in zip(wanted["_id"], wanted["_v"]):
                query = np.zeros(width, np.int64)
                query[: len(values)] = values
                at, scores = shard.top(query, own, k)
                found.append(pd.DataFrame({"query_id": own, "vec_id": shard.ids[at], "none": none[at], "score": scores, "_copy": at}))
        return pd.concat(found) if found else pd.DataFrame({"query_id": [], "vec_id": [], "none": [], "score": [], "_copy": []}, dtype="int64")

    hits = (
        left.groupBy("_shard", "_block")
        .cogroup(right.groupBy("_shard", "_block"))
        .applyInPandas(search, "query_id bigint, vec_id bigint, none boolean, score bigint, _copy bigint")
    )
    place = Window.partitionBy("query_id").orderBy(F.desc("score"), "none", "vec_id", "_copy")
    return (
        hits.withColumn("rank", F.row_number().over(place))
        .filter(F.col("rank") <= k)
        .select("query_id", "rank", F.when(~F.col("none"), F.col("vec_id")).alias("vec_id"), "score")
    )
