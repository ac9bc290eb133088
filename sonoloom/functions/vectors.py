"""Array arithmetic as built-in expressions, and matrix work inside bounded blocks."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from math import ceil

import numpy as np
import pandas as pd
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sonoloom.session import checkpointed

BLOCK_ROWS = 4_096
PIVOTS = 1_024
SAMPLE_ROWS = 2_048
ANGLE_ERROR = 1e-6
BROADCAST_BYTES = 64 * 1024 * 1024
# Where pivots rule out little, rows are compared in this many blocks of at most so many rows: every row is sent to a task once per block.
COARSE_BLOCKS = 24
COARSE_ROWS = 32_768
TASK_PAIRS = 4_000_000
MOST_COMPARED = 0.5
TILE = 1_024


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once per row, also inside a lambda."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def dot(a: Column, b: Column) -> Column:
    products = F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda s, x: s + x)


def norm(a: Column) -> Column:
    return F.sqrt(dot(a, a))


def unit(a: Column) -> Column:
    return let(norm(a), lambda length: F.transform(a, lambda x: x / length))


def cosine_distance(a: Column, b: Column) -> Column:
    return F.lit(1.0) - dot(a, b) / (norm(a) * norm(b))


def softmax(logits: Column) -> Column:
    def share(powers: Column) -> Column:
        return let(total(powers), lambda all_: F.transform(powers, lambda p: p / all_))

    return let(F.array_max(logits), lambda top: let(F.transform(logits, lambda x: F.exp(x - top)), share))


def score_strings(scores: Column) -> Column:
    return F.transform(scores, lambda s: F.format_string("%.5f", s))


def language_scores(languages: Column, scores: Column) -> Column:
    return F.map_from_arrays(languages, scores)


def total(a: Column) -> Column:
    return F.aggregate(a, F.lit(0.0), lambda s, x: s + x.cast("double"))


def mean(a: Column) -> Column:
    return total(a) / F.size(a)


def z_normalise(frame: Column, log: bool = True) -> Column:
    """(x - mean) / (population deviation + 1e-5) of one frame, after ``log1p`` by default."""
    values = F.transform(frame, lambda x: F.log1p(x.cast("double")) if log else x.cast("double"))

    def scale(centred: Column) -> Column:
        deviation = F.sqrt(mean(F.transform(centred, lambda x: x * x))) + F.lit(1e-5)
        return let(deviation, lambda d: F.transform(centred, lambda x: x / d))

    def centre(v: Column) -> Column:
        return let(mean(v), lambda m: let(F.transform(v, lambda x: x - m), scale))

    return let(values, centre)


def pad_to(a: Column, length: int) -> Column:
    """Zero-padded to ``length``; a longer array is left alone."""
    return F.concat(a, F.array_repeat(F.lit(0.0), F.greatest(F.lit(0), F.lit(length) - F.size(a))))


def crop(a: Column, length: int, position: Column) -> Column:
    """``length`` elements; ``position`` in [0, 1) picks the start.  Short arrays stay whole."""
    room = F.size(a) - F.lit(length)
    start = F.floor(position * room).cast("int") + 1
    return F.when(room <= 0, a).otherwise(F.slice(a, start, length))


def group_sum(df: DataFrame, key: str, vector: str, output: str = "total") -> DataFrame:
    """Vector sum and row count per key; partial sums are combined before the shuffle."""
    summed = df.groupBy(key).agg(
        Summarizer.sum(array_to_vector(F.col(vector).cast("array<double>"))).alias("_sum"), F.count(F.lit(1)).alias("size")
    )
    return summed.select(key, vector_to_array("_sum").alias(output), "size")


def centroids(df: DataFrame, key: str, vector: str) -> DataFrame:
    """(key, centroid, size): the mean vector of each key scaled to unit length."""
    return group_sum(df, key, vector, "_sum").select(key, unit(F.col("_sum")).alias("centroid"), "size")


def matrix(vectors: pd.Series) -> np.ndarray:
    """Unit rows."""
    rows = np.stack(vectors.to_numpy()).astype("float64")
    lengths = np.linalg.norm(rows, axis=1, keepdims=True)
    return rows / np.where(lengths == 0, 1.0, lengths)


@dataclass
class BlockPairs:
    """A blocked self comparison: both sides, their grouping keys, links that need no test, and how many close pairs a sample lets expect."""

    first: DataFrame
    second: DataFrame
    keys: list[str]
    keys2: list[str]
    sure: DataFrame
    expected: float


def _choose_pivots(sample: np.ndarray, count: int, near: float) -> np.ndarray:
    """Pivots out of a bounded sample: first the middle of every crowd, then rows far from the rest.

    A crowd is at least 1/200 of the sample within ``near`` radians, so there are at most 200
    of them; up to ``count`` further pivots are each the farthest row from those before it.
    """
    if not len(sample):
        return np.zeros((0, 1))
    apart = np.arccos(np.clip(sample @ sample.T, -1.0, 1.0))
    close, kept = apart <= near, []
    crowd = close.sum(axis=1)
    while crowd.max() >= max(2, len(sample) / 200):
        kept.append(int(np.argmax(crowd)))
        close = close & ~close[kept[-1]]
        close[:, kept[-1]] = False
        crowd = close.sum(axis=1)
    kept = kept or [0]
    nearest, limit = apart[kept].min(axis=0), len(kept) + count - 1
    while len(kept) < limit and nearest.max() > near:
        kept.append(int(np.argmax(nearest)))
        nearest = np.minimum(nearest, apart[kept[-1]])
    return sample[kept]


def _share_compared(sample: np.ndarray, centres: np.ndarray, angle: float) -> float:
    """Share of the sample's row pairs that lie in cells which have to be compared."""
    near = sample @ centres.T
    best = np.argmax(near, axis=1)
    away = np.arccos(np.clip(near[np.arange(len(best)), best], -1.0, 1.0))
    cell, inverse, rows = np.unique(2 * best + (away > angle / 2 - ANGLE_ERROR), return_inverse=True, return_counts=True)
    radius = np.zeros(len(cell))
    np.maximum.at(radius, inverse, away)
    pivot = centres[cell // 2]
    apart = np.arccos(np.clip(pivot @ pivot.T, -1.0, 1.0))
    near = apart <= radius[:, None] + radius[None, :] + angle + ANGLE_ERROR
    return float((np.outer(rows, rows) * near).sum() / max(1, rows.sum()) ** 2)


def block_pairs(
    vectors: DataFrame,
    key: str,
    vector: str,
    similarity: float,
    block_rows: int = BLOCK_ROWS,
    pivots: int = PIVOTS,
    skip_sure: bool = False,
    moved: str | None = None,
) -> BlockPairs:
    """Which rows have to be compared, cut into tasks of bounded size.

    Every row goes to its nearest pivot, one of a bounded sample.  Rows within half the wanted
    angle of their pivot form its core cell, the others its rest cell; a cell with many rows
    is cut into blocks of about ``block_rows`` by hash.  Two cells are compared only where the
    angle of their pivots is at most the sum of the cell radii and the wanted angle: beyond
    it, by the triangle inequality, no pair is close enough.

    Where the sample shows that most cells have to be compared, many small cells would only send every row to many more
    tasks: there are fewer pivots then, and larger blocks, of up to ``COARSE_ROWS``; without ``skip_sure`` also such that a
    task finds about ``TASK_PAIRS`` pairs at most.

    By the same inequality all pairs inside a core are close enough.  With ``skip_sure`` they
    are not compared but linked to the least member (``sure``), so a large group of near
    copies costs one link per row.

    With ``moved``, a flag, two cells without a flagged row are not compared.
    """
    spark = vectors.sparkSession
    angle = float(np.arccos(np.clip(similarity, -1.0, 1.0)))
    flag = F.col(moved) if moved else F.lit(True)
    rows = vectors.select(F.col(key).alias("_id"), F.col(vector).cast("array<double>").alias("_v"), flag.alias("_moved"))
    count = rows.count()
    wanted = max(1, min(pivots, ceil(count / block_rows)))
    sampled = rows.orderBy(F.xxhash64("_id"), "_id").limit(SAMPLE_ROWS).toPandas()
    sample = matrix(sampled["_v"]) if len(sampled) else np.zeros((0, 1))
    centres = _choose_pivots(sample, wanted, angle / 4)
    close = sample @ sample.T >= similarity if len(sample) else np.zeros((0, 0), dtype=bool)
    expected = (close.sum() - np.trace(close)) / max(1, len(sample) * (len(sample) - 1)) * count * (count - 1) / 2
    coarse = min(ceil(count / COARSE_BLOCKS), COARSE_ROWS)
    if not skip_sure and len(sample):
        coarse = min(coarse, int((TASK_PAIRS / close.mean()) ** 0.5))
    if coarse > block_rows and _share_compared(sample, centres, angle) > MOST_COMPARED:
        block_rows = coarse
        centres = _choose_pivots(sample, max(1, min(pivots, ceil(count / block_rows / 2))), angle / 4)

    def assign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                near = matrix(batch["_v"]) @ centres.T
                best = np.argmax(near, axis=1)
                away = np.arccos(np.clip(near[np.arange(len(best)), best], -1.0, 1.0))
                rest = away > angle / 2 - ANGLE_ERROR
                yield batch.assign(_p=(2 * best + rest).astype("int32"), _angle=away)

    placed = checkpointed(rows.mapInPandas(assign, "_id bigint, _v array<double>, _moved boolean, _p int, _angle double"))
    facts = placed.groupBy("_p").agg(F.count(F.lit(1)).alias("n"), F.max("_angle").alias("r"), F.max("_moved").alias("moved")).orderBy("_p").toPandas()
    where, radius = facts["_p"].to_numpy(dtype="int64"), facts["r"].to_numpy(dtype="float64")
    parts = np.ceil(facts["n"].to_numpy(dtype="float64") / block_rows).astype("int64")
    pivot = centres[where // 2]
    apart = np.arccos(np.clip(pivot @ pivot.T, -1.0, 1.0))
    near = np.triu(apart <= radius[:, None] + radius[None, :] + angle + ANGLE_ERROR)
    fresh = facts["moved"].to_numpy(dtype=bool)
    near &= fresh[:, None] | fresh[None, :]
    if skip_sure:
        near &= ~np.diag(where % 2 == 0)
    i, j = np.nonzero(near)
    table = pd.DataFrame({"_p": where[i], "_q": where[j], "_np": parts[i], "_nq": parts[j]})
    pairs = F.broadcast(spark.createDataFrame(table, "_p int, _q int, _np bigint, _nq bigint"))

    def block(count: str) -> Column:
        return F.pmod(F.xxhash64("_id"), F.col(count)).cast("bigint")

    first = placed.join(pairs, "_p").withColumn("_a", block("_np"))
    start = F.when(F.col("_p") == F.col("_q"), F.col("_a")).otherwise(F.lit(0))
    first = first.select("_id", "_v", "_p", "_a", "_q", F.explode(F.sequence(start, F.col("_nq") - 1)).alias("_b"))
    second = placed.withColumnRenamed("_p", "_q").join(pairs, "_q").withColumn("_b", block("_nq"))
    end = F.when(F.col("_p") == F.col("_q"), F.col("_b")).otherwise(F.col("_np") - 1)
    second = second.select(
        F.col("_id").alias("_id2"),
        F.col("_v").alias("_v2"),
        F.col("_p").alias("_p2"),
        F.explode(F.sequence(F.lit(0).cast("bigint"), end)).alias("_a2"),
        F.col("_q").alias("_q2"),
        F.col("_b").alias("_b2"),
    )
    core = placed.filter(F.col("_p") % 2 == 0).select("_id", "_p")
    least = F.broadcast(core.groupBy("_p").agg(F.min("_id").alias("a")))
    sure = core.join(least, "_p").filter("a <> _id").select("a", F.col("_id").alias("b"))
    return BlockPairs(first, second, ["_p", "_a", "_q", "_b"], ["_p2", "_a2", "_q2", "_b2"], sure, float(expected))


def _close(left: pd.DataFrame, right: pd.DataFrame, similarity: float) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Positions and similarity of the pairs at or above the bound, each pair of a block once; tile by tile."""
    rows, columns = matrix(left["_v"]), matrix(right["_v2"])
    same = (left["_p"].iat[0], left["_a"].iat[0]) == (left["_q"].iat[0], left["_b"].iat[0])
    ids, ids2 = left["_id"].to_numpy(), right["_id2"].to_numpy()
    for i0 in range(0, len(rows), TILE):
        for j0 in range(0, len(columns), TILE):
            scores = rows[i0 : i0 + TILE] @ columns[j0 : j0 + TILE].T
            found = scores >= similarity
            if same:
                found &= ids[i0 : i0 + TILE, None] < ids2[None, j0 : j0 + TILE]
            i, j = np.nonzero(found)
            if len(i):
                yield i + i0, j + j0, scores[i, j]


def similar_pairs(
    vectors: DataFrame, key: str, vector: str, similarity: float, block_rows: int = BLOCK_ROWS
) -> DataFrame:
    """All unordered pairs with cosine similarity >= ``similarity`` as (id_a, id_b, similarity)."""
    return tested_pairs(block_pairs(vectors, key, vector, similarity, block_rows), similarity)


def tested_pairs(blocks: BlockPairs, similarity: float) -> DataFrame:
    """The pairs of the blocks with cosine similarity >= ``similarity`` as (id_a, id_b, similarity)."""

    def compare(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if left.empty or right.empty:
            return pd.DataFrame({"id_a": [], "id_b": [], "similarity": []})
        none = (np.zeros(0, "int64"), np.zeros(0, "int64"), np.zeros(0))
        i, j, score = (np.concatenate(found) for found in zip(none, *_close(left, right, similarity)))
        a, b = left["_id"].to_numpy()[i], right["_id2"].to_numpy()[j]
        return pd.DataFrame({"id_a": np.minimum(a, b), "id_b": np.maximum(a, b), "similarity": score})

    return (
        blocks.first.groupBy(*blocks.keys)
        .cogroup(blocks.second.groupBy(*blocks.keys2))
        .applyInPandas(compare, "id_a bigint, id_b bigint, similarity double")
    )


def link(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Labels after the edges (a, b): each label is the least position of its component, before and after."""
    while len(a):
        low, high = label[a], label[b]
        apart = low != high
        if not apart.any():
            break
        a, b, low, high = a[apart], b[apart], low[apart], high[apart]
        np.minimum.at(label, np.maximum(low, high), np.minimum(low, high))
        while (label[label] != label).any():
            label = label[label]
    return label


def linking_edges(
    vectors: DataFrame, key: str, vector: str, similarity: float, block_rows: int = BLOCK_ROWS, moved: str | None = None
) -> DataFrame:
    """Edges (a, b) with the same connected components as all similar pairs, or as those with a row that ``moved`` flags.

    Each block pair returns only a spanning forest, fewer edges than it has rows, so a large
    group of near copies does not produce a quadratic edge list.
    """

    def forest(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if left.empty or right.empty:
            return pd.DataFrame({"a": [], "b": []})
        ids = np.unique(np.concatenate([left["_id"].to_numpy(), right["_id2"].to_numpy()]))
        rows = np.searchsorted(ids, left["_id"].to_numpy())
        columns = np.searchsorted(ids, right["_id2"].to_numpy())
        label = np.arange(len(ids))
        for i, j, _ in _close(left, right, similarity):
            label = link(label, rows[i], columns[j])
        linked = label != np.arange(len(ids))
        return pd.DataFrame({"a": ids[label[linked]], "b": ids[linked]})

    blocks = block_pairs(vectors, key, vector, similarity, block_rows, skip_sure=True, moved=moved)
    tested = blocks.first.groupBy(*blocks.keys).cogroup(blocks.second.groupBy(*blocks.keys2))
    return tested.applyInPandas(forest, "a bigint, b bigint").union(blocks.sure)


def _nearest(ids: pd.Series, vectors: pd.Series, centre_ids: np.ndarray, centres: np.ndarray) -> pd.DataFrame:
    """Least distance and its centre for every row, tile by tile; ties take the first centre."""
    rows = matrix(vectors)
    best, distance = np.zeros(len(rows), dtype="int64"), np.zeros(len(rows))
    for i0 in range(0, len(rows), TILE):
        found = []
        for j0 in range(0, len(centres), TILE):
            away = 1.0 - rows[i0 : i0 + TILE] @ centres[j0 : j0 + TILE].T
            at = np.argmin(away, axis=1)
            found.append((at + j0, away[np.arange(len(at)), at]))
        where, least = (np.stack(part) for part in zip(*found))
        tile, each = np.argmin(least, axis=0), np.arange(where.shape[1])
        best[i0 : i0 + TILE], distance[i0 : i0 + TILE] = where[tile, each], least[tile, each]
    return pd.DataFrame({"_id": ids.to_numpy(), "centre": centre_ids[best], "distance": distance})


def nearest_centroid(
    points: DataFrame,
    key: str,
    vector: str,
    centres: DataFrame,
    centre_key: str,
    centre_vector: str,
    broadcast_bytes: int = BROADCAST_BYTES,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """(key, centre, distance): the centre with the least cosine distance; ties take the lowest id.

    Centres whose measured size is within ``broadcast_bytes`` are sent to every task and the
    points are not shuffled.  More centres are compared block by block and the best of all
    blocks is taken.
    """
    measured = centres.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.max(F.size(centre_vector)), F.lit(0)).alias("d")).first()
    schema = "_id bigint, centre bigint, distance double"
    source = points.select(F.col(key).alias("_id"), F.col(vector).cast("array<double>").alias("_v"))
    if measured["n"] == 0:
        return source.sparkSession.createDataFrame([], schema).withColumnRenamed("_id", key)
    if measured["n"] * measured["d"] * 8 <= broadcast_bytes:
        table = centres.select(centre_key, centre_vector).toPandas().sort_values(centre_key)
        shared = source.sparkSession.sparkContext.broadcast((table[centre_key].to_numpy(), matrix(table[centre_vector])))

        def assign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                if len(batch):
                    yield _nearest(batch["_id"], batch["_v"], *shared.value)

        return source.mapInPandas(assign, schema).withColumnRenamed("_id", key)

    point_blocks = max(1, ceil(points.count() / block_rows))
    centre_blocks = max(1, ceil(measured["n"] / block_rows))
    left = source.withColumn("_p", F.pmod(F.xxhash64("_id"), F.lit(point_blocks)).cast("int")).withColumn(
        "_c", F.explode(F.sequence(F.lit(0), F.lit(centre_blocks - 1)))
    )
    right = (
        centres.select(F.col(centre_key).alias("_id"), F.col(centre_vector).cast("array<double>").alias("_v"))
        .withColumn("_c", F.pmod(F.xxhash64("_id"), F.lit(centre_blocks)).cast("int"))
        .withColumn("_p", F.explode(F.sequence(F.lit(0), F.lit(point_blocks - 1))))
    )

    def compare(points_block: pd.DataFrame, centre_block: pd.DataFrame) -> pd.DataFrame:
        if points_block.empty or centre_block.empty:
            return pd.DataFrame({"_id": [], "centre": [], "distance": []})
        ordered = centre_block.sort_values("_id")
        return _nearest(points_block["_id"], points_block["_v"], ordered["_id"].to_numpy(), matrix(ordered["_v"]))

    partial = left.groupBy("_p", "_c").cogroup(right.groupBy("_p", "_c")).applyInPandas(compare, schema)
    best = partial.groupBy("_id").agg(F.min(F.struct("distance", "centre")).alias("best"))
    return best.select(F.col("_id").alias(key), F.col("best.centre").alias("centre"), F.col("best.distance").alias("distance"))


def linear_gender(vector: Column, weights: list[float], bias: float = 0.0) -> Column:
    """``m`` where the linear score is not positive (class 0), else ``f``."""
    score = dot(vector, F.array(*[F.lit(float(w)) for w in weights])) + F.lit(bias)
    return F.when(score <= 0, "m").otherwise("f")
