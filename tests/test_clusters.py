import tracemalloc

import numpy as np
import pandas as pd
import pytest
from conftest import rows_of
from pyspark.sql import functions as F

from sonoloom.functions import vectors as vec
from sonoloom.operators import clusters as cl
from sonoloom.operators.components import components
from sonoloom.operators.density import density_labels


def unit(rows):
    return rows / np.linalg.norm(rows, axis=1, keepdims=True)


def blobs(seed=0, centres=6, each=30, dims=16, outliers=9, spread=0.02):
    rng = np.random.default_rng(seed)
    middle = unit(rng.normal(size=(centres, dims)))
    points = np.vstack([m + spread * rng.normal(size=(each, dims)) for m in middle] + [rng.normal(size=(outliers, dims))])
    truth = np.repeat(np.arange(centres), each).tolist() + [-1] * outliers
    order = rng.permutation(len(points))
    return unit(points)[order], np.array(truth)[order]


def frame(spark, points):
    return spark.createDataFrame([(i, [float(x) for x in p]) for i, p in enumerate(points)], "vec_id bigint, embedding array<double>")


def sums(spark, groups):
    rows = [(int(k), [float(x) for x in np.sum(v, axis=0)], len(v)) for k, v in groups.items()]
    return spark.createDataFrame(rows, "cluster bigint, total array<double>, size bigint")


def round_model(means, similarity, closest):
    """One merge round as index lists; ``means`` maps cluster -> unit vector."""
    ids = sorted(means)
    near = {a: [b for b in ids if b != a and 1 - means[a] @ means[b] <= 1 - similarity] for a in ids}
    covered, merges = set(), {}
    for head in ids:
        if near[head] and head not in covered:
            reach = [head]
            for node in reach:
                reach.extend(n for n in near[node] if n not in reach)
            covered.update(reach)
            for other in reach[1:]:
                if not closest or other in near[head]:
                    merges[other] = head
    return merges


def unit_means(groups):
    return {k: (m := np.mean(v, axis=0)) / np.linalg.norm(m) for k, v in groups.items()}


def random_groups(seed, n=40):
    rng = np.random.default_rng(seed)
    base = unit(rng.normal(size=(8, 6)))
    return {i: unit(base[rng.integers(8)] + 0.35 * rng.normal(size=(rng.integers(1, 5), 6))) for i in range(n)}


@pytest.mark.parametrize("closest", [True, False])
def test_merge_round_against_lists(spark, closest):
    for seed in (1, 2):
        groups = random_groups(seed)
        want = round_model(unit_means(groups), 0.9, closest)
        got = cl.merge_pairs(sums(spark, groups), 0.9, closest, block_rows=11)
        assert {r.cluster: r.key for r in got.collect()} == want


def test_repeated_rounds_against_lists(spark):
    groups = random_groups(5)
    state, similarity, lowered = dict(groups), 0.95, False
    while True:
        merges = round_model(unit_means(state), similarity, True)
        if not merges:
            if lowered or not similarity > 0.9:
                break
            similarity, lowered = similarity - 0.01, True
            continue
        lowered = False
        for lost, head in merges.items():
            state[head] = np.vstack([state[head], state[lost]])
        state = {k: v for k, v in state.items() if k not in merges}
    current, mapping = cl.merge_until_stable(sums(spark, groups), 0.95, 0.9, block_rows=13)
    assert {r.cluster: r["size"] for r in current.collect()} == {k: len(v) for k, v in state.items()}
    sizes = {}
    for r in mapping.collect():
        sizes[r.new] = sizes.get(r.new, 0) + len(groups[r.old])
    assert sizes == {k: len(v) for k, v in state.items()}


@pytest.mark.parametrize("closest", [True, False])
def test_a_task_goes_through_the_rounds_as_spark_does(spark, monkeypatch, closest):
    def merged(clusters):
        current, mapping = cl.merge_until_stable(clusters, 0.72, 0.6, 0.1, closest, block_rows=17)
        assert int(str(current._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())) < 1_000_000
        return [(r.cluster, r["size"], [round(x, 6) for x in r.total]) for r in current.orderBy("cluster").collect()], rows_of(mapping)

    clusters = sums(spark, random_groups(7, 60))
    monkeypatch.setattr(cl, "BROADCAST_BYTES", 0)
    by_spark = merged(clusters)
    assert len(by_spark[0]) < 40
    monkeypatch.undo()

    def no_round(*_):
        raise AssertionError("a round by Spark")

    monkeypatch.setattr(cl, "components", no_round)
    assert merged(clusters) == by_spark
    assert merged(clusters.limit(0)) == ([], [])


def test_rounds_carry_no_size_estimate_on(spark, monkeypatch):
    """The planner's size of the clusters stays that of the table, and the log of the rounds is put together on the way."""
    groups = random_groups(3, 20)
    monkeypatch.setattr(cl, "LOGGED_ROUNDS", 1)
    current, mapping = cl.merge_until_stable(sums(spark, groups), 0.95, 0.94)
    sizes = {}
    for r in mapping.collect():
        sizes[r.new] = sizes.get(r.new, 0) + len(groups[r.old])
    assert len(sizes) < len(groups)
    assert {r.cluster: r["size"] for r in current.collect()} == sizes
    for table in (current, cl.compose_moves(mapping.filter("old <> new"))):
        assert int(str(table._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())) < 1_000_000


def test_copies_give_few_edges(spark):
    copies = spark.createDataFrame([(i, [1.0, 0.0, 0.0]) for i in range(300)], "id bigint, v array<double>")
    edges = vec.linking_edges(copies, "id", "v", 0.9, block_rows=100)
    assert edges.count() == 299
    assert rows_of(components(edges).select("component").distinct()) == [(0,)]


def test_crowd_among_spread_out_rows_is_linked_once(spark):
    rng = np.random.default_rng(4)
    crowd = unit(np.eye(12)[:1] + 0.005 * rng.normal(size=(300, 12)))
    points = np.vstack([crowd, unit(rng.normal(size=(600, 12)))])
    edges = vec.linking_edges(frame(spark, points), "vec_id", "embedding", 0.95, block_rows=60)
    assert edges.count() < 600
    scores = points @ points.T
    linked = {r.node: r.component for r in components(edges).collect()}
    assert all(linked[i] == 0 for i in range(300))
    for i, j in zip(*np.nonzero(np.triu(scores >= 0.95, 1))):
        assert linked[i] == linked[j]


def test_components(spark):
    edges = [(1, 2), (2, 3), (10, 11), (12, 11), (5, 4), (3, 3), (20, 21), (21, 22), (22, 23), (23, 24), (24, 20)]
    got = components(spark.createDataFrame(edges, "a bigint, b bigint"))
    assert {r.node: r.component for r in got.collect()} == {
        1: 1, 2: 1, 3: 1, 10: 10, 11: 10, 12: 10, 4: 4, 5: 4, 20: 20, 21: 20, 22: 20, 23: 20, 24: 20,
    }


@pytest.mark.parametrize(
    "sizes,want",
    [([1] * 10 + [60], 19), ([2, 2, 2], 0), ([3, 3, 3, 3, 13], 0), ([4, 4, 4, 11], 0), ([1, 1, 4], 4), ([1] * 6 + [4], 2)],
)
def test_big_size_threshold(spark, sizes, want):
    mean, top = np.mean(sizes), max(sizes)
    kept = [mean * m for m in (5, 4, 3, 2) if top >= mean * m]
    model = int(kept[1]) if len(kept) > 2 else int(kept[0]) if len(kept) == 1 else 0
    df = spark.createDataFrame([(i, s) for i, s in enumerate(sizes)], "cluster bigint, size bigint")
    assert cl.big_size_threshold(df).first()[0] == model
    if want:
        assert model > 0


def test_density_finds_the_blobs():
    points, truth = blobs()
    labels = density_labels(points, 5, 2)
    for centre in range(6):
        found = labels[truth == centre]
        assert len(set(found[found >= 0])) == 1 and (found >= 0).mean() > 0.8
    assert len(set(labels[labels >= 0])) == 6
    order = np.random.default_rng(1).permutation(len(points))
    again = density_labels(points[order], 5, 2)
    first = {tuple(sorted(np.flatnonzero(labels == k))) for k in set(labels) - {-1}}
    second = {tuple(sorted(order[np.flatnonzero(again == k)])) for k in set(again) - {-1}}
    assert first == second


def test_density_edge_cases():
    points, _ = blobs(each=6, outliers=0)
    assert (density_labels(points[:3], 5, 2) == -1).all()
    same = np.tile(points[:1], (12, 1))
    assert len(density_labels(same, 3, 1)) == 12
    leaf = density_labels(points, 3, 1, "leaf")
    assert len(set(leaf) - {-1}) >= 6


def test_speaker_clusters_end_to_end(spark):
    points, truth = blobs(each=40)
    settings = cl.ClusterSettings(min_cluster_size=5, set_size=90, min_samples=2, fit_similarity=0.9)
    got = cl.speaker_clusters(frame(spark, points), "src", settings).orderBy("vec_id").collect()
    assert [r.vec_id for r in got] == list(range(len(points)))
    names = np.array([r.speaker_name for r in got])
    for centre in range(6):
        assert len(set(names[truth == centre])) == 1
    assert len(set(names[truth >= 0])) == 6
    assert "src_noise" in set(names[truth == -1])
    assert sorted(set(names) - {"src_noise"}) == [f"src_sp_{i}" for i in range(6)]
    ranks = {r.speaker_name: r.cluster for r in got if r.cluster is not None}
    assert [ranks[f"src_sp_{i}"] for i in range(6)] == sorted(ranks.values())


def test_no_cluster_gives_noise_only(spark):
    points, _ = blobs(centres=1, each=2, outliers=5)
    got = cl.speaker_clusters(frame(spark, points), "src", cl.ClusterSettings(min_cluster_size=5))
    assert {r.speaker_name for r in got.collect()} == {"src_noise"}


def test_noise_fit_respects_the_bound(spark):
    points, truth = blobs()
    groups = {c: points[truth == c] for c in range(6)}
    noise = frame(spark, points)
    got = {r.vec_id: r.cluster for r in cl.fit_noise(noise, sums(spark, groups), 0.95).collect()}
    means = np.stack([m for _, m in sorted(unit_means(groups).items())])
    distance = 1 - points @ means.T
    want = {i: int(np.argmin(d)) for i, d in enumerate(distance) if d.min() <= 1 - 0.95}
    assert got == want


def test_nearest_ties_take_the_lowest_id(spark):
    centres = spark.createDataFrame([(5, [1.0, 0.0]), (2, [1.0, 0.0]), (9, [0.0, 1.0])], "c bigint, v array<double>")
    points = spark.createDataFrame([(0, [2.0, 0.1]), (1, [0.0, 3.0])], "id bigint, v array<double>")
    for limit in (vec.BROADCAST_BYTES, 0):
        got = vec.nearest_centroid(points, "id", "v", centres, "c", "v", broadcast_bytes=limit, block_rows=1)
        assert rows_of(got.select("id", "centre")) == [(0, 2), (1, 9)]


def test_nearest_centres_are_compared_in_tiles():
    rng = np.random.default_rng(6)
    points, centres = unit(rng.normal(size=(5_000, 8))), unit(rng.normal(size=(5_000, 8)))
    centres[4_000:] = centres[:1_000]
    rows = pd.Series(list(points))
    tracemalloc.start()
    got = vec._nearest(pd.Series(range(5_000)), rows, np.arange(5_000) * 2, centres)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert most < 50_000_000  # all distances at once are 200 MB
    away = 1.0 - points @ centres[:4_000].T
    assert (got["centre"] == np.argmin(away, axis=1) * 2).all()
    assert np.allclose(got["distance"], away.min(axis=1))


def test_vector_expressions(spark):
    df = spark.createDataFrame([([1.0, 2.0, 3.0, 4.0],)], "v array<double>")
    x = np.array([1.0, 2.0, 3.0, 4.0])
    row = df.select(
        vec.softmax(F.col("v")).alias("s"),
        vec.score_strings(vec.softmax(F.col("v"))).alias("t"),
        vec.z_normalise(F.col("v"), log=False).alias("z"),
        vec.z_normalise(F.col("v")).alias("zl"),
        vec.unit(F.col("v")).alias("u"),
        vec.pad_to(F.col("v"), 6).alias("p"),
        vec.pad_to(F.col("v"), 2).alias("q"),
        vec.crop(F.col("v"), 2, F.lit(0.99)).alias("c"),
        vec.crop(F.col("v"), 9, F.lit(0.0)).alias("d"),
        vec.cosine_distance(F.col("v"), F.col("v")).alias("self"),
        vec.language_scores(F.array(F.lit("a"), F.lit("b")), F.array(F.lit("0.1"), F.lit("0.9"))).alias("m"),
    ).first()
    soft = np.exp(x - 4) / np.exp(x - 4).sum()
    assert np.allclose(row.s, soft) and row.t == [f"{v:.5f}" for v in soft]
    assert np.allclose(row.z, (x - x.mean()) / (x.std() + 1e-5))
    y = np.log1p(x)
    assert np.allclose(row.zl, (y - y.mean()) / (y.std() + 1e-5))
    assert np.allclose(row.u, x / np.linalg.norm(x))
    assert row.p == [1, 2, 3, 4, 0, 0] and row.q == [1, 2, 3, 4] and row.d == [1, 2, 3, 4]
    assert row.c == [2.0, 3.0] and abs(row.self) < 1e-12 and row.m == {"a": "0.1", "b": "0.9"}


def test_pairs_are_complete_and_far_blocks_are_skipped(spark):
    points, _ = blobs(centres=8, each=25, dims=12, spread=0.05)
    df = frame(spark, points)
    for bound in (0.97, 0.5, -1.0):
        scores = points @ points.T
        want = {(i, j) for i in range(len(points)) for j in range(i + 1, len(points)) if scores[i, j] >= bound}
        got = vec.similar_pairs(df, "vec_id", "embedding", bound, block_rows=10)
        assert {(r.id_a, r.id_b) for r in got.collect()} == want

    def compared(bound):
        """Row pairs that some task multiplies."""
        blocks = vec.block_pairs(df, "vec_id", "embedding", bound, block_rows=10)
        left = blocks.first.groupBy(*blocks.keys).count()
        right = blocks.second.groupBy(*[F.col(b).alias(a) for a, b in zip(blocks.keys, blocks.keys2)]).agg(F.count("*").alias("n"))
        return left.join(right, blocks.keys).agg(F.sum(F.col("count") * F.col("n"))).first()[0]

    assert compared(0.97) < compared(-1.0) / 3
    copies = spark.createDataFrame([(i, [1.0, 0.001 * (i % 3)]) for i in range(60)], "id bigint, v array<double>")
    blocks = vec.block_pairs(copies, "id", "v", 0.9, block_rows=10)
    assert blocks.first.groupBy(*blocks.keys).count().agg(F.max("count")).first()[0] <= 30
    sure = vec.block_pairs(copies, "id", "v", 0.9, block_rows=10, skip_sure=True)
    assert sure.first.isEmpty() and sure.sure.count() == 59
    assert vec.similar_pairs(copies, "id", "v", 0.9, block_rows=10).count() == 60 * 59 // 2
    assert vec.similar_pairs(copies.limit(0), "id", "v", 0.9).count() == 0


def test_rows_are_sent_to_few_tasks_where_pivots_rule_out_little(spark):
    points = unit(np.random.default_rng(3).normal(size=(600, 24)))
    df = frame(spark, points)
    blocks = vec.block_pairs(df, "vec_id", "embedding", 0.3, block_rows=5)
    assert blocks.first.count() + blocks.second.count() < 600 * 3 * vec.COARSE_BLOCKS
    scores = points @ points.T
    want = {(i, j) for i in range(600) for j in range(i + 1, 600) if scores[i, j] >= 0.3}
    got = vec.similar_pairs(df, "vec_id", "embedding", 0.3, block_rows=5)
    assert {(r.id_a, r.id_b) for r in got.collect()} == want
