"""Queries over the given embeddings: distances, centroids, clusters."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from sonoloom.functions import vectors as vec
from sonoloom.operators import clusters as cl
from sonoloom.operators.hooks import classify, gender_of_label
from sonoloom.operators.ordered import blocks
from sonoloom.plans.registry import query
from sonoloom.plans.views import embeddings

V = "CAST(embedding AS DOUBLE[])"
UNIT = "E AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings)"
MEANS = f"""{UNIT},
D AS (SELECT label, i, avg(v[i]) AS m FROM E, (SELECT unnest(generate_series(1, 64)) AS i) GROUP BY label, i),
C AS (SELECT label, list(m ORDER BY i) AS mean FROM D GROUP BY label),
G AS (SELECT label, list_transform(mean, lambda x: x / sqrt(list_inner_product(mean, mean))) AS c FROM C)"""


def rounded(column, digits=6):
    return F.round(column, digits)


@query(
    f"""WITH {UNIT} SELECT a.vec_id AS id_a, b.vec_id AS id_b, round(list_cosine_similarity(a.v, b.v), 5) AS similarity
FROM E a JOIN E b ON a.vec_id < b.vec_id WHERE list_cosine_similarity(a.v, b.v) >= 0.35"""
)
def cosine_pairs(spark, sf_dir):
    pairs = vec.similar_pairs(embeddings(spark, sf_dir), "vec_id", "embedding", 0.35, block_rows=200)
    return pairs.select("id_a", "id_b", rounded(F.col("similarity"), 5).alias("similarity"))


@query(f"WITH {MEANS} SELECT label, unnest(generate_series(0, 63)) AS i, round(unnest(c), 6) AS value FROM G")
def centroids(spark, sf_dir):
    means = vec.centroids(embeddings(spark, sf_dir), "label", "embedding")
    return means.select("label", F.posexplode("centroid").alias("i", "value")).select(
        "label", F.col("i").cast("bigint").alias("i"), rounded(F.col("value")).alias("value")
    )


NEAREST = f"""WITH {MEANS},
N AS (SELECT vec_id, E.label AS own, G.label AS centre, 1 - list_cosine_similarity(v, c) AS distance FROM E CROSS JOIN G),
Q AS (SELECT vec_id, own, arg_min(centre, (distance, centre)) AS centre, min(distance) AS distance FROM N GROUP BY vec_id, own)"""


@query(f"{NEAREST} SELECT vec_id, CAST(centre AS BIGINT) AS centre, round(distance, 6) AS distance FROM Q")
def nearest_centroid(spark, sf_dir):
    rows = embeddings(spark, sf_dir)
    means = vec.centroids(rows, "label", "embedding")
    found = vec.nearest_centroid(rows, "vec_id", "embedding", means, "label", "centroid")
    return found.select("vec_id", "centre", rounded(F.col("distance")).alias("distance"))


@query(f"{NEAREST} SELECT vec_id, CAST(centre AS BIGINT) AS centre, round(distance, 6) AS distance FROM Q")
def nearest_centroid_blocks(spark, sf_dir):
    """The block form, for centroids beyond the broadcast bound."""
    rows = embeddings(spark, sf_dir)
    means = vec.centroids(rows, "label", "embedding")
    found = vec.nearest_centroid(
        rows, "vec_id", "embedding", means, "label", "centroid", broadcast_bytes=0, block_rows=100
    )
    return found.select("vec_id", "centre", rounded(F.col("distance")).alias("distance"))


@query(
    f"""WITH {UNIT}, T AS (SELECT vec_id, list_transform(v[1:4], lambda x: exp(x * 10)) AS p FROM E)
SELECT vec_id, format('{{:.4f}}', p[1] / list_sum(p)) AS s1, format('{{:.4f}}', p[2] / list_sum(p)) AS s2,
  format('{{:.4f}}', p[3] / list_sum(p)) AS s3, format('{{:.4f}}', p[4] / list_sum(p)) AS s4 FROM T"""
)
def softmax_scores(spark, sf_dir):
    """Class scores as fixed-point texts keyed by language (compared to four digits)."""
    logits = F.transform(F.slice("embedding", 1, 4), lambda x: x.cast("double") * 10)
    names = F.array(*[F.lit(n) for n in ("en", "hi", "ta", "te")])
    scores = vec.softmax(logits)
    mapped = vec.language_scores(names, F.transform(scores, lambda s: F.format_string("%.4f", s)))
    rows = embeddings(spark, sf_dir).select("vec_id", mapped.alias("m"), vec.score_strings(scores).alias("five"))
    kept = rows.filter(F.length(F.get("five", 0)) == 7)
    return kept.select("vec_id", *[F.col("m")[n].alias(f"s{i}") for i, n in enumerate(("en", "hi", "ta", "te"), 1)])


ZNORM = f"""{UNIT}, L AS (SELECT vec_id, list_transform(v, lambda x: ln(1 + abs(x))) AS x FROM E),
M AS (SELECT vec_id, x, list_avg(x) AS mu FROM L),
Z AS (SELECT vec_id, x, mu, sqrt(list_avg(list_transform(x, lambda y: (y - mu) * (y - mu)))) AS sd FROM M)"""


@query(f"WITH {ZNORM} SELECT vec_id, round((x[1] - mu) / (sd + 1e-5), 6) AS z1, round((x[64] - mu) / (sd + 1e-5), 6) AS z64 FROM Z")
def znorm(spark, sf_dir):
    frame = F.transform("embedding", lambda x: F.abs(x.cast("double")))
    rows = embeddings(spark, sf_dir).select("vec_id", vec.z_normalise(frame).alias("z"))
    return rows.select("vec_id", rounded(F.get("z", 0)).alias("z1"), rounded(F.get("z", 63)).alias("z64"))


@query(
    f"""WITH {UNIT} SELECT vec_id, CAST(greatest(64, 60 + vec_id % 10) AS BIGINT) AS padded, round(list_sum(v), 6) AS total FROM E"""
)
def zero_padding(spark, sf_dir):
    """Vectors padded with zeros to a length that differs by row class."""
    rows = embeddings(spark, sf_dir).select("vec_id", F.col("embedding").cast("array<double>").alias("v"))
    padded = F.when(F.lit(False), F.col("v"))
    for rest in range(10):
        padded = F.when(F.col("vec_id") % 10 == rest, vec.pad_to(F.col("v"), 60 + rest)).otherwise(padded)
    total = F.aggregate("p", F.lit(0.0), lambda s, x: s + x)
    return rows.withColumn("p", padded).select("vec_id", F.size("p").cast("bigint").alias("padded"), rounded(total).alias("total"))


WEIGHTS = [((i * 7) % 11 - 5) / 5 for i in range(64)]
WEIGHTS_SQL = "[" + ", ".join(f"{w}::DOUBLE" for w in WEIGHTS) + "]"


@query(f"WITH {UNIT} SELECT vec_id, CASE WHEN list_inner_product(v, {WEIGHTS_SQL}) <= 0 THEN 'm' ELSE 'f' END AS gender FROM E")
def gender_score(spark, sf_dir):
    return embeddings(spark, sf_dir).select("vec_id", vec.linear_gender(F.col("embedding"), WEIGHTS).alias("gender"))


class SignModel:
    """A stand-in classifier: class 1 where the weighted sum is positive."""

    def predict(self, rows):
        return (rows.astype("float64") @ WEIGHTS > 0).astype("int32")


@query(f"WITH {UNIT} SELECT vec_id, CASE WHEN list_inner_product(v, {WEIGHTS_SQL}) <= 0 THEN 'm' ELSE 'f' END AS gender FROM E")
def gender_hook(spark, sf_dir):
    """The classifier hook with a model loaded once per task."""
    labelled = classify(embeddings(spark, sf_dir), SignModel)
    return gender_of_label(labelled).select("vec_id", "gender")


@query(f"WITH {UNIT} SELECT vec_id, round(list_sum(v[1 + vec_id % 33 : 32 + vec_id % 33]), 6) AS total FROM E")
def random_crop(spark, sf_dir):
    """Crops of 32 values at a position that stands for the random draw."""
    position = (F.col("vec_id") % 33 + 0.5) / 32
    rows = embeddings(spark, sf_dir).withColumn("v", F.col("embedding").cast("array<double>"))
    cropped = vec.crop(F.col("v"), 32, F.least(position, F.lit(32.5 / 32)))
    return rows.withColumn("c", cropped).select(
        "vec_id", rounded(F.aggregate("c", F.lit(0.0), lambda s, x: s + x)).alias("total")
    )


@query("SELECT vec_id, (row_number() OVER (ORDER BY vec_id) - 1) // 150 AS partial_set FROM embeddings")
def partial_sets(spark, sf_dir):
    return blocks(embeddings(spark, sf_dir).select("vec_id"), 150, ["vec_id"], "partial_set")


@query(
    """WITH T AS (SELECT label, count(*) AS size FROM embeddings GROUP BY label),
Q AS (SELECT avg(size) AS mean, max(size) AS top FROM T),
K AS (SELECT list_filter([5, 4, 3, 2], lambda m: top >= mean * m) AS kept, mean FROM Q)
SELECT CAST(CASE WHEN len(kept) > 2 THEN floor(mean * kept[2]) WHEN len(kept) = 1 THEN floor(mean * kept[1]) ELSE 0 END AS BIGINT) AS threshold
FROM K"""
)
def big_clusters(spark, sf_dir):
    sums = cl.cluster_sums(embeddings(spark, sf_dir), "embedding", "label")
    return cl.big_size_threshold(sums)


@query(
    f"""{NEAREST} SELECT vec_id, CAST(centre AS BIGINT) AS cluster FROM Q WHERE distance <= 1 - 0.3"""
)
def noise_fit(spark, sf_dir):
    """Every vector as noise, fitted to the centroids of the given labels."""
    rows = embeddings(spark, sf_dir)
    sums = cl.cluster_sums(rows, "embedding", "label")
    return cl.fit_noise(rows, sums, 0.3)


@query(
    """SELECT (rn - 1) // 150 AS partial_set, CAST(sum(CASE WHEN label = 0 THEN 1 ELSE 0 END) AS BIGINT) AS noise_rows,
  count(DISTINCT CASE WHEN label <> 0 THEN label END) AS clusters
FROM (SELECT label, row_number() OVER (ORDER BY vec_id) AS rn FROM embeddings) GROUP BY 1"""
)
def cluster_stats(spark, sf_dir):
    """Noise rows and clusters per partial set, with label 0 as noise."""
    labelled = embeddings(spark, sf_dir).select("vec_id", F.when(F.col("label") != 0, F.col("label")).alias("cluster"))
    return cl.cluster_stats(blocks(labelled, 150, ["vec_id"], "partial_set"))


def _each_vector(spark, sf_dir):
    """Every vector as a cluster of its own."""
    return cl.cluster_sums(embeddings(spark, sf_dir).withColumn("cluster", F.col("vec_id")))


@query(
    f"""WITH RECURSIVE {UNIT},
H AS (SELECT a.vec_id AS x, b.vec_id AS y FROM E a JOIN E b ON a.vec_id <> b.vec_id WHERE 1 - list_cosine_similarity(a.v, b.v) <= 1 - 0.38),
W AS (SELECT x AS node, x AS seen FROM H UNION SELECT W.node, H.y FROM W JOIN H ON W.seen = H.x),
O AS (SELECT node, min(seen) AS head FROM W GROUP BY node)
SELECT node AS cluster, head AS key FROM O JOIN H ON H.x = node AND H.y = head WHERE node <> head"""
)
def merge_round(spark, sf_dir):
    """One merge round at similarity 0.38 over single-vector clusters."""
    return cl.merge_pairs(_each_vector(spark, sf_dir), 0.38, block_rows=200)


@query(
    f"""WITH RECURSIVE {UNIT},
H AS (SELECT a.vec_id AS x, b.vec_id AS y FROM E a JOIN E b ON a.vec_id <> b.vec_id WHERE 1 - list_cosine_similarity(a.v, b.v) <= 1 - 0.38),
W AS (SELECT x AS node, x AS seen FROM H UNION SELECT W.node, H.y FROM W JOIN H ON W.seen = H.x)
SELECT node AS cluster, min(seen) AS key FROM W GROUP BY node HAVING min(seen) <> node"""
)
def merge_components(spark, sf_dir):
    """The same round taking whole components."""
    return cl.merge_pairs(_each_vector(spark, sf_dir), 0.38, closest_only=False, block_rows=200)


@query(
    """SELECT CAST(label - label % 2 AS BIGINT) AS cluster, count(*) AS size, round(sum(embedding[1]::DOUBLE), 4) AS first
FROM embeddings GROUP BY 1"""
)
def absorb_clusters(spark, sf_dir):
    """Sums and sizes after every odd label was merged into the even one before it."""
    sums = cl.cluster_sums(embeddings(spark, sf_dir).withColumn("cluster", F.col("label").cast("bigint")))
    merges = sums.filter("cluster % 2 = 1").select("cluster", (F.col("cluster") - 1).alias("key"))
    whole = cl.absorb(sums, merges)
    return whole.select("cluster", "size", F.round(F.get("total", F.lit(0)), 4).alias("first"))


def _merge_rounds(start: float, end: float, step: float, rounds: int) -> str:
    """SQL of repeated merging with every round written out: Ci the clusters, Ti the bound, Mi the merges of round i."""
    parts = [
        UNIT,
        "C0 AS MATERIALIZED (SELECT vec_id AS cluster, CAST(embedding AS DOUBLE[]) AS total, 1 AS size FROM embeddings)",
        f"T0 AS MATERIALIZED (SELECT {start}::DOUBLE AS bound, false AS lowered, false AS done)",
    ]
    for i in range(rounds):
        parts += [
            f"""H{i} AS MATERIALIZED (SELECT a.cluster AS x, b.cluster AS y FROM C{i} a JOIN C{i} b ON a.cluster <> b.cluster, T{i}
  WHERE NOT done AND list_cosine_similarity(a.total, b.total) >= bound)""",
            f"W{i} AS (SELECT x AS node, x AS seen FROM H{i} UNION SELECT W{i}.node, H{i}.y FROM W{i} JOIN H{i} ON W{i}.seen = H{i}.x)",
            f"""M{i} AS MATERIALIZED (SELECT node AS cluster, head AS key FROM (SELECT node, min(seen) AS head FROM W{i} GROUP BY node)
  JOIN H{i} ON x = node AND y = head WHERE node <> head)""",
            f"""C{i + 1} AS MATERIALIZED (SELECT cluster, list(v ORDER BY d) AS total, any_value(size) AS size FROM (
  SELECT cluster, d, sum(v) AS v, any_value(size) AS size FROM (
    SELECT coalesce(key, C{i}.cluster) AS cluster, unnest(total) AS v, unnest(range(len(total))) AS d,
      sum(size) OVER (PARTITION BY coalesce(key, C{i}.cluster)) AS size FROM C{i} LEFT JOIN M{i} ON M{i}.cluster = C{i}.cluster)
  GROUP BY cluster, d) GROUP BY cluster)""",
            f"""T{i + 1} AS MATERIALIZED (SELECT CASE WHEN n = 0 AND NOT lowered AND bound > {end} THEN bound - {step} ELSE bound END AS bound,
  n = 0 AS lowered, done OR (n = 0 AND (lowered OR NOT bound > {end})) AS done FROM T{i}, (SELECT count(*) AS n FROM M{i}))""",
        ]
    return f"WITH RECURSIVE {', '.join(parts)} SELECT cluster, CAST(size AS BIGINT) AS size FROM C{rounds}"


@query(_merge_rounds(0.42, 0.40, 0.01, 12))
def merge_repeat(spark, sf_dir):
    """Rounds from similarity 0.42 down to 0.40 over single-vector clusters."""
    clusters, _ = cl.merge_until_stable(_each_vector(spark, sf_dir), 0.42, 0.40)
    return clusters.select("cluster", "size")


@query(
    """SELECT a.vec_id, round(1 - list_cosine_similarity(a.embedding::DOUBLE[], b.embedding::DOUBLE[]), 6) AS distance
FROM embeddings a JOIN embeddings b ON b.vec_id = a.vec_id + 1"""
)
def cosine_distances(spark, sf_dir):
    """The column expression: each vector's distance to the next one."""
    rows = embeddings(spark, sf_dir)
    onward = rows.select((F.col("vec_id") - 1).alias("vec_id"), F.col("embedding").alias("_next"))
    distance = vec.cosine_distance(F.transform("embedding", lambda x: x.cast("double")), F.transform("_next", lambda x: x.cast("double")))
    return rows.join(onward, "vec_id").select("vec_id", F.round(distance, 6).alias("distance"))


SPLIT = """G AS (SELECT vec_id, CASE WHEN label <> 0 THEN CAST(label AS BIGINT) END AS cluster FROM embeddings),
Z AS (SELECT cluster FROM G WHERE cluster IS NOT NULL GROUP BY cluster HAVING count(*) >= (SELECT avg(n) FROM (SELECT count(*) AS n FROM G WHERE cluster IS NOT NULL GROUP BY cluster))),
I AS (SELECT vec_id, cluster, CASE WHEN cluster IN (SELECT cluster FROM Z) THEN
    CASE WHEN vec_id % 7 <> 0 THEN 1000 + 10 * cluster + vec_id % 3 END ELSE cluster END AS part FROM G)"""
# parts 0 and 1 of a split cluster move to part 2, clusters that are not split move to the one 4 above, in chains
MOVED = """CASE WHEN part >= 1000 THEN part - part % 10 + 2 WHEN part IS NOT NULL THEN
    (SELECT max(c) FROM (SELECT DISTINCT part AS c FROM I WHERE part < 1000) WHERE c % 4 = I.part % 4) END"""


@query(f"WITH {SPLIT} SELECT vec_id, coalesce(cluster IN (SELECT cluster FROM Z), false) AS was_big, {MOVED} AS cluster FROM I")
def split_and_recombined(spark, sf_dir):
    """Given labels: the larger clusters split by given parts, put back together, and renamed by a log of chained moves."""
    members, big, inside, moves = _given_split(spark, sf_dir)
    whole = cl.renamed(cl.recombine(members, big, inside), cl.compose_moves(moves))
    flagged = members.join(big.withColumn("_big", F.lit(True)), "cluster", "left").select("vec_id", F.coalesce("_big", F.lit(False)).alias("was_big"))
    return whole.select("vec_id", "cluster").join(flagged, "vec_id")


@query(f"""WITH {SPLIT} SELECT cluster, count(*) AS size, CAST(sum(first) AS BIGINT) AS first FROM (SELECT part AS cluster, CAST(floor(embedding[1]::DOUBLE * 1000) AS BIGINT) AS first
  FROM I JOIN embeddings USING (vec_id) WHERE part IS NOT NULL) GROUP BY cluster""")
def recombined_sums(spark, sf_dir):
    """Sums of the clusters that were not split and of the parts, as one table of clusters."""
    members, big, inside, _ = _given_split(spark, sf_dir)
    scaled = F.transform("embedding", lambda x: F.floor(x.cast("double") * 1000).cast("double"))

    def sums(rows):
        return cl.cluster_sums(rows.withColumn("embedding", scaled))

    whole = cl.recombined_sums(sums(members), big, sums(inside))
    return whole.select("cluster", "size", F.round(F.get("total", F.lit(0))).cast("bigint").alias("first"))


@query(f"WITH {SPLIT} SELECT vec_id, cluster IS NOT NULL AS lost_in_split FROM I WHERE part IS NULL")
def noise_complement(spark, sf_dir):
    """What is in no cluster after the split: the noise from before, and what the split left over."""
    members, big, inside, _ = _given_split(spark, sf_dir)
    noise = cl.recombine(members, big, inside).filter("cluster IS NULL").select("vec_id")
    return noise.join(members.select("vec_id", F.col("cluster").isNotNull().alias("lost_in_split")), "vec_id")


def _given_split(spark, sf_dir):
    """Members by label (0 is noise), the clusters of at least mean size, their members by parts, and moves between clusters."""
    members = embeddings(spark, sf_dir).select("vec_id", "embedding", F.when(F.col("label") != 0, F.col("label").cast("bigint")).alias("cluster"))
    sizes = members.filter("cluster IS NOT NULL").groupBy("cluster").count()
    big = sizes.join(sizes.agg(F.avg("count").alias("mean"))).filter("count >= mean").select("cluster")
    part = F.when(F.col("vec_id") % 7 != 0, 1000 + 10 * F.col("cluster") + F.col("vec_id") % 3)
    inside = members.join(big, "cluster", "left_semi").withColumn("cluster", part)
    parts = inside.filter("cluster IS NOT NULL").select(F.col("cluster").alias("old")).distinct()
    down = parts.select("old", (F.col("old") - F.col("old") % 10 + F.least(F.col("old") % 10 + 1, F.lit(2))).alias("new"))
    kept = sizes.join(big, "cluster", "left_anti").select(F.col("cluster").alias("old"))
    onward = kept.withColumn("new", F.lead("old").over(Window.partitionBy(F.col("old") % 4).orderBy("old"))).filter("new IS NOT NULL")
    return members, big, inside, down.filter("old <> new").unionByName(onward)


@query()
def density_clusters(spark, sf_dir):
    found = cl.density_clusters(embeddings(spark, sf_dir), set_size=250, min_cluster_size=3)
    return found.select("vec_id", "cluster")


@query()
def cluster_members(spark, sf_dir):
    """The whole analysis: blocks, merges, split of big clusters, noise fit, names."""
    settings = cl.ClusterSettings(min_cluster_size=3, set_size=250, fit_similarity=0.3, start_similarity=0.6, end_similarity=0.58)
    return cl.speaker_clusters(embeddings(spark, sf_dir), "src0", settings)


@query(
    """SELECT vec_id, CAST(label AS BIGINT) AS cluster, CASE WHEN label = 0 THEN 'src0_noise'
  ELSE concat('src0_sp_', dense_rank() OVER (ORDER BY CASE WHEN label = 0 THEN NULL ELSE label END) - 1) END AS speaker_name
FROM embeddings"""
)
def cluster_names(spark, sf_dir):
    """Names by the rank of the cluster id; label 0 stands for noise."""
    rows = embeddings(spark, sf_dir).select("vec_id", F.col("label").cast("bigint").alias("cluster"))
    ids = rows.filter("cluster <> 0").select("cluster").distinct()
    marked = rows.withColumn("cluster", F.when(F.col("cluster") != 0, F.col("cluster")))
    return cl.name_clusters(marked, ids, "src0").select("vec_id", F.coalesce("cluster", F.lit(0)).alias("cluster"), "speaker_name")
