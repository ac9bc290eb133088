import random
from itertools import accumulate

from conftest import rows_of
from pyspark.sql import functions as F

from sonoloom.operators import ordered as o
from sonoloom.operators import skew


def data(spark, n=400, seed=1):
    rng = random.Random(seed)
    keys = [None, "a", "b", "hot", "hot", "hot", "hot"]
    rows = [(rng.choice(keys), rng.randrange(30), i, rng.randrange(1, 9)) for i in range(n)]
    return rows, spark.createDataFrame(rows, "k string, t int, i int, v bigint")


def test_running_total_forms_agree_with_a_loop(spark):
    rows, df = data(spark)
    want = {}
    for key in {r[0] for r in rows}:
        mine = sorted((r for r in rows if r[0] == key), key=lambda r: (r[1], r[2]))
        want.update(zip((r[2] for r in mine), accumulate(r[3] for r in mine)))
    for sizes in ({}, {"max_group_rows": 0, "partitions": 23}, {"max_group_rows": 0, "partitions": 1}, {"max_group_rows": 0}):
        got = o.running_total(df, F.col("v"), ["t", "i"], ["k"], **sizes)
        assert {r.i: r.running_total for r in got.collect()} == want


def test_total_order_and_index(spark):
    rows, df = data(spark)
    ordered = sorted(rows, key=lambda r: (r[1], r[2]))
    for size in (40, 7, 1, None):
        got = o.running_total(df, F.col("v"), ["t", "i"], partitions=size)
        assert {r.i: r.running_total for r in got.collect()} == dict(
            zip((r[2] for r in ordered), accumulate(r[3] for r in ordered))
        )
        index = o.row_index(df, ["t", "i"], partitions=size)
        assert {r.i: r.row_index for r in index.collect()} == {r[2]: n for n, r in enumerate(ordered)}


def test_order_may_be_descending(spark):
    rows, df = data(spark)
    ordered = sorted(rows, key=lambda r: (-r[1], r[2]))
    got = o.row_index(df, [F.col("t").desc(), F.col("i").asc()], partitions=13)
    assert {r.i: r.row_index for r in got.collect()} == {r[2]: n for n, r in enumerate(ordered)}


def test_blocks_first_rows_and_lists(spark, monkeypatch):
    rows, df = data(spark)
    counts = o.blocks(df, 150, ["i"]).groupBy("block").count()
    assert rows_of(counts) == [(0, 150), (1, 150), (2, 100)]
    small = o.first_rows(df, 37, ["t", "i"])
    monkeypatch.setattr(o, "LIMIT_ROWS", 0)
    assert rows_of(small) == rows_of(o.first_rows(df, 37, ["t", "i"], partitions=30))
    parts = o.list_parts(df, ["k"], F.col("i"), ["t", "i"], "ids", items=10, max_group_rows=0, partitions=20).collect()
    assert max(len(p.ids) for p in parts) == 10
    for key in {r[0] for r in rows}:
        whole = [i for p in sorted((p for p in parts if p.k == key), key=lambda p: p.part) for i in p.ids]
        assert whole == [r[2] for r in sorted((r for r in rows if r[0] == key), key=lambda r: (r[1], r[2]))]


def test_micros_are_exact(spark):
    df = spark.createDataFrame([(0.1,)] * 10, "d double").withColumn("i", F.monotonically_increasing_id())
    assert o.running_total(df, o.micros("d"), ["i"]).agg(F.max("running_total")).first()[0] == 1_000_000


def test_lookup_join_with_hot_and_null_keys(spark):
    rows, df = data(spark)
    lookup = spark.createDataFrame([("hot", 1), ("a", 2), ("unused", 3)], "k string, n int")
    for how in ("inner", "left"):
        want = rows_of(df.join(lookup, "k", how).select("k", "i", "n"))
        for options in ({}, {"hot": ["hot"], "salts": 5}, {"hot": ["hot", "unused"], "spread_by": F.col("i")}):
            assert rows_of(skew.join_lookup(df, lookup, "k", how, **options).select("k", "i", "n")) == want
    assert "hot" in skew.hot_keys(df, "k", 50)


def test_largest_group(spark):
    rows, df = data(spark)
    assert o.largest_group(df, ["k"]) == max(sum(r[0] == k for r in rows) for k in {r[0] for r in rows})
    assert o.largest_group(df.limit(0), ["k"]) == 0


def test_parts_of_a_total_order_do_not_grow_with_the_table(spark, monkeypatch):
    from sonoloom.operators import ordered

    monkeypatch.setattr(ordered, "PART_ROWS", 20)
    df = spark.range(200).select((F.col("id") * 7 % 200).alias("k"))
    parts = ordered.range_split(df, [], [F.col("k")])
    assert parts.groupBy("_part").count().agg(F.max("count")).first()[0] < 45
    rows = ordered.row_index(df, ["k"], output="at")
    assert rows.filter("k <> at").isEmpty() and rows.count() == 200
