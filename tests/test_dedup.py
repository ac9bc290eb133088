import random

import pytest
from conftest import rows_of
from pyspark.sql import functions as F

from sonoloom.operators import dedup

SCHEMA = "id bigint, pos int, raw_file_name string, media_hash_code string"


def model(rows):
    names, hashes, kept = set(), set(), []
    for i, _, name, digest in sorted(rows, key=lambda r: r[1]):
        if (name is not None and name in names) or (digest is not None and digest in hashes):
            continue
        kept.append(i)
        names.add(name)
        hashes.add(digest)
    return sorted(kept)


@pytest.mark.parametrize("group_rows, scan_rows", [(0, 17), (0, 1_000), (5, 40), (10_000, 40)])
def test_in_order_rejection(spark, group_rows, scan_rows):
    for seed in range(2):
        rng = random.Random(seed)
        rows = []
        for i in range(150):
            name = rng.choice([None, "hot", "hot", f"n{rng.randrange(40)}", f"n{rng.randrange(40)}"])
            digest = rng.choice([None, f"h{rng.randrange(30)}", f"h{rng.randrange(90)}", f"h{rng.randrange(90)}"])
            rows.append((i, rng.randrange(10_000) * 150 + i, name, digest))
        df = spark.createDataFrame(rows, SCHEMA)
        got = dedup.reject_in_order(df, "id", ["pos"], group_rows=group_rows, scan_rows=scan_rows)
        assert sorted(r.id for r in got.collect()) == model(rows)


def test_chain_is_resolved_in_order(spark):
    rows = [(i, i, f"n{i // 2}", f"h{(i + 1) // 2}") for i in range(12)]
    got = dedup.reject_in_order(spark.createDataFrame(rows, SCHEMA), "id", ["pos"], group_rows=0)
    assert sorted(r.id for r in got.collect()) == model(rows)


def test_chain_of_many_rows_in_few_rounds(spark):
    n = 100_000
    rows = spark.range(n).selectExpr("id", "cast(id as int) as pos", "concat('n', id div 2) as raw_file_name", "concat('h', (id + 1) div 2) as media_hash_code")
    got = dedup.reject_in_order(rows, "id", ["pos"], scan_rows=60_000)
    assert got.agg(F.count(F.lit(1)), F.sum("id")).first() == (n // 2, sum(range(0, n, 2)))


def test_long_chain_is_one_component(spark):
    rows = [(i, i, f"n{i // 2}", f"h{(i + 1) // 2}") for i in range(1000)]
    got = dedup.reject_in_order(spark.createDataFrame(rows, SCHEMA), "id", ["pos"])
    assert sorted(r.id for r in got.collect()) == model(rows)


def test_known_and_unknown_split_the_input(spark):
    old = spark.createDataFrame([(1, 1, "a", "x"), (2, 2, None, None)], SCHEMA)
    new = spark.createDataFrame(
        [(1, 1, "a", "z"), (2, 2, "b", "x"), (3, 3, "b", "z"), (4, 4, None, None), (5, 5, "a", "x")], SCHEMA
    )
    assert rows_of(dedup.known_by_name_or_hash(new, old), "id") == [(1,), (2,), (5,)]
    assert rows_of(dedup.unknown_by_name_or_hash(new, old), "id") == [(3,), (4,)]


def test_duplicate_groups_and_first(spark):
    rows = [(1, 3, "a", "x"), (2, 1, "a", "x"), (3, 2, "b", "x"), (4, 4, None, "x"), (5, 5, None, "x")]
    df = spark.createDataFrame(rows, SCHEMA)
    assert rows_of(dedup.duplicate_groups(df, "raw_file_name"), "id") == [(1,), (2,), (4,), (5,)]
    assert rows_of(dedup.duplicate_groups(df.filter("id < 5"), "raw_file_name"), "id") == [(1,), (2,)]
    assert rows_of(dedup.first_per_key(df, ["raw_file_name"], ["pos"]), "id") == [(2,), (3,), (4,)]


def test_latest_keeps_ties(spark):
    df = spark.createDataFrame([(1, 5, "a"), (1, 7, "b"), (1, 7, "c"), (2, 1, "d")], "k int, t int, v string")
    assert rows_of(dedup.latest_with_ties(df, "k", "t"), "v") == [("b",), ("c",), ("d",)]
