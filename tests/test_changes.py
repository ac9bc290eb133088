"""Changes applied in turn, against a loop."""

import random

import pytest
from conftest import rows_of
from pyspark.sql import functions as F

from sonoloom.operators import mutations as mut


@pytest.mark.parametrize("seed", range(3))
def test_changes_in_turn(spark, seed):
    rng = random.Random(seed)
    table = {k: [rng.choice([None, "old"]), rng.choice([None, True, False]), rng.choice([None, ["z"]])] for k in range(8)}
    log = [(rng.randrange(10), i, rng.choice([None, "a", "b"]), rng.choice([None, True, False]), [rng.choice("pq")]) for i in range(25)]
    rows = spark.createDataFrame([(k, *v) for k, v in table.items()], "k int, name string, done boolean, used array<string>")
    rng.shuffle(log)
    changes = spark.createDataFrame(log, "k int, seq int, name string, done boolean, used array<string>")
    rules = {"name": mut.take_new, "done": mut.STICKY_TRUE, "used": mut.ENGINE_UNION}
    got = {r.k: r for r in mut.apply_changes(rows, changes, ["k"], rules, ["seq"]).collect()}
    assert set(got) == set(table)
    for key, (name, done, used) in table.items():
        mine = sorted((c for c in log if c[0] == key), key=lambda c: c[1])
        for _, _, new_name, new_done, new_used in mine:
            name, used = new_name, sorted({*(used or []), *new_used})
        flags = [c[3] for c in mine if c[3] is not None]
        assert (got[key].name, got[key].used) == (name, used)
        if mine and done is not True:
            done = max(flags) if flags else None
        assert got[key].done == done


def test_later_sets_win_and_no_order_is_repeatable(spark):
    rows = spark.createDataFrame([("a.wav", 0, "x"), ("b.wav", 0, "x")], "k string, n int, s string")
    sets = [spark.createDataFrame([("a.wav", 5), ("a.wav", 6)], "k string, n int"), spark.createDataFrame([("a.wav", 1)], "k string, n int")]
    assert rows_of(mut.bulk_apply(rows, sets, ["k"], ["n"])) == [("a.wav", 1, "x"), ("b.wav", 0, "x")]
    assert rows_of(mut.bulk_apply(rows, sets[::-1], ["k"], ["n"])) == [("a.wav", 6, "x"), ("b.wav", 0, "x")]
    assert rows_of(mut.bulk_apply(rows, [], ["k"], ["n"])) == rows_of(rows)
    assert rows_of(mut.apply_changes(rows, sets[0], ["k"], {"n": mut.take_new})) == [("a.wav", 5, "x"), ("b.wav", 0, "x")]
    log = mut.change_log(sets)
    assert rows_of(log.select("k", "n", F.col("change"))) == [("a.wav", 1, 1), ("a.wav", 5, 0), ("a.wav", 6, 0)]
