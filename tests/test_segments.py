import random
from collections import deque

import numpy as np
import pytest
from conftest import rows_of
from pyspark.sql import functions as F

from sonoloom.operators import segments as seg


def model(flags, size):
    """The segmenter as a loop over a ring of the last ``size`` frames."""
    ring, on, start, found = deque(maxlen=size), False, None, []
    for at, voiced in enumerate(flags):
        ring.append((at, voiced))
        if sum(v != on for _, v in ring) > 0.9 * size:
            if on:
                found.append((start, at))
            else:
                start = ring[0][0]
            on = not on
            ring.clear()
    return found + ([(start, len(flags) - 1)] if on else [])


def streams(seed, count=6, longest=160):
    rng = random.Random(seed)
    made = {}
    for s in range(count):
        stay = rng.choice([0.7, 0.85, 0.95])
        flags, current = [], rng.random() < 0.5
        for _ in range(rng.randrange(1, longest)):
            current = current if rng.random() < stay else not current
            flags.append(current if rng.random() < 0.97 else not current)
        made[s] = flags
    return made


def frames(spark, made):
    rows = [(s, i, f) for s, flags in made.items() for i, f in enumerate(flags)]
    return spark.createDataFrame(rows, "stream int, idx bigint, flag boolean")


def found(df):
    got = {}
    for r in df.collect():
        got.setdefault(r[0], []).append((r.start_idx, r.end_idx))
    return {k: sorted(v) for k, v in got.items()}


@pytest.mark.parametrize("size", [1, 3, 10])
def test_runs_equal_the_loop(spark, size):
    made = streams(size)
    want = {s: m for s, flags in made.items() if (m := model(flags, size))}
    assert found(seg.hysteresis(frames(spark, made), size)) == want


@pytest.mark.parametrize("size,chunk", [(3, 7), (11, 13), (20, 50), (12, 1000)])
def test_chunks_equal_the_loop(spark, size, chunk):
    made = streams(100 + size)
    want = {s: m for s, flags in made.items() if (m := model(flags, size))}
    assert found(seg.hysteresis(frames(spark, made), size, max_group_rows=0, chunk_frames=chunk)) == want


def test_rounds_do_not_grow_with_the_chunks(spark, monkeypatch):
    """64 voiced chunks, and with a pause in one of them, are scanned in a few rounds."""
    made = {0: [True] * 1280, 1: [True] * 700 + [False] * 60 + [True] * 520}
    saved, calls = seg.checkpointed, []
    monkeypatch.setattr(seg, "checkpointed", lambda df: calls.append(1) or saved(df))
    want = {s: model(flags, 12) for s, flags in made.items()}
    assert found(seg.hysteresis(frames(spark, made), 12, chunk_frames=20)) == want
    assert len(calls) <= 3 + 3 * 4


def test_rechunk_replaces_long_segments_once(spark):
    made = streams(7, longest=200)
    rng = random.Random(3)
    strict = {s: [f and rng.random() < 0.8 for f in flags] for s, flags in made.items()}
    rows = [(s, i, f, strict[s][i]) for s, flags in made.items() for i, f in enumerate(flags)]
    df = spark.createDataFrame(rows, "stream int, idx bigint, flag boolean, strict_flag boolean")
    want = {}
    for s, flags in made.items():
        for a, b in model(flags, 3):
            again = [(a, b)] if b - a + 1 <= 15 else [(a + x, a + y) for x, y in model(strict[s][a : b + 1], 3)]
            want.setdefault(s, []).extend(again)
    want = {s: sorted(v) for s, v in want.items() if v}
    segments = seg.hysteresis(df, 3)
    assert found(seg.rechunk(df, segments, 15, 3)) == want
    assert found(seg.rechunk(df, segments, 15, 3, max_group_rows=0, partitions=15)) == want


def test_framing_drops_a_frame_that_exactly_fits(spark):
    rows = [("a", i, float(i)) for i in range(8)] + [("b", i, float(i)) for i in range(9)]
    df = spark.createDataFrame(rows, "stream string, idx bigint, value double")
    got = {(r.stream, r.frame): (r.timestamp, r["values"]) for r in seg.framing(df, 4, 8.0).collect()}
    assert got == {
        ("a", 0): (0.0, [0.0, 1.0, 2.0, 3.0]),
        ("b", 0): (0.0, [0.0, 1.0, 2.0, 3.0]),
        ("b", 1): (0.5, [4.0, 5.0, 6.0, 7.0]),
    }


def test_stream_gives_the_same_closed_segments(spark, tmp_path):
    from sonoloom.streaming.voice import stream_segments

    made = streams(11, count=3, longest=120)
    df = frames(spark, made)
    source = str(tmp_path / "frames")
    schema = "stream int, idx bigint, flag boolean"
    for part in range(3):
        df.filter((F.col("idx") >= part * 40) & (F.col("idx") < (part + 1) * 40)).coalesce(1).write.mode("append").parquet(source)
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(source)
    out = stream_segments(stream, 3, "stream", "idx", "flag")
    run = (
        out.writeStream.format("memory").queryName("closed_segments").outputMode("append")
        .option("checkpointLocation", str(tmp_path / "ckpt")).trigger(availableNow=True).start()
    )
    run.awaitTermination(120)
    got = found(spark.table("closed_segments"))
    for s, flags in made.items():
        whole = model(flags, 3)
        assert got.get(s, []) in (whole, whole[:-1])


def test_chunks_are_scanned_in_a_stream_and_may_span_batches(spark, monkeypatch):
    """One Python call per group made many short chunks slow; chunks now follow one another in few batches."""
    from pyspark.sql import GroupedData

    def refuse(*_):
        raise AssertionError("a Python call per chunk")

    monkeypatch.setattr(GroupedData, "cogroup", refuse)
    rng = np.random.default_rng(5)
    rows = [(s, i, bool(f)) for s in (1, 2, 3) for i, f in enumerate(np.repeat(rng.random(40) < 0.5, 4))]
    df = spark.createDataFrame(rows, "stream bigint, idx bigint, flag boolean")
    want = rows_of(seg.hysteresis(df, 3))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        for chunk in (5, 23):
            assert rows_of(seg.hysteresis(df, 3, max_group_rows=0, chunk_frames=chunk)) == want
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
