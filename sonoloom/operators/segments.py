"""Voice segments over ordered flags: hysteresis, framing, re-chunking of long segments.

Frames are rows (stream, idx, flag) with ``idx`` dense from 0 in each stream.  A segment
opens when more than 90 % of a ring of N frames is voiced and starts at the ring's first frame;
it closes when more than 90 % is unvoiced, at that frame; the ring is emptied at each switch.

* up to N = 10 "more than 90 %" means all N frames, so segments follow from run lengths
  (windows, used while the largest stream was measured to fit one task);
* otherwise each stream is cut into chunks that are scanned at the same time.  A chunk starts
  from the state (on or off, and the ring) its predecessor ended in; chunks whose assumed start
  turns out wrong are scanned again, until all agree.  Where an open segment began is not part
  of that state: it is filled in afterwards, so a stream that stays voiced settles at once.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sonoloom.operators.ordered import MAX_GROUP_ROWS, largest_group, row_index, running_total
from sonoloom.operators.skew import join_lookup
from sonoloom.session import checkpointed

CHUNK_FRAMES = 100_000

_SCANNED = (
    "segments array<struct<start_idx:bigint,end_idx:bigint>>, last_idx bigint, "
    "triggered boolean, ring array<boolean>, open_idx bigint"
)


def _by_runs(frames: DataFrame, stream: str, idx: str, flag: str, ring: int) -> DataFrame:
    ordered = Window.partitionBy(stream).orderBy(idx)
    changed = F.coalesce((F.col(flag) != F.lag(flag).over(ordered)).cast("int"), F.lit(1))
    marked = frames.withColumn("_changed", changed)
    numbered = marked.withColumn("_run", F.sum("_changed").over(ordered.rowsBetween(Window.unboundedPreceding, 0)))
    runs = numbered.groupBy(stream, "_run").agg(
        F.first(flag).alias("_flag"), F.min(idx).alias("_start"), F.max(idx).alias("_last")
    )
    in_stream = Window.partitionBy(stream).orderBy("_run")
    stream_end = F.max("_last").over(Window.partitionBy(stream))
    long_runs = runs.withColumn("_end_of_stream", stream_end).filter(F.col("_last") - F.col("_start") + 1 >= ring)
    switches = long_runs.withColumn("_before", F.coalesce(F.lag("_flag").over(in_stream), F.lit(False))).filter(
        F.col("_flag") != F.col("_before")
    )
    closing = F.lead("_start").over(in_stream) + (ring - 1)
    return (
        switches.withColumn("end_idx", F.coalesce(closing, F.col("_end_of_stream")))
        .filter("_flag")
        .select(stream, F.col("_start").alias("start_idx"), "end_idx")
    )


def _first_switch(voiced: np.ndarray, begin: int, start: int, size: int, triggered: bool) -> int | None:
    """First frame from ``start`` on whose ring, begun at ``begin``, asks for a switch; ``voiced`` are cumulative counts."""
    step = max(1024, 4 * size)
    while start < len(voiced) - 1:
        at = np.arange(start, min(start + step, len(voiced) - 1))
        oldest = np.maximum(begin, at + 1 - size)
        hits = voiced[at + 1] - voiced[oldest]
        if triggered:
            hits = at + 1 - oldest - hits
        found = np.flatnonzero(hits > 0.9 * size)
        if len(found):
            return int(at[found[0]])
        start, step = start + step, 2 * step
    return None


def scan_flags(flags: np.ndarray, first: int, size: int, triggered: bool, ring: list[bool], open_idx: int | None) -> tuple:
    """Segments closed in one chunk and the state it ends in.

    A chunk that begins inside a segment may be given no ``open_idx``: its first segment then has no start either.
    """
    frames = np.concatenate([np.array(ring, bool), np.asarray(flags, bool)])
    voiced = np.concatenate([[0], np.cumsum(frames)])
    base, begin, start, segments = first - len(ring), 0, len(ring), []
    while (at := _first_switch(voiced, begin, max(begin, start), size, triggered)) is not None:
        if triggered:
            segments.append((open_idx, base + at))
            open_idx = None
        else:
            open_idx = base + max(begin, at - size + 1)
        triggered, begin = not triggered, at + 1
    return segments, triggered, frames[max(begin, len(frames) - size) :].tolist(), open_idx


def _by_chunks(frames: DataFrame, keys: list[str], idx: str, flag: str, ring: int, chunk_frames: int) -> DataFrame:
    chunked = checkpointed(
        frames.select(
            *keys, F.col(idx).alias("_idx"), F.col(flag).alias("_flag"), F.floor(F.col(idx) / F.lit(chunk_frames)).cast("bigint").alias("_chunk")
        )
    )
    chunk_keys = [*keys, "_chunk"]
    key_ddl = ", ".join(f"{k} {chunked.schema[k].dataType.simpleString()}" for k in chunk_keys)
    schema = f"{key_ddl}, {_SCANNED}"

    def one(rows: pd.DataFrame) -> dict:
        before = rows.iloc[0]
        segments, triggered, kept, opened = scan_flags(
            rows["_flag"].to_numpy(), int(before["_idx"]), ring, bool(before["in_triggered"]), [c == "1" for c in before["in_ring"]], None
        )
        return {
            **{k: before[k] for k in chunk_keys},
            "segments": [{"start_idx": s, "end_idx": e} for s, e in segments],
            "last_idx": int(rows["_idx"].iat[-1]),
            "triggered": triggered,
            "ring": kept,
            "open_idx": opened,
        }

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """The chunks of a partition, which follow one another; the last of a batch may go on in the next."""
        held: list[pd.DataFrame] = []

        def table(found: list[dict]) -> pd.DataFrame:
            return pd.DataFrame(found, columns=[*chunk_keys, "segments", "last_idx", "triggered", "ring", "open_idx"]).astype({"open_idx": "Int64"})

        for batch in batches:
            if batch.empty:
                continue
            fresh = np.zeros(len(batch), bool)
            for k in chunk_keys:
                values = batch[k].to_numpy()
                fresh[1:] |= values[1:] != values[:-1]
            cuts = np.flatnonzero(fresh).tolist()
            pieces = [batch.iloc[i:j] for i, j in zip([0, *cuts], [*cuts, len(batch)])]
            found = []
            for n, piece in enumerate(pieces):
                if held and (n or any(held[0][k].iat[0] != piece[k].iat[0] for k in chunk_keys)):
                    found.append(one(pd.concat(held) if len(held) > 1 else held[0]))
                    held.clear()
                held.append(piece)
            if found:
                yield table(found)
        if held:
            yield table([one(pd.concat(held))])

    def run(starts: DataFrame) -> DataFrame:
        """The chunks of ``starts`` from their states: each task scans many chunks, one after the other."""
        bits = F.array_join(F.transform("in_ring", lambda x: x.cast("int").cast("string")), "")
        wanted = chunked.join(starts.select(*chunk_keys, "in_triggered", bits.alias("in_ring")), chunk_keys)
        return wanted.repartition(*chunk_keys).sortWithinPartitions(*chunk_keys, "_idx").mapInPandas(scan, schema)

    no_ring = F.array().cast("array<boolean>")
    starts = checkpointed(
        chunked.select(*chunk_keys)
        .distinct()
        .select(*chunk_keys, F.lit(False).alias("in_triggered"), no_ring.alias("in_ring"))
    )
    scanned = checkpointed(run(starts))
    while True:
        carried = scanned.select(
            *keys,
            (F.col("_chunk") + 1).alias("_chunk"),
            F.col("triggered").alias("in_triggered"),
            F.col("ring").alias("in_ring"),
        )
        expected = starts.select(*chunk_keys).join(carried, chunk_keys, "left").select(
            *chunk_keys,
            F.coalesce("in_triggered", F.lit(False)).alias("in_triggered"),
            F.coalesce("in_ring", no_ring).alias("in_ring"),
        )
        expected = checkpointed(expected)
        wrong = expected.exceptAll(starts)
        if wrong.isEmpty():
            break
        again = checkpointed(run(wrong))
        scanned = checkpointed(scanned.join(again.select(*chunk_keys), chunk_keys, "left_anti").unionByName(again))
        starts = expected
    # a segment that began in an earlier chunk starts where the last chunk with an opening left it open
    earlier = Window.partitionBy(*keys).orderBy("_chunk")
    opened = F.when(F.col("triggered"), F.col("open_idx"))
    scanned = scanned.withColumn("_from", F.last(opened, True).over(earlier.rowsBetween(Window.unboundedPreceding, -1)))
    scanned = scanned.withColumn("open_idx", F.coalesce(opened, "_from"))
    closed = scanned.select(*keys, "_from", F.explode("segments").alias("_s")).select(
        *keys, F.coalesce("_s.start_idx", "_from").alias("start_idx"), "_s.end_idx"
    )
    last = scanned.groupBy(*keys).agg(F.max_by(F.struct("triggered", "open_idx", "last_idx"), "_chunk").alias("_e"))
    trailing = last.filter("_e.triggered").select(
        *keys, F.col("_e.open_idx").alias("start_idx"), F.col("_e.last_idx").alias("end_idx")
    )
    return closed.unionByName(trailing)


def hysteresis(
    frames: DataFrame,
    ring: int,
    keys: str | Sequence[str] = "stream",
    idx: str = "idx",
    flag: str = "flag",
    *,
    max_group_rows: int = MAX_GROUP_ROWS,
    chunk_frames: int = CHUNK_FRAMES,
) -> DataFrame:
    """(keys, start_idx, end_idx) of every segment, both ends inclusive."""
    names = [keys] if isinstance(keys, str) else list(keys)
    if ring <= 10 and largest_group(frames, names) <= max_group_rows:
        single = frames if len(names) == 1 else frames.withColumn("_stream", F.struct(*names))
        found = _by_runs(single, names[0] if len(names) == 1 else "_stream", idx, flag, ring)
        return found if len(names) == 1 else found.select("_stream.*", "start_idx", "end_idx")
    return _by_chunks(frames, names, idx, flag, ring, chunk_frames)


def rechunk(
    frames: DataFrame,
    segments: DataFrame,
    max_frames: int,
    ring: int,
    stream: str = "stream",
    idx: str = "idx",
    strict_flag: str = "strict_flag",
    **sizes: int,
) -> DataFrame:
    """Segments longer than ``max_frames`` replaced by those of a stricter flag; one level only."""
    too_long = F.col("end_idx") - F.col("start_idx") + 1 > max_frames
    long_ones = segments.filter(too_long)
    starts = long_ones.select(stream, F.col("start_idx").alias(idx), F.lit(1).alias("_opens"))
    marked = frames.select(stream, idx, strict_flag).join(starts, [stream, idx], "left")
    numbered = running_total(
        marked, F.coalesce("_opens", F.lit(0)).cast("bigint"), [idx], [stream], "_segment", **sizes
    ).filter("_segment > 0")
    ends = row_index(long_ones, ["start_idx"], [stream], "_segment", **sizes).withColumn("_segment", F.col("_segment") + 1)
    inside = numbered.join(ends, [stream, "_segment"]).filter(F.col(idx) <= F.col("end_idx"))
    shifted = inside.select(
        stream, "_segment", "start_idx", (F.col(idx) - F.col("start_idx")).alias("_at"), F.col(strict_flag).alias("_strict")
    )
    again = hysteresis(shifted.select(stream, "_segment", "_at", "_strict"), ring, [stream, "_segment"], "_at", "_strict")
    offsets = ends.select(stream, "_segment", F.col("start_idx").alias("_from"))
    replaced = again.join(offsets, [stream, "_segment"]).select(
        stream, (F.col("start_idx") + F.col("_from")).alias("start_idx"), (F.col("end_idx") + F.col("_from")).alias("end_idx")
    )
    return segments.filter(~too_long).select(stream, "start_idx", "end_idx").unionByName(replaced)


def framing(
    samples: DataFrame, size: int, rate: float, stream: str = "stream", idx: str = "idx", value: str = "value"
) -> DataFrame:
    """(stream, frame, timestamp, duration, values): fixed frames that end before the last sample.

    A final frame that exactly fits is dropped, as the end test is strict.
    """
    lengths = samples.groupBy(stream).agg((F.max(idx) + 1).alias("_length"))
    framed = samples.withColumn("frame", F.floor(F.col(idx) / F.lit(size)).cast("bigint"))
    grouped = framed.groupBy(stream, "frame").agg(F.array_sort(F.collect_list(F.struct(idx, value))).alias("_v"))
    whole = join_lookup(grouped, lengths, stream).filter((F.col("frame") + 1) * size < F.col("_length"))
    return whole.select(
        stream,
        "frame",
        (F.col("frame") * size / F.lit(rate)).alias("timestamp"),
        F.lit(size / rate).alias("duration"),
        F.transform("_v", lambda v: v[value]).alias("values"),
    )


def number_frames(events: DataFrame, stream: str, order_by: Sequence[str], **sizes: int) -> DataFrame:
    """Add the dense ``idx`` of each row within its stream."""
    return row_index(events, order_by, [stream], "idx", **sizes)
