"""Queries over ordered flags: segments, re-chunked segments, frames."""

from __future__ import annotations

from pyspark.sql import functions as F

from sonoloom.operators import segments as seg
from sonoloom.plans.registry import query
from sonoloom.plans.views import flag_events, sql, table


def numbered(spark, sf_dir):
    return seg.number_frames(flag_events(spark, sf_dir), "user_id", ["ts", "event_id"])


def _segments_sql(frames: str, keys: str, ring: int) -> str:
    """Runs of at least ``ring`` equal flags that switch the state, paired up."""
    return f"""(SELECT {keys}, start_idx, coalesce(next_start + {ring - 1}, stream_end) AS end_idx FROM (
  SELECT *, lead(start_idx) OVER (PARTITION BY {keys} ORDER BY start_idx) AS next_start FROM (
    SELECT *, coalesce(lag(flag) OVER (PARTITION BY {keys} ORDER BY start_idx), false) AS before FROM (
      SELECT {keys}, flag, min(idx) AS start_idx, max(idx) AS last_idx, any_value(stream_end) AS stream_end FROM (
        SELECT *, idx - row_number() OVER (PARTITION BY {keys}, flag ORDER BY idx) AS island,
          max(idx) OVER (PARTITION BY {keys}) AS stream_end FROM {frames})
      GROUP BY {keys}, flag, island HAVING count(*) >= {ring}))
  WHERE flag <> before) WHERE flag)"""


SEGMENTS = _segments_sql("F", "user_id", 3)


@query(sql("F", f"SELECT user_id, start_idx, end_idx FROM {SEGMENTS}"))
def hysteresis(spark, sf_dir):
    return seg.hysteresis(numbered(spark, sf_dir), 3, "user_id")


@query(sql("F", f"SELECT user_id, start_idx, end_idx FROM {SEGMENTS}"))
def hysteresis_chunks(spark, sf_dir):
    """The same segments by chunks that carry their state, the form for very long streams."""
    return seg.hysteresis(numbered(spark, sf_dir), 3, "user_id", max_group_rows=0, chunk_frames=40)


# The segmenter frame by frame: one recursion step reads one frame of every stream.
WIDE = """WITH RECURSIVE F AS (
  SELECT user_id, value > 20 AS flag, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS idx,
    count(*) OVER (PARTITION BY user_id) AS n FROM events),
W AS (
  SELECT DISTINCT user_id, CAST(-1 AS BIGINT) AS idx, n, false AS is_on, CAST(0 AS BIGINT) AS bits, CAST(0 AS BIGINT) AS len,
    CAST(NULL AS BIGINT) AS open_idx, CAST(NULL AS BIGINT) AS start_idx, CAST(NULL AS BIGINT) AS end_idx FROM F
  UNION ALL
  SELECT user_id, idx, n, is_on <> turn, CASE WHEN turn THEN 0 ELSE bits END, CASE WHEN turn THEN 0 ELSE len END,
    CASE WHEN NOT turn THEN open_idx WHEN NOT is_on THEN idx - len + 1 END,
    CASE WHEN is_on AND (turn OR idx = n - 1) THEN open_idx WHEN turn AND idx = n - 1 THEN idx - len + 1 END,
    CASE WHEN is_on AND (turn OR idx = n - 1) OR turn AND idx = n - 1 THEN idx END
  FROM (SELECT *, CASE WHEN is_on THEN len - bit_count(bits) ELSE bit_count(bits) END > 0.9 * 12 AS turn FROM (
    SELECT W.user_id, F.idx, W.n, is_on, open_idx, ((bits << 1) | CAST(F.flag AS BIGINT)) & 4095 AS bits, least(len + 1, 12) AS len
    FROM W JOIN F ON F.user_id = W.user_id AND F.idx = W.idx + 1)))
SELECT user_id, start_idx, end_idx FROM W WHERE end_idx IS NOT NULL"""


@query(WIDE)
def hysteresis_wide(spark, sf_dir):
    """A ring of 12 frames, where one frame of the ring may disagree."""
    return seg.hysteresis(numbered(spark, sf_dir), 12, "user_id")


STRICT = """G AS (SELECT F.user_id, T.start_idx AS seg, F.idx - T.start_idx AS idx, F.strict_flag AS flag
  FROM F JOIN T ON F.user_id = T.user_id AND F.idx BETWEEN T.start_idx AND T.end_idx WHERE T.end_idx - T.start_idx + 1 > 20)"""


@query(
    sql(
        "F",
        f"""SELECT user_id, start_idx, end_idx FROM {SEGMENTS} WHERE end_idx - start_idx + 1 <= 20 UNION ALL
SELECT user_id, seg + start_idx, seg + end_idx FROM {_segments_sql("G", "user_id, seg", 3)}""",
    ).replace("\nSELECT user_id, start_idx", f",\nT AS (SELECT * FROM {SEGMENTS}),\n{STRICT}\nSELECT user_id, start_idx", 1)
)
def rechunk(spark, sf_dir):
    frames = numbered(spark, sf_dir)
    return seg.rechunk(frames, seg.hysteresis(frames, 3, "user_id"), 20, 3, "user_id")


@query(
    """WITH V AS (SELECT user_id, value, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS idx,
    count(*) OVER (PARTITION BY user_id) AS n FROM events)
SELECT user_id, idx // 8 AS frame, round((idx // 8) * 8 / 16.0::DOUBLE, 6) AS timestamp, 0.5::DOUBLE AS duration, round(sum(value), 4) AS total
FROM V WHERE (idx // 8 + 1) * 8 < n GROUP BY user_id, idx // 8"""
)
def framing(spark, sf_dir):
    rows = seg.number_frames(table(spark, sf_dir, "events").select("user_id", "ts", "event_id", "value"), "user_id", ["ts", "event_id"])
    frames = seg.framing(rows.select("user_id", "idx", "value"), 8, 16.0, "user_id")
    total = F.aggregate("values", F.lit(0.0), lambda s, x: s + x)
    return frames.select("user_id", "frame", F.round("timestamp", 6).alias("timestamp"), "duration", F.round(total, 4).alias("total"))
