"""Voice segments of an unbounded flag stream; the ring and the open segment are kept as state."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from sonoloom.operators.segments import scan_flags


def stream_segments(frames: DataFrame, ring: int, stream: str = "stream", order: str = "ts", flag: str = "flag") -> DataFrame:
    """(stream, start_idx, end_idx) of segments as they close; frames of a batch are put in order."""

    def scan(key: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        rows = pd.concat(list(parts)).sort_values(order)
        first, triggered, kept, opened = state.get if state.exists else (0, False, "", -1)
        segments, triggered, held, opened = scan_flags(
            rows[flag].to_numpy(), first, ring, triggered, [c == "1" for c in kept], None if opened < 0 else opened
        )
        text = "".join("1" if f else "0" for f in held)
        state.update((first + len(rows), triggered, text, -1 if opened is None else opened))
        yield pd.DataFrame(
            {stream: [key[0]] * len(segments), "start_idx": [s for s, _ in segments], "end_idx": [e for _, e in segments]}
        )

    kind = frames.schema[stream].dataType.simpleString()
    return frames.groupBy(stream).applyInPandasWithState(
        scan,
        f"{stream} {kind}, start_idx bigint, end_idx bigint",
        "next_idx bigint, triggered boolean, ring string, open_idx bigint",
        "append",
        GroupStateTimeout.NoTimeout,
    )
