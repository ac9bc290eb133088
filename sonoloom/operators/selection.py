"""Declarative selection of utterances within quality, speaker and total-duration budgets."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sonoloom.operators.ordered import MAX_GROUP_ROWS, first_rows, largest_group, micros, running_total

DURATION = "clipped_utterance_duration"
FILE_NAME = "clipped_utterance_file_name"
INLINE_IDS = 1_000


def exclude_ids(df: DataFrame, column: str, ids: Sequence[Any]) -> DataFrame:
    """Drop rows whose ``column`` is one of ``ids``; a NULL is not one of them and stays."""
    if not ids:
        return df
    if len(ids) <= INLINE_IDS:
        return df.filter(F.coalesce(~F.col(column).isin(list(ids)), F.lit(True)))
    listed = df.sparkSession.createDataFrame([(i,) for i in ids], f"{column} {df.schema[column].dataType.simpleString()}")
    return df.join(listed, column, "left_anti")


def within(column: str, bounds: dict[str, float]) -> Column:
    """Inclusive range test for a ``{"gte": x, "lte": y}`` bound."""
    return F.col(column).between(bounds["gte"], bounds["lte"])


def sample_rows(df: DataFrame, fraction: float, key: Sequence[str], seed: int = 0) -> DataFrame:
    """Exactly ``round(fraction * n)`` rows, chosen and ordered by a seeded hash of the key.

    The added ``_shuffle`` column holds the random order, for use as an ``order_by``.
    """
    shuffled = df.withColumn("_shuffle", shuffle_key(key, seed))
    if fraction >= 1:
        return shuffled
    return first_rows(shuffled, round(fraction * df.count()), ["_shuffle", *key])


def shuffle_key(key: Sequence[str], seed: int) -> Column:
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *[F.col(k).cast("string") for k in key]))


def cap_total(df: DataFrame, hours: float, order_by: Sequence[str], duration: str = DURATION, **sizes: int) -> DataFrame:
    """Rows, in order, while their running duration stays within ``hours``."""
    value = micros(duration).cast("decimal(20,0)")
    limit = round(hours * 3_600_000_000)
    known = df.filter(F.col(duration).isNotNull())
    return running_total(known, value, order_by, output="_total", ceiling=limit, **sizes).drop("_total")


def speaker_budget(
    df: DataFrame,
    order_by: Sequence[str],
    *,
    gte_per_speaker_duration: float,
    lte_per_speaker_duration: float,
    with_threshold: float = 0.0,
    speaker: str = "speaker_id",
    duration: str = DURATION,
    max_group_rows: int = MAX_GROUP_ROWS,
    **sizes: int,
) -> DataFrame:
    """Per speaker (minutes): rows while the running duration is within the upper bound.

    Only speakers with some running duration between the two bounds are kept; rows without a
    speaker are dropped.
    """
    low = round((gte_per_speaker_duration - with_threshold) * 60_000_000)
    high = round((lte_per_speaker_duration + with_threshold) * 60_000_000)
    known = df.filter(F.col(speaker).isNotNull() & F.col(duration).isNotNull())
    in_bounds = F.col("_total").between(low, high)
    if largest_group(known, [speaker]) <= max_group_rows:
        ordered = Window.partitionBy(speaker).orderBy(*order_by).rowsBetween(Window.unboundedPreceding, 0)
        totals = known.withColumn("_total", F.sum(micros(duration)).over(ordered))
        kept = totals.withColumn("_kept", F.max(in_bounds).over(Window.partitionBy(speaker)))
        return kept.filter(F.col("_kept") & (F.col("_total") <= high)).drop("_kept", "_total")
    totals = running_total(
        known, micros(duration), order_by, [speaker], "_total", ceiling=high, max_group_rows=0, **sizes
    )
    qualified = totals.filter(in_bounds).select(speaker).distinct()
    return totals.join(qualified, speaker, "left_semi").drop("_total")


@dataclass
class FilterSpec:
    """A selection request; unknown keys of the source dictionary are ignored."""

    by_utterance_duration: dict[str, float] | None = None
    by_snr: dict[str, float] | None = None
    by_speaker: dict[str, float] | None = None
    by_duration: float | None = None
    with_randomness: bool = False
    with_fraction: float = 1.0
    exclude_audio_ids: list = field(default_factory=list)
    exclude_speaker_ids: list = field(default_factory=list)

    @classmethod
    def from_dict(cls, spec: dict[str, Any]) -> FilterSpec:
        known = {k: v for k, v in spec.items() if k in cls.__dataclass_fields__}
        if isinstance(known.get("with_randomness"), str):
            known["with_randomness"] = known["with_randomness"] == "true"
        made = cls(**known)
        for name in ("by_utterance_duration", "by_snr"):
            bounds = getattr(made, name)
            if bounds is not None and not {"gte", "lte"} <= bounds.keys():
                raise ValueError(f"{name} needs gte and lte")
        return made

    def apply(self, df: DataFrame, order_by: Sequence[str], *, compat: bool = False, seed: int = 0) -> DataFrame:
        """The selected rows.

        ``compat`` repeats an old quirk: the audio exclusion tests the speaker id and starts
        again from the input, which cancels the speaker exclusion.
        """
        rows = exclude_ids(df, "speaker_id", self.exclude_speaker_ids)
        if self.exclude_audio_ids:
            rows = exclude_ids(df if compat else rows, "speaker_id" if compat else "audio_id", self.exclude_audio_ids)
        if self.by_utterance_duration is not None:
            rows = rows.filter(within(DURATION, self.by_utterance_duration))
        if self.by_snr is not None:
            rows = rows.filter(within("snr", self.by_snr))
        if self.by_speaker is not None:
            rows = speaker_budget(rows, order_by, **self.by_speaker)
        if self.by_duration is None:
            return rows
        if self.with_randomness:
            rows = sample_rows(rows, self.with_fraction, order_by, seed)
            return cap_total(rows, self.by_duration, ["_shuffle", *order_by]).drop("_shuffle")
        return cap_total(rows, self.by_duration, order_by)


def candidates(
    utterances: DataFrame, staging: DataFrame, source: str, language: str, status: str = "Clean", data_set: str = "train"
) -> DataFrame:
    """Unstaged utterances of usable length from recordings that are free for ``data_set``."""
    recordings = staging.filter(
        (F.col("source") == source)
        & (F.col("language") == language)
        & (F.col("data_set_used_for").isNull() | (F.col("data_set_used_for") == data_set))
    ).select("audio_id")
    usable = utterances.filter(
        (F.col("status") == status) & ~F.col("staged_for_transcription") & F.col(DURATION).between(0.5, 15)
    )
    return usable.join(recordings, "audio_id", "left_semi").select("speaker_id", FILE_NAME, DURATION, "audio_id", "snr")
