"""Quality gate of clips and the per-recording clean duration."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sonoloom.operators.ordered import micros

DEFAULT_THRESHOLD = 15.0
MAX_SECONDS = 15.0


def gate_status(snr: Column, duration: Column, threshold: float = DEFAULT_THRESHOLD) -> Column:
    return F.when(snr < threshold, "Rejected").when(duration > MAX_SECONDS, "Rejected").otherwise("Clean")


def gate_reason(snr: Column, duration: Column, threshold: float = DEFAULT_THRESHOLD) -> Column:
    """Why a clip was rejected; the quality test comes first."""
    return F.when(snr < threshold, "High-SNR").when(duration > MAX_SECONDS, "High Audio Duration")


def quality_gate(
    clips: DataFrame,
    threshold: float = DEFAULT_THRESHOLD,
    snr: str = "snr",
    duration: str = "clipped_utterance_duration",
) -> DataFrame:
    """Add ``status``, ``reason`` and the bound that was exceeded; NaN quality counts as 0."""
    value = F.nanvl(F.col(snr).cast("double"), F.lit(0.0))
    reason = gate_reason(F.col(snr), F.col(duration), threshold)
    return clips.withColumn(snr, value).select(
        *[c for c in clips.columns if c not in ("status", "reason")],
        gate_status(F.col(snr), F.col(duration), threshold).alias("status"),
        reason.alias("reason"),
        F.when(reason == "High-SNR", F.lit(threshold)).alias("snr_threshold"),
        F.when(reason == "High Audio Duration", F.lit(MAX_SECONDS)).alias("max_duration"),
    )


def cleaned_minutes(clips: DataFrame, duration: str = "clipped_utterance_duration") -> DataFrame:
    """(audio_id, cleaned_duration): minutes of clean clips, two decimals (halves to even), 0 when none."""
    clean = F.sum(F.when(F.col("status") == "Clean", micros(duration)))
    minutes = F.coalesce(clean, F.lit(0)) / F.lit(60_000_000.0)
    return clips.groupBy("audio_id").agg((F.rint(minutes * 100) / 100).alias("cleaned_duration"))


def clip_duration(samples: Column, rate: Column) -> Column:
    return samples / rate


def content_hash(content: Column) -> Column:
    return F.md5(content)
