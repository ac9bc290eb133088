"""Catalogue reads: scans, eligibility, lookups, increments, surrogate keys, export rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from sonoloom.functions.utterance_json import explode_utterances, list_state, utterances_as_json
from sonoloom.operators.dedup import latest_with_ties
from sonoloom.operators.ordered import first_rows, row_index
from sonoloom.operators.selection import DURATION, FILE_NAME
from sonoloom.operators.skew import join_lookup
from sonoloom.schemas import MAPPING, MEDIA

FIRST_AUDIO_ID = 101
FIRST_SPEAKER_ID = 1


def scan_source(catalogue: DataFrame, source: str = "") -> DataFrame:
    """Rows of one source; an empty name means all of them."""
    return catalogue.filter(F.col("source") == source) if source else catalogue


def scan_ids(mapping: DataFrame, ids: DataFrame, key: str = "audio_id") -> DataFrame:
    return mapping.join(ids.select(key).distinct(), key, "left_semi")


def of_source(utterances: DataFrame, staging: DataFrame, source: str, language: str) -> DataFrame:
    """Utterances of the recordings of one source and language."""
    recordings = staging.filter((F.col("source") == source) & (F.col("language") == language))
    return utterances.join(recordings.select("audio_id"), "audio_id", "left_semi")


def snapshot(utterances: DataFrame, staging: DataFrame, source: str, language: str) -> DataFrame:
    """Speaker, length, quality and gender of the clean, staged utterances of a source."""
    staged = utterances.filter((F.col("status") == "Clean") & F.col("staged_for_transcription"))
    return of_source(staged, staging, source, language).select("speaker_id", DURATION, "snr", "speaker_gender")


def engine_unused(engine: str, used: str = "stt_api_used") -> Column:
    return ~F.array_contains(used, engine)


def stt_eligible(utterances: DataFrame, engine: str, data_set: str) -> DataFrame:
    """Staged utterances the engine has not seen, of the data set ('' = not assigned)."""
    return utterances.filter(
        F.col("staged_for_transcription") & engine_unused(engine) & (F.coalesce("data_type", F.lit("")) == data_set)
    )


def stt_counts(
    utterances: DataFrame, staging: DataFrame, source: str, language: str, engine: str, data_set: str
) -> DataFrame:
    """(audio_id, utterance_count) of the eligible utterances."""
    eligible = of_source(stt_eligible(utterances, engine, data_set), staging, source, language)
    return eligible.groupBy("audio_id").agg(F.count(F.lit(1)).alias("utterance_count"))


def eligible_json(utterances: DataFrame, ids: DataFrame, engine: str, data_set: str, **sizes: int) -> DataFrame:
    """Per asked audio id its eligible utterances as JSON, ``[]`` when there are none."""
    fields = {"name": FILE_NAME, "duration": DURATION, "snr_value": "snr", "status": "status"}
    lists = utterances_as_json(
        scan_ids(stt_eligible(utterances, engine, data_set), ids), ["audio_id"], fields, [FILE_NAME], **sizes
    )
    joined = ids.select("audio_id").distinct().join(lists, "audio_id", "left")
    return joined.select(
        "audio_id",
        F.coalesce("part", F.lit(0)).alias("part"),
        F.coalesce("utterances_files_list", F.lit("[]")).alias("utterances_files_list"),
    )


def find_by_name(utterances: DataFrame, names: DataFrame, order_by: Sequence[str]) -> DataFrame:
    """For every asked name the first utterance with it, columns NULL when there is none."""
    order = F.struct(*[F.col(o) for o in order_by])
    found = (
        utterances.join(names.select(FILE_NAME).distinct(), FILE_NAME, "left_semi")
        .groupBy(FILE_NAME)
        .agg(F.min_by(F.struct(*[c for c in utterances.columns if c != FILE_NAME]), order).alias("_u"))
    )
    return names.select(FILE_NAME).distinct().join(found, FILE_NAME, "left").select(FILE_NAME, "_u.*")


def load_high_water(media: DataFrame) -> DataFrame:
    """One row: the latest load time of the media table."""
    return media.agg(F.max("load_datetime").alias("high_water"))


def media_increment(staging: DataFrame, media: DataFrame, *, compat: bool = False) -> DataFrame:
    """Staging rows to copy: the latest load of each recording (ties kept), with a speaker,
    above the high-water mark.

    The latest load is found over all staging rows before the other tests.  An empty media
    table takes everything; with ``compat`` it takes nothing, as a NULL mark matches no row.
    """
    mark = load_high_water(media).select(F.col("high_water").cast("string")).first()[0]
    if mark is None:
        above = F.lit(not compat)
    else:
        above = F.col("load_datetime") > F.lit(mark).cast(media.schema["load_datetime"].dataType)
    return latest_with_ties(staging, "audio_id", "load_datetime").filter(above & F.col("speaker_name").isNotNull())


def media_rows(staging_rows: DataFrame) -> DataFrame:
    """Staging rows in the shape of the media table."""
    return staging_rows.withColumn("total_duration", F.col("duration")).select(
        *[F.col(f.name).cast(f.dataType).alias(f.name) for f in StructType.fromDDL(MEDIA).fields]
    )


def new_speakers(staging: DataFrame, speakers: DataFrame) -> DataFrame:
    """One row per (name, source) whose name is in no speaker row of any source."""
    grouped = (
        staging.filter(F.col("speaker_name").isNotNull())
        .groupBy("speaker_name", "source")
        .agg(
            F.min("speaker_gender").alias("gender"),
            F.min("mother_tongue").alias("mother_tongue"),
            F.min("age_group").alias("age_group"),
            F.min("load_datetime").alias("load_datetime"),
        )
    )
    return grouped.join(speakers.select("speaker_name").distinct(), "speaker_name", "left_anti")


def assign_ids(
    rows: DataFrame, existing: DataFrame | None, column: str, order_by: Sequence[str], first: int = FIRST_SPEAKER_ID, **sizes: int
) -> DataFrame:
    """Add surrogate ids after the greatest existing one, in natural-key order."""
    start = first
    if existing is not None:
        greatest = existing.agg(F.max(column).alias("m")).first()["m"]
        start = first if greatest is None else greatest + 1
    return row_index(rows, order_by, output=column, **sizes).withColumn(column, F.col(column) + F.lit(start))


def speaker_lookup(staging: DataFrame, speakers: DataFrame) -> DataFrame:
    """(audio_id, speaker_id): the least speaker id that carries the recording's speaker name."""
    by_name = speakers.groupBy("speaker_name").agg(F.min("speaker_id").alias("speaker_id"))
    named = staging.filter(F.col("speaker_name").isNotNull()).select("audio_id", "speaker_name").distinct()
    joined = join_lookup(named, by_name, "speaker_name", spread_by=F.col("audio_id"))
    return joined.groupBy("audio_id").agg(F.min("speaker_id").alias("speaker_id"))


def _mapping_rows(recordings: DataFrame, speaker: Column) -> DataFrame:
    exploded = explode_utterances(recordings, keep_empty=False)
    return exploded.select(
        "audio_id",
        speaker.cast("int").alias("speaker_id"),
        F.col("utterances_file_name").alias(FILE_NAME),
        F.col("utterances_file_duration").alias(DURATION),
        "load_datetime",
        "snr",
        F.col("utterances_file_status").alias("status"),
        F.coalesce("fail_reason", F.lit("")).alias("fail_reason"),
        "language_confidence_score",
    )


def mapping_known_speaker(staging: DataFrame, media: DataFrame, speakers: DataFrame) -> DataFrame:
    """Mapping rows of unnormalised recordings with a speaker; list and load time from ``media``."""
    pending = staging.filter(~F.col("is_normalized") & F.col("speaker_name").isNotNull()).select("audio_id").distinct()
    recordings = media.join(pending, "audio_id", "left_semi").select("audio_id", "utterances_files_list", "load_datetime")
    return _mapping_rows(recordings.join(speaker_lookup(staging, speakers), "audio_id"), F.col("speaker_id"))


def mapping_unknown_speaker(staging: DataFrame) -> DataFrame:
    """Mapping rows of unnormalised recordings without a speaker; the list from staging."""
    pending = staging.filter(~F.col("is_normalized") & F.col("speaker_name").isNull())
    return _mapping_rows(pending.select("audio_id", "utterances_files_list", "load_datetime"), F.lit(None))


def complete_mapping(rows: DataFrame, *, compat: bool = False) -> DataFrame:
    """Rows with every mapping column: not staged, no engine used, the rest NULL.

    ``compat`` starts with the engine ``google`` marked as used, as the old default did.
    """
    engines = F.array(F.lit("google")) if compat else F.array().cast("array<string>")
    defaults = {"staged_for_transcription": F.lit(False), "stt_api_used": engines}
    return rows.select(
        *[
            (F.col(f.name) if f.name in rows.columns else defaults.get(f.name, F.lit(None))).cast(f.dataType).alias(f.name)
            for f in StructType.fromDDL(MAPPING).fields
        ]
    )


def insert_absent(mapping: DataFrame, rows: DataFrame) -> DataFrame:
    """Rows not yet in the mapping by (audio_id, name), so that a rerun inserts nothing."""
    return rows.join(mapping.select("audio_id", FILE_NAME).distinct(), ["audio_id", FILE_NAME], "left_anti")


def normalised_ids(staging: DataFrame, speaker_known: bool) -> DataFrame:
    """Audio ids to flag as normalised.

    Without a speaker, a recording with a JSON ``null`` list is flagged too, but nothing is
    flagged when no utterance was found at all.
    """
    name = F.col("speaker_name")
    pending = staging.filter(~F.col("is_normalized") & (name.isNotNull() if speaker_known else name.isNull()))
    readable = pending.filter(list_state(F.col("utterances_files_list")).isin("ok", "json_null"))
    if not speaker_known and mapping_unknown_speaker(staging).isEmpty():
        return readable.select("audio_id").limit(0)
    return readable.select("audio_id").distinct()


def export_rows(
    mapping: DataFrame,
    staging: DataFrame,
    speakers: DataFrame,
    source: str,
    language: str,
    *,
    count: int | None = None,
    is_transcribed: bool = True,
    is_labelled: bool = True,
    include_rejected: bool = False,
    order_by: Sequence[str] = ("audio_id", "audio_file_name"),
) -> DataFrame:
    """Staged utterances of a source that no artifact of this kind holds yet; all of them unless ``count`` is given."""
    flag = F.col("is_transcribed")
    wanted = (
        F.col("status").isin(["Clean", "Rejected"] if include_rejected else ["Clean"])
        & F.col("staged_for_transcription")
        & (flag if is_transcribed else (~flag | flag.isNull()))
        & F.col("labelled_artifact_name" if is_labelled else "unlabelled_artifact_name").isNull()
    )
    recordings = staging.filter((F.col("source") == source) & (F.col("language") == language))
    sites = recordings.groupBy("audio_id").agg(F.min(F.struct("source_url", "source_website")).alias("_site"))
    joined = mapping.filter(wanted).join(sites.select("audio_id", "_site.*"), "audio_id")
    known = speakers.select("speaker_id", "speaker_name")
    rows = join_lookup(joined, known, "speaker_id", "left", spread_by=F.col(FILE_NAME)).select(
        F.col(FILE_NAME).alias("audio_file_name"),
        F.col(DURATION).alias("duration"),
        "snr",
        "speaker_name",
        F.col("source_url").alias("collection_source"),
        F.col("source_website").alias("main_source"),
        F.col("speaker_gender").alias("gender"),
        "audio_id",
        "status",
    )
    return rows if count is None else first_rows(rows, count, list(order_by))
