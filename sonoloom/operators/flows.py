"""The steps of the system as whole flows: tables in, new tables out.

Each flow only composes operators; writing the results is left to the caller
(``sources.sinks.write_version`` keeps snapshots).
"""

from __future__ import annotations

from collections.abc import Callable, Collection, Sequence
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sonoloom.functions.text import artifact_name, base_name
from sonoloom.functions.utterance_json import utterances_as_json
from sonoloom.operators import catalog, dedup, mutations, planning, publishing, quality, selection, transcription
from sonoloom.operators.clusters import ClusterSettings, speaker_clusters
from sonoloom.operators.ordered import row_index
from sonoloom.operators.selection import DURATION, FILE_NAME
from sonoloom.session import checkpointed, load_moment


@dataclass(frozen=True)
class Catalogue:
    """The four catalogue tables."""

    staging: DataFrame
    media: DataFrame
    speakers: DataFrame
    mapping: DataFrame


def ingest(
    recordings: DataFrame, clips: DataFrame, staging: DataFrame, order_by: Sequence[str], threshold: float = 15.0
) -> tuple[DataFrame, DataFrame]:
    """(new staging rows, gated clips) of a batch of recordings and their cut clips.

    Recordings known by name or hash are rejected, then those that repeat an accepted one of
    the batch; the rest get audio ids, clean minutes and the JSON of their clips.  ``clips`` is
    (raw_file_name, file name, duration, snr).
    """
    unknown = checkpointed(row_index(dedup.unknown_by_name_or_hash(recordings, staging), order_by, output="_row"))
    accepted = dedup.reject_in_order(unknown, "_row", ["_row"])
    numbered = checkpointed(
        catalog.assign_ids(accepted, staging, "audio_id", ["_row"], catalog.FIRST_AUDIO_ID).drop("_row")
    )
    gated = quality.quality_gate(clips.join(numbered.select("raw_file_name", "audio_id"), "raw_file_name"), threshold)
    fields = {
        "name": FILE_NAME,
        "duration": F.col(DURATION).cast("string"),
        "snr_value": "snr",
        "status": "status",
        "reason": "reason",
        "snr_threshold": "snr_threshold",
        "max_duration": "max_duration",
    }
    lists = utterances_as_json(gated, ["audio_id"], fields, [FILE_NAME]).drop("part")
    rows = numbered.join(quality.cleaned_minutes(gated), "audio_id", "left").join(lists, "audio_id", "left")
    stamped = rows.withColumn("load_datetime", load_moment(rows.sparkSession)).withColumn("is_normalized", F.lit(False))
    return stamped, gated


def normalise(tables: Catalogue, *, compat: bool = False) -> Catalogue:
    """Copy new staging rows to media, speakers and the utterance mapping, and flag them.

    Running it again adds nothing.
    """
    unknown = catalog.insert_absent(tables.mapping, catalog.mapping_unknown_speaker(tables.staging))
    mapping = tables.mapping.unionByName(catalog.complete_mapping(unknown, compat=compat))
    added = catalog.media_rows(catalog.media_increment(tables.staging, tables.media, compat=compat))
    media = checkpointed(tables.media.unionByName(added))
    speakers = checkpointed(mutations.add_speakers(tables.speakers, tables.staging))
    known = catalog.mapping_known_speaker(tables.staging, media, speakers)
    mapping = mapping.unionByName(catalog.complete_mapping(catalog.insert_absent(tables.mapping, known), compat=compat))
    done = catalog.normalised_ids(tables.staging, False).union(catalog.normalised_ids(tables.staging, True))
    return Catalogue(mutations.mark_normalised(tables.staging, done), media, speakers, mapping)


@dataclass(frozen=True)
class Marked:
    selected: DataFrame
    manifest: DataFrame
    tables: Catalogue


def mark(
    tables: Catalogue,
    spec: selection.FilterSpec,
    source: str,
    language: str,
    data_set: str,
    *,
    source_base: str,
    landing_base: str,
    landing_source: str | None = None,
    chosen: DataFrame | None = None,
    order_by: Sequence[str] = ("audio_id", FILE_NAME),
    seed: int = 0,
    compat: bool = False,
) -> Marked:
    """Select utterances (or take ``chosen`` from a file), plan their move, mark them staged."""
    language = language.title()
    if chosen is None:
        rows = selection.candidates(tables.mapping, tables.staging, source, language, "Clean", data_set)
        chosen = spec.apply(rows, list(order_by), seed=seed, compat=compat)
    chosen = checkpointed(chosen)
    paths = chosen.select(planning.clip_path(f"{source_base}/{source}", F.col("audio_id"), F.col(FILE_NAME)).alias("path"))
    manifest = planning.move_manifest(paths, f"{landing_base}/{landing_source or source}/{data_set}")
    mapping = mutations.stage_utterances(tables.mapping, tables.staging, chosen, source, language, data_set)
    staging = mutations.tag_recordings(tables.staging, chosen, source, language, data_set)
    return Marked(chosen, manifest, replace(tables, mapping=mapping, staging=staging))


def transcribe_source(
    tables: Catalogue,
    engine_call: Callable[[str], str],
    *,
    source: str,
    language: str,
    engine: str,
    data_set: str,
    base: str,
    sanitiser: str | None = None,
    skip_rejected: bool = True,
    raw_engines: Collection[str] = transcription.RAW_ENGINES,
) -> tuple[DataFrame, Catalogue]:
    """(transcripts, tables): transcribe what the engine has not seen and record the outcomes.

    The outcomes are checkpointed, so that no engine is called twice for one clip.
    """
    mine = catalog.of_source(catalog.stt_eligible(tables.mapping, engine, data_set), tables.staging, source, language.title())
    clips = transcription.transcription_gate(mine, mine, skip_rejected)
    folder = planning.stt_paths(clips.select("audio_id").distinct(), base, base, source, engine, data_set)
    located = clips.join(folder, "audio_id").withColumn("path", F.concat_ws("/", "input_path", FILE_NAME))
    called = transcription.transcribe(located.select("audio_id", FILE_NAME, "path"), engine_call)
    done = checkpointed(transcription.outcome(called, sanitiser or language.lower(), engine, raw_engines))
    return done, replace(tables, mapping=mutations.transcription_outcome(tables.mapping, done))


def analyse_speakers(
    tables: Catalogue, embeddings: DataFrame, source: str, settings: ClusterSettings | None = None, genders: DataFrame | None = None
) -> tuple[DataFrame, Catalogue]:
    """(members, tables): cluster (path, embedding) rows and write speakers and genders back.

    ``genders`` is (path, gender).
    """
    ids = catalog.assign_ids(embeddings, None, "vec_id", ["path"], 0)
    ids = checkpointed(ids)
    found = checkpointed(speaker_clusters(ids, source, settings))
    members = found.join(ids.select("vec_id", "path"), "vec_id").withColumn(FILE_NAME, base_name(F.col("path")))
    named = members.filter(F.col("cluster").isNotNull()).select("speaker_name", FILE_NAME, (F.col("was_noise") == 1).alias("was_noise"))
    speakers = checkpointed(mutations.upsert_speakers(tables.speakers, named, source))
    mapping = mutations.assign_speakers(tables.mapping, speakers, named)
    if genders is not None:
        mapping = mutations.assign_gender(mapping, genders.select(base_name(F.col("path")).alias(FILE_NAME), "gender"))
    return members, replace(tables, speakers=speakers, mapping=mapping)


def publish(
    tables: Catalogue,
    *,
    source: str,
    language: str,
    stored: DataFrame,
    moment: str,
    transcripts: DataFrame | None = None,
    is_transcribed: bool = True,
    include_rejected: bool = False,
    count: int | None = None,
) -> tuple[DataFrame, str, Catalogue]:
    """(records, artifact name, tables): export rows whose file is ``stored`` (name), and note it.

    With ``transcripts`` the corpus is labelled.
    """
    labelled = transcripts is not None
    rows = catalog.export_rows(
        tables.mapping,
        tables.staging,
        tables.speakers,
        source,
        language,
        count=count,
        is_transcribed=is_transcribed,
        is_labelled=labelled,
        include_rejected=include_rejected,
    )
    records = checkpointed(publishing.corpus_records(publishing.fetched_only(rows, stored), source, transcripts))
    planning.require_rows(records, "no data to publish")
    spark = records.sparkSession
    artifact = spark.range(1).select(artifact_name(F.lit(language), F.lit(source), F.lit(moment))).first()[0]
    held = records.select(F.col("audioId").alias("audio_id"), F.col("audioFilename").alias(FILE_NAME))
    return records, artifact, replace(tables, mapping=mutations.record_artifact(tables.mapping, held, artifact, labelled))
