"""Validation report: stored files against the catalogue, duplicates, invalid lengths, cleaned set."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sonoloom.functions.text import base_name
from sonoloom.functions.utterance_json import explode_utterances
from sonoloom.operators.dedup import duplicate_groups, first_per_key
from sonoloom.operators.ordered import micros
from sonoloom.session import checkpointed

KEYS = ["audio_id", "utterances_file_name"]
SHORTEST, LONGEST = 0.5, 15.0


def path_attributes(listing: DataFrame, base: str, path: str = "path") -> DataFrame:
    """Storage paths as (bucket_file_path, source, audio_id, raw_file_name, utterances_file_name, status).

    Commas are removed first; a train/test level is skipped; paths without ``wav`` and paths
    that do not parse are left out.
    """
    # Path and parts go through generators: filters and join keys on the columns would else build and split the path again, each of them.
    paths = listing.select(F.explode(F.array(path)).alias("_path")).filter(F.col("_path").contains("wav"))
    cleaned = paths.select(F.explode(F.array(F.replace("_path", F.lit(","), F.lit("")))).alias("bucket_file_path"))
    rest = F.split(F.substring_index("bucket_file_path", base.rstrip("/") + "/", -1), "/")
    split = cleaned.select("bucket_file_path", F.explode(F.array(rest)).alias("_rest")).withColumn(
        "_at", F.when(F.lower(F.get("_rest", F.lit(1))).isin("train", "test"), 2).otherwise(1)
    )
    name = F.element_at("_rest", -1)
    raw_name = F.substring_index(F.substring(name, F.instr(name, "_") + 1, F.length(name)), ".", 1)
    return split.select(
        "bucket_file_path",
        F.get("_rest", 0).alias("source"),
        F.get("_rest", F.col("_at")).try_cast("bigint").alias("audio_id"),
        F.when(name.contains("_"), raw_name).otherwise("NA").alias("raw_file_name"),
        name.alias("utterances_file_name"),
        F.get("_rest", F.col("_at") + 1).alias("status"),
    ).filter(F.col("audio_id").isNotNull() & F.col("status").isNotNull())


def listing_row(listing: DataFrame) -> Column:
    """Attribute columns of one stored file as a comma-joined text."""
    return F.concat_ws(
        ",", "bucket_file_path", "source", F.col("audio_id").cast("string"), "raw_file_name", "utterances_file_name", "status"
    )


def cleanse(catalogue: DataFrame, name: str) -> DataFrame:
    """Drop rows without an audio id, strip commas from the name, ids as integers."""
    return (
        catalogue.filter(F.col("audio_id").isNotNull())
        .withColumn(name, F.replace(name, F.lit(","), F.lit("")))
        .withColumn("audio_id", F.col("audio_id").cast("bigint"))
    )


def check_inputs(catalogue: DataFrame, listing: DataFrame) -> None:
    no_catalogue, no_listing = catalogue.isEmpty(), listing.isEmpty()
    if no_catalogue and no_listing:
        raise ValueError("catalogue and storage listing are both empty")
    if no_catalogue:
        raise ValueError("catalogue is empty")
    if no_listing:
        raise ValueError("storage listing is empty")


def _suffixed(listing: DataFrame, exploded: DataFrame) -> DataFrame:
    """Columns of the listing that the catalogue has too get the suffix ``_x``."""
    shared = [c for c in listing.columns if c in exploded.columns and c not in KEYS]
    return listing.select(*[F.col(c).alias(f"{c}_x") if c in shared else F.col(c) for c in listing.columns])


def _with_nulls(rows: DataFrame, other: DataFrame) -> DataFrame:
    """``rows`` and, as NULLs, the columns that a match in ``other`` would have filled."""
    missing = [F.lit(None).cast(f.dataType).alias(f.name) for f in other.schema.fields if f.name not in rows.columns]
    return rows.select("*", *missing)


def stored_not_catalogued(listing: DataFrame, exploded: DataFrame) -> DataFrame:
    """Stored files without an utterance; the catalogue's columns are NULL."""
    alone = _suffixed(listing, exploded).join(exploded.select(*KEYS), KEYS, "left_anti")
    return _with_nulls(alone, exploded)


def catalogued_not_stored(exploded: DataFrame, listing: DataFrame) -> DataFrame:
    """Utterances without a stored file; a recording with an empty list counts too.  The listing's columns are NULL."""
    alone = exploded.join(listing.select(*KEYS), KEYS, "left_anti")
    return _with_nulls(alone, _suffixed(listing, exploded))


def stored_and_catalogued(listing: DataFrame, exploded: DataFrame) -> DataFrame:
    """Inner join; columns of the listing that the catalogue has too get the suffix ``_x``."""
    return _suffixed(listing, exploded).join(exploded, KEYS)


def valid_duration(duration: str = "utterances_file_duration") -> Column:
    return F.coalesce(F.col(duration).between(SHORTEST, LONGEST), F.lit(False))


def not_rejected(status: str) -> Column:
    """Not rejected in any spelling; an unknown status counts as not rejected."""
    return ~F.lower(F.col(status)).eqNullSafe(F.lit("rejected"))


def in_report_order(rows: DataFrame) -> DataFrame:
    """Sorted by raw name; the keys behind it let Spark split a name with many rows."""
    return rows.orderBy("raw_file_name", *[k for k in KEYS if k in rows.columns])


def invalid_durations(matched: DataFrame) -> DataFrame:
    return in_report_order(matched.filter(~valid_duration()))


def clean_listing(listing: DataFrame) -> DataFrame:
    return listing.filter(F.col("status") == "clean")


def valid_utterances(matched: DataFrame, listing_status: str = "status") -> DataFrame:
    return matched.filter(valid_duration() & not_rejected(listing_status) & not_rejected("utterances_file_status"))


def valid_per_audio(matched: DataFrame, listing_status: str = "status") -> DataFrame:
    """Per audio the minutes of its valid utterances and the list of their JSON, by name."""
    listed = F.sort_array(F.collect_list(F.struct("utterances_file_name", "utterance_json")))
    return (
        valid_utterances(matched, listing_status)
        .groupBy("audio_id")
        .agg((F.sum(micros("utterances_file_duration")) / F.lit(60_000_000.0)).alias("cleaned_duration"), listed.alias("_valid"))
        .select("audio_id", F.transform("_valid", lambda u: u["utterance_json"]).alias("utterances_files_list"), "cleaned_duration")
    )


def duplicate_names(catalogue: DataFrame) -> DataFrame:
    return in_report_order(duplicate_groups(catalogue, "raw_file_name"))


def unique_names(catalogue: DataFrame, order_by: Sequence[str]) -> DataFrame:
    return first_per_key(catalogue, ["raw_file_name"], order_by)


def valid_and_unique(valid: DataFrame, unique: DataFrame) -> DataFrame:
    """Catalogue columns of unique recordings, with the clean minutes and the list of their valid utterances."""
    kept = [c for c in unique.columns if c not in ("cleaned_duration", "utterances_files_list")]
    return valid.select("audio_id", "cleaned_duration", "utterances_files_list").join(unique.select(*kept), "audio_id")


def companion_text(path: Column) -> Column:
    """``wav`` replaced by ``txt`` wherever it occurs."""
    return F.replace(path, F.lit("wav"), F.lit("txt"))


def cleaned_dataset(
    matched: DataFrame, unique: DataFrame, stage: str, bucket: str, listing_status: str = "status"
) -> DataFrame:
    """Valid utterances of unique recordings with bucket paths; transcripts in a ``post`` stage."""
    valid = valid_utterances(matched, listing_status).select(
        "audio_id", "bucket_file_path", "utterances_file_duration"
    )
    rows = valid.join(unique.select("audio_id").distinct(), "audio_id", "left_semi")
    prefix = F.lit(f"gs://{bucket}/")
    columns = ["audio_id", F.concat(prefix, "bucket_file_path").alias("wav_path_bucket")]
    if "post" in stage:
        columns.insert(1, F.concat(prefix, companion_text(F.col("bucket_file_path"))).alias("transcriptions_path_bucket"))
    return rows.select(*columns, F.col("utterances_file_duration").alias("duration"))


def with_mapping(cleaned: DataFrame, mapping: DataFrame) -> DataFrame:
    """Add the mapping columns by (audio_id, file name)."""
    facts = mapping.select(
        "audio_id",
        F.col("clipped_utterance_file_name").alias("utterance_file_name"),
        *[
            c
            for c in (
                "speaker_id",
                "speaker_gender",
                "snr",
                "status",
                "staged_for_transcription",
                "language_confidence_score",
                "was_noise",
            )
            if c in mapping.columns
        ],
    )
    named = cleaned.drop("speaker_gender").withColumn("utterance_file_name", base_name(F.col("wav_path_bucket")))
    return named.join(facts, ["audio_id", "utterance_file_name"])


def validation_report(
    catalogue: DataFrame,
    listing: DataFrame,
    mapping: DataFrame,
    *,
    base: str,
    bucket: str,
    stage: str = "pre",
    order_by: Sequence[str] = ("audio_id",),
) -> dict[str, DataFrame]:
    """All report tables by name.  ``listing`` is (path, length).

    The parsed listing and the exploded catalogue feed every table and are written once.
    """
    recordings = cleanse(catalogue, "raw_file_name")
    stored = checkpointed(path_attributes(listing, base))
    check_inputs(recordings, stored)
    exploded = checkpointed(explode_utterances(recordings))
    matched = stored_and_catalogued(stored, exploded)
    clean = stored_and_catalogued(clean_listing(stored), exploded)
    status = "status_x" if "status_x" in matched.columns else "status"
    unique = unique_names(recordings, order_by)
    cleaned = cleaned_dataset(clean, unique, stage, bucket, status)
    return {
        "bucket_not_in_catalog": stored_not_catalogued(stored, exploded),
        "catalog_not_in_bucket": catalogued_not_stored(exploded, stored),
        "bucket_in_catalog": matched,
        "duplicates": duplicate_names(recordings),
        "invalid_duration": invalid_durations(clean),
        "valid_and_unique": valid_and_unique(valid_per_audio(clean, status), unique),
        "final": with_mapping(cleaned, mapping),
    }
