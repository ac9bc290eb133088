"""Declared schemas (DDL) of the catalogue tables and files.  Nothing is inferred from data."""

from __future__ import annotations

from pyspark.sql.types import StructType

UTTERANCE_DDL = (
    "name string, duration string, snr_value string, status string, reason string, snr_threshold double, "
    "max_duration double, language_confidence_score map<string,string>"
)

# Column order of a recording metadata file, which is bound by position.
METADATA_COLUMNS = (
    "raw_file_name duration title speaker_name audio_id cleaned_duration num_of_speakers language "
    "has_other_audio_signature type source experiment_use utterances_files_list source_url speaker_gender "
    "source_website experiment_name mother_tongue age_group recorded_state recorded_district recorded_place "
    "recorded_date purpose license media_hash_code"
).split()

_METADATA_TYPES = {
    "duration": "double",
    "audio_id": "bigint",
    "cleaned_duration": "double",
    "num_of_speakers": "int",
    "has_other_audio_signature": "boolean",
    "experiment_use": "boolean",
}


def metadata_schema(with_license: bool = True) -> StructType:
    columns = [c for c in METADATA_COLUMNS if with_license or c != "license"]
    return StructType.fromDDL(", ".join(f"{c} {_METADATA_TYPES.get(c, 'string')}" for c in columns))


STAGING = (
    ", ".join(f"{c} {_METADATA_TYPES.get(c, 'string')}" for c in METADATA_COLUMNS)
    + ", load_datetime timestamp_ntz, is_normalized boolean, data_set_used_for string"
)
MEDIA = (
    "audio_id bigint, raw_file_name string, total_duration double, title string, cleaned_duration double, "
    "num_of_speakers string, language string, has_other_audio_signature boolean, type string, source string, "
    "source_url string, source_website string, utterances_files_list string, recorded_state string, "
    "recorded_district string, recorded_place string, recorded_date string, purpose string, "
    "load_datetime timestamp_ntz"
)
MAPPING = (
    "audio_id bigint, speaker_id int, clipped_utterance_file_name string, clipped_utterance_duration double, "
    "experiment_id int, load_datetime timestamp_ntz, experiment_use_status boolean, snr double, status string, "
    "fail_reason string, language_confidence_score map<string,string>, staged_for_transcription boolean, "
    "was_noise boolean, speaker_gender string, data_type string, is_transcribed boolean, "
    "stt_api_used array<string>, labelled_artifact_name string, unlabelled_artifact_name string"
)
SPEAKER = (
    "speaker_id int, source string, gender string, mother_tongue string, age_group string, "
    "voice_signature string, load_datetime timestamp_ntz, speaker_name string"
)
SOURCE_SUMMARY = "source string, num_speaker int, total_duration double, num_of_audio int"
MANIFEST = "path string, label int"
EMBEDDING = "path string, embedding array<float>"
