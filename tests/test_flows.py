"""The steps one after the other on a small corpus."""

import numpy as np
import pytest
from conftest import rows_of
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from sonoloom.operators import flows
from sonoloom.operators.clusters import ClusterSettings
from sonoloom.operators.selection import FilterSpec
from sonoloom.schemas import MAPPING, MEDIA, SPEAKER, STAGING

NAME = "clipped_utterance_file_name"


@pytest.fixture(scope="module")
def corpus(spark):
    names = [("a.mp4", "h1", 1, "ann"), ("a.mp4", "h9", 2, "bob"), ("b.mp4", "h1", 3, "bob"), ("c.mp4", "h3", 4, None), ("d.mp4", "h4", 5, "bob")]
    recordings = spark.createDataFrame(names, "raw_file_name string, media_hash_code string, pos int, speaker_name string")
    clips = spark.createDataFrame(
        [(f"{r}.mp4", f"{i}_{r}.wav", float(2 + i), 20.0 + i if i else 3.0) for r in "acd" for i in range(6)],
        f"raw_file_name string, {NAME} string, clipped_utterance_duration double, snr double",
    )
    empty = {n: spark.createDataFrame([], StructType.fromDDL(d)) for n, d in (("staging", STAGING), ("media", MEDIA), ("speakers", SPEAKER), ("mapping", MAPPING))}
    rows, gated = flows.ingest(recordings, clips, empty["staging"], ["pos"])
    types = {f.name: f.dataType for f in StructType.fromDDL(STAGING).fields}
    fixed = {"source": "src", "language": "Hindi", "source_url": "u", "source_website": "w"}
    staging = rows.select(
        *[(F.col(n) if n in rows.columns else F.lit(fixed.get(n))).cast(t).alias(n) for n, t in types.items()]
    )
    return staging, gated, empty


def test_whole_chain(spark, corpus):
    staging, gated, empty = corpus
    assert rows_of(staging, "audio_id", "raw_file_name", "cleaned_duration") == [(101, "a.mp4", 0.42), (102, "c.mp4", 0.42), (103, "d.mp4", 0.42)]
    assert gated.filter("status = 'Rejected'").count() == 3

    tables = flows.normalise(flows.Catalogue(staging, empty["media"], empty["speakers"], empty["mapping"]))
    assert rows_of(tables.speakers, "speaker_id", "speaker_name") == [(1, "ann"), (2, "bob")]
    assert tables.mapping.count() == 18 and tables.media.count() == 2
    assert rows_of(tables.staging.filter("is_normalized"), "audio_id") == [(101,), (102,), (103,)]
    assert rows_of(tables.mapping.filter("audio_id = 103").select("speaker_id").distinct()) == [(2,)]
    again = flows.normalise(tables)
    assert again.mapping.count() == 18 and again.media.count() == 2 and again.speakers.count() == 2

    spec = FilterSpec.from_dict({"by_utterance_duration": {"gte": 1, "lte": 6}, "by_duration": 20 / 3600})
    marked = flows.mark(tables, spec, "src", "hindi", "train", source_base="in", landing_base="land")
    assert rows_of(marked.selected, "audio_id", NAME) == [(101, "1_a.wav"), (101, "2_a.wav"), (101, "3_a.wav"), (101, "4_a.wav")]
    assert ("in/src/101/clean/1_a.wav", "land/src/train/101/clean/1_a.wav") in rows_of(marked.manifest)
    assert rows_of(marked.tables.mapping.filter("staged_for_transcription"), NAME, "data_type")[0] == ("1_a.wav", "train")
    assert rows_of(marked.tables.staging.filter("data_set_used_for = 'train'"), "audio_id") == [(101,)]

    def engine(path):
        assert path.startswith("stt/src/train/101/clean/")
        return {"1": "नमस्ते", "2": "8:00 से", "3": "अलग-अलग", "4": "x"}[path.rsplit("/", 1)[1][0]]

    done, tables = flows.transcribe_source(marked.tables, engine, source="src", language="hindi", engine="azure", data_set="train", base="stt")
    assert rows_of(done.filter("is_transcribed"), NAME, "transcript") == [("1_a.wav", "नमस्ते"), ("3_a.wav", "अलग अलग")]
    state = {r[NAME]: r for r in tables.mapping.filter("staged_for_transcription").collect()}
    assert state["2_a.wav"].status == "Rejected" and state["2_a.wav"].fail_reason == "sanitization error:transcription has :"
    assert state["1_a.wav"].stt_api_used == ["azure"] and state["1_a.wav"].is_transcribed
    nothing, _ = flows.transcribe_source(tables, engine, source="src", language="hindi", engine="azure", data_set="train", base="stt")
    assert nothing.count() == 0

    texts = done.filter("is_transcribed").select(F.substring_index(NAME, ".", 1).alias("stem"), F.col("transcript").alias("text"))
    stored = spark.createDataFrame([("1_a.wav",), ("3_a.wav",), ("4_a.wav",)], "name string")
    records, artifact, tables = flows.publish(tables, source="src", language="Hindi", stored=stored, moment="01-02-2021_03-04", transcripts=texts)
    assert artifact == "Hindi_src_01-02-2021_03-04.zip"
    assert rows_of(records, "audioFilename", "speaker", "text") == [("1_a.wav", "ann", "नमस्ते"), ("3_a.wav", "ann", "अलग अलग")]
    assert rows_of(tables.mapping.filter("labelled_artifact_name is not null"), NAME) == [("1_a.wav",), ("3_a.wav",)]
    with pytest.raises(ValueError, match="no data"):
        flows.publish(tables, source="src", language="Hindi", stored=stored, moment="x", transcripts=texts)


def test_speakers_are_written_back(spark, corpus):
    staging, _, empty = corpus
    tables = flows.normalise(flows.Catalogue(staging, empty["media"], empty["speakers"], empty["mapping"]))
    rng = np.random.default_rng(0)
    centres = {"a": rng.normal(size=8), "c": rng.normal(size=8), "d": rng.normal(size=8)}
    paths = [(f"store/{r}/{i}_{r}.wav", [float(x) for x in centres[r] + 0.01 * rng.normal(size=8)]) for r in "acd" for i in range(6)]
    embeddings = spark.createDataFrame(paths, "path string, embedding array<float>")
    genders = spark.createDataFrame([(p, "m" if "/a/" in p else "?") for p, _ in paths], "path string, gender string")
    members, after = flows.analyse_speakers(tables, embeddings, "src", ClusterSettings(min_cluster_size=3), genders)
    assert members.select("speaker_name").distinct().count() == 3
    owner = dict(rows_of(after.speakers.filter("speaker_name like 'src_sp_%'"), "speaker_name", "speaker_id"))
    assert len(owner) == 3 and min(owner.values()) == 3
    per_file = {r[NAME]: (r.speaker_id, r.speaker_gender, r.was_noise) for r in after.mapping.collect()}
    assert len({v[0] for k, v in per_file.items() if k.endswith("_a.wav")}) == 1
    assert per_file["0_a.wav"][1:] == ("m", False) and per_file["0_c.wav"][1] == "f"
