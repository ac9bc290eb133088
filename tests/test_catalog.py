"""Utterance lists, quality, catalogue reads and state changes on small tables."""

import json

import pytest
from conftest import rows_of
from pyspark.sql import functions as F

from sonoloom.functions import utterance_json as uj
from sonoloom.operators import catalog as cat
from sonoloom.operators import mutations as mut
from sonoloom.operators import planning as plan
from sonoloom.operators import publishing as pub
from sonoloom.operators import quality, reconcile, transcription

NAME, SECONDS = "clipped_utterance_file_name", "clipped_utterance_duration"


def lists(spark, *texts):
    return spark.createDataFrame(list(enumerate(texts)), "audio_id bigint, utterances_files_list string")


def test_utterance_lists_are_normalised(spark):
    full = [
        {"name": "a,1.wav", "duration": "3.5", "snr_value": float("nan"), "status": "Clean", "language_confidence_score": {"hi": "0.9"}},
        {"name": "b.wav", "duration": "20", "snr_value": 12.5, "status": "Rejected", "reason": "High Audio Duration", "max_duration": 15},
        {"name": "c.wav", "duration": "nan", "status": "Clean", "language_confidence_score": None},
    ]
    df = lists(
        spark,
        json.dumps(full),
        "[]",
        "null",
        None,
        json.dumps(["old,1.wav:4.0"]),
        "[{'name': 'q.wav', 'duration': '1.0', 'status': 'Clean', 'snr_value': '12'}]",
        '[{"name": ',
        json.dumps([full[1], "mixed.wav:2.0"]),
    )
    got = uj.explode_utterances(df)
    rows = [tuple(r) for r in got.select("audio_id", "utterances_file_name", "utterances_file_duration", "utterances_file_status", "snr").collect()]
    assert sorted(rows, key=repr) == sorted(
        [
            (0, "a1.wav", 3.5, "Clean", 0.0),
            (0, "b.wav", 20.0, "Rejected", 12.5),
            (0, "c.wav", None, "Clean", 0.0),
            (1, None, None, None, 0.0),
            (2, None, None, None, 0.0),
            (3, None, None, None, 0.0),
            (4, "old1.wav", 4.0, "", 0.0),
            (5, "q.wav", 1.0, "Clean", 12.0),
            (6, None, None, None, 0.0),
            (7, "b.wav", 20.0, "Rejected", 12.5),
            (7, "mixed.wav", 2.0, "", 0.0),
        ],
        key=repr,
    )
    scores = {r[0]: r[1] for r in got.select("utterances_file_name", "language_confidence_score").collect()}
    assert scores["a1.wav"] == {"hi": "0.9"} and scores["c.wav"] is None
    states = [r[0] for r in df.orderBy("audio_id").select(uj.list_state(F.col("utterances_files_list"))).collect()]
    assert states == ["ok", "ok", "json_null", "missing", "ok", "ok", "corrupt", "ok"]
    assert rows_of(uj.quarantine(df), "audio_id") == [(6,)]


@pytest.mark.parametrize("value,want", [("NaN", 0.0), ('"NaN"', 0.0), ("nan", 0.0), ('"12.5"', 12.5), ("7", 7.0), (None, 0.0), ("x", 0.0)])
def test_snr_cleaning(spark, value, want):
    assert spark.createDataFrame([(value,)], "v string").select(uj.clean_snr(F.col("v"))).first()[0] == want


def test_json_is_written_in_bounded_parts(spark):
    df = spark.createDataFrame([(1, f"f{i:02}", float(i)) for i in range(25)], f"audio_id bigint, {NAME} string, d double")
    parts = uj.utterances_as_json(df, ["audio_id"], {"name": NAME, "duration": "d"}, [NAME], items=10).orderBy("part").collect()
    assert [len(json.loads(p.utterances_files_list)) for p in parts] == [10, 10, 5]
    assert json.loads(parts[2].utterances_files_list)[-1] == {"name": "f24", "duration": 24.0}


def test_quality_gate(spark):
    rows = [("a", 10.0, 24.0), ("b", 10.0, float("nan")), ("c", 16.0, 15.0), ("d", 16.0, 3.0), ("e", 15.0, 15.0), ("f", 1.0, -1.0)]
    df = spark.createDataFrame(rows, f"audio_id string, {SECONDS} double, snr double")
    got = {r.audio_id: (r.status, r.reason, r.snr) for r in quality.quality_gate(df).collect()}
    assert got == {
        "a": ("Clean", None, 24.0),
        "b": ("Rejected", "High-SNR", 0.0),
        "c": ("Rejected", "High Audio Duration", 15.0),
        "d": ("Rejected", "High-SNR", 3.0),
        "e": ("Clean", None, 15.0),
        "f": ("Rejected", "High-SNR", -1.0),
    }
    three = spark.createDataFrame([("r", "Clean", 10.0)] * 3 + [("s", "Rejected", 9.0)], f"audio_id string, status string, {SECONDS} double")
    assert rows_of(quality.cleaned_minutes(three)) == [("r", 0.5), ("s", 0.0)]


STAGING = "audio_id bigint, speaker_name string, source string, load_datetime timestamp_ntz, is_normalized boolean, utterances_files_list string"


def staging(spark, rows):
    df = spark.createDataFrame(
        [(a, n, s, d, z, u) for a, n, s, d, z, u in rows], STAGING.replace("load_datetime timestamp_ntz", "load_datetime string")
    )
    return df.withColumn("load_datetime", F.col("load_datetime").cast("timestamp_ntz"))


UTT = json.dumps([{"name": "x.wav", "duration": "2.0", "snr_value": 20, "status": "Clean"}])


def test_first_and_later_loads(spark):
    rows = staging(
        spark,
        [
            (1, "ann", "s", "2021-01-01", False, UTT),
            (2, "bob", "s", "2021-02-01", False, UTT),
            (2, None, "s", "2021-03-01", False, UTT),
            (3, "cat", "s", "2021-04-01", False, UTT),
        ],
    )
    none = rows.limit(0)
    assert rows_of(cat.media_increment(rows, none), "audio_id") == [(1,), (3,)]
    assert cat.media_increment(rows, none, compat=True).count() == 0
    assert rows_of(cat.media_increment(rows, rows.filter("audio_id = 1")), "audio_id") == [(3,)]


def test_speakers_are_added_once(spark):
    rows = staging(
        spark,
        [
            (1, "ann", "s1", "2021-01-01", False, UTT),
            (2, "ann", "s2", "2021-01-02", False, UTT),
            (3, "bob", "s1", "2021-01-03", False, UTT),
            (4, None, "s1", "2021-01-04", False, UTT),
        ],
    ).withColumns({c: F.lit("v") for c in ("speaker_gender", "mother_tongue", "age_group")})
    empty = spark.createDataFrame([], "speaker_id int, source string, gender string, mother_tongue string, age_group string, voice_signature string, load_datetime timestamp_ntz, speaker_name string")
    once = mut.add_speakers(empty, rows)
    assert rows_of(once, "speaker_id", "speaker_name", "source") == [(1, "ann", "s1"), (2, "ann", "s2"), (3, "bob", "s1")]
    assert mut.add_speakers(once, rows).count() == 3
    assert rows_of(cat.speaker_lookup(rows, once)) == [(1, 1), (2, 1), (3, 3)]


def test_mapping_load_is_idempotent_and_flags(spark):
    rows = staging(
        spark,
        [
            (1, None, "s", "2021-01-01", False, UTT),
            (2, None, "s", "2021-01-01", False, "null"),
            (3, None, "s", "2021-01-01", True, UTT),
            (4, "ann", "s", "2021-01-01", False, UTT),
            (5, None, "s", "2021-01-01", False, "[{"),
        ],
    )
    added = cat.mapping_unknown_speaker(rows)
    assert rows_of(added, "audio_id", NAME, "snr") == [(1, "x.wav", 20.0)]
    assert cat.insert_absent(added, added).count() == 0
    flagged = mut.mark_normalised(rows, cat.normalised_ids(rows, False))
    assert rows_of(flagged.filter("is_normalized"), "audio_id") == [(1,), (2,), (3,)]
    nothing = rows.filter("audio_id = 2")
    assert cat.normalised_ids(nothing, False).count() == 0
    speakers = spark.createDataFrame([(9, "ann")], "speaker_id int, speaker_name string")
    known = cat.mapping_known_speaker(rows, rows.filter("audio_id = 4"), speakers)
    assert rows_of(known, "audio_id", "speaker_id", NAME) == [(4, 9, "x.wav")]


def test_engine_state_and_null_arrays(spark):
    schema = f"audio_id bigint, {NAME} string, staged_for_transcription boolean, stt_api_used array<string>, data_type string, status string, fail_reason string, is_transcribed boolean"
    rows = spark.createDataFrame(
        [
            (1, "a", True, ["google"], "train", "Clean", None, True),
            (1, "b", True, [], None, "Clean", None, None),
            (1, "c", True, None, "train", "Clean", None, False),
            (1, "d", None, [], "train", "Clean", None, None),
        ],
        schema,
    )
    assert rows_of(cat.stt_eligible(rows, "google", ""), NAME) == [("b",)]
    assert rows_of(cat.stt_eligible(rows, "azure", "train"), NAME) == [("a",)]
    done = spark.createDataFrame(
        [(1, "a", "Rejected", "bad", False, "azure"), (1, "c", "Clean", None, True, "azure")],
        f"audio_id bigint, {NAME} string, status string, reason string, is_transcribed boolean, engine string",
    )
    got = {r[NAME]: r for r in mut.transcription_outcome(rows, done).collect()}
    assert (got["a"].status, got["a"].fail_reason, got["a"].is_transcribed, got["a"].stt_api_used) == ("Rejected", "bad", True, ["azure", "google"])
    assert got["c"].is_transcribed is True and got["c"].stt_api_used == ["azure"]
    assert got["b"].status == "Clean" and got["b"].stt_api_used == []


def test_all_outcomes_of_a_clip_count(spark):
    ddl = f"audio_id bigint, {NAME} string, status string, fail_reason string, is_transcribed boolean, stt_api_used array<string>"
    rows = spark.createDataFrame([(1, "a", "Clean", None, None, ["x"]), (1, "b", "Clean", None, True, None)], ddl)
    done = spark.createDataFrame(
        [(1, "a", "Rejected", "bad", False, "beta", 1), (1, "a", "Clean", None, True, "alpha", 2), (1, "b", "Rejected", "no", False, "beta", 3)],
        f"audio_id bigint, {NAME} string, status string, reason string, is_transcribed boolean, engine string, pos int",
    )
    last = {r[NAME]: r for r in mut.transcription_outcome(rows, done, ["pos"]).collect()}
    assert (last["a"].status, last["a"].fail_reason, last["a"].is_transcribed, last["a"].stt_api_used) == ("Clean", None, True, ["alpha", "beta", "x"])
    assert (last["b"].status, last["b"].is_transcribed, last["b"].stt_api_used) == ("Rejected", True, ["beta"])
    reverse = {r[NAME]: r for r in mut.transcription_outcome(rows, done.withColumn("pos", -F.col("pos")), ["pos"]).collect()}
    assert (reverse["a"].status, reverse["a"].fail_reason, reverse["a"].stt_api_used) == ("Rejected", "bad", ["alpha", "beta", "x"])


def test_no_part_of_a_list_is_lost(spark):
    clips = spark.createDataFrame([(1, f"f{i}", float(i)) for i in range(5)], f"audio_id bigint, {NAME} string, d double")
    staging = spark.createDataFrame([(1, "[]"), (2, "[]")], "audio_id bigint, utterances_files_list string")
    for items in (None, 1, 2, 5):
        lists = uj.utterances_as_json(clips, ["audio_id"], {"name": NAME, "duration": "d"}, [NAME], items=items)
        after = mut.replace_utterances(staging, lists).orderBy("audio_id").collect()
        assert [u["name"] for u in json.loads(after[0].utterances_files_list)] == [f"f{i}" for i in range(5)], items
        assert len(after) == 2 and after[1].utterances_files_list == "[]"


def test_repeated_changes_count_once(spark):
    table = spark.createDataFrame([(1, "x"), (2, "y")], "k int, v string")
    changes = spark.createDataFrame([(1, "b"), (1, "a"), (7, "z")], "k int, v string")
    assert rows_of(mut.apply_changes(table, changes, ["k"], {"v": mut.take_new})) == [(1, "a"), (2, "y")]
    assert mut.changed_count(table, changes, ["k"]).first()[0] == 1
    assert mut.bulk_apply(table, [], ["k"], ["v"]) is table


def quota_model(counts, quota):
    """Fill batches of ``quota`` from the front; what is left of an id opens the next batch."""
    batches, room = [[]], quota
    for audio_id, count in counts:
        while count:
            if not room:
                batches.append([])
                room = quota
            taken = min(count, room)
            batches[-1].append(audio_id)
            count, room = count - taken, room - taken
    return sorted(((b, a) for b, ids in enumerate(batches) for a in ids), key=repr)


def test_quota_batches_against_a_loop(spark):
    import random

    for seed in range(3):
        rng = random.Random(seed)
        counts = [(i, rng.randrange(1, 40)) for i in range(rng.randrange(3, 30))]
        workers = rng.randrange(1, 9)
        quota = -(-sum(c for _, c in counts) // workers)
        want = quota_model(sorted(counts, key=lambda c: (-c[1], c[0])), quota)
        df = spark.createDataFrame(counts, "audio_id bigint, utterance_count bigint")
        assert rows_of(plan.quota_batches(df, workers, partitions=5)) == want
    assert plan.quota_batches(df.limit(0), 3).count() == 0


def test_manifests(spark):
    files = spark.createDataFrame([("base/71/clean/f.wav",)], "path string")
    assert rows_of(plan.move_manifest(files, "land/src")) == [("base/71/clean/f.wav", "land/src/71/clean/f.wav")]
    assert rows_of(plan.move_path_manifest(spark.createDataFrame([("base/71",)], "path string"), "land/src")) == [("base/71", "land/src/71")]
    with pytest.raises(ValueError, match="file not found"):
        plan.require_rows(files.limit(0))


EXPORT = "audio_file_name string, duration double, snr double, speaker_name string, collection_source string, main_source string, gender string, audio_id bigint, status string"


def test_corpus_records(spark):
    rows = spark.createDataFrame(
        [
            ("test1.wav", 10.0, 38.0, "ann", "https://c", "https://m", "f", 1, "Clean"),
            ("test2.wav", 11.0, 40.0, "bob", "https://c", "https://m", "x", 2, "Clean"),
            ("other.wav", 12.0, 41.0, None, "https://c", "https://m", None, 3, "Rejected"),
        ],
        EXPORT,
    )
    texts = spark.createDataFrame([("test1", "sample text 1"), ("test2", "sample text 2")], "stem string, text string")
    labelled = [r.asDict(recursive=True) for r in pub.corpus_records(rows, "src", texts).orderBy("audioId").collect()]
    assert labelled[0] == {
        "audioFilename": "test1.wav",
        "collectionSource": ["src", "https://c", "https://m"],
        "snr": {"methodType": "WadaSnr", "methodDetails": {"snr": 38.0}},
        "duration": 10.0,
        "speaker": "ann",
        "gender": "female",
        "audioId": 1,
        "text": "sample text 1",
    }
    assert [r["text"] for r in labelled] == ["sample text 1", "sample text 2"]
    plain = pub.corpus_records(rows, "src")
    assert plain.count() == 3 and "text" not in plain.columns
    assert pub.public_records(plain).columns == ["audioFilename", "collectionSource", "snr", "duration", "gender"]
    wav = rows_of(pub.download_manifest(rows.limit(1), "b", "w", labelled=False, external=True))
    assert wav == [("b/test1.wav", "w/test1.wav")]
    both = rows_of(pub.download_manifest(rows.filter("audio_id = 3"), "b", "w", labelled=True, external=False))
    assert both == [("b/3/rejected/other.txt", "w/other.txt"), ("b/3/rejected/other.wav", "w/other.wav")]


def test_transcription_gate_cases(spark):
    rows = [("a.wav", "Clean", "why", 3.0), ("b.wav", "Rejected", "why", 4.0), ("c.wav", "Clean", None, 0.2), ("d.wav", "Clean", None, 18.0), ("e.txt", "Clean", None, 3.0)]
    known = spark.createDataFrame(rows, f"{NAME} string, status string, reason string, {SECONDS} double")
    files = spark.createDataFrame([(r[0],) for r in rows] + [("unknown.wav",)], f"{NAME} string")
    assert rows_of(transcription.transcription_gate(files, known, True), NAME, "status", "reason") == [("a.wav", "Clean", "why")]
    assert rows_of(transcription.transcription_gate(files, known, False), NAME, "status", "reason") == [("a.wav", "Clean", "why"), ("b.wav", "Clean", "redacted")]


def test_transcription_outcomes(spark):
    rows = spark.createDataFrame([("ok",), ("same",), ("bad",), ("fail",)], "path string")

    def engine(path):
        if path == "fail":
            raise RuntimeError("no match")
        return {"ok": " good-day ", "same": "good", "bad": "₹5"}[path]

    done = {r.path: r for r in transcription.outcome(transcription.transcribe(rows, engine), "indian_english", "azure").collect()}
    assert (done["ok"].transcript, done["ok"].original_transcript, done["ok"].status) == ("good day", " good-day ", "Clean")
    assert done["same"].original_transcript is None and done["same"].is_transcribed
    assert done["bad"].reason.startswith("sanitization error:") and not done["bad"].is_transcribed
    assert done["fail"].reason == "STT API error:no match" and done["fail"].transcript is None
    raw = {r.path: r for r in transcription.outcome(transcription.transcribe(rows, engine), "hindi", "inhouse").collect()}
    assert raw["ok"].transcript == " good-day " and raw["bad"].status == "Clean"


def test_listing_attributes(spark):
    paths = [
        "p/hindi/s1/71/clean/1_raw.name.wav",
        "p/hindi/s1/Train/72/rejected/x.wav",
        "p/hindi/s1/7,3/clean/2_a,b.wav",
        "p/hindi/s1/71/clean/1_raw.txt",
        "p/hindi/s1/short.wav",
    ]
    got = reconcile.path_attributes(spark.createDataFrame([(p,) for p in paths], "path string"), "p/hindi")
    assert rows_of(got) == [
        ("p/hindi/s1/71/clean/1_raw.name.wav", "s1", 71, "raw", "1_raw.name.wav", "clean"),
        ("p/hindi/s1/73/clean/2_ab.wav", "s1", 73, "ab", "2_ab.wav", "clean"),
        ("p/hindi/s1/Train/72/rejected/x.wav", "s1", 72, "NA", "x.wav", "rejected"),
    ]


def test_report_parts_are_disjoint(spark):
    catalogue = lists(
        spark,
        json.dumps([{"name": f"{i}_r.wav", "duration": str(i), "status": "Clean"} for i in range(4)] + [{"name": "20_r.wav", "duration": "20", "status": "Clean"}]),
        "[]",
    ).withColumn("raw_file_name", F.lit("r")).withColumn("source", F.lit("s"))
    files = [f"p/s/0/clean/{i}_r.wav" for i in (1, 2, 9, 20)] + ["p/s/0/rejected/3_r.wav"]
    listing = spark.createDataFrame([(f, 1) for f in files], "path string, length bigint")
    mapping = spark.createDataFrame([(0, "1_r.wav", 5), (0, "2_r.wav", 6)], f"audio_id bigint, {NAME} string, speaker_id int")
    report = reconcile.validation_report(catalogue, listing, mapping, base="p", bucket="b", stage="post")
    assert rows_of(report["bucket_not_in_catalog"], "utterances_file_name") == [("9_r.wav",)]
    assert rows_of(report["catalog_not_in_bucket"], "audio_id", "utterances_file_name") == [(0, "0_r.wav"), (1, None)]
    assert report["bucket_in_catalog"].count() == 4
    assert rows_of(report["invalid_duration"], "utterances_file_name") == [("20_r.wav",)]
    assert rows_of(report["duplicates"], "audio_id") == [(0,), (1,)]
    assert rows_of(report["valid_and_unique"], "audio_id", "cleaned_duration") == [(0, 3.0 / 60)]
    assert rows_of(report["final"], "transcriptions_path_bucket", "speaker_id") == [("gs://b/p/s/0/clean/1_r.txt", 5), ("gs://b/p/s/0/clean/2_r.txt", 6)]
    for empty, message in ((catalogue.limit(0), "catalogue is empty"), (catalogue, "listing is empty")):
        with pytest.raises(ValueError, match=message):
            reconcile.validation_report(empty, listing if empty is not catalogue else listing.limit(0), mapping, base="p", bucket="b")
