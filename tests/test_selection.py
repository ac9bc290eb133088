"""Selection requests on generated rows against a plain loop, and the NULL and order rules."""

import pytest
from conftest import rows_of
from pyspark.sql import functions as F

from sonoloom.operators import selection as sel

COLUMNS = "speaker_id int, clipped_utterance_file_name string, clipped_utterance_duration double, audio_id string, snr double, pos int"


def generated(count, speakers, seed):
    """(speaker, file, seconds, audio id, snr) from a congruential sequence; every eleventh row has no speaker."""
    rows, state = [], seed
    for i in range(count):
        state = (state * 1103 + 377) % 7919
        speaker = None if i % 11 == 10 else state % speakers
        rows.append((speaker, f"clip-{seed}-{i:03}.wav", 0.5 + state % 29 / 2, f"rec{state % 13}", float(state % 41 - 3)))
    return rows


FEW, MANY = generated(14, 3, 5), generated(160, 9, 11)


def budget(rows, low, high):
    """Rows while their speaker's total is at most ``high``, for speakers with some total between the bounds (seconds)."""
    totals, kept, good = {}, [], set()
    for row in rows:
        speaker = row[1][0]
        if speaker is None:
            continue
        totals[speaker] = totals.get(speaker, 0) + row[1][2]
        if low <= totals[speaker] <= high:
            good.add(speaker)
        if totals[speaker] <= high:
            kept.append(row)
    return [row for row in kept if row[1][0] in good]


def expected(rows, request):
    left = list(enumerate(rows))
    left = [x for x in left if x[1][0] not in request.get("exclude_speaker_ids", [])]
    left = [x for x in left if x[1][3] not in request.get("exclude_audio_ids", [])]
    for key, column in (("by_utterance_duration", 2), ("by_snr", 4)):
        if key in request:
            left = [x for x in left if request[key]["gte"] <= x[1][column] <= request[key]["lte"]]
    if "by_speaker" in request:
        b = request["by_speaker"]
        slack = b["with_threshold"]
        left = budget(left, (b["gte_per_speaker_duration"] - slack) * 60, (b["lte_per_speaker_duration"] + slack) * 60)
    if "by_duration" in request:
        kept, total = [], 0.0
        for row in left:
            total += row[1][2]
            if total > request["by_duration"] * 3600 + 1e-6:
                break
            kept.append(row)
        left = kept
    return [position for position, _ in left]


PER_SPEAKER = {"gte_per_speaker_duration": 0.25, "lte_per_speaker_duration": 0.75, "with_threshold": 0.0}
REQUESTS = {
    "nothing asked": {},
    "speakers": {"exclude_speaker_ids": [0, 2, 400]},
    "recordings": {"exclude_audio_ids": ["rec3", "rec7"]},
    "both": {"exclude_audio_ids": ["rec3"], "exclude_speaker_ids": [1]},
    "quality": {"by_snr": {"gte": 4, "lte": 22}},
    "length": {"by_utterance_duration": {"gte": 3, "lte": 9.5}},
    "length and quality": {"by_utterance_duration": {"gte": 3, "lte": 9.5}, "by_snr": {"gte": 4, "lte": 30}, "by_source": "unused"},
    "per speaker": {"by_speaker": PER_SPEAKER},
    "per speaker with slack": {"by_speaker": {**PER_SPEAKER, "with_threshold": 0.125}},
    "a bound that few reach": {"by_speaker": {"gte_per_speaker_duration": 2.0, "lte_per_speaker_duration": 2.05, "with_threshold": 0.0}},
    "total": {"by_duration": 90 / 3600},
    "all of it": {"by_snr": {"gte": 2, "lte": 34}, "by_speaker": PER_SPEAKER, "by_duration": 75 / 3600},
}


def frame(spark, rows):
    return spark.createDataFrame([(*row, i) for i, row in enumerate(rows)], COLUMNS)


@pytest.mark.parametrize("name", REQUESTS)
@pytest.mark.parametrize("rows", [[], FEW, MANY], ids=["none", "few", "many"])
def test_requests(spark, rows, name):
    chosen = sel.FilterSpec.from_dict(REQUESTS[name]).apply(frame(spark, rows), ["pos"])
    assert sorted(r.pos for r in chosen.collect()) == expected(rows, REQUESTS[name])


def test_speaker_budget_same_in_split_form(spark):
    args = {"gte_per_speaker_duration": 0.3, "lte_per_speaker_duration": 1.5, "with_threshold": 0.1}
    for rows in (FEW, MANY):
        plain = sel.speaker_budget(frame(spark, rows), ["pos"], **args)
        split = sel.speaker_budget(frame(spark, rows), ["pos"], **args, max_group_rows=0, partitions=6)
        assert rows_of(plain, "pos") == rows_of(split, "pos")


def test_audio_exclusion_old_form_tests_the_speaker(spark):
    spec = sel.FilterSpec.from_dict({"exclude_audio_ids": [1, 2], "exclude_speaker_ids": [0]})
    got = sorted(r.pos for r in spec.apply(frame(spark, FEW), ["pos"], compat=True).collect())
    assert got == [i for i, row in enumerate(FEW) if row[0] not in (1, 2)] and any(FEW[i][0] == 0 for i in got)


def test_null_is_never_excluded(spark):
    rows = frame(spark, [(None, "a", 1.0, None, 1.0), (1, "b", 1.0, "1", 1.0)])
    assert [r.pos for r in sel.exclude_ids(rows, "speaker_id", [1]).collect()] == [0]
    assert [r.pos for r in sel.exclude_ids(rows, "speaker_id", list(range(5000))).collect()] == [0]


def test_random_selection_is_exact_and_seeded(spark):
    rows = frame(spark, [(i % 7, f"f{i}", 1.0, str(i), 20.0) for i in range(200)])
    one = sel.sample_rows(rows, 0.25, ["pos"], seed=1)
    two = sel.sample_rows(rows, 0.25, ["pos"], seed=2)
    assert one.count() == two.count() == 50
    assert rows_of(one, "pos") != rows_of(two, "pos")
    assert rows_of(one, "pos") == rows_of(sel.sample_rows(rows, 0.25, ["pos"], seed=1), "pos")
    spec = sel.FilterSpec.from_dict({"by_duration": 33 / 3600, "with_randomness": "true"})
    assert spec.apply(rows, ["pos"]).count() == 33
    assert not sel.FilterSpec.from_dict({"with_randomness": "True"}).with_randomness


def test_spec_is_checked():
    with pytest.raises(ValueError, match="by_snr"):
        sel.FilterSpec.from_dict({"by_snr": {"gte": 1}})


def test_row_without_duration_is_dropped_from_totals(spark):
    seconds = F.col("clipped_utterance_duration")
    rows = frame(spark, FEW).withColumn("clipped_utterance_duration", F.when(F.col("pos") % 3 != 1, seconds))
    with_length = [row if i % 3 != 1 else (*row[:2], 0.0, *row[3:]) for i, row in enumerate(FEW)]
    want = [i for i in expected(with_length, {"by_duration": 40 / 3600}) if i % 3 != 1]
    assert sorted(r.pos for r in sel.cap_total(rows, 40 / 3600, ["pos"]).collect()) == want


def test_total_cap_same_with_any_split(spark):
    rows = [(i % 5, f"f{i}", float(1 + i % 4), str(i), 20.0) for i in range(300)]
    want = expected(rows, {"by_duration": 0.05})
    for parts in (1, 3, 17, 60):
        assert sorted(r.pos for r in sel.cap_total(frame(spark, rows), 0.05, ["pos"], partitions=parts).collect()) == want
