"""The call ledger: no clip is sent twice, also after a task was killed."""

import os

import pytest

from sonoloom.operators.transcription import transcribe_once


def test_calls_after_a_killed_task(spark, tmp_path):
    log, fuse = str(tmp_path / "log"), str(tmp_path / "fuse")

    def engine(path):
        with open(log, "a") as out:
            out.write(path + "\n")
        if path == "p30" and not os.path.exists(fuse):
            open(fuse, "w").close()
            os._exit(1)
        if path.endswith("7"):
            raise RuntimeError("no match")
        return path.upper()

    rows = [(i, f"p{i:02d}", f"h{i // 2}") for i in range(40)] + [(99, "p00", None)]
    clips = spark.createDataFrame(rows, "id int, path string, content string")
    ledger = str(tmp_path / "ledger")
    with pytest.raises(Exception):
        transcribe_once(clips, engine, ledger, "e", chunk=4, partitions=1).count()
    committed = sum(len(f.read_text().splitlines()) for f in (tmp_path / "ledger").rglob("*.json"))
    assert 0 < committed < 41
    got = {r.id: r for r in transcribe_once(clips, engine, ledger, "e", chunk=4, partitions=1).collect()}
    assert len(got) == 41 and got[99].raw_text == "P00" and got[5].raw_text == "P05" and got[6].engine_error is None and got[7].engine_error == "no match"
    calls = open(log).read().split()
    assert max(calls.count(c) for c in set(calls) if c != "p30" and not c.endswith("7")) <= 1 + 4 / 4
    before = len(calls)
    again = transcribe_once(clips, engine, ledger, "e", content="content", chunk=4)
    assert again.count() == 41
    named = transcribe_once(clips, engine, ledger, "e", chunk=4)
    named.count()
    fresh = open(log).read().split()[before:]
    assert all(c.endswith("7") for c in fresh if fresh.count(c) > 1) and len([c for c in fresh if not c.endswith("7")]) <= 20


def test_answers_of_a_run_are_not_read_back_from_its_ledger(spark, tmp_path):
    clips = spark.createDataFrame([(i, f"p{i}") for i in range(9)], "id int, path string")
    first = transcribe_once(clips, str.upper, str(tmp_path), "e", chunk=2)
    assert not [f for f in first.inputFiles() if f.endswith(".json")]
    again = transcribe_once(clips, str.lower, str(tmp_path), "e", chunk=2)
    assert sorted(r.raw_text for r in first.collect()) == sorted(r.raw_text for r in again.collect()) == [f"P{i}" for i in range(9)]
