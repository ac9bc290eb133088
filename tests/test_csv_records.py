"""CSV folders in splits: mixed headers, quoted line breaks, any split size."""

import csv
import io
import random

import pytest
from conftest import rows_of

from sonoloom.schemas import METADATA_COLUMNS
from sonoloom.sources import csv_records as records_module
from sonoloom.sources import readers
from sonoloom.sources.csv_records import csv_records


@pytest.fixture
def finely(spark):
    """A session that cuts files into splits of a given size."""

    def session(size):
        own = spark.newSession()
        own.conf.set("spark.sql.files.maxPartitionBytes", str(size))
        own.conf.set("spark.sql.files.openCostInBytes", "1")
        return own

    return session


def odd_text(rng):
    return "".join(rng.choice(["a", "bc", ",", '"', "\n", "\r\n", " ", "é", "\\", "'"]) for _ in range(rng.randrange(12)))


@pytest.mark.parametrize("size", [7, 40, 1000])
def test_any_split_gives_the_same_records(finely, tmp_path, size):
    rng, want = random.Random(size), []
    for f in range(4):
        rows = [[str(f), str(i), odd_text(rng)] for i in range(rng.choice([0, 1, 30]) if f else 40)]
        with open(tmp_path / f"{f}.csv", "w", newline="") as out:
            csv.writer(out, lineterminator=rng.choice(["\n", "\r\n"])).writerows([["f", "i", "t"], *rows])
        want += [tuple(r) for r in rows]
    (tmp_path / "none.csv").write_text("")
    records, headers = csv_records(finely(size), str(tmp_path))
    assert records.rdd.getNumPartitions() > 4 or size == 1000
    got = [tuple(next(csv.reader(io.StringIO(r.record, newline="")))) for r in records.collect()]
    assert sorted(got) == sorted(want)
    assert {tuple(r.names) for r in headers.collect()} == {("f", "i", "t")} and headers.count() == 4


@pytest.mark.parametrize("size", [50, 100_000])
def test_folder_with_and_without_license(finely, tmp_path, size):
    want = []
    for name, columns in (("a", METADATA_COLUMNS), ("b", [c for c in METADATA_COLUMNS if c != "license"])):
        with open(tmp_path / f"{name}.csv", "w", newline="") as out:
            writer = csv.writer(out)
            writer.writerow(columns)
            for i in range(20):
                values = {"audio_id": i, "duration": i / 2, "license": f"l{i}", "title": f'two\nlines, "{i}"\r\nof a title', "media_hash_code": f"h{i}"}
                values["num_of_speakers"] = "many" if i == 3 else 2
                writer.writerow([values.get(c, "") for c in columns])
                want.append((i, i / 2, f"l{i}" if name == "a" else None, values["title"], f"h{i}", None if i == 3 else 2, None))
    got = readers.read_metadata_csv(finely(size), str(tmp_path))
    assert rows_of(got, "audio_id", "duration", "license", "title", "media_hash_code", "num_of_speakers", "type") == sorted(want, key=repr)


def test_selection_columns_by_each_file(spark, tmp_path):
    (tmp_path / "a.csv").write_text("id,audio_id,snr,speaker_id,clipped_utterance_file_name,clipped_utterance_duration\n1,7,20.5,3.0,a.wav,2.5\n")
    (tmp_path / "b.csv").write_text('clipped_utterance_duration,clipped_utterance_file_name,speaker_id,snr,audio_id\n3.5,"b,1.wav",,21.0,8\n')
    got = readers.read_selection(spark, str(tmp_path))
    assert rows_of(got) == [(3, "a.wav", 2.5, 7, 20.5), (None, "b,1.wav", 3.5, 8, 21.0)]
    (tmp_path / "c.csv").write_text("audio_id,snr\n1,2\n")
    with pytest.raises(ValueError, match="c.csv: missing columns"):
        readers.read_selection(spark, str(tmp_path))


def test_mixed_metadata_is_written_by_many_tasks(spark, tiny, tmp_path, monkeypatch):
    from sonoloom.plans import io_queries

    monkeypatch.setattr(io_queries, "work_path", lambda _spark, name: str(tmp_path / name))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert io_queries.read_metadata_mixed(spark, tiny).count() == spark.read.parquet(f"{tiny}/orders.parquet").count()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(list((tmp_path / "metadata").glob("*.csv"))) > 2


def test_lines_are_not_sorted_to_find_headers(spark, tmp_path):
    (tmp_path / "a.csv").write_text(' \n\t\r\na,b\n1,"x\ny"\n\n2,z\n')
    lines = records_module._lines(spark, str(tmp_path), None)
    splits = records_module._splits(lines)
    plan = splits._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan
    assert [(r.start, r.first) for r in splits.select("start", "first").collect()] == [(0, "a,b")]
    assert [r.quotes for r in lines.select("quotes").collect()] == [0, 0, 0, 1, 1, 0, 0]


def test_batches_without_open_quotes_are_joined_as_the_others(spark):
    import pyarrow as pa

    def batch(rows):
        columns = list(zip(*rows))
        kinds = (pa.string(), pa.int64(), pa.int32(), pa.int32(), pa.string())
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["file", "block", "start", "quotes", "value"])

    rows = [("f", 0, 0, 0, " "), ("f", 0, 0, 0, "h"), ("f", 0, 0, 2, '"a"'), ("f", 0, 0, 1, 'b"'), ("f", 0, 0, 0, ""), ("f", 0, 0, 1, '"c')]
    rows += [("f", 9, 1, 1, 'd"'), ("f", 9, 1, 0, "e"), ("g", 0, 0, 0, "\u3000"), ("g", 0, 0, 0, "h"), ("g", 0, 0, 0, "\x1c"), ("g", 0, 0, 0, "i")]
    for cut in (False, True):
        found = {}
        for size in (1, 2, 3, len(rows)):
            parts = [batch(rows[i : i + size]) for i in range(0, len(rows), size)]
            found[size] = [tuple(r.values()) for b in records_module._joiner(cut)(iter(parts)) for r in b.to_pylist()]
        assert found[1] == found[2] == found[3] == found[len(rows)], cut
