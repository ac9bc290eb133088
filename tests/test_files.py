"""Readers and sinks: what is written is read back."""

import json
import re
from datetime import datetime
from pathlib import Path

import pytest
from conftest import rows_of
from pyspark.sql import functions as F

from sonoloom.operators.planning import audio_batches
from sonoloom.sources import readers, sinks
from sonoloom.sources.store import write_lines


def test_metadata_is_bound_by_position(spark, tmp_path):
    header = "file,secs,title,spk,id,clean,n,lang,other,type,src,exp,list,url,gender,site,en,mt,age,st,di,pl,da,pu,{}hash"
    line = 'rec.mp4,12.5,t,ann,71,1.5,1,hindi,false,audio,s,true,"[{{""name"": ""a,b.wav""}}]",u,m,w,e,m,a,s,d,p,d,p,{}abc'
    for name, extra, value in (("with", "license,", "cc,"), ("short", "", "")):
        path = tmp_path / f"{name}.csv"
        path.write_text(header.format(extra) + "\n" + line.format(value) + "\n")
        row = readers.read_metadata_csv(spark, str(path)).first()
        assert (row.raw_file_name, row.duration, row.audio_id, row.media_hash_code) == ("rec.mp4", 12.5, 71, "abc")
        assert row.license == ("cc" if extra else None)
        assert row.utterances_files_list == '[{"name": "a,b.wav"}]'
        assert row.is_normalized is False and row.load_datetime is not None


def test_selection_file(spark, tmp_path):
    path = tmp_path / "u.csv"
    path.write_text("id,audio_id,snr,speaker_id,clipped_utterance_file_name,clipped_utterance_duration\n1,7,20.5,3.0,a.wav,2.5\n2,8,21.0,,b.wav,3.5\n")
    got = readers.read_selection(spark, str(path))
    assert rows_of(got) == [(3, "a.wav", 2.5, 7, 20.5), (None, "b.wav", 3.5, 8, 21.0)]
    path.write_text("audio_id,snr,speaker_id,clipped_utterance_file_name,clipped_utterance_duration\n")
    with pytest.raises(ValueError, match="no utterances"):
        readers.read_selection(spark, str(path))
    path.write_text("audio_id,snr\n1,2\n")
    with pytest.raises(ValueError, match="missing columns"):
        readers.read_selection(spark, str(path))


def test_transcripts_and_listing(spark, tmp_path):
    (tmp_path / "x").mkdir()
    (tmp_path / "x" / "test1.part.txt").write_text("sample text 1")
    (tmp_path / "test2.txt").write_text("sample\ntext 2")
    (tmp_path / "x" / "a.wav").write_bytes(b"1234")
    assert rows_of(readers.read_transcripts(spark, str(tmp_path))) == [("test1", "sample text 1"), ("test2", "sample\ntext 2")]
    listed = readers.list_store(spark, str(tmp_path))
    assert rows_of(listed.select(F.substring_index("path", "/", -1), "length")) == [("a.wav", 4)]
    assert listed.columns == ["path", "length", "modificationTime"]


def test_transcripts_are_listed_by_tasks_and_read_as_spark_does(spark, tmp_path):
    files = {
        "e.txt": b"", "a b/x%20y.v1.txt": b"ab\xff\xc3", "_q.txt": b"h", "_k=1.txt": b"k", ".z.txt": b"z", "_h/i.txt": b"i", "_k=1/j.txt": b"j",
        ".d/k.txt": b"d", "up.TXT": b"u", "[z] #?\u3000;.txt": b"br", "é'(+),~&@$!.txt": b"acc\r\n", "deep/er/twice.txt": b"1", "twice.txt": b"2" * 5_000,
    }
    for name, content in files.items():
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_bytes(content)
    (tmp_path / "none").mkdir()
    read = readers.read_transcripts(spark, str(tmp_path))
    assert not [f for f in read.inputFiles() if f.endswith(".txt")]
    spark_reads = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", "*.txt").text(str(tmp_path), wholetext=True)
    want = rows_of(spark_reads.select(F.substring_index("_metadata.file_name", ".", 1), F.hex("value")))
    assert len(want) == 7
    for root in (str(tmp_path), f"file://{tmp_path}/"):
        assert rows_of(readers.read_transcripts(spark, root).select("stem", F.hex("text"))) == want
    assert rows_of(readers.read_transcripts(spark, str(tmp_path / "twice.txt"))) == [("twice", "2" * 5_000)]
    assert readers.read_transcripts(spark, str(tmp_path / "none")).count() == 0
    with pytest.raises(Exception, match="nowhere"):
        readers.read_transcripts(spark, str(tmp_path / "nowhere")).count()


def test_children(spark):
    paths = ["b/s/a.wav", "b/s/d/x.wav", "b/s/d/y.wav", "b/s/e/f/z.wav", "b/s/n.txt", "b/t/q.wav"]
    listing = spark.createDataFrame([(p,) for p in paths], "path string")
    assert rows_of(readers.list_children(listing, "b/s")) == [("a.wav",), ("d/",), ("e/",)]
    assert rows_of(readers.list_children(listing, "b/s/", include_folders=False)) == [("a.wav",)]


def test_small_files(spark, tmp_path):
    (tmp_path / "m.csv").write_text("a.wav,1\nb.wav,0\n")
    assert rows_of(readers.read_manifest(spark, str(tmp_path / "m.csv"))) == [("a.wav", 1), ("b.wav", 0)]
    (tmp_path / "b.txt").write_text("p/a.wav\n\np/b.wav")
    assert rows_of(readers.read_batch_list(spark, str(tmp_path / "b.txt"))) == [("p/a.wav",), ("p/b.wav",)]
    (tmp_path / "s.csv").write_text("source,num_speaker,total_duration,num_of_audio\nx,3,2.5,9\n")
    assert rows_of(readers.read_source_summary(spark, str(tmp_path / "s.csv"))) == [("x", 3, 2.5, 9)]


def test_reports(spark, tmp_path):
    table = spark.createDataFrame([(1, ["a"])], "k int, l array<string>")
    assert sinks.write_report_tables({"t": table}, str(tmp_path), "post") == []
    (path,) = sinks.write_report_tables({"t": table}, str(tmp_path), "pre-check")
    assert rows_of(spark.read.parquet(path)) == [(1, ["a"])]
    (path,) = sinks.write_final_report(table, str(tmp_path), "src", datetime(2021, 3, 4, 5, 6, 7))
    assert path.endswith("Final_Report_03_04_2021_05_06_07_src.csv")
    assert Path(path).read_text() == 'k,l\n1,"[""a""]"\n'
    more = spark.createDataFrame([(i, f"a{i}") for i in range(5, 0, -1)], "k int, l string")
    files = sinks.write_final_report(more, str(tmp_path), "more", datetime(2021, 3, 4, 5, 6, 7), rows_per_file=2)
    assert [Path(f).read_text() for f in files] == ["k,l\n1,a1\n2,a2\n", "k,l\n3,a3\n4,a4\n", "k,l\n5,a5\n"]
    (empty,) = sinks.write_final_report(more.limit(0), str(tmp_path), "none", datetime(2021, 3, 4, 5, 6, 7))
    assert Path(empty).read_text() == "k,l\n"


def test_corpus_and_batches(spark, tmp_path):
    records = spark.createDataFrame([("a.wav", 1, "ann")], "audioFilename string, audioId bigint, speaker string")
    sinks.write_corpus(records, {"domain": "x"}, str(tmp_path / "c"))
    assert json.loads((tmp_path / "c" / "data.json").read_text()) == [{"audioFilename": "a.wav"}]
    assert json.loads((tmp_path / "c" / "params.json").read_text()) == {"domain": "x"}
    sinks.write_corpus(records.limit(0), {}, str(tmp_path / "none"))
    assert json.loads((tmp_path / "none" / "data.json").read_text()) == []
    many = spark.createDataFrame([(f"{i}.wav",) for i in range(5, 0, -1)], "audioFilename string")
    sinks.write_corpus(many, {}, str(tmp_path / "many"), records_per_file=2)
    got = [[r["audioFilename"] for r in json.loads((tmp_path / "many" / f"data{k}.json").read_text())] for k in ("", "_2", "_3")]
    assert got == [["1.wav", "2.wav"], ["3.wav", "4.wav"], ["5.wav"]]
    listing = spark.createDataFrame([(f"s/{i}/clean/{i}.wav", 1) for i in range(7)] + [("s/9/rejected/9.wav", 1)], "path string, length bigint")
    sinks.write_batches(audio_batches(listing, "wav", 3, "b"), str(tmp_path / "batches"))
    written = {f.name: f.read_text().split() for f in (tmp_path / "batches").iterdir()}
    assert written == {f"batch_file_{k + 1}.txt": [f"b/s/{i}/clean/{i}.wav" for i in range(3 * k, min(3 * k + 3, 7))] for k in range(3)}


def test_failed_writing_leaves_no_file(spark, tmp_path):
    rows = spark.range(40).select(F.col("id"), F.when(F.col("id") == 33, F.raise_error(F.lit("no"))).otherwise("x").alias("line"))
    with pytest.raises(Exception, match="no"):
        write_lines(rows, str(tmp_path), F.concat((F.col("id") % 5).cast("string"), F.lit(".txt")), F.col("line"), ["id"])
    assert [f for f in tmp_path.rglob("*") if f.is_file()] == []


def test_listing_by_levels(spark, tmp_path):
    want = {}
    for i in range(150):
        folder = tmp_path / f"s{i % 3}" / f"{i}" / "clean"
        folder.mkdir(parents=True)
        (folder / f"{i}.wav").write_bytes(b"x" * i)
        (folder / f"{i}.txt").write_bytes(b"x")
        want[f"{tmp_path}/s{i % 3}/{i}/clean/{i}.wav"] = i
    (tmp_path / "_hidden.wav").write_bytes(b"x")
    (tmp_path / "top [1].wav").write_bytes(b"12")
    want[f"{tmp_path}/top [1].wav"] = 2
    for root in (str(tmp_path), f"file:{tmp_path}/", f"file://{tmp_path}"):
        found = readers.list_store(spark, root).collect()
        assert {re.sub(r"^file:/+", "/", r.path): r.length for r in found} == want
        assert all(r.modificationTime is not None for r in found)
    assert readers.list_store(spark, str(tmp_path), "*.mp4").count() == 0
    with pytest.raises(Exception, match="nowhere"):
        readers.list_store(spark, str(tmp_path / "nowhere")).count()


def test_other_sinks(spark, tmp_path):
    rows = spark.createDataFrame(
        [(1, "a", "t", None), (1, "b", "t", "t!")],
        "audio_id bigint, clipped_utterance_file_name string, transcript string, original_transcript string",
    )
    sinks.write_transcripts(rows, str(tmp_path / "t"))
    sinks.write_snapshot(rows, str(tmp_path / "s"))
    sinks.write_speaker_map(rows, str(tmp_path / "m"))
    sinks.write_gender_predictions(rows, str(tmp_path / "g"))
    sinks.write_embeddings(rows, str(tmp_path / "e"))
    want = rows_of(rows)
    assert want == rows_of(spark.read.parquet(str(tmp_path / "t"))) == rows_of(spark.read.parquet(str(tmp_path / "s")))
    assert spark.read.json(str(tmp_path / "m")).count() == 2
    assert spark.read.option("header", True).csv(str(tmp_path / "g")).count() == 2


def test_versions(spark, tmp_path):
    root = str(tmp_path / "table")
    sinks.write_version(spark.range(3), root, 1)
    sinks.write_version(sinks.current_table(spark, root).union(spark.range(1)), root, 2)
    assert sinks.current_table(spark, root).count() == 4


def test_increments(spark, tmp_path):
    from sonoloom.schemas import STAGING
    from sonoloom.streaming.increments import each_increment, follow_staging

    source, seen = str(tmp_path / "in"), []
    one = spark.createDataFrame([(1,), (2,)], "audio_id bigint")
    fields = [f.strip().split(" ") for f in STAGING.split(",")]
    one.select(*[F.col(n).alias(n) if n == "audio_id" else F.lit(None).cast(t).alias(n) for n, t in fields]).write.parquet(source)
    for _ in range(2):
        run = each_increment(follow_staging(spark, source), lambda df, n: seen.append(df.count()), str(tmp_path / "ck"))
        run.awaitTermination(60)
    assert seen == [2]


def test_many_files_are_named_by_tasks(spark, tmp_path, monkeypatch):
    from sonoloom.sources import store

    rows = spark.range(0, 60, 1, 3).select("id", F.concat(F.lit("line "), F.col("id").cast("string")).alias("line"))
    name = F.concat(F.lit("d"), (F.col("id") % 2).cast("string"), F.lit("/"), (F.col("id") % 20).cast("string"), F.lit(".txt"))
    for few in (100, 5):
        root = tmp_path / str(few)
        monkeypatch.setattr(store, "FEW_FILES", few)
        write_lines(rows, str(root), name, F.col("line"), ["id"])
        found = {str(p.relative_to(root)): p.read_text() for p in root.rglob("*") if p.is_file()}
        assert found == {f"d{i % 2}/{i}.txt": "".join(f"line {j}\n" for j in (i, i + 20, i + 40)) for i in range(20)}
    message = store.Written("folder", 1_000_000)
    assert set(vars(message)) == {"folder", "count"}
