"""The report's steps run their input once: paths are split once a row, a written report is not computed again."""

from datetime import datetime

from check import duck
from conftest import rows_of
from pyspark.sql import functions as F

from sonoloom.operators import reconcile as rec
from sonoloom.plans import load
from sonoloom.plans.reconciling import stored
from sonoloom.plans.views import STORE
from sonoloom.sources import sinks


def optimized(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_a_path_is_split_once_however_many_columns_are_filtered(spark, tiny):
    clean = rec.clean_listing(stored(spark, tiny)).filter("utterances_file_name IS NOT NULL AND audio_id > 3")
    branches = optimized(clean).count("Union") + 1
    assert optimized(clean).count("split(") <= branches


def test_paths_with_commas_other_names_and_nulls(spark):
    paths = [f"{STORE}/src0/train/7/clean/1_a.wav", f"{STORE}/src1/8/rej,ected/b.wav", f"{STORE}/src1/8/clean/c.w,av", f"{STORE}/src1/x/clean/d.wav", None, "wav"]
    listing = spark.createDataFrame([(p, 1) for p in paths], "path string, length bigint")
    found = rows_of(rec.path_attributes(listing, STORE), "source", "audio_id", "raw_file_name", "utterances_file_name", "status")
    assert found == [("src0", 7, "a", "1_a.wav", "clean"), ("src1", 8, "NA", "b.wav", "rejected")]


def test_stored_not_catalogued_is_read_without_a_checkpoint(spark, tiny):
    query = load()
    df = query.QUERIES["bucket_not_in_catalog"](spark, tiny)
    assert "ExistingRDD" not in df._jdf.queryExecution().optimizedPlan().toString() and "LogicalRDD" not in optimized(df)
    assert df.count() == len(duck(tiny).execute(query.CHECKS["bucket_not_in_catalog"]).fetchall())


def test_a_report_is_computed_once(spark, tmp_path):
    seen = spark.sparkContext.accumulator(0)

    def watched(batches):
        for batch in batches:
            seen.add(len(batch))
            yield batch

    rows = spark.range(0, 25, 1, 2).select("id", F.concat(F.lit("n"), "id").alias("name")).mapInPandas(watched, "id bigint, name string")
    files = sinks.write_final_report(rows, str(tmp_path), "src", datetime(2021, 1, 1), ["id"], rows_per_file=10)
    assert seen.value == 25 and len(files) == 3
    assert spark.read.option("header", True).csv(files).count() == 25
