"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS (default 8) choose data and cores.
"""

from __future__ import annotations

import json
import os
import time

HEADLINE = [
    "filter_spec_candidates",
    "filter_spec_full",
    "speaker_budget",
    "total_cap",
    "random_sample",
    "quality_gate",
    "cleaned_minutes",
    "utterances_exploded",
    "sanitize_hindi",
    "sanitize_en",
    "media_increment",
    "mapping_rows",
    "speaker_table",
    "dup_by_name_or_hash",
    "batch_dedup_exact",
    "bucket_not_in_catalog",
    "catalog_not_in_bucket",
    "bucket_in_catalog",
    "valid_per_audio",
    "cleaned_with_mapping",
    "stt_counts",
    "quota_batches",
    "fixed_batches",
    "stage_update",
    "transcribe_update",
    "speaker_assign",
    "publish_unlabelled",
    "speaker_files",
    "cosine_pairs",
    "nearest_centroid",
    "merge_round",
    "density_clusters",
    "hysteresis",
    "hysteresis_wide",
    "framing",
]


def main() -> None:
    from sonoloom.plans import load
    from sonoloom.session import build_session

    cpus = os.environ.get("BENCH_CPUS", "8")
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.ui.enabled": "false",
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "8g"),
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    queries = load().QUERIES
    spark.read.parquet(f"{sf_dir}/lineitem.parquet").selectExpr("sum(l_quantity)").collect()
    seconds = {}
    for name in HEADLINE:
        start = time.perf_counter()
        queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total seconds of the headline queries",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
