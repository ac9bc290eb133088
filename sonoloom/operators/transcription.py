"""Transcription step: gate, pluggable engine, sanitising, outcome of every utterance."""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Callable, Collection, Iterator

import pandas as pd
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from sonoloom.functions.text import sanitise
from sonoloom.operators.selection import DURATION, FILE_NAME
from sonoloom.session import checkpointed
from sonoloom.sources.store import located

CHUNK_CALLS = 32
ENGINE_ERROR = "STT API error:"
SANITISE_ERROR = "sanitization error:"
# Engines whose text is already in the corpus spelling and is stored as it comes.
RAW_ENGINES: frozenset[str] = frozenset({"inhouse"})


def transcription_gate(files: DataFrame, utterances: DataFrame, skip_rejected: bool) -> DataFrame:
    """Utterances to transcribe: catalogued, of usable length, a ``.wav`` file.

    Rejected ones are left out with ``skip_rejected``, otherwise reset to Clean / ``redacted``.
    """
    known = utterances.join(files.select(FILE_NAME).distinct(), FILE_NAME, "left_semi")
    rejected = F.col("status") == "Rejected"
    if skip_rejected:
        known = known.filter(~F.coalesce(rejected, F.lit(False)))
    before = F.col("reason") if "reason" in known.columns else F.lit(None).cast("string")
    usable = known.filter(F.col(DURATION).between(0.5, 15) & F.col(FILE_NAME).contains(".wav"))
    return usable.select(
        *[c for c in usable.columns if c not in ("status", "reason")],
        F.when(rejected, "Clean").otherwise(F.col("status")).alias("status"),
        F.when(rejected, "redacted").otherwise(before).alias("reason"),
    )


def transcribe(utterances: DataFrame, engine: Callable[[str], str], path: str = "path") -> DataFrame:
    """Add ``raw_text`` and ``engine_error`` by calling ``engine(path)`` in Arrow batches.

    ``engine`` is any client or model of the caller; a failure is kept in its row.
    """
    schema = StructType([*utterances.schema.fields]).add("raw_text", "string").add("engine_error", "string")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            results = [_called(engine, file) for file in batch[path]]
            yield batch.assign(raw_text=[r[0] for r in results], engine_error=[r[1] for r in results])

    return utterances.mapInPandas(run, schema)


def transcribe_once(
    utterances: DataFrame,
    engine: Callable[[str], str],
    ledger: str,
    engine_name: str,
    *,
    path: str = "path",
    content: str | None = None,
    chunk: int = CHUNK_CALLS,
    partitions: int | None = None,
) -> DataFrame:
    """As :func:`transcribe`, with one engine call for each content, however often it is run.

    ``content`` names the column of the clip's content hash (its path where none is given); clips that share it share one call.
    ``ledger`` is a folder that all tasks reach.  A task commits its answers there after every ``chunk`` calls, as one file that
    appears as a whole, so a task that is killed and run again, and a later run, go on from the last chunk.  Failed calls
    are not committed: they are kept in their rows and made again in the next run.
    """
    spark = utterances.sparkSession
    root = f"{ledger.rstrip('/')}/{hashlib.md5(engine_name.encode()).hexdigest()}"
    located(ledger)[0].create_dir(located(root)[1])
    run = uuid.uuid4().hex
    call = F.sha2(F.concat_ws("|", F.lit(engine_name), F.coalesce(F.col(content or path).cast("string"), F.col(path))), 256)
    keyed = utterances.withColumn("_call", call)
    calls = keyed.groupBy(F.col("_call").alias("call")).agg(F.min(path).alias("path"))

    # The files of earlier runs only: what this run asks comes back beside the commits, so it is not read again.
    reader = spark.read.schema("call string, text string").options(recursiveFileLookup=True, pathGlobFilter="*.json")
    known = reader.json(root).dropDuplicates(["call"])
    todo = calls.join(known, "call", "left_anti")
    todo = todo.repartition(*([partitions] if partitions else []), "call")

    def ask(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        store, base = located(root)
        folder = f"{base}/{run}-{TaskContext.get().partitionId()}"
        store.create_dir(folder)
        done: dict[str, str] = {}
        for entry in store.get_file_info(fs.FileSelector(folder)):  # chunks of an earlier attempt of this task
            if entry.path.endswith(".json"):
                with store.open_input_stream(entry.path) as lines:
                    done.update((r["call"], r["text"]) for r in map(json.loads, lines.read().splitlines()))
        for batch in batches:
            for start in range(0, len(batch), chunk):
                rows = batch.iloc[start : start + chunk]
                results, fresh = [], []
                for key, file in zip(rows["call"], rows["path"]):
                    text, error = (done[key], None) if key in done else _called(engine, file)
                    results.append((key, text, error))
                    if error is None and key not in done:
                        fresh.append(json.dumps({"call": key, "text": text}))
                if fresh:
                    name = f"{folder}/{uuid.uuid4().hex}"
                    with store.open_output_stream(name) as out:
                        out.write("\n".join([*fresh, ""]).encode())
                    store.move(name, f"{name}.json")
                yield pd.DataFrame(results, columns=["call", "text", "error"])

    asked = checkpointed(todo.mapInPandas(ask, "call string, text string, error string"))
    told = known.withColumn("error", F.lit(None).cast("string")).unionByName(asked)
    both = told.select(F.col("call").alias("_call"), F.col("text").alias("raw_text"), F.col("error").alias("engine_error"))
    return keyed.join(both, "_call", "left").select(*utterances.columns, "raw_text", "engine_error")


def _called(engine: Callable[[str], str], file: str) -> tuple[str | None, str | None]:
    try:
        return engine(file), None
    except Exception as error:
        return None, str(error)


def outcome(
    transcribed: DataFrame, language: str, engine: str, raw_engines: Collection[str] = RAW_ENGINES
) -> DataFrame:
    """Add transcript, original_transcript (where sanitising changed it), status, reason, is_transcribed."""
    text, error = F.col("raw_text"), F.col("engine_error")
    raw = F.struct(text.alias("clean"), F.lit(None).cast("string").alias("reason"))
    checked = transcribed.withColumn("_s", raw if engine in raw_engines else sanitise(text, language))
    kept = [c for c in transcribed.columns if c not in ("status", "reason", "is_transcribed")]
    return checked.withColumn("_why", outcome_reason(error, F.col("_s.reason"))).select(
        *kept,
        F.when(F.col("_why").isNull(), F.col("_s.clean")).alias("transcript"),
        F.when(F.col("_why").isNull() & (F.col("_s.clean") != text), text).alias("original_transcript"),
        F.when(F.col("_why").isNull(), "Clean").otherwise("Rejected").alias("status"),
        F.col("_why").alias("reason"),
        F.col("_why").isNull().alias("is_transcribed"),
        F.lit(engine).alias("engine"),
    )


def outcome_reason(engine_error: Column, reject_reason: Column) -> Column:
    failed = F.when(engine_error.isNotNull(), F.concat(F.lit(ENGINE_ERROR), engine_error))
    return failed.when(reject_reason.isNotNull(), F.concat(F.lit(SANITISE_ERROR), reject_reason))
