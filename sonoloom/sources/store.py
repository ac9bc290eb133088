"""Files of a store reached from tasks: listing level by level, and writing under exact names.

A location is a path or a URI that Arrow's file systems know (local, HDFS, S3, GCS).
"""

from __future__ import annotations

import fnmatch
import json
import re
import uuid
from collections.abc import Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor
from contextlib import suppress
from dataclasses import dataclass
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage
from pyspark.sql.types import StructType

from sonoloom.session import work_path

FOLDERS_PER_TASK = 64
MOST_TASKS = 20_000
MOVERS = 16
FEW_FILES = 10_000
LISTED_ROWS = 10_000
READ_FILES = 1_024
READ_BYTES = 64 * 1024 * 1024
CHUNK_FILES = 256
CHUNK_BYTES = 8 * 1024 * 1024
FOLDERS = "folders"
TWO_TASKS = "two tasks wrote lines of one file"
LISTED = "path string, length bigint, modificationTime timestamp"


def located(location: str) -> tuple[fs.FileSystem, str]:
    """File system and path of a location."""
    return fs.FileSystem.from_uri(re.sub(r"^file:/+", "/", location))


def is_reachable(location: str) -> bool:
    try:
        located(location)
    except (pa.ArrowInvalid, pa.ArrowNotImplementedError, OSError):
        return False
    return True


def is_folder(location: str) -> bool:
    """Whether a location is a folder that tasks can reach."""
    if not is_reachable(location):
        return False
    store, root = located(location)
    return store.get_file_info(root).type == fs.FileType.Directory


def _left_out(name: str, keyed: bool) -> bool:
    return name[0] == "." or name[0] == "_" and not (keyed and "=" in name)


def _expander(root: str, pattern: str, keyed: bool):
    """Entries one level below each folder: matching files, and all folders."""

    def expand(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = located(root)
        for batch in batches:
            for folder in batch.column("path").to_pylist():
                inside = base + folder[len(root) :]
                entries = store.get_file_info(fs.FileSelector(inside, allow_not_found=folder != root))
                for start in range(0, len(entries), LISTED_ROWS):
                    rows = []
                    for entry in entries[start : start + LISTED_ROWS]:
                        is_folder = entry.type == fs.FileType.Directory
                        if not _left_out(entry.base_name, keyed) and (is_folder or fnmatch.fnmatchcase(entry.base_name, pattern)):
                            rows.append((f"{folder}/{entry.base_name}", None if is_folder else entry.size, entry.mtime, is_folder))
                    paths, sizes, times, folders = zip(*rows) if rows else ((), (), (), ())
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(paths, pa.string()),
                            pa.array(sizes, pa.int64()),
                            pa.array(times, pa.timestamp("us", tz="UTC")),
                            pa.array(folders, pa.bool_()),
                        ],
                        ["path", "length", "modificationTime", "is_folder"],
                    )

    return expand


def list_levels(spark: SparkSession, root: str, pattern: str, keyed: bool = False) -> DataFrame:
    """(path, length, modificationTime) of the files below ``root`` whose name matches, listed by tasks.

    Each level's folders are dealt to tasks that list them, and the folders found are the next level, so neither the driver nor
    a single task walks the tree, and the number of jobs is its depth.  The listing is a written table; names that begin
    with a dot or an underscore are left out, as Spark's readers do; those take ``_day=1``, as is done with ``keyed``.  A missing root is an error; a folder that vanishes
    meanwhile counts as empty.
    """
    root, target, level = root.rstrip("/"), work_path(spark, "listing"), 0
    folders = spark.createDataFrame([(root,)], "path string")
    while True:
        written = f"{target}/level={level}"
        folders.mapInArrow(_expander(root, pattern, keyed), f"{LISTED}, is_folder boolean").write.parquet(written)
        found = spark.read.parquet(written).filter("is_folder").select("path")
        count = found.count()
        if not count:
            break
        folders, level = found.repartition(min(-(-count // FOLDERS_PER_TASK), MOST_TASKS)), level + 1
    return spark.read.schema(f"{LISTED}, is_folder boolean").parquet(target).filter("NOT is_folder").select("path", "length", "modificationTime")


def _uri_name(name: str) -> str:
    """A file name as ``_metadata.file_name`` has it, with the characters escaped that a URI's path may not hold."""
    return re.sub(r"[^A-Za-z0-9\-_.!~*'():@&=+$,;\u0080-\U0010ffff]|[\s\x80-\x9f]", lambda found: quote(found[0]), name)


def read_files(spark: SparkSession, root: str, pattern: str) -> DataFrame:
    """(file_name, content) of the whole files below ``root`` whose name matches, without empty ones; listed and read by tasks.

    The driver knows neither the files nor their number of bytes one by one.  A task reads about ``READ_FILES`` files or
    ``READ_BYTES``, some at a time and a chunk after the other.
    """
    root = root.rstrip("/")
    files = list_levels(spark, root, pattern, keyed=True).filter("length > 0").select("path", "length")
    facts = files.agg(F.count(F.lit(1)).alias("n"), F.sum("length").alias("bytes")).first()
    tasks = max(1, -(-facts["n"] // READ_FILES), -(-(facts["bytes"] or 0) // READ_BYTES))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = located(root)

        def whole(path: str) -> bytes:
            with store.open_input_stream(base + path[len(root) :], compression=None) as content:
                return content.read()

        def chunk(paths: list[str]) -> pa.RecordBatch:
            names = [_uri_name(path.rsplit("/", 1)[1]) for path in paths]
            return pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(readers.map(whole, paths), pa.binary())], ["file_name", "content"])

        with ThreadPoolExecutor(MOVERS) as readers:
            for batch in batches:
                paths, held = [], 0
                for path, length in zip(batch.column("path").to_pylist(), batch.column("length").to_pylist()):
                    if paths and (len(paths) == CHUNK_FILES or held + length > CHUNK_BYTES):
                        yield chunk(paths)
                        paths, held = [], 0
                    paths.append(path)
                    held += length
                if paths:
                    yield chunk(paths)

    return files.repartition(min(tasks, MOST_TASKS)).mapInArrow(read, "file_name string, content binary")


@dataclass
class Written(WriterCommitMessage):
    """The folder of one task and how many files it completed; their final names are in the folder's list, by number."""

    folder: str
    count: int


def _moves(store: fs.FileSystem, folder: str) -> list[tuple[str, str]]:
    """Temporary path and final name of the files of one task."""
    with store.open_input_stream(f"{folder}/names") as names:
        return [(f"{folder}/{i}", json.loads(line)) for i, line in enumerate(names.read().splitlines())]


def _move(store: fs.FileSystem, root: str, moves: list[tuple[str, str]]) -> None:
    """Files to their names; one that an earlier attempt moved is left where it is."""

    def move(file: tuple[str, str]) -> None:
        try:
            store.move(file[0], f"{root}/{file[1]}")
        except FileNotFoundError:
            if store.get_file_info(f"{root}/{file[1]}").type != fs.FileType.File:
                raise

    for folder in {f"{root}/{name}".rsplit("/", 1)[0] for _, name in moves} | {root}:
        store.create_dir(folder)
    with ThreadPoolExecutor(MOVERS) as movers:
        list(movers.map(move, moves))


def _clear(store: fs.FileSystem, root: str, pending: str) -> None:
    with suppress(FileNotFoundError):
        store.delete_dir(f"{root}/{pending}")


class NamedFilesWriter(DataSourceArrowWriter):
    """Writes lines to the files they name; nothing has its final name before all tasks are done."""

    def __init__(self, location: str, pending: str):
        self.location, self.pending = location.rstrip("/"), pending

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        store, root = located(self.location)
        folder, out, last = f"{root}/{self.pending}/{uuid.uuid4().hex}", None, None
        seen: dict[str, None] = {}
        try:
            for batch in iterator:
                for name, line in zip(batch.column("file").to_pylist(), batch.column("value").to_pylist()):
                    if name != last:
                        if out is not None:
                            out.close()
                        if name in seen:
                            raise ValueError(f"the lines of {name} do not follow one another")
                        if not seen:
                            store.create_dir(folder)
                        out, last = store.open_output_stream(f"{folder}/{len(seen)}"), name
                        seen[name] = None
                    out.write(f"{line}\n".encode())
        finally:
            if out is not None:
                out.close()
        if seen:
            with store.open_output_stream(f"{folder}/names") as names:
                names.write("".join(f"{json.dumps(name)}\n" for name in seen).encode())
        return Written(folder, len(seen))

    def commit(self, messages: Sequence[Written | None]) -> None:
        store, root = located(self.location)
        done = [message for message in messages if message is not None and message.count]
        if sum(message.count for message in done) > FEW_FILES:  # left to tasks, see ``write_lines``
            with store.open_output_stream(f"{root}/{self.pending}/{FOLDERS}") as folders:
                folders.write("".join(f"{message.folder}\n" for message in done).encode())
            return
        moves = [move for message in done for move in _moves(store, message.folder)]
        if len({name for _, name in moves}) < len(moves):
            self.abort(messages)
            raise ValueError(TWO_TASKS)
        _move(store, root, moves)
        _clear(store, root, self.pending)

    def abort(self, messages: Sequence[Written | None]) -> None:
        _clear(*located(self.location), self.pending)


class NamedFiles(DataSource):
    """Sink of (file, value): each ``value`` is a line of the file of that name below the option ``path``.

    The lines of a file must follow one another in one partition; ``write_lines`` sees to that.  Tasks write below a hidden
    folder; only when all are done are the files of the successful attempts moved to their names, so a failed job leaves none.
    """

    @classmethod
    def name(cls) -> str:
        return "named_files"

    def schema(self) -> str:
        return "file string, value string"

    def writer(self, schema: StructType, overwrite: bool) -> NamedFilesWriter:
        if [f.name for f in schema.fields] != ["file", "value"]:
            raise ValueError("named files are written from the columns file and value")
        return NamedFilesWriter(self.options["path"], self.options["pending"])


def write_lines(rows: DataFrame, path: str, file: Column, value: Column, order_by: Sequence[str]) -> None:
    """One file below ``path`` for each value of ``file``, holding the rows' ``value`` as lines, ascending by the columns given.

    A file is written by one task as a stream, many files by each task, so a task holds no file in memory; keep files to a bounded
    number of lines, as batches are.
    """
    rows.sparkSession.dataSource.register(NamedFiles)
    order = [F.col(o).alias(f"_o{i}") for i, o in enumerate(order_by)]
    lines = rows.select(file.alias("file"), value.alias("value"), *order).repartition("file")
    placed = lines.sortWithinPartitions("file", *[f"_o{i}" for i in range(len(order))]).select("file", "value")
    pending = f"_pending-{uuid.uuid4().hex}"
    placed.write.format("named_files").mode("append").option("path", path).option("pending", pending).save()
    _publish(rows.sparkSession, path.rstrip("/"), pending)


def _publish(spark: SparkSession, path: str, pending: str) -> None:
    """Move many files to their names by tasks, one for each folder that a task wrote; the driver knows only the folders."""
    store, root = located(path)
    listed = f"{root}/{pending}/{FOLDERS}"
    if store.get_file_info(listed).type != fs.FileType.File:
        return
    with store.open_input_stream(listed) as lines:
        folders = lines.read().decode().splitlines()
    dealt = spark.createDataFrame([(i, folder) for i, folder in enumerate(folders)], "part int, folder string").repartitionById(len(folders), "part")

    def named(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, _ = located(path)
        for batch in batches:
            for folder in batch.column("folder").to_pylist():
                yield pa.RecordBatch.from_arrays([pa.array([name for _, name in _moves(store, folder)], pa.string())], ["file"])

    def moved(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = located(path)
        for batch in batches:
            for folder in batch.column("folder").to_pylist():
                moves = _moves(store, folder)
                _move(store, root, moves)
                yield pa.RecordBatch.from_arrays([pa.array([len(moves)], pa.int64())], ["files"])

    try:
        repeated = dealt.mapInArrow(named, "file string").groupBy("file").count().filter("count > 1")
        if not repeated.isEmpty():
            raise ValueError(TWO_TASKS)
        dealt.mapInArrow(moved, "files bigint").agg(F.sum("files")).collect()
    finally:
        _clear(store, root, pending)
