"""Text files under names of their own, by a data source with a commit step.

Spark's writers name files after tasks.  Here a row is a file's name and a
line, the lines of a name are written in the order they come, and a name
becomes one file.  Rows are dealt out by ranges of name and order, so a file
with many lines is the work of several tasks.  Tasks write into a hidden folder
of their attempt; when all have ended, the parts of a file that several tasks
wrote are put together, the files of the attempts that counted are moved to
their names, and the hidden folder goes with whatever failed attempts left in
it.  Until then nothing can be seen, and a failed write changes nothing.

Files are reached through pyarrow, so paths may be local (shared) folders or
any store that it knows by its scheme.
"""

from __future__ import annotations

import json
import shutil
import uuid
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

FORMAT = "named_text_files"
#: What a write with files in parts leaves in its hidden folder instead of a commit.
PLAN, JOINED, BUFFER = "parts.json", "joined", 1 << 23


def store(path: str) -> tuple[fs.FileSystem, str]:
    if "://" not in path and not path.startswith("file:"):
        return fs.LocalFileSystem(), path
    return fs.FileSystem.from_uri(path if "://" in path else path.replace("file:", "file://", 1))


@dataclass
class Written(WriterCommitMessage):
    """What one task attempt wrote: its folder and the names in it."""
    folder: str
    names: list[str] = field(default_factory=list)


class NamedFilesWriter(DataSourceArrowWriter):
    def __init__(self, path: str, overwrite: bool, hidden: str | None = None):
        """With ``hidden``, a folder's name, files may be in parts: then the
        commit only tells of them there, and :func:`join_parts` ends the write."""
        self.path, self.overwrite, self.in_parts = path.rstrip("/"), overwrite, hidden is not None
        self.hidden = f"{self.path}/{hidden or '_writing-' + uuid.uuid4().hex}"

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        task = TaskContext.get()
        files, folder = store(f"{self.hidden}/{task.partitionId()}-{task.taskAttemptId()}")
        files.create_dir(folder, recursive=True)
        done, out, name = Written(f"{task.partitionId()}-{task.taskAttemptId()}"), None, None
        seen = set()
        try:
            for batch in iterator:
                for of, line in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                    if out is None or of != name:
                        if out is not None:
                            out.close()
                        if not of or "/" in of or of in (".", ".."):
                            raise ValueError(f"{of!r} is no file name")
                        if of in seen:
                            raise ValueError(f"the lines of {of!r} do not follow each other")
                        name, out = of, files.open_output_stream(f"{folder}/{of}")
                        done.names.append(of)
                        seen.add(of)
                    if line is not None:
                        out.write(f"{line}\n".encode())
        finally:
            if out is not None:
                out.close()
        return done

    def commit(self, messages: list[Written | None]) -> None:
        parts = sorted((m for m in messages if m is not None and m.names), key=lambda m: int(m.folder.split("-")[0]))
        files, target = store(self.path)
        _, hidden = store(self.hidden)
        split = split_names(parts)
        if split is None or split and not self.in_parts:
            self.abort(messages)
            raise ValueError("the lines of a file are in several tasks; deal them out by name")
        if split:
            with files.open_output_stream(f"{hidden}/{PLAN}") as out:
                out.write(json.dumps({"split": split, "whole": [[m.folder, [n for n in m.names if n not in split]] for m in parts]}).encode())
            return
        publish(files, hidden, target, [(m.folder, m.names) for m in parts], self.overwrite)

    def abort(self, messages: list[Written | None]) -> None:
        clear(*store(self.hidden))


def split_names(parts: list[Written]) -> dict[str, list[str]] | None:
    """The names that several of ``parts``, in the order of their tasks, have,
    each with its folders; None if one does not go on from the end of a task to
    the start of the next."""
    folders: dict[str, list[str]] = {}
    for before, after in zip(parts, parts[1:]):
        if before.names[-1] == after.names[0]:
            folders.setdefault(after.names[0], [before.folder]).append(after.folder)
    names = sum(len(m.names) for m in parts) - sum(len(f) - 1 for f in folders.values())
    return folders if len({n for m in parts for n in m.names}) == names else None


def publish(files: fs.FileSystem, hidden: str, target: str, moves: list[tuple[str, list[str]]], overwrite: bool) -> None:
    """The files ``moves``, names by their folder in ``hidden``, under their names."""
    with ThreadPoolExecutor(16) as pool:
        if overwrite:
            kept = {n for _, names in moves for n in names}
            there = files.get_file_info(fs.FileSelector(target, allow_not_found=True))
            old = [f.path for f in there if f.type == fs.FileType.File and f.base_name not in kept]
            list(pool.map(files.delete_file, old))
        files.create_dir(target, recursive=True)
        some = [(folder, names[i:i + 1000]) for folder, names in moves for i in range(0, len(names), 1000)]

        def move(chunk: tuple[str, list[str]]) -> None:
            for n in chunk[1]:
                files.move(f"{hidden}/{chunk[0]}/{n}", f"{target}/{n}")

        list(pool.map(move, some))
    clear(files, hidden)


def clear(files: fs.FileSystem, hidden: str) -> None:
    if files.get_file_info(hidden).type != fs.FileType.NotFound:
        files.delete_dir(hidden)


def put(work: tuple[str, str, int | None, list[str]]) -> None:
    """Copies the files of a list, one after the other, into a file of the folder
    ``JOINED`` of ``hidden``: at a place in one that is there, or as a new one."""
    hidden, name, at, sources = work
    files, folder = store(hidden)
    target = f"{folder}/{JOINED}/{name}"
    with (files.open_output_stream(target) if at is None else open(target, "r+b")) as out:
        if at is not None:
            out.seek(at)
        for source in sources:
            with files.open_input_stream(f"{folder}/{source}/{name}") as part:
                shutil.copyfileobj(part, out, BUFFER)


def join_parts(spark: SparkSession, path: str, hidden: str, overwrite: bool) -> None:
    """Ends a write whose files are in parts, if there are any.  In a folder that
    all tasks share, each part is copied to its place by a task; other stores
    only take files from their start, so there a task copies a file's parts."""
    files, folder = store(f"{path.rstrip('/')}/{hidden}")
    _, target = store(path.rstrip("/"))
    if files.get_file_info(f"{folder}/{PLAN}").type == fs.FileType.NotFound:
        return
    try:
        with files.open_input_stream(f"{folder}/{PLAN}") as f:
            plan = json.loads(f.read())
        files.create_dir(f"{folder}/{JOINED}")
        work: list[tuple[str, str, int | None, list[str]]] = []
        for name, sources in plan["split"].items():
            if not isinstance(files, fs.LocalFileSystem):
                work.append((f"{path.rstrip('/')}/{hidden}", name, None, sources))
                continue
            at = 0
            for source in sources:
                work.append((folder, name, at, [source]))
                at += files.get_file_info(f"{folder}/{source}/{name}").size
            with open(f"{folder}/{JOINED}/{name}", "wb") as out:
                out.truncate(at)
        spark.sparkContext.parallelize(work, len(work)).foreach(put)
        publish(files, folder, target, [*((f, names) for f, names in plan["whole"]), (JOINED, list(plan["split"]))], overwrite)
    finally:
        clear(files, folder)


class NamedFiles(DataSource):
    """``df.write.format("named_text_files")`` for rows ``(name, line)``."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return "name string, line string"

    def writer(self, schema, overwrite: bool) -> NamedFilesWriter:
        return NamedFilesWriter(self.options["path"], overwrite, self.options.get("hidden"))


def write_named_files(lines: DataFrame, path: str, name: str = "file", line: str = "line", order: str = "ord", mode: str = "overwrite") -> None:
    """One file ``path/<name>`` per distinct ``name``, its lines by ``order``.

    A null line makes the file but adds nothing to it, so a file without lines
    is one such row.  ``overwrite`` leaves the files of these rows alone in the
    folder, ``append`` replaces files of the same name and keeps the others.
    The rows are dealt to a fixed number of tasks, as it is the files that take
    the time, and rows without a line take no room."""
    spark, hidden = lines.sparkSession, f"_writing-{uuid.uuid4().hex}"
    spark.dataSource.register(NamedFiles)
    rows = lines.select(F.col(name).cast("string").alias("name"), F.col(line).cast("string").alias("line"), F.col(order).alias("o"))
    ranges = rows.repartitionByRange(int(spark.conf.get("spark.sql.shuffle.partitions")), "name", "o")
    dealt = ranges.sortWithinPartitions("name", "o").select("name", "line")
    dealt.write.format(FORMAT).option("hidden", hidden).mode(mode).save(path)
    join_parts(spark, path, hidden, mode == "overwrite")
