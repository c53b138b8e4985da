"""Files put together from their chunks as results arrive.

State is kept per source file: the content of every chunk so far, how many
there are to be, and whether the file has gone out.  A file is emitted once, by
the batch that brings its last chunk.  A file that waits too long for a chunk
is reported as late with the chunks it lacks, which are then requested again;
what has arrived stays, so a late file can still be completed.

State lives in the checkpoint, so a restarted query goes on where it stopped.
Waiting is measured on the event clock, whose time for a row is the start of
the batch that reads it: no row is ever behind the watermark.
The sink is Spark's file sink, which shows every batch's files once.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from tessera.operators import requests as rq
from tessera.operators.chunking import custom_id_file, custom_id_index

#: ``state`` is ``complete`` or ``late``; ``contents`` are the chunks in order.
FILE_SCHEMA = "source_file string, state string, total_chunks int, chunk_indexes array<int>, missing array<int>, contents array<string>"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class FileChunks(StatefulProcessor):
    """Chunks of one source file until the last of them is there."""

    def __init__(self, timeout_ms: int):
        self.timeout_ms = timeout_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.chunks = handle.getMapState("chunks", "chunk_index int", "content string")
        self.known = handle.getValueState("known", "total int, sent boolean")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        total, sent = self.known.get() if self.known.exists() else (None, False)
        if sent:
            return  # a chunk delivered again
        arrived: dict[int, str] = {}
        now = 0
        for batch in rows:
            now = max(now, int(batch["seen"].max().timestamp() * 1000))
            for index, content, of in zip(batch["chunk_index"], batch["content"], batch["total_chunks"]):
                if not pd.isna(of):
                    total = max(total or 0, int(of))
                if not pd.isna(index):
                    content = "" if content is None else content
                    arrived[int(index)] = max(arrived.get(int(index), content), content)
        for index, content in arrived.items():
            self.chunks.updateValue((index,), (content,))
        held = {int(k[0]): v[0] for k, v in self.chunks.iterator()}
        if total is not None and all(i in held for i in range(total)):
            self.known.update((total, True))
            self.chunks.clear()
            self.forget_timers()
            yield self.told(key, "complete", total, held)
            return
        self.known.update((total, False))
        self.forget_timers()
        self.handle.registerTimer(now + self.timeout_ms)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        total, sent = self.known.get()
        if not sent:
            yield self.told(key, "late", total, {int(k[0]): v[0] for k, v in self.chunks.iterator()})

    def forget_timers(self) -> None:
        for at in list(self.handle.listTimers()):
            self.handle.deleteTimer(at)

    @staticmethod
    def told(key, state: str, total: int | None, held: dict[int, str]) -> pd.DataFrame:
        order = sorted(held)
        missing = [i for i in range(total or 0) if i not in held]
        return pd.DataFrame({"source_file": [key[0]], "state": [state], "total_chunks": pd.array([total], dtype="Int32"),
                             "chunk_indexes": [order], "missing": [missing], "contents": [[held[i] for i in order]]})


def files_of_results(results: DataFrame, totals: DataFrame, timeout_ms: int = 24 * 3600 * 1000) -> DataFrame:
    """Stream of :data:`FILE_SCHEMA` rows of a stream of result records.

    ``totals`` (``source_file, total_chunks``) is a table of the files that were
    requested.  Failed results bring no chunk.  Of a chunk that arrives several
    times before its file is complete the latest batch's content counts, and in
    one batch the largest; what arrives after that changes nothing.  A chunk of
    a file that is not in ``totals`` waits.  A file is late when a batch runs
    ``timeout_ms`` or more after that of its last new chunk."""
    ok, _ = rq.split_results(results)
    chunks = ok.select(custom_id_file(F.col("custom_id")).alias("source_file"), custom_id_index(F.col("custom_id")).cast("int").alias("chunk_index"),
                       rq.result_content(F.col("response")).alias("content"))
    sizes = totals.select("source_file", F.col("total_chunks").cast("int").alias("total_chunks"))
    known = (chunks.where(F.col("source_file").isNotNull()).withColumn("seen", F.current_timestamp())
             .withWatermark("seen", "0 seconds").join(sizes, "source_file", "left"))
    return known.groupBy("source_file").transformWithStateInPandas(
        FileChunks(timeout_ms), outputStructType=FILE_SCHEMA, outputMode="Append", timeMode="EventTime")


def ingest_files(results: DataFrame, totals: DataFrame, out_dir: str, checkpoint_dir: str, timeout_ms: int = 24 * 3600 * 1000) -> None:
    """Run :func:`files_of_results` over what has landed, adding to the
    Parquet table ``out_dir``; a later call goes on from the checkpoint.

    The state store is set on the session, where the query takes it from, and
    set back after."""
    conf, name = results.sparkSession.conf, "spark.sql.streaming.stateStore.providerClass"
    before = conf.get(name, None)
    conf.set(name, ROCKSDB)
    try:
        query = (files_of_results(results, totals, timeout_ms).writeStream.format("parquet").outputMode("append")
                 .option("path", out_dir).option("checkpointLocation", checkpoint_dir).trigger(availableNow=True).start())
        query.awaitTermination()
    finally:
        conf.set(name, before) if before is not None else conf.unset(name)


def complete_files(files: DataFrame) -> DataFrame:
    """``source_file, total_chunks, chunk_indexes, tokens`` of complete files."""
    tokens = F.flatten(F.transform("contents", rq.parse_translation))
    return files.where("state = 'complete'").select("source_file", "total_chunks", "chunk_indexes", tokens.alias("tokens"))


def late_chunks(files: DataFrame) -> DataFrame:
    """``source_file, chunk_index`` to request again: the chunks that a late
    file lacked when it was last reported, unless it is complete by now."""
    done = files.where("state = 'complete'").select("source_file")
    late = files.where("state = 'late'").join(done, "source_file", "left_anti")
    fewest = late.groupBy("source_file").agg(F.min_by("missing", F.size("missing")).alias("missing"))
    return fewest.select("source_file", F.explode("missing").alias("chunk_index"))
