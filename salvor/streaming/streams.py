"""Structured Streaming counterparts: upserts by micro-batch, keyed breakers, heartbeats."""

from __future__ import annotations

import tempfile
from collections import deque
from collections.abc import Callable, Iterator
from dataclasses import asdict

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from salvor.functions.text import contains_any_case
from salvor.operators.provider import ARCHIVE, EVENTS, Breaker, observe_run, start
from salvor.operators.rows import keep_last, relaxed_union
from salvor.sources import files


def source(spark: SparkSession, path: str, schema, files_a_batch: int = 1) -> DataFrame:
    """Parquet files as they arrive; the number of files a batch is the back-pressure."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_a_batch).parquet(path)


BUCKETS = 32


def versions(spark: SparkSession, target: str) -> dict[int, list[int]]:
    """The versions that each bucket of an upserted table has, ascending."""
    fs, p = files._fs(spark, f"{target}/v=*/bucket=*")
    out: dict[int, list[int]] = {}
    for s in fs.globStatus(p) or []:
        path = s.getPath()
        out.setdefault(int(path.getName().removeprefix("bucket=")), []).append(int(path.getParent().getName().removeprefix("v=")))
    return {k: sorted(v) for k, v in out.items()}


def newest(spark: SparkSession, target: str, below: int | None = None, only: set[int] | None = None) -> DataFrame | None:
    """The newest version of each bucket (of a batch before ``below``) as one table, or None."""
    have = {k: [v for v in vs if below is None or v < below] for k, vs in versions(spark, target).items() if only is None or k in only}
    paths = [f"{target}/v={vs[-1]}/bucket={k}" for k, vs in sorted(have.items()) if vs]
    return spark.read.parquet(*paths) if paths else None


def upsert_batch(target: str, key: str, order: list[str], buckets: int = BUCKETS) -> Callable[[DataFrame, int], None]:
    """A foreachBatch function: later rows by ``order`` replace saved ones.

    The table is dealt by a hash of ``key`` into buckets, and a batch rewrites those alone that it
    has rows for. A bucket's versions are folders by batch number: a batch that is run again reads
    what was there before it and writes the same folders, and what a reader has open stays whole,
    as the version before the newest is kept.
    """

    def run(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        rows = batch.withColumn("bucket", F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")).persist()
        try:
            touched = {r["bucket"] for r in rows.select("bucket").distinct().collect()}
            saved = newest(spark, target, number, touched) if touched else None
            new = rows.drop("bucket")
            out = keep_last(new if saved is None else relaxed_union(saved, new), key, order)
            out = out.withColumn("bucket", F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int"))
            out.repartition("bucket").write.mode("overwrite").option("compression", "zstd").partitionBy("bucket").parquet(f"{target}/v={number}")
        finally:
            rows.unpersist()
        for k, vs in versions(spark, target).items():
            for v in [v for v in vs if v < number][:-1] if k in touched else []:
                files.remove(spark, f"{target}/v={v}/bucket={k}")

    return run


def run_upsert(stream: DataFrame, target: str, checkpoint: str, key: str, order: list[str]) -> DataFrame:
    """Run the stream over what is there, then return the newest version of the table."""
    flush(stream, upsert_batch(target, key, order), checkpoint).awaitTermination()
    return newest(stream.sparkSession, target)


def flush(stream: DataFrame, batch: Callable[[DataFrame, int], None], checkpoint: str, seconds: float | None = None, mode: str = "append") -> StreamingQuery:
    """Start a stream whose batches are flushed by size or age: the source's files a trigger bound a
    batch, and with ``seconds`` one begins that often while the query runs; without, batches follow
    each other until what is there has been read."""
    w = stream.writeStream.outputMode(mode).foreachBatch(batch).option("checkpointLocation", checkpoint)
    return (w.trigger(availableNow=True) if seconds is None else w.trigger(processingTime=f"{seconds} seconds")).start()


class ProgressLog(StreamingQueryListener):
    """Progress events of the session's streams, kept newest last and passed to ``emit``: what was
    started, the number, rows and time of each batch, and how it ended."""

    def __init__(self, emit: Callable[[dict], None] | None = None, most: int = 10_000):
        self.events: deque[dict] = deque(maxlen=most)
        self.emit = emit

    def _add(self, **event) -> None:
        self.events.append(event)
        if self.emit:
            self.emit(event)

    def onQueryStarted(self, event) -> None:
        self._add(kind="started", query=str(event.id), at=event.timestamp)

    def onQueryProgress(self, event) -> None:
        p = event.progress
        self._add(kind="progress", query=str(p.id), batch=p.batchId, rows=p.numInputRows, at=p.timestamp, milliseconds=p.batchDuration)

    def onQueryIdle(self, event) -> None:
        self._add(kind="idle", query=str(event.id), at=event.timestamp)

    def onQueryTerminated(self, event) -> None:
        self._add(kind="ended", query=str(event.id), error=event.exception)


def append_parts(path: str, expected_unique: str = "id") -> Callable[[DataFrame, int], None]:
    """A foreachBatch function that writes a part per batch and reads it back: rows and unique ids
    must agree."""

    def run(batch: DataFrame, number: int) -> None:
        part = f"{path}/part_{number:06d}"
        batch.write.mode("overwrite").option("compression", "zstd").parquet(part)
        n = batch.sparkSession.read.parquet(part).agg(F.count(F.lit(1)).alias("n"), F.count_distinct(expected_unique).alias("u")).first()
        if n["n"] != n["u"]:
            raise ValueError(f"{part}: {n['n']} rows, {n['u']} ids")

    return run


#: An outcome as it is sorted; an event without id (not ``known``) comes last of its time.
OUTCOME = np.dtype([("ts", "f8"), ("event_id", "i8"), ("known", "?"), ("failure", "?"), ("content", "?")])
#: Outcomes of an endpoint that are held in memory at once, and those handed on at once.
HELD, CHUNK = 1 << 20, 10_000


def _sorted(parts: list[np.ndarray]) -> np.ndarray:
    rows = np.concatenate(parts)
    return rows[np.lexsort((rows["event_id"], rows["ts"]))]


def in_order(frames: Iterator[pd.DataFrame], held: int) -> Iterator[np.ndarray]:
    """The outcomes of one endpoint by time and id, in blocks: beyond ``held`` rows, sorted runs go to
    a temporary file and are merged, so that no batch needs more memory."""
    parts, n, runs, last = [], 0, [], np.iinfo(np.int64).max
    with tempfile.TemporaryFile() as file:

        def spill() -> None:
            rows = _sorted(parts)
            runs.append((file.tell(), file.tell() + rows.nbytes))
            file.write(rows.tobytes())

        for f in frames:
            part = np.empty(len(f), OUTCOME)
            part["ts"], part["known"], part["event_id"] = f["ts"], f["event_id"].notna(), f["event_id"].astype("Int64").fillna(last)
            part["failure"], part["content"] = f["failure"].to_numpy().astype(bool), f["content"].to_numpy().astype(bool)
            parts.append(part)
            n += len(part)
            if n >= held:
                spill()
                parts, n = [], 0
        if not runs:
            yield from [_sorted(parts)] if parts else []
            return
        if parts:
            spill()
            parts = []
        left, blocks = dict(enumerate(runs)), {}
        size = max(1, held // len(runs)) * OUTCOME.itemsize
        while left or blocks:
            for k, (at, end) in list(left.items()):
                if k not in blocks:
                    file.seek(at)
                    blocks[k] = np.frombuffer(file.read(min(size, end - at)), OUTCOME)
                    left[k] = (at + blocks[k].nbytes, end)
                    if left[k][0] == end:
                        del left[k]
            ends = np.array([blocks[k][-1] for k in left], OUTCOME)  # what is still to be read comes after these
            edge = ends[np.lexsort((ends["event_id"], ends["ts"]))[0]] if left else None
            taken = []
            for k, rows in list(blocks.items()):
                cut = len(rows)
                if edge is not None:
                    low, high = (int(np.searchsorted(rows["ts"], edge["ts"], side)) for side in ("left", "right"))
                    cut = low + int(np.searchsorted(rows["event_id"][low:high], edge["event_id"], "right"))
                taken.append(rows[:cut])
                blocks[k] = rows[cut:]
                if not len(blocks[k]):
                    del blocks[k]
            yield _sorted(taken)


def breaker_stream(events: DataFrame, breaker: Breaker = ARCHIVE, idle_ms: int | None = None) -> DataFrame:
    """The breaker of each endpoint as keyed state. Rows of a batch are taken in order of time, and
    those of an endpoint need no more memory than HELD of them, however large the batch is.
    ``idle_ms`` ends a state after so long without rows; leave it out for runs that should end
    when the input does, as waiting for a time-out keeps a query alive."""
    limits = asdict(breaker)
    columns = [x.split()[0] for x in EVENTS.split(", ")]

    def run(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        b = Breaker(**limits)
        names = ("consecutive", "pause_until", "probe", "openings")
        s = dict(zip(names, state.get, strict=True)) if state.exists else start()
        for rows in in_order(frames, HELD):
            for k in range(0, len(rows), CHUNK):
                r = rows[k : k + CHUNK]
                ids = pd.Series(r["event_id"], dtype="Int64").where(r["known"])
                out = pd.DataFrame({"endpoint": key[0], "event_id": ids, "ts": r["ts"], "failure": r["failure"], "content": r["content"]})
                yield out.assign(**observe_run(s, r["ts"], r["failure"], r["content"], b))[columns]
        state.update((int(s["consecutive"]), float(s["pause_until"]), bool(s["probe"]), int(s["openings"])))
        if idle_ms is not None:
            state.setTimeoutDuration(idle_ms)

    return events.groupBy("endpoint").applyInPandasWithState(run, EVENTS, "consecutive int, pause_until double, probe boolean, openings int", "append", GroupStateTimeout.NoTimeout if idle_ms is None else GroupStateTimeout.ProcessingTimeTimeout)


def heartbeat_stream(attempts: DataFrame, every: str = "60 seconds", late: str = "10 minutes", least: int = 10, rate: float = 0.2) -> DataFrame:
    """Attempts, time-outs and alarm by endpoint and window; the watermark bounds the state."""
    slow = contains_any_case(F.col("error"), "timeout")
    beat = attempts.withWatermark("ts", late).groupBy("endpoint", F.window("ts", every).alias("w")).agg(F.count(F.lit(1)).alias("attempts"), F.count_if(slow).alias("timeouts"))
    alarm = (F.col("attempts") >= least) & (F.col("timeouts") >= rate * F.col("attempts"))
    return beat.select("endpoint", F.col("w.start").alias("window_start"), "attempts", "timeouts", alarm.alias("alarm"))


def run_heartbeat(beats: DataFrame, target: str, checkpoint: str) -> DataFrame:
    """Run a heartbeat stream in update mode over what is there. A window is written again whenever
    it changes; the newest row of each endpoint and window is the beat."""
    numbered = lambda batch, number: batch.withColumn("batch", F.lit(number))
    save = upsert_batch(target, "beat", ["batch"])

    def run(batch: DataFrame, number: int) -> None:
        save(numbered(batch, number).withColumn("beat", F.to_json(F.struct("endpoint", "window_start"))), number)

    flush(beats, run, checkpoint, mode="update").awaitTermination()
    out = newest(beats.sparkSession, target)
    return (out if out is not None else beats.sparkSession.createDataFrame([], beats.schema)).select(*beats.columns)
