"""Command line: merge, scrape, prepare, run, reduce, all, status, stats. One run at a time holds a
folder's lock."""

from __future__ import annotations

import argparse
import contextlib
import json
import os
import socket
import sys
import time
from collections.abc import Iterator
from datetime import UTC, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salvor.operators.metrics import outcome_stats
from salvor.operators.rows import align
from salvor.plans import archive_run, live, pipelines
from salvor.schema import FAILED_STATUSES
from salvor.sources import files

MODES = ("complete", "live-only", "archive-only")


def _gone(owner: dict, stale_s: float | None) -> bool:
    """Whether a lock's owner can't be at work: a process of this host that has ended, or a lock
    older than ``stale_s`` where that is given."""
    if owner.get("host") == socket.gethostname() and owner.get("pid"):
        try:
            os.kill(owner["pid"], 0)
        except ProcessLookupError:
            return True
        except PermissionError:
            pass
    return stale_s is not None and time.time() - owner.get("at", 0) > stale_s


@contextlib.contextmanager
def run_lock(spark: SparkSession, folder: str, stale_s: float | None = None) -> Iterator[None]:
    """Hold ``.run.lock``: its creation fails where it exists, on any file system with atomic create.
    It tells its owner and time, so that a lock that a crash left can be taken over: of this host
    once its process has ended, of another after ``stale_s`` seconds."""
    path = f"{folder}/.run.lock"
    fs, p = files._fs(spark, path)
    mine = {"host": socket.gethostname(), "pid": os.getpid(), "at": time.time()}
    for last in (False, True):
        try:
            out = fs.create(p, False)
            break
        except Exception as e:  # py4j: the file exists, or the folder can't be written
            try:
                owner = json.loads(files.read_text(spark, path))
            except Exception:  # being written or gone
                owner = {}
            if last or not owner or not _gone(owner, stale_s):
                raise pipelines.Invalid(f"{folder} is locked by {owner.get('host', 'another run')}, process {owner.get('pid')}") from e
            files.remove(spark, path)
    try:
        out.write(bytearray(json.dumps(mine).encode()))
        out.close()
        yield
    finally:
        fs.delete(p, False)


def manifest(spark: SparkSession, run_dir: str) -> dict:
    return json.loads(files.read_text(spark, f"{run_dir}/manifest.json"))


def done_shards(spark: SparkSession, run_dir: str, m: dict) -> set[int]:
    return {k for k, n in enumerate(m["shard_rows"]) if n == 0 or files.exists(spark, f"{run_dir}/results/shard={k}")}


def status(spark: SparkSession, run_dir: str) -> dict:
    """A run's manifest with its finished shards, rows saved (of open shards, those of their parts)
    and percent done."""
    m = manifest(spark, run_dir)
    done = done_shards(spark, run_dir, m)
    total, saved = sum(m["shard_rows"]), sum(m["shard_rows"][k] for k in done)
    parts = files.read_parts(spark, f"{run_dir}/parts")
    if parts is not None and len(done) < m["shard_count"]:
        saved += parts.where(~F.col("shard").isin(*done) if done else F.lit(True)).select("id").distinct().count()
    return {"run_id": m["run_id"], "status": m["status"], "done_shards": len(done), "shards": m["shard_count"], "saved_rows": saved, "total_rows": total, "percent": 100.0 * saved / total if total else 100.0}


def set_status(spark: SparkSession, run_dir: str, value: str) -> None:
    pipelines.check(value in pipelines.MANIFEST_STATES, f"unknown status {value}")
    files.write_json(spark, f"{run_dir}/manifest.json", manifest(spark, run_dir) | {"status": value})


def run_shards(spark: SparkSession, run_dir: str, answers: DataFrame, now: str, limit: int | None = None) -> dict:
    """Take the open shards' rows through the archive, as one plan over all of them.

    Rows that the parts show as done are left out; deferred ones go on from their best saved row.
    What is made is a new part, read back before it counts; shards all of whose rows stand in parts
    are then finalised, and only they get a result. ``limit`` takes so many rows, the first by id.
    """
    m = manifest(spark, run_dir)
    done = done_shards(spark, run_dir, m)
    open_ = [k for k in range(m["shard_count"]) if k not in done]
    if not open_:
        return {"rows_completed": 0}
    set_status(spark, run_dir, "running")
    queue = spark.read.parquet(f"{run_dir}/input").where(F.col("shard").isin(*open_))
    parts = files.read_parts(spark, f"{run_dir}/parts")
    todo = pipelines.resume_rows(queue, None, parts)
    todo = todo if limit is None else todo.orderBy("id").limit(limit)
    part = f"{run_dir}/parts/part_{len(files.part_files(spark, f'{run_dir}/parts')):06d}"
    files.write_table(archive_run.results(todo, answers, m["run_id"], now), part)
    made = spark.read.parquet(part)
    pipelines.unique_rows(made, "part")
    metrics = archive_run.run_metrics(made)
    saved = files.read_parts(spark, f"{run_dir}/parts").where(F.col("shard").isin(*open_)).drop("asked", "outcome")
    have = {r["shard"]: r["n"] for r in saved.groupBy("shard").agg(F.count_distinct("id").alias("n")).collect()}
    full = [k for k in open_ if have.get(k, 0) == m["shard_rows"][k]]
    if full:
        out = pipelines.finalised(saved.where(F.col("shard").isin(*full)), sum(m["shard_rows"][k] for k in full))
        concrete = align(out, queue.columns + [c for c in out.columns if c not in queue.columns])
        staging = f"{run_dir}/results.staging"
        files.remove(spark, staging)
        files.write_table(concrete, staging, by="shard")
        for k in full:
            files.make_folder(spark, f"{run_dir}/results")
            files.rename(spark, f"{staging}/shard={k}", f"{run_dir}/results/shard={k}")
    files.write_json(spark, part.replace("/parts/", "/metrics/") + ".json", metrics)
    if len(done) + len(full) == m["shard_count"]:
        set_status(spark, run_dir, "processed")
    return metrics["counts"] | {"finished_shards": len(full)}


def total_metrics(spark: SparkSession, run_dir: str) -> dict:
    """The metrics of all parts as one record: sums, and averages made again from them."""
    made = files.read_parts(spark, f"{run_dir}/parts")
    out = archive_run.run_metrics(made) | {"parts": len(files.part_files(spark, f"{run_dir}/parts"))}
    files.write_json(spark, f"{run_dir}/run_metrics.json", out)
    return out


def scrape(spark: SparkSession, folder: str, stories: DataFrame, attempts: DataFrame, run_id: str, now: str, mode: str, limit: int | None = None, fetch_only: bool = False) -> dict:
    """The live cascade of a mode over recorded attempts: new rows become a checkpoint, which is merged
    into the canonical table; then the table's completeness (in the complete mode without a limit),
    failed URLs and statistics."""
    target = f"{folder}/results.parquet"
    none = spark.createDataFrame([], "id string, text string, needs_archive boolean, scrape_status string, verification_level string, target_verified boolean")
    saved = pipelines.saved_rows(files.read_sources(spark, [target])) if files.exists(spark, target) else none
    new = (live.fetched if fetch_only else live.scrape)(stories, saved, attempts, run_id, now, mode, limit)
    files.write_table(new, f"{folder}/_ckpt_{run_id}_{now.replace(':', '')}.parquet")
    profile = pipelines.merge_outputs(spark, folder)
    results = spark.read.parquet(target)
    if mode == "complete" and limit is None and not fetch_only:
        pipelines.complete(stories, results)
    files.remove(spark, f"{folder}/failed_urls_txt")
    failed = files.write_failed_urls(results.where(F.col("scrape_status").isin(*FAILED_STATUSES)), folder)
    return profile | {"failed_urls": failed}


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="salvor")
    p.add_argument("command", choices=["merge", "scrape", "prepare", "run", "reduce", "all", "status", "stats"])
    p.add_argument("--folder", required=True)
    p.add_argument("--run-name", default="run")
    p.add_argument("--shards", type=int, default=64)
    p.add_argument("--answers", help="recorded archive answers (run, all)")
    p.add_argument("--stories", help="CSV of stories (scrape)")
    p.add_argument("--attempts", help="recorded attempts (scrape)")
    p.add_argument("--mode", choices=MODES, default="complete")
    p.add_argument("--fetch-only", action="store_true")
    p.add_argument("--limit", type=int)
    p.add_argument("--stale-lock", type=float, help="seconds after which another host's lock is taken over")
    return p


def needed(a: argparse.Namespace, *names: str) -> None:
    missing = [f"--{n}" for n in names if not getattr(a, n)]
    pipelines.check(not missing, f"{a.command} needs {', '.join(missing)}")


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> dict | None:
    a = parser().parse_args(argv)
    pipelines.check(a.shards > 0, "shards must be positive")
    pipelines.check(a.limit is None or a.limit > 0, "limit must be positive")
    pipelines.check(bool(pipelines.RUN_NAME.fullmatch(a.run_name)), f"bad run name: {a.run_name}")
    needed(a, *{"run": ["answers"], "all": ["answers"], "scrape": ["stories", "attempts"]}.get(a.command, []))
    spark = spark or SparkSession.builder.getOrCreate()
    run_dir, target, now = f"{a.folder}/runs/{a.run_name}", f"{a.folder}/results.parquet", datetime.now(UTC).isoformat()
    if a.command == "status":
        return status(spark, run_dir)
    with run_lock(spark, a.folder, a.stale_lock):
        files.recover(spark, target)
        if a.command == "merge":
            return pipelines.merge_outputs(spark, a.folder)
        if a.command == "stats":
            return outcome_stats(spark.read.parquet(target)).first().asDict()
        if a.command == "scrape":
            return scrape(spark, a.folder, files.read_stories(spark, a.stories), spark.read.parquet(a.attempts), a.run_name, now, a.mode, a.limit, a.fetch_only)
        m = pipelines.prepare_run(spark, a.folder, run_dir, a.shards, a.run_name, now) if a.command in ("prepare", "all") else manifest(spark, run_dir)
        if a.command == "prepare" or m["status"] == "completed":
            return m
        try:
            if a.command in ("run", "all"):
                out = run_shards(spark, run_dir, spark.read.parquet(a.answers), now, a.limit)
                if a.command == "run":
                    return out
            return reduce(spark, a.folder, run_dir, target)
        except pipelines.Invalid:
            raise
        except BaseException:
            set_status(spark, run_dir, "failed")
            raise


def reduce(spark: SparkSession, folder: str, run_dir: str, target: str) -> dict:
    """The shards' results into the canonical table, once all of them have one."""
    m = manifest(spark, run_dir)
    missing = sorted(set(range(m["shard_count"])) - done_shards(spark, run_dir, m))
    pipelines.check(not missing, f"shards without a result: {missing}")
    if sum(m["shard_rows"]):
        out = pipelines.reduce_run(spark, run_dir, m, spark.read.parquet(f"{run_dir}/results").drop("shard"), files.source_files(spark, folder), target)
    else:
        out = m["base"]
    if files.part_files(spark, f"{run_dir}/parts"):
        total_metrics(spark, run_dir)
    set_status(spark, run_dir, "completed")
    return out


if __name__ == "__main__":
    print(json.dumps(main(), indent=2), file=sys.stdout)
