"""Composite plans: merge, freeze, shard, resume, finalise, reduce, country map, summary. Each
validates what it made before it is put in place."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from salvor.functions.text import has_text
from salvor.operators.acceptance import preserve_longest
from salvor.operators.levels import backfill, quality, rewrite_status, unverified_length, with_text_length
from salvor.operators.metrics import ambiguous_sources, outcome_stats, outcome_stats_by_country, recovered_by_method
from salvor.operators.queues import completed_ids, unfinished
from salvor.operators.rows import align, available, by_policy, lookup, profile, relaxed_union, shard, upsert, without_legacy
from salvor.schema import COUNTRIES, RESULT_TYPES
from salvor.sources import files

MANIFEST_STATES = ("prepared", "running", "processed", "completed", "failed", "interrupted")
FALLBACK = ("fallback_text", "fallback_text_length", "fallback_fetch_method")
RUN_NAME = re.compile(r"[A-Za-z0-9][A-Za-z0-9._-]*")


class Invalid(ValueError):
    """A table or run that breaks an invariant."""


def check(ok: bool, what: str) -> None:
    if not ok:
        raise Invalid(what)


def unique_rows(df: DataFrame, what: str, expected: int | None = None) -> dict:
    """Profile of a table whose ids must be unique (and as many as expected)."""
    p = profile(relaxed_union(df, df.sparkSession.createDataFrame([], "id string, text string, needs_archive boolean, fetch_method string"))).first().asDict()
    check(p["n_rows"] == p["n_ids"], f"{what}: {p['n_rows']} rows, {p['n_ids']} ids")
    check(expected is None or p["n_rows"] == expected, f"{what}: {p['n_rows']} rows, {expected} expected")
    return p


def validated(profile_: DataFrame, what: str, expected: Column | None = None) -> DataFrame:
    """A profile that fails as it is read where ids aren't unique or rows aren't as many as expected:
    the check is part of the plan, which runs once."""
    same = F.col("n_rows") == (F.col("n_ids") if expected is None else expected)
    ok = (F.col("n_rows") == F.col("n_ids")) & same
    return profile_.where(F.assert_true(ok, F.concat(F.lit(f"{what}: "), F.col("n_rows").cast("string"), F.lit(" rows, "), F.col("n_ids").cast("string"), F.lit(" ids"))).isNull())


def merged(sources: list[DataFrame], wide: bool = True) -> DataFrame:
    """Canonical and checkpoints into one row per id: text first, then the later source. ``wide``:
    sources are stored tables, and winners are found by their keys (see ``keep_last_wide``)."""
    both = relaxed_union(*sources)
    if "text" not in both.columns:
        both = both.withColumn("text", F.lit(None).cast("string"))
    both = both.withColumn("__has_text", has_text(F.col("text")))
    out = backfill(by_policy(both, "text_then_rank", "__position", wide=wide))
    return without_legacy(out.withColumn("scrape_status", rewrite_status(F.col("scrape_status"), F.col("text"))))


def saved_rows(sources: list[DataFrame]) -> DataFrame:
    """One saved row per id to go on from: that of the later source, then the later row."""
    return by_policy(relaxed_union(*sources), "resume_last", "__position", wide=True)


def frozen(sources: list[DataFrame], wide: bool = True) -> DataFrame:
    """The immutable base: best quality, then longest unverified text, then recency. ``wide`` as in
    ``merged``."""
    both = backfill_keeping_null_level(relaxed_union(*sources))
    q = quality(F.col("verification_level"), F.col("target_verified"), F.col("text"))
    both = both.withColumn("__quality", q)
    both = both.withColumn("__unverified_length", unverified_length(F.col("__quality"), F.col("text")))
    return backfill(by_policy(both, "quality_then_recency", "__position", wide=wide))


def backfill_keeping_null_level(df: DataFrame) -> DataFrame:
    for c in ("text", "target_verified", "verification_level"):
        if c not in df.columns:
            df = df.withColumn(c, F.lit(None).cast(RESULT_TYPES[c]))
    return df


def merge_outputs(spark: SparkSession, folder: str, canonical: str = "results.parquet") -> dict | None:
    """Merge a folder's checkpoints into its canonical table; None where there are none."""
    paths = files.source_files(spark, folder, canonical)
    target, staging = f"{folder}/{canonical}", f"{folder}/.{canonical}.staging"
    checkpoints = [p for p in paths if p != target]
    if not checkpoints:
        return None
    files.remove(spark, staging)
    files.write_table(merged(files.read_sources(spark, paths)), staging)
    p = unique_rows(spark.read.parquet(staging), "merge")
    files.commit(spark, staging, target)
    for c in checkpoints:
        files.remove(spark, c)
    return p


def freeze_base(spark: SparkSession, paths: list[str], base: str) -> dict:
    """Write the base snapshot and return its profile and fingerprint. No text may be lost that the
    canonical table had."""
    sources = files.read_sources(spark, paths)
    files.write_table(frozen(sources), base)
    df = spark.read.parquet(base)
    p = unique_rows(df, "freeze")
    had = sources[0].where(has_text(F.col("text"))).select("id").distinct().count() if "text" in sources[0].columns else 0
    check(p["n_text"] >= had, f"freeze: {p['n_text']} texts, {had} before")
    return p | {"fingerprint": files.fingerprint(df)}


def write_input_shards(base: DataFrame, path: str, shards: int) -> list[int]:
    """The pending queue, one folder and file per shard; returns the rows of each shard."""
    queue = base.where(F.coalesce(F.col("needs_archive"), F.lit(False))).withColumn("shard", shard(F.col("id"), shards))
    files.write_table(queue, path, by="shard")
    expected = queue.count()
    counts = {r["shard"]: r["n"] for r in base.sparkSession.read.parquet(path).groupBy("shard").agg(F.count(F.lit(1)).alias("n")).collect()} if expected else {}
    out = [counts.get(k, 0) for k in range(shards)]
    check(sum(out) == expected, "shards do not sum to the queue")
    return out


def prepare_run(spark: SparkSession, folder: str, run_dir: str, shards: int, run_id: str, now: str, version: str = "1") -> dict:
    """Freeze and shard once; a second call with the same shard count reuses a base whose
    fingerprint still holds."""
    import json

    check(bool(RUN_NAME.fullmatch(run_id)), f"bad run name: {run_id}")
    manifest = f"{run_dir}/manifest.json"
    if files.exists(spark, manifest):
        m = json.loads(files.read_text(spark, manifest))
        check(m["shard_count"] == shards, "the run has another shard count")
        check(files.fingerprint(spark.read.parquet(f"{run_dir}/base.parquet")) == m["base"]["fingerprint"], "the base has changed")
        return m
    paths = files.source_files(spark, folder)
    base = freeze_base(spark, paths, f"{run_dir}/base.parquet")
    rows = write_input_shards(spark.read.parquet(f"{run_dir}/base.parquet"), f"{run_dir}/input", shards)
    m = {"run_id": run_id, "pipeline_version": version, "status": "prepared", "created_at": now, "output_dir": folder, "shard_count": shards, "shard_rows": rows, "base": base, "sources": files.source_snapshot(spark, paths)}
    files.write_json(spark, manifest, m)
    return m


def resume_rows(rows: DataFrame, result: DataFrame | None, parts: DataFrame | None) -> DataFrame:
    """Rows of a shard still to do, each replaced by its best saved deferred row where that is at
    least as good. The longest unverified text of the two, saved fallbacks included, is kept as the
    fallback where it is longer than the winner's text."""
    from salvor.operators.rows import best_deferred

    todo = unfinished(rows, completed_ids(result, parts))
    if parts is None or result is not None:
        return todo
    q = lambda p="": quality(F.col(f"{p}verification_level"), F.col(f"{p}target_verified"), F.col(f"{p}text"))
    held = parts.where(F.coalesce(F.col("needs_archive"), F.lit(False)))
    extra = [c for c in ("fetch_method", *FALLBACK) if c not in todo.columns]
    todo = todo.withColumns({c: F.lit(None).cast(RESULT_TYPES[c]) for c in extra})
    best = align(best_deferred(held, q()), todo.columns, {c: RESULT_TYPES[c] for c in ("fetch_method", *FALLBACK)})
    both = todo.join(best.select("id", F.struct(*best.columns).alias("p")), "id", "left")
    longer = F.length(F.coalesce("p.text", F.lit(""))) >= F.length(F.coalesce("text", F.lit("")))
    take = F.col("p").isNotNull() & ((q("p.") > q()) | ((q("p.") == q()) & longer))

    def one(text: str, method: str, level: Column, verified: Column) -> Column:
        return F.struct(F.col(text).alias("text"), F.col(method).alias("fetch_method"), level.alias("verification_level"), verified.alias("target_verified"))

    own = [one(f"{p}text", f"{p}fetch_method", F.col(f"{p}verification_level"), F.col(f"{p}target_verified")) for p in ("", "p.")]
    saved = [one(f"{p}fallback_text", f"{p}fallback_fetch_method", F.lit("unverified_text"), F.lit(False)) for p in ("", "p.")]
    won = both.select("id", *[F.when(take, F.col(f"p.{c}")).otherwise(F.col(c)).alias(c) for c in todo.columns if c != "id"], F.array(*own, *saved).alias("__texts"))
    return preserve_longest(won, F.col("__texts")).drop("__texts", *(c for c in extra if c == "fetch_method"))


def finalised(parts: DataFrame, expected: int) -> DataFrame:
    """One row per id of a shard's parts, the latest by part and row."""
    out = by_policy(parts, "part_order_last", "__pos")
    unique_rows(out, "shard", expected)
    return out


def reduce_run(spark: SparkSession, run_dir: str, manifest: dict, delta: DataFrame, paths: list[str], target: str) -> dict:
    """Base and results of all shards into the canonical table, once nothing has changed since the
    run was prepared and nothing is lost."""
    base = spark.read.parquet(f"{run_dir}/base.parquet")
    check(files.fingerprint(base) == manifest["base"]["fingerprint"], "the base has changed")
    check(files.source_snapshot(spark, paths) == manifest["sources"], "sources have changed since preparation")
    unique_rows(delta, "delta", sum(manifest["shard_rows"]))
    staging = f"{target}.staging"
    files.remove(spark, staging)
    files.write_table(upsert(base, delta), staging)
    p = unique_rows(spark.read.parquet(staging), "reduce", manifest["base"]["n_rows"])
    check(p["n_text"] >= manifest["base"]["n_text"], "texts were lost")
    files.commit(spark, staging, target)
    return p


def country_by_id(stories: DataFrame, dimension: DataFrame) -> DataFrame:
    """(id, country) of every story. A source has one country, every story has one, and countries
    are of the fixed domain: one pass over the join counts what breaks either rule."""
    check(ambiguous_sources(dimension).isEmpty(), "a source maps to several countries")
    one = dimension.na.drop(subset=["country", "source_name"]).dropDuplicates(["source_name"])
    out = lookup(stories, one, ("media_name", "source_name"), "country", "country").select("id", "country")
    bad = out.agg(F.count_if(F.col("country").isNull()).alias("none"), F.count_if(~F.col("country").isin(*COUNTRIES)).alias("other")).first()
    check(not bad["none"], f"{bad['none']} stories have no country")
    check(not bad["other"], f"{bad['other']} stories have a country outside the domain")
    return out


SUMMARY = ["id", "scrape_status", "fetch_method", "target_verified", "text_length", "text"]


def summary(results: DataFrame) -> DataFrame:
    """Summary mode reads six columns, so 'verified' counts target_verified alone."""
    return outcome_stats(with_text_length(available(results, SUMMARY)))


def statistics(results: DataFrame, countries: DataFrame, n_input: int) -> str:
    """The text report."""
    named = results.join(countries, "id", "left")
    return files.report(outcome_stats(results).first().asDict(), [r.asDict() for r in outcome_stats_by_country(named).collect()], [r.asDict() for r in recovered_by_method(results).collect()], n_input)


def complete(stories: DataFrame, results: DataFrame) -> None:
    """Every story must have a result."""
    check(stories.select("id").join(results.select("id"), "id", "left_anti").isEmpty(), "stories without a result")


def nothing_lost(before: DataFrame, after: DataFrame) -> None:
    """A run over a copy of the table may lose neither ids nor texts."""
    check(before.select("id").join(after.select("id"), "id", "left_anti").isEmpty(), "ids were lost")
    texts = before.where(has_text(F.col("text"))).select("id")
    check(texts.join(after.where(has_text(F.col("text"))).select("id"), "id", "left_anti").isEmpty(), "texts were lost")
