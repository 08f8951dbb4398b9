"""Work queues by anti and semi joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salvor.operators.levels import pending
from salvor.operators.rows import relaxed_union, two_tier_limit


def live_queue(stories: DataFrame, saved: DataFrame) -> DataFrame:
    """Stories without a saved row."""
    return stories.join(saved.select("id"), "id", "left_anti")


def archive_queue(stories: DataFrame, saved: DataFrame) -> DataFrame:
    """Saved rows of these stories that await the archive; the filter is below the join."""
    return saved.where(pending(saved)).join(stories.select("id"), "id", "left_semi")


def pending_scan(saved: DataFrame) -> DataFrame:
    """Archive-only mode: every pending row, whether or not its story is in the input."""
    return saved.where(pending(saved))


def work(stories: DataFrame, saved: DataFrame, mode: str = "complete", limit: int | None = None) -> DataFrame:
    """The queue of a mode (complete, live-only, archive-only), with ``tier`` 0 for live rows and
    1 for archive rows; a limit takes live rows first."""
    none = saved.where(F.lit(False))
    live = stories.where(F.lit(False)) if mode == "archive-only" else live_queue(stories, saved)
    archive = none if mode == "live-only" else pending_scan(saved) if mode == "archive-only" else archive_queue(stories, saved)
    if limit is not None:
        return two_tier_limit(live, archive, limit, "id")
    return relaxed_union(live.withColumn("tier", F.lit(0)), archive.withColumn("tier", F.lit(1)))


def completed_ids(result: DataFrame | None, parts: DataFrame | None) -> DataFrame | None:
    """Ids that a shard needs no more: those of its result, else of parts that aren't deferred."""
    if result is not None:
        return result.select(F.col("id").cast("string").alias("id")).distinct()
    if parts is not None:
        return parts.where(~pending(parts)).select(F.col("id").cast("string").alias("id")).distinct()
    return None


def unfinished(rows: DataFrame, done: DataFrame | None) -> DataFrame:
    return rows if done is None else rows.join(done, "id", "left_anti")
