"""Expressions over a result row: levels, flags, predicates, and legacy back-fill."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salvor.functions.text import code_points, has_text
from salvor.schema import DEFAULTS, LEGACY_OK_STATUSES, LEVEL_RANK, RESULT_TYPES, VERIFIED


def level_rank(level: Column) -> Column:
    """0 to 3; null and unknown levels are 0."""
    out = F.lit(0)
    for name, rank in LEVEL_RANK.items():
        out = F.when(level == name, rank).otherwise(out)
    return out


def quality(level: Column, target_verified: Column, text: Column) -> Column:
    """A known level's rank; else 3 if the target is verified, 1 if there is text, else 0."""
    rest = F.when(F.coalesce(target_verified, F.lit(False)), 3).when(has_text(text), 1).otherwise(0)
    return F.when(level.isin(*LEVEL_RANK), level_rank(level)).otherwise(rest)


def unverified_length(rank: Column, text: Column) -> Column:
    return F.when(rank == 1, code_points(text)).otherwise(F.lit(0).cast("long"))


def fill_level(level: Column, target_verified: Column, text: Column) -> Column:
    rest = F.when(F.coalesce(target_verified, F.lit(False)), "strict_verified").when(has_text(text), "unverified_text").otherwise("no_text")
    return F.coalesce(level, rest)


def default_pending(status: Column, text: Column) -> Column:
    return (status == "fetch_error") & ~has_text(text)


def pending(df: DataFrame) -> Column:
    """Whether a row awaits the archive: its flag where the file has one (null: no), else a fetch
    error without text."""
    if "needs_archive" in df.columns:
        return F.coalesce(F.col("needs_archive").cast("boolean"), F.lit(False))
    return F.coalesce(default_pending(F.col("scrape_status"), F.col("text")), F.lit(False))


def rewrite_status(status: Column, text: Column) -> Column:
    return F.when(has_text(text) & status.isin(*LEGACY_OK_STATUSES), "ok").otherwise(status)


def is_terminal(status: Column, level: Column, text: Column) -> Column:
    good = (status == "fetch_ok") | ((status == "ok") & level.isin(*VERIFIED) & has_text(text))
    return F.coalesce(good, F.lit(False))


def is_unverified(level: Column, target_verified: Column, text: Column) -> Column:
    known = F.when(level.isNull(), ~F.coalesce(target_verified, F.lit(False))).otherwise(level == "unverified_text")
    return has_text(text) & known


def is_control(fetch_method: Column, text: Column) -> Column:
    return F.coalesce(fetch_method == "wayback", F.lit(False)) & has_text(text)


def browser_outcome(error: Column, had_content: Column, text: Column, terminal: Column) -> Column:
    return (
        F.when(error == "playwright_hard_timeout", "hard_timeout").when(~F.coalesce(had_content, F.lit(False)), "fetch_failed")
        .when(terminal, "accepted").when(has_text(text), "unverified_text").otherwise("no_text")
    )


def backfill(df: DataFrame) -> DataFrame:
    """Columns that older files lack, with their defaults, and flags without nulls."""
    had_flag = "needs_archive" in df.columns
    for c in ("text", "target_verified", "verification_level", "scrape_status"):
        if c not in df.columns:
            df = df.withColumn(c, F.lit(None).cast(RESULT_TYPES[c]))
    text, verified = F.col("text"), F.coalesce(F.col("target_verified").cast("boolean"), F.lit(False))
    df = df.withColumn("verification_level", fill_level(F.col("verification_level"), verified, text))
    flag = F.coalesce(F.col("needs_archive").cast("boolean"), F.lit(False)) if had_flag else F.coalesce(default_pending(F.col("scrape_status"), text), F.lit(False))
    return df.withColumns({"target_verified": verified, "needs_archive": flag})


def with_text_length(df: DataFrame) -> DataFrame:
    return df if "text_length" in df.columns else df.withColumn("text_length", code_points(F.col("text")))


def from_template(story: DataFrame, overrides: dict[str, Column]) -> DataFrame:
    """Story columns, then every result column at its default, then ``overrides``."""
    defaults = {c: F.lit(DEFAULTS.get(c)).cast(t) for c, t in RESULT_TYPES.items()}
    return story.withColumns(defaults | overrides)


def between_dates(value: Column, first: str | None, last: str | None) -> Column:
    """Within [first, last], both at midnight, so later hours of the last day are out; a value
    that is no date is out."""
    stamp = F.coalesce(value.try_cast("timestamp"), F.try_to_timestamp(value.cast("string")))
    out = stamp.isNotNull()
    if first:
        out = out & (stamp >= F.to_timestamp(F.lit(first)))
    if last:
        out = out & (stamp <= F.to_timestamp(F.lit(last)))
    return F.coalesce(out, F.lit(False))
