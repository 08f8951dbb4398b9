"""Outcome statistics and run metrics: one aggregate each, partial before its exchange."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from salvor.functions.text import contains_any_case
from salvor.functions.times import ratio
from salvor.schema import COUNTRIES, FETCH_METHODS, SHORT_TEXT

OUTCOMES = ("final", "recovered", "verified", "strict_verified", "page_verified", "unverified_text", "no_text", "short_text", "fetch_error", "extract_error", "exception")


def outcome_columns(columns: list[str]) -> list[Column]:
    """Counts of outcomes. Without verification_level the verified count falls back to
    target_verified, and the levels are 0; without either it is 0."""
    status = F.col("scrape_status")
    is_ = lambda c: F.count_if(F.coalesce(c, F.lit(False)))
    zero = F.lit(0).cast("long")
    level = F.coalesce(F.col("verification_level"), F.lit("no_text")) if "verification_level" in columns else None
    at = lambda name: zero if level is None else is_(level == name)
    if level is not None:
        verified = is_(level.isin("strict_verified", "page_verified"))
    else:
        verified = is_(F.col("target_verified").cast("boolean")) if "target_verified" in columns else zero
    short = is_((status == "ok") & (F.col("text_length").try_cast("double") < SHORT_TEXT)) if "text_length" in columns else zero
    values = (
        F.count(F.lit(1)), is_(status == "ok"), verified, at("strict_verified"), at("page_verified"), at("unverified_text"), at("no_text"), short,
        is_(status == "fetch_error"), is_(status == "extract_error"), is_(status == "exception"),
    )
    return [v.cast("long").alias(n) for n, v in zip(OUTCOMES, values, strict=True)]


def domain(df: DataFrame, name: str, values: tuple[str, ...]) -> DataFrame:
    """A fixed domain as a column, made in the JVM."""
    return df.sparkSession.range(1).select(F.explode(F.array(*map(F.lit, values))).alias(name))


def outcome_stats(results: DataFrame) -> DataFrame:
    return results.agg(*outcome_columns(results.columns))


def outcome_stats_by_country(results: DataFrame) -> DataFrame:
    """Overall and per country in one pass (grouping sets); a country of the fixed domain without
    rows stays, with zeros."""
    cols = outcome_columns(results.columns)
    sets = results.groupingSets([["country"], []], "country").agg(F.grouping("country").alias("__all"), *cols)
    named = sets.where((F.col("__all") == 1) | F.col("country").isin(*COUNTRIES)).withColumn("scope", F.when(F.col("__all") == 1, "overall").otherwise(F.col("country")))
    every = domain(results, "scope", ("overall", *COUNTRIES))
    out = every.join(named.drop("country", "__all"), "scope", "left")
    return out.select("scope", *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in OUTCOMES])


def recovered_by_method(results: DataFrame) -> DataFrame:
    """Rows with recovered text by final method, zero-filled over the known methods."""
    n = results.where("scrape_status = 'ok'").groupBy("fetch_method").agg(F.count(F.lit(1)).alias("n"))
    every = domain(results, "fetch_method", FETCH_METHODS)
    return every.join(n, "fetch_method", "left").select("fetch_method", F.coalesce("n", F.lit(0)).cast("long").alias("n_recovered"))


def value_counts(df: DataFrame, column: str, missing: str | None = None) -> DataFrame:
    """Rows by value; null is a value, or ``missing``."""
    value = F.col(column) if missing is None else F.coalesce(F.col(column), F.lit(missing))
    return df.groupBy(value.alias(column)).agg(F.count(F.lit(1)).alias("n_rows"))


def ambiguous_sources(dimension: DataFrame) -> DataFrame:
    """Sources that map to several countries, which must not be looked up."""
    d = dimension.na.drop(subset=["country", "source_name"])
    return d.groupBy("source_name").agg(F.count_distinct("country").alias("n_countries")).where("n_countries > 1")


def duplicate_keys(df: DataFrame, key: str = "id") -> DataFrame:
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("n_rows")).where("n_rows > 1")


def method_metrics(attempts: DataFrame, by: list[str]) -> DataFrame:
    """Attempts, successes, terminal acceptances, retries and seconds for each method."""
    out = attempts.groupBy(*by).agg(
        F.count(F.lit(1)).alias("attempts"), F.count_if("success").alias("successes"), F.count_if("terminal").alias("terminal_acceptances"),
        F.sum("retry_count").cast("long").alias("retries"), F.sum("seconds").alias("seconds"),
    )
    return out.withColumn("avg_seconds", ratio(F.col("seconds"), F.col("attempts")))


def histogram(df: DataFrame, by: list[str], value: Column) -> DataFrame:
    """A map of counts by value for each group, merged in two steps, null left out."""
    n = df.where(value.isNotNull()).groupBy(*by, value.cast("string").alias("__v")).agg(F.count(F.lit(1)).alias("__n"))
    return n.groupBy(*by).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("__v", "__n")))).alias("counts"))


def http_counters(attempts: DataFrame) -> DataFrame:
    """By kind: logical requests, HTTP attempts with retries, statuses and errors as text maps."""
    base = attempts.groupBy("kind").agg(F.count(F.lit(1)).alias("logical_requests"), F.sum("retry_count").cast("long").alias("retries"), F.sum(F.lit(1) + F.col("retry_count")).cast("long").alias("http_attempts"))
    text = lambda c: F.array_join(F.transform(F.map_entries("counts"), lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("string"))), ",").alias(c)
    statuses = histogram(attempts, ["kind"], F.col("status")).select("kind", text("statuses"))
    errors = histogram(attempts, ["kind"], F.col("error")).select("kind", text("errors"))
    return base.join(statuses, "kind", "left").join(errors, "kind", "left")


def merge_counters(*metrics: DataFrame, by: list[str], sums: list[str]) -> DataFrame:
    """Totals of earlier snapshots and new counts: a sum, so any split into parts gives the same. An
    average isn't summed but made again from its sums (``with_averages``)."""
    from salvor.operators.rows import relaxed_union

    return relaxed_union(*metrics).groupBy(*by).agg(*[F.sum(c).alias(c) for c in sums])


def with_averages(totals: DataFrame, averages: dict[str, tuple[str, str]]) -> DataFrame:
    """``totals`` with averages of summed columns: name to (sum, count); 0 where the count is."""
    return totals.withColumns({name: ratio(F.col(a), F.col(n)) for name, (a, n) in averages.items()})


def endpoint_telemetry(attempts: DataFrame) -> DataFrame:
    """By endpoint: attempts, successes (2xx without error), time-outs, errors, mean seconds."""
    ok = F.col("status").between(200, 299) & F.col("error").isNull()
    return attempts.groupBy("endpoint").agg(
        F.count(F.lit(1)).alias("attempts"), F.count_if(ok).alias("successes"), F.count_if(contains_any_case(F.col("error"), "timeout")).alias("timeouts"),
        F.count_if(F.col("error").isNotNull()).alias("errors"), F.avg("seconds").alias("mean_seconds"),
    )


def heartbeat(attempts: DataFrame, every: str = "60 seconds", least: int = 10, rate: float = 0.2) -> DataFrame:
    """Attempts and time-outs by endpoint and tumbling window, the change from the window before,
    and an alarm from ``least`` attempts and a time-out share of ``rate`` on."""
    late = contains_any_case(F.col("error"), "timeout")
    beat = attempts.groupBy("endpoint", F.window("ts", every).alias("w")).agg(F.count(F.lit(1)).alias("attempts"), F.count_if(late).alias("timeouts"))
    order = Window.partitionBy("endpoint").orderBy("w.start")
    out = beat.withColumn("delta", F.col("attempts") - F.coalesce(F.lag("attempts").over(order), F.lit(0)))
    alarm = (F.col("attempts") >= least) & (F.col("timeouts") >= rate * F.col("attempts"))
    return out.select("endpoint", F.col("w.start").alias("window_start"), "attempts", "timeouts", "delta", alarm.alias("alarm"))


def nearest_rank(rows: DataFrame, by: str, value: str, percents: dict[str, float]) -> DataFrame:
    """Nearest-rank percentiles of ``value`` for each group, null without one: counts by distinct value
    with a map-side part, then running sums over them. No group's values are held in memory."""
    n = rows.where(F.col(value).isNotNull()).groupBy(by, value).agg(F.count(F.lit(1)).alias("__n"))
    upto = F.sum("__n").over(Window.partitionBy(by).orderBy(value).rowsBetween(Window.unboundedPreceding, 0))
    share = upto / F.sum("__n").over(Window.partitionBy(by))
    n = n.withColumn("__share", share)
    return n.groupBy(by).agg(*[F.min(F.when(F.col("__share") >= p, F.col(value))).cast("double").alias(c) for c, p in percents.items()])


def strategy_summary(rows: DataFrame) -> DataFrame:
    """By strategy: rows, captures, terminals, requests, mean and nearest-rank percentiles of
    seconds, requests per terminal (null without one)."""
    out = rows.groupBy("strategy").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_if("capture").alias("captures"), F.count_if("terminal").alias("terminals"), F.sum("requests").cast("long").alias("requests"), F.avg("seconds").alias("mean_seconds"),
    )
    out = out.join(nearest_rank(rows, "strategy", "seconds", {"p50": 0.5, "p90": 0.9, "p95": 0.95}), "strategy", "left")
    return out.withColumn("requests_per_terminal", ratio(F.col("requests"), F.col("terminals"), None))


def strategy_rows(rows: DataFrame) -> DataFrame:
    """Rows of a strategy table in the order of its file: by id, then strategy."""
    return rows.orderBy("id", "strategy")


def throughput(metrics: DataFrame) -> DataFrame:
    return metrics.withColumns({"rows_per_second": ratio(F.col("n_rows"), F.col("seconds"), None), "requests_per_second": ratio(F.col("requests"), F.col("seconds"), None)})


def probe_summary(results: DataFrame) -> DataFrame:
    """Of a probe's results: terminal ones, controls that kept their text, rows still pending."""
    from salvor.functions.text import has_text
    from salvor.operators.levels import is_terminal, pending

    done = is_terminal(F.col("scrape_status"), F.col("verification_level"), F.col("text"))
    kept = (F.col("sample_group") == "control") & has_text(F.col("text"))
    return results.agg(F.count_if(done).alias("terminal_results"), F.count_if(kept).alias("control_text_preserved"), F.count_if(pending(results)).alias("still_pending"))


def progress(done: DataFrame, partial: DataFrame, total: int) -> DataFrame:
    """Saved rows (finished shards and parts of the others) and percent complete."""
    from salvor.functions.times import percent_complete

    n = done.select("id").unionByName(partial.select("id")).distinct().agg(F.count(F.lit(1)).alias("saved_rows"))
    return n.withColumn("percent", percent_complete(F.col("saved_rows"), F.lit(total)))
