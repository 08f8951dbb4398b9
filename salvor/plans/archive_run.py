"""The archive run over recorded answers: route, extraction, acceptance, result rows and counters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salvor.functions.html import META, extract_page
from salvor.functions.text import append_method, has_text
from salvor.functions.times import publication_timestamp
from salvor.functions.traces import append_trace, provider_failure, trace_entry
from salvor.functions.urls import capture_timestamp
from salvor.operators import acceptance, archive
from salvor.operators.levels import quality
from salvor.operators.metrics import histogram
from salvor.operators.rows import relaxed_union
from salvor.schema import DEFAULTS, RESULT_TYPES

VERSION = "1"
#: Columns that recorded answers have besides id and phase; what a table lacks is null.
ANSWER = (
    "variant string, timestamp string, captures array<struct<timestamp: string, original_url: string, digest: string>>, "
    "status int, error string, content string, final_url string, seconds double, retry_count int"
)
REPLAYS = ("direct", "snapshot")
PAGE_FIELDS = ("canonical_url", "source_article_url", "structured_url", "structured_title", "fundus_publisher", *META)
OUTCOMES = ("rows_completed", "rows_recovered", "rows_deferred", "rows_unverified", "rows_no_text", "terminal_acceptances")


def judged_answers(rows: DataFrame, answers: DataFrame, publishers: dict | None = None) -> DataFrame:
    """Answers of ``rows`` with ``accepted`` and ``page``: what the chosen candidate of a replayed
    page and the page itself give a result row. Only replays answered 2xx with content that aren't
    the provider's failure are parsed; each once."""
    empty = answers.sparkSession.createDataFrame([], f"id string, phase string, {ANSWER}")
    a = relaxed_union(answers, empty).join(rows.select("id", F.col("url").alias("__url"), F.col("title").alias("__title")), "id")
    good = F.col("phase").isin(*REPLAYS) & F.col("status").between(200, 299) & (F.length("content") > 0) & ~provider_failure(F.col("status"), F.col("error"))
    base = F.coalesce("variant", "__url")
    x = extract_page(F.when(good, F.col("content")), base, F.col("__title"), publishers, url=F.col("__url"))
    a = a.withColumns({"__good": F.coalesce(good, F.lit(False)), "__x": x})
    a = a.withColumn("__best", F.when(F.col("__good"), acceptance.chosen(acceptance.judged_candidates(F.col("__x")))))
    best = F.col("__best.best")
    fields = {
        "text": best["text"], "longer": F.col("__best.longer"), "extract_method": best["extract_method"], "verification_level": best["verification_level"], "verified_by": best["verified_by"],
        "final_url": base, "capture_time": capture_timestamp(F.col("final_url")), "http_status": F.col("status").cast("long"), "html_length": F.length("content").cast("long"),
        **{c: F.col("__x")[c] for c in PAGE_FIELDS},
    }
    page = F.struct(*[v.alias(k) for k, v in fields.items()])
    accepted = F.coalesce(best["verification_level"].isin("page_verified", "strict_verified"), F.lit(False))
    return a.withColumns({"page": F.when(has_text(best["text"]), page), "accepted": accepted}).drop("__good", "__x", "__best", "__url", "__title", "content")


def results(rows: DataFrame, answers: DataFrame, run_id: str, now: str, publishers: dict | None = None) -> DataFrame:
    """The result row of each row of the archive queue, with ``outcome`` (recovered, deferred,
    unverified, no_text, or passed for a row that no stage is left for) and ``asked``: the answers
    that its route met.

    The route goes on from the first stage that the row's trace doesn't show as done. The accepted
    replay is the result; without one, the best of the row and its replays by quality, and length
    among unverified texts, earlier ones first in ties. The longest unverified text of all of them
    is kept as the fallback. A row stays pending if the provider failed, or if its route leads to
    an answer that wasn't recorded, which tells nothing about the page. The answers of a row meet
    in one aggregate; all else happens within rows. Ids of ``rows`` are unique.
    """
    kinds = {**RESULT_TYPES, "url": "string", "title": "string", "publish_date": "string"}
    base = rows.withColumns({c: F.lit(DEFAULTS.get(c)).cast(t) for c, t in kinds.items() if c not in rows.columns})
    base = base.withColumn("target", publication_timestamp(F.col("publish_date")))
    a = judged_answers(base, answers, publishers)
    s = archive.routed(archive.gathered(base, a, F.col("page"), "seconds", "retry_count", "final_url"))

    def answer(action: Column, where: str = "outcomes") -> Column:
        """The recorded answer that an action met."""
        same = lambda x: (x["phase"] == action["phase"]) & F.when(action["phase"] == "direct", True).when(action["phase"] == "snapshot", x["timestamp"] == action["timestamp"]).otherwise(x["variant"] == action["variant"])
        return F.try_element_at(F.filter(where, same), F.lit(1))

    met = F.transform("actions", lambda act: answer(act))
    s = s.withColumn("__met", met).withColumn("__lost", F.exists("__met", lambda x: x.isNull()))
    s = s.withColumn("asked", F.filter("__met", lambda x: x.isNotNull()))

    def entry(x: Column) -> Column:
        replay = x["phase"].isin(*REPLAYS)
        stamp = F.when(replay, capture_timestamp(x["final_url"])).when(x["phase"] == "availability", x["timestamp"])
        return trace_entry(method=F.lit("wayback"), phase=x["phase"], variant=F.when(~replay, x["variant"]), status=x["status"], error=x["error"], source_url=F.when(replay, x["final_url"]), capture_time=stamp)

    pages = F.filter(F.transform("actions", lambda act: answer(act, "pages")["page"]), lambda p: p.isNotNull())
    s = s.withColumn("__pages", pages)
    rank = lambda p: quality(p["verification_level"], F.lit(None).cast("boolean"), p["text"])
    held = F.struct(quality(F.col("verification_level"), F.col("target_verified"), F.col("text")).alias("rank"), F.length(F.coalesce("text", F.lit(""))).alias("len"), F.lit(-1).alias("at"))
    tries = F.transform("__pages", lambda p, k: F.struct(rank(p).alias("rank"), F.length(p["text"]).alias("len"), k.alias("at")))
    best = acceptance.best_candidate(F.concat(F.array(held), tries))["at"]
    won = F.array_position(F.transform("__pages", lambda p: p["verification_level"].isin("page_verified", "strict_verified")), True) - 1
    s = s.withColumn("__win", F.when(F.col("terminal"), won).otherwise(best).cast("int"))
    s = s.withColumn("__w", F.when(F.col("__win") >= 0, F.get("__pages", F.col("__win"))))
    w, moved = F.col("__w"), F.col("__w").isNotNull()
    more = F.length(w["longer"]) > F.length(w["text"])
    new = {
        "scrape_status": F.lit("ok"), "fetch_method": F.lit("wayback"), "text_length": F.length(w["text"]).cast("long"), "target_verified": w["verification_level"] == "strict_verified",
        **{c: w[c] for c in ("text", "extract_method", "verification_level", "verified_by", "final_url", "capture_time", "http_status", "html_length", *PAGE_FIELDS)},
        "fallback_text": F.when(more, w["longer"]), "fallback_text_length": F.when(more, F.length(w["longer"]).cast("long")), "fallback_fetch_method": F.when(more, "wayback"),
    }
    own = F.struct("text", "fetch_method", "verification_level", "target_verified")
    saved = F.struct(F.col("fallback_text").alias("text"), F.col("fallback_fetch_method").alias("fetch_method"), F.lit("unverified_text").alias("verification_level"), F.lit(False).alias("target_verified"))
    replay = lambda text, lv: lambda p: F.struct(p[text].alias("text"), F.lit("wayback").alias("fetch_method"), (p[lv] if lv else F.lit("unverified_text")).alias("verification_level"), F.lit(False).alias("target_verified"))
    s = s.withColumn("__texts", F.concat(F.array(own), F.transform("__pages", replay("text", "verification_level")), F.array(saved), F.transform("__pages", replay("longer", None))))
    pending = ~F.col("terminal") & (F.col("deferred") | F.col("__lost"))
    s = s.withColumns({
        "__pending": pending, "__done": F.col("stage") == "done", "attempted_methods": append_method(F.col("attempted_methods"), "wayback"),
        "attempt_trace": append_trace(F.col("attempt_trace"), F.transform("asked", entry)),
    })
    keep = {"needs_archive": F.col("__pending"), "attempted_methods": F.col("attempted_methods"), "attempt_trace": F.col("attempt_trace"), "playwright_outcome": F.col("playwright_outcome"), "pipeline_version": F.lit(VERSION), "pipeline_run_id": F.lit(run_id), "completed_at": F.lit(now)}
    settled = {c: F.when(moved, new.get(c, F.lit(DEFAULTS.get(c))).cast(t)).otherwise(F.col(c)) for c, t in RESULT_TYPES.items()}
    s = s.withColumns({c: keep.get(c, settled[c]) for c in RESULT_TYPES})
    s = acceptance.preserve_longest(s, F.col("__texts"))
    outcome = F.when(F.col("__done"), "passed").when(F.col("terminal"), "recovered").when(F.col("__pending"), "deferred").when(has_text(F.col("text")), "unverified").otherwise("no_text")
    s = s.withColumns({"outcome": outcome, "asked": F.transform("asked", lambda x: F.struct(*[x[c].alias(c) for c in ("phase", "status", "error", "seconds", "retry_count")]))})
    plain = [c for c in base.columns if c != "target" and (c in rows.columns or c in RESULT_TYPES)]
    return s.select(*[F.col(f"`{c}`") for c in plain], "outcome", "asked")


def counters(done: DataFrame) -> DataFrame:
    """The run's row counters over ``results``."""
    is_ = lambda *names: F.count_if(F.col("outcome").isin(*names))
    values = (F.count(F.lit(1)), is_("recovered"), is_("deferred"), is_("unverified"), is_("no_text"), is_("recovered"))
    return done.agg(*[v.cast("long").alias(n) for n, v in zip(OUTCOMES, values, strict=True)])


def http_totals(done: DataFrame) -> DataFrame:
    """Answers by phase over ``results``: requests, retries, HTTP attempts, seconds, and the counts of
    statuses and of errors as maps."""
    a = done.select(F.explode("asked").alias("a")).select(F.col("a.phase").alias("kind"), "a.status", "a.error", F.coalesce("a.seconds", F.lit(0.0)).alias("seconds"), F.coalesce("a.retry_count", F.lit(0)).alias("retry_count"))
    base = a.groupBy("kind").agg(F.count(F.lit(1)).alias("logical_requests"), F.sum("retry_count").cast("long").alias("retries"), F.sum(F.lit(1) + F.col("retry_count")).cast("long").alias("http_attempts"), F.sum("seconds").alias("seconds"))
    for name, column in (("statuses", "status"), ("errors", "error")):
        base = base.join(histogram(a, ["kind"], F.col(column)).withColumnRenamed("counts", name), "kind", "left")
    return base


def run_metrics(done: DataFrame) -> dict:
    """Counters, HTTP totals and averages of a run as one record, made again from the sums."""
    counts = counters(done).first().asDict()
    http = {r["kind"]: {c: r[c] for c in r.asDict() if c != "kind"} for r in http_totals(done).collect()}
    requests, seconds = (sum(h[c] for h in http.values()) for c in ("logical_requests", "seconds"))
    rows = counts["rows_completed"]
    return {"counts": counts, "http": http, "average_http_seconds": seconds / requests if requests else 0.0, "average_seconds_per_completed_row": seconds / rows if rows else 0.0}
