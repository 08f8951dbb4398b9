"""The live cascade over recorded attempts: queue, extraction, acceptance, routing, result rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salvor.functions.html import extract_page
from salvor.functions.text import has_text
from salvor.functions.traces import provider_failure, trace_entry
from salvor.operators import acceptance, queues
from salvor.operators.levels import from_template, is_unverified, level_rank, quality
from salvor.operators.provider import archive_tier_route, live_route
from salvor.operators.rows import available, relaxed_union
from salvor.plans.pipelines import merged
from salvor.schema import DEFAULTS, FETCH_METHODS, RESULT_TYPES


def best_texts(stories: DataFrame, attempts: DataFrame, publishers: dict | None = None) -> DataFrame:
    """The chosen candidate of each fetched page of ``attempts(id, method, status, error, content,
    final_url)`` by ``key`` (id and method): got, its fields, and the page's. Only 2xx answers with
    content are parsed; each row stays where it is."""
    good = attempts.where("content is not null and (status is null or status between 200 and 299)")
    p = good.join(stories.select("id", "url", "title"), "id")
    page = extract_page(F.col("content"), F.coalesce("final_url", "url"), F.col("title"), publishers, url=F.col("url"))
    p = p.select(F.concat_ws("|", "id", "method").alias("key"), page.alias("page"))
    p = p.withColumn("x", acceptance.chosen(acceptance.judged_candidates(F.col("page")))).where("x is not null")
    fields = ["extract_method", "verification_level", "verified_by"]
    return p.select("key", F.col("x.best.text").alias("got"), "x.longer", *[f"x.best.{c}" for c in fields])


SAVED = "__saved"


def jobs(stories: DataFrame, saved: DataFrame, mode: str, limit: int | None) -> DataFrame:
    """A row of the queue's story columns, ``__tier`` (0 live, 1 archive) and ``__saved``: the saved
    row of an archive job, null for live ones. Archive jobs have the columns of their saved row and
    those that it lacks of their story, which need not be in the input. Ids of ``saved`` are unique.
    """
    todo = queues.work(stories, available(saved, ["id", "needs_archive", "scrape_status", "text"]), mode, limit).select("id", F.col("tier").alias("__tier"))
    known = saved.select("*", F.struct(*saved.columns).alias(SAVED))
    known = relaxed_union(known, saved.sparkSession.createDataFrame([], "url string, title string"))
    late = known.join(todo.where("__tier = 1"), "id").drop(*RESULT_TYPES)
    own = stories.drop(*RESULT_TYPES).withColumnsRenamed({c: f"__story_{c}" for c in stories.columns if c != "id"})
    both = [c for c in late.columns if f"__story_{c}" in own.columns]
    late = late.join(own, "id", "left").withColumns({c: F.coalesce(c, f"__story_{c}") for c in both}).drop(*[f"__story_{c}" for c in both])
    late = late.withColumnsRenamed({c: c.removeprefix("__story_") for c in late.columns})
    return relaxed_union(stories.join(todo.where("__tier = 0"), "id"), late)


def scrape(stories: DataFrame, saved: DataFrame, attempts: DataFrame, run_id: str, now: str, mode: str = "complete", limit: int | None = None) -> DataFrame:
    """A result row for each row of the work queue that has attempts to show.

    The best candidate of each fetched page is its attempt's result; the route decides which
    attempts a row went through; the first accepted one wins, else the best by rank and length in
    that order. Rows of the archive tier go through their wayback attempts alone, and their saved
    row with text stands first among the tries, so that a lesser one doesn't replace it. A longer
    unverified text of an earlier try, of the accepted page, or saved is kept as the fallback; the
    reference does so for accepted rows, here no row loses it. Attempt rows of a story (three
    methods) are folded per story by one aggregate.
    """
    todo = jobs(stories, saved, mode, limit)
    tries = attempts.join(todo.select("id", "__tier"), "id").where("__tier = 0 or method = 'wayback'")
    best = best_texts(todo, tries.drop("__tier"))
    a = tries.withColumn("key", F.concat_ws("|", "id", "method")).join(best, "key", "left")
    terminal = F.coalesce(level_rank(F.col("verification_level")) >= 2, F.lit(False))
    preset = F.when(F.col("method") == "wayback", provider_failure(F.col("status"), F.col("error"), "live")).otherwise(F.lit(False))
    a = a.select("id", "__tier", "method", "status", "error", "final_url", F.col("content").isNotNull().alias("has_content"), terminal.alias("terminal"), preset.alias("provider_failure"), "got", "longer", "extract_method", "verification_level", "verified_by")
    route = live_route(a.where("__tier = 0"), mode).unionByName(archive_tier_route(a.where("__tier = 1")))
    order = F.array_position(F.array(*map(F.lit, FETCH_METHODS)), F.col("method")).cast("int")
    used = a.join(route.select("id", "attempted_methods"), "id").where(F.array_contains(F.split("attempted_methods", ","), F.col("method")))
    rank = F.when(F.col("got").isNotNull(), level_rank(F.col("verification_level"))).otherwise(-1)
    pick = F.struct(order.alias("no"), rank.alias("rank"), F.length(F.coalesce("got", F.lit(""))).alias("len"), "method", "status", "error", "final_url", "got", "longer", "extract_method", "verification_level", "verified_by")
    entry = trace_entry(method=F.col("method"), status=F.col("status"), error=F.col("error"), source_url=F.col("final_url"))
    folded = used.groupBy("id").agg(
        F.array_sort(F.collect_list(F.struct(order.alias("no"), F.to_json(entry).alias("json")))).alias("trace"),
        F.array_sort(F.collect_list(pick)).alias("tries"), F.max("has_content").alias("any_content"),
    ).join(route.withColumnsRenamed({"needs_archive": "__pending", "attempted_methods": "__methods"}), "id")
    out = todo.join(folded, "id")
    old = {c: (F.col(SAVED)[c] if c in saved.columns else F.lit(None)).cast(t) for c, t in RESULT_TYPES.items()}
    was = quality(old["verification_level"], old["target_verified"], old["text"])
    blank = {"no": F.lit(0), "rank": was, "len": F.length(old["text"]), "got": old["text"], "verification_level": old["verification_level"]}
    kinds = {x.name: x.dataType for x in out.schema["tries"].dataType.elementType}
    held = F.struct(*[blank.get(c, F.lit(None)).cast(t).alias(c) for c, t in kinds.items()])
    good = F.filter("tries", lambda t: t["rank"] >= 0)
    folds = F.concat(F.when(has_text(old["text"]), F.array(held)).otherwise(F.array().cast(out.schema["tries"].dataType)), good)
    first = F.try_element_at(F.filter(good, lambda t: t["rank"] >= 2), F.lit(1))
    out = out.withColumn("b", F.when(F.col("accepted"), first).otherwise(acceptance.best_candidate(folds)))
    kept = F.coalesce(F.col("b.no") == 0, F.lit(False))
    new = {
        "scrape_status": acceptance.live_final(F.col("b"), F.col("any_content")), "fetch_method": F.col("b.method"), "extract_method": F.col("b.extract_method"), "text": F.col("b.got"),
        "text_length": F.coalesce(F.length("b.got"), F.lit(0)).cast("long"), "final_url": F.col("b.final_url"), "http_status": F.element_at("tries", -1)["status"].cast("long"), "fetch_error": F.when(F.col("b").isNull(), F.element_at("tries", -1)["error"]),
        "verification_level": F.coalesce("b.verification_level", F.lit("no_text")), "verified_by": F.col("b.verified_by"), "target_verified": F.coalesce(F.col("b.verification_level") == "strict_verified", F.lit(False)),
        "pipeline_run_id": F.lit(run_id), "playwright_outcome": old["playwright_outcome"],
        **longer_of_page(F.col("b.longer"), F.col("b.got"), F.col("b.method")),
    }
    default = {c: F.lit(DEFAULTS.get(c)).cast(t) for c, t in RESULT_TYPES.items()}
    settled = {c: F.when(kept, old[c]).otherwise(new.get(c, default[c])) for c in RESULT_TYPES}
    rows = from_template(out, settled | {
        "needs_archive": F.col("__pending"), "attempted_methods": F.col("__methods"), "attempt_trace": F.concat(F.lit("["), F.array_join(F.transform("trace", lambda t: t["json"]), ","), F.lit("]")), "completed_at": F.lit(now),
    })
    # saved texts first, then those of the tries in their order
    texts = F.array(
        F.when(is_unverified(old["verification_level"], old["target_verified"], old["text"]), F.struct(old["text"].alias("text"), old["fetch_method"].alias("method"))),
        F.when(has_text(old["fallback_text"]), F.struct(old["fallback_text"].alias("text"), old["fallback_fetch_method"].alias("method"))),
    )
    fresh = F.transform(F.filter("tries", lambda t: t["rank"] == 1), lambda t: F.struct(t["got"].alias("text"), t["method"].alias("method")))
    rows = rows.withColumn("alt", acceptance.longest(F.filter(F.concat(texts, fresh), lambda t: t.isNotNull())))
    rows = acceptance.attach_longer(rows, F.col("alt.text"), F.col("alt.method"))
    return rows.drop("alt", "b", "tries", "trace", "any_content", "accepted", "__pending", "__methods", "__tier", SAVED)


def fetched(stories: DataFrame, saved: DataFrame, attempts: DataFrame, run_id: str, now: str, mode: str = "complete", limit: int | None = None) -> DataFrame:
    """Fetch-only mode: a row for each row of the queue that has a page, by the first method with one
    (rows of the archive tier by wayback alone), with status ``fetch_ok`` and no extraction."""
    todo = jobs(stories, saved, mode, limit)
    tries = attempts.join(todo.select("id", "__tier"), "id").where("__tier = 0 or method = 'wayback'")
    good = tries.where("content is not null and (status is null or status between 200 and 299)")
    order = F.array_position(F.array(*map(F.lit, FETCH_METHODS)), F.col("method"))
    first = good.groupBy("id").agg(F.min_by(F.struct("method", "status", "final_url", F.length("content").alias("size")), order).alias("f"))
    out = todo.join(first, "id")
    rows = from_template(out, {
        "scrape_status": F.lit("fetch_ok"), "fetch_method": F.col("f.method"), "attempted_methods": F.col("f.method"), "html_length": F.col("f.size").cast("long"),
        "http_status": F.col("f.status").cast("long"), "final_url": F.coalesce("f.final_url", "url"), "pipeline_run_id": F.lit(run_id), "completed_at": F.lit(now),
    })
    return rows.drop("f", "__tier", SAVED)


def longer_of_page(text: Column, own: Column, method: Column) -> dict[str, Column]:
    """Fallback columns from a longer unverified text of the accepted page."""
    more = F.length(text) > F.length(own)
    return {"fallback_text": F.when(more, text), "fallback_text_length": F.when(more, F.length(text).cast("long")), "fallback_fetch_method": F.when(more, method)}


def scrape_and_merge(stories: DataFrame, saved: DataFrame, attempts: DataFrame, run_id: str, now: str, mode: str = "complete") -> DataFrame:
    """New rows merged with the saved ones under the policy of the merge."""
    new = scrape(stories, saved, attempts, run_id, now, mode)
    tag = lambda df, k: df.withColumns({"__source_rank": F.lit(k), "__position": F.monotonically_increasing_id()})
    return merged([tag(relaxed_union(saved), 0), tag(new, 1)], wide=False)
