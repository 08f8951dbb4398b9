"""Archive look-ups: nearest captures, ordered fallback over URL variants, publishers, routing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from salvor.functions.times import timestamp_distance
from salvor.functions.traces import provider_failure, resume_stage, wayback_entries
from salvor.functions.urls import archive_variants, bare_host

MAX_REPLAYS = 2


def variants(rows: DataFrame, url: str = "url") -> DataFrame:
    """One row per archive form of each URL, with its place in the order of trial."""
    return rows.select("*", F.posexplode(archive_variants(F.col(url))).alias("variant_no", "variant"))


def first_hit(rows: DataFrame, captures: DataFrame, url: str = "url") -> DataFrame:
    """Captures (original_url, timestamp, digest, position) of the first form of each row's URL that
    has any: an equi-join on forms, then the least place by row."""
    found = variants(rows, url).join(captures, F.col("variant") == F.col("original_url"))
    first = F.min("variant_no").over(Window.partitionBy("id"))
    return found.withColumn("__first", first).where("variant_no = __first").drop("__first")


def nearest(captures: DataFrame, most: int = MAX_REPLAYS, key: str = "id") -> DataFrame:
    """Up to ``most`` captures of each row nearest to ``target``, distinct by timestamp, then by
    digest, in order of distance and then position. Each pass is a window whose rank limit is
    pushed below its exchange where it bounds the rows."""
    near = captures.withColumn("distance", timestamp_distance(F.col("timestamp"), F.col("target")))
    order = [F.col("distance"), F.col("position")]
    for name in ("timestamp", "digest"):
        own = Window.partitionBy(key, F.coalesce(F.col(name), F.concat(F.lit("none:"), F.col("position").cast("string")))).orderBy(*order)
        near = near.withColumn("__n", F.row_number().over(own)).where("__n = 1")
    rank = F.row_number().over(Window.partitionBy(key).orderBy(*order))
    return near.withColumn("replay_no", rank).where(F.col("replay_no") <= most).drop("__n")


def publisher_join(pages: DataFrame, publishers: DataFrame, url: str = "url") -> DataFrame:
    """The publisher (host, publisher) whose host is the URL's host or the longest parent domain of
    it. Host suffixes make it an equi-join, not a nested loop."""
    labels = F.split(bare_host(F.col(url)), r"\.")
    suffix = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda k: F.array_join(F.slice(labels, k, F.size(labels)), "."))
    s = pages.select("id", F.explode(suffix).alias("suffix"))
    hits = s.join(publishers, F.col("suffix") == F.col("host")).groupBy("id").agg(F.max_by(F.struct("host", "publisher"), F.length("host")).alias("x"))
    return pages.join(hits.select("id", "x.*"), "id", "left")


ROUTE = "actions array<struct<phase: string, variant: string, timestamp: string>>, terminal boolean, deferred boolean"


def gathered(rows: DataFrame, outcomes: DataFrame, page: Column | None = None, *more: str) -> DataFrame:
    """``rows`` with ``stage``, ``forms`` and their recorded ``outcomes`` as one array each; with
    ``page``, those that have one stand in a second array, so that the route moves no texts."""
    fails = provider_failure(F.col("status"), F.col("error"))
    plain = (F.col("status") == 200) & F.col("error").isNull()
    at = ["phase", "variant", "timestamp"]
    slim = F.struct(*at, "captures", "status", "error", *more, F.coalesce(plain, F.lit(False)).alias("plain"), fails.alias("fails"), F.coalesce(F.col("accepted"), F.lit(False)).alias("accepted"))
    arrays = [F.collect_list(slim).alias("outcomes")]
    if page is not None:
        arrays.append(F.collect_list(F.when(page.isNotNull(), F.struct(*at, page.alias("page")))).alias("pages"))
    known = outcomes.groupBy("id").agg(*arrays)
    stage = resume_stage(F.col("needs_archive"), wayback_entries(F.col("attempt_trace")))
    s = rows.withColumns({"stage": stage, "forms": archive_variants(F.col("url"))}).join(known, "id", "left")
    return s.withColumns({c: F.coalesce(c, F.array().cast(known.schema[c].dataType)) for c in known.columns if c != "id"})


def route(rows: DataFrame, outcomes: DataFrame) -> DataFrame:
    """Replay the archive route of each row over recorded outcomes.

    ``rows``: id, url, target, needs_archive, attempt_trace. ``outcomes``: id, phase (direct,
    availability, cdx, snapshot), variant, timestamp (asked for or, in an availability answer,
    found), captures (of an index answer), status, error, accepted. Returns id, the actions in
    order, ``terminal`` and ``deferred``.
    """
    s = routed(gathered(rows.select("id", "url", "target", "needs_archive", "attempt_trace"), outcomes))
    return s.select("id", "actions", "terminal", "deferred", (~F.col("terminal") & F.col("deferred")).alias("needs_archive"))


def routed(s: DataFrame) -> DataFrame:
    """``gathered`` rows with ``actions``, ``terminal`` and ``deferred``. The outcomes of a row (a few)
    are one array; the route is a chain of native folds: direct replay, availability by form until a
    capture, a provider failure or an answer other than 200, then the index likewise, with two
    replays in all."""

    def find(phase: str, variant: Column | None = None, stamp: Column | None = None) -> Column:
        def same(x: Column) -> Column:
            ok = x["phase"] == phase
            if variant is not None:
                ok = ok & (x["variant"] == variant)
            return ok if stamp is None else ok & (x["timestamp"] == stamp)

        return F.try_element_at(F.filter("outcomes", same), F.lit(1))

    def action(phase: str, variant: Column, stamp: Column) -> Column:
        return F.struct(F.lit(phase).alias("phase"), variant.alias("variant"), stamp.alias("timestamp"))

    none = F.lit(None).cast("string")
    empty = F.array().cast("array<struct<phase: string, variant: string, timestamp: string>>")
    yes, no = F.lit(True), F.lit(False)
    first = F.try_element_at(F.col("forms"), F.lit(1))
    go = (F.col("stage") == "direct") & first.isNotNull() & F.col("target").isNotNull()
    s = s.withColumn("d", F.when(go, find("direct")))
    s = s.withColumns({
        "terminal": go & F.coalesce(F.col("d.accepted"), no), "deferred": go & F.coalesce(F.col("d.fails"), no), "replays": F.when(go, 1).otherwise(0),
        "actions": F.when(go, F.array(action("direct", first, F.col("target")))).otherwise(empty), "seen": F.when(go & F.coalesce(F.col("d.plain"), no), F.array(F.col("d.timestamp"))).otherwise(F.array(none)),
    })

    def look_up(phase: str) -> Column:
        """Fold over the forms: asked forms, whether the provider failed, and the answer found."""
        start = F.struct(empty.alias("asked"), no.alias("failed"), no.alias("stop"), none.alias("variant"))

        def step(acc: Column, form: Column) -> Column:
            x = find(phase, form)
            hit = F.coalesce(x["timestamp"].isNotNull() if phase == "availability" else F.size(x["captures"]) > 0, no)
            bad = F.coalesce(x["fails"], no)
            nxt = F.struct(F.array_append(acc["asked"], action(phase, form, none)).alias("asked"), bad.alias("failed"), (bad | hit | ~F.coalesce(x["plain"], no)).alias("stop"), F.when(hit & ~bad, form).otherwise(none).alias("variant"))
            return F.when(acc["stop"], acc).otherwise(nxt)

        return F.aggregate("forms", start, step)

    ask = ~F.col("terminal") & F.col("stage").isin("direct", "availability")
    s = s.withColumn("a", F.when(ask, look_up("availability")))
    s = s.withColumn("stamp", F.when(F.col("a.variant").isNotNull(), find("availability", F.col("a.variant"))["timestamp"]))
    replay = F.col("stamp").isNotNull() & ~F.coalesce(F.array_contains("seen", F.col("stamp")), no)
    s = s.withColumn("r", F.when(replay, find("snapshot", stamp=F.col("stamp"))))
    s = s.withColumns({
        "terminal": F.col("terminal") | F.coalesce(F.col("r.accepted"), no),
        "deferred": F.col("deferred") | F.coalesce(F.col("a.failed"), no) | F.coalesce(F.col("r.fails"), no),
        "replays": F.col("replays") + replay.cast("int"), "seen": F.when(replay, F.array_append("seen", F.col("stamp"))).otherwise(F.col("seen")),
        "actions": F.concat("actions", F.coalesce(F.col("a.asked"), empty), F.when(replay, F.array(action("snapshot", F.col("a.variant"), F.col("stamp")))).otherwise(empty)),
    })
    ask = ~F.col("terminal") & F.col("stage").isin("direct", "availability", "cdx") & (F.col("replays") < MAX_REPLAYS)
    s = s.withColumn("c", F.when(ask, look_up("cdx")))
    got = F.when(F.col("c.variant").isNotNull(), find("cdx", F.col("c.variant"))["captures"])
    far = F.transform(got, lambda x, i: F.struct(timestamp_distance(x["timestamp"], F.col("target")).alias("far"), i.alias("i"), x["timestamp"].alias("t"), x["digest"].alias("g")))
    s = s.withColumn("deferred", F.col("deferred") | F.coalesce(F.col("c.failed"), no)).withColumn("near", F.array_sort(far))
    s = s.withColumn("actions", F.concat("actions", F.coalesce(F.col("c.asked"), empty)))
    start = F.struct("replays", "seen", F.array().cast("array<string>").alias("digests"), "actions", no.alias("terminal"), "deferred", no.alias("stop"))

    def step(acc: Column, x: Column) -> Column:
        skip = acc["stop"] | (acc["replays"] >= MAX_REPLAYS) | F.coalesce(F.array_contains(acc["seen"], x["t"]), no) | F.coalesce(F.array_contains(acc["digests"], x["g"]), no)
        r = find("snapshot", stamp=x["t"])
        won, bad = F.coalesce(r["accepted"], no), acc["deferred"] | F.coalesce(r["fails"], no)
        nxt = F.struct(
            (acc["replays"] + 1).alias("replays"), F.array_append(acc["seen"], x["t"]).alias("seen"), F.when(F.coalesce(x["g"], F.lit("")) != "", F.array_append(acc["digests"], x["g"])).otherwise(acc["digests"]).alias("digests"),
            F.array_append(acc["actions"], action("snapshot", F.col("c.variant"), x["t"])).alias("actions"), won.alias("terminal"), bad.alias("deferred"), (won | bad).alias("stop"),
        )
        return F.when(skip, acc).otherwise(nxt)

    s = s.withColumn("e", F.when(F.size("near") > 0, F.aggregate("near", start, step)))
    end = lambda c: F.coalesce(F.col(f"e.{c}"), F.col(c))
    s = s.withColumns({"actions": end("actions"), "terminal": F.col("terminal") | F.coalesce(F.col("e.terminal"), no), "deferred": end("deferred")})
    return s.drop("d", "a", "r", "c", "e", "stamp", "replays", "seen", "near")
