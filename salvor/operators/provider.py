"""Provider health: rate gates, circuit breakers and live routing, over recorded attempts."""

from __future__ import annotations

from dataclasses import asdict, dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Breaker:
    """Limits of a circuit breaker. ``reset_on``: what clears the count of failures, content or
    any healthy answer. ``count_open``: whether failures count while it is open."""

    failures: int = 5
    pause_s: float = 30.0
    probe_pause_s: float = 30.0
    reset_on: str = "healthy"
    count_open: bool = True


LIVE = Breaker(5, 20.0, 60.0, "content", False)
ARCHIVE = Breaker()
EVENTS = "endpoint string, event_id long, ts double, failure boolean, content boolean, state string, consecutive int, pause_until double, openings int"


def rate_schedule(requests: DataFrame, gap_s: float, key: str, arrival: str = "arrival", tie: str = "event_id", block_s: float = 3600.0) -> DataFrame:
    """When each request may start: start_i = max(arrival_i, start_(i-1) + gap), per key.

    In closed form that is gap * i + max over j <= i of (arrival_j - gap * j). A key's requests are
    cut by arrival into blocks of ``block_s`` seconds, so that a busy key is many tasks: each block
    has its running maximum and count by its own places, and one row per block carries both over
    the blocks before.
    """
    r = requests.withColumn("__block", F.floor(F.col(arrival) / block_s))
    w = Window.partitionBy(key, "__block").orderBy(arrival, tie)
    r = r.withColumn("__i", F.row_number().over(w))
    r = r.withColumn("__run", F.max(F.col(arrival) - F.col("__i") * gap_s).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    blocks = r.groupBy(F.col(key).alias("__key"), F.col("__block").alias("__b")).agg(F.max("__i").alias("__n"), F.max("__run").alias("__top"))
    past = Window.partitionBy("__key").orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.withColumn("__before", F.coalesce(F.sum("__n").over(past), F.lit(0)))
    blocks = blocks.withColumn("__carry", F.max(F.col("__top") - F.col("__before") * gap_s).over(past))
    out = r.join(blocks, r[key].eqNullSafe(blocks["__key"]) & (r["__block"] == blocks["__b"]))
    run = F.greatest(F.col("__carry"), F.col("__run") - F.col("__before") * gap_s)
    out = out.withColumn("start", run + (F.col("__before") + F.col("__i")) * gap_s).withColumn("wait", F.col("start") - F.col(arrival))
    return out.drop("__block", "__i", "__run", "__key", "__b", "__n", "__top", "__before", "__carry")


def start() -> dict:
    return {"consecutive": 0, "pause_until": 0.0, "probe": False, "openings": 0}


def observe(s: dict, ts: float, failure: bool, content: bool, b: Breaker) -> str:
    """Advance a breaker by one outcome; returns the state in which the outcome was met: closed,
    open, or probe (the first outcome after a pause)."""
    state = "open" if ts < s["pause_until"] else "probe" if s["probe"] else "closed"
    if failure:
        if state == "probe":
            s.update(consecutive=0, pause_until=ts + b.probe_pause_s, probe=True, openings=s["openings"] + 1)
        elif state == "closed" or b.count_open:
            s["consecutive"] += 1
            if s["consecutive"] >= b.failures:
                s.update(consecutive=0, pause_until=max(s["pause_until"], ts + b.pause_s), probe=True, openings=s["openings"] + 1)
    else:
        if state == "probe":
            s["probe"] = False
        if content or b.reset_on == "healthy" or state == "probe":
            s["consecutive"] = 0
    return state


def observe_run(s: dict, ts: np.ndarray, failure: np.ndarray, content: np.ndarray, b: Breaker) -> dict[str, np.ndarray]:
    """observe() over outcomes of one endpoint in order: the state that each was met in and the
    numbers after it. Runs of healthy answers that leave a closed breaker as it is are passed over
    at once."""
    n = len(ts)
    state, after = np.full(n, "closed", dtype=object), {"consecutive": np.zeros(n, np.int32), "pause_until": np.zeros(n), "openings": np.zeros(n, np.int32)}
    stops = np.flatnonzero(failure.astype(bool))  # rows that a run of healthy answers ends at
    k = 0
    while k < n:
        if not (s["probe"] or s["consecutive"] or failure[k]) and ts[k] >= s["pause_until"]:
            at = np.searchsorted(stops, k, "right")
            end = int(stops[at]) if at < len(stops) else n
        else:
            state[k] = observe(s, ts[k], bool(failure[k]), bool(content[k]), b)
            end = k + 1
        for c, values in after.items():
            values[k:end] = s[c]
        k = end
    return {"state": state, **after}


def defer(s: dict, now: float, wait: float, most: float = 120.0, default: float = 2.0) -> None:
    """A Retry-After answer moves the pause."""
    s["pause_until"] = max(s["pause_until"], now + min(wait or default, most))


def breaker_fold(outcomes: DataFrame, breaker: Breaker = ARCHIVE) -> DataFrame:
    """The breaker of each endpoint over ``outcomes(endpoint, event_id, ts, failure, content)`` in
    order, which is sequential by definition: one task an endpoint. The state is a handful of
    numbers and rows stream through in sorted order, so an endpoint of any length needs no more
    memory than one batch. Runs of answers that leave a closed breaker as it is are passed over at
    once; only failures and what follows them are stepped through.
    """
    limits = asdict(breaker)
    names = [x.split()[0] for x in EVENTS.split(", ")]

    def run(batches):
        b, name, s = Breaker(**limits), None, start()
        for pdf in batches:
            n = len(pdf)
            endpoint, ts, failure, content = (pdf[c].to_numpy() for c in ("endpoint", "ts", "failure", "content"))
            at = np.flatnonzero(np.append(True, endpoint[1:] != endpoint[:-1])) if n else []
            parts = []
            for k, end in zip(at, [*at[1:], n], strict=True):
                if endpoint[k] != name:
                    name, s = endpoint[k], start()
                parts.append(observe_run(s, ts[k:end], failure[k:end], content[k:end], b))
            if parts:
                out = pd.DataFrame({"endpoint": endpoint, "event_id": pdf["event_id"], "ts": ts, "failure": failure, "content": content})
                yield out.assign(**{c: np.concatenate([x[c] for x in parts]) for c in parts[0]})[names]

    sorted_ = outcomes.select("endpoint", "event_id", "ts", "failure", "content").repartition("endpoint").sortWithinPartitions("endpoint", "ts", "event_id")
    return sorted_.mapInPandas(run, EVENTS)


def live_next(stage: Column, has_content: Column, terminal: Column, status: Column, mode: str = "complete") -> Column:
    """Where a live row goes after a stage: save, browser, archive, or save_pending."""
    last = "archive" if mode == "complete" else "save_pending"
    after_requests = (
        F.when(has_content & terminal, "save").when(has_content, "browser").when(status.isin(404, 410), last).otherwise("browser")
    )
    after_browser = F.when(has_content & terminal, "save").otherwise(last)
    return F.when(stage == "requests", after_requests).when(stage == "playwright", after_browser).when(terminal, "save").otherwise("save_or_defer")


def live_route(attempts: DataFrame, mode: str = "complete") -> DataFrame:
    """The methods that each row goes through, and how it ends, over ``attempts(id, method,
    has_content, terminal, status, provider_failure)``, at most one for each method."""
    cols = F.struct("has_content", "terminal", "status", "provider_failure")
    by = lambda m: F.max(F.when(F.col("method") == m, cols)).alias(m)
    wide = attempts.groupBy("id").agg(by("requests"), by("playwright"), F.max_by(cols, F.struct("terminal", "provider_failure")).alias("any"), F.max(F.when((F.col("method") == "wayback") & F.col("terminal"), 1)).alias("won"), F.max(F.when((F.col("method") == "wayback") & F.col("provider_failure"), 1)).alias("failed"))
    no = F.lit(False)

    def nxt(stage: str) -> Column:
        c = F.col(stage)
        return live_next(F.lit(stage), F.coalesce(c["has_content"], no), F.coalesce(c["terminal"], no), c["status"], mode)

    out = wide.withColumn("after_requests", nxt("requests"))
    out = out.withColumn("after_browser", F.when(F.col("after_requests") == "browser", nxt("playwright")))
    last = F.coalesce("after_browser", "after_requests")
    archive = last == "archive"
    methods = F.concat_ws(",", F.lit("requests"), F.when(F.col("after_requests") == "browser", "playwright"), F.when(archive, "wayback"))
    saved = (last == "save") | (archive & F.col("won").isNotNull())
    pending = (last == "save_pending") | (archive & F.col("won").isNull() & F.col("failed").isNotNull())
    return out.select("id", methods.alias("attempted_methods"), saved.alias("accepted"), pending.alias("needs_archive"))


def archive_tier_route(attempts: DataFrame) -> DataFrame:
    """``live_route`` of rows that enter at the archive: their wayback attempts alone."""
    a = attempts.where("method = 'wayback'").groupBy("id").agg(F.max("terminal").alias("accepted"), F.max("provider_failure").alias("failed"))
    return a.select("id", F.lit("wayback").alias("attempted_methods"), "accepted", (~F.col("accepted") & F.col("failed")).alias("needs_archive"))


REDIRECTS = 5


def redirect_outcome(hops: DataFrame, archive_host: str) -> DataFrame:
    """How a request ends over its hops ``(request_id, hop, url, status)``: the first answer that is
    no redirect, ``offsite_redirect`` at a hop to another host, ``too_many_redirects`` beyond five."""
    from salvor.functions.urls import host

    away = F.col("hop") > 0
    off = away & (host(F.col("url")) != archive_host.lower())
    end = ~F.col("status").between(300, 399)
    what = F.when(off, "offsite_redirect").when(F.col("hop") > REDIRECTS, "too_many_redirects")
    stop = F.when(off | end | (F.col("hop") > REDIRECTS), F.col("hop"))
    return hops.groupBy("request_id").agg(F.min_by(F.struct("status", what.alias("error"), "url"), stop).alias("x"), F.min(stop).alias("n_redirects")).select("request_id", "n_redirects", F.when(F.col("x.error").isNull(), F.col("x.status")).alias("status"), F.col("x.error").alias("error"))
