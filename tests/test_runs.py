"""The archive run, the command line, streams over several batches, and sinks."""

import json
import os
import subprocess
import sys
import time

import pytest
from pyspark.sql import functions as F
from test_operators import SAVED, row

from salvor.functions import traces
from salvor.operators import metrics, provider, rows
from salvor.plans import archive_run, cli, live, pipelines
from salvor.schema import RESULT_TYPES
from salvor.sources import files
from salvor.streaming import streams

PAGE = '<html><head><title>Title {k}</title><link rel="canonical" href="{u}"></head><body><article><h1>Title {k}</h1><p>Body of {k}.</p></article></body></html>'
QUEUE = "id string, url string, title string, publish_date string, needs_archive boolean, attempt_trace string, text string, verification_level string, target_verified boolean, fetch_method string, attempted_methods string, fallback_text string, fallback_text_length long, fallback_fetch_method string"
ANSWERS = "id string, phase string, variant string, timestamp string, captures array<struct<timestamp: string, original_url: string, digest: string>>, status int, error string, content string, final_url string, seconds double, retry_count int"


def queue(spark, *ids, **more):
    """Pending rows of these ids; ``more``: column to values by id."""
    one = lambda k: (k, f"https://e.de/{k}", f"Title {k}", "2020-01-02", True, None, None, "no_text", False, None, "requests", None, None, None)
    names = [c.split()[0] for c in QUEUE.split(", ")]
    data = [tuple(more[c][k] if k in more.get(c, ()) else v for c, v in zip(names, one(k), strict=True)) for k in ids]
    return spark.createDataFrame(data, QUEUE)


def answer(k, phase, variant=None, stamp=None, captures=None, status=200, error=None, content=None):
    shown = f"http://archive/web/{stamp or '20200103000000'}id_/{variant}" if phase in ("direct", "snapshot") else None
    return (k, phase, variant, stamp, captures, status, error, content, shown, 0.5, 1 if error else 0)


def full_archive(keys: list[str]):
    """The deterministic archive by sum of the URL's bytes mod 4 (0, 1: direct; 2: index; 3: nothing)."""
    out, ends = [], {}
    for k in keys:
        u = f"https://e.de/{k}"
        key, forms, page = sum(u.encode()) % 4, [u, u.replace("https", "http")], PAGE.format(k=k, u=u)
        out.append(answer(k, "direct", u, status=200 if key < 2 else 404, content=page if key < 2 else None))
        out += [answer(k, "availability", f) for f in forms]
        out += [answer(k, "cdx", f, captures=[("20190101000000", f, "d")] if key == 2 else []) for f in forms]
        out.append(answer(k, "snapshot", u, "20190101000000", content=page))
        ends[k] = key
    return out, ends


def test_end_states_of_the_deterministic_archive(spark):
    keys = [str(k) for k in range(24)]
    out, ends = full_archive(keys)
    got = {r["id"]: r for r in archive_run.results(queue(spark, *keys), spark.createDataFrame(out, ANSWERS), "r", "now").collect()}
    assert set(ends.values()) == {0, 1, 2, 3} and len(got) == 24
    for k, key in ends.items():
        r = got[k]
        assert not r["needs_archive"] and r["attempted_methods"] == "requests,wayback" and r["pipeline_run_id"] == "r"
        phases = [e["phase"] for e in json.loads(r["attempt_trace"])]
        if key == 3:
            assert (r["outcome"], r["text"], r["verification_level"]) == ("no_text", None, "no_text") and phases == ["direct", "availability", "availability", "cdx", "cdx"]
        else:
            assert r["outcome"] == "recovered" and r["verification_level"] == "strict_verified" and f"Body of {k}." in r["text"] and r["fetch_method"] == "wayback" and r["canonical_url"].endswith(f"/{k}")
            assert phases == (["direct"] if key < 2 else ["direct", "availability", "availability", "cdx", "snapshot"]) and r["target_verified"] and r["http_status"] == 200
            assert r["capture_time"] == ("20200103000000" if key < 2 else "20190101000000")


def test_failures_defer_and_texts_are_kept(spark):
    u = lambda k: f"https://e.de/{k}"
    a = PAGE.format(k="x", u="http://other.de/")
    out = [
        answer("a", "direct", u("a"), status=503, error=None), *[answer("a", "availability", f) for f in (u("a"), "http://e.de/a")], *[answer("a", "cdx", f, captures=[]) for f in (u("a"), "http://e.de/a")],
        answer("b", "direct", u("b"), content=a), answer("b", "availability", u("b"), status=500),
        answer("c", "availability", u("c"), stamp="20200505000000"), answer("c", "snapshot", u("c"), "20200505000000", content=PAGE.format(k="c", u=u("c"))),
        answer("d", "direct", u("d"), content=a), *[answer("d", "availability", f) for f in (u("d"), "http://e.de/d")], *[answer("d", "cdx", f, captures=[]) for f in (u("d"), "http://e.de/d")],
        answer("f", "direct", u("f"), status=404),
        answer("g", "direct", u("g"), content=a, error="ReadTimeout", status=None),
    ]
    past = json.dumps([{"method": "wayback", "phase": "direct", "status": 404}])
    done = json.dumps([{"method": "wayback", "phase": p, "status": 200} for p in ("direct", "availability", "cdx")])
    saved = {"text": {"b": "saved " * 100, "d": "s"}, "verification_level": {"b": "unverified_text", "d": "unverified_text"}, "fetch_method": {"b": "requests", "d": "requests"}, "attempt_trace": {"c": past, "e": done, "h": "[broken"}, "fallback_text": {"d": "f" * 500}, "fallback_text_length": {"d": 500}, "fallback_fetch_method": {"d": "playwright"}, "publish_date": {"h": None}}
    frame = archive_run.results(queue(spark, *"abcdefgh", **saved), spark.createDataFrame(out, ANSWERS), "r", "now").persist()
    got = {r["id"]: r for r in frame.collect()}
    assert got["a"]["outcome"] == "deferred" and got["a"]["needs_archive"] and got["a"]["text"] is None and len(json.loads(got["a"]["attempt_trace"])) == 5
    assert got["b"]["outcome"] == "deferred" and got["b"]["text"] == "saved " * 100 and got["b"]["fetch_method"] == "requests"  # longer than the replay's
    assert got["c"]["outcome"] == "recovered" and [e["phase"] for e in json.loads(got["c"]["attempt_trace"])] == ["direct", "availability", "snapshot"]
    assert got["d"]["outcome"] == "unverified" and "Body of x." in got["d"]["text"] and not got["d"]["needs_archive"] and (got["d"]["fallback_text_length"], got["d"]["fallback_fetch_method"]) == (500, "playwright")
    assert got["e"]["outcome"] == "passed" and not got["e"]["needs_archive"] and got["e"]["attempted_methods"] == "requests,wayback" and len(json.loads(got["e"]["attempt_trace"])) == 3
    assert got["f"]["outcome"] == "deferred"  # the look-up after its direct replay was not recorded
    assert got["g"]["outcome"] == "deferred" and got["g"]["text"] is None
    assert got["h"]["outcome"] == "deferred" and json.loads(got["h"]["attempt_trace"]) == []
    assert archive_run.counters(frame).first().asDict() == {"rows_completed": 8, "rows_recovered": 1, "rows_deferred": 5, "rows_unverified": 1, "rows_no_text": 0, "terminal_acceptances": 1}
    http = {r["kind"]: r for r in archive_run.http_totals(frame).collect()}
    assert http["direct"]["logical_requests"] == 5 and http["direct"]["errors"] == {"ReadTimeout": 1} and http["direct"]["http_attempts"] == 6 and http["availability"]["statuses"] == {"200": 5, "500": 1}
    frame.unpersist()
    none = archive_run.results(queue(spark, *"a").limit(0), spark.createDataFrame([], ANSWERS), "r", "now").persist()
    assert none.count() == 0 and archive_run.run_metrics(none)["average_http_seconds"] == 0.0


def test_run_of_shards_resumes(spark, tmp_path):
    d, keys = f"file://{tmp_path}", [str(k) for k in range(20)]
    saved = queue(spark, *keys, "kept").withColumns({"scrape_status": F.lit("fetch_error"), "needs_archive": F.col("id") != "kept", "text": F.when(F.col("id") == "kept", "kept text")})
    files.write_table(saved, f"{d}/results.parquet")
    out, ends = full_archive(keys)
    bad = [x for k in keys for x in [answer(k, "direct", f"https://e.de/{k}", status=503)]]
    spark.createDataFrame([x for x in bad if int(x[0]) >= 10] + [x for x in out if int(x[0]) < 10], ANSWERS).write.parquet(f"{d}/first")
    spark.createDataFrame(out, ANSWERS).write.parquet(f"{d}/second")
    run = lambda *a: cli.main([*a, "--folder", d, "--shards", "2"], spark)
    m = run("prepare")
    assert sum(m["shard_rows"]) == 20
    with pytest.raises(pipelines.Invalid):
        run("run")  # no answers given
    got = run("run", "--answers", f"{d}/first", "--limit", "7")
    assert got["rows_completed"] == 7 and got["finished_shards"] == 0
    s = run("status")
    assert s["saved_rows"] == 7 and s["percent"] == 35.0 and s["done_shards"] == 0 and s["status"] == "running"
    run("run", "--answers", f"{d}/second")
    s = run("status")
    assert s["percent"] == 100.0 and s["done_shards"] == 2 and s["status"] == "processed"
    assert run("run", "--answers", f"{d}/second") == {"rows_completed": 0}
    assert run("reduce", "--answers", f"{d}/second")["n_rows"] == 21
    final = {r["id"]: r for r in spark.read.parquet(f"{d}/results.parquet").collect()}
    assert final["kept"]["text"] == "kept text" and all((final[k]["text"] is None) == (ends[k] == 3) and not final[k]["needs_archive"] for k in keys)
    assert "asked" not in spark.read.parquet(f"{d}/results.parquet").columns
    total = json.loads(files.read_text(spark, f"{d}/runs/run/run_metrics.json"))
    assert total["parts"] == 2 and total["counts"]["rows_completed"] == 7 + len(keys) - sum(1 for r in keys if r in sorted(keys)[:7] and int(r) < 10)
    assert run("run", "--answers", f"{d}/second")["status"] == "completed"


def test_scrape_command_by_mode(spark, tmp_path):
    d = f"file://{tmp_path}"
    spark.createDataFrame([(str(k), f"http://e.de/{k}", "2020-01-01", f"Title {k}") for k in range(3)], "id string, url string, publish_date string, title string").coalesce(1).write.option("header", True).csv(f"{d}/stories")
    ok = lambda k, m: (str(k), m, 200, None, PAGE.format(k=k, u=f"http://e.de/{k}"), f"http://e.de/{k}")
    spark.createDataFrame([ok(0, "requests"), ("1", "requests", 404, "http_404", None, None), ("1", "wayback", 404, None, None, None), ok(2, "playwright"), ("2", "requests", 500, "http_500", None, None)], "id string, method string, status int, error string, content string, final_url string").write.parquet(f"{d}/attempts")
    run = lambda *a: cli.main(["scrape", "--folder", f"{d}/out", "--stories", f"{d}/stories", "--attempts", f"{d}/attempts", *a], spark)
    assert run("--mode", "live-only")["n_rows"] == 3
    got = {r["id"]: r for r in spark.read.parquet(f"{d}/out/results.parquet").collect()}
    assert got["0"]["verification_level"] == "strict_verified" and got["1"]["needs_archive"] and got["2"]["fetch_method"] == "playwright"
    out = run("--mode", "archive-only")
    got = {r["id"]: r for r in spark.read.parquet(f"{d}/out/results.parquet").collect()}
    assert out["n_rows"] == 3 and not got["1"]["needs_archive"] and got["1"]["attempted_methods"] == "wayback" and out["failed_urls"] == 1
    assert files.read_text(spark, f"{d}/out/failed_urls_txt/header.txt") == "# failed URLs: 1\n"
    assert [json.loads(r["value"]) for r in spark.read.text(f"{d}/out/failed_urls_json").collect()] == [["http://e.de/1"]]


def test_fetch_only(spark):
    stories = spark.createDataFrame([("1", "http://e.de/1", "T"), ("2", "http://e.de/2", "T")], "id string, url string, title string")
    tries = spark.createDataFrame([("1", "playwright", 200, None, "<p>x</p>", None), ("1", "requests", 404, None, None, None), ("2", "requests", 500, None, "<p>", None)], "id string, method string, status int, error string, content string, final_url string")
    (r,) = live.fetched(stories, spark.createDataFrame([], SAVED), tries, "r", "now").collect()
    assert (r["id"], r["scrape_status"], r["fetch_method"], r["html_length"], r["final_url"], r["text"]) == ("1", "fetch_ok", "playwright", 8, "http://e.de/1", None)


def test_a_lock_is_taken_over_once_its_owner_is_gone(spark, tmp_path):
    d = f"file://{tmp_path}"
    ended = subprocess.Popen([sys.executable, "-c", ""])
    ended.wait()
    import socket

    held = {"host": socket.gethostname(), "pid": os.getpid(), "at": time.time() - 100}
    files.write_json(spark, f"{d}/.run.lock", held)
    with pytest.raises(pipelines.Invalid, match=str(os.getpid())), cli.run_lock(spark, d):
        pass
    with cli.run_lock(spark, d, stale_s=50):
        assert json.loads(files.read_text(spark, f"{d}/.run.lock"))["at"] > held["at"]
    assert not files.exists(spark, f"{d}/.run.lock")
    files.write_json(spark, f"{d}/.run.lock", held | {"pid": ended.pid})
    with cli.run_lock(spark, d):
        pass
    files.write_json(spark, f"{d}/.run.lock", {"host": "elsewhere", "pid": 1, "at": time.time()})
    with pytest.raises(pipelines.Invalid), cli.run_lock(spark, d, stale_s=50):
        pass


def test_streams_over_several_batches(spark, tmp_path):
    d, schema = f"file://{tmp_path}", "id string, n long, note string"
    log = streams.ProgressLog()
    spark.streams.addListener(log)
    try:
        for k in range(4):
            spark.createDataFrame([(str(i), 10 * k + i, f"batch {k}") for i in range(k, 40, k + 1)], schema).coalesce(1).write.mode("append").parquet(f"{d}/in")
        out = streams.run_upsert(streams.source(spark, f"{d}/in", spark.createDataFrame([], schema).schema), f"{d}/table", f"{d}/state", "id", ["n"])
        want = {str(i): max((10 * k + i, f"batch {k}") for k in range(4) if i >= k and (i - k) % (k + 1) == 0) for i in range(40)}
        assert {r["id"]: (r["n"], r["note"]) for r in out.collect()} == want
        before = streams.versions(spark, f"{d}/table")
        assert all(len(v) <= 2 for v in before.values()) and max(v[-1] for v in before.values()) == 3
        streams.upsert_batch(f"{d}/table", "id", ["n"])(spark.createDataFrame([("1", 999, "new")], schema), 4)
        after = streams.versions(spark, f"{d}/table")
        assert sum(after[k] != before[k] for k in after) == 1  # one bucket alone was written
        assert {r["id"]: r["n"] for r in streams.newest(spark, f"{d}/table").collect()}["1"] == 999 and streams.newest(spark, f"{d}/table").count() == 40
        deadline = time.time() + 20
        while time.time() < deadline and not any(e["kind"] == "ended" for e in log.events):
            time.sleep(0.2)
    finally:
        spark.streams.removeListener(log)
    assert [e["kind"] for e in log.events][0] == "started" and sum(e.get("rows", 0) for e in log.events) == 40 + 20 + 13 + 10


def test_heartbeat_windows_over_batches(spark, tmp_path):
    d = f"file://{tmp_path}"
    for k in range(3):
        spark.sql(f"SELECT 'x' AS endpoint, timestamp_seconds({k} * 20 + id) AS ts, CASE WHEN id % 2 = 0 THEN 'ReadTimeout' END AS error FROM range(20)").coalesce(1).write.mode("append").parquet(f"{d}/in")
    schema = spark.read.parquet(f"{d}/in").schema
    beats = streams.heartbeat_stream(streams.source(spark, f"{d}/in", schema), "30 seconds", least=10)
    got = sorted((r["attempts"], r["timeouts"], r["alarm"]) for r in streams.run_heartbeat(beats, f"{d}/beats", f"{d}/state").collect())
    assert got == [(30, 15, True), (30, 15, True)]


def test_flush_by_age_and_parts(spark, tmp_path):
    d = f"file://{tmp_path}"
    spark.range(5).select(F.col("id").cast("string").alias("id")).coalesce(1).write.parquet(f"{d}/in")
    q = streams.flush(streams.source(spark, f"{d}/in", "id string"), streams.append_parts(f"{d}/parts"), f"{d}/state", seconds=0.2)
    try:
        deadline = time.time() + 60
        while time.time() < deadline and not files.part_files(spark, f"{d}/parts"):
            time.sleep(0.2)
        spark.range(5, 9).select(F.col("id").cast("string").alias("id")).coalesce(1).write.mode("append").parquet(f"{d}/in")
        while time.time() < deadline and len(files.part_files(spark, f"{d}/parts")) < 2:
            time.sleep(0.2)
        time.sleep(0.5)
        assert q.isActive
    finally:
        q.stop()
    parts = files.read_parts(spark, f"{d}/parts")
    assert {r["__part"] for r in parts.collect()} == {0, 1} and parts.count() == 9 and files.read_parts(spark, f"{d}/none") is None
    with pytest.raises(ValueError):
        streams.append_parts(f"{d}/parts")(spark.createDataFrame([("1",), ("1",)], "id string"), 9)


def test_one_file_a_shard_and_last_row(spark, tmp_path):
    d = f"file://{tmp_path}"
    base = spark.range(400).select(F.col("id").cast("string").alias("id"), F.lit(True).alias("needs_archive")).repartition(8)
    assert sum(pipelines.write_input_shards(base, f"{d}/input", 5)) == 400
    assert all(len(list((tmp_path / "input" / f"shard={k}").glob("part-*"))) == 1 for k in range(5))
    (tmp_path / "s.csv").write_bytes("﻿id,url,publish_date\n1,a,\n2,b,\n1,c,2020\n".encode())
    assert {r["id"]: r["url"] for r in files.read_stories(spark, f"{d}/s.csv", last_wins=True).collect()} == {"1": "c", "2": "b"}
    assert files.columns_of(spark, f"{d}/input") == ["id", "needs_archive", "shard"]
    assert files.from_rows(spark, [{"b": 1}, {"a": "x"}], "a string, b int").collect() == [(None, 1), ("x", None)]


def test_merge_and_freeze_of_files(spark, tmp_path):
    d = f"file://{tmp_path}"
    files.write_table(spark.createDataFrame([row("1", "a"), row("2", "b", "strict_verified", True), row("1", "later row")], SAVED).coalesce(1), f"{d}/results.parquet")
    files.write_table(spark.createDataFrame([row("1", None), row("2", "u" * 9, "unverified_text"), row("3", "c")], SAVED).coalesce(1), f"{d}/_ckpt_1.parquet")
    sources = files.read_sources(spark, files.source_files(spark, d))
    assert {r["id"]: r["text"] for r in pipelines.frozen(sources).collect()} == {"1": "later row", "2": "b", "3": "c"}
    plan = pipelines.merged(sources)._jdf.queryExecution().executedPlan().toString()
    assert "ShuffledHashJoin" in plan and "Window" not in plan
    assert pipelines.saved_rows(sources).where("id = '1'").first()["text"] is None
    pipelines.merge_outputs(spark, d)
    got = {r["id"]: r["text"] for r in spark.read.parquet(f"{d}/results.parquet").collect()}
    assert got == {"1": "later row", "2": "u" * 9, "3": "c"} and len(files.source_files(spark, d)) == 1
    before = spark.createDataFrame([row("1", "a"), row("2", None)], SAVED)
    pipelines.nothing_lost(before, before)
    for after in (before.limit(1), before.withColumn("text", F.lit(None).cast("string"))):
        with pytest.raises(pipelines.Invalid):
            pipelines.nothing_lost(before, after)


def test_provenance_and_metadata(spark, tmp_path):
    d = f"file://{tmp_path}"
    spark.createDataFrame([("1", "old", None)], "id string, traf_title string, traf_tags string").write.parquet(f"{d}/x")
    assert files.provenance(spark.read.parquet(f"{d}/x")).first()["file_name"].endswith(".parquet")
    df = spark.read.parquet(f"{d}/x").withColumn("m", F.struct(F.lit(None).cast("string").alias("traf_title"), F.array(F.lit("a"), F.lit(None), F.lit("b")).alias("traf_tags"), F.lit("en").alias("traf_language")))
    r = rows.merged_metadata(df, F.col("m"), ["traf_title", "traf_tags", "traf_language", "traf_image"]).first()
    assert (r["traf_title"], r["traf_tags"], r["traf_language"]) == ("old", "a, b", "en")


def test_profiles_fail_as_they_are_read(spark):
    df = spark.createDataFrame([row("1", "a"), row("1", "b")], SAVED)
    with pytest.raises(Exception, match="two: 2 rows, 1 ids"):
        pipelines.validated(rows.profile(df), "two").collect()
    assert pipelines.validated(rows.profile(df.limit(1)), "one").first()["n_rows"] == 1


@pytest.mark.parametrize("gap,block", [(0.5, 3600.0), (2.0, 1.0), (7.0, 10.0)])
def test_rate_schedule_over_blocks(spark, gap, block):
    import random

    rng = random.Random(3)
    data = [(i, rng.choice("ab"), round(rng.random() * 100, 2)) for i in range(300)]
    got = {r["event_id"]: r["start"] for r in provider.rate_schedule(spark.createDataFrame(data, "event_id long, endpoint string, arrival double"), gap, "endpoint", block_s=block).collect()}
    last = {}
    for i, e, t in sorted(data, key=lambda x: (x[2], x[0])):
        last[e] = max(t, last.get(e, -1e9) + gap)
        assert got[i] == pytest.approx(last[e])


@pytest.mark.parametrize("limits", [provider.ARCHIVE, provider.LIVE, provider.Breaker(2, 3.0, 5.0, "content", True)])
def test_breaker_runs_equal_single_steps(spark, limits):
    import random

    rng = random.Random(5)
    data = [("ab"[i % 7 == 0], i, float(i) + rng.random(), rng.random() < (0.7 if i // 60 % 2 else 0.02), rng.random() < 0.8) for i in range(900)]
    data = [(e, i, t, f, c and not f) for e, i, t, f, c in data]
    states = {"a": provider.start(), "b": provider.start()}
    want = {i: (provider.observe(states[e], t, f, c, limits), states[e]["consecutive"], states[e]["pause_until"], states[e]["openings"]) for e, i, t, f, c in data}
    got = {r["event_id"]: (r["state"], r["consecutive"], r["pause_until"], r["openings"]) for r in provider.breaker_fold(spark.createDataFrame(data, "endpoint string, event_id long, ts double, failure boolean, content boolean"), limits).collect()}
    assert got == want and {s for s, *_ in want.values()} == {"open", "closed", "probe"}


def test_health_is_never_null(spark):
    df = spark.createDataFrame([(200, None, True), (200, None, False), (None, None, None), (503, None, True), (200, "ReadTimeout", True), (404, None, None)], "s int, e string, v boolean")
    assert [r["h"] for r in df.select(traces.healthy(F.col("s"), F.col("e"), F.col("v")).alias("h")).collect()] == [True, False, True, False, False, True]


def test_percentiles_and_order(spark):
    df = spark.createDataFrame([("x", float(k), str(k)) for k in range(1, 21)] + [("y", 3.0, "1"), ("z", None, "2")], "strategy string, seconds double, id string")
    got = {r["strategy"]: (r["p50"], r["p95"]) for r in metrics.nearest_rank(df, "strategy", "seconds", {"p50": 0.5, "p95": 0.95}).collect()}
    assert got == {"x": (10.0, 19.0), "y": (3.0, 3.0)}
    assert [r["id"] for r in metrics.strategy_rows(df).limit(3).collect()] == ["1", "1", "10"]


def test_supertypes_of_nested_columns(spark):
    a = spark.sql("SELECT array(named_struct('k', 1, 'v', 'x')) AS c")
    b = spark.sql("SELECT array(named_struct('k', CAST(2 AS BIGINT), 'v', CAST(NULL AS STRING))) AS c")
    out = rows.relaxed_union(a, b)
    assert out.dtypes == [("c", "array<struct<k:bigint,v:string>>")] and out.count() == 2
    assert RESULT_TYPES["text"].typeName() == "string"
