import pytest
from pyspark.sql import functions as F
from test_operators import SAVED, row

from salvor.plans import cli, live, pipelines
from salvor.sources import files

ART = "<html><head><title>x</title></head><body><article><h1>{t}</h1><p>{b}</p></article></body></html>"


def test_live_cascade(spark):
    stories = spark.createDataFrame([(str(k), f"http://e.de/{k}", f"Title {k}") for k in range(5)], "id string, url string, title string")
    saved = spark.createDataFrame([row("4", "kept", "strict_verified", True)], SAVED)
    ok = lambda k, m, t: (str(k), m, 200, None, ART.format(t=t, b="body " + m), f"http://e.de/{k}")
    tries = [
        ok(0, "requests", "Title 0"), ok(1, "requests", "Other"), ok(1, "playwright", "Title 1"), ("2", "requests", 404, "http_404", None, None), ("2", "wayback", 503, None, None, None),
        ("3", "requests", 500, "http_500", None, None), ("3", "playwright", None, "playwright_hard_timeout", None, None), ok(3, "wayback", "Else"), ok(4, "requests", "Title 4"),
    ]
    attempts = spark.createDataFrame(tries, "id string, method string, status int, error string, content string, final_url string")
    got = {r["id"]: r for r in live.scrape(stories, saved, attempts, "r", "now").collect()}
    assert set(got) == {"0", "1", "2", "3"}
    assert got["0"]["verification_level"] == "strict_verified" and got["0"]["attempted_methods"] == "requests" and "body requests" in got["0"]["text"]
    assert got["1"]["attempted_methods"] == "requests,playwright" and got["1"]["fetch_method"] == "playwright"
    assert got["2"]["needs_archive"] and got["2"]["attempted_methods"] == "requests,wayback" and got["2"]["scrape_status"] == "fetch_error"
    assert not got["3"]["needs_archive"] and got["3"]["verification_level"] == "unverified_text" and got["3"]["attempt_trace"].count('"method"') == 3
    out = live.scrape_and_merge(stories, saved, attempts, "r", "now")
    pipelines.complete(stories, out)
    assert {r["id"]: r["text"] for r in out.collect()}["4"] == "kept"


def test_commands(spark, tmp_path):
    d = f"file://{tmp_path}"
    files.write_table(spark.createDataFrame([row("1", "a", "no_text"), row("2", None, pending=True)], SAVED), f"{d}/results.parquet")
    run = lambda *a: cli.main([*a, "--folder", d, "--shards", "2"], spark)
    m = run("prepare")
    assert run("status")["percent"] == 0.0 and sum(m["shard_rows"]) == 1
    with pytest.raises(pipelines.Invalid):
        run("reduce")
    k = m["shard_rows"].index(1)
    files.write_table(spark.createDataFrame([row("2", "b", "page_verified")], SAVED).withColumn("shard", F.lit(k)), f"{d}/runs/run/results", by="shard")
    assert run("status")["percent"] == 100.0 and run("reduce")["n_text"] == 2 and run("status")["status"] == "completed" and run("stats")["final"] == 2
    with cli.run_lock(spark, d), pytest.raises(pipelines.Invalid):
        run("merge")
    with pytest.raises(pipelines.Invalid):
        cli.main(["status", "--folder", d, "--run-name", "../x"], spark)


def test_archive_jobs_start_from_their_saved_row(spark):
    stories = spark.createDataFrame([(k, f"http://e.de/{k}", f"Title {k}") for k in "abcdefx"], "id string, url string, title string")
    kind = SAVED + ", fallback_text string, fallback_text_length long, fallback_fetch_method string, url string, title string"
    back = lambda n: ("f" * n, n, "playwright") if n else (None, None, None)
    saved = spark.createDataFrame([
        (*row("a", "u" * 5000, "unverified_text", pending=True), *back(0), None, None),
        (*row("b", "checked", "page_verified", pending=True), *back(3000), None, None),
        (*row("c", "u" * 4000, "unverified_text", pending=True), *back(0), None, None),
        (*row("d", "short", "unverified_text", pending=True), *back(2000), None, None),
        (*row("e", None, pending=True), *back(0), None, None),
        (*row("f", "u" * 50, "unverified_text", pending=True), *back(1000), None, None),
        (*row("gone", "u", "unverified_text", pending=True), *back(0), "http://e.de/gone", "Title gone"),
    ], kind)
    page = lambda k, m, t: (k, m, 200, None, ART.format(t=t, b="body of the attempt"), f"http://e.de/z{k}")
    tries = [
        page("a", "wayback", "Else"), page("b", "wayback", "Else"), page("c", "wayback", "Title c"), page("c", "requests", "Title c"), page("d", "wayback", "Title d"),
        ("e", "wayback", 503, None, None, None), page("f", "wayback", "Else"), page("gone", "wayback", "Title gone"), page("x", "requests", "Else"), page("x", "playwright", "Title x"),
    ]
    attempts = spark.createDataFrame(tries, "id string, method string, status int, error string, content string, final_url string")
    got = {r["id"]: r for r in live.scrape_and_merge(stories, saved, attempts, "r", "now").collect()}
    assert got["a"]["text"] == "u" * 5000 and not got["a"]["needs_archive"] and got["a"]["attempted_methods"] == "wayback" and got["a"]["completed_at"] == "now"
    assert got["b"]["text"] == "checked" and got["b"]["verification_level"] == "page_verified" and got["b"]["fallback_text"] == "f" * 3000
    assert got["c"]["verification_level"] == "strict_verified" and got["c"]["fallback_text"] == "u" * 4000 and got["c"]["fallback_fetch_method"] == "requests"
    assert got["c"]["attempt_trace"].count('"method"') == 1
    assert got["d"]["verification_level"] == "strict_verified" and got["d"]["fallback_text_length"] == 2000 and got["d"]["fallback_fetch_method"] == "playwright"
    assert got["e"]["needs_archive"] and got["e"]["scrape_status"] == "fetch_error" and got["e"]["text"] is None
    assert len(got["f"]["text"]) >= 50 and got["f"]["fallback_text"] == "f" * 1000
    assert got["gone"]["text"] == "u" and got["gone"]["needs_archive"]
    assert got["x"]["fetch_method"] == "playwright" and got["x"]["fallback_text"] is None
    only = {r["id"]: r for r in live.scrape(stories, saved, attempts, "r", "now", mode="archive-only").collect()}
    assert set(only) == {*"abcdef", "gone"} and only["gone"]["verification_level"] == "strict_verified" and only["gone"]["url"] == "http://e.de/gone"


def test_accepted_candidate_keeps_a_longer_one_before_it(spark):
    from salvor.operators import acceptance

    data = [("a", 0, "longest", "unverified_text"), ("a", 1, "p", "page_verified"), ("a", 2, "much longer but later", "unverified_text"), ("b", 0, "u", "unverified_text")]
    pages = spark.createDataFrame(data, "id string, position int, text string, verification_level string")
    each = pages.groupBy("id").agg(F.array_sort(F.collect_list(F.struct("position", "text", "verification_level"))).alias("c")).withColumn("x", acceptance.chosen(F.col("c")))
    got = {r["id"]: (r["text"], r["longer"]) for r in each.select("id", "x.best.text", "x.longer").collect()}
    assert got == {"a": ("p", "longest"), "b": ("u", None)}
