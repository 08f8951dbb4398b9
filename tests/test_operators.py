import pytest
from pyspark.sql import functions as F

from salvor.functions import html
from salvor.operators import acceptance, archive, levels, metrics, provider, queues, rows
from salvor.plans import pipelines
from salvor.sources import capture_log, files
from salvor.streaming import streams

SAVED = "id string, text string, verification_level string, target_verified boolean, needs_archive boolean, scrape_status string, fetch_method string"


def source(spark, data, rank, mtime, canonical):
    df = spark.createDataFrame(data, SAVED)
    return df.withColumns({"__source_rank": F.lit(rank), "__source_mtime": F.lit(mtime), "__canonical": F.lit(canonical), "__position": F.monotonically_increasing_id()})


def row(i, t, level=None, verified=None, pending=False, method="requests"):
    return (i, t, level, verified, pending, "ok" if t else "fetch_error", method)


def test_freeze_rules(spark):
    old = source(spark, [row("1", "saved text", "no_text"), row("2", "x", "strict_verified", True), row("3", "strict", "strict_verified", True), row("4", "longer old", "unverified_text")], 0, 100, True)
    new = source(spark, [row("1", None), row("2", "newer", "strict_verified", True), row("3", "u", "unverified_text"), row("4", "short", "unverified_text")], 1, 200, False)
    got = {r["id"]: r["text"] for r in pipelines.frozen([old, new]).collect()}
    assert got["2"] == "newer" and got["3"] == "strict" and got["4"] == "longer old"


def test_merge_prefers_text_then_later_source(spark):
    old, new = source(spark, [row("1", "a"), row("2", "b")], 0, 1, True), source(spark, [row("1", None), row("2", "c")], 1, 2, False)
    got = {r["id"]: r for r in pipelines.merged([old, new]).collect()}
    assert got["1"]["text"] == "a" and got["2"]["text"] == "c" and got["1"]["verification_level"] == "unverified_text"


def test_relaxed_union_meets_types(spark):
    a = spark.createDataFrame([(1, True, None)], "a int, b boolean, c string").withColumn("v", F.lit(None))
    b = spark.createDataFrame([("x", 2, 1.5)], "a string, b int, v double")
    out = rows.relaxed_union(a, b)
    assert dict(out.dtypes) == {"a": "string", "b": "int", "c": "string", "v": "double"}
    assert rows.concrete(a).schema["v"].dataType.typeName() == "string"
    assert rows.align(b, ["v", "z"]).columns == ["v", "z"]


def test_shards_are_total_and_disjoint(spark):
    df = spark.range(1000).select(F.col("id").cast("string").alias("id"))
    got = rows.shard_counts(df, 8).collect()
    assert len(got) == 8 and sum(r["n_rows"] for r in got) == 1000
    assert rows.shard_counts(df.limit(0), 3).collect()[0]["n_rows"] == 0
    with pytest.raises(ValueError):
        rows.stratified_sample({"a": df.limit(1)}, {"a": 2}, 1)


def test_queues_by_mode(spark):
    stories = spark.createDataFrame([("1",), ("2",)], "id string")
    saved = spark.createDataFrame([row("2", None, pending=True), row("3", None, pending=True)], SAVED)
    ids = lambda **k: {(r["id"], r["tier"]) for r in queues.work(stories, saved, **k).collect()}
    assert ids() == {("1", 0), ("2", 1)} and ids(mode="archive-only") == {("2", 1), ("3", 1)} and ids(mode="live-only") == {("1", 0)} and ids(limit=1) == {("1", 0)}
    legacy = saved.drop("needs_archive")
    assert legacy.where(levels.pending(legacy)).count() == 2


def test_resume_rows_take_the_better_deferred(spark):
    base = spark.createDataFrame([row("1", None, pending=True), row("2", "base text", "unverified_text", pending=True), row("3", None, pending=True)], SAVED)
    parts = spark.createDataFrame([row("1", "found", "unverified_text", pending=True), row("2", "b", "unverified_text", pending=True), row("3", None, pending=False)], SAVED)
    parts = parts.withColumns({"__part": F.lit(0), "__pos": F.monotonically_increasing_id()})
    got = {r["id"]: r["text"] for r in pipelines.resume_rows(base, None, parts).collect()}
    assert got == {"1": "found", "2": "base text"}


def test_resume_rows_keep_the_longest_unverified_text(spark):
    kind = SAVED + ", fallback_text string, fallback_text_length long, fallback_fetch_method string"
    no = (None, None, None)
    base = spark.createDataFrame([
        (*row("1", "u" * 90, "unverified_text", pending=True), *no), (*row("2", "b", "page_verified", pending=True), *no),
        (*row("3", "same", "unverified_text", pending=True), "f" * 80, 80, "playwright"), (*row("4", "alone", "unverified_text", pending=True), "g" * 70, 70, "requests"),
    ], kind)
    held = [row("1", "page", "page_verified", pending=True, method="wayback"), row("2", "v" * 60, "unverified_text", pending=True, method="wayback"), row("3", "same+", "unverified_text", pending=True, method="wayback")]
    parts = spark.createDataFrame([(*r, *no) for r in held], kind).withColumns({"__part": F.lit(0), "__pos": F.monotonically_increasing_id()})
    got = {r["id"]: (r["text"], r["fallback_text"], r["fallback_text_length"], r["fallback_fetch_method"]) for r in pipelines.resume_rows(base, None, parts).collect()}
    assert got == {"1": ("page", "u" * 90, 90, "requests"), "2": ("b", "v" * 60, 60, "wayback"), "3": ("same+", "f" * 80, 80, "playwright"), "4": ("alone", "g" * 70, 70, "requests")}
    bare = pipelines.resume_rows(base.select(*[c.split()[0] for c in SAVED.split(", ")]).drop("fetch_method"), None, parts)
    assert "fetch_method" not in bare.columns and {r["id"]: r["fallback_text_length"] for r in bare.collect()} == {"1": 90, "2": 60, "3": None, "4": None}


def test_cascade_choice(spark):
    data = [("a", 0, "u", "unverified_text"), ("a", 1, "p", "page_verified"), ("a", 2, "s", "strict_verified"), ("b", 0, "xx", "unverified_text"), ("b", 1, "yy", "unverified_text"), ("b", 2, "zzz", "unverified_text")]
    rows_ = spark.createDataFrame([*data, ("c", None, None, None)], "id string, position int, text string, verification_level string")
    each = F.array_sort(F.collect_list(F.when(F.col("position").isNotNull(), F.struct("position", "text", "verification_level"))))
    got = rows_.groupBy("id").agg(each.alias("c")).select("id", acceptance.chosen(F.col("c")).alias("x"))
    assert {r["id"]: r["x"] and r["x"]["best"]["text"] for r in got.collect()} == {"a": "p", "b": "zzz", "c": None}
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Generate" not in plan


def test_verified_by_keeps_the_order_of_signals(spark):
    page = """<html><head><title>Its title</title><link rel="canonical" href="/a/"><meta property="og:url" content="http://e.de/a"><meta property="og:title" content="ITS  title">
    <script type="application/ld+json">{"@type": "NewsArticle", "url": "http://www.e.de/a", "headline": "Its title", "articleBody": "Body."}</script></head><body><article><h1>x</h1><p>Body</p></article></body></html>"""
    df = spark.createDataFrame([("1", page, "http://e.de/a", "its title"), ("2", page, "http://e.de/b", "its title"), ("3", page, "http://e.de/b", None), ("4", None, "http://e.de/a", "")], "id string, html string, url string, title string")
    df = df.withColumn("page", html.extract_page(F.col("html"), F.lit("http://e.de/z"), F.col("title"), url=F.col("url")))
    got = {(r["id"], r["stage"]): (r["verified_by"], r["verification_level"]) for r in acceptance.judged(df).collect()}
    assert got["1", 1] == ("canonical+og_url+jsonld_url+og_title+trafilatura_title+jsonld_headline+jsonld_body", "strict_verified")
    assert got["1", 5] == ("canonical+og_url+structured_url+og_title+trafilatura_title+structured_title+whole_page", "page_verified")
    assert got["2", 1] == ("og_title+trafilatura_title+jsonld_headline+jsonld_body", "strict_verified") and got["3", 1] == (None, "unverified_text")
    assert not any(k[0] == "4" for k in got)
    plan = acceptance.judged(df)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


def test_jsonld_objects_and_declared_parsers(spark):
    page = """<script type="application/ld+json">{"@type": ["A", "B"], "x": [{"@type": "C"}]}</script><script type="application/ld+json">broken</script><h1>Head</h1><div class="x entry-content">Words<nav>no</nav></div>"""
    spark.udtf.register("jsonld_objects", html.jsonld_objects)
    df = spark.createDataFrame([(page,), (None,)], "h string")
    df.createOrReplaceTempView("jsonld_pages")
    got = spark.sql("SELECT o.* FROM jsonld_pages, LATERAL jsonld_objects(h) o").collect()
    assert [(r["position"], r["type"]) for r in got] == [(0, "A,B"), (1, "C")]
    out = html.extract(page, "http://www.pub.de/a", None, {"pub.de": "entry-content"})
    (c,) = [c for c in out["candidates"] if c["stage"] == 3]
    assert out["fundus_publisher"] == "entry-content" and c["text"] == "Words" and c["titles"][0]["value"] == "Head"


def test_publisher_takes_longest_host(spark):
    pages = spark.createDataFrame([("1", "http://www.a.b.de/x"), ("2", "http://ab.de"), ("3", "http://zb.de")], "id string, url string")
    known = spark.createDataFrame([("b.de", "B"), ("a.b.de", "A"), ("ab.de", "AB")], "host string, publisher string")
    assert {r["id"]: r["publisher"] for r in archive.publisher_join(pages, known).collect()} == {"1": "A", "2": "AB", "3": None}


def test_nearest_two_distinct_captures(spark):
    data = [("1", 0, "20200101000000", "x", "20200115000000"), ("1", 1, "20200114000000", "y", "20200115000000"), ("1", 2, "20200113000000", "y", "20200115000000"), ("1", 3, "20191201000000", None, "20200115000000")]
    got = archive.nearest(spark.createDataFrame(data, "id string, position int, timestamp string, digest string, target string")).orderBy("replay_no").collect()
    assert [r["position"] for r in got] == [1, 0]


def test_breakers(spark):
    b, s = provider.LIVE, provider.start()
    assert [provider.observe(s, float(t), True, False, b) for t in range(5)] == ["closed"] * 5 and s["pause_until"] == 24.0
    assert provider.observe(s, 10.0, True, False, b) == "open" and s["consecutive"] == 0
    assert provider.observe(s, 24.0, True, False, b) == "probe" and s["pause_until"] == 84.0
    assert provider.observe(s, 84.0, False, False, b) == "probe" and not s["probe"]
    a = provider.start()
    for t in range(4):
        provider.observe(a, float(t), True, False, provider.ARCHIVE)
    provider.observe(a, 4.0, False, False, provider.ARCHIVE)
    assert a["consecutive"] == 0
    provider.defer(a, 10.0, 500.0)
    assert a["pause_until"] == 130.0


def test_rate_schedule_equals_fold(spark):
    data = [("d", k, t) for k, t in enumerate([0.0, 0.1, 0.2, 5.0, 5.1])]
    got = [r["start"] for r in provider.rate_schedule(spark.createDataFrame(data, "k string, event_id int, arrival double"), 0.5, "k").orderBy("event_id").collect()]
    assert got == pytest.approx([0.0, 0.5, 1.0, 5.0, 5.5])


def test_capped_failures_stop_the_index(spark):
    state = spark.createDataFrame([("1", "http://e.de/a", "20200102000000", True, None)], "id string, url string, target string, needs_archive boolean, attempt_trace string")
    cap = "array<struct<timestamp: string, original_url: string, digest: string>>"
    out = [("1", "direct", "http://e.de/a", "20200102000000", None, None, "ReadTimeout", False), ("1", "availability", "http://e.de/a", None, None, 200, None, False), ("1", "cdx", "http://e.de/a", None, [("20190101000000", "http://e.de/a", "x"), ("20180101000000", "http://e.de/a", "y")], 200, None, False), ("1", "snapshot", None, "20190101000000", None, 404, None, False), ("1", "snapshot", None, "20180101000000", None, 404, None, False)]
    got = archive.route(state, spark.createDataFrame(out, f"id string, phase string, variant string, timestamp string, captures {cap}, status int, error string, accepted boolean")).first()
    assert [a["phase"] for a in got["actions"]] == ["direct", "availability", "cdx", "snapshot"] and got["needs_archive"] and not got["terminal"]


def test_stats_over_an_empty_table(spark):
    empty = spark.createDataFrame([], SAVED + ", text_length long, country string")
    assert set(metrics.outcome_stats(empty).first()) == {0}
    assert sorted(r["scope"] for r in metrics.outcome_stats_by_country(empty).collect()) == ["Germany", "Sweden", "overall"]


def test_country_map_rejects_bad_dimensions(spark):
    stories = spark.createDataFrame([("1", "a")], "id string, media_name string")
    for bad in ([("Sweden", "a"), ("Germany", "a")], [("Sweden", "b")], [("France", "a")]):
        with pytest.raises(pipelines.Invalid):
            pipelines.country_by_id(stories, spark.createDataFrame(bad, "country string, source_name string"))


def test_files_and_run(spark, tmp_path):
    d = f"file://{tmp_path}"
    (tmp_path / "s.csv").write_bytes(b'\xef\xbb\xbfid,url,publish_date,title\n1,http://a,2020-01-01,"x ""y"""\n')
    assert files.read_stories(spark, f"{d}/s.csv").first()["title"] == 'x "y"'
    for name, data in (("results", [row("1", "a", "no_text"), row("2", None, pending=True)]), ("_ckpt_000001", [row("2", "b", "unverified_text", pending=True), row("3", None, pending=True)])):
        files.write_table(spark.createDataFrame(data, SAVED), f"{d}/out/{name}.parquet")
    m = pipelines.prepare_run(spark, f"{d}/out", f"{d}/run", 4, "run-1", "2020-01-01T00:00:00+00:00")
    assert m["base"]["n_rows"] == 3 and sum(m["shard_rows"]) == 2
    assert pipelines.prepare_run(spark, f"{d}/out", f"{d}/run", 4, "run-1", "later") == m
    with pytest.raises(pipelines.Invalid):
        pipelines.prepare_run(spark, f"{d}/out", f"{d}/run", 8, "run-1", "later")
    delta = spark.createDataFrame([row("2", "b!", "page_verified", True), row("3", None)], SAVED)
    paths = files.source_files(spark, f"{d}/out")
    p = pipelines.reduce_run(spark, f"{d}/run", m, delta, paths, f"{d}/out/results.parquet")
    assert p["n_rows"] == 3 and p["n_text"] == 2
    with pytest.raises(pipelines.Invalid):
        pipelines.reduce_run(spark, f"{d}/run", m, delta, paths, f"{d}/out/results.parquet")
    assert pipelines.merge_outputs(spark, f"{d}/out")["n_rows"] == 3 and pipelines.merge_outputs(spark, f"{d}/out") is None
    results = spark.read.parquet(f"{d}/out/results.parquet")
    text = pipelines.statistics(results.withColumn("text_length", F.length("text")), spark.createDataFrame([("1", "Sweden")], "id string, country string"), 3)
    assert "recovered" in text and "Sweden" in text
    files.remove(spark, f"{d}/out/results.parquet")
    assert files.recover(spark, f"{d}/out/results.parquet") == "restored" and files.recover(spark, f"{d}/out/results.parquet") == "kept"


def test_fingerprint_ignores_order(spark):
    df = spark.range(100).withColumn("x", F.col("id") * 2)
    assert files.fingerprint(df) == files.fingerprint(df.orderBy(F.desc("id")).repartition(3)) != files.fingerprint(df.limit(99))


def test_capture_log_source(spark, tmp_path):
    (tmp_path / "a.jsonl").write_text('{"url":"u","phase":"cdx","status":200}\nbad\n{"url":"v","phase":"direct"}\n')
    path = f"file://{tmp_path}"
    df = capture_log.read_capture_log(spark, path)
    assert df.count() == 2 and df.where("phase = 'cdx'").first()["url"] == "u"
    assert "EqualTo(phase,cdx)" in df.where("phase = 'cdx'")._jdf.queryExecution().executedPlan().toString()
    every = capture_log.read_capture_log(spark, path, unreadable=True)
    assert every.count() == 3 and [r["payload"] for r in every.where(F.col("phase") == capture_log.UNREADABLE).collect()] == ["bad"]


def test_streams_resume_and_keep_state(spark, tmp_path):
    d = f"file://{tmp_path}"
    schema = "id string, n int"
    for k, data in enumerate([[("a", 1), ("b", 1)], [("a", 2)]]):
        spark.createDataFrame(data, schema).coalesce(1).write.mode("append").parquet(f"{d}/in")
        out = streams.run_upsert(streams.source(spark, f"{d}/in", spark.createDataFrame([], schema).schema), f"{d}/table", f"{d}/state", "id", ["n"])
    assert {r["id"]: r["n"] for r in out.collect()} == {"a": 2, "b": 1}
    e = [("cdx", k, float(k), True, False) for k in range(6)]
    es = "endpoint string, event_id long, ts double, failure boolean, content boolean"
    spark.createDataFrame(e, es).coalesce(1).write.parquet(f"{d}/events")
    s = streams.breaker_stream(streams.source(spark, f"{d}/events", spark.createDataFrame([], es).schema))
    q = s.writeStream.format("memory").queryName("breaker").outputMode("append").trigger(availableNow=True).start()
    q.awaitTermination()
    assert [r["state"] for r in spark.table("breaker").orderBy("event_id").collect()] == ["closed"] * 5 + ["open"]


def test_keep_last_limits_before_its_exchange(spark):
    df = spark.range(1000).select((F.col("id") % 10).alias("k"), "id")
    plan = rows.keep_last(df, "k", ["id"])._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan
