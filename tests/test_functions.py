from pyspark.sql import functions as F

from salvor.functions import html, text, times, traces, urls


def one(spark, c):
    return spark.range(1).select(c.alias("x")).first()["x"]


def test_has_text_knows_unicode_space(spark):
    got = [one(spark, text.has_text(F.lit(v).cast("string"))) for v in ("a", "", "  \x85\x1c", None, " x")]
    assert got == [True, False, False, False, True]


def test_titles_fold_entities_case_and_space(spark):
    df = spark.createDataFrame([("  Stra&szlig;e \n X",), (None,), ("STRASSE x",)], "t string")
    assert [r["x"] for r in df.select(text.normalize_title("t").alias("x")).collect()] == ["strasse x", "", "strasse x"]


def test_structured_text(spark):
    df = spark.createDataFrame([("&lt;p&gt; a &lt;/p&gt;\n\n b ",), (None,), ("x" * 300_000,)], "t string")
    got = [r["x"] for r in df.select(text.clean_structured_text("t").alias("x")).collect()]
    assert got[0] == "a\nb" and got[1] is None and len(got[2]) == 300_000


def test_affixes_labels_and_errors(spark):
    assert one(spark, text.drop_prefix(F.lit("www.a.b"), "www.")) == "a.b"
    assert one(spark, text.drop_suffix(F.lit("x-->"), "-->")) == "x"
    assert one(spark, text.http_error(F.lit(404))) == "http_404" and one(spark, text.http_error(F.lit(204))) is None
    assert one(spark, text.is_source_link(F.lit("Läs mer på Pressen"), F.lit(None).cast("string")))
    assert one(spark, text.is_source_link(F.lit("x"), F.lit("Das Original zu diesem Beitrag: y")))
    assert not one(spark, text.is_source_link(F.lit("Jetzt weiterlesen"), F.lit("")))
    assert one(spark, text.collapse_spaces(F.lit(" a \n b "))) == "a b"
    assert one(spark, text.joined(F.array(F.lit("news"), F.lit(None), F.lit("local")))) == "news, local"


def test_archive_forms(spark):
    assert one(spark, urls.archive_variants(F.lit("https://example.com/a?utm=x#part"))) == ["https://example.com/a?utm=x", "http://example.com/a?utm=x", "https://example.com/a"]
    assert one(spark, urls.archive_variants(F.lit("no host"))) == [] and one(spark, urls.archive_variants(F.lit(None).cast("string"))) == []


def test_identity_in_columns_equals_python(spark):
    cases = ["https://www.Example.com:443/a/?q=1#f", "http://u:p@example.com:8080", "http://example.com/", "http://example.com/a//", "https://example.com/ü x"]
    got = [r["x"] for r in spark.createDataFrame([(c,) for c in cases], "u string").select(urls.identity(F.col("u")).alias("x")).collect()]
    assert got == [urls.identity_text(c) for c in cases]
    assert one(spark, urls.identity(F.lit(""))) is None
    assert one(spark, urls.equivalent(F.lit("http://www.a.de/x/"), F.lit("https://a.de/x")))
    assert one(spark, urls.resolve(F.lit("http://a.de/b/c"), F.lit("../d"))) == "http://a.de/d"
    assert one(spark, urls.percent_encode(F.lit("http://a.de/ü x"))) == "http://a.de/%C3%BC%20x"
    assert one(spark, urls.is_offsite(F.lit("http://x.de/"), "web.archive.org"))


def test_times(spark):
    stamp = lambda v: one(spark, times.publication_timestamp(F.lit(v).cast("string")))
    assert [stamp(v) for v in ("2020-01-02", "on 20200102T0304", "2020-02-30", None, "x")] == ["20200102000000", "20200102030400", None, None, None]
    far = lambda a, b: one(spark, times.timestamp_distance(F.lit(a), F.lit(b).cast("string")))
    assert far("20200102000000", "20200101000000") == 86400 and far("bad", "20200101000000") == float("inf") and far("20200102000000", None) == -20200102000000.0
    assert one(spark, times.percent_complete(F.lit(0), F.lit(0))) == 100.0
    assert one(spark, times.ratio(F.lit(1), F.lit(0), None)) is None


TRACES = [
    ([("direct", 404, None)], True, "availability"),
    ([("direct", None, "ReadTimeout")], True, "direct"),
    ([("direct", 404, None), ("availability", None, "ReadTimeout")], True, "availability"),
    ([("direct", 404, None), ("availability", 200, None)], True, "cdx"),
    ([("direct", 404, None), ("availability", 200, None), ("cdx", 200, None)], True, "done"),
    ([("direct", 404, None), ("availability", 200, None), ("snapshot", 503, None)], True, "availability"),
    ([], False, "done"), ([], None, "done"), ([], True, "direct"),
]


def test_resume_stage(spark):
    import json

    data = [(k, json.dumps([1, "x", {"method": "requests"}] + [{"method": "wayback", "phase": p, "status": s, "error": e} for p, s, e in t]), n) for k, (t, n, _) in enumerate(TRACES)]
    df = spark.createDataFrame(data, "k int, raw string, n boolean")
    got = df.select("k", traces.resume_stage(F.col("n"), traces.wayback_entries(F.col("raw"))).alias("s")).orderBy("k").collect()
    assert [r["s"] for r in got] == [w for _, _, w in TRACES]


def test_trace_append_keeps_odd_elements(spark):
    entry = F.array(traces.trace_entry(method=F.lit("wayback"), phase=F.lit("cdx")))
    got = lambda raw: one(spark, traces.append_trace(F.lit(raw).cast("string"), entry))
    new = '{"method":"wayback","phase":"cdx"}'
    assert got('[1,"ä",{"a":2}]') == f'[1,"ä",{{"a":2}},{new}]'
    assert got('{"a":1}') == got("bad") == got(None) == f"[{new}]"


def test_provider_presets(spark):
    f = lambda s, e, p: one(spark, traces.provider_failure(F.lit(s).cast("int"), F.lit(e).cast("string"), p))
    assert [f(500, None, "archive"), f(500, "http_500", "live"), f(404, None, "archive"), f(None, "ReadTimeout", "live"), f(None, "offsite_redirect", "archive"), f(None, "no_capture", "live")] == [True, False, False, True, False, False]


PAGE = """<html lang="de"><head><title>T &amp; x</title><link rel="canonical" href="/a"><meta property="og:title" content="Title">
<script type="application/LD+json"><!-- {"@graph":[{"@type":"NewsArticle","url":"http://e.de/a","headline":"Title","articleBody":"Body one"}]} --></script>
<script type="application/ld+json">{bad</script></head>
<body><nav>menu</nav><article><h1>Title</h1><p>First paragraph<p>Second</article><div itemprop="x articleBody">prop</div>
<p><a href="http://other.de/b">Läs mer på Pressen</a></p></body></html>"""


def test_extraction_cascade():
    out = html.extract(PAGE, "http://e.de/a", "title")
    assert out["canonical_url"] == "http://e.de/a" and out["og_title"] == "Title" and out["source_article_url"] == "http://other.de/b" and out["structured_title"] == "Title"
    got = [(c["extract_method"], c["strict_body"]) for c in out["candidates"]]
    assert got == [("jsonld", True), ("itemprop", True), ("trafilatura_scoped", True), ("trafilatura", False)]
    assert out["candidates"][0]["text"] == "Body one" and "menu" not in out["candidates"][2]["text"] and "Second" in out["candidates"][2]["text"]


def test_extraction_of_poor_pages():
    for raw in (None, "", "<p", b"\xff\xfe<meta charset=latin-1><p>\xe4</p>", "<div>" * 5000 + "x", "</p></div>"):
        html.extract(raw, None, None)
    assert html.decode(b"<meta charset='latin-1'>\xe4").endswith("ä")
    assert html.extract("<main>a</main>", "http://x.news.de/", "t", {"news.de": "N", "de": "D"}, {"N": lambda t: ("body", "t")})["fundus_publisher"] == "N"
    assert html.extract("<article>a</article><article>b</article>", "", "")["candidates"][0]["extract_method"] == "trafilatura"


def test_charset_is_declared_anywhere():
    from salvor.functions.html import decode

    late = "<html><head><!--" + "x" * 5000 + '--><meta http-equiv="Content-Type" content="text/html; charset=windows-1251"><title>Новости</title>'
    assert decode(late.encode("windows-1251")) == late
    assert decode(late.replace('http-equiv="Content-Type" content="text/html; charset=windows-1251"', "CHARSET = 'windows-1251'").encode("windows-1251")).endswith("<title>Новости</title>")
    other = "<p>ä" + "x" * 5000 + '<a href="?charset=utf-8">ö</a>'
    assert decode(other.encode("latin-1")) == other
