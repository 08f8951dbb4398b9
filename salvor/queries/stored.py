"""Queries over stored tables, runs, streams and made-up pages, beside those of ``registry``."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salvor.functions import html, text, times, traces, urls
from salvor.operators import acceptance, provider, queues, rows
from salvor.plans import cli, live, pipelines
from salvor.queries.registry import ARCHIVE_JOB, BREAKER, CANDIDATES, HT, QUALITY, WITH_R, WITH_S, P, archive_inputs, query, result, shared
from salvor.queries.views import ATTEMPT, CANONICAL, CHECKPOINT, STORY, table, view
from salvor.sources import files
from salvor.streaming import streams

# Sources, sinks and composite plans


@query("SELECT CAST(page_id AS VARCHAR) AS id, url, '2020-01-01' AS publish_date, nullif(regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1), '') AS title FROM pages")
def story_csv(spark, sf):
    """Stories written as CSV and read again: quotes, commas and white space in titles survive."""
    path = f"{shared(spark)}/stories"
    s = view(spark, sf, STORY).select("id", "url", F.lit("2020-01-01").alias("publish_date"), F.nullif("title", F.lit("")).alias("title"))
    s.write.options(header=True, escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False).csv(path)
    return files.read_stories(spark, path)


@query("SELECT DISTINCT source AS source_name, lang AS country FROM documents WHERE source IS NOT NULL AND lang IS NOT NULL")
def dimension_csv(spark, sf):
    path = f"{shared(spark)}/dimension"
    table(spark, sf, "documents").select(F.col("lang").alias("country"), F.col("source").alias("source_name"), F.lit(1).alias("more")).distinct().write.option("header", True).csv(path)
    return files.read_dimension(spark, path)


def stored_sources(spark, sf) -> str:
    """The canonical table and a later checkpoint, as files of one folder."""
    folder = shared(spark)
    for name, sql in (("results.parquet", CANONICAL), ("_ckpt_1.parquet", CHECKPOINT)):
        files.write_table(view(spark, sf, sql).drop("src_rank", "src_mtime", "is_canonical"), f"{folder}/{name}")
    return folder


@query(WITH_S + "SELECT id, origin, src_rank, is_canonical FROM s")
def source_files(spark, sf):
    frames = files.read_sources(spark, files.source_files(spark, stored_sources(spark, sf)))
    return rows.relaxed_union(*frames).select("id", "origin", F.col("__source_rank").alias("src_rank"), F.col("__canonical").alias("is_canonical"))


MERGED = WITH_S + f"SELECT id, origin, CASE WHEN {HT} AND scrape_status IN ('ok_low_confidence', 'false_positive') THEN 'ok' ELSE scrape_status END AS scrape_status, CAST(length(coalesce(text, '')) AS BIGINT) AS n_text, md5(coalesce(text, '')) AS digest FROM s QUALIFY row_number() OVER (PARTITION BY id ORDER BY {HT} DESC, src_rank DESC) = 1"


def with_digest(df: DataFrame, *columns: str) -> DataFrame:
    return df.select(*columns, text.code_points(F.col("text")).alias("n_text"), F.md5(F.coalesce("text", F.lit("")).cast("binary")).alias("digest"))


@query(MERGED)
def merged_files(spark, sf):
    """Files merged into the canonical one, committed, and read again; the checkpoint is gone."""
    folder = stored_sources(spark, sf)
    pipelines.merge_outputs(spark, folder)
    pipelines.check(files.source_files(spark, folder) == [f"{folder}/results.parquet"], "checkpoints are left")
    return with_digest(spark.read.parquet(f"{folder}/results.parquet"), "id", "origin", "scrape_status")


FROZEN = WITH_S + f", q AS (SELECT *, {QUALITY} AS quality FROM s), f AS (SELECT * FROM q QUALIFY row_number() OVER (PARTITION BY id ORDER BY quality DESC, CASE WHEN quality = 1 THEN length(coalesce(text, '')) ELSE 0 END DESC, src_rank DESC) = 1)"


@query(FROZEN + " SELECT id, origin, CAST(length(coalesce(text, '')) AS BIGINT) AS n_text, md5(coalesce(text, '')) AS digest FROM f")
def frozen_base(spark, sf):
    folder = stored_sources(spark, sf)
    p = pipelines.freeze_base(spark, files.source_files(spark, folder), f"{folder}/base")
    base = spark.read.parquet(f"{folder}/base")
    pipelines.check(p["fingerprint"] == files.fingerprint(base.repartition("id")), "the fingerprint depends on order")
    return with_digest(base, "id", "origin")


@query(FROZEN + ", n AS (SELECT CAST(count(*) AS BIGINT) AS n_rows, CAST(count_if(coalesce(needs_archive, false)) AS BIGINT) AS n_pending FROM f) SELECT f.id, true AS in_place, n.n_rows, n.n_pending FROM f, n WHERE coalesce(f.needs_archive, false)")
def prepared_run(spark, sf):
    """The shards of a prepared run: each pending row in its own, and the manifest's counts."""
    folder = stored_sources(spark, sf)
    m = pipelines.prepare_run(spark, folder, f"{folder}/runs/r", 8, "r", "now")
    again = pipelines.prepare_run(spark, folder, f"{folder}/runs/r", 8, "r", "later")
    pipelines.check(again == m and sum(m["shard_rows"]) == m["base"]["n_pending"], "the run was prepared anew")
    q = spark.read.parquet(f"{folder}/runs/r/input")
    return q.select("id", (F.col("shard") == rows.shard(F.col("id"), 8)).alias("in_place"), F.lit(m["base"]["n_rows"]).cast("long").alias("n_rows"), F.lit(m["base"]["n_pending"]).cast("long").alias("n_pending"))


@query(ARCHIVE_JOB + "SELECT id, needs_archive, verification_level, n_text, digest, fetch_method, n_trace FROM done")
def archive_all(spark, sf):
    """The whole archive run from the command line: prepare, run, reduce over stored tables."""
    folder, (queue, answers) = shared(spark), archive_inputs(spark, sf)
    files.write_table(queue, f"{folder}/results.parquet")
    answers.write.parquet(f"{folder}/answers")
    cli.main(["all", "--folder", folder, "--answers", f"{folder}/answers", "--shards", "8"], spark)
    pipelines.check(cli.status(spark, f"{folder}/runs/run")["status"] == "completed", "the run did not complete")
    out = spark.read.parquet(f"{folder}/results.parquet")
    digest = F.md5(F.col("text").cast("binary")).alias("digest")
    return out.select("id", "needs_archive", "verification_level", F.length("text").cast("long").alias("n_text"), digest, "fetch_method", F.size(traces.elements(F.col("attempt_trace"))).alias("n_trace"))


@query("SELECT CAST(doc_id AS VARCHAR) AS id FROM documents WHERE doc_id % 2 = 0")
def recovered_table(spark, sf):
    """A commit over a table keeps it as a backup, which takes the place of a damaged one."""
    d, target = table(spark, sf, "documents").select(F.col("doc_id").cast("string").alias("id"), "doc_id"), f"{shared(spark)}/results.parquet"
    for k in (0, 1):
        files.write_table(d.where(F.col("doc_id") % 2 == k).select("id"), f"{target}.staging")
        files.commit(spark, f"{target}.staging", target)
    files.remove(spark, target)
    files.write_text(spark, f"{target}/part-0.parquet", "not a table")
    pipelines.check(files.recover(spark, target) == "restored", "nothing was restored")
    return spark.read.parquet(target)


@query("SELECT count(*) AS n, md5(string_agg(url, chr(10) ORDER BY url)) AS digest, count(*) AS in_arrays, '# failed URLs: ' || count(*) || chr(10) AS header FROM pages WHERE page_id % 5 = 0")
def failed_url_files(spark, sf):
    folder = shared(spark)
    n = files.write_failed_urls(table(spark, sf, "pages").where("page_id % 5 = 0").select("url"), folder, 7)
    t = spark.read.text(f"{folder}/failed_urls_txt/urls")
    arrays = spark.read.text(f"{folder}/failed_urls_json").agg(F.sum(F.json_array_length("value"))).first()[0]
    out = t.agg(F.md5(F.array_join(F.array_sort(F.collect_list("value")), "\n").cast("binary")).alias("digest"))
    return out.select(F.lit(n).cast("long").alias("n"), "digest", F.lit(arrays).cast("long").alias("in_arrays"), F.lit(files.read_text(spark, f"{folder}/failed_urls_txt/header.txt")).alias("header"))


@query("SELECT user_id, count(*) AS n_rows, min(event_id) AS first, 'kept, b' AS tags, 'en' AS language FROM events GROUP BY user_id")
def event_parts(spark, sf):
    """Events through a part writer that reads each part back; metadata merged over the parts."""
    e = table(spark, sf, "events")
    path = shared(spark)
    stream = streams.source(spark, f"{sf}/events.parquet*", e.schema).select("event_id", "user_id")
    streams.flush(stream, streams.append_parts(f"{path}/parts", "event_id"), f"{path}/state").awaitTermination()
    p = files.read_parts(spark, f"{path}/parts").groupBy("user_id").agg(F.count(F.lit(1)).alias("n_rows"), F.min("event_id").alias("first")).withColumn("language", F.lit("en"))
    new = F.struct(F.array(F.lit("kept"), F.lit(None), F.lit("b")).alias("tags"), F.lit(None).cast("string").alias("language"))
    return rows.merged_metadata(p, new, ["tags", "language"])


# The live cascade

#: By the page's number mod 6: 0, found at once; 1, gone, found in the archive; 2, found in the
#: browser; 3, another story's page; 4, failed everywhere, the archive too; 5, saved before.
LIVE = CANDIDATES.replace("CASE WHEN page_id % 3 <> 0 THEN", "CASE WHEN page_id % 6 <> 3 THEN") + """
, b AS (SELECT * FROM j QUALIFY row_number() OVER (PARTITION BY id ORDER BY CASE WHEN verification_level <> 'unverified_text' THEN position END NULLS LAST, n_text DESC, position) = 1),
e AS (SELECT page_id % 6 AS k, b.*, b.verification_level <> 'unverified_text' AS won FROM pages p JOIN b ON b.id = CAST(p.page_id AS VARCHAR))
"""


def live_inputs(spark, sf) -> tuple[DataFrame, DataFrame, DataFrame]:
    p = view(spark, sf, STORY).join(table(spark, sf, "pages").select("page_id", "html"), "page_id")
    k = F.col("page_id") % 6
    stories = p.select("id", "url", F.when(k == 3, "some other story").otherwise(F.col("title")).alias("title"))
    saved = p.where(k == 5).select("id", F.lit("saved").alias("text"), F.lit("page_verified").alias("verification_level"), F.lit(False).alias("needs_archive"), F.lit("ok").alias("scrape_status"), F.lit(False).alias("target_verified"))
    page = {"requests": k.isin(0, 3), "playwright": k == 2, "wayback": k == 1}
    status = {"requests": F.when(k == 1, 404).when(k.isin(2, 4), 500).otherwise(200), "playwright": F.when(k == 2, 200), "wayback": F.when(k == 4, 503).when(k == 1, 200).otherwise(404)}
    one = lambda m: p.select("id", F.lit(m).alias("method"), status[m].cast("int").alias("status"), F.lit(None).cast("string").alias("error"), F.when(page[m], F.col("html")).alias("content"), F.lit(None).cast("string").alias("final_url"))
    return stories, saved, one("requests").unionByName(one("playwright")).unionByName(one("wayback"))


@query(LIVE + """
SELECT id, CASE k WHEN 4 THEN 'fetch_error' ELSE 'ok' END AS scrape_status, CASE k WHEN 0 THEN 'requests' WHEN 1 THEN 'wayback' WHEN 2 THEN 'playwright' WHEN 3 THEN 'requests' END AS fetch_method,
  CASE k WHEN 4 THEN 'no_text' WHEN 5 THEN 'page_verified' ELSE verification_level END AS verification_level, CASE WHEN k < 4 THEN verified_by END AS verified_by, k = 4 AS needs_archive,
  CASE WHEN k = 0 AND won THEN 'requests' WHEN k = 1 THEN 'requests,wayback' WHEN k = 2 AND won THEN 'requests,playwright' WHEN k < 5 THEN 'requests,playwright,wayback' END AS attempted_methods,
  CASE WHEN k < 4 THEN digest WHEN k = 5 THEN md5('saved') END AS digest FROM e
""")
def live_scrape(spark, sf):
    out = live.scrape_and_merge(*live_inputs(spark, sf), "r", "now")
    return out.select("id", "scrape_status", "fetch_method", "verification_level", "verified_by", "needs_archive", "attempted_methods", F.md5(F.col("text").cast("binary")).alias("digest"))


@query("SELECT CAST(page_id AS VARCHAR) AS id, 'fetch_ok' AS scrape_status, CASE page_id % 6 WHEN 1 THEN 'wayback' WHEN 2 THEN 'playwright' ELSE 'requests' END AS fetch_method, CAST(length(html) AS BIGINT) AS html_length, CAST(200 AS BIGINT) AS http_status FROM pages WHERE page_id % 6 < 4")
def fetch_only(spark, sf):
    return live.fetched(*live_inputs(spark, sf), "r", "now").select("id", "scrape_status", "fetch_method", "html_length", "http_status")


@query(WITH_R + "SELECT id, scrape_status FROM r WHERE coalesce(needs_archive, false)")
def pending_scan(spark, sf):
    return queues.pending_scan(result(spark, sf).select("id", "scrape_status", "needs_archive", "text")).select("id", "scrape_status")


@query(WITH_R + "SELECT r.id, l.mark AS country FROM r LEFT JOIN (SELECT CAST(doc_id AS VARCHAR) AS id, 'q' || quality AS mark FROM labels) l ON l.id = r.id")
def result_country(spark, sf):
    known = table(spark, sf, "labels").select(F.col("doc_id").cast("string").alias("key"), F.concat(F.lit("q"), F.col("quality").cast("string")).alias("mark"))
    return rows.lookup(result(spark, sf), known, ("id", "key"), "mark", "country").select("id", "country")


@query(WITH_R + f"SELECT id, CASE WHEN {HT} THEN 'ok' WHEN doc_id % 3 = 0 THEN 'extract_error' ELSE 'fetch_error' END AS status, CASE WHEN {HT} THEN length(text) END AS n_saved FROM r")
def live_final(spark, sf):
    """The end of rows that no attempt was accepted for: their saved fallback, else an error."""
    r = result(spark, sf).select("id", "doc_id", F.col("text").alias("fallback_text"), F.col("fetch_method").alias("fallback_fetch_method"))
    c = acceptance.fallback_candidate()
    return r.select("id", acceptance.live_final(c, F.col("doc_id") % 3 == 0).alias("status"), F.length(c["text"]).cast("long").alias("n_saved"))


# Texts, addresses and made-up pages


@query(r"""SELECT page_id, 'page ' || page_id || chr(10) || 'second & line' AS cleaned, trim(regexp_replace(regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1), '\s+', ' ', 'g')) AS collapsed,
  page_id % 3 = 0 OR page_id % 3 = 1 AS labelled, CASE WHEN starts_with(url, 'https://') THEN substr(url, 9) ELSE url END AS tail, CASE WHEN ends_with(url, '1') THEN substr(url, 1, length(url) - 1) ELSE url END AS head,
  CASE WHEN page_id % 7 >= 2 THEN 'http_' || (page_id % 7 * 100) WHEN page_id % 7 = 0 THEN 'http_0' WHEN page_id % 7 = 1 THEN 'http_100' END AS error, 'news, local' AS joined FROM pages WHERE page_id % 7 <> 2
  UNION ALL SELECT page_id, 'page ' || page_id || chr(10) || 'second & line', trim(regexp_replace(regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1), '\s+', ' ', 'g')), page_id % 3 < 2, CASE WHEN starts_with(url, 'https://') THEN substr(url, 9) ELSE url END, CASE WHEN ends_with(url, '1') THEN substr(url, 1, length(url) - 1) ELSE url END, NULL, 'news, local' FROM pages WHERE page_id % 7 = 2""")
def text_forms(spark, sf):
    p, k = table(spark, sf, "pages"), F.col("page_id")
    raw = F.concat(F.lit("&lt;p&gt; page "), k.cast("string"), F.lit("  &lt;/p&gt;\n \n second &amp;amp; line "))
    label = F.when(k % 3 == 0, "  LÄS mer på Pressen").otherwise("Jetzt weiterlesen")
    around = F.when(k % 3 == 1, "Das Original zu diesem  Beitrag: x")
    title = F.regexp_extract("html", "(?is)<title[^>]*>(.*?)</title>", 1)
    return p.select(
        "page_id", text.clean_structured_text(raw).alias("cleaned"), text.collapse_spaces(title).alias("collapsed"), text.is_source_link(label, around).alias("labelled"),
        text.drop_prefix(F.col("url"), "https://").alias("tail"), text.drop_suffix(F.col("url"), "1").alias("head"), text.http_error(k % 7 * 100).alias("error"), text.joined(F.array(F.lit("news"), F.lit(None), F.lit("local"))).alias("joined"),
    )


@query(f"SELECT page_id, page_id % 3 <> 2 AS same, lower({P(2)}) || '://' || {P(4)} || regexp_replace(regexp_replace({P(5)}, '[^/]*$', ''), '[^/]+/$', '') || 'x?y=1' AS resolved FROM pages")
def url_forms(spark, sf):
    """Equivalence with another form of the address and with another address; relative references."""
    k, url = F.col("page_id") % 3, F.col("url")
    scheme = F.when(k == 0, F.upper(urls.part(url, 2))).otherwise("ftp")
    query_ = F.when(urls.part(url, 7) != "", F.concat(F.lit("?"), urls.part(url, 7))).otherwise("")
    form = F.concat(scheme, F.lit("://user:p@"), urls.part(url, 4), urls.part(url, 5), F.when(k == 1, "///").when(k == 2, "/else").otherwise(""), query_, F.lit("#f"))
    return table(spark, sf, "pages").select("page_id", urls.equivalent(url, form).alias("same"), urls.resolve(url, F.lit("../x?y=1")).alias("resolved"))


@query("SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') || '+00:00' AS stamp FROM events")
def iso_stamps(spark, sf):
    return table(spark, sf, "events").select("event_id", times.iso_utc(F.col("ts")).alias("stamp"))


#: A page with every signal, {n} being its number, and what it must give.
SIGNALS = (
    '<html lang="de"><head><title>T {n}</title><link rel="x canonical" href="/c/{n}"><meta property="og:url" content="http://e.de/o/{n}"><meta property="og:title" content="Og {n}">'
    '<script type="application/LD+JSON"><!-- {{"@graph": [{{"@type": "Person", "name": "P"}}, {{"@type": ["NewsArticle"], "url": {{"@id": " http://e.de/a/{n} "}}, "headline": "Head {n}", "articleBody": "Body &lt;b&gt;{n}&lt;/b&gt;\\n\\n two"}}]}} --></script>'
    '<script type="application/ld+json">{{broken</script></head><body><div itemprop="x articleBody"><p>Item {n}</p></div><nav>no</nav><main><h2>Head  {n}</h2><p>Main {n}</p></main>'
    '<p>Das Original zu diesem Beitrag <a href="http://other.de/s/{n}">hier</a></p></body></html>'
)


def made_pages(spark, sf) -> DataFrame:
    parts = SIGNALS.replace("{{", "{").replace("}}", "}").split("{n}")
    n = F.col("page_id").cast("string")
    page = F.concat(*[x for k, s in enumerate(parts) for x in ([n] if k else []) + [F.lit(s)]])
    x = html.extract_page(page, F.lit("http://e.de/b/"), F.concat(F.lit("head "), n), url=F.concat(F.lit("http://www.e.de/a/"), n, F.lit("/")))
    return table(spark, sf, "pages").select(n.alias("id"), page.alias("html"), x.alias("page"))


@query("""WITH c(position, stage, extract_method, level, verified_by, text) AS (VALUES
  (0, 1, 'jsonld', 'strict_verified', 'jsonld_url+jsonld_headline+jsonld_body', 'Body N' || chr(10) || 'two'), (1, 2, 'itemprop', 'unverified_text', NULL, 'Item N'),
  (2, 4, 'trafilatura_scoped', 'strict_verified', 'scoped_title+semantic_body', 'Head  N' || chr(10) || 'Main N'),
  (3, 5, 'trafilatura', 'page_verified', 'structured_url+structured_title+whole_page', 'Item N' || chr(10) || 'Head  N' || chr(10) || 'Main N' || chr(10) || 'Das Original zu diesem Beitrag hier'))
SELECT CAST(page_id AS VARCHAR) AS id, position, stage, extract_method, level, verified_by, replace(text, 'N', CAST(page_id AS VARCHAR)) AS text FROM pages, c""")
def signal_candidates(spark, sf):
    return acceptance.judged(made_pages(spark, sf)).select("id", "position", "stage", "extract_method", F.col("verification_level").alias("level"), "verified_by", "text")


@query("""SELECT CAST(page_id AS VARCHAR) AS id, 'http://e.de/c/' || page_id AS canonical_url, 'http://e.de/o/' || page_id AS og_url, 'Og ' || page_id AS og_title, 'T ' || page_id AS page_title,
  'http://other.de/s/' || page_id AS source_article_url, 'http://e.de/a/' || page_id AS structured_url, 'Head ' || page_id AS structured_title, 'e.de' AS hostname, 'de' AS language FROM pages""")
def page_signals(spark, sf):
    names = ["canonical_url", "og_url", "og_title", "page_title", "source_article_url", "structured_url", "structured_title"]
    return made_pages(spark, sf).select("id", *[f"page.{c}" for c in names], F.col("page.traf_hostname").alias("hostname"), F.col("page.traf_language").alias("language"))


@query("""SELECT CAST(page_id AS VARCHAR) AS id, position, CASE position WHEN 1 THEN 'Person' WHEN 2 THEN 'NewsArticle' END AS type, CASE WHEN position = 2 THEN 'Head ' || page_id END AS headline FROM pages, (VALUES (0), (1), (2), (3)) v(position)""")
def jsonld_rows(spark, sf):
    """Every object of the pages' JSON-LD by the table function: graph, person, article, address."""
    spark.udtf.register("jsonld_objects", html.jsonld_objects)
    out = spark.sql("SELECT id, o.* FROM {p}, LATERAL jsonld_objects(html) o", p=made_pages(spark, sf).select("id", "html"))
    return out.select("id", "position", "type", F.get_json_object("object", "$.headline").alias("headline"))


# Streams


def attempts_stream(spark, sf) -> DataFrame:
    e = table(spark, sf, "events")
    s = streams.source(spark, f"{sf}/events.parquet*", e.schema)
    return spark.sql(ATTEMPT.replace("FROM events", "FROM {events}").replace("event_id, ts,", "event_id, CAST(ts AS TIMESTAMP) AS ts,", 1), events=s)


@query(BREAKER)
def stream_breaker(spark, sf):
    """The breaker as keyed state of a stream; a replayed batch writes the same file again."""
    a = attempts_stream(spark, sf)
    e = a.select("endpoint", "event_id", (F.unix_micros("ts") / 1e6).alias("ts"), (~traces.healthy(F.col("status"), F.col("error"), F.lit(True))).alias("failure"), F.col("success").alias("content"))
    path = shared(spark)
    out = streams.breaker_stream(e, provider.Breaker(failures=2, pause_s=3600, probe_pause_s=7200))
    out.writeStream.format("parquet").option("checkpointLocation", f"{path}/state").option("path", f"{path}/out").trigger(availableNow=True).start().awaitTermination()
    return spark.read.parquet(f"{path}/out")


@query("SELECT user_id, arg_max(event_id, (ts, event_id)) AS event_id, arg_max(event_type, (ts, event_id)) AS event_type FROM events GROUP BY user_id")
def stream_restart(spark, sf):
    """The upsert, started again for each of three files that arrive one by one."""
    e, path = table(spark, sf, "events"), shared(spark)
    for k in range(3):
        e.where(F.col("event_id") % 3 == k).write.mode("append").parquet(f"{path}/in")
        stream = streams.source(spark, f"{path}/in", e.schema)
        out = streams.run_upsert(stream.select("user_id", "ts", "event_id", "event_type"), f"{path}/table", f"{path}/state", "user_id", ["ts", "event_id"])
    return out.select("user_id", "event_id", "event_type")


@query("SELECT count(*) AS n_rows, CAST(sum(length(text)) AS BIGINT) AS n_points, 'prepared' AS status FROM documents")
def manifest_file(spark, sf):
    """A small JSON file written whole and read back with a table's totals."""
    path = f"{shared(spark)}/manifest.json"
    d = table(spark, sf, "documents").agg(F.count(F.lit(1)).alias("n_rows"), F.sum(F.length("text")).alias("n_points")).first()
    files.write_json(spark, path, d.asDict() | {"status": "prepared"})
    m = json.loads(files.read_text(spark, path))
    return files.from_rows(spark, [m], "n_rows long, n_points long, status string")

