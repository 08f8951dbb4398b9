"""One query per operator of the inventory. QUERIES: name to function; ORACLES: name to SQL."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salvor.functions import html, text, times, traces, urls
from salvor.operators import acceptance, archive, levels, metrics, provider, queues, rows
from salvor.plans import archive_run as archives
from salvor.plans import pipelines
from salvor.queries.views import ATTEMPT, CANONICAL, CHECKPOINT, RESULT, STORY, TRACE, table, view
from salvor.schema import FAILED_STATUSES
from salvor.streaming import streams

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


SP = r"[\s\x1c-\x1f\x85\p{Z}]"
HAS = rf"(regexp_replace(coalesce({{0}}, ''), '^{SP}+|{SP}+$', '', 'g') <> '')"
HT = HAS.replace("{0}", "text")
WITH_R = f"WITH r AS ({RESULT}) "
WITH_S = f"WITH c AS ({CANONICAL}), k AS ({CHECKPOINT}), s AS (SELECT * FROM c UNION ALL SELECT * FROM k) "
QUALITY = f"CASE verification_level WHEN 'strict_verified' THEN 3 WHEN 'page_verified' THEN 2 WHEN 'unverified_text' THEN 1 WHEN 'no_text' THEN 0 ELSE CASE WHEN coalesce(target_verified, false) THEN 3 WHEN {HT} THEN 1 ELSE 0 END END"


def result(spark, sf):
    return view(spark, sf, RESULT)


def sources(spark, sf) -> list[DataFrame]:
    out = []
    for sql in (CANONICAL, CHECKPOINT):
        v = view(spark, sf, sql).withColumn("__position", F.col("doc_id"))
        out.append(v.withColumnsRenamed({"src_rank": "__source_rank", "src_mtime": "__source_mtime", "is_canonical": "__canonical"}))
    return out


def slim(df: DataFrame, *more: str) -> DataFrame:
    return df.select("id", "origin", "verification_level", text.code_points(F.col("text")).alias("n_text"), *more)


# Profiles, expressions, legacy back-fill


@query(WITH_R + f"SELECT count(*) AS n_rows, CAST(count(DISTINCT id) AS BIGINT) AS n_ids, CAST(count_if({HT}) AS BIGINT) AS n_text, CAST(count_if(coalesce(needs_archive, false)) AS BIGINT) AS n_pending, CAST(count_if(fetch_method = 'wayback') AS BIGINT) AS n_wayback FROM r")
def nonblank_profile(spark, sf):
    return rows.profile(result(spark, sf))


@query(WITH_R + f", q AS (SELECT *, {QUALITY} AS quality FROM r) SELECT id, quality, CASE WHEN quality = 1 THEN CAST(length(coalesce(text, '')) AS BIGINT) ELSE 0 END AS unverified_length FROM q")
def quality_rank(spark, sf):
    r = result(spark, sf).withColumn("quality", levels.quality(F.col("verification_level"), F.col("target_verified"), F.col("text")))
    return r.select("id", "quality", levels.unverified_length(F.col("quality"), F.col("text")).alias("unverified_length"))


@query("SELECT doc_id AS id, CAST(n_chars AS VARCHAR) AS n_chars, lang AS mark, CAST(NULL AS VARCHAR) AS toxic FROM documents UNION ALL BY NAME SELECT doc_id AS id, CAST(quality AS VARCHAR) AS mark, CAST(toxic AS VARCHAR) AS toxic FROM labels")
def relaxed_union(spark, sf):
    a = table(spark, sf, "documents").select(F.col("doc_id").alias("id"), "n_chars", F.col("lang").alias("mark"))
    b = table(spark, sf, "labels").select(F.col("doc_id").cast("int").alias("id"), F.col("quality").alias("mark"), F.col("toxic").cast("int").alias("toxic"))
    return rows.relaxed_union(a, b).withColumns({c: F.col(c).cast("string") for c in ("n_chars", "toxic")})


@query(WITH_R + f"SELECT id, scrape_status AS old_status, CASE WHEN {HT} AND scrape_status IN ('ok_low_confidence', 'false_positive') THEN 'ok' ELSE scrape_status END AS new_status FROM r")
def status_rewrite(spark, sf):
    return result(spark, sf).select("id", F.col("scrape_status").alias("old_status"), levels.rewrite_status(F.col("scrape_status"), F.col("text")).alias("new_status"))


@query(WITH_R + f"SELECT id, coalesce(verification_level, CASE WHEN coalesce(target_verified, false) THEN 'strict_verified' WHEN {HT} THEN 'unverified_text' ELSE 'no_text' END) AS verification_level, coalesce(target_verified, false) AS target_verified, scrape_status = 'fetch_error' AND NOT {HT} AS needs_archive FROM r")
def level_fill(spark, sf):
    return levels.backfill(result(spark, sf).drop("needs_archive")).select("id", "verification_level", "target_verified", "needs_archive")


@query(WITH_R + f"SELECT id, scrape_status = 'ok' AND coalesce(verification_level IN ('page_verified', 'strict_verified'), false) AND {HT} AS terminal, {HT} AND CASE WHEN verification_level IS NULL THEN NOT coalesce(target_verified, false) ELSE verification_level = 'unverified_text' END AS unverified, fetch_method = 'wayback' AND {HT} AS control, CASE WHEN doc_id % 29 = 0 THEN 'hard_timeout' WHEN doc_id % 3 = 0 THEN 'fetch_failed' WHEN scrape_status = 'ok' AND coalesce(verification_level IN ('page_verified', 'strict_verified'), false) AND {HT} THEN 'accepted' WHEN {HT} THEN 'unverified_text' ELSE 'no_text' END AS outcome FROM r")
def row_predicates(spark, sf):
    status, level, verified, t = (F.col(c) for c in ("scrape_status", "verification_level", "target_verified", "text"))
    terminal = levels.is_terminal(status, level, t)
    error = F.when(F.col("doc_id") % 29 == 0, "playwright_hard_timeout")
    return result(spark, sf).select("id", terminal.alias("terminal"), levels.is_unverified(level, verified, t).alias("unverified"), levels.is_control(F.col("fetch_method"), t).alias("control"), levels.browser_outcome(error, F.col("doc_id") % 3 != 0, t, terminal).alias("outcome"))


@query("SELECT CAST(page_id AS VARCHAR) AS id, 'fetch_error' AS scrape_status, 'no_text' AS verification_level, false AS target_verified, true AS needs_archive, CAST(NULL AS BIGINT) AS http_status, CAST(NULL AS VARCHAR) AS traf_title FROM pages")
def row_template(spark, sf):
    out = levels.from_template(view(spark, sf, STORY), {"scrape_status": F.lit("fetch_error"), "needs_archive": F.lit(True)})
    return rows.align(rows.concrete(out), ["id", "scrape_status", "verification_level", "target_verified", "needs_archive", "http_status", "traf_title"])


# Keep-last policies and upserts


@query(WITH_S + f"SELECT id, origin, verification_level, CAST(length(coalesce(text, '')) AS BIGINT) AS n_text FROM s QUALIFY row_number() OVER (PARTITION BY id ORDER BY {HT} DESC, src_rank DESC, doc_id DESC) = 1")
def keep_last_text_then_rank(spark, sf):
    both = rows.relaxed_union(*sources(spark, sf)).withColumn("__has_text", text.has_text(F.col("text")))
    return slim(rows.by_policy(both, "text_then_rank", "__position"))


@query(WITH_S + f", q AS (SELECT *, {QUALITY} AS quality FROM s) SELECT id, origin, coalesce(verification_level, CASE WHEN coalesce(target_verified, false) THEN 'strict_verified' WHEN {HT} THEN 'unverified_text' ELSE 'no_text' END) AS verification_level, CAST(length(coalesce(text, '')) AS BIGINT) AS n_text FROM q QUALIFY row_number() OVER (PARTITION BY id ORDER BY quality DESC, CASE WHEN quality = 1 THEN length(coalesce(text, '')) ELSE 0 END DESC, src_mtime DESC, is_canonical DESC, src_rank DESC, doc_id DESC) = 1")
def keep_last_quality_recency(spark, sf):
    return slim(pipelines.frozen(sources(spark, sf), wide=False))  # views, not stored tables


@query(WITH_S + "SELECT id, origin, verification_level, CAST(length(coalesce(text, '')) AS BIGINT) AS n_text FROM s QUALIFY row_number() OVER (PARTITION BY id ORDER BY src_rank DESC) = 1")
def base_delta_upsert(spark, sf):
    base, delta = sources(spark, sf)
    return slim(rows.upsert(base, delta))


@query(WITH_S + f", q AS (SELECT *, {QUALITY} AS quality FROM s WHERE coalesce(needs_archive, false)) SELECT id, origin, verification_level, CAST(length(coalesce(text, '')) AS BIGINT) AS n_text FROM q QUALIFY row_number() OVER (PARTITION BY id ORDER BY quality DESC, length(coalesce(text, '')) DESC, src_rank DESC) = 1")
def best_deferred(spark, sf):
    parts = rows.relaxed_union(*sources(spark, sf)).where("needs_archive")
    parts = parts.withColumns({"__part": F.col("__source_rank"), "__pos": F.col("__position")})
    return slim(rows.best_deferred(parts, levels.quality(F.col("verification_level"), F.col("target_verified"), F.col("text"))))


@query(WITH_S + f"SELECT id, origin, verification_level, CAST(length(coalesce(text, '')) AS BIGINT) AS n_text, md5(coalesce(text, '')) AS digest FROM s QUALIFY row_number() OVER (PARTITION BY id ORDER BY {HT} DESC, src_rank DESC, doc_id DESC) = 1")
def keep_last_wide(spark, sf):
    both = rows.relaxed_union(*sources(spark, sf)).withColumn("__has_text", text.has_text(F.col("text")))
    out = rows.by_policy(both, "text_then_rank", "__position", wide=True)
    return slim(out.select("*", F.md5(F.coalesce("text", F.lit("")).cast("binary")).alias("digest")), "digest")


# Queues, limits, shards, samples


@query("SELECT CAST(d.doc_id AS VARCHAR) AS id FROM documents d WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)")
def live_queue_anti(spark, sf):
    d = table(spark, sf, "documents").select(F.col("doc_id").cast("string").alias("id"))
    return queues.live_queue(d, table(spark, sf, "labels").select(F.col("doc_id").cast("string").alias("id")))


@query(WITH_R + "SELECT id, scrape_status FROM r WHERE coalesce(needs_archive, false) AND id IN (SELECT CAST(doc_id AS VARCHAR) FROM documents WHERE lang = 'en')")
def archive_queue_semi(spark, sf):
    stories = table(spark, sf, "documents").where("lang = 'en'").select(F.col("doc_id").cast("string").alias("id"))
    return queues.archive_queue(stories, result(spark, sf).select("id", "scrape_status", "needs_archive", "text")).select("id", "scrape_status")


@query(WITH_R + f"SELECT id, scrape_status = 'fetch_error' AND NOT {HT} AS legacy_pending, coalesce(needs_archive, false) AS flagged_pending FROM r")
def pending_flag(spark, sf):
    r = result(spark, sf)
    return r.select("id", levels.pending(r.drop("needs_archive")).alias("legacy_pending"), levels.pending(r).alias("flagged_pending"))


@query(WITH_R + ", t AS (SELECT id, 0 AS tier FROM r WHERE scrape_status = 'exception' UNION ALL SELECT id, 1 FROM r WHERE coalesce(needs_archive, false)) SELECT id, tier FROM t ORDER BY tier, id LIMIT 150")
def two_tier_limit(spark, sf):
    r = result(spark, sf).select("id", "scrape_status", "needs_archive")
    return rows.two_tier_limit(r.where("scrape_status = 'exception'").select("id"), r.where("needs_archive").select("id"), 150, "id")


MD5 = "CAST('0x' || substr(md5({0}), 1, 8) AS BIGINT)"


@query("WITH h AS (SELECT CAST(" + MD5.format("'20260807:' || doc_id") + " % 64 AS INTEGER) AS shard FROM documents) SELECT CAST(g.shard AS INTEGER) AS shard, count(h.shard) AS n_rows FROM range(64) g(shard) LEFT JOIN h ON h.shard = g.shard GROUP BY g.shard")
def hash_shard_counts(spark, sf):
    return rows.shard_counts(table(spark, sf, "documents").select(F.col("doc_id").cast("string").alias("id")), 64, portable=True)


@query("SELECT CAST(doc_id AS VARCHAR) AS id, n_chars FROM documents ORDER BY " + MD5.format("'7:' || doc_id") + ", CAST(doc_id AS VARCHAR) LIMIT 100")
def hash_sample(spark, sf):
    return rows.hash_sample(table(spark, sf, "documents").select(F.col("doc_id").cast("string").alias("id"), "n_chars"), 100, 7)


@query(WITH_R + f", a AS (SELECT id, 'control' AS sample_group FROM r WHERE fetch_method = 'wayback' AND {HT} ORDER BY {MD5.format(chr(39) + '11:' + chr(39) + ' || id')}, id LIMIT 10), b AS (SELECT id, 'pending' AS sample_group FROM r WHERE coalesce(needs_archive, false) ORDER BY {MD5.format(chr(39) + '11:' + chr(39) + ' || id')}, id LIMIT 20) SELECT * FROM a UNION ALL SELECT * FROM b")
def stratified_sample(spark, sf):
    r = result(spark, sf)
    strata = {"control": r.where(levels.is_control(F.col("fetch_method"), F.col("text"))).select("id"), "pending": r.where(levels.pending(r)).select("id")}
    return rows.stratified_sample(strata, {"control": 10, "pending": 20}, 11)


@query("SELECT CAST(p.page_id AS VARCHAR) AS id, s.strategy, " + MD5.format("'5:' || p.page_id || ':' || s.strategy") + " AS job_order FROM pages p, (VALUES ('direct'), ('availability'), ('cdx')) s(strategy)")
def strategy_jobs(spark, sf):
    return rows.strategy_jobs(view(spark, sf, STORY).select("id"), ["direct", "availability", "cdx"], 5)


# Filters and look-ups


@query("SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS order_date FROM orders WHERE CAST(o_orderdate AS TIMESTAMP) BETWEEN TIMESTAMP '1995-01-01' AND TIMESTAMP '1996-12-31'")
def date_filter(spark, sf):
    o = table(spark, sf, "orders")
    return o.where(levels.between_dates(F.col("o_orderdate"), "1995-01-01", "1996-12-31")).select("o_orderkey", F.date_format("o_orderdate", "yyyy-MM-dd").alias("order_date"))


@query("SELECT c.c_custkey, n.n_name AS country FROM customer c LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey")
def country_lookup(spark, sf):
    out = rows.lookup(table(spark, sf, "customer"), table(spark, sf, "nation"), ("c_nationkey", "n_nationkey"), "n_name", "country")
    return out.select("c_custkey", "country")


@query("SELECT CAST(doc_id AS VARCHAR) AS id, CASE WHEN source IN ('src1', 'src3', 'src5', 'src7', 'src9') THEN 'Sweden' ELSE 'Germany' END AS country FROM documents WHERE source IS NOT NULL")
def country_map(spark, sf):
    stories = table(spark, sf, "documents").where("source is not null").select(F.col("doc_id").cast("string").alias("id"), F.col("source").alias("media_name"))
    odd = F.col("media_name").isin("src1", "src3", "src5", "src7", "src9")
    dimension = stories.select(F.col("media_name").alias("source_name"), F.when(odd, "Sweden").otherwise("Germany").alias("country")).distinct()
    return pipelines.country_by_id(stories, dimension)


@query("SELECT source AS source_name, count(DISTINCT lang) AS n_countries FROM documents WHERE source IS NOT NULL AND lang IS NOT NULL GROUP BY source HAVING count(DISTINCT lang) > 1")
def ambiguous_sources(spark, sf):
    return metrics.ambiguous_sources(table(spark, sf, "documents").select(F.col("lang").alias("country"), F.col("source").alias("source_name")))


@query("SELECT l_orderkey, count(*) AS n_rows FROM lineitem GROUP BY l_orderkey HAVING count(*) > 1")
def duplicate_ids(spark, sf):
    return metrics.duplicate_keys(table(spark, sf, "lineitem"), "l_orderkey")


@query("SELECT DISTINCT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def missing_keys(spark, sf):
    return rows.missing_keys(table(spark, sf, "documents"), table(spark, sf, "labels"), "doc_id")


@query("SELECT CAST(page_id AS VARCHAR) AS id, url FROM pages WHERE page_id % 5 IN (0, 1, 3)")
def failed_urls(spark, sf):
    status = F.when(F.col("page_id") % 5 == 0, "extract_error").when(F.col("page_id") % 5 == 1, "exception").when(F.col("page_id") % 5 == 3, "fetch_error").otherwise("ok")
    return view(spark, sf, STORY).withColumn("scrape_status", status).where(F.col("scrape_status").isin(*FAILED_STATUSES) & F.col("url").isNotNull()).select("id", "url")


# Statistics

COUNTS = "count(*) AS final, {c}(scrape_status = 'ok') AS recovered, {v} AS verified, {c}(lv = 'strict_verified') AS strict_verified, {c}(lv = 'page_verified') AS page_verified, {c}(lv = 'unverified_text') AS unverified_text, {c}(lv = 'no_text') AS no_text, {c}(scrape_status = 'ok' AND text_length < 500) AS short_text, {c}(scrape_status = 'fetch_error') AS fetch_error, {c}(scrape_status = 'extract_error') AS extract_error, {c}(scrape_status = 'exception') AS exception"
OUT = ["final", "recovered", "verified", "strict_verified", "page_verified", "unverified_text", "no_text", "short_text", "fetch_error", "extract_error", "exception"]
CAST = ", ".join(f"CAST({c} AS BIGINT) AS {c}" for c in OUT)
CAST0 = ", ".join(f"CAST(coalesce({c}, 0) AS BIGINT) AS {c}" for c in OUT)
BY_LEVEL = COUNTS.format(c="count_if", v="count_if(lv IN ('strict_verified', 'page_verified'))")


@query(WITH_R + f", n AS (SELECT *, coalesce(verification_level, 'no_text') AS lv FROM r) SELECT {CAST} FROM (SELECT {BY_LEVEL} FROM n)")
def outcome_stats(spark, sf):
    return metrics.outcome_stats(result(spark, sf))


@query(WITH_R + f", n AS (SELECT *, coalesce(verification_level, 'no_text') AS lv FROM r), g AS (SELECT CASE WHEN grouping(country) = 1 THEN 'overall' ELSE country END AS scope, {BY_LEVEL} FROM n GROUP BY GROUPING SETS ((country), ())) SELECT d.scope, {CAST0} FROM (VALUES ('overall'), ('Sweden'), ('Germany')) d(scope) LEFT JOIN g ON g.scope = d.scope")
def outcome_stats_by_country(spark, sf):
    return metrics.outcome_stats_by_country(result(spark, sf))


@query(WITH_R + "SELECT d.fetch_method, count(r.id) AS n_recovered FROM (VALUES ('requests'), ('playwright'), ('wayback')) d(fetch_method) LEFT JOIN r ON r.fetch_method = d.fetch_method AND r.scrape_status = 'ok' GROUP BY d.fetch_method")
def recovered_by_method(spark, sf):
    return metrics.recovered_by_method(result(spark, sf))


@query(WITH_R + f"SELECT {CAST} FROM (SELECT {COUNTS.format(c='count_if', v='count_if(coalesce(target_verified, false))').replace('lv', chr(39) + 'none' + chr(39))} FROM r)")
def skip_scrape_summary(spark, sf):
    return pipelines.summary(result(spark, sf))


@query(WITH_R + "SELECT coalesce(verification_level, 'no_text') AS verification_level, count(*) AS n_rows FROM r GROUP BY 1")
def level_counts(spark, sf):
    return metrics.value_counts(result(spark, sf), "verification_level", "no_text")


@query(WITH_R + "SELECT scrape_status, count(*) AS n_rows FROM r GROUP BY 1")
def status_counts(spark, sf):
    return metrics.value_counts(result(spark, sf), "scrape_status")


# URLs, texts, times

U = r"'^(([^:/?#]+):)?(//([^/?#]*))?([^?#]*)(\?([^#]*))?(#(.*))?'"


def P(k: int) -> str:
    return f"regexp_extract(url, {U}, {k})"


@query(f"WITH p AS (SELECT page_id, lower({P(2)}) AS scheme, regexp_replace(regexp_replace(lower({P(4)}), '^.*@', ''), '^www[.]', '') AS net, {P(5)} AS path, {P(7)} AS query FROM pages) SELECT CAST(page_id AS VARCHAR) AS id, CASE WHEN (scheme = 'http' AND regexp_matches(net, ':80$')) OR (scheme = 'https' AND regexp_matches(net, ':443$')) THEN regexp_replace(net, ':[0-9]*$', '') ELSE net END || ' ' || CASE WHEN path IN ('', '/') THEN '/' ELSE regexp_replace(path, '/+$', '') END || ' ' || query AS identity FROM p")
def url_identity(spark, sf):
    return view(spark, sf, STORY).select("id", urls.identity(F.col("url")).alias("identity"))


@query(f"WITH p AS (SELECT page_id, {P(2)} AS scheme, {P(4)} AS net, {P(5)} AS path, {P(7)} AS query FROM pages), v AS (SELECT page_id, [lower(scheme) || '://' || net || path || CASE WHEN query <> '' THEN '?' || query ELSE '' END, CASE WHEN lower(scheme) = 'https' THEN 'http://' || net || path || CASE WHEN query <> '' THEN '?' || query ELSE '' END END, CASE WHEN query <> '' THEN lower(scheme) || '://' || net || path END] AS forms FROM p) SELECT CAST(page_id AS VARCHAR) AS id, array_to_string(list_filter(forms, lambda x: x IS NOT NULL), ' ') AS variants FROM v")
def url_variants(spark, sf):
    return view(spark, sf, STORY).select("id", F.array_join(urls.archive_variants(F.col("url")), " ").alias("variants"))


D = r"'([0-9]{4})[-/]?([0-9]{2})[-/]?([0-9]{2})(?:[T\s]?([0-9]{2}):?([0-9]{2})?:?([0-9]{2})?)?'"
DIGITS = " || ".join(f"CASE WHEN regexp_extract(v, {D}, {k}) = '' THEN '00' ELSE regexp_extract(v, {D}, {k}) END" for k in range(1, 7))


@query(f"WITH o AS (SELECT o_orderkey, CASE o_orderkey % 4 WHEN 0 THEN 'on ' || strftime(o_orderdate, '%Y/%m/%d') WHEN 1 THEN strftime(o_orderdate, '%Y-%m-%d') || 'T12:34' WHEN 2 THEN '2020-13-45' ELSE 'none' END AS v FROM orders) SELECT o_orderkey, CASE WHEN regexp_extract(v, {D}, 1) <> '' THEN strftime(try_strptime({DIGITS}, '%Y%m%d%H%M%S'), '%Y%m%d%H%M%S') END AS published FROM o")
def publication_timestamp(spark, sf):
    day = lambda p: F.date_format("o_orderdate", p)
    v = F.when(F.col("o_orderkey") % 4 == 0, F.concat(F.lit("on "), day("yyyy/MM/dd"))).when(F.col("o_orderkey") % 4 == 1, F.concat(day("yyyy-MM-dd"), F.lit("T12:34"))).when(F.col("o_orderkey") % 4 == 2, "2020-13-45").otherwise("none")
    return table(spark, sf, "orders").select("o_orderkey", times.publication_timestamp(v).alias("published"))


RETRY = "CASE event_id % 4 WHEN 0 THEN floor(abs(value)) WHEN 1 THEN epoch(date_trunc('second', ts)) - epoch(TIMESTAMP '2024-01-10 12:00:00') WHEN 2 THEN 0 ELSE -floor(abs(value)) END"


@query(f"SELECT event_id, CAST(least(1000000000, greatest(0, coalesce({RETRY}, 0))) AS DOUBLE) AS raw, CAST(least(120, greatest(0, coalesce({RETRY}, 0))) AS DOUBLE) AS wait FROM events")
def retry_after(spark, sf):
    """Headers made of the events: a number, an HTTP date, words, a negative number."""
    now, e = F.to_timestamp(F.lit("2024-01-10 12:00:00")), table(spark, sf, "events")
    k, number = F.col("event_id") % 4, F.floor(F.abs("value")).cast("string")
    date = F.concat(F.date_format("ts", "EEE, dd MMM yyyy HH:mm:ss"), F.lit(" GMT"))
    value = F.when(k == 0, number).when(k == 1, date).when(k == 2, F.col("event_type")).otherwise(F.concat(F.lit("-"), number))
    return e.select("event_id", times.retry_after(value, now, 1e9).alias("raw"), times.retry_after(value, now, 120).alias("wait"))


@query("SELECT CAST(page_id AS VARCHAR) AS id, 'http://web.archive.org/web/20200102000000id_/' || url AS replay, '20200102000000' AS stamp, '2020-01-02' AS crawl_date FROM pages")
def replay_address(spark, sf):
    s = view(spark, sf, STORY)
    s = s.withColumn("replay", urls.replay_url(F.lit("20200102000000"), F.col("url"), "http://web.archive.org"))
    return s.select("id", "replay", urls.capture_timestamp(F.col("replay")).alias("stamp"), times.crawl_date(urls.capture_timestamp(F.col("replay"))).cast("string").alias("crawl_date"))


@query(WITH_R + "SELECT id, fetch_method || ',,wayback' AS before, fetch_method || ',wayback,wayback' AS after FROM r")
def method_append(spark, sf):
    r = result(spark, sf).withColumn("before", F.concat("fetch_method", F.lit(",,wayback")))
    return r.select("id", "before", text.append_method(F.col("before"), "wayback").alias("after"))


RAW_TITLE = TITLE = "regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1)"
for entity, char in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "''"), ("&#x27;", "''"), ("&nbsp;", " "), ("&amp;", "&"), ("&amp", "&")):
    TITLE = f"replace({TITLE}, '{entity}', '{char}')"
TITLE = f"trim(regexp_replace({TITLE}, '\\s+', ' ', 'g'))"


@query(f"SELECT CAST(page_id AS VARCHAR) AS id, replace(lower(nfc_normalize({TITLE})), 'ß', 'ss') AS title FROM pages")
def page_title_norm(spark, sf):
    return view(spark, sf, STORY).select("id", text.normalize_title(F.col("title")).alias("title"))


# Extraction and acceptance

#: The body candidates of a page in SQL: comments and skipped elements go, block tags end lines,
#: other tags go, entities stand for their characters, and lines are trimmed. WHOLE is the text
#: outside navigation, SCOPED that of the one article.
BLOCK = "address|article|aside|blockquote|br|div|dl|dt|dd|fieldset|figure|footer|form|h[1-6]|header|hr|li|main|nav|ol|p|pre|section|table|tr|ul"


def _drop(text: str, *tags: str) -> str:
    for tag in tags:
        text = f"regexp_replace({text}, '(?is)<{tag}\\b[^>]*>.*?</{tag}\\s*>', '', 'g')"
    return text


def _lines(text: str) -> str:
    text = f"regexp_replace(regexp_replace({text}, '(?i)</?({BLOCK})\\b[^>]*>', chr(10), 'g'), '<[^>]*>', '', 'g')"
    for entity, char in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "''"), ("&nbsp;", " "), ("&copy;", "©"), ("&middot;", "·"), ("&amp;", "&")):
        text = f"replace({text}, '{entity}', '{char}')"
    return f"array_to_string(list_filter(list_transform(string_split({text}, chr(10)), lambda x: trim(x, ' ' || chr(9) || chr(13))), lambda x: x <> ''), chr(10))"


BARE = _drop("regexp_replace(html, '(?s)<!--.*?-->', '', 'g')", "script", "style", "noscript", "template", "svg")
SCOPED = _lines(_drop(f"regexp_extract({BARE}, '(?is)<article\\b[^>]*>(.*)</article\\s*>', 1)", "nav", "header", "footer", "aside", "form", "button"))
WHOLE = _lines(_drop(BARE, "nav", "header", "footer", "aside", "form", "button", "head", "title"))
HEADS = f"list_transform(regexp_extract_all(html, '(?is)<h[12]\\b[^>]*>(.*?)</h[12]>', 1), lambda x: {TITLE.replace(RAW_TITLE, 'x')})"
#: Pages, a title asked for (another story's for every third), and both candidates with their signals.
CANDIDATES = f"""
WITH p AS (SELECT page_id, html, {TITLE} AS own, CASE WHEN page_id % 3 <> 0 THEN {TITLE} ELSE 'some other story' END AS wanted, {HEADS} AS heads FROM pages),
c AS (
  SELECT page_id, 'trafilatura_scoped' AS extract_method, 'semantic_body' AS body, {SCOPED} AS text, own = wanted AND wanted <> '' AS titled, wanted <> '' AND list_contains(heads, wanted) AS headed FROM p
  UNION ALL SELECT page_id, 'trafilatura', 'whole_page', {WHOLE}, own = wanted AND wanted <> '', false FROM p
),
j AS (
  SELECT CAST(page_id AS VARCHAR) AS id, CAST(row_number() OVER (PARTITION BY page_id ORDER BY body) - 1 AS INTEGER) AS position, extract_method,
    CASE WHEN headed THEN 'strict_verified' WHEN titled THEN 'page_verified' ELSE 'unverified_text' END AS verification_level,
    CASE WHEN titled OR headed THEN CASE WHEN titled THEN 'trafilatura_title+' ELSE '' END || CASE WHEN headed THEN 'scoped_title+' ELSE '' END || body END AS verified_by,
    CAST(length(text) AS BIGINT) AS n_text, md5(text) AS digest
  FROM c WHERE text <> ''
)
"""


def judged_pages(spark, sf):
    p = table(spark, sf, "pages").withColumn("title", F.regexp_extract("html", "(?is)<title[^>]*>(.*?)</title>", 1))
    title = F.when(F.col("page_id") % 3 != 0, F.col("title")).otherwise("some other story")
    p = p.select(F.col("page_id").cast("string").alias("id"), "url", "html", title.alias("title"))
    return p.select("id", html.extract_page(F.col("html"), F.col("url"), F.col("title")).alias("page"))


def candidate_columns() -> list:
    return ["id", "position", "extract_method", "verification_level", "verified_by", F.length("text").cast("long").alias("n_text"), F.md5(F.col("text").cast("binary")).alias("digest")]


@query(CANDIDATES + "SELECT * FROM j")
def page_candidates(spark, sf):
    return acceptance.judged(judged_pages(spark, sf)).select(*candidate_columns())


@query(f"SELECT CAST(page_id AS VARCHAR) AS id, {TITLE} AS page_title, lower(regexp_extract(html, '(?i)<html[^>]* lang=\"([^\"]*)', 1)) AS language, regexp_replace(regexp_replace(lower({P(4)}), ':[0-9]*$', ''), '^www[.]', '') AS hostname, CAST(NULL AS VARCHAR) AS canonical_url, {P(4)} AS target_host, len(regexp_extract_all(html, '(?i)<article[\\s>]')) = 1 AS scoped FROM pages")
def page_extract(spark, sf):
    x = html.extract_page(F.col("html"), F.col("url"), F.lit(None).cast("string"))
    p = table(spark, sf, "pages").select(F.col("page_id").cast("string").alias("id"), "url", x.alias("x"))
    scoped = F.exists("x.candidates", lambda c: c["extract_method"] == "trafilatura_scoped")
    return p.select("id", "x.page_title", F.lower("x.traf_language").alias("language"), F.col("x.traf_hostname").alias("hostname"), "x.canonical_url", urls.part(F.col("url"), 4).alias("target_host"), scoped.alias("scoped"))


@query(CANDIDATES + "SELECT id, extract_method, verification_level, verified_by, n_text, digest FROM j QUALIFY row_number() OVER (PARTITION BY id ORDER BY CASE WHEN verification_level <> 'unverified_text' THEN position END NULLS LAST, n_text DESC, position) = 1")
def identity_level(spark, sf):
    """A page's own title identifies it; another story's does not."""
    best = judged_pages(spark, sf).select("id", acceptance.chosen(acceptance.judged_candidates(F.col("page")))["best"].alias("x"))
    found = F.filter(F.array("x"), lambda c: c.isNotNull())  # a page without text has no candidate
    return best.select("id", F.inline(found)).select(*candidate_columns()).drop("position")


# Captures, traces, routing

CAPTURE_SQL = "SELECT CAST(user_id AS STRING) AS id, event_id AS position, concat('d', CAST(event_id % 5 AS STRING)) AS digest, {stamp} AS timestamp, '20240115000000' AS target FROM events"


@query("WITH c AS (" + CAPTURE_SQL.format(stamp="strftime(ts, '%Y%m%d%H%M%S')") + "), d AS (SELECT *, CAST(abs(epoch(CAST(strptime(timestamp, '%Y%m%d%H%M%S') AS TIMESTAMP)) - epoch(TIMESTAMP '2024-01-15')) AS DOUBLE) AS distance FROM c), a AS (SELECT * FROM d QUALIFY row_number() OVER (PARTITION BY id, timestamp ORDER BY distance, position) = 1), b AS (SELECT * FROM a QUALIFY row_number() OVER (PARTITION BY id, digest ORDER BY distance, position) = 1) SELECT id, position, timestamp, distance, CAST(row_number() OVER (PARTITION BY id ORDER BY distance, position) AS INTEGER) AS replay_no FROM b QUALIFY replay_no <= 2")
def nearest_capture(spark, sf):
    c = view(spark, sf, CAPTURE_SQL.format(stamp="date_format(ts, 'yyyyMMddHHmmss')"))
    return archive.nearest(c).select("id", "position", "timestamp", "distance", "replay_no")


@query(f"WITH p AS (SELECT page_id, {P(2)} AS scheme, {P(4)} AS net, {P(5)} AS path, {P(7)} AS query FROM pages), v AS (SELECT page_id, [lower(scheme) || '://' || net || path || CASE WHEN query <> '' THEN '?' || query ELSE '' END, CASE WHEN lower(scheme) = 'https' THEN 'http://' || net || path || CASE WHEN query <> '' THEN '?' || query ELSE '' END END, CASE WHEN query <> '' THEN lower(scheme) || '://' || net || path END] AS forms FROM p), f AS (SELECT page_id, unnest(list_filter(forms, lambda x: x IS NOT NULL)) AS form, generate_subscripts(list_filter(forms, lambda x: x IS NOT NULL), 1) - 1 AS no FROM v), c AS (SELECT f.page_id, f.no, f.form FROM f JOIN (SELECT DISTINCT form FROM f WHERE (page_id + no) % 3 = 0) k ON k.form = f.form) SELECT CAST(page_id AS VARCHAR) AS id, CAST(no AS INTEGER) AS variant_no, form AS variant FROM c QUALIFY rank() OVER (PARTITION BY page_id ORDER BY no) = 1")
def variant_first_hit(spark, sf):
    s = view(spark, sf, STORY).select("id", "page_id", "url")
    captures = archive.variants(s).where((F.col("page_id") + F.col("variant_no")) % 3 == 0)
    captures = captures.select(F.col("variant").alias("original_url"), F.lit("20200101000000").alias("timestamp")).distinct()
    return archive.first_hit(s.select("id", "url"), captures).select("id", "variant_no", "variant")


def trace_rows(spark, sf):
    t = view(spark, sf, TRACE)
    entry = F.struct(F.lit("wayback").alias("method"), "phase", "status", "ordinal")
    return t.groupBy("id").agg(F.array_sort(F.collect_list(F.struct("ordinal", F.to_json(entry).alias("j")))).alias("x")).select("id", F.concat(F.lit('[7,"text",'), F.concat_ws(",", F.transform("x", lambda e: e["j"])), F.lit("]")).alias("attempt_trace"))


@query(f"WITH t AS ({TRACE}) SELECT id, CAST(count(*) + 3 AS INTEGER) AS n_elements, CAST(count(*) + 1 AS INTEGER) AS n_wayback, 'cdx' AS last_phase FROM t GROUP BY id")
def trace_append(spark, sf):
    t = trace_rows(spark, sf)
    out = t.select("id", traces.append_trace(F.col("attempt_trace"), F.array(traces.trace_entry(method=F.lit("wayback"), phase=F.lit("cdx"), status=F.lit(200)))).alias("x"))
    own = traces.wayback_entries(F.col("x"))
    return out.select("id", F.size(traces.elements(F.col("x"))).alias("n_elements"), F.size(own).alias("n_wayback"), F.try_element_at(own, F.lit(-1))["phase"].alias("last_phase"))


@query(f"WITH t AS ({TRACE}) SELECT id, CAST(coalesce(arg_max(status, ordinal) FILTER (WHERE phase = 'direct'), 0) AS INTEGER) AS direct_status, CAST(coalesce(arg_max(status, ordinal) FILTER (WHERE phase = 'cdx'), 0) AS INTEGER) AS cdx_status FROM t GROUP BY id")
def trace_latest_phase(spark, sf):
    own = traces.wayback_entries(F.col("attempt_trace"))
    return trace_rows(spark, sf).select("id", F.coalesce(traces.latest(own, "direct")["status"], F.lit(0)).alias("direct_status"), F.coalesce(traces.latest(own, "cdx")["status"], F.lit(0)).alias("cdx_status"))


BAD = "({0} IS NULL OR {0} IN (429, 500, 502, 503, 504))"


@query(f"WITH t AS ({TRACE}), s AS (SELECT id, arg_max(status, ordinal) FILTER (WHERE phase = 'direct') AS d, arg_max(status, ordinal) FILTER (WHERE phase = 'availability') AS a, arg_max(status, ordinal) FILTER (WHERE phase = 'snapshot') AS n, arg_max(status, ordinal) FILTER (WHERE phase = 'cdx') AS c FROM t GROUP BY id) SELECT id, CASE WHEN CAST(id AS BIGINT) % 7 = 6 THEN 'done' WHEN {BAD.format('d')} THEN 'direct' WHEN {BAD.format('a')} OR coalesce(n IN (429, 500, 502, 503, 504), false) THEN 'availability' WHEN {BAD.format('c')} THEN 'cdx' ELSE 'done' END AS stage FROM s")
def resume_stage(spark, sf):
    return trace_rows(spark, sf).select("id", traces.resume_stage(F.col("id").cast("long") % 7 != 6, traces.wayback_entries(F.col("attempt_trace"))).alias("stage"))


@query(f"WITH a AS ({ATTEMPT}) SELECT event_id, (coalesce(error, '') NOT IN ('', 'offsite_redirect', 'too_many_redirects')) OR coalesce(status IN (429, 500, 502, 503, 504), false) AS archive_failure, (coalesce(error, '') NOT IN ('', 'no_capture', 'no_archive_url') AND NOT starts_with(coalesce(error, ''), 'http_')) OR coalesce(status IN (429, 502, 503, 504), false) AS live_failure FROM a")
def provider_classifier(spark, sf):
    a = view(spark, sf, ATTEMPT)
    return a.select("event_id", traces.provider_failure(F.col("status"), F.col("error")).alias("archive_failure"), traces.provider_failure(F.col("status"), F.col("error"), "live").alias("live_failure"))


@query("""WITH e AS (SELECT event_id, event_id % 5 AS k FROM events) SELECT event_id, CASE k WHEN 0 THEN 2 WHEN 1 THEN 0 WHEN 2 THEN 0 ELSE -1 END AS n_captures, CASE WHEN k = 0 THEN 'u' || event_id END AS first_url, CASE WHEN k IN (3, 4) THEN '20200102030405' END AS closest FROM e""")
def archive_answers(spark, sf):
    """Index and availability answers: rows, header only, empty list, object, wrapped timestamp."""
    k = F.col("event_id") % 5
    e = table(spark, sf, "events")
    index = F.when(k == 0, F.concat(F.lit('[["timestamp","original","digest"],["20200101000000","u'), F.col("event_id").cast("string"), F.lit('","x"],["20210101000000","v",null]]'))).when(k == 1, '[["timestamp","original"]]').when(k == 2, "[]").otherwise("not json")
    near = F.when(k == 3, '{"archived_snapshots":{"closest":{"available":true,"timestamp":"20200102030405"}}}').when(k == 4, '{"archived_snapshots":{"closest":{"available":true,"timestamp":"bad","url":"http://a/web/20200102030405/x"}}}').otherwise('{"archived_snapshots":{}}')
    got = traces.index_captures(index)
    return e.select("event_id", F.when(got.isNotNull(), F.size(got)).otherwise(-1).alias("n_captures"), F.try_element_at(got, F.lit(1))["original_url"].alias("first_url"), traces.closest_capture(near).alias("closest"))


def route_outcomes(s: DataFrame) -> DataFrame:
    """Recorded answers of a deterministic archive, by the page's number mod 4."""
    v = archive.variants(s.select("id", "page_id", "url"))
    key = F.col("page_id") % 4
    none = "array<struct<timestamp: string, original_url: string, digest: string>>"
    ok = F.lit(200)
    direct = s.select("id", F.lit("direct").alias("phase"), F.try_element_at(urls.archive_variants(F.col("url")), F.lit(1)).alias("variant"), F.lit("20200102000000").alias("timestamp"), F.lit(None).cast(none).alias("captures"), F.when(key < 2, 200).otherwise(404).alias("status"), (key < 2).alias("accepted"))
    avail = v.select("id", F.lit("availability").alias("phase"), "variant", F.lit(None).cast("string").alias("timestamp"), F.lit(None).cast(none).alias("captures"), ok.alias("status"), F.lit(False).alias("accepted"))
    capture = F.array(F.struct(F.lit("20190101000000").alias("timestamp"), F.col("variant").alias("original_url"), F.lit("g").alias("digest")))
    index = v.select("id", F.lit("cdx").alias("phase"), "variant", F.lit(None).cast("string").alias("timestamp"), F.when(key == 2, capture).otherwise(F.array().cast(none)).alias("captures"), ok.alias("status"), F.lit(False).alias("accepted"))
    replay = s.select("id", F.lit("snapshot").alias("phase"), F.lit(None).cast("string").alias("variant"), F.lit("20190101000000").alias("timestamp"), F.lit(None).cast(none).alias("captures"), ok.alias("status"), (key == 2).alias("accepted"))
    return direct.unionByName(avail).unionByName(index).unionByName(replay).withColumn("error", F.lit(None).cast("string"))


N_FORMS = "1 + CASE WHEN starts_with(url, 'https:') THEN 1 ELSE 0 END + CASE WHEN regexp_matches(url, '^[^#]*[?][^#]') THEN 1 ELSE 0 END"


@query(f"WITH k AS (SELECT page_id, page_id % 4 AS key, {N_FORMS} AS n FROM pages) SELECT CAST(page_id AS VARCHAR) AS id, key < 3 AS terminal, false AS needs_archive, CASE WHEN key < 2 THEN 'direct' WHEN key = 2 THEN 'direct' || repeat(' availability', n) || ' cdx snapshot' ELSE 'direct' || repeat(' availability', n) || repeat(' cdx', n) END AS phases FROM k")
def archive_route(spark, sf):
    s = view(spark, sf, STORY)
    state = s.select("id", "url", F.lit("20200102000000").alias("target"), F.lit(True).alias("needs_archive"), F.lit(None).cast("string").alias("attempt_trace"))
    out = archive.route(state, route_outcomes(s))
    return out.select("id", "terminal", "needs_archive", F.array_join(F.transform("actions", lambda a: a["phase"]), " ").alias("phases"))


def archive_inputs(spark, sf) -> tuple[DataFrame, DataFrame]:
    """Queue and recorded answers of every page over the deterministic archive, by the page's number mod 8: the
    first four as in ``route_outcomes`` (direct, direct, index, nothing); 4: the index lookup fails;
    5: a page of another story by direct replay, nothing else found; 6: its direct replay fails and
    its saved text is longer; 7: its trace shows all stages done."""
    p = table(spark, sf, "pages").select(F.col("page_id").cast("string").alias("id"), "page_id", "url", F.regexp_extract("html", "(?is)<title[^>]*>(.*?)</title>", 1).alias("own"), "html")
    k = F.col("page_id") % 8
    title = F.when(k.isin(5, 6), "some other story").otherwise(F.col("own"))
    text, level = F.when(k == 6, F.repeat(F.lit("saved "), 20_000)), F.when(k == 6, "unverified_text").otherwise("no_text")
    trace = F.when(k == 7, F.lit('[{"method":"wayback","phase":"direct","status":404},{"method":"wayback","phase":"availability","status":200},{"method":"wayback","phase":"cdx","status":200}]'))
    rows_ = p.select("id", "page_id", "url", title.alias("title"), F.lit("2020-01-02").alias("publish_date"), F.lit(True).alias("needs_archive"), trace.alias("attempt_trace"), text.alias("text"), level.alias("verification_level"), F.when(k == 6, "playwright").alias("fetch_method"), F.lit("requests").alias("attempted_methods"), F.lit("fetch_error").alias("scrape_status"))
    v = archive.variants(p.select("id", "page_id", "url"))
    none = F.lit(None).cast("array<struct<timestamp: string, original_url: string, digest: string>>")
    null = F.lit(None).cast("string")
    first = F.try_element_at(urls.archive_variants(F.col("url")), F.lit(1))

    def answer(df, phase, variant, stamp, captures, status, error=null, content=null):
        address = F.concat(F.lit("http://archive/web/"), stamp, F.lit("id_/"), F.col("url")) if phase in ("direct", "snapshot") else null
        return df.select("id", F.lit(phase).alias("phase"), variant.alias("variant"), stamp.alias("timestamp"), captures.alias("captures"), status.cast("int").alias("status"), error.alias("error"), content.alias("content"), address.alias("final_url"))

    shown = k.isin(0, 1, 5)
    direct = answer(p, "direct", first, F.lit("20200102000000"), none, F.when(shown, 200).when(k != 6, 404), F.when(k == 6, "ReadTimeout"), F.when(shown, F.col("html")))
    near = answer(v, "availability", F.col("variant"), null, none, F.when(k == 4, 503).otherwise(200))
    capture = F.array(F.struct(F.lit("20190101000000").alias("timestamp"), F.col("variant").alias("original_url"), F.lit("g").alias("digest")))
    index = answer(v, "cdx", F.col("variant"), null, F.when(k == 2, capture).otherwise(F.slice(capture, 1, 0)), F.when(k == 4, 503).otherwise(200))
    replay = answer(p, "snapshot", first, F.lit("20190101000000"), none, F.lit(200), null, F.col("html"))
    return rows_, rows.relaxed_union(direct, near, index, replay)


def archive_job(spark, sf) -> DataFrame:
    return archives.results(*archive_inputs(spark, sf), "run", "now")


#: What the run must come to, by k. The text is the candidate that is accepted or longest.
ARCHIVE_JOB = CANDIDATES.replace("CASE WHEN page_id % 3 <> 0 THEN", "CASE WHEN page_id % 8 NOT IN (5, 6) THEN") + f"""
, b AS (SELECT * FROM j QUALIFY row_number() OVER (PARTITION BY id ORDER BY CASE WHEN verification_level <> 'unverified_text' THEN position END NULLS LAST, n_text DESC, position) = 1),
k AS (SELECT page_id, page_id % 8 AS k, {N_FORMS} AS n, CAST(page_id AS VARCHAR) AS id FROM pages),
e AS (
  SELECT k.id, k, n, k IN (0, 1, 2) AND b.verification_level <> 'unverified_text' AS won, k IN (0, 1, 2, 5) AS seen, b.verification_level AS lv, b.verified_by AS by_, b.n_text AS nt, b.digest AS dg FROM k JOIN b ON b.id = k.id
),
done AS (
  SELECT id, CASE WHEN k = 7 THEN 'passed' WHEN won THEN 'recovered' WHEN k IN (4, 6) THEN 'deferred' WHEN seen THEN 'unverified' ELSE 'no_text' END AS outcome,
    NOT won AND k IN (4, 6) AS needs_archive,
    CASE WHEN k = 6 THEN 'unverified_text' WHEN seen THEN lv ELSE 'no_text' END AS verification_level, CASE WHEN seen THEN by_ END AS verified_by,
    CASE WHEN k = 6 THEN 120000 WHEN seen THEN nt END AS n_text, CASE WHEN k = 6 THEN md5(repeat('saved ', 20000)) WHEN seen THEN dg END AS digest,
    CASE WHEN k = 6 THEN 'playwright' WHEN seen THEN 'wayback' END AS fetch_method, 'requests,wayback' AS attempted_methods,
    CAST(CASE WHEN k = 7 THEN 3 WHEN k IN (0, 1) AND won THEN 1 WHEN k = 4 THEN 3 WHEN k = 2 THEN 3 + n WHEN k IN (0, 1) THEN 1 + 2 * n ELSE 1 + 2 * n END AS INTEGER) AS n_trace
  FROM e
)
"""


@query(ARCHIVE_JOB + "SELECT * FROM done")
def archive_run(spark, sf):
    trace = F.size(traces.elements(F.col("attempt_trace"))).alias("n_trace")
    digest = F.md5(F.col("text").cast("binary")).alias("digest")
    return archive_job(spark, sf).select("id", "outcome", "needs_archive", "verification_level", "verified_by", F.length("text").cast("long").alias("n_text"), digest, "fetch_method", "attempted_methods", trace)


@query(ARCHIVE_JOB + "SELECT count(*) AS rows_completed, CAST(count_if(outcome = 'recovered') AS BIGINT) AS rows_recovered, CAST(count_if(outcome = 'deferred') AS BIGINT) AS rows_deferred, CAST(count_if(outcome = 'unverified') AS BIGINT) AS rows_unverified, CAST(count_if(outcome = 'no_text') AS BIGINT) AS rows_no_text, CAST(count_if(outcome = 'recovered') AS BIGINT) AS terminal_acceptances FROM done")
def archive_counters(spark, sf):
    return archives.counters(archive_job(spark, sf))


@query("WITH k AS (SELECT page_id, page_id % 6 AS k FROM pages) SELECT CAST(page_id AS VARCHAR) AS id, CASE k WHEN 0 THEN 'requests' WHEN 1 THEN 'requests,playwright' WHEN 2 THEN 'requests,playwright,wayback' WHEN 3 THEN 'requests,wayback' WHEN 4 THEN 'requests,playwright,wayback' ELSE 'requests,wayback' END AS attempted_methods, k IN (0, 1, 2) AS accepted, k = 4 AS needs_archive FROM k")
def live_route(spark, sf):
    """0: accepted at once; 1: in the browser; 2: by the archive; 3: gone, not archived; 4: failed
    everywhere, the archive being down; 5: gone, an archived text that isn't accepted."""
    s = view(spark, sf, STORY).select("id", (F.col("page_id") % 6).alias("k"), F.explode(F.array(*map(F.lit, ("requests", "playwright", "wayback")))).alias("method"))
    m, k = F.col("method"), F.col("k")
    terminal = ((m == "requests") & (k == 0)) | ((m == "playwright") & (k == 1)) | ((m == "wayback") & (k == 2))
    content = terminal | ((m == "requests") & (k == 1)) | ((m == "wayback") & (k == 5))
    status = F.when((m == "requests") & k.isin(3, 5), 404)
    a = s.select("id", "method", content.alias("has_content"), terminal.alias("terminal"), status.alias("status"), ((m == "wayback") & (k == 4)).alias("provider_failure"))
    return provider.live_route(a)


@query("SELECT event_id AS request_id, CAST(CASE event_id % 4 WHEN 0 THEN 0 WHEN 1 THEN 2 WHEN 2 THEN 1 ELSE 6 END AS INTEGER) AS n_redirects, CASE WHEN event_id % 4 < 2 THEN 200 ELSE 0 END AS status, CASE event_id % 4 WHEN 2 THEN 'offsite_redirect' WHEN 3 THEN 'too_many_redirects' END AS error FROM events")
def redirect_outcome(spark, sf):
    k = F.col("event_id") % 4
    hop = F.explode(F.sequence(F.lit(0), F.when(k == 0, 0).when(k == 1, 2).when(k == 2, 1).otherwise(7))).alias("hop")
    h = table(spark, sf, "events").select(F.col("event_id").alias("request_id"), k.alias("k"), hop)
    url = F.when((F.col("k") == 2) & (F.col("hop") == 1), "http://other.example/").otherwise("http://web.archive.org/web/x")
    status = F.when((F.col("k") == 0) | ((F.col("k") == 1) & (F.col("hop") == 2)), 200).otherwise(302)
    return provider.redirect_outcome(h.select("request_id", "hop", url.alias("url"), status.alias("status")), "web.archive.org").fillna({"status": 0})


# Metrics over attempts


@query(f"WITH a AS ({ATTEMPT}) SELECT endpoint, count(*) AS attempts, CAST(count_if(status BETWEEN 200 AND 299 AND error IS NULL) AS BIGINT) AS successes, CAST(count_if(coalesce(contains(lower(error), 'timeout'), false)) AS BIGINT) AS timeouts, CAST(count_if(error IS NOT NULL) AS BIGINT) AS errors, round(avg(seconds), 6) AS mean_seconds FROM a GROUP BY endpoint")
def endpoint_telemetry(spark, sf):
    return metrics.endpoint_telemetry(view(spark, sf, ATTEMPT)).withColumn("mean_seconds", F.round("mean_seconds", 6))


@query(f"WITH a AS ({ATTEMPT}) SELECT endpoint, count(*) AS attempts, CAST(count_if(success) AS BIGINT) AS successes, CAST(count_if(terminal) AS BIGINT) AS terminal_acceptances, CAST(sum(retry_count) AS BIGINT) AS retries, sum(seconds) AS seconds, round(sum(seconds) / count(*), 6) AS avg_seconds FROM a GROUP BY endpoint")
def method_metrics(spark, sf):
    return metrics.method_metrics(view(spark, sf, ATTEMPT), ["endpoint"]).withColumn("avg_seconds", F.round("avg_seconds", 6))


@query(f"WITH a AS ({ATTEMPT}), s AS (SELECT endpoint AS kind, string_agg(v || '=' || n, ',' ORDER BY v) AS statuses FROM (SELECT endpoint, CAST(status AS VARCHAR) AS v, count(*) AS n FROM a WHERE status IS NOT NULL GROUP BY 1, 2) GROUP BY 1), e AS (SELECT endpoint AS kind, string_agg(v || '=' || n, ',' ORDER BY v) AS errors FROM (SELECT endpoint, error AS v, count(*) AS n FROM a WHERE error IS NOT NULL GROUP BY 1, 2) GROUP BY 1), b AS (SELECT endpoint AS kind, count(*) AS logical_requests, CAST(sum(retry_count) AS BIGINT) AS retries, CAST(sum(1 + retry_count) AS BIGINT) AS http_attempts FROM a GROUP BY 1) SELECT b.*, s.statuses, e.errors FROM b LEFT JOIN s USING (kind) LEFT JOIN e USING (kind)")
def http_counters(spark, sf):
    return metrics.http_counters(view(spark, sf, ATTEMPT).withColumnRenamed("endpoint", "kind"))


@query(f"WITH a AS ({ATTEMPT}) SELECT endpoint, count(*) AS attempts, CAST(count_if(success) AS BIGINT) AS successes, CAST(sum(retry_count) AS BIGINT) AS retries, sum(seconds) AS seconds, round(sum(seconds) / count(*), 6) AS avg_seconds FROM a GROUP BY endpoint")
def metrics_rollup(spark, sf):
    """Totals from a saved snapshot of one half and counts of the other; averages are made again."""
    a = view(spark, sf, ATTEMPT)
    parts = [metrics.method_metrics(a.where(F.col("event_id") % 2 == k), ["endpoint"]) for k in (0, 1)]
    out = metrics.merge_counters(*parts, by=["endpoint"], sums=["attempts", "successes", "retries", "seconds"])
    return metrics.with_averages(out, {"avg_seconds": ("seconds", "attempts")}).withColumn("avg_seconds", F.round("avg_seconds", 6))


@query(f"WITH a AS ({ATTEMPT}), b AS (SELECT endpoint, to_timestamp(floor(epoch(ts) / 14400) * 14400) AT TIME ZONE 'UTC' AS window_start, count(*) AS attempts, CAST(count_if(coalesce(contains(lower(error), 'timeout'), false)) AS BIGINT) AS timeouts FROM a GROUP BY 1, 2) SELECT endpoint, CAST(window_start AS TIMESTAMP) AS window_start, attempts, timeouts, attempts - coalesce(lag(attempts) OVER (PARTITION BY endpoint ORDER BY window_start), 0) AS delta, attempts >= 5 AND timeouts >= 0.1 * attempts AS alarm FROM b")
def heartbeat_alarm(spark, sf):
    return metrics.heartbeat(view(spark, sf, ATTEMPT), "4 hours", 5, 0.1)


@query(f"WITH a AS ({ATTEMPT}) SELECT endpoint AS strategy, count(*) AS n_rows, CAST(count_if(success) AS BIGINT) AS captures, CAST(count_if(terminal) AS BIGINT) AS terminals, CAST(sum(1 + retry_count) AS BIGINT) AS requests, round(avg(seconds), 6) AS mean_seconds, CAST(quantile_disc(seconds, 0.5) AS DOUBLE) AS p50, CAST(quantile_disc(seconds, 0.9) AS DOUBLE) AS p90, CAST(quantile_disc(seconds, 0.95) AS DOUBLE) AS p95, round(sum(1 + retry_count) / nullif(count_if(terminal), 0), 6) AS requests_per_terminal FROM a GROUP BY endpoint")
def strategy_summary(spark, sf):
    a = view(spark, sf, ATTEMPT).select(F.col("endpoint").alias("strategy"), F.col("success").alias("capture"), "terminal", (F.lit(1) + F.col("retry_count")).alias("requests"), "seconds")
    out = metrics.strategy_summary(a)
    return out.withColumns({c: F.round(c, 6) for c in ("mean_seconds", "requests_per_terminal")})


@query(f"WITH a AS (SELECT *, CAST(epoch(ts) AS DOUBLE) AS arrival, row_number() OVER (PARTITION BY endpoint ORDER BY epoch(ts), event_id) AS i FROM ({ATTEMPT})) SELECT event_id, endpoint, round(max(arrival - i * 0.5) OVER (PARTITION BY endpoint ORDER BY arrival, event_id ROWS UNBOUNDED PRECEDING) + i * 0.5, 3) AS start FROM a")
def rate_schedule(spark, sf):
    a = view(spark, sf, ATTEMPT).withColumn("arrival", F.unix_micros(F.col("ts").cast("timestamp")) / 1e6)
    return provider.rate_schedule(a, times.request_gap(2.0), "endpoint").select("event_id", "endpoint", F.round("start", 3).alias("start"))


#: One step of the breaker for each row of an endpoint, in order: the state in which an outcome is
#: met, then failures in a row, the end of the pause, whether a probe is due, and openings. Two
#: failures pause for 3600 s, a failed probe for 7200 s.
BREAKER = f"""
WITH RECURSIVE a AS ({ATTEMPT}),
e AS (
  SELECT endpoint, event_id, epoch(ts) AS ts, success AS content,
    (coalesce(error, '') NOT IN ('', 'offsite_redirect', 'too_many_redirects')) OR coalesce(status IN (429, 500, 502, 503, 504), false) AS failure,
    row_number() OVER (PARTITION BY endpoint ORDER BY ts, event_id) AS i FROM a
),
f AS (
  SELECT DISTINCT endpoint, CAST(0 AS BIGINT) AS i, CAST(0 AS BIGINT) AS event_id, CAST(0 AS DOUBLE) AS ts, false AS failure, false AS content, '' AS state, 0 AS consecutive, CAST(0 AS DOUBLE) AS pause_until, false AS probe, 0 AS openings FROM e
  UNION ALL
  SELECT endpoint, i, event_id, ts, failure, content, state,
    CASE WHEN NOT failure THEN 0 WHEN state = 'probe' OR consecutive + 1 >= 2 THEN 0 ELSE consecutive + 1 END,
    CASE WHEN failure AND state = 'probe' THEN ts + 7200 WHEN failure AND consecutive + 1 >= 2 THEN greatest(pause_until, ts + 3600) ELSE pause_until END,
    CASE WHEN failure THEN probe OR consecutive + 1 >= 2 ELSE probe AND state <> 'probe' END,
    openings + CASE WHEN failure AND (state = 'probe' OR consecutive + 1 >= 2) THEN 1 ELSE 0 END
  FROM (SELECT e.*, f.consecutive, f.pause_until, f.probe, f.openings, CASE WHEN e.ts < f.pause_until THEN 'open' WHEN f.probe THEN 'probe' ELSE 'closed' END AS state FROM f JOIN e ON e.endpoint = f.endpoint AND e.i = f.i + 1)
)
SELECT endpoint, event_id, ts, failure, content, state, CAST(consecutive AS INTEGER) AS consecutive, pause_until, CAST(openings AS INTEGER) AS openings FROM f WHERE i > 0
"""


@query(BREAKER)
def breaker_fold(spark, sf):
    a = view(spark, sf, ATTEMPT)
    failure = ~traces.healthy(F.col("status"), F.col("error"), F.lit(True))
    e = a.select("endpoint", "event_id", (F.unix_micros(F.col("ts").cast("timestamp")) / 1e6).alias("ts"), failure.alias("failure"), F.col("success").alias("content"))
    return provider.breaker_fold(e, provider.Breaker(failures=2, pause_s=3600, probe_pause_s=7200))


@query(WITH_R + f"SELECT CAST(count_if(scrape_status = 'ok' AND coalesce(verification_level IN ('page_verified', 'strict_verified'), false) AND {HT}) AS BIGINT) AS terminal_results, CAST(count_if(fetch_method = 'wayback' AND {HT}) AS BIGINT) AS control_text_preserved, CAST(count_if(coalesce(needs_archive, false)) AS BIGINT) AS still_pending FROM r")
def probe_summary(spark, sf):
    return metrics.probe_summary(result(spark, sf).withColumn("sample_group", F.when(F.col("fetch_method") == "wayback", "control").otherwise("pending")))


@query(f"WITH a AS ({ATTEMPT}) SELECT endpoint, count(*) AS n_rows, CAST(sum(1 + retry_count) AS BIGINT) AS requests, sum(seconds) AS seconds, round(count(*) / sum(seconds), 6) AS rows_per_second, round(sum(1 + retry_count) / sum(seconds), 6) AS requests_per_second FROM a GROUP BY endpoint")
def throughput(spark, sf):
    a = view(spark, sf, ATTEMPT).groupBy("endpoint").agg(F.count(F.lit(1)).alias("n_rows"), F.sum(F.lit(1) + F.col("retry_count")).cast("long").alias("requests"), F.sum("seconds").alias("seconds"))
    return metrics.throughput(a).withColumns({c: F.round(c, 6) for c in ("rows_per_second", "requests_per_second")})


@query("SELECT CAST((SELECT count(DISTINCT doc_id) FROM labels) AS BIGINT) AS saved_rows, round(100.0 * (SELECT count(DISTINCT doc_id) FROM labels) / (SELECT count(*) FROM documents), 6) AS percent")
def run_progress(spark, sf):
    ids = table(spark, sf, "labels").select(F.col("doc_id").alias("id"))
    total = table(spark, sf, "documents").count()
    return metrics.progress(ids.where("id % 2 = 0"), ids.where("id % 3 <> 0 or id % 2 = 1"), total).withColumn("percent", F.round("percent", 6))


# Publishers, fallbacks, candidates


@query(f"WITH p AS (SELECT page_id, regexp_replace(regexp_replace(regexp_replace(lower({P(4)}), '^.*@', ''), ':[0-9]*$', ''), '^www[.]', '') AS host FROM pages), d AS (SELECT DISTINCT host, 'p:' || host AS publisher FROM p WHERE length(host) % 2 = 0 UNION SELECT DISTINCT regexp_extract(host, '[^.]+[.][^.]+$', 0) AS host, 'd:' || regexp_extract(host, '[^.]+[.][^.]+$', 0) FROM p WHERE length(regexp_extract(host, '[^.]+[.][^.]+$', 0)) % 2 = 1) SELECT CAST(p.page_id AS VARCHAR) AS id, d.publisher FROM p LEFT JOIN d ON p.host = d.host OR ends_with(p.host, '.' || d.host) QUALIFY row_number() OVER (PARTITION BY p.page_id ORDER BY length(d.host) DESC NULLS LAST) = 1")
def publisher_suffix_join(spark, sf):
    s = view(spark, sf, STORY).select("id", "url")
    h = s.select(urls.bare_host(F.col("url")).alias("host")).distinct()
    own = h.where(F.length("host") % 2 == 0).select("host", F.concat(F.lit("p:"), F.col("host")).alias("publisher"))
    two = F.regexp_extract("host", "[^.]+[.][^.]+$", 0)
    parent = h.select(two.alias("host")).where(F.length("host") % 2 == 1).distinct().select("host", F.concat(F.lit("d:"), F.col("host")).alias("publisher"))
    return archive.publisher_join(s, own.unionByName(parent).distinct()).select("id", "publisher")


@query(WITH_R + f", a AS (SELECT id, text, CASE WHEN doc_id % 3 = 0 THEN 'xx' || coalesce(text, '') WHEN doc_id % 3 = 1 THEN 'short' END AS alt FROM r) SELECT id, CASE WHEN {HAS.replace('{0}', 'alt')} AND length(alt) > length(coalesce(text, '')) THEN CAST(length(alt) AS BIGINT) ELSE 0 END AS fallback_text_length FROM a")
def longest_unverified(spark, sf):
    r = result(spark, sf).select("id", "doc_id", "text", F.lit(None).cast("string").alias("fallback_text"), F.lit(None).cast("long").alias("fallback_text_length"), F.lit(None).cast("string").alias("fallback_fetch_method"))
    k = F.col("doc_id") % 3
    alt = F.when(k == 0, F.concat(F.lit("xx"), F.coalesce("text", F.lit("")))).when(k == 1, "short")
    return acceptance.attach_longer(r, alt, F.lit("playwright")).select("id", F.coalesce("fallback_text_length", F.lit(0)).cast("long").alias("fallback_text_length"))


@query(WITH_R + f", a AS (SELECT id, text, coalesce(text, '') || CASE WHEN doc_id % 2 = 0 THEN ' more' ELSE '' END AS alt FROM r) SELECT id, CASE WHEN {HAS.replace('{0}', 'alt')} AND length(alt) > length(coalesce(text, '')) THEN CAST(length(alt) AS BIGINT) ELSE 0 END AS fallback_text_length FROM a")
def preserved_longest(spark, sf):
    r = result(spark, sf).select("id", "doc_id", "text", F.lit(None).cast("string").alias("fallback_text"), F.lit(None).cast("long").alias("fallback_text_length"), F.lit(None).cast("string").alias("fallback_fetch_method"))
    alt = F.concat(F.coalesce("text", F.lit("")), F.when(F.col("doc_id") % 2 == 0, " more").otherwise(""))
    one = F.struct(alt.alias("text"), F.lit("wayback").alias("fetch_method"), F.lit("unverified_text").alias("verification_level"), F.lit(False).alias("target_verified"))
    two = F.struct(F.lit("very long but verified" * 9000).alias("text"), F.lit("wayback").alias("fetch_method"), F.lit("strict_verified").alias("verification_level"), F.lit(True).alias("target_verified"))
    return acceptance.preserve_longest(r, F.array(one, two)).select("id", F.coalesce("fallback_text_length", F.lit(0)).cast("long").alias("fallback_text_length"))


@query("WITH c AS (SELECT conv_id, turn, conv_id % 3 AS rank, length(coalesce(text, '')) AS len FROM conversations), m AS (SELECT * FROM c QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY CASE WHEN rank = 1 THEN len END DESC NULLS LAST, turn) = 1) SELECT CAST(conv_id AS VARCHAR) AS id, turn, len FROM m")
def best_candidate(spark, sf):
    """Unverified texts: the longest, the first of ties. Other ranks, being equal: the first."""
    c = table(spark, sf, "conversations")
    one = F.struct("turn", (F.col("conv_id") % 3).cast("int").alias("rank"), F.length(F.coalesce("text", F.lit(""))).cast("long").alias("len"))
    g = c.groupBy(F.col("conv_id").cast("string").alias("id")).agg(F.array_sort(F.collect_list(one)).alias("c"))
    return g.select("id", acceptance.best_candidate(F.col("c")).alias("b")).select("id", "b.turn", "b.len")


# Composite plans


@query(WITH_S + f", q AS (SELECT *, {QUALITY} AS quality FROM k WHERE needs_archive), b AS (SELECT *, {QUALITY} AS quality FROM c WHERE coalesce(needs_archive, false)) SELECT b.id, CASE WHEN q.id IS NOT NULL AND (q.quality > b.quality OR (q.quality = b.quality AND length(coalesce(q.text, '')) >= length(coalesce(b.text, '')))) THEN 'checkpoint' ELSE 'canonical' END AS origin FROM b LEFT JOIN q ON q.id = b.id WHERE b.id NOT IN (SELECT id FROM k WHERE NOT needs_archive)")
def resume_rows(spark, sf):
    base, delta = sources(spark, sf)
    keep = ["id", "doc_id", "text", "verification_level", "target_verified", "needs_archive", "origin"]
    queue = base.where("needs_archive").select(*keep)
    parts = delta.select(*keep, F.col("__source_rank").alias("__part"), F.col("__position").alias("__pos"))
    return pipelines.resume_rows(queue, None, parts).select("id", "origin")


@query(WITH_S + f", q AS (SELECT *, {QUALITY} AS quality FROM s), f AS (SELECT * FROM q QUALIFY row_number() OVER (PARTITION BY id ORDER BY quality DESC, CASE WHEN quality = 1 THEN length(coalesce(text, '')) ELSE 0 END DESC, src_mtime DESC, is_canonical DESC, src_rank DESC) = 1) SELECT count(*) AS n_rows, count(DISTINCT id) AS n_ids, CAST(count_if({HT}) AS BIGINT) AS n_text, CAST(count_if(coalesce(needs_archive, false)) AS BIGINT) AS n_pending, CAST(count_if(fetch_method = 'wayback') AS BIGINT) AS n_wayback FROM f")
def freeze_validate(spark, sf):
    return pipelines.validated(rows.profile(pipelines.frozen(sources(spark, sf), wide=False)), "freeze")


@query(WITH_S + f", f AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY id ORDER BY src_rank DESC) = 1) SELECT count(*) AS n_rows, count(DISTINCT id) AS n_ids, CAST(count_if({HT}) AS BIGINT) AS n_text, CAST(count_if(coalesce(needs_archive, false)) AS BIGINT) AS n_pending, CAST(count_if(fetch_method = 'wayback') AS BIGINT) AS n_wayback FROM f")
def reduce_validate(spark, sf):
    base, delta = sources(spark, sf)
    return pipelines.validated(rows.profile(rows.upsert(base, delta)), "reduce", F.lit(base.count()))


@query(WITH_S + f"SELECT id, origin, CASE WHEN {HT} AND scrape_status IN ('ok_low_confidence', 'false_positive') THEN 'ok' ELSE scrape_status END AS scrape_status, coalesce(verification_level, CASE WHEN coalesce(target_verified, false) THEN 'strict_verified' WHEN {HT} THEN 'unverified_text' ELSE 'no_text' END) AS verification_level FROM s QUALIFY row_number() OVER (PARTITION BY id ORDER BY {HT} DESC, src_rank DESC) = 1")
def merged_outputs(spark, sf):
    return pipelines.merged(sources(spark, sf), wide=False).select("id", "origin", "scrape_status", "verification_level")


@query(WITH_S + "SELECT id, origin FROM s QUALIFY row_number() OVER (PARTITION BY id ORDER BY src_rank DESC) = 1")
def finalised_shard(spark, sf):
    base, delta = sources(spark, sf)
    parts = rows.relaxed_union(base, delta).withColumns({"__part": F.col("__source_rank"), "__pos": F.col("__position")})
    return pipelines.finalised(parts, base.count()).select("id", "origin")


# Streams


def shared(spark: SparkSession) -> str:
    """A new folder in the one that driver and executors share; unset, a local session's own."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base and not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return f"{(base or f'file://{tempfile.gettempdir()}/checkpoints').rstrip('/')}/stream-{uuid.uuid4().hex}"


@query("SELECT user_id, arg_max(event_id, (ts, event_id)) AS event_id, arg_max(event_type, (ts, event_id)) AS event_type FROM events GROUP BY user_id")
def stream_upsert(spark, sf):
    """The newest event of each user, by micro-batches over the events."""
    e = table(spark, sf, "events")
    stream = streams.source(spark, f"{sf}/events.parquet*", e.schema)
    path = shared(spark)
    out = streams.run_upsert(stream.select("user_id", "ts", "event_id", "event_type"), f"{path}/table", f"{path}/state", "user_id", ["ts", "event_id"])
    return out.select("user_id", "event_id", "event_type")


@query(f"WITH a AS ({ATTEMPT}), b AS (SELECT endpoint, CAST(to_timestamp(floor(epoch(ts) / 86400) * 86400) AT TIME ZONE 'UTC' AS TIMESTAMP) AS window_start, count(*) AS attempts, CAST(count_if(coalesce(contains(lower(error), 'timeout'), false)) AS BIGINT) AS timeouts FROM a GROUP BY 1, 2) SELECT *, attempts >= 5 AND timeouts >= 0.1 * attempts AS alarm FROM b")
def stream_heartbeat(spark, sf):
    """Daily beats of the attempt stream in update mode, the newest row of each window."""
    e = table(spark, sf, "events")
    s = spark.readStream.schema(e.schema).parquet(f"{sf}/events.parquet*")
    sql = ATTEMPT.replace("FROM events", "FROM {events}").replace("event_id, ts,", "event_id, CAST(ts AS TIMESTAMP) AS ts,", 1)
    beats = streams.heartbeat_stream(spark.sql(sql, events=s), "1 day", "60 days", 5, 0.1)
    path = shared(spark)
    return streams.run_heartbeat(beats, f"{path}/beats", f"{path}/state").withColumn("window_start", F.col("window_start").cast("timestamp_ntz"))
