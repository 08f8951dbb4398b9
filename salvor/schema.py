"""Result schema, nested shapes and the policies that operators share."""

from __future__ import annotations

from pyspark.sql import types as T

#: Verification levels from worst to best.
LEVELS = ("no_text", "unverified_text", "page_verified", "strict_verified")
LEVEL_RANK = {level: rank for rank, level in enumerate(LEVELS)}
VERIFIED = LEVELS[2:]
#: Methods and statuses.
FETCH_METHODS = ("requests", "playwright", "wayback")
EXTRACT_METHODS = ("jsonld", "itemprop", "fundus", "trafilatura_scoped", "trafilatura")
FAILED_STATUSES = ("fetch_error", "extract_error", "exception")
LEGACY_OK_STATUSES = ("ok_low_confidence", "false_positive")
COUNTRIES = ("Sweden", "Germany")
SHORT_TEXT = 500

#: The columns every result row has, by type; each is null unless DEFAULTS has it.
STRINGS = (
    "scrape_status", "fetch_method", "extract_method", "final_url", "text", "attempted_methods", "attempt_trace", "fetch_error", "capture_time",
    "verified_by", "verification_level", "playwright_outcome", "fallback_text", "fallback_fetch_method", "canonical_url", "source_article_url",
    "structured_url", "structured_title", "fundus_publisher", "pipeline_version", "pipeline_run_id", "completed_at", "traf_title", "traf_author",
    "traf_date", "traf_description", "traf_sitename", "traf_hostname", "traf_categories", "traf_tags", "traf_language", "traf_image",
    "traf_pagetype",
)
BOOLEANS = ("target_verified", "needs_archive", "fundus_free_access")
LONGS = ("html_length", "text_length", "http_status", "fallback_text_length")
RESULT_TYPES: dict[str, T.DataType] = {
    **{c: T.StringType() for c in STRINGS}, **{c: T.BooleanType() for c in BOOLEANS}, **{c: T.LongType() for c in LONGS},
}
DEFAULTS = {"verification_level": "no_text", "target_verified": False, "needs_archive": False}
LEGACY_COLUMNS = ("content_quality", "content_quality_score", "quality_flags")

FETCH_OUTCOME = "content binary, final_url string, status_code int, error string, capture_time string, source_url string, retry_count int, retry_successes int"
HTTP_OUTCOME = "status_code int, content binary, final_url string, error string, elapsed_s double, retry_count int, retry_successes int, probe boolean"
CAPTURE = "timestamp string, original_url string, digest string"
TRACE = "method string, phase string, variant string, status int, error string, source_url string, capture_time string"
CANDIDATE = "stage int, extract_method string, body_source string, text string, urls array<struct<label: string, value: string, key: string>>, titles array<struct<label: string, value: string, key: string>>, strict_body boolean"

#: What counts as the provider's failure: statuses, error texts that don't, and whether an error
#: text that names a status (http_404) counts.
PROVIDER_PRESETS = {
    "live": {"statuses": (429, 502, 503, 504), "ignored": ("no_capture", "no_archive_url"), "http_errors": False},
    "archive": {"statuses": (429, 500, 502, 503, 504), "ignored": ("offsite_redirect", "too_many_redirects"), "http_errors": True},
}
#: Sort keys, ascending; the last row in this order stays. A position key makes each order total.
DEDUP_POLICIES = {
    "text_then_rank": ("__has_text", "__source_rank"),
    "quality_then_recency": ("__quality", "__unverified_length", "__source_mtime", "__canonical", "__source_rank"),
    "part_order_last": ("__part",),
    "base_delta": ("__rank",),
    "resume_last": ("__source_rank",),
}
