"""Attempt traces and archive answers, as JSON text at rest and arrays of structs in flight."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from salvor.schema import PROVIDER_PRESETS, TRACE

_ENTRY = [x.split()[0] for x in TRACE.split(", ")]


def elements(raw: Column) -> Column:
    """The elements of a JSON array as JSON text, empty for anything else. Elements of any kind
    survive, which a typed read of the array would not allow."""
    text = F.coalesce(raw, F.lit(""))
    parsed = F.when(F.regexp_like(text, F.lit(r"^\s*\[")), F.try_parse_json(text))
    each = F.transform(F.try_variant_get(parsed, "$", "array<variant>"), lambda v: F.to_json(v))
    return F.coalesce(each, F.array().cast("array<string>"))


def append_trace(raw: Column, entries: Column) -> Column:
    """A JSON array with ``entries`` (an array of structs) added; what is no array counts as empty.
    Null fields are left out."""
    more = F.transform(entries, lambda e: F.to_json(e))
    return F.concat(F.lit("["), F.concat_ws(",", F.concat(elements(raw), more)), F.lit("]"))


def wayback_entries(raw: Column) -> Column:
    """The objects of a trace whose method is ``wayback``, in order."""
    parsed = F.transform(elements(raw), lambda e: F.when(F.regexp_like(e, F.lit(r"^\s*\{")), F.from_json(e, TRACE)))
    return F.filter(parsed, lambda e: e["method"] == "wayback")


def latest(entries: Column, phase: str) -> Column:
    return F.try_element_at(F.filter(entries, lambda e: e["phase"] == phase), F.lit(-1))


def provider_failure(status: Column, error: Column, preset: str = "archive") -> Column:
    """Whether an outcome is the provider's failure, not the URL's; never null."""
    p = PROVIDER_PRESETS[preset]
    text = F.coalesce(error, F.lit(""))
    counts = (text != "") & ~text.isin(*p["ignored"])
    if not p["http_errors"]:
        counts = counts & ~text.rlike("^http_")
    return counts | F.coalesce(status.isin(*p["statuses"]), F.lit(False))


def healthy(status: Column, error: Column, valid_payload: Column) -> Column:
    """An archive answer that resets the breaker: no provider failure and, at 200, a payload that
    could be read; never null."""
    unread = F.coalesce((status == 200) & ~F.coalesce(valid_payload, F.lit(True)), F.lit(False))
    return ~(provider_failure(status, error) | unread)


def resume_stage(needs_archive: Column, entries: Column) -> Column:
    """The first archive stage that a row hasn't reliably completed."""

    def bad(phase: str) -> Column:
        e = latest(entries, phase)
        return e.isNull() | provider_failure(e["status"], e["error"])

    snapshot = latest(entries, "snapshot")
    again = snapshot.isNotNull() & provider_failure(snapshot["status"], snapshot["error"])
    return (
        F.when(~F.coalesce(needs_archive, F.lit(False)), "done").when(bad("direct"), "direct")
        .when(bad("availability") | again, "availability").when(bad("cdx"), "cdx").otherwise("done")
    )


def trace_entry(**fields: Column) -> Column:
    return F.struct(*[(fields[k] if k in fields else F.lit(None)).cast(t).alias(k) for k, t in (x.split() for x in TRACE.split(", "))])


def index_captures(payload: Column) -> Column:
    """Captures of an index answer: a JSON table whose first row names its columns. Null where it
    can't be read, empty where no rows follow."""
    rows = F.from_json(payload, "array<array<string>>")
    names = F.try_element_at(rows, F.lit(1))
    at = lambda row, name: F.try_element_at(row, F.nullif(F.array_position(names, name), F.lit(0)).cast("int"))
    more = F.when(F.size(rows) >= 2, F.slice(rows, 2, F.size(rows)))
    read = F.transform(more, lambda r: F.struct(at(r, "timestamp").alias("timestamp"), at(r, "original").alias("original_url"), at(r, "digest").alias("digest")))
    named = F.array_contains(names, "timestamp") & F.array_contains(names, "original")
    empty = F.array().cast("array<struct<timestamp: string, original_url: string, digest: string>>")
    return F.when(rows.isNull(), F.lit(None)).when(F.size(rows) < 2, empty).when(named, read)


def closest_capture(payload: Column, require_ok: bool = False) -> Column:
    """The 14-digit timestamp of an availability answer's closest snapshot, from its field or its
    address; null where there is none. ``require_ok``: only with status 200."""
    got = F.from_json(payload, "archived_snapshots struct<closest: struct<available: boolean, timestamp: string, url: string, status: string>>")
    near = got["archived_snapshots"]["closest"]
    stamp = F.when(near["timestamp"].rlike("^[0-9]{14}$"), near["timestamp"]).otherwise(F.nullif(F.regexp_extract(near["url"], r"/web/(\d{14})", 1), F.lit("")))
    good = near["available"] & (near["status"] == "200") if require_ok else near["available"]
    return F.when(good, stamp)
