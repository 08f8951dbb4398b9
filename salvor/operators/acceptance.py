"""Which candidate text is a story's: identity signals, acceptance level, and winners."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salvor.functions.text import has_text
from salvor.operators.levels import is_unverified, level_rank


def level(sources: Column, strict_body: Column) -> Column:
    found = F.size(sources) > 0
    return F.when(found & strict_body, "strict_verified").when(found, "page_verified").otherwise("unverified_text")


def judged_candidates(page: Column) -> Column:
    """The candidates of an extracted page, in cascade order, each with ``sources`` (the labels of
    the URLs, then titles, page's before its own, that equal the story's, distinct), its
    ``verification_level`` and ``verified_by``. Arrays alone: no row is exploded or moved."""
    none = F.array().cast("array<struct<label: string, value: string, key: string>>")

    def equal(signals: Column, own: Column, target: Column) -> Column:
        return F.transform(F.filter(F.concat(F.coalesce(signals, none), own), lambda x: x["key"] == target), lambda x: x["label"])

    def one(c: Column, position: Column) -> Column:
        sources = F.array_distinct(F.concat(equal(page["urls"], c["urls"], page["target_url"]), equal(page["titles"], c["titles"], page["target_title"])))
        return F.struct(position.alias("position"), c["stage"].alias("stage"), c["extract_method"].alias("extract_method"), c["body_source"].alias("body_source"), c["text"].alias("text"), c["strict_body"].alias("strict_body"), sources.alias("sources"))

    def named(c: Column) -> Column:
        by = F.when(F.size(c["sources"]) > 0, F.concat_ws("+", c["sources"], c["body_source"]))
        return F.struct(*[c[x].alias(x) for x in ("position", "stage", "extract_method", "body_source", "text", "strict_body", "sources")], level(c["sources"], c["strict_body"]).alias("verification_level"), by.alias("verified_by"))

    return F.transform(F.transform(page["candidates"], one), named)


def judged(pages: DataFrame, page: str = "page") -> DataFrame:
    """One row per candidate of ``pages(id, page)``."""
    return pages.select("id", F.inline(judged_candidates(F.col(page))))


def chosen(candidates: Column) -> Column:
    """Of candidates in order, the first at page or strict level; else the best of the rest by rank
    and length, earlier ones first in ties. With ``longer``: the first longest of the unverified
    texts that an accepted one came after, null for the others. Null for none."""
    rank = lambda c: level_rank(c["verification_level"])
    weight = lambda c: F.struct(rank(c), F.length(c["text"]))
    first = F.try_element_at(F.filter(candidates, lambda c: rank(c) >= 2), F.lit(1))
    rest = F.aggregate(candidates, F.try_element_at(candidates, F.lit(1)), lambda held, c: F.when(weight(c) > weight(held), c).otherwise(held))
    before = F.filter(candidates, lambda c: (rank(c) < 2) & (c["position"] < first["position"]))
    return F.when(F.size(candidates) > 0, F.struct(F.coalesce(first, rest).alias("best"), longest(before)["text"].alias("longer")))


def longest(candidates: Column) -> Column:
    """The first longest of an array of structs with ``text``; null when empty."""
    sizes = F.transform(candidates, lambda c: F.length(c["text"]))
    return F.get(candidates, F.array_position(sizes, F.array_max(sizes)).cast("int") - 1)


def fallback_candidate() -> Column:
    """A row's saved fallback text as a candidate; null without text."""
    return F.when(has_text(F.col("fallback_text")), F.struct(F.col("fallback_text").alias("text"), F.col("fallback_fetch_method").alias("fetch_method")))


def preserve_longest(df: DataFrame, alternatives: Column) -> DataFrame:
    """The longest unverified text among ``alternatives`` (array of structs text, fetch_method,
    verification_level, target_verified) and the saved fallback, kept as the row's fallback if it
    is longer than the row's own text."""
    kept = F.filter(alternatives, lambda a: is_unverified(a["verification_level"], a["target_verified"], a["text"]))
    kept = F.transform(kept, lambda a: F.struct(a["text"].alias("text"), a["fetch_method"].alias("fetch_method")))
    every = F.filter(F.concat(kept, F.array(fallback_candidate())), lambda a: a.isNotNull())
    df = df.withColumn("__best", longest(every))
    more = F.coalesce(F.length("__best.text"), F.lit(0)) > F.coalesce(F.length("text"), F.lit(0))
    return df.withColumns({
        "fallback_text": F.when(more, F.col("__best.text")).otherwise(F.col("fallback_text")),
        "fallback_text_length": F.when(more, F.length("__best.text").cast("long")).otherwise(F.col("fallback_text_length")),
        "fallback_fetch_method": F.when(more, F.col("__best.fetch_method")).otherwise(F.col("fallback_fetch_method")),
    }).drop("__best")


def attach_longer(df: DataFrame, text: Column, method: Column) -> DataFrame:
    """Keep an alternative text only if it is strictly longer than both the row's text and its
    saved fallback."""
    n = F.coalesce(F.length(text), F.lit(0))
    more = has_text(text) & (n > F.coalesce(F.length("text"), F.lit(0))) & (n > F.coalesce(F.length("fallback_text"), F.lit(0)))
    return df.withColumns({
        "fallback_text_length": F.when(more, n.cast("long")).otherwise(F.col("fallback_text_length")),
        "fallback_fetch_method": F.when(more, method).otherwise(F.col("fallback_fetch_method")),
        "fallback_text": F.when(more, text).otherwise(F.col("fallback_text")),
    })


def best_candidate(candidates: Column) -> Column:
    """Fold of an ordered array of structs (rank, len, ...): a later one replaces the held one if
    its rank is higher, or both are unverified texts and it is longer; ties keep the earlier."""
    first = F.try_element_at(candidates, F.lit(1))

    def step(held: Column, c: Column) -> Column:
        better = (c["rank"] > held["rank"]) | ((c["rank"] == 1) & (held["rank"] == 1) & (c["len"] > held["len"]))
        return F.when(better, c).otherwise(held)

    return F.aggregate(candidates, first, step)


def live_final(best: Column, any_content: Column) -> Column:
    """The status when no attempt was accepted."""
    return F.when(best.isNotNull(), "ok").when(any_content, "extract_error").otherwise("fetch_error")
