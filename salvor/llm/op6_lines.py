"""Cross-site boilerplate lines by distinct-site spread, with HyperLogLog sketches."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from salvor.llm.common import WHITE, free_name, of_row, release, staged, table, whole_row

MIN_SITES = 8
LG_K = 12


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def line_rows(docs: DataFrame, site: str) -> DataFrame:
    """One row per line that isn't blank: its document's key (doc_id and text hash), place, two
    64-bit hashes of the line without white space at its ends, and its site's hash."""
    strip = lambda x: F.regexp_replace(x, f"^[{WHITE}]+|[{WHITE}]+$", "")
    out = docs.select("doc_id", F.xxhash64("text").alias("th"), F.xxhash64(F.col(f"`{site}`")).alias("site"), F.posexplode(_lines(F.col("text"))).alias("pos", "line"))
    out = out.select("doc_id", "th", "site", "pos", strip(F.col("line")).alias("line")).where("line <> ''")
    return out.select("doc_id", "th", "site", "pos", F.xxhash64("line").alias("h1"), F.xxhash64(F.lit(1), "line").alias("h2"))


def boilerplate(lines: DataFrame, min_sites: int = MIN_SITES, lg_k: int = LG_K) -> DataFrame:
    """(h1, h2) of the lines that stand on ``min_sites`` sites or more, staged.

    One sketch per line hash merges by aggregation. Estimates below half the threshold or above
    twice it decide; the lines between are counted exactly (a sketch of a few dozen sites holds
    them one by one, so its estimate is then off by far less than half).
    """
    sketch = F.hll_sketch_estimate(F.hll_sketch_agg("site", F.lit(lg_k)))
    spread = staged(lines.groupBy("h1", "h2").agg(sketch.alias("sites")).where(F.col("sites") >= min_sites / 2), "spread")
    near = spread.where(F.col("sites") <= 2 * min_sites).select("h1", "h2")
    pairs = staged(lines.select("h1", "h2", "site").join(near, ["h1", "h2"], "left_semi"), "near")
    exact = pairs.groupBy("h1", "h2", "site").agg(F.count(F.lit(1)).alias("n")).groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("sites"))
    far = spread.where(F.col("sites") > 2 * min_sites).select("h1", "h2")
    out = staged(exact.where(F.col("sites") >= min_sites).select("h1", "h2").unionByName(far), "boilerplate")
    release(spread, pairs)
    return out


def removed_lines(docs: DataFrame, site: str = "source", min_sites: int = MIN_SITES) -> DataFrame:
    """(doc_id, th, gone): the places of the lines to take out of each document, staged."""
    lines = staged(line_rows(docs, site), "lines")
    cross = boilerplate(lines, min_sites)
    marks = staged(lines.join(cross, ["h1", "h2"], "left_semi").select("h1", "h2", "doc_id", "th", "pos"), "marks")
    first = staged(marks.groupBy("h1", "h2").agg(F.min(F.struct("doc_id", "th", "pos")).alias("first")), "first")
    late = marks.join(first, ["h1", "h2"]).where(F.struct("doc_id", "th", "pos") != F.col("first"))
    out = staged(late.groupBy("doc_id", "th").agg(F.collect_set("pos").alias("gone")), "gone")
    release(lines, cross, marks, first)
    return out


def cleaned(docs: DataFrame, site: str = "source", min_sites: int = MIN_SITES) -> DataFrame:
    """(row, text, n_lines, n_removed): each row of ``docs`` as a struct, and what is left of its text."""
    gone = removed_lines(docs, site, min_sites).withColumnRenamed("doc_id", "d")
    own = docs.select(whole_row(docs), F.xxhash64("text").alias("own_hash"))
    d = own.join(gone, own["row"]["doc_id"].eqNullSafe(gone["d"]) & (own["own_hash"] == gone["th"]), "left")
    before = F.col("row.text")
    lines = _lines(before)
    kept = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col("gone"))
    cut = F.array_join(F.transform(kept, lambda i: F.element_at(lines, i + 1)), "\n")
    text = F.when(F.col("gone").isNull(), before).otherwise(cut)
    n_lines = F.when(before.isNull(), 0).otherwise(F.size(lines)).cast("long")
    n_removed = F.when(F.col("gone").isNull(), 0).otherwise(F.size("gone")).cast("long")
    return d.select("row", text.alias("text"), n_lines.alias("n_lines"), n_removed.alias("n_removed"))


def without_boilerplate(docs: DataFrame, site: str = "source", min_sites: int = MIN_SITES) -> DataFrame:
    """``docs`` with lines of ``min_sites`` sites or more taken out, and ``n_lines``, ``n_removed``.

    The first occurrence of such a line, by doc_id and place, stays, so that one copy of a text
    spread over many sites is left whole. Lines are compared without white space at their ends;
    blank lines stay. Null is a site of its own; a null text stays null with no line removed; a
    null doc_id comes first; rows alike in doc_id and text lose the same lines; an empty table
    gives no rows; further columns pass through, whatever their names, and where one has the name
    of a count, the count has an underscore at its end. Only hashes and places are exchanged by
    line; the text moves once, by doc_id.
    """
    counts = [F.col(c).alias(free_name(c, docs.columns)) for c in ("n_lines", "n_removed")]
    return cleaned(docs, site, min_sites).select(*[F.col("text") if c == "text" else of_row(c) for c in docs.columns], *counts)


def documents_without_boilerplate(docs: DataFrame, site: str = "source", min_sites: int = MIN_SITES) -> DataFrame:
    """The same with the columns of ``docs`` alone; an ``n_chars`` among them is that of the new text."""
    n_chars = F.when(F.col("n_removed") > 0, F.length("text")).otherwise(F.col("row")["n_chars"]).cast("long") if "n_chars" in docs.columns else None
    new = {"text": F.col("text"), "n_chars": n_chars}
    return cleaned(docs, site, min_sites).select(*[new[c].alias(c) if c in new else of_row(c) for c in docs.columns])


def op6_line_site_spread(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = without_boilerplate(table(spark, sf_dir, "documents").select("doc_id", "text", "source"))
    return out.select("doc_id", "n_lines", "n_removed", F.length("text").cast("long").alias("kept_chars"), F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("kept_sha256"))


CLEANED = r"""
lines AS (
  SELECT doc_id, source, pos, line,
         regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g') AS bare
  FROM (SELECT doc_id, source, unnest(x) AS line, unnest(range(len(x))) AS pos
        FROM (SELECT doc_id, source, string_split(coalesce(text, ''), chr(10)) AS x FROM {docs}))
),
spread AS (
  SELECT bare, min(doc_id * 1000000 + pos) AS first FROM lines WHERE bare <> '' GROUP BY bare
  HAVING count(DISTINCT coalesce('s' || source, '')) >= {min_sites}
),
cleaned AS (
  SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_removed,
         coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '') AS kept
  FROM (SELECT l.*, coalesce(l.doc_id * 1000000 + l.pos <> s.first, false) AS gone
        FROM lines l LEFT JOIN spread s ON l.bare = s.bare)
  GROUP BY doc_id
)
"""
ORACLE = "WITH " + CLEANED.format(docs="documents", min_sites=MIN_SITES) + """
SELECT doc_id, n_lines, n_removed, length(kept) AS kept_chars, sha256(kept) AS kept_sha256 FROM cleaned
"""
