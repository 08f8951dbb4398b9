"""Exact deduplication by content-defined chunk recipes, with built-in functions only."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salvor.llm.common import WHITE, of_row, staged, table, whole_row

#: A chunk ends at the first stop character after ``least`` characters, or at ``most``. Stops are
#: punctuation of any script, so that texts in none but ideographs are cut by what they hold too.
CHUNK = r"(?s).{{{least},{last}}}?[|\p{{Po}}]|.{{{most}}}|.+"


def recipes(docs: DataFrame, least: int = 256, most: int = 2048) -> DataFrame:
    """doc_id, n_points, text_sha256, and the text as an ordered list of chunk identifiers
    (64-bit hashes) with a check of each (60 bits of its SHA-256). The text is read once and
    not carried on."""
    pattern = CHUNK.format(least=least, last=most - 1, most=most)
    norm = F.regexp_replace(F.coalesce("text", F.lit("")), f"[{WHITE}]+", "")
    out = docs.select("doc_id", F.coalesce(F.length("text"), F.lit(0)).alias("n_points"), norm.alias("norm"))
    out = out.select("doc_id", "n_points", F.sha2(F.col("norm").cast("binary"), 256).alias("text_sha256"), F.regexp_extract_all("norm", F.lit(pattern), F.lit(0)).alias("chunks"))
    check = lambda c: F.conv(F.substring(F.sha2(c.cast("binary"), 256), 1, 15), 16, 10).cast("long")
    return out.select("doc_id", "n_points", "text_sha256", F.transform("chunks", lambda c: F.xxhash64(c)).alias("recipe"), F.transform("chunks", check).alias("checks"))


def exact_groups(docs: DataFrame) -> DataFrame:
    """Per row of ``docs(doc_id, text)``: which row of its equal texts stays.

    Chunk identifiers are verified over the whole corpus: one that stands for two chunks is
    told by its checks, and the lists compared are then those of identifiers and checks. Lists
    are compared in full. Null text is the empty text; of rows alike in doc_id and text, each
    has the same verdict; a null doc_id loses to any other.
    """
    slim = staged(recipes(docs), "recipes")
    pairs = slim.select(F.explode(F.arrays_zip("recipe", "checks")).alias("x"))
    clash = pairs.groupBy("x.recipe").agg(F.min("x.checks").alias("a"), F.max("x.checks").alias("b")).where("a <> b")
    key = F.col("recipe") if clash.isEmpty() else F.concat("recipe", "checks")
    keyed = slim.select("doc_id", "n_points", "text_sha256", key.alias("key"))
    best = keyed.groupBy("key").agg(F.count(F.lit(1)).alias("group_size"), F.max(F.struct("n_points", F.bitwise_not("doc_id").alias("r"))).alias("best"))
    best = staged(best.select("key", "group_size", F.col("best.n_points").alias("most"), F.bitwise_not("best.r").alias("keep_id")), "groups")
    kept = F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("n_points") == F.col("most"))
    return keyed.join(best, "key").select("doc_id", "keep_id", "group_size", kept.alias("kept"), "text_sha256")


def deduplicated(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns: one of each group of equal texts, and
    one of rows alike in doc_id and normalised text. Only these two columns are looked up, so
    the texts move in one exchange."""
    kept = exact_groups(docs).where("kept").select(F.coalesce("doc_id", F.lit(0)).alias("id"), F.col("doc_id").isNull().alias("none"), F.col("text_sha256").alias("sha")).distinct()
    key = ["id", "none", "sha"]
    norm = F.regexp_replace(F.coalesce("text", F.lit("")), f"[{WHITE}]+", "")
    own = docs.select(
        F.coalesce("doc_id", F.lit(0)).alias("id"), F.col("doc_id").isNull().alias("none"), F.sha2(norm.cast("binary"), 256).alias("sha"),
        F.coalesce(F.length("text"), F.lit(0)).alias("n"), whole_row(docs),
    )
    best = F.max_by("row", F.struct("n", F.xxhash64("row.text"))).alias("row")
    return own.join(kept, key, "left_semi").groupBy(*key).agg(best).select(*map(of_row, docs.columns))


def op5_chunk_recipe_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_groups(table(spark, sf_dir, "documents"))


ORACLE = r"""
WITH d AS (
  SELECT doc_id, coalesce(length(text), 0) AS n,
         sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256
  FROM documents
)
SELECT doc_id, first_value(doc_id) OVER w AS keep_id,
       count(*) OVER (PARTITION BY text_sha256) AS group_size,
       doc_id = first_value(doc_id) OVER w AS kept, text_sha256
FROM d WINDOW w AS (PARTITION BY text_sha256 ORDER BY n DESC, doc_id)
"""
