"""Mixing sources to target weights by Efraimidis-Spirakis sampling."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from salvor.llm.common import WHITE, of_row, staged, table, whole_row

WEIGHTS = (5, 2, 1)
SHARE = 1.5
CAP = 2
SEED = 20260807
#: Buckets of the sampling key for each e-fold, and parts of a bucket.
COARSE, FINE = 64, 1024


def plain_weight() -> Column:
    """A document's quality weight, 0.05 to 1, from its ``size`` in words and ``n`` code points: it
    falls as the mean word length leaves five characters."""
    off = F.abs(F.coalesce(F.try_divide(F.col("n") - F.col("size") + 1, F.col("size")), F.lit(99.0)) - 5)
    return F.greatest(F.lit(0.05), F.exp(-off / 5))


def keyed(docs: DataFrame, seed: int = SEED, quality: Column | None = None) -> DataFrame:
    """doc_id, source, size in words, number of equal rows, and the logarithm of the exponential
    sampling key -ln(u) / quality. u comes from a hash of doc_id and text that other engines can
    compute, so reruns agree. ``quality``: a column of ``docs``, such as a classifier's score, held
    to 0.05 or more and null as that, in place of ``plain_weight``."""
    words = F.regexp_count(F.coalesce("text", F.lit("")), F.lit(f"[^{WHITE}]+")).cast("long")
    own = F.lit(0.0) if quality is None else F.greatest(F.lit(0.05), F.coalesce(quality.cast("double"), F.lit(0.0)))
    digest = F.md5(F.coalesce("text", F.lit("")).cast("binary"))
    slim = docs.select("doc_id", "source", words.alias("size"), F.coalesce(F.length("text"), F.lit(0)).alias("n"), F.xxhash64("text").alias("text_hash"), digest.alias("md5"), own.alias("own"))
    slim = slim.groupBy("doc_id", "source", "size", "n", "text_hash", "md5", "own").agg(F.count(F.lit(1)).alias("copies"))
    h = F.md5(F.concat_ws(":", F.lit(str(seed)), F.coalesce(F.col("doc_id").cast("string"), F.lit("")), "md5").cast("binary"))
    u = (F.conv(F.substring(h, 1, 12), 16, 10).cast("long") + 0.5) / float(1 << 48)
    weight = plain_weight() if quality is None else F.col("own")
    return slim.withColumn("place", F.log(-F.log(u) / weight) * COARSE).select(
        "doc_id", "source", "size", "copies", "text_hash", "place",
        F.floor("place").alias("b1"), F.floor((F.col("place") - F.floor("place")) * FINE).alias("b2"),
    )


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, cap: int = CAP) -> DataFrame:
    """Add ``target`` to ``sizes(source, source_size)``: ``share`` of all words by weight, at most
    ``cap`` times a source's own, the excess going to the others by weight.

    With sources in order of the level at which they reach their cap, prefix sums give the one
    level of the rest, which repeated resharing comes to; where none is left, all are at their cap.
    Windows see one row per source.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    turn = (F.row_number().over(by_name) - 1) % len(weights)
    out = sizes.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), (turn + 1).cast("int")).cast("double"))
    out = out.withColumn("full", F.col("source_size") * cap / F.col("weight"))
    order = Window.orderBy("full", F.col("source").asc_nulls_last())
    whole = Window.partitionBy()
    before = F.coalesce(F.sum(F.col("source_size") * cap).over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    after = F.sum("weight").over(order.rowsBetween(0, Window.unboundedFollowing))
    out = out.withColumn("level", (F.sum("source_size").over(whole) * share - before) / after)
    open_ = F.when(F.col("full") > F.col("level"), F.struct("full", "level"))
    level = F.min(open_).over(whole)["level"]
    most = F.col("source_size") * float(cap)
    return out.select("source", "source_size", F.coalesce(F.when(level.isNotNull(), F.least(most, level * F.col("weight"))), most).alias("target"))


def decisions(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, cap: int = CAP, quality: Column | None = None) -> DataFrame:
    """Per distinct row of ``docs(doc_id, text, source)``: ``copies`` of it, its size, its source's
    size and target, and ``taken`` words of each copy.

    A source is first taken in whole epochs; the rest of its target goes to the documents with
    the smallest keys, up to the budget, where one document is cut at a word. The place of the
    cut is found from word sums by key bucket, then by part of that bucket; only that part is
    sorted and prefix-summed, so no source meets in one task. Equal rows share alike. Null text
    has size 0; null is a source of its own; an empty table gives no rows.
    """
    slim = staged(keyed(docs, quality=quality), "keys")
    mass = F.col("size") * F.col("copies")
    sizes = slim.groupBy("source").agg(F.sum(mass).alias("source_size"))
    goal = targets(sizes, weights, share, cap)
    epochs = F.coalesce(F.floor(F.try_divide("target", "source_size")), F.lit(0))
    goal = goal.withColumn("epochs", epochs).withColumn("budget", F.round(F.col("target") - F.col("epochs") * F.col("source_size")).cast("long"))
    goal = staged(goal, "targets")

    def cut(sums: DataFrame, bucket: str, base: str) -> DataFrame:
        """The bucket of each source in which its budget ends, and the words before it."""
        order = Window.partitionBy("source").orderBy(bucket)
        upto = F.sum("words").over(order.rowsBetween(Window.unboundedPreceding, 0)) + F.col(base)
        return sums.withColumn("upto", upto).where((F.col("upto") >= F.col("budget")) & (F.col("upto") - F.col("words") < F.col("budget"))).withColumn("before", F.col("upto") - F.col("words")).drop("upto", "words")

    def on(left: DataFrame, right: DataFrame, *more: str):
        c = left["source"].eqNullSafe(right["source"])
        for m in more:
            c = c & (left[m] == right[m])
        return c

    sums = slim.groupBy("source", "b1").agg(F.sum(mass).alias("words"))
    wanted = goal.select("source", "budget")
    sums = sums.join(wanted, on(sums, wanted)).drop(wanted["source"]).withColumn("before", F.lit(0).cast("long"))
    first = staged(cut(sums, "b1", "before"), "cut")
    inner = slim.join(first, on(slim, first, "b1")).drop(first["source"], first["b1"])
    parts = inner.groupBy("source", "b1", "b2", "budget", "before").agg(F.sum(mass).alias("words"))
    second = cut(parts, "b2", "before").select("source", F.col("b1").alias("c1"), F.col("b2").alias("c2"), "before")
    goal = staged(goal.join(second, on(goal, second), "left").drop(second["source"]), "cuts")

    rows = slim.join(goal, on(slim, goal)).drop(goal["source"])
    here = F.struct("b1", "b2")
    edge = F.struct(F.col("c1").alias("b1"), F.col("c2").alias("b2"))
    at = F.coalesce(here == edge, F.lit(False))
    keep = ["doc_id", "source", "text_hash", "copies", "size", "source_size", "target"]
    base = F.col("epochs") * F.col("size")
    clear = rows.where(~at).select(*keep, (base + F.when(F.coalesce(here < edge, F.lit(False)), F.col("size")).otherwise(0)).cast("long").alias("taken"))
    order = Window.partitionBy("source").orderBy("place", "doc_id", "text_hash").rowsBetween(Window.unboundedPreceding, -1)
    left = F.col("budget") - F.col("before") - F.coalesce(F.sum(mass).over(order), F.lit(0))
    part = F.floor(F.greatest(F.lit(0), F.least(mass, left)) / F.col("copies"))
    last = goal.where("c1 is not null")
    near = slim.join(last, on(slim, last) & (slim["b1"] == last["c1"]) & (slim["b2"] == last["c2"])).drop(last["source"])
    edges = near.select(*keep, (base + part).cast("long").alias("taken"))
    return clear.unionByName(edges)


def mixed(docs: DataFrame, **how) -> DataFrame:
    """The mix itself: each row of ``docs`` as often as it is taken whole, and once more, cut
    after its last taken word, where the budget ends within it. Columns as in ``docs``, whatever
    their names; a document without words is not taken."""
    plan = decisions(docs, **how).where("taken > 0").select(F.col("doc_id").alias("d"), F.col("source").alias("s"), "text_hash", "size", "taken")
    plan = staged(plan, "mix")
    own = docs.select(whole_row(docs), F.xxhash64("text").alias("h"))
    on = own["row"]["doc_id"].eqNullSafe(plan["d"]) & (own["h"] == plan["text_hash"]) & own["row"]["source"].eqNullSafe(plan["s"])
    rest = (F.col("taken") % F.col("size")).cast("int")
    times = (F.col("taken") / F.col("size")).cast("int")
    parts = F.concat(F.array_repeat(F.lit(-1), times), F.when(rest > 0, F.array(rest)).otherwise(F.array()))
    out = own.join(plan, on).withColumn("part", F.explode(parts))
    before, whole = F.col("row.text"), F.col("part") < 0
    words = F.regexp_extract_all(before, F.lit(f"[{WHITE}]*[^{WHITE}]+"), F.lit(0))
    text = F.when(whole, before).otherwise(F.array_join(F.slice(words, F.lit(1), F.greatest(F.lit(0), F.col("part"))), ""))
    new = {"text": text, "n_chars": F.when(whole, F.col("row.n_chars")).otherwise(F.length(text)).cast("long") if "n_chars" in docs.columns else None}
    return out.select(*[new[c].alias(c) if c in new else of_row(c) for c in docs.columns])


def op1_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = decisions(table(spark, sf_dir, "documents"))
    each = F.explode(F.expr("sequence(1L, copies)"))
    return out.withColumn("__copy", each).select("doc_id", "size", "source_size", "target", "taken")


#: The same rule over sorted keys: sources in order of the level that fills them, the one level of
#: the rest, whole epochs, then keys in order up to the budget. md5 gives the draws.
ORACLE = r"""
WITH d AS (
  SELECT doc_id, source, text, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size, coalesce(length(text), 0) AS n FROM documents
),
k AS (
  SELECT doc_id, source, size, md5(coalesce(text, '')) AS h,
         ln(-ln((CAST('0x' || substr(md5('20260807:' || coalesce(CAST(doc_id AS VARCHAR), '') || ':' || md5(coalesce(text, ''))), 1, 12) AS BIGINT) + 0.5) / 281474976710656)
            / greatest(0.05, exp(-abs(CASE WHEN size = 0 THEN 99.0 ELSE (n - size + 1) / size END - 5) / 5))) AS place
  FROM d
),
s AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size, [5, 2, 1][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3] AS weight FROM d GROUP BY source
),
f AS (SELECT *, 2 * source_size / weight AS "full" FROM s),
l AS (
  SELECT *, (1.5::DOUBLE * sum(source_size) OVER () - coalesce(sum(2 * source_size) OVER (ORDER BY "full", source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
            / sum(weight) OVER (ORDER BY "full", source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM f
),
t AS (
  SELECT source, source_size, CAST(CASE WHEN fixed IS NULL THEN 2 * source_size ELSE least(2 * source_size, fixed * weight) END AS DOUBLE) AS target
  FROM (SELECT *, (SELECT arg_min(level, "full") FROM l WHERE "full" > level) AS fixed FROM l)
),
b AS (SELECT *, CASE WHEN source_size = 0 THEN 0 ELSE CAST(floor(target / source_size) AS BIGINT) END AS epochs FROM t),
g AS (
  SELECT k.doc_id, k.size, b.source_size, b.target, b.epochs, round(b.target - b.epochs * b.source_size) AS budget,
         coalesce(sum(k.size) OVER (PARTITION BY k.source ORDER BY k.place, k.doc_id, k.h ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM k JOIN b ON k.source IS NOT DISTINCT FROM b.source
)
SELECT doc_id, size, source_size, target, CAST(epochs * size + greatest(0, least(size, budget - before)) AS BIGINT) AS taken FROM g
"""
