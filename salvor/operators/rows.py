"""Relational operators over whole tables: union with drift, keep-last, shards, samples, limits."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from salvor.functions.text import code_points, has_text
from salvor.schema import DEDUP_POLICIES, LEGACY_COLUMNS, RESULT_TYPES

_WIDTH = [T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType]


def supertype(a: T.DataType, b: T.DataType) -> T.DataType:
    """The type that holds both: null gives way, numbers widen, booleans with numbers become
    numbers, arrays and structs of the same fields meet by their parts, and anything else meets as
    text."""
    if a == b or isinstance(b, T.NullType):
        return a
    if isinstance(a, T.NullType):
        return b
    if isinstance(a, T.ArrayType) and isinstance(b, T.ArrayType):
        return T.ArrayType(supertype(a.elementType, b.elementType))
    if isinstance(a, T.StructType) and isinstance(b, T.StructType) and a.names == b.names:
        return T.StructType([T.StructField(x.name, supertype(x.dataType, y.dataType)) for x, y in zip(a, b, strict=True)])
    ranks = [_WIDTH.index(type(x)) if type(x) in _WIDTH else 0 if isinstance(x, T.BooleanType) else None for x in (a, b)]
    if None in ranks:
        return T.StringType()
    top = _WIDTH[max(ranks)]
    return T.DoubleType() if top is T.FloatType and {type(a), type(b)} & {T.IntegerType, T.LongType} else top()


def relaxed_union(*frames: DataFrame) -> DataFrame:
    """Union by name: missing columns are null, and a column's types meet in their supertype."""
    kinds: dict[str, T.DataType] = {}
    for f in frames:
        for x in f.schema:
            kinds[x.name] = supertype(kinds.get(x.name, T.NullType()), x.dataType)

    def cast(f: DataFrame) -> DataFrame:
        have = {x.name: x.dataType for x in f.schema}
        cols = []
        for n, k in kinds.items():
            c = F.col(f"`{n}`") if n in have else F.lit(None)
            if isinstance(have.get(n), T.BooleanType) and isinstance(k, T.NumericType):
                c = c.cast("int")
            cols.append(c.cast(k).alias(n) if have.get(n) != k else c)
        return f.select(*cols)

    return reduce(DataFrame.unionByName, map(cast, frames))


def concrete(df: DataFrame) -> DataFrame:
    """Columns without a type get their declared one (text by default), before any sink."""
    return df.select(*[F.col(x.name).cast(RESULT_TYPES.get(x.name, T.StringType())).alias(x.name) if isinstance(x.dataType, T.NullType) else F.col(x.name) for x in df.schema])


def align(df: DataFrame, columns: list[str], types: dict[str, T.DataType] | None = None) -> DataFrame:
    """Exactly ``columns``: missing ones null, others dropped, types cast leniently."""
    cols = [F.col(c) if c in df.columns else F.lit(None) for c in columns]
    return df.select(*[(c.try_cast(types[n]) if types and n in types else c).alias(n) for n, c in zip(columns, cols, strict=True)])


def available(df: DataFrame, wanted: list[str]) -> DataFrame:
    return df.select(*[c for c in wanted if c in df.columns])


def without_legacy(df: DataFrame) -> DataFrame:
    return df.drop(*LEGACY_COLUMNS)


def keep_last(df: DataFrame, key: str, order: list[str | Column]) -> DataFrame:
    """The last row of each key by ``order`` (ascending, nulls first). The plan holds a partial
    group limit before its exchange, so at most one row a key and task is moved."""
    last = [(F.col(o) if isinstance(o, str) else o).desc_nulls_last() for o in order]
    return df.withColumn("__rn", F.row_number().over(Window.partitionBy(key).orderBy(*last))).where("__rn = 1").drop("__rn")


def keep_last_wide(df: DataFrame, key: str, order: list[str], position: str) -> DataFrame:
    """keep_last for rows with long texts: winners are found by an aggregate over keys alone, with a
    map-side part, then joined back by key, ``order`` and ``position``. The hash table of the join
    holds keys, so texts move once and are never sorted. ``df`` is read twice, so it must be stored
    and ``position`` (such as a file's name and row) the same on every read; it makes rows of a key
    distinct."""
    at = [*order, position]
    best = df.groupBy(key).agg(F.max(F.struct(*at)).alias("__best")).select(F.col(key).alias("__key"), *[F.col("__best")[c].alias(f"__best_{k}") for k, c in enumerate(at)])
    on = df[key].eqNullSafe(best["__key"])
    for k, c in enumerate(at):
        on = on & df[c].eqNullSafe(best[f"__best_{k}"])
    return df.join(best.hint("shuffle_hash"), on, "left_semi")


def by_policy(df: DataFrame, policy: str, position: str, key: str = "id", wide: bool = False) -> DataFrame:
    """keep_last by a named policy, made total by ``position``, with ``wide`` as keep_last_wide;
    helper columns are dropped."""
    order = [*DEDUP_POLICIES[policy]]
    out = keep_last_wide(df, key, order, position) if wide else keep_last(df, key, [*order, position])
    return out.drop(*[c for c in out.columns if c.startswith("__")])


def lookup(df: DataFrame, dimension: DataFrame, on: tuple[str, str], value: str, name: str) -> DataFrame:
    """``df`` with the ``value`` that ``dimension`` has for ``on`` (a column of each), as ``name`` (in
    place of a column of that name); null where it has none. The dimension's key is unique; Spark broadcasts it where its size allows."""
    d = dimension.select(F.col(on[1]).alias("__on"), F.col(value).alias(name))
    key = df.select(F.col(on[0]).alias("__key"), *[F.col(f"`{c}`") for c in df.columns if c != name])
    return key.join(d, F.col("__key") == F.col("__on"), "left").drop("__on", "__key")


def merged_metadata(df: DataFrame, new: Column, columns: list[str]) -> DataFrame:
    """Fields of the struct ``new`` over the columns of those names where they aren't null; a list
    becomes text joined by commas."""
    kinds = df.select(new.alias("x")).schema["x"].dataType
    text = lambda c: F.concat_ws(", ", new[c]) if isinstance(kinds[c].dataType, T.ArrayType) else new[c].cast("string")
    value = lambda c: F.when(new[c].isNotNull(), text(c))
    return df.withColumns({c: F.coalesce(value(c), F.col(c)) if c in df.columns else value(c) for c in columns if c in kinds.names})


def upsert(base: DataFrame, delta: DataFrame, key: str = "id") -> DataFrame:
    """Base rows, replaced or joined by delta rows of the same key (each unique by key)."""
    both = relaxed_union(base.withColumn("__rank", F.lit(0)), delta.withColumn("__rank", F.lit(1)))
    return keep_last(both, key, ["__rank"]).drop("__rank")


def best_deferred(parts: DataFrame, quality: Column, key: str = "id") -> DataFrame:
    """The best saved row of each key: quality, then text length, then the later part and row."""
    cols = [F.col(c) for c in parts.columns if c not in ("__part", "__pos")]
    rank = F.struct(quality, code_points(F.col("text")), F.col("__part"), F.col("__pos"))
    return parts.groupBy(key).agg(F.max_by(F.struct(*cols), rank).alias("x")).select("x.*")


def md5_long(*cols: Column) -> Column:
    """32 bits of an MD5 as a long: a hash that other engines can compute as well."""
    return F.conv(F.substring(F.md5(F.concat_ws(":", *cols).cast("binary")), 1, 8), 16, 10).cast("long")


def shard(key: Column, shards: int, seed: int = 20260807, portable: bool = False) -> Column:
    """A deterministic, total and disjoint shard of a key."""
    h = md5_long(F.lit(str(seed)), key) if portable else F.xxhash64(F.lit(seed), key)
    return F.pmod(h, F.lit(shards)).cast("int")


def shard_counts(df: DataFrame, shards: int, **how) -> DataFrame:
    """Rows of every shard, empty ones too."""
    n = df.groupBy(shard(F.col("id"), shards, **how).alias("shard")).agg(F.count(F.lit(1)).alias("n"))
    every = df.sparkSession.range(shards).select(F.col("id").cast("int").alias("shard"))
    return every.join(n, "shard", "left").select("shard", F.coalesce("n", F.lit(0)).cast("long").alias("n_rows"))


def hash_sample(df: DataFrame, n: int, seed: int, key: str = "id") -> DataFrame:
    """The n rows first by a seeded hash of their key, the same on every run."""
    return df.orderBy(md5_long(F.lit(str(seed)), F.col(key)), key).limit(n)


def stratified_sample(strata: dict[str, DataFrame], sizes: dict[str, int], seed: int) -> DataFrame:
    """A hash sample of each stratum, labelled by ``sample_group``; raises where one is short."""
    parts = []
    for name, df in strata.items():
        if len(df.take(sizes[name])) < sizes[name]:
            raise ValueError(f"stratum {name} has fewer than {sizes[name]} rows")
        parts.append(hash_sample(df, sizes[name], seed).withColumn("sample_group", F.lit(name)))
    return relaxed_union(*parts)


def two_tier_limit(first: DataFrame, second: DataFrame, n: int, order: str) -> DataFrame:
    """n rows of ``first``, the remainder from ``second``, each by ``order``."""
    both = relaxed_union(first.withColumn("tier", F.lit(0)), second.withColumn("tier", F.lit(1)))
    return both.orderBy("tier", order).limit(n)


def strategy_jobs(rows: DataFrame, strategies: list[str], seed: int) -> DataFrame:
    """Every row with every strategy (a short list), in a seeded order."""
    each = F.explode(F.array(*map(F.lit, strategies))).alias("strategy")
    out = rows.select("*", each)
    return out.withColumn("job_order", md5_long(F.lit(str(seed)), F.col("id"), F.col("strategy")))


def profile(df: DataFrame) -> DataFrame:
    """Rows, distinct ids (null is one), rows with text, pending rows, rows by archive."""
    ids = F.count_distinct("id") + F.max(F.col("id").isNull().cast("int"))
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"), F.coalesce(ids, F.lit(0)).cast("long").alias("n_ids"), F.count_if(has_text(F.col("text"))).alias("n_text"),
        F.count_if(F.coalesce(F.col("needs_archive"), F.lit(False))).alias("n_pending"), F.count_if(F.coalesce(F.col("fetch_method") == "wayback", F.lit(False))).alias("n_wayback"),
    )


def missing_keys(expected: DataFrame, have: DataFrame, key: str = "id") -> DataFrame:
    return expected.select(key).distinct().join(have.select(key), key, "left_anti")
