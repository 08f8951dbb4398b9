"""Shards along a Hilbert curve over several metadata dimensions, with built-in functions only."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from salvor.llm.common import BROADCAST_ROWS, free_name, of_row, staged, table, whole_row

BITS = 5


def hilbert_index(df: DataFrame, dims: list[str], bits: int, out: str) -> DataFrame:
    """Add the Hilbert curve index of integer coordinates ``dims`` in 0..2^bits - 1.

    The known transform of coordinates to the curve's transposed index: undo the rotations
    from the highest bit down, Gray-encode, then interleave. Each step is an array fold, so
    the expression stays small; it is meant for a table of cells, not of rows.
    """
    n = len(dims)
    steps = ", ".join(f"named_struct('q', {1 << b}, 'i', {i})" for b in range(bits - 1, 0, -1) for i in range(n))
    t = "((X[0] ^ X[s.i]) & (s.q - 1))"
    turn = f"""aggregate(array({steps}), array({", ".join(f"CAST({d} AS INT)" for d in dims)}), (X, s) -> transform(X, (v, k) -> CASE
        WHEN k = 0 AND (X[s.i] & s.q) <> 0 THEN v ^ (s.q - 1)
        WHEN k = 0 OR (k = s.i AND (X[s.i] & s.q) = 0) THEN v ^ {t} ELSE v END))"""
    gray = "transform(__x, (v, k) -> aggregate(slice(__x, 1, k + 1), 0, (a, b) -> a ^ b))"
    flip = f"aggregate(sequence(1, {bits - 1}), 0, (t, b) -> CASE WHEN (__x[{n - 1}] & shiftleft(1, b)) <> 0 THEN t ^ (shiftleft(1, b) - 1) ELSE t END)"
    weave = f"aggregate(sequence({bits - 1}, 0, -1), 0L, (acc, b) -> aggregate(__x, acc, (a, v) -> shiftleft(a, 1) | CAST(shiftright(v, b) & 1 AS BIGINT)))"
    df = df.withColumn("__x", F.expr(turn)).withColumn("__x", F.expr(gray))
    df = df.withColumn("__t", F.expr(flip)).withColumn("__x", F.expr("transform(__x, v -> v ^ __t)"))
    return df.withColumn(out, F.expr(weave)).drop("__x", "__t")


def places(values: DataFrame, name: str, bits: int) -> DataFrame:
    """(__v, __q): for each of the distinct ``values(name)`` its place among them in order, null
    after all, scaled to ``bits`` bits. Values are dealt by range and ranked within their
    partition; only the partitions' counts meet in one task."""
    order = F.col(name).asc_nulls_last()
    n = int(values.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = values.repartitionByRange(n, order).select(F.col(name), F.spark_partition_id().alias("__part"))
    dealt = staged(dealt, "values")
    sizes = dealt.groupBy("__part").agg(F.count(F.lit(1)).alias("__n"))
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select("__part", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__first"), F.sum("__n").over(Window.partitionBy()).alias("__top"))
    rank = F.col("__first") + F.row_number().over(Window.partitionBy("__part").orderBy(order)) - 1
    return dealt.join(F.broadcast(sizes), "__part").select(F.col(name).alias("__v"), F.floor(rank * (1 << bits) / F.col("__top")).cast("int").alias("__q"))


def codes(docs: DataFrame, names: list[str], bits: int) -> DataFrame:
    """One row per combination of the text dimensions ``names`` with the place of each value."""
    out = staged(docs.select(*names).distinct(), "combinations")
    for name in names:
        known = places(out.select(name).distinct(), name, bits).withColumnRenamed("__q", f"__q_{name}")
        out = out.join(known, out[name].eqNullSafe(known["__v"])).drop("__v")
    return staged(out, "codes")


def placed(docs: DataFrame, shards: int, names: tuple[str, ...], bits: int, whole: bool = False) -> DataFrame:
    """doc_id, size, text_crc32, shard and slot of each row, and with ``whole`` the row itself."""
    if 1 << (bits * (len(names) + 1)) > BROADCAST_ROWS:
        raise ValueError(f"{bits} bits of {len(names) + 1} dimensions make more than {BROADCAST_ROWS} cells")
    size = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long") + 1
    crc = F.crc32(F.coalesce("text", F.lit("")).cast("binary"))
    carried = [whole_row(docs)] if whole else []
    slim = docs.select(F.col("doc_id"), size.alias("size"), crc.alias("text_crc32"), *names, *carried)
    known = codes(docs, list(names), bits)
    on = F.lit(True)
    for n in names:
        on = on & slim[n].eqNullSafe(known[n])
    magnitude = F.length(F.bin("size")) - 1  # the whole part of the binary logarithm
    level = F.least(F.lit((1 << bits) - 1), F.floor(magnitude * (1 << bits) / 32).cast("int"))
    dims = [f"__q_{n}" for n in names] + ["__q_size"]
    cell = sum((F.col(d).cast("long") * (1 << (bits * i)) for i, d in enumerate(dims)), F.lit(0).cast("long"))
    keep = ["doc_id", "size", "text_crc32"] + ["row"] * whole
    rows = staged(slim.join(known, on).withColumn("__q_size", level).select(*keep, cell.alias("cell")), "cells")
    cells = rows.select("cell").distinct()
    for i, d in enumerate(dims):
        cells = cells.withColumn(d, F.expr(f"CAST(shiftright(cell, {bits * i}) & {(1 << bits) - 1} AS INT)"))
    cells = hilbert_index(cells, dims, bits, "curve").select("cell", "curve")
    order = ["curve", "doc_id", "text_crc32", "size"]
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = rows.join(F.broadcast(cells), "cell").drop("cell").repartitionByRange(n, *order).withColumn("part", F.spark_partition_id())
    dealt = staged(dealt, "dealt")
    sizes = dealt.groupBy("part").agg(F.count(F.lit(1)).alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"), F.sum("n").over(Window.partitionBy()).alias("total"))
    rank = F.row_number().over(Window.partitionBy("part").orderBy(*order)) - 1
    out = dealt.join(F.broadcast(sizes), "part").withColumn("place", F.col("first") + rank)
    out = out.withColumn("shard", F.expr(f"CAST(place * {shards} DIV total AS INT)"))
    start = F.expr(f"(shard * total + {shards - 1}) DIV {shards}")
    return out.select(*keep, "shard", (F.col("place") - start).cast("long").alias("slot"))


def hilbert_shards(docs: DataFrame, shards: int = 16, names: tuple[str, ...] = ("source", "lang"), bits: int = BITS) -> DataFrame:
    """Deal ``docs(doc_id, text, *names)`` into ``shards`` runs of a Hilbert curve over the text
    dimensions ``names`` and the size's logarithm: file statistics of a shard then bound every
    dimension at once. Counts of shards differ by one at most (law ``rows``).

    Cells (2^(3 bits) for two names; more dimensions or bits than make BROADCAST_ROWS cells are
    refused) get their place on the curve, and rows are dealt by range of curve, doc_id, checksum
    and size, so neither a common source nor a group of copies meets in one task; a row's place is
    its partition's first and its rank in it. One row per partition is broadcast and windowed whole.
    A null text has no bytes; nulls are values of their own; a null doc_id comes first; rows alike
    in all columns stand next to each other in either order; an empty table gives no rows.
    """
    out = placed(docs, shards, names, bits)
    return out.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def write_shards(docs: DataFrame, path: str, shards: int = 16, names: tuple[str, ...] = ("source", "lang"), bits: int = BITS) -> None:
    """Write the rows of ``docs`` as Parquet folders ``shard=N``, each in the order of the curve and
    cut into as many files as its part of the range exchange has tasks. All columns are written
    as they are, nulls and repeated rows too; where one is named shard, the folders are named
    ``shard_=N``. An empty table makes a folder without shards."""
    out = placed(docs, shards, names, bits, whole=True)
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    out = out.repartitionByRange(n, "shard", "slot").sortWithinPartitions("shard", "slot")
    by = free_name("shard", docs.columns)
    out.select(F.col("shard").alias(by), *map(of_row, docs.columns)).write.partitionBy(by).parquet(path)


def op7_hilbert_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hilbert_shards(table(spark, sf_dir, "documents"))


#: CRC-32 by half bytes over the hex digits of a text, with the reflected polynomial's table for 16 values.
_HALF = "[0, 498536548, 997073096, 651767980, 1994146192, 1802195444, 1303535960, 1342533948, 3988292384, 4027552580, 3604390888, 3412177804, 2607071920, 2262029012, 2685067896, 3183342108]"


def _crc(c: str) -> str:
    """The checksum of a text column in SQL, a byte at a time."""
    half = lambda x: f"xor(({x}) >> 4, {_HALF}[1 + CAST(({x}) & 15 AS INTEGER)])"
    pairs = f"regexp_extract_all(hex(encode({c})), '..')"
    return f"xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform({pairs}, lambda b: CAST('0x' || b AS BIGINT))), lambda s, b: {half(half('xor(s, b)'))}), 4294967295)"


#: The curve by a step per bit and dimension: where a coordinate has the bit, the first one's lower
#: bits are inverted, else the lower bits of both are exchanged; then the Gray code and the weave.
ORACLE = f"""
WITH RECURSIVE d AS (
  SELECT doc_id, source, lang, CAST(coalesce(octet_length(encode(text)), 0) + 1 AS BIGINT) AS size, CAST({_crc("coalesce(text, '')")} AS BIGINT) AS text_crc32 FROM documents
),
c AS (SELECT DISTINCT source, lang FROM d),
s AS (SELECT source, CAST(floor((row_number() OVER (ORDER BY source NULLS LAST) - 1) * 32 / count(*) OVER ()) AS BIGINT) AS x FROM (SELECT DISTINCT source FROM c)),
l AS (SELECT lang, CAST(floor((row_number() OVER (ORDER BY lang NULLS LAST) - 1) * 32 / count(*) OVER ()) AS BIGINT) AS y FROM (SELECT DISTINCT lang FROM c)),
e AS (SELECT d.*, s.x, l.y, CAST(length(bin(size)) - 1 AS BIGINT) AS z FROM d JOIN s ON s.source IS NOT DISTINCT FROM d.source JOIN l ON l.lang IS NOT DISTINCT FROM d.lang),
h AS (
  SELECT DISTINCT x, y, z, 0 AS step, x AS a, y AS b, z AS c FROM e
  UNION ALL
  SELECT x, y, z, step + 1, CASE WHEN v & q <> 0 THEN xor(a, q - 1) ELSE xor(a, t) END, CASE WHEN i = 1 AND v & q = 0 THEN xor(b, t) ELSE b END, CASE WHEN i = 2 AND v & q = 0 THEN xor(c, t) ELSE c END
  FROM (SELECT *, xor(a, v) & (q - 1) AS t FROM (SELECT *, CASE i WHEN 0 THEN a WHEN 1 THEN b ELSE c END AS v FROM (SELECT *, step % 3 AS i, CAST(1 AS BIGINT) << (4 - step // 3) AS q FROM h WHERE step < 12)))
),
g AS (SELECT x, y, z, a, xor(a, b) AS b, xor(xor(a, b), c) AS c FROM h WHERE step = 12),
k AS (SELECT *, xor(xor(CASE WHEN c & 2 <> 0 THEN 1 ELSE 0 END, CASE WHEN c & 4 <> 0 THEN 3 ELSE 0 END), xor(CASE WHEN c & 8 <> 0 THEN 7 ELSE 0 END, CASE WHEN c & 16 <> 0 THEN 15 ELSE 0 END)) AS t FROM g),
w AS (SELECT x, y, z, list_sum(list_transform(range(5), lambda p: (((xor(a, t) >> p) & 1) << (3 * p + 2)) + (((xor(b, t) >> p) & 1) << (3 * p + 1)) + (((xor(c, t) >> p) & 1) << (3 * p)))) AS curve FROM k),
r AS (SELECT e.*, row_number() OVER (ORDER BY curve, doc_id, text_crc32, size) - 1 AS place, count(*) OVER () AS total FROM e JOIN w ON w.x = e.x AND w.y = e.y AND w.z = e.z)
SELECT doc_id, size, text_crc32, 'rows' AS law, CAST(place * 16 // total AS INTEGER) AS shard, CAST(place - ((place * 16 // total) * total + 15) // 16 AS BIGINT) AS slot, CAST(NULL AS INTEGER) AS grown_shard FROM r
"""
