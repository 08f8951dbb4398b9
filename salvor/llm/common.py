"""Shared helpers of the training-data operators: table reading, tables written to the
shared folder, distributed ranks, and connected components."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: White space of every word rule here, as a Java regex class body.
WHITE = r"\x20\x09-\x0D"
#: Rows that a broadcast table may have; what could have more is joined without a hint.
BROADCAST_ROWS = 1 << 16
#: Rounds of the component search at most, far beyond what chains and hubs take, so that a fault
#: ends a job.
ROUNDS = 200


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def arrow_batches(spark: SparkSession) -> None:
    """Bound what one Arrow batch holds, so that batches of long texts fit a worker. The limits are
    the session's and the same for every operator, so the order in which plans are made can't
    change them; a row beyond the byte limit has a batch of its own."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2000")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(32 << 20))


def whole_row(df: DataFrame, name: str = "row") -> Column:
    """All columns as one struct, whatever their names."""
    return F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias(name)


def of_row(c: str, name: str = "row") -> Column:
    """A column of ``whole_row`` again under its own name."""
    return F.col(name)[c].alias(c)


def free_name(name: str, columns: list[str]) -> str:
    """``name``, with underscores at its end until no column has it (in any case of letters)."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share, one for each application in it. Only a local
    session may leave it unset; on a cluster each executor would write to its own disk."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = f"file://{tempfile.gettempdir()}/checkpoints"
    return f"{base.rstrip('/')}/salvor-{spark.sparkContext.applicationId}"


def new_path(spark: SparkSession, label: str) -> str:
    """A path in the application's folder, which goes when the driver's JVM ends, by a signal too.
    What a killed driver leaves carries its application's name."""
    p = spark._jvm.org.apache.hadoop.fs.Path(shared_dir(spark))
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    if fs.mkdirs(p):
        fs.deleteOnExit(p)
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


def staged(df: DataFrame, label: str) -> DataFrame:
    """Write a table to the shared folder and read it: lineage ends here, and a lost
    executor costs no recomputation of what stands before."""
    spark, path = df.sparkSession, new_path(df.sparkSession, label)
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._salvor_path = path
    return out


def delete(spark: SparkSession, path: str) -> None:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def release(*frames: DataFrame) -> None:
    """Delete staged tables that no returned frame reads."""
    for df in frames:
        delete(df.sparkSession, df._salvor_path)


def ranked(df: DataFrame, key: str, tie: list[str | Column], out: str = "rank") -> DataFrame:
    """Add the 0-based rank of each row within its ``key`` class, without putting a class
    into one task. ``df`` should be staged, as it is read several times; ``key`` has at most
    BROADCAST_ROWS values, which is checked, as their bucket counts are broadcast.

    A class of n rows is dealt by hash into n / slot buckets; bucket counts give each
    bucket's first rank, and a window ranks within the bucket. Rows equal in every ``tie``
    column are interchangeable; they share a bucket, where only their ranks are made.
    """
    n, values = df.agg(F.count(F.lit(1)), F.count_distinct(key)).first()
    if values > BROADCAST_ROWS:
        raise ValueError(f"{key} has {values} values, more than {BROADCAST_ROWS}")
    slot = max(64, n // 1_000_000)
    cuts = df.groupBy(key).agg(F.ceil(F.count(F.lit(1)) / slot).cast("long").alias("__cuts"))
    dealt = df.join(F.broadcast(cuts), df[key].eqNullSafe(cuts[key])).drop(cuts[key])
    dealt = dealt.withColumn("__sub", F.pmod(F.xxhash64(*tie), F.col("__cuts"))).drop("__cuts")
    before = Window.partitionBy(key).orderBy("__sub").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        dealt.groupBy(key, "__sub")
        .agg(F.count(F.lit(1)).alias("__n"))
        .select(F.col(key).alias("__k"), F.col("__sub").alias("__s"), F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__start"))
    )
    own = Window.partitionBy(key, "__sub").orderBy(*tie)
    return (
        dealt.join(starts, dealt[key].eqNullSafe(starts["__k"]) & (dealt["__sub"] == starts["__s"]))
        .withColumn(out, F.col("__start") + F.row_number().over(own) - 1)
        .drop("__k", "__s", "__start", "__sub")
    )


def components(edges: DataFrame) -> tuple[DataFrame, list[DataFrame]]:
    """Connected components of ``edges(u, v)``: (node, root) per node, root the smallest.

    Every edge is held as (child, parent), parent < child. A child with several parents
    keeps the smallest and passes the others on as its children; when each child has one
    parent, the forest is flattened by pointer jumping. A node of many smaller neighbours is a
    hub as a child in the first round: its rows meet one row of ``least`` in a join, whose side
    of edges AQE splits, and each of them then has another child. Later a hub is a parent, which
    is joined to a table with one row per child, split likewise. Nothing is collected; each round
    is a staged table. Returns the frame and its staged tables.
    """
    low, high = F.least("u", "v"), F.greatest("u", "v")
    e = staged(edges.where("u <> v").select(high.alias("child"), low.alias("parent")).distinct(), "edges")
    for _ in range(ROUNDS):
        least = e.groupBy("child").agg(F.min("parent").alias("p"), F.count(F.lit(1)).alias("n"))
        if least.where("n > 1").isEmpty():
            break
        joined = e.join(least, "child")
        nxt = joined.select(
            F.explode(F.when(F.col("parent") == F.col("p"), F.array(F.struct("child", F.col("p").alias("parent"))))
                      .otherwise(F.array(F.struct(F.col("parent").alias("child"), F.col("p").alias("parent"))))).alias("x")
        ).select("x.*").distinct()
        nxt = staged(nxt, "edges")
        release(e)
        e = nxt
    else:
        raise RuntimeError(f"components not found in {ROUNDS} rounds")
    for _ in range(ROUNDS):
        up = e.select(F.col("child").alias("parent"), F.col("parent").alias("grand"))
        nxt = staged(e.join(up, "parent", "left").select("child", F.coalesce("grand", "parent").alias("parent"), F.col("grand").isNotNull().alias("moved")), "roots")
        release(e)
        e = nxt
        if e.where("moved").isEmpty():
            break
        e2 = e.select("child", "parent")
        e2._salvor_path = e._salvor_path
        e = e2
    else:
        raise RuntimeError(f"components not found in {ROUNDS} rounds")
    roots = e.select(F.col("child").alias("node"), F.col("parent").alias("root"))
    nodes = roots.unionByName(roots.select(F.col("root").alias("node"), "root").distinct())
    return nodes, [e]
