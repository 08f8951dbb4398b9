"""Readers, provenance, sinks and the atomic commit of a table, on any Hadoop file system."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from salvor.operators.rows import concrete, relaxed_union

REQUIRED = ("id", "url", "publish_date")
CHECKPOINTS = "_ckpt_*.parquet"


def require(df: DataFrame, columns: tuple[str, ...]) -> DataFrame:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"columns are missing: {', '.join(missing)}")
    return df


def columns_of(spark: SparkSession, path: str) -> list[str]:
    """The columns of a stored table, from its schema alone."""
    return spark.read.parquet(path).columns


def from_rows(spark: SparkSession, rows: list[dict], schema: str) -> DataFrame:
    """A table from a few rows of the driver's, by a given schema; what a row lacks is null."""
    names = [x.name for x in T.StructType.fromDDL(schema)]
    return spark.createDataFrame([tuple(r.get(n) for n in names) for r in rows], schema)


def read_stories(spark: SparkSession, path: str, last_wins: bool = False) -> DataFrame:
    """Stories from CSV (a byte-order mark is skipped): all text, id cast, columns and unique ids
    required; with ``last_wins``, the last row of an id stays instead."""
    df = spark.read.csv(path, header=True, multiLine=True, escape='"', inferSchema=False)
    df = require(df, REQUIRED).withColumn("id", F.col("id").cast("string"))
    if last_wins:
        m = F.struct(F.col("_metadata.file_path"), F.monotonically_increasing_id())
        return df.select("*", m.alias("__at")).groupBy("id").agg(F.max_by(F.struct(*[F.col(f"`{c}`") for c in df.columns]), "__at").alias("x")).select("x.*")
    if not df.groupBy("id").count().where("count > 1").isEmpty():
        raise ValueError("ids are not unique")
    return df


def read_dimension(spark: SparkSession, path: str) -> DataFrame:
    """Source to country; only the two columns are read, rows with a null in either are dropped."""
    return spark.read.csv(path, header=True, multiLine=True, escape='"').select("country", "source_name").na.drop()


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.exists(p)


def source_files(spark: SparkSession, folder: str, canonical: str = "results.parquet") -> list[str]:
    """The canonical table first, then checkpoints by name; raises where there is none."""
    fs, p = _fs(spark, f"{folder}/{CHECKPOINTS}")
    found = [s.getPath().toString() for s in (fs.globStatus(p) or [])]
    out = [f"{folder}/{canonical}"] * exists(spark, f"{folder}/{canonical}") + sorted(found)
    if not out:
        raise FileNotFoundError(f"no result files in {folder}")
    return out


def source_snapshot(spark: SparkSession, paths: list[str]) -> list[dict]:
    """Name, size and time of change of each source, to tell later whether one has changed."""
    out = []
    for path in paths:
        fs, p = _fs(spark, path)
        s = fs.getFileStatus(p)
        out.append({"name": p.getName(), "size": fs.getContentSummary(p).getLength(), "mtime_ns": s.getModificationTime() * 1_000_000})
    return out


def read_sources(spark: SparkSession, paths: list[str]) -> list[DataFrame]:
    """Each source with its rank, time of change, whether it is canonical, and a row position that is
    the same on every read: file and row in it."""
    out = []
    for rank, (path, s) in enumerate(zip(paths, source_snapshot(spark, paths), strict=True)):
        out.append(spark.read.parquet(path).withColumns({
            "id": F.col("id").cast("string"), "__source_rank": F.lit(rank), "__source_mtime": F.lit(s["mtime_ns"]), "__canonical": F.lit(not s["name"].startswith("_ckpt_")),
            "__position": F.struct("_metadata.file_name", "_metadata.row_index"),
        }))
    return out


def provenance(df: DataFrame) -> DataFrame:
    """File name, size and time of change of each row's file."""
    m = F.col("_metadata")
    return df.select("*", m["file_name"].alias("file_name"), m["file_size"].alias("file_size"), m["file_modification_time"].alias("file_time"))


def write_table(df: DataFrame, path: str, by: str | None = None) -> None:
    """Parquet with zstd and statistics; by a column's value, one folder and file for each."""
    out = concrete(df)
    w = (out.repartition(by) if by else out).write.option("compression", "zstd")
    (w.partitionBy(by) if by else w).parquet(path)


def part_files(spark: SparkSession, folder: str) -> list[str]:
    """The parts ``part_*`` of a folder in order of their names."""
    fs, p = _fs(spark, f"{folder}/part_*")
    return sorted(s.getPath().toString() for s in (fs.globStatus(p) or []))


def read_parts(spark: SparkSession, folder: str) -> DataFrame | None:
    """All parts with ``__part`` (their place) and ``__pos`` (file and row); None where there are none."""
    frames = [spark.read.parquet(p).withColumns({"__part": F.lit(k), "__pos": F.struct("_metadata.file_name", "_metadata.row_index")}) for k, p in enumerate(part_files(spark, folder))]
    return relaxed_union(*frames) if frames else None


def fingerprint(df: DataFrame) -> str:
    """A content fingerprint that no order of rows or files changes. Sums wrap nowhere: each row's
    hash enters as two halves."""
    cols = sorted(df.columns)
    h = df.select(F.xxhash64(*cols).alias("a"), F.xxhash64(F.lit(1), *cols).alias("b"))
    half = lambda c, k: F.sum(F.shiftrightunsigned(c, k).bitwiseAND(F.lit(0xFFFFFFFF)).cast("decimal(38,0)"))
    r = h.agg(F.count(F.lit(1)), half("a", 0), half("a", 32), half("b", 0), half("b", 32)).first()
    return "-".join(str(x or 0) for x in r)


def rename(spark: SparkSession, old: str, new: str) -> None:
    fs, a = _fs(spark, old)
    if not fs.rename(a, _fs(spark, new)[1]):
        raise OSError(f"cannot rename {old} to {new}")


def make_folder(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    fs.mkdirs(p)


def remove(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    fs.delete(p, True)


def commit(spark: SparkSession, staging: str, target: str) -> None:
    """Put a validated staging table in place, keeping one earlier generation; on failure the
    earlier table is put back."""
    backup = f"{target}.bak"
    had = exists(spark, target)
    if had:
        remove(spark, backup)
        rename(spark, target, backup)
    try:
        rename(spark, staging, target)
    except Exception:
        if had:
            rename(spark, backup, target)
        raise


def readable(spark: SparkSession, path: str) -> bool:
    try:
        spark.read.parquet(path).count()
        return True
    except Exception:  # any damage counts: footer, page or missing part
        return False


def recover(spark: SparkSession, target: str) -> str:
    """After a crash: keep a readable table; put the backup in place of a missing or damaged one,
    which is set aside. Returns what was done."""
    backup, good = f"{target}.bak", exists(spark, target) and readable(spark, target)
    if good:
        return "kept"
    if exists(spark, target):
        remove(spark, f"{target}.damaged")
        rename(spark, target, f"{target}.damaged")
    if exists(spark, backup) and readable(spark, backup):
        rename(spark, backup, target)
        return "restored"
    return "absent"


def write_text(spark: SparkSession, path: str, text: str, bom: bool = False) -> None:
    """Write a small file whole: beside its place, then renamed over it."""
    fs, p = _fs(spark, path)
    _, tmp = _fs(spark, f"{path}.tmp")
    out = fs.create(tmp, True)
    out.write(bytearray((b"\xef\xbb\xbf" if bom else b"") + text.encode()))
    out.close()
    if fs.exists(p):
        fs.delete(p, False)
    if not fs.rename(tmp, p):
        raise OSError(f"cannot write {path}")


def read_text(spark: SparkSession, path: str) -> str:
    fs, p = _fs(spark, path)
    stream = fs.open(p)
    try:
        return bytes(spark._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode("utf-8-sig")
    finally:
        stream.close()


def write_json(spark: SparkSession, path: str, value, tries: int = 10) -> None:
    """write_text of JSON, tried again after short waits while the place is held."""
    import time

    for k in range(1, tries + 1):
        try:
            return write_text(spark, path, json.dumps(value, ensure_ascii=False, indent=2))
        except OSError:
            if k == tries:
                raise
            time.sleep(0.05 * k)


def write_failed_urls(failed: DataFrame, folder: str, array: int = 10_000) -> int:
    """Failed URLs as text files beside a header with their count, and as JSON arrays of at most
    ``array`` URLs, one a line. The executors write both. Returns the count."""
    spark = failed.sparkSession
    urls = failed.where("url is not null").select("url")
    urls.write.text(f"{folder}/failed_urls_txt/urls")
    written = spark.read.text(f"{folder}/failed_urls_txt/urls")
    n = written.count()
    write_text(spark, f"{folder}/failed_urls_txt/header.txt", f"# failed URLs: {n}\n")
    part = written.select("value", F.floor(F.monotonically_increasing_id() / array).alias("part"))
    part.groupBy("part").agg(F.to_json(F.collect_list("value")).alias("value")).select("value").write.mode("overwrite").text(f"{folder}/failed_urls_json")
    return n


def report(overall: dict, by_country: list[dict], by_method: list[dict], n_input: int) -> str:
    """A plain-text report of outcome statistics."""
    rows = [("input URLs", n_input), *[(k.replace("_", " "), v) for k, v in overall.items() if k != "scope"]]
    lines = ["Run statistics", "", *[f"  {k:<24}{v:>12,}" for k, v in rows], "", "Recovered by method", *[f"  {r['fetch_method']:<24}{r['n_recovered']:>12,}" for r in by_method], "", "By country"]
    lines += [f"  {r['scope']:<10}" + "".join(f" {k}={v:,}" for k, v in r.items() if k != "scope") for r in by_country]
    return "\n".join(lines) + "\n"
