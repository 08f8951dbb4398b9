"""Recorded archive answers as JSON lines, read by Spark's own reader on any file system."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SCHEMA = "url string, phase string, timestamp string, status int, error string, elapsed_s double, payload string"
UNREADABLE = "unreadable"


def read_capture_log(spark: SparkSession, path: str, unreadable: bool = False) -> DataFrame:
    """Files of one JSON object a line with the fields of SCHEMA, in any order; missing ones are null.

    Files are split, columns pruned and filters pushed into the parser. Lines that can't be read are
    left out; with ``unreadable`` they stand as rows of phase ``unreadable``, the line as payload,
    so that they can be counted and none is lost.
    """
    names = [x.split()[0] for x in SCHEMA.split(", ")]
    if not unreadable:
        return spark.read.schema(SCHEMA).option("mode", "DROPMALFORMED").json(path)
    raw = spark.read.schema(f"{SCHEMA}, _line string").option("columnNameOfCorruptRecord", "_line").json(path)
    bad = F.col("_line").isNotNull()
    new = {"phase": F.when(bad, UNREADABLE).otherwise(F.col("phase")), "payload": F.coalesce("_line", "payload")}
    return raw.select(*[new.get(n, F.col(n)).alias(n) for n in names])
