"""The order-independence of a base's fingerprint is checked over as many tasks as a shuffle has."""

from conftest import DATA

from salvor.queries import stored
from salvor.sources import files


def test_frozen_base_is_dealt_over_all_partitions(spark, monkeypatch):
    seen, fingerprint = [], files.fingerprint

    def watched(df):
        if "Repartition" in df._jdf.queryExecution().optimizedPlan().toString():
            seen.append(df.rdd.getNumPartitions())
        return fingerprint(df)

    monkeypatch.setattr(files, "fingerprint", watched)
    old = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "7")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        stored.frozen_base(spark, DATA)
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert seen == [7]
