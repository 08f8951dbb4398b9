"""Every operator and stage on columns whose names clash or hold dots, nulls, repeats and empty tables."""

from __future__ import annotations

import re

import corpus_pipeline
import pytest
from conftest import rows_of
from pyspark.sql import functions as F

from salvor.llm import op1_mixing, op2_embeddings, op3_chat, op4_warc, op5_exact_dedup, op6_lines, op7_sharding, op8_quality, op9_simhash, op10_packing
from salvor.llm.common import BROADCAST_ROWS, free_name, ranked, shared_dir

MORE = ("score", "predicted", "held_out", "n_removed", "n_lines", "shard", "a.b", "row", "th", "gone", "part", "d", "s", "size", "own_hash", "id", "none", "key", "rank", "cell", "copies")
LONG = "some words of a long text stand here. " * 3000
ROWS = [
    (1, "One text stands here, in words.\nshared line", "s1", "en"), (1, "One text stands here, in words.\nshared line", "s1", "en"), (2, None, None, None), (3, "", "s2", "en"), (4, " \n ", "s2", None),
    (None, "A text without an id.\nshared line", "s3", "de"), (6, LONG, "s4", "de"), (7, LONG + "end", "s5", "de"), (8, "Eins zwei drei vier.\nshared line", None, "de"),
    *((20 + k, f"Text {k} has its own words {k * 7919}.\nshared line\nend {k}", f"s{k}", "en") for k in range(9)),
]


@pytest.fixture(scope="module")
def odd(spark):
    d = spark.createDataFrame(ROWS, "doc_id long, text string, source string, lang string").withColumn("n_chars", F.length("text").cast("long"))
    return d.select("*", *[F.lit(f"own {c}").alias(c) for c in MORE])


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(k, 1, 0) for k in range(30)], "doc_id long, quality int, toxic int")


def kept_own(rows, columns=MORE) -> bool:
    return all(r[c] == f"own {c}" for r in rows for c in columns)


def test_columns_pass_through(spark, odd, labels, tmp_path):
    scored = op8_quality.scored(odd, labels)
    assert scored.columns == [*odd.columns, "held_out_", "score_", "predicted_"] and kept_own(scored.collect())
    assert op8_quality.accepted(odd, labels).columns == odd.columns
    cleaned = op6_lines.without_boilerplate(odd)
    assert cleaned.columns == [*odd.columns, "n_lines_", "n_removed_"] and kept_own(cleaned.collect()) and cleaned.count() == len(ROWS)
    for out in (op1_mixing.mixed(odd), op9_simhash.one_of_each(odd), op5_exact_dedup.deduplicated(odd), op6_lines.documents_without_boilerplate(odd)):
        got = out.collect()
        assert out.columns == odd.columns and got and kept_own(got)
    assert op7_sharding.hilbert_shards(odd, 3).count() == len(ROWS) and op10_packing.packed_documents(odd).count() >= len(ROWS)
    assert op1_mixing.decisions(odd).agg(F.sum("copies")).first()[0] == len(ROWS) and op5_exact_dedup.exact_groups(odd).count() == len(ROWS)
    assert op9_simhash.near_duplicates(odd).count() == len(ROWS)
    op7_sharding.write_shards(odd, f"file://{tmp_path}/shards", 3)
    back = spark.read.parquet(f"file://{tmp_path}/shards")
    assert rows_of(back.select(*[F.col(f"`{c}`") for c in odd.columns])) == rows_of(odd) and {r["shard_"] for r in back.select("shard_").distinct().collect()} == {0, 1, 2}


def test_other_operators_ignore_further_columns(spark, tmp_path):
    extra = lambda df, *names: df.select("*", *[F.lit(1).alias(n) for n in names])
    vectors = extra(spark.createDataFrame([(1, [1.0, 0.0], 0), (2, [1.0, 0.01], 0), (2, [1.0, 0.01], 0)], "vec_id long, embedding array<float>, label int"), "grp", "cid", "copies", "least", "a.b", "root")
    assert sorted((r["vec_id"], r["n_links"], r["component_id"]) for r in op2_embeddings.near_embeddings(vectors).collect()) == [(1, 2, 1), (2, 2, 1), (2, 2, 1)]
    turns = extra(spark.createDataFrame([(1, 0, "user", "a")], "conv_id long, turn long, role string, text string"), "turns", "spans", "formatted", "a.b")
    assert op3_chat.digests(op3_chat.formatted(turns)).first()["n_turns"] == 1
    pages = extra(spark.createDataFrame([(1, "u", "x")], "page_id long, url string, html string"), "digest", "payload", "first", "again", "bytes", "a.b")
    op4_warc.write_archives(pages, f"file://{tmp_path}/warc")
    assert op4_warc.read_archives(spark, f"file://{tmp_path}/warc").first()["page_id"] == 1


@pytest.fixture(scope="module")
def folder(odd, labels, tmp_path_factory):
    path = f"file://{tmp_path_factory.mktemp('odd')}"
    odd.write.parquet(f"{path}/documents.parquet")
    labels.write.parquet(f"{path}/labels.parquet")
    return path


def test_stages_keep_columns_nulls_and_repeats(spark, folder, odd):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    out = {name: stage(spark, docs, folder) for name, stage in corpus_pipeline.STAGES}
    for name, df in list(out.items())[:-1]:
        got = df.collect()
        assert df.columns == odd.columns and got and kept_own(got), name
    assert out["quality classifier"].count() == len(ROWS)  # one class: nothing is rejected
    by = {(r["doc_id"], r["text"]): r for r in out["line dedup"].collect()}
    assert (2, None) in by and (3, "") in by and sum("shared line" in (t or "") for _, t in by) == 1
    assert all(r["n_chars"] == (None if r["text"] is None else len(r["text"])) for r in by.values())
    near = out["SimHash near-dedup"].collect()
    assert sorted(str(r["doc_id"]) for r in near if not (r["text"] or "").strip()) == ["2"] and sum(r["doc_id"] == 1 for r in near) == 1
    assert any(r["doc_id"] is None for r in near)
    words = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    mixed = out["mixing sources"].collect()
    assert all(words(r["text"]) for r in mixed)
    assert sorted(str(r["doc_id"]) for r in out["best-fit packing"].where("piece = 0").collect()) == sorted(str(r[0]) for r in ROWS)


def test_pipeline_of_odd_and_empty_tables(spark, folder, odd, tmp_path):
    assert corpus_pipeline.run(spark, folder).count() > 0
    none = f"file://{tmp_path}"
    odd.limit(0).write.parquet(f"{none}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{none}/labels.parquet")
    assert corpus_pipeline.run(spark, none).count() == 0


def test_free_names():
    assert free_name("a", ["b"]) == "a" and free_name("a", ["A", "a_"]) == "a__"


def test_bounds_of_broadcasts_are_checked(spark, odd):
    with pytest.raises(ValueError, match="cells"):
        op7_sharding.hilbert_shards(odd, names=("source", "lang", "text"))
    with pytest.raises(ValueError, match="values"):
        ranked(spark.range(BROADCAST_ROWS + 1).withColumn("x", F.lit(0)), "id", ["x"])


def test_a_cluster_needs_a_shared_folder():
    class Context:
        master, applicationId = "spark://host:7077", "app"

    class Session:
        sparkContext = Context()

        class conf:
            get = staticmethod(lambda key, default=None: default)

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_dir(Session())
    Context.master = "local[2]"
    assert shared_dir(Session()).endswith("/checkpoints/salvor-app")
