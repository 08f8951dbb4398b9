"""The corpus pipeline, stage by stage, against brute force over each stage's own input."""

from __future__ import annotations

import re
from collections import Counter, defaultdict

import corpus_pipeline
import numpy as np
import pytest
from conftest import DATA
from test_llm_operators import brute_print, fill, naive

from salvor.llm import op6_lines, op8_quality, op10_packing
from salvor.llm.common import staged


@pytest.fixture(scope="module")
def stages(spark):
    docs, out = spark.read.parquet(f"{DATA}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES:
        new = staged(stage(spark, docs, DATA), "test-stage")
        out.append((name, docs, new))
        docs = new
    return out


def test_names_and_columns(stages):
    assert [n for n, *_ in stages] == [n for n, _ in corpus_pipeline.STAGES] and corpus_pipeline.ORACLE_SQL is None
    assert all(new.columns == old.columns for _, old, new in stages[:-1])


def test_quality_stage(spark, stages):
    _, old, new = stages[0]
    model = op8_quality.train(old, spark.read.parquet(f"{DATA}/labels.parquet"))
    rows = old.collect()
    keep = model.score(op8_quality.feature_rows([r["text"] for r in rows])) >= op8_quality.THRESHOLD
    assert sorted(r["doc_id"] for r, k in zip(rows, keep, strict=True) if k) == sorted(r["doc_id"] for r in new.collect())


def test_line_stage(stages):
    _, old, new = stages[1]
    places, sites = defaultdict(list), defaultdict(set)
    rows = sorted(old.collect(), key=lambda r: r["doc_id"])
    bare = lambda x: re.sub(r"^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$", "", x)
    for r in rows:
        for k, x in enumerate(r["text"].split("\n")):
            if bare(x):
                places[bare(x)].append((r["doc_id"], k))
                sites[bare(x)].add(r["source"])
    gone = {p for x, where in places.items() if len(sites[x]) >= op6_lines.MIN_SITES for p in sorted(where)[1:]}
    want = {r["doc_id"]: "\n".join(x for k, x in enumerate(r["text"].split("\n")) if (r["doc_id"], k) not in gone) for r in rows}
    assert {r["doc_id"]: r["text"] for r in new.collect()} == want
    assert all(r["n_chars"] == len(r["text"]) for r in new.collect())


def test_near_stage(stages):
    _, old, new = stages[2]
    rows = sorted(old.collect(), key=lambda r: r["doc_id"])
    f = np.array([brute_print(r["text"]) for r in rows], np.uint64)
    root = np.arange(len(f))
    near = np.bitwise_count(f[:, None] ^ f[None]) <= 4
    while (low := np.array([root[near[i]].min() for i in range(len(f))])).tolist() != root.tolist():
        root = low
    assert sorted(r["doc_id"] for r in new.collect()) == [rows[i]["doc_id"] for i in sorted(set(root.tolist()))]


def test_mix_stage(stages):
    _, old, new = stages[3]
    words = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    sizes, taken, text = Counter(), Counter(), {}
    for r in old.collect():
        sizes[r["source"]] += words(r["text"])
        text[r["doc_id"]] = r["text"]
    for r in new.collect():
        taken[r["source"]] += words(r["text"])
        assert text[r["doc_id"]].startswith(r["text"])
    assert all(abs(taken[s] - t) <= 1 for s, t in fill({s: sizes[s] for s in sizes}).items())


def test_pack_stage(stages):
    _, old, new = stages[4]
    pieces = op10_packing.tokenised(old).collect()
    got = new.collect()
    assert sorted((r["doc_id"], r["piece"], r["ids_crc32"]) for r in got) == sorted((r["doc_id"], r["piece"], r["ids_crc32"]) for r in pieces)
    assert len({r["sequence_id"] for r in got}) == naive([r["length"] for r in pieces], 2048)


def test_run_equals_its_stages(spark, stages):
    key = lambda df: sorted((r["doc_id"], r["piece"], r["length"], r["ids_crc32"]) for r in df.collect())
    assert key(corpus_pipeline.run(spark, DATA)) == key(stages[-1][2])
