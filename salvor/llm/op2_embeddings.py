"""Embedding near-duplicates by product quantisation."""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salvor.llm.common import arrow_batches, components, release, staged, table
from salvor.llm.op9_simhash import forest

COSINE = 0.93
#: Vectors and bytes that the index is fitted on at most, lists at most, lists that each vector
#: visits at least, rows of a tile.
SAMPLE, SAMPLE_BYTES, LISTS, PROBES, TILE = 20_000, 64 << 20, 1024, 8, 512
SUBSPACES, CODES = 8, 64


@dataclass
class Index:
    """Coarse centroids, and a codebook for each subspace of the residuals."""

    dim: int
    centroids: np.ndarray
    books: np.ndarray

    def padded(self, rows: pa.Array | pa.ChunkedArray | list) -> np.ndarray:
        """Unit vectors in double precision, cut into subspaces of equal width by zeros at the end."""
        col = pa.array(rows, pa.list_(pa.float64())) if isinstance(rows, list) else rows
        col = col.combine_chunks() if isinstance(col, pa.ChunkedArray) else col
        n = pc.list_value_length(col).to_numpy(zero_copy_only=False).astype(np.int64)
        row = np.repeat(np.arange(len(n)), n)
        out = np.zeros((len(n), self.dim))
        out[row, np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)] = col.flatten().to_numpy(zero_copy_only=False)
        out /= np.abs(out).max(axis=1, keepdims=True)
        return out / np.linalg.norm(out, axis=1, keepdims=True)

    def lists(self, x: np.ndarray, probes: int, reach: float) -> np.ndarray:
        """The nearest lists of each vector, nearest first; -1 where a list is so far that no
        vector within ``reach`` of x can be in it (its half space begins beyond)."""
        c = self.centroids
        d = (c**2).sum(1) - 2 * x @ c.T
        near = np.argsort(d, axis=1, kind="stable")[:, :probes]
        best = near[:, :1]
        gap = np.take_along_axis(d, near, 1) - np.take_along_axis(d, best, 1)
        apart = 2 * np.linalg.norm(c[near] - c[best], axis=2)
        return np.where((apart == 0) | (gap <= reach * apart + 1e-9), near, -1)

    def codes(self, x: np.ndarray, own: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Residual codes of each vector, and how far the coded vector is from it."""
        rest = (x - self.centroids[own]).reshape(len(x), len(self.books), -1)
        code = np.stack([((b**2).sum(1) - 2 * rest[:, s] @ b.T).argmin(1) for s, b in enumerate(self.books)], 1)
        error = rest - self.books[np.arange(len(self.books)), code]
        return code.astype(np.uint8), np.sqrt((error**2).sum((1, 2)))

    def table_cosines(self, q: np.ndarray, of_list: int, code: np.ndarray) -> np.ndarray:
        """Asymmetric cosines of exact queries with coded vectors, by table look-up."""
        parts = q.reshape(len(q), len(self.books), -1)
        out = np.repeat((q @ self.centroids[of_list])[:, None], len(code), 1)
        for s, b in enumerate(self.books):
            out += (parts[:, s] @ b.T)[:, code[:, s]]
        return out


def k_means(x: np.ndarray, k: int, rounds: int = 12, seed: int = 7) -> np.ndarray:
    rng = np.random.default_rng(seed)
    c = x[rng.choice(len(x), min(k, len(x)), replace=False)].copy()
    for _ in range(rounds):
        own = ((c**2).sum(1) - 2 * x @ c.T).argmin(1)
        n = np.bincount(own, minlength=len(c))
        total = np.zeros_like(c)
        np.add.at(total, own, x)
        c[n > 0] = total[n > 0] / n[n > 0][:, None]
    return c


def fit(rows: pa.Array | pa.ChunkedArray | list, dim: int, total: int) -> Index:
    """Fit on a bounded sample of vectors; the number of lists follows the whole table, up to LISTS."""
    dim = -(-dim // SUBSPACES) * SUBSPACES
    index = Index(dim, np.zeros((1, dim)), np.zeros((SUBSPACES, 1, dim // SUBSPACES)))
    x = index.padded(rows)
    index.centroids = k_means(x, int(np.clip(total // 512, 1, LISTS)))
    rest = (x - index.centroids[index.lists(x, 1, 0)[:, 0]]).reshape(len(x), SUBSPACES, -1)
    index.books = np.stack([np.resize(k_means(np.ascontiguousarray(rest[:, s]), CODES), (CODES, dim // SUBSPACES)) for s in range(SUBSPACES)])
    return index


def probes_of(lists: int) -> int:
    """Lists that each vector visits: the square root of their number, so that recall holds as they
    grow. Of pairs of isotropic 64-d vectors, cosine 0.932, 0.998 or more meet at 8 to 1,024 lists."""
    return max(PROBES, math.isqrt(lists - 1) + 1)


def usable(embedding) -> F.Column:
    """Neither null, empty nor zero, and every component present and finite."""
    good = F.forall(embedding, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(good & F.exists(embedding, lambda x: x != 0), F.lit(False))


def close_links(classes: DataFrame, index: Index, least: float = COSINE, probes: int | None = None) -> DataFrame:
    """Rows (cid, root, degree) per block for each class that links there: the block's smallest
    class linked to it, and how many vectors it links to. ``classes``: cid, grp, embedding, copies.

    A class stands in its own list and visits its other near lists. Within a list, members are
    compared with members and visitors: table cosines plus the coding error bound the cosine
    from above, so what they leave out is below the threshold, and the rest is decided by the
    exact cosine. Lists are dealt by hash into tiles, and each pair of tiles is a block, so a
    large list is many blocks; a pair seen in two lists counts in the lower one. Vectors stay in
    their own precision until they are compared. A pair can be missed only where neither visits
    the other's list: ``probes`` as many as there are lists finds every pair.
    """
    spark = classes.sparkSession
    arrow_batches(spark)
    probes = probes or probes_of(len(index.centroids))
    reach = float(np.sqrt(2 - 2 * least)) + 1e-9
    kind = classes.schema["embedding"].dataType.elementType.typeName()
    vector = F.col("embedding") if kind in ("float", "double") else F.col("embedding").cast("array<double>")
    slim = classes.select("cid", "grp", "copies", vector.alias("embedding"))
    row = f"cid long, grp string, copies long, embedding {slim.schema['embedding'].dataType.simpleString()}, list int, probes array<int>, code binary, error double"
    names = [x.split()[0] for x in row.split(", ")]

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x = index.padded(batch.column(3))
            near = index.lists(x, probes, reach)
            code, error = index.codes(x, near[:, 0])
            size = np.append(0, (near >= 0).sum(1).cumsum()).astype(np.int32)
            visits = pa.ListArray.from_arrays(pa.array(size), pa.array(near[near >= 0].astype(np.int32)))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(near[:, 0], pa.int32()), visits, pa.array([c.tobytes() for c in code], pa.binary()), pa.array(error)], names)

    placed = staged(slim.mapInArrow(place, row), "lists")
    sizes = placed.select("grp", F.explode("probes").alias("at")).groupBy("grp", "at").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    sizes = staged(sizes.select("grp", "at", F.ceil(F.col("n") / TILE).cast("long").alias("tiles"), F.monotonically_increasing_id().alias("place")), "list-sizes")
    seen = placed.withColumn("at", F.explode("probes")).join(sizes, ["grp", "at"])
    tile = F.pmod(F.xxhash64("cid", F.lit(3)), F.col("tiles"))
    seen = seen.withColumn("tile", tile).withColumn("other", F.explode(F.expr("sequence(0L, tiles - 1)")))
    block = ["place", "a", "b"]
    seen = seen.select("place", F.least("tile", "other").alias("a"), F.greatest("tile", "other").alias("b"), "tile", "at", "cid", "copies", "list", "error", "code", "probes", "embedding")
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    seen = seen.repartition(n, *block).sortWithinPartitions(*block)

    def compare(rows: pa.RecordBatch) -> pa.RecordBatch | None:
        col = lambda name: rows.column(name).to_numpy(zero_copy_only=False)
        lists, tile, cid, copies = col("list"), col("tile"), col("cid"), col("copies")
        at, split = int(col("at")[0]), col("a")[0] != col("b")[0]
        own = lists == at
        base = np.flatnonzero(own)
        if not len(base):
            return None
        x = index.padded(rows.column("embedding"))
        code = np.frombuffer(b"".join(rows.column("code").take(pa.array(base)).to_pylist()), np.uint8).reshape(len(base), -1)
        error = col("error")[base]
        pairs = []
        for start in range(0, len(x), 256):
            q = np.arange(start, min(start + 256, len(x)))
            likely = index.table_cosines(x[q], at, code) + error >= least - 1e-9
            if split:
                likely &= tile[q][:, None] != tile[base]
            i, j = np.nonzero(likely)
            i, j = q[i], base[j]
            keep = ~own[i] | (cid[i] < cid[j])
            i, j = i[keep], j[keep]
            for s in range(0, len(i), 65536):
                a, b = i[s : s + 65536], j[s : s + 65536]
                sure = np.einsum("ij,ij->i", x[a], x[b]) >= least
                pairs.append((a[sure], b[sure]))
        i, j = (np.concatenate(p) for p in zip(*pairs, strict=True)) if pairs else (np.empty(0, int),) * 2
        if not len(i):
            return None
        many = pc.list_value_length(rows.column("probes")).to_numpy(zero_copy_only=False)
        visits = np.full((len(x), many.max()), -1)
        visits[np.arange(visits.shape[1]) < many[:, None]] = rows.column("probes").flatten().to_numpy()
        for s in range(0, len(i), 65536):  # a pair that the visitor's own, lower list sees too counts there
            part = slice(s, s + 65536)
            twice = ~own[i[part]] & (lists[i[part]] < at) & (visits[j[part]] == lists[i[part]][:, None]).any(axis=1)
            i[part] = np.where(twice, -1, i[part])
        i, j = i[i >= 0], j[i >= 0]
        degree = np.bincount(i, copies[j], len(x)) + np.bincount(j, copies[i], len(x))
        root = forest(len(x), i, j)
        k = np.flatnonzero(degree)
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in (cid[k], cid[root[k]], degree[k].astype(np.int64))], ["cid", "root", "degree"]) if len(k) else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in blocks_of(batches, 3):
            if (out := compare(rows)) is not None:
                yield out

    out = staged(seen.mapInArrow(run, "cid long, root long, degree long"), "close")
    release(placed, sizes)
    return out


def blocks_of(batches: Iterator[pa.RecordBatch], n_keys: int) -> Iterator[pa.RecordBatch]:
    """Runs of rows that are alike in their first ``n_keys`` columns of whole numbers, each as one batch."""

    def joined(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
        return parts[0] if len(parts) == 1 else pa.Table.from_batches(parts).combine_chunks().to_batches()[0]

    held, key = [], None
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = np.stack([batch.column(k).to_numpy() for k in range(n_keys)])
        cuts = np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0)) + 1
        for a, b in itertools.pairwise([0, *cuts.tolist(), batch.num_rows]):
            if held and tuple(keys[:, a]) != key:
                yield joined(held)
                held = []
            key = tuple(keys[:, a])
            held.append(batch.slice(a, b - a))
    if held:
        yield joined(held)


def near_embeddings(vectors: DataFrame, least: float = COSINE, probes: int | None = None) -> DataFrame:
    """vec_id, n_links, component_id and kept of each row of ``vectors(vec_id, embedding, label)``.

    Equal vectors of a label are one class with a count, so copies link without being compared.
    Vectors of different length never link. Unusable vectors, and those whose label is null,
    stand alone. Rows with the same vec_id are vectors of their own; a null vec_id never names
    a component that has another; an empty table gives no rows. The index is fitted on SAMPLE
    vectors or SAMPLE_BYTES of them, the first by a hash; all are indexed.
    """
    grp = F.concat_ws("/", F.col("label").cast("string"), F.size("embedding").cast("string"))
    v = vectors.select("vec_id", "embedding", F.when(usable(F.col("embedding")) & F.col("label").isNotNull(), grp).alias("grp"))
    good = v.where("grp is not null")
    classes = good.groupBy("grp", "embedding").agg(F.count(F.lit(1)).alias("copies"), F.min("vec_id").alias("least"))
    classes = staged(classes.withColumn("cid", F.monotonically_increasing_id()), "vectors")
    total, dim = classes.agg(F.count(F.lit(1)), F.max(F.size("embedding"))).first()
    if total:
        most = max(1, min(SAMPLE, SAMPLE_BYTES // (8 * dim)))
        sample = classes.orderBy(F.xxhash64("embedding"), "cid").select("embedding").limit(most).toArrow()["embedding"]
        close = close_links(classes, fit(sample, dim, total), least, probes)
    else:
        close = v.sparkSession.createDataFrame([], "cid long, root long, degree long")
    member, used = components(close.select(F.col("cid").alias("u"), F.col("root").alias("v")))
    degree = close.groupBy("cid").agg(F.sum("degree").alias("degree"))
    named = classes.select("cid", "grp", "embedding", "copies", "least").join(degree, "cid", "left").join(member, classes["cid"] == member["node"], "left")
    named = staged(named.select("grp", "embedding", "least", (F.col("copies") - 1 + F.coalesce("degree", F.lit(0))).alias("n_links"), F.coalesce("root", "cid").alias("root")), "members")
    first = staged(named.groupBy("root").agg(F.min("least").alias("component_id")), "first")
    known = staged(named.join(first, "root").select("grp", "embedding", "n_links", "component_id"), "named")
    release(named, first, *used)
    found = good.join(known, ["grp", "embedding"]).select("vec_id", "n_links", "component_id")
    alone = v.where("grp is null").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return found.unionByName(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


def op2_embedding_pq(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_embeddings(table(spark, sf_dir, "embeddings"))


#: All pairs of a label by brute force, then each vector's smallest reachable one.
ORACLE = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS x FROM embeddings
  WHERE label IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda e: e IS NULL OR NOT isfinite(e))) = 0
    AND len(list_filter(embedding, lambda e: e <> 0)) > 0
),
link AS (
  SELECT a.vec_id AS u, b.vec_id AS w FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.x) = len(b.x)
  WHERE list_cosine_similarity(a.x, b.x) >= 0.93
),
reach AS (SELECT vec_id AS u, vec_id AS w FROM embeddings UNION SELECT r.u, l.w FROM reach r JOIN link l ON l.u = r.w)
SELECT e.vec_id, (SELECT count(*) FROM link WHERE u = e.vec_id) AS n_links, c.component_id, c.component_id = e.vec_id AS kept
FROM embeddings e JOIN (SELECT u, min(w) AS component_id FROM reach GROUP BY u) c ON c.u = e.vec_id
"""
