"""SimHash near-duplicates by bit-sliced comparison."""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salvor.llm.common import arrow_batches, components, of_row, release, staged, table, whole_row

RADIUS = 4
SHINGLE = 4
SEED = 42
#: Rows of a tile, of one band key on average, and of a band key that is cut by further bits.
TILE, MEAN, HOT = 1024, 256, 4096


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """The SimHash of a whole text. Words are runs outside ASCII white space, with A-Z in lower
    case; fewer words than a shingle has make one shingle, none give 0."""
    from xxhash import xxh64_intdigest

    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    k = min(shingle, len(words))
    spans = zip(starts[: len(words) - k + 1].tolist(), ends[k - 1 :].tolist(), strict=True)
    counts, n = np.zeros(64, np.int64), 0
    while part := [xxh64_intdigest(joined[a:b], SEED) for a, b in itertools.islice(spans, 1 << 16)]:
        bits = np.unpackbits(np.array(part, "<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(0, dtype=np.int64)
        n += len(part)
    return int(np.packbits(2 * counts > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, th, fp) for each row: a hash of its text, and its 64 bits as a signed long."""
    arrow_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = np.array([fingerprint(t.as_py(), shingle) for t in batch.column(2)], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(fps, pa.int64())], ["doc_id", "th", "fp"])

    return docs.select(F.col("doc_id").cast("long"), F.xxhash64("text").alias("th"), "text").mapInArrow(run, "doc_id long, th long, fp long")


def bit_planes(fps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The bits of each fingerprint (64 x n), and the same planes packed into 64-bit words."""
    bits = np.unpackbits(fps.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").T
    pad = np.zeros((64, -bits.shape[1] % 64), np.uint8)
    return bits, np.ascontiguousarray(np.packbits(np.hstack([bits, pad]), axis=1, bitorder="little")).view("<u8")


def close_pairs(left: np.ndarray, right: np.ndarray, radius: int = RADIUS) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs (i, j) with left[i] and right[j] at most ``radius`` bits apart.

    The right side stands as bit planes, so one word operation serves 64 distances. Each plane,
    compared with a left bit, enters vertical counters through carry-save adders; counts above
    the radius set a lane dead, and left rows whose lanes are all dead leave the comparison.
    """
    bits, _ = bit_planes(left)
    _, planes = bit_planes(right)
    n, width = len(right), planes.shape[1]
    digits = radius.bit_length() + 2
    out_i, out_j = [], []
    step = max(1, (1 << 17) // width)
    for at in range(0, len(left), step):
        rows = np.arange(at, min(at + step, len(left)))
        counter = np.zeros((digits, len(rows), width), "<u8")
        dead = np.zeros((len(rows), width), "<u8")
        dead[:, -1] = ~np.uint64(0) << np.uint64(n % 64) if n % 64 else 0
        for b in range(0, 64, 2):
            flip = bits[b : b + 2, rows].astype("<u8") * ~np.uint64(0)
            x, y = planes[b] ^ flip[0][:, None], planes[b + 1] ^ flip[1][:, None]
            ones = counter[0]
            half = x ^ y
            carry = (x & y) | (ones & half)
            counter[0] = ones ^ half
            for d in range(1, digits):
                counter[d], carry = counter[d] ^ carry, counter[d] & carry
            dead |= carry
            if b % 8 == 6:
                dead |= above(counter, radius)
                live = (dead != ~np.uint64(0)).any(axis=1)
                if not live.all():
                    rows, counter, dead = rows[live], counter[:, live], dead[live]
                    if not len(rows):
                        break
        if len(rows):
            near = np.unpackbits((~dead).view(np.uint8), axis=1, bitorder="little")[:, :n]
            i, j = np.nonzero(near)
            out_i.append(rows[i])
            out_j.append(j)
    return (np.concatenate(out_i), np.concatenate(out_j)) if out_i else (np.empty(0, int), np.empty(0, int))


def above(counter: np.ndarray, radius: int) -> np.ndarray:
    """Lanes whose vertical counter is greater than the radius."""
    more, same = np.zeros_like(counter[0]), np.full_like(counter[0], ~np.uint64(0))
    for d in range(len(counter) - 1, -1, -1):
        if radius >> d & 1:
            same = same & counter[d]
        else:
            more = more | (same & counter[d])
            same = same & ~counter[d]
    return more


def forest(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """For each of n nodes the smallest node of its component under the pairs (i, j)."""
    label = np.arange(n)
    while len(i):
        low = np.minimum(label[i], label[j])
        new = label.copy()
        np.minimum.at(new, label[i], low)
        np.minimum.at(new, label[j], low)
        while (new[new] != new).any():
            new = new[new]
        label = new[label]
        differ = label[i] != label[j]
        i, j = i[differ], j[differ]
    return label


def bands(total: int, radius: int, mean: int = MEAN) -> tuple[list[list[tuple[int, int]]], int]:
    """Band combinations such that any two fingerprints within the radius agree on one of them,
    and how many bits of each to use. With m + radius bands at most ``radius`` differ, so some m
    agree; m grows until a key holds ``mean`` rows on average. Every choice finds all pairs."""
    want = max(4, (max(1, total) // mean).bit_length())
    for m in range(1, 5):
        n = m + radius
        edge = [64 * k // n for k in range(n + 1)]
        spans = [(a, b - a) for a, b in itertools.pairwise(edge)]
        sets = [list(c) for c in itertools.combinations(spans, m)]
        width = min(sum(w for _, w in s) for s in sets)
        if width >= want:
            break
    return sets, min(want, width)


def parts_of_rest(spans: list[tuple[int, int]], bits: int, radius: int) -> list[int]:
    """Masks (as signed longs) that cut the bits which a band's key leaves out into radius + 1 parts:
    of two fingerprints in that band within the radius, one part is alike."""
    used = [b for start, width in spans for b in range(start, start + width)][:bits]
    rest = [b for b in range(64) if b not in used]
    edge = [len(rest) * k // (radius + 1) for k in range(radius + 2)]
    masks = [sum(1 << b for b in rest[x:y]) for x, y in itertools.pairwise(edge)]
    return [m - (1 << 64) if m >> 63 else m for m in masks]


def links(distinct: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Edges (u, v) that connect all of ``distinct(fp)``, staged, within the radius.

    Each fingerprint goes to one block for each band combination. A key with more than HOT rows is
    cut by parts of its other bits, as exactly as by bands. In a key with more than TILE rows, those
    within the radius of its smallest fingerprint are linked to it, which connects them; the others
    are dealt by hash into tiles and compared with all, so a dense group costs its rows times those
    that are far from its smallest. A block returns its components' edges, not its pairs.
    """
    sets, bits = bands(distinct.count(), radius)

    def key(k: int, spans: list[tuple[int, int]]):
        out, used = F.lit(0).cast("long"), 0
        for start, width in spans:
            width = min(width, bits - used)
            if width > 0:
                out = out.bitwiseOR(F.shiftleft(F.shiftrightunsigned("fp", start).bitwiseAND(F.lit((1 << width) - 1)), used))
                used += width
        return out.bitwiseOR(F.lit(k << 48))

    sized = lambda df: staged(df.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.min("fp").alias("pivot")).where("n > 1"), "bands")
    keyed = distinct.select("fp", F.explode(F.array(*[key(k, s) for k, s in enumerate(sets)])).alias("key"))
    sizes = sized(keyed)
    met = keyed.join(sizes, "key")
    if not sizes.where(F.col("n") > HOT).isEmpty():
        masks = F.array(*[F.array(*[F.lit(m).cast("long") for m in parts_of_rest(s, bits, radius)]) for s in sets])
        part = F.posexplode(F.element_at(masks, (F.shiftright("key", 48) + 1).cast("int"))).alias("j", "mask")
        hot = met.where(F.col("n") > HOT).select("fp", "key", part).select("fp", F.xxhash64("key", "j", F.col("fp").bitwiseAND(F.col("mask"))).alias("key"))
        met = met.where(F.col("n") <= HOT).unionByName(hot.join(sized(hot), "key"))
    near = (F.col("n") > TILE) & (F.bit_count(F.col("fp").bitwiseXOR(F.col("pivot"))) <= radius)
    met = met.withColumn("near", near)
    large = staged(met.where(F.col("n") > TILE).groupBy("key").agg(F.count_if("near").alias("n_near"), F.count_if(~F.col("near")).alias("n_far")), "large-bands")
    spokes = met.where("near and fp <> pivot").select(F.col("pivot").alias("u"), F.col("fp").alias("v")).distinct()
    tiles = lambda c: F.ceil(F.col(c) / TILE).cast("long")
    dealt = met.join(large.select("key", tiles("n_near").alias("t_near"), tiles("n_far").alias("t_far")), "key", "left").fillna({"t_near": 0, "t_far": 1})
    at = lambda c: F.pmod(F.xxhash64("fp", F.lit(7)), F.greatest(F.lit(1), F.col(c)))
    dealt = dealt.withColumn("tile", F.when(F.col("near"), at("t_near")).otherwise(F.col("t_near") + at("t_far")))
    first = F.when(F.col("near"), F.col("t_near")).otherwise(0)
    others = F.when(F.col("t_far") > 0, F.sequence(first, F.col("t_near") + F.col("t_far") - 1)).otherwise(F.array().cast("array<bigint>"))
    dealt = dealt.withColumn("other", F.explode(others))
    dealt = dealt.select("key", F.least("tile", "other").alias("a"), F.greatest("tile", "other").alias("b"), "tile", "fp")
    block = ["key", "a", "b"]
    n = int(dealt.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = dealt.repartition(n, *block).sortWithinPartitions(*block)

    def compare(cols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        fps, tile, a, b = np.ascontiguousarray(cols[4]).view("<u8"), cols[3], cols[1][0], cols[2][0]
        if a == b:
            i, j = close_pairs(fps, fps, radius)
            i, j = i[i < j], j[i < j]
        else:
            left, right = np.flatnonzero(tile == a), np.flatnonzero(tile == b)
            if not (len(left) and len(right)):
                return np.empty(0, np.int64), np.empty(0, np.int64)
            i, j = close_pairs(fps[left], fps[right], radius)
            i, j = left[i], right[j]
        root = forest(len(fps), i, j)
        child = np.flatnonzero(root != np.arange(len(fps)))
        return cols[4][child], cols[4][root[child]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def blocks():
            held = np.empty((5, 0), np.int64)
            for batch in batches:
                cols = np.hstack([held, np.array([c.to_numpy(zero_copy_only=False) for c in batch.columns], np.int64).reshape(5, -1)])
                cut = np.flatnonzero((cols[:3, 1:] != cols[:3, :-1]).any(axis=0)) + 1
                parts = np.split(cols, cut, axis=1)
                held = parts[-1]
                yield from parts[:-1]
            if held.shape[1]:
                yield held

        for cols in blocks():
            if cols.shape[1] > 1:
                u, v = compare(cols)
                if len(u):
                    yield pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], ["u", "v"])

    return dealt.mapInArrow(run, "u long, v long").unionByName(spokes)


def near_duplicates(docs: DataFrame, radius: int = RADIUS, shingle: int = SHINGLE) -> DataFrame:
    """doc_id, th (a hash of the text), fp, root (a fingerprint of the component) and component_id
    of each row of ``docs(doc_id, text)``.

    Fingerprints within ``radius`` bits link; a component is named by its smallest doc_id. Equal
    fingerprints are one node, so copies cost nothing. Null and empty texts have fingerprint 0
    and link like any other; a null doc_id takes part and never names a component that has
    another; repeated rows are alike; an empty table gives no rows.
    """
    slim = staged(fingerprints(docs, shingle), "fingerprints")
    nodes = staged(slim.groupBy("fp").agg(F.min("doc_id").alias("least")), "nodes")
    edges = staged(links(nodes.select("fp"), radius), "links")
    member, used = components(edges)
    named = nodes.join(member, nodes["fp"] == member["node"], "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    named = staged(named, "members")
    first = staged(named.groupBy("root").agg(F.min("least").alias("component_id")), "components")
    known = staged(named.join(first, "root").select("fp", "root", "component_id"), "named")
    release(edges, named, first, *used)
    return slim.join(known, "fp").select("doc_id", "th", "fp", "root", "component_id")


def one_of_each(docs: DataFrame) -> DataFrame:
    """One row of ``docs`` from each component: the first by doc_id (null after all), then by the
    hash of its text; of rows alike in both, one. Null and empty texts are one component; an
    empty table gives no rows; columns pass through, whatever their names."""
    found = near_duplicates(docs)
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "th")).alias("x")
    id_, text_hash = F.coalesce(F.col("x.doc_id"), F.lit(0)), F.col("x.th")
    keep = staged(found.groupBy("root").agg(first).select(id_.alias("id"), F.col("x.none").alias("none"), text_hash.alias("th")), "kept")
    key = ["id", "none", "th"]  # no nulls: the join and the last step then share one exchange of the texts
    own = docs.select(F.coalesce("doc_id", F.lit(0)).alias("id"), F.col("doc_id").isNull().alias("none"), F.xxhash64("text").alias("th"), whole_row(docs))
    return own.join(keep, key, "left_semi").dropDuplicates(key).select(*map(of_row, docs.columns))


def op9_simhash_bit_sliced(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = near_duplicates(table(spark, sf_dir, "documents"))
    return out.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


# The same in SQL: XXH64 as published, a column or fold for each of its steps. Products are made in
# 128 bits and cut to 64.

#: The five primes of XXH64.
PRIMES = (11400714785074694791, 14029467366897019727, 1609587929392839161, 9650029242287828579, 2870177450012600261)


def _low(x: str) -> str:
    return f"CAST(({x}) % {1 << 64}::UHUGEINT AS UBIGINT)"


def _times(a: str, b: int) -> str:
    return _low(f"CAST({a} AS UHUGEINT) * {b}::UHUGEINT")


def _plus(a: str, b) -> str:
    return _low(f"CAST({a} AS UHUGEINT) + CAST({b} AS UHUGEINT)")


def _turn(x: str, r: int) -> str:
    return f"({_times(x, 1 << r)} | ({x} >> {64 - r}))"


def _round(held: str, lane: str) -> str:
    return _times(_turn(_plus(held, _times(lane, PRIMES[1])), 31), PRIMES[0])


def _hash_steps() -> str:
    """Relations from u(s), the distinct shingles, to x(s, h)."""
    p1, p2, p3, p4, p5 = PRIMES
    begin = [x % (1 << 64) for x in (SEED + p1 + p2, SEED + p2, SEED, SEED - p1)]
    stripes = ", ".join(f"CASE WHEN z > 0 THEN list_reduce(list_transform(range(z), lambda i: l[4 * i + {k + 1}]), lambda a, x: {_round('a', 'x')}, {v}::UBIGINT) END AS v{k}" for k, v in enumerate(begin))
    joined = _plus(_plus(_turn("v0", 1), _turn("v1", 7)), _plus(_turn("v2", 12), _turn("v3", 18)))
    merges = ", ".join(f"m{k} AS (SELECT *, {_plus(_times(f'xor({"m" if k == 0 else f"m{k - 1}"}, {_round("0", f"v{k}")})', p1), p4)} AS m{k} FROM {'m' if k == 0 else f'm{k - 1}'})" for k in range(4))
    lane = lambda start, n: f"CAST('0x' || list_aggregate(list_reverse(b[{start} + 1:{start} + {n}]), 'string_agg', '') AS UBIGINT)"
    eight = _plus(_times(_turn(f"xor(h, {_round('0', 'x')})", 27), p1), p4)
    four = _plus(_times(_turn(f"xor(h, {_times(lane('(n - n % 8)', 4), p1)})", 23), p2), p3)
    one = _times(_turn(f"xor(h, {_times('x', p5)})", 11), p1)
    return f"""
b AS (SELECT s, regexp_extract_all(hex(encode(s)), '..') AS b, octet_length(encode(s)) AS n FROM u),
l AS (SELECT *, list_transform(range(n // 8), lambda i: {lane('8 * i', 8)}) AS l, n // 32 AS z FROM b),
v AS (SELECT *, {stripes} FROM l),
m AS (SELECT *, {joined} AS m FROM v),
{merges},
h0 AS (SELECT s, b, n, l, z, {_plus(f"coalesce(m3, {(SEED + p5) % (1 << 64)}::UBIGINT)", "n")} AS h FROM m3),
h1 AS (SELECT s, b, n, list_reduce(l[4 * z + 1:], lambda h, x: {eight}, h) AS h FROM h0),
h2 AS (SELECT s, b, n, CASE WHEN n % 8 >= 4 THEN {four} ELSE h END AS h FROM h1),
h3 AS (SELECT s, list_reduce(list_transform(b[n - n % 4 + 1:], lambda x: CAST('0x' || x AS UBIGINT)), lambda h, x: {one}, h) AS h FROM h2),
h4 AS (SELECT s, {_times('xor(h, h >> 33)', p2)} AS h FROM h3),
h5 AS (SELECT s, {_times('xor(h, h >> 29)', p3)} AS h FROM h4),
x AS (SELECT s, xor(h, h >> 32) AS h FROM h5)"""


ORACLE = f"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS w FROM documents
),
s AS (SELECT doc_id, unnest(list_transform(range(1, greatest(2, len(w) - {SHINGLE - 2})), lambda i: array_to_string(w[i:i + {SHINGLE - 1}], ' '))) AS s FROM d WHERE len(w) > 0),
u AS (SELECT DISTINCT s FROM s),{_hash_steps()},
c AS (SELECT doc_id, k, 2 * sum(CAST((h >> k) & 1 AS BIGINT)) > count(*) AS bit FROM s JOIN x ON x.s = s.s, range(64) r(k) GROUP BY doc_id, k),
f AS (SELECT d.doc_id, coalesce(sum(CASE WHEN bit THEN CAST(1 AS HUGEINT) << CAST(k AS INTEGER) END), 0) AS fp FROM d LEFT JOIN c ON c.doc_id = d.doc_id GROUP BY d.doc_id),
n AS (SELECT fp, min(doc_id) AS least FROM f GROUP BY fp),
e AS (SELECT a.fp AS u, b.fp AS v FROM n a JOIN n b ON a.fp <> b.fp AND bit_count(xor(a.fp, b.fp)) <= {RADIUS}),
reach AS (SELECT fp AS u, fp AS v FROM n UNION SELECT r.u, e.v FROM reach r JOIN e ON e.u = r.v),
g AS (SELECT r.u, min(n.least) AS component_id FROM reach r JOIN n ON n.fp = r.v GROUP BY r.u)
SELECT f.doc_id, lpad(lower(hex(CAST(f.fp AS UBIGINT))), 16, '0') AS fingerprint, g.component_id FROM f JOIN g ON g.u = f.fp
"""
