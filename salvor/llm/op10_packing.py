"""Best-fit-decreasing packing of tokenised documents into fixed-length sequences."""

from __future__ import annotations

import base64
import re
import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salvor.llm.common import arrow_batches, ranked, staged, table

CAPACITY = 2048
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
#: Without this end-of-text string and with single spaces and line ends only, the rule for
#: white space that looks ahead never applies, and a pattern without look-ahead (run as a
#: plain automaton) cuts a text as the vocabulary's own pattern does.
SPECIAL = "<|endoftext|>"
ODD = re.compile("[\t\r\x0b\x0c\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]|  |\n\n| \n|\n |^[ \n]|[ \n]\\Z")
PLAIN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+"


class Ids:
    """Token ids of a text, equal to those of ``tokenizers`` for the vocabulary file.

    A byte-pair vocabulary merges within the parts that its pattern cuts, so ids are equal where the
    parts and the merge ranks are. The ranks file has the vocabulary's own ranks, and ``full`` its
    own pattern. ``plain`` differs from it in one alternative: white space not followed by other
    characters, which looks ahead. Where no two white-space characters stand together, none is odd
    and none stands at either end, that alternative never matches: each is followed by another
    character, and takes part in the alternatives before and after it alike in both patterns. ODD
    finds all other texts, for which ``full`` is used; those with the end-of-text string go to
    the library itself. Tests compare ids over every Unicode category.
    """

    def __init__(self, vocabulary: str, ranks: str | None, pattern: str | None):
        from tokenizers import Tokenizer

        self.exact, self.plain, self.full = Tokenizer.from_file(vocabulary), None, None
        if ranks:
            import tiktoken

            with open(ranks, "rb") as f:
                table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
            self.plain = tiktoken.Encoding("plain", pat_str=PLAIN, mergeable_ranks=table, special_tokens={})
            self.full = tiktoken.Encoding("full", pat_str=pattern, mergeable_ranks=table, special_tokens={})

    def __call__(self, text: str) -> list[int]:
        if self.plain is None or SPECIAL in text:
            return self.exact.encode(text, add_special_tokens=False).ids
        return (self.full if ODD.search(text) else self.plain).encode_ordinary(text)


def public_vocabulary() -> tuple[str, str, str]:
    import public_tokenizers as public

    return public.path("byte_bpe_50k.json"), public.path("byte_bpe_50k.tiktoken"), public.PATTERN


def cuts(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of n tokens: one, or full ones after a shorter first."""
    if n <= capacity:
        return [(0, n)]
    first = n % capacity
    return ([(0, first)] if first else []) + [(a, capacity) for a in range(first, n, capacity)]


def tokenised(docs: DataFrame, capacity: int = CAPACITY, with_ids: bool = False, vocabulary=None) -> DataFrame:
    """One row per piece of each document of ``docs(doc_id, text)``: its ids, then id 0, cut
    where longer than ``capacity``. ``vocabulary``: (file for tokenizers, the same as ranks or
    None, its pattern); by default the public 50k one. ``with_ids`` adds the ids themselves."""
    arrow_batches(docs.sparkSession)
    schema = PIECES + (", ids array<int>" if with_ids else "")
    types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()] + [pa.list_(pa.int32())] * with_ids
    names = [x.split()[0] for x in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = Ids(*(vocabulary or public_vocabulary()))
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                ids = np.array([*encode(text.as_py() or ""), 0], "<u4")
                for k, (a, n) in enumerate(cuts(len(ids), capacity)):
                    own = ids[a : a + n]
                    rows.append((doc_id, k, a, n, zlib.crc32(own.tobytes())) + ((own.astype("i4"),) if with_ids else ()))
            cols = list(zip(*rows, strict=True)) or [()] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types, strict=True)], names)

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, schema)


class CapacityTree:
    """Segment tree over remaining capacities 0..top: how many open bins have each."""

    def __init__(self, top: int):
        self.size = 1 << (top + 1).bit_length()
        self.tree = [0] * (2 * self.size)

    def add(self, capacity: int, n: int) -> None:
        i = capacity + self.size
        while i:
            self.tree[i] += n
            i //= 2

    def tightest(self, least: int) -> int | None:
        """The smallest capacity >= least that an open bin has, in logarithmic time."""
        i = least + self.size
        if self.tree[i]:
            return least
        while i > 1 and not (i % 2 == 0 and self.tree[i + 1]):
            i //= 2
        if i <= 1:
            return None
        i += 1
        while i < self.size:
            i = 2 * i if self.tree[2 * i] else 2 * i + 1
        return i - self.size


def best_fit(counts: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int, int]]:
    """Best-fit decreasing over lengths. Returns rows (length, rank from, rank to, first bin,
    items a bin, offset): the items of that length with these ranks fill successive bins.

    Bins of like history stand together as runs, so the work is in the number of lengths, not
    of documents. It equals placing the items one by one: the tightest bin stays the tightest
    for the next item of the same length until it holds no more of them.
    """
    tree, runs, plan, bins = CapacityTree(capacity), defaultdict(list), [], 0

    def put(left: int, first: int, n: int) -> None:
        if n and left:
            runs[left].append((first, n))
            tree.add(left, n)

    for size in sorted(counts, reverse=True):
        rank, todo = 0, counts[size]
        while todo:
            left = tree.tightest(size)
            each = (left or capacity) // size
            if left is None:
                left, first, n = capacity, bins, -(-todo // each)
                bins += n
            else:
                first, n = runs[left].pop()
                tree.add(left, -n)
            whole = min(n, todo // each)
            for start, many, items in ((first, whole, each), (first + whole, 1, todo - whole * each if whole < n else 0)):
                if many and items:
                    plan.append((size, rank, rank + many * items, start, items, capacity - left))
                    rank += many * items
                    put(left - items * size, start, many)
                    n, first = n - many, start + many
            put(left, first, n)
            todo = counts[size] - rank
    return plan


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to staged ``pieces`` (with ``length`` <= capacity).

    The driver gets the histogram of lengths (at most ``capacity`` rows) and returns the
    plan of runs, a few thousand rows, whose size depends on ``capacity`` alone: the proven
    bound of the broadcast. Pieces find their run by length and rank.
    """
    spark = pieces.sparkSession
    counts = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    plan = spark.createDataFrame(best_fit(counts, capacity), "l long, a long, b long, bin long, each long, at long")
    rows = ranked(pieces, "length", ["doc_id", "piece", "ids_crc32"])
    here = (F.col("length") == F.col("l")) & (F.col("rank") >= F.col("a")) & (F.col("rank") < F.col("b"))
    k = F.col("rank") - F.col("a")
    return rows.join(F.broadcast(plan), here).select(
        *pieces.columns,
        (F.col("bin") + F.floor(k / F.col("each"))).cast("long").alias("sequence_id"),
        (F.col("at") + k % F.col("each") * F.col("length")).cast("long").alias("offset"),
    )


def packed_documents(docs: DataFrame, capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    """Tokenise and pack ``docs(doc_id, text)``. A null or empty text is the one id 0; a null
    doc_id is kept; repeated rows are packed as often as they stand; an empty table gives no
    rows; further columns are ignored."""
    return pack(staged(tokenised(docs, capacity, with_ids), "pieces"), capacity)


def op10_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed_documents(table(spark, sf_dir, "documents"))
