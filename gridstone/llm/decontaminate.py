"""Benchmark decontamination by SimHash over item-sized windows.

A document leaks an item where a window of as many words as the item has (A-Z in lower case) is similar to it: the weighted Jaccard
similarity of their five-word shingles is at least 0.8, a shingle's weight being the number of times it occurs.

1. Every item gets a 64-bit SimHash of its shingles and a row for each of 8 bit blocks and each block value within one bit of its own.
   Fingerprints that differ in at most 15 bits differ in at most one bit in some block, so the join by (length, block, value) returns all of
   them.
2. A window can reach the threshold only if enough of its shingles are in the benchmark at all. A bitmap of fixed size (2 MB) of the items'
   shingle hashes tells that for all windows of a text at once, so fingerprints are computed for the few windows that are left.
   False hits cost time only.
3. Pairs within the radius are verified by their shingles.

At a similarity of 0.8 two fingerprints differ in 10 bits on average, and in over 15 for about one window in 40; windows shifted by
a word or two give further chances.

Nulls: a null text, or an item without words, has no windows; rows with a null doc_id or item_id are never reported. Items under five words
have one shingle, the whole. Repeated rows of a doc_id are reported together. Empty tables give no leaks. Other columns of documents are
carried along by ``clean`` and not read otherwise.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import BASE_B, U64, Texts, checkpointed, column, group_starts, mix, prefix_sums, range_hashes, slices, table

SHINGLE, PERCENT, RADIUS, BLOCKS = 5, 80, 15, 8
BITMAP_BITS = 24


def numbered(h: np.ndarray, of: np.ndarray) -> np.ndarray:
    """Hashes with their occurrence number within their window mixed in, so that a multiset becomes a set."""
    order = np.lexsort((h, of))
    at = group_starts(of[order], h[order])
    nth = np.arange(len(h)) - np.repeat(at, np.diff(np.append(at, len(h))))
    out = np.empty(len(h), U64)
    out[order] = mix(h[order] + nth.astype(U64) * U64(0x9E3779B97F4A7C15))
    return out


def simhash(h: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """SimHash of each of consecutive groups of hashes."""
    bits = np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1).astype(np.int8) * 2 - 1
    sums = np.zeros((len(h) + 1, 64), np.int32)
    np.cumsum(bits, axis=0, out=sums[1:])
    end = np.cumsum(lengths)
    return np.packbits(sums[end] - sums[end - lengths] > 0, axis=1).reshape(-1).view(U64)


def lists(values: np.ndarray, lengths: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)), pa.array(values.view(np.int64)))


def item_windows(benchmark: DataFrame, k: int = SHINGLE) -> DataFrame:
    """item_id, length (words), fp, shingles (numbered) and plain (hashes) of each item."""

    def run(batches):
        for b in slices(batches):
            words = Texts(b.column("text"), lower=True).words()
            n = np.diff(words.first)
            some = np.flatnonzero(n > 0)
            s = prefix_sums(words.hashes(), BASE_B)
            wide = np.minimum(n[some], k)
            count = n[some] - wide + 1
            of = np.repeat(some, count)
            at = np.arange(len(of)) - np.repeat(np.cumsum(count) - count, count) + words.first[of]
            h = range_hashes(s, at, at + np.repeat(wide, count), BASE_B)
            yield pa.RecordBatch.from_arrays(
                [b.column("item_id").take(pa.array(some)), pa.array(n[some].astype(np.int32)), pa.array(simhash(h, count).view(np.int64)), lists(numbered(h, of), count), lists(h, count)],
                ["item_id", "length", "fp", "shingles", "plain"],
            )

    return benchmark.where("item_id is not null").select("item_id", "text").mapInArrow(run, "item_id long, length int, fp long, shingles array<long>, plain array<long>")


def bitmap(items: DataFrame, bits: int = BITMAP_BITS) -> np.ndarray:
    """A bitmap of the items' shingle hashes: 2**bits bits whatever the benchmark's size."""
    bit = F.shiftrightunsigned("h", 64 - bits)
    word = items.select(F.explode("plain").alias("h")).select(F.shiftright(bit, 6).alias("w"), F.expr(f"shiftleft(1L, cast(shiftrightunsigned(h, {64 - bits}) & 63 as int))").alias("m"))
    out = np.zeros(1 << (bits - 6), np.int64)
    for w, m in word.groupBy("w").agg(F.bit_or("m")).collect():
        out[w] = m
    return out


def document_windows(docs: DataFrame, items: DataFrame, k: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """doc_id, start, length, fp and shingles of the windows that hold enough shingles of the benchmark."""
    spark = docs.sparkSession
    known = spark.sparkContext.broadcast(bitmap(items))
    sizes = spark.sparkContext.broadcast(sorted(r[0] for r in items.select("length").distinct().collect()))  # at most the longest item's words

    def run(batches):
        seen = known.value.view(U64)
        for b in slices(batches):
            words = Texts(b.column("text"), lower=True).words()
            hashes = words.hashes()
            s, ids = prefix_sums(hashes, BASE_B), column(b, "doc_id")
            for wide in sorted({min(k, n) for n in sizes.value}):
                at, h = words.windows(wide, hashes=hashes)
                bit = h >> U64(64 - BITMAP_BITS)
                hit = (seen[bit >> U64(6)] >> (bit & U64(63)) & U64(1)).astype(np.int64)
                if not hit.any():
                    continue
                count = np.zeros(len(words) + 2, np.int64)  # by the shingle's first word; windows near a text's end have none
                count[at + 1] = hit
                count = np.cumsum(count)
                with_hit = np.zeros(len(b), bool)
                with_hit[words.of[at[hit > 0]]] = True
                places = np.flatnonzero(with_hit[words.of])
                for n in (n for n in sizes.value if min(k, n) == wide):
                    start = places[places + n <= len(words)]
                    start = start[words.of[start] == words.of[start + n - 1]]
                    m = n - wide + 1
                    start = start[(count[start + m] - count[start]) * 100 >= percent * m]
                    for part in np.array_split(start, len(start) * m // 1_000_000 + 1) if len(start) else ():
                        each = (part[:, None] + np.arange(m)[None, :]).reshape(-1)
                        g = range_hashes(s, each, each + wide, BASE_B)
                        lengths = np.full(len(part), m)
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(ids[words.of[part]]), pa.array(part - words.first[words.of[part]]), pa.array(np.full(len(part), n, np.int32)), pa.array(simhash(g, lengths).view(np.int64)), lists(numbered(g, np.repeat(np.arange(len(part)), m)), lengths)],
                            ["doc_id", "start", "length", "fp", "shingles"],
                        )

    return docs.where("doc_id is not null").select("doc_id", "text").mapInArrow(run, "doc_id long, start long, length int, fp long, shingles array<long>")


def leaks(docs: DataFrame, benchmark: DataFrame, percent: int = PERCENT) -> DataFrame:
    """doc_id, start, item_id, length, similarity of each window of docs that is similar to an item."""
    items = checkpointed(item_windows(benchmark))
    windows = document_windows(docs, items, percent=percent)
    width = 64 // BLOCKS
    cut = lambda fp, i: F.shiftrightunsigned(fp, width * i).bitwiseAND((1 << width) - 1)
    flips = [0, *(1 << i for i in range(width))]
    index = items.select(
        "item_id",
        "length",
        F.col("fp").alias("item_fp"),
        F.col("shingles").alias("item_shingles"),
        F.explode(F.array(*[F.struct(F.lit(i).alias("block"), cut("fp", i).bitwiseXOR(F.lit(f)).alias("value")) for i in range(BLOCKS) for f in flips])).alias("key"),
    ).select("*", "key.*")
    asked = windows.withColumn("key", F.explode(F.array(*[F.struct(F.lit(i).alias("block"), cut("fp", i).alias("value")) for i in range(BLOCKS)]))).select("*", "key.*").drop("key")
    # a pair can meet in several blocks: the first block that brings it together keeps it
    here = F.col("fp").bitwiseXOR(F.col("item_fp"))
    earlier = [F.when(F.bit_count(F.shiftrightunsigned(here, width * i).bitwiseAND((1 << width) - 1)) <= 1, i) for i in range(BLOCKS)]
    near = asked.join(index.drop("key"), ["length", "block", "value"]).where((F.bit_count(here) <= RADIUS) & (F.coalesce(*earlier) == F.col("block")))
    both = F.size(F.array_intersect("shingles", "item_shingles"))
    return (
        near.withColumn("i", both)
        .withColumn("similarity", F.col("i") / (F.size("shingles") + F.size("item_shingles") - F.col("i")))
        .where(F.col("i") * 100 >= percent * (F.size("shingles") + F.size("item_shingles") - F.col("i")))
        .select("doc_id", "start", "item_id", "length", "similarity")
    )


def leaking(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, items and similarity (of the best window) of each document that leaks."""
    return leaks(docs, benchmark).groupBy("doc_id").agg(F.array_sort(F.collect_set("item_id")).alias("items"), F.max("similarity").alias("similarity"))


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of docs, with docs' columns, that leak no item."""
    return docs.join(leaking(docs, benchmark).select("doc_id"), "doc_id", "left_anti").select(*docs.columns)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = leaking(docs, table(spark, sf_dir, "benchmark"))
    return docs.select("doc_id").join(found, "doc_id", "left").select("doc_id", F.col("items").isNotNull().alias("leaked"), F.coalesce("items", F.array().cast("array<bigint>")).alias("items"), "similarity")
