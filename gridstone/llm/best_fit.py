"""Best-two-fit packing of token sequences.

Documents are cut into pieces of at most ``size`` tokens. What matters for packing is how many pieces there are of each length, and there
are at most ``size`` lengths: that histogram is all that the driver sees. A bin is filled greedily, longest piece first and then the
longest that fits; then its smallest piece is replaced by two unpacked ones that fill the gap it leaves more tightly. A bin so made is
repeated as long as the histogram has the pieces for it, so the number of distinct bins follows the number of lengths and not the number
of documents. Pieces are then dealt to bins by their rank within their length: ranks come from counts by partition and length, so no window
over a whole length is needed.

Nulls: a null text counts as empty and has the end token alone; rows with a null doc_id are packed like others. Ties are dealt in any order
that the input's partitions give. Repeated rows are packed each. An empty table gives an empty result; other columns are
not read.
"""

from __future__ import annotations

import base64
import bisect
import json
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import checkpointed, slices, table

SIZE, END = 2048, 0
VOCABULARY = "byte_bpe_50k"


def vocabulary_path(name: str = VOCABULARY, kind: str = "tiktoken") -> str:
    import public_tokenizers

    return public_tokenizers.path(f"{name}.{kind}")


def added_tokens(path: str) -> dict[str, int]:
    """The added tokens of a tokenizers file, which stand for their ids wherever they are in a text."""
    found = json.load(open(path, encoding="utf-8"))["added_tokens"]
    if any(t["single_word"] or t["lstrip"] or t["rstrip"] or t["normalized"] for t in found):
        raise ValueError(f"{path}: added tokens that take in or depend on what is around them are not built")
    return {t["content"]: t["id"] for t in found}


def encoder(path: str, added: dict[str, int]):
    """The byte-level BPE whose ranks stand in a file, with added tokens (its ids are those of the tokenizers file of the same name)."""
    import public_tokenizers
    import tiktoken

    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(path, "rb"))}
    return tiktoken.Encoding("bpe", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=added)


def pieces(docs: DataFrame, size: int = SIZE, name: str = VOCABULARY) -> DataFrame:
    """doc_id, piece, start, length and ids_crc32 of the pieces of each row of docs. Only the first piece of a cut document may be shorter."""

    def run(batches):
        tokens = encoder(vocabulary_path(name), added_tokens(vocabulary_path(name, "json")))
        for b in slices(batches, most=1 << 20):
            rows: tuple[list, ...] = ([], [], [], [], [])
            for doc_id, text in zip(b.column("doc_id").to_pylist(), b.column("text").to_pylist(), strict=True):
                ids = np.array([*tokens.encode(text or "", allowed_special="all"), END], "<u4")
                first = len(ids) % size or size
                for i, end in enumerate(range(first, len(ids) + 1, size)):
                    start = max(0, end - size) if i else 0
                    for r, x in zip(rows, (doc_id, i, start, end - start, zlib.crc32(ids[start:end].tobytes())), strict=True):
                        r.append(x)
            yield pa.RecordBatch.from_arrays([pa.array(r, t) for r, t in zip(rows, (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()), strict=True)], ["doc_id", "piece", "start", "length", "ids_crc32"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, piece int, start long, length long, ids_crc32 long")


def plan(counts: dict[int, int], size: int = SIZE) -> list[tuple[list[int], int]]:
    """Bins as (piece lengths, times), which use up counts (pieces by length)."""
    left = {n: c for n, c in counts.items() if c}
    lengths = sorted(left)
    bins = []

    def longest(most: int, taken: dict[int, int]) -> int | None:
        i = bisect.bisect_right(lengths, most)
        while i:
            i -= 1
            if left[lengths[i]] > taken.get(lengths[i], 0):
                return lengths[i]
        return None

    while lengths:
        bin_, taken, gap = [], {}, size
        while gap and (n := longest(gap, taken)) is not None:
            bin_.append(n)
            taken[n] = taken.get(n, 0) + 1
            gap -= n
        if gap and len(bin_) > 1:  # two for the smallest
            small = min(bin_)
            taken[small] -= 1
            room, best = gap + small, (small,)
            lo, hi = 0, bisect.bisect_right(lengths, room) - 1
            while lo <= hi and sum(best) < room:
                a, b = lengths[lo], lengths[hi]
                enough = left[a] - taken.get(a, 0) >= 1 + (a == b) and left[b] - taken.get(b, 0) >= 1 + (a == b)
                if a + b > room:
                    hi -= 1
                    continue
                if enough and a + b > sum(best):
                    best = (b, a)
                if left[b] - taken.get(b, 0) < 1 + (a == b):
                    hi -= 1
                else:
                    lo += 1
            bin_.remove(small)
            for n in best:
                bin_.append(n)
                taken[n] = taken.get(n, 0) + 1
        need = {n: c for n, c in taken.items() if c}
        times = min(left[n] // c for n, c in need.items())
        bins.append((bin_, times))
        for n, c in need.items():
            left[n] -= c * times
            if not left[n]:
                del left[n]
                lengths.pop(bisect.bisect_left(lengths, n))
    return bins


def packed(found: DataFrame, size: int = SIZE) -> DataFrame:
    """found (with length) and its sequence_id and offset."""
    spark = found.sparkSession
    found = checkpointed(found.withColumn("part_", F.spark_partition_id()))
    counts = found.groupBy("part_", "length").count()
    total = {r[0]: r[1] for r in counts.groupBy("length").agg(F.sum("count")).collect()}  # size rows at most
    slots, given, sequence = [], {}, 0
    for lengths, times in plan(total, size):
        offset, same = 0, {}
        for n in lengths:
            same.setdefault(n, []).append(offset)
            offset += n
        for n, offsets in same.items():  # ranks given[n] .. in turn: times sequences, one piece of each for every offset
            for o in offsets:
                slots.append((n, given.get(n, 0), given.get(n, 0) + times, sequence, o))
                given[n] = given.get(n, 0) + times
        sequence += times
    base = counts.withColumn("base_", F.sum("count").over(Window.partitionBy("length").orderBy("part_").rowsBetween(Window.unboundedPreceding, -1))).select("part_", "length", F.coalesce("base_", F.lit(0)).alias("base_"))
    local = Window.partitionBy("part_", "length").orderBy("doc_id", "piece", "start")
    ranked = found.withColumn("n_", F.row_number().over(local) - 1).join(base, ["part_", "length"]).withColumn("rank_", F.col("base_") + F.col("n_"))
    # a slot is a range of ranks of a length: the plan's size follows the number of lengths, not of documents
    table_ = np.array(slots, np.int64).reshape(-1, 5)
    table_ = spark.sparkContext.broadcast(table_[np.lexsort((table_[:, 1], table_[:, 0]))])

    def deal(batches):
        at = table_.value
        key = at[:, 0] << 48 | at[:, 1]
        for b in batches:
            n, rank = (b.column(c).to_numpy() for c in ("length", "rank_"))
            slot = at[np.searchsorted(key, n << 48 | rank, side="right") - 1]
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in kept), pa.array(slot[:, 3] + rank - slot[:, 1]), pa.array(slot[:, 4])], [*kept, "sequence_id", "offset"])

    kept = ["doc_id", "piece", "start", "length", "ids_crc32"]
    return ranked.select(*kept, "rank_").mapInArrow(deal, "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")


def pack(docs: DataFrame, size: int = SIZE) -> DataFrame:
    """A row for each piece of each row of docs: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    return packed(pieces(docs, size), size)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"))
