"""What several operators share: reading tables, checkpoints, and words as numpy arrays.

Words are the maximal runs of bytes other than ``\\x20`` and ``\\x09-\\x0D``. A batch of texts is one byte buffer; words
and their hashes are computed for the whole buffer at once, so a task costs a few passes over memory and no Python
step for each word.
"""

from __future__ import annotations

import contextlib
import re
import tempfile
import uuid

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401  pa.compute
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

U64 = np.uint64
WORD = r"[^\x20\x09-\x0D]+"
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"  # since Spark 4.1
#: Odd multipliers for polynomial hashes modulo 2**64 (fixed values).
BASE_A, BASE_B = 0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder that the session names in spark.checkpoint.dir. Only a local session may go without one: it gets a temporary folder, as in tests."""
    context = spark.sparkContext
    named = context.getConf().get("spark.checkpoint.dir") or context.getCheckpointDir()
    if named is None and not re.match(r"local(\[|$)", context.master):
        raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
    return named or tempfile.mkdtemp(prefix="checkpoints-")


@contextlib.contextmanager
def shuffles_go(spark: SparkSession):
    """Shuffle files of queries that run inside go once the query has ended; else they stay until the driver collects garbage.

    The setting is the session's. A query of another thread that begins meanwhile loses its shuffle files at its end too, which costs it a repeated
    stage only if it runs again.
    """
    before = spark.conf.get(CLEANUP, "false")
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(CLEANUP, before)


def checkpointed(df: DataFrame) -> DataFrame:
    """df, written to the shared folder, so that no lost executor makes it be computed again. Its shuffle files go once it is written."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_folder(df.sparkSession))
    with shuffles_go(df.sparkSession):
        return df.select("*").checkpoint(eager=True)  # a plan of its own: df's shuffles, if it has run before, stay


class Scratch:
    """Intermediate tables of one run of an operator, as Parquet in the shared folder.

    What is kept is written and read again, so that no lost executor makes it be computed twice, the next plan knows its size, and small results are read in
    few tasks. A table goes when it is dropped; what the operator's result still reads stays, like a checkpoint.
    """

    def __init__(self, spark: SparkSession):
        self.spark, self.folder, self.paths = spark, f"{shared_folder(spark)}/scratch-{uuid.uuid4().hex}", []

    def keep(self, df: DataFrame) -> DataFrame:
        path = f"{self.folder}/{len(self.paths)}"
        with shuffles_go(self.spark):
            df.write.parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        self.paths.append((out, path))
        return out

    def drop(self, *dfs: DataFrame | None) -> None:
        jvm, conf = self.spark.sparkContext._jvm, self.spark.sparkContext._jsc.hadoopConfiguration()
        for out, name in self.paths:
            if any(out is df for df in dfs):
                path = jvm.org.apache.hadoop.fs.Path(name)
                path.getFileSystem(conf).delete(path, True)


def buckets(spark: SparkSession, each: int = 4) -> int:
    """Hash buckets for packed exchanges: a multiple of the session's shuffle partitions, which the user sizes to the data."""
    return each * int(spark.conf.get("spark.sql.shuffle.partitions"))


# --- arrays -------------------------------------------------------------------------------------------------------


def mix(h: np.ndarray) -> np.ndarray:
    """A bijective finaliser of 64-bit values (splitmix64's constants)."""
    h = h.astype(U64, copy=True)
    h ^= h >> U64(30)
    h *= U64(0xBF58476D1CE4E5B9)
    h ^= h >> U64(27)
    h *= U64(0x94D049BB133111EB)
    h ^= h >> U64(31)
    return h


def powers(base: int, n: int) -> np.ndarray:
    p = np.full(n + 1, base, U64)
    p[0] = 1
    return np.cumprod(p, dtype=U64)


def inverse(base: int) -> int:
    return pow(base, -1, 1 << 64)


def prefix_sums(values: np.ndarray, base: int) -> np.ndarray:
    """s with s[j] = sum of values[i] * base**i over i < j, modulo 2**64."""
    s = np.zeros(len(values) + 1, U64)
    np.cumsum(values.astype(U64) * powers(base, len(values))[:-1], out=s[1:], dtype=U64)
    return s


def range_hashes(s: np.ndarray, starts: np.ndarray, ends: np.ndarray, base: int) -> np.ndarray:
    """Hashes of values[start:end], equal for equal sequences; s are the values' prefix sums."""
    back = powers(inverse(base), int(starts.max()) if len(starts) else 0)
    return mix((s[ends] - s[starts]) * back[starts] + U64(0x51) * (ends - starts).astype(U64))


class Texts:
    """The texts of one Arrow column (null: empty) as UTF-8 bytes, with document bounds in the buffer."""

    def __init__(self, column: pa.ChunkedArray | pa.Array, lower: bool = False):
        if isinstance(column, pa.ChunkedArray):
            column = column.combine_chunks()
            column = column.chunk(0) if isinstance(column, pa.ChunkedArray) else column
        column = column.cast(pa.large_string()).fill_null("")
        n = len(column)
        _, offsets, data = column.buffers()
        at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + n + 1] if n else np.zeros(1, np.int64)
        raw = np.frombuffer(data, np.uint8)[at[0] : at[-1]] if data is not None and n else np.zeros(0, np.uint8)
        self.bounds = at - at[0]
        if lower:
            upper = (raw >= 65) & (raw <= 90)
            raw = raw + (upper * np.uint8(32))
        self.raw = raw

    def words(self) -> Words:
        return Words(self)


class Words:
    """starts, ends: byte bounds of each word in the buffer; of: the document's number; first: each document's first word (and the end)."""

    def __init__(self, texts: Texts):
        raw, bounds = texts.raw, texts.bounds
        space = (raw == 32) | ((raw >= 9) & (raw <= 13))
        inside = np.zeros(len(raw) + 2, np.int8)
        inside[1:-1] = ~space
        step = np.diff(inside)
        # a document's end also ends a word
        cut = bounds[1:-1]
        cut = np.unique(cut[(cut > 0) & (cut < len(raw))])
        cut = cut[(inside[cut] == 1) & (inside[cut + 1] == 1)]
        self.starts = np.sort(np.concatenate([np.flatnonzero(step == 1), cut]))
        self.ends = np.sort(np.concatenate([np.flatnonzero(step == -1), cut]))
        self.first = np.searchsorted(self.starts, bounds)
        self.of = np.repeat(np.arange(len(bounds) - 1), np.diff(self.first))
        self.texts = texts

    def __len__(self) -> int:
        return len(self.starts)

    def hashes(self, base: int = BASE_A) -> np.ndarray:
        return range_hashes(prefix_sums(self.texts.raw + U64(1), base), self.starts, self.ends, base)

    def windows(self, k: int, base: int = BASE_A, hashes: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """First words of the windows of k words within a document, and the windows' hashes."""
        h = self.hashes(base) if hashes is None else hashes
        n = len(h)
        at = np.arange(max(0, n - k + 1))
        at = at[self.of[at] == self.of[at + k - 1]] if len(at) else at
        return at, range_hashes(prefix_sums(h, BASE_B), at, at + k, BASE_B)

    def word(self, i: int) -> bytes:
        return self.texts.raw[self.starts[i] : self.ends[i]].tobytes()


def sliding_min(x: np.ndarray, w: int) -> np.ndarray:
    """Minimum of each w consecutive values, by doubling."""
    n, out, have = len(x) - w + 1, x, 1
    while have * 2 <= w:
        out = np.minimum(out[: len(out) - have], out[have:])
        have *= 2
    if have < w:
        out = np.minimum(out[: len(out) - (w - have)], out[w - have :])
    return out[:n]


def group_starts(*sorted_keys: np.ndarray) -> np.ndarray:
    """Where a new group begins in arrays sorted by these keys."""
    n = len(sorted_keys[0])
    new = np.zeros(n, bool)
    if n:
        new[0] = True
        for k in sorted_keys:
            new[1:] |= k[1:] != k[:-1]
    return np.flatnonzero(new)


def covered(starts: np.ndarray, ends: np.ndarray, n: int) -> np.ndarray:
    """Which of n positions lie in any of the ranges [start, end)."""
    d = np.zeros(n + 1, np.int64)
    np.add.at(d, starts, 1)
    np.add.at(d, ends, -1)
    return np.cumsum(d[:-1]) > 0


# --- packed exchanges ---------------------------------------------------------------------------------------------


def slices(batches, text: str = "text", most: int = 4 << 20):
    """The rows of an iterator of record batches, in pieces of about ``most`` bytes of text, which bounds a task's arrays."""
    pa.set_memory_pool(pa.system_memory_pool())  # gives memory back between slices
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        lengths = np.asarray(pa.compute.fill_null(pa.compute.binary_length(batch.column(text)), 0), np.int64)
        piece = np.concatenate([[0], np.cumsum(lengths + 64)[:-1]]) // most
        at = np.concatenate([group_starts(piece), [n]])
        for a, b in zip(at[:-1], at[1:], strict=True):
            yield batch.slice(int(a), int(b - a))


def squeezed(a: np.ndarray) -> bytes:
    """An array, compressed; sorted integers become small as they are kept as differences."""
    import zstandard

    if a.dtype.kind == "i":
        a = np.diff(a, prepend=a.dtype.type(0))
    return zstandard.ZstdCompressor(level=1).compress(a.tobytes())


def unsqueezed(data: bytes, dtype) -> np.ndarray:
    import zstandard

    a = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), dtype)
    return np.cumsum(a, dtype=dtype) if np.dtype(dtype).kind == "i" else a


def bucket_of(h: np.ndarray, n: int) -> np.ndarray:
    return ((h >> U64(32)) * U64(n) >> U64(32)).astype(np.int32)


def by_bucket(bucket: np.ndarray, n: int):
    """(bucket, indices) of each bucket that occurs, indices in their order."""
    if not len(bucket):
        return
    order = np.argsort(bucket.astype(np.uint16) if n <= 65536 else bucket, kind="stable")
    at = group_starts(bucket[order])
    for a, b in zip(at, [*at[1:], len(order)], strict=True):
        yield int(bucket[order[a]]), order[a:b]


def column(t: pa.Table | pa.RecordBatch, name: str) -> np.ndarray:
    return t.column(name).to_numpy(zero_copy_only=False) if isinstance(t, pa.RecordBatch) else t.column(name).to_numpy()


def components(edges: DataFrame, scratch: Scratch | None = None) -> DataFrame:
    """node and component (the smallest node reachable) for the nodes of edges (a, b), by large-star and small-star rounds.

    A node's smallest neighbour comes from an aggregation with partial sums; only counts reach the driver. Rounds end when every node but the
    components' smallest has one edge and those have none.
    """
    scratch = scratch or Scratch(edges.sparkSession)
    links = scratch.keep(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct())
    while True:
        ends = links.groupBy("u").agg(F.count(F.lit(1)).alias("n"), F.lit(1).alias("up")).unionByName(links.select(F.col("v").alias("u")).distinct().select("u", F.lit(0).cast("long").alias("n"), F.lit(0).alias("up")))
        # a node with two edges up, or with edges both up and down, is not settled
        if not ends.groupBy("u").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("sides")).where("n > 1 or sides > 1").limit(1).count():
            break
        both = links.union(links.select("v", "u"))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).union(low.select("u", "m")).where("u <> v").distinct()
        before, links = links, scratch.keep(small)
        scratch.drop(before)
    return links.select(F.col("u").alias("node"), F.col("v").alias("component")).union(links.select("v", "v").distinct())
