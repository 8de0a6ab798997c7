"""Fingerprints of documents by context-triggered piecewise hashing, and their likeness.

A rolling hash of 7 bytes ends a chunk where its lowest ``level`` bits are zero, so chunks end at the same places in texts that share a passage. A signature has one
character for each chunk, six bits of the chunk's hash. A text's level follows from its length, so that 32 to 64 chunks are expected, and is lowered while fewer than
24 come about; the 64th chunk of a signature reaches to the text's end. The fingerprint ``level:signature:signature`` has the signatures at this level and the next one. Fingerprints are compared where they have a level in common (equal
levels, or one apart), by the edit distance of those signatures: likeness is 1 - distance / (the two lengths), with a replacement as one deletion and
one insertion. Signatures without a common run of RUN characters (or the shorter one's length) are unlike (0); equal fingerprints have likeness 1.

The next document, in ascending (doc_id, text), is found without ordering all documents in one task: ids alone are dealt by range, which gives each range's first row
(one small row for each partition reaches the driver); then texts are shuffled once, to their range, and each range's first row also to the range before.

Edges: a null text is empty; null ids come first, as a document like any other; rows with equal ids follow each other by a hash of their text, and a
repeated row is its own next document, but the last of them. The only row of a table is its own next document. An empty table gives an empty result. Further
columns are not read. A text is never split, so numpy arrays of up to 10 times 8 bytes for each byte of the largest text must fit in a task.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import BASE_A, U64, Texts, mix, prefix_sums, range_hashes, slices, table

WINDOW, LEAST, FEWEST_CHUNKS, MOST_CHUNKS, RUN = 7, 0, 24, 64, 4
FEW_BITS = MOST_CHUNKS.bit_length() - 1
LETTERS = np.frombuffer(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/", np.uint8)
RESULT = "n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


# --- one batch of texts -------------------------------------------------------------------------------------------


def zero_bits(raw: np.ndarray) -> np.ndarray:
    """For each byte, how many of the lowest bits of the rolling hash are zero over the window that ends there (the first of a buffer's windows are short)."""
    h = np.zeros(len(raw), U64)
    for back in range(min(WINDOW, len(raw))):
        h[back:] += (raw[: len(raw) - back].astype(U64) + U64(1)) * U64(pow(BASE_A, back + 1, 1 << 64))
    h = mix(h)
    return np.bitwise_count((h & (~h + U64(1))) - U64(1))


def fingerprints(texts: Texts) -> list[str]:
    raw, bounds = texts.raw, texts.bounds
    zeros, parts = zero_bits(raw), []
    for a, b in zip(bounds[:-1], bounds[1:], strict=True):
        own = zeros[a + WINDOW - 1 : b] if b - a >= WINDOW else zeros[:0]
        level = max(LEAST, int(b - a - 1 or 1).bit_length() - FEW_BITS)  # 32 to 64 chunks are expected
        while level > LEAST and np.count_nonzero(own >= level) < FEWEST_CHUNKS:
            level -= 1
        for k in (level, level + 1):
            ends = (np.flatnonzero(own >= k) + a + WINDOW)[: MOST_CHUNKS - 1]
            parts.append((level, np.unique(np.append(ends, b)) if b > a else ends, a))
    sizes = [len(ends) for _, ends, _ in parts]
    ends = np.concatenate([e for _, e, _ in parts]) if parts else np.zeros(0, np.int64)
    starts = np.concatenate([np.append(a, e[:-1]) if len(e) else e for _, e, a in parts]) if parts else ends
    pieces = range_hashes(prefix_sums(raw + U64(1), BASE_A), starts, ends, BASE_A) if len(ends) else np.zeros(0, U64)
    letters = LETTERS[(pieces >> U64(58)).astype(np.int64)].tobytes().decode()
    at = [0, *np.cumsum(sizes).tolist()]
    signatures = [letters[i:j] for i, j in zip(at[:-1], at[1:], strict=True)]
    return [f"{parts[i][0]}:{signatures[i]}:{signatures[i + 1]}" for i in range(0, len(parts), 2)]


def common_letters(a: str, b: str) -> int:
    """Length of the longest common subsequence, with one bit for each letter of a."""
    masks: dict[str, int] = {}
    for i, x in enumerate(a):
        masks[x] = masks.get(x, 0) | 1 << i
    full = left = (1 << len(a)) - 1
    for y in b:
        hit = left & masks.get(y, 0)
        left = ((left + hit) | (left - hit)) & full
    return len(a) - left.bit_count()


def alike(a: str, b: str) -> float:
    """1 - edit distance / lengths of two signatures, 0 without a common run."""
    run = min(RUN, len(a), len(b))
    if not run or not any(a[i : i + run] in b for i in range(len(a) - run + 1)):
        return 0.0
    return 2 * common_letters(a, b) / (len(a) + len(b))


def likeness(a: str, b: str) -> float:
    """Likeness (0 to 1) of two fingerprints."""
    if a == b:
        return 1.0
    (i, x, x2), (j, y, y2) = ((int(k), s, t) for k, s, t in (f.split(":") for f in (a, b)))
    if i == j:
        return max(alike(x, y), alike(x2, y2))
    return alike(x2, y) if i + 1 == j else alike(x, y2) if j + 1 == i else 0.0


# --- DataFrames ---------------------------------------------------------------------------------------------------


@F.pandas_udf(T.DoubleType())
def likeness_of(a: pd.Series, b: pd.Series) -> pd.Series:
    """Likeness of two columns of fingerprints, NULL where one of them is."""
    return pd.Series([None if x is None or y is None else likeness(x, y) for x, y in zip(a, b, strict=True)], dtype="float64")


@F.pandas_udf(T.StringType())
def fingerprint_of(text: pd.Series) -> pd.Series:
    """Fingerprints of a column of texts; a null text has that of an empty one."""
    return pd.Series(fingerprints(Texts(pa.array(text, pa.large_string(), from_pandas=True))), dtype="object")


def edited(text: str, following: str) -> str:
    """text with its last quarter replaced by as much of the following document's beginning."""
    quarter = len(text) // 4
    return text[: len(text) - quarter] + following[:quarter]


def in_order(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows (ahead, doc_id, text) in partitions that are sorted; each run of documents ends with the row that follows it (ahead), which is its own elsewhere."""
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    whole = F.coalesce(F.col(text), F.lit(""))
    key = [F.col(doc_id).isNotNull().cast("long").alias("known"), F.coalesce(F.col(doc_id).cast("long"), F.lit(0)).alias("id"), F.xxhash64(whole).alias("h")]
    names = ["known", "id", "h"]
    dealt = docs.select(*key).repartitionByRange(n, *names).select(F.spark_partition_id().alias("p"), F.struct(*names).alias("k"))
    firsts = np.array(sorted(tuple(r.k) for r in dealt.groupBy("p").agg(F.min("k").alias("k")).collect()), dtype=[(c, np.int64) for c in names])

    @F.pandas_udf(T.LongType())
    def place(known: pd.Series, number: pd.Series, h: pd.Series) -> pd.Series:
        """Twice the row's range, and one more where the row is its range's first."""
        keys = np.zeros(len(h), firsts.dtype)
        keys["known"], keys["id"], keys["h"] = known, number, h
        at = np.maximum(np.searchsorted(firsts, keys, side="right") - 1, 0)
        return pd.Series(2 * at + (firsts[at] == keys))

    rows = docs.select(F.col(doc_id).alias("doc_id"), whole.alias("text"), *key).withColumn("place", place(*names))
    part = (F.col("place") / 2).cast("int")
    before = F.pmod(part - 1, F.lit(max(1, len(firsts))))
    here, ahead = F.struct(part.alias("part"), F.lit(False).alias("ahead")), F.struct(before.cast("int").alias("part"), F.lit(True).alias("ahead"))
    copies = F.explode(F.when(F.col("place") % 2 == 1, F.array(here, ahead)).otherwise(F.array(here)))
    placed = rows.select("doc_id", "text", *names, copies.alias("to")).select("doc_id", "text", *names, "to.*")
    return placed.repartitionById(n, F.col("part")).sortWithinPartitions("part", "ahead", *names).select("ahead", "doc_id", "text")


def against_next(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Each document's fingerprint beside those of its edited text and of the next document."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        for batch in slices(batches):
            rows = held + list(zip(*[batch.column(c).to_pylist() for c in ("ahead", "doc_id", "text")], strict=True))
            texts = [t for _, _, t in rows]
            pairs = [(a, b) for a, b in zip(range(len(rows)), range(1, len(rows)), strict=False) if not rows[a][0]]
            changed = [edited(texts[a], texts[b]) for a, b in pairs]
            own, other = fingerprints(Texts(pa.array(texts, pa.large_string()))), fingerprints(Texts(pa.array(changed, pa.large_string())))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([rows[a][1] for a, _ in pairs], batch.schema.field("doc_id").type),
                    pa.array([len(texts[a]) for a, _ in pairs], pa.int64()),
                    pa.array([hashlib.sha256(t.encode()).hexdigest() for t in changed], pa.string()),
                    pa.array([own[a] for a, _ in pairs], pa.string()),
                    pa.array(other, pa.string()),
                    pa.array([likeness(own[a], f) for (a, _), f in zip(pairs, other, strict=True)], pa.float64()),
                    pa.array([likeness(own[a], own[b]) for a, b in pairs], pa.float64()),
                ],
                [doc_id, *[c.split()[0] for c in RESULT.split(", ")]],
            )
            held = rows[-1:]

    return in_order(docs, doc_id, text).mapInArrow(each, f"`{doc_id}` {docs.schema[doc_id].dataType.simpleString()}, {RESULT}")


def with_fingerprint(docs: DataFrame, text: Column | str = "text", name: str = "fingerprint") -> DataFrame:
    return docs.withColumn(name, fingerprint_of(F.col(text) if isinstance(text, str) else text))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return against_next(table(spark, sf_dir, "documents"))
