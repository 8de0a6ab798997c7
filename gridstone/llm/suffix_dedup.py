"""Byte-exact dedup of long repeated substrings, after the suffix-array methods.

A byte goes if a string of 400 bytes that covers it also starts anywhere else. The named method, the distributed difference-cover construction,
sorts sampled suffixes so that any two equal strings have a sampled position at the same offset, names their prefixes, and compares neighbours in the
order. Here the cover is content-defined in place of residues modulo 3 (see README for why, with figures): the sampled positions are the smallest
200-byte grams of every 400-byte window. That keeps the property the method rests on, that equal strings have a common sampled offset, at one position
in a hundred, and only prefixes of bounded length are named:

1. Sampled suffixes are named by the hash of their first 200 bytes and dealt out by name; names that occur once are dropped, and with
   them all windows that they stand for.
2. For the other suffixes, the windows that they stand for are merged in: each is named by sample and whole window, sorted, and compared
   with its neighbours. Windows with an equal neighbour repeat.
3. Repeated windows become byte ranges; overlapping ranges are one span.

Nulls: a null text counts as empty; a row with a null doc_id stays whole and matches nothing. Texts under 400 bytes stay whole. All copies lose the
bytes, the first too. Rows that repeat a doc_id are one place: they don't match each other, but lose the same ranges. Strings are judged on the input.
An empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations


import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import checkpointed, covered, group_starts, table
from .repeats import Unit, candidate_runs, resolved, windows_in, with_found

LENGTH = 400
UNIT = Unit(words=False, n=LENGTH, k=LENGTH // 2)


def repeated_ranges(docs: DataFrame, unit: Unit = UNIT) -> DataFrame:
    """doc_id and runs (start, windows): where repeated strings of unit.n bytes start."""
    runs = F.collect_list(F.struct("start", "windows")).alias("runs")
    candidates = checkpointed(candidate_runs(docs, unit).groupBy("doc_id").agg(runs))
    found = resolved(windows_in(with_found(docs, candidates, keep_rest=False), unit), unit, earlier_only=False)
    return checkpointed(found.groupBy("doc_id").agg(runs))


def kept_bytes(docs: DataFrame, found: DataFrame, unit: Unit = UNIT) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept (binary: what is left may split a character) of each row of docs."""

    def run(batches):
        for b in batches:
            n, gone, spans, kept = [], [], [], []
            for text, runs in zip(b.column("text"), b.column("runs"), strict=True):
                data = text.as_buffer().to_pybytes() if text.is_valid else b""
                n.append(len(data))
                spans.append(0)
                if runs.is_valid and len(data) >= unit.n:
                    start, count = (runs.values.field(c).to_numpy(zero_copy_only=False) for c in ("start", "windows"))
                    inside = start + count - 1 + unit.n <= len(data)
                    drop = covered(start[inside], (start + count - 1 + unit.n)[inside], len(data))
                    spans[-1] = int(drop[group_starts(drop)].sum())
                    data = np.frombuffer(data, np.uint8)[~drop].tobytes()
                gone.append(n[-1] - len(data))
                kept.append(data)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), *(pa.array(x, pa.int64()) for x in (n, gone, spans)), pa.array(kept, pa.binary())], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept"])

    return with_found(docs, found, keep_rest=True).mapInArrow(run, "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return kept_bytes(docs, repeated_ranges(docs)).select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
