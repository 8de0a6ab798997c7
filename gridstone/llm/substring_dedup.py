"""Substring dedup by relative Lempel-Ziv parsing.

The corpus itself is the reference. Its index consists of blocks, one for each bucket of content-defined places (see ``repeats``), and
a block holds the first occurrence of every phrase of 20 words in it. Each document is factored greedily against every block: a factor is copied from an
earlier place (a smaller doc_id, or the same document further left) as far as document and source run along, so it's as long as the phrases that
follow each other at the source. Factors end where a phrase's source changes; the phrases across such a boundary are looked up like any others, so a
repeated phrase that no single factor holds isn't missed. A factor of 20 words or more is a duplicate span, and every word in one is
removed. Factors are judged on the input, not on what is left.

Words are ``[^\\x20\\x09-\\x0D]+``, unchanged; kept words are joined by one space.

Nulls: a null text has no words; a row with a null doc_id keeps all its words and is no source. Texts under 20 words keep all. Of equal
phrases the first in (doc_id, start) stays; rows that repeat a doc_id are one place, so none of them is the other's source, and what a factor of one of
them covers is removed from each. An empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import checkpointed, covered, table
from .repeats import Unit, all_windows, resolved, with_found

PHRASE = 20
UNIT = Unit(words=True, n=PHRASE, k=8)


def factors(docs: DataFrame, unit: Unit = UNIT) -> DataFrame:
    """doc_id and runs: its factors (start, windows, source_doc, source_start) in words, windows being the phrases that begin in one."""
    found = resolved(all_windows(docs, unit), unit, earlier_only=True)
    return checkpointed(found.groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct("start", "windows", "source_doc", "source_start"))).alias("runs")))


def kept_words(docs: DataFrame, found: DataFrame, unit: Unit = UNIT) -> DataFrame:
    """doc_id, n_words, n_removed, n_factors and kept (the words left, joined by one space) of each row of docs."""

    def run(batches):
        for b in batches:
            n, gone, parts, kept = [], [], [], []
            for text, runs in zip(b.column("text"), b.column("runs"), strict=True):
                words = text.as_buffer().to_pybytes().split() if text.is_valid else []
                n.append(len(words))
                parts.append(0)
                if runs.is_valid and len(words) >= unit.n:
                    start, count, doc, source = (runs.values.field(c).to_numpy(zero_copy_only=False) for c in ("start", "windows", "source_doc", "source_start"))
                    inside = start + count - 1 + unit.n <= len(words)
                    start, count, doc, source = start[inside], count[inside], doc[inside], source[inside]
                    # fragments from different blocks are one factor where document and source run along
                    joined = (start[1:] == start[:-1] + count[:-1]) & (doc[1:] == doc[:-1]) & (source[1:] == source[:-1] + count[:-1])
                    parts[-1] = len(start) - int(joined.sum())
                    stays = ~covered(start, start + count - 1 + unit.n, len(words))
                    words = list(compress(words, stays.tolist()))
                gone.append(n[-1] - len(words))
                kept.append(b" ".join(words))
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), *(pa.array(x, pa.int64()) for x in (n, gone, parts)), pa.array(kept, pa.binary()).cast(pa.string())], ["doc_id", "n_words", "n_removed", "n_factors", "kept"])

    return with_found(docs, found, keep_rest=True).mapInArrow(run, "doc_id long, n_words long, n_removed long, n_factors long, kept string")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return kept_words(docs, factors(docs)).select("doc_id", "n_words", "n_removed", "n_factors", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))
