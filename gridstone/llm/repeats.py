"""Distributed search for repeated windows of n symbols (words or bytes), shared by the substring operators.

Every window has a content-defined position: the smallest hash among its sub-windows of k symbols. Equal windows have the same one, so
that windows meet in the bucket of that hash, and consecutive windows mostly share it and travel together as a run. Within a slice of documents
equal windows are joined before anything is shuffled, so a passage that very many documents share costs each slice one row for each of its
windows. A window is compared by its k-gram's 64-bit hash and its own 64-bit sum: those of one k-gram can be very many, so that the sum alone has to
tell them apart. Sums of consecutive windows of bytes travel as the first one and the bytes that leave and enter, two for each window.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import BASE_A, BASE_B, U64, Texts, bucket_of, buckets, by_bucket, column, group_starts, inverse, mix, powers, prefix_sums, range_hashes, sliding_min, slices, squeezed, unsqueezed

PACKED = "bucket int, ids binary, starts binary, counts binary, keys binary, sums binary, left binary, right binary, done binary"
FRAGMENT = "doc_id long, start long, windows long, source_doc long, source_start long"
COLUMNS = ["doc_id", "start", "windows", "source_doc", "source_start"]


@dataclass(frozen=True)
class Unit:
    """words or bytes; n: symbols of a window; k: symbols of the sub-window that places it."""

    words: bool
    n: int
    k: int

    def symbols(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of the symbols, and each text's first symbol (and the end)."""
        t = Texts(texts)
        if self.words:
            w = t.words()
            return w.hashes(), w.first
        return t.raw + U64(1), t.bounds


def starts_of(first: np.ndarray, n: int) -> np.ndarray:
    """First symbols of all windows of n symbols that lie within a text."""
    count = np.maximum(0, np.diff(first) - n + 1)
    return np.repeat(first[:-1] - (np.cumsum(count) - count), count) + np.arange(count.sum())


def least_grams(symbols: np.ndarray, at: np.ndarray, unit: Unit) -> tuple[np.ndarray, np.ndarray]:
    """Of each window in at: the place and the hash of its smallest k-gram, the last one on a tie."""
    grams = np.arange(len(symbols) - unit.k + 1)
    h = range_hashes(prefix_sums(symbols, BASE_A), grams, grams + unit.k, BASE_A)
    bits = U64(max(1, int(len(h)).bit_length()))
    low = (U64(1) << bits) - U64(1)
    best = sliding_min(h & ~low | (low - grams.astype(U64)), unit.n - unit.k + 1)[at]
    place = (low - (best & low)).astype(np.int64)
    return place, h[place]


def window_sums(symbols: np.ndarray, at: np.ndarray, n: int) -> np.ndarray:
    """Of each window of n symbols: the sum of symbols[at + i] * BASE_B**i, modulo 2**64."""
    s = prefix_sums(symbols, BASE_B)
    return (s[at + n] - s[at]) * powers(inverse(BASE_B), len(symbols))[at]


def rolled_sums(first: np.ndarray, counts: np.ndarray, left: np.ndarray, right: np.ndarray, n: int) -> np.ndarray:
    """``window_sums`` of runs of consecutive windows of n bytes: first is that of each run's first window, left and right are the bytes at
    each window's start and just behind its end."""
    begin = np.cumsum(counts) - counts
    p = powers(BASE_B, len(left))
    step = p[:-1] * ((right + U64(1)) * U64(pow(BASE_B, n, 1 << 64)) - (left + U64(1)))
    s = np.concatenate([np.zeros(1, U64), np.cumsum(step, dtype=U64)])
    return (np.repeat(first * p[begin] - s[begin], counts) + s[:-1]) * powers(inverse(BASE_B), len(left))[:-1]


def fragments(doc: np.ndarray, start: np.ndarray, source_doc: np.ndarray, source_start: np.ndarray) -> pa.Table:
    """Windows (sorted by doc and start) as runs whose sources run along."""
    at = group_starts(doc, start - np.arange(len(start)), source_doc, source_start - np.arange(len(start)))
    n = np.diff(np.append(at, len(doc)))
    return pa.table([pa.array(x) for x in (doc[at], start[at], n, source_doc[at], source_start[at])], COLUMNS)


def as_bytes(t: pa.Table) -> bytes:
    return squeezed(np.concatenate([t.column(c).to_numpy().astype(np.int64) for c in COLUMNS]).view(U64))


def from_bytes(data: bytes) -> pa.Table:
    return pa.table([pa.array(x) for x in unsqueezed(data, U64).view(np.int64).reshape(5, -1)], COLUMNS)


def equal_windows(key: np.ndarray, doc: np.ndarray, start: np.ndarray, tie: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For windows with these keys: the first (by doc, start) equal window, the number of different places of equal windows, and the order used."""
    order = np.lexsort((start, doc, key) if tie is None else (start, doc, tie, key))
    k, d, s = key[order], doc[order], start[order]
    at = group_starts(k) if tie is None else group_starts(k, tie[order])
    size = np.diff(np.append(at, len(k)))
    new = np.zeros(len(k) + 1, np.int64)
    new[group_starts(k, d, s)] = 1
    if tie is not None:
        new[at] = 1
    total = np.concatenate([[0], np.cumsum(new[:-1])])
    places = total[at + size] - total[at]
    first, n = np.empty(len(k), np.int64), np.empty(len(k), np.int64)
    first[order], n[order] = np.repeat(order[at], size), np.repeat(places, size)
    return first, n, order


def pack_rows(rows: list[tuple]) -> pa.RecordBatch:
    names = [c.split()[0] for c in PACKED.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(x, pa.int32() if i == 0 else pa.binary()) for i, x in enumerate(zip(*rows, strict=True) if rows else [[]] * len(names))], names)


def packed_windows(ids: np.ndarray, local: np.ndarray, at: np.ndarray, key: np.ndarray, symbols: np.ndarray, unit: Unit, earlier_only: bool, n: int) -> pa.RecordBatch:
    """A slice's windows for the exchange. ids, local: document and start of each; at: their place in the slice's symbols, which tells neighbours."""
    if not len(at):
        return pack_rows([])
    sums = window_sums(symbols, at, unit.n)
    first, places, _ = equal_windows(mix(sums) ^ mix(key), ids, local)
    here = np.arange(len(at))
    mark = (ids[first] != ids) | (local[first] != local) if earlier_only else places > 1
    rows = []
    if mark.any():
        w = np.flatnonzero(mark)
        w = w[np.lexsort((local[w], ids[w]))]
        done = fragments(ids[w], local[w], ids[first[w]], local[first[w]])
        rows.append((int(mix(ids[:1].astype(U64))[0] % U64(n)), *[None] * 7, as_bytes(done)))
    keep = here[first == here]
    ids, local, at, key, sums = ids[keep], local[keep], at[keep], key[keep], sums[keep]
    run = group_starts(key, at - np.arange(len(at)), ids)
    count = np.diff(np.append(run, len(at)))
    if not unit.words:
        left = (symbols[at] - U64(1)).astype(np.uint8)
        right = (symbols[np.minimum(at + unit.n, len(symbols) - 1)] - U64(1)).astype(np.uint8)
    bucket = bucket_of(mix(key[run]), n)
    for b, i in by_bucket(bucket, n):
        each = np.repeat(run[i] - (np.cumsum(count[i]) - count[i]), count[i]) + np.arange(count[i].sum())
        sent = (sums[each].tobytes(), None, None) if unit.words else (sums[run[i]].tobytes(), squeezed(left[each]), squeezed(right[each]))
        rows.append((b, squeezed(ids[run[i]]), squeezed(local[run[i]].astype(np.int64)), squeezed(count[i].astype(np.uint32)), key[run[i]].tobytes(), *sent, None))
    return pack_rows(rows)


def unpacked(t: pa.Table) -> tuple[np.ndarray, ...]:
    """ids, starts, counts, keys and sums of a bucket's runs, and the bytes left and right of their windows."""
    def of(name: str, read):
        found = [read(x) for x in t.column(name).to_pylist() if x is not None]
        return np.concatenate(found) if found else read(None)

    return (
        of("ids", lambda x: unsqueezed(x, np.int64) if x is not None else np.zeros(0, np.int64)),
        of("starts", lambda x: unsqueezed(x, np.int64) if x is not None else np.zeros(0, np.int64)),
        of("counts", lambda x: unsqueezed(x, np.uint32).astype(np.int64) if x is not None else np.zeros(0, np.int64)),
        of("keys", lambda x: np.frombuffer(x or b"", U64)),
        of("sums", lambda x: np.frombuffer(x or b"", U64)),
        of("left", lambda x: unsqueezed(x, np.uint8) if x is not None else np.zeros(0, np.uint8)),
        of("right", lambda x: unsqueezed(x, np.uint8) if x is not None else np.zeros(0, np.uint8)),
    )


def resolved(packed: DataFrame, unit: Unit, earlier_only: bool) -> DataFrame:
    """The repeated windows of an exchange as fragments: with earlier_only those that begin earlier elsewhere too, else all that begin elsewhere."""

    def resolve(t: pa.Table) -> pa.Table:
        ids, starts, counts, keys, sums, left, right = unpacked(t)
        out = [from_bytes(x) for x in t.column("done").to_pylist() if x is not None]
        if len(ids):
            doc, key = np.repeat(ids, counts), np.repeat(keys, counts)
            start = np.repeat(starts - (np.cumsum(counts) - counts), counts) + np.arange(counts.sum())
            first, places, _ = equal_windows(key, doc, start, sums if unit.words else rolled_sums(sums, counts, left, right, unit.n))
            w = np.flatnonzero((doc[first] != doc) | (start[first] != start) if earlier_only else places > 1)
            w = w[np.lexsort((start[w], doc[w]))]
            if len(w):
                out.append(fragments(doc[w], start[w], doc[first[w]], start[first[w]]))
        return pa.concat_tables(out) if out else pa.table([pa.array([], pa.int64())] * 5, COLUMNS)

    return packed.groupBy("bucket").applyInArrow(resolve, FRAGMENT)


def all_windows(docs: DataFrame, unit: Unit, most: int = 4 << 20) -> DataFrame:
    """An exchange of all windows of docs, for ``resolved`` with earlier_only."""
    n = buckets(docs.sparkSession)

    def spread(batches):
        for b in slices(batches, most=most):
            b = b.take(pa.array(np.argsort(column(b, "doc_id"), kind="stable")))
            symbols, first = unit.symbols(b.column("text"))
            at = starts_of(first, unit.n)
            if not len(at):
                continue
            of = np.searchsorted(first, at, side="right") - 1
            _, key = least_grams(symbols, at, unit)
            yield packed_windows(column(b, "doc_id")[of], at - first[of], at, key, symbols, unit, True, n)

    return docs.where("doc_id is not null").select("doc_id", "text").mapInArrow(spread, PACKED)


def candidate_runs(docs: DataFrame, unit: Unit, most: int = 1 << 20) -> DataFrame:
    """doc_id, start, windows of the runs whose k-gram occurs at another place too; only they can hold a repeated window."""
    n = buckets(docs.sparkSession)

    def spread(batches):
        for b in slices(batches, most=most):
            symbols, first = unit.symbols(b.column("text"))
            at = starts_of(first, unit.n)
            if not len(at):
                continue
            place, key = least_grams(symbols, at, unit)
            of = np.searchsorted(first, at, side="right") - 1
            run = group_starts(place, of)
            count = np.diff(np.append(run, len(at)))
            ids, start, key = column(b, "doc_id")[of[run]], at[run] - first[of[run]], key[run]
            # of equal k-grams in a slice one is sent to their bucket, with a mark that it has others; these are settled here
            order = np.argsort(key, kind="stable")
            head = group_starts(key[order])
            size = np.diff(np.append(head, len(key)))
            i, others = order[head], np.delete(order, head)
            key, marks = key[i], (size > 1).astype(U64)
            rows = [(x, squeezed(ids[i[j]]), squeezed(start[i[j]]), squeezed(count[i[j]].astype(np.uint32)), key[j].tobytes(), marks[j].tobytes(), None, None, None) for x, j in by_bucket(bucket_of(mix(key), n), n)]
            if len(others):
                nowhere = np.zeros(len(others), np.int64)
                done = pa.table([pa.array(x.astype(np.int64)) for x in (ids[others], start[others], count[others], nowhere, nowhere)], COLUMNS)
                rows.append((int(mix(ids[:1].astype(U64))[0] % U64(n)), *[None] * 7, as_bytes(done)))
            yield pack_rows(rows)

    def several(t: pa.Table) -> pa.Table:
        ids, starts, counts, keys, marks, _, _ = unpacked(t)
        _, back, size = np.unique(keys, return_inverse=True, return_counts=True)
        w = (size[back] > 1) | (marks > 0)
        names = COLUMNS[:3]
        return pa.concat_tables([pa.table([pa.array(x[w]) for x in (ids, starts, counts)], names), *(from_bytes(x).select(names) for x in t.column("done").to_pylist() if x is not None)])

    packed = docs.where("doc_id is not null").select("doc_id", "text").mapInArrow(spread, PACKED)
    return packed.groupBy("bucket").applyInArrow(several, "doc_id long, start long, windows long")


def windows_in(docs: DataFrame, unit: Unit, most: int = 1 << 20) -> DataFrame:
    """An exchange of the windows of docs that lie in its column runs (of start, windows)."""
    n = buckets(docs.sparkSession, 8)

    def spread(batches):
        for b in slices(batches, most=most):
            symbols, first = unit.symbols(b.column("text"))
            runs = b.column("runs")
            of_run = np.repeat(np.arange(len(b)), np.diff(runs.offsets.to_numpy()))
            values = runs.flatten()
            start, count = (values.field(c).to_numpy().astype(np.int64) for c in ("start", "windows"))
            lo = first[of_run] + start
            order = np.argsort(lo, kind="stable")
            lo, count = lo[order], count[order]
            fits = lo + count - 1 + unit.n <= first[of_run[order] + 1]  # a row that repeats a doc_id may be shorter
            lo, count, of_run = lo[fits], count[fits], of_run[order][fits]
            at = np.repeat(lo - (np.cumsum(count) - count), count) + np.arange(count.sum())
            if not len(at):
                continue
            at, once = np.unique(at, return_index=True)
            of = np.repeat(of_run, count)[once]
            _, key = least_grams(symbols, at, unit)
            yield packed_windows(column(b, "doc_id")[of], at - first[of], at, key, symbols, unit, False, n)

    return docs.select("doc_id", "text", "runs").mapInArrow(spread, PACKED)


# --- joining texts with what was found for some of them -----------------------------------------------------------


def id_bitmap(ids: DataFrame, bits: int = 23):
    """A broadcast bitmap of fixed size of hashed ids: texts that are certainly not among them need no shuffle."""
    h = F.shiftrightunsigned(F.xxhash64("doc_id"), 64 - bits)
    rows = ids.select(F.shiftright(h, 6).alias("w"), F.expr(f"shiftleft(1L, cast(shiftrightunsigned(xxhash64(doc_id), {64 - bits}) & 63 as int))").alias("m")).groupBy("w").agg(F.bit_or("m"))
    out = np.zeros(1 << (bits - 6), np.int64)
    for w, m in rows.collect():
        out[w] = m
    return ids.sparkSession.sparkContext.broadcast(out)


def with_found(docs: DataFrame, found: DataFrame, keep_rest: bool, bits: int = 23) -> DataFrame:
    """docs (doc_id, text) with the array ``runs`` of found (doc_id, runs). The rest has null and isn't shuffled, or is left out."""
    known = id_bitmap(found, bits)
    marked = docs.select("doc_id", "text", F.shiftrightunsigned(F.xxhash64("doc_id"), 64 - bits).alias("h"))

    def part(inside: bool):
        def run(batches):
            seen = known.value.view(U64)
            for b in batches:
                h = column(b, "h").astype(U64)
                hit = (seen[h >> U64(6)] >> (h & U64(63)) & U64(1)).astype(bool)
                yield b.filter(pa.array(hit == inside)).select(["doc_id", "text"])

        return marked.mapInArrow(run, "doc_id long, text string")

    joined = part(True).join(found, "doc_id", "left" if keep_rest else "inner").select("doc_id", "text", "runs")
    return joined.unionByName(part(False).withColumn("runs", F.lit(None).cast(found.schema["runs"].dataType))) if keep_rest else joined
