"""N-gram Jaccard self-join: rare-first prefix filtering with length, positional and suffix filters.

A document's set holds its distinct shingles of five words (A-Z in lower case); two documents link where the Jaccard similarity of
their sets is at least the threshold. Steps:

1. Documents with the same set form a class; a class goes on as its smallest doc_id.
2. The number of documents of every shingle is counted over all documents, in packed buckets of hashes. A shingle of one document
   can't link it to anything, so only the others come back, ordered rare first; the lonely ones stand before them as a number. Shingles of more than
   one document in a hundred are found while sizes are computed; they are known to be shared and go to their documents without being gathered.
3. A document's prefix is so long that similar documents share a shingle of their prefixes. Prefixes are joined on their shingles;
   of shingles with the same documents one is joined. Length (a similar set has at least 0.8 of the size), position (what can follow a
   shared shingle) and suffix (how many shared shingles both have in each of 32 cells of the hashes, which bounds their overlap) discard pairs
   before any verification. Shingles of very many documents are joined in salted parts.
4. Pairs are verified in turns: first each document with one other of its size class for each of its prefix shingles, which is linear in the prefixes
   (a second such turn finds next to nothing); then, between the components that these links make, one pair for each two groups (a component's documents at
   a shingle) that can hold a link, in a few rounds; then every other pair of the join between components, with the filters inside the
   join, first for a group's documents together. Documents of a group that can't hold a link with any other group at its shingle leave the join. A pair within a component can't change it, so no group of near copies is spelled out as pairs. Pairs that
   have been verified are remembered, so that each is verified once, and turns end as soon as no shingle joins two components.
5. If asked for, links within a component are counted in tiles of its classes, from their intersection sizes; a tile gives a number for each document.
   That takes time with the square of a component's classes, so nothing else depends on it.

Shingles are compared by 64-bit hashes.

Nulls: a null text has an empty set, as a text without words, which links with nothing and is its own component; a null
doc_id has a null component. Rows that repeat a doc_id are one document. Texts under five words have one shingle, the whole. An
empty table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

import functools

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import BASE_B, U64, Scratch, Texts, bucket_of, by_bucket, column, components, group_starts, mix, prefix_sums, range_hashes, slices, squeezed, table, unsqueezed

WORDS, PERCENT, TILE, CELLS, ROUNDS, GROUP_ROUNDS = 5, 80, 256, 32, 1, 3
PER_BUCKET = 1 << 20  # shingles of a bucket, about
FREQUENT = 100  # a shingle of more than one document in so many is frequent
SALTED = 4096  # documents of a shingle that are joined in one part, about


def shingle_sets(texts: pa.Array, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each distinct shingle of each text: the text's number and the hash, sorted; and each text's number of them."""
    words = Texts(texts, lower=True).words()
    at, h = words.windows(k)
    of = words.of[at]
    n = np.diff(words.first)
    short = np.flatnonzero((n > 0) & (n < k))
    if len(short):
        s = prefix_sums(words.hashes(), BASE_B)
        h = np.concatenate([h, range_hashes(s, words.first[short], words.first[short + 1], BASE_B)])
        of = np.concatenate([of, short])
    order = np.lexsort((h, of))
    of, h = of[order], h[order]
    new = group_starts(of, h)
    of, h = of[new], h[new]
    return of, h, np.bincount(of, minlength=len(n)).astype(np.int64)


class SliceSets:
    """The sets of one slice of documents: ids; of and h, each distinct shingle's document and hash; n and sums of each document, equal for equal sets;
    own: whether a shingle is one of the first document of its set in the slice, so that copies within a slice count once."""

    def __init__(self, batch: pa.RecordBatch, k: int):
        self.of, self.h, self.n = shingle_sets(batch.column("text"), k)
        self.ids = pa.compute.fill_null(batch.column("doc_id").cast(pa.int64()), np.iinfo(np.int64).max).to_numpy(zero_copy_only=False)
        end, self.sums = np.cumsum(self.n), []
        for salt in (0x1B873593, 0xC2B2AE3D27D4EB4F):
            s = np.concatenate([[U64(0)], np.cumsum(mix(self.h ^ U64(salt)), dtype=U64)])
            self.sums.append((s[end] - s[end - self.n]).view(np.int64))
        order = np.lexsort((self.ids, *self.sums, self.n))
        first = np.zeros(len(self.ids), bool)
        first[order[group_starts(self.n[order], *(x[order] for x in self.sums))]] = True
        self.documents, self.own = int(first.sum()), first[self.of]


def set_sizes(docs: DataFrame, k: int = WORDS) -> DataFrame:
    """doc_id, n (set size) and the sums sa, sb, which are equal for equal sets; and, in one row of each slice of documents, how many sets it has and
    its frequent shingles with their number of sets."""

    def run(batches):
        for b in slices(batches):
            s = SliceSets(b, k)
            h, times = np.unique(s.h[s.own], return_counts=True)
            some, rest = times >= max(4, s.documents // (2 * FREQUENT)), len(b) - 1
            yield pa.RecordBatch.from_arrays(
                [
                    b.column("doc_id").cast(pa.int64()),
                    *(pa.array(x) for x in (s.n, *s.sums)),
                    pa.array(np.concatenate([[s.documents], np.zeros(rest, np.int64)])),
                    *(pa.concat_arrays([pa.array([x[some]], pa.list_(pa.int64())), pa.nulls(rest, pa.list_(pa.int64()))]) for x in (h.view(np.int64), times.astype(np.int64))),
                ],
                ["doc_id", "n", "sa", "sb", "documents", "often", "times"],
            )

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, n long, sa long, sb long, documents long, often array<long>, times array<long>")


def frequent_shingles(sizes: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """The hashes, sorted, and numbers of sets of the frequent shingles. There are at most FREQUENT times as many as an average set has shingles, whatever
    the number of documents. Which shingles count as frequent changes the way they take, not the result."""
    total = sizes.agg(F.sum("documents")).first()[0] or 0
    each = sizes.where("often is not null").select(F.explode(F.arrays_zip("often", "times")).alias("x")).groupBy(F.col("x.often").alias("h")).agg(F.sum("x.times").alias("times"))
    found = each.where(F.col("times") * FREQUENT > F.lit(total)).toArrow()
    h = column(found, "h").view(U64)
    order = np.argsort(h)
    return h[order], column(found, "times")[order].astype(np.int64)


def shared_shingles(docs: DataFrame, total: int, frequent: tuple[np.ndarray, np.ndarray], k: int = WORDS) -> DataFrame:
    """doc_id, shared (the hashes of its shingles that other documents have too, the rarest first), times (the numbers of documents of those that can stand in a prefix) and
    cells (how many fall into each cell of the hashes).

    Buckets are sized to ``total``, the shingles of all documents, so that a bucket's size doesn't follow the data.
    """
    n = max(1, -(-total // PER_BUCKET))
    often = docs.sparkSession.sparkContext.broadcast(frequent)
    names = ["bucket", "ids", "hashes", "df"]

    def home(ids: np.ndarray) -> np.ndarray:
        return bucket_of(mix(ids.astype(U64)), n)

    def packed_rows(bucket: np.ndarray, ids: np.ndarray, h: np.ndarray, df: np.ndarray | None, plus: int = 0) -> list[tuple]:
        return [(b + plus, squeezed(ids[i]), h[i].tobytes(), None if df is None else squeezed(df[i].astype(np.uint32))) for b, i in by_bucket(bucket, n)]

    def batch(rows: list[tuple]) -> pa.RecordBatch:
        parts = list(zip(*rows, strict=True)) or [()] * 4
        return pa.RecordBatch.from_arrays([pa.array(x, pa.int32() if i == 0 else pa.binary()) for i, x in enumerate(parts)], names)

    def spread(batches):
        known, times = often.value
        for b in slices(batches):
            s = SliceSets(b, k)
            ids, h = s.ids[s.of[s.own]], s.h[s.own]
            at = np.minimum(np.searchsorted(known, h), max(0, len(known) - 1))
            hit = known[at] == h if len(known) else np.zeros(len(h), bool)
            rest = ~hit
            yield batch(packed_rows(bucket_of(h[rest], n), ids[rest], h[rest], None) + packed_rows(home(ids[hit]), ids[hit], h[hit], times[at[hit]], n))

    def arrays(t: pa.Table) -> tuple[np.ndarray, np.ndarray]:
        return np.concatenate([unsqueezed(x, np.int64) for x in t.column("ids").to_pylist()]), np.concatenate([np.frombuffer(x, U64) for x in t.column("hashes").to_pylist()])

    def count(key: tuple, t: pa.Table) -> pa.Table:
        if key[0].as_py() >= n:  # on the way to their documents
            return t.set_column(0, "bucket", pa.compute.subtract(t.column("bucket"), pa.scalar(n, pa.int32())))
        ids, h = arrays(t)
        order = np.argsort(h, kind="stable")
        ids, h = ids[order], h[order]
        size = np.diff(np.append(group_starts(h), len(h)))
        df = np.repeat(size, size)
        keep = df > 1
        ids, h, df = ids[keep], h[keep], df[keep]
        order = np.argsort(ids, kind="stable")
        ids, h, df = ids[order], h[order], df[order]
        return pa.Table.from_batches([batch(packed_rows(home(ids), ids, h, df))])

    def gather(t: pa.Table) -> pa.Table:
        ids, h = arrays(t)
        df = np.concatenate([unsqueezed(x, np.uint32) for x in t.column("df").to_pylist()])
        order = np.lexsort((h, df, ids))
        ids, h, df = ids[order], h[order], df[order]
        # a repeated row's shingles stand twice, next to each other
        once = group_starts(ids, h)
        ids, h, df = ids[once], h[once], df[once]
        at = group_starts(ids)
        count_ = np.diff(np.append(at, len(ids)))
        of = np.repeat(np.arange(len(at)), count_)
        cells = np.bincount(of * CELLS + (h >> U64(20)).astype(np.int64) % CELLS, minlength=len(at) * CELLS).astype(np.int32)
        lists = lambda starts, values: pa.ListArray.from_arrays(pa.array(np.append(starts, len(values)), pa.int32()), pa.array(values))
        first = count_ // 4 + 1  # what can stand in a prefix, see ``reach``
        head = np.arange(len(ids)) - at[of] < first[of]
        starts = np.cumsum(np.minimum(first, count_)) - np.minimum(first, count_)
        return pa.table([pa.array(ids[at]), lists(at, h.view(np.int64)), lists(starts, df[head].astype(np.int64)), lists(np.arange(len(at)) * CELLS, cells)], ["doc_id", "shared", "times", "cells"])

    packed = docs.select("doc_id", "text").where("doc_id is not null").mapInArrow(spread, "bucket int, ids binary, hashes binary, df binary")
    counted = packed.groupBy("bucket").applyInArrow(count, "bucket int, ids binary, hashes binary, df binary")
    return counted.groupBy("bucket").applyInArrow(gather, "doc_id long, shared array<long>, times array<long>, cells array<int>")


def verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b, with other columns) that link."""
    a = sets.select(F.col("doc_id").alias("a"), F.col("n").alias("na"), F.col("shared").alias("sa"))
    b = sets.select(F.col("doc_id").alias("b"), F.col("n").alias("nb"), F.col("shared").alias("sb"))
    both = F.size(F.array_intersect("sa", "sb"))
    return pairs.join(a, "a").join(b, "b").withColumn("i", both).where(F.col("i") * 100 >= percent * (F.col("na") + F.col("nb") - F.col("i"))).select(pairs.columns)


def link_counts(sets: DataFrame, percent: int, tile: int = TILE) -> DataFrame:
    """doc_id and links (to documents of other classes), from sets with component and copies."""
    sizes = sets.groupBy("component").agg(F.count(F.lit(1)).alias("m")).where("m > 1").withColumn("blocks", F.ceil(F.col("m") / tile).cast("int"))
    own = sets.join(sizes, "component").withColumn("block", F.pmod(F.xxhash64("doc_id"), F.col("blocks")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    tiles = own.withColumn("other", other).select("component", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), (F.col("block") <= F.col("other")).alias("left_"), "doc_id", "n", "copies", "shared")

    def count(t: pa.Table) -> pa.Table:
        first, second = t.column("i")[0].as_py(), t.column("j")[0].as_py()
        left = column(t, "left_")
        lists = t.column("shared").combine_chunks()
        lengths = np.diff(lists.offsets.to_numpy())
        _, symbol = np.unique(lists.flatten().to_numpy(), return_inverse=True)
        row = np.repeat(np.arange(len(lengths)), lengths)
        x, y = np.flatnonzero(left), np.arange(len(left)) if first == second else np.flatnonzero(~left)
        overlap, width = np.zeros((len(x), len(y)), np.float64), 4096
        order = np.argsort(symbol, kind="stable")
        row, symbol = row[order], symbol[order]
        for low in range(0, int(symbol[-1]) + 1 if len(symbol) else 0, width):
            a, b = np.searchsorted(symbol, (low, low + width))
            has = np.zeros((len(left), width), np.float32)
            has[row[a:b], symbol[a:b] - low] = 1
            overlap += has[x] @ has[y].T
        n, copies, ids = column(t, "n"), column(t, "copies"), column(t, "doc_id")
        links = (overlap * 100 >= percent * (n[x][:, None] + n[y][None, :] - overlap)) & (ids[x][:, None] != ids[y][None, :])
        out = np.zeros(len(left), np.int64)
        out[x] += links @ copies[y]
        if first != second:
            out[y] += links.T @ copies[x]
        return pa.table([pa.array(ids), pa.array(out)], ["doc_id", "links"])

    return tiles.groupBy("component", "i", "j").applyInArrow(count, "doc_id long, links long").groupBy("doc_id").agg(F.sum("links").alias("links"))


class Prefixes:
    """The prefix join: candidate pairs of the rows at a shingle, and the filters that they pass."""

    def __init__(self, percent: int):
        self.percent = percent

    def overlap_fits(self, xa: str, xb: str, na: str, nb: str) -> Column:
        """Whether the cells (or the largest of several documents' cells) allow the overlap that sets of these sizes (or the smallest of them) need."""
        bound = F.aggregate(F.zip_with(xa, xb, lambda x, y: F.least(x, y)), F.lit(0), lambda t, x: t + x)
        return bound * (100 + self.percent) >= self.percent * (F.col(na) + F.col(nb))

    def passing(self, pairs: DataFrame) -> DataFrame:
        """The distinct pairs (a, b), with their components (ca, cb), that pass the length, positional and suffix filters."""
        small, large = F.least("na", "nb"), F.greatest("na", "nb")
        possible = 1 + F.least(F.col("na") - F.col("pa"), F.col("nb") - F.col("pb")) - 1 + F.least("pa", "pb")
        fits = (F.col("ca") != F.col("cb")) & (100 * small >= self.percent * large) & (possible * (100 + self.percent) >= self.percent * (F.col("na") + F.col("nb"))) & self.overlap_fits("xa", "xb", "na", "nb")
        return pairs.where(fits).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), F.least("ca", "cb").alias("ca"), F.greatest("ca", "cb").alias("cb")).distinct()

    def with_one(self, rows: DataFrame, turn: int) -> DataFrame:
        """Each row with one other document of its size class at its shingle: first one with few lonely shingles, such as what the others were copied from, later any."""
        order = F.col("lonely") / F.col("n") if turn == 0 else F.xxhash64(F.lit(turn), "doc_id")
        one = F.min(F.struct(order.alias("o"), F.col("doc_id").alias("b"), F.col("n").alias("nb"), F.col("at").alias("pb"), F.col("cells").alias("xb"), F.col("c").alias("cb")))
        first = rows.groupBy("h", "band").agg(one.alias("f"), F.max("salts").alias("salts")).select("h", "band", "f.*", F.explode(F.sequence(F.lit(0), F.col("salts"))).alias("salt")).drop("o")
        near = rows.select("h", "salt", F.explode(F.array(F.col("band"), F.col("band") - 1)).alias("band"), F.col("doc_id").alias("a"), F.col("n").alias("na"), F.col("at").alias("pa"), F.col("cells").alias("xa"), F.col("c").alias("ca"))
        return self.passing(near.join(first, ["h", "band", "salt"]))

    def groups(self, rows: DataFrame, turn: int) -> DataFrame:
        """The documents of one component at one shingle and band, with one of them: first the one with most shared shingles, later any."""
        order = -F.aggregate("cells", F.lit(0), lambda t, x: t + x).cast("long") if turn == 0 else F.xxhash64(F.lit(turn), "h", "doc_id")
        most = F.array(*(F.max(F.col("cells")[i]) for i in range(CELLS)))
        return rows.groupBy("h", "band", "c").agg(F.min("n").alias("low"), F.max("n").alias("high"), most.alias("most"), F.min(F.struct(order.alias("o"), "doc_id", "n", "at", "cells")).alias("one"))

    def between(self, groups: DataFrame) -> DataFrame:
        """The pairs of groups at a shingle that can hold a link: their largest cells bound the overlap of each of their documents."""
        named = lambda s, *more: [F.col("c").alias(f"c{s}"), F.col("low").alias(f"low{s}"), F.col("high").alias(f"high{s}"), F.col("most").alias(f"most{s}"), F.col("one").alias(f"one{s}"), *more]
        near = groups.select("h", F.col("band").alias("ba"), *named("a", F.explode(F.array(F.col("band") - 1, F.col("band"), F.col("band") + 1)).alias("bb")))
        lengths = (100 * F.col("higha") >= self.percent * F.col("lowb")) & (100 * F.col("highb") >= self.percent * F.col("lowa"))
        return near.join(groups.select("h", F.col("band").alias("bb"), *named("b")), ["h", "bb"]).where((F.col("ca") < F.col("cb")) & lengths & self.overlap_fits("mosta", "mostb", "lowa", "lowb"))

    def one_of_both(self, between: DataFrame) -> DataFrame:
        one = lambda s: [F.col(f"c{s}"), *(F.col(f"one{s}.{x}").alias(y) for x, y in (("doc_id", s), ("n", f"n{s}"), ("at", f"p{s}"), ("cells", f"x{s}")))]
        return self.passing(between.select(*one("a"), *one("b")))

    def all_of_both(self, rows: DataFrame, between: DataFrame) -> DataFrame:
        across = between.select("h", "ba", "ca", "bb", "cb", "lowb", "highb", "mostb")
        side = lambda s: rows.select("h", F.col("band").alias(f"b{s}"), F.col("c").alias(f"c{s}"), F.col("doc_id").alias(s), F.col("n").alias(f"n{s}"), F.col("at").alias(f"p{s}"), F.col("cells").alias(f"x{s}"))
        ones = across.join(side("a"), ["h", "ba", "ca"]).where((100 * F.col("na") >= self.percent * F.col("lowb")) & (100 * F.col("highb") >= self.percent * F.col("na")) & self.overlap_fits("xa", "mostb", "na", "lowb"))
        return self.passing(ones.drop("lowb", "highb", "mostb").join(side("b"), ["h", "bb", "cb"]))


def prefix_rows(sets: DataFrame, percent: int, scratch: Scratch) -> DataFrame:
    """The rows of the prefix join: h, salt (of 0 .. salts), band (size class), doc_id, n, lonely, at (place in the order), cells and c (component, at first the document)."""
    lonely = F.col("n") - F.size("shared")
    reach = F.col("n") - ((F.col("n") * percent + 99) / 100).cast("int") + 1 - lonely
    marks = scratch.keep(
        sets.where(reach > 0)
        .select("doc_id", "n", "cells", lonely.alias("lonely"), F.posexplode(F.slice(F.arrays_zip("shared", "times"), F.lit(1), reach.cast("int"))).alias("at", "x"))
        .select(
            "doc_id", "cells", "lonely", F.col("n").cast("long").alias("n"), (F.col("at") + F.col("lonely")).alias("at"), F.col("x.shared").alias("h"), F.floor(F.log(F.col("n")) / F.log(F.lit(100 / percent))).cast("int").alias("band"),
            F.floor(F.col("x.times") / SALTED).cast("int").alias("salts"),
        )
        .withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.col("salts") + 1).cast("int"))
    )
    # the shingles of a shared passage have the same documents: one of them stands for all
    alike = marks.groupBy("h").agg(F.count(F.lit(1)).alias("m"), F.bit_xor(F.xxhash64("doc_id")).alias("x"), F.sum(F.hash("doc_id").cast("long")).alias("s"), F.max("salts").alias("salts")).where("m > 1")
    chosen = alike.groupBy("m", "x", "s").agg(F.min(F.struct("h", "salts")).alias("f")).select("f.h", F.explode(F.sequence(F.lit(0), F.col("f.salts"))).alias("salt"))
    rows = scratch.keep(marks.join(chosen, ["h", "salt"], "left_semi").withColumn("c", F.col("doc_id")))
    scratch.drop(marks)
    return rows


def links_between(sets: DataFrame, percent: int, scratch: Scratch) -> DataFrame:
    """Links (a, b) between documents of sets that connect the same components as all links do. No pair is verified twice."""
    join, rows = Prefixes(percent), prefix_rows(sets, percent, scratch)
    links, checked = [], []

    def settle(rows: DataFrame, pairs: DataFrame, last: bool) -> tuple[DataFrame, bool]:
        """Verifies the pairs that haven't been; rows that are still open, with their new components, and whether there was a new link."""
        for before in checked:
            pairs = pairs.join(before.select("a", "b"), ["a", "b"], "left_anti")
        checked.append(scratch.keep(pairs))
        if checked[-1].isEmpty():
            return rows, False
        links.append(scratch.keep(verified(checked[-1], sets, percent)))
        if last or links[-1].isEmpty():
            return rows, False
        joined = components(links[-1].select(F.col("ca").alias("a"), F.col("cb").alias("b")), scratch).select(F.col("node").alias("c"), "component")
        moved = scratch.keep(rows.join(joined, "c", "left").withColumn("c", F.coalesce("component", "c")).drop("component"))
        several = moved.groupBy("h").agg(F.min("c").alias("c0"), F.max("c").alias("c1"), F.max("salts").alias("salts")).where("c0 < c1").select("h", F.explode(F.sequence(F.lit(0), F.col("salts"))).alias("salt"))
        out = scratch.keep(moved.join(several, ["h", "salt"], "left_semi"))
        scratch.drop(rows, moved)
        return out, True

    def paired(rows: DataFrame, turn: int) -> tuple[DataFrame, DataFrame]:
        """The rows of groups that can hold a link with another group at their shingle, and the pairs of such groups. The others are done with: when components
        grow, there are only fewer documents elsewhere to link with."""
        groups = scratch.keep(join.groups(rows, turn))
        between = scratch.keep(join.between(groups).drop("mosta", "lowa", "higha"))
        sides = between.select("h", F.col("ba").alias("band"), F.col("ca").alias("c")).union(between.select("h", "bb", "cb")).distinct()
        out = scratch.keep(rows.join(sides, ["h", "band", "c"], "left_semi"))
        scratch.drop(rows, groups)
        return out, between

    for kind, turns in (("one", ROUNDS), ("groups", GROUP_ROUNDS), ("all", 1)):
        for turn in range(turns):
            between = None
            if kind != "one" and not rows.isEmpty():
                rows, between = paired(rows, turn)
            if rows.isEmpty():
                break
            pairs = join.with_one(rows, turn) if kind == "one" else join.one_of_both(between) if kind == "groups" else join.all_of_both(rows, between)
            rows, more = settle(rows, pairs, kind == "all")
            scratch.drop(between)
            if not more:
                break
    scratch.drop(rows, *checked)
    return functools.reduce(DataFrame.union, [x.select("a", "b") for x in links]) if links else sets.select(F.col("doc_id").alias("a"), F.col("doc_id").alias("b")).limit(0)


def near_duplicates(docs: DataFrame, k: int = WORDS, percent: int = PERCENT, count_links: bool = False) -> DataFrame:
    """doc_id, n_shingles, component_id and, if asked for, n_links of each row of docs."""
    scratch = Scratch(docs.sparkSession)
    sizes = scratch.keep(set_sizes(docs, k))
    classes = scratch.keep(sizes.where("n > 0 and doc_id is not null").groupBy("n", "sa", "sb").agg(F.min("doc_id").alias("class_id"), F.countDistinct("doc_id").alias("copies")))
    total = sizes.agg(F.sum("n")).first()[0] or 0
    chosen = classes.select(F.col("class_id").alias("doc_id"), "n", "copies").groupBy("doc_id").agg(F.max("n").alias("n"), F.max("copies").alias("copies"))
    # suffix filter: a document whose shared shingles can't reach the threshold links with no other class
    sets = scratch.keep(shared_shingles(docs, total, frequent_shingles(sizes), k).join(chosen, "doc_id").where(F.size("shared") * 100 >= percent * F.col("n")))
    found = components(links_between(sets, percent, scratch), scratch)

    classed = sizes.join(classes, ["n", "sa", "sb"], "left").join(found.withColumnRenamed("node", "class_id"), "class_id", "left")
    lone = F.col("class_id").isNull()
    out = classed.select("doc_id", F.col("n").alias("n_shingles"), F.when(lone, F.col("doc_id")).otherwise(F.coalesce("component", "class_id")).alias("component_id"), "class_id", F.coalesce("copies", F.lit(1)).alias("copies"))
    if not count_links:
        scratch.drop(sets)
        return out.drop("class_id", "copies")
    counts = link_counts(sets.join(found.withColumnRenamed("node", "doc_id"), "doc_id"), percent)
    joined = out.join(counts.withColumnRenamed("doc_id", "class_id"), "class_id", "left")
    return joined.select("doc_id", "n_shingles", "component_id", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"))


def one_of_each(docs: DataFrame) -> DataFrame:
    """The rows of docs, with docs' columns, that are the first of their component; rows that repeat such a doc_id stay."""
    found = near_duplicates(docs.select("doc_id", "text"))
    gone = found.where("component_id < doc_id").select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti").select(*docs.columns)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"))
