"""Collocations of 2 to 5 words from a weighted de Bruijn graph of phrases.

Texts are split at marks and line ends into pieces, these into words. The graph's edges are the longest grams (5 words) with their numbers of
occurrences; an edge runs from the node of its first four words to that of its last four. A node's count is its flow: what its outgoing edges carry, and the
pieces that end with it. In the same way the counts of three words follow from those of four, and two from three; shorter grams are never counted one by one.
A phrase whose whole flow goes through one longer edge, on its right or its left, lies on a unary path and is compacted into that edge; as counts never grow with
a phrase, looking at the phrases with one word more is enough. What isn't compacted is scored by its cuts.

Thinning: a word, or two neighbours, that occur less than the least count can't be within a phrase that occurs so often, so a piece ends between them. That leaves all
counts from the least one on as they are. Pairs are counted by a hash of 64 bits; one that shares its hash with others is at worst kept without need. The frequent words
and pairs are sent to all tasks if they take no more than ``broadcast_bytes``; if they take more, the pieces stay whole, which costs shuffles and changes no row. Counts are summed in each slice of a task, then by Spark with partial sums; nothing is
gathered by a word or a language, and the first rows of a language are found in parts first.

Edges: a null text is empty, a null language is ``und``; repeated rows count as often as they occur; ties are ordered by the phrase's UTF-8 bytes; an
empty table, or one without frequent phrases, gives an empty result. Further columns are not read. The arrays of the largest single text must fit in a task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401  pa.compute
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import BASE_A, BASE_B, U64, Scratch, Texts, group_starts, mix, prefix_sums, range_hashes, slices, table

LONGEST, LEAST_COUNT, TOP = 5, 100, 2000
SLICE = 2 << 20
SPACES, MARKS = b" \t", b".,;:!?\n\v\f\r"
COUNTS = "lang string, size int, phrase string, n bigint"


# --- one slice of texts -------------------------------------------------------------------------------------------


class Pieces:
    """The words of a slice: word (number of the distinct word), piece (number, over all texts), lang (number); and the distinct words and languages."""

    def __init__(self, batch: pa.RecordBatch):
        texts = Texts(batch.column("text"), lower=True)
        raw = texts.raw
        kind = np.zeros(256, np.int8)
        kind[list(SPACES)], kind[list(MARKS)] = 1, 2
        kinds = kind[raw]
        inside = np.zeros(len(raw) + 2, np.int8)
        inside[1:-1] = kinds == 0
        cut = texts.bounds[1:-1]
        cut = np.unique(cut[(cut > 0) & (cut < len(raw))])
        cut = cut[(inside[cut] == 1) & (inside[cut + 1] == 1)]  # a text's end also ends a word
        step = np.diff(inside)
        starts, ends = (np.sort(np.concatenate([np.flatnonzero(step == s), cut])) for s in (1, -1))
        offsets = np.concatenate([[0], np.cumsum(ends - starts)]).astype(np.int64)
        words = pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(offsets), pa.py_buffer(raw[kinds == 0].tobytes())).dictionary_encode()
        self.word, self.words = words.indices.to_numpy(zero_copy_only=False).astype(np.int64), words.dictionary
        text = np.searchsorted(texts.bounds, starts, side="right")
        self.piece = np.searchsorted(np.flatnonzero(kinds == 2), starts) + text
        langs = pa.compute.fill_null(batch.column("lang").cast(pa.string()), "und").dictionary_encode()
        self.lang, self.langs = langs.indices.to_numpy(zero_copy_only=False).astype(np.int64)[text - 1], langs.dictionary.cast(pa.large_string())

    def phrases(self, starts: np.ndarray, size: int) -> pa.Array:
        columns = [self.words.take(pa.array(self.word[starts + i])) for i in range(size)]
        return columns[0] if size == 1 else pa.compute.binary_join_element_wise(*columns, pa.scalar(" ", pa.large_string()))

    def counted(self, starts: np.ndarray, key: np.ndarray, size: int) -> pa.RecordBatch:
        """One row for each distinct key (of a language and a phrase) among the grams of this size that begin at starts."""
        _, first, n = np.unique(key, return_index=True, return_counts=True)
        at = starts[first]
        columns = [self.langs.take(pa.array(self.lang[at])).cast(pa.string()), pa.array(np.full(len(at), size, np.int32)), self.phrases(at, size).cast(pa.string()), pa.array(n)]
        return pa.RecordBatch.from_arrays(columns, [c.split()[0] for c in COUNTS.split(", ")])

    def known(self, frequent: dict[str, pa.Array] | None) -> np.ndarray:
        """Which words are frequent in their language; all where that isn't known."""
        if frequent is None:
            return np.ones(len(self.word), bool)
        found = np.zeros((len(self.langs), len(self.words)), bool)
        for i, lang in enumerate(self.langs.to_pylist()):
            found[i] = pa.compute.is_in(self.words, frequent.get(lang, pa.array([], pa.large_string()))).to_numpy(zero_copy_only=False)
        return found[self.lang, self.word]

    def pairs(self, frequent: dict[str, pa.Array] | None) -> tuple[np.ndarray, np.ndarray]:
        """Starts of the neighbouring words of a piece that are both frequent, and hashes of the pair and its language."""
        good = self.known(frequent)
        at = np.flatnonzero((self.piece[:-1] == self.piece[1:]) & good[:-1] & good[1:])
        word, lang = hashes(self.words), hashes(self.langs)
        return at, mix(word[self.word[at]] * U64(BASE_B) + word[self.word[at + 1]] + mix(lang[self.lang[at]])).view(np.int64)


def hashes(strings: pa.Array) -> np.ndarray:
    texts = Texts(strings)
    return range_hashes(prefix_sums(texts.raw + U64(1), BASE_A), texts.bounds[:-1], texts.bounds[1:], BASE_A)


def merged(counts: Iterator[pa.RecordBatch], most: int = 1 << 19) -> Iterator[pa.RecordBatch]:
    """Counts of a task's slices, added up while they have no more than so many rows."""
    held, n = [], 0
    for batch in counts:
        held.append(batch)
        n += batch.num_rows
        if n > most:
            held = pa.Table.from_batches(held).group_by(batch.schema.names[:-1], use_threads=False).aggregate([("n", "sum")]).rename_columns(batch.schema.names).to_batches()
            n = sum(b.num_rows for b in held)
            if 2 * n > most:
                yield from held
                held, n = [], 0
    yield from held


def word_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, most=SLICE):
        p = Pieces(batch)
        yield p.counted(np.arange(len(p.word)), p.lang * len(p.words) + p.word, 1)


def pair_counts(words: dict[str, pa.Array] | None):
    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, most=SLICE):
            pair, n = np.unique(Pieces(batch).pairs(words)[1], return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(pair), pa.array(n)], ["pair", "n"])

    return each


def edge_counts(words: dict[str, pa.Array] | None, pairs: np.ndarray | None):
    """The graph's edges, and for each piece its tail: the last words of it, one less than an edge has or all there are. pairs: hashes of those to keep, sorted."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, most=SLICE):
            p = Pieces(batch)
            at, key = p.pairs(words)
            if pairs is not None:
                good = pairs[np.minimum(np.searchsorted(pairs, key), len(pairs) - 1)] == key if len(pairs) else np.zeros(len(key), bool)
                at, key = at[good], key[good]  # a run of neighbours is what is left of a piece
            fresh = np.zeros(len(at), bool)
            fresh[group_starts(at - np.arange(len(at)))] = True
            run = np.cumsum(fresh)
            size, names = 2, np.unique((p.lang[at] * len(p.words) + p.word[at]) * len(p.words) + p.word[at + 1], return_inverse=True)[1]
            while True:  # names: numbers of the grams of this size that begin at at[i], for those that do
                if size == LONGEST:
                    yield p.counted(at, names, size)
                    break
                tail, first = np.ones(len(run), bool), np.ones(len(run), bool)
                tail[:-1] = first[1:] = run[1:] != run[:-1]
                if size < LONGEST - 1:
                    tail &= first  # the piece has no more words
                yield p.counted(at[tail], names[tail], size)
                on = np.flatnonzero(run[:-1] == run[1:])
                # two neighbouring grams of one size are a gram of the next
                names = np.unique(names[on] * (int(names.max()) + 1 if len(names) else 1) + names[on + 1], return_inverse=True)[1]
                at, run, size = at[on], run[on], size + 1

    return each


# --- the graph as tables ------------------------------------------------------------------------------------------


def sent(counts: DataFrame, most: int) -> dict[str, pa.Array] | None:
    """The phrases of each language for every task, unless they take more than so many bytes."""
    taken = counts.agg(F.sum(F.octet_length("phrase") + F.octet_length("lang") + 16)).first()[0] or 0
    if taken > most:
        return None
    found = counts.select("lang", "phrase").toArrow()
    return {lang.as_py(): found.filter(pa.compute.equal(found["lang"], lang))["phrase"].combine_chunks().cast(pa.large_string()) for lang in pa.compute.unique(found["lang"])}


def summed(counts: DataFrame) -> DataFrame:
    return counts.groupBy("lang", "size", "phrase").agg(F.sum("n").alias("n"))


def first_words(phrase: Column, size: int | Column) -> Column:
    return F.array_join(F.slice(F.split(phrase, " "), 1, size), " ")


def rest_words(phrase: Column, size: int | Column) -> Column:
    """phrase without so many words at its beginning."""
    size = F.lit(size) if isinstance(size, int) else size
    return F.array_join(F.slice(F.split(phrase, " "), size + 1, F.size(F.split(phrase, " ")) - size), " ")


def flows(longer: DataFrame, tails: DataFrame, size: int) -> DataFrame:
    """Counts of the nodes of this size: what the grams of one word more that leave them carry, and the pieces that end with them."""
    leaving = longer.select("lang", first_words(F.col("phrase"), size).alias("phrase"), "n")
    ending = tails.where(F.col("size").between(size, LONGEST - 1)).select("lang", rest_words(F.col("phrase"), F.col("size") - size).alias("phrase"), "n")
    return leaving.unionByName(ending).groupBy("lang", "phrase").agg(F.sum("n").alias("n")).withColumn("size", F.lit(size))


def compacted(phrases: DataFrame) -> DataFrame:
    """phrases without those whose whole flow goes through one that has a word more before or after them."""
    longer = phrases.where("size > 2")
    parts = [longer.select("lang", p(F.col("phrase")).alias("phrase"), F.col("n").alias("through")) for p in (lambda c: first_words(c, F.size(F.split(c, " ")) - 1), lambda c: rest_words(c, 1))]
    most = parts[0].unionByName(parts[1]).groupBy("lang", "phrase").agg(F.max("through").alias("through"))
    return phrases.join(most, ["lang", "phrase"], "left").where("through is null or through < n").drop("through")


def scored(phrases: DataFrame, counts: DataFrame, totals: DataFrame) -> DataFrame:
    """Each phrase with its lowest-scoring cut. counts: lang, phrase and n of all parts; totals: lang and the number of its words."""
    cuts = phrases.select("lang", "phrase", F.col("n").alias("a"), F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("k"))
    cuts = cuts.withColumns({"first": first_words(F.col("phrase"), F.col("k")), "rest": rest_words(F.col("phrase"), F.col("k"))})
    for part, name in (("first", "l"), ("rest", "r")):
        cuts = cuts.join(counts.select("lang", F.col("phrase").alias(part), F.col("n").alias(name)), ["lang", part])
    cuts = cuts.join(totals, "lang")  # one row for each language: Spark sends it to all tasks when it's small
    wide = lambda c, digits: F.col(c).cast(f"decimal({digits},0)")
    score = F.expr("cast(a * 1000 as decimal(19,0)) * cast(total as decimal(19,0)) div (cast(l as decimal(19,0)) * cast(r as decimal(19,0)))")
    best = cuts.groupBy("lang", "phrase", "a", "total").agg(F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("c"))
    return best.select("lang", "phrase", "a", "c.l", "c.r", F.col("total").alias("n"), "c.score")


def ranked(found: DataFrame, top: int, parts: int) -> DataFrame:
    """The first rows of each language; first within parts of it, so that no task holds all of a language."""
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase")]
    head = lambda df, *keys: df.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(F.col("rank") <= top)
    some = head(found.withColumn("part", F.pmod(F.xxhash64("phrase"), F.lit(parts))), "lang", "part").drop("part", "rank")
    return head(some, "lang").withColumn("rank", F.col("rank").cast("long"))


def collocations(docs: DataFrame, least: int = LEAST_COUNT, top: int = TOP, broadcast_bytes: int = 64 << 20, scratch: Scratch | None = None) -> DataFrame:
    """lang, rank, phrase, a, l, r, n and score of each language's first phrases."""
    spark = docs.sparkSession
    scratch, parts = scratch or Scratch(spark), int(spark.conf.get("spark.sql.shuffle.partitions"))
    texts = docs.select("text", "lang")
    words = scratch.keep(summed(texts.mapInArrow(word_counts, COUNTS)).withColumn("often", F.col("n") >= least))
    # languages are codes; their totals are one small row each
    totals = words.groupBy("lang").agg(F.sum("n").alias("total"))
    often = words.where("often").drop("often")
    frequent = sent(often, broadcast_bytes)
    pairs = None
    if frequent is not None:
        heavy = scratch.keep(texts.mapInArrow(pair_counts(frequent), "pair bigint, n bigint").groupBy("pair").agg(F.sum("n").alias("n")).where(F.col("n") >= least).select("pair"))
        if heavy.count() * 8 <= broadcast_bytes:
            pairs = np.sort(heavy.toArrow()["pair"].to_numpy())
        scratch.drop(heavy)
    each = edge_counts(frequent, pairs)
    grams = scratch.keep(summed(texts.mapInArrow(lambda batches: merged(each(batches)), COUNTS)))
    of_size = {LONGEST: grams.where(F.col("size") == LONGEST)}
    for size in range(LONGEST - 1, 1, -1):
        of_size[size] = scratch.keep(flows(of_size[size + 1], grams, size))
    candidates = None
    for part in of_size.values():
        part = part.where(F.col("n") >= least).select("lang", "size", "phrase", "n")
        candidates = part if candidates is None else candidates.unionByName(part)
    candidates = scratch.keep(candidates)
    scratch.drop(grams, *of_size.values())
    result = ranked(scored(compacted(candidates), candidates.unionByName(often.select("lang", "size", "phrase", "n")), totals), top, parts)
    return result.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents"))


ORACLE = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, regexp_extract_all(p, '[^ \t]+') AS w
  FROM (SELECT lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS p FROM documents)),
places AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM pieces),
grams AS (SELECT lang, k, array_to_string(w[i : i + k - 1], ' ') AS phrase FROM places, (SELECT unnest([1, 2, 3, 4, 5]) AS k) WHERE i + k - 1 <= len(w)),
f AS (SELECT lang, k, phrase, count(*) AS a, string_split(phrase, ' ') AS w FROM grams GROUP BY 1, 2, 3 HAVING count(*) >= 100),
totals AS (SELECT lang, count(*) AS n FROM places GROUP BY 1),
inside AS (SELECT lang, array_to_string(w[i : i + j - 1], ' ') AS phrase, max(a) AS most FROM (SELECT *, unnest(range(1, k)) AS j FROM f WHERE k > 2), (SELECT unnest([1, 2, 3, 4]) AS i) WHERE j >= 2 AND i + j - 1 <= k GROUP BY 1, 2),
cuts AS (SELECT f.lang, f.phrase, f.a, c, x.a AS l, y.a AS r, n, (1000::HUGEINT * f.a * n) // (x.a::HUGEINT * y.a) AS score
  FROM (SELECT *, unnest(range(1, k)) AS c FROM f WHERE k > 1 AND NOT EXISTS (SELECT 1 FROM inside WHERE inside.lang = f.lang AND inside.phrase = f.phrase AND 100 * most >= 100 * f.a)) f
  JOIN f x ON x.lang = f.lang AND x.phrase = array_to_string(f.w[1 : c], ' ') JOIN f y ON y.lang = f.lang AND y.phrase = array_to_string(f.w[c + 1 : f.k], ' ') JOIN totals ON totals.lang = f.lang),
best AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, c) = 1)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n::BIGINT AS n, score::BIGINT AS score
FROM best QUALIFY rank <= 2000"""
