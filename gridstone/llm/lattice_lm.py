"""Document scores from a subword lattice.

The vocabulary is an existing subword vocabulary. Its pieces' unigram scores weight every segmentation of a word (a space and the word's bytes) in a
lattice; the log-space forward recursion sums them all, and a document's probability is the product over its words and one end.
Scores start from the vocabulary's own ranks and are fitted to the training texts by expectation maximisation over the same lattices,
with the words of the training texts weighted by their counts. Byte pieces make sure that every text has a segmentation.

Everything is done for each distinct word once, not for each token: words are counted by a distributed aggregation, scored in a table, and go
back to the documents in two ways. The most frequent words (a fixed number) are broadcast; the others are joined.

The base score is that of words: log10((c + 0.5) / (N + 0.5 (V + 1))) for every token, the end included.

Nulls: a null text counts as empty and has the end token alone; a row with a null doc_id is in the training part. Repeated rows are scored
and counted each. With no training texts, scores are those of the vocabulary's ranks. An empty table gives an empty result. Other
columns are not read. Words of any length are scored whole.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import BASE_A, U64, Texts, checkpointed, column, prefix_sums, range_hashes, slices, table

VOCABULARY, ITERATIONS, HOT_WORDS, HELD_OUT = "piece_bpe_32k", 3, 1 << 17, 1


def vocabulary(name: str = VOCABULARY) -> list[tuple[bytes, float]]:
    """Pieces as bytes (a space marks a word's start), each with its score, best first; last the single bytes."""
    import public_tokenizers
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(f"{name}.model"))
    found: dict[bytes, float] = {}
    for i in range(sp.get_piece_size()):
        if sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i) or sp.get_score(i) < -1e8:
            continue
        piece = sp.id_to_piece(i).replace("▁", " ").encode()
        if b" " not in piece[1:] and not any(65 <= c <= 90 for c in piece):
            found[piece] = max(found.get(piece, -np.inf), sp.get_score(i))
    for c in range(256):
        found.setdefault(bytes([c]), -np.inf)
    return sorted(found.items(), key=lambda x: (-x[1], x[0]))


class Lattice:
    """A trie of the pieces as a transition table, and the lattices of many words at once."""

    def __init__(self, pieces: list[bytes]):
        nodes: list[dict[int, int]] = [{}]
        self.piece = [-1]
        for i, p in enumerate(pieces):
            at = 0
            for c in p:
                if c not in nodes[at]:
                    nodes[at][c] = len(nodes)
                    nodes.append({})
                    self.piece.append(-1)
                at = nodes[at][c]
            self.piece[at] = i
        self.piece = np.array(self.piece, np.int32)
        self.next = np.zeros((len(nodes), 256), np.int32)
        for i, node in enumerate(nodes):
            for c, j in node.items():
                self.next[i, c] = j

    def edges(self, text: np.ndarray):
        """(from, to, words, pieces) of the lattices of words of equal length, by starting place; text: one row of bytes for each word."""
        n, length = text.shape
        for i in range(length):
            words, node = np.arange(n), np.zeros(n, np.int32)
            for j in range(i, length):
                node = self.next[node, text[words, j]]
                alive = node > 0
                if not alive.all():
                    words, node = words[alive], node[alive]
                if not len(words):
                    break
                piece = self.piece[node]
                ends = piece >= 0
                if ends.any():
                    yield i, j + 1, words[ends], piece[ends]

    def forward(self, text: np.ndarray, scores: np.ndarray, keep: list | None = None) -> np.ndarray:
        """alpha[place, word]: log probability of all segmentations up to place."""
        alpha = np.full((text.shape[1] + 1, len(text)), -np.inf)
        alpha[0] = 0
        for edge in self.edges(text):
            i, j, words, piece = edge
            alpha[j, words] = np.logaddexp(alpha[j, words], alpha[i, words] + scores[piece])
            if keep is not None:
                keep.append(edge)
        return alpha

    def expected(self, text: np.ndarray, weight: np.ndarray, scores: np.ndarray) -> np.ndarray:
        """How often each piece is expected in words of these weights."""
        kept: list = []
        alpha = self.forward(text, scores, kept)
        beta = np.full(alpha.shape, -np.inf)
        beta[-1] = 0
        out = np.zeros(len(scores))
        for i, j, words, piece in reversed(kept):
            through = scores[piece] + beta[j, words]
            out += np.bincount(piece, np.exp(alpha[i, words] + through - alpha[-1, words]) * weight[words], len(out))
            beta[i, words] = np.logaddexp(beta[i, words], through)
        return out


def by_length(words: pa.Array, most: int = 1 << 17):
    """(indices, bytes) of words of one length, a space before each, in groups of about ``most`` bytes."""
    t = Texts(words)
    lengths = np.diff(t.bounds)
    for n in np.unique(lengths):
        rows = np.flatnonzero(lengths == n)
        for part in np.array_split(rows, max(1, len(rows) * (n + 1) // most)):
            text = np.full((len(part), n + 1), 32, np.uint8)
            text[:, 1:] = t.raw[t.bounds[part][:, None] + np.arange(n)[None, :]]
            yield part, text


def strings(texts: Texts, starts: np.ndarray, ends: np.ndarray) -> pa.Array:
    """Ranges of a buffer as a string column."""
    n = ends - starts
    at = np.repeat(starts - (np.cumsum(n) - n), n) + np.arange(n.sum())
    offsets = np.concatenate([[0], np.cumsum(n)]).astype(np.int32)
    return pa.StringArray.from_buffers(len(n), pa.py_buffer(offsets), pa.py_buffer(texts.raw[at].tobytes()))


def count_words(docs: DataFrame) -> DataFrame:
    """word and c (its occurrences in training texts) of every word of docs (text, held_out)."""

    def run(batches):
        for b in slices(batches):
            t = Texts(b.column("text"), lower=True)
            w = t.words()
            trains = ~column(b, "held_out").astype(bool)
            _, at, back = np.unique(w.hashes(), return_index=True, return_inverse=True)
            c = np.bincount(back, trains[w.of], len(at)).astype(np.int64)
            yield pa.RecordBatch.from_arrays([strings(t, w.starts[at], w.ends[at]), pa.array(c)], ["word", "c"])

    return docs.mapInArrow(run, "word string, c long").groupBy("word").agg(F.sum("c").alias("c"))


def fitted(words: DataFrame, n_texts: int, iterations: int = ITERATIONS) -> tuple[list[bytes], np.ndarray, float]:
    """Pieces, their log scores, and the end's, after EM on words (word, c). The driver sees a number for each piece."""
    ranked = vocabulary()
    pieces = [p for p, _ in ranked]
    first = 1 / (np.arange(len(pieces)) + 10.0)
    first[[i for i, (_, s) in enumerate(ranked) if s == -np.inf]] = 1e-6
    counts, ends = first / first.sum(), 1 / (1 + len(pieces))
    spark = words.sparkSession
    training = words.where("c > 0")
    for i in range(iterations + 1):
        total = counts.sum() + ends
        scores, end = np.log(counts / total), float(np.log(ends / total))
        if i == iterations or not n_texts:
            return pieces, scores, end
        model = spark.sparkContext.broadcast((pieces, scores))

        def run(batches, model=model):
            lattice, found = Lattice(model.value[0]), np.zeros(len(model.value[0]))
            for b in batches:
                c = column(b, "c").astype(float)
                for rows, text in by_length(b.column("word")):
                    found += lattice.expected(text, c[rows], model.value[1])
            at = np.flatnonzero(found)
            yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(found[at])], ["piece", "n"])

        counts, ends = np.full(len(pieces), 0.01), float(n_texts)
        for piece, n in training.mapInArrow(run, "piece int, n double").groupBy("piece").agg(F.sum("n")).collect():
            counts[piece] += n


def scored_words(words: DataFrame, pieces: list[bytes], scores: np.ndarray) -> DataFrame:
    """words with base (log10(c + 0.5)) and score (log10 of the word's probability)."""
    model = words.sparkSession.sparkContext.broadcast((pieces, scores))

    def run(batches):
        lattice = Lattice(model.value[0])
        for b in batches:
            out = np.zeros(len(b))
            for rows, text in by_length(b.column("word")):
                out[rows] = lattice.forward(text, model.value[1])[-1] / np.log(10)
            yield pa.RecordBatch.from_arrays([b.column("word"), b.column("c"), pa.array(np.log10(column(b, "c") + 0.5)), pa.array(out)], ["word", "c", "base", "score"])

    return words.mapInArrow(run, "word string, c long, base double, score double")


def scored(docs: DataFrame, hot_words: int = HOT_WORDS) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score of each row of docs."""
    spark = docs.sparkSession
    part = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == HELD_OUT, F.lit(False))
    docs = docs.select("doc_id", "text", part.alias("held_out"))
    words = checkpointed(count_words(docs.select("text", "held_out")))
    n_texts = docs.where("not held_out").count()
    sums = words.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count_if(F.col("c") > 0)).first()
    n, v = sums[0] + n_texts, sums[1] + (n_texts > 0)
    pieces, scores, end = fitted(words, n_texts)
    words = checkpointed(scored_words(words, pieces, scores))

    # the least count that at most hot_words words reach, from a histogram of a few hundred steps: no task sees more than its part
    step = F.floor(F.log(F.col("c")) / F.log(F.lit(1.05)))
    least_count, total = None, 0
    for low, m in sorted(words.where("c > 0").groupBy(step.alias("s")).agg(F.min("c").alias("low"), F.count(F.lit(1)).alias("m")).select("low", "m").collect(), reverse=True):
        total += m
        if total > hot_words:
            break
        least_count = low
    top = words.where(F.lit(least_count is not None) & (F.col("c") >= (least_count or 0))).select("word", "c", "base", "score").toArrow()
    t = Texts(top.column("word")) if top.num_rows else Texts(pa.array([], pa.string()))
    h = range_hashes(prefix_sums(t.raw + U64(1), BASE_A), t.bounds[:-1], t.bounds[1:], BASE_A)
    order = np.argsort(h)
    hot = spark.sparkContext.broadcast((h[order], *(top.column(c).to_numpy()[order] for c in ("c", "base", "score"))))
    least = float(np.log10(n + 0.5 * (v + 1)))

    def look(batches):
        known, count, base, score = hot.value
        row = TaskContext.get().partitionId() << 36
        for b in slices(batches):
            t = Texts(b.column("text"), lower=True)
            w = t.words()
            x = w.hashes()
            at = np.minimum(np.searchsorted(known, x), max(0, len(known) - 1))
            hit = known[at] == x if len(known) else np.zeros(len(x), bool)
            m, rows = len(b), row + np.arange(len(b))
            row += m
            of, at = w.of[hit], at[hit]
            sums = [np.bincount(of, y, m) for y in ((count[at] > 0).astype(float), base[at], score[at])]
            # the others: one row for each document and word
            rest = np.flatnonzero(~hit)
            order = np.lexsort((x[rest], w.of[rest]))
            rest = rest[order]
            new = np.ones(len(rest), bool)
            new[1:] = (x[rest][1:] != x[rest][:-1]) | (w.of[rest][1:] != w.of[rest][:-1])
            first = np.flatnonzero(new)
            times = np.diff(np.append(first, len(rest)))
            rest = rest[first]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.concatenate([rows, rows[w.of[rest]]])),
                    pa.chunked_array([pa.array([f" {r}" for r in rows.tolist()], pa.string()), strings(t, w.starts[rest], w.ends[rest])]).combine_chunks(),
                    pa.array(np.concatenate([np.zeros(m, np.int64), times])),
                    pa.concat_arrays([b.column("doc_id").cast(pa.int64()), pa.nulls(len(rest), pa.int64())]),
                    pa.concat_arrays([b.column("held_out"), pa.nulls(len(rest), pa.bool_())]),
                    *(pa.array(np.concatenate([y, np.zeros(len(rest))]), pa.float64()) for y in (np.diff(w.first), *sums)),
                ],
                ["row_", "word", "times", "doc_id", "held_out", "n", "known", "base", "score"],
            )

    seen = docs.mapInArrow(look, "row_ long, word string, times long, doc_id long, held_out boolean, n double, known double, base double, score double")
    # a document's own row has a key with a space, which is no word, so that it isn't joined and needs no second pass over the texts
    joined = seen.join(words.select("word", F.col("c").alias("c_"), F.col("base").alias("b_"), F.col("score").alias("s_")), "word", "left")
    times = F.col("times")
    per_row = joined.groupBy("row_").agg(
        F.max("doc_id").alias("doc_id"),
        F.max("held_out").alias("held_out"),
        F.sum("n").alias("n"),
        F.sum(F.col("known") + F.when(F.col("c_") > 0, times).otherwise(0)).alias("known"),
        F.sum(F.col("base") + F.when(times > 0, times * F.col("b_")).otherwise(0.0)).alias("base"),
        F.sum(F.col("score") + F.when(times > 0, times * F.col("s_")).otherwise(0.0)).alias("score"),
    )
    tokens = F.col("n") + 1
    return per_row.select(
        "doc_id",
        "held_out",
        tokens.cast("long").alias("n_tokens"),
        (F.col("known") + int(n_texts > 0)).cast("long").alias("n_known"),
        F.lit(int(n)).cast("long").alias("train_tokens"),
        (F.col("base") + F.lit(float(np.log10(n_texts + 0.5))) - tokens * F.lit(least)).alias("base_score"),
        (F.col("score") + F.lit(end / float(np.log(10)))).alias("score"),
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scored(table(spark, sf_dir, "documents").select("doc_id", "text"))
