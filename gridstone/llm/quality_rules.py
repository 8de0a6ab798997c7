"""Quality rules as a short-circuit cascade, with DataFrame functions only.

Each rule is a Boolean column that is true where a text fails. On a bounded sample the cascade measures what each rule
costs and how many of the sampled texts that pass the base rule it rejects, and then runs the rules in the order of rejection per cost inside
one ``CASE``, whose later branches are not evaluated for a text that an earlier branch has rejected. The order changes
the cost only; the verdict is the same in any order. A rule's cost is the least time of three runs over the sample, less that of a rule that looks at nothing,
so that planning and scheduling don't count. The sample is the first rows of at most SAMPLE_CHARS characters that Spark finds, read from as few partitions as hold
enough of them.

``judged`` returns every statistic of every text, so only the six further rules are in its cascade. ``keep_quality`` needs the verdict alone: its cascade also
holds the base rule's repeated words, and a statistic is computed only in the branch that needs it.

Nulls: a null text counts as empty; null in any other column is carried along. An empty text has no words and fails
the base rule. Repeated rows are judged one by one. An empty table gives an empty result. Columns of ``judged``'s input that have the
name of a result column, or are called words or text_, are replaced or dropped; ``keep_quality`` carries all columns along, whatever their names.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table

SPACES = r"[\x20\x09-\x0D]+"
SYMBOLS = r"[#*$%&|<>]"
LEAST_WORDS = 50
#: Characters of a sampled text at most, so that the sample, which passes through the driver, has a bounded size. It sets the order of the rules only.
SAMPLE_CHARS = 16_384
Values = Callable[[str], Column]


@dataclass(frozen=True)
class Rule:
    """fails: a Boolean column, from a function that gives the statistics, the text and its words by name."""

    name: str
    fails: Callable[[Values], Column]


#: Rules with their fixed thresholds; the reasons they look at are each text's own words, characters and lines.
RULES = (
    Rule("symbols_per_word", lambda x: x("n_symbols") > 0.1 * x("n_words")),
    Rule("long_or_short_words", lambda x: (x("word_chars") < 2 * x("n_words")) | (x("word_chars") > 20 * x("n_words"))),
    Rule("repeated_lines", lambda x: let(x("lines"), lambda n: n["n"] - n["d"] > 0.3 * n["n"])),
    Rule("few_distinct_words", lambda x: F.size(F.array_distinct(x("words"))) < 0.2 * x("n_words")),
    Rule("shouting", lambda x: F.regexp_count(x("text"), F.lit(r"\p{Lu}")) > 0.5 * x("word_chars")),
    Rule("no_letters", lambda x: F.regexp_count(x("text"), F.lit(r"\p{L}")) < 0.5 * x("word_chars")),
)
REPEATED_WORDS = Rule("repeated_words", lambda x: 100 * x("n_repeat_words") > 50 * x("n_words"))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body of value, with value computed once for a row however often body uses it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def words_of(text: Column) -> Column:
    return F.filter(F.split(text, SPACES), lambda w: w != "")


def repeated_words(words: Column, window: int = 3) -> Column:
    """How many words lie in windows that occur twice or more in the text.

    Windows are compared by a hash of their words' hashes. If any occurs twice, they are sorted as (hash, place); those with an equal neighbour
    repeat. Their places, in order, cover min(window, distance to the next) words each.
    """

    def windows(h: Column) -> Column:
        return F.transform(F.sequence(F.lit(0), F.size(h) - window), lambda i: F.xxhash64(*[F.get(h, i + k) for k in range(window)]))

    def same(a: Column, b: Column) -> Column:
        return F.coalesce(a["h"] == b["h"], F.lit(False))

    def places(s: Column) -> Column:
        kept = F.filter(s, lambda x, k: same(x, F.get(s, k - 1)) | same(x, F.get(s, k + 1)))
        return F.sort_array(F.transform(kept, lambda x: x["i"]))

    def cover(p: Column) -> Column:
        return F.aggregate(p, F.struct(F.lit(0).alias("n"), F.lit(-window).alias("last")), lambda a, i: F.struct((a["n"] + F.least(F.lit(window), i - a["last"])).alias("n"), i.alias("last")), lambda a: a["n"])

    def sorted_windows(w: Column) -> Column:
        return F.sort_array(F.transform(w, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

    def count(h: Column) -> Column:
        # most texts repeat no window: a hash set tells, without a sort
        return let(windows(h), lambda w: F.when(F.size(F.array_distinct(w)) < F.size(w), let(sorted_windows(w), lambda t: let(places(t), cover))).otherwise(0))

    return F.when(F.size(words) > window, let(F.transform(words, lambda x: F.xxhash64(x)), count)).otherwise(0)


def values(text: Column, words: Column, n_words: Column | None = None, word_chars: Column | None = None) -> Values:
    """The statistics by name, as expressions of a text and its words."""
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    found = {
        "text": text,
        "words": words,
        "n_words": F.size(words).cast("long") if n_words is None else n_words,
        "word_chars": F.length(F.array_join(words, "")).cast("long") if word_chars is None else word_chars,
        "n_symbols": F.regexp_count(text, F.lit(SYMBOLS)).cast("long"),
        "lines": let(lines, lambda x: F.struct(F.size(x).cast("long").alias("n"), F.size(F.array_distinct(x)).cast("long").alias("d"))),
        "n_repeat_words": repeated_words(words).cast("long"),
    }
    return found.__getitem__


def known(name: str) -> Column:
    """The same statistics where ``with_statistics`` has put them into columns."""
    return F.struct(F.col("n_lines").alias("n"), (F.col("n_lines") - F.col("n_dup_lines")).alias("d")) if name == "lines" else F.col("text_" if name == "text" else name)


def with_statistics(docs: DataFrame) -> DataFrame:
    """docs with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines, base_failed, and text_ and words for the rules."""
    x = values(F.col("text_"), F.col("words"))
    return (
        docs.withColumn("text_", F.coalesce(F.col("text"), F.lit("")))
        .withColumn("words", words_of(F.col("text_")))
        .withColumns({"lines_": x("lines"), **{name: x(name) for name in ("n_words", "word_chars", "n_symbols", "n_repeat_words")}})
        .withColumns({"n_lines": F.col("lines_.n"), "n_dup_lines": F.col("lines_.n") - F.col("lines_.d"), "base_failed": (F.col("n_words") < LEAST_WORDS) | REPEATED_WORDS.fails(F.col)})
        .drop("lines_")
    )


def cascade_order(docs: DataFrame, rules: tuple[Rule, ...], sample_rows: int = 512, precomputed: bool = True) -> list[Rule]:
    """rules, those that reject most per second first, among texts that pass the base rule or, without precomputed statistics, its number of words."""
    rows = docs.select("text").where(F.length("text") <= SAMPLE_CHARS).take(sample_rows)
    if not rows:
        return list(rules)
    sample = cached = with_statistics(docs.sparkSession.createDataFrame(rows, "text string").coalesce(1)).cache()
    sample = sample.where(~F.col("base_failed") if precomputed else F.col("n_words") >= LEAST_WORDS)
    x = known if precomputed else values(F.col("text_"), F.col("words"), F.col("n_words"), F.col("word_chars"))

    def run(fails: Column) -> tuple[float, float]:
        began = time.perf_counter()
        rejected = sample.agg(F.avg(fails.cast("double"))).first()[0] or 0.0
        return time.perf_counter() - began, rejected

    nothing = F.length("text_") < 0
    run(nothing)  # fills the cache
    least = min(run(nothing)[0] for _ in range(3))
    found = []
    for rule in rules:
        seconds, rejected = min(run(rule.fails(x)) for _ in range(3))
        found.append((rejected / max(1e-4, seconds - least), rule))
    cached.unpersist()
    return [rule for _, rule in sorted(found, key=lambda x: -x[0])]


def cascade(x: Values, rules: list[Rule], first: Column) -> Column:
    """False where first holds or a rule fails, each looked at only if none before it did."""
    verdict = F.when(first, False)
    for rule in rules:
        verdict = verdict.when(rule.fails(x), False)
    return verdict.otherwise(True)


def judged(docs: DataFrame, rules: tuple[Rule, ...] = RULES, sample_rows: int = 512) -> DataFrame:
    """docs with the statistics, base_failed and kept."""
    return with_statistics(docs).withColumn("kept", cascade(known, cascade_order(docs, rules, sample_rows), F.col("base_failed"))).drop("words", "text_")


def keep_quality(docs: DataFrame, rules: tuple[Rule, ...] = RULES, sample_rows: int = 512) -> DataFrame:
    """The rows of docs, with docs' columns, whose text passes the base rule and every rule."""
    order = cascade_order(docs, (*rules, REPEATED_WORDS), sample_rows, precomputed=False)

    def kept(text: Column) -> Column:
        def with_sums(words: Column) -> Column:
            sums = F.struct(F.size(words).cast("long").alias("n"), F.length(F.array_join(words, "")).cast("long").alias("c"))
            return let(sums, lambda s: cascade(values(text, words, s["n"], s["c"]), order, s["n"] < LEAST_WORDS))

        return let(words_of(text), with_sums)

    return docs.where(let(F.coalesce(F.col("text"), F.lit("")), kept))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return judged(docs).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


ORACLE = r"""
WITH w AS (
  SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls
  FROM documents),
g AS (
  SELECT doc_id, unnest(range(1, len(ws) - 1)) AS i, ws FROM w WHERE len(ws) > 2),
h AS (
  SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, ws[i], ws[i + 1], ws[i + 2]) AS c FROM g),
r AS (
  SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS p FROM h WHERE c > 1) GROUP BY doc_id),
s AS (
  SELECT w.doc_id, t, ws, len(ws) AS n_words, length(array_to_string(ws, '')) AS word_chars,
    len(regexp_extract_all(t, '[#*$%&|<>]')) AS n_symbols, len(ls) AS n_lines, len(ls) - len(list_distinct(ls)) AS n_dup_lines,
    coalesce(r.n, 0) AS n_repeat_words
  FROM w LEFT JOIN r ON r.doc_id = w.doc_id),
b AS (
  SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM s)
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols,
  n_dup_lines::BIGINT AS n_dup_lines, n_repeat_words::BIGINT AS n_repeat_words, base_failed,
  NOT (base_failed OR n_symbols > 0.1 * n_words OR word_chars < 2 * n_words OR word_chars > 20 * n_words
    OR n_dup_lines > 0.3 * n_lines OR len(list_distinct(ws)) < 0.2 * n_words
    OR len(regexp_extract_all(t, '\p{Lu}')) > 0.5 * word_chars OR len(regexp_extract_all(t, '\p{L}')) < 0.5 * word_chars) AS kept
FROM b
"""
