"""Line dedup by winnowing over line hashes, with DataFrame functions only.

A text's lines are what ``\\n`` separates. The smallest line hash (the last one on a tie) of every ``run`` consecutive
lines is a fingerprint, so that any two equal runs of ``run`` or more lines share one. Fingerprints are joined with
those that occur more than once, each hit is extended both ways to the windows of ``run`` lines around it, and a window is
compared with the first one of the same lines in (doc_id, line) order. Lines in windows that began earlier elsewhere are deleted;
overlapping windows make up longer runs. Windows are judged on the input, not on what is left.

A repeated passage of fewer than ``run`` lines stays by this rule, however long its lines are. With ``long`` (words, characters) a run of
fewer lines counts too if it has that many words or characters in all: every such run is a fingerprint of its own and is compared with the
first one of the same lines in the same way. The pipeline's line stage uses ``LONG``; the registered query does not, as its SQL has the
rule of ``run`` lines alone.

Nulls: a null text has no lines and stays null; rows with a null doc_id stay as they are and match nothing. Texts of fewer than
``run`` lines stay as they are unless ``long`` is given. Rows that repeat a doc_id are treated as one place: none deletes another. An empty table gives an
empty result. Other columns, whatever their names, are carried along unchanged.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import WORD, table
from .quality_rules import let

RUN_LINES = 3
#: Words or characters that make a run of fewer than RUN_LINES lines long enough.
LONG = (50, 400)


def fingerprints(hashes: Column, run: int) -> Column:
    """Places (from 1) of the rightmost minimum of every run consecutive hashes, each once."""

    def least(h: Column, i: Column) -> Column:
        return F.array_min(F.transform(F.sequence(i, i + (run - 1)), lambda j: F.struct(F.element_at(h, j).alias("h"), (-j).alias("j"))))

    return let(hashes, lambda h: F.array_distinct(F.transform(F.sequence(F.lit(1), F.size(h) - (run - 1)), lambda i: -least(h, i)["j"])))


def long_windows(docs: DataFrame, run: int, long: tuple[int, int]) -> DataFrame:
    """Runs of fewer than run lines that have long's words or characters: doc_id, start, width and the hashes of their lines."""
    words, chars = long
    lines = (
        docs.where("doc_id is not null and text is not null")
        .where(F.length("text") >= min(2 * words - 1, chars))  # words are apart
        .select("doc_id", F.split("text", "\n", -1).alias("lines"))
        .select(
            "doc_id",
            F.transform("lines", lambda x: F.xxhash64(x)).alias("h"),
            F.transform("lines", lambda x: F.hash(x)).alias("g"),
            F.transform("lines", lambda x: F.regexp_count(x, F.lit(WORD))).alias("w"),
            F.transform("lines", lambda x: F.length(x)).alias("c"),
        )
    )

    def total(numbers: str, i: Column, width: int) -> Column:
        return sum((F.element_at(numbers, i + k) for k in range(1, width)), F.element_at(numbers, i))

    def starts(width: int) -> Column:
        every = F.when(F.size("h") >= width, F.sequence(F.lit(1), F.size("h") - (width - 1))).otherwise(F.array().cast("array<int>"))
        return F.transform(F.filter(every, lambda i: (total("w", i, width) >= words) | (total("c", i, width) >= chars)), lambda i: F.struct(i.alias("start"), F.lit(width).alias("width")))

    return (
        lines.select("doc_id", "h", "g", F.explode(F.concat(*[starts(n) for n in range(1, run)])).alias("at"))
        .select("doc_id", "at.start", "at.width", F.xxhash64(F.slice("h", F.col("at.start"), F.col("at.width"))).alias("a"), F.hash(F.slice("g", F.col("at.start"), F.col("at.width"))).alias("b"))
        .distinct()
    )


def repeated_lines(docs: DataFrame, run: int = RUN_LINES, long: tuple[int, int] | None = None) -> DataFrame:
    """doc_id_ and drop_ (the places, from 1, of lines to delete) of each document that has such lines."""
    lines = (
        docs.where("doc_id is not null and text is not null")
        .select("doc_id", F.split("text", "\n", -1).alias("lines"))
        .where(F.size("lines") >= run)
        .select("doc_id", F.transform("lines", lambda x: F.xxhash64(x)).alias("h"), F.transform("lines", lambda x: F.hash(x)).alias("g"))
    )
    # One row for each fingerprint, with the hashes of the lines that any window holding it can have.
    marks = (
        lines.select("doc_id", "h", "g", F.explode(fingerprints(F.col("h"), run)).alias("at"))
        .select(
            "doc_id",
            F.element_at("h", F.col("at")).alias("mark"),
            F.greatest(F.lit(1), F.col("at") - (run - 1)).alias("from_"),
            F.least(F.size("h"), F.col("at") + (run - 1)).alias("to_"),
            "h",
            "g",
        )
        .select("doc_id", "mark", "from_", F.slice("h", F.col("from_"), F.col("to_") - F.col("from_") + 1).alias("h"), F.slice("g", F.col("from_"), F.col("to_") - F.col("from_") + 1).alias("g"))
    )
    repeated = marks.groupBy("mark").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("mark")
    hits = marks.join(repeated, "mark", "left_semi")
    windows = (
        hits.select("doc_id", "from_", "h", "g", F.explode(F.sequence(F.lit(1), F.size("h") - (run - 1))).alias("k"))
        .select("doc_id", (F.col("from_") + F.col("k") - 1).alias("start"), F.xxhash64(F.slice("h", F.col("k"), run)).alias("a"), F.hash(F.slice("g", F.col("k"), run)).alias("b"))
        .distinct()
        .withColumn("width", F.lit(run))
    )
    if long is not None and run > 1:
        windows = windows.unionByName(long_windows(docs, run, long))
    place = F.struct("doc_id", "start")
    first = windows.groupBy("width", "a", "b").agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1").select("width", "a", "b", "first")
    later = windows.join(first, ["width", "a", "b"]).where(F.col("first") < place)
    return later.groupBy(F.col("doc_id").alias("doc_id_")).agg(F.array_distinct(F.flatten(F.collect_list(F.sequence("start", F.col("start") + F.col("width") - 1)))).alias("drop_"))


def without_repeats(docs: DataFrame, run: int = RUN_LINES, long: tuple[int, int] | None = None) -> DataFrame:
    """docs (columns row_, doc_id, text) with the kept text and n_deleted."""
    found = repeated_lines(docs.select("doc_id", "text"), run, long)
    def flags(n: Column, drop: Column) -> Column:
        """0 or 1 for each of n lines: a merge of the sorted places, as a count of each place in both lists."""
        both = F.concat(F.transform(F.sequence(F.lit(1), n), lambda i: i * 2 + 1), F.transform(drop, lambda i: i * 2))
        # in order, a place's mark (even) stands just before the place itself (odd)
        return let(F.array_sort(both), lambda s: F.transform(F.filter(F.transform(s, lambda x, k: F.struct(x.alias("x"), F.coalesce(F.get(s, k - 1) == x - 1, F.lit(False)).cast("int").alias("d"))), lambda y: y["x"] % 2 == 1), lambda y: y["d"]))

    def kept(lines: Column) -> Column:
        return let(flags(F.size(lines), F.col("drop_")), lambda d: F.filter(lines, lambda x, i: F.get(d, i) == 0))

    joined = docs.join(found, docs["doc_id"] == found["doc_id_"], "left").drop("doc_id_")
    return joined.select(
        *[c for c in docs.columns if c != "text"],
        F.when(F.col("drop_").isNull(), F.col("text")).otherwise(F.array_join(let(F.split("text", "\n", -1), kept), "\n")).alias("text"),
        F.coalesce(F.size("drop_"), F.lit(0)).cast("long").alias("n_deleted"),
    )


def dedup_lines(docs: DataFrame, run: int = RUN_LINES, length_column: str | None = None, long: tuple[int, int] | None = None) -> DataFrame:
    """docs, with docs' columns, whose text has lost its repeated lines; no row goes. length_column is set to the new text's length."""
    packed = docs.select(F.struct(*[F.col(c) for c in docs.columns]).alias("row_"), "doc_id", "text")
    row = F.col("row_").withField("text", F.col("text"))
    if length_column in docs.columns:
        kept = F.when(F.col("n_deleted") > 0, F.length("text")).otherwise(F.col(f"row_.{length_column}"))
        row = row.withField(length_column, kept.cast(docs.schema[length_column].dataType))
    return without_repeats(packed, run, long).select(row.alias("row_")).select("row_.*")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return without_repeats(docs).select(
        "doc_id",
        "n_deleted",
        F.length(F.coalesce("text", F.lit(""))).cast("long").alias("kept_chars"),
        F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("kept_sha256"),
    )


ORACLE = f"""
WITH l AS (
  SELECT doc_id, coalesce(text, '') AS t, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
w AS (
  SELECT doc_id, i, ls[i : i + {RUN_LINES} - 1] AS k FROM (SELECT doc_id, ls, unnest(range(1, len(ls) - {RUN_LINES} + 2)) AS i FROM l)),
f AS (
  SELECT doc_id, i, row_number() OVER (PARTITION BY k ORDER BY doc_id, i) AS r FROM w),
d AS (
  SELECT DISTINCT doc_id, p FROM (SELECT doc_id, unnest(range(i, i + {RUN_LINES})) AS p FROM f WHERE r > 1)),
a AS (
  SELECT doc_id, list(p ORDER BY p) AS ps FROM d GROUP BY doc_id),
o AS (
  SELECT l.doc_id, CASE WHEN ps IS NULL THEN t ELSE array_to_string(list_filter(ls, lambda x, i: NOT list_contains(ps, i)), chr(10)) END AS kept,
    coalesce(len(ps), 0) AS n FROM l LEFT JOIN a ON a.doc_id = l.doc_id)
SELECT doc_id, n::BIGINT AS n_deleted, length(kept)::BIGINT AS kept_chars, sha256(kept) AS kept_sha256 FROM o
"""
