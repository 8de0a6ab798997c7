"""Chat formatting with a grammar round trip, with DataFrame functions only.

A conversation becomes one string of turns: ``[INST]text[/INST]`` for a user, ``<s>text</s>`` for an assistant,
``[SYS]text[/SYS]`` for a system turn and ``[ROLE]role[/ROLE]text[/END]`` for any other role. The grammar is regular, so one
pattern is a deterministic parser of it. Rendered text is parsed again and compared with the source; where they differ, its
conflicting content is escaped (a backslash more after the first character of a control string) until they are identical. The parser
takes one backslash away again, so every text comes back.

Nulls: a null text or role counts as empty; rows with a null conv_id make up one conversation of their own. Turns are in the order of
(turn, role, text), nulls first; repeated rows are turns like any other. An empty table gives an empty result; further columns
are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table
from .quality_rules import let

MARKS = {"user": ("[INST]", "[/INST]"), "assistant": ("<s>", "</s>"), "system": ("[SYS]", "[/SYS]")}
TURN = r"(?s)\[INST\](.*?)\[/INST\]|<s>(.*?)</s>|\[SYS\](.*?)\[/SYS\]|\[ROLE\](.*?)\[/ROLE\](.*?)\[/END\]"
NAMES = r"(?:/?(?:INST|SYS|ROLE|END)\]|/?s>)"


def escaped(text: Column) -> Column:
    return F.regexp_replace(text, r"([\[<]\\*)(?=" + NAMES + ")", "$1\\\\")


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"([\[<]\\*)\\(?=" + NAMES + ")", "$1")


def rendered(turns: Column, escape: bool) -> Column:
    put = escaped if escape else (lambda x: x)

    def one(t: Column) -> Column:
        body = put(t["text"])
        out = F.concat(F.lit("[ROLE]"), put(t["role"]), F.lit("[/ROLE]"), body, F.lit("[/END]"))
        for role, (a, b) in MARKS.items():
            out = F.when(t["role"] == role, F.concat(F.lit(a), body, F.lit(b))).otherwise(out)
        return out

    return F.array_join(F.transform(turns, one), "")


def parsed(formatted: Column) -> Column:
    """The turns (role, text) of a rendered conversation."""

    def one(x: Column) -> Column:
        body = lambda a, b: F.substring(x, F.lit(len(a) + 1), F.length(x) - (len(a) + len(b)))
        named = F.split(x, r"\[/ROLE\]", 2)
        role, text = F.substring(named[0], F.lit(len("[ROLE]") + 1), F.length(named[0])), F.substring(named[1], F.lit(1), F.length(named[1]) - len("[/END]"))
        out = F.struct(unescaped(role).alias("role"), unescaped(text).alias("text"))
        for name, (a, b) in MARKS.items():
            out = F.when(x.startswith(a), F.struct(F.lit(name).alias("role"), unescaped(body(a, b)).alias("text"))).otherwise(out)
        return out

    return F.transform(F.regexp_extract_all(formatted, F.lit(TURN), F.lit(0)), one)


def format_conversations(conversations: DataFrame) -> DataFrame:
    """conv_id, formatted, escaped_ (whether escaping was needed) and round_trip (whether the parser gives the source back)."""
    turn = F.struct("turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    source = F.transform(F.array_sort(F.collect_list(turn)), lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text")))
    tried = conversations.groupBy("conv_id").agg(source.alias("source")).withColumn("plain", rendered(F.col("source"), False))
    clean = tried.withColumn("clean", parsed(F.col("plain")) == F.col("source"))
    out = clean.withColumn("formatted", F.when(F.col("clean"), F.col("plain")).otherwise(rendered(F.col("source"), True)))
    return out.select("conv_id", "formatted", (~F.col("clean")).alias("escaped_"), F.when(F.col("clean"), True).otherwise(parsed(F.col("formatted")) == F.col("source")).alias("round_trip"))


def read_back(formatted: DataFrame) -> DataFrame:
    """What the parser and the loss mask (the assistants' texts) find in formatted."""
    loss = let(F.col("turns"), lambda t: F.array_join(F.transform(F.filter(t, lambda x: x["role"] == "assistant"), lambda x: x["text"]), ""))
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return formatted.withColumn("turns", parsed(F.col("formatted"))).withColumn("loss", loss).select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(said.cast("binary"), 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2(F.col("loss").cast("binary"), 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
        "round_trip",
        "escaped_",
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = "</s>[INST] ok [/INST]"
    extra = spark.range(2).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(said).alias("text"))
    return read_back(format_conversations(found.unionByName(extra))).drop("escaped_")


ORACLE = r"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
g AS (
  SELECT *, bool_or(regexp_matches(role || text, '[\[<]\\*(/?(INST|SYS|ROLE|END)\]|/?s>)')) OVER (PARTITION BY conv_id) AS bad FROM c),
e AS (
  SELECT *, length(CASE WHEN bad THEN regexp_replace(text, '([\[<]\\*)(/?(INST|SYS|ROLE|END)\]|/?s>)', '\1\\\2', 'g') ELSE text END) AS n,
    CASE role WHEN 'user' THEN 13 WHEN 'assistant' THEN 7 WHEN 'system' THEN 11
      ELSE 19 + length(CASE WHEN bad THEN regexp_replace(role, '([\[<]\\*)(/?(INST|SYS|ROLE|END)\]|/?s>)', '\1\\\2', 'g') ELSE role END) END AS m
  FROM g)
SELECT conv_id, count(*)::BIGINT AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
  sum(n + m)::BIGINT AS formatted_chars, true AS round_trip
FROM e GROUP BY conv_id
"""
