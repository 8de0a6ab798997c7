"""Integrity of a star from its declared relations and grains, with one pass over each fact.

Columns are bound first: a relation or grain over a column that isn't there is a result of its own and isn't run. Each check of a fact is a grouping set over the key's own columns, so that
one pass over the fact counts the keys of all its checks, with partial sums: a key of very many rows is a few rows when it is shuffled. A grain's keys end there but for repeated ones. Those of
relations are then grouped with the dimensions' keys, which are rows that count as none and are known; keys of integers stay numbers, others are met as text. Each dimension is read once too, and
nothing is broadcast, however large a dimension is. A task's partial sums of all checks are one hash table; where nearly every row is a new key of several checks, that table passes the memory
and is sorted and spilled. Facts in column files with such keys are better named in ``apart``: each check then reads its own columns only.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

INTEGERS = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


@dataclass(frozen=True)
class Relation:
    """Many rows of a fact to one of a dimension. Inactive ones are declared but not filtered by; they are checked all the same."""

    fact: str
    key: str
    dimension: str
    dimension_key: str
    active: bool = True

    @property
    def name(self) -> str:
        return f"{self.fact}.{self.key} -> {self.dimension}.{self.dimension_key}"


@dataclass(frozen=True)
class Grain:
    fact: str
    keys: tuple[str, ...]

    @property
    def name(self) -> str:
        return f"{self.fact} by {', '.join(self.keys)}"


def unbound(tables: dict[str, DataFrame], check: Relation | Grain) -> str | None:
    """What a check names that isn't there."""
    wanted = [(check.fact, k) for k in check.keys] if isinstance(check, Grain) else [(check.fact, check.key), (check.dimension, check.dimension_key)]
    gone = [t if t not in tables else f"{t}.{c}" for t, c in wanted if t not in tables or c not in tables[t].columns]
    return ", ".join(dict.fromkeys(gone)) or None


def columns_of(check: Relation | Grain) -> list[str]:
    return list(check.keys) if isinstance(check, Grain) else [check.key]


def numeric(tables: dict[str, DataFrame], check: Relation) -> bool:
    """Whether the key is of integers on both sides, which are equal exactly if their texts are."""
    return all(isinstance(tables[t].schema[c].dataType, INTEGERS) for t, c in ((check.fact, check.key), (check.dimension, check.dimension_key)))


def chosen(by: Column, values: dict[int, Column], kind: str) -> Column:
    """The value for this row's number, or NULL."""
    out = F.lit(None).cast(kind)
    for i, value in values.items():
        out = F.when(by == i, value).otherwise(out)
    return out


def counted(fact: DataFrame, checks: dict[int, Relation | Grain], numbers: set[int]) -> DataFrame:
    """check (its number), number or text (the key of a relation; of a grain the repeated keys' JSON, in which NULLs are no texts), n and known (false), from one pass."""
    names, sets = [], {}  # of the columns' copies, and of those of each check; two checks with the same columns need sets of their own
    for i, c in checks.items():
        own = list(dict.fromkeys(columns_of(c)))
        if any(set(own) == set(x) for x in sets.values()):
            own[0] = (own[0], i)
        names += [x for x in own if x not in names]
        sets[i] = own
    at = {x: f"c{j}" for j, x in enumerate(names)}
    rows, n = fact.select(*[F.col(x[0] if isinstance(x, tuple) else x).alias(a) for x, a in at.items()]), F.count(F.lit(1)).alias("n")
    if len(checks) == 1:
        counts = rows.groupBy(*at.values()).agg(n).withColumn("check", F.lit(next(iter(checks))))
    else:
        counts = rows.groupingSets([[at[x] for x in own] for own in sets.values()], *at.values()).agg(n, F.grouping_id().alias("set"))
        set_of = {i: sum(1 << (len(names) - 1 - j) for j, x in enumerate(names) if x not in own) for i, own in sets.items()}
        counts = counts.withColumn("check", chosen(F.col("set"), {set_of[i]: F.lit(i) for i in checks}, "int"))
    number, text = {}, {}
    for i, c in checks.items():
        key = [F.col(at[x]) for x in sets[i]]
        if isinstance(c, Grain):
            text[i] = F.when(F.col("n") > 1, F.to_json(F.struct(*[k.alias(x[0] if isinstance(x, tuple) else x) for k, x in zip(key, sets[i], strict=True)]), {"ignoreNullFields": "false"}))
        elif i in numbers:
            number[i] = key[0].cast("long")
        else:
            text[i] = key[0].cast("string")
    return counts.select("check", chosen(F.col("check"), number, "long").alias("number"), chosen(F.col("check"), text, "string").alias("text"), "n", F.lit(False).alias("known"))


def keys_of(table: DataFrame, columns: dict[int, str], numbers: set[int], known: bool) -> DataFrame:
    """The keys in columns (by check) of a fact or a dimension, uncounted, as rows like those of ``counted``."""
    rows = []
    for i, column in columns.items():
        number, text = (F.col(column), F.lit(None)) if i in numbers else (F.lit(None), F.col(column))
        rows.append([F.lit(i).alias("check"), number.cast("long").alias("number"), text.cast("string").alias("text")])
    keys = table.select(*rows[0]) if len(rows) == 1 else table.select(F.inline(F.array(*[F.struct(*r) for r in rows])))
    return keys.select("*", F.lit(int(not known)).cast("long").alias("n"), F.lit(known).alias("known"))


def integrity(tables: dict[str, DataFrame], checks: Iterable[Relation | Grain], apart: Iterable[str] = ()) -> DataFrame:
    """check, kind (relation or grain), status (OK, FAIL or UNBOUND), rows of the fact, bad (orphan rows, or keys with several rows) and detail (an example)."""
    checks, spark = list(checks), next(iter(tables.values())).sparkSession
    faults = [unbound(tables, c) for c in checks]
    declared = spark.createDataFrame([(i, c.name, "grain" if isinstance(c, Grain) else "relation", faults[i]) for i, c in enumerate(checks)], "id int, check string, kind string, missing string")
    bound = {i: c for i, c in enumerate(checks) if faults[i] is None}
    if bound:
        numbers = {i for i, c in bound.items() if isinstance(c, Relation) and numeric(tables, c)}
        grains = [i for i, c in bound.items() if isinstance(c, Grain)]
        apart, parts, dimensions = set(apart), [], {}
        for fact in dict.fromkeys(c.fact for c in bound.values()):
            mine = {i: c for i, c in bound.items() if c.fact == fact}
            if fact not in apart:
                parts.append(counted(tables[fact], mine, numbers))
                continue
            parts += [counted(tables[fact], {i: c}, numbers) if i in grains else keys_of(tables[fact], {i: c.key}, numbers, False) for i, c in mine.items()]
        for i, c in bound.items():
            if i not in grains:
                dimensions.setdefault(c.dimension, {})[i] = c.dimension_key
        parts += [keys_of(tables[d], columns, numbers, True) for d, columns in dimensions.items()]
        counts = reduce(DataFrame.unionByName, parts).groupBy("check", "number", "text").agg(F.sum("n").alias("n"), F.max("known").alias("known"))
        repeated = F.col("text").isNotNull().cast("long")
        orphans = F.when(~F.col("known") & (F.col("number").isNotNull() | F.col("text").isNotNull()), F.col("n")).otherwise(0)
        counts = counts.withColumn("bad", F.when(F.col("check").isin(*grains), repeated).otherwise(orphans))
        example = F.min(F.when(F.col("bad") > 0, F.coalesce("text", F.col("number").cast("string"))))
        found = counts.groupBy(F.col("check").alias("id")).agg(F.sum("n").alias("rows"), F.sum("bad").alias("bad"), example.alias("example"))
        declared = declared.join(found, "id", "left")
    else:
        declared = declared.withColumns({"rows": F.lit(None).cast("long"), "bad": F.lit(None).cast("long"), "example": F.lit(None).cast("string")})
    count = lambda c: F.when(F.col("missing").isNull(), F.coalesce(c, F.lit(0))).alias(c)
    status = F.when(F.col("missing").isNotNull(), "UNBOUND").when(F.coalesce("bad", F.lit(0)) > 0, "FAIL").otherwise("OK")
    return declared.select("check", "kind", status.alias("status"), count("rows"), count("bad"), F.coalesce(F.concat(F.lit("no "), "missing"), "example").alias("detail"))
