"""Facts at a declared grain, codes on shared ladders, and the checks that both hold."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def to_grain(df: DataFrame, keys: list[str], measure: str | None = None, constants: tuple[str, ...] = ()) -> DataFrame:
    """df summed to keys (NULL keys kept). Columns that mustn't be summed (constants) keep their smallest value. Without a measure, distinct keys."""
    present = [k for k in keys if k in df.columns]
    if measure is None:
        return df.select(*present).distinct()
    out = df.groupBy(*present).agg(F.sum(measure).alias(measure), *[F.min(c).alias(c) for c in constants])
    return out.withColumn("measure_value", F.col(measure))


def duplicates(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys with more than one row, and how many."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def orphans(fact: DataFrame, fact_key: str, dim: DataFrame, dim_key: str) -> DataFrame:
    """Rows of fact whose key isn't in dim; a NULL key refers to nothing and is no orphan."""
    return fact.where(F.col(fact_key).isNotNull()).join(dim.select(F.col(dim_key).alias(fact_key)).distinct(), fact_key, "left_anti")


def integrity(edges: list[tuple[str, DataFrame, str, DataFrame, str]]) -> DataFrame:
    """edge, fact_rows and orphan_rows of each (name, fact, key, dim, key)."""
    out = None
    for name, fact, fact_key, dim, dim_key in edges:
        marked = fact.select(F.col(fact_key).alias("k")).join(dim.select(F.col(dim_key).alias("k")).distinct().withColumn("hit", F.lit(True)), "k", "left")
        row = marked.agg(F.count(F.lit(1)).alias("fact_rows"), F.count_if(F.col("k").isNotNull() & F.col("hit").isNull()).alias("orphan_rows")).select(F.lit(name).alias("edge"), "fact_rows", "orphan_rows")
        out = row if out is None else out.unionByName(row)
    return out


def conform(df: DataFrame, code: Column, mapping: DataFrame, name: str) -> DataFrame:
    """df with its code on the shared ladder of mapping (code_, band_); unknown codes get NULL. mapping is a short code list."""
    return df.withColumn("code_", code).join(F.broadcast(mapping), "code_", "left").withColumnRenamed("band_", name).drop("code_")


def surrogate_keys(df: DataFrame, order: str, name: str, start: int = 1) -> DataFrame:
    """Dense keys in the order of a column, for literal code lists; ``ranks.positions`` and ``ranks.stable_keys`` are for dimensions that grow."""
    from pyspark.sql import Window

    return df.withColumn(name, F.row_number().over(Window.orderBy(F.col(order).asc_nulls_last())) + F.lit(start - 1))
