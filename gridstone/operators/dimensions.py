"""Dimensions from short code lists, and the joins that bring their labels to facts and views."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .grain import surrogate_keys


def coded(spark: SparkSession, name: str, schema: str, rows: list[tuple]) -> DataFrame:
    """A dimension from a code list: its columns behind a dense key ``<name>_key`` in the order of the first one."""
    df = spark.createDataFrame(rows, schema)
    return surrogate_keys(df, df.columns[0], f"{name}_key").select(f"{name}_key", *df.columns)


def age_groups(spark: SparkSession, bands: list[tuple[str, str, int, int | None]], retirement: tuple[str, ...]) -> DataFrame:
    """bands: (code, label, min_age, max_age), youngest first; sort_order counts from 0."""
    rows = [(code, label, low, high, i, code in retirement) for i, (code, label, low, high) in enumerate(bands)]
    return coded(spark, "age", "age_group_code string, age_group_label string, min_age int, max_age int, sort_order int, is_retirement_age boolean", rows)


def genders(spark: SparkSession, labels: dict[str, str], total: str = "T") -> DataFrame:
    return coded(spark, "gender", "sex_code string, sex_label string, is_total boolean", [(c, label, c == total) for c, label in labels.items()])


def professions(spark: SparkSession, names: dict[str, tuple[str, str]], ladders: DataFrame) -> DataFrame:
    """names: code to (name, ladder); ladders (ladder, code_): the source codes that each ladder reads, listed in order."""
    codes = ladders.groupBy("ladder").agg(F.array_join(F.array_sort(F.collect_set("code_")), ",").alias("source_age_codes"))
    rows = spark.createDataFrame([(c, n, ladder) for c, (n, ladder) in names.items()], "profession_code string, profession_name string, ladder string")
    return surrogate_keys(rows.join(codes, "ladder", "left").drop("ladder"), "profession_code", "profession_key").select("profession_key", "profession_code", "profession_name", "source_age_codes")


def specializations(spark: SparkSession, names: dict[str, str]) -> DataFrame:
    return coded(spark, "specialization", "spec_code string, spec_name string", sorted(names.items()))


def sectors(spark: SparkSession, names: list[str]) -> DataFrame:
    return coded(spark, "sector", "sector_code string, sector_name string", [(f"S{i}", n) for i, n in enumerate(names, 1)])


def labelled(fact: DataFrame, dim: DataFrame, key: str, *columns: str, keep_unknown: bool = False) -> DataFrame:
    """fact with columns of a dimension. Rows of unknown members go, or stay with the code in place of the first label."""
    short = dim.select(key, *columns)
    if not keep_unknown:
        return fact.join(F.broadcast(short), key)
    return fact.join(F.broadcast(short), key, "left").withColumn(columns[0], F.coalesce(columns[0], key))
