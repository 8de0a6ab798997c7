"""Serving extracts: small, bounded tables cut from the views for a report. Ties are broken by the entity, so a cut is the same each time."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import ratio
from . import ranks


def without_nan(df: DataFrame) -> DataFrame:
    """df with NULL for every NaN and infinity, which JSON can't hold."""
    odd = lambda c: F.isnan(c) | (F.abs(c) == float("inf"))
    return df.select(*[F.when(~odd(F.col(c)), F.col(c)).alias(c) if kind in ("double", "float") else c for c, kind in df.dtypes])


def rounded(df: DataFrame, **digits: int) -> DataFrame:
    return df.select(*[F.round(c, digits[c]).alias(c) if c in digits else c for c in df.columns])


def anchor_year(df: DataFrame, value: str, at_least: int) -> DataFrame:
    """One row: the newest year in which at_least rows have a value; else the newest of all."""
    per = df.groupBy("year").agg(F.count(value).alias("n"))
    return per.agg(F.coalesce(F.max(F.when(F.col("n") >= at_least, F.col("year"))), F.max("year")).alias("year"))


def at(df: DataFrame, year: DataFrame) -> DataFrame:
    return df.join(F.broadcast(year), "year", "left_semi")


def kpi_row(year: DataFrame, **parts: DataFrame) -> DataFrame:
    """year and one column for each part, a table with year and value."""
    out = year
    for name, part in parts.items():
        out = out.join(part.select("year", F.col("value").alias(name)), "year", "left")
    return out


def top(df: DataFrame, by: Column, entity: str, n: int) -> DataFrame:
    """The n rows with the largest ``by`` and their rank; NULLs never."""
    best = df.where(by.isNotNull()).orderBy(by.desc(), entity).limit(n)
    return best.withColumn("rank", F.row_number().over(Window.orderBy(by.desc(), entity)))


def ranked(df: DataFrame, by: Column, entity: str) -> DataFrame:
    """All rows with their rank by a value, the largest first."""
    return ranks.positions(df.where(by.isNotNull()).withColumn("by_", by), [ranks.By("by_", True), entity], row_number="rank").drop("by_")


def most_complete(pyramid: DataFrame, at_least: int = 5) -> DataFrame:
    """One row: the country with the most cells (sex and band) of at_least years."""
    cells = pyramid.groupBy("country_code", "sex_code", "age_group_code").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= at_least)
    return cells.groupBy("country_code").agg(F.count(F.lit(1)).alias("cells")).orderBy(F.desc("cells"), "country_code").limit(1)


def pyramid_of(pyramid: DataFrame, country: DataFrame) -> DataFrame:
    """Its headcounts by band and sex over all years, without any total."""
    return pyramid.join(F.broadcast(country.select("country_code")), "country_code", "left_semi").groupBy("country_code", "profession_code", "age_group_code", "sex_code").agg(F.sum("workers").alias("workers"))


def latest_of_each(regional: DataFrame, entity: str = "region_code") -> DataFrame:
    """Each entity's rows of its own latest year."""
    return regional.withColumn("last_", F.max("year").over(Window.partitionBy(entity))).where("year = last_").drop("last_")


def horizons(forecasts: DataFrame, *years: int) -> DataFrame:
    return forecasts.where(F.col("year").isin(*years))


def series_of(df: DataFrame, country: str) -> DataFrame:
    return df.where(F.col("country_code") == country)


def female_share(composition: DataFrame) -> DataFrame:
    """Women among women and men, where there are any."""
    return composition.where("female + male > 0").select("country_code", "profession_code", "year", ratio(F.col("female"), F.col("female") + F.col("male"), 100).alias("pct_female"))


def quality_block(**numbers: DataFrame) -> DataFrame:
    """name and value: one row for each one-column, one-row table."""
    return reduce(DataFrame.unionByName, [df.select(F.lit(n).alias("name"), F.col(df.columns[0]).cast("double").alias("value")) for n, df in numbers.items()])
