"""Datasets of landed cube files: what is expected of each, loading, and reports on what came in. Fetching is left to the landing job."""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .cubes import read_cubes


@dataclass(frozen=True)
class Dataset:
    """code: the published dataset; dims: its dimensions; since: the first period that counts; tags: constant columns; where: a condition on its rows."""

    code: str
    label: str
    dims: tuple[str, ...]
    since: str | None = None
    tags: tuple[tuple[str, str], ...] = ()
    where: str | None = None


class Registry:
    """Datasets by name. Codes that are known not to exist can't be registered."""

    def __init__(self, missing: tuple[str, ...] = ()):
        self.missing, self.known = missing, {}

    def add(self, name: str, dataset: Dataset) -> Registry:
        if dataset.code in self.missing:
            raise ValueError(f"{dataset.code} is not a published dataset")
        self.known[name] = dataset
        return self

    def load(self, spark: SparkSession, name: str, path: str, geos: list[str] | None = None) -> DataFrame:
        d = self.known[name]
        return of_interest(read_cubes(spark, path, list(d.dims), d.code, d.label), d, geos)


def of_interest(rows: DataFrame, dataset: Dataset, geos: list[str] | None = None) -> DataFrame:
    """rows of the wanted entities and periods that satisfy the dataset's condition, with its tags. Without geos, the whole table."""
    if geos is not None:
        rows = rows.where(F.col("geo").isin(*geos))
    if dataset.since is not None:
        rows = rows.where(F.col("time") >= dataset.since)
    if dataset.where is not None:
        rows = rows.where(dataset.where)
    return rows.withColumns({k: F.lit(v) for k, v in dataset.tags}) if dataset.tags else rows


def together(*parts: DataFrame) -> DataFrame:
    """The rows of several datasets; a dimension that one lacks is NULL there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def last_periods(rows: DataFrame, n: int, entity: str = "geo") -> DataFrame:
    """The rows of each entity's last n periods."""
    w = Window.partitionBy(entity).orderBy(F.col("time").desc())
    return rows.withColumn("r_", F.dense_rank().over(w)).where(F.col("r_") <= n).drop("r_")


def run_report(spark: SparkSession, wanted: list[str], rows: DataFrame, failed: dict[str, str] | None = None) -> DataFrame:
    """dataset_code, rows and status (OK, EMPTY or FAIL) of every wanted dataset."""
    asked = spark.createDataFrame([(c, (failed or {}).get(c)) for c in wanted], "dataset_code string, error string")
    counts = rows.groupBy("dataset_code").agg(F.count(F.lit(1)).alias("rows"))
    status = F.when(F.col("error").isNotNull(), "FAIL").when(F.col("rows") > 0, "OK").otherwise("EMPTY")
    return asked.join(counts, "dataset_code", "left").select("dataset_code", F.coalesce("rows", F.lit(0)).alias("rows"), status.alias("status"), "error")


def exists(spark: SparkSession, path: str) -> bool:
    found = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return found.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(found)


def hierarchy_index(spark: SparkSession, path: str) -> DataFrame:
    """region_code, region_level, region_name and country_code from lines of JSON; without the file, no rows."""
    schema = "region_code string, region_level int, region_name string, country_code string"
    return spark.read.schema(schema).json(path) if exists(spark, path) else spark.createDataFrame([], schema)


def read_forecasts(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.csv(path, header=True, schema="country_code string, profession_code string, year int, forecast double, baseline_forecast double")


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").csv(path, header=True)


def write_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def export_tables(tables: dict[str, DataFrame], folder: str) -> DataFrame:
    """Each table under folder as Parquet; the manifest has the rows that were written, or the error of a table that couldn't be."""
    spark, manifest = next(iter(tables.values())).sparkSession, []
    for name, df in tables.items():
        try:
            df.write.mode("overwrite").parquet(f"{folder}/{name}")
            manifest.append((name, spark.read.parquet(f"{folder}/{name}").count(), None))
        except Exception as e:  # the others are still exported, and the manifest says what failed
            manifest.append((name, None, f"{type(e).__name__}: {str(e)[:200]}"))
    return spark.createDataFrame(manifest, "table string, rows long, error string")


def relations_of(spark: SparkSession, sql: str) -> set[str]:
    """The names a query reads, subqueries and common table expressions included, from its parsed plan before any of them is looked up."""
    plan = spark._jsparkSession.sessionState().sqlParser().parsePlan(sql).toString()
    return {name.replace(", ", ".") for name in re.findall(r"'UnresolvedRelation \[([^\]]+)\]", plan)}


def view_order(spark: SparkSession, views: dict[str, str | Callable[[SparkSession], DataFrame]]) -> list[str]:
    """Names of views, each after those its SQL reads. A function says nothing of what it reads and has to stand after that itself."""
    needs = {name: sorted(relations_of(spark, v) & (views.keys() - {name})) if isinstance(v, str) else [] for name, v in views.items()}
    needs |= {name: [name] for name, v in views.items() if isinstance(v, str) and name in relations_of(spark, v)}
    order: list[str] = []

    def visit(name: str, path: tuple[str, ...]) -> None:
        if name in path:
            raise ValueError("views that need each other: " + " -> ".join([*path[path.index(name) :], name]))
        if name not in order:
            for other in needs[name]:
                visit(other, (*path, name))
            order.append(name)

    for name in views:
        visit(name, ())
    return order


def build_views(spark: SparkSession, views: dict[str, str | Callable[[SparkSession], DataFrame]]) -> list[str]:
    """Registers views, given as SQL or functions in any order, each after those its SQL reads; every one is analysed, and all that fail are named at the end."""
    done, failed = [], []
    for name in view_order(spark, views):
        try:
            build = views[name]
            (spark.sql(build) if isinstance(build, str) else build(spark)).createOrReplaceTempView(name)
            done.append(name)
        except Exception as e:  # all failures are raised together below
            failed.append(f"{name}: {type(e).__name__}: {str(e)[:200]}")
    if failed:
        raise ValueError("; ".join(failed))
    return done
