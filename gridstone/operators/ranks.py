"""Exact positions in a whole table's order, without one task that sees all of it.

Rows are dealt by range of the order's columns and written once; each range's number of rows (one small row for a range) gives the ranges after it their offsets;
positions within a range come from a window over the range alone. NULLs come last, also where the order falls.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.storage import checkpointed


@dataclass(frozen=True)
class By:
    """A column of an order, rising or falling."""

    column: str
    falling: bool = False

    @property
    def key(self) -> Column:
        return F.col(self.column).desc_nulls_last() if self.falling else F.col(self.column).asc_nulls_last()


def in_ranges(df: DataFrame, order: list[By], weight: Column) -> tuple[DataFrame, int]:
    """df dealt by ranges of the order, with before_ (the weights of all ranges before) and values_ (their rows); and the weight of all."""
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranges = checkpointed(df.repartitionByRange(n, *[b.key for b in order]).withColumns({"range_": F.spark_partition_id(), "weight_": weight.cast("long")}))
    sizes = ranges.groupBy("range_").agg(F.sum("weight_").alias("weight"), F.count(F.lit(1)).alias("rows"))
    before, weights, rows = [], 0, 0
    for r in sorted(sizes.collect()):  # a row for each range, of which there are as many as shuffle partitions at most
        before.append((r.range_, weights, rows))
        weights, rows = weights + r.weight, rows + r.rows
    offsets = df.sparkSession.createDataFrame(before, "range_ int, before_ long, values_ long")
    return ranges.join(F.broadcast(offsets), "range_"), weights


def orders(order: list[str | By]) -> list[By]:
    return [By(o) if isinstance(o, str) else o for o in order]


def positions(df: DataFrame, order: list[str | By], row_number: str, total: str | None = None) -> DataFrame:
    """df with each row's place in the order, and total, the number of all rows. Rows equal in the order share a task, so it should end with columns that tell rows apart."""
    by = orders(order)
    placed, rows = in_ranges(df, by, F.lit(1))
    at = F.row_number().over(Window.partitionBy("range_").orderBy(*[b.key for b in by])) + F.col("before_")
    return placed.select(*df.columns, at.alias(row_number), *([F.lit(rows).cast("long").alias(total)] if total else []))


def value_ranks(df: DataFrame, order: list[str | By], rank: str, dense_rank: str | None = None) -> DataFrame:
    """df with the rank of its values. Values are counted first and ranked without their rows, so a value of very many rows is one row here."""
    by = orders(order)
    columns = [b.column for b in by]
    placed, _ = in_ranges(df.groupBy(*columns).agg(F.count(F.lit(1)).alias("n_")), by, F.col("n_"))
    w = Window.partitionBy("range_").orderBy(*[b.key for b in by])
    above = F.coalesce(F.sum("n_").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    found = {rank: above + F.col("before_") + 1, dense_rank: F.row_number().over(w) + F.col("values_")}
    ranked = placed.select(*[F.col(c).alias(f"{c}_") for c in columns], *[c.alias(n) for n, c in found.items() if n])
    same = [F.col(c).eqNullSafe(F.col(f"{c}_")) for c in columns]
    return df.join(ranked, same).drop(*[f"{c}_" for c in columns])


def ntile(df: DataFrame, order: list[str | By], tiles: int, name: str) -> DataFrame:
    """df with the number of its tile: tiles as equal as can be, the larger ones first."""
    placed = positions(df, order, row_number="at_", total="all_")
    each, more = F.floor(F.col("all_") / tiles), F.col("all_") % tiles
    large = more * (each + 1)
    tile = F.when(F.col("at_") <= large, F.floor((F.col("at_") - 1) / (each + 1)) + 1).otherwise(more + F.floor((F.col("at_") - large - 1) / F.nullif(each, F.lit(0))) + 1)
    return placed.withColumn(name, tile.cast("int")).drop("at_", "all_")


def sketch_tile(df: DataFrame, value: str, tiles: int, name: str, accuracy: int = 10_000) -> DataFrame:
    """The tile by bounds from a mergeable quantile sketch, whose ranks are off by 1 / accuracy of all rows at most: one narrow pass and no shuffle of rows."""
    bounds = df.agg(F.percentile_approx(value, [i / tiles for i in range(1, tiles)], accuracy).alias("bounds_"))
    above = F.size(F.filter("bounds_", lambda b: F.col(value) > b))
    return df.crossJoin(F.broadcast(bounds)).withColumn(name, F.when(F.col(value).isNotNull(), above + 1).cast("int")).drop("bounds_")


def stable_keys(codes: DataFrame, code: str, name: str, known: DataFrame | None = None, start: int = 1) -> DataFrame:
    """code and its key for every code of ``known`` (an earlier result) and of codes. Known codes keep their keys; unseen ones get the following ones, in their order."""
    seen = codes.select(code).where(F.col(code).isNotNull()).distinct()
    if known is None:
        return positions(seen, [code], row_number="n_").select(code, (F.col("n_") + start - 1).alias(name))
    last = known.agg(F.coalesce(F.max(name), F.lit(start - 1)).alias("last_"))
    unseen = positions(seen.join(known.select(code), code, "left_anti"), [code], row_number="n_")
    return known.select(code, name).unionByName(unseen.crossJoin(F.broadcast(last)).select(code, (F.col("n_") + F.col("last_")).alias(name)))
