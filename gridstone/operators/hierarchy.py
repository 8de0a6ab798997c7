"""Tables that mix the levels of a hierarchy: which level a group reports at is found by reconciling against independent totals."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

KEYS = ["country_code", "profession_code"]


def annotate(regional: DataFrame, index: DataFrame) -> DataFrame:
    """regional with region_level, region_name and country_code; a code that isn't in the index keeps a NULL level."""
    return regional.join(index, "region_code", "left").withColumn("country_code", F.coalesce("country_code", F.substring("region_code", 1, 2)))


def detect_level(annotated: DataFrame, national: DataFrame, tolerance: float = 0.05, published: bool = False) -> DataFrame:
    """For every group with a national total: the level whose sum is nearest to it, if within tolerance, the lowest on a tie; else NULL.

    A group that doesn't reconcile keeps the nearest level's total, number of regions and difference, so that one can see by how much it failed; only
    reporting_level is NULL. ``published`` blanks them as well, as the published tables do: total and difference NULL, no regions."""
    sums = annotated.where("unit = 'NR' and region_level >= 1").groupBy(*KEYS, "region_level").agg(F.sum("value").alias("regional_total"), F.countDistinct("region_code").alias("n_regions"))
    known = national.where("national_total > 0")
    tried = sums.where("n_regions >= 2 and regional_total > 0").join(known, KEYS).withColumn("rel_diff", F.abs(F.col("regional_total") - F.col("national_total")) / F.col("national_total"))
    best = tried.withColumn("r", F.row_number().over(Window.partitionBy(*KEYS).orderBy("rel_diff", "region_level"))).where("r = 1").drop("r")
    within = F.col("rel_diff") <= tolerance
    # countries without any usable level stay, flagged
    have = annotated.where("unit = 'NR' and region_level >= 1").select(*KEYS).distinct()
    only = (lambda c, rest=None: F.when(within, F.col(c)).otherwise(rest)) if published else (lambda c, rest=None: F.col(c))
    return (
        have.join(known, KEYS)
        .join(best.drop("national_total"), KEYS, "left")
        .select(
            *KEYS, "national_total", F.when(within, F.col("region_level")).alias("reporting_level"), only("regional_total").alias("regional_total"), only("n_regions", 0).alias("n_regions"),
            F.round(only("rel_diff"), 5).alias("rel_diff"), F.coalesce(within, F.lit(False)).alias("reconciles"),
        )
    )


def reconciliation_rate(report: DataFrame, *groups: str, worst: int = 5) -> DataFrame:
    """Of each group of a reconciliation report: how many totals it compares, the share within tolerance, and the ``worst`` countries and years."""
    rows = report.withColumn("r", F.row_number().over(Window.partitionBy(*groups).orderBy(F.desc("rel_diff"), "country_code", "year")))
    worst_of = F.array_sort(F.collect_list(F.when(F.col("r") <= worst, F.struct("r", F.concat_ws(" ", "country_code", "year").alias("x")))))
    return rows.groupBy(*groups).agg(F.count(F.lit(1)).alias("n"), F.avg(F.col("within").cast("double")).alias("share_within"), F.array_join(F.transform(worst_of, lambda e: e["x"]), ", ").alias("worst"))


def at_reporting_level(annotated: DataFrame, levels: DataFrame) -> DataFrame:
    """Rows at their group's own level; levels are joined by country and profession, so a group never fans out."""
    found = levels.where("reporting_level is not null").select(*KEYS, "reporting_level")
    rows = annotated.where("unit = 'NR'").join(found, KEYS).where("region_level = reporting_level")
    return rows.groupBy("region_code", "region_level", *KEYS, "year").agg(F.sum("value").alias("measure_value"))


def reconciliation(fact: DataFrame, national: DataFrame, tolerance: float = 0.05) -> DataFrame:
    sums = fact.groupBy(*KEYS, "year").agg(F.sum("measure_value").alias("regional_total"))
    diff = F.abs(F.col("regional_total") - F.col("national_total")) / F.col("national_total")
    return sums.join(national.where("national_total > 0"), [*KEYS, "year"]).withColumn("rel_diff", diff).withColumn("within", F.col("rel_diff") <= tolerance)


def keep_reconciling(fact: DataFrame, national: DataFrame, tolerance: float = 0.05) -> DataFrame:
    return fact.join(reconciliation(fact, national, tolerance).where("within").select(*KEYS, "year"), [*KEYS, "year"], "left_semi")


def double_count(annotated: DataFrame, national: DataFrame) -> DataFrame:
    """What adding all levels up would give, as a share of the national total."""
    sums = annotated.where("unit = 'NR'").groupBy(*KEYS).agg(F.sum("value").alias("all_levels"))
    return sums.join(national, KEYS).select(*KEYS, "all_levels", "national_total", (F.col("all_levels") / F.col("national_total")).alias("share"))
