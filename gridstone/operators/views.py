"""Semantic views over the facts. Every ratio is computed from totals, and nothing unreported becomes 0."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import ratio, sum_if, tier
from . import ranks

TOTALS = "measure = 'headcount_total' and sex_code = 'T'"
BANDS = "measure = 'headcount_by_age' and sex_code = 'T'"


def coverage_index(workers: DataFrame, people: DataFrame, first: str, second: str) -> DataFrame:
    a = workers.where(TOTALS).groupBy("country_code", "year").agg(sum_if(F.col("profession_code") == first, F.col("workers")).alias("first"), sum_if(F.col("profession_code") == second, F.col("workers")).alias("second"))
    p = people.where("sex_code = 'T' and population > 0").groupBy("country_code", "year").agg(F.sum("population").alias("population"))
    return a.join(p, ["country_code", "year"]).select("*", ratio(F.col("first"), F.col("population"), 1000).alias("first_per_1000"), ratio(F.col("second"), F.col("population"), 1000).alias("second_per_1000"))


def retirement_exposure(workers: DataFrame, oldest: tuple[str, str]) -> DataFrame:
    band = F.col("age_group_code")
    out = workers.where(BANDS).groupBy("profession_code", "country_code", "year").agg(F.sum("workers").alias("total_by_age"), sum_if(band.isin(*oldest), F.col("workers")).alias("near_retirement"), sum_if(band == oldest[1], F.col("workers")).alias("oldest"))
    return out.select("profession_code", "country_code", "year", "total_by_age", "near_retirement", ratio(F.col("near_retirement"), F.col("total_by_age"), 100).alias("pct_near"), ratio(F.col("oldest"), F.col("total_by_age"), 100).alias("pct_oldest"))


def shortage_ranking(shortage: DataFrame, *within: str) -> DataFrame:
    """Largest shortage first, within a year and further columns."""
    w = Window.partitionBy("year", *within).orderBy(F.col("shortage").desc_nulls_last())
    return shortage.select("country_code", "profession_code", "year", "shortage", "coverage_index", F.dense_rank().over(w).alias("severity_rank"))


def trend(df: DataFrame, column: str, *series: str) -> DataFrame:
    """Change against the year before (NULL where that year is missing) and mean of up to three rows, by year within a series."""
    w = Window.partitionBy(*series).orderBy("year")
    before = F.when(F.lag("year").over(w) == F.col("year") - 1, F.lag(column).over(w))
    return df.select(*series, "year", column, (F.col(column) - before).alias("yoy_change"), F.round(F.avg(column).over(w.rowsBetween(-2, 0)), 6).alias("rolling_3y_mean"))


def capacity_pressure(capacity: DataFrame) -> DataFrame:
    group = F.col("category_group")
    a = capacity.groupBy("country_code", "year").agg(sum_if((group == "hospital_bed") & ~F.col("is_total"), F.col("beds")).alias("hospital_beds"), sum_if(group == "icu_bed", F.col("beds")).alias("icu_beds"))
    return a.select("*", ratio(F.col("icu_beds"), F.col("hospital_beds"), 100).alias("icu_share_pct"))


def sex_composition(workers: DataFrame, female: str, male: str) -> DataFrame:
    sex = F.col("sex_code")
    a = workers.where("measure = 'headcount_total'").groupBy("profession_code", "country_code", "year").agg(sum_if(sex == female, F.col("workers")).alias("female"), sum_if(sex == male, F.col("workers")).alias("male"))
    return a.select("*", ratio(F.col("female"), F.col("female") + F.col("male"), 100).alias("pct_female"))


def reporting_completeness(workers: DataFrame, full: int = 5) -> DataFrame:
    a = workers.where(BANDS).groupBy("profession_code", "country_code", "year").agg(F.count(F.lit(1)).alias("age_rows"), F.countDistinct("age_group_code").alias("distinct_bands"))
    return a.select("*", F.when(F.col("distinct_bands") >= full, "full").otherwise("partial").alias("coverage"))


def measure_availability(workers: DataFrame) -> DataFrame:
    return workers.where(TOTALS).select("country_code", "profession_code", "year", "workers", F.col("workers").isNotNull().alias("is_reported"))


def data_gaps(entities: DataFrame, **facts: DataFrame) -> DataFrame:
    """Entities without any row in a fact, one row for each fact that lacks them."""
    out = None
    for domain, fact in facts.items():
        gap = entities.join(fact.select("country_code").distinct(), "country_code", "left_anti").select(F.lit(domain).alias("domain"), "country_code")
        out = gap if out is None else out.unionByName(gap)
    return out


def series_endpoints(workers: DataFrame) -> DataFrame:
    a = workers.groupBy("country_code", "profession_code").agg(F.min("year").alias("first_year"), F.max("year").alias("last_year"))
    last = workers.agg(F.max("year").alias("dataset_max_year"))
    return a.crossJoin(F.broadcast(last)).withColumn("is_stale", F.col("last_year") < F.col("dataset_max_year"))


def coverage_safe(index: DataFrame) -> DataFrame:
    return index.select("country_code", "year", "population", *[F.when(F.col(c).isNotNull(), ratio(F.col(c), F.col("population"), 1000)).alias(f"{c}_per_1000") for c in ("first", "second")], *[F.col(c).isNull().alias(f"{c}_missing") for c in ("first", "second")])


def age_pyramid(workers: DataFrame) -> DataFrame:
    return workers.where("measure = 'headcount_by_age' and sex_code <> 'T'").groupBy("country_code", "profession_code", "year", "age_group_code", "sex_code").agg(F.sum("workers").alias("workers"))


def regional_risk(regional: DataFrame, people: DataFrame, cuts: tuple[float, float, float] = (2, 5, 10)) -> DataFrame:
    """Density of each region's latest year against its population, with quartile (exact, by ranges of the density) and tier."""
    latest = regional.groupBy("region_code").agg(F.max_by("measure_value", "year").alias("workers"), F.max("year").alias("year"))
    a = latest.join(people, "region_code").select("region_code", "year", "workers", "population", ratio(F.col("workers"), F.col("population"), 1000).alias("workers_per_1000"))
    low, mid, high = cuts
    return ranks.ntile(a, ["workers_per_1000", "region_code"], 4, "density_quartile").select("*", tier(F.col("workers_per_1000"), [(high, "good"), (mid, "adequate"), (low, "low")], "critical").alias("access_tier"))


# --- dimensions ---------------------------------------------------------------------------------------------------


def dim_date(spark, first: int, last: int, as_of: int) -> DataFrame:
    y = F.col("year")
    return spark.sql(f"select explode(sequence({first}, {last})) as year").select((y - 1900 + 1).alias("date_key"), "year", F.make_date(y, F.lit(1), F.lit(1)).alias("date"), (y <= as_of).alias("is_observed"), (y > as_of).alias("is_projection"), (F.floor(y / 10) * 10).cast("int").alias("decade"))


def scd2_initial(df: DataFrame, since: str) -> DataFrame:
    return df.withColumns({"valid_from": F.lit(since).cast("date"), "valid_to": F.lit(None).cast("date"), "is_current": F.lit(True), "version": F.lit(1)})


def scd2_merge(current: DataFrame, incoming: DataFrame, key: str, tracked: list[str], as_of: str) -> DataFrame:
    """current with its rows closed where incoming changes a tracked column, and the new versions and members added."""
    old = current.where("is_current").select(F.col(key), F.struct(*tracked).alias("old"), F.col("version").alias("v"))
    marks = incoming.select(key, F.struct(*tracked).alias("new")).join(old, key, "left").where("v is null or not (new <=> old)")
    closed = current.join(marks.where("v is not null").select(key, F.lit(True).alias("hit")), key, "left")
    ends = F.col("is_current") & F.coalesce("hit", F.lit(False))
    kept = closed.select(*[c for c in current.columns if c not in ("valid_to", "is_current")], F.when(ends, F.lit(as_of).cast("date")).otherwise(F.col("valid_to")).alias("valid_to"), (F.col("is_current") & ~ends).alias("is_current")).select(current.columns)
    added = marks.select(key, *[F.col(f"new.{c}").alias(c) for c in tracked], F.lit(as_of).cast("date").alias("valid_from"), F.lit(None).cast("date").alias("valid_to"), F.lit(True).alias("is_current"), (F.coalesce("v", F.lit(0)) + 1).alias("version"))
    return kept.unionByName(added)
