"""Facts: totals kept apart from their parts, NULL kept apart from 0, one declared grain each."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .grain import conform, to_grain

GRAIN = {
    "workers": ["profession_code", "age_group_code", "sex_code", "country_code", "year", "measure"],
    "retirement": ["profession_code", "age_group_code", "country_code", "year"],
    "population": ["country_code", "sex_code", "year"],
    "population_regions": ["region_code", "country_code", "age_group_code", "is_total", "sex_code", "year"],
    "indicators": ["country_code", "indicator_code", "sex_code", "year"],
    "capacity": ["country_code", "year", "bed_category", "category_group", "is_total"],
    "shortage": ["profession_code", "country_code", "year"],
    "regional": ["region_code", "region_level", "country_code", "profession_code", "year"],
}


def named(df: DataFrame, **columns: Column) -> DataFrame:
    return df.select(*[c.alias(n) for n, c in columns.items()])


def workers(tidy: DataFrame, ladder: DataFrame, total: str = "TOTAL") -> DataFrame:
    """Headcounts: the published total is a measure of its own (band NULL), never one of the bands."""
    is_total = F.col("age") == total
    rows = conform(tidy, F.col("age"), ladder, "age_group_code").where(is_total | F.col("age_group_code").isNotNull())
    rows = named(
        rows,
        profession_code=F.col("profession"),
        age_group_code=F.when(~is_total, F.col("age_group_code")),
        sex_code=F.col("sex"),
        country_code=F.col("geo"),
        year=F.col("time").cast("int"),
        measure=F.when(is_total, "headcount_total").otherwise("headcount_by_age"),
        workers=F.col("value").try_cast("bigint"),
    )
    return to_grain(rows, GRAIN["workers"], "workers")


def retirement(fact: DataFrame, oldest: tuple[str, ...]) -> DataFrame:
    rows = fact.where((F.col("measure") == "headcount_by_age") & F.col("age_group_code").isin(*oldest) & (F.col("sex_code") == "T"))
    return to_grain(rows.withColumn("near_retirement_workers", F.col("workers")), GRAIN["retirement"], "near_retirement_workers")


def population(tidy: DataFrame) -> DataFrame:
    sex = F.coalesce(F.col("sex"), F.lit("T")) if "sex" in tidy.columns else F.lit("T")
    return to_grain(named(tidy, country_code=F.col("geo"), sex_code=sex, year=F.col("time").cast("int"), population=F.col("value").try_cast("bigint")), GRAIN["population"], "population")


def indicators(tidy: DataFrame) -> DataFrame:
    return to_grain(named(tidy, country_code=F.col("geo"), indicator_code=F.col("indicator"), sex_code=F.lit("T"), year=F.col("time").cast("int"), population=F.col("value").try_cast("double")), GRAIN["indicators"], "population")


def population_regions(tidy: DataFrame, ladder: DataFrame, country: Column, total: str = "TOTAL") -> DataFrame:
    is_total = F.col("age") == total
    rows = conform(tidy, F.col("age"), ladder, "age_group_code").where(is_total | F.col("age_group_code").isNotNull())
    rows = named(rows, region_code=F.col("geo"), country_code=country, age_group_code=F.when(~is_total, F.col("age_group_code")), is_total=is_total, sex_code=F.col("sex"), year=F.col("time").cast("int"), population=F.col("value").try_cast("bigint"))
    return to_grain(rows, GRAIN["population_regions"], "population")


def capacity(tidy: DataFrame, labels: DataFrame, unit: str = "NR", total_label: str = "total") -> DataFrame:
    """Beds by category. Ratios (other units) are dropped, an unknown facility keeps its code, and the total stands apart."""
    rows = tidy.where(F.col("unit") == unit).join(F.broadcast(labels), "facility", "left")
    label = F.coalesce("label", "facility")
    rows = named(rows, country_code=F.col("geo"), year=F.col("time").cast("int"), bed_category=label, category_group=F.coalesce("category_group", F.lit("hospital_bed")), is_total=label == total_label, beds=F.col("value").try_cast("double"))
    return to_grain(rows, GRAIN["capacity"], "beds")


def shortage(fact: DataFrame, people: DataFrame, per_1000: DataFrame) -> DataFrame:
    """Required against actual workers. per_1000 (profession_code, reference_per_1000) is a short list; professions without a reference are left out."""
    actual = fact.where("measure = 'headcount_total' and sex_code = 'T'").groupBy("profession_code", "country_code", "year").agg(F.sum("workers").alias("actual_workers"))
    total = people.where("sex_code = 'T'").groupBy("country_code", "year").agg(F.sum("population").alias("total_population"))
    required = F.col("total_population") / F.lit(1000.0) * F.col("reference_per_1000")
    out = actual.join(total, ["country_code", "year"]).join(F.broadcast(per_1000), "profession_code").withColumn("required_workers", required)
    return out.select("profession_code", "country_code", "year", (F.col("required_workers") - F.col("actual_workers")).alias("shortage"), "actual_workers", "required_workers", F.try_divide(F.col("actual_workers") * F.lit(100.0), F.col("required_workers")).alias("coverage_index"), "total_population", "reference_per_1000")
