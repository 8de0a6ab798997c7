"""The registered queries of the KPI measures, of labelled views and of dimensions, each with its SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import dimensions, facts, forecast, measure_plan, measures, views
from ..sources.storage import checkpointed
from . import adapter as A
from .catalog import ORACLES, C, N, P, R, S, V1, W, capacity, coverage, people, query, shortage, workers

YEARS_AHEAD = [1, 2, 3, 4, 5]
CONSTANTS = {"beds_per_nurse": 60.0, "icu_share": 0.3, "coverage": 0.75, "population": 25_000.0, "direction": 0.01}


def yearly_panel(spark: SparkSession, d: str) -> DataFrame:
    return views_panel(workers(spark, d))


def views_panel(staff: DataFrame) -> DataFrame:
    return staff.where(views.TOTALS).select("country_code", "profession_code", F.col("year").alias("period"), F.col("workers").alias("value"))


def forecasts(spark: SparkSession, d: str) -> DataFrame:
    found = forecast.forecast(yearly_panel(spark, d), ["country_code", "profession_code"], YEARS_AHEAD)
    return found.select("country_code", "profession_code", F.col("period").alias("year"), F.col("trend").alias("forecast"), F.col("naive").alias("baseline_forecast"))


def regions(spark: SparkSession, d: str) -> DataFrame:
    """Orders of each nation and year under its region."""
    o = A.placed_orders(spark, d).join(F.broadcast(A.read(spark, d, "region")), F.col("n_regionkey") == F.col("r_regionkey"))
    return o.groupBy(F.col("n_name").alias("region_code"), F.col("r_name").alias("country_code"), F.year("o_orderdate").alias("year")).agg(F.count(F.lit(1)).alias("measure_value"))


def star(spark: SparkSession, d: str) -> measures.Star:
    folk = people(spark, d)
    return measures.Star(
        workers(spark, d), shortage(spark, d), capacity(spark, d), folk, regions(spark, d), folk.withColumnRenamed("country_code", "region_code").withColumn("is_total", F.lit(True)), forecasts(spark, d),
        "BUILDING", "HOUSEHOLD", A.OLDEST, CONSTANTS,
    )


def kept_star(spark: SparkSession, d: str, staff: DataFrame | None = None, folk: DataFrame | None = None) -> measures.Star:
    """The star with each fact computed once: shortage and forecasts come from the kept workers, regions and people from the kept population. Workers and population may be given."""
    staff, folk = checkpointed(workers(spark, d) if staff is None else staff), checkpointed(people(spark, d) if folk is None else folk)
    short = facts.shortage(staff, folk, A.pairs(spark, A.PER_1000, "profession_code string, reference_per_1000 double"))
    ahead = forecast.forecast(views_panel(staff), ["country_code", "profession_code"], YEARS_AHEAD)
    ahead = ahead.select("country_code", "profession_code", F.col("period").alias("year"), F.col("trend").alias("forecast"), F.col("naive").alias("baseline_forecast"))
    places = folk.withColumnRenamed("country_code", "region_code").withColumn("is_total", F.lit(True))
    return measures.Star(staff, short, capacity(spark, d), folk, regions(spark, d), places, ahead, "BUILDING", "HOUSEHOLD", A.OLDEST, CONSTANTS)


HC = "hc AS (SELECT * FROM workers WHERE measure = 'headcount_total' AND sex_code = 'T')"
GS = "gs AS (SELECT country_code, year, sum(required_workers) AS required, sum(actual_workers)::BIGINT AS actual, sum(shortage) AS gap FROM shortage GROUP BY ALL)"
AG = """ag AS (SELECT country_code, year, sum(workers)::BIGINT AS banded, (sum(workers) FILTER (WHERE age_group_code IN ('B4', 'B5')))::BIGINT AS near, (sum(workers) FILTER (WHERE age_group_code = 'B5'))::BIGINT AS oldest
  FROM workers WHERE measure = 'headcount_by_age' AND sex_code = 'T' GROUP BY ALL)"""
BD = "bd AS (SELECT country_code, year, sum(beds) FILTER (WHERE category_group = 'hospital_bed') AS beds, sum(beds) FILTER (WHERE category_group = 'icu_bed') AS icu FROM capacity GROUP BY ALL)"
HR = """hr AS (SELECT country_code, year, round((least(1.0::DOUBLE, beds / nullif(nurses, 0) / 60.0::DOUBLE) * 0.40::DOUBLE + least(1.0::DOUBLE, 0.3::DOUBLE / (icu / beds)) * 0.35::DOUBLE + least(1.0::DOUBLE, near * 1.0::DOUBLE / banded / 0.6::DOUBLE) * 0.25::DOUBLE) * 100, 1) AS value0, beds IS NULL OR icu IS NULL OR nurses IS NULL OR near IS NULL AS unknown
  FROM bd FULL JOIN (SELECT country_code, year, (sum(workers) FILTER (WHERE profession_code = 'HOUSEHOLD'))::BIGINT AS nurses FROM hc GROUP BY ALL) USING (country_code, year) FULL JOIN ag USING (country_code, year)),
hrisk AS (SELECT country_code, year, CASE WHEN NOT unknown THEN value0 END AS value FROM hr)"""
RS = """rs AS (SELECT region_code, year, measure_value, population FROM (SELECT n_name AS region_code, year, sum(value)::BIGINT AS measure_value FROM r0 GROUP BY ALL) FULL JOIN (SELECT country_code AS region_code, year, population FROM people) USING (region_code, year)),
ds AS (SELECT region_code, year, population, CASE WHEN measure_value IS NOT NULL AND population IS NOT NULL THEN round(least(1.0::DOUBLE, 0.75::DOUBLE / (measure_value * 1000.0::DOUBLE / population)) * 70 + least(1.0::DOUBLE, 25000.0::DOUBLE / population) * 30, 1) END AS score FROM rs),
dt AS (SELECT *, CASE WHEN score IS NULL THEN 'Unknown' WHEN score >= 70 THEN 'Critical' WHEN score >= 45 THEN 'High' WHEN score >= 25 THEN 'Medium' ELSE 'Low' END AS tier FROM ds)"""
FC = """fit AS (SELECT country_code, profession_code, arg_max(workers, year)::DOUBLE AS l, count(*) AS n, sum(year)::DOUBLE AS st, sum(workers)::DOUBLE AS sy, sum(year::BIGINT * year)::DOUBLE AS stt, sum(year * workers)::DOUBLE AS sty FROM hc GROUP BY ALL),
line AS (SELECT *, (n * sty - st * sy) / nullif(n * stt - st * st, 0) AS slope FROM fit),
fc AS (SELECT country_code, profession_code, (SELECT max(year) FROM hc) + h AS year, greatest(0.0, CASE WHEN n >= 2 THEN coalesce((sy - slope * st) / n + slope * ((SELECT max(year) FROM hc) + h), l) ELSE l END) AS forecast, greatest(0.0, l) AS baseline_forecast FROM line, (SELECT unnest([1, 2, 3, 4, 5]) AS h))"""
CY = ("country_code", "year")
LATEST = "SELECT country_code, {} AS value FROM hc WHERE year = (SELECT max(year) FROM hc) GROUP BY 1"
RATE = "FROM (SELECT *, CASE WHEN lag(year) OVER w = year - 1 THEN lag({0}) OVER w END AS before FROM {1} WINDOW w AS (PARTITION BY country_code ORDER BY year))"
SUFF = "sf AS (SELECT country_code, year, actual * 1.0::DOUBLE / nullif(required, 0) AS value FROM gs)"
SHARE = "CASE WHEN a <> 0 THEN (b - a) / a END"
CHANGE = "ch AS (SELECT country_code, sum(forecast) FILTER (WHERE year = (SELECT max(year) FROM fc) - 4) AS a, sum(forecast) FILTER (WHERE year = (SELECT max(year) FROM fc)) AS b FROM fc GROUP BY 1)"

#: number, measure, grouping, SQL, what the SQL is over
KPIS = [
    (1, "total_first", ("country_code",), LATEST.format("(sum(workers) FILTER (WHERE profession_code = 'BUILDING'))::BIGINT"), (W, HC)),
    (2, "total_second", ("country_code",), LATEST.format("(sum(workers) FILTER (WHERE profession_code = 'HOUSEHOLD'))::BIGINT"), (W, HC)),
    (3, "total_workers", ("country_code",), LATEST.format("sum(workers)::BIGINT"), (W, HC)),
    (4, "required_workers", CY, "SELECT country_code, year, required AS value FROM gs", (W, P, S, GS)),
    (5, "workforce_gap", CY, "SELECT country_code, year, gap AS value FROM gs", (W, P, S, GS)),
    (6, "workforce_gap_share", CY, "SELECT country_code, year, gap / nullif(required, 0) AS value FROM gs", (W, P, S, GS)),
    (7, "staffing_sufficiency", CY, "SELECT * FROM sf", (W, P, S, GS, SUFF)),
    (8, "retirement_risk", CY, "SELECT country_code, year, near * 1.0::DOUBLE / nullif(banded, 0) AS value FROM ag", (W, AG)),
    (9, "retirement_exposure", CY, "SELECT country_code, year, oldest * 1.0::DOUBLE / nullif(banded, 0) AS value FROM ag", (W, AG)),
    (10, "near_retirement", CY, "SELECT country_code, year, near AS value FROM ag", (W, AG)),
    (11, "hospital_readiness", CY, "SELECT country_code, year, icu / nullif(beds, 0) AS value FROM bd", (C, BD)),
    (12, "hospital_beds", CY, "SELECT country_code, year, beds AS value FROM bd", (C, BD)),
    (13, "icu_beds", CY, "SELECT country_code, year, icu AS value FROM bd", (C, BD)),
    (14, "worker_population_ratio", CY, "SELECT country_code, year, w * 1000.0::DOUBLE / nullif(population, 0) AS value FROM (SELECT country_code, year, sum(workers)::BIGINT AS w FROM hc GROUP BY ALL) FULL JOIN people USING (country_code, year)", (W, P, HC)),
    (15, "weighted_coverage", ("year",), "SELECT year, round(sum(w * 1000.0::DOUBLE / nullif(population, 0) * population) / sum(population)::DOUBLE, 6) AS value FROM people LEFT JOIN (SELECT country_code, year, sum(workers)::BIGINT AS w FROM hc GROUP BY ALL) USING (country_code, year) GROUP BY 1", (W, P, HC)),
    (16, "first_reported", CY, "SELECT country_code, year, count(workers) FILTER (WHERE profession_code = 'BUILDING') > 0 AS value FROM hc GROUP BY ALL", (W, HC)),
    (17, "second_reported", CY, "SELECT country_code, year, count(workers) FILTER (WHERE profession_code = 'HOUSEHOLD') > 0 AS value FROM hc GROUP BY ALL", (W, HC)),
    (18, "countries_reporting", ("year",), "SELECT year, count(DISTINCT country_code) FILTER (WHERE profession_code = 'HOUSEHOLD' AND workers IS NOT NULL) AS value FROM hc GROUP BY 1", (W, HC)),
    (19, "severity_rank", CY, "SELECT country_code, year, (dense_rank() OVER (PARTITION BY year ORDER BY gap DESC NULLS LAST))::INT AS value FROM gs", (W, P, S, GS)),
    (20, "gap_change", CY, "SELECT country_code, year, gap - before AS value " + RATE.format("gap", "gs"), (W, P, S, GS)),
    (21, "gap_rolling", CY, "SELECT country_code, year, round(avg(gap) OVER (PARTITION BY country_code ORDER BY year RANGE BETWEEN 2 PRECEDING AND CURRENT ROW), 6) AS value FROM gs", (W, P, S, GS)),
    (22, "deteriorating", ("year",), "SELECT year, count(*) FILTER (WHERE value < before) AS value " + RATE.format("value", "sf") + " GROUP BY 1", (W, P, S, GS, SUFF)),
    (23, "aging_index", CY, "SELECT country_code, year, near * 1.0::DOUBLE / nullif(banded, 0) AS value FROM ag", (W, AG)),
    (24, "aging_against_all", CY, "SELECT country_code, year, (x - y) / nullif(y, 0) AS value FROM (SELECT country_code, year, near * 1.0::DOUBLE / nullif(banded, 0) AS x, sum(near) OVER w::BIGINT * 1.0::DOUBLE / nullif(sum(banded) OVER w, 0)::BIGINT AS y FROM ag WINDOW w AS (PARTITION BY year))", (W, AG)),
    (25, "replacement_demand", CY, "SELECT country_code, year, near AS value FROM ag", (W, AG)),
    (26, "hospital_risk", CY, "SELECT * FROM hrisk", (W, C, HC, AG, BD, HR)),
    (27, "hospital_tier", CY, "SELECT country_code, year, CASE WHEN value IS NULL THEN 'Unknown' WHEN value >= 75 THEN 'Critical' WHEN value >= 50 THEN 'High' WHEN value >= 25 THEN 'Medium' ELSE 'Low' END AS value FROM hrisk", (W, C, HC, AG, BD, HR)),
    (28, "regional_coverage", ("region_code", "year"), "SELECT region_code, year, measure_value * 1000.0::DOUBLE / nullif(population, 0) AS value FROM rs", (P, R, RS)),
    (29, "desert_score", ("region_code", "year"), "SELECT region_code, year, score AS value FROM dt", (P, R, RS)),
    (30, "desert_tier", ("region_code", "year"), "SELECT region_code, year, tier AS value FROM dt", (P, R, RS)),
    (31, "critical_regions", ("year",), "SELECT year, count(*) FILTER (WHERE tier = 'Critical') AS value FROM dt GROUP BY 1", (P, R, RS)),
    (32, "people_in_deserts", ("year",), "SELECT year, (sum(population) FILTER (WHERE tier IN ('Critical', 'High')))::BIGINT AS value FROM dt GROUP BY 1", (P, R, RS)),
    (33, "forecast_gap", ("country_code",), "SELECT country_code, round(r - f, 6) AS value FROM (SELECT country_code, sum(required_workers) AS r FROM shortage WHERE year = (SELECT max(year) FROM shortage) GROUP BY 1) FULL JOIN (SELECT country_code, sum(forecast) AS f FROM fc WHERE year = (SELECT max(year) FROM fc) GROUP BY 1) USING (country_code)", (W, P, S, HC, FC)),
    (34, "model_uplift", CY, "SELECT country_code, year, round(sum(forecast) - sum(baseline_forecast), 6) AS value FROM fc GROUP BY ALL", (W, HC, FC)),
    (35, "forecast_direction", ("country_code",), f"SELECT country_code, CASE WHEN x IS NULL THEN 'Unknown' WHEN x > 0.01 THEN 'Growing' WHEN x < -0.01 THEN 'Shrinking' ELSE 'Stable' END AS value FROM (SELECT country_code, round({SHARE}, 9) AS x FROM ch)", (W, HC, FC, CHANGE)),
    (36, "coverage_index", CY, "SELECT * FROM sf", (W, P, S, GS, SUFF)),
    (37, "future_capacity", CY, "SELECT country_code, year, round(sum(forecast), 6) AS value FROM fc GROUP BY ALL", (W, HC, FC)),
    (38, "equity", ("year",), "SELECT year, 1.0::DOUBLE / (1 + (max(value) - min(value))) AS value FROM sf GROUP BY 1", (W, P, S, GS, SUFF)),
    (39, "regional_risk", CY, "SELECT * FROM hrisk", (W, C, HC, AG, BD, HR)),
    (40, "recruitment_efficiency", CY, "SELECT country_code, year, (before - gap) / nullif(abs(before), 0) AS value " + RATE.format("gap", "gs"), (W, P, S, GS)),
    (41, "access_score", ("region_code", "year"), "SELECT region_code, year, measure_value * 1000.0::DOUBLE / nullif(population, 0) AS value FROM rs", (P, R, RS)),
    (42, "forecast_workers", CY, "SELECT country_code, year, round(sum(forecast), 6) AS value FROM fc GROUP BY ALL", (W, HC, FC)),
    (43, "baseline_forecast", CY, "SELECT country_code, year, round(sum(baseline_forecast), 6) AS value FROM fc GROUP BY ALL", (W, HC, FC)),
    (44, "forecast_change", ("country_code",), f"SELECT country_code, round({SHARE}, 9) AS value FROM ch", (W, HC, FC, CHANGE)),
]
for number, name, groups, sql, shared in KPIS:
    query(f"m{number}_{name}", sql, *shared)(lambda s, d, name=name, groups=groups: measures.measure(star(s, d), name, *groups))

CARD = ["total_first", "total_second", "total_workers", "required_workers", "workforce_gap", "workforce_gap_share", "staffing_sufficiency", "retirement_risk", "near_retirement", "hospital_beds", "icu_beds", "hospital_readiness"]
query(
    "m45_card",
    """SELECT name AS measure, round(v::DOUBLE, 6) AS value FROM (
  SELECT unnest(['total_first', 'total_second', 'total_workers', 'required_workers', 'workforce_gap', 'workforce_gap_share', 'staffing_sufficiency', 'retirement_risk', 'near_retirement', 'hospital_beds', 'icu_beds', 'hospital_readiness']) AS name, unnest([d, n, t, r, g, g / r, a / r, near / banded, near, beds, icu, icu / beds]) AS v
  FROM (SELECT (sum(workers) FILTER (WHERE profession_code = 'BUILDING'))::DOUBLE AS d, (sum(workers) FILTER (WHERE profession_code = 'HOUSEHOLD'))::DOUBLE AS n, sum(workers)::DOUBLE AS t FROM hc WHERE year = 1998),
    (SELECT sum(required)::DOUBLE AS r, sum(gap)::DOUBLE AS g, sum(actual)::DOUBLE AS a FROM gs WHERE year = 1998), (SELECT sum(near)::DOUBLE AS near, sum(banded)::DOUBLE AS banded FROM ag WHERE year = 1998), (SELECT sum(beds)::DOUBLE AS beds, sum(icu)::DOUBLE AS icu FROM bd WHERE year = 1998))""",
    W, P, S, C, HC, GS, AG, BD,
)(lambda s, d: measure_plan.card(kept_star(s, d), 1998, CARD))

ALL_SQL = " UNION ALL ".join(
    f"SELECT '{name}' AS measure, {', '.join(c if c in groups else f'NULL::{kind} AS {c}' for c, kind in (('country_code', 'VARCHAR'), ('region_code', 'VARCHAR'), ('year', 'INT')))}, {'NULL::DOUBLE AS value, value AS label' if name.endswith(('tier', 'direction')) else 'round(value::DOUBLE, 6) AS value, NULL::VARCHAR AS label'} FROM ({ORACLES[f'm{number}_{name}']})"
    for number, name, groups, _, _ in KPIS
)


@query("m46_all_measures", ALL_SQL)
def all_measures(spark: SparkSession, d: str) -> DataFrame:
    """Every measure in its grouping from one plan: one aggregate for each fact."""
    return measure_plan.Plan(kept_star(spark, d), [(name, groups) for _, name, groups, _, _ in KPIS]).rows().withColumn("value", F.round("value", 6))
