"""The registered queries of the library's own operators, each with the SQL it is compared with.

Names start with the inventory id they cover. SQL stands next to its query; ``shared`` definitions are the adapter's.
"""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.columns import is_missing, number, ratio, sum_if, tier
from ..operators import facts, forecast, grain, hierarchy, quality, ranks, views
from ..sources import cubes
from . import adapter as A

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None, *shared: str):
    def add(f):
        QUERIES[name] = f
        if sql is not None:
            ORACLES[name] = (f"WITH {', '.join(shared)} " if shared else "") + sql
        return f

    return add


W, P, C, S, R, N = A.SQL_WORKERS, A.SQL_PEOPLE, A.SQL_CAPACITY, A.SQL_SHORTAGE, A.SQL_REGIONAL, A.SQL_PANEL
KEYS = hierarchy.KEYS


def workers(spark, d):
    return facts.workers(A.tidy_workers(spark, d), A.ladder(spark))


def people(spark, d):
    return facts.population(A.tidy_population(spark, d))


def capacity(spark, d):
    return facts.capacity(A.tidy_beds(spark, d), A.facilities(spark))


def shortage(spark, d):
    return facts.shortage(workers(spark, d), people(spark, d), A.pairs(spark, A.PER_1000, "profession_code string, reference_per_1000 double"))


def coverage(spark, d):
    return views.coverage_index(workers(spark, d), people(spark, d), "BUILDING", "HOUSEHOLD")


def levels_of(rows, nat):
    return hierarchy.detect_level(rows.where(F.col("year") == A.ANCHOR), nat.where(F.col("year") == A.ANCHOR).drop("year"))


def levels(spark, d):
    return levels_of(*A.regional(spark, d))


def regional(spark, d):
    rows, nat = A.regional(spark, d)
    return hierarchy.at_reporting_level(rows, levels_of(rows, nat))


# --- sources ------------------------------------------------------------------------------------------------------


@query(
    "s1_cube_decode",
    "SELECT n_name AS geo, c_mktsegment AS age, count(*)::DOUBLE AS value, CASE WHEN count(*) % 3 = 0 THEN 'p' END AS status, CASE WHEN count(*) % 3 = 0 THEN 'provisional' END AS status_label FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY ALL",
)
def cube_decode(spark: SparkSession, d: str) -> DataFrame:
    """Customers by segment as one cube file for each nation, encoded and decoded again."""
    return cubes.decode(customer_cubes(customers_of_nations(spark, d)).select("payload"), ["geo", "age"])


def customers_of_nations(spark: SparkSession, d: str) -> DataFrame:
    return A.read(spark, d, "customer").join(F.broadcast(A.read(spark, d, "nation")), F.col("c_nationkey") == F.col("n_nationkey"))


def customer_cubes(customers: DataFrame) -> DataFrame:
    """n_name and payload: a cube of each nation's customers by segment."""
    c = customers.groupBy("n_name", F.col("c_mktsegment").alias("s")).agg(F.count(F.lit(1)).alias("n"))
    one = c.groupBy("n_name").agg(F.array_sort(F.collect_list(F.struct("s", "n"))).alias("x"))
    index = F.map_from_arrays(F.transform("x", lambda e: e["s"]), F.transform("x", lambda e, i: i))
    keyed = lambda v: F.map_from_entries(F.transform(v, lambda e: F.struct(e["k"], e["v"])))
    cells = F.transform("x", lambda e, i: F.struct(i.cast("string").alias("k"), e["n"].alias("v")))
    flags = F.transform(F.filter(F.transform("x", lambda e, i: F.struct(i.cast("string").alias("k"), F.lit("p").alias("v"), e["n"].alias("n"))), lambda e: e["n"] % 3 == 0), lambda e: F.struct(e["k"].alias("k"), e["v"].alias("v")))
    payload = F.to_json(
        F.struct(
            F.array(F.lit("geo"), F.lit("age")).alias("id"),
            F.array(F.lit(1), F.size("x")).alias("size"),
            F.struct(F.struct(F.struct(F.create_map("n_name", F.lit(0)).alias("index")).alias("category")).alias("geo"), F.struct(F.struct(index.alias("index")).alias("category")).alias("age")).alias("dimension"),
            keyed(cells).alias("value"),
            keyed(flags).alias("status"),
        )
    )
    return one.select("n_name", payload.alias("payload"))


@query("s4_missing_values", "SELECT event_type, count(*) AS n, count(*) FILTER (WHERE value = 0) AS zeros, 0::BIGINT AS missing FROM events GROUP BY 1")
def missing_values(spark, d):
    e = A.read(spark, d, "events").withColumn("v", F.col("value").cast("string"))
    return e.groupBy("event_type").agg(F.count(number(F.col("v"))).alias("n"), F.count_if(number(F.col("v")) == 0).alias("zeros"), F.count_if(is_missing(F.col("v"))).alias("missing"))


@query("s14_last_periods", f"SELECT country_code, year, population FROM people QUALIFY dense_rank() OVER (PARTITION BY country_code ORDER BY year DESC) <= 2", P)
def last_periods(spark, d):
    w = Window.partitionBy("country_code").orderBy(F.col("year").desc())
    return people(spark, d).withColumn("r", F.dense_rank().over(w)).where("r <= 2").select("country_code", "year", "population")


# --- facts --------------------------------------------------------------------------------------------------------

query("f1_workers", "SELECT *, workers AS measure_value FROM workers", W)(workers)
query("f2_retirement", "SELECT profession_code, age_group_code, country_code, year, sum(workers)::BIGINT AS near_retirement_workers, sum(workers)::BIGINT AS measure_value FROM workers WHERE measure = 'headcount_by_age' AND sex_code = 'T' AND age_group_code IN ('B4', 'B5') GROUP BY ALL", W)(lambda s, d: facts.retirement(workers(s, d), A.OLDEST))
query("f5_capacity", "SELECT *, beds AS measure_value FROM capacity", C)(capacity)
query("f6_population", "SELECT *, population AS measure_value FROM people", P)(people)
query("f7_shortage", "SELECT * FROM shortage", W, P, S)(shortage)
query("f8_regional", "SELECT * FROM regional", R)(regional)


@query("f3_indicators", "SELECT country_code, 'customers' AS indicator_code, 'T' AS sex_code, year, population::DOUBLE AS population, population::DOUBLE AS measure_value FROM people", P)
def indicators(spark, d):
    return indicators_of(A.tidy_population(spark, d))


def indicators_of(tidy):
    return facts.indicators(tidy.withColumn("indicator", F.lit("customers")))


@query("f4_population_regions", "SELECT country_code || '-R' AS region_code, country_code, age_group_code, age_group_code IS NULL AS is_total, sex_code, year, sum(workers)::BIGINT AS population, sum(workers)::BIGINT AS measure_value FROM workers GROUP BY ALL", W)
def population_regions(spark, d):
    return population_regions_of(spark, A.tidy_workers(spark, d))


def population_regions_of(spark, tidy):
    tidy = tidy.withColumn("geo", F.concat("geo", F.lit("-R")))
    return facts.population_regions(tidy, A.ladder(spark), F.expr("substring(geo, 1, length(geo) - 2)"))


@query("f10_integrity", "SELECT 'lineitem.order' AS edge, count(*) AS fact_rows, count(*) FILTER (WHERE o_orderkey IS NULL) AS orphan_rows FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey UNION ALL SELECT 'order.customer', count(*), count(*) FILTER (WHERE c_custkey IS NULL) FROM orders LEFT JOIN customer ON o_custkey = c_custkey UNION ALL SELECT 'customer.nation', count(*), count(*) FILTER (WHERE n_nationkey IS NULL) FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey")
def integrity(spark, d):
    t = lambda n: A.read(spark, d, n)
    return grain.integrity([("lineitem.order", t("lineitem"), "l_orderkey", t("orders"), "o_orderkey"), ("order.customer", t("orders"), "o_custkey", t("customer"), "c_custkey"), ("customer.nation", t("customer"), "c_nationkey", t("nation"), "n_nationkey")])


@query("f11_grain_duplicates", "SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY ALL HAVING count(*) > 1")
def grain_duplicates(spark, d):
    return grain.duplicates(A.read(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"])


# --- dimensions ---------------------------------------------------------------------------------------------------


@query("d1_scd2_merge", "SELECT n_name AS code, n_regionkey AS parent, DATE '2000-01-01' AS valid_from, CASE WHEN n_nationkey % 5 = 0 THEN DATE '2024-01-01' END AS valid_to, n_nationkey % 5 <> 0 AS is_current, 1 AS version FROM nation UNION ALL SELECT n_name, n_regionkey + 100, DATE '2024-01-01', NULL, true, 2 FROM nation WHERE n_nationkey % 5 = 0")
def scd2(spark, d):
    n = A.read(spark, d, "nation").select(F.col("n_name").alias("code"), F.col("n_regionkey").alias("parent"), "n_nationkey")
    new = n.select("code", F.when(F.col("n_nationkey") % 5 == 0, F.col("parent") + 100).otherwise(F.col("parent")).alias("parent"))
    return views.scd2_merge(views.scd2_initial(n.drop("n_nationkey"), "2000-01-01"), new, "code", ["parent"], "2024-01-01")


@query("d2_dim_region", "WITH k AS (SELECT n_name AS region_code FROM nation UNION SELECT DISTINCT n_name || '-' || o_orderstatus FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey) SELECT row_number() OVER (ORDER BY region_code) AS region_key, region_code, coalesce(n_name, region_code) AS region_name, CASE WHEN n_name IS NOT NULL THEN 1 END AS region_level FROM k LEFT JOIN nation ON n_name = region_code")
def dim_region(spark, d):
    official = A.read(spark, d, "nation").select("n_name")
    seen = A.placed_orders(spark, d).select(F.concat_ws("-", "n_name", "o_orderstatus").alias("region_code"))
    codes = official.select(F.col("n_name").alias("region_code")).union(seen).distinct().join(F.broadcast(official), F.col("region_code") == F.col("n_name"), "left")
    rows = codes.select("region_code", F.coalesce("n_name", "region_code").alias("region_name"), F.when(F.col("n_name").isNotNull(), 1).alias("region_level"))
    return ranks.positions(rows, ["region_code"], row_number="region_key")


query("d8_dim_date", "SELECT y - 1899 AS date_key, y AS year, make_date(y, 1, 1) AS date, y <= 1999 AS is_observed, y > 1999 AS is_projection, (y // 10) * 10 AS decade FROM (SELECT unnest(range(min(year(o_orderdate)), max(year(o_orderdate)) + 6))::INT AS y FROM orders)")(
    lambda s, d: (lambda r: views.dim_date(s, r[0], r[1] + 5, 1999))(A.read(s, d, "orders").agg(F.min(F.year("o_orderdate")), F.max(F.year("o_orderdate"))).first())
)


@query("p2_band_ladder", "SELECT age_group_code, count(DISTINCT age) AS n_codes, string_agg(DISTINCT age, ',' ORDER BY age) AS codes FROM (SELECT age, 'B' || ((substr(age, 2)::INT + 1) // 2)::VARCHAR AS age_group_code FROM c0) GROUP BY 1", W)
def band_ladder(spark, d):
    tidy = A.tidy_workers(spark, d).where("age <> 'TOTAL'")
    return grain.conform(tidy, F.col("age"), A.ladder(spark), "age_group_code").groupBy("age_group_code").agg(F.countDistinct("age").alias("n_codes"), F.array_join(F.array_sort(F.collect_set("age")), ",").alias("codes"))


# --- views --------------------------------------------------------------------------------------------------------

V1 = """cov AS (SELECT w.country_code, w.year, w."first", w."second", population, w."first" * 1000.0::DOUBLE / population AS first_per_1000, w."second" * 1000.0::DOUBLE / population AS second_per_1000 FROM (
  SELECT country_code, year, (sum(workers) FILTER (WHERE profession_code = 'BUILDING'))::BIGINT AS "first", (sum(workers) FILTER (WHERE profession_code = 'HOUSEHOLD'))::BIGINT AS "second" FROM workers WHERE measure = 'headcount_total' AND sex_code = 'T' GROUP BY ALL) w
  JOIN people p ON w.country_code = p.country_code AND w.year = p.year WHERE population > 0)"""
V2 = """ret AS (SELECT profession_code, country_code, year, sum(workers)::BIGINT AS total_by_age, (sum(workers) FILTER (WHERE age_group_code IN ('B4', 'B5')))::BIGINT AS near_retirement, (sum(workers) FILTER (WHERE age_group_code = 'B5'))::BIGINT AS o
  FROM workers WHERE measure = 'headcount_by_age' AND sex_code = 'T' GROUP BY ALL),
rex AS (SELECT profession_code, country_code, year, total_by_age, near_retirement, near_retirement * 100.0::DOUBLE / total_by_age AS pct_near, o * 100.0::DOUBLE / total_by_age AS pct_oldest FROM ret)"""
query("v1_coverage_index", "SELECT * FROM cov", W, P, V1)(coverage)
query("v2_retirement_exposure", "SELECT * FROM rex", W, V2)(lambda s, d: views.retirement_exposure(workers(s, d), A.OLDEST))
query("v3_shortage_ranking", "SELECT country_code, profession_code, year, shortage, coverage_index, dense_rank() OVER (PARTITION BY year ORDER BY shortage DESC NULLS LAST) AS severity_rank FROM shortage", W, P, S)(lambda s, d: views.shortage_ranking(shortage(s, d)))
query("v4_coverage_trend", "SELECT country_code, year, first_per_1000, first_per_1000 - lag(first_per_1000) OVER w AS yoy_change, round(avg(first_per_1000) OVER (w ROWS BETWEEN 2 PRECEDING AND CURRENT ROW), 6) AS rolling_3y_mean FROM cov WINDOW w AS (PARTITION BY country_code ORDER BY year)", W, P, V1)(lambda s, d: views.trend(coverage(s, d), "first_per_1000", "country_code"))
query("v5_capacity_pressure", "SELECT country_code, year, sum(beds) FILTER (WHERE category_group = 'hospital_bed') AS hospital_beds, sum(beds) FILTER (WHERE category_group = 'icu_bed') AS icu_beds, (sum(beds) FILTER (WHERE category_group = 'icu_bed')) * 100.0::DOUBLE / sum(beds) FILTER (WHERE category_group = 'hospital_bed') AS icu_share_pct FROM capacity GROUP BY ALL", C)(lambda s, d: views.capacity_pressure(capacity(s, d)))
query("v6_sex_composition", "SELECT profession_code, country_code, year, (sum(workers) FILTER (WHERE sex_code = 'F'))::BIGINT AS female, (sum(workers) FILTER (WHERE sex_code = 'O'))::BIGINT AS male, (sum(workers) FILTER (WHERE sex_code = 'F')) * 100.0::DOUBLE / (sum(workers) FILTER (WHERE sex_code IN ('F', 'O'))) AS pct_female FROM workers WHERE measure = 'headcount_total' GROUP BY ALL", W)(lambda s, d: views.sex_composition(workers(s, d), "F", "O"))
query("v7_reporting_completeness", "SELECT profession_code, country_code, year, count(*) AS age_rows, count(DISTINCT age_group_code) AS distinct_bands, CASE WHEN count(DISTINCT age_group_code) >= 5 THEN 'full' ELSE 'partial' END AS coverage FROM workers WHERE measure = 'headcount_by_age' AND sex_code = 'T' GROUP BY ALL", W)(lambda s, d: views.reporting_completeness(workers(s, d)))
query("v8_measure_availability", "SELECT country_code, profession_code, year, workers, workers IS NOT NULL AS is_reported FROM workers WHERE measure = 'headcount_total' AND sex_code = 'T'", W)(lambda s, d: views.measure_availability(workers(s, d)))


@query("v9_data_gaps", "SELECT 'workers_building_f' AS domain, n_name AS country_code FROM nation WHERE NOT EXISTS (SELECT 1 FROM workers WHERE country_code = n_name AND profession_code = 'BUILDING' AND year = 1995 AND age_group_code = 'B5') UNION ALL SELECT 'capacity', n_name FROM nation WHERE NOT EXISTS (SELECT 1 FROM capacity WHERE country_code = n_name)", W, C)
def data_gaps(spark, d):
    entities = A.read(spark, d, "nation").select(F.col("n_name").alias("country_code"))
    return views.data_gaps(entities, workers_building_f=workers(spark, d).where("profession_code = 'BUILDING' and year = 1995 and age_group_code = 'B5'"), capacity=capacity(spark, d))


query("v10_series_endpoints", "SELECT country_code, profession_code, min(year) AS first_year, max(year) AS last_year, (SELECT max(year) FROM workers) AS dataset_max_year, max(year) < (SELECT max(year) FROM workers) AS is_stale FROM workers GROUP BY ALL", W)(lambda s, d: views.series_endpoints(workers(s, d)))
query("v11_coverage_safe", 'SELECT country_code, year, population, first_per_1000, second_per_1000, "first" IS NULL AS first_missing, "second" IS NULL AS second_missing FROM cov', W, P, V1)(lambda s, d: views.coverage_safe(coverage(s, d)))
query("v17_age_pyramid", "SELECT country_code, profession_code, year, age_group_code, sex_code, sum(workers)::BIGINT AS workers FROM workers WHERE measure = 'headcount_by_age' AND sex_code <> 'T' GROUP BY ALL", W)(lambda s, d: views.age_pyramid(workers(s, d)))
query("v19_profession_shortage_rank", "SELECT country_code, profession_code, year, shortage, coverage_index, dense_rank() OVER (PARTITION BY year, profession_code ORDER BY shortage DESC NULLS LAST) AS severity_rank FROM shortage", W, P, S)(lambda s, d: views.shortage_ranking(shortage(s, d), "profession_code"))
query("v20_coverage_gap_trend", "SELECT country_code, profession_code, year, coverage_index, coverage_index - lag(coverage_index) OVER w AS yoy_change, round(avg(coverage_index) OVER (w ROWS BETWEEN 2 PRECEDING AND CURRENT ROW), 6) AS rolling_3y_mean FROM shortage WINDOW w AS (PARTITION BY country_code, profession_code ORDER BY year)", W, P, S)(lambda s, d: views.trend(shortage(s, d), "coverage_index", "country_code", "profession_code"))


@query("v12_kpi_total_workers", "SELECT year, (sum(workers) FILTER (WHERE profession_code = 'BUILDING'))::BIGINT AS total_first, (sum(workers) FILTER (WHERE profession_code = 'HOUSEHOLD'))::BIGINT AS total_second, sum(workers)::BIGINT AS total_workers FROM workers WHERE measure = 'headcount_total' AND sex_code = 'T' GROUP BY 1", W)
def kpi_total_workers(spark, d):
    p = F.col("profession_code")
    return workers(spark, d).where(views.TOTALS).groupBy("year").agg(sum_if(p == "BUILDING", F.col("workers")).alias("total_first"), sum_if(p == "HOUSEHOLD", F.col("workers")).alias("total_second"), F.sum("workers").alias("total_workers"))


@query("v13_kpi_workforce_gap", "SELECT year, round(sum(required_workers), 3) AS required, sum(actual_workers)::BIGINT AS actual, round(sum(shortage), 3) AS gap, round(sum(shortage) * 100 / nullif(sum(required_workers), 0), 6) AS gap_pct FROM shortage GROUP BY 1", W, P, S)
def kpi_gap(spark, d):
    return shortage(spark, d).groupBy("year").agg(F.round(F.sum("required_workers"), 3).alias("required"), F.sum("actual_workers").alias("actual"), F.round(F.sum("shortage"), 3).alias("gap"), ratio(F.sum("shortage"), F.sum("required_workers"), 100, 6).alias("gap_pct"))


@query("v14_kpi_retirement_risk", "SELECT year, sum(near_retirement)::BIGINT AS near_retirement_workers, sum(near_retirement)::BIGINT * 100.0::DOUBLE / sum(total_by_age)::BIGINT AS retirement_risk_pct FROM rex GROUP BY 1", W, V2)
def kpi_retirement(spark, d):
    return views.retirement_exposure(workers(spark, d), A.OLDEST).groupBy("year").agg(F.sum("near_retirement").alias("near_retirement_workers"), ratio(F.sum("near_retirement"), F.sum("total_by_age"), 100).alias("retirement_risk_pct"))


@query("v15_kpi_coverage", 'SELECT year, round(avg(first_per_1000), 6) AS avg_first, round(avg(second_per_1000), 6) AS avg_second, count(*) FILTER (WHERE "first" IS NULL) AS first_missing, count(*) FILTER (WHERE "second" IS NULL) AS second_missing FROM cov GROUP BY 1', W, P, V1)
def kpi_coverage(spark, d):
    return views.coverage_safe(coverage(spark, d)).groupBy("year").agg(F.round(F.avg("first_per_1000"), 6).alias("avg_first"), F.round(F.avg("second_per_1000"), 6).alias("avg_second"), F.count_if("first_missing").alias("first_missing"), F.count_if("second_missing").alias("second_missing"))


@query("v16_kpi_hospital_readiness", "SELECT year, sum(beds) FILTER (WHERE category_group = 'hospital_bed') AS beds, sum(beds) FILTER (WHERE category_group = 'icu_bed') AS icu_beds, (sum(beds) FILTER (WHERE category_group = 'icu_bed')) * 100.0::DOUBLE / sum(beds) FILTER (WHERE category_group = 'hospital_bed') AS icu_share_pct FROM capacity GROUP BY 1", C)
def kpi_readiness(spark, d):
    return views.capacity_pressure(capacity(spark, d)).groupBy("year").agg(F.sum("hospital_beds").alias("beds"), F.sum("icu_beds").alias("icu_beds"), ratio(F.sum("icu_beds"), F.sum("hospital_beds"), 100).alias("icu_share_pct"))


query("v18_workforce_aging", "SELECT country_code, profession_code, year, pct_near, pct_near - lag(pct_near) OVER w AS yoy_change, round(avg(pct_near) OVER (w ROWS BETWEEN 2 PRECEDING AND CURRENT ROW), 6) AS rolling_3y_mean FROM rex WINDOW w AS (PARTITION BY country_code, profession_code ORDER BY year)", W, V2)(lambda s, d: views.trend(views.retirement_exposure(workers(s, d), A.OLDEST), "pct_near", "country_code", "profession_code"))


@query("v21_regional_risk", "SELECT *, ntile(4) OVER (ORDER BY workers_per_1000 NULLS LAST, region_code) AS density_quartile, CASE WHEN workers_per_1000 IS NULL THEN 'Unknown' WHEN workers_per_1000 >= 200 THEN 'good' WHEN workers_per_1000 >= 100 THEN 'adequate' WHEN workers_per_1000 >= 50 THEN 'low' ELSE 'critical' END AS access_tier FROM (SELECT region_code, year, workers, population, workers * 1000.0::DOUBLE / population AS workers_per_1000 FROM (SELECT n_name AS region_code, max(year)::INT AS year, arg_max(v, year)::BIGINT AS workers FROM (SELECT n_name, year, sum(value)::BIGINT AS v FROM r0 GROUP BY ALL) GROUP BY 1) JOIN (SELECT n_name AS region_code, count(*) AS population FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY 1) USING (region_code))", R)
def regional_risk(spark, d):
    o = A.placed_orders(spark, d).groupBy(F.col("n_name").alias("region_code"), F.year("o_orderdate").alias("year")).agg(F.count(F.lit(1)).alias("measure_value"))
    p = A.read(spark, d, "customer").join(F.broadcast(A.read(spark, d, "nation")), F.col("c_nationkey") == F.col("n_nationkey")).groupBy(F.col("n_name").alias("region_code")).agg(F.count(F.lit(1)).alias("population"))
    return views.regional_risk(o, p, (50, 100, 200))


# --- quality ------------------------------------------------------------------------------------------------------

K_SQL = """SELECT 'null_rate' AS name, 'completeness' AS family, 'PASS' AS status, 0.0::DOUBLE AS observed, 0.05::DOUBLE AS threshold, 'error' AS severity
UNION ALL SELECT 'duplicate_rate', 'uniqueness', CASE WHEN count(*) = sum(c) THEN 'PASS' ELSE 'FAIL' END, 1 - count(*) / sum(c)::DOUBLE, 0.0, 'error' FROM (SELECT count(*) AS c FROM lineitem GROUP BY l_orderkey, l_linenumber)
UNION ALL SELECT 'range', 'validity', CASE WHEN count(*) FILTER (WHERE l_quantity < 1 OR l_quantity > 40) = 0 THEN 'PASS' ELSE 'FAIL' END, count(*) FILTER (WHERE l_quantity < 1 OR l_quantity > 40) / count(*)::DOUBLE, 0.0, 'error' FROM lineitem
UNION ALL SELECT 'schema', 'validity', 'PASS', 0.0, 0.0, 'error'
UNION ALL SELECT 'references', 'consistency', CASE WHEN count(*) = 0 THEN 'PASS' ELSE 'FAIL' END, count(*)::DOUBLE, 0.0, 'error' FROM (SELECT DISTINCT l_orderkey FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders))
UNION ALL SELECT 'completeness', 'completeness', CASE WHEN avg((c = 11)::INT) >= 0.9 THEN 'PASS' WHEN avg((c = 11)::INT) >= 0.5 THEN 'WARN' ELSE 'FAIL' END, avg((c = 11)::INT), 0.9, 'warning' FROM (SELECT count(DISTINCT age) AS c FROM raw GROUP BY geo, profession, year, sex)
UNION ALL SELECT 'total_reconciliation', 'consistency', CASE WHEN max(x) IS NULL THEN 'WARN' WHEN max(x) > 1 THEN 'FAIL' ELSE 'PASS' END, max(x), 1.0, 'error' FROM (SELECT abs(sum(value) FILTER (WHERE age <> 'TOTAL') - sum(value) FILTER (WHERE age = 'TOTAL')) / sum(value) FILTER (WHERE age = 'TOTAL') * 100.0::DOUBLE AS x FROM raw GROUP BY geo, profession, year, sex HAVING count(DISTINCT age) = 11)
UNION ALL SELECT 'freshness', 'timeliness', CASE WHEN datediff('day', max(ts)::DATE, DATE '2024-06-01') <= 900 THEN 'PASS' ELSE 'FAIL' END, datediff('day', max(ts)::DATE, DATE '2024-06-01')::DOUBLE, 900.0, 'warning' FROM events
UNION ALL SELECT 'coverage', 'completeness', CASE WHEN avg(h) >= 0.95 THEN 'PASS' WHEN avg(h) >= 0.7 THEN 'WARN' ELSE 'FAIL' END, avg(h), 0.95, 'warning' FROM (SELECT n_nationkey IN (SELECT s_nationkey FROM supplier) AS b, (CASE WHEN n_nationkey IN (SELECT s_nationkey FROM supplier) THEN 1.0::DOUBLE ELSE 0 END) AS h FROM nation)"""


def checks(spark, d):
    t = lambda n: A.read(spark, d, n)
    tidy, group = A.tidy_workers(spark, d), ["geo", "profession", "time", "sex"]
    found = [
        quality.row_checks(t("lineitem"), ["l_orderkey", "l_linenumber"], ["l_orderkey", "l_quantity"], "l_quantity", 1, 40),
        quality.has_columns(t("lineitem"), ["l_orderkey", "l_quantity"]),
        quality.references(t("lineitem"), "l_orderkey", t("orders"), "o_orderkey"),
        quality.completeness(tidy, group, "age", 11),
        quality.totals_reconcile(tidy, group, "age", "value", 10),
        quality.freshness(t("events"), "ts", "2024-06-01"),
        quality.coverage(t("supplier"), "s_nationkey", t("nation"), "n_nationkey"),
    ]
    return functools.reduce(DataFrame.unionByName, found)


query("k1_quality_checks", K_SQL, W)(lambda s, d: checks(s, d).drop("detail"))
query("k10_quality_score", f"SELECT avg(CASE status WHEN 'PASS' THEN 1.0::DOUBLE WHEN 'WARN' THEN 0.5 ELSE 0 END) * 100 AS score, count(*) FILTER (WHERE status = 'PASS') AS n_pass, count(*) FILTER (WHERE status = 'WARN') AS n_warn, count(*) FILTER (WHERE status = 'FAIL') AS n_fail, count(*) FILTER (WHERE status = 'FAIL' AND severity = 'error') AS blocking FROM ({K_SQL})", W)(lambda s, d: quality.score(checks(s, d)))

# --- hierarchy ----------------------------------------------------------------------------------------------------

query("g2_detect_level", "SELECT * FROM levels", R)(levels)
query("g4_reconciliation", "SELECT country_code, profession_code, year, sum(measure_value)::BIGINT AS regional_total, max(national_total) AS national_total, abs(sum(measure_value)::BIGINT - max(national_total)) / max(national_total) AS rel_diff, abs(sum(measure_value)::BIGINT - max(national_total)) / max(national_total) <= 0.05 AS within FROM regional JOIN nat USING (country_code, profession_code, year) GROUP BY ALL", R)(lambda s, d: hierarchy.reconciliation(regional(s, d), A.regional(s, d)[1]))
query("g5_keep_reconciling", "SELECT r.* FROM regional r JOIN (SELECT country_code, profession_code, year FROM regional JOIN nat USING (country_code, profession_code, year) GROUP BY ALL HAVING abs(sum(measure_value)::BIGINT - max(national_total)) / max(national_total) <= 0.05) USING (country_code, profession_code, year)", R)(lambda s, d: hierarchy.keep_reconciling(regional(s, d), A.regional(s, d)[1]))
query("g8_double_count", "SELECT country_code, profession_code, a AS all_levels, n AS national_total, a / n AS share FROM (SELECT country_code, profession_code, sum(value)::BIGINT AS a FROM reg WHERE year = 1997 GROUP BY ALL) JOIN (SELECT country_code, profession_code, national_total AS n FROM nat WHERE year = 1997) USING (country_code, profession_code)", R)(
    lambda s, d: (lambda x: hierarchy.double_count(x[0].where(F.col("year") == A.ANCHOR), x[1].where(F.col("year") == A.ANCHOR).drop("year")))(A.regional(s, d))
)

# --- forecasts ----------------------------------------------------------------------------------------------------

SERIES = ["region", "segment"]
query("l2_baseline_forecasts", "SELECT region, segment, e + h AS period, greatest(0.0, l) AS naive, greatest(0.0, l + coalesce((l - f) / nullif(p1 - p0, 0), 0) * (e + h - p1)) AS naive_drift, greatest(0.0, coalesce((sy - (n * sty - st * sy) / (n * stt - st * st) * st) / n + (n * sty - st * sy) / (n * stt - st * st) * (e + h), l)) AS trend FROM (SELECT region, segment, arg_max(value, period)::DOUBLE AS l, arg_min(value, period)::DOUBLE AS f, max(period) AS p1, min(period) AS p0, count(*) AS n, sum(period)::DOUBLE AS st, sum(value)::DOUBLE AS sy, sum(period * period)::DOUBLE AS stt, sum(period * value)::DOUBLE AS sty FROM panel GROUP BY ALL), (SELECT max(period) AS e FROM panel), (SELECT unnest([1, 6, 12]) AS h)", N)(lambda s, d: forecast.forecast(A.panel(s, d), SERIES, [1, 6, 12]))
query("l6_features", "SELECT region, segment, period, value, lag(value) OVER w AS lag_1, lag(value, 2) OVER w AS lag_2, lag(value, 3) OVER w AS lag_3, round(avg(value) OVER (w ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING), 6) AS rolling_mean_3, (lag(value) OVER w - lag(value, 2) OVER w) / nullif(lag(value, 2) OVER w, 0) AS growth, (lag(value) OVER w - lag(value, 5) OVER w) / 4 AS trend FROM (SELECT g.region, g.segment, g.period, value::DOUBLE AS value FROM (SELECT region, segment, unnest(range((SELECT min(period) FROM panel), (SELECT max(period) FROM panel) + 1))::INT AS period FROM (SELECT DISTINCT region, segment FROM panel)) g LEFT JOIN panel p ON g.region = p.region AND g.segment = p.segment AND g.period = p.period) WINDOW w AS (PARTITION BY region, segment ORDER BY period)", N)(lambda s, d: forecast.features(A.panel(s, d), SERIES))
query("l10_folds", "SELECT row_number() OVER (ORDER BY t) AS fold, t AS train_end, least(t + 12, b) AS test_end FROM (SELECT unnest(range(min(period) + 35, max(period), 12)) AS t, max(period) AS b FROM panel)", N)(lambda s, d: forecast.folds(A.panel(s, d), 36, 12))
query("l12_breaks", "SELECT region, segment, period, value, round((value - past) / past * 100, 6) AS deviation_pct FROM (SELECT *, avg(value) OVER (PARTITION BY region, segment ORDER BY period ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING) AS past, row_number() OVER (PARTITION BY region, segment ORDER BY period) AS n FROM panel) WHERE n >= 3 AND past > 0 AND abs((value - past) / past) >= 0.15", N)(lambda s, d: forecast.breaks(A.panel(s, d), SERIES))
L11 = """seen AS (SELECT period, row_number() OVER (ORDER BY period) AS i, count(*) OVER () AS m FROM (SELECT DISTINCT period FROM panel)),
cuts AS (SELECT a.period AS train_end, b.period AS test_end FROM seen a JOIN seen b ON b.i = least(a.i + 12, a.m) WHERE a.i >= 36 AND a.i < a.m AND (a.i - 36) % 12 = 0),
fit AS (SELECT train_end, test_end, region, segment, arg_max(value, period)::DOUBLE AS l, arg_min(value, period)::DOUBLE AS f, max(period) AS p1, min(period) AS p0, count(*) AS n, sum(period)::DOUBLE AS st, sum(value)::DOUBLE AS sy,
  sum(period * period)::DOUBLE AS stt, sum(period * value)::DOUBLE AS sty FROM panel JOIN cuts ON period <= train_end GROUP BY ALL),
line AS (SELECT *, (n * sty - st * sy) / nullif(n * stt - st * st, 0) AS slope FROM fit),
said AS (SELECT p.value::DOUBLE AS actual, greatest(0.0, l) AS naive, greatest(0.0, l + coalesce((l - f) / nullif(p1 - p0, 0), 0) * (p.period - p1)) AS naive_drift,
  greatest(0.0, CASE WHEN n >= 2 THEN coalesce((sy - slope * st) / n + slope * p.period, l) ELSE l END) AS trend
  FROM line JOIN panel p ON p.region = line.region AND p.segment = line.segment AND p.period > train_end AND p.period <= test_end),
each AS (SELECT actual, 'naive' AS model, naive AS y FROM said UNION ALL SELECT actual, 'naive_drift', naive_drift FROM said UNION ALL SELECT actual, 'trend', trend FROM said),
compared AS (SELECT model, round(avg(abs(actual - y)), 6) AS mae, round(sqrt(avg((actual - y) * (actual - y))), 6) AS rmse, round(avg(abs(actual - y) / abs(actual) * 100) FILTER (WHERE abs(actual) >= 1e-9), 6) AS mape,
  round(avg(abs(actual - y) * 200 / (abs(actual) + abs(y))) FILTER (WHERE abs(actual) + abs(y) >= 1e-9), 6) AS smape, count(*) AS n FROM each GROUP BY model)"""
L14 = """champion AS (SELECT CASE WHEN b.mape < n.mape THEN b.model ELSE 'naive' END AS model, b.mape AS best_mape, n.mape AS naive_mape FROM (SELECT * FROM compared WHERE model NOT LIKE 'naive%' ORDER BY mape LIMIT 1) b, (SELECT * FROM compared WHERE model = 'naive') n)"""
query("l11_walk_forward", "SELECT * FROM compared", N, L11)(lambda s, d: forecast.walk_forward(A.panel(s, d), SERIES, 36, 12))
query("l14_champion", "SELECT * FROM champion", N, L11, L14)(lambda s, d: forecast.champion(forecast.walk_forward(A.panel(s, d), SERIES, 36, 12)))
