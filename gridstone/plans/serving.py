"""The registered queries of dimensions, labelled views, extracts, the quality suite, datasets and models, with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import ratio, sum_if
from ..operators import backtest, dimensions, extracts, forecast, hierarchy, measures, models, quality, sketches, views
from ..sources import datasets
from ..sources.storage import checkpointed
from . import adapter as A
from .catalog import C, L11, L14, N, ORACLES, P, QUERIES, R, S, SERIES, V1, V2, W, capacity, checks, coverage, cube_decode, levels, people, query, regional, shortage, workers
from .kpis import FC, GS, HC, forecasts, yearly_panel

BANDS = [(f"B{i}", f"{10 * i - 9}-{10 * i}", 10 * i - 9, 10 * i) for i in range(1, 6)]
SEXES = {"F": "Female", "O": "Male", "T": "Total"}
NAMES = {n: (n.title(), "quantity") for n in ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY")}
SQL_NAMES = "upper(substr(profession_code, 1, 1)) || lower(substr(profession_code, 2)) AS profession_name"
SQL_BAND = "((substr(age_group_code, 2)::INT * 10 - 9) || '-' || (substr(age_group_code, 2)::INT * 10)) AS age_group_label, substr(age_group_code, 2)::INT - 1 AS sort_order"


def ages(spark):
    return dimensions.age_groups(spark, BANDS, A.OLDEST)


def professions(spark):
    return dimensions.professions(spark, NAMES, A.ladder(spark).select(F.lit("quantity").alias("ladder"), "code_"))


def countries(spark, d):
    return A.read(spark, d, "nation").select(F.col("n_name").alias("country_code"), F.lower("n_name").alias("country_name"))


# --- dimensions ---------------------------------------------------------------------------------------------------

query("d3_dim_age_group", "SELECT i::INT AS age_key, 'B' || i AS age_group_code, (10 * i - 9) || '-' || (10 * i) AS age_group_label, (10 * i - 9)::INT AS min_age, (10 * i)::INT AS max_age, (i - 1)::INT AS sort_order, i > 3 AS is_retirement_age FROM (SELECT DISTINCT ceil(l_quantity / 10)::INT AS i FROM lineitem)")(
    lambda s, d: dimensions.labelled(A.read(s, d, "lineitem").select(F.concat(F.lit("B"), F.ceil(F.col("l_quantity") / 10).cast("string")).alias("age_group_code")).distinct(), ages(s), "age_group_code", "age_key", "age_group_label", "min_age", "max_age", "sort_order", "is_retirement_age")
)
query("d4_dim_gender", "SELECT row_number() OVER (ORDER BY c)::INT AS gender_key, c AS sex_code, CASE c WHEN 'F' THEN 'Female' WHEN 'O' THEN 'Male' ELSE 'Total' END AS sex_label, c = 'T' AS is_total FROM (SELECT DISTINCT l_linestatus AS c FROM lineitem UNION SELECT 'T')")(
    lambda s, d: dimensions.labelled(A.read(s, d, "lineitem").select(F.col("l_linestatus").alias("sex_code")).union(s.createDataFrame([("T",)], "sex_code string")).distinct(), dimensions.genders(s, SEXES), "sex_code", "gender_key", "sex_label", "is_total")
)
query("d5_dim_profession", f"SELECT row_number() OVER (ORDER BY profession_code)::INT AS profession_key, profession_code, {SQL_NAMES}, (SELECT string_agg(DISTINCT 'Q' || lpad(ceil(l_quantity / 5)::INT::VARCHAR, 2, '0'), ',' ORDER BY 'Q' || lpad(ceil(l_quantity / 5)::INT::VARCHAR, 2, '0')) FROM lineitem) AS source_age_codes FROM (SELECT DISTINCT c_mktsegment AS profession_code FROM customer)")(
    lambda s, d: dimensions.labelled(A.read(s, d, "customer").select(F.col("c_mktsegment").alias("profession_code")).distinct(), professions(s), "profession_code", "profession_key", "profession_name", "source_age_codes")
)
query("d6_dim_specialization", "SELECT row_number() OVER (ORDER BY spec_code)::INT AS specialization_key, spec_code, lower(spec_code) AS spec_name FROM (SELECT DISTINCT o_orderpriority AS spec_code FROM orders)")(
    lambda s, d: dimensions.specializations(s, {r[0]: r[0].lower() for r in A.read(s, d, "orders").select("o_orderpriority").distinct().collect()})  # a list of a few codes
)
query("d7_dim_sector", "SELECT row_number() OVER (ORDER BY r_regionkey)::INT AS sector_key, 'S' || row_number() OVER (ORDER BY r_regionkey) AS sector_code, r_name AS sector_name FROM region")(
    lambda s, d: dimensions.sectors(s, [r[0] for r in A.read(s, d, "region").orderBy("r_regionkey").select("r_name").collect()])  # a list of a few names
)
query("d9_region_reporting", "SELECT *, 1997 AS year FROM levels", R)(lambda s, d: levels(s, d).withColumn("year", F.lit(A.ANCHOR)))

# --- labels -------------------------------------------------------------------------------------------------------

NATION = "JOIN (SELECT n_name AS country_code, lower(n_name) AS country_name FROM nation) USING (country_code)"


def labels(df: DataFrame, spark: SparkSession, d: str, *more: str) -> DataFrame:
    out = dimensions.labelled(df, countries(spark, d), "country_code", "country_name")
    if "profession" in more:
        out = dimensions.labelled(out, professions(spark), "profession_code", "profession_name")
    if "age" in more:
        out = dimensions.labelled(out, ages(spark), "age_group_code", "age_group_label", "sort_order")
    if "sex" in more:
        out = dimensions.labelled(out, dimensions.genders(spark, SEXES), "sex_code", "sex_label")
    return out


for base, more in {
    "v1_coverage_index": (), "v2_retirement_exposure": ("profession",), "v3_shortage_ranking": (), "v5_capacity_pressure": (), "v7_reporting_completeness": (), "v9_data_gaps": (), "v17_age_pyramid": ("age", "sex"), "v19_profession_shortage_rank": ("profession",),
}.items():
    shown = ["country_name", *([SQL_NAMES] if "profession" in more else []), *([SQL_BAND, "CASE sex_code WHEN 'F' THEN 'Female' WHEN 'O' THEN 'Male' ELSE 'Total' END AS sex_label"] if "age" in more else [])]
    query(f"{base}_labelled", f"SELECT v.*, {', '.join(shown)} FROM ({ORACLES[base]}) v {NATION}")(lambda s, d, base=base, more=more: labels(QUERIES[base](s, d), s, d, *more))


@query("v9_country_segment_gaps", "SELECT segment AS domain, country_code, country_name FROM (SELECT DISTINCT c_mktsegment AS segment FROM customer), (SELECT n_name AS country_code, lower(n_name) AS country_name FROM nation) WHERE NOT EXISTS (SELECT 1 FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey WHERE n_name = country_code AND c_mktsegment = segment AND o_orderdate >= TIMESTAMP '2001-03-01' AND o_orderpriority = '1-URGENT')")
def segment_gaps(spark, d):
    """Nations without an urgent order of a segment in the last months."""
    o = A.placed_orders(spark, d).where("o_orderdate >= timestamp'2001-03-01' and o_orderpriority = '1-URGENT'").select(F.col("n_name").alias("country_code"), "c_mktsegment")
    return labels(views.data_gaps(countries(spark, d).select("country_code"), **{n: o.where(F.col("c_mktsegment") == n) for n in NAMES}), spark, d)


query("v21_regional_risk_labelled", f"SELECT v.*, coalesce(country_name, region_code) AS region_name FROM ({ORACLES['v21_regional_risk']}) v LEFT JOIN (SELECT n_name AS region_code, lower(n_name) AS country_name FROM nation WHERE n_regionkey > 0) USING (region_code)")(
    lambda s, d: dimensions.labelled(QUERIES["v21_regional_risk"](s, d), A.read(s, d, "nation").where("n_regionkey > 0").select(F.col("n_name").alias("region_code"), F.lower("n_name").alias("region_name")), "region_code", "region_name", keep_unknown=True)
)

# --- forecasts ----------------------------------------------------------------------------------------------------

PAIR = ["country_code", "profession_code"]
FINAL = """final AS (SELECT fc.country_code, fc.profession_code, fc.year AS period, round(forecast, 6) AS forecast, baseline_forecast, ly AS latest_period, lo AS latest_observed, round(CASE WHEN lo <> 0 THEN (forecast - lo) / lo * 100 END, 6) AS change_vs_latest_pct, forecast > hi * 10 AS is_implausible
  FROM fc JOIN (SELECT country_code, profession_code, max(year) AS ly, arg_max(workers, year)::DOUBLE AS lo, max(workers) AS hi FROM hc GROUP BY ALL) USING (country_code, profession_code))"""


def finals(spark, d):
    found = forecasts(spark, d).withColumnRenamed("year", "period")
    out = models.final_forecasts(yearly_panel(spark, d), PAIR, found, found.withColumn("forecast", F.col("baseline_forecast")))
    return extracts.rounded(out, forecast=6, change_vs_latest_pct=6)


query("l15_final_forecasts", "SELECT * FROM final", W, HC, FC, FINAL)(finals)
query("v22_forecast_vs_baseline", f"SELECT final.*, round(forecast - baseline_forecast, 6) AS model_uplift, country_name FROM final {NATION}", W, HC, FC, FINAL)(lambda s, d: labels(extracts.rounded(models.against_baseline(finals(s, d)), model_uplift=6), s, d))
query("p18_series_keys", "SELECT region || '_' || segment AS series, count(*) AS periods, sum(value)::BIGINT AS total FROM panel GROUP BY 1", N)(lambda s, d: A.panel(s, d).groupBy(F.concat_ws("_", *SERIES).alias("series")).agg(F.count(F.lit(1)).alias("periods"), F.sum("value").alias("total")))


def ahead(spark, d) -> list[int]:
    end = A.panel(spark, d).agg(F.max("period")).first()[0]
    return [end + h for h in (1, 6, 12)]


query("l4_arima_like")(lambda s, d: models.arima_like(A.panel(s, d), SERIES, ahead(s, d)))
query("l5_piecewise_trend")(lambda s, d: models.piecewise(A.panel(s, d), SERIES, ahead(s, d)))
@query("l7_trees_and_recursion")
def trees_and_recursion(spark, d):
    panel = checkpointed(A.panel(spark, d))
    end = panel.agg(F.max("period")).first()[0]
    return models.Trees("forest", trees=20).fit(panel, SERIES).predict(panel, SERIES, [end + 1, end + 6], end=end)


query("l9_feature_importance")(lambda s, d: models.Trees("boosted", trees=10).fit(A.panel(s, d), SERIES).importance(s))


@query("l13_model_comparison")
def model_comparison(spark, d):
    """All six models over all folds; the panel of months is small beside the orders, and is written once."""
    panel = checkpointed(A.panel(spark, d))
    return backtest.scores(backtest.walk_forward_all(panel, SERIES, forecast.folds(panel, 48, 12)))


L15 = """chosen AS (SELECT region, segment, period, CASE WHEN model = 'trend' THEN trend ELSE naive END AS forecast, naive AS baseline_forecast, champion.model FROM base, champion),
seen_ AS (SELECT region, segment, max(period) AS latest_period, arg_max(value, period)::DOUBLE AS latest_observed, max(value)::DOUBLE AS largest FROM panel GROUP BY ALL)"""


@query("l15_champion_forecasts", "SELECT region, segment, c.period, round(forecast, 6) AS forecast, round(baseline_forecast, 6) AS baseline_forecast, latest_period, latest_observed, round((forecast - latest_observed) / nullif(latest_observed, 0) * 100, 6) AS change_vs_latest_pct, forecast > largest * 10 AS is_implausible, model, round(forecast - baseline_forecast, 6) AS model_uplift FROM chosen c JOIN seen_ USING (region, segment)", f"base AS ({ORACLES['l2_baseline_forecasts']})", N, L11, L14, L15)
def champion_forecasts(spark, d):
    """The champion of the walk-forward comparison makes the final table; naive is its baseline."""
    panel = checkpointed(A.panel(spark, d))
    won = forecast.champion(forecast.walk_forward(panel, SERIES, 36, 12)).select("model")
    said = forecast.forecast(panel, SERIES, [1, 6, 12]).crossJoin(F.broadcast(won))
    said = said.select(*SERIES, "period", F.when(F.col("model") == "trend", F.col("trend")).otherwise(F.col("naive")).alias("forecast"), F.col("naive").alias("baseline_forecast"), "model")
    finals = models.against_baseline(models.final_forecasts(panel, SERIES, said, said.withColumn("forecast", F.col("baseline_forecast")))).join(said.select(*SERIES, "period", "model"), [*SERIES, "period"])
    return extracts.rounded(finals, forecast=6, baseline_forecast=6, change_vs_latest_pct=6, model_uplift=6)


# --- distinct counts ----------------------------------------------------------------------------------------------


@query("a3_distinct_rollup", """SELECT country_code, year, people, true AS within_bound FROM (SELECT n_name AS country_code, year(o_orderdate)::INT AS year, count(DISTINCT o_custkey) AS people
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey GROUP BY GROUPING SETS ((n_name, year(o_orderdate)), (n_name), (year(o_orderdate)), ()))""")
def distinct_rollup(spark, d):
    """Customers by country and year, by each, and in all: rolled up from one table of sketches, and held against exact counts."""
    placed = A.placed_orders(spark, d).select(F.col("n_name").alias("country_code"), F.year("o_orderdate").alias("year"), "o_custkey")
    sets = [["country_code", "year"], ["country_code"], ["year"], []]
    rolled = sketches.rolled_up(sketches.sketched(placed, ["country_code", "year"], "o_custkey"), ["country_code", "year"], sets)
    exact = placed.groupingSets(sets, "country_code", "year").agg(F.countDistinct("o_custkey").alias("people"))
    same = rolled["country_code"].eqNullSafe(exact["country_code"]) & rolled["year"].eqNullSafe(exact["year"])
    return exact.join(rolled, same, "left").select(exact["country_code"], exact["year"], "people", sketches.within(F.col("estimate"), F.col("people")).alias("within_bound"))


# --- hierarchy ----------------------------------------------------------------------------------------------------

query("g7_reconciliation_rate", f"SELECT profession_code, count(*) AS n, avg(within::INT) AS share_within, string_agg(country_code || ' ' || year, ', ' ORDER BY r) FILTER (WHERE r <= 5) AS worst FROM (SELECT *, row_number() OVER (PARTITION BY profession_code ORDER BY rel_diff DESC, country_code, year) AS r FROM ({ORACLES['g4_reconciliation']})) GROUP BY 1")(
    lambda s, d: hierarchy.reconciliation_rate(hierarchy.reconciliation(regional(s, d), A.regional(s, d)[1]), "profession_code")
)


@query("g1_annotate", "SELECT region_code, country_code, profession_code, year, CASE WHEN n_name IS NOT NULL THEN 1 END AS level_, lower(n_name) AS region_name, value FROM reg LEFT JOIN nation ON n_name = region_code", R)
def annotated(spark, d):
    index = A.read(spark, d, "nation").select(F.col("n_name").alias("region_code"), F.lit(1).alias("level_"), F.lower("n_name").alias("region_name"))
    return hierarchy.annotate(A.regional(spark, d)[0], index).select("region_code", "country_code", "profession_code", "year", "level_", "region_name", "value")


query("p7_prefixes", "SELECT substr(n_name, 1, 8) AS prefix, count(*) AS regions, count(DISTINCT n_regionkey) AS parents FROM nation JOIN customer ON c_nationkey = n_nationkey GROUP BY 1")(
    lambda s, d: A.read(s, d, "customer").join(F.broadcast(A.read(s, d, "nation")), F.col("c_nationkey") == F.col("n_nationkey")).groupBy(F.substring("n_name", 1, 8).alias("prefix")).agg(F.count(F.lit(1)).alias("regions"), F.countDistinct("n_regionkey").alias("parents"))
)

# --- quality ------------------------------------------------------------------------------------------------------

TIDY = "tidy AS (SELECT geo, profession, year::VARCHAR AS time, sex, age, value::DOUBLE AS value FROM raw WHERE profession = 'BUILDING')"
K11 = """suite AS (SELECT 'null_rate' AS name, 'completeness' AS family, 'PASS' AS status, count(*) FILTER (WHERE value IS NULL) / count(*)::DOUBLE AS observed, 0.05::DOUBLE AS threshold, 'no nulls' AS detail, 'error' AS severity FROM tidy
UNION ALL SELECT 'duplicate_rate', 'uniqueness', CASE WHEN count(*) = sum(c) THEN 'PASS' ELSE 'FAIL' END, 1 - count(*) / sum(c)::DOUBLE, 0.0, 'key: geo+time+sex+age', 'error' FROM (SELECT count(*) AS c FROM tidy GROUP BY geo, time, sex, age)
UNION ALL SELECT 'range', 'validity', CASE WHEN count(*) FILTER (WHERE value < 0) = 0 THEN 'PASS' ELSE 'FAIL' END, count(*) FILTER (WHERE value < 0) / count(value)::DOUBLE, 0.0, (count(*) FILTER (WHERE value < 0)) || ' of ' || count(value) || ' outside [0, None]', 'error' FROM tidy
UNION ALL SELECT 'schema', 'validity', 'PASS', 0.0, 0.0, 'all present', 'error'
UNION ALL SELECT 'references', 'consistency', CASE WHEN count(*) = 0 THEN 'PASS' ELSE 'FAIL' END, count(*)::DOUBLE, 0.0, CASE WHEN count(*) = 0 THEN 'all valid' ELSE 'unknown codes: ' || string_agg(geo, ', ' ORDER BY geo) FILTER (WHERE i <= 10) END, 'error' FROM (SELECT geo, row_number() OVER (ORDER BY geo) AS i FROM (SELECT DISTINCT geo FROM tidy WHERE geo NOT IN (SELECT n_name FROM nation WHERE n_regionkey <> 3)))
UNION ALL SELECT 'completeness', 'completeness', CASE WHEN avg((c = 11)::INT) >= 0.9 THEN 'PASS' WHEN avg((c = 11)::INT) >= 0.5 THEN 'WARN' ELSE 'FAIL' END, avg((c = 11)::INT), 0.9, count(*) FILTER (WHERE c = 11) || '/' || count(*) || ' groups report all 11 codes', 'warning' FROM (SELECT count(DISTINCT age) AS c FROM tidy GROUP BY geo, time, sex)
UNION ALL SELECT 'total_reconciliation', 'consistency', CASE WHEN max(x) IS NULL THEN 'WARN' WHEN max(x) > 1 THEN 'FAIL' ELSE 'PASS' END, max(x), 1.0, count(*) FILTER (WHERE x > 1) || ' of ' || count(*) || ' complete groups beyond 1.0 %', 'error' FROM (SELECT abs(sum(value) FILTER (WHERE age <> 'TOTAL') - sum(value) FILTER (WHERE age = 'TOTAL')) / sum(value) FILTER (WHERE age = 'TOTAL') * 100.0::DOUBLE AS x FROM tidy GROUP BY geo, time, sex HAVING count(DISTINCT age) = 11)
UNION ALL SELECT 'freshness', 'timeliness', CASE WHEN datediff('day', make_date(max(time)::INT, 1, 1), DATE '2003-06-01') <= 900 THEN 'PASS' ELSE 'FAIL' END, datediff('day', make_date(max(time)::INT, 1, 1), DATE '2003-06-01')::DOUBLE, 900.0, 'newest: ' || make_date(max(time)::INT, 1, 1), 'warning' FROM tidy
UNION ALL SELECT 'coverage', 'completeness', CASE WHEN avg(h) >= 0.95 THEN 'PASS' WHEN avg(h) >= 0.7 THEN 'WARN' ELSE 'FAIL' END, avg(h), 0.95, CASE WHEN min(h) = 1 THEN 'all present' ELSE 'missing: ' || string_agg(n_name, ', ' ORDER BY n_name) FILTER (WHERE h = 0) END, 'warning' FROM (SELECT n_name, (CASE WHEN n_name IN (SELECT geo FROM tidy) THEN 1.0::DOUBLE ELSE 0 END) AS h FROM nation WHERE n_regionkey <> 3))"""


def suite(spark, d):
    """The suite on one profession, against the nations outside one region: codes of that region are unknown."""
    tidy = checkpointed(A.tidy_workers(spark, d).where("profession = 'BUILDING'").drop("profession"))  # the suite groups it in several ways
    entities = A.read(spark, d, "nation").where("n_regionkey <> 3").select(F.col("n_name").alias("geo"))
    return quality.assess(tidy, ["geo", "time", "sex", "age"], ["geo", "time", "sex"], "age", "value", 10, entities, "geo", "time", "2003-06-01")


query("k11_suite", "SELECT * FROM suite", W, TIDY, K11)(suite)
query("k12_gate", "SELECT avg(CASE status WHEN 'PASS' THEN 1.0::DOUBLE WHEN 'WARN' THEN 0.5 ELSE 0 END) * 100 AS score, count(*) FILTER (WHERE status = 'PASS') AS n_pass, count(*) FILTER (WHERE status = 'WARN') AS n_warn, count(*) FILTER (WHERE status = 'FAIL') AS n_fail, count(*) FILTER (WHERE status = 'FAIL' AND severity = 'error') AS blocking, count(*) FILTER (WHERE status = 'FAIL' AND severity = 'error') = 0 AS promoted FROM suite", W, TIDY, K11)(lambda s, d: quality.gate(suite(s, d)))

# --- datasets -----------------------------------------------------------------------------------------------------

CUBE = ORACLES["s1_cube_decode"]
REGISTRY = datasets.Registry(("no_such_cube",)).add("segments", datasets.Dataset("customers", "customers by segment", ("geo", "age"), tags=(("profession", "ALL"),), where="age <> 'FURNITURE'"))
GEOS = ["NATION_3", "NATION_7", "NATION_99"]


def tagged(spark, d, geos=None):
    return datasets.of_interest(cube_decode(spark, d), REGISTRY.known["segments"], geos)


query("s9_wanted_entities", f"SELECT *, 'ALL' AS profession FROM ({CUBE}) WHERE age <> 'FURNITURE' AND geo IN ('NATION_3', 'NATION_7', 'NATION_99')")(lambda s, d: tagged(s, d, GEOS))
query("s10_whole_table", f"SELECT *, 'ALL' AS profession FROM ({CUBE}) WHERE age <> 'FURNITURE'")(tagged)
query("s11_tagged_union", "SELECT geo, time, sex, age, value, profession FROM tidy UNION ALL SELECT geo, time, sex, NULL, value, 'MACHINES' FROM (SELECT geo, year::VARCHAR AS time, sex, value::DOUBLE AS value FROM raw WHERE profession = 'MACHINERY' AND age = 'TOTAL')", W, "tidy AS (SELECT geo, year::VARCHAR AS time, sex, age, value::DOUBLE AS value, profession FROM raw WHERE profession = 'BUILDING')")(
    lambda s, d: (lambda t: datasets.together(datasets.of_interest(t, datasets.Dataset("a", "", (), where="profession = 'BUILDING'")), datasets.of_interest(t.where("profession = 'MACHINERY'").drop("profession"), datasets.Dataset("b", "", (), where="age = 'TOTAL'", tags=(("profession", "MACHINES"),))).drop("age")))(A.tidy_workers(s, d))
)
query("s12_totals_only", "SELECT geo, year::VARCHAR AS time, profession, value::DOUBLE AS value FROM raw WHERE age = 'TOTAL' AND sex = 'T' AND year >= 1997", W)(lambda s, d: datasets.of_interest(A.tidy_workers(s, d), datasets.Dataset("c", "", (), since="1997", where="age = 'TOTAL' and sex = 'T'")).select("geo", "time", "profession", "value"))
query("s13_one_level", "SELECT region_code, country_code, profession_code, year, value FROM reg WHERE region_level = 2 AND year = 1999", R)(lambda s, d: A.regional(s, d)[0].where("region_level = 2 and year = 1999").select("region_code", "country_code", "profession_code", "year", "value"))
query("s18_run_report", f"SELECT dataset_code, coalesce(n, 0) AS rows, CASE WHEN n > 0 THEN 'OK' ELSE 'EMPTY' END AS status, NULL::VARCHAR AS error FROM (SELECT unnest(['AUTOMOBILE', 'BUILDING', 'BOATS']) AS dataset_code) LEFT JOIN (SELECT age, count(*) AS n FROM ({CUBE}) GROUP BY 1) ON age = dataset_code")(
    lambda s, d: datasets.run_report(s, ["AUTOMOBILE", "BUILDING", "BOATS"], cube_decode(s, d).withColumnRenamed("age", "dataset_code"))
)

# --- extracts -----------------------------------------------------------------------------------------------------

YEAR = 'anchor AS (SELECT coalesce(max(year) FILTER (WHERE n >= 20), max(year)) AS year FROM (SELECT year, count(first_per_1000) AS n FROM cov GROUP BY 1))'


def anchor(spark, d):
    return extracts.anchor_year(coverage(spark, d), "first_per_1000", 20)


def of_year(df: DataFrame, **values) -> dict[str, DataFrame]:
    return {n: df.groupBy("year").agg(c.alias("value")) for n, c in values.items()}


@query("x2_kpi_row", """SELECT a.year, (SELECT sum(workers)::BIGINT FROM hc WHERE profession_code = 'BUILDING' AND year = a.year) AS first, (SELECT sum(workers)::BIGINT FROM hc WHERE profession_code = 'HOUSEHOLD' AND year = a.year) AS second, (SELECT sum(gap) FROM gs WHERE year = a.year) AS gap, (SELECT sum(required) FROM gs WHERE year = a.year) AS required,
  (SELECT sum(near_retirement)::BIGINT * 100.0::DOUBLE / sum(total_by_age)::BIGINT FROM rex WHERE year = a.year) AS retirement_risk_pct, (SELECT (sum(beds) FILTER (WHERE category_group = 'icu_bed')) * 100.0::DOUBLE / sum(beds) FILTER (WHERE category_group = 'hospital_bed') FROM capacity WHERE year = a.year) AS icu_share_pct FROM anchor a""", W, P, S, C, V1, V2, HC, GS, YEAR)
def kpi_row(spark, d):
    h, p = workers(spark, d).where(views.TOTALS), F.col("profession_code")
    parts = of_year(h, first=sum_if(p == "BUILDING", F.col("workers")), second=sum_if(p == "HOUSEHOLD", F.col("workers"))) | of_year(shortage(spark, d), gap=F.sum("shortage"), required=F.sum("required_workers"))
    parts |= of_year(views.retirement_exposure(workers(spark, d), A.OLDEST), retirement_risk_pct=ratio(F.sum("near_retirement"), F.sum("total_by_age"), 100)) | of_year(views.capacity_pressure(capacity(spark, d)), icu_share_pct=ratio(F.sum("icu_beds"), F.sum("hospital_beds"), 100))
    return extracts.kpi_row(anchor(spark, d), **parts)


query("x1_anchor_year", "SELECT year FROM anchor", W, P, V1, YEAR)(anchor)
query("x3_coverage_at_anchor", f"SELECT cov.country_code, country_name, round(first_per_1000, 6) AS first_per_1000, round(second_per_1000, 6) AS second_per_1000 FROM cov JOIN anchor USING (year) {NATION}", W, P, V1, YEAR)(
    lambda s, d: extracts.rounded(labels(extracts.at(coverage(s, d), anchor(s, d)), s, d).select("country_code", "country_name", "first_per_1000", "second_per_1000"), first_per_1000=6, second_per_1000=6)
)
RET_YEAR = "ry AS (SELECT coalesce(max(year) FILTER (WHERE n >= 10), max(year)) AS year FROM (SELECT year, count(pct_near) AS n FROM rex WHERE profession_code = 'BUILDING' GROUP BY 1))"


def exposure(spark, d):
    rows = views.retirement_exposure(workers(spark, d), A.OLDEST).where("profession_code = 'BUILDING'")
    return extracts.at(rows, extracts.anchor_year(rows, "pct_near", 10)).select("country_code", "profession_code", "pct_near", "pct_oldest")


EXPOSED = "exposed AS (SELECT country_code, profession_code, pct_near, pct_oldest, row_number() OVER (ORDER BY pct_near DESC, country_code)::INT AS rank FROM rex JOIN ry USING (year) WHERE profession_code = 'BUILDING' AND pct_near IS NOT NULL)"
query("x4_retirement_ranked", "SELECT * FROM exposed", W, V2, RET_YEAR, EXPOSED)(lambda s, d: extracts.ranked(exposure(s, d), F.col("pct_near"), "country_code"))
query("x13_top_exposure", "SELECT * FROM exposed WHERE rank <= 8", W, V2, RET_YEAR, EXPOSED)(lambda s, d: extracts.top(exposure(s, d), F.col("pct_near"), "country_code", 8))


@query("x5_age_pyramid", """SELECT country_code, profession_code, age_group_code, sex_code, sum(workers)::BIGINT AS workers FROM workers WHERE measure = 'headcount_by_age' AND sex_code <> 'T' AND profession_code = 'BUILDING'
  AND country_code = (SELECT country_code FROM (SELECT country_code FROM workers WHERE measure = 'headcount_by_age' AND sex_code <> 'T' AND profession_code = 'BUILDING' GROUP BY country_code, sex_code, age_group_code HAVING count(*) >= 5) GROUP BY 1 ORDER BY count(*) DESC, country_code LIMIT 1) GROUP BY ALL""", W)
def age_pyramid(spark, d):
    rows = views.age_pyramid(workers(spark, d)).where("profession_code = 'BUILDING'")
    return extracts.pyramid_of(rows, extracts.most_complete(rows))


query("x6_capacity_top", "SELECT country_code, hospital_beds, icu_beds, icu_share_pct, row_number() OVER (ORDER BY icu_share_pct DESC, country_code)::INT AS rank FROM (SELECT country_code, sum(beds) FILTER (WHERE category_group = 'hospital_bed') AS hospital_beds, sum(beds) FILTER (WHERE category_group = 'icu_bed') AS icu_beds, (sum(beds) FILTER (WHERE category_group = 'icu_bed')) * 100.0::DOUBLE / sum(beds) FILTER (WHERE category_group = 'hospital_bed') AS icu_share_pct FROM capacity JOIN anchor USING (year) GROUP BY 1) WHERE icu_share_pct IS NOT NULL QUALIFY rank <= 20", W, P, C, V1, YEAR)(
    lambda s, d: extracts.top(extracts.at(views.capacity_pressure(capacity(s, d)), anchor(s, d)).drop("year"), F.col("icu_share_pct"), "country_code", 20)
)
query("x7_latest_of_each_region", "SELECT * FROM regional WHERE profession_code = 'BUILDING' QUALIFY year = max(year) OVER (PARTITION BY region_code)", R)(lambda s, d: extracts.latest_of_each(regional(s, d).where("profession_code = 'BUILDING'")))
query("x8_horizons", "SELECT country_code, profession_code, period AS year, forecast, baseline_forecast, round(forecast - baseline_forecast, 6) AS model_uplift FROM final WHERE period IN (2003, 2005)", W, HC, FC, FINAL)(
    lambda s, d: extracts.horizons(extracts.rounded(models.against_baseline(finals(s, d)), model_uplift=6).withColumnRenamed("period", "year").select(*PAIR, "year", "forecast", "baseline_forecast", "model_uplift"), 2003, 2005)
)
query("x9_one_country", "SELECT country_code, year, first_per_1000, second_per_1000 FROM cov WHERE country_code = 'NATION_3'", W, P, V1)(lambda s, d: extracts.series_of(coverage(s, d), "NATION_3").select("country_code", "year", "first_per_1000", "second_per_1000"))
query("x10_breaks_top", f"SELECT series, period, value, deviation_pct, row_number() OVER (ORDER BY abs(deviation_pct) DESC, series || '/' || period)::INT AS rank FROM (SELECT region || '_' || segment AS series, period, value, deviation_pct FROM ({ORACLES['l12_breaks']})) QUALIFY rank <= 12")(
    lambda s, d: (lambda b: extracts.top(b.withColumn("k_", F.concat_ws("/", "series", "period")), F.abs("deviation_pct"), "k_", 12).drop("k_"))(forecast.breaks(A.panel(s, d), SERIES).select(F.concat_ws("_", *SERIES).alias("series"), "period", "value", "deviation_pct"))
)
query("x11_female_share", "SELECT profession_code, country_code, year, pct_female FROM (" + ORACLES["v6_sex_composition"] + ") WHERE female + male > 0")(lambda s, d: extracts.female_share(views.sex_composition(workers(s, d), "F", "O")))
query("x12_quality_block", f"SELECT 'score' AS name, score AS value FROM ({ORACLES['k10_quality_score']}) UNION ALL SELECT 'gaps', count(*)::DOUBLE FROM ({ORACLES['v9_data_gaps']}) UNION ALL SELECT 'best_mape', min(mape) FROM ({ORACLES['l11_walk_forward']}) UNION ALL SELECT 'regional_rows', count(*)::DOUBLE FROM ({ORACLES['f8_regional']}) UNION ALL SELECT 'regional_countries', count(DISTINCT country_code)::DOUBLE FROM ({ORACLES['f8_regional']})")(
    lambda s, d: quality_numbers(s, d, checkpointed(regional(s, d)))
)


def quality_numbers(spark, d, kept):
    """kept: the regional table, computed once."""
    score, gaps, mape = quality.score(checks(spark, d)).select("score"), QUERIES["v9_data_gaps"](spark, d).agg(F.count(F.lit(1))), QUERIES["l11_walk_forward"](spark, d).agg(F.min("mape"))
    return extracts.quality_block(score=score, gaps=gaps, best_mape=mape, regional_rows=kept.agg(F.count(F.lit(1))), regional_countries=kept.agg(F.countDistinct("country_code")))
