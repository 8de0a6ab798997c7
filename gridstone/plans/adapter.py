"""The domain's tables, derived from the given ones, as DataFrames and (for comparison) as SQL.

Countries are nations, professions market segments, years those of orders; sexes are line statuses with an all-up T; fine age codes are steps of
five of the quantity; beds are part sizes by part type; the mixed-level table has nations and nation-status codes under regions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.storage import checkpointed

LADDER = {f"Q{i:02d}": f"B{(i + 1) // 2}" for i in range(1, 11)}
OLDEST = ("B4", "B5")
PER_1000 = {"BUILDING": 400.0, "MACHINERY": 500.0, "AUTOMOBILE": 450.0}
FACILITIES = {"STANDARD": ("curative", "hospital_bed"), "ECONOMY": ("long-term", "hospital_bed"), "MEDIUM": ("psychiatric", "hospital_bed"), "PROMO": ("intensive", "icu_bed")}
ANCHOR = 1997


def read(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def pairs(spark: SparkSession, mapping: dict, schema: str) -> DataFrame:
    return spark.createDataFrame([(k, *(v if isinstance(v, tuple) else (v,))) for k, v in mapping.items()], schema)


def ladder(spark: SparkSession) -> DataFrame:
    return pairs(spark, LADDER, "code_ string, band_ string")


def placed_orders(spark: SparkSession, d: str) -> DataFrame:
    c = read(spark, d, "customer").join(F.broadcast(read(spark, d, "nation")), F.col("c_nationkey") == F.col("n_nationkey"))
    return read(spark, d, "orders").join(c, F.col("o_custkey") == F.col("c_custkey"))


def tidy_workers(spark: SparkSession, d: str) -> DataFrame:
    """Lines counted by country, profession, year, sex and age; totals by grouping sets of the small cube, which also gets its texts after the counting."""
    o = placed_orders(spark, d).select("o_orderkey", F.col("n_name").alias("geo"), F.col("c_mktsegment").alias("profession"), F.year("o_orderdate").alias("time"))
    lines = read(spark, d, "lineitem").select("l_orderkey", F.col("l_linestatus").alias("sex"), F.ceil(F.col("l_quantity") / 5).cast("int").alias("fives"))
    cube = lines.join(o, F.col("l_orderkey") == F.col("o_orderkey")).groupBy("geo", "profession", "time", "sex", "fives").agg(F.count(F.lit(1)).alias("value"))
    cube = cube.select("geo", "profession", F.col("time").cast("string").alias("time"), "sex", F.format_string("Q%02d", "fives").alias("age"), "value")
    keys = ["geo", "profession", "time"]
    sets = [[*keys, *more] for more in (["sex", "age"], ["sex"], ["age"], [])]
    return cube.groupingSets(sets, "sex", "age", *keys).agg(F.sum("value").cast("double").alias("value")).select(*keys, F.coalesce("sex", F.lit("T")).alias("sex"), F.coalesce("age", F.lit("TOTAL")).alias("age"), "value")


def tidy_population(spark: SparkSession, d: str) -> DataFrame:
    return placed_orders(spark, d).groupBy(F.col("n_name").alias("geo"), F.year("o_orderdate").cast("string").alias("time")).agg((F.countDistinct("o_custkey") * 1000).cast("double").alias("value")).withColumn("sex", F.lit("T"))


def tidy_beds(spark: SparkSession, d: str) -> DataFrame:
    s = read(spark, d, "supplier").join(F.broadcast(read(spark, d, "nation")), F.col("s_nationkey") == F.col("n_nationkey")).select("s_suppkey", F.col("n_name").alias("geo"))
    lines = read(spark, d, "lineitem").select("l_partkey", "l_suppkey", F.year("l_shipdate").alias("time"))
    rows = lines.join(s, F.col("l_suppkey") == F.col("s_suppkey")).join(read(spark, d, "part").select("p_partkey", "p_type", "p_size"), F.col("l_partkey") == F.col("p_partkey"))
    counts = rows.groupBy("geo", "time", F.col("p_type").alias("facility")).agg(F.sum("p_size").cast("double").alias("value")).withColumn("time", F.col("time").cast("string"))
    return counts.withColumn("unit", F.lit("NR")).unionByName(counts.withColumns({"unit": F.lit("HAB_P"), "value": F.col("value") / 1000}))


def facilities(spark: SparkSession) -> DataFrame:
    return pairs(spark, FACILITIES, "facility string, label string, category_group string")


def regional(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """The mixed-level table (two levels of codes, some rows missing) and the national totals by year. Both come from one small table of counts, kept, as level detection reads them many times."""
    o = placed_orders(spark, d).join(F.broadcast(read(spark, d, "region")), F.col("n_regionkey") == F.col("r_regionkey"))
    o = o.select(F.col("r_name").alias("country_code"), F.col("c_mktsegment").alias("profession_code"), F.year("o_orderdate").alias("year"), "n_name", "n_nationkey", "o_orderstatus", "n_regionkey")
    small = checkpointed(o.groupBy("country_code", "profession_code", "year", "n_name", "n_nationkey", "o_orderstatus", "n_regionkey").agg(F.count(F.lit(1)).alias("value")))
    keys = ["country_code", "profession_code", "year"]
    one = small.where("n_nationkey % 7 <> 0").groupBy(*keys, F.col("n_name").alias("region_code")).agg(F.sum("value").alias("value")).withColumn("region_level", F.lit(1))
    two = small.where("n_regionkey <> 2 or o_orderstatus <> 'F'").groupBy(*keys, F.concat_ws("-", "n_name", "o_orderstatus").alias("region_code")).agg(F.sum("value").alias("value")).withColumn("region_level", F.lit(2))
    return one.unionByName(two).withColumn("unit", F.lit("NR")), small.groupBy(*keys).agg(F.sum("value").alias("national_total"))


def panel(spark: SparkSession, d: str) -> DataFrame:
    """Orders by region, segment and month (numbered from 1995-01)."""
    o = placed_orders(spark, d).join(F.broadcast(read(spark, d, "region")), F.col("n_regionkey") == F.col("r_regionkey"))
    month = (F.year("o_orderdate") - 1995) * 12 + F.month("o_orderdate")
    return o.groupBy(F.col("r_name").alias("region"), F.col("c_mktsegment").alias("segment"), month.alias("period")).agg(F.count(F.lit(1)).alias("value"))


# --- the same tables in SQL ---------------------------------------------------------------------------------------

SQL_WORKERS = """c0 AS (SELECT n_name AS geo, c_mktsegment AS profession, year(o_orderdate)::INT AS year, l_linestatus AS sex,
  'Q' || lpad(ceil(l_quantity / 5)::INT::VARCHAR, 2, '0') AS age, count(*) AS value
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey GROUP BY ALL),
raw AS (SELECT * FROM c0 UNION ALL SELECT geo, profession, year, 'T', age, sum(value) FROM c0 GROUP BY ALL
  UNION ALL SELECT geo, profession, year, sex, 'TOTAL', sum(value) FROM c0 GROUP BY ALL UNION ALL SELECT geo, profession, year, 'T', 'TOTAL', sum(value) FROM c0 GROUP BY ALL),
workers AS (SELECT profession AS profession_code, CASE WHEN age <> 'TOTAL' THEN 'B' || ((substr(age, 2)::INT + 1) // 2)::VARCHAR END AS age_group_code, sex AS sex_code,
  geo AS country_code, year, CASE WHEN age = 'TOTAL' THEN 'headcount_total' ELSE 'headcount_by_age' END AS measure, sum(value)::BIGINT AS workers FROM raw GROUP BY ALL)"""
SQL_PEOPLE = """people AS (SELECT n_name AS country_code, 'T' AS sex_code, year(o_orderdate)::INT AS year, (count(DISTINCT o_custkey) * 1000)::BIGINT AS population
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey GROUP BY ALL)"""
SQL_CAPACITY = """capacity AS (SELECT n_name AS country_code, year(l_shipdate)::INT AS year,
  CASE p_type WHEN 'STANDARD' THEN 'curative' WHEN 'ECONOMY' THEN 'long-term' WHEN 'MEDIUM' THEN 'psychiatric' WHEN 'PROMO' THEN 'intensive' ELSE p_type END AS bed_category,
  CASE p_type WHEN 'PROMO' THEN 'icu_bed' ELSE 'hospital_bed' END AS category_group, false AS is_total, sum(p_size)::DOUBLE AS beds
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey JOIN part ON l_partkey = p_partkey GROUP BY ALL)"""
SQL_SHORTAGE = """per (profession_code, reference_per_1000) AS (VALUES ('BUILDING', 400.0::DOUBLE), ('MACHINERY', 500.0::DOUBLE), ('AUTOMOBILE', 450.0::DOUBLE)),
shortage AS (SELECT w.profession_code, w.country_code, w.year, population / 1000.0::DOUBLE * reference_per_1000 - workers AS shortage, workers AS actual_workers,
  population / 1000.0::DOUBLE * reference_per_1000 AS required_workers, workers * 100.0::DOUBLE / (population / 1000.0::DOUBLE * reference_per_1000) AS coverage_index, population AS total_population, reference_per_1000
  FROM workers w JOIN people p ON w.country_code = p.country_code AND w.year = p.year JOIN per ON per.profession_code = w.profession_code
  WHERE measure = 'headcount_total' AND w.sex_code = 'T')"""
SQL_REGIONAL = """r0 AS (SELECT r_name AS country_code, c_mktsegment AS profession_code, year(o_orderdate)::INT AS year, n_name, n_nationkey, o_orderstatus, n_regionkey, count(*) AS value
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY ALL),
reg AS (SELECT country_code, profession_code, year, n_name AS region_code, 1 AS region_level, sum(value)::BIGINT AS value FROM r0 WHERE n_nationkey % 7 <> 0 GROUP BY ALL
  UNION ALL SELECT country_code, profession_code, year, n_name || '-' || o_orderstatus, 2, sum(value)::BIGINT FROM r0 WHERE n_regionkey <> 2 OR o_orderstatus <> 'F' GROUP BY ALL),
nat AS (SELECT country_code, profession_code, year, sum(value)::BIGINT AS national_total FROM r0 GROUP BY ALL),
lev0 AS (SELECT country_code, profession_code, region_level, sum(value) AS regional_total, count(DISTINCT region_code) AS n_regions FROM reg WHERE year = 1997 GROUP BY ALL),
lev1 AS (SELECT l.*, national_total, abs(regional_total - national_total) / national_total AS d FROM lev0 l JOIN nat n USING (country_code, profession_code) WHERE n.year = 1997 AND n_regions >= 2),
levels AS (SELECT country_code, profession_code, national_total::BIGINT AS national_total, CASE WHEN d <= 0.05 THEN region_level END AS reporting_level, regional_total::BIGINT AS regional_total, n_regions, round(d, 5) AS rel_diff, d <= 0.05 AS reconciles
  FROM lev1 QUALIFY row_number() OVER (PARTITION BY country_code, profession_code ORDER BY d, region_level) = 1),
regional AS (SELECT region_code, region_level, country_code, profession_code, year, sum(value)::BIGINT AS measure_value FROM reg JOIN levels USING (country_code, profession_code) WHERE region_level = reporting_level GROUP BY ALL)"""
SQL_PANEL = """panel AS (SELECT r_name AS region, c_mktsegment AS segment, ((year(o_orderdate) - 1995) * 12 + month(o_orderdate))::INT AS period, count(*) AS value
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY ALL)"""
