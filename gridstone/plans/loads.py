"""The registered queries of guarded loads, stable keys, landings and integrity, with their SQL."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import facts, quality, ranks
from ..operators.relations import Grain, Relation, integrity
from ..sources import landing, promotion
from ..sources.datasets import Dataset, Registry, build_views
from ..sources.storage import checkpointed, shared_folder
from . import adapter as A
from .catalog import C, ORACLES, P, R, S, W, customer_cubes, customers_of_nations, indicators_of, population_regions_of, query, regional
from .kpis import FC, HC, kept_star


def run_folder(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


# --- guarded loads ------------------------------------------------------------------------------------------------

LINES = promotion.RowChecks(("l_orderkey", "l_linenumber", "l_quantity", "l_shipdate"), (("l_quantity", 1, 50), ("l_discount", 0, 0.1)), time="l_shipdate", as_of="2002-01-01")


@query(
    "k12_guarded_load",
    """WITH t AS (SELECT count(*) AS n, count(*) FILTER (WHERE l_returnflag = 'R') AS back, count(*) FILTER (WHERE l_quantity NOT BETWEEN 1 AND 50) AS q, count(*) FILTER (WHERE l_returnflag <> 'R' AND l_quantity NOT BETWEEN 1 AND 50) AS q2,
  count(*) FILTER (WHERE l_discount NOT BETWEEN 0 AND 0.1) AS x, greatest(count(*) - count(l_orderkey), count(*) - count(l_linenumber), count(*) - count(l_quantity), count(*) - count(l_shipdate)) AS nulls,
  date_diff('day', max(l_shipdate)::DATE, DATE '2002-01-01')::DOUBLE AS days, sum(l_quantity) AS quantity, count(DISTINCT (l_orderkey, l_linenumber, l_partkey, l_suppkey)) AS keys FROM lineitem),
r AS (SELECT 'first' AS load, 'null_rate' AS name, nulls / n AS observed, nulls <= 0.05 * n AS ok FROM t UNION ALL SELECT 'first', 'range_l_quantity', q / n, q = 0 FROM t UNION ALL SELECT 'first', 'range_l_discount', x / n, x = 0 FROM t
  UNION ALL SELECT 'first', 'schema', 0, true FROM t UNION ALL SELECT 'first', 'freshness', days, days <= 900 FROM t UNION ALL SELECT 'first', 'duplicate_rate', 1 - keys / n, keys >= 0.999 * n FROM t
  UNION ALL SELECT 'second', 'null_rate', nulls / n, nulls <= 0.05 * n FROM t UNION ALL SELECT 'second', 'range_l_quantity', (q2 + back) / n, q2 + back = 0 FROM t UNION ALL SELECT 'second', 'range_l_discount', x / n, x = 0 FROM t
  UNION ALL SELECT 'second', 'schema', 0, true FROM t UNION ALL SELECT 'second', 'freshness', days, days <= 900 FROM t UNION ALL SELECT 'second', 'duplicate_rate', 1 - keys / n, keys >= 0.999 * n FROM t)
SELECT load, name, CASE WHEN ok THEN 'PASS' ELSE 'FAIL' END AS status, round(observed::DOUBLE, 9) AS observed, load = 'first' AS promoted, 1 AS current_version, n AS current_rows, quantity AS current_quantity FROM r, t""",
)
def guarded_load(spark: SparkSession, d: str) -> DataFrame:
    """Lines are loaded behind their checks; a second load with negative quantities is refused, and readers still get the first."""
    lines = A.read(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_discount", "l_returnflag", "l_shipdate")
    table = promotion.VersionedTable(spark, run_folder(spark, "lines"))
    keys = lambda staged: quality.duplicate_rate(staged, ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"], 0.001)
    loads, promoted = {"first": lines, "second": lines.withColumn("l_quantity", F.when(F.col("l_returnflag") == "R", -F.col("l_quantity")).otherwise(F.col("l_quantity")))}, set()
    results = None
    for name, rows in loads.items():
        try:
            found = promotion.guarded_write(rows, table, LINES, keys)
            promoted.add(name)
        except promotion.Blocked as e:
            found = e.results
        found = found.select(F.lit(name).alias("load"), "name", "status", F.round("observed", 9).alias("observed"), F.lit(name in promoted).alias("promoted"))
        results = found if results is None else results.unionByName(found)
    current = table.read().agg(F.count(F.lit(1)).alias("current_rows"), F.sum("l_quantity").alias("current_quantity"))
    return results.withColumn("current_version", F.lit(table.history()[-1].number)).crossJoin(F.broadcast(current))


# --- keys and ranks -----------------------------------------------------------------------------------------------


@query(
    "d2_stable_keys",
    """WITH old AS (SELECT c_name AS code, row_number() OVER (ORDER BY c_name) AS key FROM (SELECT DISTINCT c_name FROM customer JOIN orders ON o_custkey = c_custkey)),
new AS (SELECT c_name AS code, (SELECT max(key) FROM old) + row_number() OVER (ORDER BY c_name) AS key FROM (SELECT DISTINCT c_name FROM customer WHERE c_name NOT IN (SELECT code FROM old)))
SELECT code, key, 1 AS since FROM old UNION ALL SELECT code, key, 2 FROM new""",
)
def stable_keys(spark: SparkSession, d: str) -> DataFrame:
    """Keys of the customers who ordered, kept in a versioned table; a second load with all customers keeps them and adds the rest."""
    table = promotion.VersionedTable(spark, run_folder(spark, "customer-keys"))
    everyone = A.read(spark, d, "customer").select(F.col("c_name").alias("code"), "c_custkey")
    seen = A.read(spark, d, "orders").select(F.col("o_custkey").alias("c_custkey"))
    whole = promotion.RowChecks(("code", "key"), most_null=0.0)
    unique = lambda staged: quality.duplicate_rate(staged, ["key"]).unionByName(quality.duplicate_rate(staged, ["code"]).withColumn("name", F.lit("duplicate_codes")))
    promotion.guarded_write(ranks.stable_keys(everyone.join(seen, "c_custkey", "left_semi"), "code", "key"), table, whole, unique)
    promotion.guarded_write(ranks.stable_keys(everyone, "code", "key", table.read()), table, whole, unique)
    before = table.read(1).select("code", F.lit(1).alias("since"))
    return table.read().join(before, "code", "left").select("code", "key", F.coalesce("since", F.lit(2)).alias("since"))


@query(
    "w4_price_ranks",
    "SELECT o_orderkey, row_number() OVER w AS place, rank() OVER (ORDER BY o_totalprice DESC NULLS LAST) AS price_rank, dense_rank() OVER (ORDER BY o_orderpriority) AS priority_rank, (ntile(100) OVER w)::INT AS percentile FROM orders WINDOW w AS (ORDER BY o_totalprice DESC NULLS LAST, o_orderkey)",
)
def price_ranks(spark: SparkSession, d: str) -> DataFrame:
    """Every order's place among all orders, its percentile, and the rank of its priority."""
    orders = A.read(spark, d, "orders").select("o_orderkey", "o_totalprice", "o_orderpriority")
    price = ranks.By("o_totalprice", True)
    placed = ranks.ntile(ranks.positions(orders, [price, "o_orderkey"], row_number="place"), [price, "o_orderkey"], 100, "percentile")
    placed = ranks.value_ranks(ranks.value_ranks(placed, [price], "price_rank"), ["o_orderpriority"], "rows_before", "priority_rank")
    return placed.select("o_orderkey", "place", "price_rank", "priority_rank", "percentile")


# --- landings -----------------------------------------------------------------------------------------------------


@query(
    "s8_incremental_landing",
    """SELECT n_name AS geo, c_mktsegment AS age, count(*)::DOUBLE AS value, (CASE WHEN n_regionkey = 1 THEN 2 ELSE 1 END)::INT AS landing, 'segments' AS dataset_code,
  (SELECT count(DISTINCT c_nationkey) FROM customer) AS files_first, (SELECT count(DISTINCT c_nationkey) FROM customer JOIN nation ON c_nationkey = n_nationkey WHERE n_regionkey = 1 AND c_acctbal > 0) AS files_second
  FROM customer JOIN nation ON c_nationkey = n_nationkey WHERE n_regionkey <> 1 OR c_acctbal > 0 GROUP BY n_name, c_mktsegment, n_regionkey""",
)
def incremental_landing(spark: SparkSession, d: str) -> DataFrame:
    """A cube file for each nation lands; one region's files are replaced (customers with a balance), and the second landing decodes those alone."""
    folder = run_folder(spark, "landing")
    registry = Registry().add("customers", Dataset("segments", "Customers by segment", ("geo", "age")))
    taken = landing.Landing(spark, f"{folder}/landed", registry)
    customers, inbox = customers_of_nations(spark, d), f"{folder}/inbox"
    write = lambda df: customer_cubes(df).repartition("n_name").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("n_name").text(f"{inbox}/segments")
    write(customers)
    first = taken.land(inbox)
    write(customers.where("n_regionkey = 1 and c_acctbal > 0"))
    second = taken.land(inbox)
    return taken.rows("customers").select("geo", "age", "value", "landing", "dataset_code", F.lit(first.decoded).cast("long").alias("files_first"), F.lit(second.decoded).cast("long").alias("files_second"))


# --- integrity ----------------------------------------------------------------------------------------------------

LINKS = {
    "country_code": ("country", "code"),
    "profession_code": ("profession", "code"),
    "age_group_code": ("age_group", "code"),
    "sex_code": ("sex", "code"),
    "year": ("period", "year"),
    "region_code": ("region", "code"),
}
#: Facts of the star with their grain; every column of it that LINKS knows is a relation.
GRAINS = {
    "workers": ("profession_code", "age_group_code", "sex_code", "country_code", "year", "measure"),
    "retirement": ("profession_code", "age_group_code", "country_code", "year"),
    "population": ("country_code", "sex_code", "year"),
    "population_regions": ("region_code", "country_code", "age_group_code", "sex_code", "year"),
    "indicators": ("country_code", "indicator_code", "sex_code", "year"),
    "capacity": ("country_code", "year", "bed_category"),
    "shortage": ("profession_code", "country_code", "year"),
    "regional": ("region_code", "profession_code", "year"),
    "forecast": ("country_code", "profession_code", "year"),
}
LINE_LINKS = [("l_orderkey", "orders", "o_orderkey"), ("l_partkey", "part", "p_partkey"), ("l_suppkey", "supplier", "s_suppkey")]
CHECKS = [Relation(f, k, *LINKS[k]) for f, keys in GRAINS.items() for k in keys if k in LINKS] + [Relation("lineitem", *link) for link in LINE_LINKS]
CHECKS += [Grain(f, keys) for f, keys in GRAINS.items()] + [Grain("lineitem", ("l_orderkey", "l_linenumber"))]


def integrity_sql() -> str:
    """One row for each check: rows of the fact, and orphans or repeated keys."""
    tables = {"population": "people", "forecast": "fc", "retirement": f"({ORACLES['f2_retirement']})", "indicators": f"({ORACLES['f3_indicators']})", "population_regions": f"({ORACLES['f4_population_regions']})"}
    dims = {
        "country": "SELECT n_name FROM nation JOIN supplier ON s_nationkey = n_nationkey WHERE s_acctbal > 0", "profession": "SELECT profession_code FROM per", "age_group": "VALUES ('B1'), ('B2'), ('B3'), ('B4'), ('B5')",
        "sex": "SELECT l_linestatus FROM lineitem UNION SELECT 'T'", "period": "SELECT year(o_orderdate) FROM orders", "region": "SELECT n_name || '-R' FROM nation UNION SELECT n_name FROM nation",
        "orders": "SELECT o_orderkey FROM orders", "part": "SELECT p_partkey FROM part", "supplier": "SELECT s_suppkey FROM supplier",
    }
    out = []
    for c in CHECKS:
        fact = tables.get(c.fact, c.fact)
        if isinstance(c, Grain):
            out.append(f"SELECT '{c.name}' AS \"check\", 'grain' AS kind, coalesce(sum(c), 0)::BIGINT AS rows, count(*) FILTER (WHERE c > 1) AS bad FROM (SELECT count(*) AS c FROM {fact} GROUP BY {', '.join(c.keys)})")
        else:
            out.append(f"SELECT '{c.name}', 'relation', count(*), count(*) FILTER (WHERE {c.key} IS NOT NULL AND {c.key} NOT IN ({dims[c.dimension]})) FROM {fact}")
    out.sort(key=lambda q: "AS kind" not in q)  # the first one names the columns
    return f"SELECT \"check\", kind, CASE WHEN bad > 0 THEN 'FAIL' ELSE 'OK' END AS status, rows, bad FROM ({' UNION ALL '.join(out)})"


@query("f10_all_relations", integrity_sql(), W, P, C, S, R, HC, FC)
def all_relations(spark: SparkSession, d: str) -> DataFrame:
    """All relations and grains of the star and of the lines. Some are broken by intent: benchmarks for three professions, countries with a solvent supplier, periods of orders."""
    t = lambda n: A.read(spark, d, n)
    lines, orders = checkpointed(A.tidy_workers(spark, d)), checkpointed(A.tidy_population(spark, d))
    star = kept_star(spark, d, facts.workers(lines, A.ladder(spark)), facts.population(orders))
    codes = lambda *c: spark.createDataFrame([(x,) for x in c], "code string")
    nations = t("nation").select("n_nationkey", F.col("n_name").alias("code"))
    tables = {
        "workers": star.workers, "retirement": facts.retirement(star.workers, A.OLDEST), "population": star.population, "population_regions": population_regions_of(spark, lines), "indicators": indicators_of(orders), "capacity": star.capacity,
        "shortage": star.shortage, "regional": checkpointed(regional(spark, d)), "forecast": star.forecast, "lineitem": t("lineitem"), "orders": t("orders"), "part": t("part"), "supplier": t("supplier"),
        "country": t("supplier").where("s_acctbal > 0").join(nations, F.col("s_nationkey") == F.col("n_nationkey")).select("code").distinct(),
        "profession": codes(*A.PER_1000), "age_group": codes("B1", "B2", "B3", "B4", "B5"), "sex": t("lineitem").select(F.col("l_linestatus").alias("code")).distinct().union(codes("T")),
        "period": t("orders").select(F.year("o_orderdate").alias("year")).distinct(), "region": nations.select("code").union(nations.select(F.concat("code", F.lit("-R")))),
    }
    return integrity(tables, CHECKS, apart=["lineitem"]).drop("detail")


# --- views --------------------------------------------------------------------------------------------------------

#: Views in an order in which none could be built: each reads those after it.
LAYERS = {
    "layer_busy": "SELECT nation, year, orders, share FROM layer_shares WHERE share > (SELECT avg(share) FROM layer_shares)",
    "layer_shares": "WITH all_years AS (SELECT year, sum(orders) AS total FROM layer_years GROUP BY year) SELECT nation, y.year, orders, orders / CAST(total AS DOUBLE) AS share FROM layer_years y JOIN all_years a ON y.year = a.year",
    "layer_years": "SELECT nation, year(o_orderdate) AS year, count(*) AS orders FROM layer_orders GROUP BY nation, year(o_orderdate)",
}


@query(
    "s25_view_order",
    "WITH y AS (SELECT n_name AS nation, year(o_orderdate)::INT AS year, count(*) AS orders FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey GROUP BY ALL), s AS (SELECT *, orders / (sum(orders) OVER (PARTITION BY year))::DOUBLE AS share FROM y) SELECT * FROM s WHERE share > (SELECT avg(share) FROM s)",
)
def view_layers(spark: SparkSession, d: str) -> DataFrame:
    """Views over views over orders, built from declarations in the wrong order."""
    build_views(spark, {**LAYERS, "layer_orders": lambda s: A.placed_orders(s, d).select(F.col("n_name").alias("nation"), "o_orderdate")})
    return spark.table("layer_busy")
