"""The library's operators on small frames; the registered queries are compared with SQL by the driver."""

import json

from pyspark.sql import functions as F

from gridstone.functions.columns import is_missing, number, ratio, sum_if, tier
from gridstone.operators import facts, forecast, grain, hierarchy, quality, views
from gridstone.sources import cubes


def cube(**changes):
    body = {
        "id": ["geo", "age", "time"],
        "size": [1, 2, 2],
        "dimension": {
            "geo": {"category": {"index": {"DE": 0}}},
            "age": {"category": {"index": {"Y30": 1, "TOTAL": 0}}},
            "time": {"category": {"index": {"2020": 0, "2021": 1}}},
        },
        "value": {"0": 10, "1": ":", "2": 0, "3": "7.5"},
        "status": {"0": "p", "3": "q"},
    } | changes
    return json.dumps(body)


def decoded(spark, *payloads):
    rows = cubes.decode(spark.createDataFrame([(p,) for p in payloads], "payload string"), ["geo", "age", "time"])
    return {(r.age, r.time): (r.value, r.status, r.status_label) for r in rows.collect()}


def test_cube_decode(spark):
    want = {("TOTAL", "2020"): (10.0, "p", "provisional"), ("Y30", "2020"): (0.0, None, None), ("Y30", "2021"): (7.5, "q", "q")}
    assert decoded(spark, cube()) == want
    lists = {k: {"category": {"index": v}} for k, v in (("geo", ["DE"]), ("age", ["TOTAL", "Y30"]), ("time", ["2020", "2021"]))}
    assert decoded(spark, cube(value=[10, None, 0, 7.5], dimension=lists)) == want


def test_cube_decode_drops_what_does_not_fit(spark):
    assert decoded(spark, cube(size=[1, 2]), cube(id="geo"), "[]", "no json") == {}
    assert decoded(spark, cube(value={"4": 1, "-1": 2, "x": 3, "0": "abc"})) == {}


def test_missing_is_not_zero(spark):
    df = spark.createDataFrame([("0",), (":",), ("",), (None,), ("NaN",), (" 1 ",)], "v string")
    assert [r[0] for r in df.select(is_missing(F.col("v"))).collect()] == [False, True, True, True, True, False]
    assert [r[0] for r in df.select(number(F.trim("v"))).collect()] == [0.0, None, None, None, None, 1.0]
    one = spark.createDataFrame([(1, 0)], "a int, b int").agg(ratio(F.sum("a"), F.sum("b")).alias("r"), sum_if(F.lit(False), F.col("a")).alias("s"), sum_if(F.lit(False), F.col("a"), True).alias("z")).first()
    assert (one.r, one.s, one.z) == (None, None, 0)
    assert spark.range(1).select(tier(F.lit(None).cast("double"), [(1, "a")], "b"), tier(F.lit(2.0), [(1, "a")], "b")).first() == ("Unknown", "a")


def test_workers_keep_totals_apart(spark):
    rows = [("DE", "2020", "T", a, "PHYS", v) for a, v in (("TOTAL", 100.0), ("Y1", 60.0), ("Y2", 30.0), ("Y3", 10.0), ("ODD", 5.0))]
    ladder = spark.createDataFrame([("Y1", "young"), ("Y2", "old"), ("Y3", "old")], "code_ string, band_ string")
    fact = facts.workers(spark.createDataFrame(rows, "geo string, time string, sex string, age string, profession string, value double"), ladder)
    assert {(r.measure, r.age_group_code): r.workers for r in fact.collect()} == {("headcount_total", None): 100, ("headcount_by_age", "young"): 60, ("headcount_by_age", "old"): 40}
    assert grain.duplicates(fact, facts.GRAIN["workers"]).count() == 0
    people = spark.createDataFrame([("DE", "T", 2020, 83_000_000)], "country_code string, sex_code string, year int, population long")
    got = facts.shortage(fact, people, spark.createDataFrame([("PHYS", 3.3)], "profession_code string, reference_per_1000 double")).first()
    assert abs(got.required_workers - 273_900) < 1e-6 and abs(got.shortage - 273_800) < 1e-6


def test_levels_do_not_fan_out(spark):
    schema = "region_code string, region_level int, country_code string, profession_code string, year int, unit string, value double"
    rows = []
    for p in ("PHYS", "NURS"):
        rows += [(c, n, "FR", p, 2015, "NR", 50.0) for c, n in (("FR10", 2), ("FR20", 2), ("FR101", 3), ("FR102", 3))]
        rows += [("DE1", 1, "DE", p, 2015, "NR", 100.0), ("DE2", 1, "DE", p, 2015, "NR", 238.0), ("DE1", 1, "DE", p, 2015, "P_HTHAB", 9.0), ("IT1", 1, "IT", p, 2015, "NR", 5.0), ("IT2", 1, "IT", p, 2015, "NR", 5.0)]
    national = spark.createDataFrame([(c, p, v) for p in ("PHYS", "NURS") for c, v in (("FR", 100.0), ("DE", 338.0), ("IT", 100.0))], "country_code string, profession_code string, national_total double")
    table = spark.createDataFrame(rows, schema)
    levels = hierarchy.detect_level(table, national)
    assert {r.country_code: (r.reporting_level, r.reconciles) for r in levels.collect()} == {"FR": (2, True), "DE": (1, True), "IT": (None, False)}
    assert sum(r.measure_value for r in hierarchy.at_reporting_level(table, levels).collect()) == 2 * 438
    assert {r.country_code: r.share for r in hierarchy.double_count(table, national).collect()}["FR"] == 2.0


def test_quality_checks(spark):
    df = spark.createDataFrame([("DE", 1.0), ("FR", None), ("FR", None)], "geo string, value double")
    status = lambda x: x.first().status
    assert status(quality.null_rate(df, ["value"])) == "FAIL" and status(quality.null_rate(df, ["geo"])) == "PASS"
    assert status(quality.null_rate(df.limit(0), ["geo"])) == "FAIL" and status(quality.duplicate_rate(df.limit(0), ["geo"])) == "WARN"
    assert status(quality.duplicate_rate(df, ["geo"])) == "FAIL" and status(quality.value_range(df, "value", 0, 0.5)) == "FAIL"
    assert status(quality.has_columns(df, ["geo", "x"])) == "FAIL"
    assert status(quality.freshness(df.withColumn("t", F.lit("nonsense")), "t", "2024-01-01")) == "FAIL"
    assert quality.score(quality.value_range(df, "value", 0, 2).unionByName(quality.null_rate(df, ["value"]))).first().score == 50.0


def test_forecasts(spark):
    rows = [("a", t, float(10 + 2 * t)) for t in range(1, 21)] + [("b", 1, 5.0)]
    panel = spark.createDataFrame(rows, "s string, period int, value double")
    got = {r.s: r for r in forecast.forecast(panel, ["s"], [5]).collect()}
    assert got["a"].naive == 50.0 and abs(got["a"].trend - 60.0) < 1e-9 and got["a"].naive_drift == 60.0 and got["b"].trend == 5.0
    gap = {r.period: r for r in forecast.features(panel.where("s = 'a' and period <> 10"), ["s"]).collect()}
    assert gap[11].lag_1 is None and gap[12].lag_1 == 32.0 and gap[10].value is None
    cuts = forecast.folds(panel, 10, 4).orderBy("fold").collect()
    assert [(r.train_end, r.test_end) for r in cuts] == [(10, 14), (14, 18), (18, 20)]
    assert forecast.champion(forecast.walk_forward(panel, ["s"], 10, 4)).first().model == "trend"
    one = spark.createDataFrame([(1.0, 2.0), (2.0, 4.0), (0.0, 1.0)], "a double, f double").agg(*[c.alias(n) for n, c in forecast.metrics(F.col("a"), F.col("f")).items()]).first()
    assert one.mape == 100.0 and abs(one.mae - 4 / 3) < 1e-12


def test_scd2_merge_closes_and_adds(spark):
    current = views.scd2_initial(spark.createDataFrame([("a", 1), ("b", 2)], "k string, v int"), "2000-01-01")
    merged = views.scd2_merge(current, spark.createDataFrame([("a", 1), ("b", 3), ("c", 4)], "k string, v int"), "k", ["v"], "2024-01-01")
    assert sorted((r.k, r.v, r.is_current, r.version) for r in merged.collect()) == [("a", 1, True, 1), ("b", 2, False, 1), ("b", 3, True, 2), ("c", 4, True, 1)]


def test_tables_round_trip(spark, tmp_path):
    manifest = cubes.write_tables({"t": spark.range(3), "u": spark.range(0)}, str(tmp_path))
    assert {r["table"]: r["rows"] for r in manifest.collect()} == {"t": 3, "u": 0}


def test_entry_imports():
    import __spark_entry__ as e

    assert set(e.oracle_sql()) <= set(e.queries())
