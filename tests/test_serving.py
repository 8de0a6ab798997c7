"""Measures, dimensions, extracts, the quality gate, datasets and models on small frames; the registered queries are compared with SQL by the driver."""

import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from gridstone.operators import dimensions, extracts, facts, forecast, grain, hierarchy, measures, models, quality, views
from gridstone.sources import datasets
from gridstone.sources.cubes import FLAGS, landing_audit, read_cubes


def star(spark, **changes):
    w = [("PHYS", None, "T", c, y, "headcount_total", n) for c, y, n in (("A", 2020, 90), ("A", 2022, 80), ("B", 2020, 50), ("B", 2021, 55), ("B", 2022, None))]
    w += [("NURS", None, "T", "B", 2022, "headcount_total", 200)] + [("PHYS", b, "T", "A", 2022, "headcount_by_age", n) for b, n in (("Y_LT35", 40), ("Y55_64", 30), ("Y_GE65", 10))]
    short = [("PHYS", c, y, r - a, a, r, 1000) for c, y, a, r in (("A", 2020, 90, 100.0), ("A", 2022, 80, 100.0), ("B", 2021, 55, 50.0), ("B", 2022, 40, 50.0))]
    beds = [("A", 2022, "curative", "hospital_bed", False, 60.0), ("A", 2022, "total", "hospital_bed", True, 60.0), ("A", 2022, "adult", "icu_bed", False, 3.0), ("B", 2022, "curative", "hospital_bed", False, 160.0)]
    people, years = [(c, "T", y, 1000 * (1 + (c == "B"))) for c in "AB" for y in (2020, 2021, 2022)], [("A", "PHYS", 2023, 70.0, 80.0), ("A", "PHYS", 2027, 35.0, 80.0)]
    frame = lambda rows, schema: spark.createDataFrame(rows, schema)
    return measures.Star(
        frame(w, "profession_code string, age_group_code string, sex_code string, country_code string, year int, measure string, workers long"),
        frame(short, "profession_code string, country_code string, year int, shortage double, actual_workers long, required_workers double, total_population long"),
        frame(beds, "country_code string, year int, bed_category string, category_group string, is_total boolean, beds double"),
        frame(people, "country_code string, sex_code string, year int, population long"),
        frame([("A1", "A", 2022, 10), ("A2", "A", 2022, 1)], "region_code string, country_code string, year int, measure_value long"),
        frame([("A1", "T", 2022, 1000, True), ("A2", "T", 2022, 1000, True), ("A2", "T", 2022, 400, False), ("A3", "T", 2022, 5, True)], "region_code string, sex_code string, year int, population long, is_total boolean"),
        frame(years, "country_code string, profession_code string, year int, forecast double, baseline_forecast double"),
        **changes,
    )


def test_measures(spark):
    s = star(spark)
    got = lambda name, *groups: {tuple(r)[:-1] if len(groups) != 1 else r[0]: r.value for r in measures.measure(s, name, *groups).collect()}
    assert got("total_first", "country_code") == {"A": 80, "B": None} and got("total_first")[()] == 80
    assert got("gap_change", "country_code", "year") == {("A", 2020): None, ("A", 2022): None, ("B", 2021): None, ("B", 2022): 15.0}  # a missing year is no year before
    assert got("gap_rolling", "country_code", "year")["A", 2022] == 15.0 and got("severity_rank", "country_code", "year")["B", 2022] == 2
    assert got("deteriorating", "year") == {2020: 0, 2021: 0, 2022: 1} and got("countries_reporting", "year")[2022] == 1
    assert got("first_reported", "country_code", "year")["B", 2022] is False and got("retirement_risk", "country_code") == {"A": 0.5}
    assert got("hospital_beds", "country_code")["A"] == 60.0  # the total isn't one of its parts
    assert got("hospital_readiness", "country_code") == {"A": 0.05, "B": None} and got("hospital_risk", "country_code") == {"A": None, "B": None}
    assert got("hospital_tier", "country_code") == {"A": "Unknown", "B": "Unknown"}
    assert got("regional_coverage", "region_code") == {"A1": 10.0, "A2": 1.0, "A3": None} and got("desert_tier", "region_code") == {"A1": "Critical", "A2": "Critical", "A3": "Unknown"}
    assert got("critical_regions")[()] == 2 and got("people_in_deserts")[()] == 2000
    assert got("forecast_change", "country_code") == {"A": -0.5} and got("forecast_direction", "country_code") == {"A": "Shrinking"} and got("forecast_gap", "country_code")["A"] == 65.0
    assert abs(got("equity", "year")[2022] - 1.0) < 1e-12 and got("recruitment_efficiency", "country_code", "year")["B", 2022] == -3.0
    assert abs(got("weighted_coverage", "year")[2022] - 280 / 3) < 1e-6
    assert {r.measure: r.value for r in measures.card(s, 2022, ["total_second", "workforce_gap"]).collect()} == {"total_second": 200.0, "workforce_gap": 30.0}
    risk = star(spark, second="PHYS", constants={"beds_per_nurse": 1.5})
    assert measures.hospital_risk(risk, ["country_code"]).where("country_code = 'A'").first().value is not None
    plain, published = (measures.hospital_risk(risk, ["country_code", "year"], x).where("country_code = 'A' and year = 2022").first().value for x in (False, True))
    assert plain == 68.8 and published == 88.8  # pressure 0.5 or 1 (capped), scarcity 0.8, retirement 0.5 / 0.6


def test_dimensions(spark):
    ages = dimensions.age_groups(spark, [("Y_LT35", "under 35", 0, 34), ("Y_GE65", "65 and over", 65, None)], ("Y_GE65",))
    assert {(r.age_group_code, r.sort_order, r.is_retirement_age) for r in ages.collect()} == {("Y_LT35", 0, False), ("Y_GE65", 1, True)}
    assert [r.sex_code for r in dimensions.genders(spark, {"T": "Total", "F": "Female"}).orderBy("gender_key").collect()] == ["F", "T"]
    ladders = spark.createDataFrame([("n", "Y2"), ("n", "Y1"), ("p", "Y9")], "ladder string, code_ string")
    rows = dimensions.professions(spark, {"NURS": ("Nurse", "n"), "PHYS": ("Physician", "p"), "X": ("Other", "none")}, ladders).collect()
    assert {r.profession_code: r.source_age_codes for r in rows} == {"NURS": "Y1,Y2", "PHYS": "Y9", "X": None}
    assert dimensions.sectors(spark, ["Public", "Private"]).orderBy("sector_key").first().sector_code == "S1" and dimensions.specializations(spark, {"b": "B", "a": "A"}).count() == 2
    fact = spark.createDataFrame([("Y_LT35", 1), ("odd", 2)], "age_group_code string, n int")
    assert dimensions.labelled(fact, ages, "age_group_code", "age_group_label").count() == 1
    assert {r.age_group_label for r in dimensions.labelled(fact, ages, "age_group_code", "age_group_label", keep_unknown=True).collect()} == {"under 35", "odd"}


def test_extracts(spark):
    df = spark.createDataFrame([("a", 2020, 1.0), ("b", 2020, float("nan")), ("a", 2021, 3.0), ("b", 2021, None)], "country_code string, year int, x double")
    clean = extracts.without_nan(df)
    assert [r.x for r in clean.where("year = 2020").orderBy("country_code").collect()] == [1.0, None]
    assert extracts.anchor_year(df, "x", 2).first().year == 2020 and extracts.anchor_year(df, "x", 3).first().year == 2021
    assert [(r.country_code, r["rank"]) for r in extracts.top(clean, F.col("x"), "country_code", 1).collect()] == [("a", 1)]
    assert {r.year for r in extracts.latest_of_each(df, "country_code").collect()} == {2021} and extracts.rounded(df, x=0).first().x == 1.0
    cells = spark.createDataFrame([(c, s, "Y", y, "P", 1) for c, s in (("a", "F"), ("b", "F"), ("b", "M")) for y in range(5)], "country_code string, sex_code string, age_group_code string, year int, profession_code string, workers long")
    assert extracts.most_complete(cells).first().country_code == "b" and extracts.pyramid_of(cells, extracts.most_complete(cells)).count() == 2


def test_details_and_gate(spark):
    df = spark.createDataFrame([("DE", "2020", "T", "TOTAL", 10.0), ("DE", "2020", "T", "Y1", 6.0), ("DE", "2020", "T", "Y2", 3.0), ("XX", "2020", "T", "TOTAL", None)], "geo string, time string, sex string, age string, value double")
    valid = spark.createDataFrame([("DE",), ("FR",)], "geo string")
    rows = quality.assess(df, ["geo", "time", "sex", "age"], ["geo", "time", "sex"], "age", "value", 2, valid, "geo", "time", "2021-01-01").persist()
    got = {r.name: (r.status, r.detail) for r in rows.collect()}
    assert rows.columns == quality.COLUMNS and len(got) == 9
    assert got["null_rate"] == ("FAIL", "worst column: value") and got["references"] == ("FAIL", "unknown codes: XX") and got["coverage"] == ("FAIL", "missing: FR")
    assert got["completeness"] == ("WARN", "1/2 groups report all 3 codes") and got["total_reconciliation"] == ("FAIL", "1 of 1 complete groups beyond 1.0 %")
    assert got["duplicate_rate"] == ("PASS", "key: geo+time+sex+age") and got["freshness"] == ("PASS", "newest: 2020-01-01") and got["schema"] == ("PASS", "all present")
    assert quality.gate(rows).first().promoted is False
    with pytest.raises(ValueError, match="null_rate"):
        quality.gate(rows, strict=True)
    assert quality.duplicate_rate(df, ["nothing"]).first().status == "WARN" and quality.value_range(df.limit(0), "value", 0).first().status == "WARN"
    assert quality.value_range(df, "value", 0, 9).first().status == "FAIL"  # both bounds count


def test_datasets(spark, tmp_path):
    body = lambda geo, values: json.dumps({"id": ["geo", "time"], "size": [1, 3], "dimension": {"geo": {"category": {"index": {geo: 0}}}, "time": {"category": {"index": ["2019", "2020", "2021"]}}}, "value": values, "status": {"1": "be"}})
    (tmp_path / "cubes").mkdir()
    for geo, values in (("DE", [1, 2, 3]), ("FR", [4, ":", 6]), ("IT", [":", ":", ":"])):
        (tmp_path / "cubes" / f"{geo}.json").write_text(body(geo, values))
    (tmp_path / "cubes" / "bad.json").write_text("no json")
    registry = datasets.Registry(("gone",)).add("p", datasets.Dataset("cube_p", "people", ("geo", "time"), since="2020", tags=(("kind", "x"),)))
    with pytest.raises(ValueError):
        registry.add("q", datasets.Dataset("gone", "", ()))
    path = f"{tmp_path}/cubes/*.json"
    rows = registry.load(spark, "p", path, ["DE", "IT"])
    assert {(r.geo, r.time, r.value, r.status_label, r.kind, r.dataset_code) for r in rows.collect()} == {("DE", "2020", 2.0, FLAGS["be"], "x", "cube_p"), ("DE", "2021", 3.0, None, "x", "cube_p")}
    assert registry.load(spark, "p", path).count() == 3
    assert {r.time for r in datasets.last_periods(rows, 1).collect()} == {"2021"}
    whole = read_cubes(spark, path, ["geo", "time"], "cube_p", "people")
    audit = {r.file.rsplit("/", 1)[1]: (r.status, r.rows) for r in landing_audit(spark, path, whole).collect()}
    assert audit == {"DE.json": ("OK", 3), "FR.json": ("OK", 2), "IT.json": ("EMPTY", 0), "bad.json": ("BADJSON", 0)}
    report = {r.dataset_code: (r.status, r["rows"]) for r in datasets.run_report(spark, ["cube_p", "none", "broken"], whole, {"broken": "timeout"}).collect()}
    assert report == {"cube_p": ("OK", 5), "none": ("EMPTY", 0), "broken": ("FAIL", 0)}
    both = datasets.together(rows.drop("kind"), rows.drop("status"))
    assert both.where("kind is null").count() == 2 and both.count() == 4
    assert datasets.hierarchy_index(spark, f"{tmp_path}/none.json").columns == ["region_code", "region_level", "region_name", "country_code"]
    (tmp_path / "index.json").write_text('{"region_code": "DE1", "region_level": 1, "region_name": "South", "country_code": "DE"}')
    regional = spark.createDataFrame([("DE1", None, 5.0), ("FR1", None, 6.0)], "region_code string, country_code string, value double")
    index = datasets.hierarchy_index(spark, f"{tmp_path}/index.json").drop("country_code")
    assert {(r.country_code, r.region_level) for r in hierarchy.annotate(regional, index).collect()} == {("DE", 1), ("FR", None)}


def test_sinks_and_views(spark, tmp_path):
    good = spark.createDataFrame([("DE", "P", 2027, 1.5, 1.0)], "country_code string, profession_code string, year int, forecast double, baseline_forecast double")
    datasets.write_csv(good, f"{tmp_path}/csv")
    assert datasets.read_forecasts(spark, f"{tmp_path}/csv").collect() == good.collect()
    datasets.write_json(good, f"{tmp_path}/json")
    assert spark.read.json(f"{tmp_path}/json").count() == 1
    manifest = {r["table"]: (r["rows"], r.error is None) for r in datasets.export_tables({"good": good, "bad": good.select(F.raise_error(F.lit("x")).alias("y"))}, f"{tmp_path}/tables").collect()}
    assert manifest == {"good": (1, True), "bad": (None, False)}
    assert datasets.build_views(spark, {"v_one": lambda s: good, "v_two": lambda s: s.sql("select year from v_one")}) == ["v_one", "v_two"]
    with pytest.raises(ValueError, match="v_bad"):
        datasets.build_views(spark, {"v_bad": lambda s: s.sql("select nothing from v_one"), "v_three": lambda s: good})


def test_empty_facts_keep_their_columns(spark):
    tidy = spark.createDataFrame([], "geo string, time string, sex string, age string, profession string, value double")
    ladder = spark.createDataFrame([], "code_ string, band_ string")
    fact = facts.workers(tidy, ladder)
    assert fact.count() == 0 and fact.columns == [*facts.GRAIN["workers"], "workers", "measure_value"] and grain.duplicates(fact, facts.GRAIN["workers"]).count() == 0


def test_breaks_folds_and_gaps(spark):
    rows = [("a", t, v) for t, v in ((1, 10.0), (2, 20.0), (3, 15.0), (5, 30.0))]
    panel = spark.createDataFrame(rows, "s string, period int, value double")
    assert [(r.period, r.deviation_pct) for r in forecast.breaks(panel, ["s"]).orderBy("period").collect()] == [(5, 100.0)]  # the second row has no break, the third none of 15 %
    assert [(r.train_end, r.test_end) for r in forecast.folds(panel, 2, 1).orderBy("fold").collect()] == [(2, 3), (3, 5)]
    years = spark.createDataFrame([("a", 2020, 1.0), ("a", 2022, 4.0), ("a", 2023, 5.0)], "s string, year int, x double")
    assert [r.yoy_change for r in views.trend(years, "x", "s").orderBy("year").collect()] == [None, None, 1.0]


def test_levels_that_do_not_reconcile(spark):
    table = spark.createDataFrame([("IT1", 1, "IT", "P", "NR", 5.0), ("IT2", 1, "IT", "P", "NR", 5.0)], "region_code string, region_level int, country_code string, profession_code string, unit string, value double")
    national = spark.createDataFrame([("IT", "P", 100.0)], "country_code string, profession_code string, national_total double")
    kept, blank = (hierarchy.detect_level(table, national, published=x).first() for x in (False, True))
    assert (kept.reporting_level, kept.regional_total, kept.rel_diff) == (None, 10.0, 0.9) and (blank.reporting_level, blank.regional_total, blank.n_regions, blank.rel_diff) == (None, None, 0, None)


def test_models(spark):
    assert np.allclose(models.autoregression(np.arange(20.0), 3), [20, 21, 22], atol=1e-3) and models.autoregression(np.array([1.0, 2.0]), 1) is None
    assert np.allclose(models.piecewise_trend(np.arange(40.0), 2), [40, 41], atol=1.5)
    rows = [(s, t, k * 10.0 + t) for k, s in enumerate("abc") for t in range(1, 25) if (s, t) != ("a", 7)] + [("short", 1, 5.0), ("short", 2, 6.0)]
    panel = spark.createDataFrame(rows, "s string, period int, value double")
    for name in ("arima_like", "piecewise_trend"):
        got = {(r.s, r.period): (r.forecast, r.method) for r in models.MODELS[name](panel, ["s"], [25, 27]).collect()}
        assert len(got) == 8 and got["short", 25] == (6.0, "naive") and got["a", 27][1] == name and abs(got["a", 27][0] - 27) < 2
    trees = models.Trees("forest", trees=10).fit(panel, ["s"])
    out = trees.predict(panel, ["s"], [25, 26]).collect()
    assert len(out) == 8 and all(r.forecast >= 0 and r.method == "forest" for r in out)
    shares = trees.importance(spark).collect()
    assert abs(sum(r.importance for r in shares) - 1) < 1e-9 and [r.importance for r in shares] == sorted((r.importance for r in shares), reverse=True)
    few = models.Trees().fit(panel.where("s = 'short'"), ["s"]).predict(panel.where("s = 'short'"), ["s"], [3]).first()
    assert (few.forecast, few.method) == (6.0, "naive")

    def broken(train, series, periods):
        raise RuntimeError("no fit")

    said, failed = models.evaluate(panel, ["s"], [(20, [21, 22]), (22, [23, 24])], {"naive": models.naive, "drift": models.drift, "broken": broken})
    assert failed == {"broken": "RuntimeError: no fit"} and said.count() == 2 * 12
    table = {r.model: (r["rank"], r.fallback_share) for r in models.comparison(said).collect()}
    assert table == {"drift": (1, 0.0), "naive": (2, 0.0)}
    finals = models.final_forecasts(panel, ["s"], models.drift(panel, ["s"], [30]), models.naive(panel, ["s"], [30]))
    row = models.against_baseline(finals).where("s = 'b'").first()
    assert (row.latest_observed, row.baseline_forecast, row.is_implausible) == (34.0, 34.0, False) and abs(row.model_uplift - 6) < 1e-6
