"""The plan of several measures against each measure by itself, and what it reads."""

import pytest
from pyspark.sql import functions as F
from test_serving import star

from gridstone.operators import measure_plan, measures
from gridstone.operators.measure_plan import ALIASES, NODES, Plan

REGIONAL = ("regional_coverage", "desert_score", "desert_tier", "critical_regions", "people_in_deserts", "access_score")


def plain(rows):
    return sorted(str(tuple(float(x) if isinstance(x, int | float) and not isinstance(x, bool) else x for x in r)) for r in rows)


def groupings(name):
    if name in ("critical_regions", "people_in_deserts"):
        return [()]
    if name in REGIONAL:
        return [("region_code", "year")]
    if name in ("deteriorating", "equity", "weighted_coverage", "countries_reporting"):
        return [(), ("year",)]
    return [("country_code", "year")] if name.startswith(("gap_", "severity", "aging_against", "recruitment")) else [("country_code",), ("country_code", "year")]


def test_every_measure_is_planned():
    assert set(measures.MEASURES) == {n for n in [*NODES, *ALIASES] if n in measures.MEASURES} and set(ALIASES.values()) <= set(NODES)


def test_one_plan_equals_each_measure(spark):
    s = star(spark, second="PHYS", constants={"beds_per_nurse": 1.5})
    by = {}
    for name in measures.MEASURES:
        for groups in groupings(name):
            if name not in ALIASES:
                by.setdefault(groups, []).append(name)
    for groups, names in by.items():
        keys, plan = sorted(groups), Plan(s, [(n, groups) for n in names])
        table = plan.table(groups).collect()
        for name in names:
            want = measures.measure(s, name, *groups).where("value is not null").select(*keys, "value").collect()
            assert plain([[*[r[k] for k in keys], r[name]] for r in table if r[name] is not None]) == plain(want), (name, groups)


def test_rows_of_several_groupings(spark):
    plan = Plan(star(spark), [("workforce_gap", ()), ("hospital_tier", ("country_code",)), ("coverage_index", ("year",))])
    rows = plan.rows()
    assert rows.columns == ["measure", "country_code", "year", "value", "label"]
    found = rows.collect()
    assert {(r.country_code, r.label) for r in found if r.measure == "hospital_tier"} == {("A", "Unknown"), ("B", "Unknown")}
    assert len([r for r in found if r.measure == "workforce_gap"]) == 1 and {r.year for r in found if r.measure == "coverage_index"} == {2020, 2021, 2022}


def test_a_ratio_takes_a_year_that_both_facts_have(spark):
    s = star(spark)
    later = s.population.where("year = 2022").withColumns({"year": F.lit(2030), "population": F.col("population") * 10})
    s2 = measures.Star(s.workers, s.shortage, s.capacity, s.population.unionByName(later), s.regional, s.population_regions, s.forecast, s.first, s.second, s.oldest, s.constants)
    for of in (s, s2):
        assert Plan(of, [("worker_population_ratio", ())]).table(()).first()[0] == measures.measure(of, "worker_population_ratio").first().value == measures.measure(s, "worker_population_ratio").first().value


def test_facts_are_read_once(spark):
    s, seen = star(spark), spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    n = s.workers.count()
    watched = measures.Star(s.workers.mapInArrow(counted, s.workers.schema), s.shortage, s.capacity, s.population, s.regional, s.population_regions, s.forecast, s.first, s.second, s.oldest, s.constants)
    plan = Plan(watched, [(m, g) for m in ("total_first", "total_workers", "retirement_risk", "first_reported", "weighted_coverage") for g in ((), ("year",), ("country_code", "year"))])
    plan.rows().collect()
    assert seen.value == n


def test_unknown_groupings_are_named(spark):
    with pytest.raises(ValueError, match="shortage has no region_code"):
        Plan(star(spark), [("workforce_gap", ("region_code",))])
