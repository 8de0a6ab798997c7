"""KPI measures: each one an aggregate over the facts of a star, for any grouping.

A measure is evaluated in a context: the facts, filtered as the caller likes, and the columns to group by. Base measures are aggregates of one fact;
the others are expressions over base measures that meet on the grouping, so no ratio is ever averaged. What isn't reported stays NULL. Measures that compare with
the year before look at that year and not at the row before, so a gap in the years gives NULL.

Decisions where the published formulas contradict their own text: required workers are a sum; the aging index is the retirement risk; the forecast gap is
required less forecast workers (positive: too few); pressure on hospitals grows with beds for each nurse; a desert score's terms are capped one by one;
a direction's threshold is a share of 1 %. All constants are parameters.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import ratio, sum_if, tier


#: References and thresholds of the published formulas (fixed values).
CONSTANTS = {"beds_per_nurse": 0.8, "icu_share": 0.04, "retirement": 0.6, "coverage": 12.0, "population": 50_000.0, "direction": 0.01, "change_years": 4}


@dataclass(frozen=True)
class Star:
    """The facts that measures read, and the codes that their conditions name."""

    workers: DataFrame
    shortage: DataFrame
    capacity: DataFrame
    population: DataFrame
    regional: DataFrame | None = None
    population_regions: DataFrame | None = None
    forecast: DataFrame | None = None
    first: str = "PHYS"
    second: str = "NURS"
    oldest: tuple[str, str] = ("Y55_64", "Y_GE65")
    constants: dict[str, float] = field(default_factory=dict)

    def constant(self, name: str) -> float:
        return (CONSTANTS | self.constants)[name]


def headcounts(star: Star) -> DataFrame:
    return star.workers.where("measure = 'headcount_total' and sex_code = 'T'")


def bands(star: Star) -> DataFrame:
    return star.workers.where("measure = 'headcount_by_age' and sex_code = 'T'")


def latest(df: DataFrame, groups: list[str]) -> DataFrame:
    """The rows of the context's latest year; with years in the grouping, each is its own latest."""
    return df if "year" in groups else df.join(F.broadcast(df.agg(F.max("year").alias("year"))), "year", "left_semi")


def by(df: DataFrame, groups: list[str], **aggregates: Column) -> DataFrame:
    return df.groupBy(*groups).agg(*[c.alias(n) for n, c in aggregates.items()])


def meet(groups: list[str], *parts: DataFrame) -> DataFrame:
    """Parts that are grouped alike, side by side; a group that one of them lacks has NULLs there."""
    return reduce(lambda a, b: a.join(b, groups, "full") if groups else a.crossJoin(F.broadcast(b)), parts)


def chosen(df: DataFrame, groups: list[str], value: Column) -> DataFrame:
    return df.select(*groups, value.alias("value"))


# --- workforce ----------------------------------------------------------------------------------------------------


def total_of(profession: str | None):
    def measure(star: Star, groups: list[str]) -> DataFrame:
        code = {"first": star.first, "second": star.second}.get(profession)
        counted = F.lit(True) if code is None else F.col("profession_code") == code
        return by(latest(headcounts(star), groups), groups, value=sum_if(counted, F.col("workers")))

    return measure


def gap_sums(star: Star, groups: list[str]) -> DataFrame:
    return by(star.shortage, groups, required=F.sum("required_workers"), actual=F.sum("actual_workers"), gap=F.sum("shortage"))


def required_workers(star: Star, groups: list[str]) -> DataFrame:
    return chosen(gap_sums(star, groups), groups, F.col("required"))


def workforce_gap(star: Star, groups: list[str]) -> DataFrame:
    return chosen(gap_sums(star, groups), groups, F.col("gap"))


def workforce_gap_share(star: Star, groups: list[str]) -> DataFrame:
    return chosen(gap_sums(star, groups), groups, ratio(F.col("gap"), F.col("required")))


def staffing_sufficiency(star: Star, groups: list[str]) -> DataFrame:
    return chosen(gap_sums(star, groups), groups, ratio(F.col("actual"), F.col("required")))


def age_sums(star: Star, groups: list[str]) -> DataFrame:
    band = F.col("age_group_code")
    return by(bands(star), groups, banded=F.sum("workers"), near=sum_if(band.isin(*star.oldest), F.col("workers")), oldest=sum_if(band == star.oldest[1], F.col("workers")))


def retirement_risk(star: Star, groups: list[str]) -> DataFrame:
    return chosen(age_sums(star, groups), groups, ratio(F.col("near"), F.col("banded")))


def retirement_exposure(star: Star, groups: list[str]) -> DataFrame:
    return chosen(age_sums(star, groups), groups, ratio(F.col("oldest"), F.col("banded")))


def near_retirement(star: Star, groups: list[str]) -> DataFrame:
    return chosen(age_sums(star, groups), groups, F.col("near"))


def worker_population_ratio(star: Star, groups: list[str]) -> DataFrame:
    """Workers per 1000 people, both of the latest year that both facts have."""
    heads, folk = headcounts(star), star.population.where("sex_code = 'T'")
    if "year" not in groups:
        last = F.broadcast(heads.select("year").distinct().join(folk.select("year").distinct(), "year").agg(F.max("year").alias("year")))
        heads, folk = heads.join(last, "year", "left_semi"), folk.join(last, "year", "left_semi")
    both = meet(groups, by(heads, groups, workers=F.sum("workers")), by(folk, groups, people=F.sum("population")))
    return chosen(both, groups, ratio(F.col("workers"), F.col("people"), 1000))


def weighted_coverage(star: Star, groups: list[str]) -> DataFrame:
    """Workers per 1000 people of each country, weighted by its people; people of a country without workers count too."""
    each = [*dict.fromkeys([*groups, "country_code"])]
    people = by(star.population.where("sex_code = 'T'"), each, people=F.sum("population"))
    per = people.join(by(headcounts(star), each, workers=F.sum("workers")), each, "left")
    sums = by(per, groups, x=F.sum(ratio(F.col("workers"), F.col("people"), 1000) * F.col("people")), p=F.sum("people"))
    return chosen(sums, groups, F.round(ratio(F.col("x"), F.col("p")), 6))


def reported(profession: str):
    def measure(star: Star, groups: list[str]) -> DataFrame:
        return by(headcounts(star), groups, value=F.count(F.when(F.col("profession_code") == getattr(star, profession), F.col("workers"))) > 0)

    return measure


def countries_reporting(star: Star, groups: list[str]) -> DataFrame:
    return by(headcounts(star), groups, value=F.countDistinct(F.when((F.col("profession_code") == star.second) & F.col("workers").isNotNull(), F.col("country_code"))))


# --- shortage over time -------------------------------------------------------------------------------------------


def severity_rank(star: Star, groups: list[str]) -> DataFrame:
    """Rank of each country's gap, the largest first, within the rest of the grouping."""
    w = Window.partitionBy(*[g for g in groups if g != "country_code"]).orderBy(F.col("gap").desc_nulls_last())
    return chosen(gap_sums(star, groups).withColumn("r", F.dense_rank().over(w)), groups, F.when(F.col("gap").isNotNull(), F.col("r")))


def year_before(groups: list[str], column: str) -> Column:
    """The value of the year before, NULL where that year is missing."""
    w = Window.partitionBy(*[g for g in groups if g != "year"]).orderBy("year")
    return F.when(F.lag("year").over(w) == F.col("year") - 1, F.lag(column).over(w))


def gap_change(star: Star, groups: list[str]) -> DataFrame:
    return chosen(gap_sums(star, groups), groups, F.col("gap") - year_before(groups, "gap"))


def gap_rolling(star: Star, groups: list[str], years: int = 3) -> DataFrame:
    w = Window.partitionBy(*[g for g in groups if g != "year"]).orderBy("year").rangeBetween(1 - years, 0)
    return chosen(gap_sums(star, groups), groups, F.round(F.avg("gap").over(w), 6))


def deteriorating(star: Star, groups: list[str]) -> DataFrame:
    each = [*dict.fromkeys([*groups, "year", "country_code"])]
    per = staffing_sufficiency(star, each).select(*each, "value", year_before(each, "value").alias("before"))
    return by(per, groups, value=F.count_if(F.col("value") < F.col("before")))


def recruitment_efficiency(star: Star, groups: list[str]) -> DataFrame:
    per = gap_sums(star, groups).select(*groups, "gap", year_before(groups, "gap").alias("before"))
    return chosen(per, groups, ratio(F.col("before") - F.col("gap"), F.abs("before")))


def aging_against_all(star: Star, groups: list[str]) -> DataFrame:
    """Distance of each country's retirement risk from that of all countries, as a share of the latter."""
    rest = [g for g in groups if g != "country_code"]
    whole = retirement_risk(star, rest).withColumnRenamed("value", "whole")
    mine = retirement_risk(star, groups)
    both = mine.join(F.broadcast(whole), rest) if rest else mine.crossJoin(F.broadcast(whole))
    return chosen(both, groups, ratio(F.col("value") - F.col("whole"), F.col("whole")))


def equity(star: Star, groups: list[str]) -> DataFrame:
    """1 where all countries are staffed alike, less the further they are apart."""
    per = staffing_sufficiency(star, [*dict.fromkeys([*groups, "country_code"])])
    return chosen(by(per, groups, spread=F.max("value") - F.min("value")), groups, ratio(F.lit(1.0), 1 + F.col("spread")))


# --- hospitals ----------------------------------------------------------------------------------------------------


def beds(star: Star, groups: list[str]) -> DataFrame:
    group = F.col("category_group")
    return by(star.capacity, groups, beds=sum_if((group == "hospital_bed") & ~F.col("is_total"), F.col("beds")), icu=sum_if((group == "icu_bed") & ~F.col("is_total"), F.col("beds")))


def hospital_readiness(star: Star, groups: list[str]) -> DataFrame:
    return chosen(beds(star, groups), groups, ratio(F.col("icu"), F.col("beds")))


def hospital_beds(star: Star, groups: list[str]) -> DataFrame:
    return chosen(beds(star, groups), groups, F.col("beds"))


def icu_beds(star: Star, groups: list[str]) -> DataFrame:
    return chosen(beds(star, groups), groups, F.col("icu"))


def hospital_risk(star: Star, groups: list[str], published: bool = False) -> DataFrame:
    """0 to 100: workforce pressure 40 %, scarcity of intensive beds 35 %, retirement 25 %; NULL if any is unknown. published: pressure as in the published
    formula, which falls as beds for each nurse grow."""
    nurses = by(headcounts(star), groups, nurses=sum_if(F.col("profession_code") == star.second, F.col("workers")))
    all_ = meet(groups, beds(star, groups), nurses, age_sums(star, groups))
    per_nurse, reference = ratio(F.col("beds"), F.col("nurses")), F.lit(star.constant("beds_per_nurse"))
    one = lambda c: F.when(c.isNotNull(), F.least(F.lit(1.0), c))
    pressure = one(ratio(reference, per_nurse) if published else ratio(per_nurse, reference))
    scarcity = one(ratio(F.lit(star.constant("icu_share")), ratio(F.col("icu"), F.col("beds"))))
    leaving = one(ratio(F.col("near"), F.col("banded")) / F.lit(star.constant("retirement")))
    return chosen(all_, groups, F.round((pressure * 0.40 + scarcity * 0.35 + leaving * 0.25) * 100, 1))


def hospital_tier(star: Star, groups: list[str]) -> DataFrame:
    return chosen(hospital_risk(star, groups), groups, tier(F.col("value"), [(75, "Critical"), (50, "High"), (25, "Medium")], "Low"))


# --- regions ------------------------------------------------------------------------------------------------------


def region_sums(star: Star, groups: list[str]) -> DataFrame:
    people = by(star.population_regions.where("is_total and sex_code = 'T'"), groups, people=F.sum("population"))
    return meet(groups, by(star.regional, groups, workers=F.sum("measure_value")), people)


def regional_coverage(star: Star, groups: list[str]) -> DataFrame:
    return chosen(region_sums(star, groups), groups, ratio(F.col("workers"), F.col("people"), 1000))


def desert_scores(star: Star, groups: list[str]) -> DataFrame:
    """0 to 100 for each group: how thin coverage is (70 %) and how small the population (30 %), with people."""
    sums = region_sums(star, groups)
    thin = ratio(F.lit(star.constant("coverage")), ratio(F.col("workers"), F.col("people"), 1000))
    small = ratio(F.lit(star.constant("population")), F.col("people"))
    score = F.least(F.lit(1.0), thin) * 70 + F.least(F.lit(1.0), small) * 30
    return sums.select(*groups, "people", F.when(thin.isNotNull(), F.round(score, 1)).alias("value"))


def desert_score(star: Star, groups: list[str]) -> DataFrame:
    return desert_scores(star, groups).drop("people")


def desert_tiers(star: Star, groups: list[str]) -> DataFrame:
    return desert_scores(star, groups).withColumn("value", tier(F.col("value"), [(70, "Critical"), (45, "High"), (25, "Medium")], "Low"))


def desert_tier(star: Star, groups: list[str]) -> DataFrame:
    return desert_tiers(star, groups).drop("people")


def critical_regions(star: Star, groups: list[str]) -> DataFrame:
    return by(desert_tiers(star, [*dict.fromkeys([*groups, "region_code"])]), groups, value=F.count_if(F.col("value") == "Critical"))


def people_in_deserts(star: Star, groups: list[str]) -> DataFrame:
    return by(desert_tiers(star, [*dict.fromkeys([*groups, "region_code"])]), groups, value=sum_if(F.col("value").isin("Critical", "High"), F.col("people")))


# --- forecasts ----------------------------------------------------------------------------------------------------


def forecast_sums(star: Star, groups: list[str]) -> DataFrame:
    return by(star.forecast, groups, forecast=F.sum("forecast"), baseline=F.sum("baseline_forecast"))


def forecast_workers(star: Star, groups: list[str]) -> DataFrame:
    return chosen(forecast_sums(star, groups), groups, F.round("forecast", 6))


def baseline_forecast(star: Star, groups: list[str]) -> DataFrame:
    return chosen(forecast_sums(star, groups), groups, F.round("baseline", 6))


def model_uplift(star: Star, groups: list[str]) -> DataFrame:
    return chosen(forecast_sums(star, groups), groups, F.round(F.col("forecast") - F.col("baseline"), 6))


def forecast_gap(star: Star, groups: list[str]) -> DataFrame:
    """Required workers of the latest observed year less forecast workers of the last forecast year."""
    last = by(latest(star.forecast, groups), groups, forecast=F.sum("forecast"))
    need = by(latest(star.shortage, groups), groups, required=F.sum("required_workers"))
    return chosen(meet(groups, need, last), groups, F.round(F.col("required") - F.col("forecast"), 6))


def forecast_change(star: Star, groups: list[str]) -> DataFrame:
    """Change of the last forecast year against the one that is the constant ``change_years`` before it."""
    years = star.constant("change_years")
    ends = star.forecast.agg(F.max("year").alias("end"))
    rows = star.forecast.crossJoin(F.broadcast(ends))
    sums = by(rows, groups, a=F.sum(F.when(F.col("year") == F.col("end") - years, F.col("forecast"))), b=F.sum(F.when(F.col("year") == F.col("end"), F.col("forecast"))))
    return chosen(sums, groups, F.round(ratio(F.col("b") - F.col("a"), F.col("a")), 9))


def forecast_direction(star: Star, groups: list[str]) -> DataFrame:
    x, cut = F.col("value"), star.constant("direction")
    return chosen(forecast_change(star, groups), groups, F.when(x.isNull(), "Unknown").when(x > cut, "Growing").when(x < -cut, "Shrinking").otherwise("Stable"))


MEASURES = {
    "total_first": total_of("first"), "total_second": total_of("second"), "total_workers": total_of(None), "required_workers": required_workers, "workforce_gap": workforce_gap,
    "workforce_gap_share": workforce_gap_share, "staffing_sufficiency": staffing_sufficiency, "retirement_risk": retirement_risk, "retirement_exposure": retirement_exposure,
    "near_retirement": near_retirement, "hospital_readiness": hospital_readiness, "hospital_beds": hospital_beds, "icu_beds": icu_beds, "worker_population_ratio": worker_population_ratio,
    "weighted_coverage": weighted_coverage, "first_reported": reported("first"), "second_reported": reported("second"), "countries_reporting": countries_reporting, "severity_rank": severity_rank,
    "gap_change": gap_change, "gap_rolling": gap_rolling, "deteriorating": deteriorating, "aging_index": retirement_risk, "aging_against_all": aging_against_all, "replacement_demand": near_retirement,
    "hospital_risk": hospital_risk, "hospital_tier": hospital_tier, "regional_coverage": regional_coverage, "desert_score": desert_score, "desert_tier": desert_tier,
    "critical_regions": critical_regions, "people_in_deserts": people_in_deserts, "forecast_gap": forecast_gap, "model_uplift": model_uplift, "forecast_direction": forecast_direction,
    "coverage_index": staffing_sufficiency, "future_capacity": forecast_workers, "equity": equity, "regional_risk": hospital_risk, "recruitment_efficiency": recruitment_efficiency,
    "access_score": regional_coverage, "forecast_workers": forecast_workers, "baseline_forecast": baseline_forecast, "forecast_change": forecast_change,
}


def measure(star: Star, name: str, *groups: str) -> DataFrame:
    """groups and value of a measure by name."""
    return MEASURES[name](star, list(groups))


def card(star: Star, year: int, names: list[str]) -> DataFrame:
    """measure and value, one row for each of names, in the context of one year, each measure by itself; ``measure_plan.card`` gives the same rows with each fact read once."""
    only = lambda df: None if df is None else df.where(F.col("year") == year)
    context = Star(only(star.workers), only(star.shortage), only(star.capacity), only(star.population), only(star.regional), only(star.population_regions), star.forecast, star.first, star.second, star.oldest, star.constants)
    return reduce(DataFrame.unionByName, [measure(context, n).select(F.lit(n).alias("measure"), F.round(F.col("value").cast("double"), 6).alias("value")) for n in names])
