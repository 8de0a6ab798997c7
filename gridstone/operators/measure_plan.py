"""Several KPI measures in several groupings from one aggregate for each fact.

A measure is a node of a graph: a base (the sum of a column of one fact, where a condition holds), an expression over nodes in the same grouping, a window over
such, a fold (an aggregate of nodes in a finer grouping), or a comparison with a coarser grouping. Resolving a request gives the bases and groupings that each
fact has to serve. Each fact is read once: its rows are summed to the finest grouping, that to all groupings with their years by grouping sets, and the small result is
kept. All that follows - the latest year of a context, ratios, ranks, folds - works on kept results.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import ratio, tier
from ..sources.storage import checkpointed
from .measures import Star, meet, year_before

Groups = tuple[str, ...]


@dataclass(frozen=True)
class Base:
    """Sum of a fact's column where a condition holds. period: bases whose latest common year counts where years aren't grouped by; without it, all years."""

    fact: str
    column: str
    where: Callable[[Star], Column] | None = None
    period: tuple[str, ...] = ()
    count: bool = False

    def aggregate(self, star: Star) -> Column:
        value = F.col(self.column) if self.where is None else F.when(self.where(star), F.col(self.column))
        return F.count(value) if self.count else F.sum(value)


@dataclass(frozen=True)
class Expr:
    """A column computed from other nodes' columns; it may be a window over the grouping."""

    inputs: tuple[str, ...]
    column: Callable[[Star, list[str]], Column]


@dataclass(frozen=True)
class Fold:
    """An aggregate of nodes in a grouping that is finer by some columns. steps: columns computed there before."""

    inputs: tuple[str, ...]
    finer: Groups
    aggregate: Callable[[Star], Column]
    steps: Callable[[list[str]], dict[str, Column]] = lambda groups: {}
    result: Callable[[Column], Column] = lambda c: c


@dataclass(frozen=True)
class Against:
    """A node beside the same one in a grouping without a column, as column(mine, whole)."""

    node: str
    without: str
    column: Callable[[Column, Column], Column]


def share(a: str, b: str, times: float = 1.0) -> Expr:
    return Expr((a, b), lambda star, groups: ratio(F.col(a), F.col(b), times))


def same(a: str, digits: int | None = None) -> Expr:
    return Expr((a,), lambda star, groups: F.col(a) if digits is None else F.round(a, digits))


def per_year(groups: list[str]) -> Window:
    return Window.partitionBy(*[g for g in groups if g != "year"]).orderBy("year")


def severity(star: Star, groups: list[str]) -> Column:
    w = Window.partitionBy(*[g for g in groups if g != "country_code"]).orderBy(F.col("gap").desc_nulls_last())
    return F.when(F.col("gap").isNotNull(), F.dense_rank().over(w))


def risk(star: Star, groups: list[str]) -> Column:
    one = lambda c: F.when(c.isNotNull(), F.least(F.lit(1.0), c))
    pressure = one(ratio(ratio(F.col("beds"), F.col("second_all")), F.lit(star.constant("beds_per_nurse"))))
    scarcity = one(ratio(F.lit(star.constant("icu_share")), ratio(F.col("icu"), F.col("beds"))))
    leaving = one(ratio(F.col("near"), F.col("banded")) / F.lit(star.constant("retirement")))
    return F.round((pressure * 0.40 + scarcity * 0.35 + leaving * 0.25) * 100, 1)


def desert(star: Star, groups: list[str]) -> Column:
    thin = ratio(F.lit(star.constant("coverage")), ratio(F.col("region_workers"), F.col("region_people"), 1000))
    small = ratio(F.lit(star.constant("population")), F.col("region_people"))
    return F.when(thin.isNotNull(), F.round(F.least(F.lit(1.0), thin) * 70 + F.least(F.lit(1.0), small) * 30, 1))


def direction(star: Star, groups: list[str]) -> Column:
    x, cut = F.col("forecast_change"), star.constant("direction")
    return F.when(x.isNull(), "Unknown").when(x > cut, "Growing").when(x < -cut, "Shrinking").otherwise("Stable")


def head(star: Star) -> Column:
    return (F.col("measure") == "headcount_total") & (F.col("sex_code") == "T")


def band(star: Star) -> Column:
    return (F.col("measure") == "headcount_by_age") & (F.col("sex_code") == "T")


def of(which: str) -> Callable[[Star], Column]:
    return lambda star: head(star) & (F.col("profession_code") == getattr(star, which))


NOW, BOTH = ("workers_now",), ("workers_met", "people_met")
NODES: dict[str, Base | Expr | Fold | Against] = {
    # bases
    "first_now": Base("workers", "workers", of("first"), NOW),
    "second_now": Base("workers", "workers", of("second"), NOW),
    "workers_now": Base("workers", "workers", head, NOW),
    "workers_met": Base("workers", "workers", head, BOTH),
    "workers_all": Base("workers", "workers", head),
    "second_all": Base("workers", "workers", of("second")),
    "first_rows": Base("workers", "workers", of("first"), count=True),
    "second_rows": Base("workers", "workers", of("second"), count=True),
    "head_rows": Base("workers", "year", head, count=True),
    "banded": Base("workers", "workers", band),
    "near": Base("workers", "workers", lambda star: band(star) & F.col("age_group_code").isin(*star.oldest)),
    "oldest": Base("workers", "workers", lambda star: band(star) & (F.col("age_group_code") == star.oldest[1])),
    "required": Base("shortage", "required_workers"),
    "actual": Base("shortage", "actual_workers"),
    "gap": Base("shortage", "shortage"),
    "required_now": Base("shortage", "required_workers", period=("required_now",)),
    "people": Base("population", "population", lambda star: F.col("sex_code") == "T"),
    "people_met": Base("population", "population", lambda star: F.col("sex_code") == "T", BOTH),
    "beds": Base("capacity", "beds", lambda star: (F.col("category_group") == "hospital_bed") & ~F.col("is_total")),
    "icu": Base("capacity", "beds", lambda star: (F.col("category_group") == "icu_bed") & ~F.col("is_total")),
    "region_workers": Base("regional", "measure_value"),
    "region_people": Base("population_regions", "population", lambda star: F.col("is_total") & (F.col("sex_code") == "T")),
    "ahead": Base("forecast", "forecast"),
    "ahead_last": Base("forecast", "forecast", period=("ahead_last",)),
    "baseline": Base("forecast", "baseline_forecast"),
    # measures
    "total_first": same("first_now"),
    "total_second": same("second_now"),
    "total_workers": same("workers_now"),
    "required_workers": same("required"),
    "workforce_gap": same("gap"),
    "workforce_gap_share": share("gap", "required"),
    "staffing_sufficiency": share("actual", "required"),
    "retirement_risk": share("near", "banded"),
    "retirement_exposure": share("oldest", "banded"),
    "near_retirement": same("near"),
    "hospital_readiness": share("icu", "beds"),
    "hospital_beds": same("beds"),
    "icu_beds": same("icu"),
    "worker_population_ratio": share("workers_met", "people_met", 1000),
    "weighted_coverage": Fold(
        ("workers_all", "people"),
        ("country_code",),
        lambda star: F.struct(F.sum(F.when(F.col("people").isNotNull(), ratio(F.col("workers_all"), F.col("people"), 1000) * F.col("people"))).alias("x"), F.sum("people").alias("p")),
        result=lambda c: F.round(ratio(c["x"], c["p"]), 6),
    ),
    "first_reported": Expr(("first_rows", "head_rows"), lambda star, groups: F.when(F.col("head_rows") > 0, F.col("first_rows") > 0)),
    "second_reported": Expr(("second_rows", "head_rows"), lambda star, groups: F.when(F.col("head_rows") > 0, F.col("second_rows") > 0)),
    "countries_reporting": Fold(("second_rows",), ("country_code",), lambda star: F.count_if(F.col("second_rows") > 0)),
    "severity_rank": Expr(("gap",), severity),
    "gap_change": Expr(("gap",), lambda star, groups: F.col("gap") - year_before(groups, "gap")),
    "gap_rolling": Expr(("gap",), lambda star, groups: F.round(F.avg("gap").over(per_year(groups).rangeBetween(-2, 0)), 6)),
    "deteriorating": Fold(
        ("staffing_sufficiency",),
        ("country_code", "year"),
        lambda star: F.count_if(F.col("staffing_sufficiency") < F.col("before")),
        lambda groups: {"before": year_before(groups, "staffing_sufficiency")},
    ),
    "recruitment_efficiency": Expr(("gap",), lambda star, groups: ratio(year_before(groups, "gap") - F.col("gap"), F.abs(year_before(groups, "gap")))),
    "aging_against_all": Against("retirement_risk", "country_code", lambda mine, whole: ratio(mine - whole, whole)),
    "hospital_risk": Expr(("beds", "icu", "second_all", "near", "banded"), risk),
    "hospital_tier": Expr(("hospital_risk",), lambda star, groups: tier(F.col("hospital_risk"), [(75, "Critical"), (50, "High"), (25, "Medium")], "Low")),
    "regional_coverage": share("region_workers", "region_people", 1000),
    "desert_score": Expr(("region_workers", "region_people"), desert),
    "desert_tier": Expr(("desert_score",), lambda star, groups: tier(F.col("desert_score"), [(70, "Critical"), (45, "High"), (25, "Medium")], "Low")),
    "critical_regions": Fold(("desert_tier",), ("region_code",), lambda star: F.count_if(F.col("desert_tier") == "Critical")),
    "people_in_deserts": Fold(("desert_tier", "region_people"), ("region_code",), lambda star: F.sum(F.when(F.col("desert_tier").isin("Critical", "High"), F.col("region_people")))),
    "forecast_gap": Expr(("required_now", "ahead_last"), lambda star, groups: F.round(F.col("required_now") - F.col("ahead_last"), 6)),
    "forecast_workers": same("ahead", 6),
    "baseline_forecast": same("baseline", 6),
    "model_uplift": Expr(("ahead", "baseline"), lambda star, groups: F.round(F.col("ahead") - F.col("baseline"), 6)),
    "forecast_change": Fold(
        ("ahead",),
        ("year",),
        lambda star: F.struct(F.sum(F.when(F.col("year") == F.col("end") - star.constant("change_years"), F.col("ahead"))).alias("a"), F.sum(F.when(F.col("year") == F.col("end"), F.col("ahead"))).alias("b")),
        lambda groups: {"end": F.max("year").over(Window.partitionBy(F.lit(1)))},
        lambda c: F.round(ratio(c["b"] - c["a"], c["a"]), 9),
    ),
    "forecast_direction": Expr(("forecast_change",), direction),
    "equity": Fold(("staffing_sufficiency",), ("country_code",), lambda star: F.max("staffing_sufficiency") - F.min("staffing_sufficiency"), result=lambda c: ratio(F.lit(1.0), 1 + c)),
}
#: Published names for the same measure.
ALIASES = {
    "aging_index": "retirement_risk", "replacement_demand": "near_retirement", "coverage_index": "staffing_sufficiency", "future_capacity": "forecast_workers",
    "regional_risk": "hospital_risk", "access_score": "regional_coverage",
}


class Plan:
    """requests: measures and the columns to group them by, as (name, columns)."""

    def __init__(self, star: Star, requests: list[tuple[str, Groups]]):
        self.star, self.requests = star, [(n, tuple(sorted(g))) for n, g in requests]
        self.bases: dict[str, dict[Groups, set[str]]] = {}
        for name, groups in self.requests:
            self.visit(ALIASES.get(name, name), groups)
        self.small = {fact: self.summed(fact) for fact in self.bases}

    def visit(self, name: str, groups: Groups) -> None:
        node = NODES[name]
        if isinstance(node, Base):
            for base in (name, *node.period):
                self.bases.setdefault(NODES[base].fact, {}).setdefault(groups, set()).add(base)
        elif isinstance(node, Expr):
            for i in node.inputs:
                self.visit(i, groups)
        elif isinstance(node, Fold):
            for i in node.inputs:
                self.visit(i, finer(groups, node))
        else:
            self.visit(node.node, groups)
            self.visit(node.node, tuple(g for g in groups if g != node.without))

    def summed(self, fact: str) -> DataFrame:
        """set_ (number of the grouping), its columns, year_ and all bases of the fact, from one pass over it."""
        df, sets = getattr(self.star, fact), list(dict.fromkeys(tuple(c for c in s if c != "year") for s in self.bases[fact]))
        columns = list(dict.fromkeys(c for s in sets for c in s))
        if missing := [c for c in columns if c not in df.columns]:
            raise ValueError(f"{fact} has no {', '.join(missing)} to group by")
        names = sorted(set().union(*self.bases[fact].values()))
        finest = df.groupBy(*columns, F.col("year").alias("year_")).agg(*[NODES[n].aggregate(self.star).alias(n) for n in names])
        rolled = finest.groupingSets([[*map(F.col, s), F.col("year_")] for s in sets], *[F.col(c) for c in columns], F.col("year_"))
        return checkpointed(rolled.agg(F.grouping_id(*columns, "year_").alias("set_") if columns else F.lit(0).alias("set_"), *[F.sum(n).alias(n) for n in names]))

    def number(self, fact: str, groups: Groups) -> int:
        """grouping_id of a grouping: a bit for each column that is rolled up, the first one the highest."""
        columns = list(dict.fromkeys(c for s in self.bases[fact] for c in s if c != "year"))
        return sum(2 ** (len(columns) - i) for i, c in enumerate(columns) if c not in groups)

    def years(self, name: str, groups: Groups) -> DataFrame:
        fact = NODES[name].fact
        return self.small[fact].where((F.col("set_") == self.number(fact, groups)) & F.col(name).isNotNull()).select("year_").distinct()

    def sums(self, fact: str, groups: Groups) -> DataFrame:
        """The fact's bases in a grouping."""
        rows, names = self.small[fact].where(F.col("set_") == self.number(fact, groups)), sorted(self.bases[fact][groups])
        rest = [g for g in groups if g != "year"]
        if "year" in groups:
            return rows.select(*rest, F.col("year_").alias("year"), *names)
        periods = sorted({NODES[n].period for n in names} - {()})
        for i, period in enumerate(periods):
            last = reduce(lambda a, b: a.join(b, "year_"), [self.years(n, groups) for n in period]).agg(F.max("year_").alias(f"last_{i}"))
            rows = rows.crossJoin(F.broadcast(last))
        value = lambda n: F.when(F.col("year_") == F.col(f"last_{periods.index(NODES[n].period)}"), F.col(n)) if NODES[n].period else F.col(n)
        kept = rows if any(not NODES[n].period for n in names) or not periods else rows.where(reduce(Column.__or__, [F.col("year_") == F.col(f"last_{i}") for i in range(len(periods))]))
        return kept.groupBy(*rest).agg(*[F.sum(value(n)).alias(n) for n in names])

    def needed(self, names: list[str]) -> list[str]:
        """names after those in the same grouping that they are computed from."""
        out: list[str] = []
        for name in names:
            node = NODES[name]
            inputs = node.inputs if isinstance(node, Expr) else (node.node,) if isinstance(node, Against) else ()
            out += [n for n in [*self.needed(list(inputs)), name] if n not in out]
        return out

    def wide(self, groups: Groups, names: list[str]) -> DataFrame:
        """Nodes of a grouping, with what they are computed from, as columns beside those that are grouped by."""
        keys, names = sorted(groups), self.needed(names)
        nodes = {n: NODES[n] for n in names}
        parts = [self.sums(fact, groups).withColumn(f"in_{fact}", F.lit(True)) for fact in dict.fromkeys(n.fact for n in nodes.values() if isinstance(n, Base))]
        for name, node in nodes.items():
            if isinstance(node, Fold):
                fine = finer(groups, node)
                rows = self.wide(fine, list(node.inputs)).withColumns(node.steps(list(fine)))
                parts.append(rows.groupBy(*keys).agg(node.aggregate(self.star).alias("x_")).select(*keys, node.result(F.col("x_")).alias(name), F.lit(True).alias(f"in_{name}")))
        out = meet(keys, *parts)
        for name, node in nodes.items():
            if isinstance(node, Expr):
                out = out.withColumn(name, F.when(self.present(name), node.column(self.star, keys)))
            elif isinstance(node, Against):
                rest = [g for g in keys if g != node.without]
                whole = self.wide(tuple(rest), [node.node]).select(*rest, F.col(node.node).alias("whole_"))
                out = (out.join(whole, rest, "left") if rest else out.crossJoin(F.broadcast(whole))).withColumn(name, node.column(F.col(node.node), F.col("whole_"))).drop("whole_")
        return out

    def present(self, name: str) -> Column:
        """Whether a fact that the node is computed from has a row's group; the others' groups stand in a wide table too."""
        marks = {f"in_{NODES[n].fact}" if isinstance(NODES[n], Base) else f"in_{n}" for n in self.needed([name]) if isinstance(NODES[n], Base | Fold)}
        return F.coalesce(*map(F.col, sorted(marks)), F.lit(False))

    def asked(self, groups: Groups) -> list[str]:
        return [ALIASES.get(n, n) for n, g in self.requests if g == groups]

    def table(self, groups: Groups) -> DataFrame:
        """The requested measures of one grouping as columns."""
        groups = tuple(sorted(groups))
        return self.wide(groups, self.asked(groups)).select(*groups, *[F.col(ALIASES.get(n, n)).alias(n) for n, g in self.requests if g == groups])

    def rows(self) -> DataFrame:
        """measure, all columns that any request groups by (NULL where it doesn't) and value as a double; text values are in label."""
        columns = sorted({c for _, g in self.requests for c in g})
        out = []
        for groups in dict.fromkeys(g for _, g in self.requests):
            wide = self.wide(groups, self.asked(groups))
            kinds = dict(wide.dtypes)
            one = lambda n, kinds=kinds: F.struct(F.lit(n).alias("measure"), *(values(F.col(ALIASES.get(n, n)), kinds[ALIASES.get(n, n)])))
            each = [F.when(self.present(ALIASES.get(n, n)), one(n)) for n, g in self.requests if g == groups]
            stacked = wide.select(*groups, F.explode(F.array(*each)).alias("m")).where("m is not null").select(*groups, "m.*")
            out.append(stacked)
        return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), out).select("measure", *columns, "value", "label")


def values(column: Column, kind: str) -> list[Column]:
    text = kind == "string"
    return [(F.lit(None) if text else column).cast("double").alias("value"), (column if text else F.lit(None)).cast("string").alias("label")]


def finer(groups: Groups, node: Fold) -> Groups:
    return tuple(sorted({*groups, *node.finer}))


def card(star: Star, year: int, names: list[str]) -> DataFrame:
    """measure and value of names in the context of one year."""
    only = lambda df: None if df is None else df.where(F.col("year") == year)
    context = Star(only(star.workers), only(star.shortage), only(star.capacity), only(star.population), only(star.regional), only(star.population_regions), star.forecast, star.first, star.second, star.oldest, star.constants)
    return Plan(context, [(n, ()) for n in names]).rows().select("measure", F.round("value", 6).alias("value"))
