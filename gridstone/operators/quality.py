"""Data-quality checks as rows: name, family, status, observed, threshold, detail, severity; and a score."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


COLUMNS = ["name", "family", "status", "observed", "threshold", "detail", "severity"]


def result(df: DataFrame, name: str, family: str, status: Column, observed: Column, threshold: float, severity: str = "error", detail: Column | None = None) -> DataFrame:
    return df.select(row(name, family, status, observed, threshold, severity, detail).alias("r")).select("r.*")


def row(name: str, family: str, status: Column, observed: Column, threshold: float, severity: str = "error", detail: Column | None = None) -> Column:
    """One check's result as a struct."""
    shown = F.lit(None).cast("string") if detail is None else detail
    return F.struct(F.lit(name).alias("name"), F.lit(family).alias("family"), status.alias("status"), observed.cast("double").alias("observed"), F.lit(float(threshold)).alias("threshold"), shown.alias("detail"), F.lit(severity).alias("severity"))


def verdict(passes: Column, warns: Column | None = None) -> Column:
    out = F.when(F.coalesce(passes, F.lit(False)), "PASS")
    return (out if warns is None else out.when(F.coalesce(warns, F.lit(False)), "WARN")).otherwise("FAIL")


def said(text: str, *values: Column) -> Column:
    return F.format_string(text, *values)


def absent(df: DataFrame, name: str, family: str, threshold: float) -> DataFrame:
    """What a check says of a table without its columns."""
    return result(df.sparkSession.range(1), name, family, F.lit("WARN"), F.lit(None).cast("double"), threshold, "warning", F.lit("columns unavailable"))


def null_row(columns: list[str], rows: Column, nulls: dict[str, Column], most: float) -> Column:
    """The worst column's share of nulls, from counts."""
    worst = F.greatest(*[F.struct((nulls[c] / rows).alias("x"), F.lit(c).alias("c")) for c in columns], F.struct(F.lit(-1.0).alias("x"), F.lit("").alias("c")))
    x = F.when(rows > 0, worst["x"])
    return row("null_rate", "completeness", verdict(x <= most), x, most, "error", F.when(x > 0, said("worst column: %s", worst["c"])).when(rows > 0, "no nulls").otherwise("table is empty"))


def null_rate(df: DataFrame, columns: list[str], most: float = 0.05) -> DataFrame:
    known = [c for c in columns if c in df.columns]
    one = df.agg(F.count(F.lit(1)).alias("n_"), *[F.count_if(F.col(c).isNull()).alias(c) for c in known])
    return one.select(null_row(known, F.col("n_"), {c: F.col(c) for c in known}, most).alias("r")).select("r.*")


def duplicate_row(keys: list[str], rows: Column, distinct: Column, most: float) -> Column:
    x = F.when(rows > 0, 1 - distinct / rows)
    return row("duplicate_rate", "uniqueness", F.when(x.isNull(), "WARN").otherwise(verdict(x <= most)), x, most, "error", F.lit("key: " + "+".join(keys)))


def duplicate_rate(df: DataFrame, keys: list[str], most: float = 0.0) -> DataFrame:
    if any(k not in df.columns for k in keys):
        return absent(df, "duplicate_rate", "uniqueness", most)
    one = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("c")).agg(F.coalesce(F.sum("c"), F.lit(0)).alias("n"), F.count(F.lit(1)).alias("d"))
    return one.select(duplicate_row(keys, F.col("n"), F.col("d"), most).alias("r")).select("r.*")


def outside(column: str, low: float | None, high: float | None) -> Column:
    c, out = F.col(column), F.lit(False)
    if low is not None:
        out = out | (c < low)
    if high is not None:
        out = out | (c > high)
    return out


def range_row(bad: Column, known: Column, low: float | None, high: float | None) -> Column:
    return row("range", "validity", F.when(known == 0, "WARN").otherwise(verdict(bad == 0)), F.try_divide(bad, known), 0, "error", said(f"%d of %d outside [{low}, {high}]", bad, known))


def value_range(df: DataFrame, column: str, low: float | None = None, high: float | None = None) -> DataFrame:
    if column not in df.columns:
        return absent(df, "range", "validity", 0)
    one = df.agg(F.count_if(outside(column, low, high)).alias("bad"), F.count(column).alias("n"))
    return one.select(range_row(F.col("bad"), F.col("n"), low, high).alias("r")).select("r.*")


def row_checks(df: DataFrame, keys: list[str], columns: list[str], ranged: str, low: float | None, high: float | None, most_null: float = 0.05, most_duplicate: float = 0.0) -> DataFrame:
    """null_rate, duplicate_rate and value_range of one table, in one scan: counts by key, then their sums."""
    nulls = {c: f"null_{c}" for c in columns}
    per = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_"), *[F.count_if(F.col(c).isNull()).alias(n) for c, n in nulls.items()], F.count_if(outside(ranged, low, high)).alias("bad_"), F.count(ranged).alias("known_"))
    zero = lambda c: F.coalesce(F.sum(c), F.lit(0)).alias(c)
    one = per.agg(F.count(F.lit(1)).alias("d_"), *[zero(c) for c in ("n_", *nulls.values(), "bad_", "known_")])
    rows = [null_row(columns, F.col("n_"), {c: F.col(n) for c, n in nulls.items()}, most_null), duplicate_row(keys, F.col("n_"), F.col("d_"), most_duplicate), range_row(F.col("bad_"), F.col("known_"), low, high)]
    return one.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def has_columns(df: DataFrame, required: list[str]) -> DataFrame:
    missing = [c for c in required if c not in df.columns]
    return result(df.sparkSession.range(1), "schema", "validity", F.lit("FAIL" if missing else "PASS"), F.lit(len(missing)), 0, "error", F.lit("missing columns: " + ", ".join(missing) if missing else "all present"))


def listed(codes: DataFrame, most: int = 10) -> DataFrame:
    """One row: x, how many codes (k) there are, and the first of them."""
    count = codes.agg(F.count(F.lit(1)).alias("x"))
    head = codes.orderBy("k").limit(most).agg(F.array_join(F.sort_array(F.collect_list("k")), ", ").alias("codes"))
    return count.crossJoin(F.broadcast(head))


def references(df: DataFrame, column: str, valid: DataFrame, valid_column: str) -> DataFrame:
    if column not in df.columns:
        return absent(df, "references", "consistency", 0)
    unknown = df.select(F.col(column).alias("k")).where("k is not null").distinct().join(valid.select(F.col(valid_column).alias("k")), "k", "left_anti")
    return result(listed(unknown), "references", "consistency", verdict(F.col("x") == 0), F.col("x"), 0, "error", F.when(F.col("x") == 0, "all valid").otherwise(said("unknown codes: %s", F.col("codes"))))


def completeness(df: DataFrame, group: list[str], code: str, expected: int) -> DataFrame:
    """The share of groups with exactly the expected number of distinct codes."""
    one = df.groupBy(*group).agg(F.countDistinct(code).alias("c")).agg(F.avg((F.col("c") == expected).cast("double")).alias("x"), F.count_if(F.col("c") == expected).alias("f"), F.count(F.lit(1)).alias("n"))
    return result(one, "completeness", "completeness", verdict(F.col("x") >= 0.9, F.col("x") >= 0.5), F.col("x"), 0.9, "warning", said(f"%d/%d groups report all {expected} codes", F.col("f"), F.col("n")))


def totals_reconcile(df: DataFrame, group: list[str], code: str, value: str, expected: int, tolerance: float = 1.0, total: str = "TOTAL") -> DataFrame:
    """Over complete groups: the worst difference between the total and its parts, in percent of the total."""
    is_total = F.col(code) == total
    per = df.groupBy(*group).agg(F.sum(F.when(is_total, F.col(value))).alias("t"), F.sum(F.when(~is_total, F.col(value))).alias("p"), F.countDistinct(F.when(~is_total, F.col(code))).alias("c"))
    off = F.abs(F.col("p") - F.col("t")) / F.col("t") * 100
    one = per.where((F.col("c") == expected) & (F.col("t") != 0)).agg(F.max(off).alias("x"), F.count_if(off > tolerance).alias("bad"), F.count(F.lit(1)).alias("n"))
    return result(one, "total_reconciliation", "consistency", F.when(F.col("x").isNull(), "WARN").otherwise(verdict(F.col("bad") == 0)), F.col("x"), tolerance, "error", said(f"%d of %d complete groups beyond {tolerance} %%", F.col("bad"), F.col("n")))


def freshness_row(newest: Column, as_of: str, most_days: int) -> Column:
    days = F.datediff(F.lit(as_of).cast("date"), newest)
    return row("freshness", "timeliness", verdict(days <= most_days), days, most_days, "warning", F.coalesce(said("newest: %s", newest.cast("string")), F.lit("no time parses")))


def freshness(df: DataFrame, column: str, as_of: str, most_days: int = 900) -> DataFrame:
    one = df.agg(F.max(F.to_date(F.try_to_timestamp(F.col(column).cast("string")))).alias("d"))
    return one.select(freshness_row(F.col("d"), as_of, most_days).alias("r")).select("r.*")


def coverage(df: DataFrame, column: str, expected: DataFrame, expected_column: str) -> DataFrame:
    have = df.select(F.col(column).alias("k")).distinct().withColumn("hit", F.lit(1))
    both = expected.select(F.col(expected_column).alias("k")).distinct().join(have, "k", "left")
    share = both.agg(F.avg(F.coalesce("hit", F.lit(0)).cast("double")).alias("share"))
    one = share.crossJoin(F.broadcast(listed(both.where("hit is null").select("k"))))
    x = F.col("share")
    return result(one, "coverage", "completeness", verdict(x >= 0.95, x >= 0.7), x, 0.95, "warning", F.when(F.col("x") == 0, "all present").otherwise(said("missing: %s", F.col("codes"))))


def assess(df: DataFrame, keys: list[str], group: list[str], code: str, value: str, n_codes: int, entities: DataFrame, entity: str, time: str, as_of: str) -> DataFrame:
    """The suite of nine checks on a tidy table; entities: a table of valid and expected values of the entity column. A table that is dear to compute
    should be persisted by the caller, as five of the checks group it in ways of their own."""
    found = [
        row_checks(df, keys, [*keys, value], value, 0, None),
        has_columns(df, [*keys, value]),
        references(df, entity, entities, entity),
        completeness(df, group, code, n_codes + 1),
        totals_reconcile(df, group, code, value, n_codes),
        freshness(df, time, as_of),
        coverage(df, entity, entities, entity),
    ]
    return reduce(DataFrame.unionByName, found)


def gate(results: DataFrame, strict: bool = False) -> DataFrame:
    """The score with promoted (nothing blocks). strict: raises where something does, so that nothing is loaded behind it."""
    out = score(results).withColumn("promoted", F.col("blocking") == 0)
    if strict and not out.first().promoted:
        raise ValueError(f"blocked: {', '.join(r['name'] for r in results.where('status = \'FAIL\' and severity = \'error\'').collect())}")
    return out


def score(results: DataFrame) -> DataFrame:
    """One row: the mean of PASS 1, WARN 1/2, FAIL 0 in percent, the counts, and the failures that block a load."""
    points = F.when(F.col("status") == "PASS", 1.0).when(F.col("status") == "WARN", 0.5).otherwise(0.0)
    return results.agg(
        (F.avg(points) * 100).alias("score"),
        *[F.count_if(F.col("status") == s).alias(f"n_{s.lower()}") for s in ("PASS", "WARN", "FAIL")],
        F.count_if((F.col("status") == "FAIL") & (F.col("severity") == "error")).alias("blocking"),
    )
