"""Distinct counts that roll up: mergeable sketches as a column. Exact counts stay the default everywhere else; these are for who asks for them.

A distinct count can't be added up from finer ones, so every grouping needs all rows again. A sketch (HyperLogLog) of 2 ** ``log_size`` registers can: the facts are read once at the
finest grain, sketches are kept as a binary column, and any coarser grouping merges them. The relative standard error is about 1.04 / sqrt(2 ** log_size), whatever the number of rows;
small sets are counted almost exactly. NULL ids aren't counted; a group of only such has 0.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LOG_SIZE = 14


def standard_error(log_size: int = LOG_SIZE) -> float:
    return 1.04 / math.sqrt(2**log_size)


def sketched(df: DataFrame, keys: list[str], id_column: str, log_size: int = LOG_SIZE) -> DataFrame:
    """keys and the sketch of the group's ids; partial sketches are merged before the shuffle, so a group sends one for each task."""
    return df.groupBy(*keys).agg(F.hll_sketch_agg(id_column, log_size).alias("sketch"))


def rolled_up(sketches: DataFrame, keys: list[str], sets: list[list[str]]) -> DataFrame:
    """keys (NULL where rolled up) and the estimate in each of ``sets``, from sketches alone."""
    return sketches.groupingSets(sets, *keys).agg(F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("estimate"))


def added(kept: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """A kept table of sketches with those of new rows merged in: a load doesn't read old rows again."""
    return kept.select(*keys, "sketch").unionByName(new.select(*keys, "sketch")).groupBy(*keys).agg(F.hll_union_agg("sketch").alias("sketch"))


def within(estimate: Column, exact: Column, log_size: int = LOG_SIZE, errors: float = 4.0) -> Column:
    """Whether an estimate lies within so many standard errors of the exact count (and one more)."""
    return F.abs(estimate - exact) <= F.lit(1.0) + exact * (errors * standard_error(log_size))
