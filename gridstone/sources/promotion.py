"""Tables in versions: a write goes to a folder of its own, is checked there, and counts only once a manifest points to it.

A table's folder has ``versions/<id>`` with Parquet files and ``manifests/<number>.json``, one line each with the version, its rows and when it was promoted. Readers
take the highest manifest. A manifest comes about by a rename that fails where the number exists, so of two promotions at once one fails and can be repeated; a write
that is killed, or refused by its checks, leaves a version no manifest names, and the table as it was.

Row-level metrics are observed while the rows are written, so the source is computed once; checks over groups read the version that was written. Observed
metrics of a task that ran twice could count twice: the number of rows is compared with the written files', and on a difference the metrics are taken
from those.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from dataclasses import dataclass
from datetime import UTC, datetime

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..operators import quality


class Blocked(ValueError):
    """A version whose checks failed; results has a row for each check."""

    def __init__(self, results: DataFrame):
        super().__init__("not promoted: " + ", ".join(sorted(r["name"] for r in results.where("status = 'FAIL' and severity = 'error'").collect())))
        self.results = results


class Files:
    """The few file operations of a manifest, on whatever store the path is in."""

    def __init__(self, spark: SparkSession, folder: str):
        jvm, self.conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
        self.path = jvm.org.apache.hadoop.fs.Path
        self.fs = self.path(folder).getFileSystem(self.conf)

    def names(self, folder: str) -> list[str]:
        at = self.path(folder)
        return [s.getPath().getName() for s in self.fs.listStatus(at)] if self.fs.exists(at) else []

    def put(self, path: str, text: str) -> bool:
        """Writes a file under a name that nobody has yet; False if somebody has."""
        draft = self.path(f"{path}.{uuid.uuid4().hex}.draft")
        out = self.fs.create(draft, True)
        out.write(bytearray(text.encode()))
        out.close()
        done = not self.fs.exists(self.path(path)) and self.fs.rename(draft, self.path(path))
        if not done:
            self.fs.delete(draft, False)
        return done

    def delete(self, path: str) -> None:
        self.fs.delete(self.path(path), True)


@dataclass(frozen=True)
class Version:
    number: int
    id: str
    rows: int
    at: str


class VersionedTable:
    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder, self.files = spark, folder.rstrip("/"), Files(spark, folder)

    def history(self) -> list[Version]:
        """All promoted versions, the latest last."""
        numbers = sorted(int(n.removesuffix(".json")) for n in self.files.names(f"{self.folder}/manifests") if n.endswith(".json"))
        if not numbers:
            return []
        rows = self.spark.read.schema("number int, id string, rows long, at string").json([self.manifest(n) for n in numbers]).collect()
        return [Version(*r) for r in sorted(rows)]

    def manifest(self, number: int) -> str:
        return f"{self.folder}/manifests/{number:010d}.json"

    def version_path(self, version: str) -> str:
        return f"{self.folder}/versions/{version}"

    def read(self, number: int | None = None) -> DataFrame:
        """The current version, or the one of this number."""
        known = [v for v in self.history() if number in (None, v.number)]
        if not known:
            raise FileNotFoundError(f"{self.folder} has no promoted version{'' if number is None else f' {number}'}")
        return self.spark.read.parquet(self.version_path(known[-1].id))

    def promote(self, version: str, rows: int) -> Version:
        """The version becomes the current one. Fails if another one was promoted meanwhile."""
        last = self.history()
        new = Version(last[-1].number + 1 if last else 1, version, rows, datetime.now(UTC).isoformat(timespec="seconds"))
        if not self.files.put(self.manifest(new.number), json.dumps(new.__dict__) + "\n"):
            raise FileExistsError(f"version {new.number} of {self.folder} was promoted meanwhile")
        return new

    def vacuum(self, keep: int = 2) -> list[str]:
        """Removes all but the last promoted versions, with their manifests, and what was never promoted. Not to be called while a write is under way."""
        known = self.history()
        kept = {v.id for v in known[-keep:]}
        gone = [n for n in self.files.names(f"{self.folder}/versions") if n not in kept]
        for v in known[:-keep]:
            self.files.delete(self.manifest(v.number))
        for name in gone:
            self.files.delete(self.version_path(name))
        return sorted(gone)


@dataclass(frozen=True)
class RowChecks:
    """What is observed of each row of a write. columns: those whose nulls count; ranges: (column, least, most); time: the column whose newest value counts."""

    columns: tuple[str, ...]
    ranges: tuple[tuple[str, float | None, float | None], ...] = ()
    most_null: float = 0.05
    time: str | None = None
    as_of: str | None = None
    most_days: int = 900

    def metrics(self, df: DataFrame) -> list[Column]:
        out = [F.count(F.lit(1)).alias("rows")]
        out += [F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in self.columns if c in df.columns]
        for c, low, high in self.ranges:
            if c in df.columns:
                out += [F.count_if(quality.outside(c, low, high)).alias(f"outside_{c}"), F.count(c).alias(f"known_{c}")]
        if self.time in df.columns:
            out.append(F.max(F.to_date(F.try_to_timestamp(F.col(self.time).cast("string")))).cast("string").alias("newest"))
        return out

    def results(self, df: DataFrame, seen: dict) -> DataFrame:
        """The checks' rows from the observed metrics of df."""
        known, n = [c for c in self.columns if c in df.columns], F.lit(seen["rows"])
        rows = [quality.null_row(known, n, {c: F.lit(seen[f"null_{c}"]) for c in known}, self.most_null)]
        for c, low, high in self.ranges:
            if c in df.columns:
                rows.append(quality.range_row(F.lit(seen[f"outside_{c}"]), F.lit(seen[f"known_{c}"]), low, high).withField("name", F.lit(f"range_{c}")))
        missing = [c for c in dict.fromkeys([*self.columns, *[r[0] for r in self.ranges], *([self.time] if self.time else [])]) if c not in df.columns]
        rows.append(quality.row("schema", "validity", F.lit("FAIL" if missing else "PASS"), F.lit(len(missing)), 0, "error", F.lit("missing columns: " + ", ".join(missing) if missing else "all present")))
        if self.time in df.columns:
            rows.append(quality.freshness_row(F.lit(seen["newest"]).cast("date"), self.as_of, self.most_days))
        return df.sparkSession.range(1).select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def guarded_write(df: DataFrame, table: VersionedTable, checks: RowChecks, group_checks: Callable[[DataFrame], DataFrame] | None = None, strict: bool = True) -> DataFrame:
    """Writes a version, checks it and promotes it; returns the checks' rows.

    group_checks: rows of checks over groups (duplicates, totals) of the written version. strict: a failing check of severity error raises Blocked, and the current
    version stays; without it the version is promoted all the same, and the rows say what failed.
    """
    seen, version = Observation("written"), uuid.uuid4().hex
    path, wanted = table.version_path(version), checks.metrics(df)
    df.observe(seen, *wanted).write.parquet(path)
    staged = table.spark.read.schema(df.schema).parquet(path)
    rows, metrics = staged.count(), seen.get  # a count of Parquet files reads their footers only
    if metrics["rows"] != rows:
        metrics = staged.agg(*wanted).first().asDict()
    results = checks.results(df, metrics)
    if group_checks is not None:
        results = results.unionByName(group_checks(staged))
    found = table.spark.createDataFrame(results.collect(), results.schema)  # a few rows; the staged version may go now
    if strict and not quality.gate(found).first().promoted:
        table.files.delete(path)
        raise Blocked(found)
    table.promote(version, rows)
    return found
