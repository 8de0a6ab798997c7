"""Landed cube files, taken in again only where they changed.

Files lie under ``<inbox>/<dataset code>/``. A landing lists them without reading them, and reads those whose size or time differs from the last landing; of these
it decodes the ones whose checksum differs too. Decoded rows of a landing are a segment of their own; the manifest, a versioned table, says for every file which segment
has its rows, so a landing writes what changed and no more, and one that dies leaves the last one as it was. Files that went are no longer named.

Status of a file: OK, EMPTY (no rows), BADJSON, or FAIL: its dataset is unknown, its decoding failed, or it was expected and isn't there.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import cubes
from .datasets import Dataset, Registry, exists, of_interest
from .promotion import VersionedTable

MANIFEST = "file string, dataset_code string, length long, modified timestamp, sha256 string, rows long, status string, error string, segment string, landing int"
FREQ, PLACE = ("freq",), ("geo", "time")
#: Published statistical datasets (Eurostat): name, code, title, dimensions between the frequency and the place, first year (fixed values).
PUBLISHED = """
physicians | hlth_rs_phys | Physicians by sex and age | unit age sex | 2000
nurses | hlth_rs_nurse | Nurses and midwives by sex and age | unit age sex | 2000
staff_isco | hlth_rs_prs1 | Health staff by ISCO and work status | unit wstatus isco08 | 2000
staff_specialty | hlth_rs_prs2 | Health staff by medical speciality and work status | unit wstatus med_spec | 2000
consultants | hlth_rs_spec | Physicians by consultant/specialist status | unit med_spec | 2000
graduates | hlth_rs_grd | Graduating health professionals | unit isco08 | 2000
beds | hlth_rs_bds | Hospital beds by facility type | unit facility | 2000
beds_ownership | hlth_rs_bds2 | Hospital beds by ownership | unit owner | 2000
icu_beds | hlth_rs_bdsicu | Intensive care beds | unit facility statinfo | 2000
tech_staff | hlth_rs_tech | Health technicians by facility | unit facility | 2000
worker_migration | hlth_rs_wkmg | Health workers by place of training | unit isco08 tngplace | 2000
hospital_days | hlth_co_hosday | Hospital days by ICD-10 group | age indic_he unit sex icd10 | 2015
population_nuts | demo_r_pjangrp3 | Population by age and sex at NUTS level | sex unit age |
population_country | demo_pjanind | National population indicators | indic_de | 2000
life_expectancy | demo_mlexpec | Life expectancy at birth | unit sex age | 2000
mortality | demo_magec | Deaths by age and sex | unit sex age | 2000
density | demo_r_d3dens | Population density | unit | 2000
projections | proj_25np | EU population projections, 2025 baseline | sex age unit projection |
regional_workforce | hlth_rs_prsrg | Health personnel by NUTS 2 region | unit isco08 | 2000
regional_nursing | hlth_rs_prsns | Nursing and caring professionals, national, historical | unit wstatus isco08 | 2000
regional_beds | hlth_rs_bdsrg | Hospital beds by NUTS 2 region | unit facility | 2000
labour_status | lfsa_egaps | Labour force by work status | unit sex age wstatus | 2000
labour_education | lfsa_egaed | Labour force by education level | unit sex age isced11 | 2000
"""
#: Codes that are known not to be published (fixed values).
UNPUBLISHED = ("hlth_rs_wdsy", "hlth_rs_empt", "lfsa_3une_r", "hlth_ges11_hf", "hlth_inpatient", "hlth_care", "censis_r")


def published() -> Registry:
    """The registry of published datasets."""
    registry = Registry(UNPUBLISHED)
    for line in PUBLISHED.strip().splitlines():
        name, code, label, dims, since = (x.strip() for x in line.split("|"))
        registry.add(name, Dataset(code, label, (*FREQ, *dims.split(), *PLACE), since or None))
    return registry


@dataclass(frozen=True)
class Report:
    """What a landing did: numbers of files."""

    listed: int
    read: int
    decoded: int
    gone: int


class Landing:
    def __init__(self, spark: SparkSession, folder: str, registry: Registry):
        self.spark, self.folder, self.registry = spark, folder.rstrip("/"), registry
        self.table = VersionedTable(spark, f"{self.folder}/manifest")

    def manifest(self) -> DataFrame:
        return self.table.read() if self.table.history() else self.spark.createDataFrame([], MANIFEST)

    def land(self, inbox: str, expected: list[str] = ()) -> Report:
        """Takes in what changed under inbox. expected: files, below the inbox, that should be there."""
        segment, number = uuid.uuid4().hex, len(self.table.history()) + 1
        known = self.manifest()
        code = F.element_at(F.split(F.substring_index("file", f"{inbox.rstrip('/')}/", -1), "/"), 1)
        listed = self.listed(inbox).withColumn("dataset_code", code)
        old = known.where("status <> 'FAIL'").select("file", "length", "modified")
        suspects = listed.join(old, ["file", "length", "modified"], "left_anti").select("file").toArrow()["file"].to_pylist()  # as the file index, a name for each file
        fresh, decoded = None, 0
        if suspects:
            binary = self.spark.read.format("binaryFile").load(suspects).select(F.col("path").alias("file"), "length", F.col("modificationTime").alias("modified"), F.sha2("content", 256).alias("sha256"), F.get_json_object(F.col("content").cast("string"), "$").isNull().alias("bad"))
            read = binary.withColumn("dataset_code", code)
            same = read.join(known.where("status <> 'FAIL'").select("file", "sha256", "rows", "status", "error", "segment", "landing"), ["file", "sha256"])
            changed = read.join(same.select("file"), "file", "left_anti")
            states, decoded = self.decode(changed, segment)
            fresh = states.withColumns({"segment": F.lit(segment), "landing": F.lit(number)}).unionByName(same.drop("bad"))
        kept = known.join(listed.select("file"), "file", "left_semi")
        if fresh is not None:
            kept = kept.join(self.spark.createDataFrame([(f,) for f in suspects], "file string"), "file", "left_anti").unionByName(fresh)
        missing = [f"{inbox.rstrip('/')}/{e}" for e in expected if not exists(self.spark, f"{inbox.rstrip('/')}/{e}")]
        if missing:
            lost = self.spark.createDataFrame([(f,) for f in missing], "file string").withColumn("dataset_code", code).selectExpr("file", "dataset_code", "0L as rows", "'FAIL' as status", "'not there' as error").withColumn("landing", F.lit(number))
            kept = kept.unionByName(lost, allowMissingColumns=True)
        names = [c.split()[0] for c in MANIFEST.split(", ")]
        version = uuid.uuid4().hex
        kept.select(*names).write.parquet(self.table.version_path(version))
        gone = known.where("status <> 'FAIL' or length is not null").join(listed.select("file"), "file", "left_anti").count()
        self.table.promote(version, self.spark.read.parquet(self.table.version_path(version)).count())
        return Report(listed.count(), len(suspects), decoded, gone)

    def listed(self, inbox: str) -> DataFrame:
        """Names, sizes and times of all files; their content isn't read."""
        files = self.spark.read.format("binaryFile").option("recursiveFileLookup", True).load(inbox)
        return files.select(F.col("path").alias("file"), "length", F.col("modificationTime").alias("modified"))

    def decode(self, changed: DataFrame, segment: str) -> tuple[DataFrame, int]:
        """Writes the rows of changed files, a dataset at a time, and gives every file its status; and how many were decoded."""
        rows = changed.select("file", "dataset_code", "length", "modified", "sha256", "bad").toArrow().to_pylist()  # changed files only, without content
        by_code, states, decoded = {d.code: d for d in self.registry.known.values()}, [], 0
        for code in sorted({r["dataset_code"] for r in rows}):
            mine = [r for r in rows if r["dataset_code"] == code]
            good, counts, error = [r["file"] for r in mine if not r["bad"]], {}, None if code in by_code else "unknown dataset"
            if good and error is None:
                path = f"{self.folder}/segments/{segment}/{code}"
                try:
                    payloads = self.spark.read.text(good, wholetext=True).select(F.col("value").alias("payload"), F.col("_metadata.file_path").alias("file"))
                    cubes.decode(payloads, list(by_code[code].dims)).write.parquet(path)
                    counts = {r.file: r["count"] for r in self.spark.read.parquet(path).groupBy("file").count().collect()}
                    decoded += len(good)
                except Exception as e:  # the other datasets still land, and the manifest says what failed
                    error = f"{type(e).__name__}: {str(e)[:200]}"
            for r in mine:
                n = counts.get(r["file"], 0)
                status = "BADJSON" if r["bad"] else "FAIL" if error else "OK" if n else "EMPTY"
                states.append((r["file"], code, r["length"], r["modified"], r["sha256"], n, status, error))
        return self.spark.createDataFrame(states, "file string, dataset_code string, length long, modified timestamp, sha256 string, rows long, status string, error string"), decoded

    def rows(self, name: str, geos: list[str] | None = None) -> DataFrame:
        """The dataset's rows of all files that are there, each from the landing that decoded it, with file and landing."""
        d = self.registry.known[name]
        mine = self.manifest().where((F.col("dataset_code") == d.code) & (F.col("status") == "OK"))
        segments = sorted(r.segment for r in mine.select("segment").distinct().collect())
        if not segments:
            schema = ", ".join(f"`{c}` string" for c in d.dims)
            return self.spark.createDataFrame([], f"file string, {schema}, value double, status string, status_label string, landing int, dataset_code string, dataset_label string")
        paths = [f"{self.folder}/segments/{s}/{d.code}" for s in segments]
        found = self.spark.read.parquet(*paths).withColumn("segment", F.regexp_extract(F.col("_metadata.file_path"), r"/segments/([0-9a-f]+)/", 1))
        rows = found.join(mine.select("file", "segment", "landing"), ["file", "segment"]).drop("segment")
        return of_interest(rows.withColumns({"dataset_code": F.lit(d.code), "dataset_label": F.lit(d.label)}), d, geos)

    def report(self) -> DataFrame:
        """dataset_code, files and rows by status, over the whole registry; a dataset without files is EMPTY."""
        wanted = self.spark.createDataFrame([(d.code,) for d in self.registry.known.values()], "dataset_code string")
        per = self.manifest().groupBy("dataset_code").agg(F.count(F.lit(1)).alias("files"), F.sum("rows").alias("rows"), F.count_if(F.col("status") == "FAIL").alias("failed"))
        status = F.when(F.col("failed") > 0, "FAIL").when(F.col("rows") > 0, "OK").otherwise("EMPTY")
        return wanted.join(per, "dataset_code", "full").select("dataset_code", F.coalesce("files", F.lit(0)).alias("files"), F.coalesce("rows", F.lit(0)).alias("rows"), status.alias("status"))
