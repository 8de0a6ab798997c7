"""Statistical cubes (JSON-stat 2.0) to tidy rows, by built-in functions only.

A cube file is one JSON object: dimension names ``id``, sizes ``size``, category positions, and sparse or dense values in row-major order. Values are
exploded; each cell's position along every dimension follows from its flat index. A file whose shape doesn't fit its sizes gives no rows. Missing
tokens and unparsable values are dropped; a reported 0 stays.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import is_missing, number

INDEX_MAP = "map<string,struct<category:struct<index:map<string,int>>>>"
INDEX_LIST = "map<string,struct<category:struct<index:array<string>>>>"
#: Flags of published observations and their labels (fixed values of the published status list).
FLAGS = {
    "b": "break_in_series",
    "be": "break_in_series_estimated",
    "c": "confidential",
    "d": "definition_unavailable",
    "e": "estimated",
    "f": "forecast",
    "n": "not_significant",
    "p": "provisional",
    "r": "revised",
    "s": "Eurostat_estimate",
    "u": "low_reliability",
    "z": "not_applicable",
    ":": "not_available",
}


def codes_of(payload: Column, name: str) -> Column:
    """The category codes of a dimension, in order of position, from either form of index."""
    as_map = F.from_json(F.get_json_object(payload, "$.dimension"), INDEX_MAP)[name]["category"]["index"]
    as_list = F.from_json(F.get_json_object(payload, "$.dimension"), INDEX_LIST)[name]["category"]["index"]
    ordered = F.transform(F.array_sort(F.transform(F.map_entries(as_map), lambda e: F.struct(e["value"].alias("p"), e["key"].alias("c")))), lambda e: e["c"])
    return F.coalesce(as_list, ordered)


def decode(payloads: DataFrame, dims: list[str], payload: str = "payload") -> DataFrame:
    """A row for each present cell of each payload: dims, value, status, status_label and payloads' other columns."""
    p = F.col(payload)
    others = [c for c in payloads.columns if c != payload]
    shaped = payloads.select(
        *others,
        F.from_json(F.get_json_object(p, "$.id"), "array<string>").alias("id_"),
        F.from_json(F.get_json_object(p, "$.size"), "array<bigint>").alias("size_"),
        F.coalesce(
            F.map_entries(F.from_json(F.get_json_object(p, "$.value"), "map<string,string>")),
            F.transform(F.from_json(F.get_json_object(p, "$.value"), "array<string>"), lambda x, i: F.struct(i.cast("string").alias("key"), x.alias("value"))),
        ).alias("cells_"),
        F.from_json(F.get_json_object(p, "$.status"), "map<string,string>").alias("flags_"),
        *[codes_of(p, d).alias(f"codes_{d}") for d in dims],
    )
    cells = F.aggregate("size_", F.lit(1).cast("long"), lambda a, x: a * x)
    fits = shaped.where((F.size("id_") == F.size("size_")) & (F.size("id_") == len(dims))).withColumn("n_", cells)
    rows = fits.withColumn("cell_", F.explode("cells_")).withColumn("flat_", F.col("cell_.key").try_cast("bigint"))
    rows = rows.where((F.col("flat_") >= 0) & (F.col("flat_") < F.col("n_")) & ~is_missing(F.col("cell_.value"))).withColumn("value", number(F.col("cell_.value"))).where("value is not null")
    flag = F.try_element_at("flags_", F.col("cell_.key"))
    label = F.create_map(*[F.lit(x) for kv in FLAGS.items() for x in kv])

    def place(d: str) -> Column:  # dims may stand in any order in the file
        at = F.array_position("id_", d)
        inner = F.aggregate(F.slice("size_", (at + 1).cast("int"), F.greatest(F.size("size_") - at, F.lit(0)).cast("int")), F.lit(1).cast("long"), lambda a, x: a * x)
        step = F.floor(F.col("flat_") / inner) % F.get("size_", (at - 1).cast("int"))
        return F.get(F.col(f"codes_{d}"), step.cast("int"))

    out = rows.select(*others, *[place(d).alias(d) for d in dims], "value", flag.alias("status"))
    return out.withColumn("status_label", F.coalesce(F.try_element_at(label, F.col("status")), F.col("status")))


def read_cubes(spark: SparkSession, path: str, dims: list[str], code: str, label: str) -> DataFrame:
    """The tidy rows of every cube file under path, tagged with the dataset."""
    files = spark.read.text(path, wholetext=True).select(F.col("value").alias("payload"), F.col("_metadata.file_path").alias("file"))
    return decode(files, dims).withColumns({"dataset_code": F.lit(code), "dataset_label": F.lit(label)})


def landing_audit(spark: SparkSession, path: str, rows: DataFrame) -> DataFrame:
    """Size, checksum and status (OK, EMPTY or BADJSON) of every landed file; rows: decoded rows with ``file``."""
    found = spark.read.format("binaryFile").load(path).select(F.col("path").alias("file"), "length", F.sha2("content", 256).alias("sha256"), F.get_json_object(F.col("content").cast("string"), "$").isNull().alias("bad"))
    counts = rows.groupBy("file").agg(F.count(F.lit(1)).alias("rows"))
    return found.join(counts, "file", "left").select("file", "length", "sha256", F.coalesce("rows", F.lit(0)).alias("rows"), F.when(F.col("bad"), "BADJSON").when(F.col("rows").isNull(), "EMPTY").otherwise("OK").alias("status"))


def write_tables(tables: dict[str, DataFrame], folder: str) -> DataFrame:
    """Each table replaced under folder as Parquet; the manifest has the row counts of what was written."""
    spark = next(iter(tables.values())).sparkSession
    out = None
    for name, df in tables.items():
        df.write.mode("overwrite").parquet(f"{folder}/{name}")
        row = spark.read.parquet(f"{folder}/{name}").agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("table"), "rows")
        out = row if out is None else out.unionByName(row)
    return out
