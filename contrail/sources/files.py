"""Readers and writers at the edge: raw JSON documents and CSV layers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from contrail.functions.columns import to_boolean
from contrail.operators.silver import coerce_numeric
from contrail.schemas import PREDICTIONS, SILVER, SILVER_DOUBLES, SILVER_LONGS
from contrail.session import path_exists, prepare, settle


def _require(spark: SparkSession, path: str, what: str) -> None:
    if not path:
        raise ValueError(f"no path given for the {what}")
    if not path_exists(spark, path):
        raise FileNotFoundError(f"{what} not found: {path}")


def read_bronze_json(spark: SparkSession, path: str) -> DataFrame:
    """Raw documents, one per file, with the file each came from."""
    _require(prepare(spark), path, "raw documents")
    return spark.read.text(path, wholetext=True).select(
        F.col("value").alias("raw_data"), F.col("_metadata.file_path").alias("source_file")
    )


def _typed_silver(text: DataFrame) -> DataFrame:
    typed = coerce_numeric(text, SILVER_DOUBLES, SILVER_LONGS)
    if "on_ground" in typed.columns:
        typed = typed.withColumn("on_ground", to_boolean(F.col("on_ground")))
    return typed


def read_silver(spark: SparkSession, path: str) -> DataFrame:
    """Silver CSV, columns by header name; columns the file lacks stay absent."""
    _require(prepare(spark), path, "silver file")
    return _typed_silver(spark.read.option("header", True).csv(path))


def read_silver_dir(spark: SparkSession, path: str, pattern: str = "flight_silver_*.csv") -> DataFrame:
    """All silver CSVs of a folder, united by column name; unreadable files are passed over.

    One scan finds the first line of each file, another reads all rows, however
    many headers there are: each line meets the header of its file (a table of a
    row a file, whose real size decides how they are joined), is cut into fields,
    and gives every column the field that stands where its name does. Columns
    that a file lacks are NULL, columns that no file has are absent, unknown ones
    are left out. Eager as far as the headers go. No readable file raises
    `ValueError`.
    """
    if "*" not in path:
        _require(prepare(spark), path, "silver folder")
    reader = spark.read.option("pathGlobFilter", pattern).option("ignoreCorruptFiles", True)
    lines = reader.text(path).select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("at"))
    first = lines.where("at = 0").withColumn("row", F.monotonically_increasing_id())
    headers = first.groupBy("file").agg(F.min_by("value", "row").alias("header")).where("header <> ''")
    headers = settle(headers, "headers")
    fields = headers.agg(F.max(F.size(F.split("header", ",")))).first()[0] or 0
    names = _fields(F.ltrim(F.col("header"), F.lit("\ufeff")), fields)
    known = headers.select(F.explode(names).alias("name")).where(F.col("name").isin(SILVER.names)).distinct()
    present = {r.name for r in known.collect()}  # at most the columns of silver
    if not present:
        raise ValueError(f"no readable {pattern} in {path}")
    rows = lines.join(headers, "file").where("value <> header AND value <> ''").select(names.alias("names"), _fields(F.col("value"), fields).alias("given"))
    picked = [F.get("given", (F.array_position("names", n) - 1).cast("int")).alias(n) for n in SILVER.names if n in present]
    return _typed_silver(rows.select(*picked))


def _fields(line: Column, n: int) -> Column:
    """The fields of a CSV line, as an array of `n` texts, those that are missing or empty NULL."""
    names = [f"c{i}" for i in range(n)]
    parsed = F.from_csv(line, ", ".join(f"{c} string" for c in names) or "c0 string")
    return F.array(*[parsed[c] for c in names])


def read_predictions(spark: SparkSession, path: str) -> DataFrame:
    _require(prepare(spark), path, "predictions")
    text = spark.read.option("header", True).csv(path)
    casts = {
        f.name: F.col(f.name).try_cast(f.dataType) for f in PREDICTIONS if f.name in text.columns
    }
    return text.withColumns(casts)


def write_layer(df: DataFrame, path: str, fmt: str = "csv", mode: str = "overwrite") -> str:
    """Write a layer as a folder of CSV (with header) or Parquet files."""
    writer = df.write.mode(mode)
    if fmt == "csv":
        writer = writer.option("header", True)
    writer.format(fmt).save(path)
    return path
