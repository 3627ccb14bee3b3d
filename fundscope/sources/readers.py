"""Scans: CSV with a sentinel null, header-less CSV, text lines, Parquet."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from fundscope.functions.columns import SENTINEL_TEXT


def read_csv(spark: SparkSession, path: str, *, header: bool = True,
             infer_schema: bool = True, schema: StructType | str | None = None,
             null_value: str | None = SENTINEL_TEXT, sep: str = ",",
             escape: str | None = None) -> DataFrame:
    """CSV scan with a header row; the text ``false`` is read as null.

    ``schema`` skips inference (one pass fewer over the input: inference reads
    the whole file before the query starts); prefer it at scale.  ``escape='"'``
    makes doubled quotes inside quoted fields read as one quote; the default
    escape is a backslash, which keeps them.
    """
    reader = spark.read.option("header", header).option("sep", sep)
    if null_value is not None:
        reader = reader.option("nullValue", null_value)
    if escape is not None:
        reader = reader.option("escape", escape)
    if schema is not None:
        reader = reader.schema(schema)
    else:
        reader = reader.option("inferSchema", infer_schema)
    return reader.csv(path)


def read_csv_quarantined(spark: SparkSession, path: str, schema: StructType, out: str, *, header: bool = False,
                         null_value: str | None = SENTINEL_TEXT, sep: str = ",") -> tuple[DataFrame, DataFrame]:
    """(good rows in ``schema``, malformed lines): a scan with the declared schema that loses no line.

    A line with too few or too many fields, or a field that is not of its type,
    goes to the side table with its ``file`` and its text (``line``); good and
    bad rows together are as many as the input's records.  One pass: both are
    written to ``out``, by side, and read from there.
    """
    reader = (spark.read.schema(StructType([*schema.fields, StructField("_line", StringType())])).option("header", header).option("sep", sep)
              .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_line"))
    if null_value is not None:
        reader = reader.option("nullValue", null_value)
    # All columns are written, so every field of every line is parsed.
    scanned = reader.csv(path).withColumns({"_file": F.col("_metadata.file_path"), "_bad": F.col("_line").isNotNull()})
    scanned.write.partitionBy("_bad").parquet(out)
    stored = spark.read.schema(StructType([*scanned.schema.fields])).parquet(out)
    good = stored.where(~F.col("_bad")).select(*schema.names)
    return good, stored.where("_bad").select(F.col("_file").alias("file"), F.col("_line").alias("line"))


def read_csv_headerless(spark: SparkSession, path: str) -> DataFrame:
    """CSV scan without a header: columns ``_c0``, ``_c1``, ... all strings."""
    return spark.read.csv(path)


def read_text(spark: SparkSession, path: str) -> DataFrame:
    """One row per line, one string column ``value``."""
    return spark.read.text(path)


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the driver tables, ``<sf_dir>/<name>.parquet``."""
    return read_parquet(spark, f"{sf_dir.rstrip('/')}/{name}.parquet")
