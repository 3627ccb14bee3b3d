"""Results that are written to the shared folder and read again."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from fundscope.session import scratch_path


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a Parquet table under ``spark.checkpoint.dir``.

    Later jobs read the table, so nothing before it runs twice, and a lost
    executor costs a reread of shared files only.
    """
    spark: SparkSession = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
