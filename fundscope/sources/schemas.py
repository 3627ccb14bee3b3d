"""Explicit schemas (no inference pass over the input)."""

from pyspark.sql.types import (BooleanType, IntegerType, StringType, StructField,
                               StructType)

# The raw campaign CSV, typed as a scan with inference reads it.
RAW_CAMPAIGN_SCHEMA = StructType([
    StructField("project_id", StringType()),
    StructField("name", StringType()),
    StructField("desc", StringType()),
    StructField("keywords", StringType()),
    StructField("goal", StringType()),
    StructField("disable_communication", BooleanType()),
    StructField("country", StringType()),
    StructField("currency", StringType()),
    StructField("deadline", IntegerType()),
    StructField("state_changed_at", IntegerType()),
    StructField("created_at", IntegerType()),
    StructField("launched_at", IntegerType()),
    StructField("backers_count", IntegerType()),
    StructField("final_status", IntegerType()),
])
