"""The two cleaning jobs (raw campaigns -> prepared training set) and the
text-cleaning round trip.  Each job is one chain of narrow transforms, so
Catalyst folds it into a single scan stage: filters are combined and pushed
under the projections, unused columns are pruned at the scan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fundscope.operators import cleaning as cl
from fundscope.sources import readers, sinks
from fundscope.sources.schemas import RAW_CAMPAIGN_SCHEMA

PREPARED_COLUMNS = ("project_id", "name", "desc", "goal", "keywords", "final_status",
                    "country2", "currency2", "deadline2", "created_at2", "launched_at2",
                    "days_campaign", "hours_prepa", "text")

ELAPSED_COLUMNS = ("project_id", "name", "desc", "goal", "keywords", "country", "currency",
                   "final_status", "country2", "currency2", "days_campaign", "hours_prepa",
                   "text")


def campaign_features(raw: DataFrame, tz: str | None = "UTC") -> DataFrame:
    """Common job up to the text column, before any row filter."""
    return (raw
            .transform(cl.cast_ints)
            .transform(lambda d: cl.drop_columns(d, *cl.UNUSED_COLUMNS))
            .transform(cl.drop_leakage)
            .transform(cl.repair_country_currency)
            .transform(cl.lower_text)
            .transform(lambda d: cl.add_durations(d, tz))
            .transform(lambda d: d.drop(*cl.EPOCH_COLUMNS))
            .transform(cl.add_text))


def prepare_campaigns(raw: DataFrame, tz: str | None = "UTC") -> DataFrame:
    """Common cleaning job: casts, drops, repairs, lower case, durations,
    duration filter, text, goal filter, null fill, class filter."""
    feats = (campaign_features(raw, tz)
             .transform(cl.filter_durations)
             .transform(cl.filter_goal)
             .transform(cl.null_fill)
             .transform(cl.filter_classes))
    return feats.select(*[F.col(f"`{c}`") for c in PREPARED_COLUMNS])


def prepare_campaigns_elapsed(raw: DataFrame) -> DataFrame:
    """Variant job: class filter as a SQL predicate, de-duplication, elapsed
    whole days / hours, null parts printed as ``null``; no lower case, and
    ``country`` / ``currency`` kept."""
    out = (raw
           .transform(cl.cast_ints)
           .transform(lambda d: cl.filter_predicate(d, "final_status = 0 OR final_status = 1"))
           .transform(cl.drop_duplicates)
           .transform(lambda d: cl.drop_columns(d, *cl.UNUSED_COLUMNS))
           .transform(cl.drop_leakage)
           .transform(lambda d: cl.repair_country_currency(d, keep_raw=True))
           .transform(cl.add_elapsed_durations)
           .transform(lambda d: d.drop(*cl.EPOCH_COLUMNS))
           .transform(lambda d: cl.add_text(d, null_literal=True))
           .transform(cl.filter_goal)
           .transform(cl.null_fill))
    return out.select(*[F.col(f"`{c}`") for c in ELAPSED_COLUMNS])


def run_prepare_job(spark: SparkSession, csv_path: str, out_path: str,
                    variant: str = "common", schema=RAW_CAMPAIGN_SCHEMA) -> str:
    """CSV in, Parquet out: the whole batch job.

    The schema is given, so the input is read once and cannot choose its own
    types; ``schema=None`` infers it, at the price of a second pass.
    """
    raw = readers.read_csv(spark, csv_path, schema=schema)
    if variant == "common":
        return sinks.write_parquet(prepare_campaigns(raw), out_path)
    return sinks.write_parquet_strict(prepare_campaigns_elapsed(raw), out_path)


def text_clean_roundtrip(spark: SparkSession, lines_path: str, out_path: str) -> DataFrame:
    """Text scan, quote runs to a space, text write, header-less CSV scan."""
    lines = readers.read_text(spark, lines_path)
    cleaned = cl.clean_quote_runs(lines, "value").select(F.col("value").alias("replaced"))
    sinks.write_text(cleaned, out_path, "replaced")
    return readers.read_csv_headerless(spark, out_path)
