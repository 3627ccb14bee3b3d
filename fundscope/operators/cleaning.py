"""Column and row cleaning: casts, drops, repairs, case folding, features,
filters, null fill and de-duplication.  All narrow (no shuffle) except
``drop_duplicates``, which is a hash aggregation with a map-side step.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fundscope.functions import columns as fc

# Fixed values of the campaign jobs.
INT_COLUMNS = ("goal", "deadline", "state_changed_at", "created_at", "launched_at",
               "backers_count", "final_status")
LEAKAGE_COLUMNS = ("backers_count", "state_changed_at")   # known only after the campaign
UNUSED_COLUMNS = ("disable_communication",)
TEXT_COLUMNS = ("name", "desc", "keywords")
EPOCH_COLUMNS = ("deadline", "created_at", "launched_at")
FILL_VALUES = {"days_campaign": -1, "hours_prepa": -1, "goal": -1}
CLASSES = (0, 1)


# ---------------------------------------------------------------- columns

def cast_ints(df: DataFrame, cols=INT_COLUMNS) -> DataFrame:
    return df.withColumns({c: fc.tolerant_int(c) for c in cols})


def project(df: DataFrame, cols) -> DataFrame:
    return df.select(*cols)


def drop_columns(df: DataFrame, *cols) -> DataFrame:
    return df.drop(*cols)


def drop_leakage(df: DataFrame, cols=LEAKAGE_COLUMNS) -> DataFrame:
    return df.drop(*cols)


def repair_country_currency(df: DataFrame, keep_raw: bool = False) -> DataFrame:
    out = df.withColumns({"country2": fc.repair_country("country", "currency"),
                          "currency2": fc.validate_currency("currency")})
    return out if keep_raw else out.drop("country", "currency")


def lower_text(df: DataFrame, cols=TEXT_COLUMNS) -> DataFrame:
    return df.withColumns({c: F.lower(F.col(f"`{c}`")) for c in cols})


def clean_quote_runs(df: DataFrame, cols) -> DataFrame:
    cols = [cols] if isinstance(cols, str) else list(cols)
    return df.withColumns({c: fc.collapse_quote_runs(F.col(f"`{c}`")) for c in cols})


# ---------------------------------------------------------------- features

def add_durations(df: DataFrame, tz: str | None = "UTC") -> DataFrame:
    """Epoch columns as text, calendar days of the campaign, preparation hours."""
    out = df.withColumns({
        "deadline2": fc.epoch_to_text("deadline", tz),
        "created_at2": fc.epoch_to_text("created_at", tz),
        "launched_at2": fc.epoch_to_text("launched_at", tz),
    })
    return out.withColumns({
        "days_campaign": fc.calendar_days("deadline2", "launched_at2"),
        "hours_prepa": fc.hours_between("launched_at", "created_at", 3),
    })


def add_elapsed_durations(df: DataFrame) -> DataFrame:
    """Variant: whole elapsed days and hours by integer division, -1 on null."""
    return df.withColumns({
        "days_campaign": fc.elapsed_whole_days("deadline", "launched_at"),
        "hours_prepa": fc.elapsed_whole_hours("launched_at", "created_at"),
    })


def add_text(df: DataFrame, cols=TEXT_COLUMNS, null_literal: bool = False) -> DataFrame:
    fn = fc.concat_text_null_literal if null_literal else fc.concat_text
    return df.withColumn("text", fn(*[F.col(f"`{c}`") for c in cols]))


# ---------------------------------------------------------------- rows

def filter_durations(df: DataFrame) -> DataFrame:
    return df.filter((F.col("hours_prepa") >= 0) & (F.col("days_campaign") >= 0))


def filter_goal(df: DataFrame) -> DataFrame:
    return df.filter(F.col("goal") > 0)


def filter_classes(df: DataFrame, label: str = "final_status", classes=CLASSES) -> DataFrame:
    return df.filter(F.col(label).isin(*classes))


def filter_predicate(df: DataFrame, predicate: str) -> DataFrame:
    """Filter by a SQL predicate string, e.g. ``final_status = 0 OR final_status = 1``."""
    return df.filter(predicate)


def null_fill(df: DataFrame, values: dict | None = None) -> DataFrame:
    return df.na.fill(dict(values or FILL_VALUES))


def drop_duplicates(df: DataFrame, subset=None) -> DataFrame:
    """Whole-row (or ``subset``) de-duplication.

    Planned as a hash aggregation on all columns with a partial step before
    the shuffle: a row repeated millions of times leaves each map task once.
    """
    return df.dropDuplicates(subset) if subset else df.dropDuplicates()
