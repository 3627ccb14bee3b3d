"""Profiling: counts, schema, first rows, describe, value counts, top-k, distinct.

Each profile is a DataFrame, so it runs on the executors; only its (small)
result is ever shown.  Aggregations are hash aggregations with a map-side
partial step, so a value that holds a third of all rows is reduced to one row
per input partition before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DESCRIBE_STATS = ("count", "mean", "stddev", "min", "max")

# Every text the double cast can parse starts (after blanks and a sign) with a
# digit, a dot, "inf", "nan" or "0x"; testing that first skips the failing
# parse, which costs an exception per value, for ordinary text.
_MAYBE_NUMBER = r"(?i)^\s*[+-]?(\d|\.|inf|nan|0x)"


def _text_as_double(col):
    return F.when(col.rlike(_MAYBE_NUMBER), col.try_cast("double"))


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("row_count"))


def schema_profile(df: DataFrame) -> DataFrame:
    """One row per column: ordinal, name, Spark type and non-null count.

    All counts come from a single aggregation (one scan), then ``stack``
    turns the one wide row into one row per column.
    """
    fields = df.schema.fields
    wide = df.agg(*[F.count(F.col(f"`{f.name}`")).alias(f"n{i}") for i, f in enumerate(fields)])
    parts = []
    for i, f in enumerate(fields):
        parts += [F.lit(i + 1), F.lit(f.name), F.lit(f.dataType.simpleString()), F.col(f"n{i}")]
    return wide.select(F.stack(F.lit(len(fields)), *parts).alias(
        "ordinal", "column_name", "data_type", "non_null"))


def head_n(df: DataFrame, n: int = 20, order_by=None) -> DataFrame:
    """First ``n`` rows; with ``order_by`` the answer is deterministic
    (planned as a per-partition top-n, then a merge of n rows per partition)."""
    if order_by is not None:
        keys = order_by if isinstance(order_by, (list, tuple)) else [order_by]
        df = df.orderBy(*keys)
    return df.limit(n)


def describe(df: DataFrame, cols=None, digits: int | None = None) -> DataFrame:
    """``describe`` in one pass: count, mean, sample stddev, min, max.

    Every statistic is text, as in ``DataFrame.describe``, so min and max of
    wide integers and decimals keep all their digits.  Mean and stddev are
    doubles (rounded to ``digits`` if given), null for text that is not a
    number; min / max of text follow text order.  The result has a ``summary``
    column and one column per input.
    """
    cols = list(cols or df.columns)
    numeric = ("tinyint", "smallint", "int", "bigint", "float", "double", "decimal")
    kinds = {f.name: f.dataType.simpleString().split("(")[0] for f in df.schema.fields}
    aggs = []
    for i, c in enumerate(cols):
        col = F.col(f"`{c}`")
        as_num = col.cast("double") if kinds[c] in numeric else _text_as_double(col)
        mean, std = F.avg(as_num), F.stddev_samp(as_num)
        if digits is not None:
            mean, std = F.round(mean, digits), F.round(std, digits)
        aggs += [F.count(col).alias(f"count{i}"), mean.alias(f"mean{i}"), std.alias(f"stddev{i}"),
                 F.min(col).alias(f"min{i}"), F.max(col).alias(f"max{i}")]
    wide = df.agg(*aggs)

    parts = []
    for stat in DESCRIBE_STATS:
        parts.append(F.lit(stat))
        parts += [F.col(f"{stat}{i}").cast("string") for i in range(len(cols))]
    return wide.select(F.stack(F.lit(len(DESCRIBE_STATS)), *parts).alias("summary", *cols))


def value_counts(df: DataFrame, *cols, where=None, sort: bool = True) -> DataFrame:
    """Rows per distinct value (or value tuple), largest first; null is a group."""
    if where is not None:
        df = df.filter(where)
    counts = df.groupBy(*cols).agg(F.count(F.lit(1)).alias("count"))
    if sort:
        counts = counts.orderBy(F.desc("count"), *[F.asc_nulls_first(c) for c in cols])
    return counts


def class_balance(df: DataFrame, label: str = "final_status") -> DataFrame:
    return value_counts(df, label)


def top_k(df: DataFrame, cols, k: int, where=None) -> DataFrame:
    """The ``k`` most frequent values; ties broken by the values themselves."""
    cols = cols if isinstance(cols, (list, tuple)) else [cols]
    counts = value_counts(df, *cols, where=where, sort=False)
    return counts.orderBy(F.desc("count"), *[F.asc_nulls_first(c) for c in cols]).limit(k)


def distinct_values(df: DataFrame, col: str) -> DataFrame:
    return df.select(col).dropDuplicates()
