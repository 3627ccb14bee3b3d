"""Word count: split lines on single spaces, count words, largest first.

The count is a hash aggregation with a map-side partial step, so frequent
words (or the empty word) collapse to one row per map task before the
shuffle; the final sort is a range-partitioned sort over distinct words only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fundscope.functions.columns import split_on_space


def split_words(lines: DataFrame, line_col: str = "value", keep=()) -> DataFrame:
    # explode_outer + null test: a plain explode adds a size() > 0 filter
    # under the projection that evaluates the split twice per line.
    return (lines.select(*keep, F.explode_outer(split_on_space(line_col)).alias("word"))
                 .filter(F.col("word").isNotNull()))


def word_count(lines: DataFrame, line_col: str = "value", sort: bool = True) -> DataFrame:
    counts = (split_words(lines, line_col)
              .groupBy("word").agg(F.count(F.lit(1)).alias("count")))
    return counts.orderBy(F.desc("count"), F.asc("word")) if sort else counts
