"""Whole texts for Python tasks, a bounded Arrow batch at a time."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame

BATCH_BYTES_CONF = "spark.sql.execution.arrow.maxBytesPerBatch"
BATCH_BYTES = 2 << 20


def map_texts(rows: DataFrame, function: Callable, schema) -> DataFrame:
    """``rows.mapInArrow``, in batches of about ``BATCH_BYTES`` (a longer row is a batch of its own).

    By rows alone a batch of texts is as large as 10,000 texts, in the executor
    and in the worker.  The bound is a setting of the session, because Spark
    reads it when the plan runs; a session that has a bound keeps it.
    """
    conf = rows.sparkSession.conf
    if BATCH_BYTES_CONF not in conf.getAll:
        conf.set(BATCH_BYTES_CONF, str(BATCH_BYTES))
    return rows.mapInArrow(function, schema)
