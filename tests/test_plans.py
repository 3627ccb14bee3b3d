"""Sinks, the variant job, CSV round trips, fixture facts."""

import pytest

from fundscope.catalog import QUERIES
from fundscope.plans import prepare as pp
from fundscope.session import scratch_path
from fundscope.sources import fixtures as fx
from fundscope.sources import readers, sinks
from tests.conftest import SF_MID, SF_SMALL


def test_prepared_row_count_at_sf001(spark):
    # the fact FIXTURES.md states for the common job
    assert pp.prepare_campaigns(fx.campaigns(spark, SF_MID)).count() == 14240


def test_csv_round_trip_equals_view(spark):
    view = fx.campaigns(spark, SF_SMALL)
    back = QUERIES["csv_scan"](spark, SF_SMALL)
    assert [f.simpleString() for f in view.schema.fields] == \
           [f.simpleString() for f in back.schema.fields]
    assert view.exceptAll(back).count() == 0 and back.exceptAll(view).count() == 0


def test_strict_parquet_sink_refuses_existing_path(spark):
    df = pp.prepare_campaigns_elapsed(fx.campaigns(spark, SF_SMALL))
    path = scratch_path(spark, "strict")
    sinks.write_parquet_strict(df, path)
    with pytest.raises(Exception):
        sinks.write_parquet_strict(df, path)
    assert readers.read_parquet(spark, path).count() == df.count()


def test_text_sink_refuses_existing_path(spark):
    df = fx.quoted_lines(spark, SF_SMALL)
    path = scratch_path(spark, "text")
    sinks.write_text(df, path, "value")
    with pytest.raises(Exception):
        sinks.write_text(df, path, "value")


def test_prepare_job_csv_to_parquet(spark):
    csv = scratch_path(spark, "raw_csv")
    sinks.write_sentinel_csv(fx.campaigns(spark, SF_SMALL), csv)
    out = pp.run_prepare_job(spark, csv, scratch_path(spark, "prepared"))
    got = readers.read_parquet(spark, out)
    want = pp.prepare_campaigns(fx.campaigns(spark, SF_SMALL))
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_variant_deduplicates_before_features(spark):
    raw = fx.campaigns(spark, SF_SMALL)
    doubled = raw.unionByName(raw)
    a = pp.prepare_campaigns_elapsed(raw)
    b = pp.prepare_campaigns_elapsed(doubled)
    assert a.count() == b.count()


def test_top_k_is_a_limit_of_value_counts(spark):
    top = QUERIES["top_k"](spark, SF_SMALL).collect()
    counts = [r["count"] for r in top]
    assert counts == sorted(counts, reverse=True) and len(top) <= 100


def test_scratch_paths_stay_under_the_checkpoint_root(spark):
    import os
    import re
    from fundscope.session import ensure_checkpoint_dir
    root = ensure_checkpoint_dir(spark)
    path = scratch_path(spark, "probe")
    assert path.startswith(root.rstrip("/"))
    local = re.sub(r"^file:", "", path)
    assert local.startswith("/")                     # a URI or an absolute path, never relative
    spark.range(3).write.parquet(path)
    if path.startswith("file:") or path.startswith("/"):
        assert os.path.isdir(local)
    assert not os.path.exists(os.path.join(os.getcwd(), "file:"))


def _plan(df, capsys):
    capsys.readouterr()
    df.explain()
    return capsys.readouterr().out


def test_hot_keys_are_pre_aggregated_before_the_shuffle(spark, capsys):
    from pyspark.sql import functions as F
    from fundscope.operators import cleaning as cl
    from fundscope.operators import profile as pr
    from fundscope.operators import wordcount as wc
    # one value holds a third of all rows
    df = spark.range(30000).select(F.when(F.col("id") % 3 == 0, F.lit("hot"))
                                   .otherwise(F.col("id").cast("string")).alias("v"))
    counts = {r.v: r["count"] for r in pr.value_counts(df, "v").collect() if r.v == "hot"}
    assert counts == {"hot": 10000}
    for q in (pr.value_counts(df, "v", sort=False),
              cl.drop_duplicates(df),
              wc.word_count(df.select(F.col("v").alias("value")), sort=False)):
        plan = _plan(q, capsys)
        lines = plan.splitlines()
        first_exchange = next(i for i, ln in enumerate(lines) if "Exchange hashpartitioning" in ln)
        assert any("HashAggregate" in ln and ("partial_" in ln or "functions=[]" in ln)
                   for ln in lines[first_exchange + 1:]), plan


def test_csv_doubled_quotes_default_and_escape_option(spark):
    from fundscope.session import scratch_path as sp
    path = sp(spark, "quoted_csv")
    lines = spark.createDataFrame([("id,name",), ('1,"Bad ""quote"" row"',)], "value string")
    lines.coalesce(1).write.text(path)
    kept = readers.read_csv(spark, path, infer_schema=False).first()["name"]
    unescaped = readers.read_csv(spark, path, infer_schema=False, escape='"').first()["name"]
    # default escape is a backslash: the field is not unquoted, it is read with all its quotes
    assert kept == '"Bad ""quote"" row"'
    assert unescaped == 'Bad "quote" row'
