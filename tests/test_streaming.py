"""Incremental runners over several micro-batches equal the batch jobs."""

from pyspark.sql import functions as F

from fundscope.operators import wordcount as wc
from fundscope.plans import prepare as pp
from fundscope.session import scratch_path
from fundscope.sources import fixtures as fx
from fundscope.sources import readers, sinks
from fundscope.sources.schemas import RAW_CAMPAIGN_SCHEMA
from fundscope.streaming import incremental as inc
from tests.conftest import SF_SMALL


def _same(a, b):
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_explicit_schema_scan_equals_inferred(spark):
    csv = scratch_path(spark, "campaigns_csv")
    sinks.write_sentinel_csv(fx.campaigns(spark, SF_SMALL).repartition(4), csv)
    inferred = readers.read_csv(spark, csv)
    explicit = readers.read_csv(spark, csv, schema=RAW_CAMPAIGN_SCHEMA)
    assert inferred.schema == explicit.schema and _same(inferred, explicit)


def test_prepare_stream_over_many_batches(spark):
    csv = scratch_path(spark, "campaigns_csv")
    sinks.write_sentinel_csv(fx.campaigns(spark, SF_SMALL).repartition(6), csv)
    out = scratch_path(spark, "prepared_stream")
    q = inc.start_prepare_stream(spark, csv, out, max_files_per_trigger=2)
    q.awaitTermination()
    assert len(q.recentProgress) >= 3            # the files arrived in several micro-batches
    want = pp.prepare_campaigns(readers.read_csv(spark, csv, schema=RAW_CAMPAIGN_SCHEMA))
    assert _same(readers.read_parquet(spark, out), want)


def test_word_count_stream_goes_on_after_a_restart(spark):
    lines = fx.document_lines(spark, SF_SMALL).select("value")
    first, second = lines.randomSplit([0.5, 0.5], seed=7)
    txt, out = scratch_path(spark, "lines"), scratch_path(spark, "counts")
    sinks.write_text(first, txt + "/a")
    inc.start_word_count_stream(spark, txt + "/*", out).awaitTermination()
    sinks.write_text(second, txt + "/b")          # new files arrive; the restarted query resumes
    inc.start_word_count_stream(spark, txt + "/*", out).awaitTermination()
    want = wc.word_count(readers.read_text(spark, txt + "/*"), sort=False)
    assert _same(inc.read_word_counts(spark, out), want)


def test_prepare_stream_goes_on_after_a_restart(spark):
    rows = fx.campaigns(spark, SF_SMALL)
    csv, out = scratch_path(spark, "campaigns_csv"), scratch_path(spark, "prepared_stream")
    first, second = rows.randomSplit([0.5, 0.5], seed=7)
    sinks.write_sentinel_csv(first.coalesce(1), csv + "/a")
    inc.start_prepare_stream(spark, csv + "/*", out).awaitTermination()
    sinks.write_sentinel_csv(second.coalesce(1), csv + "/b")
    inc.start_prepare_stream(spark, csv + "/*", out).awaitTermination()
    want = pp.prepare_campaigns(readers.read_csv(spark, csv + "/*", schema=RAW_CAMPAIGN_SCHEMA))
    assert _same(readers.read_parquet(spark, out), want)


def test_word_counts_read_a_bounded_number_of_files(spark):
    """After 50 batches a reader opens the last snapshot and the batches after it."""
    txt, out = scratch_path(spark, "lines"), scratch_path(spark, "counts")
    lines = fx.document_lines(spark, SF_SMALL).select("value").limit(400).repartition(50)
    sinks.write_text(lines, txt)
    q = inc.start_word_count_stream(spark, txt, out, compact_every=7, max_files_per_trigger=1)
    q.awaitTermination()
    assert len(q.recentProgress) >= 50
    counts = inc.read_word_counts(spark, out)
    assert _same(counts, wc.word_count(readers.read_text(spark, txt), sort=False))
    folders = {f.rsplit("/", 2)[1] for f in counts.inputFiles()}
    read = {r.f.rsplit("/", 2)[1] for r in inc._log(spark, out).select(F.input_file_name().alias("f")).distinct().collect()}
    assert len(folders) > 40 and len(read) <= 8 and sum(not f.startswith("batch_id=") for f in read) == 1
    # a snapshot that was written but not published is not read, and the same state can be published again
    counts.limit(1).write.parquet(f"{out}/_snapshots/999999999999-x")
    inc.compact_word_counts(spark, out, 49)
    inc.compact_word_counts(spark, out, 49)
    assert _same(inc.read_word_counts(spark, out), counts)
    assert inc._latest_snapshot(spark, out)["batch"] == 49
