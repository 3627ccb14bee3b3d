"""Scalar rules on hand-written rows (the traps of the survey)."""

from pyspark.sql import functions as F

from fundscope.functions import columns as fc


def _one(spark, expr, schema, rows):
    df = spark.createDataFrame(rows, schema)
    return [r[0] for r in df.select(expr).collect()]


def test_tolerant_int(spark):
    got = _one(spark, fc.tolerant_int("x"), "x string",
               [("12",), ("99.5",), ("-1.5",), ("abc",), (None,), ("1e3",), ("99999999999",)])
    assert got == [12, 99, -1, None, None, 1000, None]


def test_split_on_space_follows_jvm_rule(spark):
    got = _one(spark, fc.split_on_space("x"), "x string",
               [("a  b ",), ("",), ("   ",), (" lead",), ("a b",)])
    assert got == [["a", "", "b"], [""], [], ["", "lead"], ["a", "b"]]


def test_truncated_division(spark):
    got = _one(spark, fc.truncated_div("x", 86400), "x bigint",
               [(90000,), (-90000,), (-86400,), (0,), (None,)])
    assert got == [1, -1, -1, 0, None]


def test_elapsed_days_and_hours(spark):
    df = spark.createDataFrame([(200000, 0, 100), (None, 0, 1), (5, 7200, None)],
                               "deadline int, launched_at int, created_at int")
    rows = df.select(fc.elapsed_whole_days("deadline", "launched_at").alias("d"),
                     fc.elapsed_whole_hours("launched_at", "created_at").alias("h")).collect()
    assert [(r.d, r.h) for r in rows] == [(2, 0.0), (-1, 0.0), (0, -1.0)]


def test_currency_and_country(spark):
    df = spark.createDataFrame([(None, "USD"), ("FR", "EU"), (None, None), ("DE", "EUR")],
                               "country string, currency string")
    rows = df.select(fc.repair_country().alias("c"), fc.validate_currency().alias("u")).collect()
    assert [(r.c, r.u) for r in rows] == [("USD", "USD"), ("FR", None), (None, None), ("DE", "EUR")]


def test_concat_null_handling(spark):
    df = spark.createDataFrame([("a", None, "c")], "a string, b string, c string")
    r = df.select(fc.concat_text("a", "b", "c").alias("x"),
                  fc.concat_text_null_literal("a", "b", "c").alias("y")).first()
    assert r.x == "a c" and r.y == "a null c"


def test_epoch_text_is_session_independent(spark):
    df = spark.createDataFrame([(907372800,), (0,)], "e int")
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        got = [r[0] for r in df.select(fc.epoch_to_text("e")).collect()]
        back = df.select(fc.ntz_to_epoch(F.lit("1998-10-03 00:00:00").cast("timestamp_ntz"))).first()[0]
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert got == ["1998-10-03 00:00:00", "1970-01-01 00:00:00"]
    assert back == 907372800


def test_calendar_days_vs_elapsed(spark):
    # 23:00 -> 01:00 two days later: 2 calendar days, 1 elapsed day
    df = spark.createDataFrame([(86400 * 3 + 3600, 86400 + 82800)], "deadline int, launched_at int")
    r = df.select(fc.calendar_days(fc.epoch_to_text("deadline"), fc.epoch_to_text("launched_at")).alias("c"),
                  fc.elapsed_whole_days("deadline", "launched_at").alias("e")).first()
    assert (r.c, r.e) == (2, 1)


def test_quote_runs(spark):
    got = _one(spark, fc.collapse_quote_runs("x"), "x string", [('a"""b""c"d',), ("none",)])
    assert got == ['a b c"d', "none"]


def test_regex_tokens_ascii_word_class(spark):
    got = _one(spark, fc.regex_tokens("x"), "x string", [("Héllo, WORLD!! x_1",), ("",), (None,)])
    assert got == [["h", "llo", "world", "x_1"], [], None]


def test_sentinels(spark):
    got = _one(spark, fc.sentinel_to_null("x"), "x string", [("false",), ("true",), (None,)])
    assert got == [None, "true", None]
    got = _one(spark, fc.null_or_zero_to_sentinel("x"), "x double", [(0.0,), (None,), (2.5,)])
    assert got == [-1.0, -1.0, 2.5]


def test_no_python_udf_in_cleaning_job(spark, capsys):
    from fundscope.plans.prepare import prepare_campaigns
    from fundscope.sources.fixtures import campaigns
    from tests.conftest import SF_SMALL
    capsys.readouterr()
    prepare_campaigns(campaigns(spark, SF_SMALL)).explain("formatted")
    plan = capsys.readouterr().out
    assert "EvalPython" not in plan and "PythonUDF" not in plan
    assert plan.count("lineitem.parquet") == 1


def test_describe_number_prefilter_equals_try_cast(spark):
    from fundscope.operators.profile import _text_as_double
    vals = [" 12", "-.5", "+3e2", "NaN", "nan", "Infinity", "-Infinity", "inf", "1d", "2F",
            "0x1p3", "abc", "N12", "", " ", None, "1,5", ".", "e5", "Brand#13"]
    df = spark.createDataFrame([(v,) for v in vals], "x string")
    rows = df.select(_text_as_double(F.col("x")).alias("a"),
                     F.col("x").try_cast("double").alias("b")).collect()
    for v, r in zip(vals, rows):
        same = (r.a == r.b) or (r.a is None and r.b is None) or (r.a != r.a and r.b != r.b)
        assert same, (v, r.a, r.b)


def test_stop_words_are_sparks_own(spark):
    from pyspark.ml.feature import StopWordsRemover

    from fundscope.functions.stopwords import default_stop_words
    assert list(default_stop_words()) == list(StopWordsRemover.loadDefaultStopWords("english"))


def test_truncated_division_is_exact_over_bigint(spark):
    from fundscope.functions import columns as fc
    rows = [(2**63 - 1,), (-(2**63) + 1,), (2**53 + 1,), (-7,), (None,)]
    got = [r[0] for r in spark.createDataFrame(rows, "x long").select(fc.truncated_div("x", 2)).collect()]
    assert got == [(2**63 - 1) // 2, -((2**63 - 1) // 2), (2**53 + 1) // 2, -3, None]


def test_describe_keeps_all_digits(spark):
    from fundscope.operators import profile as pr
    df = spark.createDataFrame([(2**53 + 1, "a"), (5, "3")], "x long, y string")
    got = {r.summary: (r.x, r.y) for r in pr.describe(df).collect()}
    assert got["max"] == (str(2**53 + 1), "a") and got["min"] == ("5", "3") and got["count"] == ("2", "2")


def test_readers_see_new_columns_and_sinks_refuse_unknown_ones(spark, tmp_path):
    import pytest

    from fundscope.sources import readers, sinks
    path = f"{tmp_path}/t.parquet"
    spark.range(3).write.parquet(path)
    assert readers.read_table(spark, str(tmp_path), "t").columns == ["id"]
    spark.range(3).selectExpr("id", "id + 1 as b").write.mode("overwrite").parquet(path)
    assert readers.read_table(spark, str(tmp_path), "t").columns == ["id", "b"]
    with pytest.raises(ValueError):
        sinks.write_predictions(spark.range(3), f"{tmp_path}/p", ("id", "nope"))


def test_checkpoint_folder_must_be_named_off_local(monkeypatch):
    import pytest

    from fundscope import session

    class Context:
        master = "yarn"

    class Session:
        sparkContext = Context()

    monkeypatch.setattr(session, "_conf_checkpoint_dir", lambda s: None)
    with pytest.raises(RuntimeError):
        session.ensure_checkpoint_dir(Session())
