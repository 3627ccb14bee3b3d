"""Twin checks (DataFrame formulation == MLlib stage) and model invariants."""

import math

import pytest
from pyspark.ml import Pipeline
from pyspark.ml.feature import CountVectorizer, IDF, StringIndexer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Window
from pyspark.sql import functions as F

from fundscope.catalog import QUERIES
from fundscope.operators import encode as en
from fundscope.operators import evaluate as ev
from fundscope.operators import model as md
from fundscope.operators import text as tx
from fundscope.plans import train as tr
from fundscope.sources import fixtures as fx
from fundscope.sources import readers
from tests.conftest import SF_SMALL


@pytest.fixture(scope="module")
def docs(spark):
    d = readers.read_table(spark, SF_SMALL, "documents").select("doc_id", "text")
    return md.pretokenize(d).persist()


def test_tokenizer_and_stop_words_twin(docs):
    native = tx.remove_stop_words(tx.tokenize(docs.select("doc_id", "text"), output_col="t2"),
                                  input_col="t2", output_col="f2")
    both = docs.join(native.select("doc_id", "t2", "f2"), "doc_id")
    assert both.filter((F.col("tokens") != F.col("t2")) | (F.col("filtered") != F.col("f2"))).count() == 0


def test_vocabulary_and_idf_twin(spark, docs):
    cv = CountVectorizer(inputCol="filtered", outputCol="raw", minDF=3.0).fit(docs)
    idf = IDF(inputCol="raw", outputCol="w").fit(cv.transform(docs))
    tf = tx.term_frequencies(docs)
    vocab = tx.vocabulary(tf, docs, 3.0)
    weights = {r.term: r.idf for r in tx.idf_weights(vocab, docs).collect()}
    assert set(weights) == set(cv.vocabulary)
    for term, w in zip(cv.vocabulary, idf.idf.toArray()):
        assert math.isclose(weights[term], w, rel_tol=1e-9, abs_tol=1e-12)


def test_capped_vocabulary_keeps_the_most_frequent(spark, docs):
    tf = tx.term_frequencies(docs)
    full = {r.term: r.term_count for r in tx.vocabulary(tf, docs, 1.0).collect()}
    cut = tx.vocabulary(tf, docs, 1.0, vocab_size=30).collect()
    assert len(cut) == 30
    floor = min(r.term_count for r in cut)
    assert all(c <= floor for t, c in full.items() if t not in {r.term for r in cut})
    ml = CountVectorizer(inputCol="filtered", outputCol="raw", vocabSize=30).fit(docs)
    above = {t for t, c in full.items() if c > floor}
    assert above <= set(ml.vocabulary)


def test_threshold_rule_matches_classifier(spark):
    labelled = fx.labelled_docs(spark, SF_SMALL)
    model = tr.fit_pipeline(labelled, 2.0, 1e-4)
    scored = model.transform(labelled).withColumn(
        "rule", ev.threshold_prediction(vector_to_array("probability")))
    assert scored.filter(F.col("rule") != F.col(ev.PREDICTION_COL)).count() == 0
    p1 = tr.probability_of_one()
    assert scored.filter((p1 > 0.3) != (F.col(ev.PREDICTION_COL) == 1.0)).count() == 0


def test_weighted_f1_twin(spark):
    df = spark.createDataFrame([(0, 0.0), (0, 1.0), (1, 1.0), (1, 1.0), (1, 0.0), (2, 1.0)],
                               "final_status int, predictions double")
    ours = ev.weighted_f1(df).first()["f1"]
    theirs = ev.f1_evaluator().evaluate(df.withColumn("final_status", F.col("final_status").cast("double")))
    assert math.isclose(ours, theirs, rel_tol=1e-12)


def test_split_is_disjoint_and_complete(spark):
    parts = QUERIES["split_seeded"](spark, SF_SMALL)
    total = fx.labelled_docs(spark, SF_SMALL).count()
    assert parts.count() == total and parts.select("doc_id").distinct().count() == total


def test_param_grids():
    lr = md.logistic_regression()
    cv = tx.count_vectorizer_stage()
    assert len(md.param_grid(lr, cv)) == 12
    assert len(md.param_grid(lr, cv, md.LARGE_GRID_REG, md.LARGE_GRID_MIN_DF)) == 72
    first = md.param_grid(lr, cv)[0]
    assert first[lr.regParam] == 1e-8 and first[cv.minDF] == 55.0


def test_search_best_is_max_and_model_roundtrip(spark):
    from pyspark.ml import PipelineModel
    labelled = fx.labelled_docs(spark, SF_SMALL)
    res = tr.train(spark, labelled, reg_params=(1e-6, 1e-2), min_dfs=(2.0, 4.0))
    grid = res.grid.collect()
    best = max(grid, key=lambda r: r.metric)
    params = md.best_params(res.search.bestModel)
    assert (params["min_df"], params["reg_param"]) == (best.min_df, best.reg_param)
    from fundscope.session import scratch_path
    path = scratch_path(spark, "model")
    res.model.write().overwrite().save(path)
    again = PipelineModel.load(path)
    test = res.test.select(*labelled.columns)
    a = res.model.transform(test).select("doc_id", ev.PREDICTION_COL, "probability")
    b = again.transform(test).select("doc_id", F.col(ev.PREDICTION_COL).alias("p2"),
                                     F.col("probability").alias("q2"))
    j = a.join(b, "doc_id")
    assert j.count() == test.count()
    assert j.filter((F.col(ev.PREDICTION_COL) != F.col("p2"))).count() == 0


def test_one_hot_slots(spark):
    df = QUERIES["one_hot"](spark, SF_SMALL).collect()
    n = df[0].n_slots
    assert all(r.n_slots == n for r in df)
    assert {r.slot for r in df} == set(range(n)) | {None}


@pytest.mark.parametrize("kw, n_stages", [
    ({"use_idf": False}, 7),
    ({"one_hot": True}, 10),
    ({"use_idf": False, "one_hot": True, "text_first": False}, 9),   # TF only, one-hot, days first
])
def test_pipeline_variants(spark, kw, n_stages):
    labelled = fx.labelled_docs(spark, SF_SMALL)
    pipeline, _, _ = md.build_pipeline(min_df=2.0, reg_param=1e-4, **kw)
    assert len(pipeline.getStages()) == n_stages
    model = pipeline.fit(labelled)
    scored = model.transform(labelled)
    assert scored.count() == labelled.count()
    p1 = tr.probability_of_one()
    assert scored.filter((p1 > 0.3) != (F.col(ev.PREDICTION_COL) == 1.0)).count() == 0


def test_train_job_end_to_end(spark):
    from pyspark.ml import PipelineModel
    from fundscope.plans import prepare as pp
    from fundscope.session import scratch_path
    from fundscope.sources import sinks
    src = scratch_path(spark, "prepared")
    sinks.write_parquet(fx.labelled_docs(spark, SF_SMALL), src)
    out = tr.run_train_job(spark, src, scratch_path(spark, "model"), scratch_path(spark, "pred"),
                           search_path=scratch_path(spark, "search"),
                           reg_params=(1e-4, 1e-2), min_dfs=(2.0,))
    assert 0.0 <= out.f1 <= 1.0
    conf = out.confusion.collect()
    assert sum(r["count"] for r in conf) == readers.read_parquet(spark, out.predictions_path).count()
    assert PipelineModel.load(out.model_path) is not None
    from pyspark.ml.tuning import TrainValidationSplitModel
    reloaded = TrainValidationSplitModel.load(out.search_path)
    assert [round(m, 9) for m in reloaded.validationMetrics] == \
           [round(r.metric, 9) for r in out.grid.orderBy("candidate").collect()]


def test_split_does_not_depend_on_the_layout(spark):
    labelled = fx.labelled_docs(spark, SF_SMALL)
    parts = [[sorted(r.doc_id for r in p.select("doc_id").collect()) for p in md.split(labelled.repartition(n))] for n in (1, 2, 8)]
    assert parts[0] == parts[1] == parts[2] and all(parts[0])
    assert sorted(parts[0][0] + parts[0][1]) == sorted(r.doc_id for r in labelled.collect())


def test_features_are_fitted_once_per_fold_and_min_df(spark, monkeypatch):
    """Metrics equal a CrossValidator on the same folds, which refits the features for every candidate."""
    from pyspark.ml import Pipeline
    from pyspark.ml.tuning import CrossValidator
    tokens = tr.training_set(fx.labelled_docs(spark, SF_SMALL))
    stages, cv = md.feature_stages(min_df=2.0, tokenize=False)
    lr = md.logistic_regression(max_iter=5)
    grid = md.param_grid(lr, cv, (1e-4, 1e-1), (2.0,))
    part = md.split_part([1, 1], "x", "doc_id")
    folds = [(tokens.filter(part != k), tokens.filter(part == k)) for k in (0, 1)]
    fits = []
    real = tr.Pipeline.fit
    monkeypatch.setattr(tr.Pipeline, "fit", lambda self, *a: fits.append(1) or real(self, *a))
    got = tr.fold_metrics(folds, stages, cv, lr, grid, ev.f1_evaluator(), 2)
    assert len(fits) == 2                                       # 2 folds x 1 minDF, not 4
    monkeypatch.undo()
    plain = CrossValidator(estimator=Pipeline(stages=stages + [lr]), estimatorParamMaps=grid, evaluator=ev.f1_evaluator(),
                           numFolds=2, foldCol="fold").fit(tokens.withColumn("fold", part))
    for mine, theirs in zip(zip(*got), plain.avgMetrics):
        assert math.isclose(sum(mine) / 2, theirs, abs_tol=1e-6)


def test_frequent_terms_are_dealt_over_reducers(spark):
    docs = spark.createDataFrame([(k, ["every", f"w{k % 7}", "every"]) for k in range(200)], "doc_id long, filtered array<string>")
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        tf = tx.term_frequencies(docs)
        assert "partial_count" in tf._jdf.queryExecution().toString()
        idf = tx.idf_weights(tx.vocabulary(tf, docs, 1.0), docs)
        got = tx.tf_idf(tf, idf)
        assert "BroadcastHashJoin" not in got._jdf.queryExecution().toString()
        rows = {(r.doc_id, r.term): r.tf for r in got.collect()}
        assert rows == {(k, t): n for k in range(200) for t, n in (("every", 2), (f"w{k % 7}", 1))}
        assert tx.restrict_to_vocabulary(tf, tx.vocabulary(tf, docs, 100.0)).count() == 200
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


@pytest.mark.parametrize("size, counters, sketched", [(10, 4096, True), (10, 32, False), (100000, 4096, False)])
def test_capped_vocabulary_is_exact(spark, docs, monkeypatch, size, counters, sketched):
    tf = tx.term_frequencies(docs)
    want = {tuple(r) for r in tx.vocabulary(tf, docs, 2.0, vocab_size=size).collect()}
    counted = []
    real = tx.vocabulary
    monkeypatch.setattr(tx, "vocabulary", lambda *a, **kw: counted.append(1) or real(*a, **kw))
    assert {tuple(r) for r in tx.capped_vocabulary(docs, size, 2.0, counters=counters).collect()} == want
    assert len(counted) == (1 if sketched else 2)             # the full count runs only where the bound proves nothing


def test_capped_vocabulary_of_nothing(spark):
    none = spark.createDataFrame([(1, []), (2, None)], "doc_id long, filtered array<string>")
    assert tx.capped_vocabulary(none, 5).collect() == []


@pytest.mark.parametrize("handle", ["error", "skip", "keep"])
def test_distributed_index_equals_the_stage(spark, handle):
    rows = spark.createDataFrame([(k, ["b", "a", "c", "a", "b", "Z", None, "é"][k % 8] if k % 5 else "d") for k in range(200)], "id long, v string")
    known, other = rows.where("v <> 'Z'"), rows.where("v is not null")
    stage = en.string_indexer_stage("v", "x", handle).fit(known)
    labels = en.label_index(known, "v")
    if handle == "error":
        assert _index(en.apply_index(known, labels, "v", "x", handle)) == _index(stage.transform(known))
        for unseen in (rows.where("v is null"), rows.where("v = 'Z'")):
            with pytest.raises(Exception, match="no index"):
                en.apply_index(unseen, labels, "v", "x", handle).collect()
    else:
        assert _index(en.apply_index(rows, labels, "v", "x", handle)) == _index(stage.transform(rows))
        assert _index(en.index_strings(other, "v", "x", handle)) == _index(en.string_indexer_stage("v", "x", handle).fit(other).transform(other))


def _index(df):
    return sorted((r.id, r.x) for r in df.collect())


def test_a_million_labels(spark):
    n = 1_000_000
    rows = spark.range(n + 1000).select((F.col("id") % n).alias("v"))           # the first 1000 occur twice
    labels = en.label_index(rows, "v").cache()
    assert labels.agg(F.count("*"), F.min("index"), F.max("index"), F.count_distinct("index")).first()[:] == (n, 0, n - 1, n)
    twice = labels.where("index < 1000")
    assert twice.where(F.col("value").cast("long") >= 1000).count() == 0
    ordered = labels.where("index >= 1000").select("index", F.row_number().over(Window.orderBy("value")).alias("r"))
    assert ordered.where(F.col("index") != F.col("r") + 999).count() == 0
    assert "StringIndexer" not in str(labels._jdf.queryExecution())
    labels.unpersist()


def test_empty_label_table(spark):
    none = spark.createDataFrame([], "id long, v string")
    assert en.label_index(none, "v").collect() == [] and en.index_strings(none, "v", "x").collect() == []


def test_fit_steps_carry_no_feature_names(spark, monkeypatch):
    """The optimizer's input has no name for each feature in its schema, which every task of every step would read."""
    from pyspark.ml.classification import LogisticRegression
    rows = spark.range(40).select(F.col("id").alias("doc_id"), (F.col("id") % 2).cast("int").alias(ev.LABEL_COL),
                                  F.concat(F.lit("apple pear word"), F.col("id") % 7, F.lit(" word"), F.col("id") % 5).alias("text"),
                                  *[F.lit(i).alias(c) for i, c in enumerate(("days_campaign", "hours_prepa", "goal"))],
                                  F.lit("FR").alias("country2"), F.lit("EUR").alias("currency2"))
    seen, fit = [], LogisticRegression._fit
    monkeypatch.setattr(LogisticRegression, "_fit", lambda self, data: (seen.append(data.schema["features"].metadata), fit(self, data))[1])
    model = tr.fit_pipeline(rows, 2.0, 1e-4)
    assert [m.get("ml_attr", {}).get("attrs") for m in seen] == [None]
    plain = Pipeline(stages=md.feature_stages(min_df=2.0)[0] + [md.logistic_regression(reg_param=1e-4)]).fit(rows)
    assert abs(model.stages[-1].coefficients.toArray() - plain.stages[-1].coefficients.toArray()).max() < 1e-6
