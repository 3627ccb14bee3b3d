"""Registered queries: one callable ``(spark, sf_dir) -> DataFrame`` per key.

Keys follow the operator inventory.  Queries that round-trip through files
write under the shared scratch area (``spark.checkpoint.dir``), each call to
a fresh path, and return the read-back DataFrame.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fundscope.functions import columns as fc
from fundscope.operators import cleaning as cl
from fundscope.operators import encode as en
from fundscope.operators import evaluate as ev
from fundscope.operators import folds as fo
from fundscope.operators import linear as ln
from fundscope.operators import model as md
from fundscope.operators import profile as pr
from fundscope.operators import text as tx
from fundscope.operators import wordcount as wc
from fundscope.plans import prepare as pp
from fundscope.plans import train as tr
from fundscope.session import scratch_path
from fundscope.sources import fixtures as fx
from fundscope.sources import readers, searches, sinks
from fundscope.sources.schemas import RAW_CAMPAIGN_SCHEMA
from fundscope.streaming import incremental as inc

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(name: str):
    def register(fn: Query) -> Query:
        QUERIES[name] = fn
        return fn
    return register


def _casted(spark, sf):
    return cl.cast_ints(fx.campaigns(spark, sf))


def _cleaned_lines_path(spark, sf) -> str:
    """C3 lines with quote runs collapsed, written once as text."""
    path = scratch_path(spark, "cleaned_lines")
    cleaned = cl.clean_quote_runs(fx.quoted_lines(spark, sf), "value")
    sinks.write_text(cleaned, path, "value")
    return path


# ---------------------------------------------------------------- sources

@query("csv_scan")
def q_csv_scan(spark, sf):
    path = scratch_path(spark, "campaigns_csv")
    sinks.write_sentinel_csv(fx.campaigns(spark, sf), path)
    return readers.read_csv(spark, path)


@query("csv_quarantine")
def q_csv_quarantine(spark, sf):
    """Scan with the declared schema: good rows by number and side, malformed lines with their file and text."""
    path = scratch_path(spark, "campaigns_csv_dirty")
    sinks.write_text(fx.dirty_campaign_lines(spark, sf), path, "value")
    good, bad = readers.read_csv_quarantined(spark, path, RAW_CAMPAIGN_SCHEMA, scratch_path(spark, "scanned"))
    return (good.select(F.lit("good").alias("side"), F.coalesce("project_id", F.lit("")).alias("line"))
            .unionByName(bad.select(F.lit("bad").alias("side"), F.col("line"))).groupBy("side", "line").agg(F.count("*").alias("n")))


@query("csv_scan_headerless")
def q_csv_scan_headerless(spark, sf):
    return readers.read_csv_headerless(spark, _cleaned_lines_path(spark, sf))


@query("text_scan")
def q_text_scan(spark, sf):
    path = scratch_path(spark, "documents_txt")
    sinks.write_text(readers.read_table(spark, sf, "documents"), path, "text")
    return readers.read_text(spark, path)


@query("parquet_scan")
def q_parquet_scan(spark, sf):
    return readers.read_table(spark, sf, "lineitem")


# ---------------------------------------------------------------- sinks

@query("parquet_sink")
def q_parquet_sink(spark, sf):
    path = scratch_path(spark, "prepared_parquet")
    sinks.write_parquet(pp.prepare_campaigns(fx.campaigns(spark, sf)), path)
    return readers.read_parquet(spark, path)


@query("parquet_sink_strict")
def q_parquet_sink_strict(spark, sf):
    path = scratch_path(spark, "prepared_elapsed_parquet")
    sinks.write_parquet_strict(pp.prepare_campaigns_elapsed(fx.campaigns(spark, sf)), path)
    return readers.read_parquet(spark, path)


@query("text_sink")
def q_text_sink(spark, sf):
    return readers.read_text(spark, _cleaned_lines_path(spark, sf))


@query("csv_sink_delimited")
def q_csv_sink_delimited(spark, sf):
    prepared = pp.prepare_campaigns(fx.campaigns(spark, sf))
    path = scratch_path(spark, "prepared_csv")
    sinks.write_csv(prepared, path, sep=";", header=True)
    return readers.read_csv(spark, path, sep=";", schema=prepared.schema, null_value=None)


# ---------------------------------------------------------------- profiling

@query("row_count")
def q_row_count(spark, sf):
    return pr.row_count(readers.read_table(spark, sf, "lineitem"))


@query("schema_profile")
def q_schema_profile(spark, sf):
    return pr.schema_profile(readers.read_table(spark, sf, "lineitem"))


@query("head_n")
def q_head_n(spark, sf):
    return pr.head_n(readers.read_table(spark, sf, "orders"), 20,
                     order_by="o_orderkey")


@query("describe_numeric")
def q_describe_numeric(spark, sf):
    cols = ["goal", "backers_count", "final_status"]
    stats = pr.describe(_casted(spark, sf), cols)
    return stats.select("summary", *[F.round(F.col(c).cast("double"), 4).alias(c) for c in cols])


@query("describe_mixed")
def q_describe_mixed(spark, sf):
    return pr.describe(fx.campaigns(spark, sf), ["name", "desc", "keywords", "country", "currency"])


@query("value_counts")
def q_value_counts(spark, sf):
    return pr.value_counts(_casted(spark, sf), "country")


@query("value_counts_pair")
def q_value_counts_pair(spark, sf):
    return pr.value_counts(_casted(spark, sf), "country", "currency")


@query("value_counts_where_null")
def q_value_counts_where_null(spark, sf):
    return pr.value_counts(_casted(spark, sf), "currency", where=F.col("country").isNull())


@query("class_balance")
def q_class_balance(spark, sf):
    return pr.class_balance(_casted(spark, sf))


@query("top_k")
def q_top_k(spark, sf):
    return pr.top_k(_casted(spark, sf), "state_changed_at", 100)


@query("distinct_values")
def q_distinct_values(spark, sf):
    return pr.distinct_values(_casted(spark, sf), "deadline")


# ---------------------------------------------------------------- columns

@query("cast_ints")
def q_cast_ints(spark, sf):
    return _casted(spark, sf)


@query("project")
def q_project(spark, sf):
    return cl.project(_casted(spark, sf), ["goal", "final_status"])


@query("drop_columns")
def q_drop_columns(spark, sf):
    return cl.drop_columns(_casted(spark, sf), "disable_communication")


@query("drop_leakage")
def q_drop_leakage(spark, sf):
    return cl.drop_leakage(cl.drop_columns(_casted(spark, sf), "disable_communication"))


# ---------------------------------------------------------------- filters

@query("filter_durations")
def q_filter_durations(spark, sf):
    return cl.filter_durations(pp.campaign_features(fx.campaigns(spark, sf)))


@query("filter_goal")
def q_filter_goal(spark, sf):
    return cl.filter_goal(_casted(spark, sf))


@query("filter_classes")
def q_filter_classes(spark, sf):
    return cl.filter_classes(_casted(spark, sf))


@query("filter_sql_predicate")
def q_filter_sql_predicate(spark, sf):
    return cl.filter_predicate(_casted(spark, sf), "final_status = 0 OR final_status = 1")


@query("null_fill")
def q_null_fill(spark, sf):
    return cl.null_fill(pp.campaign_features(fx.campaigns(spark, sf)))


@query("drop_duplicates")
def q_drop_duplicates(spark, sf):
    return cl.drop_duplicates(fx.dedup_rows(spark, sf))


# ---------------------------------------------------------------- scalar functions

@query("repair_country")
def q_repair_country(spark, sf):
    return fx.campaigns(spark, sf).select(
        "project_id", "country", "currency", fc.repair_country().alias("country2"))


@query("validate_currency")
def q_validate_currency(spark, sf):
    return fx.campaigns(spark, sf).select(
        "project_id", "currency", fc.validate_currency().alias("currency2"))


@query("lower_text")
def q_lower_text(spark, sf):
    return cl.lower_text(fx.campaigns(spark, sf)).select("project_id", "name", "desc", "keywords")


@query("clean_quote_runs")
def q_clean_quote_runs(spark, sf):
    return fx.quoted_lines(spark, sf).select(
        "line_id", fc.collapse_quote_runs("value").alias("replaced"))


@query("clean_quote_runs_columns")
def q_clean_quote_runs_columns(spark, sf):
    return cl.clean_quote_runs(fx.quoted_columns(spark, sf), ["name", "desc"])


@query("epoch_to_text")
def q_epoch_to_text(spark, sf):
    return _casted(spark, sf).select(
        "project_id", *[fc.epoch_to_text(c).alias(f"{c}2") for c in cl.EPOCH_COLUMNS])


@query("campaign_days")
def q_campaign_days(spark, sf):
    return cl.add_durations(_casted(spark, sf)).select("project_id", "days_campaign")


@query("prep_hours")
def q_prep_hours(spark, sf):
    return cl.add_durations(_casted(spark, sf)).select("project_id", "hours_prepa")


@query("campaign_days_elapsed")
def q_campaign_days_elapsed(spark, sf):
    return cl.add_elapsed_durations(_casted(spark, sf)).select("project_id", "days_campaign")


@query("prep_hours_elapsed")
def q_prep_hours_elapsed(spark, sf):
    return cl.add_elapsed_durations(_casted(spark, sf)).select("project_id", "hours_prepa")


@query("concat_text")
def q_concat_text(spark, sf):
    return cl.add_text(fx.campaigns(spark, sf)).select("project_id", "text")


@query("concat_text_null_literal")
def q_concat_text_null_literal(spark, sf):
    return cl.add_text(fx.campaigns(spark, sf), null_literal=True).select("project_id", "text")


@query("sentinel_to_null")
def q_sentinel_to_null(spark, sf):
    path = scratch_path(spark, "campaigns_csv_raw")
    sinks.write_sentinel_csv(fx.campaigns(spark, sf), path)
    raw = readers.read_csv(spark, path, infer_schema=False, null_value=None)
    cols = ["keywords", "country", "disable_communication", "created_at"]
    return raw.select("project_id", *[fc.sentinel_to_null(c).alias(c) for c in cols])


@query("null_or_zero_to_sentinel")
def q_null_or_zero_to_sentinel(spark, sf):
    return _casted(spark, sf).select("project_id", fc.null_or_zero_to_sentinel("goal").alias("goal"))


# ---------------------------------------------------------------- word count, jobs

@query("split_words")
def q_split_words(spark, sf):
    return wc.split_words(fx.document_lines(spark, sf), keep=["doc_id"])


@query("word_count")
def q_word_count(spark, sf):
    return wc.word_count(fx.document_lines(spark, sf))


@query("text_clean_roundtrip")
def q_text_clean_roundtrip(spark, sf):
    src = scratch_path(spark, "quoted_lines_txt")
    sinks.write_text(fx.quoted_lines(spark, sf), src, "value")
    return pp.text_clean_roundtrip(spark, src, scratch_path(spark, "replaced_txt"))


@query("prepare_campaigns")
def q_prepare_campaigns(spark, sf):
    return pp.prepare_campaigns(fx.campaigns(spark, sf))


@query("prepare_campaigns_elapsed")
def q_prepare_campaigns_elapsed(spark, sf):
    return pp.prepare_campaigns_elapsed(fx.campaigns(spark, sf))


# ---------------------------------------------------------------- text features


# Fixed values of the text queries.  The labelled table is small, so minDF is
# 5 / 10 / 20 there (55 / 75 / 95 empty the vocabulary of a few hundred rows).
TEXT_MIN_DF = 5.0
CAPPED_VOCAB_SIZE = 50
LABELLED_MIN_DFS = (5.0, 10.0, 20.0)
FIT_REG_PARAM = 1e-4
SEARCH_FOLDS = 3


def _documents(spark, sf):
    return readers.read_table(spark, sf, "documents").select("doc_id", "text")


def _filtered_docs(spark, sf):
    return tx.remove_stop_words(tx.tokenize(_documents(spark, sf)))


def _round(col, digits=6):
    return F.round(F.col(col), digits).alias(col)


@query("regex_tokenize")
def q_regex_tokenize(spark, sf):
    tokens = tx.tokenizer_stage().transform(_documents(spark, sf))
    return tx.explode_positions(tokens, "doc_id", "tokens")


@query("remove_stop_words")
def q_remove_stop_words(spark, sf):
    filtered = md.pretokenize(_documents(spark, sf))
    return tx.explode_positions(filtered, "doc_id", "filtered")


@query("vocabulary")
def q_vocabulary(spark, sf):
    docs = _filtered_docs(spark, sf)
    return tx.vocabulary(tx.term_frequencies(docs), docs, TEXT_MIN_DF)


@query("count_vectorize")
def q_count_vectorize(spark, sf):
    docs = _filtered_docs(spark, sf)
    tf = tx.stored_postings(docs)
    vocab = tx.vocabulary(tf, docs, TEXT_MIN_DF)
    return tx.restrict_to_vocabulary(tf, vocab).select("doc_id", "term", F.col("tf").alias("count"))


@query("count_vectorize_capped")
def q_count_vectorize_capped(spark, sf):
    docs = _filtered_docs(spark, sf)
    tf = tx.stored_postings(docs)
    vocab = tx.capped_vocabulary(docs, CAPPED_VOCAB_SIZE, tf=tf)
    return tx.restrict_to_vocabulary(tf, vocab).select("doc_id", "term", F.col("tf").alias("count"))


@query("idf_weights")
def q_idf_weights(spark, sf):
    docs = _filtered_docs(spark, sf)
    vocab = tx.vocabulary(tx.term_frequencies(docs), docs, TEXT_MIN_DF)
    return tx.idf_weights(vocab, docs).select("term", "doc_freq", _round("idf"))


@query("tf_idf")
def q_tf_idf(spark, sf):
    docs = _filtered_docs(spark, sf)
    tf = tx.stored_postings(docs)
    idf = tx.idf_weights(tx.vocabulary(tf, docs, TEXT_MIN_DF), docs)
    return tx.tf_idf(tf, idf).select("doc_id", "term", "tf", _round("tfidf"))


# ---------------------------------------------------------------- encoders

def _prepared(spark, sf):
    return pp.prepare_campaigns(fx.campaigns(spark, sf))


@query("string_index")
def q_string_index(spark, sf):
    docs = readers.read_table(spark, sf, "documents").select("doc_id", "source")
    return en.index_strings(docs, "source", "source_index", "error")


@query("string_index_skip")
def q_string_index_skip(spark, sf):
    return en.index_strings(_prepared(spark, sf), "currency2", "currency_indexed", "skip") \
        .select("project_id", "currency2", "currency_indexed")


@query("string_index_keep")
def q_string_index_keep(spark, sf):
    return en.index_strings(_prepared(spark, sf), "currency2", "currency_indexed", "keep") \
        .select("project_id", "currency2", "currency_indexed")


@query("one_hot")
def q_one_hot(spark, sf):
    docs = readers.read_table(spark, sf, "documents").select("doc_id", "source")
    indexed = en.string_indexer_stage("source", "source_index", "error").fit(docs).transform(docs)
    encoder = en.one_hot_stage("source_index", "source_vec").fit(indexed)
    n_slots = encoder.categorySizes[0] - 1
    return encoder.transform(indexed).select("doc_id", "source", F.lit(n_slots).alias("n_slots"),
                                             en.one_hot_slot("source_index", n_slots).alias("slot"))


@query("assemble_features")
def q_assemble_features(spark, sf):
    from pyspark.ml import Pipeline
    from pyspark.ml.feature import CountVectorizerModel, VectorSlicer
    from pyspark.ml.functions import vector_to_array
    docs = fx.labelled_docs(spark, sf)
    stages, _ = md.feature_stages(min_df=TEXT_MIN_DF)
    fitted = Pipeline(stages=stages).fit(docs)
    terms = next(len(s.vocabulary) for s in fitted.stages if isinstance(s, CountVectorizerModel))
    names = ["days_campaign", "hours_prepa", "goal", "country_indexed", "currency_indexed"]
    last = VectorSlicer(inputCol="features", outputCol="last", indices=list(range(terms, terms + len(names))))
    feats = last.transform(fitted.transform(docs)).withColumn("last", vector_to_array("last"))
    return feats.select(
        "doc_id", F.lit(terms + len(names)).alias("n_features"), F.round(en.vector_sum("tfidf"), 6).alias("tfidf_sum"),
        *[F.round(F.col("last")[i], 6).alias(c) for i, c in enumerate(names)])


# ---------------------------------------------------------------- decisions and metrics

def _scored_by_rule(spark, sf):
    """Labelled rows with a deterministic p(1) and the thresholded class."""
    docs = fx.labelled_docs(spark, sf)
    p1 = (F.col("doc_id") % 97) / F.lit(96.0)
    return docs.select("doc_id", "final_status", p1.alias("p1")).withColumn(
        ev.PREDICTION_COL, ev.threshold_prediction(F.array(1 - F.col("p1"), F.col("p1"))))


@query("threshold_predict")
def q_threshold_predict(spark, sf):
    return _scored_by_rule(spark, sf).select("doc_id", "final_status", _round("p1"),
                                             ev.PREDICTION_COL)


@query("f1_score")
def q_f1_score(spark, sf):
    return ev.weighted_f1(_scored_by_rule(spark, sf)).select(_round("f1"))


@query("confusion_matrix")
def q_confusion_matrix(spark, sf):
    return ev.confusion_matrix(_scored_by_rule(spark, sf))


# ---------------------------------------------------------------- fit, search, persistence

# A fitted model's largest gradient entry (by a standardised weight) at which it counts as optimal, and the largest
# difference between a relational score and the model's own.
OPTIMAL_RESIDUAL = 1e-5
SCORE_DIFFERENCE = 1e-6

_FITTED: dict = {}


def _fitted(spark, sf, rows: DataFrame, which: str, **options):
    """The pipeline fitted on ``rows``, once a session for the same table, rows (named ``which``) and options."""
    key = (spark.sparkContext.applicationId, sf, which, tuple(sorted(options.items())))
    if key not in _FITTED:
        _FITTED[key] = tr.fit_pipeline(rows, TEXT_MIN_DF, FIT_REG_PARAM, **options)
    return _FITTED[key]


def _split_fit(spark, sf, **options):
    train, test = md.split(fx.labelled_docs(spark, sf))
    return _fitted(spark, sf, train, "train", **options), test


def _compared(spark, model, docs: DataFrame, scored: DataFrame) -> DataFrame:
    """What the relational score of ``model`` says of ``docs``, beside ``scored`` (doc_id, p1, predictions) of the model itself.

    doc_id, final_status, ``n_terms`` (vocabulary terms in the document),
    ``score_agrees`` and ``class_agrees``.
    """
    linear = ln.from_pipeline(spark, model)
    tokens = md.pretokenize(docs)
    terms = linear.table.where("kind = 'term'").select(F.col("value").alias("term"))
    n_terms = (tx.salted_join(tx.term_frequencies(tokens), terms).groupBy("doc_id").agg(F.count("*").alias("n_terms")))
    theirs = scored.select("doc_id", F.col("p1").alias("_p1"), F.col(ev.PREDICTION_COL).alias("_class"))
    return (ln.scored(tokens, linear).join(theirs, "doc_id").join(n_terms, "doc_id", "left").fillna(0, ["n_terms"])
            .select("doc_id", ev.LABEL_COL, "n_terms", (F.abs(F.col("p1") - F.col("_p1")) < SCORE_DIFFERENCE).alias("score_agrees"),
                    (F.col(ev.PREDICTION_COL) == F.col("_class")).alias("class_agrees")))


def _own_scores(scored: DataFrame) -> DataFrame:
    return scored.select("doc_id", tr.probability_of_one().alias("p1"), ev.PREDICTION_COL)


@query("logistic_fit")
def q_logistic_fit(spark, sf):
    """Each coefficient's feature in the training rows, and that the fit is optimal there."""
    docs = fx.labelled_docs(spark, sf)
    model = _fitted(spark, sf, docs, "all")
    found = ln.residuals(md.pretokenize(docs), ln.from_pipeline(spark, model))
    return found.select("kind", F.coalesce("name", F.lit("")).alias("name"), "n_rows", _round("x_sum", 4), _round("x_std", 4),
                        (F.col("residual") < OPTIMAL_RESIDUAL).alias("optimal"))


@query("split_seeded")
def q_split_seeded(spark, sf):
    train, test = md.split(fx.labelled_docs(spark, sf))
    return (train.select("doc_id", F.lit(0).alias("part"))
            .unionByName(test.select("doc_id", F.lit(1).alias("part"))))


@query("pipeline_predict_tf_onehot")
def q_pipeline_predict_tf_onehot(spark, sf):
    """Term counts without IDF, both indices one-hot, ``days_campaign`` first."""
    model, test = _split_fit(spark, sf, use_idf=False, one_hot=True, text_first=False)
    return _compared(spark, model, test, _own_scores(model.transform(test)))


@query("pipeline_predict")
def q_pipeline_predict(spark, sf):
    model, test = _split_fit(spark, sf)
    return _compared(spark, model, test, _own_scores(model.transform(test)))


def _grid_vocabulary(spark, sf, reg_params, min_dfs):
    docs = tx.remove_stop_words(tx.tokenize(fx.labelled_docs(spark, sf)))
    lr, cv = md.logistic_regression(), tx.count_vectorizer_stage()
    grid = md.param_grid(lr, cv, reg_params, min_dfs)
    return md.grid_vocabulary(spark, grid, lr, cv, tx.term_frequencies(docs), docs)


@query("param_grid")
def q_param_grid(spark, sf):
    return _grid_vocabulary(spark, sf, md.REG_PARAMS, md.MIN_DFS)


@query("param_grid_alt")
def q_param_grid_alt(spark, sf):
    """The ladder of the other trainers."""
    return _grid_vocabulary(spark, sf, md.REG_PARAMS_ALT, md.MIN_DFS)


@query("param_grid_large")
def q_param_grid_large(spark, sf):
    return _grid_vocabulary(spark, sf, md.LARGE_GRID_REG, md.LARGE_GRID_MIN_DF)


def _searched(spark, sf, num_folds=None):
    key = (spark.sparkContext.applicationId, sf, "search", num_folds)
    if key not in _FITTED:
        _FITTED[key] = tr.train(spark, fx.labelled_docs(spark, sf), min_dfs=LABELLED_MIN_DFS, num_folds=num_folds)
    return _FITTED[key]


@query("grid_search")
def q_grid_search(spark, sf):
    return _searched(spark, sf).grid.withColumnRenamed("metric", "f1")


def held_out_f1(spark, sf) -> float:
    """Weighted F1 of the search's winner on the held-out rows."""
    return float(ev.weighted_f1(_searched(spark, sf).scored).first()["f1"])


@query("grid_results")
def q_grid_results(spark, sf):
    """The candidates of a saved search, read back from its files, with what the live search said of them."""
    found = _searched(spark, sf)
    path = scratch_path(spark, "search")
    sinks.save_model(found.search, path)
    saved = searches.read_search(spark, path)
    live = found.grid.withColumnRenamed("metric", "live")
    value = lambda name: F.col("params")[name].cast("double")
    rows = saved.join(live.select("candidate", "live", F.max("live").over(Window.partitionBy()).alias("best")), "candidate")
    return rows.select(
        F.col("candidate").cast("int").alias("candidate"), value("regParam").alias("reg_param"), value("minDF").alias("min_df"),
        (F.abs(F.col("metric") - F.col("live")) < 1e-12).alias("metric_kept"), F.col("metric").between(0, 1).alias("metric_in_range"),
        (~F.col("is_best") | (F.col("live") == F.col("best"))).alias("best_is_largest"))


@query("best_params")
def q_best_params(spark, sf):
    """Each candidate beside the winner: that it scores no better, and that the winner's fitted stages hold the winner's parameters."""
    found = _searched(spark, sf)
    best = md.best_params(found.search.bestModel)
    top = F.max_by(F.struct("reg_param", "min_df", "metric"), F.struct("metric", -F.col("candidate"))).over(Window.partitionBy())
    rows = found.grid.withColumn("top", top)
    return rows.select("candidate", "reg_param", "min_df", (F.col("metric") <= F.col("top.metric")).alias("no_better"),
                       ((F.col("top.min_df") == best["min_df"]) & (F.col("top.reg_param") == best["reg_param"])).alias("stages_hold_winner"))


@query("cross_validate")
def q_cross_validate(spark, sf):
    return _searched(spark, sf, 3).grid.withColumnRenamed("metric", "f1")


def _training_folds(spark, sf):
    """Training rows and their fold, as the cross-validation has them."""
    train, _ = md.split(fx.labelled_docs(spark, sf))
    return train, md.split_part([1] * SEARCH_FOLDS, f"{md.SPLIT_SEED}:fold", "doc_id")


@query("fold_vocabulary")
def q_fold_vocabulary(spark, sf):
    """Vocabulary and IDF weights of each fold's training rows, for each minDF."""
    train, part = _training_folds(spark, sf)
    tf = tx.term_frequencies(tx.remove_stop_words(tx.tokenize(train)))
    sizes = fo.row_counts(train, part, SEARCH_FOLDS)
    found = fo.fold_vocabularies(fo.term_statistics(tf, part, SEARCH_FOLDS), sizes, LABELLED_MIN_DFS)
    return found.select("fold", "min_df", "term", "doc_freq", "term_count", _round("idf"))


@query("fold_labels")
def q_fold_labels(spark, sf):
    """Category indices of each fold's training rows."""
    train, part = _training_folds(spark, sf)
    found = [fo.label_indices(fo.label_statistics(train, c, part, SEARCH_FOLDS)).select("fold", F.lit(c).alias("column"), "value", "index")
             for c in ("country2", "currency2")]
    return found[0].unionByName(found[1])


@query("model_roundtrip")
def q_model_roundtrip(spark, sf):
    """The published version, loaded again, scores as the model does."""
    from pyspark.ml import PipelineModel
    model, test = _split_fit(spark, sf)
    root = scratch_path(spark, "pipeline_model")
    sinks.publish_model(model, root)
    again = PipelineModel.load(sinks.latest_model_path(spark, root))
    return _compared(spark, model, test, _own_scores(again.transform(test)))


@query("predictions_sink")
def q_predictions_sink(spark, sf):
    """The written predictions, read back: sizes of the vectors, and that the scores are the model's."""
    from pyspark.ml.functions import vector_to_array
    model, test = _split_fit(spark, sf)
    path = scratch_path(spark, "predictions")
    sinks.write_predictions(model.transform(test), path, ("doc_id", "features", ev.LABEL_COL,
                                                          ev.PREDICTION_COL, ev.RAW_PREDICTION_COL))
    written = readers.read_parquet(spark, path)
    p1 = 1 / (1 + F.exp(-vector_to_array(ev.RAW_PREDICTION_COL)[1]))
    sizes = written.select("doc_id", F.unwrap_udt("features")["size"].alias("_size"), F.size(vector_to_array("features")).alias("_length"))
    compared = _compared(spark, model, test, written.select("doc_id", p1.alias("p1"), ev.PREDICTION_COL))
    return compared.join(sizes.select("doc_id", F.coalesce("_size", "_length").alias("n_features")), "doc_id")


# ---------------------------------------------------------------- incremental (Structured Streaming)



@query("prepare_campaigns_incremental")
def q_prepare_campaigns_incremental(spark, sf):
    csv = scratch_path(spark, "campaigns_csv_stream")
    sinks.write_sentinel_csv(fx.campaigns(spark, sf), csv)
    out = scratch_path(spark, "prepared_stream")
    inc.start_prepare_stream(spark, csv, out).awaitTermination()
    return readers.read_parquet(spark, out)


@query("word_count_incremental")
def q_word_count_incremental(spark, sf):
    txt = scratch_path(spark, "documents_txt_stream")
    sinks.write_text(readers.read_table(spark, sf, "documents"), txt, "text")
    out = scratch_path(spark, "word_counts_stream")
    inc.start_word_count_stream(spark, txt, out).awaitTermination()
    return inc.read_word_counts(spark, out)
