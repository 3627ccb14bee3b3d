"""Logistic regression, the feature pipeline, seeded splits, grid search.

Training is MLlib's: each optimizer step is one distributed tree aggregation
of gradients; only the coefficient vector (vocabulary size + 5 doubles) goes
back and forth with the driver.  Candidates of a search are fitted
``parallelism`` at a time on a persisted training set.
"""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder, TrainValidationSplit
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fundscope.operators import encode as en
from fundscope.operators import evaluate as ev
from fundscope.operators import text as tx

# Fixed values of the trainer.
SPLIT_WEIGHTS = (0.9, 0.1)
SPLIT_SEED = 12345
REG_PARAMS = (1e-8, 1e-6, 1e-4, 1e-2)          # ladder of the first trainer
REG_PARAMS_ALT = (1e-7, 1e-5, 1e-3, 1e-1)      # ladder written as 10e-8 ... 10e-2
MIN_DFS = (55.0, 75.0, 95.0)                    # for the full-size campaign table
TRAIN_RATIO = 0.7
LARGE_GRID_REG = (1e-8, 1e-7, 1e-6, 1e-5, 1e-4, 1e-3, 1e-2, 1e-1, 1.0)   # 9 x 8 grid
LARGE_GRID_MIN_DF = (5.0, 10.0, 20.0, 30.0, 50.0, 75.0, 100.0, 125.0)


def logistic_regression(label: str = ev.LABEL_COL, features: str = "features",
                        max_iter: int = 300, tol: float = 1e-6,
                        thresholds=ev.THRESHOLDS, reg_param: float = 0.0) -> LogisticRegression:
    """L2-only logistic regression with intercept and standardization."""
    return LogisticRegression(
        featuresCol=features, labelCol=label, predictionCol=ev.PREDICTION_COL,
        rawPredictionCol=ev.RAW_PREDICTION_COL, elasticNetParam=0.0, fitIntercept=True,
        standardization=True, thresholds=list(thresholds), tol=tol, maxIter=max_iter,
        regParam=reg_param)


def feature_stages(min_df: float = 1.0, vocab_size: int = tx.DEFAULT_VOCAB_SIZE,
                   use_idf: bool = True, one_hot: bool = False, tokenize: bool = True,
                   handle_invalid: str = "keep", text_first: bool = True):
    """Stages from text to the assembled ``features`` vector.

    ``tokenize=False`` leaves out the stateless tokenizer and stop-word
    remover, for inputs that already hold ``filtered`` (see ``pretokenize``).
    ``use_idf=False`` assembles raw term counts; ``one_hot`` encodes both
    indices; ``text_first=False`` puts ``days_campaign`` before the text vector.
    """
    stages = [tx.tokenizer_stage(), tx.stop_words_stage()] if tokenize else []
    cv = tx.count_vectorizer_stage(min_df=min_df, vocab_size=vocab_size)
    stages.append(cv)
    text_col = "rawFeatures"
    if use_idf:
        stages.append(tx.idf_stage())
        text_col = "tfidf"
    stages += [en.string_indexer_stage("country2", "country_indexed", handle_invalid),
               en.string_indexer_stage("currency2", "currency_indexed", handle_invalid)]
    country, currency = "country_indexed", "currency_indexed"
    if one_hot:
        stages += [en.one_hot_stage("country_indexed", "country_onehot"),
                   en.one_hot_stage("currency_indexed", "currency_onehot")]
        country, currency = "country_onehot", "currency_onehot"
    head = (text_col, "days_campaign") if text_first else ("days_campaign", text_col)
    stages.append(en.assembler_stage(head + ("hours_prepa", "goal", country, currency)))
    return stages, cv


def build_pipeline(min_df: float = 1.0, reg_param: float = 0.0, **kw):
    """The trainer's pipeline: tokenizer, stop words, counts, IDF, two indexers,
    assembler, logistic regression (eight stages; nine or ten with one-hot)."""
    stages, cv = feature_stages(min_df=min_df, **kw)
    lr = logistic_regression(reg_param=reg_param)
    return Pipeline(stages=stages + [lr]), cv, lr


def pretokenize(df: DataFrame) -> DataFrame:
    """Run the stateless text stages once (they learn nothing from the data)."""
    return tx.stop_words_stage().transform(tx.tokenizer_stage().transform(df))


def split_key(seed: int | str, id_col: str) -> F.Column:
    """First 8 hex digits of md5(seed:id): even over 0 ... 2**32 - 1, and the
    same for any layout of the rows, cluster or engine."""
    return F.substring(F.md5(F.concat_ws(":", F.lit(str(seed)), F.coalesce(F.col(id_col).cast("string"), F.lit("")))), 1, 8)


def split_part(weights, seed: int | str, id_col: str) -> F.Column:
    """Number of the part (from 0) that a row's id falls into."""
    total, upto, part = float(sum(weights)), 0.0, F.lit(len(weights) - 1)
    cuts = []
    for w in list(weights)[:-1]:
        upto += w / total
        cuts.append(f"{min(int(upto * (1 << 32)), (1 << 32) - 1):08x}")
    for k, cut in reversed(list(enumerate(cuts))):
        part = F.when(split_key(seed, id_col) < cut, F.lit(k)).otherwise(part)
    return part


def split(df: DataFrame, weights=SPLIT_WEIGHTS, seed: int | str = SPLIT_SEED, id_col: str = "doc_id"):
    """Seeded split by id; parts are disjoint, together complete and repeatable."""
    part = split_part(weights, seed, id_col)
    return [df.filter(part == k) for k in range(len(weights))]


def param_grid(lr, cv, reg_params=REG_PARAMS, min_dfs=MIN_DFS):
    """regParam x minDF candidates (regParam varies slowest, as built)."""
    return (ParamGridBuilder()
            .addGrid(lr.regParam, list(reg_params))
            .addGrid(cv.minDF, [float(x) for x in min_dfs])
            .build())


def grid_table(spark, grid, lr, cv):
    """The candidate list as a DataFrame (candidate, reg_param, min_df)."""
    rows = [(i, float(m[lr.regParam]), float(m[cv.minDF])) for i, m in enumerate(grid)]
    return spark.createDataFrame(rows, "candidate int, reg_param double, min_df double")


def train_validation_split(pipeline, grid, evaluator=None, train_ratio: float = TRAIN_RATIO,
                           seed: int = SPLIT_SEED, parallelism: int = 4) -> TrainValidationSplit:
    return TrainValidationSplit(estimator=pipeline, estimatorParamMaps=grid,
                                evaluator=evaluator or ev.f1_evaluator(),
                                trainRatio=train_ratio, seed=seed, parallelism=parallelism)


def cross_validator(pipeline, grid, evaluator=None, num_folds: int = 3,
                    seed: int = SPLIT_SEED, parallelism: int = 4) -> CrossValidator:
    return CrossValidator(estimator=pipeline, estimatorParamMaps=grid,
                          evaluator=evaluator or ev.f1_evaluator(),
                          numFolds=num_folds, seed=seed, parallelism=parallelism)


def best_params(pipeline_model) -> dict:
    """minDF of the fitted counts stage and regParam of the fitted model."""
    from pyspark.ml.feature import CountVectorizerModel
    from pyspark.ml.classification import LogisticRegressionModel
    out = {}
    for stage in pipeline_model.stages:
        if isinstance(stage, CountVectorizerModel):
            out["min_df"] = float(stage.getMinDF())
        if isinstance(stage, LogisticRegressionModel):
            out["reg_param"] = float(stage.getRegParam())
    return out


def grid_vocabulary(spark, grid, lr, cv, tf: DataFrame, docs: DataFrame | None = None) -> DataFrame:
    """Each candidate with the number of vocabulary terms its ``minDF`` keeps.

    A large ``minDF`` can empty the vocabulary of a small table, and the fit
    then fails; this checks the grid against the data before any fit.  Each
    term emits the thresholds it reaches (at most one row per distinct
    ``minDF``), so the sizes come from one aggregation and an equi-join with
    the (tiny) candidate table.
    """
    table = grid_table(spark, grid, lr, cv)
    mins = sorted({float(m[cv.minDF]) for m in grid})
    n_docs = None
    if any(m < 1.0 for m in mins):
        n_docs = docs.select(F.count(F.lit(1))).scalar()
    thresholds = F.array(*[F.lit(m) for m in mins])
    stats = tf.groupBy("term").agg(F.count(F.lit(1)).alias("doc_freq"))
    reached = stats.select(F.explode(F.filter(
        thresholds,
        lambda m: F.col("doc_freq") >= F.when(m >= 1.0, m).otherwise(m * (n_docs if n_docs is not None else F.lit(0.0)))
    )).alias("min_df"))
    sizes = reached.groupBy("min_df").agg(F.count(F.lit(1)).alias("vocab_terms"))
    return (table.join(sizes, "min_df", "left").fillna(0, ["vocab_terms"])
                 .select("candidate", "reg_param", "min_df", "vocab_terms"))
