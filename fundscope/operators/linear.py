"""A fitted logistic pipeline as a table: scores by join and sum, optimality by one aggregation.

``from_pipeline`` writes the whole fitted pipeline down as rows: a term with its
weight and IDF, a category with its index (or its one-hot slot), a number, the
intercept.  Scoring a table of documents is then relational -- the long form of
the features joined with these rows, weight times value summed up per document
-- with no vectors and no Python, so any SQL engine can do it from the stored
table.  ``residuals`` says how far a model is from the optimum of its training
problem: one aggregation by coefficient gives the gradient of the penalised
likelihood there.

Joins: postings are dealt over several reducers for each term (a term of every
document is no hot key); numbers and categories join with tables that have a row
per column or category.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fundscope.operators import evaluate as ev
from fundscope.operators import text as tx

#: kind: term, number, category or intercept.  column: the source column.  value: the term or the category (null: any
#: other category).  position: place in the coefficient vector (-1: intercept).  A value of the feature is scale times
#: the term count, the number, or 1 for a category.
SCHEMA = "kind string, column string, value string, position int, weight double, scale double"


@dataclass
class LinearModel:
    table: DataFrame                    # SCHEMA
    tokens: str | None                  # column of filtered tokens
    numbers: tuple[str, ...]
    categories: tuple[str, ...]
    reg_param: float
    thresholds: tuple[float, ...]


def _category_rows(column: str, labels: list[str], position: int, weights, one_hot: int | None):
    """Rows of one category column; ``one_hot``: number of slots, the category after the last one is all zeros."""
    for index, value in enumerate([*labels, None]):
        if one_hot is None:
            yield ("category", column, value, position, float(weights[position]), float(index))
        elif index < one_hot:
            yield ("category", column, value, position + index, float(weights[position + index]), 1.0)
        else:
            yield ("category", column, value, None, 0.0, 0.0)


def from_pipeline(spark: SparkSession, model: PipelineModel) -> LinearModel:
    """The table of a fitted pipeline of ``operators.model``.

    The rows come from the model on the driver, which holds its vocabulary (at
    most ``vocabSize`` terms) and labels anyway.
    """
    by_output, assembler, fitted = {}, None, None
    for stage in model.stages:
        kind = type(stage).__name__
        if kind == "VectorAssembler":
            assembler = stage
        elif kind == "LogisticRegressionModel":
            fitted = stage
        elif kind == "OneHotEncoderModel":
            by_output.update({o: (kind, stage, i) for o, i in zip(stage.getOutputCols(), stage.getInputCols())})
        else:
            by_output[stage.getOutputCol()] = (kind, stage, stage.getInputCol())
    weights, rows, position = fitted.coefficients.toArray(), [], 0
    tokens, numbers, categories = None, [], []
    for column in assembler.getInputCols():
        kind, stage, source = by_output.get(column, (None, None, column))
        if kind in ("IDFModel", "CountVectorizerModel"):
            scales = stage.idf.toArray() if kind == "IDFModel" else None
            counts = by_output[source][1] if kind == "IDFModel" else stage
            tokens = counts.getInputCol()
            rows += [("term", tokens, t, position + k, float(weights[position + k]), 1.0 if scales is None else float(scales[k]))
                     for k, t in enumerate(counts.vocabulary)]
            position += len(counts.vocabulary)
        elif kind in ("StringIndexerModel", "OneHotEncoderModel"):
            slots = None
            if kind == "OneHotEncoderModel":
                slots = stage.categorySizes[stage.getInputCols().index(source)] - int(stage.getDropLast())
                _, stage, source = by_output[source]
            rows += _category_rows(source, list(stage.labels), position, weights, slots)
            categories.append(source)
            position += 1 if slots is None else slots
        else:
            rows.append(("number", column, None, position, float(weights[position]), 1.0))
            numbers.append(column)
            position += 1
    if position != len(weights):
        raise ValueError(f"{len(weights)} coefficients, {position} features")
    rows.append(("intercept", None, None, -1, float(fitted.intercept), 1.0))
    return LinearModel(spark.createDataFrame(rows, SCHEMA), tokens, tuple(numbers), tuple(categories),
                       float(fitted.getRegParam()), tuple(fitted.getThresholds()))


def _pairs(columns, kind: str) -> Column:
    return F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast(kind).alias("of")) for c in columns])).alias("p")


def features(docs: DataFrame, model: LinearModel, id_col: str = "doc_id") -> DataFrame:
    """(id, position, weight, x): the features that are not zero, in long form; ids are unique."""
    table, key, out = model.table, F.col(id_col).alias("id"), []
    if model.tokens:
        terms = table.where("kind = 'term'").select(F.col("value").alias("term"), "position", "weight", "scale")
        postings = tx.term_frequencies(docs, id_col, model.tokens)
        out.append(tx.salted_join(postings, terms).select(key, "position", "weight", (F.col("tf") * F.col("scale")).alias("x")))
    if model.numbers:
        numbers = table.where("kind = 'number'").select("column", "position", "weight")
        listed = docs.select(key, _pairs(model.numbers, "double")).select("id", "p.column", F.col("p.of").alias("x"))
        out.append(listed.join(numbers, "column").select("id", "position", "weight", "x"))
    if model.categories:
        rows = table.where("kind = 'category'").select("column", "value", F.struct("position", "weight", "scale").alias("f"))
        other = rows.where("value is null").select("column", F.col("f").alias("other"))
        listed = docs.select(key, _pairs(model.categories, "string")).select("id", "p.column", F.col("p.of").alias("value"))
        found = listed.join(rows, ["column", "value"], "left").join(other, "column").select("id", F.coalesce("f", "other").alias("f"))
        out.append(found.select("id", "f.position", "f.weight", F.col("f.scale").alias("x")))
    everything = out[0]
    for more in out[1:]:
        everything = everything.unionByName(more)
    return everything.where("x <> 0")


def scored(docs: DataFrame, model: LinearModel, id_col: str = "doc_id", label: str = ev.LABEL_COL) -> DataFrame:
    """id, label, ``margin``, ``p1`` and the thresholded class of each document."""
    table = model.table
    sums = features(docs, model, id_col).groupBy("id").agg(F.sum(F.col("weight") * F.col("x")).alias("part"))
    intercept = table.where("kind = 'intercept'").select(F.max("weight")).scalar()
    margin = F.coalesce("part", F.lit(0.0)) + intercept
    p1 = 1 / (1 + F.exp(-F.col("margin")))
    return (docs.select(F.col(id_col).alias("id"), label).join(sums, "id", "left").select(F.col("id").alias(id_col), label, margin.alias("margin"))
            .withColumn("p1", p1).withColumn(ev.PREDICTION_COL, ev.threshold_prediction(F.array(1 - F.col("p1"), F.col("p1")), model.thresholds)))


def residuals(docs: DataFrame, model: LinearModel, id_col: str = "doc_id", label: str = ev.LABEL_COL) -> DataFrame:
    """kind, name, position, weight, n_rows, x_sum, x_std, residual: one row per coefficient.

    The training problem is the mean logistic loss plus ``reg_param`` / 2 times
    the squared weights of the standardised features (value by sample standard
    deviation).  ``residual`` is the absolute gradient by a standardised weight
    -- zero at the optimum, and 0 for a feature that is constant, whose weight
    is 0.  ``n_rows`` counts rows where the feature is not zero.
    """
    error = scored(docs, model, id_col, label).select(F.col(id_col).alias("id"), (F.col("p1") - F.col(label)).alias("error"))
    per_row = features(docs, model, id_col).groupBy("id", "position").agg(F.sum("x").alias("x"))
    sums = per_row.join(error, "id").groupBy("position").agg(
        F.count("*").alias("n_rows"), F.sum("x").alias("x_sum"), F.sum(F.col("x") * F.col("x")).alias("x_square"),
        F.sum(F.col("error") * F.col("x")).alias("slope"))
    whole = error.select(F.lit(-1).alias("position"), F.lit(1.0).alias("x"), "error").groupBy("position").agg(
        F.count("*").alias("n_rows"), F.sum("x").alias("x_sum"), F.sum("x").alias("x_square"), F.sum("error").alias("slope"))
    n = docs.select(F.count("*").cast("double")).scalar()
    names = model.table.where("position is not null").groupBy("position").agg(
        F.max("kind").alias("kind"), F.max("weight").alias("weight"),
        F.max(F.when(F.col("kind") == "term", F.col("value")).otherwise(F.col("column"))).alias("name"))
    spread = F.sqrt(F.greatest((F.col("x_square") - F.col("x_sum") * F.col("x_sum") / n) / (n - 1), F.lit(0.0)))
    scaled = F.abs(F.col("slope") / n / F.col("x_std") + model.reg_param * F.col("weight") * F.col("x_std"))
    return (names.join(sums.unionByName(whole), "position", "left").fillna(0.0, ["x_sum", "x_square", "slope"]).fillna(0, ["n_rows"])
            .withColumn("x_std", spread)
            .select("kind", "name", "position", "weight", "n_rows", "x_sum", "x_std",
                    F.when(F.col("kind") == "intercept", F.abs(F.col("slope") / n))
                    .when(F.col("x_std") > 0, scaled).otherwise(F.lit(0.0)).alias("residual")))
