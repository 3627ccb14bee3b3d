"""Mixing sources to target weights: hierarchical token budgets over a tree of sources.

The columns ``levels`` (say domain, language, source) form a tree.  A node's
capacity is the tokens below it, ``max_epochs`` times over.  Budgets flow from
the root down: a node's budget is split among its children by weight, but no
child gets more than its capacity; what a full child leaves goes to its
siblings, again by weight, until all siblings are full.  Only then is it the
ancestors' to give away: a node's own capacity already counts all that its
subtree can take, so the shortage is shared among the node's siblings first,
and so on up.  Shares are rounded down to whole tokens.

A leaf's budget is filled with whole epochs and a prefix of one more.  Each
epoch has its own seeded order of the leaf's documents, by the md5 of (seed,
epoch, id); the prefix ends inside the document that reaches the budget, of
which only the first tokens are taken.

All of it is joins, aggregations and windows on tables of leaves.  The cut of
a leaf is found in two steps: token sums over 4,096 slices of the hash range
name the slice with the cut, and only that slice's documents are sorted.  The
documents then need one join with the leaves, on the tree's columns.

A token is a maximal run of bytes other than ASCII white space.
"""

from __future__ import annotations

from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SEED = 20
MAX_EPOCHS = 3
SLICE_DIGITS = 3          # of the md5: 16**3 slices a leaf
WIDE = "decimal(38,0)"

TOKEN = r"[^\x20\x09-\x0D]+"


def n_tokens(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(TOKEN)), F.lit(0)).cast("long")


def first_tokens(text: Column, n: Column) -> Column:
    """The text up to the end of its n-th token."""
    pieces = F.regexp_extract_all(text, F.lit(r"[\x20\x09-\x0D]*" + TOKEN), F.lit(0))
    return F.array_join(F.slice(pieces, F.lit(1), n.cast("int")), "")


def _fill(children: DataFrame, parent: Sequence[str | Column], name: str, weight: str = "weight") -> DataFrame:
    """Budgets of the children (column ``name``) of each parent, from columns budget (the parent's), capacity and weight.

    In the order of capacity by weight, a child is full if the budget covers
    the children up to it and gives those after it the same share by weight.
    """
    by = Window.partitionBy(*parent)
    order = by.orderBy(F.col("capacity") / F.col(weight), name)
    upto = order.rowsBetween(Window.unboundedPreceding, 0)
    full = (F.col("capacity").cast("decimal(19,0)") * (F.col("all_w") - F.col("w_upto")).cast("decimal(18,0)")
            <= (F.col("budget") - F.col("c_upto")).cast("decimal(19,0)") * F.col(weight).cast("decimal(18,0)"))
    seen = (children.withColumn("c_upto", F.sum("capacity").over(upto)).withColumn("w_upto", F.sum(weight).over(upto))
            .withColumn("all_w", F.sum(weight).over(by)).withColumn("full", full))
    left = (F.col("budget") - F.coalesce(F.sum(F.when(F.col("full"), F.col("capacity"))).over(by), F.lit(0)))
    open_w = F.sum(F.when(~F.col("full"), F.col(weight))).over(by)
    return (seen.withColumn("left", left).withColumn("open_w", open_w)
            .withColumn("share", F.when(F.col("full"), F.col("capacity")).otherwise(
                F.floor(F.col("left").cast("decimal(19,0)") * F.col(weight).cast("decimal(18,0)") / F.col("open_w")).cast("long")))
            .drop("c_upto", "w_upto", "all_w", "full", "left", "open_w", "budget"))


def budgets(leaves: DataFrame, levels: Sequence[str], total: Column | int, weights: dict[tuple, int] | None = None,
            max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """``leaves`` (levels, tokens) with ``budget``.

    ``weights`` maps paths (tuples of the first levels' values) to whole
    positive weights; a path that is not listed has weight 1.
    """
    spark = leaves.sparkSession
    n = len(levels)
    for path, w in (weights or {}).items():
        if not 1 <= len(path) <= n or int(w) != w or w <= 0:
            raise ValueError(f"weight of {path}: paths have 1 to {n} parts, weights are whole and positive")
    nodes = leaves.withColumn("capacity", F.col("tokens") * max_epochs).where("capacity > 0")
    above = nodes.agg(F.sum("tokens").alias("all_tokens")).select(
        F.coalesce(F.floor(F.lit(total) if isinstance(total, int) else total), F.lit(0)).cast("long").alias("budget"))
    parent: list[str] = []
    result = None
    for depth in range(1, n + 1):
        path = list(levels[:depth])
        level = nodes.groupBy(*path).agg(F.sum("capacity").alias("capacity"))
        listed = [(*[None if x is None else str(x) for x in p], int(w)) for p, w in (weights or {}).items() if len(p) == depth]
        names = [f"node_{k}" for k in range(depth)]
        if listed:
            kinds = [pa.string()] * depth + [pa.int64()]
            # An Arrow table: a list would start workers of another kind on every executor.
            table = spark.createDataFrame(pa.table([pa.array(c, t) for c, t in zip(zip(*listed), kinds)], names=[*names, "weight"]))
            cond = [F.col(c).cast("string").eqNullSafe(F.col(k)) for c, k in zip(path, names)]
            on = cond[0]
            for c in cond[1:]:
                on = on & c
            level = level.join(table, on, "left").drop(*names)
        else:
            level = level.withColumn("weight", F.lit(None).cast("long"))
        level = level.withColumn("weight", F.coalesce("weight", F.lit(1).cast("long")))
        if parent:
            up = result.select(*[F.col(c).alias(f"up_{c}") for c in parent], F.col("share").alias("budget"))
            on = F.lit(True)
            for c in parent:
                on = on & F.col(c).eqNullSafe(F.col(f"up_{c}"))
            level = level.join(up, on).drop(*[f"up_{c}" for c in parent])
        else:
            level = level.withColumn("budget", above.scalar())
        result = _fill(level, parent or [F.lit(0)], path[-1])
        parent = path
    return result.select(*levels, F.col("share").alias("budget"))


def mix(docs: DataFrame, levels: Sequence[str], total: Column | int, *, weights: dict[tuple, int] | None = None,
        id_col: str = "doc_id", text_col: str = "text", max_epochs: int = MAX_EPOCHS, seed: int = SEED) -> DataFrame:
    """The selected documents: columns of ``docs``, then ``mix_epoch`` and ``mix_tokens``.

    ``total`` is the budget in tokens: a number, or an expression on
    ``all_tokens``.  A document is returned once for each epoch that takes it;
    ``mix_tokens`` (its first tokens, all but for the one at the cut) is what
    the epoch takes.  Null values of a level are a child of their own.
    Documents without tokens fill no budget and are left out.  Rows that repeat
    an id in a leaf share a place in the order; where that is the cut, each is
    cut alike.  A row without id takes the id ''.
    """
    levels = list(levels)
    key = lambda epoch: F.md5(F.concat_ws(":", F.lit(str(seed)), epoch.cast("string"), F.coalesce(F.col("mix_id"), F.lit(""))))
    narrow = docs.select(*levels, F.col(id_col).cast("string").alias("mix_id"), n_tokens(F.col(text_col)).alias("mix_n"))
    leaves = narrow.groupBy(*levels).agg(F.sum("mix_n").alias("tokens"))
    plan = leaves.alias("l").join(budgets(leaves, levels, total, weights, max_epochs).alias("b"),
                                  _same("l", "b", levels)).select(
        *[F.col(f"l.{c}").alias(c) for c in levels], F.expr("b.budget div l.tokens").alias("whole"),
        F.expr("b.budget % l.tokens").alias("rest")).checkpoint()
    # the cut of each leaf
    keyed = (_joined(narrow, plan.where("rest > 0"), levels)
             .withColumn("mix_key", key(F.col("whole"))).withColumn("slice", F.substring("mix_key", 1, SLICE_DIGITS))
             .where("mix_n > 0"))
    node = [f"leaf_{k}" for k in range(len(levels))]
    named = keyed.select(*[F.col(c).alias(k) for c, k in zip(levels, node)], "rest", "mix_key", "slice", "mix_id", "mix_n")
    slices = named.groupBy(*node, "rest", "slice").agg(F.sum("mix_n").alias("sum"))
    order = Window.partitionBy(*node).orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    hit = (slices.withColumn("before", F.coalesce(F.sum("sum").over(order), F.lit(0)))
           .where("before < rest and before + sum >= rest").drop("sum", "rest"))
    inside = (named.alias("n").join(hit.alias("h"), _same("n", "h", node) & (F.col("n.slice") == F.col("h.slice")))
              .select(*[F.col(f"n.{c}").alias(c) for c in node], "rest", "mix_key", "mix_id", "mix_n", "before"))
    order = Window.partitionBy(*node).orderBy("mix_key", "mix_id").rowsBetween(Window.unboundedPreceding, -1)
    cut = (inside.withColumn("before", F.col("before") + F.coalesce(F.sum("mix_n").over(order), F.lit(0)))
           .where("before < rest and before + mix_n >= rest")
           .groupBy(*node).agg(F.min(F.struct("mix_key", "mix_id", (F.col("rest") - F.col("before")).alias("take"))).alias("cut")))
    full = (plan.alias("p").join(cut.alias("c"), _same("p", "c", levels, node), "left")
            .select(*[F.col(f"p.{c}").alias(c) for c in levels], F.col("whole").alias("mix_whole"), F.col("cut").alias("mix_cut")).checkpoint())
    # one pass over the documents
    row = docs.withColumn("mix_id", F.col(id_col).cast("string")).withColumn("mix_n", n_tokens(F.col(text_col))).where("mix_n > 0")
    chosen = _joined(row, full, levels).withColumn("mix_key", key(F.col("mix_whole")))
    last = F.when(F.col("mix_key") < F.col("mix_cut.mix_key"), F.col("mix_n")).when(
        F.col("mix_key") == F.col("mix_cut.mix_key"), F.least("mix_n", "mix_cut.take"))
    taken = F.transform(F.sequence(F.lit(0).cast("long"), F.col("mix_whole")), lambda e: F.struct(
        e.cast("int").alias("epoch"), F.when(e < F.col("mix_whole"), F.col("mix_n")).otherwise(last).alias("n")))
    return (chosen.withColumn("mix_taken", F.explode(F.filter(taken, lambda x: x["n"] > 0)))
            .select(*docs.columns, F.col("mix_taken.epoch").alias("mix_epoch"), F.col("mix_taken.n").alias("mix_tokens")))


def _same(a: str, b: str, left: Sequence[str], right: Sequence[str] | None = None) -> Column:
    on = F.lit(True)
    for x, y in zip(left, right or left):
        on = on & F.col(f"{a}.`{x}`").eqNullSafe(F.col(f"{b}.`{y}`"))
    return on


def _joined(rows: DataFrame, leaves: DataFrame, levels: Sequence[str]) -> DataFrame:
    """Rows with the columns of their leaf; a large leaf is split by adaptive execution's skew join."""
    names = [f"mix_leaf_{k}" for k in range(len(levels))]
    other = leaves.select(*[F.col(c).alias(k) for c, k in zip(levels, names)], *[c for c in leaves.columns if c not in levels])
    on = F.lit(True)
    for c, k in zip(levels, names):
        on = on & rows[c].eqNullSafe(F.col(k))
    return rows.join(other, on).drop(*names)


def trim_to_taken(mixed: DataFrame, text_col: str = "text", chars_col: str | None = None) -> DataFrame:
    """Texts cut to the tokens that were taken; ``chars_col`` (if given) is counted anew for cut texts."""
    cut = F.col("mix_tokens") < n_tokens(F.col(text_col))
    out = mixed.withColumn("mix_cut", cut).withColumn(
        text_col, F.when(F.col("mix_cut"), first_tokens(F.col(text_col), F.col("mix_tokens"))).otherwise(F.col(text_col)))
    if chars_col:
        out = out.withColumn(chars_col, F.when(F.col("mix_cut"), F.length(text_col)).otherwise(F.col(chars_col)).cast(mixed.schema[chars_col].dataType))
    return out.drop("mix_cut")
