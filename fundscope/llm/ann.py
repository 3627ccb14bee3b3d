"""Approximate nearest neighbours by inner product, on shifted space-filling curves.

Vectors are projected to four random orthogonal directions, shifted, and
ordered along a Hilbert curve; ``CURVES`` such orderings differ in projection
and shift.  Each ordering is range-partitioned and ranked in Spark, and cut
into blocks of ``BLOCK`` rows by rank, so blocks are equally large whatever
the data.  A query looks at its own block and ``reach`` blocks on either side
of every ordering; what the blocks find is merged, reranked by the exact inner
product, and cut to the k nearest.

The reach is measured, not assumed: ``calibrate`` compares a bounded sample of
queries with brute force over all vectors and takes the smallest reach that
finds ``RECALL`` of their true neighbours.  Data without structure need a
reach in proportion to their size, clustered data a few blocks.

Equal vectors are one point of the curves, with the k + 1 smallest ids of
their group (all that any query can need), so a vector in a third of all rows
takes one place.  Scores are sums over the components in their order, in
double precision, and so do not depend on how rows are dealt out.

Vectors of different lengths have no inner product: each length has curves,
blocks and a reach of its own, and is searched among its own kind.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fundscope.llm.storage import stored

CURVES = 10
DIMENSIONS, BITS = 4, 15
BLOCK = 2048
BUNDLE = 16                # blocks whose queries look at a block in one group
RECALL = 0.95
SAMPLE = 64                # queries that the reach is measured on
SEED = 3


def hilbert(cells: np.ndarray, bits: int) -> np.ndarray:
    """Place along the Hilbert curve of each row of cells (n, m): m numbers of ``bits`` bits."""
    x = [cells[:, i].astype(np.int64) for i in range(cells.shape[1])]
    q = 1 << (bits - 1)
    while q > 1:                                   # undo the rotations, from the coarsest square on
        low = q - 1
        for i in range(len(x)):
            turn = (x[i] & q) != 0
            swap = np.where(turn, 0, (x[0] ^ x[i]) & low)
            x[0] = np.where(turn, x[0] ^ low, x[0]) ^ swap
            x[i] = x[i] ^ swap
        q >>= 1
    for i in range(1, len(x)):                     # Gray code
        x[i] = x[i] ^ x[i - 1]
    flip = np.zeros_like(x[0])
    q = 1 << (bits - 1)
    while q > 1:
        flip ^= np.where((x[-1] & q) != 0, q - 1, 0)
        q >>= 1
    key = np.zeros_like(x[0])
    for bit in range(bits - 1, -1, -1):
        for part in x:
            key = key << 1 | ((part ^ flip) >> bit & 1)
    return key


def curve_keys(vectors: np.ndarray, radius: float, curve: int) -> np.ndarray:
    """Keys of one ordering; ``radius`` is the largest length of a vector."""
    rng = np.random.default_rng([SEED, curve])
    m = min(DIMENSIONS, vectors.shape[1])
    axes = np.linalg.qr(rng.normal(size=(vectors.shape[1], m)))[0]
    shift = rng.uniform(0, 0.5, m)
    place = (vectors @ axes / radius + 1) / 4 + shift
    return hilbert(np.clip(place * (1 << BITS), 0, (1 << BITS) - 1).astype(np.int64), BITS)


def exact_scores(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of the rows, added up in the order of the components."""
    total = np.zeros(len(a))
    for k in range(a.shape[1]):
        total += a[:, k] * b[:, k]
    return total


def _vectors(column) -> np.ndarray:
    return np.frombuffer(b"".join(column), np.float64).reshape(len(column), -1)


def _by_size(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(number of components, rows, vectors) of each length of the vectors in ``column``."""
    packed = column.to_pylist()
    sizes = np.array([len(x) // 8 for x in packed], np.int64)
    for size in np.unique(sizes).tolist():
        at = np.flatnonzero(sizes == size)
        yield size, at, _vectors([packed[k] for k in at])


def _nearest(queries: np.ndarray, q_ids: np.ndarray, points: np.ndarray, p_ids: np.ndarray, k: int) -> tuple[np.ndarray, ...]:
    """(query id, point id, score) of the k nearest points of each query, ties to the smaller id."""
    out = []
    for at in range(0, len(queries), 1024):
        part = queries[at: at + 1024]
        rough = part @ points.T
        if rough.shape[1] > k:
            edge = np.partition(rough, rough.shape[1] - k, axis=1)[:, -k]
            row, col = np.nonzero(rough >= (edge - 1e-9 * (1 + np.abs(edge)))[:, None])
        else:
            row, col = (x.ravel() for x in np.indices(rough.shape))
        score = exact_scores(part[row], points[col])
        order = np.lexsort((p_ids[col], -score, row))
        row, col, score = row[order], col[order], score[order]
        first = np.searchsorted(row, np.arange(len(part)))
        keep = np.arange(len(row)) - first[row] < k
        out.append((q_ids[at + row[keep]], p_ids[col[keep]], score[keep]))
    return tuple(np.concatenate(x) for x in zip(*out))


def _size() -> Column:
    """Number of components of the packed vectors in column ``vec``."""
    return (F.octet_length("vec") / 8).cast("int")


def usable(df: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """id and vec (its doubles as bytes) of the rows that take part.

    Null ids and vectors, and vectors that are all zero or hold null or
    non-finite components take no part.  Of rows with equal id and vector one does.
    """
    v = F.col(vector_col)
    fit = v.isNotNull() & F.col(id_col).isNotNull() & F.forall(
        v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))) & F.exists(v, lambda x: x != 0)
    kept = df.where(F.coalesce(fit, F.lit(False))).select(F.col(id_col).cast("long").alias("id"),
                                                          v.cast("array<double>").alias("v"))

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.column(1)
            bounds = np.asarray(rows.offsets)
            flat = np.asarray(rows.values) + 0.0                       # -0.0 becomes 0.0
            vec = [flat[a:b].tobytes() for a, b in zip(bounds[:-1], bounds[1:])]
            yield pa.record_batch([batch.column(0), pa.array(vec, pa.binary())], names=["id", "vec"])

    return kept.mapInArrow(packed, "id long, vec binary").distinct()


def nearest(df: DataFrame, k: int, queries: Column, *, id_col: str = "vec_id", vector_col: str = "embedding",
            reach: int | None = None, block: int = BLOCK, curves: int = CURVES, recall: float = RECALL) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: the k nearest found of each query row, best first.

    ``queries`` is a condition on column ``id``; candidates are all rows with
    another id and a vector as long.  Ties go to the smaller id.  ``reach``
    (blocks) is calibrated to ``recall`` for each length if not given.  Fewer candidates than k give them all.
    """
    rows = stored(usable(df, id_col, vector_col), "vectors")
    small = Window.partitionBy("vec").orderBy("id")
    groups = (rows.withColumn("k", F.row_number().over(small)).where(F.col("k") <= k + 1)
              .groupBy("vec").agg(F.sort_array(F.collect_list("id")).alias("ids")))       # at most k + 1 each
    asked = rows.where(queries).select("vec", F.col("id").alias("query_id"))
    points = stored(groups.join(asked.select("vec", F.lit(True).alias("asked")).distinct(), "vec", "left")
                    .select(F.element_at("ids", 1).alias("point"), "vec", "ids", F.coalesce("asked", F.lit(False)).alias("asked")), "points")
    placed = _placed(points, curves, block)
    if reach is None:
        reaches = calibrate(points, placed, k, recall)
        far = F.lit(0)
        for size, blocks in reaches.items():
            far = F.when(F.col("size") == size, blocks).otherwise(far)
        reach = max(reaches.values(), default=0)
    else:
        far = F.lit(reach)
    rows = placed.select("size", "curve", "block", F.lit(0).alias("bundle"), "point", "vec", F.lit(None).cast("double").alias("floor"), F.lit(False).alias("query"))
    own = placed.where("asked")
    found = _searched(rows, own.withColumn("floor", F.lit(float("-inf"))).withColumn("bundle", F.lit(0)), k)
    if reach:
        # what the own blocks found sets a floor: other blocks return only what is at least as near
        found = stored(found, "own_blocks")
        kth = Window.partitionBy("size", "asker").orderBy(F.desc("score"), "point")
        floors = (found.withColumn("k", F.row_number().over(kth)).where(F.col("k") == k + 1)
                  .select("size", F.col("asker").alias("point"), F.col("score").alias("floor")))
        away = F.filter(F.sequence(-far, far), lambda d: d != 0)
        looks = (own.join(floors, ["size", "point"], "left").fillna({"floor": float("-inf")})
                 .withColumn("step", F.explode(away)).withColumn("block", F.col("block") + F.col("step"))
                 .withColumn("bundle", F.expr(f"cast(floor(step / {BUNDLE}) as int)")))
        bundles = F.sequence(F.floor(-far / BUNDLE).cast("int"), F.floor(far / BUNDLE).cast("int"))
        rows = rows.withColumn("bundle", F.explode(bundles))       # a group has at most BUNDLE blocks of queries
        found = found.unionByName(_searched(rows, looks, k)).groupBy("size", "asker", "point").agg(F.max("score").alias("score"))
    best = Window.partitionBy("size", "asker").orderBy(F.desc("score"), "point")
    found = found.withColumn("k", F.row_number().over(best)).where(F.col("k") <= k + 1).drop("k")
    size = _size().alias("size")
    members = (found.join(points.select(size, "point", "ids"), ["size", "point"])
               .select("size", "asker", "score", F.explode("ids").alias("vec_id")))
    owner = (asked.join(points.where("asked").select("vec", F.col("point").alias("asker")), "vec")
             .select(size, "asker", "query_id"))
    last = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (owner.join(members, ["size", "asker"]).where("vec_id <> query_id").withColumn("rank", F.row_number().over(last))
            .where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score"))


def _searched(rows: DataFrame, looks: DataFrame, k: int) -> DataFrame:
    """size, asker, point, score: the k + 1 nearest rows of each block that a query looks at, from its floor up."""

    def search(group: pd.DataFrame) -> pd.DataFrame:
        q, p = group[group["query"]], group[~group["query"]]
        if not len(q) or not len(p):
            return pd.DataFrame({"size": np.zeros(0, np.int32), "asker": np.zeros(0, np.int64), "point": np.zeros(0, np.int64), "score": np.zeros(0)})
        ids = q["point"].to_numpy()
        asker, point, score = _nearest(_vectors(q["vec"]), ids, _vectors(p["vec"]), p["point"].to_numpy(), k + 1)
        order = np.argsort(ids)
        keep = score >= q["floor"].to_numpy()[order[np.searchsorted(ids[order], asker)]]
        return pd.DataFrame({"size": np.full(int(keep.sum()), group["size"].iloc[0], np.int32), "asker": asker[keep], "point": point[keep], "score": score[keep]})

    both = rows.unionByName(looks.select("size", "curve", "block", "bundle", "point", "vec", "floor", F.lit(True).alias("query")))
    return (both.groupBy("size", "curve", "block", "bundle").applyInPandas(search, "size int, asker long, point long, score double")
            .groupBy("size", "asker", "point").agg(F.max("score").alias("score")))


def _placed(points: DataFrame, curves: int, block: int) -> DataFrame:
    """Every point once per curve, with its block: size, curve, block, point, vec, asked."""

    def longest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for size, _, vectors in _by_size(batch.column(0)):
                yield pa.record_batch([pa.array([size], pa.int32()), pa.array([float(np.sqrt((vectors ** 2).sum(axis=1)).max())])],
                                      names=["size", "r"])

    radius = {r.size: r.r or 1.0 for r in points.select("vec").mapInArrow(longest, "size int, r double")
              .groupBy("size").agg(F.max("r").alias("r")).collect()}       # a row per length

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for size, at, vectors in _by_size(batch.column(1)):
                part = batch.take(pa.array(at))
                for c in range(curves):
                    yield pa.record_batch([pa.array(np.full(len(at), size, np.int32)), pa.array(np.full(len(at), c, np.int32)),
                                           pa.array(curve_keys(vectors, radius[size], c)), *part.columns],
                                          names=["size", "curve", "key", "point", "vec", "asked"])

    def numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = Counter()
        part = TaskContext.get().partitionId()
        for batch in batches:
            if not batch.num_rows:
                continue
            order = np.stack([np.asarray(batch.column(0)), np.asarray(batch.column(1))], axis=1)
            edges = np.flatnonzero((order[1:] != order[:-1]).any(axis=1)) + 1          # rows are sorted by size and curve
            place = np.zeros(len(order), np.int64)
            for a, b in zip([0, *edges.tolist()], [*edges.tolist(), len(order)]):
                run = tuple(order[a].tolist())
                place[a:b] = seen[run] + np.arange(b - a)
                seen[run] += b - a
            yield pa.record_batch([*batch.columns[:2], pa.array(np.full(len(order), part, np.int32)), pa.array(place),
                                   *batch.columns[3:]], names=["size", "curve", "part", "place", "point", "vec", "asked"])

    rows = (points.select("point", "vec", "asked").mapInArrow(keyed, "size int, curve int, key long, point long, vec binary, asked boolean")
            .repartitionByRange("size", "curve", "key", "point").sortWithinPartitions("size", "curve", "key", "point")
            .mapInArrow(numbered, "size int, curve int, part int, place long, point long, vec binary, asked boolean"))
    rows = stored(rows, "curves")
    before = Window.partitionBy("size", "curve").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (rows.groupBy("size", "curve", "part").agg(F.count("*").alias("n"))       # a row per length, curve and partition
               .select("size", "curve", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset")))
    return rows.join(offsets, ["size", "curve", "part"]).select(
        "size", "curve", F.expr(f"cast((offset + place) div {block} as int)").alias("block"), "point", "vec", "asked")


def sample_truth(points: DataFrame, k: int) -> tuple[DataFrame, int]:
    """(size, asker, point): the exact k nearest points of at most SAMPLE query points of each length, and the number of those."""
    drawn = Window.partitionBy("size").orderBy(F.xxhash64("point"), "point")
    some = (points.where("asked").select(_size().alias("size"), "point", "vec").withColumn("k", F.row_number().over(drawn))
            .where(F.col("k") <= SAMPLE).collect())
    if not some:
        return points.sparkSession.createDataFrame([], T.StructType().add("size", "integer").add("asker", "long").add("point", "long")), 0
    asked = {size: (np.array([r.point for r in some if r.size == size]), _vectors([bytes(r.vec) for r in some if r.size == size]))
             for size in {r.size for r in some}}

    def brute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for size, at, vectors in _by_size(batch.column(1)):
                if size in asked:
                    ids, queries = asked[size]
                    found = _nearest(queries, ids, vectors, np.asarray(batch.column(0))[at], k + 1)
                    yield pa.record_batch([pa.array(np.full(len(found[0]), size, np.int32)), *(pa.array(x) for x in found)],
                                          names=["size", "asker", "point", "score"])

    best = Window.partitionBy("size", "asker").orderBy(F.desc("score"), "point")
    found = points.select("point", "vec").mapInArrow(brute, "size int, asker long, point long, score double").where("asker <> point")
    return found.withColumn("k", F.row_number().over(best)).where(F.col("k") <= k).select("size", "asker", "point"), len(some)


def calibrate(points: DataFrame, placed: DataFrame, k: int, recall: float) -> dict[int, int]:
    """For each vector length, the smallest reach (blocks) that finds ``recall`` of the true neighbours of its sampled queries."""
    truth, n = sample_truth(points, k)
    if not n:
        return {}
    truth = truth.checkpoint()
    at = placed.select("size", "curve", "block", "point")
    gap = (truth.join(at.withColumnRenamed("point", "asker").withColumnRenamed("block", "from"), ["size", "asker"])
           .join(at, ["size", "point", "curve"]).groupBy("size", "asker", "point")
           .agg(F.min(F.abs(F.col("block") - F.col("from"))).alias("gap")))
    gaps = defaultdict(list)
    for r in gap.collect():                                         # at most SAMPLE * k numbers a length
        gaps[r.size].append(r.gap)
    return {size: int(sorted(g)[max(0, int(np.ceil(recall * len(g))) - 1)]) for size, g in gaps.items()}


def measured_recall(df: DataFrame, found: DataFrame, k: int, queries: Column, *, id_col: str = "vec_id",
                    vector_col: str = "embedding") -> float:
    """Share of the exact k nearest (by brute force, a bounded sample of queries) that ``found`` holds."""
    rows = usable(df, id_col, vector_col)
    points = rows.select(F.col("id").alias("point"), "vec", queries.alias("asked"))
    truth, n = sample_truth(points, k)
    if not n:
        return 1.0
    hit = truth.join(found, (truth["asker"] == found["query_id"]) & (truth["point"] == found["vec_id"]), "left")
    return float(hit.agg(F.avg(F.col("vec_id").isNotNull().cast("int"))).first()[0])
