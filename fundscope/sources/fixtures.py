"""Fixture views that give the driver tables the shapes the jobs expect.

The jobs were written for a crowdfunding CSV that ships with nothing, so the
inputs are derived from the TPC-H-like driver tables (``FIXTURES.md`` part C):

* ``campaigns``      raw campaign table, the types a CSV scan with inference gives
* ``labelled_docs``  a prepared training set from ``documents`` joined to ``labels``
* ``quoted_lines``   lines holding runs of double quotes, from ``part``
* ``document_lines`` the lines of ``documents.text``
* ``dedup_rows``     three low-cardinality ``lineitem`` columns

Joins are left to the planner: the dimension sides (``nation`` is 25 rows,
``customer`` and ``part`` grow with the scale factor) are broadcast only when
their size statistics are under ``spark.sql.autoBroadcastJoinThreshold`` or
when adaptive execution measures them small at run time; otherwise they are
sort-merge joins on their keys.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fundscope.functions.columns import ntz_to_epoch, split_lines
from fundscope.sources.readers import read_table

# Fixed values of the fixture derivation (FIXTURES.md, part C).
MISSING_BRAND = "Brand#2"          # this brand becomes a null keyword
MISSING_STATUS = "P"               # this order status becomes a null country
BAD_GOAL_LINE = 6                  # line 6 with return flag 'A' gets goal 'n/a'
BAD_GOAL_FLAG = "A"
BAD_GOAL_TEXT = "n/a"
NO_CREATED_LINE = 7                # line 7 has no created_at
DIRTY_EVERY = 97                   # of 97 order keys three give a malformed line
STATE_CHANGE_DELAY = 18            # state_changed_at = deadline + 18 s


def _cents(col: str):
    return F.col(col).cast("decimal(15,2)")


def _money(amount):
    """Exact decimal product rounded half-up to cents, printed with two
    decimals (double rounding differs between engines on half cents)."""
    return F.round(amount, 2).cast("decimal(18,2)").cast("string")


def campaigns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw campaigns (14 columns), typed as the CSV scan infers them."""
    li = read_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_linenumber", "l_quantity", "l_extendedprice",
        "l_discount", "l_returnflag", "l_shipdate")
    orders = read_table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate")
    customer = read_table(spark, sf_dir, "customer").select(
        "c_custkey", "c_nationkey", "c_mktsegment")
    nation = read_table(spark, sf_dir, "nation").select("n_nationkey")
    part = read_table(spark, sf_dir, "part").select(
        "p_partkey", "p_name", "p_type", "p_brand")

    j = (li.join(orders, li.l_orderkey == orders.o_orderkey)
           .join(customer, F.col("o_custkey") == F.col("c_custkey"))
           .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
           .join(part, F.col("l_partkey") == F.col("p_partkey")))

    line = F.col("l_linenumber")
    flag = F.col("l_returnflag")
    status = F.col("o_orderstatus")
    ship = ntz_to_epoch("l_shipdate")
    ordered = ntz_to_epoch("o_orderdate")
    return j.select(
        F.concat(F.col("l_orderkey").cast("string"), F.lit("-"),
                 line.cast("string")).alias("project_id"),
        F.col("p_name").alias("name"),
        F.col("p_type").alias("desc"),
        F.nullif(F.col("p_brand"), F.lit(MISSING_BRAND)).alias("keywords"),
        F.when((line == BAD_GOAL_LINE) & (flag == BAD_GOAL_FLAG), F.lit(BAD_GOAL_TEXT))
         .otherwise(_money(_cents("l_extendedprice") * _cents("l_discount"))).alias("goal"),
        F.when(status == "O", F.lit(True)).alias("disable_communication"),
        F.nullif(status, F.lit(MISSING_STATUS)).alias("country"),
        F.when(status == MISSING_STATUS,
               F.concat(F.lit("N"), F.col("n_nationkey").cast("string")))
         .otherwise(F.substring("c_mktsegment", 1, 3)).alias("currency"),
        ship.cast("int").alias("deadline"),
        (ship + STATE_CHANGE_DELAY).cast("int").alias("state_changed_at"),
        F.when(line != NO_CREATED_LINE,
               ordered - 3600 * (F.col("l_quantity").cast("int") - 5))
         .cast("int").alias("created_at"),
        ordered.cast("int").alias("launched_at"),
        line.alias("backers_count"),
        F.when(flag == "A", 0).when(flag == "N", 1).otherwise(2).alias("final_status"),
    )


def dirty_campaign_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Campaigns as CSV lines without a header; some have a word for a number, too few or too many fields."""
    rows = campaigns(spark, sf_dir)
    fields = {c: F.coalesce(F.col(c).cast("string"), F.lit("false")) for c in rows.columns}
    line = F.concat_ws(",", *fields.values())
    kind = F.substring_index("project_id", "-", 1).cast("bigint") % DIRTY_EVERY
    return rows.select(
        F.when(kind == 1, F.concat_ws(",", *[F.lit("soon") if c == "deadline" else f for c, f in fields.items()]))
        .when(kind == 2, F.substring_index(line, ",", 5))
        .when(kind == 3, F.concat_ws(",", line, F.lit("1"), F.lit("2"))).otherwise(line).alias("value"))


def labelled_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``documents`` joined to ``labels`` in the shape of the prepared set."""
    docs = read_table(spark, sf_dir, "documents").select(
        "doc_id", "text", "lang", "source", "n_chars")
    labels = read_table(spark, sf_dir, "labels").select("doc_id", "quality")
    j = docs.join(labels, "doc_id")
    return j.select(
        F.col("doc_id"),
        F.col("doc_id").cast("string").alias("project_id"),
        F.col("text"),
        F.col("lang").alias("country2"),
        F.col("source").alias("currency2"),
        F.col("n_chars").cast("int").alias("goal"),
        F.length(F.substring_index("text", "\n", 1)).alias("days_campaign"),
        (F.col("n_chars") / F.lit(3600.0)).alias("hours_prepa"),
        F.col("quality").alias("final_status"),
    )


def quoted_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One line per part holding a run of three quotes, one of two and a single one."""
    part = read_table(spark, sf_dir, "part")
    return part.select(
        F.col("p_partkey").alias("line_id"),
        F.concat(F.col("p_name"), F.lit('"""'), F.col("p_type"), F.lit('""'),
                 F.col("p_brand"), F.lit('"'), F.col("p_size").cast("string")).alias("value"))


def quoted_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``name`` and ``desc`` columns holding quote runs (for the per-column rule)."""
    part = read_table(spark, sf_dir, "part")
    return part.select(
        F.col("p_partkey").alias("line_id"),
        F.concat(F.col("p_name"), F.lit('""'), F.col("p_brand")).alias("name"),
        F.concat(F.col("p_type"), F.lit('"""'), F.col("p_size").cast("string"),
                 F.lit('"')).alias("desc"))


def document_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lines of every document, as a text scan of the documents would give."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return (docs.select("doc_id", F.explode_outer(split_lines("text")).alias("value"))
                .filter(F.col("value").isNotNull()))


def dedup_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    # no spread: the partial aggregation already shrinks each split to its
    # distinct rows, so a round-robin shuffle first would only add work
    return read_table(spark, sf_dir, "lineitem").select(
        "l_returnflag", "l_linestatus", "l_quantity")
