"""Adapters from the test tables to the library's role schemas.

The test data is a TPC-H-like star plus text tables; these views give them
the shapes the operators expect. They are plain ``select`` / ``where`` over
parquet scans, so Catalyst prunes columns and pushes filters through them.

| role | table | mapping |
|---|---|---|
| questions | orders | id=o_orderkey, creationdate=o_orderdate, owneruserid=o_custkey, acceptedanswerid set when o_orderstatus='F', title=o_orderpriority |
| answers | lineitem | parentid=l_orderkey, creationdate=l_shipdate |
| asks | events | purchase events: id=event_id, owneruserid=user_id, creationdate=ts |
| badges | events | the other event types: id=event_id, userid=user_id, date=ts, name=event_type |
| tags | part | '<' p_brand '><' p_type '>' |
| text + label | documents, labels | doc_id, text, quality |
| HTML bodies | pages | page_id, html |
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# answer columns that make one answer row unique enough to break ties
ANSWER_TIE_COLS = (
    "l_linenumber",
    "l_partkey",
    "l_suppkey",
    "l_quantity",
    "l_extendedprice",
    "l_discount",
    "l_tax",
    "l_returnflag",
    "l_linestatus",
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def questions(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    return o.select(
        F.col("o_orderkey").alias("id"),
        F.lit(1).alias("posttypeid"),
        F.col("o_orderdate").alias("creationdate"),
        F.col("o_custkey").alias("owneruserid"),
        F.when(F.col("o_orderstatus") == "F", F.col("o_orderkey")).alias("acceptedanswerid"),
        F.col("o_orderpriority").alias("title"),
    )


def answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    return li.select(
        F.col("l_orderkey").alias("parentid"),
        F.lit(2).alias("posttypeid"),
        F.col("l_shipdate").alias("creationdate"),
        *ANSWER_TIE_COLS,
    )


def posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Questions and answers as one posts table (``posts_scan``, ``type_counts``).

    An answer's id is not unique in the proxy (line numbers repeat), so it
    is ``l_orderkey * 100 + l_linenumber`` only to fill the column.
    """
    q = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("id"),
        F.when(F.col("o_orderstatus") == "F", F.col("o_orderkey")).alias("acceptedanswerid"),
        F.lit(None).cast("bigint").alias("parentid"),
        F.col("o_orderdate").alias("creationdate"),
        F.lit(None).cast("string").alias("body"),
        F.lit(None).cast("string").alias("tags"),
        F.col("o_orderpriority").alias("title"),
        F.lit(1).alias("posttypeid"),
    )
    a = table(spark, sf_dir, "lineitem").select(
        (F.col("l_orderkey") * 100 + F.col("l_linenumber")).alias("id"),
        F.lit(None).cast("bigint").alias("acceptedanswerid"),
        F.col("l_orderkey").alias("parentid"),
        F.col("l_shipdate").alias("creationdate"),
        F.lit(None).cast("string").alias("body"),
        F.lit(None).cast("string").alias("tags"),
        F.lit(None).cast("string").alias("title"),
        F.lit(2).alias("posttypeid"),
    )
    return q.unionByName(a)


def asks(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    return e.where(F.col("event_type") == "purchase").select(
        F.col("event_id").alias("id"),
        F.col("user_id").alias("owneruserid"),
        F.col("ts").alias("creationdate"),
    )


def badges(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    return e.where(F.col("event_type") != "purchase").select(
        F.col("event_id").alias("id"),
        F.col("user_id").alias("userid"),
        F.col("ts").alias("date"),
        F.col("event_type").alias("name"),
    )


def part_tags(spark: SparkSession, sf_dir: str, *keep: str) -> DataFrame:
    p = table(spark, sf_dir, "part")
    return p.select(
        "p_partkey",
        *keep,
        F.concat(F.lit("<"), F.col("p_brand"), F.lit("><"), F.col("p_type"), F.lit(">")).alias(
            "tags"
        ),
    )


def labelled_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents").select("doc_id", "text", "n_chars")
    lab = table(spark, sf_dir, "labels").select("doc_id", "quality")
    return d.join(lab, "doc_id", "inner")
