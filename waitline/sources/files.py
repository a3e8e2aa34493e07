"""Table scans, ad-hoc SQL and file formats.

Every reader takes an explicit schema: no inference pass over the data, and
the same types on every run.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

POSTS_SCAN_COLUMNS = (
    "id",
    "acceptedanswerid",
    "parentid",
    "creationdate",
    "body",
    "tags",
    "title",
    "posttypeid",
)


def scan_posts(
    posts: DataFrame,
    since,
    types: Sequence[int] = (1, 2),
    columns: Sequence[str] = POSTS_SCAN_COLUMNS,
    type_col: str = "posttypeid",
    date_col: str = "creationdate",
) -> DataFrame:
    """Questions and answers created strictly after ``since``.

    Both predicates reach the parquet scan as pushed filters; only the
    listed columns are read.
    """
    cond = F.col(type_col).isin(*types) & (
        F.col(date_col) > F.lit(since).cast("timestamp_ntz")
    )
    return posts.where(cond).select(*columns)


def adhoc_sql(spark: SparkSession, views: Mapping[str, DataFrame], sql: str) -> DataFrame:
    """Run SQL over named frames (A6). Write ``ORDER BY`` before ``LIMIT``:
    without it the rows a limit keeps depend on partitioning."""
    for name, df in views.items():
        df.createOrReplaceTempView(name)
    return spark.sql(sql)


def read_csv(spark: SparkSession, path: str, schema: StructType, timestamp_format=None) -> DataFrame:
    """CSV with a header, quoted multi-line fields and typed columns."""
    r = (
        spark.read.schema(schema)
        .option("header", True)
        .option("multiLine", True)
        .option("escape", '"')
        .option("mode", "PERMISSIVE")
    )
    if timestamp_format:
        r = r.option("timestampNTZFormat", timestamp_format)
    return r.csv(path)


def read_json(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """JSON lines with a fixed schema."""
    return spark.read.schema(schema).json(path)


def write_json(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """JSON lines with ISO timestamps."""
    (
        df.write.mode(mode)
        .option("timestampNTZFormat", "yyyy-MM-dd'T'HH:mm:ss.SSS")
        .json(path)
    )


def append_table(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Create-if-absent and append (A3): parquet appends add files, never
    rewrite existing ones."""
    w = df.write.mode("append")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def write_stage(df: DataFrame, path: str, starting_date: str, key: str = "starting_date") -> None:
    """Stage output keyed by snapshot date.

    Written as parquet into that date's partition folder, which is replaced
    whole: re-running a date that now has no rows leaves none, other dates
    stay, and a reader filtering on the date prunes them.
    """
    df.drop(key).write.mode("overwrite").parquet(f"{path.rstrip('/')}/{key}={starting_date}")


def read_stage(
    spark: SparkSession, path: str, starting_date: str, key: str = "starting_date",
    schema: StructType | None = None,
):
    """One snapshot of a stage; the date filter prunes partitions. Pass the
    stage's ``schema`` to read a stage that may hold no rows (no files)."""
    r = spark.read
    if schema is not None:
        from pyspark.sql.types import StringType, StructField

        r = r.schema(StructType([*schema.fields, StructField(key, StringType(), True)]))
    return r.parquet(path).where(F.col(key) == starting_date).drop(key)


def read_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    properties: Mapping[str, str],
    partition_column: str | None = None,
    lower: int | None = None,
    upper: int | None = None,
    num_partitions: int = 64,
) -> DataFrame:
    """A table from a SQL database (the reference's Postgres extract, A5).

    With ``partition_column`` and bounds, Spark opens ``num_partitions``
    parallel range queries instead of one connection; filters and column
    lists applied to the result are pushed into the database query.
    Credentials come from ``properties`` (never from code).
    """
    r = spark.read.format("jdbc").option("url", url).option("dbtable", table)
    for k, v in properties.items():
        r = r.option(k, v)
    if partition_column is not None:
        r = (
            r.option("partitionColumn", partition_column)
            .option("lowerBound", str(lower))
            .option("upperBound", str(upper))
            .option("numPartitions", str(num_partitions))
        )
    return r.load()
