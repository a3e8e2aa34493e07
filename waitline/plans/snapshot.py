"""All stages of one snapshot, from the XML dump to the model tables.

The reference runs these as separate scripts and scheduler tasks, each
writing a file named after ``starting_date``:

| stage | reference | here |
|---|---|---|
| posts_extracted | extract script | ``scan_posts`` + ``extract_posts`` |
| content (1 day), content_week | ``readData`` / notebook | ``success_label`` |
| time | ``readTimeDf`` | ``response_time`` |
| earned_badges, earned_badges_any | badge scripts | ``prior_events`` inner / left |
| badge_success, badge_time | badge tables | ``outer_by_id`` |
| combined, combined_time | combined model inputs | ``outer_by_id`` + fill (+ bounds) |
| tag_itemsets | tag profiles | ``frequent_itemsets`` |

Here each stage is a DataFrame built from the previous ones and written as
parquet partitioned by ``starting_date`` (dynamic overwrite: re-running a
date replaces only that date). Nothing is collected to the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import split_whitespace
from ..functions.time import ONE_DAY_MINUTES, ONE_WEEK_MINUTES
from ..operators import history, itemsets, response, tables
from ..operators.extract import extract_posts
from ..sources.dump import read_dump
from ..sources.files import read_stage, scan_posts, write_stage

CONTENT_COLS = ("title", "paragraphs", "tags", "hascodes")


def extract(posts: DataFrame, starting_date: str) -> tuple[DataFrame, DataFrame]:
    """(posts_extracted, posts_quarantined) for posts after ``starting_date``."""
    scanned = scan_posts(
        posts, starting_date,
        columns=("id", "acceptedanswerid", "parentid", "creationdate", "body", "tags", "title",
                 "posttypeid", "owneruserid"),
    )
    return extract_posts(
        scanned, keep=("id", "posttypeid", "acceptedanswerid", "parentid", "creationdate", "owneruserid")
    )


def labels(extracted: DataFrame, badges: DataFrame, deadline: int = ONE_DAY_MINUTES) -> dict[str, DataFrame]:
    """Label and history stages from the extracted posts."""
    questions, answers = response.split_posts(extracted)
    first = response.first_answers(answers, ("id",))
    asks = questions.select("id", "owneruserid", "creationdate")
    return {
        "content": response.success_label(questions, answers, deadline, keep=CONTENT_COLS, first=first),
        "content_week": response.success_label(
            questions, answers, ONE_WEEK_MINUTES, keep=CONTENT_COLS, first=first
        ),
        "time": response.response_time(questions, answers, keep=CONTENT_COLS),
        "first_accepted": response.first_response_time(
            questions, answers, tie_cols=("id",), accepted="acceptedanswerid", keep=CONTENT_COLS,
            first=first,
        ).select(*CONTENT_COLS, "elapsed", "id"),
        "earned_badges": history.prior_events(asks, badges, how="inner").select("badges", "userid", "id"),
        "earned_badges_any": history.prior_events(asks, badges, how="left").select(
            "badges", "userid", "id"
        ),
    }


def badge_tables(content: DataFrame, first_accepted: DataFrame, earned: DataFrame) -> dict[str, DataFrame]:
    e = earned.select("badges", "id")
    return {
        "badge_success": tables.outer_by_id(content.select("success", "id"), e).select(
            "success", "id", "badges"
        ),
        "badge_time": tables.outer_by_id(first_accepted.select("id", "elapsed"), e).select(
            "id", "elapsed", "badges"
        ),
    }


def model_tables(
    content: DataFrame, first_accepted: DataFrame, badge_time: DataFrame, bound_hi: int = ONE_DAY_MINUTES
) -> dict[str, DataFrame]:
    return {
        "combined": tables.outer_by_id(content, badge_time, fill={"badges": ""}),
        "combined_time": tables.bounded_with_history(
            first_accepted, badge_time.select("id", "badges"), "elapsed", 0, bound_hi
        ),
    }


def tag_sets(combined: DataFrame, min_support: int = 15) -> DataFrame:
    baskets = combined.where(F.col("tags").isNotNull()).select(
        "id", split_whitespace("tags").alias("items")
    )
    return itemsets.frequent_itemsets(baskets, min_support)


def build(
    posts: DataFrame,
    badges: DataFrame,
    starting_date: str,
    deadline: int = ONE_DAY_MINUTES,
    min_support: int = 15,
    bound_hi: int = ONE_DAY_MINUTES,
) -> dict[str, DataFrame]:
    """Every stage of one snapshot as lazy DataFrames (no writes).

    ``posts`` and ``badges`` have the dump schemas (``schemas.DUMP_TABLES``).
    """
    extracted, quarantined = extract(posts, starting_date)
    out = {"posts_extracted": extracted, "posts_quarantined": quarantined}
    out.update(labels(extracted, badges, deadline))
    out.update(badge_tables(out["content"], out["first_accepted"], out["earned_badges"]))
    out.update(model_tables(out["content"], out["first_accepted"], out["badge_time"], bound_hi))
    out["tag_itemsets"] = tag_sets(out["combined"], min_support)
    return out


def run(
    spark: SparkSession,
    dump_dir: str,
    out_dir: str,
    starting_date: str,
    deadline: int = ONE_DAY_MINUTES,
    min_support: int = 15,
    bound_hi: int = ONE_DAY_MINUTES,
) -> dict[str, str]:
    """Read ``Posts.xml`` / ``Badges.xml`` (or lower-case names) from
    ``dump_dir`` and write every stage under ``out_dir/<stage>/starting_date=<date>``.

    Each stage is written once and later stages read the written table back,
    so the XML is parsed once, lineage stays short and a lost executor only
    recomputes the stage at hand. Returns stage -> path.
    """
    import posixpath

    def find(name: str) -> str:
        """By Hadoop's file system, so the dump may lie in any store."""
        jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
        for cand in (f"{name.capitalize()}.xml", f"{name}.xml"):
            p = posixpath.join(dump_dir, cand)
            at = jvm.org.apache.hadoop.fs.Path(p)
            if at.getFileSystem(conf).exists(at):
                return p
        return posixpath.join(dump_dir, f"{name}.xml")

    paths: dict[str, str] = {}

    def put(name: str, df: DataFrame) -> DataFrame:
        path = posixpath.join(out_dir, name)
        write_stage(df, path, starting_date)
        paths[name] = path
        return read_stage(spark, path, starting_date, schema=df.schema)

    posts, bad_posts = read_dump(spark, find("posts"), "posts")
    badges, bad_badges = read_dump(spark, find("badges"), "badges")
    put("dump_quarantine", bad_posts.withColumn("table", F.lit("posts")).unionByName(
        bad_badges.withColumn("table", F.lit("badges"))
    ))
    badges = put("badges", badges)
    extracted, quarantined = extract(posts, starting_date)
    extracted = put("posts_extracted", extracted)
    put("posts_quarantined", quarantined)
    lab = {k: put(k, v) for k, v in labels(extracted, badges, deadline).items()}
    bt = {k: put(k, v) for k, v in badge_tables(
        lab["content"], lab["first_accepted"], lab["earned_badges"]).items()}
    mt = {k: put(k, v) for k, v in model_tables(
        lab["content"], lab["first_accepted"], bt["badge_time"], bound_hi).items()}
    put("tag_itemsets", tag_sets(mt["combined"], min_support))
    return paths
