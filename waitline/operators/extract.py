"""One-pass post extraction with a quarantine (H8, A4).

The reference loops over rows, prints failures and skips them. Here the
whole extraction is one ``select`` of column expressions; rows that cannot
be extracted (no body) go to a second frame instead of being lost silently.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.html import extract_columns
from .response import has_codes

PASS_THROUGH = ("id", "posttypeid", "acceptedanswerid", "parentid", "creationdate")


def extract_posts(
    posts: DataFrame,
    body: str = "body",
    tags: str | None = "tags",
    title: str | None = "title",
    keep: Sequence[str] = PASS_THROUGH,
) -> tuple[DataFrame, DataFrame]:
    """(extracted, quarantined). Extracted columns: kept ids, ``title,
    paragraphs, tags, codes, hascodes``; quarantined rows keep their input
    columns plus ``reason``."""
    kept = [c for c in keep if c in posts.columns]
    ok = posts.where(F.col(body).isNotNull())
    out = ok.select(*kept, *extract_columns(body, tags, title)).withColumn(
        "hascodes", has_codes("codes")
    )
    bad = posts.where(F.col(body).isNull()).withColumn("reason", F.lit("null body"))
    return out, bad
