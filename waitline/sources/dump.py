"""Row-per-element XML dump ingest with a quarantine (A1, A2, A4).

Each ``<row .../>`` element's attributes become one row. The file is read
with every column as a string (a typed read throws on one bad integer even
in DROPMALFORMED mode), then cast with ``try_cast``: a row whose non-null
value fails its cast, or whose key is missing, goes to the quarantine frame
with the reason instead of failing the job or vanishing. Attributes outside
the schema are ignored (the reference lost the whole row). Attribute names
match the schema regardless of case (``ParentID`` / ``ParentId``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas


def _elements(spark: SparkSession, path: str, row_tag: str) -> DataFrame:
    """(file, element, opened, closed): the text of each ``<row ...`` up to its own end;
    ``opened``: what follows opens a comment that it does not close, ``closed``: it
    closes one that it does not open.

    The text source with the tag's beginning as the record separator reads any byte
    range of a file: it starts at the first separator after the range's start and
    ends with the record that crosses its end, so one file is many tasks."""
    lines = spark.read.option("lineSep", f"<{row_tag}").text(path).select(F.col("value").alias("v"), F.col("_metadata.file_path").alias("file"))
    # attributes may hold ">" between quotes
    start = r"""^((?:[\s/](?:[^"'>]++|"[^"]*+"|'[^']*+')*+)?>)"""
    tag = F.regexp_extract("v", start, 1)
    close = f"</{row_tag}>"
    whole = F.when(F.endswith(tag, F.lit("/>")), tag).when(
        (tag != "") & F.contains("v", F.lit(close)), F.concat(F.substring_index("v", close, 1), F.lit(close))
    )
    rest = F.substring(F.col("v"), F.coalesce(F.length(whole), F.lit(0)) + 1, F.length("v"))
    after = lambda mark: F.length(rest) - F.length(F.substring_index(rest, mark, -1))  # noqa: E731  0: no such mark
    shut = F.instr(rest, "-->")
    return lines.select(
        "file",
        F.concat(F.lit(f"<{row_tag}"), whole).alias("element"),
        (after("<!--") > after("-->")).alias("opened"),
        ((shut > 0) & ((F.instr(rest, "<!--") == 0) | (F.instr(rest, "<!--") > shut))).alias("closed"),
    )


def _by_tokenizer(spark: SparkSession, paths, schema, row_tag: str) -> DataFrame:
    reader = spark.read.format("xml").option("rowTag", row_tag).option("attributePrefix", "").option("mode", "PERMISSIVE")
    return reader.schema(schema).load(paths)


def read_rows(spark: SparkSession, path: str, table: str, row_tag: str = "row") -> DataFrame:
    """The ``<row>`` elements of a dump (a file, folder or glob), every attribute a
    string. Files are read in byte ranges, whatever their line breaks. Elements inside
    a comment are no rows: files that have a comment around the beginning of an
    element (dumps have none) are read by the XML tokenizer instead, a task each."""
    schema = schemas.string_struct(table)
    found = _elements(spark, path, row_tag)
    odd = [r.file for r in found.where("opened OR closed").select("file").distinct().collect()]  # names of files
    parsed = found.where(F.col("element").isNotNull())
    if odd:
        parsed = parsed.where(~F.col("file").isin(odd))
    options = {"rowTag": row_tag, "attributePrefix": "", "mode": "PERMISSIVE"}
    rows = parsed.select(F.from_xml("element", schema, options).alias("r")).select("r.*")
    return rows.unionByName(_by_tokenizer(spark, odd, schema, row_tag)) if odd else rows


def read_dump(spark: SparkSession, path: str, table: str, row_tag: str = "row") -> tuple[DataFrame, DataFrame]:
    """(typed rows, quarantined rows) of one dump table."""
    return type_rows(read_rows(spark, path, table, row_tag), table)


def type_rows(raw: DataFrame, table: str) -> tuple[DataFrame, DataFrame]:
    cols = schemas.DUMP_TABLES[table]
    key = schemas.KEYS[table]
    typed = [F.col(n).try_cast(t).alias(n) for n, t in cols]
    failed = [
        F.when(F.col(n).isNotNull() & F.col(n).try_cast(t).isNull(), F.lit(n)) for n, t in cols
    ]
    checked = raw.select(
        *typed,
        F.array_compact(F.array(*failed)).alias("_bad_cols"),
        F.to_json(F.struct(*[F.col(n) for n, _ in cols])).alias("_raw"),
    )
    ok = (F.size("_bad_cols") == 0) & F.col(key).isNotNull()
    good = checked.where(ok).drop("_bad_cols", "_raw")
    bad = checked.where(~ok).select(
        "_raw",
        F.when(F.col(key).isNull() & (F.size("_bad_cols") == 0), F.lit("missing key"))
        .otherwise(F.concat(F.lit("bad value: "), F.array_join("_bad_cols", ",")))
        .alias("reason"),
    )
    return good, bad


def write_tables(tables: dict[str, DataFrame], out_dir: str) -> None:
    """Append each typed table under ``out_dir/<name>`` (A3)."""
    from .files import append_table

    for name, df in tables.items():
        append_table(df, f"{out_dir}/{name}")
