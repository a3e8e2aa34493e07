"""Dumps are read in byte ranges, with the rows of the XML tokenizer."""

import pytest
from pyspark.sql import functions as F

from waitline import schemas
from waitline.sources import dump as D


def _both(spark, path, table="badges"):
    got = D.read_rows(spark, str(path), table)
    want = D._by_tokenizer(spark, str(path), schemas.string_struct(table), "row")
    rows = lambda df: sorted(map(repr, df.select(*sorted(df.columns)).collect()))
    return rows(got), rows(want)


@pytest.fixture
def small_splits(spark):
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "100000")
    spark.conf.set("spark.sql.files.openCostInBytes", "1000")
    yield
    for k, v in old.items():
        spark.conf.set(k, v)


def test_one_file_is_many_tasks(spark, tmp_path, small_splits):
    body = "".join(f'  <row Id="{i}" UserId="{i % 90}" Name="n{i} &lt;b&gt; &amp; &quot;x&quot; > é" Date="2016-01-01T00:00:00.000" />\n' for i in range(20_000))
    (tmp_path / "b.xml").write_bytes("﻿".encode() + f'<?xml version="1.0" encoding="utf-8"?>\n<badges>\n{body}</badges>\n'.encode())
    rows = D.read_rows(spark, str(tmp_path / "b.xml"), "badges")
    assert rows.rdd.getNumPartitions() > 10
    assert rows.count() == 20_000 and rows.select(F.countDistinct("Id")).first()[0] == 20_000
    got, want = _both(spark, tmp_path / "b.xml")
    assert got == want


def test_forms_of_elements(spark, tmp_path):
    text = """<badges><row Id="1" Name="a>b"/><row Id='2' Name='it "is"' UserId="7"></row>
    <rows Id="99"/><row
        Id="3"
        Name="two lines"
    /><row Id="4" Name="<tag"/><row/><row Id="5" Name="last" /></badges>"""
    (tmp_path / "b.xml").write_text(text.replace('"<tag"', '"&lt;tag"'))
    ids = lambda df: sorted(r.id or "" for r in df.select(F.col("id")).collect())
    assert ids(D.read_rows(spark, str(tmp_path / "b.xml"), "badges")) == ["", "1", "2", "3", "4", "5"]
    names = {r.id: r.name for r in D.read_rows(spark, str(tmp_path / "b.xml"), "badges").collect()}
    assert names["1"] == "a>b" and names["2"] == 'it "is"' and names["4"] == "<tag"


def test_elements_in_comments_are_no_rows(spark, tmp_path):
    (tmp_path / "a.xml").write_text('<x><!-- <row Id="8"/> and <row Id="9"/> --><row Id="1" Name="a"/><!-- note --></x>')
    (tmp_path / "b.xml").write_text('<x><row Id="2" Name="b"/><!-- note -->\n<row Id="3" Name="--> <!--"/></x>'.replace("<!--\"", "&lt;!--\""))
    got, want = _both(spark, tmp_path)
    assert got == want and len(got) == 3


def test_empty_files(spark, tmp_path):
    (tmp_path / "a.xml").write_text("<badges></badges>")
    (tmp_path / "b.xml").write_text("")
    assert D.read_rows(spark, str(tmp_path), "badges").count() == 0
