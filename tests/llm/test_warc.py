"""WARC archives: whole-table round trip, segments, chunked framing, damage."""

import base64
import glob
import hashlib
import random

import pyarrow.parquet as pq
import pytest
from pyspark.sql import types as T

from waitline.llm import common as C
from waitline.llm import warc as W

SF = "/root/testdata/sf0.001"
SCHEMA = T.StructType([T.StructField("page_id", T.LongType()), T.StructField("url", T.StringType()), T.StructField("html", T.StringType()), T.StructField("key", T.StringType()), T.StructField("name", T.StringType())])


def brute(rows):
    last = {}
    for i, h in rows:
        if i is not None:
            last[h or ""] = max(i, last.get(h or "", i))
    out = []
    for i, h in rows:
        raw, best = (h or "").encode(), last.get(h or "")
        revisit = best is not None and i != best
        out.append((i, len(raw), base64.b32encode(hashlib.sha1(raw).digest()).decode(), "revisit" if revisit else "response", best if revisit else None))
    return sorted(out, key=str)


def index(spark, path):
    return sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in W.page_index(W.read(spark, path)).where("error IS NULL").collect()), key=str)


def test_whole_table(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    path = C.scratch_path(spark, "warc")
    W.write(pages, path, segment=1000, records_a_file=40)
    t = pq.read_table(f"{SF}/pages.parquet").to_pydict()
    assert index(spark, path) == brute(list(zip(t["page_id"], t["html"])))
    texts = {r.page_id: r.payload for r in W.page_index(W.read(spark, path)).join(W.read(spark, path).select("digest", "payload"), F_digest(), "left").where("payload IS NOT NULL").collect()}
    assert texts and all(bytes(texts[i]).decode() == h for i, h in zip(t["page_id"], t["html"]) if i in texts)


def F_digest():
    from pyspark.sql import functions as F

    return F.concat(F.lit("sha1:"), F.col("payload_digest")) == F.col("digest")


def test_nulls_ties_long_repeats_and_clashing_columns(spark):
    rows = [(1, None, None), (2, "http://a/\r\nX: y", ""), (None, "u", "same"), (3, "u", "same"), (3, "u", "same"), (4, "u", "same\r\n\r\nWARC/1.1\r\n"), (-5, "é", "é" * 300_000), (6, "u", "0\r\n\r\n"), (7, "v", "only"), (7, "v", "only")]
    path = C.scratch_path(spark, "warc")
    W.write(spark.createDataFrame([(*r, "k", "n") for r in rows], SCHEMA), path)
    assert index(spark, path) == brute([(r[0], r[2]) for r in rows])


def test_least_bytes(spark):
    path = C.scratch_path(spark, "warc")
    W.write(spark.createDataFrame([(1, "u", "ab", "", ""), (2, "u", "ab", "", ""), (3, "u", "abc", "", ""), (4, "u", "abc", "", "")], SCHEMA), path, least=3)
    assert [(r[0], r[3]) for r in index(spark, path)] == [(1, "response"), (2, "response"), (3, "revisit"), (4, "response")]


def test_empty_table(spark):
    path = C.scratch_path(spark, "warc")
    W.write(spark.createDataFrame([], SCHEMA), path)
    assert W.read(spark, path).count() == 0


def _read(spark, tmp_path, files):
    for k, records in enumerate(files):
        (tmp_path / f"{k}.warc").write_bytes(b"".join(r + b"\r\n\r\n" for r in records))
    return {r.record_id: r for r in W.read(spark, str(tmp_path)).collect()}


def test_segments_in_any_order_and_missing_ones(spark, tmp_path):
    payload = bytes(random.Random(1).randrange(256) for _ in range(5000))
    good = W.records_of("urn:good", "u", payload, W.digest_of(payload), None, 700)
    gap = W.records_of("urn:gap", "u", payload, W.digest_of(payload), None, 700)
    cut = W.records_of("urn:cut", "u", payload, W.digest_of(payload), None, 700)
    twice = W.records_of("urn:twice", "u", payload, W.digest_of(payload), None, 700)
    assert len(good) > 5
    records = [*good, *gap[:2], *gap[3:], *cut[:-1], *twice, twice[1]]
    random.Random(2).shuffle(records)
    got = _read(spark, tmp_path, [records[::2], records[1::2]])
    assert bytes(got["urn:good"].payload) == payload and got["urn:good"].error is None
    assert "missing" in got["urn:gap"].error and "total" in got["urn:cut"].error and "repeated" in got["urn:twice"].error


def test_damaged_payloads_are_told(spark, tmp_path):
    one = W.records_of("urn:a", "u", b"hello", W.digest_of(b"other"), None, 9999)
    two = [W.records_of("urn:b", "u", b"hello", W.digest_of(b"hello"), None, 9999)[0].replace(b"5\r\nhello", b"6\r\nhello")]
    three = [W._record([("WARC-Type", "response"), ("WARC-Record-ID", "<urn:c>")], b"HTTP/1.1 200 OK\r\nContent-Length: 4\r\n\r\nfine")]
    got = _read(spark, tmp_path, [one + two + three])
    assert "digest" in got["urn:a"].error and "broken" in got["urn:b"].error
    assert got["urn:c"].error is None and bytes(got["urn:c"].payload) == b"fine"


def test_chunked_framing():
    rnd = random.Random(3)
    for n in (0, 1, 15, 16, 17, 1000):
        body = bytes(rnd.randrange(256) for _ in range(n))
        for size in (1, 16, 4096):
            assert W.dechunked(W.chunked(body, size)) == body
    assert W.dechunked(b"4;x=1\r\nab\r\n\r\n1\r\n!\r\n0\r\nTrailer: 1\r\n\r\n") == b"ab\r\n!"
    for bad in (b"", b"5\r\nabc\r\n0\r\n\r\n", b"zz\r\n", b"0\r\n\r\nmore", b"3\r\nabc\r\n"):
        with pytest.raises(ValueError):
            W.dechunked(bad)


def test_files_are_plain_warc(spark):
    path = C.scratch_path(spark, "warc")
    W.write(spark.createDataFrame([(i, "u", f"page {i}", "", "") for i in range(25)], SCHEMA).coalesce(1), path, records_a_file=10)
    files = glob.glob(f"{path}/part-*")
    assert len(files) == 3
    assert sum(sum(e is None for *_, e in W.parsed(open(f, "rb").read())) for f in files) == 25


def _raw(name, body=b"fine"):
    return W.records_of(name, "u", body, W.digest_of(body), None, 1 << 20)[0] + b"\r\n\r\n"


def test_damaged_records_are_told_and_the_others_read(spark, tmp_path):
    length = b"Content-Length: " + _raw("urn:x").split(b"Content-Length: ")[1].split(b"\r\n")[0]
    cut = {
        "word": _raw("urn:bad").replace(length, b"Content-Length: many"),
        "none": _raw("urn:bad").replace(length + b"\r\n", b""),
        "large": _raw("urn:bad").replace(length, b"Content-Length: 999999999"),
        "short": _raw("urn:bad").replace(length, b"Content-Length: 3"),
        "number": _raw("urn:bad").replace(b"WARC-Date", b"WARC-Segment-Number: x\r\nWARC-Date", 1),
    }
    for k, bad in cut.items():
        (tmp_path / f"{k}.warc").write_bytes(_raw(f"urn:before-{k}") + bad + _raw(f"urn:after-{k}"))
    (tmp_path / "junk.warc").write_bytes(b"junk" + b"\r\n\r\n" + _raw("urn:after-junk"))
    (tmp_path / "end.warc").write_bytes(_raw("urn:before-end") + _raw("urn:bad")[:-30])
    (tmp_path / "head.warc").write_bytes(_raw("urn:before-head") + b"WARC/1.1\r\nWARC-Type: resp")
    (tmp_path / "empty.warc").write_bytes(b"")
    rows = W.read(spark, str(tmp_path)).collect()
    good = [r for r in rows if r.error is None]
    assert sorted(r.record_id for r in good) == sorted([f"urn:{a}-{k}" for k in cut for a in ("before", "after")] + ["urn:after-junk", "urn:before-end", "urn:before-head"])
    assert all(bytes(r.payload) == b"fine" for r in good)
    assert len([r for r in rows if r.record_id == "urn:bad"]) == len(cut) + 1
    assert len(rows) == len(good) + len(cut) + 3


def test_a_damaged_segment_spoils_its_record_only(spark, tmp_path):
    body = b"0123456789" * 300
    parts = W.records_of("urn:seg", "u", body, W.digest_of(body), None, 700)
    parts[1] = parts[1].replace(b"WARC-Segment-Number: 2", b"WARC-Segment-Number: two")
    got = _read(spark, tmp_path, [parts + W.records_of("urn:ok", "u", body, W.digest_of(body), None, 700)])
    assert "number" in got["urn:seg"].error and bytes(got["urn:ok"].payload) == body


def test_gzip_files(spark, tmp_path):
    import gzip
    import random as R

    noise = R.Random(5).randbytes(150_000)
    records = [_raw(f"urn:{k}", noise if k == 2 else b"body %d" % k) for k in range(5)]
    (tmp_path / "each.warc.gz").write_bytes(b"".join(map(gzip.compress, records)))
    (tmp_path / "whole.warc.gz").write_bytes(gzip.compress(b"".join(x.replace(b"urn:", b"urn:w") for x in records)))
    broken = bytearray(gzip.compress(_raw("urn:lost", noise)))
    broken[5000:5050] = b"\0" * 50
    (tmp_path / "broken.warc.gz").write_bytes(gzip.compress(_raw("urn:b")) + bytes(broken) + gzip.compress(_raw("urn:c")))
    (tmp_path / "cut.warc.gz").write_bytes(gzip.compress(_raw("urn:d")) + gzip.compress(_raw("urn:e"))[:-12])
    rows = W.read(spark, str(tmp_path)).collect()
    good = {r.record_id for r in rows if r.error is None}
    assert {f"urn:{k}" for k in range(5)} | {f"urn:w{k}" for k in range(5)} | {"urn:b", "urn:c", "urn:d"} <= good and "urn:lost" not in good
    assert any("gzip" in (r.error or "") for r in rows)
