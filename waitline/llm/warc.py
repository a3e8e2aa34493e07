"""WARC archives: writing pages as records, and reading them back with segment
reassembly.

Writing. Each row is a WARC/1.1 record whose block is an HTTP message. Of rows
with equal payloads of at least ``least`` bytes, that with the largest id is a
response and the others are revisits of it, without payload; smaller payloads
are all responses. A response's body is in chunked transfer coding; a block of
over ``segment`` bytes is cut into a first record and continuation records
(WARC-Segment-Number, WARC-Segment-Origin-ID, and on the last
WARC-Segment-Total-Length). Spark's text
writer writes the files (a record's last four bytes, CRLF CRLF, are its line
separator), so any store works.

Reading. A file, plain or gzip (one member or one for each record), is parsed record
by record by its Content-Length. Where a record does not end where it says, or has
no usable length, reading goes on at the next record that begins after an empty
line; a gzip member that is damaged is left at the next one. Continuation records are grouped with their first one by origin identifier, ordered by
segment number and joined; numbers must be 1, 2, ... n and the length must be
the total that the last one states. Then the HTTP header is split off, chunked
transfer framing is decoded, and length and digest are verified. Broken records
come back with a note in ``error``, none is dropped. Only segmented records are
shuffled. A file is read whole by one task: ``records_a_file`` bounds it.

Payloads are compared by SHA-1, as the format does. Null payloads are empty; a
null id counts as smaller than any other. Rows that share id and payload have the
same type (all responses, if the largest). Repeated rows are all written.
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common as C

SEGMENT = 16 << 10  # bytes of a block in one record
CHUNK = 4 << 10  # bytes of a chunk of a body
RECORDS_A_FILE = 4_000  # of at most SEGMENT bytes and a header each
DATE = "2026-01-01T00:00:00Z"
_URN = "urn:waitline:page:"
_GAP = b"\r\n\r\n"


def digest_of(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def chunked(body: bytes, size: int = CHUNK) -> bytes:
    """``body`` in chunked transfer coding."""
    parts = [b"%x\r\n%s\r\n" % (len(body[i : i + size]), body[i : i + size]) for i in range(0, len(body), size)]
    return b"".join([*parts, b"0\r\n\r\n"])


def dechunked(raw: bytes) -> bytes:
    """The body of chunked transfer coding; extensions and trailers are skipped.
    ValueError if it is broken or ends early."""
    out, at = [], 0
    while True:
        end = raw.index(b"\r\n", at)
        size = int(raw[at:end].split(b";")[0].strip(), 16)
        at = end + 2
        if size == 0:
            break
        if size < 0 or raw[at + size : at + size + 2] != b"\r\n":
            raise ValueError("chunk without its end")
        out.append(raw[at : at + size])
        at += size + 2
    while (end := raw.index(b"\r\n", at)) > at:  # trailers
        at = end + 2
    if end + 2 != len(raw):
        raise ValueError("bytes after the last chunk")
    return b"".join(out)


def _record(fields: list[tuple[str, str]], block: bytes) -> bytes:
    """Without the CRLF CRLF at its end."""
    head = "".join(f"{k}: {v}\r\n" for k, v in [*fields, ("Content-Length", str(len(block)))])
    return b"WARC/1.1\r\n" + head.encode() + b"\r\n" + block


def _clean(url: str | None) -> str | None:
    return None if url is None else re.sub(r"[\r\n]+", " ", url)


def records_of(name: str, url: str | None, payload: bytes, digest: str, refers_to: str | None, segment: int) -> list[bytes]:
    """The records of one page: one, or the segments of one."""
    head = [("WARC-Type", "revisit" if refers_to else "response"), ("WARC-Record-ID", f"<{name}>"), ("WARC-Date", DATE)]
    head += [("WARC-Target-URI", _clean(url))] * (url is not None) + [("WARC-Payload-Digest", f"sha1:{digest}")]
    if refers_to:
        head += [("WARC-Refers-To", f"<{refers_to}>"), ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")]
        block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
        return [_record([*head, ("Content-Type", "application/http; msgtype=response")], block)]
    block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nTransfer-Encoding: chunked\r\n\r\n" + chunked(payload)
    head.append(("Content-Type", "application/http; msgtype=response"))
    if len(block) <= segment:
        return [_record(head, block)]
    parts = [block[i : i + segment] for i in range(0, len(block), segment)]
    out = [_record([*head, ("WARC-Segment-Number", "1")], parts[0])]
    for k, part in enumerate(parts[1:], 2):
        own = [("WARC-Type", "continuation"), ("WARC-Record-ID", f"<{name}:{k}>"), ("WARC-Date", DATE), ("WARC-Segment-Origin-ID", f"<{name}>"), ("WARC-Segment-Number", str(k))]
        own += [("WARC-Segment-Total-Length", str(len(block)))] * (k == len(parts))
        out.append(_record(own, part))
    return out


# ------------------------------------------------------------ writing


def _writer(segment: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, size = [], 0
            for name, url, payload, refers_to in zip(*(batch.column(i) for i in range(4))):
                payload = payload.as_py() or b""
                made = records_of(name.as_py(), url.as_py(), payload, digest_of(payload), refers_to.as_py(), segment)
                rows += made
                size += sum(map(len, made))
                if size > 16 << 20:
                    yield pa.RecordBatch.from_arrays([pa.array(rows, pa.binary())], names=["record"])
                    rows, size = [], 0
            yield pa.RecordBatch.from_arrays([pa.array(rows, pa.binary())], names=["record"])

    return run


def write(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html", least: int = 0, segment: int = SEGMENT, records_a_file: int = RECORDS_A_FILE) -> None:
    """Writes a record for every row of ``pages`` to WARC files under ``path``."""
    page = pages.select(F.col(id_col).cast("long").alias("id"), F.col(url_col).cast("string").alias("url"), F.coalesce(F.col(payload_col).cast("binary"), F.lit(b"")).alias("payload"))
    key = F.sha1("payload").alias("key")
    # the largest id of each payload that occurs under several ids
    shared = page.where(F.octet_length("payload") >= least).groupBy(key).agg(F.max("id").alias("last"), F.count(F.lit(1)).alias("n"), F.min("id").alias("first"), F.count("id").alias("named"))
    shared = C.stored(shared.where("last IS NOT NULL AND (first < last OR named < n)").select("key", "last"), "shared")
    joined = page.withColumn("key", key).join(shared, "key", "left")
    revisit = F.col("last").isNotNull() & ~F.col("id").eqNullSafe(F.col("last")) & (F.octet_length("payload") >= least)
    # a row's own number keeps the records of equal ids apart
    name = F.concat(F.lit(_URN), F.coalesce(F.col("id").cast("string"), F.lit("null")), F.lit(":"), F.monotonically_increasing_id())
    refers_to = F.when(revisit, F.concat(F.lit(_URN), F.col("last").cast("string")))
    records = joined.select(name.alias("name"), "url", "payload", refers_to.alias("refers_to")).mapInArrow(_writer(segment), "record binary")
    lines = records.select(F.col("record").cast("string").alias("value"))
    lines.write.option("lineSep", "\r\n\r\n").option("maxRecordsPerFile", records_a_file).option("compression", "none").text(path)


# ------------------------------------------------------------ reading


_MAGIC = b"\x1f\x8b\x08"


def unzipped(raw: bytes, step: int = 64 << 10) -> tuple[bytes, list[str]]:
    """The content of gzip members one after the other, and what is wrong."""
    out, errors, at, view = [], [], 0, memoryview(raw)
    while at < len(raw):
        begin, member = at, zlib.decompressobj(31)
        try:
            while not member.eof and at < len(raw):
                out.append(member.decompress(view[at : at + step]))
                at += step
            if not member.eof:
                errors.append("the file ends within a gzip member")
            at -= len(member.unused_data) + max(0, at - len(raw)) if member.eof else 0
        except zlib.error as e:
            errors.append(f"broken gzip member at byte {begin}: {e}")
            out.append(_GAP)  # the record that is cut ends here
            at = raw.find(_MAGIC, begin + 1)
            if at < 0:
                break
    return b"".join(out), errors


def _number(x: str | None) -> int | None:
    """The number that ``x`` states; -1 for none that can be."""
    if x is None:
        return None
    return int(x) if x.isascii() and x.isdigit() and len(x) < 10 else -1


def parsed(raw: bytes) -> Iterator[tuple[dict[str, str], memoryview, str | None]]:
    """(fields by lower-case name, block, what is wrong) of each record of a file."""
    view, at = memoryview(raw), 0
    while at < len(raw):
        after = raw.find(_GAP, at)
        fields, error, start = {}, None, at
        if not raw.startswith(b"WARC/", at):
            error = f"no WARC record at byte {at}"
            after = at
        elif after < 0:
            error, after = f"no end of the header at byte {at}", at
        else:
            lines = raw[at:after].decode(errors="replace").split("\r\n")[1:]
            fields = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines)}
            start = after + len(_GAP)
            length = _number(fields.get("content-length"))
            stop = start + (length or 0)
            if length is None or length < 0:
                error = f"no Content-Length of the record at byte {at}"
            elif raw[stop : stop + 4] != _GAP:
                error = f"record at byte {at} does not end where it says"
        if error:
            stop = raw.find(_GAP + b"WARC/", after)
            stop = len(raw) if stop < 0 else stop
        yield fields, view[min(start, stop) : stop], error
        at = stop + len(_GAP)


_RECORD = pa.schema(
    [("type", pa.string()), ("record_id", pa.string()), ("origin", pa.string()), ("number", pa.int32()), ("total", pa.int64()), ("url", pa.string()), ("digest", pa.string()), ("refers_to", pa.string()), ("block", pa.binary()), ("error", pa.string())]
)
_RECORD_SQL = "type string, record_id string, origin string, number int, total long, url string, digest string, refers_to string, block binary, error string"


def _bare(x: str | None) -> str | None:
    return x.strip("<>") if x else None


def _row(f: dict[str, str], block: memoryview, error: str | None) -> tuple:
    number, total = _number(f.get("warc-segment-number")), _number(f.get("warc-segment-total-length"))
    if error is None and (number == -1 or total == -1):
        error = "a segment number or total length that is none"
    id_ = _bare(f.get("warc-record-id"))
    origin = _bare(f.get("warc-segment-origin-id")) or (id_ if number else None)
    return f.get("warc-type"), id_, origin, number, total, f.get("warc-target-uri"), f.get("warc-payload-digest"), _bare(f.get("warc-refers-to")), bytes(block), error


def _reader(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    out = lambda rows: pa.RecordBatch.from_arrays([pa.array(c, x.type) for c, x in zip(zip(*rows), _RECORD)], schema=_RECORD)
    for batch in batches:
        for content in batch.column(0):
            raw, errors = content.as_py(), []
            if raw.startswith(_MAGIC):
                raw, errors = unzipped(raw)
            rows, size = [_row({}, memoryview(b""), e) for e in errors], 0
            for record in parsed(raw):
                rows.append(_row(*record))
                size += len(record[1])
                if size > 8 << 20:
                    yield out(rows)
                    rows, size = [], 0
            if rows:
                yield out(rows)


def reassembled(records: DataFrame) -> DataFrame:
    """Whole records of those that ``_reader`` gives: the segments of one origin
    joined in order of their numbers; ``error`` says what is wrong, if anything."""
    single = records.where("origin IS NULL").drop("origin", "number", "total")
    first = lambda c: F.max(F.when(F.col("number") == 1, F.col(c))).alias(c)
    parts = F.array_sort(F.collect_list(F.struct("number", "block")))
    joined = records.where("origin IS NOT NULL").groupBy("origin").agg(*(first(c) for c in ("type", "url", "digest", "refers_to")), F.max("total").alias("total"), F.max("number").alias("last"), F.max("error").alias("error"), parts.alias("parts"))
    # as strings for array_join, which takes their bytes as they are
    joined = joined.withColumn("last", F.coalesce("last", F.lit(1)))
    joined = joined.withColumn("block", F.array_join(F.transform("parts", lambda x: x["block"].cast("string")), "").cast("binary"))
    numbers = F.transform("parts", lambda x: x["number"])
    error = F.when(F.col("error").isNotNull(), F.col("error")).when(~numbers.eqNullSafe(F.sequence(F.lit(1), F.greatest("last", F.lit(1)))), F.lit("segments are missing or repeated")).when(
        F.col("total").isNull() | (F.col("total") != F.octet_length("block")), F.lit("not the total length that the last segment states")
    )
    return single.unionByName(joined.withColumn("error", error).select("type", F.col("origin").alias("record_id"), "url", "digest", "refers_to", "block", "error"))


def payload_of(block: bytes) -> tuple[bytes, int]:
    """(payload, its stated length) of an HTTP message; ValueError if broken."""
    head, gap, body = block.partition(_GAP)
    if not gap:
        raise ValueError("no end of the HTTP header")
    fields = {k.strip().lower(): v.strip() for k, _, v in (x.partition(b":") for x in head.split(b"\r\n")[1:])}
    if fields.get(b"transfer-encoding", b"").lower() == b"chunked":
        body = dechunked(body)
        return body, len(body)
    return body, int(fields.get(b"content-length", len(body)))


def _decoder(with_payload: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kinds, digests, blocks, errors = (batch.column(i) for i in (0, 3, 5, 6))
            bodies, sizes, found = [], [], []
            for kind, digest, block, error in zip(kinds, digests, blocks, errors):
                kind, digest, error, body, size = kind.as_py(), digest.as_py(), error.as_py(), None, None
                if error is None:
                    try:
                        body, size = payload_of(block.as_py())
                        if kind == "revisit":
                            body = None
                        elif size != len(body):
                            error = "not the length that its header states"
                        elif digest is not None and digest != f"sha1:{digest_of(body)}":
                            error = "not the digest that its header states"
                    except ValueError as e:
                        error = f"broken HTTP message: {e}"
                bodies.append(body)
                sizes.append(size)
                found.append(error)
            cols = [kinds, batch.column(1), batch.column(2), digests, batch.column(4), pa.array(sizes, pa.int64()), pa.array(found, pa.string())]
            names = ["type", "record_id", "url", "digest", "refers_to", "payload_bytes", "error"]
            yield pa.RecordBatch.from_arrays([*cols, *[pa.array(bodies, pa.binary())] * with_payload], names=[*names, *["payload"] * with_payload])

    return run


def read(spark: SparkSession, path: str, with_payload: bool = True) -> DataFrame:
    """type, record_id, url, digest, refers_to, payload_bytes, error and the payload
    (null for revisits) of every record of the files under ``path``."""
    files = spark.read.format("binaryFile").load(path).select("content")
    whole = reassembled(files.mapInArrow(_reader, _RECORD_SQL)).select("type", "record_id", "url", "digest", "refers_to", "block", "error")
    schema = "type string, record_id string, url string, digest string, refers_to string, payload_bytes long, error string" + ", payload binary" * with_payload
    return whole.mapInArrow(_decoder(with_payload), schema)


def page_index(records: DataFrame) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to of records
    that ``write`` made."""
    id_ = lambda c: F.expr(f"try_cast(regexp_extract({c}, '^{_URN}([^:]+)', 1) AS bigint)")
    return records.select(
        id_("record_id").alias("page_id"), "payload_bytes", F.regexp_replace("digest", "^sha1:", "").alias("payload_digest"), F.col("type").alias("record_type"), F.when(F.col("refers_to").isNotNull(), id_("refers_to")).alias("refers_to"), "error"
    )
