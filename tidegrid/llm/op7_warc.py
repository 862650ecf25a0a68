"""WARC archives: writing with revisits, segments and chunked transfer framing, and reading back.

Writing: each row becomes a response whose block is an HTTP message with a chunked body; a block over ``SEGMENT_BYTES``
is cut into a first record and ``continuation`` records that name their origin.  Of rows with equal payloads, the one
with the smallest id is the response and the others are ``revisit`` records without a body, which name the response's
record and state the payload's length in their HTTP header.  Every record is a gzip member of its own, so it can be read
alone from its offset.  Archives are written by Spark's text writer, so executors need no shared local folder and a lost
task is written again: a member's last byte, the high byte of its length, is always zero and is left to the writer's line
separator.  A file holds at most ``RECORDS_PER_FILE`` records and so stays far below what one row can hold when read.

Reading: records are split by their Content-Length, never by searching for the next header; continuation records are
grouped by origin, ordered by segment number and held against the total length that the last one states; then the
chunked framing is decoded and the payload's digest compared with the header's.

Defined results: null html is an empty payload; payloads may be text or any bytes; very long ones are cut into as many
segments as they need; a null id is kept, and is a response only if no row with an id has its payload; rows that share
the smallest id and the payload are all responses, and revisits of theirs name the record of that id and payload without
the suffix that tells such copies apart; equal rows get records of their own; a segment that is missing, doubled or short
raises ``ValueError``; an empty table gives an empty archive and no rows; further columns are not read.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegrid.sources.scratch import scratch_path

from .common import table

SEGMENT_BYTES = 1 << 16
CHUNK_BYTES = 1 << 12
RECORDS_PER_FILE = 4000
_EOL = b"\r\n"


def digest(payload: bytes) -> str:
    """Bare upper-case base32 SHA-1."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def cut(data: bytes, limit: int) -> list[bytes]:
    return [data[at : at + limit] for at in range(0, len(data), limit)]


def chunked(payload: bytes, limit: int = CHUNK_BYTES) -> bytes:
    """HTTP/1.1 chunked transfer framing."""
    return b"".join(b"%x\r\n%s\r\n" % (len(p), p) for p in cut(payload, limit)) + b"0\r\n\r\n"


def unchunked(body: bytes) -> bytes:
    out, at = [], 0
    while True:
        end = body.find(b"\r\n", at)
        if end < 0:
            raise ValueError("chunked body ends early")
        size = int(body[at:end].split(b";")[0], 16)
        at = end + 2
        if not size:
            return b"".join(out)
        if len(body) < at + size + 2 or body[at + size : at + size + 2] != b"\r\n":
            raise ValueError("chunk is short")
        out.append(body[at : at + size])
        at += size + 2


def record(kind: str, rid: str, headers: list[tuple[str, str]], block: bytes) -> bytes:
    """One record as a gzip member."""
    lines = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <{rid}>", "WARC-Date: 1970-01-01T00:00:00Z"]
    lines += [f"{k}: {v}" for k, v in headers] + [f"Content-Length: {len(block)}"]
    return gzip.compress(_EOL.join(x.encode() for x in lines) + 2 * _EOL + block + 2 * _EOL, 6, mtime=0)


def record_id(page: str, sha: str, copy: str = "") -> str:
    return f"urn:page:{page}:{sha}" + (f":{copy}" if copy else "")


def page_records(page: str, copy: str, url: str | None, payload: bytes, refers: str | None, segment_bytes: int = SEGMENT_BYTES) -> list[bytes]:
    """All records of a row; ``copy`` tells equal rows apart, ``refers``: the page that a revisit refers to."""
    sha = digest(payload)
    rid = record_id(page, sha, copy)
    uri = "".join(c for c in (url or "about:blank") if c not in "\r\n")
    head = [("WARC-Target-URI", uri), ("WARC-Payload-Digest", f"sha1:{sha}"), ("Content-Type", "application/http; msgtype=response")]
    if refers is not None:
        return [record("revisit", rid, [*head, ("WARC-Refers-To", f"<{record_id(refers, sha)}>"), ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")], b"HTTP/1.1 200 OK\r\nContent-Length: %d\r\n\r\n" % len(payload))]
    block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nTransfer-Encoding: chunked\r\n\r\n" + chunked(payload)
    parts = cut(block, segment_bytes)
    if len(parts) == 1:
        return [record("response", rid, head, block)]
    out = [record("response", rid, [*head, ("WARC-Segment-Number", "1")], parts[0])]
    for i, part in enumerate(parts[1:], 2):
        more = [("WARC-Target-URI", uri), ("WARC-Segment-Origin-ID", f"<{rid}>"), ("WARC-Segment-Number", str(i))]
        if i == len(parts):
            more.append(("WARC-Segment-Total-Length", str(len(block))))
        out.append(record("continuation", f"{rid}:{i}", more, part))
    return out


def read_records(stream) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers by lower-case name, block) of each record, by Content-Length."""
    while line := stream.readline():
        if not line.strip():
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError(f"not a WARC record: {line[:40]!r}")
        headers = {}
        while (line := stream.readline()).strip():
            name, _, value = line.decode().partition(":")
            headers[name.strip().lower()] = value.strip()
        size = int(headers["content-length"])
        block = stream.read(size)
        if len(block) != size:
            raise ValueError("record is short")
        yield headers, block


def write_archives(pages: DataFrame, path: str, key: str = "page_id", html: str = "html", url: str = "url", segment_bytes: int = SEGMENT_BYTES, records_per_file: int = RECORDS_PER_FILE) -> None:
    """Write ``pages`` as WARC files of gzip members under ``path``."""
    payload = F.coalesce(F.col(html).cast("binary"), F.lit(b""))
    rows = pages.select(F.col(key).cast("long").alias("page"), F.col(url).alias("url"), payload.alias("html"))
    rows = rows.withColumn("sha", F.sha1(F.col("html"))).withColumn("n", F.octet_length("html"))
    # Payloads that occur once need no join partner, so only repeated ones travel.
    pages_of = rows.groupBy("sha", "n", "page").agg(F.count("*").alias("copies"))
    firsts = pages_of.groupBy("sha", "n").agg(F.min("page").alias("first"), F.sum("copies").alias("copies"), F.max("copies").alias("most")).where(F.col("copies") > 1)
    firsts = firsts.select("sha", "n", "first", (F.col("most") > 1).alias("repeated"))
    refers = F.when(~F.col("page").eqNullSafe(F.col("first")), F.col("first")).alias("refers")
    typed = rows.join(firsts, ["sha", "n"], "left").select("page", "url", "html", refers, F.coalesce("repeated", F.lit(False)).alias("repeated"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        task, serial = TaskContext.get().partitionId(), 0
        for b in batches:
            out = []
            for page, u, h, ref, repeated in zip(b["page"], b["url"], b["html"], b["refers"], b["repeated"], strict=True):
                serial += 1
                got = page_records("null" if pd.isna(page) else str(int(page)), f"{task}-{serial}" if repeated else "", u, bytes(h), None if pd.isna(ref) else str(int(ref)), segment_bytes)
                if any(r[-1] for r in got):
                    raise ValueError("a record of 16 MB or more; take smaller segments")
                out += [r[:-1] for r in got]
                if len(out) >= 500:
                    yield pd.DataFrame({"value": out})
                    out = []
            yield pd.DataFrame({"value": out}, dtype=object)

    # Bytes pass the text writer as they are; its separator is the zero byte that ends every member.
    members = typed.mapInPandas(run, "value binary").select(F.col("value").cast("string").alias("value"))
    members.write.option("lineSep", "\x00").option("maxRecordsPerFile", str(records_per_file)).text(path)


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """(page, kind, sha, refers, n, payload) of each reassembled record.

    ``n``: bytes of the full payload; ``payload`` is null for revisits, whose length their HTTP header states.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("content")
    cols = ["origin", "number", "total", "kind", "sha", "refers", "block"]

    def split(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for content in b["content"]:
                out = []
                held = 0
                for h, block in read_records(gzip.GzipFile(fileobj=io.BytesIO(content))):
                    origin = h.get("warc-segment-origin-id", h["warc-record-id"]).strip("<>")
                    out.append((origin, int(h.get("warc-segment-number", 0)), int(h.get("warc-segment-total-length", -1)), h["warc-type"], h.get("warc-payload-digest", "").partition(":")[2] or None, h.get("warc-refers-to", "").strip("<>") or None, block))
                    held += len(block)
                    if held > 8 << 20:
                        yield pd.DataFrame(out, columns=cols)
                        out, held = [], 0
                yield pd.DataFrame(out, columns=cols)

    parts = files.mapInPandas(split, "origin string, number int, total long, kind string, sha string, refers string, block binary")
    # Whole records pass; only segmented ones are gathered by their origin.
    alone = parts.where("number = 0").select("origin", "kind", "sha", "refers", F.array("block").alias("blocks"), F.lit(-1).cast("long").alias("total"), F.lit(True).alias("whole"))
    segment = F.struct("number", "block")
    many = parts.where("number > 0").groupBy("origin").agg(F.sort_array(F.collect_list(segment)).alias("s"), F.max("total").alias("total"), F.max("sha").alias("sha"))
    in_order = F.transform("s", lambda x: x["number"]) == F.sequence(F.lit(1), F.size("s"))
    many = many.select("origin", F.lit("response").alias("kind"), "sha", F.lit(None).cast("string").alias("refers"), F.col("s.block").alias("blocks"), "total", in_order.alias("whole"))

    def decode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            payloads, sizes = [], []
            for origin, kind, sha, blocks, total, whole in zip(b["origin"], b["kind"], b["sha"], b["blocks"], b["total"], b["whole"], strict=True):
                block = b"".join(blocks)
                if not whole or (len(blocks) > 1 and total != len(block)):
                    raise ValueError(f"segments of {origin} don't make up its record")
                head, _, body = block.partition(b"\r\n\r\n")
                if kind == "revisit":
                    payloads.append(None)
                    sizes.append(int(head.lower().partition(b"content-length:")[2].split(b"\r\n")[0]))
                    continue
                payload = unchunked(body) if b"transfer-encoding: chunked" in head.lower() else body
                if digest(payload) != sha:
                    raise ValueError(f"digest of {origin} differs")
                payloads.append(payload)
                sizes.append(len(payload))
            yield pd.DataFrame({"origin": b["origin"], "kind": b["kind"], "sha": b["sha"], "refers": b["refers"], "n": sizes, "payload": pd.Series(payloads, dtype=object)})

    out = alone.unionByName(many).mapInPandas(decode, "origin string, kind string, sha string, refers string, n long, payload binary")
    number = lambda c: F.expr(f"try_cast(split({c}, ':')[2] AS BIGINT)")
    return out.select(number("origin").alias("page"), "kind", "sha", number("refers").alias("refers"), "n", "payload", F.col("origin").alias("record_id"), F.col("refers").alias("refers_to_record"))


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write every page, read the archives back and report each record."""
    path = scratch_path(spark, "op7-warc")
    write_archives(table(spark, sf_dir, "pages"), path)
    got = read_archives(spark, path)
    return got.select(F.col("page").alias("page_id"), F.col("n").alias("payload_bytes"), F.col("sha").alias("payload_digest"), F.col("kind").alias("record_type"), F.col("refers").alias("refers_to"))
