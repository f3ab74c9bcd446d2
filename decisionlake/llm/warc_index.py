"""WARC archives with an index, read back by coalesced byte ranges.

Each task writes compressed records into files of its own under the shared folder and returns one
index row per record: file, offset, length, URL and digest. The index is an ordinary table, filtered
like one; the ranges of the records that it selects are sorted, joined where they are close, and read
by tasks that each get a share of the bytes. A file name is unique to the attempt that wrote it, and
only the rows of attempts that succeed enter the index.

Of records with equal payloads (of at least ``min_bytes``) that of the smallest page id is the
response; the others are revisits, which refer to it and hold only its HTTP header.

Cases: null html is an empty payload; a null url has no target header; a null id counts as larger
than any other, and equal payloads without any id are all responses; rows that repeat the response's
id and payload are responses too; line breaks in a url are percent-encoded; an empty table gives an
empty index; other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

INDEX = (
    "file string, offset bigint, length bigint, url string, digest string, page_id bigint, "
    "record_type string, refers_to bigint"
)
RECORDS = "page_id bigint, url string, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint"
FILE_BYTES = 256 << 20
#: Ranges are read in shares of so many bytes, over gaps of at most ``GAP_BYTES``.
SHARE_BYTES, GAP_BYTES = 4 << 20, 64 << 10
DATE = "2024-01-01T00:00:00Z"
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def _name(page_id: int | None) -> str:
    return f"<urn:page:{'null' if page_id is None else page_id}>"


def _page(name: str | None) -> int | None:
    number = name.strip("<>").rsplit(":", 1)[1] if name else "null"
    return None if number == "null" else int(number)


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """One record, compressed on its own. ``refers_to`` is the response's id, for a revisit."""
    revisit = refers_to is not None
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http if revisit else http + payload
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {_name(page_id)}", f"WARC-Date: {DATE}"]
    if url is not None:
        head.append(f"WARC-Target-URI: {quote(url, safe=''.join(map(chr, range(33, 127))))}")
    head += [f"WARC-Payload-Digest: sha1:{digest}", "Content-Type: application/http; msgtype=response"]
    if revisit:
        head += [f"WARC-Refers-To: {_name(refers_to)}", f"WARC-Profile: {REVISIT}"]
    head.append(f"Content-Length: {len(block)}")
    squeeze = zlib.compressobj(4, zlib.DEFLATED, 31)
    return squeeze.compress("\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n") + squeeze.flush()


def parse(data: bytes) -> dict:
    """Headers and payload of one compressed record."""
    plain = zlib.decompress(data, 31)
    cut = plain.index(b"\r\n\r\n")
    version, *lines = plain[:cut].decode().split("\r\n")
    headers = dict(line.split(": ", 1) for line in lines)
    block = plain[cut + 4 : cut + 4 + int(headers["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    if not version.startswith("WARC/") or len(plain) != cut + 8 + len(block):
        raise ValueError("not a single complete record")
    revisit = headers["WARC-Type"] == "revisit"
    declared = int(http.decode().rsplit("Content-Length: ", 1)[1].split("\r\n", 1)[0])
    digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
    claimed = headers["WARC-Payload-Digest"].removeprefix("sha1:")
    if not revisit and (digest != claimed or declared != len(payload)):
        raise ValueError(f"record {headers['WARC-Record-ID']} does not match its digest")
    return {
        "page_id": _page(headers["WARC-Record-ID"]), "url": headers.get("WARC-Target-URI"), "payload": payload,
        "payload_bytes": declared, "payload_digest": claimed, "record_type": headers["WARC-Type"],
        "refers_to": _page(headers.get("WARC-Refers-To")),
    }


def _write_task(folder: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = fs.FileSystem.from_uri(folder)
        store.create_dir(base, recursive=True)
        out = file = None
        offset = 0
        for batch in batches:
            rows = []
            for page, url, html, sha1, refers in zip(*(batch.column(c).to_pylist() for c in ("page_id", "url", "html", "sha1", "refers_to"))):
                if out is None or offset >= FILE_BYTES:
                    if out is not None:
                        out.close()
                    file, offset = f"{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex}.warc.gz", 0
                    out = store.open_output_stream(f"{base}/{file}", compression=None)
                digest = base64.b32encode(bytes.fromhex(sha1)).decode()
                data = record(page, url, (html or "").encode(), digest, refers)
                out.write(data)
                rows.append((file, offset, len(data), url, digest, page, "response" if refers is None else "revisit", refers))
                offset += len(data)
            if rows:
                kinds = [pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64()]
                columns = [pa.array(c, k) for c, k in zip(zip(*rows), kinds)]
                yield pa.RecordBatch.from_arrays(columns, ["file", "offset", "length", "url", "digest", "page_id", "record_type", "refers_to"])
        if out is not None:
            out.close()

    return run


def write_warc(pages: DataFrame, folder: str, min_bytes: int = 0) -> DataFrame:
    """Write ``pages`` (page_id, url, html) under ``folder``; returns the index, itself written there."""
    rows = pages.select(
        F.col("page_id").cast("bigint").alias("page_id"), F.col("url").cast("string").alias("url"), F.coalesce("html", F.lit("")).alias("html")
    ).withColumn("sha1", F.sha1(F.col("html").cast("binary")))
    firsts = rows.filter(F.octet_length("html") >= min_bytes).groupBy("sha1").agg(F.min("page_id").alias("_first"), F.count("*").alias("_n"))
    firsts = firsts.filter("_n > 1 AND _first IS NOT NULL").drop("_n")
    refers = F.when(F.col("page_id").isNull() | (F.col("page_id") != F.col("_first")), F.col("_first"))
    rows = rows.join(firsts, "sha1", "left").withColumn("refers_to", refers).select("page_id", "url", "html", "sha1", "refers_to")
    spark = pages.sparkSession
    rows.mapInArrow(_write_task(f"{folder}/archives"), INDEX).write.mode("overwrite").parquet(f"{folder}/index")
    return spark.read.schema(INDEX).parquet(f"{folder}/index")


def _read_task(folder: str, with_payload: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = fs.FileSystem.from_uri(folder)
        names = ["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to", *(["payload"] if with_payload else [])]
        kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary()]

        def out(rows):
            return pa.RecordBatch.from_arrays([pa.array([r[n] for r in rows], k) for n, k in zip(names, kinds)], names)

        for batch in batches:
            for file, ranges in zip(batch.column("file").to_pylist(), batch.column("ranges").to_pylist()):
                ranges = sorted((r["offset"], r["length"]) for r in ranges)
                with store.open_input_file(f"{base}/{file}") as source:
                    at, rows = 0, []
                    while at < len(ranges):
                        start, end, last = ranges[at][0], ranges[at][0] + ranges[at][1], at + 1
                        while last < len(ranges) and ranges[last][0] - end <= GAP_BYTES:
                            end, last = max(end, sum(ranges[last])), last + 1
                        data = memoryview(source.read_at(end - start, start))
                        rows += [parse(data[o - start : o - start + n]) for o, n in ranges[at:last]]
                        at = last
                yield out(rows)

    return run


def read_records(selected: DataFrame, folder: str, with_payload: bool = False) -> DataFrame:
    """The records of ``selected`` index rows, from the archives under ``folder``."""
    shares = selected.groupBy("file", F.floor(F.col("offset") / SHARE_BYTES).alias("share")).agg(
        F.collect_list(F.struct("offset", "length")).alias("ranges")
    )
    total = selected.agg(F.sum("length")).first()[0] or 0
    tasks = max(selected.sparkSession.sparkContext.defaultParallelism, total // (8 * SHARE_BYTES) + 1)
    schema = RECORDS + (", payload binary" if with_payload else "")
    return shares.repartition(int(tasks), "file", "share").mapInArrow(_read_task(f"{folder}/archives", with_payload), schema)
