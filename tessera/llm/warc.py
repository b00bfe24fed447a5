"""WARC archives, index first.

Writing: every page is a record of its own gzip member; tasks write archives
of bounded size to the shared folder through its file system, and what they
return is the index: archive, offset, length, url and digest of each record.
Only archives of finished tasks are in the index, so a repeated task leaves
nothing but a file that no one refers to. Of records with equal payloads the
one with the largest id is the response and the others revisit it.

Reading starts from the index: selected records are sorted by offset, close
ones are joined into ranges of bounded bytes, and a task reads each range at
once and parses the records in it.

Defined results: a null html is an empty payload; a null url is written
without a target; a null id is smaller than every other; of repeated rows that
hold the largest id one is the response; an empty table gives an empty index;
other columns are ignored. ``pages`` must be a scan of stored files (its rows
are numbered twice).
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import math
import re
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import map_arrow, numbered, slices, text_bytes, written
from tessera.session import scratch_path

SMALLEST = 1000
ARCHIVE_BYTES = 64 << 20
RANGE_BYTES = 4 << 20
#: Compressed bytes that a task reads of the archives.
TASK_BYTES = 64 << 20
GAP_BYTES = 64 << 10
INDEX = ("archive string, offset long, length long, url string, payload_digest string, page_id long, "
         "record_type string")
#: Fixed values of the format.
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "1970-01-01T00:00:00Z"


def opened(folder: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(re.sub(r"^file:/*", "file:///", folder))


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, revisit: bool) -> bytes:
    """One WARC record; the block of a revisit has no payload."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: <urn:page:{page_id}>", f"WARC-Date: {DATE}"]
    if url is not None:
        head.append("WARC-Target-URI: " + url.replace("%", "%25").replace("\r", "%0D").replace("\n", "%0A"))
    if revisit:
        head += [f"WARC-Profile: {REVISIT_PROFILE}", f"WARC-Refers-To: <urn:page:{refers_to}>"]
    head += ["WARC-Payload-Digest: sha1:" + base64.b32encode(hashlib.sha1(payload).digest()).decode(),
             "Content-Type: application/http;msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse(data: bytes) -> dict:
    """What a record says; the digest of a response is checked."""
    head, _, rest = data.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = rest[:int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    digest = base64.b32decode(fields["WARC-Payload-Digest"].removeprefix("sha1:"))
    revisit = fields["WARC-Type"] == "revisit"
    if not revisit and hashlib.sha1(payload).digest() != digest:
        raise ValueError(f"damaged record {fields['WARC-Record-ID']}")

    def page(name: str) -> int | None:
        value = fields.get(name, "<urn:page:None>")[10:-1]
        return None if value == "None" else int(value)

    url = fields.get("WARC-Target-URI")
    return {"page_id": page("WARC-Record-ID"), "record_type": fields["WARC-Type"], "refers_to": page("WARC-Refers-To"),
            "payload_bytes": int(re.search(rb"Content-Length: (\d+)", http)[1]), "payload_digest": digest.hex(),
            "url": url and url.replace("%0A", "\n").replace("%0D", "\r").replace("%25", "%"),
            "payload": None if revisit else payload}


def typed(pages: DataFrame, smallest: int = SMALLEST) -> DataFrame:
    """Pages with ``refers_to`` and ``revisit``, by equal payloads."""
    rows = numbered(pages.select("page_id", "url", "html")).select(
        "row_id", F.col("page_id").cast("long"), "url", text_bytes("html").alias("payload"))
    ids = written(rows.where(F.octet_length("payload") >= smallest)
                  .select("row_id", "page_id", F.sha2("payload", 256).alias("content"), F.octet_length("payload").alias("size")), "payload-ids")
    groups = (ids.groupBy("content", "size").agg(F.max(F.struct("page_id", "row_id")).alias("best"), F.count("*").alias("n"))
              .where("n > 1").select("content", "size", "best"))
    revisits = (ids.join(groups, ["content", "size"]).where(F.col("row_id") != F.col("best.row_id"))
                .select("row_id", F.col("best.page_id").alias("refers_to"), F.lit(True).alias("revisit")))
    return rows.join(revisits, "row_id", "left").withColumn("revisit", F.coalesce("revisit", F.lit(False)))


def write_archives(pages: DataFrame, folder: str, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write the archives of ``typed`` pages; the index, as a stored table."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        store, base = opened(folder)
        out, stream, at, name = [], None, 0, ""
        store.create_dir(base, recursive=True)

        def rows():
            return dict(zip([f.split()[0] for f in INDEX.split(", ")], zip(*out, strict=True), strict=True))

        for batch in batches:
            for part in slices(batch, "payload"):
                for page, url, payload, refers, revisit in zip(*(part.column(c).to_pylist() for c in ("page_id", "url", "payload", "refers_to", "revisit")), strict=True):
                    if stream is None:
                        name, at = f"{uuid.uuid4().hex}.warc.gz", 0
                        stream = store.open_output_stream(f"{base}/{name}", compression=None)
                    data = gzip.compress(record(page, url, payload, refers, revisit), 3, mtime=0)
                    stream.write(data)
                    out.append((f"{folder}/{name}", at, len(data), url, hashlib.sha1(payload).hexdigest(), page, "revisit" if revisit else "response"))
                    at += len(data)
                    if at >= archive_bytes:
                        stream.close()
                        stream = None
                if stream is None and out:
                    yield rows()
                    out = []
        if stream is not None:
            stream.close()
        if out:
            yield rows()

    return written(map_arrow(pages.select("page_id", "url", "payload", "refers_to", "revisit"), run, INDEX), "warc-index")


def read_records(index: DataFrame, range_bytes: int = RANGE_BYTES, gap_bytes: int = GAP_BYTES, payloads: bool = True,
                 task_bytes: int = TASK_BYTES) -> DataFrame:
    """The records of (selected) index rows, by coalesced range reads, some
    ``task_bytes`` a task: page_id, url, record_type, refers_to, payload_bytes,
    payload_digest, payload (null for revisits, or if not asked for)."""
    by = Window.partitionBy("archive").orderBy("offset")
    end = F.col("offset") + F.col("length")
    new = ((F.col("offset") - F.lag(end).over(by) > gap_bytes)
           | (F.floor(F.col("offset") / range_bytes) != F.floor(F.lag("offset").over(by) / range_bytes)))
    ranges = (index.select("archive", "offset", "length").withColumn("new", F.coalesce(new.cast("int"), F.lit(0)))
              .withColumn("range", F.sum("new").over(by))
              .groupBy("archive", "range").agg(F.min("offset").alias("start"), F.max(end).alias("stop"),
                                               F.sort_array(F.collect_list(F.struct("offset", "length"))).alias("records")))

    # The index is small against what it points to: tasks by the bytes they will read.
    total = index.agg(F.sum("length")).first()[0] or 0
    tasks = max(index.sparkSession.sparkContext.defaultParallelism, math.ceil(total / task_bytes))
    ranges = ranges.repartition(tasks, "archive", "range")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        names = ["page_id", "url", "record_type", "refers_to", "payload_bytes", "payload_digest", "payload"]
        for batch in batches:
            for row in batch.to_pylist():
                folder, _, name = row["archive"].rpartition("/")
                store, base = opened(folder)
                with store.open_input_file(f"{base}/{name}") as f:
                    data = f.read_at(row["stop"] - row["start"], row["start"])
                found = []
                for r in row["records"]:
                    at = r["offset"] - row["start"]
                    found.append(parse(gzip.decompress(data[at:at + r["length"]])))
                    if not payloads:
                        found[-1]["payload"] = None
                yield {n: [x[n] for x in found] for n in names}

    return map_arrow(ranges.select("archive", "start", "stop", "records"), run,
                     "page_id long, url string, record_type string, refers_to long, payload_bytes long, payload_digest string, payload binary")


def round_trip(pages: DataFrame) -> DataFrame:
    """Write (page_id, url, html) rows as archives and read them back."""
    index = write_archives(typed(pages), scratch_path(pages.sparkSession, "warc"))
    return read_records(index, payloads=False)
