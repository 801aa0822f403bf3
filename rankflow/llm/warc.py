"""WARC archives: write with an index first, read back by sorted byte ranges.

Writing: every page becomes a WARC 1.1 record of its own gzip member.  Pages
whose payload equals that of a page with a smaller id become ``revisit``
records that refer to it.  For each record the index holds file, offset,
length, page id, URL, payload digest and type; Spark commits it, so files of
failed attempts are never referenced.

Reading: the wanted index rows are dealt out by (file, ``SEGMENT`` of the
file), sorted by offset, and neighbouring records are fetched with one read.

Scale: one shuffle of the pages, on the payload digest with a salt, so that
a payload shared by a third of all pages is spread over ``SALTS`` tasks; the
other side holds one row for each repeated payload.  Tasks stream: a writer
holds one record, a reader one coalesced range.

Defined cases: a null payload is empty; a null URL is left out of the record;
a page with a null id is always a response and is never referred to (its id
reads back as null); rows that repeat the smallest id are all responses; an
empty table gives no file and no row.
"""

from __future__ import annotations

import base64
import hashlib
import zlib

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankflow.llm.common import attempt_name, file_system, ship, shuffle_partitions, written
from rankflow.session import scratch_path

DATE = "2024-01-01T00:00:00Z"
SALTS = 16
FILE_BYTES = 1 << 30
SEGMENT = 8 << 20
GAP = 64 << 10
_HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
_INDEX = ("file string, offset long, length long, page_id long, url string, payload_digest string, "
          "record_type string")
_RECORD = ("page_id long, url string, payload_bytes long, payload_digest string, record_type string, "
           "refers_to long, payload binary")


def _clean(url: str) -> str:
    """A URL on one line (control characters and % signs of its own escape)."""
    return "".join(f"%{ord(c):02X}" if ord(c) < 32 else c for c in url)


def record(page_id, url, payload: bytes, first, date: str = DATE) -> tuple:
    """(gzip member, base32 digest, type) of one page."""
    digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
    revisit = first is not None and page_id is not None and first != page_id
    kind = "revisit" if revisit else "response"
    block = _HTTP if revisit else _HTTP + payload
    head = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <urn:page:{page_id}>", f"WARC-Date: {date}",
            f"WARC-Payload-Digest: sha1:{digest}", f"X-Payload-Length: {len(payload)}",
            "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    if url is not None:
        head.insert(3, f"WARC-Target-URI: {_clean(url)}")
    if revisit:
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
                 f"WARC-Refers-To: <urn:page:{first}>"]
    raw = "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"
    z = zlib.compressobj(1, zlib.DEFLATED, 31)
    return z.compress(raw) + z.flush(), digest, kind


def parse(member: bytes) -> tuple:
    """The fields of ``_RECORD`` of one gzip member; checks the digest."""
    raw = zlib.decompress(member, 31)
    head, _, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    field = dict(x.split(": ", 1) for x in lines[1:])
    block = rest[:int(field["Content-Length"])]
    kind = field["WARC-Type"]
    digest = field["WARC-Payload-Digest"].removeprefix("sha1:")
    number = lambda x: None if x == "None" else int(x)
    own = number(field["WARC-Record-ID"].removeprefix("<urn:page:").removesuffix(">"))
    if kind == "revisit":
        first = number(field["WARC-Refers-To"].removeprefix("<urn:page:").removesuffix(">"))
        return own, field.get("WARC-Target-URI"), int(field["X-Payload-Length"]), digest, kind, first, None
    payload = block.partition(b"\r\n\r\n")[2]
    if base64.b32encode(hashlib.sha1(payload).digest()).decode() != digest:
        raise ValueError(f"record {own}: payload does not match its digest")
    return own, field.get("WARC-Target-URI"), len(payload), digest, kind, None, payload


def write_warc(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html",
               min_bytes: int = 0, salts: int = SALTS, file_bytes: int = FILE_BYTES) -> DataFrame:
    """Write the archives to the shared folder; returns their index.  Equal
    payloads of at least ``min_bytes`` are written once."""
    spark = pages.sparkSession
    folder = scratch_path(spark, "warc")
    payload = F.coalesce(F.col(payload_col).cast("binary"), F.lit(b""))
    page = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("url"), payload.alias("payload"))
    key = F.unhex(F.sha1("payload"))
    keyed = page.where(F.length("payload") >= min_bytes).select("page_id", key.alias("digest"))
    firsts = (keyed.groupBy("digest").agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
              .select(F.col("digest").alias("f_digest"), "first",
                      F.explode(F.array(*[F.lit(k) for k in range(salts)])).alias("f_salt")))
    wide = page.select("*", key.alias("digest"), F.pmod(F.xxhash64("page_id", "url"), F.lit(salts)).cast("int").alias("salt"))
    joined = (wide.join(firsts, (F.col("digest") == F.col("f_digest")) & (F.col("salt") == F.col("f_salt")), "left")
              .select("page_id", "url", "payload", F.when(F.length("payload") >= min_bytes, F.col("first")).alias("first")))

    def write(batches):
        import pyarrow as pa

        fs = out = name = None
        at = 0
        names = [f.split()[0] for f in _INDEX.split(", ")]
        for b in batches:
            rows = []
            for page_id, url, body, first in zip(*(c.to_pylist() for c in b.columns)):
                if out is None:
                    fs, base = file_system(folder)
                    fs.create_dir(base, recursive=True)
                    name, at = attempt_name(".warc.gz"), 0
                    out = fs.open_output_stream(f"{base}/{name}", compression=None)
                member, digest, kind = record(page_id, url, body, first)
                out.write(member)
                rows.append((f"{folder}/{name}", at, len(member), page_id, url, digest, kind))
                at += len(member)
                if at >= file_bytes:
                    out.close()
                    out = None
            kinds = [pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string()]
            cols = list(zip(*rows)) or [()] * len(kinds)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds)], names)
        if out is not None:
            out.close()

    return written(joined.mapInArrow(write, _INDEX), "warc-index")


def read_warc(index: DataFrame, segment: int = SEGMENT, gap: int = GAP, payload: bool = True) -> DataFrame:
    """The records of the given index rows, read back from their archives."""
    n = shuffle_partitions(index)
    wanted = (index.select("file", "offset", "length")
              .withColumn("segment", F.floor(F.col("offset") / F.lit(segment)))
              .repartition(n, "file", "segment").sortWithinPartitions("file", "offset"))

    def read(batches):
        import pyarrow as pa

        kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary()]
        names = [f.split()[0] for f in _RECORD.split(", ")]
        name = f = None

        def fetch(group):
            data = f.read_at(group[-1][0] + group[-1][1] - group[0][0], group[0][0])
            rows = [parse(data[o - group[0][0]:o - group[0][0] + n]) for o, n in group]
            if not payload:
                rows = [(*r[:-1], None) for r in rows]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names)

        group = []
        for b in batches:
            for file, offset, length in zip(*(b.column(c).to_pylist() for c in ("file", "offset", "length"))):
                if group and (file != name or offset - group[-1][0] - group[-1][1] > gap
                              or offset + length - group[0][0] > segment):
                    yield fetch(group)
                    group = []
                if file != name:
                    if f is not None:
                        f.close()
                    fs, p = file_system(file)
                    f, name = fs.open_input_file(p), file
                group.append((offset, length))
        if group:
            yield fetch(group)
            f.close()

    return wanted.mapInArrow(read, _RECORD)


ship(__name__)
