"""Legacy archives (ARC, versions 1 and 2) and their conversion to WARC.

``write_arcs`` stores pages as ARC files, ``index_arcs`` lists the records of
files that others wrote, ``convert`` parses each ARC by its version's field line
and the records' declared lengths and writes the WARC records that say the same,
``read_warcs`` reads those back. All run a file a task; page bytes never pass a
shuffle. Files may be plain or gzipped, with a member a record or several in
one; a record that can't be read is a row with the reason, not an error.
"""

from __future__ import annotations

import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator
from datetime import datetime, timezone
from urllib.parse import quote, unquote

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import files
from .session import checkpoint, scratch, workers_import_this

#: Fixed values of the two formats: the field line of each ARC version.
ARC_FIELDS = {
    "1": "URL IP-address Archive-date Content-type Archive-length",
    "2": "URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length",
}
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
MIN_REVISIT_BYTES = 100
FILE_BYTES = 64 << 20
CAPTURED = "20240101000000"
_DATE = re.compile(r"\d{8}(?:\d{2}){0,3}")
#: What a header line looks like: where reading goes on after a damaged record.
_HEADER = re.compile(rb"^[a-z][a-z0-9+.-]*:[^\n]* \S+ \d{8,14} [^\n]*\d+\r?$", re.M | re.I)


def _member(data: bytes, level: int) -> bytes:
    """One gzip member without a time stamp."""
    z = zlib.compressobj(level, zlib.DEFLATED, 31)
    return z.compress(data) + z.flush()


def members(data: bytes) -> Iterator[tuple[int, bytes]]:
    """Offset and content of each gzip member."""
    at, view = 0, memoryview(data)
    while at < len(data):
        z, out, fed = zlib.decompressobj(31), [], at
        while not z.eof:
            if fed >= len(data):
                raise ValueError("a gzip member is cut off")
            out.append(z.decompress(view[fed : fed + 8192]))
            fed += min(8192, len(data) - fed)
        yield at, b"".join(out)
        at = fed - len(z.unused_data)


def arc_head(name: str, version: str) -> bytes:
    """The version block, which describes the file itself."""
    body = f"{version} 0 deliverylens\n{ARC_FIELDS[version]}\n".encode()
    url = f"filedesc://{name}"
    if version == "1":
        line = f"{url} 0.0.0.0 {CAPTURED} text/plain {len(body)}\n"
    else:
        line = f"{url} 0.0.0.0 {CAPTURED} text/plain 200 - - 0 {name} {len(body)}\n"
    return line.encode() + body + b"\n"


def arc_record(version: str, url: str | None, response: bytes, offset: int, name: str) -> bytes:
    """One record; the URL's white space is percent-encoded, as the line is split at it."""
    place = "".join(f"%{b:02X}" if b <= 32 else chr(b) for b in (url or "-").encode("latin-1", "ignore")) if (url or "").isascii() else "".join(f"%{b:02X}" if b <= 32 or b > 126 else chr(b) for b in url.encode())
    place = place or "-"
    if version == "1":
        line = f"{place} 0.0.0.0 {CAPTURED} text/html {len(response)}\n"
    else:
        line = f"{place} 0.0.0.0 {CAPTURED} text/html 200 {zlib.crc32(response):08x} - {offset} {name} {len(response)}\n"
    return line.encode() + response + b"\n"


def _fields(line: str, names: list[str]) -> dict[str, str]:
    """The values of a header line by its version's names. More values than
    names are white space inside the content type, or inside the URL if only
    that puts a date in its place."""
    values, more = line.split(" "), 0
    if len(values) < len(names):
        raise ValueError("fewer fields than the version has")
    more = len(values) - len(names)
    if more and _DATE.fullmatch(values[2]):
        values[3 : 4 + more] = [" ".join(values[3 : 4 + more])]
    elif more:
        values[: 1 + more] = ["%20".join(values[: 1 + more])]
    out = dict(zip(names, values))
    if not _DATE.fullmatch(out["Archive-date"]):
        raise ValueError("no archive date")
    if not out["Archive-length"].isdigit():
        raise ValueError("no declared length")
    return out


def parse_arc(data: bytes) -> Iterator[tuple[int, int, dict[str, str], bytes]]:
    """(offset, nth, header fields, body) of each record but version blocks.

    offset is the gzip member's, nth counts the records inside it; in a plain
    file offset is the record's own. A version block's body names the version
    and its fields, by which the header lines after it are read (version 1 until
    one comes); bodies are read by their declared length, and line ends after
    them are skipped. A damaged record has the only field ``error``; reading
    goes on at the next member, or at the next line that looks like a header.
    """
    names = ARC_FIELDS["1"].split(" ")
    zipped = data[:2] == b"\x1f\x8b"
    flow = members(data) if zipped else iter([(0, data)])
    while True:
        try:
            base, raw = next(flow)
        except StopIteration:
            return
        except (ValueError, zlib.error) as e:
            yield len(data), 0, {"error": str(e)}, b""
            return
        at = nth = 0
        while at < len(raw):
            if raw[at] in b"\r\n":
                at += 1
                continue
            stop = raw.find(b"\n", at)
            place, stop = (base, nth) if zipped else (at, 0), len(raw) if stop < 0 else stop
            try:
                fields = _fields(raw[at:stop].rstrip(b"\r").decode("utf-8", "replace"), names)
                end = stop + 1 + int(fields["Archive-length"])
                if end > len(raw) or (end < len(raw) and raw[end] not in b"\r\n" and not _HEADER.match(raw, end)):
                    raise ValueError("the declared length isn't the record's")
            except ValueError as e:
                yield *place, {"error": str(e)}, b""
                again = _HEADER.search(raw, min(stop + 1, len(raw)))
                at, nth = again.start() if again else len(raw), nth + 1
                continue
            body, at, nth = raw[stop + 1 : end], end, nth + 1
            if fields["URL"].startswith("filedesc://"):
                told = body.decode("utf-8", "replace").splitlines()[:2]
                listed = told[1].split(" ") if len(told) > 1 else []
                if {"URL", "IP-address", "Archive-date", "Content-type", "Archive-length"} <= set(listed):
                    names = listed
                elif told and told[0].split(" ")[0] in ARC_FIELDS:
                    names = ARC_FIELDS[told[0].split(" ")[0]].split(" ")
                nth -= 1
            else:
                yield *place, fields, body


def record_id(arc: str, offset: int, nth: int = 0) -> str:
    """The identifier of the WARC record for an ARC record: the same for every run."""
    place = f"arc:{arc}#{offset}.{nth}" if nth else f"arc:{arc}#{offset}"
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, place)}>"


def warc_record(kind: str, fields: list[tuple[str, str]], block: bytes) -> bytes:
    head = [("WARC-Type", kind), *fields, ("Content-Length", str(len(block)))]
    return b"WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in head).encode() + b"\r\n" + block + b"\r\n\r\n"


def parse_warc(raw: bytes) -> tuple[dict[str, str], bytes]:
    head, _, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("not a WARC record")
    fields = dict(x.split(": ", 1) for x in lines[1:])
    n = int(fields["Content-Length"])
    if rest[n:] != b"\r\n\r\n":
        raise ValueError("a WARC record's length is not the declared one")
    return fields, rest[:n]


def _date(stamp: str) -> str:
    return datetime.strptime(stamp.ljust(14, "0"), "%Y%m%d%H%M%S").replace(tzinfo=timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")


def _page_of(head: bytes) -> str | None:
    """The page id that ``write_arcs`` puts among the HTTP headers."""
    return next((unquote(x[11:].decode()) for x in head.split(b"\r\n") if x.startswith(b"X-Page-Id: ")), None)


def _payload(body: bytes) -> tuple[bytes, bytes, bool]:
    """(HTTP headers, payload, whether it is a response)."""
    head, _, payload = body.partition(b"\r\n\r\n")
    return (head, payload, True) if head.startswith(b"HTTP/") else (b"", body, False)


def to_warc(arc: str, offset: int, nth: int, fields: dict[str, str], body: bytes, revisits: tuple[str, str] | None) -> bytes:
    """The WARC record equivalent to an ARC record.

    A record with an HTTP status line is a response, or a revisit of
    (record id, page id); anything else is a resource.
    """
    head, payload, http = _payload(body)
    page = _page_of(head) if http else None
    out = [
        ("WARC-Record-ID", record_id(arc, offset, nth)),
        ("WARC-Date", _date(fields["Archive-date"])),
        ("WARC-Target-URI", fields["URL"]),
        ("WARC-IP-Address", fields["IP-address"]),
        ("WARC-Payload-Digest", "sha256:" + hashlib.sha256(payload).hexdigest()),
    ]
    if page is not None:
        out.append(("DL-Page-Id", quote(page, safe="")))
    if not http:
        return warc_record("resource", [*out, ("WARC-Block-Digest", "sha256:" + hashlib.sha256(body).hexdigest()), ("Content-Type", fields["Content-type"])], body)
    block, kind = body, "response"
    if revisits:
        block, kind = head + b"\r\n\r\n", "revisit"
        out += [("WARC-Profile", REVISIT_PROFILE), ("WARC-Refers-To", revisits[0]), ("DL-Payload-Bytes", str(len(payload)))]
        if revisits[1] is not None:
            out.append(("DL-Refers-To-Page-Id", quote(revisits[1], safe="")))
    out += [("WARC-Block-Digest", "sha256:" + hashlib.sha256(block).hexdigest()), ("Content-Type", f"application/http;msgtype=response")]
    return warc_record(kind, out, block)


def write_arcs(pages: DataFrame, folder: str, *, version: str | None = None, file_bytes: int = FILE_BYTES) -> DataFrame:
    """Store pages (page_id, url, html) as ARC files; one row a record:
    (arc, offset, nth, page_id, payload_bytes, payload_digest); nth is 0.

    A null html is an empty payload, a null url is ``-``. Without a version,
    tasks take version 1 and 2 in turn.
    """
    workers_import_this(pages.sparkSession)
    files.make_dir(folder)
    kind = pages.schema["page_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        v = version or "12"[part % 2]
        flow = ((i, u, h.as_py(), b.schema.field(0).type) for b in batches for i, u, h in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2)))
        held, number = next(flow, None), 0
        while held is not None:
            name = f"part-{part:06d}-{number:04d}.arc.gz"
            rows = []
            with files.new_file(f"{folder}/{name}") as out:
                first = _member(arc_head(name, v), 1)
                out.write(first)
                at = len(first)
                while held is not None and at < file_bytes:
                    page, url, html, kind_ = held
                    payload = (html or "").encode()
                    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n"
                    head += f"X-Page-Id: {quote(str(page), safe='')}\r\n" if page is not None else ""
                    data = _member(arc_record(v, url, head.encode() + b"\r\n" + payload, at, name), 1)
                    out.write(data)
                    rows.append((name, at, page, len(payload), hashlib.sha256(payload).hexdigest()))
                    at += len(data)
                    held = next(flow, None)
            number += 1
            cols = list(zip(*rows))
            yield pa.RecordBatch.from_arrays([pa.array(cols[0]), pa.array(cols[1], pa.int64()), pa.array(cols[2], kind_), pa.array(cols[3], pa.int64()), pa.array(cols[4])], names=["arc", "offset", "page_id", "payload_bytes", "payload_digest"])

    return pages.select("page_id", F.col("url").cast("string"), F.col("html").cast("string")).mapInArrow(run, f"arc string, offset long, page_id {kind}, payload_bytes long, payload_digest string").selectExpr("arc", "offset", "0 AS nth", "page_id", "payload_bytes", "payload_digest")


def index_arcs(names: DataFrame, folder: str) -> DataFrame:
    """The records of ARC files (arc) in a folder: (arc, offset, nth, page_id,
    payload_bytes, payload_digest, error). A record that can't be read has its
    reason in ``error`` and no payload; page_id is a string, null in files of others."""
    workers_import_this(names.sparkSession)
    cols = ["arc", "offset", "nth", "page_id", "payload_bytes", "payload_digest", "error"]
    kinds = [pa.string(), pa.int64(), pa.int32(), pa.string(), pa.int64(), pa.string(), pa.string()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for arc in batch.column(0).to_pylist():
                rows = []
                for offset, nth, fields, body in parse_arc(files.read_file(f"{folder}/{arc}")):
                    if "error" in fields:
                        rows.append((arc, offset, nth, None, None, None, fields["error"]))
                        continue
                    head, payload, _ = _payload(body)
                    rows.append((arc, offset, nth, _page_of(head), len(payload), hashlib.sha256(payload).hexdigest(), None))
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(list(zip(*rows)) or [[]] * 7, kinds)], names=cols)

    return _a_file_each(names.select("arc")).mapInArrow(run, "arc string, offset long, nth int, page_id string, payload_bytes long, payload_digest string, error string")


def _a_file_each(todo: DataFrame) -> DataFrame:
    """Rows of ``arc`` and what a task needs for it, few and each much work: a
    file a task while cores are free, then four files each."""
    n, cores = todo.count(), todo.sparkSession.sparkContext.defaultParallelism
    return todo.repartitionByRange(max(1, min(n, cores), n // 4), "arc")


def revisits(index: DataFrame) -> DataFrame:
    """(arc, offset, first): for every record of 100 bytes or more whose payload
    an earlier record has, that record: the smallest page id (null ids last, then by place)."""
    rank = F.struct(F.col("page_id").isNull().alias("none"), "page_id", "arc", "offset", "nth")
    big = index.where(F.col("payload_bytes") >= MIN_REVISIT_BYTES)
    first = big.groupBy("payload_digest").agg(F.min(rank).alias("first"), F.count("*").alias("n")).where("n > 1").drop("n")
    again = big.join(checkpoint(first), "payload_digest")
    return again.where("arc != first.arc OR offset != first.offset OR nth != first.nth").select("arc", "offset", "nth", F.struct("first.arc", "first.offset", "first.nth", F.col("first.page_id").cast("string").alias("page_id")).alias("first"))


def convert(index: DataFrame, arcs: str, folder: str) -> DataFrame:
    """Write one WARC file for each ARC file; (path, records) a file.

    Records that can't be read are left out here; ``index_arcs`` lists them.
    A task gets the revisits of its own file only, so what it holds is bounded
    by the file's size.
    """
    spark = index.sparkSession
    workers_import_this(spark)
    files.make_dir(folder)
    if "error" in index.columns:
        index = index.where("error IS NULL")
    again = revisits(index).groupBy("arc").agg(F.collect_list(F.struct("offset", "nth", "first")).alias("again"))
    todo = index.groupBy("arc").agg(F.count("*").alias("records")).join(again, "arc", "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                first = {(x["offset"], x["nth"]): x["first"] for x in r["again"] or ()}
                name = r["arc"].removesuffix(".gz").removesuffix(".arc")
                path, n = f"{folder}/{name}.warc.gz", 0
                with files.new_file(path) as out:
                    info = [("WARC-Record-ID", record_id(r["arc"], -1)), ("WARC-Date", _date(CAPTURED)), ("WARC-Filename", path.rpartition("/")[2]), ("Content-Type", "application/warc-fields")]
                    out.write(_member(warc_record("warcinfo", info, f"converted-from: {r['arc']}\r\n".encode()), 3))
                    for offset, nth, fields, body in parse_arc(files.read_file(f"{arcs}/{r['arc']}")):
                        if "error" in fields:
                            continue
                        x = first.get((offset, nth))
                        out.write(_member(to_warc(r["arc"], offset, nth, fields, body, x and (record_id(x["arc"], x["offset"], x["nth"]), x["page_id"])), 3))
                        n += 1
                if n != r["records"]:
                    raise ValueError(f"{r['arc']} has {n} records, not {r['records']}")
                yield pa.RecordBatch.from_pylist([{"path": path, "records": n}])

    return checkpoint(_a_file_each(todo).mapInArrow(run, "path string, records long"))


def read_warcs(warcs: DataFrame, page_type: str = "bigint") -> DataFrame:
    """One row a response, revisit or resource record of the WARC files.

    Digests are computed anew and compared; a revisit says its payload's size.
    """
    workers_import_this(warcs.sparkSession)
    names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "record_id", "target_uri"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column(0).to_pylist():
                rows = []
                for _, raw in members(files.read_file(path)):
                    fields, block = parse_warc(raw)
                    kind = fields["WARC-Type"]
                    if kind == "warcinfo":
                        continue
                    if fields["WARC-Block-Digest"] != "sha256:" + hashlib.sha256(block).hexdigest():
                        raise ValueError(f"{path}: a block differs from its digest")
                    payload = block.partition(b"\r\n\r\n")[2] if kind != "resource" else block
                    digest = fields["WARC-Payload-Digest"].removeprefix("sha256:")
                    size = len(payload)
                    if kind == "revisit":
                        size = int(fields["DL-Payload-Bytes"])
                    elif hashlib.sha256(payload).hexdigest() != digest:
                        raise ValueError(f"{path}: a payload differs from its digest")
                    page, of = (None if fields.get(x) is None else unquote(fields[x]) for x in ("DL-Page-Id", "DL-Refers-To-Page-Id"))
                    rows.append((page, size, digest, kind, of, fields["WARC-Record-ID"], fields["WARC-Target-URI"]))
                cols = list(zip(*rows)) or [[]] * len(names)
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64() if k == "payload_bytes" else pa.string()) for k, c in zip(names, cols)], names=names)

    out = warcs.select("path").mapInArrow(run, "page_id string, payload_bytes long, payload_digest string, record_type string, refers_to string, record_id string, target_uri string")
    return out.withColumn("page_id", F.col("page_id").cast(page_type)).withColumn("refers_to", F.col("refers_to").cast(page_type))


def round_trip(spark: SparkSession, pages: DataFrame) -> DataFrame:
    """Pages to ARC files, those to WARC files, and these read back."""
    arcs, warcs = scratch(spark, "arc"), scratch(spark, "warc")
    index = checkpoint(write_arcs(pages, arcs))
    return read_warcs(convert(index, arcs, warcs), pages.schema["page_id"].dataType.simpleString())
