"""WARC records of web pages in ZIP packages: writing, and reading back by ranges.

A package holds ``archive/data.warc.gz`` (stored, every record a gzip member of its own) and
``indexes/index.cdxj`` (stored, a line with offset and length per record). Tasks write packages of a
bounded size under new names into a shared folder; a list of finished packages is what counts, so
a repeated task leaves a file that nobody reads. The reader parses the central directory, finds
both members, and reads runs of records by range.

Pages with equal payloads of at least ``min_bytes`` bytes: the smallest page_id is the response, the
others revisit it. A null html is an empty payload, a null url is left out. A page without id can
only revisit; without another page to refer to it is a response. Repeated rows of the smallest
page_id are all responses. Folders are opened with pyarrow's file systems, by the URI's scheme.
"""

import gzip
import hashlib
import json
import uuid
import zipfile
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from saleslake.llm import zip_archive

MIN_BYTES = 100
PACKAGE_BYTES = 64_000_000
RANGE_BYTES = 4_000_000
DATA = "archive/data.warc.gz"
INDEX = "indexes/index.cdxj"
PACKAGES = T.StructType().add("path", T.StringType()).add("n_records", T.LongType())
RECORDS = (
    T.StructType()
    .add("page_id", T.LongType())
    .add("url", T.StringType())
    .add("record_type", T.StringType())
    .add("refers_to", T.LongType())
    .add("payload_bytes", T.LongType())
    .add("payload_digest", T.StringType())
)


def classify(pages: DataFrame, min_bytes: int = MIN_BYTES) -> DataFrame:
    """page_id, url, payload, digest and refers_to. Only digests that occur twice are joined back."""
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    rows = pages.select("page_id", "url", payload.alias("payload"), F.sha2(payload, 256).alias("digest"))
    size = F.octet_length("payload")
    groups = rows.where(size >= min_bytes).groupBy("digest")
    first = groups.agg(F.min("page_id").alias("first_id"), F.count(F.lit(1)).alias("n"))
    joined = rows.join(first.where("n > 1").drop("n"), "digest", "left")
    refers = F.when(~F.col("page_id").eqNullSafe(F.col("first_id")), F.col("first_id"))
    return joined.select("page_id", "url", "payload", "digest", refers.alias("refers_to"))


def record(page_id, url, payload: bytes, digest: str, refers_to) -> bytes:
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n"
    block = http.encode() + (payload if refers_to is None else b"")
    lines = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}"]
    name = f"urn:page:{page_id}" if page_id is not None else f"urn:uuid:{uuid.uuid4()}"
    lines.append(f"WARC-Record-ID: <{name}>")
    if url is not None:
        lines.append("WARC-Target-URI: " + json.dumps(url))
    lines.append("WARC-Date: 1970-01-01T00:00:00Z")
    lines.append(f"WARC-Payload-Digest: sha256:{digest}")
    if refers_to is not None:
        lines.append("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
        lines.append(f"WARC-Refers-To: <urn:page:{refers_to}>")
    lines.append("Content-Type: application/http;msgtype=response")
    lines.append(f"Content-Length: {len(block)}")
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def write_packages(records: DataFrame, folder: str, package_bytes: int = PACKAGE_BYTES) -> DataFrame:
    """Write classified pages; the result lists the packages and must be stored before it is used."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = pyarrow.fs.FileSystem.from_uri(folder)
        rows = (row for batch in batches for row in batch.to_pylist())
        row = next(rows, None)
        while row is not None:
            name = f"{uuid.uuid4().hex}.wacz"
            index, at = [], 0
            with (
                system.open_output_stream(f"{root}/{name}") as out,
                zipfile.ZipFile(out, "w", zipfile.ZIP_STORED) as package,
            ):
                with package.open(DATA, "w", force_zip64=True) as data:
                    while row is not None and at < package_bytes:
                        packed = gzip.compress(record(**row), 1, mtime=0)
                        data.write(packed)
                        index.append(json.dumps({"page": row["page_id"], "offset": at, "length": len(packed)}))
                        at += len(packed)
                        row = next(rows, None)
                package.writestr(INDEX, "\n".join(index))
            listed = [pa.array([f"{folder}/{name}"]), pa.array([len(index)], pa.int64())]
            yield pa.RecordBatch.from_arrays(listed, names=PACKAGES.names)

    columns = records.select("page_id", "url", "payload", "digest", "refers_to")
    return columns.mapInArrow(run, PACKAGES)


def parse_record(raw: bytes) -> dict:
    head, _, rest = raw.partition(b"\r\n\r\n")
    version, *lines = head.decode().split("\r\n")
    if not version.startswith("WARC/"):
        raise zip_archive.BadArchive("no WARC record")
    fields = dict(line.split(": ", 1) for line in lines)
    block = rest[: int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    length = next(x for x in http.decode().split("\r\n") if x.startswith("Content-Length: "))
    digest = fields["WARC-Payload-Digest"].removeprefix("sha256:")
    page = fields["WARC-Record-ID"].strip("<>")
    revisit = fields["WARC-Type"] == "revisit"
    if not revisit and hashlib.sha256(payload).hexdigest() != digest:
        raise zip_archive.BadArchive(f"{page}: the payload doesn't have its digest")
    return {
        "page_id": int(page.removeprefix("urn:page:")) if page.startswith("urn:page:") else None,
        "url": json.loads(fields["WARC-Target-URI"]) if "WARC-Target-URI" in fields else None,
        "record_type": fields["WARC-Type"],
        "refers_to": int(fields["WARC-Refers-To"].strip("<>").removeprefix("urn:page:")) if revisit else None,
        "payload_bytes": int(length.removeprefix("Content-Length: ")),
        "payload_digest": digest,
        "payload": None if revisit else payload,
    }


def records_of(path: str) -> Iterator[dict]:
    """All records of a package, in the order of its index."""
    system, local = pyarrow.fs.FileSystem.from_uri(path)
    with system.open_input_file(local) as file:

        def read_at(offset: int, length: int) -> bytes:
            return file.read_at(length, offset)

        members = zip_archive.directory(read_at, file.size())
        index_at = zip_archive.data_offset(read_at, members[INDEX])
        data_at = zip_archive.data_offset(read_at, members[DATA])
        text = read_at(index_at, members[INDEX].size).decode()
        entries = [json.loads(line) for line in text.split("\n") if line]
        first = 0
        while first < len(entries):
            start, last = entries[first]["offset"], first
            while last < len(entries) and entries[last]["offset"] - start < RANGE_BYTES:
                last += 1
            end = entries[last - 1]["offset"] + entries[last - 1]["length"]
            chunk = read_at(data_at + start, end - start)
            for e in entries[first:last]:
                at = e["offset"] - start
                yield parse_record(gzip.decompress(chunk[at : at + e["length"]]))
            first = last


def read_packages(packages: DataFrame, payloads: bool = True) -> DataFrame:
    """One row per record; a package is the unit of a task."""
    schema = T.StructType([*RECORDS.fields, *[T.StructField("payload", T.BinaryType())] * payloads])
    kinds = {T.LongType(): pa.int64(), T.StringType(): pa.string(), T.BinaryType(): pa.binary()}
    arrow = pa.schema([(f.name, kinds[f.dataType]) for f in schema])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column("path").to_pylist():
                rows, size = [], 0
                for r in records_of(path):
                    rows.append({name: r[name] for name in arrow.names})
                    size += r["payload_bytes"] if payloads else 100
                    if size > RANGE_BYTES:
                        yield pa.RecordBatch.from_pylist(rows, arrow)
                        rows, size = [], 0
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, arrow)

    tasks = max(1, min(packages.count(), 20_000))
    return packages.select("path").repartition(tasks).mapInArrow(run, schema)
