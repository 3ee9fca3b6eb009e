"""WARC archives with an index written first (operator 4).

Each task writes archives of gzip members, a record each, and returns an index row for each record: file, offset, length,
URL, digest. An archive is closed at a gigabyte or 131,072 records. Only index rows of tasks that ended count, so what a lost
executor began is never read. Reading takes the wanted
index rows, sorts them by file and offset, joins neighbouring byte ranges into one read, and cuts the records out of it.

Defined results: a null html is an empty payload; a null URL is written as an empty one; payloads under `least_bytes` are
always responses; of equal ids (repeated rows) all are written, and with equal payloads all with the largest id are
responses; an empty table gives no rows; further columns are not looked at.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sheaf.llm.common import partitions, prepare, shared_folder, table, to_batch

INDEX = pa.schema([("file", pa.string()), ("offset", pa.int64()), ("length", pa.int64()), ("url", pa.string()), ("digest", pa.string()), ("page_id", pa.int64())])
INDEX_DDL = "file string, offset long, length long, url string, digest string, page_id long"
RECORD = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("payload", pa.binary()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("refers_to", pa.int64())])
RECORD_DDL = "page_id long, url string, record_type string, payload binary, payload_bytes long, payload_digest string, refers_to long"
EPOCH = "1970-01-01T00:00:00Z"


def digest_of(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_bytes(page_id: int | None, url: str, payload: bytes, digest: str, refers_to: int | None, date: str = EPOCH) -> bytes:
    """One WARC 1.1 resource of kind response (with its payload) or revisit (without)."""
    fields = [
        ("WARC-Type", "response" if refers_to is None else "revisit"),
        ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page_id}/{digest}')}>"),
        ("WARC-Date", date),
        ("WARC-Target-URI", "".join(c for c in url if c not in "\r\n")),
        ("WARC-Payload-Digest", f"sha1:{digest}"),
        ("X-Payload-Length", str(len(payload))),
        ("X-Page-ID", "" if page_id is None else str(page_id)),
    ]
    if refers_to is not None:
        fields += [("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"), ("X-Refers-To-Page-ID", str(refers_to))]
        payload = b""
    fields += [("Content-Type", "text/html; charset=utf-8"), ("Content-Length", str(len(payload)))]
    return b"WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields).encode() + b"\r\n" + payload + b"\r\n\r\n"


def parse_record(raw: bytes) -> tuple[dict[str, str], bytes]:
    head, _, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if lines[0] != "WARC/1.1":
        raise ValueError(f"no WARC record: {lines[0][:40]!r}")
    fields = dict(x.split(": ", 1) for x in lines[1:])
    payload = rest[: int(fields["Content-Length"])]
    if rest[len(payload) :] != b"\r\n\r\n":
        raise ValueError("a record's length is wrong")
    return fields, payload


ROLL_BYTES, ROLL_RECORDS = 1 << 30, 1 << 17  # an archive is closed at the first that it reaches


def _writer(folder: str, roll_bytes: int, roll_records: int):
    """Writes a task's archives. The index rows of one go out when it is closed, so a task holds those of one archive only."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        store, base = fs.FileSystem.from_uri(folder)
        task = f"{TaskContext.get().partitionId():06d}-{TaskContext.get().taskAttemptId()}"
        out, at, name, archives = None, 0, "", 0
        rows: dict[str, list] = {c: [] for c in INDEX.names}
        for b in batches:
            for page_id, url, html, refers_to in zip(*(b.column(k).to_pylist() for k in range(4)), strict=True):
                payload = (html or "").encode("utf-8", "surrogatepass")
                digest = digest_of(payload)
                raw = gzip.compress(record_bytes(page_id, url or "", payload, digest, refers_to), 4, mtime=0)
                if out is None:
                    store.create_dir(base, recursive=True)
                    name, at, archives = f"{base}/{task}-{archives:04d}.warc.gz", 0, archives + 1
                    out = store.open_output_stream(name, compression=None)  # the members are compressed already
                out.write(raw)
                for c, v in zip(INDEX.names, (name, at, len(raw), url, digest, page_id), strict=True):
                    rows[c].append(v)
                at += len(raw)
                if at >= roll_bytes or len(rows["file"]) >= roll_records:
                    out.close()
                    yield to_batch(rows, INDEX)
                    out, rows = None, {c: [] for c in INDEX.names}
        if out is not None:
            out.close()
            yield to_batch(rows, INDEX)

    return write


def write_warc(pages: DataFrame, folder: str, least_bytes: int = 0, roll_bytes: int = ROLL_BYTES, roll_records: int = ROLL_RECORDS) -> DataFrame:
    """Writes a record for each page and returns the index, itself written to the folder. Copies of a payload are revisits of the page with the largest id."""
    prepare(pages.sparkSession)
    html = F.coalesce("html", F.lit(""))
    pages = pages.select("page_id", "url", "html", F.sha1(html.cast("binary")).alias("_key"), (F.octet_length(html) >= least_bytes).alias("_large"))
    # Of payloads that come once nothing is joined; the groups are combined before the shuffle.
    groups = pages.where("_large").groupBy("_key").agg(F.max("page_id").alias("_first"), F.count("*").alias("_n")).where("_n > 1").select("_key", "_first")
    first = pages.join(groups, "_key", "left")
    refers_to = F.when(F.col("_large") & (F.col("_first") != F.coalesce("page_id", F.lit(-(2**63)))), F.col("_first"))
    index = first.select("page_id", "url", "html", refers_to.alias("refers_to")).mapInArrow(_writer(folder, roll_bytes, roll_records), INDEX_DDL)
    index.write.parquet(f"{folder}/index")
    return pages.sparkSession.read.schema(INDEX_DDL).parquet(f"{folder}/index")


def _reader(folder: str, gap: int, most: int):
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        store, _ = fs.FileSystem.from_uri(folder)
        for b in batches:
            wanted = sorted(zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).to_pylist(), strict=True))
            runs: list[list] = []
            for file, offset, length in wanted:
                if runs and runs[-1][0] == file and offset - runs[-1][2] <= gap and offset + length - runs[-1][1] <= most:
                    runs[-1][2] = max(runs[-1][2], offset + length)
                    runs[-1][3].append((offset, length))
                else:
                    runs.append([file, offset, offset + length, [(offset, length)]])
            for file, begin, end, members in runs:
                rows: dict[str, list] = {c: [] for c in RECORD.names}
                with store.open_input_file(file) as f:
                    f.seek(begin)
                    raw = f.read(end - begin)
                for offset, length in members:
                    fields, payload = parse_record(gzip.decompress(raw[offset - begin : offset - begin + length]))
                    kind = fields["WARC-Type"]
                    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
                    if kind == "response" and (digest_of(payload) != digest or len(payload) != int(fields["X-Payload-Length"])):
                        raise ValueError(f"{file} at {offset}: the payload isn't what was written")
                    page, ref = fields["X-Page-ID"], fields.get("X-Refers-To-Page-ID")
                    for c, v in zip(RECORD.names, (int(page) if page else None, fields["WARC-Target-URI"], kind, payload if kind == "response" else None, int(fields["X-Payload-Length"]), digest, int(ref) if ref else None), strict=True):
                        rows[c].append(v)
                yield to_batch(rows, RECORD)

    return read


def read_warc(index: DataFrame, folder: str, gap: int = 1 << 16, most: int = 1 << 22) -> DataFrame:
    """The records of the given index rows. Ranges at most `gap` bytes apart are read at once, up to `most` bytes."""
    spark = prepare(index.sparkSession)
    wanted = index.select("file", "offset", "length").repartitionByRange(partitions(spark), "file", "offset").sortWithinPartitions("file", "offset")
    return wanted.mapInArrow(_reader(folder, gap, most), RECORD_DDL)


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = shared_folder(spark, "warc")
    index = write_warc(table(spark, sf_dir, "pages"), folder)
    return read_warc(index, folder).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
