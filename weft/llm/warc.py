"""WARC archives with an index, and reads by coalesced byte ranges.

Writing makes one gzip member per record and an index row with its file, offset,
length, URL and digest. Reading takes index rows, any selection of them, sorts them
by file and offset, joins ranges that lie close together into one read and cuts the
records out of it. The archives lie in a folder that all executors share; they are
opened through pyarrow's file systems (local, shared mount, HDFS, object stores).
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weft.llm.common import kept
from weft.llm.exact import placed

FILE_BYTES = 1 << 30
LEVEL = 3
GAP_BYTES, READ_BYTES = 64 << 10, 8 << 20
OUT_BYTES = 16 << 20
TASK_BYTES, SMALL_BYTES = 128 << 20, 1 << 20
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "1970-01-01T00:00:00Z"
HTTP = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {}\r\n\r\n"

INDEX = "file string, offset long, length long, url string, digest string, record_type string"
RECORD = (
    "url string, record_type string, refers_to string, payload_bytes long, payload_digest string"
)


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(name: str, url: str | None, refers_to: str | None, payload: bytes, digest: str) -> bytes:
    """One record, a revisit if it refers to another. Its block has the HTTP headers
    of the full payload, which a revisit leaves out."""
    block = HTTP.format(len(payload)).encode() + (b"" if refers_to is not None else payload)
    head = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: <urn:x-page:{name}>",
        f"WARC-Date: {DATE}",
        f"WARC-Payload-Digest: sha1:{digest}",
    ]
    if url is not None:
        head.append("WARC-Target-URI: " + url.replace("\r", "%0D").replace("\n", "%0A"))
    if refers_to is not None:
        head += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: <urn:x-page:{refers_to}>"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse_record(data: bytes) -> tuple[dict[str, str], bytes]:
    """Headers (lower-case names) and block; raises if the record is not whole."""
    head, _, rest = data.partition(b"\r\n\r\n")
    version, *lines = head.decode().split("\r\n")
    headers = {k.lower(): v for k, v in (line.split(": ", 1) for line in lines)}
    size = int(headers["content-length"])
    if not version.startswith("WARC/") or rest[size:] != b"\r\n\r\n":
        raise ValueError("not a whole WARC record")
    return headers, rest[:size]


def _name(urn: str | None) -> str | None:
    return None if urn is None else urn.removeprefix("<urn:x-page:").removesuffix(">")


def write_warc(
    pages: DataFrame,
    folder: str,
    *,
    id: str = "page_id",
    url: str = "url",
    payload: str = "html",
    least_revisit: int = 0,
    file_bytes: int = FILE_BYTES,
) -> DataFrame:
    """Writes a record per row under ``folder`` and returns the written index: the id
    column, ``file``, ``offset``, ``length``, ``url``, ``digest``, ``record_type``.

    Of equal payloads of at least ``least_revisit`` bytes the row with the smallest
    id is the response (a null id is the largest; of rows with one id, one), the
    others are revisits of it. A null payload is empty, a null URL has no header.
    Repeated rows are records of their own; an empty table makes no file; other
    columns are left out. A task that runs again writes new files, and the index
    names only those of the attempt that counts.
    """
    body = F.coalesce(F.col(payload), F.lit(""))
    named = [F.col(id).alias("_id"), F.col(url).alias("_url"), body.alias("_body")]
    rows = placed(pages.select(*named))
    # A short payload is always a response: its key is its own place.
    digest, long = F.sha2(F.col("_body").cast("binary"), 256), F.octet_length("_body") >= least_revisit
    rows = rows.withColumn("_key", F.when(long, digest).otherwise(F.col("_place")))
    first = F.min(F.struct(F.col("_id").isNull().alias("_none"), "_id", "_place")).alias("_first")
    decided = rows.join(rows.groupBy("_key").agg(first), "_key")
    again = F.col("_first._place") != F.col("_place")
    refers = F.when(again, F.coalesce(F.col("_first._id").cast("string"), F.lit("null")))
    schema = T.StructType([pages.schema[id], *T.StructType.fromDDL(INDEX).fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, path = fs.FileSystem.from_uri(folder)
        stem = f"{path}/part-{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex}"
        out, file, number, at = None, "", 0, 0
        for batch in batches:
            lines = []
            for own, link, text, other in zip(*[c.to_pylist() for c in batch.columns]):
                if out is None or at >= file_bytes:
                    if out is None:
                        store.create_dir(path, recursive=True)
                    else:
                        out.close()
                    file, at = f"{stem}-{number}.warc.gz", 0
                    out, number = store.open_output_stream(file, compression=None), number + 1
                data = text.encode()
                digest = payload_digest(data)
                packer = zlib.compressobj(LEVEL, wbits=31)
                name = "null" if own is None else str(own)
                member = packer.compress(record(name, link, other, data, digest)) + packer.flush()
                out.write(member)
                kind = "response" if other is None else "revisit"
                lines.append((own, file, at, len(member), link, digest, kind))
                at += len(member)
            if lines:
                columns = [pa.array(c) for c in zip(*lines)]
                columns[0], columns[4] = batch.column(0), batch.column(1)
                yield pa.RecordBatch.from_arrays(columns, schema.names)
        if out is not None:
            out.close()

    records = decided.select("_id", "_url", "_body", refers.alias("_refers"))
    return kept(records.mapInArrow(run, schema), "warc-index")


def _ranges(batches: Iterator[pa.RecordBatch], gap: int, most: int):
    """Runs of index rows (file, offset, length) that one read covers."""
    run = []
    for batch in batches:
        for file, offset, length in zip(*[c.to_pylist() for c in batch.columns]):
            if run and not (
                file == run[0][0]
                and offset - run[-1][1] - run[-1][2] <= gap
                and offset + length - run[0][1] <= most
            ):
                yield run
                run = []
            run.append((file, offset, length))
    if run:
        yield run


def read_warc(
    index: DataFrame,
    folder: str,
    *,
    id: str = "page_id",
    gap: int = GAP_BYTES,
    most: int = READ_BYTES,
    task_bytes: int = TASK_BYTES,
    payloads: bool = True,
) -> DataFrame:
    """The records that ``index`` names: the id column, ``url``, ``record_type``,
    ``refers_to``, ``payload_bytes``, ``payload_digest`` and, on request, ``payload``.

    Ranges at most ``gap`` bytes apart are read together, up to ``most`` bytes, and a task
    reads about ``task_bytes`` (less if there would be fewer tasks than cores). The
    payload of a response is checked against its digest; a revisit has no payload of
    its own (null), and gives the size and digest of the full one. A row that is
    named twice comes twice; an empty index gives no rows.
    """
    own = index.schema[id].dataType
    schema = T.StructType.fromDDL(f"_name string, {RECORD}" + ", payload binary" * payloads)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store = fs.FileSystem.from_uri(folder)[0]
        rows, size, name, source = [], 0, None, None

        def batch():
            columns = zip(*rows)
            kinds = [pa.string()] * 4 + [pa.int64(), pa.string()] + [pa.binary()] * payloads
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], schema.names)

        for near in _ranges(batches, gap, most):
            if near[0][0] != name:
                if source is not None:
                    source.close()
                name, source = near[0][0], store.open_input_file(near[0][0])
            begin = near[0][1]
            data = source.read_at(near[-1][1] + near[-1][2] - begin, begin)
            for _, offset, length in near:
                part = zlib.decompress(memoryview(data)[offset - begin : offset - begin + length], wbits=31)
                headers, block = parse_record(part)
                http, _, payload = block.partition(b"\r\n\r\n")
                digest = headers["warc-payload-digest"].removeprefix("sha1:")
                kind, count = headers["warc-type"], int(http.rsplit(b": ", 1)[1])
                if kind == "response":
                    if payload_digest(payload) != digest or len(payload) != count:
                        raise ValueError(f"damaged record in {name} at {offset}")
                else:
                    payload = None
                row = (
                    _name(headers["warc-record-id"]),
                    headers.get("warc-target-uri"),
                    kind,
                    _name(headers.get("warc-refers-to")),
                    count,
                    digest,
                )
                rows.append((*row, payload) if payloads else row)
                size += 200 + (len(payload or b"") if payloads else 0)
                if size >= OUT_BYTES:
                    yield batch()
                    rows, size = [], 0
        if rows:
            yield batch()
        if source is not None:
            source.close()

    # Tasks by the bytes to read: left open, their number would follow the index's size.
    total = index.agg(F.sum("length")).first()[0] or 0
    cores = index.sparkSession.sparkContext.defaultParallelism
    tasks = max(1, -(-total // task_bytes), min(cores, total // SMALL_BYTES))
    order = ["file", "offset"]
    ranged = index.select("file", "offset", "length").repartitionByRange(tasks, *order).sortWithinPartitions(*order)
    read = ranged.mapInArrow(run, schema)
    key = F.when(F.col("_name") != "null", F.col("_name")).cast(own).alias(id)
    refers = F.when(F.col("refers_to") != "null", F.col("refers_to")).cast(own).alias("refers_to")
    return read.select(key, *[refers if c == "refers_to" else c for c in schema.names[1:]])
