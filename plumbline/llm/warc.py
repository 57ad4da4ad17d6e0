"""WARC archives as a chunked record table.

A record is a run of rows (record_id, chunk_no): row 0 holds the WARC header and the first CHUNK bytes of the payload,
oversized payloads go on in further rows of CHUNK bytes. Each row carries the SHA-1 of the payload up to its own end,
so a reader checks a record piece by piece and neither side builds a record in memory. The bytes of a record's rows,
in order, are the WARC record; the table is written and read by Spark, so it lives in any store that Spark reaches.

Records with equal payloads of at least `min_bytes` bytes are stored once, as a response; the others are revisits
that name it. Payloads are equal if their lengths and SHA-256 are; the SHA-1 of the headers, of which collisions are
known, doesn't decide. Grouping reads digests and lengths only; the payloads cross the network once.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ._spark import fresh, utf8, written

CHUNK = 1 << 18
ROWS = "record_id string, page_id long, chunk_no int, chunks int, data binary, payload_sha1 string"
READ = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, url string"
HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
END = b"\r\n\r\n"
NAMESPACE = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")  # RFC 4122: URLs


def base32_sha1(hexdigest: str) -> str:
    return base64.b32encode(bytes.fromhex(hexdigest)).decode()


def record_id(page_id: int | None, copy: int) -> str:
    return f"<urn:uuid:{uuid.uuid5(NAMESPACE, f'page/{page_id}/{copy}')}>"


def _header(kind: str, page_id: int | None, copy: int, url: str | None, sha1: str, payload: int, refers_to: int | None) -> bytes:
    length = len(HTTP) + payload if kind == "response" else 0
    lines = [
        "WARC/1.1",
        f"WARC-Type: {kind}",
        f"WARC-Record-ID: {record_id(page_id, copy)}",
        f"WARC-Target-URI: {' '.join((url or '').split()) or 'urn:unknown'}",
        "WARC-Date: 1970-01-01T00:00:00Z",
        f"WARC-Payload-Digest: sha1:{base32_sha1(sha1)}",
        f"X-Payload-Length: {payload}",
        f"X-Page-ID: {'' if page_id is None else page_id}",
        f"Content-Type: {'application/http; msgtype=response' if kind == 'response' else 'message/http'}",
        f"Content-Length: {length}",
    ]
    if kind == "revisit":
        lines[2:2] = ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
        lines += [f"WARC-Refers-To: {record_id(refers_to, 0)}", f"X-Refers-To-Page-ID: {refers_to}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n"


def _chunked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pages with their record's kind to rows of the table; holds about 8 MB of pieces at a time."""
    schema = pa.schema([("record_id", pa.string()), ("page_id", pa.int64()), ("chunk_no", pa.int32()), ("chunks", pa.int32()), ("data", pa.binary()), ("payload_sha1", pa.string())])
    rows: list[tuple] = []
    held = 0

    def flush() -> pa.RecordBatch:
        nonlocal rows, held
        out = pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)
        rows, held = [], 0
        return out

    for batch in batches:
        columns = [batch.column(c) for c in ("page_id", "copy", "url", "sha1", "bytes", "record_type", "refers_to", "payload")]
        for i in range(batch.num_rows):
            page_id, copy, url, sha1, size, kind, refers_to = (c[i].as_py() for c in columns[:-1])
            header = _header(kind, page_id, copy, url, sha1, size, refers_to)
            name = record_id(page_id, copy)
            n = max(1, -(-size // CHUNK)) if kind == "response" else 1
            digest = hashlib.sha1()
            view = memoryview(columns[-1][i].as_buffer() or b"") if kind == "response" else b""
            for k in range(n):
                piece = view[k * CHUNK : (k + 1) * CHUNK]
                digest.update(piece)
                lead = (header + HTTP if kind == "response" else header) if k == 0 else b""
                data = b"".join((lead, piece, END if k == n - 1 else b""))
                rows.append((name, page_id, k, n, data, digest.hexdigest()))
                held += len(data)
                if held > 8 << 20:
                    yield flush()
            if len(rows) >= 4000:
                yield flush()
    if rows:
        yield flush()


def _records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of the table, each record's rows one after another, to one row for each record; checks the digests on the way.

    A row that is missing, first, in the middle or last, stops the job.
    """
    schema = pa.schema([("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()), ("url", pa.string())])
    number = lambda text: int(text) if text else None
    head: dict[str, str] = {}
    digest, seen, left, at = hashlib.sha1(), 0, 0, None
    for batch in batches:
        out = []
        columns = [batch.column(c) for c in ("record_id", "chunk_no", "chunks", "payload_sha1", "data")]
        for i in range(batch.num_rows):
            name, k, n, sha1 = (c[i].as_py() for c in columns[:-1])
            data = memoryview(columns[-1][i].as_buffer())
            if left and name != at:
                raise ValueError(f"{at}: the last {left} rows are missing")
            if k == 0:
                if left:
                    raise ValueError(f"{name}: begins twice")
                at = name
                top = bytes(data).index(END)
                version, *lines = bytes(data[:top]).decode().split("\r\n")
                head = dict(line.split(": ", 1) if ": " in line else (line.rstrip(":"), "") for line in lines)
                if version != "WARC/1.1" or head["WARC-Record-ID"] != name:
                    raise ValueError(f"{name}: not the start of this record")
                digest, seen, left = hashlib.sha1(), 0, n
                data = data[top + len(END) + (len(HTTP) if head["WARC-Type"] == "response" else 0) :]
            if k != n - left or name != at:
                raise ValueError(f"{name}: row {k} of {n} is out of order")
            left -= 1
            piece = data[: len(data) - (len(END) if left == 0 else 0)]
            digest.update(piece)
            seen += len(piece)
            if digest.hexdigest() != sha1:
                raise ValueError(f"{name}: the digest fails at row {k}")
            if left == 0:
                revisit = head["WARC-Type"] == "revisit"
                found = head["WARC-Payload-Digest"].removeprefix("sha1:") if revisit else base32_sha1(digest.hexdigest())
                size = int(head["X-Payload-Length"]) if revisit else seen
                if found != head["WARC-Payload-Digest"].removeprefix("sha1:") or size != int(head["X-Payload-Length"]):
                    raise ValueError(f"{name}: the header names another payload")
                out.append((number(head["X-Page-ID"]), size, found, head["WARC-Type"], number(head.get("X-Refers-To-Page-ID", "")), head["WARC-Target-URI"]))
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*out, strict=True), schema, strict=True)], schema=schema)
    if left:
        raise ValueError(f"{at}: the last {left} rows are missing")


def write_records(pages: DataFrame, path: str | None = None, min_bytes: int = 0, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> str:
    """Writes a record for each row of pages; returns the path of the table.

    Null html counts as empty. Of rows with the same id and payload one is the response at most. A null id is larger
    than any other, and a revisit of it has no id to name. Extra columns aren't read.
    """
    spark = pages.sparkSession
    body = utf8(F.col(html_col))
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"), body.alias("payload"))
    keyed = rows.withColumn("sha1", F.sha1("payload")).withColumn("sha256", F.sha2("payload", 256)).withColumn("bytes", F.length("payload").cast("long"))
    ids = written(keyed.groupBy("page_id", "sha1", "sha256", "bytes").agg(F.count(F.lit(1)).alias("copies")), "ids")
    # written first, so a payload that very many pages have is a plain skewed join
    firsts = written(ids.groupBy("sha256", "bytes").agg(F.min("page_id").alias("first")), "firsts")
    kinds = ids.join(firsts, ["sha256", "bytes"]).select(F.col("page_id").alias("p"), F.col("sha256").alias("s"), "first", "copies")
    same = F.col("page_id").eqNullSafe(F.col("p")) & (F.col("sha256") == F.col("s"))
    own = (F.col("bytes") < min_bytes) | (F.col("page_id").eqNullSafe(F.col("first")) & (F.col("copy") == 0))
    columns = ["page_id", "copy", "url", "sha1", "bytes", F.when(own, "response").otherwise("revisit").alias("record_type"), F.when(~own, F.col("first")).alias("refers_to"), F.when(own, F.col("payload")).alias("payload")]
    full = keyed.join(kinds, same).where("copies = 1").withColumn("copy", F.lit(0)).select(*columns)
    if ids.where("copies > 1").limit(1).count():
        # rows that repeat are counted by url and numbered without their payloads, which only responses get back
        repeated = kinds.where("copies > 1")
        urls = keyed.drop("payload").join(repeated, same).groupBy("page_id", "sha1", "sha256", "bytes", "url", "first").agg(F.count(F.lit(1)).alias("n"))
        before = F.sum("n").over(Window.partitionBy("page_id", "sha256").orderBy("url")) - F.col("n")
        each = urls.withColumn("before", before).withColumn("copy", F.explode(F.expr("sequence(cast(before as int), cast(before + n - 1 as int))")))
        payloads = keyed.join(repeated, same, "left_semi").groupBy(F.col("page_id").alias("p"), F.col("sha256").alias("s")).agg(F.first("payload").alias("payload"))
        full = full.unionByName(each.where(own).join(payloads, same).select(*columns)).unionByName(each.where(~own).withColumn("payload", F.lit(None).cast("binary")).select(*columns))
    path = path or fresh(spark, "warc")
    full.mapInArrow(_chunked, ROWS).write.parquet(path)
    return path


def read_records(spark, path: str) -> DataFrame:
    """One row for each record: page_id, payload_bytes, payload_digest, record_type, refers_to, url.

    Records of one row are read where they lie; only the rows of longer ones are brought together, by record, and
    sorted by chunk.
    """
    chunks = spark.read.schema(ROWS).parquet(path).drop("page_id")
    long = chunks.where("chunks > 1").repartition("record_id").sortWithinPartitions("record_id", "chunk_no")
    return chunks.where("chunks = 1").mapInArrow(_records, READ).unionByName(long.mapInArrow(_records, READ))
