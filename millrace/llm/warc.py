"""WARC archives of web captures: writing with revisits, and reading by transaction assembly.

A capture is three records: a request and a metadata record that name the capture's main record
in WARC-Concurrent-To, and the main record itself, a response with its payload or a revisit
that names in WARC-Refers-To the response that holds an equal payload. Records are gzip members
of their own, as the format wants. Reading streams every archive, brings the records of a
capture together through their concurrent-to identifiers, and emits one nested row per capture.

Keys and URLs are written percent-encoded where they hold white space, control characters or a
percent sign, so keys come back as they were, empty ones and line ends included.

Defined results: a null payload is an empty one; a null URL leaves the field out; payloads below
``min_revisit`` bytes are stored every time; of rows with one key and equal payloads that of the
smallest URL (null last) is the response, of rows equal in all three any one, and every row is a
capture of its own; a null key sorts last. Very long payloads are one record each and held one at a
time. An archive of no rows has no file and reads as no rows. Other columns are not read, whatever
their names.
"""

from __future__ import annotations

import gzip
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.shared_files import open_for_read, open_for_write, stored
from millrace.session import scratch_path

FILE_BYTES = 64 << 20
PIECE = 10_000  # equal rows that one task numbers at a time
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_RECORDS = "capture string, id string, kind string, refers_to string, uri string, payload_bytes long, payload_digest string, head string, body binary"


def _record(kind: str, name: str, fields: list[tuple[str, str | None]], block: bytes) -> bytes:
    head = [("WARC-Type", kind), ("WARC-Record-ID", name), *fields, ("Content-Length", str(len(block)))]
    text = "".join(f"{k}: {v}\r\n" for k, v in head if v is not None)
    out = zlib.compressobj(6, zlib.DEFLATED, 31)
    return out.compress(f"WARC/1.1\r\n{text}\r\n".encode() + block + b"\r\n\r\n") + out.flush()


def record_id(kind: str, *parts) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_OID, ' '.join(map(str, (kind, *parts))))}>"


def _field(value: str) -> str:
    """``value`` for one line of a header: blanks, control characters and % as %XX of their UTF-8."""
    return re.sub(r"[\s\x00-\x20\x7f-\x9f%]", lambda c: "".join(f"%{b:02X}" for b in c[0].encode()), value)


def _capture(place: str, key: str | None, url: str | None, payload: bytes, digest: str, kind: str, size: int, date: str) -> bytes:
    """The records of one capture; ``kind`` is first, if others revisit it, again, or only.
    ``place`` tells the captures of one writing apart."""
    uri = None if url is None else re.sub(r"[\s\x00-\x20\x7f-\x9f]", lambda c: _field(c[0]), url)
    first = record_id("payload", digest)  # so that those who revisit it know its name
    own = first if kind == "first" else record_id("main", place, digest)
    common = [("WARC-Date", date), ("WARC-Target-URI", uri)]
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    main = [*common, ("WARC-Payload-Digest", f"sha256:{digest}"), ("Content-Type", "application/http;msgtype=response")]
    if kind != "again":
        out = _record("response", own, main, http + payload)
    else:
        out = _record("revisit", own, [*main, ("WARC-Profile", PROFILE), ("WARC-Refers-To", first)], http)
    tied = [*common, ("WARC-Concurrent-To", own)]
    request = f"GET {uri or '/'} HTTP/1.1\r\n\r\n".encode()
    out += _record("request", record_id("request", own), [*tied, ("Content-Type", "application/http;msgtype=request")], request)
    about = "" if key is None else f"key: {_field(key)}\r\n"
    return out + _record("metadata", record_id("metadata", own), [*tied, ("Content-Type", "application/warc-fields")], about.encode())


def marked(pages: DataFrame, key: str, url: str, payload: str, min_revisit: int) -> tuple[DataFrame, DataFrame]:
    """digest, first (key, url and n, the number of rows equal to it) of every payload that several
    captures have, stored; and key, url, body, digest, first and size of every row."""
    body = F.coalesce(F.col(payload).cast("string"), F.lit("")).cast("binary")
    rows = pages.select(F.col(key).alias("key"), F.col(url).cast("string").alias("url"), body.alias("body")).withColumn("digest", F.sha2("body", 256))
    alike = rows.where(F.octet_length("body") >= min_revisit).groupBy("digest", "key", "url").agg(F.count("*").alias("n"))
    first = F.min(F.struct(F.isnull("key").alias("no_key"), "key", F.isnull("url").alias("no_url"), "url", "n")).alias("first")
    firsts = alike.groupBy("digest").agg(first, F.sum("n").alias("copies")).where("copies > 1").select("digest", "first")
    firsts = stored(firsts, "warc-firsts")
    return firsts, rows.join(firsts, "digest", "left").withColumn("size", F.octet_length("body").cast("long"))


def write_archives(
    pages: DataFrame,
    folder: str,
    key: str = "page_id",
    url: str = "url",
    payload: str = "html",
    min_revisit: int = 100,
    date: str = "2000-01-01T00:00:00Z",
    file_bytes: int = FILE_BYTES,
) -> DataFrame:
    """Writes .warc.gz files of about ``file_bytes`` below ``folder``; one row per file.

    Payloads are shuffled once, by digest. Which capture of a digest is first is decided by content
    alone (key, then URL) and stored, so a digest with a third of all rows is split by the join.
    Rows equal in key, URL and payload to the first one are counted, and written from the count.
    """
    firsts, joined = marked(pages, key, url, payload, min_revisit)
    own = F.col("key").eqNullSafe(F.col("first.key")) & F.col("url").eqNullSafe(F.col("first.url"))
    out = ["key", "url", "digest", "kind", "body", "size"]
    kind = F.when(F.col("first").isNull(), "only").when(own, "first").otherwise("again")
    plan = joined.withColumn("kind", kind).withColumn("body", F.when(F.col("kind") != "again", F.col("body")))
    if not firsts.where("first.n > 1").isEmpty():
        # grouped by a struct, which the join's layout does not serve: equal rows are combined before they are shuffled
        equal = joined.where(own & (F.col("first.n") > 1)).groupBy(F.struct("key", "url", "digest").alias("same"))
        equal = equal.agg(F.first("body").alias("body"), F.count("*").alias("n"), F.first("size").alias("size"))
        pieces = equal.select("same.*", "body", "n", "size")
        pieces = pieces.withColumn("low", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1, F.lit(PIECE).cast("long"))))
        pieces = pieces.withColumn("body", F.when(F.col("low") == 0, F.col("body"))).repartition("digest", "key", "url", "low")
        copies = pieces.withColumn("copy", F.explode(F.sequence(F.col("low"), F.least(F.col("low") + PIECE, "n") - 1)))
        copies = copies.withColumn("kind", F.when(F.col("copy") == 0, "first").otherwise("again"))
        copies = copies.withColumn("body", F.when(F.col("copy") == 0, F.col("body")))
        plan = plan.where("kind <> 'first' OR first.n = 1").select(out).unionByName(copies.select(out))
    plan = plan.select(out).withColumn("key", F.col("key").cast("string"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        path, out, size, count, row = None, None, 0, 0, 0
        part = TaskContext.get().partitionId()
        for batch in batches:
            for r in batch.to_pylist():
                row += 1
                if out is None:
                    (path, out), size, count = open_for_write(folder, ".warc.gz"), 0, 0
                data = _capture(f"{part} {row}", r["key"], r["url"], r["body"] or b"", r["digest"], r["kind"], r["size"], date)
                out.write(data)
                size, count = size + len(data), count + 1
                if size >= file_bytes:
                    out.close()
                    yield pa.RecordBatch.from_pylist([{"path": path, "captures": count, "bytes": size}])
                    out = None
        if out is not None:
            out.close()
            yield pa.RecordBatch.from_pylist([{"path": path, "captures": count, "bytes": size}])

    return stored(plan.mapInArrow(run, "path string, captures long, bytes long"), "warc-files")


def _parse(path: str) -> Iterator[dict]:
    """The records of one archive, in file order."""
    with open_for_read(path) as raw, gzip.GzipFile(fileobj=raw) as file:
        while line := file.readline():
            if not line.startswith(b"WARC/"):
                raise ValueError(f"{path}: a record begins with {line[:40]!r}")
            head = {}
            while (line := file.readline().strip()) != b"":
                name, _, value = line.decode().partition(":")
                head[name.strip().lower()] = value.strip()
            block = file.read(int(head["content-length"]))
            if len(block) != int(head["content-length"]) or file.read(4) != b"\r\n\r\n":
                raise ValueError(f"{path}: record {head.get('warc-record-id')} is cut short")
            kind, own = head["warc-type"], head["warc-record-id"]
            out = {
                "capture": head.get("warc-concurrent-to", own), "id": own, "kind": kind, "refers_to": head.get("warc-refers-to"), "uri": head.get("warc-target-uri"),
                "payload_bytes": None, "payload_digest": head.get("warc-payload-digest", "").removeprefix("sha256:") or None, "head": None, "body": block,
            }
            if "application/http" in head.get("content-type", ""):
                http, _, body = block.partition(b"\r\n\r\n")
                out |= {"head": http.decode("utf-8", "replace"), "body": body}
            if kind == "response":
                digest = hashlib.sha256(out["body"]).hexdigest()
                if out["payload_digest"] not in (None, digest):
                    raise ValueError(f"{path}: the payload of {own} does not have its digest")
                out |= {"payload_bytes": len(out["body"]), "payload_digest": digest}
            yield out


def read_records(files: DataFrame, payloads: bool = True) -> DataFrame:
    """All records of the archives named in column ``path``; without ``payloads``, responses
    keep only the length and digest of theirs, taken from the bytes read."""
    schema = pa.schema([(n, {"long": pa.int64(), "binary": pa.binary()}.get(t, pa.string())) for n, t in (x.split() for x in _RECORDS.split(", "))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column(0).to_pylist():
                rows, size = [], 0
                for r in _parse(path):
                    if r["kind"] == "response" and not payloads:
                        r["body"] = None
                    rows.append(r)
                    size += len(r["body"] or b"") + 500
                    if size >= 4 << 20:
                        yield pa.RecordBatch.from_pylist(rows, schema)
                        rows, size = [], 0
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema)

    spread = files.select("path").repartition(files.sparkSession.sparkContext.defaultParallelism)
    return spread.mapInArrow(run, _RECORDS)


def noted_key(about: Column) -> Column:
    """The key that a metadata record notes; null if it notes none."""
    line = r"^key: ([^\r\n]*)"
    value = F.regexp_extract(about, line, 1)
    plain = F.try_url_decode(F.replace(value, F.lit("+"), F.lit("%2B")))  # a plus sign is itself here
    return F.when(about.rlike(line), F.coalesce(plain, value))


def assemble(records: DataFrame) -> DataFrame:
    """One nested row per capture: id, main (the response or revisit), requests, metadata, and
    original (id, key, payload length of the response that a revisit refers to).

    The records of a capture are a handful, so grouping by identifier has no large group; a
    response that many captures revisit is the copied side of the last join.
    """
    main = F.col("kind").isin("response", "revisit", "resource")
    part = F.struct("id", "kind", "refers_to", "uri", "payload_bytes", "payload_digest", "head", "body")
    rows = records.groupBy("capture").agg(
        F.first(F.when(main, part), ignorenulls=True).alias("main"),
        F.collect_list(F.when(F.col("kind") == "request", F.struct("id", "head"))).alias("requests"),
        F.collect_list(F.when(F.col("kind") == "metadata", F.struct("id", "body"))).alias("metadata"),
    )
    rows = rows.where("main IS NOT NULL").withColumn("key", noted_key(F.col("metadata")[0]["body"].cast("string")))
    responses = rows.where("main.kind = 'response'").select(
        F.struct(F.col("main.id"), "key", F.col("main.payload_bytes"), F.col("main.payload_digest")).alias("original")
    )
    return rows.join(responses, F.col("main.refers_to") == F.col("original.id"), "left")


def archive_round_trip(pages: DataFrame, **options) -> DataFrame:
    """Writes ``pages`` to archives in the shared folder and returns the captures read back."""
    spark: SparkSession = pages.sparkSession
    files = write_archives(pages, scratch_path(spark, "warc"), **options)
    return assemble(read_records(files, payloads=False))
