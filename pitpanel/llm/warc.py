"""A deterministic sharded WARC writer, and its reader.

Two passes over the pages. The first compresses every record and keeps only (key, url, digest, sizes);
from these follow which of equal payloads is the response, what each record takes as it will be written, and, by a
running sum of that in order of key, url and digest, in which file a record stands: boundaries are fixed by the
data alone, however Spark deals out the rows. The second sends each record to its file's task,
sorted, with the revisit notes (small rows) just before the records they speak of. A task streams a
file under a temporary name and moves it to its final one; the manifest names the files that count.
"""

from __future__ import annotations

import base64
import bisect
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import files
from .common import new_path, numbered, partitions, slices, written

LEVEL = 3
DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def sha1(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def record_id(key: int | None, url: str | None, digest: str, number: int) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{key}/{number}/{digest}/{url}')}>"


def target(url: str | None) -> str:
    return "".join(c if c > " " and c != "\x7f" else "%%%02X" % ord(c) for c in url or "urn:none")


def record(key: int | None, url: str | None, payload: bytes | None, digest: str, size: int, chief: tuple[int, str | None] | None = None, number: int = 0, date: str = DATE) -> bytes:
    """One WARC record: a response, or, with a ``chief`` (key, url), a revisit without the payload. All headers follow from the arguments.

    ``number`` counts rows of equal key, url and payload.
    """
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    block = head if chief else head + payload
    fields = [
        "WARC/1.1", f"WARC-Type: {'revisit' if chief else 'response'}", f"WARC-Record-ID: {record_id(key, url, digest, number)}", f"WARC-Date: {date}", f"WARC-Target-URI: {target(url)}",
        f"WARC-Payload-Digest: sha1:{base64.b32encode(bytes.fromhex(digest)).decode()}", f"WARC-Block-Digest: {sha1(block)}", f"X-Payload-Length: {size}", f"X-Page-Id: {'' if key is None else key}",
    ]
    if chief:
        fields += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {record_id(*chief, digest, 0)}", f"WARC-Refers-To-Target-URI: {target(chief[1])}", f"WARC-Refers-To-Date: {date}", "WARC-Truncated: length", f"X-Refers-To-Page-Id: {chief[0]}"]
    return "\r\n".join([*fields, "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}", "", ""]).encode() + block + b"\r\n\r\n"


def opening(name: str, date: str = DATE) -> bytes:
    """The warcinfo record that begins a file."""
    block = b"software: pitpanel\r\nformat: WARC File Format 1.1\r\n"
    fields = ["WARC/1.1", "WARC-Type: warcinfo", f"WARC-Record-ID: <urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, name)}>", f"WARC-Date: {date}", f"WARC-Filename: {name}", f"WARC-Block-Digest: {sha1(block)}", "Content-Type: application/warc-fields", f"Content-Length: {len(block)}", "", ""]
    return "\r\n".join(fields).encode() + block + b"\r\n\r\n"


def member(data: bytes) -> bytes:
    """A gzip member with no time and no name in it."""
    z = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
    return z.compress(data) + z.flush()


def measured(pages: DataFrame) -> DataFrame:
    """(key, url, digest, bytes, packed): each page's payload digest, length and its response's compressed size."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi in slices(batch.column("html"), 4 << 20):
                part = batch.slice(lo, hi - lo)
                out = [[], [], []]
                for key, url, html in zip(*(part.column(c).to_pylist() for c in ("key", "url", "html")), strict=True):
                    payload = (html or "").encode()
                    digest = hashlib.sha1(payload).hexdigest()
                    for column, v in zip(out, (digest, len(payload), len(member(record(key, url, payload, digest, len(payload))))), strict=True):
                        column.append(v)
                yield pa.RecordBatch.from_arrays([part.column("key"), part.column("url"), pa.array(out[0], pa.string()), *(pa.array(c, pa.int64()) for c in out[1:])], names=["key", "url", "digest", "bytes", "packed"])

    return pages.mapInArrow(run, "key long, url string, digest string, bytes long, packed long")


def sized(marked: DataFrame) -> DataFrame:
    """``marked`` with ``total``: what the rows of a key, url and digest take as they are written."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            totals = []
            for key, url, digest, size, packed, copies, chief, chief_url, lead in zip(*(batch.column(c).to_pylist() for c in ("key", "url", "digest", "bytes", "packed", "copies", "chief", "chief_url", "lead")), strict=True):
                again = len(member(record(key, url, None, digest, size, (chief, chief_url)))) if chief is not None else packed
                totals.append((packed if chief is None or lead else again) + (copies - 1) * again)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(totals, pa.int64())], names=[*batch.schema.names, "total"])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in marked.schema.fields)
    return marked.mapInArrow(run, f"{fields}, total long")


def write(pages: DataFrame, folder: str, roll_mb: float = 16, least: int = 1000, runs: int = 20_000, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Writes the archives and returns the manifest (file, path, records, bytes, first, last), a table in the shared folder.

    Of equal payloads of at least ``least`` bytes the largest key (of its repeated rows the one with the largest url) is
    the response and the others revisit it; smaller payloads are all responses. A null html is an
    empty payload. Null keys stand first and revisit like others, unless no equal payload has a key. A file ends
    where ``roll_mb`` of records as written are reached; rows that are equal in key, url and html count together and stand in one
    file. A page of any length is one record. Only the three columns named are read. An empty table gives no file. Tasks write ``runs``
    runs of files at most.
    """
    spark = pages.sparkSession
    rows = pages.select(F.col(id_col).cast("long").alias("key"), F.col(url_col).alias("url"), F.col(html_col).alias("html"))
    kinds = written(measured(rows), "measured").groupBy("key", "url", "digest").agg(F.max("bytes").alias("bytes"), F.max("packed").alias("packed"), F.count(F.lit(1)).alias("copies"))
    kinds = written(kinds, "kinds")
    chiefs = kinds.where((F.col("bytes") >= least) & F.col("key").isNotNull()).groupBy("digest").agg(F.max(F.struct("key", "url")).alias("c"))
    marked = kinds.join(chiefs, "digest", "left").select("key", "url", "digest", "bytes", "packed", "copies", F.col("c.key").alias("chief"), F.col("c.url").alias("chief_url"), F.coalesce(F.col("key").eqNullSafe(F.col("c.key")) & F.col("url").eqNullSafe(F.col("c.url")), F.lit(False)).alias("lead"))
    marked = written(sized(marked), "marked")
    notes = marked.where("chief is not null AND NOT (lead AND copies = 1)").select("key", "url", "digest", "chief", "chief_url", "lead")

    placed = numbered(marked.select("key", "url", "digest", "total"), ["key", "url", "digest"], "before", "total")
    roll = int(roll_mb * (1 << 20))
    # Where files begin is a table, a row for each file. Tasks get runs of whole files; the driver sees where each run begins, never more
    # than ``runs`` rows, and inside a task the table's own rows, sorted among the records, say where the next file begins.
    first = F.min(F.struct(F.col("key").isNotNull().alias("a"), F.coalesce("key", F.lit(0)).alias("b"), F.col("url").isNotNull().alias("c"), F.coalesce("url", F.lit("")).alias("d"), F.col("digest").alias("e")))
    begins = placed.groupBy(F.floor(F.col("before") / roll).alias("at")).agg(first.alias("first"))
    begins = written(numbered(begins, ["at"], "file"), "files")
    each = -(-begins.count() // runs)
    bounds = [tuple(r["first"]) for r in begins.where(F.col("file") % max(1, each) == 0).orderBy("file").collect()]

    def run_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Each row's run of files; equal rows of a batch become one with their number."""
        for batch in batches:
            keep, times, run, seen = [], [], [], {}
            for i, (key, url, digest, kind) in enumerate(zip(*(batch.column(c).to_pylist() for c in ("key", "url", "digest", "kind")), strict=True)):
                at = seen.setdefault((key, url, digest, kind), len(keep))
                if at < len(keep):
                    times[at] += 1
                    continue
                keep.append(i)
                times.append(1)
                run.append(max(0, bisect.bisect_right(bounds, (key is not None, key or 0, url is not None, url or "", digest)) - 1))
            kept = batch.take(pa.array(keep, pa.int64()))
            yield pa.RecordBatch.from_arrays([pa.array(run, pa.int32()), pa.array(times, pa.int64()), *kept.columns], names=["run", "times", *batch.schema.names])

    plain = [F.lit(None).cast(t).alias(n) for n, t in (("chief", "long"), ("chief_url", "string"), ("lead", "boolean"))]
    bodies = rows.select("key", "url", F.sha1(F.coalesce("html", F.lit("")).cast("binary")).alias("digest"), F.lit(1).alias("kind"), "html", *plain, F.lit(None).cast("long").alias("file"))
    marks = notes.select("key", "url", "digest", F.lit(0).alias("kind"), F.lit(None).cast("string").alias("html"), "chief", "chief_url", "lead", F.lit(None).cast("long").alias("file"))
    starts = begins.select(F.when(F.col("first.a"), F.col("first.b")).alias("key"), F.when(F.col("first.c"), F.col("first.d")).alias("url"), F.col("first.e").alias("digest"), F.lit(-1).alias("kind"), F.lit(None).cast("string").alias("html"), *plain, "file")
    dealt = bodies.unionByName(marks).unionByName(starts).mapInArrow(run_of, "run int, times long, key long, url string, digest string, kind int, html string, chief long, chief_url string, lead boolean, file long")
    dealt = dealt.repartitionById(max(partitions(spark), len(bounds)), "run").sortWithinPartitions("run", "key", "url", "digest", "kind")

    def save(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        file, out, last, number, note = None, None, None, 0, None
        made, held = [], {}

        def close() -> None:
            if out is not None:
                made.append({"file": file, "path": held["path"], "records": held["records"], "bytes": out.close(), "first": held["first"], "last": held["last"]})

        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in ("times", "key", "url", "digest", "kind", "html", "chief", "chief_url", "lead", "file")), strict=True):
                times, key, url, digest, kind, html, chief, chief_url, lead, at = row
                if kind == -1:
                    close()
                    file, last = at, None
                    held = {"path": f"{folder}/pages-{at:08d}.warc.gz", "records": 0, "first": key, "last": key}
                    out = files.Writing(held["path"])
                    out.write(member(opening(held["path"].rpartition("/")[2])))
                    continue
                if (key, url, digest) != last:
                    last, number, note = (key, url, digest), 0, None
                if kind == 0:
                    note = ((chief, chief_url), lead)
                    continue
                payload = (html or "").encode()
                for _ in range(times):
                    revisit = note is not None and not (note[1] and number == 0)
                    out.write(member(record(key, url, payload, digest, len(payload), note[0] if revisit else None, number)))
                    number += 1
                held["records"] += times
                held["last"] = key
        close()
        if made:
            yield pa.RecordBatch.from_pylist(made, pa.schema([("file", pa.int64()), ("path", pa.string()), ("records", pa.int64()), ("bytes", pa.int64()), ("first", pa.int64()), ("last", pa.int64())]))

    return written(dealt.mapInArrow(save, "file long, path string, records long, bytes long, first long, last long"), "manifest")


def records(stream, block: int = 1 << 16) -> Iterator[tuple[dict, bytes]]:
    """(headers, block) of each member of a .warc.gz, read in pieces; what a piece holds of the next members is copied once a member, so pieces are small."""
    z, plain, rest = zlib.decompressobj(31), [], b""
    while True:
        data = rest or stream.read(block)
        if not data:
            if plain:
                raise ValueError("the archive ends inside a record")
            return
        plain.append(z.decompress(data))
        rest = z.unused_data
        if z.eof:
            head, _, body = b"".join(plain).partition(b"\r\n\r\n")
            fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
            yield fields, body[: int(fields["Content-Length"])]
            z, plain = zlib.decompressobj(31), []


def read(manifest: DataFrame) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to) of every record of the manifest's files.

    A response's length and digest are taken from its payload and held against its headers. An empty manifest gives an empty result.
    """
    names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column("path").to_pylist():
                out: list[list] = [[] for _ in names]
                with files.opened(path) as f:
                    for head, block in records(f):
                        kind = head["WARC-Type"]
                        if kind == "warcinfo":
                            continue
                        digest, size = base64.b32decode(head["WARC-Payload-Digest"].removeprefix("sha1:")).hex(), int(head["X-Payload-Length"])
                        if kind == "response":
                            body = block.partition(b"\r\n\r\n")[2]
                            if (len(body), hashlib.sha1(body).hexdigest()) != (size, digest):
                                raise ValueError(f"{path}: payload of {head['WARC-Record-ID']} differs from its headers")
                        key, other = head.get("X-Page-Id", ""), head.get("X-Refers-To-Page-Id")
                        for column, v in zip(out, (int(key) if key else None, size, digest, kind, int(other) if other else None), strict=True):
                            column.append(v)
                yield pa.RecordBatch.from_arrays([pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.string()), pa.array(out[3], pa.string()), pa.array(out[4], pa.int64())], names=names)

    tasks = max(partitions(manifest.sparkSession), min(manifest.count(), 20_000))
    return manifest.select("path", F.col("file").cast("int").alias("file")).repartitionById(tasks, "file").select("path").mapInArrow(run, "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long")


def new_folder(pages: DataFrame) -> str:
    return new_path(pages.sparkSession, "warc")
