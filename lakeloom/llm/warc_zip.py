"""Web archives packaged in ZIP files: writing, and reading by ranges.

An archive holds archive/data.warc.gz (one gzip member per record) and
indexes/index.cdxj, both stored, so a record is a byte range of the ZIP file. The
reader parses the end record, the ZIP64 records and the central directory, finds the
stored members, turns the index into (path, offset, length) rows, deals these over
the cluster and reads just those ranges. Paths stay in DataFrames; the driver sees
none of them.

Archives are written under names of their own and become part of the result only
through the manifest, so a repeated task leaves at worst a file that nothing reads.
"""

from __future__ import annotations

import gzip
import hashlib
import json
import struct
import uuid
import zipfile
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeloom.llm.common import in_arrow, new_path, pieces, stored

DATA, INDEX = "archive/data.warc.gz", "indexes/index.cdxj"

#: Bytes from which equal payloads become revisits; records and bytes of an archive.
REVISIT, RECORDS, BYTES = 100, 50_000, 1 << 30

#: Bytes of neighbouring records that are read at once; size of a read task's range; tasks at most.
JOINED, RANGE, TASKS = 4 << 20, 8 << 20, 100_000

_DATE = "2024-01-01T00:00:00Z"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def opened(uri: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a URI or absolute path, and the path in it."""
    return pafs.FileSystem.from_uri(uri)


def record(page_id: int, url: str, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """One gzip member with a response, or a revisit without its payload."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    target = "".join(c if c > " " else f"%{ord(c):02X}" for c in url)
    head = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: <urn:page:{page_id}>",
        f"WARC-Target-URI: {target}",
        f"WARC-Date: {_DATE}",
        f"WARC-Payload-Digest: sha256:{digest}",
        *([] if refers_to is None else [f"WARC-Refers-To: <urn:page:{refers_to}>", f"WARC-Profile: {_PROFILE}"]),
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    return gzip.compress("\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n", 1, mtime=0)


def parsed(member: bytes) -> dict:
    """Fields of a record: page_id, type, payload (None for a revisit), length, digest, refers_to."""
    raw = zlib.decompress(member, 31)
    head, _, rest = raw.partition(b"\r\n\r\n")
    fields = dict(x.split(": ", 1) for x in head.decode().split("\r\n")[1:])
    block = rest[: int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    told = dict(x.split(": ", 1) for x in http.decode().split("\r\n")[1:])
    number = lambda x: int(x.removeprefix("<urn:page:").removesuffix(">"))
    revisit = fields["WARC-Type"] == "revisit"
    return {
        "page_id": number(fields["WARC-Record-ID"]),
        "type": fields["WARC-Type"],
        "url": fields["WARC-Target-URI"],
        "payload": None if revisit else payload,
        "length": int(told["Content-Length"]),
        "digest": fields["WARC-Payload-Digest"].removeprefix("sha256:"),
        "refers_to": number(fields["WARC-Refers-To"]) if revisit else None,
    }


class _Archive:
    """One ZIP file under way: records go to the stored data member, lines to the index."""

    def __init__(self, folder: str):
        system, path = opened(folder)
        system.create_dir(path, recursive=True)
        name = f"pages-{uuid.uuid4().hex}.zip"
        self.uri = f"{folder}/{name}"
        self.stream = system.open_output_stream(f"{path}/{name}")
        self.zip = zipfile.ZipFile(self.stream, "w", zipfile.ZIP_STORED)
        self.data = self.zip.open(zipfile.ZipInfo(DATA), "w", force_zip64=True)
        self.lines: list[str] = []
        self.size = 0

    def add(self, page_id: int, url: str, member: bytes) -> None:
        self.data.write(member)
        self.lines.append(json.dumps({"id": page_id, "url": url, "offset": self.size, "length": len(member)}))
        self.size += len(member)

    def close(self) -> tuple[str, int, int]:
        self.data.close()
        self.zip.writestr(zipfile.ZipInfo(INDEX), "\n".join(self.lines))
        self.zip.close()
        self.stream.close()
        return self.uri, len(self.lines), self.size


def _written(folder: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = pa.schema([("path", pa.string()), ("records", pa.int64()), ("bytes", pa.int64())])
        held = None
        done = []
        for batch in pieces(batches, column=2, most=8 << 20):
            for r in batch.to_pylist():
                held = held or _Archive(folder)
                payload = (r["payload"] or "").encode()
                held.add(r["page_id"], r["url"] or "", record(r["page_id"], r["url"] or "", payload, r["digest"], r["refers_to"]))
                if len(held.lines) >= RECORDS or held.size >= BYTES:
                    done.append(held.close())
                    held = None
        if held:
            done.append(held.close())
        yield pa.RecordBatch.from_arrays([pa.array(c, k.type) for c, k in zip(zip(*done) if done else [[], [], []], kinds)], schema=kinds)

    return run


def write(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", folder: str | None = None) -> DataFrame:
    """Writes archives and returns their manifest (path, records, bytes).

    Of equal payloads of REVISIT bytes or more the least id is a response and the
    others revisit it. A null payload is empty. Rows without an id are left out;
    rows that repeat an id with equal payloads are all responses if it is the least.
    No rows: no archives. Other columns are left out, whatever their names.

    Shorter payloads meet the first ones under keys of their own, as none of them can
    be a revisit: an empty payload that many pages share gathers nowhere.
    """
    rows = pages.where(F.col(id_col).isNotNull()).select(
        F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"), F.coalesce(F.col(html_col), F.lit("")).alias("payload")
    )
    keyed = rows.withColumn("digest", F.sha2("payload", 256))
    firsts = (
        keyed.where(F.octet_length("payload") >= REVISIT).groupBy("digest")
        .agg(F.min("page_id").alias("first"), F.count("*").alias("n")).where("n > 1").select("digest", "first")
    )
    long = F.octet_length("payload") >= REVISIT
    met = keyed.withColumn("key", F.when(long, F.col("digest")).otherwise(F.concat(F.lit("-"), F.col("page_id").cast("string"))))
    told = met.join(firsts.withColumnRenamed("digest", "key"), "key", "left").select(
        "page_id", "url", "payload", "digest", F.when(F.col("first") < F.col("page_id"), F.col("first")).alias("refers_to")
    )
    folder = folder or new_path(pages.sparkSession, "archives")
    return stored(in_arrow(told, _written(folder), "path string, records long, bytes long"), "manifest")


def members(source, size: int) -> dict[str, tuple[int, int, int]]:
    """Name to (method, offset of its bytes, size) from the central directory of a ZIP file.

    source: anything with seek and read. ZIP64 fields are followed where the short
    ones are full. Raises ValueError where no end record is found.
    """

    def at(offset: int, n: int) -> bytes:
        source.seek(offset)
        return source.read(n)

    tail_at = max(0, size - (1 << 16) - 22)
    tail = at(tail_at, size - tail_at)
    end = tail.rfind(b"PK\x05\x06")
    if end < 0:
        raise ValueError("no end of central directory")
    count, length, start = struct.unpack("<10xHII", tail[end : end + 20])
    if count == 0xFFFF or length == 0xFFFFFFFF or start == 0xFFFFFFFF:
        where = at(tail_at + end - 20, 20)
        if where[:4] != b"PK\x06\x07":
            raise ValueError("no ZIP64 locator")
        wide = at(struct.unpack("<8xQ", where[:16])[0], 56)
        count, length, start = struct.unpack("<32xQQQ", wide)
    body = at(start, length)
    found, p = {}, 0
    for _ in range(count):
        if body[p : p + 4] != b"PK\x01\x02":
            raise ValueError("broken central directory")
        method, packed, plain, n, m, k, local = struct.unpack("<10xH8xIIHHH8xI", body[p : p + 46])
        name = body[p + 46 : p + 46 + n].decode()
        extra, q = body[p + 46 + n : p + 46 + n + m], 0
        while q + 4 <= len(extra):
            tag, width = struct.unpack("<HH", extra[q : q + 4])
            if tag == 1:
                wide = iter(struct.unpack(f"<{width // 8}Q", extra[q + 4 : q + 4 + width // 8 * 8]))
                plain = next(wide) if plain == 0xFFFFFFFF else plain
                packed = next(wide) if packed == 0xFFFFFFFF else packed
                local = next(wide) if local == 0xFFFFFFFF else local
            q += 4 + width
        a, b = struct.unpack("<26xHH", at(local, 30))
        found[name] = (method, local + 30 + a + b, packed)
        p += 46 + n + m + k
    return found


def _located(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(path) to one row per indexed record: where its bytes lie in the ZIP file."""
    for batch in batches:
        for path in batch.column(0).to_pylist():
            system, inner = opened(path)
            with system.open_input_file(inner) as f:
                found = members(f, f.size())
                for name in (DATA, INDEX):
                    if found[name][0] != zipfile.ZIP_STORED:
                        raise ValueError(f"{path}: {name} is not stored")
                _, at, n = found[INDEX]
                f.seek(at)
                rows = [json.loads(x) for x in f.read(n).decode().split("\n") if x]
            base = found[DATA][1]
            yield pa.RecordBatch.from_arrays(
                [pa.array([path] * len(rows), pa.string()), pa.array([base + r["offset"] for r in rows], pa.int64()), pa.array([r["length"] for r in rows], pa.int64())],
                ["path", "offset", "length"],
            )


def records(paths: DataFrame) -> DataFrame:
    """(path, offset, length) of every record of the archives in a column path.

    The paths are few and short beside what is read for them, so they are dealt to a
    number of tasks of their own (an archive each, up to TASKS) and not by their bytes.
    """
    n = max(1, min(TASKS, paths.count()))
    return in_arrow(paths.select("path").repartition(n, "path"), _located, "path string, offset long, length long")


_READ = "page_id long, url string, record_type string, payload_bytes long, payload_digest string, refers_to long, payload string"


def _read(with_payload: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.string()]
        names = [x.split()[0] for x in _READ.split(", ")]
        f, now = None, None
        for batch in batches:
            rows = list(zip(*(c.to_pylist() for c in batch.columns)))
            i = 0
            while i < len(rows):
                path, offset, n = rows[i]
                j = i + 1
                while j < len(rows) and rows[j][0] == path and rows[j][1] == offset + n and n + rows[j][2] <= JOINED:
                    n += rows[j][2]
                    j += 1
                if path != now:
                    if f is not None:
                        f.close()
                    system, inner = opened(path)
                    f, now = system.open_input_file(inner), path
                f.seek(offset)
                body = f.read(n)
                out = []
                for _, at, m in rows[i:j]:
                    r = parsed(body[at - offset : at - offset + m])
                    p = r["payload"]
                    out.append((
                        r["page_id"], r["url"], r["type"],
                        r["length"] if p is None else len(p), r["digest"] if p is None else hashlib.sha256(p).hexdigest(),
                        r["refers_to"], None if p is None or not with_payload else p.decode(),
                    ))
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names)
                i = j
        if f is not None:
            f.close()

    return run


def read(paths: DataFrame, with_payload: bool = True) -> DataFrame:
    """Every record of the archives, its length and digest taken from the bytes read.

    A revisit has no payload; its length and digest are those its headers state. The
    places of records are a work table; ranges of RANGE bytes are dealt to as many
    tasks as the bytes of the archives make, not by the size of the places.
    """
    where = stored(records(paths), "places")
    size = where.agg(F.coalesce(F.sum("length"), F.lit(0))).first()[0]
    n = max(1, min(TASKS, -(-size // RANGE)))
    dealt = where.repartition(n, "path", F.floor(F.col("offset") / RANGE)).sortWithinPartitions("path", "offset")
    return in_arrow(dealt, _read(with_payload), _READ)


def op7_warc(spark, sf_dir: str) -> DataFrame:
    """Every page written to ZIP-packaged archives and read back by ranges."""
    from lakeloom.session import table

    back = read(write(table(spark, sf_dir, "pages")), with_payload=False)
    return back.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


ORACLE = """
SELECT page_id, CAST(strlen(h) AS BIGINT) AS payload_bytes, sha256(h) AS payload_digest,
       CASE WHEN strlen(h) >= 100 AND first < page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN strlen(h) >= 100 AND first < page_id THEN first END AS refers_to
FROM (SELECT page_id, coalesce(html, '') AS h, min(page_id) OVER (PARTITION BY coalesce(html, '')) AS first FROM pages)"""
