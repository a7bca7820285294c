"""WARC archives: a writer, and a Python data source that reads them.

Every record is a gzip member of its own. The member's header has an extra field "LX" with the compressed and the plain length, so a
reader that does not want a record's payload inflates its first bytes for the headers and goes to the next member.

The source (format "warc") plans partitions from the files' sizes and reads each file as a stream: READ_BYTES and one record's wanted payload are
held, whatever the file's size. Predicates on warc_type, record_id, target_uri, warc_date, refers_to and page_id (equality, lists, beginnings, ends,
parts, order; stated when reading, or pushed down by Spark) are tested on the headers, which are inflated first; the payload of a record that fails is never inflated where
an LX field tells the member's end, and else inflated into nothing (with the option payload "false" so is every one; with "digest" payloads are
measured and digested, not given). Members of any number of records, without the extra field, and files that are not compressed are read
as well. payload_digest is the SHA-256 of the payload; a stated digest (sha256 in hex, sha1 in base32) is compared unless verify is "false", one of
another kind is not.

Of records with equal payloads of at least LEAST_SHARED bytes one is written as response, the others as revisits
(profile identical-payload-digest) without a payload; each names the length and digest of the full payload.

Defined results: a null payload is empty; shorter payloads are all responses; rows that repeat an id and a payload that is shared are
all responses if the id is the smallest; null ids count as largest, and revisits of null-id payloads only have no refers_to;
an empty table writes no file; columns besides id, url and payload are not written.
"""

from __future__ import annotations

import base64
import hashlib
import json
import struct
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from .storage import stash

LEAST_SHARED = 100
PART_BYTES = 32 << 20
FILE_BYTES = 64 << 20
#: Fixed values of the format.
VERSION = b"WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP_HEAD = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n"

SCHEMA = "page_id long, warc_type string, record_id string, target_uri string, warc_date string, payload_bytes long, payload_digest string, refers_to long, headers map<string,string>, payload binary"
#: Bytes read at a time: of a member whose end is known first so many as headers mostly have, otherwise more.
FIRST_BYTES = 2048
READ_BYTES = 1 << 16
#: The longest headers of a record, and the bytes of rows in a batch.
HEADER_BYTES = 1 << 20
BATCH_BYTES = 8 << 20


def member(plain: bytes, level: int = 6) -> bytes:
    """A gzip member that tells its lengths in an LX extra field."""
    press = zlib.compressobj(level, zlib.DEFLATED, -15)
    body = press.compress(plain) + press.flush()
    total = 10 + 2 + 12 + len(body) + 8
    head = b"\x1f\x8b\x08\x04\0\0\0\0\0\xff" + struct.pack("<H2sHII", 12, b"LX", 8, total, len(plain))
    return head + body + struct.pack("<II", zlib.crc32(plain), len(plain) & 0xFFFFFFFF)


def record(kind: str, page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, date: str) -> bytes:
    """A record's plain bytes."""
    name = lambda x: f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{x}:{digest}')}>"
    head = [("WARC-Type", kind), ("WARC-Record-ID", name(page_id)), ("WARC-Date", date), ("Content-Type", "application/http;msgtype=response"), ("WARC-Payload-Digest", f"sha256:{digest}"), ("X-Payload-Length", str(len(payload)))]
    if url is not None:
        head.append(("WARC-Target-URI", " ".join(url.split())))
    if page_id is not None:
        head.append(("X-Page-Id", str(page_id)))
    block = b""
    if kind == "revisit":
        head += [("WARC-Profile", REVISIT_PROFILE), ("WARC-Refers-To", name(refers_to))]
        if refers_to is not None:
            head.append(("X-Refers-To-Page", str(refers_to)))
    else:
        block = HTTP_HEAD % len(payload) + payload
    head.append(("Content-Length", str(len(block))))
    lines = b"".join(f"{k}: {v}\r\n".encode() for k, v in head)
    return VERSION + b"\r\n" + lines + b"\r\n" + block + b"\r\n\r\n"


def write_archives(pages: DataFrame, folder: str, key: str = "page_id", url: str = "url", payload: str = "html", date: str = "2020-01-01T00:00:00Z") -> DataFrame:
    """Write a record a row to folder; gives a row a file: path, records."""
    rows = pages.select(F.col(key).cast("long").alias("__key"), F.col(url).cast("string").alias("__url"), F.coalesce(F.col(payload).cast("string"), F.lit("")).alias("__payload"))
    rows = rows.withColumn("__digest", F.sha2("__payload", 256))
    # light rows only: ids and digests
    light = stash(rows.where(F.octet_length("__payload") >= LEAST_SHARED).select("__key", "__digest"))
    first = light.groupBy("__digest").agg(F.min("__key").alias("__first"), F.count("*").alias("__n")).where("__n > 1").drop("__n")
    again = light.join(first, "__digest").where(~F.coalesce(F.col("__key") == F.col("__first"), F.lit(False)))
    again = again.select(F.col("__key").alias("__k"), F.col("__digest").alias("__d"), "__first", F.lit(True).alias("__again")).distinct()
    # null ids of one payload only have no id to refer to: they stay responses
    again = again.where(F.col("__first").isNotNull())
    joined = rows.join(again, F.col("__key").eqNullSafe(F.col("__k")) & (F.col("__digest") == F.col("__d")), "left")

    def write(batches):
        from pyspark import TaskContext

        from .storage import write_file

        part, held, size, n, files = TaskContext.get().partitionId(), [], 0, 0, 0

        def flush():
            nonlocal held, size, n, files
            path = f"{folder}/part-{part:07d}-{files:04d}.warc.gz"
            write_file(path, b"".join(held))
            row = pa.RecordBatch.from_pydict({"path": pa.array([path]), "records": pa.array([n], pa.int64())})
            held, size, n, files = [], 0, 0, files + 1
            return row

        for batch in batches:
            for k, u, p, d, f, a in zip(*(batch[c].to_pylist() for c in ("__key", "__url", "__payload", "__digest", "__first", "__again")), strict=True):
                held.append(member(record("revisit" if a else "response", k, u, p.encode(), d, f if a else None, date)))
                size, n = size + len(held[-1]), n + 1
                if size >= FILE_BYTES:
                    yield flush()
        if held:
            yield flush()

    return stash(joined.mapInArrow(write, "path string, records long"))


def _headers(block: bytes) -> dict[str, str]:
    found: dict[str, str] = {}
    for line in block.split(b"\r\n")[1:]:
        k, colon, v = line.partition(b":")
        if colon:
            found[k.decode("utf-8", "replace").strip()] = v.decode("utf-8", "replace").strip()
    return found


class _Block:
    """A record's block, which is read in pieces if at all."""

    def __init__(self, plain: _Plain, size: int):
        self.plain, self.left = plain, size

    def pieces(self) -> Iterator[bytes]:
        while self.left:
            if not self.plain.held and not self.plain.more():
                raise ValueError("a record ends before its Content-Length")
            piece, self.plain.held = self.plain.held[: self.left], self.plain.held[self.left :]
            self.left -= len(piece)
            yield piece


class _Plain:
    """Records in a stream of plain pieces: headers first; what is not read of a block is dropped piece by piece."""

    def __init__(self, pieces: Iterator[bytes]):
        self.source, self.held = pieces, b""

    def more(self) -> bool:
        piece = next(self.source, None)
        if piece is None:
            return False
        self.held += piece
        return True

    def __iter__(self) -> Iterator[tuple[dict[str, str], _Block]]:
        while True:
            while not (found := self.held.lstrip(b"\r\n")):
                self.held = b""
                if not self.more():
                    return
            self.held = found
            while (cut := self.held.find(b"\r\n\r\n")) < 0:
                if len(self.held) > HEADER_BYTES or not self.more():
                    raise ValueError("no end of a record's headers")
            headers, self.held = _headers(self.held[:cut]), self.held[cut + 4 :]
            block = _Block(self, int(headers.get("Content-Length", 0)))
            yield headers, block
            for _ in block.pieces():
                pass


class Archive:
    """The records of a seekable file, of which READ_BYTES and one piece of a block are held at a time. inflated counts plain bytes."""

    def __init__(self, file):
        self.file, self.inflated = file, 0

    def __iter__(self) -> Iterator[tuple[dict[str, str], _Block]]:
        while True:
            at = self.file.tell()
            start = self.file.read(12)
            if not start:
                return
            if start[:2] != b"\x1f\x8b":
                self.file.seek(at)
                yield from _Plain(iter(lambda: self.file.read(READ_BYTES), b""))
                return
            size = self._length(start)
            self.file.seek(at)
            if size is None:
                yield from _Plain(self._member())
            else:  # one record; where it ends is known, so the rest need not be inflated
                yield next(iter(_Plain(self._member(size))))
                self.file.seek(at + size)

    def _length(self, start: bytes) -> int | None:
        """The compressed length that a member's LX field tells."""
        if len(start) < 12 or not start[3] & 4:
            return None
        extra, p = self.file.read(struct.unpack("<H", start[10:12])[0]), 0
        while p + 4 <= len(extra):
            n = struct.unpack("<H", extra[p + 2 : p + 4])[0]
            if extra[p : p + 2] == b"LX" and n == 8:
                return struct.unpack("<I", extra[p + 4 : p + 8])[0]
            p += 4 + n
        return None

    def _member(self, size: int | None = None) -> Iterator[bytes]:
        """The plain pieces of the gzip member here; the file then stands at its end."""
        inflate, first = zlib.decompressobj(31), FIRST_BYTES if size else READ_BYTES
        while not inflate.eof:
            raw = inflate.unconsumed_tail or self.file.read(first if size is None else min(first, size))
            piece = inflate.decompress(raw, first)
            if not raw and not piece and not inflate.eof:
                raise ValueError("a gzip member is cut short")
            first = READ_BYTES
            self.inflated += len(piece)
            if piece:
                yield piece
        self.file.seek(self.file.tell() - len(inflate.unused_data))


def _payload(headers: dict[str, str], block: _Block) -> Iterator[bytes]:
    """The pieces of a record's payload: its block, without the head of an HTTP message."""
    pieces = block.pieces()
    if headers.get("Content-Type", "").startswith("application/http"):
        head = b""
        for piece in pieces:
            head += piece
            if (cut := head.find(b"\r\n\r\n")) >= 0:
                yield head[cut + 4 :]
                break
    yield from pieces


def _number(x: str | None) -> int | None:
    try:
        return int(x) if x is not None else None
    except ValueError:
        return None


#: Columns that headers alone tell, and how.
TOLD = {
    "page_id": lambda h: _number(h.get("X-Page-Id")),
    "refers_to": lambda h: _number(h.get("X-Refers-To-Page")),
    "warc_type": lambda h: h.get("WARC-Type"),
    "record_id": lambda h: h.get("WARC-Record-ID"),
    "target_uri": lambda h: h.get("WARC-Target-URI"),
    "warc_date": lambda h: h.get("WARC-Date"),
}
#: Predicates that are tested on headers: what holds of a value that is not null.
TESTS = {
    "EqualTo": lambda x, v: x == v,
    "In": lambda x, v: x in v,
    "StringStartsWith": lambda x, v: x.startswith(v),
    "StringEndsWith": lambda x, v: x.endswith(v),
    "StringContains": lambda x, v: v in x,
    "GreaterThan": lambda x, v: x > v,
    "GreaterThanOrEqual": lambda x, v: x >= v,
    "LessThan": lambda x, v: x < v,
    "LessThanOrEqual": lambda x, v: x <= v,
    "IsNotNull": lambda x, v: True,
}


def holds(wanted: list[tuple], headers: dict[str, str]) -> bool:
    """Whether a record can fulfil the predicates (name, column, value)."""
    for test, column, value in wanted:
        if column == "payload_digest":  # only a stated digest of the same kind can refuse
            stated = headers.get("WARC-Payload-Digest", "")
            if stated.startswith("sha256:") and stated != f"sha256:{value}":
                return False
        else:
            told = TOLD[column](headers)
            if told is None or not TESTS[test](told, value):
                return False
    return True


class _Files(InputPartition):
    def __init__(self, paths: list[str]):
        super().__init__(paths)
        self.paths = paths


class WarcReader(DataSourceReader):
    def __init__(self, options: dict):
        self.path = options.get("path") or ""
        self.payload = options.get("payload", "true").lower()
        if self.payload not in ("true", "false", "digest"):
            raise ValueError(f"payload: true, false or digest, not {self.payload}")
        self.verify = options.get("verify", "true").lower() == "true"
        self.part_bytes = int(options.get("partbytes", PART_BYTES))
        self.wanted: list[tuple] = [tuple(x) for x in json.loads(options.get("where", "[]"))]

    def partitions(self):
        from pyarrow import fs

        from .storage import file_system

        store, place = file_system(self.path)
        found = store.get_file_info(fs.FileSelector(place, recursive=True, allow_not_found=True)) if store.get_file_info(place).type != fs.FileType.File else [store.get_file_info(place)]
        files = sorted((x.path, x.size) for x in found if x.type == fs.FileType.File and x.path.endswith((".warc", ".warc.gz")))
        groups, size = [[]], 0
        for path, n in files:
            if groups[-1] and size + n > self.part_bytes:
                groups.append([])
                size = 0
            groups[-1].append(path)
            size += n
        return [_Files(g) for g in groups]

    def read(self, partition):
        from .storage import file_system

        rows: list[dict] = []
        held = 0
        store, _ = file_system(self.path)
        for path in partition.paths:
            with store.open_input_file(path) as f:
                for headers, block in Archive(f):
                    if not holds(self.wanted, headers):
                        continue
                    rows.append(self._row(headers, block))
                    held += len(rows[-1]["payload"] or b"") + 500
                    if held >= BATCH_BYTES:
                        yield _batch(rows)
                        rows, held = [], 0
        if rows:
            yield _batch(rows)

    def _row(self, headers: dict[str, str], block: _Block) -> dict:
        stated = headers.get("WARC-Payload-Digest", "")
        payload, digest = None, stated.removeprefix("sha256:") if stated.startswith("sha256:") else None
        size = _number(headers.get("X-Payload-Length"))
        if self.payload != "false" and headers.get("WARC-Type") != "revisit":
            full, other, size, kept = hashlib.sha256(), hashlib.sha1(), 0, []
            for piece in _payload(headers, block):
                full.update(piece)
                size += len(piece)
                if stated.startswith("sha1:"):
                    other.update(piece)
                if self.payload == "true":
                    kept.append(piece)
            payload, told, digest = b"".join(kept) if self.payload == "true" else None, digest, full.hexdigest()
            wrong = told not in (None, digest) or (stated.startswith("sha1:") and stated[5:] != base64.b32encode(other.digest()).decode())
            if wrong and self.verify:
                raise ValueError(f"{headers.get('WARC-Record-ID')}: the payload does not have the digest {stated}")
        return {
            **{c: tell(headers) for c, tell in TOLD.items()},
            "payload_bytes": size,
            "payload_digest": digest,
            "headers": list(headers.items()),
            "payload": payload,
        }


class PushdownReader(WarcReader):
    """Takes what Spark pushes down. Spark keeps a relation's last pushed predicates for all queries over it, so a relation with
    the option "pushdown" is for one query with one set of filters; predicates in the option "where" have no such limit."""

    def pushFilters(self, filters):
        for f in filters:
            name, column = type(f).__name__, f.attribute[0] if len(getattr(f, "attribute", ())) == 1 else None
            value = getattr(f, "value", None)
            if column in TOLD and name in TESTS and (value is not None or name == "IsNotNull"):
                self.wanted.append((name, column, value))
                continue
            if column == "payload_digest" and name == "EqualTo" and value is not None:
                self.wanted.append((name, column, value))
            yield f


_ARROW = pa.schema([("page_id", pa.int64()), ("warc_type", pa.string()), ("record_id", pa.string()), ("target_uri", pa.string()), ("warc_date", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("refers_to", pa.int64()), ("headers", pa.map_(pa.string(), pa.string())), ("payload", pa.binary())])


def _batch(rows: list[dict]) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist(rows, schema=_ARROW)


class WarcDataSource(DataSource):
    """spark.read.format("warc").option("payload", "true" | "false" | "digest").option("verify", "true" | "false").load(folder or file)"""

    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> WarcReader:
        return (PushdownReader if self.options.get("pushdown", "false").lower() == "true" else WarcReader)(self.options)


def read_archives(spark, folder: str, payload: bool | str = True, verify: bool = True, where: list[tuple] | None = None, pushdown: bool = False) -> DataFrame:
    """The records of all archives below a folder. payload "digest": read, measured and digested, not given.

    where: predicates (test, column, value) that the reader tests on headers, as ("EqualTo", "warc_type", "response"), by the names of
    TESTS, of the columns of TOLD, or EqualTo of payload_digest. With pushdown Spark hands the reader those that the query
    states, for one query (see PushdownReader).
    """
    for test, column, _ in where or []:
        if (column not in TOLD or test not in TESTS) and (test, column) != ("EqualTo", "payload_digest"):
            raise ValueError(f"headers do not tell {test} of {column}")
    if pushdown:
        spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(WarcDataSource)
    reader = spark.read.format("warc").option("payload", str(payload).lower()).option("verify", str(verify).lower()).option("pushdown", str(pushdown).lower())
    found = reader.option("where", json.dumps(where or [])).load(folder)
    for _, column, value in where or []:
        if column == "payload_digest":  # headers can only refuse
            found = found.where(F.col(column) == value)
    return found


ORACLE_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS h, sha256(coalesce(html, '')) AS d FROM pages),
q AS (SELECT page_id, CAST(strlen(h) AS BIGINT) AS n, d, min(page_id) OVER (PARTITION BY d) AS f FROM p)
SELECT page_id, n AS payload_bytes, d AS payload_digest, CASE WHEN n >= 100 AND f <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN n >= 100 AND f <> page_id THEN f END AS refers_to FROM q
"""
