"""WARC archives as a chunked record table.

A record is a row of metadata and any number of chunk rows (record id, chunk
number, bytes). Writing streams the chunks of a record through a gzip member;
reading streams an archive and gives chunk rows again, each with the SHA-1 of the
payload up to its end (an incremental digest) and the bytes so far, so the last
chunk of a record carries the digest and length of the whole payload. Neither
side ever holds a whole record; a task holds one chunk and one output batch.

Archives are written by tasks under names of their own, and the list of archives
is the staged output of those tasks: what a lost or repeated task leaves behind
isn't in the list and is never read. Paths may be of any file system that
pyarrow opens; the folder is one that all executors share.

Of records with equal payloads of ``dedupe_bytes`` or more, that with the largest
id is a response and the others are revisits that refer to it.

Defined cases: a null payload is an empty one; a null url leaves its header out; line
ends in a url are percent-encoded; repeated rows are numbered and stay records of
their own (of equal rows the last is the response); an
empty table gives no archives and no rows. Columns besides those named take no part.
"""

from __future__ import annotations

import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kaiji.llm.common import shared_path, stage

CHUNK = 1 << 20
ARCHIVE_BYTES = 256 << 20  # an archive is closed beyond this size, between records
HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"


def _open(path: str) -> tuple[pafs.FileSystem, str]:
    if path.startswith("file:"):
        return pafs.LocalFileSystem(), "/" + path[5:].lstrip("/")
    return pafs.FileSystem.from_uri(path) if "://" in path else (pafs.LocalFileSystem(), path)


# ---- what becomes of each record ------------------------------------------

def decide(groups: DataFrame, dedupe_bytes: int = 1000) -> DataFrame:
    """Adds ``responses`` and refers_to to groups of equal rows.

    ``groups``: id, key, url_hash, payload_bytes, payload_digest and n, the number of
    equal rows. Only digests and ids are shuffled, and a hot digest's rows are
    reduced to their maximum first. ``responses``: how many of the n are responses.
    """
    order = F.struct(F.col("id").isNotNull().alias("known"), "id", "key", "url_hash", "n")
    last = (groups.filter(F.col("payload_bytes") >= dedupe_bytes).groupBy("payload_digest", "payload_bytes")
            .agg(F.max(order).alias("last")))
    joined = groups.join(last, ["payload_digest", "payload_bytes"], "left")
    responses = F.when(F.col("last").isNull(), F.col("n")).when(F.col("last") == order, 1).otherwise(0)
    return joined.select(*[groups[c] for c in groups.columns], responses.cast("long").alias("responses"),
                         record_id(F.col("last.key"), F.col("last.url_hash"), F.col("last.n")).alias("refers_to"))


def key_text(column: Column) -> Column:
    """A key that is never null: k and the value, or n."""
    return F.coalesce(F.concat(F.lit("k"), column.cast("string")), F.lit("n"))


def record_id(key: Column, url_hash: Column, nth: Column) -> Column:
    """Record id of the nth of the rows equal in key, url and payload."""
    return F.concat_ws(":", F.lit("urn:record"), key, url_hash.cast("string"), nth.cast("string"))


def key_of(rid: Column) -> Column:
    """The value that ``record_id`` was made from, as a string, or null."""
    key = F.regexp_extract(rid, r"(?s)^urn:record:(.*):-?[0-9]+:[0-9]+$", 1)
    return F.when(F.startswith(key, F.lit("k")), F.substring(key, F.lit(2), F.length(key)))


# ---- writing --------------------------------------------------------------

def chunk_rows(records: DataFrame, payload: str, chunk_bytes: int = CHUNK) -> DataFrame:
    """One row per chunk of a binary payload column; an empty payload has one empty chunk."""
    n = F.greatest(F.lit(1), F.ceil(F.length(payload) / F.lit(chunk_bytes))).cast("int")
    return (records.withColumn("chunk_no", F.explode(F.sequence(F.lit(0), n - 1)))
            .withColumn(payload, F.substring(F.col(payload), F.col("chunk_no") * chunk_bytes + 1, F.lit(chunk_bytes))))


class _Archive:
    """One gzip file of records under a name that no other task has."""

    def __init__(self, folder: str, level: int):
        self.path = f"{folder.rstrip('/')}/{uuid.uuid4().hex}.warc.gz"
        fs, at = _open(self.path)
        fs.create_dir(at.rsplit("/", 1)[0], recursive=True)
        self.out, self.level, self.records, self.bytes = fs.open_output_stream(at, compression=None), level, 0, 0
        self.member = None

    def _put(self, data: bytes) -> None:
        if data:
            self.bytes += len(data)
            self.out.write(data)

    def begin(self, head: bytes) -> None:
        self.member = zlib.compressobj(self.level, zlib.DEFLATED, 31)
        self.add(head)
        self.records += 1

    def add(self, data: bytes) -> None:
        self._put(self.member.compress(data))

    def end(self) -> None:
        self.add(b"\r\n\r\n")
        self._put(self.member.flush())
        self.member = None

    def close(self) -> tuple[str, int, int]:
        self.out.close()
        return self.path, self.records, self.bytes


def _head(row: dict) -> bytes:
    url = row["url"]
    lines = ["WARC/1.1", f"WARC-Type: {row['record_type']}", f"WARC-Record-ID: <{row['record_id']}>", "WARC-Date: 2000-01-01T00:00:00Z",
             f"WARC-Payload-Digest: sha1:{row['payload_digest']}"]
    if url is not None:
        lines.append("WARC-Target-URI: " + url.replace("\r", "%0D").replace("\n", "%0A"))
    if row["record_type"] == "revisit":
        lines += [f"WARC-Refers-To: <{row['refers_to']}>", "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
                  "Content-Length: 0"]
        return "\r\n".join([*lines, "", ""]).encode()
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(HTTP) + row['payload_bytes']}"]
    return "\r\n".join([*lines, "", ""]).encode() + HTTP


def _write(folder: str, level: int, archive_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        archive, done, now = None, [], None
        for batch in batches:
            fields = [c for c in batch.schema.names if c != "payload"]
            for i in range(batch.num_rows):
                row = {c: batch.column(c)[i].as_py() for c in fields}
                if row["record_id"] != now:
                    if now is not None:
                        archive.end()
                        if archive.bytes >= archive_bytes:
                            done.append(archive.close())
                            archive = None
                    archive, now = archive or _Archive(folder, level), row["record_id"]
                    archive.begin(_head(row))
                if row["record_type"] == "response":
                    archive.add(batch.column("payload")[i].as_py() or b"")
        if now is not None:
            archive.end()
            done.append(archive.close())
        if done:
            yield pa.record_batch([pa.array([d[0] for d in done]), pa.array([d[1] for d in done], pa.int64()),
                                   pa.array([d[2] for d in done], pa.int64())], names=["path", "records", "bytes"])

    return run


def write_archives(chunks: DataFrame, folder: str, level: int = 1, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write chunk rows, sorted in each partition by record and chunk; returns (path, records, bytes).

    Columns: record_id, record_type, refers_to, url, payload_bytes, payload_digest, chunk_no, payload.
    A partition must hold all chunks of its records.
    """
    cols = ["record_id", "record_type", "refers_to", "url", "payload_bytes", "payload_digest", "chunk_no", "payload"]
    return stage(chunks.select(*cols).mapInArrow(_write(folder, level, archive_bytes), "path string, records long, bytes long"), "warc-list")


# ---- reading --------------------------------------------------------------

class _Inflated:
    """Reads a stream of gzip members in bounded pieces."""

    def __init__(self, path: str, piece: int):
        fs, at = _open(path)
        self.raw, self.piece, self.buffer, self.member, self.rest = fs.open_input_stream(at, compression=None), piece, b"", None, b""

    def _fill(self) -> bool:
        while True:
            if not self.rest:
                self.rest = self.raw.read(self.piece)
                if not self.rest:
                    return False
            if self.member is None:
                self.member = zlib.decompressobj(31)
            data = self.member.decompress(self.rest, self.piece)
            self.rest = self.member.unconsumed_tail
            if self.member.eof:
                self.rest, self.member = self.member.unused_data, None
            if data:
                self.buffer += data
                return True

    def line(self) -> bytes | None:
        """The next line without its end, or None at the end of the file."""
        while (at := self.buffer.find(b"\n")) < 0:
            if not self._fill():
                return None
        line, self.buffer = self.buffer[:at], self.buffer[at + 1:]
        return line.rstrip(b"\r")

    def some(self, most: int) -> bytes:
        if not self.buffer and not self._fill():
            raise EOFError("archive ends inside a record")
        data, self.buffer = self.buffer[:most], self.buffer[most:]
        return data

    def exactly(self, n: int) -> bytes:
        got = []
        while n:
            got.append(self.some(n))
            n -= len(got[-1])
        return b"".join(got)


def read_records(path: str, chunk_bytes: int = CHUNK) -> Iterator[dict]:
    """Chunk rows of one archive: headers, chunk_no, data, running length and digest, is_last."""
    stream = _Inflated(path, min(chunk_bytes, 1 << 20))
    while (line := stream.line()) is not None:
        if not line.startswith(b"WARC/"):
            continue  # blank lines between records
        head = {}
        while line := stream.line():
            name, _, value = line.decode().partition(":")
            head[name.strip().lower()] = value.strip()
        left = int(head["content-length"])
        if left and "msgtype=response" in head.get("content-type", ""):
            while left:  # the HTTP header isn't payload
                line = stream.line()
                left -= len(line) + 2
                if not line:
                    break
        base = {"record_id": head["warc-record-id"].strip("<>"), "record_type": head["warc-type"], "url": head.get("warc-target-uri"),
                "refers_to": head.get("warc-refers-to", "").strip("<>") or None,
                "stated_digest": head.get("warc-payload-digest", "").removeprefix("sha1:") or None}
        digest, length, number = hashlib.sha1(), 0, 0
        while True:
            data = stream.exactly(min(left, chunk_bytes))
            left -= len(data)
            digest.update(data)
            length += len(data)
            yield base | {"chunk_no": number, "data": data, "bytes_so_far": length, "digest_so_far": digest.hexdigest(), "is_last": not left}
            number += 1
            if not left:
                break


READ_SCHEMA = ("path string, record_id string, record_type string, url string, refers_to string, stated_digest string, "
               "chunk_no int, data binary, bytes_so_far long, digest_so_far string, is_last boolean")
_ARROW = pa.schema([("path", pa.string()), ("record_id", pa.string()), ("record_type", pa.string()), ("url", pa.string()),
                    ("refers_to", pa.string()), ("stated_digest", pa.string()), ("chunk_no", pa.int32()), ("data", pa.binary()),
                    ("bytes_so_far", pa.int64()), ("digest_so_far", pa.string()), ("is_last", pa.bool_())])


def _read(chunk_bytes: int, with_data: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, held = [], 0
        for batch in batches:
            for path in batch.column("path").to_pylist():
                for row in read_records(path, chunk_bytes):
                    held += len(row["data"]) + 300
                    rows.append(row | {"path": path} | ({} if with_data else {"data": None}))
                    if held >= 4 * chunk_bytes or len(rows) >= 4096:
                        yield pa.RecordBatch.from_pylist(rows, _ARROW)
                        rows, held = [], 0
        if rows:
            yield pa.RecordBatch.from_pylist(rows, _ARROW)

    return run


def read_archives(archives: DataFrame, chunk_bytes: int = CHUNK, with_data: bool = True) -> DataFrame:
    """Chunk rows of the archives listed in ``path``; ``with_data=False`` leaves the bytes out (digests and lengths stay)."""
    n = max(1, archives.count())
    return archives.select("path").repartition(n).mapInArrow(_read(chunk_bytes, with_data), READ_SCHEMA)


# ---- table to archives ----------------------------------------------------

BLOCK = 10_000  # equal rows that one task writes out together


def archive(rows: DataFrame, id_col: str, url_col: str, payload: Column, dedupe_bytes: int = 1000, folder: str | None = None) -> DataFrame:
    """Write one record per row of ``rows``; returns the list of archives.

    Payloads are shuffled once, reduced to one of each group of equal rows;
    revisits never meet a payload, and a hot group's are dealt out in blocks.
    """
    spark: SparkSession = rows.sparkSession
    named = rows.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), F.coalesce(payload, F.lit(b"")).alias("payload"))
    named = (named.withColumn("payload_digest", F.sha1("payload")).withColumn("url_hash", F.xxhash64("url"))
             .withColumn("key", key_text(F.col("id"))))
    groups = (named.groupBy("id", "key", "url", "url_hash", F.length("payload").cast("long").alias("payload_bytes"), "payload_digest")
              .agg(F.count("*").alias("n")))
    groups = stage(decide(stage(groups, "warc-groups"), dedupe_bytes), "warc-kinds")

    def numbered(df: DataFrame, first: Column, count: Column, data: Column, kind: str, *, spread: bool) -> DataFrame:
        blocks = df.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((count - 1) / BLOCK))))
        blocks = blocks.repartition("key", "url_hash", "block") if spread else blocks
        upto = F.least(first + F.col("block") * BLOCK + BLOCK - 1, first + count - 1)
        nth = blocks.withColumn("nth", F.explode(F.sequence(first + F.col("block") * BLOCK, upto)))
        return nth.select(record_id(F.col("key"), F.col("url_hash"), F.col("nth")).alias("record_id"), F.lit(kind).alias("record_type"),
                          F.when(F.lit(kind == "revisit"), F.col("refers_to")).alias("refers_to"), "url", "payload_bytes",
                          "payload_digest", data.alias("payload"))

    by = ["key", "url_hash", "payload_digest"]
    payloads = named.select(*by, "payload").dropDuplicates(by)  # the join below keeps this partitioning
    answered = groups.filter("responses > 0").join(payloads, by)
    one = F.lit(1).cast("long")
    responses = numbered(answered, F.col("n") - F.col("responses") + 1, F.col("responses"), F.col("payload"), "response", spread=False)
    revisits = numbered(groups.filter("n > responses"), one, F.col("n") - F.col("responses"), F.lit(b""), "revisit", spread=True)
    return write_archives(chunk_rows(responses, "payload").unionByName(chunk_rows(revisits, "payload")), folder or shared_path(spark, "warc"))
