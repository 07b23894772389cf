"""WARC archives: written a gzip member a record, read back by splittable byte ranges.

Writing: records of equal payload share a digest; the one of the largest id is written in full (a
response), the others as revisits that name it. Payloads below ``revisit_bytes`` are always written
in full. Digests are gathered as (digest, largest id) with partial maxima; the pages then join that
narrow table, and Spark splits the join where one payload is very common. Every task writes one
archive of its own under a fresh name and reports it; only reported archives are read, so files of
failed attempts don't matter.

Reading: each archive is cut into byte ranges, which are dealt to tasks. A task looks for the gzip
magic from the start of its range, takes a place for a member's start only if a WARC header decodes
there, and owns every record that starts inside its range, reading the last one beyond the end.

Null payloads are empty ones. A record without id is written without one and can't be referred
to: records equal to none but such are all written in full. Repeated rows are records of
their own: of several rows with the largest id, all are responses.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallybook.llm.frames import prepare, stored, trimmed
from tallybook.session import shared_dir

REVISIT_BYTES = 0
SPLIT_BYTES = 4 << 20
READ_BYTES = 1 << 18
_MAGIC = b"\x1f\x8b\x08"
_VERSION = b"WARC/1.1\r\n"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_URN = "urn:page:"

RECORDS = ("record_id long, uri string, record_type string, refers_to long, payload_bytes long, "
           "payload_digest string, payload binary")


def place(path: str) -> tuple[pa.fs.FileSystem, str]:
    """File system and path inside it; a path without a scheme is a local one."""
    return pa.fs.FileSystem.from_uri(path if "://" in path else
                                     "file://" + path.removeprefix("file:"))


# -- writing -------------------------------------------------------------------------------

def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(kind: str, record_id: int | None, uri: str | None, refers_to: int | None,
           payload_digest: str, payload_bytes: int, payload: bytes) -> bytes:
    """One record: header lines, blank line, payload, two line ends."""
    lines = [f"WARC-Type: {kind}", f"WARC-Payload-Digest: sha1:{payload_digest}",
             f"X-Payload-Length: {payload_bytes}", f"Content-Length: {len(payload)}"]
    if record_id is not None:
        lines.append(f"WARC-Record-ID: <{_URN}{record_id}>")
    if uri is not None:
        lines.append(f"WARC-Target-URI: {quote(uri, safe=':/?#[]@!$&()*+,;=%~')}")
    if refers_to is not None:
        lines += [f"WARC-Refers-To: <{_URN}{refers_to}>", f"WARC-Profile: {_PROFILE}"]
    head = _VERSION + "".join(x + "\r\n" for x in lines).encode() + b"\r\n"
    return head + payload + b"\r\n\r\n"


def member(data: bytes) -> bytes:
    """Data as one gzip member."""
    packer = zlib.compressobj(1, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


def write(pages: DataFrame, folder: str, record_id: str = "page_id", payload: str = "html",
          uri: str | None = "url", revisit_bytes: int = REVISIT_BYTES) -> DataFrame:
    """Write all rows as archives under ``folder``; returns (path, bytes, records), materialised."""
    prepare(pages.sparkSession)
    body = F.coalesce(F.col(payload).cast("binary"), F.lit(b""))
    rows = pages.select(
        F.col(record_id).cast("long").alias("id"),
        (F.col(uri).cast("string") if uri else F.lit(None).cast("string")).alias("uri"),
        body.alias("payload"), F.unhex(F.sha1(body)).alias("digest"))
    # Written, so that both sides of the join are plain exchanges, which Spark splits if skewed.
    last = stored(rows.groupBy("digest").agg(F.max("id").alias("last")), "warc-digests")
    joined = rows.join(last, "digest").select(
        "id", "uri", "payload", "digest", F.when(
            (F.octet_length("payload") >= revisit_bytes) & ~F.col("id").eqNullSafe(F.col("last")),
            F.col("last")).alias("refers_to"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, path, size, count = None, "", 0, 0
        for batch in batches:
            for r in batch.to_pylist():
                if out is None:
                    path = f"{folder}/{uuid.uuid4().hex}.warc.gz"
                    system, inner = place(path)
                    system.create_dir(inner.rpartition("/")[0], recursive=True)
                    out = system.open_output_stream(inner, compression=None)
                again = r["refers_to"] is not None
                made = member(record(
                    "revisit" if again else "response", r["id"], r["uri"], r["refers_to"],
                    base64.b32encode(r["digest"]).decode(), len(r["payload"]),
                    b"" if again else r["payload"]))
                out.write(made)
                size, count = size + len(made), count + 1
        if out is not None:
            out.close()
            yield pa.RecordBatch.from_pylist([{"path": path, "bytes": size, "records": count}])

    return stored(joined.mapInArrow(trimmed(run), "path string, bytes long, records long"), "warc-manifest")


# -- reading -------------------------------------------------------------------------------

class Range:
    """Bytes of a file from a place on, read in steps; what was passed is let go."""

    def __init__(self, source, start: int, size: int):
        self.source, self.size, self.base, self.data = source, size, start, b""

    def upto(self, end: int) -> bool:
        """Hold bytes up to ``end``; false if the file ends before."""
        while self.base + len(self.data) < min(end, self.size):
            at = self.base + len(self.data)
            more = self.source.read_at(min(READ_BYTES, self.size - at), at)
            if not more:
                break
            self.data += more
        return self.base + len(self.data) >= end

    def drop(self, start: int) -> None:
        if start > self.base:
            self.data, self.base = self.data[start - self.base:], start

    def find_magic(self, at: int, end: int) -> int:
        """The first gzip magic that starts in [at, end), or -1."""
        while at < end:
            self.drop(at)
            self.upto(min(at + READ_BYTES, end + len(_MAGIC) - 1))
            found = self.data.find(_MAGIC, at - self.base)
            if found >= 0:
                return self.base + found if self.base + found < end else -1
            if self.base + len(self.data) >= min(end + len(_MAGIC) - 1, self.size):
                return -1
            at = self.base + max(at - self.base, len(self.data) - len(_MAGIC) + 1)
        return -1

    def starts_record(self, at: int) -> bool:
        """Whether a member at this place decodes to the beginning of a WARC header."""
        self.upto(at + 512)
        try:
            return zlib.decompressobj(31).decompress(
                self.data[at - self.base:at - self.base + 512], len(_VERSION)) == _VERSION
        except zlib.error:
            return False

    def member(self, at: int) -> tuple[bytes, int]:
        """The whole member at this place, and where the next one begins."""
        unpacker, parts = zlib.decompressobj(31), []
        self.drop(at)
        step = 0
        while not unpacker.eof:
            if not self.upto(at + step + 1):
                raise EOFError(f"archive ends inside the member at byte {at}")
            parts.append(unpacker.decompress(self.data[at + step - self.base:]))
            step = self.base + len(self.data) - at
        return b"".join(parts), self.base + len(self.data) - len(unpacker.unused_data)


def _number(value: str | None) -> int | None:
    return int(value.strip("<>").removeprefix(_URN)) if value is not None else None


def parse(data: bytes) -> dict:
    """A record's fields. Payloads of the wrong length or digest raise an error."""
    head, _, body = data.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    fields = dict(line.split(": ", 1) for line in lines[1:])
    payload = body[:int(fields["Content-Length"])]
    if len(body) != len(payload) + 4:
        raise ValueError("record of the wrong length")
    known = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    if fields["WARC-Type"] == "response" and digest(payload) != known:
        raise ValueError("payload doesn't have its digest")
    return {"record_id": _number(fields.get("WARC-Record-ID")),
            "uri": fields.get("WARC-Target-URI"), "record_type": fields["WARC-Type"],
            "refers_to": _number(fields.get("WARC-Refers-To")),
            "payload_bytes": int(fields["X-Payload-Length"]), "payload_digest": known,
            "payload": payload if fields["WARC-Type"] == "response" else None}


def records_in(source, size: int, start: int, end: int) -> Iterator[dict]:
    """Records that start in [start, end) of an archive of ``size`` bytes."""
    held = Range(source, start, size)
    at = held.find_magic(start, end)
    while 0 <= at < end and not held.starts_record(at):
        at = held.find_magic(at + 1, end)
    while 0 <= at < min(end, size):
        data, at = held.member(at)
        yield parse(data)


def read(manifest: DataFrame, split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """All records of the archives listed as (path, bytes), by ranges of ``split_bytes``."""
    ranges = manifest.select("path", "bytes", F.explode(F.sequence(
        F.lit(0).cast("long"), F.greatest(F.col("bytes") - 1, F.lit(0)),
        F.lit(split_bytes).cast("long"))).alias("start"))
    # A task a range or nearly so: their number follows the bytes, not the shuffle setting.
    count = manifest.agg(F.sum(F.ceil(F.col("bytes") / split_bytes))).first()[0] or 1
    dealt = ranges.repartition(max(1, int(count)), "path", "start")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [x.split()[0] for x in RECORDS.split(", ")]
        kinds = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string(),
                 pa.binary()]
        for batch in batches:
            for r in batch.to_pylist():
                system, inner = place(r["path"])
                with system.open_input_file(inner) as source:
                    held, size = [], 0
                    end = min(r["start"] + split_bytes, r["bytes"])
                    for found in records_in(source, r["bytes"], r["start"], end):
                        held.append(found)
                        size += found["payload_bytes"]
                        if size > SPLIT_BYTES:
                            yield _batch(held, names, kinds)
                            held, size = [], 0
                    if held:
                        yield _batch(held, names, kinds)

    return dealt.mapInArrow(trimmed(run), RECORDS)


def _batch(held: list[dict], names: list[str], kinds: list[pa.DataType]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([x[n] for x in held], k) for n, k in zip(names, kinds, strict=True)], names=names)


def archive(pages: DataFrame, name: str = "archives", **columns) -> DataFrame:
    """Write pages to a fresh folder in the shared place and read them back."""
    folder = f"{shared_dir(pages.sparkSession).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    return read(write(pages, folder, **columns))
