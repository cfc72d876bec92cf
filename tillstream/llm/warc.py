"""WARC archives: monolithic gzip in, one gzip member per record out.

``dump`` writes rows as WARC records into archives that are each one gzip
stream (as crawlers without record compression leave them). ``normalise``
inflates such a stream once, front to back, rewrites every record as a gzip
member of its own and writes a sidecar offset index next to the archive, so a
record can be read by one seek. On the way it can turn records into revisits
of a record with the same payload. ``read`` fetches records by the index.

Tasks write through Arrow file systems to the shared folder they are given,
under names of their own attempt; what counts is the table of rows they
return, so a task that is lost or run twice leaves only unused files. A task
holds one record at a time, an archive is closed at ``ARCHIVE_BYTES``, and
payloads never pass through a shuffle.

Defined results: a null payload is an empty one; a null id is written empty
and read back as null, and such a record is always a response; of rows that
repeat id and payload, the first in archive order is the response and the
others revisit it; control characters of a URL are percent-encoded and a null
URL has no header; a very long payload is one record, held whole; an
empty table gives no archive and an empty result; other columns are not read.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterable, Iterator
from urllib.parse import quote, unquote

import pandas as pd
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path
from .common import discard, remove, written

#: Bytes of records, before compression, at which an archive is closed.
ARCHIVE_BYTES = 32 << 20
#: Payloads of at least this size are stored once.
REVISIT_BYTES = 100
READ_BYTES = 1 << 20
#: Tasks that archives are spread over at most.
MOST_TASKS = 20_000
GZIP = 31  # zlib's window bits for gzip members
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

MANIFEST = "archive string, ordinal long, id string, payload_bytes long, payload_digest string"
INDEX = "archive string, offset long, length long, id string, record_type string"
RECORD = "id string, record_type string, refers_to string, payload_bytes long, payload_digest string"


def _uri(record_id: str) -> str:
    return f"<urn:page:{quote(record_id, safe='')}>"


def _from_uri(uri: str) -> str:
    return unquote(uri.removeprefix("<urn:page:").removesuffix(">"))


def record(headers: dict[str, str], block: bytes) -> bytes:
    head = "".join(f"{k}: {v}\r\n" for k, v in (headers | {"Content-Length": str(len(block))}).items())
    return b"WARC/1.1\r\n" + head.encode() + b"\r\n" + block + b"\r\n\r\n"


def response(record_id: str, url: str | None, payload: bytes, digest: str) -> bytes:
    headers = {"WARC-Type": "response", "WARC-Record-ID": _uri(record_id), "WARC-Date": "1970-01-01T00:00:00Z"}
    if url is not None:
        headers["WARC-Target-URI"] = "".join(quote(c) if c < " " or c == "\x7f" else c for c in url)
    headers |= {"WARC-Payload-Digest": f"sha256:{digest}", "Content-Type": "application/http;msgtype=response"}
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n"
    return record(headers, http.encode() + payload)


def as_revisit(headers: dict[str, str], block: bytes, refers_to: str) -> bytes:
    """The record without its payload, referring to one that has it."""
    headers = headers | {"WARC-Type": "revisit", "WARC-Refers-To": _uri(refers_to), "WARC-Profile": PROFILE}
    return record(headers, split_http(block)[0])


def split_http(block: bytes) -> tuple[bytes, bytes]:
    head, _, payload = block.partition(b"\r\n\r\n")
    return head + b"\r\n\r\n", payload


class Inflated:
    """Bytes of a gzip file, member after member, inflated front to back once."""

    def __init__(self, source):
        self.source, self.buffer, self.inflate, self.open = source, bytearray(), zlib.decompressobj(GZIP), False

    def _more(self) -> bool:
        raw = self.inflate.unused_data if self.inflate.eof else b""
        if self.inflate.eof:
            self.inflate, self.open = zlib.decompressobj(GZIP), False
        raw = self.inflate.unconsumed_tail or raw or self.source.read(READ_BYTES)
        if not raw:
            if self.open:
                raise EOFError("gzip stream cut off")
            return False
        self.open = True
        self.buffer += self.inflate.decompress(raw, READ_BYTES)
        if self.inflate.eof:
            self.open = False
        return True

    def line(self) -> bytes:
        while (at := self.buffer.find(b"\n")) < 0:
            if not self._more():
                return b""
        out = bytes(self.buffer[:at + 1])
        del self.buffer[:at + 1]
        return out

    def take(self, n: int) -> bytes:
        while len(self.buffer) < n:
            if not self._more():
                raise EOFError("record cut off")
        out = bytes(self.buffer[:n])
        del self.buffer[:n]
        return out


def records(source) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers, block) of every record of an open gzip file."""
    stream = Inflated(source)
    while version := stream.line():
        if not version.strip():
            continue
        if not version.startswith(b"WARC/"):
            raise ValueError(f"no WARC record at {version[:40]!r}")
        headers = {}
        while (line := stream.line().decode().rstrip("\r\n")):
            name, _, value = line.partition(":")
            headers[name] = value.strip()
        block = stream.take(int(headers.pop("Content-Length")))
        yield headers, block


def _member(data: bytes) -> bytes:
    z = zlib.compressobj(6, zlib.DEFLATED, GZIP)
    return z.compress(data) + z.flush()


def _attempt() -> str:
    task = TaskContext.get()
    return f"{task.partitionId():05d}-{task.taskAttemptId()}"


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


def _arrow(ddl: str) -> pa.Schema:
    kinds = {"string": pa.string(), "long": pa.int64()}
    return pa.schema([(n, kinds[t]) for n, t in (x.split() for x in ddl.split(", "))])


def dump(df: DataFrame, out_dir: str, record_id: str, url: str, payload: str,
         archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write each row as a response record; returns the manifest of records by archive."""
    schema = _arrow(MANIFEST)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, root = fs.FileSystem.from_uri(out_dir)
        rows, sink, zipper, size, number = [], None, None, 0, 0
        for batch in batches:
            for key, link, body in zip(*batch.columns):
                if sink is None:
                    files.create_dir(root, recursive=True)
                    name = f"raw-{_attempt()}-{number:04d}.warc.gz"
                    sink = files.open_output_stream(f"{root}/{name}", compression=None)
                    zipper = zlib.compressobj(6, zlib.DEFLATED, GZIP)
                data, text = body.as_py() or b"", key.as_py()
                digest = hashlib.sha256(data).hexdigest()
                raw = response(text or "", link.as_py(), data, digest)
                sink.write(zipper.compress(raw))
                rows.append((f"{out_dir}/{name}", len(rows), text, len(data), digest))
                size += len(raw)
                if size >= archive_bytes:
                    sink.write(zipper.flush())
                    sink.close()
                    yield _batch(rows, schema)
                    rows, sink, size, number = [], None, 0, number + 1
        if sink is not None:
            sink.write(zipper.flush())
            sink.close()
            yield _batch(rows, schema)

    return df.select(F.col(record_id).cast("string"), F.col(url).cast("string"),
                     F.col(payload).cast("binary")).mapInArrow(run, MANIFEST)


def revisits(manifest: DataFrame, least_bytes: int = REVISIT_BYTES, order: str = "long") -> DataFrame:
    """(archive, ordinal, refers_to) of records whose payload an earlier id has.

    Counts and minima per digest are combined map-side; the digests that occur
    twice are joined back (unique on that side; AQE splits a hot digest).
    """
    place = F.struct(F.col("id").cast(order).alias("key"), "archive", "ordinal", "id")
    large = manifest.where((F.col("payload_bytes") >= least_bytes) & F.col("id").isNotNull())
    firsts = written(large.groupBy("payload_digest").agg(F.count("*").alias("n"), F.min(place).alias("first"))
                     .where("n > 1").select("payload_digest", "first"), "first_payloads")
    return (large.join(firsts, "payload_digest")
            .where((F.col("archive") != F.col("first.archive")) | (F.col("ordinal") != F.col("first.ordinal")))
            .select("archive", "ordinal", F.col("first.id").alias("refers_to")))


def normalise(archives: DataFrame, out_dir: str, changes: DataFrame | None = None) -> DataFrame:
    """Rewrite archives record by record; returns the offset index.

    ``archives``: column ``archive``, one row each. ``changes``: (archive,
    ordinal, refers_to) of records to store as revisits. A group is one
    archive, bounded by its size; a stated number of partitions keeps the few
    bytes of places from being merged into a few tasks.
    """
    if changes is None:
        changes = archives.select("archive", F.lit(None).cast("long").alias("ordinal"),
                                  F.lit(None).cast("string").alias("refers_to")).limit(0)

    def run(group: pd.DataFrame) -> pd.DataFrame:
        raw = group["archive"].iloc[0]
        refers = {int(k): v for k, v in zip(group["ordinal"], group["refers_to"]) if pd.notna(k)}
        files, path = fs.FileSystem.from_uri(raw)
        out, root = fs.FileSystem.from_uri(out_dir)
        out.create_dir(root, recursive=True)
        name = f"{path.rsplit('/', 1)[-1].removesuffix('.warc.gz')}-{TaskContext.get().taskAttemptId()}"
        rows, offset = [], 0
        with files.open_input_stream(path, compression=None) as source, \
                out.open_output_stream(f"{root}/{name}.warc.gz", compression=None) as sink, \
                out.open_output_stream(f"{root}/{name}.cdx", compression=None) as index:
            for ordinal, (headers, block) in enumerate(records(source)):
                new = as_revisit(headers, block, refers[ordinal]) if ordinal in refers else record(headers, block)
                member = _member(new)
                kind = "revisit" if ordinal in refers else headers["WARC-Type"]
                sink.write(member)
                index.write(f"{offset} {len(member)} {kind} {headers['WARC-Record-ID']} "
                            f"{headers.get('WARC-Payload-Digest', '-')}\n".encode())
                rows.append((f"{out_dir}/{name}.warc.gz", offset, len(member),
                             _from_uri(headers["WARC-Record-ID"]) or None, kind))
                offset += len(member)
        return pd.DataFrame(rows, columns=[x.split()[0] for x in INDEX.split(", ")])

    return (archives.select("archive").join(changes, "archive", "left")
            .repartition(_tasks(archives), "archive").groupBy("archive").applyInPandas(run, INDEX))


def _tasks(archives: DataFrame) -> int:
    """Tasks for work by archive: one each, up to ``MOST_TASKS``."""
    return max(1, min(MOST_TASKS, archives.select("archive").distinct().count()))


def read(index: DataFrame) -> DataFrame:
    """Records by their places: (id, record_type, refers_to, payload_bytes, payload_digest).

    A response's size and digest are those of the payload read; a revisit's
    are in its own headers (the payload is the referred record's).
    """
    schema = _arrow(RECORD)

    def parse(headers: dict[str, str], block: bytes) -> tuple:
        http, payload = split_http(block)
        record_id = _from_uri(headers["WARC-Record-ID"]) or None
        if headers["WARC-Type"] == "revisit":
            size = next(int(x.split(b":")[1]) for x in http.split(b"\r\n") if x.lower().startswith(b"content-length:"))
            return (record_id, "revisit", _from_uri(headers["WARC-Refers-To"]), size,
                    headers["WARC-Payload-Digest"].removeprefix("sha256:"))
        return record_id, headers["WARC-Type"], None, len(payload), hashlib.sha256(payload).hexdigest()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        opened, source = None, None
        for batch in batches:
            rows = []
            for archive, offset, length in zip(*(c.to_pylist() for c in batch.columns)):
                if archive != opened:
                    if source is not None:
                        source.close()
                    files, path = fs.FileSystem.from_uri(archive)
                    opened, source = archive, files.open_input_file(path)
                source.seek(offset)
                [(headers, block)] = records(pa.BufferReader(source.read(length)))
                rows.append(parse(headers, block))
            if rows:
                yield _batch(rows, schema)
        if source is not None:
            source.close()

    return (index.select("archive", "offset", "length").repartition(_tasks(index), "archive")
            .sortWithinPartitions("archive", "offset").mapInArrow(run, RECORD))


def store_and_read(df: DataFrame, record_id: str, url: str, payload: str, out_dir: str | None = None) -> DataFrame:
    """Dump, normalise with revisits, and read back through the index."""
    spark: SparkSession = df.sparkSession
    scratch = None if out_dir else scratch_path(spark, "llm", "warc")
    out_dir = out_dir or scratch
    kind = df.schema[record_id].dataType.simpleString()
    manifest = written(dump(df, f"{out_dir}/raw", record_id, url, payload), "manifest")
    index = written(normalise(manifest.select("archive").distinct(), f"{out_dir}/records",
                              revisits(manifest, order=kind)), "warc_index")
    discard(manifest)
    if scratch:  # the index is written: nothing reads the archives as they came any more
        remove(spark, f"{scratch}/raw")
    back: Column = F.col("id").cast(kind).alias(record_id)
    return read(index).select(back, "payload_bytes", "payload_digest", "record_type",
                              F.col("refers_to").cast(kind).alias("refers_to"))
