"""WARC archives: one gzip member per record, read one after the other."""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterable, Iterator
from urllib.parse import quote, unquote

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from uptrail.llm.common import place, scratch, written

# Fixed values of the format (ISO 28500).
VERSION = b"WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "2024-01-01T00:00:00Z"
CHUNK = 1 << 16
#: A record header longer than this is not one.
LONGEST_HEADER = 1 << 20

SCHEMA = ("key string, type string, refers string, uri string, payload_bytes long, "
          "payload_digest string, block_bytes long, file string, place long")


class WarcError(ValueError):
    """An archive that does not hold what its headers say."""


def digest(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def record(key: str, uri: str | None, payload: bytes, kind: str, refers: str | None) -> bytes:
    """One compressed record. A revisit has the header of the answer, not its payload."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http + (payload if kind == "response" else b"")
    head = [("WARC-Type", kind), ("WARC-Record-ID", f"<urn:row:{quote(key, safe='')}>"),
            ("WARC-Date", DATE), ("WARC-Target-URI", quote(uri or "", safe=":/?#[]@!$&'()*+,;=%"))]
    if refers is not None:
        head += [("WARC-Profile", PROFILE), ("WARC-Refers-To", f"<urn:row:{quote(refers, safe='')}>")]
    head += [("WARC-Payload-Digest", f"sha1:{digest(payload)}"), ("WARC-Block-Digest", f"sha1:{digest(block)}"),
             ("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block)))]
    text = "".join(f"{k}: {v}\r\n" for k, v in head)
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(VERSION + b"\r\n" + text.encode() + b"\r\n" + block + b"\r\n\r\n") + packer.flush()


def members(stream) -> Iterator[tuple[int, Iterator[bytes]]]:
    """The place of each gzip member and its bytes, piece by piece. A member must be used up."""
    rest, at = stream.read(CHUNK), 0
    while rest:
        start = at

        def pieces() -> Iterator[bytes]:
            nonlocal rest, at
            unpacker = zlib.decompressobj(31)
            while not unpacker.eof:
                data = unpacker.unconsumed_tail or rest
                fresh = not unpacker.unconsumed_tail
                out = unpacker.decompress(data, CHUNK)
                if not data and not out and not unpacker.eof:
                    raise WarcError(f"the member at {start} is cut off")
                at += len(data) - len(unpacker.unconsumed_tail) - len(unpacker.unused_data)
                if fresh:
                    rest = b""
                if unpacker.eof:
                    rest = unpacker.unused_data
                elif not unpacker.unconsumed_tail:
                    rest = stream.read(CHUNK)
                if out:
                    yield out
            if not rest:
                rest = stream.read(CHUNK)

        yield start, pieces()


def until(buffer: bytearray, pieces: Iterator[bytes], mark: bytes, start: int) -> bytes:
    """What comes before the mark; both are taken off the buffer."""
    seen = 0
    while (end := buffer.find(mark, max(0, seen - len(mark)))) < 0:
        seen = len(buffer)
        if seen > LONGEST_HEADER or (piece := next(pieces, None)) is None:
            raise WarcError(f"the record at {start} has no whole header")
        buffer += piece
    head = bytes(buffer[:end])
    del buffer[:end + len(mark)]
    return head


def fields(head: bytes) -> dict[str, str]:
    pairs = (line.partition(":") for line in head.decode().split("\r\n")[1:])
    return {k.strip().lower(): v.strip() for k, _, v in pairs}


def read_file(stream, file: str, payloads: bool = False) -> Iterator[dict]:
    """The records of an archive in its order. Never holds more than a piece of a payload, unless
    payloads are asked for. Raises WarcError on a wrong length or digest."""
    for start, pieces in members(stream):
        buffer = bytearray()
        lines = until(buffer, pieces, b"\r\n\r\n", start)
        if not lines.startswith(VERSION):
            raise WarcError(f"no record at {start}")
        head = fields(lines)
        left = length = int(head["content-length"])
        block, payload, body, kept = hashlib.sha1(), hashlib.sha1(), 0, []
        http, opening = None, bytearray()
        while left:
            if not buffer:
                piece = next(pieces, None)
                if piece is None:
                    raise WarcError(f"the record at {start} ends {left} bytes early")
                buffer += piece
            part = bytes(buffer[:left])
            del buffer[:left]
            left -= len(part)
            block.update(part)
            if http is None:
                opening += part
                if len(opening) > LONGEST_HEADER + CHUNK:
                    raise WarcError(f"the block at {start} has no whole header")
                if (end := opening.find(b"\r\n\r\n")) < 0:
                    continue
                http, part = fields(bytes(opening[:end])), bytes(opening[end + 4:])
            payload.update(part)
            body += len(part)
            if payloads:
                kept.append(part)
        tail = bytes(buffer) + b"".join(pieces)
        if tail != b"\r\n\r\n":
            raise WarcError(f"the record at {start} does not end after {length} bytes")
        if head["warc-block-digest"] != "sha1:" + base64.b32encode(block.digest()).decode():
            raise WarcError(f"the block at {start} does not match its digest")
        said = head["warc-payload-digest"].removeprefix("sha1:")
        size = int((http or {}).get("content-length", body))
        if head["warc-type"] == "response" and (said, size) != (base64.b32encode(payload.digest()).decode(), body):
            raise WarcError(f"the payload at {start} does not match its header")
        name = lambda x: None if x is None else unquote(x.removeprefix("<urn:row:").removesuffix(">"))
        row = {"key": name(head["warc-record-id"]), "type": head["warc-type"], "refers": name(head.get("warc-refers-to")),
               "uri": head["warc-target-uri"], "payload_bytes": size, "payload_digest": said,
               "block_bytes": length, "file": file, "place": start}
        yield row | ({"payload": b"".join(kept)} if payloads else {})


def marked(pages: DataFrame, key: str, payload: str, least: int = 0) -> DataFrame:
    """Adds _kind and _refers: of records with equal payloads of at least `least` bytes the one with
    the largest key is the response.

    Only payloads that occur more than once are joined back, by digest. Each row carries the
    digest, no group is collected; a frequent digest is split by the adaptive join.
    """
    data = F.coalesce(F.col(payload).cast("binary"), F.lit(b""))
    rows = pages.withColumns({"_digest": F.sha1(data), "_bytes": F.length(data)})
    groups = (rows.where(F.col("_bytes") >= least).groupBy("_digest")
              .agg(F.max(key).alias("_first"), F.count("*").alias("_n")).where("_n > 1")
              .withColumnRenamed("_digest", "_d"))
    groups = written(groups, "warc-groups")  # with an exchange of its own, the join can split a hot digest
    return rows.join(groups, (rows["_digest"] == groups["_d"]) & (rows["_bytes"] >= least), "left")


def write(pages: DataFrame, folder: str, key: str = "page_id", uri: str = "url", payload: str = "html",
          least: int = 0) -> DataFrame:
    """Writes every row as a record, each task its own archive; returns the table of archives.

    Null payload: empty. Null uri: empty. Null key: the empty key, smaller than all others. Rows
    that share the largest key and the payload are all responses. Other columns are left out. A task that runs again
    writes the archive under another name; only archives in the returned table count.
    """
    rows = marked(pages.select(F.col(key), F.col(uri), F.col(payload)), key, payload, least)
    text = F.coalesce(F.col(key).cast("string"), F.lit(""))
    single = F.col("_n").isNull() | (F.col("_first").isNull() & F.col(key).isNull()) | (F.col(key) == F.col("_first"))
    rows = rows.select(text.alias("key"), F.col(uri).cast("string").alias("uri"),
                       F.coalesce(F.col(payload).cast("binary"), F.lit(b"")).alias("payload"),
                       F.coalesce(single, F.lit(False)).alias("single"),
                       F.coalesce(F.col("_first").cast("string"), F.lit("")).alias("first"))

    def archives(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = place(folder)
        system.create_dir(root, recursive=True)
        name = f"{uuid.uuid4().hex}.warc.gz"
        n = size = 0
        out = None
        for batch in batches:
            for i in range(batch.num_rows):
                if out is None:
                    out = system.open_output_stream(f"{root}/{name}", compression=None)
                key, uri, payload, single, first = (c[i].as_py() for c in batch.columns)
                data = record(key, uri, payload, *(("response", None) if single else ("revisit", first)))
                out.write(data)
                n, size = n + 1, size + len(data)
        if out is not None:
            out.close()
            yield pa.RecordBatch.from_pydict({"file": [name], "records": [n], "bytes": [size]})

    return written(rows.mapInArrow(archives, "file string, records long, bytes long"), "warc-files")


def read(archives: DataFrame, folder: str, payloads: bool = False) -> DataFrame:
    """The records of the archives, each archive read in order by one task."""
    schema = SCHEMA + (", payload binary" if payloads else "")
    tasks = archives.count()

    def records(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = place(folder)
        for batch in batches:
            for file in batch.column("file").to_pylist():
                rows, held = [], 0
                with system.open_input_stream(f"{root}/{file}", compression=None) as stream:
                    for row in read_file(stream, file, payloads):
                        rows.append(row)
                        held += len(row.get("payload", b""))
                        if len(rows) >= 2000 or held > 8 << 20:
                            yield pa.RecordBatch.from_pylist(rows, schema=kinds(payloads))
                            rows, held = [], 0
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema=kinds(payloads))

    files = archives.select("file").repartition(max(1, tasks))
    return files.mapInArrow(records, schema)


def kinds(payloads: bool) -> pa.Schema:
    named = [(x.split()[0], pa.int64() if x.split()[1] == "long" else pa.string()) for x in SCHEMA.split(", ")]
    return pa.schema(named + ([("payload", pa.binary())] if payloads else []))


def round_trip(pages: DataFrame, key: str = "page_id", uri: str = "url", payload: str = "html",
               least: int = 0) -> DataFrame:
    """Writes the rows as archives in the shared folder and reads them back."""
    folder = scratch(pages.sparkSession, "warc")
    return read(write(pages, folder, key, uri, payload, least), folder)
