"""WARC archives: writing one gzip stream a file, normalising it to one member a record, and reading records by offset.

A crawler may write a whole archive as one gzip stream, which can only be read from its start. The normaliser inflates
such a stream once, block by block, and rewrites every record as a gzip member of its own beside a sidecar index of
offsets, so that any record can then be read alone.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluiceway.llm.shared import file_system, fresh_folder, stored

BLOCK = 1 << 20
#: Records in one row of the normaliser's manifest, which is what one reading task gets at least.
SLICE = 5_000
_ID = re.compile(r"<urn:page:(-?\d+|none)>")


def _open_for_writing(uri: str):
    store, path = file_system(uri)
    store.create_dir(path.rpartition("/")[0], recursive=True)
    return store.open_output_stream(path, compression=None)


def _open_for_reading(uri: str):
    store, path = file_system(uri)
    return store.open_input_file(path)


def record_id(page_id: int | None) -> str:
    return f"<urn:page:{'none' if page_id is None else page_id}>"


def page_of(name: str | None) -> int | None:
    found = _ID.fullmatch(name or "")
    return int(found[1]) if found and found[1] != "none" else None


def _clean(url: str) -> str:
    """Control characters and line ends would end a header line."""
    return re.sub(r"[\x00-\x1f\x7f]", lambda m: f"%{ord(m[0]):02X}", url)


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, revisit: bool, date: str) -> bytes:
    """A response record with its payload, or a revisit record with the response's HTTP header alone."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {record_id(page_id)}", f"WARC-Date: {date}"]
    if url is not None:
        head.append(f"WARC-Target-URI: {_clean(url)}")
    head.append(f"WARC-Payload-Digest: sha1:{digest}")
    if revisit:
        head += [f"WARC-Refers-To: {record_id(refers_to)}", "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _write(folder: str, date: str, level: int, roll_bytes: int):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = stream = uri = None
        records = size = number = 0
        done = []

        def finish():
            out.write(stream.flush())
            out.close()
            done.append((uri, records))

        for batch in batches:
            columns = (batch[c].to_pylist() for c in ("page_id", "url", "payload", "refers_to", "revisit"))
            for page_id, url, payload, refers_to, revisit in zip(*columns, strict=True):
                if out is None:
                    uri = f"{folder}/{TaskContext.get().partitionId():06d}-{number:04d}-{uuid.uuid4().hex}.warc.gz"
                    out, stream, records, size = _open_for_writing(uri), zlib.compressobj(level, zlib.DEFLATED, 31), 0, 0
                    number += 1
                data = record(page_id, url, payload, base32_sha1(payload), refers_to, revisit, date)
                out.write(stream.compress(data))
                records, size = records + 1, size + len(data)
                if size >= roll_bytes:
                    finish()
                    out = None
        if out is not None:
            finish()
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*done, strict=True)], names=["uri", "records"])

    return write


def write_archives(
    pages: DataFrame, folder: str, revisit_from: int = 0, date: str = "2000-01-01T00:00:00Z", level: int = 6, roll_bytes: int = 1 << 30
) -> DataFrame:
    """Write one record for each row of ``pages`` (page_id, url, html) to monolithic archives below ``folder``.

    The payload is the html in UTF-8; null is empty. Of the records with one payload of at least ``revisit_from`` bytes,
    that with the largest page_id is the response and the others are revisits of it; rows without page_id
    come behind all others, and rows that repeat the largest page_id, or that all have none, are responses each. A null url is
    left out. Returns the stored manifest ``uri, records``; an empty table writes no archive.

    Only page_ids and digests are grouped, the copies of a payload summed up before they meet; the html crosses the
    network only if the list of revisits is too long to broadcast.
    """
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    known = pages.select("page_id", "url", payload.alias("payload")).withColumn("digest", F.sha1("payload"))
    digests = known.filter(F.octet_length("payload") >= revisit_from).select("page_id", "digest")
    groups = stored(digests.groupBy("digest").agg(F.max("page_id").alias("refers_to"), F.count("*").alias("n")).filter("n > 1 AND refers_to IS NOT NULL"))
    copies = digests.join(groups, "digest").filter("page_id IS NULL OR page_id < refers_to")
    copies = stored(copies.select(F.col("page_id").alias("copy"), F.col("digest").alias("copied"), "refers_to").distinct())
    marked = known.join(copies, known["page_id"].eqNullSafe(copies["copy"]) & (known["digest"] == copies["copied"]), "left")
    rows = marked.select("page_id", "url", "payload", "refers_to", F.col("copied").isNotNull().alias("revisit"))
    return stored(rows.mapInArrow(_write(folder, date, level, roll_bytes), "uri string, records bigint"))


class Inflated:
    """The bytes of a gzip file of one or many members, inflated block by block as they are asked for."""

    def __init__(self, file):
        self.file, self.engine, self.rest = file, zlib.decompressobj(31), b""
        self.held = bytearray()

    def more(self) -> bool:
        while True:
            if self.engine.eof:
                self.rest, self.engine = self.engine.unused_data, zlib.decompressobj(31)
            data = self.rest or self.file.read(BLOCK)
            self.rest = b""
            if not data:
                return False
            found = self.engine.decompress(data, BLOCK)
            self.rest = self.engine.unconsumed_tail
            if found:
                self.held += found
                return True

    def line_block(self) -> bytes | None:
        """Up to and with the next empty line; None at the end."""
        at = -1
        while (at := self.held.find(b"\r\n\r\n", max(0, at))) < 0:
            at = len(self.held) - 3
            if not self.more():
                return None
        return self.take(at + 4)

    def take(self, n: int) -> bytes:
        while len(self.held) < n:
            if not self.more():
                raise ValueError("the archive ends within a record")
        data = bytes(self.held[:n])
        del self.held[:n]
        return data

    def pieces(self, n: int) -> Iterator[bytes]:
        """The next ``n`` bytes, a block at a time."""
        while n:
            data = self.take(min(n, BLOCK))
            n -= len(data)
            yield data


def headers(block: bytes) -> dict[str, str]:
    lines = block.decode("utf-8", "replace").split("\r\n")
    return {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in lines[1:] if line)}


def _normalise(folder: str, level: int):
    def rewrite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for uri in batch["uri"].to_pylist():
                target = f"{folder}/{uuid.uuid4().hex}.warc.gz"
                source, out, index = _open_for_reading(uri), _open_for_writing(target), _open_for_writing(f"{target}.idx")
                stream, offset, index_at, slices, lines = Inflated(source), 0, 0, [], []

                def flush():
                    nonlocal index_at
                    data = "".join(lines).encode()
                    index.write(data)
                    slices.append((target, index_at, len(data), len(lines)))
                    index_at += len(data)
                    lines.clear()

                while (head := stream.line_block()) is not None:
                    fields = headers(head)
                    member = zlib.compressobj(level, zlib.DEFLATED, 31)
                    size = out.write(member.compress(head))
                    for piece in stream.pieces(int(fields["content-length"])):
                        size += out.write(member.compress(piece))
                    size += out.write(member.compress(stream.take(4)) + member.flush())
                    lines.append(f"{fields['warc-record-id']}\t{fields['warc-type']}\t{offset}\t{size}\n")
                    offset += size
                    if len(lines) == SLICE:
                        flush()
                if lines:
                    flush()
                for file in (source, out, index):
                    file.close()
                if slices:
                    columns = zip(*slices, strict=True)
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["uri", "index_start", "index_bytes", "records"])

    return rewrite


def normalise(archives: DataFrame, folder: str, level: int = 6) -> DataFrame:
    """Rewrite archives (uri) below ``folder`` with one gzip member a record, and an index ``<archive>.idx`` beside each.

    A line of the index is record id, type, offset and length of the member, tab-separated. Returns the stored manifest ``uri,
    index_start, index_bytes, records``: a row for each slice of an index. One task an archive; it holds one block.
    """
    files = max(1, archives.count())
    return stored(
        archives.select("uri").repartition(files).mapInArrow(_normalise(folder, level), "uri string, index_start bigint, index_bytes bigint, records bigint")
    )


def _records(with_payload: bool):
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["page_id", "target_uri", "payload_bytes", "payload_digest", "record_type", "refers_to"] + ["payload"] * with_payload
        kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary()]
        for batch in batches:
            for uri, start, size in zip(*(batch[c].to_pylist() for c in ("uri", "index_start", "index_bytes")), strict=True):
                index = _open_for_reading(f"{uri}.idx")
                index.seek(start)
                lines = index.read(size).decode().splitlines()
                index.close()
                archive, rows, held = _open_for_reading(uri), [], 0
                for line in lines:
                    name, kind, offset, length = line.rsplit("\t", 3)
                    archive.seek(int(offset))
                    data = zlib.decompress(archive.read(int(length)), 31)
                    head, _, rest = data.partition(b"\r\n\r\n")
                    fields = headers(head)
                    block = rest[: int(fields["content-length"])]
                    http, _, payload = block.partition(b"\r\n\r\n")
                    said = fields["warc-payload-digest"].removeprefix("sha1:")
                    if kind == "response":
                        if base32_sha1(payload) != said:
                            raise ValueError(f"record {name} of {uri} is damaged")
                        n = len(payload)
                    else:
                        n = int(headers(http)["content-length"])
                    row = (page_of(name), fields.get("warc-target-uri"), n, said, kind, page_of(fields.get("warc-refers-to")))
                    rows.append((*row, payload if kind == "response" else None) if with_payload else row)
                    held += len(payload)
                    if len(rows) == SLICE or with_payload and held > 8 * BLOCK:
                        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=False)], names=names)
                        rows, held = [], 0
                archive.close()
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=False)], names=names)

    return read


def read_records(slices: DataFrame, with_payload: bool = False) -> DataFrame:
    """Every record of normalised archives, each read alone by its offset, its digest checked.

    ``page_id, target_uri, payload_bytes, payload_digest, record_type, refers_to`` and, if asked for, ``payload`` (null for revisits).
    """
    schema = "page_id bigint, target_uri string, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint"
    rows = max(1, slices.count())
    return slices.select("uri", "index_start", "index_bytes").repartition(rows).mapInArrow(
        _records(with_payload), schema + ", payload binary" * with_payload
    )


def archive_round_trip(pages: DataFrame, folder: str | None = None) -> DataFrame:
    """Write ``pages`` as monolithic archives, normalise them and read every record back; see the functions above."""
    folder = folder or fresh_folder(pages.sparkSession)
    return read_records(normalise(write_archives(pages, f"{folder}/monolithic"), f"{folder}/members"))
