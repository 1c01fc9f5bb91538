"""Token-id files: one array of ids, with document boundaries and document ids in Elias-Fano code.

A non-decreasing sequence of n numbers below u takes about 2 + log2(u / n) bits a number: the low bits of
each as they are, the high bits as a unary bit vector. A sample of the places of its ones, one in ``SAMPLE``, lets
``select`` find any number by looking at a few bytes.

A file is: the ids (2 or 4 bytes, little-endian); the boundaries; the document ids; a JSON footer; its length in 4 bytes;
the magic ``EFT1``. Boundaries hold where each document ends.
"""

from __future__ import annotations

import json
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sluiceway.llm.shared import chunks, file_system, fresh_folder, stored, texts_of
from sluiceway.llm.tokens import encoder

MAGIC = b"EFT1"
SAMPLE = 256


class EliasFano:
    """A non-decreasing sequence of unsigned numbers in near-minimal space."""

    def __init__(self, size: int, low_bits: int, low: bytes, high: bytes, samples: bytes):
        self.size, self.low_bits = size, low_bits
        self.low, self.high = np.frombuffer(low, np.uint8), np.frombuffer(high, np.uint8)
        self.samples = np.frombuffer(samples, "<u4")

    @classmethod
    def encode(cls, values: np.ndarray) -> EliasFano:
        values = np.asarray(values, np.uint64)
        n = len(values)
        if not n:
            return cls(0, 0, b"", b"", b"")
        bits = max(0, ((int(values[-1]) + 1) // n).bit_length() - 1)
        low, shifts = b"", np.arange(bits, dtype=np.uint64)
        if bits:  # a slice at a time: a number's bits take 8 bytes each until they are packed; slices end at whole bytes
            slices = (values[i : i + 8 * SAMPLE] for i in range(0, n, 8 * SAMPLE))
            low = b"".join(np.packbits(((v[:, None] >> shifts) & np.uint64(1)).astype(np.uint8), bitorder="little").tobytes() for v in slices)
        ones = (values >> np.uint64(bits)).astype(np.int64) + np.arange(n)
        marks = np.zeros(int(ones[-1]) + 1, np.uint8)
        marks[ones] = 1
        return cls(n, bits, low, np.packbits(marks, bitorder="little").tobytes(), ones[::SAMPLE].astype("<u4").tobytes())

    def run(self, start: int, stop: int) -> np.ndarray:
        """Numbers ``start`` to ``stop``, that one left out: select for all of them at once, from the last sample before the first."""
        start, stop = max(0, start), min(stop, self.size)
        if start >= stop:
            return np.zeros(0, np.uint64)
        block, after = start // SAMPLE, (stop - 1) // SAMPLE + 1
        first = int(self.samples[block]) // 8
        upto = int(self.samples[after]) // 8 + 1 if after < len(self.samples) else len(self.high)
        marks = np.flatnonzero(np.unpackbits(self.high[first:upto], bitorder="little"))
        before = int(np.searchsorted(marks, int(self.samples[block]) - first * 8)) + start - block * SAMPLE
        values = (marks[before : before + stop - start] + first * 8 - np.arange(start, stop)).astype(np.uint64) << np.uint64(self.low_bits)
        if self.low_bits:
            begin, end = start * self.low_bits, stop * self.low_bits
            bits = np.unpackbits(self.low[begin // 8 : (end + 7) // 8], bitorder="little")[begin % 8 : begin % 8 + end - begin]
            weights = np.uint64(1) << np.arange(self.low_bits, dtype=np.uint64)
            values |= bits.reshape(-1, self.low_bits) @ weights
        return values

    def decode(self, at_once: int = 16 * SAMPLE) -> Iterator[np.ndarray]:
        """All numbers, a run at a time."""
        for i in range(0, self.size, at_once):
            yield self.run(i, i + at_once)

    def select(self, i: int) -> int:
        """Number ``i``: the high part from the place of its one, which lies behind the last sample before it."""
        if not 0 <= i < self.size:
            raise IndexError(i)
        block, rest = divmod(i, SAMPLE)
        first = int(self.samples[block]) // 8
        upto = int(self.samples[block + 1]) // 8 + 1 if block + 1 < len(self.samples) else len(self.high)
        marks = np.flatnonzero(np.unpackbits(self.high[first:upto], bitorder="little"))
        before = int(np.searchsorted(marks, int(self.samples[block]) - first * 8))
        value = (int(marks[before + rest]) + first * 8 - i) << self.low_bits
        if self.low_bits:
            start = i * self.low_bits
            piece = int.from_bytes(self.low[start // 8 : (start + self.low_bits + 7) // 8].tobytes(), "little")
            value |= (piece >> (start % 8)) & ((1 << self.low_bits) - 1)
        return value

    def parts(self) -> tuple[dict, list[bytes]]:
        data = [self.low.tobytes(), self.high.tobytes(), self.samples.tobytes()]
        return {"size": self.size, "low_bits": self.low_bits, "bytes": [len(d) for d in data]}, data

    @classmethod
    def read(cls, spec: dict, source) -> EliasFano:
        return cls(spec["size"], spec["low_bits"], *(source.read(n) for n in spec["bytes"]))


class TokenFile:
    """A file of this module, opened for reading: any document's ids without reading the others'."""

    def __init__(self, uri: str):
        store, path = file_system(uri)
        self.file = store.open_input_file(path)
        end = self.file.size()
        self.file.seek(end - 8)
        tail = self.file.read(8)
        if tail[4:] != MAGIC:
            raise ValueError(f"{uri} is not a token-id file")
        length = int.from_bytes(tail[:4], "little")
        self.file.seek(end - 8 - length)
        self.footer = json.loads(self.file.read(length))
        self.kind = np.dtype(self.footer["kind"])
        self.file.seek(self.footer["n_ids"] * self.kind.itemsize)
        self.ends = EliasFano.read(self.footer["ends"], self.file)
        self.doc_ids = EliasFano.read(self.footer["doc_ids"], self.file)
        self.n_docs = self.ends.size

    def _read(self, start: int, stop: int) -> np.ndarray:
        self.file.seek(start * self.kind.itemsize)
        return np.frombuffer(self.file.read((stop - start) * self.kind.itemsize), self.kind)

    def document(self, i: int) -> np.ndarray:
        """The ids of the document at place ``i``, found by select."""
        return self._read(self.ends.select(i - 1) if i else 0, self.ends.select(i))

    def names(self, start: int, stop: int) -> list[int | None]:
        """The ids of the documents at places ``start`` to ``stop``; those without one come first."""
        n_null = self.footer["n_null"]
        known = self.doc_ids.run(start - n_null, stop - n_null) + np.uint64(self.footer["first_id"] % 2**64)
        return [None] * (min(stop, n_null) - min(start, n_null)) + known.view(np.int64).tolist()

    def documents(self, at_once: int = 1_000_000, places: int = 16 * SAMPLE) -> Iterator[tuple[int | None, int, np.ndarray]]:
        """Each document's id, start and ids. Runs of ``places`` boundaries are selected at a time, and about ``at_once`` ids are held."""
        last = 0
        for first in range(0, self.n_docs, places):
            edges = np.concatenate([[last], self.ends.run(first, first + places).astype(np.int64)])
            names, i = self.names(first, min(first + places, self.n_docs)), 0
            while i < len(names):
                j = max(i + 1, int(np.searchsorted(edges, edges[i] + at_once, "right")) - 1)
                ids = self._read(int(edges[i]), int(edges[j]))
                for k in range(i, j):
                    yield names[k], int(edges[k]), ids[edges[k] - edges[i] : edges[k + 1] - edges[i]]
                i = j
            last = int(edges[-1])

    def close(self) -> None:
        self.file.close()


class TokenFileWriter:
    """Writes a file of this module; ids go out as they come."""

    def __init__(self, uri: str, largest_id: int):
        store, path = file_system(uri)
        store.create_dir(path.rpartition("/")[0], recursive=True)
        self.out = store.open_output_stream(path, compression=None)
        self.kind = np.dtype("<u2" if largest_id < 2**16 else "<u4")
        self.sizes: list[np.ndarray] = []
        self.doc_ids: list[np.ndarray] = []
        self.n_null = self.n_ids = 0

    def add(self, doc_ids: list[int | None], ids: np.ndarray, sizes: np.ndarray) -> None:
        """Documents in ascending order of their ids, those without one first."""
        self.out.write(ids.astype(self.kind).tobytes())
        known = [d for d in doc_ids if d is not None]
        self.n_null += len(doc_ids) - len(known)
        self.n_ids += len(ids)
        self.doc_ids.append(np.array(known, np.int64))
        self.sizes.append(np.asarray(sizes, np.int64))

    def close(self) -> None:
        doc_ids = np.concatenate(self.doc_ids) if self.doc_ids else np.zeros(0, np.int64)
        first = int(doc_ids[0]) if len(doc_ids) else 0
        ends = np.cumsum(np.concatenate(self.sizes)) if self.sizes else np.zeros(0, np.int64)
        footer = {"kind": self.kind.str, "n_ids": self.n_ids, "n_null": self.n_null, "first_id": first}
        for name, values in (("ends", ends), ("doc_ids", doc_ids.view(np.uint64) - np.uint64(first % 2**64))):
            footer[name], data = EliasFano.encode(values).parts()
            for part in data:
                self.out.write(part)
        text = json.dumps(footer).encode()
        self.out.write(text + len(text).to_bytes(4, "little") + MAGIC)
        self.out.close()


def _write(folder: str, vocabulary: str, end_id: int):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = encoder(vocabulary, blanks=True)
        shard, writer = TaskContext.get().partitionId(), None
        uri = f"{folder}/shard-{shard:06d}-{uuid.uuid4().hex}.ids"  # each attempt has a file of its own
        for batch in batches:
            for part in chunks(batch, "text"):
                writer = writer or TokenFileWriter(uri, max(end_id, code.tokenizer.get_vocab_size()))
                ids, sizes = code.encode(texts_of(part))
                ids = np.insert(ids, np.cumsum(sizes), np.uint32(end_id))
                writer.add(part["doc_id"].to_pylist(), ids, sizes + 1)
        if writer:
            writer.close()
            n_docs = sum(map(len, writer.sizes))
            yield pa.RecordBatch.from_pydict({"shard": [shard], "uri": [uri], "n_docs": [n_docs], "n_ids": [writer.n_ids]})

    return write


def write_token_files(docs: DataFrame, folder: str, vocabulary: str, end_id: int = 0) -> DataFrame:
    """Encode every text of ``docs`` (doc_id, text) and write id files in ascending doc_id order below ``folder``.

    Returns the stored manifest ``shard, uri, n_docs, n_ids, base``: one row a file, ``base`` the ids of all files before it. A
    null text is empty, so its document is the end id alone; null doc_ids come first; repeated rows are written
    each; rows that share a doc_id stand in the order of a hash of their texts, then of the texts, and may be in several files; other columns
    are not read; an empty table writes no file. A task holds a few numbers for each document of its range; files of lost attempts are in no
    manifest.
    """
    order = ["doc_id", F.xxhash64("text"), "text"]
    ordered = docs.select("doc_id", "text").repartitionByRange(*order).sortWithinPartitions(*order)
    files = stored(ordered.mapInArrow(_write(folder, vocabulary, end_id), "shard bigint, uri string, n_docs bigint, n_ids bigint"))
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    return files.withColumn("base", F.coalesce(F.sum("n_ids").over(before), F.lit(0).cast("bigint")))


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["doc_id", "start", "n_tokens", "ids_crc32"]
    for batch in batches:
        for uri, base in zip(batch["uri"].to_pylist(), batch["base"].to_pylist(), strict=True):
            file, rows = TokenFile(uri), []
            for doc_id, start, ids in file.documents():
                rows.append((doc_id, base + start, len(ids), zlib.crc32(ids.astype("<u4").tobytes())))
                if len(rows) == 20_000:
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows, strict=True)], names=names)
                    rows = []
            file.close()
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows, strict=True)], names=names)


def read_token_files(manifest: DataFrame) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of every document, from the files of a manifest: one task a file."""
    files = max(1, manifest.count())
    return manifest.select("uri", "base").repartition(files).mapInArrow(
        _read, "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint"
    )


def token_file_round_trip(docs: DataFrame, vocabulary: str, end_id: int = 0, folder: str | None = None) -> DataFrame:
    """Write ``docs`` as id files below ``folder`` (by default a new one in the shared folder) and read them back."""
    return read_token_files(write_token_files(docs, folder or fresh_folder(docs.sparkSession), vocabulary, end_id))
