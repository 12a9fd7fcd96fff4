"""Token ids as length-delimited binary records with masked checksums and a separate offset index.

A record file holds one record per document, in ascending doc_id order over all files by file number:

    length of the payload, 8 bytes | masked CRC-32 of those 8 bytes, 4 | payload | masked CRC-32 of the payload, 4
    payload: 1 if there is a doc_id else 0, 1 byte | doc_id, 8 bytes | ids, as packing.pack_ids has them

All numbers are little-endian. A checksum is masked (rotated by 15 bits, plus a constant) so that a
checksum over data that holds checksums stays sound. The index file beside it holds the offset of
each record and the file's length, 8 bytes each: record k is read without touching the others, which
shuffled reads need.

Executors write through Arrow's file systems, so the folder may be any that Arrow reaches and all
executors share. A file's name is new for each attempt of a task; only files of the manifest, which
Spark commits, count, so a lost executor leaves at most a file nobody reads.

A null or empty text has the end id alone. Rows that share a doc_id are records in the order of their
texts' hashes; null ids come first. An empty table gives an empty manifest.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import saved, scratch_path
from .packing import pack_ids, unpack_ids
from .tokens import encoder

MANIFEST = "part int, path string, records long, ids long"
#: Bytes of payload read before rows are handed on.
READ_AHEAD = 4 << 20


@dataclass(frozen=True)
class RecordParams:
    tokenizer: str
    kind: str = "spaces"
    end_id: int = 2


def masked(data: bytes) -> int:
    crc = zlib.crc32(data)
    return ((crc >> 15 | crc << 17) + 0xA282EAD8) & 0xFFFFFFFF


def frame(payload: bytes) -> bytes:
    head = struct.pack("<Q", len(payload))
    return head + struct.pack("<I", masked(head)) + payload + struct.pack("<I", masked(payload))


def payload_size(head: bytes, at: int = 0) -> int:
    """The length that a record's first 12 bytes tell; ValueError if they are cut short or their checksum is wrong."""
    if len(head) < 12 or masked(head[:8]) != struct.unpack_from("<I", head, 8)[0]:
        raise ValueError(f"a record's length is damaged at byte {at}")
    return struct.unpack_from("<Q", head)[0]


def unframe(data: bytes, at: int = 0) -> tuple[bytes, int]:
    """The payload of the record at an offset, and the offset after it; ValueError if a checksum is wrong."""
    end = at + 12 + payload_size(data[at : at + 12], at)
    payload = data[at + 12 : end]
    if len(data) < end + 4 or masked(payload) != struct.unpack_from("<I", data, end)[0]:
        raise ValueError(f"a record is damaged at byte {at}")
    return payload, end + 4


def _fs(path: str) -> tuple:
    from pyarrow import fs

    if path.startswith("file:/") and not path.startswith("file://"):
        path = path[5:]  # as Hadoop writes local paths
    return fs.FileSystem.from_uri(path)


def write_records(docs: DataFrame, folder: str, params: RecordParams, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """Writes the files and returns their manifest: part (file number), path, records, ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, part = encoder(params.tokenizer, params.kind), TaskContext.get().partitionId()
        path, out, offsets, at, total = f"{folder}/part-{part:06d}-{uuid.uuid4().hex}.rec", None, [], 0, 0
        for b in batches:
            for i, ids in zip(b.column(0).to_pylist(), enc.encode(t.as_py() for t in b.column(1).cast(pa.binary()))):
                ids = np.append(ids, np.uint32(params.end_id))
                if out is None:
                    fs, where = _fs(folder)
                    fs.create_dir(where, recursive=True)
                    fs, where = _fs(path)
                    out = fs.open_output_stream(where)
                record = frame(struct.pack("<Bq", i is not None, i or 0) + pack_ids(ids))
                out.write(record)
                offsets.append(at)
                at, total = at + len(record), total + len(ids)
        if out is not None:
            out.close()
            fs, where = _fs(path + ".idx")
            with fs.open_output_stream(where) as f:
                f.write(np.array([*offsets, at], "<u8").tobytes())
            yield pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([path]), pa.array([len(offsets)], pa.int64()), pa.array([total], pa.int64())], ["part", "path", "records", "ids"])

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    # longs alone are sampled for the ranges; nulls sort first
    sorted_rows = rows.repartitionByRange("doc_id").sortWithinPartitions("doc_id", F.xxhash64("text"))
    return saved(sorted_rows.mapInArrow(run, MANIFEST), "manifest")


def read_records(manifest: DataFrame) -> DataFrame:
    """One row per record of the manifest's files: doc_id, start (ids of all records before it), ids (packed).

    Every checksum is verified. Files are read in parallel, front to back.
    """
    # one row per file
    counted = manifest.selectExpr("path", "coalesce(sum(ids) over (order by part rows between unbounded preceding and 1 preceding), 0) as before")
    files = max(1, manifest.count())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for path, before in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                fs, where = _fs(path)
                with fs.open_input_stream(where, buffer_size=1 << 20) as f:
                    rows: list[tuple] = []
                    size = 0
                    while head := f.read(12):
                        payload, _ = unframe(head + f.read(payload_size(head) + 4))
                        known, doc = struct.unpack_from("<Bq", payload)
                        rows.append((doc if known else None, before, payload[9:]))
                        before += (len(payload) - 10) // payload[9]
                        size += len(payload)
                        if size >= READ_AHEAD:
                            yield _rows(rows)
                            rows, size = [], 0
                    yield _rows(rows)

    return counted.repartition(min(files, 10_000)).mapInArrow(run, "doc_id long, start long, ids binary")


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    columns = zip(*rows) if rows else ([], [], [])
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, (pa.int64(), pa.int64(), pa.binary()))], ["doc_id", "start", "ids"])


class RecordFile:
    """Random access to the records of one file, through its index."""

    def __init__(self, path: str):
        fs, where = _fs(path + ".idx")
        with fs.open_input_stream(where) as f:
            self.offsets = np.frombuffer(f.read(), "<u8")
        self.fs, self.where = _fs(path)

    def __len__(self) -> int:
        return len(self.offsets) - 1

    def __getitem__(self, k: int) -> tuple[int | None, np.ndarray]:
        """doc_id and ids of record k."""
        with self.fs.open_input_file(self.where) as f:
            f.seek(int(self.offsets[k]))
            payload, _ = unframe(f.read(int(self.offsets[k + 1] - self.offsets[k])))
        known, doc = struct.unpack_from("<Bq", payload)
        return (doc if known else None), unpack_ids(payload[9:])


def record_report(docs: DataFrame, params: RecordParams) -> DataFrame:
    """Writes docs to a new folder of the shared place and digests what is read back from it."""

    @F.arrow_udf("struct<n:long,crc:long>")
    def digest(ids: pa.Array) -> pa.Array:
        all_ids = [unpack_ids(x.as_py()) for x in ids]
        return pa.StructArray.from_arrays([pa.array([len(x) for x in all_ids], pa.int64()), pa.array([zlib.crc32(x.tobytes()) for x in all_ids], pa.int64())], ["n", "crc"])

    back = read_records(write_records(docs, scratch_path(docs.sparkSession, "records"), params))
    return back.select("doc_id", "start", digest("ids").alias("d")).select("doc_id", "start", F.col("d.n").alias("n_tokens"), F.col("d.crc").alias("ids_crc32"))
