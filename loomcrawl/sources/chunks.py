"""Statements as gzip chunks of a bounded size, a folder an extractor: a Spark data sink with commit and abort.

A task keeps a chunk open for each extractor it meets. Lines are packed as gzip members of some hundred KB, so the size of a
chunk is known as it grows, and a new one begins before the next member would take it over the bound; readers of
gzip read members as one stream. Tasks write below a folder that the driver makes. When all tasks are done the
driver moves their chunks into place and writes how many lines there were and how many were no statements; a job
that fails leaves nothing behind, and of a task that is tried again only the attempt that Spark counts stays.
"""

from __future__ import annotations

import json
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter

from loomcrawl.operators.quads import EXTRACTORS, format_quads
from loomcrawl.sources.staged import Staged, StagedWriter, open_path

CHUNK_BYTES = 100 << 20
#: Bytes of lines that are packed as one member.
MEMBER = 256 << 10
COUNTS = "counts.json"
COUNTED = ("files", "lines", "unknown", "unparsable")
_EXTRACTOR = re.compile(rb"<ex:([^<>]+)>\s*\.\s*$")


class _Chunk:
    """The open chunk of an extractor."""

    def __init__(self, name: str):
        self.name, self.number, self.size, self.lines, self.held, self.file = name, 0, 0, [], 0, None


class ChunkWriter(StagedWriter):
    """Options: path; chunkBytes; memberBytes; extractors (comma-separated, all known ones if not told). The first column is the line."""

    def __init__(self, options: dict):
        super().__init__(options["path"])
        self.most, self.member = int(options.get("chunkBytes", CHUNK_BYTES)), int(options.get("memberBytes", MEMBER))
        self.known = frozenset(options.get("extractors", ",".join(EXTRACTORS)).split(","))

    def write(self, batches: Iterator[pa.RecordBatch]) -> Staged:
        system, stage, own = self.task_folder()
        done, chunks = Staged(), {}

        def pack(c: _Chunk) -> None:
            packer = zlib.compressobj(6, zlib.DEFLATED, 31)
            data = packer.compress(b"\n".join(c.lines) + b"\n") + packer.flush()
            if len(data) > self.most and len(c.lines) > 1:  # a member is over the bound: each half on its own
                half, lines = len(c.lines) // 2, c.lines
                for c.lines in (lines[:half], lines[half:]):
                    pack(c)
                return
            if c.file is not None and c.size + len(data) > self.most:
                c.file.close()
                c.file = None
            if c.file is None:
                name = f"{own}/{c.name}.{own}.{c.number}.nq.gz"
                c.file, c.size, c.number = system.open_output_stream(f"{stage}/{name}", compression=None), 0, c.number + 1
                done.files.append((name, c.name))
                done.add("files")
            c.file.write(data)
            c.size, c.lines, c.held = c.size + len(data), [], 0

        try:
            for b in batches:
                for line in b.column(0).cast(pa.binary()).to_pylist():
                    m = _EXTRACTOR.search(line or b"")
                    name = m[1].decode("utf-8", "replace") if m else None
                    if name not in self.known:
                        done.add("unknown" if m else "unparsable")
                        continue
                    c = chunks.setdefault(name, _Chunk(name))
                    c.lines.append(line)
                    c.held += len(line) + 1
                    done.add("lines")
                    if c.held >= self.member:
                        pack(c)
            for c in chunks.values():
                if c.lines:
                    pack(c)
        finally:
            for c in chunks.values():
                if c.file is not None:
                    c.file.close()
        return done

    def finish(self, told: list[Staged]) -> None:
        system, root = open_path(self.path)
        system.create_dir(root, recursive=True)
        with system.open_output_stream(f"{root}/{COUNTS}", compression=None) as f:
            f.write(json.dumps({c: sum(m.counts.get(c, 0) for m in told) for c in COUNTED}).encode())


class ChunkSink(DataSource):
    """df.write.format("nquads_chunks").option("chunkBytes", …).mode("append").save(path)"""

    @classmethod
    def name(cls) -> str:
        return "nquads_chunks"

    def schema(self) -> str:
        return "value string"

    def writer(self, schema, overwrite: bool) -> DataSourceArrowWriter:
        return ChunkWriter(self.options).prepare()


def write_chunks(lines: DataFrame, path: str, chunk_bytes: int = CHUNK_BYTES, member_bytes: int = MEMBER) -> None:
    """Lines (column value) as chunks below path/EXTRACTOR, none over chunk_bytes but one of a single line that is; counts in path/counts.json."""
    lines.sparkSession.dataSource.register(ChunkSink)
    lines.select("value").write.format("nquads_chunks").option("chunkBytes", chunk_bytes).option("memberBytes", min(member_bytes, chunk_bytes)).mode("append").save(path)


def write_quad_chunks(quads: DataFrame, path: str, chunk_bytes: int = CHUNK_BYTES) -> None:
    write_chunks(format_quads(quads), path, chunk_bytes)


def chunk_counts(spark: SparkSession, path: str) -> DataFrame:
    """(files, lines, unknown, unparsable) of what was written."""
    return spark.read.schema(", ".join(f"{c} long" for c in COUNTED)).json(f"{path}/{COUNTS}")


def read_chunks(spark: SparkSession, path: str) -> DataFrame:
    """Lines (column value) of all chunks."""
    return spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", "*.nq.gz").text(path)
