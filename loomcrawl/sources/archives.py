"""Crawl archives as Spark data sources: records as rows, by whole files or by an index of their records.

WARC and ARC files are gzip members one after another. Where a member begins is only known from the start of the file on
(bytes that look like a beginning may lie inside a record), so a file is first read as one task. That can
leave an index (index_records): a row for each record without its content, with the member that it begins in. By such rows
records are fetched (fetch_records) in tasks of a bounded number of packed bytes, several for a long file, and
after a filter on the index only what it keeps is read.

Readers go through Arrow's file systems and read record by record: a file is never held whole. A
damaged record is skipped or told, a damaged file ends where it breaks; neither fails the job. The sink `warc` writes
each record as a member of its own.
"""

from __future__ import annotations

import io
import re
import zlib
from collections import deque
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, EqualTo, Filter, In, InputPartition, StringContains, StringStartsWith

from loomcrawl.sources.staged import Staged, StagedWriter
from loomcrawl.sources.staged import open_path as _open

#: offset and end_offset are places in the unpacked file; member is the place in the packed one where a record begins with a
#: member (in a plain file its offset), null for a record that begins inside one.
WARC_SCHEMA = "file string, offset long, end_offset long, member long, type string, uri string, ip string, ts string, mime string, content binary, error string"
COLUMNS = [c.split()[0] for c in WARC_SCHEMA.split(", ")]
#: Bytes read at once.
CHUNK = 1 << 20
#: Of a record without its content, about.
ROW_BYTES = 1000


class _Inflated(io.RawIOBase):
    """Concatenated gzip members, or plain bytes, as one stream of plain bytes; a damaged member ends it."""

    def __init__(self, raw, packed: int = 0, unpacked: int = 0):
        self.raw, self.buffer, self.done, self.broken = raw, b"", False, False
        #: the last output filled its chunk
        self.full = False
        head = raw.read(2)
        self.pending = head
        self.gzip = head == b"\x1f\x8b"
        self.inflater = zlib.decompressobj(31) if self.gzip else None
        self.taken, self.made = packed + len(head), unpacked
        #: (unpacked, packed) beginnings of members that were met
        self.members = deque([(unpacked, packed)])

    def readable(self) -> bool:
        return True

    def _more(self) -> bytes:
        data, self.pending = self.pending, b""
        if not data:
            data = self.raw.read(CHUNK)
            self.taken += len(data)
        return data

    def readinto(self, target) -> int:
        while not self.buffer and not self.done:
            data = self._more()
            # at the end of a file the inflater may still hold what did not fit in the last chunk
            if not data and not (self.gzip and self.full):
                self.done = True
                break
            if not self.gzip:
                self.buffer = data
                break
            try:
                self.buffer = self.inflater.decompress(data, CHUNK)
            except zlib.error:
                self.done = self.broken = True
                break
            self.made += len(self.buffer)
            self.full = len(self.buffer) == CHUNK
            self.pending = self.inflater.unconsumed_tail
            if self.inflater.eof:
                self.pending = self.inflater.unused_data.lstrip(b"\0")
                self.inflater = zlib.decompressobj(31)
                self.members.append((self.made, self.taken - len(self.pending)))
        n = min(len(target), len(self.buffer))
        target[:n] = self.buffer[:n]
        self.buffer = self.buffer[n:]
        return n


class _Counted:
    """Lines and blocks of a stream, how far it was read, and the members that were met."""

    def __init__(self, raw, packed: int = 0, unpacked: int = 0):
        self.inflated, self.at = _Inflated(raw, packed, unpacked), unpacked
        self.stream = io.BufferedReader(self.inflated, CHUNK)

    def line(self) -> bytes:
        x = self.stream.readline()
        self.at += len(x)
        return x

    def block(self, n: int) -> bytes:
        x = self.stream.read(n)
        self.at += len(x)
        return x

    def member(self, at: int) -> int | None:
        """Where the member that begins at a place of the unpacked stream does so in the packed one."""
        if not self.inflated.gzip:
            return at
        known = self.inflated.members
        while len(known) > 1 and known[1][0] <= at:
            known.popleft()
        return known[0][1] if known[0][0] == at else None


def warc_records(raw, file: str, packed: int = 0, unpacked: int = 0) -> Iterator[tuple]:
    """Rows of WARC_SCHEMA; raw begins at these places. What is no record header is skipped up to the next one."""
    s = _Counted(raw, packed, unpacked)
    while line := s.line():
        if not line.startswith(b"WARC/"):
            continue
        start, head = s.at - len(line), {}
        member = s.member(start)
        while (line := s.line()).strip():
            k, _, v = line.partition(b":")
            head[k.strip().lower().decode("latin-1")] = v.strip().decode("utf-8", "replace")
        length = head.get("content-length", "")
        if not length.isdigit():
            yield file, start, s.at, member, head.get("warc-type"), head.get("warc-target-uri"), None, None, None, None, "no content length"
            continue
        content = s.block(int(length))
        error = None if len(content) == int(length) else "cut off"
        uri = head.get("warc-target-uri")
        yield file, start, s.at, member, head.get("warc-type"), uri.strip("<>") if uri else None, head.get("warc-ip-address"), head.get("warc-date"), head.get("content-type"), content, error


ARC_LINE = re.compile(rb"^(\S+://\S+|\S+:\S+) (\S+) (\d{8,14}) (\S+) (\d+)\s*$")


def arc_records(raw, file: str, tolerant: bool = False, packed: int = 0, unpacked: int = 0) -> Iterator[tuple]:
    """Rows of WARC_SCHEMA from an ARC file: a header line `url ip date mime length`, then that many bytes.

    tolerant: a line that is no header is passed over until one is; otherwise the file ends there with an error row.
    """
    s = _Counted(raw, packed, unpacked)
    while line := s.line():
        if not line.strip():
            continue
        m = ARC_LINE.match(line)
        if not m:
            if tolerant:
                continue
            yield file, s.at - len(line), s.at, None, None, None, None, None, None, None, "no record header"
            return
        start, n = s.at - len(line), int(m[5])
        member = s.member(start)
        content = s.block(n)
        kind = "filedesc" if m[1].startswith(b"filedesc:") else "response"
        yield file, start, s.at, member, kind, m[1].decode("utf-8", "replace"), m[2].decode("latin-1"), m[3].decode(), m[4].decode("latin-1"), content, None if len(content) == n else "cut off"


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    schema = pa.schema([(c, pa.binary() if c == "content" else pa.int64() if c in ("offset", "end_offset", "member") else pa.string()) for c in COLUMNS])
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


def _batches(rows: Iterator[tuple]) -> Iterator[pa.RecordBatch]:
    """Rows of WARC_SCHEMA as batches that end by bytes, so that memory depends on the largest record and not on how many there are."""
    out, size = [], 0
    for row in rows:
        out.append(row)
        size += len(row[9] or b"") + ROW_BYTES
        if size >= CHUNK << 3:
            yield _batch(out)
            out, size = [], 0
    if out:
        yield _batch(out)


class _Reader(DataSourceReader):
    def __init__(self, options: dict, arc: bool):
        self.paths, self.arc = [p for p in options.get("paths", options.get("path", "")).split(",") if p], arc
        self.tolerant = str(options.get("tolerant", "false")).lower() == "true"
        self.checks: list[tuple[int, Filter]] = []

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        """Tests of one text column are made here, before a record crosses to the JVM; Spark makes the others."""
        for f in filters:
            if isinstance(f, (EqualTo, In, StringContains, StringStartsWith)) and len(f.attribute) == 1 and f.attribute[0] in ("type", "uri", "mime", "ip", "ts"):
                self.checks.append((COLUMNS.index(f.attribute[0]), f))
            else:
                yield f

    def _kept(self, row: tuple) -> bool:
        for k, f in self.checks:
            v = row[k]
            if v is None or not (v == f.value if isinstance(f, EqualTo) else v in f.value if isinstance(f, In) else f.value in v if isinstance(f, StringContains) else v.startswith(f.value)):
                return False
        return True

    def partitions(self) -> list[InputPartition]:
        from pyarrow import fs

        files = []
        for p in self.paths:
            system, where = _open(p)
            info = system.get_file_info(where)
            scheme = p[: len(p) - len(where)] if p.endswith(where) else ""
            if info.type == fs.FileType.Directory:
                files += [scheme + x.path for x in system.get_file_info(fs.FileSelector(where, recursive=True)) if x.type == fs.FileType.File and not x.base_name.startswith(("_", "."))]
            else:
                files.append(p)
        return [InputPartition(f) for f in sorted(files)]

    def read(self, partition: InputPartition) -> Iterator[pa.RecordBatch]:
        path = partition.value
        system, where = _open(path)
        try:
            with system.open_input_stream(where, compression=None) as raw:
                yield from _batches(filter(self._kept, arc_records(raw, path, self.tolerant) if self.arc else warc_records(raw, path)))
        except OSError as e:
            yield from _batches(filter(self._kept, [(path, *[None] * (len(COLUMNS) - 2), str(e)[:200])]))


class WarcSource(DataSource):
    """spark.read.format("warc").load(folder or comma-separated paths)"""

    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return WARC_SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return _Reader(self.options, False)

    def writer(self, schema, overwrite: bool) -> DataSourceArrowWriter:
        return WarcWriter(self.options["path"], schema.fieldNames()).prepare()


class WarcWriter(StagedWriter):
    """Rows of type, uri, ts, mime and content (others are not looked at) as files of one member a record."""

    def __init__(self, path: str, columns: list[str]):
        super().__init__(path)
        self.columns = columns

    def write(self, batches: Iterator[pa.RecordBatch]) -> Staged:
        system, stage, own = self.task_folder()
        done, name = Staged(), f"{own}/part-{own}.warc.gz"
        heads = {"type": b"WARC-Type", "uri": b"WARC-Target-URI", "ts": b"WARC-Date", "mime": b"Content-Type"}
        file = None
        try:
            for b in batches:
                if file is None and b.num_rows:
                    file = system.open_output_stream(f"{stage}/{name}", compression=None)
                    done.files.append((name, ""))
                columns = {c: b.column(k).cast(pa.binary()).to_pylist() for k, c in enumerate(self.columns) if c in heads or c == "content"}
                for k in range(b.num_rows):
                    lines = [heads[c] + b": " + b" ".join(v[k].split()) for c, v in columns.items() if c in heads and v[k] is not None]
                    body = columns["content"][k] or b""
                    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
                    file.write(packer.compress(b"\r\n".join([b"WARC/1.0", *lines, b"Content-Length: %d" % len(body), b"", body, b"", b""])) + packer.flush())
                    done.add("records")
        finally:
            if file is not None:
                file.close()
        return done


class ArcSource(DataSource):
    """spark.read.format("arc").option("tolerant", True).load(…)"""

    @classmethod
    def name(cls) -> str:
        return "arc"

    def schema(self) -> str:
        return WARC_SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return _Reader(self.options, True)


def register(spark: SparkSession) -> None:
    """Makes the formats `warc` and `arc` known, and lets filters reach them, which Spark does only if told."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(WarcSource)
    spark.dataSource.register(ArcSource)


def index_records(records: DataFrame) -> DataFrame:
    """An index of archives from their records: all but the content. Write it as Parquet, sorted as it will be asked for."""
    return records.where("member is not null and error is null").select("file", "member", "offset", "end_offset", "type", "uri", "ip", "ts", "mime")


def fetch_records(index: DataFrame, arc: bool = False, task_bytes: int = 64 << 20) -> DataFrame:
    """The records (WARC_SCHEMA) of rows of an index, each once: files are read from member to member.

    Rows of a file that lie in the same `task_bytes` packed bytes are read by one task, one after another; what lies between them
    is passed over. A file that no longer has a record there gives a row with an error.
    """
    wanted = index.select("file", "member", "offset").distinct()
    parted = wanted.withColumn("part", F.expr(f"member div {task_bytes}"))
    # told in number, as rows of an index are too small for Spark to see the work that they are
    parts = parted.select("file", "part").distinct().count()
    dealt = parted.repartition(max(1, parts), "file", "part").sortWithinPartitions("file", "member")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, file, rows, at = None, None, iter(()), -1
        for b in batches:
            out, size = [], 0
            for path, member, offset in zip(*(b.column(k).to_pylist() for k in range(3))):
                try:
                    if path != now:
                        if file is not None:
                            file.close()
                        system, where = _open(path)
                        now, file, at = path, system.open_input_file(where), -1
                    row = next(rows, None) if at == offset else None
                    if row is None or row[1] != offset:
                        file.seek(member)
                        rows = arc_records(file, path, False, member, offset) if arc else warc_records(file, path, member, offset)
                        row = next(rows, None)
                    if row is None or row[1] != offset:
                        raise OSError("no record there")
                    # records of a WARC end with two line ends, those of an ARC with one
                    at = row[2] + (1 if arc else 4)
                except OSError as e:
                    at = -1
                    row = (path, offset, None, member, *[None] * (len(COLUMNS) - 5), str(e)[:200])
                out.append(row)
                size += len(row[9] or b"")
                if size >= CHUNK << 3:
                    yield _batch(out)
                    out, size = [], 0
            if out:
                yield _batch(out)
        if file is not None:
            file.close()

    return dealt.select("file", "member", "offset").mapInArrow(run, WARC_SCHEMA)


def html_responses(records: DataFrame) -> DataFrame:
    """(file, offset, uri, ip, ts, status, content_type, last_modified, html): HTTP responses that hold HTML, with a URI that has a host.

    The header is split off in the JVM. A Content-Type header counts if its line has one colon; without one text/html is taken.
    """
    text = F.decode("content", "iso-8859-1")
    cut = F.locate("\r\n\r\n", text)
    r = records.where("error is null and type = 'response' and content is not null").withColumn("cut", F.when(cut > 0, cut)).withColumn("head", F.when(F.col("cut").isNotNull(), F.substring(text, F.lit(1), F.col("cut"))).otherwise(""))
    header = lambda n: F.regexp_extract("head", rf"(?im)^{n}:([^:\r\n]*)\r?$", 1)
    kind = F.trim(header("Content-Type"))
    kept = r.withColumn("content_type", F.when(kind == "", "text/html").otherwise(kind)).where(F.lower("content_type").contains("html") & F.try_parse_url("uri", F.lit("HOST")).isNotNull())
    body = F.expr("substring(content, cut + 4, length(content))")
    modified = F.trim(F.regexp_extract("head", r"(?im)^Last-Modified:([^\r\n]*)\r?$", 1))
    status = F.expr(r"try_cast(regexp_extract(head, '^HTTP/[0-9.]+ ([0-9]{3})', 1) as int)")
    return kept.where("cut is not null").select("file", "offset", "uri", "ip", "ts", status.alias("status"), "content_type", F.when(modified != "", modified).alias("last_modified"), F.expr("try_validate_utf8(cast(substring(content, cut + 4, length(content)) as string))").alias("utf8"), F.decode(body, "iso-8859-1").alias("latin")).withColumn("html", F.coalesce("utf8", "latin")).drop("utf8", "latin")


def rejected_records(records: DataFrame) -> DataFrame:
    """Failure rows: (file, offset, uri, error)."""
    return records.where("error is not null").select("file", "offset", "uri", "error")


def matching_records(records: DataFrame, part: str) -> DataFrame:
    """Records whose URI holds a text, with their content as text."""
    return records.where(F.col("uri").contains(part)).select("file", "uri", F.decode("content", "iso-8859-1").alias("text"))

