"""Report archives as a data source for batches and streams, and archives written by tasks.

Planning lists the archives and reads only their directories, by seeking from the end; each member of the wanted kind becomes a partition, and a task reads
its member once, as a stream, from where it lies in its archive. So neither an archive nor a member is ever one value, and the header is resolved where
the rows are read: each row carries its header's width and the places of the table's columns. Archives may be in any file system that
pyarrow opens (local or mounted folders, HDFS, object stores); for others there is ragged.archive_lines, which Spark's own reader feeds.

As a stream an offset is the ledger of archives seen, with their sizes; a batch holds the members of archives that its end has and its start has not.
"""

from __future__ import annotations

import csv
import io
import json
import re
import zipfile
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

from .ragged import ARCHIVE, COLUMNS, MEMBERS, _lists_of

NAME = "report_archives"
SCHEMA = "year int, quarter int, zip string, member string, file_rank int, line_no bigint, line string, width int, places array<int>"
ROWS = 20_000
LostBreaks = dict[tuple[int, int], str]


def file_system(path: str):
    """(file system, path in it) of a path or URI."""
    from pyarrow import fs

    if "://" in path:
        return fs.FileSystem.from_uri(path)
    return fs.LocalFileSystem(), re.sub("^file:", "", path)


@dataclass(frozen=True)
class Archive:
    path: str  # in its file system
    zip: str
    year: int
    quarter: int
    size: int

    @property
    def key(self) -> str:
        return f"{self.year}q{self.quarter}/{self.path}"


@dataclass
class Member(InputPartition):
    archive: Archive
    file_rank: int
    name: str

    def __init__(self, archive: Archive, file_rank: int, name: str):
        super().__init__(None)
        self.archive, self.file_rank, self.name = archive, file_rank, name


def found_archives(root: str) -> list[Archive]:
    """Archives below root in order of year, quarter and name in lower case; one entry an archive, of its name and size alone."""
    from pyarrow import fs

    system, top = file_system(root)
    out = []
    for info in system.get_file_info(fs.FileSelector(top, recursive=True)):
        if info.type == fs.FileType.File and (m := re.search(ARCHIVE, info.path)):
            out.append(Archive(info.path, info.path.rpartition("/")[2], int(m[1]), int(m[2]), info.size))
    return sorted(out, key=lambda a: (a.year, a.quarter, a.zip.lower(), a.path))


def resolved(head: list[str], table: str) -> tuple[int, list[int | None]]:
    """The header's width without blank cells at its end, and the place of each of the table's columns, by the first of its names that is there."""
    names = [c.strip(" ").lower() for c in head]
    while names and not names[-1]:
        names.pop()
    return len(names), [next((names.index(n) for n in some if n in names), None) for some in COLUMNS[table]]


class _Archives:
    """What batches and streams share: options, planning and reading."""

    def __init__(self, options: dict[str, str]):
        self.root, self.table = options["path"], options["table"].lower()
        if self.table not in MEMBERS:
            raise ValueError(f"table is one of {sorted(MEMBERS)}")
        self.lost_breaks: dict[str, str] = json.loads(options.get("lostbreaks", "{}"))

    def open(self, archive: Archive) -> zipfile.ZipFile:
        return zipfile.ZipFile(file_system(self.root)[0].open_input_file(archive.path))

    def members(self, archives: list[tuple[int, Archive]]) -> list[Member]:
        """The first member of the kind in each archive; lists of deleted ids only from archives that have reports."""
        want, demo, out = re.compile(MEMBERS[self.table]), re.compile(MEMBERS["demo"]), []
        for rank, archive in archives:
            with self.open(archive) as z:
                inside = z.namelist()
            name = next((n for n in inside if want.search(n)), None)
            if name is not None and (self.table != "delete" or any(demo.search(n) for n in inside)):
                out.append(Member(archive, rank, name))
        return out

    def read(self, partition: Member | None) -> Iterator[pa.RecordBatch]:
        if partition is None:  # what Spark makes of a plan without partitions
            return
        a, types = partition.archive, [pa.int32(), pa.int32(), pa.string(), pa.string(), pa.int32(), pa.int64(), pa.string(), pa.int32(), pa.list_(pa.int32())]
        names = [c.strip().split(" ")[0] for c in SCHEMA.split(",")]
        with self.open(a) as z, io.TextIOWrapper(z.open(partition.name), encoding="latin-1", newline="\n") as stream:
            at, head, width, places = 0, self.table != "delete", None, None
            for some in _lists_of(stream, self.table, self.lost_breaks.get(f"{a.year}q{a.quarter}")):
                numbers, lines = pa.array(range(at, at + len(some)), pa.int64()), pa.array(some, pa.string())
                at += len(some)
                whole = pc.not_equal(pc.utf8_trim(lines, "\r"), "")
                if not pc.all(whole).as_py():
                    numbers, lines = numbers.filter(whole), lines.filter(whole)
                if head and len(lines):
                    first, head = lines[0].as_py(), False
                    cells = next(csv.reader([first], delimiter="$"), []) if self.table == "demo" else first.split("$")
                    width, places = resolved(cells, self.table)
                    numbers, lines = numbers[1:], lines[1:]
                for k in range(0, len(lines), ROWS):
                    n = min(ROWS, len(lines) - k)
                    values = [a.year, a.quarter, a.zip, partition.name, partition.file_rank, None, None, width, places]
                    columns = [pa.repeat(pa.scalar(v, t), n) for v, t in zip(values, types, strict=True)]
                    columns[5:7] = numbers[k : k + n], lines[k : k + n]
                    yield pa.RecordBatch.from_arrays(columns, names=names)


class ArchiveReader(_Archives, DataSourceReader):
    def partitions(self) -> list[Member]:
        return self.members(list(enumerate(found_archives(self.root), 1)))


class ArchiveStreamReader(_Archives, DataSourceStreamReader):
    def initialOffset(self) -> dict:
        return {"archives": {}}

    def latestOffset(self) -> dict:
        return {"archives": {a.key: a.size for a in found_archives(self.root)}}

    def partitions(self, start: dict, end: dict) -> list[Member]:
        seen, now = start["archives"], end["archives"]
        if changed := sorted(k for k in seen if now.get(k) != seen[k]):
            raise ValueError(f"archives that were read have changed or are gone: {changed}")
        found = {a.key: (rank, a) for rank, a in enumerate(found_archives(self.root), 1)}
        if lost := sorted(k for k in now if k not in seen and (k not in found or found[k][1].size != now[k])):
            raise ValueError(f"archives have changed or are gone since this batch was planned: {lost}")
        return self.members([found[k] for k in now if k not in seen])


class ArchiveSource(DataSource):
    """spark.read.format("report_archives") and spark.readStream with options path, table (demo, delete, drug, reac) and lostbreaks (JSON)."""

    @classmethod
    def name(cls) -> str:
        return NAME

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return ArchiveReader(dict(self.options))

    def streamReader(self, schema) -> DataSourceStreamReader:
        return ArchiveStreamReader(dict(self.options))


def _options(root: str, table: str, lost_breaks: LostBreaks | None) -> dict[str, str]:
    return {"path": root, "table": table, "lostbreaks": json.dumps({f"{y}q{q}": t for (y, q), t in (lost_breaks or {}).items()})}


def lines(spark: SparkSession, root: str, table: str, lost_breaks: LostBreaks | None = None) -> DataFrame:
    """Rows of one kind of member, for ragged.parse; lost_breaks gives, for (year, quarter), a token before which a line break is put.

    Lists of deleted ids have no header, so no width and places. A member without rows, or a root without archives, gives none.
    """
    spark.dataSource.register(ArchiveSource)
    return spark.read.format(NAME).options(**_options(root, table, lost_breaks)).load()


def line_stream(spark: SparkSession, root: str, table: str, lost_breaks: LostBreaks | None = None) -> DataFrame:
    """The same as a stream: each batch holds the archives that have come since the last."""
    spark.dataSource.register(ArchiveSource)
    return spark.readStream.format(NAME).options(**_options(root, table, lost_breaks)).load()


def archive_ordinal(zip_col: str = "zip"):
    """An order of rows that does not depend on which archives have come so far."""
    return F.struct("year", "quarter", F.lower(zip_col).alias("low"), zip_col, "line_no")


def _runs(batch: pa.RecordBatch):
    """(start, end, year, quarter, kind) of runs of rows that are alike in these."""
    columns, n = [batch.column(c) for c in ("year", "quarter", "kind")], batch.num_rows
    new = None
    for c in columns:
        other = pc.not_equal(c[1:], c[:-1])
        new = other if new is None else pc.or_(new, other)
    starts = [0, *(i + 1 for i in pc.indices_nonzero(new).to_pylist())] if n else []
    for start, end in zip(starts, [*starts[1:], n]):
        yield (start, end, *(c[start].as_py() for c in columns))


def _joined(lines: pa.Array) -> bytes:
    """Lines joined by line feeds, in UTF-8."""
    whole = pa.LargeListArray.from_arrays(pa.array([0, len(lines)], pa.int64()), lines.cast(pa.large_string()))
    return pc.binary_join(whole, pa.scalar("\n", pa.large_string()))[0].as_buffer().to_pybytes()


def write_archives(rows: DataFrame, root: str, prefix: str = "faers_ascii_") -> DataFrame:
    """Writes (year, quarter, kind, line_no, line) as one archive a quarter below root; gives (path, lines) when it is run.

    A task writes its archives line by line, in order, under a name of its own that becomes the archive's at the end, so that a repeated task replaces what it
    wrote. Lines end in a line feed and are Latin-1; characters beyond it become question marks.
    """

    def write(batches):
        import uuid

        system, top = file_system(root)
        system.create_dir(top, recursive=True)
        now, z, member, n, at = None, None, None, 0, None

        def closed():
            member.close()
            z.close()
            stream.close()
            system.move(at, f"{top}/{name}")
            return pa.RecordBatch.from_arrays([pa.array([f"{top}/{name}"]), pa.array([n], pa.int64())], names=["path", "lines"])

        for batch in batches:
            column = batch.column("line")
            for start, end, year, quarter, kind in _runs(batch):
                if now is not None and now[:2] != (year, quarter):
                    yield closed()
                if now is None or now[:2] != (year, quarter):
                    name, n, at, now = f"{prefix}{year}q{quarter}.zip", 0, f"{top}/_{uuid.uuid4().hex}", (year, quarter, None)
                    stream = system.open_output_stream(at)
                    z = zipfile.ZipFile(stream, "w", zipfile.ZIP_DEFLATED, compresslevel=1)
                if now[2] != kind:
                    if now[2] is not None:
                        member.close()
                    member, now = z.open(f"ascii/{kind.upper()}{year % 100:02}Q{quarter}.txt", "w", force_zip64=True), (year, quarter, kind)
                body = _joined(column.slice(start, end - start))
                member.write((body if body.isascii() else body.decode().encode("latin-1", "replace")) + b"\n")
                n += end - start
        if now is not None:
            yield closed()

    # Archives are few and long: many partitions, not merged again, and quarters that follow one another never are one task's.
    n = max(64, 8 * rows.sparkSession.sparkContext.defaultParallelism)
    dealt = rows.repartitionById(n, F.pmod(F.col("year") * 4 + F.col("quarter"), F.lit(n)).cast("int")).sortWithinPartitions("year", "quarter", "kind", "line_no")
    return dealt.select("year", "quarter", "kind", "line").mapInArrow(write, "path string, lines bigint")
