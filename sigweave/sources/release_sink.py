"""Releases through a data source writer: parts by tasks, digests while they are written, commit and abort.

A task writes its part to a staging folder and digests it block by block as it goes. The driver's commit moves the parts of the tasks that count
into the release, writes the table's manifest (names, rows, bytes and digests of parts, and the root of the tree of digests over them) and then the
index of releases; a table counts once its manifest is there. Abort removes the staging folder, so a lost run leaves nothing. Verifying reads
parts in tasks, a block at a time.
"""

from __future__ import annotations

import hashlib
import io
import json
import uuid
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

from .archive_source import file_system

NAME = "release_parts"
BLOCK = 1 << 20


def tree_root(digests: list[bytes]) -> str:
    """The root of a binary tree of digests: neighbours are digested together, an odd one is carried up; of none, the digest of nothing."""
    level = digests or [hashlib.sha256(b"").digest()]
    while len(level) > 1:
        pairs = [hashlib.sha256(a + b).digest() for a, b in zip(level[::2], level[1::2], strict=False)]
        level = pairs + level[len(pairs) * 2 :]
    return level[0].hex()


class _Digested(io.RawIOBase):
    """A stream that digests each block of what is written to it."""

    def __init__(self, stream):
        self.stream, self.size, self.blocks, self.now = stream, 0, [], hashlib.sha256()

    def writable(self) -> bool:
        return True

    def write(self, data) -> int:
        data = bytes(data)
        self.stream.write(data)
        at = 0
        while at < len(data):
            some = data[at : at + BLOCK - self.size % BLOCK]
            self.now.update(some)
            self.size += len(some)
            at += len(some)
            if self.size % BLOCK == 0:
                self.blocks.append(self.now.digest())
                self.now = hashlib.sha256()
        return len(data)

    def tell(self) -> int:
        return self.size

    def root(self) -> str:
        return tree_root(self.blocks + ([self.now.digest()] if self.size % BLOCK else []))


def digest_of(stream) -> str:
    """The digest of a stored part, a block at a time."""
    blocks = []
    while data := stream.read(BLOCK):
        blocks.append(hashlib.sha256(data).digest())
    return tree_root(blocks)


@dataclass
class Part(WriterCommitMessage):
    staged: str
    name: str
    rows: int
    bytes: int
    digest: str


class ReleaseWriter(DataSourceArrowWriter):
    def __init__(self, options: dict[str, str], schema):
        self.root, self.release, self.table, self.job, self.schema = options["path"], options["release"], options["table"], options["job"], schema

    def _staging(self) -> str:
        return f"{file_system(self.root)[1]}/_staging/{self.job}"

    def write(self, iterator) -> Part:
        import pyarrow.parquet as pq
        from pyspark import TaskContext
        from pyspark.sql.pandas.types import to_arrow_schema

        task, system = TaskContext.get(), file_system(self.root)[0]
        system.create_dir(self._staging(), recursive=True)
        name = f"part-{task.partitionId():06}.parquet"
        staged = f"{self._staging()}/{task.taskAttemptId()}-{name}"
        schema, rows = to_arrow_schema(self.schema), 0
        with system.open_output_stream(staged) as raw:
            out = _Digested(raw)
            with pq.ParquetWriter(pa.PythonFile(out, mode="w"), schema, compression="zstd") as writer:
                for batch in iterator:
                    rows += batch.num_rows
                    writer.write_batch(batch.cast(schema) if batch.schema != schema else batch)
        return Part(staged, name, rows, out.size, out.root())

    def commit(self, messages: list[Part | None]) -> None:
        system, top = file_system(self.root)
        parts = sorted((m for m in messages if m is not None and m.rows), key=lambda m: m.name)
        home = f"{top}/{self.release}/{self.table}"
        system.create_dir(home, recursive=True)
        for p in parts:
            system.move(p.staged, f"{home}/{p.name}")
        entry = {
            "release": self.release, "table": self.table, "rows": sum(p.rows for p in parts), "bytes": sum(p.bytes for p in parts),
            "digest": tree_root([hashlib.sha256(f"{p.name} {p.rows} {p.bytes} {p.digest}".encode()).digest() for p in parts]),
            "parts": [{"name": p.name, "rows": p.rows, "bytes": p.bytes, "digest": p.digest} for p in parts],
        }
        _put(system, f"{home}/_manifest.json", entry)
        system.delete_dir(self._staging())
        index = [e for e in _index(self.root) if (e["release"], e["table"]) != (self.release, self.table)]
        _put(system, f"{top}/index.json", sorted(index + [{k: v for k, v in entry.items() if k != "parts"} | {"parts": len(parts)}], key=lambda e: (e["release"], e["table"])))

    def abort(self, messages: list[Part | None]) -> None:
        from pyarrow import fs

        system = file_system(self.root)[0]
        if system.get_file_info(self._staging()).type == fs.FileType.Directory:
            system.delete_dir(self._staging())


def _put(system, path: str, what) -> None:
    """A document, written beside and moved into place."""
    at = f"{path}.{uuid.uuid4().hex}"
    with system.open_output_stream(at) as f:
        f.write(json.dumps(what, indent=1).encode())
    system.move(at, path)


def _get(system, path: str):
    from pyarrow import fs

    if system.get_file_info(path).type == fs.FileType.NotFound:
        return None
    with system.open_input_stream(path) as f:
        return json.loads(f.read())


def _index(root: str) -> list[dict]:
    system, top = file_system(root)
    return _get(system, f"{top}/index.json") or []


class ReleaseSink(DataSource):
    """df.write.format("release_parts") with options path, release, table and job."""

    @classmethod
    def name(cls) -> str:
        return NAME

    def writer(self, schema, overwrite: bool) -> ReleaseWriter:
        return ReleaseWriter(dict(self.options), schema)


def write_table(df: DataFrame, root: str, release: str, table: str) -> None:
    """One table of a release; a table that the release already has raises an error. Rows stand in the partitions of df, so the same rows in the
    same partitions give the same digests."""
    system, top = file_system(root)
    if _get(system, f"{top}/{release}/{table}/_manifest.json"):
        raise FileExistsError(f"release {release} already has {table}")
    df.sparkSession.dataSource.register(ReleaseSink)
    df.write.format(NAME).mode("append").options(path=root, release=release, table=table, job=uuid.uuid4().hex).save()


def releases(spark: SparkSession, root: str) -> DataFrame:
    """The index: (release, table, parts, rows, bytes, digest), a row for each table of each release."""
    rows = [(e["release"], e["table"], e["parts"], e["rows"], e["bytes"], e["digest"]) for e in _index(root)]
    return spark.createDataFrame(rows, "release string, table string, parts int, rows bigint, bytes bigint, digest string")


def verified(spark: SparkSession, root: str, release: str) -> DataFrame:
    """(table, part, rows, ok) of every part that a release's manifests name; ok says whether what is stored has its digest."""
    system, top = file_system(root)
    named = [_get(system, f"{top}/{release}/{e['table']}/_manifest.json") for e in _index(root) if e["release"] == release]
    parts = [(m["table"], p["name"], p["rows"], p["digest"]) for m in named for p in m["parts"]]

    def check(batches):
        from pyarrow import fs

        system, top = file_system(root)
        for b in batches:
            ok = []
            for table, part, digest in zip(*(b.column(c).to_pylist() for c in ("table", "part", "digest")), strict=True):
                path = f"{top}/{release}/{table}/{part}"
                there = system.get_file_info(path).type == fs.FileType.File
                if there:
                    with system.open_input_stream(path) as f:
                        there = digest_of(f) == digest
                ok.append(there)
            yield pa.RecordBatch.from_arrays([b.column("table"), b.column("part"), b.column("rows"), pa.array(ok, pa.bool_())], names=["table", "part", "rows", "ok"])

    rows = spark.createDataFrame(parts, "table string, part string, rows bigint, digest string")
    spread = rows.repartition(max(1, min(len(parts), int(spark.conf.get("spark.sql.shuffle.partitions")))), F.xxhash64("table", "part"))
    return spread.mapInArrow(check, "table string, part string, rows bigint, ok boolean")
