"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Words are runs of characters other than the six ASCII white-space characters.
WORD = r"[^\x20\x09-\x0D]+"


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir. Only a local master may do without it and gets a temporary one."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        folder = getattr(shared_dir, "own", None) or tempfile.mkdtemp(prefix="sigweave-")
        shared_dir.own = folder
    return folder.rstrip("/")


def fresh_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/sigweave-{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write df to the shared folder and read it again: cuts lineage, survives lost executors, is computed once."""
    path = fresh_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._sigweave_path = path
    return out


def remove(*frames: DataFrame) -> None:
    """Delete what materialize has written for these frames, once nothing reads it any more; others are left alone."""
    for df in frames:
        if path := getattr(df, "_sigweave_path", None):
            spark = df.sparkSession
            at = spark._jvm.org.apache.hadoop.fs.Path(path)
            at.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(at, True)


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def map_columns(df: DataFrame, keep: list[str | Column], args: list[Column], made: dict[str, str], func: Callable[..., Iterator[list] | list[list]], most_bytes: int | None = None, **options) -> DataFrame:
    """Columns `keep` of df, and those that func(args as Arrow arrays, **options) makes of each Arrow batch (a list for each).

    made gives the new columns' names and SQL types. Arguments travel under private names, so df may have any columns. With most_bytes, func gets
    slices of a batch whose arguments (text or binary) hold about so many bytes, or one row, so that what it makes of a batch needn't be held at once.
    """
    names = [f"__sigweave_arg{i}" for i in range(len(args))]
    kept = df.select(*keep, *(a.alias(n) for a, n in zip(args, names, strict=True)))
    n_kept = len(kept.columns) - len(args)
    schema = T.StructType(list(kept.schema.fields[:n_kept]))
    new = T.StructType.fromDDL(", ".join(f"`{n}` {k}" for n, k in made.items())).fields
    schema = T.StructType(schema.fields + new)

    def run(batches):
        from pyspark.sql.pandas.types import to_arrow_type

        types = [to_arrow_type(k.dataType) for k in new]
        for batch in batches:
            if not batch.num_rows:
                continue
            for some in slices(batch, n_kept, most_bytes):
                out = func(*(some.column(n_kept + i) for i in range(len(names))), **options)
                cols = [o if isinstance(o, pa.Array) else pa.array(o, type=t) for o, t in zip(out, types, strict=True)]
                yield pa.RecordBatch.from_arrays([some.column(i) for i in range(n_kept)] + cols, names=[f.name for f in schema.fields])

    return kept.mapInArrow(run, schema)


def slices(batch: pa.RecordBatch, first: int, most_bytes: int | None) -> Iterator[pa.RecordBatch]:
    """The batch in slices of rows that begin in the same stretch of most_bytes of the columns from `first` on; whole if that is None."""
    if most_bytes is None:
        yield batch
        return
    sizes = sum(pc.fill_null(pc.binary_length(c), 0).to_numpy(zero_copy_only=False).astype(np.int64) for c in batch.columns[first:])
    stretch = (np.cumsum(sizes) - sizes) // most_bytes
    cuts = [0, *(np.flatnonzero(np.diff(stretch)) + 1).tolist(), batch.num_rows]
    for a, b in zip(cuts, cuts[1:], strict=False):
        yield batch.slice(a, b - a)


def as_bytes(column: pa.Array) -> list[bytes]:
    """UTF-8 of a string column; null counts as empty."""
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


def as_text(column: pa.Array) -> list[str]:
    return [x or "" for x in column.to_pylist()]


def text_of(df: DataFrame, name: str) -> Column:
    """The text column, or empty text where the table has none."""
    return F.col(f"`{name}`").cast("string") if name in df.columns else F.lit("")
