"""Coverage reports and sinks."""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


def coverage(df: DataFrame, weight: Column, **mapped: Column) -> DataFrame:
    """One row: terms and weight in all, and of each condition with its ratios; one scan."""
    aggs = [F.count("*").alias("terms"), F.sum(weight).alias("rows")]
    for name, c in mapped.items():
        aggs += [F.count_if(c).alias(f"terms_{name}"), F.coalesce(F.sum(F.when(c, weight)), F.lit(0)).alias(f"rows_{name}")]
    out = df.agg(*aggs)
    for name in mapped:
        for what in ("terms", "rows"):
            out = out.withColumn(f"{what}_{name}_ratio", F.round(F.coalesce(F.try_divide(f"{what}_{name}", what), F.lit(0.0)), 6))
    return out


def write_csv(df: DataFrame, path: str, *order: Column | str, compression: str = "none") -> int:
    """Ordered CSV with a header in one file, for exports of bounded size; the number of rows, counted as they are written."""
    seen = Observation()
    rows = df.orderBy(*order).coalesce(1).observe(seen, F.count(F.lit(1)).alias("n"))  # behind the sort, whose sampling would count, too
    rows.write.mode("overwrite").option("header", True).option("escape", '"').option("compression", compression).csv(path)
    return seen.get["n"]


def write_master(corrections: DataFrame, path: str) -> int:
    """The master list of corrections, in order of its terms; the number of its rows."""
    return write_csv(corrections.select("term_std", "action", "target_term", "note"), path, "term_std")


def backed_up(df: DataFrame, path: str) -> bool:
    """Keep df as a backup at path unless there is one: a later pass never replaces what the first one found. Whether it was written."""
    spark = df.sparkSession
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    if at.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).exists(at):
        return False
    df.write.parquet(path)
    return True


def write_json(metrics: DataFrame, path: str) -> None:
    """A one-row table as an indented JSON document."""
    _write_document(metrics.sparkSession, metrics.first().asDict(), path)


def _write_document(spark: SparkSession, what: dict, path: str) -> None:
    text = json.dumps(what, indent=2, ensure_ascii=False, default=str)
    spark.createDataFrame([(text,)], "value string").coalesce(1).write.mode("overwrite").text(path)


def reported(spark: SparkSession, path: str, job: Callable[[], object]) -> object:
    """What job() returns; if it fails, a JSON document with the error is left at path, and the error is raised again."""
    try:
        return job()
    except Exception as e:
        _write_document(spark, {"status": "error", "error_type": type(e).__name__, "error": str(e)}, path)
        raise


def write_decisions(decisions: DataFrame, path: str, *order: Column | str, size: int = 500) -> None:
    """Decisions in numbered batches of `size` rows, a folder for each (batch_id=), as the audit trail of a curation pass."""
    from .graph import surrogate

    keyed = decisions.withColumn("__k", F.struct(F.struct(*order), F.struct(*(F.col(f"`{c}`") for c in decisions.columns))))
    ids = surrogate(keyed, "__k", "n").select("__k", (F.floor((F.col("n") - 1) / size) + 1).alias("batch_id"))
    keyed.join(ids, "__k").drop("__k").repartition("batch_id").write.mode("overwrite").partitionBy("batch_id").option("header", True).csv(path)


def manifest(spark: SparkSession, root: str) -> DataFrame:
    """(path, bytes, sha256) of the data files below root; a file is read whole in one task, so releases should be cut into files of moderate size."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
    return files.select("path", F.col("length").alias("bytes"), F.sha2("content", 256).alias("sha256")).where(~F.element_at(F.split("path", "/"), -1).rlike(r"^[_.]"))


def write_release(tables: dict[str, DataFrame], root: str) -> DataFrame:
    """Tables as Parquet below root, and manifest.csv with the digests of their files, which is returned."""
    spark = next(iter(tables.values())).sparkSession
    for name, table in tables.items():
        table.write.mode("overwrite").parquet(f"{root}/tables/{name}")
    found = manifest(spark, f"{root}/tables")
    write_csv(found, f"{root}/manifest.csv", "path")
    return found
