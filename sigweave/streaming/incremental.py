"""Incremental runs: new archives as a file stream, and states that late rows change."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.dedup import first_wins, latest_cases


def ingest_available(spark: SparkSession, source: str, schema: str, target: str, checkpoint: str, keys: list[str] | None = None, ordinal: list[str] | None = None) -> None:
    """Write Parquet files that have arrived since the last run below target, each batch to a folder of its own; the checkpoint is the ledger of files.

    A batch that is repeated after a failure replaces what it has written. With keys the first row of each key, by ordinal (all columns, if none is given),
    stays within a batch; rows of earlier batches win over later ones when the target is read with first_wins over batch_id and the ordinal.
    """
    stream = spark.readStream.schema(schema).parquet(source)

    def put(batch: DataFrame, batch_id: int) -> None:
        rows = first_wins(batch, keys, ordinal or batch.columns) if keys else batch
        rows.write.mode("overwrite").parquet(f"{target}/batch_id={batch_id}")

    stream.writeStream.foreachBatch(put).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def count_available(spark: SparkSession, source: str, schema: str, target: str, checkpoint: str, keys: list[str], weight: str) -> None:
    """Counts by keys of files that have arrived since the last run, each batch's in a folder of its own: repeated batches replace their own counts."""
    stream = spark.readStream.schema(schema).parquet(source)

    def put(batch: DataFrame, batch_id: int) -> None:
        counts = batch.groupBy(*keys).agg(F.count("*").alias(weight))
        counts.write.mode("overwrite").parquet(f"{target}/batch_id={batch_id}")

    stream.writeStream.foreachBatch(put).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def merged_counts(state: DataFrame, batch: DataFrame, keys: list[str], weight: str) -> DataFrame:
    """Counts of a state and of a batch added up."""
    return state.unionByName(batch).groupBy(*keys).agg(F.sum(weight).cast("bigint").alias(weight))


def refreshed_cases(selected: DataFrame, history: DataFrame, batch: DataFrame, deleted: DataFrame) -> DataFrame:
    """Selected cases after a batch: cases that its rows or the deleted ids touch are decided anew over all their rows, others stay."""
    columns = selected.columns
    everything = history.unionByName(batch)
    by_report = everything.join(deleted.select(F.col("id").alias("primaryid")), "primaryid", "left_semi").select("caseid")
    # A report can name several cases, so all cases of touched reports are touched.
    touched = batch.select("caseid").unionByName(by_report).unionByName(deleted.select(F.col("id").alias("caseid"))).distinct()
    reports = everything.join(touched, "caseid", "left_semi").select("primaryid").distinct()
    touched = touched.unionByName(everything.join(reports, "primaryid", "left_semi").select("caseid")).distinct()
    anew = latest_cases(everything.join(touched, "caseid", "left_semi"), deleted)
    return selected.join(touched, "caseid", "left_anti").select(*columns).unionByName(anew.select(*columns))
