"""Cases and edge weights that late quarters and deletes change, as keyed state with retractions.

State is kept in tables by report and case: the latest row of each that is not deleted, and the deleted ids. A batch adds its rows and ids to both, and what is selected
from them is held against what was selected before: an addition is 1 and a retraction -1, so rows, quarters and deletes may come in any order and in
any batches, and after each batch the sum of all changes is what the batch job selects from all archives so far. Rows of a report and case are deleted
together, so but the latest of them can ever stand for the report, and a deleted id stays deleted: nothing else has to be kept. All tables are versions, two of
which stay, and a repeated batch replaces its own. Edge weights are a table to which each batch's changes are added.

case_changes does the same by three keyed operators in a row (transformWithState), for streams of small batches: by case, rows of deleted cases are taken back; by
report, deleted reports go, and of a report's rows the latest stands for it; by case again, of a case's reports the latest is selected. Each key costs several calls
between Python and the state, some milliseconds, while a batch of the tables costs a pass over what is kept.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor

from ..operators.cases import CASE_COLUMNS
from ..operators.dedup import STAGE_ONE, STAGE_TWO, date_score, digit_score, drop_tombstones, followup_rank, last_wins
from ..sources import archive_source, ragged

_ROW = "id string, first string, second string, " + ", ".join(f"{c} {'int' if c in ('year', 'quarter') else 'string'}" for c in CASE_COLUMNS)
_NAMES = [c.split(" ")[0] for c in _ROW.split(", ")]
EVENT = f"key string, sign int, {_ROW}"
DELETE = 0
_STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
_ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


_EVENT = Row("key", "sign", *_NAMES)  # by place, as input rows are read: names would be looked up for each value
_ID = _NAMES.index("id")


class _Keyed(StatefulProcessor):
    """Rows of a key, the latest of them, and whether the key has been deleted.

    A batch's events of a key are added up before they count, so their order is of no matter. A deleted key keeps nothing and passes nothing on. Rows are
    kept as a list to which a batch's are added at once; it is read again only where some are taken back. So a key costs a few calls
    of the state a batch, however many rows it has.
    """

    def __init__(self, next_key: str, order: str | None = None, forward: bool = False):
        self.next_key, self.order, self.forward = next_key, order, forward
        self.key_at, self.order_at = _NAMES.index(next_key), None if order is None else _NAMES.index(order)

    def init(self, handle) -> None:
        self.rows = handle.getListState("rows", _ROW)
        self.now = handle.getValueState("now", f"dead boolean, {_ROW}")

    def handleInputRows(self, key, rows, timerValues):
        net, held, deleted = {}, {}, False
        for r in rows:
            sign, row = r[1], tuple(r)[2:]
            if sign == DELETE:
                deleted = True
                if self.forward:
                    yield _EVENT(*r)
            else:
                net[row[_ID]] = net.get(row[_ID], 0) + sign
                held[row[_ID]] = row
        now = self.now.get()
        if now is not None and now[0]:
            return
        best = None if now is None else tuple(now)[1:]
        if deleted:
            if self.order is not None:
                yield from self._moved(best, None)
            else:
                for row in list(self.rows.get()):
                    yield self._event(-1, tuple(row))
            self.rows.clear()
            self.now.update((True, *[None] * len(_NAMES)))
            return
        new = [held[i] for i, n in net.items() if n > 0]
        gone = {i for i, n in net.items() if n < 0}
        if gone:
            kept = [row for row in map(tuple, self.rows.get()) if row[_ID] not in gone] + new
            if kept:
                self.rows.put(kept)
            else:
                self.rows.clear()
        elif new:
            kept = new if best is None else [best, *new]
            self.rows.appendList(new)
        else:
            return
        if self.order is None:
            for i, n in net.items():
                if n:
                    yield self._event(n, held[i])
            return
        last = max(kept, key=lambda row: row[self.order_at], default=None)
        if last != best:
            if last is None:
                self.now.clear()
            else:
                self.now.update((False, *last))
            yield from self._moved(best, last)

    def _moved(self, old: tuple | None, new: tuple | None):
        if old is not None:
            yield self._event(-1, old)
        if new is not None:
            yield self._event(1, new)

    def _event(self, sign: int, row: tuple) -> Row:
        return _EVENT(row[self.key_at], sign, *row)

    def close(self) -> None:
        pass


def _key(*parts: Column) -> Column:
    """Numbers that are not negative as a string of the same order, followed by the archive and the line."""
    numbers = [F.lpad(p.cast("string"), 19, "0") for p in parts]
    return F.concat_ws("\x01", *numbers, F.col("year").cast("string"), F.col("quarter").cast("string"), F.lower("zip"), "zip", F.lpad(F.col("line_no").cast("string"), 19, "0"))


def _scored(demo: DataFrame, mode: str) -> DataFrame:
    """Parsed demo rows (a batch or a stream) with both ids, and what they are ordered by."""
    return demo.where((F.trim("primaryid") != "") & (F.trim("caseid") != "")).withColumns({
        "quarter_idx": F.col("year") * 10 + F.col("quarter"), "caseversion_n": digit_score(F.col("caseversion"), mode), "primaryid_n": digit_score(F.col("primaryid"), mode),
        "fda_dt_n": date_score(F.col("fda_dt")), "event_dt_n": date_score(F.col("event_dt")), "if_rank": followup_rank(F.col("i_f_code")),
    })


def row_events(demo: DataFrame, mode: str = "glob2") -> DataFrame:
    """Events of parsed demo rows (a batch or a stream), keyed by case."""
    rows = _scored(demo, mode).withColumns({
        "key": F.col("caseid"), "sign": F.lit(1), "zip_name": F.col("zip"), "id": F.concat_ws("/", "year", "quarter", "zip", "line_no"),
        "first": _key(*map(F.col, STAGE_ONE)), "second": _key(*map(F.col, STAGE_TWO)),
    })
    return rows.select("key", "sign", *_NAMES)


def delete_events(ids: DataFrame) -> DataFrame:
    """Events of ids (column id) by which cases or reports are deleted."""
    empty = [F.lit(None).cast(c.split(" ")[1]).alias(c.split(" ")[0]) for c in _ROW.split(", ")]
    return ids.select(F.col("id").alias("key"), F.lit(DELETE).alias("sign"), *empty).withColumn("id", F.col("key"))


def case_changes(events: DataFrame) -> DataFrame:
    """Changes of the selected rows (sign 1 or -1) from a stream of events."""
    step = lambda df, processor: df.groupBy("key").transformWithState(processor, EVENT, "Append", "None")
    alive = step(events, _Keyed("primaryid", forward=True))
    return step(step(alive, _Keyed("caseid", "first")), _Keyed("caseid", "second")).drop("key", "first", "second", "id")


def _versions(spark: SparkSession, path: str) -> list[int]:
    """Whole versions of a table, in order."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = at.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    if not fs.exists(at):
        return []
    found = [x.getPath() for x in fs.listStatus(at) if x.getPath().getName().startswith("version=")]
    return sorted(int(p.getName().partition("=")[2]) for p in found if fs.exists(spark._jvm.org.apache.hadoop.fs.Path(p, "_SUCCESS")))


def current(spark: SparkSession, path: str) -> DataFrame | None:
    """The newest whole version, None if there is none."""
    found = _versions(spark, path)
    return spark.read.parquet(f"{path}/version={found[-1]}") if found else None


def _put(spark: SparkSession, path: str, batch_id: int, made: Callable[[DataFrame | None], DataFrame]) -> tuple[DataFrame | None, DataFrame]:
    """Writes what is made of the newest version before the batch as the batch's version; both versions. All but two versions go.

    The version before is left as it was, so a batch that is repeated replaces its own version.
    """
    before = [v for v in _versions(spark, path) if v < batch_id]
    old = spark.read.parquet(f"{path}/version={before[-1]}") if before else None
    made(old).write.mode("overwrite").parquet(f"{path}/version={batch_id}")
    for v in before[:-1]:
        gone = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/version={v}")
        gone.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(gone, True)
    return old, spark.read.parquet(f"{path}/version={batch_id}")


def add_changes(spark: SparkSession, path: str, batch_id: int, changes: DataFrame, keys: list[str], weight: str) -> None:
    """Adds a batch's weights to the table at path as a new version; keys whose weight becomes 0 go, and all but two versions."""
    rows = changes.select(*keys, F.col(weight).cast("bigint").alias(weight))
    _put(spark, path, batch_id, lambda old: (rows if old is None else old.unionByName(rows)).groupBy(*keys).agg(F.sum(weight).alias(weight)).where(F.col(weight) != 0))


_KEPT = [*CASE_COLUMNS, *STAGE_ONE, "ordinal"]


def _kept_rows(demo: DataFrame, mode: str) -> DataFrame:
    return _scored(demo, mode).withColumns({"zip_name": F.col("zip"), "ordinal": archive_source.archive_ordinal()}).select(*_KEPT)


def _table_changes(spark: SparkSession, target: str, state: str, batch_id: int, rows: DataFrame, ids: DataFrame) -> DataFrame:
    """Adds a batch's rows and deleted ids to what is kept, writes what is selected now, and gives the changes of it (CASE_COLUMNS, sign)."""
    union = lambda old, new: new if old is None else old.unionByName(new)
    latest = lambda df, keys, order: last_wins(df, keys, [*order, "ordinal"])
    _, dead = _put(spark, f"{state}/dead", batch_id, lambda old: union(old, ids).distinct())

    def alive(old):
        held = latest(drop_tombstones(union(old, rows), dead, ["primaryid"]), ["primaryid", "caseid"], STAGE_ONE)
        return drop_tombstones(held, dead, ["caseid"])

    _, kept = _put(spark, f"{state}/kept", batch_id, alive)
    chosen = latest(latest(kept, ["primaryid"], STAGE_ONE), ["caseid"], STAGE_TWO).select(*CASE_COLUMNS, F.lit(1).cast("bigint").alias("sign"))
    before, now = _put(spark, target, batch_id, lambda old: chosen)
    if before is None:
        return now
    return now.unionByName(before.withColumn("sign", -F.col("sign"))).groupBy(*CASE_COLUMNS).agg(F.sum("sign").alias("sign")).where("sign <> 0")


def pair_deltas(changes: DataFrame, compounds: DataFrame, outcomes: DataFrame) -> DataFrame:
    """(compound, outcome, n_reports) by which a batch's changes of selected rows change the weights of pairs.

    compounds and outcomes are facts by (year, quarter, primaryid). What a quarter's file says of a report never changes, so what a
    retraction takes away is what the addition brought. A report that leaves and comes back in one batch is added up first.
    """
    report = ["year", "quarter", "primaryid"]
    moved = changes.groupBy(*report).agg(F.sum("sign").alias("sign")).where("sign <> 0")
    c = compounds.select(*report, "compound").join(moved, report).distinct()
    o = outcomes.select(*report, "outcome").join(moved, report, "left_semi").distinct()
    return c.join(o, report).groupBy("compound", "outcome").agg(F.sum("sign").alias("n_reports")).where("n_reports <> 0")


def cases_available(
    spark: SparkSession, root: str, target: str, checkpoint: str, lost_breaks: dict | None = None, mode: str = "glob2", also: Callable[[DataFrame, int], None] | None = None,
    keyed: bool = False,
) -> DataFrame:
    """Selected cases after all archives below root that have come since the last run; the first run takes all.

    The checkpoint holds the ledger of archives and the state: tables, or with keyed that of case_changes; a checkpoint stays with the kind it began with. also gets each
    batch's changes, for what follows from them; it may be called again with the same batch.
    """
    demo = ragged.parse(archive_source.line_stream(spark, root, "demo", lost_breaks), "demo", quoted=True)
    deleted = archive_source.line_stream(spark, root, "delete").select(F.trim(F.split("line", r"\$")[0]).alias("id")).where(F.col("id").rlike("^[0-9]+$"))

    def put_changes(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            if also:
                also(batch, batch_id)
            add_changes(spark, target, batch_id, batch, CASE_COLUMNS, "sign")
        finally:
            batch.unpersist()

    def put_rows(batch: DataFrame, batch_id: int) -> None:
        batch.persist(StorageLevel.DISK_ONLY)
        try:
            rows, ids = batch.where(F.col("sign") != DELETE).select(*_KEPT), batch.where(F.col("sign") == DELETE).select("id")
            changes = _table_changes(spark, target, f"{checkpoint}/tables", batch_id, rows, ids)
        finally:
            batch.unpersist()
        if also:
            also(changes, batch_id)

    kinds = {spark._jvm.org.apache.hadoop.fs.Path(checkpoint, x) for x in ("state", "tables")}
    fs = next(iter(kinds)).getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    if any(fs.exists(p) and (p.getName() == "state") != keyed for p in kinds):
        raise ValueError(f"{checkpoint} holds state of the other kind")
    before = spark.conf.get(_STATE_STORE)
    spark.conf.set(_STATE_STORE, _ROCKS)
    try:
        if keyed:
            changes, put = case_changes(row_events(demo, mode).unionByName(delete_events(deleted))), put_changes
        else:
            rows = _kept_rows(demo, mode).withColumns({"sign": F.lit(1), "id": F.lit(None).cast("string")})
            changes, put = rows.unionByName(deleted.withColumn("sign", F.lit(DELETE)), allowMissingColumns=True), put_rows
        stream = changes.writeStream.foreachBatch(put).outputMode("append").option("checkpointLocation", checkpoint)
        stream.trigger(availableNow=True).start().awaitTermination()
    finally:
        spark.conf.set(_STATE_STORE, before)
    found = current(spark, target)
    return spark.createDataFrame([], _selected_schema()) if found is None else found.drop("sign")


def _selected_schema() -> str:
    return ", ".join(f"{c} {'int' if c in ('year', 'quarter') else 'string'}" for c in CASE_COLUMNS)
