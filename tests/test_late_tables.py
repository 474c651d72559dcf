"""State of late cases in tables: what is kept, what the keyed operators give from the same archives, and a large batch's lines by blocks."""

import os

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from sigweave.sources import archive_source, ragged
from sigweave.streaming import late

from .test_late import archives, put, rows


def test_tables_keep_a_row_of_a_report_and_case_and_give_what_keyed_state_gives(spark, tmp_path):
    (tmp_path / "in").mkdir()
    root, all_, changes = str(tmp_path / "in"), archives(), []
    for batch in ([2, 0], [1, 4]):
        for k in batch:
            put(tmp_path / "in", *all_[k])
        got = late.cases_available(spark, root, str(tmp_path / "cases"), str(tmp_path / "mark"), also=lambda df, i: changes.extend(df.collect()))
    assert not os.path.exists(tmp_path / "mark" / "state")
    kept = late.current(spark, str(tmp_path / "mark" / "tables" / "kept"))
    dead = late.current(spark, str(tmp_path / "mark" / "tables" / "dead"))
    assert kept.count() == kept.select("primaryid", "caseid").distinct().count() > got.count() and dead.count()
    assert kept.join(dead, (F.col("id") == F.col("primaryid")) | (F.col("id") == F.col("caseid"))).count() == 0
    net = {}
    for r in changes:
        net[tuple(r)[:-1]] = net.get(tuple(r)[:-1], 0) + r.sign
    assert any(r.sign < 0 for r in changes) and sorted(k for k, n in net.items() if n) == rows(got) and set(net.values()) <= {0, 1}
    keyed = late.cases_available(spark, root, str(tmp_path / "cases2"), str(tmp_path / "mark2"), keyed=True)
    assert rows(keyed) == rows(got)
    for mark, other in (("mark", True), ("mark2", False)):
        with pytest.raises(ValueError, match="other kind"):
            late.cases_available(spark, root, str(tmp_path / "cases3"), str(tmp_path / mark), keyed=other)


def test_lines_are_parsed_without_functions_over_cells(spark, tmp_path):
    heads = {"demo": "primaryid$caseid$caseversion$i_f_code$fda_dt$event_dt$sex$ $", "drug": "primaryid$caseid$drug_seq"}
    demo = ["1$2$10$F$$$M", "1$2$10$F$$$M$$", '1$2$"1$0"$F$$$"$"$$', " 1 $2$x", "$$$", "", "3$$$$$$$$", '"4"$', '5$6$"a\nb"$I$1$2$M$x$y']
    drug = ["1$2$3", "1$2$3$$", "$$$", "1", "1$2$3$x$$", "$$3 \x1f"]
    both = [(2020, 1, k, i, x) for k, some in (("demo", demo), ("drug", drug)) for i, x in enumerate([heads[k], *some])]
    archive_source.write_archives(spark.createDataFrame(both, "year int, quarter int, kind string, line_no bigint, line string"), str(tmp_path / "in")).collect()
    got = ragged.parse(archive_source.lines(spark, str(tmp_path / "in"), "demo"), "demo", quoted=True)
    cells = [tuple(r) for r in got.orderBy("line_no").select("trimmed", "padded", "folded", "primaryid", "caseid", "caseversion", "sex").collect()]
    assert cells == [
        (0, 0, 0, "1", "2", "10", "M"), (2, 0, 0, "1", "2", "10", "M"), (2, 0, 0, "1", "2", "1$0", "$"), (0, 1, 0, "1", "2", "x", ""),
        (2, 0, 0, "3", "3", "", ""), (0, 1, 0, "4", "4", "", ""), (0, 0, 1, "5", "6", "a\nb", "M$x$y"),
    ]
    drugs = ragged.parse(archive_source.lines(spark, str(tmp_path / "in"), "drug"), "drug")
    cells = [tuple(r) for r in drugs.orderBy("line_no").select("trimmed", "padded", "folded", "primaryid", "drug_seq").collect()]
    assert cells == [(0, 0, 0, "1", "3"), (2, 0, 0, "1", "3"), (1, 0, 0, "", ""), (0, 1, 0, "1", ""), (2, 0, 1, "1", "3$x"), (0, 0, 0, "", "3")]
    for df in (got, drugs):
        assert "lambda" not in df._jdf.queryExecution().optimizedPlan().toString()


def test_lines_are_joined_by_blocks(spark, tmp_path):
    batch = pa.RecordBatch.from_pydict({"year": [2020, 2020, 2020, 2021], "quarter": [1, 1, 1, 1], "kind": ["demo", "demo", "drug", "drug"]})
    assert list(archive_source._runs(batch)) == [(0, 2, 2020, 1, "demo"), (2, 3, 2020, 1, "drug"), (3, 4, 2021, 1, "drug")]
    assert list(archive_source._runs(batch.slice(0, 0))) == [] and list(archive_source._runs(batch.slice(3))) == [(0, 1, 2021, 1, "drug")]
    assert archive_source._joined(pa.array(["a", "x", "", "é一"]).slice(1)) == "x\n\né一".encode()
    lines = spark.range(40).select((2010 + F.floor(F.col("id") / 4)).cast("int").alias("year"), (F.col("id") % 4 + 1).cast("int").alias("quarter"), F.lit("demo").alias("kind"), F.col("id").alias("line_no"), F.lit("a").alias("line"))
    made = archive_source.write_archives(lines, str(tmp_path / "in")).withColumn("task", F.spark_partition_id())
    assert made.groupBy("task").count().where("count > 1").count() == 0
