"""Archives as a data source: planning by member, one pass, streams with a ledger, and archives written by tasks."""

import io
import shutil
import struct
import zipfile

import pytest
from pyspark.sql import functions as F

from sigweave.operators import cases
from sigweave.sources import archive_source, ragged

DEMO = "primaryid$caseid$caseversion$i_f_code$fda_dt$event_dt$sex$age$reporter_country"


def archive(folder, name, quarter, **members):
    folder.mkdir(exist_ok=True)
    with zipfile.ZipFile(folder / name, "w", zipfile.ZIP_DEFLATED) as z:
        for kind, body in members.items():
            z.writestr(f"ascii/{kind.upper()}{quarter}.txt", body.encode("latin-1"))


@pytest.fixture
def root(tmp_path):
    folder = tmp_path / "in"
    archive(folder, "faers_ascii_2019q1.zip", "19Q1", readme="x", demo=DEMO + '\n\n101$1$1$I$20190101$$M$1$"A$B"\n$2$1$I$2019$$F$2$"two\nlines"\n$$1$I$2019$$F$2$\n', drug="ISR$CASE$drug_seq$drugname$$\n101$1$1$a\x85b$$\n101$1$2$ASPIRIN$$$\n", reac="pt$primaryid\npain$101\n")
    archive(folder, "AERS_ASCII_2004Q3.ZIP", "04Q3", demo="ISR$CASE$FOLL_SEQ$GNDR_COD\n5$6$7$F\n", delete="77$x\nno\n 78 \n", drug="ISR$drugname\n5$first$2\n6$second\n")
    archive(folder, "faers_ascii_2020q2.zip", "20Q2", delete="5\n")
    archive(folder, "faers_ascii_2020q3.zip", "20Q3", demo="", drug="primaryid$drugname\n")
    return folder


def seen(rows, *columns):
    return sorted(tuple(r[c] for c in columns) for r in rows.collect())


def test_every_table_as_by_whole_archives(spark, root):
    for table in ("demo", "drug", "reac"):
        quoted = table == "demo"
        one = ragged.parse(archive_source.lines(spark, str(root), table), table, quoted)
        other = ragged.parse(ragged.archive_lines(spark, str(root), table), table, quoted)
        columns = other.columns
        assert seen(one, *columns) == seen(other, *columns) and one.count() > 0
    demo = ragged.parse(archive_source.lines(spark, f"file://{root}", "demo"), "demo", True)
    assert seen(demo, "file_rank", "primaryid", "caseid", "sex", "reporter_country") == [(1, "5", "6", "F", ""), (2, "101", "1", "M", "A$B"), (2, "2", "2", "F", "two\nlines")]
    drug = ragged.parse(archive_source.lines(spark, str(root), "drug", {(2004, 3): "6$"}), "drug")
    assert seen(drug, "primaryid", "drugname", "padded", "trimmed", "folded") == [("101", "ASPIRIN", 0, 3, 0), ("101", "a", 0, 0, 0), ("5", "first$2", 0, 0, 1), ("6", "second", 0, 0, 0), ("b", "", 1, 0, 0)]
    assert seen(ragged.deleted_ids(archive_source.lines(spark, str(root), "delete")), "id") == [("77",), ("78",)]  # 2020q2 has no reports
    assert seen(cases.cases_from_archives(spark, str(root)), "caseid", "primaryid") == [("1", "101"), ("2", "2"), ("6", "5")]
    with pytest.raises(Exception, match="table is one of"):
        archive_source.lines(spark, str(root), "other").collect()
    (root / "none").mkdir()
    assert archive_source.lines(spark, str(root / "none"), "demo").count() == 0


def test_lost_line_breaks(spark, tmp_path):
    archive(tmp_path / "lost", "aers_ascii_2011q4.zip", "11Q4", drug="ISR$CASE$drug_seq$drugname\n1$1$1$a2$1$2$b\n2$1$3$c\n")
    archive(tmp_path / "lost", "aers_ascii_2012q1.zip", "12Q1", drug="ISR$CASE$drug_seq$drugname\n1$1$1$a2$1$2$b\n")
    for read in (archive_source.lines, ragged.archive_lines):
        got = ragged.parse(read(spark, str(tmp_path / "lost"), "drug", {(2011, 4): "2$1$2"}), "drug")
        assert seen(got, "year", "drug_seq", "drugname") == [(2011, "1", "a"), (2011, "2", "b"), (2011, "3", "c"), (2012, "1", "a2$1$2$b")]


def test_members_are_read_once_and_in_parts(spark, root, tmp_path, monkeypatch):
    """No value holds an archive: the reader of whole files refuses what this source streams, and each member is opened once."""
    monkeypatch.setattr(archive_source, "ROWS", 2)
    log = tmp_path / "log"
    opened = {"path": str(log)}

    class Counting(archive_source.ArchiveSource):
        @classmethod
        def name(cls):
            return "counting"

        def reader(self, schema):
            class Reader(archive_source.ArchiveReader):
                def read(self, partition):
                    with open(opened["path"], "a") as f:
                        f.write(partition.name + "\n")
                    return super().read(partition)

            return Reader(dict(self.options))

    spark.dataSource.register(Counting)
    lines = spark.read.format("counting").option("path", str(root)).option("table", "drug").load()
    assert lines.rdd.getNumPartitions() == 3
    assert ragged.parse(lines, "drug").count() == 5
    assert sorted(log.read_text().split()) == ["ascii/DRUG04Q3.txt", "ascii/DRUG19Q1.txt", "ascii/DRUG20Q3.txt"]
    spark.conf.set("spark.sql.sources.binaryFile.maxLength", "100")
    try:
        with pytest.raises(Exception, match="exceeds the max length"):
            ragged.archive_lines(spark, str(root), "drug").count()
        assert archive_source.lines(spark, str(root), "drug").count() == 5
    finally:
        spark.conf.unset("spark.sql.sources.binaryFile.maxLength")


def test_planning_reads_directories_only(root, monkeypatch):
    """A damaged member does not disturb planning, and only a few bytes of each archive are asked for."""
    body = bytearray((root / "faers_ascii_2019q1.zip").read_bytes())
    at = struct.unpack("<H", body[26:28])[0] + 30
    body[at : at + 1] = b"\xff"
    (root / "faers_ascii_2019q1.zip").write_bytes(body)
    reader = archive_source.ArchiveReader({"path": str(root), "table": "reac"})
    (only,) = reader.partitions()
    assert (only.name, only.file_rank, only.archive.year) == ("ascii/REAC19Q1.txt", 2, 2019)
    big = io.BytesIO()
    with zipfile.ZipFile(big, "w") as z:
        z.writestr("DEMO21Q1.txt", DEMO + "\n" + "1$1$\n" * 400_000)
    (root / "faers_ascii_2021q1.zip").write_bytes(big.getvalue())
    read, whole = [], archive_source.file_system

    class Counted:
        def __init__(self, f):
            self.f = f

        def read(self, n=-1):
            got = self.f.read() if n is None or n < 0 else self.f.read(n)
            read.append(len(got))
            return got

        def __getattr__(self, name):
            return getattr(self.f, name)

    class System:
        def __init__(self, path):
            self.system, self.top = whole(path)

        def open_input_file(self, path):
            return Counted(self.system.open_input_file(path))

        def get_file_info(self, selector):
            return self.system.get_file_info(selector)

    monkeypatch.setattr(archive_source, "file_system", lambda path: (System(path), whole(path)[1]))
    assert len(archive_source.ArchiveReader({"path": str(root), "table": "demo"}).partitions()) == 4
    assert 0 < sum(read) < 10_000


def stream_into(spark, root, target, mark, fail=False):
    def put(batch, batch_id):
        rows = ragged.parse(batch, "demo", True)
        rows.write.mode("overwrite").parquet(f"{target}/batch_id={batch_id}")
        if fail:
            raise RuntimeError("lost")

    archive_source.line_stream(spark, str(root), "demo").writeStream.foreachBatch(put).option("checkpointLocation", mark).trigger(availableNow=True).start().awaitTermination()


def test_a_stream_reads_each_archive_once(spark, root, tmp_path):
    target, mark, late = str(tmp_path / "out"), str(tmp_path / "mark"), tmp_path / "late"
    late.mkdir()
    shutil.move(root / "faers_ascii_2019q1.zip", late)
    stream_into(spark, root, target, mark)
    stream_into(spark, root, target, mark)  # nothing new
    shutil.move(late / "faers_ascii_2019q1.zip", root)
    archive(root, "faers_ascii_2021q1.zip", "21Q1", demo=DEMO + "\n900$9$1$I$2021$$M$1$US\n")
    with pytest.raises(Exception, match="lost"):
        stream_into(spark, root, target, mark, fail=True)  # ends between writing and committing
    stream_into(spark, root, target, mark)
    columns = ["year", "quarter", "zip", "line_no", "primaryid", "caseid"]
    assert seen(spark.read.parquet(target), *columns) == seen(ragged.parse(archive_source.lines(spark, str(root), "demo"), "demo", True), *columns)
    (root / "faers_ascii_2021q1.zip").write_bytes(b"")
    with pytest.raises(Exception, match="have changed"):
        stream_into(spark, root, target, mark)


def test_archives_written_by_tasks(spark, tmp_path):
    rows = spark.range(5000).select(
        (F.lit(2010) + F.col("id") % 3).cast("int").alias("year"), (F.col("id") % 4 + 1).cast("int").alias("quarter"), F.when(F.col("id") % 5 == 0, "demo").otherwise("reac").alias("kind"), F.col("id").alias("line_no"),
        F.concat(F.col("id").cast("string"), F.lit("$é$日")).alias("line"),
    )
    heads = rows.select("year", "quarter", "kind").distinct().select("*", F.lit(-1).cast("bigint").alias("line_no"), F.when(F.col("kind") == "demo", "primaryid$sex$age").otherwise("primaryid$pt$x").alias("line"))
    for _ in range(2):  # again, as a repeated task would
        made = archive_source.write_archives(rows.unionByName(heads), str(tmp_path / "made")).collect()
    assert len(made) == 12 and sum(r.lines for r in made) == 5024 and len(list((tmp_path / "made").iterdir())) == 12
    got = ragged.parse(archive_source.lines(spark, str(tmp_path / "made"), "reac"), "reac")
    assert got.count() == 4000 and seen(got.select("pt").distinct(), "pt") == [("é",)]
    assert ragged.parse(archive_source.lines(spark, str(tmp_path / "made"), "demo"), "demo", True).select("age").distinct().collect() == [("?",)]
