"""Ragged, versioned report archives: discovery, members, and rows repaired to their header."""

from __future__ import annotations

import io
import re
from itertools import chain

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.text import WS_CHARACTERS

# Names of archives, members of an archive, and the columns of its tables with their older names. Names are matched whole.
ARCHIVE = r"(?i)(?:^|/)f?aers_ascii_(20\d\d)q([1-4])\.zip$"
MEMBERS = {
    "demo": r"(?i)(?:^|/)demo\d\dq[1-4](?:_new)?\.txt$", "delete": r"(?i)(?:^|/)delete\d\dq[1-4]\.txt$",
    "drug": r"(?i)(?:^|/)drug\d\dq[1-4](?:_new)?\.txt$", "reac": r"(?i)(?:^|/)reac\d\dq[1-4](?:_new)?\.txt$",
}
COLUMNS = {
    "demo": [["primaryid", "isr"], ["caseid", "case"], ["caseversion", "foll_seq"], ["i_f_code", "i_f_cod"], ["fda_dt"], ["event_dt"], ["sex", "gndr_cod"], ["age"], ["reporter_country"]],
    "drug": [["primaryid", "isr"], ["caseid", "case"], ["drug_seq"], ["role_cod"], ["drugname"], ["prod_ai"], ["route"], ["dose_vbm"], ["val_vbm"]],
    "reac": [["primaryid", "isr"], ["caseid", "case"], ["pt"], ["drug_rec_act"]],
}

#: Characters of a member that are cut into lines at once.
BLOCK = 1 << 20


def archives(spark: SparkSession, root: str) -> DataFrame:
    """(path, zip, year, quarter, file_rank) of the archives below root, ranked by year, quarter and name in lower case. Files are listed, not read."""
    name = F.regexp_extract("path", "([^/]*)$", 1)
    part = lambda i: F.regexp_extract("path", ARCHIVE, i).cast("int")
    rows = _files(spark, root).select("path", name.alias("zip"), part(1).alias("year"), part(2).alias("quarter"))
    order = Window.orderBy("year", "quarter", F.lower("zip"), "path")  # a row for each archive
    return rows.withColumn("file_rank", F.row_number().over(order))


def _files(spark: SparkSession, root: str) -> DataFrame:
    found = spark.read.format("binaryFile").option("pathGlobFilter", "*.[zZ][iI][pP]").option("recursiveFileLookup", "true").load(root)
    return found.where(F.col("path").rlike(ARCHIVE))


def _rows_of(stream, table: str, token: str | None):
    """Lines of a member as it is read; demo tables are cut into records, as quotes may hold line breaks there."""
    return chain.from_iterable(_lists_of(stream, table, token))


def _lists_of(stream, table: str, token: str | None):
    """The same in lists, each of about a block's lines."""
    import csv

    broken = re.compile(f"(?<=[^\n])(?={re.escape(token)})") if token else None

    def blocks():
        """The member in blocks of whole lines."""
        while block := stream.read(BLOCK):
            block += stream.readline()
            yield broken.sub("\n", block) if broken else block

    if table != "demo":
        for block in blocks():
            yield block.splitlines()
        return
    csv.field_size_limit(1 << 30)
    ends: list[int] = []  # lines that have been cut off, by block

    def cut():
        for block in blocks():
            some = block.split("\n")
            last = some.pop()
            yield from (x + "\n" for x in some)
            if last:
                yield last
            ends.append(1)

    lines, out = cut(), []
    for line in lines:
        if '"' not in line and "\r" not in line:
            out.append(line.rstrip("\n"))
        else:
            held: list[str] = []

            def feed(first=line, held=held):
                for x in chain([first], lines):
                    held.append(x)
                    yield x

            next(csv.reader(feed(), delimiter="$"), None)
            out.append("".join(held).rstrip("\r\n"))
        if ends:
            yield out
            out = []
            ends.clear()
    yield out


def archive_lines(spark: SparkSession, root: str, table: str, lost_breaks: dict[tuple[int, int], str] | None = None) -> DataFrame:
    """(year, quarter, zip, member, line_no, line) of the first member of that kind in each archive, read as Latin-1.

    Delete lists of archives without a demo member are left out. lost_breaks gives, for (year, quarter), a token before which a line break is
    put. Report tables other than demo are cut at every character that str.splitlines() cuts at; empty lines go. An archive comes to a
    task as one value (2 GB at most); its members are read as streams.
    """
    want, demo, fix = re.compile(MEMBERS[table]), re.compile(MEMBERS["demo"]), lost_breaks or {}

    def unzip(batches):
        import io
        import zipfile
        from itertools import islice

        import pyarrow as pa

        names = ["year", "quarter", "zip", "member", "line_no", "line"]
        for b in batches:
            for path, data in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                found = re.search(ARCHIVE, path)
                with zipfile.ZipFile(io.BytesIO(data)) as z:
                    inside = z.namelist()
                    name = next((n for n in inside if want.search(n)), None)
                    if name is None or table == "delete" and not any(demo.search(n) for n in inside):
                        continue
                    year, quarter = int(found[1]), int(found[2])
                    with io.TextIOWrapper(z.open(name), encoding="latin-1", newline="\n") as stream:
                        rows = ((i, x) for i, x in enumerate(_rows_of(stream, table, fix.get((year, quarter)))) if x.strip("\r"))
                        while some := list(islice(rows, 20_000)):
                            n = len(some)
                            yield pa.RecordBatch.from_arrays([pa.array([year] * n, pa.int32()), pa.array([quarter] * n, pa.int32()), pa.array([path.rpartition("/")[2]] * n), pa.array([name] * n), pa.array([r[0] for r in some], pa.int64()), pa.array([r[1] for r in some])], names=names)

    return _files(spark, root).select("path", "content").mapInArrow(unzip, "year int, quarter int, zip string, member string, line_no bigint, line string")


def fit(cells: Column, n: int | Column) -> Column:
    """Cells to n columns: short rows are padded, what is too much is folded into the last, joined by the delimiter."""
    n = F.lit(n) if isinstance(n, int) else n
    short = F.concat(cells, F.array_repeat(F.lit(""), F.greatest(n - F.size(cells), F.lit(0))))
    long = F.concat(F.slice(cells, F.lit(1), n - 1), F.array(F.array_join(F.slice(cells, n, F.greatest(F.size(cells), F.lit(1))), "$")))
    return F.when(F.size(cells) > n, long).otherwise(short)


def without_blank_tail(cells: Column) -> Column:
    """Trailing empty cells off (of a header)."""
    last = F.aggregate(F.transform(cells, lambda x, i: F.when(F.trim(x) != "", i + 1).otherwise(0)), F.lit(0), lambda a, x: F.greatest(a, x))
    return F.slice(cells, F.lit(1), last)


def _marked(line: Column) -> Column:
    """Whether a line has a quote or a line break."""
    return F.contains(line, F.lit('"')) | F.contains(line, F.lit("\r")) | F.contains(line, F.lit("\n"))


def _cut(line: Column) -> Column:
    """Cells of a line in which quotes may hold the delimiter, and the number of them up to the last that is not empty; null for lines without quotes and line breaks."""
    made = pa.struct([("cells", pa.list_(pa.string())), ("filled", pa.int32())])

    @F.arrow_udf("struct<cells: array<string>, filled: int>")
    def cut(lines: pa.Array) -> pa.Array:
        import csv
        import io

        csv.field_size_limit(1 << 30)

        def one(x):
            if x is None:
                return None
            cells = next(csv.reader(io.StringIO(x, newline=""), delimiter="$"), [""])
            return {"cells": cells, "filled": max((i for i, c in enumerate(cells, 1) if c), default=0)}

        return pa.nulls(len(lines), made) if lines.null_count == len(lines) else pa.array([one(x) for x in lines.to_pylist()], made)

    return cut(F.when(_marked(line), line))


def quoted_cells(df: DataFrame, line: str = "line", out: str = "cells") -> DataFrame:
    """Cells of lines in which quotes may hold the delimiter (demo tables). Only lines with quotes or line breaks go to Python; others are cut by Spark."""
    whole = F.coalesce(line, F.lit(""))
    return df.withColumn(out, F.coalesce(_cut(whole)["cells"], F.split(whole, r"\$", -1)))


def with_heads(lines: DataFrame, table: str) -> DataFrame:
    """Lines after their file's first, with the width of that header and the places of the table's columns in it."""
    heads = lines.groupBy("zip", "member").agg(F.min_by("cells", "line_no").alias("head"), F.min("line_no").alias("first"))
    head = F.transform(without_blank_tail(F.col("head")), lambda x: F.lower(F.trim(x)))
    heads = heads.withColumn("head", head).withColumn("width", F.size("head"))
    place = lambda name: F.nullif(F.array_position("head", name), F.lit(0)) - 1
    places = F.array(*(F.coalesce(*map(place, names)).cast("int") for names in COLUMNS[table]))
    return lines.join(heads.withColumn("places", places).drop("head"), ["zip", "member"]).where("line_no > first")


def parse(lines: DataFrame, table: str, quoted: bool = False) -> DataFrame:
    """(year, quarter, zip, line_no, trimmed, padded, folded, columns): rows fitted to their file's header, synonyms resolved, missing columns empty.

    trimmed counts the empty cells that were cut off the end of a row longer than its header.

    Lines of sources.archive_source know the places of their columns; in other lines the first of each file is its header. The first of a
    column's names that it has is taken. Blank ids of demo rows fill each other; rows without either go.
    """
    # The cells of a row whose line is cut at every delimiter end in as many empty ones as the line ends in delimiters.
    bare = F.rtrim("line", F.lit("$"))
    filled = F.when(bare == "", 0).otherwise(F.size("cells") - (F.length("line") - F.length(bare)))
    if quoted:
        whole = F.coalesce("line", F.lit(""))
        lines = lines.withColumn("cut", _cut(whole)).withColumn("cells", F.coalesce(F.col("cut.cells"), F.split(whole, r"\$", -1)))
        filled = F.coalesce(F.col("cut.filled"), filled)
    else:
        lines = lines.withColumn("cells", F.split("line", r"\$", -1))
    rows = lines if "places" in lines.columns else with_heads(lines, table)
    n = F.col("width")
    rows = rows.withColumn("left", F.least(F.size("cells"), F.greatest(n, filled)))
    rows = rows.withColumn("padded", (F.size("cells") < n).cast("int")).withColumn("trimmed", F.size("cells") - F.col("left"))
    rows = rows.withColumn("cells", F.when(F.col("trimmed") > 0, F.slice("cells", F.lit(1), F.col("left"))).otherwise(F.col("cells")))
    rows = rows.withColumn("folded", (F.size("cells") > n).cast("int")).withColumn("cells", F.when(F.size("cells") == n, F.col("cells")).otherwise(fit(F.col("cells"), n)))
    cols = {names[0]: F.btrim(F.coalesce(F.get("cells", F.get("places", F.lit(k))), F.lit("")), F.lit(WS_CHARACTERS)) for k, names in enumerate(COLUMNS[table])}
    if table == "demo":
        # Conditions on columns would be moved below them, each with the whole expression of the cells, beyond what can be compiled; they aren't below a generator.
        rows = rows.select(*rows.columns, F.inline(F.array(F.struct(*(c.alias(k) for k, c in cols.items())))))
        p, c = F.col("primaryid"), F.col("caseid")
        rows = rows.withColumns({"primaryid": F.when(p == "", c).otherwise(p), "caseid": F.when(c == "", p).otherwise(c)}).where("primaryid <> ''")
    else:
        rows = rows.withColumns(cols)
    rank = ["file_rank"] if "file_rank" in rows.columns else []
    return rows.select("year", "quarter", "zip", *rank, "line_no", "trimmed", "padded", "folded", *cols)


def deleted_ids(lines: DataFrame) -> DataFrame:
    first = F.trim(F.split("line", r"\$")[0])
    return lines.select(first.alias("id")).where(F.col("id").rlike("^[0-9]+$")).distinct()
