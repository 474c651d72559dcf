"""Vocabulary files: delimited text read by position."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import nfkc, normalize_text, strip
from ..operators.dedup import first_wins, last_wins


def positional(spark: SparkSession, path: str, delimiter: str, columns: dict[str, int], least: int = 0, charset: str = "UTF-8") -> DataFrame:
    """(columns, line_no): fields by position of lines that have `least` fields; line_no grows within a file in line order."""
    raw = spark.read.format("binaryFile").load(path) if charset != "UTF-8" else None
    if raw is not None:
        lines = raw.select(F.posexplode(F.split(F.decode("content", charset), "\r?\n")).alias("line_no", "line"))
    else:
        lines = spark.read.text(path).select(F.monotonically_increasing_id().alias("line_no"), F.col("value").alias("line"))
    parts = F.split("line", "\\" + delimiter, -1)
    return lines.where(F.size(parts) >= least).select(*(F.trim(F.coalesce(F.get(parts, F.lit(i)), F.lit(""))).alias(k) for k, i in columns.items()), F.col("line_no").cast("bigint").alias("line_no"))


def concepts(spark: SparkSession, path: str) -> DataFrame:
    """English, unsuppressed concept names, in compatibility form."""
    rows = positional(spark, path, "|", {"rxcui": 0, "lat": 1, "sab": 11, "tty": 12, "code": 13, "string": 14, "suppress": 16}, 17)
    return compatible(rows.where("lat = 'ENG' AND suppress = 'N'").drop("lat", "suppress"), "string")


def compatible(rows: DataFrame, column: str) -> DataFrame:
    """rows with NFKC of a column; only strings beyond Latin-1, whose forms the JVM functions do not know, go through Python."""
    far = F.col(column).rlike(r"[^\x00-\xFF]")
    return rows.where(~far | F.col(column).isNull()).unionByName(nfkc(rows.where(far), column))


def names(spark: SparkSession, path: str, key: str = "DrugID", value: str = "DrugName", out: str = "name", blank: bool = True) -> DataFrame:
    """(dbid, name) or (dbid, inchi) from a CSV with a header: ids in upper case, the first row of an id; blank: keep ids without a value."""
    rows = spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(path).withColumn("line_no", F.monotonically_increasing_id())
    rows = compatible(rows, value).select(normalize_text(F.col(key)).alias("dbid"), normalize_text(F.col(value), upper=False).alias(out), "line_no")
    rows = rows.where(F.col("dbid") != "") if blank else rows.where((F.col("dbid") != "") & (F.col(out) != ""))
    return first_wins(rows, ["dbid"], ["line_no"]).drop("line_no")


def structures(spark: SparkSession, path: str) -> DataFrame:
    """(dbid, inchi) from a CSV (DrugID, InChI): the first row of an id that has one."""
    return names(spark, path, "DrugID", "InChI", "inchi", blank=False)


def concept_links(spark: SparkSession, path: str, source: str = "DRUGBANK") -> DataFrame:
    """(rxcui, code) of a source's rows, whatever their language; codes begin with DB, and concept ids are not blank."""
    rows = positional(spark, path, "|", {"rxcui": 0, "sab": 11, "code": 13}, 17).where(F.col("sab") == source)
    return rows.where(F.col("code").startswith("DB") & (F.col("rxcui") != "")).select("rxcui", "code").distinct()


def relations(spark: SparkSession, path: str) -> DataFrame:
    from ..operators.match import relation_allowed

    rows = positional(spark, path, "|", {"a": 0, "rel": 3, "b": 4, "rela": 7, "suppress": 14}, 15)
    return rows.where((F.col("suppress").isin("", "N")) & relation_allowed(F.col("rela"), F.col("rel"))).select("a", "b")


def mapping(spark: SparkSession, path: str, key: int, value: int, wins: str = "first", charset: str = "ISO-8859-1") -> DataFrame:
    """(key, value) with one row for each key, the first or the last line's."""
    rows = positional(spark, path, "$", {"key": key, "value": value}, max(key, value) + 1, charset).where("key <> ''")
    return (first_wins if wins == "first" else last_wins)(rows, ["key"], ["line_no"]).drop("line_no")


def hierarchy(spark: SparkSession, path: str, charset: str = "ISO-8859-1") -> DataFrame:
    """(pt_code, soc_code, pt_name, soc_name, soc_code_primary, is_primary, line_no) of the hierarchy's lines with at least 12 fields."""
    columns = {"pt_code": 0, "soc_code": 3, "pt_name": 4, "soc_name": 7, "soc_code_primary": 10, "flag": 11}
    rows = positional(spark, path, "$", columns, 12, charset)
    return rows.where("pt_code <> ''").withColumn("is_primary", (F.upper("flag") == "Y").cast("int")).drop("flag")


def reaction_resources(spark: SparkSession, root: str) -> dict[str, DataFrame | str] | None:
    """preferred (name, code), lower (name, code), their folder and its release: the last part of its path that holds a version number; None without both files."""
    folder = find_folder(spark, root, "pt.asc")
    if folder is None or find_folder(spark, folder, "llt.asc") is None:
        return None
    preferred = mapping(spark, f"{folder}/pt.asc", 1, 0).toDF("name", "code")
    lower = mapping(spark, f"{folder}/llt.asc", 1, 2).toDF("name", "code")
    found = [x for x in folder.split("/") if re.search(r"\d+[._]\d+", x)]
    return {"preferred": preferred, "lower": lower, "folder": folder, "release": re.search(r"\d+[._]\d+", found[-1])[0].replace("_", ".") if found else ""}


def correction_list(spark: SparkSession, path: str, actions: tuple[str, ...] | None = ("MAP_TO_TERM", "EXCLUDE_NON_DRUG")) -> DataFrame:
    rows = spark.read.option("header", True).csv(path).withColumn("line_no", F.monotonically_increasing_id())
    rows = rows.withColumn("action", F.upper(F.trim("action")))
    return last_wins(rows.where(F.col("action").isin(*actions)) if actions else rows, ["term_std"], ["line_no"])


def override_list(spark: SparkSession, path: str, term: str = "pt_norm", code: str = "pt_code") -> DataFrame:
    """(term, code, line_no) of rows that have both: a byte order mark goes, terms are stripped and put in upper case."""
    rows = spark.read.option("header", True).csv(path)
    rows = rows.toDF(*(c.lstrip("\ufeff") for c in rows.columns)).withColumn("line_no", F.monotonically_increasing_id())
    rows = rows.select(F.upper(strip(F.coalesce(F.col(term), F.lit("")))).alias(term), strip(F.coalesce(F.col(code), F.lit(""))).alias(code), "line_no")
    return rows.where((F.col(term) != "") & (F.col(code) != ""))


def find_folder(spark: SparkSession, root: str, member: str = "pt.asc") -> str | None:
    """The folder below root that holds a file `member`: the least deep one, then the first by name; None without one. Files are listed, not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", member).load(root)
    folder = F.regexp_replace("path", "/[^/]*$", "")
    best = files.select(folder.alias("folder")).orderBy(F.size(F.split("folder", "/")), "folder").first()
    return best and best.folder
