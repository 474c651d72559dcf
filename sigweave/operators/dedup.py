"""Latest-record deduplication and tombstones."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def digit_score(c: Column, mode: str = "glob2") -> Column:
    """Leading digits as a number, 0 if there are none; glob2 asks for two digits at least (as the archives' rule does)."""
    t = F.trim(c)
    least = 2 if mode == "glob2" else 1
    digits = F.regexp_extract(t, "^([0-9]+)", 1)
    return F.when(t.rlike(rf"^[0-9]{{{least}}}"), F.coalesce(digits.try_cast("bigint"), F.lit((1 << 63) - 1))).otherwise(F.lit(0)).cast("bigint")


def date_score(c: Column) -> Column:
    """Eight digits as a number, else 0; no calendar is consulted."""
    return F.when(c.rlike("^[0-9]{8}$"), c.try_cast("bigint")).otherwise(F.lit(0)).cast("bigint")


def followup_rank(c: Column) -> Column:
    return F.when(F.upper(F.trim(c)) == "F", 2).when(F.upper(F.trim(c)) == "I", 1).otherwise(0)


def top_one(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The first row of each key; the order should end in an ingest ordinal, so that ties are settled."""
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("__rank", rank).where("__rank = 1").drop("__rank")


def first_wins(df: DataFrame, keys: list[str], ordinal: list[str]) -> DataFrame:
    return top_one(df, keys, [F.asc(c) for c in ordinal])


def last_wins(df: DataFrame, keys: list[str], ordinal: list[str]) -> DataFrame:
    return top_one(df, keys, [F.desc(c) for c in ordinal])


def drop_tombstones(df: DataFrame, dead: DataFrame, keys: list[str], dead_key: str = "id") -> DataFrame:
    """Rows none of whose keys is in dead: one anti join for each key; an OR would become a nested loop."""
    dead = dead.select(F.col(dead_key).alias("__dead")).distinct()
    for k in keys:
        df = df.join(dead, df[k] == dead["__dead"], "left_anti")
    return df


STAGE_ONE = ("quarter_idx", "fda_dt_n", "if_rank", "event_dt_n", "caseversion_n", "primaryid_n")
STAGE_TWO = ("caseversion_n", "fda_dt_n", "if_rank", "event_dt_n", "quarter_idx", "primaryid_n")


def latest_cases(demo: DataFrame, deleted: DataFrame, mode: str = "glob2", ordinal: str = "ingest_ordinal") -> DataFrame:
    """One row for each case: deleted ids go, the latest row of each report stays, then the latest report of each case."""
    scored = demo.where((F.trim("primaryid") != "") & (F.trim("caseid") != ""))
    scored = drop_tombstones(scored, deleted, ["primaryid"])
    scored = scored.withColumns({
        "quarter_idx": F.col("year") * 10 + F.col("quarter"), "caseversion_n": digit_score(F.col("caseversion"), mode), "primaryid_n": digit_score(F.col("primaryid"), mode),
        "fda_dt_n": date_score(F.col("fda_dt")), "event_dt_n": date_score(F.col("event_dt")), "if_rank": followup_rank(F.col("i_f_code")),
    })
    latest = lambda df, keys, order: top_one(df, keys, [*(F.desc(c) for c in order), F.desc(ordinal)])
    # Rows of a report and case are deleted together, so but one of them travels to its case's deletion.
    scored = drop_tombstones(latest(scored, ["primaryid", "caseid"], STAGE_ONE), deleted, ["caseid"])
    return latest(latest(scored, ["primaryid"], STAGE_ONE), ["caseid"], STAGE_TWO)


def select_facts(facts: DataFrame, cases: DataFrame) -> DataFrame:
    """Facts of selected reports from the selected quarter, with the selected case id; caseid_overridden tells where it differed."""
    keys = cases.select("year", "quarter", "primaryid", F.col("caseid").alias("__case"))
    got = facts.join(keys, ["year", "quarter", "primaryid"])
    return got.withColumn("caseid_overridden", (F.col("caseid") != F.col("__case")).cast("int")).withColumn("caseid", F.col("__case")).drop("__case")
