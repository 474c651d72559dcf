"""Reaction terms to vocabulary codes: the staged map, facts by code, manual overrides and what they change."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import is_blank, normalize_reaction
from ..plans.store import written
from .dedup import last_wins
from .match import cascade

FACT = ["primaryid", "caseid", "pt_code", "pt_name", "map_source"]


def standardize(terms: DataFrame, preferred: DataFrame, lower: DataFrame, hints: DataFrame) -> DataFrame:
    """(pt_norm, hint, code, name, map_source) for distinct normal forms of terms.pt_norm.

    Stages: preferred name (name, code), lower-level name (name, code), hint (term, code) whose code has a preferred name. What is left is
    EMPTY_PT, MANUAL_HINT_CODE_UNRESOLVED or UNRESOLVED_WITH_MEDDRA. Names and terms of the three tables must be distinct.
    """
    norm = terms.select(normalize_reaction(F.col("pt_norm")).alias("pt_norm")).distinct()
    hint = hints.select(F.col("term").alias("__t"), F.col("code").alias("hint"))
    rows = norm.join(hint, norm["pt_norm"] == hint["__t"], "left").withColumn("hint", F.coalesce("hint", F.lit(""))).drop("__t")
    names = preferred.groupBy("code").agg(F.min("name").alias("__name"))
    stage = lambda d, key, how: d.join(names, "code", how).select(F.col(key).alias("key"), "code", F.coalesce("__name", F.lit("")).alias("name"))
    stages = [("PT_EXACT", stage(preferred, "name", "left")), ("LLT_TO_PT", stage(lower, "name", "left")), ("MANUAL_CODE_HINT", stage(hints, "term", "inner"))]
    stages = [(source, d.where("code <> ''")) for source, d in stages]
    out = cascade(rows, "pt_norm", [(s, d.where("key <> ''")) for s, d in stages], unresolved="UNRESOLVED_WITH_MEDDRA")
    source = F.when((F.col("map_source") == "UNRESOLVED_WITH_MEDDRA") & (F.col("hint") != ""), "MANUAL_HINT_CODE_UNRESOLVED").otherwise(F.col("map_source"))
    return out.withColumn("map_source", source)


def _coded(facts: DataFrame, term_map: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Distinct (primaryid, caseid, __kind) of facts whose term has a code, and the few kinds (__kind, pt_code, pt_name, map_source).

    Facts are many and are made distinct by numbers instead of names, which keeps a task's memory small; the map's rows are written once for that. A report's
    facts come to one task, so none are held before that. A term may be in the map more than once.
    """
    names = ["pt_code", "pt_name", "map_source"]
    m = term_map.where(~is_blank(F.col("code"))).select("pt_norm", F.col("code").alias("pt_code"), F.col("name").alias("pt_name"), "map_source")
    m = written(m, "codes")
    kinds = written(m.select(*names).distinct().withColumn("__kind", F.monotonically_increasing_id()), "kinds")
    same = [m[c].eqNullSafe(kinds[c]) for c in names]
    terms = m.join(kinds, same).select("pt_norm", "__kind").distinct()
    return facts.join(terms, "pt_norm").select("primaryid", "caseid", "__kind").repartition("primaryid").distinct(), kinds


def facts_by_code(facts: DataFrame, term_map: DataFrame) -> DataFrame:
    """Distinct (primaryid, caseid, pt_code, pt_name, map_source) of facts whose term has a code."""
    rows, kinds = _coded(facts, term_map)
    return rows.join(kinds, "__kind").select(*FACT)


def code_counts(base: DataFrame) -> DataFrame:
    return base.groupBy("pt_code", "pt_name").agg(F.count("*").alias("n_case_reaction_rows"), F.countDistinct("primaryid").alias("n_primaryid"))


def counts_by_code(facts: DataFrame, term_map: DataFrame) -> DataFrame:
    """code_counts of facts_by_code: counted by report and code number first, where a report's facts are."""
    rows, kinds = _coded(facts, term_map)
    codes = kinds.groupBy("pt_code", "pt_name").agg(F.min("__kind").alias("__code"))
    same = kinds.join(codes, [kinds[c].eqNullSafe(codes[c]) for c in ("pt_code", "pt_name")]).select("__kind", "__code")
    by_report = rows.join(F.broadcast(same), "__kind").groupBy("primaryid", "__code").agg(F.count("*").alias("n"))
    counts = by_report.groupBy("__code").agg(F.sum("n").alias("n_case_reaction_rows"), F.count("primaryid").alias("n_primaryid"))
    return counts.join(codes, "__code").select("pt_code", "pt_name", "n_case_reaction_rows", "n_primaryid")


def unresolved_counts(facts: DataFrame, term_map: DataFrame) -> DataFrame:
    """(pt_norm, cnt) of facts whose term is in the map without a code; order by cnt descending, then pt_norm."""
    return facts.join(term_map.where(is_blank(F.col("code"))).select("pt_norm"), "pt_norm").groupBy("pt_norm").agg(F.count("*").alias("cnt"))


def source_counts(term_map: DataFrame) -> DataFrame:
    return term_map.groupBy("map_source").agg(F.count("*").alias("cnt"))


def overridden(term_map: DataFrame, overrides: DataFrame, fallback: DataFrame) -> dict[str, DataFrame]:
    """term_map with overrides (pt_norm, code, reason, line_no) applied, their log, and those that couldn't be.

    A code's name comes from the map, else from fallback (code, name). Of several overrides of a term the last that can be applied counts.
    `missing` are overrides of terms the map doesn't have, `unresolved` those whose code has no name.
    """
    wanted = overrides.where(~is_blank(F.col("pt_norm")) & ~is_blank(F.col("code")))
    keys = term_map.select("pt_norm").distinct()
    there = wanted.join(keys, "pt_norm", "left_semi")
    known = term_map.where(~is_blank(F.col("name"))).groupBy("code").agg(F.min("name").alias("__known"))
    spare = fallback.where(~is_blank(F.col("name"))).groupBy("code").agg(F.min("name").alias("__spare"))
    named = there.join(known, "code", "left").join(spare, "code", "left").withColumn("name", F.coalesce("__known", "__spare")).drop("__known", "__spare")
    log = last_wins(named.where("name IS NOT NULL"), ["pt_norm"], ["line_no"])
    new = log.select("pt_norm", F.col("code").alias("__code"), F.col("name").alias("__name"))
    hit = F.col("__code").isNotNull()
    cols = {"code": F.coalesce("__code", "code"), "name": F.coalesce("__name", "name"), "map_source": F.when(hit, "MANUAL_TERM_OVERRIDE").otherwise(F.col("map_source"))}
    table = term_map.join(new, "pt_norm", "left").withColumns(cols).select(*term_map.columns)
    return {
        "term_map": table, "log": log.select("pt_norm", "code", "reason"), "missing": wanted.join(keys, "pt_norm", "left_anti").select("pt_norm", "code"),
        "unresolved": named.where("name IS NULL").select("pt_norm", "code"),
    }


def refreshed_facts(base: DataFrame, facts: DataFrame, term_map: DataFrame, overrides: DataFrame) -> DataFrame:
    """Facts by code after overrides: what there was, and the facts of all terms that overrides name, once each."""
    touched = facts.join(overrides.select("pt_norm").distinct(), "pt_norm", "left_semi")
    return base.select(*FACT).unionByName(facts_by_code(touched, term_map)).distinct()


def facts_after(facts: DataFrame, before: DataFrame, term_map: DataFrame, overrides: DataFrame) -> DataFrame:
    """refreshed_facts of facts_by_code(facts, before), where those were not kept: a term's facts by the map before and, if overrides name it, by the one after."""
    named = term_map.join(overrides.select("pt_norm").distinct(), "pt_norm", "left_semi")
    columns = ["pt_norm", "code", "name", "map_source"]
    return facts_by_code(facts, before.select(*columns).unionByName(named.select(*columns)))


def map_metrics(facts: DataFrame, term_map: DataFrame) -> DataFrame:
    """One row: unmapped_terms, and the facts whose term is mapped; taken before and after overrides."""
    terms = term_map.agg(F.count_if(is_blank(F.col("code"))).alias("unmapped_terms"))
    rows = facts.join(term_map.where(~is_blank(F.col("code"))).select("pt_norm"), "pt_norm").agg(F.count("*").alias("mapped_rows"))
    return terms.crossJoin(rows)  # of one row each
