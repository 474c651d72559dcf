"""Staged dictionary matching, candidate ranking and relation bridging."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import clean_term, normalize_drug_v3, variants
from ..plans.store import written
from .dedup import first_wins

# Priorities of sources and of term types, and the relations that bridge.
SOURCES = "RXNORM MTHSPL MMSL MMX GS VANDF NDDF ATC DRUGBANK USP CVX".split()
TERM_TYPES = "IN PIN MIN SCD SBD SCDC SBDC GPCK BPCK SCDG SBDG BN DF".split()
RELATIONS = "HAS_INGREDIENT INGREDIENT_OF HAS_PRECISE_INGREDIENT PRECISE_INGREDIENT_OF TRADENAME_OF HAS_TRADENAME CONSISTS_OF CONSTITUTES FORM_OF HAS_FORM".split()


def priority(c: Column, order: list[str], other: int = 99) -> Column:
    at = F.array_position(F.array(*map(F.lit, order)), c)
    return F.when(at > 0, at).otherwise(other).cast("int")


def relation_allowed(rela: Column, rel: Column) -> Column:
    return F.coalesce(F.upper(rela).isin(RELATIONS), F.lit(False)) | F.coalesce(F.upper(rel).isin("RN", "RB"), F.lit(False))


def cascade(terms: DataFrame, term: str, stages: list[tuple[str, DataFrame]], unresolved: str = "UNRESOLVED", empty: str = "EMPTY_PT", only: list[DataFrame] | None = None) -> DataFrame:
    """terms with code, name and source of the first stage that has the term; stages are (source, DataFrame of key, code, name) with distinct keys."""
    out = terms
    for i, (_, d) in enumerate(stages):
        d = d.select(F.col("key").alias(f"__k{i}"), F.col("code").alias(f"__c{i}"), F.col("name").alias(f"__n{i}"))
        out = out.join(d, F.col(term) == F.col(f"__k{i}"), "left")
    n = range(len(stages))
    source = reduce(lambda e, i: F.when(F.col(f"__k{i}").isNotNull(), F.lit(stages[i][0])).otherwise(e), reversed(n), F.when(F.trim(F.coalesce(F.col(term), F.lit(""))) == "", F.lit(empty)).otherwise(F.lit(unresolved)))
    first = lambda p: reduce(lambda e, i: F.when(F.col(f"__k{i}").isNotNull(), F.col(f"{p}{i}")).otherwise(e), reversed(n), F.lit(""))
    return out.select(*terms.columns, first("__c").alias("code"), first("__n").alias("name"), source.alias("map_source"))


def rank_best(candidates: DataFrame, key: str, target: str, ordinal: str = "line_no") -> DataFrame:
    """For each key the candidate (rxcui, sab, tty, string) with the best source, type, exactness, length difference and length; ties go by ordinal."""
    name = normalize_drug_v3(F.col("string"))
    diff = F.abs(F.length(name) - F.length(target))
    order = [priority(F.col("sab"), SOURCES), priority(F.col("tty"), TERM_TYPES), (name != F.col(target)).cast("int"), diff, F.length(name), F.col(ordinal)]
    rank = F.row_number().over(Window.partitionBy(key).orderBy(*order))
    return candidates.withColumn("__r", rank).where("__r = 1").drop("__r")


def first_hit(hits: DataFrame, key: str, stage: str) -> DataFrame:
    """Only the hits of a key's earliest stage."""
    return hits.withColumn("__m", F.min(stage).over(Window.partitionBy(key))).where(F.col(stage) == F.col("__m")).drop("__m")


def candidates(table: DataFrame) -> DataFrame:
    """Distinct candidates (rxcui, sab, tty, code, string), the first line kept."""
    return table.groupBy("rxcui", "sab", "tty", "code", "string").agg(F.min("line_no").alias("line_no"))


def name_index(names: DataFrame, key: str, name: str) -> DataFrame:
    """(term, key): normal and cleaned names of each key."""
    forms = F.array_distinct(F.array(normalize_drug_v3(F.col(name)), clean_term(F.col(name))))
    return names.select(F.explode(forms).alias("term"), key).where("term <> ''").distinct()


def preferred_id(links: DataFrame, key: str, value: str, good: DataFrame) -> DataFrame:
    """(key, value): the smallest value of each key, those in good (column value) before others."""
    g = good.select(F.col(value).alias("__g")).distinct()
    best = links.join(g, links[value] == g["__g"], "left").groupBy(key).agg(F.min(F.struct(F.col("__g").isNull().alias("late"), F.col(value).alias("v"))).alias("b"))
    return best.select(key, F.col("b.v").alias(value))


def bridge(relations: DataFrame, wanted: DataFrame, linked: DataFrame, chunk: int = 1 << 12, most: int = 1 << 16) -> DataFrame:
    """(id, target): linked neighbours of wanted ids over undirected relations (a, b), direct or by one neighbour that isn't linked itself.

    A relation is kept from its ends that are wanted or linked, and says whether the other end is linked. Linked neighbours of an unlinked id stand in lists
    of about `chunk` ids at most, so a hub is several rows; wanted neighbours meet these lists by the id between them. Lists travel whole to a wanted
    id, which makes their ids distinct; one that would have over `most` ids in its lists is dealt out pair by pair instead.
    """
    known = written(linked.select("id").distinct(), "linked")  # so that Spark knows whether it is small
    both = relations.select("a", "b").unionByName(relations.select(F.col("b").alias("a"), F.col("a").alias("b"))).where("a <> b AND a <> '' AND b <> ''")
    for name, ids, of in (("l", known, "a"), ("on", known, "b"), ("w", wanted.select("id").distinct(), "a")):
        both = both.join(ids.select(F.col("id").alias(of), F.lit(True).alias(name)), of, "left")
    marked = both.where("w OR l").groupBy("a", "b").agg(*(F.first(c).alias(c) for c in ("w", "l", "on")))
    marked = written(marked, "relations")
    direct = marked.where("w AND on").select(F.col("a").alias("id"), F.col("b").alias("target"))
    between = marked.where("on IS NULL")
    degree = between.where("l").groupBy("b").agg(F.count("*").alias("n"))
    chunks = degree.select("b", F.ceil(F.col("n") / chunk).alias("chunks"))
    far = between.where("l").join(chunks, "b").groupBy("b", F.pmod(F.xxhash64("a"), F.col("chunks")).alias("part")).agg(F.collect_list("a").alias("targets"))
    near = between.where("w").select(F.col("a").alias("id"), "b")
    weights = near.join(degree, "b").select("id", "n").unionByName(direct.select("id", F.lit(1).cast("bigint").alias("n"))).groupBy("id").agg(F.sum("n").alias("n"))
    heavy = written(weights.where(F.col("n") > most).select("id"), "heavy")

    def lists(how: str) -> DataFrame:
        second = near.join(heavy, "id", how).join(far, "b").select("id", F.filter("targets", lambda t: t != F.col("id")).alias("targets"))
        return direct.join(heavy, "id", how).select("id", F.array("target").alias("targets")).unionByName(second)

    light = lists("left_anti").groupBy("id").agg(F.array_distinct(F.flatten(F.collect_list("targets"))).alias("targets"))
    dealt = lists("left_semi").select("id", F.explode("targets").alias("target")).distinct()
    return light.select("id", F.explode("targets").alias("target")).unionByName(dealt)


def match_terms(terms: DataFrame, term: str, variant_rows: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """terms with the best candidate: exact variants first, then later stages, ranked within the first stage that has any."""
    vocab = candidates(vocabulary.withColumn("__key", normalize_drug_v3(F.col("string")))) if "__key" not in vocabulary.columns else vocabulary
    hits = variant_rows.join(vocab.withColumn("__key", normalize_drug_v3(F.col("string"))), F.col("variant") == F.col("__key")).drop("__key")
    best = rank_best(first_hit(hits, term, "priority").withColumn("__target", normalize_drug_v3(F.col(term))), term, "__target")
    return terms.join(best.select(term, "rxcui", "sab", "tty", "string", "stage"), term, "left")


# The columns of the term table.
TERM_MAP = (
    "term_std term_norm n_rows n_cases manual_action manual_target mapping_stage candidate_count rxcui sab tty code rx_string dbid drugbank_name inchi"
).split()


def ids_by_name(terms: DataFrame, key: str, forms: Column, names: DataFrame, structures: DataFrame) -> DataFrame:
    """(key, dbid): of a term's forms, in order, the first that names an id with a structure, and of its ids the smallest.

    forms is an array of text; each counts in its normal and then in its cleaned form.
    """
    both = F.flatten(F.transform(forms, lambda t: F.array(normalize_drug_v3(t), clean_term(t))))
    rows = terms.select(key, F.posexplode(both).alias("__at", "term")).where("term <> ''")
    index = name_index(names, "dbid", "name").join(structures.select("dbid"), "dbid", "left_semi")
    best = rows.join(index, "term").groupBy(key).agg(F.min(F.struct("__at", "dbid")).alias("__b"))
    return best.select(key, F.col("__b.dbid").alias("dbid"))


def map_terms(terms: DataFrame, vocabulary: DataFrame, links: DataFrame, names: DataFrame, structures: DataFrame, fixes: DataFrame) -> DataFrame:
    """The term table: (term_std, n_rows, n_cases) mapped to concepts, ids and structures, in the columns TERM_MAP.

    vocabulary has (rxcui, sab, tty, code, string, line_no); links (rxcui, dbid); names (dbid, name); structures (dbid, inchi), both with one row for an
    id; fixes (term_std, action, target_term, line_no) the corrections. A term to be excluded gets the stage MANUAL_EXCLUDE. Another takes the first kind of
    its variants (of the correction's target, where there is one) that has candidates, the best of these, and that concept's id, an id with a
    structure before others. Without candidates an id is looked up by name. Stages of corrected terms begin with MANUAL_.
    """
    norm = normalize_drug_v3(F.col("term_std"))
    rows = terms.select("term_std", norm.alias("term_norm"), "n_rows", "n_cases").where("term_norm <> ''")
    fix = corrections(fixes.withColumn("term_std", normalize_drug_v3(F.col("term_std"))))
    fix = fix.select(F.col("term_std").alias("__key"), F.col("action").alias("manual_action"), normalize_drug_v3(F.col("target_term")).alias("manual_target")).where("__key <> ''")
    rows = rows.join(fix, rows["term_norm"] == fix["__key"], "left").drop("__key").na.fill("", ["manual_action", "manual_target"])
    aimed = (F.col("manual_action") == "MAP_TO_TERM") & (F.col("manual_target") != "")
    rows = written(rows.withColumn("base", F.when(aimed, F.col("manual_target")).otherwise(F.col("term_std"))), "terms")
    asked = rows.where("manual_action <> 'EXCLUDE_NON_DRUG'")
    found = variants(asked, "base", ["term_std"]).join(candidates(vocabulary).withColumn("__key", normalize_drug_v3(F.col("string"))), F.col("variant") == F.col("__key"))
    hits = first_hit(found, "term_std", "priority").groupBy("term_std", "rxcui", "sab", "tty", "code", "string").agg(F.min("line_no").alias("line_no"), F.min("stage").alias("stage"))
    hits = written(hits, "hits")
    counts = hits.groupBy("term_std").agg(F.count("*").cast("int").alias("candidate_count"))
    best = rank_best(hits.withColumn("__target", normalize_drug_v3(F.col("term_std"))), "term_std", "__target").join(counts, "term_std")
    # An id for the concept, or one by name where there is no concept.
    by_concept = preferred_id(links.select("rxcui", "dbid").distinct(), "rxcui", "dbid", structures)
    best = best.join(by_concept.withColumnRenamed("rxcui", "__rx"), F.col("rxcui") == F.col("__rx"), "left").drop("__rx")
    without = asked.join(best.select("term_std"), "term_std", "left_anti")
    named = ids_by_name(without, "term_std", F.array("base", "term_std", "term_norm"), names, structures)
    named = named.select("term_std", F.lit("DB_NAME_EXACT").alias("stage"), F.lit(1).alias("candidate_count"), "dbid")
    got = best.select("term_std", "stage", "candidate_count", "rxcui", "sab", "tty", "code", "string", "dbid").unionByName(named, allowMissingColumns=True)
    out = rows.join(got, "term_std", "left").join(names.select(F.col("dbid").alias("__n"), F.col("name").alias("drugbank_name")), F.col("dbid") == F.col("__n"), "left")
    out = out.join(structures.select(F.col("dbid").alias("__s"), "inchi"), F.col("dbid") == F.col("__s"), "left")
    stage = F.concat(F.when(F.col("manual_action") == "MAP_TO_TERM", F.lit("MANUAL_")).otherwise(F.lit("")), F.coalesce("stage", F.lit("UNMAPPED")))
    out = out.withColumn("mapping_stage", F.when(F.col("manual_action") == "EXCLUDE_NON_DRUG", F.lit("MANUAL_EXCLUDE")).otherwise(stage)).na.fill(0, ["candidate_count"])
    return out.withColumnRenamed("string", "rx_string").na.fill("", ["rxcui", "sab", "tty", "code", "rx_string", "dbid", "drugbank_name", "inchi"]).select(*TERM_MAP)


def stage_counts(term_map: DataFrame) -> DataFrame:
    """(mapping_stage, n_terms, n_rows): terms and rows by the stage that mapped them."""
    return term_map.groupBy("mapping_stage").agg(F.count("*").alias("n_terms"), F.sum("n_rows").cast("bigint").alias("n_rows"))


def corrections(*lists: DataFrame, key: str = "term_std", ordinal: str = "line_no") -> DataFrame:
    """Correction lists merged; an earlier list wins, within a list the last line."""
    ranked = [first_wins(d.withColumn("__o", -F.col(ordinal)), [key], ["__o"]).drop("__o").withColumn("__list", F.lit(i)) for i, d in enumerate(lists)]
    return first_wins(reduce(lambda a, b: a.unionByName(b), ranked), [key], ["__list"]).drop("__list")
