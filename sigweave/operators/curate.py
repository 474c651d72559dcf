"""Mapping terms to vocabulary concepts and identifiers, and the curation of what is left unmapped, as joins over all terms at once."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import FORM_WORDS_CURATION, clean_term, is_blank, non_drug, normalize_drug_v3, probe_terms, strip_salt, variants
from .dedup import top_one
from .match import SOURCES, TERM_TYPES, preferred_id, priority

FOUND = ["stage", "candidate_count", "rxcui", "sab", "tty", "code", "rx_string", "id", "id_name", "structure", "method"]


@dataclass
class Vocabulary:
    """concepts (rxcui, sab, tty, code, string, line_no); links (rxcui, id); bridged (rxcui, target), target having links; names (id, name); structures (id, structure)."""

    concepts: DataFrame
    links: DataFrame
    bridged: DataFrame
    names: DataFrame
    structures: DataFrame

    def concept_index(self) -> DataFrame:
        """Concepts under their normal (0) and their cleaned form (1)."""
        return self.concepts.withColumn("form", F.explode(_forms(F.col("string")))).select("form.which", "form.key", *self.concepts.columns)

    def id_of_concept(self) -> DataFrame:
        """(rxcui, id): direct links, else bridged ones; ids with a structure before others, then the smallest."""
        direct = self.links.select("rxcui", "id").distinct()
        far = direct.select(F.col("rxcui").alias("target"), "id")
        via = self.bridged.join(direct, "rxcui", "left_anti").join(far, "target").select("rxcui", "id").distinct()
        return preferred_id(direct.unionByName(via), "rxcui", "id", self.structures)

    def name_index(self) -> DataFrame:
        """(which, key, id): for each form of a name the smallest id that has a structure."""
        named = self.names.join(self.structures.select("id"), "id", "left_semi").withColumn("form", F.explode(_forms(F.col("name"))))
        return named.groupBy("form.which", "form.key").agg(F.min("id").alias("id"))


def _forms(c: Column) -> Column:
    forms = F.array(*(F.struct(F.lit(i).alias("which"), x.alias("key")) for i, x in enumerate((normalize_drug_v3(c), clean_term(c, FORM_WORDS_CURATION)))))
    return F.filter(forms, lambda x: x["key"] != "")


def id_by_name(rows: DataFrame, keys: list[str], terms: list[Column], index: DataFrame) -> DataFrame:
    """(keys, id): of the terms in order, each by its normal and then its cleaned form, the first that the index has."""
    tried = rows.select(*keys, F.posexplode(F.array(*terms)).alias("at", "t")).withColumn("form", F.explode(_forms(F.col("t"))))
    hits = tried.select(*keys, "at", "form.which", "form.key").join(index, ["which", "key"])
    return hits.groupBy(*keys).agg(F.min(F.struct("at", "which", "id")).alias("b")).select(*keys, F.col("b.id").alias("id"))


def resolve(rows: DataFrame, keys: list[str], term: str, vocabulary: Vocabulary) -> DataFrame:
    """keys, term and FOUND for each row that maps; keys must be unique.

    Variants of the term are tried in order of priority, stage and text; the pool of a variant is all concepts that share its normal or cleaned
    form, ranked by source, type, exactness and length. An id comes from the best concept, else from names. Without any concept a
    name that has a structure maps by itself (DB_NAME_EXACT).
    """
    v = vocabulary
    pool_key, concept = [*keys, "priority", "stage", "variant"], ["rxcui", "sab", "tty", "code", "string"]
    forms = variants(rows, term, [*keys, term], curation=True).withColumn("form", F.explode(_forms(F.col("variant"))))
    pool = forms.select(*pool_key, F.col(term).alias("__term"), "form.which", "form.key").join(v.concept_index(), ["which", "key"])
    pool = pool.groupBy(*pool_key, "__term", *concept).agg(F.min(F.struct("which", "line_no")).alias("at"))
    name, target = normalize_drug_v3(F.col("string")), normalize_drug_v3(F.col("__term"))
    group = Window.partitionBy(*pool_key)
    rank = [priority(F.col("sab"), SOURCES), priority(F.col("tty"), TERM_TYPES), (name != target).cast("int"), F.abs(F.length(name) - F.length(target)), F.length(name), "at", *concept]
    best = pool.withColumn("candidate_count", F.count("*").over(group)).withColumn("r", F.row_number().over(group.orderBy(*rank))).where("r = 1").drop("r", "at")

    index, has = v.name_index(), v.structures.select("id", "structure")
    best = best.join(v.id_of_concept(), "rxcui", "left").join(has, "id", "left")
    t, s = F.col("__term"), F.col("string")
    late = id_by_name(best.where(is_blank(F.col("structure"))), pool_key, [t, s, clean_term(t, FORM_WORDS_CURATION), clean_term(s, FORM_WORDS_CURATION), strip_salt(t)], index)
    late = late.join(has, "id").select(*pool_key, F.col("id").alias("late_id"), F.col("structure").alias("late_structure"))
    # The fallback replaces the concept's id even where it finds nothing, so that an id without a structure isn't kept.
    known = ~is_blank(F.col("structure"))
    best = best.join(late, pool_key, "left").withColumn("id", F.when(known, F.col("id")).otherwise(F.col("late_id"))).withColumn("structure", F.when(known, F.col("structure")).otherwise(F.col("late_structure")))
    best = top_one(best.where(~is_blank(F.col("rxcui")) | ~is_blank(F.col("structure"))), keys, [F.asc("priority"), F.asc("stage"), F.asc("variant")])
    best = best.select(*keys, "stage", "candidate_count", "rxcui", "sab", "tty", "code", F.col("string").alias("rx_string"), "id", "structure", F.lit("RXNORM").alias("method"))

    rest = rows.select(*keys, term).join(best.select(*keys), keys, "left_anti")
    empty = {c: F.lit("") for c in ("rxcui", "sab", "tty", "code", "rx_string")}
    alone = id_by_name(rest, keys, [F.col(term)], index).join(has, "id").withColumns(empty | {"stage": F.lit("DB_NAME_EXACT"), "candidate_count": F.lit(1).cast("bigint"), "method": F.lit("DRUGBANK_NAME")})
    found = best.unionByName(alone.select(*best.columns)).join(v.names.select("id", F.col("name").alias("id_name")), "id", "left")
    blank = {c: F.coalesce(F.col(c), F.lit("")) for c in ("id", "id_name", "structure")}
    return rows.select(*keys, term).join(found.withColumns(blank), keys).select(*keys, term, *FOUND)


def unmapped(base: DataFrame, top: int | None = None, excluded: bool = False) -> DataFrame:
    """Terms without a structure, those that somebody has excluded only if asked for; with `top`, those with most rows (ties by term)."""
    left = base.where(is_blank(F.col("structure")))
    if not excluded:
        left = left.where(F.coalesce("mapping_stage", F.lit("")) != "MANUAL_EXCLUDE")
    return left if top is None else left.orderBy(F.desc("n_rows"), "term_std").limit(top)


def decide(terms: DataFrame, corrections: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """terms (term_std, distinct, and others) with action, target_term, status, note and FOUND (null where nothing maps).

    A correction (term_std, action, target_term, note; one for each normal form) comes first. Then what is no drug is excluded. Then the
    term's probe forms are tried in order, and the first that leads to a structure is the target.
    """
    c = corrections.select(normalize_drug_v3(F.col("term_std")).alias("__key"), F.col("action").alias("__action"), F.col("target_term").alias("__target"), F.col("note").alias("__note"))
    rows = terms.withColumn("__key", normalize_drug_v3(F.col("term_std"))).join(c, "__key", "left")
    told = F.col("__action").isNotNull()
    junk = ~told & non_drug(F.col("term_std"))
    mapped = F.when(F.col("__action") == "MAP_TO_TERM", F.array("__target")).when(~told & ~junk, probe_terms(F.col("term_std")))
    tries = rows.select("term_std", F.posexplode(mapped).alias("__at", "__cand"))
    hits = resolve(tries, ["term_std", "__at"], "__cand", vocabulary).where(~is_blank(F.col("structure")))
    hits = top_one(hits, ["term_std"], [F.asc("__at")]).drop("__at")
    out = rows.join(hits, "term_std", "left")
    hit, exclude = F.col("__cand").isNotNull(), junk | F.coalesce(F.col("__action") == "EXCLUDE_NON_DRUG", F.lit(False))
    lost = F.coalesce(F.col("__action") == "MAP_TO_TERM", F.lit(False)) & ~hit
    action = F.when(exclude, "EXCLUDE_NON_DRUG").when(hit, "MAP_TO_TERM").when(lost | ~told, "").otherwise(F.col("__action"))
    status = F.when(exclude, "EXCLUDE").when(hit, "MAP_SUCCESS").otherwise("UNRESOLVED")
    note = F.when(junk, "auto_non_drug_rule").when(lost, "").when(told, F.col("__note")).when(hit, F.concat_ws("_", F.lit("auto"), "method", "stage")).otherwise("")
    return out.select(*terms.columns, action.alias("action"), F.when(hit, F.col("__cand")).otherwise("").alias("target_term"), status.alias("status"), F.coalesce(note, F.lit("")).alias("note"), *FOUND)


TERM_FIELDS = ["candidate_count", "rxcui", "sab", "tty", "code", "rx_string", "id", "id_name", "structure"]


def apply_decisions(base: DataFrame, decisions: DataFrame) -> DataFrame:
    """The term table with what was decided: excluded terms lose their mapping, mapped ones get stage MANUAL_<stage>, others stay."""
    d = decisions.where(F.col("status").isin("EXCLUDE", "MAP_SUCCESS")).select("term_std", "status", "action", "target_term", "stage", *(F.col(c).alias(f"__{c}") for c in TERM_FIELDS))
    out, kept = base.join(d, "term_std", "left"), [c for c in base.columns if c not in ("manual_action", "manual_target", "mapping_stage", *TERM_FIELDS)]
    old = lambda c: F.col(c) if c in base.columns else F.lit("")
    gone, new = F.col("status") == "EXCLUDE", F.col("status") == "MAP_SUCCESS"
    cols = [F.coalesce("action", old("manual_action")).alias("manual_action"), F.coalesce("target_term", old("manual_target")).alias("manual_target")]
    cols.append(F.when(gone, "MANUAL_EXCLUDE").when(new, F.concat(F.lit("MANUAL_"), "stage")).otherwise(F.col("mapping_stage")).alias("mapping_stage"))
    for c in TERM_FIELDS:
        cols.append(F.when(gone, F.lit(0) if c == "candidate_count" else F.lit("")).when(new, F.col(f"__{c}")).otherwise(F.col(c)).alias(c))
    return out.select(*kept, *cols)


def merged_corrections(known: DataFrame, decisions: DataFrame) -> DataFrame:
    """The master list after a run: known corrections, and new decisions in their place; one for each normal form."""
    fields = ["term_std", "action", "target_term", "note"]
    new = decisions.where(F.col("status").isin("EXCLUDE", "MAP_SUCCESS")).select(*fields)
    both = reduce(lambda a, b: a.unionByName(b), (x.select(*fields, F.lit(i).alias("__list")) for i, x in enumerate((new, known))))
    return top_one(both.withColumn("__key", normalize_drug_v3(F.col("term_std"))), ["__key"], [F.asc("__list"), F.desc("term_std")]).drop("__key", "__list")


def curate(base: DataFrame, corrections: DataFrame, vocabulary: Vocabulary, top: int | None = None) -> tuple[DataFrame, DataFrame]:
    """One pass of curation: (the term table after it, its decisions)."""
    decisions = decide(unmapped(base, top).select("term_std", "term_norm", "n_rows", "n_cases"), corrections, vocabulary)
    return apply_decisions(base, decisions), decisions
