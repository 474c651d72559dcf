"""Structure standardisation over distinct structures, with the chemistry as a parameter.

A standardiser maps a structure to (status, key, inchi_std, smiles_std, n_frag_before, n_frag_after, note). No chemistry library is part of
this package: `by_table` takes results from a table, `by_function` runs a function that the caller makes once for each task.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import is_blank, strip
from .graph import joined_distinct

SCHEMA = "inchi_raw string, status string, inchikey string, inchi_std string, smiles_std string, n_frag_before bigint, n_frag_after bigint, note string"


def distinct_structures(terms: DataFrame, column: str = "structure") -> DataFrame:
    """Structures of terms that nobody has excluded, each once."""
    kept = terms.where(F.coalesce("mapping_stage", F.lit("")) != "MANUAL_EXCLUDE") if "mapping_stage" in terms.columns else terms
    return kept.where(~is_blank(F.col(column))).select(strip(F.col(column)).alias("inchi_raw")).distinct()


def by_function(structures: DataFrame, make: Callable[[], Callable[[str], tuple]], partitions: int | None = None) -> DataFrame:
    """SCHEMA for each distinct inchi_raw. make() is called once for each task; an error in the function is STANDARDIZE_FAIL with its text as note."""
    names = [f.split()[0] for f in SCHEMA.split(", ")]

    def run(batches):
        import pandas as pd

        standardise = make()
        for b in batches:
            rows = []
            for raw in b["inchi_raw"]:
                raw = (raw or "").strip()
                try:
                    got = ("EMPTY", "", "", "", 0, 0, "empty input") if not raw else standardise(raw)
                except Exception as e:  # one bad structure must not end the run
                    got = ("STANDARDIZE_FAIL", "", "", "", 0, 0, f"standardize error: {e}")
                rows.append((raw, *got))
            yield pd.DataFrame(rows, columns=names)

    # Few rows take long here, so they are dealt out evenly rather than by size.
    spread = structures.select("inchi_raw").distinct().repartition(partitions) if partitions else structures.select("inchi_raw").distinct()
    return spread.mapInPandas(run, SCHEMA)


def by_table(structures: DataFrame, table: DataFrame) -> DataFrame:
    """SCHEMA from a table of results; a structure that it lacks is PARSE_FAIL."""
    rest = [f.split()[0] for f in SCHEMA.split(", ")][1:]
    got = structures.select("inchi_raw").distinct().join(table, "inchi_raw", "left")
    lost = F.col("status").isNull()
    empty = {"status": F.lit("PARSE_FAIL"), "n_frag_before": F.lit(0), "n_frag_after": F.lit(0), "note": F.lit("not in table")}
    return got.select("inchi_raw", *(F.when(lost, empty.get(c, F.lit(""))).otherwise(F.col(c)).alias(c) for c in rest))


def term_structures(terms: DataFrame, normalized: DataFrame) -> DataFrame:
    """Terms with the key of their structure: only those that are OK, have a key and aren't excluded."""
    ok = normalized.where((F.col("status") == "OK") & ~is_blank(F.col("inchikey"))).withColumnRenamed("note", "norm_note")
    kept = terms.where(F.coalesce("mapping_stage", F.lit("")) != "MANUAL_EXCLUDE").withColumn("inchi_raw", strip(F.col("structure")))
    return kept.join(ok, "inchi_raw")


def structure_meta(mapped: DataFrame) -> DataFrame:
    """One row for each key: smallest forms, numbers of terms and ids, and their lists in order."""
    return mapped.groupBy("inchikey").agg(
        F.min("inchi_std").alias("inchi_std"), F.min("smiles_std").alias("smiles_std"), F.countDistinct("term_std").alias("term_count"), F.countDistinct("id").alias("dbid_count"),
        joined_distinct(F.col("id")).alias("dbid_list"), joined_distinct(F.col("id_name")).alias("drugbank_name_list"),
    )


def raw_structure_meta(terms: DataFrame) -> DataFrame:
    """The same without standardisation: one row for each raw structure, excluded terms included."""
    kept = terms.where(~is_blank(F.col("structure"))).groupBy(strip(F.col("structure")).alias("inchi"))
    return kept.agg(F.min("id").alias("dbid"), F.min("id_name").alias("drugbank_name"), F.countDistinct("term_std").alias("term_count"), F.countDistinct("id").alias("dbid_count"))


def status_counts(normalized: DataFrame) -> DataFrame:
    return normalized.groupBy("status").agg(F.count("*").alias("n"))


def report_compounds(drugs: DataFrame, mapped: DataFrame, roles: tuple[str, ...] | None = None, key: str = "term_std", compound: str = "inchikey") -> DataFrame:
    """Distinct (primaryid, caseid, role, compound) of drug facts; `roles` keeps some, written in any case and with blanks around.

    The facts' drug_key_std is looked up by `key` (term_std, or term_norm, under which a term can have several compounds).
    """
    role = F.upper(F.trim("role_cod"))
    kept = drugs.where(role.isin(*roles)) if roles else drugs
    terms = mapped.where(~is_blank(F.col(compound))).select(F.col(key).alias("drug_key_std"), compound).distinct()
    return kept.where(~is_blank(F.col("drug_key_std"))).join(terms, "drug_key_std").select("primaryid", "caseid", role.alias("role"), compound).distinct()
