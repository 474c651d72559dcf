"""Curation of unmapped terms as queries, each with SQL for an oracle: parts' names as terms, a vocabulary of parts, bridged concepts, a correction list."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import curate
from .catalog import _read, query

_CURATION = """
parts AS (SELECT p_partkey, p_name, p_size, p_brand AS brand, translate(replace(p_brand, 'Brand#', ''), '0123456789', 'QRSTUVWXYZ') AS p_brand FROM part),
terms AS (SELECT DISTINCT CASE WHEN p_size = 1 THEN 'unknown ' ELSE '' END || p_name || ' ' || p_brand AS term_std FROM parts),
v AS (
  SELECT 'R' || (p_partkey % 300) AS rxcui, CASE p_partkey % 4 WHEN 0 THEN 'RXNORM' WHEN 1 THEN 'GS' WHEN 2 THEN 'ATC' ELSE 'OTHER' END AS sab, CASE p_partkey % 3 WHEN 0 THEN 'IN' WHEN 1 THEN 'BN' ELSE 'XX' END AS tty, 'C' AS code,
    p_name || '  ' || lower(p_brand) AS string, p_partkey AS line_no, upper(p_name || ' ' || p_brand) AS v_norm FROM parts WHERE p_size > 30
), direct AS (SELECT DISTINCT 'R' || (p_partkey % 300) AS rxcui, 'DB' || (p_partkey % 40 + 10) AS id FROM parts WHERE p_partkey % 300 % 7 < 3),
bridged AS (SELECT DISTINCT 'R' || (p_partkey % 300) AS rxcui, 'R' || (p_partkey % 100) AS target FROM parts WHERE p_partkey % 5 < 2),
links AS (SELECT * FROM direct UNION SELECT b.rxcui, d.id FROM bridged b JOIN direct d ON d.rxcui = b.target WHERE b.rxcui NOT IN (SELECT rxcui FROM direct)),
names AS (SELECT 'DB' || i AS id, 'label ' || i AS name FROM range(10, 50) r(i) UNION ALL SELECT 'DN' || min(p_partkey), p_name || ' ' || p_brand FROM parts WHERE p_partkey % 3 = 0 GROUP BY p_name, p_brand),
structures AS (SELECT id, 'InChI=' || id AS structure FROM names WHERE right(id, 1) IN ('0', '2', '4', '6', '8')),
of_concept AS (SELECT rxcui, coalesce(min(CASE WHEN s.id IS NOT NULL THEN l.id END), min(l.id)) AS id FROM links l LEFT JOIN structures s ON s.id = l.id GROUP BY rxcui),
by_name AS (SELECT upper(name) AS k, min(n.id) AS id FROM names n JOIN structures s ON s.id = n.id GROUP BY 1),
told AS (
  SELECT term_std, CASE WHEN term_std LIKE '%widget R' THEN 'EXCLUDE_NON_DRUG' WHEN term_std LIKE '%ring S' THEN 'MAP_TO_TERM' END AS act, CASE WHEN term_std LIKE '%ring S' THEN split_part(term_std, ' ', 1) || ' ring T' ELSE '' END AS target FROM terms
), c AS (
  SELECT *, act IS NULL AND term_std LIKE 'unknown%' AS junk, CASE WHEN act = 'MAP_TO_TERM' THEN target WHEN act IS NULL AND term_std NOT LIKE 'unknown%' THEN upper(term_std) END AS cand FROM told
), pool AS (SELECT term_std, rxcui, sab, tty, code, string, min(line_no) AS line_no FROM c JOIN v ON v_norm = upper(cand) GROUP BY ALL),
best AS (
  SELECT *, count(*) OVER (PARTITION BY term_std) AS n FROM pool
  QUALIFY row_number() OVER (PARTITION BY term_std ORDER BY CASE sab WHEN 'RXNORM' THEN 1 WHEN 'GS' THEN 5 WHEN 'ATC' THEN 8 ELSE 99 END, CASE tty WHEN 'IN' THEN 1 WHEN 'BN' THEN 12 ELSE 99 END, line_no, rxcui, sab, tty, code, string) = 1
), chosen AS (
  SELECT term_std, rxcui, sab, tty, code, string AS rx_string, n, CASE WHEN s.structure IS NOT NULL THEN o.id ELSE b.id END AS id, 'RXNORM' AS method, 'EXACT' AS stage
  FROM best JOIN c USING (term_std) LEFT JOIN of_concept o USING (rxcui) LEFT JOIN structures s ON s.id = o.id LEFT JOIN by_name b ON b.k = upper(cand)
  UNION ALL SELECT term_std, '', '', '', '', '', 1, b.id, 'DRUGBANK_NAME', 'DB_NAME_EXACT' FROM c JOIN by_name b ON b.k = upper(cand) WHERE term_std NOT IN (SELECT term_std FROM best)
), hits AS (SELECT h.*, s.structure, n.name AS id_name FROM chosen h JOIN structures s ON s.id = h.id JOIN names n ON n.id = h.id),
decided AS (
  SELECT c.term_std, CASE WHEN junk OR coalesce(act = 'EXCLUDE_NON_DRUG', false) THEN 'EXCLUDE_NON_DRUG' WHEN h.id IS NOT NULL THEN 'MAP_TO_TERM' ELSE '' END AS action, CASE WHEN h.id IS NOT NULL THEN cand ELSE '' END AS target_term,
    CASE WHEN junk OR coalesce(act = 'EXCLUDE_NON_DRUG', false) THEN 'EXCLUDE' WHEN h.id IS NOT NULL THEN 'MAP_SUCCESS' ELSE 'UNRESOLVED' END AS status,
    CASE WHEN junk THEN 'auto_non_drug_rule' WHEN act = 'MAP_TO_TERM' AND h.id IS NULL THEN '' WHEN act IS NOT NULL THEN 'by hand' WHEN h.id IS NOT NULL THEN 'auto_' || method || '_' || stage ELSE '' END AS note,
    stage, h.n AS candidate_count, rxcui, sab, tty, code, rx_string, h.id, id_name, structure, method
  FROM c LEFT JOIN hits h USING (term_std)
)
"""


def _inputs(spark, d):
    """(terms, corrections, vocabulary)."""
    word = F.translate(F.replace("p_brand", F.lit("Brand#"), F.lit("")), "0123456789", "QRSTUVWXYZ")
    part, k = _read(spark, d, "part").select("p_partkey", "p_name", "p_size", word.alias("p_brand")), F.col("p_partkey")
    named = lambda prefix, n: F.concat(F.lit(prefix), n.cast("string"))
    terms = part.select(F.concat(F.when(F.col("p_size") == 1, "unknown ").otherwise(""), F.concat_ws(" ", "p_name", "p_brand")).alias("term_std")).distinct()
    concepts = part.where("p_size > 30").select(
        named("R", k % 300).alias("rxcui"), F.when(k % 4 == 0, "RXNORM").when(k % 4 == 1, "GS").when(k % 4 == 2, "ATC").otherwise("OTHER").alias("sab"), F.when(k % 3 == 0, "IN").when(k % 3 == 1, "BN").otherwise("XX").alias("tty"),
        F.lit("C").alias("code"), F.concat("p_name", F.lit("  "), F.lower("p_brand")).alias("string"), k.alias("line_no"),
    )
    links = part.where(k % 300 % 7 < 3).select(named("R", k % 300).alias("rxcui"), named("DB", k % 40 + 10).alias("id"))
    bridged = part.where(k % 5 < 2).select(named("R", k % 300).alias("rxcui"), named("R", k % 100).alias("target")).distinct()
    parts = part.where(k % 3 == 0).groupBy("p_name", "p_brand").agg(F.min(k).alias("k")).select(named("DN", F.col("k")).alias("id"), F.concat_ws(" ", "p_name", "p_brand").alias("name"))
    names = spark.range(10, 50).select(named("DB", F.col("id")).alias("id"), named("label ", F.col("id")).alias("name")).unionByName(parts)
    structures = names.where(F.substring("id", -1, 1).isin(*"02468")).select("id", F.concat(F.lit("InChI="), "id").alias("structure"))
    t = F.col("term_std")
    fixed = terms.where(t.like("%widget R") | t.like("%ring S"))
    target = F.when(t.like("%ring S"), F.concat(F.split(t, " ")[0], F.lit(" ring T"))).otherwise("")
    corrections = fixed.select(t, F.when(t.like("%ring S"), "MAP_TO_TERM").otherwise("EXCLUDE_NON_DRUG").alias("action"), target.alias("target_term"), F.lit("by hand").alias("note"))
    return terms, corrections, curate.Vocabulary(concepts, links, bridged, names, structures)


@query(f"WITH {_CURATION} SELECT * FROM decided")
def curation_decisions(spark, d):
    """Corrections, rules and lookups for every term: concepts by pool and rank, ids by links, bridges and names."""
    return curate.decide(*_inputs(spark, d)).select("term_std", "action", "target_term", "status", "note", *curate.FOUND)


@query(f"""WITH {_CURATION} SELECT term_std, 1 AS n_rows, action AS manual_action, target_term AS manual_target, CASE status WHEN 'EXCLUDE' THEN 'MANUAL_EXCLUDE' WHEN 'MAP_SUCCESS' THEN 'MANUAL_' || stage ELSE 'UNMAPPED' END AS mapping_stage,
CASE WHEN status = 'MAP_SUCCESS' THEN id ELSE '' END AS id, CASE WHEN status = 'MAP_SUCCESS' THEN structure ELSE '' END AS structure FROM decided""")
def curation_applied(spark, d):
    """The term table after the decisions, from one in which nothing is mapped."""
    terms, corrections, vocabulary = _inputs(spark, d)
    empty = {c: F.lit("") for c in ("manual_action", "manual_target", "rxcui", "sab", "tty", "code", "rx_string", "id", "id_name", "structure")}
    base = terms.withColumns({"term_norm": F.upper("term_std"), "n_cases": F.lit(1), "n_rows": F.lit(1), "mapping_stage": F.lit("UNMAPPED"), "candidate_count": F.lit(0).cast("bigint")} | empty)
    done, _ = curate.curate(base, corrections, vocabulary)
    return done.select("term_std", "n_rows", "manual_action", "manual_target", "mapping_stage", "id", "structure")
