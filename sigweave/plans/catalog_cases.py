"""Queries of the way from report rows to cases, facts and mapped terms, each with SQL for an oracle.

Report = order, case = customer, a report's rows = order lines.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text
from ..operators import cases, curate, dedup, graph, match
from .catalog import _EDGE_SQL, _edges, _read, query
from .store import written

_DEMO = r"""
d AS (
  SELECT l_orderkey::VARCHAR AS primaryid, o_custkey::VARCHAR AS caseid, 2000 + l_linenumber % 3 AS year, l_partkey::INT % 4 + 1 AS quarter, l_partkey, l_suppkey, l_extendedprice,
    CASE l_linenumber % 4 WHEN 0 THEN '12A' WHEN 1 THEN ' ' || l_quantity::INT::VARCHAR WHEN 2 THEN 'x9' ELSE '' END AS caseversion,
    CASE l_returnflag WHEN 'R' THEN ' f' WHEN 'A' THEN 'I' ELSE '' END AS i_f_code,
    CASE WHEN l_suppkey % 5 = 0 THEN strftime(l_shipdate::DATE, '%Y%m') WHEN l_suppkey % 5 = 1 THEN '99999999' ELSE strftime(l_shipdate::DATE, '%Y%m%d') END AS fda_dt,
    CASE WHEN l_linestatus = 'F' THEN strftime(o_orderdate::DATE, '%Y%m%d') ELSE '' END AS event_dt
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
), dead AS (
  SELECT o_orderkey::VARCHAR AS id FROM orders WHERE o_orderkey % 11 = 0 UNION SELECT o_custkey::VARCHAR FROM orders WHERE o_custkey % 50 = 0
), s AS (
  SELECT *, year * 10 + quarter AS quarter_idx,
    CASE WHEN regexp_matches(trim(caseversion), '^[0-9][0-9]') THEN regexp_extract(trim(caseversion), '^([0-9]+)', 1)::BIGINT ELSE 0 END AS caseversion_n,
    CASE WHEN regexp_matches(trim(primaryid), '^[0-9][0-9]') THEN primaryid::BIGINT ELSE 0 END AS primaryid_n,
    CASE WHEN regexp_matches(fda_dt, '^[0-9]{8}$') THEN fda_dt::BIGINT ELSE 0 END AS fda_dt_n, CASE WHEN regexp_matches(event_dt, '^[0-9]{8}$') THEN event_dt::BIGINT ELSE 0 END AS event_dt_n,
    CASE upper(trim(i_f_code)) WHEN 'F' THEN 2 WHEN 'I' THEN 1 ELSE 0 END AS if_rank
  FROM d WHERE primaryid NOT IN (SELECT id FROM dead) AND caseid NOT IN (SELECT id FROM dead)
), a AS (
  SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY primaryid ORDER BY quarter_idx DESC, fda_dt_n DESC, if_rank DESC, event_dt_n DESC, caseversion_n DESC, primaryid_n DESC, l_partkey DESC, l_suppkey DESC, l_extendedprice DESC) = 1
), b AS (
  SELECT * FROM a QUALIFY row_number() OVER (PARTITION BY caseid ORDER BY caseversion_n DESC, fda_dt_n DESC, if_rank DESC, event_dt_n DESC, quarter_idx DESC, primaryid_n DESC, l_partkey DESC, l_suppkey DESC, l_extendedprice DESC) = 1
)
"""


def _demo(spark, d):
    """Versions of reports as they come from archives: scores that count and that don't, partial dates, several rows a report."""
    # Joined by the report's id as it is used from here on, so rows are where their report's deletion and latest row are looked for.
    orders = _read(spark, d, "orders").select(F.col("o_orderkey").cast("string").alias("primaryid"), "o_custkey", "o_orderdate")
    rows = _read(spark, d, "lineitem").withColumn("primaryid", F.col("l_orderkey").cast("string")).join(orders, "primaryid")
    n, s = F.col("l_linenumber") % 4, F.col("l_suppkey") % 5
    day = lambda c, f="yyyyMMdd": F.date_format(F.col(c).cast("date"), f)
    return rows.select(
        "primaryid", F.col("o_custkey").cast("string").alias("caseid"), (F.lit(2000) + F.col("l_linenumber") % 3).alias("year"), (F.col("l_partkey").cast("int") % 4 + 1).alias("quarter"),
        F.when(n == 0, "12A").when(n == 1, F.concat(F.lit(" "), F.col("l_quantity").cast("int").cast("string"))).when(n == 2, "x9").otherwise("").alias("caseversion"),
        F.when(F.col("l_returnflag") == "R", " f").when(F.col("l_returnflag") == "A", "I").otherwise("").alias("i_f_code"),
        F.when(s == 0, day("l_shipdate", "yyyyMM")).when(s == 1, "99999999").otherwise(day("l_shipdate")).alias("fda_dt"), F.when(F.col("l_linestatus") == "F", day("o_orderdate")).otherwise("").alias("event_dt"),
        F.struct("l_partkey", "l_suppkey", "l_extendedprice").alias("ingest_ordinal"),
    )


def _selected(spark, d):
    o = _read(spark, d, "orders")
    dead = o.where("o_orderkey % 11 = 0").select(F.col("o_orderkey").cast("string").alias("id")).unionByName(o.where("o_custkey % 50 = 0").select(F.col("o_custkey").cast("string").alias("id")))
    return dedup.latest_cases(_demo(spark, d), dead)


@query(f"WITH {_DEMO} SELECT caseid, primaryid, year, quarter, caseversion, i_f_code, fda_dt, event_dt, caseversion_n, fda_dt_n FROM b")
def case_latest(spark, d):
    return _selected(spark, d).select("caseid", "primaryid", "year", "quarter", "caseversion", "i_f_code", "fda_dt", "event_dt", "caseversion_n", "fda_dt_n")


_ALL_FACTS = """
k AS (SELECT o_orderkey::VARCHAR AS primaryid, o_custkey::VARCHAR AS caseid, (2000 + o_orderkey % 3)::INT AS year, (o_orderkey % 2 + 1)::INT AS quarter FROM orders WHERE o_orderkey % 4 < 3),
r AS (
  SELECT (2000 + l_orderkey % 3)::INT AS year, (l_linenumber % 2 + 1)::INT AS quarter, 'z' || (l_suppkey % 5) AS zip_name, l_partkey * 1000 + l_suppkey AS line_no, CASE WHEN l_linenumber = 7 THEN '' ELSE l_orderkey::VARCHAR END AS primaryid,
    CASE l_suppkey % 3 WHEN 0 THEN '' WHEN 1 THEN (l_orderkey + 1)::VARCHAR ELSE NULL END AS caseid, (l_partkey % 2)::VARCHAR AS drug_seq, upper(l_returnflag) AS role_cod, p_name AS drugname_raw, upper(p_name) AS drugname_std,
    CASE WHEN l_partkey % 3 = 0 THEN p_type || '/' || p_brand ELSE '  ' END AS prod_ai_raw, CASE WHEN l_partkey % 3 = 0 THEN upper(p_type || ' / ' || p_brand) ELSE '' END AS prod_ai_std,
    ' ' || lower(l_linestatus) || '  x' AS route_raw, upper(l_linestatus) || ' X' AS route_std, l_quantity::INT::VARCHAR || ' mg' AS dose_vbm_raw, l_quantity::INT::VARCHAR || ' MG' AS dose_vbm_std, 'v' AS val_vbm,
    (l_quantity::INT % 3)::INT AS trimmed, (l_linenumber % 5 = 0)::INT AS padded, (l_linenumber % 5 = 1)::INT AS folded
  FROM lineitem JOIN part ON l_partkey = p_partkey
), f AS (
  SELECT r.* EXCLUDE (caseid), k.caseid, CASE WHEN prod_ai_std = '' THEN drugname_std ELSE prod_ai_std END AS drug_key_std, (coalesce(r.caseid, '') <> '' AND r.caseid <> k.caseid)::INT AS caseid_overridden
  FROM r JOIN k USING (year, quarter, primaryid) WHERE r.primaryid <> ''
), g AS (
  SELECT * FROM f QUALIFY row_number() OVER (PARTITION BY primaryid, drug_seq, role_cod, drugname_std, prod_ai_std ORDER BY year, quarter, zip_name, line_no, route_raw, dose_vbm_raw) = 1
)
"""


def _drug_rows(spark, d):
    """(parsed drug rows, selected cases)."""
    rows = _read(spark, d, "lineitem").join(_read(spark, d, "part"), F.col("l_partkey") == F.col("p_partkey"))
    key, n, s = F.col("l_orderkey"), F.col("l_linenumber"), F.col("l_suppkey")
    rows = rows.select(
        (F.lit(2000) + key % 3).cast("int").alias("year"), (n % 2 + 1).cast("int").alias("quarter"), F.concat(F.lit("z"), (s % 5).cast("string")).alias("zip"), (F.col("l_partkey") * 1000 + s).alias("line_no"),
        F.when(n == 7, "").otherwise(key.cast("string")).alias("primaryid"), F.when(s % 3 == 0, "").when(s % 3 == 1, (key + 1).cast("string")).alias("caseid"), (F.col("l_partkey") % 2).cast("string").alias("drug_seq"),
        F.lower("l_returnflag").alias("role_cod"), F.col("p_name").alias("drugname"), F.when(F.col("l_partkey") % 3 == 0, F.concat_ws("/", "p_type", "p_brand")).otherwise("  ").alias("prod_ai"),
        F.concat(F.lit(" "), F.lower("l_linestatus"), F.lit("  x")).alias("route"), F.concat(F.col("l_quantity").cast("int").cast("string"), F.lit(" mg")).alias("dose_vbm"), F.lit("v").alias("val_vbm"),
        (F.col("l_quantity").cast("int") % 3).alias("trimmed"), (n % 5 == 0).cast("int").alias("padded"), (n % 5 == 1).cast("int").alias("folded"),
    )
    o = F.col("o_orderkey")
    chosen = _read(spark, d, "orders").where(o % 4 < 3).select(o.cast("string").alias("primaryid"), F.col("o_custkey").cast("string").alias("caseid"), (F.lit(2000) + o % 3).cast("int").alias("year"), (o % 2 + 1).cast("int").alias("quarter"))
    return rows, chosen


@query(f"WITH {_ALL_FACTS} SELECT year, quarter, zip_name, primaryid, caseid, drug_seq, role_cod, drugname_std, prod_ai_std, drug_key_std, route_std, val_vbm FROM g")
def drug_facts(spark, d):
    return cases.drug_facts(*_drug_rows(spark, d)).select("year", "quarter", "zip_name", "primaryid", "caseid", "drug_seq", "role_cod", "drugname_std", "prod_ai_std", "drug_key_std", "route_std", "val_vbm")


@query(f"WITH {_ALL_FACTS} SELECT drug_key_std AS term_std, count(*) AS n_rows, count(DISTINCT primaryid) AS n_cases FROM g GROUP BY drug_key_std")
def drug_term_stats(spark, d):
    return cases.term_stats(cases.drug_facts(*_drug_rows(spark, d)))


@query(f"""WITH {_ALL_FACTS}, p AS (SELECT year, quarter, zip_name, count(*) AS raw_rows, sum((primaryid = '')::INT)::BIGINT AS skipped_no_primaryid, sum(trimmed)::BIGINT AS trailing_trimmed, sum(padded)::BIGINT AS padded_short, sum(folded)::BIGINT AS merged_long FROM r GROUP BY ALL),
c AS (SELECT year, quarter, zip_name, count(*) AS filtered_rows, sum(caseid_overridden)::BIGINT AS caseid_overridden FROM f GROUP BY ALL), i AS (SELECT year, quarter, zip_name, count(*) AS inserted_rows FROM g GROUP BY ALL)
SELECT year, quarter, zip_name, raw_rows, skipped_no_primaryid, trailing_trimmed, padded_short, merged_long, coalesce(filtered_rows, 0) AS filtered_rows, coalesce(caseid_overridden, 0) AS caseid_overridden, coalesce(inserted_rows, 0) AS inserted_rows
FROM p LEFT JOIN c USING (year, quarter, zip_name) LEFT JOIN i USING (year, quarter, zip_name)""")
def fact_counters(spark, d):
    rows, chosen = _drug_rows(spark, d)
    return cases.drug_counters(rows, chosen)


_TERM_MAP = """
parts AS (SELECT p_partkey, p_name, p_size, p_brand AS brand, translate(replace(p_brand, 'Brand#', ''), '0123456789', 'QRSTUVWXYZ') AS p_brand FROM part),
t AS (SELECT p_name || ' ' || p_brand AS term_std, count(*) AS n_rows, count(DISTINCT p_size) AS n_cases FROM parts GROUP BY 1),
x AS (SELECT *, upper(term_std) AS term_norm, CASE WHEN term_norm LIKE '%WIDGET R' THEN 'EXCLUDE_NON_DRUG' WHEN term_norm LIKE '%RING S' THEN 'MAP_TO_TERM' ELSE '' END AS manual_action,
  CASE WHEN term_norm LIKE '%RING S' THEN split_part(term_norm, ' ', 1) || ' RING T' ELSE '' END AS manual_target FROM t),
v AS (SELECT 'R' || (p_partkey % 300) AS rxcui, CASE p_partkey % 4 WHEN 0 THEN 'RXNORM' WHEN 1 THEN 'GS' WHEN 2 THEN 'ATC' ELSE 'OTHER' END AS sab, CASE p_partkey % 3 WHEN 0 THEN 'IN' WHEN 1 THEN 'BN' ELSE 'XX' END AS tty, 'C' AS code, p_name || '  ' || lower(p_brand) AS string,
  p_partkey AS line_no, upper(p_name || ' ' || p_brand) AS v_norm FROM parts WHERE p_size > 10),
h AS (SELECT term_std, term_norm, rxcui, sab, tty, code, string, min(line_no) AS line_no FROM x JOIN v ON v_norm = CASE WHEN manual_target <> '' THEN manual_target ELSE term_norm END WHERE manual_action <> 'EXCLUDE_NON_DRUG' GROUP BY ALL),
q AS (SELECT *, count(*) OVER (PARTITION BY term_std) AS n FROM h QUALIFY row_number() OVER (PARTITION BY term_std ORDER BY CASE sab WHEN 'RXNORM' THEN 1 WHEN 'GS' THEN 5 WHEN 'ATC' THEN 8 ELSE 99 END, CASE tty WHEN 'IN' THEN 1 WHEN 'BN' THEN 12 ELSE 99 END,
  (upper(regexp_replace(string, ' +', ' ', 'g')) <> term_norm)::INT, abs(length(regexp_replace(string, ' +', ' ', 'g')) - length(term_norm)), length(regexp_replace(string, ' +', ' ', 'g')), line_no) = 1),
l AS (SELECT DISTINCT 'R' || (p_partkey % 300) AS rxcui, 'DB' || (p_partkey % 40 + 10) AS dbid FROM parts WHERE p_partkey % 7 < 4),
n AS (SELECT 'DB' || i AS dbid, 'name ' || i AS name FROM range(10, 60) r(i) UNION ALL SELECT 'DN' || min(p_partkey), p_name || ' ' || p_brand FROM parts WHERE brand LIKE '%5' GROUP BY p_name, p_brand),
s AS (SELECT dbid, 'InChI=' || dbid AS inchi FROM n WHERE right(dbid, 1) IN ('0', '2', '4', '6', '8')),
b AS (SELECT rxcui, coalesce(min(CASE WHEN s.dbid IS NOT NULL THEN l.dbid END), min(l.dbid)) AS dbid FROM l LEFT JOIN s USING (dbid) GROUP BY rxcui),
y AS (SELECT x.term_std, min(n.dbid) AS dbid FROM x JOIN n ON upper(n.name) = CASE WHEN manual_target <> '' THEN manual_target ELSE term_norm END JOIN s ON s.dbid = n.dbid WHERE x.term_std NOT IN (SELECT term_std FROM q) AND manual_action <> 'EXCLUDE_NON_DRUG' GROUP BY 1),
z AS (SELECT x.term_std, min(n.dbid) AS dbid FROM x JOIN n ON upper(n.name) = term_norm JOIN s ON s.dbid = n.dbid WHERE x.term_std NOT IN (SELECT term_std FROM q UNION ALL SELECT term_std FROM y) AND manual_action <> 'EXCLUDE_NON_DRUG' GROUP BY 1),
m AS (
  SELECT x.term_std, x.term_norm, n_rows, n_cases, manual_action, manual_target,
    CASE WHEN manual_action = 'EXCLUDE_NON_DRUG' THEN 'MANUAL_EXCLUDE' ELSE CASE WHEN manual_action = 'MAP_TO_TERM' THEN 'MANUAL_' ELSE '' END || CASE WHEN q.term_std IS NOT NULL THEN 'EXACT' WHEN coalesce(y.dbid, z.dbid) IS NOT NULL THEN 'DB_NAME_EXACT' ELSE 'UNMAPPED' END END AS mapping_stage,
    coalesce(q.n, CASE WHEN coalesce(y.dbid, z.dbid) IS NOT NULL THEN 1 ELSE 0 END)::INT AS candidate_count, coalesce(q.rxcui, '') AS rxcui, coalesce(q.sab, '') AS sab, coalesce(q.tty, '') AS tty, coalesce(q.code, '') AS code, coalesce(string, '') AS rx_string,
    coalesce(b.dbid, y.dbid, z.dbid, '') AS dbid
  FROM x LEFT JOIN q USING (term_std) LEFT JOIN b ON b.rxcui = q.rxcui LEFT JOIN y ON y.term_std = x.term_std LEFT JOIN z ON z.term_std = x.term_std
), w AS (SELECT m.*, coalesce(n.name, '') AS drugbank_name, coalesce(s.inchi, '') AS inchi FROM m LEFT JOIN n ON n.dbid = m.dbid LEFT JOIN s ON s.dbid = m.dbid)
"""


def _term_map(spark, d):
    word = F.translate(F.replace("p_brand", F.lit("Brand#"), F.lit("")), "0123456789", "QRSTUVWXYZ")
    part = _read(spark, d, "part").select("p_partkey", "p_name", "p_size", F.col("p_brand").alias("brand"), word.alias("p_brand"))
    terms = part.groupBy(F.concat_ws(" ", "p_name", "p_brand").alias("term_std")).agg(F.count("*").alias("n_rows"), F.countDistinct("p_size").alias("n_cases"))
    k = F.col("p_partkey")
    words = part.where("p_size > 10").select(
        F.concat(F.lit("R"), (k % 300).cast("string")).alias("rxcui"), F.when(k % 4 == 0, "RXNORM").when(k % 4 == 1, "GS").when(k % 4 == 2, "ATC").otherwise("OTHER").alias("sab"),
        F.when(k % 3 == 0, "IN").when(k % 3 == 1, "BN").otherwise("XX").alias("tty"), F.lit("C").alias("code"), F.concat("p_name", F.lit("  "), F.lower("p_brand")).alias("string"), k.alias("line_no"),
    )
    links = part.where(k % 7 < 4).select(F.concat(F.lit("R"), (k % 300).cast("string")).alias("rxcui"), F.concat(F.lit("DB"), (k % 40 + 10).cast("string")).alias("dbid"))
    named = part.where("brand LIKE '%5'").groupBy("p_name", "p_brand").agg(F.min(k).alias("k")).select(F.concat(F.lit("DN"), F.col("k").cast("string")).alias("dbid"), F.concat_ws(" ", "p_name", "p_brand").alias("name"))
    numbered = spark.range(10, 60).select(F.concat(F.lit("DB"), F.col("id").cast("string")).alias("dbid"), F.concat(F.lit("name "), F.col("id").cast("string")).alias("name"))
    names = numbered.unionByName(named)
    inchi = names.where(F.substring("dbid", -1, 1).isin(*"02468")).select("dbid", F.concat(F.lit("InChI="), "dbid").alias("inchi"))
    norm = F.upper("term_std")
    target = F.when(norm.like("%RING S"), F.concat(F.split("term_std", " ")[0], F.lit(" ring  T"))).otherwise("")
    fixes = terms.where(norm.like("%WIDGET R") | norm.like("%RING S")).select("term_std", F.when(norm.like("%RING S"), "MAP_TO_TERM").otherwise("EXCLUDE_NON_DRUG").alias("action"), target.alias("target_term"), F.lit(1).cast("bigint").alias("line_no"))
    return match.map_terms(terms, words, links, names, inchi, fixes)


@query(f"WITH {_TERM_MAP} SELECT term_std, term_norm, n_rows, n_cases, manual_action, manual_target, mapping_stage, candidate_count, rxcui, sab, tty, code, rx_string, dbid, drugbank_name, inchi FROM w")
def term_map(spark, d):
    return _term_map(spark, d)


@query(f"WITH {_TERM_MAP} SELECT mapping_stage, count(*) AS n_terms, sum(n_rows)::BIGINT AS n_rows FROM w GROUP BY mapping_stage")
def term_map_stage_counts(spark, d):
    return match.stage_counts(_term_map(spark, d))


@query(f"""WITH {_TERM_MAP} SELECT term_std, mapping_stage, n_rows FROM w WHERE trim(inchi) = '' ORDER BY n_rows DESC, term_std LIMIT 200""")
def unmapped_export(spark, d):
    """Terms without a structure, excluded ones too, with most rows."""
    found = _term_map(spark, d).withColumnRenamed("inchi", "structure")
    return curate.unmapped(found, 200, excluded=True).select("term_std", "mapping_stage", "n_rows")


@query(f"""WITH {_TERM_MAP} SELECT term_std, mapping_stage, n_rows FROM w WHERE trim(inchi) = '' AND mapping_stage <> 'MANUAL_EXCLUDE'""")
def unmapped_candidates(spark, d):
    found = _term_map(spark, d).withColumnRenamed("inchi", "structure")
    return curate.unmapped(found).select("term_std", "mapping_stage", "n_rows")


@query("""WITH t AS (SELECT p_partkey, upper(p_name || ' and ' || p_type) AS t FROM part)
SELECT p_partkey, 1 AS priority, 'EXACT' AS stage, t AS variant FROM t UNION ALL SELECT p_partkey, 3, 'AND_TO_SLASH', replace(t, ' AND ', ' / ') FROM t""")
def term_variants_curation(spark, d):
    terms = _read(spark, d, "part").select("p_partkey", F.concat_ws(" and ", "p_name", "p_type").alias("term"))
    return text.variants(terms, "term", ["p_partkey"], curation=True)


@query("SELECT p_partkey, upper(p_name) || ' SODIUM|' || upper(p_name) AS probes FROM part")
def probe_terms(spark, d):
    parts = _read(spark, d, "part").select("p_partkey", "p_name").repartition(spark.sparkContext.defaultParallelism)  # a small file with much work
    return parts.select("p_partkey", F.array_join(text.probe_terms(F.concat("p_name", F.lit("  sodium"))), "|").alias("probes"))


@query(f"WITH {_EDGE_SQL} SELECT compound, count(*) FILTER (role = 'PS') AS ps_edges, count(*) FILTER (role = 'SS') AS ss_edges, max(n_reports) AS top FROM e WHERE n_reports >= 20 GROUP BY compound")
def compound_degrees(spark, d):
    kept = written(graph.prune(_edges(spark, d), "n_reports", 20), "edges")
    of = lambda role: F.sum((F.col("role") == role).cast("bigint"))
    return kept.groupBy("compound").agg(of("PS").alias("ps_edges"), of("SS").alias("ss_edges"), F.max("n_reports").alias("top"))


_PAIR_SQL = """
c AS (SELECT l_orderkey AS report, CASE l_returnflag WHEN 'R' THEN 'PS' WHEN 'A' THEN 'SS' ELSE 'C' END AS role, CASE WHEN p_size % 9 = 0 THEN ' ' ELSE p_brand END AS compound FROM lineitem JOIN part ON l_partkey = p_partkey),
o AS (SELECT DISTINCT l_orderkey AS report, 'o' || (l_suppkey % 30) AS outcome FROM lineitem),
p AS (SELECT compound, outcome, count(*) AS n FROM (SELECT DISTINCT report, compound FROM c WHERE role IN ('PS', 'SS') AND trim(compound) <> '') JOIN o USING (report) GROUP BY ALL),
a AS (SELECT compound, outcome, count(*) AS n FROM (SELECT DISTINCT report, compound FROM c WHERE trim(compound) <> '') JOIN o USING (report) GROUP BY ALL),
k AS (SELECT * FROM p WHERE n >= 30), ci AS (SELECT compound, row_number() OVER (ORDER BY compound) AS i FROM (SELECT DISTINCT compound FROM k)), oi AS (SELECT outcome, row_number() OVER (ORDER BY outcome) AS j FROM (SELECT DISTINCT outcome FROM k))
"""


def _pair_sides(spark, d):
    role = F.when(F.col("l_returnflag") == "R", "PS").when(F.col("l_returnflag") == "A", "SS").otherwise("C")
    lines = _read(spark, d, "lineitem")
    part = _read(spark, d, "part").select("p_partkey", F.when(F.col("p_size") % 9 == 0, " ").otherwise(F.col("p_brand")).alias("compound"))
    c = lines.join(part, F.col("l_partkey") == F.col("p_partkey")).select(F.col("l_orderkey").alias("report"), role.alias("role"), "compound")
    o = lines.select(F.col("l_orderkey").alias("report"), F.concat(F.lit("o"), (F.col("l_suppkey") % 30).cast("string")).alias("outcome"))
    return c, o


@query(f"WITH {_PAIR_SQL} SELECT i AS compound_id, j AS outcome_id, n AS n_cases FROM k JOIN ci USING (compound) JOIN oi USING (outcome)")
def pair_tables_matrix(spark, d):
    return graph.pair_tables(*_pair_sides(spark, d), 30)["matrix"]


@query(f"""WITH {_PAIR_SQL} SELECT 'pairs' AS item, count(*) AS rows, coalesce(sum(n), 0)::BIGINT AS n FROM p UNION ALL SELECT 'pruned', count(*), coalesce(sum(n), 0)::BIGINT FROM k
UNION ALL SELECT 'any', count(*), coalesce(sum(n), 0)::BIGINT FROM a UNION ALL SELECT 'not asked', 0, 0""")
def pair_tables_counts(spark, d):
    weights = graph.pair_weights(*_pair_sides(spark, d))
    with_any, without = (graph.tables_of_weights(weights, 30, include_any=x) for x in (True, False))
    tables = {"pairs": with_any["pairs"], "pruned": with_any["pruned"], "any": with_any["any"], "not asked": without["any"]}
    out = None
    for item, t in tables.items():
        row = t.agg(F.count("*").alias("rows"), F.coalesce(F.sum("n_cases"), F.lit(0)).cast("bigint").alias("n")).select(F.lit(item).alias("item"), "rows", "n")
        out = row if out is None else out.unionByName(row)
    return out


@query(f"""WITH {_EDGE_SQL}, n AS (SELECT compound, max((n_reports >= 100)::INT) AS in_ge100, max((n_reports >= 200)::INT) AS in_ge200 FROM e GROUP BY compound)
SELECT compound, parts, in_ge100, in_ge200 FROM n JOIN (SELECT p_brand AS compound, count(*) AS parts FROM part GROUP BY p_brand) USING (compound)""")
def reference_compounds(spark, d):
    e = written(_edges(spark, d), "edges")
    parts = _read(spark, d, "part").groupBy(F.col("p_brand").alias("compound")).agg(F.count("*").alias("parts"))
    nodes = graph.nodes_of([e], "compound").join(parts, "compound")
    return graph.reference_compounds(nodes, "compound", {f"in_ge{n}": graph.prune(e, "n_reports", n) for n in (100, 200)})
