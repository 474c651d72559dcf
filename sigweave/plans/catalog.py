"""The query catalogue on the driver's tables, each with the SQL that an oracle runs.

Report = order, compound = brand, role = return flag (R as PS, A as SS), outcome = supplier's nation, parent = region.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text
from ..operators import dedup, graph, match, reactions, report, structures
from ..sources import ragged
from .store import written

_QUERIES: dict = {}
_SQL: dict[str, str] = {}


def query(sql: str | None = None, name: str | None = None):
    def add(f):
        _QUERIES[name or f.__name__] = f
        if sql:
            _SQL[name or f.__name__] = sql
        return f

    return add


def queries() -> dict:
    from . import catalog_archives, catalog_cases, catalog_curation  # noqa: F401  register their queries here

    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    queries()
    return dict(_SQL)


def _read(spark: SparkSession, d: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{table}.parquet")


def _compounds(spark, d):
    role = F.when(F.col("l_returnflag") == "R", "PS").when(F.col("l_returnflag") == "A", "SS")
    lines = _read(spark, d, "lineitem").where(F.col("l_returnflag").isin("R", "A")).select(F.col("l_orderkey").alias("report"), role.alias("role"), "l_partkey")
    return lines.join(_read(spark, d, "part").select(F.col("p_partkey").alias("l_partkey"), F.col("p_brand").alias("compound")), "l_partkey").select("report", "role", "compound")


def _outcomes(spark, d):
    nation = _read(spark, d, "supplier").join(_read(spark, d, "nation"), F.col("s_nationkey") == F.col("n_nationkey")).select(F.col("s_suppkey").alias("l_suppkey"), F.col("n_name").alias("outcome"))
    return _read(spark, d, "lineitem").select(F.col("l_orderkey").alias("report"), "l_suppkey").join(nation, "l_suppkey").select("report", "outcome")


def _edges(spark, d, role=None):
    c = _compounds(spark, d)
    if role:
        c = c.where(F.col("role") == role)
    return graph.pair_counts(c, _outcomes(spark, d), "report", ["role", "compound"], ["outcome"], "n_reports", "distinct_reports")


_EDGE_SQL = """
c AS (SELECT DISTINCT l_orderkey AS report, CASE l_returnflag WHEN 'R' THEN 'PS' ELSE 'SS' END AS role, p_brand AS compound FROM lineitem JOIN part ON l_partkey = p_partkey WHERE l_returnflag IN ('R', 'A')),
o AS (SELECT DISTINCT l_orderkey AS report, n_name AS outcome FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey),
e AS (SELECT role, compound, outcome, count(*) AS n_reports FROM c JOIN o USING (report) GROUP BY ALL)
"""


@query(f"WITH {_EDGE_SQL} SELECT compound, outcome, n_reports FROM e WHERE role = 'PS'")
def flagship_graph_ps(spark, d):
    return _edges(spark, d, "PS").drop("role")


def _pruned(least):
    @query(f"WITH {_EDGE_SQL} SELECT * FROM e WHERE n_reports >= {least}", f"graph_prune_ge{least}")
    def run(spark, d):
        return graph.prune(_edges(spark, d), "n_reports", least)


for _least in (100, 150, 200):
    _pruned(_least)


@query(f"WITH {_EDGE_SQL} SELECT DISTINCT compound FROM e WHERE n_reports >= 150")
def graph_nodes_compound(spark, d):
    return graph.nodes_of([graph.prune(_edges(spark, d), "n_reports", 150)], "compound")


@query(f"WITH {_EDGE_SQL} SELECT outcome, min(compound) AS name FROM e WHERE n_reports >= 150 GROUP BY outcome")
def graph_nodes_outcome(spark, d):
    return graph.nodes_of([graph.prune(_edges(spark, d), "n_reports", 150)], "outcome", F.col("compound"))


@query("SELECT n_name AS outcome, r_name AS parent FROM nation JOIN region ON n_regionkey = r_regionkey QUALIFY row_number() OVER (PARTITION BY n_name ORDER BY CASE WHEN r_name LIKE 'A%' THEN 0 ELSE 1 END, r_regionkey, n_nationkey) = 1")
def outcome_primary_parent(spark, d):
    h = _read(spark, d, "nation").join(_read(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    h = h.select(F.col("n_name").alias("outcome"), F.col("r_name").alias("parent"), F.struct("r_regionkey", "n_nationkey").alias("o"))
    return graph.primary_parent(h, "outcome", F.col("parent").startswith("A"), "o").drop("o")


@query(f"""WITH {_EDGE_SQL} SELECT outcome, max((n_reports >= 100)::INT) AS in_ge100, max((n_reports >= 150)::INT) AS in_ge150, max((n_reports >= 200)::INT) AS in_ge200, first(r_name) AS parent
FROM e JOIN nation ON outcome = n_name LEFT JOIN region ON n_regionkey = r_regionkey GROUP BY outcome""")
def graph_membership_flags(spark, d):
    e = written(_edges(spark, d), "edges")
    nodes = graph.flags(graph.nodes_of([e], "outcome"), "outcome", {f"in_ge{n}": graph.prune(e, "n_reports", n) for n in (100, 150, 200)})
    h = _read(spark, d, "nation").join(_read(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey"), "left").select(F.col("n_name").alias("outcome"), F.col("r_name").alias("parent"))
    return nodes.join(h, "outcome", "left")


@query(f"""WITH {_EDGE_SQL}, p AS (SELECT * FROM e WHERE n_reports >= 150)
SELECT 'compound_nodes' AS item, count(DISTINCT compound) AS n FROM p UNION ALL SELECT 'outcome_nodes', count(DISTINCT outcome) FROM p UNION ALL SELECT 'edge_ps', count(*) FROM p WHERE role = 'PS' UNION ALL SELECT 'edge_ss', count(*) FROM p WHERE role = 'SS' UNION ALL
SELECT 'parent_nodes', count(DISTINCT n_regionkey) FROM p JOIN nation ON outcome = n_name""")
def graph_summary(spark, d):
    h = _read(spark, d, "nation").select(F.col("n_name").alias("outcome"), F.col("n_regionkey").alias("parent"))
    g = graph.core_graph(_compounds(spark, d), _outcomes(spark, d), h, 150)
    items = {"compound_nodes": "node_compound", "outcome_nodes": "node_outcome", "edge_ps": "edge_ps", "edge_ss": "edge_ss", "parent_nodes": "node_parent"}
    out = None
    for item, table in items.items():
        row = g[table].agg(F.count("*").alias("n")).select(F.lit(item).alias("item"), "n")
        out = row if out is None else out.unionByName(row)
    return out


_PAIR = "SELECT DISTINCT l_orderkey AS report, p_brand AS compound FROM lineitem JOIN part ON l_partkey = p_partkey"


@query(f"WITH c AS ({_PAIR}), o AS (SELECT DISTINCT l_orderkey AS report, l_linestatus AS outcome, l_returnflag AS via FROM lineitem) SELECT compound, outcome, count(*) AS n_cases FROM c JOIN o USING (report) GROUP BY ALL")
def pair_counts_any(spark, d):
    return _pair(spark, d, "rows")


@query(f"WITH c AS ({_PAIR}), o AS (SELECT DISTINCT l_orderkey AS report, l_linestatus AS outcome FROM lineitem) SELECT compound, outcome, count(*) AS n_cases FROM c JOIN o USING (report) GROUP BY ALL")
def pair_counts_distinct(spark, d):
    return _pair(spark, d, "distinct_reports")


def _pair(spark, d, mode):
    lines = _read(spark, d, "lineitem")
    c = lines.join(_read(spark, d, "part"), F.col("l_partkey") == F.col("p_partkey")).select(F.col("l_orderkey").alias("report"), F.col("p_brand").alias("compound"))
    o = lines.select(F.col("l_orderkey").alias("report"), F.col("l_linestatus").alias("outcome"), F.col("l_returnflag").alias("via"))
    return graph.pair_counts(c, o, "report", ["compound"], ["outcome"], mode=mode)


@query(f"""WITH {_EDGE_SQL}, p AS (SELECT compound, outcome, n_reports FROM e WHERE role = 'PS'), ci AS (SELECT compound, row_number() OVER (ORDER BY compound) AS compound_id FROM (SELECT DISTINCT compound FROM p)),
oi AS (SELECT outcome, row_number() OVER (ORDER BY outcome) AS outcome_id FROM (SELECT DISTINCT outcome FROM p)) SELECT compound_id, outcome_id, n_reports FROM p JOIN ci USING (compound) JOIN oi USING (outcome)""")
def pair_matrix_coo(spark, d):
    e = written(_edges(spark, d, "PS"), "edges")
    return graph.coo(e, graph.surrogate(e, "compound", "compound_id"), "compound", graph.surrogate(e, "outcome", "outcome_id"), "outcome", "n_reports")


@query("SELECT row_number() OVER (ORDER BY p_name) AS entity_id, p_name, n FROM (SELECT p_name, count(*) AS n FROM part GROUP BY p_name)")
def entity_index(spark, d):
    p = _read(spark, d, "part")
    return graph.surrogate(p, "p_name", "entity_id").join(p.groupBy("p_name").agg(F.count("*").alias("n")), "p_name").select("entity_id", "p_name", "n")


@query(f"WITH {_EDGE_SQL} SELECT role, compound, outcome, n_reports FROM e ORDER BY n_reports DESC, compound, outcome, role LIMIT 20000")
def pair_top20000(spark, d):
    return _edges(spark, d).orderBy(F.desc("n_reports"), "compound", "outcome", "role").limit(20000)


@query("""WITH a AS (SELECT * FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey, o_orderdate::DATE ORDER BY o_totalprice DESC, o_orderkey DESC) = 1)
SELECT o_custkey, o_orderkey, o_totalprice FROM a QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_totalprice DESC, o_orderkey DESC) = 1""")
def case_latest_two_stage(spark, d):
    o = _read(spark, d, "orders").withColumn("day", F.to_date("o_orderdate"))
    o = dedup.top_one(o, ["o_custkey", "day"], [F.desc("o_totalprice"), F.desc("o_orderkey")])
    return dedup.top_one(o, ["o_custkey"], [F.desc("o_orderdate"), F.desc("o_totalprice"), F.desc("o_orderkey")]).select("o_custkey", "o_orderkey", "o_totalprice")


@query("""WITH s AS (SELECT event_id, user_id, CASE event_id % 5 WHEN 0 THEN (event_id % 9)::VARCHAR WHEN 1 THEN (event_id % 90)::VARCHAR || 'A' ELSE (event_id % 500)::VARCHAR END AS version, CASE WHEN event_id % 3 = 0 THEN 'I' ELSE 'f ' END AS kind, CASE WHEN event_id % 7 = 0 THEN strftime(ts, '%Y%m') ELSE strftime(ts, '%Y%m%d') END AS day FROM events),
n AS (SELECT *, CASE WHEN regexp_matches(version, '^[0-9][0-9]') THEN regexp_extract(version, '^[0-9]+')::BIGINT ELSE 0 END AS version_n, CASE WHEN length(day) = 8 THEN day::BIGINT ELSE 0 END AS day_n, CASE upper(trim(kind)) WHEN 'F' THEN 2 WHEN 'I' THEN 1 ELSE 0 END AS kind_n FROM s)
SELECT user_id, event_id, version_n, day_n, kind_n FROM n QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY version_n DESC, day_n DESC, kind_n DESC, event_id DESC) = 1""")
def case_latest_scored(spark, d):
    i = F.col("event_id")
    version = F.when(i % 5 == 0, (i % 9).cast("string")).when(i % 5 == 1, F.concat((i % 90).cast("string"), F.lit("A"))).otherwise((i % 500).cast("string"))
    e = _read(spark, d, "events").select("event_id", "user_id", dedup.digit_score(version).alias("version_n"), dedup.date_score(F.when(i % 7 == 0, F.date_format("ts", "yyyyMM")).otherwise(F.date_format("ts", "yyyyMMdd"))).alias("day_n"), dedup.followup_rank(F.when(i % 3 == 0, "I").otherwise("f ")).alias("kind_n"))
    return dedup.top_one(e, ["user_id"], [F.desc(c) for c in ("version_n", "day_n", "kind_n", "event_id")]).select("user_id", "event_id", "version_n", "day_n", "kind_n")


@query("SELECT o_orderkey, o_custkey FROM orders WHERE NOT EXISTS (SELECT 1 FROM (SELECT s_suppkey * 7 AS id FROM supplier) x WHERE id = o_orderkey OR id = o_custkey)")
def tombstone_filter(spark, d):
    dead = _read(spark, d, "supplier").select((F.col("s_suppkey") * 7).alias("id"))
    return dedup.drop_tombstones(_read(spark, d, "orders"), dead, ["o_orderkey", "o_custkey"]).select("o_orderkey", "o_custkey")


def _wins(which, sign):
    @query(f"SELECT l_suppkey, l_partkey, l_orderkey, l_linenumber FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_suppkey, l_partkey ORDER BY l_orderkey {sign}, l_linenumber {sign}, l_extendedprice {sign}) = 1", f"{which}_wins")
    def run(spark, d):
        f = dedup.first_wins if which == "first" else dedup.last_wins
        return f(_read(spark, d, "lineitem"), ["l_suppkey", "l_partkey"], ["l_orderkey", "l_linenumber", "l_extendedprice"]).select("l_suppkey", "l_partkey", "l_orderkey", "l_linenumber")


_wins("first", "ASC")
_wins("last", "DESC")


@query("""WITH f AS (SELECT o_orderkey AS primaryid, CASE WHEN o_orderkey % 10 = 0 THEN o_custkey + 1 ELSE o_custkey END AS caseid, o_custkey AS selected, year(o_orderdate)::INTEGER AS year, quarter(o_orderdate)::INTEGER AS quarter, o_orderstatus FROM orders)
SELECT year, quarter, count(*) AS n, sum((caseid <> selected)::INT)::BIGINT AS overridden, sum(selected)::BIGINT AS ids FROM f JOIN lineitem ON primaryid = l_orderkey WHERE o_orderstatus <> 'P' GROUP BY ALL""")
def selected_case_override(spark, d):
    o = _read(spark, d, "orders").select(F.col("o_orderkey").alias("primaryid"), F.col("o_custkey").alias("caseid"), F.year("o_orderdate").alias("year"), F.quarter("o_orderdate").alias("quarter"), "o_orderstatus")
    shifted = o.drop("o_orderstatus").withColumn("caseid", F.when(F.col("primaryid") % 10 == 0, F.col("caseid") + 1).otherwise(F.col("caseid")))
    facts = shifted.join(_read(spark, d, "lineitem").select(F.col("l_orderkey").alias("primaryid"), "l_linenumber"), "primaryid")
    got = dedup.select_facts(facts, o.where("o_orderstatus <> 'P'").drop("o_orderstatus"))
    return got.groupBy("year", "quarter").agg(F.count("*").alias("n"), F.sum("caseid_overridden").alias("overridden"), F.sum("caseid").alias("ids"))


@query("SELECT p_name AS term, count(*) AS n_rows, count(DISTINCT l_orderkey) AS n_cases FROM lineitem JOIN part ON l_partkey = p_partkey WHERE trim(p_name) <> '' GROUP BY p_name")
def term_stats(spark, d):
    j = _read(spark, d, "lineitem").join(_read(spark, d, "part"), F.col("l_partkey") == F.col("p_partkey")).where(~text.is_blank(F.col("p_name")))
    return j.groupBy(F.col("p_name").alias("term")).agg(F.count("*").alias("n_rows"), F.countDistinct("l_orderkey").alias("n_cases"))


# Terms of documents and parts with marks, for the normalisers; the oracle repeats the rules step by step.
_TERM = """'"' || p_name || '\\' || p_type || '&' || p_brand || ' (' || p_size || ' MG/5 ML)-HCL; tablet,  5 %'"""


def _terms(spark, d):
    p = _read(spark, d, "part")
    return p.select("p_partkey", F.concat(F.lit('"'), "p_name", F.lit("\\"), "p_type", F.lit("&"), "p_brand", F.lit(" ("), F.col("p_size").cast("string"), F.lit(" MG/5 ML)-HCL; tablet,  5 %")).alias("term"))


_UP = f"upper(trim(regexp_replace({_TERM}, '\\s+', ' ', 'g')))"
_OFF = "regexp_replace({0}, '^[\"'']+|[\"'']+$', '', 'g')"
_PAD = "trim(regexp_replace(regexp_replace({0}, '\\s*([{1}])\\s*', ' \\1 ', 'g'), '\\s+', ' ', 'g'))"
_V2 = _PAD.format(_OFF.format(_UP), ",;/+()\\[\\]-")
_V3 = _PAD.format(_OFF.format(f"replace({_UP}, '\\', ' / ')"), ",;/+&()\\[\\]-")
_ONE = "\\d+(?:\\.\\d+)?\\s*(?:" + "|".join(text.UNITS) + ")"


def _clean_sql(t, words=text.FORM_WORDS):
    t = f"regexp_replace({t}, '\\b{_ONE}(?:\\s*/\\s*{_ONE})?\\b', ' ', 'g')"
    t = f"regexp_replace({t}, '\\b(?:{'|'.join(words)})\\b', ' ', 'g')"
    t = f"regexp_replace({t}, '\\b\\d+(?:\\.\\d+)?\\b', ' ', 'g')"
    return f"trim(regexp_replace(regexp_replace({t}, '\\s*[,;/+()\\[\\]-]\\s*', ' ', 'g'), '\\s+', ' ', 'g'))"


def _norm(name, sql, f):
    @query(f"SELECT p_partkey, {sql} AS v FROM part", name)
    def run(spark, d):
        return _terms(spark, d).select("p_partkey", f(F.col("term")).alias("v"))


_norm("norm_text", _UP, text.normalize_text)
_norm("norm_drug_v2", _V2, text.normalize_drug_v2)
_norm("norm_drug_v3", _V3, text.normalize_drug_v3)
_norm("clean_term", _clean_sql(_V3), text.clean_term)


@query("SELECT doc_id, trim(regexp_replace(regexp_replace(regexp_replace(upper(trim(regexp_replace(lang || ' -- ' || source || '/a -b', '\\s+', ' ', 'g'))), '\\s*-+\\s*', '-', 'g'), '\\s*/\\s*', ' / ', 'g'), '\\s+', ' ', 'g')) AS v FROM documents")
def norm_reaction(spark, d):
    return _read(spark, d, "documents").select("doc_id", text.normalize_reaction(F.concat("lang", F.lit(" -- "), "source", F.lit("/a -b"))).alias("v"))


@query("SELECT p_partkey, CASE WHEN p_size % 3 = 0 THEN 'SODIUM' ELSE upper(p_type) END AS v FROM part")
def salt_strip(spark, d):
    p = _read(spark, d, "part")
    return p.select("p_partkey", text.strip_salt(F.when(F.col("p_size") % 3 == 0, F.lit("sodium citrate")).otherwise(F.concat("p_type", F.lit(" hydrochloride  monohydrate")))).alias("v"))


@query(f"""WITH t AS (SELECT DISTINCT upper(p_type) || ' / ' || upper(p_brand) || ' ( ' || p_size || ' X )' AS b FROM part), v AS (
SELECT b, 1 AS priority, 'EXACT' AS stage, b AS v FROM t UNION ALL SELECT b, 2, 'CLEANED', {_clean_sql('b')} FROM t UNION ALL
SELECT b, 3, 'PAREN', unnest(regexp_extract_all(b, '\\(([^()]{{2,}})\\)', 1)) FROM t UNION ALL SELECT b, 4, 'SPLIT', unnest(string_split(b, '/')) FROM t), n AS (SELECT b, priority, stage, {_PAD.format('v', ',;/+&()\\[\\]-')} AS variant FROM v)
SELECT b AS term, variant, min(priority)::INT AS priority, arg_min(stage, priority) AS stage FROM n WHERE variant <> '' GROUP BY b, variant""".replace("#", "\\#"))
def term_variants(spark, d):
    p = _read(spark, d, "part").select(F.concat(F.upper("p_type"), F.lit(" / "), F.upper("p_brand"), F.lit(" ( "), F.col("p_size").cast("string"), F.lit(" X )")).alias("term")).distinct()
    # The part after a slash keeps its parentheses, as in the base form.
    return text.variants(p, "term", ["term"])


def _stages(spark, d):
    types = _read(spark, d, "part").select(F.col("p_type").alias("key")).distinct().where("key < 'N'").select("key", F.lower("key").alias("code"), F.col("key").alias("name"))
    brands = _read(spark, d, "part").groupBy(F.col("p_brand").alias("key")).agg(F.min("p_type").alias("name")).where("key like '%1'").select("key", F.concat(F.lit("b-"), "key").alias("code"), "name")
    return [("PT_EXACT", types), ("LLT_TO_PT", brands)]


_CASCADE = """WITH t AS (SELECT p_partkey, CASE p_partkey % 3 WHEN 0 THEN p_type WHEN 1 THEN p_brand ELSE ' ' END AS term FROM part), a AS (SELECT DISTINCT p_type AS key FROM part WHERE p_type < 'N'), b AS (SELECT p_brand AS key, min(p_type) AS name FROM part WHERE p_brand LIKE '%1' GROUP BY p_brand),
m AS (SELECT p_partkey, term, CASE WHEN a.key IS NOT NULL THEN lower(a.key) WHEN b.key IS NOT NULL THEN 'b-' || b.key ELSE '' END AS code, CASE WHEN a.key IS NOT NULL THEN a.key WHEN b.key IS NOT NULL THEN b.name ELSE '' END AS name,
CASE WHEN a.key IS NOT NULL THEN 'PT_EXACT' WHEN b.key IS NOT NULL THEN 'LLT_TO_PT' WHEN trim(term) = '' THEN 'EMPTY_PT' ELSE 'UNRESOLVED' END AS map_source FROM t LEFT JOIN a ON term = a.key LEFT JOIN b ON term = b.key)"""


def _cascaded(spark, d):
    p = _read(spark, d, "part")
    term = F.when(F.col("p_partkey") % 3 == 0, F.col("p_type")).when(F.col("p_partkey") % 3 == 1, F.col("p_brand")).otherwise(" ")
    return match.cascade(p.select("p_partkey", term.alias("term")), "term", _stages(spark, d))


@query(f"{_CASCADE} SELECT * FROM m")
def cascade_map(spark, d):
    return _cascaded(spark, d)


@query(f"{_CASCADE} SELECT map_source, count(*) AS n FROM m GROUP BY map_source ORDER BY n DESC, map_source")
def cascade_source_counts(spark, d):
    return _cascaded(spark, d).groupBy("map_source").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "map_source")


_SAB = "CASE p_size % 4 WHEN 0 THEN 'RXNORM' WHEN 1 THEN 'GS' WHEN 2 THEN 'ATC' ELSE 'XX' END"
_CAND = f"""WITH c AS (SELECT p_brand AS k, p_partkey AS line_no, {_SAB} AS sab, CASE p_partkey % 3 WHEN 0 THEN 'IN' WHEN 1 THEN 'BN' ELSE 'ZZ' END AS tty, upper(p_type) AS string FROM part)"""


def _candidates(spark, d):
    size, i = F.col("p_size") % 4, F.col("p_partkey")
    sab = F.when(size == 0, "RXNORM").when(size == 1, "GS").when(size == 2, "ATC").otherwise("XX")
    return _read(spark, d, "part").select(F.col("p_brand").alias("k"), i.alias("line_no"), sab.alias("sab"), F.when(i % 3 == 0, "IN").when(i % 3 == 1, "BN").otherwise("ZZ").alias("tty"), F.upper("p_type").alias("string"))


@query(f"""{_CAND} SELECT k, line_no, sab, tty, string FROM c QUALIFY row_number() OVER (PARTITION BY k ORDER BY CASE sab WHEN 'RXNORM' THEN 1 WHEN 'GS' THEN 5 WHEN 'ATC' THEN 8 ELSE 99 END, CASE tty WHEN 'IN' THEN 1 WHEN 'BN' THEN 12 ELSE 99 END,
(string <> upper(k))::INT, abs(length(string) - length(k)), length(string), line_no) = 1""")
def rank_top1(spark, d):
    return match.rank_best(_candidates(spark, d).withColumn("target", F.upper("k")), "k", "target").drop("target")


@query(f"{_CAND} SELECT k, line_no, tty FROM c QUALIFY line_no % 7 = min(line_no % 7) OVER (PARTITION BY k)")
def stage_first_hit(spark, d):
    return match.first_hit(_candidates(spark, d).withColumn("stage", F.col("line_no") % 7), "k", "stage").select("k", "line_no", "tty")


@query("""WITH r AS (SELECT DISTINCT 'p' || l_partkey AS a, 's' || l_suppkey AS b FROM lineitem), u AS (SELECT a, b FROM r UNION SELECT b, a FROM r), w AS (SELECT 'p' || p_partkey AS id FROM part),
k AS (SELECT 's' || s_suppkey AS id FROM supplier WHERE s_acctbal > 9000 UNION SELECT 'p' || p_partkey FROM part WHERE p_brand = 'Brand#11' AND p_size > 40)
SELECT DISTINCT u.a AS id, u.b AS target FROM u JOIN w ON u.a = w.id JOIN k ON u.b = k.id UNION
SELECT DISTINCT u.a, v.b FROM u JOIN w ON u.a = w.id JOIN u v ON u.b = v.a JOIN k ON v.b = k.id WHERE u.b NOT IN (SELECT id FROM k) AND u.a <> v.b""")
def two_hop_bridge(spark, d):
    lines, part, supplier = (_read(spark, d, t) for t in ("lineitem", "part", "supplier"))
    name = lambda p, c: F.concat(F.lit(p), F.col(c).cast("string"))
    rel = lines.select(name("p", "l_partkey").alias("a"), name("s", "l_suppkey").alias("b"))
    linked = supplier.where("s_acctbal > 9000").select(name("s", "s_suppkey").alias("id")).unionByName(part.where("p_brand = 'Brand#11' AND p_size > 40").select(name("p", "p_partkey").alias("id")))
    return match.bridge(rel, part.select(name("p", "p_partkey").alias("id")), linked)


@query("SELECT s_nationkey, coalesce(min(CASE WHEN s_acctbal > 5000 THEN s_suppkey END), min(s_suppkey)) AS s_suppkey FROM supplier GROUP BY s_nationkey")
def id_choice_min_preferred(spark, d):
    s = _read(spark, d, "supplier")
    return match.preferred_id(s.select("s_nationkey", "s_suppkey"), "s_nationkey", "s_suppkey", s.where("s_acctbal > 5000"))


@query("SELECT n_nationkey, n_name, CASE WHEN n_regionkey < 2 THEN lower(n_name) ELSE n_name END AS name_local FROM nation")
def label_update(spark, d):
    n = _read(spark, d, "nation")
    labels = n.where("n_regionkey < 2").select("n_nationkey", F.lower("n_name").alias("label"))
    return graph.labelled(n, "n_nationkey", labels, "label", F.col("n_name"), "name_local").select("n_nationkey", "n_name", "name_local")


@query(f"""{_CASCADE} SELECT count(*) AS terms, sum(p_partkey)::BIGINT AS rows, count(*) FILTER (map_source = 'PT_EXACT') AS terms_exact, sum(p_partkey) FILTER (map_source = 'PT_EXACT')::BIGINT AS rows_exact, count(*) FILTER (code <> '') AS terms_any, sum(p_partkey) FILTER (code <> '')::BIGINT AS rows_any,
round(terms_exact / terms, 6) AS terms_exact_ratio, round(rows_exact / rows, 6) AS rows_exact_ratio, round(terms_any / terms, 6) AS terms_any_ratio, round(rows_any / rows, 6) AS rows_any_ratio FROM m""")
def coverage_report(spark, d):
    return report.coverage(_cascaded(spark, d), F.col("p_partkey"), exact=F.col("map_source") == "PT_EXACT", any=F.col("code") != "")


@query("SELECT p_type, min(p_name) AS first_name, count(DISTINCT p_name) AS names, string_agg(DISTINCT p_brand, ',' ORDER BY p_brand) AS brands FROM part GROUP BY p_type")
def group_concat_distinct(spark, d):
    return _read(spark, d, "part").groupBy("p_type").agg(F.min("p_name").alias("first_name"), F.countDistinct("p_name").alias("names"), graph.joined_distinct(F.col("p_brand")).alias("brands"))


@query("SELECT event_type || '-' || user_id AS term, count(*) AS n FROM events GROUP BY term ORDER BY n DESC, term LIMIT 1000")
def unresolved_topk(spark, d):
    return _read(spark, d, "events").groupBy(F.concat("event_type", F.lit("-"), F.col("user_id").cast("string")).alias("term")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "term").limit(1000)


_NON_DRUG_TEXT = "trim(t, chr(32) || chr(9) || chr(10) || chr(13)) IN ('', '.', '?', '??') OR regexp_matches(upper(t), '\\b(" + "|".join(text.NOT_DRUGS) + ")\\b')"


@query(f"""SELECT doc_id, {_NON_DRUG_TEXT} AS non_drug FROM (
  SELECT doc_id, CASE WHEN doc_id % 5 = 3 THEN 'n/a ' ELSE '' END || coalesce(text, '') || CASE doc_id % 5 WHEN 1 THEN ' radiation therapy' WHEN 2 THEN ' unknowns' ELSE '' END AS t FROM documents)""")
def non_drug_flag(spark, d):
    i = F.col("doc_id") % 5
    whole = F.coalesce("text", F.lit(""))
    term = F.when(i == 1, F.concat(whole, F.lit(" radiation therapy"))).when(i == 2, F.concat(whole, F.lit(" unknowns"))).when(i == 3, F.concat(F.lit("n/a "), whole)).otherwise(whole)
    return _read(spark, d, "documents").select("doc_id", text.non_drug(term).alias("non_drug"))


@query("SELECT l_orderkey, l_linenumber FROM lineitem WHERE (l_returnflag = 'R' AND l_linestatus = 'F') OR (l_returnflag = 'A')")
def relation_filter(spark, d):
    rela = F.when((F.col("l_returnflag") == "R") & (F.col("l_linestatus") == "F"), "has_form").otherwise("isa")
    rel = F.when(F.col("l_returnflag") == "A", "RN").otherwise("RO")
    return _read(spark, d, "lineitem").where(match.relation_allowed(rela, rel)).select("l_orderkey", "l_linenumber")


def _ragged(spark, d):
    """Lines of four columns, some short, some overlong, some with blank cells behind, in one archive of six files."""
    i = F.col("o_orderkey")
    line = F.concat_ws("$", i.cast("string"), F.col("o_custkey").cast("string"))
    line = F.when(i % 4 == 0, line).when(i % 4 == 1, F.concat(line, F.lit("$tablet$x$y"))).when(i % 4 == 2, F.concat(line, F.lit("$tablet$x$$"))).otherwise(F.concat(line, F.lit("$ tablet $x")))
    rows = _read(spark, d, "orders").select(F.lit(2020).alias("year"), F.lit(1).alias("quarter"), F.concat(F.lit("z"), (i % 6).cast("string")).alias("zip"), F.lit("reac20q1.txt").alias("member"), i.alias("line_no"), line.alias("line"))
    heads = spark.range(6).select(F.lit(2020).alias("year"), F.lit(1).alias("quarter"), F.concat(F.lit("z"), F.col("id").cast("string")).alias("zip"), F.lit("reac20q1.txt").alias("member"), F.lit(-1).cast("bigint").alias("line_no"), F.lit("ISR$CASE$PT$drug_rec_act$").alias("line"))
    return ragged.parse(heads.unionByName(rows), "reac")


@query("""SELECT o_orderkey AS line_no, o_orderkey::VARCHAR AS primaryid, o_custkey::VARCHAR AS caseid, CASE WHEN o_orderkey % 4 = 0 THEN '' ELSE 'tablet' END AS pt, CASE o_orderkey % 4 WHEN 0 THEN '' WHEN 1 THEN 'x$y' ELSE 'x' END AS drug_rec_act FROM orders""")
def parse_ragged(spark, d):
    return _ragged(spark, d).select("line_no", "primaryid", "caseid", "pt", "drug_rec_act")


@query("SELECT 'z' || (o_orderkey % 6) AS zip, count(*) AS n, sum((o_orderkey % 4 = 0)::INT)::BIGINT AS padded, sum((o_orderkey % 4 = 1)::INT)::BIGINT AS folded FROM orders GROUP BY zip")
def parse_counters(spark, d):
    return _ragged(spark, d).groupBy("zip").agg(F.count("*").alias("n"), F.sum("padded").alias("padded"), F.sum("folded").alias("folded"))


@query("SELECT o_orderkey, ((row_number() OVER (ORDER BY o_totalprice DESC, o_orderkey) - 1) // 500)::BIGINT AS batch_id FROM orders")
def batch_ids(spark, d):
    o = _read(spark, d, "orders").select(F.struct((-F.col("o_totalprice")).alias("p"), "o_orderkey").alias("k"))
    return graph.surrogate(o, "k", "n").select(F.col("k.o_orderkey").alias("o_orderkey"), F.floor((F.col("n") - 1) / 500).alias("batch_id"))


def _reaction_map(spark, d):
    """Terms are part types; every third word list is a preferred name, others lower-level names, hints or nothing."""
    part = _read(spark, d, "part").select(F.upper("p_type").alias("t")).distinct().withColumn("n", F.length("t") % 4)
    code = F.concat(F.lit("C"), F.length("t").cast("string"), F.substring("t", 1, 2))
    preferred = part.where("n = 0").select(F.col("t").alias("name"), code.alias("code"))
    lower = part.where("n = 1").select(F.col("t").alias("name"), F.lit("C0").alias("code"))
    hints = part.where("n = 2").select(F.col("t").alias("term"), F.when(F.length("t") % 3 == 0, "C1").otherwise("C0").alias("code"))
    preferred = preferred.unionByName(spark.createDataFrame([("BASE", "C0")], "name string, code string"))
    return reactions.standardize(part.select(F.col("t").alias("pt_norm")), preferred, lower, hints)


_REACTION_MAP = """WITH t AS (SELECT DISTINCT upper(p_type) AS t, length(p_type) % 4 AS n, length(p_type) AS l FROM part), m AS (
  SELECT t AS pt_norm, CASE WHEN n = 2 THEN CASE WHEN l % 3 = 0 THEN 'C1' ELSE 'C0' END ELSE '' END AS hint,
    CASE WHEN n = 0 THEN 'C' || l || t[1:2] WHEN n = 1 OR n = 2 AND l % 3 <> 0 THEN 'C0' ELSE '' END AS code,
    CASE WHEN n = 0 THEN (SELECT min(x.t) FROM t x WHERE x.n = 0 AND x.l = y.l AND x.t[1:2] = y.t[1:2]) WHEN n = 1 OR n = 2 AND l % 3 <> 0 THEN 'BASE' ELSE '' END AS name,
    CASE WHEN n = 0 THEN 'PT_EXACT' WHEN n = 1 THEN 'LLT_TO_PT' WHEN n = 2 AND l % 3 <> 0 THEN 'MANUAL_CODE_HINT' WHEN n = 2 THEN 'MANUAL_HINT_CODE_UNRESOLVED' ELSE 'UNRESOLVED_WITH_MEDDRA' END AS map_source FROM t y)"""


@query(f"{_REACTION_MAP} SELECT * FROM m")
def reaction_standardize(spark, d):
    return _reaction_map(spark, d)


def _reaction_facts(spark, d):
    part = _read(spark, d, "part").select(F.col("p_partkey").alias("l_partkey"), F.upper("p_type").alias("pt_norm"))
    lines = _read(spark, d, "lineitem").select(F.col("l_orderkey").alias("primaryid"), F.col("l_orderkey").alias("caseid"), "l_partkey")
    return lines.join(part, "l_partkey").select("primaryid", "caseid", "pt_norm")


_REACTION_FACTS = "f AS (SELECT l_orderkey AS primaryid, l_orderkey AS caseid, upper(p_type) AS pt_norm FROM lineitem JOIN part ON p_partkey = l_partkey)"


@query(f"""{_REACTION_MAP}, {_REACTION_FACTS}, b AS (SELECT DISTINCT primaryid, caseid, code, name, map_source FROM f JOIN m USING (pt_norm) WHERE code <> '')
SELECT code AS pt_code, name AS pt_name, count(*) AS n_case_reaction_rows, count(DISTINCT primaryid) AS n_primaryid FROM b GROUP BY code, name""")
def reaction_code_counts(spark, d):
    return reactions.counts_by_code(_reaction_facts(spark, d), _reaction_map(spark, d))


@query(f"{_REACTION_MAP}, {_REACTION_FACTS} SELECT pt_norm, count(*) AS cnt FROM f JOIN m USING (pt_norm) WHERE code = '' GROUP BY pt_norm")
def reaction_unresolved(spark, d):
    return reactions.unresolved_counts(_reaction_facts(spark, d), _reaction_map(spark, d))


def _overrides(spark, d):
    """Terms without a code get the base code where their length is even, else a code that nothing names."""
    terms = _read(spark, d, "part").select(F.upper("p_type").alias("pt_norm")).distinct().where(F.length("pt_norm") % 4 >= 2)
    code = F.when(F.length("pt_norm") % 2 == 0, "C0").otherwise("C9")
    return terms.select("pt_norm", code.alias("code"), F.lit("manual").alias("reason"), F.lit(1).cast("bigint").alias("line_no"))


_OVERRIDDEN = _REACTION_MAP + """, o AS (SELECT pt_norm, CASE WHEN length(pt_norm) % 4 = 2 AND EXISTS (SELECT 1 FROM m WHERE code = 'C0') THEN 'C0' END AS oc FROM m),
n AS (SELECT pt_norm, hint, coalesce(oc, code) AS code, CASE WHEN oc IS NULL THEN name ELSE 'BASE' END AS name, CASE WHEN oc IS NULL THEN map_source ELSE 'MANUAL_TERM_OVERRIDE' END AS map_source FROM m JOIN o USING (pt_norm))"""


@query(f"{_OVERRIDDEN} SELECT * FROM n")
def reaction_overrides(spark, d):
    none = spark.createDataFrame([], "code string, name string")
    return reactions.overridden(_reaction_map(spark, d), _overrides(spark, d), none)["term_map"]


@query(f"""{_OVERRIDDEN}, {_REACTION_FACTS}, b AS (SELECT DISTINCT primaryid, caseid, code AS pt_code, name AS pt_name, map_source FROM f JOIN m USING (pt_norm) WHERE code <> ''),
a AS (SELECT DISTINCT primaryid, caseid, code AS pt_code, name AS pt_name, map_source FROM f JOIN n USING (pt_norm) WHERE code <> '' AND length(pt_norm) % 4 >= 2)
SELECT map_source, count(*) AS n FROM (SELECT * FROM a UNION SELECT * FROM b) GROUP BY map_source""")
def reaction_refresh(spark, d):
    facts, before, overrides = _reaction_facts(spark, d), _reaction_map(spark, d), _overrides(spark, d)
    after = reactions.overridden(before, overrides, spark.createDataFrame([], "code string, name string"))["term_map"]
    return reactions.facts_after(facts, before, after, overrides).groupBy("map_source").agg(F.count("*").alias("n"))


@query(f"""{_REACTION_MAP}, {_REACTION_FACTS} SELECT count(*) FILTER (code = '') AS unmapped_terms, (SELECT count(*) FROM f JOIN m USING (pt_norm) WHERE code <> '') AS mapped_rows FROM m""")
def reaction_map_metrics(spark, d):
    return reactions.map_metrics(_reaction_facts(spark, d), _reaction_map(spark, d))


def _soc_edges(spark, d):
    """Edges to nations under their own name (suppliers) and in lower case (customers); the hierarchy is the regions'."""
    n = _read(spark, d, "nation")
    key = F.col("n_nationkey").cast("string")
    s = _read(spark, d, "supplier").join(n, F.col("s_nationkey") == F.col("n_nationkey")).select(key.alias("pt_code"), F.col("n_name").alias("pt_name"))
    c = _read(spark, d, "customer").join(n, F.col("c_nationkey") == F.col("n_nationkey")).select(key.alias("pt_code"), F.lower("n_name").alias("pt_name"))
    tree = n.join(_read(spark, d, "region").where("r_name <> 'ASIA'"), F.col("n_regionkey") == F.col("r_regionkey"))
    tree = tree.select(key.alias("pt_code"), F.col("r_regionkey").cast("string").alias("soc_code_primary"), F.col("r_name").alias("soc_name_primary"))
    return [s, c], tree


_NODES = """WITH e AS (SELECT s_nationkey AS k, n_name AS nm FROM supplier JOIN nation ON n_nationkey = s_nationkey UNION SELECT c_nationkey, lower(n_name) FROM customer JOIN nation ON n_nationkey = c_nationkey),
p AS (SELECT k::VARCHAR AS pt_code, min(nm) AS pt_name FROM e GROUP BY k),
h AS (SELECT n_nationkey::VARCHAR AS pt_code, r_regionkey::VARCHAR AS soc_code_primary, r_name AS soc_name_primary FROM nation JOIN region ON n_regionkey = r_regionkey WHERE r_name <> 'ASIA')"""


@query(f"""{_NODES} SELECT 'pt' AS kind, pt_code AS code, pt_name AS name FROM p UNION ALL SELECT 'edge', pt_code, soc_name_primary FROM h WHERE pt_code IN (SELECT pt_code FROM p)
UNION ALL SELECT DISTINCT 'soc', soc_code_primary, soc_name_primary FROM h WHERE pt_code IN (SELECT pt_code FROM p)""")
def node_repair(spark, d):
    t = graph.repaired_nodes(*_soc_edges(spark, d))
    tagged = lambda kind, df, code, name: df.select(F.lit(kind).alias("kind"), F.col(code).alias("code"), F.col(name).alias("name"))
    return tagged("pt", t["node_pt"], "pt_code", "pt_name").unionByName(tagged("edge", t["edge_pt_soc_primary"], "pt_code", "soc_name_primary")).unionByName(tagged("soc", t["node_soc"], "soc_code", "soc_name"))


@query(f"""{_NODES} SELECT p.pt_code, CASE WHEN p.pt_code::INT % 2 = 0 THEN 'EN' || p.pt_code ELSE pt_name END AS pt_name_en, CASE WHEN p.pt_code::INT % 2 = 0 THEN 'ZH' || p.pt_code ELSE '' END AS pt_name_zh, soc_code_primary,
CASE WHEN soc_code_primary::INT % 2 = 0 THEN 'EN' || soc_code_primary ELSE '' END AS soc_name_en, CASE WHEN soc_code_primary::INT % 2 = 0 THEN 'ZH' || soc_code_primary ELSE '' END AS soc_name_zh,
(p.pt_code::INT IN (SELECT s_nationkey FROM supplier WHERE s_acctbal > 9000))::INT AS in_rich FROM p LEFT JOIN h USING (pt_code)""")
def reference_reactions(spark, d):
    edges, tree = _soc_edges(spark, d)
    t = graph.repaired_nodes(edges, tree)
    codes = spark.range(0, 25, 2).select(F.col("id").cast("string").alias("code"))
    label = lambda lang: codes.select("code", F.concat(F.lit(lang), "code").alias("label"))
    rich = _read(spark, d, "supplier").where("s_acctbal > 9000").select(F.col("s_nationkey").cast("string").alias("pt_code"))
    return graph.reference_reactions(t["node_pt"], t["edge_pt_soc_primary"], (label("EN"), label("ZH")), (label("EN"), label("ZH")), {"in_rich": rich})


def _structured_terms(spark, d):
    """Terms are parts, ids their brands, structures their types; terms of size 7 are excluded."""
    stage = F.when(F.col("p_size") == 7, "MANUAL_EXCLUDE").otherwise("EXACT")
    return _read(spark, d, "part").select(F.col("p_partkey").cast("string").alias("term_std"), F.col("p_brand").alias("id"), F.lower("p_brand").alias("id_name"), F.col("p_type").alias("structure"), stage.alias("mapping_stage"))


def _normalized(spark, d):
    s = structures.distinct_structures(_structured_terms(spark, d))
    n, raw = F.length("inchi_raw"), F.col("inchi_raw")
    table = s.where(n % 5 != 0).select("inchi_raw", F.when(n % 7 == 0, "EMPTY_PARENT").otherwise("OK").alias("status"), F.concat(F.lit("K"), F.substring(raw, 1, 3)).alias("inchikey"), F.upper(raw).alias("inchi_std"), F.lower(raw).alias("smiles_std"), F.lit(1).cast("bigint").alias("n_frag_before"), F.lit(1).cast("bigint").alias("n_frag_after"), F.lit("ok").alias("note"))
    return structures.by_table(s, table)


@query("SELECT CASE WHEN length(t) % 5 = 0 THEN 'PARSE_FAIL' WHEN length(t) % 7 = 0 THEN 'EMPTY_PARENT' ELSE 'OK' END AS status, count(*) AS n FROM (SELECT DISTINCT p_type AS t FROM part WHERE p_size <> 7) GROUP BY 1")
def structure_status(spark, d):
    return structures.status_counts(_normalized(spark, d))


@query("""SELECT 'K' || p_type[1:3] AS inchikey, min(upper(p_type)) AS inchi_std, min(lower(p_type)) AS smiles_std, count(DISTINCT p_partkey) AS term_count, count(DISTINCT p_brand) AS dbid_count,
string_agg(DISTINCT p_brand, ',' ORDER BY p_brand) AS dbid_list, string_agg(DISTINCT lower(p_brand), ',' ORDER BY lower(p_brand)) AS drugbank_name_list
FROM part WHERE p_size <> 7 AND length(p_type) % 5 <> 0 AND length(p_type) % 7 <> 0 GROUP BY 1""")
def structure_meta(spark, d):
    return structures.structure_meta(structures.term_structures(_structured_terms(spark, d), _normalized(spark, d)))


@query("SELECT p_type AS inchi, min(p_brand) AS dbid, min(lower(p_brand)) AS drugbank_name, count(DISTINCT p_partkey) AS term_count, count(DISTINCT p_brand) AS dbid_count FROM part GROUP BY p_type")
def raw_structure_meta(spark, d):
    return structures.raw_structure_meta(_structured_terms(spark, d))


@query("""SELECT l_returnflag AS role, count(*) AS n FROM (SELECT DISTINCT l_orderkey, l_returnflag, 'K' || p_type[1:3] FROM lineitem JOIN part ON l_partkey = p_partkey
WHERE l_returnflag IN ('R', 'A') AND p_size <> 7 AND length(p_type) % 5 <> 0 AND length(p_type) % 7 <> 0) GROUP BY l_returnflag""")
def report_compound_roles(spark, d):
    drugs = _read(spark, d, "lineitem").select(F.col("l_orderkey").alias("primaryid"), F.col("l_orderkey").alias("caseid"), F.lower("l_returnflag").alias("role_cod"), F.col("l_partkey").cast("string").alias("drug_key_std"))
    mapped = structures.term_structures(_structured_terms(spark, d), _normalized(spark, d))
    return structures.report_compounds(drugs, mapped, ("R", "A")).groupBy("role").agg(F.count("*").alias("n"))
