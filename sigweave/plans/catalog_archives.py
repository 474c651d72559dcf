"""Queries of the way from archives, each with SQL for an oracle.

Tasks write report archives with members of all kinds from orders and their lines, one archive a quarter; the data source reads them back. Order = a version
of a report (three orders a report), customer = case. Headers are old ones before 2004; rows are short, overlong, quoted or without ids.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text
from ..operators import cases
from ..sources import archive_source, ragged, release_sink
from ..streaming import late
from .catalog import _read, query
from .store import shared_folder

LOST = {(2003, 2): "ZZ9$"}
_HEADS = {
    "demo": ("ISR$CASE$FOLL_SEQ$I_F_COD$FDA_DT$EVENT_DT$GNDR_COD$AGE$REPORTER_COUNTRY$ ", "primaryid$caseid$caseversion$i_f_code$sex$fda_dt$event_dt$age$reporter_country"),
    "drug": ("ISR$CASE$DRUG_SEQ$ROLE_COD$DRUGNAME$PROD_AI$$", "primaryid$caseid$drug_seq$role_cod$drugname$prod_ai$$"),
    "reac": ("ISR$CASE$PT$ ", "primaryid$caseid$pt$drug_rec_act"),
}

_ORDERS = """
base AS (
  SELECT o_orderkey AS k, (2001 + o_orderkey % 7)::INT AS year, (o_custkey % 4 + 1)::INT AS quarter, (o_orderkey // 3)::VARCHAR AS report, (o_custkey % 500)::VARCHAR AS customer,
    CASE WHEN o_orderkey % 13 = 0 THEN '' ELSE (o_orderkey // 3)::VARCHAR END AS p, CASE WHEN o_orderkey % 17 = 0 THEN '' ELSE (o_custkey % 500)::VARCHAR END AS c, o_orderstatus, o_orderdate FROM orders
), named AS (SELECT *, 'faers_ascii_' || year || 'q' || quarter || '.zip' AS zip FROM base)
"""
_DEMO_ROWS = f"""{_ORDERS}, rows AS (
  SELECT year, quarter, zip, row_number() OVER (PARTITION BY year, quarter ORDER BY k) AS line_no, (k % 11 = 2)::INT * 2 AS trimmed, (k % 11 = 0)::INT AS padded, (k % 11 = 1)::INT AS folded,
    CASE WHEN p = '' THEN c ELSE p END AS primaryid, CASE WHEN c = '' THEN p ELSE c END AS caseid, CASE k % 5 WHEN 0 THEN '12A' WHEN 1 THEN '9' WHEN 2 THEN '10' WHEN 3 THEN '' ELSE 'x1' END AS caseversion,
    CASE o_orderstatus WHEN 'F' THEN 'f' WHEN 'O' THEN 'I' ELSE '' END AS i_f_code, CASE k % 5 WHEN 0 THEN strftime(o_orderdate, '%Y%m') WHEN 1 THEN '99999999' ELSE strftime(o_orderdate, '%Y%m%d') END AS fda_dt,
    CASE WHEN k % 2 = 0 THEN strftime(o_orderdate, '%Y%m%d') ELSE '' END AS event_dt, CASE WHEN k % 7 = 0 THEN 'M$F' ELSE 'M' END AS sex, CASE k % 11 WHEN 0 THEN '' WHEN 1 THEN 'US$X$Y' ELSE 'US' END AS reporter_country
  FROM named
), demo AS (SELECT * FROM rows WHERE primaryid <> '')
"""
_SELECTED = f"""{_DEMO_ROWS}, dead AS (
  SELECT report AS id FROM base WHERE k % 101 = 0 UNION SELECT customer FROM base WHERE k % 103 = 0
), scored AS (
  SELECT *, year * 10 + quarter AS q, CASE WHEN regexp_matches(caseversion, '^[0-9][0-9]') THEN regexp_extract(caseversion, '^([0-9]+)', 1)::BIGINT ELSE 0 END AS v, CASE WHEN length(primaryid) > 1 THEN primaryid::BIGINT ELSE 0 END AS pn,
    CASE WHEN length(fda_dt) = 8 THEN fda_dt::BIGINT ELSE 0 END AS fd, CASE WHEN length(event_dt) = 8 THEN event_dt::BIGINT ELSE 0 END AS ed, CASE i_f_code WHEN 'f' THEN 2 WHEN 'I' THEN 1 ELSE 0 END AS r
  FROM demo WHERE primaryid NOT IN (SELECT id FROM dead) AND caseid NOT IN (SELECT id FROM dead)
), one AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY primaryid ORDER BY q DESC, fd DESC, r DESC, ed DESC, v DESC, pn DESC, year DESC, quarter DESC, line_no DESC) = 1
), selected AS (SELECT * FROM one QUALIFY row_number() OVER (PARTITION BY caseid ORDER BY v DESC, fd DESC, r DESC, ed DESC, q DESC, pn DESC, year DESC, quarter DESC, line_no DESC) = 1)
"""
_LINES = """
lines AS (
  SELECT n.*, l_linenumber, l_returnflag, l_partkey, p_name, row_number() OVER (PARTITION BY year, quarter ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice) AS rn
  FROM lineitem JOIN named n ON l_orderkey = n.k JOIN part ON l_partkey = p_partkey
)
"""


def _orders(spark, d):
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    report, customer = (k / 3).cast("bigint").cast("string"), (c % 500).cast("string")
    return _read(spark, d, "orders").select(
        k.alias("k"), (F.lit(2001) + k % 7).cast("int").alias("year"), (c % 4 + 1).cast("int").alias("quarter"), report.alias("report"), customer.alias("customer"), F.when(k % 13 == 0, "").otherwise(report).alias("p"),
        F.when(k % 17 == 0, "").otherwise(customer).alias("c"), "o_orderstatus", "o_orderdate",
    )


def _place(*columns):
    """Order of the lines of a member: by columns, or before all others."""
    kinds = ("bigint", "bigint", "bigint", "bigint", "double")
    parts = [F.col(c) for c in columns] or [F.lit(-1)]
    return F.struct(*(p.cast(kind).alias(f"o{i}") for i, (p, kind) in enumerate(zip([*parts, *[F.lit(0)] * 4][:5], kinds, strict=True)))).alias("line_no")


def _cells(*parts):
    return F.concat_ws("$", *parts)


def _demo_lines(spark, d):
    o, k = _orders(spark, d), F.col("k")
    day = lambda f: F.date_format("o_orderdate", f)
    version = F.when(k % 5 == 0, "12A").when(k % 5 == 1, "9").when(k % 5 == 2, " 10").when(k % 5 == 3, "").otherwise("x1")
    follow = F.when(F.col("o_orderstatus") == "F", " f").when(F.col("o_orderstatus") == "O", "I").otherwise("")
    fda = F.when(k % 5 == 0, day("yyyyMM")).when(k % 5 == 1, "99999999").otherwise(day("yyyyMMdd"))
    event, sex = F.when(k % 2 == 0, day("yyyyMMdd")).otherwise(""), F.when(k % 7 == 0, '"M$F"').otherwise("M")
    tail = F.when(k % 11 == 0, "").when(k % 11 == 1, "$US$X$Y").when(k % 11 == 2, "$US$$").otherwise("$US")
    line = F.when(F.col("year") < 2004, _cells("p", "c", version, follow, fda, event, sex, F.lit("40"))).otherwise(_cells("p", "c", version, follow, sex, fda, event, F.lit("40")))
    return o.select("year", "quarter", F.lit("demo").alias("kind"), _place("k"), F.concat(line, tail).alias("line"))


def _delete_lines(spark, d):
    o, k = _orders(spark, d), F.col("k")
    made = F.when(k % 101 == 0, F.concat("report", F.lit("$x"))).when(k % 103 == 0, F.concat(F.lit(" "), "customer")).otherwise("none")
    both = o.where((k % 101 == 0) | (k % 103 == 0) | (k % 107 == 0)).select("year", "quarter", F.lit("delete").alias("kind"), _place("k"), made.alias("line"))
    return both.unionByName(o.where((k % 101 == 0) & (k % 103 == 0)).select("year", "quarter", F.lit("delete").alias("kind"), _place("k"), F.col("customer").alias("line")))


def _order_lines(spark, d):
    rows = _read(spark, d, "lineitem").join(_orders(spark, d), F.col("l_orderkey") == F.col("k"))
    rows = rows.join(_read(spark, d, "part").select("p_partkey", "p_name"), F.col("l_partkey") == F.col("p_partkey"))
    return rows.withColumn("line_no", _place("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"))


def _drug_line():
    n = F.col("l_partkey") % 6
    name = F.when(n == 3, F.concat(F.lit('"'), "p_name")).otherwise(F.col("p_name"))
    tail = F.when(n == 0, "$AI$$").when(n == 1, "").when(n == 2, "$AI$EXTRA").otherwise("$AI")
    line = F.concat(_cells("p", "c", F.col("l_linenumber").cast("string"), F.lower("l_returnflag"), name), tail)
    return F.when((F.col("year") == 2003) & (F.col("quarter") == 2), F.concat(line, F.lit("ZZ9$7$1$PS$lost$x"))).otherwise(line)


def _reaction_line():
    cells = _cells("p", "c", F.split("p_name", " ")[1])
    return F.when(F.col("year") < 2004, cells).otherwise(_cells(cells, F.lower("l_returnflag")))


def _written(spark, d, *kinds):
    """The root of archives with members of these kinds, each with its header but for lists of deleted ids."""
    made, parts = {"drug": _drug_line(), "reac": _reaction_line()}, []
    if "demo" in kinds:
        parts.append(_demo_lines(spark, d))
    if "delete" in kinds:
        parts.append(_delete_lines(spark, d))
    if some := [k for k in kinds if k in made]:  # of one row two lines, so that orders and parts are looked up once
        both = F.explode(F.array(*(F.struct(F.lit(k).alias("kind"), made[k].alias("line")) for k in some))).alias("of")
        parts.append(_order_lines(spark, d).select("year", "quarter", "line_no", both).select("year", "quarter", "of.kind", "line_no", "of.line"))
    heads = [F.struct(F.lit(k).alias("kind"), F.when(F.col("year") < 2004, _HEADS[k][0]).otherwise(_HEADS[k][1]).alias("line")) for k in kinds if k in _HEADS]
    quarters = _orders(spark, d).select("year", "quarter").distinct()
    parts.append(quarters.select("year", "quarter", F.explode(F.array(*heads)).alias("of")).select("year", "quarter", "of.kind", _place(), "of.line"))
    root = f"{shared_folder(spark)}/sigweave-archives-{uuid.uuid4().hex}"
    archive_source.write_archives(reduce(DataFrame.unionByName, parts), root).agg(F.count("*")).collect()
    return root


@query(f"WITH {_DEMO_ROWS} SELECT year, quarter, zip, line_no, trimmed, padded, folded, primaryid, caseid, caseversion, i_f_code, fda_dt, event_dt, sex, reporter_country FROM demo")
def archive_rows(spark, d):
    rows = ragged.parse(archive_source.lines(spark, _written(spark, d, "demo"), "demo"), "demo", quoted=True)
    return rows.select("year", "quarter", "zip", "line_no", "trimmed", "padded", "folded", "primaryid", "caseid", "caseversion", "i_f_code", "fda_dt", "event_dt", "sex", "reporter_country")


@query(f"""WITH {_ORDERS}, {_LINES}, one AS (
  SELECT year, quarter, zip, CASE WHEN year = 2003 AND quarter = 2 THEN 2 * rn - 1 ELSE rn END AS line_no, (l_partkey % 6 = 0)::INT * 2 AS trimmed, (l_partkey % 6 = 1)::INT AS padded, (l_partkey % 6 = 2)::INT AS folded, p AS primaryid, c AS caseid,
    l_linenumber::VARCHAR AS drug_seq, lower(l_returnflag) AS role_cod, CASE WHEN l_partkey % 6 = 3 THEN '"' ELSE '' END || p_name AS drugname, CASE l_partkey % 6 WHEN 1 THEN '' WHEN 2 THEN 'AI$EXTRA' ELSE 'AI' END AS prod_ai FROM lines
) SELECT * FROM one UNION ALL SELECT year, quarter, zip, 2 * rn, 0, 0, 0, 'ZZ9', '7', '1', 'PS', 'lost', 'x' FROM lines WHERE year = 2003 AND quarter = 2""")
def archive_drug_rows(spark, d):
    rows = ragged.parse(archive_source.lines(spark, _written(spark, d, "drug"), "drug", LOST), "drug")
    return rows.select("year", "quarter", "zip", "line_no", "trimmed", "padded", "folded", "primaryid", "caseid", "drug_seq", "role_cod", "drugname", "prod_ai")


_CASE_SQL = "SELECT caseid, primaryid, caseversion, i_f_code, fda_dt, event_dt, year, quarter, zip AS zip_name, sex, reporter_country FROM selected"
_CASE_COLUMNS = [c for c in cases.CASE_COLUMNS if c != "age"]


@query(f"WITH {_SELECTED} {_CASE_SQL}")
def archive_cases(spark, d):
    return cases.cases_from_archives(spark, _written(spark, d, "demo", "delete")).select(*_CASE_COLUMNS)


@query("WITH dead AS (SELECT (o_orderkey // 3)::VARCHAR AS id FROM orders WHERE o_orderkey % 101 = 0 UNION SELECT (o_custkey % 500)::VARCHAR FROM orders WHERE o_orderkey % 103 = 0) SELECT id FROM dead")
def archive_deleted_ids(spark, d):
    return ragged.deleted_ids(archive_source.lines(spark, _written(spark, d, "demo", "delete"), "delete"))


@query(f"""WITH {_SELECTED}, {_LINES}, f AS (
  SELECT l.year, l.quarter, l.zip AS zip_name, s.primaryid, s.caseid, split_part(p_name, ' ', 2) AS pt_raw, upper(split_part(p_name, ' ', 2)) AS pt_norm, CASE WHEN l.year < 2004 THEN '' ELSE l_returnflag END AS drug_rec_act_std, rn
  FROM lines l JOIN selected s ON l.year = s.year AND l.quarter = s.quarter AND l.p = s.primaryid WHERE l.p <> ''
) SELECT year, quarter, zip_name, primaryid, caseid, pt_raw, pt_norm, drug_rec_act_std FROM f QUALIFY row_number() OVER (PARTITION BY primaryid, pt_norm ORDER BY rn) = 1""")
def reaction_facts(spark, d):
    root = _written(spark, d, "demo", "delete", "reac")
    rows = ragged.parse(archive_source.lines(spark, root, "reac"), "reac")
    got = cases.reaction_facts(rows, cases.cases_from_archives(spark, root), text.normalize_reaction(F.col("pt")))
    return got.select("year", "quarter", "zip_name", "primaryid", "caseid", "pt_raw", "pt_norm", "drug_rec_act_std")


def _folder(spark, name):
    return f"{shared_folder(spark)}/sigweave-{name}-{uuid.uuid4().hex}"


@query(f"WITH {_SELECTED} {_CASE_SQL}")
def late_cases(spark, d):
    """The same cases from a stream of archives with keyed state."""
    root = _written(spark, d, "demo", "delete")
    return late.cases_available(spark, root, _folder(spark, "cases"), _folder(spark, "ledger")).select(*_CASE_COLUMNS)


@query(f"""WITH {_SELECTED}, {_LINES}, f AS (SELECT DISTINCT s.primaryid, split_part(p_name, ' ', 1) AS compound FROM lines l JOIN selected s ON l.year = s.year AND l.quarter = s.quarter AND l.p = s.primaryid),
g AS (SELECT DISTINCT s.primaryid, split_part(p_name, ' ', 2) AS outcome FROM lines l JOIN selected s ON l.year = s.year AND l.quarter = s.quarter AND l.p = s.primaryid)
SELECT compound, outcome, count(*) AS n_reports FROM f JOIN g USING (primaryid) GROUP BY ALL""")
def late_pair_weights(spark, d):
    """Weights of pairs, to which each batch's changes of cases are added."""
    root, pairs = _written(spark, d, "demo", "delete", "drug", "reac"), _folder(spark, "pairs")
    word = lambda c: F.regexp_replace(F.split(c, " ")[0], '"', "")

    def also(changes, batch_id):
        compounds = ragged.parse(archive_source.lines(spark, root, "drug", LOST), "drug").withColumn("compound", word("drugname"))
        outcomes = ragged.parse(archive_source.lines(spark, root, "reac"), "reac").withColumn("outcome", F.col("pt"))
        late.add_changes(spark, pairs, batch_id, late.pair_deltas(changes, compounds, outcomes), ["compound", "outcome"], "n_reports")

    late.cases_available(spark, root, _folder(spark, "cases"), _folder(spark, "ledger"), also=also)
    return late.current(spark, pairs)


@query("""WITH e AS (SELECT DISTINCT l_orderkey AS report, p_brand AS compound, l_suppkey % 30 AS outcome FROM lineitem JOIN part ON l_partkey = p_partkey)
SELECT 'v1' AS release, 'pairs' AS table_name, (SELECT count(*) FROM (SELECT DISTINCT compound, outcome FROM e)) AS rows, true AS same_again, true AS verified
UNION ALL SELECT 'v1', 'reports', (SELECT count(DISTINCT report) FROM e), true, true""")
def release_index(spark, d):
    """Two tables released twice: the index, whether both releases have the same digests, and whether what is stored has them."""
    root, e = _folder(spark, "release"), _read(spark, d, "lineitem").join(_read(spark, d, "part"), F.col("l_partkey") == F.col("p_partkey"))
    pairs = e.select(F.col("p_brand").alias("compound"), (F.col("l_suppkey") % 30).alias("outcome")).distinct()
    reports = e.groupBy(F.col("l_orderkey").alias("report")).agg(F.countDistinct("p_brand").alias("compounds"))
    for release in ("v1", "v2"):
        for name, table in (("pairs", pairs), ("reports", reports)):
            release_sink.write_table(table.repartition(4, F.col(table.columns[0])).sortWithinPartitions(*table.columns), root, release, name)
    found = release_sink.releases(spark, root).withColumnRenamed("table", "table_name")
    again = found.where("release = 'v2'").select("table_name", F.col("digest").alias("other"))
    checked = release_sink.verified(spark, root, "v1").groupBy(F.col("table").alias("table_name")).agg(F.every("ok").alias("verified"))
    return found.where("release = 'v1'").join(again, "table_name").join(checked, "table_name").select("release", "table_name", "rows", (F.col("digest") == F.col("other")).alias("same_again"), "verified")
