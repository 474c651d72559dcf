import zipfile

import pytest
from pyspark.sql import functions as F

from sigweave.operators import dedup, graph, match, report
from sigweave.plans import catalog, stages
from sigweave.sources import ragged, vocab
from sigweave.streaming import incremental

DEMO = "year int, quarter int, primaryid string, caseid string, caseversion string, i_f_code string, fda_dt string, event_dt string, ingest_ordinal bigint"


def one(spark, f, *values):
    df = spark.createDataFrame([(i, x) for i, x in enumerate(values)], "i int, s string")
    return [r[1] for r in sorted(df.select("i", f(F.col("s"))).collect())]


def test_scores(spark):
    assert one(spark, dedup.digit_score, "1", "9", "10", "12A", "", None, "9" * 30) == [0, 0, 10, 12, 0, 0, (1 << 63) - 1]
    assert one(spark, lambda c: dedup.digit_score(c, "numeric"), "1", "12A", "A") == [1, 12, 0]
    assert one(spark, dedup.date_score, "20240101", "202401", "99999999", None) == [20240101, 0, 99999999, 0]
    assert one(spark, dedup.followup_rank, "F", " i", "x", None) == [2, 1, 0, 0]


def demo(spark):
    rows = [
        (2020, 1, "1001", "10", "11", "I", "20200101", "", 1), (2020, 2, "1001", "10", "11", "F", "20200101", "", 2), (2020, 3, "1002", "10", "12", "I", "20200301", "", 3),
        (2020, 1, "2001", "20", "10", "I", "20200101", "", 4), (2020, 1, "3001", "30", "10", "I", "20200101", "", 5), (2020, 1, "3001", "30", "10", "I", "20200101", "", 6), (2020, 1, " ", "40", "", "", "", "", 7),
    ]
    return spark.createDataFrame(rows, DEMO)


def test_latest_cases_and_tombstones(spark):
    dead = spark.createDataFrame([("20",)], "id string")
    got = {r.caseid: (r.primaryid, r.ingest_ordinal) for r in dedup.latest_cases(demo(spark), dead).collect()}
    assert got == {"10": ("1002", 3), "30": ("3001", 6)}
    dead = spark.createDataFrame([("1002",), ("3001",)], "id string")
    assert {r.caseid: r.primaryid for r in dedup.latest_cases(demo(spark), dead).collect()} == {"10": "1001", "20": "2001"}


def test_refresh_is_a_full_run(spark):
    rows, none = demo(spark), spark.createDataFrame([], "id string")
    old, new, dead = rows.where("ingest_ordinal <> 3"), rows.where("ingest_ordinal = 3"), spark.createDataFrame([("3001",)], "id string")
    first = dedup.latest_cases(old, none)
    key = lambda df: sorted(map(tuple, df.select("caseid", "primaryid", "ingest_ordinal").collect()))
    assert key(incremental.refreshed_cases(first, old, new, none)) == key(dedup.latest_cases(rows, none))
    assert key(incremental.refreshed_cases(first, old, new, dead)) == key(dedup.latest_cases(rows, dead))


def test_stream_takes_each_file_once(spark, tmp_path):
    src, out, mark = (str(tmp_path / x) for x in ("in", "out", "mark"))
    for k in range(2):
        spark.range(k * 10, k * 10 + 5).write.mode("append").parquet(src)
        for _ in range(2):
            incremental.ingest_available(spark, src, "id bigint", out, mark)
        assert spark.read.parquet(out).count() == 5 * (k + 1)
    a = spark.createDataFrame([("x", 2)], "k string, n bigint")
    assert incremental.merged_counts(a, a.union(spark.createDataFrame([("y", 1)], "k string, n bigint")), ["k"], "n").orderBy("k").collect() == [("x", 4), ("y", 1)]


def test_archives(spark, tmp_path):
    drug = "ISR$CASE$DRUG_SEQ$ROLE_COD$DRUGNAME$$\n1$2$1$PS$A\x85B$c\n3$4$2$SS$x$y$z\n5$6$1$PS$q$$$\n"
    with zipfile.ZipFile(tmp_path / "AERS_ascii_2012Q3.zip", "w") as z:
        z.writestr("ascii/DEMO12Q3.txt", 'ISR$CASE$FOLL_SEQ$I_F_COD$FDA_DT$EVENT_DT$GNDR_COD\n1$2$10$F$"2012$0101"$x$M$extra\n$9$$$\n$$\n'.encode("latin-1"))
        z.writestr("ascii/DRUG12Q3.txt", drug.encode("latin-1"))
        z.writestr("ascii/DELETE12Q3.txt", b"77$x\nabc\n")
    with zipfile.ZipFile(tmp_path / "faers_ascii_2019q1.zip", "w") as z:
        z.writestr("deleted/DELETE19Q1.txt", b"99\n")
    (tmp_path / "other.zip").write_bytes(b"no")
    root = str(tmp_path)
    d = sorted(ragged.parse(ragged.archive_lines(spark, root, "demo"), "demo", quoted=True).select("primaryid", "caseid", "fda_dt", "sex", "age", "padded", "folded").collect())
    assert d == [("1", "2", "2012$0101", "M$extra", "", 0, 1), ("9", "9", "", "", "", 1, 0)]
    rows = sorted(ragged.parse(ragged.archive_lines(spark, root, "drug"), "drug").select("line_no", "primaryid", "role_cod", "drugname", "padded", "folded").collect())
    assert rows == [(1, "1", "PS", "A", 0, 0), (2, "B", "", "", 1, 0), (3, "3", "SS", "x$y$z", 0, 1), (4, "5", "PS", "q", 0, 0)]
    assert ragged.deleted_ids(ragged.archive_lines(spark, root, "delete")).collect() == [("77",)]
    fixed = ragged.archive_lines(spark, root, "drug", {(2012, 3): "3$4"}).count()
    assert fixed == 5


def test_vocabularies(spark, tmp_path):
    line = lambda **k: "|".join(str(k.get(f"f{i}", "")) for i in range(18))
    (tmp_path / "c.rrf").write_text("\n".join([line(f0=1, f1="ENG", f11="RXNORM", f12="IN", f13="1", f14="Aspirin", f16="N"), line(f0=1, f1="FRE", f11="DRUGBANK", f13="DB1", f14="x", f16="O"), "short"]))
    assert vocab.concepts(spark, f"{tmp_path}/c.rrf").select("rxcui", "string").collect() == [("1", "Aspirin")]
    assert vocab.concept_links(spark, f"{tmp_path}/c.rrf").collect() == [("1", "DB1")]
    (tmp_path / "r.rrf").write_text("\n".join([line(f0=1, f3="RN", f4=2, f14="N"), line(f0=1, f3="RO", f4=3, f7="has_form"), line(f0=1, f3="RO", f4=4, f7="isa"), line(f0=1, f3="RB", f4=5, f14="O")]))
    assert sorted(vocab.relations(spark, f"{tmp_path}/r.rrf").collect()) == [("1", "2"), ("1", "3")]
    (tmp_path / "pt.asc").write_bytes("1$é\n2$b\n1$z\n".encode("latin-1"))
    assert sorted(vocab.mapping(spark, f"{tmp_path}/pt.asc", 0, 1).collect()) == [("1", "é"), ("2", "b")]
    assert sorted(vocab.mapping(spark, f"{tmp_path}/pt.asc", 0, 1, "last").collect()) == [("1", "z"), ("2", "b")]
    (tmp_path / "k.csv").write_text("term_std,action,target_term,note\nA,map_to_term,B,\nA,EXCLUDE_NON_DRUG,,\nC,other,,\n")
    assert [(r.term_std, r.action) for r in vocab.correction_list(spark, f"{tmp_path}/k.csv").collect()] == [("A", "EXCLUDE_NON_DRUG")]


def test_weights_by_mode(spark):
    left = spark.createDataFrame([(1, "c"), (1, "c")], "report int, compound string")
    right = spark.createDataFrame([(1, "p", "PT_EXACT"), (1, "p", "LLT_TO_PT")], "report int, outcome string, via string")
    assert graph.pair_counts(left, right, "report", ["compound"], ["outcome"]).collect() == [("c", "p", 2)]
    assert graph.pair_counts(left, right, "report", ["compound"], ["outcome"], mode="distinct_reports").collect() == [("c", "p", 1)]


def test_a_large_report_is_dealt_out(spark):
    """One report of 5,000 x 5,000 pairs among small ones: same counts as by the plain join, and no task makes more than three times the median."""
    small = spark.range(4000)
    left = small.select(F.col("id").alias("report"), F.concat(F.lit("c"), (F.col("id") % 7).cast("string")).alias("compound")).unionByName(spark.range(5000).select(F.lit(-1).cast("bigint").alias("report"), F.concat(F.lit("c"), F.col("id").cast("string")).alias("compound")))
    right = small.select(F.col("id").alias("report"), F.concat(F.lit("o"), (F.col("id") % 5).cast("string")).alias("outcome")).unionByName(spark.range(5000).select(F.lit(-1).cast("bigint").alias("report"), F.concat(F.lit("o"), F.col("id").cast("string")).alias("outcome")))
    right = right.unionByName(right).unionByName(spark.createDataFrame([(None, "none")], "report bigint, outcome string"))
    old = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.enabled")}
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        rows = graph.pair_rows(left, right, "report", most=1 << 16)
        made = [r["count"] for r in rows.where("report = -1").groupBy(F.spark_partition_id()).count().collect()]
        assert sum(made) == 25_000_000 and len(made) == 16 and max(made) <= 3 * sorted(made)[8]
        plain = graph.pair_rows(left.where("report >= 0"), right.where("report >= 0"), "report", most=1 << 16)
        assert "__i" not in plain._jdf.queryExecution().toString()
        got = graph.pair_counts(left.where("report >= 0 OR compound < 'c1'"), right.where("report >= 0 OR outcome < 'o2'"), "report", ["compound"], ["outcome"], most=100)
        few = left.where("report >= 0 OR compound < 'c1'").distinct().join(right.where("report >= 0 OR outcome < 'o2'").distinct(), "report").groupBy("compound", "outcome").agg(F.count("*").alias("n_cases"))
        assert got.count() == few.count() and got.exceptAll(few).count() == 0
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_bridge_and_choice(spark):
    rel = spark.createDataFrame([("a", "m"), ("m", "z"), ("a", "y"), ("y", "q"), ("b", "n"), ("", "z")], "a string, b string")
    ids = lambda *x: spark.createDataFrame([(i,) for i in x], "id string")
    assert sorted(match.bridge(rel, ids("a", "b"), ids("z", "y", "q")).collect()) == [("a", "y"), ("a", "z")]
    # A hub between wanted and linked ids, in many chunks; relations repeated and turned round.
    hub = spark.range(3000).select(F.concat(F.lit("n"), F.col("id").cast("string")).alias("a"), F.lit("hub").alias("b"))
    some = hub.where("a LIKE '%7'").select(F.col("a").alias("id"))
    got = match.bridge(hub.unionByName(hub.select(F.col("b").alias("a"), F.col("a").alias("b"))), ids("n1", "n2", "n7"), some, chunk=10)
    assert got.count() == 300 + 300 + 299 and got.where("id = 'n7' AND target = 'n7'").count() == 0
    links = spark.createDataFrame([("k", "1"), ("k", "2"), ("j", "3")], "k string, v string")
    assert sorted(match.preferred_id(links, "k", "v", spark.createDataFrame([("2",)], "v string")).collect()) == [("j", "3"), ("k", "2")]


def test_match_terms_and_corrections(spark):
    from sigweave.functions.text import variants

    terms = spark.createDataFrame([("aspirin 10 mg",), ("foo/bar",), ("none",)], "term string")
    voc = spark.createDataFrame([("1", "RXNORM", "IN", "c", "Aspirin", 5), ("2", "GS", "IN", "c", "ASPIRIN", 1), ("3", "ATC", "BN", "c", "bar", 2)], "rxcui string, sab string, tty string, code string, string string, line_no bigint")
    got = {r.term: (r.rxcui, r.stage) for r in match.match_terms(terms, "term", variants(terms, "term", ["term"]), voc).collect()}
    assert got == {"aspirin 10 mg": ("1", "CLEANED"), "foo/bar": ("3", "SPLIT"), "none": (None, None)}
    a = spark.createDataFrame([("t", "x", 1), ("t", "y", 2)], "term_std string, action string, line_no bigint")
    b = spark.createDataFrame([("t", "z", 1), ("u", "w", 1)], "term_std string, action string, line_no bigint")
    assert {r.term_std: r.action for r in match.corrections(a, b).collect()} == {"t": "y", "u": "w"}
    assert sorted(match.name_index(spark.createDataFrame([("D1", "X 5 MG")], "id string, n string"), "id", "n").collect()) == [("X", "D1"), ("X 5 MG", "D1")]


def test_graph_invariants(spark):
    c = spark.range(400).select(F.col("id").alias("report"), F.when(F.col("id") % 2 == 0, "PS").otherwise("SS").alias("role"), (F.col("id") % 7).cast("string").alias("compound"))
    o = spark.range(400).select(F.col("id").alias("report"), (F.col("id") % 5).cast("string").alias("outcome"))
    h = spark.createDataFrame([(str(i), None if i == 4 else f"p{i % 2}") for i in range(5)], "outcome string, parent string")
    last = None
    for least in (1, 6, 7):
        g = graph.core_graph(c, o, h, least)
        edges = {tuple(r) for t in ("edge_ps", "edge_ss") for r in g[t].collect()}
        assert {e[0] for e in edges} == {r[0] for r in g["node_compound"].collect()} and {e[1] for e in edges} == {r[0] for r in g["node_outcome"].collect()}
        assert all(e[2] >= least for e in edges) and (last is None or edges <= last)
        last = edges
    assert sorted(r.i for r in graph.surrogate(c, "compound", "i").collect()) == list(range(1, 8))


def test_stages_resume(spark, tmp_path):
    calls = []

    def make(*inputs):
        calls.append(1)
        return inputs[0] if inputs else spark.range(3)

    plan = [("a", [], make), ("b", ["a"], make)]
    for _ in range(2):
        assert stages.run(spark, str(tmp_path), plan)["b"].count() == 3
    assert len(calls) == 2
    with pytest.raises(ValueError):
        stages.run(spark, str(tmp_path), [("c", ["x"], make)])


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([(2, 'a,"b'), (1, "line\nbreak")], "k int, v string")
    report.write_csv(df, f"{tmp_path}/c", "k", compression="gzip")
    assert spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(f"{tmp_path}/c").count() == 2
    report.write_json(report.coverage(df, F.col("k"), small=F.col("k") == 1), f"{tmp_path}/j")
    assert "0.333333" in "".join(r[0] for r in spark.read.text(f"{tmp_path}/j").collect())


def test_no_nested_loops_in_graph_plans(spark, capsys):
    for name in ("flagship_graph_ps", "tombstone_filter", "graph_summary"):
        catalog.queries()[name](spark, "/root/testdata/sf0.001").explain()
        assert not any(x in capsys.readouterr().out for x in ("NestedLoop", "Cartesian"))
