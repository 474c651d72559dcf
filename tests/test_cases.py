"""From archives to facts and mapped terms, on the edge rows of FIXTURES.md."""

import zipfile

import pytest
from pyspark.sql import functions as F

from sigweave.functions import text
from sigweave.operators import cases, graph, match
from sigweave.sources import ragged, vocab
from sigweave.streaming import incremental

DEMO = "primaryid$caseid$caseversion$i_f_code$fda_dt$event_dt$sex$age$reporter_country\n"
DRUG = "primaryid$caseid$drug_seq$role_cod$drugname$prod_ai$route$dose_vbm$val_vbm\n"


@pytest.fixture(scope="module")
def root(tmp_path_factory):
    folder = tmp_path_factory.mktemp("archives")

    def archive(name, quarter, **members):
        with zipfile.ZipFile(folder / name, "w") as z:
            for kind, body in members.items():
                z.writestr(f"ascii/{kind.upper()}{quarter}.txt", body.encode("latin-1"))

    first = DEMO + '101$1$1$I$20190101$$M$1$US\n102$1$2$F$20190301$$M$1$"two\nlines"\n201$2$1$I$20190101$$F$2$FR\n301$3$1$I$20190101$$F$2$DE\n'
    drugs = DRUG + "102$9$1$ps$Aspirin$$ORAL$a$1\n102$1$1$PS$aspirin$$IV$b$1\n102$1$2$SS$x$Co-Trimoxazole$$$$$$\n201$2$1$C$gone$$$$\n$2$1$C$none$$$$\n102$1$3$I$A$B$C$D$E$F\n102$1$4$C$short\n"
    archive("faers_ascii_2019q1.zip", "19Q1", demo=first, drug=drugs, reac="primaryid$caseid$pt$drug_rec_act\n102$1$Head - ache$x\n102$1$HEAD-ACHE$y\n301$3$pain$\n")
    archive("FAERS_ascii_2019Q2.zip", "19Q2", demo=DEMO + "301$3$1$F$20190401$$F$2$DE\n", delete="2\n", drug=DRUG + "102$1$9$PS$late$$$$\n301$3$1$PS$kept$$$$\n")
    archive("old_faers_ascii_2012q3.zip", "12Q3", demo=DEMO + "901$9$1$I$20120101$$M$1$US\n")
    archive("faers_ascii_2019q3.zip", "19Q9", demo=DEMO + "902$9$1$I$20190701$$M$1$US\n", delete="3\n")
    return str(folder)


def test_archives_are_known_by_their_whole_names(spark, root):
    assert [(r.zip, r.file_rank) for r in ragged.archives(spark, root).orderBy("file_rank").collect()] == [("faers_ascii_2019q1.zip", 1), ("FAERS_ascii_2019Q2.zip", 2), ("faers_ascii_2019q3.zip", 3)]
    assert ragged.archive_lines(spark, root, "demo").select("zip").distinct().count() == 2  # DEMO19Q9 is no member
    lines = ragged.archive_lines(spark, root, "demo").where("zip LIKE 'faers%'").orderBy("line_no").collect()
    assert lines[2].line == '102$1$2$F$20190301$$M$1$"two\nlines"'  # a record, not a line


def test_cases_and_facts(spark, root):
    got = cases.cases_from_archives(spark, root).select("caseid", "primaryid", "year", "quarter", "zip_name", "reporter_country").orderBy("caseid")
    assert [tuple(r) for r in got.collect()] == [("1", "102", 2019, 1, "faers_ascii_2019q1.zip", "two\nlines"), ("3", "301", 2019, 2, "FAERS_ascii_2019Q2.zip", "DE")]
    chosen = cases.cases_from_archives(spark, root)
    rows = ragged.parse(ragged.archive_lines(spark, root, "drug"), "drug")
    facts = cases.drug_facts(rows, chosen).orderBy("primaryid", "drug_seq").collect()
    assert facts[0].asDict().keys() == dict.fromkeys(cases.DRUG_COLUMNS).keys()
    # Of rows that differ only in route the first stays, with the selected case id; rows of another quarter's file are not picked up.
    assert [(r.primaryid, r.caseid, r.drug_seq, r.role_cod, r.drug_key_std, r.route_std, r.val_vbm) for r in facts] == [
        ("102", "1", "1", "PS", "ASPIRIN", "ORAL", "1"), ("102", "1", "2", "SS", "CO - TRIMOXAZOLE", "", ""), ("102", "1", "3", "I", "B", "C", "E$F"), ("102", "1", "4", "C", "SHORT", "", ""), ("301", "3", "1", "PS", "KEPT", "", "")
    ]
    counters = cases.parse_counters(rows, cases.all_drug_facts(rows, chosen), cases.drug_facts(rows, chosen)).orderBy("zip_name").collect()
    by = {r.zip_name: r.asDict() for r in counters}
    assert by["faers_ascii_2019q1.zip"] | {"year": 0, "quarter": 0} == {
        "year": 0, "quarter": 0, "zip_name": "faers_ascii_2019q1.zip", "raw_rows": 7, "skipped_no_primaryid": 1, "trailing_trimmed": 3, "padded_short": 1, "merged_long": 1, "filtered_rows": 5, "caseid_overridden": 1, "inserted_rows": 4,
    }
    reac = ragged.parse(ragged.archive_lines(spark, root, "reac"), "reac")
    found = cases.reaction_facts(reac, chosen, text.normalize_reaction(F.col("pt"))).collect()
    assert [(r.primaryid, r.pt_norm, r.drug_rec_act_std) for r in found] == [("102", "HEAD-ACHE", "X")]
    assert sorted(map(tuple, cases.term_stats(cases.drug_facts(rows, chosen)).where("term_std IN ('ASPIRIN', 'B')").collect())) == [("ASPIRIN", 1, 1), ("B", 1, 1)]


def test_trailing_empty_cells_of_long_rows(spark):
    rows = [(2019, 1, "z", "m", 0, "primaryid$caseid$pt"), (2019, 1, "z", "m", 1, "1$2$a$$"), (2019, 1, "z", "m", 2, "1$2$a$$b$"), (2019, 1, "z", "m", 3, "1$2")]
    got = ragged.parse(spark.createDataFrame(rows, "year int, quarter int, zip string, member string, line_no bigint, line string"), "reac").orderBy("line_no")
    assert [(r.pt, r.trimmed, r.padded, r.folded) for r in got.collect()] == [("a", 2, 0, 0), ("a$$b", 1, 0, 1), ("", 0, 1, 0)]


def test_keys_of_a_step(spark, tmp_path):
    (tmp_path / "k.csv").write_text("caseid,primaryid,year,quarter\n1,101,2019,1\n2,,2019,1\n3,301,x,1\n,1,2019,2\n4, 401 , 2020 ,4\n")
    assert sorted(map(tuple, cases.step_keys(spark, f"{tmp_path}/k.csv").collect())) == [(2019, 1, "1", "101"), (2020, 4, "4", "401")]


def test_term_map(spark, tmp_path):
    (tmp_path / "n.csv").write_text('DrugID,DrugName\ndb1,"Aspirin, pure"\nDB1,second\nDB2,Ｆoobar\nDB3,nostructure\n,x\n')
    (tmp_path / "i.csv").write_text("DrugID,InChI\nDB1,\nDB1,InChI=1\nDB2,InChI=2\n")
    names, inchi = vocab.names(spark, f"{tmp_path}/n.csv"), vocab.structures(spark, f"{tmp_path}/i.csv")
    assert sorted(map(tuple, names.collect())) == [("DB1", "Aspirin, pure"), ("DB2", "Foobar"), ("DB3", "nostructure")]
    assert sorted(map(tuple, inchi.collect())) == [("DB1", "InChI=1"), ("DB2", "InChI=2")]
    terms = spark.createDataFrame([("aspirin 10 MG", 5, 4), ("FOOBAR", 3, 3), ("NOSTRUCTURE", 2, 2), ("TRASH", 1, 1), ("ASA", 9, 9), ("ZZZ", 1, 1), ("  ", 7, 7)], "term_std string, n_rows bigint, n_cases bigint")
    words = spark.createDataFrame([("1", "RXNORM", "IN", "c1", "Aspirin", 5), ("1", "RXNORM", "IN", "c1", "Aspirin", 9), ("2", "GS", "IN", "c2", "ASPIRIN", 1)], "rxcui string, sab string, tty string, code string, string string, line_no bigint")
    links = spark.createDataFrame([("1", "DB0"), ("1", "DB1")], "rxcui string, dbid string")
    fixes = spark.createDataFrame([("trash", "EXCLUDE_NON_DRUG", "", 1), ("asa", "EXCLUDE_NON_DRUG", None, 2), ("ASA", "MAP_TO_TERM", "aspirin", 3), ("ZZZ", "MAP_TO_TERM", "YYY", 4)], "term_std string, action string, target_term string, line_no bigint")
    got = match.map_terms(terms, words, links, names, inchi, fixes)
    assert got.columns == match.TERM_MAP
    rows = {r.term_std: (r.mapping_stage, r.candidate_count, r.rxcui, r.dbid, r.drugbank_name, r.inchi) for r in got.collect()}
    assert rows == {
        "aspirin 10 MG": ("CLEANED", 2, "1", "DB1", "Aspirin, pure", "InChI=1"), "FOOBAR": ("DB_NAME_EXACT", 1, "", "DB2", "Foobar", "InChI=2"), "NOSTRUCTURE": ("UNMAPPED", 0, "", "", "", ""),
        "TRASH": ("MANUAL_EXCLUDE", 0, "", "", "", ""), "ASA": ("MANUAL_EXACT", 2, "1", "DB1", "Aspirin, pure", "InChI=1"), "ZZZ": ("MANUAL_UNMAPPED", 0, "", "", "", ""),
    }
    assert {r.mapping_stage: (r.n_terms, r.n_rows) for r in match.stage_counts(got).collect()}["MANUAL_EXACT"] == (1, 9)


def test_links_and_hierarchy(spark, tmp_path):
    line = lambda *p: "|".join(p + ("",) * 4)
    row = lambda rx, code, name="Ａspirin": line(rx, "ENG", *[""] * 9, "DRUGBANK", "IN", code, name, "", "N")
    (tmp_path / "c.rrf").write_text("\n".join([row("1", "DB1"), row("1", "X9"), row("", "DB2")]))
    assert vocab.concept_links(spark, f"{tmp_path}/c.rrf").collect() == [("1", "DB1")]
    assert {r.string for r in vocab.concepts(spark, f"{tmp_path}/c.rrf").collect()} == {"Aspirin"}
    (tmp_path / "v_26_1").mkdir()
    (tmp_path / "v_26_1" / "pt.asc").write_bytes("1$Schmerz é$\n".encode("latin-1"))
    (tmp_path / "v_26_1" / "llt.asc").write_bytes(b"7$Weh$1$\n")
    (tmp_path / "h.asc").write_bytes(b"1$h$g$s1$Pain$a$b$Body$x$y$s1$Y$\n1$h$g$s2$Pain$a$b$Mind$x$y$s1$N$\nshort$\n")
    found = vocab.reaction_resources(spark, str(tmp_path))
    assert found["release"] == "26.1" and found["lower"].collect() == [("Weh", "1")] and found["preferred"].collect() == [("Schmerz é", "1")]
    assert sorted((r.pt_code, r.soc_code, r.is_primary) for r in vocab.hierarchy(spark, f"{tmp_path}/h.asc").collect()) == [("1", "s1", 1), ("1", "s2", 0)]
    assert vocab.reaction_resources(spark, str(tmp_path / "nothing")) is None if (tmp_path / "nothing").mkdir() is None else False


@pytest.mark.parametrize("reuse, adaptive", [("false", "true"), ("true", "false")])
def test_surrogates_without_reuse_of_exchanges(spark, reuse, adaptive):
    old = {k: spark.conf.get(k) for k in ("spark.sql.exchange.reuse", "spark.sql.adaptive.enabled")}
    spark.conf.set("spark.sql.exchange.reuse", reuse)
    spark.conf.set("spark.sql.adaptive.enabled", adaptive)
    try:
        keys = spark.range(60_000).select(F.md5(F.col("id").cast("string")).alias("key"))
        got = graph.surrogate(keys, "key", "id").agg(F.count("*"), F.countDistinct("id"), F.min("id"), F.max("id")).first()
        assert tuple(got) == (60_000, 60_000, 1, 60_000)
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_a_repeated_batch_replaces_its_rows(spark, tmp_path):
    src, out, mark = (str(tmp_path / x) for x in ("in", "out", "mark"))
    spark.createDataFrame([(1, "b"), (1, "a"), (2, "c")], "k int, v string").coalesce(1).write.parquet(src)
    incremental.ingest_available(spark, src, "k int, v string", out, mark, ["k"], ["v"])
    incremental.ingest_available(spark, src, "k int, v string", out, str(tmp_path / "lost"), ["k"], ["v"])  # as after a crash without its checkpoint
    assert sorted(tuple(r)[:2] for r in spark.read.parquet(out).collect()) == [(1, "a"), (2, "c")]
    counts = str(tmp_path / "counts")
    incremental.count_available(spark, src, "k int, v string", counts, str(tmp_path / "mark2"), ["k"], "n")
    assert sorted((r.k, r.n) for r in incremental.merged_counts(spark.read.parquet(counts).select("k", "n"), spark.createDataFrame([(1, 5)], "k int, n bigint"), ["k"], "n").collect()) == [(1, 7), (2, 1)]


def test_exports_count_their_rows(spark, root, tmp_path):
    from sigweave.operators import report

    assert cases.export_cases(cases.cases_from_archives(spark, root), f"{tmp_path}/cases") == 2
    assert spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(f"{tmp_path}/cases").columns == cases.CASE_COLUMNS
    fixes = spark.createDataFrame([("B", "MAP_TO_TERM", "x", None), ("A", "EXCLUDE_NON_DRUG", "", "n")], "term_std string, action string, target_term string, note string")
    assert report.write_master(fixes, f"{tmp_path}/master") == 2
    assert [r.term_std for r in spark.read.option("header", True).csv(f"{tmp_path}/master").collect()] == ["A", "B"]
    assert report.backed_up(fixes, f"{tmp_path}/backup") and not report.backed_up(fixes.limit(1), f"{tmp_path}/backup")
    assert spark.read.parquet(f"{tmp_path}/backup").count() == 2
    got = graph.reference_parents(spark.createDataFrame([("1", "s", "a", "b"), ("2", "s", "a", "b"), ("3", None, "", "")], "pt_code string, soc_code_primary string, soc_name_en string, soc_name_zh string"))
    assert got.collect() == [("s", "a", "b")]
