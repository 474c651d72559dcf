import csv
import glob
import json

import pytest
from pyspark.sql import functions as F

from sigweave.functions import text
from sigweave.operators import curate, graph, match, reactions, report, structures

CONCEPTS = [
    ("1", "RXNORM", "IN", "c1", "ASPIRIN", 0), ("1", "GS", "BN", "c1", "ASPIRIN", 1), ("2", "RXNORM", "SCD", "c2", "ASPIRIN 100 MG TABLET", 2), ("3", "VANDF", "IN", "c3", "IBUPROFEN", 3),
    ("4", "RXNORM", "IN", "c4", "CODEINE", 4), ("5", "RXNORM", "MIN", "c5", "ASPIRIN / CODEINE", 5), ("6", "RXNORM", "IN", "c6", "ORPHANOL", 6), ("3", "VANDF", "IN", "c3", "IBUPROFEN", 7),
]
TERMS = ["ASPIRIN", "ASPIRIN TABLET", "IBUPROFEN SODIUM TABLET", "CODEINE PHOSPHATE", "ASPIRIN AND CODEINE", "ORPHANOL", "NAMEONLY", "FOO (CODEINE)", "UNKNOWN", "N/A", "??", "TYPO", "BADFIX", "NOTHING KNOWN HERE", "IBUPROFEN + XYZ", "KEEPME"]


@pytest.fixture(scope="module")
def vocabulary(spark):
    links = spark.createDataFrame([("1", "D9"), ("1", "D1"), ("1", "D0"), ("30", "D3"), ("4", "D4"), ("5", "D0")], "rxcui string, id string")
    bridged = match.bridge(spark.createDataFrame([("3", "30"), ("6", "7")], "a string, b string"), spark.createDataFrame([("3",), ("6",)], "id string"), spark.createDataFrame([("1",), ("30",), ("4",)], "id string"))
    return curate.Vocabulary(
        spark.createDataFrame(CONCEPTS, "rxcui string, sab string, tty string, code string, string string, line_no bigint"), links, bridged.select(F.col("id").alias("rxcui"), "target"),
        spark.createDataFrame([("D1", "Aspirin"), ("D3", "Ibuprofen"), ("D4", "Codeine"), ("D5", "NameOnly"), ("D0", "Aspirin/Codeine")], "id string, name string"),
        spark.createDataFrame([("D1", "S1"), ("D9", "S9"), ("D3", "S3"), ("D4", "S4"), ("D5", "S5")], "id string, structure string"),
    )


@pytest.fixture(scope="module")
def decided(spark, vocabulary):
    terms = spark.createDataFrame([(t, t, 100 - i, 1) for i, t in enumerate(TERMS)], "term_std string, term_norm string, n_rows bigint, n_cases bigint")
    fixes = spark.createDataFrame([("typo", "MAP_TO_TERM", "CODEINE", "seen"), ("BADFIX", "MAP_TO_TERM", "NOWHERE", "x"), ("KEEPME", "REVIEW", "", "later")], "term_std string, action string, target_term string, note string")
    return curate.decide(terms, fixes, vocabulary)


def test_decisions(decided):
    got = {r.term_std: r for r in decided.collect()}
    assert len(got) == len(TERMS)
    mapped = {t: (r.target_term, r.stage, r.rxcui, r.id, r.structure) for t, r in got.items() if r.status == "MAP_SUCCESS"}
    assert mapped == {
        "ASPIRIN": ("ASPIRIN", "EXACT", "1", "D1", "S1"),
        "ASPIRIN TABLET": ("ASPIRIN TABLET", "EXACT", "1", "D1", "S1"),  # the pool of a variant has concepts of its cleaned form, too
        "IBUPROFEN SODIUM TABLET": ("IBUPROFEN", "EXACT", "3", "D3", "S3"),  # cleaned, then without its salt; by the bridge
        "CODEINE PHOSPHATE": ("CODEINE", "EXACT", "4", "D4", "S4"),
        "NAMEONLY": ("NAMEONLY", "DB_NAME_EXACT", "", "D5", "S5"),
        "FOO (CODEINE)": ("FOO ( CODEINE )", "PAREN", "4", "D4", "S4"),
        "TYPO": ("CODEINE", "EXACT", "4", "D4", "S4"),
        "IBUPROFEN + XYZ": ("IBUPROFEN + XYZ", "SPLIT", "3", "D3", "S3"),
    }
    assert {t for t, r in got.items() if r.status == "EXCLUDE"} == {"UNKNOWN", "??"}  # N/A has its slash padded before it is looked at, and stays
    assert got["ASPIRIN"].note == "auto_RXNORM_EXACT" and got["TYPO"].note == "seen" and got["ASPIRIN"].candidate_count == 3
    assert (got["BADFIX"].action, got["BADFIX"].status, got["KEEPME"].action, got["KEEPME"].status) == ("", "UNRESOLVED", "REVIEW", "UNRESOLVED")


def test_concept_without_structure_ends_the_variants(spark, vocabulary):
    rows = spark.createDataFrame([(1, "ORPHANOL / IBUPROFEN"), (2, "ASPIRIN AND CODEINE"), (3, "ORPHANOL")], "k int, t string")
    got = {r.k: (r.rxcui, r.id, r.structure) for r in curate.resolve(rows, ["k"], "t", vocabulary).collect()}
    # ties of priority go by stage and text: IBUPROFEN before ORPHANOL; a concept whose ids lack a structure loses its id
    assert got == {1: ("3", "D3", "S3"), 2: ("5", "", ""), 3: ("6", "", "")}


def test_decisions_applied(spark, decided):
    base = spark.createDataFrame([(t, t, 1, 1, "UNMAPPED", 0, "", "", "", "", "", "", "", "") for t in TERMS] + [("DONE", "DONE", 9, 9, "EXACT", 2, "8", "s", "t", "c", "r", "D8", "n", "S8")], "term_std string, term_norm string, n_rows bigint, n_cases bigint, mapping_stage string, candidate_count bigint, rxcui string, sab string, tty string, code string, rx_string string, id string, id_name string, structure string")
    assert curate.unmapped(base).count() == len(TERMS) and [r.term_std for r in curate.unmapped(base, 2).collect()] == sorted(TERMS)[:2]
    got = {r.term_std: r for r in curate.apply_decisions(base, decided).collect()}
    assert (got["DONE"].mapping_stage, got["DONE"].structure, got["DONE"].manual_action) == ("EXACT", "S8", "")
    assert (got["TYPO"].mapping_stage, got["TYPO"].manual_target, got["TYPO"].structure) == ("MANUAL_EXACT", "CODEINE", "S4")
    assert (got["UNKNOWN"].mapping_stage, got["UNKNOWN"].manual_action) == ("MANUAL_EXCLUDE", "EXCLUDE_NON_DRUG")
    known = spark.createDataFrame([("typo", "MAP_TO_TERM", "OLD", ""), ("OTHER", "REVIEW", "", "")], "term_std string, action string, target_term string, note string")
    merged = {text_std: target for text_std, target in (r[::2] for r in curate.merged_corrections(known, decided).select("term_std", "action", "target_term").collect())}
    assert merged["TYPO"] == "CODEINE" and "typo" not in merged and "OTHER" in merged


def test_probe_terms_strip_salts_of_the_cleaned_form(spark):
    df = spark.createDataFrame([("X SODIUM TABLET",)], "t string")
    assert df.select(text.probe_terms(F.col("t"))).first()[0] == ["X SODIUM TABLET", "X SODIUM", "X"]


def test_reaction_stages_and_overrides(spark):
    terms = spark.createDataFrame([("Head-Ache",), ("LOW",), ("H1",), ("H2",), ("??",), ("",), (None,)], "pt_norm string")
    pt = spark.createDataFrame([("HEAD-ACHE", "1"), ("BASE", "2")], "name string, code string")
    made = reactions.standardize(terms, pt, spark.createDataFrame([("LOW", "2")], "name string, code string"), spark.createDataFrame([("H1", "1"), ("H2", "7")], "term string, code string"))
    assert {r.pt_norm: (r.code, r.name, r.map_source) for r in made.collect()} == {
        "HEAD-ACHE": ("1", "HEAD-ACHE", "PT_EXACT"), "LOW": ("2", "BASE", "LLT_TO_PT"), "H1": ("1", "HEAD-ACHE", "MANUAL_CODE_HINT"),
        "H2": ("", "", "MANUAL_HINT_CODE_UNRESOLVED"), "??": ("", "", "UNRESOLVED_WITH_MEDDRA"), "": ("", "", "EMPTY_PT"),
    }
    over = spark.createDataFrame([("??", "5", "a", 0), ("??", "9", "no name", 1), ("H2", "2", "b", 2), ("GONE", "1", "c", 3), ("H2", "", "blank", 4)], "pt_norm string, code string, reason string, line_no bigint")
    got = reactions.overridden(made, over, spark.createDataFrame([("5", "FIVE")], "code string, name string"))
    table = {r.pt_norm: (r.code, r.name) for r in got["term_map"].where("map_source = 'MANUAL_TERM_OVERRIDE'").collect()}
    assert table == {"??": ("5", "FIVE"), "H2": ("2", "BASE")}
    assert [tuple(r) for r in got["missing"].collect()] == [("GONE", "1")] and [tuple(r) for r in got["unresolved"].collect()] == [("??", "9")]
    assert sorted(r.reason for r in got["log"].collect()) == ["a", "b"]
    facts = spark.createDataFrame([("p1", "c1", "??"), ("p1", "c1", "??"), ("p2", "c2", "LOW")], "primaryid string, caseid string, pt_norm string")
    base = reactions.facts_by_code(facts, made)
    assert (base.count(), reactions.refreshed_facts(base, facts, got["term_map"], over).count()) == (1, 2)
    assert tuple(reactions.map_metrics(facts, made).first()) == (3, 1) and tuple(reactions.map_metrics(facts, got["term_map"]).first()) == (1, 3)
    assert [tuple(r) for r in reactions.unresolved_counts(facts, made).collect()] == [("??", 2)]


def test_structures(spark):
    rows = [("a", "D1", "n1", " S1 ", "EXACT"), ("b", "D2", "n2", "S1", "EXACT"), ("c", "D3", "n3", "S2;x", "EXACT"), ("d", "D4", "n4", "BAD", "EXACT"), ("e", "D5", "n5", "S9", "MANUAL_EXCLUDE"), ("f", "D6", "n6", "", "EXACT")]
    terms = spark.createDataFrame(rows, "term_std string, id string, id_name string, structure string, mapping_stage string")
    raw = structures.distinct_structures(terms)
    assert sorted(r[0] for r in raw.collect()) == ["BAD", "S1", "S2;x"]

    def make():
        def standardise(s):
            parts = s.split(";")
            if s == "BAD":
                raise ValueError("no")
            return ("OK", parts[0].lower(), parts[0], parts[0], len(parts), 1, "ok" if len(parts) == 1 else f"fragment_parent_from_{len(parts)}")

        return standardise

    done = structures.by_function(raw, make)
    got = {r.inchi_raw: (r.status, r.inchikey, r.note) for r in done.collect()}
    assert got == {"S1": ("OK", "s1", "ok"), "S2;x": ("OK", "s2", "fragment_parent_from_2"), "BAD": ("STANDARDIZE_FAIL", "", "standardize error: no")}
    assert {r.inchi_raw: r.status for r in structures.by_table(raw, done.where("inchi_raw <> 'BAD'")).collect()} == {"S1": "OK", "S2;x": "OK", "BAD": "PARSE_FAIL"}
    mapped = structures.term_structures(terms, done)
    meta = {r.inchikey: (r.term_count, r.dbid_list, r.drugbank_name_list) for r in structures.structure_meta(mapped).collect()}
    assert meta == {"s1": (2, "D1,D2", "n1,n2"), "s2": (1, "D3", "n3")}
    drugs = spark.createDataFrame([("p", "c", " ps", "a"), ("p", "c", "PS", "b"), ("p", "c", "C", "c"), ("q", "c", "SS", " ")], "primaryid string, caseid string, role_cod string, drug_key_std string")
    assert [tuple(r) for r in structures.report_compounds(drugs, mapped, ("PS", "SS")).collect()] == [("p", "c", "PS", "s1")]


def test_labels_of_reference_table(spark):
    lab = lambda *x: spark.createDataFrame(x, "code string, label string")
    pt = spark.createDataFrame([("1", "one"), ("2", None)], "pt_code string, pt_name string")
    soc = spark.createDataFrame([("1", "9", "nine")], "pt_code string, soc_code_primary string, soc_name_primary string")
    got = graph.reference_reactions(pt, soc, (lab(("5", "x")), lab(("1", "eins"))), (lab(("9", "Nine")), lab(("8", "x"))), {"in_ge10": pt.where("pt_code = '2'")})
    assert sorted(map(tuple, got.collect())) == [("1", "one", "eins", "9", "Nine", "", 0), ("2", "", "", None, "", "", 1)]


def test_release_decisions_and_error_report(spark, tmp_path):
    df = spark.range(5).select("id", (F.col("id") % 2).alias("k"))
    found = report.write_release({"a": df, "b": df.where("id < 0")}, str(tmp_path / "rel"))
    import hashlib

    for r in found.collect():
        raw = open(r.path.removeprefix("file:"), "rb").read()
        assert (len(raw), hashlib.sha256(raw).hexdigest()) == (r.bytes, r.sha256)
    listed = [row for p in glob.glob(str(tmp_path / "rel/manifest.csv/*.csv")) for row in csv.DictReader(open(p))]
    assert len(listed) == found.count() > 0
    report.write_decisions(df, str(tmp_path / "d"), "k", size=2)
    back = spark.read.option("header", True).option("inferSchema", True).csv(str(tmp_path / "d"))
    assert sorted((r.batch_id, r.k, r.id) for r in back.collect()) == [(1, 0, 0), (1, 0, 2), (2, 0, 4), (2, 1, 1), (3, 1, 3)]

    def fails():
        raise ValueError("broken")

    with pytest.raises(ValueError):
        report.reported(spark, str(tmp_path / "err"), fails)
    assert json.loads(open(glob.glob(str(tmp_path / "err/part*"))[0]).read())["error"] == "broken"
