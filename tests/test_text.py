import re
import unicodedata

import pytest
from pyspark.sql import functions as F

from sigweave.functions import text


def v(spark, f, *values):
    rows = spark.createDataFrame([(i, x) for i, x in enumerate(values)], "i int, s string")
    return [r[1] for r in sorted(rows.select("i", f(F.col("s"))).collect())]


def test_nfkc_of_latin1_is_complete(spark):
    chars = [chr(c) for c in range(1, 256)]
    want = [re.sub(r"\s+", " ", unicodedata.normalize("NFKC", f"a{c}b").strip()).upper() for c in chars]
    assert v(spark, text.normalize_text, *(f"a{c}b" for c in chars)) == want


@pytest.mark.parametrize("f, given, want", [
    (text.normalize_drug_v2, "A\\B", "A\\B"), (text.normalize_drug_v3, "A\\B", "A / B"), (text.normalize_drug_v2, "A & B", "A & B"), (text.normalize_drug_v3, "a&b", "A & B"),
    (text.normalize_drug_v3, "CO-TRIMOXAZOLE", "CO - TRIMOXAZOLE"), (text.normalize_drug_v3, "N/A", "N / A"), (text.normalize_drug_v3, None, ""), (text.normalize_drug_v3, "'\"x\"", "X"),
    (text.normalize_reaction, " off -- label/use ", "OFF-LABEL / USE"), (text.clean_term, "SALINE 5 %", "SALINE %"), (text.clean_term, "DEXTROSE 5%W", "DEXTROSE W"), (text.clean_term, "X 10 MG", "X"),
    (text.clean_term, "aspirin 100 mg/5 ml tablet", "ASPIRIN"), (text.strip_salt, "amlodipine besylate", "AMLODIPINE"), (text.strip_salt, "sodium citrate", "SODIUM"), (text.strip_salt, "X HCL MONOHYDRATE", "X"), (text.strip_salt, "SODIUM", "SODIUM"),
])
def test_terms(spark, f, given, want):
    assert v(spark, f, given) == [want]


def test_non_drug_marks(spark):
    assert v(spark, text.non_drug, "N/A", "?", "", None, "gene therapy", "aspirin") == [False, True, True, True, True, False]


def test_normalisers_are_idempotent(spark):
    given = ["a-b", "'x, y;z'", "A \\ b & (c)[d]", "é½ ª", "  – “q”  "]
    for f in (text.normalize_text, text.normalize_drug_v2, text.normalize_drug_v3, text.normalize_reaction):
        once = v(spark, f, *given)
        assert v(spark, f, *once) == once


def test_variants(spark):
    df = spark.createDataFrame([("a (bc) and d/e 5 mg",)], "t string")
    got = {(r.priority, r.stage, r.variant) for r in text.variants(df, "t", ["t"], curation=True).collect()}
    assert (1, "EXACT", "A ( BC ) AND D / E 5 MG") in got and (3, "AND_TO_SLASH", "A ( BC ) / D / E 5 MG") in got and (4, "PAREN", "BC") in got
    assert {x[2] for x in got if x[1] == "SPLIT"} == {"A ( BC ) AND D", "E 5 MG"}
    assert {x[1] for x in text.variants(df, "t", ["t"]).select("priority", "stage", "variant").collect()} == {"EXACT", "CLEANED", "PAREN", "SPLIT"}


def test_nfkc_of_vocabularies(spark):
    assert text.nfkc(spark.createDataFrame([("ﬁ½",), (None,)], "s string"), "s").collect() == [("fi1⁄2",), (None,)]


def test_probe_terms_compute_a_normal_form_once(spark):
    """The forms are those written out one by one, and a plan of them doesn't repeat the normal form in each."""
    given = ["aspirin and codeine", "A or b sodium 5 mg tablet", "a '", "'x' & \"y\"", "", None, "HCL", "x \\ y-z phosphate"]

    def written_out(c):
        t, cleaned = text.normalize_drug_v3(c), text.clean_term(c, text.FORM_WORDS_CURATION)
        slash = lambda word: text.normalize_drug_v3(F.replace(t, F.lit(word), F.lit(" / ")))
        return F.filter(F.array_distinct(F.array(t, cleaned, slash(" AND "), slash(" OR "), text.strip_salt(c), text.strip_salt(cleaned))), lambda x: x != "")

    assert v(spark, text.probe_terms, *given) == v(spark, written_out, *given)
    df = spark.createDataFrame([("a",)], "s string")
    plan = lambda f: df.select(f(F.col("s")).alias("x"))._jdf.queryExecution().optimizedPlan().toString()
    assert plan(text.probe_terms).count("translate(") * 3 < plan(written_out).count("translate(")
