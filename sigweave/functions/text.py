"""Text canonicalisation as Column expressions: all in the JVM, nothing row by row."""

from __future__ import annotations

from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: White space as Python sees it in Latin-1 text; Java's class lacks some of these.
WS = r"[\s\x1C-\x1F\x85\xA0]"
WS_CHARACTERS = " \t\n\x0b\f\r\x1c\x1d\x1e\x1f\x85\xa0"

# The characters of U+0000 to U+00FF that NFKC changes.
NFKC_LATIN = {
    " ": " ", "¨": " ̈", "ª": "a", "¯": " ̄", "²": "2", "³": "3", "´": " ́", "µ": "μ",
    "¸": " ̧", "¹": "1", "º": "o", "¼": "1⁄4", "½": "1⁄2", "¾": "3⁄4",
}
# Typographic characters and their plain forms.
PLAIN = {"﻿": "", "–": "-", "—": "-", "‘": "'", "’": "'", "“": '"', "”": '"'}
# Units of strengths, words of dose forms, salts, marks of what is no drug, relations that bridge.
UNITS = "MG MCG UG G GRAM GRAMS KG ML MILLILITER MILLILITERS MILLILITRE MILLILITRES IU UNITS %".split()
FORM_WORDS = "TABLET TABLETS CAPSULE CAPSULES INJECTION INJECTABLE SOLUTION SUSPENSION SYRUP CREAM OINTMENT UNKNOWN UNK NOS FORMULATION GENERIC BLINDED DOSE DOSES MG MCG ML IU".split()
FORM_WORDS_CURATION = [*FORM_WORDS, "TAB", "CAP", "PATCH", "VACCINE", "NDA"]
SALTS = (
    "HYDROCHLORIDE HCL BESYLATE MALEATE MESYLATE FUMARATE PHOSPHATE DIPHOSPHATE SODIUM POTASSIUM CALCIUM MAGNESIUM "
    "SUCCINATE TARTRATE CITRATE ACETATE NITRATE MONOHYDRATE DIHYDRATE TRIHYDRATE ANHYDROUS"
).split()
NOT_DRUGS = [
    "UNKNOWN", "UNSPECIFIED", "NO DRUG NAME", "NO CONCURRENT", "THERAPY", "RADIATION", "RADIOTHERAPY", "DEVICE", "HOMEOPATH", "INVESTIGATIONAL", "CHEMOTHERAPY",
    "BIRTH CONTROL PILLS", "DRUG USED IN DIABETES", "BLOOD PRESSURE MEDICATION", "HUMAN RED BLOOD CELL", "HUMAN PLATELET", "PLATELETS",
]
NOT_DRUG_MARKS = [".", "-", "?", "??", "N/A"]


#: Characters that become one other or, at the end, none, and those that become several.
_SINGLE = dict(sorted(((k, v) for k, v in (NFKC_LATIN | PLAIN).items() if len(v) < 2), key=lambda kv: -len(kv[1])))
_LONGER = {k: v for k, v in NFKC_LATIN.items() if len(v) > 1}


def strip(c: Column) -> Column:
    return F.regexp_replace(c, rf"^{WS}+|{WS}+$", "")


def collapse(c: Column) -> Column:
    return F.regexp_replace(c, f"{WS}+", " ")


def is_blank(c: Column) -> Column:
    return F.trim(F.coalesce(c, F.lit(""))) == ""


def nfkc(df: DataFrame, column: str) -> DataFrame:
    """Full NFKC of a column of UTF-8 vocabularies by an Arrow function; use it on distinct strings."""
    import unicodedata

    @F.pandas_udf("string")
    def full(s: pd.Series) -> pd.Series:
        return s.map(lambda x: None if x is None else unicodedata.normalize("NFKC", x))

    return df.withColumn(column, full(F.col(column)))


def normalize_text(c: Column, upper: bool = True) -> Column:
    """Null becomes empty; compatibility forms (Latin-1), typographic marks, outer and inner white space, upper case."""
    t = F.coalesce(c, F.lit(""))
    plain = F.translate(t, "".join(_SINGLE), "".join(_SINGLE.values()))
    plain = reduce(lambda x, kv: F.replace(x, F.lit(kv[0]), F.lit(kv[1])), _LONGER.items(), plain)
    # Most strings are printable ASCII with single spaces inside, which all this would leave as they are.
    t = F.when(t.rlike("[^ -~]|^ | $|  "), collapse(strip(plain))).otherwise(t)
    return F.upper(t) if upper else t


def _padded(t: Column, marks: str) -> Column:
    """Outer quotes off, marks between single spaces; t has neither outer nor double white space."""
    bare = F.regexp_replace(t, "^[\"']+|[\"']+$", "")
    return F.when(t.rlike(rf"[\"'{marks}]"), strip(collapse(F.regexp_replace(bare, rf"{WS}*([{marks}]){WS}*", " $1 ")))).otherwise(t)


def normalize_drug_v2(c: Column) -> Column:
    """The ingest form of a drug term: outer quotes off, punctuation between single spaces."""
    return _padded(normalize_text(c), r",;/+()\[\]-")


def normalize_drug_v3(c: Column) -> Column:
    """The matching form: a backslash is a slash, and the ampersand is padded, too."""
    t = F.replace(normalize_text(c), F.lit("\\"), F.lit(" / "))
    return _padded(F.regexp_replace(t, "^[\"']+|[\"']+$", ""), r",;/+&()\[\]-")


def normalize_reaction(c: Column) -> Column:
    t = F.regexp_replace(normalize_text(c), f"{WS}*-+{WS}*", "-")
    return strip(collapse(F.regexp_replace(t, f"{WS}*/{WS}*", " / ")))


def clean_term(c: Column, form_words: list[str] = FORM_WORDS, normalized: bool = False) -> Column:
    """The matching form without strengths, dose forms, numbers and punctuation."""
    one = rf"\d+(?:\.\d+)?\s*(?:{'|'.join(UNITS)})"
    t = c if normalized else normalize_drug_v3(c)
    t = F.regexp_replace(t, rf"\b{one}(?:\s*/\s*{one})?\b", " ")
    t = F.regexp_replace(t, rf"\b(?:{'|'.join(form_words)})\b", " ")
    t = F.regexp_replace(t, r"\b\d+(?:\.\d+)?\b", " ")
    return F.trim(collapse(F.regexp_replace(t, r"\s*[,;/+()\[\]-]\s*", " ")))


def strip_salt(c: Column, normalized: bool = False) -> Column:
    """Trailing salt and hydrate words off, as long as something stays."""
    return F.regexp_replace(c if normalized else normalize_drug_v3(c), rf"(?<=\S)(?:\s+(?:{'|'.join(SALTS)}))+$", "")


def non_drug(c: Column) -> Column:
    t = normalize_drug_v3(c)
    return (t == "") | t.isin(NOT_DRUG_MARKS) | t.rlike(rf"\b(?:{'|'.join(NOT_DRUGS)})\b")


def variants(df: DataFrame, term: str, keys: list[str], curation: bool = False) -> DataFrame:
    """Rows (keys, priority, stage, variant): the term, its cleaned form, [AND and OR as slashes,] inner parentheses and parts; the first kind wins."""
    base = normalize_drug_v3(F.col(term))
    rows = df.select(*keys, F.col(term).alias("__t"), base.alias("__b"))
    b = F.col("__b")
    kind = lambda p, s, values: F.transform(values, lambda v: F.struct(F.lit(p).alias("priority"), F.lit(s).alias("stage"), v.alias("v")))
    parts = [kind(1, "EXACT", F.array(b)), kind(2, "CLEANED", F.array(clean_term(b, FORM_WORDS_CURATION if curation else FORM_WORDS, normalized=True)))]
    late = 3
    if curation:
        for word in ("AND", "OR"):
            parts.append(kind(3, f"{word}_TO_SLASH", F.when(b.contains(f" {word} "), F.array(F.replace(b, F.lit(f" {word} "), F.lit(" / ")))).otherwise(F.array().cast("array<string>"))))
        late = 4
    parts.append(kind(late, "PAREN", F.regexp_extract_all(b, F.lit(r"\(([^()]{2,})\)"), F.lit(1))))
    for sep in "/+,;&":
        parts.append(kind(late + 1, "SPLIT", F.when(b.contains(sep), F.split(b, f"[{sep}]")).otherwise(F.array().cast("array<string>"))))
    rows = rows.select(*keys, F.explode(F.concat(*parts)).alias("x")).select(*keys, "x.priority", "x.stage", normalize_drug_v3(F.col("x.v")).alias("variant")).where("variant <> ''")
    return rows.groupBy(*keys, "variant").agg(F.min(F.struct("priority", "stage")).alias("p")).select(*keys, "p.priority", "p.stage", "variant")


def probe_terms(c: Column) -> Column:
    """Ordered, distinct forms under which a term is looked up.

    A normal form stands in an array that a lambda reads: written out in each form that needs it, it would be computed again every time.
    """
    once = lambda value, then: F.transform(F.array(value), then)[0]
    slashed = lambda t, again, word: F.when(t.contains(word), normalize_drug_v3(F.replace(t, F.lit(word), F.lit(" / ")))).otherwise(again)

    def forms(t: Column, cleaned: Column, again: Column) -> Column:
        return F.array(t, cleaned, slashed(t, again, " AND "), slashed(t, again, " OR "), strip_salt(t, normalized=True), strip_salt(cleaned))

    rest = lambda t: once(clean_term(t, FORM_WORDS_CURATION, normalized=True), lambda cleaned: once(normalize_drug_v3(t), lambda again: F.array_distinct(forms(t, cleaned, again))))
    return F.filter(once(normalize_drug_v3(c), rest), lambda x: x != "")
