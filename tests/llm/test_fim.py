import hashlib
import random
import re

import pytest

from sigweave.llm import fim

TOKEN = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")


def by_hand(doc_id, text, percent=50):
    """The contract with a regular expression and lists."""
    d = hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(d[i : i + 8], 16) for i in range(0, 32, 8))
    units = TOKEN.findall(text)
    n = len(units)
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= percent:
        return n, "plain", None, None, text
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if h4 % 100 < 80:
        return n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def texts(count):
    rng = random.Random(7)
    bits = ["a", "bc", " ", "  ", "\n", "\t", "\x0b", "é", "日本", "😀", " ", " ", "\x1c", "\x00", "<", "P>", "<P", "x" * 70]
    return ["".join(rng.choice(bits) for _ in range(rng.choice((0, 1, 2, 5, 40, 300)))) for _ in range(count)]


def test_fill_in_middle_is_the_contract(spark):
    some = [None, "", " ", "\n\n", "a", " a ", "<M>", "one <P> two", "word " * 60000, "x" * 200001, " " * 5001] * 3 + texts(600)
    rows = [(i if i != 3 else None, t, "clash", 1.0) for i, t in enumerate(some)] + [(9000, "again and again", "c", None)] * 3
    df = spark.createDataFrame(rows, "doc_id bigint, text string, output string, n double").repartition(5)
    made = fim.fill_in_middle(df.drop("output", "n"), ["doc_id", "text"])
    got = made.withColumn("back", fim.restored(made["output"], made["form"])).collect()
    assert len(got) == len(rows)
    for r in got:
        text = r.text or ""
        assert (r.n, r.form, r.prefix_chars, r.middle_chars, r.output) == by_hand(r.doc_id, text)
        assert r.back == text
    assert {r.form for r in got} == {"plain", "spm", "psm"}
    assert fim.fill_in_middle(df, ["doc_id"]).count() == len(rows)  # clashing columns that are not kept
    assert fim.fill_in_middle(df.limit(0), ["doc_id"]).collect() == []


def test_ranks_are_selected_by_halving():
    rng = random.Random(3)
    for width in (1, 2, 3, 64, 65, 1000, 4097):
        mask = rng.getrandbits(width)
        places = [i for i in range(width) if mask >> i & 1]
        ranks = sorted(rng.choices(range(1, len(places) + 1), k=min(5, len(places)))) if places else []
        assert fim.select(mask, width, ranks) == [places[r - 1] for r in ranks]


def test_marks_must_part_outputs(spark):
    s = fim.Settings(percent=100, prefix="⟨pre⟩", suffix="⟨suf⟩", middle="⟨mid⟩")
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts(60))], "id bigint, body string")
    made = fim.fill_in_middle(df, ["id", "body"], "id", "body", s)
    rows = made.withColumn("back", fim.restored(made["output"], made["form"], s)).collect()
    assert all(r.back == r.body for r in rows) and {r.form for r in rows if r.body} == {"spm", "psm"}
    for bad in (("<P>", "<P>", "<M>"), ("", "<S>", "<M>"), ("aba", "c", "d"), ("<P", "<P>", "<M>")):
        with pytest.raises(ValueError, match="marks"):
            fim.Settings(prefix=bad[0], suffix=bad[1], middle=bad[2])
