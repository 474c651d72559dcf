import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from sigweave.llm import variants


def near(a, b):
    """One inserted, deleted or replaced character."""
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    if len(a) > len(b):
        a, b = b, a
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def by_hand(counts, ratio=5):
    """word -> (form, root, n, n_near, form_n) by comparing all pairs."""
    out, form = {}, {}
    for w, n in counts.items():
        some = [v for v in counts if near(w, v)]
        best = min(some, key=lambda v: (-counts[v], v), default=None)
        form[w] = best if best is not None and counts[best] >= ratio * n else None
        out[w] = [form[w], None, n, len(some), counts[best] if form[w] else None]
    for w in counts:
        root = w
        while form[root]:
            root = form[root]
        out[w][1] = root
    return {w: tuple(x) for w, x in out.items()}


def found(df):
    return {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in df.collect()}


def some_words(rng, count, letters="abé", lengths=(5, 9)):
    words = set()
    while len(words) < count:
        w = "".join(rng.choice(letters) for _ in range(rng.randint(*lengths)))
        words.add(w)
        if rng.random() < 0.7:
            i = rng.randrange(len(w))
            words.add(w[:i] + rng.choice(["", rng.choice(letters) * 2, rng.choice(letters)]) + w[i + 1 :])
    return {w: rng.choice((5, 6, 25, 26, 130, 700, 4000)) for w in sorted(words) if w}


def test_tree_reports_rectangles():
    rng = np.random.default_rng(1)
    for n in (1, 2, 3, 8, 9, 300):
        values = rng.permutation(n)
        tree = variants.WaveletTree(values)
        a, b, c, d = (rng.integers(0, n + 1, 60) for _ in range(4))
        of, got = tree.report(a, b, c, d)
        want = [(q, v) for q in range(60) for v in values[a[q] : max(a[q], b[q])].tolist() if c[q] <= v < d[q]]
        assert sorted(zip(of.tolist(), got.tolist(), strict=True)) == sorted(want)


@pytest.mark.parametrize("settings", [variants.Settings(), variants.Settings(block=40), variants.Settings(block=64, chunk=7)])
def test_forms_are_those_of_all_pairs(spark, settings):
    rng = random.Random(settings.chunk)
    counts = some_words(rng, 260) | {"x" * 300: 9, "x" * 301: 99, "x" * 150 + "y" + "x" * 149: 7, "lonely": 5, "q": 30, "": 6, "qr": 900}
    counts |= {f"prefix{chr(97 + i)}{chr(97 + j)}": 5 + 40 * (i == j) for i in range(12) for j in range(12)}  # a half that a third of all share
    df = spark.createDataFrame(list(counts.items()), "word string, n bigint").repartition(3)
    assert found(variants.forms(df, settings)) == by_hand(counts)


def test_forms_are_followed_to_the_last(spark):
    counts = {"a" * 6 + "b" * i: 5**i for i in range(1, 12)}
    got = found(variants.forms(spark.createDataFrame(list(counts.items()), "word string, n bigint")))
    assert got == by_hand(counts) and {r[1] for r in got.values()} == {"a" * 6 + "b" * 11}
    with pytest.raises(ValueError, match="frequent"):
        variants.Settings(ratio=1)


def test_words_of_whole_texts(spark):
    rng = random.Random(4)
    bits = ["Strasse", "straße", "ÉCOLE", "naïveté", "wordy", "letters", "abc", "×÷mixed", "ŁódźCity", "Ångström", "日本languages", "x" * 4000]
    texts = [None, "", " ", "a" * 50000, *(rng.choice(["", " ", "-", "\n"]).join(rng.choice(bits) for _ in range(rng.choice((1, 5, 300)))) for _ in range(300))]
    rows = [(i if i != 4 else None, t, 1) for i, t in enumerate(texts)] + [(500, "repeated ROWS count repeated", 2)] * 30
    df = spark.createDataFrame(rows, "doc_id bigint, text string, n int").repartition(4)
    for s in (variants.Settings(), variants.Settings(typo=5, least=1, shortest=3, held=10)):
        counts = Counter()
        for i, t, _ in rows:
            for w in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
                w = "".join(c.lower() if "A" <= c <= "Z" else c for c in w)
                h = zlib.crc32(f"{'' if i is None else i}:{w}".encode())
                counts[w[: h % len(w)] + w[h % len(w) + 1 :] if h % s.typo == 0 else w] += 1
        want = {w: n for w, n in counts.items() if len(w) >= s.shortest and n >= s.least}
        assert {r.word: r.n for r in variants.vocabulary(df, settings=s).collect()} == want
    assert variants.forms(variants.vocabulary(df.limit(0))).collect() == []
