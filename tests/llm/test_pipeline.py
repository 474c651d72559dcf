import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from sigweave.llm import minhash, secrets, toxicity

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars int, ids string, n_tokens int, size string"
BAD = ["vermin", "gutless", "cretin", "buffoon"]


def corpus():
    rng = random.Random(5)
    syllables = ["th", "er", "on", "an", "re", "he", "in", "ed", "nd", "ha"]
    word = lambda: "".join(rng.choices(syllables, k=rng.randrange(1, 4)))
    rows, labels = [], []
    for i in range(240):
        ws, bad = [word() for _ in range(60)], i % 4 == 0
        for _ in range(3 * bad):
            ws[rng.randrange(60)] = rng.choice(BAD)
        rows.append([i, " ".join(ws), "en", f"s{i % 3}"])
        labels.append((i, None, int(bad)))
    for i in range(300, 330):  # near copies of clean documents: one word of sixty differs at the end
        ws = rows[i - 299][1].split()
        rows.append([i, " ".join([*ws[:-1], "changed"]), "en", "copies"])
    rows += [[400, rows[1][1], "en", "s1"], [400, rows[1][1], "en", "s1"], [401, None, None, None], [402, "", "en", "s0"], [403, " ", None, None], [None, "a text without an id of any kind at all", "en", None]]
    rows += [[404, "my password = hunter2hunter2 and nothing else that is worth a word", "en", "s2"], [405, "x" * 30_000, "en", "s2"]]
    return [(*r, len(r[1] or ""), "own", 7, "big") for r in rows], labels


def alike(a, b):
    x, y = (set(minhash.shingles((t or "").encode()).tolist()) for t in (a, b))
    return len(x & y) >= 0.8 * len(x | y)


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("corpus"))
    rows, labels = corpus()
    spark.createDataFrame(rows, SCHEMA).repartition(3).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    out = [spark.read.parquet(f"{folder}/documents.parquet")]
    for name, stage in corpus_pipeline.STAGES:
        out.append(corpus_pipeline.materialize(stage(spark, out[-1], folder), name))
    return folder, [sorted((r.asDict() for r in df.collect()), key=str) for df in out], [df.columns for df in out]


def test_stages_by_brute_force(spark, stages):
    from tokenizers import Tokenizer

    from sigweave.llm import bpe

    folder, (docs, ordinary, single, masked, mixed, encoded), columns = stages
    assert all(c == columns[0] for c in columns[1:5])
    model = toxicity.fit_table(spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/labels.parquet"))
    assert ordinary == [r for r in docs if model.score(r["text"] or "") < 0.7]
    assert sum(any(w in (r["text"] or "") for w in BAD) for r in ordinary) <= 4 and len(ordinary) > 170
    left = []  # each against those before it that are still there or not: a document goes if one before it is alike
    order = sorted(ordinary, key=lambda r: (r["doc_id"] is None, r["doc_id"] or 0))
    for i, r in enumerate(order):
        if not any(alike(r["text"], x["text"]) for x in order[:i]):
            left.append(r)
    assert single == sorted(left, key=str)
    want = [r | {"text": None if r["text"] is None else secrets.redact(r["text"])} for r in single]
    want = [r if r["text"] is None else r | {"n_chars": len(r["text"])} for r in want]
    assert masked == sorted(want, key=str) and any("<secret>" in (r["text"] or "") for r in masked)
    size = lambda r: len((r["text"] or "").split())
    sizes, taken = {r["doc_id"]: size(r) for r in masked}, {}
    for r in mixed:
        taken[r["doc_id"]] = taken.get(r["doc_id"], 0) + size(r)
        assert any(x["text"].startswith(r["text"]) for x in masked if x["doc_id"] == r["doc_id"])
    assert all(n <= 2 * sizes[i] for i, n in taken.items())
    assert abs(sum(taken.values()) - 1.5 * sum(sizes.values())) <= 4
    tok = Tokenizer.from_file(bpe.tokenizer_path())
    ids = lambda r: tok.encode(r["text"], add_special_tokens=False).ids
    want = [{k: v for k, v in r.items() if k not in ("text", "ids", "n_tokens")} | {"doc_ids": "own", "doc_n_tokens": 7, "ids": ids(r), "n_tokens": len(ids(r))} for r in mixed]
    assert sorted((sorted(r.items()) for r in encoded), key=str) == sorted((sorted(r.items()) for r in want), key=str)


def test_run_on_empty_tables(spark, tmp_path):
    spark.createDataFrame([], "doc_id bigint, text string, lang string, source string, n_chars int").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id bigint, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    got = corpus_pipeline.run(spark, str(tmp_path))
    assert got.count() == 0 and got.columns == ["doc_id", "lang", "source", "n_chars", "ids", "n_tokens"]


def test_run_is_its_stages(spark, stages):
    folder, tables, _ = stages
    assert corpus_pipeline.run(spark, folder).select(F.sum("n_tokens")).first()[0] == sum(r["n_tokens"] for r in tables[-1])
