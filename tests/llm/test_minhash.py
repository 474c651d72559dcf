import random

from corpus_pipeline import drop_near_duplicates

from sigweave.llm import minhash, simhash

SCHEMA = "doc_id bigint, text string"


def jaccard(a, b):
    x, y = (set(minhash.shingles(t.encode()).tolist()) for t in (a, b))
    return len(x & y) / len(x | y) if x | y else 1.0


def kept_by_brute_force(rows):
    """Ids of the documents that are like none before them."""
    rows = sorted(rows)
    return [i for n, (i, t) in enumerate(rows) if all(jaccard(t, u) < 0.8 for _, u in rows[:n])]


def test_near_copies_go_as_by_all_pairs(spark):
    rng = random.Random(4)
    word = lambda: f"w{rng.randrange(5000)}"
    rows = []
    for base in range(25):
        text = [word() for _ in range(120)]
        rows.append((len(rows), " ".join(text)))
        for changes in (0, 1, 2, 3, 4, 8):
            copy = list(text)
            for at in rng.sample(range(120), changes):
                copy[at] = word()
            rows.append((len(rows), " ".join(copy)))
    text = [word() for _ in range(120)]
    for _ in range(90):  # one group that shares keys by dozens, alike and not alike
        copy = list(text)
        for at in rng.sample(range(120), rng.randrange(5)):
            copy[at] = word()
        rows.append((len(rows), " ".join(copy)))
    got = sorted(r.doc_id for r in drop_near_duplicates(spark, spark.createDataFrame(rows, SCHEMA).repartition(3), "").collect())
    assert got == kept_by_brute_force(rows) and 25 < len(got) < len(rows)
    # The same in blocks of a few nodes, and without a first round that leaves little to them.
    few = minhash.keep_one(spark.createDataFrame(rows, SCHEMA), settings=minhash.Settings(block=1500, first=1))
    assert sorted(r.doc_id for r in few.collect()) == got


def test_rows_without_words_ids_or_partners(spark):
    rows = [(1, None), (2, ""), (3, " \t"), (4, "one two"), (5, "One  TWO"), (6, "three"), (None, "three"), (None, "four"), (7, "five"), (7, "five")]
    got = minhash.keep_one(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted((r.doc_id or 99, r.text or "") for r in got) == [(1, ""), (4, "one two"), (6, "three"), (7, "five"), (99, "four")]
    assert minhash.keep_one(spark.createDataFrame([], SCHEMA)).count() == 0


def test_pigeonring_finds_the_closest_copies(spark):
    """Copies of one word's difference go by their SimHash fingerprints alone: a key of 500 minima is shared by none but equal sets."""
    rng = random.Random(7)
    rows = []
    for i in range(0, 24, 2):
        text = [f"w{rng.randrange(5000)}" for _ in range(1500)]
        rows += [(i, " ".join(text)), (i + 1, " ".join([*text[:700], "other", *text[701:]]))]
    prints = [minhash.majority(minhash.shingles(t.encode())) for _, t in rows]
    close = {i + 1 for i in range(0, 24, 2) if (prints[i] ^ prints[i + 1]).bit_count() <= 2}
    got = minhash.keep_one(spark.createDataFrame(rows, SCHEMA), settings=minhash.Settings(bands=1, rows=500))
    gone = {i for i, _ in rows} - {r.doc_id for r in got.collect()}
    assert len(close) > 6 and close <= gone and gone <= {i + 1 for i in range(0, 24, 2)}


def test_tables_are_brought_together_few_times(spark, monkeypatch):
    """Each exchange is a stage whose tasks, metrics and plan the driver holds for a while, however many rows there are."""
    counts = []

    def counted(df, name, write=minhash.materialize):
        counts.append(df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning"))
        return write(df, name)

    monkeypatch.setattr(minhash, "materialize", counted)
    monkeypatch.setattr(simhash, "materialize", counted)
    monkeypatch.setattr(minhash, "whole_rows", lambda docs, row, prints, kept: kept)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        kept = minhash.keep_one(spark.createDataFrame([(1, "a b"), (2, "a  b"), (3, "c")], SCHEMA))
        counted(kept, "kept", lambda df, name: None)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert sum(counts) <= 44
