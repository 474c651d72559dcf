import base64
import hashlib
import zlib
from collections import defaultdict

import numpy as np
import pytest

from sigweave.llm import sharding, warc


def test_shards_are_even_and_gapless(spark):
    rows = [(i, "w" * (1 + i * 37 % 400), "x") for i in range(3000)] + [(i, "same text " * 9, None) for i in range(5000, 6500)] + [(None, None, None), (90007, "", None), (90007, "", None)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, size string").repartition(5)
    got = sharding.shard(df).collect()
    assert len(got) == len(rows) and {r.law for r in got} == {"bytes"} and {r.grown_shard for r in got} == {None}
    by, load = defaultdict(list), defaultdict(int)
    texts = {r[0]: r[1] for r in rows}
    for r in got:
        t = (texts[r.doc_id] or "").encode()
        assert r.size == len(t) + 1 and r.text_crc32 == zlib.crc32(t)
        by[r.shard].append(r.slot)
        load[r.shard] += r.size
    assert set(by) == set(range(16)) and all(sorted(s) == list(range(len(s))) for s in by.values())
    groups, home = defaultdict(set), defaultdict(int)
    for r in got:
        groups[texts[r.doc_id] or ""].add(r.shard)
        home[texts[r.doc_id] or ""] += r.size
    assert all(len(s) == 1 for s in groups.values())  # the group "same" holds over a third of all rows, and stays whole
    (giant,) = groups["same text " * 9]
    rest = [n for k, n in load.items() if k != giant]
    assert home["same text " * 9] <= load[giant] < home["same text " * 9] + 0.1 * max(rest)
    assert max(rest) - min(rest) < 0.01 * sum(rest) / 15
    assert sharding.shard(df.limit(0)).count() == 0


def test_copies_by_the_hundred_share_a_shard(spark):
    rows = [(i, f"text {i // 20} " * (1 + i // 20 % 50)) for i in range(4000)]
    got = sharding.shard(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    where, load = defaultdict(set), defaultdict(int)
    for r in got:
        where[r.doc_id // 20].add(r.shard)
        load[r.shard] += r.size
    assert all(len(s) == 1 for s in where.values())
    assert max(load.values()) < 1.02 * sum(load.values()) / 16  # 200 groups for 16 shards


def by_hand(vectors, shards):
    """The placing rule with plain loops."""
    total = [max(1.0, sum(v[c] for v in vectors)) for c in range(3)]
    share = [[v[c] / total[c] for c in range(3)] for v in vectors]
    left, out = [[1 / shards] * 3 for _ in range(shards)], [0] * len(vectors)
    for i in sorted(range(len(vectors)), key=lambda i: (-max(share[i]), i)):
        dots = [sum(x * y for x, y in zip(left[k], share[i], strict=True)) for k in range(shards)]
        out[i] = k = max(range(shards), key=lambda k: (round(dots[k], 15), -k))
        left[k] = [x - y for x, y in zip(left[k], share[i], strict=True)]
    return out


def test_placing_is_the_rule():
    rng = np.random.default_rng(4)
    for n in (1, 5, 60):
        v = rng.integers(1, 500, (n, 3)).astype(float)
        assert sharding.place(v, 4, moves=0).tolist() == by_hand(v.tolist(), 4)


def test_placing_balances_all_three():
    rng = np.random.default_rng(1)
    v = np.stack([rng.integers(1, 1000, 4000), rng.integers(1, 200, 4000), rng.integers(1, 9, 4000)], axis=1).astype(float)
    out = sharding.place(v, 16)
    for c, most in ((0, 1.0001), (1, 1.01), (2, 1.01)):
        load = np.bincount(out, weights=v[:, c], minlength=16)
        assert load.max() / load.mean() < most


@pytest.mark.parametrize("split, compression", [("128m", "gzip"), ("128m", "none"), ("3000b", "none")])
def test_warc_round_trip(spark, monkeypatch, split, compression):
    fake = "WARC/1.1\r\nWARC-Type: response\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"
    rows = [(i, f"http://x/{i}", f"<p>{i % 50}</p>" * (i % 7 * 30 + 1), 1) for i in range(300)]
    rows += [(1000 + i, "u v\r\n", fake * (i + 1) + "é" * 2000 + fake, 2) for i in range(20)] + [(2000, "", None, 0), (2001, None, "", 0), (5, "x", "dup", 0), (5, "x", "dup", 0), (None, "n", "lonely", 0), (None, "n", "<p>1</p>" * 31, 0), (3000, "m", "WARC/1.1\r\n", 0), (3001, "m", "\r\n\r\nWARC/1.1\r\n\r\n", 0)]
    df = spark.createDataFrame(rows, "page_id bigint, url string, html string, digest int").repartition(3)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    monkeypatch.setattr(warc, "BITS", 1 << 8)  # most bits are set: pages that are no revisits are told so by the join
    try:
        got = sorted(map(tuple, warc.round_trip(df, segment=2000 if split == "3000b" else 1 << 20, compression=compression).collect()), key=str)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    least = {}
    for i, _, h, _ in rows:
        if i is not None:
            least[h or ""] = min(i, least.get(h or "", i))
    want = []
    for i, _, h, _ in rows:
        b = (h or "").encode()
        first = least.get(h or "")
        known = first is not None and i != first
        want.append((i, len(b), base64.b32encode(hashlib.sha1(b).digest()).decode(), "revisit" if known else "response", first if known else None))
    assert got == sorted(want, key=str)


def test_warc_of_nothing(spark):
    assert warc.round_trip(spark.createDataFrame([], "page_id bigint, url string, html string")).count() == 0


def test_pointer_jumping_in_rounds(spark, monkeypatch):
    """Each round doubles the reach, and false version lines in payloads are never reached."""
    fake = "WARC/1.1\r\nWARC-Type: response\r\nContent-Length: 9\r\n\r\nabc\r\n\r\n"
    rows = [(i, "u", f"{i} " + fake * (i % 3) + "x" * 500) for i in range(400)]
    rounds, plain = [], warc.materialize
    monkeypatch.setattr(warc, "materialize", lambda df, name: (rounds.append(name), plain(df, name))[1])
    got = warc.round_trip(spark.createDataFrame(rows, "page_id bigint, url string, html string").coalesce(1), segment=2048).collect()
    assert rounds.count("reached") >= 8  # over 128 segments
    assert {(r.page_id, r.payload_digest) for r in got} == {(i, warc.digest(h.encode())) for i, _, h in rows} and len(got) == 400


def test_warc_of_string_ids_and_of_others(spark):
    rows = [("a b:c/é", "u", "x"), ("b", "u", "x"), ("", "u", "y"), (None, "u", "z"), ("7", "u", None)]
    got = sorted(map(tuple, warc.round_trip(spark.createDataFrame(rows, "page_id string, url string, html string")).select("page_id", "record_type", "refers_to").collect()), key=str)
    assert got == sorted([("a b:c/é", "response", None), ("b", "revisit", "a b:c/é"), ("", "response", None), (None, "response", None), ("7", "response", None)], key=str)
    with pytest.raises(TypeError):
        warc.round_trip(spark.createDataFrame([(1.5, "u", "x")], "page_id double, url string, html string"))
