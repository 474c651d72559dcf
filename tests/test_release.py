"""Releases: parts by tasks, digests while writing, nothing left by a lost run."""

import hashlib

import pytest
from pyspark.sql import functions as F

from sigweave.sources import release_sink as r


def test_digests_as_trees(tmp_path, monkeypatch):
    monkeypatch.setattr(r, "BLOCK", 4)
    h = lambda b: hashlib.sha256(b).digest()
    assert r.tree_root([]) == h(b"").hex()
    want = h(h(h(b"abcd") + h(b"efgh")) + h(b"i")).hex()
    with open(tmp_path / "x", "wb") as f:
        out = r._Digested(f)
        for piece in (b"ab", b"", b"cdefghi"):
            out.write(piece)
    assert out.root() == want
    with open(tmp_path / "x", "rb") as f:
        assert r.digest_of(f) == want


def test_a_release(spark, tmp_path):
    root = str(tmp_path / "out")
    edges = spark.range(1000).select((F.col("id") % 10).alias("a"), F.concat(F.lit("o"), F.col("id").cast("string")).alias("b"), F.array("id").alias("c")).repartition(3, "a").sortWithinPartitions("b")
    for release in ("v1", "v2"):
        r.write_table(edges, root, release, "edges")
    r.write_table(edges.limit(0), root, "v1", "empty")
    found = {(x.release, x.table): x for x in r.releases(spark, root).collect()}
    assert found["v1", "edges"].rows == 1000 and found["v1", "edges"].digest == found["v2", "edges"].digest != found["v1", "empty"].digest
    assert found["v1", "empty"].rows == 0
    assert spark.read.parquet(f"{root}/v1/edges").exceptAll(edges).count() == 0
    assert [x.ok for x in r.verified(spark, root, "v1").collect()] == [True] * found["v1", "edges"].parts
    with pytest.raises(FileExistsError):
        r.write_table(edges, root, "v1", "edges")
    part = next((tmp_path / "out" / "v1" / "edges").glob("part*"))
    part.write_bytes(part.read_bytes()[:-9] + b"x" * 9)
    next((tmp_path / "out" / "v2" / "edges").glob("part*")).unlink()
    assert sorted(x.ok for x in r.verified(spark, root, "v1").collect()).count(False) == 1
    assert sorted(x.ok for x in r.verified(spark, root, "v2").collect()).count(False) == 1


def test_an_abort_leaves_nothing(spark, tmp_path):
    root = str(tmp_path / "out")
    lost = spark.range(1000, numPartitions=4).select(F.when(F.col("id") == 900, F.raise_error(F.lit("lost"))).otherwise(F.col("id")).alias("id"))
    with pytest.raises(Exception, match="lost"):
        r.write_table(lost, root, "v1", "edges")
    assert r.releases(spark, root).count() == 0
    assert [p for p in (tmp_path / "out").rglob("*") if p.is_file()] == []
    r.write_table(spark.range(5), root, "v1", "edges")
    assert r.releases(spark, root).first().rows == 5
