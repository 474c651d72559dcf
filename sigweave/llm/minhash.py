"""Near-duplicates by Jaccard similarity of word shingles: SimHash with pigeonring filtering and MinHash bands for candidates, exact similarity for the verdict.

A document goes if one before it (smaller id, null last, then smaller fingerprint) has at least `similarity` of its shingles in common, in
Jaccard's sense. So no two documents that stay are known to be that alike, and each one that goes is that alike to one before it; unlike
documents are never joined through a third. Documents with equal shingle sets are one node.

First come the pairs that pigeonring filtering of the shingles' SimHash finds (simhash.close_pairs, 2 of 64 bits). At 0.8 about 10 bits differ, so these are
the closest copies alone; what they leave is asked on by MinHash.

Each node has `bands` keys of `rows` minima. Two nodes of similarity j share a key with probability 1 - (1 - j^rows)^bands: at 0.8, 5 rows
and 32 bands miss 3 in a million. Nodes of a key stand in order. Each is first held against the nearest few before it; one that stays is
held against all before it, however many share the key: a key's nodes are cut into blocks of a bounded number of shingles, and a task holds
the nodes left of one block against another block, all at once, by products of sparse rows. No pairs are listed, and a pair is
compared only under the first key that it shares.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import as_bytes, map_columns, materialize, text_of
from .simhash import LOWER, close_pairs, majority, row_key, whole_rows


@dataclass(frozen=True)
class Settings:
    shingle: int = 5
    similarity: float = 0.8
    bands: int = 32
    rows: int = 5
    first: int = 4  # nodes before it that a node is held against in the first round
    block: int = 1 << 21  # shingles of a block
    seed: int = 42


def shingles(text: bytes, n: int = 5, seed: int = 42) -> np.ndarray:
    """Sorted distinct XXH64 values of the text's n-word shingles; fewer words are one shingle, no word gives none."""
    import xxhash

    hashed = xxhash.xxh64_intdigest
    words = text.translate(LOWER).split()
    if not words:
        return np.zeros(0, np.uint64)
    if len(words) <= n:
        return np.array([hashed(b" ".join(words), seed)], np.uint64)
    made = map(b" ".join, zip(*(words[i:] for i in range(n)), strict=False))
    return np.unique(np.fromiter((hashed(s, seed) for s in made), np.uint64, len(words) - n + 1))


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _prints(texts, s: Settings):
    import xxhash

    rng = np.random.default_rng(s.seed)
    factor = rng.integers(0, 1 << 63, s.bands * s.rows, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    added = rng.integers(0, 1 << 63, s.bands * s.rows, dtype=np.uint64)
    fps, keys, sims = [], [], []
    for t in as_bytes(texts):
        h = shingles(t, s.shingle, s.seed)
        least = np.full(len(factor), (1 << 64) - 1, np.uint64)
        for at in range(0, len(h), 256):
            np.minimum(least, (h[at : at + 256, None] * factor + added).min(axis=0), out=least)
        fps.append(_signed(xxhash.xxh64_intdigest(h.tobytes(), s.seed)))
        sims.append(_signed(majority(h)))
        keys.append([_signed(xxhash.xxh64_intdigest(m.tobytes(), i)) for i, m in enumerate(least.reshape(s.bands, s.rows))])
    return [fps, keys, sims]


def _sets(texts, s: Settings):
    return [[shingles(t, s.shingle, s.seed).tobytes() for t in as_bytes(texts)]]


def _alike(pairs: DataFrame, similarity: float) -> DataFrame:
    """d of the pairs (d, a, b) whose sets a and b reach the similarity, perhaps repeated."""

    def run(batches):
        for batch in batches:
            out = []
            for d, a, b in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2), strict=True):
                x, y = (np.frombuffer(v.as_buffer(), np.uint64) for v in (a, b))
                if min(len(x), len(y)) >= similarity * max(len(x), len(y)):
                    both = len(np.intersect1d(x, y, assume_unique=True))
                    if both >= similarity * (len(x) + len(y) - both):
                        out.append(d)
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.int64())], names=["d"])

    return pairs.mapInArrow(run, "d bigint")


def _overlaps(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """For each of left and each of right the number of shingles in common."""
    out = np.zeros((len(left), len(right)), np.float32)
    l_of, r_of = np.repeat(np.arange(len(left)), list(map(len, left))), np.repeat(np.arange(len(right)), list(map(len, right)))
    common, l_at, r_at = (x for x in _places(np.concatenate([*left, np.zeros(0, np.uint64)]), np.concatenate([*right, np.zeros(0, np.uint64)])))
    for a in range(0, common, 2048):
        x, y = np.zeros((len(left), min(2048, common - a)), np.float32), np.zeros((len(right), min(2048, common - a)), np.float32)
        for to, of, at in ((x, l_of, l_at), (y, r_of, r_at)):
            some = (at >= a) & (at < a + 2048)
            to[of[some], at[some] - a] = 1
        out += x @ y.T
    return out


def _places(left: np.ndarray, right: np.ndarray) -> tuple[int, np.ndarray, np.ndarray]:
    """How many values both have, and each one's place among these (-1: none)."""
    both = np.intersect1d(left, right)
    place = lambda x: np.where(np.isin(x, both), np.searchsorted(both, x), -1)
    return len(both), place(left), place(right)


def _block_pairs(s: Settings):
    """d of the nodes left in one block that are alike to one before them in another."""

    def run(group: pa.Table) -> pa.Table:
        order = group.sort_by("at")
        sets = [np.frombuffer(v.as_buffer(), np.uint64) for v in order.column("shingles").combine_chunks()]
        keys = order.column("keys").combine_chunks().flatten().to_numpy().reshape(len(sets), s.bands)
        fp, at, asks, band = (order.column(c).to_numpy() for c in ("fp", "at", "asks", "band"))
        held = order.column("held").to_numpy()
        sizes = np.array(list(map(len, sets)))
        out = []
        lefts, rights = np.flatnonzero(asks), np.flatnonzero(held)
        for i in range(0, len(lefts), 256):
            some, gone = lefts[i : i + 256], np.zeros(len(lefts[i : i + 256]), bool)
            for j in range(0, len(rights), 1024):
                other = rights[j : j + 1024]
                ok = at[other][None, :] < at[some][:, None]
                least, most = np.minimum(sizes[some][:, None], sizes[other]), np.maximum(sizes[some][:, None], sizes[other])
                ok &= least >= s.similarity * most
                for k in range(int(band[0])):  # a pair with an earlier key in common is compared there
                    ok &= keys[some, k][:, None] != keys[other, k]
                if not ok.any():
                    continue
                both = _overlaps([sets[x] for x in some], [sets[x] for x in other])
                gone |= (ok & (both >= s.similarity * (sizes[some][:, None] + sizes[other] - both))).any(axis=1)
            out += fp[some[gone]].tolist()
        return pa.table({"d": pa.array(out, pa.int64())})

    return run


def _in_blocks(near: DataFrame, shared: DataFrame, sets: DataFrame, s: Settings) -> DataFrame:
    """d (perhaps repeated) of the nodes beyond the first few of a key, near aside, that are alike to any node before them under a key."""
    asks = F.col("gone").isNull() & (F.col("at") - 1 > s.first)
    # The windows see places and lengths alone; what a node holds comes to its blocks afterwards.
    sizes = sets.select("fp", (F.length("shingles") / 8 + 1).alias("size"))
    members = shared.select("key", "band", "fp", "at").join(near.select(F.col("d").alias("fp"), F.lit(True).alias("gone")).distinct().hint("merge"), "fp", "left")
    members = members.join(sizes.hint("merge"), "fp").select("key", "band", "fp", "at", "size", asks.alias("asks"))
    whole, place = Window.partitionBy("key"), Window.partitionBy("key").orderBy("at")
    members = members.withColumn("__asked", F.max("asks").over(whole)).where("__asked").drop("__asked")
    members = members.withColumn("block", F.floor((F.sum("size").over(place) - 1) / s.block).cast("int"))
    # A key's blocks that ask: one for each `block` shingles under it.
    members = materialize(members.withColumn("live", F.collect_set(F.when(F.col("asks"), F.col("block"))).over(whole)), "members")
    columns = ["key", "band", "fp", "at"]
    held = members.select(*columns, F.lit(False).alias("asks"), F.lit(True).alias("held"), F.col("block").alias("j"), F.explode(F.filter("live", lambda i: i >= F.col("block"))).alias("i"))
    asking = members.where("asks").select(*columns, "asks", F.lit(False).alias("held"), F.explode(F.sequence(F.lit(0), "block")).alias("j"), F.col("block").alias("i"))
    dealt = held.unionByName(asking).join(sets.select("fp", "shingles", "keys").hint("merge"), "fp")
    return dealt.groupBy("key", "i", "j").applyInArrow(_block_pairs(s), "d bigint")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", settings: Settings = Settings()) -> DataFrame:
    """docs without those that are near-duplicates of one before them; a document goes even if the one before it goes itself.

    Null and empty texts have no shingle and are alike. Of rows equal in text the smallest id stays, null last, then the smallest hash of the row; of equal rows
    one. A text of any length is one set of hashes in a task; other columns, whatever their names, are kept. An empty table gives no rows.
    """
    s = settings
    row = row_key(docs, id_col)
    prints = materialize(map_columns(docs, [row.alias("k")], [text_of(docs, text_col)], {"fp": "bigint", "keys": "array<bigint>", "sim": "bigint"}, _prints, s=s), "prints")
    firsts = materialize(prints.groupBy("fp").agg(F.min("k").alias("k"), F.any_value("keys").alias("keys"), F.any_value("sim").alias("sim")), "firsts")
    ringed = materialize(close_pairs(firsts.select("fp", "sim", F.struct("k.none", "k.id", "fp").alias("place"))), "ringed")
    keyed = firsts.select("fp", F.col("k.none").alias("none"), F.col("k.id").alias("id"), F.posexplode("keys").alias("band", "key"))
    # A key's nodes in order, each with the nearest few before it; a node that has its key alone goes.
    place = Window.partitionBy("key").orderBy("none", "id", "fp")
    before = F.array(*(F.lag("fp", i).over(place) for i in range(1, s.first + 1)))
    shared = keyed.select("key", "band", "fp", F.row_number().over(place).alias("at"), before.alias("before"), F.lead("fp").over(place).alias("next"))
    shared = materialize(shared.where("at > 1 or next is not null").drop("next"), "shared")
    held = shared.select("fp").unionByName(ringed.select("fp")).unionByName(ringed.select(F.col("d").alias("fp"))).distinct()
    asked = firsts.join(held.hint("merge"), "fp", "left_semi").select("k", "fp", "keys")
    texts = docs.select(row.alias("k"), text_of(docs, text_col).alias("text")).join(asked.hint("merge"), "k")
    texts = texts.groupBy("k").agg(*(F.any_value(c).alias(c) for c in ("fp", "keys", "text")))  # equal rows
    sets = materialize(map_columns(texts, ["fp", "keys"], [F.col("text")], {"shingles": "binary"}, _sets, s=s), "sets")

    def alike(pairs: DataFrame) -> DataFrame:
        pairs = pairs.join(sets.select("fp", F.col("shingles").alias("a")).hint("merge"), "fp").join(sets.select(F.col("fp").alias("d"), F.col("shingles").alias("b")).hint("merge"), "d")
        return _alike(pairs.select("d", "a", "b"), s.similarity)

    ring = materialize(alike(ringed), "ring")
    # The nearest few before it: a pair is compared once, whatever the number of keys that it shares.
    reach = shared.where("at > 1").select(F.col("fp").alias("d"), "before").join(ring.hint("merge"), "d", "left_anti")
    reach = reach.select("d", F.explode("before").alias("fp")).where("fp is not null").distinct()
    near = materialize(ring.unionByName(alike(reach)), "near")
    far = materialize(_in_blocks(near, shared, sets, s), "far")
    gone = near.unionByName(far)
    kept = firsts.join(gone.hint("merge"), firsts["fp"] == gone["d"], "left_anti").select("k")
    return whole_rows(docs, row, prints, kept)
